"""N-gram Jaccard join by PartEnum signatures, and the components of its links.

A document is its set of distinct word shingles (64-bit hashes; two texts with equal lowered words
are merged first, by digest).  Two sets with Jaccard >= t differ in at most (a + b)(1 - t)/(1 + t)
features.  Sizes fall into bands; a band deals the feature domain into a fixed number of partitions,
and the projection of a set on one non-empty partition is a signature.  A larger set whose partner may
lie in the band below also signs there.  If a set gives its first k + 1 non-empty partitions, k being
the most features in which any partner may differ, one of them is free of differences and both sides
have it: similar sets share a signature.  Small sets use each feature as a partition of its own.

Each set gives some spare signatures beyond k + 1 (`spare`), so similar sets share one more than the
smaller one's spare.  A set may therefore drop as many signatures as any of its partners has to spare
and is still found by all of them.  Signatures held by more than three sets (common passages) are
dropped that way; sets that hold more of these than they can drop (members of large groups of near
copies) are crowded and keep them.  Sets with too few non-empty partitions share one more signature.

Links are then looked for until no unseen link could join two components.  Similar sets share at
least one signature more than either can spare, less those that are crowded, so pairs that share fewer
are none; pairs are counted only within signatures of at most three sets.
1. pairs that share enough of these are compared, and each crowded set with the first set of the
   crowded signatures it has most in common with; components follow;
2. pairs that share enough only if crowded signatures are added, and lie in different components;
3. in every crowded signature that still holds several components, the sets outside its largest one
   are queries: blocks of them, as a feature index, meet all crowded sets (rows, not pairs, move).
Comparison is exact on the features: 100 * shared >= percent * union.

Defined results: null, empty or wordless texts have no feature and no link, and are their own
component; rows without an id get a null component; repeated rows of one id count once and are each
reported; texts of one id that differ are taken as one node; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.components import components
from tillwatch.llm.shared import discard, narrow_batches, small, stored
from tillwatch.llm.words import Words, long_list, mix, runs_hash, spans_hash, word_slices

SHINGLE = 5
PERCENT = 75
#: sets up to this size sign with single features
TINY = 24
#: ratio of the sizes at a band's ends, in steps of one similarity bound
STEPS = 4
#: most sets of a signature whose members are kept one by one
FEW = 3
#: features in one block of queries (a broadcast of 16 bytes each)
BLOCK_FEATURES = 2_000_000
_U = np.uint64


def feature_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, texts in order and features sorted, and their numbers."""
    hashes = words.hashes()
    runs = runs_hash(hashes, k)
    of = words.text_of_word()
    start = np.flatnonzero(of[: len(runs)] == of[k - 1 :]) if len(runs) else np.zeros(0, int)
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    values = np.concatenate([runs[start], spans_hash(hashes, words.bounds[short], words.bounds[short + 1])])
    text = np.concatenate([of[start], short])
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[new], text[new]
    return values, np.bincount(text, minlength=len(words.counts))


class Bands:
    """Size bands for a similarity of percent/100, and how many partitions and signatures each takes."""

    def __init__(self, percent: int):
        self.percent = percent
        self.lows, low = [1], TINY + 1
        while low < 1 << 40:
            self.lows.append(low)
            low = low * 100**STEPS // percent**STEPS + 1
        self.lows = np.array(self.lows, np.int64)

    def partitions(self, band: np.ndarray) -> np.ndarray:
        """About 1.6 features a partition (1.3 in small sets, whose partitions vary more) at the band's upper end."""
        top = self.lows[band + 1]
        return np.where(top < 200, top * 10 // 13, top * 5 // 8) + 1

    def spare(self, size: np.ndarray) -> np.ndarray:
        """Signatures that a set gives beyond the needed ones; never fewer for a larger set."""
        return 2 + size // 12

    def salt(self, band: np.ndarray) -> np.ndarray:
        return mix(band.astype(np.uint64) + _U(77))

    def last_resort(self, band: np.ndarray) -> np.ndarray:
        """The signature of all sets of a band with too few non-empty partitions."""
        return mix(self.salt(band) + _U(99))

    def differing(self, size: np.ndarray, partner: np.ndarray) -> np.ndarray:
        """Most features in which sets of these sizes may differ."""
        return (size + partner) * (100 - self.percent) // (100 + self.percent)

    def roles(self, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(which sets, their band, most differing features): in the own band, and in the one below."""
        band = np.searchsorted(self.lows, size, "right") - 1
        own = np.flatnonzero(size > 0)
        least = -(-size * self.percent // 100)
        below = np.flatnonzero((size > 0) & (band > 0) & (least < self.lows[band]))
        return [
            (own, band[own], self.differing(size[own], size[own] * 100 // self.percent)),
            (below, band[below] - 1, self.differing(size[below], self.lows[band[below]] - 1)),
        ]


def signatures(values: np.ndarray, counts: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """signature, text index, role, and how many signatures of that role the text can spare."""
    ends = np.cumsum(counts)
    out: list[tuple] = []
    for role, (which, band, differing) in enumerate(bands.roles(counts)):
        if not len(which):
            continue
        size = counts[which]
        where = np.repeat(np.arange(len(which)), size)
        at = np.arange(len(where)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(ends[which] - size, size)
        feature = values[at]
        salt = bands.salt(band)
        tiny = band == 0
        parts = np.where(tiny, 1, bands.partitions(band)).astype(np.uint64)
        spread = mix(feature ^ salt[where]) >> _U(32)
        part = np.where(tiny[where], np.arange(len(where)).astype(np.uint64), (spread * parts[where]) >> _U(32))
        order = np.lexsort((part, where))
        where, part, feature = where[order], part[order], feature[order]
        head = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (where[1:] != where[:-1])]))
        of = where[head]
        number = np.where(tiny[of], _U(0), part[head])
        sign = mix(np.add.reduceat(mix(feature), head) + salt[of] + mix(number + _U(5)))
        full = np.bincount(of, minlength=len(which))
        rank = np.arange(len(head)) - np.repeat(np.cumsum(full) - full, full)
        need = differing + 1
        given = np.where(tiny, full, np.minimum(full, need + bands.spare(size)))
        keep = rank < given[of]
        partner = -(-size * bands.percent // 100)
        poor = np.flatnonzero(~tiny & (full < need + bands.spare(size)))
        spare = np.where(tiny, full - need, bands.spare(partner))
        spare[poor] = -1
        text = np.concatenate([of[keep], poor])
        out.append((np.concatenate([sign[keep], bands.last_resort(band[poor])]), which[text], np.full(len(text), role), spare[text]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def _sizes(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in word_slices(batch.column("text"), "space_lower"):
            _, counts = feature_sets(words, k)
            bounds, n = words.bounds, j - i
            digest = spans_hash(words.hashes(), bounds[:-1], bounds[1:])
            other = spans_hash(words.hashes(1), bounds[:-1], bounds[1:], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, n), pa.array(counts.astype(np.int64)), pa.array(digest.view(np.int64)), pa.array(other.view(np.int64))],
                names=["doc_id", "n_shingles", "digest", "other"],
            )


def _sign(batches: Iterator[pa.RecordBatch], k: int, bands: Bands) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, _, words in word_slices(batch.column("text"), "space_lower"):
            sign, text, role, spare = signatures(*feature_sets(words, k), bands)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sign.view(np.int64)), batch.column("doc_id").take(pa.array(text + i)), pa.array(role.astype(np.int32)), pa.array(spare.astype(np.int32))],
                names=["sign", "doc_id", "role", "spare"],
            )


def _features(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in word_slices(batch.column("text"), "space_lower"):
            values, counts = feature_sets(words, k)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), long_list(values, counts)], names=["doc_id", "features"])


def _linked(shared: F.Column, a: F.Column, b: F.Column, percent: int) -> F.Column:
    return shared * 100 >= (a + b - shared) * percent


def _search(batches: Iterator[pa.RecordBatch], index, percent: int) -> Iterator[pa.RecordBatch]:
    """Links between the rows and one block of queries, by counting shared features."""
    feature, query, ids, sizes = index
    for batch in batches:
        a, b = [], []
        for doc, found in zip(batch.column("doc_id").to_pylist(), batch.column("features")):
            own = found.values.to_numpy()
            low, high = np.searchsorted(feature, own, "left"), np.searchsorted(feature, own, "right")
            hit = np.flatnonzero(high > low)
            if not len(hit):
                continue
            n = high[hit] - low[hit]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[hit], n)
            shared = np.bincount(query[at], minlength=len(ids))
            good = np.flatnonzero((shared > 0) & (shared * 100 >= (len(own) + sizes - shared) * percent) & (ids != doc))
            a.extend([doc] * len(good)), b.extend(ids[good].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


class _Join:
    def __init__(self, docs: DataFrame, k: int, percent: int, scratch: list[DataFrame]):
        self.docs, self.k, self.percent, self.scratch = docs, k, percent, scratch

    def sets(self, ids: DataFrame) -> DataFrame:
        """doc_id, features of these documents."""
        rows = self.docs.join(small(ids), "doc_id").dropDuplicates(["doc_id"])
        k = self.k
        return stored(rows.mapInArrow(lambda b: _features(b, k), "doc_id long, features array<long>"), "sets", self.scratch)

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the stored pairs a, b that are similar enough."""
        ids = stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct(), "ids", self.scratch)
        sets = self.sets(ids)
        one = sets.select(F.col("doc_id").alias("b"), F.col("features").alias("fb")).join(small(pairs), "b")
        two = one.join(sets.select(F.col("doc_id").alias("a"), F.col("features").alias("fa")), "a")
        shared = F.size(F.array_intersect("fa", "fb"))
        return stored(two.filter(_linked(shared, F.size("fa"), F.size("fb"), self.percent)).select("a", "b"), "links", self.scratch)


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    spark, scratch = docs.sparkSession, []
    found_tables: list[DataFrame] = []
    narrow_batches(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sizes = stored(rows.mapInArrow(lambda b: _sizes(b, shingle), "doc_id long, n_shingles long, digest long, other long"), "sizes")
    filled = sizes.filter("doc_id is not null and n_shingles > 0")
    classes = filled.groupBy("digest", "other").agg(F.min("doc_id").alias("component"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    copies = stored(filled.join(classes, ["digest", "other"]).filter("doc_id != component").select(F.col("component").alias("a"), F.col("doc_id").alias("b")).distinct(), "copies", scratch)

    source = rows.filter("doc_id is not null and text is not null")
    source = source.join(small(copies.select(F.col("b").alias("doc_id")).distinct()), "doc_id", "left_anti")
    join, bands = _Join(source, shingle, percent, scratch), Bands(percent)
    signed = source.mapInArrow(lambda b: _sign(b, shingle, bands), "sign long, doc_id long, role int, spare int")
    held = signed.groupBy("sign").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("x"), F.max("doc_id").alias("z"), F.bit_xor("doc_id").alias("all"))
    groups = stored(held.filter("n > 1"), "groups", scratch)
    few = groups.filter(F.col("n") <= FEW).withColumn("y", F.when(F.col("n") == 3, F.col("all").bitwiseXOR(F.col("x")).bitwiseXOR(F.col("z"))))

    # sets that lack signatures of their own once the crowded ones are left out
    many = groups.filter(F.col("n") > FEW).select("sign")
    worn = signed.join(small(many), "sign").groupBy("doc_id", "role").agg(F.count(F.lit(1)).alias("lost"), F.first("spare").alias("spare"), F.collect_set("sign").alias("signs"))
    worn = stored(worn.select("doc_id", "lost", F.when(F.col("lost") > F.col("spare"), F.col("signs")).alias("signs")), "worn", scratch)
    crowded = stored(worn.filter("signs is not null").select("doc_id", F.explode("signs").alias("sign")), "crowded", scratch)

    # pairs of small groups, and how many signatures they must share
    special = [int(x) for x in bands.last_resort(np.arange(len(bands.lows))).view(np.int64)]
    pairs = few.select(
        F.explode(F.array(*(F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in (("x", "y"), ("x", "z"), ("y", "z"))))).alias("p"),
        F.col("sign").isin(special).alias("special"),
    )
    pairs = pairs.select("p.*", "special").filter("a is not null and b is not null").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.max("special").alias("special"))
    size, lost = sizes.groupBy("doc_id").agg(F.max("n_shingles").alias("s")), worn.groupBy("doc_id").agg(F.sum("lost").alias("l"))
    for side in ("a", "b"):
        pairs = pairs.join(size.toDF(side, "s" + side), side).join(lost.toDF(side, "l" + side), side, "left")
    low, high = F.least("sa", "sb"), F.greatest("sa", "sb")
    spare = F.floor((low * percent + 99) / 100)
    spare = F.when(low <= TINY, 0).otherwise(2 + F.floor(spare / 12))
    given = F.least(F.coalesce("la", F.lit(0)), F.coalesce("lb", F.lit(0)))
    pairs = pairs.filter(low * 100 >= high * percent)
    pairs = stored(pairs.select("a", "b", (F.col("shared") > spare).alias("strong"), ((F.col("shared") + given > spare) | F.col("special")).alias("possible")).filter("possible"), "pairs", scratch)

    # 1: strong pairs, and crowded sets with the head of most of their signatures
    heads = crowded.groupBy("sign").agg(F.min("doc_id").alias("a"))
    met = crowded.join(heads, "sign").filter("a < doc_id").groupBy("doc_id", "a").agg(F.count(F.lit(1)).alias("n"))
    met = met.groupBy(F.col("doc_id").alias("b")).agg(F.max(F.struct("n", F.bitwise_not("a"), "a")).alias("m")).select("m.a", "b")
    first = stored(pairs.filter("strong").select("a", "b").unionByName(met).distinct(), "first", scratch)
    links = copies.unionByName(join.links(first))
    found = stored(components(links, scratch=scratch), "components", found_tables)

    # 2: pairs that may have shared crowded signatures too
    rest = pairs.select("a", "b").join(first, ["a", "b"], "left_anti")
    for side in ("a", "b"):
        rest = rest.join(found.select(F.col("node").alias(side), F.col("component").alias("c" + side)), side, "left")
    rest = stored(rest.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"), "rest", scratch)
    links = links.unionByName(join.links(rest))
    found = stored(components(links, scratch=scratch), "components", found_tables)

    # 3: crowded signatures that hold several components
    placed = stored(crowded.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")), "placed", scratch)
    parts = placed.groupBy("sign", "component").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("sign").agg(F.max(F.struct("n", "component")).alias("m"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    queries = stored(placed.join(main, "sign").filter("component != m.component").select("doc_id").distinct(), "queries", scratch)
    if not queries.isEmpty():
        everyone = join.sets(crowded.select("doc_id").distinct())
        for index in _blocks(everyone.join(queries, "doc_id", "left_semi")):
            shared = spark.sparkContext.broadcast(index)
            more = everyone.mapInArrow(lambda b, shared=shared: _search(b, shared.value, percent), "a long, b long")
            links = links.unionByName(stored(more, "links", scratch))
        found = stored(components(links, scratch=scratch), "components", found_tables)
    # what is read from here on are the sizes and the last components
    discard(*scratch, *found_tables[:-1])
    out = sizes.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _blocks(sets: DataFrame) -> Iterator[tuple]:
    """Query sets, streamed from the executors, as feature indexes of at most BLOCK_FEATURES features (or one set)."""
    ids: list[int] = []
    held: list[np.ndarray] = []

    def index() -> tuple:
        sizes = np.array([len(x) for x in held])
        feature = np.concatenate(held)
        order = np.argsort(feature, kind="stable")
        return feature[order], np.repeat(np.arange(len(ids)), sizes)[order], np.array(ids), sizes

    for row in sets.toLocalIterator():
        if held and sum(map(len, held)) + len(row.features) > BLOCK_FEATURES:
            yield index()
            ids, held = [], []
        ids.append(row.doc_id)
        held.append(np.array(row.features, np.int64))
    if held:
        yield index()
