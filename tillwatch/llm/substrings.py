"""Substring dedup: words covered by a long enough word sequence that also starts earlier in the corpus.

Every window of `length` words belongs to the shard named by its minimizer, the smallest hash among
its runs of `SEED` words, so equal windows always meet in one shard.  A maximal run of windows of one
document with the same minimizer is a segment.  Minimizers seen once in the corpus need nothing more.
Copies of a segment fall together before anything else is done: all but the first are removed as a
whole.  Where different segments share a minimizer, the shard's reference is a suffix automaton of
its segments in corpus order: each segment is streamed through it for matching statistics, spans at or
above the threshold are removed, and then it joins the reference.  References grow with the corpus, so
shards are dealt out by key instead of being sent everywhere; a shard above `shard_segments` segments
is split further, by whole windows, which is exact for any size.

Hashes choose candidates and name copies (two 64-bit hashes together); automata compare the words.

Defined results: null and empty texts have no words; a text of fewer words than a window keeps all;
rows without an id keep all their words and are nobody's earlier place; repeated rows of one id count
as one document, each reported; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.automaton import SuffixAutomaton
from tillwatch.llm.shared import discard, stored, texts_of, with_rest
from tillwatch.llm.words import Words, merged, runs_hash, spans_hash, word_slices, without

LENGTH = 20
SEED = 6
SHARD_SEGMENTS = 2_000
#: minimizers that a scan may hold at most as one sorted array (8 MB) instead of a join
HELD = 1_000_000

SEGMENTS = "shard long, body long, doc_id long, first int, windows int"


def segments(words: Words, length: int) -> tuple[np.ndarray, ...]:
    """shard, body hash, text index, first word in the text, number of windows of every segment."""
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    n = len(words.starts)
    if n < length:
        return none
    hashes = words.hashes()
    seed = runs_hash(hashes, min(SEED, length))
    width = length - min(SEED, length) + 1
    # leftmost smallest seed of every window, by doubling
    at, reach = np.arange(len(seed)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = at[:-step], at[step:]
        at = np.where(seed[left] <= seed[right], left, right)
        reach += step
    of = words.text_of_word()
    start = np.flatnonzero(of[: n - length + 1] == of[length - 1 :])
    if not len(start):
        return none
    at = at[start]
    head = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)]))
    windows = np.diff(np.append(head, len(start)))
    first = start[head]
    return seed[at[head]], spans_hash(hashes, first, first + windows + length - 1), of[first], first - words.bounds[of[first]], windows


def _scan(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for i, _, words in word_slices(batch.column("text"), "space"):
            shard, body, text, first, windows = segments(words, length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.view(np.int64)), pa.array(body.view(np.int64)), ids.take(pa.array(text + i)), pa.array(first.astype(np.int32)), pa.array(windows.astype(np.int32))],
                names=["shard", "body", "doc_id", "first", "windows"],
            )


def _spell(batches: Iterator[pa.RecordBatch], wanted: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    """The segments of the wanted shards with their words."""
    for batch in batches:
        ids = batch.column("doc_id")
        for i, _, words in word_slices(batch.column("text"), "space"):
            shard, body, text, first, windows = segments(words, length)
            at = np.searchsorted(wanted, shard.view(np.int64))
            at[at == len(wanted)] = 0
            keep = np.flatnonzero(wanted[at] == shard.view(np.int64)) if len(wanted) else np.zeros(0, int)
            begin = words.bounds[text[keep]] + first[keep]
            end = begin + windows[keep] + length - 1
            spelt = [b" ".join(words.words(a, b)) for a, b in zip(begin.tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[keep].view(np.int64)), pa.array(body[keep].view(np.int64)), ids.take(pa.array(text[keep] + i)), pa.array(first[keep].astype(np.int32)), pa.array(windows[keep].astype(np.int32)), pa.array(spelt, pa.binary())],
                names=["shard", "body", "doc_id", "first", "windows", "words"],
            )


def _repeats(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Removed spans, shard after shard: matching statistics of each segment against the shard's segments before it.

    Rows come sorted by shard, doc_id, first; only the automaton of one shard is held.
    """
    shard, sam = None, SuffixAutomaton()
    for batch in batches:
        ids, firsts, lasts = [], [], []
        for key, doc, first, text in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "first", "words"))):
            words = text.split(b" ")
            if key != shard:
                shard, sam = key, SuffixAutomaton()
            else:
                begin = end = -1
                for at, (_, matched) in enumerate(sam.stream(words)):
                    if matched >= length:
                        if at + 1 - length > end:
                            if end >= 0:
                                ids.append(doc), firsts.append(first + begin), lasts.append(first + end)
                            begin = at + 1 - length
                        end = at + 1
                if end >= 0:
                    ids.append(doc), firsts.append(first + begin), lasts.append(first + end)
            sam.add(words)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())], names=["doc_id", "first", "last"])


def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every window of the segments by itself, named by the window's own words."""
    for batch in batches:
        out = {"doc_id": [], "first": [], "window": []}
        for doc, first, windows, words in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "first", "windows", "words"))):
            words = words.split(b" ")
            for k in range(windows):
                out["doc_id"].append(doc), out["first"].append(first + k), out["window"].append(b" ".join(words[k : k + length]))
        yield pa.RecordBatch.from_arrays([pa.array(out["doc_id"], pa.int64()), pa.array(out["first"], pa.int32()), pa.array(out["window"], pa.binary())], names=list(out))


def repeated_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, shard_segments: int = SHARD_SEGMENTS, held: int = HELD,
    scratch: list[DataFrame] | None = None,
) -> DataFrame:
    """doc_id, first, last: word ranges covered by windows that also start earlier (ranges may overlap).

    The result reads stored tables; on a `scratch` list they can be discarded once it is read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null and text is not null")
    scan = source.mapInArrow(lambda batches: _scan(batches, length), SEGMENTS)
    again = scan.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("body").alias("low"), F.max("body").alias("high")).filter("n > 1")
    again = again.select("shard", (F.col("low") != F.col("high")).alias("mixed"))
    places = stored(scan.join(again, "shard"), "places", scratch)
    firsts = stored(
        places.groupBy("shard", "body").agg(F.min(F.struct("doc_id", "first", "windows")).alias("f"), F.first("mixed").alias("mixed"), F.count(F.lit(1)).alias("n"))
        .select("shard", "body", "mixed", "n", "f.*"), "firsts", scratch,
    )
    origin = firsts.filter("n > 1").select("shard", "body", F.col("doc_id").alias("doc_0"), F.col("first").alias("first_0"))
    width = F.col("windows") + F.lit(length - 1)
    copies = (
        places.join(origin, ["shard", "body"]).filter("doc_id != doc_0 or first != first_0")
        .select("doc_id", "first", (F.col("first") + width).cast("int").alias("last"))
    )
    sizes = stored(firsts.filter("mixed").groupBy("shard").agg(F.count(F.lit(1)).alias("n_segments")), "shards", scratch)
    spelt_schema = SEGMENTS + ", words binary"
    if sizes.limit(held + 1).count() <= held:
        rows = sizes.select("shard").toPandas()["shard"].to_numpy(np.int64)
        wanted = spark.sparkContext.broadcast(np.sort(rows))
        spelt = source.mapInArrow(lambda batches: _spell(batches, wanted.value, length), spelt_schema)
    else:
        lists = firsts.filter("mixed").groupBy("doc_id").agg(F.array_sort(F.collect_set("shard")).alias("shards"))
        spelt = source.join(lists, "doc_id").mapInArrow(lambda batches: _spell_joined(batches, length), spelt_schema)
    # only the first copy of each segment goes on
    mine = firsts.filter("mixed").select("shard", "body", F.col("doc_id").alias("doc_0"), F.col("first").alias("first_0"))
    spelt = spelt.join(mine, ["shard", "body"]).filter("doc_id = doc_0 and first = first_0").dropDuplicates(["shard", "body"]).drop("doc_0", "first_0", "body")
    spelt = stored(spelt.join(sizes, "shard"), "spelt", scratch)
    spans = "doc_id long, first int, last int"
    shards = spelt.filter(F.col("n_segments") <= shard_segments).select("shard", "doc_id", "first", "words").repartition("shard")
    shards = shards.sortWithinPartitions("shard", "doc_id", "first").mapInArrow(lambda b: _repeats(b, length), spans)
    alone = spelt.filter(F.col("n_segments") > shard_segments).mapInArrow(lambda b: _windows(b, length), "doc_id long, first int, window binary")
    alone = stored(alone.select("doc_id", "first", F.md5("window").alias("w")), "windows", scratch)
    earliest = alone.groupBy("w").agg(F.min(F.struct("doc_id", "first")).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = alone.join(earliest, "w").filter("doc_id != f.doc_id or first != f.first").select("doc_id", "first", (F.col("first") + length).cast("int").alias("last"))
    return copies.union(shards).union(later)


def _spell_joined(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """As _spell, with each document's own list of wanted shards."""
    for batch in batches:
        for k, shards in enumerate(batch.column("shards").to_pylist()):
            yield from _spell([batch.select(["doc_id", "text"]).slice(k, 1)], np.array(sorted(shards), np.int64), length)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("spans").to_pylist()
        for i, j, words in word_slices(batch.column("text"), "space"):
            kept, removed = [], np.zeros(j - i, np.int64)
            for k in range(j - i):
                a, b = int(words.bounds[k]), int(words.bounds[k + 1])
                spans = lists[i + k]
                found = words.words(a, b)
                if spans:
                    gone = np.zeros(b - a + 1, np.int32)
                    for s in spans:
                        gone[min(s["first"], b - a)] += 1
                        gone[min(s["last"], b - a)] -= 1
                    gone = np.cumsum(gone[:-1]) > 0
                    removed[k] = int(gone.sum())
                    found = [w for w, g in zip(found, gone.tolist()) if not g]
                kept.append(b" ".join(found))
            columns = [batch.column("doc_id").slice(i, j - i), pa.array(words.counts, pa.int64()), pa.array(removed)]
            if "rest" in batch.schema.names:
                texts = batch.column("text").slice(i, j - i).to_pylist()
                cut = [without(t, [(s["first"], s["last"]) for s in spans], "space") if spans else t for t, spans in zip(texts, lists[i:j])]
                columns += [pa.array(cut, pa.string()), batch.column("rest").slice(i, j - i)]
                names = ["doc_id", "n_words", "n_removed", "text", "rest"]
            else:
                columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
                names = ["doc_id", "n_words", "n_removed", "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None, **options) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the kept words joined by one space) of every row.

    With columns to carry: instead of kept, text without the removed spans (all else as it was) and rest.
    """
    source = texts_of(docs, doc_id, text, carry)
    scratch: list[DataFrame] = []
    spans = repeated_spans(docs, doc_id, text, scratch=scratch, **options)
    per_doc = stored(spans.groupBy("doc_id").agg(F.collect_set(F.struct("first", "last")).alias("spans")), "spans")
    discard(*scratch)
    joined = source.join(per_doc, "doc_id", "left")
    return joined.mapInArrow(_apply, with_rest(f"doc_id long, n_words long, n_removed long, {'text' if carry else 'kept'} string", source))
