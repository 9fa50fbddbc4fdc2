"""SimHash fingerprints, and all fingerprints within a Hamming radius by permuted block tables.

Terms are pairs of neighbouring lower-cased words (the word itself in a text of one), weighted by
their number and by their length in bytes, since longer pairs are rarer.  Each term's 64-bit hash
votes with its weight on 64 signed bits.

Defined results: null, empty and wordless texts have fingerprint 0; equal texts have equal
fingerprints; repeated rows are repeated; rows without an id come after all others in descending
order of id; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.words import runs_hash, word_slices

RADIUS = 3
BLOCKS = 5
#: rows of one range of ids
RANGE_ROWS = 50_000
#: ranges that smaller tables are cut into, so that many tasks share them
LEAST_RANGES = 64


def fingerprints(texts: pa.Array) -> np.ndarray:
    """uint64 fingerprint of every text."""
    out = np.zeros(len(texts), np.uint64)
    for i, j, words in word_slices(texts, "letters_lower"):
        n = len(words.starts)
        if not n:
            continue
        hashes, size = words.hashes(), (words.ends - words.starts).astype(np.int32)
        first = words.bounds[:-1][words.counts > 0]
        last = words.bounds[1:][words.counts > 0] - 1
        weight = size.copy()
        weight[:-1] += size[1:]
        pair = np.zeros(n, np.uint64)
        pair[:-1] = runs_hash(hashes, 2)
        # a text's last word starts no pair; alone it is a term
        weight[last] = 0
        alone = first[first == last]
        pair[alone], weight[alone] = hashes[alone], size[alone]
        bits = np.unpackbits(pair.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes = 2 * np.add.reduceat(bits * weight[:, None], first, axis=0, dtype=np.int64) - np.add.reduceat(weight, first, dtype=np.int64)[:, None]
        out[i:j][words.counts > 0] = np.packbits(votes > 0, axis=1, bitorder="little").reshape(-1).view(np.uint64)
    return out


def _print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fingerprints(batch.column("text")).view(np.int64))], names=["doc_id", "fingerprint"])


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (64 bits as a long) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_print, "doc_id long, fingerprint long")


def within_radius(queries: DataFrame, prints: DataFrame, fingerprint: str = "fingerprint", radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """fingerprint, near, distance: distinct fingerprints of prints within the radius of those of queries.

    64 bits fall into `blocks` blocks; at most `radius` of them differ, so some blocks - radius blocks
    are equal.  Each choice of these is one table, keyed by their bits.
    """
    if not 0 <= radius < blocks <= 64:
        raise ValueError("radius must be below the number of blocks")
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = []
    for chosen in itertools.combinations(range(blocks), blocks - radius):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)

    def tables(df: DataFrame, name: str) -> DataFrame:
        one = df.select(F.col(fingerprint).alias(name)).filter(F.col(name).isNotNull()).distinct()
        tables = F.array(*(F.struct(F.lit(k).alias("table"), F.col(name).bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)))
        return one.select(name, F.explode(tables).alias("t")).select(name, "t.table", "t.key")

    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("near")))
    joined = tables(queries, "fingerprint").join(tables(prints, "near"), ["table", "key"])
    return joined.select("fingerprint", "near", distance.alias("distance")).filter(F.col("distance") <= radius).distinct()


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the row after it: rows of a range come in order, the next range's first row last, as a copy."""
    waiting: pa.Table | None = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None and not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if batch is not None else None
        if waiting is not None:
            table = pa.concat_tables([waiting, table]) if table is not None else waiting
        if table is None:
            return
        n = table.num_rows - (batch is not None)
        waiting = table.slice(n)
        for k in range(0, n, 500):
            yield from _edited_part(table.slice(k, min(500, n - k) + 1), min(500, n - k))


def _edited_part(table: pa.Table, n: int) -> Iterator[pa.RecordBatch]:
    texts = [t or "" for t in table.column("text").to_pylist()]
    ranges, copies = table.column("range").to_pylist(), table.column("copy").to_pylist()
    own = fingerprints(pa.array(texts, pa.large_string()))
    keep = [k for k in range(n) if not copies[k]]
    if not keep:
        return
    edited, nexts = [], []
    for k in keep:
        follows = k + 1 < len(texts) and ranges[k + 1] == ranges[k]
        text, after = texts[k], texts[k + 1] if follows else texts[k]
        cut = len(text) // 3
        edited.append(text[: len(text) - cut] + after[:cut])
        nexts.append(k + 1 if follows else k)
    other = fingerprints(pa.array(edited, pa.large_string()))
    mine = own[keep]

    def like(x: np.ndarray) -> pa.Array:
        return pa.array(1 - np.bitwise_count(mine ^ x).astype(np.float64) / 64)

    yield pa.RecordBatch.from_arrays(
        [
            table.column("doc_id").take(pa.array(keep)).combine_chunks(), pa.array([len(texts[k]) for k in keep], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array(mine.view(np.int64)), pa.array(other.view(np.int64)), like(other), like(own[nexts]),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of every text and of the text with its last third replaced by the next document's start.

    Next means descending id, cyclically.  Ids are cut into ranges at quantiles, each range also gets
    a copy of the first row of the one below, and texts move once; no task holds more than one range
    in order, streamed.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n = rows.count()
    count = max(1, n // range_rows, min(LEAST_RANGES, n // 500))
    cuts = rows.approxQuantile("doc_id", [k / count for k in range(1, count)], 1 / (8 * count)) if count > 1 else []
    cuts = sorted({int(c) for c in cuts})
    spark = docs.sparkSession
    # range k holds the ids above cuts[k - 1], up to cuts[k]; rows without an id are in range 0
    bound = F.array(*(F.lit(c) for c in cuts)) if cuts else F.array().cast("array<long>")
    ranged = rows.withColumn("range", F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(bound, lambda c: c < F.col("doc_id")))))
    firsts = {r["range"]: r["top"] for r in ranged.groupBy("range").agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(firsts, reverse=True)
    target = [(firsts[order[(k + 1) % len(order)]], r) for k, r in enumerate(order)]
    heads = F.broadcast(spark.createDataFrame(target, "top long, to int"))
    copies = rows.join(heads, F.col("doc_id").eqNullSafe(F.col("top"))).select("doc_id", "text", F.col("to").alias("range"), F.lit(1).alias("copy"))
    both = ranged.withColumn("copy", F.lit(0)).unionByName(copies)
    dealt = both.repartition(max(1, len(order)), "range").sortWithinPartitions("range", "copy", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))
    return dealt.mapInArrow(
        _edited,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint long, edited_fingerprint long, near_edited double, near_next double",
    )
