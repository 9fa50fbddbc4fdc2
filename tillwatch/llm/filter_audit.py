"""What each filter removes, alone and after others: sorted posting lists of failing ids.

Every row is tested once by all filters in built-in expressions.  The narrow outcomes are dealt out by
ranges of (part, id), so a part that holds a third of all rows spreads over many tasks, and each task
walks its rows in order, in ranges of at most RANGE rows of one part.  A range keeps one sorted list of
failing ids per filter.  Unions of the lists come from galloping k-way merges, what a filter removes
after others is the galloping difference of its list and their union; only sizes leave the task, and
sizes of ranges add up.  An order of filters needs no more than the (filter, filters before it) sizes.

A row is a duplicate if an equal text has a smaller id.  The smallest id per text comes from a partial
aggregate and is joined back on (id, text digest), which no group of copies can make hot.

Defined results: a null text is empty, a null part the empty string; a row without an id has no smaller
id and counts as a row of its own; repeated rows count once each and are no duplicates of one another;
a document with several label rows is good or toxic if one of them says so; without rows there are no
parts; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.shared import stored

#: rows of one id range
RANGE = 65_536
LETTERS = "ABCDE"
# The limits of the five filters.
LEAST_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_CAPITALS_PERCENT = 5
FORBIDDEN = "[#$%&*|]"
WORD = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SIZES = "part string, filter int, before int, docs long, removed long, covered long, good long, toxic long"


def text_filters(text: Column) -> dict[str, Column]:
    """Filter letter -> whether a text (never null) fails it; E needs the other rows."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": n < LEAST_WORDS,
        "B": F.size(F.array_distinct(words)) * F.lit(100) < n * LEAST_DISTINCT_PERCENT,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * MOST_CAPITALS_PERCENT,
        "D": text.rlike(FORBIDDEN),
    }


def outcomes(docs: DataFrame, part: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """part, doc_id, fails (bit k: filter k of LETTERS) of every row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    bits = [F.when(fails, F.lit(1 << LETTERS.index(k))).otherwise(0) for k, fails in text_filters(whole).items()]
    rows = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(doc_id).cast("long").alias("doc_id"),
        F.unhex(F.sha2(whole, 256)).alias("digest"), sum(bits[1:], bits[0]).alias("fails"),
    )
    rows = stored(rows, "outcomes")
    known = rows.filter("doc_id is not null")
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    late = F.when(F.col("first").isNull(), F.lit(1 << LETTERS.index("E"))).otherwise(0)
    known = known.join(firsts, ["doc_id", "digest"], "left").withColumn("fails", F.col("fails") + late)
    columns = ["part", "doc_id", "digest", "fails"]
    return known.select(columns).unionByName(rows.filter("doc_id is null").select(columns))


def gallop(ids: list[int], at: int, bound: int) -> int:
    """The first place from `at` on with an id of at least bound: doubling steps, then a search between the last two."""
    step, n = 1, len(ids)
    while at + step < n and ids[at + step] < bound:
        step *= 2
    return bisect_left(ids, bound, at + step // 2, min(at + step + 1, n))


def union(lists: list[list[int]]) -> list[int]:
    """Sorted union of sorted lists; the run of one list below all other heads is taken at once."""
    todo = [(ids, 0) for ids in lists if ids]
    out: list[int] = []
    while len(todo) > 1:
        heads = [ids[at] for ids, at in todo]
        low = min(heads)
        k = heads.index(low)
        bound = min(h for j, h in enumerate(heads) if j != k)
        if bound == low:
            out.append(low)
            todo = [(ids, at + (ids[at] == low)) for ids, at in todo]
        else:
            ids, at = todo[k]
            end = gallop(ids, at, bound)
            out += ids[at:end]
            todo[k] = ids, end
        todo = [(ids, at) for ids, at in todo if at < len(ids)]
    for ids, at in todo:
        out += ids[at:]
    return out


def difference(a: list[int], b: list[int]) -> list[int]:
    """The ids of a that b lacks."""
    out: list[int] = []
    i = j = 0
    while i < len(a):
        j = gallop(b, j, a[i]) if j < len(b) else j
        if j == len(b):
            return out + a[i:]
        if b[j] == a[i]:
            i += 1
        else:
            end = gallop(a, i, b[j])
            out += a[i:end]
            i = end
    return out


def range_sizes(fails: np.ndarray, good: np.ndarray, toxic: np.ndarray, filters: int = len(LETTERS)) -> np.ndarray:
    """One id range: [filter, filters before it] -> docs, removed, covered, good, toxic."""
    posting = [np.flatnonzero(fails >> k & 1).tolist() for k in range(filters)]
    out = np.zeros((filters, 1 << filters, 5), np.int64)
    for before in range(1 << filters):
        gone = union([posting[k] for k in range(filters) if before >> k & 1])
        for k in range(filters):
            if not before >> k & 1:
                ids = difference(posting[k], gone)
                out[k, before] = len(fails), len(ids), len(gone) + len(ids), good[ids].sum(), toxic[ids].sum()
    return out


def _sizes(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part: the sums of each part's ranges."""
    part, held, total = None, [], None

    def close(total):
        if not held:
            return total
        found = range_sizes(*(np.concatenate(c) for c in zip(*held)))
        held.clear()
        return found if total is None else total + found

    def rows(part, total):
        k, before = np.nonzero([[not b >> f & 1 for b in range(total.shape[1])] for f in range(total.shape[0])])
        numbers = total[k, before].T
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(k), pa.string()), pa.array(k, pa.int32()), pa.array(before, pa.int32()), *map(pa.array, numbers)],
            names=["part", "filter", "before", "docs", "removed", "covered", "good", "toxic"],
        )

    for batch in batches:
        n = batch.num_rows
        parts = batch.column("part").dictionary_encode()
        codes, names = parts.indices.to_numpy(), parts.dictionary.to_pylist()
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("fails", "good", "toxic")]
        edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), n] if n else [0]
        for a, b in zip(edges, edges[1:]):
            if (held or total is not None) and names[codes[a]] != part:
                total = close(total)
                yield rows(part, total)
                total = None
            part = names[codes[a]]
            while a < b:
                room = limit - sum(len(h[0]) for h in held)
                held.append([c[a : min(b, a + room)] for c in columns])
                a = min(b, a + room)
                if sum(len(h[0]) for h in held) == limit:
                    total = close(total)
    if held or total is not None:
        yield rows(part, close(total))


def filter_sizes(docs: DataFrame, labels: DataFrame, part: str = "source", doc_id: str = "doc_id", text: str = "text", limit: int = RANGE) -> DataFrame:
    """part, filter, before (bits): rows of the part, removed by the filter after those before it, removed by any of them."""
    said = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    rows = outcomes(docs, part, doc_id, text).join(said, "doc_id", "left")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    dealt = rows.select("part", "doc_id", "digest", "fails", *flags).repartitionByRange("part", "doc_id", "digest").sortWithinPartitions("part", "doc_id")
    sizes = dealt.drop("doc_id", "digest").mapInArrow(lambda b: _sizes(b, limit), SIZES)
    return sizes.groupBy("part", "filter", "before").agg(*(F.sum(c).alias(c) for c in ("docs", "removed", "covered", "good", "toxic")))


def audit_orders(sizes: DataFrame, filters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step; the table of orders depends on the filters alone."""
    orders = [
        ("".join(order), step + 1, filters.index(f), sum(1 << filters.index(g) for g in order[:step]))
        for order in itertools.permutations(filters) for step, f in enumerate(order)
    ]
    table = sizes.sparkSession.createDataFrame(orders, "filter_order string, step int, filter int, before int")
    n = len(filters)
    times = F.element_at(F.array(*(F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n))), F.bit_count("before") + 1)
    others = F.expr(f"{(1 << n) - 1} ^ shiftleft(1, filter)")
    alone = sizes.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"), F.sum(F.when(F.col("before") == others, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * times).alias("shapley"),
    )
    found = sizes.join(alone, ["part", "filter"]).join(F.broadcast(table), ["filter", "before"])
    return found.select(
        "part", "filter_order", "step", (F.col("docs") - F.col("covered")).alias("kept"), "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley",
    )


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return audit_orders(stored(filter_sizes(docs, labels, part, doc_id, text), "sizes"))
