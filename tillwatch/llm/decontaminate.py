"""Benchmark decontamination: a generalised suffix automaton of the items, and the documents streamed through it.

The items' words are kept in automata of at most `block_words` words each, which bounds what is
broadcast; a larger benchmark takes more blocks, each applied to all documents, and the spans found
are merged per document.  A document word whose hash is no item word ends every match, so only runs
of item words at least as long as the shortest window are streamed, with their true bytes.

Defined results: a null or empty text has no words and no hit; a null or wordless item never occurs;
repeated items occur together; repeated rows are reported once each; an empty table gives no row, an
empty benchmark no hit; other columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.automaton import SuffixAutomaton
from tillwatch.llm.shared import texts_of, with_rest
from tillwatch.llm.words import Words, merged, without, word_slices

WINDOW = 10
BLOCK_WORDS = 500_000
SPANS = "array<struct<first:int,last:int>>"
FOUND = f"doc_id long, key long, n_words long, spans {SPANS}, items array<long>"


class Items:
    """The automaton of one block of items, and which items each window stands in."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.automaton = sam = SuffixAutomaton()
        self.codes: dict[bytes, int] = {}
        coded = []
        for item, words in items:
            codes = [self.codes.setdefault(w, len(self.codes)) for w in words]
            coded.append((item, codes))
            sam.add(codes)
        self.full: dict[int, set[int]] = {}
        own: dict[int, dict[int, set[int]]] = {}
        for item, codes in coded:
            for at, (state, _) in enumerate(sam.stream(codes)):
                if at >= window - 1:
                    self.full.setdefault(sam.holder(state, window), set()).add(item)
                elif at == len(codes) - 1:
                    own.setdefault(sam.holder(state, len(codes)), {}).setdefault(len(codes), set()).add(item)
        self.short: list[tuple] = [()] * len(sam.length)
        for state in sorted(range(1, len(sam.length)), key=sam.length.__getitem__):
            self.short[state] = self.short[sam.link[state]] + tuple(sorted(own.get(state, {}).items()))
        self.least = min([window, *(len(c) for _, c in coded)])
        joined = [w for w in self.codes]
        offsets = np.cumsum([0, *map(len, joined)])
        data = np.frombuffer(b"".join(joined), np.uint8)
        self.hashes = np.sort(Words(data, offsets, "letters_lower").hashes())

    def known(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return self.hashes[at] == hashes

    def hits(self, words: list[bytes]) -> Iterator[tuple[int, int, Iterable[int]]]:
        """(first word, after the last, items) of every window that occurs."""
        codes = [self.codes.get(w) for w in words]
        sam, window, short = self.automaton, self.window, self.short
        for at, (state, matched) in enumerate(sam.stream(codes)):
            if matched >= window:
                yield at + 1 - window, at + 1, self.full.get(sam.holder(state, window), ())
            if matched and short[state]:
                for size, items in short[state]:
                    if size <= matched:
                        yield at + 1 - size, at + 1, items


def _found(items: Items | None, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    texts = batch.column("text")
    more = ["text", "rest"] if "rest" in batch.schema.names else []
    for i, j, words in word_slices(texts, "letters_lower"):
        n = j - i
        spans: list[list] = [[] for _ in range(n)]
        ids: list[set] = [set() for _ in range(n)]
        known = items.known(words.hashes()) if items and len(words.starts) else np.zeros(0, bool)
        edge = np.flatnonzero(known[1:] != known[:-1]) + 1 if len(known) else np.zeros(0, int)
        cuts = np.unique(np.concatenate([edge, words.bounds])).astype(np.int64)
        first, last = cuts[:-1], cuts[1:]
        for a, b in zip(first.tolist(), last.tolist()):
            if known[a : a + 1].any() and b - a >= items.least:
                doc = int(np.searchsorted(words.bounds, a, "right")) - 1
                shift = a - int(words.bounds[doc])
                for s, e, which in items.hits(words.words(a, b)):
                    spans[doc].append((s + shift, e + shift))
                    ids[doc].update(which)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").slice(i, n), batch.column("key").slice(i, n), pa.array(words.counts, pa.int64()),
                pa.array([[{"first": a, "last": b} for a, b in merged(s)] for s in spans], pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                pa.array([sorted(x) for x in ids], pa.list_(pa.int64())), *(batch.column(c).slice(i, n) for c in more),
            ],
            names=["doc_id", "key", "n_words", "spans", "items", *more],
        )


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items with their words, read in order of id and handed out in blocks of at most block_words words (or one item)."""
    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).filter("item_id is not null and text is not null").orderBy("item_id")
    block: list[tuple[int, list[bytes]]] = []
    held = 0
    for row in rows.toLocalIterator():
        for _, _, words in word_slices(pa.array([row.text]), "letters_lower"):
            found = words.words(0, len(words.starts))
            if found and held and held + len(found) > block_words:
                yield block
                block, held = [], 0
            if found:
                block.append((row.item_id, found))
                held += len(found)
    if block:
        yield block


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, carry: list[str] | None = None,
) -> DataFrame:
    """doc_id, n_words, spans (hit word ranges, joined), items (ids with an occurring window) and, if others are carried, text and rest of every row."""
    spark = docs.sparkSession
    source = texts_of(docs, doc_id, text, carry)
    source = source.withColumn("key", F.xxhash64(*(c for c in source.columns if c != "doc_id")))
    schema = with_rest(FOUND + ", text string" * bool(carry), source)
    # without any item one empty block still counts the words
    blocks = item_blocks(benchmark, item_id, item_text, block_words)
    shared = [spark.sparkContext.broadcast(Items(block, window)) for block in blocks] or [spark.sparkContext.broadcast(None)]
    parts = [
        source.mapInArrow(lambda batches, held=held: (out for b in batches for out in _found(held.value, b)), schema)
        for held in shared
    ]
    more = ["text", "rest"] if carry else []
    kept = ["doc_id", "n_words", "spans", "items", *more]
    if len(parts) == 1:
        return parts[0].select(*kept)
    # each row came once per block; rows equal in all they carry have equal spans and stay as often as they were
    total = reduce(DataFrame.union, parts).groupBy("doc_id", "key").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        *(F.first(c).alias(c) for c in more), (F.count(F.lit(1)) / F.lit(len(parts))).cast("int").alias("copies"),
    )
    joined = F.udf(lambda s: [{"first": a, "last": b} for a, b in merged([(x["first"], x["last"]) for x in s])], SPANS)
    return total.withColumn("spans", joined("spans")).withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*kept)


def hit_words(spans: str = "spans") -> F.Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, carry: list[str], min_words: int = 1, max_coverage: float = 0.5, text: str = "text", **names) -> DataFrame:
    """doc_id, text without its hit spans of at least min_words words, n_words, n_hit and rest.

    Documents hit in more than max_coverage of their words are removed as a whole.
    """
    found = contamination(docs, benchmark, carry=carry, text=text, **names).withColumn("n_hit", hit_words())
    kept = found.filter(F.col("n_hit") <= F.col("n_words") * F.lit(max_coverage))
    long = F.filter("spans", lambda s: s["last"] - s["first"] >= min_words)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([without(t, [(s["first"], s["last"]) for s in x], "letters_lower") for t, x in zip(texts, spans)], dtype=object)

    return kept.select("doc_id", F.when(F.size(long) == 0, F.col("text")).otherwise(cut("text", long)).alias("text"), "n_words", "n_hit", "rest")
