"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams (one to three) of a language by rank; a document's
own list is compared to each by the sum of rank differences, where a missing n-gram costs the profile
length.  n-grams run over the UTF-8 bytes of the lower-cased text (all scripts), within words, with one
blank at a word's ends; bytes beyond ASCII stand for themselves.  Profiles are counted over all
training rows; what is broadcast is languages * PROFILE ranks.

Defined results: a text that is null or has no letter is `und` with score 0, as is every text if
nothing was learned; equal distances go to the first language in order of name; rows without a
language teach nothing; repeated rows are repeated; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.shared import narrow_batches, texts_of, with_rest
from tillwatch.llm.words import slices

PROFILE = 400
#: n-grams gathered in a task before they are summed (16 bytes each)
GATHER = 500_000
_B = np.arange(256)
#: lower-case letters and all bytes beyond ASCII stand for themselves
_CODE = np.where(((_B >= 97) & (_B <= 122)) | (_B >= 128), _B, np.where((_B >= 65) & (_B <= 90), _B + 32, 0)).astype(np.int32)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-gram codes, three for each letter and one more at a word's start, and their text."""
    code = _CODE[data]
    before, after = np.zeros_like(code), np.zeros_like(code)
    before[1:], after[:-1] = code[:-1], code[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = 0
    after[offsets[1:][offsets[1:] > 0] - 1] = 0
    at = np.flatnonzero(code)
    a, b, c = before[at], code[at], after[at]
    text = np.searchsorted(offsets, at, "right") - 1
    start = np.flatnonzero(a == 0)
    found = np.concatenate([a << 16 | b << 8 | c, 1 << 24 | b << 8 | c, 1 << 25 | b, 1 << 24 | b[start]])
    return found, np.concatenate([text, text, text, text[start]])


def top_grams(codes: np.ndarray, n: int) -> np.ndarray:
    """The n most frequent codes, ties by code."""
    codes = np.sort(codes)
    head = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, int)
    count = np.diff(np.append(head, len(codes)))
    order = np.argsort(-count, kind="stable")[:n]
    return codes[head[order]]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for i, j, data, offsets in slices(pc.utf8_lower(batch.column("text"))):
            codes, text = grams(data, offsets)
            names, which = np.unique(langs[i:j].astype(str), return_inverse=True)
            for k, name in enumerate(names.tolist()):
                own, n = np.unique(codes[which[text] == k], return_counts=True)
                held.setdefault(name, []).append((own, n))
                size += len(own)
            if size > GATHER:
                held = {name: [_summed(parts)] for name, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > GATHER // 2:
                    yield from _rows(held)
                    held, size = {}, 0
    yield from _rows(held)


def _rows(held: dict[str, list]) -> Iterator[pa.RecordBatch]:
    for name, parts in held.items():
        codes, n = _summed(parts)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> DataFrame:
    """lang, gram, rank (from 0) over all rows that have a language."""
    narrow_batches(docs.sparkSession)
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # a filter on the row number itself lets each task cut its own list before the shuffle
    best = counts.withColumn("row", F.row_number().over(order)).filter(F.col("row") <= size)
    return best.select("lang", "gram", (F.col("row") - 1).alias("rank"))


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _predict(batches: Iterator[pa.RecordBatch], profiles: tuple, size: int) -> Iterator[pa.RecordBatch]:
    names, known, ranks = profiles
    for batch in batches:
        langs, scores = [], []
        texts = batch.column("text")
        for i, j, data, offsets in slices(pc.utf8_lower(texts)):
            codes, text = grams(data, offsets)
            order = np.argsort(text, kind="stable")
            codes, bounds = codes[order], np.searchsorted(text[order], np.arange(j - i + 1))
            plain = ((data | 0x20) >= 97) & ((data | 0x20) <= 122)
            letters = np.concatenate([[0], np.cumsum(plain)])[offsets]
            for k in range(j - i):
                own = top_grams(codes[bounds[k] : bounds[k + 1]], size)
                if not len(names) or not len(own) or letters[k] == letters[k + 1] and not _has_letter(texts[i + k].as_py()):
                    langs.append("und"), scores.append(0.0)
                    continue
                at = np.searchsorted(known, own)
                at[at == len(known)] = 0
                rank = np.where(known[at] == own, ranks[:, at], -1)
                away = np.where(rank < 0, size, np.abs(rank - np.arange(len(own)))).sum(axis=1)
                best = int(away.argmin())
                other = np.delete(away, best).min() if len(names) > 1 else size * len(own)
                langs.append(names[best]), scores.append(float((other - away[best]) / other) if other else 0.0)
        more = [c for c in ("text", "rest") if c in batch.schema.names and "rest" in batch.schema.names]
        columns = [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), *map(batch.column, more)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", *more])


def predict_language(
    docs: DataFrame, profiles: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = PROFILE, carry: list[str] | None = None,
) -> DataFrame:
    """doc_id, lang_pred and score (how much nearer the language is than the next one, 0 to 1) of every row; text and rest if others are carried."""
    learned = profiles.toPandas()  # languages * size rows
    names = sorted(learned["lang"].unique())
    known = np.unique(learned["gram"].to_numpy(np.int64))
    ranks = np.full((len(names), max(1, len(known))), -1, np.int64)
    for k, name in enumerate(names):
        own = learned[learned["lang"] == name]
        ranks[k, np.searchsorted(known, own["gram"].to_numpy(np.int64))] = own["rank"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((names, known, ranks))
    rows = texts_of(docs, doc_id, text, carry)
    schema = with_rest("doc_id long, lang_pred string, score double" + ", text string" * bool(carry), rows)
    return rows.mapInArrow(lambda b: _predict(b, shared.value, size), schema)
