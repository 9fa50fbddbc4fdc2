"""License scan: exact phrases, and short notices found with bounded errors.

A notice with at most k errors leaves one of k + 1 pieces of its phrase intact (pigeonhole), so exact
pieces are the seeds; around each seed the regex library verifies the phrase with at most k edits.
All runs over the text's lower-cased words joined by one space.

Defined results: null is an empty text; texts without words or notices have no label and score 0;
overlapping places of one label count once for the fuzzy notices, all exact places count; repeated
rows are repeated; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.words import word_slices

#: fixed values: phrases searched exactly, and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: notices searched with errors: phrase, label
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under the apache license": "apache",
    "released under the mit license": "mit",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution": "cc",
    "licensed under cc by": "cc-by",
    "permission is hereby granted free of charge": "mit",
    "all rights reserved": "reserved",
    "apache license": "apache",
    "mit license": "mit",
    "cc by": "cc-by",
}
#: a base phrase below SHORT characters is a notice only at word edges, with one error from SHORT // 3 characters on
SHORT = 24
#: one error is allowed for so many characters of a phrase
CHARS_PER_ERROR = 12
SPANS = "array<struct<label:string,first:int,last:int,errors:int>>"


def word_numbers(text: bytes, places: list[int]) -> list[int]:
    """How many spaces stand before each place, the text looked through once."""
    if not places:
        return []
    return np.searchsorted(np.flatnonzero(np.frombuffer(text, np.uint8) == 32), places).tolist()


class Scanner:
    def __init__(self, notices: dict[str, str] = NOTICES, phrases: dict[str, str] = PHRASES, chars_per_error: int = CHARS_PER_ERROR):
        self.phrases = [(b" " + p.encode() + b" ", label, p.count(" ") + 1) for p, label in phrases.items()]
        self.seeds: dict[bytes, list[tuple[int, int]]] = {}
        self.notices = []
        for text, label in notices.items():
            phrase = text.encode()
            k, edge = len(phrase) // chars_per_error, b""
            if text in phrases and len(phrase) < SHORT:
                k, edge = max(k, int(len(phrase) >= SHORT // 3)), b" "
            pattern = regex.compile(rb"(?b)" + edge + b"(?:" + regex.escape(phrase, literal_spaces=True) + b"){e<=%d}" % k + edge)
            edges = [len(phrase) * n // (k + 1) for n in range(k + 2)]
            for a, b in zip(edges, edges[1:]):
                self.seeds.setdefault(phrase[a:b], []).append((len(self.notices), a))
            self.notices.append((edge + phrase + edge, label, k, pattern, len(edge)))

    def exact(self, text: bytes) -> list[tuple[int, str]]:
        """(first word, label) of every place of a phrase; text begins and ends with a space."""
        found = []
        for phrase, label, _ in self.phrases:
            at = text.find(phrase)
            while at >= 0:
                found.append((at, label))
                at = text.find(phrase, at + 1)
        words = word_numbers(text, [at for at, _ in found])
        return sorted((w, label) for w, (_, label) in zip(words, found))

    def fuzzy(self, text: bytes) -> list[tuple[str, int, int, int]]:
        """(label, first word, after the last, errors) of notices with bounded errors."""
        windows: set[tuple[int, int, int]] = set()
        for seed, uses in self.seeds.items():
            at = text.find(seed)
            while at >= 0:
                for n, offset in uses:
                    phrase, _, k, _, edge = self.notices[n]
                    begin = at - offset - edge
                    windows.add((n, max(0, begin - k), min(len(text), begin + len(phrase) + k)))
                at = text.find(seed, at + 1)
        best: dict[tuple[str, int], tuple] = {}
        short: dict[tuple[str, int], tuple] = {}
        hits: list[tuple[str, int, int, int, int]] = []
        for n, begin, end in windows:
            _, label, _, pattern, edge = self.notices[n]
            hit = pattern.search(text, begin, end)
            if hit:
                errors = sum(hit.fuzzy_counts)
                a, b = hit.span()
                while a < b and text[a] == 32:
                    a += 1
                while b > a and text[b - 1] == 32:
                    b -= 1
                hits.append((label, a, b, errors, edge))
        begins, ends = word_numbers(text, [h[1] for h in hits]), word_numbers(text, [h[2] for h in hits])
        for (label, _, _, errors, edge), begin, end in zip(hits, begins, ends):
            row, key = (label, begin - 1, end, errors), (label, begin - 1)
            if edge:
                short[key] = min(row, short.get(key, row), key=lambda r: r[3])
            elif key not in best or errors < best[key][3]:
                best[key] = row
        # a short notice within a longer one of its label is that one
        covered = {(label, w) for label, a, b, _ in best.values() for w in range(a, b)}
        for key, row in short.items():
            if not any((row[0], w) in covered for w in range(row[1], row[2])):
                best[key] = row
        return sorted(best.values(), key=lambda r: (r[1], r[0]))


def _scan(batches: Iterator[pa.RecordBatch], scanner: Scanner) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("errors", pa.int32())]))
    for batch in batches:
        for i, j, words in word_slices(batch.column("text"), "letters_lower"):
            exact, fuzzy = [], []
            for k in range(j - i):
                text = b" ".join([b"", *words.words(int(words.bounds[k]), int(words.bounds[k + 1])), b""])
                exact.append([{"label": label, "first": first, "last": None, "errors": 0} for first, label in scanner.exact(text)])
                fuzzy.append([dict(zip(("label", "first", "last", "errors"), row)) for row in scanner.fuzzy(text)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), pa.array(words.counts, pa.int64()), pa.array(exact, kind), pa.array(fuzzy, kind)],
                names=["doc_id", "n_words", "exact", "fuzzy"],
            )


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, n_words, exact (places of the phrases) and fuzzy (notices: words, label, errors) of every row."""
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(**options))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda b: _scan(b, scanner.value), f"doc_id long, n_words long, exact {SPANS}, fuzzy {SPANS}")


def license_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: places, labels and a score (1 for an exact phrase, less per error)."""
    found = scan_licenses(docs, **options)
    names = lambda c: F.array_distinct(F.transform(c, lambda s: s["label"]))
    first = F.transform("exact", lambda s: s["first"].cast("long"))
    least = F.array_min(F.transform("fuzzy", lambda s: s["errors"]))
    score = F.when(F.size("exact") > 0, 1.0).when(F.size("fuzzy") > 0, 1 / (1 + least)).otherwise(0.0)
    return found.select(
        "doc_id", "n_words", F.size("exact").cast("long").alias("n_base"), F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        F.array_join(F.array_sort(names("exact")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(names("exact"), names("fuzzy"))), ",").alias("labels"),
        score.cast("double").alias("score"), "fuzzy",
    )
