"""Token ids in files of directly addressable codes: any token can be read without decoding a block.

An id is split into chunks of 8 bits, the lowest first.  Level 0 holds the first chunk of every id, level
k + 1 the next chunk of those ids that have one; a bitmap per level says which go on, and a directory
holds the number of set bits before every 512 bits.  The place of an id's next chunk is its rank among
the set bits, so one id, or a run of neighbouring ids, is read by one small piece of each level.

Documents are dealt out by ranges of (id, text hash) and sorted, so files in their order hold the ids of
all documents in ascending id, and each task writes one file, segment by segment.  `token_codes` is a
Spark data source: a task's file has a name of its own and counts only if its commit message names it,
so a lost executor's attempts leave nothing that is read; the commit writes the manifest with every
file's place among all tokens.

A file: segments, each the arrays named in the footer; the footer as JSON; its length (uint32); MAGIC.
All numbers are little-endian.  Arrays of a segment: doc_id (int64), known (uint8, 0 for a null id),
starts (uint64, documents + 1), and per level chunks (uint8), more (bits, lowest first), ranks (uint64).

Defined results: null is an empty text, an empty text has only the end id; null ids come first, rows of
one id in the order of their text's hash, then of the text; repeated rows are written repeatedly; no rows
make a folder without tokens; other columns are not read.
"""

from __future__ import annotations

import bisect
import functools
import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tillwatch.llm import bpe
from tillwatch.llm.shared import texts_of

FORMAT = "token_codes"
MAGIC = b"TWTOKDAC"
MANIFEST = "manifest.json"
#: tokens after which a segment is closed, and tokens read back at once (a longer document is taken whole)
SEGMENT = 1 << 21
READ = 1 << 18
#: bits of a bitmap per directory entry
BLOCK = 512
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


# ---------------------------------------------------------------- codes

def code_levels(ids: np.ndarray) -> list[dict[str, np.ndarray]]:
    """The levels of the ids (unsigned, below 2**32): chunks, more, ranks."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        goes_on = rest > 0xFF
        more = np.packbits(goes_on, bitorder="little")
        padded = np.zeros(-(-len(rest) // BLOCK) * (BLOCK // 8), np.uint8)
        padded[: len(more)] = more
        counts = _ONES[padded].reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint64)
        ranks = np.zeros(len(counts) + 1, np.uint64)
        np.cumsum(counts, out=ranks[1:])
        levels.append({"chunks": (rest & 0xFF).astype(np.uint8), "more": more, "ranks": ranks})
        if not goes_on.any():
            return levels
        rest = rest[goes_on] >> np.uint32(8)


class Level:
    """One level, in memory or in a file: read(name, first, last) gives a piece of an array."""

    def __init__(self, read):
        self.read = read

    def rank(self, at: int) -> int:
        """Set bits before place `at`."""
        block = at // BLOCK
        before = self.read("more", block * (BLOCK // 8), -(-at // 8))
        found = int(self.read("ranks", block, block + 1)[0]) + int(_ONES[before].sum())
        if at % 8:
            found -= int(_ONES[before[-1] >> (at % 8)])
        return found

    def goes_on(self, first: int, last: int) -> np.ndarray:
        bits = np.unpackbits(self.read("more", first // 8, -(-last // 8)), bitorder="little")
        return bits[first % 8 : first % 8 + last - first].astype(bool)


def read_codes(levels: list[Level], first: int, last: int) -> np.ndarray:
    """Ids first .. last - 1: neighbours stay neighbours on every level."""
    ids = np.zeros(last - first, np.uint32)
    places = np.arange(last - first)
    for depth, level in enumerate(levels):
        if not len(places):
            break
        ids[places] |= level.read("chunks", first, last).astype(np.uint32) << np.uint32(8 * depth)
        goes_on = level.goes_on(first, last)
        first = level.rank(first)
        places = places[goes_on]
        last = first + len(places)
    return ids


# ---------------------------------------------------------------- files

def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if ":/" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _write_segment(out, at: int, doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> tuple[int, dict]:
    """Appends a segment at offset `at`; its end and its footer entry."""
    arrays = {
        "doc_id": np.array([d or 0 for d in doc_ids], np.int64), "known": np.array([d is not None for d in doc_ids], np.uint8),
        "starts": np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint64),
    }
    levels = code_levels(ids)
    arrays |= {f"{name}{k}": a for k, level in enumerate(levels) for name, a in level.items()}
    entry = {"docs": len(doc_ids), "tokens": len(ids), "levels": len(levels), "arrays": {}}
    for name, a in arrays.items():
        raw = a.astype(a.dtype.newbyteorder("<")).tobytes()
        entry["arrays"][name] = [at, a.dtype.newbyteorder("<").str, len(a)]
        out.write(raw)
        at += len(raw)
    return at, entry


def write_file(fs: pafs.FileSystem, path: str, documents: Iterator[tuple[int | None, np.ndarray]], segment: int = SEGMENT) -> tuple[int, int]:
    """One file of the documents (id, token ids) in their order; numbers of documents and tokens."""
    entries, at, docs, tokens = [], 0, 0, 0
    with fs.open_output_stream(path) as out:
        names: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def close() -> None:
            nonlocal at, held
            if names:
                at, entry = _write_segment(out, at, names, [len(p) for p in parts], np.concatenate(parts))
                entries.append(entry)
                names.clear()
                parts.clear()
                held = 0

        for doc_id, ids in documents:
            names.append(doc_id)
            parts.append(ids)
            held += len(ids)
            docs, tokens = docs + 1, tokens + len(ids)
            if held >= segment:
                close()
        close()
        footer = json.dumps({"segments": entries}).encode()
        out.write(footer + len(footer).to_bytes(4, "little") + MAGIC)
    return docs, tokens


class TokenFile:
    """Random access to one file."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} is no token file")
        length = int.from_bytes(tail[:4], "little")
        self.segments = json.loads(self.file.read_at(length, size - 12 - length))["segments"]
        self.bases = [0]
        for s in self.segments:
            self.bases.append(self.bases[-1] + s["tokens"])

    def array(self, segment: dict, name: str, first: int = 0, last: int | None = None) -> np.ndarray:
        at, kind, count = segment["arrays"][name]
        last = count if last is None else min(last, count)
        size = np.dtype(kind).itemsize
        return np.frombuffer(self.file.read_at(max(0, last - first) * size, at + first * size), kind)

    def levels(self, segment: dict, whole: bool = False) -> list[Level]:
        """The segment's levels; with whole=True their arrays are read once, else piece by piece."""
        def reader(k: int):
            if not whole:
                return lambda name, first, last: self.array(segment, f"{name}{k}", first, last)
            held = {name: self.array(segment, f"{name}{k}") for name in ("chunks", "more", "ranks")}
            return lambda name, first, last: held[name][first:last]

        return [Level(reader(k)) for k in range(segment["levels"])]

    def tokens(self, first: int, last: int) -> np.ndarray:
        """Token ids at places first .. last - 1 of this file."""
        found = []
        while first < last:
            k = bisect.bisect_right(self.bases, first) - 1
            end = min(last, self.bases[k + 1])
            found.append(read_codes(self.levels(self.segments[k]), first - self.bases[k], end - self.bases[k]))
            first = end
        return np.concatenate(found) if found else np.zeros(0, np.uint32)


class TokenFolder:
    """Random access to all tokens of a written folder, by their places among all."""

    def __init__(self, path: str):
        self.fs, self.path = file_system(path)
        with self.fs.open_input_stream(posixpath.join(self.path, MANIFEST)) as f:
            self.files = json.loads(f.read())["files"]
        self.bases = [f["start"] for f in self.files]
        self.total = self.files[-1]["start"] + self.files[-1]["tokens"] if self.files else 0

    def tokens(self, first: int, last: int) -> np.ndarray:
        if not 0 <= first <= last <= self.total:
            raise IndexError(f"{first}..{last} of {self.total} tokens")
        found = []
        while first < last:
            f = self.files[bisect.bisect_right(self.bases, first) - 1]
            end = min(last, f["start"] + f["tokens"])
            found.append(TokenFile(self.fs, posixpath.join(self.path, f["name"])).tokens(first - f["start"], end - f["start"]))
            first = end
        return np.concatenate(found) if found else np.zeros(0, np.uint32)


# ---------------------------------------------------------------- data source

@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str
    docs: int
    tokens: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, segment: int):
        self.path, self.segment = path, segment

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = file_system(self.path)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tokens"
        fs.create_dir(folder, recursive=True)

        def documents() -> Iterator[tuple[int | None, np.ndarray]]:
            for batch in iterator:
                column = batch.column("ids")
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), column):
                    yield doc_id, ids.values.to_numpy(zero_copy_only=False).astype(np.uint32)

        docs, tokens = write_file(fs, posixpath.join(folder, name), documents(), self.segment)
        return Written(part, name, docs, tokens)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = file_system(self.path)
        files, at = [], 0
        for m in sorted((m for m in messages if m is not None and m.docs), key=lambda m: m.part):
            files.append({"name": m.name, "start": at, "docs": m.docs, "tokens": m.tokens})
            at += m.tokens
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(posixpath.join(folder, MANIFEST)) as out:
            out.write(json.dumps({"files": files}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = file_system(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(posixpath.join(folder, m.name))


@dataclass
class Part(InputPartition):
    name: str
    start: int


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Part]:
        # an empty folder still needs a partition
        return [Part(f["name"], f["start"]) for f in TokenFolder(self.path).files] or [Part("", 0)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        fs, folder = file_system(self.path)
        file = TokenFile(fs, posixpath.join(folder, partition.name))
        for base, segment in zip(file.bases, file.segments):
            levels = file.levels(segment, whole=True)
            starts = file.array(segment, "starts").astype(np.int64)
            doc_ids, known = file.array(segment, "doc_id"), file.array(segment, "known").astype(bool)
            i, n = 0, segment["docs"]
            while i < n:
                j = min(n, max(i + 1, int(np.searchsorted(starts, starts[i] + READ, "right")) - 1))
                raw = read_codes(levels, int(starts[i]), int(starts[j])).astype("<u4").tobytes()
                offsets = ((starts[i : j + 1] - starts[i]) * 4).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids[i:j], mask=~known[i:j]), pa.array(starts[i:j] + base + partition.start), pa.array(np.diff(starts[i : j + 1])),
                    pa.BinaryArray.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)]),
                ], names=["doc_id", "start", "n_tokens", "ids"])
                i = j


class TokenCodes(DataSource):
    """Written: doc_id, ids (array<int>).  Read: doc_id, start, n_tokens, ids (their uint32 bytes, little-endian)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "doc_id bigint, start bigint, n_tokens bigint, ids binary"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], int(self.options.get("segment", SEGMENT)))


# ---------------------------------------------------------------- documents

@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> bpe.Bpe:
    return bpe.Bpe(path)


def _token_ids(batches: Iterator[pa.RecordBatch], path: str, end_id: int | None) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(path)
    tail = [] if end_id is None else [end_id]
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            ids = [np.append(encoder.encode(t or ""), tail).astype(np.int32) for t in part.column("text").to_pylist()]
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(i) for i in ids], out=offsets[1:])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))], names=["doc_id", "ids"])


def write_tokens(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text", segment: int = SEGMENT,
) -> None:
    """The token ids of all texts, each followed by end_id, in ascending doc_id into the files of a new folder."""
    spark = docs.sparkSession
    spark.dataSource.register(TokenCodes)
    order = ["doc_id", F.xxhash64("text")]
    dealt = texts_of(docs, doc_id, text).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    ids = dealt.mapInArrow(lambda b: _token_ids(b, tokenizer, end_id), "doc_id long, ids array<int>")
    ids.write.format(FORMAT).mode("append").option("segment", segment).save(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids of every written document."""
    spark.dataSource.register(TokenCodes)
    return spark.read.format(FORMAT).load(folder)
