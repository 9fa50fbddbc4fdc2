"""Token files: round trips, random access, order and places against the library."""

import random
import zlib

import numpy as np
import pyarrow.fs as pafs
from tokenizers import Tokenizer

from tillwatch.llm import queries, token_files
from tillwatch.llm.token_files import Level, TokenFile, TokenFolder, code_levels, read_codes


def in_memory(levels):
    return [Level(lambda name, a, b, level=level: level[name][a:b]) for level in levels]


def test_codes_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 511, 512, 513, 5_000):
        for top in (2, 256, 257, 65_536, 50_257, 2**24 + 1, 2**32):
            ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            ids[rng.random(n) < 0.3] %= 250
            levels = code_levels(ids)
            assert sum(len(level["chunks"]) for level in levels) == sum(max(1, (int(i).bit_length() + 7) // 8) for i in ids)
            read = in_memory(levels)
            assert (read_codes(read, 0, n) == ids).all()
            for _ in range(20):
                a, b = sorted(rng.integers(0, n + 1, 2).tolist())
                assert (read_codes(read, a, b) == ids[a:b]).all()
            for at in rng.integers(0, n, 20).tolist() if n else []:
                assert read_codes(read, at, at + 1)[0] == ids[at]
                assert read[0].rank(at) == (ids[:at] > 255).sum()


def test_one_token_reads_few_bytes(tmp_path):
    rng = np.random.default_rng(2)
    docs = [(k, rng.integers(0, 50_257, 20_000).astype(np.uint32)) for k in range(10)]
    fs, path = pafs.LocalFileSystem(), str(tmp_path / "one.tokens")
    assert token_files.write_file(fs, path, iter(docs), segment=50_000) == (10, 200_000)
    file, whole = TokenFile(fs, path), np.concatenate([i for _, i in docs])
    assert [s["docs"] for s in file.segments] == [3, 3, 3, 1]
    read = []
    inner = file.file

    class Counted:
        def read_at(self, n, at):
            read.append(n)
            return inner.read_at(n, at)

    file.file = Counted()
    for at in rng.integers(0, 200_000, 50).tolist():
        read.clear()
        assert file.tokens(at, at + 1)[0] == whole[at] and sum(read) < 200
    assert (file.tokens(59_990, 160_010) == whole[59_990:160_010]).all()


def check(spark, docs, folder, **options):
    path = queries.tokenizer_path()
    frame = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, ids string, start int")
    token_files.write_tokens(frame.repartition(5), path, folder, end_id=2, **options)
    found = token_files.read_tokens(spark, folder)
    assert dict(found.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids": "binary"}
    rows = sorted(found.collect(), key=lambda r: r["start"])
    library = Tokenizer.from_file(path)
    ids = {t: [*library.encode(t or "", add_special_tokens=False).ids, 2] for _, t in docs}
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"])) for r in rows) == sorted(
        (d is not None, d or 0, np.array(ids[t], "<u4").tobytes()) for d, t in docs)
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in rows]
    assert order == sorted(order)
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] * 4 == len(r["ids"])
        at += r["n_tokens"]
    whole = b"".join(bytes(r["ids"]) for r in rows)
    reader = TokenFolder(folder)
    assert reader.total == at and reader.tokens(0, at).astype("<u4").tobytes() == whole
    for _ in range(20 if at else 0):
        k = random.Random(at).randrange(at)
        assert reader.tokens(k, k + 1)[0] == int.from_bytes(whole[4 * k : 4 * k + 4], "little")


def test_documents(spark, tmp_path):
    rnd = random.Random(3)
    parts = ["word ", "the ", "é", "日本", "😀 ", "\n", "<|endoftext|>", "x" * 70, " 12 "]
    docs = [(k * 7 - 300, "".join(rnd.choice(parts) for _ in range(rnd.randrange(60)))) for k in range(400)]
    docs += [(None, "no id"), (None, None), (5, None), (5, ""), (5, "same"), (5, "same"), (5, "other"), (2**63 - 1, "last"), (-(2**63), "first"), (6, "long text " * 60_000)]
    check(spark, docs, str(tmp_path / "plain"), segment=1_000)
    check(spark, docs[:30], f"file://{tmp_path}/uri")
    check(spark, [], str(tmp_path / "empty"))


def test_query(spark, sf):
    library = Tokenizer.from_file(queries.tokenizer_path())
    found = {r["doc_id"]: r for r in queries.token_output_query(spark, sf).collect()}
    at = 0
    for r in sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()):
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        row = found.pop(r["doc_id"])
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert not found
