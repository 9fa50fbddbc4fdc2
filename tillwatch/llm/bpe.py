"""BPE encoding and decoding by tree concatenation.

A long text is halved until its parts have at most LEAF bytes, parts are encoded in one batch of
parallel threads within the text's task, and neighbours are joined pairwise.  A join re-encodes a
window of tokens around the cut and grows it until the window's first and last tokens are the tokens that the two sides already have there.  In a
BPE encoding any two neighbouring tokens are what their joined text encodes to, and a sequence with
that property is the encoding; so parts spliced at shared tokens are exact.  A window starts and ends
where the pre-tokeniser cannot see a difference: before white space that follows other characters, or
inside a run of letters, digits or other characters, but not at an apostrophe.

Vocabulary files are parameters.  Where token ids follow the order of merges and a text has only
characters on which all pattern engines agree, parts are encoded by tiktoken with the same merges;
any other part goes through the tokenizers library.

Defined results: null is an empty text; an empty text has no token; repeated rows are repeated; other
columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tillwatch.llm.shared import texts_of, with_rest

LEAF = 16_384
WINDOW = 8
#: threads for the parts of a long text
THREADS = 4
#: fixed value: the pre-tokenisation pattern of byte-level BPE
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = re.compile("[\t\n\r -~¡-¬®-ɏ]*")


def _byte_letters() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    letters = {chr(b): b for b in own}
    rest = [b for b in range(256) if b not in own]
    return letters | {chr(256 + k): b for k, b in enumerate(rest)}


def _kind(c: str) -> str:
    return "s" if c.isspace() else "l" if c.isalpha() else "n" if c.isnumeric() else "o"


class Bpe:
    """A byte-level BPE tokenizer of a tokenizers JSON file."""

    def __init__(self, path: str, leaf: int = LEAF):
        self.leaf = leaf
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        vocab, letters = spec["model"]["vocab"], _byte_letters()
        self.bytes: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if all(c in letters for c in t)}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.bytes |= {i: t.encode() for t, i in self.added.items()}
        top = max(self.bytes) + 1
        self.table = [self.bytes.get(i, b"") for i in range(top)]
        self.sizes = np.array([len(b) for b in self.table], np.int64)
        self.numbers = [str(i) for i in range(top)]
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ids = [vocab.get(a + b, -1) for a, b in pairs]
        ordered = all(x < y for x, y in zip(ids, ids[1:])) and spec.get("normalizer") is None
        ranks = {self.bytes[i]: i for i in vocab.values() if i in self.bytes and i not in self.added.values()}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ordered else None

    def encode_part(self, text: str) -> list[int]:
        """Ids of a text without added tokens, in one piece."""
        if self.fast is not None and _PLAIN.fullmatch(text):
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode_parts(self, texts: list[str]) -> list[list[int]]:
        """encode_part of each, the parts in parallel threads of the libraries."""
        plain = [self.fast is not None and _PLAIN.fullmatch(t) is not None for t in texts]
        fast = iter(self.fast.encode_ordinary_batch([t for t, p in zip(texts, plain) if p], num_threads=THREADS) if any(plain) else [])
        rest = [t for t, p in zip(texts, plain) if not p]
        other = iter([e.ids for e in self.tokenizer.encode_batch(rest, add_special_tokens=False)] if rest else [])
        return [next(fast) if p else next(other) for p in plain]

    def cuts(self, raw: bytes) -> list[int]:
        """Byte offsets at which a long text is halved, outermost first left to right: preferably before white space."""
        found, todo = [0, len(raw)], [(0, len(raw))]
        while todo:
            a, b = todo.pop()
            if b - a <= self.leaf:
                continue
            mid = (a + b) // 2
            while raw[mid] & 0xC0 == 0x80:
                mid -= 1
            at = raw.rfind(b" ", max(a + 1, mid - self.leaf // 4), mid + 1)
            if at > 0 and not raw[at - 1 : at].isspace() and not raw[at - 1] >= 0x80:
                mid = at
            if a < mid < b:
                found.append(mid)
                todo += [(a, mid), (mid, b)]
        return sorted(found)

    def encode_text(self, text: str) -> np.ndarray:
        raw = text.encode()
        if len(raw) <= self.leaf:
            return np.array(self.encode_part(text), np.int64)
        edges = self.cuts(raw)
        ids = self.encode_parts([raw[a:b].decode() for a, b in zip(edges, edges[1:])])
        parts = [(a, b, np.array(i, np.int64)) for a, b, i in zip(edges, edges[1:], ids)]
        while len(parts) > 1:
            joined = [self.join(raw, *parts[k], *parts[k + 1]) for k in range(0, len(parts) - 1, 2)]
            parts = joined + parts[len(joined) * 2 :]
        return parts[0][2]

    def join(self, raw: bytes, a: int, mid: int, left: np.ndarray, mid2: int, b: int, right: np.ndarray) -> tuple[int, int, np.ndarray]:
        """raw[a:b] from the tokens of raw[a:mid] and raw[mid:b]."""
        left_at = a + np.concatenate([[0], np.cumsum(self.sizes[left])])
        right_at = mid + np.concatenate([[0], np.cumsum(self.sizes[right])])
        width = WINDOW
        while True:
            i, j = max(0, len(left) - width), min(len(right), width)
            while i > 0 and not self.blind(raw, int(left_at[i])):
                i -= 1
            while j < len(right) and not self.blind(raw, int(right_at[j])):
                j += 1
            window = np.array(self.encode_part(raw[left_at[i] : right_at[j]].decode()), np.int64)
            if (i == 0 or window[0] == left[i]) and (j == len(right) or window[-1] == right[j - 1]):
                return a, b, np.concatenate([left[:i], window, right[j:]])
            width *= 2

    @staticmethod
    def blind(raw: bytes, at: int) -> bool:
        """Whether texts may be cut here without changing how either side is pre-tokenised, but for the cut itself."""
        if at <= 0 or at >= len(raw) or raw[at] & 0xC0 == 0x80:
            return False
        start = at - 1
        while raw[start] & 0xC0 == 0x80:
            start -= 1
        before, after = raw[start:at].decode(), raw[at : at + 4].decode(errors="ignore")[:1]
        if not after or after == "'" or before == "'":
            return False
        kinds = _kind(before), _kind(after)
        return kinds[0] == kinds[1] != "s" or kinds[0] != "s" and kinds[1] == "s"

    def encode(self, text: str) -> np.ndarray:
        if self.split is None or not any(t in text for t in self.added):
            return self.encode_text(text)
        parts = [np.array([self.added[p]], np.int64) if p in self.added else self.encode_text(p) for p in self.split.split(text) if p]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def decode(self, ids) -> bytes:
        table = self.table
        return b"".join([table[i] for i in ids])

    def digest(self, ids) -> str:
        numbers = self.numbers
        return hashlib.sha256(",".join([numbers[i] for i in ids]).encode()).hexdigest()


@functools.lru_cache(maxsize=2)
def _load(path: str, leaf: int) -> Bpe:
    return Bpe(path, leaf)


def _encode(batches: Iterator[pa.RecordBatch], path: str, leaf: int, digests: bool) -> Iterator[pa.RecordBatch]:
    bpe = _load(path, leaf)
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            out: dict[str, list] = {"n": [], "x": [], "y": []}
            for text in part.column("text").to_pylist():
                ids = bpe.encode(text or "").tolist()
                raw = bpe.decode(ids)
                out["n"].append(len(ids))
                out["x"].append(bpe.digest(ids) if digests else ids)
                out["y"].append(hashlib.sha256(raw).hexdigest() if digests else raw.decode("utf-8", "replace"))
            rest = [part.column("rest")] if "rest" in part.schema.names else []
            arrays = [part.column("doc_id"), pa.array(out["n"], pa.int64()), pa.array(out["x"], pa.string() if digests else pa.list_(pa.int32())), pa.array(out["y"], pa.string()), *rest]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]), *(["rest"] if rest else [])])


def encode_documents(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", leaf: int = LEAF, digests: bool = False, carry: list[str] | None = None,
) -> DataFrame:
    """doc_id, n_tokens, ids, decoded (and rest, if others are carried) of every row; with digests=True, SHA-256 of ids and text."""
    source = texts_of(docs, doc_id, text, carry)
    columns = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return source.mapInArrow(lambda b: _encode(b, path, leaf, digests), with_rest(f"doc_id long, n_tokens long, {columns}", source))
