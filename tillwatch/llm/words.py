"""Words of whole texts as numpy arrays: byte positions, 64-bit hashes and hashes of word runs.

Texts come as Arrow columns and are taken in slices of about SLICE bytes, so memory is bounded by a
slice or by the longest single text.  A word's hash mixes its bytes eight at a time (long words are digested
one by one), a word sequence's is a polynomial of its words' hashes modulo a prime, from prefix sums; both
come in two families without common constants.  A hash finds candidates or stands for a word run of a
set, and the operators say where texts themselves are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 18
_U = np.uint64
_ALL = np.arange(256)
_LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)
_SPACE = (_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D))
_LETTER = (_ALL >= 0x80) | ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_LOWER >= 0x61) & (_LOWER <= 0x7A))
#: kind of words -> which bytes belong to a word, and whether A-Z are lowered
KINDS = {"space": (~_SPACE, False), "space_lower": (~_SPACE, True), "letters_lower": (_LETTER, True)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: a prime; sums of words are taken modulo it
_PRIME = (1 << 61) - 1
_BASES = (0x1D3F84A5B6C7E91, 0x0B7A3D2C94E65F17 & _PRIME)
#: two families of hashes that share no constant
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_STEPS = (0xD1342543DE82EF95, 0xA0761D6478BD642F)
#: longer words are hashed one by one
_LONG = 64
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _modulo(x: np.ndarray) -> np.ndarray:
    x = (x & _U(_PRIME)) + (x >> _U(61))
    return np.where(x >= _U(_PRIME), x - _U(_PRIME), x)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, both below it."""
    a_low, a_high, b_low, b_high = a & _U(0x7FFFFFFF), a >> _U(31), b & _U(0x7FFFFFFF), b >> _U(31)
    middle = a_low * b_high + a_high * b_low
    return _modulo((a_high * b_high << _U(1)) + (middle >> _U(30)) + ((middle & _U(0x3FFFFFFF)) << _U(31)) + a_low * b_low)


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo the prime."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.ones(1, np.uint64)
        while len(known) < max(n, SLICE // 4):
            known = np.concatenate([known, _product(known, np.uint64(pow(base, len(known), _PRIME)))])
        if n <= SLICE:
            _powers[base] = known
    return known[:n]


def spans_hash(values: np.ndarray, first: np.ndarray, last: np.ndarray, family: int = 0) -> np.ndarray:
    """Hash of values[first:last] for each pair, whatever its place: a polynomial modulo the prime."""
    base = _BASES[family]
    terms = _product(_modulo(values), powers(base, len(values)))
    low, high = np.zeros(len(values) + 1, np.uint64), np.zeros(len(values) + 1, np.uint64)
    np.cumsum(terms & _U(0x7FFFFFFF), out=low[1:])
    np.cumsum(terms >> _U(31), out=high[1:])
    found = _modulo(_product(_modulo(high[last] - high[first]), np.full(1, 1 << 31, np.uint64)) + _modulo(low[last] - low[first]))
    found = _product(found, powers(pow(base, -1, _PRIME), len(values) + 1)[first])
    return mix(found + (last - first).astype(np.uint64) * _U(_SEEDS[family]))


class Words:
    """All words of the texts of one slice; those of text i are bounds[i] to bounds[i + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: str):
        member, lower = KINDS[kind]
        self.data = _LOWER[data] if lower else data
        inside = member[data]
        size = len(data)
        before, after = np.zeros(size, bool), np.zeros(size, bool)
        if size:
            before[1:], after[:-1] = inside[:-1], inside[1:]
            before[offsets[:-1][offsets[:-1] < size]] = False
            after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)

    def hashes(self, family: int = 0) -> np.ndarray:
        """A 64-bit hash of each word: eight bytes at a time, mixed after each, so that no pattern of bytes cancels out."""
        size = self.ends - self.starts
        found = mix(size.astype(np.uint64) + _U(_SEEDS[family]))
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        which, at, left = slice(None), self.starts, size
        for _ in range(0, min(int(size.max(initial=0)), _LONG), 8):
            found[which] = mix((found[which] ^ (eight[at] & _MASKS[np.minimum(left, 8)])) * _U(_STEPS[family]))
            more = np.flatnonzero(left > 8)
            which = more if isinstance(which, slice) else which[more]
            at, left = at[more] + 8, left[more] - 8
        for i in np.flatnonzero(size > _LONG).tolist():
            found[i] = int.from_bytes(hashlib.blake2b(self.word(i), digest_size=8, key=bytes([family])).digest(), "little")
        return found

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def words(self, first: int, last: int) -> list[bytes]:
        if first >= last:
            return []
        base = int(self.starts[first])
        raw = self.data[base : self.ends[last - 1]].tobytes()
        return [raw[a - base : b - base] for a, b in zip(self.starts[first:last].tolist(), self.ends[first:last].tolist())]


def runs_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words (across texts too: callers mask those)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(n, np.uint64)
    for j in range(k):
        found *= _U(0xA24BAED4963EE407)
        found += hashes[j : j + n]
    return mix(found)


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, after the last, their bytes, their offsets); a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1))
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j
    # a Python worker lives on: what Arrow keeps of large batches goes back
    if len(data) > 4 * limit:
        pa.default_memory_pool().release_unused()


def word_slices(column: pa.Array, kind: str) -> Iterator[tuple[int, int, Words]]:
    for i, j, data, offsets in slices(column):
        yield i, j, Words(data, offsets, kind)


def long_list(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """list<int64> column: counts[i] of the values for row i."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64)))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, with overlapping or touching ones joined."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            if last > out[-1][1]:
                out[-1] = (out[-1][0], last)
        else:
            out.append((first, last))
    return out


def without(text: str | None, spans: list[tuple[int, int]], kind: str) -> str | None:
    """text without the words of the spans and what stands between the words of one span."""
    if not text or not spans:
        return text
    raw = text.encode()
    words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), kind)
    kept, at = [], 0
    for first, last in merged(spans):
        if first < min(last, len(words.starts)):
            kept.append(raw[at : words.starts[first]])
            at = int(words.ends[min(last, len(words.starts)) - 1])
    return b"".join([*kept, raw[at:]]).decode()
