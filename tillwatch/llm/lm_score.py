"""LM scoring by cross-entropy difference.

Two bigram models of words, one of the target rows and one of all rows, over every word of the corpus (or,
if `vocabulary` is given, its most frequent words, everything else being one unknown word).  Both use the
same smoothing: a bigram's probability falls back on the word's, and the word's on the uniform one.  A
document's score is the mean over its tokens of target loss minus background loss: the lower, the more
it is like the target.

A token's difference is a part of its bigram and a part of its first word.  Common words (more than one of
`hot_words` parts of all tokens) and common bigrams of them (`hot` parts) are few; their counts are broadcast
and their parts are summed where the text is.  All other tokens move once, eight or sixteen bytes each with
a document number, packed per slice of the corpus and bucket: by bigram where the second word is common,
else by that word.  A bucket's tokens are sorted, so the groups themselves are the counts of bigrams and
words, and what goes back is one sum per document of a slice.  The model is never gathered and no group is
larger than a common word's or bigram's share.

Defined results: a text without words has no token and a null score; without any target row the target
model is uniform but for smoothing; equally frequent words enter a limited vocabulary by hash; repeated
rows count each time; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.shared import discard, narrow_batches, small, stored
from tillwatch.llm.words import mix, word_slices

#: pseudo-counts of the fallback, of bigrams on words and of words on the uniform distribution
PRIOR = 50.0
#: tokens, and documents, of a slice of the corpus
GATHER = 1_000_000
SLICE_DOCS = 1 << 15
#: common bigrams, and words, are more than one of so many parts of all tokens
HOT = 500_000
HOT_WORDS = 1_000_000
#: tokens of a bucket
BUCKET = 2_000_000
#: stands for an unknown word, and before a text's first
UNKNOWN = 0
#: bits of a common word's number in a bigram's key
WORD_BITS = 20

_U = np.uint64
_END = _U(0xFFFFFFFFFFFFFFFF)


def _words(words, known: np.ndarray | None) -> np.ndarray:
    """Hashes of all words, the unknown ones as UNKNOWN."""
    found = words.hashes()
    if known is not None:
        at = np.searchsorted(known, found)
        at[at == len(known)] = 0
        found = np.where(known[at] == found, found, _U(UNKNOWN)) if len(known) else np.zeros_like(found)
    return found


class Slice:
    """Neighbouring texts with about GATHER words: word hashes, the text of each word, bounds, target marks."""

    def __init__(self, parts: list[tuple]):
        self.second = np.concatenate([p[0] for p in parts])
        counts = np.concatenate([p[1] for p in parts])
        self.target = np.concatenate([p[2] for p in parts])
        self.ids = [i for p in parts for i in p[3]]
        self.counts, self.bounds = counts, np.concatenate([[0], np.cumsum(counts)])
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.first = np.empty_like(self.second)
        self.first[1:] = self.second[:-1]
        filled = counts > 0
        self.first[self.bounds[:-1][filled]] = UNKNOWN
        self.last = np.zeros(len(self.second), bool)
        self.last[self.bounds[1:][filled] - 1] = True
        self.marks = self.target[self.text]


def _slices(batches: Iterator[pa.RecordBatch], known: np.ndarray | None) -> Iterator[Slice]:
    held, tokens, texts = [], 0, 0
    for batch in batches:
        target = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
        ids = batch.column("doc_id").to_pylist()
        for i, j, words in word_slices(batch.column("text"), "letters_lower"):
            if held and (tokens > GATHER or texts + j - i > SLICE_DOCS):
                yield Slice(held)
                held, tokens, texts = [], 0, 0
            own = _words(words, known)
            for a in range(i, j, SLICE_DOCS):  # a slice has at most SLICE_DOCS texts
                b = min(j, a + SLICE_DOCS)
                if held and texts + b - a > SLICE_DOCS:
                    yield Slice(held)
                    held, tokens, texts = [], 0, 0
                held.append((own[words.bounds[a - i] : words.bounds[b - i]], words.counts[a - i : b - i], target[a:b], ids[a:b]))
                tokens, texts = tokens + len(held[-1][0]), texts + b - a
    if held:
        yield Slice(held)


def _groups(sorted_keys: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Begins of groups of equal keys (all sorted together)."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    for k in more:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _first_counts(batches: Iterator[pa.RecordBatch], known: np.ndarray | None, hot: int) -> Iterator[pa.RecordBatch]:
    """Per slice: (0, word, 0) with its tokens, target tokens, and those of them that end a text; (1, first, second)
    with the tokens of a bigram that is common in the slice; (2, 0, 0) with texts that have words."""
    for s in _slices(batches, known):
        order = np.argsort(s.second, kind="stable")
        words, at = s.second[order], s.marks[order]
        begin = _groups(words)
        last, ends = s.last[order], s.last[order] & at
        sums = [np.add.reduceat(x.astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64) for x in (np.ones(len(words)), at, last, ends)]
        pair = np.lexsort((s.first, s.second))
        first, second = s.first[pair], s.second[pair]
        starts = _groups(second, first)
        n = np.diff(np.append(starts, len(pair)))
        often = np.flatnonzero(n * hot > len(pair))
        filled = s.counts > 0
        k, none = len(often), np.zeros(len(often) + 1, np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([np.zeros(len(begin)), np.ones(k), [2]]).astype(np.int32)),
            pa.array(np.concatenate([words[begin], first[starts[often]], np.zeros(1, np.uint64)]).view(np.int64)),
            pa.array(np.concatenate([np.zeros(len(begin), np.uint64), second[starts[often]], np.zeros(1, np.uint64)]).view(np.int64)),
            pa.array(np.concatenate([sums[0], n[often], [filled.sum()]])), pa.array(np.concatenate([sums[1], none[:-1], [(filled & s.target).sum()]])),
            pa.array(np.concatenate([sums[2], none])), pa.array(np.concatenate([sums[3], none])),
        ], names=["kind", "a", "b", "n", "t", "e", "te"])


class Model:
    """What every task knows: totals, common words with their counts, common bigrams with their parts."""

    def __init__(self, prior: float, size: int, total: int, target: int, starts: tuple[int, int], known: np.ndarray | None, words: np.ndarray, counts: np.ndarray):
        self.prior, self.size, self.total, self.target, self.known = prior, size, total, target, known
        order = np.argsort(words)
        self.words = words[order]  # with UNKNOWN, the first
        n, t, e, te = counts[order].T
        before, before_target = n - e, t - te  # as first words
        before[self.words == UNKNOWN] += starts[0]
        before_target[self.words == UNKNOWN] += starts[1]
        self.n, self.t = n, t
        self.first = self.first_part(before, before_target)
        self.pairs, self.parts = np.zeros(0, np.uint64), np.zeros(0)

    def first_part(self, n: np.ndarray, t: np.ndarray) -> np.ndarray:
        return np.log(t + self.prior) - np.log(n + self.prior)

    def pair_part(self, n: np.ndarray, t: np.ndarray, second_n: np.ndarray, second_t: np.ndarray) -> np.ndarray:
        alike, target = ((c + self.prior / self.size) / (tokens + self.prior) * self.prior for c, tokens in ((second_n, self.total), (second_t, self.target)))
        return np.log(n + alike) - np.log(t + target)

    def number(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the common words, and whether it is one."""
        at = np.searchsorted(self.words, words)
        at[at == len(self.words)] = 0
        return at, self.words[at] == words

    def key(self, number: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A bigram of a common second word."""
        return number.astype(np.uint64) << _U(64 - WORD_BITS) | mix(first + _U(1)) >> _U(WORD_BITS)

    def pair_number(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.pairs):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        return at, self.pairs[at] == key


def _count_pairs(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Tokens and target tokens of the common bigrams, summed over the task."""
    n, t = np.zeros(len(model.pairs), np.int64), np.zeros(len(model.pairs), np.int64)
    for s in _slices(batches, model.known):
        number, common = model.number(s.second)
        at, hit = model.pair_number(model.key(number[common], s.first[common]))
        n += np.bincount(at[hit], minlength=len(n))
        t += np.bincount(at[hit], weights=s.marks[common][hit], minlength=len(n)).astype(np.int64)
    some = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), pa.array(t[some])], names=["pair", "n", "t"])


def learn(rows: DataFrame, vocabulary: int | None, prior: float, hot: int, hot_words: int) -> Model:
    """Counts of all words in Spark; what is gathered are the common ones, fewer than hot_words and hot."""
    sc = rows.sparkSession.sparkContext
    hot_words = min(hot_words, (1 << WORD_BITS) - 2)

    def counted(known: np.ndarray | None) -> DataFrame:
        shared = sc.broadcast(known)
        found = rows.mapInArrow(lambda b: _first_counts(b, shared.value, hot), "kind int, a long, b long, n long, t long, e long, te long")
        return stored(found.groupBy("kind", "a", "b").agg(*(F.sum(c).alias(c) for c in ("n", "t", "e", "te"))), "words")

    counts, known = counted(None), None
    if vocabulary is not None:
        best = counts.filter("kind = 0").orderBy(F.desc("n"), "a").limit(vocabulary).select("a").toPandas()
        known = np.sort(best["a"].to_numpy(np.int64).view(np.uint64))
        discard(counts)
        counts = counted(known)
    words = counts.filter("kind = 0")
    total, target, distinct = (x or 0 for x in words.agg(F.sum("n"), F.sum("t"), F.count(F.lit(1))).first())
    starts = counts.filter("kind = 2").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    common = words.filter((F.col("n") * hot_words > total) | (F.col("a") == UNKNOWN)).select("a", "n", "t", "e", "te").toPandas()
    hashes, sums = common["a"].to_numpy(np.int64).view(np.uint64), common[["n", "t", "e", "te"]].to_numpy(np.int64)
    if UNKNOWN not in hashes:
        hashes, sums = np.append(hashes, _U(UNKNOWN)), np.concatenate([sums, np.zeros((1, 4), np.int64)])
    model = Model(prior, 1 + (len(known) if known is not None else distinct), total, target, tuple(starts), known, hashes, sums)
    # what is common in slices, as far as it is common in all; counted exactly next
    often = counts.filter("kind = 1").filter(F.col("n") * hot > total).select("a", "b").toPandas()
    discard(counts)
    number, is_common = model.number(often["b"].to_numpy(np.int64).view(np.uint64))
    model.pairs = np.unique(model.key(number[is_common], often["a"].to_numpy(np.int64).view(np.uint64)[is_common]))
    if len(model.pairs):
        shared = sc.broadcast(model)
        exact = rows.mapInArrow(lambda b: _count_pairs(b, shared.value), "pair long, n long, t long").groupBy("pair").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
        found = exact.toPandas().sort_values("pair")
        at = found["pair"].to_numpy(np.int64)
        n, t = np.zeros(len(model.pairs)), np.zeros(len(model.pairs))
        n[at], t[at] = found["n"], found["t"]
        number = (model.pairs >> _U(64 - WORD_BITS)).astype(np.int64)
        model.parts = model.pair_part(n, t, model.n[number], model.t[number])
    return model


# rows between tasks: a slice's documents (kind 0), its tokens of a bucket by bigram (1) or by word (2), sums that go back (3)
PACKED = "to int, slice long, kind int, keys binary, more binary, docs binary"
_NAMES = ["to", "slice", "kind", "keys", "more", "docs"]


def _record(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=_NAMES)


def _send(batches: Iterator[pa.RecordBatch], model: Model, buckets: int) -> Iterator[pa.RecordBatch]:
    """Each slice's own sums, and its other tokens by bucket."""
    part = TaskContext.get().partitionId()
    for n, s in enumerate(_slices(batches, model.known)):
        name = part << 32 | n
        number, common = model.number(s.second)
        sums = np.zeros(len(s.counts))
        filled = s.counts > 0
        start = model.first[np.searchsorted(model.words, _U(UNKNOWN))]
        sums[filled] += start
        inside = common & ~s.last
        sums += np.bincount(s.text[inside], weights=model.first[number[inside]], minlength=len(sums))
        key = model.key(number[common], s.first[common])
        at, hit = model.pair_number(key)
        text = s.text[common]
        if hit.any():
            sums += np.bincount(text[hit], weights=model.parts[at[hit]], minlength=len(sums))
        rows = [(n % buckets, name, 0, np.array([0 if i is None else i for i in s.ids], np.int64).tobytes(),
                 np.concatenate([sums, s.counts]).tobytes(), np.array([i is not None for i in s.ids], bool).tobytes())]
        doc = (s.text << 1 | s.marks).astype(np.uint16)
        rest = ~hit
        rows += _packed(name, 1, buckets, mix(key[rest]), doc[common][rest], key[rest])
        # by word: the bigrams of a rare second word, and a mark where it ends a text
        rare, ends = ~common, ~common & s.last
        second = np.concatenate([s.second[rare], s.second[ends]])
        more = np.concatenate([s.first[rare], np.full(int(ends.sum()), _END)])
        rows += _packed(name, 2, buckets, mix(second), np.concatenate([doc[rare], doc[ends]]), second, more)
        yield _record(rows)


def _packed(name: int, kind: int, buckets: int, spread: np.ndarray, doc: np.ndarray, keys: np.ndarray, more: np.ndarray | None = None) -> list[tuple]:
    to = (spread % _U(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    bounds = np.searchsorted(to[order], np.arange(buckets + 1))
    out = []
    for k in np.flatnonzero(np.diff(bounds)).tolist():
        own = order[bounds[k] : bounds[k + 1]]
        out.append((k, name, kind, keys[own].tobytes(), b"" if more is None else more[own].tobytes(), doc[own].tobytes()))
    return out


def _answer(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """The buckets of a task, one after the other: from all tokens of a bucket, one sum per document of a slice."""
    bucket, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[2] == 0:
                yield _record([(0, *row[1:])])
                continue
            if row[0] != bucket and held:
                yield from _sums(held, model)
                held = []
            bucket = row[0]
            held.append(row)
    if held:
        yield from _sums(held, model)


def _sums(rows: list[tuple], model: Model) -> Iterator[pa.RecordBatch]:
    names = sorted({r[1] for r in rows})
    place = {name: k for k, name in enumerate(names)}
    whose, values = [], []
    for kind in (1, 2):
        mine = [r for r in rows if r[2] == kind]
        if not mine:
            continue
        keys = np.concatenate([np.frombuffer(r[3], np.uint64) for r in mine])
        docs = [np.frombuffer(r[5], np.uint16) for r in mine]
        owner = np.concatenate([place[r[1]] * SLICE_DOCS + (d >> 1).astype(np.int64) for r, d in zip(mine, docs)])
        target = np.concatenate(docs) & 1
        if kind == 1:
            order = np.argsort(keys, kind="stable")
            begin = _groups(keys[order])
            n, t = np.diff(np.append(begin, len(keys))), np.add.reduceat(target[order].astype(np.int64), begin)
            number = (keys[order][begin] >> _U(64 - WORD_BITS)).astype(np.int64)
            part = np.repeat(model.pair_part(n, t, model.n[number], model.t[number]), n)
        else:
            first = np.concatenate([np.frombuffer(r[4], np.uint64) for r in mine])
            order = np.lexsort((first, keys))
            keys, first, marks = keys[order], first[order], target[order].astype(np.int64)
            begin = _groups(keys)
            size = np.diff(np.append(begin, len(keys)))
            ends = (first == _END).astype(np.int64)
            n_ends, t_ends = np.add.reduceat(ends, begin), np.add.reduceat(ends * marks, begin)
            n_all, t_all = size - n_ends, np.add.reduceat(marks, begin) - t_ends
            as_first = np.repeat(model.first_part(n_all - n_ends, t_all - t_ends), size)
            pairs = _groups(keys, first)
            n = np.diff(np.append(pairs, len(keys)))
            word = np.searchsorted(begin, pairs, "right") - 1
            part = np.repeat(model.pair_part(n, np.add.reduceat(marks, pairs), n_all[word], t_all[word]), n)
            # an end only takes back that the word is a first word there
            part = np.where(ends == 1, -as_first, part + as_first)
        owner = owner[order]
        whose.append(owner)
        values.append(part)
    owner, part = np.concatenate(whose), np.concatenate(values)
    some, where = np.unique(owner, return_inverse=True)
    total = np.bincount(where, weights=part).astype(np.float32)
    bounds = np.searchsorted(some, np.arange(len(names) + 1) * SLICE_DOCS)
    yield _record([(0, name, 3, total[a:b].tobytes(), b"", (some[a:b] % SLICE_DOCS).astype(np.uint16).tobytes())
                   for name, a, b in zip(names, bounds, bounds[1:]) if a < b])


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by slice, its documents first: their scores."""
    ids = known = counts = sums = None

    def scores() -> pa.RecordBatch:
        mean = np.divide(sums, counts, out=np.zeros(len(sums)), where=counts > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=~known), pa.array(counts.astype(np.int64)), pa.array(mean, mask=counts == 0)], names=["doc_id", "n_tokens", "score"])

    for batch in batches:
        for kind, keys, more, docs in zip(*(batch.column(c).to_pylist() for c in ("kind", "keys", "more", "docs"))):
            if kind == 0:
                if ids is not None:
                    yield scores()
                ids, known = np.frombuffer(keys, np.int64), np.frombuffer(docs, bool)
                both = np.frombuffer(more, np.float64)
                sums, counts = both[: len(ids)].copy(), both[len(ids) :]
            else:
                np.add.at(sums, np.frombuffer(docs, np.uint16), np.frombuffer(keys, np.float32))
    if ids is not None:
        yield scores()


def score_documents(
    docs: DataFrame, target_ids: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: int | None = None, prior: float = PRIOR,
    hot: int = HOT, hot_words: int = HOT_WORDS,
) -> DataFrame:
    """doc_id, n_tokens, score of every row; target_ids has the ids of the target rows in its column of the same name."""
    narrow_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chosen = target_ids.select(F.col(doc_id).cast("long").alias("doc_id")).filter("doc_id is not null").distinct().withColumn("target", F.lit(True))
    marked = rows.join(small(stored(chosen, "target")), "doc_id", "left").select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    model = learn(marked, vocabulary, prior, hot, hot_words)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    buckets = model.total // BUCKET + 1
    sent = marked.mapInArrow(lambda b: _send(b, shared.value, buckets), PACKED)
    # a bucket is a task's, so its rows lie together once they are sorted
    sent = sent.repartition(buckets, "to").sortWithinPartitions("to") if buckets > 1 else sent.coalesce(1)
    answers = sent.mapInArrow(lambda b: _answer(b, shared.value), PACKED)
    gathered = answers.repartition("slice").sortWithinPartitions("slice", "kind")
    return gathered.mapInArrow(_score, "doc_id long, n_tokens long, score double")
