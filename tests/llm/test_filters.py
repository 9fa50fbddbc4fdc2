"""Filter audit: galloping merges, id ranges and sizes against sets."""

import itertools
import random
from collections import defaultdict

import brute
import numpy as np
import pytest

from tillwatch.llm import filter_audit


def plain(docs, labels):
    """(part, order, step) -> kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley; docs are (id, part, text)."""
    first = {}
    for d, _, t in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    parts = defaultdict(list)
    for d, p, t in docs:
        t = t or ""
        w = brute.SPACE.findall(t)
        fails = {
            k for k, x in zip("ABCDE", (
                len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                any(c in "#$%&*|" for c in t), d is not None and first[t] < d)) if x
        }
        parts[p or ""].append((fails, any(q == 1 for i, q, _ in labels if i == d is not None), any(x == 1 for i, _, x in labels if i == d is not None)))
    out, shapley = {}, defaultdict(int)
    for p, rows in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = list(rows)
            for step, f in enumerate(order):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                fails = [r for r in rows if f in r[0]]
                shapley[p, f] += len(gone)
                out[p, "".join(order), step + 1] = [
                    len(left), len(gone), len(fails) - len(gone), sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(found):
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {tuple(r[:3]): tuple(r[3:]) for r in found.collect()}


def frames(spark, docs, labels):
    rows = [(d, p, t, "x", "y", 1) for d, p, t in docs]
    return (spark.createDataFrame(rows, "doc_id long, source string, text string, part string, digest string, good int"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_merges_equal_sets():
    rnd = random.Random(1)
    for _ in range(500):
        n = rnd.choice([1, 3, 20, 400])
        lists = [sorted(rnd.sample(range(n), rnd.randrange(n + 1))) for _ in range(rnd.randrange(6))]
        assert filter_audit.union(lists) == sorted(set().union(*lists))
        a, b = sorted(rnd.sample(range(n), rnd.randrange(n + 1))), sorted(rnd.sample(range(n), rnd.randrange(n + 1)))
        assert filter_audit.difference(a, b) == sorted(set(a) - set(b))
        at, bound = rnd.randrange(len(a) + 1), rnd.randrange(-1, n + 2)
        assert filter_audit.gallop(a, at, bound) == max(at, sum(x < bound for x in a))


def test_sizes_of_ranges_add_up():
    rng = np.random.default_rng(2)
    fails, good, toxic = rng.integers(0, 32, 999), rng.random(999) < 0.5, rng.random(999) < 0.1
    whole = filter_audit.range_sizes(fails, good, toxic)
    parts = [filter_audit.range_sizes(fails[k : k + 100], good[k : k + 100], toxic[k : k + 100]) for k in range(0, 999, 100)]
    assert (whole == sum(parts)).all()


@pytest.mark.parametrize("limit", [7, 65_536])
def test_against_sets(spark, limit):
    rnd = random.Random(3)
    words = ["alpha", "BETA", "c#", "d", "é", "日本", "E", "f|g"]
    texts = [" ".join(rnd.choice(words + [f"w{k}" for k in range(rnd.choice([1, 60, 300]))]) for _ in range(rnd.choice([3, 49, 50, 51, 120]))) for _ in range(60)]
    texts += [None, "", " \t\n", "X" * 20 + "a" * 380, "A" + "b" * 19, "word " * 100_000, "vertical\x0bform\x0cfeed" * 30, "no break " * 60]
    docs = [(k, rnd.choice([None, "", "hot", "hot", "hot", "cold"]), rnd.choice(texts)) for k in range(300)]
    docs += [(None, "hot", texts[0]), (None, None, None), (5, docs[5][1], docs[5][2]), (5, "other", "another text under the id of five"), (2**62, "big", texts[1]), (-(2**62), "big", texts[1])]
    labels = [(k, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for k in range(0, 300, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1), (9_999, 1, 1)]
    frame, said = frames(spark, docs, labels)
    found = filter_audit.audit_orders(filter_audit.filter_sizes(frame, said, limit=limit))
    assert audited(found) == plain(docs, labels)


def test_empty_tables(spark):
    frame, said = frames(spark, [], [])
    assert audited(filter_audit.audit_filters(frame, said)) == {}
    frame, said = frames(spark, [(1, None, None)], [])
    assert audited(filter_audit.audit_filters(frame, said)) == plain([(1, None, None)], [])
