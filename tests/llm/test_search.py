"""Decontamination, substring dedup, the Jaccard join, licenses: against brute force and in edge cases."""

import random
import re

import brute
import pytest

from tillwatch.llm import decontaminate, jaccard, licenses, substrings
from tillwatch.llm.automaton import SuffixAutomaton
from tillwatch.llm.components import components

EDGE = [(90, None), (91, ""), (92, " \n"), (93, "one"), (94, "a b c d"), (95, "A b C d"), (96, "word " * 3000), (None, "a b c d")]


def family(seed=3, n=160):
    """Near copies around the threshold, a passage in many texts, copies, short texts."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = [rnd.choice(words) for _ in range(50)]
    base = [f"b{j}" for j in range(140)]
    out = {}
    for i in range(n):
        r = rnd.random()
        if r < 0.3 and out:
            w = rnd.choice(list(out.values())).split()
            for _ in range(max(1, int(len(w) * rnd.choice([0.01, 0.03, 0.05])))):
                if w:
                    w[rnd.randrange(len(w))] = rnd.choice(words)
        elif r < 0.6:
            w = list(base)
            for _ in range(rnd.randrange(8)):
                w[rnd.randrange(140)] = rnd.choice(words)
        elif r < 0.85:
            w = [rnd.choice(words) for _ in range(rnd.randrange(5, 120))] + passage
        else:
            w = [rnd.choice(words) for _ in range(rnd.randrange(30))]
        out[i] = " ".join(w)
    return out


def test_matching_statistics():
    rnd = random.Random(1)
    for _ in range(60):
        known = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 12))) for _ in range(4)]
        sam = SuffixAutomaton()
        for s in known:
            sam.add(s)
        text = "".join(rnd.choice("abc") for _ in range(25))
        got = [n for _, n in sam.stream(text)]
        assert got == [max(k for k in range(e + 2) if any(text[e + 1 - k : e + 1] in s for s in known)) for e in range(25)]


def test_components(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(100, 102), (102, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components(links.limit(0)).count() == 0


def test_jaccard_join(make):
    texts = family() | dict(EDGE[:-1])
    rows = jaccard.similar_documents(make([*texts.items(), EDGE[-1], (93, "one")])).collect()
    assert len(rows) == len(texts) + 2
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None} == brute.components(texts)
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert jaccard.similar_documents(make([])).count() == 0


@pytest.mark.parametrize("options", [{}, {"shard_segments": 1}, {"held": 0}])
def test_substrings(make, options):
    texts = family(5, 80) | dict(EDGE[:-1])
    rows = substrings.dedup_substrings(make([*texts.items(), EDGE[-1]]), **options).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in rows if r["doc_id"] is not None}
    assert got == {d: (len(w), sum(g), " ".join(x for x, y in zip(w, g) if not y)) for d, (w, g) in brute.repeated(texts).items()}
    assert [r["kept"] for r in rows if r["doc_id"] is None] == ["a b c d"]


def test_substrings_of_nothing(make):
    assert substrings.dedup_substrings(make([])).count() == 0


@pytest.mark.parametrize("block_words", [10**6, 12])
def test_contamination(make, spark, block_words):
    items = {1: "The quick brown fox jumps over the lazy dog and runs far away", 2: "tiny item", 3: None, 4: "...", 5: "TINY item"}
    texts = dict(EDGE[:-1]) | {1: "x quick brown fox jumps over the lazy dog and runs, far y", 2: "a Tiny ITEM b tiny", 3: "quick brown fox jumps over the lazy dog and"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontaminate.contamination(make([*texts.items(), (2, texts[2])]), bench, block_words=block_words)
    rows = found.withColumn("n_hit", decontaminate.hit_words()).collect()
    assert len(rows) == len(texts) + 1
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows} == {d: (n, len(h), i) for d, (n, h, i) in brute.contaminated(texts, items).items()}
    assert decontaminate.contamination(make([]), bench).count() == 0
    assert decontaminate.contamination(make(texts.items()), bench.limit(0)).filter("size(items) > 0").count() == 0


def test_licenses(make):
    texts = dict(EDGE) | {1: "MIT License and the GNU General-Public License, mit license", 2: "under the Apach License, Version", 3: "cc, by cc by by", 4: "licensed undr the apache lisense"}
    got = {r["doc_id"]: r for r in licenses.license_report(make(texts.items())).collect()}
    for d, text in texts.items():
        w = brute.LETTERS.findall(brute.lower(text))
        places = sorted((k, label) for p, label in licenses.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        r = got[d]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None)
        assert r["base_labels"] == ",".join(sorted({label for _, label in places})) and 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
    assert got[4]["labels"] == "apache" and got[4]["base_labels"] == "" and got[90]["score"] == 0
    assert licenses.license_report(make([])).count() == 0


def test_misspelt_short_notices(make):
    texts = {1: "Apache Licence 2.0", 2: "under the Apach License, Version", 3: "MIT Licence", 4: "the mit licens of it", 5: "CC BY 4.0", 6: "we permit licensees", 7: "cc bz", 8: "a licensed driver", 9: "licensed under the Apache Licence"}
    got = {r["doc_id"]: r for r in licenses.license_report(make(texts.items())).collect()}
    want = {1: "apache", 2: "apache", 3: "mit", 4: "mit", 5: "cc-by", 6: "", 7: "", 8: "", 9: "apache"}
    assert {d: r["labels"] for d, r in got.items()} == want
    assert all(got[d]["score"] == 0.5 and got[d]["base_labels"] == "" for d in (1, 2, 3, 4)) and got[5]["score"] == 1 and len(got[9]["fuzzy"]) == 1


def test_fuzzy_notices_find_every_small_edit():
    rnd, scanner, phrase = random.Random(2), licenses.Scanner(), "mozilla public license"
    for _ in range(200):
        p, k = rnd.randrange(len(phrase)), rnd.randrange(3)
        edited = phrase[:p] + ("" if k == 0 else "x") + phrase[p + (k < 2) :]
        edited = re.sub(" +", " ", edited).strip()
        assert "mpl" in {r[0] for r in scanner.fuzzy(f" some {edited} here ".encode())}, edited


def test_stored_tables_go_when_nobody_reads_them(make, tmp_path, monkeypatch):
    import os

    from tillwatch.llm import shared

    monkeypatch.setattr(shared, "shared_folder", lambda _: str(tmp_path))
    base = [f"w{k}" for k in range(60)]
    docs = make([(n, " ".join(base[: 30 + n])) for n in range(30)])
    groups = jaccard.similar_documents(docs)
    assert {r["component_id"] for r in groups.collect()} == {0}
    assert len(os.listdir(tmp_path)) == 2
    assert substrings.dedup_substrings(docs).count() == 30 and len(os.listdir(tmp_path)) == 3
