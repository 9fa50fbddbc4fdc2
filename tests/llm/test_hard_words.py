"""Words and ids that meet where hashes or sums are weak, long texts, several scripts."""

import math
import random
import time
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tillwatch.llm import html, jaccard, language, licenses, substrings, words


def doubling(a, b, n):
    """Two sequences that agree in every sum of powers below the n-th."""
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def hashes(text, family=0):
    raw = text.encode()
    return words.Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), "space").hashes(family).tolist()


def test_patterns_do_not_cancel_out():
    for n in range(1, 13):
        one, two = doubling("a", "b", n)
        assert hashes(one) != hashes(two) and hashes(one, 1) != hashes(two, 1)
        codes = [np.array(hashes(" ".join(t)), np.uint64) for t in doubling("a", "b", n)]
        ends = np.array([len(codes[0])])
        for family in (0, 1):
            assert words.spans_hash(codes[0], ends * 0, ends, family) != words.spans_hash(codes[1], ends * 0, ends, family)
    rnd = random.Random(1)
    some = {"".join(rnd.choice("ab") for _ in range(rnd.choice([1, 7, 8, 9, 16, 17, 63, 64, 65, 200]))) for _ in range(3_000)}
    assert len({h for w in some for h in hashes(w)}) == len(some)
    text = " ".join(some)
    assert hashes(text) == [h for w in text.split(" ") for h in hashes(w)]


def test_spans_are_the_same_wherever_they_stand():
    values = np.random.default_rng(1).integers(0, 2**64, 5_000, dtype=np.uint64, endpoint=False)
    moved = np.concatenate([values[:700], values])
    a, b = np.array([0, 10, 4_000]), np.array([5_000, 11, 4_999])
    assert (words.spans_hash(values, a, b) == words.spans_hash(moved, a + 700, b + 700)).all()


def test_documents_of_colliding_words(make):
    one, two = doubling("a", "b", 10)
    around = [f"w{k}" for k in range(30)]
    texts = {1: " ".join(around[:10] + [one] + around[10:19]), 2: " ".join(around[:10] + [two] + around[10:19])}
    got = {r["doc_id"]: r["n_removed"] for r in substrings.dedup_substrings(make(texts.items())).collect()}
    assert got == {1: 0, 2: 0}
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_documents(make([(1, one), (2, two)])).collect()}
    assert got == {1: 1, 2: 2}
    many = doubling(["a"], ["b"], 11)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_documents(make([(1, " ".join(many[0])), (2, " ".join(many[1]))])).collect()}
    want = brute.components({1: " ".join(many[0]), 2: " ".join(many[1])})
    assert got == {d: c for d, (_, c) in want.items()}


def test_largest_ids(make):
    base = [f"word{k}" for k in range(300)]
    texts = {}
    for n in range(9):
        own = list(base)
        own[n * 20] = f"other{n}"
        texts[(2**63 - 1 - n) if n % 2 else -(2**63) + n] = " ".join(own)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_documents(make(texts.items())).collect()}
    assert got == brute.components(texts)


def test_a_long_text_of_license_phrases_is_one_pass():
    text = b" " + b"mit license " * 200_000
    scanner = licenses.Scanner()
    began = time.time()
    found = scanner.exact(text)
    assert len(found) == 200_000 and found[:3] == [(0, "mit"), (2, "mit"), (4, "mit")] and time.time() - began < 10
    small = b" " + b"mit license apache licence " * 50
    for phrase, label, first, last, text in [("x", *row[:3], small) for row in scanner.fuzzy(small)[:20]]:
        assert text.split()[first:last]


def test_license_word_numbers_equal_plain_counts():
    text = b" a bb  c d "
    places = [0, 1, 3, 5, 6, 10, 11]
    assert licenses.word_numbers(text, places) == [text.count(b" ", 0, p) for p in places]


def gram_ranks(texts, size):
    """The most frequent n-grams of bytes within words: one, two (one blank at the ends), three."""
    counts = {}
    for text in texts:
        letters = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode())
        for word in letters.split():
            padded = b" " + word + b" "
            found = [word[k : k + 1] for k in range(len(word))] + [padded[k : k + 2] for k in range(len(padded) - 1)]
            found += [padded[k : k + 3] for k in range(len(padded) - 2)]
            for g in found:
                counts[g] = counts.get(g, 0) + 1
    # ties as the operator orders them: by the gram's code
    def code(g):
        g = bytes(0 if b == 32 else b for b in g)
        return (1 << 25 | g[0]) if len(g) == 1 else (1 << 24 | g[0] << 8 | g[1]) if len(g) == 2 else (g[0] << 16 | g[1] << 8 | g[2])
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:size]]


def test_predictions_equal_the_plain_version_in_every_script(spark):
    rnd = random.Random(4)
    alphabets = {"en": "etaoinshr", "ru": "оеаинтсрв", "el": "αετιονρλκ", "th": "กขคงจฉชซ", "zh": "的一是不了人我在", "hi": "अआइकखगघच"}

    def text(lang):
        letters = alphabets[lang]
        made = ["".join(rnd.choice(letters[: rnd.choice([3, 6, 9])]) for _ in range(rnd.randrange(1, 7))) for _ in range(rnd.randrange(1, 60))]
        return " ".join(w.upper() if rnd.random() < 0.3 else w for w in made)

    rows = [(k, text(lang), lang) for k, lang in enumerate(list(alphabets) * 12)]
    tests = [(1_000 + k, text(lang), lang) for k, lang in enumerate(list(alphabets) * 10)] + [(2_000, "123 ...", None), (2_001, None, None), (2_002, "Ж", None)]
    size = 40
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.predict_language(spark.createDataFrame(tests, "doc_id long, text string, lang string"), language.learn_profiles(train, size=size), size=size)
    got = {r["doc_id"]: (r["lang_pred"], round(r["score"], 9)) for r in found.collect()}
    profiles = {lang: {g: k for k, g in enumerate(gram_ranks([t for _, t, x in rows if x == lang], size))} for lang in alphabets}
    want = {}
    for d, t, _ in tests:
        if not t or not any(c.isalpha() for c in t):
            want[d] = ("und", 0.0)
            continue
        own = gram_ranks([t], size)
        away = sorted((sum(abs(p[g] - k) if g in p else size for k, g in enumerate(own)), lang) for lang, p in profiles.items())
        want[d] = (away[0][1], round((away[1][0] - away[0][0]) / away[1][0] if away[1][0] else 0.0, 9))
    assert got == want
    right = [got[d][0] == lang for d, _, lang in tests if lang]
    assert sum(right) > 0.9 * len(right)


def test_capitals_of_any_script_are_small_letters():
    for lower, upper in (("жизнь", "ЖИЗНЬ"), ("αβγ", "ΑΒΓ"), ("été", "ÉTÉ")):
        a, b = (language.top_grams(language.grams(*next(words.slices(language.pc.utf8_lower(pa.array([t]))))[2:])[0], 99).tolist() for t in (lower, upper))
        assert a == b


def recipes(n, other=0):
    pages = [(k, f"http://cook.example/{k}", f"<html><body><h1>Dish {k}</h1><h2>Ingredients</h2><p>{k} eggs and a long list of other things {k * 7}</p></body></html>") for k in range(n)]
    return pages + [(n + k, f"http://cook.example/a{k}", f"<html><body><main><h2>Ingredients</h2><p>About page {k} has some more text of its own</p></main></body></html>") for k in range(other)]


def test_headings_stay_whatever_the_number_of_pages(spark):
    for n in (2, 9, 10, 300):
        pages = spark.createDataFrame(recipes(n), "page_id long, url string, html string")
        got = {r["page_id"]: r["text"] for r in html.extract_pages(pages).collect()}
        assert got == {k: f"Dish {k}\nIngredients\n{k} eggs and a long list of other things {k * 7}" for k in range(n)}


def test_a_text_of_all_templates_goes_and_a_heading_of_one_stays(spark):
    notice = "<div class='x'>We moved to a new address this spring</div>"
    pages = [(k, f"http://h.example/{k}", f"<html><body>{notice}<div class='post'><h2>Summary</h2><p>Post {k} with a rather long text of its own {k * 3}</p></div></body></html>") for k in range(8)]
    pages += [(100 + k, f"http://h.example/i{k}", f"<html><body>{notice}<div class='item'><h2>Details</h2><p>Item {k} with a rather long text of its own {k * 5}</p></div></body></html>") for k in range(8)]
    got = {r["page_id"]: r["text"] for r in html.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[3] == "Summary\nPost 3 with a rather long text of its own 9" and got[102] == "Details\nItem 2 with a rather long text of its own 10"


def test_classes_are_those_of_whole_occurrence_vectors(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", F.lit("http://one.example/").alias("url"), "html")
    vectors = html.token_vectors(html.page_walks(pages))
    got = defaultdict(set)
    for r in html.equivalence_classes(vectors).collect():
        got[r["class"]].add(r["token"])
    counts, elements, n = defaultdict(Counter), set(), 0
    for n, r in enumerate(pages.collect(), 1):
        tokens, _, kinds, *_ = html.Page(r["html"]).walk()
        elements |= {t for t, kind in zip(tokens, kinds) if kind >= 0}
        for t in tokens:
            counts[t][r["page_id"]] += 1
    support = max(2, math.ceil(html.SUPPORT * max(len(counts[t]) for t in elements)))
    want = defaultdict(set)
    for t, c in counts.items():
        if len(c) >= support:
            want[frozenset(c.items())].add(t)
    assert n and {frozenset(v) for v in got.values()} == {frozenset(v) for v in want.values()}
    assert any(len(v) > 1 for v in got.values())


def test_tokens_of_a_class_are_ordered_and_told_apart_by_their_gap():
    # html body hr div, and two other divs in gaps of their class
    html_, body, hr, div, p = 2, 4, 6, 8, 10
    classes = {html_: (1, 1), body: (1, 2), hr: (1, 3), div: (5, 1), p: (7, 1)}
    tokens, parents = [html_, body, div, p, hr, div, p], [-1, 0, 1, 2, 1, 1, 5]
    new, nests = html.refine(tokens, parents, classes)
    assert [new[k] for k in (0, 1, 4)] == [html_, body, hr] and len({new[2], new[5]}) == 2 and len({new[3], new[6]}) == 2
    assert nests[0] == nests[1] == nests[4] and nests[2] != nests[5]
    assert html.disordered(tokens, parents, classes) == set()
    # nav and article of one class change places; a list repeats as a whole in two gaps
    classes = {html_: (1, 1), body: (1, 2), 12: (1, 3), 14: (1, 4), 20: (9, 1), 22: (9, 2)}
    assert html.disordered([html_, body, 14, 12], [-1, 0, 1, 1], classes) == {12, 14}
    assert html.disordered([html_, body, 12, 20, 22, 20, 22, 14], [-1, 0, 1, 2, 3, 2, 5, 1], classes) == set()
    assert html.disordered([html_, body, 12, 22, 20, 22, 20, 14], [-1, 0, 1, 2, 2, 2, 2, 1], classes) == {20, 22}


def random_pages(rnd, hosts):
    """Pages of random templates, whose parts are missing, repeated, in another order or not closed on some pages."""

    def node(depth):
        kids = [node(depth - 1) for _ in range(rnd.randrange(4))] if depth else []
        return rnd.choice(["div", "div", "p", "ul", "h2", "b", "hr", "article"]), rnd.random() < 0.3 and f"fixed {rnd.randrange(9)}", rnd.random(), kids, rnd.random() < 0.3

    def show(tag, fixed, some, kids, mixed):
        if some < 0.15 and rnd.random() < 0.5:
            return ""
        inner = [show(*one) for one in kids for _ in range(rnd.randrange(1, 4) if some > 0.85 else 1)]
        if mixed and rnd.random() < 0.3:
            rnd.shuffle(inner)
        return f"<{tag}>{fixed or rnd.random()}{''.join(inner)}" + (f"</{tag}>" if rnd.random() < 0.95 else "")

    for h in range(hosts):
        template = [node(3) for _ in range(4)]
        for k in range(rnd.choice([1, 3, 20])):
            yield 1000 * h + k, f"http://{h}.example/", "<html><body>" + "".join(show(*one) for one in template) + "</body></html>"


def test_last_classes_have_one_vector_one_order_and_one_gap(spark):
    pages = list(random_pages(random.Random(3), 12))
    found, rounds, _ = html.page_classes(spark.createDataFrame(pages, "page_id long, url string, html string"))
    told = [{r["host"]: dict(zip(r["classes"][::4], zip(*(r["classes"][k::4] for k in (1, 2, 3))))) for r in one.collect()} for one in rounds]
    last, vectors, nests = defaultdict(dict), defaultdict(Counter), defaultdict(set)
    for r in found[-1].collect():
        last[r["host"]][r["token"]] = (r["class"], r["rank"], r["pages"])
    for d, url, source in pages:
        host = url.split("/")[2]
        tokens, parents, *_ = html.Page(source).walk()
        for one in told:
            tokens = html.refine(tokens, parents, one.get(host, {}))[0]
        assert html.disordered(tokens, parents, last[host]) == set()
        for t, nest in zip(tokens, html.nesting(tokens, parents, last[host])[1]):
            if t in last[host]:
                vectors[host, t][d] += 1
                nests[host, last[host][t][0]].add(nest)
    assert all(len(v) == 1 for v in nests.values()) and len(rounds) > 1 and found[-1].filter("alone > 0").count()
    of_class = defaultdict(set)
    for (host, t), v in vectors.items():
        of_class[host, last[host][t][0]].add(frozenset(v.items()))
    assert sum(map(len, last.values())) == len(vectors) and all(len(v) == 1 for v in of_class.values())


def test_containers_of_one_path_are_told_apart_by_the_template(spark, monkeypatch):
    def page(k, rule):
        return f"<html><body><div><a>Home</a> <a>All pages</a></div>{rule}<div><h2>Summary</h2><p>Story {k} with a rather long text of its own {k}</p><div>Part {k}</div></div><div>Our address</div></body></html>"

    pages = [(100 * n + k, f"http://{n}.example/{k}", page(k, rule)) for n, rule in enumerate(("<hr>", "")) for k in range(6)]
    # the boxes around the story change places on one page: it is still found
    pages += [(200 + k, f"http://swapped.example/{k}", f"<html><body><div class='{'ab'[k == 3]}'>One box</div><div class='text'><p>Story {k} with a rather long text of its own</p></div><div class='{'ba'[k == 3]}'>Two boxes</div></body></html>") for k in range(6)]
    # the rule stands before the story on one page only, and there is a page without a story
    body = "<html><body><div>Home and all pages</div>{}</body></html>"
    pages += [(300 + k, f"http://moved.example/{k}", body.format(("<hr>{}" if k == 2 else "{}<hr>").format(f"<div class='text'><p>Story {k} with a rather long text of its own</p></div>"))) for k in range(6)]
    pages += [(310, "http://moved.example/none", body.format("<p>None here</p><hr>"))]
    # two parts of a story, or two stories, are told apart and both stay
    parts = "<html><body><{0}><h2>Intro</h2><p>Short {1}</p></{0}><hr><{0}><h2>Details</h2><p>Story {1} with a rather long text of its own</p></{0}></body></html>"
    pages += [(400 + 100 * n + k, f"http://{tag}.example/{k}", parts.format(tag, k)) for n, tag in enumerate(("div", "article")) for k in range(6)]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract_pages(rows).collect()}
    for k in range(6):
        assert got[400 + k] == got[500 + k] == f"Intro\nShort {k}\nDetails\nStory {k} with a rather long text of its own"
        assert got[100 + k] == f"Summary\nStory {k} with a rather long text of its own {k}\nPart {k}"
        assert got[k] == got[100 + k] and got[200 + k] == got[300 + k] == f"Story {k} with a rather long text of its own"
    monkeypatch.setattr(html, "BROADCAST_ROWS", 0)  # hosts are joined by a shuffle
    assert got == {r["page_id"]: r["text"] for r in html.extract_pages(rows).collect()}


def test_a_text_above_a_slice_goes_through_every_operator(make, spark):
    rnd = random.Random(5)
    long = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(60_000))
    assert len(long) > 1.4 * words.SLICE
    docs = make([(1, "short text of a few words"), (2, long), (3, long + " and a tail")])
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substrings.dedup_substrings(docs).collect()}
    assert got == {1: (6, 0), 2: (60_000, 0), 3: (60_003, 60_000)}
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_documents(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 2}
