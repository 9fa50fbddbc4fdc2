"""BPE, language, fingerprints, HTML, LM scores, shards: exact round trips, brute force and edge cases."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwatch.llm import bpe, html, language, lm_score, queries, sharding, simhash

EDGE = [(None, "a b"), (1, None), (2, ""), (3, "12 34 ..."), (4, "x"), (5, "word " * 3000)]


def test_bpe_equals_the_library(make):
    path = queries.tokenizer_path()
    library, own = Tokenizer.from_file(path), bpe.Bpe(path, leaf=64)
    rnd = random.Random(4)
    parts = ["a", "the", "ing", " ", "'s", "'", "!", "  ", "\n", "7", "é", "日本", "😀", "x" * 90, "'ll", "-", "‍", "<|endoftext|>", " "]
    for _ in range(1500):
        pool = rnd.sample(parts, rnd.randrange(1, 7))
        text = "".join(rnd.choice(pool) for _ in range(rnd.randrange(200)))
        ids = own.encode(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert own.decode(ids).decode() == library.decode(ids, skip_special_tokens=False) == text
    got = {r["doc_id"]: r for r in bpe.encode_documents(make(EDGE), path).collect()}
    assert all(r["decoded"] == (dict(EDGE)[d] or "") and len(r["ids"]) == r["n_tokens"] for d, r in got.items())
    assert bpe.encode_documents(make([]), path).count() == 0


def test_bpe_parts_of_a_long_text_are_one_batch():
    path = queries.tokenizer_path()
    library, own, batches = Tokenizer.from_file(path), bpe.Bpe(path, leaf=64), []

    class Counted:
        def __init__(self, inner, name):
            self.inner, self.name = inner, name

        def __getattr__(self, name):
            def call(*a, **k):
                if name == self.name:
                    batches.append(len(a[0]))
                return getattr(self.inner, name)(*a, **k)

            return call

    own.fast = own.fast and Counted(own.fast, "encode_ordinary_batch")
    own.tokenizer = Counted(own.tokenizer, "encode_batch")
    text = "the long text goes on 'n on " * 60 + "日本 ends it " * 60
    assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(batches) <= 2 and sum(batches) == len(own.cuts(text.encode())) - 1 > 20


def test_language_held_out_accuracy(spark, sf):
    found = queries.language_query(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rates = {r["held_out"]: r["rate"] for r in found.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("rate")).collect()}
    assert rates[True] > 0.97


def test_language_edges(make, spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "fr"), ("x", None)], "text string, lang string")
    profiles = language.learn_profiles(train)
    counts = Counter()
    for word in "the cat and the dog".split():
        padded = f" {word} "
        counts.update(padded[k : k + 3] for k in range(len(word)))
        counts.update(padded[k : k + 2] for k in range(len(word) + 1))
        counts.update(word)
    assert profiles.filter("lang = 'en'").count() == len(counts)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict_language(make([*EDGE, (6, "the dog"), (7, "der und")]), profiles).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[6][0] == "en" and got[7][0] == "de"
    assert language.predict_language(make([(1, "abc")]), profiles.limit(0)).first()["lang_pred"] == "und"
    assert language.predict_language(make([]), profiles).count() == 0


def hamming(a, b):
    return bin((a ^ b) & (2**64 - 1)).count("1")


@pytest.mark.parametrize("range_rows", [50_000, 7])
def test_edited_fingerprints(make, range_rows):
    rnd = random.Random(3)
    texts = {i * 3: " ".join(rnd.choice(["é", "ab", "c", "😀", "dd"]) for _ in range(rnd.randrange(40))) for i in range(40)} | {500: None, 501: "x"}
    got = {r["doc_id"]: r for r in simhash.edited_fingerprints(make(texts.items()), range_rows=range_rows).collect()}
    order = sorted(texts, reverse=True)
    for k, d in enumerate(order):
        x, y = texts[d] or "", texts[order[(k + 1) % len(order)]] or ""
        cut = len(x) // 3
        edited = x[: len(x) - cut] + y[:cut]
        r, after = got[d], got[order[(k + 1) % len(order)]]
        assert r["n_chars"] == len(x) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_next"] == 1 - hamming(r["fingerprint"], after["fingerprint"]) / 64
    assert simhash.edited_fingerprints(make([])).count() == 0
    assert simhash.edited_fingerprints(make([(1, "a b"), (1, "a b"), (None, "c")])).count() == 3


def test_within_radius_finds_all(spark):
    rnd = random.Random(6)
    base = [rnd.getrandbits(64) for _ in range(30)]
    values = base + [b ^ sum(1 << i for i in rnd.sample(range(64), rnd.randrange(6))) for b in base for _ in range(5)]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed] + [(None,)], "fingerprint long")
    got = {(r[0], r[1]) for r in simhash.within_radius(prints, prints).collect()}
    assert got == {(a, b) for a in signed for b in signed if hamming(a, b) <= 3}


def test_html(spark):
    body = "<p>One &amp; two<p>three <b>bold</b>\n line</p><!-- no --><div class='share-box'>Share</div>"
    page = "<html><head><title>T</title><script>var a='<p>';</script></head><body><nav><a>Home</a></nav><header>H</header><article><h1>Title</h1>{}</article><aside>S</aside><form>f</form><section id='comments'>C</section><footer>F</footer></body></html>"
    rows = [(k, "http://a.example/x", page.format(body + f"<p>{k}</p>")) for k in range(5)]
    rows += [(10, None, None), (11, "", ""), (12, "http://b.example", "plain text"), (13, "http://c.example", page.format(body)[:150]), (14, "http://d.example", "<body><div>only &lt;b&gt;<br>here")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("slot", F.lit("x"))
    got = {r["page_id"]: r["text"] for r in html.extract_pages(pages).collect()}
    assert all(got[k] == f"Title\nOne & two\nthree bold line\n{k}" for k in range(5))
    assert got[10] == got[11] == "" and got[12] == "plain text" and got[14] == "only <b> here"
    assert html.extract_pages(pages.limit(0)).count() == 0


def test_html_marks_never_hide_the_main_text(spark):
    page = "<html{}><body{}><div{}><nav>N</nav><article{}><h1>Title</h1><p>Text {}</p><div class='{}'>Block</div><p><math><mi>x</mi></math></p></article></div><div class='sidebar'>S</div></body></html>"
    cases = [
        ("", " class='with-sidebar'", "", "", "plain"), (" class='has-cookie-banner'", "", "", "", "plain"), ("", " class='sidebar'", "", " class='post comments-open'", "plain"),
        ("", "", "", " class='post comments'", "related-work"), ("", "", " class='widget'", "", "search-results"),
    ]
    rows = [(10 * k + n, f"http://h{k}.example/{n}", page.format(*c[:4], n, c[4])) for k, c in enumerate(cases) for n in range(3)]
    rows += [(100, "http://i.example", "<body class='sidebar'><div class='widget'><div id='text'>All of the text</div></div><div class='promo'>ad</div></body>")]
    rows += [(101, "http://j.example", "<body><div class='promo'><article>One</article></div><div class='widget'><article>Two</article></div><div class='menu'><article>Six</article></div></body>")]
    got = {r["page_id"]: r["text"] for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[d] == f"Title\nText {d % 10}\nBlock\nx" for d in got if d < 100)
    assert got[100] == "All of the text" and got[101] == "One\nTwo\nSix"


def test_html_mixed_templates_and_unmarked_boilerplate(spark):
    box = "<html><body><div class='bar'>Our bar of links</div>{}<div class='end'>The end of it</div></body></html>"
    post = box.format("<article><h1>Title {0}</h1><p>Text number {0} of the host</p><p>Follow us</p><p>Follow us</p></article>")
    product = box.format("<div class='wrap'><div class='product'><p>Product {0} with its long description</p><p>Ships in a day</p></div></div>")
    rows = [(n, f"http://a.example/{n}", post.format(n)) for n in range(40)]
    rows += [(100 + n, f"http://a.example/p{n}", product.format(n)) for n in range(12)]
    rows += [(200, "http://a.example/404", box.format("Nothing is found at this place")), (201, "http://a.example/one", box.format("<article id='one'>A page of its own</article>"))]
    rows += [(300 + n, f"http://copies.example/{n}", post.format(7)) for n in range(20)]
    got = {r["page_id"]: r["text"] for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # the boxes around the slots go; what repeats inside an article or a product stays, as headings of recipes do
    assert all(got[n] == f"Title {n}\nText number {n} of the host\nFollow us\nFollow us" for n in range(40))
    assert all(got[100 + n] == f"Product {n} with its long description\nShips in a day" for n in range(12))
    assert "Nothing is found at this place" in got[200] and got[201] == "A page of its own"
    assert all(got[300 + n] == "Title 7\nText number 7 of the host\nFollow us\nFollow us" for n in range(20))


def test_html_paths_of_one_template_are_hashed_once(monkeypatch):
    hashed, plain = Counter(), html.hash_text
    monkeypatch.setattr(html, "hash_text", lambda text: hashed.update([text]) or plain(text))
    page = "<html><body><div class='hashed once'><h1>Title {0}</h1><a href='/{0}'>Go</a><p id='{1}'>Text {0}</p></div></body></html>"
    walks = [html.Page(page.format(k, "long" * (100 * (k % 2)))).walk() for k in range(40)]
    # the template's own steps once; a long id every time, so that no page fills the store
    assert all(n == 1 for text, n in hashed.items() if "/" in text and "longlong" not in text)
    assert sum(n for text, n in hashed.items() if "longlong" in text and "Text" not in text) == 20
    for at, steps in ((0, ["html "]), (2, ["html ", "body ", "div class=hashed once"]), (7, ["html ", "body ", "div class=hashed once", "p id=" + "long" * 100])):
        want = 0
        for step in steps:
            want = plain(f"{want}/{step}")
        assert {w[0][at] for w in walks[1::2]} == {want}


def test_html_a_block_of_many_lines_takes_as_long_as_many_blocks():
    def seconds(between):
        start = time.process_time()
        page = html.Page(f"<body><p>{between.join(['a line of text'] * 20_000)}</body>")
        blocks = page.walk()[0], page.extract([], [])
        return time.process_time() - start, blocks

    (many, _), (one, (_, text)) = seconds("<p>"), seconds("<br>")
    assert text == " ".join(["a line of text"] * 20_000) and one < 8 * many


def test_html_articles_of_the_table(spark, sf):
    import html as entities

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.html_query(spark, sf).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.S)[1]
        blocks = (re.sub(r"\s+", " ", entities.unescape(re.sub("<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", article.replace("<br>", " ")))
        assert r["text"] == "\n".join(filter(None, blocks)) and r["n_chars"] == len(r["text"])


def test_lm_scores(make, spark):
    rnd = random.Random(8)
    texts = {i: " ".join(rnd.choice(["alpha", "beta", "gamma", "Delta", f"r{rnd.randrange(50)}"]) for _ in range(rnd.randrange(30))) for i in range(60)} | {100: None}
    target = {i for i in texts if i % 3 == 0}
    ids = spark.createDataFrame([(i,) for i in target], "doc_id long")
    got = {r["doc_id"]: r for r in lm_score.score_documents(make(texts.items()), ids, vocabulary=4, prior=2.0).collect()}
    words = {d: brute.LETTERS.findall(brute.lower(t)) for d, t in texts.items()}
    vocabulary = {w for w, _ in Counter(w for ws in words.values() for w in ws).most_common(4)}
    coded = {d: [w if w in vocabulary else "?" for w in ws] for d, ws in words.items()}

    def model(docs):
        pairs = Counter((a, b) for d in docs for a, b in zip(["?", *coded[d]], coded[d]))
        single, first = Counter(), Counter()
        for (a, b), n in pairs.items():
            single[b] += n
            first[a] += n
        total = sum(single.values())
        return lambda a, b: (pairs[a, b] + 2 * (single[b] + 2 / 5) / (total + 2)) / (first[a] + 2)

    p, q = model([d for d in texts if d in target]), model(texts)
    for d, ws in coded.items():
        assert got[d]["n_tokens"] == len(ws)
        want = sum(math.log(q(a, b)) - math.log(p(a, b)) for a, b in zip(["?", *ws], ws)) / len(ws) if ws else None
        assert got[d]["score"] == (pytest.approx(want, abs=1e-5) if ws else None)
    assert lm_score.score_documents(make([]), ids).count() == 0


@pytest.mark.parametrize("hot", [0, 200, 500_000])
@pytest.mark.parametrize("hot_words", [0, 60, 1_000_000])
def test_lm_scores_know_every_word(make, spark, monkeypatch, hot, hot_words):
    monkeypatch.setattr(lm_score, "BUCKET", 900)
    rnd = random.Random(9)
    texts = {i: " ".join(rnd.choice(["the", "of", f"w{rnd.randrange(20_000)}"]) for _ in range(rnd.randrange(120))) for i in range(150)} | {900: None, 901: "Only12 once é"}
    rows = [*texts.items(), (3, texts[3]), (3, "another text"), (None, "the of")]
    ids = spark.createDataFrame([(i,) for i in texts if i % 2], "doc_id long")
    words = [(d, brute.LETTERS.findall(brute.lower(t))) for d, t in rows]
    size = len({w for _, ws in words for w in ws}) + 1
    assert size > 2048

    def model(chosen):
        pairs = Counter(p for ws in chosen for p in zip(["?", *ws], ws))
        single, first = Counter(), Counter()
        for (a, b), n in pairs.items():
            single[b] += n
            first[a] += n
        total = sum(single.values())
        return lambda a, b: (pairs[a, b] + 50 * (single[b] + 50 / size) / (total + 50)) / (first[a] + 50)

    p, q = model([ws for d, ws in words if d is not None and d % 2]), model([ws for _, ws in words])
    want = sorted((-1 if d is None else d, len(ws), sum(math.log(q(a, b)) - math.log(p(a, b)) for a, b in zip(["?", *ws], ws)) / len(ws) if ws else 0) for d, ws in words)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["score"] or 0) for r in lm_score.score_documents(make(rows), ids, hot=hot, hot_words=hot_words).collect())
    assert [x[:2] for x in got] == [x[:2] for x in want] and [x[2] for x in got] == pytest.approx([x[2] for x in want], abs=1e-5)


def test_sharding(make):
    table = sharding.lookup_table(["a", "b", "c"], 101)
    assert sorted(Counter(table).values()) == [33, 34, 34]
    fewer = sharding.lookup_table(["a", "b"], 101)
    assert sum(x != y for x, y in zip(table, fewer) if x < 2) < 34
    for wrong in (["a", "a"], []):
        with pytest.raises(ValueError):
            sharding.lookup_table(wrong, 101)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 100)
    rows = sharding.assign_shards(make([*EDGE, (4, "y")]).withColumn("shard", F.lit(1)), "doc_id", ["a", "b", "c"], 101).collect()
    assert len(rows) == 7 and all((r["shard"] is None) == (r["doc_id"] is None) for r in rows)
    assert len({r["shard"] for r in rows if r["doc_id"] == 4}) == 1
