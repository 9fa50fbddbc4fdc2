"""The pipeline against plain versions of its stages, and the queries against their SQL."""

import brute
import oracle_compare as oc
import pytest

import corpus_pipeline
from tillwatch.llm import bpe, queries


def cut(text, spans, words):
    """text without these runs of words and what stands between them."""
    places = list(words.finditer(brute.lower(text)))
    out, at = [], 0
    for first, last in spans:
        out.append(text[at : places[first].start()])
        at = places[last - 1].end()
    return "".join([*out, text[at:]])


def runs(flags):
    edges = [k for k in range(len(flags) + 1) if (flags[k] if k < len(flags) else False) != (flags[k - 1] if k else False)]
    return list(zip(edges[::2], edges[1::2]))


def test_run(spark, tmp_path):
    passage = " ".join(f"p{k}" for k in range(60))
    item = " ".join(f"item{k}" for k in range(12))
    base = " ".join(f"b{k}" for k in range(200))
    texts = {
        0: "plain clean text\nof two lines", 1: None, 2: "", 3: "123 456 !!", 4: base, 5: base.replace("b7 ", "x "), 6: f"start {passage} end",
        7: f"other\n\n{passage}\nlast words", 8: passage, 9: f"before {item} after these words are clean and stay where they are", 10: item, 11: base,
    }
    rows = [(d, t, "en" if d % 2 else None, "s", len(t or "")) for d, t in texts.items()] + [(0, texts[0], None, "s", 30)]
    rows[0] = (0, texts[0], "en", "s", 30)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    kept = {d: t for d, t in texts.items() if t and any(c.isalpha() for c in t)}
    kept = {d: t for d, t in kept.items() if brute.components(kept)[d][1] == d}
    flags = brute.repeated(kept)
    kept = {d: cut(t, runs(flags[d][1]), brute.SPACE) for d, t in kept.items() if not all(flags[d][1])}
    hits = brute.contaminated(kept, {1: item})
    kept = {d: cut(t, runs([k in hits[d][1] for k in range(hits[d][0])]), brute.LETTERS) for d, t in kept.items() if 2 * len(hits[d][1]) <= hits[d][0]}
    assert {d: r["text"] for d, r in got.items()} == kept
    encoder = bpe.Bpe(queries.tokenizer_path())
    assert all(r["ids"] == encoder.encode(kept[d]).tolist() and r["n_tokens"] == len(r["ids"]) for d, r in got.items())
    assert got[0]["text"] == texts[0] and 5 not in got and 8 not in got and 10 not in got


def test_of_rows_that_repeat_an_id_the_same_one_stays_every_time(spark, tmp_path):
    import hashlib

    texts = ["one text of some words", "quite another text", "a third one", "a third one"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, digest string, id int"
    rows = [(7, t, "en", f"s{k}", 1, "x", 2) for k, t in enumerate(texts)] + [(None, "no id here", None, None, None, "x", 2)] * 2
    least = min(texts, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    for order in (rows, rows[::-1]):
        found = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(order, schema).repartition(3), "")
        assert found.columns == corpus_pipeline.COLUMNS
        got = found.collect()
        assert [r["text"] for r in got if r["doc_id"] == 7] == [least] and sum(r["doc_id"] is None for r in got) == 2


def test_stages_of_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql(spark, sf, name):
    con = oc.connect(sf)
    assert oc.spark_rows(queries.QUERIES[name](spark, sf)) == oc.duck_rows(con, queries.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_whole_table(spark, sf, name):
    rows = spark.read.parquet(f"{sf}/{'pages' if name.startswith('op7_') else 'documents'}.parquet").count()
    assert queries.QUERIES[name](spark, sf).count() == rows
