"""Batch tables, the key index and arrival order."""

import time

import pytest
from pyspark.sql import functions as F

from tillwatch.operators import ingest
from tillwatch.sources.batches import BatchTable, Folder, joined_spans, to_merge
from tillwatch.sources.key_index import KeyIndex
from tillwatch.sources.messages import file_replay, file_stream, positioned, split_dead_letters
from tillwatch.streaming import sinks
from tillwatch.streaming.live import run_ingest


def line(tx, at, **more):
    import json
    return json.dumps({"tx_id": tx, "user_id": "u", "amount": 5, "merchant": "Tiki", "country": "VN", "tx_at": at, **more})


def messages(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def keys(spark, first, last):
    return spark.range(first, last).select(F.concat(F.lit("tx-"), F.col("id").cast("string")).alias("tx_id"))


def test_ten_thousand_batches_are_few_entries():
    entries, most = [], 0
    for n in range(10_000):
        entries.append({"name": str(n), "tier": 0, "spans": [["r", n, n]]})
        while some := to_merge(entries, 16):
            gone = {e["name"] for e in some}
            entries = [e for e in entries if e["name"] not in gone]
            entries.append({"name": f"m{n}", "tier": some[0]["tier"] + 1, "spans": joined_spans([s for e in some for s in e["spans"]])})
        most = max(most, len(entries))
    assert most <= 16 * 4 + 1
    assert joined_spans([s for e in entries for s in e["spans"]]) == [["r", 0, 9_999]]
    assert [e for e in entries if not e["tier"]][-1]["spans"] == [["r", 9_999, 9_999]]


def test_merged_batches_read_alike_and_a_retry_replaces_itself(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"), "n int, batch_id bigint", fan=3)
    assert table.read(spark).count() == 0 and table.read_batch(spark, "a", 0) is None
    for batch in range(8):
        for run in "ab":
            for attempt in (100, 0)[batch % 3 > 0:]:        # the second attempt counts
                table.write(spark.createDataFrame([(batch + attempt,)], "n int"), run, batch)
    got = sorted(table.read(spark, run=True).collect())
    assert got == sorted((b, b, r) for b in range(8) for r in "ab")
    assert any(e["tier"] == 2 for e in table.entries(spark)) and len(table.entries(spark)) <= 3 * 3 + 2
    assert [tuple(r) for r in table.read_batch(spark, "b", 1).collect()] == [(1, 1)]
    table.write(spark.createDataFrame([(55,)], "n int"), "a", 1)     # merged long ago: stays
    assert [tuple(r) for r in table.read_batch(spark, "a", 1).collect()] == [(1, 1)]
    for batch in range(8, 15):
        table.write(spark.createDataFrame([(batch,)], "n int"), "a", batch)
    folders = [n for n in Folder(spark, str(tmp_path / "t")).names() if not n.startswith("_")]
    assert len(table.entries(spark)) <= 3 * 4 + 2 and len(folders) < 25     # folders no longer named go


def test_a_write_that_fails_leaves_nothing(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"), "n int", fan=3)
    table.write(spark.createDataFrame([(1,)], "n int"), "a", 0)
    bad = spark.createDataFrame([(2,)], "n int").withColumn("n", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        table.write(bad, "a", 1)
    assert [r["n"] for r in table.read(spark).collect()] == [1]


def test_index_opens_only_what_may_hold_the_keys(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "k"), fan=4, part_keys=200)
    for batch in range(17):
        index.write(keys(spark, batch * 100, batch * 100 + 100), "r", batch, lambda rows: {"keys": rows.count()})
    merged = [e for e in index.entries(spark) if e["tier"]]
    assert [(e["tier"], e["parts"], e["stats"]["keys"]) for e in merged] == [(2, 8, 1_600)]
    recent = index.paths(spark, keys(spark, 10**6, 10**6))
    assert len(recent) == 1                                             # the newest batch
    opened = index.paths(spark, keys(spark, 10**6, 10**6 + 50))
    assert len(opened) <= len(recent) + 2                               # new keys: hardly a part
    assert len(index.paths(spark, keys(spark, 5, 6))) <= len(recent) + 1
    assert index.paths(spark, keys(spark, 0, 1), "r", 16) == [p for p in index.paths(spark, keys(spark, 0, 1)) if "merged" in p]
    absent = index.absent(keys(spark, 0, 2_000))
    assert sorted(int(r["tx_id"][3:]) for r in absent.collect()) == list(range(1_700, 2_000))
    assert index.absent(keys(spark, 1_600, 1_800), "r", 16).count() == 200
    nulls = spark.createDataFrame([(None,)], "tx_id string")
    assert index.absent(nulls).count() == 1


def test_ingest_reads_few_files_and_a_new_checkpoint_adds_nothing(spark, tmp_path, monkeypatch):
    sink = sinks.IngestSink(str(tmp_path), fan=3)
    sink.index.part_keys = 20
    day = "2024-05-01T12:00:00+00:00"
    batches = [messages(spark, [line(f"t{b * 10 + k}", day) for k in range(12)]) for b in range(7)]     # two of each come again
    for b, batch in enumerate(batches):
        sink(batch, b)
    assert sink.table(spark).count() == 72 == sink.table(spark).select("tx_id").distinct().count()
    new = messages(spark, [line("fresh", day)])
    good, _ = split_dead_letters(positioned(new))
    assert len(sink.index.paths(spark, good)) <= 3 + 1
    monkeypatch.setattr(sinks, "run_of", lambda _: "second")
    for b, batch in enumerate(batches):
        sink(batch, b)
    sink(new, len(batches))
    assert sink.table(spark).count() == 73


def test_keys_stored_but_not_indexed_are_found(spark, tmp_path, monkeypatch):
    sink = sinks.IngestSink(str(tmp_path), fan=3)
    one = messages(spark, [line("a", "2024-05-01T12:00:00+00:00")])
    with monkeypatch.context() as stopped:
        stopped.setattr(sink, "_index", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            sink(one, 0)
    monkeypatch.setattr(sinks, "run_of", lambda _: "second")
    sink(one, 0)
    assert sink.table(spark).count() == 1


def test_the_first_arrival_stays_although_a_later_copy_is_older(spark):
    rows = spark.createDataFrame(
        [("a", 2, "2024-05-01 12:00:00", "kept"), ("a", 3, "2024-05-01 11:00:00", "late"), ("b", None, "2024-05-01 11:00:00", "nowhere"),
         ("b", 9, "2024-05-01 12:00:00", "kept"), ("c", None, "2024-05-01 12:00:00", "late"), ("c", None, "2024-05-01 11:00:00", "kept")],
        "tx_id string, arrival int, tx_at string, device string").withColumn("tx_at", F.col("tx_at").cast("timestamp_ntz"))
    assert {r["device"] for r in ingest.first_per_key(rows).collect()} == {"kept"}
    assert {r["tx_id"]: r["device"] for r in ingest.first_per_key(rows, arrival="tx_at").collect()}["a"] == "late"


def test_topic_positions_order_copies(spark):
    rows = [(line("a", "2024-05-01T11:00:00+00:00", device="second"), "t", 0, 8), (line("a", "2024-05-01T12:00:00+00:00", device="first"), "t", 0, 7)]
    topic = spark.createDataFrame(rows, "value string, topic string, partition int, offset bigint")
    good, dead = split_dead_letters(positioned(topic))
    assert ingest.first_per_key(ingest.with_defaults(good)).first()["device"] == "first"
    assert dead.columns == ["value", "reject_reason"]


def test_files_keep_their_order_in_batch_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    # the file that sorts last by name is written first; within a file the first line counts
    for n, (name, device) in enumerate([("z", "first"), ("a", "second")]):
        lines = [line("x", f"2024-05-01T1{5 - n}:00:00+00:00", device=device), line("x", "2024-05-01T01:00:00+00:00", device="later line")]
        (folder / f"{name}.json").write_text("\n".join(lines + ["cut"]))
        time.sleep(1.1)
    good, dead = split_dead_letters(positioned(file_replay(spark, str(folder))))
    assert ingest.first_per_key(ingest.with_defaults(good)).first()["device"] == "first" and dead.count() == 2
    sink = sinks.IngestSink(str(tmp_path / "t"))
    run_ingest(file_stream(spark, str(folder), max_files=2), sink, str(tmp_path / "cp"), trigger=None).awaitTermination(300)
    assert [(r["tx_id"], r["device"]) for r in sink.table(spark).collect()] == [("x", "first")]
    assert sink.dead_letters(spark).count() == 2
