import json

from pyspark.sql import functions as F

from tollgauge import schemas
from tollgauge.operators import receipts
from tollgauge.plans.inputs import Tables
from tollgauge.sources import landed, storage
from tollgauge.streaming import streams

SF = "/root/testdata/sf0.001"


def test_logs_round_trip(spark, tmp_path):
    raw = Tables(spark, SF).raw_logs().select("topics", "data", "blockNumber")
    landed.write_logs(raw, str(tmp_path / "logs"))
    back = landed.read_logs(spark, str(tmp_path / "logs"))
    assert back.count() == raw.count() and back.exceptAll(raw).isEmpty()


def test_tape_reads_one_chain_and_skips_bad_files(spark, tmp_path):
    day = {"date": "2026-08-12", "by_address": {"0xA": {"settlements": 2, "usdc": 1.5, "unique_payers": 1}}}
    sol = {"generated": "2026-08-12 01:00:00", "by_wallet": {"W": {"settlements": 1, "usdc": 2.0, "unique_payers": 1, "host": "h"}}}
    (tmp_path / "settlements_2026-08-12.json").write_text(json.dumps(day, indent=1))
    (tmp_path / "settlements_2026-08-13.json").write_text("{broken")
    (tmp_path / "settlements_solana_2026-08-12.json").write_text(json.dumps(sol, indent=1))
    base = landed.read_tape(spark, str(tmp_path)).collect()
    assert [(r["date"], r["address"], r["usdc"]) for r in base] == [("2026-08-12", "0xa", 1.5)]
    other = landed.read_tape(spark, str(tmp_path), "solana").collect()
    assert [(r["date"], r["wallet"], r["host"]) for r in other] == [("2026-08-12", "W", "h")]


def test_registry_keeps_nested_fields(spark, tmp_path):
    doc = [{"resource": "https://x.com/api", "accepts": [{"amount": "1000", "payTo": "0xAB"}],
            "quality": {"l30DaysTotalCalls": 42}, "extensions": {"bazaar": {"schema": {"x": 1}}}}]
    (tmp_path / "registry.json").write_text(json.dumps(doc))
    row = landed.read_registry(spark, str(tmp_path / "registry.json")).first()
    assert row["host"] == "x.com" and row["quality"]["l30DaysTotalCalls"] == 42
    assert json.loads(row["extensions"]["bazaar"]["schema"]) == {"x": 1}


def test_rewriting_a_date_replaces_only_that_date(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(r, "date string, n int")
    path = str(tmp_path / "tape")
    storage.write_partition(rows(("d1", 1), ("d2", 1)), path)
    storage.write_partition(rows(("d2", 5)), path)
    assert {(r["date"], r["n"]) for r in spark.read.parquet(path).collect()} == {("d1", 1), ("d2", 5)}


def test_captures_append_and_come_back(spark, tmp_path):
    rec = spark.createDataFrame([("2026-08-12T01", "u1", "GET", None, 0, "{}", ""), ("2026-08-13T01", "u2", "GET", None, 0, "{}", "")], schemas.CAPTURE)
    folder = str(tmp_path / "captures")
    landed.append_captures(rec, folder)
    before = {r["url"]: r["capture_id"] for r in landed.read_captures(spark, folder).collect()}
    landed.append_captures(rec.limit(1), folder)
    rows = landed.read_captures(spark, folder).collect()
    assert sorted((r["url"], r["file"]) for r in rows) == [("u1", "raw_2026-08-12")] * 2 + [("u2", "raw_2026-08-13")]
    assert {r["url"]: r["capture_id"] for r in rows} == before


def test_snapshots_and_captures_by_name(spark, tmp_path):
    (tmp_path / "raw_2026-08-13.jsonl").write_text('{"url":"a","stdout":"{}"}\n{"url":"b","stdout":"{}"}\n')
    rows = landed.read_captures(spark, str(tmp_path)).orderBy("line").collect()
    assert [(r["file"], r["url"]) for r in rows] == [("raw_2026-08-13.jsonl", "a"), ("raw_2026-08-13.jsonl", "b")]
    place = landed.write_snapshot(spark.range(3), str(tmp_path / "snap"))
    assert landed.read_snapshot(spark, place, "id long").count() == 3


def test_hits_stop_at_the_first_bad_line_of_a_file(spark, tmp_path):
    good = '{"ts":1,"tool":"a","subject":"s","client":"c"}\n'
    (tmp_path / "hits-1.jsonl").write_text(good + "{oops\n" + good)
    (tmp_path / "hits-2.jsonl").write_text(good + good)
    assert landed.read_hits(spark, str(tmp_path)).count() == 3


def test_ledger_is_written_in_id_order(spark, tmp_path):
    df = spark.createDataFrame([(f"rcpt_{i * 7 % 50:03d}", i) for i in range(50)], "receipt_id string, n int")
    landed.write_ledger(df, str(tmp_path / "ledger"))
    back = landed.read_ledger(spark, str(tmp_path / "ledger"), "receipt_id string, n int")
    assert [r["receipt_id"] for r in back.collect()] == sorted(f"rcpt_{i:03d}" for i in range(50))
    storage.write_mart(df, str(tmp_path / "mart"), "json")
    assert storage.read_mart(spark, str(tmp_path / "mart"), "json", "receipt_id string, n int").count() == 50


def test_a_ledger_can_be_read_and_written_back(spark, tmp_path):
    path, schema = str(tmp_path / "ledger"), "receipt_id string, n int"
    landed.write_ledger(spark.createDataFrame([("a", 1), ("b", 2)], schema), path)
    landed.write_ledger(landed.read_ledger(spark, path, schema).withColumn("n", F.col("n") + 1), path)
    assert [tuple(r) for r in landed.read_ledger(spark, path, schema).collect()] == [("a", 2), ("b", 3)]


LEDGER = "receipt_id string, kind string, url string, metric string, ts string, status string"


def test_fresh_receipts_win_per_id(spark):
    old = spark.createDataFrame([("r1", "delivery", "a", "", "d1", "old"), ("r2", "delivery", "b", "", "d1", "kept")], LEDGER)
    fresh = spark.createDataFrame([("r1", "delivery", "a", "", "d2", "fresh")], LEDGER)
    assert sorted(tuple(r) for r in receipts.supersede(old, fresh).collect()) == [
        ("r1", "delivery", "a", "", "d2", "fresh"), ("r2", "delivery", "b", "", "d1", "kept")]


def test_streaming_ledger_equals_batch_supersede_over_any_split(spark, tmp_path):
    old = spark.createDataFrame([("r1", "delivery", "a", "", "d", "short"), ("r2", "delivery", "b", "", "d", "short")], LEDGER)
    rows = [("r3", "delivery", "a", "", "d", "delivered"), ("r4", "delivery", "a", "", "d", "short"),
            ("r5", "delivery", "c", "", "d", "short"), ("r3", "delivery", "a", "", "e", "delivered")]
    want = {tuple(r) for r in receipts.supersede(old, spark.createDataFrame(rows, LEDGER)).collect()}
    for k, split in enumerate(([rows], [rows[:1], rows[1:]], [rows[3:], rows[1:3], rows[:1]])):
        src, path = str(tmp_path / f"in{k}"), str(tmp_path / f"ledger{k}")
        for batch in split:
            spark.createDataFrame(batch, LEDGER).coalesce(1).write.mode("append").parquet(src)
            streams.stream_ledger(spark.readStream.schema(LEDGER).parquet(src), path, str(tmp_path / f"cp{k}"))
        assert {tuple(r) for r in streams.current_ledger(spark, path, old).collect()} == want


def test_a_table_in_one_row_group_is_dealt_out(spark, tmp_path):
    """One row group is one task of a scan, and all work on its rows would be that task's."""
    rows = spark.range(200000).select(F.col("id").alias("o_orderkey"), F.sha2(F.col("id").cast("string"), 256).alias("o_comment"))
    rows.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    rows.limit(5).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    t = Tables(spark, str(tmp_path))
    tasks = t("orders").rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(n > 0 for n in tasks) >= 2 * spark.sparkContext.defaultParallelism and sum(tasks) == 200000
    assert t("orders").exceptAll(rows).isEmpty() and t("part").rdd.getNumPartitions() == 1
