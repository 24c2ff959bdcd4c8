"""Steps that large tables need: a row is made once, dealt out without sorting, and no key takes all rows."""

import re

from pyspark.sql import functions as F

from __spark_entry__ import queries
from tollgauge.operators import accuracy, changes, flows, shapes
from tollgauge.plans.inputs import Tables

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_log_is_made_once_before_it_is_decoded(spark):
    logs = spark.range(3).select(
        F.array(F.lit("T"), F.md5(F.col("id").cast("string")), F.md5(F.col("id").cast("string"))).alias("topics"),
        F.concat(F.lit("0x"), F.sha1(F.col("id").cast("string"))).alias("data"), F.lit("0x1").alias("blockNumber"))
    for on_error in ("drop", "zero"):
        assert plan_of(flows.dated_pairs(flows.decode_logs(logs.withColumn("date", F.lit("d")), on_error))).count("sha1(") == 1


def test_decoding_drops_or_counts_unreadable_logs(spark):
    side = "0x" + "0" * 24 + "a" * 40
    rows = [(1, ["T", side, side], "0x5", "0x7"), (2, ["T", side, side], "0xzz", "0x7"), (3, ["T", side, side], "0x5", "0xzz"),
            (4, ["T", side], "0x5", "0x7"), (5, None, "0x5", "0x7"), (6, ["T", side, side, "x"], None, "0x7"), (7, ["T", side, side], "0x5", None),
            (8, ["T", None, side], "0x5", "0x7")]
    logs = spark.createDataFrame(rows, "id int, topics array<string>, data string, blockNumber string")
    kept = {r["id"]: r for r in flows.decode_logs(logs).collect()}
    assert set(kept) == {1, 8} and kept[8]["payer"] is None and kept[1]["payer"] == "0x" + "a" * 40 and kept[1]["block"] == 7
    assert {r["id"]: int(r["units"]) for r in flows.decode_logs(logs, "zero").collect()} == {1: 5, 2: 0, 6: 0, 8: 5}


def test_tapes_read_transfers_that_are_combined_already(spark):
    for name in ("merge_flows", "tape_gaps", "organic_score", "service_rollup", "second_chain_hosts"):
        assert "l_extendedprice" not in plan_of(queries()[name](spark, SF)), name


def test_dealt_scans_keep_all_rows_and_sort_none(spark):
    t = Tables(spark, SF)
    plain = t("lineitem")
    t.scan_partitions = 7
    dealt = t("lineitem")
    assert dealt.columns == plain.columns and dealt.exceptAll(plain).count() == 0 and dealt.count() == plain.count()
    assert re.search(r"RepartitionByExpression \[_dealt", plan_of(dealt))
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 7 and max(sizes) < 2 * min(sizes)


def test_few_categories_do_not_deal_the_answers_out(spark):
    config = spark.createDataFrame([("a", "pct", 0.5, 500.0, "bps", 1.0, 1e6)],
                                   "category string, kind string, band double, tol double, unit string, lo double, hi double")
    answers = spark.createDataFrame([("a", '{"price":10}', 10.0), ("b", '{"price":10}', 10.0)], "category string, payload string, ref double")
    graded = accuracy.grade(answers, config)
    assert "strategy=broadcast" in plan_of(graded)
    assert [(r["category"], r["value"], r["dev"]) for r in graded.collect()] == [("a", 10.0, 0.0)]


def test_what_is_gone_is_not_joined_by_its_missing_host(spark):
    schema = "url string, host string, amount string"
    prev = spark.createDataFrame([("u1", "a", "1"), ("u2", "a", "2"), ("u3", "b", "3"), ("u4", None, "3")], schema)
    cur = spark.createDataFrame([("u1", "a", "9"), ("u5", "b", "1"), ("u6", "c", "1"), ("u7", None, "1")], schema)
    diff = changes.index_diff(prev, cur)
    plan = plan_of(diff)
    assert plan.index("FullOuter") < plan.index("LeftOuter")
    assert {(r["url"], r["host"], r["change"]) for r in diff.collect()} == {
        ("u1", "a", "repriced"), ("u2", "a", "gone"), ("u3", "b", "gone"), ("u4", None, "gone"), ("u5", "b", "new on known host"),
        ("u6", "c", "new on new host"), ("u7", None, "new on new host")}


def test_only_failed_envelopes_are_searched_for_a_payment(spark):
    tx = "0x" + "7" * 64
    rows = [(1, f'{{"success":true,"data":{{"transactionHash":"{tx}"}},"metadata":{{}}}}'),
            (2, f'{{"success":false,"error":{{"details":{{"x":[{{"transactionHash":"{tx}"}}]}}}}}}'), (3, f'{{"deep":{{"transactionHash":"{tx}"}}}}'),
            (4, "no json"), (5, None)]
    split = shapes.split_envelope(spark.createDataFrame(rows, "id int, stdout string"))
    assert {r["id"]: (r["ok"], r["paid"], r["tx"]) for r in split.collect()} == {
        1: (True, False, None), 2: (False, True, tx), 3: (False, True, tx), 4: (False, False, None), 5: (False, False, None)}
    assert "_failed" in plan_of(split)
