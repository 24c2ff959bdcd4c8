"""What large tables leave on disk: written tables are packed, shuffles are given back, and rows are sent once."""

import glob
import os
import re

from pyspark.sql import functions as F

from tollgauge.operators import archive, conformance, grams, receipts, shapes
from tollgauge.sources import landed, storage

LEDGER = "receipt_id string, kind string, url string, metric string, ts string, status string, why string"


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def receipt(i, ts="1", status="short", kind="delivery"):
    return (f"r{i}", kind, f"u{i}", "", ts, status, "w")


def test_a_ledger_is_written_packed_and_read_back(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = spark.createDataFrame([receipt(i) for i in range(50)], LEDGER)
    landed.write_ledger(rows, path)
    files = glob.glob(f"{path}/v=0/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    assert landed.read_ledger(spark, path, LEDGER).exceptAll(rows).count() == 0 and landed.read_ledger(spark, path, LEDGER).count() == 50


def test_written_tables_are_packed_unless_a_writer_says_how(spark, tmp_path):
    storage.write_version(spark.range(10), str(tmp_path / "a"))
    storage.write_version(spark.range(10), str(tmp_path / "b"), compression="snappy")
    assert glob.glob(f"{tmp_path}/a/v=0/*.zstd.parquet") and glob.glob(f"{tmp_path}/b/v=0/*.snappy.parquet")


def test_a_superseded_ledger_is_dealt_out_once_to_be_sorted(spark):
    old = spark.createDataFrame([receipt(1), receipt(2, "2"), receipt(2, "1"), receipt(3)], LEDGER)
    fresh = spark.createDataFrame([receipt(3, "1", "delivered"), receipt(4)], LEDGER)
    kept = receipts.supersede(old, fresh, ranged=True)
    assert executed(kept.orderBy("receipt_id")).count("rangepartitioning(receipt_id") == 1
    assert sorted((r["receipt_id"], r["ts"], r["status"]) for r in kept.collect()) == [
        ("r1", "1", "short"), ("r2", "1", "short"), ("r3", "1", "delivered"), ("r4", "1", "short")]
    plain = receipts.supersede(old, fresh)
    assert "rangepartitioning" not in executed(plain) and plain.exceptAll(kept).count() == kept.exceptAll(plain).count() == 0


def test_one_per_id_carries_only_the_columns_that_are_asked_for(spark):
    rows = spark.createDataFrame([receipt(1), receipt(1, "0")], LEDGER)
    plan = executed(receipts.one_per_id(rows).select("receipt_id", "status"))
    assert "why" not in plan.split("== Initial Plan ==")[-1].replace("why string", "").split("Scan ExistingRDD")[0]
    assert [r["ts"] for r in receipts.one_per_id(rows).collect()] == ["0"]


def test_pointers_are_grouped_where_calls_meet_them(spark):
    calls = spark.createDataFrame([("u1", "t"), ("u1", None), ("u1", ""), ("u2", "x"), (None, None)], "url string, tx string")
    captures = spark.createDataFrame([("c1", "u1", "t", "f2", 1), ("c2", "u1", "t", "f1", 9), ("c3", "u1", None, "f1", 2), ("c4", "u1", "", "f3", 1)],
                                     "capture_id string, url string, tx string, file string, line int")
    found = archive.link_first(calls, archive.capture_pointers(captures, "line"))
    assert {(r["url"], r["tx"]): (r["raw_file"], r["raw_id"]) for r in found.collect()} == {
        ("u1", "t"): ("f1", "c2"), ("u1", None): ("f1", "c3"), ("u1", ""): ("f3", "c4"), ("u2", "x"): (None, None), (None, None): (None, None)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(archive.link_first(calls, archive.capture_pointers(captures, "line")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # by capture, by (url, transaction) and the calls: the groups are not dealt out again for the join
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3, plan


def test_second_calls_without_a_verdict_are_not_sent(spark):
    schema = "url string, status string, missing array<string>, extra array<string>, why string, conforms boolean"
    first = spark.createDataFrame([(u, "short", ["a"], [], "w", False) for u in ("u1", "u2", "u3", "u4")] + [("u5", "inconclusive", [], [], "x", False)], schema)
    second = spark.createDataFrame([("u1", "delivered", [], ["b"], "", True), ("u2", "short", ["a"], [], "", False), ("u2", "inconclusive", ["z"], [], "", False),
                                    ("u3", "inconclusive", ["a"], [], "", False), ("u5", "delivered", [], [], "", True), ("u1", None, None, None, None, None)], schema)
    settled = conformance.reconcile(first, second)
    assert {r["url"]: (r["status"], r["missing"], r["extra"]) for r in settled.collect()} == {
        "u1": ("delivered", [], ["b"]), "u2": ("short", ["a"], []), "u3": ("inconclusive", ["a"], []), "u4": ("inconclusive", ["a"], []),
        "u5": ("inconclusive", [], [])}
    assert re.search(r"Filter .*status#\d+ IN \(delivered,short\)", settled._jdf.queryExecution().optimizedPlan().toString())
    assert settled.where(F.col("conforms")).count() == 1


def test_lists_of_pieces_keep_a_number_in_place_of_a_long_key(spark, tmp_path):
    rows = spark.range(3000).select(F.concat(F.lit("https://api"), F.col("id"), F.lit(".example.com/v1/report")).alias("url"))
    kept = storage.write_version(grams.numbered(rows, "row_key", F.col("url")), str(tmp_path / "rows"))
    keyed = spark.read.parquet(kept)
    place = storage.write_version(grams.postings(keyed, "row_key", F.col("url")), str(tmp_path / "lists"), partition_by=("bucket",), **grams.PACKED)
    lists = spark.read.parquet(place).withColumn("bucket", F.col("bucket").cast("string"))
    files = glob.glob(f"{place}/bucket=*/*.parquet")
    assert lists.count() > 30 * 3000 and sum(os.path.getsize(f) for f in files) - 900 * len(files) < lists.count()
    found = grams.narrowed(keyed, "row_key", grams.candidates(lists, grams.counts(lists), "api123."))
    assert [r["url"] for r in found.collect()] == ["https://api123.example.com/v1/report"]


def test_no_task_sorts_more_pieces_than_it_has_room_for(spark, monkeypatch):
    monkeypatch.setattr(grams, "TASK_LETTERS", 100)
    rows = spark.createDataFrame([(i, "abcdefghij") for i in range(95)] + [(None, None)], "id long, text string").coalesce(1)
    lists = grams.postings(rows, "id", F.col("text"))
    sizes = [r["count"] for r in lists.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 5 and max(sizes) < 40 * 8 and sum(sizes) == 95 * 8
    assert lists.rdd.mapPartitions(lambda p: [[(r["bucket"], r["piece"], r["key"]) for r in p]]).map(lambda p: p == sorted(p)).min()


def test_pieces_hold_every_kind_of_character(spark):
    text = "É\nb😀日\r𝔄$\\ x"
    low = text.lower()
    rows = spark.createDataFrame([(text,), ("ab",), ("",), (None,)], "t string")
    got = [r[0] for r in rows.select(grams.pieces(F.col("t"))).collect()]
    assert got == [[low[i:i + 3] for i in range(len(low) - 2)], [], [], []]
    assert "zip_with" not in rows.select(grams.pieces(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()


def test_nodes_are_described_level_by_level_to_the_deepest(spark):
    docs = ['{"a":{"b":[1,{"c":"x"}]},"d":[[],{}],"e":null}', "[[[{\"z\":true}]]]", "{}", "7", "bad", None, '{"x":"{[{["}']
    rows = spark.createDataFrame([(d,) for d in docs], "doc string")
    nodes = shapes.json_nodes(rows, "doc")
    got = [r["nodes"] and [(n["path"], n["kind"], n["text"], n["depth"], n["at"]) for n in r["nodes"]] for r in nodes.collect()]
    assert got[0] == [(".a", "object", None, 1, [0]), (".d", "array", None, 1, [1]), (".e", "null", None, 1, [2]), (".a.b", "array", None, 2, [0, 0]),
                      (".d[0]", "array", None, 2, [1, 0]), (".d[1]", "object", None, 2, [1, 1]), (".a.b[0]", "integer", "1", 3, [0, 0, 0]),
                      (".a.b[1]", "object", None, 3, [0, 0, 1]), (".a.b[1].c", "string", "x", 4, [0, 0, 1, 0])]
    assert [n[0] for n in got[1]] == ["[0]", "[0][0]", "[0][0][0]", "[0][0][0].z"] and got[6] == [(".x", "string", "{[{[", 1, [0])]
    assert not got[2] and not got[3] and not got[4] and not got[5]
    # all nodes found so far are not bound to a variable, which would copy them at every level
    fold = nodes._jdf.queryExecution().optimizedPlan().toString()
    assert "array_append(" in fold or "array_insert(" in fold
    assert "slice(array(lambda" not in fold


def test_rows_of_one_key_have_one_number(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"k{i // 2}") for i in range(40)] + [(40, None)], "id int, k string")
    kept = spark.read.parquet(storage.write_version(rows, str(tmp_path / "rows")))
    numbered = grams.numbered(kept, "n", F.col("k")).collect()
    assert len(numbered) == 41 and {r["n"] for r in numbered if r["k"] is None} <= {None}
    assert len({(r["k"], r["n"]) for r in numbered if r["k"]}) == len({r["n"] for r in numbered if r["k"]}) == 20
