"""One round of publishing: what runs side by side, what is computed once, and what a refusal leaves."""

import threading

import pytest
from pyspark.sql import SparkSession

from tollgauge.operators import shapes
from tollgauge.plans import ledger_queries, publish_queries
from tollgauge.plans.inputs import Tables
from tollgauge.sources import publish

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_jobs_run_at_once_and_the_first_failure_in_order_is_raised(spark):
    met = threading.Barrier(3, timeout=60)
    ended = []

    def job(i, why=None):
        def run():
            met.wait()  # passes only if all three are running
            n = spark.range(i).count()
            ended.append(i)
            if why:
                raise publish.Refused(why)
            return n
        return run

    assert publish.side_by_side(spark, job(1), job(2), job(3)) == [1, 2, 3]
    with pytest.raises(publish.Refused, match="second"):
        publish.side_by_side(spark, job(4), job(5, "second"), job(6, "third"))
    assert sorted(ended) == [1, 2, 3, 4, 5, 6]


def test_a_round_is_switched_and_read_without_rows_from_python(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "set")

    def no_python_rows(*_, **__):
        raise AssertionError("rows are handed over from Python")

    monkeypatch.setattr(SparkSession, "createDataFrame", no_python_rows)
    assert publish.publish(spark, base, lambda r: (r.stage("b", spark.range(3)), r.stage("a's", spark.range(2)))) is None
    assert {m: n for m, (_, n) in publish.manifest(spark, base).items()} == {"a's": 2, "b": 3}
    before = publish.manifest(spark, base)
    publish.publish(spark, base, lambda r: r.stage("b", spark.range(9)))
    assert publish.published(spark, base, "b").count() == 9 and publish.published(spark, base, "b", before).count() == 3


def test_both_kinds_of_receipts_are_linked_through_stored_pointers(spark):
    t = Tables(spark, SF)
    for rows in (publish_queries.ledger(t), ledger_queries.fresh_delivery(t)):
        assert "sha2(cast(concat_ws" not in plan_of(rows)
    fresh, kept = ledger_queries.pointers(t), ledger_queries.stored_pointers(t)
    assert kept.count() == fresh.count() and kept.select(fresh.columns).exceptAll(fresh).count() == 0


def test_a_field_name_is_made_plain_once_for_all_hints(spark):
    doc = '{"Spot_Price":"$1,000","price":{"x":5},"ok":true,"none":null,"n":[7,{"last":8.5}],"name":"x"}'
    rows = spark.createDataFrame([(doc,), ("no json",), (None,)], "doc string")
    found = shapes.numeric_candidates(shapes.json_nodes(rows, "doc"))
    assert plan_of(found.select("candidates")).count("lower(") == 1
    got = [[(c["path"], c["value"], c["named"]) for c in r["candidates"] or ()] for r in found.collect()]
    assert sorted(got[0]) == [(".Spot_Price", 1000.0, True), (".n[1].last", 8.5, True), (".price.x", 5.0, False)] and got[1:] == [[], []]


def test_shapes_are_ordered_without_a_comparison_in_the_row(spark):
    rows = spark.createDataFrame([('{"b":[{"z":null}],"a":1.5,"A":"x"}',), ("7",), ("bad",)], "doc string")
    shaped = shapes.json_shape(rows, "doc")
    assert "sort_array(" in plan_of(shaped) and "array_sort(" not in plan_of(shaped)
    assert [r["shape"] and [(s["path"], s["type"]) for s in r["shape"]] for r in shaped.collect()] == [
        [("", "object"), ("/A", "string"), ("/a", "number"), ("/b", "array"), ("/b/~*", "object"), ("/b/~*/z", "null")], [("", "integer")], None]
