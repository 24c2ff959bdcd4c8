import json

import pytest
from pyspark.sql import functions as F

from tollgauge.operators import accuracy, checks, conformance, guards, receipts, shapes, verdicts

TX = "0x" + "a" * 64


def judge_one(spark, payload, expect):
    df = spark.createDataFrame([(payload if isinstance(payload, str) else json.dumps(payload), expect)],
                               "payload string, expect array<string>")
    direct = shapes.judge(df, "payload").first()
    stored = shapes.judge_shape(shapes.json_shape(df, "payload"), "shape").first()
    assert direct["status"] == stored["status"]
    return direct


@pytest.mark.parametrize("payload, expect, status, missing", [
    ({"a": 1, "b": "x", "c": True}, ["a", "b"], "delivered", []),
    ({"a": 1}, ["a", "b", "c"], "short", ["b", "c"]),
    ("not an object", ["a"], "inconclusive", ["a"]),
    ("null", ["price"], "inconclusive", ["price"]),
    ({"error": "bad request", "code": 400}, ["price", "symbol"], "inconclusive", ["price", "symbol"]),
    ({"price": 1, "symbol": "BTC"}, ["price", "symbol", "volume24h"], "short", ["volume24h"]),
    ({"ok": True, "data": {"price": 1, "high24h": 2}}, ["price", "high24h"], "delivered", []),
    ({"observations": [{"airport_code": "KJFK"}], "links": {}}, ["airport_code"], "delivered", []),
    ({"observations": [{"airport_code": "KJFK"}]}, ["airport_code", "temperature"], "short", ["temperature"]),
    ({"count": 3, "data": {"bridges": [], "source": "x"}}, ["count", "bridges"], "delivered", []),
    ({"a/b": 1, "c~d": {"e/f": 2}}, ["a/b", "e/f"], "delivered", []),
])
def test_judge(spark, payload, expect, status, missing):
    row = judge_one(spark, payload, expect)
    assert (row["status"], row["missing"]) == (status, missing)


def test_shape_keeps_types_and_no_values(spark):
    doc = {"price": 43512.11, "symbol": "BTC", "ok": True, "count": 3, "one": 1.0,
           "records": [{"type": "A", "ip": "1.2.3.4"}], "meta": {"asOf": "2026-08-12"}}
    df = spark.createDataFrame([(json.dumps(doc),)], "p string")
    got = {s["path"]: s["type"] for s in shapes.json_shape(df, "p").first()["shape"]}
    assert got["/price"] == "number" and got["/count"] == "integer" and got["/one"] == "number"
    assert got["/records/~*/ip"] == "string" and got["/meta/asOf"] == "string" and got["/records"] == "array"
    assert not any(v in str(got) for v in ("43512", "BTC", "1.2.3.4", "2026-08-12"))


@pytest.mark.parametrize("doc, tx", [
    ({"transactionHash": TX}, TX), ({"a": {"b": {"payment": {"transaction": TX}}}}, TX),
    ({"status": "ok", "price": "$0.001"}, None), ({"transaction": "0xshort"}, None)])
def test_find_payment(spark, doc, tx):
    df = spark.createDataFrame([(json.dumps(doc),)], "p string")
    assert shapes.find_payment(df, "p").first()["tx"] == tx


def test_reconcile(spark):
    schema = "url string, status string, missing array<string>, extra array<string>, why string, conforms boolean"
    first = spark.createDataFrame([(u, "short", ["b"], [], "missing 1", False) for u in "abc"], schema)
    second = spark.createDataFrame([("a", "delivered", [], [], "", True), ("b", "inconclusive", [], [], "", False),
                                    ("c", "short", ["b"], [], "", False)], schema)
    got = {r["url"]: r["status"] for r in conformance.reconcile(first, second).collect()}
    assert got == {"a": "delivered", "b": "inconclusive", "c": "short"}


def test_receipts_are_tamper_evident_and_reproduce(spark):
    rows = spark.createDataFrame([
        ("https://v.io/tts", "v.io", "0.001", "0.001", "True", "False", TX, 2679, ["content_type", "description"],
         '{"type":"x"}', "short", ["content_type", "description"], ["type"], "shortfall confirmed on two calls"),
        ("https://ok.io/tts", "ok.io", "0.001", "0.001", "True", "False", "0xabc", 120, ["content_type", "description"],
         '{"content_type":"a","description":"b"}', "delivered", [], [], "")],
        "url string, host string, quoted string, charged string, paid string, free string, tx string, ms long,"
        "promised array<string>, payload string, status string, missing array<string>, extra array<string>, why string")
    none = spark.createDataFrame([], "file string, line long, url string, tx string, payload string")
    made = receipts.delivery_receipts(shapes.json_shape(rows, "payload"), none, "2026-08-15")
    for r in receipts.verify_delivery(made, none).collect():
        assert (r["integrity"], r["verdict"], r["raw"]) == (True, True, None)
    cut = made.withColumn("promised", F.array(F.lit("content_type")))
    assert not any(r["integrity"] for r in receipts.verify_delivery(cut, none).collect())
    short = made.where("status = 'short'").first()
    assert short["reverified"] and short["missing"] == ["content_type", "description"] and short["tx"] == TX
    leaves = shapes.untyped_leaves(shapes.shape_rows(made, "receipt_id"))
    assert leaves.isEmpty()


def claims(spark, rows):
    return spark.createDataFrame(
        [("https://f.io/p", "f.io", "0.001", True, "BTC price", r, 63147.6, "median", d, 50.0, "bps", f, "2026-08-14") for r, d, f in rows],
        "url string, host string, quoted string, paid boolean, metric string, returned double, truth double, truth_source string,"
        "dev_value double, tol_value double, unit string, field string, ts string")


def test_accuracy_receipts(spark):
    made = receipts.receipts_from(claims(spark, [(63121.8, -2.1, ".p"), (61000.0, -340.0, ".p"), (None, None, None)]), "stock")
    assert sorted(r["status"] for r in made.collect()) == ["accurate", "inconclusive", "off"]
    assert all(r["integrity"] and r["verdict"] for r in receipts.verify_accuracy(made).collect())
    forged = made.withColumn("truth", F.lit(1.0))
    assert not any(r["integrity"] for r in receipts.verify_accuracy(forged).collect())
    guarded = receipts.receipts_from(claims(spark, [(63765.94, 99.9, ".markets[7].volume24hUsd")]), "price").first()
    assert guarded["status"] == "inconclusive" and "not a price" in guarded["why"]


def test_supersede_keeps_one_verdict_per_call(spark):
    off, none = (receipts.receipts_from(claims(spark, [row]), "stock") for row in ((63765.9, 99.9, ".x"), (None, None, ".x")))
    out = receipts.supersede(off, none).collect()
    assert [r["status"] for r in out] == ["inconclusive"]


CLEAN = dict(price_ok=True, payto_ok=True, phantom=False, checked_live=True)
INPUT = ("host string, price_ok boolean, payto_ok boolean, phantom boolean, checked_live boolean, receipts long, disputes long,"
         "delivered long, accurate long, severe long, severe_fields int, payout_pct double, demand string, ranked boolean, text string")


def light(spark, **facts):
    names = [c.split()[0] for c in INPUT.split(",")]
    row = verdicts.verdict(spark.createDataFrame([tuple(facts.get(n, "x.com" if n == "host" else None) for n in names)], INPUT)).first()
    return row


@pytest.mark.parametrize("facts, expected", [
    (dict(CLEAN, payto_ok=False), "red"), (dict(CLEAN, phantom=True), "red"),
    (dict(receipts=1, disputes=1, severe=1, severe_fields=2), "red"),
    (dict(CLEAN, payout_pct=99.0), "green"), (dict(CLEAN, demand="one wallet", ranked=True), "green"),
    (dict(CLEAN, text="hourly weather forecast"), "green"), (dict(CLEAN, price_ok=False), "yellow"),
    (dict(CLEAN, receipts=1, disputes=1), "yellow"), (dict(CLEAN, price_ok=False, payto_ok=False), "red"), (dict(), "gray")])
def test_red_needs_hard_evidence(spark, facts, expected):
    row = light(spark, **facts)
    assert row["light"] == expected
    assert (row["score"] is None) == (expected == "gray")


def test_challenge_precedence(spark):
    usdc = "0x833589fcd6edb6e08f4c7c32d4f71b54bda02913"
    body = json.dumps({"accepts": [{"amount": "9", "asset": "0xother", "payTo": "0xno", "network": "n0"},
                                   {"maxAmountRequired": "80000", "asset": usdc.upper().replace("0X", "0x"), "recipient": "0xyes", "network": "eip155:8453"}]})
    rows = [(1, body, None, None), (2, "oops", None, None), (3, '{"price":{"amount":"0.0085"}}', None, None)]
    df = spark.createDataFrame(rows, "id int, body string, payment_required string, www_authenticate string")
    got = {r["id"]: r for r in checks.parse_challenge(df).collect()}
    assert (got[1]["amount"], got[1]["payto"]) == (0.08, "0xyes")
    assert got[2]["amount"] is None and got[3]["amount"] == 0.0085


def test_guards(spark):
    guards.check_shrink(100, 80, 0.75)
    guards.check_window(6, 24)
    guards.check_partial(75000, 12, 0)
    for bad in (lambda: guards.check_shrink(100, 70, 0.75), lambda: guards.check_window(24, 6),
                lambda: guards.check_partial(75000, 12, 8), lambda: guards.check_not_empty(spark.range(0)),
                lambda: guards.check_no_new_short(spark.range(1)),
                lambda: guards.check_canary(spark.createDataFrame([("null", ["a"])], "payload string, expect array<string>"))):
        with pytest.raises(guards.Refused):
            bad()
    assert guards.check_canary(spark.createDataFrame([('{"a":1}', ["a"])], "payload string, expect array<string>")) == 1


def test_filters_on_judged_rows_do_not_read_the_response_again(spark, tmp_path):
    """A filter on a judged column would be moved below the judgement and repeat it at every mention."""
    rows = spark.createDataFrame([("u1", "h1", 1.0, True, '{"a":1}', ["a"]), ("u2", "h2", 1.0, True, '{"b":1}', ["a"]),
                                  ("u3", "h3", 1.0, False, "nope", ["a"])],
                                 "url string, host string, quoted double, conforms boolean, payload string, promised array<string>")
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    clean, recall, flips = conformance.regrade(shapes.json_shape(rows, "payload"))
    assert sorted(map(tuple, flips.select("url", "was", "now").collect())) == [("u2", "delivered", "short")]
    assert [r["url"] for r in recall.collect()] == ["u3"] and clean.count() == 2
    seen = shapes.classify_screen(shapes.json_nodes(rows, "payload"), "payload").select(
        F.col("url").alias("host"), F.col("host").alias("address"), "screen")
    listed = spark.createDataFrame([("h1", "sanctioned"), ("h3", "sanctioned")], "address string, expect string")
    missed = accuracy.screening_misses(seen, listed)
    assert sorted(map(tuple, missed.collect())) == [("u1", "h1", "unclear"), ("u3", "h3", "unclear")]
    for made, most in ((flips, 2), (missed, 2)):  # nodes or levels, and whether there is a document
        plan = made._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "")
        assert 0 < plan.count("parsejson") <= most
