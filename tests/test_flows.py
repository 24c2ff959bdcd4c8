from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tollgauge.operators import changes, flows, graph, ranks, registry

SELLER = "0x" + "1" * 40
A, B = "0x" + "a" * 40, "0x" + "b" * 40


def log(frm, to, amount, block="0x1"):
    pad = "0x" + "0" * 24
    return (["T", pad + frm[2:], pad + to[2:]], hex(amount), block)


def logs(spark, rows):
    return spark.createDataFrame(rows, "topics array<string>, data string, blockNumber string")


def test_decode_and_aggregate(spark):
    rows = [log(A, SELLER, 1000000), log(B, SELLER, 2000000), log(A, SELLER, 500000),
            (["T"], "0x1", "0x1"), log(A, SELLER, 1)[:1] + ("0xzz", "0x1")]
    row = flows.tape_aggregate(flows.decode_logs(logs(spark, rows))).first()
    assert (row["usdc"], row["settlements"], row["unique_payers"], row["repeat_payers"]) == (3.5, 3, 2, 1)
    assert "payer" not in row.asDict()
    zero = flows.decode_logs(logs(spark, rows), "zero")
    assert zero.count() == 4 and zero.agg(F.sum("units")).first()[0] == 3500000


def test_burn_and_wide_amounts(spark):
    rows = [log(A, "0x" + "0" * 40, 5), log(A, "0x" + "0" * 36 + "dead", 7), log(A, SELLER, 2 ** 100)]
    out = flows.tape_aggregate(flows.decode_logs(logs(spark, rows))).collect()
    assert [r["payee"] for r in out] == [SELLER] and out[0]["units"] == 2 ** 100


def test_zero_totals_do_not_divide(spark):
    row = flows.tape_aggregate(flows.decode_logs(logs(spark, [log(A, SELLER, 0)]))).first()
    assert (row["top_payer_share"], row["payer_hhi"]) == (0.0, 0.0)


def test_hot_payee_matches_brute_force_in_any_layout(spark):
    rows = [(f"p{i * 7919 % 800}", "hot" if i % 3 == 0 else f"s{i % 50}", (i * 31) % 997 + 1, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "payer string, payee string, units long, block long").withColumn(
        "units", F.col("units").cast("decimal(38,0)"))
    paid = defaultdict(Counter)
    for payer, payee, units, _ in rows:
        paid[payee][payer] += units
    for layout in (df.repartition(7), df.coalesce(1).orderBy(F.desc("block"))):
        got = {r["payee"]: r for r in flows.tape_aggregate(layout).collect()}
        for payee, by in paid.items():
            total, top = sum(by.values()), sorted(by.values(), reverse=True)
            assert got[payee]["unique_payers"] == len(by)
            assert abs(got[payee]["top5_payer_share"] - sum(top[:5]) / total) < 1e-4
            assert abs(got[payee]["payer_hhi"] - sum((x / total) ** 2 for x in top)) < 1e-4


def test_token_inflow(spark):
    m = "EPjFWdd5AufqSSqeM2qN1xzybapC8G4wEGGkZwyTDt1v"
    bal = lambda i, o, a: (i, m, o, a)
    schema = ("account string, keys array<string>, pre array<struct<accountIndex:int,mint:string,owner:string,uiAmount:double>>,"
              "post array<struct<accountIndex:int,mint:string,owner:string,uiAmount:double>>")
    rows = [("X", ["X", "P"], [bal(0, "us", 244.9959), bal(1, "them", 0.7248)], [bal(0, "us", 245.1459), bal(1, "them", 0.5748)]),
            ("X", ["X"], [bal(0, "us", 5.0)], [bal(0, "us", 5.0)]),
            ("Y", ["X"], [bal(0, "us", 5.0)], [bal(0, "us", 9.0)])]
    got = flows.token_inflow(spark.createDataFrame(rows, schema)).select("delta", "payer").collect()
    assert abs(got[0]["delta"] - 0.15) < 1e-9 and got[0]["payer"] == "them"
    assert (got[1]["delta"], got[1]["payer"], got[2]["delta"]) == (0.0, None, 0.0)


def test_exact_order_statistics_on_a_hot_group(spark):
    values = {"hot": [(i * i) % 1009 / 7 for i in range(4000)], "tie": [5.0] * 900, "one": [3.0]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k string, v double").repartition(9)
    upper = {r["k"]: r["median"] for r in ranks.upper_median(df, ["k"], "v").collect()}
    quant = {r["k"]: (r["p10"], r["p90"]) for r in ranks.positional_quantiles(df, ["k"], "v").collect()}
    for k, vs in values.items():
        s, n = sorted(vs), len(vs)
        assert upper[k] == s[n // 2]
        assert quant[k] == ((s[max(0, int(n * .1) - 1)], s[min(n - 1, int(n * .9))]) if n >= 10 else (s[0], s[-1]))


def test_budget_takes_cheapest_first_and_stops(spark):
    rows = [(f"u{i:04d}", 0.004 if i < 900 else 0.007) for i in range(1000)]
    df = spark.createDataFrame(rows, "url string, price double")
    assert registry.within_budget(df, 0.01).count() == 2
    assert registry.within_budget(df, 3.6 + 0.015).count() == 902
    assert registry.within_budget(df, 100.0).count() == 1000


def test_components_on_a_long_chain_and_a_hub(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(150)]
    hub = [("hub", f"x{i:03d}") for i in range(200)]
    edges = spark.createDataFrame(chain + hub + [("solo", "solo")], "a string, b string")
    got = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    assert {got[f"n{i:03d}"] for i in range(151)} == {"n000"}
    assert {got[f"x{i:03d}"] for i in range(200)} == {"hub"} and got["solo"] == "solo"


def test_first_seen_seeds_from_the_previous_snapshot(spark):
    df = lambda rows: spark.createDataFrame(rows, "url string")
    first = spark.createDataFrame([], "url string, date string")
    out = changes.update_first_seen(first, df([("a",), ("b",)]), "2026-08-11", df([("a",)]), "2026-08-10")
    assert {(r["url"], r["date"]) for r in out.collect()} == {("a", "2026-08-10"), ("b", "2026-08-11")}
