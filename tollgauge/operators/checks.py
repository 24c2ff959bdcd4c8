"""Free, unpaid checks of listings: honesty, probe score, adoption and reliability.

A check row: origin, url, status, ms, adv_amount, live_amount, adv_payto, live_payto,
network, schema, payable, inconclusive, body_sample, calls30d. An origin row carries
discovery facts, phantom and rotation results, usage and settlement counters.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions.chain import is_burn
from tollgauge.functions.demand import adoption
from tollgauge.functions.grades import score_grade
from tollgauge.functions.numbers import half_even, money_text, whole_days_since
from tollgauge.operators.registry import first_priceable, pay_address
from tollgauge import schemas


def is_conclusive() -> Column:
    return ~F.coalesce("inconclusive", F.lit(False))


def conclusive(checks: DataFrame) -> DataFrame:
    return checks.where(is_conclusive())


def median_of_falling(col: str) -> Column:
    """Upper median of values that ``col`` holds with their sign turned, as an aggregate: the upper
    middle of rising values is the lower middle of falling ones. Milliseconds take few values, and
    the aggregate counts per value."""
    return -F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {col})")


def price_differs(adv: Column, live: Column) -> Column:
    """More than 2% of the larger amount apart; a missing or zero amount cannot differ."""
    both = F.coalesce((adv != 0) & (live != 0), F.lit(False))
    return both & (F.abs(adv - live) / F.greatest(adv, live) > 0.02)


def payto_differs(adv: Column, live: Column) -> Column:
    return F.coalesce((adv != "") & (live != "") & (F.lower(adv) != F.lower(live)), F.lit(False))


def honesty_flags(checks: DataFrame) -> DataFrame:
    """Per origin with a conclusive check: do price and address match the listing?"""
    return conclusive(checks).groupBy("origin").agg(
        (~F.bool_or(price_differs(F.col("adv_amount"), F.col("live_amount")))).alias("price_ok"),
        (~F.bool_or(payto_differs(F.col("adv_payto"), F.col("live_payto")))).alias("payto_ok"))


def probe_flags(checks: DataFrame, origins: DataFrame) -> DataFrame:
    return honesty_flags(checks).join(origins.select("origin", "phantom"), "origin").select(
        F.lower("origin").alias("host"), "price_ok", "payto_ok",
        F.coalesce("phantom", F.lit(False)).alias("phantom"))


def trusted_only(candidates: DataFrame, flags: DataFrame) -> DataFrame:
    """Candidates on hosts that were checked and found honest."""
    good = flags.where("price_ok AND payto_ok AND NOT phantom").select("host")
    return candidates.join(good, "host", "left_semi")


def payto_counts(checks: DataFrame) -> DataFrame:
    """How often each origin's challenges named each payment address."""
    paid = checks.where((F.col("status") == 402) & (F.col("live_payto") != "")
                        & ~is_burn(F.col("live_payto")))
    return paid.groupBy("origin", F.col("live_payto").alias("payto")).agg(F.count("*").alias("n"))


def probe_score(checks: DataFrame, origins: DataFrame) -> DataFrame:
    """Score 0-100 and grade per origin from conclusive checks, with notes and flags.

    Reachable 15, correct handshake 15, payable challenge 25, price honesty 15, payment
    address 10, machine-readable 6+4, speed 10/7/4/1, phantom paywall -30, free tier +3.
    Origins without a conclusive check are not rated.
    """
    paid = F.col("status") == 402
    comparable = paid & F.col("adv_amount").isNotNull() & F.col("live_amount").isNotNull()
    high = F.greatest("adv_amount", "live_amount")
    low = F.least("adv_amount", "live_amount")
    honest = comparable & ((high == 0) | ((high - low) / high <= 0.02))
    addressed = paid & (F.col("adv_payto") != "") & (F.col("live_payto") != "")
    gap = F.abs(F.col("live_amount") - F.col("adv_amount"))
    odd = F.col("status").isNotNull() & ~F.col("status").isin(402, 200)
    sample = F.when(paid & (F.col("body_sample") != ""), F.struct("url", "body_sample"))
    sure = is_conclusive()
    turned = checks.withColumn("_ms", F.when(paid, -F.col("ms").cast("double")))
    facts = turned.groupBy("origin").agg(  # one pass: every figure says which checks it counts
        F.count("*").alias("n_checked"), F.bool_or(F.col("status") == 200).alias("free_tier"),
        median_of_falling("_ms").alias("median_ms"),
        F.count_if(sure).alias("n"),
        F.count_if(sure & F.col("status").isNotNull()).alias("reached"),
        F.count_if(sure & paid).alias("paid"),
        F.count_if(sure & (F.col("status") == 200)).alias("open"),
        F.count_if(sure & odd).alias("odd"),
        F.min(F.when(sure & odd, F.col("status"))).alias("odd_code"),
        F.count_if(sure & paid & F.col("payable")).alias("payable"),
        F.min(F.when(sure, sample)).alias("sample"),
        F.count_if(sure & comparable).alias("comparable"), F.count_if(sure & honest).alias("honest"),
        F.min_by(F.struct("adv_amount", "live_amount"),
                 F.when(sure & comparable, F.struct((-gap).alias("g"), F.col("url")))).alias("worst"),
        F.count_if(sure & addressed).alias("addressed"),
        F.count_if(sure & addressed & (F.lower("adv_payto") == F.lower("live_payto"))).alias("same_payto"),
        F.bool_or(sure & paid & F.coalesce("schema", F.lit(False))).alias("has_schema"))
    rows = origins.join(facts, "origin", "left")
    n = F.coalesce("n", F.lit(0))
    c = {k: F.coalesce(k, F.lit(0)) for k in
         ("reached", "paid", "open", "odd", "payable", "comparable", "honest", "addressed", "same_payto")}
    rotates = F.coalesce("rotates_payto", F.lit(False))
    phantom = F.coalesce("phantom", F.lit(False))
    free_tier = F.coalesce("free_tier", F.lit(False))
    schema = F.coalesce("has_schema", F.lit(False))
    ms = F.col("median_ms")

    def part(points, top, bottom):
        return F.when(bottom > 0, F.lit(float(points)) * (top / bottom)).otherwise(0.0)

    raw = (
        part(15, c["reached"], n) + part(15, c["paid"] + c["open"], n)
        + part(25, c["payable"], c["paid"]) + part(15, c["honest"], c["comparable"])
        + F.when(rotates, 10.0).otherwise(part(10, c["same_payto"], c["addressed"]))
        + F.when(F.col("discoverable"), 6.0).otherwise(0.0) + F.when(schema, 4.0).otherwise(0.0)
        + F.when(ms.isNull(), 0.0).when(ms < 400, 10.0).when(ms < 1000, 7.0)
        .when(ms < 2500, 4.0).otherwise(1.0)
        - F.when(phantom, 30.0).otherwise(0.0) + F.when(free_tier, 3.0).otherwise(0.0))
    score = F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw))
    empty = F.trim(F.coalesce("sample.body_sample", F.lit(""))).isin("{}", "")
    why = F.when(empty, "empty body").otherwise("no payment requirements in the response")
    flags = F.array_compact(F.array(
        F.when(n == 0, fixed.FLAG_NO_RESOURCES),
        F.when((n > 0) & (c["reached"] < n), F.format_string(
            fixed.FLAG_UNREACHABLE, n - c["reached"], n)),
        F.when(c["odd"] > 0, F.format_string(fixed.FLAG_ODD_STATUS, c["odd"], F.col("odd_code"))),
        F.when((c["paid"] > 0) & (c["payable"] == 0), F.format_string(fixed.FLAG_NO_QUOTE, why)),
        F.when((c["payable"] > 0) & (c["payable"] < c["paid"]), F.format_string(
            fixed.FLAG_SOME_QUOTES, c["paid"] - c["payable"], c["paid"])),
        F.when(c["honest"] < c["comparable"], F.format_string(
            fixed.FLAG_PRICE, money_text(F.col("worst.adv_amount")),
            money_text(F.col("worst.live_amount")))),
        F.when(~rotates & (c["same_payto"] < c["addressed"]), fixed.FLAG_PAYTO),
        F.when(phantom, fixed.FLAG_PHANTOM)))
    notes = F.array_compact(F.array(
        F.when((c["paid"] > 0) & (c["payable"] == c["paid"]), fixed.NOTE_PAYABLE),
        F.when((c["comparable"] > 0) & (c["honest"] == c["comparable"]), fixed.NOTE_PRICE),
        F.when(rotates, fixed.NOTE_ROTATES),
        F.when(F.col("discoverable"), F.concat(
            F.lit("publishes "), F.array_join("discovery_paths", " and "))),
        F.when(schema, fixed.NOTE_SCHEMA),
        F.when(free_tier, fixed.NOTE_FREE)))
    rated = n > 0
    none = F.array().cast("array<string>")
    unrated = F.when(F.coalesce("n_checked", F.lit(0)) > 0, fixed.NOTE_UNASSESSED_CHECKED
                     ).otherwise(fixed.NOTE_UNASSESSED_UNLISTED)
    return rows.select(
        "origin", rated.alias("assessable"),
        F.when(rated, half_even(score, 1)).otherwise(0.0).alias("score"),
        F.when(rated, score_grade(score)).otherwise("?").alias("grade"),
        F.when(rated, notes).otherwise(F.array(unrated)).alias("notes"),
        F.when(rated, flags).otherwise(none).alias("flags"),
        ms.alias("median_ms"))


def adoption_tier(origins: DataFrame, as_of: str) -> DataFrame:
    """Is anyone buying? Settlement seen on chain overrides smaller registry counters."""
    chain = F.coalesce("settled_tx30d", F.lit(0)) > F.col("calls30d")
    calls = F.when(chain, F.col("settled_tx30d")).otherwise(F.col("calls30d"))
    payers = F.when(chain, F.coalesce("settled_buyers30d", F.lit(0))).otherwise(F.col("payers30d"))
    days = whole_days_since(F.col("last_called"), as_of)
    rated = origins.withColumn("_t", adoption(calls, payers, days))
    return rated.select(
        *origins.columns, F.col("_t.tier").alias("tier"), F.col("_t.why").alias("tier_why"),
        F.col("_t.wash_ratio").alias("wash_ratio"), days.alias("days_since_call"),
        F.when(chain, "settlement").otherwise("registry").alias("demand_source"))


def probe_rank(origins: DataFrame) -> DataFrame:
    """Origins in reading order: tier, settled dollars, calls, score."""
    order = F.lit(len(fixed.TIERS))
    for position, tier in reversed(list(enumerate(fixed.TIERS))):
        order = F.when(F.col("tier") == tier, position).otherwise(order)
    return origins.withColumn("tier_order", order).orderBy(
        "tier_order", F.desc(F.coalesce("settled_usd30d", F.lit(0.0))), F.desc("calls30d"),
        F.desc("score"), "origin")


def reliability(probe: DataFrame) -> DataFrame:
    """Payment-safety score 0-100 with its parts, from the probe mart's facts."""
    ms = F.col("median_ms")
    parts = {
        "responds": F.when(F.col("checked") > 0, half_even(
            F.lit(30.0) * F.col("returns_402") / F.col("checked"), 0)).otherwise(0.0).cast("bigint"),
        "price_honest": F.when(F.col("price_ok"), 25).otherwise(0),
        "payto_honest": F.when(F.col("payto_ok"), 25).otherwise(0),
        "real": F.when(F.col("phantom"), 0).otherwise(10),
        "fast": F.when(ms.isNull(), 5).when(ms <= 1000, 10).when(ms <= 3000, 6).otherwise(2),
    }
    total = sum(parts.values(), F.lit(0))
    return probe.select(*probe.columns, total.cast("bigint").alias("reliability"),
                        *[p.cast("bigint").alias(f"part_{k}") for k, p in parts.items()])


def probe_mart(checks: DataFrame, origins: DataFrame) -> DataFrame:
    """One published row per origin that answered: counts, honesty, up to five price
    mismatches (by URL), upper-median latency and reliability."""
    sure = is_conclusive()
    differs = price_differs(F.col("adv_amount"), F.col("live_amount"))
    moved = payto_differs(F.col("adv_payto"), F.col("live_payto"))
    turned = checks.withColumn("_ms", F.when(sure & (F.col("ms") != 0), -F.col("ms").cast("double")))
    facts = turned.groupBy("origin").agg(
        F.count_if(sure).alias("checked"), F.count_if(sure & (F.col("status") == 402)).alias("returns_402"),
        F.count_if(sure & F.col("payable")).alias("priceable"),
        (~F.coalesce(F.bool_or(sure & differs), F.lit(False))).alias("price_ok"),
        (~F.coalesce(F.bool_or(sure & moved), F.lit(False))).alias("payto_ok"),
        median_of_falling("_ms").alias("median_ms"),
        F.bool_or(F.col("status") == 200).alias("free_tier")).where("checked > 0")
    first5 = Window.partitionBy("origin").orderBy("url")
    wrong = checks.where(sure & differs).select("origin", "url", "adv_amount", "live_amount").withColumn(
        "rn", F.row_number().over(first5)).where("rn <= 5")
    wrong = wrong.groupBy("origin").agg(F.array_sort(F.collect_list(
        F.struct("url", F.col("adv_amount").alias("listed"), F.col("live_amount").alias("live"))
    )).alias("mismatches"))
    rows = (facts.join(origins.select("origin", "breadth", "phantom"), "origin")
            .join(wrong, "origin", "left"))
    return reliability(rows.select(
        F.col("origin").alias("host"), "breadth", "checked", "returns_402", "priceable",
        "price_ok", "payto_ok", F.coalesce("phantom", F.lit(False)).alias("phantom"),
        "median_ms", F.coalesce("free_tier", F.lit(False)).alias("free_tier"), "mismatches"))


def parse_challenge(responses: DataFrame) -> DataFrame:
    """Amount, address, network and schema flag asked for in a captured 402 response.

    Sources in order, each filling only what is still missing: body options (first one that
    can be priced), the body's own price object, a base64 header challenge, a
    ``requirements="…"`` challenge, and a ``request="…"`` challenge in 6-decimal units.
    Input: (id, body, payment_required, www_authenticate).
    """
    def decoded(text: Column) -> Column:
        padded = F.rpad(text, F.ceil(F.length(text) / 4).cast("int") * 4, F.lit("="))
        raw = F.try_to_binary(padded, F.lit("base64")).cast("string")
        return F.from_json(raw, schemas.CHALLENGE)

    auth = F.coalesce("www_authenticate", F.lit(""))
    rows = responses.select(
        "*",
        F.from_json("body", schemas.CHALLENGE).alias("_b"),
        decoded(F.nullif(F.coalesce("payment_required", F.lit("")), F.lit(""))).alias("_h"),
        decoded(F.nullif(F.regexp_extract(auth, 'requirements="([^"]+)"', 1), F.lit(""))).alias("_r"),
        decoded(F.when(F.lower(F.trim(auth)).startswith("payment"), F.nullif(
            F.regexp_extract(auth, 'request="([^"]+)"', 1), F.lit("")))).alias("_q"))

    def option(doc: str):
        """First option that can be priced, else the first one without an amount."""
        first = F.get(F.col(f"{doc}.accepts"), F.lit(0))
        best = first_priceable(F.col(f"{doc}.accepts"))
        return best, first

    def lead(doc: str):
        one = first_priceable(F.slice(F.col(f"{doc}.accepts"), 1, 1))
        first = F.get(F.col(f"{doc}.accepts"), F.lit(0))
        return one["usd"], pay_address(first), F.nullif(first["network"], F.lit(""))

    best, first = option("_b")
    body_payto = F.when(best.isNotNull(), best["payto"]).otherwise(
        pay_address(first))
    body_network = F.when(best.isNotNull(), best["network"]).otherwise(F.nullif(first["network"], F.lit("")))
    h_usd, h_payto, h_net = lead("_h")
    r_usd, r_payto, r_net = lead("_r")
    early = F.coalesce(best["usd"], F.col("_b.price.amount").try_cast("double"), h_usd, r_usd)
    asks = early.isNull() & F.col("_q").isNotNull()
    q_amount = F.col("_q.amount").try_cast("decimal(38,0)").cast("double") / 1e6
    return rows.select(
        *responses.columns,
        F.coalesce(early, F.when(asks, q_amount)).alias("amount"),
        F.coalesce(body_payto, h_payto, r_payto, F.when(asks, F.col("_q.recipient"))).alias("payto"),
        F.coalesce(body_network, F.when(best["usd"].isNull(), F.col("_b.paymentInfo.network")),
                   h_net, r_net, F.when(asks, F.lit("tempo"))).alias("network"),
        F.coalesce(F.col("_b.extensions.bazaar").isNotNull()
                   | F.col("_h.extensions.bazaar").isNotNull()
                   | F.col("_r.extensions.bazaar").isNotNull(), F.lit(False)).alias("schema"))
