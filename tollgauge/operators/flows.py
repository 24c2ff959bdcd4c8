"""Money flows: transfer logs to per-wallet tapes, funders and buyers."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions.chain import (
    hex_to_units, hex_value, is_burn, is_hex_quantity, topic_to_address)
from tollgauge.functions.numbers import half_even, usd
from tollgauge.operators.ranks import first_per
from tollgauge.operators.shapes import held


def decode_logs(logs: DataFrame, on_error: str = "drop") -> DataFrame:
    """Raw transfer logs to (payer, payee, units, block); other columns pass through.

    ``drop`` removes rows with an unreadable amount or block, ``zero`` counts an
    unreadable amount as nothing and keeps the row.
    """
    rest = [c for c in logs.columns if c not in ("topics", "data", "blockNumber")]
    # read once: a filter on what a log is made of would repeat its whole making at every mention
    read = held(logs.select(
        *rest, F.when(F.size("topics") >= 3, F.transform(F.slice("topics", 2, 2), topic_to_address)).alias("_sides"),
        hex_to_units(F.col("data"), on_error).alias("units"), hex_to_units(F.col("blockNumber")).alias("_block")),
        "_sides", "units", "_block")
    return read.where("_sides IS NOT NULL AND units IS NOT NULL AND _block IS NOT NULL").select(
        *rest, F.get("_sides", F.lit(0)).alias("payer"), F.get("_sides", F.lit(1)).alias("payee"),
        "units", F.col("_block").cast("bigint").alias("block"))


def rejected_logs(logs: DataFrame) -> DataFrame:
    """Raw logs that ``decode_logs`` cannot carry exactly, with the reason, so that none goes in
    silence: too few topics, an unreadable block or amount, or an amount above 124 bits."""
    wide = F.startswith("data", F.lit("0x")) & F.rlike(F.substring("data", 3, 64), F.lit("^[0-9a-fA-F]+$"))
    reason = (F.when(~F.coalesce(F.size("topics") >= 3, F.lit(False)), "topics")
              .when(~is_hex_quantity(F.col("blockNumber")), "block")
              .when(~is_hex_quantity(F.col("data")), F.when(
                  F.coalesce(wide & (F.length("data") <= 66), F.lit(False)), "amount above 124 bits").otherwise("amount")))
    return logs.withColumn("reason", reason).where("reason IS NOT NULL")


def drop_burn(df: DataFrame, col: str) -> DataFrame:
    return df.where(~is_burn(F.col(col)))


def inflow_to(transfers: DataFrame, wallets: DataFrame) -> DataFrame:
    return transfers.join(wallets.select(F.col("address").alias("payee")), "payee", "left_semi")


def outflow_from(transfers: DataFrame, wallets: DataFrame) -> DataFrame:
    return transfers.join(wallets.select(F.col("address").alias("payer")), "payer", "left_semi")


def _share(part: Column, total: Column, digits: int = 4) -> Column:
    divisor = F.when(total == 0, F.lit(1.0)).otherwise(total.cast("double"))
    return half_even(part.cast("double") / divisor, digits)


def _sum_of_squares(units: Column) -> Column:
    """Sum of squares of whole numbers up to 38 digits, as a double. The number is cut into three
    limbs of 13 digits; sums of limb products are exact in 38 digits, so order does not matter."""
    limb = F.lit(10 ** 13).cast("decimal(14,0)")
    low = (units % limb).cast("decimal(13,0)")
    rest = ((units - low) / limb).cast("decimal(25,0)")
    middle = (rest % limb).cast("decimal(13,0)")
    high = ((rest - middle) / limb).cast("decimal(12,0)")

    def total(a: Column, b: Column) -> Column:
        return F.sum((a * b).cast("decimal(28,0)")).cast("double")

    return (total(low, low) + 2e13 * total(low, middle) + 1e26 * (total(middle, middle) + 2 * total(low, high))
            + 2e39 * total(middle, high) + 1e52 * total(high, high))


def tape_aggregate(transfers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Demand of each payee and its shape: counts, dollars, payers, returning payers,
    shares of the top buyer and top five, Herfindahl index of dollars, block range.

    Two-level: payments are combined per (payee, payer) before anything is keyed on the
    payee alone, and the top five are cut map-side, so a payee that takes a third of all
    payments never meets in one task with its raw rows.
    """
    return tape_of_pairs(_pairs(transfers, by), by)


def tape_of_pairs(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same from payments that are combined per (payee, payer) already."""
    keys = [*by, "payee"]
    pairs = drop_burn(pairs, "payee")
    total = F.sum("u")
    squares = _sum_of_squares(F.col("u"))
    shape = pairs.groupBy(*keys).agg(
        F.sum("n").alias("settlements"),
        total.alias("units"),
        F.count("*").alias("unique_payers"),
        F.count_if(F.col("n") > 1).alias("repeat_payers"),
        _share(F.max("u"), total).alias("top_payer_share"),
        squares.alias("_sq"),
        F.min("b0").alias("first_block"), F.max("b1").alias("last_block"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("u"), "payer"))
    top5 = (pairs.select(*keys, "payer", "u").withColumn("rn", rank).where("rn <= 5")
            .groupBy(*keys).agg(F.sum("u").alias("_u5")))
    total_sq = F.when(F.col("units") == 0, F.lit(1.0)).otherwise(
        F.col("units").cast("double") * F.col("units").cast("double"))
    return shape.join(top5, keys).select(
        *keys, "settlements", "units",
        half_even(usd(F.col("units")), 6).alias("usdc"),
        "unique_payers", "repeat_payers", "top_payer_share",
        _share(F.col("_u5"), F.col("units")).alias("top5_payer_share"),
        half_even(F.col("_sq") / total_sq, 4).alias("payer_hhi"),
        "first_block", "last_block")


def outflow_aggregate(transfers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Money leaving each payer. Burns count here: only receipts exclude them."""
    return transfers.groupBy(*by, "payer").agg(
        F.count("*").alias("transfers_out"), F.sum("units").alias("units_out"))


def merge_flows(inflow: DataFrame, outflow: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Receipts and payments of one wallet in one row, zeros for the missing side."""
    keys = [*by, "address"]
    zero = F.lit(0).cast("decimal(38,0)")
    joined = inflow.withColumnRenamed("payee", "address").join(
        outflow.withColumnRenamed("payer", "address"), keys, "full_outer")
    units = F.coalesce("units", zero)
    units_out = F.coalesce("units_out", zero)
    return joined.select(
        *keys,
        F.coalesce("settlements", F.lit(0)).alias("settlements"),
        units.cast("decimal(38,0)").alias("units"),
        units_out.cast("decimal(38,0)").alias("units_out"),
        half_even(usd(units), 6).alias("usdc"),
        half_even(usd(units_out), 6).alias("usdc_out"),
        half_even(usd(units - units_out), 6).alias("usdc_net"),
        F.coalesce("transfers_out", F.lit(0)).alias("transfers_out"),
        F.coalesce("unique_payers", F.lit(0)).alias("unique_payers"),
        F.coalesce("repeat_payers", F.lit(0)).alias("repeat_payers"),
        "top_payer_share", "top5_payer_share", "payer_hhi", "first_block", "last_block")


def dated_tape(transfers: DataFrame, wallets: DataFrame) -> DataFrame:
    """The settlement tape: one row per collected date and tracked wallet. Transfers are
    combined per (date, payee, payer) before any join, so a hot wallet's raw rows never meet."""
    return tape_of_dated_pairs(dated_pairs(transfers), wallets)


def dated_pairs(transfers: DataFrame) -> DataFrame:
    """Transfers combined per (date, payer, payee)."""
    return _pairs(transfers, ["date"])


def tape_of_dated_pairs(pairs: DataFrame, wallets: DataFrame) -> DataFrame:
    """The tape from combined transfers. They are asked three times (both sides and the top five), so a caller with many keeps them written."""
    out = outflow_from(pairs, wallets).groupBy("date", "payer").agg(
        F.sum("n").alias("transfers_out"), F.sum("u").alias("units_out"))
    return merge_flows(tape_of_pairs(inflow_to(pairs, wallets), ["date"]), out, ["date"])


def service_wallets(services: DataFrame, tape: DataFrame) -> DataFrame:
    """Every wallet of every service with that wallet's tape row."""
    wallets = services.select(
        F.col("origin").alias("service"), F.explode("payto").alias("address"))
    wallets = wallets.select("service", F.lower("address").alias("address")).distinct()
    return wallets.join(tape, "address")


def service_rollup(wallets: DataFrame) -> DataFrame:
    """Sum of a service's wallets. Payers are summed too, not united."""
    return wallets.groupBy("service").agg(
        F.sum("settlements").alias("settlements"),
        half_even(usd(F.sum("units")), 6).alias("usdc"),
        half_even(usd(F.sum("units_out")), 6).alias("usdc_out"),
        half_even(usd(F.sum("units") - F.sum("units_out")), 6).alias("usdc_net"),
        F.sum("unique_payers").alias("unique_payers"))


def wallet_inflow(credits: DataFrame, since: int, until: int) -> DataFrame:
    """Receipts per wallet on a chain read from balance changes: only positive changes of
    transactions that did not fail and lie inside the window."""
    kept = credits.where((F.col("delta") > 0) & ~F.coalesce("failed", F.lit(False))
                         & F.col("block_time").between(since, until))
    pairs = kept.groupBy("wallet", "payer").agg(
        F.count("*").alias("n"), F.sum(F.col("delta").cast("decimal(20,6)")).alias("d"))
    return pairs.groupBy("wallet").agg(
        F.sum("n").alias("settlements"),
        half_even(F.sum("d").cast("double"), 6).alias("usdc"),
        F.count("payer").alias("unique_payers"))


def sample_velocity(transfers: DataFrame, as_of: int, page: int = 100) -> DataFrame:
    """Rates per wallet from its newest ``page`` transfers; only receipts count, and a full
    page marks the rate as a floor. Input: (address, payer, payee, units, ts, seq)."""
    newest = Window.partitionBy("address").orderBy(F.desc("ts"), F.desc("seq"))
    sample = transfers.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= page)
    inbound = F.col("payee") == F.col("address")
    facts = sample.groupBy("address").agg(
        F.count("*").alias("sampled"),
        F.count_if(inbound).alias("settlements"),
        F.count_distinct(F.when(inbound, F.col("payer"))).alias("unique_payers"),
        F.sum(F.when(inbound, F.col("units"))).alias("units"),
        F.min(F.when(inbound, F.col("ts"))).alias("first_ts"),
        F.max(F.when(inbound, F.col("ts"))).alias("last_ts"))
    hours = F.greatest(F.lit(1e-9), (F.col("last_ts") - F.col("first_ts")) / 3600)
    several = F.col("settlements") > 1
    some = F.col("settlements") > 0
    total = usd(F.col("units"))
    return facts.select(
        "address", "sampled", "settlements", "unique_payers",
        F.when(some, F.col("sampled") >= page).alias("truncated"),
        half_even(hours, 3).alias("window_hours"),
        half_even(total, 4).alias("usdc_in_sample"),
        F.when(some, half_even(total / F.col("settlements"), 6)).alias("avg_ticket"),
        "first_ts", "last_ts",
        half_even((F.lit(as_of) - F.col("last_ts")) / 3600, 1).alias("hours_since_last"),
        F.when(some, F.when(several, half_even(F.col("settlements") / hours * 24, 1))
               .otherwise(0.0)).alias("settlements_per_day"),
        F.when(some, F.when(several, half_even(total / hours * 24, 4))
               .otherwise(0.0)).alias("usd_per_day"))


def velocity_rollup(velocity: DataFrame, services: DataFrame) -> DataFrame:
    wallets = services.select(
        F.col("origin").alias("service"), F.explode("payto").alias("address"))
    wallets = wallets.select("service", F.lower("address").alias("address")).distinct()
    live = velocity.where("settlements > 0")
    dec = "decimal(28,4)"
    return wallets.join(live, "address").groupBy("service").agg(
        F.sum("settlements").alias("settlements_sampled"),
        F.max("unique_payers").alias("unique_payers"),
        F.sum(F.col("settlements_per_day").cast(dec)).cast("double").alias("settlements_per_day"),
        F.sum(F.col("usd_per_day").cast(dec)).cast("double").alias("usd_per_day"),
        F.min("avg_ticket").alias("avg_ticket"),
        F.min("hours_since_last").alias("hours_since_last"),
        F.bool_or("truncated").alias("truncated"))


def _pairs(transfers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return transfers.groupBy(*by, "payer", "payee").agg(
        F.count("*").alias("n"), F.sum("units").alias("u"),
        F.min("block").alias("b0"), F.max("block").alias("b1"))


def funders(transfers: DataFrame, min_payees: int = 5) -> DataFrame:
    """Wallets that pay many distinct listed endpoints."""
    per = _pairs(transfers).groupBy("payer").agg(
        F.count("*").alias("payees"), F.sum("n").alias("pays"), F.sum("u").alias("u"),
        F.min("b0").alias("first_block"), F.max("b1").alias("last_block"))
    return per.where(F.col("payees") >= min_payees).select(
        "payer", "payees", "pays", half_even(usd(F.col("u")), 6).alias("usdc"),
        half_even(usd(F.col("u")) / F.col("pays"), 6).alias("avg_payment"),
        "first_block", "last_block",
    ).orderBy(F.desc("payees"), F.desc("pays"), "payer")


def funder_detail(transfers: DataFrame, payer: str, owners: DataFrame) -> DataFrame:
    """What one wallet paid, per payee, with the payee's owner ('?' when unlisted)."""
    paid = transfers.where(F.col("payer") == payer).groupBy("payee").agg(F.count("*").alias("pays"))
    named = paid.join(owners.withColumnRenamed("address", "payee"), "payee", "left")
    return named.select("payee", "pays", F.coalesce("host", F.lit("?")).alias("host")
                        ).orderBy(F.desc("pays"), "payee")


def buyer_census(transfers: DataFrame, services: DataFrame) -> DataFrame:
    """Each buyer of the given services (address, service): dollars, payments, breadth and
    the service it paid most often."""
    top = services.withColumnRenamed("address", "payee")
    pairs = _pairs(transfers).join(top.select("payee"), "payee", "left_semi")  # combined before it is keyed on a payee
    per = pairs.groupBy("payer").agg(
        F.sum("u").alias("u"), F.sum("n").alias("payments"),
        F.count("*").alias("distinct_services"),
        F.min(F.struct((-F.col("n")).alias("k"), F.col("payee"))).alias("_top"))
    rows = per.select(
        F.col("payer").alias("wallet"), F.col("u").alias("units"),
        half_even(usd(F.col("u")), 4).alias("usdc"), "payments", "distinct_services",
        F.col("_top.payee").alias("payee"), (-F.col("_top.k")).alias("top_recipient_payments"))
    return rows.join(top, "payee", "left").select(
        "wallet", "units", "usdc", "payments", "distinct_services",
        F.col("payee").alias("top_recipient"),
        F.col("service").alias("top_recipient_service"), "top_recipient_payments")


def census_summary(buyers: DataFrame) -> DataFrame:
    """Market concentration on the buying side, one row."""
    top5 = buyers.orderBy(F.desc("usdc"), "wallet").limit(5).select(
        "usdc", F.lit(0).cast("bigint").alias("payments"), F.lit(True).alias("head"))
    both = buyers.select("usdc", "payments", F.lit(False).alias("head")).unionByName(top5)
    money = F.col("usdc").cast("decimal(28,4)")
    total = F.sum(F.when(~F.col("head"), money)).cast("double")
    head = F.sum(F.when(F.col("head"), money)).cast("double")
    return both.agg(
        F.count_if(~F.col("head")).alias("buyers"),
        half_even(total, 2).alias("total_usdc"),
        F.sum("payments").alias("total_payments"),
        F.when(total != 0, half_even(F.max("usdc") / total, 4)).alias("top_buyer_share"),
        F.when(total != 0, half_even(head / total, 4)).alias("top5_share"))


def token_inflow(transactions: DataFrame, mint: str = fixed.USDC_SOLANA) -> DataFrame:
    """Credit of ``account`` in each balance-change transaction, and who paid it.

    Input: (account, keys array<string>, pre, post array<struct<accountIndex, mint, owner,
    uiAmount>>). The payer is the first other account that fell by at least the credit.
    Evaluated row by row on the arrays, so nothing is shuffled.
    """
    def amount(balances: str, index: Column) -> Column:
        hit = F.filter(balances, lambda b: (b["accountIndex"] == index) & (b["mint"] == mint))
        return F.coalesce(F.get(F.transform(hit, lambda b: b["uiAmount"]), F.lit(0)), F.lit(0.0))

    index = (F.array_position("keys", F.col("account")) - 1).cast("int")
    named = transactions.withColumn("_i", index)
    listed = F.exists("post", lambda b: (b["accountIndex"] == F.col("_i")) & (b["mint"] == mint))
    delta = F.when(listed, amount("post", F.col("_i")) - amount("pre", F.col("_i"))).otherwise(0.0)
    rated = named.withColumn("delta", F.greatest(delta, F.lit(0.0)))
    losers = F.filter("post", lambda b: (
        (b["mint"] == mint) & (b["accountIndex"] != F.col("_i"))
        & (amount("pre", b["accountIndex"]) - b["uiAmount"] >= F.col("delta") - 1e-9)))
    return rated.withColumn(
        "payer", F.when(F.col("delta") > 0, F.get(losers, F.lit(0))["owner"])).drop("_i")


def payto_owner(listings: DataFrame) -> DataFrame:
    """First host, in listing order, that names each payment address."""
    pairs = listings.select(
        "ordinal", "host", F.posexplode(F.transform("accepts", lambda a: F.lower(a["payTo"]))))
    named = pairs.where((F.col("col") != "") & (F.col("host") != "")).select(
        F.col("col").alias("address"), "host", "ordinal", "pos")
    return first_per(named, ["address"], F.col("ordinal"), F.col("pos")).select("address", "host")
