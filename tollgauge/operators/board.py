"""The revenue board: windows over the tape, attribution, scores and ranking."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions.chain import is_burn
from tollgauge.functions.demand import demand_label, organic_score
from tollgauge.functions.numbers import half_even, usd
from tollgauge.operators.ranks import first_per


def newest_dates(tape: DataFrame, n: int) -> DataFrame:
    """The n most recent collected dates (not calendar days)."""
    return tape.select("date").distinct().orderBy(F.desc("date")).limit(n)


def newest_days(tape: DataFrame, n: int) -> DataFrame:
    """Tape rows of the n most recent collected dates. The date list has at most n rows,
    so it is broadcast, and on a tape partitioned by date it prunes the scan."""
    return tape.join(F.broadcast(newest_dates(tape, n)), "date", "left_semi")


def window_rollup(tape: DataFrame, n: int) -> DataFrame:
    """Sums over the window; payers and concentration are the worst day, never a union."""
    days = newest_days(tape, n).where(~is_burn(F.col("address")))
    return days.groupBy(F.lower("address").alias("address")).agg(
        F.sum("settlements").alias("settlements"),
        F.sum("units").alias("units"), F.sum("units_out").alias("units_out"),
        F.max("unique_payers").alias("payers"), F.max("repeat_payers").alias("repeat_payers"),
        F.max("top_payer_share").alias("top_payer_share"),
        F.max("top5_payer_share").alias("top5_payer_share"),
        F.max("payer_hhi").alias("payer_hhi"))


def window_coverage(tape: DataFrame, n: int) -> DataFrame:
    return newest_dates(tape, n).agg(
        F.lit(n).cast("bigint").alias("days_wanted"), F.count("*").alias("days_have"),
        (F.count("*") >= n).alias("complete"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def noise_count(host, words=fixed.HOSTING_NOISE):
    total = F.lit(0)
    for word in words:
        total = total + host.contains(word).cast("int")
    return total


def best_listing(services: DataFrame) -> DataFrame:
    """One best service per payment address: least hosting noise, fewest dashes, shortest
    name, then name. ``shares`` counts the services that name the wallet."""
    host = F.lower("origin")
    named = services.select(
        F.explode(F.transform("payto", lambda a: F.lower(a))).alias("address"),
        "origin", "service", "grade",
        noise_count(host).alias("_noise"),
        (F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit("")))).alias("_dashes"))
    named = named.where((F.col("address") != "") & ~is_burn(F.col("address"))).distinct()
    order = F.struct("_noise", "_dashes", F.length("origin"), "origin")
    return named.groupBy("address").agg(
        F.min_by(F.struct("origin", "service", "grade"), order).alias("_b"),
        F.count("*").alias("shares"),
    ).select(
        "address", F.coalesce("_b.service", "_b.origin").alias("service"),
        F.col("_b.origin").alias("host"), F.col("_b.grade").alias("grade"), "shares")


def attribute(window: DataFrame, services: DataFrame) -> DataFrame:
    """Window rows with the service that asks for payment at the address, if any."""
    return window.join(best_listing(services), "address", "left").select(
        *[window[c] for c in window.columns],
        F.coalesce("service", F.concat(F.substring("address", 1, 10), F.lit("…"))).alias("service"),
        F.coalesce("host", F.lit("")).alias("host"), "grade",
        F.coalesce(F.col("shares") > 1, F.lit(False)).alias("shared_wallet"))


def board_rows(window: DataFrame, services: DataFrame) -> DataFrame:
    """Board rows of one window on the first chain."""
    rows = attribute(window, services)
    received, out = F.col("units").cast("double"), F.col("units_out").cast("double")
    earned = F.col("units") > 0
    score = organic_score(F.col("payers"), F.col("repeat_payers"), F.col("top_payer_share"),
                          F.col("payer_hhi"), F.col("settlements"))
    scored = rows.withColumn("_s", score)
    return scored.select(
        "address", "service", "host", "grade", "shared_wallet", "units", "units_out",
        half_even(usd(F.col("units")), 4).alias("usdc"),
        half_even(usd(F.col("units_out")), 4).alias("usdc_out"),
        half_even(usd(F.col("units") - F.col("units_out")), 4).alias("kept"),
        F.when(earned, half_even(100 * out / received, 1)).alias("payout_pct"),
        F.coalesce(F.when(earned, out / received >= 0.9), F.lit(False)).alias("circular"),
        "settlements", "payers",
        F.when(F.col("settlements") > 0,
               half_even(usd(F.col("units")) / F.col("settlements"), 6)).alias("avg_ticket"),
        "repeat_payers", "top_payer_share", "top5_payer_share", "payer_hhi",
        demand_label(F.col("payers"), F.col("top_payer_share"), F.col("payer_hhi")).alias("demand"),
        F.col("_s.score").alias("organic_score"), F.col("_s.breadth").alias("organic_breadth"),
        F.col("_s.dispersion").alias("organic_dispersion"),
        F.col("_s.repeat").alias("organic_repeat"),
        F.col("_s.confidence").alias("organic_confidence"),
        F.lit("base").alias("demand_measured_on"),
        half_even(usd(F.col("units")), 4).alias("base_usdc"))


def host_rollup(tape: DataFrame, n: int) -> DataFrame:
    """Second chain per host over its own n newest collected dates ('?' hosts skipped)."""
    days = newest_days(tape, n).where(F.col("host") != "?")
    return days.groupBy("host").agg(
        F.sum("units").alias("units"), F.sum("settlements").alias("settlements"),
        F.max("unique_payers").alias("payers"), F.count_distinct("date").alias("days"))


def fold_chain(board: DataFrame, other: DataFrame, chain: str = "solana") -> DataFrame:
    """Fold a second chain into the board by host.

    A host's revenue lands on one row (its lowest address); hosts seen only there are
    appended. Money columns refresh, the demand shape stays measured on the first chain.
    """
    heads = board.where("host != ''").groupBy("host").agg(F.min("address").alias("address"))
    extra = other.join(heads, "host", "left").select(
        F.col("host").alias("o_host"), F.col("address").alias("o_address"),
        half_even(usd(F.col("units")), 4).alias("o_usdc"),
        F.col("settlements").alias("o_settlements"), F.col("payers").alias("o_payers"))
    both = board.join(
        extra, (F.col("address") == F.col("o_address")) & (F.col("host") == F.col("o_host")),
        "full_outer")
    added = F.col("address").isNull()
    touched = F.col("o_host").isNotNull()
    usdc = F.when(touched, half_even(F.coalesce("usdc", F.lit(0.0)) + F.col("o_usdc"), 4)
                  ).otherwise(F.col("usdc"))
    out = F.coalesce("usdc_out", F.lit(0.0))
    count = F.coalesce("settlements", F.lit(0)) + F.coalesce("o_settlements", F.lit(0))
    lone = organic_score(F.col("o_payers"), F.lit(0), F.lit(None).cast("double"),
                         F.lit(None).cast("double"), F.col("o_settlements"))
    folded = both.select(
        "address",
        F.coalesce("service", "o_host").alias("service"), F.coalesce("host", "o_host").alias("host"),
        "grade", F.coalesce("shared_wallet", F.lit(False)).alias("shared_wallet"),
        usdc.alias("usdc"), out.alias("usdc_out"),
        F.when(touched, half_even(usdc - out, 4)).otherwise(F.col("kept")).alias("kept"),
        F.when(added, F.lit(None)).when(
            touched, F.when(usdc != 0, half_even(100 * out / usdc, 1))
        ).otherwise(F.col("payout_pct")).alias("payout_pct"),
        F.coalesce("circular", F.lit(False)).alias("circular"),
        count.alias("settlements"), F.coalesce("payers", "o_payers").alias("payers"),
        F.when(touched, F.when(count > 0, half_even(usdc / count, 6))
               ).otherwise(F.col("avg_ticket")).alias("avg_ticket"),
        F.coalesce("repeat_payers", F.lit(0)).alias("repeat_payers"),
        "top_payer_share", "top5_payer_share", "payer_hhi",
        F.when(added, demand_label(F.col("o_payers"), F.lit(None).cast("double"),
                                   F.lit(None).cast("double"))).otherwise(F.col("demand")).alias("demand"),
        F.when(~added, F.col("organic_score")).alias("organic_score"),
        F.when(added, lone["breadth"]).otherwise(F.col("organic_breadth")).alias("organic_breadth"),
        F.when(~added, F.col("organic_dispersion")).alias("organic_dispersion"),
        F.when(added, lone["repeat"]).otherwise(F.col("organic_repeat")).alias("organic_repeat"),
        F.when(added, lone["confidence"]).otherwise(F.col("organic_confidence"))
        .alias("organic_confidence"),
        F.when(added, F.lit(chain)).otherwise(F.col("demand_measured_on")).alias("demand_measured_on"),
        F.coalesce("base_usdc", F.lit(0.0)).alias("base_usdc"),
        F.coalesce("o_usdc", F.lit(0.0)).alias("other_usdc"),
        F.coalesce("o_settlements", F.lit(0)).cast("bigint").alias("other_settlements"),
        F.coalesce("o_payers", F.lit(0)).cast("bigint").alias("other_payers"))
    return folded


def market_totals(board: DataFrame) -> DataFrame:
    """Totals of the whole board, before any rank cut."""
    def money(col):
        return F.col(col).cast("decimal(28,4)")
    return board.agg(
        half_even(F.sum(money("usdc")).cast("double"), 2).alias("total_usdc"),
        half_even(F.sum(money("kept")).cast("double"), 2).alias("total_kept"),
        F.sum("settlements").alias("total_settlements"),
        half_even(F.coalesce(F.sum(F.when(F.col("host") == "", money("usdc"))), F.lit(0))
                  .cast("double"), 2).alias("unattributed_usdc"))


def board_rank(board: DataFrame, k: int = 60) -> DataFrame:
    """Top k named services by revenue. The cut runs before the rank number is assigned, so
    the ranking window sees k rows."""
    top = board.where("host != ''").orderBy(F.desc("usdc"), "host", "address").limit(k)
    return _numbered(top, F.desc("usdc"), F.col("host"), F.col("address"))


def _numbered(few: DataFrame, *order) -> DataFrame:
    """Rank numbers for a handful of rows that a limit has already bounded."""
    return few.withColumn("rank", F.row_number().over(
        Window.partitionBy(F.lit(1)).orderBy(*order)).cast("bigint"))


def best_per_host(board: DataFrame) -> DataFrame:
    """First board row of each host, by revenue."""
    named = board.where("host != ''")
    return first_per(named, ["host"], -F.col("usdc"), F.coalesce(F.col("address"), F.lit("")))


def claim_vs_chain(listings: DataFrame, board: DataFrame) -> DataFrame:
    """Calls the directory credits a host with against settlements seen on chain."""
    claimed = listings.where("host != ''").groupBy("host").agg(
        F.sum(F.coalesce("calls30d", F.lit(0))).alias("calls30d"))
    seen = board.where("host != ''").groupBy("host").agg(F.sum("settlements").alias("settlements"))
    return claimed.join(seen, "host").where("calls30d > 0 AND settlements > 0")


def chain_sum_errors(board: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Rows whose chains do not add up to the amount received."""
    diff = F.abs(F.col("base_usdc") + F.col("other_usdc") - F.col("usdc"))
    return board.where(diff >= tolerance).select("host", "address", diff.alias("diff"))
