"""Snapshots over time: diffs, first sightings, arrivals and their novelty."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions.text import tidy_text
from tollgauge.functions.urls import host_of, url_path
from tollgauge.operators.ranks import first_per


def latest_index(index: DataFrame, before: str | None = None) -> DataFrame:
    """Rows of the newest snapshot at or before a date. On a table partitioned by date the
    one-row date lookup prunes the scan."""
    dated = index if before is None else index.where(F.col("date") <= before)
    newest = dated.agg(F.max("date").alias("date"))
    return dated.join(F.broadcast(newest), "date", "left_semi")


def index_diff(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Change per URL: new (on a new or known host), gone, or repriced."""
    old = prev.select("url", F.col("host").alias("p_host"), F.col("amount").alias("p_amount"),
                      F.lit(True).alias("p"))
    known = prev.select("host").distinct().withColumn("known", F.lit(True))
    # asked before the snapshots meet: all that is gone has no new host, and would be one key
    new = cur.select("url", "host", "amount", F.lit(True).alias("c")).join(known, "host", "left")
    rows = new.join(old, "url", "full_outer")
    priced = (F.col("amount") != "") & (F.col("p_amount") != "")
    change = (
        F.when(F.col("p").isNull() & F.col("known").isNull(), "new on new host")
        .when(F.col("p").isNull(), "new on known host")
        .when(F.col("c").isNull(), "gone")
        .when(priced & (F.col("amount") != F.col("p_amount")), "repriced"))
    return rows.select("url", F.coalesce("host", "p_host").alias("host"),
                       "p_amount", "amount", change.alias("change")).where("change IS NOT NULL")


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("change").agg(
        F.count("*").alias("urls"), F.count_distinct("host").alias("hosts"))


def update_first_seen(first: DataFrame, cur: DataFrame, date: str,
                      seed: DataFrame | None = None, seed_date: str | None = None) -> DataFrame:
    """Earliest date of every URL. ``seed`` is the previous snapshot, used on the first run so
    that an existing catalogue is not stamped as new."""
    rows = first.select("url", "date").unionByName(cur.select("url", F.lit(date).alias("date")))
    if seed is not None:
        rows = rows.unionByName(seed.select("url", F.lit(seed_date).alias("date")))
    return rows.groupBy("url").agg(F.min("date").alias("date"))


def host_first_seen(first: DataFrame) -> DataFrame:
    return first.withColumn("host", host_of(F.col("url"))).where("host != ''").groupBy("host").agg(
        F.min("date").alias("date"))


def arrival_endpoints(index: DataFrame, first: DataFrame, date: str) -> DataFrame:
    """URLs first seen on ``date``, with whether their host was unknown before."""
    dated = index.join(first.withColumnRenamed("date", "first_date"), "url")
    known = dated.where(F.col("first_date") < date).select("host").distinct()
    fresh = dated.where(F.col("first_date") == date)
    named = F.when(F.col("service") != "", F.col("service")).otherwise(F.col("host"))
    return fresh.join(known.withColumn("_k", F.lit(True)), "host", "left").select(
        F.lit(date).alias("date"), "host", named.alias("service"), "url",
        url_path(F.col("url")).alias("path"), "descr", "amount", "calls30d",
        F.col("_k").isNull().alias("new_service"))


def arrivals(endpoints: DataFrame) -> DataFrame:
    """Arrivals per (date, host). The endpoints themselves stay rows of their own table, so a
    host that lists a third of the market is never gathered into one row; what the reader
    needs from them (count, best endpoint, unusual words) is aggregated."""
    text = F.lower(F.coalesce("descr", F.lit("")))
    words = F.regexp_extract_all(text, F.lit(fixed.CURIOUS_PATTERN), F.lit(0))
    best = F.struct((-F.col("calls30d")).alias("k"), F.col("url"))
    base = endpoints.groupBy("date", "host").agg(
        F.count("*").alias("n_endpoints"), F.max_by("service", "url").alias("service"),
        F.max("calls30d").alias("calls30d"), F.bool_and("new_service").alias("new_service"),
        F.bool_and(F.trim(text) == "").alias("undescribed"),
        F.min_by(F.struct("url", "descr", "calls30d"), best).alias("_b"))
    unusual = (endpoints.select("date", "host", F.explode(words).alias("w")).distinct()
               .groupBy("date", "host").agg(F.array_sort(F.collect_list("w")).alias("unusual")))
    return base.join(unusual, ["date", "host"], "left").select(
        "date", "host", "service", "n_endpoints", "calls30d", "new_service", "undescribed",
        F.coalesce("unusual", F.array().cast("array<string>")).alias("unusual"),
        F.col("_b.url").alias("best_url"), F.col("_b.descr").alias("best_descr"),
        F.col("_b.calls30d").alias("best_calls"))


def novelty(rows: DataFrame) -> DataFrame:
    """Score arrivals by how much a reader would care, with reasons."""
    calls = F.coalesce("calls30d", F.lit(0))
    n_hits = F.size("unusual")
    score = (
        F.when(F.col("new_service"), 3.0).otherwise(0.0)
        + F.when(calls > 0, 2 + F.least(calls / 100, F.lit(3.0))).otherwise(0.0)
        + 1.5 * F.least(n_hits, F.lit(3))
        + F.when(F.col("n_endpoints") >= 5, 1.0).otherwise(0.0)
        - F.when(F.col("undescribed"), 2.0).otherwise(0.0))
    why = F.array_compact(F.array(
        F.when(F.col("new_service"), "new service, not another endpoint on a known one"),
        F.when(calls > 0, F.concat(F.lit("already taking paid calls ("), F.format_number(calls, 0),
                                   F.lit(" in 30d)"))),
        F.when(n_hits > 0, F.concat(F.lit("sells something unusual: "),
                                    F.array_join(F.slice("unusual", 1, 4), ", "))),
        F.when(F.col("n_endpoints") >= 5, F.concat(
            F.lit("arrived with "), F.col("n_endpoints").cast("string"),
            F.lit(" endpoints at once"))),
        F.when(F.col("undescribed"), "no description published")))
    return rows.select(*rows.columns, score.alias("score"), why.alias("why"))


def top_arrivals(rows: DataFrame, k: int = 3) -> DataFrame:
    return novelty(rows).orderBy(F.desc("score"), "host").limit(k)


def rolling_newest(existing: DataFrame, today: DataFrame, date: str, cap: int = 400) -> DataFrame:
    """Newest arrivals first: today's rows replace earlier rows of the same date, and the
    list keeps ``cap`` rows."""
    kept = existing.where(F.col("date") != date)
    return today.unionByName(kept).orderBy(
        F.desc("date"), F.desc("n_endpoints"), "host").limit(cap)


def daily_brief(rows: DataFrame, date: str, previous: str | None) -> DataFrame:
    """One row of totals for the day's arrivals plus the comparison date."""
    day = rows.where(F.col("date") == date)
    return day.agg(
        F.sum("n_endpoints").alias("endpoints"), F.count("*").alias("services"),
        F.count_if("new_service").alias("new_services")
    ).select(F.lit(date).alias("date"), F.lit(previous).alias("since"), "*")


def brief_bullets(rows: DataFrame, k: int = 3) -> DataFrame:
    """Text line for each of the day's picks."""
    picks = top_arrivals(rows, k)
    label = F.when(F.lower("service") == F.lower("host"), F.col("service")).otherwise(
        F.concat("service", F.lit(" ("), "host", F.lit(")")))
    said = tidy_text(F.col("best_descr"))
    used = F.when(F.col("best_calls") > 0, F.concat(
        F.lit(" Already taking money: "), F.format_number("best_calls", 0), F.lit(" paid calls."))
    ).otherwise("")
    return picks.select("host", "score", F.concat(
        label, F.lit(" — "), F.when(said != "", said).otherwise("no description published"),
        F.lit("."), used).alias("line"))


def day_brief(board: DataFrame, rows: DataFrame) -> DataFrame:
    """Compact day view: top 8 services by money and the 5 most called new services of the
    newest arrival day."""
    money = board.where("host != ''").orderBy(F.desc("usdc"), "host", "address").limit(8).select(
        F.lit("money").alias("section"), "host", F.col("usdc").alias("amount"),
        F.col("settlements").alias("calls"))
    newest = rows.agg(F.max("date").alias("date"))
    fresh = rows.where("new_service").join(F.broadcast(newest), "date", "left_semi")
    new = fresh.orderBy(F.desc("calls30d"), "host").limit(5).select(
        F.lit("new").alias("section"), "host", F.lit(None).cast("double").alias("amount"),
        F.col("calls30d").alias("calls"))
    both = money.unionByName(new)
    order = Window.partitionBy("section").orderBy(F.desc_nulls_last("amount"), F.desc("calls"), "host")
    return both.withColumn("rank", F.row_number().over(order).cast("bigint"))


def tape_gaps(tape: DataFrame) -> DataFrame:
    """Calendar days between the first and last collected day that were not collected."""
    have = tape.select(F.col("date").cast("date").alias("d")).distinct()
    span = have.agg(F.min("d").alias("a"), F.max("d").alias("z"))
    want = span.where("a IS NOT NULL").select(F.explode(F.sequence("a", "z")).alias("d"))
    return want.join(have, "d", "left_anti").select(F.col("d").cast("string").alias("missing_date"))


def wallet_trend(tape: DataFrame) -> DataFrame:
    """Direction of each wallet's daily dollars over all collected days, zero when absent:
    first against last day at 15%, with at least three days collected.

    Only the first and the last collected day decide, so no wallet-by-day grid is built. An
    address that is on neither of them has no ``days`` value, which can only happen when at
    least three days were collected.
    """
    span = tape.agg(F.min("date").alias("a"), F.max("date").alias("z"),
                    F.count_distinct("date").alias("days"))
    ends = span.select("days", F.explode(F.array(
        F.struct(F.col("a").alias("date"), F.lit("a").alias("end")),
        F.struct(F.col("z").alias("date"), F.lit("z").alias("end")))).alias("e")).select(
        "days", "e.date", "e.end")
    money = F.bround("usdc", 2)
    per = tape.join(F.broadcast(ends), "date", "left").groupBy("address").agg(
        F.max("days").alias("days"),
        F.coalesce(F.max(F.when(F.col("end") == "a", money)), F.lit(0.0)).alias("first_usdc"),
        F.coalesce(F.max(F.when(F.col("end") == "z", money)), F.lit(0.0)).alias("last_usdc"))
    way = (F.when(F.col("last_usdc") > F.col("first_usdc") * 1.15, "grew")
           .when(F.col("last_usdc") < F.col("first_usdc") * 0.85, "shrank").otherwise("flat"))
    return per.where("days IS NULL OR days >= 3").select(
        "address", "first_usdc", "last_usdc", way.alias("direction"))


def wallet_days(tape: DataFrame, wallets: DataFrame) -> DataFrame:
    """Dollars of each asked wallet (address) on every collected date, zero where it took nothing.
    The collected dates are one short list (a date a day); only asked wallets are filled."""
    dates = tape.select("date").distinct().agg(F.array_sort(F.collect_list("date")).alias("dates"), F.lit(1).alias("_one"))
    asked = wallets.select("address").distinct()
    grid = asked.withColumn("_one", F.lit(1)).join(F.broadcast(dates), "_one").select(
        "address", F.explode("dates").alias("date"))
    have = tape.join(asked, "address", "left_semi").groupBy("address", "date").agg(F.sum("usdc").alias("usdc"))
    return grid.join(have, ["address", "date"], "left").select(
        "address", "date", F.coalesce(F.bround("usdc", 2), F.lit(0.0)).alias("usdc"))


def first_per_url(rows: DataFrame) -> DataFrame:
    """One row per URL across files, the first by (file, ordinal)."""
    return first_per(rows.where("url IS NOT NULL"), ["url"], F.col("file"), F.col("ordinal"))


def upsert(prior: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace prior rows with the same key; all other prior rows stay."""
    return new.unionByName(prior.join(new.select(*keys).distinct(), keys, "left_anti"))
