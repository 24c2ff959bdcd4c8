"""Paid delivery checks: reconciliation, regrading and the current verdict per endpoint."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions.numbers import call_cap, clean_charged, to_number
from tollgauge.operators.ranks import first_per
from tollgauge.operators.shapes import held, judge, judge_shape


def verified(conformance: DataFrame) -> DataFrame:
    return held(conformance, "status").where(F.col("status").isin("delivered", "short"))


def untested(candidates: DataFrame, done: DataFrame) -> DataFrame:
    return candidates.join(done.select("url").distinct(), "url", "left_anti")


def recall_targets(candidates: DataFrame, targets: DataFrame, today: DataFrame) -> DataFrame:
    """Only the listed URLs, without those already called today."""
    wanted = candidates.join(targets.select("url").distinct(), "url", "left_semi")
    return wanted.join(today.select("url").distinct(), "url", "left_anti")


def reconcile(first: DataFrame, second: DataFrame) -> DataFrame:
    """Settle each short verdict against a second call of the same URL.

    A second delivery clears it, a second short confirms it, anything else leaves it
    inconclusive. Rows that are not short do not change. Of several second calls of a URL a
    delivery counts before a short, and a short before anything else.
    """
    weight = F.when(F.col("status") == "delivered", 0).when(F.col("status") == "short", 1).otherwise(2)
    # a second call that is neither is like none, and need not be sent to the first
    told = held(second.select("url", "status", "missing", "extra"), "status", "missing", "extra").where(F.col("status").isin("delivered", "short"))
    again = told.groupBy("url").agg(F.min(F.struct(
        weight.alias("w"), "status", "missing", "extra")).alias("_s")).select(
        "url", *[F.col(f"_s.{c}").alias(f"_{c}") for c in ("status", "missing", "extra")])
    rows = first.join(again, "url", "left")
    short = F.col("status") == "short"
    cleared = short & F.coalesce(F.col("_status") == "delivered", F.lit(False))
    confirmed = short & F.coalesce(F.col("_status") == "short", F.lit(False))
    status = (F.when(cleared, "delivered").when(short & ~confirmed, "inconclusive")
              .otherwise(F.col("status")))
    why = (F.when(cleared, fixed.WHY_CLEARED).when(confirmed, fixed.WHY_CONFIRMED)
           .when(short, fixed.WHY_UNCONFIRMED).otherwise(F.col("why")))
    rest = [c for c in first.columns if c not in ("status", "why", "missing", "extra", "conforms")]
    return rows.select(
        *rest, status.alias("status"),
        F.when(cleared, F.col("_missing")).otherwise(F.col("missing")).alias("missing"),
        F.when(cleared, F.col("_extra")).otherwise(F.col("extra")).alias("extra"),
        why.alias("why"), (status == "delivered").alias("conforms"))


def conformance_rows(calls: DataFrame) -> DataFrame:
    """Judged paid calls. Input: (url, host, quoted, ok, payload, paid, tx, price, error,
    expect, ms); calls that never returned are inconclusive."""
    judged = judge(calls, "payload", "expect")
    cap = call_cap(F.col("quoted"))
    charged = clean_charged(to_number(F.col("price")), cap)
    returned = F.col("ok")
    return judged.select(
        "url", "host", "quoted", charged.alias("charged"), "paid",
        (F.col("ok") & ~F.col("paid")).alias("free"), "tx", "ms",
        F.col("expect").alias("promised"), "payload",
        F.when(returned, F.col("status")).otherwise("inconclusive").alias("status"),
        F.when(returned, F.col("missing")).otherwise(F.col("expect")).alias("missing"),
        F.when(returned, F.col("extra")).otherwise(F.array().cast("array<string>")).alias("extra"),
        F.when(returned, F.col("why")).otherwise(
            F.coalesce("error", F.lit("call failed"))).alias("why"),
        (returned & F.col("conforms")).alias("conforms"))


def run_summary(rows: DataFrame) -> DataFrame:
    """One row: calls, paid, free, delivered after paying, charged above the quote."""
    over = (F.col("charged") > 0) & (F.col("charged") > F.col("quoted") * 1.001)
    return rows.agg(
        F.count("*").alias("called"), F.count_if("conforms").alias("delivered"),
        F.count_if("paid").alias("paid"), F.count_if("free").alias("free"),
        F.count_if(F.col("paid") & F.col("conforms")).alias("paid_and_delivered"),
        F.count_if(over).alias("overcharged"))


def delivery_counts(conformance: DataFrame) -> DataFrame:
    """Per host: delivered and short endpoints, and inconclusive calls counted apart."""
    return conformance.groupBy("host").agg(
        F.count_if(F.col("status") == "delivered").alias("ok"),
        F.count_if(F.col("status") == "short").alias("short"),
        F.count_if(F.col("status") == "inconclusive").alias("inconclusive"))


def latest_verdict(conformance: DataFrame) -> DataFrame:
    """Current verdict per (host, url): the row of the newest file wins."""
    return first_per_desc(verified(conformance), ["host", "url"])


def first_per_desc(rows: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct("file", "ordinal")).alias("_r")
    ).select(*keys, "_r.*").select(*rows.columns)


def regrade(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Re-judge stored shapes without new calls: (clean rows, recall queue, flips).

    A row whose response was no object carries no usable shape and goes to the recall queue.
    """
    usable = F.coalesce(F.exists("shape", lambda s: (s["path"] == "") & (s["type"] == "object")),
                        F.lit(False))
    rows = held(rows, "shape")
    was = rows.withColumn("was_conforming", F.coalesce("conforms", F.lit(False)))
    judged = judge_shape(was.where(usable), "shape", "promised")
    clean = held(judged, "status", "missing", "extra", "why", "conforms").withColumn("regraded", F.lit(True))
    recall = rows.where(~usable).select(
        "url", "host", "quoted", F.lit("no response shape saved").alias("reason"))
    flips = clean.where(F.col("conforms") != F.col("was_conforming")).select(
        "url", "host", F.when(F.col("was_conforming"), "delivered").otherwise("failed").alias("was"),
        F.col("status").alias("now"))
    return clean, recall, flips


def regrade_summary(clean: DataFrame, recall: DataFrame, flips: DataFrame) -> DataFrame:
    """One row: counts by status, flips, and the recall queue with its hosts."""
    tagged = (clean.select(F.col("status").alias("k"), F.lit(None).cast("string").alias("host"))
              .unionByName(recall.select(F.lit("recall").alias("k"), "host"))
              .unionByName(flips.select(F.lit("flip").alias("k"), F.lit(None).cast("string").alias("host"))))
    def n(kind):
        return F.count_if(F.col("k") == kind)
    return tagged.agg(
        n("delivered").alias("delivered"), n("short").alias("short"),
        n("inconclusive").alias("inconclusive"), n("flip").alias("flips"),
        n("recall").alias("recall"),
        F.count_distinct(F.when(F.col("k") == "recall", F.col("host"))).alias("recall_hosts"))


def regrade_monotone(rows: DataFrame) -> DataFrame:
    """Correct shorts only, and only downward: a re-judged row is accepted when its shortfall
    strictly shrinks, so no row can become an accusation."""
    judged = judge_shape(rows, "shape", "promised", prefix="n_")
    accept = ((F.col("status") == "short")
              & F.coalesce(F.exists("shape", lambda s: (s["path"] == "") & (s["type"] == "object")),
                           F.lit(False))
              & F.col("n_status").isin("delivered", "short")
              & (F.size("n_missing") < F.size("missing")))
    cleared = F.col("n_status") == "delivered"
    why = (F.when(cleared, "").when(F.coalesce("why", F.lit("")).contains("two calls"), F.col("why"))
           .otherwise(F.col("n_why")))
    rest = [c for c in rows.columns if c not in ("status", "missing", "extra", "why", "conforms")]
    return judged.select(
        *rest,
        F.when(accept, F.col("n_status")).otherwise(F.col("status")).alias("status"),
        F.when(accept, F.col("n_missing")).otherwise(F.col("missing")).alias("missing"),
        F.when(accept, F.col("n_extra")).otherwise(F.col("extra")).alias("extra"),
        F.when(accept, why).otherwise(F.col("why")).alias("why"),
        F.when(accept, cleared).otherwise(F.col("conforms")).alias("conforms"))


def new_shorts(before: DataFrame, after: DataFrame) -> DataFrame:
    """URLs that are short after but were not before: must be empty."""
    return held(after.select("url", "status"), "status").where("status = 'short'").select("url").join(
        held(before.select("url", "status"), "status").where("status = 'short'").select("url"), "url", "left_anti")


def first_call(rows: DataFrame) -> DataFrame:
    return first_per(rows, ["url"], F.col("file"), F.col("ordinal"))
