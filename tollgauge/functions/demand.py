"""Scores and labels that describe the shape of demand."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollgauge.functions.numbers import clamp01, half_even


def organic_score(payers: Column, repeat: Column, top1: Column, hhi: Column,
                  settlements: Column) -> Column:
    """Struct(score, breadth, dispersion, repeat, confidence, repeat_rate), or null
    without payers. Breadth 40 (log of payers, full at 100), dispersion 40 (evenness of
    dollars), repeat 20 (share of returning payers, full at 30%)."""
    paid = payers.cast("double")
    breadth = 40.0 * clamp01(F.log10(paid) / 2.0)
    concentration = F.coalesce(hhi, top1 * top1)
    dispersion = 40.0 * clamp01((1.0 - concentration) / 0.95)
    rate = repeat.cast("double") / paid
    returning = 20.0 * clamp01(rate / 0.30)
    confidence = (
        F.when(dispersion.isNull(), "unknown")
        .when((F.coalesce(settlements, F.lit(0)) < 10) | (payers < 3), "low")
        .when(settlements < 100, "medium")
        .otherwise("high")
    )
    return F.when(
        payers > 0,
        F.struct(
            half_even(breadth + dispersion + returning, 0).cast("bigint").alias("score"),
            half_even(breadth, 1).alias("breadth"),
            half_even(dispersion, 1).alias("dispersion"),
            half_even(returning, 1).alias("repeat"),
            confidence.alias("confidence"),
            half_even(rate, 3).alias("repeat_rate"),
        ),
    )


def demand_label(payers: Column, top1: Column, hhi: Column) -> Column:
    concentrated = (top1 >= 0.9) | (top1.isNotNull() & F.coalesce(hhi >= 0.8, F.lit(False)))
    spread = F.coalesce(top1 <= 0.35, F.lit(True)) & F.coalesce(hhi <= 0.15, F.lit(True))
    return (
        F.when(F.coalesce(payers, F.lit(0)) == 0, F.lit(None).cast("string"))
        .when(F.coalesce(concentrated, F.lit(False)), "one wallet")
        .when(payers <= 5, "thin")
        .when((payers >= 20) & spread, "broad")
        .otherwise("mixed")
    )


def directory_demand(settlements: Column, payers: Column, hours: int = 24) -> Column:
    """Struct(tier, why) of one settled service; null settlements mean nothing settled."""
    count = F.format_number(settlements, 0)
    wallets = F.concat(payers.cast("string"), F.lit(" distinct wallets paid it on chain"))
    quiet = f"no settlement on chain in the last {hours}h"
    return (
        F.when(settlements.isNull(), _tier("quiet", F.lit(quiet)))
        .when(payers >= 10, _tier("established", wallets))
        .when((settlements >= 500) & (payers <= 2), _tier(
            "concentrated",
            F.concat(count, F.lit(" settlements from "), payers.cast("string"), F.lit(" wallet(s)"))))
        .when(payers >= 3, _tier("traction", wallets))
        .otherwise(_tier(
            "thin",
            F.concat(count, F.lit(" settlement(s) from "), payers.cast("string"), F.lit(" wallet(s)"))))
    )


def _tier(name: str, why: Column) -> Column:
    return F.struct(F.lit(name).alias("tier"), why.alias("why"))


def adoption(calls: Column, payers: Column, days_idle: Column) -> Column:
    """Struct(tier, why, wash_ratio) from calls, paying wallets and days since a call."""
    wallets = F.concat(payers.cast("string"), F.lit(" distinct paying wallets"))
    many = F.concat(payers.cast("string"),
                    F.lit(" distinct wallets paid it in the last 30 days"))
    count = F.format_number(calls, 0)
    tier = (
        F.when((payers >= 20) & (calls >= 200), _tier("established", many))
        .when(payers >= 5, _tier("traction", wallets))
        .when((calls >= 500) & (payers <= 2), _tier(
            "self-traffic",
            F.concat(count, F.lit(" calls from only "), payers.cast("string"),
                     F.lit(" paying wallet(s)"))))
        .when(calls > 0, _tier(
            "thin", F.concat(count, F.lit(" calls from "), payers.cast("string"), F.lit(" wallet(s)"))))
        .otherwise(_tier("dormant", F.lit("no recorded paid calls")))
    )
    stale = F.coalesce(days_idle > 14, F.lit(False)) & (tier["tier"] != "dormant")
    idle = F.concat(F.lit("last paid call "), days_idle.cast("string"), F.lit(" days ago"))
    return F.struct(
        F.when(stale, F.lit("dormant")).otherwise(tier["tier"]).alias("tier"),
        F.when(stale, idle).otherwise(tier["why"]).alias("why"),
        F.when(payers > 0, half_even(calls / payers, 1)).alias("wash_ratio"),
    )
