"""The second source of sellers: duplicates, aliases and market headline."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgauge.functions.numbers import half_even, usd
from tollgauge.functions.urls import host_of
from tollgauge.operators.ranks import first_per


def dedupe_sellers(records: DataFrame) -> DataFrame:
    """One record per (recipient set, transaction count), the first by ordinal."""
    keyed = records.withColumn("_k", F.array_join(F.array_sort("recipients"), ","))
    return first_per(keyed, ["_k", "tx"], F.col("ordinal")).select(*records.columns)


def alias_revenue(sellers: DataFrame) -> DataFrame:
    """Revenue per host. A seller's volume belongs to the seller, so of the sellers that name
    a host the largest counts; volumes are never added."""
    named = sellers.select(
        F.explode(F.transform("origins", lambda o: host_of(o, "stripped"))).alias("host"),
        F.col("units"), F.coalesce("tx", F.lit(0)).alias("tx"),
        F.coalesce("buyers", F.lit(0)).alias("buyers"), "ordinal").where("host != ''")
    order = F.struct((-F.col("units")).alias("k"), F.col("ordinal"))
    return named.groupBy("host").agg(F.min_by(F.struct("units", "tx", "buyers"), order).alias("b")
                                     ).select("host", half_even(usd(F.col("b.units")), 6).alias("usd"),
                                              "b.tx", "b.buyers")


def dedupe_aliases(rows: DataFrame) -> DataFrame:
    """Hosts that report the same (tx, dollars, buyers) are one seller; the shortest name stays."""
    keyed = rows.withColumn("_u", half_even(F.col("usd"), 4))
    return first_per(keyed, ["tx", "_u", "buyers"], F.length("host"), F.col("host")).select(*rows.columns)


def seller_headline(rows: DataFrame) -> DataFrame:
    """One row of totals over distinct sellers."""
    total = F.sum("tx")
    money = F.sum(F.col("usd").cast("decimal(28,6)")).cast("double")
    return rows.agg(
        F.count("*").alias("sellers"), total.alias("tx"), half_even(money, 2).alias("usd"),
        F.when(total > 0, half_even(100.0 * F.max("tx") / total, 2)).alias("top1_share"),
        F.when(total > 0, half_even(money / total, 6)).alias("avg_ticket"))


def seller_scatter(rows: DataFrame, min_tx: int = 20) -> DataFrame:
    return rows.where((F.col("tx") >= min_tx) & (F.col("usd") > 0)).select(
        "host", "tx", half_even(F.col("usd"), 2).alias("usd"), "buyers",
        half_even(F.col("usd") / F.greatest("tx", F.lit(1)), 6).alias("avg_ticket"))
