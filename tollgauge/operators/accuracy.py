"""Were the returned numbers right? Grading against primary sources, and re-check planning."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions.numbers import days_since, deviation
from tollgauge.operators.ranks import true_median, upper_median
from tollgauge.operators.shapes import held, json_nodes, nearest, numeric_candidates


def category_config(spark) -> DataFrame:
    """The accuracy categories as a table (six rows, so it is always safe to broadcast)."""
    rows = [(name, c["kind"], c["band"], c["tol"], c["unit"], c["lo"], c["hi"])
            for name, c in fixed.ACCURACY_CATEGORIES.items()]
    return spark.createDataFrame(
        rows, "category string, kind string, band double, tol double, unit string, lo double, hi double")


def reference_value(quotes: DataFrame) -> DataFrame:
    """Reference per category: the median over its sources."""
    return true_median(quotes, ["category"], "value", "ref")


def grade(payloads: DataFrame, config: DataFrame) -> DataFrame:
    """Extract the number near the reference from each response and measure its distance.

    Input payloads carry their reference as ``ref``; the config has a row per category.
    """
    # a few categories would be a few tasks, if the answers were dealt out by them
    rows = payloads.join(F.broadcast(config), "category")
    seen = numeric_candidates(json_nodes(rows, "payload"), lo=F.col("lo"), hi=F.col("hi"))
    valued = nearest(seen, "ref", "band", "kind")
    return valued.select(
        *payloads.columns, "tol", "unit", "kind", "value", "field",
        F.when(F.col("value").isNotNull(), deviation(F.col("value"), F.col("ref"), F.col("kind")))
        .alias("dev"))


def accuracy_summary(graded: DataFrame) -> DataFrame:
    """Per category: usable answers, upper-median absolute deviation, worst seller."""
    usable = graded.where("value IS NOT NULL").withColumn("abs_dev", F.abs("dev"))
    worst = F.struct((-F.col("abs_dev")).alias("d"), F.col("host"), F.col("url"))
    facts = usable.groupBy("category").agg(
        F.count("*").alias("usable"), F.min_by("host", worst).alias("worst_host"),
        F.max("abs_dev").alias("worst_dev"))
    total = graded.groupBy("category").agg(F.count("*").alias("called"))
    middle = upper_median(usable, ["category"], "abs_dev", "median_abs_dev")
    return total.join(facts, "category", "left").join(middle, "category", "left").select(
        "category", "called", F.coalesce("usable", F.lit(0)).alias("usable"),
        "median_abs_dev", "worst_host", "worst_dev")


def graded_rows(graded: DataFrame) -> DataFrame:
    """Usable answers with their verdict against the category's tolerance."""
    dev = F.abs(F.coalesce("dev", F.lit(0.0)))
    return graded.where("value IS NOT NULL").select(
        "category", "host", "url", "value", "dev", "quoted", "unit", dev.alias("abs_dev"),
        F.when(dev <= F.col("tol"), "accurate").otherwise("off").alias("verdict"))


def accuracy_mart(graded: DataFrame, sources: DataFrame) -> DataFrame:
    """The published corpus: every usable answer with its category's metric, source and reference, closest first within
    a category and then cheapest (``rank``). Input sources: one row per category (category, metric, source); the
    reference is the one each answer was graded against."""
    price = F.coalesce(F.nullif("quoted", F.lit(0.0)), F.lit(9.0))
    dev = F.abs(F.coalesce("dev", F.lit(0.0)))
    rows = graded.where("value IS NOT NULL").join(sources.select("category", "metric", "source"), "category", "left")
    return rows.select(
        "category", F.coalesce("metric", "category").alias("metric"), "source", F.col("ref").alias("reference"), "unit",
        F.col("tol").alias("tolerance"), "host", "url", "value", F.col("dev").alias("deviation"), F.col("quoted").alias("price_usdc"),
        F.when(dev <= F.col("tol"), "accurate").otherwise("off").alias("verdict"), dev.alias("abs_dev"), price.alias("_price"))


def accuracy_order(mart: DataFrame) -> DataFrame:
    return mart.orderBy("category", "abs_dev", "_price", "url").drop("_price")


def accuracy_answer(mart: DataFrame, category: str | None = None, limit: int = 10) -> DataFrame:
    """One row: the closest sellers of a category with what they were graded against, or, where the category is missing or unknown, the
    categories there are. Limits run from 1 to 50; ``limit`` states the one used."""
    k, asked = min(max(int(limit), 1), 50), (category or "").strip().lower()
    mine = mart.where(F.lower("category") == asked)
    top = mine.orderBy("abs_dev", "_price", "url").limit(k).agg(F.array_sort(F.collect_list(F.struct(
        "abs_dev", "_price", "url", "host", "value", "deviation", "unit", "price_usdc", "verdict"))).alias("_top"))
    facts = mine.agg(F.count("*").alias("count"), F.min("metric").alias("metric"), F.min("source").alias("graded_against"),
                     F.min("reference").alias("reference"))
    # a name a category
    names = mart.agg(F.array_sort(F.collect_set("category")).alias("_names"))
    one = lambda df: df.withColumn("_k", F.lit(1))
    found = F.col("count") > 0
    return one(facts).join(one(top), "_k").join(one(names), "_k").select(
        F.lit(asked or None).cast("string").alias("category"), found.alias("found"), "metric", "graded_against", "reference", "count",
        F.lit(k).alias("limit"), F.transform("_top", lambda r: F.struct(
            r["host"].alias("host"), r["value"].alias("returned"), r["deviation"].alias("off_by"), r["unit"].alias("unit"),
            r["price_usdc"].alias("price_usdc"), r["verdict"].alias("verdict"))).alias("ranked"),
        F.when(~found, F.col("_names")).alias("available_categories"))


def accuracy_board(graded: DataFrame) -> DataFrame:
    """Published order per category: closest first, then cheapest (unpriced counts as 9)."""
    return graded_rows(graded).orderBy(
        "category", "abs_dev", F.coalesce(F.nullif("quoted", F.lit(0.0)), F.lit(9.0)), "url")


def most_accurate(graded: DataFrame, category: str, limit: int = 10) -> DataFrame:
    """The closest sellers of one category, at most 50."""
    k = min(max(int(limit), 1), 50)
    top = graded_rows(graded).where(F.col("category") == category).orderBy(
        "abs_dev", F.coalesce(F.nullif("quoted", F.lit(0.0)), F.lit(9.0)), "url").limit(k)
    order = Window.partitionBy("category").orderBy(
        "abs_dev", F.coalesce(F.nullif("quoted", F.lit(0.0)), F.lit(9.0)), "url")
    return top.withColumn("rank", F.row_number().over(order).cast("bigint"))


def recheck_plan(sellers: DataFrame, log: DataFrame, as_of: str, floor: int = 14) -> DataFrame:
    """What to test next: never tested or repriced first, then the oldest past the freshness
    floor. Fresh and unchanged endpoints are left out."""
    seen = log.select("url", "last_tested", F.col("price").alias("_price"), F.lit(True).alias("_seen"))
    rows = sellers.join(seen, "url", "left")
    changed = F.abs(F.coalesce("_price", F.lit(0.0)) - F.coalesce("price", F.lit(0.0))) > 1e-9
    age = days_since(F.col("last_tested"), as_of)
    first = F.col("_seen").isNull() | changed
    return rows.select(
        *sellers.columns, F.when(first, 0).otherwise(1).alias("priority"),
        F.when(first, F.lit(None).cast("int")).otherwise(age).alias("age"),
    ).where((F.col("priority") == 0) | (F.col("age") >= floor)).orderBy(
        "priority", F.desc("age"), "url")


def recheck_counts(sellers: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of the plan by priority, and how many sellers were skipped as fresh."""
    planned = plan.select("url", F.col("priority").alias("_p"))
    return sellers.join(planned, "url", "left").agg(
        F.count_if(F.col("_p") == 0).alias("new_or_changed"),
        F.count_if(F.col("_p") == 1).alias("stale"),
        F.count_if(F.col("_p").isNull()).alias("skipped"))


def screening_misses(results: DataFrame, labels: DataFrame) -> DataFrame:
    """Listed addresses that a screener did not flag."""
    listed = labels.where("expect = 'sanctioned'").select("address")
    return held(results, "screen").join(listed, "address", "left_semi").where(
        F.coalesce(F.col("screen") != "flagged", F.lit(True))).select("host", "address", "screen")
