"""Quality rules: fixed base rules, then a hashed n-gram likelihood ratio.

Words and word pairs are hashed into ``BUCKETS`` buckets. Two smoothed multinomials over the buckets
are counted over all documents: the raw corpus, and the trusted target (documents labelled as good).
A document's score is the mean over its n-grams of the log ratio target to raw; it is kept if it
passes the base rules and the score reaches the threshold. The threshold is fixed, so equal
documents share a verdict and no draw is involved. Only DataFrame functions are used.
"""

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge.llm.common import table, word_array

BUCKETS = 8192
SMOOTHING = 1.0
THRESHOLD = -0.06
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: labels up to this number of rows are sent to every task; more are joined by shuffle
BROADCAST_ROWS = 2_000_000
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"


def _buckets(words: Column) -> Column:
    """Buckets of all words and word pairs, in order; ``words`` must be a column."""
    n = F.size(words)
    single = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    pairs = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.pmod(
        F.xxhash64(F.get(words, i - 1), F.get(words, i)), F.lit(BUCKETS)).cast("int"))).otherwise(
        F.array().cast("array<int>"))
    return F.concat(single, pairs)


def _windows(words: Column) -> Column:
    n = F.size(words)
    return F.when(n > 2, F.transform(F.sequence(F.lit(2), n - 1), lambda i: F.xxhash64(
        F.get(words, i - 2), F.get(words, i - 1), F.get(words, i)))).otherwise(F.array().cast("array<bigint>"))


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with _words and the base figures n_words, word_chars, n_symbols, n_dup_lines and
    n_repeat_words. Repeated windows are found by sorting their hashes within the row, and only in
    rows whose windows are not all different."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    out = docs.withColumns({"_words": word_array(F.col(f"`{text}`")), "_lines": lines})
    out = out.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.char_length(F.translate(t, _SPACES, "")).cast("bigint"),
        "n_symbols": (F.char_length(t) - F.char_length(F.translate(t, _SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "_windows": _windows(F.col("_words"))}).drop("_lines")
    varied = F.size(F.array_distinct("_windows")) == F.size("_windows")
    out = out.withColumn("_sorted", F.when(~varied, F.array_sort(F.transform(
        "_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_sorted")
    out = out.withColumn("_again", F.sort_array(F.transform(F.filter(s, lambda e, k: (
        e["h"] == F.get(s, k - 1)["h"]) | (e["h"] == F.get(s, k + 1)["h"])), lambda e: e["i"])))
    p = F.col("_again")
    gaps = F.transform(F.sequence(F.lit(1), F.size(p) - 1), lambda k: F.least(F.lit(3), F.get(p, k) - F.get(p, k - 1)))
    # windows that are found twice come at least in twos
    covered = F.when(F.size(p) > 1, 3 + F.aggregate(gaps, F.lit(0), lambda a, g: a + g)).otherwise(0)
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_windows", "_sorted", "_again")


def log_ratios(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row, column w: log(target / raw) of every bucket. ``trusted`` holds keys; the counts cover
    every document and are summed on the map side."""
    ids = trusted.select(F.col(f"`{key}`").alias("_key")).where("_key is not null").distinct().withColumn("_good", F.lit(1))
    if trusted.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).join(ids, "_key", "left")
    grams = rows.select("_good", word_array(F.col("_text")).alias("_words")).select(
        "_good", F.explode(_buckets(F.col("_words"))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("_good").alias("good"))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").fillna(0)
    parts = every.agg(F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good"), F.sort_array(
        F.collect_list(F.struct("bucket", "raw", "good"))).alias("b"))
    spread = F.lit(SMOOTHING * BUCKETS)
    return parts.select(F.transform("b", lambda x: F.log((x["good"] + SMOOTHING) / (F.col("all_good") + spread)) - F.log(
        (x["raw"] + SMOOTHING) / (F.col("all_raw") + spread))).alias("w"))


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "log_ratio", "kept")


HELPERS = {"_words", "_lines", "_windows", "_sorted", "_again", "_grams"}


def judged(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text",
           threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the base figures, base_failed, log_ratio (mean per n-gram) and kept; existing
    columns of these names are replaced.

    A null or empty text has no words: it fails the base rules and its log_ratio is 0. Repeated rows
    are counted and judged each. Without trusted keys the target is uniform. An empty table gives an
    empty table.
    """
    # BUCKETS numbers, whatever the size of the corpus, go to the plan as one constant
    weights = F.lit(np.array(log_ratios(docs, trusted, key, text).first()["w"], dtype=np.float64))
    clash = HELPERS & set(docs.columns)  # then the columns travel in a struct, out of the way
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("_text"))
    out = base_columns(rows, "_text") if clash else base_columns(docs, text)
    out = out.withColumn("_grams", _buckets(F.col("_words")))
    total = F.aggregate("_grams", F.lit(0.0), lambda a, b: a + F.get(weights, b))
    out = out.withColumns({
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (
            100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
        "log_ratio": F.when(F.size("_grams") > 0, total / F.size("_grams")).otherwise(0.0)})
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= threshold))
    if not clash:
        return out.drop("_words", "_grams")
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in FIGURES], *FIGURES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return judged(table(spark, sf_dir, "documents").select("doc_id", "text"), good).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ratio")
