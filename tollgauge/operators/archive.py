"""Pointers into the archive of captured responses.

A pointer is the hash of a capture's content, so it stays when files are added, split or written anew, which a
file and line do not. Every kind of receipt carries one.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge.operators.shapes import find_payment
from tollgauge.sources.storage import current_version, write_version

BUCKETS = 64


def with_payment(captures: DataFrame) -> DataFrame:
    """Landed captures with the transaction their output reports."""
    return find_payment(captures, "stdout")


def identified(captures: DataFrame) -> DataFrame:
    """Captures with ``capture_id``: their own, or a hash of URL, transaction and payload where they have none."""
    if "capture_id" in captures.columns:
        return captures
    return captures.withColumn("capture_id", F.sha2(F.to_json(F.struct("url", "tx", "payload")), 256))


def as_pointers(table: DataFrame) -> DataFrame:
    """A pointer table as it is, or that of a table of captures (by ``ts`` if they have one, else by ``line``)."""
    if {"first", "last"} <= set(table.columns):
        return table
    return capture_pointers(identified(table), "ts" if "ts" in table.columns else "line")


def capture_pointers(captures: DataFrame, at: str = "ts") -> DataFrame:
    """One row for each archived response with a URL: ``capture_id``, ``url``, ``tx``, and the
    ``first`` and ``last`` place (file, at) where this content stands. Input: (capture_id, url, tx, file, ``at``)."""
    place = F.struct("file", F.col(at).alias("at"))
    return captures.where("url IS NOT NULL").groupBy("capture_id", "url", "tx").agg(
        F.min(place).alias("first"), F.max(place).alias("last"))


def write_pointers(pointers: DataFrame, path: str) -> str:
    """A version of the pointer table, in folders by a hash of the pointer: a reader that knows pointers opens theirs only."""
    bucket = F.pmod(F.xxhash64("capture_id"), F.lit(BUCKETS)).cast("int")
    return write_version(pointers.withColumn("bucket", bucket), path, partition_by=("bucket",))


def read_pointers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current_version(spark, path)).drop("bucket")


def link_first(calls: DataFrame, pointers: DataFrame) -> DataFrame:
    """``calls`` with ``raw_file`` and ``raw_id`` of the response archived first for the same (url, tx), transaction null-safe."""
    # grouped by the two parts that a null-safe comparison consists of, so that the groups meet the calls where they lie
    part, none = F.coalesce("tx", F.lit("")), F.col("tx").isNull()
    first = pointers.groupBy(F.col("url").alias("_u"), part.alias("_t"), none.alias("_n")).agg(
        F.min(F.struct("first", "capture_id")).alias("_p"))
    same = (F.col("url") == F.col("_u")) & (part == F.col("_t")) & (none == F.col("_n"))
    return calls.join(first, same, "left").withColumns(
        {"raw_file": F.col("_p.first.file"), "raw_id": F.col("_p.capture_id")}).drop("_u", "_t", "_n", "_p")


def link_last(calls: DataFrame, pointers: DataFrame) -> DataFrame:
    """``calls`` with ``raw_file``, ``raw_id`` and ``raw_tx`` of the response archived last for the same URL."""
    last = pointers.groupBy(F.col("url").alias("_u")).agg(F.max(F.struct("last", "capture_id", "tx")).alias("_p"))
    return calls.join(last, F.col("url") == F.col("_u"), "left").withColumns(
        {"raw_file": F.col("_p.last.file"), "raw_id": F.col("_p.capture_id"), "raw_tx": F.col("_p.tx")}).drop("_u", "_p")
