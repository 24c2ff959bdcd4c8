"""Readers and writers of landed files, always with declared schemas."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge import schemas
from tollgauge.functions.numbers import half_even
from tollgauge.functions.urls import host_of
from tollgauge.operators.ranks import running_total
from tollgauge.sources.storage import current_version, ensure_checkpoint_dir, write_version


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Raw transfer logs, one JSON object per line: the newest version of the folder."""
    return spark.read.schema(schemas.TRANSFER_LOG).json(current_version(spark, path))


def write_logs(df: DataFrame, path: str) -> None:
    write_version(df, path, "json", compression="gzip")


def read_tape(spark: SparkSession, folder: str, chain: str = "base") -> DataFrame:
    """All days of one chain's dated settlement files, one row per (date, wallet). Each file is
    one JSON document; a file that does not parse is skipped. Files of the second chain share
    the name prefix and carry the chain in their name. A folder may hold a file for each day or a folder of them."""
    days = (spark.read.schema(schemas.TAPE_DAY).option("multiLine", True)
            .option("columnNameOfCorruptRecord", "_corrupt_record").option("mode", "PERMISSIVE")
            .option("pathGlobFilter", "settlements_*.json*").json(folder)
            .select("*", F.col("_metadata.file_name").alias("file")))
    days = days.where("_corrupt_record IS NULL")
    named = F.col("file").contains(f"settlements_{chain}_")
    if chain == "base":
        picked = days.where(~F.col("file").rlike(r"settlements_[a-z]+_"))
        return _with_units(picked.select("date", F.explode("by_address").alias("address", "v")).select(
            "date", F.lower("address").alias("address"), "v.*"))
    picked = days.where(named)
    return _with_units(picked.select(F.substring("generated", 1, 10).alias("date"), F.explode("by_wallet").alias(
        "wallet", "v")).select("date", "wallet", "v.*"))


def _with_units(tape: DataFrame) -> DataFrame:
    """The files carry dollars with six decimals; operators count whole base units."""
    money = {c: u for c, u in (("usdc", "units"), ("usdc_out", "units_out")) if c in tape.columns and u not in tape.columns}
    return tape.withColumns({u: half_even(F.col(c) * 1e6, 0).cast("decimal(38,0)") for c, u in money.items()})


def _numbered(rows: DataFrame, out: str, *first: Column) -> DataFrame:
    """Rows read from files with their number, from 0, in the order of file names (after what ``first`` says of a file) and of
    rows as they stand in a file.

    Tasks take files by size and in parts, so numbers in reading order mean nothing. A part of a file is read by one
    task from first to last: every row is stored once with its part and its place in the task, and the rows
    of the parts before it are counted in the order of (file, part).
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    names = [f"f{i}" for i in range(len(first))]
    part = F.struct(*[c.alias(n) for c, n in zip(first, names, strict=True)], F.col("_metadata.file_name").alias("name"),
                    F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    stored = rows.select(F.struct(*rows.columns).alias("row"), part.alias("_part"), F.monotonically_increasing_id().alias("_at")).checkpoint()
    parts = stored.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("_least"))
    upto = running_total(parts, "n", ["_part"], "_upto").select("_part", (F.col("_upto") - F.col("n") - F.col("_least")).alias("_shift"))
    return stored.join(upto, "_part").select("row.*", "_part", (F.col("_at") + F.col("_shift")).alias(out))


def read_registry(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Registry snapshot: a nested JSON array (or one resource per line), with its order.

    ``ordinal`` is the place in the snapshot: an own field of that name where a file has one, else
    the number of the row, files by name and rows as they stand, however many tasks read them."""
    raw = _numbered(spark.read.schema(schemas.REGISTRY).option("multiLine", multiline).json(path), "_number")
    return raw.withColumn("ordinal", F.coalesce("ordinal", "_number")).withColumn(
        "host", host_of(F.coalesce("resource", F.lit("")))).drop("_number", "_part")


def read_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Plain or gzipped JSON snapshot; the codec follows the file name."""
    return spark.read.schema(schema).json(path)


def write_snapshot(df: DataFrame, path: str) -> str:
    return write_version(df, path, "json", compression="gzip")


def read_captures(spark: SparkSession, folder: str) -> DataFrame:
    """Capture archive: raw client output. Every JSON file below the folder is read: files a client
    named, and those that ``append_captures`` put into day folders. ``file`` is the file's name, or
    raw_<day> for a day folder; ``line`` numbers the rows of one reading in the order of files and rows; ``capture_id`` hashes a
    capture's content and stays when files are added or split."""
    rows = (spark.read.schema(schemas.CAPTURE).option("pathGlobFilter", "*.json*")
            .option("recursiveFileLookup", True).json(folder))
    day = F.regexp_extract("_metadata.file_path", r"/raw_day=([^/]*)/[^/]*$", 1)
    fields = rows.columns
    file = F.when(day != "", F.concat(F.lit("raw_"), day)).otherwise(F.col("_metadata.file_name"))
    return _numbered(rows, "line", file).select(
        *fields, F.col("_part.f0").alias("file"), "line", F.sha2(F.to_json(F.struct(*fields)), 256).alias("capture_id"))


def append_captures(df: DataFrame, folder: str) -> None:
    """Append-only, into a folder raw_day=<day> for each day of ``ts``: existing captures are never touched."""
    day = F.coalesce(F.nullif(F.substring("ts", 1, 10), F.lit("")), F.lit("undated"))
    (df.withColumn("raw_day", day).write.mode("append").option("maxRecordsPerFile", 1_000_000)
     .partitionBy("raw_day").json(folder))


def read_ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest version of the ledger."""
    return spark.read.schema(schema).json(current_version(spark, path))


def write_ledger(df: DataFrame, path: str) -> None:
    """Canonical ledger: sorted by receipt id (a range partitioning, not one task), as a new version,
    so that a ledger may be read, superseded and written back. Packed: every line names its columns and the paths of its shape."""
    write_version(df.orderBy("receipt_id"), path, "json", compression="gzip")


def read_hits(spark: SparkSession, folder: str, names: str = "hits-*.json*") -> DataFrame:
    """Usage log lines; from the first unreadable line on, a file's lines are dropped."""
    lines = _numbered(spark.read.option("pathGlobFilter", names).option("recursiveFileLookup", True).text(folder), "_line")
    read = F.from_json("value", schemas.HIT, {"columnNameOfCorruptRecord": "_corrupt_record"})
    rows = lines.where(F.trim("value") != "").select(read.alias("h"), F.col("_part.path").alias("_f"), "_line").select("h.*", "_f", "_line")
    bad = rows.where("_corrupt_record IS NOT NULL").groupBy("_f").agg(F.min("_line").alias("_bad"))
    kept = rows.join(bad, "_f", "left").where(
        "_corrupt_record IS NULL AND (_bad IS NULL OR _line < _bad)")
    return kept.select("ts", "tool", "subject", "client")
