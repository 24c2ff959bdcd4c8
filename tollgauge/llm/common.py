"""Helpers that several operators of this subpackage share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge.sources.storage import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """Rows written to the shared checkpoint folder, so that later jobs do not replay the plan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def packed(df: DataFrame) -> Column:
    """All columns of a table as one struct, so that none of their names can meet a name of an operator's own."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def text_id(text: Column) -> Column:
    """128-bit hash of a text, null counting as empty. Unlike a row number, which follows the splits of files and so the cores there
    are, it is the same in every scan."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def content_id(df: DataFrame) -> Column:
    """128-bit hash of a whole row, equal for rows that are equal in all columns."""
    cells = [F.to_json(F.col(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema.fields]
    nulls = [F.col(f"`{c}`").isNull() for c in df.columns]  # a null cell leaves a hash as it was
    return F.struct(F.xxhash64(F.lit(1), *cells, *nulls).alias("a"), F.xxhash64(F.lit(2), *nulls, *cells).alias("b"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_array(text: Column) -> Column:
    """Words of a text, none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key's text modulo the number of folds; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def hash_below(key: Column, seed: int, share: float) -> Column:
    """True for about a share of the keys, the same ones at every run."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))


def labelled_ids(labels: DataFrame, label: str, folds: int, held: int, most: int, seed: int) -> DataFrame:
    """(doc_id, label) of labelled rows outside the held-out fold, thinned by a hash of the id to
    about ``most`` rows and never more than twice that: small enough to broadcast. Of several labels
    of one id the largest counts; null ids and null labels are left out."""
    known = labels.where(fold(F.col("doc_id"), folds) != held).groupBy("doc_id").agg(
        F.max(F.col(label)).cast("int").alias("label")).where("label in (0, 1)")
    share = min(1.0, most / max(1, known.count()))
    return known.where(hash_below(F.col("doc_id"), seed, share)).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(2 * most)


def labelled_rows(docs: DataFrame, ids: DataFrame, *columns: str) -> DataFrame:
    """One row (doc_id, label and the given columns) of each of a bounded number of ids: of an id's repeated rows the one whose
    text has the least hash, chosen before rows leave their task."""
    rows = docs.select("doc_id", *columns).join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min_by(F.struct(*columns), F.xxhash64("text")).alias("r")).select("doc_id", "label", "r.*")
