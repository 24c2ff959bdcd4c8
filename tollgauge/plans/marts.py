"""Facts and marts that queries share: written once for a state of the given tables, read by everything built on them."""

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgauge.plans.inputs import BASE_TABLES, Tables
from tollgauge.sources.storage import current_version, shared_folder, versions, write_version


def fingerprint(t: Tables) -> str:
    """Changes when a file of the given tables does: their places, sizes and times."""
    jvm, seen = t.spark.sparkContext._jvm, [t.folder]
    for name in BASE_TABLES:
        place = jvm.org.apache.hadoop.fs.Path(f"{t.folder}/{name}.parquet")
        fs = place.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(place):
            files = fs.getContentSummary(place)
            seen.append((name, files.getLength(), files.getFileCount(), fs.getFileStatus(place).getModificationTime()))
    return hashlib.sha256(repr(seen).encode()).hexdigest()[:24]


def stored(t: Tables, name: str, build: Callable[[], DataFrame], partition_by: tuple[str, ...] = (), **options) -> DataFrame:
    """A table that is written the first time it is asked for and read from then on; the columns it is
    partitioned by are text, and the options are those of the writer."""
    place = f"{shared_folder(t.spark)}/marts/{fingerprint(t)}/{name}"
    if versions(t.spark, place):
        rows = t.spark.read.parquet(current_version(t.spark, place))
        return rows.withColumns({c: F.col(c).cast("string") for c in partition_by})
    rows = build()
    write_version(rows, place, partition_by=partition_by, **options)
    return t.spark.read.schema(rows.schema).parquet(current_version(t.spark, place))
