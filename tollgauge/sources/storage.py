"""Shared folders: checkpoints, versions of written tables and partition replacement."""

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it. Only where the session
    names none (local tests) a temporary folder takes its place."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tollgauge-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def write_partition(df: DataFrame, path: str, column: str = "date") -> None:
    """Write dated rows; a rewrite replaces exactly the dates it contains."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the whole versions under a folder, rising."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit() and fs.exists(
        jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


def release_shuffles(spark: SparkSession) -> None:
    """Give back the disk of shuffles whose job has ended. Spark removes them when the driver collects what refers to them, which
    with a large heap comes late: until then every step of a long job adds its shuffles to those of the steps before."""
    spark.sparkContext._jvm.System.gc()


def write_version(df: DataFrame, path: str, form: str = "parquet", number: int | None = None,
                  partition_by: tuple[str, ...] = (), **options) -> str:
    """Write a table as the next version of a folder and return its place. Earlier versions stay
    readable, so a table may be read, changed and written back, and a lost job changes nothing."""
    if number is None:
        number = max(versions(df.sparkSession, path), default=-1) + 1
    place = f"{path}/v={number}"
    packed = {"compression": "zstd"} if form == "parquet" else {}
    df.write.mode("overwrite").format(form).options(**(packed | options)).partitionBy(*partition_by).save(place)
    release_shuffles(df.sparkSession)
    return place


def current_version(spark: SparkSession, path: str) -> str:
    """Place of the newest whole version."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no version under {path}")
    return f"{path}/v={found[-1]}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder or file of the library's own; nothing happens if it is not there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def drop_checkpoint(df: DataFrame) -> None:
    """Remove the files of a checkpointed table that nothing reads any more."""
    kept = df._jdf.logicalPlan().rdd().getCheckpointFile()
    if kept.isDefined():
        delete(df.sparkSession, kept.get())


def write_named(df: DataFrame, folder: str, name: str, form: str = "json") -> None:
    """One file for each value of the column ``name``, called by it, as a client would land them."""
    spark = df.sparkSession
    jvm, parts = spark.sparkContext._jvm, f"{folder}/_parts"
    df.repartition(name).write.mode("overwrite").partitionBy(name).format(form).save(parts)
    top = jvm.org.apache.hadoop.fs.Path(parts)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for part in fs.listStatus(top):
        called = part.getPath().getName()
        if called.startswith(f"{name}="):
            files = [f.getPath() for f in fs.listStatus(part.getPath()) if f.getPath().getName().startswith("part-")]
            if len(files) != 1:
                raise RuntimeError(f"{called} came in {len(files)} files")
            fs.rename(files[0], jvm.org.apache.hadoop.fs.Path(f"{folder}/{called.removeprefix(f'{name}=')}"))
    delete(spark, parts)


def write_mart(df: DataFrame, path: str, form: str = "parquet") -> None:
    write_version(df, path, form)


def read_mart(spark: SparkSession, path: str, form: str = "parquet", schema: str | None = None) -> DataFrame:
    reader = spark.read.format(form)
    return (reader.schema(schema) if schema else reader).load(current_version(spark, path))
