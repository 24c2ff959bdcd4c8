"""Continuous versions of four batch operators; each equals its batch operator on the same
input. Results land as change files in the shared folder and are folded at read time."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge.operators.receipts import one_per_id, supersede
from tollgauge.sources.storage import delete, versions, write_version


#: pieces of one level that are folded into one piece of the next level
TIER = 8
PIECES = "place string, level int, first bigint, last bigint, left bigint"


def fold_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Newest value of every key out of update-mode batches."""
    return _newest(changes, keys).drop("batch")


def _newest(changes: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in changes.columns if c not in keys and c != "batch"]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_v"), F.max("batch").alias("batch")).select(
        *keys, "_v.*", "batch")


def _manifest(spark: SparkSession, path: str, before: int) -> list:
    """Pieces known after the newest batch below a number; ``left`` is the batch that folded one away, null while it counts."""
    known = [n for n in versions(spark, f"{path}/manifest") if n < before]
    if not known:
        return []
    # a row a piece: at most TIER of them on each of the few levels, and those that have just left
    return spark.read.schema(PIECES).json(f"{path}/manifest/v={known[-1]}").collect()


def store_changes(batch: DataFrame, number: int, path: str, keys: list[str], tier: int = TIER) -> None:
    """Add a batch of changes as a piece. When a level has ``tier`` pieces they are folded into one of the next level,
    dealt out by key, so the pieces to read grow with the logarithm of the number of batches.

    A batch ends with a manifest of the pieces that count. A replayed batch starts from the manifest before it and writes the
    same pieces again. A piece that was folded away is deleted two batches later, when no replay can need it.
    """
    spark = batch.sparkSession
    known = [r.asDict() for r in _manifest(spark, path, number)]
    place = f"{path}/level=0/piece={number}"
    batch.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(place)
    known.append({"place": place, "level": 0, "first": number, "last": number, "left": None})
    level = 0
    while len(full := [p for p in known if p["level"] == level and p["left"] is None]) >= tier:
        merged = _newest(spark.read.parquet(*[p["place"] for p in full]), keys)
        place = f"{path}/level={level + 1}/piece={number}"
        merged.write.mode("overwrite").parquet(place)
        for p in full:
            p["left"] = number
        known.append({"place": place, "level": level + 1, "first": min(p["first"] for p in full),
                      "last": max(p["last"] for p in full), "left": None})
        level += 1
    old = [p for p in known if p["left"] is not None and p["left"] <= number - 2]
    kept = [tuple(p.values()) for p in known if p not in old]
    write_version(spark.createDataFrame(kept, PIECES).coalesce(1), f"{path}/manifest", "json", number=number)
    for p in old:
        delete(spark, p["place"])


def pieces(spark: SparkSession, path: str) -> list[str]:
    """Places of the pieces that count now."""
    return [p["place"] for p in _manifest(spark, path, 1 << 62) if p["left"] is None]


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All changes that count, for ``fold_changes``."""
    return spark.read.parquet(*pieces(spark, path))


#: state on the executors' disks with a bounded part in memory, so that keys ever seen may outgrow it
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256"}


DEFAULT_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "false",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500"}


def _write_changes(stream: DataFrame, path: str, checkpoint: str, keys: list[str]):
    """Run what is available, with state in a store of bounded memory. Settings the session has itself stay as they are."""
    spark = stream.sparkSession
    mine = [k for k in STATE_STORE if spark.conf.get(k, None) in (None, DEFAULT_STORE.get(k))]
    before = {k: spark.conf.get(k, None) for k in mine}
    for k in mine:
        spark.conf.set(k, STATE_STORE[k])
    try:
        query = (stream.writeStream.outputMode("update").foreachBatch(lambda batch, number: store_changes(batch, number, path, keys))
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()
    return query


def stream_tape(transfers: DataFrame, path: str, checkpoint: str, late: str = "2 days") -> None:
    """Daily tape state per (day, payee, payer). Unique payers and concentration are not
    incremental over a plain window, so the pair state is kept and the payee row is derived
    from it at read time. Input stream: (ts, payee, payer, units, block)."""
    pairs = (transfers.withWatermark("ts", late)
             .groupBy(F.window("ts", "1 day").alias("w"), "payee", "payer")
             .agg(F.count("*").alias("n"), F.sum("units").alias("units"),
                  F.min("block").alias("first_block"), F.max("block").alias("last_block")))
    flat = pairs.select(F.date_format("w.start", "yyyy-MM-dd").alias("date"), "payee", "payer", "n",
                        "units", "first_block", "last_block")
    _write_changes(flat, path, checkpoint, ["date", "payee", "payer"])


def tape_from_pairs(pairs: DataFrame) -> DataFrame:
    """Payee rows of the tape out of folded pair state."""
    return pairs.groupBy("date", "payee").agg(
        F.sum("n").alias("settlements"), F.sum("units").alias("units"),
        F.count("*").alias("unique_payers"), F.count_if(F.col("n") > 1).alias("repeat_payers"),
        F.max("units").alias("top_units"), F.min("first_block").alias("first_block"),
        F.max("last_block").alias("last_block"))


def stream_first_seen(listings: DataFrame, path: str, checkpoint: str):
    """Earliest sighting per URL. The state is one timestamp per URL ever seen, on disk, with a bounded part in memory."""
    first = listings.groupBy("url").agg(F.min("ts").alias("ts"))
    return _write_changes(first, path, checkpoint, ["url"])


def stream_usage(hits: DataFrame, path: str, checkpoint: str, late: str = "2 days") -> None:
    """Hits per tool over seven trailing days, one window per day."""
    counts = (hits.withWatermark("ts", late)
              .groupBy(F.window("ts", "7 days", "1 day").alias("w"), "tool")
              .agg(F.count("*").alias("n")))
    flat = counts.select(F.date_format("w.start", "yyyy-MM-dd").alias("start"), "tool", "n")
    _write_changes(flat, path, checkpoint, ["start", "tool"])


BUCKETS = 64


def stream_ledger(receipts: DataFrame, path: str, checkpoint: str) -> None:
    """Store streamed receipts, one row per id (the earliest). Rows are kept by a hash of the id in
    ``BUCKETS`` parts; a batch writes only the parts it touches, as a version of its own, so a lost or
    replayed batch leaves the others whole."""
    def store(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        rows = batch.withColumn("bucket", F.pmod(F.xxhash64("receipt_id"), F.lit(BUCKETS)).cast("int"))
        touched = [r[0] for r in rows.select("bucket").distinct().collect()]  # at most BUCKETS
        parts = _parts(spark, path, number)
        old = [parts[b] for b in touched if b in parts]
        if old:
            rows = rows.unionByName(_stored(spark, path, old))
        if touched:
            write_version(one_per_id(rows), path, number=number, partition_by=("bucket",))

    query = (receipts.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def _parts(spark: SparkSession, path: str, before: int) -> dict[int, str]:
    """Newest folder of every part among the versions before a number."""
    jvm, out = spark.sparkContext._jvm, {}
    for number in versions(spark, path):
        if number < before:
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/v={number}")
            listed = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
            names = [s.getPath().getName() for s in listed]
            out |= {int(n[7:]): f"{path}/v={number}/{n}" for n in names if n.startswith("bucket=")}
    return out


def _stored(spark: SparkSession, path: str, places: list[str]) -> DataFrame:
    return spark.read.option("basePath", path).parquet(*places).drop("v")


def current_ledger(spark: SparkSession, path: str, ledger: DataFrame | None = None) -> DataFrame:
    """The ledger with everything streamed so far as fresh receipts: equal to ``supersede`` of the
    ledger by all streamed receipts, however these were split into batches."""
    fresh = _stored(spark, path, list(_parts(spark, path, 1 << 62).values())).drop("bucket")
    return fresh if ledger is None else supersede(ledger, fresh)
