"""Landed files in any layout, published sets, change pieces and running totals."""

import json

import pytest
from pyspark.sql import functions as F

from tollgauge import schemas
from tollgauge.operators import archive, graph, guards, ranks, receipts, registry
from tollgauge.sources import landed, publish, storage
from tollgauge.streaming import streams


@pytest.fixture
def cores(spark):
    """Set the number of cores that splits of files follow."""
    name = "spark.sql.leafNodeDefaultParallelism"
    before = spark.conf.get(name, None)
    yield lambda n: spark.conf.set(name, str(n))
    spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_registry_order_is_that_of_names_and_rows(spark, tmp_path, cores):
    want = []
    for name, n in (("a", 2), ("b", 200), ("c", 50)):
        docs = [{"resource": f"https://{name}.com/{i}"} for i in range(n)]
        (tmp_path / f"{name}.json").write_text("\n".join(map(json.dumps, docs)) if name == "b" else json.dumps(docs))
        want += [d["resource"] for d in docs]
    for n in (1, 4, 16):
        cores(n)
        rows = landed.read_registry(spark, str(tmp_path), multiline=True).orderBy("ordinal").collect()
        names = [r["resource"] for r in rows]
        # a file of lines read as one document gives its first line only
        assert names == [w for w in want if ".com/" in w and not (w.startswith("https://b") and not w.endswith("/0"))]
        assert [r["ordinal"] for r in rows] == list(range(len(names)))


def test_line_files_are_numbered_across_their_parts(spark, tmp_path, cores):
    want = []
    for name, n in (("a", 2), ("b", 9000), ("c", 50)):
        docs = [{"resource": f"https://{name}.com/{i}"} for i in range(n)]
        (tmp_path / f"{name}.json").write_text("\n".join(map(json.dumps, docs)))
        want += [d["resource"] for d in docs]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        for n in (1, 4, 16):
            cores(n)
            rows = landed.read_registry(spark, str(tmp_path), multiline=False)
            assert [r["resource"] for r in rows.orderBy("ordinal").collect()] == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_running_total_in_any_layout(spark):
    rows = [(i * 7919 % 5003, i % 7 if i % 5 else None) for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, v long")
    total, want = 0, {}
    for k, v in sorted(rows):
        total += v or 0
        want[k] = total
    for layout in (df.repartition(13), df.coalesce(1)):
        got = ranks.running_total(layout, "v", ["k"], "t")
        assert {r["k"]: r["t"] or 0 for r in got.collect()} == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
    assert ranks.running_total(df.limit(0), "v", ["k"], "t").collect() == []


def test_budget_has_no_task_that_sees_all_prices(spark):
    df = spark.createDataFrame([(f"u{i}", i / 1000) for i in range(500)], "url string, price double")
    out = registry.within_budget(df, 1.0)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    spent, want = 0, 0
    for i in range(500):
        if spent + i > 1000:
            break
        spent, want = spent + i, want + 1
    assert out.count() == want


def captures(spark, folder, rows):
    landed.append_captures(spark.createDataFrame(rows, schemas.CAPTURE), folder)
    return archive.capture_pointers(archive.with_payment(landed.read_captures(spark, folder)))


def said(tx, price):
    return json.dumps({"success": True, "data": {"price": price}, "metadata": {"payment": {"success": True, "transactionHash": tx}}})


def test_pointers_survive_added_and_split_files(spark, tmp_path):
    tx = "0x" + "1" * 64
    rows = [(f"2026-08-{12 + i}T0{i}", "https://a.com/x", "GET", None, 0, said(tx, i), "") for i in range(3)]
    calls = spark.createDataFrame([("https://a.com/x", tx)], "url string, tx string")
    first = archive.link_first(calls, captures(spark, str(tmp_path / "one"), rows)).first()
    last = archive.link_last(calls.select("url"), captures(spark, str(tmp_path / "one"), rows[::-1])).first()
    assert (first["raw_file"], last["raw_file"]) == ("raw_2026-08-12", "raw_2026-08-14")
    for i, r in enumerate(rows[::-1]):
        pointers = captures(spark, str(tmp_path / "two"), [r, ("2026-08-13T05", f"https://b.com/{i}", "GET", None, 0, "{}", "")])
    assert archive.link_first(calls, pointers).first()["raw_id"] == first["raw_id"]
    assert archive.link_last(calls.select("url"), pointers).first()["raw_id"] == last["raw_id"]
    archive.write_pointers(pointers, str(tmp_path / "table"))
    assert archive.read_pointers(spark, str(tmp_path / "table")).exceptAll(pointers).isEmpty()


def test_accuracy_receipts_carry_a_pointer_and_fit_the_ledger(spark, tmp_path):
    tx = "0x" + "2" * 64
    pointers = captures(spark, str(tmp_path / "c"), [("2026-08-12T01", "https://a.com/q", "GET", None, 0, said(tx, 7), "")])
    rows = spark.createDataFrame([("https://a.com/q", "a.com", 0.01, True, "$7.5", "12", ".price", "AAPL", 7.49, "2026-08-12T09:00")],
                                 "url string, host string, quoted double, paid boolean, price string, dev_bps string, field string, "
                                 "symbol string, reference double, generated string")
    row = receipts.as_ledger(receipts.receipts_of_source(rows, "stock", pointers)).first()
    assert (row["raw_file"], row["tx"], row["status"], row["charged"], row["ts"]) == ("raw_2026-08-12", tx, "accurate", "0.01", "2026-08-12")
    assert row["raw_id"] and row["promised"] is None and row["metric"] == "AAPL real-time stock price"
    checked = receipts.verify_accuracy(receipts.receipts_of_source(rows, "stock", pointers)).first()
    assert checked["integrity"] and checked["verdict"]


def test_a_refused_mart_leaves_the_whole_set(spark, tmp_path):
    base, rows = str(tmp_path / "set"), lambda *n: spark.createDataFrame([(i,) for i in n], "id long")

    def job(board, probe, *probe_guards):
        def run(r):
            staged = r.stage("board", board, guards.not_empty)
            assert staged.count() == board.count()
            r.stage("probe", probe, *probe_guards)
        return run

    with pytest.raises(FileNotFoundError):
        publish.published(spark, base, "board")
    assert publish.publish(spark, base, job(rows(1, 2, 3, 4), rows(1, 2))) is None
    why = publish.publish(spark, base, job(rows(9), rows(1), guards.no_shrink(0.75)))
    assert why == "got 1 rows against 2 before (floor 0.75x)"
    assert sorted(r["id"] for r in publish.published(spark, base, "board").collect()) == [1, 2, 3, 4]
    assert publish.manifest(spark, base)["probe"][1] == 2
    assert publish.publish(spark, base, job(rows(9), rows(1), guards.no_shrink(0.5))) is None
    assert [r["id"] for r in publish.published(spark, base, "board").collect()] == [9]
    missing = rows(9, 10).withColumnRenamed("id", "k")
    assert "1 keys are missing" in publish.publish(spark, base, lambda r: r.stage("board", rows(9), guards.covers("id", missing)))


def test_pieces_stay_few_and_say_the_same(spark, tmp_path):
    path, want = str(tmp_path / "changes"), {}
    for n in range(50):
        rows = [(f"k{(n * 7 + j) % 11}", n * 10 + j) for j in range(3)]
        want |= dict(rows)
        batch = spark.createDataFrame(rows, "k string, v long").coalesce(1)
        streams.store_changes(batch, n, path, ["k"], tier=4)
        if n % 10 == 9:
            streams.store_changes(batch, n, path, ["k"], tier=4)  # replayed
            got = streams.fold_changes(streams.read_changes(spark, path), ["k"]).collect()
            assert {r["k"]: r["v"] for r in got} == want and len(got) == len(want)
            assert len(streams.pieces(spark, path)) <= 9
    kept = [p for level in (tmp_path / "changes").glob("level=*") for p in level.iterdir() if not p.name.startswith(".")]
    assert len(kept) < 25  # pieces that were folded away are gone


def test_first_seen_keeps_its_state_on_disk(spark, tmp_path):
    rows = [(f"u{i % 700}", f"2026-08-{10 + i % 9:02d} 00:00:00") for i in range(3000)]
    df = spark.createDataFrame(rows, "url string, t string").select("url", F.col("t").cast("timestamp").alias("ts"))
    want = {r["url"]: r["ts"] for r in df.groupBy("url").agg(F.min("ts").alias("ts")).collect()}
    src, path = str(tmp_path / "in"), str(tmp_path / "table")
    for part in df.randomSplit([0.5, 0.5], 1):
        part.coalesce(1).write.mode("append").parquet(src)
        query = streams.stream_first_seen(spark.readStream.schema(df.schema).parquet(src), path, str(tmp_path / "cp"))
    got = streams.fold_changes(streams.read_changes(spark, path), ["url"])
    assert {r["url"]: r["ts"] for r in got.collect()} == want
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 700 and any(m.startswith("rocksdb") for m in state["customMetrics"])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_extended_components_equal_those_of_all_edges(spark):
    import random
    rng = random.Random(3)
    edges = [(f"n{rng.randrange(90):02d}", f"n{rng.randrange(90):02d}") for _ in range(70)]
    df = lambda rows: spark.createDataFrame(rows, "a string, b string")
    whole = {r["node"]: r["component"] for r in graph.components(df(edges)).collect()}
    labels = graph.components(df(edges[:40]))
    grown = graph.extend_components(labels, df(edges[40:]))
    assert {r["node"]: r["component"] for r in grown.collect()} == whole
    assert storage.versions(spark, "/nowhere/at/all") == []
