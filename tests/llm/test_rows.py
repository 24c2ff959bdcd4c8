"""Stages keep and lose the right rows when the number of cores changes between scans, and whatever their columns are called."""

import pytest
from pyspark.sql import functions as F

from tollgauge.llm import (
    common, decontamination, quality_classifier, quality_rules, simhash_dedup, source_mixing, suffix_dedup, toxicity)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
NAMES = ("number", "row", "_llm_row", "_row", "_key", "_class", "_text_id", "_toxicity", "score", "_mix_row", "_mix_shard", "_mix_order",
         "_words", "_text", "_llm_kept", "_null", "_new", "kept", "_quality", "mix_copy", "node", "size", "keys", "_llm_null")


def texts(n):
    """Different texts of 40 words, some repeated."""
    word = lambda i, j: f"w{(i * 7919 + j * 104729) % 99991}"
    return [" ".join(word(i // 2 if i % 10 == 0 else i + 10 ** 6, j) for j in range(40)) + "." for i in range(n)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A table of many row groups, whose splits follow the cores."""
    place = str(tmp_path_factory.mktemp("rows") / "documents.parquet")
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts(3000))]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.option("parquet.block.size", 20_000).parquet(place)
    return place


class Cores:
    """A table whose scans are split for another number of cores each time its plan is used."""

    def __init__(self, spark, place):
        self.spark, self.place, self.n = spark, place, 0

    def __enter__(self):
        self.before = self.spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
        return self

    def turn(self):
        self.n += 1
        self.spark.conf.set("spark.sql.leafNodeDefaultParallelism", str((4, 16, 2, 9)[self.n % 4]))

    def __exit__(self, *_):
        if self.before is None:
            self.spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        else:
            self.spark.conf.set("spark.sql.leafNodeDefaultParallelism", self.before)


def turning(monkeypatch, cores, module):
    """Turn the setting wherever a module settles a table, that is between its scans."""
    if hasattr(module, "settled"):
        plain = common.settled
        monkeypatch.setattr(module, "settled", lambda df: (plain(df), cores.turn())[0])
    if hasattr(module, "stored_rows"):
        kept = common.stored_rows
        monkeypatch.setattr(module, "stored_rows", lambda df: (kept(df), cores.turn())[0])


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_keep_one_while_cores_change(spark, stored, monkeypatch):
    docs = spark.read.parquet(stored)
    least = {}
    for i, t in enumerate(texts(3000)):
        least.setdefault(t, i)
    with Cores(spark, stored) as cores:
        turning(monkeypatch, cores, simhash_dedup)
        got = simhash_dedup.keep_one(docs)
        cores.turn()
        assert ids(got) == sorted(least.values())
        assert cores.n > 3


def test_clean_and_mix_while_cores_change(spark, stored, monkeypatch):
    docs = spark.read.parquet(stored)
    items = spark.createDataFrame([(1, texts(8)[7]), (2, texts(600)[501])], "item_id bigint, text string")
    with Cores(spark, stored) as cores:
        turning(monkeypatch, cores, decontamination)
        got = decontamination.clean(docs, items)
        cores.turn()
        assert ids(got) == [i for i in range(3000) if i not in (7, 501)]
        turning(monkeypatch, cores, source_mixing)
        mixed = source_mixing.mixed_documents(docs)
        cores.turn()
        rows = mixed.collect()
        body = dict(enumerate(texts(3000)))
        assert all(body[r["doc_id"]] == r["text"] and r["source"] == f"s{r['doc_id'] % 3}" for r in rows)
        assert len({(r["doc_id"], r["mix_copy"]) for r in rows}) == len(rows)
        assert abs(len(rows) - 4500) < 60


def test_stages_pass_columns_of_any_name(spark):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts(60))] + [(None, None, None, None, None), (5, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    more = docs.withColumns({c: F.concat(F.lit(f"{c}="), F.col("doc_id").cast("string")) for c in NAMES})
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([(1, texts(8)[7])], "item_id bigint, text string")
    stages = {
        "toxicity": lambda d: toxicity.without_toxic(d, labels, 0.99), "near": simhash_dedup.keep_one,
        "suffix": suffix_dedup.without_repeats, "clean": lambda d: decontamination.clean(d, items)}
    for name, stage in stages.items():
        plain, wide = stage(docs), stage(more)
        assert wide.columns == more.columns, name
        got = wide.collect()
        assert sorted(str(r[:5]) for r in got) == sorted(map(str, (tuple(r) for r in plain.collect()))), name
        assert all(r[c] == (None if r["doc_id"] is None else f"{c}={r['doc_id']}") for r in got for c in NAMES), name
        assert stage(docs.limit(0)).collect() == [], name
    wide = source_mixing.mixed_documents(more)
    assert set(wide.columns) == {*more.columns, "mix_shard"}
    assert all(r[c] == f"{c}={r['doc_id']}" for r in wide.where("doc_id is not null").collect() for c in NAMES if c not in ("mix_shard", "mix_copy"))
    assert source_mixing.mixed_documents(docs.limit(0)).collect() == []
    judged = quality_rules.judged(more, labels.where("quality = 1"))
    assert judged.count() == 62 and judged.where("_words is not null").count() == 61
    assert quality_classifier.scored(more, labels).columns.count("_quality") == 1


def test_labelled_rows_are_one_per_id(spark):
    docs = spark.createDataFrame([(1, f"text {i % 50}") for i in range(2000)] + [(2, "x"), (3, None)], "doc_id bigint, text string")
    ids = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id bigint, label int")
    rows = common.labelled_rows(docs, ids, "text").collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 2, 3]
    assert common.labelled_rows(docs.orderBy(F.desc("text")), ids, "text").collect() != [] and sorted(map(str, rows)) == sorted(
        map(str, common.labelled_rows(docs.orderBy(F.desc("text")), ids, "text").collect()))
