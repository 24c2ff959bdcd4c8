import itertools

import numpy as np
import pytest

from tollgauge.llm import quality_classifier as op

SF = "/root/testdata/sf0.01"


def test_linear_time_equals_all_pairs():
    machine = op.Machine(np.random.default_rng(2))
    machine.weight += np.random.default_rng(3).normal(0, 1, op.FEATURES)
    column, value = op.Featurer().of("Some words, some 12 words & more\nwords", 40)
    z = machine.logits(np.zeros(len(column), int), np.array(column), np.array(value), 1)[0][0]
    pairs = sum(machine.vector[i] @ machine.vector[j] * x * y for (i, x), (j, y) in itertools.combinations(list(zip(column, value)), 2))
    assert z == pytest.approx(machine.bias[0] + machine.weight[column] @ np.array(value) + pairs)


def test_held_out_rows(spark):
    rows = op.query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    assert sum(r["predicted"] for r in rows if r["quality"]) >= 0.97 * sum(r["quality"] for r in rows)


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "", 0), (3, "x " * 60_000, 120_000), (3, "a", 1), (None, "b", -5)],
                                 "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = op.scored(docs, labels)
    assert got.columns == [*docs.columns, "_quality"] and all(0 <= r["_quality"] <= 1 for r in got.collect())
    assert {r["_quality"] for r in op.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert op.scored(docs.drop("n_chars"), labels).count() == 5 and op.scored(docs.limit(0), labels).count() == 0
