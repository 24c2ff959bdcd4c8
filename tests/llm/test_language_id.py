import numpy as np

from tollgauge.llm import language_id as op

SF = "/root/testdata/sf0.01"


def test_gradients_equal_differences():
    p = {k: v.astype(np.float64) for k, v in op.start(3, 4, 1).items()}
    rng = np.random.default_rng(0)
    data, used = rng.integers(0, 256, (7, 5)).astype(np.uint8), np.ones((7, 5))
    used[5:, 2] = 0
    label = np.array([0, 1, 2, 1, 0])
    _, g = op.gradients(p, data, used, label)
    for k in p:
        at = (int(data[1, 0]), 2) if k.endswith("_e") else tuple(rng.integers(0, s) for s in p[k].shape)
        loss = []
        for d in (1e-2, -1e-2):
            moved = p[k].copy()
            moved[at] += d
            loss.append(op.gradients(p | {k: moved}, data, used, label)[0])
        assert abs((loss[0] - loss[1]) / 2e-2 - g[k][at]) < 1e-4


def test_labeller_equals_the_plain_network():
    p = op.start(3, seed=5)
    data = np.random.default_rng(1).integers(0, 256, (op.STEPS, 9)).astype(np.uint8)
    (f, _), (b, _) = op._read(p, "f", data), op._read(p, "b", data)
    want = op._softmax(np.concatenate([f, b], axis=2) @ p["o"] + p["c"])
    assert np.abs(op.Labeller(p).probabilities(data) - want).max() < 1e-4
    texts = [b"", b"abc", bytes(range(256)) * 3]
    mean, labelled = op.Labeller(p).documents(texts)
    assert labelled.sum(axis=1).tolist() == [0, 3, 768] and np.allclose(mean[1:].sum(axis=1), 1, atol=1e-5)


def test_held_out_accuracy_and_edge_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "", None), (-3, "12 ?!", "fr"), (-4, "é", None), (-4, "é", None), (None, "the", "en")], docs.schema)
    rows = op.identified(docs.unionByName(odd)).collect()
    fold = {r["doc_id"] for r in op.query(spark, SF).where("held_out").select("doc_id").collect()}
    tested = [r for r in rows if r["doc_id"] in fold]
    assert len(tested) > 200 and sum(r["_language"]["lang"] == r["lang"] for r in tested) >= 0.97 * len(tested)
    by = {r["doc_id"]: r["_language"] for r in rows}
    assert [by[i]["lang"] for i in (-1, -2, -3)] == ["und"] * 3 and by[-4]["lang"] != "und"
    assert all(sum(r["_language"]["bytes_labelled"].values()) == len(r["text"].encode()) for r in tested)
    assert op.identified(docs.limit(0)).count() == 0
    assert {r["_language"]["lang"] for r in op.identified(docs.limit(5).withColumn("lang", docs.lang.substr(0, 0)).replace("", None, "lang")).collect()} == {"und"}
