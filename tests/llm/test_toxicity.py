import random

import numpy as np

from tollgauge.llm import toxicity as op

SF = "/root/testdata/sf0.01"


def labelled(n=600, seed=3):
    """Insults mark toxic texts; toxic texts mention a group far more often than the others."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        toxic = i % 2
        words = [f"w{rng.randint(0, 80)}" for _ in range(30)]
        if toxic and rng.random() < 0.8:
            words[3] = rng.choice(["idiot", "moron"])
        if rng.random() < (0.7 if toxic else 0.05):
            words[5] = "women"
        rows.append((" ".join(words), toxic))
    return rows


def features(text):
    return np.array(sorted(op.features(set(op.tokens(text)))), np.int64)


def swapped(text):
    words = set(op.tokens(text))
    return np.array(sorted(op.features({op.SWAPS.get(w, w) for w in words})), np.int64) if words & op.SWAPS.keys() else None


def test_swap_penalty_takes_weight_from_group_mentions():
    rows = labelled()
    present, swaps = [features(t) for t, _ in rows], [swapped(t) for t, _ in rows]
    labels = np.array([y for _, y in rows])
    neutral = " ".join(f"w{i}" for i in range(20)) + " women"
    plain = op.fit(present, swaps, labels, swap_penalty=0.0).scorer()
    fair = op.fit(present, swaps, labels, swap_penalty=200.0).scorer()
    gap = lambda s: s(neutral) - s(neutral.replace("women", "men"))
    assert gap(plain) > 0.15 > 0.06 > abs(gap(fair))
    assert fair("you idiot") > fair("you") and fair("idiot moron w1") > 0.7


def test_the_default_penalty_frees_neutral_mentions_of_planted_groups():
    """Mentions planted as unevenly as in life: with the swaps the model calls far fewer neutral ones toxic and keeps its insults."""
    rows = labelled(800, 11)
    present, swaps = [features(t) for t, _ in rows], [swapped(t) for t, _ in rows]
    labels = np.array([y for _, y in rows])
    rng = random.Random(5)
    neutral = [" ".join(f"w{rng.randint(0, 80)}" for _ in range(30)) + f" {g}" for g in ("women", "men") for _ in range(100)]
    toxic = [t.replace("women", "w1") for t, y in rows if y and ("idiot" in t or "moron" in t)]
    blind = op.fit(present, [None] * len(rows), labels).scorer()
    fair = op.fit(present, swaps, labels).scorer()
    called = lambda s, texts: sum(s(t) >= 0.5 for t in texts) / len(texts)
    assert called(blind, neutral[:100]) > 0.5 and called(fair, neutral) < 0.1
    assert called(fair, toxic) > 0.9
    assert max(abs(fair(t) - fair(t.replace("women", "men"))) for t in neutral[:100]) < 0.03


def test_held_out_toxic_rows_are_found(spark):
    folder = "/root/testdata/sf0.1"
    rows = op.query(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_swaps_stay_within_their_list():
    assert op.SWAPS[b"women"] == b"men" and op.SWAPS["chrétiens".encode()] == b"musulmans"
    assert sorted(op.SWAPS) == sorted(op.SWAPS.values())


def test_held_out_rows(spark):
    rows = op.query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    clean = [r for r in rows if r["toxic"] == 0]
    toxic = [r for r in rows if r["toxic"] == 1]
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    # a score that is worth something: ranks toxic above clean
    pairs = [(t["score"] > c["score"]) for t in toxic for c in clean]
    assert sum(pairs) / len(pairs) > 0.8


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "x " * 50_000 + "idiot", 3), (3, "a", 3), (None, "b", 4)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, None, 0), (2, 1, 1), (None, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    got = op.scored(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r["_toxicity"] <= 1 for r in got) and "score" in got[0].__fields__
    none = labels.limit(0)
    assert {round(r["_toxicity"], 6) for r in op.scored(docs, none).collect()} == {round(0.01 / 1.01, 6)}
    assert op.without_toxic(docs, none).columns == docs.columns and op.scored(docs.limit(0), none).count() == 0
