import random

import numpy as np
import pytest

from tollgauge.llm import source_mixing as op


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    fixed, total = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        part = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if part[s] > 2 * sizes[s]]
        if not over:
            return fixed | part
        fixed |= {s: 2.0 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(5))
def test_targets(seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 5, 100, 10_000]) for s in ["a", "b", "é", "Z", "z1", None][:rng.randint(1, 6)]}
    got, want = op.targets(sizes), brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in got)
    assert abs(sum(got.values()) - 1.5 * sum(sizes.values())) < 1e-6


def test_split_tree_is_exact():
    quotas = np.array([1000, 0, 7, 333])
    dealt = op.split_tree(quotas, 13, 1)
    assert (dealt.sum(axis=0) == quotas).all() and (dealt >= 0).all()
    assert dealt.sum(axis=1).max() - dealt.sum(axis=1).min() <= 2
    assert (dealt == op.split_tree(quotas, 13, 1)).all()
    assert abs(dealt[:, 0] - 1000 / 13).max() < 12


def test_a_large_document_that_comes_late_is_fitted():
    taken = op.fitting([100, 100, 100, 100, 350], 420)
    assert sum(n for n, t in zip([100, 100, 100, 100, 350], taken) if t) == 400
    taken = op.fitting([90, 90, 90, 90, 350], 440)
    assert sum(n for n, t in zip([90, 90, 90, 90, 350], taken) if t) == 440
    assert op.fitting([], 5) == [] and op.fitting([7], 5) == [False]


def corpus(spark, n=900):
    rng = random.Random(4)
    rows = [(i, " ".join("w" * rng.choice([1, 2]) for _ in range(rng.choice([0, 3, 40, 90]))), rng.choice(["hot", "hot", "hot", "b", "c", None]), 1)
            for i in range(n)]
    rows += [(n, None, "d", 1), (n, None, "d", 1), (n + 1, "x y " * 1200, "b", 1), (None, "q", "c", 2), (5, rows[5][1], rows[5][2], 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, mix_copy int")


def test_taken_words_meet_the_targets(spark):
    docs = corpus(spark)
    sizes, draws, shards = op.mix(docs, block_words=700)
    assert shards == op.SHARDS
    count = {r["_mix_row"]: r["n"] for r in draws.groupBy("_mix_row").count().withColumnRenamed("count", "n").collect()}
    rows = sizes.collect()
    taken, want, have = {}, {}, {}
    for r in rows:
        n = count.get(r["_mix_row"], 0)
        assert n <= 2
        taken[r["source"]] = taken.get(r["source"], 0) + n * r["_mix_size"]
        have[r["source"]] = have.get(r["source"], 0) + r["_mix_size"]
        want[r["source"]] = r["_mix_target"]
    assert len(rows) == docs.count() and brute_targets(have) == pytest.approx(want)
    for s in want:
        assert abs(taken[s] - want[s]) <= 90 or taken[s] == pytest.approx(want[s], rel=0.03)
    again = op.mix(docs, block_words=700)[1]
    assert sorted(map(tuple, draws.collect())) == sorted(map(tuple, again.collect()))


def test_mixed_documents(spark):
    docs = corpus(spark, 60)
    rows = op.mixed_documents(docs, shards=4, block_words=100)
    assert rows.columns == ["doc_id", "text", "source", "mix_shard", "mix_copy"]
    got = rows.collect()
    assert len(set((r["mix_shard"]) for r in got)) > 1 and len(got) > 0
    assert op.mixed_documents(docs.limit(0)).count() == 0
