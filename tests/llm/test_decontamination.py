import random

import numpy as np
import pytest

from tollgauge.llm import decontamination as op


def vocabulary(rng, n=3000):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def edit(words, n, rng, vocab):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[i] = rng.choice(vocab)
        elif kind == 1:
            words.insert(i, rng.choice(vocab))
        elif len(words) > 1:
            del words[i]
    return words


def brute_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    best = min(row)
    return best, row.index(best)


@pytest.mark.parametrize("seed", range(5))
def test_distance(seed):
    rng = random.Random(seed)
    pattern = [rng.randint(1, 6) for _ in range(rng.randint(1, 70))]
    text = edit(pattern, rng.randint(0, 9), rng, [1, 2, 7]) if seed % 2 else [rng.randint(1, 6) for _ in range(80)]
    index = op.Index([(1, np.array(pattern, np.uint64))])
    best, end = index.distance(0, text)
    want = brute_distance(pattern, text)
    assert best == want[0] and (end == want[1] or best == len(pattern))


def world(seed, share):
    """Items, and documents that hold an item with about this share of its words edited."""
    rng = random.Random(seed)
    vocab = vocabulary(rng)
    common = vocab[:60]
    draw = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(n)]
    items = [draw(rng.randint(15, 60)) for _ in range(80)]
    docs = []
    for i in range(240):
        item = items[i % 80]
        docs.append((i, " ".join(draw(rng.randint(0, 150)) + edit(item, int(share * len(item)), rng, vocab) + draw(rng.randint(0, 150))), i % 80))
    docs += [(1000 + i, " ".join(draw(200)), None) for i in range(200)]
    return [(i, " ".join(w)) for i, w in enumerate(items)], docs


@pytest.mark.parametrize("share, recall", [(0.0, 1.0), (0.05, 0.99), (0.1, 0.95), (0.15, 0.9)])
def test_recall_against_brute_force(spark, share, recall):
    items, docs = world(7, share)
    found = op.contaminated(spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string"),
                            spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in found}
    words = {i: t.split() for i, t in items}
    want = {}
    for d, text, i in docs:
        if i is not None:
            best = brute_distance(words[i], text.split())[0]
            if best <= len(words[i]) - np.ceil(0.8 * len(words[i]) - 1e-9):
                want[d, i] = best
    hit = [k for k in want if k in got]
    assert len(hit) >= recall * len(want), (len(hit), len(want))
    assert all(got[k] == want[k] for k in hit) and not {k for k in got if k[0] >= 1000}


def test_edge_cases(spark):
    item = " ".join(f"W{i}," for i in range(20))
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too short an item"), (None, item), (4, "")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " * 70_000 + item.lower() + " y" * 9, 0), (1, item, 0), (2, None, 0), (3, "", 0), (None, item, 0), (4, "w1 w2", 0)],
                                 "doc_id long, text string, distance int")
    got = op.contaminated(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"], r["distance"]) for r in got) == [(0, 1, 0), (1, 1, 0), (1, 1, 0)]
    assert {r["end_word"] for r in got} == {20, 70_020}
    assert [r["doc_id"] for r in op.clean(docs, bench).orderBy("doc_id").collect()] == [2, 3, 4] and op.clean(docs, bench).columns == docs.columns
    assert op.contaminated(docs, bench, slice_words=10).count() == 3
    assert op.contaminated(docs.limit(0), bench).count() == 0 == op.contaminated(docs, bench.limit(0)).count()


def distances(items, docs):
    """Brute force: least distance of each pair within 20 % word edits."""
    words, out = {i: t.split() for i, t in items}, {}
    for d, text, *_ in docs:
        for i, item in words.items():
            best = brute_distance(item, text.split())[0]
            if best <= len(item) - np.ceil(0.8 * len(item) - 1e-9):
                out[d, i] = best
    return out


def searched(spark, items, docs):
    found = op.contaminated(spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string"),
                            spark.createDataFrame(items, "item_id long, text string")).collect()
    return {(r["doc_id"], r["item_id"]): r["distance"] for r in found}


def sized(seed, low, high, share, n=60):
    rng = random.Random(seed)
    vocab = vocabulary(rng)
    draw = lambda n: [rng.choice(vocab[:60]) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(n)]
    items = [draw(rng.randint(low, high)) for _ in range(n)]
    docs = [(i, " ".join(draw(rng.randint(0, 40)) + edit(items[i % n], int(share * len(items[i % n])), rng, vocab) + draw(rng.randint(0, 40))))
            for i in range(2 * n)]
    return [(i, " ".join(w)) for i, w in enumerate(items)], docs


@pytest.mark.parametrize("share", [0.0, 0.1, 0.2])
def test_short_items_are_all_found(spark, share):
    items, docs = sized(3, 1, 13, share)
    want = distances(items, docs)
    assert len(want) > 100 and searched(spark, items, docs) == want


def test_scripts_without_spaces(spark):
    item = "水的化学式是什么？请选择正确的答案。"
    docs = [(1, "前言，" + item + "结束"), (2, "题目：水的化学式为什么，请选择正确答案"), (3, "今天天气很好，我们去公园散步吧。"), (4, "答案")]
    got = searched(spark, [(1, item), (2, "日本語のテスト")], [*docs, (5, "これは日本語のテストです")])
    assert {k for k, d in got.items()} == {(1, 1), (2, 1), (5, 2)} and got[1, 1] == 0 == got[5, 2]


@pytest.mark.parametrize("low, high, recall", [(14, 19, 1.0), (20, 39, 1.0), (15, 60, 0.95)])
def test_recall_at_the_threshold(spark, low, high, recall):
    items, docs = sized(11, low, high, 0.2, 60)
    want, got = distances(items, docs), searched(spark, items, docs)
    hit = [k for k in want if k in got]
    assert len(hit) >= recall * len(want) and all(got[k] == want[k] for k in hit) and got.keys() <= want.keys()
