import random

import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from tollgauge.llm import simhash_dedup as op


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    width = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + width]), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(values, bits=3):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v
    order = sorted(set(values))
    for i, a in enumerate(order):
        for b in order[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    return {v: find(v) for v in order}


def same_partition(left, right):
    pairs = {(left[v], right[v]) for v in left}
    return len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


@pytest.mark.parametrize("text", ["", None, " \n", "one", "One two", "a b c", "É a B c ä d e f", "w " * 70000])
def test_fingerprint(text):
    assert op.simhash((text or "").encode()) == brute_print(text)


def planted(seed, n):
    """Dense clusters, so that keys are shared by many fingerprints, and lone ones."""
    rng, out = random.Random(seed), set()
    for _ in range(3):
        base = rng.getrandbits(64)
        for _ in range(n):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            out.add(x)
    out |= {rng.getrandbits(64) for _ in range(n)} | {0, 1, (1 << 64) - 1}
    return sorted(out)


@pytest.mark.parametrize("small", [2, 8, 512])
def test_links_connect_the_classes_of_all_pairs(spark, small):
    values = planted(small, 120)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = op.links(spark.createDataFrame(pd.DataFrame({"x": signed})), small=small).collect()
    parent = {v: v for v in signed}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for a, b in edges:
        parent[find(a)] = find(b)
    mine = {v % (1 << 64): find(v) for v in signed}
    assert same_partition(mine, brute_classes(values))


def test_edge_cases(spark):
    rows = [(5, "a b c d e f", 1), (3, "A b  c d e f", 2), (9, None, 3), (8, "", 4), (8, "", 4), (None, "x y z", 5), (1, "q", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _class long")
    got = {(r["_key"], r["_fingerprint"]): r["_class"] for r in op.near_duplicates(docs).collect()}
    assert len(got) == 6 and got[5, [k[1] for k in got if k[0] == 5][0]] == got[3, [k[1] for k in got if k[0] == 3][0]]
    assert got[9, 0] == got[8, 0]
    kept = op.keep_one(docs).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 1, 3, 8] and kept[0].__fields__ == ["doc_id", "text", "_class"]
    assert op.near_duplicates(docs.limit(0)).count() == 0 == op.keep_one(docs.limit(0)).count()


def test_near_copies_are_found_and_others_are_left(spark):
    rng = random.Random(9)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 10))) for _ in range(4000)]
    rows, n = [], 120
    for i in range(n):
        words = [rng.choice(vocab[:40]) if rng.random() < 0.3 else rng.choice(vocab) for _ in range(300)]
        copy = list(words)
        for j in rng.sample(range(300), 4):  # about 0.93 of the five-word shingles stay
            copy[j] = rng.choice(vocab)
        rows += [(i, " ".join(words)), (1000 + i, " ".join(copy))]
    rows += [(5000 + i, " ".join(rng.choice(vocab[:40]) for _ in range(12))) for i in range(60)]
    kept = {r["doc_id"] for r in op.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(range(n)) <= kept and len(kept & set(range(1000, 1000 + n))) <= 0.1 * n
    assert len([d for d in kept if d >= 5000]) == 60


def brute_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_near_classes(texts):
    """Least index that pairs with a five-word-shingle Jaccard of 0.8 or more reach."""
    sets = [brute_shingles(t) for t in texts]
    label, moved = list(range(len(sets))), True
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    while moved:
        moved = False
        for i, j in links:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                moved = True
    return label, links


def test_every_near_copy_is_verified_and_none_is_missed(spark):
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 10))) for _ in range(4000)]
    texts = []
    for i in range(60):
        words = [rng.choice(vocab) for _ in range(200)]
        shuffled = rng.sample(words, 200)  # the same words in another order
        texts += [" ".join(words), " ".join(shuffled)]
        for n in (2, 3, 4, 5, 6, 12, 20):  # similarities on both sides of 0.8
            copy = list(words)
            for j in rng.sample(range(200), n):
                copy[j] = rng.choice(vocab)
            texts.append(" ".join(copy))
    base = [rng.choice(vocab) for _ in range(200)]
    for _ in range(150):  # a large group
        copy = list(base)
        for j in rng.sample(range(200), rng.randint(0, 9)):
            copy[j] = rng.choice(vocab)
        texts.append(" ".join(copy))
    texts += ["pay 17 now", "pay 18 now", "Pay 17  now", "", None, "a b c d", "a b c e"]
    label, links = brute_near_classes(texts)
    rows = list(enumerate(texts))
    got = {r["_key"]: r["_class"] for r in op.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert same_partition(got, dict(enumerate(label)))
    assert len(links) > 200 and len(set(label)) > 200


def test_similarity_below_the_bands_is_refused(spark):
    with pytest.raises(ValueError):
        op.near_copies(spark.createDataFrame([(1, "a")], "doc_id long, text string"), similarity=0.5)


def test_near_copies_compares_texts_whose_fingerprints_are_near(spark, monkeypatch):
    """Without any band, what links by fingerprint is still found, and verified."""
    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[:-1], "end"])), (3, " ".join(reversed(words)))],
                                 "doc_id bigint, text string")
    classes = {r["_key"]: r["_class"] for r in op.near_copies(docs).collect()}
    near = {r["_key"]: r["_class"] for r in op.near_duplicates(docs).collect()}
    assert near[1] == near[2] != near[3]
    plan = op.links(docs.select(op.fingerprint_udf()(F.col("text").cast("binary")).alias("x")))
    assert plan.count() == 1 and classes[1] == classes[2] != classes[3]
    asked = []
    monkeypatch.setattr(op, "links", lambda prints, *more: asked.append(prints) or plan)
    op.keep_one(docs).collect()
    assert len(asked) == 1
