"""Ranked search against brute force over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgauge.llm import lexical_search as lexical

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def expected(docs, items, top=10):
    read = [(d, Counter(ts), len(ts)) for d, t in docs if (ts := words(t))]
    n, total = len(read), sum(x for _, _, x in read)
    df, out = Counter(t for _, c, _ in read for t in c), []
    for item, text in items:
        scores = []
        for d, c, size in read:
            m = 100 - 90 + (90 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(words(text)) if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def ranks(df):
    return sorted(((r["item"], r["rank"], r["doc"], r["score"]) for r in df.collect()), key=str)


def corpus(seed, docs, items):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    draw = lambda n: " ".join(vocabulary[min(int(rng.expovariate(0.02)), 299)] for _ in range(n))
    rows = [(i, draw(rng.randrange(1, 60))) for i in range(docs)]
    return rows, [(i, draw(rng.randrange(1, 25))) for i in range(items)]


def test_query_on_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = {t: [tuple(r) for r in spark.read.parquet(f"{folder}/{t}.parquet").select(k, "text").collect()]
            for t, k in (("documents", "doc_id"), ("benchmark", "item_id"))}
    got = sorted((tuple(r) for r in lexical.query(spark, folder).select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert got == expected(rows["documents"], rows["benchmark"]) and got


@pytest.mark.parametrize("limits", [{}, {"slice_terms": 60}])
def test_against_brute_force_with_small_shards(spark, monkeypatch, limits):
    monkeypatch.setattr(lexical, "SHARD_DOCS", 40)
    monkeypatch.setattr(lexical, "SEED_SHARDS", 3)
    docs, items = corpus(1, 500, 30)
    docs += [(1000 + i, docs[3][1]) for i in range(60)] + [(2000, None), (2001, ""), (2002, "..."), (None, docs[5][1]), (7, docs[7][1])]
    items += [(50, None), (51, "?!"), (52, docs[3][1]), (52, docs[3][1]), (None, "W1 w2"), (53, "absent")]
    df, asked = spark.createDataFrame(docs, DOCS).repartition(6), spark.createDataFrame(items, ITEMS)
    want = expected(docs, items)
    assert ranks(lexical.search(df, asked, **limits)) == want
    assert ranks(lexical.search(df, asked, top=3)) == expected(docs, items, 3)


def test_letters_cases_and_marks(spark):
    docs = [(1, "Straße ÄÖ x2-y3"), (2, "STRASSE äö x2"), (3, "日本語 テスト naïve\x00NAÏVE"), (4, "x2 " * 5)]
    items = [(1, "straße x2"), (2, "ÄÖ äö"), (3, "日本語 naïve NAÏVE"), (4, "Y3,X2")]
    got = ranks(lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)))
    assert got == expected(docs, items)


def test_blocks_are_skipped_and_bounds_hold():
    """Documents of different topics: an item about one leaves the blocks of the others unread."""
    rng = np.random.default_rng(3)
    topics, found, starts, tf = 12, [], [0], []
    for d in range(600):
        own = np.unique(np.r_[rng.integers(0, 20, 6) + 20 * (d % topics), 240 + rng.integers(0, 4, 2)])
        found.append(own)
        tf.append(rng.integers(1, 4, len(own)))
        starts.append(starts[-1] + len(own))
    names = [f"t{i:03}" for i in range(244)]
    items = lexical.Items([names] + [[*names[20 * k:20 * k + 20:2], *names[240:]] for k in range(topics)],
                          np.r_[np.full(240, 3000), np.full(4, 300)])
    starts, found, tf = np.array(starts), np.concatenate(found).astype(np.int32), np.concatenate(tf)
    impacts = lexical.impact(tf, np.full(len(tf), 100)).astype(np.int32)
    made = lexical.blocks(starts, found, impacts, items, block_docs=8)
    dense = lexical.matrix(starts, found, impacts, 244)
    shard = lexical.Shard(items, list(range(600)), starts, found, impacts, *made)
    at = 0
    for b, term in enumerate(made[0]):  # every summary is at least the maximum of its members
        beside = items.beside[term]
        members = made[2][made[1][b]:made[1][b + 1]]
        assert (made[3][at:at + len(beside)].astype(int) * (1 << 12) >= dense[members][:, beside].max(axis=0)).all()
        at += len(beside)
    assert at == len(made[3])
    for item in range(1, topics + 1):
        scores = dense[:, items.terms[item]].astype(np.int64) @ items.weights[items.terms[item]]
        want = sorted((-int(s), d) for d, s in enumerate(scores) if s > 0)[:10]
        assert [(s, d) for s, _, d in shard.search(item, [], 1)] == want
    assert shard.skipped > 2 * shard.visited


def test_long_items_use_the_maximum_of_the_shard():
    docs, items = corpus(9, 200, 6)
    texts = [words(t) for _, t in items]
    vocabulary = sorted({t for ts in texts for t in ts})
    counts = [Counter(t for t in words(x) if t in vocabulary) for _, x in docs]
    found = [np.array([vocabulary.index(t) for t in sorted(c)], np.int32) for c in counts]
    starts = np.cumsum([0, *map(len, found)])
    impacts = lexical.impact(np.concatenate([[c[t] for t in sorted(c)] for c in counts]).astype(np.int64), np.int64(100)).astype(np.int32)
    few = lexical.Items([sorted(set(ts)) for ts in texts], np.arange(len(vocabulary)) * 7 + 5, summary_terms=3)
    shard = lexical.Shard(few, [d for d, _ in docs], starts, np.concatenate(found), impacts,
                          *lexical.blocks(starts, np.concatenate(found), impacts, few, 4))
    for item, ts in enumerate(few.terms):
        scores = shard.dense[:, ts].astype(np.int64) @ few.weights[ts]
        assert [(s, d) for s, _, d in shard.search(item, [], 1)] == sorted((-int(s), d) for d, s in enumerate(scores) if s > 0)[:10]


def test_empty_tables_and_extra_columns(spark):
    docs, items = corpus(4, 50, 5)
    df, asked = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert ranks(lexical.search(spark.createDataFrame([], DOCS), asked)) == []
    assert ranks(lexical.search(df, spark.createDataFrame([], ITEMS))) == []
    more, wide = df, asked
    for name in ("_doc", "_text", "item", "rank", "score", "ids", "terms", "doc", "_item", "_terms"):
        more, wide = more.withColumn(name, F.lit("x")), wide.withColumn(name, F.lit("x"))
    assert ranks(lexical.search(more, wide)) == expected(docs, items)


def test_very_long_text(spark):
    docs = [(1, "a b c " * 300_000), (2, "a b"), (3, "c")]
    items = [(1, "a"), (2, "b c"), (3, "a b c " * 1000)]
    assert ranks(lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))) == expected(docs, items)
