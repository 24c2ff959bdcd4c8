import os
import random

import pytest

from tollgauge.llm import token_counts as op

pytestmark = pytest.mark.skipif(not os.path.exists(op.VOCABULARY), reason="no vocabulary file here")


def brute(word, score):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        s, n = max((best[b][0] + score[word[b:end]], -best[b][1] - 1) for b in range(end) if word[b:end] in score)
        best.append((s, -n))
    return best[-1][1]


def test_counts_equal_brute_force():
    score, rng = op.read_vocabulary(), random.Random(1)
    trie = op.Trie(score)
    words = [bytes(rng.choice(b"the anding\xc3\xa9\xff01-") for _ in range(rng.randint(1, 14))) for _ in range(500)] + [b" the", b"-" * 200]
    for w in words + words[:20]:
        assert trie.insert(w) == brute(w, score)
    text = b" ".join(words)
    pieces = op.PRETOKEN.findall(text)
    assert b"".join(pieces) == text and trie.count(text) == (sum(brute(p, score) for p in pieces), len(pieces))


def test_memory_bound_changes_nothing(monkeypatch):
    score = op.read_vocabulary()
    texts = [f"word{i} and more{i * 7} of it".encode() for i in range(300)]
    want = [op.Trie(score).count(t) for t in texts]
    monkeypatch.setattr(op, "NODES", 50)
    small = op.Trie(score)
    assert [small.count(t) for t in texts] == want


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 7), (2, "", 7), (3, "a b", 7), (3, "a b", 7), (None, " ", 7)], "doc_id long, text string, key int")
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["n_pretokens"]) for r in op.token_counts(docs).collect())
    assert got == [(0, 1, 1), (1, 0, 0), (2, 0, 0), (3, 2, 2), (3, 2, 2)]
    assert op.token_counts(docs.limit(0)).count() == 0
