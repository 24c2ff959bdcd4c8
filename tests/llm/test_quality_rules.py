import collections
import math
import re

import pytest
import xxhash

from tollgauge.llm import quality_rules as op

GAP = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in GAP.split(text or "") if w]


def base(text):
    text, words, seen, dup = text or "", words_of(text), set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def buckets(text):
    words = [w.encode() for w in words_of(text)]
    one = [xxhash.xxh64_intdigest(w, 42) for w in words]
    two = [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) for a, b in zip(words, words[1:])]
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    return [signed(h) % op.BUCKETS for h in one + two]


TEXTS = [None, "", " \n\t", "a b", "a b a b a b", "x y z x y z\nx y z", "# é ü <b> 100% $5\n\n a\n a\na", "w " * 400,
         "le chat noir dort sur le grand tapis rouge " * 9, "é" * 3000 + " tail", " ".join(f"w{i}" for i in range(120)),
         " ".join(f"w{i}" for i in range(120)), " ".join(f"v{i}" for i in range(49)), "one two three four " * 2 + " ".join(f"k{i}" for i in range(60)),
         "a\x0bb\x0cc\rd"]


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(i if i != 3 else None, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, kept string")
    trusted = spark.createDataFrame([(8,), (10,), (10,), (None,), (99,)], "doc_id long")
    rows = op.judged(docs, trusted).collect()
    raw, good = collections.Counter(), collections.Counter()
    for i, t in enumerate(TEXTS):
        raw.update(buckets(t))
        if i in (8, 10):
            good.update(buckets(t))
    ratio = [math.log((good[b] + 1) / (sum(good.values()) + op.BUCKETS)) - math.log((raw[b] + 1) / (sum(raw.values()) + op.BUCKETS))
             for b in range(op.BUCKETS)]
    assert len(rows) == len(TEXTS)
    for r in rows:
        want = base(r["text"])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, r["text"]
        grams = buckets(r["text"])
        score = sum(ratio[b] for b in grams) / len(grams) if grams else 0.0
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["log_ratio"] == pytest.approx(score, abs=1e-9) and r["base_failed"] == failed
        assert r["kept"] == (not failed and r["log_ratio"] >= op.THRESHOLD)


def test_plan_is_native_and_empty_tables_work(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    trusted = spark.createDataFrame([], "doc_id long")
    out = op.judged(docs, trusted)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 0 and "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
