import random

import pytest

from tollgauge.llm import deep_shallow, suffix_dedup as op


@pytest.mark.parametrize("seed", range(4))
def test_deep_shallow_order_sorts(seed):
    rng = random.Random(seed)
    common = bytes(rng.choice(b"ab") for _ in range(120))
    strings = [common[:rng.randint(0, 120)] + bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(0, 6)))
               for _ in range(300)] + [b"", b"", common, common]
    order = deep_shallow.deep_shallow_order(strings, list(range(len(strings))))
    assert sorted(order) == list(range(len(strings)))
    assert [strings[i] for i in order] == sorted(strings)


def brute(texts, need=op.NEED):
    datas, seen = [(t or "").encode() for t in texts], {}
    for i, d in enumerate(datas):
        for s in range(len(d) - need + 1):
            seen.setdefault(d[s:s + need], []).append((i, s))
    gone = [bytearray(len(d)) for d in datas]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                gone[i][s:s + need] = b"\x01" * need
    return [bytes(x for x, g in zip(d, mark, strict=True) if not g) for d, mark in zip(datas, gone, strict=True)]


def cases(seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    shared, base = [word(n) for n in (199, 200, 201, 420)], word(3000)
    texts = [word(rng.randint(0, 500)) + rng.choice(shared) + word(rng.randint(0, 400)) + rng.choice(shared) for _ in range(40)]
    for _ in range(12):  # near copies
        t = list(base)
        for _ in range(rng.randint(1, 9)):
            t[rng.randrange(len(t))] = "Z"
        texts.append("".join(t)[rng.randint(0, 50):])
    return texts + [None, "", "", word(150), "x" * 700, "ab" * 400, base, base, word(90), "é" * 150, "a" * 199, "a" * 199]


@pytest.mark.parametrize("seed, most", [(1, op.MOST), (2, 3)])
def test_kept_bytes_equal_brute_force(spark, seed, most):
    texts = cases(seed)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    from pyspark.sql import functions as F
    keyed = docs.withColumn("_text_id", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    rows = keyed.join(op.repeats(docs, with_text=True, most=most), "_text_id").collect()
    want = brute(texts)
    assert len(rows) == len(texts)
    for r in rows:
        assert bytes(r["kept"]) == want[r["doc_id"]], r["doc_id"]
        assert r["n_removed"] == len((r["text"] or "").encode()) - len(want[r["doc_id"]])


def test_slices_find_the_same_anchors(monkeypatch):
    data = cases(3)[0].encode() * 9
    powers = op._powers(op.SLICE + op.NEED)
    whole = op.anchors(data, powers)
    monkeypatch.setattr(op, "SLICE", 256)
    parts = op.anchors(data, powers)
    assert list(whole[0]) == list(parts[0]) and list(whole[1]) == list(parts[1])


def test_stage_keeps_rows_and_columns(spark):
    passage = "p q " * 80
    docs = spark.createDataFrame([(1, "é" + passage + "end", 9, "x"), (1, "start " + passage, 9, "x"), (2, None, None, "y"), (3, "", 0, None)],
                                 "doc_id long, text string, n_chars long, kept string")
    rows = op.without_repeats(docs).collect()
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in rows if r["text"] is not None) == [
        (1, "start", 5), (1, "éend", 4), (3, "", 0)]  # the space before the passage occurs within it too
    assert [tuple(r) for r in rows if r["text"] is None] == [(2, None, None, "y")]
    assert rows[0].__fields__ == docs.columns
    assert op.without_repeats(docs.limit(0)).count() == 0
