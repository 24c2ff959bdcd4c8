"""One-permutation MinHash against exact Jaccard, and its documents' pairs and edits against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tollgauge.llm import minhash_fingerprints as minhash

SCHEMA = "doc_id bigint, text string"


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """doc_id: (n_chars, hash of the edited text, edited text, next text), for different ids."""
    rows, out = sorted((d, t or "") for d, t in rows), {}
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(t) // 4
        edited = t[:len(t) - cut] + after[:cut]
        out[d] = len(t), hashlib.sha256(edited.encode()).hexdigest(), edited, after
    return out


def written(tmp_path, spark, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_query_on_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want, texts = expected(rows), dict(rows)
    got = minhash.query(spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(want)
    off = []
    for r in got:
        n, sha, edited, after = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        assert len(r["fingerprint"]) == len(r["edited_fingerprint"]) == minhash.BINS * minhash.BITS // 4
        off += [r["near_edited"] - jaccard(texts[r["doc_id"]], edited), r["near_next"] - jaccard(texts[r["doc_id"]], after)]
    assert max(map(abs, off)) < 0.17 and abs(sum(off) / len(off)) < 0.01
    assert sum(abs(x) < 0.08 for x in off) >= 0.97 * len(off)


def test_likeness_at_all_lengths_is_unbiased(spark):
    """Short texts leave most bins empty; the draws must not bend the estimate."""
    rng, rows = random.Random(5), []
    for words in (6, 12, 40, 300, 3000):
        for share in (0.0, 0.3, 0.6, 0.9):
            for _ in range(60):
                a = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
                keep = int(words * share)
                b = a[:keep] + [f"x{rng.randrange(10 ** 6)}" for _ in range(words - keep)]
                rows.append((words, share, " ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "words int, share double, a string, b string")
    df = minhash.with_fingerprint(minhash.with_fingerprint(df, "a", "fa"), "b", "fb")
    got = df.select("words", "share", "a", "b", minhash.likeness(F.col("fa"), F.col("fb")).alias("near")).collect()
    cells = {}
    for r in got:
        cells.setdefault((r["words"], r["share"]), []).append((r["near"], jaccard(r["a"], r["b"])))
    for cell, values in cells.items():
        near, true = (sum(v[i] for v in values) / len(values) for i in (0, 1))
        assert abs(near - true) < (0.02 if true else 0.06), (cell, near, true)


def test_equal_texts_short_and_empty_texts(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one "), (6, "one two three four"), (7, "a b c d e"), (8, "b c d e a"),
            (9, "a b c d e a b c d e a b c d e"), (10, "a b c d e a b c d e")]
    got = {r["doc_id"]: r["p"] for r in minhash.with_fingerprint(spark.createDataFrame(rows, SCHEMA), "text", "p").collect()}
    assert got[1] == got[2] == got[3] == [0] * (minhash.BINS * minhash.BITS // 64)
    assert got[4] == got[5] and got[9] == got[10]
    assert len({tuple(got[i]) for i in (1, 4, 6, 7, 8, 9)}) == 6


@pytest.mark.parametrize("range_rows", [50_000, 3])
def test_pairs_with_repeated_null_and_hot_keys(spark, range_rows):
    rng = random.Random(1)
    rows = [(rng.choice([None, 5, 5, 5, *range(40)]), f"t{rng.randrange(30)}") for _ in range(300)] + [(5, "same")] * 40
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = minhash.following(df, "doc_id", "text", ["doc_id", "text"], range_rows).collect()
    assert sorted(map(str, (tuple(r["row"]) for r in got))) == sorted(map(str, rows))
    assert sorted(map(str, (tuple(r["next"]) for r in got))) == sorted(map(str, rows))  # everyone follows one row
    keys = [None, *sorted({k for k, _ in rows if k is not None})]
    place = {k: i for i, k in enumerate(keys)}
    steps = [place[r["next"]["doc_id"]] - place[r["row"]["doc_id"]] for r in got]
    assert sorted(steps)[0] == 1 - len(keys) and sorted(steps)[1:] == [0] * (len(rows) - len(keys)) + [1] * (len(keys) - 1)
    again = minhash.following(df.repartition(3), "doc_id", "text", ["doc_id", "text"], range_rows).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_one_row_empty_table_extra_columns_and_wide_characters(spark, tmp_path):
    one = minhash.query(spark, written(tmp_path / "one", spark, [(3, "ab😀d efgh")])).collect()
    assert one[0]["n_chars"] == 9
    assert one[0]["edited_sha256"] == hashlib.sha256("ab😀d efab".encode()).hexdigest()
    assert one[0]["near_next"] == 1.0
    assert minhash.query(spark, written(tmp_path / "none", spark, [])).collect() == []
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "b c d e f g")], SCHEMA)
    more = df
    for name in ("_key", "_tie", "_range", "_at", "row", "next", "_head", "_of", "p", "p__0"):
        more = more.withColumn(name, F.lit(1))
    plain = minhash.following(df, "doc_id", "text", ["doc_id"]).collect()
    assert minhash.following(more, "doc_id", "text", ["doc_id"]).collect() == plain


def test_very_long_text(spark):
    text = " ".join(f"w{i % 70000}" for i in range(400_000))
    df = spark.createDataFrame([(1, text), (2, text + " end")], SCHEMA)
    a, b = (r["p"] for r in minhash.with_fingerprint(df, "text", "p").orderBy("doc_id").collect())
    assert sum(x == y for x, y in zip(a, b, strict=True)) >= len(a) - 1


def test_no_python_in_the_plan(spark):
    plan = minhash.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
