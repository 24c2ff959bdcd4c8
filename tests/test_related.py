"""Related posts against all pairs, and how many pairs are formed."""

import random

import pytest

from tollgauge.operators import ratings

SCHEMA = "id long, service string, tags array<string>"


def brute(rows, k=4):
    out = []
    for i, s, tags in rows:
        found = []
        for j, s2, tags2 in rows:
            shared = len(set(tags or ()) & set(tags2 or ()))
            same = bool(s) and s == s2
            if i != j and (same or shared):
                found.append((not same, -shared, j))
        out += [(i, j, n + 1) for n, (_, _, j) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("common", [0, 2, 200])
def test_related_equals_all_pairs(spark, common):
    rng = random.Random(common)
    rows = []
    for i in range(260):
        tags = ["every"] + rng.sample(["a", "b", "c", "d", "e", "f", "g"], rng.randrange(0, 4)) + ([f"r{rng.randrange(40)}"] if i % 3 else [])
        rows.append((i * 7 % 1009, rng.choice(["", None, "s1", "s1", "s2", f"t{i % 30}"]), rng.choice([tags, tags, tags, [], None])))
    got = ratings.related(spark.createDataFrame(rows, SCHEMA), 4, common)
    assert sorted((r["id"], r["related_id"], r["rank"]) for r in got.collect()) == brute(rows)


def test_a_tag_on_every_post_makes_no_pairs_of_sets(spark):
    for n in (400, 1600):
        rows = [(i, f"s{i}", ["every", f"own{i}"]) for i in range(n)]
        sets = spark.createDataFrame(rows, SCHEMA).selectExpr("'' as scope", "array_join(tags, '-') as tset", "tags")
        rare, kinds, between = ratings._overlaps(sets, 200)
        assert (rare.count(), kinds.count(), between.count()) == (n, n, 1)  # each set with itself, and one kind with itself
