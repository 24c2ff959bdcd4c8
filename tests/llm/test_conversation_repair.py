"""Conversation repair against a brute-force search over all edits."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tollgauge.llm import conversation_repair as repair

GAP = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def least(rows, most=12):
    """Cheapest (cost, audit) by a search over edits: rows are (initial, cost of keeping, must go)."""
    start, best = [(0, "", 0, "")], None
    front = {(0, "", 0): {""}}
    for cost in range(0, 4 * len(rows) + 13):
        done = set()
        todo = [(k, a) for k, v in front.items() if k[2] == cost for a in v]
        while todo:
            (i, state, c), edits = todo.pop()
            if i == len(rows) and state in ("", "a"):
                done.add(edits)
            due = "a" if state == "u" else "u"
            steps = [(i, due, 3, "I")]
            if i < len(rows):
                initial, kept, must = rows[i]
                steps.append((i + 1, state, 4, "D"))
                if not must:
                    if initial == due or (initial == "s" and state == ""):
                        steps.append((i + 1, initial, kept, "K"))
                    steps.append((i + 1, due, 3 + kept, "R"))
            for j, q, more, letter in steps:
                if letter == "I" and edits.endswith("I" * most):
                    continue
                key = (j, q, c + more)
                if more == 0:
                    todo.append((key, edits + letter))
                else:
                    # of equal ways to a state only the least can begin the least audit
                    held = front.setdefault(key, set())
                    held.add(edits + letter)
        if done:
            return cost, min(done)
        front = {k: v for k, v in front.items() if k[2] > cost}
    return start, best


def expected(turns):
    """The contract, conversation by conversation."""
    out, groups = {}, {}
    for conv, turn, role, text in turns:
        groups.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        groups[conv] += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, plan = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, role, text in rows:
            bare = text.strip(GAP)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            plan.append((role[:1], 3 * (fault == "truncated"), fault in ("blank", "duplicate")))
        known = [t for t, _, _ in rows if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit = least(plan)
        kept, state, i = [], "", 0
        for letter in audit:
            due = "a" if state == "u" else "u"
            if letter == "I":
                kept.append({"u": "user", "a": "assistant"}[due] + ":")
                state = due
                continue
            if letter != "D":
                state = rows[i][1][:1] if letter == "K" else due
                kept.append((rows[i][1] if letter == "K" else {"u": "user", "a": "assistant"}[due]) + ":" + rows[i][2])
            i += 1
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, faults["blank"], faults["duplicate"],
                     faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def of(rows):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
            for r in rows}


def run(df, **options):
    found = repair.digests(repair.repair(repair.damaged(df), **options)).withColumnRenamed("_conv", "conv_id")
    return of(found.collect())


def drawn(seed, conversations, rows=9):
    rng = random.Random(seed)
    out = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, rows)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "cut", " \t", "", None, "Eh? ", f"line {turn}.", "Ünï。"])
            out.append((None if conv == 7 else conv, rng.choice([turn, turn, turn, None, turn + 3]), role, text))
    return out


def test_alignment_is_the_cheapest_and_least():
    rng = random.Random(1)
    for _ in range(400):
        codes = bytes(rng.choice([0, 1, 2, 3]) + 4 * rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(rng.randrange(0, 7)))
        rows = [("sua "[c & 3], 3 * (c >> 2 == 3), c >> 2 in (1, 2)) for c in codes]
        assert repair.audit(codes) == least(rows), codes
        assert repair.audit(codes, long=0) == least(rows), codes


def test_both_tables_agree_on_longer_conversations():
    rng = random.Random(2)
    for n in (30, 77, 300):
        for weights in ((1, 5, 5, 1), (0, 1, 0, 0), (3, 1, 1, 3), (1, 0, 0, 0)):
            rows = [(rng.choices("sua ", weights)[0], 3 * (rng.random() < 0.3)) for _ in range(n)]
            assert repair.align(rows) == repair.align_folded(rows)


@pytest.mark.parametrize("options", [{}, {"held": 200}, {"held": 0, "long": 2}])
def test_against_brute_force(spark, options):
    turns = drawn(3, 120)
    df = spark.createDataFrame(turns, SCHEMA).repartition(5)
    want = expected(turns)
    got = run(df, **options)
    left = {c for c in want if c not in got}
    assert all(want[c][6] == "" for c in left)  # all their rows were dropped
    assert got == {c: v for c, v in want.items() if c not in left}


def test_query_on_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert of(repair.query(spark, folder).collect()) == expected(rows)


def test_a_hot_conversation_with_repeats(spark):
    turns = [(1, i % 50, ("user", "assistant")[i % 2], f"t {i % 90}.") for i in range(1500)] + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    df = spark.createDataFrame(turns, SCHEMA)
    plain, twice = run(df), run(df, held=0, long=100)
    assert plain == twice
    assert plain[1][2] > 1000 and len(plain) == 2


def test_empty_tables_extra_columns_and_dropped_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair(empty).collect() == []
    turns = drawn(4, 20)
    df = spark.createDataFrame(turns, SCHEMA)
    more = df
    for name in ("_conv", "_place", "_turn", "_role", "_text", "_again", "audit", "position", "_large", "_copy"):
        more = more.withColumn(name, F.lit("x"))
    plain = sorted(map(str, repair.repair(df).collect()))
    assert sorted(map(str, repair.repair(more).collect())) == plain
    assert sorted(map(str, repair.repair(more, held=0).collect())) == plain
    assert repair.audit(b"") == (0, "")


def test_very_long_text_and_turns(spark):
    long = "wörd " * 400_000 + "."
    df = spark.createDataFrame([("x", 0, "user", long), ("x", 1, "assistant", "ok.")], "c string, t bigint, r string, b string")
    rows = repair.repair(df, conv="c", turn="t", role="r", text="b").orderBy("position").collect()
    assert [r["audit"] for r in rows] == ["KK", None, None] and rows[1]["text"] == long
