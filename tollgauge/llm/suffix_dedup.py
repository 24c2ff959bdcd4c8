"""Removal of byte strings that occur more than once, by a sparse suffix array.

Sorting every suffix of a corpus in one place does not scale, and is not needed: a 200-byte string
has a minimiser, the 32-byte gram with the least hash within it, and equal strings have it at the
same offset. So only suffixes that start at minimisers (about one position in 85) are sorted, and
only those whose gram occurs again. Suffixes with the same gram meet in one task; there they are put
in order, forwards from the anchor and backwards before it, by deep-shallow sorting (see
``deep_shallow``), and common prefixes of neighbours give every repeated 200-byte string.

Equal texts are one text with a count, reduced on the map side, and equal contexts of anchors (all
bytes that such a string around the anchor can have, compared by gram and a second 64-bit hash) are
one string with a count: one of them is sorted, and all bytes of a context that occurs twice are
repeated. A gram with more than ``MOST`` different contexts is cut into blocks, and every pair of
blocks is a group of its own: no task holds more than ``MOST`` contexts of a gram, and every two
still meet.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgauge.llm.common import table
from tollgauge.llm.deep_shallow import repeated_reach

NEED = 200
GRAM = 32
MOST = 60_000
SLICE = 1 << 20
_POS = (1 << 31) - 1
_BASE = 0x9E3779B97F4A7C15
_ROWS = 20_000


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse."""
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.ones(n, np.uint64), np.ones(n, np.uint64)
    up[1:], down[1:] = np.uint64(_BASE), np.uint64(inverse)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def gram_hashes(data: np.ndarray, gram: int, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """64-bit hash of the gram that starts at each position."""
    up, down = powers
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    h = (total[gram:] - total[:-gram]) * down[:len(data) - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors(data: bytes, powers, need: int = NEED, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the minimisers of all ``need``-byte strings (the leftmost of equal ones) and the
    hashes of their grams. Long texts go through in overlapping slices of ``SLICE`` bytes."""
    places, hashes = [], []
    for at in range(0, max(1, len(data) - need + 1), SLICE):
        piece = np.frombuffer(data, np.uint8, min(SLICE + need - 1, len(data) - at), at)
        if len(piece) < need:
            break
        h = gram_hashes(piece, gram, powers)
        key = (h & np.uint64(~_POS & ((1 << 64) - 1))) | np.arange(len(h), dtype=np.uint64)
        low = (_window_minimum(key, need - gram + 1) & np.uint64(_POS)).astype(np.int64)
        found = low[np.r_[True, low[1:] != low[:-1]]]
        places.append(found + at)
        hashes.append(h[found].view(np.int64))
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, one = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[one]


def context(data: bytes, pos: int) -> tuple[bytes, bytes]:
    """All bytes of the 200-byte strings that contain the anchor's gram: those before the anchor and
    those from it on."""
    return data[max(0, pos - NEED + GRAM):pos], data[pos:pos + NEED]


def _anchor_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    powers, of = _powers(SLICE + NEED), xxhash.xxh3_64_intdigest
    for frame in frames:
        grams, places, contexts = [], [], []
        for d in frame["data"]:
            p, h = anchors(d, powers)
            seen = [of(d[max(0, x - NEED + GRAM):x + NEED], min(x, NEED)) for x in p.tolist()]
            grams.append(h)
            places.append(p.astype(np.int32))
            contexts.append(np.array(seen, np.uint64).view(np.int64))
        yield pd.DataFrame({"id": frame["id"], "gram": grams, "context": contexts, "pos": places})


def _context_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["gram", "blocks", "id", "pos", "left", "right"]
    for frame in frames:
        rows = []
        for i, d, found in zip(frame["id"], frame["data"], frame["found"], strict=True):
            for f in found:
                left, right = context(d, f["pos"])
                rows.append((f["gram"], f["blocks"], i, f["pos"], left[::-1], right))
            if len(rows) >= _ROWS:
                yield pd.DataFrame(rows, columns=columns)
                rows = []
        yield pd.DataFrame(rows, columns=columns)


def _reach_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reads contexts sorted by group; whole groups are sorted together, about ``_ROWS`` rows at a time."""
    held: list[pd.DataFrame] = []

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        k = rows[["gram", "block"]].to_numpy(np.int64)
        cut = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        size = np.diff(np.r_[0, cut, len(rows)])
        rows = rows[np.repeat(size > 1, size)]
        size = size[size > 1]
        if not len(rows):
            return pd.DataFrame({"id": [], "first": [], "last": []})
        ends = np.cumsum(size)
        groups = [list(range(e - n, e)) for e, n in zip(ends.tolist(), size.tolist(), strict=True)]
        before, after = repeated_reach(rows["left"].tolist(), rows["right"].tolist(), groups, NEED, GRAM)
        pos, hit = rows["pos"].to_numpy(np.int64), after > 0
        return pd.DataFrame({"id": rows["id"].to_numpy()[hit], "first": (pos - before)[hit], "last": (pos + after)[hit]})

    for frame in frames:
        if frame.empty:
            continue
        held.append(frame)
        if sum(map(len, held)) < _ROWS:
            continue
        rows = pd.concat(held, ignore_index=True)
        k = rows[["gram", "block"]].to_numpy(np.int64)
        same = (k == k[-1]).all(axis=1)
        whole = len(rows) - int(same[::-1].argmin()) if not same.all() else 0
        if whole:
            yield solve(rows.iloc[:whole])
        held = [rows.iloc[whole:]]
    if held:
        yield solve(pd.concat(held, ignore_index=True))


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


_RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<array<bigint>>, kept binary"


def _cutter(with_text: bool):
    @F.pandas_udf(_RESULT)
    def cut(data: pd.Series, copies: pd.Series, twins: pd.Series, firsts: pd.Series, lasts: pd.Series) -> pd.DataFrame:
        rows = []
        for d, n, twin, first, last in zip(data, copies, twins, firsts, lasts, strict=True):
            found = [] if twin is None else [(max(0, p - NEED + GRAM), min(len(d), p + NEED)) for p in twin.tolist()]
            if first is not None:
                found += zip(first.tolist(), last.tolist(), strict=True)
            spans = [[0, len(d)]] if n > 1 and len(d) >= NEED else _merged(found)
            edges = [0, *(x for s in spans for x in s), len(d)]
            kept = b"".join(d[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if spans else d
            rows.append((len(d), len(d) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), spans,
                         kept if with_text else None))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])
    return cut


def repeats(docs: DataFrame, text: str = "text", with_text: bool = False, most: int = MOST) -> DataFrame:
    """Per distinct text: ``_text_id`` (128-bit hash), n_bytes, n_removed, n_spans, kept_sha256, spans
    ([first, last) of each removed run) and, if asked for, the kept bytes.

    A byte goes if it lies in a 200-byte string that also starts anywhere else, in the same text
    included; overlapping starts count. A null text is the empty one; texts under 200 bytes lose
    nothing; an empty table gives an empty result. No other column is read.
    """
    data = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    # every use of texts takes all its columns and the same filter (which an inner join would add for
    # itself alone): then one exchange of the texts serves them all
    texts = docs.select(F.unhex(F.md5(data)).alias("id"), data.alias("data")).where("id is not null").groupBy("id").agg(
        F.first("data").alias("data"), F.count("*").alias("copies"))
    found = texts.mapInPandas(
        _anchor_rows, "id binary, gram array<bigint>, context array<bigint>, pos array<int>")
    flat = found.select("id", F.inline(F.arrays_zip("gram", "context", "pos")))
    often = flat.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    gram, same = Window.partitionBy("gram"), Window.partitionBy("gram", "context")
    known = flat.join(often, "gram").withColumn("copies", F.count("*").over(same)).withColumn(
        "rank", F.row_number().over(same.orderBy("id", "pos"))).withColumn(
        "strings", F.sum(F.when(F.col("rank") == 1, 1).otherwise(0)).over(gram))
    sorts = (F.col("rank") == 1) & (F.col("strings") > 1)
    blocks = F.when(F.col("strings") > most, F.ceil(2 * F.col("strings") / most)).otherwise(1).cast("int")
    mine = known.where((F.col("copies") > 1) | sorts).groupBy("id").agg(
        F.collect_list(F.when(F.col("copies") > 1, F.col("pos"))).alias("twins"),
        F.collect_list(F.when(sorts, F.struct("gram", "pos", blocks.alias("blocks")))).alias("found"))
    contexts = texts.join(mine.where(F.size("found") > 0), "id").select("id", "data", "copies", "found").mapInPandas(
        _context_rows, "gram bigint, blocks int, id binary, pos int, left binary, right binary")
    own = F.pmod(F.xxhash64("id", "pos"), F.col("blocks")).cast("int")
    dealt = contexts.withColumn("own", own).select("gram", "id", "pos", "left", "right", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.least("own", j).cast("bigint") * F.col("blocks") + F.greatest(F.col("own"), j))).alias("block"))
    reach = dealt.repartition("gram", "block").sortWithinPartitions("gram", "block").mapInPandas(
        _reach_rows, "id binary, first bigint, last bigint")
    spans = reach.groupBy("id").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    return texts.join(mine.select("id", "twins"), "id", "left").join(spans, "id", "left").select(
        F.col("id").alias("_text_id"), _cutter(with_text)("data", "copies", "twins", "firsts", "lasts").alias("r")).select(
        "_text_id", "r.*")


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each text reduced to its kept bytes (a character that loses a byte goes) and, where
    it exists, n_chars set to the new length. No row is dropped; a null text stays null; repeated rows are
    all kept and all cut alike; columns of any other names pass through; an empty table gives an empty result."""
    found = repeats(docs, text, with_text=True).select("_text_id", "kept")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rest = docs.select(F.unhex(F.md5(whole)).alias("_text_id"), F.col(f"`{text}`").isNull().alias("_null"),
                       (F.struct(*others) if others else F.lit(None)).alias("row"))
    out = rest.join(found, "_text_id").select("row", F.when(~F.col("_null"), _decoder()("kept")).alias("_new"))
    new = {text: F.col("_new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.char_length("_new").cast(docs.schema["n_chars"].dataType), F.col("row.n_chars"))
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _decoder():
    @F.pandas_udf("string")
    def decoded(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: b.decode("utf-8", "ignore"))
    return decoded


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    data = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select("doc_id", F.unhex(F.md5(data)).alias("_text_id")).join(repeats(docs), "_text_id").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT rid, j, substr(h, 512 * j + 1, 910) AS piece FROM d, range(0, CAST(length(h) // 512 + 1 AS BIGINT)) AS r(j) WHERE length(h) >= 400),
w AS (SELECT rid, 256 * j + i AS i, md5(substr(piece, 2 * i + 1, 400)) AS k FROM b, range(0, 256) AS r(i) WHERE 2 * i + 400 <= length(piece)),
c AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
e AS (SELECT rid, i FROM w SEMI JOIN c USING (k)),
m AS (SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + 200 THEN 0 ELSE 1 END AS opens FROM e),
g AS (SELECT rid, i, sum(opens) OVER (PARTITION BY rid ORDER BY i) AS run FROM m),
s AS (SELECT rid, run, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY rid, run),
p AS (SELECT rid, a, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before_a FROM s),
kept AS (SELECT p.rid, string_agg(substr(h, 2 * before_a + 1, 2 * (a - before_a)), '' ORDER BY a) AS head FROM p JOIN d USING (rid) GROUP BY p.rid),
t AS (SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last FROM s GROUP BY rid)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN t.rid IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN t USING (rid) LEFT JOIN kept USING (rid)"""
