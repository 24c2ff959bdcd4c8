"""One-permutation MinHash fingerprints of documents, in column functions only.

Every five-word shingle is hashed once. The high bits of the hash choose one of ``BINS`` bins and each bin keeps its
least hash. An empty bin takes the value of a filled one that a fixed draw of its own chooses, draw after draw until a filled
bin is met (optimal densification), so it agrees between two texts as often as their shingles do. The
low ``BITS`` bits of every bin are packed; two fingerprints agree in a bin by chance once in 2^BITS, which
``likeness`` takes out of the share of equal bins.

A fingerprint is an array of longs, 64 / BITS bins in each. A text of fewer words is one shingle; a text without words has no
filled bin and a fingerprint of zeros. ``following`` pairs each document with the next one by key without ordering
all of them in one place.
"""

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgauge.llm.common import settled, table, word_array

SHINGLE_WORDS = 5
BINS = 256
BITS = 4
#: draws of an empty bin that are looked up; later ones are made at once, by the least hash of all filled bins
DRAWS = 12
SEED = 42
#: rows that a range of keys shall hold, and the high bits of a text's hash that cut a key which fills ranges by itself
RANGE_ROWS, HOT_BITS = 50_000, 10
_PER_LONG = 64 // BITS
_BIN_SHIFT = 65 - BINS.bit_length()


def _numbers(values) -> Column:
    return F.expr(f"array({','.join(map(str, values))})")


def _bin(x: Column) -> Column:
    """By the high bits, rising with the signed value."""
    return (F.shiftright(x, _BIN_SHIFT) + BINS // 2).cast("int")


def with_fingerprint(rows: DataFrame, text: str, out: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``rows`` with a column ``out``: the packed fingerprint of a text column (null counts as empty).

    Steps are kept in columns named ``out`` with a suffix of two underscores and a number, and dropped again. A text of any length
    is read whole; equal texts have equal fingerprints, and so have texts with the same set of shingles.
    """
    kept = rows.columns
    words, hashes, least, dense, full = (F.col(f"`{out}__{i}`") for i in range(5))
    n = F.size(words)
    shingles = F.transform(
        F.slice(words, F.lit(1), F.greatest(n - (shingle_words - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *(F.get(words, i + k) for k in range(1, shingle_words))))
    every = F.sequence(F.lit(0), F.lit(BINS - 1))
    rng = np.random.default_rng(SEED)
    draws = [_numbers(rng.integers(0, BINS, BINS)) for _ in range(DRAWS)]
    last = lambda b: F.array_min(F.transform(least, lambda x: F.struct(F.xxhash64(b, _bin(x)).alias("h"), x.alias("v"))))["v"]
    steps = [
        F.transform(word_array(F.col(f"`{text}`")), lambda w: F.xxhash64(w)),
        F.sort_array(F.when(n == 0, F.array().cast("array<bigint>")).when(n < shingle_words, F.array(F.xxhash64(words))).otherwise(shingles)),
        F.filter(hashes, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(hashes, i - 1)))),
        F.flatten(F.transform(least, lambda x, i: F.concat(F.array_repeat(F.lit(None).cast("bigint"), _bin(x) - F.when(
            i == 0, -1).otherwise(_bin(F.get(least, i - 1))) - 1), F.array(x)))),
        F.transform(every, lambda b: F.coalesce(
            F.get(dense, b), *(F.get(dense, F.get(d, b)) for d in draws), last(b), F.lit(0).cast("bigint")))]
    # a step that is named once, inside a function of array elements, would be made again for each element
    packed = F.array(*(F.aggregate(
        F.slice(full, g * _PER_LONG + 1, _PER_LONG), F.lit(0).cast("bigint"),
        lambda acc, x: F.shiftleft(acc, BITS).bitwiseOR(x.bitwiseAND((1 << BITS) - 1))) for g in range(BINS // _PER_LONG)))
    for i, step in enumerate(steps):
        rows = rows.withColumn(f"{out}__{i}", step)
    return rows.withColumn(out, packed).select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{out}`"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of the sets of shingles of two packed fingerprints, without the bins that agree by chance."""
    lowest = sum(1 << at for at in range(0, 64, BITS))

    def unequal(x: Column, y: Column) -> Column:
        bits, both = x.bitwiseXOR(y), None
        for k in range(BITS):
            both = bits if both is None else both.bitwiseOR(F.shiftrightunsigned(bits, k))
        return F.bit_count(both.bitwiseAND(lowest))

    chance = 2.0 ** -BITS
    share = 1 - F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda acc, x: acc + x) / BINS
    return F.greatest((share - chance) / (1 - chance), F.lit(0.0))


def as_hex(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def _below(cuts: list[int], key: Column) -> Column:
    """How many of the rising cuts are less than a key, by a look into every 32nd and one into those between."""
    if not cuts:
        return F.lit(0)
    coarse = cuts[::32]
    parts = F.expr("array(" + ",".join("array(" + ",".join(f"{c}L" for c in cuts[i:i + 32]) + ")" for i in range(0, len(cuts), 32)) + ")")
    less = lambda some: F.size(F.filter(some, lambda c: c < key))
    block = F.greatest(less(F.expr(f"array({','.join(f'{c}L' for c in coarse)})")) - 1, F.lit(0))
    return block * 32 + less(F.get(parts, block))


def following(docs: DataFrame, key: str, text: str, columns: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each row as a struct ``row`` of some of its columns beside that of the row ``next`` to it by ascending key; the first follows the last.

    The key is an integer; null keys come first. Rows with the same key follow each other by a hash of their texts; rows whose texts
    are the same too are alike. A single row follows itself; an empty table gives none.

    Keys are cut into ranges of about ``range_rows`` rows, of which only the cuts and the first row's key are gathered. A key that
    is cut itself has a range of its own, and one that fills ranges is cut again by the hash. Each range gets the first row of the next one with it.
    """
    k, named = F.col("_key"), F.col(f"`{key}`").cast("bigint")
    n = docs.count()
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // range_rows), 2)
    marks = [i / ranges for i in range(1, ranges)]
    found = docs.select(F.percentile_approx(named, marks, F.lit(20 * ranges)).alias("cuts")).first()["cuts"] or []
    cuts, hot = sorted(set(found)), sorted({a for a, b in zip(found, found[1:], strict=False) if a == b})
    tie = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    rows = docs.select(named.alias("_key"), tie.alias("_tie"), F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"))
    below = _below(cuts, k)
    at_cut = F.coalesce(F.get(F.expr(f"array({','.join(f'{c}L' for c in cuts)})"), below) == k, F.lit(False)) if cuts else F.lit(False)
    dealt = F.coalesce(k.isin(*hot), F.lit(True)) if hot else k.isNull()
    rows = rows.withColumn("_range", F.struct(
        F.when(k.isNull(), -1).otherwise(2 * below + at_cut.cast("int")).alias("r"),
        F.when(dealt, F.shiftrightunsigned("_tie", 64 - HOT_BITS)).otherwise(F.lit(0).cast("bigint")).alias("s"), F.lit(0).alias("end")))
    # one row a range
    every = Window.orderBy("_range")
    head = F.min(F.struct("_key", "_tie"))
    heads = settled(rows.groupBy("_range").agg(head.alias("_head")).select(
        F.col("_range").alias("_of"), "_head", F.coalesce(F.lag("_range").over(every), F.max("_range").over(
            every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_before")))
    end = F.struct(F.col("_before.r").alias("r"), F.col("_before.s").alias("s"), F.lit(1).alias("end"))
    at = F.explode(F.when(F.struct("_key", "_tie").eqNullSafe(F.col("_head")), F.array(F.col("_range"), end)).otherwise(F.array("_range")))
    rows = rows.join(F.broadcast(heads), F.col("_range") == F.col("_of")).select("_key", "_tie", "row", at.alias("_at"))
    order = Window.partitionBy("_at.r", "_at.s").orderBy("_at.end", F.col("_key").asc_nulls_first(), "_tie")
    return rows.withColumn("next", F.lead("row").over(order)).where("_at.end = 0").select("row", "next")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = following(with_fingerprint(docs, "text", "print"), "doc_id", "text", ["doc_id", "text", "print"])
    n = F.char_length("row.text").cast("bigint")
    moved = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("row.text", F.lit(1), (n - moved).cast("int")), F.substring("next.text", F.lit(1), moved))
    found = with_fingerprint(pairs.select("row.doc_id", n.alias("n_chars"), edited.alias("edited"), F.col("row.print").alias("print"),
                                          F.col("next.print").alias("next_print")), "edited", "edited_print")
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        as_hex(F.col("print")).alias("fingerprint"), as_hex(F.col("edited_print")).alias("edited_fingerprint"),
                        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
                        likeness(F.col("print"), F.col("next_print")).alias("near_next"))
