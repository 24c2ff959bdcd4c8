"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is dealt into blocks by a hash of the document key. A source's target, in words,
is met by whole passes over its blocks, then by further blocks that still fit, in order of their
number (the hash has permuted the documents), then by documents that still fit, out of the
``LAST_BLOCKS`` smallest blocks left. The block quotas of all sources are exact integers. A binary tree over the output shards splits
that vector of quotas: each node draws its left child's share without replacement, so every
shard gets its due number of blocks and the shards' quotas add up exactly. A shard's blocks
are consecutive runs of each source's block list, hence disjoint, and its documents are put
in hash order.

What the driver holds is one row per source and at most ``max_blocks`` block sums per source.
The last blocks of a source are one group of about 8/``max_blocks`` of its keys and sizes.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgauge.llm.common import WORD, content_id, packed, settled, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
BLOCK_WORDS = 50_000
MAX_BLOCKS = 4096
LAST_BLOCKS = 8
SHARDS = 64
SHARD_WORDS = 20_000_000
SEED = 20_071


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: dict[str | None, int], weights=WEIGHTS, share: float = SHARE,
            max_repeats: float = MAX_REPEATS) -> dict[str | None, float]:
    """Words each source gives: weights repeat over the sources in code-point order, null last;
    what would exceed a source's cap is shared again among the others by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        part = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if part[s] > max_repeats * sizes[s]]
        if not over:
            return out | part
        for s in over:
            out[s] = float(max_repeats * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def split_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Quotas per shard, (shards, sources): exact column sums, and row sums that differ by one at most."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def deal(vector: np.ndarray, first: int, n: int, node: int) -> None:
        if n == 1:
            out[first] = vector
            return
        left, total = n // 2, int(vector.sum())
        draw = np.random.default_rng([seed, node]).multivariate_hypergeometric(
            vector, total * left // n, method="marginals")
        deal(draw, first, left, 2 * node)
        deal(vector - draw, first + left, n - left, 2 * node + 1)

    deal(np.asarray(quotas, dtype=np.int64), 0, shards, 1)
    return out


def block_plan(blocks: pd.DataFrame, goal: dict[str | None, float], shards: int, seed: int) -> pd.DataFrame:
    """One row per drawn block copy: source number, block, copy, shard, and the words still to be
    filled if only documents that fit are taken (-1 for a whole block)."""
    names = sorted(goal, key=lambda s: (s is None, s or ""))
    rows, quotas = [], []
    for number, name in enumerate(names):
        mine = blocks[blocks.source.isna() if name is None else blocks.source == name].sort_values("block")
        words, ids = mine.words.to_numpy(np.int64), mine.block.to_numpy(np.int64)
        size = int(words.sum())
        passes = int(goal[name] // size) if size else 0
        rest = int(round(goal[name])) - passes * size if size else 0
        whole, left_out, room = [], [], rest
        for b, w in zip(ids.tolist(), words.tolist(), strict=True):
            if 0 < rest and w <= room:
                whole.append(b)
                room -= w
            else:
                left_out.append((w, b))
        drawn = [(number, int(b), c, -1) for c in range(passes) for b in ids]
        drawn += [(number, b, passes, -1) for b in whole]
        drawn += [(number, b, passes, room) for _, b in sorted(left_out)[:LAST_BLOCKS] if room > 0]
        rows.append(drawn)
        quotas.append(len(drawn))
    dealt = split_tree(np.array(quotas), shards, seed)
    out = []
    for number, drawn in enumerate(rows):
        shard = np.repeat(np.arange(shards), dealt[:, number])
        out += [(*row, int(s)) for row, s in zip(drawn, shard, strict=True)]
    plan = pd.DataFrame(out, columns=["_mix_source", "_mix_block", "_mix_copy", "_mix_room", "_mix_shard"])
    return plan.astype("int64")


def fitting(sizes: list[int], room: int) -> list[bool]:
    """Which documents to take: in the given order each one that still fits. If room is left, the
    smallest document left out is tried first instead, and what leaves less room is kept."""
    def fill(order: list[int]) -> tuple[int, list[bool]]:
        left, taken = room, [False] * len(sizes)
        for i in order:
            if sizes[i] <= left:
                taken[i] = True
                left -= sizes[i]
        return left, taken

    order = list(range(len(sizes)))
    left, taken = fill(order)
    outside = sorted((sizes[i], i) for i in order if not taken[i] and sizes[i] <= room)
    for _, i in outside[:3]:
        if left == 0:
            break
        left, taken = min((left, taken), fill([i, *(j for j in order if j != i)]), key=lambda x: x[0])
    return taken


def _fitting(pdf: pd.DataFrame) -> pd.DataFrame:
    """Documents of a source's last blocks that are taken, tried in hash order."""
    pdf = pdf.sort_values(["_mix_order", "a", "b", "_mix_row"], kind="stable")
    taken = fitting(pdf["_mix_size"].tolist(), int(pdf["_mix_room"].iloc[0]))
    return pdf.loc[taken, ["_mix_row", "_mix_copy", "_mix_shard", "a", "b"]]


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS,
        block_words: int = BLOCK_WORDS, max_blocks: int = MAX_BLOCKS, shards: int | None = None,
        seed: int = SEED) -> tuple[DataFrame, DataFrame, int]:
    """(sizes, draws, shards). sizes: _mix_row, the key, source, _mix_size, _mix_source_size,
    _mix_target for every row; draws: _mix_row, _mix_copy, _mix_shard, _mix_order for every copy taken;
    shards: their number, if not given ``SHARDS`` or as many as keep one at about ``SHARD_WORDS`` words.

    ``_mix_row`` numbers the rows of ``docs`` (monotonically_increasing_id), so repeated keys stay
    apart. Only whole documents are taken, so a source misses its target by less than the smallest
    document left out of its last blocks; that is much only where one document holds most of a source.
    Null and empty texts have size 0; a null source is a source of its own, the last one;
    an empty table gives empty results. Equal hashes fall back to the row number.
    """
    rows = settled(docs.select(F.monotonically_increasing_id().alias("_mix_row"), *_facts_of(docs, key, text, source)))
    facts, plan, shards = _planned(rows, weights, share, max_repeats, block_words, max_blocks, shards, seed)
    known = _in_blocks(rows, facts, seed)
    draws = _drawn(known, plan).unionByName(_fitted(known, plan).drop("_mix_id"))
    return (known.select("_mix_row", F.col("_mix_key").alias(key), F.col("_mix_name").alias(source), "_mix_size",
                         "_mix_source_size", "_mix_target"),
            draws.withColumn("_mix_order", F.xxhash64("_mix_shard", "_mix_row", "_mix_copy", F.lit(seed))), shards)


def _facts_of(docs: DataFrame, key: str, text: str, source: str) -> list[Column]:
    return [F.col(f"`{key}`").alias("_mix_key"), F.col(f"`{source}`").alias("_mix_name"),
            word_count(F.col(f"`{text}`")).alias("_mix_size"), content_id(docs).alias("_mix_id")]


def _planned(rows: DataFrame, weights, share: float, max_repeats: int, block_words: int, max_blocks: int, shards: int | None,
             seed: int) -> tuple[DataFrame, DataFrame, int]:
    """(facts of each source, plan, shards): the plan says for each copy of a block of a source its shard, and what room a
    boundary block has (-1: it is taken whole)."""
    spark = rows.sparkSession
    per_source = rows.groupBy("_mix_name").agg(F.sum("_mix_size").alias("size")).collect()  # a row per source
    sizes = {r["_mix_name"]: int(r["size"]) for r in per_source}
    goal = targets(sizes, weights, share, max_repeats)
    shards = shards or max(SHARDS, math.ceil(sum(goal.values()) / SHARD_WORDS))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    facts = _local(spark, [(i, n, sizes[n], goal[n], min(max_blocks, max(1, math.ceil(sizes[n] / block_words))))
                           for i, n in enumerate(names)],
                   "_mix_source bigint, _mix_name string, _mix_source_size bigint, _mix_target double, _mix_blocks bigint")
    sums = _in_blocks(rows, facts, seed).groupBy("_mix_name", "_mix_block").agg(F.sum("_mix_size").alias("words")).toPandas()
    sums.columns = ["source", "block", "words"]
    plan = _local(spark, block_plan(sums, goal, shards, seed).to_numpy().tolist(), "_mix_source bigint, _mix_block bigint, "
                  "_mix_copy bigint, _mix_room bigint, _mix_shard bigint")
    return facts, plan, shards


def _in_blocks(rows: DataFrame, facts: DataFrame, seed: int) -> DataFrame:
    """Rows with what is known of their source, and their block, which is a hash of the key."""
    same = F.col("r._mix_name").eqNullSafe(F.col("f._mix_name"))
    return rows.alias("r").join(facts.alias("f"), same).select(
        *[f"r.{c}" for c in rows.columns], "_mix_source", "_mix_source_size", "_mix_target",
        F.pmod(F.xxhash64("_mix_key", F.lit(seed)), F.col("_mix_blocks")).alias("_mix_block"),
        F.xxhash64("_mix_key", F.lit(seed + 1)).alias("_mix_order"))


def _drawn(known: DataFrame, plan: DataFrame) -> DataFrame:
    """Copies of the rows whose blocks are taken whole."""
    return known.join(plan.where("_mix_room < 0"), ["_mix_source", "_mix_block"]).select("_mix_row", "_mix_copy", "_mix_shard")


def _fitted(known: DataFrame, plan: DataFrame) -> DataFrame:
    """Copies of the rows that are taken from boundary blocks."""
    return known.join(plan.where("_mix_room >= 0"), ["_mix_source", "_mix_block"]).select(
        "_mix_source", "_mix_order", "_mix_size", "_mix_room", "_mix_row", "_mix_copy", "_mix_shard", "_mix_id.a", "_mix_id.b").groupBy(
        "_mix_source").applyInPandas(_fitting, "_mix_row bigint, _mix_copy bigint, _mix_shard bigint, a bigint, b bigint").select(
        "_mix_row", "_mix_copy", "_mix_shard", F.struct("a", "b").alias("_mix_id"))


def _local(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A table of the plan: bounded by sources and blocks, whatever the number of documents."""
    return spark.createDataFrame(rows, schema)


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
                    share: float = SHARE, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS,
                    max_blocks: int = MAX_BLOCKS, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The mix itself: a row per copy taken, with the columns of ``docs`` and mix_shard, mix_copy
    (existing columns of these names are replaced; any other name passes through), each shard in one partition and shuffled.

    No row is looked up by a number. Blocks that are taken whole are known by the hash of the key again when the texts are read;
    only rows of the few boundary blocks are known by a hash of their content and, among equal rows, their rank. Nulls,
    repeated rows and empty tables are those of ``mix``.
    """
    rows = settled(docs.select(F.monotonically_increasing_id().alias("_mix_row"), *_facts_of(docs, key, text, source)))
    facts, plan, shards = _planned(rows, weights, share, max_repeats, block_words, max_blocks, shards, seed)
    whole = docs.select(packed(docs).alias("row"), F.col(f"`{key}`").alias("_mix_key"), F.col(f"`{source}`").alias("_mix_name"),
                        content_id(docs).alias("_mix_id"))
    texts = _in_blocks(whole, facts, seed)
    drawn = texts.join(plan.where("_mix_room < 0"), ["_mix_source", "_mix_block"]).select("row", "_mix_id", "_mix_copy", "_mix_shard")
    # equal rows of a boundary block are told apart by rank, in both readings of the table
    alike = Window.partitionBy("_mix_id")
    edge = plan.where("_mix_room >= 0").select("_mix_source", "_mix_block").distinct()
    numbered = _in_blocks(rows, facts, seed).join(edge, ["_mix_source", "_mix_block"], "left_semi").select(
        "_mix_row", "_mix_id", F.row_number().over(alike.orderBy("_mix_row")).alias("_mix_rank"))
    taken = _fitted(_in_blocks(rows, facts, seed), plan).drop("_mix_id").join(numbered, "_mix_row").drop("_mix_row")
    last = texts.join(edge, ["_mix_source", "_mix_block"], "left_semi").select(
        "row", "_mix_id", F.row_number().over(alike.orderBy("_mix_key")).alias("_mix_rank")).join(taken, ["_mix_id", "_mix_rank"])
    both = drawn.unionByName(last.select("row", "_mix_id", "_mix_copy", "_mix_shard"))
    order = F.xxhash64("_mix_shard", "_mix_id", "_mix_copy", F.lit(seed))
    out = both.withColumn("_mix_order", order).repartition(shards, "_mix_shard").sortWithinPartitions("_mix_shard", "_mix_order", "_mix_copy")
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in ("mix_shard", "mix_copy")],
                      F.col("_mix_shard").alias("mix_shard"), F.col("_mix_copy").alias("mix_copy"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes, draws, _ = mix(table(spark, sf_dir, "documents"))
    copies = draws.groupBy("_mix_row").agg(F.count("*").alias("copies"))
    return sizes.join(copies, "_mix_row", "left").select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("_mix_size") * F.coalesce("copies", F.lit(0))).alias("taken"))
