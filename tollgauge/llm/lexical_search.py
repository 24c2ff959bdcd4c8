"""Ranked lexical search with geometric blocks in the posting lists.

Documents are read once into shards of bounded size, each a row of a stored table: their counts of the items' terms. When the
corpus' statistics are known, every posting list of a shard is cut into blocks of documents that are alike (by a random
projection of their impacts onto a few members of the list), and each block is stored with the coordinatewise maximum of its
documents' impacts, over the terms that occur in an item beside the list's own. Maxima are stored in one byte, rounded up.

An item visits the blocks of its terms by falling bound: weights times the summary. A block is skipped only if its bound is below the
score of the tenth document that is known already, so the result is exact. Known from the start are the
tenth scores of a share of the shards, which are searched first.

Items are taken in slices of bounded size, so that what a task holds does not grow with their number.
"""

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgauge.llm.common import ascii_lower, table
from tollgauge.sources.storage import shared_folder

TOP = 10
#: distinct terms of the items of one slice
SLICE_TERMS = 20_000
SHARD_DOCS, SHARD_POSTINGS, SHARD_CELLS = 2048, 1 << 18, 1 << 23
BLOCK_DOCS = 32
SKETCH = 32
#: terms of an item that summaries hold apart; the shard's maximum stands for further ones
SUMMARY_TERMS = 1024
SEED_SHARDS = 16
SEED = 42
_STEP = 1 << 12
_NOT_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms(data: bytes) -> list[bytes]:
    """Terms of a text's UTF-8 bytes, in order."""
    return data.translate(_TERM_BYTES).split()


def term_array(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _NOT_TERM), lambda t: t != "")


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_norms(lengths: list[int], n: int, total: int) -> np.ndarray:
    return np.array([100 - 90 + (90 * x * n) // total for x in lengths], np.int64)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Items:
    """The items of one slice: their terms as numbers, and for every term those that an item has beside it."""

    def __init__(self, found: list[list[str]], weights: np.ndarray | None = None, summary_terms: int = SUMMARY_TERMS):
        self.vocabulary = {t.encode(): i for i, t in enumerate(sorted({t for ts in found for t in ts}))}
        self.terms = [np.array(sorted(self.vocabulary[t.encode()] for t in ts), np.int64) for ts in found]
        if weights is None:
            return
        self.weights, beside = weights, [[] for _ in self.vocabulary]
        self.held, self.rest = [], []
        for ts in self.terms:
            heavy = np.sort(ts[np.argsort(-weights[ts], kind="stable")[:summary_terms]])
            self.held.append(heavy)
            self.rest.append(np.setdiff1d(ts, heavy, assume_unique=True))
            for t in ts:
                beside[t].append(heavy)
        self.beside = [np.unique(np.concatenate(b)) if b else np.empty(0, np.int64) for b in beside]


def _reader(vocabulary: dict[bytes, int]):
    """Documents into shards: a row of how many documents and terms there are, and the counts of known terms."""
    most = max(1, min(SHARD_DOCS, SHARD_CELLS // max(1, len(vocabulary))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, rest = None, None

        def shard() -> pa.RecordBatch:
            starts = np.cumsum([0, *map(len, rest["terms"])]).astype(np.int64)
            flat = [np.concatenate(rest[c]).astype(np.int32) if rest[c] else np.empty(0, np.int32) for c in ("terms", "counts")]
            cells = [rest["docs"], rest["words"], rest["ids"], rest["lengths"], *(a.tobytes() for a in (starts, *flat))]
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, schema, strict=True)], schema=schema)

        def empty() -> dict:
            return {"docs": 0, "words": 0, "size": 0, "ids": [], "lengths": [], "terms": [], "counts": []}

        rest = empty()
        for batch in batches:
            schema = schema or _shard_schema(batch.schema.field(0).type)
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = terms(text or b"")
                if not words:
                    continue
                rest["docs"], rest["words"] = rest["docs"] + 1, rest["words"] + len(words)
                known = [i for i in map(vocabulary.get, words) if i is not None]
                if known:
                    found, counts = np.unique(np.array(known, np.int32), return_counts=True)
                    rest["ids"].append(name)
                    rest["lengths"].append(len(words))
                    rest["terms"].append(found)
                    rest["counts"].append(counts)
                    rest["size"] += len(found)
                if len(rest["ids"]) >= most or rest["size"] >= SHARD_POSTINGS:
                    yield shard()
                    rest = empty()
        if rest["docs"]:
            yield shard()
    return read


def _shard_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("docs", pa.int64()), ("words", pa.int64()), ("ids", pa.list_(kind)), ("lengths", pa.list_(pa.int64())),
                      *((c, pa.binary()) for c in ("starts", "terms", "counts"))])


def _document_counts(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for found in batch.column(0).to_pylist():
                df += np.bincount(np.frombuffer(found, np.int32), minlength=size)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(df[seen])], names=["term", "df"])
    return count


def matrix(starts: np.ndarray, found: np.ndarray, impacts: np.ndarray, size: int) -> np.ndarray:
    """Documents by terms: the impact of each term in each document."""
    out = np.zeros((len(starts) - 1, size), np.int32)
    out[np.repeat(np.arange(len(starts) - 1), np.diff(starts)), found] = impacts
    return out


def blocks(starts: np.ndarray, found: np.ndarray, impacts: np.ndarray, items: Items, block_docs: int = BLOCK_DOCS):
    """Posting lists of a shard as blocks: their term, first member, members and summaries, term by term."""
    size = len(items.vocabulary)
    docs = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    sketch = np.zeros((len(starts) - 1, SKETCH), np.float32)
    signs = np.random.default_rng(SEED).choice(np.array([-1, 1], np.float32), (size, SKETCH))
    for at in range(0, len(starts) - 1, 256):  # a few documents at a time bound the memory of the products
        a, b = starts[at], starts[min(at + 256, len(starts) - 1)]
        held = signs[found[a:b]] * (impacts[a:b] * items.weights[found[a:b]]).astype(np.float32)[:, None]
        np.add.at(sketch, docs[a:b], held)
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
    dense = matrix(starts, found, impacts, size)
    order = np.argsort(found, kind="stable")
    listed, cut = found[order], docs[order]
    lists = np.flatnonzero(np.r_[True, listed[1:] != listed[:-1]]) if len(listed) else np.empty(0, np.int64)
    block_terms, firsts, members, summaries, at = [], [], [], [], 0
    for a, b in zip(lists, np.r_[lists[1:], len(listed)], strict=True):
        term, of = int(listed[a]), cut[a:b]
        parts = -(-len(of) // block_docs)
        if parts > 1:
            centres = sketch[of[np.linspace(0, len(of) - 1, parts).astype(int)]]
            nearest = np.argmax(sketch[of] @ centres.T, axis=1)
            by = np.argsort(nearest, kind="stable")
            of, nearest = of[by], nearest[by]
            edges = np.flatnonzero(np.r_[True, nearest[1:] != nearest[:-1]])
        else:
            edges = np.zeros(1, np.int64)
        beside = items.beside[term]
        most = np.maximum.reduceat(dense[of[:, None], beside[None, :]], edges, axis=0)
        block_terms.append(np.full(len(edges), term, np.int32))
        firsts.append(at + edges)
        members.append(of)
        summaries.append((-(-most // _STEP)).astype(np.uint8).ravel())
        at += len(of)
    whole = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
    return whole(block_terms, np.int32), whole([*firsts, [at]], np.int64), whole(members, np.int32), whole(summaries, np.uint8)


_BLOCK_COLUMNS = ("block_terms", "firsts", "members", "summaries")


def _indexer(items: Items, n: int, total: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([batch.schema.field("ids"), *((c, pa.binary()) for c in ("starts", "terms", "impacts", *_BLOCK_COLUMNS))])
            columns = [batch.column(c).to_pylist() for c in ("ids", "lengths", "starts", "terms", "counts")]
            for ids, lengths, starts, found, counts in zip(*columns, strict=True):
                starts, found = np.frombuffer(starts, np.int64), np.frombuffer(found, np.int32)
                norms = np.repeat(length_norms(lengths, n, total), np.diff(starts))
                impacts = impact(np.frombuffer(counts, np.int32).astype(np.int64), norms).astype(np.int32)
                made = blocks(starts, found, impacts, items)
                cells = [ids, starts.tobytes(), found.tobytes(), impacts.tobytes(), *(a.tobytes() for a in made)]
                yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, schema, strict=True)], schema=schema)
    return index


def _before(name) -> tuple:
    """Ascending order of ids, nulls last."""
    return name is None, 0 if name is None else name


class Shard:
    """A shard's blocks as they are searched."""

    def __init__(self, items: Items, ids: list, starts, found, impacts, block_terms, firsts, members, summaries):
        self.items, self.ids, self.members, self.firsts = items, ids, members, firsts
        self.dense = matrix(starts, found, impacts, len(items.vocabulary))
        self.most = self.dense.max(axis=0, initial=0).astype(np.int64)
        self.of, edges = {}, np.flatnonzero(np.r_[True, block_terms[1:] != block_terms[:-1]]) if len(block_terms) else []
        at = 0
        for a, b in zip(edges, [*edges[1:], len(block_terms)], strict=True):
            term = int(block_terms[a])
            width = len(items.beside[term])
            self.of[term] = a, summaries[at:at + (b - a) * width].reshape(b - a, width)
            at += (b - a) * width
        self.visited = self.skipped = 0

    def search(self, item: int, known: list[tuple], least: int, top: int = TOP) -> list[tuple]:
        """The best (-score, id order, id) of ``known`` and this shard; scores below ``least`` do not matter."""
        items = self.items
        ts, held = items.terms[item], items.held[item]
        weights, bounds, names = items.weights[ts], [], []
        rest = int((items.weights[items.rest[item]] * self.most[items.rest[item]]).sum())
        for t in ts.tolist():
            if t in self.of:
                first, summary = self.of[t]
                columns = np.searchsorted(items.beside[t], held)
                bounds.append(summary[:, columns].astype(np.int64) @ items.weights[held] * _STEP + rest)
                names.append(first + np.arange(len(summary)))
        if not bounds:
            return known
        bounds, names = np.concatenate(bounds), np.concatenate(names)
        order, at, step = np.argsort(-bounds, kind="stable"), 0, 4
        fresh = np.ones(len(self.ids), bool)
        while at < len(order):
            limit = max(least, -known[-1][0]) if len(known) >= top else least
            taken = order[at:at + step]
            taken = taken[bounds[taken] >= limit]
            if not len(taken):
                break
            docs = np.unique(np.concatenate([self.members[self.firsts[b]:self.firsts[b + 1]] for b in names[taken]]))
            docs = docs[fresh[docs]]
            fresh[docs] = False
            scores = self.dense[docs[:, None], ts[None, :]].astype(np.int64) @ weights
            good = np.flatnonzero(scores >= limit)
            known = sorted([*known, *((-int(scores[i]), _before(self.ids[docs[i]]), self.ids[docs[i]]) for i in good)],
                           key=lambda k: k[:2])[:top]
            self.visited += len(taken)
            at, step = at + len(taken), step * 2
        self.skipped += len(order) - at
        return known


def _searcher(items: Items, least: list[int], top: int):
    """The best of all shards of a partition for each item: (item, id, score)."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kind = [[] for _ in items.terms], None
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for row in range(batch.num_rows):
                cells = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                shard = Shard(items, cells["ids"], np.frombuffer(cells["starts"], np.int64), *(
                    np.frombuffer(cells[c], k) for c, k in (("terms", np.int32), ("impacts", np.int32), ("block_terms", np.int32),
                                                           ("firsts", np.int64), ("members", np.int32), ("summaries", np.uint8))))
                for item, known in enumerate(best):
                    best[item] = shard.search(item, known, least[item], top)
        rows = [(item, name, -score) for item, known in enumerate(best) for score, _, name in known]
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], kind), pa.array(columns[2], pa.int64())],
                                             names=["item", "doc", "score"])
    return search


def _best(found: DataFrame, top: int) -> DataFrame:
    """Ranked best per item, first within spreads of the documents."""
    for by in (["item", F.pmod(F.xxhash64("doc"), F.lit(64))], ["item"]):
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return found


def _of_slice(docs: DataFrame, items: list[tuple], schema: str, top: int, folder: str) -> DataFrame:
    """Ranks of one slice of (item, its terms)."""
    spark, kind = docs.sparkSession, docs.schema[0].dataType.simpleString()
    plain = Items([ts for _, ts in items])
    size = len(plain.vocabulary)
    shards = f"docs bigint, words bigint, ids array<{kind}>, lengths array<bigint>, starts binary, terms binary, counts binary"
    docs.mapInArrow(_reader(plain.vocabulary), shards).write.parquet(f"{folder}/shards")
    stored = spark.read.parquet(f"{folder}/shards")
    n, total = stored.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    df = dict(stored.select("terms").mapInArrow(_document_counts(size), "term bigint, df bigint").groupBy("term").agg(
        F.sum("df")).collect())  # no more than the terms of the slice
    ready = Items([ts for _, ts in items], np.array([weight(n, df.get(i, 0)) for i in range(size)], np.int64))
    columns = ", ".join(f"{c} binary" for c in ("starts", "terms", "impacts", *_BLOCK_COLUMNS))
    stored.drop("docs", "words").mapInArrow(_indexer(ready, n, total), f"ids array<{kind}>, {columns}").write.parquet(f"{folder}/blocks")
    index = spark.read.parquet(f"{folder}/blocks")
    out = f"item int, doc {kind}, score bigint"
    first = index.where(F.pmod(F.xxhash64("ids"), F.lit(SEED_SHARDS)) == 0).mapInArrow(_searcher(ready, [1] * len(items), top), out)
    tenth = dict(_best(first, top).where(F.col("rank") == top).select("item", "score").collect())  # a row an item of the slice
    found = _best(index.mapInArrow(_searcher(ready, [tenth.get(i, 1) for i in range(len(items))], top), out), top)
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(items)], f"item int, {schema}")
    return found.join(F.broadcast(names), "item").drop("item")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", top: int = TOP, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """The ``top`` best rows of ``docs`` for each row of ``items``: ``item``, ``rank``, ``doc`` and ``score``.

    Scores are sums over the item's distinct terms of whole-number weights and impacts; equal scores rank by
    ascending key, null keys last. Null and empty texts have no terms: such documents count nowhere and such items have no rows. Repeated rows of
    documents or items each count and rank by themselves, however long a text is. Empty tables give no row; other columns are not
    read, whatever their names. Stored shards and blocks stay in the shared folder.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{key}`").alias("_doc"), F.col(f"`{text}`").cast("binary").alias("_text"))
    asked = items.select(F.col(f"`{item_key}`").alias("_item"), F.array_distinct(term_array(F.col(f"`{item_text}`"))).alias("_terms")).where(
        F.size("_terms") > 0)
    kind = asked.schema["_item"].dataType.simpleString()
    words = asked.agg(F.coalesce(F.sum(F.size("_terms")), F.lit(0))).first()[0]
    slices, folder, out = -(-words // slice_terms), f"{shared_folder(spark)}/lexical-{uuid.uuid4().hex}", None
    for i in range(slices):
        part = [tuple(r) for r in asked.where(F.pmod(F.xxhash64("_item", "_terms"), F.lit(slices)) == i).collect()]
        if part:
            found = _of_slice(docs, part, f"_item {kind}", top, f"{folder}/{i}")
            if slices > 1:
                found.write.parquet(f"{folder}/{i}/ranks")
                found = spark.read.parquet(f"{folder}/{i}/ranks")
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], f"_item {kind}, rank int, doc {docs.schema['_doc'].dataType.simpleString()}, score bigint")
    return out.select(F.col("_item").alias("item"), "rank", "doc", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


_ORACLE_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                 r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE = f"""
with counted as (
  select row_number() over () as d, doc_id, {_ORACLE_TERMS} as ts from documents where text is not null),
docs as (select d, doc_id, len(ts)::bigint as n, ts from counted where len(ts) > 0),
sizes as (select count(*)::bigint as nn, sum(n)::bigint as ll from docs),
postings as (select d, t, count(*)::bigint as tf from (select d, unnest(ts) as t from docs) group by d, t),
weights as (
  select t, floor(1000 * ln((2 * any_value(nn) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from postings, sizes group by t),
items as (select row_number() over () as i, item_id, {_ORACLE_TERMS} as ts from benchmark where text is not null),
asked as (select distinct i, item_id, t from (select i, item_id, unnest(ts) as t from items)),
scores as (
  select i, item_id, doc_id, d,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // ll))))::bigint as score
  from asked join weights using (t) join postings using (t) join docs using (d), sizes group by i, item_id, doc_id, d),
ranked as (select *, row_number() over (partition by i order by score desc, doc_id) as r from scores where score > 0)
select item_id, r::int as rank, doc_id, score from ranked where r <= {TOP}"""
