"""SimHash near-duplicates by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most three bits have a half that differs in at most one.
So every half is indexed 32 times, each time with one bit as a wildcard; fingerprints meet where
half, wildcard position and remaining bits are equal, and are then compared in full.

Equal fingerprints are one node, so copies add no links. A key shared by more than ``SMALL``
different fingerprints is cut again in the same way over the other half (two quarters), and once
more (two eighths). What then still meets differs in at most 8 + 3 bits, so no group exceeds 2,048
fingerprints, whatever the data. A group gives the edges of a spanning forest of its links, not its
pairs. Links become classes with the library's star contraction of connected components.

``near_copies``, which removes near copies, compares the texts whose fingerprints are in one such class, and those
that share minima of their five-word shingles: its links are the pairs whose shingles are alike on the whole sets.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge.llm.common import content_id, packed, settled, table, text_id
from tollgauge.operators.graph import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
SMALL = 512
SIMILAR_WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_MINIMA = 40, 8
SPREADS = 4.5
NEIGHBOURS = 3
GROUP_NODES, GROUP_SHINGLES = 1024, 1 << 20
_BLOCK = 1 << 16
_RNG = np.random.default_rng(SEED)
_FUNCTIONS = tuple(_RNG.integers(0, 1 << 63, BANDS * BAND_MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
_BAND_FACTORS = _RNG.integers(0, 1 << 63, (BANDS, BAND_MINIMA), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def simhash(data: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of a text's UTF-8 bytes; 0 for a text without words."""
    words = data.lower().split()
    if not words:
        return 0
    width = min(shingle_words, len(words))
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(length + 1) - 1
    starts, ends = (ends - length)[: len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    digest, ones, n = xxhash.xxh64_digest, np.zeros(64, np.int64), len(starts)
    for at in range(0, n, _BLOCK):
        hashed = b"".join([digest(joined[s:e], SEED) for s, e in
                           zip(starts[at:at + _BLOCK], ends[at:at + _BLOCK], strict=True)])
        bits = np.unpackbits(np.frombuffer(hashed, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint_udf(shingle_words: int = SHINGLE_WORDS):
    """Fingerprint as a signed bigint, for a binary column; null counts as empty."""
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        found = np.fromiter((simhash(t or b"", shingle_words) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))
    return of


def _one_wildcard(value, bits: int, tag):
    """Variants of the low bits of a value: (tag, wildcard, remaining bits) packed into one long."""
    return [F.lit((tag * bits + i) << bits).bitwiseOR(value.bitwiseAND(((1 << bits) - 1) & ~(1 << i)))
            for i in range(bits)]


def _variants(rows: DataFrame, level: int) -> DataFrame:
    """Columns x, k1, k2: level 1 keys are one-wildcard halves; levels 2 and 3 add one-wildcard
    quarters and eighths of what the keys before leave open."""
    x = F.col("x")
    if level == 1:
        keys = [k for half in (0, 1) for k in
                _one_wildcard(F.shiftrightunsigned(x, 32 * half).bitwiseAND((1 << 32) - 1), 32, half)]
        return rows.select("x", F.explode(F.array(*keys)).alias("k1"), F.lit(0).cast("bigint").alias("k2"))
    tag1 = F.shiftrightunsigned("k1", 32)
    other = F.when(tag1 < 32, F.shiftrightunsigned(x, 32)).otherwise(x).bitwiseAND((1 << 32) - 1)
    if level == 2:
        keys = [k for q in (0, 1) for k in
                _one_wildcard(F.shiftrightunsigned(other, 16 * q).bitwiseAND((1 << 16) - 1), 16, q)]
        return rows.select("x", "k1", F.explode(F.array(*keys)).alias("k2"))
    tag2 = F.shiftrightunsigned("k2", 16)
    rest = F.when(tag2 < 16, F.shiftrightunsigned(other, 16)).otherwise(other).bitwiseAND((1 << 16) - 1)
    keys = [k for e in (0, 1) for k in _one_wildcard(F.shiftrightunsigned(rest, 8 * e).bitwiseAND(255), 8, e)]
    return rows.select("x", "k1", F.explode(F.array(*keys)).alias("k3"), F.col("k2").alias("k0")).select(
        "x", "k1", F.shiftleft("k0", 12).bitwiseOR(F.col("k3")).alias("k2"))


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))  # of signed numbers it would count the absolute value's bits


def forest(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each value to the least index of its component under the links of one group."""
    near = differing(values[:, None], values[None, :]) <= max_bits
    label, before = np.arange(len(values)), None
    while before is None or (label != before).any():
        before = label
        label = np.where(near, label[None, :], len(values)).min(axis=1)
        label = label[label]
    moved = label != np.arange(len(values))
    return values[moved], values[label[moved]]


def _linker(max_bits: int, limit: int | None):
    """Reads rows sorted by key. Gives (a, b, k1, k2): an edge, or with null b a member of a group
    above the limit, together with its key. At most ``limit`` members of a group are held."""
    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, key, open_hot = [], None, False

        def rows(a: np.ndarray, b: np.ndarray | None, of: tuple) -> pd.DataFrame:
            ends = pd.array([pd.NA] * len(a) if b is None else b, dtype="Int64")
            return pd.DataFrame({"a": a, "b": ends, "k1": of[0], "k2": of[1]})

        def give(members: np.ndarray, of: tuple, hot: bool) -> pd.DataFrame | None:
            members = np.unique(members)
            if hot:
                return rows(members, None, of)
            if len(members) < 2:
                return None
            a, b = forest(members, max_bits)
            return rows(a, b, of) if len(a) else None

        for frame in frames:
            if frame.empty:
                continue
            x, k1, k2 = (frame[c].to_numpy(np.int64) for c in ("x", "k1", "k2"))
            cut = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
            starts, ends = np.r_[0, cut], np.r_[cut, len(x)]
            out = []
            goes_on = key == (k1[0], k2[0])
            if not goes_on:
                out.append(give(np.concatenate(held), key, False) if held else None)
                held, open_hot = [], False
            last = len(starts) - 1
            pairs = np.flatnonzero((ends - starts == 2)[:last])
            pairs = pairs[pairs > 0] if goes_on else pairs
            p, q = x[starts[pairs]], x[starts[pairs] + 1]
            good = (differing(p, q) <= max_bits) & (p != q)
            if good.any():
                out.append(rows(q[good], p[good], (0, 0)))
            for i in sorted(({0} if goes_on else set()) | set(np.flatnonzero((ends - starts > 2)[:last]).tolist()) | {last}):
                members, of = x[starts[i]:ends[i]], (k1[starts[i]], k2[starts[i]])
                if i == 0:
                    members = np.concatenate([*held, members])
                hot = (open_hot and i == 0) or (limit is not None and len(np.unique(members)) > limit)
                if i < last:
                    out.append(give(members, of, hot))
                elif hot:  # the group may go on: its members leave at once
                    out.append(give(members, of, True))
                    held, key, open_hot = [], of, True
                else:
                    held, key, open_hot = [members], of, False
            out = [o for o in out if o is not None]
            if out:
                yield pd.concat(out, ignore_index=True)
        if held and (done := give(np.concatenate(held), key, False)) is not None:
            yield done
    return link


def links(prints: DataFrame, max_bits: int = MAX_BITS, small: int = SMALL) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints of column x that connect the same classes as
    all links of at most ``max_bits`` <= 3 differing bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves find links of at most three bits")
    rows, found = prints, []
    for level in (1, 2, 3):
        met = settled(_variants(rows, level).repartition("k1", "k2").sortWithinPartitions("k1", "k2").mapInPandas(
            _linker(max_bits, small if level < 3 else None), "a bigint, b bigint, k1 bigint, k2 bigint"))
        found.append(met.where("b is not null").select("a", "b"))
        rows = met.where("b is null").select(F.col("a").alias("x"), "k1", "k2")
        if level == 3 or rows.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: ``_row`` (its number in ``docs``), the key, ``_fingerprint`` and ``_class``, which is
    the least fingerprint that can be reached through links.

    Null and empty texts have fingerprint 0 and are linked like any other; repeated rows and keys
    each keep their row; other columns are not read; an empty table gives an empty result.
    """
    rows = settled(docs.select(F.monotonically_increasing_id().alias("_row"), F.col(f"`{key}`").alias("_key"),
                               fingerprint_udf(shingle_words)(F.col(f"`{text}`").cast("binary")).alias("_fingerprint")))
    distinct = rows.select(F.col("_fingerprint").alias("x")).distinct()
    classes = components(links(distinct, max_bits)).select(
        F.col("node").alias("_fingerprint"), F.col("component").alias("_linked"))
    return rows.join(classes, "_fingerprint", "left").select(
        "_row", "_key", "_fingerprint", F.coalesce("_linked", "_fingerprint").alias("_class"))


def shingles(data: bytes, shingle_words: int = SIMILAR_WORDS) -> np.ndarray:
    """Sorted hashes of the different shingles of a text; a shorter text is one shingle, none without words."""
    words = data.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    width = min(shingle_words, len(words))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i:i + width]), SEED)
                                  for i in range(len(words) - width + 1)), np.uint64, len(words) - width + 1))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets of shingles; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def minima(found: np.ndarray) -> np.ndarray:
    """Least value of each of BANDS x BAND_MINIMA hash functions over a set of shingles, (bands, minima)."""
    factor, add = _FUNCTIONS
    out = np.full(len(factor), np.iinfo(np.uint64).max)
    for at in range(0, len(found), 1024):
        np.minimum(out, (found[at:at + 1024, None] * factor + add).min(axis=0), out=out)
    return out.reshape(BANDS, BAND_MINIMA)


def _sets():
    """Per text: node (hash of its set of shingles), size of the set, a key for each band, and a bit of each minimum."""
    @F.pandas_udf("node bigint, size int, sketch binary, keys array<bigint>")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            found = shingles(t or b"")
            least = minima(found)
            keys = (least * _BAND_FACTORS).sum(axis=1, dtype=np.uint64)
            bits = (least.ravel() * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)
            rows.append((xxhash.xxh64_intdigest(found.tobytes(), SEED), len(found),
                         np.packbits(bits.astype(bool)).tobytes(), (keys ^ (keys >> np.uint64(31))).view(np.int64)))
        out = pd.DataFrame(rows, columns=["node", "size", "sketch", "keys"])
        out["node"] = np.array(out["node"], np.uint64).view(np.int64)
        return out
    return of


def _shared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reads rows sorted by key; leaves out those that have their key for themselves."""
    held, before = None, False
    for frame in frames:
        if frame.empty:
            continue
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        key = frame["key"].to_numpy(np.int64)
        same = key[1:] == key[:-1]
        as_before = np.r_[before, same]
        yield frame[:-1][(as_before | np.r_[same, False])[:-1]]
        held, before = frame.iloc[-1:], bool(as_before[-1])
    if held is not None and before:
        yield held


def _most_bits(similarity: float) -> float:
    """Bits of two sketches that differ at most, but for 2 in 100,000 of the pairs of just this similarity."""
    n = BANDS * BAND_MINIMA
    return n * (1 - similarity) / 2 + SPREADS * (n * (1 - similarity ** 2) / 4) ** 0.5


def _neighbours(similarity: float):
    """Reads rows sorted by key and node. Gives the pairs (a, b) of each key that stand up to ``NEIGHBOURS``
    places apart and may be similar by their sizes and sketches."""
    most = _most_bits(similarity)

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            if frame.empty:
                continue
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            key, node, size = (frame[c].to_numpy(np.int64) for c in ("key", "node", "size"))
            sketch = np.frombuffer(b"".join(frame["sketch"]), np.uint64).reshape(len(frame), -1)
            out = []
            for d in range(1, NEIGHBOURS + 1):
                at = np.arange(max(0, len(key) - d))
                at = at[key[at] == key[at + d]]
                x, y = size[at], size[at + d]
                at = at[np.minimum(x, y) >= similarity * np.maximum(x, y) - 1e-9]
                at = at[np.bitwise_count(sketch[at] ^ sketch[at + d]).sum(axis=1) <= most]
                out.append(np.stack([node[at], node[at + d]], axis=1))
            yield pd.DataFrame(np.unique(np.concatenate(out), axis=0), columns=["a", "b"])
            held = frame.iloc[-NEIGHBOURS:]
    return pairs


class _Group:
    """The members of a key, or of two blocks of it, with their sets of shingles."""

    def __init__(self, parts: list[dict[str, np.ndarray]]):
        of = lambda c: parts[0][c] if len(parts) == 1 else np.concatenate([p[c] for p in parts])
        self.key, self.node, self.size, self.own = of("key")[0], of("node"), of("size"), of("own")
        self.crossed = self.own.min() != self.own.max()
        self.root = of("label").copy()
        self.sketch = np.frombuffer(b"".join(of("sketch")), np.uint64).reshape(len(self.node), -1)
        self.keys = np.stack(of("keys"))
        found, self.flat = np.unique(np.frombuffer(b"".join(of("found")), np.uint64), return_inverse=True)
        self.starts = np.cumsum(np.r_[0, self.size])
        self.marked = np.zeros(len(found), np.int32)

    def candidates(self, i: int, similarity: float, most: float) -> np.ndarray:
        """Later members that no link joins to i yet, that may be similar, and that meet i in this key first."""
        at = np.flatnonzero(self.root[i + 1:] != self.root[i]) + i + 1
        if self.crossed:
            at = at[self.own[at] != self.own[i]]
        x, y = self.size[at], self.size[i]
        at = at[np.minimum(x, y) >= similarity * np.maximum(x, y) - 1e-9]
        at = at[np.bitwise_count(self.sketch[at] ^ self.sketch[i]).sum(axis=1) <= most]
        same = self.keys[at] == self.keys[i]
        return at[self.keys[i][same.argmax(axis=1)] == self.key]

    def links(self, similarity: float) -> list[tuple[int, int]]:
        """Verified links that join members which nothing has joined before: a spanning forest."""
        most, out = _most_bits(similarity), []
        for i in range(len(self.node) - 1):
            at = self.candidates(i, similarity, most)
            if not len(at):
                continue
            mine = self.flat[self.starts[i]:self.starts[i + 1]]
            self.marked[mine] = 1
            for j in at:
                if self.root[j] == self.root[i]:
                    continue
                both = int(self.marked[self.flat[self.starts[j]:self.starts[j + 1]]].sum())
                if both / (self.size[i] + self.size[j] - both) >= similarity - 1e-9:
                    out.append((int(self.node[i]), int(self.node[j])))
                    self.root[self.root == self.root[j]] = self.root[i]
            self.marked[mine] = 0
        return out


def _verified(similarity: float):
    """Reads rows sorted by key and block of it; gives the new links (a, b) of each group."""
    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, last = [], None

        def found() -> pd.DataFrame:
            return pd.DataFrame(_Group(held).links(similarity), columns=["a", "b"], dtype=np.int64)

        for frame in frames:
            if frame.empty:
                continue
            columns = {c: frame[c].to_numpy() for c in frame.columns}
            key, block = columns["key"], columns["block"]
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(frame)], strict=True):
                if held and (key[a], block[a]) != last:
                    yield found()
                    held = []
                held.append({c: v[a:b] for c, v in columns.items()})
                last = key[a], block[a]
        if held:
            yield found()
    return verify


def _shingle_bytes():
    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t or b"").tobytes() for t in texts], dtype=object)
    return of


def _similar(similarity: float):
    @F.pandas_udf("boolean")
    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([jaccard(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= similarity - 1e-9
                          for x, y in zip(a, b, strict=True)], dtype=bool)
    return of


def _classes(docs: DataFrame, key: str, text: str, similarity: float) -> DataFrame:
    """``_id`` (hash of the row's content), ``_key`` and ``_class`` of every row."""
    if not SIMILARITY <= similarity <= 1:
        raise ValueError("the bands find links of a similarity of at least 0.8")
    body = F.col(f"`{text}`")
    rows = settled(docs.select(content_id(docs).alias("_id"), F.col(f"`{key}`").alias("_key"), text_id(body).alias("_text"),
                               _sets()(body.cast("binary")).alias("f"), fingerprint_udf()(body.cast("binary")).alias("x")).select(
                                   "_id", "_key", "_text", "f.*", "x"))
    near_prints = components(links(rows.select("x").distinct())).select(F.col("node").alias("x"), F.col("component").alias("_linked"))
    # the class of a text's fingerprint is the first of its keys, those of the bands follow
    print_key = F.xxhash64(F.lit("fingerprint"), F.coalesce("_linked", "x"))
    nodes = rows.groupBy("node").agg(F.min("_text").alias("_text"), F.first("size").alias("size"), F.first("sketch").alias("sketch"),
                                     F.first("keys").alias("keys"), F.min("x").alias("x")).join(near_prints, "x", "left").select(
        "node", "_text", "size", "sketch", F.concat(F.array(print_key), "keys").alias("keys"))
    shared = settled(nodes.select(F.explode("keys").alias("key"), "node").repartition("key").sortWithinPartitions("key").mapInPandas(
        _shared, "key bigint, node bigint"))
    known = settled(nodes.join(shared.select("node").distinct(), "node"))
    texts = docs.select(text_id(body).alias("_text"), body.cast("binary").alias("data")).groupBy("_text").agg(F.first("data").alias("data"))
    sets = settled(texts.join(known.select("_text", "node"), "_text").select("node", _shingle_bytes()("data").alias("found")))
    near = shared.join(known.select("node", "size", "sketch"), "node").repartition("key").sortWithinPartitions("key", "node").mapInPandas(
        _neighbours(similarity), "a bigint, b bigint").distinct()
    edges = settled(near.join(sets.select(F.col("node").alias("a"), F.col("found").alias("fa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("found").alias("fb")), "b").where(
        _similar(similarity)("fa", "fb")).select("a", "b"))
    classes = components(edges).select("node", F.col("component").alias("label"))
    members = shared.join(known.join(classes, "node", "left").select("node", "size", F.coalesce("label", "node").alias("label")), "node")
    parts = F.ceil(F.greatest(2 * F.col("n") / GROUP_NODES, 2 * F.col("shingles") / GROUP_SHINGLES))
    open_keys = members.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("size").alias("shingles"), F.min("label").alias("least"), F.max("label").alias("most")).where(
        "least < most").select("key", F.when((F.col("n") <= GROUP_NODES) & (F.col("shingles") <= GROUP_SHINGLES), 1).otherwise(
            parts).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = members.select("key", "node", "label").join(open_keys, "key").withColumn("own", own).withColumn("other", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)))
    block = F.least("own", "other").cast("bigint") * F.col("blocks") + F.greatest("own", "other")
    # where two different blocks come together, a member meets those of the other one only
    verified = dealt.select("key", "node", "label", "own", block.alias("block")).join(
        known.select("node", "size", "sketch", "keys"), "node").join(sets, "node").repartition("key", "block").sortWithinPartitions(
        "key", "block", "node").mapInPandas(_verified(similarity), "a bigint, b bigint")
    whole = components(edges.unionByName(settled(verified)))
    return rows.join(whole, "node", "left").select("_id", "_key", F.coalesce("component", "node").alias("_class"))


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Per row: ``_id`` (a hash of its content), ``_key`` and ``_class``, for removing near copies. Two texts are linked if at
    least ``similarity`` of their five-word shingles are common (Jaccard); every link is verified on the whole sets of shingles.

    Candidates have fingerprints of one class, or share all minima of one of ``BANDS`` bands; a pair at exactly 0.8 is missed with a
    probability of 6 in 10,000, one at 0.85 of 3 in a million; the sketches add about 2 in 100,000 at 0.8. Texts with the same
    shingles are one node. Within a key, neighbours are verified first. A key that these links have not joined to one class is then
    compared within its group, where the sets of its members come together and a pair is compared in the first key it shares only; a large key is dealt
    to tasks as pairs of blocks. What leaves a group is a forest of links, so no output grows with the square of a group.

    Null and empty texts are one class; repeated rows and keys each keep their row; texts are known by their hash from
    one scan to the next; columns of any names pass; an empty table gives an empty result.
    """
    return _classes(docs, key, text, similarity)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class of ``near_copies``: the one with the least key (null first),
    then hash of its content. Columns of any names pass through; of repeated rows one stays."""
    first = _classes(docs, key, text, similarity).groupBy("_class").agg(F.min(F.struct("_key", "_id"))["_id"].alias("id"))
    # equal rows are one before they meet in a task
    one = docs.select(content_id(docs).alias("id"), packed(docs).alias("row")).groupBy("id").agg(F.first("row").alias("row"))
    return one.join(first.select("id"), "id", "left_semi").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    least = found.groupBy("_class").agg(F.min("_key").alias("component_id"))
    return found.join(least, "_class").select(
        F.col("_key").alias("doc_id"), F.lower(F.lpad(F.hex("_fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id")
