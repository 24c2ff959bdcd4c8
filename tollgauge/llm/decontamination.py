"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts are sequences of words (A-Z lower-cased, outer punctuation dropped). A CGK walk reads a
sequence and writes a longer one: at every step it writes the current word and then moves on or not,
as a random bit of (step, word) says. Small edit distance becomes small Hamming distance. Each of
``WALKS`` walks is sampled by ``BANDS`` bands of ``KEYS`` positions; equal samples make a candidate, and an
exact edit distance decides.

Windows start at minimisers of word pairs, which an item and its copy share, so not every word
starts one. An item is indexed from each of its minimisers that leaves at least half of it; the rest
of the item is the window's size. The walk of a longer window begins with that of a shorter one,
so one walk per start serves all size classes; a class samples only steps that lie within its
smallest size.

An item under ``SHORT_WORDS`` words is cut into one piece more than the edits it may have. One of them stands
unedited in every copy, so a look-up of the pieces at every word finds all copies, for items of any length.

The items are small, the documents are not: an index of at most ``SLICE_WORDS`` words goes to every
task, and a larger benchmark is searched slice by slice. Documents are read where they lie.
"""

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge.llm.common import packed, table, text_id

SIMILARITY = 0.8
WALKS, BANDS, KEYS = 3, 4, 4
CLASSES = (6, 12, 24, 40)
REACH = 1.6
ANCHOR = 8
LEAST_WORDS = 1
SHORT_WORDS = 40
SLICE_WORDS = 2_000_000
SEED = 6007
_PIECE = 60_000
_CACHE = 150_000
_TABLE_BITS = 22
_STEPS = int(REACH * CLASSES[-1])
_PUNCTUATION = b".,;:!?\"'()[]{}"
_WIDE_PUNCTUATION = re.compile("[\u3000-\u3004\u3008-\u3020\u3030\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
#: Thai, Lao, Burmese, Khmer, kana and Han: written without spaces, so each character is a word
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff])")


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    h = x ^ np.uint64(salt & ((1 << 64) - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words(dict):
    """Word -> odd 64-bit hash; 0 stands for no word. Forgets when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHE:
            self.clear()
        bare = word.strip(_PUNCTUATION)
        self[word] = found = xxhash.xxh3_64_intdigest(bare, SEED) | 1 if bare else 0
        return found

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the words of a text."""
        text = text or ""
        if not text.isascii() and _UNSPACED.search(text):
            text = _UNSPACED.sub(r" \1 ", _WIDE_PUNCTUATION.sub(" ", text))
        words = text.encode().lower().split()
        found = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        return found[found != 0]


def starts(flat: np.ndarray) -> np.ndarray:
    """Minimisers of word pairs: the least pair of every ``ANCHOR`` pairs in a row."""
    if len(flat) <= ANCHOR:
        return np.empty(0, np.int64)
    pair = _mixed(flat[:-1] * np.uint64(3) + flat[1:], SEED)
    pair[(flat[:-1] == 0) | (flat[1:] == 0)] = np.iinfo(np.uint64).max
    low = np.uint64((1 << 32) - 1)
    key = (pair | low) ^ low | np.arange(len(pair), dtype=np.uint64)
    view = np.lib.stride_tricks.sliding_window_view(key, ANCHOR)
    least = view[:, 0].copy()
    for i in range(1, ANCHOR):
        np.minimum(least, view[:, i], out=least)
    place = (least & low).astype(np.int64)
    return np.unique(place[pair[place] != np.iinfo(np.uint64).max])


def _bands() -> list[list[list[tuple[np.ndarray, np.ndarray]]]]:
    """[walk][class][band]: sampled steps and multipliers."""
    rng = np.random.default_rng(SEED)
    return [[[(np.sort(rng.choice(int(REACH * low), KEYS, replace=False)),
               rng.integers(1, 1 << 63, KEYS, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
              for _ in range(BANDS)] for low in CLASSES] for _ in range(WALKS)]


SAMPLES = _bands()


def walk_keys(flat: np.ndarray, at: np.ndarray, walk: int) -> list[list[np.ndarray]]:
    """Keys of the windows that start at the given words, [class][band]. ``flat`` ends every text
    with 0, where walks stay."""
    steps = np.empty((_STEPS, len(at)), np.uint32)
    small, pos = (flat >> np.uint64(32)).astype(np.uint32), at.copy()
    for j in range(_STEPS):
        if j % 64 == 0:
            bits = _mixed(flat, (walk * 64 + j + 1) * 0x9E3779B97F4A7C15)
            bits[flat == 0] = 0
        steps[j] = small[pos]
        pos += ((bits[pos] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)
    out = []
    for bands in SAMPLES[walk]:
        out.append([])
        for places, factors in bands:
            key = np.zeros(len(at), np.uint64)
            for p, f in zip(places, factors, strict=True):
                key += steps[p].astype(np.uint64) * f
            out[-1].append(key)
    return out


def edits(size: int, similarity: float = SIMILARITY) -> int:
    """Word edits that an item of so many words may have."""
    return size - math.ceil(similarity * size - 1e-9)


def piece_keys(flat: np.ndarray, length: int) -> np.ndarray:
    """Keys of all windows of so many words."""
    key = np.zeros(max(0, len(flat) - length + 1), np.uint64)
    for j in range(length):
        key = _mixed(key ^ flat[j:len(key) + j], SEED + 1)
    return key


def _sieve(keys: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """Which high bits some key has, and how far a key is shifted to them: about a hundredth of other keys pass, however many there are."""
    shift = np.uint64(64 - min(_TABLE_BITS, max(10, len(keys).bit_length() + 7)))
    table = np.zeros(1 << (64 - int(shift)), bool)
    table[keys >> shift] = True
    return table, shift


class Index:
    """Items by their sampled keys, short ones by their pieces."""

    def __init__(self, items: list[tuple[int, np.ndarray]], similarity: float = SIMILARITY):
        self.items = items
        pieces: dict[int, list[tuple[int, int, int]]] = {}  # length -> key, item number, start within it
        for number, (_, words) in enumerate(items):
            if 0 < len(words) < SHORT_WORDS:
                n = min(len(words), edits(len(words), similarity) + 1)
                cuts = [len(words) * i // n for i in range(n + 1)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    pieces.setdefault(b - a, []).append((int(piece_keys(words[a:b], b - a)[0]), number, a))
        self.pieces = {}
        for length, rows in pieces.items():
            rows.sort()
            keys = np.array([r[0] for r in rows], np.uint64)
            self.pieces[length] = keys, np.array([r[1:] for r in rows], np.int64), *_sieve(keys)
        rows = []  # item number, start within it, class
        flat, bounds = [], 0
        for number, (_, words) in enumerate(items):
            for a in starts(words).tolist() if len(words) >= SHORT_WORDS else []:
                left = len(words) - a
                if left >= CLASSES[0] and 2 * left >= len(words):
                    rows.append((number, a, sum(left >= low for low in CLASSES) - 1, bounds + a))
            flat.append(np.r_[words, np.uint64(0)])
            bounds += len(words) + 1
        self.number, self.start, size, at = (np.array([r[k] for r in rows], np.int64) for k in range(4))
        joined = np.concatenate(flat) if flat else np.zeros(1, np.uint64)
        self.keys, self.rows, self.tables = {}, {}, {}
        for walk in range(WALKS):
            found = walk_keys(joined, at, walk)
            for c in range(len(CLASSES)):
                mine = np.flatnonzero(size == c)
                for band in range(BANDS):
                    keys = found[c][band][mine]
                    order = np.argsort(keys, kind="stable")
                    where = walk, c, band
                    self.keys[where], self.rows[where] = keys[order], mine[order]
                    self.tables[where] = _sieve(keys) if len(keys) else None
        self.masks = []
        for _, words in items:
            mask: dict[int, int] = {}
            for i, w in enumerate(words.tolist()):
                mask[w] = mask.get(w, 0) | 1 << i
            self.masks.append(mask)

    def candidates(self, flat: np.ndarray) -> dict[tuple[int, int], int]:
        """(item number, word where the item would begin) of all windows that share a key, with the
        word where the window begins."""
        at, found = starts(flat), {}
        for length, (have, rows, table, shift) in self.pieces.items():
            key = piece_keys(flat, length)
            maybe = np.flatnonzero(table[key >> shift])
            first, last = np.searchsorted(have, key[maybe], "left"), np.searchsorted(have, key[maybe], "right")
            for i, a, b in zip(maybe[last > first].tolist(), first[last > first].tolist(), last[last > first].tolist(), strict=True):
                for number, start in rows[a:b].tolist():
                    found[number, i - start] = i
        for walk in range(WALKS):
            keys = walk_keys(flat, at, walk)
            for (w, c, band), have in self.keys.items():
                if w != walk or not len(have):
                    continue
                key = keys[c][band]
                table, shift = self.tables[w, c, band]
                maybe = np.flatnonzero(table[key >> shift])
                first, last = np.searchsorted(have, key[maybe], "left"), np.searchsorted(have, key[maybe], "right")
                for i, a, b in zip(maybe[last > first].tolist(), first[last > first].tolist(), last[last > first].tolist(), strict=True):
                    rows = self.rows[w, c, band][a:b]
                    for number, begin in zip(self.number[rows].tolist(), (at[i] - self.start[rows]).tolist(), strict=True):
                        found[number, begin] = int(at[i])
        return found

    def distance(self, number: int, words: list[int]) -> tuple[int, int]:
        """Least edit distance of the item to a part of the words, and where that part ends (the first
        such place), by bit-parallel dynamic programming."""
        mask, n = self.masks[number], len(self.items[number][1])
        full, top = (1 << n) - 1, 1 << (n - 1)
        plus, minus, score, best, end = full, 0, n, n, 0
        for i, w in enumerate(words):
            equal = mask.get(w, 0)
            v = equal | minus
            h = (((equal & plus) + plus) ^ plus) | equal
            up, down = minus | (full & ~(h | plus)), plus & h
            score += 1 if up & top else -1 if down & top else 0
            up, down = (up << 1) & full, (down << 1) & full
            plus, minus = down | (full & ~(v | up)), up & v
            if score < best:
                best, end = score, i + 1
        return best, end


def _searcher(items: list[tuple[int, np.ndarray]], similarity: float):
    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, words = Index(items, similarity), Words()
        for frame in frames:
            texts = [words.of(t) for t in frame["text"]]
            keys, out = frame["key"].tolist(), []
            i = 0
            while i < len(texts):
                n, j = 0, i
                while j < len(texts) and (j == i or n + len(texts[j]) < _PIECE):
                    n, j = n + len(texts[j]) + 1, j + 1
                flat = np.concatenate([p for t in texts[i:j] for p in (t, np.zeros(1, np.uint64))])
                begin = np.cumsum([0] + [len(t) + 1 for t in texts[i:j]])
                best: dict[tuple[int, int], tuple[int, int]] = {}
                for (number, at), anchor in sorted(index.candidates(flat).items()):
                    size = len(items[number][1])
                    slack = edits(size, similarity)
                    doc = int(np.searchsorted(begin, anchor, "right")) - 1
                    if best.get((doc, number), (1, 0))[0] == 0:
                        continue
                    low, high = max(begin[doc], at - slack), min(begin[doc + 1] - 1, at + size + slack)
                    distance, end = index.distance(number, flat[low:high].tolist())
                    if distance <= slack:
                        found = distance, int(low - begin[doc]) + end
                        best[doc, number] = min(best.get((doc, number), found), found)
                out += [(keys[i + doc], items[number][0], d, 1 - d / len(items[number][1]), len(items[number][1]), end)
                        for (doc, number), (d, end) in best.items()]
                i = j
            yield pd.DataFrame(out, columns=["_key", "item_id", "distance", "similarity", "item_words", "end_word"])
    return search


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", similarity: float = SIMILARITY,
                 slice_words: int = SLICE_WORDS) -> DataFrame:
    """A row per document row and benchmark item found in it: the key, item_id, distance (word
    edits), similarity (1 - distance / item words), item_words and end_word (the last word of the
    best place, counted from 1; the first of equally good ones).

    An item is found if some part of the text is within (1 - similarity) x its words, so one under five
    words only if it stands there unedited. Characters of scripts without spaces count as words. Null
    or empty texts and items give no row; repeated items are searched once per item_id and repeated documents give a row each.
    """
    sizes = benchmark.select("item_id", "text").where("text is not null and item_id is not null").distinct()
    total = sizes.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    slices, out, words = max(1, math.ceil(total / slice_words)), None, Words()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col("text"))
    kind = rows.schema["key"].dataType.simpleString()
    for part in range(slices):
        mine = sizes.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == part).collect()  # at most about slice_words words
        items = sorted(((int(r["item_id"]), words.of(r["text"])) for r in mine), key=lambda x: (x[0], len(x[1])))
        items = [x for x in items if len(x[1]) >= LEAST_WORDS]
        found = rows.mapInPandas(_searcher(items, similarity), f"_key {kind}, item_id bigint, distance int, "
                                 "similarity double, item_words int, end_word int")
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("_key", key)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows in which an item is found. What is found is a text, known by its hash, so repeated rows stay or go
    together; columns of any names pass through; null and empty texts stay; an empty table gives an empty result."""
    of = text_id(F.col(f"`{text}`"))
    found = contaminated(docs.select(of.alias("id"), F.col(f"`{text}`").alias("text")), benchmark, key="id", **options)
    return docs.select(packed(docs).alias("row"), of.alias("id")).join(found.select("id").distinct(), "id", "left_anti").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
