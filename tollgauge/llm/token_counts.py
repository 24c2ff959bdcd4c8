"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

A text is cut into pre-tokens; a pre-token is cut into the pieces of a vocabulary whose log
probabilities sum highest (of equal sums, the fewest pieces). The best sum of a prefix does not depend
on what follows, so distinct pre-tokens go into a trie whose nodes hold the best sum and its number
of pieces: a shared prefix is scored once, and the node where a pre-token ends holds its count.

The vocabulary is a file of ranked byte strings (its path is a parameter; the driver reads it and
sends it along, a bounded table). Ranks stand for frequencies: a piece of rank r has the probability
of Zipf's law, proportional to 1 / (r + ``SHIFT``). All single bytes are pieces, so every text has a
cut. Documents are read where they lie, without a shuffle.
"""

import base64
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge.llm.common import table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SHIFT = 2.7
NODES = 400_000
#: words with the space before them, numbers, other signs, and white space
PRETOKEN = re.compile(rb" ?[A-Za-z\x80-\xff]+| ?[0-9]+| ?[^\sA-Za-z0-9\x80-\xff]+|\s+")


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, float]:
    """Piece -> log probability, from lines of base64 text and rank."""
    with open(path, "rb") as lines:
        rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    for b in range(256):
        rank.setdefault(bytes([b]), len(rank))
    total = math.log(sum(1 / (r + SHIFT) for r in rank.values()))
    return {p: -math.log(r + SHIFT) - total for p, r in rank.items()}


class Trie:
    """Pre-tokens with their numbers of pieces. A node is [children, best sum, pieces, terminal count];
    beyond ``NODES`` nodes the trie starts afresh, so its memory is bounded."""

    def __init__(self, vocabulary: dict[bytes, float]):
        self.score, self.longest = vocabulary, max(map(len, vocabulary))
        self.clear()

    def clear(self) -> None:
        self.root, self.size, self.counts = [{}, 0.0, 0, 0], 0, {}

    def insert(self, word: bytes) -> int:
        """Number of pieces of a pre-token."""
        path, node, n = [self.root], self.root, len(word)
        at = 0
        while at < n and (child := node[0].get(word[at])) is not None:
            path.append(child)
            node, at = child, at + 1
        score = self.score
        for end in range(at + 1, n + 1):
            best, pieces = -math.inf, 0
            for begin in range(max(0, end - self.longest), end):
                s = score.get(word[begin:end])
                if s is not None:
                    before = path[begin]
                    s += before[1]
                    if s > best or s == best and before[2] + 1 < pieces:
                        best, pieces = s, before[2] + 1
            made = [{}, best, pieces, 0]
            node[0][word[end - 1]] = made
            path.append(made)
            node = made
        self.size += n - at
        node[3] = node[2]
        return node[3]

    def count(self, data: bytes) -> tuple[int, int]:
        """Tokens and pre-tokens of a text."""
        if self.size > NODES:
            self.clear()
        words, counts = PRETOKEN.findall(data), self.counts
        for w in set(words).difference(counts):
            counts[w] = self.insert(w)
        return sum(map(counts.__getitem__, words)), len(words)


def _counter(vocabulary: dict[bytes, float]):
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = Trie(vocabulary)
        for frame in frames:
            found = [trie.count((t or "").encode()) for t in frame["text"]]
            yield pd.DataFrame({"key": frame["key"].array, "n_tokens": [a for a, _ in found], "n_pretokens": [b for _, b in found]})
    return count


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """A row per document row: the key, n_tokens and n_pretokens. A null or empty text has none of
    either; repeated rows are counted each; other columns are not read; an empty table gives none."""
    return docs.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("text")).mapInPandas(
        _counter(read_vocabulary(vocabulary)), "key bigint, n_tokens bigint, n_pretokens bigint").withColumnRenamed("key", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
