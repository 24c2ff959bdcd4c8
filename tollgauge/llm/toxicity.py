"""Toxicity: a sparse logistic classifier that is regularised by counterfactuals.

Features are the hashed words of a whole text and their five-byte beginnings, each present or not.
In labelled texts that mention a group, every identity term is swapped for the next one of its
list; half the squared change of the score that the swap makes is added to the loss, so a mention
by itself cannot carry weight. An L1 penalty keeps only words that speak for a class.

The model is fitted on the driver from the feature numbers of a bounded sample of labelled
documents (``SAMPLE``, see ``labelled_ids``); scoring reads every document where it lies, without a
shuffle.
"""

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge.llm.common import fold, labelled_ids, labelled_rows, table

SAMPLE = 5000
FOLDS, HELD = 3, 1
THRESHOLD = 0.7
SEED = 4101
LEAST_DOCS = 3
PENALTY, SWAP_PENALTY, ROUNDS = 2e-3, 1.0, 150
_BITS = 20
_CACHE = 150_000
_TOKEN = re.compile(rb"[a-z0-9'\x80-\xff]+")

#: fixed values: terms that may be swapped for one another
IDENTITY_TERMS = (
    "women men girls boys females males", "woman man girl boy female male",
    "christian muslim jewish hindu buddhist sikh atheist catholic protestant",
    "christians muslims jews hindus buddhists sikhs atheists catholics protestants",
    "gay lesbian straight bisexual transgender queer heterosexual homosexual",
    "black white asian african european latino hispanic arab native",
    "americans mexicans chinese indians africans russians germans french immigrants refugees",
    "blind deaf disabled autistic", "old young elderly",
    "femmes hommes", "chrétiens musulmans juifs", "frauen männer", "christen muslime juden",
    "mujeres hombres", "cristianos musulmanes judíos")


def _swaps() -> dict[bytes, bytes]:
    out: dict[bytes, bytes] = {}
    for line in IDENTITY_TERMS:
        terms = [t.encode() for t in line.split()]
        out |= dict(zip(terms, terms[1:] + terms[:1], strict=True))
    return out


SWAPS = _swaps()


def tokens(text: str | None) -> list[bytes]:
    return _TOKEN.findall((text or "").encode().lower())


def _buckets(word: bytes) -> tuple[int, int]:
    mask = (1 << _BITS) - 1
    return xxhash.xxh32_intdigest(word, 1) & mask, xxhash.xxh32_intdigest(word[:5], 2) & mask


def features(words) -> set[int]:
    return {b for w in words for b in _buckets(w)}


@dataclass
class Model:
    """A bias and the weights other than zero, by bucket."""
    bias: float
    weights: dict[int, float]

    def scorer(self):
        """text -> score, with a bounded memory of words seen."""
        seen: dict[bytes, tuple[int, ...]] = {}
        weights, bias = self.weights, self.bias

        def score(text: str | None) -> float:
            if len(seen) > _CACHE:
                seen.clear()
            hits: set[int] = set()
            for w in set(tokens(text)):
                found = seen.get(w)
                if found is None:
                    found = seen[w] = tuple(b for b in _buckets(w) if b in weights)
                if found:
                    hits.update(found)
            z = bias + sum(weights[b] for b in sorted(hits))
            return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return score


def fit(present: list[np.ndarray], swapped: list[np.ndarray | None], labels: np.ndarray,
        penalty: float = PENALTY, swap_penalty: float = SWAP_PENALTY, rounds: int = ROUNDS) -> Model:
    """Proximal adaptive gradient over all rows. ``swapped`` holds a row's buckets after the swap, or
    None where it has no identity term. Without both classes the model is its prior."""
    n, positive = len(labels), int(labels.sum())
    if not 0 < positive < n:
        return Model(float(np.log((positive + 0.01) / (n - positive + 1))), {})
    row = np.repeat(np.arange(n), [len(p) for p in present])
    flat = np.concatenate(present)
    names, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    changes = [(i, np.setdiff1d(present[i], s), np.setdiff1d(s, present[i])) for i, s in enumerate(swapped) if s is not None]
    often = count >= LEAST_DOCS
    number = np.cumsum(often) - 1
    row, column = row[often[column]], number[column[often[column]]]
    names = names[often]
    k = len(names)

    def known(buckets: np.ndarray) -> np.ndarray:
        at = np.searchsorted(names, buckets)
        at = np.minimum(at, max(0, k - 1))
        return at[names[at] == buckets] if k else at[:0]
    swap_row, swap_col, swap_sign = [], [], []
    for j, (_, gone, new) in enumerate(changes):
        for sign, part in ((1.0, known(gone)), (-1.0, known(new))):
            swap_row += [j] * len(part)
            swap_col += part.tolist()
            swap_sign += [sign] * len(part)
    swap_row, swap_col = np.array(swap_row, np.int64), np.array(swap_col, np.int64)
    swap_sign = np.array(swap_sign)

    share = np.where(labels == 1, 0.5 / positive, 0.5 / (n - positive))
    w, bias, sum_w, sum_b, step, chosen = np.zeros(k), 0.0, np.full(k, 1e-8), 1e-8, 0.3, 1.0
    for turn in range(2 * rounds):
        if turn == rounds:  # the words are chosen: their weights are fitted again with little shrinkage
            chosen, penalty, sum_w, sum_b = (w != 0).astype(float), penalty / 10, np.full(k, 1e-8), 1e-8
        z = bias + np.bincount(row, w[column], n)
        g = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        grad = np.bincount(column, g[row], k)
        if len(swap_row):
            change = np.bincount(swap_row, swap_sign * w[swap_col], len(changes))
            grad += swap_penalty / n * np.bincount(swap_col, swap_sign * change[swap_row], k)
        sum_w, sum_b = sum_w + grad ** 2, sum_b + g.sum() ** 2
        rate = step / np.sqrt(sum_w)
        w = w - chosen * rate * grad
        w = np.sign(w) * np.maximum(0, np.abs(w) - rate * penalty)
        bias -= step / np.sqrt(sum_b) * g.sum()
    kept = w != 0
    return Model(float(bias), dict(zip(names[kept].tolist(), w[kept].tolist(), strict=True)))


def _feature_rows(frames):
    for frame in frames:
        plain, swapped = [], []
        for text in frame["text"]:
            words = set(tokens(text))
            plain.append(sorted(features(words)))
            swapped.append(sorted(features({SWAPS.get(w, w) for w in words})) if words & SWAPS.keys() else None)
        yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"], "plain": plain, "swapped": swapped})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` labelled documents outside the held-out fold."""
    ids = labelled_ids(labels, "toxic", FOLDS, HELD, sample, SEED)
    rows = labelled_rows(docs, ids, "text").mapInPandas(
        _feature_rows, "doc_id bigint, label int, plain array<int>, swapped array<int>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    return fit([np.asarray(p, np.int64) for p in rows["plain"]],
               [None if s is None else np.asarray(s, np.int64) for s in rows["swapped"]],
               rows["label"].to_numpy(np.int64))


def score_udf(model: Model):
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        one = model.scorer()
        return pd.Series([one(t) for t in texts], dtype="float64")
    return score


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with _toxicity (0 to 1).

    Null and empty texts get the score of a text without words. Repeated rows are scored alike.
    Without labels, or with one class only, every score is the class prior. Labels, lang, source
    and ids are not read for a score; other columns pass through.
    """
    return docs.withColumn("_toxicity", score_udf(train(docs, labels, sample))(F.col("text")))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents whose score stays below the threshold. Columns of any names pass through; repeated rows stay or go
    together; null and empty texts get the score of a text without words; an empty table gives an empty result."""
    model = train(docs, labels)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), score_udf(model)(F.col("text")).alias("score"))
    return rows.where(F.col("score") < threshold).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"),
                       F.col("_toxicity").alias("score"), (F.col("_toxicity") >= THRESHOLD).cast("int").alias("predicted"))
