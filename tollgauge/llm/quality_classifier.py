"""Quality classifier: a factorisation machine over words, structure and metadata.

A document's features are its hashed words (log counts, of unit length together), bins of structure
statistics and bins of its metadata. Every feature has a weight and a vector of ``RANK`` numbers; the
interaction of two features is the product of their vectors. All pairs together are scored in linear
time: half of (sum of v x) squared less the sum of (v x) squared, summed over the rank.

The machine is fitted on the driver by Adam over the sparse features of a bounded sample of labelled
documents (``SAMPLE``, see ``labelled_ids``). Scoring reads every document where it lies.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge.llm.common import fold, labelled_ids, labelled_rows, table

SAMPLE = 5000
FOLDS, HELD = 4, 2
THRESHOLD = 0.7
SEED = 9001
RANK = 6
WORDS = 4096
BINS = 12
EPOCHS, BATCH, RATE, DECAY = 12, 128, 0.02, 1e-4
_STATISTICS = 10
_METADATA = WORDS + _STATISTICS * BINS
FEATURES = _METADATA + 2 * BINS
_CACHE = 150_000
_SLICE = 400


def statistics(data: bytes, words: Counter) -> list[float]:
    """Shares between 0 and 1 that describe a text's form, and its length on a log scale."""
    n, total = max(1, len(data)), max(1, sum(words.values()))
    without = lambda drop: len(data) - len(data.translate(None, drop))
    lines = [x for x in data.split(b"\n") if x.strip()]
    short = sum(len(x) < 40 for x in lines)
    return [without(b"#*$%&|<>") / n, without(b"0123456789") / n, without(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / n,
            without(b".,;:!?") / n, without(b"@/\\_=~^{}[]()") / n, len(words) / total,
            min(1.0, n / total / 20), 1 - len(set(lines)) / max(1, len(lines)), short / max(1, len(lines)),
            min(1.0, np.log2(1 + sum(words.values())) / 16)]


class Featurer:
    """Sparse features of texts, with a bounded memory of words seen."""

    def __init__(self):
        self.seen: dict[bytes, int] = {}

    def of(self, text: str | None, n_chars) -> tuple[list[int], list[float]]:
        data = (text or "").encode()
        words, seen = Counter(data.lower().split()), self.seen
        if len(seen) > _CACHE:
            seen.clear()
        buckets: dict[int, float] = {}
        for w, n in words.items():
            b = seen.get(w)
            if b is None:
                b = seen[w] = xxhash.xxh32_intdigest(w, SEED) % WORDS
            buckets[b] = buckets.get(b, 0) + n
        value = np.log1p(np.fromiter(buckets.values(), np.float64, len(buckets)))
        value /= max(1e-9, float(np.sqrt((value ** 2).sum())))
        form = [WORDS + i * BINS + min(BINS - 1, int(s ** 0.5 * BINS)) for i, s in enumerate(statistics(data, words))]
        known = n_chars is not None and n_chars == n_chars and n_chars >= 0
        size = int(min(BINS - 1, np.log2(1 + float(n_chars)) * BINS / 20)) if known else 0
        meta = [_METADATA + size, _METADATA + BINS + (1 if known else 0)]
        return [*buckets, *form, *meta], [*value.tolist(), *[0.4] * (len(form) + len(meta))]


class Machine:
    def __init__(self, rng: np.random.Generator):
        self.bias = np.zeros(1)
        self.weight = np.zeros(FEATURES)
        self.vector = rng.normal(0, 0.05, (FEATURES, RANK))

    def logits(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the sums of v x, by row."""
        vx = self.vector[column] * value[:, None]
        sums = np.stack([np.bincount(row, vx[:, f], n) for f in range(RANK)], axis=1)
        squares = np.bincount(row, (vx ** 2).sum(axis=1), n)
        return self.bias[0] + np.bincount(row, self.weight[column] * value, n) + 0.5 * ((sums ** 2).sum(axis=1) - squares), sums


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(columns: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Machine:
    """Adam on the logistic loss in which both classes weigh the same. One class only: its prior."""
    rng = np.random.default_rng(SEED)
    machine, n, positive = Machine(rng), len(labels), int(labels.sum())
    if not 0 < positive < n:
        machine.vector[:] = 0
        machine.bias[0] = np.log((positive + 0.5) / (n - positive + 0.5))
        return machine
    share = np.where(labels == 1, 0.5 * n / positive, 0.5 * n / (n - positive))
    state = [(x, np.zeros_like(x), np.zeros_like(x)) for x in (machine.bias, machine.weight, machine.vector)]
    turn = 0
    for _ in range(max(epochs, -(-600 // max(1, n // BATCH)) if n < 50 * BATCH else epochs)):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            some, turn = order[at:at + BATCH], turn + 1
            row = np.repeat(np.arange(len(some)), [len(columns[i]) for i in some])
            column = np.concatenate([columns[i] for i in some])
            value = np.concatenate([values[i] for i in some])
            z, sums = machine.logits(row, column, value, len(some))
            g = share[some] * (_sigmoid(z) - labels[some]) / len(some)
            gx = g[row] * value
            to_v = gx[:, None] * (sums[row] - machine.vector[column] * value[:, None])
            grads = (np.array([g.sum()]), np.bincount(column, gx, FEATURES) + DECAY * machine.weight,
                     np.stack([np.bincount(column, to_v[:, f], FEATURES) for f in range(RANK)], axis=1) + DECAY * machine.vector)
            for (x, m, v), grad in zip(state, grads, strict=True):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad ** 2 - v)
                x -= RATE * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-8)
    return machine


def _feature_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    featurer = Featurer()
    for frame in frames:
        found = [featurer.of(t, n) for t, n in zip(frame["text"], frame["n_chars"], strict=True)]
        yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"], "columns": [c for c, _ in found],
                            "values": [v for _, v in found]})


def _with_metadata(docs: DataFrame) -> DataFrame:
    return docs if "n_chars" in docs.columns else docs.withColumn("n_chars", F.lit(None).cast("bigint"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fit on about ``sample`` labelled documents outside the held-out fold."""
    ids = labelled_ids(labels, "quality", FOLDS, HELD, sample, SEED)
    rows = labelled_rows(_with_metadata(docs), ids, "text", "n_chars").mapInPandas(
        _feature_rows, "doc_id bigint, label int, columns array<int>, values array<double>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    return fit([np.asarray(c, np.int64) for c in rows["columns"]], [np.asarray(v) for v in rows["values"]],
               rows["label"].to_numpy(np.int64))


def score_udf(machine: Machine):
    @F.pandas_udf("double")
    def score(texts: pd.Series, sizes: pd.Series) -> pd.Series:
        featurer, out = Featurer(), []
        for at in range(0, len(texts), _SLICE):
            found = [featurer.of(t, n) for t, n in zip(texts[at:at + _SLICE], sizes[at:at + _SLICE], strict=True)]
            row = np.repeat(np.arange(len(found)), [len(c) for c, _ in found])
            column = np.fromiter((x for c, _ in found for x in c), np.int64, len(row))
            value = np.fromiter((x for _, v in found for x in v), np.float64, len(row))
            out.append(_sigmoid(machine.logits(row, column, value, len(found))[0]))
        return pd.Series(np.concatenate(out) if out else [], dtype="float64")
    return score


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with _quality (0 to 1, higher: likelier good); a column of this name is replaced.

    A null text is an empty one; a missing or null n_chars has a bin of its own; repeated rows are
    scored alike. Without labels, or with one class only, every score is the class prior. Labels,
    lang, source and ids are not read for a score; other columns pass through.
    """
    score = score_udf(train(docs, labels, sample))(F.col("text"), F.col("n_chars").cast("double"))
    return _with_metadata(docs).select(*[F.col(f"`{c}`") for c in docs.columns if c != "_quality"], score.alias("_quality"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"),
                       F.col("_quality").alias("score"), (F.col("_quality") >= THRESHOLD).cast("int").alias("predicted"))
