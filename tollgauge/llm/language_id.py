"""Language ID: a bidirectional gated recurrent network over bytes.

A text is cut into windows of ``STEPS`` bytes. Two gated recurrent units read a window, one from each
end; a linear layer over both states labels every byte, and a document's probabilities are the means
over all its bytes. The network is trained in numpy by backpropagation through time.

Training takes windows from anywhere in the texts of a bounded sample of labelled documents
(``SAMPLE`` documents, ``WINDOWS`` windows each) to the driver. Labelling reads every byte of every
document where it lies, in blocks of ``BLOCK`` windows, without a shuffle.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge.llm.common import fold, hash_below, table

SAMPLE, WINDOWS = 3000, 3
STEPS, WIDTH = 64, 8
EPOCHS, BATCH, RATE = 5, 256, 0.02
FOLDS, HELD = 3, 1
SEED = 7013
BLOCK = 2048
UNKNOWN = "und"

Parameters = dict[str, np.ndarray]


def start(languages: int, width: int = WIDTH, seed: int = SEED) -> Parameters:
    """Small random weights; f_ reads forwards, b_ backwards. e: what a byte adds to the gates, u: what
    the state adds."""
    rng, p = np.random.default_rng(seed), {}
    for d in "fb":
        p[f"{d}_e"] = rng.normal(0, 0.3, (256, 3 * width))
        p[f"{d}_u"] = rng.normal(0, width ** -0.5, (width, 3 * width))
    p["o"], p["c"] = rng.normal(0, width ** -0.5, (2 * width, languages)), np.zeros(languages)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _gate(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _read(p: Parameters, d: str, data: np.ndarray) -> tuple[np.ndarray, list]:
    """States after each byte, (steps, windows, width), in text order, and what backpropagation needs."""
    e, u = p[f"{d}_e"], p[f"{d}_u"]
    width, steps = u.shape[0], data.shape[0]
    h = np.zeros((data.shape[1], width), np.float32)
    states, kept = np.empty((steps, *h.shape), np.float32), []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        a, g = e[data[t]], h @ u
        zr = _gate(a[:, :2 * width] + g[:, :2 * width])
        z, r = zr[:, :width], zr[:, width:]
        n = np.tanh(a[:, 2 * width:] + r * g[:, 2 * width:])
        kept.append((t, h, z, r, n, g[:, 2 * width:]))
        h = n + z * (h - n)
        states[t] = h
    return states, kept


def _unread(p: Parameters, d: str, data: np.ndarray, kept: list, from_states: np.ndarray) -> Parameters:
    """Gradients of a direction's weights from those of its states."""
    u = p[f"{d}_u"]
    width, carry = u.shape[0], 0.0
    to_u, to_a = np.zeros_like(u), np.empty((*data.shape, 3 * width), np.float32)
    for t, h, z, r, n, g in reversed(kept):
        dh = from_states[t] + carry
        dn = dh * (1 - z) * (1 - n * n)
        dz, dr = dh * (h - n) * z * (1 - z), dn * g * r * (1 - r)
        to_a[t] = np.concatenate([dz, dr, dn], axis=1)
        dg = np.concatenate([dz, dr, dn * r], axis=1)
        to_u += h.T @ dg
        carry = dh * z + dg @ u.T
    flat, rows = data.ravel(), to_a.reshape(-1, 3 * width)
    to_e = np.stack([np.bincount(flat, rows[:, k], 256) for k in range(3 * width)], axis=1).astype(np.float32)
    return {f"{d}_e": to_e, f"{d}_u": to_u}


def _softmax(x: np.ndarray) -> np.ndarray:
    y = np.exp(x - x.max(axis=-1, keepdims=True))
    return y / y.sum(axis=-1, keepdims=True)


def gradients(p: Parameters, data: np.ndarray, used: np.ndarray, label: np.ndarray) -> tuple[float, Parameters]:
    """Mean cross-entropy over the used bytes, and its gradients. data, used: (steps, windows)."""
    (hf, kf), (hb, kb) = _read(p, "f", data), _read(p, "b", data)
    both = np.concatenate([hf, hb], axis=2)
    soft = _softmax(both @ p["o"] + p["c"])
    total = max(1.0, float(used.sum()))
    picked = soft[:, np.arange(len(label)), label]
    loss = -float((np.log(picked + 1e-9) * used).sum()) / total
    soft[:, np.arange(len(label)), label] -= 1
    soft *= (used / total)[:, :, None]
    out = {"o": np.einsum("twh,twl->hl", both, soft), "c": soft.sum(axis=(0, 1))}
    back, width = soft @ p["o"].T, hf.shape[2]
    return loss, out | _unread(p, "f", data, kf, back[:, :, :width]) | _unread(p, "b", data, kb, back[:, :, width:])


def train(data: np.ndarray, used: np.ndarray, label: np.ndarray, languages: int, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = SEED) -> Parameters:
    """Adam over shuffled batches of windows."""
    p, rng = start(languages, seed=seed), np.random.default_rng(seed)
    m, v, turn = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    updates = max(60, epochs * -(-data.shape[1] // BATCH))
    while turn < updates:
        order = rng.permutation(data.shape[1])
        for at in range(0, len(order), BATCH):
            turn += 1
            if turn > updates:
                break
            some = order[at:at + BATCH]
            _, g = gradients(p, data[:, some], used[:, some], label[some])
            step = rate * min(1.0, 2 * (1 - turn / (updates + 1)))
            for k in p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.01 * (g[k] ** 2 - v[k])
                p[k] -= (step * (m[k] / (1 - 0.9 ** turn)) / (np.sqrt(v[k] / (1 - 0.99 ** turn)) + 1e-8)).astype(np.float32)
    return p


class Labeller:
    """Trained weights, laid out for speed: gates are halved so that one tanh serves all of them."""

    def __init__(self, p: Parameters):
        self.width = p["f_u"].shape[0]
        w2 = 2 * self.width
        self.parts = {d: tuple(np.ascontiguousarray(x) for x in (
            0.5 * p[f"{d}_e"][:, :w2], p[f"{d}_e"][:, w2:], 0.5 * p[f"{d}_u"][:, :w2], p[f"{d}_u"][:, w2:])) for d in "fb"}
        self.out = {"f": np.ascontiguousarray(p["o"][:self.width]), "b": np.ascontiguousarray(p["o"][self.width:])}
        self.bias = p["c"]

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        """Of every byte of the windows, (steps, windows, languages)."""
        steps, n = data.shape
        logits = np.empty((steps, n, len(self.bias)), np.float32)
        logits[:] = self.bias
        w = self.width
        for d, times in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            e_zr, e_n, u_zr, u_n = self.parts[d]
            h = np.zeros((n, w), np.float32)
            zr, a = np.empty((n, 2 * w), np.float32), np.empty((n, w), np.float32)
            for t in times:
                np.take(e_zr, data[t], axis=0, out=zr, mode="clip")
                np.take(e_n, data[t], axis=0, out=a, mode="clip")
                zr += h @ u_zr
                np.tanh(zr, out=zr)
                zr *= 0.5
                zr += 0.5
                g = h @ u_n
                g *= zr[:, w:]
                a += g
                np.tanh(a, out=a)
                h -= a
                h *= zr[:, :w]
                h += a
                logits[t] += h @ self.out[d]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits

    def documents(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the mean probabilities and how many bytes are labelled with each language."""
        k = len(self.bias)
        mean, labelled = np.zeros((len(texts), k)), np.zeros((len(texts), k), np.int64)
        windows = [(i, at) for i, t in enumerate(texts) for at in range(0, len(t), STEPS)]
        for first in range(0, len(windows), BLOCK):
            some = windows[first:first + BLOCK]
            owner = np.fromiter((i for i, _ in some), np.int64, len(some))
            pieces = [texts[i][at:at + STEPS] for i, at in some]
            size = np.fromiter(map(len, pieces), np.int64, len(pieces))
            data = np.frombuffer(b"".join([x.ljust(STEPS, b"\0") for x in pieces]), np.uint8).reshape(len(pieces), STEPS)
            soft = self.probabilities(np.ascontiguousarray(data.T))
            used = np.arange(STEPS)[:, None] < size[None, :]
            soft *= used[:, :, None]
            best = soft.argmax(axis=2)
            total = soft.sum(axis=0, dtype=np.float64)
            for c in range(k):
                mean[:, c] += np.bincount(owner, total[:, c], len(texts))
                labelled[:, c] += np.bincount(owner, ((best == c) & used).sum(axis=0), len(texts)).astype(np.int64)
        length = np.fromiter(map(len, texts), np.float64, len(texts))
        return mean / np.maximum(length, 1)[:, None], labelled


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Training windows, at places that a hash of text and number picks."""
    for frame in frames:
        rows = []
        for key, text, lang in zip(frame["doc_id"], frame["text"], frame["lang"], strict=True):
            data = text.encode()
            for j in range(WINDOWS):
                at = xxhash.xxh64_intdigest(data, SEED + j) % max(1, len(data) - STEPS + 1)
                rows.append((key, j, lang, data[at:at + STEPS]))
        yield pd.DataFrame(rows, columns=["doc_id", "number", "lang", "window"])


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], Labeller | None]:
    """Languages and the network, from about ``sample`` documents with a language and a letter that lie
    outside the held-out fold."""
    known = docs.select("doc_id", "text", "lang").where(
        (fold(F.col("doc_id"), FOLDS) != HELD) & F.col("lang").isNotNull() & F.rlike("text", F.lit(r"\p{L}")))
    count = docs.where((fold(F.col("doc_id"), FOLDS) != HELD) & F.col("lang").isNotNull()).count()
    share = min(1.0, sample / max(1, count))
    rows = known.where(hash_below(F.col("doc_id"), SEED, share)).mapInPandas(
        _cut, "doc_id bigint, number int, lang string, window binary").orderBy(
        F.xxhash64("doc_id", F.lit(SEED)), "doc_id", "number", "window").limit(2 * sample * WINDOWS).toPandas()
    rows = rows.sort_values(["doc_id", "number", "window"], kind="stable")
    languages = sorted(rows["lang"].unique())
    if not languages:
        return [], None
    pieces = [bytes(x) for x in rows["window"]]
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    data = np.frombuffer(b"".join([x.ljust(STEPS, b"\0") for x in pieces]), np.uint8).reshape(-1, STEPS).T
    used = (np.arange(STEPS)[:, None] < size[None, :]).astype(np.float32)
    label = rows["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    return languages, Labeller(train(np.ascontiguousarray(data), used, label, len(languages)))


def _predictor(languages: list[str], network: Labeller | None):
    @F.pandas_udf("lang string, score double, bytes_labelled map<string,bigint>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        lettered = [t is not None and any(map(str.isalpha, t)) for t in texts]
        out = [(UNKNOWN, 0.0, {})] * len(texts)
        where = [i for i, ok in enumerate(lettered) if ok and network is not None]
        for at in range(0, len(where), 256):
            some = where[at:at + 256]
            mean, labelled = network.documents([texts.iloc[i].encode() for i in some])
            best = mean.argmax(axis=1)
            for i, b, row, n in zip(some, best.tolist(), mean, labelled, strict=True):
                out[i] = (languages[b], min(1.0, float(row[b])), dict(zip(languages, n.tolist(), strict=True)))
        return pd.DataFrame(out, columns=["lang", "score", "bytes_labelled"])
    return predict


def identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with _language (lang, score, bytes_labelled: bytes that bear each language); a column of this name is replaced.

    ``und`` with score 0 for a null text, one without a letter, or where no labelled document was at
    hand; equal probabilities go to the first language by name. Lang, source and ids are not read for
    a prediction; repeated rows are labelled alike; other columns pass through.
    """
    return docs.withColumn("_language", _predictor(*fit(docs, sample))(F.col("text")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identified(docs).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"),
        F.col("_language.lang").alias("lang_pred"), F.col("_language.score").alias("score"))
