"""Quality scores by a generalised additive model with pairwise interactions.

Each feature of a text is cut into quantile bins. Boosting goes round the
features in turn; at each, a shallow tree on that one feature (up to four
leaves) is fitted to the current residuals, and its small step is added to the
feature's lookup table. Afterwards the pairs of features that best explain
what is left get tables of two features, boosted in turn the same way. A
score is the logistic function of the sum of table entries, so it is vectorised
lookups and additions and every part of it can be read off.

Features of all texts are computed once and stored. The tables are learned in
one task from at most about ``MAX_ROWS`` labelled rows (hash-sampled; the
documented bound), whose features alone it reads.

Defined results: null and empty texts have the features of an empty text and
get a score; rows without label are scored but not learned from; a document
with several labels counts once with their maximum; without any label of
either kind scores are 0.5; equal texts get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_key, saved
from .words import chunks, split_words

MAX_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 64, 12, 6
ROUNDS, RATE = 120, 0.15

#: Share of a text's bytes that fall in each class.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#$%&*@^~+=<>\\/{}[]_",
    "bar": b"|", "shout": b"!?", "stop": b".,;:", "space": b" \t\r", "line": b"\n"}
FEATURES = ["log_bytes", "log_words", "word_bytes", "distinct", "common_word", "other_bytes", *CLASSES]


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES a text."""
    blob = np.frombuffer(("\n" + "\n".join(texts.to_pylist())).encode("utf-8", "surrogatepass"), np.uint8)
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    out = np.zeros((len(size), len(FEATURES)))
    some = np.maximum(size, 1)
    for k, name in enumerate(CLASSES):
        table = np.zeros(256, dtype=np.uint8)
        table[list(CLASSES[name])] = 1
        count = np.add.reduceat(table[blob], first, dtype=np.int64) - (name == "line")
        out[:, 6 + k] = count / some
    out[:, 5] = np.add.reduceat((blob > 127).astype(np.uint8), first, dtype=np.int64) / some
    _, codes, offsets = split_words(texts)
    n = np.diff(offsets)
    for i in np.flatnonzero(n):
        counts = np.unique(codes[offsets[i]:offsets[i + 1]], return_counts=True)[1]
        out[i, 3] = len(counts) / n[i]
        out[i, 4] = counts.max() / n[i]
    out[:, 0], out[:, 1], out[:, 2] = np.log1p(size), np.log1p(n), size / np.maximum(n, 1)
    return out


def featurise(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                x = features(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.FixedSizeListArray.from_arrays(
                        pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))],
                    names=["doc_id", "x"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return saved(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
                 .mapInArrow(run, f"doc_id {kind}, x array<double>"), "features")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _cut(grad: np.ndarray, weight: np.ndarray, low: int, high: int) -> tuple[float, int]:
    """The best place to split bins [low, high) and its gain; (0, low) for none."""
    if high - low < 2:
        return 0.0, low
    g, w = np.cumsum(grad[low:high]), np.cumsum(weight[low:high])
    left, right, gr = w[:-1], w[-1] - w[:-1], g[-1] - g[:-1]
    gain = g[:-1] ** 2 / (left + 1) + gr ** 2 / (right + 1) - g[-1] ** 2 / (w[-1] + 1)
    gain = np.where((left < 1) | (right < 1), 0.0, gain)
    best = int(gain.argmax())
    return (float(gain[best]), low + best + 1) if gain[best] > 1e-9 else (0.0, low)


def tree(grad: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A step for each bin: a tree of two levels over the order of the bins."""
    n, out = len(grad), np.zeros(len(grad))
    gain, root = _cut(grad, weight, 0, n)
    halves = [(0, root), (root, n)] if gain else [(0, n)]
    for low, high in halves:
        gain, at = _cut(grad, weight, low, high)
        for a, b in ([(low, at), (at, high)] if gain else [(low, high)]):
            out[a:b] = grad[a:b].sum() / (weight[a:b].sum() + 1)
    return out


def pair_tree(grad: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A step for each cell: the cut of the first feature whose halves gain most by a cut of the second."""
    def halves(root: int) -> list[tuple[int, int, float, int]]:
        return [(low, high, *_cut(grad[low:high].sum(axis=0), weight[low:high].sum(axis=0), 0, grad.shape[1]))
                for low, high in ((0, root), (root, len(grad))) if high > low]

    best = max((halves(root) for root in range(1, max(2, len(grad)))), key=lambda h: sum(x[2] for x in h))
    out = np.zeros_like(grad)
    for low, high, gain, at in best:
        for a, b in ([(0, at), (at, grad.shape[1])] if gain else [(0, grad.shape[1])]):
            out[low:high, a:b] = grad[low:high, a:b].sum() / (weight[low:high, a:b].sum() + 1)
    return out, sum(x[2] for x in best)


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Bin edges, tables and pair tables for labels 0/1."""
    quantiles = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(quantiles, x.T)])
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(y), base)
    tables = [np.zeros(len(e) + 1) for e in quantiles]
    for _ in range(ROUNDS):
        for f, t in enumerate(tables):
            p = sigmoid(score)
            step = RATE * tree(np.bincount(bins[f], y - p, len(t)),
                               np.bincount(bins[f], p * (1 - p), len(t)))
            t += step
            score += step[bins[f]]
    coarse = [np.unique(np.quantile(c, np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) for c in x.T]
    cells = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(coarse, x.T)])

    def step2(a: int, b: int) -> tuple[np.ndarray, float]:
        na, nb = len(coarse[a]) + 1, len(coarse[b]) + 1
        p, at = sigmoid(score), cells[a] * nb + cells[b]
        return pair_tree(np.bincount(at, y - p, na * nb).reshape(na, nb),
                         np.bincount(at, p * (1 - p), na * nb).reshape(na, nb))

    gains = sorted(((step2(a, b)[1], a, b) for a in range(len(tables)) for b in range(len(tables))
                    if a != b), key=lambda g: (-g[0], g[1], g[2]))
    chosen = list(dict.fromkeys((min(a, b), max(a, b)) for g, a, b in gains if g > 0))[:PAIRS]
    pairs = {k: np.zeros((len(coarse[k[0]]) + 1, len(coarse[k[1]]) + 1)) for k in chosen}
    for _ in range(ROUNDS // 4):
        for (a, b), t in pairs.items():
            step = RATE * step2(a, b)[0]
            t += step
            score += step[cells[a], cells[b]]
    return {"base": base, "edges": quantiles, "tables": tables, "coarse": coarse, "pairs": pairs}


def additive(model: dict, x: np.ndarray) -> np.ndarray:
    total = np.full(len(x), model["base"])
    for e, t, c in zip(model["edges"], model["tables"], x.T):
        total += t[np.searchsorted(e, c, side="left")]
    for (a, b), t in model["pairs"].items():
        total += t[np.searchsorted(model["coarse"][a], x[:, a], side="left"),
                   np.searchsorted(model["coarse"][b], x[:, b], side="left")]
    return sigmoid(total)


def train(stored: DataFrame, labels: DataFrame, label: str) -> dict | None:
    """Learn from stored features whose ids have a label in ``labels`` (doc_id, label)."""
    known = (labels.where(F.col(label).isNotNull()).groupBy(id_key(F.col("doc_id")).alias("l_id"))
             .agg(F.max(label).cast("int").alias("y")))
    n = known.count()
    if not n:
        return None
    place = F.shiftrightunsigned(F.xxhash64(F.lit("gam"), F.col("l_id")), 11) / float(2 ** 53)
    sample = saved(known.where(place < F.lit(MAX_ROWS / n)), "gam-labels")
    rows = stored.join(sample, id_key(F.col("doc_id")) == F.col("l_id")).dropDuplicates(["l_id"])

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        import pickle
        pdf = pdf.sort_values("l_id")
        return pd.DataFrame({"model": [pickle.dumps(fit(np.stack(pdf["x"].to_numpy()),
                                                        pdf["y"].to_numpy(dtype=float)))]})

    got = (rows.select("l_id", "x", "y", F.lit(0).alias("one")).groupBy("one")
           .applyInPandas(learn, "model binary").first())
    if got is None:
        return None
    import pickle
    return pickle.loads(bytes(got["model"]))


def score(docs: DataFrame, labels: DataFrame, train_on: Column, label: str = "quality",
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row, from labels of rows of ``labels`` where ``train_on`` holds."""
    stored = featurise(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast(train(stored, labels.where(train_on), label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            s = np.full(len(x), 0.5) if shared.value is None else additive(shared.value, x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=["doc_id", "score"])

    kind = stored.schema["doc_id"].dataType.simpleString()
    return stored.mapInArrow(run, f"doc_id {kind}, score double")
