"""Language identification by sparse multinomial logistic regression.

Features are hashed character 1- to 3-grams of lower-cased letters (a gram may
begin or end at a word's edge), with sublinear tf-idf weights of unit length.
Document frequencies are counted over all training rows. The weights are
learned with follow-the-regularised-leader under an elastic net from at most
about ``PER_LANGUAGE`` rows a language (hash-sampled, the documented bound),
in one task of bounded size; a fifth of that sample is kept apart to fit the
temperature that calibrates the scores. Every text is scored whole.

Defined results: null texts and texts without a letter give ``und`` with score
0; so does everything if there is no training row; rows with a null language
are scored but not learned from; equal texts get equal results; an empty table
gives no rows; language, source and id are never inputs of a prediction.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .words import chunks, mix

BITS = 17
ORDERS = 3
PER_LANGUAGE = 2000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-3, 1e-3
UNKNOWN = "und"
#: Text bytes handled at once; arrays of code points take some thirty times that.
PORTION = 2 << 20

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point its lower-case letter's code point, 0 for what is no letter."""
    if not _LETTERS:
        table = np.zeros(0x110000, dtype=np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if unicodedata.category(c)[0] == "L":
                table[i] = ord(c.lower()[0])
        _LETTERS.append(table)
    return _LETTERS[0]


def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its gram buckets and their counts; empty if it has no letter."""
    blob = "\n" + "\n".join(texts.to_pylist())
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    first = np.concatenate([[0], np.cumsum(sizes)])
    code = letters()[np.frombuffer(blob.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    keep = code > 0
    keep[1:] |= code[:-1] > 0  # of a run of separators the first stays,
    keep[first[:-1]] = True  # and each text's own
    first = np.concatenate([[0], np.cumsum(keep)])[first]
    code = np.concatenate([code[keep], np.zeros(ORDERS, dtype=np.uint32)]).astype(np.uint64)
    n = len(code) - ORDERS
    buckets, bounds = [], []
    for order in range(1, ORDERS + 1):
        value = np.full(n, np.uint64(order))
        fine = np.ones(n, dtype=bool)
        any_letter = np.zeros(n, dtype=bool)
        for j in range(order):
            c = code[j:j + n]
            value = value * np.uint64(0x110000) + c
            any_letter |= c > 0
            if 0 < j < order - 1:
                fine &= c > 0
        fine &= any_letter
        at = np.flatnonzero(fine)
        buckets.append((mix(value[at]) >> np.uint64(64 - BITS)).astype(np.int32))
        bounds.append(np.searchsorted(at, first))
    for i in range(len(sizes)):
        own = np.concatenate([b[e[i]:e[i + 1]] for b, e in zip(buckets, bounds)])
        if len(own) < 4000:
            yield np.unique(own, return_counts=True)
        else:
            counts = np.bincount(own, minlength=1 << BITS)
            found = np.flatnonzero(counts)
            yield found, counts[found]


def weighted(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[buckets]
    norm = np.sqrt(x @ x)
    return (x / norm if norm else x).astype(np.float32)


def document_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << BITS, dtype=np.int64), 0
        for batch in batches:
            for part in chunks(batch, 0, PORTION):
                for buckets, _ in grams(part.column(0)):
                    df[buckets] += 1
                    n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()),
                                          pa.array(np.append(df[at], n), pa.int64())],
                                         names=["bucket", "n"])

    counts = (docs.select(text).mapInArrow(run, "bucket int, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas())  # <= 2^BITS + 1 rows
    total = counts.loc[counts.bucket < 0, "n"].sum()
    counts = counts[counts.bucket >= 0]
    out = np.zeros(1 << BITS)
    out[counts.bucket.to_numpy()] = counts.n.to_numpy()
    return out, int(total)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int
         ) -> tuple[np.ndarray, np.ndarray]:
    """Weights (bucket x class) and biases learned one row at a time."""
    z = np.zeros((1 << BITS, classes))
    n = np.zeros_like(z)
    zb, nb = np.zeros(classes), np.zeros(classes)
    one = np.eye(classes)

    def now(z: np.ndarray, n: np.ndarray, l1: float, l2: float) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0,
                        -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + l2))

    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at, x = rows[i]
            w, b = now(z[at], n[at], L1, L2), now(zb, nb, 0, 0)
            score = x @ w + b
            p = np.exp(score - score.max())
            d = p / p.sum() - one[labels[i]]
            g = x[:, None] * d
            s = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - s * w
            n[at] += g * g
            sb = (np.sqrt(nb + d * d) - np.sqrt(nb)) / ALPHA
            zb += d - sb * b
            nb += d * d
    return now(z, n, L1, L2).astype(np.float32), now(zb, nb, 0, 0)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least log loss, by golden section on its log."""
    def loss(log_t: float) -> float:
        s = scores / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), labels]).mean())

    low, high, r = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - r * (high - low), low + r * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, lang: str, text: str, key: str) -> dict | None:
    """A model from the rows of ``docs`` with a language; None if there is none."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[lang]: r["n"] for r in rows.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    classes = sorted(sizes)
    df, total = document_frequencies(rows, text)
    idf = np.log((1 + total) / (1 + df)) + 1
    place = F.xxhash64(F.lit("langid"), F.col(key))
    share = (F.shiftrightunsigned(place, 11).cast("double") / float(2 ** 53))
    rate = F.element_at(F.create_map(*[x for c in classes for x in (
        F.lit(c), F.lit(PER_LANGUAGE / sizes[c]))]), F.col(lang))
    sample = rows.where(share < rate).select(
        F.array_position(F.array(*map(F.lit, classes)), F.col(lang)).cast("int").alias("label"),
        place.alias("place"), F.col(text).alias("text"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 2, PORTION):
                pairs = [(a, weighted(a, c, idf)) for a, c in grams(part.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([a.astype("<i4").tobytes() for a, _ in pairs], pa.binary()),
                     pa.array([x.astype("<f4").tobytes() for _, x in pairs], pa.binary())],
                    names=["label", "place", "at", "x"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "label"], kind="stable").reset_index(drop=True)
        data = [(np.frombuffer(a, "<i4"), np.frombuffer(x, "<f4")) for a, x in zip(pdf["at"], pdf["x"])]
        labels = pdf["label"].to_numpy() - 1
        kept = np.arange(len(data)) % 5 == 4
        train_at = np.flatnonzero(~kept)
        w, b = ftrl([data[i] for i in train_at], labels[train_at], len(classes))
        t = 1.0
        if kept.any() and len(classes) > 1:
            scores = np.stack([data[i][1] @ w[data[i][0]] + b for i in np.flatnonzero(kept)])
            t = temperature(scores, labels[kept])
        return pd.DataFrame({"w": [w.tobytes()], "b": [b.tobytes()], "t": [t]})

    features = saved(sample.mapInArrow(featurise, "label int, place long, at binary, x binary"),
                     "langid-sample")
    got = features.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(fit, "w binary, b binary, t double").first()
    if got is None:
        return None
    return {"classes": classes, "idf": idf, "t": got["t"], "b": np.frombuffer(got["b"]),
            "w": np.frombuffer(got["w"], dtype=np.float32).reshape(1 << BITS, len(classes))}


def predict(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    names = docs.drop("lang_pred", "score").columns
    rows = docs.select(*names, F.col(text).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in chunks(batch, len(names), PORTION):
                langs, scores = [], []
                for buckets, counts in grams(part.column(len(names))):
                    if m is None or not len(buckets):
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    s = (weighted(buckets, counts, m["idf"]) @ m["w"][buckets] + m["b"]) / m["t"]
                    p = np.exp(s - s.max())
                    best = int(p.argmax())
                    langs.append(m["classes"][best])
                    scores.append(float(p[best] / p.sum()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(names)], pa.array(langs, pa.string()),
                     pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields}, lang_pred string, score double")


def identify(docs: DataFrame, train_on: Column, lang: str = "lang", text: str = "text",
             key: str = "doc_id") -> DataFrame:
    """Learn from the rows where ``train_on`` holds, then predict every row."""
    return predict(docs, train(docs.where(train_on), lang, text, key), text)
