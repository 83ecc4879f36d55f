"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

The classifier is fitted on at most about ``MAX_EXAMPLES`` labelled rows
(hash-sampled; the documented bound). Terms are words and word beginnings
(``^`` and 4 to 8 letters) whose presence is tied to the label: those with a
chi-square over these rows of at least ``MIN_CHI2``, on at least ``MIN_DOCS`` of
them (on fewer the test says nothing). Document frequencies are counted over all
texts. Examples with equal vectors are one entry with its counts of votes.

Entries are held in an inverted index whose postings are cut into blocks with
the largest weight of each term in each block; entries that share their
strongest terms stand together. A query visits blocks in waves by their upper
bound and stops when no block left can reach its ``K`` nearest votes, so the
neighbours are exactly the nearest by cosine, ties included. The share of
toxic votes, weighted by closeness, goes through an isotonic curve fitted on
the examples (each without its own vote) and gives the score; the nearest
examples' ids are the evidence.

Defined results: null, empty and term-free texts get the share of toxic rows
among term-free examples, without evidence; without any label the score is 0;
a document with several labels counts once with their maximum; equal texts get
equal scores.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import id_key, measured, saved
from .words import chunks, split_words

MIN_CHI2, MIN_DOCS = 25.0, 4
BEGINNINGS = (4, 5, 6, 7, 8)
MAX_EXAMPLES = 30_000
K, BLOCK, WAVE = 25, 64, 8
#: Distinct vectors scored by one task.
PER_TASK = 4_000
EDGE = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words without punctuation around them: distinct, occurrences, offsets."""
    found, codes, offsets = split_words(texts)
    bare = pc.dictionary_encode(pc.ascii_trim(found, characters=EDGE))
    return bare.dictionary, bare.indices.to_numpy(zero_copy_only=False)[codes], offsets


def terms_of(words: pa.Array) -> list[pa.Array]:
    """Aligned with the words: the word itself, then its beginnings, null where it is no longer."""
    out, size = [words], pc.utf8_length(words)
    for k in BEGINNINGS:
        mark, join = pa.scalar("^", words.type), pa.scalar("", words.type)
        begin = pc.binary_join_element_wise(mark, pc.utf8_slice_codeunits(words, 0, k), join)
        out.append(pc.if_else(pc.greater(size, k), begin, pa.scalar(None, begin.type)))
    return out


def label_counts(docs: DataFrame) -> DataFrame:
    """(term, docs, toxic) over rows (text, y): in how many texts each word occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 0):
                words, codes, offsets = words_of(part.column(0))
                y = part.column(1).to_numpy(zero_copy_only=False)
                coded = pc.dictionary_encode(pa.concat_arrays(terms_of(words)))
                place = pc.fill_null(coded.indices, len(coded.dictionary)).to_numpy(
                    zero_copy_only=False).reshape(-1, len(words))
                n = np.zeros((2, len(coded.dictionary) + 1), dtype=np.int64)
                for i in range(len(y)):
                    own = np.unique(place[:, np.unique(codes[offsets[i]:offsets[i + 1]])])
                    n[0, own] += 1
                    n[1, own] += y[i]
                yield pa.RecordBatch.from_arrays(
                    [coded.dictionary, pa.array(n[0, :-1]), pa.array(n[1, :-1])],
                    names=["term", "docs", "toxic"])

    return (docs.mapInArrow(run, "term string, docs long, toxic long").where("term <> ''")
            .groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic")))


def choose_terms(counts: DataFrame, rows: int, toxic: int) -> list[str]:
    """The words tied to the label by chi-square; as many as the sample's rows hold."""
    a, n = F.col("toxic").cast("double"), F.col("docs").cast("double")
    miss, other = F.lit(float(toxic)) - a, F.lit(float(rows - toxic)) - (n - a)
    cross = a * other - (n - a) * miss
    chi2 = float(rows) * cross * cross / (
        n * (F.lit(float(rows)) - n) * F.lit(float(toxic) * float(rows - toxic)))
    tied = counts.where((n >= MIN_DOCS) & (n < rows)).where(chi2 >= MIN_CHI2)
    return sorted(r["term"] for r in tied.select("term").collect())


def vectors(docs: DataFrame, doc_id: str, text: str, terms: list[str]) -> DataFrame:
    """Stored (doc_id, key, t, c): the chosen terms of each text by place, their
    counts, and a 128-bit hash of both."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                words, codes, offsets = words_of(part.column(1))
                chosen = pa.array(terms, words.type)
                place = np.stack([pc.fill_null(pc.index_in(t, value_set=chosen), -1).to_numpy(
                    zero_copy_only=False) for t in terms_of(words)])
                told = (place >= 0).any(axis=0)[codes]
                at, cs, keys = [], [], []
                for i in range(part.num_rows):
                    own = codes[offsets[i]:offsets[i + 1]]
                    own = place[:, own[told[offsets[i]:offsets[i + 1]]]]
                    t, c = np.unique(own[own >= 0], return_counts=True)
                    at.append(t)
                    cs.append(c)
                    keys.append(hashlib.blake2b(np.concatenate([t, c]).astype("<i8").tobytes(),
                                                digest_size=16).digest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(keys, pa.binary()), pa.array(at, pa.list_(pa.int32())),
                     pa.array(cs, pa.list_(pa.int32()))], names=["doc_id", "key", "t", "c"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return saved(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
                 .mapInArrow(run, f"doc_id {kind}, key binary, t array<int>, c array<int>"), "term-vectors")


class BlockMaxIndex:
    """Entries with unit vectors and votes, searched exactly by block upper bounds."""

    def __init__(self, entries: list[tuple], idf: np.ndarray):
        """entries: (terms, counts, votes, toxic votes, ids of some examples)."""
        self.idf = idf
        # entries with the same strongest terms stand together, so a block's bounds are tight
        rows = sorted(((tuple(t), tuple(c), n, y, tuple(ids)) for t, c, n, y, ids in entries),
                      key=lambda r: ([r[0][i] for i in np.argsort(-self.unit(*r[:2]), kind="stable")], r))
        self.keys = {(r[0], r[1]): i for i, r in enumerate(rows)}
        self.votes = np.array([r[2] for r in rows], dtype=float)
        self.toxic = np.array([r[3] for r in rows], dtype=float)
        self.ids = [r[4] for r in rows]
        self.blocks = -(-len(rows) // BLOCK)
        at = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        ts = np.array([t for r in rows for t in r[0]], dtype=np.int64)
        ws = np.concatenate([self.unit(r[0], r[1]) for r in rows]) if rows else np.zeros(0)
        order = np.lexsort((at, ts))
        #: Postings by term, then entry; ``cuts[t, b]`` is where term t's block b begins.
        self.at, self.ws = at[order].astype(np.int32), ws[order]
        cell = ts[order] * self.blocks + self.at // BLOCK
        size = len(idf) * self.blocks
        self.cuts = np.searchsorted(cell, np.arange(size + 1)).astype(np.int32)
        self.peaks = np.zeros(size)
        np.maximum.at(self.peaks, cell, self.ws)
        self.peaks = self.peaks.reshape(len(idf), self.blocks)

    def unit(self, t, c) -> np.ndarray:
        w = (1 + np.log(np.asarray(c, dtype=float))) * self.idf[list(t)]
        return w / np.sqrt(w @ w)

    def cosines(self, t: np.ndarray, w: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The cosine of every entry of the blocks with a query, 0 for other entries."""
        cell = (t[:, None] * self.blocks + blocks).ravel()
        low = self.cuts[cell].astype(np.int64)
        n = self.cuts[cell + 1] - low
        place = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        parts = np.repeat(np.repeat(w, len(blocks)), n) * self.ws[place]
        return np.bincount(self.at[place], parts, len(self.votes)).round(12)

    def nearest(self, t, c, own: int = -1, k: int = K) -> list[tuple[float, int, float]]:
        """(cosine, entry, votes) of the nearest entries holding at least k votes, ties included.

        Blocks are visited by their bounds, each wave WAVE times the last one's
        number, until none left can hold an entry as near as the k-th vote.
        ``own``: an entry that lends one vote less.
        """
        t, w = np.asarray(t, dtype=np.int64), self.unit(t, c)
        bound = w @ self.peaks[t]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        found, cos, votes = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        least, done, step = 0.0, 0, WAVE
        while done < len(order):
            wave = order[done:done + step]
            wave = wave[bound[wave] >= least - 1e-9]
            if not len(wave):
                break
            near = self.cosines(t, w, wave)
            more = np.flatnonzero((near > 0) & (near >= least))
            lent = self.votes[more] - (more == own)
            more, lent = more[lent > 0], lent[lent > 0]
            found, cos = np.concatenate([found, more]), np.concatenate([cos, near[more]])
            votes = np.concatenate([votes, lent])
            rank = np.lexsort((found, -cos))
            found, cos, votes = found[rank], cos[rank], votes[rank]
            reached = int(np.searchsorted(np.cumsum(votes), k))
            if reached < len(found):
                least = cos[reached]
                kept = int(np.searchsorted(-cos, -least, side="right"))
                found, cos, votes = found[:kept], cos[:kept], votes[:kept]
            done, step = done + step, step * WAVE
        return list(zip(cos.tolist(), found.tolist(), votes.tolist()))

    def vote(self, near: list[tuple], own: int = -1, own_toxic: float = 0.0) -> float:
        """The weighted share of toxic votes among ``near``; the overall share if none is near."""
        up, down = 0.0, 0.0
        for cos, e, n in near:
            w = 1 / (1.05 - min(cos, 1.0))
            up += w * (self.toxic[e] - (own_toxic if e == own else 0.0))
            down += w * n
        return up / down if down else float(self.toxic.sum() / max(self.votes.sum(), 1))


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit by pooling neighbours: block means of x and y."""
    stack: list[list[float]] = []
    for a, b, n in sorted(zip(x, y, w)):
        stack.append([a * n, b * n, n])
        while len(stack) > 1 and stack[-2][1] * stack[-1][2] >= stack[-1][1] * stack[-2][2]:
            last = stack.pop()
            stack[-1] = [p + q for p, q in zip(stack[-1], last)]
    s = np.array(stack)
    return s[:, 0] / s[:, 2], s[:, 1] / s[:, 2]


def document_counts(stored: DataFrame) -> DataFrame:
    """(t, n): how many vectors hold each term; a task counts its own and returns a row a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            held = np.bincount(np.asarray(batch.column(0).flatten(), np.int64), minlength=len(counts))
            held[:len(counts)] += counts
            counts = held
        t = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(counts[t], pa.int64())], names=["t", "n"])

    return stored.select("t").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str
          ) -> tuple[DataFrame, dict | None]:
    """The texts' vectors and a model from the labelled rows."""
    known = saved(labels.where(F.col(label).isNotNull())
                  .groupBy(id_key(F.col("doc_id")).alias("l_id"))
                  .agg(F.max(label).cast("int").alias("y")), "toxic-labels")
    n = known.count()
    place = F.shiftrightunsigned(F.xxhash64(F.lit("toxic"), F.col("l_id")), 11) / float(2 ** 53)
    sample = saved(known.where(place < F.lit(MAX_EXAMPLES / max(n, 1))), "toxic-sample")
    labelled = docs.join(measured(sample), id_key(F.col(doc_id)) == F.col("l_id"))
    total = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).first()
    rows, toxic = total["n"], total["y"] or 0
    terms = choose_terms(label_counts(labelled.select(text, "y")), rows, toxic) if (
        0 < toxic < rows) else []
    stored = vectors(docs, doc_id, text, terms)
    if not rows:
        return stored, None
    df = np.zeros(len(terms) + 1)
    for r in document_counts(stored).collect():
        df[r["t"]] = r["n"]  # one row a term
    idf = np.log((1 + stored.count()) / (1 + df)) + 1
    examples = (stored.join(measured(sample), id_key(F.col("doc_id")) == F.col("l_id"))
                .groupBy("t", "c").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"),
                                       F.min("doc_id").alias("one")).collect())  # <= MAX_EXAMPLES
    bare = [(r["n"], r["y"]) for r in examples if not r["t"]]
    prior = toxic / rows
    n0, y0 = bare[0] if bare else (0, 0)
    index = BlockMaxIndex([(r["t"], r["c"], r["n"], r["y"], [r["one"]]) for r in examples if r["t"]], idf)
    curve = calibration(docs.sparkSession, index, prior)
    return stored, {"index": index, "curve": curve, "bare": (y0 + prior) / (n0 + 1)}


def calibration(spark: SparkSession, index: BlockMaxIndex, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """The isotonic curve over the entries' votes, each example without its own."""
    if not index.keys:
        return np.zeros(1), np.array([prior])
    shared = spark.sparkContext.broadcast(index)  # at most MAX_EXAMPLES entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        keys = list(own.keys)
        for batch in batches:
            out = []
            for e in batch.column(0).to_pylist():
                near = own.nearest(*keys[e], own=e)
                out += [(own.vote(near, e, y), y, n) for y, n in (
                    (1.0, own.toxic[e]), (0.0, own.votes[e] - own.toxic[e])) if n]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.float64()) for v in zip(*out)], names=["x", "y", "n"])

    entries = spark.range(0, len(index.keys), 1, -(-len(index.keys) // PER_TASK))
    points = entries.mapInArrow(run, "x double, y double, n double").toPandas()  # two an entry at most
    return isotonic(*points.to_numpy().T)


def score(docs: DataFrame, labels: DataFrame, train_on: Column, label: str = "toxic",
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, evidence) of every row, from labels of rows where ``train_on`` holds.

    Each distinct vector is searched once, in tasks of some PER_TASK vectors
    that begin with the same terms; texts without terms need no search.
    """
    stored, model = train(docs, labels.where(train_on), label, doc_id, text)
    kind = stored.schema["doc_id"].dataType.simpleString()
    bare = stored.where(F.size("t") == 0) if model else stored
    bare = bare.select("doc_id", F.lit(float(model["bare"]) if model else 0.0).alias("score"),
                         F.array().cast(f"array<{kind}>").alias("evidence"))
    if model is None:
        return bare
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_EXAMPLES entries
    told = F.size("t") > 0
    id_type = to_arrow_type(stored.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, (x, y) = shared.value["index"], shared.value["curve"]
        ids = pa.list_(id_type)
        for batch in batches:
            scores, evidence = [], []
            for t, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                near = index.nearest(t, c)
                scores.append(float(np.interp(index.vote(near), x, y)))
                evidence.append([i for _, e, _ in near[:3] for i in index.ids[e]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, ids)],
                names=["key", "score", "evidence"])

    distinct = saved(stored.where(told).select("key", "t", "c").dropDuplicates(["key"]), "distinct-vectors")
    tasks = -(-distinct.count() // PER_TASK) or 1
    scored = saved(distinct.repartitionByRange(tasks, "t", "c").mapInArrow(
        run, f"key binary, score double, evidence array<{kind}>"), "scored-vectors")
    rows = stored.where(told).select("doc_id", "key").join(
        measured(scored.withColumnRenamed("key", "__key")), F.col("key") == F.col("__key"))
    return rows.select("doc_id", "score", "evidence").union(bare)
