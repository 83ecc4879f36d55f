"""Source divergence, whitening and license scans: queries, brute force and edge rows."""
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chartlake.llm import divergence, licenses, queries, whitening

MID = "/root/testdata/sf0.01"


# --- source divergence --------------------------------------------------------

def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def divergence_of(rows, min_docs, top):
    """The audit of (lang, source, text) rows, in whole numbers."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text)))
            for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, terms in mine for t in set(terms))
        kept = [t for t, n in seen.items() if n >= min_docs]
        counts = {None: Counter()} | {s: Counter() for _, s, _ in mine}
        for _, source, terms in mine:
            for t in terms:
                if seen[t] >= min_docs:
                    counts[source][t] += 1
                    counts[None][t] += 1
        p = {s: {t: 1 + 10 ** 9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
             for s, c in counts.items()}
        for s in set(counts) - {None}:
            parts = {"pair": [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in set(counts) - {s, None}],
                     "term": [(t, p[s][t] - p[None][t]) for t in kept if counts[s][t] and p[s][t] > p[None][t]]}
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(found, 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, value, rank))
    return out


def test_divergence_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{MID}/documents.parquet'")
    got = queries.op11_divergence(spark, MID)
    want = con.sql(queries.ORACLE["op11_divergence"])
    assert got.columns == want.columns
    assert {tuple(r) for r in got.collect()} == set(want.fetchall())


@pytest.mark.parametrize("how", [{}, {"tile": 1, "entries": 1}, {"tile": 2, "entries": 7}])
def test_divergence_of_edge_rows(spark, edges, how):
    rows = [(r.lang, r.source, r.text) for r in edges.collect()]
    got = divergence.audit(edges, min_docs=2, top=3, **how).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == divergence_of(rows, 2, 3)
    bare = {tuple(r) for r in divergence.audit(edges, min_docs=99).collect()}
    assert bare == divergence_of(rows, 99, 50) and {r[4] for r in bare} == {0}


def test_divergence_of_an_empty_table(spark, empty):
    assert divergence.audit(empty).isEmpty()


def test_runs_cover_the_vocabulary_and_merge_equal_counts(spark, edges):
    rows = [(r.lang, r.source, r.text) for r in edges.collect()]
    kept, groups = divergence.counts_of(edges, F.col("lang"), F.col("source"), F.col("text"), 1)
    runs = divergence.runs_of(kept, groups, entries=50).collect()
    size = Counter()
    for r in runs:
        if r.number is None:
            size[r.lang] += sum(r.lengths)
    terms = defaultdict(set)
    for lang, _, text in rows:
        terms[lang or ""].update(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text)))
    assert size == {lang: len(t) for lang, t in terms.items() if t}
    for r in runs:
        assert all(a != b for a, b in zip(r.counts, r.counts[1:])) and all(r.lengths)
    assert len({(r.lang, r.block) for r in runs}) == sum(r.number is None for r in runs)


def test_intersect():
    a, b = np.array([3, 4, 10]), np.array([4, 9, 10])
    assert divergence.intersect(a, np.array([1, 5, 2]), b, np.array([2, 2, 7])) == 3 + 3 + 0 + 5


def test_shares_stay_exact_beyond_64_bits(spark):
    n, total, terms = 123_456_789_012, 987_654_321_098_765, 10_000_019
    got = spark.range(1).select(F.expr(divergence.share(f"{n}L", f"{total}L", f"{terms}L"))).first()[0]
    assert got == 1 + 10 ** 9 * (n + 5) // (total + 5 * terms)


# --- whitening ----------------------------------------------------------------

def whitened(rows):
    x = np.floor(64 * np.array(rows, float)).astype(int) + 1_000_000
    v = np.cov(x.T.astype(np.longdouble), bias=True).astype(float)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    return x, e, (x - x.mean(axis=0)) @ q / np.sqrt(e)


def test_whitening(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{MID}/embeddings.parquet'").fetchall()
    x, e, w = whitened([r[1] for r in rows])
    out = queries.op12_whitening(spark, MID).toPandas()
    assert len(out) == 32 * len(rows) and set(out.n) == {len(rows)}
    got = out.pivot(index="vec_id", columns="component", values="whitened").loc[[r[0] for r in rows]].to_numpy()
    sign = np.sign((got * w[:, :32]).sum(axis=0))
    assert np.abs(got - sign * w[:, :32]).max() < 1e-9
    far = [sum((len(x) * int(a) - int(s)) ** 2 for a, s in zip(row, x.sum(axis=0))) for row in x]
    one = out[out.component == 1].set_index("vec_id").loc[[r[0] for r in rows]]
    assert one.deviation.tolist() == far
    explained = out.groupby("component").explained.first().to_numpy()
    assert np.allclose(explained, e[:32] / e.sum(), rtol=1e-9)
    assert out.identity_error.nunique() == 1 and out.identity_error[0] < 1e-9


def test_whitening_of_edge_rows(spark):
    nan, inf = math.nan, math.inf
    good = [(0, [1.0, 0.0, 2.0]), (0, [1.0, 0.0, 2.0]), (None, [3.0, 4.0, 2.0]), (7, [-1.0, 2.5, 2.0]), (8, [5.0])]
    bad = [(1, None), (2, [nan, 1.0, 1.0]), (3, [inf, 1.0, 1.0]), (4, [None, 1.0, 1.0]), (5, [-inf, 0.0, 0.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("n", F.lit(-1))
    out = whitening.whiten(df).toPandas()
    assert len(out) == 3 * len(good) and set(out.n) == {len(good)}
    x, e, w = whitened([v + [0.0] * (3 - len(v)) for _, v in good])
    got = out[out.vec_id == 7].sort_values("component").whitened.to_numpy()
    assert np.abs(np.abs(got) - np.abs(w[3])).max() < 1e-9
    assert whitening.whiten(df.limit(0)).isEmpty() and whitening.whiten(df.where("vec_id = 1")).isEmpty()
    flat = whitening.whiten(df.where("vec_id = 0")).toPandas()
    assert len(flat) == 6 and flat.whitened.isna().all() and set(flat.deviation) == {0} and set(flat.explained) == {0}
    with pytest.raises(Exception, match="entry"):
        whitening.whiten(spark.createDataFrame([(1, [1e300]), (2, [0.0])], "vec_id long, embedding array<double>"))


def test_exact_distances_near_the_limit():
    x = np.array([[10 ** 9 + 1_000_000], [1_000_000]])
    centre = whitening.Centre(2, x.sum(axis=0))
    assert centre.deviation(x).tolist() == [10 ** 18, 10 ** 18]
    wide = whitening.Centre(2, x.sum(axis=0) * 4)
    with pytest.raises(OverflowError):
        wide.deviation(x * 4 + np.array([[0], [1]]))


CLUSTERS = [np.arange(1, 65.0), np.r_[np.ones(10), 1 + 1e-9 * np.arange(10), 2 + 1e-13 * np.arange(5), np.arange(3, 9)],
            np.ones(8), np.r_[np.zeros(5), 1, 2, 3], 10.0 ** -np.arange(20)]


@pytest.mark.parametrize("values", CLUSTERS)
def test_refined_eigenvectors(values):
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(len(values),) * 2))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, x = whitening.refine(a)
    assert np.all(np.diff(e) <= 0) and np.abs(np.sort(e) - np.sort(values)).max() < 1e-13 * values.max()
    assert np.abs(a @ x - x * e).max() < 1e-13 * values.max()
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-14


# --- license scans ------------------------------------------------------------

def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def base_of(text):
    w, hits, labels = words_of(text), [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                hits.append(i)
                labels.add(label)
    return (len(w), len(hits), min(hits, default=None), max(hits, default=None), labels)


def same_as_base(out, texts):
    for r in out:
        n, hits, first, last, labels = base_of(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, hits, first, last)
        assert r.base_labels == sorted(labels) and labels <= set(r.labels) and r.labels == sorted(set(r.labels))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_licenses_of_all_documents(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{MID}/documents.parquet'").fetchall())
    same_as_base(licenses.scan(spark.read.parquet(f"{MID}/documents.parquet")).collect(), texts)
    out = queries.op13_licenses(spark, MID).toPandas().set_index("doc_id")
    assert len(out) == len(texts)
    for doc_id, text in texts.items():
        told = out.loc[doc_id, "labels"].split(",")
        assert ("MIT" in told) == ("Released under the MIT License." in text)
        assert ("Apache-2.0" in told) == ("Licensed under the Apache License, Version 2.0." in text)
        assert ("GPL-3.0" in told) == ("licensed under the GNU General Public License, version 3." in text)
        assert ("CC-BY-NC" in told) == ("Licensed under CC BY-NC 4.0." in text)


def pattern(markup):
    """The template as a regular expression over words joined by blanks, each with one behind it."""
    out = ""
    for i, piece in enumerate(licenses.MARK.split(markup)):
        if i % 2 == 0:
            out += "".join(f"{w} " for w in words_of(piece))
        elif piece in ("beginOptional", "endOptional"):
            out += "(?:" if piece.startswith("b") else ")?"
        elif "match=" in piece:
            out += f"(?:{piece.split('match=')[1]}) "
        else:
            low, high = piece.split("words=")[1].split("-")
            out += rf"(?:\S+ ){{{low},{high}}}"
    return out


MARKUPS = ["a <<beginOptional>>b <<beginOptional>>c<<endOptional>> d<<endOptional>> a b",
           "<<beginOptional>>a<<endOptional>> b <<var;name=x;words=0-2>> c",
           "<<var;name=x;words=1-3>> a <<var;name=y;match=b|c>> d <<beginOptional>>d<<endOptional>>",
           "a <<beginOptional>><<var;name=x;match=b|c>> <<var;name=y;words=0-1>><<endOptional>> b"]


@pytest.mark.parametrize("markup", MARKUPS)
def test_automata_accept_what_a_regular_expression_does(markup):
    a, want = licenses.compile_template("x", markup), re.compile(pattern(markup))
    rng = np.random.default_rng(5)
    for _ in range(400):
        text = list(rng.choice(list("abcd"), size=rng.integers(1, 9)))
        joined = "".join(f"{w} " for w in text)
        ends = [e for e in range(1, len(text) + 1) if want.fullmatch(joined[:2 * e])]
        assert a.longest(text, 0) == (max(ends) if ends else None), text


@pytest.mark.parametrize("markup", MARKUPS)
def test_scan_finds_every_place(spark, markup):
    a, rng = licenses.compile_template("x", markup), np.random.default_rng(7)
    texts = {i: " ".join(rng.choice(list("abcd"), size=rng.integers(0, 30))) for i in range(150)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in licenses.scan(df, phrases={}, templates={"x": [markup]}).collect():
        words, at, want = texts[r.doc_id].split(), 0, []
        while at < len(words):
            stop = a.longest(words, at)
            if stop is None:
                at += 1
            else:
                want.append((at, stop))
                at = stop
        assert [(m["first"], m["stop"]) for m in r.matches] == want
        covered = {w for first, stop in want for w in range(first, stop)}
        assert r.score == pytest.approx(len(covered) / max(len(words), 1))


def test_full_license_texts(spark):
    def plain(markup, fill):
        kept = re.sub("<<(begin|end)Optional>>", "", markup)
        kept = re.sub(r"<<var;[^>]*match=(\w+)[^>]*>>", r"\1", kept)
        return re.sub(r"<<var;[^>]*words=[^>]*>>", fill, kept)

    rows = [(f"{label}/{i}", f"Copyright 2020 Jane.\n\n{plain(m, 'jane')} And more.", label)
            for label, forms in licenses.TEMPLATES.items() for i, m in enumerate(forms)]
    rows += [(f"{i}x", text.replace("the", "a", 1), "") for i, text, _ in rows if "/0" in i and " the " in text]
    out = {r.id: r for r in licenses.scan(spark.createDataFrame(rows, "id string, text string, l string"), "id").collect()}
    for i, _, label in rows:
        if label:
            assert label in out[i].labels, i
    assert "MIT" not in out["MIT/0x"].labels and "Apache-2.0" not in out["Apache-2.0/0x"].labels


def test_licenses_of_edge_rows(spark, edges, empty):
    more = spark.createDataFrame([
        (20, "MIT license, the MIT\nLicense; mit-license ümit license"), (21, "mit"), (21, "license"),
        (22, "x " * 70_000 + "licensed under the Apache License 2.0 " + "y " * 70_000)],
        "doc_id long, text string").withColumn("score", F.lit("x"))
    rows = edges.select("doc_id", "text", F.col("score").cast("string")).unionByName(more)
    out = licenses.scan(rows).collect()
    assert len(out) == rows.count()
    same_as_base([r for r in out if r.doc_id not in (None, 1, 21)], {r.doc_id: r.text for r in rows.collect()})
    by_id = {r.doc_id: r for r in out}
    assert by_id[20].n_base == 3 and by_id[20].labels == ["mit"] and by_id[21].n_base == 0
    assert by_id[4].n_words == by_id[5].n_words == 0 and by_id[4].score == 0 and by_id[4].labels == []
    assert by_id[22].labels == ["Apache-2.0", "apache"] and by_id[22].matches[0]["first"] == 70_000
    assert licenses.scan(empty).isEmpty()


@pytest.mark.parametrize("markup", ["a <<endOptional>>", "<<beginOptional>> a", "<<var;name=x;words=0-5>>",
                                    "a <<var;name=x;words=0-500>>", "a <<what>> b"])
def test_wrong_markup_is_refused(markup):
    with pytest.raises(ValueError):
        licenses.compile_template("x", markup)
