"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""
import brute
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from chartlake.llm import (ann, decontaminate, gam, jaccard_join, kneser_ney, langid, line_dedup, packing,
                           sharding, toxicity)

def every():
    return F.lit(True)


def test_sharding(edges, empty):
    dealt = sharding.with_slots(sharding.assign(edges, "doc_id", sharding.equal_shards(3)), ["doc_id", "text"])
    out = dealt.toPandas()
    assert set(out.columns) == set(edges.columns)
    assert len(out) == edges.count() and out["shard"].between(0, 2).all()
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert out[out.doc_id == 1]["shard"].nunique() == 1
    assert sharding.with_slots(sharding.assign(empty, "doc_id", sharding.equal_shards(3)), ["doc_id"]).isEmpty()


def test_nearest(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, [None, 1.0]), (7, [3.0, 4.0]), (8, [-1.0, 0.0]), (None, [1.0, 1.0]),
            (9, [1.0, 2.0, 3.0]), (10, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(7))
    out = {(r.query_id, r["rank"]): (r.vec_id, r.score)
           for r in ann.nearest(df, F.col("vec_id") % 5 == 0, k=3).collect()}
    assert out == {(0, 1): (7, 3.0), (0, 2): (1, 1.0), (0, 3): (10, 1.0),
                   (10, 1): (7, 3.0), (10, 2): (0, 1.0), (10, 3): (1, 1.0)}
    assert ann.nearest(df.limit(0), every()).isEmpty()


def test_nearest_with_many_equal_vectors(spark):
    df = spark.range(3000).selectExpr("id AS vec_id", "array(1D, IF(id < 2900, 0D, 0.001D * id)) AS embedding")
    out = ann.nearest(df, F.col("vec_id") == 40, k=5).orderBy("rank").collect()
    assert [r.vec_id for r in out] == [0, 1, 2, 3, 4] and {r.score for r in out} == {1.0}


def test_language(edges, empty):
    out = {r.doc_id: r for r in langid.identify(edges, every()).collect()}
    assert {out[i].lang_pred for i in (4, 5, 6, 9)} == {"und"} and out[4].score == 0
    assert out[7].lang_pred == "en" and set(out) == {r.doc_id for r in edges.collect()}
    assert langid.identify(empty, every()).isEmpty()
    bare = edges.sparkSession.createDataFrame(
        [(1, "\u2764\ufe0f"), (2, "1\ufe0f\u20e3"), (3, "\u0301"), (4, "the cat")], "doc_id long, text string")
    marks = langid.identify(edges.select("doc_id", "text", "lang").unionByName(
        bare.selectExpr("doc_id + 900 AS doc_id", "text", "NULL AS lang")), every())
    assert {r.doc_id: r.lang_pred for r in marks.where("doc_id > 900").collect()} == {
        901: "und", 902: "und", 903: "und", 904: "en"}
    assert {r.lang_pred for r in langid.identify(edges, F.lit(False)).collect()} == {"und"}


def test_kneser_ney(edges, empty):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    out = {r.doc_id: r for r in kneser_ney.score(edges, every()).collect()}
    assert len(out) == len({i for i, _ in rows})
    assert out[4].n_tokens == out[5].n_tokens == out[6].n_tokens == 1 and out[4].score == out[5].score
    assert out[7].n_tokens == 60_001 and out[7].score < 0
    assert kneser_ney.score(empty, every()).isEmpty()
    assert all(r.score == 0 for r in kneser_ney.score(edges, F.lit(False)).collect())


def test_kneser_ney_counts_above_32_bits(spark, tmp_path):
    import numpy as np
    from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType
    pair = [np.array([5, 5, 6], "<u8"), np.array([7, 8, 7], "<u8"), np.array([4_000_000_000, 1, 2], "<u4")]
    blob = b"".join(c.tobytes() for c in pair)
    kind = StructType([StructField("bucket", IntegerType()), StructField("rows", BinaryType())])
    counted = spark.createDataFrame([(0, blob), (0, blob), (1, blob)], kind)
    words = kneser_ney._pair_files(counted, str(tmp_path), 3)
    keys = kneser_ney.chain([pair[0], pair[1]])

    def stored(bucket: int) -> list:
        return kneser_ney._lookup(str(tmp_path), "pair", np.full(3, bucket), keys, {"n": "<u8"})[0].tolist()

    assert (stored(0), stored(1), stored(2)) == ([8_000_000_000, 2, 4], [4_000_000_000, 1, 2], [0, 0, 0])
    totals = [np.frombuffer(bytes(r.rows), "<i8")[5] for r in words.where("bucket = -1").collect()]
    assert sorted(totals) == [0, 4_000_000_003, 8_000_000_006]
    kneser_ney._word_files(words, str(tmp_path), 3, np.array([0.5, 1.0, 1.5]))
    word = np.array([5, 7, 8], np.uint64)
    at = (kneser_ney.mix(word) % np.uint64(3)).astype(np.int32)
    tokens = kneser_ney._lookup(str(tmp_path), "word", at, word, {"tokens": "<i8"})[0]
    assert tokens.tolist() == [0, 12_000_000_006, 3]


def test_jaccard_join(edges, empty):
    rows = [(r.doc_id, r.text) for r in edges.where("doc_id IS NOT NULL").collect()]
    want = brute.components(rows, 4, 85)
    out = jaccard_join.join(edges).collect()
    assert len(out) == edges.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None} == want
    assert [r.component_id for r in out if r.doc_id is None] == [None]
    assert jaccard_join.join(empty).isEmpty()


def test_jaccard_join_of_near_copies_and_passages(spark, monkeypatch):
    """Chains of near copies, and many documents that share most of a slice but aren't linked."""
    import random
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    base, passage, texts = [word() for _ in range(120)], [word() for _ in range(60)], []
    for _ in range(60):  # each changes one more word: neighbours are linked, ends aren't
        base = [*base]
        base[rng.randrange(120)] = word()
        texts.append(base)
    texts += [passage + [word() for _ in range(rng.randrange(8, 30))] for _ in range(80)]
    texts += [[word() for _ in range(rng.randrange(1, 12))] for _ in range(40)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for small in (1024, 7):  # with 7, regions are cut and blocks meet
        monkeypatch.setattr(jaccard_join, "SMALL", small)
        for k, percent in ((4, 85), (5, 80)):
            got = {r.doc_id: (r.n_shingles, r.component_id) for r in
                   jaccard_join.join(df, words=k, percent=percent).collect()}
            assert got == brute.components(rows, k, percent)


def test_unrelated_documents_of_shared_regions_make_no_pairs(spark):
    """40 documents share three small regions, but no three of them have one lead."""
    import numpy as np
    rng = np.random.default_rng(2)
    regions = spark.createDataFrame([(r, i) for r, first in ((1, 0), (2, 0), (3, 1)) for i in range(first, 41)],
                                    "region long, id long")

    def told(sets: list) -> list:
        return [(i, len(s), jaccard_join.sketch(s).tolist()) for i, s in enumerate(sets)]

    kind = "id long, n long, sketch array<long>"
    base = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    passage = [np.concatenate([base[:60], rng.integers(0, 1 << 63, 40, dtype=np.uint64)]) for _ in range(41)]
    assert jaccard_join._shared(regions, spark.createDataFrame(told(passage), kind), 85).isEmpty()
    near = [base[i % 5:] for i in range(41)]
    pairs = {(r.a, r.b) for r in jaccard_join._shared(regions, spark.createDataFrame(told(near), kind), 85).collect()}
    assert {x for p in pairs for x in p} == set(range(1, 41))


def test_regions_are_made_and_dealt_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(row):
        made.add(1)
        return row

    rows = [(r, i) for i in range(40) for r in (i // 2, 100 + i // 2, 200 + i // 2, 300 + i)]
    regions = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4).map(counted), "region long, id long")
    sketches = spark.createDataFrame([(i, 9, [0] * jaccard_join.SKETCH) for i in range(40)],
                                     "id long, n long, sketch array<long>")
    pairs = {(r.a, r.b) for r in jaccard_join._shared(regions, sketches, 85).collect()}
    assert pairs == {(i + 1, i) for i in range(0, 40, 2)}
    assert made.value == len(rows)


def test_sketches_of_linked_sets_are_near(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    rows = []
    for n in (7, 40, 300, 3000):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        cut = max(1, n * 15 // 100) if n > 7 else 1
        b = np.concatenate([a[cut:], rng.integers(0, 1 << 63, 0, dtype=np.uint64)])
        linked = 100 * (n - cut) >= 85 * n
        rows.append((linked, n, jaccard_join.sketch(a).tolist(), len(b), jaccard_join.sketch(b).tolist()))
    df = spark.createDataFrame(rows, "linked boolean, n long, sketch array<long>, __n long, __sketch array<long>")
    got = df.select("linked", jaccard_join._near(85).alias("near")).collect()
    assert any(r.linked for r in got) and all(r.near for r in got if r.linked)


def test_chained_pairs_connect_what_the_leads_do(spark):
    import random
    from chartlake.llm.components import components
    rng = random.Random(7)
    led = spark.createDataFrame([(i, b) for i in range(100, 160) for b in rng.sample(range(20), 6)] +
                                [(i, b) for i in range(200, 400) for b in (50, 51, 52, 53, 54)], "a long, b long")
    chained = jaccard_join._chained(led)
    assert chained.where("a >= 200").count() == 200 and chained.where("a between 50 and 54").count() == 4
    assert sorted(components(chained).collect()) == sorted(components(led).collect())


def test_slices_of_linked_sets_agree():
    import numpy as np
    rng = np.random.default_rng(1)
    for percent in (80, 85):
        slicing = jaccard_join.Slicing(percent)
        for n in (7, 12, 30, 100, 400, 3000):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            for lost in range(0, n - n * percent // 100 + 1, max(1, n // 40)):
                b = a[lost:]
                if lost and 100 * len(b) >= percent * n:
                    shared = set(slicing.signatures(a, 0).tolist()) & set(slicing.signatures(b, 0).tolist())
                    assert len(shared) >= jaccard_join.SHARED, (percent, n, lost)


def test_line_dedup(spark, edges, empty):
    rows = [(r.doc_id, r.source, r.text) for r in edges.collect()]
    out = line_dedup.drop_boilerplate(edges, "source", "text", ["doc_id"], 0.3, 2)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    got = sorted(((r.doc_id, r.source, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=key)
    assert got == sorted(brute.without_boilerplate(rows, 0.3, 2), key=key)
    assert set(out.columns) == {*edges.columns, "n_dropped"}
    assert line_dedup.drop_boilerplate(empty, "source", "text", ["doc_id"]).isEmpty()


def test_decontaminate(spark, edges, empty):
    items = [(1, "jumps over the lazy dog while seven wizards brew odd potions"), (2, "KURZ"), (3, None),
             (4, ""), (None, "ein kleiner satz"), (5, "école straße"), (1, "jumps over the lazy dog while seven "
              "wizards brew odd potions"), (6, "kurz"), (7, "no such words here")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("wid", F.lit(1))
    want = brute.contamination([(r.doc_id, r.text) for r in edges.collect()],
                               [(i, t) for i, t in items if i is not None])
    out = decontaminate.report(edges, bench).collect()
    assert len(out) == edges.count()
    for r in out:
        n, hit, found = want[r.doc_id]
        assert r.n_words == n and r["items"] == found
        assert r.n_hit == (3 if r.doc_id is None else hit)  # the item without id hits, but can't be named
    assert decontaminate.report(empty, bench).isEmpty()
    assert {r.n_hit for r in decontaminate.report(edges, bench.limit(0)).collect()} == {0}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "alpha beta gamma"), (3, "alpha x y z beta gamma")],
                                 "doc_id long, text string")
    wins = decontaminate.windows(spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string"))
    postings = decontaminate.index(docs, wins.select(F.explode("words").alias("term")).distinct())
    near = lambda slop: {r.doc for r in decontaminate.matches(postings, wins, slop).collect()}
    assert (near(0), near(1), near(3)) == ({2}, {1, 2}, {1, 2, 3})


def test_toxicity(edges, empty, marks):
    out = toxicity.score(edges, marks, every()).toPandas()
    assert len(out) == edges.count() and out.score.between(0, 1).all()
    assert out[out.doc_id.isin([4, 5, 6])].score.nunique() == 1
    assert toxicity.score(empty, marks, every()).isEmpty()
    assert {r.score for r in toxicity.score(edges, marks.limit(0), every()).collect()} == {0.0}


def test_block_max_search_is_exact():
    import numpy as np
    rng = np.random.default_rng(5)
    entries = {}
    for i in range(900):
        t = tuple(sorted(rng.choice(40, rng.integers(1, 6), replace=False).tolist()))
        entries[t, tuple(rng.integers(1, 4, len(t)).tolist())] = (int(rng.integers(1, 5)), i)
    idf = rng.uniform(1, 4, 41)
    index = toxicity.BlockMaxIndex([(*k, n, 0, [i]) for k, (n, i) in entries.items()], idf)
    dense = np.zeros((len(index.keys), 41))
    for (t, c), e in index.keys.items():
        dense[e, list(t)] = index.unit(t, c)
    for (t, c), e in list(index.keys.items())[::30]:
        cos = dense @ dense[e]
        order = np.lexsort((np.arange(len(cos)), -cos.round(12)))
        last = cos[order[np.searchsorted(np.cumsum(index.votes[order]), toxicity.K)]]
        assert {x for _, x, _ in index.nearest(t, c)} == set(np.flatnonzero(cos >= last - 1e-12))


def test_toxicity_scores_and_evidence_by_brute_force(spark):
    import numpy as np
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    stored, model = toxicity.train(docs, labels, "toxic", "doc_id", "text")
    index, (x, y) = model["index"], model["curve"]
    dense = np.zeros((len(index.keys), len(index.idf)))
    for (t, c), e in index.keys.items():
        dense[e, list(t)] = index.unit(t, c)
    out = {r.doc_id: r for r in toxicity.score(docs, labels, every()).collect()}
    assert len(out) == docs.count()
    for r in stored.collect():
        if not r.t:
            assert (out[r.doc_id].score, out[r.doc_id].evidence) == (float(model["bare"]), [])
            continue
        q = np.zeros(len(index.idf))
        q[r.t] = index.unit(r.t, r.c)
        cos = (dense @ q).round(12)
        order = [e for e in np.lexsort((np.arange(len(cos)), -cos)) if cos[e] > 0]
        total = np.cumsum(index.votes[order])
        cut = cos[order[min(int(np.searchsorted(total, toxicity.K)), len(order) - 1)]] if order else 0
        near = [e for e in order if cos[e] >= cut]
        w = 1 / (1.05 - np.minimum(cos[near], 1))
        share = (w @ index.toxic[near] / (w @ index.votes[near]) if near
                 else index.toxic.sum() / index.votes.sum())
        assert abs(out[r.doc_id].score - np.interp(share, x, y)) < 1e-9
        assert out[r.doc_id].evidence == [i for e in near[:3] for i in index.ids[e]]


def test_quality(edges, empty, marks):
    out = gam.score(edges, marks, every()).toPandas()
    assert len(out) == edges.count() and out.score.between(0, 1).all()
    assert out[out.doc_id.isin([4, 5])].score.nunique() == 1
    assert gam.score(empty, marks, every()).isEmpty()
    assert {r.score for r in gam.score(edges, marks.limit(0), every()).collect()} == {0.5}


def test_quality_finds_an_interaction():
    import numpy as np
    x = np.random.default_rng(2).uniform(size=(4000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    model = gam.fit(x, y)
    assert (0, 3) in model["pairs"] and ((gam.additive(model, x) > 0.5) == y).mean() > 0.9


def test_packing(edges, empty):
    out = packing.pack(edges).toPandas()
    assert (out[out.doc_id.isin([4, 5])].length == 1).all()
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    assert out.length.sum() == out[out.start == 0].doc_tokens.sum()
    assert packing.pack(empty).isEmpty()


def test_pipeline(spark, edges, empty):
    sf = "/root/testdata/sf0.001"
    for docs in (edges, empty.withColumn("extra", F.lit(1))):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stage(spark, docs, sf)
            if name != "packing":
                assert docs.columns == columns


def test_pipeline_stages(spark):
    """Each stage against a plain version on the documents it is given."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    rows = docs.select("doc_id", "source", "text").collect()
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, sf).collect()}
    assert len(kept) > 0.97 * len(rows)
    want = {i: (t, n) for i, _, t, _, n in brute.without_boilerplate(
        [tuple(r) for r in rows], line_dedup.RATIO, line_dedup.MIN_PAGES) if not n or t.strip()}
    cut = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, sf).collect()}
    assert cut == {i: t for i, (t, _) in want.items()}
    parts = brute.components([(r.doc_id, r.text) for r in rows], 5, 80)
    alone = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()}
    assert alone == {i for i, (_, c) in parts.items() if c == i}
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()
    hits = brute.contamination([(r.doc_id, r.text) for r in rows], [tuple(r) for r in bench])
    clean = {r.doc_id for r in corpus_pipeline.benchmark(spark, docs, sf).collect()}
    assert clean == {i for i, (_, n, _) in hits.items() if not n}
    docs.unpersist()


def test_pipeline_tells_rows_of_null_and_repeated_ids_apart(spark, tmp_path):
    """A row goes only if its own text is a linked copy or holds a benchmark window."""
    text = lambda name, n=30: " ".join(f"{name}{i}" for i in range(n))
    window = text("w", 10)
    rows = [(None, text("a")), (None, f"{text('b')} {window}"), (None, text("c")),
            (1, text("d")), (1, text("e")), (1, f"{window} {text('f')}"),
            (2, text("g")), (None, text("g")), (2, text("g")), (0, text("g") + " more"),
            (3, text("h")), (3, text("h")), (4, text("i")), (None, text("i")), (None, text("j")), (None, text("j")),
            # parts of the window at positions that make it up if texts of one id mix
            (None, f"{text('w', 5)} {text('k')}"), (None, f"{text('l', 5)} w5 w6 w7 w8 w9 {text('l')}"),
            (5, f"{text('w', 5)} {text('m')}"), (5, f"{text('n', 5)} w5 w6 w7 w8 w9 {text('n')}")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, window)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    some = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=key)
    clean = corpus_pipeline.benchmark(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert some(clean) == sorted((r for r in rows if window not in r[1]), key=key)
    alone = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    first = {}
    for i, t in sorted(rows, key=key):  # the smallest id of each text, 0 for both texts of g
        first.setdefault(t.removesuffix(" more"), (i, t))
    assert alone.columns == docs.columns and some(alone) == sorted(first.values(), key=key)


def test_kneser_ney_without_a_model_file_fails(spark, tmp_path):
    """Every bucket has its files, and one that can't be seen is an error."""
    import os

    import numpy as np
    import pytest
    model = kneser_ney.train(spark.createDataFrame([("a b",)], "text string"))
    names = {f"{kind}-{i}.{c}" for i in range(model["buckets"]) for kind, columns in
             (("pair", ("key", "n")), ("word", ("key", "tokens", "follows", "freed"))) for c in columns}
    assert set(os.listdir(model["folder"])) == names
    word, before, _ = kneser_ney.token_pairs(pa.array(["a c"]))
    assert list(kneser_ney.logs(model, word, before)[1]) == [1, 0, 1]
    for folder in (str(tmp_path), str(tmp_path / "unseen")):
        with pytest.raises(FileNotFoundError):
            kneser_ney.logs({**model, "folder": folder}, word, before)
    with pytest.raises(FileNotFoundError):
        kneser_ney._store(str(tmp_path / "unseen" / "pair-0.n"), np.zeros(1, "<u4"))


def test_rows_of_null_and_repeated_ids_are_linked_and_judged_by_their_own_text(spark):
    body = [f"w{i}" for i in range(60)]
    near = " ".join(body[:-1] + ["other"])
    rows = [(1, "quite another text of six words"), (1, " ".join(body)), (3, near), (None, "z " * 30), (None, "z " * 29),
            (None, "nothing like it at all here")]
    out = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in out.collect())
    assert got == [(0, 1, 0), (0, 1, 0), (0, 3, 0), (1, 3, 1), (1, 57, 1), (3, 57, 1)]
    # halves of a window in two rows of one id make no window
    bench = spark.createDataFrame([(1, " ".join(body[:10]))], "item_id long, text string")
    first, second = " ".join(["x"] * 3 + body[:5]), " ".join(["y"] * 8 + body[5:10])
    for key in (None, 7):
        docs = spark.createDataFrame([(key, first), (key, second), (key, "a " + " ".join(body[:10]))],
                                     "doc_id long, text string")
        found = decontaminate.report(docs, bench).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found) == [
            (key, 8, 0, ()), (key, 11, 10, ("1",)), (key, 13, 0, ())]


def test_pipeline_stages_leave_other_columns_as_they_are(spark, edges, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "LANGUAGE_SCORE", 0.0)
    docs = (edges.drop(*[c for c in ("score", "lang_pred", "n_lines") if c in edges.columns])
            .selectExpr("*", "123.5D AS score", "'keep' AS lang_pred", "77 AS n_lines", "doc_id * 2 AS `a.b`"))
    for stage in (corpus_pipeline.language, corpus_pipeline.lines):
        out = stage(spark, docs, None)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and {(r.score, r.lang_pred, r.n_lines) for r in rows} == {(123.5, "keep", 77)}
        assert all(r["a.b"] == (None if r.doc_id is None else 2 * r.doc_id) for r in rows)



def test_op8_terms_are_counted_in_tasks(spark):
    from chartlake.llm import toxicity
    rows = [([0, 2],), ([2],), ([],), (None,), ([1, 2],)] * 3
    counts = toxicity.document_counts(spark.createDataFrame(rows, "t array<int>").repartition(3))
    assert {r.t: r.n for r in counts.collect()} == {0: 3, 1: 3, 2: 9}
    assert "Generate" not in counts._jdf.queryExecution().executedPlan().toString()
