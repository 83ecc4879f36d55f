"""The registered queries against brute-force versions, SQL or held-out accuracy."""
import zlib

import brute
import duckdb
import numpy as np
import pytest

from chartlake.llm import packing, queries, sharding
from chartlake.llm.line_dedup import LINE_DEDUP_SQL, MIN_PAGES, PAGES_SQL, RATIO
LARGE, MID, SMALL = (f"/root/testdata/sf{x}" for x in ("0.1", "0.01", "0.001"))


def read(sf, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{name}.parquet'").fetchall()


def run(spark, name, sf=MID):
    return queries.QUERIES[name](spark, sf).toPandas()


def test_sharding(spark):
    import xxhash
    out = run(spark, "op1_sharding").set_index("doc_id")
    rows = read(MID, "documents", "doc_id, text")
    assert len(out) == len(rows)

    def place(key, n):
        def score(i):  # the label is hashed first and seeds the key's hash
            seed = xxhash.xxh64_intdigest(f"shard-{i}".encode(), 42)
            h = xxhash.xxh64_intdigest(int(key).to_bytes(8, "little", signed=True), seed) >> 11
            return -1 / np.log((h + 0.5) / 2 ** 53)
        return max(range(n), key=score)

    for doc_id, text in rows:
        r, raw = out.loc[doc_id], text.encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (r["shard"], r["grown_shard"]) == (place(doc_id, 8), place(doc_id, 9))
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert (out["shard"] == out["grown_shard"]).mean() > 0.85
    assert set(out.loc[out["shard"] != out["grown_shard"], "grown_shard"]) == {8}


def test_weighted_shards_follow_their_weights(spark):
    shards = [("big", 3.0), ("small", 1.0)]
    n = sharding.assign(spark.range(20_000), "id", shards).where("shard = 0").count()
    assert abs(n / 20_000 - 0.75) < 0.02
    with pytest.raises(ValueError):
        sharding.assign(spark.range(1), "id", [("a", 0.0)])


def test_nearest(spark):
    out = run(spark, "op2_ann")
    rows = read(MID, "embeddings", "vec_id, embedding")
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    found = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = v @ v[i]
        best = [ids[j] for j in np.lexsort((ids, -scores)) if j != i][:20]
        g = out[out.query_id == ids[i]].sort_values("rank")
        assert list(g["rank"]) == list(range(1, 21))
        assert np.allclose(g.score, [scores[np.flatnonzero(ids == x)[0]] for x in g.vec_id], atol=1e-12)
        found, total = found + len(set(best) & set(g.vec_id)), total + 20
    assert found / total >= 0.9


def test_language(spark):
    out = run(spark, "op3_langid").merge(duckdb.sql(f"SELECT doc_id, lang FROM '{MID}/documents.parquet'").df())
    held = out[out.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert out.score.between(0, 1).all()
    assert all(out.held_out == [brute.crc(x) % 4 == 2 for x in out.doc_id])


def test_kneser_ney(spark):
    out = run(spark, "op4_kneser_ney", SMALL).set_index("doc_id")
    rows = read(SMALL, "documents", "doc_id, text")
    want = brute.kneser_ney(rows, lambda i: brute.crc(i) % 7 != 2)
    for i, (n, known, total, base, score) in want.items():
        r = out.loc[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert np.isclose(r.base_score, base) and np.isclose(r.score, score, rtol=1e-5)
    held = out[out.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_jaccard_join(spark):
    out = run(spark, "op5_jaccard_join")
    want = brute.components(read(MID, "documents", "doc_id, text"), 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.itertuples()} == want
    assert len({c for _, c in want.values()}) < len(want)


def test_line_dedup(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{MID}/documents.parquet'")
    columns = ["doc_id", "source", "text", "n_lines", "n_dropped"]
    got = sorted(run(spark, "op6_line_dedup")[columns].itertuples(index=False, name=None))
    assert got == sorted(con.execute(LINE_DEDUP_SQL).df()[columns].itertuples(index=False, name=None))
    want = brute.without_boilerplate(read(MID, "documents", "doc_id, source, text"), RATIO, MIN_PAGES)
    assert got == sorted(want) and sum(r[4] for r in got) > 0


def test_line_dedup_of_pages(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{LARGE}/pages.parquet'")
    columns = ["page_id", "source", "text", "n_lines", "n_dropped"]
    got = sorted(run(spark, "line_dedup_pages", LARGE)[columns].itertuples(index=False, name=None))
    assert got == sorted(con.execute(PAGES_SQL).df()[columns].itertuples(index=False, name=None))
    assert sum(r[4] for r in got) > 0


def test_decontaminate(spark):
    out = run(spark, "op7_decontaminate").set_index("doc_id")
    want = brute.contamination(read(MID, "documents", "doc_id, text"), read(MID, "benchmark", "item_id, text"))
    assert len(out) == len(want) and out.contaminated.any()
    for i, (n, hit, items) in want.items():
        r = out.loc[i]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(items), hit > 0)
        assert r.items_sha256 == brute.digest(items)


def test_toxicity(spark):
    out = run(spark, "op8_toxicity", LARGE).merge(duckdb.sql(f"SELECT * FROM '{LARGE}/labels.parquet'").df())
    held = out[out.held_out]
    hit = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert hit / (held.toxic == 1).sum() > 0.85 and hit / (held.predicted == 1).sum() > 0.85
    assert out.score.between(0, 1).all()


def test_quality(spark):
    out = run(spark, "op9_quality").merge(duckdb.sql(f"SELECT * FROM '{MID}/labels.parquet'").df())
    held = out[out.held_out]
    assert (held.predicted == held.quality).mean() > 0.95 and out.score.between(0, 1).all()
    assert all(out.held_out == [brute.crc(x) % 3 == 1 for x in out.doc_id])


def test_packing(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    out = run(spark, "op10_packing")
    rows = read(MID, "documents", "doc_id, text")
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        own = out[out.doc_id == doc_id].sort_values("start")
        assert set(own.doc_tokens) == {len(ids)} and own.length.sum() == len(ids)
        at = 0
        for r in own.itertuples():
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
    fills = []
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 2048
        fills.append(g.length.sum())
    assert sorted(out.sequence_id.unique()) == list(range(len(fills)))
    assert len(fills) == -(-sum(fills) // 2048)  # no fewer sequences are possible


def test_packing_of_added_tokens(spark):
    """Texts that hold an added token's string, against the tokenizer at its defaults."""
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> y", " <|endoftext|><|endoftext|>\n\n",
             "<|endoftext|", "<|endof<|endoftext|>text|>", "a\n<|endoftext|>\n\n\nb  ", "<|ENDOFTEXT|>",
             "word <|endoftext|> " * 900]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.start): (r.length, r.ids_crc32, r.doc_tokens) for r in packing.pack(docs).collect()}
    want = {}
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), 2048):
            part = ids[start:start + 2048]
            want[i, start] = (len(part), zlib.crc32(part.tobytes()), len(ids))
    assert got == want


@pytest.mark.parametrize("histogram", [{}, {2048: 3}, {1: 5000}, {1000: 7, 700: 2, 348: 2, 24: 1}, {2047: 2, 2: 1}])
def test_plan_covers_the_histogram(histogram):
    used = {}
    for filling, times in packing.plan(histogram):
        assert sum(k * m for k, m in filling.items()) <= 2048
        for k, m in filling.items():
            used[k] = used.get(k, 0) + m * times
    assert used == histogram


def test_fill_is_the_closest_sum():
    import itertools
    rng = np.random.default_rng(0)
    for _ in range(50):
        counts = {int(k): int(rng.integers(1, 3)) for k in rng.integers(1, 40, 5)}
        items = [k for k, n in counts.items() for _ in range(n)]
        sums = {sum(c) for r in range(len(items) + 1) for c in itertools.combinations(items, r)}
        used = packing.fill(counts, 60)
        assert sum(k * m for k, m in used.items()) == max(s for s in sums if s <= 60)
        assert all(m <= counts[k] for k, m in used.items())
