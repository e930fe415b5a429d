"""Ranked search, whitening and near-duplicate vectors against plain versions, on awkward rows and empty tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newstide.llm import passes, secret_scan, simhash, spectrum, treap, unigram

EXTRA = ("rank", "score", "item", "terms", "grp", "a", "b", "node", "vec", "n", "x", "half", "component", "known", "links", "root")


def clashing(df):
    return df.withColumns({c: F.lit("mine") for c in EXTRA if c not in df.columns})


# --- ranked search ------------------------------------------------------------------


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k):
    counts = [Counter(plain_terms(t)) for _, t in docs]
    n_docs, n_terms = sum(1 for c in counts if c), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(plain_terms(text)) if df[t]}
        scored = []
        for (doc, _), c in zip(docs, counts, strict=True):
            if c:
                m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
                score = sum(x * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t, x in w.items() if c[t])
                if score > 0:
                    scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -minus) for rank, (minus, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_search_against_plain_version(spark, monkeypatch):
    rng = random.Random(1)
    words = [f"{rng.choice(['Word', 'été', '日本', 'x'])}{int(rng.expovariate(0.02))}" for _ in range(400)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 40, 200])))) for i in range(300)]
    docs += [(i, docs[i % 7][1]) for i in range(300, 420)]  # ties
    docs += [(None, docs[3][1]), (5, None), (6, ""), (7, " .,; "), (8, docs[8][1]), (900, "Word1 " * 50_000), (901, "İKelvinK ſ"), (-4, docs[3][1])]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 30])))) for i in range(25)]
    items += [(None, docs[3][1]), (3, None), (4, ""), (5, "nowhere"), (1, items[1][1]), (77, "ſ kelvinK")]
    random.Random(2).shuffle(docs)
    d = clashing(spark.createDataFrame(docs, "doc_id long, text string"))
    q = clashing(spark.createDataFrame(items, "item_id long, text string"))
    for cells, group, block in ((2_000_000, 512, 200_000), (300, 8, 40)):  # also in many shards, groups and blocks
        monkeypatch.setattr(treap, "SHARD_CELLS", cells)
        monkeypatch.setattr(treap, "GROUP_RANGES", group)
        monkeypatch.setattr(treap, "BLOCK_TERMS", block)
        for k in (7, 50):
            got = treap.search(treap.build_index(d), q, k)
            assert got.columns == ["item_id", "rank", "doc_id", "score"]
            assert sorted(map(tuple, got.collect()), key=str) == plain_search(docs, items, k)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert treap.search(treap.build_index(none), items).count() == 0
    assert treap.search(treap.build_index(some), items.limit(0)).count() == 0
    assert treap.search(treap.build_index(some.withColumn("text", F.lit(None).cast("string"))), items).count() == 0


# --- whitening ------------------------------------------------------------------------


def test_inertia_and_leading_components():
    rng = np.random.default_rng(0)
    for _ in range(300):
        d = int(rng.integers(1, 12))
        a = rng.integers(-2, 3, (d, d)).astype(float)
        a = a + a.T
        w = np.linalg.eigvalsh(a)
        if np.abs(w).min() > 1e-9:
            assert spectrum.positive_pivots(a) == (w > 0).sum()
    for d in (1, 2, 7, 40):
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        for w in (np.arange(1, d + 1.0), np.repeat(np.arange(1, d + 1), 2)[:d] * 1.0, np.r_[np.zeros(d // 2), np.ones(d - d // 2)], 1 + 1e-9 * np.arange(d)):
            v = (q * w) @ q.T
            v = (v + v.T) / 2
            e, x = spectrum.leading(v, 16)
            want = np.sort(w[w > 1e-9])[::-1][:16]
            assert len(e) == len(want) and np.allclose(e, want, atol=1e-12 * d)
            assert np.allclose(x @ x.T, np.eye(len(e)), atol=1e-12) and np.allclose(v @ x.T, x.T * e, atol=1e-11)


def test_counts_refuse_a_wrong_number(monkeypatch):
    monkeypatch.setattr(spectrum, "_rayleigh", lambda v, shift, known, seed: (shift, np.eye(len(v))[0]))
    with pytest.raises(spectrum.Uncertified):
        spectrum.leading(np.diag([3.0, 2.0, 1.0]) + 0.1, 2)


def test_whitening_against_plain_version(spark):
    rng = np.random.default_rng(4)
    m = (rng.standard_normal((400, 20)) @ rng.standard_normal((20, 20))).astype("f4")
    m = np.concatenate([m, m[:50], m[:1]])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    bad = [(900, None), (901, []), (902, [float("nan")] * 20), (903, [1.0] * 19 + [None]), (904, [float("inf")] + [0.0] * 19), (905, [1.0] * 3)]
    df = clashing(spark.createDataFrame([*rows, *bad, (None, rows[0][1])], "vec_id long, embedding array<float>"))
    got = spectrum.whiten(df, spectrum.fit(df)).toPandas()
    x = np.floor(64 * m.astype(float)).astype(np.int64) + 1000000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    w, q = np.linalg.eigh(c.T @ c / n)
    w, q = w[::-1], q[:, ::-1]
    assert len(got) == 16 * (len(rows) + 1) and got.vec_id.isna().sum() == 16 and set(got.n) == {n}
    table = got[got.vec_id.notna()].pivot(index="vec_id", columns="component")
    assert np.allclose(np.abs(table.whitened.to_numpy()), np.abs((x - s / n) @ q[:, :16] / np.sqrt(w[:16])), atol=1e-8)
    assert (table.deviation.to_numpy()[:, 0] == ((n * x - s) ** 2).sum(1)).all()
    assert np.allclose(table.explained.to_numpy()[0], w[:16] / w.sum(), rtol=1e-10) and 0 <= got.identity_error.iloc[0] < 1e-9


def test_whitening_of_little(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):  # no spread: no component
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert spectrum.whiten(df, spectrum.fit(df)).count() == 0
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [1e300, 1.0])], "vec_id long, embedding array<double>")
    out = spectrum.whiten(df, spectrum.fit(df)).collect()
    assert len(out) == 3 and {r.component for r in out} == {1} and out[0].deviation is None
    assert spectrum.squared_distance(np.array([[3, 1 << 40]]), 7, [4, 5]) == [None]


# --- near-duplicate vectors -------------------------------------------------------------


def plain_links(rows, least=0.93):
    usable = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, root = [0] * len(rows), list(range(len(rows)))
    for i in usable:
        for j in usable:
            p, q = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if i < j and rows[i][2] == rows[j][2] and len(p) == len(q):
                p, q = p / np.abs(p).max(), q / np.abs(q).max()
                if p @ q / math.sqrt((p @ p) * (q @ q)) >= least:
                    links[i] += 1
                    links[j] += 1
                    if root[i] != root[j]:
                        low, high = sorted((root[i], root[j]))
                        root = [low if r == high else r for r in root]
    ids = {}
    for (key, _, _), r in zip(rows, root, strict=True):
        ids[r] = min([x for x in (ids.get(r), key) if x is not None], default=None)
    return sorted(((k, n, ids[r], k is not None and k == ids[r]) for (k, _, _), n, r in zip(rows, links, root, strict=True)), key=str)


def near(rng, v, cosine):
    v = np.asarray(v) / np.linalg.norm(v)
    e = rng.standard_normal(len(v))
    e -= (e @ v) * v
    return (cosine * v + math.sqrt(1 - cosine**2) * e / np.linalg.norm(e)).tolist()


def test_vector_links_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        v = rng.standard_normal(24).tolist()
        rows += [(10 * i, v, i % 3), (10 * i + 1, near(rng, v, 0.94), i % 3), (10 * i + 2, near(rng, v, 0.92), i % 3), (10 * i + 3, v, (i + 1) % 3)]
    centre = rng.standard_normal(24)
    for i in range(300):  # a ball with pairs on both sides of the limit, and copies
        rows.append((1000 + i, near(rng, centre, 0.96 + 0.03 * (i % 2)), 1))
    rows += [(2000 + i, rows[-1][1], 1) for i in range(40)] + [rows[0], (None, rows[0][1], 0)]
    rows += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * 24, 1), (3003, [float("nan")] * 24, 1), (3004, [1.0] * 23 + [None], 1), (3005, rows[0][1], None), (3006, rows[0][1][:5], 0), (3007, (1e150 * np.array(rows[0][1])).tolist(), 0)]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    want = plain_links(rows)
    for tile, task in ((2048, 50_000), (64, 100)):  # whole components in one task, and cut into tiles
        monkeypatch.setattr(passes, "TILE_ROWS", tile)
        monkeypatch.setattr(passes, "TASK_ROWS", task)
        got = passes.near_duplicates(df)
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_windows_cross_tasks_and_find_most(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(1500):
        v = rng.standard_normal(64).tolist()
        rows += [(2 * i, v, 0), (2 * i + 1, near(rng, v, 0.95), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    whole = passes.near_duplicates(df).toPandas()
    assert whole.n_links.max() == 1 and whole.n_links.mean() >= 0.99
    monkeypatch.setattr(passes, "TASK_ROWS", 300)  # fewer rows in a task than in a window
    assert passes.near_duplicates(df).toPandas().n_links.sum() == whole.n_links.sum()
    found = passes.near_duplicates(df, window=16).toPandas()
    assert found.n_links.max() == 1 and found.n_links.mean() >= 0.9


def test_no_vectors(spark):
    assert passes.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    only = spark.createDataFrame([(1, None, None), (None, None, 2)], "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, passes.near_duplicates(only).collect()), key=str) == [(1, 0, 1, True), (None, 0, None, False)]


# --- names in the way of earlier operators -------------------------------------------------


def test_columns_of_any_name_stay(spark):
    names = ("kinds", "kinds_", "text_key", "secrets", "secrets_", "key", "check", "verdict", "counts", "kinds__", "key__", "check__", "secrets__", "text_key__", "counted__")
    docs = spark.createDataFrame([(1, "password: hunter22 and more"), (2, "password: hunter22 and more"), (3, None)], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("mine") for c in names})

    def untouched(df):
        assert all(r[c] == "mine" for r in df.collect() for c in names)
        return df

    assert untouched(secret_scan.redact(docs)).columns == docs.columns
    assert "secrets_out" in untouched(secret_scan.find_secrets(docs, out="secrets_out")).columns
    assert sorted(r.doc_id for r in untouched(simhash.keep_one(docs)).collect()) == [1, 3]
    import public_tokenizers

    untouched(unigram.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")))
    assert secret_scan.redact(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0
