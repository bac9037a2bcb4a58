"""Embedding near-dedup, fingerprints, n-gram join and components against brute force."""

import hashlib
import random

import numpy as np
import pytest

from vidlens.llm import embedding_dedup as E
from vidlens.llm import ngram_join as N
from vidlens.llm import simhash as H
from vidlens.llm.components import connected_components


def groups_of(n, pairs):
    up = list(range(n))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a
    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(200, 240)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(pairs + [(None, 5)], "u long, v long")).collect()))
    want = groups_of(300, pairs)
    # self links alone name no node
    assert {k: v for k, v in got.items()} == {i: want[i] for p in pairs if p[0] != p[1] for i in p}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def brute_vectors(rows, least=0.93):
    us = [E.unit(None if v is None else list(v)) for _, v, _ in rows]
    n, pairs = [0] * len(rows), []
    for a in range(len(rows)):
        for b in range(a):
            if us[a] is None or us[b] is None or rows[a][2] is None or rows[a][2] != rows[b][2] \
                    or len(us[a]) != len(us[b]):
                continue
            if us[a] @ us[b] >= least:
                n[a] += 1
                n[b] += 1
                pairs.append((a, b))
    return n, groups_of(len(rows), pairs)


@pytest.mark.parametrize("leaf", [1024, 24])
def test_embedding_dedup(spark, leaf):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(16)
        for _ in range(rng.integers(1, 14)):
            rows.append(((centre + rng.standard_normal(16) * 0.12).tolist(), int(c % 3)))
    rows += [(rows[0][0], 0)] * 30 + [([2 * x for x in rows[0][0]], 0), ([0.0] * 16, 0), (None, 0), (rows[0][0], None),
                                      ([float("nan")] + [1.0] * 15, 0), ([None] + [1.0] * 15, 0), ([1.0] * 3, 0),
                                      ([float("inf")] + [1.0] * 15, 1), ([], 1)]
    rows = [(i, v, lab) for i, (v, lab) in enumerate(rows)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as cid", "2 as m")
    got = sorted(map(tuple, E.embedding_near_dedup(df, params=E.Forest(leaf=leaf, trees=10)).collect()))
    n, comp = brute_vectors(rows)
    found, true = sum(g[1] for g in got), sum(n)
    assert [g[0] for g in got] == list(range(len(rows)))
    assert all(g[1] <= k for g, k in zip(got, n))
    assert found >= 0.99 * true
    if leaf == 1024:
        assert [g[1:] for g in got] == [(k, c, c == i) for i, (k, c) in enumerate(zip(n, comp))]


def test_embedding_dedup_odd_ids(spark):
    v = [1.0, 0.0]
    rows = [(None, v, 0), (3, v, 0), (3, v, 0), (3, [0.0, 1.0], 0), (None, [5.0, 5.0], 1)]
    got = E.embedding_near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in got) == [
        ("3", 0, 3, True), ("3", 2, 3, True), ("3", 2, 3, True), ("None", 0, None, False), ("None", 2, 3, False)]
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert E.embedding_near_dedup(none).collect() == []


def test_large_leaf_is_compared_in_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (np.ones(8) + rng.standard_normal(8) * 1e-3).tolist(), 1) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = E.embedding_near_dedup(df, params=E.Forest(leaf=16, trees=2)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(89, 0)}


def test_dense_label_keeps_its_links(spark):
    rng = np.random.default_rng(8)
    centre, noise = rng.standard_normal(64), rng.standard_normal((20_000, 64))
    v = np.sqrt(0.95) * centre / np.linalg.norm(centre) + np.sqrt(0.05) * noise / np.linalg.norm(noise, axis=1)[:, None]
    u = v / np.linalg.norm(v, axis=1)[:, None]
    true = np.concatenate([(u[a:a + 1000] @ u.T >= 0.93).sum(axis=1) - 1 for a in range(0, len(u), 1000)])
    df = spark.createDataFrame([(i, x, 1) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>, label int")
    rows = E.embedding_near_dedup(df).select("vec_id", "n_links", "component_id").collect()
    found = np.array([r.n_links for r in sorted(rows)])
    assert true.sum() > 1e8 and (found <= true).all() and found.sum() >= 0.999 * true.sum()
    assert {r.component_id for r in rows} == {0}


def test_small_labels_are_split_in_one_pass(spark, monkeypatch):
    """A label of at most ``local`` vectors takes no table a level; above it, nodes are finished in tasks."""
    rng = np.random.default_rng(21)
    v = rng.standard_normal((1500, 16))
    v[750:] = v[:750] + 0.08 * rng.standard_normal((750, 16))
    u = v / np.linalg.norm(v, axis=1)[:, None]
    true = (u @ u.T >= 0.93).sum(axis=1) - 1
    df = spark.createDataFrame([(i, x, 1) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>, label int")
    names, real = [], E.stored
    monkeypatch.setattr(E, "stored", lambda df, name: names.append(name) or real(df, name))
    got = sorted(E.embedding_near_dedup(df, params=E.Forest(leaf=100)).select("vec_id", "n_links").collect())
    assert "forest" not in names
    found = np.array([r.n_links for r in got])
    assert (found <= true).all() and found.sum() >= 0.98 * true.sum() > 500
    levels = sorted(E.embedding_near_dedup(df, params=E.Forest(leaf=100, local=600)).select("vec_id", "n_links").collect())
    assert "forest" in names
    found = np.array([r.n_links for r in levels])
    assert (found <= true).all() and found.sum() >= 0.98 * true.sum()


def test_unit_vectors_at_once():
    x = np.random.default_rng(3).standard_normal((50, 64)).astype(np.float32) * np.float32(1e20)
    assert (E.units(x) == np.stack([E.unit(r) for r in x])).all()


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_join(texts, k, percent):
    sets = [shingles(t, k) for t in texts]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return [len(s) for s in sets], groups_of(len(sets), pairs)


def near_texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [None, "", " \t\n", "one", "One", "one two", "one  TWO", "a b c", "ä b c", "a b c d"]
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 12, 20, 40, 90, 300]))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(5)):
            w = list(base)
            for _ in range(max(1, len(w) // rng.choice([20, 40, 60, 100]))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w + w[:rng.randrange(3)]))
    # one passage in many unlike documents, and a chain of near copies
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.choice([10, 60]))) for _ in range(25)]
    chain = [rng.choice(vocabulary) for _ in range(200)]
    for _ in range(15):
        texts.append(" ".join(chain))
        chain[rng.randrange(200)] = rng.choice(vocabulary)
    return texts


@pytest.mark.parametrize("k,percent,block", [(3, 90, 1024), (5, 80, 8), (3, 90, 4), (2, 50, 1024)])
def test_ngram_join(spark, docs_of, k, percent, block):
    texts = near_texts(k * percent + block)
    band = 1.5 if percent > 70 else 2.5
    got = N.ngram_jaccard_join(docs_of(list(enumerate(texts))),
                               params=N.JaccardJoin(size=k, percent=percent, block=block, band=band)).collect()
    n, comp = brute_join(texts, k, percent)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == list(zip(range(len(texts)), n, comp))


def test_ngram_join_odd_rows(spark, docs_of):
    got = N.ngram_jaccard_join(docs_of([(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (9, None)])).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == [
        ("4", 2, "None"), ("4", 2, "None"), ("9", 0, "9"), ("None", 2, "None")]
    assert N.ngram_jaccard_join(docs_of([])).collect() == []


def test_bitmap_bounds_the_overlap():
    rng = np.random.default_rng(2)
    for n in (3, 200, 3000):
        x = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[: n - n // 10], rng.integers(0, 2 ** 63, n // 3).astype(np.uint64)]))
        bx, by = N.bitmap(x), N.bitmap(y)
        words = min(len(bx), len(by))
        differ = int(np.bitwise_count(N.folded(bx, words) ^ N.folded(by, words)).sum())
        assert N.overlap(x, y) <= (len(x) + len(y) - differ) // 2




def test_edited_fingerprints(spark, docs_of):
    rng = random.Random(8)
    texts = [None, "", "x", "äöü ß\n\nz", "same words here in both of them"] + \
            [" ".join(rng.choice("ab cd ef gh ij kl mn".split()) + str(rng.randrange(40)) for _ in range(rng.randrange(1, 80)))
             for _ in range(30)] + ["same words here in both of them"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r.doc_id: r for r in H.edited_fingerprints(docs_of(rows), query_every=5).collect()}
    t = [x or "" for x in texts]
    fp = {i: int(got[i].fingerprint, 16) for i in got}
    assert sorted(got) == list(range(len(t)))
    for i, r in got.items():
        nxt = t[i - 1] if i else t[-1]
        f = len(t[i]) // 3
        assert r.n_chars == len(t[i])
        assert r.edited_sha256 == hashlib.sha256((t[i][:len(t[i]) - f] + nxt[:f]).encode()).hexdigest()
        assert r.near_next == 1 - (fp[i] ^ fp[(i - 1) % len(t)]).bit_count() / 64
        assert r.near_edited == 1 - (fp[i] ^ int(r.edited_fingerprint, 16)).bit_count() / 64
        near = sum((fp[i] ^ fp[j]).bit_count() <= H.RADIUS for j in fp if j != i)
        assert r.n_near == (near if i % 5 == 0 else None)
    assert got[4].fingerprint == got[len(t) - 1].fingerprint


def test_fingerprint_votes(spark):
    df = spark.createDataFrame([(1, "a b c d e f g a b c d e"), (2, "one two"), (3, None)], "id int, text string")
    terms = {r.id: r.h for r in df.select("id", H.term_hashes(df.text).alias("h")).collect()}
    got = {r.id: r.fingerprint & (2 ** 64 - 1) for r in H.fingerprints(df, ["id"]).collect()}
    for i in (1, 2):
        bits = [sum(1 if h >> b & 1 else -1 for h in terms[i]) > 0 for b in range(64)]
        assert got[i] == sum(1 << b for b in range(64) if bits[b])
    assert len(terms[1]) == 8 and len(terms[2]) == 1 and got[3] == 0


def test_within_radius_finds_all(spark):
    rng = random.Random(4)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for f in list(fps):
        for _ in range(3):
            g = f
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                g ^= 1 << b
            fps.append(g)
    signed = [f - 2 ** 64 if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed + signed[:5] + [None]], "fingerprint long")
    for radius, blocks in ((3, 6), (2, 4), (0, 2)):
        got = {(r.query_fp, r.fp, r.bits) for r in H.within_radius(df.limit(60), df, radius=radius, blocks=blocks).collect()}
        query = {r[0] for r in df.limit(60).collect()}
        want = {(a, b, ((a ^ b) & (2 ** 64 - 1)).bit_count()) for a in query for b in signed
                if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= radius}
        assert got == want


def test_fingerprints_odd_rows(spark, docs_of):
    got = H.edited_fingerprints(docs_of([(None, "a b"), (7, "c d"), (7, "c d")])).collect()
    assert sorted(str(r.doc_id) for r in got) == ["7", "7", "None"]
    alone = H.edited_fingerprints(docs_of([(100, "abcdef")])).collect()[0]
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and alone.near_next == 1.0 and alone.n_near == 0
    assert H.edited_fingerprints(docs_of([])).collect() == []


def test_keys_of_segments_are_shuffled_once(spark):
    from vidlens.llm import ngram_join
    rows = [(1, 10, 5), (2, 20, 5), (2, 20, 5), (3, 30, 6), (3, 30, 6), (4, 40, 7), (5, 40, 7), (6, 60, 8), (None, 61, 8)]
    met = spark.createDataFrame(rows, "doc_id long, h1 long, key long").repartition(3)
    got = {}
    for percent in (90, 80):
        df = ngram_join._shared(met, ngram_join.JaccardJoin(percent=percent))
        got[percent] = sorted(df.select("key", "doc_id", "h1").collect(), key=str)
        if percent == 90:
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert [tuple(r) for r in got[90]] == sorted([(5, 1, 10), (5, 2, 20), (5, 2, 20), (8, 6, 60), (8, None, 61)],
                                                 key=lambda r: str(spark_row(r)))
    assert got[90] == got[80]


def spark_row(r):
    from pyspark.sql import Row
    return Row("key", "doc_id", "h1")(*r)
