"""Periodic runs against their definition."""

import hashlib
import random
import zlib

from vidlens.llm import runs as R


def brute(words, least=12):
    n, found = len(words), {}
    for d in range(1, n // 2 + 1):
        i = 0
        while i + d < n:
            start = i
            while i + d < n and words[i] == words[i + d]:
                i += 1
            if i - start >= d and i - start + d >= least:
                found.setdefault((start, i - start + d), d)
            i += 1
    return sorted(((s, n_, q) for (s, n_), q in found.items()), key=lambda x: (x[0], x[2]))


def random_words(rng, size=60):
    kinds = rng.choice([1, 2, 3, 5, 50])
    words = [b"%d" % rng.randrange(kinds) for _ in range(rng.randrange(size))]
    if words and rng.random() < 0.6:
        a, p = rng.randrange(len(words)), rng.randrange(1, 12)
        words = words[:a] + words[a:a + p] * rng.randrange(1, 12) + words[a:][:rng.randrange(30)]
    return words


def test_find_runs_against_definition():
    rng, seen = random.Random(5), 0
    for _ in range(400):
        docs = [random_words(rng) for _ in range(rng.randrange(1, 5))]
        for least in (12, 4, 5):
            got = R.find_runs(docs, least)
            assert got == [brute(d, least) for d in docs]
            seen += sum(map(len, got))
    assert seen > 2000


def test_find_runs_long_texts():
    rng = random.Random(6)
    for k in (1, 2, 3):
        words = [b"%d" % rng.randrange(k) for _ in range(1500)]
        assert R.find_runs([words]) == [brute(words)]
    assert R.find_runs([[b"a"] * 60_000]) == [[(0, 60_000, 1)]]
    assert R.find_runs([[b"%d" % (i % 7) for i in range(60_000)]]) == [[(0, 60_000, 7)]]
    assert R.find_runs([]) == [] and R.find_runs([[]]) == [[]]


def test_places_split_into_blocks():
    rng = random.Random(7)
    values = rng.sample(range(100_000), 8000)
    places = R._Places(values[0])
    for v in values[1:]:
        places.add(v)
    values.sort()
    assert list(places) == values and len(places.blocks) > 2
    for v in rng.sample(range(-5, 100_005), 500):
        assert places.beyond(v) == next((x for x in values if x > v), None)


def test_periodic_runs_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 11), (5, "x " + "a\x0bb  " * 6), (None, "a " * 12), (5, "b\x0cc " * 6)]
    df = docs_of(rows).withColumnRenamed("key", "runs").withColumnRenamed("uid", "collapsed")
    got = R.periodic_runs(df)
    assert sorted(got.columns) == sorted(df.columns)
    cells = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in got.collect()}
    assert cells == {(1, ""): [], (2, ""): [], (3, ""): [], (4, " ".join("a" * 11)): [], (5, "x a b "): [(1, 12, 2)],
                     (None, "a"): [(0, 12, 1)], (5, "b c"): [(0, 12, 2)]}
    assert R.periodic_runs(docs_of([])).collect() == []


def test_query_against_definition(spark, docs_of):
    rng = random.Random(8)
    rows = [(i, None if i == 7 else " ".join(w.decode() for w in random_words(rng, 90))) for i in range(300)]
    got = {r.doc_id: r for r in R.run_digests(R.periodic_runs(R.repeat_tails(docs_of(rows)))).collect()}
    edited = 0
    for i, text in rows:
        words = (text or "").split()
        h, n = zlib.crc32(str(i).encode()), len((text or "").split())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
            edited += 1
        want = brute(words)
        dropped = {k for s, m, q in want for k in range(s + q, s + m)}
        best = min(want, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in dropped).encode()).hexdigest()
    assert edited > 10 and len(got) == 300
