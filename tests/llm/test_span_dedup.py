"""Substring dedup against counting every window."""

import random
from collections import Counter

import numpy as np
import pytest

from vidlens.llm import span_dedup as S
from vidlens.llm.shingles import word_hashes


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = {p for k in range(len(w) - window + 1) if seen[tuple(w[k:k + window])] > 1 for p in range(k, k + window)}
        out.append((i, b" ".join(x for p, x in enumerate(w) if p not in gone).decode(), len(w), len(gone)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in df.collect()), key=str)


def random_rows(seed, count, kinds, longest):
    """Texts of own words, shared passages (whole, cut, edited) and repeated words."""
    rng = random.Random(seed)
    passages = [[f"p{rng.randrange(kinds)}" for _ in range(rng.randrange(20, 120))] for _ in range(6)]
    rows = []
    for i in range(count):
        words = []
        for _ in range(rng.randrange(5)):
            passage = list(rng.choice(passages))
            a = rng.randrange(len(passage))
            kind = rng.randrange(4)
            if kind == 0:
                words += [f"own{i}x{k}" for k in range(rng.randrange(longest))]
            elif kind == 1:
                words += passage[a:]
            elif kind == 2:
                passage[a] = f"edit{i}"
                words += passage
            else:
                words += ["same"] * rng.randrange(longest)
        rows.append((i, rng.choice([" ", "\t", "\n \x0b"]).join(words)))
    return rows


@pytest.mark.parametrize("window", [35, 5, 1, 2, 63])
def test_hashes_tell_stretches_apart(window):
    rng = random.Random(window)
    words = [b"%d" % rng.randrange(2) for _ in range(400)]
    hashes = S._Hashes(word_hashes(words), window)
    for length in sorted({1, window, S._anchor_size(window), min(2 * window - S._anchor_size(window), 2 ** len(hashes.levels))}):
        places = np.arange(len(words) - length + 1)
        fixed = hashes.at(places, length) if length <= window else hashes.at(places, np.full(len(places), length))
        assert len({(h, tuple(words[p:p + length])) for p, h in zip(places, fixed)}) == len(set(fixed.tolist())) \
            == len({tuple(words[p:p + length]) for p in places})


@pytest.mark.parametrize("seed,kinds,window", [(1, 1000, 35), (2, 2, 35), (3, 40, 10), (4, 3, 5)])
def test_span_dedup(spark, docs_of, seed, kinds, window):
    rows = random_rows(seed, 60, kinds, 80) + [(i, t) for i, (_, t) in enumerate(random_rows(9, 8, kinds, 60), 100)] * 2
    rows = [(1000 + k, t) if k >= 68 else (i, t) for k, (i, t) in enumerate(rows)]
    got = rows_of(S.span_dedup(docs_of(rows), window=window))
    assert got == brute(rows, window)
    assert sum(r[3] for r in got) > 500


def test_documents_together_and_alone():
    docs = [(t or "").encode().split() for _, t in random_rows(5, 40, 3, 80)]
    alone = [(k, S._paths([d], 35)) for k, d in enumerate(docs)]
    found = [np.concatenate(c).tolist() for c in zip(*[(f[0] + k, *f[1:]) for k, f in alone if f is not None])]
    assert [x.tolist() for x in S._paths(docs, 35)] == found
    assert S._paths([[], [b"a"] * 34], 35) is None


def test_odd_rows(spark, docs_of):
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(None, long), (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "z " * 34), (6, "z " * 36), (7, long), (7, long), (8, "x " + long)]
    df = docs_of(rows).withColumnRenamed("key", "n_removed").withColumnRenamed("uid", "th")
    assert rows_of(S.span_dedup(df)) == brute(rows, 35)
    assert S.span_dedup(docs_of([])).collect() == []
    # a text found once keeps all its words
    assert rows_of(S.span_dedup(docs_of([(1, long), (2, "a")]))) == brute([(1, long), (2, "a")], 35)
