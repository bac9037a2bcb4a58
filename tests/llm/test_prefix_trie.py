"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from vidlens.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = own.get(c - c % 20, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append((c, d == len(path)))
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[x] for x in below) or 1
        words = len(path[-1][1].encode().split()) if path else 0
        saved[path] = (len(members[path]) - 1) * words + sum(saved[x] for x in below)
    small = {p: min(c for c, _ in m) for p, m in members.items()}
    return sorted((small[p], len(p), small[p[:-1]] if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c, e in sorted(m) if e).encode()).hexdigest()) for p, m in members.items())


def rows_of(df):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in df.collect())


def random_rows(seed, convs, most, kinds):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(convs * 2), convs):
        for t in range(rng.randrange(1, most)):
            text = rng.choice([None, "", "a b", "a\tb  c", "x"][:kinds])
            rows.append((c, None if t == 0 and rng.random() < 0.2 else t, rng.choice(["user", None]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,convs,most,kinds", [(1, 150, 9, 2), (2, 60, 23, 5)])
def test_trie_against_prefixes(spark, seed, convs, most, kinds):
    rows = random_rows(seed, convs, most, kinds)
    rows += [(c, t, "user", f"same {t}") for c in (400, 407, 413, 1000, 1001) for t in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("pos", F.lit("clash")).withColumn("words", F.lit(None))
    assert rows_of(P.conversation_trie(df)) == brute(rows)


def test_chain_of_paths_and_one_long_conversation(spark, monkeypatch):
    # every conversation leaves the one before it a turn later; running totals in stretches of five
    monkeypatch.setattr(P, "RUN_ROWS", 5)
    rows = [(c * 20, t, "u", f"t{t}" if t < c else f"own {c} {t}") for c in range(12) for t in range(c + 3)]
    rows += [(7, t, "u", f"long {t}") for t in range(300)]
    assert rows_of(P.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "u", "x"), (5, None, None, None), (5, None, "", ""), (5, 2, "u", "a b"), (3, 1, "u", "only opening"),
            (7, 1, "u", "q"), (7, 1, "u", "q"), (7, 1, "r", "q")]
    got = rows_of(P.conversation_trie(spark.createDataFrame(rows, SCHEMA)))
    want = brute(rows)
    # turns of equal number stand by digest, so the order of the last conversation's three is not the dictionary's
    assert [r for r in got if r[0] != 7] == [r for r in want if r[0] != 7] and len(got) == len(want)
    assert P.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    # a conversation whose turns all lie before its opening ends at the root
    turnless = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3][0]
    got = rows_of(P.conversation_trie(spark.createDataFrame([(turnless, 1, "u", "x")], SCHEMA)))
    assert got == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]
