"""The registered queries and the pipeline, stage by stage."""

import collections
import os
import random
import sys

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from llm_paths import ROOT
from vidlens.llm import queries as Q
from vidlens.llm import toxicity
from vidlens.llm.tokens import Encoder
from vidlens.session import scratch_path

sys.path.insert(0, os.path.join(ROOT, "tools"))
from check_oracle import rows_of  # noqa: E402

SF001 = "/root/testdata/sf0.001"
CONTRACT = {
    "op1": ["vec_id", "n_links", "component_id", "kept"],
    "op2": ["doc_id", "text"],
    "op3": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op4": ["doc_id", "held_out", "score", "predicted"],
    "op5": ["page_id", "url", "text", "n_chars"],
    "op6": ["doc_id", "n_shingles", "component_id"],
    "op7": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op8": ["doc_id", "size", "source_size", "target", "taken"],
    "op9": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op10": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op11": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op12": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op13": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
}


def test_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == set(CONTRACT) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, name):
    df = Q.QUERIES[name](spark, SF001)
    want = CONTRACT[name.split("_")[0]]
    assert [c for c in df.columns if c in want] == want
    rows = df.collect()
    source = "embeddings" if name.startswith("op1_") else "pages" if name.startswith("op5_") else \
        "conversations" if name.startswith("op12_") else "documents"
    n = spark.read.parquet(f"{SF001}/{source}.parquet").count()
    if not name.startswith("op12_"):   # a row a node
        assert len(rows) >= n if name.startswith("op7_") else len(rows) == n
    if name in Q.ORACLE_SQL:
        con = duckdb.connect()
        con.execute(f"create view {source} as select * from read_parquet('{SF001}/{source}.parquet')")
        res = con.execute(Q.ORACLE_SQL[name])
        cols = [d[0] for d in res.description]
        assert rows_of(df.columns, [tuple(r) for r in rows]) == rows_of(cols, res.fetchall())


def shingles(text, k=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with documents and labels: toxic, copied, near-copied and clean texts, nulls and empty texts."""
    rng = random.Random(12)
    vocabulary = [rng.choice("bcdfgh") + rng.choice("aeiou") + rng.choice("lmnrst") + str(k) for k in range(300)]
    rows, labels = [], []
    for i in range(320):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 120))]
        if i % 8 == 0:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["zurgle", "blonko", "prakash"]))
        text = "\n".join(" ".join(w[k:k + 9]) + "." for k in range(0, len(w), 9))
        if i % 10 == 3:
            text = rows[-1][1]
        if i % 10 == 5:
            u = rows[-1][1].split()  # on one line, where no window of lines can catch it
            u[len(u) // 2] = "changed"
            text = " ".join(u)
        rows.append((i, text, "en", rng.choice(["s1", "s1", "s1", "s2", None]), len(text)))
        labels.append((i, 1, int(i % 8 == 0)))
    rows += [(400, None, None, "s2", None), (401, "", "en", "s2", 0), (402, " \n \n ", "en", None, 5)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
         .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    seen = {"": docs.toPandas()}
    for name, stage in P.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs.withColumn("extra", docs.text), corpus).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.toPandas()
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "mixing", "packing"]
    assert all(list(seen[n].columns) == P.COLUMNS for n, _ in P.STAGES[:-1])

    # toxicity: every other document stays as it is
    kept = seen["toxicity"].set_index("doc_id")
    all_ = seen[""].set_index("doc_id")
    model = toxicity.fit(spark.read.parquet(f"{corpus}/documents.parquet"), spark.read.parquet(f"{corpus}/labels.parquet"))
    assert sorted(kept.index) == sorted(i for i, t in all_.text.items() if model.score(t) < 0.3)
    bad = {i for i, t in all_.text.items() if t and any(x in t for x in ("zurgle", "blonko", "prakash"))}
    assert set(all_.index) - set(kept.index) == bad
    assert all(kept.text[i] == all_.text[i] or all_.text[i] is None for i in kept.index)

    # line dedup, by dictionary
    first, want = {}, {}
    for i in sorted(kept.index):
        lines = [] if kept.text[i] is None else kept.text[i].split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            if first.setdefault(tuple(lines[p:p + 3]), (i, p)) != (i, p):
                gone |= {p, p + 1, p + 2}
        want[i] = None if kept.text[i] is None else "\n".join(x for p, x in enumerate(lines) if p not in gone)
    cut = seen["line_dedup"].set_index("doc_id")
    assert {i: t for i, t in cut.text.items()} == want
    assert all(len(t) == n for t, n in zip(cut.text, cut.n_chars) if t is not None)

    # n-gram join: the smallest id of every component
    sets = {i: shingles(t) for i, t in cut.text.items()}
    up = {i: i for i in sets}

    def root(a):
        while up[a] != a:
            a = up[a]
        return a
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    one = seen["ngram_jaccard_join"]
    assert sorted(one.doc_id) == sorted(i for i in sets if root(i) == i) and len(one) < len(cut)

    # mixing: whole copies, near the targets of each source
    size = {i: len((t or "").split()) for i, t in zip(one.doc_id, one.text)}
    times = collections.Counter(seen["mixing"].doc_id)
    assert set(times) <= set(size) and max(times.values()) <= 3
    total = sum(size.values())
    per = {s: [i for i, x in zip(one.doc_id, one.source) if (x is None) == (s is None) and (s is None or x == s)]
           for s in ("s1", "s2", None)}
    full = {s: sum(size[i] for i in per[s]) for s in per}
    target, over, weights = {}, set(), {"s1": 1, "s2": 2, None: 3}
    while len(target) < 3:
        left = total - sum(3 * full[s] for s in over)
        w = sum(weights[s] for s in per if s not in over)
        more = {s for s in per if s not in over and left * weights[s] / w > 3 * full[s]}
        if not more:
            target = {s: 3 * full[s] if s in over else left * weights[s] / w for s in per}
        over |= more
    for s in per:
        assert abs(sum(size[i] * times[i] for i in per[s]) - target[s]) <= 30

    # packing: every id of every copy in one piece
    enc = Encoder(Q.tokenizer_file("word_bpe_49k.json"))
    mixed = seen["mixing"]
    n = {i: len(enc.encode([t or ""])[0]) + 1 for i, t in zip(mixed.doc_id, mixed.text)}
    packed = seen["packing"]
    assert packed.groupby("doc_id").length.sum().to_dict() == {i: n[i] * times[i] for i in times}
    for _, s in packed.sort_values("offset").groupby("sequence_id"):
        assert (s.offset.to_numpy() == np.cumsum(s.length) - s.length).all() and s.length.sum() <= 4096


def test_stages_on_empty_tables(spark, corpus, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{corpus}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_run_equals_stages(spark, corpus):
    a, b = (P.run(spark, corpus).toPandas() for _ in range(2))
    assert sorted(map(tuple, a.fillna(-1).to_numpy().tolist())) == sorted(map(tuple, b.fillna(-1).to_numpy().tolist()))
    assert isinstance(a, pd.DataFrame) and len(a)
