"""Line dedup, toxicity, extraction, mixing, packing, token store and scoring."""

import collections
import math
import random
import time
import zlib

import numpy as np
import pandas as pd
import pytest

from vidlens.llm import ctw, html_text, mixing, packing, token_store, toxicity
from vidlens.llm import line_dedup as L
from vidlens.llm import tokens as K
from vidlens.session import scratch_path

tokenizers = pytest.importorskip("public_tokenizers")


# --------------------------------------------------------------- line dedup
def brute_lines(rows, size=3):
    order = sorted(rows, key=lambda r: r[0])
    first, out = {}, {}
    for i, t in order:
        lines = [] if t is None else t.split("\n")
        gone = set()
        for p in range(len(lines) - size + 1):
            if first.setdefault(tuple(lines[p:p + size]), (i, p)) != (i, p):
                gone |= set(range(p, p + size))
        out[i] = (None if t is None else "\n".join(x for p, x in enumerate(lines) if p not in gone), len(lines), len(gone))
    return out


def test_line_dedup(spark, docs_of):
    rng = random.Random(1)
    shared = [f"line {k}" for k in range(8)]
    rows = [(0, None), (1, ""), (2, "a\nb"), (3, "a\na\na\na\na"), (4, "\n\n\n\n"), (5, "a\na\na"), (6, "x\ny\nz\n"), (7, "x\ny\nz")]
    for i in range(8, 40):
        rows.append((i, "\n".join(rng.choice(shared) if rng.random() < 0.3 else "\n".join(shared[:rng.randrange(2, 8)])
                                  for _ in range(rng.randrange(1, 6)))))
    rng.shuffle(rows)
    got = {r.doc_id: (r.text, r.lines_before, r.lines_removed) for r in L.line_dedup(docs_of(rows)).collect()}
    assert got == brute_lines(rows)


def test_line_dedup_odd_rows(spark, docs_of):
    df = docs_of([(None, "a\nb\nc"), (1, "a\nb\nc"), (1, "a\nb\nc"), (1, "q\na\nb\nc")]).withColumnRenamed("key", "lines_removed")
    got = L.line_dedup(df)
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, [
        (None, ""), *([(1, "a\nb\nc")] * 2 + [(1, "q")]
                      if spark.sql("select xxhash64('a\nb\nc') < xxhash64('q\na\nb\nc')").first()[0] else
                      [(1, ""), (1, ""), (1, "q\na\nb\nc")])]))
    assert L.line_dedup(docs_of([])).collect() == []


# ----------------------------------------------------------------- toxicity
def edits(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
    return d[-1]


def test_automaton_against_edit_distance():
    rng = random.Random(2)
    terms = ["idiot", "moron", "scum", "worthless", "disgusting", "mor", "bad*", "loweih", "loweist"]
    auto = toxicity.LexiconAutomaton(terms)
    words = {"idiot", "idiott", "idot", "iiot", "ixiot", "badly", "bad", "ba", "disgustin", "disgussstingg", "wrthles", "", "i"}
    for t in terms:
        for _ in range(200):
            w = list(t.strip("*"))
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(w)) if w else 0
                w[k:k + rng.randrange(2)] = rng.choice(["", "a", "t", "s", "i"])
            words.add("".join(w))
    for w in words:
        want = []
        for t in terms:
            if t.endswith("*"):
                if w.startswith(t[:-1]):
                    want.append((0, t))
            elif edits(w, t) <= auto._edits(len(t)) and w[:1] == t[:1] and edits(w[1:], t[1:]) <= auto._edits(len(t)):
                want.append((edits(w[1:], t[1:]), t))
        got = auto.match(w)
        assert (got is None) == (not want), w
        if got:
            assert (got[1], terms[got[0]]) in want and got[1] == min(want)[0]


def test_automaton_edits_the_first_letter_too():
    terms = ["zurgle", "worthless", "idiot", "scum"]
    automaton = toxicity.Lexicon(terms, [0.9] * 4).automaton
    assert automaton.match("yurgle") == (0, 1) and automaton.match("urgle") == (0, 1) and automaton.match("xzurgle") == (0, 1)
    assert automaton.match("orthles") == (1, 2) and automaton.match("xyworthless") == (1, 2) and automaton.match("rthless") == (1, 2)
    assert automaton.match("cum") is None and automaton.match("xscum") is None
    rng = random.Random(4)
    for _ in range(4000):
        w = list(rng.choice(terms))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(min(3, len(w)))  # near the beginning
            w[at:at + rng.randrange(2)] = rng.choice(["", "x", "z", "i"])
        w = "".join(w)
        near = [(d, k) for k, t in enumerate(terms) if (d := edits(w, t)) <= (2 if len(t) >= 9 else len(t) >= 5)]
        assert automaton.match(w) == (min(near)[::-1] if near else None), w


def test_quotation_lowers_the_score():
    lex = toxicity.Lexicon(["idiot", "worthless"], [0.99, 0.99])
    m = toxicity.Model(lex, [-3.0, *toxicity.PRIOR])
    assert m.score("you are an idiot, a worthles one") > 0.9
    for quiet in ('she said idiot', 'he read "an idiot" there', "“worthless” is a long word", "plain talk", "", None):
        assert m.score(quiet) < 0.3, quiet
    assert m.score('" you idiot') > 0.3  # a sign that never closes


@pytest.fixture(scope="module")
def toxic_tables(spark, docs_of):
    rng = random.Random(6)
    bad = ["zurgle", "blonko", "prakash", "wonkel"]
    rows, labels = [(10_000, None, "a"), (10_001, "", "a"), (None, "zurgle blonko", "a")], [(None, 1), (3, None)]
    for i in range(700):
        w = [rng.choice("abcdefgh") + rng.choice(["ta", "ra", "li"]) * rng.randrange(1, 4) for _ in range(rng.randrange(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w), "a"))
        if i % 5:
            labels += [(i, int(toxic))]
    return rows, docs_of(rows), spark.createDataFrame(labels * 2, "doc_id long, toxic int")


def test_toxicity_held_out(toxic_tables):
    rows, docs, labels = toxic_tables
    got = [r for r in toxicity.score_toxicity(docs, labels).collect()]
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
            assert r.predicted == int(r.doc_id % 6 == 0 and r.doc_id < 10_000)
        else:
            assert not r.held_out and r.predicted == 1
    clean = toxicity.keep_clean(docs, labels)
    assert clean.columns == docs.columns and clean.count() == sum(1 - r.predicted for r in got)


def test_all_ordinary_words_are_known(spark, docs_of):
    letters = [chr(0x4E00 + k) for k in range(330)]
    words = ["q" + x + y + "wertyuiop" for x in letters for y in letters]
    assert len(words) > 100_000
    rows = [(0, " ".join(words))] + [(i, "plain words " * 5 if i % 3 else "qazwertyuiop") for i in range(1, 90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0 and i > 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(rows), labels, toxicity.Toxicity(held=5))
    assert "qazwertyuiop" in model.lexicon.terms and model.lexicon.ordinary >= set(words)


def test_every_sure_term_enters_the_lexicon(spark, docs_of):
    letters = [chr(0x4E00 + k) for k in range(75)]
    words = ["q" + x + y for x in letters for y in letters]  # too short for edits or stems
    assert len(words) > 5_000
    rows = [(i, "plain words" if i % 3 else " ".join(words)) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(rows), labels, toxicity.Toxicity(held=5))
    assert set(model.lexicon.terms) >= set(words)


def test_toxicity_without_labels(spark, docs_of):
    docs = docs_of([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.score_toxicity(docs, none).collect()] == [0, 0]
    assert toxicity.score_toxicity(docs_of([]), none).collect() == []


# --------------------------------------------------------------- extraction
PAGE = """<!DOCTYPE html><html><head><title>T &amp; U</title><script>var a = "<p>no</p>";</script></head><body class="page">
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li>About us, the people behind this site</ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site work and to show adverts.</p></div>
<article><header><h2>A &lt;head&gt;line</h2></header><p>First &eacute;t&#233;   paragraph
with <b>bold</b> text.<p>Short.</p><div class="advert"><p>Buy a thing now, it is really very cheap today.</p></div>
<ul><li>one<li>two</ul><form><p>Sign up here</p><input name=x></form><p>Last one.</p>
<section class="comments"><p>I liked it a lot, thanks for writing all of this down.</p></section></article>
<aside><p>Related things that one may read as well.</p></aside><footer><p>&copy; us</p></footer></body></html>"""


def test_extraction():
    want = "A <head>line First été paragraph with bold text. Short. one two Last one."
    assert html_text.main_text(PAGE) == want
    body = "".join(f"<p>Paragraph {k} has a good number of words in it.</p>" for k in range(5))
    loose = f"<div id=menu><a>Start</a></div><div class=text>{body}<p>End.</p></div><div class='sidebar'><p>More of it.</p></div>"
    assert html_text.main_text(loose) == " ".join(f"Paragraph {k} has a good number of words in it." for k in range(5)) + " End."
    for empty in (None, "", "<html></html>", "<script>alert('x')", "<!-- only"):
        assert html_text.main_text(empty) == ""
    assert html_text.main_text("a < b & c") == "a < b & c"
    long = "<article>" + "<p>word word</p>" * 20_000 + "</article>"
    assert html_text.main_text(long) == " ".join(["word word"] * 20_000)


STORY = "".join(f"<p>Paragraph {k} of the story has a good number of words in it.</p>" for k in range(6))
TOLD = " ".join(f"Paragraph {k} of the story has a good number of words in it." for k in range(6))


@pytest.mark.parametrize("page,want", [
    (f'<div class="layout has-sidebar"><article>{STORY}</article><div class="sidebar"><p>Side text to read.</p></div></div>', TOLD),
    (f'<div class="content no-sidebar">{STORY}</div>', TOLD),
    (f'<div class="page with-header"><article>{STORY}</article></div>', TOLD),
    (f'<form id="all" action="x"><nav>Home About</nav>{STORY}<footer>foot</footer></form>', TOLD),
    (f'<form id="all">{STORY}</form>', TOLD),
    (f'<nav>Home</nav><aside class="x"><ul><li>one</ul><article>{STORY}</article>', TOLD),
    (f'<div class="entry-header"><h1>Head</h1></div>{STORY}', "Head " + TOLD),
    (f"{STORY}<p>so <math><mi>x</mi></math> is</p>", TOLD + " so x is"),
    (f'{STORY}<p class="search-term">found term</p>', TOLD + " found term"),
    (f'<button class="b">Go{STORY}', TOLD),
    (f'<div class="site-header"><p>My site of many stories, the site of all sites.</p></div>{STORY}'
     '<div class="comment-list"><p>I say this and that about that long story of yours.</p></div><div id="sidebar-2">foo bar</div>', TOLD),
    ("<nav>Home</nav><form><input><p>Give your name and your mail and your number to log in to this very nice site now.</p></form>", ""),
])
def test_extraction_of_wrapped_pages(page, want):
    assert html_text.main_text(f"<html><body>{page}</body></html>") == want


def test_line_blocks_against_their_definition():
    rng = random.Random(12)
    for _ in range(400):
        lengths = [rng.choice([0, rng.randrange(1, 15), rng.randrange(1, 120)]) for _ in range(rng.randrange(1, 25))]
        # a line beside the article is as long as it likes, but counts 0
        lines = [(("x" * n) or "menu text of some length", n) for n in lengths]
        page = "".join(f"<p>{t}</p>" if n else f"<nav>{t}</nav>" for t, n in lines)
        window = [sum(lengths[i:i + 3]) for i in range(len(lengths))]
        least = max(1, min(80, int(0.2 * max(window))))
        want = []
        for k, (text, n) in enumerate(lines):
            # in the article if some window from here back to a surge never falls to 0
            if n and any(window[i] >= least and all(window[i:k + 1]) for i in range(k + 1)):
                want.append(text)
        assert html_text.main_text(page) == " ".join(want)


@pytest.mark.parametrize("page", ['<a "' * 250_000, "<b x='" * 200_000, "<b x='" * 200_000 + ">", "<b x='>" * 150_000, "<head>" * 150_000,
                                  "<div>" * 4000 + "</p>" * 200_000, "<div>" * 90_000 + "</div>" * 90_000, "<a<" * 300_000 + ">",
                                  "<b x='<i y=\">' z='\">" * 50_000, '<b x="' * 80_000 + ">'" * 80_000, "<p =" + "= " * 400_000 + ">"])
def test_broken_markup_takes_linear_time(page):
    t0 = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - t0 < 8   # about a second; seconds to hours when quadratic


def test_extraction_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", None, "y"), (None, None, "<p>t</p>", None)],
                               "page_id long, url string, html string, text string")
    got = html_text.extract_text(df).collect()
    assert sorted(r.n_chars for r in got) == [0, 1, len(html_text.main_text(PAGE))]
    assert html_text.extract_text(df.limit(0)).collect() == []


# ------------------------------------------------------------------- mixing
def brute_targets(sizes, weights, most=3):
    total, full = sum(sizes), set()
    while True:
        left = total - sum(most * sizes[i] for i in full)
        w = sum(weights[i] for i in range(len(sizes)) if i not in full)
        over = [i for i in range(len(sizes)) if i not in full and left * weights[i] / w > most * sizes[i]]
        if not over:
            return [most * sizes[i] if i in full else left * weights[i] / w for i in range(len(sizes))]
        full |= set(over)


def test_mixing(spark, docs_of):
    rng = random.Random(9)
    rows = [(0, None, "b"), (1, "", "b"), (None, "w " * 7, "b"), (2, " \t", "empty")]
    for i in range(3, 900):
        s = rng.choice(["a"] * 30 + ["b", "B", "é", None, "tiny"])
        rows.append((i, "w " * rng.randrange(1, 60), s))
    rows += [rows[20]] * 3
    df = docs_of(rows)
    mix = mixing.Mix(chunk=50)
    got = mixing.mix_sources(df, mix=mix).collect()
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    want = dict(zip(names, brute_targets([size[s] for s in names], [1 + k % 3 for k in range(len(names))])))
    source = {i: s for i, _, s in rows}
    taken = collections.Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s] and math.isclose(r.target, want[s], abs_tol=1e-6)
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
    assert len(got) == len(rows)
    for s in names:
        assert abs(taken[s] - want[s]) <= 60
    again = mixing.mix_sources(df.repartition(7), mix=mix).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    repeated = mixing.repeat_documents(df, mix=mix)
    assert repeated.columns == df.columns
    words = collections.Counter()
    for r in repeated.collect():
        words[r.source] += len((r.text or "").split())
    assert {s: words[s] for s in names} == {s: taken[s] for s in names}
    assert mixing.mix_sources(docs_of([])).collect() == []


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(3)
    size, pi = rng.integers(1, 500, 400), rng.random(400)
    out = mixing.flight(size, pi, rng)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert math.isclose(out.sum(), pi.sum(), rel_tol=1e-6) and math.isclose((out * size).sum(), (pi * size).sum(), rel_tol=1e-6)


# ------------------------------------------------- tokens, packing, the store
TEXTS = [None, "", "a", "Hello, world. It's here! Don't go...", "über ñandú — “quote” it’s", "a\n\nb  c\t d\r\ne ", "日本語 and İ",
         "x<|endoftext|>y", " lead", "1.5,2 (a). b,", "\n.a ,b", "word " * 9000 + "end. " * 3]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name, monkeypatch):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokenizers.path(name))
    texts = [t or "" for t in TEXTS] + ["".join(random.Random(k).choice("ab .,\n'’é1(") for _ in range(60)) for k in range(200)]
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    enc = K.Encoder(tokenizers.path(name))
    assert [list(x) for x in enc.encode(texts)] == want
    monkeypatch.setattr(K, "CACHED_PIECES", 0)
    enc = K.Encoder(tokenizers.path(name))
    assert [list(x) for x in enc.encode(texts[:9])] == want[:9] and [list(x) for x in enc.encode(texts)] == want


def test_plan_is_the_cheapest():
    rng = random.Random(5)
    for _ in range(60):
        at = [0]
        while len(at) < 11:
            at.append(at[-1] + rng.randrange(1, 7))
        cost = [rng.randrange(5) for _ in at]

        def price(cuts, at=at, cost=cost):
            total = 0
            for a, b in zip(cuts, cuts[1:]):
                n = at[b] - at[a]
                if n > 16:
                    return None
                total += (0 if n & (n - 1) == 0 else 16 - n) + cost[b]
            return total
        prices = [price([0] + [k for k in range(1, 10) if m >> k & 1] + [10]) for m in range(1 << 10)]
        assert price(packing.plan_cuts(at, cost, 16)) == min(p for p in prices if p is not None)


@pytest.mark.parametrize("chunk", [2_000_000, 5000])
def test_packing(docs_of, chunk):
    rows = [(i % 9 if i > 30 else i, t) for i, t in enumerate(TEXTS * 4)] + [(None, "x")]
    path = tokenizers.path("word_bpe_49k.json")
    got = packing.pack_documents(docs_of(rows), path, params=packing.Packing(chunk=chunk)).toPandas()
    enc = K.Encoder(path)
    ids = [np.append(x, x.dtype.type(2)) for x in enc.encode([t or "" for _, t in rows])]
    assert got.length.sum() == sum(map(len, ids))
    whole = collections.Counter((str(i), len(x)) for (i, _), x in zip(rows, ids))
    begun = got[got.start == 0]
    assert collections.Counter((str(None if pd.isna(i) else int(i)), n) for i, n in zip(begun.doc_id, begun.doc_tokens)) == whole
    used = 0
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert (s.offset.to_numpy() == np.cumsum(s.length) - s.length).all()
        n = s.length.sum()
        assert n <= 4096
        used += n if n & (n - 1) == 0 else 4096
    assert used <= got.length.sum() * 1.03 + 2048 * 8
    one = got[(got.doc_tokens == max(map(len, ids))) & (got.doc_id == 11)].sort_values("start")
    x = max(ids, key=len)
    assert (one.start.to_numpy() == np.cumsum(one.length) - one.length).all()
    assert [K.crc32_of_ids(x[a:a + n]) for a, n in zip(one.start, one.length)] == one.ids_crc32.tolist()
    assert packing.pack_documents(docs_of([]), path).collect() == []


def test_perfect_hash():
    keys = np.arange(-500, 4500) * 977
    h = token_store.key_hashes(keys, np.zeros(5000, np.int64))
    mph = token_store.PerfectHash.from_bytes(token_store.PerfectHash.build(h).to_bytes())
    assert sorted(mph.slots(h)) == list(range(5000))
    assert token_store.PerfectHash.build(h[:0]).slots(h[:3]).tolist() == [-1, -1, -1]


def test_token_store(spark, docs_of):
    rows = [(i * 7 - 20, t) for i, t in enumerate(TEXTS * 3)] + [(None, "n"), (1, "copy"), (1, "copy"), (1, "other copy")]
    path, file = scratch_path(spark, "store"), tokenizers.path("byte_bpe_50k.json")
    token_store.write_token_store(docs_of(rows), path, file, shard_bytes=2000)
    enc = K.Encoder(file)
    ids = {}
    for i, t in rows:
        x = enc.encode([t or ""])[0]
        ids.setdefault(i, []).append(np.append(x, x.dtype.type(2)))
    got = token_store.read_documents(spark, path).toPandas().sort_values("start")
    assert (got.start.to_numpy() == np.cumsum(got.n_tokens) - got.n_tokens).all()
    order = [None if pd.isna(i) else int(i) for i in got.doc_id]
    assert order == sorted((i for i, _ in rows), key=lambda i: -10 ** 9 if i is None else i)
    for i in set(order):
        mine = got[got.doc_id.isna()] if i is None else got[got.doc_id == i]
        assert sorted(mine.ids_crc32) == sorted(K.crc32_of_ids(x) for x in ids[i])
    found = {r.doc_id: r.ids for r in token_store.lookup(spark, path, [1, 8, -20, 5, 10 ** 9]).collect()}
    assert sorted(found) == [-20, 1, 8] and found[8] == ids[8][0].tolist()
    empty = scratch_path(spark, "store")
    token_store.write_token_store(docs_of([]), empty, file)
    assert token_store.read_documents(spark, empty).collect() == []
    assert token_store.lookup(spark, empty, [1]).collect() == []


@pytest.mark.parametrize("shard_bytes", [1, 60, 1 << 20])
def test_lookup_returns_every_copy(spark, docs_of, shard_bytes):
    file = tokenizers.path("byte_bpe_50k.json")
    rows = [(i, f"text {i} {k}") for i in range(6) for k in range(1 + 3 * (i % 3))]
    path = scratch_path(spark, "store")
    token_store.write_token_store(docs_of(rows), path, file, shard_bytes=shard_bytes)
    got = token_store.lookup(spark, path, [1, 2, 3, 77]).collect()
    assert sorted(r.doc_id for r in got) == [1] * 4 + [2] * 7 + [3]
    assert len({tuple(r.ids) for r in got}) == 12


# --------------------------------------------------- pages with other articles
def test_body_outside_the_article_elements():
    body = [f"Paragraph {k} of the story has a good number of words in it, as stories have." for k in range(6)]
    story = "<div class='story'>" + "".join(f"<p>{b}</p>" for b in body) + "<p>End.</p></div>"
    cards = "".join(f"<article class='card'><h3>Other story {k}</h3><p>A few words on it.</p></article>" for k in range(9))
    comments = "".join(f"<article class='comment' id='c{k}'><p>{'I read all of this story and liked it. ' * 40}</p></article>"
                       for k in range(3))
    want = " ".join(body) + " End."
    assert html_text.main_text(f"<body>{story}{cards}</body>") == want
    assert html_text.main_text(f"<body>{cards}{story}</body>") == want
    assert html_text.main_text(f"<body>{story}{comments}</body>") == want
    whole = f"<article class='post has-sidebar'>{story}</article>"
    assert html_text.main_text(f"<body>{whole}{comments}<div>Imprint</div></body>") == want
    assert html_text.main_text(f"<body>{story}<article>{story}</article></body>") == want + " " + want


# ------------------------------------------------------------------ scoring
def direct_tree(train, depth, share):
    """Counts of the kept contexts, and a plain recursive predictor."""
    data = [bytes([255] * depth) + b" ".join(w) + b"\xff" for w in train]
    counts = collections.defaultdict(collections.Counter)
    total = 0
    for x in data:
        for k in range(depth, len(x)):
            total += 1
            for d in range(depth + 1):
                counts[x[k - d:k]][x[k]] += 1
    kept = {c for c, m in counts.items() if not c or sum(m.values()) >= share * total}
    return counts, kept


def log_kt(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)


def test_tree_against_recursion():
    rng = random.Random(3)
    train = [[bytes(rng.choice([b"ab", b"abc", b"ca", b"bab"])) for _ in range(30)] for _ in range(20)]
    depth, share = ctw.DEPTH, 0.01
    counts, kept = direct_tree(train, depth, share)
    rows = [(len(c), int.from_bytes(c, "big"), x, n) for c in kept for x, n in counts[c].items()]
    m = ctw.build_model(pd.DataFrame(rows, columns=["depth", "context", "byte", "n"]))

    def split(counter, node, level):
        z = o = 0
        for x, n in counter.items():
            if (x | 256) >> (8 - level) == node:
                if x >> (7 - level) & 1:
                    o += n
                else:
                    z += n
        return z, o

    def rest(c):
        left = collections.Counter(counts[c])
        for k in kept:
            if len(k) == len(c) + 1 and k[1:] == c:
                left.subtract(counts[k])
        return left

    def weighted(c, node, level):
        own = log_kt(*split(counts[c], node, level))
        if len(c) == depth:
            return own
        below = log_kt(*split(rest(c), node, level)) + sum(weighted(k, node, level) for k in kept
                                                           if len(k) == len(c) + 1 and k[1:] == c)
        return math.log(0.5) + max(own, below) + math.log1p(math.exp(-abs(own - below)))

    def predict(history, d, node, level, above):
        c = history[len(history) - d:]
        z, o = split(counts[c], node, level)
        if d and z + o == 0:
            return above
        one = (o + .5) / (z + o + 1)
        if d == depth:
            return one
        w = 0.5 * math.exp(log_kt(z, o) - weighted(c, node, level))
        longer = history[len(history) - d - 1:]
        if longer in kept:
            return w * one + (1 - w) * predict(history, d + 1, node, level, one)
        z, o = split(rest(c), node, level)
        return w * one + (1 - w) * ((o + .5) / (z + o + 1) if z + o else one)

    for w in (train[0][:4], [b"zz", b"ab"], []):
        x = bytes([255] * depth) + b" ".join(w) + b"\xff"
        want = 0.0
        for k in range(depth, len(x)):
            for level in range(8):
                p = predict(x[:k], 0, (x[k] | 256) >> (8 - level), level, 0.5)
                want += math.log10(p if x[k] >> (7 - level) & 1 else 1 - p)
        data, begins = ctw._stream([w])
        assert math.isclose(m.score(data, begins)[0], want, rel_tol=1e-4), w
    # probabilities of all bytes sum to one
    assert np.allclose((10.0 ** m.table.astype(np.float64)).sum(axis=1), 1, atol=1e-4)


@pytest.mark.parametrize("common", [1e-6, 0.02])
def test_scoring(spark, docs_of, common):
    rng = random.Random(11)
    rows = [(0, None), (1, ""), (None, "Null id"), (2, "THE the\x0bThe É é"), (3, "new" * 3000)]
    rows += [(i, " ".join(rng.choice(["the", "cat", "sat", "on", f"w{i % 40}", f"v{i}"]) for _ in range(rng.randrange(1, 50))))
             for i in range(4, 150)]
    rows += [rows[9]] * 2
    got = ctw.score_documents(docs_of(rows), params=ctw.ContextTree(common=common, slice_bytes=2000)).collect()
    c = collections.Counter()
    words = [(t or "").encode().lower().split() for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    for w, h in zip(words, held):
        if not h:
            c.update(w + ["end"])
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), h, len(w) + 1, sum(c[x] > 0 for x in w + ["end"]), n,
                   round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w + ["end"]), 6))
                  for (i, _), w, h in zip(rows, words, held))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and r.bits_per_byte > 0 for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(math.log10(1 / 256) * (10 * r.n_tokens) for r in out)
    assert ctw.score_documents(docs_of([])).collect() == []


def test_tree_of_a_sure_corpus_stays_finite():
    rows = [(d, int.from_bytes(b"a" * d, "big"), 97, 10 ** 12) for d in range(ctw.DEPTH + 1)]
    m = ctw.build_model(pd.DataFrame(rows, columns=["depth", "context", "byte", "n"]))
    assert np.isfinite(m.table).all() and np.allclose((10.0 ** m.table.astype(np.float64)).sum(axis=1), 1, atol=1e-4)


@pytest.mark.parametrize("hot", [2.5e-7, 1e-3, 1.0])
def test_every_context_counts(spark, docs_of, hot):
    """Scores are those of the whole tree, contexts of a single occurrence included."""
    rng = random.Random(17)
    rows = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(60)))
            for i in range(500)] + [(500, "é abcd " * 9), (501, None)]
    train = [ctw.words_of(t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    data, begins = ctw._stream(train)
    assert len(data) > 100_000  # one in 50,000 is more than a single occurrence
    counts = collections.Counter()
    for a in ctw._own(data, begins):
        for d in range(ctw.DEPTH + 1):
            counts[d, int.from_bytes(data[a - d:a].tobytes(), "big"), int(data[a])] += 1
    whole = ctw.build_model(pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["depth", "context", "byte", "n"]))
    want = {i: float(whole.score(*ctw._stream([ctw.words_of(t)]))[0]) for i, t in rows}
    got = ctw.score_documents(docs_of(rows), params=ctw.ContextTree(hot=hot, slice_bytes=20_000)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.score - want[r.doc_id]) < 1e-4 * abs(want[r.doc_id]), r


def test_a_full_memory_of_pieces_keeps_one_dict(monkeypatch):
    import sys

    import public_tokenizers
    from vidlens.llm import tokens
    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(tokens, "CACHED_PIECES", 5)
    enc, calls = tokens.Encoder(path), []
    texts = [" ".join(f"word{i * j % 97}x" for i in range(60)) for j in range(1, 8)] + ["", "one two"]
    want = [enc.lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in enc.encode(texts[:2])] == want[:2]
    held = dict(enc.known)
    sys.setprofile(lambda frame, event, arg: calls.append(frame.f_code.co_name) if event == "call" else None)
    try:
        got = enc.encode(texts)
    finally:
        sys.setprofile(None)
    assert [x.tolist() for x in got] == want
    assert enc.known == held and "__missing__" not in calls


class _Task:
    """Stands for the task's context where an operator's task function runs by itself."""

    @staticmethod
    def get():
        return _Task()

    def partitionId(self):
        return 0


class _Value:
    def __init__(self, value):
        self.value = value


def test_scoring_holds_a_small_slice(monkeypatch):
    """A batch of many texts is scored in slices that take little memory, with the rows of one slice."""
    import pyarrow as pa
    rng = random.Random(23)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(1000)) for _ in range(800)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts, "held_out": [False] * len(texts)})
    assert sum(len(t or "") for t in texts) > 3_500_000
    monkeypatch.setattr(ctw, "TaskContext", _Task)
    empty = _Value((np.empty(0, np.int64), np.empty(0))), _Value((np.empty(0, np.uint64), np.empty(0)))
    keys, rows = ("doc_id", "n_tokens", "n_bytes", "grams", "gram_tf", "words", "word_tf"), []
    for p in (ctw.ContextTree(), ctw.ContextTree(score_bytes=4_000_000)):
        rows.append([tuple(r[k] for k in keys) for x in ctw._score(p, *empty)([batch]) for r in x.to_pylist()])
    assert rows[0] == rows[1] and len(rows[0]) == len(texts)
    calls = []
    real = ctw._stream
    monkeypatch.setattr(ctw, "_stream", lambda docs: calls.append(sum(len(w) + 1 for d in docs for w in d)) or real(docs))
    list(ctw._score(ctw.ContextTree(), *empty)([batch]))
    assert max(calls) < 1_010_000


def test_packing_encodes_a_slice_at_a_time(monkeypatch):
    """Of an Arrow batch only a slice is held as strings; the pieces are those of any slice."""
    import pyarrow as pa
    path = tokenizers.path("word_bpe_49k.json")
    texts = ["", None] + [f"some words, number {i}. " * 300 for i in range(400)] + ["last"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [str(i) for i in range(len(texts))], "text": texts})
    monkeypatch.setattr(packing, "TaskContext", _Task)
    seen, real = [], K.Encoder.encode
    monkeypatch.setattr(K.Encoder, "encode", lambda self, x: seen.append(sum(map(len, x))) or real(self, x))
    run = packing._pack(path, packing.Packing(chunk=50_000))
    rows = [r for x in run(iter([batch])) for r in x.to_pylist()]
    assert len(seen) > 2 and max(seen) < packing._SLICE_CHARS + 10_000
    monkeypatch.setattr(packing, "_SLICE_CHARS", 10)
    assert [r for x in run(iter([batch])) for r in x.to_pylist()] == rows
    assert [r["doc_id"] for r in rows if r["start"] == 0] == [str(i) for i in range(len(texts))]


def test_arrow_batches_of_texts_are_bounded(spark, docs_of):
    """Python tasks get few megabytes of texts at a time, unless the session has its own bound."""
    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(conf, None)
    spark.conf.unset(conf)
    try:
        df = docs_of([(i, "x" * 100_000) for i in range(400)]).coalesce(1).cache()
        packing.pack_documents(df, tokenizers.path("word_bpe_49k.json"))
        most = df.select("text").mapInArrow(
            lambda batches: (b.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").agg({"n": "max"}).first()[0]
        assert most < 9_000_000
        spark.conf.set(conf, "1m")
        packing.pack_documents(df, tokenizers.path("word_bpe_49k.json"))
        assert spark.conf.get(conf) == "1m"
    finally:
        spark.conf.unset(conf) if held is None else spark.conf.set(conf, held)
