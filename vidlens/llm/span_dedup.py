"""Substring dedup: repeated edges of the De Bruijn graph of word windows, compacted into paths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlens.llm.common import stored, words_sql
from vidlens.llm.shingles import mix, word_hashes

#: Words of a window: an edge of the graph, from its first to its last ``WINDOW - 1`` words.
WINDOW = 35
#: Least words of the anchor by which a path is found.
ANCHOR = 8
#: Documents of a task are hashed together until they hold this many words.
CHUNK_WORDS = 400_000
_M = np.uint64(0x9E3779B97F4A7C15)


class _Hashes:
    """Hashes of all stretches of words that start at each place, for any length up to twice ``reach``."""

    def __init__(self, words: np.ndarray, reach: int):
        self.levels = [mix(words + _M)]
        while 2 ** len(self.levels) <= reach:
            half = 2 ** (len(self.levels) - 1)
            last = self.levels[-1]
            self.levels.append(mix(last[:max(len(last) - half, 0)] * _M + last[half:]))

    def at(self, places: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        """The hash of ``lengths`` words at ``places``: two overlapping stretches and the length."""
        if isinstance(lengths, int):
            level = min(lengths.bit_length(), len(self.levels)) - 1
        else:
            level = len(self.levels) - 1
        h, size = self.levels[level], 2 ** level
        return mix(h[places] * _M + h[places + lengths - size] + np.asarray(lengths, np.uint64))


def _anchor_size(window: int) -> int:
    """Two overlapping stretches of the largest power of two must cover every path, so the anchor may be longer."""
    return min(window, max(ANCHOR, 2 * (window - 2 ** (window.bit_length() - 1))))


def _paths(documents: list[list[bytes]], window: int):
    """``(document, start, edges, anchor hash, path hash)`` of the paths of all documents.

    A path is a longest row of consecutive windows with the same anchor: the
    stretch of ``_anchor_size`` words with the smallest hash in the window,
    the first of equals.  A window's anchor follows from its words alone.
    """
    anchor = _anchor_size(window)
    sizes = np.array([len(d) for d in documents], np.int64)
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = word_hashes([w for d in documents for w in d])
    edges = np.maximum(sizes - window + 1, 0)
    total = int(edges.sum())
    if not total:
        return None
    hashes = _Hashes(flat, window)
    least = hashes.at(np.arange(len(flat) - anchor + 1), anchor)
    place = np.arange(len(least))
    span, need = 1, window - anchor + 1
    while span < need:
        step = min(span, need - span)
        a, b = least[:len(least) - step], least[step:]
        place = np.where(b < a, place[step:], place[:len(place) - step])
        least = np.minimum(a, b)
        span += step
    document = np.repeat(np.arange(len(documents)), edges)
    before = np.concatenate([[0], np.cumsum(edges)[:-1]])
    starts = np.arange(total) - before[document] + firsts[document]
    place = place[starts]
    head = np.ones(total, bool)
    head[1:] = (place[1:] != place[:-1]) | (document[1:] != document[:-1])
    head = np.flatnonzero(head)
    counts = np.diff(np.append(head, total))
    return (document[head], starts[head] - firsts[document[head]], counts,
            hashes.at(place[head], anchor), hashes.at(starts[head], counts + window - 1))


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[bytes]]]]:
    """The words of a batch's texts, some documents at a time, with the place of the first."""
    texts, first, held, chunk = batch.column(batch.schema.get_field_index("_bytes")), 0, 0, []
    for k, text in enumerate(texts):
        chunk.append((text.as_py() or b"").split())
        held += len(chunk[-1])
        if held >= CHUNK_WORDS:
            yield first, chunk
            first, held, chunk = k + 1, 0, []
    if chunk:
        yield first, chunk


def _path_task(batches, window: int):
    for batch in batches:
        for first, documents in _chunks(batch):
            found = _paths(documents, window)
            if found is None:
                continue
            document, start, edges, key, body = found
            row = pa.array(document + first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(start), pa.array(edges), _signed(key), _signed(body)],
                names=["id", "th", "start", "edges", "key", "body"])


def _edge_task(batches, window: int):
    """The hashes of each window of the listed paths."""
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("paths"))
        for first, documents in _chunks(batch):
            hashes = _Hashes(word_hashes([w for d in documents for w in d]), window)
            at, rows, out = 0, [], []
            for k, words in enumerate(documents):
                for path in lists[first + k].as_py():
                    rows.append(first + k)
                    out.append((path["start"], path["key"], path["single"],
                                hashes.at(at + path["start"] + np.arange(path["edges"]), window).view(np.int64)))
                at += len(words)
            if rows:
                starts, keys, single, edges = zip(*out)
                row = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(starts, pa.int64()), pa.array(keys, pa.int64()),
                     pa.array(single, pa.bool_()), pa.array(edges, pa.list_(pa.int64()))],
                    names=["id", "th", "start", "key", "single", "edges"])


def _cut_task(batches, columns: list[str]):
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("_bytes"))
        spans = batch.column(batch.schema.get_field_index("_spans"))
        kept, before, removed = [], [], []
        for text, spans_ in zip(texts, spans):
            words = (text.as_py() or b"").split()
            before.append(len(words))
            if spans_.is_valid:
                keep = np.ones(len(words), bool)
                for s in spans_.as_py():
                    keep[s["start"]:s["stop"]] = False
                words = [w for w, k in zip(words, keep.tolist()) if k]
            removed.append(before[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(c)) for c in columns]
            + [pa.array(kept, pa.binary()), pa.array(before, pa.int64()), pa.array(removed, pa.int64())],
            names=[*columns, "_kept", "n_words", "n_removed"])


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"),
                     F.col(text_col).cast("binary").alias("_bytes"))


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(id, th, start, stop)``: word spans that are made of repeated windows.

    Every ``window`` consecutive words are an edge between two nodes of
    ``window - 1`` words.  Consecutive edges with one anchor are a path, and
    equal edges have equal anchors, so only paths whose anchor occurs again
    can hold a repeated edge.  Joined by anchor, a path is nonbranching if all
    paths with its anchor are equal: then it counts as a whole.  Where paths
    branch, equal ones still count as a whole, and one of each is opened into
    its edges, which are counted by themselves.  The source coordinates
    ``(id, hash of the text, first word)`` carried along name the spans.

    Paths and edges are told apart by two 64-bit hashes (of the anchor, and of
    all words).  Every count is a partial aggregate; every join has a unique
    side, so a passage found in a third of all documents is split.
    """
    docs = _documents(df, id_col, text_col)
    schema = "id long, th long, start long, edges long, key long, body long"
    paths = docs.mapInArrow(lambda batches: _path_task(batches, window), schema)
    anchors = paths.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("body").alias("lo"), F.max("body").alias("hi")) \
        .where("n > 1").select("key", (F.col("lo") != F.col("hi")).alias("branches"))
    found = stored(paths.join(anchors, "key"), "paths")
    whole = found.where("not branches")
    branching = found.where("branches")
    bodies = stored(branching.groupBy("key", "body").agg(
        (F.count(F.lit(1)) == 1).alias("single"), F.min(F.struct("id", "th", "start", "edges")).alias("one")), "bodies")
    whole = whole.select("id", "th", "start", "edges").unionByName(
        branching.join(bodies.where("not single").select("key", "body"), ["key", "body"]).select("id", "th", "start", "edges"))
    listed = bodies.groupBy(F.col("one.id").alias("_id"), F.col("one.th").alias("_th")).agg(F.collect_list(F.struct(
        F.col("one.start").alias("start"), F.col("one.edges").alias("edges"), "key", "single")).alias("paths"))
    opened = docs.join(listed, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))) \
        .select("id", "th", "_bytes", "paths")
    opened = stored(opened.mapInArrow(lambda batches: _edge_task(batches, window),
                                      "id long, th long, start long, key long, single boolean, edges array<long>"), "edges")
    edges = opened.select("id", "th", "start", "key", "single", F.posexplode("edges").alias("place", "edge"))
    again = edges.groupBy("key", "edge").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "edge")
    singles = edges.where("single").join(again, ["key", "edge"]).select(
        "id", "th", (F.col("start") + F.col("place")).alias("start"), F.lit(1).cast("long").alias("edges"))
    return whole.unionByName(singles).select("id", "th", "start", (F.col("start") + F.col("edges") + window - 1).alias("stop"))


def span_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove each word that lies in a window of ``window`` words which starts anywhere else as well.

    Words stand between spaces, tabs, LF, VT, FF and CR and are compared
    unchanged.  Windows are judged on the input, all occurrences alike: none
    stays, and a window may repeat within its own document.  All columns of
    ``df`` are returned, ``text_col`` with its kept words joined by one space,
    plus ``n_words`` and ``n_removed`` (existing columns of these names are
    replaced).  Null text, empty text and text without words become the empty
    string with 0 words; a text of fewer words than a window keeps them all;
    repeated rows are occurrences of their own, null ids are ids like any
    other; an empty table gives an empty result.
    """
    columns = [c for c in df.columns if c not in ("n_words", "n_removed", text_col)]
    spans = repeated_spans(df, id_col, text_col, window).groupBy(F.col("id").alias("_id"), F.col("th").alias("_th")).agg(
        F.collect_set(F.struct("start", "stop")).alias("_spans"))
    rows = df.select(*columns, F.col(text_col).cast("binary").alias("_bytes"), F.xxhash64(text_col).alias("_own")).join(
        spans, F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_th")), "left")
    out = df.select(*columns).schema.add("_kept", "binary").add("n_words", "long").add("n_removed", "long")
    cut = rows.select(*columns, "_bytes", "_spans").mapInArrow(lambda batches: _cut_task(batches, columns), out)
    names = [c for c in df.columns if c not in ("n_words", "n_removed")]
    return cut.select(*[F.col("_kept").cast("string").alias(c) if c == text_col else c for c in names], "n_words", "n_removed")


ORACLE_SQL = f"""with w as (select doc_id, {words_sql('text')} as ws from documents),
k as (select doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') as edge
      from (select doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) as i from w where len(ws) >= {WINDOW})),
r as (select edge from k group by edge having count(*) > 1),
c as (select distinct k.doc_id, unnest(range(k.i, k.i + {WINDOW})) as i from k join r on k.edge = r.edge),
x as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from w),
y as (select x.doc_id, count(*) as kept, string_agg(x.word, ' ' order by x.i) as text
      from x left join c on x.doc_id = c.doc_id and x.i = c.i where c.i is null group by x.doc_id)
select w.doc_id, cast(len(w.ws) as bigint) as n_words, cast(len(w.ws) - coalesce(y.kept, 0) as bigint) as n_removed,
       sha256(coalesce(y.text, '')) as kept_sha256
from w left join y on w.doc_id = y.doc_id"""
