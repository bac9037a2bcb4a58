"""Periodic run detection: maximal pairs of an LCP-interval tree."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlens.llm.common import crc32_sql, id_crc, split_words, words_sql
from vidlens.llm.shingles import mix

#: Fewest words of a run.
MIN_LENGTH = 12
#: Documents of a task are worked on together until they hold this many words.
CHUNK_WORDS = 200_000
#: Positions in a block of a sorted list; a block of twice the size is halved.
BLOCK = 1024
RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")


class _Places:
    """The positions below an LCP interval in ascending order, in blocks, so that adding one stays cheap."""

    __slots__ = ("blocks", "last", "size")

    def __init__(self, place: int):
        self.blocks, self.last, self.size = [[place]], [place], 1

    def add(self, place: int) -> None:
        k = min(bisect_left(self.last, place), len(self.last) - 1)
        block = self.blocks[k]
        insort(block, place)
        self.last[k] = block[-1]
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[k:k + 1] = [block[:BLOCK], block[BLOCK:]]
            self.last[k:k + 1] = [block[BLOCK - 1], block[-1]]

    def beyond(self, place: int) -> int | None:
        """The smallest position greater than ``place``."""
        k = bisect_right(self.last, place)
        if k == len(self.last):
            return None
        block = self.blocks[k]
        return block[bisect_right(block, place)]

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def _sorted_suffixes(words: np.ndarray, ends: np.ndarray, seed: int):
    """Suffixes that share their first ``seed`` words with another one of their document.

    ``words`` are numbers, documents one after the other with -1 before the
    first and after each; ``ends`` is the position of the -1 behind a word's
    document.  Returns the suffixes' positions in lexical order (documents
    apart) and what each has in common with the one before it (0: less than
    ``seed`` words).
    """
    none = np.zeros(0, np.int64)
    n = len(words)
    if n <= seed:
        return none, none
    grams = mix(ends[:n - seed + 1].astype(np.uint64))
    for k in range(seed):
        grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + words[k:n - seed + 1 + k].astype(np.uint64))
    places = np.flatnonzero((words[:n - seed + 1] >= 0) & (np.arange(n - seed + 1) + seed <= ends[:n - seed + 1]))
    grams = grams[places]
    order = np.argsort(grams, kind="stable")
    equal = grams[order[1:]] == grams[order[:-1]]
    again = np.zeros(len(places), bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    here = places[again]
    if not len(here):
        return none, none
    # the rank of the first seed words, also of the suffixes right behind one of those
    ranked = np.union1d(here, np.minimum(here + seed, ends[here]))
    ranked = ranked[words[ranked] >= 0]
    key = ends[ranked]
    for k in range(seed):
        word = words[np.minimum(ranked + k, ends[ranked])]
        key = np.unique(key * (int(words.max()) + 3) + word + 1, return_inverse=True)[1]
    levels, reach = [], seed
    rank = np.zeros(n + 1, np.int64)
    while True:
        rank[ranked] = key + 1
        levels.append((reach, rank.copy()))
        if key.max() + 1 == len(ranked):
            break
        behind = rank[np.minimum(ranked + reach, n)]
        key = np.unique((key + 1) * (len(ranked) + 2) + behind, return_inverse=True)[1]
        reach *= 2
    here = here[np.argsort(rank[here])]
    a, b = here[:-1], here[1:]
    common = np.zeros(len(a), np.int64)
    for reach, level in reversed(levels):
        x, y = level[np.minimum(a + common, n)], level[np.minimum(b + common, n)]
        common += np.where((x == y) & (x > 0), reach, 0)
    open_ = common >= seed
    common[~open_] = 0
    for _ in range(seed - 1):
        x, y = words[np.minimum(a + common, n - 1)], words[np.minimum(b + common, n - 1)]
        open_ &= (x == y) & (x >= 0)
        common += open_
    return here, np.concatenate([[0], common])


def _maximal_pairs(places: np.ndarray, common: np.ndarray, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(i, j, length)``: equal stretches at ``i < j``, no farther apart than they are long, that no word extends.

    The tree of LCP intervals is built bottom-up with a stack.  Where two
    children of an interval of ``length`` meet, their right words differ; a
    pair counts if the left words differ as well.  A child's positions are one
    sorted list in which the left word tells the class.  Three occurrences
    within ``length`` are a progression by the smallest period, all of one
    class but its first, all with one right word but its last.  So a position
    can pair only with the nearest one beyond it and with the first one within
    reach before it, and the smaller child is looked up in the larger.
    """
    left = words[places - 1].tolist()
    cls = dict(zip(places.tolist(), left))
    starts, ahead = places.tolist(), common[1:].tolist() + [0]
    stack: list[tuple[int, _Places]] = []

    def join(a: _Places, b: _Places, length: int, out: list) -> _Places:
        if a.size < b.size:
            a, b = b, a
        for p in b:
            j = a.beyond(p)
            if j is not None and j - p <= length and cls[j] != cls[p]:
                out.append((p, j, length))
            i = a.beyond(p - length - 1)
            if i is not None and i < p and cls[i] != cls[p]:
                out.append((i, p, length))
        for p in b:
            a.add(p)
        return a

    found: list[tuple[int, int, int]] = []
    for start, depth in zip(starts, ahead):
        node = _Places(start)
        while stack and stack[-1][0] > depth:
            length, below = stack.pop()
            node = join(below, node, length, found)
        if stack and stack[-1][0] == depth:
            stack[-1] = (depth, join(stack[-1][1], node, depth, found))
        elif depth:
            stack.append((depth, node))
        if found:
            yield from found
            found.clear()


def find_runs(documents: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """The runs ``(start, length, period)`` of each document, in order."""
    numbers: dict = defaultdict()
    numbers.default_factory = numbers.__len__
    sizes = [len(d) for d in documents]
    firsts = np.cumsum([1] + [s + 1 for s in sizes[:-1]]) if sizes else np.zeros(0, np.int64)
    total = sum(sizes) + len(sizes) + 1
    words, ends = np.full(total, -1, np.int64), np.zeros(total, np.int64)
    for first, doc in zip(firsts.tolist(), documents):
        words[first:first + len(doc)] = np.fromiter(map(numbers.__getitem__, doc), np.int64, len(doc))
        ends[first:first + len(doc) + 1] = first + len(doc)
    places, common = _sorted_suffixes(words, ends, max(1, (min_length + 1) // 2))
    periods: dict[tuple[int, int], int] = {}
    for i, j, length in _maximal_pairs(places, common, words):
        if j - i + length >= min_length:
            span = (i, j + length)
            periods[span] = min(periods.get(span, j - i), j - i)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    for (start, end), period in periods.items():
        k = int(np.searchsorted(firsts, start, side="right")) - 1
        runs[k].append((start - int(firsts[k]), end - start, period))
    for r in runs:
        r.sort(key=lambda x: (x[0], x[2]))
    return runs


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that are in no run after its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join(w for w, k in zip(words, keep.tolist()) if k)


def _task(batches, columns: list[str], min_length: int):
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("_bytes"))
        runs, collapsed, chunk, held = [], [], [], 0

        def work():
            found = find_runs(chunk, min_length)
            runs.extend([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in found])
            collapsed.extend(collapse(d, rs) for d, rs in zip(chunk, found))
            chunk.clear()

        for text in texts:
            words = (text.as_py() or b"").split()
            chunk.append(words)
            held += len(words)
            if held >= CHUNK_WORDS:
                work()
                held = 0
        work()
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(c)) for c in columns]
            + [pa.array(runs, runs_type), pa.array(collapsed, pa.binary())], names=[*columns, "runs", "_collapsed"])


def periodic_runs(df: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """The runs of every text, and the text with each run cut to its first period.

    Words stand between spaces, tabs, LF, VT, FF and CR, numbered from 0.  A
    run is a stretch of words with smallest period ``q`` (words ``q`` apart are
    identical), at least ``max(min_length, 2 * q)`` long, that no neighbouring
    word extends.  A word goes from ``collapsed`` if any run holds it after
    that run's first ``q`` words.

    All columns of ``df`` are returned, plus ``runs`` (array of ``start``,
    ``length``, ``period`` by start, then period) and ``collapsed`` (kept words
    joined by one space); existing columns of these names are replaced.  A null
    or empty text, or one without words, has no runs and collapses to the empty
    string; repeated rows are each worked on; an empty table gives an empty
    result.  A run of one word is a run of period 1.

    Documents are independent, so there is no shuffle.  A run of period ``q``
    is a maximal pair of stretches ``q`` apart and at least ``q`` long, hence
    only positions whose next ``min_length / 2`` words occur again in the
    document are sorted (prefix doubling over the words of many documents at
    once).  Work is near-linear in these also for a text of one repeated word.
    """
    columns = [c for c in df.columns if c not in ("runs", "collapsed")]
    rows = df.select(*columns, F.col(text_col).cast("binary").alias("_bytes"))
    out = df.select(*columns).schema.add("runs", T.ArrayType(RUN)).add("_collapsed", "binary")
    found = rows.mapInArrow(lambda batches: _task(batches, columns, min_length), out)
    return found.select(*columns, "runs", F.col("_collapsed").cast("string").alias("collapsed"))


def repeat_tails(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every tenth document by the crc32 of its id gets a periodic tail, made of its own words.

    ``h`` is the crc32, ``g = h // 10``; with ``h % 10 = 0`` and ``n`` words,
    each word from ``a = g % n`` on becomes word ``a + (i - a) % p``, where
    ``p = 1 + (n - a) // (3 + g % 8)``.  Other texts, null ids and texts
    without words stay as they are.
    """
    h, words = id_crc(F.col(id_col)), split_words(F.col(text_col))
    n, g = F.size("_words"), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - F.col("_a")) / (F.lit(3) + g % 8))).cast("int")
    tail = F.transform(F.sequence(F.col("_a"), n - 1), lambda i: F.element_at(
        "_words", F.col("_a") + (i - F.col("_a")) % F.col("_p") + 1))
    new = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a")), tail), " ")
    edit = (h % 10 == 0) & (F.size(words) > 0)
    steps = (df.withColumn("_words", F.when(edit, words)).withColumn("_a", F.when(F.col("_words").isNotNull(), a))
             .withColumn("_p", F.when(F.col("_words").isNotNull(), p)))
    return (steps.withColumn(text_col, F.when(F.col("_words").isNotNull(), new).otherwise(F.col(text_col)))
            .drop("_words", "_a", "_p"))


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period) and hashes of runs and collapsed text."""
    def minus(c: Column) -> Column:
        return -c
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), minus(r["start"]).alias("s"), minus(r["period"]).alias("p"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    rows = found.select(id_col, F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return rows.select(id_col, "n_runs", (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
                       (-F.col("best.p")).alias("period"),
                       F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.p")).cast("long").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


ORACLE_SQL = f"""with w as (select doc_id, {words_sql('text')} as ws, {crc32_sql('cast(doc_id as varchar)')} as h from documents),
t as (select doc_id, case when h % 10 = 0 and len(ws) > 0 then list_transform(range(len(ws)), lambda i:
        case when i < (h // 10) % len(ws) then ws[i + 1]
             else ws[(h // 10) % len(ws) + (i - (h // 10) % len(ws))
                     % (1 + (len(ws) - (h // 10) % len(ws)) // (3 + (h // 10) % 8)) + 1] end) else ws end as ws from w),
k as (select doc_id, i, array_to_string(ws[i + 1:i + 6], ' ') as gram
      from (select doc_id, ws, unnest(range(len(ws) - 5)) as i from t where len(ws) > 5)),
p as (select a.doc_id, a.i, b.i - a.i as d from k a join k b on a.doc_id = b.doc_id and a.gram = b.gram and a.i < b.i),
s as (select doc_id, d, min(i) as b, count(*) + 5 as l
      from (select *, i - row_number() over (partition by doc_id, d order by i) as run from p) group by doc_id, d, run),
r as (select doc_id, b, d + l as n, min(d) as q from s where l >= d and d + l >= 12 group by doc_id, b, d + l),
g as (select doc_id, count(*) as n_runs, max((n, -b, -q)) as best,
             string_agg(concat(b, ',', n, ',', q, chr(10)), '' order by b, q) as listed from r group by doc_id),
x as (select doc_id, unnest(ws) as word, unnest(range(len(ws))) as i from t),
c as (select distinct doc_id, unnest(range(b + q, b + n)) as i from r),
y as (select x.doc_id, string_agg(x.word, ' ' order by x.i) as text
      from x left join c on x.doc_id = c.doc_id and x.i = c.i where c.i is null group by x.doc_id)
select t.doc_id, coalesce(g.n_runs, 0) as n_runs, -best[2] as start, best[1] as length, -best[3] as period,
       cast(1000 * best[1] // -best[3] as bigint) as exponent_milli,
       sha256(coalesce(listed, '')) as runs_sha256, sha256(coalesce(y.text, '')) as collapsed_sha256
from t left join g on t.doc_id = g.doc_id left join y on t.doc_id = y.doc_id"""
