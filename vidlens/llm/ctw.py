"""LM scoring: context-tree weighting over bytes, beside a word unigram base."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlens.llm.common import NULL_ID, id_remainder, small_batches, stored
from vidlens.llm.shingles import word_hashes, words_of

#: Longest context in bytes (a gram of context and byte fits a long).
DEPTH = 5
#: A byte that UTF-8 never has: the end of a text, and the context before its start.
END = 0xFF
_HALF = float(np.log(0.5))
_ROWS = 512
#: Documents in a slice: a document's number stands beside the 48 bits of a gram.
_SLICE_DOCS = 1 << 16


@dataclass(frozen=True)
class ContextTree:
    """Parameters.

    Every context of the training text stands in the tree.  Words with at
    least ``common`` of all training tokens (at most ``1 / common``) and grams
    with at least ``hot`` of all bytes (at most ``1 / hot``) go to every task;
    the others are joined.  Slices of ``slice_bytes`` are counted and of
    ``score_bytes`` scored at a time: a larger slice sends fewer counts, while
    scores are the same for any slice and its arrays take many times its
    bytes.
    """

    common: float = 1e-6
    hot: float = 2.5e-7
    slice_bytes: int = 4_000_000
    score_bytes: int = 1_000_000


# ---------------------------------------------------------------- counting
def _lines(texts: list[str | None], most: int) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    """Documents' words, in slices of about ``most`` bytes and at most ``_SLICE_DOCS`` documents."""
    start, total, held = 0, 0, []
    for i, t in enumerate(texts):
        w = words_of(t)
        held.append(w)
        total += sum(map(len, w)) + len(w)
        if total >= most or len(held) == _SLICE_DOCS:
            yield start, i + 1, held
            start, total, held = i + 1, 0, []
    if held:
        yield start, len(texts), held


def _stream(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all documents and where each one's own begin; ``DEPTH`` end bytes stand before each."""
    pad, end = bytes([END]) * DEPTH, bytes([END])
    parts = [pad + b" ".join(w) + end for w in docs]
    ends = np.cumsum([len(x) for x in parts])
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.concatenate(([0], ends[:-1])) + DEPTH


def _own(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Positions of the documents' own bytes."""
    own = np.ones(len(data), dtype=bool)
    for k in range(1, DEPTH + 1):
        own[begins - k] = False
    return np.flatnonzero(own)


def _grams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Context and byte at each position: the nearest byte highest, so contexts of all depths sort together."""
    gram = data[at].astype(np.int64)
    for k in range(1, DEPTH + 1):
        gram |= data[at - k].astype(np.int64) << (8 * (DEPTH + 1 - k))
    return gram


#: Kinds of counted keys.
_GRAM, _WORD, _TEXTS = range(3)


def _count(p: ContextTree):
    """Grams of all documents (``n`` of training, ``m`` of all) and words of training documents."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = f["held_out"].to_numpy(dtype=bool)
            for a, b, docs in _lines(f["text"].tolist(), p.slice_bytes):
                data, begins = _stream(docs)
                at = _own(data, begins)
                held = np.repeat(out[a:b], np.diff(np.append(begins, len(data) + DEPTH)) - DEPTH)
                both, m = np.unique(_grams(data, at) << 1 | held, return_counts=True)
                yield pd.DataFrame({"kind": _GRAM, "key": both >> 1, "n": np.where(both & 1, 0, m), "m": m})
                train = [w for w, h in zip(docs, out[a:b]) if not h]
                words = np.concatenate([word_hashes(w) for w in train]) if train else np.empty(0, np.uint64)
                words, n = np.unique(words, return_counts=True)
                yield pd.DataFrame({"kind": _WORD, "key": words.view(np.int64), "n": n, "m": n})
                yield pd.DataFrame({"kind": _TEXTS, "key": [0], "n": [len(train)], "m": [len(train)]})
    return run


# ------------------------------------------------------------------- model
def _lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 0.5 (Stirling's series after eight steps up)."""
    low = np.ones_like(x)
    for k in range(8):
        low *= x + k
    y = x + 8
    r = 1 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(low)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability that the Krichevsky-Trofimov estimator gives n0 zeros and n1 ones."""
    if len(n0) > _ROWS:  # in parts, for the sake of the driver's memory
        return np.concatenate([log_kt(n0[a:a + _ROWS], n1[a:a + _ROWS]) for a in range(0, len(n0), _ROWS)])
    return _lgamma(n0 + 0.5) + _lgamma(n1 + 0.5) - _lgamma(n0 + n1 + 1.0) - float(np.log(np.pi))


def _bits(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at each of the 255 nodes of a byte's binary decomposition (1 to 255; 0 unused)."""
    n0, n1 = np.zeros_like(counts), np.zeros_like(counts)
    for level in range(8):
        both = counts.reshape(len(counts), 1 << level, 2, -1).sum(axis=3)
        n0[:, 1 << level:2 << level], n1[:, 1 << level:2 << level] = both[:, :, 0], both[:, :, 1]
    return n0, n1


class Model:
    """Log10 probability of every byte after every context of the tree.

    ``codes[d]`` are the sorted contexts of ``d`` bytes (the nearest byte
    lowest), rows follow them in order, the root first.
    """

    def __init__(self, codes: list[np.ndarray], table: np.ndarray):
        self.codes, self.table = codes, table
        self.child: np.ndarray | None = None

    def _children(self) -> np.ndarray:
        if self.child is None:
            total = sum(map(len, self.codes))
            self.child = np.full((total + 1, 256), total, dtype=np.int32)
            first = 0
            for d in range(1, len(self.codes)):
                start = first + len(self.codes[d - 1])
                up = np.searchsorted(self.codes[d - 1], self.codes[d] & ((1 << 8 * (d - 1)) - 1)) + first
                self.child[up, self.codes[d] >> 8 * (d - 1)] = np.arange(start, start + len(self.codes[d]))
                first = start
        return self.child

    def score(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Log10 probability of each document of the stream."""
        child, none = self._children(), len(self.table)
        at = _own(data, begins)
        logs = np.empty(len(at), dtype=np.float64)
        for a in range(0, len(at), 1 << 20):
            x = at[a:a + (1 << 20)]
            node = best = np.zeros(len(x), dtype=np.int32)
            for k in range(1, len(self.codes)):
                node = child[node, data[x - k]]
                best = np.where(node == none, best, node)
            logs[a:a + len(x)] = self.table[best, data[x]]
        return np.add.reduceat(logs, np.searchsorted(at, begins)) if len(begins) else np.empty(0)


def build_model(rows: pd.DataFrame) -> Model:
    """The tree weighted by its training counts ``(depth, context, byte, n)``, in one process (for small tables).

    Every binary node of a byte has a context tree of its own.  A context's
    weighted probability mixes, half and half, its own estimate and the product
    over its longer contexts; what belongs to no kept longer context is one
    more child.  The predictive probability is the mixture of the estimates of
    all depths by the weights that the counts leave; where a longer context
    was never seen at a node, the estimate above it stands.
    """
    codes, counts = [], []
    for d in range(DEPTH + 1):
        r = rows[rows["depth"] == d]
        c, inverse = np.unique(r["context"].to_numpy(np.int64), return_inverse=True)
        m = np.zeros((len(c), 256))
        m[inverse, r["byte"].to_numpy(np.int64)] = r["n"].to_numpy(np.float64)
        if d == 0 and not len(c):
            c, m = np.zeros(1, np.int64), np.zeros((1, 256))
        codes.append(c)
        counts.append(m)
    while len(codes) > 1 and not len(codes[-1]):
        codes.pop(), counts.pop()
    ups = [None] + [np.searchsorted(codes[d - 1], codes[d] & ((1 << 8 * (d - 1)) - 1)) for d in range(1, len(codes))]
    # from the longest contexts up: the weight of each own estimate, the
    # estimates, and what a context passes to the one above
    nodes: list[tuple] = [()] * len(codes)
    passed = deeper = None
    for d in range(len(codes) - 1, -1, -1):
        n0, n1 = _bits(counts[d])
        own = log_kt(n0, n1)
        one, new = (n1 + 0.5) / (n0 + n1 + 1.0), n0 + n1 > 0  # doubles: n can be far above 2 ** 24
        del n0, n1
        if d == DEPTH:
            nodes[d] = (np.float64(1), one, None, new)
            passed, deeper = own, counts[d]
            counts[d] = None
            continue
        below, left = np.zeros_like(own), counts[d].copy()
        if passed is not None:
            np.add.at(below, ups[d + 1], passed)
            np.subtract.at(left, ups[d + 1], deeper)
        r0, r1 = _bits(np.maximum(left, 0))
        below += log_kt(r0, r1)
        rest = np.where(r0 + r1 > 0, (r1 + 0.5) / (r0 + r1 + 1.0), one)
        del r0, r1, left
        weighted = np.logaddexp(_HALF + own, _HALF + below)
        nodes[d] = (np.exp(np.minimum(_HALF + own - weighted, 0.0)), one, rest, new)
        passed, deeper = weighted, counts[d]
        counts[d] = None
    del passed, deeper
    # from the root down: the mixture so far and the weight that is left
    table = []
    mixed = left = above = None
    for d, (w, one, rest, new) in enumerate(nodes):
        if d == 0:
            mixed, left = w * one, 1 - w * np.ones_like(one)
        else:
            m, r, a = mixed[ups[d]], left[ups[d]], above[ups[d]]
            mixed = np.where(new, m + r * w * one, m + r * a)
            left = np.where(new, r * (1.0 - w), 0.0)
        above = one
        final = mixed + left * (rest if rest is not None else one)
        logs = np.zeros((len(one), 256))
        byte = np.arange(256)
        for level in range(8):
            q = final[:, (1 << level) + (byte >> (8 - level))]
            logs += np.log10(np.where((byte >> (7 - level)) & 1, q, 1 - q))
        table.append(logs.astype(np.float32))
    return Model(codes, np.concatenate(table))


# ------------------------------------------------- the model over all contexts
#: Contexts up to this length (at most 65,536) are weighted on the driver; longer ones in tasks.
_SHALLOW = 2
_TOP = 8 * (DEPTH - _SHALLOW)  # a gram shifted right by this names its group, a context one longer than _SHALLOW
_GROUP_ROWS = 1 << 16
_LEVELS = np.arange(8)


def _groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted grams in parts that never cut a group."""
    held, size, most = [], 0, _GROUP_ROWS
    for f in frames:
        held.append(f)
        size += len(f)
        if size < most:
            continue
        f = pd.concat(held, ignore_index=True)
        group = f["key"].to_numpy() >> _TOP
        cut = int(np.searchsorted(group, group[-1]))
        if cut:
            yield f.iloc[:cut]
        held, size = [f.iloc[cut:]], len(f) - cut
        most = max(_GROUP_ROWS, 2 * size)
    if size:
        yield pd.concat(held, ignore_index=True)


class _Part:
    """The binary nodes of the contexts of some depths: ``at[d]`` sorted (context number, node), zeros and ones."""

    def __init__(self, codes: np.ndarray, at: np.ndarray, n0: np.ndarray, n1: np.ndarray, deep: int, shallow: int):
        self.deep, self.shallow = deep, shallow
        self.codes, self.at, self.n0, self.n1 = {deep: codes}, {deep: at}, {deep: n0}, {deep: n1}
        self.up: dict[int, np.ndarray] = {}
        for d in range(deep, shallow, -1):
            self.codes[d - 1], number = np.unique(self.codes[d] >> 8, return_inverse=True)
            self.at[d - 1], self.up[d] = np.unique(number[self.at[d] >> 8] << 8 | self.at[d] & 255, return_inverse=True)
            for n in (self.n0, self.n1):
                n[d - 1] = np.bincount(self.up[d], weights=n[d], minlength=len(self.at[d - 1]))

    def weigh(self, below: np.ndarray | None) -> np.ndarray:
        """From the longest contexts up: weights of the own estimates; returns what the shortest pass up."""
        self.weight = {}
        for d in range(self.deep, self.shallow - 1, -1):
            own = log_kt(self.n0[d], self.n1[d])
            if below is None:  # the longest context of all has but its own estimate
                self.weight[d], passed = np.ones(len(own)), own
            else:
                passed = np.logaddexp(_HALF + own, _HALF + below)
                self.weight[d] = np.exp(np.minimum(_HALF + own - passed, 0.0))
            if d > self.shallow:
                below = np.bincount(self.up[d], weights=passed, minlength=len(self.at[d - 1]))
        return passed

    def mix(self, state: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From the shortest contexts down: the mixture so far, the weight left and the own estimate."""
        for d in range(self.shallow, self.deep + 1):
            w, one = self.weight[d], (self.n1[d] + 0.5) / (self.n0[d] + self.n1[d] + 1.0)
            if state is None:
                state = w * one, 1 - w, one
                continue
            m, r, a = (x[self.up[d]] for x in state) if d > self.shallow else state
            new = self.n0[d] + self.n1[d] > 0
            state = np.where(new, m + r * w * one, m + r * a), np.where(new, r * (1.0 - w), 0.0), one
        return state


def _deep(key: np.ndarray, n: np.ndarray) -> tuple[_Part, np.ndarray, np.ndarray]:
    """The contexts longer than ``_SHALLOW`` of sorted grams; each gram's eight nodes and bits."""
    codes, number = np.unique(key >> 8, return_inverse=True)
    byte = (key & 255)[:, None]
    ones = (byte >> (7 - _LEVELS)) & 1
    at, node = np.unique((number[:, None] << 8 | (1 << _LEVELS) + (byte >> (8 - _LEVELS))).ravel(), return_inverse=True)
    n = n[:, None].astype(np.float64)
    n0, n1 = (np.bincount(node, weights=(n * x).ravel(), minlength=len(at)) for x in (1 - ones, ones))
    return _Part(codes, at, n0, n1, DEPTH, _SHALLOW + 1), node.reshape(-1, 8), ones


def _up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What the groups pass to the contexts of ``_SHALLOW`` bytes."""
    for f in _groups(frames):
        part, _, _ = _deep(f["key"].to_numpy(), f["n"].to_numpy())
        passed = part.weigh(None)
        d = part.shallow
        at, up = np.unique((part.codes[d][part.at[d] >> 8] >> 8) << 8 | part.at[d] & 255, return_inverse=True)
        n0, n1, below = (np.bincount(up, weights=x, minlength=len(at)) for x in (part.n0[d], part.n1[d], passed))
        yield pd.DataFrame({"at": at, "n0": n0, "n1": n1, "below": below})


def _down(shallow):
    """Log10 probability of the byte of every gram after its context."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        above, state = shallow.value
        for f in _groups(frames):
            key = f["key"].to_numpy()
            part, node, ones = _deep(key, f["n"].to_numpy())
            part.weigh(None)
            d = part.shallow
            at = np.searchsorted(above, (part.codes[d][part.at[d] >> 8] >> 8) << 8 | part.at[d] & 255)
            m, r, a = (x[at] for x in state)
            q = part.mix((m, r, a))[0][node]
            yield pd.DataFrame({"key": key, "m": f["m"].to_numpy(), "log": np.log10(np.where(ones, q, 1 - q)).sum(axis=1)})
    return run


def _gram_logs(counts: DataFrame) -> DataFrame:
    """``(key, m, log)`` of every gram of the table, trained or only scored.

    Contexts of three bytes and more are weighted in tasks, each with all the
    longer contexts that end in it; the sums that they pass on meet in one
    aggregate, and the contexts of at most two bytes are weighted here.
    """
    spark = counts.sparkSession
    grams = counts.where(F.col("kind") == _GRAM).select("key", "n", "m")
    dealt = grams.repartition(F.shiftright("key", _TOP)).sortWithinPartitions("key")
    rows = (dealt.mapInPandas(_up, "at long, n0 double, n1 double, below double")
            .groupBy("at").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("below").alias("below"))
            .toArrow().sort_by("at"))
    at, n0, n1, below = (rows[c].to_numpy() for c in ("at", "n0", "n1", "below"))
    codes, number = np.unique(at >> 8, return_inverse=True)
    part = _Part(codes, number << 8 | at & 255, n0, n1, _SHALLOW, 0)
    part.weigh(below)
    shallow = spark.sparkContext.broadcast((at, part.mix(None)))
    return stored(dealt.mapInPandas(_down(shallow), "key long, m long, log double"), "gram-logs")


# ----------------------------------------------------------------- scoring
SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, n_bytes long, "
          "words array<long>, word_tf array<int>, grams array<long>, gram_tf array<int>")


def _score(p: ContextTree, hot_grams, common):
    """A row a document: what the broadcast words and grams give, and the others with their counts."""
    names = [c.split()[0] for c in SCORED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, gram_logs = hot_grams.value
        words, logs = common.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            for a, b, docs in _lines(columns["text"].to_pylist(), min(p.slice_bytes, p.score_bytes)):
                data, begins = _stream(docs)
                n_bytes = np.diff(np.append(begins, len(data) + DEPTH)) - DEPTH
                # grams of each document and how often, by one sort
                both = _grams(data, _own(data, begins)).view(np.uint64) << np.uint64(16) | np.repeat(
                    np.arange(len(docs), dtype=np.uint64), n_bytes)
                gram, within, tf = _counted(both)
                at, sure = _found(grams, gram)
                score = np.bincount(within[sure], weights=tf[sure] * gram_logs[at[sure]], minlength=len(docs)).astype(np.float64)
                cold_grams = _by_document(within[~sure], gram[~sure], tf[~sure], len(docs))
                size = np.array([len(w) for w in docs], dtype=np.int64)
                h = np.concatenate([word_hashes(w) for w in docs])
                key, which = np.unique(h, return_inverse=True)
                (doc, number), tf = _pairs(np.repeat(np.arange(len(docs)), size), which, max(len(key), 1))
                at, hot = _found(words, key[number])
                base = np.bincount(doc[hot], weights=tf[hot] * logs[at[hot]], minlength=len(docs)).astype(np.float64)
                known = np.bincount(doc[hot], weights=tf[hot], minlength=len(docs)).astype(np.int64)
                cold_words = _by_document(doc[~hot], key[number[~hot]].view(np.int64), tf[~hot], len(docs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(len(docs))), columns["doc_id"].slice(a, b - a), columns["held_out"].slice(a, b - a),
                     pa.array(size + 1), pa.array(known), pa.array(base, pa.float64()), pa.array(score, pa.float64()), pa.array(n_bytes),
                     *cold_words, *cold_grams], names=names)
                row += len(docs)
    return run


def _counted(both: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (gram, document) of packed values, and how often each occurs."""
    both.sort()
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.empty(0, np.int64)
    tf = np.diff(np.append(first, len(both)))
    both = both[first]
    return (both >> np.uint64(16)).view(np.int64), (both & np.uint64(0xFFFF)).astype(np.uint16), tf


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in the sorted table, and whether it does."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def _by_document(doc: np.ndarray, keys: np.ndarray, tf: np.ndarray, docs: int) -> tuple[pa.Array, pa.Array]:
    """Lists of keys and of counts, a list a document."""
    order = np.argsort(doc.astype(np.uint16), kind="stable")
    ends = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=docs)))).astype(np.int32)
    return (pa.ListArray.from_arrays(ends, pa.array(keys[order])),
            pa.ListArray.from_arrays(ends, pa.array(tf[order].astype(np.int32))))


def _pairs(a: np.ndarray, b: np.ndarray, width: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Distinct pairs and how often each occurs."""
    both, n = np.unique(a * width + b, return_counts=True)
    return (both // width, both % width), n


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7,
                    held: int = 2, params: ContextTree = ContextTree()) -> DataFrame:
    """Log10 probabilities of every document under the tree and under the word base.

    Rows whose ``crc32(id as text) mod modulus`` is ``held`` are held out; the
    rest train.  Returns ``id_col, held_out, n_tokens, n_known, train_tokens,
    base_score, score`` and ``bits_per_byte``.  The tree's probability is that
    of the words joined by one space and an end; the code length per byte is
    over the same bytes.

    Training is one pass: every task counts its byte grams (five bytes of
    context and a byte) and word hashes, and partial aggregates sum them.
    Every context stands in the tree, which is weighted in tasks; each gram of
    the table gets its log probability once.  The common grams and words go to
    every task, their number bounded by ``params``; the log probabilities of
    other grams and counts of other words meet their documents in a join.  Words
    are known by 64-bit hashes.  Defined cases: a null or empty text is one end
    token; a null id is reported null and trains; rows that repeat an id are
    documents of their own and train as often; without training rows every
    base term is 0 and the tree is uniform; other columns play no part; an
    empty table gives an empty result.
    """
    spark = df.sparkSession
    small_batches(spark)
    held_out = F.coalesce(id_remainder(F.col(id_col), modulus) == held, F.lit(False))
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                     F.col(text_col).alias("text"), held_out.alias("held_out"))
    raw = docs.select("text", "held_out").mapInPandas(_count(params), "kind int, key long, n long, m long")
    counts = stored(raw.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "counts")
    words = counts.where(F.col("kind") == _WORD)
    sums = counts.where(F.col("kind") != _GRAM).agg(
        F.sum("n"), F.count(F.when(F.col("kind") == _WORD, 1)), F.max(F.when(F.col("kind") == _TEXTS, F.col("n")))).first()
    n, v, ends = sums[0] or 0, (sums[1] or 0) + bool(sums[2]), sums[2] or 0
    logs = _gram_logs(counts)
    least = max(1, params.hot * (logs.agg(F.sum("m")).first()[0] or 0))
    top = logs.where(F.col("m") >= least).select("key", "log").toArrow().sort_by("key")
    grams = spark.sparkContext.broadcast((top["key"].to_numpy(), top["log"].to_numpy()))
    hot = words.where(F.col("n") >= max(1, params.common * n)).select("key", "n").toPandas()
    keys = hot["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    common = spark.sparkContext.broadcast((keys[order], np.log10(hot["n"].to_numpy(np.float64)[order] + 1)))
    scored = stored(docs.mapInArrow(_score(params, grams, common), SCORED), "scored")
    def cold(keys: str, counted: str, rare: DataFrame, *sums) -> DataFrame:
        pairs = scored.select("row", F.explode(F.arrays_zip(F.col(keys).alias("key"), F.col(counted).alias("tf"))).alias("p"))
        return pairs.select("row", "p.key", "p.tf").join(rare, "key").groupBy("row").agg(*sums)
    rare_words = words.where(F.col("n") < max(1, params.common * n)).select("key", F.log10(F.col("n") + 1.0).alias("log"))
    by_word = cold("words", "word_tf", rare_words, F.sum("tf").alias("k"), F.sum(F.col("tf") * F.col("log")).alias("l"))
    by_gram = cold("grams", "gram_tf", logs.where(F.col("m") < least).select("key", "log"), F.sum(F.col("tf") * F.col("log")).alias("g"))
    out = (scored.drop("words", "word_tf", "grams", "gram_tf").join(by_word, "row", "left").join(by_gram, "row", "left")
           .withColumn("score", F.col("score") + F.coalesce("g", F.lit(0.0))))
    end_log = F.log10(F.lit(float(ends + 1)))
    each = F.log10(F.lit(float(n + v + 1)))
    return out.select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("k", F.lit(0)) + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("l", F.lit(0.0)) + end_log - F.col("n_tokens") * each).alias("base_score"),
        "score", (-F.col("score") * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"))
