"""Packing: order-preserving dynamic programming over document and sentence cuts."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlens.llm.common import small_batches
from vidlens.llm.tokens import END_ID, crc32_of_ids, encoder

PIECES = ("doc_id string, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


@dataclass(frozen=True)
class Packing:
    """Parameters, all in tokens.

    A sequence holds up to ``window`` tokens and is padded to it unless its
    length is a power of two.  Cuts cost 0 at the end of a document,
    ``sentence`` at the end of a sentence and ``inside`` elsewhere; the last
    are possible only every ``grid`` tokens of a longer sentence and in the
    last window of a partition.  ``chunk`` tokens are planned at a time.
    """

    window: int = 4096
    sentence: int = 4
    inside: int = 32
    grid: int = 1024
    chunk: int = 2_000_000


def plan_cuts(at: list[int], cost: list[int], window: int) -> list[int]:
    """Indexes of the cuts that minimise padding plus costs; first and last included.

    ``at`` are the possible positions in ascending order, at most ``window``
    apart.  ``best[j]`` is the least cost up to ``at[j]``; the padded
    transitions from ``i`` cost ``best[i] + window - (at[j] - at[i])``, so the
    least ``best[i] + at[i]`` in the sliding window is kept at the head of a
    monotone queue.  Exact powers of two are looked up.
    """
    powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
    n = len(at)
    best, back, key = [0] * n, [0] * n, [0] * n
    key[0] = at[0]
    index = {at[0]: 0}
    queue = deque([0])
    for j in range(1, n):
        c = at[j]
        while at[queue[0]] < c - window:
            queue.popleft()
        i = queue[0]
        least = key[i] + window - c
        for w in powers:
            k = index.get(c - w)
            if k is not None and best[k] < least:
                i, least = k, best[k]
        best[j] = least = least + cost[j]
        back[j] = i
        key[j] = least + c
        while queue and key[queue[-1]] >= least + c:
            queue.pop()
        queue.append(j)
        index[c] = j
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def _sentence_ends(lib) -> np.ndarray:
    """Which ids end a sentence: tokens of ``. ! ?`` and closing marks."""
    ends = np.zeros(lib.get_vocab_size(), dtype=bool)
    for token, i in lib.get_vocab().items():
        word = token.removesuffix("</w>")
        if word and set(word) <= set(".!?\"')") and set(word) & set(".!?"):
            ends[i] = True
    return ends


class _Packer:
    """Packs the documents of one partition in their order."""

    def __init__(self, p: Packing, first_sequence: int):
        self.p, self.sequence = p, first_sequence
        self.docs: list[tuple] = []  # (doc_id, ids, sentence ends, start of what is left)
        self.tokens = 0

    def add(self, doc_id, ids: np.ndarray, ends: np.ndarray) -> None:
        self.docs.append((doc_id, ids, ends, 0))
        self.tokens += len(ids)

    def _positions(self, last: bool) -> tuple[list[int], list[int]]:
        p, at, cost, base = self.p, [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
        for _, ids, ends, start in self.docs:
            here = ends[np.searchsorted(ends, start, side="right"):]
            here = here[here < len(ids)] - start
            at += [here + base, np.array([base + len(ids) - start])]
            cost += [np.full(len(here), p.sentence), np.zeros(1, np.int64)]
            base += len(ids) - start
        a, c = np.concatenate(at), np.concatenate(cost)
        gaps = np.diff(a)
        far = np.flatnonzero(gaps > p.grid)
        more = [np.arange(a[k] + p.grid, a[k + 1], p.grid) for k in far]
        if last:
            more.append(np.arange(max(base - p.window, 0) + 1, base))
        if more:
            x = np.concatenate(more)
            a, c = np.concatenate([a, x]), np.concatenate([c, np.full(len(x), p.inside)])
            order = np.lexsort((c, a))
            a, c = a[order], c[order]
            one = np.r_[True, np.diff(a) > 0]
            a, c = a[one], c[one]
        return a.tolist(), c.tolist()

    def flush(self, last: bool) -> list[tuple]:
        """Pieces of the planned sequences; unless ``last``, the final one waits."""
        if not self.docs:
            return []
        at, cost = self._positions(last)
        ends = [at[k] for k in plan_cuts(at, cost, self.p.window)]
        if not last:
            ends = ends[:-1]
        out, d, begin = [], 0, 0  # begin: position of the current document's first waiting token
        for a, b in zip(ends, ends[1:]):
            pos = a
            while pos < b:
                doc_id, ids, _, start = self.docs[d]
                size = len(ids) - start
                stop = min(b, begin + size)
                i, j = start + pos - begin, start + stop - begin
                out.append((doc_id, i, j - i, crc32_of_ids(ids[i:j]), len(ids), self.sequence, pos - a))
                pos = stop
                if stop == begin + size:
                    d, begin = d + 1, stop
            self.sequence += 1
        left = self.docs[d:]
        if left and ends:
            doc_id, ids, sent, start = left[0]
            left[0] = (doc_id, ids, sent, start + ends[-1] - begin)
        self.docs = left
        self.tokens = sum(len(x[1]) - x[3] for x in left)
        return out


#: Characters of texts that are taken out of an Arrow batch and encoded at a time.
_SLICE_CHARS = 1_000_000
_SCHEMA = pa.schema([(c, pa.string() if kind == "string" else pa.int64()) for c, kind in map(str.split, PIECES.split(", "))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Slices ``(from, to)`` of ``texts`` that end with the text in which ``most`` bytes are reached."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = 0
    while a < len(ends):
        b = min(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most)) + 1, len(ends))
        yield a, b
        a = b


def _pack(path: str, p: Packing):
    """Packs a partition; only a slice of a batch's texts is held as Python strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        is_end = _sentence_ends(enc.lib)
        packer = _Packer(p, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for a, b in _slices(batch.column(1), _SLICE_CHARS):
                part = batch.slice(a, b - a)
                texts = ["" if t is None else t for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), enc.encode(texts)):
                    ends = np.flatnonzero(is_end[ids]) + 1
                    packer.add(doc_id, np.append(ids, ids.dtype.type(END_ID)), ends)
                    if packer.tokens >= p.chunk:
                        yield _batch(packer.flush(False))
        yield _batch(packer.flush(True))
    return run


def pack_documents(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   params: Packing = Packing()) -> DataFrame:
    """Pieces of documents packed into sequences.

    Documents keep the order in which the table's partitions hold them; each
    partition is packed on its own, without a shuffle, and plans ``chunk``
    tokens at a time, the last open sequence going on to the next chunk.  A
    document is its ids followed by the end id; every id lies in exactly one
    piece.  Returns ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``; ``sequence_id`` is unique over the table.

    Defined cases: a null or empty text is the end id alone; a document longer
    than a window spans sequences; null and repeated ids are packed row by row
    and keep their id; an empty table gives no pieces; other columns play no
    part.
    """
    small_batches(df.sparkSession)
    # ids travel as text: a null among long numbers would make them floating
    rows = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_pack(tokenizer, params), PIECES).withColumn("doc_id", F.col("doc_id").cast("long"))
