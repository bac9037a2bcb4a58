"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, exact sorted-array intersection."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidlens.llm.common import NULL_ID, small_batches, small_or_shuffled, stored
from vidlens.llm.components import connected_components
from vidlens.llm.shingles import mix, shingle_set


@dataclass(frozen=True)
class JaccardJoin:
    """Parameters: words in a shingle, links from ``percent`` / 100 on.

    ``band`` is the ratio of a tile's largest to its smallest set size;
    A signature has 2 to 4 bits a shingle.  ``block`` rows are compared at once
    where a tile group has to be compared in full, after ``turns`` more
    documents of each group have been tried against the rest of it.
    """

    size: int = 3
    percent: int = 90
    band: float = 1.5
    block: int = 1024
    segments_from: int = 88
    turns: int = 1

    def __post_init__(self):
        if self.band * self.percent < 100:
            raise ValueError("a band must span the sizes of a link")

    def tiles(self, n: int) -> list[tuple[int, int]]:
        """``(tile, largest set size of the tile)`` in which a set of ``n`` shingles stands.

        Its own, and the next one if that holds sets it could link with.
        """
        b = 0
        top = 1
        while top < n:
            b, top = b + 1, max(top + 1, int(top * self.band))
        nxt = max(top + 1, int(top * self.band))
        largest_partner = n * 100 // self.percent
        return [(b, top)] + ([(b + 1, nxt)] if largest_partner > top else [])

    def differences(self, top: int) -> int:
        """Most shingles in which two linked sets of at most ``top`` can differ.

        ``|x ^ y| <= (1 - j) / (1 + j) * (|x| + |y|)``.
        """
        return (100 - self.percent) * 2 * top // (100 + self.percent)

    def prefix(self, n: int) -> int:
        """A linked partner shares one of the first so many shingles in any fixed order."""
        return n - (n * self.percent + 99) // 100 + 1


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity bitmap: the bit of every shingle's hash flips.

    Two bitmaps of one width differ in at most as many bits as the sets do in
    shingles.  The width is a power of two, 512 bits at least.
    """
    width = 1 << max(9, int(2 * len(s) - 1).bit_length() if len(s) else 9)
    bits = np.bincount((mix(s) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def folded(b: np.ndarray, words: int) -> np.ndarray:
    """The bitmap of the same set at a smaller width of ``words`` 64-bit words."""
    b = np.asarray(b).view(np.uint64)  # a signed count would be that of the absolute value
    while len(b) > words:
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return b


def tile_keys(s: np.ndarray, p: JaccardJoin) -> np.ndarray:
    """Keys under which linked, different sets are sure to meet.

    In a tile whose sets differ in at most ``d`` shingles, the hash space is cut
    into ``d + 1`` segments: two linked sets are equal in one of them at least.
    The key is the tile, the segment and a hash of the shingles in it.  Sets
    with an empty segment also stand under the shingles of their prefix, as
    an empty segment on both sides says nothing.  Below ``segments_from``
    percent segments would hold too few shingles, and the prefix alone serves.
    """
    out = []
    n = len(s)
    if p.percent < p.segments_from:
        return mix(s[:p.prefix(n)]) if n else np.empty(0, np.uint64)
    for tile, top in p.tiles(n):
        k = p.differences(top) + 1
        if k == 1:  # only equal sets can link here; those are classes already
            continue
        segment = ((s >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
        edge = np.searchsorted(segment, np.arange(k + 1, dtype=np.uint64))
        total = np.concatenate(([np.uint64(0)], np.cumsum(mix(s + np.uint64(1)), dtype=np.uint64)))
        filled = edge[1:] > edge[:-1]
        ids = np.arange(k, dtype=np.uint64)
        where = np.uint64(tile * 1_000_003 + 17) + ids * np.uint64(1 << 20)
        keys = mix((total[edge[1:]] - total[edge[:-1]]) + mix(where + np.uint64(1)))[filled]
        out.append(keys)
        if not filled.all():
            out.append(mix(s[:p.prefix(n)] + mix(np.full(1, np.uint64(tile * 1_000_003 + 29)))))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


#: Documents whose sets a task holds at a time.
_PART_ROWS = 1_000


def _parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        for a in range(0, len(f), _PART_ROWS):
            yield f.iloc[a:a + _PART_ROWS]


def _signatures(p: JaccardJoin):
    """Sets of the texts; of equal sets in one task only the first has keys (the keys are the same)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int]] = set()
        for f in _parts(frames):
            rows = []
            for doc_id, text in zip(f["doc_id"], f["text"]):
                s = shingle_set(text, p.size)
                raw = s.tobytes()
                h = xxhash.xxh64_intdigest(raw, 1) - (1 << 63), xxhash.xxh64_intdigest(raw, 2) - (1 << 63)
                rows.append((doc_id, len(s), *h, None if h in seen else tile_keys(s, p).view(np.int64), bitmap(s)))
                seen.add(h)
            yield pd.DataFrame(rows, columns=["doc_id", "n", "h1", "h2", "keys", "bits"])
    return run


def _shingle_rows(p: JaccardJoin):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in _parts(frames):
            yield pd.DataFrame({"doc_id": f["doc_id"], "s": [shingle_set(t, p.size).tobytes() for t in f["text"]]})
    return run


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common values of two sorted arrays of distinct values."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def _linked(p: JaccardJoin):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keep = []
            for a, b in zip(f["su"], f["sv"]):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = overlap(x, y)
                keep.append(100 * both >= p.percent * (len(x) + len(y) - both))
            yield f.loc[np.array(keep, dtype=bool), ["u", "v"]]
    return run


def may_link(percent: int, nu, nv, differ):
    """The bitmap bound: the overlap is at most half of what the difference leaves."""
    most = (nu + nv - differ) // 2
    return 100 * most >= percent * (nu + nv - most)


def _possible(p: JaccardJoin):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keep = []
            for nu, nv, bu, bv in zip(f["nu"], f["nv"], f["bu"], f["bv"]):
                words = min(len(bu), len(bv))
                differ = int(np.bitwise_count(folded(bu, words) ^ folded(bv, words)).sum(dtype=np.int64))
                keep.append(may_link(p.percent, int(nu), int(nv), differ))
            yield f.loc[np.array(keep, dtype=bool), ["u", "v"]]
    return run


def _verified(pairs: DataFrame, docs: DataFrame, p: JaccardJoin) -> DataFrame:
    """Those of the stored ``pairs(u, v)`` whose exact shingle sets link."""
    wanted = stored(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), "wanted")
    texts = docs.join(small_or_shuffled(wanted, 16), "doc_id", "left_semi").select("doc_id", "text")
    sets = stored(texts.mapInPandas(_shingle_rows(p), "doc_id long, s binary"), "sets")
    both = (pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("s").alias("su")), "u")
                 .join(sets.select(F.col("doc_id").alias("v"), F.col("s").alias("sv")), "v"))
    return both.mapInPandas(_linked(p), "u long, v long")


def _candidates(met: DataFrame, sig: DataFrame, p: JaccardJoin) -> DataFrame:
    """Pairs ``(u, v)`` of ``met`` that sizes and bitmaps leave possible."""
    side = lambda c: sig.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"b{c}"))
    sized = met.join(side("u"), "u").join(side("v"), "v").where(
        100 * F.least("nu", "nv") >= p.percent * F.greatest("nu", "nv"))
    return sized.mapInPandas(_possible(p), "u long, v long")


def _block_pairs(p: JaccardJoin, same: bool, ids, n, bits, comp, blk) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one block pair that sizes and bitmaps leave possible."""
    left = np.flatnonzero(blk == blk.min())
    right = left if same else np.flatnonzero(blk != blk.min())
    u, v = [], []
    for k, r in enumerate(left):
        c = right[k + 1:] if same else right
        differ = np.bitwise_count(bits[c] ^ bits[r]).sum(axis=1, dtype=np.int64)
        hit = c[may_link(p.percent, n[c], n[r], differ) & (comp[c] != comp[r])]
        u.append(np.full(len(hit), ids[r]))
        v.append(ids[hit])
    return np.concatenate(u), np.concatenate(v)


def _compare_blocks(p: JaccardJoin):
    """Goes through rows sorted by (key, i, j); holds one block pair at a time."""
    def pairs(f: pd.DataFrame) -> Iterator[pd.DataFrame]:
        key, i, j, ids, n, comp, blk = (f[c].to_numpy(np.int64) for c in ("key", "i", "j", "doc_id", "n", "comp", "blk"))
        raw = f["bits"].to_numpy()
        edge = np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        found, total = [], 0
        for a, b in zip(np.r_[0, edge], np.r_[edge, len(f)]):
            words = min(map(len, raw[a:b]))
            bits = np.stack([folded(x, words) for x in raw[a:b]])
            found.append(_block_pairs(p, i[a] == j[a], ids[a:b], n[a:b], bits, comp[a:b], blk[a:b]))
            total += len(found[-1][0])
            if total > 200_000 or b == len(f):
                yield pd.DataFrame({"u": np.concatenate([x for x, _ in found]), "v": np.concatenate([x for _, x in found])})
                found, total = [], 0

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for f in frames:
            f = f if held is None else pd.concat([held, f], ignore_index=True)
            last = (f[["key", "i", "j"]] == f[["key", "i", "j"]].iloc[-1]).all(axis=1)
            held, f = f[last], f[~last]
            if len(f):
                yield from pairs(f)
        if held is not None and len(held):
            yield from pairs(held)
    return run


def _shared(met: DataFrame, p: JaccardJoin) -> DataFrame:
    """``(key, doc_id, h1)``: the rows of keys under which different sets stand.

    Keys of segments are shuffled once and looked through by key.  Keys of
    single shingles can be as frequent as a phrase: these are counted with
    partial aggregates and picked by a join, which splits a frequent key.
    """
    if p.percent >= p.segments_from:
        key = Window.partitionBy("key")
        return (met.withColumn("lo", F.min("h1").over(key)).withColumn("hi", F.max("h1").over(key))
                   .where("lo < hi").select("key", "doc_id", "h1"))
    shared = stored(met.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
                       .where("lo < hi").select("key"), "shared")
    return met.join(shared, "key")


def _grouped(groups: DataFrame, comps: DataFrame) -> DataFrame:
    """``(key, doc_id, comp)``: the groups with the component of each document so far."""
    return (groups.join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                  .withColumn("comp", F.coalesce("component", "doc_id")).select("key", "doc_id", "comp"))


def _pivots(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs of one document of each group, another every turn, with those of other components."""
    draw = F.struct(F.xxhash64("doc_id", F.lit(turn)).alias("h"), F.col("doc_id").alias("u"), F.col("comp").alias("cu"))
    pick = rows.groupBy("key").agg(F.min(draw).alias("p"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                   F.count(F.lit(1)).alias("m")).where("lo < hi and m > 2")
    met = rows.join(pick.select("key", "p.u", "p.cu"), "key").where("comp != cu")
    return met.select(F.least("u", "doc_id").alias("u"), F.greatest("u", "doc_id").alias("v")).distinct()


def _remaining(groups: DataFrame, comps: DataFrame, sig: DataFrame, p: JaccardJoin) -> DataFrame:
    """Possible pairs within groups that still hold more than one component.

    A pair alone under its key has been decided; of keys with the very same
    documents one is enough.
    """
    rows = stored(_grouped(groups, comps), "grouped")
    open_ = rows.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"),
        F.bit_xor(F.xxhash64("doc_id")).alias("s1"), F.bit_xor(F.xxhash64(F.lit(1), "doc_id")).alias("s2"))
    open_ = open_.where("lo < hi and m > 2").groupBy("m", "s1", "s2").agg(F.min("key").alias("key"))
    rows = rows.join(open_.select("key"), "key").join(sig.select("doc_id", "n"), "doc_id")

    # by size: a set meets those of its own band and, as the smaller one, of the next
    def band(n):
        return F.floor(F.log(n) / math.log(p.band)).cast("int")
    rows = rows.withColumn("band", F.explode(F.array_distinct(F.array(
        band(F.col("n")), F.least(band(F.col("n") * (100 / p.percent) * (1 + 1e-9)), band(F.col("n")) + 1)))))
    rows = stored(rows.select(F.xxhash64("key", "band").alias("key"), "doc_id", "comp", "n"), "bands")
    # a group of more than a block is dealt over pairs of blocks
    size = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    rows = rows.join(size.where("lo < hi").select("key", "m"), "key")
    blocks = F.ceil(F.col("m") / p.block).cast("int")
    mine = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("blk", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("o", other).select(
        "key", "doc_id", "comp", "n", "blk",
        F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"))
    # bitmaps come last and travel once
    rows = rows.join(sig.select("doc_id", "bits"), "doc_id")
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return rows.mapInPandas(_compare_blocks(p), "u long, v long").distinct()


def ngram_jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       params: JaccardJoin = JaccardJoin()) -> DataFrame:
    """Groups of documents whose word-shingle sets are alike.

    Returns ``id_col, n_shingles, component_id, class_id``: the size of the
    set, the smallest id reachable over links (itself included), and the
    smallest id with the very same set.  No link between different sets is
    lost: see :func:`tile_keys`.

    1. One pass makes each set's size, 128-bit hash, tile keys and bitmap.
       Equal sets are a class, whose smallest id stands for it.
    2. Sets meeting under a key are paired with the smallest id there (one row
       each, not all pairs); sizes and bitmap bit counts bound the overlap from
       above, and the exact sorted arrays decide.
    3. In groups that are then not one component, further single documents
       are paired with those of other components in the same way.
    4. What is still apart is compared in full by bitmap, in blocks of bounded
       size, and possible pairs of different components are decided exactly.

    Sets of more than one document are read again from the texts, so no array
    travels that no pair needs.  Defined cases: null and empty texts and texts
    without words have no shingles and link with nothing; a null id counts as
    the smallest id and is reported null; rows with equal id are one document
    per text; other columns play no part; an empty table gives an empty result.
    """
    p = params
    small_batches(df.sparkSession)
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                     F.col(text_col).alias("text"))
    sig = stored(docs.mapInPandas(
        _signatures(p), "doc_id long, n long, h1 long, h2 long, keys array<long>, bits array<long>"), "signatures")
    same = sig.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    classes = stored(sig.select("doc_id", "n", "h1", "h2").join(same, ["n", "h1", "h2"], "left")
                     .select("doc_id", "n", "h1", F.coalesce("rep", "doc_id").alias("rep")), "classes")
    # a class stands under its keys once a task; its members become its smallest id afterwards
    met = sig.where("n > 0").select("doc_id", "h1", F.explode("keys").alias("key"))
    members = stored(_shared(met, p).join(classes.select("doc_id", "h1", "rep"), ["doc_id", "h1"])
                     .select("key", F.col("rep").alias("doc_id")).distinct(), "members")
    groups = stored(members.join(members.groupBy("key").agg(F.min("doc_id").alias("u")), "key"), "groups")
    small = stored(sig.select("doc_id", "n", "bits")
                   .join(groups.select("doc_id").distinct(), "doc_id", "left_semi"), "bitmaps")
    stars = groups.where("u < doc_id").select("u", F.col("doc_id").alias("v")).distinct()
    links = stored(_verified(stored(_candidates(stars, small, p), "stars"), docs, p), "verified")
    comps = connected_components(links)
    for turn in range(p.turns):
        met = stored(_pivots(stored(_grouped(groups, comps), "grouped"), turn), "met")
        links = links.unionByName(stored(_verified(stored(_candidates(met, small, p), "stars"), docs, p), "verified"))
        comps = connected_components(links)
    rest = stored(_remaining(groups, comps, small, p), "rest")
    more = _verified(rest, docs, p)
    every = connected_components(links.unionByName(more))
    out = classes.join(every.select(F.col("node").alias("rep"), "component"), "rep", "left")
    return out.select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.coalesce("component", "rep") != NULL_ID, F.coalesce("component", "rep")).alias("component_id"),
        F.when(F.col("rep") != NULL_ID, F.col("rep")).alias("class_id"))


#: Shared shingles of all documents, counted by pair.
ORACLE_SQL = """with recursive w as (
  select doc_id, [x for x in string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \\t\\n\\x0B\\f\\r]+') if x != ''] as ws from documents),
s as (select doc_id, list_sort(list_distinct(case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')]
  else [concat_ws(' ', ws[i], ws[i + 1], ws[i + 2]) for i in range(1, len(ws) - 1)] end)) as sh from w),
k as (select doc_id, cast(len(sh) as bigint) as n, sh from s),
g as (select doc_id, n, case when n = 0 then doc_id else min(doc_id) over (partition by sh) end as class_id from k),
u as (select doc_id, unnest(sh) as x from k where doc_id in (select class_id from g)),
i as (select a.doc_id as x, b.doc_id as y, count(*) as n from u a join u b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
p as (select i.x, i.y from i join k a on i.x = a.doc_id join k b on i.y = b.doc_id
      where 100 * i.n >= 90 * (a.n + b.n - i.n)),
q as (select x, y from p union select y, x from p),
r(x, y) as (select distinct class_id, class_id from g union select r.x, q.y from r join q on r.y = q.x),
c as (select x, min(y) as component_id from r group by x)
select g.doc_id, g.n as n_shingles, c.component_id, g.class_id from g join c on g.class_id = c.x"""
