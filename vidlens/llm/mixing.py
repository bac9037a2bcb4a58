"""Mixing sources to target weights: balanced sampling by the cube method."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidlens.llm.common import NULL_ID, small_or_shuffled, split_words, stored

ROWS = "uid long, tkey long, source string, size long, full long, pi double"
_SURE = 1e-9


@dataclass(frozen=True)
class Mix:
    """Parameters: sources in order weigh ``weights``, repeating.

    ``share`` of all sizes is dealt out; no target exceeds ``most`` times its
    source.  ``chunk`` units are balanced at a time;
    the landing decides so many others anew.
    """

    weights: tuple[int, ...] = (1, 2, 3)
    share: float = 1.0
    most: int = 3
    chunk: int = 4096
    reopen: int = 12
    seed: int = 7


def source_targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``source, n, source_size, target`` from ``source, n, source_size`` (one row per source).

    Sources stand by code point, null last.  Filling up to the cap: with the
    sources in ascending order of cap by weight, those before the first that
    its share does not overfill are full, and the rest share what is left by
    weight.  The windows run over one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*[F.lit(w) for w in mix.weights])
    s = sizes.withColumn("w", F.element_at(weights, (rank - 1) % len(mix.weights) + 1).cast("double")) \
             .withColumn("cap", F.lit(float(mix.most)) * F.col("source_size"))
    every = Window.partitionBy(F.lit(0))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()) \
                   .rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0.0)
    left = F.sum("source_size").over(every) * mix.share - F.coalesce(F.sum("cap").over(before), none)
    left_w = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), none)
    s = s.withColumn("level", left / left_w)
    first = F.min(F.when(F.col("cap") >= F.col("level") * F.col("w"),
                         F.struct((F.col("cap") / F.col("w")).alias("o"), "level"))).over(every)
    level = F.coalesce(first["level"], F.lit(float("inf")))
    return s.withColumn("level", level) \
            .select("source", "n", "source_size", F.least("cap", F.col("level") * F.col("w")).alias("target"))


def flight(size: np.ndarray, pi: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Cube method, flight phase, balanced on the number of units and on size.

    Three undecided units at a time move along the null space of both
    constraints, in one of two directions at random so that every probability
    keeps its expectation, until one of them is 0 or 1.  Fewer than three units
    stay undecided.
    """
    pi = pi.copy()
    held: list[int] = []
    for k in np.flatnonzero((pi > 0) & (pi < 1)).tolist():
        held.append(k)
        if len(held) < 3:
            continue
        a, b, c = (float(size[i]) for i in held)
        move = (c - b, a - c, b - a) if not a == b == c else (1.0, -1.0, 0.0)
        _step(pi, held, move, rng)
        held = [i for i in held if 0 < pi[i] < 1]
    return pi


def _step(pi: np.ndarray, units: list[int], move: tuple, rng: np.random.Generator) -> None:
    up = min((1 - pi[i]) / m if m > 0 else pi[i] / -m for i, m in zip(units, move) if m)
    down = min(pi[i] / m if m > 0 else (1 - pi[i]) / -m for i, m in zip(units, move) if m)
    t = up if rng.random() * (up + down) < down else -down
    for i, m in zip(units, move):
        p = pi[i] + t * m
        pi[i] = 0.0 if p < _SURE else 1.0 if p > 1 - _SURE else p


def land(size: np.ndarray, start: np.ndarray, pi: np.ndarray, reopen: int) -> np.ndarray:
    """Landing phase: the undecided units, and ``reopen`` others of all sizes.

    Of all ways to decide these few units, the one whose total size is nearest
    to that of the probabilities ``start``, then nearest in number.  ``size`` is
    in descending order.
    """
    pi = pi.copy()
    undecided = np.flatnonzero((pi > 0) & (pi < 1))
    others = np.setdiff1d(np.flatnonzero((size > 0) & (start > 0) & (start < 1)), undecided)
    spread = np.unique(np.linspace(0, len(others) - 1, min(reopen, len(others))).round().astype(int))
    units = np.concatenate([undecided, others[spread]])
    if not len(units):
        return pi
    rest = np.ones(len(pi), dtype=bool)
    rest[units] = False
    words = (start * size).sum() - (pi * size)[rest].sum()
    number = start.sum() - pi[rest].sum()
    ways = (np.arange(1 << len(units))[:, None] >> np.arange(len(units))) & 1
    off = np.abs(ways @ size[units] - words)
    best = np.lexsort((np.arange(len(ways)), np.abs(ways.sum(axis=1) - number), off))[0]
    pi[units] = ways[best]
    return pi


def _balance(mix: Mix, rounds: int):
    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["size", "uid", "tkey"], ascending=[False, True, True]).reset_index(drop=True)
        source = f["source"].iat[0]
        name = b"\x00" if source is None else b"\x01" + source.encode("utf-8", "surrogatepass")
        rng = np.random.default_rng([mix.seed, zlib.crc32(name), int(f["chunk"].iat[0]), rounds])
        size = f["size"].to_numpy(np.int64)
        start = f["pi"].to_numpy(np.float64)
        pi = flight(size, start, rng)
        if f["chunks"].iat[0] == 1:
            pi = land(size, start, pi, mix.reopen)
        return f.assign(pi=pi)[[c.split()[0] for c in ROWS.split(", ")]]
    return run


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          mix: Mix = Mix()) -> DataFrame:
    """One row per document: ``uid, tkey, source, size, source_size, target, copies``.

    A source is taken ``target / source_size`` times: every document that many
    whole times, and once more with the fraction as its probability.  The cube
    method decides these, balancing the number of documents and of words of
    each source: chunks of a source are balanced apart, their few undecided
    documents meet in the next round, and the last round lands.  So no group
    grows with the source, and reruns agree (all randomness is seeded by
    source, chunk and round).
    """
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("uid"),
                     F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("tkey"),
                     F.col(source_col).cast("string").alias("source"),
                     F.coalesce(F.size(split_words(F.coalesce(F.col(text_col), F.lit("")))), F.lit(0)).cast("long").alias("size"))
    rows = stored(rows, "sizes")
    per = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    targets = stored(source_targets(per, mix), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    near = F.round(ratio)
    ratio = F.when(F.abs(ratio - near) < _SURE, near).otherwise(ratio)
    per_source = targets.select(F.col("source").alias("s"), ratio.alias("ratio"))
    open_ = (rows.join(small_or_shuffled(per_source, 64), F.col("source").eqNullSafe(F.col("s")))
                 .withColumn("full", F.floor("ratio").cast("long"))
                 .withColumn("pi", F.col("ratio") - F.col("full")).select("uid", "tkey", "source", "size", "full", "pi"))
    done = open_.where("pi = 0")
    open_ = open_.where("pi > 0")
    rounds = 0
    while True:
        count = stored(open_.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / mix.chunk).cast("int").alias("chunks"))
                       .withColumnRenamed("source", "s"), "chunks")
        dealt = (open_.join(small_or_shuffled(count, 64), F.col("source").eqNullSafe(F.col("s"))).drop("s")
                      .withColumn("chunk", F.pmod(F.xxhash64("uid", "tkey", F.lit(rounds)), F.col("chunks")).cast("int")))
        after = stored(dealt.groupBy("source", "chunk").applyInPandas(_balance(mix, rounds), ROWS), "balanced")
        done = done.unionByName(after.where("pi = 0 or pi = 1"))
        open_ = after.where("pi > 0 and pi < 1")
        rounds += 1
        if not open_.take(1):
            break
    targets = targets.select(F.col("source").alias("s"), "source_size", "target")
    return (done.join(small_or_shuffled(targets, 64), F.col("source").eqNullSafe(F.col("s")))
                .select("uid", "tkey", "source", "size", "source_size", "target",
                        (F.col("full") + F.col("pi").cast("long")).alias("copies")))


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                mix: Mix = Mix()) -> DataFrame:
    """Documents mixed to their sources' targets: ``id_col, size, source_size, target, taken``.

    ``size`` is the number of words, ``taken`` the words that the mix takes of
    the document, repeats counted.  Defined cases: a null or empty text has size
    0; a null source is a source of its own, the last; a null id is reported
    null; rows that repeat an id are documents of their own; a source without
    words has target 0; an empty table gives an empty result; other columns
    play no part.
    """
    m = mixed(df, id_col, text_col, source_col, mix)
    return m.select(F.when(F.col("uid") != NULL_ID, F.col("uid")).alias(id_col), "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken"))


def repeat_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                     mix: Mix = Mix()) -> DataFrame:
    """The mix itself: the rows of ``df``, each as often as it is taken."""
    m = mixed(df, id_col, text_col, source_col, mix)
    m = m.select(F.col("uid").alias("_u"), F.col("tkey").alias("_t"), F.col("source").alias("_s"), "copies",
                 F.row_number().over(Window.partitionBy("uid", "tkey", "source").orderBy("copies")).alias("_m")) \
         .withColumnRenamed("copies", "_copies")
    uid = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))
    keyed = df.withColumn("_uid", uid).withColumn("_tkey", F.coalesce(F.xxhash64(text_col), F.lit(0)))
    # rows that repeat id, text and source are numbered, so each takes one decision
    n = F.row_number().over(Window.partitionBy("_uid", "_tkey", source_col).orderBy("_uid"))
    keyed = keyed.withColumn("_n", n)
    on = (F.col("_uid") == F.col("_u")) & (F.col("_tkey") == F.col("_t")) & (F.col("_n") == F.col("_m")) \
        & F.col(source_col).cast("string").eqNullSafe(F.col("_s"))
    return keyed.join(m, on).withColumn("_r", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))) \
                .select(*df.columns)
