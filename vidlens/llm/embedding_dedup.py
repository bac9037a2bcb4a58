"""Embedding near-dedup: a forest of random-projection trees with spill overlap."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidlens.llm.common import small_or_shuffled, stored
from vidlens.llm.components import connected_components


@dataclass(frozen=True)
class Forest:
    """Parameters of the forest.

    A node of more than ``leaf`` vectors is split at the median of a random
    projection; both halves also get the vectors between the quantiles
    0.5 - ``spill`` and 0.5 + ``spill``, and at least those within the usual
    projected distance of two vectors at ``cosine``.  Where a half would get
    more than 0.7 of the vectors, two halves are no fewer pairs than the whole:
    such a node is left whole, as is one at ``depth``, and compared in blocks
    of ``leaf`` vectors.  Nodes of more than ``local`` vectors are split level
    by level over all vectors; a smaller one is split to its leaves in one task.
    """

    cosine: float = 0.93
    trees: int = 6
    leaf: int = 1024
    spill: float = 0.08
    depth: int = 24
    local: int = 50_000
    seed: int = 20240601

    def direction(self, tree: int, dim: int) -> np.ndarray:
        """Directions of a tree, one column per level."""
        d = np.random.default_rng([self.seed, tree, dim]).standard_normal((dim, self.depth))
        return d / np.linalg.norm(d, axis=0)


def unit(values) -> np.ndarray | None:
    """The unit vector in double precision; None for unusable vectors."""
    if values is None:
        return None
    v = np.array([np.nan if x is None else x for x in values], dtype=np.float64) \
        if not isinstance(values, np.ndarray) or values.dtype == object else values.astype(np.float64)
    if len(v) == 0 or not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if top == 0:
        return None
    v = v / top
    return v / np.sqrt((v * v).sum())


def units(x: np.ndarray) -> np.ndarray:
    """The unit vectors of usable rows, as by :func:`unit`."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _usable(p: Forest, single: bool):
    """Usable vectors as bytes in their own precision, and all their projections."""
    kind = "<f4" if single else "<f8"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            size = np.array([0 if v is None else len(v) for v in f["vector"]], dtype=np.int64)
            for dim in np.unique(size[size > 0]).tolist():
                g = f[size == dim]
                x = np.array([v if v.dtype != object else [np.nan if e is None else e for e in v]
                              for v in map(np.asarray, g["vector"])], dtype=np.float64)
                ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
                g, x = g.loc[ok, ["label", "cid", "copies"]], x[ok]
                u = units(x)
                at = np.concatenate([u @ p.direction(tree, dim) for tree in range(p.trees)], axis=1)
                yield g.assign(dim=dim, v=[v.tobytes() for v in x.astype(kind)], at=list(at.astype(np.float32)))
    return run


def _quantiles(p: Forest) -> list[float]:
    """Of a node's projections: between the first and the last, a cut leaves halves of at most 0.7."""
    return [0.3, 0.5 - p.spill, 0.5, 0.5 + p.spill, 0.7]


def _split(p: Forest, at: np.ndarray, dim: int, node: int, level: int) -> list[tuple[int, np.ndarray]]:
    """The leaves below a node, each with its rows of ``at``, the projections of all levels."""
    margin = np.sqrt(2 * (1 - p.cosine) / max(dim, 1))
    leaves, todo = [], [(node, level, np.arange(len(at)))]
    while todo:
        node, level, rows = todo.pop()
        if len(rows) > p.leaf and level < p.depth:
            here = at[rows, level]
            order = np.sort(here).astype(np.float64)
            q = [order[max(int(np.ceil(x * len(rows))) - 1, 0)] for x in _quantiles(p)]
            lo, hi = min(q[1], q[2] - margin), max(q[3], q[2] + margin)
            if q[0] < lo and hi < q[4]:
                todo += [(2 * node, level + 1, rows[here <= hi]), (2 * node + 1, level + 1, rows[here >= lo])]
                continue
        leaves.append((node, rows))
    return leaves


_LEAVES = "label int, dim long, cid long, tree int, node long, m long"


def _split_rows(p: Forest, level: int | None):
    """Leaves of a whole label and dimension (``level`` is None) or of one node."""
    def run(f: pd.DataFrame) -> pd.DataFrame:
        dim, cid = int(f["dim"].iat[0]), f["cid"].to_numpy()
        at, out = np.stack(f["at"].to_numpy()), []
        if level is None:
            for tree in range(p.trees):
                found = _split(p, at[:, tree * p.depth:(tree + 1) * p.depth], dim, 1, 0)
                if len(found) == 1:  # a tree that is one leaf has every pair; the others have nothing to add
                    out = [(tree, found)]
                    break
                out.append((tree, found))
        else:
            out.append((int(f["tree"].iat[0]), _split(p, at, dim, int(f["node"].iat[0]), level)))
        parts = [pd.DataFrame({"cid": cid[rows], "tree": tree, "node": node, "m": len(rows)})
                 for tree, found in out for node, rows in found]
        return pd.concat(parts).assign(label=f["label"].iat[0], dim=dim)[[c.split()[0] for c in _LEAVES.split(", ")]]
    return run


def _leaves(vectors: DataFrame, p: Forest) -> DataFrame:
    """``(label, dim, cid, tree, node, m)`` for every leaf that holds the vector.

    ``m`` is the size of the leaf.  The levels of nodes above ``local`` vectors
    run over all vectors: size, median and overlap of each node are
    partial-aggregated, and rows carry projections instead of vectors.
    """
    key = ["label", "dim", "tree", "node"]
    sizes = stored(vectors.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("m")), "label-sizes")
    of = lambda which: vectors.join(small_or_shuffled(sizes, 32).where(which), ["label", "dim"], "left_semi")
    done = (of(F.col("m") <= p.local).select("label", "dim", "cid", "at")
            .groupBy("label", "dim").applyInPandas(_split_rows(p, None), _LEAVES))
    if not sizes.where(F.col("m") > p.local).take(1):
        return stored(done, "leaves")
    tree = F.explode(F.sequence(F.lit(0), F.lit(p.trees - 1)))
    open_ = (of(F.col("m") > p.local).select("label", "dim", "cid", "at", tree.alias("tree"))
             .select("label", "dim", "cid", "tree", F.lit(1).cast("long").alias("node"),
                     F.slice("at", F.col("tree") * p.depth + 1, p.depth).alias("at")))
    margin = F.sqrt(F.lit(2 * (1 - p.cosine)) / F.greatest("dim", F.lit(1)))
    for level in range(p.depth + 1):
        here = F.col("at")[level] if level < p.depth else F.lit(0.0)
        q = open_.groupBy(*key).agg(F.count(F.lit(1)).alias("m"),
                                    F.percentile_approx(here, _quantiles(p), F.lit(2000)).alias("q"))
        near = (F.col("m") <= p.local) & F.lit(level > 0)
        cut = (q.withColumn("lo", F.least(F.col("q")[1], F.col("q")[2] - margin))
                .withColumn("hi", F.greatest(F.col("q")[3], F.col("q")[2] + margin))
                .withColumn("near", near)
                .withColumn("leaf", ~near & ((F.col("m") <= p.leaf) | (F.col("lo") <= F.col("q")[0])
                                             | (F.col("hi") >= F.col("q")[4]) | F.lit(level == p.depth))).drop("q"))
        if level == 0:  # a tree that is one leaf has every pair; the others have nothing to add
            whole = F.min(F.when(F.col("leaf"), F.col("tree"))).over(Window.partitionBy("label", "dim"))
            cut = cut.withColumn("whole", whole).where("whole is null or tree = whole").drop("whole")
        cut = stored(cut, "cuts")
        sides = F.when(F.col("leaf") | F.col("near"), F.array("node")).otherwise(F.filter(F.array(
            F.when(here <= F.col("hi"), F.col("node") * 2), F.when(here >= F.col("lo"), F.col("node") * 2 + 1)),
            lambda s: s.isNotNull()))
        rows = stored(open_.join(small_or_shuffled(cut, 64), key)
                      .select("label", "dim", "cid", "tree", F.explode(sides).alias("node"), "m", "leaf", "near",
                              F.when(~F.col("leaf"), F.col("at")).alias("at")), "forest")
        done = done.unionByName(rows.where("leaf").select("label", "dim", "cid", "tree", "node", "m"))
        if level:
            done = done.unionByName(rows.where("near").select(*key, "cid", "at").groupBy(*key)
                                    .applyInPandas(_split_rows(p, level), _LEAVES))
        open_ = rows.where("not leaf and not near").drop("m", "leaf", "near")
        if not open_.take(1):
            return stored(done, "leaves")


def _smallest_linked(adj: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each row's component under the symmetric links ``adj``."""
    at = ids.copy()
    far = np.iinfo(np.int64).max
    while True:
        new = np.minimum(at, np.where(adj, at[None, :], far).min(axis=1))
        if (new == at).all():
            return at
        at = new


def _compare(p: Forest):
    """Links between the vectors of one leaf (or of two blocks of a large leaf).

    A pair that meets in several leaves counts in the first of them in the
    order of leaf numbers, which both vectors carry; no pair leaves the task.
    """
    def run(f: pd.DataFrame) -> pd.DataFrame:
        leaf, i, j = f["leaf"].iat[0], f["i"].iat[0], f["j"].iat[0]
        f = f.sort_values("cid").reset_index(drop=True)
        kind = f"<f{len(f['v'].iat[0]) // int(f['dim'].iat[0])}"
        x = units(np.frombuffer(b"".join(f["v"]), kind).reshape(len(f), -1))
        ids, weight, blk = (f[c].to_numpy(np.int64) for c in ("cid", "copies", "blk"))
        adj = (x @ x.T) >= p.cosine
        np.fill_diagonal(adj, False)
        if i != j:
            adj &= blk[:, None] != blk[None, :]
        rows = np.flatnonzero(adj.any(axis=1))
        if not len(rows):
            return pd.DataFrame({"cid": [], "links": [], "to": []}).astype("int64")
        adj = adj[np.ix_(rows, rows)]
        ids, weight = ids[rows], weight[rows]
        lowest = _smallest_linked(adj, ids)
        earlier = [[t for t in f["leaves"].iat[r] if t < leaf] for r in rows]
        names = {t: n for n, t in enumerate(sorted({t for e in earlier for t in e}))}
        if names:
            met = np.zeros((len(rows), len(names)), dtype=np.float32)
            for n, e in enumerate(earlier):
                met[n, [names[t] for t in e]] = 1
            adj = adj & ~((met @ met.T) > 0)
        return pd.DataFrame({"cid": ids, "links": adj @ weight, "to": lowest})
    return run


def embedding_near_dedup(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                         label_col: str = "label", params: Forest = Forest()) -> DataFrame:
    """Near-duplicate vectors within a label, by cosine of at least ``params.cosine``.

    Returns ``id_col, n_links, component_id, kept``.  Vectors are compared only
    with vectors of an equal, non-null label and the same length.  Null or zero
    vectors and vectors with null or non-finite components link with nothing;
    neither do vectors with a null label.  Rows with equal vectors are one
    class until the end, each counted as a link of the others.  Rows that
    repeat an id are vectors of their own; a null id is reported null and
    never the name of a component unless its class has no other id.  An empty
    table gives an empty result; other columns play no part.

    Every link reported is exact (double precision over the pairs that meet in
    a leaf); the share of links found is a matter of ``params`` and is measured
    against all pairs in the tests.  Leaves hold at most ``leaf`` vectors, or
    are compared in blocks of that size, so no task grows with a label.
    """
    p = params
    single = df.schema[vector_col].dataType.elementType.typeName() == "float"
    base = df.select(F.col(id_col).cast("long").alias("vid"), F.col(label_col).cast("int").alias("label"),
                     F.col(vector_col).cast("array<float>" if single else "array<double>").alias("vector"))
    base = base.withColumn("h1", F.xxhash64(F.lit(1), "vector")).withColumn("h2", F.xxhash64(F.lit(2), "vector"))
    lead = F.coalesce("vid", F.lit(2 ** 63 - 1))
    # one row per distinct vector; cid names the class, low is its smallest id
    sizes = stored(base.where("label is not null and vector is not null").groupBy("label", "h1", "h2").agg(
        F.min(lead).alias("low"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
        .withColumn("cid", F.xxhash64("label", "h1", "h2")), "vector-classes")
    vectors = stored(sizes.select("label", "cid", "copies", "vector").mapInPandas(
        _usable(p, single), "label int, cid long, copies long, dim long, v binary, at array<float>"), "usable")
    leaves = _leaves(vectors, p).withColumn("leaf", F.xxhash64("label", "dim", "tree", "node"))
    held = leaves.groupBy("cid").agg(F.collect_list(F.struct("leaf", "m")).alias("in"))
    blocks = F.ceil(F.col("m") / p.leaf).cast("int")
    rows = (vectors.select("cid", "copies", "dim", "v").join(held, "cid")
                   .select("cid", "copies", "dim", "v", F.col("in.leaf").alias("leaves"), F.explode("in").alias("l"))
                   .select("cid", "copies", "dim", "v", "leaves", "l.leaf", "l.m")
                   .withColumn("blk", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
                   .withColumn("o", F.explode(F.sequence(F.lit(0), blocks - 1))))
    rows = rows.select("leaf", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"), "blk",
                       "cid", "copies", "dim", "v", "leaves")
    found = stored(rows.groupBy("leaf", "i", "j").applyInPandas(
        _compare(p), "cid long, links long, to long"), "leaf-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comps = connected_components(found.select(F.col("cid").alias("u"), F.col("to").alias("v")))
    every = (sizes.select("label", "h1", "h2", "low", "copies", "cid")
                  .join(vectors.select("cid", F.lit(True).alias("good")), "cid", "left")
                  .join(links, "cid", "left").join(comps, F.col("cid") == F.col("node"), "left")
                  .withColumn("comp", F.coalesce("component", "cid")))
    names = every.groupBy("comp").agg(F.min("low").alias("component_id"))
    out = base.join(every.where("good").join(names, "comp"), ["label", "h1", "h2"], "left")
    named = F.coalesce("component_id", "vid")
    return out.select(
        F.col("vid").alias(id_col),
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.when(named != 2 ** 63 - 1, named).alias("component_id"),
        F.coalesce(F.col("vid") == named, F.lit(False)).alias("kept"))


#: All pairs of a label, for tables small enough that every label is one leaf.
ORACLE_SQL = """with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings where label is not null),
p as (select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id != b.vec_id
      where list_cosine_similarity(a.e, b.e) between 0.93 and 1.01),
r(x, y) as (select vec_id, vec_id from embeddings union select r.x, p.y from r join p on r.y = p.x),
c as (select x, min(y) as component_id from r group by x),
n as (select x, count(*) as n_links from p group by x)
select e.vec_id, cast(coalesce(n.n_links, 0) as bigint) as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join c on e.vec_id = c.x left join n on e.vec_id = n.x"""
