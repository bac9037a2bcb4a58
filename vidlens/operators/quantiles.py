"""Exact quantiles (linear interpolation, as pandas ``quantile`` and DuckDB
``quantile_cont``) without pulling a whole group into one task.

Spark's exact ``percentile`` merges a value->count map for the whole group in
a single task, which does not survive a 100 TB table with many distinct
values.  Here the work is spread out:

1. ``groupBy(keys, x).count()`` -- distinct values with multiplicity; partial
   aggregation collapses hot values map-side.
2. ``repartitionByRange(P, keys, x)`` -- partitions hold consecutive value
   ranges; ``spark_partition_id`` numbers them in order.
3. Per-partition totals (keys x P rows) give each partition's first rank by a
   window over that small table.
4. Only the partitions that contain a wanted rank are sorted (a window
   partitioned by ``(keys, pid)``) to find the values at the two ranks around
   each ``(n - 1) * q``.

``method="approx"`` uses ``percentile_approx`` (bounded memory sketch) and
``method="builtin"`` the exact single-task ``percentile`` for small inputs.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _qname(q: float) -> str:
    return "q_" + f"{q:g}".replace(".", "_").replace("-", "m")


STATS = ("rows", "count", "min", "max", "sum")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    by: Sequence[str] = (), names: Sequence[str] | None = None,
                    method: str = "exact", partitions: int | None = None,
                    accuracy: int = 10000, max_groups: int | None = None,
                    stats: bool = False) -> DataFrame:
    """One row per group of ``by`` with one column per probability.

    Nulls and NaN are ignored (pandas skips them).  Groups with no values are
    absent.  ``max_groups`` is a caller-proven bound on the number of groups;
    with it (or without ``by``) the small range directory is broadcast,
    otherwise AQE picks the join from measured sizes.

    ``stats=True`` (exact method) adds ``rows`` (all rows, nulls included),
    ``count``, ``min``, ``max`` and ``sum`` of the values per group, taken
    from the same value-count table -- no second scan of the input -- and
    keeps groups whose values are all null (their quantiles are null).
    """
    probs = [float(q) for q in probs]
    for q in probs:
        if not 0.0 <= q <= 1.0:
            raise ValueError(f"quantile out of [0, 1]: {q}")
    names = list(names) if names else [_qname(q) for q in probs]
    by = list(by)
    x = F.col(col).cast("double")
    base = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    if stats and method != "exact":
        raise ValueError("stats=True needs method='exact'")

    if method == "builtin":
        return base.groupBy(*by).agg(*[
            F.percentile("_x", F.lit(q)).alias(n) for q, n in zip(probs, names)])
    if method == "approx":
        arr = F.percentile_approx("_x", F.array(*[F.lit(q) for q in probs]), accuracy)
        out = base.groupBy(*by).agg(arr.alias("_qs"))
        return out.select(*by, *[F.col("_qs")[i].alias(n) for i, n in enumerate(names)])
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")

    spark = df.sparkSession
    P = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A whole-table quantile is the one-group case of the grouped one.
    keys = by or ["_g"]
    if stats:
        # keep null rows (as one null value per group) so ``rows`` counts them
        base = df.select(*by, F.when(~F.isnan(x), x).alias("_x"))
    if not by:
        base = base.withColumn("_g", F.lit(0))

    # 1. distinct values with their multiplicity (partial aggregation map-side).
    vc = base.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_c"))
    # 2. ordered ranges of distinct values; the partition id is the range index.
    # Both readers of ``vr`` below must see the same range bounds: Spark plans
    # them as one reused exchange (lost map output is recomputed with the same
    # partitioner).  If a session disables exchange reuse, ``vr`` is
    # checkpointed to the shared checkpoint folder instead, fixing the ids.
    vr = vc.repartitionByRange(P, *keys, "_x").withColumn("_pid", F.spark_partition_id())
    if spark.conf.get("spark.sql.exchange.reuse", "true").lower() == "false":
        from vidlens.session import checkpoint_root
        checkpoint_root(spark)
        vr = vr.checkpoint(eager=True)

    # 3. directory of ranges (groups x P rows): first rank and group size.
    wg = Window.partitionBy(*keys).orderBy("_pid")
    valued = F.col("_x").isNotNull()
    rdir = (vr.groupBy(*keys, "_pid").agg(
                F.coalesce(F.sum(F.when(valued, F.col("_c"))), F.lit(0)).alias("_pc"),
                F.sum("_c").alias("_rows"), F.min("_x").alias("_mn"), F.max("_x").alias("_mx"),
                F.sum(F.col("_x") * F.col("_c")).alias("_sx"))
              .withColumn("_start", F.coalesce(
                  F.sum("_pc").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_n", F.sum("_pc").over(Window.partitionBy(*keys))))

    # wanted 0-based ranks: floor and ceil of (n - 1) q for every q.
    h = [(F.col("_n") - 1) * F.lit(q) for q in probs]
    lo_r = [F.floor(e) for e in h]
    hi_r = [F.ceil(e) for e in h]
    ranks = F.array(*lo_r, *hi_r)

    def holds(first, last):
        return F.exists(ranks, lambda r: (r >= first) & (r < last))

    # 4. sort only the ranges that hold a wanted rank (<= 2 len(probs) per group).
    need = rdir.where(holds(F.col("_start"), F.col("_start") + F.col("_pc"))) \
               .select(*keys, "_pid", "_start", "_n")
    if not by or max_groups:
        need = F.broadcast(need)  # at most groups * 2 * len(probs) rows
    cand = vr.where(valued).join(need, [*keys, "_pid"], "inner")
    wp = Window.partitionBy(*keys, "_pid").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    cand = (cand.withColumn("_end", F.col("_start") + F.sum("_c").over(wp))
                .withColumn("_begin", F.col("_end") - F.col("_c")))
    hit = cand.where(holds(F.col("_begin"), F.col("_end")))

    def at(rank):
        return F.max(F.when((rank >= F.col("_begin")) & (rank < F.col("_end")), F.col("_x")))

    aggs = []
    for i in range(len(probs)):
        aggs += [at(lo_r[i]).alias(f"_lo{i}"), at(hi_r[i]).alias(f"_hi{i}"),
                 F.first(h[i]).alias(f"_h{i}")]
    out = hit.groupBy(*keys).agg(*aggs)
    out = out.select(*keys, *[
        (F.col(f"_lo{i}") + (F.col(f"_h{i}") - F.floor(f"_h{i}")) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(n)
        for i, n in enumerate(names)])
    if stats:
        # per-group totals from the range directory (groups x P rows)
        gst = rdir.groupBy(*keys).agg(
            F.sum("_rows").alias("rows"), F.sum("_pc").alias("count"), F.min("_mn").alias("min"),
            F.max("_mx").alias("max"), F.sum("_sx").alias("sum"))
        if not by:
            # one group: the quantiles enter as a scalar subquery (a join on
            # the constant key would fold into a cross join)
            qv = out.select(F.struct(*names)).scalar()
            return gst.select(*[qv.getField(n).alias(n) for n in names], *STATS)
        if max_groups:
            out = F.broadcast(out)  # one row per group, bounded as above
        out = gst.join(out, keys, "left").select(*keys, *names, *STATS)
    return out if by else out.drop("_g")


def quantile_scalar(df: DataFrame, col: str, q: float, **kw):
    """A lazy scalar-subquery Column holding one quantile of ``col``."""
    return exact_quantiles(df, col, [q], names=["_q"], **kw).select("_q").scalar()
