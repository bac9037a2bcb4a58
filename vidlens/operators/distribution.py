"""Histogram, density and per-bin distribution shape.

Scalars (min, max, n, spread) enter as lazy scalar subqueries; the per-row
work is one projection plus a partial aggregation into a bounded number of
bins, so cost after the scan does not grow with the table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidlens import schema as S
from vidlens.functions.columns import length_range, length_range_order
from vidlens.operators.filters import length_window, quantile_band
from vidlens.operators.quantiles import exact_quantiles
from vidlens.session import checkpoint_root

SQRT_2PI = math.sqrt(2.0 * math.pi)


def _log_values(df: DataFrame, col: str, weight: str | None = None) -> DataFrame:
    """``lv, c``: the logarithms and how often each row counts."""
    return df.where(F.col(col) > 0).select(F.log10(F.col(col).cast("double")).alias("lv"),
                                           (F.col(weight) if weight else F.lit(1)).alias("c"))


def _span(lo, hi):
    """numpy's rule for a degenerate range: widen a single value by 0.5 each way."""
    same = lo == hi
    return F.when(same, lo - 0.5).otherwise(lo), F.when(same, hi + 0.5).otherwise(hi)


def _bin_index(x, lo, hi, bins):
    """Equal-width bin of ``x`` on ``[lo, hi]``; the last bin is closed."""
    return F.least(F.floor((x - lo) / (hi - lo) * F.lit(bins)).cast("int"), F.lit(bins - 1))


def log_histogram(df: DataFrame, col: str = "views", bins: int = S.HISTOGRAM_BINS,
                  weight: str | None = None) -> DataFrame:
    """``bins`` equal bins on ``log10(col)`` over positive values.

    ``weight`` names a column that says how many rows a row stands for.

    Output ``bin, bin_lo, bin_hi, count`` for every bin (empty bins give 0);
    edges are in the original units.
    """
    lv = _log_values(df, col, weight)
    b = lv.agg(F.min("lv").alias("lo"), F.max("lv").alias("hi")).select(F.struct("lo", "hi")).scalar()
    lo, hi = _span(b.getField("lo"), b.getField("hi"))
    counts = lv.groupBy(_bin_index(F.col("lv"), lo, hi, bins).alias("bin")).agg(
        F.sum("c").alias("count"))
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / F.lit(bins)
    # counts has at most ``bins`` rows: a proven bound for the broadcast.
    return (grid.join(F.broadcast(counts), "bin", "left")
                .select("bin",
                        F.pow(F.lit(10.0), lo + F.col("bin") * width).alias("bin_lo"),
                        F.pow(F.lit(10.0), lo + (F.col("bin") + 1) * width).alias("bin_hi"),
                        F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def kde(df: DataFrame, col: str = "views", points: int = S.DENSITY_GRID, tolerance: float = S.DENSITY_TOLERANCE,
        by: str | None = None, log: bool = True, cut: float = 0.0, peak_normalise: bool = False,
        weight: str | None = None) -> DataFrame:
    """Gaussian kernel density of ``col`` (or of ``log10(col)``) on a grid.

    Bandwidth is Scott's rule, ``h = stddev_samp * n^(-1/5)``; the grid has
    ``points`` evenly spaced points from ``min - cut*h`` to ``max + cut*h``.
    Every density is within ``tolerance`` times ``1 / (h * sqrt(2 pi))``, the
    largest value a curve of this bandwidth can have, of the sum over all
    rows (see :func:`_curves`).

    ``by`` gives one curve per group.  ``peak_normalise`` scales each curve to
    a maximum of 1.  ``log=True`` drops values <= 0 (the log axis) and adds
    ``log_x``.  One row, or rows that are all alike, have no bandwidth and no
    curve; null and NaN are left out, and so are rows of a null group.

    ``weight`` names a column that says how many rows a row stands for; the
    spread is then taken from sums of squares, which a log axis keeps small.
    """
    if weight and not log:
        raise ValueError("weights need the log axis")
    keys = [by] if by else []
    v = F.col(col).cast("double")
    c = (F.col(weight) if weight else F.lit(1)).alias("c")
    if log:
        src = df.where((F.col(col) > 0) & ~F.isnan(v)).select(*keys, F.log10(v).alias("lv"), c)
    else:
        src = df.where(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("lv"), c)
    if by:
        src = src.where(F.col(by).isNotNull())
    spread = F.stddev_samp("lv")
    if weight:
        n, total = F.sum("c"), F.sum(F.col("c") * F.col("lv"))
        spread = F.when(F.min("lv") < F.max("lv"), F.sqrt(F.greatest(F.lit(0.0), F.try_divide(
            F.sum(F.col("c") * F.col("lv") * F.col("lv")) - total * total / n, n - 1))))
    stats = src.groupBy(*keys).agg(
        F.sum("c").alias("n"), F.min("lv").alias("lo"), F.max("lv").alias("hi"), spread.alias("sd"))
    dens = _curves(src, stats, keys, points, tolerance, cut, peak_normalise)
    xs = ([F.col("x").alias("log_x"), F.pow(F.lit(10.0), F.col("x")).alias("x")] if log else [F.col("x")])
    return dens.select(*keys, "point", *xs, "density")


def _curves(values: DataFrame, stats: DataFrame, keys: list[str], points: int, tolerance: float,
            cut: float, peak_normalise: bool, few: bool = False) -> DataFrame:
    """``keys, point, x, density`` from values ``lv`` that occur ``c`` times and
    the ``n, lo, hi, sd`` of each group.

    The values are binned linearly: the range is cut into cells of width
    ``d``, and a value between two nodes counts for both by its distances.
    That replaces the kernel by its chord on a cell, which is off by at most
    ``d^2 / 8`` times the kernel's largest second derivative, so by
    ``(d / h)^2 / 8`` of the kernel's peak.  A cell adds to the points within
    ``r`` bandwidths only; what is left out is at most ``exp(-r^2 / 2)`` of the
    peak.  ``d`` and ``r`` are chosen so that both together stay within
    ``tolerance``.  There are ``(hi - lo) / d`` cells, which grows as the fifth
    root of the rows, and each adds to fewer points in the same measure: the
    terms do not grow with the table.

    ``few`` says that the groups are few by construction, so that their
    statistics (one row a group) may be broadcast.
    """
    beyond = tolerance / 1000
    width, reach = math.sqrt(8 * (tolerance - beyond)), math.sqrt(-2 * math.log(beyond))
    stats = (stats.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).where(F.col("h") > 0)
                  .select(*keys, "n", "lo", "hi", "h",
                          F.ceil((F.col("hi") - F.col("lo")) / (F.col("h") * F.lit(width))).alias("cells"),
                          (F.col("lo") - F.lit(float(cut)) * F.col("h")).alias("g0"),
                          ((F.col("hi") - F.col("lo") + F.lit(2.0 * cut) * F.col("h")) / F.lit(points - 1)).alias("step")))
    known = ["n", "lo", "hi", "h", "cells", "g0", "step"]
    if keys:
        placed = values.join(F.broadcast(stats) if few else stats, keys)
        grid = stats.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    else:
        s = stats.select(F.struct(*known)).scalar()
        given = [s.getField(k).alias(k) for k in known]
        placed = values.select("lv", "c", *given).where(F.col("h").isNotNull())
        grid = (values.sparkSession.range(points).select(F.col("id").cast("int").alias("point"), *given)
                      .where(F.col("h").isNotNull()))
    place = (F.col("lv") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("cells")
    placed = (placed.withColumn("place", place)
                    .withColumn("cell", F.least(F.floor("place"), F.col("cells") - 1)))
    mass = placed.groupBy(*keys, "cell", *known).agg(
        F.sum("c").alias("m"), F.sum(F.col("c") * (F.col("place") - F.col("cell"))).alias("right"))
    d = (F.col("hi") - F.col("lo")) / F.col("cells")
    at, far = F.col("lo") + F.col("cell") * d, F.lit(reach) * F.col("h")
    mass = (mass.withColumn("left_at", at).withColumn("right_at", at + d)
                .withColumn("first", F.greatest(F.lit(0), F.ceil((F.col("left_at") - far - F.col("g0")) / F.col("step")).cast("int")))
                .withColumn("last", F.least(F.lit(points - 1), F.floor((F.col("right_at") + far - F.col("g0")) / F.col("step")).cast("int")))
                .where(F.col("first") <= F.col("last")))
    x = F.col("g0") + F.col("point") * F.col("step")

    def kernel(node):
        u = (x - F.col(node)) / F.col("h")
        return F.exp(F.lit(-0.5) * u * u)

    terms = (mass.withColumn("point", F.explode(F.sequence("first", "last")))
                 .select(*keys, "point", ((F.col("m") - F.col("right")) * kernel("left_at")
                                          + F.col("right") * kernel("right_at")).alias("t"), x.alias("x"), "n", "h"))
    # a point that no cell reaches has a row as well
    terms = terms.unionByName(grid.select(*keys, "point", F.lit(0.0).alias("t"), x.alias("x"), "n", "h"))
    dens = terms.groupBy(*keys, "point").agg(
        F.first("x").alias("x"), (F.sum("t") / (F.first("n") * F.first("h") * F.lit(SQRT_2PI))).alias("density"))
    if peak_normalise:
        # a window over the points of a curve, so never more than ``points`` rows
        w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        dens = dens.withColumn("density", F.try_divide(F.col("density"), F.max("density").over(w)))
    return dens.select(*keys, "point", "x", "density")


def log_density(df: DataFrame, col: str = "views", points: int = S.DENSITY_GRID,
                tolerance: float = S.DENSITY_TOLERANCE, by: str | None = None,
                peak_normalise: bool = False, weight: str | None = None) -> DataFrame:
    """the histogram's density curve -- KDE of ``log10(col)`` on
    ``points`` points from min to max (no extension past the data)."""
    return kde(df, col, points, tolerance, by=by, log=True, cut=0.0, peak_normalise=peak_normalise,
               weight=weight)


def length_range_table(df: DataFrame, col: str = "views", length: str = "length") -> DataFrame:
    """F16 input: D7 -> D8 -> E3, rows with ``length_range`` and its order."""
    band = quantile_band(length_window(df, length), col)
    return band.select("*", length_range(length).alias("length_range"),
                       length_range_order(length).alias("range_order"))


class LengthDirectory:
    """How often each value of a column occurs in each length range.

    One pass over the table makes it: rows ``range_order, value, n`` of the
    length window, a row for each distinct value of a range, dealt into parts
    of consecutive values (column ``part``).  The band, the quartiles and the
    curves are all read from it; a rank is found by the parts' totals, and only
    the parts that hold a wanted one are sorted.  A value or range of a third of
    all rows is one row.  Null and NaN have no place in the band and are left
    out; rows of the window outside every range count for the band.

    :meth:`of` is lazy, for one result; :meth:`build` stores the directory, so
    that several results take one scan of the table.  A stored directory is
    valid for as long as the table does not change.
    """

    def __init__(self, rows: DataFrame):
        self.rows = rows

    @classmethod
    def of(cls, df: DataFrame, col: str = "views", length: str = "length",
           partitions: int | None = None) -> "LengthDirectory":
        spark = df.sparkSession
        value = F.col(col).cast("double")
        counted = (length_window(df, length).select(length_range_order(length).alias("range_order"), value.alias("value"))
                   .where(F.col("value").isNotNull() & ~F.isnan("value"))
                   .groupBy("range_order", "value").agg(F.count(F.lit(1)).alias("n")))
        parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = counted.repartitionByRange(parts, "value", "range_order").withColumn("part", F.spark_partition_id())
        # all readers take one reused exchange; without reuse the parts are fixed by a checkpoint
        if spark.conf.get("spark.sql.exchange.reuse", "true").lower() == "false":
            checkpoint_root(spark)
            rows = rows.checkpoint(eager=True)
        return cls(rows)

    @classmethod
    def build(cls, df: DataFrame, path: str, col: str = "views", length: str = "length",
              partitions: int | None = None) -> "LengthDirectory":
        """Count once and write the directory to ``path`` (an older one is replaced)."""
        rows = cls.of(df, col, length, partitions).rows
        rows.write.mode("overwrite").parquet(path)
        return cls(df.sparkSession.read.schema(rows.schema).parquet(path))

    def band(self, probs=S.BAND_QUANTILES):
        """D8's bounds as a lazy scalar struct ``(lo, hi)``."""
        return value_quantiles(self.rows, probs, ["lo", "hi"]).select(F.struct("lo", "hi")).scalar()

    def in_band(self, probs=S.BAND_QUANTILES) -> DataFrame:
        """The directory's rows within the band that lie in a length range."""
        b = self.band(probs)
        return self.rows.where(F.col("range_order").isNotNull()
                               & F.col("value").between(b.getField("lo"), b.getField("hi")))

    def summary(self) -> DataFrame:
        """Per length range, in range order: ``n, min, q1, median, q3, max``."""
        q = _ranked(self.in_band(), "range_order", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
        return q.select(_label(), "range_order", "n", "min", "q1", "median", "q3", "max").orderBy("range_order")

    def density(self, points: int = S.VIOLIN_GRID, cut: float = S.VIOLIN_CUT,
                tolerance: float = S.DENSITY_TOLERANCE) -> DataFrame:
        """Per length range, a violin curve scaled to peak 1."""
        # spread by sums above the band's start, which keeps them small beside the values
        rows = self.in_band().withColumn("above", F.col("value") - self.band().getField("lo"))
        n, total = F.sum("n"), F.sum(F.col("n") * F.col("above"))
        spread = F.sum(F.col("n") * F.col("above") * F.col("above")) - total * total / n
        stats = rows.groupBy("range_order").agg(
            n.alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
            F.sqrt(F.greatest(F.lit(0.0), F.try_divide(spread, n - 1))).alias("sd"))
        # at most one row a length range
        dens = _curves(rows.select("range_order", F.col("value").alias("lv"), F.col("n").alias("c")), stats,
                       ["range_order"], points, tolerance, cut, peak_normalise=True, few=True)
        return dens.select(_label(), "point", "x", "density")


def _label():
    return F.element_at(F.array(*[F.lit(lab) for lab in S.LENGTH_LABELS]), F.col("range_order") + 1).alias("length_range")


def value_quantiles(rows: DataFrame, probs, names) -> DataFrame:
    """``n, min, max`` and the quantiles of all values of a directory (columns
    ``value, n, part``), one row; none where it is empty."""
    return _ranked(rows.withColumn("whole", F.lit(0)), "whole", probs, names).drop("whole")


def _ranked(rows: DataFrame, group: str, probs, names) -> DataFrame:
    """Per ``group``, its ``n, min, max`` and the interpolated quantiles of ``value``.

    ``rows`` are a directory's.  The groups are the length ranges or the whole,
    so the places joined below are a few rows and broadcast.
    """
    over = Window.partitionBy(group)
    parts = (rows.groupBy(group, "part").agg(F.sum("n").alias("held"), F.min("value").alias("min"),
                                             F.max("value").alias("max"))
                 .select(group, "part", "held", F.sum("held").over(over).alias("total"),
                         F.min("min").over(over).alias("min"), F.max("max").over(over).alias("max"),
                         (F.sum("held").over(over.orderBy("part")) - F.col("held")).alias("before")))
    places = [(F.col("total") - 1) * F.lit(float(q)) for q in probs]
    ranks = F.array(*[F.floor(p) for p in places], *[F.ceil(p) for p in places])

    def holds(first, end):
        return F.exists(ranks, lambda r: (r >= first) & (r < end))

    need = parts.where(holds(F.col("before"), F.col("before") + F.col("held"))).drop("held")
    running = Window.partitionBy(group, "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    near = (rows.join(F.broadcast(need), [group, "part"])
                .withColumn("end", F.col("before") + F.sum("n").over(running))
                .withColumn("begin", F.col("end") - F.col("n"))
                .where(holds(F.col("begin"), F.col("end"))))

    def at(rank):
        return F.max(F.when((rank >= F.col("begin")) & (rank < F.col("end")), F.col("value")))

    found = near.groupBy(group, "total", "min", "max").agg(*[
        c for i, p in enumerate(places) for c in (at(F.floor(p)).alias(f"lo{i}"), at(F.ceil(p)).alias(f"hi{i}"))])
    return found.select(group, F.col("total").alias("n"), "min", "max", *[
        (F.col(f"lo{i}") + (p - F.floor(p)) * (F.col(f"hi{i}") - F.col(f"lo{i}"))).alias(name)
        for i, (p, name) in enumerate(zip(places, names))])


def length_range_summary(df: DataFrame, col: str = "views", length: str = "length",
                         method: str = "exact") -> DataFrame:
    """F16: per length range, ``n, min, q1, median, q3, max`` of ``col``.

    Quartiles are exact (linear interpolation) and, like the band, read from
    one :class:`LengthDirectory`.  Empty ranges are absent; rows are in range
    order.  Other methods are those of :func:`exact_quantiles`.
    """
    if method == "exact":
        return LengthDirectory.of(df, col, length).summary()
    t = length_range_table(df, col, length).where(F.col("length_range").isNotNull())
    basic = t.groupBy("length_range", "range_order").agg(
        F.count(F.col(col)).alias("n"), F.min(col).cast("double").alias("min"),
        F.max(col).cast("double").alias("max"))
    q = exact_quantiles(t, col, [0.25, 0.5, 0.75], by=["length_range", "range_order"],
                        names=["q1", "median", "q3"], method=method)
    # both sides have one row per length range (at most six)
    qs = basic.join(F.broadcast(q), ["length_range", "range_order"])
    return (qs.select("length_range", "range_order", "n", "min", "q1", "median", "q3", "max")
              .orderBy("range_order"))


def length_range_density(df: DataFrame, col: str = "views", length: str = "length",
                         points: int = S.VIOLIN_GRID, cut: float = S.VIOLIN_CUT) -> DataFrame:
    """F16 shapes: per-range violin curves of ``col`` (linear values, as the
    violins are drawn before the axis turns logarithmic), grid extended
    ``cut`` bandwidths past the data, each curve scaled to peak 1 (equal
    widths)."""
    return LengthDirectory.of(df, col, length).density(points, cut)
