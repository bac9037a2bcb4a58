"""Aggregations and statistics.

Every result is one ``agg`` pass or a small composition of them; partial
aggregation runs map-side, so a category holding a third of all rows costs
one partial row per task before the shuffle.
"""

from __future__ import annotations

from itertools import combinations
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlens import schema as S
from vidlens.operators.quantiles import exact_quantiles
from vidlens.operators.topn import known, top_n

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def summary_statistics(df: DataFrame, col: str = "views", method: str = "exact") -> DataFrame:
    """One row ``total_videos, average_<col>, median_<col>``.

    With the exact method, the row count, the mean and the median all come
    from one pass: the distributed quantile operator's value-count table also
    yields the totals.  The final global aggregate keeps exactly one row (an
    empty table gives 0, null, null).
    """
    if method != "exact":
        med = exact_quantiles(df, col, [0.5], names=["m"], method=method).select("m").scalar()
        return df.agg(F.count(F.lit(1)).alias("total_videos"),
                      F.avg(F.col(col)).alias(f"average_{col}")).select("*", med.alias(f"median_{col}"))
    q = exact_quantiles(df, col, [0.5], names=["median"], stats=True)
    return q.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_videos"),
        F.try_divide(F.sum("sum"), F.sum("count")).alias(f"average_{col}"),
        F.max("median").alias(f"median_{col}"))


def arg_max_row(df: DataFrame, metric: str, tie_break: Sequence[str] | None = None) -> DataFrame:
    """the whole row with the largest ``metric``.

    Ties go to the smallest remaining columns (a total order instead of the
    storage order), so the answer is the same on every run.
    """
    return top_n(df, metric, 1, tie_break=tie_break)


def top_rated(df: DataFrame, **kw) -> DataFrame:
    return arg_max_row(df, "rating", **kw)


def most_watched(df: DataFrame, **kw) -> DataFrame:
    return arg_max_row(df, "views", **kw)


def category_stats(df: DataFrame, key: str = "category",
                   metrics: Sequence[str] = ("views", "rating"),
                   drop_null_keys: bool = False, order: str | None = None,
                   normalise: bool = False) -> DataFrame:
    """mean of each metric per key, columns ``avg_<metric>``.

    ``drop_null_keys`` removes the null group (pandas path, C5); ``order`` is
    ``"desc"``/``"asc"`` on the first mean (G6/G7); ``normalise`` trims the key
    and unescapes ``&amp;`` so HTML-escaped twins fall into one group (S6).
    """
    k = F.col(key)
    if normalise:
        k = F.regexp_replace(F.trim(k), "&amp;", "&")
    src = df.select(k.alias(key), *metrics)
    if drop_null_keys:
        src = src.where(F.col(key).isNotNull())
    names = [f"avg_{m}" for m in metrics]
    out = src.groupBy(key).agg(*[F.avg(known(src, m)).alias(n) for m, n in zip(metrics, names)])
    return in_order(out, names[0], key, order)


def in_order(df: DataFrame, first: str, then: str, order: str | None) -> DataFrame:
    """``df`` by ``first`` (``"desc"``, ``"asc"`` or as it is), ties by ``then``."""
    if order is None:
        return df
    lead = F.col(first).desc_nulls_last() if order == "desc" else F.col(first).asc_nulls_last()
    return df.orderBy(lead, F.col(then).asc_nulls_last())


def quantiles(df: DataFrame, col: str = "views",
              probs: Sequence[float] = S.BAND_QUANTILES, **kw) -> DataFrame:
    """F8: one row of quantiles (linear interpolation)."""
    return exact_quantiles(df, col, probs, **kw)


def pair_correlations(df: DataFrame, pairs, means: dict | None = None) -> DataFrame:
    """Pearson r for every ``(a, b)`` pair as rows ``(i, a, b, r)``.

    One aggregate over the rows as they are: for each pair the co-moment, and
    each column's spread where the other is known (null and NaN are unknown,
    pandas' pairwise-complete rule).  These aggregates carry means along, and
    every column is taken from its mean over the table (a lazy scalar of one more
    aggregate), so that a large mean costs a small spread no digits, in whatever
    order tasks end; the partial aggregates leave one row a task.  A caller that
    has the means passes them as scalars by column, which saves that aggregate.
    ``corr`` raises on a constant column under ANSI, so
    ``try_divide(covar_pop, stddev_pop * stddev_pop)`` gives null instead; a
    pair without rows has a null r as well.
    """
    cols = sorted({c for p in pairs for c in p})
    x = {c: F.col(c).cast("double") for c in cols}
    rows = df.select(*[F.when(~F.isnan(x[c]), x[c]).alias(f"x{i}") for i, c in enumerate(cols)])
    if means is None:
        found = rows.agg(*[F.avg(f"x{i}").alias(f"x{i}") for i in range(len(cols))]).select(F.struct("*")).scalar()
        means = {c: found.getField(f"x{i}") for i, c in enumerate(cols)}

    def centred(i):
        mean = means[cols[i]]
        # none for a column of unknowns, nor where the sum overflows
        return F.col(f"x{i}") - F.when(F.abs(mean) < F.lit(float("inf")), mean).otherwise(F.lit(0.0))

    rows = rows.select(*[centred(i).alias(f"x{i}") for i in range(len(cols))])
    at = {c: F.col(f"x{i}") for i, c in enumerate(cols)}

    def spread(own, other):
        return F.stddev_pop(at[own] if own == other else F.when(at[other].isNotNull(), at[own]))

    moments = [F.try_divide(F.covar_pop(at[a], at[b]), spread(a, b) * spread(b, a)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    entries = [F.struct(F.lit(i).alias("i"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
               for i, (a, b) in enumerate(pairs)]
    return rows.agg(*moments).select(F.inline(F.array(*entries)))


def correlation_pairs(df: DataFrame, cols: Sequence[str] = S.CORRELATION_COLUMNS,
                      names: Sequence[str] = S.CORRELATION_NAMES, means: dict | None = None) -> DataFrame:
    """upper-triangle pairs ranked by absolute correlation, undefined dropped."""
    pairs = list(combinations(cols, 2))
    n1, n2, nr, na = names
    long = pair_correlations(df, pairs, means).where(F.col("r").isNotNull() & ~F.isnan("r"))
    return (long.select(F.col("a").alias(n1), F.col("b").alias(n2), F.col("r").alias(nr),
                        F.abs("r").alias(na))
            .orderBy(F.col(na).desc(), F.col(n1), F.col(n2)))


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None,
                       names=("x", "y", "r")) -> DataFrame:
    """full matrix of numeric columns as a long table ``(x, y, r)``.

    Each unordered pair is computed once and mirrored; undefined entries are
    null.  Only numeric columns take part (S15).
    """
    cols = list(cols) if cols else numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    r = pair_correlations(df, pairs)
    ab = F.struct(F.col("a").alias("x"), F.col("b").alias("y"), F.col("r").alias("r"))
    ba = F.struct(F.col("b").alias("x"), F.col("a").alias("y"), F.col("r").alias("r"))
    both = F.when(F.col("a") == F.col("b"), F.array(ab)).otherwise(F.array(ab, ba))
    nx, ny, nr = names
    return r.select(F.explode(both).alias("e")).select(
        F.col("e.x").alias(nx), F.col("e.y").alias(ny), F.col("e.r").alias(nr))


def correlation_wide(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """F13 pivoted: one row per column, one column per column (like ``.corr()``)."""
    cols = list(cols) if cols else numeric_columns(df)
    long = correlation_matrix(df, cols)
    return long.groupBy("x").pivot("y", cols).agg(F.first("r"))
