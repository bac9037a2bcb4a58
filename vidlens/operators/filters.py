"""Filters and counted predicates.

Predicates are plain Column expressions, so Catalyst pushes the comparisons
into the Parquet scan (``PushedFilters``) and prunes row groups.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidlens import schema as S
from vidlens.functions.columns import parse_range
from vidlens.operators.quantiles import exact_quantiles

# How bounds typed as text are read, per column.
RANGE_CASTS = {"age": int, "views": int, "rating": float}


def range_filter(df: DataFrame, ranges: Mapping[str, object] | None = None) -> DataFrame:
    """Keep rows with every given column inside its inclusive range.

    ``ranges`` maps column -> ``(lo, hi)``, used as given, or ``"lo-hi"`` text,
    whose bounds are sorted; blank text means no filter.  No ranges -> the input unchanged.
    Malformed bounds raise ``ValueError``.
    """
    conds = []
    for col, spec in (ranges or {}).items():
        try:
            b = parse_range(spec, RANGE_CASTS.get(col, float))
        except (TypeError, ValueError) as e:
            raise ValueError(f"bad range for column {col!r}: {e}") from e
        if b is None:
            continue
        if col not in df.columns:
            raise ValueError(f"cannot filter on {col!r}: the table has no such column")
        conds.append(F.col(col).between(F.lit(b[0]), F.lit(b[1])))
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def filter_videos(df: DataFrame, age_range=None, views_range=None, rating_range=None) -> DataFrame:
    """D1 with the reference's keyword arguments."""
    return range_filter(df, {"age": age_range, "views": views_range, "rating": rating_range})


_OPS = {"=": lambda c, v: c == v, "==": lambda c, v: c == v, ">": lambda c, v: c > v,
        ">=": lambda c, v: c >= v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
        "!=": lambda c, v: c != v}


def predicate(col: str, op: str, value) -> Column:
    """``col op value`` as a Column (string equality, >, float equality)."""
    return _OPS[op](F.col(col), F.lit(value))


def describe_predicate(col: str, op: str, value) -> str:
    v = f"'{value}'" if isinstance(value, str) else repr(value)
    return f"{col} {op} {v}"


def count_matches(df: DataFrame, predicates: Sequence = S.EXAMPLE_PREDICATES,
                  names: Sequence[str] | None = None) -> DataFrame:
    """Matched-row count of every predicate in one scan, as ``(query, matched)``.

    ``predicates`` holds ``(col, op, value)`` triples or Columns.  All counts
    are one aggregate; the single result row is unpivoted into one row each.
    """
    conds, labels = [], []
    for i, p in enumerate(predicates):
        if isinstance(p, Column):
            conds.append(p)
            labels.append(names[i] if names else f"q{i}")
        else:
            conds.append(predicate(*p))
            labels.append(names[i] if names else describe_predicate(*p))
    row = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"m{i}") for i, c in enumerate(conds)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(lab).alias("query"), F.col(f"m{i}").alias("matched"))
        for i, lab in enumerate(labels)])).alias("e")).select("e.query", "e.matched")


def length_window(df: DataFrame, col: str = "length", bounds=S.LENGTH_WINDOW) -> DataFrame:
    """Strict ``lo < col < hi``."""
    lo, hi = bounds
    return df.where((F.col(col) > lo) & (F.col(col) < hi))


def quantile_bounds(df: DataFrame, col: str = "views", probs=S.BAND_QUANTILES, **kw) -> Column:
    """F8 as a lazy scalar struct ``(lo, hi)`` (one row, computed once)."""
    q = exact_quantiles(df, col, probs, names=["lo", "hi"], **kw)
    return q.select(F.struct("lo", "hi")).scalar()


def quantile_band(df: DataFrame, col: str = "views", probs=S.BAND_QUANTILES, **kw) -> DataFrame:
    """Keep rows whose ``col`` lies between two quantiles, inclusive.

    The quantiles are computed on ``df`` itself (so apply D7 first, as the
    reference does) and enter the filter as a scalar subquery -- no join.
    """
    b = quantile_bounds(df, col, probs, **kw)
    return df.where(F.col(col).between(b.getField("lo"), b.getField("hi")))


def valid_age(df: DataFrame, col: str = "age") -> DataFrame:
    """Age known and not negative (drops the -1 sentinel)."""
    return df.where(F.col(col).isNotNull() & (F.col(col) >= 0))
