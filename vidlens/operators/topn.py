"""Sort, top-k, paging and preview."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlens import schema as S


def validate_n(n, default: int = S.TOP_N_DEFAULT, upper: int = S.TOP_N_MAX) -> int:
    """Non-integers and values outside 1..upper fall back to the default."""
    try:
        v = int(str(n).strip())
    except (TypeError, ValueError):
        return default
    return v if 1 <= v <= upper else default


def orderable_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns that can take part in a sort (maps cannot)."""
    return [f.name for f in df.schema.fields
            if f.name not in exclude and not isinstance(f.dataType, T.MapType)]


def total_order(df: DataFrame, first: Sequence, tie_break: Sequence[str] | None = None,
                exclude: Sequence[str] = ()):
    """Sort expressions: ``first`` then the tie-break columns ascending, nulls last.

    By default every other column is a tie-break, which makes ties
    deterministic (S1) even when the key column is not unique.
    """
    used = {e for e in first if isinstance(e, str)} | set(exclude)
    exprs = [F.col(e).asc_nulls_last() if isinstance(e, str) else e for e in first]
    rest = list(tie_break) if tie_break is not None else orderable_columns(df, used)
    return exprs + [F.col(c).asc_nulls_last() for c in rest if c not in used]


def known(df: DataFrame, col: str):
    """The column with NaN as null."""
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), F.col(col))
    return F.col(col)


def top_n(df: DataFrame, metric: str, n=S.TOP_N_DEFAULT,
          tie_break: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` rows with the largest ``metric`` (null and NaN last).

    Any ``n`` from 1 on is honoured; text, as typed into a box, goes through
    :func:`validate_n`.  ``orderBy(...).limit(n)`` plans as
    TakeOrderedAndProject: every task keeps its own top ``n`` and only those
    reach the final merge -- no full sort.
    """
    k = validate_n(n) if isinstance(n, str) else int(n)
    if k < 1:
        raise ValueError("n must be at least 1")
    order = total_order(df, [known(df, metric).desc_nulls_last()], tie_break, exclude=[metric])
    return df.orderBy(*order).limit(k)


def top_views(df: DataFrame, n=S.TOP_N_DEFAULT, **kw) -> DataFrame:
    return top_n(df, "views", n, **kw)


def top_rating(df: DataFrame, n=S.TOP_N_DEFAULT, **kw) -> DataFrame:
    return top_n(df, "rating", n, **kw)


def top_comments(df: DataFrame, n=S.TOP_N_DEFAULT, **kw) -> DataFrame:
    return top_n(df, "comments_count", n, **kw)


def sort_by(df: DataFrame, col: str, ascending: bool = True) -> DataFrame:
    """Ordered result (ties by the remaining columns)."""
    c = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()
    return df.orderBy(*total_order(df, [c], exclude=[col]))


def page_count(n_rows: int, size: int = S.PAGE_SIZE) -> int:
    """Total pages, ``ceil(rows / size)``."""
    return max(0, math.ceil(n_rows / size))


def next_page(current: int, n_pages: int) -> int:
    """Next page, clamped at the last page."""
    return min(current + 1, max(n_pages - 1, 0))


def prev_page(current: int) -> int:
    """Previous page, clamped at page 0."""
    return max(current - 1, 0)


#: Rows that a task may keep for a page: up to here a page is a plain top-k.
SHALLOW_ROWS = 10_000


def page(df: DataFrame, number: int = 0, size: int = S.PAGE_SIZE,
         order_by: Sequence[str] | None = None, sort_col: str | None = None,
         ascending: bool = True, partitions: int | None = None) -> DataFrame:
    """Rows ``[number*size, (number+1)*size)`` in a total order.

    The total order is ``order_by`` and then every other column.  A page that
    ends within the first ``SHALLOW_ROWS`` rows is a top-k: each task keeps that
    many.  A deeper one is found by the order's values at its first row and
    behind its last (``ranked_keys``): the table is scanned with these as a
    filter and the page is what is left.  Nothing runs before the page is
    asked for.  For many pages of one table build a ``PageIndex``.
    ``sort_col`` re-sorts the rows of the shown page only.
    """
    if number < 0:
        raise ValueError("page number must be >= 0")
    keys = _order_keys(df, order_by)
    first = number * size
    order = total_order(df, keys)
    if first + size <= SHALLOW_ROWS:
        rows = df.orderBy(*order).offset(first).limit(size)
    else:
        ranked = ranked_keys(df, keys, partitions).where(F.col("rank").isin(first, first + size))
        rows = _between(df, keys, ranked, first, first + size).orderBy(*order).limit(size)
    return _sorted_page(rows, sort_col, ascending)


def _order_keys(df: DataFrame, order_by: Sequence[str] | None) -> list[str]:
    first = list(order_by) if order_by else [S.KEY] if S.KEY in df.columns else orderable_columns(df)[:1]
    return first + orderable_columns(df, first)


def _sorted_page(rows: DataFrame, sort_col: str | None, ascending: bool) -> DataFrame:
    if not sort_col:
        return rows
    c = F.col(sort_col).asc_nulls_last() if ascending else F.col(sort_col).desc_nulls_last()
    return rows.orderBy(*total_order(rows, [c], exclude=[sort_col]))


def _place(columns: Sequence[str]):
    """The columns as one value that compares as they order: ascending, nulls last."""
    return F.struct(*[F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("value")).alias(f"k{i}")
                      for i, c in enumerate(columns)])


def ranked_keys(df: DataFrame, order_by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``(rank, place)`` of every row: its number from 0 in the order of all ``order_by``, nulls last.

    The order columns are range-partitioned as a whole, so equal first columns
    are spread like any others, and sorted per range; a rank is the row's number
    in its range plus the rows of the ranges before (a row a range).  Both are
    read from one exchange.
    """
    from pyspark.sql import Window
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_last() for c in order_by]
    ranges = df.select(*order_by).repartitionByRange(n, *order)
    sizes = ranges.groupBy(F.spark_partition_id().alias("range")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start"))
    rows = ranges.sortWithinPartitions(*order).select(
        F.spark_partition_id().alias("range"), F.monotonically_increasing_id().bitwiseAND(F.lit(2 ** 33 - 1)).alias("row"),
        _place(order_by).alias("place"))
    # one row per range, a number the caller sets
    return rows.join(F.broadcast(starts), "range").select((F.col("start") + F.col("row")).alias("rank"), "place")


def _between(df: DataFrame, keys: Sequence[str], ranked: DataFrame, first: int, end: int) -> DataFrame:
    """The rows from rank ``first`` up to (without) ``end``, whose places ``ranked`` holds as far as they exist."""
    def at(rank):
        return ranked.where(F.col("rank") == rank).select("place").scalar()
    lower, upper = at(first), at(end)
    place = _place(keys)
    # the first column once more by itself, for the scan
    k, lo = F.col(keys[0]), lower.getField("k0").getField("value")
    return df.where((place >= lower) & F.coalesce(place < upper, F.lit(True)) & ((k >= lo) | k.isNull()))


class PageIndex:
    """A stored index for pages of one table in one order.

    It holds the order's values at every ``stride``-th row and the number of
    rows.  A page reads two of its entries, scans the table with them as a
    filter, and takes a top-k of at most a stride and a page.  It is valid for
    as long as the table does not change.
    """

    def __init__(self, spark, path: str, order_by: Sequence[str], stride: int):
        self.spark, self.path, self.order_by, self.stride = spark, path, list(order_by), stride

    @classmethod
    def build(cls, df: DataFrame, path: str, order_by: Sequence[str] | None = None, stride: int = 1000,
              partitions: int | None = None) -> "PageIndex":
        """Rank the order columns of ``df`` once and write the entries to ``path``."""
        keys = _order_keys(df, order_by)
        last = df.agg(F.count(F.lit(1)).alias("n")).scalar()
        ranked_keys(df, keys, partitions).where((F.col("rank") % stride == 0) | (F.col("rank") == last - 1)).write.parquet(path)
        return cls(df.sparkSession, path, keys, stride)

    def entries(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def rows(self) -> int:
        """Rows of the indexed table."""
        return (self.entries().agg(F.max("rank")).first()[0] + 1) if not self.entries().isEmpty() else 0

    def page(self, df: DataFrame, number: int = 0, size: int = S.PAGE_SIZE,
             sort_col: str | None = None, ascending: bool = True) -> DataFrame:
        """G8/G9 by the index; ``df`` is the indexed table."""
        if number < 0:
            raise ValueError("page number must be >= 0")
        first, stride = number * size, self.stride
        start, end = first // stride * stride, -(-(first + size) // stride) * stride
        rows = _between(df, self.order_by, self.entries().where(F.col("rank") % stride == 0), start, end)
        return _sorted_page(rows.orderBy(*total_order(df, self.order_by)).offset(first - start).limit(size), sort_col, ascending)


def preview(df: DataFrame, n: int = S.PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows (``df.schema`` gives the schema print)."""
    return df.limit(n)
