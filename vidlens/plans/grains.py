"""One pre-aggregate of several grains, from which the parts of a report are read.

A report asks the same table for category means, daily and monthly trends, the
mean and median of views, a histogram, curves and quartiles by length range.
All of them are sums over one of a few keys, so one aggregate with grouping
sets makes them in a single scan; the rankings take a second scan and the
correlations a third.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidlens import schema as S
from vidlens.functions.columns import length_range_order, month_start, upload_date
from vidlens.operators import stats
from vidlens.operators.distribution import LengthDirectory, value_quantiles
from vidlens.operators.filters import valid_age
from vidlens.operators.topn import known, orderable_columns

#: Grains and their keys; ``whole`` is the table in one row.
GRAINS = {"whole": [], "category": ["category"], "age": ["age"], "views": ["inside", "range_order", "views_value"],
          "rating": ["rating_value"], "comments_count": ["comments_count_value"]}
KEYS = ["category", "age", "inside", "range_order", "views_value", "rating_value", "comments_count_value"]
METRICS = ("views", "rating", "comments_count")
#: Up to this many rows a ranking is cut in every task before it is shuffled
#: (the session's ``spark.sql.window.group.limit.threshold`` by default).
GROUP_LIMIT = 1000


def _value(df: DataFrame, col: str):
    return known(df, col).cast("double")


class Grains:
    """Sums and counts of a video table by category, age, and value of each metric.

    :meth:`build` scans the table once and stores one row for each key of each
    wanted grain.  A category, age or value of a third of all rows is one row
    per task before the shuffle.  Rows are dealt into parts of consecutive
    values (column ``part``), so that quantiles sort only the parts with a
    wanted rank.  Defined cases: null keys are keys of their own; null and NaN
    metrics count as rows but not in means, quantiles or curves; an empty table
    gives a total of 0 and no means.  Valid while the table does not change.
    """

    def __init__(self, rows: DataFrame):
        self.rows = rows

    @classmethod
    def build(cls, df: DataFrame, path: str, grains: Sequence[str] = tuple(GRAINS),
              partitions: int | None = None) -> "Grains":
        """Aggregate ``df`` once and write the result to ``path`` (an older one is replaced)."""
        spark = df.sparkSession
        inside = F.coalesce((F.col("length") > S.LENGTH_WINDOW[0]) & (F.col("length") < S.LENGTH_WINDOW[1]), F.lit(False))
        src = df.select("category", "age", inside.alias("inside"),
                        F.when(inside, length_range_order("length")).alias("range_order"),
                        *[_value(df, m).alias(f"{m}_value") for m in METRICS],
                        *[_value(df, m).alias(m) for m in S.CORRELATION_COLUMNS])
        grains = [g for g in GRAINS if g in grains]
        keys = [k for k in KEYS if any(k in GRAINS[g] for g in grains)]
        # the bits of grouping_id say which keys a grain leaves out, the first key in the highest
        bits = {sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in GRAINS[g]): g for g in grains}
        sums = [F.count(F.lit(1)).alias("n")]
        for m in S.CORRELATION_COLUMNS:
            sums += [F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n")]
        if keys:
            agg = src.groupingSets([[F.col(k) for k in GRAINS[g]] for g in grains], *[F.col(k) for k in keys]) \
                     .agg(F.grouping_id().alias("gid"), *sums)
            name = F.element_at(F.create_map(*[x for b, g in bits.items() for x in (F.lit(b).cast("long"), F.lit(g))]), F.col("gid"))
        else:
            agg, name = src.agg(*sums), F.lit("whole")
        value = F.coalesce(*[F.col(f"{m}_value") for m in METRICS if f"{m}_value" in keys], F.lit(None).cast("double"))
        sparse = F.col("grain").isin("whole", "category", "age")
        rows = (agg.withColumn("grain", name).withColumn("value", value)
                   .select("grain", "value", "n",
                           *[(F.col(k) if k in keys else F.lit(None).cast(src.schema[k].dataType)).alias(k)
                             for k in ("category", "age", "inside", "range_order")],
                           # the grains by value need their counts only
                           *[F.when(sparse, F.col(f"{m}_{s}")).alias(f"{m}_{s}") for m in S.CORRELATION_COLUMNS for s in ("sum", "n")]))
        parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartitionByRange(parts, "grain", "value", "range_order").withColumn("part", F.spark_partition_id())
        rows.write.mode("overwrite").parquet(path)
        return cls(spark.read.schema(rows.schema).parquet(path))

    def of(self, grain: str) -> DataFrame:
        return self.rows.where(F.col("grain") == grain)

    def values(self, metric: str = "views") -> DataFrame:
        """``value, n, part``: the known values of a metric and how often each occurs."""
        return self.of(metric).where(F.col("value").isNotNull()).select("value", "n", "part", "inside", "range_order")

    def lengths(self) -> LengthDirectory:
        """The views by length range (F16)."""
        return LengthDirectory(self.values().where("inside").select("range_order", "value", "n", "part"))

    def means(self, cols: Sequence[str] = S.CORRELATION_COLUMNS) -> dict:
        """Each column's mean over the table, as a lazy scalar."""
        sums = self.of("whole").agg(*[F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n")).alias(c) for c in cols])
        held = sums.select(F.struct(*cols)).scalar()
        return {c: held.getField(c) for c in cols}

    def _means(self, rows: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
        return rows.groupBy(key).agg(*[
            F.try_divide(F.sum(f"{m}_sum"), F.sum(f"{m}_n")).alias(f"avg_{m}") for m in metrics])

    def summary(self) -> DataFrame:
        """F1-F3 as :func:`stats.summary_statistics` gives them, always one row."""
        median = value_quantiles(self.values(), [0.5], ["m"]).select("m").scalar()
        return self.of("whole").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_videos"),
            F.try_divide(F.sum("views_sum"), F.sum("views_n")).alias("average_views")) \
            .select("*", median.alias("median_views"))

    def category_stats(self, drop_null_keys: bool = False, order: str | None = None) -> DataFrame:
        """F6/F7 from the category rows."""
        out = self._means(self.of("category"), "category", ("views", "rating"))
        if drop_null_keys:
            out = out.where(F.col("category").isNotNull())
        return stats.in_order(out, "avg_views", "category", order)

    def daily_trend(self, anchor: str = S.DATE_ANCHOR, ordered: bool = True) -> DataFrame:
        """F9 from the age rows."""
        rows = self.of("age").withColumn("upload_date", upload_date("age", anchor))
        out = self._means(rows, "upload_date", ("views", "rating"))
        return out.orderBy("upload_date") if ordered else out

    def monthly_trend(self, anchor: str = S.DATE_ANCHOR) -> DataFrame:
        """F10 from the rows of valid ages."""
        rows = valid_age(self.of("age")).withColumn("upload_month", month_start(upload_date("age", anchor)))
        return self._means(rows, "upload_month", ("views", "rating")).orderBy("upload_month")

    def floor(self, metric: str, k: int):
        """The ``k``-th largest known value of a metric as a lazy scalar; null where there are fewer.

        At most ``k`` distinct values are looked at, as each occurs at least once.
        """
        top = self.values(metric).groupBy("value").agg(F.sum("n").alias("n")).orderBy(F.desc("value")).limit(k)
        seen = F.sum("n").over(Window.orderBy(F.desc("value")))
        return top.select("value", seen.alias("seen")).where(F.col("seen") >= k).agg(F.max("value").alias("v")).select("v").scalar()


class Leaders:
    """The first ``k`` rows of a table by views, rating and comments, from one scan.

    A row is looked at only where a metric reaches the ``k``-th largest value,
    which :class:`Grains` knows; those are about ``k`` rows a metric and all
    that tie with the last.  Each task keeps its own first ``k`` of them, so a
    tie of a third of all rows is sorted where it lies and not shuffled.  Order
    and ties are those of :func:`topn.top_n`: null and NaN last, equal values by
    the remaining columns.
    """

    def __init__(self, rows: DataFrame, k: int):
        self.rows, self.k = rows, k

    @classmethod
    def build(cls, df: DataFrame, grains: Grains, path: str, k: int) -> "Leaders":
        """Rank the candidates and write them to ``path``; ``k`` is at most ``GROUP_LIMIT``."""
        if not 1 <= k <= GROUP_LIMIT:
            raise ValueError(f"k must be from 1 to {GROUP_LIMIT}")
        floors = df.sparkSession.range(1).select(*[grains.floor(m, k).alias(m) for m in METRICS]) \
            .select(F.struct(*METRICS)).scalar()

        def wanted(m):
            least = floors.getField(m)
            return F.when(least.isNull() | F.coalesce(_value(df, m) >= least, F.lit(False)), F.lit(m))

        # the row as one column: no name of the table can clash with the ranking's
        every = (df.select(F.struct("*").alias("row"), *[wanted(m).alias(m) for m in METRICS])
                   .where(F.coalesce(*METRICS).isNotNull())
                   .select("row", F.explode(F.array(*METRICS)).alias("metric")).where("metric is not null"))
        first = [F.when(F.col("metric") == m, _nested(df, m)).desc_nulls_last() for m in METRICS]
        rest = [(F.when(F.col("metric") != c, F.col("row").getField(c)) if c in METRICS
                 else F.col("row").getField(c)).asc_nulls_last() for c in orderable_columns(df)]
        place = F.row_number().over(Window.partitionBy("metric").orderBy(*first, *rest))
        ranked = every.withColumn("place", place).where(F.col("place") <= k)
        ranked.write.mode("overwrite").parquet(path)
        return cls(df.sparkSession.read.schema(ranked.schema).parquet(path), k)

    def top(self, metric: str, n: int) -> DataFrame:
        """The first ``n`` rows by ``metric``, in order."""
        if n > self.k:
            raise ValueError(f"only {self.k} places are kept")
        # at most ``n`` rows
        return (self.rows.where((F.col("metric") == metric) & (F.col("place") <= n))
                    .orderBy("place").select("row.*"))


def _nested(df: DataFrame, col: str):
    """The metric in the row's struct, with NaN as null."""
    c = F.col("row").getField(col)
    return F.when(~F.isnan(c), c) if df.schema[col].dataType.typeName() in ("double", "float") else c
