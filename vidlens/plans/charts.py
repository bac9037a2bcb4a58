"""Chart datasets (H1-H9): the data behind every reference chart.

Drawing is left to the caller; each dataset is a small lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlens import schema as S
from vidlens.operators import distribution, stats, topn, trends


def category_views(df: DataFrame, order: str = "desc") -> DataFrame:
    """H1: category -> average views (descending as in the pandas chart,
    ``order="asc"`` as in the Spark chart)."""
    if order == "desc":
        cs = stats.category_stats(df, drop_null_keys=True, order="desc")
    else:
        cs = stats.category_stats(df, order="asc")
    return cs.select("category", "avg_views")


def category_ratings(df: DataFrame) -> DataFrame:
    """H2: category -> average rating, in order of mean views."""
    return stats.category_stats(df, drop_null_keys=True, order="desc").select("category", "avg_rating")


def monthly_trend(df: DataFrame, anchor: str = S.DATE_ANCHOR) -> DataFrame:
    """H3: month -> average views and average rating (valid ages only)."""
    return trends.monthly_trend(df, anchor)


def daily_trend(df: DataFrame, anchor: str = S.DATE_ANCHOR) -> DataFrame:
    """H4: day -> average views / rating, incomplete rows dropped, ascending."""
    return trends.reaggregate_trend(trends.daily_trend(df, anchor, ordered=False))


def top_videos(df: DataFrame, n: int = S.TOP_N_DEFAULT) -> DataFrame:
    """H5: ``(video_id, views)`` of the top ``n`` by views."""
    return topn.top_views(df, n).select("video_id", "views")


def views_distribution(df: DataFrame, col: str = "views", weight: str | None = None) -> dict[str, DataFrame]:
    """H6: histogram (F14) and density curve (F15) of views on a log axis.

    The curve also comes in histogram units (``count_density`` = density x
    n x log-bin width), the scale at which it is drawn over the bars.
    ``weight`` names a column that says how many rows a row stands for.
    """
    dens = distribution.log_density(df, col, weight=weight)
    lv = df.where(F.col(col) > 0).select(F.log10(F.col(col).cast("double")).alias("lv"),
                                         (F.col(weight) if weight else F.lit(1)).alias("c"))
    scale = lv.agg((F.sum("c") * (F.max("lv") - F.min("lv")) / F.lit(S.HISTOGRAM_BINS))
                   .alias("s")).select("s").scalar()
    dens = dens.withColumn("count_density", F.col("density") * scale)
    return {"histogram": distribution.log_histogram(df, col, weight=weight), "density": dens}


def views_by_length(df: DataFrame, path: str | None = None) -> dict[str, DataFrame]:
    """H7: per length range box statistics and violin shapes (F16).

    With ``path`` the value counts that both are read from are stored there, so
    the table is scanned once for both; else each result counts for itself.
    """
    directory = (distribution.LengthDirectory.build(df, path) if path else distribution.LengthDirectory.of(df))
    return {"summary": directory.summary(), "density": directory.density()}


def correlation_table(df: DataFrame) -> DataFrame:
    """H8: ranked correlation pairs."""
    return stats.correlation_pairs(df)


def related_correlation(related: DataFrame) -> DataFrame:
    """H9: correlation matrix of the numeric columns of the related table."""
    return stats.correlation_wide(related)


def related_counts(df: DataFrame, col: str = "related_ids") -> DataFrame:
    """Numeric view of the related table for H9: number of related ids."""
    # explicit null case: with ANSI off, size(null) is -1 (legacy rule)
    return df.withColumn("related_count", F.when(F.col(col).isNull(), F.lit(0)).otherwise(F.size(col)))
