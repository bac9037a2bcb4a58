"""Time trends."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlens import schema as S
from vidlens.functions.columns import month_start, upload_date
from vidlens.operators.filters import valid_age
from vidlens.operators.topn import known


def _means(df, metrics):
    return [F.avg(known(df, m)).alias(f"avg_{m}") for m in metrics]


def daily_trend(df: DataFrame, anchor: str = S.DATE_ANCHOR, valid_only: bool = False,
                metrics: Sequence[str] = ("views", "rating"), ordered: bool = True) -> DataFrame:
    """mean metrics per ``upload_date = anchor - age``.

    The reference's daily trend keeps every age, so the -1 sentinel lands on
    anchor + 1 day (S3); ``valid_only=True`` drops those rows first.
    """
    src = valid_age(df) if valid_only else df
    out = (src.select(upload_date("age", anchor).alias("upload_date"), *metrics)
              .groupBy("upload_date").agg(*_means(src, metrics)))
    return out.orderBy("upload_date") if ordered else out


def monthly_trend(df: DataFrame, anchor: str = S.DATE_ANCHOR, valid_only: bool = True,
                  metrics: Sequence[str] = ("views", "rating")) -> DataFrame:
    """mean metrics per upload month (first day), ascending."""
    src = valid_age(df) if valid_only else df
    return (src.select(month_start(upload_date("age", anchor)).alias("upload_month"), *metrics)
               .groupBy("upload_month").agg(*_means(src, metrics))
               .orderBy("upload_month"))


def reaggregate_trend(trend: DataFrame, date_col: str = "upload_date") -> DataFrame:
    """F11 (with C6, C7, G6): drop incomplete rows, parse the date, mean of
    every numeric column per date, ascending."""
    numeric = [f.name for f in trend.schema.fields
               if f.name != date_col and isinstance(f.dataType, T.NumericType)]
    clean = trend.na.drop("any").withColumn(date_col, F.to_date(F.col(date_col)))
    return (clean.groupBy(date_col).agg(*[F.avg(known(clean, c)).alias(c) for c in numeric])
                 .orderBy(date_col))
