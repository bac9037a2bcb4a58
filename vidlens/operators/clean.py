"""Cleansing and projection."""

from __future__ import annotations

import logging
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlens import schema as S
from vidlens.functions.columns import delimited, to_number

log = logging.getLogger(__name__)


def coerce_numeric(df: DataFrame, defaults: Mapping[str, float] = S.DEFAULTS,
                   integer: Sequence[str] = S.INTEGER_METRICS) -> DataFrame:
    """Unparsable or missing -> default, then truncate the integer columns.

    Columns absent from ``df`` are skipped.  Integer results are ``bigint``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df
    for c, d in defaults.items():
        if c in types:
            numeric = isinstance(types[c], T.NumericType)
            out = out.withColumn(c, to_number(c, d, integer=c in integer, numeric_input=numeric))
    return out


def fill_defaults(df: DataFrame, values: Mapping[str, object] = S.DEFAULTS) -> DataFrame:
    """Null fill by column map (only columns that exist).

    Unlike ``na.fill`` with a bare number, string columns are never touched.
    """
    present = {c: v for c, v in values.items() if c in df.columns}
    return df.na.fill(present) if present else df


def drop_related(df: DataFrame, col: str = "related_ids") -> DataFrame:
    """Drop the related-id column (no-op when absent)."""
    return df.drop(col)


def related_as_text(df: DataFrame, col: str = "related_ids", sep: str = ",") -> DataFrame:
    """C4: the related-id array as one delimited string (null/empty -> "").

    When the column is absent the input comes back unchanged and a message is
    logged, as the reference skips the analysis.
    """
    if col not in df.columns:
        log.warning("no %s to turn into text; the table is left as it is", col)
        return df
    return df.withColumn(col, delimited(col, sep))


def drop_null_keys(df: DataFrame, col: str = "category") -> DataFrame:
    """Remove rows whose key is null (empty strings stay)."""
    return df.where(F.col(col).isNotNull())


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows holding any null."""
    return df.na.drop("any")


def to_dates(df: DataFrame, col: str = "upload_date") -> DataFrame:
    """Parse a text column to a date."""
    return df.withColumn(col, F.to_date(F.col(col)))


def dedup_first(df: DataFrame, key: str = S.KEY, order: Sequence[str] = (),
                keep_order_cols: bool = True) -> DataFrame:
    """One row per ``key`` -- the first by ``order``, then by every column.

    First-wins is an arg-min per key, written as ``min(struct(order..., row...))``
    in a ``groupBy``: the partial aggregate runs map-side, so a key holding a
    third of all rows shrinks to one row per task before the shuffle (a
    ``row_number`` window would send all of them to one task).  Struct
    comparison is lexicographic, so the remaining columns break ties and the
    result does not depend on storage order.
    """
    order = [c for c in order if c != key]
    payload = [c for c in df.columns if c != key and c not in order]
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)] + \
             [F.col(c).alias(f"p{i}") for i, c in enumerate(payload)]
    best = df.groupBy(key).agg(F.min(F.struct(*fields)).alias("_first"))
    cols = [F.col(key)]
    cols += [F.col(f"_first.o{i}").alias(c) for i, c in enumerate(order)] if keep_order_cols else []
    cols += [F.col(f"_first.p{i}").alias(c) for i, c in enumerate(payload)]
    out = best.select(*cols)
    return out.select(*[c for c in df.columns if c in out.columns])
