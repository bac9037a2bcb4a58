"""Sinks (B1-B7).

Results are written by Spark's writers, one folder per dataset with
``mode("overwrite")`` (B7: a rerun replaces its own output, it never deletes a
parent folder).  CSV keeps blanks and quotes (no trimming, quotes escaped by
doubling); arrays are joined to text first.  Plain CSV does not tell an empty
string from null, and a line break in a value needs ``multi_line`` on reading;
``write_csv_reversible`` keeps both, as Parquet does.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlens import schema as S

CSV_OPTIONS = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}


def csv_ready(df: DataFrame, sep: str = ",") -> DataFrame:
    """Arrays of strings become ``sep``-joined text (C4 at the sink)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.concat_ws(sep, F.col(f.name).cast("array<string>")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


#: Signs of the reversible CSV form, the backslash first; then what would end a line.
ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))
NULL_TEXT, EMPTY_TEXT = "\\N", "\\E"


def _escaped(c: Column) -> Column:
    """Text on one line that tells null from empty."""
    text = c
    for plain, sign in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(sign))
    return F.when(c.isNull(), NULL_TEXT).when(c == "", EMPTY_TEXT).otherwise(text)


def _unescaped(c: Column) -> Column:
    """The value that ``_escaped`` wrote (every backslash in it begins a sign)."""
    text = c
    for plain, sign in reversed(ESCAPES):
        text = F.replace(text, F.lit(sign), F.lit(plain))
    return F.when(c != NULL_TEXT, F.when(c == EMPTY_TEXT, F.lit("")).otherwise(text))


def write_csv_reversible(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """B1 without loss: null, empty text and line breaks come back as they were.

    Text columns carry backslash signs (``ESCAPES``), so a row is one line and
    the files can be split on reading; arrays and structs travel as JSON, other
    types as their text, null as ``\\N``.  Read it with
    :func:`read_csv_reversible` and the same schema.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        cols.append(_escaped(F.to_json(c) if nested else c.cast("string")).alias(f.name))
    df.select(*cols).write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path


def read_csv_reversible(spark, path: str, schema: T.StructType | str) -> DataFrame:
    """What :func:`write_csv_reversible` wrote, in the types of ``schema``; files are split over tasks."""
    st = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in st.fields])
    rows = spark.read.options(**CSV_OPTIONS).schema(text).csv(path)
    cols = []
    for f in st.fields:
        c = _unescaped(F.col(f"`{f.name}`"))
        nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        cols.append((F.from_json(c, f.dataType) if nested else c.cast(f.dataType)).alias(f.name))
    return rows.select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> str:
    """B1/B2: CSV folder with header; ``mode="errorifexists"`` is B2."""
    opts = {**CSV_OPTIONS, **options}
    csv_ready(df).write.mode(mode).options(**opts).csv(path)
    return path


def write_single_csv(df: DataFrame, path: str, order_by: Sequence[str] | None = None,
                     mode: str = "overwrite") -> str:
    """A CSV folder of one part file with one header, rows in a fixed order.

    For results that are bounded by construction (statistics, top-N, pages,
    bins): one task writes them.  Everything that grows with the data belongs
    to :func:`write_csv`.  ``coalesce(1)`` keeps an existing global sort
    (partitions are concatenated in order); ``order_by`` sorts the single
    partition instead.
    """
    one = csv_ready(df).coalesce(1)
    if order_by:
        one = one.sortWithinPartitions(*order_by)
    one.write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path


def publish_csv(df: DataFrame, folder: str, name: str, order_by: Sequence[str] | None = None) -> str:
    """A result as the single file ``<folder>/<name>.csv``.

    Written in parallel as parts (sorted by ranges where ``order_by`` says so),
    which are then joined into the one file; an earlier file of that name stays
    until the new one is whole.
    """
    target = f"{folder.rstrip('/')}/{name}.csv"
    parts = f"{folder.rstrip('/')}/{name}"
    write_csv(df.orderBy(*order_by) if order_by else df, parts)
    return publish_part(df.sparkSession, parts, target)


def publish_part(spark, part_folder: str, target: str) -> str:
    """The CSV parts of ``part_folder``, in order, as the one file ``target``; then the folder goes.

    One part is moved, several are copied one after the other, with the header
    of the first alone.  Uses the Hadoop file system of the path, so any store
    that Spark writes to will do.  The new file is made beside the target, an
    old target is set aside, the new one takes its place, and only then are the
    old one and the parts deleted: a step that fails leaves the old file (or
    puts it back) and the parts, and raises ``OSError``.  ``FileNotFoundError``
    without the folder or a part in it, ``IsADirectoryError`` for a folder as
    target.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, to = hadoop.Path(part_folder), hadoop.Path(target)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(source):
        raise FileNotFoundError(f"nothing was written to {part_folder}")
    parts = sorted((f.getPath() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-")),
                   key=lambda path: path.getName())
    if not parts:
        raise FileNotFoundError(f"no part file in {part_folder}")
    if fs.exists(to) and fs.getFileStatus(to).isDirectory():
        raise IsADirectoryError(f"{target} is a folder")
    new, old = hadoop.Path(f"{target}.new"), hadoop.Path(f"{target}.old")
    fs.delete(new, False)
    if len(parts) > 1:
        _join_parts(spark, fs, parts, new)
    elif not fs.rename(parts[0], new):
        raise OSError(f"cannot move {parts[0]} to {new}")
    kept = fs.exists(to)
    if kept:
        fs.delete(old, False)
        if not fs.rename(to, old):
            raise OSError(f"cannot set {target} aside")
    if not fs.rename(new, to):
        if kept:
            fs.rename(old, to)
        raise OSError(f"cannot move {new} to {target}")
    fs.delete(old, False)
    fs.delete(source, True)
    return target


def _join_parts(spark, fs, parts, new) -> None:
    """The parts' bytes one after the other, without the header line but of the first."""
    out = fs.create(new, True)
    try:
        for k, part in enumerate(parts):
            stream = fs.open(part)
            try:
                if k:
                    # a header line holds column names only
                    while stream.read() not in (10, -1):
                        pass
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
            finally:
                stream.close()
    finally:
        out.close()


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None,
                  sort_within: Sequence[str] | None = None, salt: int = 32,
                  max_records_per_file: int | None = None) -> str:
    """Parquet table; optional ``partitionBy`` and per-file sort (so the
    scan can skip row groups on the sorted column).

    With ``partition_by`` the rows are shuffled on the partition columns plus
    a salt of ``salt`` buckets, so one partition value holding a third of the
    table is written by ``salt`` tasks, not one, and the directory gets at
    most ``salt`` files per value.  The salt is a hash of the row, so a retried
    task routes every row the same way.
    """
    out = df
    if partition_by:
        bucket = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt))
        out = out.repartition(*[F.col(c) for c in partition_by], bucket)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    w = out.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def metric_table(stats_row: DataFrame, names: dict[str, str] | None = None,
                 value_format: str = "%.6f") -> DataFrame:
    """A one-row statistics frame as ``(metric, value)`` text rows.

    Integers print as integers, fractions with ``value_format``, structs (whole
    rows) as JSON.  ``names`` maps column -> metric label.
    """
    names = names or {}
    entries = []
    for i, f in enumerate(stats_row.schema.fields):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StructType):
            v = F.to_json(c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            v = F.format_string(value_format, c)
        else:
            v = c.cast("string")
        entries.append(F.struct(F.lit(i).alias("i"), F.lit(names.get(f.name, f.name)).alias("metric"),
                                v.alias("value")))
    return stats_row.select(F.explode(F.array(*entries)).alias("e")).select("e.metric", "e.value")


def statistics_table(summary: DataFrame, top_rated: DataFrame, most_watched: DataFrame) -> DataFrame:
    """B6 for the report: the five statistics in the reference's order and labels.

    The two rows enter as scalar-subquery structs (one row each).
    """
    tr = top_rated.select(F.struct(*top_rated.columns)).scalar()
    mw = most_watched.select(F.struct(*most_watched.columns)).scalar()
    total, avg, med = summary.columns[:3]
    row = summary.select(F.col(total).alias(S.STATISTICS_NAMES[0]), F.col(avg).alias(S.STATISTICS_NAMES[1]),
                         F.col(med).alias(S.STATISTICS_NAMES[2]), tr.alias(S.STATISTICS_NAMES[3]),
                         mw.alias(S.STATISTICS_NAMES[4]))
    return metric_table(row)
