"""Crawl-tree ingest.

Layout: ``<root>/<YYMMDD>/{0,1,2,3}.txt`` (one tab-separated video per line)
plus ``log.txt`` whose ``start:`` line carries the crawl date.  Files are read
by Spark's text source -- splits of big files spread over tasks -- and every
line keeps its file and position so that "first wins" is well defined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens import schema as S
from vidlens.functions.columns import crawl_date_of, decimal_text, strip_ws
from vidlens.operators.clean import dedup_first

# Python's ``\s`` inside one line: whitespace except the line break.
_LOG_PATTERN = r"start:[^\S\n]+(\d{6})"


def _parent(path_col):
    return F.regexp_extract(path_col, r"^(.*)/[^/]*$", 1)


def read_crawl_lines(spark: SparkSession, root: str) -> DataFrame:
    """A1: every line of every ``*.txt`` under ``root`` except ``log.txt``.

    Columns: ``folder`` (parent directory path), ``file_name``, ``line_pos``
    (``struct(split start, row in split)`` -- sorts in file order) and
    ``value``.  The ``*.txt`` glob prunes the listing; ``log.txt`` (a glob
    cannot exclude one name) is dropped by a filter on the file name -- its
    few lines are read and discarded.
    """
    raw = (spark.read.option("recursiveFileLookup", "true")
           .option("pathGlobFilter", "*.txt").text(root))
    lines = raw.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.struct(F.col("_metadata.file_block_start").alias("start"),
                 F.monotonically_increasing_id().alias("row")).alias("line_pos"))
    return (lines.where(F.col("file_name") != S.LOG_FILE)
                 .select(_parent(F.col("file_path")).alias("folder"), "file_name", "line_pos", "value"))


def read_crawl_logs(spark: SparkSession, root: str) -> DataFrame:
    """A3 input: ``(folder, value)`` with the whole text of each ``log.txt``."""
    raw = (spark.read.option("recursiveFileLookup", "true")
           .option("pathGlobFilter", S.LOG_FILE).text(root, wholetext=True))
    return raw.select(_parent(F.col("_metadata.file_path")).alias("folder"), "value")


def crawl_dates(logs: DataFrame) -> DataFrame:
    """A3: folder -> first ``start:`` date (6 digits) or null when none."""
    return logs.select("folder", crawl_date_of(F.col("value"), _LOG_PATTERN).alias("crawl_date"))


def parse_crawl_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Strip, split on tab, type the nine fixed fields, keep the rest.

    Adds ``status``: ``short`` (< 9 fields, dropped by the reference),
    ``bad`` (a number does not parse; the reference aborts, here the row is
    rejected and counted) or ``ok``.  ``related_ids`` is ``[]`` when a line
    has exactly nine fields.
    """
    # The split array is produced by a one-row generator: predicates on the
    # parsed fields (status filters) cannot be pushed below it, so the line
    # is stripped and split once per row instead of once per reference.
    split = F.split(strip_ws(F.col(value)), "\t", -1)
    keep = [c for c in lines.columns if c != value]
    lines = lines.select(*keep, F.inline(F.array(F.struct(split.alias("_parts")))))
    parts = F.col("_parts")
    n = F.size(parts)
    typed = {}
    for i, name in enumerate(S.CRAWL_FIELDS):
        f = F.get(parts, i)
        if name in S.INT_FIELDS:
            f = f.try_cast(S.INT_FIELDS[name])
        elif name in S.FLOAT_FIELDS:
            f = decimal_text(f).cast(S.FLOAT_FIELDS[name])
        typed[name] = f
    related = F.when(n > 9, F.slice(parts, 10, n - 9)).otherwise(F.array().cast("array<string>"))
    numeric_bad = None
    for name in list(S.INT_FIELDS) + list(S.FLOAT_FIELDS):
        c = typed[name].isNull()
        numeric_bad = c if numeric_bad is None else (numeric_bad | c)
    # a null line counts as short in both ANSI modes (size(null) differs)
    status = F.when(parts.isNull() | (n < 9), "short").when(numeric_bad, "bad").otherwise("ok")
    return lines.select(*keep, *[typed[k].alias(k) for k in S.CRAWL_FIELDS],
                        related.alias("related_ids"), status.alias("status"))


def attach_crawl_dates(parsed: DataFrame, dates: DataFrame, how: str = "inner") -> DataFrame:
    """A4: every line gets its own folder's date; folders without one are
    dropped whole (``how="inner"``) or kept with a null date (``"left"``).

    The date table has one short row per crawl folder and is broadcast: there
    are few folders of very many lines, so a shuffle by folder would bring
    whole folders to one task.
    """
    return parsed.join(F.broadcast(dates), "folder", how)


ORDER = ["crawl_date", "folder", "file_name", "line_pos"]
VIDEO_COLUMNS = S.CRAWL_FIELDS + ["related_ids"]


def stage_crawls(lines: DataFrame, logs: DataFrame, path: str) -> DataFrame:
    """Every line, parsed once: position, date, ``status`` and the video (only where ``ok``).

    Written as Parquet under ``path`` and read back, so the text is scanned and
    split a single time whatever is asked of it afterwards.
    """
    spark = lines.sparkSession
    dated = dated_lines(lines, logs)
    ok = F.col("status") == "ok"
    rows = dated.select(*ORDER, "status", *[F.when(ok, F.col(c)).alias(c) for c in VIDEO_COLUMNS])
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def load_crawls(spark: SparkSession | None = None, root: str | None = None,
                lines: DataFrame | None = None, logs: DataFrame | None = None,
                strict: bool = False, stage: str | None = None):
    """Crawl tree -> (videos, accounting).

    ``videos``: one row per ``video_id`` -- the first by crawl date, folder,
    file and line (C8) -- with ``crawl_date`` and the source position.
    ``accounting`` (C9): per folder and file, and rolled up per folder and in
    total, ``lines_read = skipped + short + bad + duplicates + kept``.
    With ``stage``, a folder to write to, the lines are staged there first
    (``stage_crawls``) and both results read the stage: one scan and one parse
    of the text for both.  Without it both are lazy and each parses for itself.
    ``strict=True`` raises when a numeric field fails to parse.
    """
    if lines is None:
        lines = read_crawl_lines(spark, root)
    if logs is None:
        logs = read_crawl_logs(spark, root)
    staged = stage_crawls(lines, logs, stage) if stage else dated_lines(lines, logs)
    if strict:
        raise_on_bad(staged)
    videos = first_videos(staged)
    return videos, crawl_accounting(staged, videos)


def raise_on_bad(staged: DataFrame) -> None:
    """``ValueError`` naming the file of a line with a number that does not parse."""
    bad = staged.where(F.col("status") == "bad").select("folder", "file_name").limit(1).collect()
    if bad:
        raise ValueError(f"unparsable crawl line in {bad[0]['folder']}/{bad[0]['file_name']}")


def first_videos(staged: DataFrame) -> DataFrame:
    """C8 over the staged lines."""
    ok = staged.where(F.col("status") == "ok").select(*VIDEO_COLUMNS, *ORDER)
    return dedup_first(ok, key=S.KEY, order=ORDER)


def dated_lines(lines: DataFrame, logs: DataFrame) -> DataFrame:
    """A2 + A3 + A4: parsed lines with their crawl date and final ``status``
    (``skipped`` when the folder has no date, else the parse status)."""
    parsed = parse_crawl_lines(lines)
    dated = attach_crawl_dates(parsed, crawl_dates(logs).where(F.col("crawl_date").isNotNull()), "left")
    status = F.when(F.col("crawl_date").isNull(), "skipped").otherwise(F.col("status"))
    return dated.withColumn("status", status)


def crawl_accounting(dated: DataFrame, videos: DataFrame) -> DataFrame:
    """Per-file counts of the staged lines (three columns), then a rollup.

    ``kept`` comes from the deduplicated table; ``duplicates = ok - kept``.
    Both per-file tables have one row per file, so the join and the rollup
    run on small inputs.
    """
    per_file = dated.groupBy("folder", "file_name").agg(
        F.count(F.lit(1)).alias("lines_read"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "short").alias("short"),
        F.count_if(F.col("status") == "bad").alias("bad"),
        F.count_if(F.col("status") == "ok").alias("ok"))
    kept = videos.groupBy("folder", "file_name").agg(F.count(F.lit(1)).alias("kept"))
    f = (per_file.join(kept, ["folder", "file_name"], "left")
                 .select("folder", "file_name", "lines_read", "skipped", "short", "bad",
                         (F.col("ok") - F.coalesce(F.col("kept"), F.lit(0))).alias("duplicates"),
                         F.coalesce(F.col("kept"), F.lit(0)).alias("kept")))
    sums = ["lines_read", "skipped", "short", "bad", "duplicates", "kept"]
    return f.rollup("folder", "file_name").agg(*[F.sum(c).alias(c) for c in sums])


def video_table(videos: DataFrame) -> DataFrame:
    """The stored video document: the schema of :data:`vidlens.schema.VIDEO`."""
    return videos.select(*[F.col(f.name).cast(f.dataType) for f in S.VIDEO.fields])
