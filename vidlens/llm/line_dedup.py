"""Line dedup: repeated windows of three consecutive lines (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Consecutive lines in a window.
WINDOW_LINES = 3


def _windows(df: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    lines = F.split(F.col(text_col), "\n")
    # a regular "\n" keeps every trailing empty line: split() has limit -1
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("_lines") - F.lit(size)),
        lambda i: F.struct(
            i.cast("int").alias("pos"),
            F.xxhash64(F.lit(1), *[F.col("_lines")[i + k] for k in range(size)]).alias("h1"),
            F.xxhash64(F.lit(2), *[F.col("_lines")[i + k] for k in range(size)]).alias("h2")))
    return (df.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_key"), lines.alias("_lines"))
              .where(F.size("_lines") >= size)
              .select("_id", "_key", F.explode(hashes).alias("w"))
              .select("_id", "_key", "w.pos", "w.h1", "w.h2"))


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               size: int = WINDOW_LINES) -> DataFrame:
    """Remove repeated runs of lines.

    Lines are the pieces between ``\\n``.  Every ``size`` consecutive lines
    form a window (windows overlap).  Windows are compared over all documents
    by a 128-bit hash of their lines.  The first occurrence, by
    ``(id, text hash, line number)``, stays; each later occurrence covers its
    lines, the covered positions of a document are merged, and covered lines
    are removed.  The kept lines are joined by ``\\n`` again.

    All columns of ``df`` are returned, ``text_col`` with its new text, plus
    ``lines_before`` and ``lines_removed`` (existing columns of these names
    are replaced).  Defined cases: a null text stays null with 0 lines; a text
    with fewer than ``size`` lines is left as it is; a text whose lines are all
    covered becomes empty; a null id orders last; rows repeating both id and
    text are one document, and every copy of the row gets the same text.  A
    window that repeats within its own document is removed as well.

    Every occurrence count is a partial aggregate, so a window found in a
    third of all documents sends one row per task; finding its occurrences
    again is a join that the skew handling splits.  The covered positions of
    one document are bounded by its own lines.
    """
    columns = [c for c in df.columns if c not in ("lines_before", "lines_removed")]
    spans = _windows(df, id_col, text_col, size)
    order = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"),
                     F.col("_key").alias("k"), F.col("pos").alias("p"))
    repeated = (spans.groupBy("h1", "h2")
                .agg(F.min(order).alias("first"), F.max(order).alias("last"))
                .where(F.col("first") != F.col("last")).select("h1", "h2", "first"))
    later = (spans.join(repeated, ["h1", "h2"])
             .where(order != F.col("first"))
             .groupBy("_id", "_key").agg(F.collect_set("pos").alias("_starts")))
    covered = later.select(F.col("_id").alias("_cid"), F.col("_key").alias("_ckey"),
                           F.sort_array("_starts").alias("_starts"))
    parts = F.split(F.col(text_col), "\n")
    # what stays lies between the covered runs: from the end of one window to
    # the start of the next (nothing where they touch or overlap)
    gaps = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.transform("_starts", lambda p: p + F.lit(size))).alias("a"),
        F.concat(F.col("_starts"), F.array(F.size(parts))).alias("b"))
    kept = F.flatten(F.transform(F.col("_gaps"), lambda g: F.slice(
        F.col("_parts"), g["a"] + F.lit(1), F.greatest(g["b"] - g["a"], F.lit(0)))))
    joined = df.select(*columns, F.xxhash64(text_col).alias("_key")).join(
        covered, F.col(id_col).eqNullSafe(F.col("_cid")) & (F.col("_key") == F.col("_ckey")), "left")
    joined = (joined.withColumn("_parts", parts).withColumn("_gaps", gaps)
              .withColumn("_kept", F.when(F.col("_starts").isNotNull(), kept)))
    before = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size("_parts"))
    return joined.select(
        *[F.when(F.col("_starts").isNull(), F.col(c)).otherwise(F.array_join("_kept", "\n")).alias(c)
          if c == text_col else F.col(c) for c in columns],
        before.cast("long").alias("lines_before"),
        F.when(F.col("_starts").isNull(), F.lit(0)).otherwise(before - F.size("_kept"))
        .cast("long").alias("lines_removed"))


def _windows_sql(size: int) -> str:
    cells = ", ".join(f"ls[i + {k}]" for k in range(size))
    return f"""l as (select doc_id, text, string_split(text, chr(10)) as ls from documents),
w as (select doc_id, i, [{cells}] as win from
      (select doc_id, ls, unnest(generate_series(1, len(ls) - {size - 1})) as i from l where len(ls) >= {size}))"""


ORACLE_SQL = f"""with {_windows_sql(WINDOW_LINES)},
f as (select win, min((doc_id, i)) as first from w group by win having count(*) > 1),
c as (select distinct w.doc_id, unnest(generate_series(w.i, w.i + {WINDOW_LINES - 1})) as p
      from w join f on w.win = f.win where (w.doc_id, w.i) != f.first),
x as (select doc_id, unnest(ls) as line, unnest(generate_series(1, len(ls))) as p from l),
k as (select x.doc_id, string_agg(x.line, chr(10) order by x.p) as text, count(*) as n
      from x left join c on x.doc_id = c.doc_id and x.p = c.p where c.p is null group by x.doc_id)
select l.doc_id, case when l.text is null then null else coalesce(k.text, '') end as text,
       cast(coalesce(len(l.ls), 0) as bigint) as lines_before,
       cast(coalesce(len(l.ls), 0) - coalesce(k.n, 0) as bigint) as lines_removed
from l left join k on l.doc_id = k.doc_id"""
