"""Table sources (A5-A10): one generic reader plus the shaped variants."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlens import schema as S


def read_table(spark: SparkSession, fmt: str, path: str | None = None,
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """A5: any batch source as a DataFrame.

    ``fmt`` is a Spark data source name (``parquet``, ``json``, ``csv``,
    ``orc``, or a document-store connector such as ``mongodb`` when its jar is
    on the classpath); options go to the reader unchanged (``connection.uri``,
    ``database``, ``collection`` ...).
    """
    r = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        r = r.schema(schema)
    return r.load(path) if path is not None else r.load()


def read_videos(spark: SparkSession, fmt: str, path: str | None = None,
                columns: Sequence[str] = S.ANALYSIS_COLUMNS, **options) -> DataFrame:
    """Projected scan -- only the analysis columns (and ``_id`` if the
    source has one) are read; Catalyst prunes the rest at the source."""
    df = read_table(spark, fmt, path, **options)
    keep = (["_id"] if "_id" in df.columns else []) + [c for c in columns if c in df.columns]
    return df.select(*keep)


def read_json_videos(spark: SparkSession, path: str, schema: T.StructType | None = S.VIDEO,
                     infer: bool = False) -> DataFrame:
    """JSON documents (one per line).  The video schema is applied unless
    ``infer=True`` (inference reads the data twice and sorts columns by name)."""
    r = spark.read
    if not infer and schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The stored (cleaned) table; a missing path raises AnalysisException."""
    return spark.read.parquet(path)


def read_csv_result(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                    multi_line: bool = False) -> DataFrame:
    """A CSV result folder/file with header; types inferred when no schema.

    Reads with the options the CSV sink writes with.  Empty strings come back
    null.  ``multi_line`` reads values with line breaks in them, at the price of
    one task per file.
    """
    r = (spark.read.option("header", "true").option("escape", '"')
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
    r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
    return r.option("multiLine", str(multi_line).lower()).csv(path)


# A field with the separator before it: quoted (a doubled quote stands for one;
# what follows the closing quote belongs to the field) or plain.  No backtracking.
_FIELD = r',("(?:[^"]++|"")*+"?[^,]*+|[^,]*+)'
_QUOTED = r'(?s)^"((?:[^"]++|"")*+)"?(.*)$'
# A separator that no line holds: the reader then splits files into lines,
# skips each file's header and leaves the fields alone.
_NO_SEPARATOR = "\x01\x02\x03"


def split_csv_line(line) -> Column:
    """The fields of one CSV line, as an array of text (empty fields are null).

    One pass over the line, whatever its number of fields.  An unclosed quote
    reaches to the end of the line.
    """
    def value(field: Column) -> Column:
        inner = F.replace(F.regexp_extract(field, _QUOTED, 1), F.lit('""'), F.lit('"'))
        text = F.when(field.startswith('"'), F.concat(inner, F.regexp_extract(field, _QUOTED, 2))).otherwise(field)
        return F.nullif(text, F.lit(""))
    line = F.col(line) if isinstance(line, str) else line
    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1)), value)


def read_csv_tolerant(spark: SparkSession, path: str, schema: T.StructType | str,
                      header: bool = True) -> DataFrame:
    """A10: rows with more fields than the schema are skipped; short rows stay
    with nulls (pandas ``on_bad_lines="skip"``).

    Files are read as lines (splittable; blank lines and, with ``header``, each
    file's first line go) and every line is split once, before any column is
    chosen: a row's fate does not depend on which columns are read later.
    Empty fields, and fields that do not fit their type, are null.
    """
    st = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    lines = (spark.read.option("header", str(header).lower()).option("sep", _NO_SEPARATOR)
             .option("quote", "").schema("line string").csv(path))
    # the one-row generator keeps later filters from splitting the line again
    rows = lines.select(F.inline(F.array(F.struct(split_csv_line("line").alias("f")))))
    return rows.where(F.size("f") <= len(st.fields)).select(
        *[F.get("f", i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(st.fields)])
