"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.session import scratch_path

#: Word separators of every operator here: space, tab, LF, VT, FF, CR.
WORD_SEPARATORS = " \t\n\x0b\x0c\r"
#: A side is broadcast only when its measured size is at most this.
BROADCAST_BYTES = 16 * 1024 * 1024
#: Most bytes of an Arrow batch that goes to a Python task; texts are long, and rows alone are a poor bound.
BATCH_BYTES = "8m"
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Stands for a null document id inside an operator; reported as null again.
NULL_ID = -(2 ** 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts lineage: a lost executor costs the reading of files, not the work
    before them, and two readers see the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by ``BATCH_BYTES``; a bound that the session has been given stays.

    A Python worker holds a batch several times over, as Arrow, as strings and
    as results; Spark's own bound of 64 MB lets ten thousand texts through.
    """
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, BATCH_BYTES)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_or_shuffled(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows fit ``limit`` bytes.

    ``df`` should be a stored table (counting it reads only footers).  Beyond
    the limit it is returned as it is and the join shuffles; either way the
    joined rows are the same.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_words(text: Column) -> Column:
    """The words of ``text`` as an array (no empty strings)."""
    return F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != F.lit(""))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; null ids give null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def id_crc(doc_id: Column) -> Column:
    """The unsigned crc32 of the id's decimal text, as a long; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned crc32 of an ASCII text, bit by bit."""
    seen = f"list_transform(range(1, len({text}) + 1), lambda i: cast(ascii(substr({text}, i, 1)) as bigint))"
    byte = "list_reduce(list_prepend(xor(x, y), range(8)), lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))"
    return f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {seen}), lambda x, y: {byte}), cast(4294967295 as bigint))"


def words_sql(text: str) -> str:
    """DuckDB expression for the words of a text, as a list (null: none)."""
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda word: word <> '')"
