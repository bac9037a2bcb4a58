"""Corpus pipeline over ``documents``: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.llm.common import NULL_ID, table
from vidlens.llm.line_dedup import line_dedup
from vidlens.llm.mixing import repeat_documents
from vidlens.llm.ngram_join import JaccardJoin, ngram_jaccard_join
from vidlens.llm.packing import pack_documents
from vidlens.llm.queries import tokenizer_file
from vidlens.llm.toxicity import keep_clean
from vidlens.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near duplicates of the pipeline: five-word shingles, Jaccard of 0.8 or more.
NEAR = JaccardJoin(size=5, percent=80)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the classifier is fitted on this stage's labelled documents."""
    return keep_clean(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut out of the texts; every document stays."""
    return line_dedup(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the smallest id stays, with all rows that bear it."""
    docs = docs.select(*COLUMNS)
    groups = ngram_jaccard_join(docs, params=NEAR)
    gone = (groups.where(~F.col("component_id").eqNullSafe(F.col("doc_id")))
                  .select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_gone")).distinct())
    return docs.join(gone, F.coalesce("doc_id", F.lit(NULL_ID)) == F.col("_gone"), "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return repeat_documents(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix packed into sequences; a row for every piece of a document."""
    return pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", cut_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_group),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL can't express the learned and the sampled stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
