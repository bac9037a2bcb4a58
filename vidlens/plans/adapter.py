"""Video-shaped views over the driver's tables.

The test tables hold no videos, so the check queries run on a projection of
``lineitem`` with the video schema.  The view is a plain ``select`` -- column
pruning and filters still reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Base date the adapter counts ages from (about 12% of ages are negative).
AGE_BASE = "2001-01-01"
# Rows of a task that builds crawl lines.
DEAL_ROWS = 250_000
# A written crawl tree is read in about so many splits, of 64 KB at least.
TREE_SPLITS, SPLIT_BYTES = 256, 64 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def videos(spark: SparkSession, sf_dir: str, related: bool = False) -> DataFrame:
    """lineitem as videos: the seven analysis columns plus uploader.

    ``related=True`` adds ``ratings_count``, ``related_ids`` (empty for line 1,
    null for line 7, else two ids) and ``crawl_date`` (ship date as YYMMDD).
    """
    li = table(spark, sf_dir, "lineitem")
    cols = [
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("video_id"),
        F.concat(F.lit("u"), F.col("l_suppkey").cast("string")).alias("uploader"),
        F.datediff(F.lit(AGE_BASE).cast("date"), F.col("l_shipdate").cast("date")).cast("int").alias("age"),
        F.col("l_returnflag").alias("category"),
        F.floor(F.col("l_quantity") * 75).cast("int").alias("length"),
        F.floor(F.col("l_extendedprice")).cast("bigint").alias("views"),
        (F.col("l_discount") * 50).alias("rating"),
        (F.col("l_partkey") % 100).cast("int").alias("comments_count"),
    ]
    if related:
        ids = F.array(F.concat(F.lit("p"), F.col("l_partkey").cast("string")),
                      F.concat(F.lit("s"), F.col("l_suppkey").cast("string")))
        cols += [
            F.floor(F.col("l_tax") * 1000).cast("bigint").alias("ratings_count"),
            F.when(F.col("l_linenumber") == 1, F.array().cast("array<string>"))
             .when(F.col("l_linenumber") == 7, F.lit(None).cast("array<string>"))
             .otherwise(ids).alias("related_ids"),
            F.date_format(F.col("l_shipdate"), "yyMMdd").alias("crawl_date"),
        ]
    return li.select(*cols)


def _parts(li: DataFrame) -> int:
    """Tasks that ``li`` is dealt over: more with more rows (the count reads footers only)."""
    return max(li.sparkSession.sparkContext.defaultParallelism, -(-li.count() // DEAL_ROWS))


def crawl_lines(spark: SparkSession, sf_dir: str, deal: str | None = "any") -> DataFrame:
    """Raw crawl lines made from lineitem, laid out as a crawl tree.

    Folder = ship year (``c1995`` ...), file = ``<line % 4>.txt``, position in
    the file = order key.  Line 7 is cut to five fields (too short), line 6
    carries a non-integer age (rejected), line 5 ends in tabs (stripped),
    lines 1-2 carry three related ids, the rest one.  The rows are dealt out
    first: building and parsing lines is the work here, and a test table is a
    single row group.  ``deal="files"`` deals them by ranges in the order of
    folder, file and position, None leaves them as they are read.
    """
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    if deal == "files":
        li = li.repartitionByRange(_parts(li), F.year("l_shipdate"), ln % 4, "l_orderkey")
    elif deal:
        li = li.repartition(_parts(li))
    vid = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string"))
    age = F.datediff(F.lit(AGE_BASE).cast("date"), F.col("l_shipdate").cast("date"))
    age_txt = F.when(ln == 6, F.concat(F.lit("x"), age.cast("string"))).otherwise(age.cast("string"))
    fixed = [vid, F.concat(F.lit("u"), F.col("l_suppkey").cast("string")), age_txt,
             F.col("l_returnflag"), F.floor(F.col("l_quantity") * 75).cast("string"),
             F.floor(F.col("l_extendedprice")).cast("string"),
             (F.col("l_discount") * 50).cast("string"),
             F.floor(F.col("l_tax") * 1000).cast("string"),
             (F.col("l_partkey") % 100).cast("string")]
    rel3 = F.concat_ws("\t", F.concat(F.lit("p"), F.col("l_partkey").cast("string")),
                       F.concat(F.lit("s"), F.col("l_suppkey").cast("string")),
                       F.concat(F.lit("o"), F.col("l_orderkey").cast("string")))
    rel1 = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    full = F.concat_ws("\t", *fixed)
    value = (F.when(ln == 7, F.concat_ws("\t", *fixed[:5]))
              .when(ln == 5, F.concat(full, F.lit("\t\t")))
              .when(ln <= 2, F.concat_ws("\t", full, rel3))
              .otherwise(F.concat_ws("\t", full, rel1)))
    return li.select(
        F.concat(F.lit("c"), F.year("l_shipdate").cast("string")).alias("folder"),
        F.concat((ln % 4).cast("string"), F.lit(".txt")).alias("file_name"),
        F.col("l_orderkey").alias("line_pos"),
        value.alias("value"))


def crawl_logs(lines: DataFrame) -> DataFrame:
    """One log text per folder; the 1998 folder's start line has no date."""
    folders = lines.select("folder").distinct()
    yy = F.substring(F.col("folder"), 4, 2)
    text = F.when(F.col("folder") == "c1998", F.lit("BFS crawl\n\nstart:  ::\nfinish: ::\n")) \
            .otherwise(F.concat(F.lit("BFS crawl\n\nstart:  "), yy, F.lit("0101 1:29:13\nfinish: "),
                                yy, F.lit("0101 5:44:46\n")))
    return folders.select("folder", text.alias("value"))


def write_crawl_tree(spark: SparkSession, sf_dir: str, root: str, without_log: str = "c1997", late_log: str = "c1996") -> str:
    """The crawl lines as a tree of text files: ``<root>/<folder>/<n>.txt`` and ``log.txt``.

    Lines of a file stand in the order in which the first one wins.  The
    folder ``without_log`` gets no log, the log of ``late_log`` has its start
    line after many others.  Lines are parsed and sorted in ranges of many
    tasks; the one task that writes a file gets only their text and number.
    """
    from vidlens.sources import crawl
    lines = crawl_lines(spark, sf_dir, deal="files")
    rows = crawl.parse_crawl_lines(lines.withColumn("line", F.col("value"))).withColumnRenamed("folder", "crawl")
    rows = rows.sortWithinPartitions("crawl", "file_name", "line_pos", *crawl.VIDEO_COLUMNS)
    rows = rows.select("crawl", "file_name", F.monotonically_increasing_id().alias("number"), F.col("line").alias("value"))
    rows = rows.repartition("crawl", "file_name").sortWithinPartitions("crawl", "file_name", "number")
    rows.select("crawl", "file_name", "value").write.partitionBy("crawl", "file_name").text(f"{root}/parts")
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = spark.read.format("binaryFile").load(f"{root}/parts").select("path").collect()   # a file for each crawl file
    for (path,) in parts:
        folder, name = (x.split("=", 1)[1] for x in path.split("/")[-3:-1])
        fs.mkdirs(hadoop.Path(f"{root}/{folder}"))
        fs.rename(hadoop.Path(path), hadoop.Path(f"{root}/{folder}/{name}"))
    fs.delete(hadoop.Path(f"{root}/parts"), True)
    for folder, text in crawl_logs(crawl_lines(spark, sf_dir, deal=None)).where(F.col("folder") != without_log).collect():
        out = fs.create(hadoop.Path(f"{root}/{folder}/log.txt"))
        out.write(((text.split("start:")[0] + "queued one more\n" * 500) * (folder == late_log) + text).encode())
        out.close()
    return root


def split_bytes(spark: SparkSession, root: str, most: str) -> int:
    """Bytes of a split with which small files still spread over several tasks; ``most`` at most.

    It grows with the tree, so that the number of tasks and of files they write does not.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    total = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(most)
    return min(most, max(SPLIT_BYTES, -(-total // TREE_SPLITS)))
