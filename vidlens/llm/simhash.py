"""Document fingerprints: SimHash with permuted block tables (DataFrame functions only)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidlens.llm.common import NULL_ID, partitions, split_words, stored

#: Words in a term.
TERM_WORDS = 5
#: Two fingerprints are near when at most this many of their 64 bits differ.
RADIUS = 3
#: Bit blocks of the tables; every choice of BLOCKS - RADIUS blocks is a table.
BLOCKS = 6
#: Two 32-bit counters in one long: bits i and i + 32 of a term hash.
_LANES = (1 << 32) | 1


def term_hashes(text: Column, words: int = TERM_WORDS) -> Column:
    """64-bit hashes of every run of ``words`` words of the lower-cased text.

    A shorter text is one term; a text without words has none.
    """
    w = split_words(F.lower(text))

    def runs(x: Column) -> Column:
        run = F.transform(F.sequence(F.lit(0), F.size(x) - F.lit(words)),
                          lambda i: F.xxhash64(*[x[i + k] for k in range(words)]))
        return (F.when(F.size(x) >= words, run)
                 .when(F.size(x) > 0, F.array(F.xxhash64(x)))
                 .otherwise(F.array().cast("array<bigint>")))
    # bound once: a lambda variable keeps the split from being repeated per use
    return F.flatten(F.transform(F.array(w), runs))


def fingerprints(df: DataFrame, keys: list[str], text_col: str = "text",
                 words: int = TERM_WORDS, name: str = "fingerprint") -> DataFrame:
    """``keys`` and the 64-bit SimHash ``name`` (long) of the text in each row.

    A term weighs as often as it occurs: every occurrence votes +1 or -1 on
    each bit of the fingerprint by the bit of its hash, and the sign of the
    sum is the bit (a tie gives 0).  The votes of 64 bits are 32 sums of two
    packed counters, aggregated within the task that holds the text, so no
    term leaves it.  ``keys`` must tell the rows apart.  Equal texts have equal
    fingerprints; null, empty and wordless texts have fingerprint 0.
    """
    terms = df.select(*keys, F.explode_outer(term_hashes(F.coalesce(F.col(text_col), F.lit("")), words)).alias("_h"))
    votes = terms.groupBy(*keys).agg(
        F.count("_h").alias("_n"),
        *[F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(F.lit(_LANES))).alias(f"_v{i}") for i in range(32)])
    bits = F.lit(0).cast("long")
    for i in range(32):
        low = F.col(f"_v{i}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"_v{i}"), 32)
        for bit, votes_for in ((i, low), (i + 32, high)):
            one = -(1 << 63) if bit == 63 else 1 << bit
            bits = bits.bitwiseOR(F.when(votes_for * 2 > F.col("_n"), F.lit(one)).otherwise(F.lit(0)).cast("long"))
    return votes.select(*keys, bits.alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits of two fingerprints, 0 to 1."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _masks(radius: int, blocks: int) -> list[int]:
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(c) for c in combinations(block, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _tables(df: DataFrame, radius: int, blocks: int) -> DataFrame:
    """A row for every block table: its number and the kept bits."""
    keys = [F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("k"))
            for i, m in enumerate(_masks(radius, blocks))]
    return df.withColumn("_b", F.explode(F.array(*keys))).select(*df.columns, "_b.t", "_b.k")


def within_radius(queries: DataFrame, rows: DataFrame, fp_col: str = "fingerprint",
                  radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Pairs ``(query_fp, fp, bits)`` of distinct fingerprints within ``radius`` bits.

    Permuted block tables: if at most ``radius`` bits differ, at least
    ``blocks - radius`` of the blocks agree, so the pair meets in the table of
    that choice of blocks.  No pair is missed.  Rows are collapsed to distinct
    fingerprints first, so copies of a document cost nothing; null
    fingerprints match nothing.
    """
    if not 0 <= radius < blocks:
        raise ValueError("radius must be smaller than blocks")
    q = queries.select(F.col(fp_col).alias("fp")).where("fp is not null").distinct()
    r = rows.select(F.col(fp_col).alias("fp")).where("fp is not null").distinct()
    met = _tables(q, radius, blocks).withColumnRenamed("fp", "query_fp").join(_tables(r, radius, blocks), ["t", "k"])
    bits = F.bit_count(F.col("query_fp").bitwiseXOR(F.col("fp")))
    return met.where(bits <= radius).select("query_fp", "fp", bits.alias("bits")).distinct()


def near_counts(queries: DataFrame, rows: DataFrame, fp_col: str = "fingerprint",
                radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``(fp_col, n_within)``: rows of ``rows`` within ``radius`` bits of each query fingerprint."""
    size = rows.groupBy(F.col(fp_col).alias("fp")).agg(F.count(F.lit(1)).alias("m"))
    pairs = within_radius(queries, rows, fp_col, radius, blocks)
    return (pairs.join(size, "fp").groupBy(F.col("query_fp").alias(fp_col))
                 .agg(F.sum("m").alias("n_within")))


def following(ids: DataFrame, order: list[str], carry: list[str]) -> DataFrame:
    """Each row of ``ids`` (no two alike) with the following row's columns as ``o_<name>``.

    The rows are put in the ascending ``order``, and the last is followed by
    the first.  Ranges of the order are numbered and a window runs inside each
    range; only the first row of every range crosses to the one before.
    """
    spark = ids.sparkSession
    cols = order + carry
    r = (ids.select(*cols).repartitionByRange(partitions(spark), *order)
            .withColumn("_pid", F.spark_partition_id()))
    r = stored(r, "ranges")
    inside = Window.partitionBy("_pid").orderBy(*order)
    one = F.lead(F.struct(*cols)).over(inside)
    # one row per range from here on: as many as partitions
    heads = r.groupBy("_pid").agg(F.min(F.struct(*cols)).alias("_head"))
    over = Window.orderBy("_pid")
    every = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("_pid", F.coalesce(F.lead("_head").over(over), F.first("_head").over(every)).alias("_next"))
    out = r.withColumn("_one", one).join(F.broadcast(heads), "_pid") \
           .withColumn("_o", F.coalesce("_one", "_next"))
    return out.select(*cols, *[F.col(f"_o.{c}").alias(f"o_{c}") for c in cols])


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        words: int = TERM_WORDS, query_every: int = 100) -> DataFrame:
    """Fingerprints of every text and of the text edited with its neighbour's start.

    Documents stand in descending id order and the first follows the last.
    The edited text replaces the last ``floor(n/3)`` code points by the first as
    many (or all) of the next document.  Returns ``id_col, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` and
    ``n_near``: for ids divisible by ``query_every`` the number of other
    documents within :data:`RADIUS` bits, null for the rest.

    Defined cases: a null text is empty; a null id counts as the smallest id
    and is reported null; rows with equal id are ordered by a hash of the text,
    and rows repeating id and text count as one document in the order but are
    all returned; a single document is its own neighbour; other columns of
    ``df`` play no part.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("uid"), text.alias("text")) \
             .withColumn("tkey", F.xxhash64("text"))
    ids = docs.groupBy("uid", "tkey", F.char_length("text").alias("n")).agg(F.count(F.lit(1)).alias("copies"))
    # the document that this one is "next" of is the following one in ascending order
    own = docs.join(following(ids, ["uid", "tkey"], ["n", "copies"]), ["uid", "tkey"])
    start = own.select(F.col("o_uid").alias("uid"), F.col("o_tkey").alias("tkey"),
                       F.substring("text", F.lit(1), F.floor(F.col("o_n") / 3).cast("int")).alias("pre"),
                       F.col("uid").alias("next_uid"), F.col("tkey").alias("next_tkey"))
    cut = F.col("n") - F.floor(F.col("n") / 3).cast("int")
    both = (own.join(start, ["uid", "tkey"])
               .withColumn("edited", F.concat(F.substring("text", F.lit(1), cut), F.col("pre"))))
    keys = ["uid", "tkey", "n", "copies", "next_uid", "next_tkey", "sha"]
    kinds = F.explode(F.array(F.struct(F.lit(False).alias("e"), F.col("text").alias("t")),
                              F.struct(F.lit(True).alias("e"), F.col("edited").alias("t"))))
    rows = (both.withColumn("sha", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
                .select(*keys, kinds.alias("_k")).select(*keys, "_k.e", F.col("_k.t").alias("t")))
    # repeated rows vote together, which scales the votes and keeps their signs
    fp = fingerprints(rows, keys + ["e"], "t", words, "fp")
    fp = fp.groupBy(*keys).agg(F.max(F.when(~F.col("e"), F.col("fp"))).alias("fp"),
                               F.max(F.when(F.col("e"), F.col("fp"))).alias("efp"))
    fp = stored(fp, "fingerprints")
    nxt = fp.select(F.col("uid").alias("next_uid"), F.col("tkey").alias("next_tkey"), F.col("fp").alias("next_fp"))
    out = fp.join(nxt, ["next_uid", "next_tkey"])
    is_query = (F.col("uid") != NULL_ID) & (F.col("uid") % query_every == 0)
    near = near_counts(fp.where(is_query), fp.withColumn("_c", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))),
                       "fp")
    out = out.join(near, "fp", "left")
    return out.select(
        F.when(F.col("uid") != NULL_ID, F.col("uid")).alias(id_col), F.col("n").cast("long").alias("n_chars"),
        F.lower(F.hex("sha")).alias("edited_sha256"), as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(is_query, F.col("n_within") - 1).alias("n_near"),
        F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_c")).drop("_c")
