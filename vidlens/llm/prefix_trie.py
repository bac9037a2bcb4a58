"""Conversation prefix trie: blocks of turns first, single turns only where siblings diverge."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidlens.llm.common import crc32_sql, id_crc, partitions, split_words, stored, words_sql

#: Turns in a block.
BLOCK_TURNS = 4
#: Rows of one key that a running total takes at once.
RUN_ROWS = 4096
#: Conversations of one group, whose first takes the others' opening turns.
GROUP = 20
NOTHING_SHA256 = hashlib.sha256(b"").hexdigest()


def _running(df: DataFrame, key: str, place: str, totals: dict[str, tuple[str, str]], down: bool = False) -> DataFrame:
    """Running totals of each ``key`` along the dense number ``place``, the row itself included.

    ``totals`` maps a new column to ``(aggregate, column)``, the aggregate
    being ``sum`` or ``bit_xor``.  Rows go by stretches of ``RUN_ROWS`` places:
    first the total of each stretch, then the totals before each stretch, then
    the rows of one stretch.  So a key with very many rows is no single window.
    """
    part = F.floor(F.col(place) / RUN_ROWS).alias("_part")
    order = (lambda c: F.col(c).desc()) if down else (lambda c: F.col(c).asc())
    parts = df.groupBy(key, part).agg(*[F.expr(f"{f}({c})").alias(f"_{n}") for n, (f, c) in totals.items()])
    before = Window.partitionBy(key).orderBy(order("_part")).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(key, "_part", *[F.coalesce(F.expr(f"{f}(_{n})").over(before), F.lit(0)).alias(f"_{n}")
                                         for n, (f, _) in totals.items()])
    within = Window.partitionBy(key, "_part").orderBy(order(place)).rowsBetween(Window.unboundedPreceding, 0)
    own = df.withColumn("_part", part).join(parts, [key, "_part"])
    for n, (f, c) in totals.items():
        here = F.expr(f"{f}({c})").over(within)
        own = own.withColumn(n, here.bitwiseXOR(F.col(f"_{n}")) if f == "bit_xor" else here + F.col(f"_{n}"))
    return own.drop("_part", *[f"_{n}" for n in totals])


def numbered_turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv, pos, t1, t2, words)``: each turn's place in its conversation, digest and number of words.

    Turns stand by ``turn`` (null first), ties by digest; null role or text is
    the empty string.  Rows without an id are left out.  The rows are sorted
    over all conversations by ranges, so one conversation may be spread over
    many tasks; a place is the row's place in its task plus the rows of the
    conversation in earlier tasks.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), role, text).alias("t2"),
        F.size(split_words(text)).cast("long").alias("words"))
    order = [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("t1").asc(), F.col("t2").asc()]
    n = partitions(df.sparkSession)
    rows = stored(rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
                  .select("conv", "t1", "t2", "words", F.spark_partition_id().alias("_task"),
                          F.monotonically_increasing_id().alias("_row")), "turns")
    tasks = rows.groupBy("conv", "_task").agg(F.min("_row").alias("_from"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("conv").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("conv", "_task", "_from", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return rows.join(tasks, ["conv", "_task"]).select(
        "conv", (F.col("_row") - F.col("_from") + F.col("_before")).alias("pos"), "t1", "t2", "words")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with the first turns of their group's first conversation.

    Takes ``numbered_turns``.  Of conversation ``c`` the first ``h`` turns are
    those of ``c - c % 20`` (all if it has fewer, none if it is absent), with
    ``h = crc32(c) % 4``; then come its own from the ``h``-th on.  Returns
    ``(conv, pos, t1, t2, words)`` and ``(conv, n_turns)`` with a row for every
    conversation, also one without turns.
    """
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("conv", "n", (F.col("conv") - F.col("conv") % GROUP).alias("base"),
                         (id_crc(F.col("conv")) % 4).alias("h"))
    bases = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    sizes = stored(sizes.join(bases, "base", "left").select(
        "conv", "base", "h", "n", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")), "sizes")
    openings = turns.where((F.col("pos") < 3) & (F.col("conv") % GROUP == 0)).select(
        F.col("conv").alias("base"), "pos", "t1", "t2", "words")
    opening = sizes.where("taken > 0").select("conv", "base", "taken").join(openings, "base") \
        .where("pos < taken").select("conv", "pos", "t1", "t2", "words")
    own = turns.join(sizes.select("conv", "h", "taken"), "conv").where("pos >= h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "t1", "t2", "words")
    lengths = sizes.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    return opening.unionByName(own), lengths


def _blocks(turns: DataFrame, size: int) -> DataFrame:
    """``(conv, block, turns, b1, b2, d1, d2)``: the turns of a block, its own digest and that of all up to its end."""
    rows = turns.select("conv", F.floor(F.col("pos") / size).alias("block"), F.struct(
        "pos", F.xxhash64(F.lit(1), "pos", "t1", "t2").alias("x1"), F.xxhash64(F.lit(2), "pos", "t1", "t2").alias("x2"),
        "words").alias("turn"))
    blocks = rows.groupBy("conv", "block").agg(F.sort_array(F.collect_list("turn")).alias("turns"),
                                               F.expr("bit_xor(turn.x1)").alias("b1"), F.expr("bit_xor(turn.x2)").alias("b2"))
    return _running(blocks, "conv", "block", {"d1": ("bit_xor", "b1"), "d2": ("bit_xor", "b2")})


def _nodes(blocks: DataFrame) -> DataFrame:
    """``(depth, p1, p2, q1, q2, words, n_convs, conv_id)`` of all nodes below the root.

    ``p`` is the digest of the node's turns, ``q`` its parent's.  Conversations
    with equal blocks up to here are one row.  A block without a sibling (the
    same turns before it, another block) gives its nodes as they are; the
    blocks of siblings are opened and grouped turn by turn.
    """
    same = stored(blocks.groupBy("block", F.col("d1").bitwiseXOR(F.col("b1")).alias("s1"),
                                 F.col("d2").bitwiseXOR(F.col("b2")).alias("s2"), "d1", "d2")
                  .agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"),
                       F.min("turns").alias("turns")), "blocks")
    siblings = same.groupBy("block", "s1", "s2").agg((F.count(F.lit(1)) > 1).alias("diverge"))

    def digests(k: int) -> Column:
        return F.transform("turns", lambda t, i: F.aggregate(
            F.slice("turns", F.lit(1), i + 1), F.col(f"s{k}"), lambda a, u: a.bitwiseXOR(u[f"x{k}"])))

    rows = same.join(siblings, ["block", "s1", "s2"]).select(
        "diverge", "n_convs", "conv_id", "s1", "s2", F.explode(F.arrays_zip(
            F.col("turns").alias("turn"), digests(1).alias("p1"), digests(2).alias("p2"))).alias("t"))
    rows = rows.select("diverge", "n_convs", "conv_id", (F.col("t.turn.pos") + 1).alias("depth"), "t.p1", "t.p2",
                       F.col("t.p1").bitwiseXOR(F.col("t.turn.x1")).alias("q1"),
                       F.col("t.p2").bitwiseXOR(F.col("t.turn.x2")).alias("q2"), F.col("t.turn.words").alias("words"))
    columns = ["depth", "p1", "p2", "q1", "q2", "words"]
    alone = rows.where("not diverge").select(*columns, "n_convs", "conv_id")
    shared = rows.where("diverge").groupBy(*columns).agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    return alone.unionByName(shared.select(*alone.columns))


def _end_hashes(ends: DataFrame) -> DataFrame:
    """``(depth, p1, p2, ends_sha256)``: the hash of each node's ids in ascending order, joined by commas.

    The rows of a node are sorted in one partition and streamed through the
    hash, which takes them in order; nothing is gathered.
    """
    key = ["depth", "p1", "p2"]

    def task(batches):
        now, state, done = None, None, []
        for batch in batches:
            for *node, conv in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if node == now:
                    state.update(b",%d" % conv)
                    continue
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = node, hashlib.sha256(b"%d" % conv)
            if len(done) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*key, "ends_sha256"])
                done = []
        if now is not None:
            done.append((*now, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*key, "ends_sha256"])

    rows = ends.select(*key, "conv").repartition(partitions(ends.sparkSession), *key).sortWithinPartitions(*key, "conv")
    return rows.mapInArrow(task, "depth long, p1 long, p2 long, ends_sha256 string")


def _subtree_sums(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """``nodes`` with the sum of each column over the node and all below it.

    The nodes with one smallest member ``conv_id`` are a path downwards; each
    path hangs on the node ``(parent_conv_id, depth - 1)`` of its top.  Totals
    of whole paths with all that hang on them are found by doubling: a path
    passes what it has gathered to the path 1, 2, 4, ... steps above, until
    none has one.  A node then has its own path from it downwards, and what
    hangs there.
    """
    whole = [F.sum(c).alias(c) for c in columns]
    top = F.min(F.struct("depth", F.col("parent_conv_id").alias("up")))
    paths = nodes.groupBy("conv_id").agg(*whole, top.alias("top"))
    paths = stored(paths.select("conv_id", F.col("top.up").alias("up"), F.col("top.depth").alias("depth"),
                                F.col("top.up").alias("jump"), *columns), "paths")
    while not paths.where("jump is not null").isEmpty():
        passed = paths.where("jump is not null").groupBy(F.col("jump").alias("conv_id")) \
            .agg(*[F.sum(c).alias(f"_{c}") for c in columns])
        above = paths.select(F.col("conv_id").alias("jump"), F.col("jump").alias("_jump"))
        paths = stored(paths.join(above, "jump", "left").join(passed, "conv_id", "left").select(
            "conv_id", "up", "depth", F.col("_jump").alias("jump"),
            *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in columns]), "paths")
    hanging = paths.where("up is not null").groupBy(F.col("up").alias("conv_id"), (F.col("depth") - 1).alias("depth")) \
        .agg(*[F.sum(c).alias(f"_{c}") for c in columns])
    rows = nodes.join(hanging, ["conv_id", "depth"], "left")
    for c in columns:
        rows = rows.withColumn(c, F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).drop(f"_{c}")
    sums = _running(rows, "conv_id", "depth", {f"_{c}": ("sum", c) for c in columns}, down=True)
    for c in columns:
        sums = sums.withColumn(c, F.col(f"_{c}")).drop(f"_{c}")
    return sums


def prefix_trie(turns: DataFrame, lengths: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The trie of the conversations' first turns, a row a node.

    ``turns`` holds ``conv``, ``pos`` (from 0, without gaps), ``t1``, ``t2``
    (digest of the turn) and ``words``; ``lengths`` holds ``conv`` and
    ``n_turns`` of every conversation, also those without turns.  A node is a
    distinct sequence of first turns; its members are the conversations that
    start with it.  Columns: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes in its subtree), ``saved_tokens`` (summed over
    its subtree: members but one, times the words of the last turn) and
    ``ends_sha256`` (of the ids that end here, ascending, joined by commas).
    ``(conv_id, depth)`` is a key.

    Turns are compared by 128-bit digests.  Conversations are grouped by the
    digests of successive blocks of ``block_turns`` turns; only where blocks
    differ after the same turns are they opened.  Every grouping is a partial
    aggregate and every join is on a unique side, so a first turn that a third
    of all conversations share costs one row a task.  No conversations give an
    empty result; conversations without a turn end at the root.
    """
    blocks = stored(_blocks(turns, block_turns), "blocks")
    below = _nodes(blocks)
    root = lengths.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        *[F.lit(0).cast("long").alias(c) for c in ("depth", "p1", "p2")],
        *[F.lit(None).cast("long").alias(c) for c in ("q1", "q2")],
        F.lit(0).cast("long").alias("words"), "n_convs", "conv_id")
    nodes = stored(below.unionByName(root), "nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
                           F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(parents, ["depth", "q1", "q2"], "left")
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes.select(
        "conv_id", "depth", "p1", "p2", "parent_conv_id", "n_convs", "n_children",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), "nodes")
    last = blocks.groupBy("conv").agg(F.max(F.struct("block", "d1", "d2")).alias("b"))
    ends = lengths.join(last, "conv", "left").select(
        "conv", F.col("n_turns").alias("depth"), F.coalesce("b.d1", F.lit(0)).alias("p1"), F.coalesce("b.d2", F.lit(0)).alias("p2"))
    summed = _subtree_sums(nodes, ["n_leaves", "saved_tokens"])
    return summed.join(_end_hashes(ends), ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING_SHA256)).alias("ends_sha256"))


def conversation_trie(df: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``prefix_trie`` of ``conversations`` after ``rebuilt_turns``.

    Repeated rows are turns of their own; rows without ``conv_id`` are left
    out; other columns are not read.
    """
    return prefix_trie(*rebuilt_turns(numbered_turns(df)), block_turns)


ORACLE_SQL = f"""with o as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, len({words_sql('text')}) as words,
         row_number() over (partition by conv_id order by turn nulls first) - 1 as pos
  from conversations where conv_id is not null),
c as (select conv_id, conv_id - conv_id % {GROUP} as base, {crc32_sql('cast(conv_id as varchar)')} % 4 as h
      from (select distinct conv_id from o)),
u as (select c.conv_id, 0 as part, o.pos, o.role, o.text, o.words from c join o on o.conv_id = c.base and o.pos < c.h
      union all select c.conv_id, 1, o.pos, o.role, o.text, o.words from c join o on o.conv_id = c.conv_id and o.pos >= c.h),
s as (select c.conv_id, coalesce(list((u.role, u.text) order by part, pos) filter (where part is not null), []) as path,
             coalesce(list(u.words order by part, pos) filter (where part is not null), []) as words
      from c left join u on c.conv_id = u.conv_id group by c.conv_id),
m as (select conv_id, d, path[1:d] as prefix, case when d > 0 then words[d] else 0 end as words, len(path) = d as ends
      from (select *, unnest(range(len(path) + 1)) as d from s)),
n as (select d, prefix, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(words) as saved,
             coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ends), '') as ends from m group by d, prefix),
k as (select n.*, p.conv_id as parent_conv_id, (select count(*) from n x where x.d = n.d + 1 and x.prefix[1:n.d] = n.prefix) as n_children
      from n left join n p on p.d = n.d - 1 and p.prefix = n.prefix[1:n.d - 1]),
t as (select a.conv_id, a.d, sum(case when b.n_children = 0 then 1 else 0 end) as n_leaves, sum(b.saved) as saved_tokens
      from k a join k b on b.d >= a.d and b.prefix[1:a.d] = a.prefix group by a.conv_id, a.d)
select k.conv_id, cast(k.d as bigint) as depth, k.parent_conv_id, k.n_convs, k.n_children, cast(t.n_leaves as bigint) as n_leaves,
       cast(t.saved_tokens as bigint) as saved_tokens, sha256(k.ends) as ends_sha256
from k join t on k.conv_id = t.conv_id and k.d = t.d"""
