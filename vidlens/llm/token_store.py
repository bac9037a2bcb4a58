"""Token-id shards with a minimal perfect hash index."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vidlens.llm.common import NULL_ID, partitions
from vidlens.llm.shingles import mix
from vidlens.llm.tokens import END_ID, batches, crc32_of_ids, encoder

#: A shard is closed when its payload has so many bytes (a longer document has a shard of its own).
SHARD_BYTES = 4 * 1024 * 1024
#: Slots per key of a level of the hash.
_GAMMA = 2
_SALT = np.uint64(0xD6E8FEB86659FD93)

SHARDS = ("part int, shard int, first_key long, last_key long, n_docs long, n_tokens long, part_start long, "
          "width int, keys binary, copies binary, hash binary, prints binary, offsets binary, payload binary")


def key_hashes(keys: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``(key, copy number)``."""
    return mix(mix(keys.astype(np.int64).view(np.uint64) + _SALT) + copies.astype(np.uint64) * _SALT)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ _SALT) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """Minimal perfect hash: levels of bit arrays, each holding the keys that stand alone there.

    The slot of a key is the number of set bits before its own.
    """

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        self.rank = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))

    @staticmethod
    def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * int(_SALT) & (1 << 64) - 1)
        return (mix(h + salt) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        left, sizes, levels = hashes, [], []
        while len(left):
            if len(sizes) >= 200:
                raise ValueError("equal key hashes in a shard")
            size = max(8, _GAMMA * len(left))
            at = cls._place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of every hash; any slot, or -1, for hashes not built in."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        for level, size in enumerate(self.sizes):
            todo = np.flatnonzero(out < 0)
            if not len(todo):
                break
            at = self.starts[level] + self._place(hashes[todo], level, size)
            hit = self.bits[at]
            out[todo[hit]] = self.rank[at[hit]]
        return out

    def to_bytes(self) -> bytes:
        return struct.pack(f"<I{len(self.sizes)}I", len(self.sizes), *self.sizes) + np.packbits(self.bits).tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        (n,) = struct.unpack_from("<I", raw)
        sizes = list(struct.unpack_from(f"<{n}I", raw, 4))
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, offset=4 + 4 * n), count=sum(sizes)).astype(bool)
        return cls(sizes, bits)


def _shard(part: int, number: int, start: int, keys: list[int], copies: list[int], ids: list[np.ndarray]) -> tuple:
    k, c = np.array(keys, "<i8"), np.array(copies, "<i8")
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    h = key_hashes(k, c)
    mph = PerfectHash.build(h)
    slot = mph.slots(h)
    prints, offsets = np.empty(len(k), "<u4"), np.empty((len(k), 2), "<i8")
    prints[slot] = fingerprint(h)
    offsets[slot, 0], offsets[slot, 1] = ends - [len(x) for x in ids], [len(x) for x in ids]
    body = np.concatenate(ids)
    return (part, number, keys[0], keys[-1], len(keys), int(ends[-1]), start, body.dtype.itemsize, k.tobytes(),
            c.tobytes(), mph.to_bytes(), prints.tobytes(), offsets.tobytes(), body.tobytes())


def _shards(path: str, shard_bytes: int):
    names = [c.split()[0] for c in SHARDS.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, part = encoder(path), TaskContext.get().partitionId()
        number = start = size = 0
        keys, copies, ids = [], [], []
        last, copy = None, 0
        for f in frames:
            texts, uids = f["text"].tolist(), f["uid"].tolist()
            for a, b in batches(texts):
                for uid, x in zip(uids[a:b], enc.encode(texts[a:b])):
                    copy = copy + 1 if uid == last else 0
                    last = uid
                    x = np.append(x, x.dtype.type(END_ID))
                    keys.append(uid)
                    copies.append(copy)
                    ids.append(x)
                    size += x.nbytes
                    if size >= shard_bytes:
                        yield pd.DataFrame([_shard(part, number, start, keys, copies, ids)], columns=names)
                        start += sum(map(len, ids))
                        number, size, keys, copies, ids = number + 1, 0, [], [], []
        if keys:
            yield pd.DataFrame([_shard(part, number, start, keys, copies, ids)], columns=names)
    return run


def write_token_store(df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every document and write the ids as shards under ``path``.

    Documents are range-partitioned and sorted by id; a partition writes its
    shards one after another, so ids and shards ascend together.  A row of the
    written table is a shard: the raw little-endian ids of its documents
    (``payload``, 2 or 4 bytes each by the size of the vocabulary), and an
    index: a minimal perfect hash of ``(key, copy)`` to a slot, and by slot the
    key's fingerprint and its offset and length in the payload.

    Defined cases: a null or empty text is the end id alone; a null id counts
    as the smallest id; rows that repeat an id are numbered copies in the order
    of a hash of their text; an empty table writes an empty store.
    """
    spark = df.sparkSession
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("uid"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tkey", F.xxhash64("text"))
    rows = rows.repartitionByRange(partitions(spark), "uid").sortWithinPartitions("uid", "tkey")
    rows.select("uid", "text").mapInPandas(_shards(tokenizer, shard_bytes), SHARDS).write.parquet(path)


def _find(row, keys: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(found, [offset, length])`` of keys in a shard: one probe each."""
    mph = PerfectHash.from_bytes(row.hash)
    h = key_hashes(keys, copies)
    slot = mph.slots(h)
    ok = slot >= 0
    ok[ok] = np.frombuffer(row.prints, "<u4")[slot[ok]] == fingerprint(h[ok])
    return ok, np.frombuffer(row.offsets, "<i8").reshape(-1, 2)[np.where(ok, slot, 0)]


def _payload(row) -> np.ndarray:
    return np.frombuffer(row.payload, f"<u{row.width}")


def _documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        for row in f.itertuples(index=False):
            keys, copies = np.frombuffer(row.keys, "<i8"), np.frombuffer(row.copies, "<i8")
            ok, where = _find(row, keys, copies)
            if not ok.all():
                raise ValueError("a key of the shard is not in its index")
            ids = _payload(row)
            yield pd.DataFrame({
                "uid": keys, "start": row.base + row.part_start + where[:, 0], "n_tokens": where[:, 1],
                "ids_crc32": [crc32_of_ids(ids[o:o + n]) for o, n in where]})


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col, start, n_tokens, ids_crc32`` of every document, from the files alone.

    Each key of a shard is looked up through its index.  ``start`` counts the
    ids of all documents before it; the sum over earlier partitions comes from
    one row per partition, read without the payloads.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    # as many rows as partitions were written
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = shards.join(F.broadcast(parts), "part").select(
        "base", "part_start", "width", "keys", "copies", "hash", "prints", "offsets", "payload")
    out = rows.mapInPandas(_documents, "uid long, start long, n_tokens long, ids_crc32 long")
    return out.select(F.when(F.col("uid") != NULL_ID, F.col("uid")).alias(id_col), "start", "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, keys: list[int], id_col: str = "doc_id") -> DataFrame:
    """``id_col, ids`` of the given keys that are stored, a row for each copy.

    For a list of keys that the caller holds.  Only shards whose key range
    reaches into that of the list are read; copies are probed upwards until
    one misses, in the next shard from the copy that it begins with.
    """
    wanted = np.array(sorted(set(keys)), dtype=np.int64)

    def probe(frames):
        for f in frames:
            for row in f.itertuples(index=False):
                near = wanted[(wanted >= row.first_key) & (wanted <= row.last_key)]
                if not len(near):
                    continue
                ids = _payload(row)
                copies = np.where(near == row.first_key, np.frombuffer(row.copies, "<i8", 1)[0], 0)
                while len(near):
                    ok, where = _find(row, near, copies)
                    near, copies = near[ok], copies[ok] + 1
                    if len(near):
                        yield pd.DataFrame({"k": near, "ids": [ids[o:o + n].astype(np.int64) for o, n in where[ok]]})

    shards = spark.read.schema(SHARDS).parquet(path)
    low, high = (int(wanted[0]), int(wanted[-1])) if len(wanted) else (0, -1)
    near = shards.where((F.col("last_key") >= low) & (F.col("first_key") <= high))
    return near.mapInPandas(probe, "k long, ids array<long>").withColumnRenamed("k", id_col)
