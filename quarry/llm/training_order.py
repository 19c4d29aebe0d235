"""Training-order materialisation.

Documents become sequences of at most ``length`` token ids (the end id
closes each document) and are written once; each has its place in its
part of that table, and the sizes of the parts make the places dense
numbers without moving a row.  A keyed Feistel network permutes the
numbers of the next larger power of four, and cycle-walking repeats it
until the result is below the number of sequences, which makes it a
permutation of exactly those.  The result is a sequence's global slot.  Slot ranges are
partitions: each writes shards of ``stride`` consecutive slots, one folder
and one file per shard, every record padded to the same number of bytes.
So the record of a slot is found by division, a reader starts or resumes
at any slot, and reads are sequential.

Null and empty texts are sequences of the end id alone.  Repeated rows and
null doc_ids are sequences of their own, extra columns are ignored, and an
empty table writes no shards.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import batches_out, new_folder, stored
from quarry.llm.tokens import encoded

ROUNDS = 6
PAD_ID = 0
SHARD = "slot long, doc_id long, piece int, n_tokens int, ids binary, shard long"


# ---------------------------------------------------------------- permutation

def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A round function: a keyed 64-bit finaliser (wrapping arithmetic)."""
    x = x ^ np.uint64(key)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _round_keys(key: int) -> list[int]:
    seeds = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return [int(k) for k in _mix(seeds, key & (1 << 64) - 1)]


def _feistel(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for key in keys:
        left, right = right, left ^ (_mix(right, key) & mask)
    return left << np.uint64(half) | right


def _unfeistel(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for key in reversed(keys):
        left, right = right ^ (_mix(left, key) & mask), left
    return left << np.uint64(half) | right


def _walk(x: np.ndarray, n: int, key: int, step) -> np.ndarray:
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    keys = _round_keys(key)
    x = step(np.asarray(x).astype(np.uint64), half, keys)
    out = np.flatnonzero(x >= n)
    while len(out):
        x[out] = step(x[out], half, keys)
        out = out[x[out] >= n]
    return x.astype(np.int64)


def slots(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each index below ``n``: a keyed permutation of 0..n-1."""
    return _walk(index, n, key, _feistel)


def indexes(slot: np.ndarray, n: int, key: int) -> np.ndarray:
    """The inverse of ``slots``."""
    return _walk(slot, n, key, _unfeistel)


# ------------------------------------------------------------------ sequences

SEQUENCE = "part int, local long, doc_id long, piece int, n_tokens int, ids binary"


def cut_sequences(df: DataFrame, path: str, length: int = 1024, end_id: int = 1) -> DataFrame:
    """Every sequence: its part and place there, doc_id, piece, n_tokens
    and ids (little-endian unsigned 16-bit)."""
    schema = pa.schema([("part", pa.int32()), ("local", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("n_tokens", pa.int32()), ("ids", pa.binary())])

    def rows(batches):
        part, local = TaskContext.get().partitionId(), 0
        end = int(end_id).to_bytes(2, "little")
        for (doc_id,), packed in encoded(batches, path):
            wide = np.frombuffer(packed, "<u4")
            if len(wide) and wide.max() > 0xFFFF:
                raise ValueError("ids above 65535 do not fit a record")
            ids = wide.astype("<u2").tobytes() + end
            for i, start in enumerate(range(0, len(ids), 2 * length)):
                piece = ids[start:start + 2 * length]
                yield part, local, doc_id, i, len(piece) // 2, piece
                local += 1

    def run(batches):
        yield from batches_out(schema, rows(batches), lambda r: len(r[5]))

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SEQUENCE)


def _slot_column(n: int, key: int):
    @F.pandas_udf("long")
    def slot(index: pd.Series) -> pd.Series:
        return pd.Series(slots(index.to_numpy(), n, key))

    return slot


def write_shards(sequences: DataFrame, key: int, length: int, stride: int) -> str:
    """Write ``sequences`` (as ``cut_sequences`` gives) in their training
    order; returns the folder."""
    spark = sequences.sparkSession
    kept = stored(sequences, "sequences", "zstd")
    out = new_folder(spark, "shards")
    sizes = sorted((r["part"], r["count"]) for r in kept.groupBy("part").count().collect())
    n = sum(c for _, c in sizes)
    if not n:
        spark.createDataFrame([], SHARD).write.parquet(out)
        return out
    starts = itertools.accumulate((c for _, c in sizes), initial=0)
    offsets = spark.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts, strict=False)], "part int, first long")
    placed = kept.join(F.broadcast(offsets), "part")          # one row per part
    placed = placed.withColumn("slot", _slot_column(n, key)(F.col("first") + F.col("local")))
    placed = placed.withColumn("shard", F.floor(F.col("slot") / stride).cast("long"))
    n_shards = -(-n // stride)
    parts = min(n_shards, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    range_of = F.floor(F.col("shard") * parts / n_shards).cast("int")
    dealt = placed.select("slot", "doc_id", "piece", "n_tokens", "ids", "shard").repartitionById(parts, range_of)
    padded = F.expr(f"rpad(ids, {2 * length}, X'{PAD_ID.to_bytes(2, 'little').hex()}')")
    dealt.sortWithinPartitions("shard", "slot").withColumn("ids", padded).write.partitionBy("shard").parquet(out)
    return out


def read_shards(spark: SparkSession, folder: str, first: int = 0, count: int | None = None, stride: int = 4096) -> DataFrame:
    """Records of ``count`` slots from ``first`` on, of those shards only
    that hold them, with their shard and their place in it."""
    rows = spark.read.schema(SHARD).parquet(folder)
    if count is not None:
        last = first + count - 1
        rows = rows.where((F.col("shard") >= first // stride) & (F.col("shard") <= last // stride) & (F.col("slot") <= last))
    rows = rows.where(F.col("slot") >= first) if first else rows
    return rows.withColumn("place", (F.col("slot") - F.col("shard") * stride).cast("int"))


def materialise(df: DataFrame, path: str, key: int, length: int = 1024, stride: int = 4096, end_id: int = 1) -> DataFrame:
    """Write every document's sequences in training order and read them back."""
    folder = write_shards(cut_sequences(df, path, length, end_id), key, length, stride)
    return read_shards(df.sparkSession, folder, stride=stride)
