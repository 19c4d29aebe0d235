"""Best-fit packing with certified bin counts.

Documents become pieces of at most ``capacity`` tokens; pieces are dealt
to partitions by row, and each partition packs its own by best fit
decreasing.  Lower bounds from dual-feasible functions certify a
partition whose bin count they reach.  While the whole count is above the
bound of the whole, partitions with a gap give up the documents of their
bins that are not full, certified ones those of their emptiest bin (what
rounding up per partition costs), and what was given up is dealt to fewer
partitions and packed again.  A round is kept when it saves bins; the
loop ends when the bound is reached, or a round saves nothing.

Only (length, place) rows are shuffled, never ids or texts.  A partition
holds about ``per_part`` pieces, whatever the input; a document with very
many pieces is dealt like any others, as pieces are dealt by row.

Null and empty texts are documents of the end id alone.  Repeated rows
and null doc_ids are packed as documents of their own; ties in length go
by row.  An empty table gives no sequences; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import batches_out, stored
from quarry.llm.tokens import encoded

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "row long, " + PIECE + ", part long, bin long, offset long, fill long, bins long, bound long, emptiest boolean"


def cut_pieces(df: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece of every document: its ids and the end id, cut
    into ``capacity`` tokens where they are more."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = int(end_id).to_bytes(4, "little")

    def rows(batches):
        for (doc_id,), packed in encoded(batches, path):
            packed = memoryview(packed + end)
            n = len(packed) // 4
            for i, start in enumerate(range(0, n, capacity)):
                stop = min(n, start + capacity)
                yield doc_id, i, start, stop - start, zlib.crc32(packed[4 * start:4 * stop])

    def run(batches):
        yield from batches_out(schema, rows(batches), lambda r: 40)

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE)


# ------------------------------------------------------------- one partition

def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of lengths given longest first, and the bin count.
    Open bins stand in stacks by the room they have; a bit set of the
    rooms in use finds the smallest that is large enough."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n_bins = 0, 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        large = rooms >> length
        if large:
            room = length + (large & -large).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = b, capacity - room
        left = room - length
        if left:
            stacks[left].append(b)
            rooms |= 1 << left
    return bins, offsets, n_bins


def lower_bound(counts: np.ndarray, capacity: int, max_p: int = 32) -> int:
    """The best of three bounds on the bins for ``counts[x]`` items of
    length x: total size; for every k up to half a bin, items over
    capacity - k as whole bins and those under k as nothing; the stepped
    functions u_p, which round a length down to p-ths of a bin unless it
    is a multiple of 1 / (p + 1)."""
    x = np.arange(capacity + 1, dtype=np.int64)
    sizes = np.cumsum(counts * x)
    number = np.cumsum(counts)
    best = -(-int(sizes[-1]) // capacity)
    k = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - k]
    middle = sizes[capacity - k] - sizes[k - 1]
    if len(k):
        best = max(best, int((whole + -(-middle // capacity)).max()))
    for p in range(1, max_p + 1):
        weight = np.where((p + 1) * x % capacity == 0, x * p, (p + 1) * x // capacity * capacity)
        best = max(best, -(-int((counts * weight).sum()) // (capacity * p)))
    return best


def _pack_part(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row"], ascending=[False, True], kind="stable").reset_index(drop=True)
        lengths = rows["length"].to_numpy()
        bins, offsets, n = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=n).astype(np.int64)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        emptiest = bins == (int(fill.argmin()) if n and fill.min() < capacity else -1)
        return rows.assign(bin=bins, offset=offsets, fill=fill[bins], bins=n, bound=bound, emptiest=emptiest)

    return run


# ------------------------------------------------------------------ the whole

def _pack_round(rows: DataFrame, number: int, n_rows: int, per_part: int, capacity: int, name: str) -> DataFrame:
    parts = max(1, -(-n_rows // per_part))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("row", F.lit(number)), F.lit(parts)))
    return stored(dealt.groupBy("part").applyInPandas(_pack_part(capacity), PLACED), name)


def _bound_of(rows: DataFrame, capacity: int) -> int:
    """The bound of all rows together, from at most ``capacity`` counts."""
    counts = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    return lower_bound(counts, capacity)


def _bins_of(rows: DataFrame) -> int:
    return rows.select("part", "bin").distinct().count()


def pack(pieces: DataFrame, capacity: int = 4096, per_part: int = 8192) -> DataFrame:
    """``pieces`` (PIECE) with sequence_id and offset: each sequence holds
    its pieces without gaps from 0, ``capacity`` tokens at most."""
    pieces = stored(pieces.withColumn("row", F.monotonically_increasing_id()).select(
        "row", "doc_id", "piece", "start", "length", "ids_crc32"), "pieces")
    n = pieces.count()
    placed = _pack_round(pieces, 0, n, per_part, capacity, "packed")
    settled, number = None, 0
    while True:
        number += 1
        given_up = (F.col("fill") < capacity) & ((F.col("bins") > F.col("bound")) | F.col("emptiest"))
        pool = placed.where(given_up)
        pool_rows, before, least = pool.count(), _bins_of(pool), _bound_of(pool, capacity)
        if before <= least:
            break
        again = _pack_round(pool.select("row", "doc_id", "piece", "start", "length", "ids_crc32"), number, pool_rows, per_part, capacity, "repacked")
        if _bins_of(again) >= before:
            break
        kept = _named(placed.where(~given_up), number - 1)
        settled = kept if settled is None else settled.unionByName(kept)
        placed = again
    last = _named(placed, number - 1)
    return last if settled is None else settled.unionByName(last)


def _named(placed: DataFrame, number: int) -> DataFrame:
    sequence = F.lit(number).cast("long") * (1 << 48) + F.col("part") * (1 << 24) + F.col("bin")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset")


def best_fit_packing(df: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    return pack(cut_pieces(df, path, capacity, end_id), capacity)
