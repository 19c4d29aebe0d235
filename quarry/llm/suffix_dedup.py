"""Removal of repeated byte strings by suffix sorting.

Every byte that lies in a string of ``LENGTH`` bytes which also starts
anywhere else, in the same document or another, is removed.

A window of that many bytes has an anchor: the least hash among its
k-grams, leftmost first.  It depends on the window's bytes alone, so equal
windows have equal anchors at the same place, and comparing windows within
the group of their anchor's hash loses nothing.  Starts in a row with one
anchor form a cell; a cell's span is what its windows cover.  Cells of a
hash that occurs once are settled: cells are sorted by it, once, and those
without an equal neighbour go.  Cells with equal spans are collapsed
before anything is compared; a span that occurs twice is repeated as a
whole.  What remains are groups of different spans with the same anchor:
these are lined up at the anchor and cut where the spans' agreement
changes from one byte to the next, which turns each span into a short
string of symbols.  The suffixes of all these strings are sorted (see
``suffix_sort``), and a window is repeated if its suffix shares enough
symbols with a neighbour in that order.

A group beyond a task's size is dealt to chunks, and each pair of chunks
meets in a task of its own.  Equal texts are documents of their own here,
their spans are collapsed like all others.

Null texts are empty; texts shorter than a window lose nothing.  Repeated
rows count as documents (each is elsewhere for the other); null doc_ids
are kept apart by their text.  Extra columns are ignored, and an empty
table gives an empty table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import batches_out, release, stored
from quarry.llm.suffix_sort import common_prefixes, suffix_array

LENGTH = 400
GRAM = 200
BLOCK = 1 << 17             # window starts worked on at once
CHUNK = 1024                # spans of a group in a task, twice
SYMBOLS = 1 << 17           # sorted at once
CELL = "key long, known boolean, anchor long, span long, doc_id long, text_hash long, place long"
REPEATED = "anchor long, span long, doc_id long, text_hash long, place long"


# ----------------------------------------------------------------------- cells

def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        out[done:2 * done] = out[:min(done, n - done)] * step
        done *= 2
    return out


@lru_cache(maxsize=1)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A value for each byte, and powers of an odd base and of its inverse modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    return _mix(np.arange(1, 257, dtype=np.uint64)), _powers(base, n), _powers(pow(base, -1, 1 << 64), n)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def cells(data: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(first start, number of starts, anchor place - first start, anchor
    hash, span hash) of every cell of a text, as arrays."""
    width = length - gram + 1       # k-grams of a window
    found = []
    for first in range(0, len(data) - length + 1, BLOCK):
        part = data[first:first + BLOCK + length - 1]
        value, power, inverse = _tables(BLOCK + length)
        before = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(value[part] * power[:len(part)], out=before[1:])
        n = len(part) - gram + 1
        h = _mix((before[gram:gram + n] - before[:n]) * inverse[:n])
        least = h & ~np.uint64((1 << 20) - 1) | np.arange(n, dtype=np.uint64)      # of equal ones the leftmost
        size = 1
        while size < width:
            step = min(size, width - size)
            least = np.minimum(least[:-step], least[step:])
            size += step
        place = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        start = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        count = np.diff(np.r_[start, len(place)])
        place = place[start]
        end = start + count - 1 + length
        span = _mix((before[end] - before[start]) * inverse[start])
        span = _mix(span ^ _mix((count << 32 | (place - start)).astype(np.uint64)))
        found.append((start + first, count, place - start, h[place].view(np.int64), span.view(np.int64)))
    return [np.concatenate(c) for c in zip(*found, strict=True)] if found else None


def _bytes(text: pa.StringScalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _cell_task(length: int):
    def run(batches):
        held, weight = [], 0
        for batch in batches:
            for doc_id, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = cells(np.frombuffer(_bytes(text), np.uint8), length, length // 2)
                if found is not None:
                    held.append((doc_id, text_hash, found))
                    weight += len(found[0])
                if weight > 100_000:
                    yield _cell_batch(held)
                    held, weight = [], 0
        if held:
            yield _cell_batch(held)

    return run


def _cell_batch(held):
    """Cells as rows keyed by their anchor.  Of an anchor that a batch holds
    several times only the first cell is: the others are known to be
    repeated and lie anywhere."""
    n = [len(f[0]) for *_, f in held]
    index = pa.array(np.repeat(np.arange(len(held)), n))
    start, n_starts, lead, anchor, span = (np.concatenate([f[k] for *_, f in held]) for k in range(5))
    _, first, which, count = np.unique(anchor, return_index=True, return_inverse=True, return_counts=True)
    known = count[which] > 1
    spread = known.copy()
    spread[first] = False
    key = np.where(spread, _mix(anchor.view(np.uint64) + np.arange(len(anchor), dtype=np.uint64)).view(np.int64), anchor)
    place = start.astype(np.int64) << 32 | n_starts.astype(np.int64) << 16 | lead.astype(np.int64)
    columns = [pa.array(key), pa.array(known), pa.array(anchor, mask=~spread), pa.array(span), pa.array([d for d, *_ in held], pa.int64()).take(index),
               pa.array([t for _, t, _ in held], pa.int64()).take(index), pa.array(place)]
    return pa.record_batch(columns, names=["key", "known", "anchor", "span", "doc_id", "text_hash", "place"])


def _repeated_task(batches):
    """Rows sorted by key: those known to be repeated, and those with the
    key of the row before or after them."""
    before, held = None, None

    def kept(rows, keep):
        anchor = rows.column("anchor").fill_null(0).to_numpy()
        anchor = np.where(np.asarray(rows.column("anchor").is_null()), rows.column("key").to_numpy(), anchor)
        part = pa.record_batch([pa.array(anchor), *[rows.column(c) for c in ("span", "doc_id", "text_hash", "place")]], names=["anchor", "span", "doc_id", "text_hash", "place"])
        return part.filter(pa.array(keep))

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key, n = rows.column("key").to_numpy(), rows.num_rows
        same = key[1:] == key[:-1]
        keep = np.asarray(rows.column("known").to_numpy(zero_copy_only=False), bool)
        keep[0] |= before is not None and key[0] == before
        keep[1:] |= same
        keep[:-1] |= same
        yield kept(rows.slice(0, n - 1), keep[:-1])
        before, held = key[n - 2] if n > 1 else before, rows.slice(n - 1)
    if held is not None:
        yield kept(held, np.asarray(held.column("known").to_numpy(zero_copy_only=False), bool) | (held.column("key").to_numpy() == before if before is not None else False))


# -------------------------------------------------------- spans with one anchor

def first_equal(rows: np.ndarray) -> np.ndarray:
    """For each value the place of the first equal one in its row."""
    order = np.argsort(rows, axis=1, kind="stable")
    held = np.take_along_axis(rows, order, 1)
    begins = np.zeros(rows.shape, np.int64)
    begins[:, 1:] = np.where(held[:, 1:] != held[:, :-1], np.arange(1, rows.shape[1]), 0)
    out = np.empty(rows.shape, np.int64)
    np.put_along_axis(out, order, np.take_along_axis(order, np.maximum.accumulate(begins, axis=1), 1), 1)
    return out


class Group:
    """Different spans with one anchor hash, lined up at the anchor.

    ``members``: (key, anchor place in the span, number of starts, bytes).
    A segment is a run of columns in which the same spans agree; a symbol
    names a segment and the first span that has the same bytes there.
    """

    def __init__(self, members: list[tuple]):
        self.keys = [m[0] for m in members]
        d = len(members)
        lead = np.array([m[1] for m in members])
        self.first = lead.max() - lead                  # the column of each span's first start
        self.n_starts = np.array([m[2] for m in members])
        width = int(max(f + len(m[3]) for f, m in zip(self.first, members, strict=True)))
        outside = 256 + np.arange(d, dtype=np.int16 if d < 1 << 14 else np.int32)       # outside a span nothing agrees
        grid = np.repeat(outside[:, None], width, 1)
        for r, m in enumerate(members):
            grid[r, self.first[r]:self.first[r] + len(m[3])] = np.frombuffer(m[3], np.uint8)
        label = np.zeros((d, width), np.int32)
        differ = np.flatnonzero((grid != grid[0]).any(0))
        for some in np.split(differ, range(BLOCK // d + 1, len(differ), BLOCK // d + 1)):
            label[:, some] = first_equal(grid[:, some].T).T
        cut = np.flatnonzero(np.r_[True, (label[:, 1:] != label[:, :-1]).any(0)])
        self.starts, self.ends = cut, np.r_[cut[1:], width]
        self.symbols = label[:, cut] + d * np.arange(len(cut))

    def repeated(self, shared: np.ndarray, length: int) -> list[list[int]]:
        """By span: first start and number of starts of each run whose
        windows are repeated.  ``shared``: symbols that each suffix shares."""
        last = np.arange(len(self.starts))[None, :] + shared - 1
        reach = np.where(shared > 0, self.ends[np.maximum(last, 0)], 0)
        low = np.maximum(self.starts[None, :], self.first[:, None])
        high = np.minimum(np.minimum(self.ends[None, :] - 1, (self.first + self.n_starts)[:, None] - 1), reach - length)
        out: list[list[int]] = [[] for _ in self.keys]
        for r, s in zip(*np.nonzero(high >= low), strict=True):
            out[r] += [int(low[r, s] - self.first[r]), int(high[r, s] - low[r, s] + 1)]
        return out


def resolve(groups: list[Group], length: int = LENGTH):
    """(key, repeated runs) of the spans of all groups, by one suffix sort."""
    parts, base, rows = [], 0, 0
    for g in groups:
        d, s = g.symbols.shape
        text = np.empty((d, s + 1), np.int64)
        text[:, :-1] = g.symbols + base
        text[:, -1] = -2 - rows - np.arange(d)          # a separator of its own after each string
        parts.append(text.ravel())
        base, rows = base + int(g.symbols.max()) + 1, rows + d
    text = np.concatenate([*parts, [-2 - rows]])
    order = suffix_array(text)
    prefix = np.array(common_prefixes(text.tolist(), order))
    shared = np.empty(len(text), np.int64)
    shared[order] = np.maximum(prefix, np.r_[prefix[1:], 0])
    at = 0
    for g in groups:
        d, s = g.symbols.shape
        mine = shared[at:at + d * (s + 1)].reshape(d, s + 1)[:, :-1]
        at += d * (s + 1)
        yield from zip(g.keys, g.repeated(mine, length), strict=True)


def _span_task(length: int):
    """Bytes of the wanted spans of each text."""
    def run(batches):
        schema = pa.schema([("anchor", pa.int64()), ("span", pa.int64()), ("chunks", pa.int64()), ("lead", pa.int32()), ("n_starts", pa.int32()), ("bytes", pa.binary())])

        def rows():
            for batch in batches:
                for text, wanted in zip(batch.column(0), batch.column(1), strict=True):
                    data = _bytes(text)
                    for w in wanted.as_py():
                        yield w["anchor"], w["span"], w["chunks"], w["lead"], w["n_starts"], data[w["start"]:w["start"] + w["n_starts"] - 1 + length]

        yield from batches_out(schema, rows(), lambda r: len(r[5]))

    return run


def _resolve_task(length: int):
    """Rows sorted by (anchor, i, j): one group after the other."""
    def run(batches):
        schema = pa.schema([("anchor", pa.int64()), ("span", pa.int64()), ("runs", pa.list_(pa.int32()))])

        def groups():
            now, members = None, {}
            for batch in batches:
                for anchor, i, j, span, lead, n_starts, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if (anchor, i, j) != now:
                        if len(members) > 1:
                            yield Group(list(members.values()))
                        now, members = (anchor, i, j), {}
                    members[span] = ((anchor, span), lead, n_starts, data)
            if len(members) > 1:
                yield Group(list(members.values()))

        def rows():
            held, weight = [], 0
            for g in groups():
                held.append(g)
                weight += g.symbols.size
                if weight >= SYMBOLS:
                    for (anchor, span), runs in resolve(held, length):
                        yield anchor, span, runs
                    held, weight = [], 0
            if held:
                for (anchor, span), runs in resolve(held, length):
                    yield anchor, span, runs

        yield from batches_out(schema, (r for r in rows() if r[2]), lambda r: 8 * len(r[2]))

    return run


# ------------------------------------------------------------------- operator

REMOVED = "doc_id long, n_bytes long, removed array<long>, kept binary"


def _cut(text: pa.StringScalar, found: list, whole_characters: bool, length: int, words: int = 0) -> tuple[int, list[int], bytes]:
    """(bytes of the text, removed runs flat, what is kept).  A run of fewer
    than ``LENGTH`` bytes and fewer than ``words`` words stays."""
    data = _bytes(text)
    kept, at, flat = [], 0, []
    for first, last in merged(found, length):
        if last - first < LENGTH and len(data[first:last].split()) < words:
            continue
        if whole_characters:
            first, last = _inside(data, first, last)
        if first < last:
            kept.append(data[at:first])
            at = last
            flat += [first, last]
    return len(data), flat, b"".join([*kept, data[at:]])


def _removal_task(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.int64())), ("kept", pa.binary())])

    def rows():
        for batch in batches:
            for doc_id, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                yield doc_id, *_cut(text, found.as_py() or [], False, LENGTH)

    yield from batches_out(schema, rows(), lambda r: len(r[3]) + 8 * len(r[2]))


def _cleaning_task(length: int, words: int, found_in: str):
    """The same batches with the texts cut and without the found runs."""
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                at = part.schema.get_field_index("text")
                runs = part.column(part.schema.get_field_index(found_in))
                texts = [text.as_py() if not found.is_valid else _cut(text, found.as_py(), True, length, words)[2].decode()
                         for text, found in zip(part.column(at), runs, strict=True)]
                yield part.set_column(at, "text", pa.array(texts, pa.string())).drop_columns([found_in])

    return run


def _inside(data: bytes, first: int, last: int) -> tuple[int, int]:
    """The run without the characters that it covers in part only."""
    while first < last and data[first] & 0xC0 == 0x80:
        first += 1
    while first < last < len(data) and data[last] & 0xC0 == 0x80:
        last -= 1
    return first, last


def merged(found: list, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal byte runs [first, last) of windows given as cells' runs."""
    runs = sorted((c["start"] + first, c["start"] + first + n - 1 + length) for c in found for first, n in zip(c["runs"][::2], c["runs"][1::2], strict=True))
    out: list[list[int]] = []
    for first, last in runs:
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def remove_repeats(df: DataFrame) -> DataFrame:
    """doc_id, n_bytes, removed (first and end of each removed run, flat)
    and kept (the bytes that remain, joined) of every document."""
    found = _with_runs(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), LENGTH, "found")
    return found.select("doc_id", "text", "found").mapInArrow(_removal_task, REMOVED)


def clean_texts(df: DataFrame, length: int = LENGTH, words: int = 0) -> DataFrame:
    """``df`` with strings of ``length`` bytes that stand elsewhere, too,
    taken out of its texts.  Of runs shorter than ``LENGTH`` bytes only
    those of ``words`` words or more are taken.  A run leaves the
    characters that it would cut, so a text stays UTF-8."""
    runs = unused(df, "found")
    return _with_runs(df, length, runs).mapInArrow(_cleaning_task(length, words, runs), df.schema)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _with_runs(df: DataFrame, length: int, runs: str) -> DataFrame:
    """``df`` with ``runs``: the runs of repeated windows by cell, or null."""
    spark = df.sparkSession
    read = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    by_key = read.mapInArrow(_cell_task(length), CELL).repartition("key").sortWithinPartitions("key")
    place = {"start": F.shiftright("place", 32), "n_starts": F.shiftright("place", 16).bitwiseAND(0xFFFF), "lead": F.col("place").bitwiseAND(0xFFFF)}
    repeated = by_key.mapInArrow(_repeated_task, REPEATED).select("doc_id", "text_hash", "anchor", "span", *[c.cast("int").alias(n) for n, c in place.items()])
    repeated = stored(repeated, "repeated-cells", "zstd")
    release(spark)

    where = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash", "start")
    spans = stored(repeated.groupBy("anchor", "span").agg(F.count(F.lit(1)).alias("n"), F.min(where).alias("at"), F.first("n_starts").alias("n_starts"), F.first("lead").alias("lead")), "spans")
    kinds = spans.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    mixed = spans.join(kinds.where(F.col("kinds") > 1), "anchor").select(
        "anchor", "span", "lead", "n_starts", F.ceil(F.col("kinds") / CHUNK).alias("chunks"), "at.doc_id", "at.text_hash", "at.start")
    wanted = mixed.groupBy(F.col("doc_id").alias("its_id"), "text_hash").agg(F.collect_list(F.struct("anchor", "span", "chunks", "lead", "n_starts", "start")).alias("wanted"))
    texts = read.join(wanted, "text_hash").where(F.col("doc_id").eqNullSafe(F.col("its_id"))).select("text", "wanted")
    contents = texts.mapInArrow(_span_task(length), "anchor long, span long, chunks long, lead int, n_starts int, bytes binary")
    mine = F.pmod(F.xxhash64("span"), F.col("chunks"))
    dealt = contents.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = dealt.select("anchor", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "span", "lead", "n_starts", "bytes")
    dealt = dealt.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j", "span")
    resolved = stored(dealt.mapInArrow(_resolve_task(length), "anchor long, span long, runs array<int>"), "resolved")
    release(spark)

    whole = spans.where(F.col("n") > 1).select("anchor", "span", F.array(F.lit(0), F.col("n_starts")).alias("runs"))
    settled = whole.unionByName(resolved)
    parts = repeated.join(settled, ["anchor", "span"]).groupBy(F.col("doc_id").alias("its_id"), "text_hash").agg(F.collect_list(F.struct("start", "runs")).alias("found"))
    its_id, its_hash = unused(df, "its_id"), unused(df, "its_hash")
    parts = parts.select(F.col("its_id").alias(its_id), F.col("text_hash").alias(its_hash), F.col("found").alias(runs))
    same = (F.xxhash64(df["text"]) == F.col(its_hash)) & df["doc_id"].eqNullSafe(F.col(its_id))
    return df.join(parts, same, "left").drop(its_id, its_hash)
