"""Near-duplicates by HyperMinHash, confirmed on full shingle sets.

Every text becomes the set of its distinct word shingles, as 64-bit
hashes.  Texts with equal sets are one class, so copies cost nothing
beyond their rows.  A class's sketch has one 16-bit register per hash
bucket: the leading zeros of the bucket's least hash and the mantissa
bits after them.  Bands of four registers put classes into buckets; two
classes at the threshold miss each other in all 32 bands with a chance of
about 5e-8.  Inside a bucket, a search from one class to the next links
those that the registers, corrected for agreement by chance, do not rule
out: a pair at the threshold agrees in as few with a chance of at most
1e-9 (``MISS``, an exact binomial tail).  The linked classes form
clusters, and all true links that met lie inside one.  Only for the
classes of clusters are full sets worked out again; the same search on
the exact sets inside a cluster gives links that hold a class's whole
component together; there a bound on the intersection, which loses
nothing, goes before the comparison.  Neither search emits pairs: each
class is reached once, so a task gives at most one link per class, and
contracts its links to one per class before it writes them.

Buckets and clusters beyond a task's size are dealt to chunks, and every
pair of chunks meets in a task of its own, so no task holds a whole hot
bucket and no pair goes untested.

Null and empty texts have no shingles and are alone.  Repeated rows and
equal texts share a class; a component's id is its least doc_id (null when
all are null), and a row is kept if that is its doc_id.  Extra columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import batches_out, only_memo, stored
from quarry.operators.graph import Graph, connected_components

REGISTERS = 128
MANTISSA = 10
EMPTY = 0xFFFF
BAND = 4
CHUNK = 1024                # classes of a bucket or cluster in a task, twice
CHUNK_BYTES = 8 << 20       # of their sets
MISS = 1e-9                 # chance that the registers rule out a pair at the threshold
CELLS = 512                 # hash ranges in which sets are counted for a bound
ONE_TASK = 1 << 20          # contracted links that one task labels (16 MB)

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Sets of 64-bit shingle hashes; hashes of words met before are kept."""

    def __init__(self, max_words: int = 500_000):
        self.max_words, self.known = max_words, {}

    def hashes(self, data: bytes) -> np.ndarray:
        words = data.lower().split()      # of bytes: A-Z and ASCII white space only
        if len(self.known) > self.max_words:
            self.known = {}
        known = self.known
        for w in [w for w in words if w not in known]:
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def shingles(self, data: bytes, size: int = 2) -> np.ndarray:
        """Sorted distinct hashes of ``size`` words in a row; of all words
        if they are fewer; none without words."""
        h = self.hashes(data)
        if not len(h):
            return h
        size = min(size, len(h))
        s = np.full(len(h) - size + 1, size, np.uint64)
        for i in range(size):
            s = mix(s * np.uint64(31) + h[i:len(h) - size + 1 + i])
        return np.unique(s)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One register per bucket: leading zeros and mantissa bits of its least hash."""
    out = np.full(REGISTERS, EMPTY, np.uint16)
    if len(shingles):
        bits = REGISTERS.bit_length() - 1
        g = np.sort(mix(shingles + np.uint64(0x9E3779B97F4A7C15)))
        bucket = (g >> np.uint64(64 - bits)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        rest = (g[first] << np.uint64(bits)) >> np.uint64(bits)          # 64 - bits bits
        exponent = np.frexp(np.maximum(rest, np.uint64(1)).astype(np.float64))[1]      # its bit length, but for rounding
        top = rest >> (np.maximum(exponent - 1, 0).astype(np.uint64))
        exponent = np.where(top == 0, exponent - 1, exponent)             # the float was rounded up to a power of two
        zeros = (64 - bits) - exponent
        shift = exponent - 1 - MANTISSA
        mantissa = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64), rest << np.maximum(-shift, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
        out[bucket[first]] = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    return out


# ------------------------------------------------------------------ estimation

@lru_cache(maxsize=4096)
def chance(log_n: int, log_m: int) -> float:
    """Chance that a register of two unrelated sets of 2^(n/2) and 2^(m/2)
    hashes agrees: over all cells, the product of their chances to hold
    the bucket's least hash."""
    edges = []
    for zeros in range(0, 40):
        width = 2.0 ** -(zeros + 1)
        edges.append(width + width * np.arange(1 << MANTISSA) / (1 << MANTISSA))
    low = np.sort(np.concatenate(edges))
    high = np.r_[low[1:], 1.0]
    total = 1.0
    cells = []
    for log in (log_n, log_m):
        rate = 2.0 ** (log / 2) / REGISTERS
        cells.append((np.exp(-rate * low) - np.exp(-rate * high)) / -np.expm1(-rate))
    return float(total * (cells[0] * cells[1]).sum())


def agreement(registers: np.ndarray, sizes: np.ndarray, i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(registers that agree, registers in use, chance that one agrees
    though the sets are unrelated) of class i with others."""
    a, b = registers[i], registers[others]
    held = (a != EMPTY) | (b != EMPTY)
    logs = np.maximum(0, np.rint(2 * np.log2(sizes[others]))).astype(int)
    mine = max(0, round(2 * float(np.log2(sizes[i]))))
    by_log = {x: chance(min(mine, x), max(mine, x)) for x in set(logs.tolist())}
    return ((a == b) & held).sum(1), held.sum(1), np.array([by_log[x] for x in logs.tolist()])


def estimate(registers: np.ndarray, sizes: np.ndarray, i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimate, registers it stands on) of class i with others."""
    agree, n, lucky = agreement(registers, sizes, i, others)
    return (agree / n - lucky) / (1 - lucky), n


@lru_cache(maxsize=4096)
def cuts(percent: int, lucky: float) -> np.ndarray:
    """By registers in use: the most that may be asked to agree so that a
    pair at the threshold fails with a chance of ``MISS`` at most."""
    p = percent / 100 + (1 - percent / 100) * lucky
    out = np.zeros(REGISTERS + 1, np.int64)
    for n in range(1, REGISTERS + 1):
        below = np.cumsum([math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(n + 1)])
        out[n] = np.searchsorted(below, MISS, side="right")
    return out


def sizes_allow(sizes: np.ndarray, i: int, others: np.ndarray, percent: int) -> np.ndarray:
    low, high = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
    return others[100 * low >= percent * high]


def plausible(registers, sizes, i, others, percent: int) -> np.ndarray:
    """Those of ``others`` that sizes and registers do not rule out."""
    others = sizes_allow(sizes, i, others, percent)
    if not len(others):
        return others
    agree, n, lucky = agreement(registers, sizes, i, others)
    least = np.empty(len(others), np.int64)
    for x in set(lucky.tolist()):
        at = lucky == x
        least[at] = cuts(percent, x)[n[at]]
    return others[agree >= least]


def counted(shingles: np.ndarray) -> np.ndarray:
    """How many of a set's hashes lie in each of ``CELLS`` ranges."""
    return np.bincount((shingles >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64), minlength=CELLS).astype(np.int32)


def possible(counts, sizes, i, others, percent: int) -> np.ndarray:
    """Those of ``others`` whose set can be linked with set i: two sets share
    no more of a range than the smaller count.  Rules out no true link."""
    others = sizes_allow(sizes, i, others, percent)
    most = np.minimum(counts[i], counts[others]).sum(1, dtype=np.int64)
    return others[100 * most >= percent * (sizes[i] + sizes[others] - most)]


def exact(sets: list[np.ndarray], i: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Those of ``others`` whose set is linked with set i."""
    if not len(others):
        return others
    mine, length = sets[i], np.array([len(sets[o]) for o in others])
    found = np.concatenate([sets[o] for o in others])
    at = np.minimum(np.searchsorted(mine, found), len(mine) - 1)
    both = np.add.reduceat((mine[at] == found).astype(np.int64), np.r_[0, np.cumsum(length)[:-1]])
    return others[100 * both >= percent * (len(mine) + length - both)]


def forest(n: int, linked) -> list[tuple[int, int]]:
    """Links that connect what ``linked(i, others)`` connects: from one
    member to the next, each looks at those not reached so far only."""
    left = np.arange(1, n)
    queue, out = [0], []
    while True:
        while queue and len(left):
            i = queue.pop()
            new = linked(i, left)
            if len(new):
                out += [(i, int(x)) for x in new]
                queue += new.tolist()
                left = left[~np.isin(left, new, assume_unique=True)]
        if len(left) < 2:
            return out
        queue, left = [int(left[0])], left[1:]


# ---------------------------------------------------------------------- tasks

def _sketch_task(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("set_key", pa.binary()), ("n_shingles", pa.int64()), ("registers", pa.binary())])

    def run(batches):
        shingler = _shingler()

        def rows():
            for batch in batches:
                for doc_id, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    s = shingler.shingles(_bytes(text), size)
                    if len(s):
                        yield doc_id, text_hash, xxhash.xxh3_128_digest(s.tobytes()), len(s), sketch(s).tobytes()
                    else:
                        yield doc_id, text_hash, b"", 0, b""

        yield from batches_out(schema, rows(), lambda r: 300)

    return run


def _set_task(size: int):
    schema = pa.schema([("cid", pa.int64()), ("shingles", pa.binary())])

    def run(batches):
        shingler = _shingler()

        def rows():
            for batch in batches:
                for cid, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    s = shingler.shingles(_bytes(text), size).tobytes()
                    if xxhash.xxh3_128_digest(s) == key:
                        yield cid, s

        yield from batches_out(schema, rows(), lambda r: len(r[1]))

    return run


def _bytes(text: pa.StringScalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _shingler() -> Shingler:
    return only_memo(Shingler)


def _band_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, cid) of every band that is not empty."""
    for batch in batches:
        for start in range(0, batch.num_rows, 20_000):
            part = batch.slice(start, 20_000)
            if not part.num_rows:
                continue
            cid = part.column(0).to_numpy()
            r = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(len(cid), -1, BAND)
            packed = np.ascontiguousarray(r).view(np.uint64)[:, :, 0]
            band = np.arange(packed.shape[1], dtype=np.uint64)
            bucket = mix(packed ^ mix(band + np.uint64(1))[None, :])
            row, col = np.nonzero(packed != np.uint64(0xFFFFFFFFFFFFFFFF))
            yield pa.record_batch([pa.array(bucket[row, col].view(np.int64)), pa.array(cid[row])], names=["bucket", "cid"])


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows of each run of equal leading ``keys`` columns, without these."""
    held, now = [], None
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:keys] != now:
                if held:
                    yield held
                held, now = [], row[:keys]
            held.append(row[keys:])
    if held:
        yield held


EDGE = pa.schema([("src", pa.int64()), ("dst", pa.int64())])
EDGES = "src long, dst long"


def least_reached(edges: Iterable[tuple[int, int]]) -> dict[int, int]:
    """Of every end of an edge, the least one that it reaches."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        root = up.setdefault(x, x)
        while up[root] != root:
            root = up[root]
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    for a, b in edges:
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up}


def _pairs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    return zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)


def _contract_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars, one edge per vertex that is not a centre;
    begun anew after ``ONE_TASK`` vertices."""
    def rows():
        held: dict[int, int] = {}
        for batch in batches:
            held = least_reached(itertools.chain(held.items(), _pairs(batch)))
            if len(held) > ONE_TASK:
                yield from ((root, x) for x, root in held.items() if x != root)
                held = {}
        yield from ((root, x) for x, root in held.items() if x != root)

    yield from batches_out(EDGE, rows(), lambda r: 0)


def _label_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, component) from all edges there are: ``ONE_TASK`` at most."""
    found = least_reached(pair for batch in batches for pair in _pairs(batch))
    yield from batches_out(pa.schema([("cid", pa.int64()), ("component", pa.int64())]), found.items(), lambda r: 0)


def _cluster_task(percent: int):
    def run(batches):
        def rows():
            for group in _groups(batches, 3):
                if len(group) > 1:
                    cid = [g[0] for g in group]
                    sizes = np.array([g[1] for g in group], np.int64)
                    registers = np.frombuffer(b"".join(g[2] for g in group), np.uint16).reshape(len(group), -1)
                    for a, b in forest(len(group), lambda i, o, r=registers, s=sizes: plausible(r, s, i, o, percent)):
                        yield cid[a], cid[b]

        yield from batches_out(EDGE, rows(), lambda r: 0)

    return run


def _link_task(percent: int):
    def run(batches):
        def rows():
            for group in _groups(batches, 3):
                if len(group) > 1:
                    cid = [g[0] for g in group]
                    sets = [np.frombuffer(g[1], np.uint64) for g in group]
                    sizes = np.array([len(s) for s in sets], np.int64)
                    counts = np.array([counted(s) for s in sets])
                    for a, b in forest(len(group), lambda i, o, c=counts, n=sizes, x=sets: exact(x, i, possible(c, n, i, o, percent), percent)):
                        yield cid[a], cid[b]

        yield from batches_out(EDGE, rows(), lambda r: 0)

    return run


# ------------------------------------------------------------------- operator

def _dealt(rows: DataFrame, key: str, chunks) -> DataFrame:
    """``rows`` (with their group's number of ``chunks``) under (key, i, j):
    once for every chunk that theirs has to meet."""
    mine = F.pmod(F.xxhash64("cid"), F.col("chunks"))
    spread = rows.withColumn("chunks", chunks).withColumn("mine", mine)
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    spread = spread.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
    return spread.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "cid")


def components(df: DataFrame, percent: int = 80, size: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.  Two
    are linked if their sets' Jaccard similarity is ``percent`` / 100 or more."""
    read = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    sketched = stored(read.mapInArrow(_sketch_task(size), "doc_id long, text_hash long, set_key binary, n_shingles long, registers binary"), "sketches")
    filled = sketched.where(F.col("n_shingles") > 0)
    classes = stored(
        filled.groupBy("set_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")).alias("one"),
                                      F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
        .select(F.monotonically_increasing_id().alias("cid"), "set_key", F.col("one.doc_id").alias("doc_id"), F.col("one.text_hash").alias("text_hash"), "n_shingles", "registers"), "classes")

    banded = classes.select("cid", "registers").mapInArrow(_band_task, "bucket long, cid long")
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    members = banded.join(shared, "bucket").join(classes.select("cid", "n_shingles", "registers"), "cid")
    dealt = _dealt(members.select("bucket", "cid", "n_shingles", "registers", "n"), "bucket", F.ceil(F.col("n") / CHUNK))
    near = dealt.select("bucket", "i", "j", "cid", "n_shingles", "registers").mapInArrow(_cluster_task(percent), EDGES)
    clusters = _components(near)

    wanted = clusters.join(classes.select("cid", "set_key", "doc_id", "text_hash"), "cid")
    texts = read.join(wanted.select("cid", "set_key", F.col("doc_id").alias("its_id"), "text_hash"), "text_hash").where(F.col("doc_id").eqNullSafe(F.col("its_id")))
    sets = texts.select("cid", "set_key", "text").mapInArrow(_set_task(size), "cid long, shingles binary").dropDuplicates(["cid"])
    sets = stored(sets, "sets")
    held = sets.join(clusters, "cid")
    weights = clusters.join(classes.select("cid", "n_shingles"), "cid").groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum(8 * F.col("n_shingles")).alias("bytes"))
    chunks = F.ceil(F.greatest(F.col("n") / CHUNK, F.col("bytes") / CHUNK_BYTES))
    dealt = _dealt(held.join(weights, "component"), "component", chunks)
    links = dealt.select("component", "i", "j", "cid", "shingles").mapInArrow(_link_task(percent), EDGES)
    linked = _components(links)

    least = linked.join(classes.select("cid", "doc_id"), "cid").groupBy("component").agg(F.min("doc_id").alias("least"))
    of_class = classes.select("cid", "set_key", F.col("doc_id").alias("own")).join(linked.join(least, "component").select("cid", "least"), "cid", "left")
    of_class = of_class.select("set_key", F.coalesce("least", "own").alias("least"))
    joined = sketched.select("doc_id", "set_key", "n_shingles").join(of_class, "set_key", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """cid and component of the classes that have an edge.  Tasks contract
    their own edges to stars; if what is left is no more than a task may
    hold, one labels it, otherwise star rounds over all tasks do."""
    stars = stored(edges.mapInArrow(_contract_task, EDGES), "stars")
    if stars.count() <= one_task:
        return stored(stars.coalesce(1).mapInArrow(_label_task, "cid long, component long"), "components")
    vertices = stars.select(F.col("src").alias("id")).union(stars.select(F.col("dst").alias("id"))).distinct()
    found = connected_components(Graph(vertices, stars))
    return stored(found.select(F.col("id").alias("cid"), "component"), "components")


#: The same over ``documents`` in DuckDB: all pairs that share a shingle, then what each reaches.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT b.y, r.c FROM reach r JOIN both_ways b ON b.x = r.doc_id),
least AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)"""
