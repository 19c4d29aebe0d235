"""Exact top-k search by inner product: a Voronoi kNN join.

The score of a query q and a vector x is q.x.  One more component makes it
a distance: with M the longest norm, x' = (x, sqrt(M^2 - x.x)) and
q' = (q, 0), |q' - x'|^2 = q.q + M^2 - 2 q.x, so the largest products are
the least distances and the triangle inequality holds.

Vectors and queries fall into the cells of a bounded set of pivots.  Per
cell of vectors the summary holds the count and the ``k`` least distances
to its pivot.  They bound how far a query's k-th neighbour can be:
theta(q) is the k-th least of |q p_j| + |p_j x| over the summaries.  A
vector x of cell j can only matter to q if | |q p_j| - |p_j x| | <= theta(q),
so a cell of queries keeps, per j, the least |q p_j| - theta(q) and the
largest |q p_j| + theta(q): a vector goes to a cell of queries only if its
distance lies between.

Cells of queries are packed to groups of a bounded number of queries (a
cell that holds more is dealt to several groups), and what is sent to a
group is dealt to blocks, so a task multiplies one bounded block of
queries with one bounded block of vectors, however many rows share a
vector or a cell.  Each block gives its ``k`` best per query; the best of
these are the result.  Where pivots tell nothing (random directions in
many dimensions) all blocks are solved, and the result is the same.

Defined results.  Vectors that are null or hold null, NaN or infinite
components take no part, neither as query nor as candidate.  A shorter
vector counts as followed by zeros; an empty one scores 0 with all.  A row
with a null id is never a query; as a candidate it comes last among equal
scores.  Rows that repeat an id are rows of their own: only the query's
own row is left out.  Equal scores go to the smaller id, equal ids in any
order (their rows look alike).  Scores are exact: products that doubles
may round are formed with whole numbers, and what no long holds is shown
as its end, though ranked by its true size.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import stored

#: Cells; their pairs (65,536 of them) are all that the driver ever holds.
PIVOTS = 256
#: Payload of a block of vectors and of a group of queries.
BLOCK_BYTES = 16 << 20
#: Scores held at once in a task.
SCORES = 1 << 22
SCALE = 256
EXACT = 2.0 ** 53
LONG = 2 ** 63
#: Bytes that hold any product of two vectors of doubles.
WIDE_BYTES = 288


def whole(x: Column) -> Column:
    """floor(256 x) as a double (a double of 2^53 or more is whole already)."""
    y = x.cast("double") * SCALE
    return F.when(F.abs(y) < 2.0 ** 53, F.floor(y).cast("double")).otherwise(y)


def usable(vector: Column) -> Column:
    """Neither null nor with a component that is null, NaN or infinite
    (or that is once it is scaled)."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) < F.lit(float("inf")), F.lit(False)) & ~F.coalesce(F.isnan(x), F.lit(True)))


def prepared(vectors: DataFrame, id_col: str, vector_col: str, every: int) -> DataFrame:
    """(row, id, asks, v): a number for each row that takes part, written once."""
    picked = vectors.where(usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col) % every == 0, F.lit(False)).alias("asks"), F.transform(vector_col, whole).alias("v"))
    return stored(picked.select(F.monotonically_increasing_id().alias("row"), "id", "asks", "v"), "vectors", "zstd")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` doubles, short lists padded by zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if len(flat) == len(column) * width:
        return flat.reshape(len(column), width)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Space:
    """Distances to the pivots in the space with one component more."""

    def __init__(self, pivots: np.ndarray, longest: float):
        self.longest = longest
        self.square = longest * longest
        self.points = np.column_stack([pivots, self.beyond(pivots)])
        self.norms = np.einsum("ab,ab->a", self.points, self.points)
        #: Distances are trusted up to this much.
        self.slack = 1e-5 * longest + 1e-6

    def beyond(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.square - np.einsum("ab,ab->a", x, x), 0.0))

    def distances(self, x: np.ndarray, query: bool) -> np.ndarray:
        more = np.zeros(len(x)) if query else self.beyond(x)
        own = np.einsum("ab,ab->a", x, x) + more * more
        products = x @ self.points[:, :-1].T + more[:, None] * self.points[:, -1]
        return np.sqrt(np.maximum(own[:, None] + self.norms - 2 * products, 0.0))


def choose_pivots(rows: DataFrame, width: int, longest: float, pivots: int) -> Space:
    """A bounded sample: the rows of least hash, one of each vector."""
    h = F.xxhash64("v")
    sample = rows.select(h.alias("h"), "v").groupBy("h").agg(F.first("v").alias("v")).orderBy("h").limit(pivots)
    table = sample.select("v").toArrow()
    return Space(matrix(table.column("v"), width), longest)


def cell_summaries(rows: DataFrame, space: Space, width: int, k: int) -> tuple[np.ndarray, list[list[float]]]:
    """Per cell of vectors: how many, and the ``k`` least distances."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, near = np.zeros(len(space.points), np.int64), [[] for _ in space.points]
        for batch in batches:
            if not batch.num_rows:
                continue
            d = space.distances(matrix(batch.column("v"), width), False)
            cell = d.argmin(1)
            least = d[np.arange(len(cell)), cell]
            count += np.bincount(cell, minlength=len(count))
            for c in np.unique(cell):
                near[c] = sorted([*near[c], *np.sort(least[cell == c])[:k].tolist()])[:k]
        held = [c for c in range(len(count)) if count[c]]
        yield pa.record_batch([pa.array(held, pa.int32()), pa.array([int(count[c]) for c in held], pa.int64()), pa.array([near[c] for c in held], pa.list_(pa.float64()))], names=["cell", "n", "near"])

    parts = rows.select("v").mapInArrow(run, "cell int, n long, near array<double>")
    nearest = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)        # k from each partition
    found = parts.groupBy("cell").agg(F.sum("n").alias("n"), nearest.alias("near")).collect()
    count, near = np.zeros(len(space.points), np.int64), [[] for _ in space.points]
    for r in found:
        count[r["cell"]], near[r["cell"]] = r["n"], list(r["near"])
    return count, near


def query_bounds(rows: DataFrame, space: Space, width: int, k: int, near: list[list[float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per cell of queries: how many, and per cell of vectors the least and
    the largest distance to its pivot that a needed vector can have."""
    n = len(space.points)
    seen = np.array([(j, d) for j in range(n) for d in near[j]]).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, low, high = np.zeros(n, np.int64), np.full((n, n), np.inf), np.full((n, n), -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            d = space.distances(matrix(batch.column("v"), width), True)
            ways = d[:, seen[:, 0].astype(int)] + seen[:, 1]
            theta = np.partition(ways, k - 1, axis=1)[:, k - 1] if ways.shape[1] >= k else np.full(len(d), np.inf)
            cell = d.argmin(1)
            count += np.bincount(cell, minlength=n)
            reach = (theta + space.slack)[:, None]
            np.minimum.at(low, cell, d - reach)
            np.maximum.at(high, cell, d + reach)
        held = np.flatnonzero(count)
        yield pa.record_batch([pa.array(held, pa.int32()), pa.array(count[held], pa.int64()), pa.array(list(low[held]), pa.list_(pa.float64())), pa.array(list(high[held]), pa.list_(pa.float64()))],
                              names=["cell", "n", "low", "high"])

    parts = rows.where("asks").select("v").mapInArrow(run, "cell int, n long, low array<double>, high array<double>")
    pairs = parts.select("cell", "n", F.posexplode(F.arrays_zip("low", "high")).alias("other", "b"))
    found = pairs.groupBy("cell", "other").agg(F.sum("n").alias("n"), F.min("b.low").alias("low"), F.max("b.high").alias("high")).collect()
    count, low, high = np.zeros(n, np.int64), np.full((n, n), np.inf), np.full((n, n), -np.inf)
    for r in found:
        count[r["cell"]], low[r["cell"], r["other"]], high[r["cell"], r["other"]] = r["n"], r["low"], r["high"]
    return count, low, high


def pack_cells(count: np.ndarray, space: Space, most: int) -> tuple[np.ndarray, list[int]]:
    """Cells of queries to groups of about ``most`` queries: a walk from
    cell to nearest cell left.  A cell of more is a group of its own that
    is dealt to parts.  Returns the group of each cell (-1: no queries) and
    the parts of each group."""
    group, parts = np.full(len(count), -1), []
    left = set(np.flatnonzero(count).tolist())
    at, held = None, 0
    while left:
        rest = sorted(left)
        at = rest[0] if at is None else rest[int(((space.points[rest] - space.points[at]) ** 2).sum(1).argmin())]
        left.remove(at)
        big = count[at] > most
        if big or not parts or parts[-1] > 1 or held + count[at] > most:
            parts.append(math.ceil(count[at] / most))
            held = 0
        group[at] = len(parts) - 1
        held += int(count[at])
    return group, parts


def best(queries: pa.Table, vectors: pa.Table, width: int, k: int) -> pa.Table:
    """The ``k`` best vectors of a block for each query of a group."""
    ids = vectors.column("id")
    missing = np.asarray(ids.is_null())
    number = ids.fill_null(0).to_numpy()
    order = np.lexsort((number, missing))           # columns by id, so that ties go to the left
    own = vectors.column("row").to_numpy()[order]
    x = matrix(vectors.column("v"), width)[order]
    q, asked = matrix(queries.column("v"), width), queries.column("row").to_numpy()
    biggest = max(1.0, width * float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)))
    wide = not biggest < EXACT
    if wide:
        x, q = (np.array([[int(c) for c in row] for row in m.tolist()], dtype=object).reshape(m.shape) for m in (x, q))
    places = {int(r): i for i, r in enumerate(own.tolist())}
    step = max(1, SCORES // max(1, len(x)))
    asked_out, place_out, score_out, beyond = [], [], [], []
    for begin in range(0, len(q), step):
        scores = q[begin:begin + step] @ x.T
        for i, line in enumerate(scores):
            self_at = places.get(int(asked[begin + i]))
            want = k if self_at is None else k + 1
            if wide:
                top = sorted(range(len(line)), key=lambda c, line=line: (-line[c], c))[:want]
            elif want >= len(line):
                top = np.argsort(-line, kind="stable")
            else:
                edge = np.partition(line, len(line) - want)[len(line) - want]
                above = np.flatnonzero(line > edge)
                top = np.concatenate([above[np.argsort(-line[above], kind="stable")], np.flatnonzero(line == edge)[:want - len(above)]])
            top = [int(c) for c in top if c != self_at][:k]
            asked_out += [asked[begin + i]] * len(top)
            place_out += top
            for s in (int(line[c]) for c in top):
                score_out.append(max(-LONG, min(LONG - 1, s)))
                beyond.append(None if score_out[-1] == s else (s + (1 << 8 * WIDE_BYTES - 1)).to_bytes(WIDE_BYTES, "big"))
    taken = ids.take(pa.array(order[place_out], pa.int64())) if place_out else pa.array([], pa.int64())
    taken = taken.combine_chunks() if isinstance(taken, pa.ChunkedArray) else taken
    return pa.table({"row": pa.array(asked_out, pa.int64()), "vec_id": taken.cast(pa.int64()), "score": pa.array(score_out, pa.int64()), "beyond": pa.array(beyond, pa.binary())})


def knn_join(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5, pivots: int = PIVOTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of every
    row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = prepared(vectors, id_col, vector_col, every)
    size = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    width, longest = rows.agg(F.max(F.size("v")), F.max(F.sqrt(size))).first()
    width, longest = max(width or 0, 1), longest or 0.0
    if longest < math.sqrt(sys.float_info.max) / 4:
        space = choose_pivots(rows, width, longest, pivots)
    else:                                           # squares overflow: one cell, no bounds
        space = Space(np.zeros((1, width)), 0.0)
        space.slack = math.inf
    if not len(space.points):
        space = Space(np.zeros((1, width)), longest)
    count, near = cell_summaries(rows, space, width, k + 1)      # one may be the query's own row
    asking, low, high = query_bounds(rows, space, width, k + 1, near)
    bound = max(64, block_bytes // (8 * width))
    group, parts = pack_cells(asking, space, bound)
    wanted = [np.flatnonzero(group == g) for g in range(len(parts))]
    reached = [(low[cells] <= high[cells]).any(0) for cells in wanted]
    blocks = [max(1, math.ceil(int(count[r].sum()) / bound)) for r in reached]

    def send_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = space.distances(matrix(batch.column("v"), width), False)
            cell = d.argmin(1)
            least = d[np.arange(len(cell)), cell]
            for g, cells in enumerate(wanted):
                needed = ((low[cells][:, cell] <= least) & (least <= high[cells][:, cell])).any(0) if math.isfinite(space.slack) else np.ones(len(cell), bool)
                if needed.any():
                    picked = batch.select(["row", "id", "v"]).filter(pa.array(needed))
                    yield pa.record_batch([*picked.columns, pa.array([g] * picked.num_rows, pa.int32())], names=["row", "id", "v", "g"])

    def send_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                g = group[space.distances(matrix(batch.column("v"), width), True).argmin(1)]
                yield pa.record_batch([*batch.select(["row", "v"]).columns, pa.array(g, pa.int32())], names=["row", "v", "g"])

    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    of_group = spark.createDataFrame([(g, parts[g], blocks[g]) for g in range(len(parts))], "g int, parts int, blocks int")     # a row for PIVOTS cells at most
    sent = rows.select("row", "id", "v").mapInArrow(send_vectors, "row long, id long, v array<double>, g int").join(F.broadcast(of_group), "g")
    dealt = sent.select("row", "id", "v", "g", F.pmod(F.xxhash64("row"), "blocks").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    asked = rows.where("asks").select("row", "v").mapInArrow(send_queries, "row long, v array<double>, g int").join(F.broadcast(of_group), "g")
    asked = asked.select("row", "v", "g", F.pmod(F.xxhash64(F.lit(1), "row"), "parts").cast("int").alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"))
    key = ["g", "part", "block"]

    def solve(queries: pa.Table, data: pa.Table) -> pa.Table:
        return best(queries, data, width, k)

    found = asked.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(solve, "row long, vec_id long, score long, beyond binary")
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), F.desc("beyond"), F.asc_nulls_last("vec_id")))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= k)
    ids = rows.where("asks").select("row", F.col("id").alias("query_id"))
    return ranked.join(ids, "row").select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5"""
