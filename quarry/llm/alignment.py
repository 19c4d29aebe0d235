"""Alignment of two tokenizers' tokens by the bytes they cover.

Tokenizer A reads a space and the text, tokenizer B the text (it puts the
space itself).  Both are incidence matrices of tokens and bytes in
compressed rows (CSR), built by hand here: row i of A holds the bytes of
token i.  The product A.B^T, formed row by row as Gustavson does, has an
entry wherever a token of A and one of B overlap (the bytes they share):
the links.  Byte offsets at which tokens of both end cut them into groups;
incidence matrices of groups and tokens have as product the links of
tokens that share a group.

A space between two characters that are not white space is a place at
which both tokenizers always begin a token, so a text is a chain of
chunks, and a chunk's tokens, links and groups are the same wherever it
stands.  Chunks are aligned once, many at a time as one block-diagonal
matrix, and kept in a bounded memo, which only saves time.

Corpus-wide counts of linked id pairs: each task adds up its own, the sums
are shuffled by pair.  The most frequent pairs (a bounded number) are
broadcast to score the documents, all others are joined by shuffle.

Defined results.  Texts that are null or empty, and texts that either
tokenizer's bytes do not give back, have no tokens: zeros and an empty
string.  Special tokens' strings are plain text.  Rows that repeat or lack
a doc_id are documents of their own.  Ties for an id's highest count are
all highest.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import batches_out, stored
from quarry.llm.tokens import byte_letters

#: Bytes of a generation of the memo (two), and what an entry takes besides its strings.
MEMO_BYTES = 96 << 20
ENTRY = 320
#: Texts aligned together, in characters.
TOGETHER = 2 << 20
#: Pairs that a task adds up before it hands their sums on.
SUMMED = 400_000
#: Pairs broadcast at most (16 bytes each).
FREQUENT = 1 << 18
SHIFT = 32

CHUNK = re.compile(r"(?<=\S)(?= \S)")
ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups string, "
           "pairs array<long>, times array<long>")


# ----------------------------------------------------------------- matrices

def by_rows(sizes: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 0/1 matrix: row i holds the next ``sizes[i]`` of ``columns``."""
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), columns


def transposed(matrix: tuple[np.ndarray, np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    starts, columns = matrix
    rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return by_rows(np.bincount(columns, minlength=width), rows[np.argsort(columns, kind="stable")])


def product_sizes(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Terms that each row of the product adds up (its entries, if no two
    terms meet in one)."""
    before = np.concatenate([[0], np.cumsum(np.diff(b[0])[a[1]])])
    return before[a[0][1:]] - before[a[0][:-1]]


def row_products(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A.B in CSR (starts, columns, values): for each row of A the rows of
    B that it names, terms of one column added up."""
    (a_at, a_col), (b_at, b_col) = a, b
    sizes = np.diff(b_at)[a_col]
    rows = np.repeat(np.repeat(np.arange(len(a_at) - 1), np.diff(a_at)), sizes)
    first = np.cumsum(sizes) - sizes
    columns = b_col[np.repeat(b_at[a_col] - first, sizes) + np.arange(int(sizes.sum()))]
    if len(columns) and ((np.diff(rows) == 0) & (np.diff(columns) < 0)).any():
        order = np.lexsort((columns, rows))
        rows, columns = rows[order], columns[order]
    new = np.ones(len(rows), bool)
    new[1:] = (np.diff(rows) != 0) | (np.diff(columns) != 0)
    at = np.flatnonzero(new)
    values = np.diff(np.append(at, len(rows)))
    starts = np.concatenate([[0], np.cumsum(np.bincount(rows[at], minlength=len(a_at) - 1))])
    return starts, columns[at], values


class Aligned:
    """Tokens of one stretch of bytes: ``a`` and ``b`` are the byte lengths
    of its tokens, which add up to the same."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.ends_a, self.ends_b = np.cumsum(a), np.cumsum(b)
        n = int(self.ends_a[-1]) if len(a) else 0
        every_byte = np.arange(n)
        self.bytes_a, self.bytes_b = by_rows(a, every_byte), by_rows(b, every_byte)
        cuts = np.intersect1d(self.ends_a, self.ends_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(cuts, self.ends_a), np.searchsorted(cuts, self.ends_b)
        self.groups_a = by_rows(np.bincount(self.group_a, minlength=len(cuts)), np.arange(len(a)))
        self.groups_b = by_rows(np.bincount(self.group_b, minlength=len(cuts)), np.arange(len(b)))
        self.cuts = cuts

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A.B^T: the tokens of B that each token of A overlaps, with the bytes shared."""
        return row_products(self.bytes_a, transposed(self.bytes_b, len(self.bytes_b[1])))

    def shared(self, rows: slice = slice(None)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links of tokens that share a group, for some tokens of A (their
        number can grow with the square of a group: see ``shared_sizes``)."""
        tokens = np.arange(len(self.group_a))[rows]
        return row_products(by_rows(np.ones(len(tokens), np.int64), self.group_a[tokens]), self.groups_b)

    def shared_sizes(self) -> np.ndarray:
        """Tokens of B in the group of each token of A."""
        return product_sizes(transposed(self.groups_a, len(self.group_a)), self.groups_b)


# ---------------------------------------------------------------- tokenizers

class Pair:
    """Both tokenizers in one worker, with the chunks aligned so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        letters = {chr(c): b for b, c in byte_letters().items()} | {chr(c): c for c in range(256) if c not in byte_letters()}
        entries = self.a.get_vocab(with_added_tokens=True)
        # an added token's string need not be written in byte letters; it never occurs as a token
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = ([np.array([f"{i}{s}" for i in range(len(t))], object) for s in marks] for t, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;")))
        self.now, self.older = Memo(), Memo()

    def align(self, chunks: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Of chunks (which begin with the space that B puts): n_a, n_b,
        n_groups, n_links, n_shared of each (n_a of -1 and nothing else
        where the bytes do not come back), its groups, and all linked pairs
        one after the other."""
        a_ids = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        b_ids = self.b.encode([c[1:] for c in chunks], num_threads=1)
        raw = [c.encode() for c in chunks]
        sound = self._sound(raw, a_ids, b_ids)
        if not all(sound):
            a_ids, b_ids = ([x if ok else [] for x, ok in zip(ids, sound, strict=True)] for ids in (a_ids, b_ids))
        a_n, b_n = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a_ids, b_ids))
        both = Aligned(self.a_size[a], self.b_size[b])
        starts, columns, _ = both.links()
        shared = np.concatenate([[0], np.cumsum(both.shared_sizes())])
        linked = (np.repeat(a, np.diff(starts)) << SHIFT) | b[columns]
        # a group is written as its tokens of A, then its tokens of B
        written = np.empty(len(a) + len(b), object)
        place_a = np.arange(len(a)) + both.groups_b[0][both.group_a]
        place_b = np.arange(len(b)) + both.groups_a[0][both.group_b + 1]
        for place, text, ids, group in ((place_a, self.a_text, a, both.group_a), (place_b, self.b_text, b, both.group_b)):
            last = np.append(group[1:] != group[:-1], True)[:len(group)]
            written[place] = np.where(last, text[1][ids], text[0][ids])
        written = written.tolist()
        a_at, b_at = (np.concatenate([[0], np.cumsum(n)]) for n in (a_n, b_n))
        group_at = np.append(both.group_a, len(both.cuts))[a_at]
        stats = np.column_stack([a_n, b_n, np.diff(group_at), np.diff(starts[a_at]), np.diff(shared[a_at])])
        stats[~np.array(sound), 0] = -1
        ends = (a_at + b_at).tolist()
        return stats, ["".join(written[x:y])[:-1] for x, y in zip(ends, ends[1:], strict=False)], linked

    def _sound(self, raw: list[bytes], a_ids: list[list[int]], b_ids: list[list[int]]) -> list[bool]:
        """Which chunks both tokenizers' bytes give back."""
        good = [True] * len(raw)
        for table, sizes, ids in ((self.a_bytes, self.a_size, a_ids), (self.b_bytes, self.b_size, b_ids)):
            given = b"".join(map(table.__getitem__, chain.from_iterable(ids)))
            lengths = np.concatenate([[0], np.cumsum(sizes[np.fromiter(chain.from_iterable(ids), np.int64)])])[np.cumsum([len(x) for x in ids])]
            if given != b"".join(raw) or (lengths != np.cumsum([len(r) for r in raw])).any():
                good = [g and r == b"".join(map(table.__getitem__, x)) for g, r, x in zip(good, raw, ids, strict=True)]
        return good

    def _learn(self, chunks: Iterator[str]) -> None:
        if self.now.weight > MEMO_BYTES:
            self.older, self.now = self.now, Memo()
        index, older = self.now.index, self.older.index
        new = [c for c in dict.fromkeys(chunks) if c not in index]
        again = [c for c in new if c in older]
        if again:
            self.now.add(again, *self.older.take(again))
        new = [c for c in new if c not in older]
        while new:
            size, n = 0, 0
            while n < len(new) and size < TOGETHER:
                size += len(new[n])
                n += 1
            self.now.add(new[:n], *self.align(new[:n]))
            new = new[n:]

    def documents(self, texts: list[str | None]) -> Iterator[tuple]:
        """Per text the sums over its chunks, the groups and the pairs."""
        chains = [CHUNK.split(" " + t) if t else [] for t in texts]
        self._learn(chain.from_iterable(chains))
        for text, cs in zip(texts, chains, strict=True):
            stats, groups, linked = self.now.take(cs)
            if len(stats) and stats[:, 0].min() < 0:        # judged as a whole: what one chunk lacks, another may have
                stats, groups, linked = self.align([" " + text])
                stats = np.maximum(stats, 0)
            yield *stats.sum(0).tolist(), ";".join(groups), linked


class Memo:
    """Aligned chunks: their numbers, groups and pairs by position."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.stats, self.starts, self.groups = np.zeros((1024, 5), np.int64), np.zeros(1024, np.int64), []
        self.pairs, self.used, self.weight = np.zeros(4096, np.int64), 0, 0

    def add(self, chunks: list[str], stats: np.ndarray, groups: list[str], pairs: np.ndarray) -> None:
        n, end = len(self.groups), self.used + len(pairs)
        while len(self.stats) < n + len(chunks):
            self.stats, self.starts = np.concatenate([self.stats, self.stats]), np.concatenate([self.starts, self.starts])
        while len(self.pairs) < end:
            self.pairs = np.concatenate([self.pairs, self.pairs])
        self.index.update(zip(chunks, range(n, n + len(chunks)), strict=True))
        self.stats[n:n + len(chunks)] = stats
        self.starts[n:n + len(chunks)] = self.used + np.cumsum(stats[:, 3]) - stats[:, 3]
        self.pairs[self.used:end] = pairs
        self.groups += groups
        self.used = end
        self.weight += 8 * len(pairs) + sum(map(len, groups)) + sum(map(len, chunks)) + ENTRY * len(chunks)

    def take(self, chunks: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        at = list(map(self.index.__getitem__, chunks))
        where = np.array(at, np.int64)
        stats = self.stats[where]
        sizes = stats[:, 3]
        places = np.repeat(self.starts[where] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return stats, list(map(self.groups.__getitem__, at)), self.pairs[places]


@lru_cache(maxsize=2)
def tokenizer_pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def _merged(sums: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, where = np.unique(np.concatenate([p for p, _ in sums]), return_inverse=True)
    return pairs, np.bincount(where, weights=np.concatenate([t for _, t in sums]), minlength=len(pairs)).astype(np.int64)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row per document: numbers of tokens, groups, links and links
    inside groups, the groups as text, and its distinct linked id pairs
    (a << 32 | b) with how often.  Rows without a ``row`` are sums of pairs
    over several documents."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_shared")],
                        ("groups", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        both, sums, held = tokenizer_pair(a_path, b_path), [], 0
        for batch in batches:
            keys = zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), strict=True)
            texts = iter(batch.column("text"))
            while some := _some(texts):
                for key, (*n, groups, linked) in zip(islice(keys, len(some)), both.documents(some), strict=True):
                    pairs, times = np.unique(linked, return_counts=True)
                    sums.append((pairs, times))
                    held += len(pairs)
                    yield *key, *n, groups, pairs, times
                if held > SUMMED:
                    sums = [_merged(sums)]
                    held = len(sums[0][0])
                    if 2 * held > SUMMED:
                        yield None, None, *[None] * 6, *sums[0]
                        sums, held = [], 0
        if sums:
            yield None, None, *[None] * 6, *_merged(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_out(schema, rows(batches), lambda r: len(r[7] or "") + 16 * len(r[8]))

    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, ALIGNED)


def _some(texts: Iterator) -> list:
    out, size = [], 0
    for t in texts:
        t = t.as_py()
        out.append(t)
        size += len(t or "")
        if size >= TOGETHER:
            break
    return out


# -------------------------------------------------------------------- counts

def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many links corpus-wide hold each id pair, and
    whether that is the highest of its B id."""
    each = aligned.where("row IS NULL").select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND((1 << SHIFT) - 1))
    highest = counts.groupBy("b").agg(F.max("n").alias("top"))
    return counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def scored(aligned: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``aligned`` documents (written before) with n_best and count_sum;
    ``counts`` as by ``pair_counts`` (written, too)."""
    scale = F.floor(F.log2("n")).cast("int").alias("e")
    least, room = 64, frequent
    for r in sorted(counts.groupBy(scale).agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):      # a row per power of two
        room -= r["k"]
        if room < 0:
            break
        least = r["e"]
    is_frequent = F.floor(F.log2("n")) >= least
    docs = aligned.where("row IS NOT NULL")
    each = docs.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    often = F.broadcast(counts.where(is_frequent))          # FREQUENT rows at most
    near, rest = each.join(often, "pair"), each.join(often, "pair", "left_anti").join(counts.where(~is_frequent), "pair")
    sums = [F.sum(F.col("times") * F.col("n")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best")]
    per_row = near.groupBy("row").agg(*sums).union(rest.groupBy("row").agg(*sums)).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    none = F.lit(0).cast("long")
    return docs.drop("pairs", "times").join(per_row, "row", "left").withColumns({n: F.coalesce(F.col(n), none) for n in ("n_best", "count_sum")})


def alignment(docs: DataFrame, a_path: str, b_path: str, frequent: int = FREQUENT, keep_groups: bool = True) -> DataFrame:
    """The whole: documents aligned, pairs counted, documents scored.
    Without ``keep_groups`` the groups (longer than the text) are kept as
    their SHA-256 only (empty: as they are)."""
    found = align(docs, a_path, b_path)
    if not keep_groups:
        found = found.withColumn("groups", F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise(F.col("groups")))
    found = stored(found, "aligned", "zstd")
    return scored(found, stored(pair_counts(found), "pair-counts", "zstd"), frequent)
