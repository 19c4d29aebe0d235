"""Byte-level BPE as a lazily determinised finite-state transducer.

Encoding.  A sequence of tokens is the BPE encoding of its bytes exactly
when every adjacent pair of tokens is stable: encoding the bytes of the
pair gives the pair back.  So the encoding of every prefix of a string
ends in one token, and that token is the only one, among all vocabulary
entries that end there, which is stable after the last token of the
prefix before it.  A state of the transducer holds what later bytes can
still change: the open positions, each with its node in the vocabulary
trie and the last token of the prefix before it.  States are numbered and
transitions are worked out when they are first met, then kept in a table.
A position is open only while the bytes since are the start of some
vocabulary entry, so the lookahead is bounded by the longest entry.  Each
step names the token that ends the prefix so far; tokens are emitted as
soon as one position only is open, or, after a few times the longest
entry, up to the place where the walks back from all open ones meet.

Whether a pair is stable is read off the merges: the symbols next to the
border grow along the right edge of the first token and the left edge of
the second, in the order of rank; the pair is unstable when at some time
a merge across the border ranks below the next merge on either side.

Decoding streams ids through a UTF-8 state machine: it holds the bytes of
an unfinished character between tokens and puts U+FFFD for bytes that
cannot begin or continue one.

Nulls count as empty texts (no ids); ids of an empty text are empty bytes.
Rows are kept one to one, repeated rows and null doc_ids too; extra
columns are ignored.  An empty table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import batches_out

NEVER = 1 << 60


class BpeTransducer:
    """``encode(piece)`` for one piece of bytes; the tables grow as they are
    needed and are thrown away when they hold ``max_transitions``."""

    def __init__(self, ranks: dict[bytes, int], max_transitions: int = 700_000):
        self.ranks = ranks
        self.max_transitions = max_transitions
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.child: dict[int, int] = {}
        self.entry: dict[int, int] = {}
        self.length = {i: len(b) for i, b in self.bytes_of.items()}
        self.longest = max(self.length.values())
        self.depth = [0]
        nodes = 1
        for token, rank in ranks.items():
            node = 0
            for c in token:
                key = node << 8 | c
                nxt = self.child.get(key)
                if nxt is None:
                    nxt = self.child[key] = nodes
                    nodes += 1
                    self.depth.append(self.depth[node] + 1)
                node = nxt
            self.entry[node] = rank
        self.edges: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        # an open position: (trie node of the bytes since, last token of the prefix before)
        start = ((0, -1),)
        self.states = [start]
        self.number = {start: 0}
        # state << 8 | byte -> next state << 25 | token << 1 | all before is agreed
        self.table: dict[int, int] = {}

    # ------------------------------------------------------------- merges

    def _edges(self, token: int) -> tuple | None:
        """(left edge, right edge): the symbols that stood first and last
        while the token was merged; None if its bytes encode otherwise."""
        if token in self.edges:
            return self.edges[token]
        ranks, of = self.ranks, self.bytes_of
        parts = [ranks[bytes([c])] for c in of[token]]
        left, right = [parts[0]], [parts[-1]]
        while len(parts) > 1:
            best, at = NEVER, -1
            for i in range(len(parts) - 1):
                r = ranks.get(of[parts[i]] + of[parts[i + 1]], NEVER)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at:at + 2] = [best]
            if at == 0:
                left.append(best)
            if at == len(parts) - 1:
                right.append(best)
        found = (left, right) if parts == [token] else None
        self.edges[token] = found
        return found

    def stable(self, first: int, second: int) -> bool:
        """Whether the bytes of the two tokens encode to just these two."""
        key = first << 24 | second
        known = self.pairs.get(key)
        if known is not None:
            return known
        if len(self.pairs) > 500_000:
            self.pairs.clear()
        right, left = self._edges(first)[1], self._edges(second)[0]
        ranks, of = self.ranks, self.bytes_of
        x = y = 0
        good = True
        while True:
            next_r = right[x + 1] if x + 1 < len(right) else NEVER
            next_l = left[y + 1] if y + 1 < len(left) else NEVER
            across = ranks.get(of[right[x]] + of[left[y]], NEVER)
            # of equal ranks the leftmost merges first
            if across < next_r and across <= next_l and across != NEVER:
                good = False
                break
            if next_r == NEVER and next_l == NEVER:
                break
            if next_r <= next_l:
                x += 1
            else:
                y += 1
        self.pairs[key] = good
        return good

    # ------------------------------------------------------------- states

    def _advance(self, state: int, c: int) -> int:
        """The step of a state and a byte, as the table holds it."""
        if len(self.table) >= self.max_transitions:
            held = self.states[state]
            self._reset()
            state = self._intern(held)
        child, entry = self.child, self.entry
        places, chosen = [], -1
        for node, last in self.states[state]:
            nxt = child.get(node << 8 | c)
            if nxt is None:
                continue
            places.append((nxt, last))
            if chosen < 0:
                token = entry.get(nxt, -1)
                if token >= 0 and self._edges(token) is not None and (last < 0 or self.stable(last, token)):
                    chosen = token
        if chosen < 0:
            raise ValueError("the ranks hold no encoding for these bytes")
        places.append((0, chosen))
        step = self._intern(tuple(places)) << 25 | chosen << 1 | (len(places) == 1)
        self.table[state << 8 | c] = step
        return step

    def _intern(self, places: tuple) -> int:
        n = self.number.get(places)
        if n is None:
            n = self.number[places] = len(self.states)
            self.states.append(places)
        return n

    def encode(self, piece: bytes) -> list[int]:
        state, out, table = 0, [], self.table
        ends: list[int] = []  # by byte since the last emission: the token that ends there
        for c in piece:
            step = table.get(state << 8 | c)
            if step is None:
                step = self._advance(state, c)
                table = self.table
            state = step >> 25
            ends.append(step >> 1 & 0xFFFFFF)
            if step & 1:
                self._emit(ends, out)
                ends = []
            elif len(ends) > 4 * self.longest:
                ends = self._emit_agreed(ends, out, state)
        self._emit(ends, out)
        return out

    def _emit(self, ends: list[int], out: list[int]) -> None:
        """The tokens from the last emission to here, walked from the back."""
        at, back = len(ends), []
        while at:
            back.append(ends[at - 1])
            at -= self.length[ends[at - 1]]
        back.reverse()
        out += back

    def _emit_agreed(self, ends: list[int], out: list[int], state: int) -> list[int]:
        """Emit up to the place where the walks from all open positions meet."""
        here = len(ends)
        places = {here - self.depth[node] for node, _ in self.states[state]}
        while len(places) > 1:
            top = max(places)
            places.remove(top)
            places.add(top - self.length[ends[top - 1]])
        meet, = places
        self._emit(ends[:meet], out)
        return ends[meet:]


class Utf8Machine:
    """Incremental UTF-8 decoding; ``feed`` takes any cut of the bytes.

    The state is what the next byte must look like: how many continuation
    bytes are due and the range of the first of them.
    """

    def __init__(self):
        self.due, self.low, self.high, self.held = 0, 0x80, 0xBF, bytearray()

    def feed(self, data: bytes) -> str:
        """The text that ``data`` completes.  Whole characters in its middle
        are decoded at once; the machine steps through an unfinished one at
        either end, and through all bytes when some are not UTF-8."""
        first = 0
        out: list[str] = []
        while self.due and first < len(data):
            self._step(data[first], out)
            first += 1
        last = len(data)
        while last > first and len(data) - last < 4 and data[last - 1] & 0xC0 == 0x80:
            last -= 1
        if last > first and data[last - 1] >= 0xC0:
            last -= 1
        else:
            last = len(data)
        try:
            out.append(data[first:last].decode("utf-8"))
        except UnicodeDecodeError:
            last = first
        for c in data[last:]:
            self._step(c, out)
        return "".join(out)

    def _step(self, c: int, out: list[str]) -> None:
        if self.due:
            if self.low <= c <= self.high:
                self.held.append(c)
                self.due -= 1
                self.low, self.high = 0x80, 0xBF
                if not self.due:
                    out.append(self._character())
                return
            out.append("\ufffd")
            self._clear()
        if c < 0x80:
            out.append(chr(c))
        elif 0xC2 <= c <= 0xF4:
            self.due = 1 + (c >= 0xE0) + (c >= 0xF0)
            self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(c, 0x80)
            self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(c, 0xBF)
            self.held.append(c)
        else:
            out.append("\ufffd")

    def finish(self) -> str:
        open_end = bool(self.due)
        self._clear()
        return "\ufffd" if open_end else ""

    def _character(self) -> str:
        head, *tail = self.held
        code = head & (0x1F if len(tail) == 1 else 0x0F if len(tail) == 2 else 0x07)
        for c in tail:
            code = code << 6 | c & 0x3F
        self._clear()
        return chr(code)

    def _clear(self) -> None:
        self.due, self.low, self.high = 0, 0x80, 0xBF
        self.held.clear()


class BpeCodec:
    """Pieces of a text by a pattern, each through the transducer; the ids
    of pieces met lately are kept, at most ``max_pieces`` of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_pieces: int = 900_000):
        self.machine = BpeTransducer(ranks)
        self.find = regex.compile(pattern).findall
        self.max_pieces = max_pieces
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        found = self.find(text)
        if 2 * len(self.pieces) >= self.max_pieces:
            self.older, self.pieces = self.pieces, {}
        known = self.pieces
        for piece in [p for p in found if p not in known]:
            known[piece] = self.older.get(piece) or self._encoded(piece)
        return b"".join(map(known.__getitem__, found))

    def _encoded(self, piece: str) -> bytes:
        ids = self.machine.encode(piece.encode())
        return pack(f"<{len(ids)}I", *ids)


class BpeDecoder:
    """Text of ids, ``step`` of them at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {i: b for b, i in ranks.items()}

    def decode(self, packed: bytes, step: int = 1 << 16) -> str:
        ids = np.frombuffer(packed, "<u4")
        of, machine, out = self.bytes_of.__getitem__, Utf8Machine(), []
        for i in range(0, len(ids), step):
            out.append(machine.feed(b"".join(map(of, ids[i:i + step].tolist()))))
        out.append(machine.finish())
        return "".join(out)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> BpeCodec:
    """One codec per worker process."""
    return BpeCodec(load_ranks(path), pattern)


@lru_cache(maxsize=2)
def decoder(path: str) -> BpeDecoder:
    return BpeDecoder(load_ranks(path))


def encode_documents(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens long, ids binary (little-endian unsigned 32-bit)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def rows(batch_iter):
        encode = codec(path, pattern).encode
        for batch in batch_iter:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packed = encode(text.as_py() or "")
                yield doc_id, len(packed) // 4, packed

    def run(batch_iter: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_out(schema, rows(batch_iter), lambda r: len(r[2]))

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with ``decoded``, the text of its ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def rows(batch_iter):
        decode = decoder(path).decode
        for batch in batch_iter:
            for doc_id, n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                packed = ids.as_py() or b""
                yield doc_id, n, packed, decode(packed)

    def run(batch_iter: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_out(schema, rows(batch_iter), lambda r: len(r[2]) + len(r[3]))

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def round_trip(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encode_documents`` and ``decode_documents`` in one pass: doc_id,
    n_tokens, ids and decoded."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def rows(batch_iter):
        encode, decode = codec(path, pattern).encode, decoder(path).decode
        for batch in batch_iter:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packed = encode(text.as_py() or "")
                yield doc_id, len(packed) // 4, packed, decode(packed)

    def run(batch_iter: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_out(schema, rows(batch_iter), lambda r: len(r[2]) + len(r[3]))

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded string")
