"""Cheapest repair of conversation structure, with an audit of the edits.

The rows of a conversation, in order, are kept (K, 0), given another role
(R, 2) or deleted (D, 3; blank and repeated rows must be), and empty rows
of either role are inserted (I, 2), so that the initials of the roles read
``(s?(ua)+)?``; a truncated row that stays adds 1.  Of the cheapest edits
the ASCII-least string of initials, the audit, is taken.  It fixes the
rest: what an R or I row becomes follows from the place it stands at.

Audits are found by dynamic programming over four states (nothing yet,
after s, after u, after a).  Prefixes of audits are shared: an edit is a
node linked to the one before it, with a skip link to a farther ancestor
and the rolling hash of the string so far.  Two prefixes of equal cost are
compared at their longest common prefix, which a descent along the skip
links finds by hash; equal hashes are verified by walking both strings back
to a node they share or to a pair that was verified before.

A conversation's rows are dealt to segments of a bounded number of rows.
A segment is solved for each state it can be entered in, so segments are
solved apart from each other, one byte a row; a conversation then chooses
among its segments' strings by the same programming with strings as edges
(what one row of output, its audit, must hold in any case).  Texts are
moved twice, once to order a conversation and once to hash it: SHA-256
reads a conversation from its first byte to its last, so one task streams
through its rows, and holds none of them.

Defined results.  A null role or text is one space, and so is a null in
the string a row's damage is taken from.  Rows of one turn stand by role,
then text; rows that look alike are interchangeable.  Rows without a
conv_id are a conversation of their own.  A role that begins otherwise
than with s, u or a can only be changed or deleted.  A conversation
without rows after damage has zeros, no audit and the hash of nothing.  An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import batches_out, stored

SEGMENT = 4096
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The states a row may leave by role, and where they lead.
NEXT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
GOAL = (NOTHING, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
PRIME, BASE = (1 << 61) - 1, 911382323


# ------------------------------------------------------------ shared prefixes

class Prefixes:
    """Strings that grow at their end and share what they have in common.
    Node 0 is the empty string."""

    def __init__(self):
        self.before, self.skip, self.depth = [0], [0], [0]
        self.letter, self.hash = [""], [0]
        self.verified: set[tuple[int, int]] = set()

    def grow(self, node: int, letter: str) -> int:
        """The string of ``node`` and one letter more.  The skip link goes
        to the ancestor that two equal jumps reach (an ancestor at any depth
        is O(log n) links away), or to the one before."""
        s = self.skip[node]
        far = self.depth[node] - self.depth[s] == self.depth[s] - self.depth[self.skip[s]]
        self.before.append(node)
        self.skip.append(self.skip[s] if far else node)
        self.depth.append(self.depth[node] + 1)
        self.letter.append(letter)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % PRIME)
        return len(self.before) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.skip[node] if self.depth[self.skip[node]] >= depth else self.before[node]
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth are the same string."""
        if a == b:
            return True
        if self.hash[a] != self.hash[b]:
            return False
        walked = []
        while a != b and (a, b) not in self.verified:
            if self.letter[a] != self.letter[b]:
                return False
            walked.append((a, b))
            a, b = self.before[a], self.before[b]
        self.verified.update(walked)
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether string a sorts before string b."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        while not self.same(self.before[x], self.before[y]):    # descend to the first difference
            if self.depth[self.skip[x]] == self.depth[self.skip[y]] and not self.same(self.skip[x], self.skip[y]):
                x, y = self.skip[x], self.skip[y]
            else:
                x, y = self.before[x], self.before[y]
        return self.letter[x] < self.letter[y]

    def string(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.before[node]
        return "".join(reversed(out))


class Programme:
    """The cheapest, then ASCII-least prefix per state."""

    def __init__(self, state: int):
        self.prefixes = Prefixes()
        self.best: dict[int, tuple[int, int]] = {state: (0, 0)}

    def offer(self, best: dict, state: int, cost: int, node: int, letters: str) -> bool:
        held = best.get(state)
        if held is not None and held[0] < cost:
            return False
        for letter in letters:
            node = self.prefixes.grow(node, letter)
        if held is not None and held[0] == cost and not self.prefixes.less(node, held[1]):
            return False
        best[state] = cost, node
        return True

    def insert(self) -> None:
        """Rows put in where the programme stands: u, a, or both."""
        for _ in range(2):
            for at in (NOTHING, SYSTEM, ASSISTANT, USER):
                if at in self.best:
                    cost, node = self.best[at]
                    self.offer(self.best, ASSISTANT if at == USER else USER, cost + INSERT, node, "I")

    def row(self, role: str, must_go: bool, truncated: bool) -> None:
        after: dict[int, tuple[int, int]] = {}
        for at, (cost, node) in self.best.items():
            self.offer(after, at, cost + DELETE, node, "D")
            if must_go:
                continue
            stays = cost + TRUNCATED * truncated
            if at in NEXT.get(role, {}):
                self.offer(after, NEXT[role][at], stays + KEEP, node, "K")
            self.offer(after, ASSISTANT if at == USER else USER, stays + REROLE, node, "R")
        self.best = after
        self.insert()

    def segment(self, entries: dict[int, dict[int, tuple[int, str]]]) -> dict[int, tuple[int, str]]:
        """A segment solved before: per state entered, per state left, the
        cost and the string.  Returns by state left what was taken."""
        after: dict[int, tuple[int, int]] = {}
        taken: dict[int, tuple[int, str]] = {}
        for at, (cost, node) in self.best.items():
            for left, (more, letters) in entries.get(at, {}).items():
                if self.offer(after, left, cost + more, node, letters):
                    taken[left] = at, letters
        self.best = after
        return taken

    def found(self) -> dict[int, tuple[int, str]]:
        return {s: (cost, self.prefixes.string(node)) for s, (cost, node) in self.best.items()}


def code(role: Column, must_go: Column, truncated: Column) -> Column:
    """A row as one letter: s, u, a or x for its role, in upper case if it
    is truncated, d if it must be deleted."""
    initial = F.when(F.substring(role, 1, 1).isin("s", "u", "a"), F.substring(role, 1, 1)).otherwise(F.lit("x"))
    return F.when(must_go, F.lit("d")).when(truncated, F.upper(initial)).otherwise(initial)


def solve(codes: str, state: int, first: bool) -> dict[int, tuple[int, str]]:
    """The programme over the rows ``codes`` from ``state``; rows may be put
    in before the first one of a conversation, later ones follow rows."""
    p = Programme(state)
    if first:
        p.insert()
    for c in codes:
        p.row(c.lower(), c == "d", c.isupper())
    return p.found()


# -------------------------------------------------------------------- damage

def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage: by the hash of its id
    and turn a row is dropped, emptied, robbed of its ends of sentences,
    repeated, or given to the user."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    plain = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return plain.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Every row with its place in its conversation (from 1) and its first
    fault; one shuffle, by conversation."""
    order = [F.asc_nulls_first("turn"), "role", "text"]
    conv = Window.partitionBy("conv_id").orderBy(*order)
    placed = rows.withColumns({"place": F.row_number().over(conv).cast("long"), "prior": F.lag("role").over(conv)})
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("place")) > 1
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    pair = F.concat(F.substring("prior", 1, 1), F.substring("role", 1, 1))
    faults = placed.withColumns({"blank": blank, "duplicate": ~blank & seen, "illegal": F.col("prior").isNotNull() & ~pair.isin("su", "ua", "au")})
    faults = faults.withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & ~ended).drop("prior")
    return faults.withColumns({"segment": F.floor((F.col("place") - 1) / SEGMENT).cast("long"), "code": code(F.col("role"), F.col("blank") | F.col("duplicate"), F.col("truncated"))})


# --------------------------------------------------------------------- tasks

SOLVED = "conv_id long, segment long, entries array<struct<entered: int, left: int, cost: long, letters: string>>"
CHOSEN = "conv_id long, cost long, audit string, segments array<struct<segment: long, entered: int, letters: string>>"


def _solve_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    entry = pa.struct([("entered", pa.int32()), ("left", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())])
    schema = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("entries", pa.list_(entry))])

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for r in batch.to_pylist():
                first = r["segment"] == 0
                entries = [{"entered": s, "left": t, "cost": cost, "letters": letters}
                           for s in ((NOTHING,) if first else range(4)) for t, (cost, letters) in solve(r["codes"], s, first).items()]
                yield r["conv_id"], r["segment"], entries

    yield from batches_out(schema, rows(), lambda r: sum(32 + len(e["letters"]) for e in r[2]))


def _choose_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = pa.struct([("segment", pa.int64()), ("entered", pa.int32()), ("letters", pa.string())])
    schema = pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("segments", pa.list_(part))])

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for conv_id, solved in zip(batch.column("conv_id").to_pylist(), batch.column("solved"), strict=True):
                yield conv_id, *_choose([(s["segment"], s["entries"]) for s in solved.as_py()])

    yield from batches_out(schema, rows(), lambda r: 2 * len(r[2]) + 64 * len(r[3]))


def _choose(solved: list[tuple[int, list[dict]]]) -> tuple[int, str, list[dict]]:
    """Cost, audit, and each segment's part of it."""
    p = Programme(NOTHING)
    came: list[dict[int, tuple[int, str]]] = []
    for _, entries in solved:
        by_state: dict[int, dict[int, tuple[int, str]]] = {}
        for e in entries:
            by_state.setdefault(e["entered"], {})[e["left"]] = e["cost"], e["letters"]
        came.append(p.segment(by_state))
    ends: dict[int, tuple[int, int]] = {}
    state = NOTHING
    for s in GOAL:
        if s in p.best and p.offer(ends, 0, *p.best[s], ""):
            state = s
    cost, node = ends[0]
    parts = []
    for (segment, _), back in zip(reversed(solved), reversed(came), strict=True):
        state, letters = back[state]
        parts.append({"segment": segment, "entered": state, "letters": letters})
    return cost, p.prefixes.string(node), parts[::-1]


def _apply_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each segment's edits before its first row: the rows
    as they are after repair.  Holds one segment's edits and no rows."""
    schema = pa.schema([("conv_id", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])

    def put_in(conv_id: int | None, state: int, text: str, letter: str) -> tuple[int, tuple]:
        """A row that gets its role from where it stands."""
        state = ASSISTANT if state == USER else USER
        return state, (conv_id, ROLES[state], text, letter)

    def rows() -> Iterator[tuple]:
        conv_id, state, letters = None, NOTHING, iter("")
        for batch in batches:
            for r in batch.to_pylist():
                if r["letters"] is not None:        # what is left of the segment before are rows put in at its end
                    for letter in letters:
                        state, out = put_in(conv_id, state, "", letter)
                        yield out
                    conv_id, state, letters = r["conv_id"], r["entered"], iter(r["letters"])
                    continue
                for letter in letters:
                    if letter == "I":
                        state, out = put_in(conv_id, state, "", letter)
                        yield out
                        continue
                    if letter == "R":
                        state, out = put_in(conv_id, state, r["text"], letter)
                        yield out
                    elif letter == "K":
                        state = NEXT[r["role"][0]][state]
                        yield conv_id, r["role"], r["text"], letter
                    break
        for letter in letters:
            state, out = put_in(conv_id, state, "", letter)
            yield out

    yield from batches_out(schema, rows(), lambda r: len(r[2]))


def _hash_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's ``role:text`` rows, joined by newlines."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def rows() -> Iterator[tuple]:
        now, digest = None, None
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if digest is not None and conv_id == now:
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        yield now, digest.hexdigest()
                    now, digest = conv_id, hashlib.sha256()
                digest.update(f"{role}:{text}".encode())
        if digest is not None:
            yield now, digest.hexdigest()

    yield from batches_out(schema, rows(), lambda r: 80)


# ------------------------------------------------------------------ operator

def prepared(conversations: DataFrame) -> DataFrame:
    """Damaged rows with place and faults, written once."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return stored(with_faults(damaged(rows)), "conversation-rows", "zstd")


def choose_edits(faulted: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, segments) of every conversation with rows."""
    lettered = F.array_sort(F.collect_list(F.struct("place", "code")))          # SEGMENT rows at most
    codes = faulted.groupBy("conv_id", "segment").agg(F.array_join(F.transform(lettered, lambda x: x["code"]), "").alias("codes"))
    solved = codes.mapInArrow(_solve_task, SOLVED)
    gathered = solved.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("segment", "entries"))).alias("solved"))
    return stored(gathered.mapInArrow(_choose_task, CHOSEN), "conversation-edits", "zstd")


def repaired_rows(faulted: DataFrame, chosen: DataFrame) -> DataFrame:
    """(conv_id, role, text, edit): the rows of every repaired conversation,
    a conversation's rows in order in one partition."""
    none = F.lit(None)
    rows = faulted.select("conv_id", "place", F.lit(1).alias("kind"), "role", "text", none.cast("string").alias("letters"), none.cast("int").alias("entered"))
    edits = chosen.select("conv_id", F.explode("segments").alias("s")).select(
        "conv_id", (F.col("s.segment") * SEGMENT + 1).alias("place"), F.lit(0).alias("kind"), none.cast("string").alias("role"), none.cast("string").alias("text"), "s.letters", "s.entered")
    ordered = rows.union(edits).repartition("conv_id").sortWithinPartitions("conv_id", "place", "kind")
    return ordered.mapInArrow(_apply_task, "conv_id long, role string, text string, edit string")


def _joined(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.withColumnRenamed("conv_id", "_other")
    return left.join(other, left["conv_id"].eqNullSafe(other["_other"]), "left").drop("_other")


def repair(conversations: DataFrame) -> DataFrame:
    """A row per original conversation: its faults, the cost and audit of
    its repair, and the hash of what it is afterwards."""
    faulted = prepared(conversations)
    chosen = choose_edits(faulted)
    wide = [F.col(f"{f}_turn").cast("decimal(20,0)") for f in ("max", "min")]
    gaps = F.when(F.col("turns") > 0, F.least(wide[0] - wide[1] + 1 - F.col("turns"), F.lit((1 << 63) - 1).cast("decimal(20,0)"))).cast("long")
    faults = [F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    counts = faulted.groupBy("conv_id").agg(F.max("turn").alias("max_turn"), F.min("turn").alias("min_turn"), F.count_distinct("turn").alias("turns"), *faults)
    hashes = repaired_rows(faulted, chosen).mapInArrow(_hash_task, "conv_id long, repaired_sha256 string")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = _joined(_joined(_joined(every, counts), chosen.select("conv_id", "cost", "audit")), hashes)
    zero, nothing = F.lit(0).cast("long"), hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", F.coalesce(gaps, zero).alias("gaps"), *[F.coalesce(F.col(c), zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


ORACLE = """
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS c FROM range(256) r(i))),
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda a, b: xor(t[CAST(xor(a, b) & 255 AS INTEGER) + 1], a >> 8), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind
  FROM conversations, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, LATERAL (SELECT unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy) WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER w AS i, left(lag(role) OVER w, 1) || left(role, 1) AS pair FROM damaged
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank FROM placed),
faults AS (
  SELECT *, again AND NOT blank AS duplicate, NOT blank AND NOT again AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS truncated,
    pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au') AS illegal, left(role, 1) AS initial FROM seen),
-- per state (nothing, after s, after u, after a) the least (cost, audit), with the rows so far
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i,
    {'c': 0, 'e': '', 'r': CAST([] AS VARCHAR[])} AS n, CAST(NULL AS STRUCT(c INTEGER, e VARCHAR, r VARCHAR[])) AS s,
    {'c': 2, 'e': 'I', 'r': ['user:']} AS u, {'c': 4, 'e': 'II', 'r': ['user:', 'assistant:']} AS a
  FROM (SELECT DISTINCT conv_id FROM damaged)
  UNION ALL
  SELECT conv_id, i, n, s, u2, least(a1, {'c': u2.c + 2, 'e': u2.e || 'I', 'r': list_append(u2.r, 'assistant:')}) FROM (
    SELECT *, least(u1, CASE WHEN a1 IS NOT NULL THEN {'c': a1.c + 2, 'e': a1.e || 'I', 'r': list_append(a1.r, 'user:')} END,
      {'c': n.c + 2, 'e': n.e || 'I', 'r': list_append(n.r, 'user:')}, CASE WHEN s IS NOT NULL THEN {'c': s.c + 2, 'e': s.e || 'I', 'r': list_append(s.r, 'user:')} END) AS u2 FROM (
      SELECT w.conv_id, f.i,
        {'c': w.n.c + 3, 'e': w.n.e || 'D', 'r': w.n.r} AS n,
        least(CASE WHEN w.s IS NOT NULL THEN {'c': w.s.c + 3, 'e': w.s.e || 'D', 'r': w.s.r} END,
          CASE WHEN NOT gone AND f.initial = 's' THEN {'c': w.n.c + t, 'e': w.n.e || 'K', 'r': list_append(w.n.r, f.role || ':' || f.text)} END) AS s,
        least({'c': w.u.c + 3, 'e': w.u.e || 'D', 'r': w.u.r},
          CASE WHEN NOT gone AND f.initial = 'u' THEN {'c': w.n.c + t, 'e': w.n.e || 'K', 'r': list_append(w.n.r, f.role || ':' || f.text)} END,
          CASE WHEN NOT gone AND f.initial = 'u' AND w.s IS NOT NULL THEN {'c': w.s.c + t, 'e': w.s.e || 'K', 'r': list_append(w.s.r, f.role || ':' || f.text)} END,
          CASE WHEN NOT gone AND f.initial = 'u' THEN {'c': w.a.c + t, 'e': w.a.e || 'K', 'r': list_append(w.a.r, f.role || ':' || f.text)} END,
          CASE WHEN NOT gone THEN {'c': w.n.c + t + 2, 'e': w.n.e || 'R', 'r': list_append(w.n.r, 'user:' || f.text)} END,
          CASE WHEN NOT gone AND w.s IS NOT NULL THEN {'c': w.s.c + t + 2, 'e': w.s.e || 'R', 'r': list_append(w.s.r, 'user:' || f.text)} END,
          CASE WHEN NOT gone THEN {'c': w.a.c + t + 2, 'e': w.a.e || 'R', 'r': list_append(w.a.r, 'user:' || f.text)} END) AS u1,
        least({'c': w.a.c + 3, 'e': w.a.e || 'D', 'r': w.a.r},
          CASE WHEN NOT gone AND f.initial = 'a' THEN {'c': w.u.c + t, 'e': w.u.e || 'K', 'r': list_append(w.u.r, f.role || ':' || f.text)} END,
          CASE WHEN NOT gone THEN {'c': w.u.c + t + 2, 'e': w.u.e || 'R', 'r': list_append(w.u.r, 'assistant:' || f.text)} END) AS a1
      FROM walk w JOIN (SELECT *, blank OR duplicate AS gone, CASE WHEN truncated THEN 1 ELSE 0 END AS t FROM faults) f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1))),
ends AS (SELECT w.conv_id, least(w.n, w.a) AS b FROM walk w JOIN (SELECT conv_id, max(i) AS i FROM faults GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.i = w.i),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
    count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE illegal) AS illegal FROM faults GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.e, '') AS audit, sha256(coalesce(array_to_string(b.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""
