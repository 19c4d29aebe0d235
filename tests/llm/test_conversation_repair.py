import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from quarry.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, place int, code string"
EMPTY = hashlib.sha256(b"").hexdigest()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        out += [row] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    """(role, text, fault) in order of one conversation."""
    seen, out = set(), []
    for _, _, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())):
        words = text.strip(" \t\n\v\f\r")
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """A search over whole strings by (cost, audit): the first to reach the end."""
    goal, done = None, set()
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            goal = cost, audit, lines
            break
        nxt = "assistant" if state == "u" else "user"
        heapq.heappush(heap, (cost + 2, audit + "I", i, nxt[0], (*lines, nxt + ":")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, nxt[0], (*lines, f"{nxt}:{text}")))
                if role[:1] == nxt[0] or (role[:1] == "s" and state == ""):
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role[0], (*lines, f"{role}:{text}")))
    return goal


def brute(rows):
    out = []
    by_conv = {}
    for r in damage(rows):
        by_conv.setdefault(r[0], []).append(r)
    for conv in {r[0] for r in rows}:
        held = by_conv.get(conv)
        if not held:
            out.append((conv, 0, 0, 0, 0, 0, 0, "", EMPTY))
            continue
        f = faults(held)
        turns = {r[1] for r in held if r[1] is not None}
        gaps = min(2 ** 63 - 1, max(turns) - min(turns) + 1 - len(turns)) if turns else 0
        n = [sum(x[2] == k for x in f) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(f))
        cost, audit, lines = cheapest(f)
        out.append((conv, gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in C.repair(df).collect()), key=repr)


def random_rows(seed, convs, most):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rnd.choice(["Yes.", "no", "Well!", "", " \n", "what?  ", "more.", f"t{t}."]))
            for c in range(convs) for t in range(rnd.randrange(1, most))]


@pytest.mark.parametrize("segment", [1, 3, 4096])
def test_against_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(C, "SEGMENT", segment)
    rows = random_rows(segment, 60, 14)
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, None, None, None), (1, None, "user", "x."), (1, None, "assistant", "y."), (1, None, "user", "x."), (2, 5, "user", "same."), (2, 5, "user", "same."),
            (2, 5, "assistant", "same."), (3, -2 ** 63, "user", "far."), (3, 2 ** 63 - 1, "assistant", "away."), (4, 1, "user", "word " * 60_000 + "end."), (4, 2, "assistant", "é ü。"), (5, 1, "User", "."), (6, None, "user", "only nulls.")]
    dropped = next(c for c in range(100, 1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows.append((dropped, 1, "user", "gone."))
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_long_conversation(spark, monkeypatch):
    """A conversation over many segments, one long run of ties among it."""
    monkeypatch.setattr(C, "SEGMENT", 64)
    rnd = random.Random(2)
    rows = [(7, t, "tool" if t < 700 else rnd.choice(["user", "assistant"]), f"t{t}." if rnd.random() < 0.8 else "cut") for t in range(1500)]
    assert got(spark, rows) == brute(rows)


def test_prefixes_compare_like_strings():
    rnd = random.Random(1)
    p = C.Prefixes()
    nodes = [0]
    for _ in range(400):
        nodes.append(p.grow(rnd.choice(nodes[-30:]), rnd.choice("DK")))
    for a in rnd.sample(nodes, 60):
        for b in rnd.sample(nodes, 60):
            assert p.less(a, b) == (p.string(a) < p.string(b))
        assert all(p.string(p.ancestor(a, d)) == p.string(a)[:d] for d in range(p.depth[a] + 1))


def test_equal_hashes_are_verified(monkeypatch):
    codes = "uuaSxdaauxxxdUuA"
    want = C.solve(codes, 0, True)
    monkeypatch.setattr(C, "PRIME", 3)
    test_prefixes_compare_like_strings()
    assert C.solve(codes, 0, True) == want


def test_query(spark):
    from quarry.llm.queries import QUERIES
    df = QUERIES["op11_conversation_repair"](spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == brute(rows)
