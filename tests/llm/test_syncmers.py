import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from quarry.llm import syncmers
from quarry.llm.syncmers import K, S

MASK = 0xFFFFFFFF


def chain(parts):
    seed = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else p.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def brute(text):
    if not text:
        return []
    ws = re.split(r"[\x20\x09-\x0D]+", text.strip(" \t\n\x0b\f\r"))
    u = ws if len(ws) >= K else list(text)
    if len(u) < K:
        return [(chain(["".join(u)]) & MASK, 0)]
    h = [chain(u[i:i + S]) for i in range(len(u) - S + 1)]
    inner = K - S + 1
    out = []
    for i in range(len(u) - K + 1):
        w = h[i:i + inner]
        if min(w) in (w[0], w[-1]):
            out.append((chain([w[j] for j in sorted({*range(0, inner, S), inner - 1})]) & MASK, i))
    return out


def near(a, b):
    x, y = {h for h, _ in a}, {h for h, _ in b}
    return len(x & y) / len(x | y) if x | y else 1.0


def expected(rows):
    rows = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0]), reverse=True)
    out = {}
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        m = len(text) // 3
        edited = text[:len(text) - m] + following[:m]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), brute(text), brute(edited), near(brute(text), brute(edited)), near(brute(text), brute(following)))
    return out


def string(found):
    return " ".join(f"{h:x}@{p}" for h, p in found)


def test_query_equals_brute_force(spark):
    import __spark_entry__ as e
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = expected(docs)
    got = e.queries()["op9_closed_syncmers"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        w = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) == (w[0], w[1], string(w[2]), string(w[3]), w[4], w[5])


def test_odd_rows(spark):
    rows = [(1, "short"), (2, None), (3, ""), (4, "w " * 40_000), (5, "éü中😀" * 9), (9, "ten words are just enough for a k mer here yes"), (None, "no id at all")]
    df = spark.createDataFrame([(a, b, "x", "y") for a, b in rows], "doc_id long, text string, anchors string, edited string")
    want = expected(rows)
    for buckets in (1, 3, 50):
        got = syncmers.with_next(df.select("doc_id", "text"), ["text"], buckets=buckets).collect()
        ids = sorted([r for r, _ in rows if r], reverse=True) + [None]
        following = dict(zip(ids, [*ids[1:], ids[0]]))
        texts = dict(rows)
        assert {r.doc_id: r.next_text for r in got} == {i: texts[following[i]] for i in ids}
    for r in syncmers.fingerprints(df).collect():
        assert [(a & MASK, a >> 32) for a in r.anchors] == want[r.doc_id][2]
        assert [(a & MASK, a >> 32) for a in r.edited_anchors] == want[r.doc_id][3]
    assert syncmers.fingerprints(df.limit(0)).collect() == []
    alone = syncmers.fingerprints(df.where("doc_id = 9")).first()
    assert alone.next_anchors == alone.anchors
    assert syncmers.fingerprints(df.union(df)).count() == 14


def test_anchors_do_not_depend_on_context(spark):
    shared = " ".join(f"w{i * i}" for i in range(200))
    df = spark.createDataFrame([(1, "a b c " + shared), (2, "some other beginning of it " + shared + " and end")], "doc_id long, text string")
    found = df.select("doc_id", syncmers.anchors(F.col("text")).alias("anchors"))
    pairs = syncmers.positional_matches(found.where("doc_id = 1"), found.where("doc_id = 2")).collect()
    best = max(pairs, key=lambda r: r.matches)
    assert best["shift"] == 2 and best.matches >= 30
