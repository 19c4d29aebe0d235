"""Windows of texts in Arrow batches: ids, signatures and neighbours by brute force."""

import hashlib
import random
from collections import Counter
from types import SimpleNamespace

import pyarrow as pa
import pytest

from quarry.operators import similarity as S
from quarry.operators import windows as W
from quarry.plans import textsim as T


def texts():
    rnd = random.Random(4)
    return ["".join(rnd.choice("ab déß漢😀\n") for _ in range(rnd.randint(0, 50))) for _ in range(80)] + ["", "short", "a" * 30, None]


def windows(text, k=10):
    return {text[i:i + k] for i in range(len(text) - k + 1)} if text else set()


def ids(text, k=10):
    return {int(hashlib.md5(w.encode()).hexdigest()[:15], 16) for w in windows(text, k)}


@pytest.mark.parametrize("k", [1, 10, 20])
@pytest.mark.parametrize("size", [40, 1 << 20])
def test_block_windows(monkeypatch, k, size):
    monkeypatch.setattr(W, "BLOCK_BYTES", size)
    rows = texts()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows, pa.string())], ["id", "text"]).slice(3)
    seen = 0
    for part, block in W.blocks([batch], "text", k):
        ends, found = block.distinct_ids()
        owner, strings = block.distinct()
        for i, n in enumerate(part.column(0).to_pylist()):
            assert found[ends[i]:ends[i + 1]].tolist() == sorted(ids(rows[n], k))
            assert sorted(w for o, w in zip(owner, strings.to_pylist(), strict=True) if o == i) == sorted(windows(rows[n], k))
            seen += 1
    assert seen == len(rows) - 3 - 1


def test_signatures_without_a_row_per_shingle(spark, capsys):
    rows = [(i // 2 if i % 7 else None, x) for i, x in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    every, count, total = {}, Counter(), Counter()
    for d, x in rows:
        every.setdefault(d, set()).update(ids(x))
        count[d] += len(ids(x))
        total[d] += sum(h % 1000000007 for h in ids(x))
    prime, params = S.MERSENNE_31, S.minhash_params()
    want = {d: [min((a * x + b) % prime for x in h) for a, b in params] for d, h in every.items() if h}
    signed = S.document_signatures(df)
    assert {r["doc_id"]: r["sig"] for r in signed.collect()} == want
    assert {r["doc_id"]: (r["n_hashes"], r["sum_hash"]) for r in S.hashed_sums(df).collect()} == {d: (count[d], total[d]) for d in want}
    t = SimpleNamespace(documents=df, spark=spark)
    for one in (T.q_minhash(t), T.q_shingle_hash(t)):
        capsys.readouterr()
        one.explain()
        assert "Generate" not in capsys.readouterr().out


def test_neighbours_with_repeated_and_null_ids(spark):
    texts_ = {0: ["the quick brown fox jumps"], 1: ["the quick brown fox sleeps", "the quick brown fox sleeps well"], 2: [None], 3: ["the quick brown fox sleeps", "a quick brown fox sleeps"],
              4: ["short"], 5: ["tiny"], 9: ["far away from all the others"], None: ["nobody owns this text", "nobody owns that text"]}
    df = spark.createDataFrame([(d, x) for d, many in texts_.items() for x in many], "doc_id long, text string")
    t = SimpleNamespace(documents=df, spark=spark)
    h = {d: Counter(x for one in many for x in ids(one)) for d, many in texts_.items()}
    inc, cut, union = {}, {}, {}
    for d in h:
        if d is None or d + 1 not in h:
            continue
        a, b = h[d], h[d + 1]
        if a or b:
            inc[d] = (sum(n for x, n in a.items() if x not in b), sum(n for x, n in b.items() if x not in a), sum(n * b[x] for x, n in a.items()))
        if set(a) & set(b):
            cut[d] = len(set(a) & set(b))
        if a and b:
            union[d] = len(set(a) | set(b))
    cut[None] = len(h[None])
    assert {r["doc_id"]: (r["only_left"], r["only_right"], r["both"]) for r in T.q_incremental(t).collect()} == inc
    assert {r["doc_id"]: r["n"] for r in T.q_intersect(t).collect()} == cut
    assert {r["doc_id"]: r["n"] for r in T.q_union(t).collect()} == union
