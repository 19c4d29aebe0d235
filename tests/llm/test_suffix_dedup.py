import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quarry.llm import suffix_dedup as sd
from quarry.llm.suffix_sort import common_prefixes, suffix_array


def test_suffix_array():
    rnd = random.Random(1)
    for _ in range(800):
        s = [rnd.randint(1, rnd.choice([1, 2, 4])) for _ in range(rnd.randint(0, 40))] + [0]
        order = suffix_array(np.array(s))
        assert order == sorted(range(len(s)), key=lambda i: s[i:])
        for r, h in enumerate(common_prefixes(s, order)):
            a, b = s[order[r - 1]:] if r else [], s[order[r]:]
            assert h == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def brute(texts, length=400):
    data = [(t or "").encode() for t in texts]
    seen = Counter(hash(d[i:i + length]) for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        covered, end = np.zeros(len(d), bool), 0
        for i in range(len(d)):
            if i + length <= len(d) and seen[hash(d[i:i + length])] > 1:
                end = i + length
            covered[i] = i < end
        spans = int((np.diff(np.r_[False, covered].astype(int)) == 1).sum())
        out.append((len(d), int(covered.sum()), spans, hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~covered])).hexdigest()))
    return out


def rows_of(df):
    out = []
    for r in df.collect():
        taken = sum(r.removed[1::2]) - sum(r.removed[::2])
        out.append((r.doc_id, r.n_bytes, taken, len(r.removed) // 2, hashlib.sha256(r.kept).hexdigest()))
    return out


def corpus(rnd):
    def words(n):
        return " ".join(rnd.choice(["alpha", "béta", "γάμμα", "d", "epsilon"]) + str(rnd.randrange(50)) for _ in range(n))
    base, passage = words(300), words(75)
    texts = [base, base, words(200) + passage + words(10), words(5) + passage + words(200), passage]
    for _ in range(12):
        w = base.split()
        for _ in range(rnd.randint(1, 6)):
            w[rnd.randrange(len(w))] = f"edit{rnd.randrange(999)}"
        texts.append(" ".join(w))
    texts += ["ab" * 700, "z" * 1000, "z" * 399, "z" * 400, passage[:200] + words(100) + passage[-380:], None, "", "short", base[:450] + "x" + base[450:900]]
    return texts


@pytest.mark.parametrize("chunk,block", [(1024, 1 << 17), (4, 300)])
def test_documents(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(sd, "CHUNK", chunk)
    monkeypatch.setattr(sd, "BLOCK", block)
    sd._tables.cache_clear()
    texts = corpus(random.Random(chunk))
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, kept string, span int")
    got = {r[0]: r[1:] for r in rows_of(sd.remove_repeats(df))}
    want = brute(texts)
    assert [got[i] for i in range(len(texts))] == want
    sd._tables.cache_clear()


def test_cells_do_not_depend_on_blocks(monkeypatch):
    data = np.frombuffer(("some text that goes on and on " * 40 + "x" * 900 + "other text " * 90).encode(), np.uint8)
    one = sd.cells(data)
    assert (np.diff(one[0]) == one[1][:-1]).all() and one[0][0] == 0 and one[0][-1] + one[1][-1] == len(data) - 399
    assert sd.cells(data[:399]) is None


def test_groups_are_labelled_without_a_sort_per_column(monkeypatch):
    rnd = random.Random(5)
    calls = []
    unique = np.unique
    monkeypatch.setattr(np, "unique", lambda *a, **b: calls.append(1) or unique(*a, **b))
    monkeypatch.setattr(sd, "BLOCK", 100)
    for d in (2, 3, 40):
        members = [(r, rnd.randint(0, 9), 5, bytes(rnd.choices(b"abc", k=60))) for r in range(d)]
        g = sd.Group(members)
        grid = [dict(enumerate(m[3], int(f))) for f, m in zip(g.first, members, strict=True)]
        at = {c: s for s, (a, b) in enumerate(zip(g.starts, g.ends, strict=True)) for c in range(a, b)}
        for c, s in at.items():
            first = [next(q for q in range(d) if q == r or c in grid[q] and grid[q][c] == grid[r].get(c)) for r in range(d)]
            assert (g.symbols[:, s] - d * s).tolist() == first
    assert not calls


def test_odd_rows(spark):
    long_text = "unlike any other " + "".join(chr(97 + i * i % 23) + str(i) for i in range(300))
    df = spark.createDataFrame([(1, long_text), (1, long_text), (None, "q" + long_text), (None, "another"), (None, None)], "doc_id long, text string")
    got = sorted(rows_of(sd.remove_repeats(df)), key=str)
    n = len(long_text)
    assert sorted(x[2] for x in got) == [0, 0, n, n, n]
    assert sd.remove_repeats(df.limit(0)).collect() == []
    assert sd.merged([]) == []


def test_query_equals_brute_force(spark):
    import __spark_entry__ as e
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in e.queries()["op5_suffix_dedup"](spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    want = brute([d.text for d in docs])
    assert [got[d.doc_id] for d in docs] == want
    assert sum(w[1] for w in want) > 50_000
