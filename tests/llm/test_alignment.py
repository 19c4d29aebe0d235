import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import sentencepiece
from tokenizers import Tokenizer

from quarry.llm import alignment as L

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, row int, pairs string"


def byte_decoder():
    """How byte-level vocabularies write bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, n = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            table[chr(256 + n)] = b
            n += 1
    return table


def brute(rows):
    """Whole texts through both libraries, spans compared one by one."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = byte_decoder()
    per = []
    for doc_id, text in rows:
        want = (" " + (text or "")).encode()
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        xb = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
        yb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in y)]
        if b"".join(xb) != want or b"".join(yb) != want:
            x = y = xb = yb = []
        xe, ye = np.cumsum([len(t) for t in xb]).tolist(), np.cumsum([len(t) for t in yb]).tolist()
        cuts = sorted(set(xe) & set(ye))
        links, j = [], 0
        for i, t in enumerate(xb):
            while j < len(y) and ye[j] <= xe[i] - len(t):
                j += 1
            k = j
            while k < len(y) and ye[k] - len(yb[k]) < xe[i]:
                links.append((x[i], y[k]))
                k += 1
        groups, shared, low = [], 0, 0
        for c in cuts:
            ga, gb = [x[i] for i in range(len(x)) if low < xe[i] <= c], [y[i] for i in range(len(y)) if low < ye[i] <= c]
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            shared += len(ga) * len(gb)
            low = c
        per.append((doc_id, len(x), len(y), len(cuts), links, ";".join(groups), shared))
    counts = Counter(p for *_, links, _, _ in per for p in links)
    top = {}
    for (_, t), n in counts.items():
        top[t] = max(top.get(t, 0), n)
    return sorted(((d, na, nb, ng, len(ls), sum(counts[p] == top[p[1]] for p in ls), sum(counts[p] for p in ls), groups, sh) for d, na, nb, ng, ls, groups, sh in per), key=repr)


def got(spark, rows, **kw):
    df = L.alignment(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), A, B, **kw)
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "n_shared").collect()), key=repr)


ODD = ["", None, " ", "  a", "a  b ", "\n", "a\n\nb c\td", "naïve café ﬁn 中文字 テスト", "x▁y z", "<|endoftext|> and <s> </s>", "\x00 \x1c \x85 a\xa0b　c", "😀😀 👩‍👩‍👧", "don't I'll 'tis",
       "é ﻿ end", "aaaa" * 300, "x" + " " * 700 + "y", "a b", "a b"]


def test_against_brute_force(spark):
    rows = list(enumerate(ODD)) + [(None, "a b"), (3, "again the same words again"), (3, "again the same words again")]
    want = brute(rows)
    assert got(spark, rows) == want
    assert got(spark, rows, frequent=0) == want == got(spark, rows, frequent=20)
    assert got(spark, []) == []


def test_products_against_dense():
    rnd = np.random.default_rng(7)
    a, b = (rnd.random((9, 12)) < 0.3).astype(int), (rnd.random((12, 7)) < 0.3).astype(int)
    ca, cb = (L.by_rows(m.sum(1), np.nonzero(m)[1]) for m in (a, b))
    starts, columns, values = L.row_products(ca, cb)
    dense = np.zeros((9, 7), int)
    dense[np.repeat(np.arange(9), np.diff(starts)), columns] = values
    assert (dense == a @ b).all() and L.product_sizes(ca, cb).tolist() == (a @ b.sum(1)).tolist()
    at, col = L.transposed(ca, 12)
    assert (np.concatenate([[0], np.cumsum(a.sum(0))]) == at).all() and (col == np.nonzero(a.T)[1]).all()


def test_shared_links():
    both = L.Aligned(np.array([2, 1, 3, 1]), np.array([1, 2, 4]))
    starts, columns, bytes_shared = both.links()
    assert np.repeat(np.arange(4), np.diff(starts)).tolist() == [0, 0, 1, 2, 3] and columns.tolist() == [0, 1, 1, 2, 2] and bytes_shared.tolist() == [1, 1, 1, 3, 1]
    starts, columns, _ = both.shared()
    assert np.repeat(np.arange(4), np.diff(starts)).tolist() == [0, 0, 1, 1, 2, 3] and columns.tolist() == [0, 1, 0, 1, 2, 2] and both.shared_sizes().tolist() == [2, 2, 1, 1]
    assert both.shared(slice(1, 2))[1].tolist() == [0, 1]


def test_memo_changes_nothing(monkeypatch):
    texts = [t for t in ODD if t]
    usual = [(*r[:6], r[6].tolist()) for r in L.Pair(A, B).documents(texts)]
    monkeypatch.setattr(L, "MEMO_BYTES", 1000)
    monkeypatch.setattr(L, "TOGETHER", 5)
    small = L.Pair(A, B)
    assert [(*r[:6], r[6].tolist()) for t in texts for r in small.documents([t])] == usual


def test_query(spark):
    from quarry.llm.queries import QUERIES
    df = QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.001")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want = sorted(((d, na, nb, ng, nl, best, total, hashlib.sha256(g.encode()).hexdigest() if g else "", sh) for d, na, nb, ng, nl, best, total, g, sh in brute(rows)), key=repr)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == want
