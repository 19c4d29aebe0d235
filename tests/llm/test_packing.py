import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from quarry.llm.packing import best_fit_decreasing, best_fit_packing, cut_pieces, lower_bound, pack
from quarry.llm.tokens import WordIds

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def check(rows, capacity=4096):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for placed in by.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_words_give_the_ids_of_the_text(library):
    texts = ["", "Hello  World", "a\x1cb c", "é é  x　y\x85z", "it's <|endoftext|> 12345 don't", "ΣΑΣ σ", "́ a", "x" * 5000]
    few = WordIds(PATH, max_words=3)
    got = few.encode(texts)
    latin = [chr(a) + chr(b) for a in range(1, 256) for b in (97, 65, 39, 233, 49, 33, a)] + ["İ Ŀ ǆ ﬁ", "can't'LL'S x's'", "o'clock<|startoftext|>", "ÀÉß", "q" * 300]
    assert [np.frombuffer(g, "<u4").tolist() for g in WordIds(PATH).encode(latin)] == [library.encode(t, add_special_tokens=False).ids for t in latin]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_lower_bound_and_best_fit():
    rnd = np.random.default_rng(5)
    for capacity in (10, 100, 4096):
        for _ in range(20):
            lengths = np.sort(rnd.integers(1, capacity + 1, 200))[::-1]
            bins, offsets, n = best_fit_decreasing(lengths, capacity)
            bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
            assert -(-lengths.sum() // capacity) <= bound <= n
    thirds = np.bincount([34] * 9, minlength=101)     # two to a bin: the u_p functions see it
    assert lower_bound(thirds, 100) == 5
    assert lower_bound(np.bincount([60] * 5, minlength=101), 100) == 5
    assert lower_bound(np.zeros(101, int), 100) == 0


def test_partitions_exchange(spark):
    """Halves dealt to many partitions: odd ones are left over and must meet."""
    rows = [(i, 0, 0, 50, 0) for i in range(301)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = pack(df, capacity=100, per_part=10).collect()
    assert len(got) == 301
    assert check(got, 100) == 151


def test_documents(spark, library):
    rows = [(1, "some words here", 5), (2, None, 5), (3, "", 5), (3, "", 5), (None, "no id", 5), (7, "word " * 9000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    got = best_fit_packing(df, PATH).collect()
    check(got)
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length) for r in got) == sorted(
        [(1, 0, 0, 4), (2, 0, 0, 1), (3, 0, 0, 1), (3, 0, 0, 1), (0, 0, 0, 3), (7, 0, 0, 4096), (7, 1, 4096, 4096), (7, 2, 8192, 809)])
    assert best_fit_packing(df.limit(0), PATH).collect() == []


def test_query(spark, library):
    import __spark_entry__ as e
    got = e.queries()["op3_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    want = {}
    for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = np.array(library.encode(d.text or "", add_special_tokens=False).ids + [1], "<u4")
        for i in range(0, len(ids), 4096):
            want[d.doc_id, i // 4096] = (i, len(ids[i:i + 4096]), zlib.crc32(ids[i:i + 4096].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    total = sum(v[1] for v in want.values())
    assert check(got) <= -(-total // 4096) * 1.02 + 1
    assert cut_pieces(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), PATH).count() == len(want)


def test_rounds_go_on_while_they_save(spark, monkeypatch):
    from quarry.llm import packing
    counts, rounds = iter(x for n in range(20, 11, -1) for x in (n, n - (n > 12))), []
    real = packing._pack_round
    monkeypatch.setattr(packing, "_bins_of", lambda rows: next(counts))
    monkeypatch.setattr(packing, "_bound_of", lambda rows, capacity: 0)
    monkeypatch.setattr(packing, "_pack_round", lambda *a: rounds.append(a[1]) or real(*a))
    pieces = spark.createDataFrame([(i, 0, 0, 3, 0) for i in range(8)], packing.PIECE)
    rows = packing.pack(pieces, 10, per_part=4).collect()
    assert rounds == list(range(10)) and sorted(r.doc_id for r in rows) == list(range(8))
