import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from quarry.llm.bpe_fst import BpeCodec, BpeDecoder, Utf8Machine, decode_documents, encode_documents, load_ranks, round_trip

PATH = P.path("byte_bpe_50k.tiktoken")
BPE_TEXT = BpeDecoder(load_ranks(PATH))


@pytest.fixture(scope="module")
def codec():
    return BpeCodec(load_ranks(PATH), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_ids_equal_the_library(codec, library):
    rnd = random.Random(3)
    parts = ["a", "b", "é", "ß", "中", "😀", " ", "\n", "\t", "　", "\x1c", "\x85", "1", "'s", "the", "ing", "́", "A", "\x00"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))
        assert ids(codec.encode(text)) == library.encode_ordinary(text)
        assert BPE_TEXT.decode(codec.encode(text), step=3) == text


def test_long_runs_emit_before_the_end(codec, library):
    for piece in ("a" * 20_000, "ab" * 9_000, "é" * 5_000, " " * 3_000, "=" * 4_000):
        assert ids(codec.encode(piece)) == library.encode_ordinary(piece)


def test_tables_may_be_thrown_away(library):
    small = BpeCodec(load_ranks(PATH), P.PATTERN, max_pieces=5)
    small.machine.max_transitions = 40
    text = "Unforgettable transformations, 12 naïve cafés and other reasonably long words"
    for _ in range(3):
        assert ids(small.encode(text)) == library.encode_ordinary(text)


def test_utf8_machine_takes_any_cut():
    data = "aé中😀z".encode()
    for cut in range(len(data) + 1):
        m = Utf8Machine()
        assert m.feed(data[:cut]) + m.feed(data[cut:]) + m.finish() == "aé中😀z"
    m = Utf8Machine()
    assert m.feed(b"\xff\xc3") + m.feed(b"a\xe2\x82") + m.finish() == "��a�"


def test_documents(spark, library):
    rows = [(1, "the the end", "x"), (2, None, "x"), (3, "", "x"), (1, "the the end", "x"), (None, "null id", None), (9, "long " * 30_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = decode_documents(encode_documents(df, PATH, P.PATTERN), PATH).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in got) == sorted((a or 0, t or "") for a, t, _ in rows)
    assert all(ids(r.ids) == library.encode_ordinary(r.decoded) and r.n_tokens == len(r.ids) // 4 for r in got)
    assert encode_documents(df.limit(0), PATH, P.PATTERN).collect() == []
    both = round_trip(df, PATH, P.PATTERN).collect()
    assert sorted(map(str, both)) == sorted(map(str, got)) and round_trip(df.limit(0), PATH, P.PATTERN).collect() == []


def test_query(spark, library):
    import __spark_entry__ as e
    got = {r.doc_id: r for r in e.queries()["op8_bpe_transducer"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = np.array(library.encode_ordinary(d.text or ""), "<u4")
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(want.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
