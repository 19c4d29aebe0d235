import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from quarry.llm.tokens import WordIds
from quarry.llm.training_order import cut_sequences, indexes, materialise, read_shards, slots, write_shards

PATH = P.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 100, 1023, 1024, 1025, 70_000])
def test_slots_are_a_keyed_permutation(n):
    x = np.arange(n)
    s = slots(x, n, 7)
    assert sorted(s.tolist()) == x.tolist()
    assert indexes(s, n, 7).tolist() == x.tolist()
    if n > 100:
        assert (s != slots(x, n, 8)).mean() > 0.9
        assert abs(np.corrcoef(x, s)[0, 1]) < 0.2


def test_shards(spark):
    words = WordIds(PATH)
    rows = [(i, f"text number {i} " * (1 + i % 9), "s") for i in range(200)] + [(7, "twice", "s"), (7, "twice", "s"), (None, None, "s"), (None, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string")
    folder = write_shards(cut_sequences(df, PATH, length=8), key=3, length=8, stride=50)
    got = read_shards(spark, folder, stride=50).collect()
    n = len(got)
    assert sorted(r.slot for r in got) == list(range(n))
    assert all(r.shard == r.slot // 50 and r.place == r.slot % 50 and len(r.ids) == 16 for r in got)
    texts = {}
    for r in got:
        texts.setdefault(r.doc_id, []).append((r.piece, np.frombuffer(r.ids, "<u2")[:r.n_tokens].tolist()))
    for doc_id in range(200):
        if doc_id != 7:
            want = np.frombuffer(words.encode([rows[doc_id][1]])[0], "<u4").tolist() + [1]
            assert sum((p for _, p in sorted(texts[doc_id])), []) == want
    assert len(texts[None]) == 2
    part = read_shards(spark, folder, first=73, count=60, stride=50).collect()
    assert sorted(r.slot for r in part) == list(range(73, 133))
    assert read_shards(spark, folder, first=n - 5, stride=50).count() == 5
    # every shard is one file, in the order of its slots
    files = read_shards(spark, folder, stride=50).select("shard", F.input_file_name().alias("f")).distinct().groupBy("shard").count()
    assert files.where("count > 1").count() == 0
    again = materialise(df, PATH, key=3, length=8, stride=50).collect()
    assert sorted((r.slot, r.doc_id or -1, r.piece, bytes(r.ids)) for r in again) == sorted((r.slot, r.doc_id or -1, r.piece, bytes(r.ids)) for r in got)
    assert materialise(df.limit(0), PATH, key=3).collect() == []


def test_query(spark):
    import __spark_entry__ as e
    got = e.queries()["op2_training_order"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    assert {r.doc_id for r in got} == set(range(200))
    assert {r.record_bytes for r in got} == {2048}
