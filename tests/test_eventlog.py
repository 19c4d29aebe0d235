"""The partitioned log: offsets, commits and restarts."""

import glob
import json
import os

from pyspark.sql import functions as F

from quarry.sources import eventlog as L

ROWS = "i long, key string, value string"


def rows(spark, numbers, keys):
    return spark.createDataFrame([(i, keys[i % len(keys)], f"v{i}") for i in numbers], ROWS)


def keys_of(spark, partitions):
    """A key for each partition."""
    df = spark.range(200).select(F.col("id").cast("string").alias("k"))
    found = df.select("k", F.pmod(F.xxhash64("k"), F.lit(partitions)).alias("p")).collect()
    return [next(r.k for r in found if r.p == p) for p in range(partitions)]


def drain(spark, log, out, ckpt, partitions, **options):
    s = spark.readStream.format(L.register(spark)).option("path", log).option("partitions", str(partitions)).options(**options).load()
    q = s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()


def position(ckpt):
    last = max((f for f in glob.glob(f"{ckpt}/offsets/*") if os.path.basename(f).isdigit()), key=lambda f: int(os.path.basename(f)))
    return json.loads(open(last).read().splitlines()[2])


def test_partitions_go_on_apart(spark, tmpdir_path):
    log, out, ckpt = (f"{tmpdir_path}/{x}" for x in ("log", "out", "ckpt"))
    a, b = keys_of(spark, 2)
    assert L.append(rows(spark, range(10), [a, b]), log, ["i"], 2) == 1
    drain(spark, log, out, ckpt, 2)
    assert position(ckpt) == {"0": 5, "1": 5}
    assert L.append(rows(spark, range(10, 17), [a]), log, ["i"], 2) == 2
    drain(spark, log, out, ckpt, 2, rowsPerTask="2")
    assert position(ckpt) == {"0": 12, "1": 5} and L.ends(spark, log) == {0: 12, 1: 5}
    got = spark.read.parquet(out).collect()
    want = {(0, n, a, f"v{i}") for n, i in enumerate([0, 2, 4, 6, 8, *range(10, 17)])} | {(1, n, b, f"v{i}") for n, i in enumerate([1, 3, 5, 7, 9])}
    assert len(got) == 17 and {(r.partition, r.offset, r.key, r.value) for r in got} == want
    assert L.reached(json.dumps(position(ckpt)), {0: 12, 1: 5}) and not L.reached(position(ckpt), {0: 12, 1: 6}) and not L.reached(None, {0: 1})
    before = len(glob.glob(f"{ckpt}/commits/*"))
    drain(spark, log, out, ckpt, 2)                       # nothing new
    assert spark.read.parquet(out).count() == 17 and len(glob.glob(f"{ckpt}/commits/*")) == before


def test_only_committed_batches_count(spark, tmpdir_path):
    log, out, ckpt = (f"{tmpdir_path}/{x}" for x in ("log", "out", "ckpt"))
    L.append(rows(spark, range(6), ["a", "b", "c"]), log, ["i"], 2)
    L.append(rows(spark, range(6, 9), ["a", "b", "c"]), log, ["i"], 2)
    os.remove(f"{log}/ends/b00000002/_SUCCESS")            # as a writer that died leaves it
    drain(spark, log, out, ckpt, 2)
    assert spark.read.parquet(out).count() == 6
    assert L.append(rows(spark, range(6, 10), ["a", "b", "c"]), log, ["i"], 2) == 2     # appended anew
    drain(spark, log, out, ckpt, 2)
    got = spark.read.parquet(out).collect()
    assert sorted(r.value for r in got) == sorted(f"v{i}" for i in range(10))
    assert all(sorted(r.offset for r in got if r.partition == p) == list(range(sum(r.partition == p for r in got))) for p in (0, 1))


def test_offsets_read_again_are_the_same_rows(spark, tmpdir_path):
    log = f"{tmpdir_path}/log"
    L.append(spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "k", "")], ROWS), log, ["i"], 1)
    L.append(rows(spark, range(4, 9), ["k"]), log, ["i"], 1)
    L.append(rows(spark, [], ["k"]), log, ["i"], 1)
    reader = L.LogReader(log, 1, 2)
    assert reader.latestOffset() == {"0": 8}

    def read(start, end):
        return [r for p in reader.partitions({"0": start}, {"0": end}) for batch in reader.read(p) for r in batch.to_pylist()]
    all_rows = read(0, 8)
    assert [r["offset"] for r in all_rows] == list(range(8)) and [r["key"] for r in all_rows[:3]] == [None, None, "k"]
    assert read(2, 6) == all_rows[2:6] and read(5, 5) == []
    assert L.LogReader(f"{tmpdir_path}/none", 2, 2).latestOffset() == {"0": 0, "1": 0}
