"""Streaming state vs its batch twin, restart, upsert sink, file round trips."""

import os

from pyspark.sql import functions as F

from quarry.sources import files as IO
from quarry.streaming import keyed as K


def _lines(spark, n=200):
    rows = [(f"{i},k{i % 3},{i % 17}", i) for i in range(n)] + [("bad,line", 10_000)]
    return spark.createDataFrame(rows, "value string, event_id long")


def test_stream_equals_batch_and_restart(spark, tmpdir_path):
    lines = _lines(spark)
    K.write_chunk(lines.where("event_id < 100"), f"{tmpdir_path}/src/a")
    q = K.run_running_avg(spark, f"{tmpdir_path}/src/*", f"{tmpdir_path}/out", f"{tmpdir_path}/ck")
    q.awaitTermination()
    K.forget_last_batch(spark, f"{tmpdir_path}/out/latest", f"{tmpdir_path}/ck")
    K.write_chunk(lines.where("event_id >= 100"), f"{tmpdir_path}/src/b")
    K.run_running_avg(spark, f"{tmpdir_path}/src/*", f"{tmpdir_path}/out", f"{tmpdir_path}/ck").awaitTermination()
    stream = {(r["key"], r["arrival"]): round(r["avg"], 9) for r in K.read_log(spark, f"{tmpdir_path}/out").collect()}
    batch = K.running_avg_batch(K.split_key_value(lines).where("ok"))
    want = {(r["key"], r["arrival"]): round(r["avg"], 9) for r in batch.collect()}
    assert stream == want and len(stream) == 200
    latest = K.VersionedTable(f"{tmpdir_path}/out/latest", "key", "arrival").read(spark)
    assert {r["key"]: r["n"] for r in latest.collect()} == {"k0": 67, "k1": 67, "k2": 66}


def test_sinks_and_sources(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    IO.write_json(df, f"{tmpdir_path}/j", "overwrite")
    IO.write_json(df, f"{tmpdir_path}/j", "append")
    IO.write_json(df, f"{tmpdir_path}/j", "ignore")
    assert IO.scan_jsonl(spark, f"{tmpdir_path}/j").count() == 4
    try:
        IO.write_json(df, f"{tmpdir_path}/j", "error")
        raise AssertionError("error mode must refuse an existing folder")
    except Exception as ex:  # noqa: BLE001
        assert "already exists" in str(ex) or "PATH_ALREADY_EXISTS" in str(ex)
    IO.write_tsv(df, f"{tmpdir_path}/t")
    back = spark.read.csv(f"{tmpdir_path}/t", sep="\t").collect()
    assert sorted(tuple(r) for r in back) == [("1", "a"), ("2", "b")]


def test_line_number_keyed(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "tags.txt")
    with open(p, "w") as f:
        f.write("1 2 3\n#\n7\n")
    got = [(r["line_no"], r["items"]) for r in IO.scan_line_number_keyed(spark, p).orderBy("line_no").collect()]
    assert got == [(0, ["1", "2", "3"]), (1, []), (2, ["7"])]


def test_line_numbers_over_splits(spark, tmpdir_path):
    """One file read in many byte ranges, and a folder of files by name."""
    lines = [" ".join(str(x) for x in range(i % 7)) or "#" for i in range(400)]
    want = [(i, [] if v == "#" else v.split()) for i, v in enumerate(lines)]
    one, many = os.path.join(tmpdir_path, "one.txt"), os.path.join(tmpdir_path, "many")
    os.mkdir(many)
    with open(one, "w") as f:
        f.write("\n".join(lines))
    for k in range(4):
        with open(f"{many}/part-{k}.txt", "w") as f:
            f.write("".join(v + "\n" for v in lines[100 * k:100 * k + 100]))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert spark.read.text(one).rdd.getNumPartitions() > 5
        for path in (one, many):
            assert sorted(tuple(r) for r in IO.scan_line_number_keyed(spark, path).collect()) == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_nested_json_wrapped(spark, tmpdir_path):
    import json
    from quarry.sources.nested import scan_nested_json
    doc = {"data": [{"title": "t", "paragraphs": [{"context": "abc def", "qas": [
        {"id": "q1", "question": "what?", "answers": [{"text": "def", "answer_start": 4}]}]}]}]}
    p = os.path.join(tmpdir_path, "qa.json")
    with open(p, "w") as f:
        json.dump(doc, f)
    r = scan_nested_json(spark, p, wrapped=True).first()
    assert (r["qid"], r["answer"], list(r["label"])) == ("q1", "def", [4, 7])


def test_processing_time_trigger_and_quota(spark, tmpdir_path):
    """Continuous micro-batches every 2 seconds; W6: at most n keys per
    batch handled by the per-batch action."""
    lines = _lines(spark, 60)
    for i, chunk in enumerate(K.chunks(lines, 2, "event_id")):
        K.write_chunk(chunk, f"{tmpdir_path}/src/c{i}")
    q = K.run_running_avg(spark, f"{tmpdir_path}/src/*", f"{tmpdir_path}/out", f"{tmpdir_path}/ck",
                          trigger={"processingTime": "2 seconds"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    log = K.read_log(spark, f"{tmpdir_path}/out")
    assert log.count() == 60
    assert K.take_per_batch(log, 2).count() == 2


def test_upsert_survives_replay(spark, tmpdir_path):
    def batch(*rows):
        return spark.createDataFrame(rows, "key string, arrival long, v int")

    def state():
        return {r["key"]: r["v"] for r in tab.read(spark).collect()}
    tab = K.VersionedTable(f"{tmpdir_path}/t", "key", "arrival")
    assert tab.upsert(batch(("a", 1, 1), ("b", 1, 2)), 0)
    one = batch(("b", 2, 20), ("c", 2, 3))
    # a first attempt that died before its commit
    one.write.parquet(tab.path(1))
    os.remove(f"{tab.path(1)}/_SUCCESS")
    assert tab.versions(spark) == [0] and state() == {"a": 1, "b": 2}
    assert tab.upsert(one, 1) and state() == {"a": 1, "b": 20, "c": 3}
    assert not tab.upsert(one, 1) and state() == {"a": 1, "b": 20, "c": 3}
    try:
        tab.upsert(one, 0 - 1)
        raise AssertionError("an older batch was taken")
    except ValueError:
        pass
    # a committed version that cannot be read is an error, not an empty table
    for name in os.listdir(tab.path(1)):
        if name.endswith(".parquet"):
            with open(f"{tab.path(1)}/{name}", "wb") as f:
                f.write(b"not parquet")
    try:
        tab.upsert(batch(("z", 3, 1)), 2)
        raise AssertionError("a damaged table was taken for an empty one")
    except Exception as ex:  # noqa: BLE001
        assert not isinstance(ex, AssertionError)


def test_upsert_writes_what_changed(spark, tmpdir_path):
    """A batch costs its own rows and its share of compactions; dead runs go."""
    import random
    rnd = random.Random(4)
    tab = K.VersionedTable(f"{tmpdir_path}/log", "key", "arrival", buckets=3, fan=3)
    written, write = [], tab._write
    tab._write = lambda rows, run, level: written.append(write(rows, run, level)) or written[-1]
    want, keys = {}, [f"k{i}" for i in range(300)] + [None]
    for b in range(12):
        rows = [(rnd.choice(keys), rnd.randrange(50), rnd.randrange(1000)) for _ in range(0 if b == 7 else 300 if b == 0 else 10)]
        changed = {}
        for k, at, v in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
            changed.setdefault(k, []).append((at, v))
        for k, held in changed.items():
            want[k] = {v for at, v in held if at == max(a for a, _ in held)}
        df = spark.createDataFrame(rows, "key string, arrival long, v int")
        assert tab.upsert(df, b) and not tab.upsert(df, b)
        got = {r["key"]: r["v"] for r in tab.read(spark).collect()}
        assert got.keys() == want.keys() and all(got[k] in want[k] for k in got)
        assert len(tab.runs(spark, b)) <= 2 * 3
    small = [r.n_rows for r in written if r.level == 0]
    assert small[0] <= 300 and all(n <= 10 for n in small[1:])
    assert sum(r.n_rows for r in written) < 12 * len(want) / 3       # a rewrite of the table per batch is 12 times its rows
    live = {r.run for v in tab.versions(spark)[-2:] for r in tab.runs(spark, v)}
    assert set(os.listdir(f"{tmpdir_path}/log/runs")) <= live


def test_whole_files_are_written_by_many_tasks(spark, tmpdir_path):
    from quarry.plans.io import q_scan_wholetext
    from quarry.tables import Tables

    rows = [(i, "x" * (i % 7)) for i in range(400)] + [(5, "again"), (400, None)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmpdir_path}/documents.parquet")
    found = q_scan_wholetext(Tables(spark, tmpdir_path))
    tasks = {os.path.basename(f).split("-")[1] for f in found.inputFiles()}
    assert len(tasks) > 1
    got = {r.doc_id: r.n_chars for r in found.collect()}
    assert got == {i: i % 7 + 1 + 6 * (i == 5) for i in range(400)} | {400: 1}
