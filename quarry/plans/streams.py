"""Keyed streaming jobs run to completion on a replayable file source
(W1-W4, W8, K4, A19, P10).  Each query writes its input under the shared
scratch folder, drains it with ``availableNow`` and reads the sink back."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from quarry.plans.registry import query
from quarry.plans.relations import kv_lines
from quarry.session import scratch_path
from quarry.sources import eventlog as L
from quarry.streaming import keyed as K

N_CHUNKS = 4


def _replay(t):
    """The events in four chunks; each is written, then the stream takes it
    up from its checkpoint and drains it: four micro-batches."""
    base = scratch_path(t.spark, f"kv-{uuid.uuid4().hex}")
    for i, chunk in enumerate(K.chunks(kv_lines(t), N_CHUNKS, "event_id")):
        K.write_chunk(chunk, f"{base}/src/c{i:05d}")
        K.run_running_avg(t.spark, f"{base}/src/*", f"{base}/out", f"{base}/ckpt").awaitTermination()
    return base


def _out(df):
    return df.select("key", "arrival", F.round("avg", 6).alias("avg"), F.col("n").cast("long").alias("n"))


@query("split_key_value")
def q_split(t):
    """P10: parsed rows with an ok flag (bad rows kept for a reject output)."""
    return K.split_key_value(kv_lines(t))


@query("running_avg_by_key")
def q_running_batch(t):
    """Batch twin of the stateful stream."""
    p = K.split_key_value(kv_lines(t)).where("ok")
    return _out(K.running_avg_batch(p))


@query("stateful_running_avg")
def q_stateful(t):
    """One output per input row from keyed state, 4 micro-batches."""
    base = _replay(t)
    return _out(K.read_log(t.spark, f"{base}/out"))


@query("upsert_by_key")
def q_upsert(t):
    """K4: the last-write-wins table after all batches."""
    base = _replay(t)
    tab = K.VersionedTable(f"{base}/out/latest", "key", "arrival").read(t.spark)
    return tab.select("key", F.round("avg", 6).alias("avg"), F.col("n").cast("long").alias("n"))


@query("checkpointed_recovery")
def q_recovery(t):
    """Run on the first half of the events, undo the last commit of the
    sink as a driver that died there would leave it, add the rest and
    restart from the same checkpoint: the batch whose version is missing is
    applied again, and totals equal one uninterrupted run."""
    spark = t.spark
    base = scratch_path(spark, f"kv-{uuid.uuid4().hex}")
    first, second = K.chunks(kv_lines(t), 2, "event_id")
    src, out, ckpt = f"{base}/src/*", f"{base}/out", f"{base}/ckpt"
    K.write_chunk(first, f"{base}/src/a")
    K.run_running_avg(spark, src, out, ckpt).awaitTermination()
    K.forget_last_batch(spark, f"{out}/latest", ckpt)
    K.write_chunk(second, f"{base}/src/b")
    K.run_running_avg(spark, src, out, ckpt).awaitTermination()
    tab = K.VersionedTable(f"{out}/latest", "key", "arrival").read(spark)
    return tab.select("key", F.round("avg", 6).alias("avg"), F.col("n").cast("long").alias("n"))


LOG_PARTITIONS = 3


def _append(t, chunk, log):
    """A chunk of the events in a partitioned log, by key (the event's type)."""
    keyed = chunk.withColumn("key", F.split("value", ",")[1])
    return L.append(keyed, log, ["event_id"], LOG_PARTITIONS)


def _drain(t, base):
    """Take the log up from the checkpoint until its end is reached: a start
    that has to repeat a batch does only that and ends."""
    options = {"path": f"{base}/log", "partitions": str(LOG_PARTITIONS)}
    end = L.ends(t.spark, f"{base}/log")
    while True:
        q = K.run_running_avg(t.spark, None, f"{base}/out", f"{base}/ckpt", fmt=L.register(t.spark), options=options)
        q.awaitTermination()
        if q.lastProgress is None or L.reached(json.loads(q.lastProgress.json)["sources"][0]["endOffset"], end):
            return


@query("log_source_running_avg")
def q_log_source(t):
    """The running average over a partitioned log that grows by
    four appends; after each the stream goes on from its offsets."""
    base = scratch_path(t.spark, f"log-{uuid.uuid4().hex}")
    for chunk in K.chunks(kv_lines(t), N_CHUNKS, "event_id"):
        _append(t, chunk, f"{base}/log")
        _drain(t, base)
    return _out(K.read_log(t.spark, f"{base}/out"))


@query("log_source_recovery")
def q_log_recovery(t):
    """The last commit of a drained log is undone, more is appended
    and the query starts again: the offsets of the batch that is missing are
    read anew, and totals equal one uninterrupted run."""
    spark = t.spark
    base = scratch_path(spark, f"log-{uuid.uuid4().hex}")
    first, second = K.chunks(kv_lines(t), 2, "event_id")
    _append(t, first, f"{base}/log")
    _drain(t, base)
    K.forget_last_batch(spark, f"{base}/out/latest", f"{base}/ckpt")
    _append(t, second, f"{base}/log")
    _drain(t, base)
    tab = K.VersionedTable(f"{base}/out/latest", "key", "arrival").read(spark)
    return tab.select("key", F.round("avg", 6).alias("avg"), F.col("n").cast("long").alias("n"))
