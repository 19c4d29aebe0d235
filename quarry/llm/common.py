"""Shared-folder tables and small helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import release, scratch_path, share_package  # noqa: F401 - release is taken from here

#: Bytes of payload after which a Python task hands a batch back to Spark.
BATCH_BYTES = 8 << 20

#: What separates words: ASCII space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back: its rows are
    derived once, and a lost executor costs a reread and nothing more."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text (null: none) as an array of strings."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def batches_out(schema: pa.Schema, rows: Iterable[tuple], size) -> Iterator[pa.RecordBatch]:
    """Row tuples as record batches of about ``BATCH_BYTES`` of payload;
    ``size(row)`` says what a row weighs."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 64 + size(row)
        if weight >= BATCH_BYTES:
            yield _batch(schema, held)
            held, weight = [], 0
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def label_fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5: fold 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


_memo: dict = {}


def only_memo(make: Callable, *args):
    """``make(*args)``, kept between the tasks of a worker process.  Workers
    outlive steps, so one of them keeps one memo: a step that asks for
    another lets go of the one before, and their sizes do not add up."""
    key = (make, *args)
    if key not in _memo:
        _memo.clear()
        _memo[key] = make(*args)
    return _memo[key]
