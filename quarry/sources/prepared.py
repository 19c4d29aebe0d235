"""Prepared sets kept with their vocabularies (K5).

Ids mean nothing without the vocabulary they were made with.  A saved
vocabulary or set is a Parquet table beside a manifest, written last, that
holds the content hash of the table and, for a set, the hashes of its
vocabularies.  Loading compares them: a table that was changed or half
written, a set beside a vocabulary of other content, or one that lacks a
vocabulary is refused.  Everything goes through Spark and its file systems.
"""

from __future__ import annotations

import hashlib
import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "role string, name string, content string, columns string"


class Mismatch(ValueError):
    """What was loaded is not what was saved together."""


class Saved(NamedTuple):
    path: str
    content: str


def content_hash(df: DataFrame) -> str:
    """Hash of the columns' names and types and of the rows as a multiset:
    the order of rows, files and partitions does not matter.  One pass with
    a partial aggregate; columns may hold anything but maps."""
    columns = sorted(df.columns)
    row = [F.col(c).isNull() for c in columns] + [F.col(c) for c in columns]      # a null leaves the hash as it is
    one, two = F.xxhash64(*row), F.xxhash64(F.lit(1), *row)
    total = df.agg(F.count(F.lit(1)).alias("n"), F.sum(one.cast("decimal(38,0)")).alias("a"), F.sum(two.cast("decimal(38,0)")).alias("b")).first()
    types = [f"{c} {df.schema[c].dataType.simpleString()}" for c in columns]
    return hashlib.sha256("\n".join([*types, str(total["n"]), str(total["a"]), str(total["b"])]).encode()).hexdigest()


def _done(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/_SUCCESS")
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def _save(df: DataFrame, path: str, role: str, ties: dict[str, Saved]) -> Saved:
    spark = df.sparkSession
    if _done(spark, path):
        raise FileExistsError(path)
    df.write.mode("overwrite").parquet(f"{path}/rows")
    content = content_hash(spark.read.schema(df.schema).parquet(f"{path}/rows"))
    lines = [(role, "", content, df.schema.json()), *[("needs", name, v.content, "") for name, v in ties.items()]]
    spark.createDataFrame(lines, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    return Saved(path, content)


def _load(spark: SparkSession, path: str, role: str) -> tuple[DataFrame, Saved, dict[str, str]]:
    if not _done(spark, path):
        raise FileNotFoundError(f"{path}: nothing saved, or its write did not end")
    lines = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").collect()       # a row per vocabulary
    own = [r for r in lines if r["role"] == role]
    if len(own) != 1:
        raise Mismatch(f"{path} holds no {role}")
    df = spark.read.schema(StructType.fromJson(json.loads(own[0]["columns"]))).parquet(f"{path}/rows")
    if content_hash(df) != own[0]["content"]:
        raise Mismatch(f"{path}: the rows are not those that were saved")
    return df, Saved(path, own[0]["content"]), {r["name"]: r["content"] for r in lines if r["role"] == "needs"}


def save_vocabulary(vocab: DataFrame, path: str) -> Saved:
    """Write a vocabulary to ``path``, which must be new."""
    return _save(vocab, path, "vocabulary", {})


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return _load(spark, path, "vocabulary")[0]


def save_prepared(df: DataFrame, path: str, vocabularies: dict[str, Saved]) -> Saved:
    """Write a set whose ids were made with ``vocabularies`` (by name)."""
    return _save(df, path, "set", vocabularies)


def load_prepared(spark: SparkSession, path: str, vocabularies: dict[str, str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The set of ``path`` and its vocabularies from the paths given, if all
    are those that were saved with it."""
    df, _, needs = _load(spark, path, "set")
    if set(needs) != set(vocabularies):
        raise Mismatch(f"{path} was made with {sorted(needs)}, not {sorted(vocabularies)}")
    found = {}
    for name, where in vocabularies.items():
        found[name], saved, _ = _load(spark, where, "vocabulary")
        if saved.content != needs[name]:
            raise Mismatch(f"{path} was not made with the {name} vocabulary of {where}")
    return df, found
