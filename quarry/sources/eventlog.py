"""A partitioned log as a streaming source.

Records are appended in batches and dealt to partitions by key; in its
partition each has an offset, one more than the one before.  A batch
counts once its manifest (first and next offset by partition), written
last by Spark, is complete.  The stream takes the committed end of every
partition as its position, so partitions go on apart from each other, a
restart goes on from the offsets of its checkpoint, and offsets that were
handed out but not committed by the query are read again, the same rows.

    <root>/records/b00000001/partition=0/*.parquet   offset, key, value
    <root>/ends/b00000001/*.parquet                  partition, first, next
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from quarry.operators.ordering import running_sums

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # workers may not have this package

FORMAT = "partitioned_log"
RECORDS = "partition int, offset long, key string, value string"
ENDS = "partition int, first long, next long"
ROWS_A_TASK = 1 << 20


# ------------------------------------------------------------------ writing

def _committed(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the batches whose manifest is complete, rising."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{root}/ends")
    file_system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not file_system.exists(folder):
        return []
    found = [s.getPath() for s in file_system.listStatus(folder)]
    return sorted(int(p.getName()[1:]) for p in found if file_system.exists(hadoop.Path(p, "_SUCCESS")))


def ends(spark: SparkSession, root: str) -> dict[int, int]:
    """The next offset of each partition that has records."""
    done = _committed(spark, root)
    if not done:
        return {}
    manifests = spark.read.schema(ENDS).parquet(*[f"{root}/ends/b{b:08d}" for b in done])
    return {r["partition"]: r["next"] for r in manifests.groupBy("partition").agg(F.max("next").alias("next")).collect()}


def reached(position: str | dict | None, end: dict[int, int]) -> bool:
    """Whether a query's position (as its progress gives it) is at ``end``."""
    at = json.loads(position) if isinstance(position, str) else position or {}
    return all(at.get(str(p), 0) >= n for p, n in end.items())


def append(df: DataFrame, root: str, order: list[str], partitions: int, key: str = "key", value: str = "value") -> int:
    """Append the rows of ``df`` as one batch and return its number.  Keys
    (null is one, too) decide the partition, ``order`` (which names a row)
    the offsets.  A batch that died before its manifest was complete left
    nothing that is read; it is appended anew.  One writer at a time."""
    spark = df.sparkSession
    batch = next(reversed(_committed(spark, root)), 0) + 1
    dealt = df.withColumn("_partition", F.pmod(F.xxhash64(F.col(key)), F.lit(partitions)).cast("int"))
    placed = running_sums(dealt, ["_partition", *order], {"_row": None})
    firsts = placed.groupBy("_partition").agg(F.min("_row").alias("_first"))
    held = spark.createDataFrame([(p, n) for p, n in ends(spark, root).items()], "_partition int, _next long")      # a row per partition
    firsts = firsts.join(held, "_partition", "left").select("_partition", (F.coalesce("_next", F.lit(0)) - F.col("_first")).alias("_shift"))
    offset = (F.col("_row") + F.col("_shift")).alias("offset")
    rows = placed.join(firsts, "_partition").select(F.col("_partition").alias("partition"), offset, F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))
    path = f"{root}/records/b{batch:08d}"
    (rows.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset")
     .write.mode("overwrite").partitionBy("partition").parquet(path))
    written = spark.read.schema(RECORDS).parquet(path)
    manifest = written.groupBy("partition").agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("next"))
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{root}/ends/b{batch:08d}")
    return batch


# ------------------------------------------------------------------ reading

class Offsets(InputPartition):
    """Offsets ``first`` to ``end`` - 1 of one partition, all of one batch."""

    def __init__(self, partition: int, first: int, end: int, folder: str):
        self.partition, self.first, self.end, self.folder = partition, first, end, folder


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class LogReader(DataSourceStreamReader):
    def __init__(self, root: str, partitions: int, rows_a_task: int):
        self.root, self.n, self.rows_a_task = root.rstrip("/"), partitions, rows_a_task

    def manifests(self) -> Iterator[tuple[str, int, int, int]]:
        """(batch, partition, first, next) of every committed batch."""
        files, root = _opened(self.root)
        for entry in sorted(files.get_file_info(fs.FileSelector(f"{root}/ends", allow_not_found=True)), key=lambda e: e.base_name):
            if files.get_file_info(f"{entry.path}/_SUCCESS").type != fs.FileType.NotFound:
                for row in ds.dataset(entry.path, filesystem=files, format="parquet").to_table().to_pylist():
                    yield entry.base_name, row["partition"], row["first"], row["next"]

    def initialOffset(self) -> dict:
        return {str(p): 0 for p in range(self.n)}

    def latestOffset(self) -> dict:
        at = self.initialOffset()
        for _, partition, _, end in self.manifests():
            at[str(partition)] = max(at.get(str(partition), 0), end)
        return at

    def partitions(self, start: dict, end: dict) -> list[Offsets]:
        out = []
        for batch, partition, first, following in self.manifests():
            low, high = max(first, start.get(str(partition), 0)), min(following, end.get(str(partition), 0))
            for at in range(low, high, self.rows_a_task):
                out.append(Offsets(partition, at, min(at + self.rows_a_task, high), f"{self.root}/records/{batch}/partition={partition}"))
        return out

    def read(self, partition: Offsets) -> Iterator[pa.RecordBatch]:
        files, path = _opened(partition.folder)
        wanted = (ds.field("offset") >= partition.first) & (ds.field("offset") < partition.end)
        for batch in ds.dataset(path, filesystem=files, format="parquet").to_batches(columns=["offset", "key", "value"], filter=wanted):
            if batch.num_rows:
                own = pa.array([partition.partition] * batch.num_rows, pa.int32())
                columns = [own, batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), batch.column(2).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["partition", "offset", "key", "value"])

    def commit(self, end: dict) -> None:
        pass            # records stay in the log


class PartitionedLog(DataSource):
    """``readStream.format("partitioned_log")`` with the options path,
    partitions (as many as the log has) and rowsPerTask."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORDS

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options["path"], int(self.options["partitions"]), int(self.options.get("rowspertask", ROWS_A_TASK)))


def register(spark: SparkSession) -> str:
    """Make the format known to a session; returns its name."""
    spark.dataSource.register(PartitionedLog)
    return FORMAT
