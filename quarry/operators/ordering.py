"""Global positions and running sums over a total order.

Rows are range partitioned and sorted, every partition numbers or sums its
own rows while it is at it, and the totals of the partitions (one row
each) become offsets.  One shuffle, no window over a single partition and
no second exchange by a few partition numbers.
"""

from __future__ import annotations

import itertools
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path


def running_before(df: DataFrame, order: list, weight: str | None, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``weight`` (None: the number of
    rows) over all rows before this one in ``order``."""
    return running_sums(df, order, {name: weight})


def running_sums(df: DataFrame, order: list, sums: dict[str, str | None]) -> DataFrame:
    """``df`` with a column for each of ``sums`` (name -> integer column, or
    None for 1): its sum over all rows before this one in ``order``, which
    must be total.  Nulls weigh nothing."""
    spark = df.sparkSession
    names = list(sums)
    source = df.withColumns({f"_w{i}": (F.lit(1) if sums[n] is None else F.coalesce(F.col(sums[n]), F.lit(0))).cast("long") for i, n in enumerate(names)})
    extra = [T.StructField("_part", T.IntegerType()), *[T.StructField(f"_b{i}", T.LongType()) for i in range(len(names))]]
    schema = T.StructType([*source.schema.fields, *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, totals = TaskContext.get().partitionId(), [0] * len(names)
        for batch in batches:
            before = []
            for i in range(len(names)):
                w = batch.column(batch.schema.get_field_index(f"_w{i}")).to_numpy(zero_copy_only=False)
                before.append(pa.array(totals[i] + w.cumsum() - w, pa.int64()))
                totals[i] += int(w.sum())
            columns = [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), *before]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_part", *[f"_b{i}" for i in range(len(names))]])

    path = os.path.join(scratch_path(spark, "running"), uuid.uuid4().hex)
    source.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema).write.parquet(path)
    numbered = spark.read.schema(schema).parquet(path)
    totals = sorted(numbered.groupBy("_part").agg(*[F.sum(f"_w{i}").alias(f"_t{i}") for i in range(len(names))]).collect())
    starts = [[0, *itertools.accumulate(r[f"_t{i}"] for r in totals)] for i in range(len(names))]
    rows = [(r["_part"], *[s[k] for s in starts]) for k, r in enumerate(totals)]
    offsets = spark.createDataFrame(rows, ", ".join(["_part int", *[f"_s{i} long" for i in range(len(names))]]))
    joined = numbered.join(F.broadcast(offsets), "_part")      # one row per partition
    found = joined.withColumns({n: F.col(f"_s{i}") + F.col(f"_b{i}") for i, n in enumerate(names)})
    return found.drop("_part", *[f"_{c}{i}" for c in "wbs" for i in range(len(names))])


def global_row_number(df: DataFrame, order: list, name: str = "rn") -> DataFrame:
    """Exact 1-based position of every row in a total ``order``."""
    return running_sums(df, order, {name: None}).withColumn(name, F.col(name) + 1)


def global_cumsum_before(df: DataFrame, order: list, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows strictly before each row in ``order``."""
    return running_sums(df, order, {name: value})
