"""Token counts as delta-maintained rollups.

A batch of changes (insert, revise, delete of documents) becomes signed
rows: an insert adds one document and its tokens under its source,
language and tokenizer version; a delete takes off what the ledger holds
for the document; a revised count takes off the old and adds the new.
Totals are the last batch's totals plus the sum of the signed rows, so
a batch costs what changed and no recount.

A batch is committed by its totals folder, which Spark's committer marks
as the last thing it does.  Committing a batch id again changes nothing;
a batch that broke off is written anew from the last committed batch
before it, as if it had never begun.  Batch ids must come in rising order.

Null sources, languages and versions are groups of their own.  A null
doc_id can be inserted, and no delete or revision meets it; a repeated row
counts as often as it is inserted, and a delete takes off all of them.
Deletes of unknown documents do nothing; a revision of one is an insert.
Null token counts are zero.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import batches_out
from quarry.llm.tokens import split_words, word_ids

GROUP = ["source", "lang", "tokenizer"]
LEDGER = "doc_id long, source string, lang string, tokenizer string, docs long, tokens long"
TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"
COUNTED = "doc_id long, source string, lang string, tokenizer string, tokens long"


def count_tokens(df: DataFrame, tokenizers: dict[str, str | None]) -> DataFrame:
    """A row per document and version: its token count.  ``tokenizers``:
    version -> file of the ``tokenizers`` library, or None for white-space words."""
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("lang", pa.string()), ("tokenizer", pa.string()), ("tokens", pa.int64())])

    def rows(batches):
        for batch in batches:
            keys = list(zip(*[c.to_pylist() for c in batch.columns[:-1]], strict=True))
            for i in range(0, len(keys), 256):
                texts = [t or "" for t in batch.column(batch.num_columns - 1).slice(i, 256).to_pylist()]
                for version, path in tokenizers.items():
                    counts = [len(split_words(t)) for t in texts] if path is None else [len(x) // 4 for x in word_ids(path).encode(texts)]
                    for key, n in zip(keys[i:i + 256], counts, strict=True):
                        yield *key, version, n

    def run(batches):
        yield from batches_out(schema, rows(batches), lambda r: 60)

    read = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "text")
    return read.mapInArrow(run, COUNTED)


class TokenRollup:
    """Rollups and their ledger below ``folder`` (a shared path)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, kind: str, batch: int) -> str:
        return f"{self.folder}/{kind}/batch-{batch:012d}"

    def committed(self) -> list[int]:
        """Ids of the committed batches, rising."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(f"{self.folder}/totals")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found = [s.getPath() for s in fs.listStatus(root)]
        return sorted(int(p.getName().rpartition("-")[2]) for p in found if fs.exists(hadoop.Path(p, "_SUCCESS")))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs and tokens after the last committed batch."""
        done = self.committed()
        if not done:
            return self.spark.createDataFrame([], TOTALS)
        return self.spark.read.schema(TOTALS).parquet(self._path("totals", done[-1]))

    def ledger(self) -> DataFrame:
        """Signed rows of all committed batches."""
        done = self.committed()
        if not done:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(*[self._path("ledger", b) for b in done])

    def commit(self, batch: int, inserts: DataFrame | None = None, revised: DataFrame | None = None, deletes: DataFrame | None = None) -> bool:
        """Apply a batch: ``inserts`` and ``revised`` as ``count_tokens``
        gives them, ``deletes`` with a doc_id.  False if it was committed before."""
        done = self.committed()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after batch {done[-1]}")
        signed = self.spark.createDataFrame([], LEDGER)
        if inserts is not None:
            signed = signed.unionByName(_plus(inserts))
        if revised is not None:
            # only the revised versions of a document are replaced
            signed = signed.unionByName(_plus(revised)).unionByName(self._minus(revised.select("doc_id", "tokenizer")))
        if deletes is not None:
            signed = signed.unionByName(self._minus(deletes.select(F.col("doc_id").cast("long").alias("doc_id"))))
        signed.write.mode("overwrite").parquet(self._path("ledger", batch))
        written = self.spark.read.schema(LEDGER).parquet(self._path("ledger", batch))
        summed = written.select(*GROUP, "docs", "tokens").unionByName(self.totals())
        new = summed.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where((F.col("docs") != 0) | (F.col("tokens") != 0))
        new.write.mode("overwrite").parquet(self._path("totals", batch))
        return True

    def _minus(self, keys: DataFrame) -> DataFrame:
        """What the ledger holds for the keys, with the signs turned."""
        held = self.ledger().join(keys.distinct(), keys.columns, "left_semi")
        sums = held.groupBy("doc_id", *GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where((F.col("docs") != 0) | (F.col("tokens") != 0)).select(
            "doc_id", *GROUP, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))


def _plus(counted: DataFrame) -> DataFrame:
    return counted.select("doc_id", *GROUP, F.lit(1).cast("long").alias("docs"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))


def cleaned(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a cleaning pass changes: the doc_ids of texts that a smaller
    doc_id has word for word, and the other documents with repeated lines,
    whose text keeps the first of each."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text.cast("binary"), 256).alias("h"))
    first = hashed.groupBy("h").agg(F.min("doc_id").alias("first"))
    gone = hashed.join(first, "h").where(F.col("doc_id") > F.col("first")).select("doc_id")
    lines = F.split(text, "\n")
    shorter = df.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.when(F.size(F.array_distinct(lines)) < F.size(lines), F.array_join(F.array_distinct(lines), "\n")).alias("text"))
    return gone, shorter.where(F.col("text").isNotNull()).join(gone, "doc_id", "left_anti")
