"""Nested question-answer JSON, written and read back flat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nest_qa(qa: DataFrame) -> DataFrame:
    """One JSON record per article: {title, paragraphs[{context, qas[{id,
    question, answers[{text, answer_start}]}]}]}.  Each record holds one
    document's questions only, so no group spans the whole data set."""
    answers = F.array(F.struct(F.col("answer").alias("text"), F.col("answer_start")))
    qas = qa.select("doc_id", "context", F.struct(F.col("qid").alias("id"), "question",
                                                  answers.alias("answers")).alias("q"))
    para = qas.groupBy("doc_id", "context").agg(F.array_sort(F.collect_list("q")).alias("qas"))
    return para.select(F.col("doc_id").cast("string").alias("title"),
                       F.array(F.struct("context", "qas")).alias("paragraphs"))


def write_nested_json(articles: DataFrame, path: str) -> None:
    articles.write.mode("overwrite").json(path)


def scan_nested_json(spark, path: str, multiline: bool = False,
                     wrapped: bool = False) -> DataFrame:
    """Read nested QA JSON and flatten to one row per answer with
    ``label = [start, start + len(text)]``.  ``wrapped`` handles the
    original single-file layout {"data": [article, ...]} (read with
    multiLine); the default reads one article per line."""
    df = spark.read.json(path, multiLine=multiline or wrapped)
    if wrapped:
        df = df.select(F.explode("data").alias("a")).select("a.*")
    p = df.select("title", F.explode("paragraphs").alias("p"))
    q = p.select("title", F.col("p.context").alias("context"), F.explode("p.qas").alias("q"))
    a = q.select("title", "context", F.col("q.id").alias("qid"), F.col("q.question").alias("question"),
                 F.explode("q.answers").alias("a"))
    start = F.col("a.answer_start")
    return a.select("title", "context", "qid", "question", F.col("a.text").alias("answer"),
                    start.alias("answer_start"),
                    F.array(start, start + F.length("a.text")).alias("label"))
