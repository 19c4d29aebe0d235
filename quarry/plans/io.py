"""Source and sink round trips on the driver's tables (S1-S3, S5-S7, S10,
S15, K1, K2, K6, P14, P15, P26-P28).  Each writes under the shared
scratch folder and reads the data back through the source under test."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators.relational import sum_by_key
from quarry.plans.registry import query
from quarry.plans.relations import baskets, edge_stream, housing, tag_lines, votes
from quarry.session import scratch_path
from quarry.sources import files as IO


def _tmp(t, name):
    return scratch_path(t.spark, f"{name}-{uuid.uuid4().hex}")


@query("scan_text")
def q_scan_text(t):
    """Documents written as text, read back one row per line."""
    p = _tmp(t, "text")
    t.documents.select("text").write.text(p)
    return IO.scan_text(t.spark, p)


@query("scan_jsonl")
def q_scan_jsonl(t):
    """Ballots as JSON lines, schema inferred on the way back."""
    p = _tmp(t, "jsonl")
    votes(t).write.json(p)
    return IO.scan_jsonl(t.spark, p).select("candidate_name", "precinct_code", "total_votes")


@query("scan_csv")
def q_scan_csv(t):
    """S3: housing columns as CSV with a header, types inferred."""
    p = _tmp(t, "csv")
    cols = ["order_id", "line_no", "total_rooms", "total_bedrooms", "ocean_proximity"]
    IO.write_csv(housing(t).select(*cols), p)
    return IO.scan_csv(t.spark, p).select(
        F.col("order_id").cast("long").alias("order_id"), F.col("line_no").cast("int").alias("line_no"),
        F.col("total_rooms").cast("double").alias("total_rooms"),
        F.col("total_bedrooms").cast("double").alias("total_bedrooms"), "ocean_proximity")


@query("scan_delimited_edges")
def q_scan_edges(t):
    """S5: "u v t" edge lines, the third field ignored."""
    p = _tmp(t, "edges")
    edge_stream(t).select(F.concat_ws(" ", "u", "v", "t").alias("value")).write.text(p)
    return IO.scan_delimited_edges(t.spark, p)


@query("scan_baskets")
def q_scan_baskets(t):
    """One basket per line of item ids."""
    p = _tmp(t, "baskets")
    b = baskets(t).groupBy("basket").agg(F.array_join(F.array_sort(F.collect_list("item")), " ").alias("value"))
    b.select("value").write.text(p)
    return IO.scan_baskets(t.spark, p).select(F.array_join("items", " ").alias("items"))


@query("scan_wholetext")
def q_scan_wholetext(t):
    """One file per document (partition folders by id), read whole."""
    p = _tmp(t, "whole")
    IO.write_wholetext(t.documents.select("doc_id", "text"), "doc_id", p)
    w = IO.scan_wholetext(t.spark, p)
    return w.select(F.regexp_extract("file", r"doc_id=(\d+)", 1).cast("long").alias("doc_id"),
                    F.length("text").alias("n_chars"))


@query("scan_line_number_keyed")
def q_scan_lines(t):
    """Tag lines written in order of their part, keyed by line number."""
    p = _tmp(t, "tag-lines")
    tag_lines(t).repartitionByRange("id").sortWithinPartitions("id").select("line").write.text(p)
    found = IO.scan_line_number_keyed(t.spark, p)
    return found.select("line_no", F.array_join("items", " ").alias("tags"), F.size("items").alias("n_tags"))


@query("scan_keyed_table")
def q_scan_keyed(t):
    """Column pruning + equality pushdown into the Parquet scan."""
    return IO.scan_keyed_table(t.spark, f"{t.sf_dir}/orders.parquet", ["o_orderkey", "o_totalprice"],
                               {"o_orderstatus": "F"})


@query("chunk_lines")
def q_chunk_lines(t):
    """Every 5 lines of each document joined by a blank (blank lines
    count but add no text)."""
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "value"))
    return IO.chunk_lines(lines, "doc_id", "line_no", 5)


@query("write_json")
def q_write_json(t):
    """K1: overwrite then append the per-candidate totals; ignore mode
    leaves the folder as it is."""
    p = _tmp(t, "json")
    per = sum_by_key(votes(t), "candidate_name", F.col("total_votes").try_cast("bigint"), "votes")
    IO.write_json(per, p, "overwrite")
    IO.write_json(per, p, "append")
    IO.write_json(per.limit(1), p, "ignore")
    return IO.scan_jsonl(t.spark, p, "candidate_name string, votes long")


@query("write_csv")
def q_write_csv(t):
    """K2: category averages as CSV with a header, read back."""
    p = _tmp(t, "csvout")
    g = housing(t).groupBy("ocean_proximity").agg(F.round(F.avg("median_house_value"), 6).alias("avg_value"))
    IO.write_csv(g, p)
    return IO.scan_csv(t.spark, p)


@query("serialise_record")
def q_serialise(t):
    """K6: order records as (key, JSON text) messages."""
    o, c = t.orders, t.customer
    o = o.join(c, o["o_custkey"] == c["c_custkey"])
    rec = o.select(F.col("o_orderkey").alias("id"),
                   F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("text"),
                   F.lit("en").alias("lang"),
                   F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                            F.col("c_nationkey").alias("followersCount")).alias("user"),
                   (F.col("o_orderkey") % 7).cast("int").alias("retweetCount"))
    return IO.serialise_record(rec, "id")


@query("parse_json_record")
def q_parse_json(t):
    """The messages parsed back, camelCase names mapped."""
    msgs = q_serialise(t)
    schema = ("id long, text string, lang string, user struct<id: long, name: string, "
              "followersCount: int>, retweetCount int")
    p = IO.parse_json_record(msgs, schema, {"retweetCount": "retweet_count"})
    return p.select("id", "text", F.col("user.id").alias("user_id"), F.col("user.name").alias("user_name"),
                    F.col("user.followersCount").alias("followers_count"), "retweet_count")


@query("fill_missing")
def q_fill_missing(t):
    """Missing bedroom counts -> 0."""
    return housing(t).select("order_id", "line_no", "total_bedrooms").fillna(0.0, ["total_bedrooms"])


@query("drop_missing_in_column")
def q_drop_missing(t):
    """Rows whose bedroom count is present."""
    h = housing(t)
    return h.where(F.col("total_bedrooms").isNotNull()).select("order_id", "line_no", "total_bedrooms")


@query("show_head")
def q_show_head(t):
    """First 20 rows in key order."""
    return votes(t).orderBy("candidate_name", "precinct_code", "total_votes").limit(20)


@query("row_count")
def q_row_count(t):
    """A21."""
    from quarry.operators.relational import row_count
    return row_count(t.lineitem)


@query("max_key")
def q_max_key(t):
    """Next free order id."""
    from quarry.operators.relational import max_key
    return max_key(t.orders, "o_orderkey")
