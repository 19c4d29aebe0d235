"""Document fingerprints by closed syncmers, in DataFrame functions only.

A text's units are its words, or its characters where it has fewer words
than a k-mer takes.  A k-mer of units is an anchor when the smallest hash
of its inner s-mers stands at its first or last place.  That is settled by
the k-mer alone, so an edit moves or destroys the anchors it touches and
no others.  A fingerprint lists the anchors as hash@place; the likeness of
two is the share of distinct anchor hashes they have in common, and
``positional_matches`` pairs anchors of different texts with their shift.

The next document in descending doc_id comes from one shuffle of the
texts: doc_ids are cut into buckets at approximate quantiles, the first
document of every bucket is also dealt to the bucket before, and a window
inside the bucket reads the following row.

A null text is empty; a text with fewer characters than a k-mer has one
anchor, its whole; an empty text has none (like another empty one, unlike
all others).  Null doc_ids come last in the order, repeated rows follow
each other, and extra columns are ignored.  An empty table gives an empty
table; a single document follows itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import SPACE

K, S = 10, 3
LOWEST = -(1 << 63)
WHITE = " \t\n\x0b\f\r"


def _units(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    spaced = F.split(trimmed, SPACE)
    characters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.when(F.size(spaced) >= K, spaced).otherwise(characters)


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def anchors(text: Column) -> Column:
    """The anchors of a text as longs, place in the upper half and the
    k-mer's hash in the lower, in order of place."""
    inner = K - S + 1

    def selected(h: Column) -> Column:
        def one(i: Column) -> Column:
            inside = [F.get(h, i + j) for j in range(inner)]
            edge = F.least(*inside)
            whole = F.xxhash64(*[F.get(h, i + j) for j in sorted({*range(0, inner, S), inner - 1})])
            return F.when((edge == inside[0]) | (edge == inside[-1]), F.shiftleft(i.cast("long"), 32).bitwiseOR(whole.bitwiseAND(F.lit(0xFFFFFFFF))))

        return F.filter(F.transform(F.sequence(F.lit(0), F.size(h) - inner), one), lambda a: a.isNotNull())

    def of_units(u: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(u) - S), lambda i: F.xxhash64(*[F.get(u, i + j) for j in range(S)]))
        return F.when(F.size(u) >= K, let(hashes, selected)).otherwise(F.array(F.xxhash64(F.concat_ws("", u)).bitwiseAND(F.lit(0xFFFFFFFF))))

    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(let(_units(text), of_units))


def as_string(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda a: F.concat_ws("@", F.lower(F.hex(a.bitwiseAND(F.lit(0xFFFFFFFF)))), F.shiftright(a, 32))), " ")


def _hashes(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda a: a.bitwiseAND(F.lit(0xFFFFFFFF))))


def likeness(a: Column, b: Column) -> Column:
    """Distinct anchor hashes in both, of those in either; 1 for two empty fingerprints."""
    def of(x, y):
        both = F.size(F.array_intersect(x, y))
        either = F.size(x) + F.size(y) - both
        return F.when(either == 0, F.lit(1.0)).otherwise(both / either)

    return let(_hashes(a), lambda x: let(_hashes(b), lambda y: of(x, y)))


def positional_matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Anchors that texts of ``left`` share with texts of ``right`` (each
    doc_id, anchors): (left_id, right_id, shift, matches), the number of
    shared anchors by the shift of their places.  The join is on the
    anchor's hash; give it bounded sets of queries or rare anchors."""
    def flat(df, name):
        return df.select(F.col("doc_id").alias(f"{name}_id"), F.explode("anchors").alias("a")).select(
            f"{name}_id", F.col("a").bitwiseAND(F.lit(0xFFFFFFFF)).alias("hash"), F.shiftright("a", 32).alias(f"{name}_place"))

    pairs = flat(left, "left").join(flat(right, "right"), "hash")
    return pairs.groupBy("left_id", "right_id", (F.col("right_place") - F.col("left_place")).alias("shift")).agg(F.count(F.lit(1)).alias("matches"))


def with_next(df: DataFrame, carried: list[str], order: str = "doc_id", buckets: int | None = None) -> DataFrame:
    """``df`` with next_<column> of the row that follows in descending
    ``order`` (after the last: of the first)."""
    spark = df.sparkSession
    n = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_key", F.coalesce(F.col(order), F.lit(LOWEST)))
    cuts = keyed.agg(F.percentile_approx("_key", [i / n for i in range(1, n)], 10 * n).alias("c")).first()["c"] if n > 1 else []
    cuts = sorted(set(cuts or []))
    bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"), lambda c: c >= F.col("_key"))) if cuts else F.lit(0)
    keyed = keyed.withColumn("_bucket", bucket)
    # the largest key of each bucket (as many rows as buckets) is read by the bucket before; the very first by the last
    heads = {r["_bucket"]: r["k"] for r in keyed.groupBy("_bucket").agg(F.max("_key").alias("k")).collect()}
    filled = sorted(heads)
    also = {}
    for i, b in enumerate(filled):
        also.setdefault(heads[b], []).append(filled[i - 1] if i else filled[-1])
    extra = F.array().cast("array<int>")
    if also:
        names = list(also)
        place = F.array_position(F.array(*[F.lit(k) for k in names]).cast("array<bigint>"), F.col("_key"))
        lists = F.array(*[F.array(*[F.lit(b) for b in also[k]]) for k in names])
        extra = F.when(place > 0, F.get(lists, (place - 1).cast("int"))).otherwise(extra)
    copies = F.concat(F.array(F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("extra"))),
                      F.transform(extra, lambda b: F.struct(b.alias("b"), F.lit(True).alias("extra"))))
    dealt = keyed.withColumn("_copy", F.explode(copies)).drop("_bucket")
    w = Window.partitionBy("_copy.b").orderBy(F.col("_copy.extra"), F.col("_key").desc(), *carried[:1])
    out = dealt.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carried])
    return out.where(~F.col("_copy.extra")).drop("_key", "_copy")


def fingerprints(df: DataFrame) -> DataFrame:
    """doc_id, text, edited (the last third replaced by the beginning of
    the next text), their anchors and those of the next text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = df.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("anchors", anchors(F.col("text")))
    chained = with_next(read, ["text", "anchors"])
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    return chained.withColumn("edited", edited).drop("next_text").withColumn("edited_anchors", anchors(F.col("edited")))
