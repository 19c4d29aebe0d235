"""Question-answering and caption data preparation and scoring
(N1-N14, P13, P17-P21, P30, J11, A20, O8, O9).

Texts are tokenised by one regex, in the JVM where the tokens stay an
array, in Arrow batches where they become rows with their offsets: a text
is read once from left to right and its tokens never leave its task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.ordering import global_row_number

# token = a run of letters/digits/underscore, or any single
# other mark that is not ASCII white space; the same with the class spelt out.
TOKEN = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"
TOKEN_CODE_POINTS = r"[\p{L}\p{N}_]+|[^ \t\n\x0B\f\r\p{L}\p{N}_]"
# ASCII punctuation removed by the answer normaliser and the
# articles it drops.
PUNCT = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""
ARTICLES = ("a", "an", "the")
WORD_SPECIALS = ("<unk>", "<pad>")               # ids 0, 1
CAPTION_SPECIALS = ("<PAD>", "<SOS>", "<EOS>", "<UNK>")  # ids 0..3


def tokens(text: Column) -> Column:
    """Token array."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def token_rows(df: DataFrame, keep, text_col: str, lower: bool = False) -> DataFrame:
    """P18 long form: the ``keep`` columns, pos, token, start and end
    (0-based character offsets), text by text; nothing is shuffled."""
    keep = [keep] if isinstance(keep, str) else list(keep)
    read = df.select(*keep, F.col(text_col).alias("_text"))
    fields = [f for f in read.schema.fields if f.name != "_text"]
    schema = T.StructType([*fields, T.StructField("pos", T.IntegerType()), T.StructField("token", T.StringType()),
                           T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(TOKEN_CODE_POINTS).finditer
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                owner, pos, token, start, end = [], [], [], [], []
                for row, text in enumerate(part.column(part.num_columns - 1)):
                    for n, m in enumerate(find(text.as_py() or "")):
                        owner.append(row)
                        pos.append(n)
                        token.append(m.group())
                        start.append(m.start())
                        end.append(m.end())
                kept = [c.take(pa.array(owner, pa.int64())) for c in part.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(pos, pa.int32()), pa.array(token, pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    names=[*part.schema.names[:-1], "pos", "token", "start", "end"])

    found = read.mapInArrow(run, schema)
    return found.withColumn("token", F.lower("token")) if lower else found


def normalise_answer(s: Column) -> Column:
    """Lower -> drop punctuation -> drop articles -> squeeze blanks."""
    low = F.lower(s)
    nop = F.regexp_replace(low, PUNCT, "")
    words = F.filter(F.split(F.trim(nop), r"\s+"),
                     lambda w: ~w.isin(*ARTICLES) & (w != ""))
    return F.array_join(words, " ")


def answer_token_span(qa: DataFrame, ctx_tokens: DataFrame) -> DataFrame:
    """Char span -> token index span: start must be a token start and
    end a token end; a miss gives null.  (qid, start_tok, end_tok)."""
    q = qa.select("qid", "doc_id", F.col("answer_start").alias("start"),
                  (F.col("answer_start") + F.length("answer")).alias("end"))
    s = ctx_tokens.select("doc_id", "start", F.col("pos").alias("start_tok"))
    e = ctx_tokens.select("doc_id", "end", F.col("pos").alias("end_tok"))
    return (q.join(s, ["doc_id", "start"], "left").join(e, ["doc_id", "end"], "left")
            .select("qid", "start_tok", "end_tok"))


def span_alignment_errors(qa: DataFrame, ctx_tokens: DataFrame) -> DataFrame:
    """Flags per question: start missing, end missing, tokens differ
    (the answer's own tokens vs the context tokens of the span)."""
    span = answer_token_span(qa, ctx_tokens).join(qa.select("qid", "context", "answer"), "qid")
    places = F.col("end_tok") - F.col("start_tok") + 1
    inside = span.where(places > 0).select("qid", F.array_join(F.slice(tokens(F.col("context")), F.col("start_tok") + 1, places), " ").alias("ctx_span"))
    f = span.join(inside, "qid", "left").select(
        "qid", F.col("start_tok").isNull().alias("start_missing"),
        F.col("end_tok").isNull().alias("end_missing"),
        (F.coalesce(F.col("ctx_span"), F.lit("")) != F.array_join(tokens(F.col("answer")), " "))
        .alias("tokens_differ"))
    return f.where(F.col("start_missing") | F.col("end_missing") | F.col("tokens_differ"))


def frequency_vocab(tok: DataFrame, col: str, specials=WORD_SPECIALS,
                    min_count: int = 1, weight: str | None = None) -> DataFrame:
    """(token, id, freq): specials first, then by falling
    frequency (ties by token).  A row counts once, or as often as its
    ``weight`` says.  Positions come from a distributed global
    row number over the distinct vocabulary."""
    freq = F.count(F.lit(1)) if weight is None else F.sum(weight)
    c = tok.groupBy(col).agg(freq.alias("freq")).where(F.col("freq") >= min_count)
    c = global_row_number(c, [F.desc("freq"), F.asc(col)], "_rn")
    ranked = c.select(F.col(col).alias("token"), (F.col("_rn") - 1 + len(specials)).alias("id"), "freq")
    sp = tok.sparkSession.createDataFrame([(s, i, 0) for i, s in enumerate(specials)],
                                          "token string, id int, freq bigint")
    return sp.unionByName(ranked.withColumn("id", F.col("id").cast("int")))


def threshold_vocab(tok: DataFrame, order_cols: list[str], threshold: int = 4) -> DataFrame:
    """Words reaching ``threshold`` occurrences, numbered from 4 in the
    order in which they reach it.  ``row_number() <= threshold`` per word
    is planned as a group limit applied before the shuffle, so a very
    frequent word ships at most ``threshold`` rows per partition."""
    w = Window.partitionBy("token").orderBy(*order_cols)
    nth = (tok.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= threshold)
           .where(F.col("_rn") == threshold))
    nth = global_row_number(nth.select("token", *order_cols), [F.col(c) for c in order_cols], "_rn")
    words = nth.select("token", (F.col("_rn") + len(CAPTION_SPECIALS) - 1).cast("int").alias("id"))
    sp = tok.sparkSession.createDataFrame([(s, i) for i, s in enumerate(CAPTION_SPECIALS)],
                                          "token string, id int")
    return sp.unionByName(words)


def ordered_ids(tok: DataFrame, key: list[str], vocab: DataFrame, miss: int) -> DataFrame:
    """Tokens -> ids through a vocabulary (left join, miss -> ``miss``),
    regrouped per text in position order: (key..., ids array<int>)."""
    j = tok.join(vocab.select("token", "id"), "token", "left")
    j = j.withColumn("id", F.coalesce("id", F.lit(miss)))
    g = j.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("_p"))
    return g.select(*key, F.transform("_p", lambda x: x["id"]).alias("ids"))


def pad_to_batch_max(df: DataFrame, batch: str, ids: str, pad: int = 0) -> DataFrame:
    """P20: pad each id list to the longest list in its batch."""
    w = Window.partitionBy(batch)
    m = F.max(F.size(ids)).over(w)
    return df.withColumn(ids, F.concat(F.col(ids), F.array_repeat(F.lit(pad), m - F.size(ids))))


def pad_batches(df: DataFrame, order: list[str], ids: str, n: int, pad: int = 0) -> DataFrame:
    """P20: batches of ``n`` rows each, formed over the whole table from the
    shortest list to the longest (ties by ``order``, which names a row), and
    padded to the longest list of the batch; adds ``batch`` (from 0).  A
    row's place comes from range sums, so batches go across partitions; a
    null list counts as empty."""
    return _padded(df, order, ids, n, lambda longest, _: F.concat(F.col(ids), F.array_repeat(F.lit(pad), longest - F.size(ids))))


def pad_nested_batches(df: DataFrame, order: list[str], ids: str, n: int, pad: int = 0) -> DataFrame:
    """P20 on lists of lists (characters of words): batches as above by the
    number of words; every word is padded to the batch's longest word and
    every row to the batch's longest row, with words that are all ``pad``."""
    def padded(longest, widest):
        words = F.concat(F.col(ids), F.array_repeat(F.array().cast("array<int>"), longest - F.size(ids)))
        return F.transform(words, lambda w: F.concat(w, F.array_repeat(F.lit(pad), widest - F.size(w))))

    given = F.transform(F.col(ids), lambda w: F.coalesce(w, F.array().cast("array<int>")))
    return _padded(df.withColumn(ids, given), order, ids, n, padded, F.array_max(F.transform(F.col(ids), F.size)))


def _padded(df: DataFrame, order: list[str], ids: str, n: int, padded, width=None) -> DataFrame:
    """Batches of ``n`` rows by length, with ``ids`` made anew from the most
    that the batch's rows have in length and in ``width``."""
    sized = df.withColumn(ids, F.coalesce(F.col(ids), F.array().cast(df.schema[ids].dataType))).withColumn("_size", F.size(ids))
    placed = global_row_number(sized, ["_size", *order], "_place").withColumn("batch", F.floor((F.col("_place") - 1) / n).cast("long"))
    longest = placed.groupBy(F.col("batch").alias("_batch")).agg(F.max("_size").alias("_longest"), F.coalesce(F.max(F.lit(0) if width is None else width), F.lit(0)).alias("_widest"))
    joined = placed.join(longest, F.col("batch") == F.col("_batch"))
    return joined.withColumn(ids, padded(F.col("_longest"), F.col("_widest"))).drop("_size", "_place", "_batch", "_longest", "_widest")


def char_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, char) for each character of a short text."""
    ch = F.regexp_extract_all(F.col(text_col), F.lit("(?s)."), F.lit(0))
    return df.select(id_col, F.posexplode(ch).alias("pos", "token"))


def token_f1(pred: DataFrame, truth: DataFrame, key: list[str]) -> DataFrame:
    """Multiset overlap of whitespace tokens of normalised texts.

    ``pred``/``truth`` hold key + ``text`` (already normalised).  Returns
    key + f1 (0 when nothing is shared)."""
    def counts(df, name):
        t = df.select(*key, F.explode(F.split("text", " ")).alias("tok")).where(F.col("tok") != "")
        return t.groupBy(*key, "tok").agg(F.count(F.lit(1)).alias(name))
    pc, tc = counts(pred, "cp"), counts(truth, "ct")
    common = pc.join(tc, key + ["tok"]).groupBy(*key).agg(
        F.sum(F.least("cp", "ct")).alias("common"))
    lp = pc.groupBy(*key).agg(F.sum("cp").alias("lp"))
    lt = tc.groupBy(*key).agg(F.sum("ct").alias("lt"))
    base = pred.select(*key).join(lp, key, "left").join(lt, key, "left").join(common, key, "left")
    c = F.coalesce("common", F.lit(0))
    prec = c / F.col("lp")
    rec = c / F.col("lt")
    f1 = F.when(c == 0, F.lit(0.0)).otherwise(2 * prec * rec / (prec + rec))
    return base.select(*key, f1.alias("f1"))


def ngram_counts(df: DataFrame, key: list[str], toks: str, n: int, name: str) -> DataFrame:
    grams = F.transform(F.sequence(F.lit(1), F.size(toks) - n + 1),
                        lambda i: F.array_join(F.slice(toks, i, n), " "))
    g = df.where(F.size(toks) >= n).select(*key, F.explode(grams).alias("g"))
    return g.groupBy(*key, "g").agg(F.count(F.lit(1)).alias(name))


def _bleu_parts(cand: DataFrame, ref: DataFrame, key: list[str], max_n: int) -> DataFrame:
    """key, lengths c and r, and per n the clipped matches m and grams t.
    Clipping is a join of n-gram counts."""
    c_len = cand.select(*key, F.size("toks").alias("c"))
    r_len = ref.select(*key, F.size("toks").alias("r"))
    out = c_len.join(r_len, key)
    for n in range(1, max_n + 1):
        cc = ngram_counts(cand, key, "toks", n, "cc")
        rc = ngram_counts(ref, key, "toks", n, "rc")
        clip = cc.join(rc, key + ["g"], "left").groupBy(*key).agg(
            F.sum(F.least("cc", F.coalesce("rc", F.lit(0)))).alias(f"m{n}"),
            F.sum("cc").alias(f"t{n}"))
        out = out.join(clip, key, "left")
    return out


def _bleu_score(max_n: int) -> Column:
    logs = [F.log(F.col(f"m{n}") / F.col(f"t{n}")) for n in range(1, max_n + 1)]
    zero = F.lit(False)
    for n in range(1, max_n + 1):
        zero = zero | (F.coalesce(F.col(f"m{n}"), F.lit(0)) == 0)
    bp = F.when(F.col("c") < F.col("r"), F.exp(1 - F.col("r") / F.col("c"))).otherwise(F.lit(1.0))
    return F.when(zero, F.lit(0.0)).otherwise(bp * F.exp(sum(logs[1:], logs[0]) / max_n))


def bleu(cand: DataFrame, ref: DataFrame, key: list[str], max_n: int = 4) -> DataFrame:
    """Sentence BLEU-4 (uniform weights, brevity penalty); any zero
    n-gram precision gives 0."""
    return _bleu_parts(cand, ref, key, max_n).select(*key, _bleu_score(max_n).alias("bleu"))


def corpus_bleu(cand: DataFrame, ref: DataFrame, key: list[str], max_n: int = 4) -> DataFrame:
    """One score of all sentences: matches, grams and lengths are added
    up before the precisions are taken.  No sentences score 0."""
    parts = _bleu_parts(cand, ref, key, max_n)
    names = ["c", "r", *[f"{x}{n}" for n in range(1, max_n + 1) for x in "mt"]]
    total = parts.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in names], F.count(F.lit(1)).alias("sentences"))
    return total.select("sentences", _bleu_score(max_n).alias("bleu"))


def exact_match(pred: DataFrame, truth: DataFrame, key: list[str]) -> DataFrame:
    """Key + em, 1 where the (normalised) texts are equal."""
    both = pred.join(truth.withColumnRenamed("text", "_expected"), key)
    return both.select(*key, (F.col("text") == F.col("_expected")).cast("int").alias("em"))


def max_over_truths(pred: DataFrame, truths: DataFrame, key: str, metric: Callable[[DataFrame, DataFrame, list[str]], DataFrame]) -> DataFrame:
    """The best score of a prediction (key, text) over its truths
    (key, text).  ``metric`` takes both sides with equal keys and returns
    the key and a score as its last column, as ``exact_match`` and
    ``token_f1`` do; repeated truths count once."""
    pairs = pred.join(truths.distinct().withColumnRenamed("text", "_truth"), key)
    scored = metric(pairs.select(key, "_truth", "text"), pairs.select(key, "_truth", F.col("_truth").alias("text")), [key, "_truth"])
    score = scored.columns[-1]
    return scored.groupBy(key).agg(F.max(score).alias(score))


def best_span(scores: DataFrame, key: str) -> DataFrame:
    """Argmax over s <= e of ls(s) + le(e) in O(n) per text.

    A running window keeps the best start so far (earliest on ties); the
    best end is then a ``max_by`` per text (smallest e on ties)."""
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    best_s = F.max(F.struct(F.col("ls").alias("v"), (-F.col("pos")).alias("ns"))).over(w)
    r = scores.withColumn("bs", best_s).select(
        key, F.col("pos").alias("e"), (-F.col("bs.ns")).alias("s"),
        (F.col("bs.v") + F.col("le")).alias("total"))
    return r.groupBy(key).agg(F.max(F.struct("total", (-F.col("e")).alias("ne"), "s")).alias("b")) \
            .select(key, F.col("b.s").alias("start_tok"), (-F.col("b.ne")).alias("end_tok"),
                    F.round("b.total", 6).alias("score"))
