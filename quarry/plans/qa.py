"""QA / caption preparation and scoring jobs (N1-N14, P13, P17-P21, P30,
J11, A20, O8, O9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators import qa as Q
from quarry.plans.registry import query
from quarry.plans.relations import qa_predictions, qa_rows, qa_truths
from quarry.session import scratch_path
from quarry.sources.nested import nest_qa, scan_nested_json, write_nested_json
from quarry.sources.prepared import load_prepared, load_vocabulary, save_prepared, save_vocabulary


def ctx_tokens(t, lower=False):
    ctx = qa_rows(t).select("doc_id", "context").distinct()
    return Q.token_rows(ctx, "doc_id", "context", lower)


def corpus_tokens(t):
    """Every lower-case token of all documents and questions, without places."""
    c = t.documents.select(F.explode(Q.tokens(F.col("text"))).alias("token"))
    q = qa_rows(t).select(F.explode(Q.tokens(F.col("question"))).alias("token"))
    return c.union(q).select(F.lower("token").alias("token"))


@query("flatten_qa")
def q_flatten(t):
    """Nested JSON written to the shared scratch folder, read back
    and flattened (one row per answer, label = [start, end])."""
    spark = t.spark
    path = scratch_path(spark, f"qa-json-{uuid.uuid4().hex}")
    write_nested_json(nest_qa(qa_rows(t)), path)
    f = scan_nested_json(spark, path)
    return f.select("title", "qid", "question", "answer", F.col("answer_start").cast("long").alias("answer_start"),
                    F.col("label")[0].cast("long").alias("label_start"),
                    F.col("label")[1].cast("long").alias("label_end"))


@query("lowercase_text")
def q_lower(t):
    """P13 over every document."""
    return t.documents.select("doc_id", F.lower("text").alias("text"))


@query("tokenise")
def q_tokenise(t):
    """Every document's tokens with character offsets (long form)."""
    return Q.token_rows(t.documents, "doc_id", "text")


@query("answer_token_span")
def q_span(t):
    """N5."""
    return Q.answer_token_span(qa_rows(t), ctx_tokens(t))


def misaligned(t):
    """Questions some of whose answers do not fall on token borders: every
    fifth begins a character late, every fifth lacks its last character."""
    kind = (F.col("doc_id") + F.col("item_id")) % 5
    short = F.substring(F.col("answer"), F.lit(1), F.length("answer") - 1)
    return (qa_rows(t).withColumn("answer", F.when(kind == 1, short).otherwise(F.col("answer")))
            .withColumn("answer_start", F.col("answer_start") + F.when(kind == 0, 1).otherwise(0)))


@query("span_alignment_errors")
def q_span_errors(t):
    """N6."""
    return Q.span_alignment_errors(misaligned(t), ctx_tokens(t))


@query("drop_rows_by_id")
def q_drop_rows(t):
    """Question ids left after removing misaligned ones."""
    qa = misaligned(t)
    bad = Q.span_alignment_errors(qa, ctx_tokens(t)).select("qid")
    return qa.join(bad, "qid", "left_anti").select("qid")


@query("word_vocab")
def q_word_vocab(t):
    """Words by falling frequency after <unk>=0, <pad>=1."""
    return Q.frequency_vocab(corpus_tokens(t), "token")


def _char_vocab(t):
    """Each different token is cut once; its characters count as often as it."""
    words = corpus_tokens(t).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return Q.frequency_vocab(Q.char_rows(words, "n", "token"), "token", min_count=20, weight="n")


@query("char_vocab")
def q_char_vocab(t):
    """Characters seen at least 20 times."""
    return _char_vocab(t)


def caption_tokens(t):
    c = t.conversations.select("conv_id", "turn", "text")
    return Q.token_rows(c, ["conv_id", "turn"], "text", lower=True)


@query("threshold_vocab")
def q_threshold_vocab(t):
    """Caption words reaching 4 occurrences, ids in order of reaching it."""
    return Q.threshold_vocab(caption_tokens(t), ["conv_id", "turn", "pos"], 4)


def _numericalised(t):
    tok = caption_tokens(t)
    vocab = Q.threshold_vocab(tok, ["conv_id", "turn", "pos"], 4)
    ids = Q.ordered_ids(tok, ["conv_id", "turn"], vocab, miss=3)
    return ids.select("conv_id", "turn",
                      F.concat(F.array(F.lit(1)), "ids", F.array(F.lit(2))).alias("ids"))


@query("numericalise")
def q_numericalise(t):
    """<SOS> ids <EOS>, unknown words -> <UNK>."""
    return _numericalised(t).select("conv_id", "turn", F.array_join("ids", " ").alias("ids"))


def _prepared(t):
    """Captions as ids, saved with the vocabulary that made them and with
    the corpus's words, and read back: (set, vocabularies)."""
    tok = caption_tokens(t)
    base = scratch_path(t.spark, f"prepared-{uuid.uuid4().hex}")
    paths = {"captions": f"{base}/captions", "words": f"{base}/words"}
    saved = {"captions": save_vocabulary(Q.threshold_vocab(tok, ["conv_id", "turn", "pos"], 4), paths["captions"]),
             "words": save_vocabulary(Q.frequency_vocab(corpus_tokens(t), "token"), paths["words"])}
    ids = Q.ordered_ids(tok, ["conv_id", "turn"], load_vocabulary(t.spark, paths["captions"]), miss=3)
    save_prepared(ids, f"{base}/set", saved)
    return load_prepared(t.spark, f"{base}/set", paths)


@query("prepared_set")
def q_prepared(t):
    """K5: a prepared set saved and loaded with its vocabularies, its ids
    as words again."""
    ids, vocabularies = _prepared(t)
    at = ids.select("conv_id", "turn", F.posexplode("ids").alias("pos", "id"))
    return at.join(vocabularies["captions"], "id").select("conv_id", "turn", F.col("pos").cast("long").alias("pos"), "id", "token")


@query("prepared_vocabulary")
def q_prepared_vocabulary(t):
    """K5: the corpus's words as they were saved with a set."""
    return _prepared(t)[1]["words"]


@query("pad_to_batch_max")
def q_pad(t):
    """P20: id lists padded to the longest in their conversation."""
    p = Q.pad_to_batch_max(_numericalised(t), "conv_id", "ids", 0)
    return p.select("conv_id", "turn", F.array_join("ids", " ").alias("ids"))


def _batches(t, n):
    p = Q.pad_batches(_numericalised(t), ["conv_id", "turn"], "ids", n)
    return p.select("conv_id", "turn", "batch", F.array_join("ids", " ").alias("ids"))


@query("pad_batches_of_32")
def q_pad_32(t):
    """P20: captions in batches of 32 rows by length, padded to the batch's longest."""
    return _batches(t, 32)


@query("pad_batches_of_7")
def q_pad_7(t):
    """P20: captions in batches of 7 rows by length, padded to the batch's longest."""
    return _batches(t, 7)


@query("pad_char_batches_of_32")
def q_pad_chars(t):
    """P20: captions as character ids of their words, in batches of 32 rows;
    words padded to the batch's longest word, captions to its longest."""
    tok = caption_tokens(t).select("conv_id", "turn", "pos", "token")
    ch = Q.char_rows(tok.select(F.col("token").alias("word")).distinct(), "word", "word")
    chars = Q.ordered_ids(ch, ["word"], _char_vocab(t), miss=0).withColumnRenamed("ids", "chars")
    held = tok.join(chars, F.col("token") == F.col("word")).groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("pos", "chars"))).alias("w"))
    p = Q.pad_nested_batches(held.select("conv_id", "turn", F.col("w.chars").alias("ids")), ["conv_id", "turn"], "ids", 32, pad=1)
    words = F.transform("ids", lambda w: F.array_join(w.cast("array<string>"), " "))
    return p.select("conv_id", "turn", "batch", F.array_join(words, "|").alias("ids"))


@query("char_ids")
def q_char_ids(t):
    """Per question word, its character ids (miss -> 0)."""
    words = Q.token_rows(qa_rows(t).select("qid", "question"), "qid", "question", True) \
        .select(F.col("token").alias("word")).distinct()
    ch = Q.char_rows(words, "word", "word")
    ids = Q.ordered_ids(ch, ["word"], _char_vocab(t), miss=0)
    return ids.select("word", F.array_join("ids", " ").alias("char_ids"))


@query("vector_left_join_zero")
def q_vectors(t):
    """Word -> pretrained vector (embeddings by vocabulary position);
    out-of-vocabulary -> zero vector of length 64."""
    v = Q.frequency_vocab(corpus_tokens(t), "token")
    e = t.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    j = v.join(e, v["id"] == e["id"], "left").drop(e["id"])
    vec = F.coalesce("embedding", F.array_repeat(F.lit(0.0).cast("float"), 64))
    return j.select("token", "id", F.col("embedding").isNotNull().alias("found"),
                    F.round(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x), 3).alias("vsum"))


@query("length_filter")
def q_length_filter(t):
    """Questions whose context > 400, question > 50 or answer > 30 tokens."""
    qa = qa_rows(t)
    n = lambda c: F.size(Q.tokens(F.col(c)))
    return qa.where((n("context") > 400) | (n("question") > 50) | (n("answer") > 30)).select("qid")


@query("answers_by_question")
def q_answers(t):
    """All accepted answers per question."""
    tr = qa_truths(qa_rows(t))
    return tr.groupBy("qid").agg(F.array_join(F.array_sort(F.collect_list("answer")), "|").alias("answers"))


@query("distinct_union_text")
def q_distinct_union(t):
    """Distinct contexts followed by distinct questions (no cross-dedup)."""
    qa = qa_rows(t)
    from quarry.operators.relational import distinct_union
    return distinct_union(qa.select(F.md5("context").alias("text_md5")),
                          qa.select(F.md5("question").alias("text_md5")))


def _scored(t):
    qa = qa_rows(t)
    pred = qa_predictions(qa)
    tr = qa_truths(qa)
    pt = pred.join(tr, "qid")
    p = pt.select("qid", F.col("answer").alias("truth"), Q.normalise_answer(F.col("prediction")).alias("text"))
    g = pt.select("qid", F.col("answer").alias("truth"), Q.normalise_answer(F.col("answer")).alias("text"))
    em = p.join(g.withColumnRenamed("text", "gt"), ["qid", "truth"]).select(
        "qid", "truth", (F.col("text") == F.col("gt")).cast("int").alias("em"))
    f1 = Q.token_f1(p, g, ["qid", "truth"])
    return qa, em.join(f1, ["qid", "truth"])


@query("normalise_answer")
def q_normalise(t):
    """P17."""
    p = qa_predictions(qa_rows(t))
    return p.select("qid", Q.normalise_answer(F.col("prediction")).alias("normalised"))


@query("exact_match")
def q_em(t):
    """N9."""
    return _scored(t)[1].select("qid", "truth", "em")


@query("token_f1")
def q_f1(t):
    """N10."""
    return _scored(t)[1].select("qid", "truth", F.round("f1", 6).alias("f1"))


@query("max_over_truths")
def q_max_truths(t):
    """The best exact match and the best F1 over a question's truths."""
    qa = qa_rows(t)
    pred = qa_predictions(qa).select("qid", Q.normalise_answer(F.col("prediction")).alias("text"))
    truths = qa_truths(qa).select("qid", Q.normalise_answer(F.col("answer")).alias("text"))
    best = [Q.max_over_truths(pred, truths, "qid", m) for m in (Q.exact_match, Q.token_f1)]
    return best[0].join(best[1], "qid").select("qid", "em", F.round("f1", 6).alias("f1"))


@query("em_f1_report")
def q_report(t):
    """100·Σ/total with unanswered questions counted as 0."""
    qa, s = _scored(t)
    best = s.groupBy("qid").agg(F.max("em").alias("em"), F.max("f1").alias("f1"))
    allq = qa.select("qid").join(best, "qid", "left")
    return allq.agg(F.round(100 * F.sum(F.coalesce("em", F.lit(0))) / F.count(F.lit(1)), 6).alias("exact_match"),
                    F.round(100 * F.sum(F.coalesce("f1", F.lit(0.0))) / F.count(F.lit(1)), 6).alias("f1"),
                    F.count(F.lit(1)).alias("total"))


def _bleu_sides(t):
    """(qid, toks) of every prediction and of its passage."""
    qa = qa_rows(t)
    pred = qa_predictions(qa).select("qid", Q.tokens(F.lower("prediction")).alias("toks"))
    ref = qa.select("qid", Q.tokens(F.lower("answer")).alias("toks"))
    return pred, ref.join(pred.select("qid"), "qid", "left_semi")


@query("bleu")
def q_bleu(t):
    """Sentence BLEU-4 of each prediction against its passage."""
    b = Q.bleu(*_bleu_sides(t), ["qid"])
    return b.select("qid", F.round("bleu", 6).alias("bleu"))


@query("corpus_bleu")
def q_corpus_bleu(t):
    """BLEU-4 of all predictions together."""
    b = Q.corpus_bleu(*_bleu_sides(t), ["qid"])
    return b.select("sentences", F.round("bleu", 6).alias("bleu"))


def span_scores(t):
    tok = ctx_tokens(t)
    return tok.select("doc_id", "pos",
                      (-((F.col("pos") * 37 + 11) % 101) / 10.0).alias("ls"),
                      (-((F.col("pos") * 53 + 7) % 97) / 10.0).alias("le"))


@query("best_span")
def q_best_span(t):
    """Best (start <= end) token span per context from stored scores."""
    return Q.best_span(span_scores(t), "doc_id")


@query("mean_loss_from_scores")
def q_mean_loss(t):
    """Mean start + end cross-entropy of the true spans."""
    sc = span_scores(t)
    lse = sc.groupBy("doc_id").agg(F.log(F.sum(F.exp("ls"))).alias("lse_s"),
                                   F.log(F.sum(F.exp("le"))).alias("lse_e"))
    span = Q.answer_token_span(qa_rows(t), ctx_tokens(t)).where(
        F.col("start_tok").isNotNull() & F.col("end_tok").isNotNull())
    qa = qa_rows(t).select("qid", "doc_id")
    j = (span.join(qa, "qid").join(lse, "doc_id")
         .join(sc.select("doc_id", F.col("pos").alias("start_tok"), "ls"), ["doc_id", "start_tok"])
         .join(sc.select("doc_id", F.col("pos").alias("end_tok"), "le"), ["doc_id", "end_tok"]))
    loss = (F.col("lse_s") - F.col("ls")) + (F.col("lse_e") - F.col("le"))
    return j.agg(F.round(F.avg(loss), 6).alias("mean_loss"))


@query("vectors_found")
def q_vectors_found(t):
    """How many words of the vocabulary have a pretrained vector."""
    v = Q.frequency_vocab(corpus_tokens(t), "token").select("id")
    e = t.embeddings.select(F.col("vec_id").alias("id"), F.lit(1).alias("hit"))
    return v.join(e, "id", "left").agg(F.count(F.lit(1)).alias("words"), F.count("hit").alias("found"))
