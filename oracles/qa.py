"""Oracle SQL for QA preparation and scoring."""

from oracles.relations import with_

SQL = {}
PAIR = r"(\s*)([\p{L}\p{N}_]+|[^\s\p{L}\p{N}_])"
TOK = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"
PUNCT = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]""".replace("'", "''")

QA = """
qa AS (SELECT CAST(d.doc_id AS VARCHAR) || '-' || CAST(b.item_id AS VARCHAR) AS qid,
              d.doc_id, b.item_id, d.text AS context,
              'what does the text say about ' || array_to_string(string_split(b.text, ' ')[1:3], ' ')
                || '?' AS question,
              b.text AS answer, instr(d.text, b.text) - 1 AS answer_start
       FROM documents d JOIN benchmark b ON instr(d.text, b.text) > 0)"""


def toks(name, src, key, text, lower=False):
    t = "lower(t)" if lower else "t"
    return f"""
{name}_raw AS (SELECT {key}, regexp_extract_all({text}, '{PAIR}', 1) AS g,
                      regexp_extract_all({text}, '{PAIR}', 2) AS t FROM {src}),
{name}_x AS (SELECT {key}, unnest(g) AS g, unnest(t) AS t, unnest(range(0, len(t))) AS pos
             FROM {name}_raw),
{name} AS (SELECT {key}, pos, {t} AS token,
                  sum(length(g) + length(t)) OVER (PARTITION BY {key} ORDER BY pos
                      ROWS UNBOUNDED PRECEDING) - length(t) AS start,
                  sum(length(g) + length(t)) OVER (PARTITION BY {key} ORDER BY pos
                      ROWS UNBOUNDED PRECEDING) AS "end"
           FROM {name}_x)"""


def norm(x):
    return (f"array_to_string(list_filter(string_split_regex(trim(regexp_replace(lower({x}), "
            f"'{PUNCT}', '', 'g')), '\\s+'), lambda w: w NOT IN ('a', 'an', 'the') AND w <> ''), ' ')")


def W(*parts):
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


CTX = "ctx AS (SELECT DISTINCT doc_id, context FROM qa)"
CT = toks("ct", "ctx", "doc_id", "context")
CTL = toks("ctl", "documents", "doc_id", "text", True)
QT = toks("qt", "qa", "qid", "question", True)
CORPUS = "corpus AS (SELECT token FROM ctl UNION ALL SELECT token FROM qt)"

SQL["flatten_qa"] = W(QA) + """
SELECT CAST(doc_id AS VARCHAR) AS title, qid, question, answer, CAST(answer_start AS BIGINT) AS answer_start,
       CAST(answer_start AS BIGINT) AS label_start,
       CAST(answer_start + length(answer) AS BIGINT) AS label_end FROM qa"""

SQL["lowercase_text"] = "SELECT doc_id, lower(text) AS text FROM documents"

SQL["tokenise"] = W(toks("ct", "documents", "doc_id", "text")) + 'SELECT doc_id, pos, token, start, "end" FROM ct'

SPAN = """
span AS (SELECT q.qid, s.pos AS start_tok, e.pos AS end_tok FROM qa q
         LEFT JOIN ct s ON s.doc_id = q.doc_id AND s.start = q.answer_start
         LEFT JOIN ct e ON e.doc_id = q.doc_id AND e."end" = q.answer_start + length(q.answer))"""

SQL["answer_token_span"] = W(QA, CTX, CT, SPAN) + "SELECT * FROM span"

ERR = """
inside AS (SELECT s.qid, string_agg(c.token, ' ' ORDER BY c.pos) AS ctx_span
           FROM span s JOIN qa q ON q.qid = s.qid JOIN ct c ON c.doc_id = q.doc_id
           AND c.pos BETWEEN s.start_tok AND s.end_tok GROUP BY s.qid),
err AS (SELECT s.qid, s.start_tok IS NULL AS start_missing, s.end_tok IS NULL AS end_missing,
               coalesce(i.ctx_span, '') <> array_to_string(regexp_extract_all(q.answer, '""" + TOK + """', 0), ' ')
                 AS tokens_differ
        FROM span s JOIN qa q ON q.qid = s.qid LEFT JOIN inside i ON i.qid = s.qid)"""

MIS = [QA.replace("qa AS", "qa0 AS", 1), """
qa AS (SELECT qid, doc_id, item_id, context, question,
              CASE WHEN (doc_id + item_id) % 5 = 1 THEN left(answer, length(answer) - 1) ELSE answer END AS answer,
              answer_start + CASE WHEN (doc_id + item_id) % 5 = 0 THEN 1 ELSE 0 END AS answer_start FROM qa0)"""]

SQL["span_alignment_errors"] = W(*MIS, CTX, CT, SPAN, ERR) + \
    "SELECT * FROM err WHERE start_missing OR end_missing OR tokens_differ"

SQL["drop_rows_by_id"] = W(*MIS, CTX, CT, SPAN, ERR) + """
SELECT qid FROM qa WHERE qid NOT IN
  (SELECT qid FROM err WHERE start_missing OR end_missing OR tokens_differ)"""

VOCAB = """
vocab AS (SELECT '<unk>' AS token, 0 AS id, CAST(0 AS BIGINT) AS freq
          UNION ALL SELECT '<pad>', 1, 0
          UNION ALL SELECT token, CAST(row_number() OVER (ORDER BY count(*) DESC, token) + 1 AS INTEGER),
                           count(*) FROM corpus GROUP BY token)"""

SQL["word_vocab"] = W(QA, CTX, CTL, QT, CORPUS, VOCAB) + "SELECT * FROM vocab"

CHARV = """
chars AS (SELECT unnest(regexp_extract_all(token, '(?s).', 0)) AS ch FROM corpus),
cvocab AS (SELECT '<unk>' AS token, 0 AS id, CAST(0 AS BIGINT) AS freq
           UNION ALL SELECT '<pad>', 1, 0
           UNION ALL SELECT ch, CAST(row_number() OVER (ORDER BY count(*) DESC, ch) + 1 AS INTEGER), count(*)
           FROM chars GROUP BY ch HAVING count(*) >= 20)"""

SQL["char_vocab"] = W(QA, CTX, CTL, QT, CORPUS, CHARV) + "SELECT * FROM cvocab"

CONV = toks("cv", "conv", "cid", "text", True)
CONVSRC = "conv AS (SELECT conv_id, turn, CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS cid, text FROM conversations)"
CAPT = "capt AS (SELECT c.conv_id, c.turn, t.pos, t.token FROM cv t JOIN conv c ON c.cid = t.cid)"
TV = """
nth AS (SELECT token, conv_id, turn, pos FROM (
          SELECT *, row_number() OVER (PARTITION BY token ORDER BY conv_id, turn, pos) AS rn FROM capt)
        WHERE rn = 4),
tvocab AS (SELECT '<PAD>' AS token, 0 AS id UNION ALL SELECT '<SOS>', 1 UNION ALL SELECT '<EOS>', 2
           UNION ALL SELECT '<UNK>', 3
           UNION ALL SELECT token, CAST(row_number() OVER (ORDER BY conv_id, turn, pos) + 3 AS INTEGER) FROM nth)"""

SQL["threshold_vocab"] = W(CONVSRC, CONV, CAPT, TV) + "SELECT * FROM tvocab"

NUM = """
num AS (SELECT c.conv_id, c.turn, [1] || list(coalesce(v.id, 3) ORDER BY c.pos) || [2] AS ids
        FROM capt c LEFT JOIN tvocab v ON v.token = c.token GROUP BY c.conv_id, c.turn)"""

SQL["numericalise"] = W(CONVSRC, CONV, CAPT, TV, NUM) + \
    "SELECT conv_id, turn, array_to_string(ids, ' ') AS ids FROM num"

SQL["prepared_set"] = W(CONVSRC, CONV, CAPT, TV) + """
SELECT c.conv_id, c.turn, c.pos, coalesce(v.id, 3) AS id, CASE WHEN v.id IS NULL THEN '<UNK>' ELSE c.token END AS token
FROM capt c LEFT JOIN tvocab v ON v.token = c.token"""
SQL["prepared_vocabulary"] = SQL["word_vocab"]

SQL["pad_to_batch_max"] = W(CONVSRC, CONV, CAPT, TV, NUM) + """
SELECT conv_id, turn, array_to_string(ids || list_transform(range(0, m - len(ids)), lambda x: 0), ' ') AS ids
FROM (SELECT *, max(len(ids)) OVER (PARTITION BY conv_id) AS m FROM num)"""

for _n in (32, 7):
    SQL[f"pad_batches_of_{_n}"] = W(CONVSRC, CONV, CAPT, TV, NUM) + f"""
SELECT conv_id, turn, batch, array_to_string(ids || list_transform(range(0, m - len(ids)), lambda x: 0), ' ') AS ids
FROM (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS m FROM (
  SELECT *, (row_number() OVER (ORDER BY len(ids), conv_id, turn) - 1) // {_n} AS batch FROM num))"""

SQL["char_ids"] = W(QA, CTX, CTL, QT, CORPUS, CHARV, """
w AS (SELECT DISTINCT token AS word FROM qt),
wc AS (SELECT word, unnest(regexp_extract_all(word, '(?s).', 0)) AS ch,
              unnest(range(0, len(regexp_extract_all(word, '(?s).', 0)))) AS pos FROM w)""") + """
SELECT word, string_agg(CAST(coalesce(v.id, 0) AS VARCHAR), ' ' ORDER BY pos) AS char_ids
FROM wc LEFT JOIN cvocab v ON v.token = wc.ch GROUP BY word"""

SQL["pad_char_batches_of_32"] = W(QA, CTX, CTL, QT, CORPUS, CHARV, CONVSRC, CONV, CAPT, """
wc AS (SELECT word, unnest(regexp_extract_all(word, '(?s).', 0)) AS ch,
              unnest(range(0, len(regexp_extract_all(word, '(?s).', 0)))) AS k FROM (SELECT DISTINCT token AS word FROM capt)),
wid AS (SELECT word, list(coalesce(v.id, 0) ORDER BY k) AS chars FROM wc LEFT JOIN cvocab v ON v.token = wc.ch GROUP BY word),
cap AS (SELECT conv_id, turn, list(chars ORDER BY pos) AS ids FROM capt JOIN wid ON word = token GROUP BY conv_id, turn),
bat AS (SELECT *, (row_number() OVER (ORDER BY len(ids), conv_id, turn) - 1) // 32 AS batch FROM cap),
wide AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS rows_, max(list_max(list_transform(ids, lambda w: len(w)))) OVER (PARTITION BY batch) AS chars_ FROM bat)""") + """
SELECT conv_id, turn, batch, array_to_string(
         list_transform(ids, lambda w: array_to_string(w || list_transform(range(0, chars_ - len(w)), lambda x: 1), ' '))
         || list_transform(range(0, rows_ - len(ids)), lambda x: array_to_string(list_transform(range(0, chars_), lambda y: 1), ' ')), '|') AS ids
FROM wide"""

SQL["vector_left_join_zero"] = W(QA, CTX, CTL, QT, CORPUS, VOCAB) + """
SELECT v.token, v.id, e.embedding IS NOT NULL AS found,
       round(coalesce(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE))), 0.0), 3) AS vsum
FROM vocab v LEFT JOIN embeddings e ON e.vec_id = v.id"""

SQL["length_filter"] = W(QA) + f"""
SELECT qid FROM qa WHERE len(regexp_extract_all(context, '{TOK}', 0)) > 400
   OR len(regexp_extract_all(question, '{TOK}', 0)) > 50
   OR len(regexp_extract_all(answer, '{TOK}', 0)) > 30"""

TRUTHS = """
truths AS (SELECT qid, answer FROM qa UNION ALL
           SELECT qid, array_to_string(string_split(answer, ' ')[1:3], ' ') FROM qa)"""

SQL["answers_by_question"] = W(QA, TRUTHS) + """
SELECT qid, string_agg(answer, '|' ORDER BY answer) AS answers FROM truths GROUP BY qid"""

SQL["distinct_union_text"] = W(QA) + """
SELECT * FROM (SELECT DISTINCT md5(context) AS text_md5 FROM qa)
UNION ALL SELECT * FROM (SELECT DISTINCT md5(question) FROM qa)"""

PRED = """
pred AS (SELECT qid, CASE (doc_id + item_id) % 6
                  WHEN 0 THEN answer WHEN 1 THEN 'The ' || answer || '!!'
                  WHEN 2 THEN array_to_string(string_split(answer, ' ')[1:5], ' ')
                  WHEN 3 THEN question WHEN 4 THEN answer || ' and a few more words' END AS prediction
         FROM qa WHERE (doc_id + item_id) % 6 <> 5)"""

SCORE = f"""
pt AS (SELECT p.qid, t.answer AS truth, {norm('p.prediction')} AS pn, {norm('t.answer')} AS tn
       FROM pred p JOIN truths t ON t.qid = p.qid),
pc AS (SELECT qid, truth, tok, count(*) AS c FROM (SELECT qid, truth, unnest(string_split(pn, ' ')) AS tok
       FROM pt) WHERE tok <> '' GROUP BY ALL),
tc AS (SELECT qid, truth, tok, count(*) AS c FROM (SELECT qid, truth, unnest(string_split(tn, ' ')) AS tok
       FROM pt) WHERE tok <> '' GROUP BY ALL),
cm AS (SELECT pc.qid, pc.truth, sum(least(pc.c, tc.c)) AS common FROM pc JOIN tc
       ON pc.qid = tc.qid AND pc.truth = tc.truth AND pc.tok = tc.tok GROUP BY ALL),
lp AS (SELECT qid, truth, sum(c) AS lp FROM pc GROUP BY ALL),
lt AS (SELECT qid, truth, sum(c) AS lt FROM tc GROUP BY ALL),
sc AS (SELECT pt.qid, pt.truth, CAST(pt.pn = pt.tn AS INTEGER) AS em,
              CASE WHEN coalesce(cm.common, 0) = 0 THEN 0.0
                   ELSE 2 * (cm.common / lp.lp) * (cm.common / lt.lt) / (cm.common / lp.lp + cm.common / lt.lt)
              END AS f1
       FROM pt LEFT JOIN cm ON cm.qid = pt.qid AND cm.truth = pt.truth
       LEFT JOIN lp ON lp.qid = pt.qid AND lp.truth = pt.truth
       LEFT JOIN lt ON lt.qid = pt.qid AND lt.truth = pt.truth)"""

SQL["normalise_answer"] = W(QA, PRED) + f"SELECT qid, {norm('prediction')} AS normalised FROM pred"
SQL["exact_match"] = W(QA, PRED, TRUTHS, SCORE) + "SELECT qid, truth, em FROM sc"
SQL["token_f1"] = W(QA, PRED, TRUTHS, SCORE) + "SELECT qid, truth, round(f1, 6) AS f1 FROM sc"
SQL["max_over_truths"] = W(QA, PRED, TRUTHS, SCORE) + \
    "SELECT qid, max(em) AS em, round(max(f1), 6) AS f1 FROM sc GROUP BY qid"
SQL["em_f1_report"] = W(QA, PRED, TRUTHS, SCORE, "best AS (SELECT qid, max(em) AS em, max(f1) AS f1 FROM sc GROUP BY qid)") + """
SELECT round(100 * sum(coalesce(b.em, 0)) / count(*), 6) AS exact_match,
       round(100 * sum(coalesce(b.f1, 0.0)) / count(*), 6) AS f1, count(*) AS total
FROM qa LEFT JOIN best b ON b.qid = qa.qid"""


def _ngrams(n):
    return f"""
cg{n} AS (SELECT qid, g, count(*) AS c FROM (SELECT qid, unnest(list_transform(range(1, len(ct) - {n} + 2),
           lambda i: array_to_string(ct[i:i + {n} - 1], ' '))) AS g FROM bt) GROUP BY ALL),
rg{n} AS (SELECT qid, g, count(*) AS c FROM (SELECT qid, unnest(list_transform(range(1, len(rt) - {n} + 2),
           lambda i: array_to_string(rt[i:i + {n} - 1], ' '))) AS g FROM bt) GROUP BY ALL),
m{n} AS (SELECT cg{n}.qid, sum(least(cg{n}.c, coalesce(rg{n}.c, 0))) AS m, sum(cg{n}.c) AS t
         FROM cg{n} LEFT JOIN rg{n} ON rg{n}.qid = cg{n}.qid AND rg{n}.g = cg{n}.g GROUP BY ALL)"""


BT = f"""
bt AS (SELECT p.qid, regexp_extract_all(lower(p.prediction), '{TOK}', 0) AS ct,
              regexp_extract_all(lower(q.answer), '{TOK}', 0) AS rt
       FROM pred p JOIN qa q ON q.qid = p.qid)"""

SQL["bleu"] = W(QA, PRED, BT, *[_ngrams(n) for n in range(1, 5)]) + """
SELECT bt.qid, round(CASE WHEN coalesce(m1.m, 0) = 0 OR coalesce(m2.m, 0) = 0 OR coalesce(m3.m, 0) = 0
                               OR coalesce(m4.m, 0) = 0 THEN 0.0
       ELSE (CASE WHEN len(ct) < len(rt) THEN exp(1 - len(rt) / len(ct)) ELSE 1.0 END)
            * exp((ln(m1.m / m1.t) + ln(m2.m / m2.t) + ln(m3.m / m3.t) + ln(m4.m / m4.t)) / 4) END, 6) AS bleu
FROM bt LEFT JOIN m1 ON m1.qid = bt.qid LEFT JOIN m2 ON m2.qid = bt.qid
LEFT JOIN m3 ON m3.qid = bt.qid LEFT JOIN m4 ON m4.qid = bt.qid"""

SQL["corpus_bleu"] = W(QA, PRED, BT, *[_ngrams(n) for n in range(1, 5)], """
tot AS (SELECT count(*) AS n, sum(len(ct)) AS c, sum(len(rt)) AS r,
               sum(m1.m) AS a1, sum(m1.t) AS b1, sum(m2.m) AS a2, sum(m2.t) AS b2, sum(m3.m) AS a3, sum(m3.t) AS b3, sum(m4.m) AS a4, sum(m4.t) AS b4
        FROM bt LEFT JOIN m1 ON m1.qid = bt.qid LEFT JOIN m2 ON m2.qid = bt.qid
        LEFT JOIN m3 ON m3.qid = bt.qid LEFT JOIN m4 ON m4.qid = bt.qid)""") + """
SELECT n AS sentences, round(CASE WHEN coalesce(least(a1, a2, a3, a4), 0) = 0 THEN 0.0
       ELSE (CASE WHEN c < r THEN exp(1 - r / c) ELSE 1.0 END) * exp((ln(a1 / b1) + ln(a2 / b2) + ln(a3 / b3) + ln(a4 / b4)) / 4) END, 6) AS bleu
FROM tot"""

SCORES = """
scs AS (SELECT doc_id, pos, -((pos * 37 + 11) % 101) / 10.0 AS ls, -((pos * 53 + 7) % 97) / 10.0 AS le
        FROM ct)"""

SQL["best_span"] = W(QA, CTX, CT, SCORES, """
pm AS (SELECT doc_id, pos AS e, le, max(ls) OVER (PARTITION BY doc_id ORDER BY pos
                                                 ROWS UNBOUNDED PRECEDING) AS mls FROM scs)""", """
be AS (SELECT * FROM (SELECT doc_id, e, mls, mls + le AS total,
                             row_number() OVER (PARTITION BY doc_id ORDER BY mls + le DESC, e) AS rn FROM pm)
       WHERE rn = 1)""") + """
SELECT be.doc_id, (SELECT min(pos) FROM scs WHERE scs.doc_id = be.doc_id AND scs.pos <= be.e
                   AND scs.ls = be.mls) AS start_tok,
       be.e AS end_tok, round(be.total, 6) AS score FROM be"""

SQL["mean_loss_from_scores"] = W(QA, CTX, CT, SPAN, SCORES, """
lse AS (SELECT doc_id, ln(sum(exp(ls))) AS lse_s, ln(sum(exp(le))) AS lse_e FROM scs GROUP BY doc_id)""") + """
SELECT round(avg((l.lse_s - s1.ls) + (l.lse_e - s2.le)), 6) AS mean_loss
FROM span sp JOIN qa q ON q.qid = sp.qid JOIN lse l ON l.doc_id = q.doc_id
JOIN scs s1 ON s1.doc_id = q.doc_id AND s1.pos = sp.start_tok
JOIN scs s2 ON s2.doc_id = q.doc_id AND s2.pos = sp.end_tok"""


SQL["vectors_found"] = W(QA, CTX, CTL, QT, CORPUS, VOCAB) + """
SELECT count(*) AS words, count(e.vec_id) AS found FROM vocab v LEFT JOIN embeddings e ON e.vec_id = v.id"""
