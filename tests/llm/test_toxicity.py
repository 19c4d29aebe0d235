from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import toxicity as tx


def brute_kernel(a, b):
    def features(s):
        c, out = tx.code(s), {}
        for i, j, k in combinations(range(len(c)), 3):
            if k - i < tx.SPAN and c[i] and c[j] and c[k]:
                out[c[i], c[j], c[k]] = out.get((c[i], c[j], c[k]), 0) + tx.DECAY ** (k - i + 1)
        return out
    x, y = features(a), features(b)
    return sum(v * y.get(t, 0) for t, v in x.items())


def brute_value(word, landmark):
    """The power of the kernel, both strings scaled to 1, largest over windows."""
    core = word.strip(tx.OUTER).lower()
    letters = [i for i, x in enumerate(core) if tx.code(x)[0]]
    windows = [core]
    if len(core) > tx.WIDTH:
        starts = range(0, max(1, len(letters) - tx.WIDTH // 2), tx.WIDTH // 2)
        windows = [core[letters[i]:letters[min(i + tx.WIDTH, len(letters)) - 1] + 1] for i in starts if letters]
    best = 0.0
    for w in windows:
        own = brute_kernel(w, w)
        if own:
            best = max(best, (brute_kernel(w, landmark) / (own * brute_kernel(landmark, landmark)) ** 0.5) ** tx.POWER)
    return best


def test_kernel():
    for a, b in (("idiot", "idiot"), ("idiot", "i-d-i-o-t"), ("aaaa", "aab"), ("worthless", "harmless"), ("ab", "abc"), ("a.b.", "x")):
        assert tx.kernel(a, b) == pytest.approx(brute_kernel(a, b))
    landmarks = ["idiot", "trash", "idiotic", "aaaa", "worthles"]
    marks = tx.Landmarks(landmarks)
    words = ["idiot", "i.d.i.o.t", "idixot", "id1ot", "trash", "harmless", "ab", "", "..,", "aaaaaaaa", "größe", "ひらがな", "an" * 9 + "idiot" + "er" * 9, "worthlessworthless", "w-o-r-t-h-l-e-s-s", "---------", "i" + "." * 30 + "d.i.o.t", "12345678٣٤٥idiot"]
    got = marks.kernel_values(words)
    assert got == pytest.approx(np.array([[brute_value(w, s) for s in landmarks] for w in words]), rel=1e-4, abs=1e-6)
    k = marks.kernel_values(landmarks)
    assert np.allclose(k, k.T, atol=1e-6) and np.allclose(np.diag(k), 1, atol=1e-5) and np.linalg.eigvalsh(k).min() > -1e-6
    assert k[0, 2] == pytest.approx(brute_value("idiotic", "idiot"), rel=1e-4) and k[0, 2] < 0.9
    white = tx.whitening(marks)
    value, vector = np.linalg.eigh(k.astype(float))
    assert np.allclose(white @ white, vector @ np.diag(1 / np.maximum(value, 0.05)) @ vector.T, atol=1e-5)
    assert got[1][0] > 0.5 and got[2][0] > 0.1 > got[5][0] and got[12][0] > 0.1 and got[14][4] > 0.5 and not got[6:9].any()
    rows = marks.learn(["idiot", "x"])
    assert marks.values[rows[0]] == pytest.approx(got[0]) and len(marks.cores) == 2
    marks.max_words = 1
    assert marks.learn(["trash"]).tolist() == [0] and len(marks.cores) == 1


def test_sentences():
    marks = tx.Landmarks(["idiot"], max_words=4)
    for _ in range(2):
        found, words = marks.sentences("He said so. You idiot there!\nplain line\n\n you i d i o t now ")
        assert len(found) == 4 and found[:, 0].round(2).tolist() == [0, 1, 0, 1] and len(words) == 13
    assert marks.sentences("")[0].shape == (0, 1) and marks.sentences(" \n\t")[1].shape == (0, 1)


def brute_sentences(text, landmarks):
    """Features of sentences and of the different cores of a text, word by word."""
    groups, cores = [], set()
    for line in text.split("\n"):
        new = True
        for w in line.split():
            if new:
                groups.append([])
            groups[-1].append(w)
            new = w[-1] in ".!?"
    flat = [(w, g) for g, ws in enumerate(groups) for w in ws]
    extra, run = [], []
    for i, (w, _) in enumerate([*flat, ("end", 0)]):
        if i < len(flat) and len(w) <= 2:
            run.append(i)
            continue
        if len(run) >= 3:
            for at in range(0, max(1, len(run) - tx.RUN // 2), tx.RUN // 2):
                extra.append(("".join(flat[x][0] for x in run[at:at + tx.RUN]), flat[run[at]][1]))
        run = []
    out = np.zeros((len(groups), len(landmarks)))
    for w, g in flat + extra:
        out[g] = np.maximum(out[g], [brute_value(w, s) for s in landmarks])
        cores.add(w.strip(tx.OUTER).lower())
    return out, np.array([[brute_value(w, s) for s in landmarks] for w in cores])


def test_scores_by_brute_force(monkeypatch):
    landmarks = ["idiot", "trash", "loser"]
    texts = ["You idiot. Go home!", None, "", "so t r a s h, said he\nand l-o-s-e-r it is", " \n ", "a b c d e f g h i j k l m n o p q r s t. Losers!",
             "plain words only, nothing else here", "idiot " * 40 + "\n" + "the end. " * 30, "l o", "s e r"]
    direction, weights = np.array([1.5, -0.4, 0.9]), np.linspace(-1, 1, 9)
    model = tx.Model(landmarks, direction, -0.6, weights)
    want = []
    for text in texts:
        found, words = brute_sentences(text or "", landmarks)
        if not len(found):
            want.append(0.0)
            continue
        margins = words @ direction - 0.6
        counts = np.array([(margins > x).sum() for x in tx.LEVELS])
        x = np.r_[np.clip((found @ direction - 0.6).max(), -2, 2), np.log1p(len(words)) / 5, np.log1p(counts), 10 * np.sqrt(counts / len(words))]
        want.append(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))))
    for block, piece in ((1 << 20, 1 << 16), (40, 7)):
        monkeypatch.setattr(tx, "BLOCK", block)
        monkeypatch.setattr(tx, "PIECE", piece)
        assert list(model.scores(tx.Landmarks(landmarks), pa.array(texts))) == pytest.approx(want, rel=1e-4)
    assert list(model.scores(tx.Landmarks(landmarks), pa.array([], pa.string()))) == []


def test_candidates_and_sentence_choice():
    assert {"idio", "diot", "idiot", "idiots"} <= set(tx._parts("(Idiots!")) and "diots" in tx._parts("xxxxxxxxxxxxxxidiots") and "horrid" in tx._parts("h.o.r-r.i.d!") and not tx._parts("abc")
    x = np.random.default_rng(1).random((100, 4))
    some = tx.sentence_choice(x, 10)
    assert len(some) == 10 and set(map(tuple, some)) <= set(map(tuple, x)) and np.sort(x.max(1))[-5:] == pytest.approx(np.sort(some.max(1))[-5:])
    assert tx.sentence_choice(x, 100) is x


def test_machine_separates():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(400, 5))
    y = np.sign(x[:, 0] + 0.5 * x[:, 1] - 0.3)
    w, b = tx.fit_svm(x, y, np.ones(400))
    assert (np.sign(x @ w + b) == y).mean() > 0.98
    w = tx.fit_logistic(x, (y > 0).astype(float))
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def corpus():
    rows = []
    for i in range(300):
        words = [f"common{j * i % 17} ordinary{j % 5} text{i % 7}." for j in range(6)]
        if i % 3 == 0:
            words.insert(3, "you are " + ["a horrid wretch", "a h.o.r.r.i.d thing", "so wretchxed"][i % 9 // 3] + " indeed.")
        rows.append((i, " ".join(words), "x", 0.5))
    return rows


def test_gapped_insults_and_odd_rows(spark):
    rows = corpus() + [(1000, None, "x", 0.0), (1001, "", "x", 0.0), (1002, "horrid " * 20_000, "x", 0.0), (None, "a horrid wretch", "x", 0.0), (3, corpus()[3][1], "x", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held_out string, score double")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    got = tx.toxicity(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    right = [r.predicted == (r.doc_id % 3 == 0) for r in got if r.doc_id is not None and r.doc_id < 300]
    assert sum(right) / len(right) > 0.95
    odd = {r.doc_id: r.predicted for r in got if r.doc_id is None or r.doc_id >= 1000}
    assert odd == {1000: 0, 1001: 0, 1002: 1, None: 1}
    assert {r.score for r in tx.toxicity(df, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in tx.toxicity(df, labels.where("toxic = 0")).collect()} == {0.0}
    assert tx.toxicity(df.limit(0), labels).collect() == []


def test_held_out_documents(spark):
    import __spark_entry__ as e
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in e.queries()["op4_string_kernel_toxicity"](spark, d).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    held = [(got[i].predicted, t) for i, t in labels.items() if got[i].held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.9
