"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every text.
Expectation-maximisation estimates how accurate each is and how common
good texts are, from the counts of vote patterns alone (three votes to the
power of the number of labellers at most, whatever the input), and gives
each pattern a posterior.  Posteriors are the soft labels of a linear
scorer over hashed features of the text, fitted on a sample of at most
about ``SAMPLE`` documents and applied to all.  No given label is used.

Estimates are kept sane by pseudo-counts, by bounds on the share of good
texts, and by holding that a bad vote is commoner on bad texts than on
good ones, so a corpus with next to no bad texts is not split in two for
the sake of its own variety.

A null or empty text has no words: every labeller votes bad.  Repeated
rows and null doc_ids are scored one by one, extra columns are ignored and
an empty table gives an empty table.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import batches_out, only_memo, stored

LABELLERS = ["symbols", "stutter", "variety", "sentences", "loose_signs", "same_lines", "word_length", "mixed_words", "shouting", "exclaiming"]
SAMPLE = 8_000
DIMS = 1 << 14
SIGNS = "#*$%&|<>{}[]=~^"


# ------------------------------------------------------------------- labellers

def word_kind(word: str) -> int:
    """0 letters or digits (with ordinary punctuation around), 1 no letter
    or digit at all, 2 letters mixed with signs."""
    if not any(c.isalnum() for c in word):
        return 1
    return 2 if any(c in SIGNS for c in word) else 0


def described(word: str) -> tuple[int, str, bool]:
    """Kind, shape and whether it is shouted: two capitals or more and no
    small letter.  A shape has letters and digits by class, runs as one,
    and signs as themselves."""
    core, tail = (word[:-1], word[-1]) if word[-1] in ".,!?" else (word, "")
    if core.isalpha():
        if core.islower():
            return 0, "a" + tail, False
        if core.isupper():
            return 0, "A" + tail, len(core) > 1
        if core[:1].isupper() and core[1:].islower():
            return 0, "Aa" + tail, False
    shape = "".join("a" if c.islower() else "A" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return word_kind(word), re.sub(r"(.)\1+", r"\1", shape), word.isupper() and sum(map(str.isalpha, word)) > 1


def _between(x: float, good: float, bad: float) -> int:
    """+1 up to ``good``, -1 from ``bad`` on, 0 between."""
    return 1 if x <= good else -1 if x >= bad else 0


def votes(text: str, words: list[str], kinds: np.ndarray, same: float, shouted: float) -> list[int]:
    """The labellers' votes, -1, 0 or 1, in the order of ``LABELLERS``.
    ``same``: the share of words equal to the word before; ``shouted``: of
    words of two capital letters or more and no small one."""
    n = len(words)
    if not n:
        return [-1] * len(LABELLERS)
    lines = [x for x in text.split("\n") if x.strip()]
    ends = len(re.findall(r"[.!?](?=\s|$)", text))
    shares = np.bincount(kinds, minlength=3) / n
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
    length = sum(map(len, words)) / n
    return [
        _between(sum(map(text.count, SIGNS)) / len(text), 0.004, 0.02),
        _between(same, 0.03, 0.2),
        0 if n < 20 else _between(1 - len(set(words)) / n, 0.6, 0.85),
        0 if n < 20 else _between(-ends / n, -0.02, -0.002),
        _between(float(shares[1]), 0.01, 0.1),
        0 if len(lines) < 4 else _between(repeated, 0.1, 0.4),
        1 if 2.5 <= length <= 12 else -1 if length < 1.5 or length > 20 else 0,
        _between(float(shares[2]), 0.02, 0.15),
        0 if n < 5 else _between(shouted, 0.1, 0.4),
        _between(text.count("!") / n, 0.05, 0.3),
    ]


def pattern(vote: list[int]) -> int:
    code = 0
    for v in vote:
        code = code * 3 + v + 1
    return code


#: Chances of the votes (bad, good), when one is cast, on a bad and on a good text before any are seen.
BEFORE = np.array([[0.35, 0.65], [0.02, 0.98]])
GOOD_BEFORE = 0.85


def estimate(counts: dict[int, int], rounds: int = 200, pseudo: float = 0.01) -> tuple[dict[int, float], np.ndarray, float]:
    """(posterior of good by pattern, chance of each vote by labeller and
    class, share of good texts) by expectation-maximisation on pattern
    counts.  A labeller's accuracy differs by class: most see one kind of
    bad text and vote good on the other kinds."""
    m = len(LABELLERS)
    codes = np.array(sorted(counts), np.int64)
    weight = np.array([counts[c] for c in codes.tolist()], float)
    vote = codes[:, None] // 3 ** np.arange(m - 1, -1, -1) % 3
    cast = [vote == v for v in range(3)]
    chance = np.repeat(BEFORE[None], m, 0)          # labeller, class, vote (bad, good)
    good, prior = GOOD_BEFORE, pseudo * max(1.0, weight.sum())
    q = np.zeros(len(codes))
    place = np.arange(m)[None, :]
    for _ in range(rounds):
        logs = np.log(chance)
        # a labeller that says nothing has nothing to go by: no evidence
        odds = np.log(good / (1 - good)) + np.where(cast[1], 0.0, logs[place, 1, vote // 2] - logs[place, 0, vote // 2]).sum(1)
        q = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        for k, share in ((0, 1 - q), (1, q)):
            seen = np.stack([(weight[:, None] * share[:, None] * c).sum(0) for c in (cast[0], cast[2])], 1) + prior * BEFORE[k]
            chance[:, k] = seen / seen.sum(1, keepdims=True)
        # a bad vote speaks for a bad text, however the counts fall
        chance[:, 0, 0] = np.maximum(chance[:, 0, 0], 1.5 * chance[:, 1, 0])
        chance[:, 0] /= chance[:, 0].sum(1, keepdims=True)
        good = float(np.clip((weight @ q + GOOD_BEFORE * prior) / (weight.sum() + prior), 0.3, 0.99))
    return dict(zip(codes.tolist(), q.tolist(), strict=True)), chance, good


# -------------------------------------------------------------------- features

class Reader:
    """Words of a text with the kind and hashed features of each; what was
    worked out for a word is kept, for at most ``max_words`` of them."""

    def __init__(self, max_words: int = 300_000):
        self.max_words = max_words
        self._clear()

    def _clear(self):
        self.known: dict[str, int] = {}
        self.kind = np.zeros(1 << 12, np.int8)
        self.shape = np.zeros(1 << 12, np.int64)
        self.shouted = np.zeros(1 << 12, bool)

    def _add(self, word: str) -> int:
        n = len(self.known)
        if n == len(self.kind):
            self.kind, self.shape, self.shouted = (np.concatenate([a, np.zeros_like(a)]) for a in (self.kind, self.shape, self.shouted))
        self.known[word] = n
        self.kind[n], shape, self.shouted[n] = described(word)
        self.shape[n] = crc32(shape.encode("utf-8", "replace"))
        return n

    def read(self, text: str) -> tuple[list[str], np.ndarray]:
        words = text.split()
        if len(self.known) > self.max_words:
            self._clear()
        known = self.known
        for w in [w for w in words if w not in known]:
            if w not in known:
                self._add(w)
        return words, np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def votes(self, text: str, words: list[str], ids: np.ndarray) -> list[int]:
        same = float((ids[1:] == ids[:-1]).mean()) if len(ids) > 1 else 0.0
        return votes(text, words, self.kind[ids], same, float(self.shouted[ids].mean()) if len(ids) else 0.0)

    def features(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashed feature, value): shapes, neighbouring shapes, a word
        repeated at once, words seen again; damped shares of length one."""
        n = len(ids)
        if not n:
            return np.zeros(1, np.int64), np.ones(1, np.float32)
        shape = self.shape[ids]
        pairs = shape[:-1] * 31 + shape[1:] * 17 + 5
        again = np.full(int((ids[1:] == ids[:-1]).sum()), 3)
        seen = np.full(n - len(np.unique(ids)), 11)
        found, count = np.unique(np.concatenate([shape % DIMS, pairs % DIMS, again, seen]), return_counts=True)
        value = np.sqrt(count / n)
        return found, (value / np.sqrt((value ** 2).sum())).astype(np.float32)


def reader() -> Reader:
    return only_memo(Reader)


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, steps: int = 200, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer for soft targets: full
    gradients with a step size per weight that shrinks as it moves."""
    if not rows:
        return np.zeros(DIMS), 0.0
    place = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows]).astype(float)
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    w, bias = np.zeros(DIMS), 0.0
    moved, moved_bias = np.full(DIMS, 1e-8), 1e-8
    for _ in range(steps):
        z = np.bincount(owner, weights=value * w[place], minlength=len(rows)) + bias
        error = (1 / (1 + np.exp(-z)) - target) / len(rows)
        g = np.bincount(place, weights=value * error[owner], minlength=DIMS) + decay * w
        moved += g * g
        w -= 0.5 * g / np.sqrt(moved)
        gb = float(error.sum())
        moved_bias += gb * gb
        bias -= 0.5 * gb / moved_bias ** 0.5
    return w, bias


# ------------------------------------------------------------------- operator

def classify(df: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, votes (one sign per labeller), posterior, score and kept
    (score of a half or more) of every document."""
    spark = df.sparkSession
    read = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    codes = stored(read.select("doc_id", "text").mapInArrow(_vote_task, "doc_id long, code int"), "votes")
    counts = {r["code"]: r["count"] for r in codes.groupBy("code").count().collect()}
    posterior, _, _ = estimate(counts) if counts else ({}, None, None)
    n = sum(counts.values())
    chosen = read
    if n > sample:
        # every row alike, copies too, so that no group of them fills the sample
        chosen = read.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 40)) < int(sample / n * (1 << 40)))
    rows, target = [], []
    for r in chosen.mapInArrow(_feature_task, "code int, place array<int>, value array<float>").toLocalIterator():
        rows.append((np.array(r["place"], np.int64), np.array(r["value"], np.float32)))
        target.append(posterior[r["code"]])
    w, bias = fit_linear(rows, np.array(target))
    model = spark.sparkContext.broadcast((w, bias, posterior))
    return read.mapInArrow(_score_task(model), "doc_id long, votes string, posterior double, score double, kept boolean")


def _texts(batch: pa.RecordBatch):
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        yield doc_id, text.as_py() or ""


def _vote_task(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("code", pa.int32())])
    r = reader()

    def rows():
        for batch in batches:
            for doc_id, text in _texts(batch):
                yield doc_id, pattern(r.votes(text, *r.read(text)))

    yield from batches_out(schema, rows(), lambda x: 12)


def _feature_task(batches):
    schema = pa.schema([("code", pa.int32()), ("place", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))])
    r = reader()

    def rows():
        for batch in batches:
            for _, text in _texts(batch):
                words, ids = r.read(text)
                place, value = r.features(ids)
                yield pattern(r.votes(text, words, ids)), place.tolist(), value.tolist()

    yield from batches_out(schema, rows(), lambda x: 8 * len(x[1]))


def _score_task(model):
    schema = pa.schema([("doc_id", pa.int64()), ("votes", pa.string()), ("posterior", pa.float64()), ("score", pa.float64()), ("kept", pa.bool_())])

    def run(batches):
        r = reader()
        w, bias, posterior = model.value

        def rows():
            for batch in batches:
                for doc_id, text in _texts(batch):
                    words, ids = r.read(text)
                    vote = r.votes(text, words, ids)
                    place, value = r.features(ids)
                    score = float(1 / (1 + np.exp(-(w[place] @ value + bias)))) if words else 0.0
                    yield doc_id, "".join("-0+"[v + 1] for v in vote), posterior[pattern(vote)], score, score >= 0.5

        yield from batches_out(schema, rows(), lambda x: 60)

    return run
