"""Toxicity by a subsequence string kernel and Nyström landmarks.

The kernel of two strings sums, over the character triples they share as
subsequences, the products of their weights; a triple spread over more
characters weighs less (``DECAY`` per character).  Triples are of letters
and digits; other characters only widen gaps.  The kernel is divided by
the root of both strings' own values, so that every string is 1 with
itself, and an insult with inserted or missing characters stays close to
the plain one.  Its ``POWER``-th power, a kernel too, sets close strings
off from those that share a little.  Landmarks are parts of words whose
document frequency differs most between toxic and other labelled texts.
A word's Nyström features are its kernel values with the landmarks, times
the inverse root of the landmarks' own kernel matrix; before that product
a word of many characters takes the largest value of each over its
windows, and a sentence over its words (runs of single characters also
count as one word, so spelt-out insults are seen).  A linear support
vector machine is trained on sentences: those of texts that are not toxic
against, from toxic texts, the sentence that looks worst so far (three
rounds).  A text's score is a logistic function of the largest margin of
its sentences and of how many different words of it have margins above
some levels.

It learns from a sample of at most ``SAMPLE`` labelled texts of each kind
outside fold 0 and, for the machine, at most ``SENTENCES`` different
sentences of each; nothing but the text enters a score.  All texts are scored whole.

Null, empty and blank texts have no sentences and score 0.  Labels that disagree about a doc_id count as toxic.  Repeated
rows and null doc_ids (not held out) are scored one by one; extra columns
are ignored; without labels of both kinds every score is 0; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import batches_out, label_fold

DECAY = 0.6
POWER = 3
SPAN = 8                # characters that a triple may spread over
WIDTH = 8               # longer words are read in windows of this many letters and digits
RUN = 12                # spelt-out words are read in windows of this many parts
PARTS = (4, 5, 6, 7, WIDTH)                     # lengths of landmark candidates
LANDMARKS = 48
SAMPLE = 3_000          # labelled texts of each kind to learn from
SENTENCES = 32          # different sentences of a text to learn from
BLOCK = 1 << 20         # bytes of texts that are read together
PIECE = 1 << 16         # words whose features are held at a time
OUTER = ".,;:!?\"'()[]{}#*$%&|<>-_~^+=/\\@`"      # taken off both ends of a word
#: Letters and digits with a class of their own; other letters share one of four, all else is 0.
ALPHABET = "abcdefghijklmnopqrstuvwxyzäöüßéèêëàâáçñóíúîôûùœ0123456789"
CLASSES = 64


def _class(c: str) -> int:
    return ALPHABET.find(c) + 1 or (59 + ord(c) % 4 if c.isalpha() else 0)


#: Classes of the first code points; those behind are taken for letters.
_TABLE = np.array([_class(chr(i)) for i in range(0x3000)], np.int64)


def code(text: str) -> np.ndarray:
    """The class of every character."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < len(_TABLE), _TABLE[np.minimum(points, len(_TABLE) - 1)], 59 + points % 4).astype(np.int32)


@lru_cache(maxsize=64)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of all triples in n characters and what each spans, less two."""
    found = [(i, j, k) for i in range(n) for k in range(i + 2, min(n, i + SPAN)) for j in range(i + 1, k)]
    i, j, k = np.array(found, np.int64).reshape(-1, 3).T
    return i, j, k, (k - i - 1).astype(np.int32)


#: Weight by span less two; 0 stands for triples with a character that is no letter or digit.
_WEIGHT = np.r_[0, DECAY ** np.arange(3.0, SPAN + 1)].astype(np.float32)


def _triple_codes(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triples of strings of one length (rows of classes), 0 where a class is 0, and spans."""
    i, j, k, span = _triples(c.shape[1])
    a, b, z = np.take(c, i, axis=1), np.take(c, j, axis=1), np.take(c, k, axis=1)
    triples = (a * CLASSES + b) * CLASSES + z
    if not c.all():
        triples[(a == 0) | (b == 0) | (z == 0)] = 0
    return triples, span


def _own_values(triples: np.ndarray, span: np.ndarray) -> np.ndarray:
    """The kernel of each row's string with itself: equal triples stand
    together once sorted, their weights are added and squared."""
    keys = np.sort(np.where(triples, triples * 8 + span, 0).astype(np.int32), axis=1)
    same = keys >> 3
    starts = np.flatnonzero(np.c_[np.ones(len(keys), bool), same[:, 1:] != same[:, :-1]])
    sums = np.add.reduceat(_WEIGHT[keys & 7].ravel(), starts)
    return np.add.reduceat(sums * sums, np.searchsorted(starts, np.arange(len(keys)) * keys.shape[1]))


def triple_weights(text: str) -> dict[int, float]:
    """The kernel's features of a string: triple -> summed weight."""
    triples, span = _triple_codes(code(text).reshape(1, -1))
    out: dict[int, float] = {}
    for t, w in zip(triples[0].tolist(), DECAY ** (span + 2.0), strict=True):
        if t:
            out[t] = out.get(t, 0.0) + float(w)
    return out


def kernel(a: str, b: str) -> float:
    """Of two strings, before they are scaled to 1 with themselves."""
    x, y = triple_weights(a), triple_weights(b)
    return sum(w * y[t] for t, w in x.items() if t in y)


class Landmarks:
    """Kernel values of words with the landmarks, every string scaled to 1
    with itself.  Values of cores of words met before are kept, ``max_words`` at most."""

    def __init__(self, strings: list[str], max_words: int = 900_000):
        self.strings, self.max_words = strings, max_words
        self.m = len(strings)
        self.place = np.zeros(CLASSES ** 3, np.int32)
        rows = [np.zeros(self.m, np.float32)]
        for n, s in enumerate(strings):
            w = triple_weights(s)
            own = sum(x * x for x in w.values()) ** 0.5
            for t, x in w.items():
                if not self.place[t]:
                    self.place[t] = len(rows)
                    rows.append(np.zeros(self.m, np.float32))
                rows[self.place[t]][n] = x / own
        self.rows = np.array(rows)
        self._clear()

    def _clear(self):
        self.cores: dict[str, int] = {}
        self.values = np.zeros((1024, self.m), np.float32)

    def kernel_values(self, words: list[str]) -> np.ndarray:
        """One row per word (its core, see ``_core``): the largest values of its windows."""
        out = np.zeros((len(words), self.m), np.float32)
        by_length: dict[int, tuple[list, list]] = {}
        longer: list[tuple[int, str]] = []
        for n, w in enumerate(words):
            if len(w) > WIDTH:
                longer += [(n, x) for x in _windows(w)]
            elif len(w) >= 3:
                owners, found = by_length.setdefault(len(w), ([], []))
                owners.append(n)
                found.append(w)
        for length, (owners, found) in by_length.items():
            for at in range(0, len(found), 2048):
                rows, values = self._values_of(found[at:at + 2048], length)
                out[np.array(owners[at:at + 2048])[rows]] = values
        if longer:
            windows = list(dict.fromkeys(w for _, w in longer))
            row = dict(zip(windows, range(len(windows)), strict=True))
            found = np.zeros((len(windows), self.m), np.float32)
            lengths = np.fromiter(map(len, windows), np.int64, len(windows))
            for length in np.unique(lengths[lengths >= 3]).tolist():
                where = np.flatnonzero(lengths == length)
                for at in range(0, len(where), 2048):
                    rows, values = self._values_of([windows[i] for i in where[at:at + 2048]], length)
                    found[where[at:at + 2048][rows]] = values
            owners = np.array([n for n, _ in longer])
            starts = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
            out[owners[starts]] = np.maximum.reduceat(found[[row[w] for _, w in longer]], starts, axis=0)
        return out

    def _values_of(self, strings: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
        """Which strings of one length share a triple with a landmark, and their values."""
        triples, span = _triple_codes(code("".join(strings)).reshape(len(strings), length))
        place = self.place[triples]                 # 0: no landmark has the triple
        row, col = np.nonzero(place)
        if not len(row):
            return row, np.zeros((0, self.m), np.float32)
        terms = self.rows[place[row, col]] * _WEIGHT[span][col, None]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        hit = row[first]
        values = np.add.reduceat(terms, first, axis=0) / np.sqrt(_own_values(triples[hit], span))[:, None]
        return hit, values ** POWER

    def learn(self, cores: list[str]) -> np.ndarray:
        """The rows of ``values`` that hold those of different ``cores``;
        what is not known is worked out."""
        if len(self.cores) > self.max_words:
            self._clear()
        known = self.cores
        fresh = [c for c in cores if c not in known]
        if fresh:
            first = len(known)
            while first + len(fresh) > len(self.values):
                self.values = np.concatenate([self.values, np.zeros_like(self.values)])
            self.values[first:first + len(fresh)] = self.kernel_values(fresh)
            known.update(zip(fresh, range(first, first + len(fresh)), strict=True))
        return np.fromiter(map(known.__getitem__, cores), np.int64, len(cores))

    def sentences(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Features of every sentence, and of every different word."""
        block = self.block(pa.array([text], pa.large_string()))
        return block.sentences, block.values[block.words]

    def blocks(self, texts: pa.Array):
        """``texts`` in blocks of whole texts, of ``BLOCK`` bytes or one text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + BLOCK, "right")))
            yield self.block(texts[first:last])
            first = last

    def block(self, texts: pa.Array) -> Block:
        ids, names, line_starts, text_starts = _read(texts)
        cores = pc.utf8_lower(pc.utf8_trim(names, characters=OUTER)).dictionary_encode()
        extra, where = spelt_out(ids, names, text_starts)
        own = cores.dictionary.to_pylist()
        row = self.learn(list(dict.fromkeys(own + [_core(w) for w in extra])))[:len(own)]
        extra_row = np.fromiter((self.cores[_core(w)] for w in extra), np.int64, len(extra))
        rows = row[cores.indices.to_numpy()][ids]
        stops = pc.or_(pc.or_(pc.ends_with(names, "."), pc.ends_with(names, "!")), pc.ends_with(names, "?")).to_numpy(zero_copy_only=False)
        n = len(ids)
        begins = np.zeros(n + 1, bool)
        begins[line_starts] = True
        begins[1:][stops[ids]] = True
        starts = np.flatnonzero(begins[:n])
        found = np.zeros((len(starts), self.m), np.float32)
        for at in range(0, n, PIECE):
            first, last = np.searchsorted(starts, (at, min(n, at + PIECE)))
            inside = starts[first:last] - at
            if not len(inside) or inside[0]:            # goes on with the last sentence
                first, inside = first - 1, np.r_[0, inside]
            part = np.maximum.reduceat(self.values[rows[at:at + PIECE]], inside, axis=0)
            found[first:last] = np.maximum(found[first:last], part)
        owner = np.searchsorted(text_starts[1:], starts, "right")
        np.maximum.at(found, np.searchsorted(starts, where, "right") - 1, self.values[extra_row])
        text_of = np.r_[np.repeat(np.arange(len(texts)), np.diff(text_starts)), np.searchsorted(text_starts[1:], where, "right")]
        text, words = np.divmod(np.unique(text_of * len(self.values) + np.r_[rows, extra_row]), len(self.values))
        return Block(len(texts), found, owner, self.values, words, text)


class Block(NamedTuple):
    """What is found in some texts: features of their sentences and the
    rows in ``values`` of each text's different words, both in order of
    the texts, and which text each is of."""

    n_texts: int
    sentences: np.ndarray
    sentence_text: np.ndarray
    values: np.ndarray
    words: np.ndarray
    word_text: np.ndarray


def _core(word: str) -> str:
    """Small letters, without characters at the ends that no triple holds."""
    return word.strip(OUTER).lower()


def _windows(core: str) -> list[str]:
    """Windows of ``WIDTH`` letters and digits, half a window apart.  Other
    characters between two of them stay, at most as many as a triple spans."""
    starts = range(0, max(1, len(core) - WIDTH // 2), WIDTH // 2)
    if core.isalnum():
        return [core[i:i + WIDTH] for i in starts]
    places = np.flatnonzero(code(core))
    after = np.arange(len(core))
    last = places[np.searchsorted(places, after, "right") - 1] if len(places) else after + 1
    text = "".join(core[i] for i in np.flatnonzero((after >= last) & (after <= last + SPAN)))
    places = np.flatnonzero(code(text))
    return [text[places[i]:places[min(i + WIDTH, len(places)) - 1] + 1] for i in starts if i == 0 < len(places) or i < len(places) - WIDTH // 2]


def _read(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Words as places in a list of different ones, that list, and where
    lines and texts begin (and end) among the words."""
    lines = pc.split_pattern(texts, "\n")
    words = pc.utf8_split_whitespace(lines.flatten())
    flat = words.flatten().dictionary_encode()
    ids, names = flat.indices.to_numpy(), flat.dictionary
    line_starts = words.offsets.to_numpy()
    empty = pc.index(names, "").as_py()
    if empty >= 0:                                      # white space at the ends of a line
        there = ids != empty
        line_starts = np.r_[0, np.cumsum(there)][line_starts]
        ids = ids[there]
    return ids, names, line_starts, line_starts[lines.offsets.to_numpy()]


def spelt_out(ids: np.ndarray, names: pa.Array, text_starts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Runs of three or more words of one or two characters in a text,
    joined, in windows of ``RUN`` words; and where each begins."""
    joined, where = [], []
    if len(ids):
        short = np.r_[(pc.utf8_length(names).to_numpy(zero_copy_only=False) <= 2)[ids], False]
        before = np.r_[False, short[:-1]]
        before[text_starts] = False
        firsts = np.flatnonzero(short & ~before)
        breaks = np.unique(np.r_[np.flatnonzero(~short), text_starts])
        lasts = breaks[np.searchsorted(breaks, firsts, "right")]
        for first, last in zip(firsts.tolist(), lasts.tolist(), strict=True):
            if last - first >= 3:
                for start in range(first, max(first + 1, last - RUN // 2), RUN // 2):
                    joined.append("".join(names.take(pa.array(ids[start:min(last, start + RUN)])).to_pylist()))
                    where.append(start)
    return joined, np.array(where, np.int64)


# -------------------------------------------------------------------- training

def choose_landmarks(stats: list[tuple[str, int, int]], toxic: int, other: int, count: int = LANDMARKS) -> list[str]:
    """Strings in order of how their document shares differ (two-sample z),
    leaving out parts of one already taken and those too close to one."""
    def z(s):
        a, b = s[1] / toxic, s[2] / other
        p = (s[1] + s[2] + 1) / (toxic + other + 2)
        return (a - b) / np.sqrt(p * (1 - p) * (1 / toxic + 1 / other))

    taken: list[str] = []
    own: dict[str, float] = {}
    for s, *_ in sorted(stats, key=lambda s: (-z(s), -len(s[0]), s[0])):
        mine = kernel(s, s)
        if mine and not any(s in t for t in taken) and all(kernel(s, t) < 0.55 * np.sqrt(mine * own[t]) for t in taken):
            taken.append(s)
            own[s] = mine
            if len(taken) == count:
                break
    return taken


def whitening(landmarks: Landmarks) -> np.ndarray:
    """K^(-1/2) of the landmarks' kernel matrix, small directions damped."""
    k = landmarks.kernel_values(landmarks.strings).astype(float)
    value, vector = np.linalg.eigh(k)
    return vector @ np.diag(1 / np.sqrt(np.maximum(value, 0.05))) @ vector.T


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 40, c: float = 2_000.0) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge, by Newton steps:
    a weighted least-squares fit to the rows inside the margin."""
    x = np.c_[x, np.ones(len(x))]
    weight = weight / weight.sum()
    ridge = np.eye(x.shape[1]) / (2 * c)
    ridge[-1, -1] = 1e-9
    w, inside = np.zeros(x.shape[1]), np.ones(len(x), bool)
    for _ in range(rounds):
        part = x[inside] * weight[inside, None]
        w = 0.5 * w + 0.5 * np.linalg.solve(part.T @ x[inside] + ridge, part.T @ y[inside]) if w.any() else np.linalg.solve(part.T @ x[inside] + ridge, part.T @ y[inside])
        now = y * (x @ w) < 1
        if (now == inside).all() or not now.any():
            break
        inside = now
    return w[:-1], float(w[-1])


#: Margins that words are counted above: well inside, near and past the boundary.
LEVELS = np.array([-0.7, -0.3, 0.0])


def summaries(block: Block, direction: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """Which texts have words, and what their scores are made of: the
    largest margin of a sentence, how many different words there are, and
    how many of them have margins above each level, and their share."""
    first = np.flatnonzero(np.r_[True, block.sentence_text[1:] != block.sentence_text[:-1]][:len(block.sentence_text)])
    text = block.sentence_text[first]
    if not len(text):
        return text, np.zeros((0, 2 + 2 * len(LEVELS)))
    worst = np.maximum.reduceat(block.sentences @ direction + bias, first)
    row, place = np.unique(block.words, return_inverse=True)
    margin = (block.values[row] @ direction + bias)[place]
    begin = np.searchsorted(block.word_text, text)
    many = np.add.reduceat(np.ones(len(margin)), begin)
    counts = np.add.reduceat(margin[:, None] > LEVELS, begin, axis=0, dtype=float)
    return text, np.c_[np.clip(worst, -2, 2), np.log1p(many) / 5, np.log1p(counts), 10 * np.sqrt(counts / many[:, None])]


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method; the last weight is the bias."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(h, x.T @ (p - y) + ridge * w)
        w = w - move
        if np.abs(move).max() < 1e-8:
            break
    return w


class Model:
    """Scores texts; small enough to send to every task."""

    def __init__(self, strings, direction, bias, weights=None):
        self.strings, self.direction, self.bias, self.weights = strings, direction, bias, weights

    def scores(self, landmarks: Landmarks, texts: pa.Array):
        """Texts without words score 0."""
        for block in landmarks.blocks(texts):
            out = np.zeros(block.n_texts)
            text, x = summaries(block, self.direction, self.bias)
            out[text] = 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))
            yield from out.tolist()


def fit_sentences(bags: list[tuple[int, np.ndarray]], landmarks: Landmarks) -> Model:
    """The machine, from (toxic, sentence features) of labelled texts."""
    white = whitening(landmarks)
    toxic = np.array([t for t, _ in bags], float)
    owner = np.repeat(np.arange(len(bags)), [len(s) for _, s in bags])
    x = np.concatenate([s for _, s in bags]) @ white
    margin = np.concatenate([s for _, s in bags]).max(1)
    direction, bias = np.zeros(x.shape[1]), 0.0
    for _ in range(3):
        worst = {}
        for i in np.argsort(margin, kind="stable"):
            worst[owner[i]] = i
        positive = np.array([i for d, i in worst.items() if toxic[d]], int)
        negative = np.flatnonzero(toxic[owner] == 0)
        rows = np.concatenate([positive, negative])
        y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
        weight = np.r_[np.full(len(positive), 0.5 / max(1, len(positive))), np.full(len(negative), 0.5 / max(1, len(negative)))]
        direction, bias = fit_svm(x[rows], y, weight)
        margin = x @ direction + bias
    return Model(landmarks.strings, white @ direction, bias)


# -------------------------------------------------------------------- operator

def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """toxic and text of at most ``sample`` labelled documents of each kind
    outside fold 0, taken in the order of a hash of their doc_id."""
    one = labels.where(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    usable = one.where(label_fold(F.col("doc_id")) != 0)
    kinds = [usable.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for t in (0, 1)]
    chosen = F.broadcast(kinds[0].unionByName(kinds[1]))        # at most 2 x sample rows of 12 bytes
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id").select("toxic", "text")


@lru_cache(maxsize=200_000)
def _parts(word: str) -> tuple[str, ...]:
    """A word's parts of the candidate lengths, inner ones too, without
    what stands between its letters and digits."""
    core = _core(word)
    if not core.isalnum():
        core = "".join(filter(str.isalnum, core))
    return tuple(core[i:i + n] for n in PARTS for i in range(len(core) - n + 1))


def _string_task(batches):
    """In how many toxic and in how many other texts of the task each part of a word stands."""
    schema = pa.schema([("s", pa.string()), ("a", pa.int64()), ("b", pa.int64())])
    counts: tuple[Counter, Counter] = Counter(), Counter()
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts[1 - toxic].update(set().union(*map(_parts, set((text.as_py() or "").split()))))
            if len(counts[0]) + len(counts[1]) > 1_000_000:
                yield from batches_out(schema, _both(*counts), lambda r: 32)
                counts = Counter(), Counter()
    yield from batches_out(schema, _both(*counts), lambda r: 32)


def _both(a: Counter, b: Counter):
    return ((s, a[s], b[s]) for s in a.keys() | b.keys())


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sentences: int = SENTENCES) -> Model | None:
    chosen = labelled_sample(docs, labels, sample)
    kinds = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    if len(kinds) < 2:
        return None
    strings = chosen.mapInArrow(_string_task, "s string, a long, b long").groupBy("s").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    lift = F.col("a") / kinds[1] - F.col("b") / kinds[0]
    top = strings.where(F.col("a") >= 3).orderBy(lift.desc(), F.length("s").desc(), "s").limit(40 * LANDMARKS).collect()
    taken = choose_landmarks([(r["s"], r["a"], r["b"]) for r in top], kinds[1], kinds[0])
    if not taken:
        return None
    landmarks = Landmarks(taken)

    found = [(r["toxic"], np.frombuffer(r["features"], np.float32).reshape(-1, len(taken)))
             for r in chosen.mapInArrow(_bag_task(taken, sentences), "toxic int, features binary").toLocalIterator()]
    model = fit_sentences(found, landmarks)
    sums = [(r["toxic"], r["summary"]) for r in chosen.mapInArrow(_summary_task(model), "toxic int, summary array<double>").toLocalIterator()]
    model.weights = fit_logistic(np.array([x for _, x in sums]), np.array([t for t, _ in sums], float))
    return model


def sentence_choice(found: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` rows."""
    if len(found) <= most:
        return found
    order = np.argsort(-found.max(1), kind="stable")
    near = most // 2
    return found[np.r_[order[:near], order[np.linspace(near, len(order) - 1, most - near).astype(int)]]]


def _bag_task(strings: list[str], most: int = SENTENCES):
    """Features of each text's different sentences.  Of more than
    ``most``, training takes the half of them closest to any landmark and
    an even choice of the others."""
    def run(batches):
        schema = pa.schema([("toxic", pa.int32()), ("features", pa.binary())])
        landmarks = _landmarks(tuple(strings))

        def rows():
            for batch in batches:
                toxic = iter(batch.column(0).to_pylist())
                for block in landmarks.blocks(batch.column(1)):
                    edges = np.searchsorted(block.sentence_text, np.arange(block.n_texts + 1))
                    for first, last in zip(edges[:-1], edges[1:], strict=True):
                        kind = next(toxic)
                        if last > first:
                            yield kind, sentence_choice(np.unique(block.sentences[first:last], axis=0), most).tobytes()

        yield from batches_out(schema, rows(), lambda r: len(r[1]))

    return run


def _summary_task(model: Model):
    def run(batches):
        schema = pa.schema([("toxic", pa.int32()), ("summary", pa.list_(pa.float64()))])
        landmarks = _landmarks(tuple(model.strings))

        def rows():
            for batch in batches:
                kinds, at = batch.column(0).to_pylist(), 0
                for block in landmarks.blocks(batch.column(1)):
                    text, x = summaries(block, model.direction, model.bias)
                    yield from zip((kinds[at + t] for t in text.tolist()), x.tolist(), strict=True)
                    at += block.n_texts

        yield from batches_out(schema, rows(), lambda r: 80)

    return run


def score(df: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every text."""
    read = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        return read.select("doc_id", F.lit(0.0).alias("score"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
        m = shared.value
        landmarks = _landmarks(tuple(m.strings))

        def rows():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), m.scores(landmarks, batch.column(1)), strict=True)

        yield from batches_out(schema, rows(), lambda r: 16)

    return read.mapInArrow(run, "doc_id long, score double")


@lru_cache(maxsize=1)
def _landmarks(strings: tuple) -> Landmarks:
    return Landmarks(list(strings))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = score(docs, train(docs, labels, sample))
    return scored.select("doc_id", F.coalesce(label_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
