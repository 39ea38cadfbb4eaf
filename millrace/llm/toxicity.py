"""Operator 7: toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The string kernel of two words sums, over all letter triples that both hold as subsequences, decay ** span of each
occurrence, divided by the words' own norms; the kernel of the machine is a Gaussian of the distance it gives. Spans
reach over REACH letters, so a word with letters put in between, left out or repeated still shares triples with the
plain one; digits stand for the letters they look like and punctuation inside a word is passed over. Landmarks are
words of the labelled texts: the telling ones, and the clean words nearest to them. The Nyström map sends a word to
its kernel values with the landmarks, whitened. A linear support vector machine on that map is trained with a text's
most toxic word standing for the text, which is chosen anew after every fit, and with the words that only toxic texts
hold, far beyond chance, against the words of clean texts.

Every word of a text goes through the machine, a word that stands there often once. To be trained with, of the words of
clean texts those count that can come near a telling landmark; a bound on the string kernel with all of them, which is
one table lookup for each triple, finds them (ToxicConfig.near).
A text's score is a logistic function of its highest word value, fitted on labelled texts kept out of the machine.

The driver gets the distinct words of the labelled sample, which tasks cut from the texts. Rows of the Nyström map are
made block by block; HELD blocks are kept, and made anew beyond that, so what they take does not grow with the words.

Null and empty texts, and texts without letters, get the least score. Without labels of both
kinds, or without a word of three letters in labelled texts, every score is 0. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .letters import SYMBOLS, bounded_sample, held_out, stream

#: Places after the first that a triple may reach, and the pairs of places that make one with it.
REACH = 4
PAIRS = [(i, j) for j in range(2, REACH + 1) for i in range(1, j)]
TRIPLES = SYMBOLS**3
#: Words whose rows of the Nyström map are made at once, and how many such blocks are kept between the steps of a fit.
BLOCK = 4096
HELD = 16


@dataclass(frozen=True)
class ToxicConfig:
    each: int = 2500  #: labelled rows of either label to learn from, the bound of the sample
    telling: int = 128  #: landmarks among the words of toxic texts
    clean: int = 256  #: landmarks among the words of clean texts
    decay: float = 0.8
    gamma: float = 2.0  #: of the Gaussian
    near: float = 0.5  #: most of the string kernel with a telling landmark that a word must be able to reach to be trained with; less if a copy with a letter put in or left out has less
    rounds: int = 4
    cost: float = 30.0
    gapped: int = 8  #: copies of each toxic word with one letter put in, which the machine learns beside it
    seed: int = 7


def word_places(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of non-zero symbols begins and ends."""
    inside = np.empty(len(symbols) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = symbols != 0
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def triples(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """For each pair of places (its span, codes at every place, the places where the triple stays inside its word)."""
    wide = np.concatenate([symbols, np.zeros(REACH, symbols.dtype)]).astype(np.int32)
    room = _room(symbols, begin, end)
    n = len(symbols)
    for i, j in PAIRS:
        yield j + 1, (wide[:n] * SYMBOLS + wide[i : n + i]) * SYMBOLS + wide[j : n + j], room > j


def _room(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Letters from each place to its word's end."""
    out = np.zeros(len(symbols), np.int32)
    out[symbols != 0] = np.repeat(end, end - begin) - np.flatnonzero(symbols)
    return out


def norms(lengths: np.ndarray, decay: float) -> np.ndarray:
    """Of words by length: root of the summed squares of their triples' weights."""
    total = np.zeros(len(lengths))
    for _, j in PAIRS:
        total += np.maximum(lengths - j, 0) * decay ** (2 * (j + 1))
    return np.sqrt(total)


@dataclass
class Landmarks:
    """Words by their triples: for each triple the landmarks that have it, and its weight in each."""

    count: int
    first: np.ndarray  #: for each triple, where its landmarks begin in owner and weight; the end last
    owner: np.ndarray
    weight: np.ndarray

    def kernel(self, words: list[bytes], decay: float) -> np.ndarray:
        """Normalised string kernel of words with the landmarks."""
        out = np.zeros((len(words), self.count))
        for low in range(0, len(words), 1024):
            part = words[low : low + 1024]
            who, what, weight = _features(part, decay)
            begin, n = self.first[what], self.first[what + 1] - self.first[what]
            row = np.repeat(np.arange(len(what)), n)
            at = begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            out[low : low + len(part)] = np.bincount(who[row] * self.count + self.owner[at], weight[row] * self.weight[at], len(part) * self.count).reshape(len(part), self.count)
        return out

    def greatest(self) -> np.ndarray:
        """For each triple its greatest weight in a landmark."""
        out = np.zeros(TRIPLES, np.float32)
        np.maximum.at(out, np.repeat(np.arange(TRIPLES), np.diff(self.first)), self.weight.astype(np.float32))
        return out


@dataclass
class Gate:
    """Which words can come near a telling landmark."""

    config: ToxicConfig
    reach: np.ndarray  #: for each triple its greatest weight in a telling landmark
    least: float  #: bound on the string kernel from which on a word is near

    def bound(self, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """What the string kernel of each word with any telling landmark is at most."""
        total = np.zeros(len(symbols), np.float32)
        for span, codes, inside in triples(symbols, begin, end):
            total += self.reach[codes] * (np.float32(self.config.decay**span) * inside)
        return np.add.reduceat(total, begin) / np.maximum(norms(end - begin, self.config.decay), 1e-9)

    def near(self, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.bound(symbols, begin, end) >= self.least) if len(begin) else np.zeros(0, np.int64)


@dataclass
class ToxicModel:
    config: ToxicConfig
    marks: Landmarks
    weights: np.ndarray  #: for each landmark
    bias: float
    floor: float
    slope: float
    shift: float
    known: dict = field(default_factory=dict)  #: values of words that have been met

    def word_values(self, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(words))
        for low in range(0, len(words), 4096):
            out[low : low + 4096] = gaussian(self.marks.kernel(words[low : low + 4096], self.config.decay), self.config.gamma) @ self.weights + self.bias
        return out

    def text_values(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The highest word value of each text."""
        symbols, first = stream(raw, at, digits=True)
        begin, end = word_places(symbols)
        out = np.full(len(at) - 1, self.floor)
        if len(begin):
            # a word is looked at once, however often it stands in the texts
            which, _ = pd.factorize(V.slice_hash(V.prefix_hash(symbols), begin, end))
            one = np.zeros(which.max() + 1, np.int64)
            one[which] = np.arange(len(which))
            data = symbols.tobytes()
            values = self.values([data[i:j] for i, j in zip(begin[one], end[one])])
            np.maximum.at(out, np.searchsorted(first, begin, "right") - 1, values[which])
        return out

    def values(self, words: list[bytes]) -> np.ndarray:
        """Of distinct words; those met before are looked up."""
        if len(self.known) > 400_000:
            self.known.clear()
        if new := [w for w in words if w not in self.known]:
            self.known.update(zip(new, self.word_values(new).tolist()))
        return np.array([self.known[w] for w in words])

    def scores(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.text_values(raw, at) + self.shift, -30, 30)))


def _no_model(config: ToxicConfig) -> ToxicModel:
    return ToxicModel(config, Landmarks(0, np.zeros(TRIPLES + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)), np.zeros(0), 0.0, 0.0, 0.0, -1e3)


def _features(words: list[bytes], decay: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words given as symbols: (word, triple, weight), each triple of a word once and each word's weights with norm 1."""
    symbols = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
    begin, end = word_places(symbols)
    owner = np.zeros(len(symbols), np.int64)
    owner[begin] = 1
    owner = np.cumsum(owner) - 1
    keys, weights = [], []
    for span, codes, inside in triples(symbols, begin, end):
        where = np.flatnonzero(inside)
        keys.append(owner[where] * TRIPLES + codes[where])
        weights.append(np.full(len(where), decay**span))
    keys, back = np.unique(np.concatenate(keys), return_inverse=True)
    weights = np.bincount(back, np.concatenate(weights), len(keys))
    who, what = keys // TRIPLES, keys % TRIPLES
    norm = np.sqrt(np.bincount(who, weights**2, len(words)))
    return who, what, weights / norm[who]


def gaussian(kernel: np.ndarray, gamma: float) -> np.ndarray:
    return np.exp(-2 * gamma * (1 - kernel))


def put_in(word: bytes) -> list[bytes]:
    """Copies of a word with one letter more."""
    return [word[:k] + bytes([c]) + word[k:] for k in range(1, len(word)) for c in range(1, 27)]


def left_out(word: bytes) -> list[bytes]:
    """Copies of a word with one letter less; of a word of four letters or fewer little is left, which many words have."""
    return [word[:k] + word[k + 1 :] for k in range(len(word))] if len(word) > 4 else []


def landmarks(words: list[bytes], decay: float) -> Landmarks:
    who, what, weight = _features(words, decay)
    order = np.argsort(what, kind="stable")
    return Landmarks(len(words), np.searchsorted(what[order], np.arange(TRIPLES + 1)), who[order], weight[order])


class Mapped:
    """Rows of the Nyström map of words, whose last column is 1, in blocks; the first `held` blocks are kept, the others made anew each time."""

    def __init__(self, row: Callable[[list[bytes]], np.ndarray], words: list[bytes], held: int = 0):
        self.row, self.words, self.held, self.kept = row, words, held, {}

    def blocks(self) -> Iterator[np.ndarray]:
        for k, low in enumerate(range(0, len(self.words), BLOCK)):
            block = self.kept[k] if k in self.kept else self.row(self.words[low : low + BLOCK])
            if k < self.held:
                self.kept[k] = block
            yield block

    def values(self, w: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(block @ w for block in self.blocks())])


def _machine(parts: list[tuple[Mapped, int, float]], size: int) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps. parts: rows of so many columns with their label and weight; they are added up block by block."""
    w = np.zeros(size)
    for _ in range(20):
        left, right = np.eye(size), np.zeros(size)
        for x, label, weight in parts:
            for block in x.blocks():
                block = block[label * (block @ w) < 1].astype(np.float64)
                left += weight * (block.T @ block)
                right += weight * label * block.sum(axis=0)
        new = np.linalg.solve(left, right)
        if np.abs(new - w).max() < 1e-6:
            return new
        w = new
    return w


def distinct_words(raw: np.ndarray, at: np.ndarray) -> list[bytes]:
    """For each text its words of three symbols and more, each once, as symbols with a 0 between them."""
    symbols, first = stream(raw, at, digits=True)
    return [b"\0".join(dict.fromkeys(w for w in symbols[i:j].tobytes().split(b"\0") if len(w) >= 3)) for i, j in zip(first, first[1:])]


def train(texts: list[str | None], labels: list[int], config: ToxicConfig) -> ToxicModel:
    return learn([w for text in texts for w in distinct_words(*V.buffers(pa.array([text], pa.large_string())))], labels, config)


def learn(texts: list[bytes], labels: list[int], config: ToxicConfig) -> ToxicModel:
    """texts: the distinct_words() of each."""
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        return _no_model(config)
    number: dict[bytes, int] = {}
    owned = [np.array(sorted({number.setdefault(w, len(number)) for w in text.split(b"\0") if w}), np.int64) for text in texts]
    words = list(number)
    if not words:
        return _no_model(config)
    # near copies count once: of texts whose long words have the same least hash and label the first stays
    long = np.array([len(w) >= 6 for w in words], bool)
    rank = V.mix(np.arange(len(words), dtype=V.U64))
    first: dict[tuple, int] = {}
    for i, mine in enumerate(owned):
        own = rank[mine[long[mine]]]
        first.setdefault((int(own.min()), int(y[i])) if len(own) else (i, -1), i)
    stay = sorted(first.values())
    owned, y = [owned[i] for i in stay], y[stay]
    if y.min() == y.max():
        return _no_model(config)
    # every fourth text has no part in the fit; they show how high clean texts come
    apart_y, apart_texts = y[3::4], owned[3::4]
    fit = [i for i in range(len(y)) if i % 4 != 3]
    owned, y = [owned[i] for i in fit], y[fit]
    if y.min() == y.max():
        return _no_model(config)
    in_toxic, in_clean = np.zeros(len(words)), np.zeros(len(words))
    for mine, label in zip(owned, y):
        (in_toxic if label else in_clean)[mine] += 1
    gain = np.log((in_toxic + 0.5) / ((y == 1).sum() + 1)) - np.log((in_clean + 0.5) / ((y == 0).sum() + 1))
    random = np.random.RandomState(config.seed)
    pull = np.where((in_toxic > 0) & (gain > 0), gain * np.sqrt(in_toxic), 0.0)
    telling = np.argsort(-pull, kind="stable")[: config.telling]
    marks = [words[i] for i in telling]
    table = landmarks(marks, config.decay)
    # words that stand in so many toxic texts, and no clean one, that chance at the share of toxic texts leaves none of all words
    certain = (in_clean == 0) & (in_toxic * -np.log(np.mean(y)) > np.log(100 * len(words)))
    gates = sorted({*marks, *(words[i] for i in np.flatnonzero(certain))})
    gate = Gate(config, landmarks(gates, config.decay).greatest(), config.near)
    for word in (words[i] for i in np.flatnonzero(certain)):
        copies = np.frombuffer(b"\0".join([*put_in(word), *left_out(word)]) + b"\0", np.uint8)
        begin, end = word_places(copies)
        if len(begin):
            gate.least = min(gate.least, float(gate.bound(copies, begin, end).min()) - 1e-4)
    # only words that may come near a telling landmark count from here on
    near = [np.zeros(0, np.int64)]
    for low in range(0, len(words), BLOCK):
        symbols = np.frombuffer(b"\0".join(words[low : low + BLOCK]) + b"\0", np.uint8)
        near.append(low + gate.near(symbols, *word_places(symbols)))
    near = np.concatenate(near)
    place = np.full(len(words), -1)
    place[near] = np.arange(len(near))
    clean = np.flatnonzero(in_clean[near] > 0)
    nearest = [words[near[i]] for i in clean]
    close = np.concatenate([np.zeros(0), *(table.kernel(nearest[low : low + BLOCK], config.decay).max(axis=1, initial=0) for low in range(0, len(nearest), BLOCK))])
    marks += [words[near[i]] for i in clean[np.argsort(-close, kind="stable")[: config.clean]] if words[near[i]] not in set(marks)]
    table = landmarks(marks, config.decay)
    level, axes = np.linalg.eigh(gaussian(table.kernel(marks, config.decay), config.gamma))
    good = level > 1e-6 * level.max()
    white = axes[:, good] / np.sqrt(level[good])

    def mapped(some):
        out = np.ones((len(some), white.shape[1] + 1), np.float32)
        for low in range(0, len(some), 1024):
            out[low : low + 1024, :-1] = gaussian(table.kernel(some[low : low + 1024], config.decay), config.gamma) @ white
        return out

    # the rounds need the values of words of toxic texts alone, the machine the rows of words of clean texts
    ours = np.flatnonzero(in_toxic[near] > 0)
    x_toxic, x_clean = Mapped(mapped, [words[i] for i in near[ours]], HELD), Mapped(mapped, nearest, HELD)
    toxic = [own for mine, label in zip(owned, y) if label and len(own := place[mine][place[mine] >= 0])]
    sure = np.flatnonzero(certain[near])
    value, size = pull[near], white.shape[1] + 1
    for _ in range(config.rounds):
        plus = np.array([own[np.argmax(value[own])] for own in toxic], np.int64)
        plus = np.concatenate([plus[in_clean[near[plus]] == 0], sure]).astype(np.int64)
        apart = sorted({v[:k] + bytes([random.randint(1, 27)]) + v[k:] for v in (words[near[i]] for i in np.unique(plus)) for k in random.randint(1, len(v), config.gapped)})
        more = max(1, len(plus) // max(1, len(apart)))  # they weigh as much as the plain words
        ups, downs = len(plus) + more * len(apart), len(clean)
        unit = config.cost * (ups + downs) / 100  # both labels weigh alike
        x_apart = Mapped(mapped, apart, HELD)
        w = _machine([(Mapped(mapped, [words[i] for i in near[plus]], HELD), 1, unit / max(1, ups)), (x_apart, 1, unit * more / max(1, ups)), (x_clean, -1, unit / max(1, downs))], size)
        value[ours] = x_toxic.values(w)
    del x_toxic, x_clean
    value = Mapped(mapped, [words[i] for i in near]).values(w)
    model = ToxicModel(config, table, white @ w[:-1], float(w[-1]), 0.0, 1.0, 0.0)
    model.floor = float(min(w[-1], value.min(initial=0.0), -1.0))
    # one toxic word is enough: the logistic function parts the toxic words, plain and gapped, from the highest words of clean texts
    low = np.array([value[place[mine][place[mine] >= 0]].max(initial=model.floor) for mine in [mine for mine, label in zip(apart_texts, apart_y) if not label]])
    high = np.concatenate([value[np.unique(plus)], x_apart.values(w)])
    low = np.repeat(low, -(-20 * len(high) // max(1, len(low))))  # clean texts are far more than toxic words
    model.slope, model.shift = _logistic(np.concatenate([low, high]), np.concatenate([np.zeros(len(low), int), np.ones(len(high), int)]))
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic function with softened targets; both labels weigh as often as they occur."""
    plus, minus = (y == 1).sum(), (y == 0).sum()
    goal = np.where(y == 1, (plus + 1) / (plus + 2), 1 / (minus + 2))
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-6 * np.eye(2), a.T @ (goal - p) - 1e-6 * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, config: ToxicConfig = ToxicConfig()) -> ToxicModel:
    """docs: doc_id, text; labels: doc_id, toxic. Learns from labelled rows that are not held out."""
    told = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    told = told.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))  # of labels that disagree the toxic one holds
    told = bounded_sample(told, "toxic", config.each, config.seed)
    rows = docs.select("doc_id", "text").join(F.broadcast(told), "doc_id")  # the sample is bounded by the config
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # of rows that repeat an id, one
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch, raw, at in V.chunks(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(distinct_words(raw, at), pa.binary())], names=["doc_id", "toxic", "words"])

    words = rows.select("doc_id", F.col("toxic").cast("int"), "text").mapInArrow(run, f"doc_id {kind}, toxic int, words binary")
    words = words.orderBy(F.xxhash64("doc_id", F.lit(config.seed)), "doc_id").select("toxic", "words").collect()
    return learn([bytes(r.words) for r in words], [r.toxic for r in words], config)


def toxicity(docs: DataFrame, labels: DataFrame, config: ToxicConfig = ToxicConfig()) -> DataFrame:
    """doc_id, held_out, score, predicted for each document. Two scans of the texts, no shuffle of them."""
    model = fit_toxicity(docs, labels, config)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch, raw, at in V.chunks(batches):
            score = model.scores(raw, at)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")
