"""Operator 8: language identification.

A sparse multinomial logistic regression on TF-IDF character n-grams of orders 1 to 3, with a mark at word borders.
Weights are learned with follow-the-regularised-leader under an elastic-net penalty on a bounded sample of labelled
rows (LanguageConfig.each per language), then a temperature is fitted on rows of the sample that had no part in it.

A text that is null or has no letter gets `und` with score 0. With no labelled row to learn from, so does every text.
Repeated rows are scored each; a language that is rare is learned from all its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .letters import SYMBOLS, bounded_sample, held_out, stream

#: Where the codes of each order begin in the table of weights.
STARTS = (0, SYMBOLS, SYMBOLS + SYMBOLS**2)
FEATURES = SYMBOLS + SYMBOLS**2 + SYMBOLS**3


@dataclass(frozen=True)
class LanguageConfig:
    each: int = 1200  #: labelled rows of each language to learn from, the bound of the sample
    epochs: int = 3
    alpha: float = 2.0  #: step size of the leader
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-6
    scale: float = 100.0  #: of TF-IDF values, which sum to about 1 in a text
    seed: int = 8


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  #: languages x features: weight times IDF, and temperature
    bias: np.ndarray

    def probabilities(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at) - 1, len(self.languages)))
        for codes, first in _grams(raw, at):
            codes, count = codes[: first[-1]], np.diff(first)  # a text has at least its two marks
            for k, weights in enumerate(self.table):
                out[:, k] += np.add.reduceat(weights[codes], first[:-1]) / count
        out += self.bias
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    def predict(self, docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
        """keep, lang_pred, score: for each row of docs, which needs the column text."""
        names, fields = list(keep), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
        schema = ", ".join(x for x in (fields, "lang_pred string, score double") if x)
        model = self

        def run(batches):
            for batch, raw, at in V.chunks(batches):
                known = batch.column(batch.schema.get_field_index("has_letter")).to_numpy(zero_copy_only=False)
                best, score = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
                if model.languages:
                    p = model.probabilities(raw, at)
                    best, score = np.where(known, np.array(model.languages, object)[p.argmax(axis=1)], "und"), np.where(known, p.max(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in names] + [pa.array(best, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

        letter = _has_letter().alias("has_letter")
        return docs.select(*keep, *([] if "text" in keep else ["text"]), letter).mapInArrow(run, schema)

    def known(self, docs: DataFrame, least: float) -> DataFrame:
        """The rows of docs, with all their columns, whose language is told with a score of at least `least`; texts that are `und` go."""
        model = self

        def run(batches):
            for batch, raw, at in V.chunks(batches):
                stays = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
                stays = stays & (model.probabilities(raw, at).max(axis=1) >= least) if model.languages else np.zeros(batch.num_rows, bool)
                yield batch.select(list(range(batch.num_columns - 1))).filter(pa.array(stays))

        return docs.withColumn("_has_letter", _has_letter()).mapInArrow(run, docs.schema)


def _has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def _grams(raw: np.ndarray, at: np.ndarray):
    """For each order, the codes of all texts' n-grams and where each text's begin."""
    symbols, first = stream(raw, at, digits=False)
    wide = symbols.astype(np.int32)
    for order in (1, 2, 3):
        codes = wide[: len(wide) - order + 1].copy()
        for k in range(1, order):
            codes *= SYMBOLS
            codes += wide[k : len(wide) - order + 1 + k]
        yield codes + STARTS[order - 1], first


def fit_language(docs: DataFrame, config: LanguageConfig = LanguageConfig()) -> LanguageModel:
    """docs: doc_id, text, lang. Learns from rows that are not held out and have a language and text."""
    rows = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sample = bounded_sample(rows, "lang", config.each, config.seed).orderBy(F.xxhash64("doc_id", F.lit(config.seed + 1)), "doc_id", "text").toPandas()
    return train(list(sample["text"]), list(sample["lang"]), config)


def train(texts: list[str], labels: list[str], config: LanguageConfig) -> LanguageModel:
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((0, 0)), np.zeros(0))
    y = np.array([languages.index(x) for x in labels])
    found = [_counts(t) for t in texts]
    seen = np.zeros(FEATURES, np.int64)
    for codes, _ in found:
        seen[codes] += 1
    idf = np.log((1 + len(texts)) / (1 + seen)) + 1
    values = [config.scale * tf * idf[codes] for codes, tf in found]
    z, n = np.zeros((FEATURES, len(languages))), np.zeros((FEATURES, len(languages)))
    zb, nb = np.zeros(len(languages)), np.zeros(len(languages))

    def leader(z, n):
        return np.where(np.abs(z) <= config.l1, 0.0, -(z - np.sign(z) * config.l1) / ((config.beta + np.sqrt(n)) / config.alpha + config.l2))

    fit = [i for i in range(len(texts)) if i % 5 or len(texts) < 10]
    random = np.random.RandomState(config.seed)
    for _ in range(config.epochs):
        for i in random.permutation(fit):
            codes, x = found[i][0], values[i]
            w, b = leader(z[codes], n[codes]), leader(zb, nb)
            p = _softmax(x @ w + b)
            p[y[i]] -= 1
            g = x[:, None] * p
            more = n[codes] + g * g
            z[codes] += g - (np.sqrt(more) - np.sqrt(n[codes])) / config.alpha * w
            n[codes] = more
            zb, nb = zb + p - (np.sqrt(nb + p * p) - np.sqrt(nb)) / config.alpha * b, nb + p * p
    w, b = leader(z, n), leader(zb, nb)
    rest = [i for i in range(len(texts)) if i not in set(fit)] or fit
    logits = np.array([values[i] @ w[found[i][0]] + b for i in rest])
    heat = min(np.geomspace(0.05, 20, 120), key=lambda t: -np.mean([np.log(_softmax(s / t)[y[i]] + 1e-12) for s, i in zip(logits, rest)]))
    return LanguageModel(languages, np.ascontiguousarray((w * idf[:, None] * config.scale / heat / 3).T), b / heat)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max())
    return x / x.sum()


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text's features and their frequencies; each order has a third of the weight."""
    raw = np.frombuffer(text.encode(), np.uint8)
    codes, tf = [], []
    for all_codes, first in _grams(raw, np.array([0, len(raw)])):
        one, many = np.unique(all_codes[first[0] : first[1]], return_counts=True)
        codes.append(one)
        tf.append(many / max(1, many.sum()) / 3)
    return np.concatenate(codes), np.concatenate(tf)


def language_id(docs: DataFrame, config: LanguageConfig = LanguageConfig()) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each document. One scan to count labels, one for the sample, one to predict; no shuffle of texts."""
    model = fit_language(docs, config)
    return model.predict(docs.select("doc_id", "text")).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
