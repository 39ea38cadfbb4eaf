"""Quality filters: for each row the reason why it goes, or null. The first filter that fails is charged."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T


@dataclass(frozen=True)
class QualityConfig:
    # The defaults of the filters.
    allowed: tuple[str, ...] = ("vi", "en", "unknown")
    match_source_language: bool = True
    min_prompt_chars: int = 3
    min_answer_chars: int = 2
    max_total_chars: int = 16_000
    min_words: int = 50
    max_word_run: int = 8
    max_duplicate_sentence_ratio: float = 0.5
    ngram_words: int = 5
    max_duplicate_ngram_ratio: float = 0.5
    threshold: float = 0.8
    shingle_words: int = 3
    permutations: int = 128
    bands: int = 32
    language: bool = True
    length: bool = True
    repetition: bool = True
    near_duplicate: bool = True

    def __post_init__(self):
        if self.permutations % self.bands:
            raise ValueError(f"{self.permutations} permutations do not divide into {self.bands} bands")
        if not 0 < self.threshold <= 1:
            raise ValueError(f"threshold {self.threshold} is not in (0, 1]")
        if min(self.ngram_words, self.shingle_words, self.min_words, self.max_word_run) < 1:
            raise ValueError("counts of words are at least 1")

    @classmethod
    def of(cls, given: dict | bool | None) -> "QualityConfig | None":
        """True: the defaults; a false value: no filters; a dict: exactly these keys."""
        if not given:
            return None
        if given is True:
            return cls()
        if unknown := set(given) - {f.name for f in fields(cls)}:
            raise ValueError(f"unknown keys: {', '.join(sorted(unknown))}")
        return cls(**given)


def flatten(messages: str | Column) -> tuple[Column, Column]:
    """Contents of the user's turns and of the assistant's, each joined by line feeds."""
    messages = F.col(messages) if isinstance(messages, str) else messages
    of = lambda role: F.array_join(F.transform(F.filter(messages, lambda m: m["role"] == F.lit(role)), lambda m: m["content"]), "\n")
    return of("user"), of("assistant")


def language_reason(text: Column, declared: Column, config: QualityConfig = QualityConfig()) -> Column:
    def told(found):
        mismatch = F.lit(config.match_source_language) & declared.isNotNull() & ~(found == declared) & ~found.isin("unknown", "vi")
        return F.when(mismatch, F.concat(F.lit("source language "), declared, F.lit(", found "), found)).when(~found.isin(*config.allowed), F.concat(F.lit("language "), found))

    return T.let(T.detect_language(text), told)


def length_reason(prompt: Column, answer: Column, config: QualityConfig = QualityConfig()) -> Column:
    p, a = F.length(T.collapse_ends(prompt)), F.length(T.collapse_ends(answer))
    return (
        F.when(p < config.min_prompt_chars, f"prompt shorter than {config.min_prompt_chars}")
        .when(a < config.min_answer_chars, f"answer shorter than {config.min_answer_chars}")
        .when(p + a > config.max_total_chars, f"longer than {config.max_total_chars}")
    )


def repetition_reason(text: Column, config: QualityConfig = QualityConfig()) -> Column:
    by_words = lambda text, w: (
        F.when(T.longest_word_run(w) > config.max_word_run, "word run")
        .when(F.size(w) < config.min_words, F.lit(None).cast("string"))
        .when(T.duplicate_sentence_share(text) > config.max_duplicate_sentence_ratio, "sentences")
        .when(T.repeated_share(T.ngrams(w, config.ngram_words)) > config.max_duplicate_ngram_ratio, "n-grams")
    )
    return T.let(T.prose(text), lambda text: T.let(T.words(T.normalize(text)), lambda w: by_words(text, w)))


def first_turn_reason(messages: Column, config: QualityConfig = QualityConfig()) -> Column:
    """Of the first turn that repeats itself."""
    return F.get(F.filter(F.transform(messages, lambda m: repetition_reason(m["content"], config)), lambda r: r.isNotNull()), F.lit(0))


def corpus_reason(text: Column) -> Column:
    plain = T.collapse_ends(text)
    return F.when(T.has_secret(text), "pii_or_secret").when(F.length(plain) < 80, "too_short").when(F.size(F.array_distinct(F.split(plain, ""))) < 10, "low_quality")
