"""Texts as streams of letter symbols, for the two classifiers.

A symbol is 1 to 26 for a-z without case, and 27 to 58 for the last byte of any other letter, with its case bit left
out; lead bytes, digits and punctuation have none. 0 stands between words.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V

SYMBOLS = 64
_NONE = 255
SYMBOL = np.full(256, _NONE, np.uint8)
for _i in range(26):
    SYMBOL[[ord("a") + _i, ord("A") + _i]] = 1 + _i
SYMBOL[0x80:0xC0] = 27 + (np.arange(0x80, 0xC0) & 31)
#: Digits that stand for letters in disguised words.
for _digit, _letter in zip("01345", "oieas"):
    SYMBOL[ord(_digit)] = SYMBOL[ord(_letter)]
SYMBOL[V.IS_SPACE] = 0


def stream(raw: np.ndarray, at: np.ndarray, digits: bool) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, with two 0 before each and at the end, and where each text's begin (the end last): what is
    read of a text up to two places on does not depend on its neighbours."""
    out = SYMBOL[raw]
    if not digits:
        out[(raw >= 0x30) & (raw <= 0x39)] = _NONE
    keep = out != _NONE
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    first = before[at]
    return np.insert(out[keep], np.repeat(first, 2), 0), first + 2 * np.arange(len(first))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def bounded_sample(rows: DataFrame, label: str, each: int, seed: int) -> DataFrame:
    """About `each` rows of every label, the same ones in every run: by a hash of the row, with a bound for each label from its count. Rows that are equal count once."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return rows.limit(0)
    space = 1 << 20
    bound = F.lit(0)
    for value, n in counts.items():
        bound = F.when(F.col(label) == value, F.lit(min(space, -(-each * space // n)))).otherwise(bound)
    return rows.where(F.pmod(F.xxhash64(*rows.columns, F.lit(seed)), F.lit(space)) < bound).distinct()
