"""Vectorised text work on Arrow batches: bytes, words and their hashes without a Python loop per word.

White space is what the contracts call it: the bytes 0x20 and 0x09 to 0x0D. No byte of a longer UTF-8
sequence is one of these, so words can be found on the encoded text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text that are worked on at once; longer single texts are worked on alone.
CHUNK = 1 << 20

_state = np.random.RandomState(20_240_607)
BYTE_CODES = _state.randint(0, 1 << 62, 256).astype(U64) * U64(2) + U64(1)
BASE = U64(0x9E3779B97F4A7C15 | 1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits, so that near values end far apart."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins, with the end last. A null text has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def trim() -> None:
    """Gives memory that a task has freed back to the system; a worker that waits for its next task would keep it."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def trimmed(run):
    """A function of batches that trims once its batches have ended."""

    def whole(batches):
        yield from run(batches)
        trim()

    return whole


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of about CHUNK bytes of text each, with bytes and offsets: memory stays bounded whatever the batch size."""
    for batch in batches:
        raw, at = buffers(batch.column(batch.schema.get_field_index(text)))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(at, at[low] + CHUNK, "right")) - 1)
            yield batch.slice(low, high - low), raw[at[low] : at[high]], at[low : high + 1] - at[low]
            low = high
    raw = at = batch = None
    trim()


@dataclass
class Words:
    """Words of a chunk: byte positions where each begins and ends, and the first word of each text (the number of words last)."""

    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(raw: np.ndarray, at: np.ndarray, inside: np.ndarray | None = None) -> Words:
    """inside: which bytes belong to words; by default all that are not white space. Words never span texts."""
    inside = ~IS_SPACE[raw] if inside is None else inside
    cut = np.zeros(len(raw) + 1, bool)
    cut[at] = True
    before = np.empty(len(raw) + 1, bool)
    before[0] = False
    before[1:] = inside
    now = np.empty(len(raw) + 1, bool)
    now[-1] = False
    now[:-1] = inside
    begin = np.flatnonzero(now & (~before | cut))
    end = np.flatnonzero(before & (~now | cut))
    return Words(begin, end, np.searchsorted(begin, at))


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_inverse = U64(pow(int(BASE), -1, 1 << 64))


class _Tables(dict):
    """Tables that each process makes for itself: pickled, they are empty, so no function that is shipped carries them."""

    def __reduce__(self):
        return _Tables, ()


_cache = _Tables()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _cache.get("up")
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1)
        _cache.update(up=powers(size), down=powers(size, _inverse))
    return _cache["up"], _cache["down"]


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Running polynomial hash of the bytes: the hash of any slice follows from two of its values."""
    up, _ = _powers(len(raw) + 1)
    run = np.empty(len(raw) + 1, U64)
    run[0] = 0
    np.cumsum(BYTE_CODES[raw] * up[: len(raw)], out=run[1:])
    return run


def slice_hash(run: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the slices; equal slices have equal hashes wherever they stand."""
    _, down = _powers(len(run))
    return mix((run[end] - run[begin]) * down[begin] + (end - begin).astype(U64) * U64(0xD6E8FEB86659FD93))


def code_hash(codes: np.ndarray) -> np.ndarray:
    """Running hash of codes of words, for slice_hash() over runs of words."""
    up, _ = _powers(len(codes) + 1)
    run = np.empty(len(codes) + 1, U64)
    run[0] = 0
    np.cumsum(codes * up[: len(codes)], out=run[1:])
    return run


def gram_hash(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n codes, by its first place; there are n - 1 fewer of them than codes."""
    if len(codes) < n:
        return np.zeros(0, U64)
    out = np.zeros(len(codes) - n + 1, U64)
    factor = 1
    for k in range(n):
        factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)
        out += codes[k : len(codes) - n + 1 + k] * U64(factor | 1)
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


#: A constant for each round of the permutation.
ROUND_KEYS = np.array([r * 0xA0761D6478BD642F % (1 << 64) for r in range(16)], U64)


def feistel(index: np.ndarray, size: np.ndarray, key: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Keyed bijection of 0..size-1, for each row with its own size and key: a balanced Feistel network over the next
    even power of two, walked along its cycle until it is back inside the range."""
    index, size, key = (np.asarray(x).astype(U64) for x in np.broadcast_arrays(index, size, key))
    bits = np.ceil(np.log2(np.maximum(size.astype(np.float64), 2))).astype(np.int64)
    bits += (U64(1) << bits.astype(U64)) < size  # where the logarithm was rounded down
    half = ((bits + 1) // 2).astype(U64)
    mask = (U64(1) << half) - U64(1)
    out, todo = index.copy(), np.arange(len(index))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(rounds):
            left, right = right, left ^ (mix(right ^ mix(k + ROUND_KEYS[r])) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def unfeistel(value: np.ndarray, size: np.ndarray, key: np.ndarray, rounds: int = 6) -> np.ndarray:
    """The index that feistel() sends to a value."""
    value, size, key = (np.asarray(x).astype(U64) for x in np.broadcast_arrays(value, size, key))
    bits = np.ceil(np.log2(np.maximum(size.astype(np.float64), 2))).astype(np.int64)
    bits += (U64(1) << bits.astype(U64)) < size
    half = ((bits + 1) // 2).astype(U64)
    mask = (U64(1) << half) - U64(1)
    out, todo = value.copy(), np.arange(len(value))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in reversed(range(rounds)):
            left, right = right ^ (mix(left ^ mix(k + ROUND_KEYS[r])) & m), left
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)
