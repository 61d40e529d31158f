"""Words of texts inside a task: splitting, a bounded word table, byte n-grams.

A word is a maximal run of bytes other than the six ASCII blanks, with A-Z lower-cased.
Working on UTF-8 bytes gives exactly that: ``bytes.lower`` and ``bytes.split`` know ASCII only.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from collections.abc import Callable, Iterable, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BATCH_ROWS = 1000
BATCH_BYTES = 16 * 1024 * 1024
_AT_ONCE = 1 << 20  # bytes that are cut at once
_BLANKS = b"\t\n\x0b\x0c\r "
_BLANK, _MARK, _LETTER = 1, 2, 3
_KINDS = bytes(
    _BLANK if c in _BLANKS else _MARK if c in b".,;:!?" else _LETTER if 97 <= c <= 122 else 0 for c in range(256)
)


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that Python tasks hold, in rows and in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def tidied(run: Callable) -> Callable:
    """The same function of batches, giving memory back to the system at the end of a task.

    Python workers live on from stage to stage.  What a task's tables leave in the allocators'
    own stores would otherwise stay with the worker, beside the next stage's tables.
    """

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            give_back()

    return wrapped


def give_back() -> None:
    """Return what the allocators keep unused to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def raw(texts: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each text."""
    wide = pa.types.is_large_string(texts.type)
    return texts.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def split(text: bytes | None) -> list[bytes]:
    """Lower-cased words of one text; none for NULL."""
    return text.lower().split() if text else []


def _cut(data: bytes, edges: np.ndarray, parted: bool) -> tuple[np.ndarray, np.ndarray]:
    """Size of each word between the blanks and words per text; texts lie between the edges."""
    kind = np.frombuffer(data.translate(_KINDS), np.uint8)
    inner = kind != _BLANK
    begin = inner.copy()
    begin[1:] &= ~inner[:-1]
    starts = edges[:-1][edges[:-1] < len(data)]
    begin[starts] = inner[starts]
    last = inner.copy()
    last[:-1] &= ~inner[1:] | begin[1:]
    at, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
    if parted:
        mark = kind == _MARK
        some = np.flatnonzero(mark[1:] & (kind[:-1] == _LETTER)) + 1
        some = some[~begin[some]]
        stop = end[np.searchsorted(at, some, "right") - 1]
        marks = np.concatenate([[0], np.cumsum(mark, dtype=np.int32)])
        some = some[marks[stop] - marks[some] == stop - some]
        at, end = np.sort(np.concatenate([at, some])), np.sort(np.concatenate([end, some]))
    return end - at, np.diff(np.searchsorted(at, edges))


def words_of(
    texts: pa.Array | Iterable[bytes | None], lowered: bool = True, parted: bool = False
) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, one after the other, and words per text; none for NULL.

    ``parted``: a word's closing ``.,;:!?`` behind a letter of a-z are a word of their own.
    """
    if not isinstance(texts, pa.Array):
        texts = pa.array(list(texts), pa.large_binary())
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    _, places, held = texts.buffers()
    edges = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    row, kept, sizes, lengths = 0, [], [], []
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(edges, edges[row] + _AT_ONCE, "right")) - 1)
        data = held[int(edges[row]) : int(edges[stop])].to_pybytes() if edges[stop] > edges[row] else b""
        data = data.lower() if lowered else data
        size, number = _cut(data, edges[row : stop + 1] - edges[row], parted)
        kept.append(data.translate(None, _BLANKS))
        sizes.append(size)
        lengths.append(number)
        row = stop
    offsets = np.concatenate([[0], *sizes])
    np.cumsum(offsets, out=offsets)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(kept))]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers), np.concatenate(lengths)


class Numbers(dict):
    """Key to row number; unknown keys get the next number."""

    def __missing__(self, word: bytes | str) -> int:
        number = self[word] = len(self)
        return number


class WordTable:
    """Numbers for words and one feature row per word, computed once per word.

    ``features`` maps a list of new words to a matrix with one row per word.  When the table
    holds more than ``limit`` words at the start of a batch, only those that have come again
    stay, half the limit at most, so its memory depends on the limit and the batch, not on the
    input.
    """

    def __init__(
        self, features: Callable[[list[bytes]], np.ndarray] | None = None, limit: int = 300_000
    ):
        self.features, self.limit = features, limit
        self.reset()

    def reset(self) -> None:
        self.words, self.rows, self.filled = pa.array([], pa.large_binary()), None, 0
        self.hits = np.zeros(0, np.int64)

    def shrink(self) -> np.ndarray:
        """Leave words out that have not come again; the old numbers of those that stay."""
        most = self.limit // 2
        known = self.hits >= 2
        if known.sum() > most:
            known = self.hits > np.partition(self.hits, -most)[-most]
        kept = np.flatnonzero(known)
        self.words = self.words.take(pa.array(kept))
        if self.rows is not None:
            self.rows = self.rows[kept]
        self.filled, self.hits = len(kept), self.hits[kept] // 2
        return kept

    def batch(
        self, texts: pa.Array | Iterable[bytes | None], cut: Callable[..., tuple[pa.Array, np.ndarray]] = words_of
    ) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of all words of all texts, one after the other, and words per text."""
        if len(self.words) > self.limit:
            self.shrink()
        words, lengths = cut(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        number = pc.index_in(distinct, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).copy()
        new = number < 0
        number[new] = len(self.words) + np.arange(int(new.sum()))
        self.words = pa.concat_arrays([self.words, distinct.filter(pa.array(new))])
        flat = number[coded.indices.to_numpy(zero_copy_only=False)]
        self._fill()
        came = np.bincount(flat, minlength=len(self.words))
        came[: len(self.hits)] += self.hits
        self.hits = came
        return flat.astype(np.int32, copy=False), lengths

    def fresh(self) -> list[bytes]:
        """Words numbered since the last call."""
        added = self.words.slice(self.filled).to_numpy(zero_copy_only=False).tolist()
        self.filled = len(self.words)
        return added

    def _fill(self) -> None:
        if self.features is None:
            return
        start = self.filled
        added = self.fresh()
        if not added:
            return
        block = self.features(added)
        if self.rows is None or len(self.rows) < self.filled:
            room = np.zeros((max(1024, 2 * self.filled), *block.shape[1:]), block.dtype)
            if start:
                room[:start] = self.rows[:start]
            self.rows = room
        self.rows[start : self.filled] = block


def sum_by_text(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each text's rows; zero for texts without words."""
    out = np.zeros((len(lengths), *rows.shape[1:]), np.float64)
    some = lengths > 0
    if some.any():
        starts = (np.cumsum(lengths) - lengths)[some]
        out[some] = np.add.reduceat(rows, starts, axis=0, dtype=np.float64)
    return out


def hash_words(words: Sequence[bytes], seed: int = 0) -> np.ndarray:
    """64-bit hashes of words, the same on every machine."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words, repeat(seed)), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters them (the splitmix64 finaliser)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def byte_grams(words: Sequence[bytes], order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte n-grams of each word, with one blank on either side as the word's edge.

    Returns the word's position in ``words`` and the bucket, one entry per n-gram.
    """
    flat = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    count = len(flat) - order + 1
    if not words or count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blanks = np.cumsum(flat == 32)
    inner = blanks[max(0, order - 2) :][:count] - blanks[:count]
    kept = np.flatnonzero((flat[:count] != 32) if order == 1 else (inner == 0))
    value = np.full(len(kept), order, np.uint64)
    for step in range(order):
        value = value * np.uint64(257) + flat[kept + step]
    bucket = (value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    return blanks[kept] - 1, bucket.astype(np.int64)
