"""Arrow text columns as numpy bytes, in pieces of bounded size."""

from __future__ import annotations

import ctypes
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of text that one numpy pass handles. A longer text is one piece by itself.
PIECE_BYTES = 4 << 20
#: Bytes of text whose words are counted in one dictionary.
COUNTED_BYTES = 16 << 20
#: The same for operators that keep many arrays for each byte.
SMALL_PIECE = 1 << 20
#: Bytes of one Arrow batch between the JVM and a Python worker, whatever the length of the rows.
BATCH_BYTES = 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes as well as by rows, so that very long texts don't pile up in one batch.

    This is a setting of the session, which stays: queries that were made before are bounded by it too.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def releasing(batches: Callable) -> Callable:
    """``batches`` for mapInArrow, after which freed memory goes back to the system: a worker that is used again would keep it."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(parts)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # which not every C library has
        if trim:
            trim(0)

    return run


class Texts:
    """Texts that lie behind each other in one array of UTF-8 bytes; null counts as empty."""

    def __init__(self, column: pa.Array):
        column = column.fill_null("") if column.null_count else column
        wide = pa.types.is_large_string(column.type)
        _, offsets, data = column.buffers()
        kind = np.int64 if wide else np.int32
        offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, kind)
        first, last = int(offsets[0]), int(offsets[-1])
        self.offsets = offsets.astype(np.int64) - first
        self.data = np.frombuffer(data, np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Texts:
        """Texts that lie in ``data`` between ``offsets``."""
        made = cls.__new__(cls)
        made.data, made.offsets = data, offsets
        return made

    def __len__(self) -> int:
        return len(self.offsets) - 1


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cuts record batches so that ``column`` holds about ``size`` bytes at most, and at least one row."""
    for batch in batches:
        texts = Texts(batch.column(batch.schema.get_field_index(column)))
        start, n = 0, len(texts)
        while start < n:
            end = int(np.searchsorted(texts.offsets, texts.offsets[start] + size, side="right")) - 1
            end = min(n, max(end, start + 1))
            part = batch.slice(start, end - start)
            yield part, Texts(part.column(part.schema.get_field_index(column)))
            start = end


def parts(data: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of parts of about ``size`` bytes of one text, cut before a space that follows an ASCII letter.

    There a word ends whatever follows, so splitters and normal forms give for the parts what they give for the text. A
    stretch without such a place stays whole.
    """
    at = 0
    while len(data) - at > size:
        end, reach = at, size
        while end == at and at + reach < len(data):
            part = data[at : at + reach + 1]
            letters = part | 32
            cuts = np.flatnonzero((part[1:] == 32) & (letters[:-1] >= 97) & (letters[:-1] <= 122))
            end, reach = (at + 1 + int(cuts[-1])) if len(cuts) else at, 2 * reach
        if end == at:
            break
        yield at, end
        at = end
    yield at, len(data)


def is_separator(data: np.ndarray) -> np.ndarray:
    """Marks the bytes of space and of x09 to x0D, which separate words."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each text, and the number of words before each text (one more entry than texts)."""
    inside = ~is_separator(data)
    before = np.zeros(len(data), bool)
    if len(data):
        before[1:] = inside[:-1]
        cuts = offsets[:-1]
        before[cuts[cuts < len(data)]] = False
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        ends_at = offsets[1:]
        after[ends_at[ends_at > 0] - 1] = False
    else:
        after = before
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def counted_words(data: np.ndarray, split: Callable[[bytes], list[bytes]], size: int = COUNTED_BYTES) -> Iterator[Counter]:
    """Counts of the words into which ``split`` cuts a text, each word in one of the counters; separators end words.

    A text of more than ``size`` bytes is gone through once for each share of its words by hash, in pieces, so that a
    counter holds about one share of its different words.
    """
    turns = -(-len(data) // size)
    if turns <= 1:
        yield Counter(split(data.tobytes()))
        return
    for turn in range(turns):
        found: Counter = Counter()
        at = 0
        while at < len(data):
            end = min(len(data), at + size)
            while end < len(data):
                ends = np.flatnonzero(is_separator(data[end : end + size]))
                end = min(len(data), end + (int(ends[0]) if len(ends) else size))
                if len(ends):
                    break
            found.update(word for word in split(data[at:end].tobytes()) if hash(word) % turns == turn)
            at = end
        yield found
