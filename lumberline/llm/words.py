"""Words of whole texts, as flat arrays over a batch of documents.

A word is a run of other characters than space, tab, line feed, vertical tab, form feed and
carriage return.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes; a longer text is a range of its own."""
    if not len(texts):
        return
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield start, stop
        start = stop


class Words:
    """The words of some texts in order; document ``d`` has words ``first[d]:first[d + 1]``."""

    def __init__(self, texts: pa.Array, lower: bool):
        texts = pc.ascii_trim_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        if lower:
            texts = pc.ascii_lower(texts)
        parts = pc.ascii_split_whitespace(texts)
        offsets = parts.offsets.to_numpy()
        values = parts.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        #: An empty text splits into one empty word, which is none.
        is_word = pc.greater(pc.binary_length(values), 0)
        if pc.all(is_word).as_py() is False:
            kept = is_word.to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
            values = values.filter(is_word)
        self.values = values
        self.first = offsets.astype(np.int64)

    def __len__(self) -> int:
        return len(self.values)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, and the distinct words by number."""
        encoded = pc.dictionary_encode(self.values)
        if isinstance(encoded, pa.ChunkedArray):
            encoded = encoded.combine_chunks()
        return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary

    def bytes(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words joined by one space, and the start and end of each in that."""
        data, offsets = flat(self.values)
        sizes = np.diff(offsets)
        starts = offsets[:-1] + np.arange(len(sizes))
        joined = np.full(len(data) + len(sizes), 0x20, np.uint8)
        joined[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = data
        return joined.tobytes(), starts, starts + sizes


def flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values one after the other, and where each begins; the end comes last."""
    values = values.cast(pa.large_string())
    buffers = values.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[values.offset : values.offset + len(values) + 1]
    if not len(values) or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def sums_by_document(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum over each document's words, zero where it has none; other documents don't touch it."""
    counts = np.diff(first)
    out = np.zeros(len(counts), values.dtype)
    some = counts > 0
    if some.any():
        out[some] = np.add.reduceat(values, first[:-1][some])
    return out


def hashes(words: pa.Array, hash64) -> np.ndarray:
    """``hash64`` of the bytes of each word."""
    words = words.cast(pa.large_binary())
    return np.fromiter(map(hash64, words.to_numpy(zero_copy_only=False)), np.uint64, len(words))


def spread(
    codes: np.ndarray, sizes: np.ndarray, items: np.ndarray, begins: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The items of each coded word in order, and where each word's begin (and the end).

    ``sizes`` has how many items each distinct word has, and ``begins`` where they begin in ``items``; without
    it they stand one after the other.
    """
    if begins is None:
        begins = np.cumsum(sizes) - sizes
    n = sizes[codes]
    total = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(begins[codes] - total[:-1], n)
    at += np.arange(total[-1])
    return items[at], total
