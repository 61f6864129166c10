"""Words of Arrow text columns, found on their UTF-8 bytes without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are looked at together; a longer text is a slab of its own.
SLAB_BYTES = 4 << 20

# The bytes that words are made of, as tables of 256 answers. All bytes of other than ASCII
# characters are word bytes in both, so no character is cut.
PRINTED = np.ones(256, bool)  # [^\x20\x09-\x0D]
PRINTED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F], for lower-cased texts
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

# Lower-cases A-Z alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def slabs(texts: pa.StringArray, limit: int = SLAB_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, behind the last row, bytes, offsets) of stretches of rows with about `limit` bytes.

    Null texts are empty. A stretch has one row at least, and only one if that is longer.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        start, end = int(offsets[first]), int(offsets[last])
        yield first, last, raw[start:end], (offsets[first : last + 1] - start).astype(np.int64)
        first = last


def as_strings(column: pa.Array) -> pa.StringArray:
    """The column with 32-bit offsets and empty texts for nulls."""
    return column.cast(pa.string()).fill_null("")


def spans(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in bytes of the slab, of the words of all its texts; none crosses texts."""
    held = table[raw]
    before, behind = np.zeros_like(held), np.zeros_like(held)
    before[1:], behind[:-1] = held[:-1], held[1:]
    full = offsets[:-1] < offsets[1:]
    before[offsets[:-1][full]] = False
    behind[offsets[1:][full] - 1] = False
    return np.flatnonzero(held & ~before), np.flatnonzero(held & ~behind) + 1


def firsts(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text the number of its first word, and the number of all words at the end."""
    return np.searchsorted(starts, offsets)


def numbered(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For each word the place of its text in a dictionary, and the dictionary (binary)."""
    if not len(starts):
        return np.empty(0, np.int32), pa.array([], pa.binary())
    cuts = np.empty(2 * len(starts) + 1, np.int32)
    cuts[0:-1:2], cuts[1::2], cuts[-1] = starts, ends, ends[-1]
    # Words and what lies between them, in turn.
    tokens = pa.BinaryArray.from_buffers(
        pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(raw))]
    )
    coded = tokens.dictionary_encode()
    return coded.indices.to_numpy()[::2], coded.dictionary
