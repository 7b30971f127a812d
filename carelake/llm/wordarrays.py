"""Words of many texts as Arrow arrays: flat words with offsets per text.

No Python object per word: splitting, dictionary encoding and joining run over whole
columns; a word becomes the index of its entry in the batch's dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20  # bytes of text handled at a time, about

#: Byte tables: ASCII capitals become small letters; with LETTERS_DIGITS all other ASCII
#: characters but letters and digits become spaces. Bytes of longer characters stay.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
LETTERS_DIGITS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in LOWER)


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges (i, j) of a text column of about ``size`` bytes together (a longer text alone)."""
    n = np.asarray(pc.fill_null(pc.binary_length(column), 0))
    upto, i = np.cumsum(n, dtype=np.int64), 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + size)))
        yield i, j
        i = j


def mapped(column: pa.StringArray, table: bytes) -> pa.BinaryArray:
    """Every byte of the texts put through ``table`` (null: empty), as binary values."""
    column = pc.fill_null(column.cast(pa.string()), "")  # 32-bit offsets, whatever the session's Arrow types
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = data[offsets[0]:offsets[-1]].to_pybytes() if data is not None else b""
    return pa.BinaryArray.from_buffers(pa.binary(), len(column), [
        None, pa.py_buffer((offsets - offsets[0]).astype(np.int32).tobytes()), pa.py_buffer(raw.translate(table))])


def words(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets per text, all words): runs of characters other than ASCII white
    characters (space and 0x09 to 0x0D). A null text has no words."""
    lists = pc.ascii_split_whitespace(column)
    flat, n = lists.flatten(), np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    some = pc.greater(pc.binary_length(flat), 0)  # white characters at an end leave an empty word
    upto = np.concatenate(([0], np.cumsum(np.asarray(some), dtype=np.int64)))
    return upto[np.concatenate(([0], np.cumsum(n, dtype=np.int64)))], flat.filter(some)


def ids(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(index of each word in the dictionary, dictionary)."""
    d = flat.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False), d.dictionary


def owners(offsets: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
