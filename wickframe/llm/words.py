"""Words of many texts at once.

The bytes of a column of texts are split in one go: at white space (the six ASCII characters) and between an ASCII letter
and punctuation behind it, with A-Z lower-cased. Each different word is handed over once, and its value is put back at
all its places. Texts that hold ``<|``, which may open a special token, are not split but handed over whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text, and texts, that are split together.
PART, ROWS = 16 << 20, 20_000

SPACE, LETTER, MARK = 1, 2, 3
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t\n\v\f\r")] = SPACE
KIND[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = LETTER
KIND[list(b".,*$%&#!?;:)")] = MARK  # none of them forms a letter with a combining mark behind it
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def large_binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a column of strings or binaries; null is empty."""
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    column = column.cast(pa.binary() if pa.types.is_string(column.type) else column.type).fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], flat[offsets[0] : offsets[-1]]


def rows_of(column: pa.Array) -> list[bytes]:
    """The bytes of each row."""
    offsets, flat = bytes_of(column)
    at, data = offsets.tolist(), flat.tobytes()
    return [data[i:j] for i, j in zip(at, at[1:])]


def parts(column: pa.Array, size: int = PART, rows: int = ROWS) -> Iterator[tuple[int, int]]:
    """Ranges of rows with a bounded number of rows and bytes (one row at least)."""
    offsets, _ = bytes_of(column)
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        stop = min(max(stop, at + 1), at + rows, len(column))
        yield at, stop
        at = stop


def encode_texts(column: pa.Array, values: Callable[[pa.Array], pa.Array], whole: Callable[[bytes], bytes], end: bytes = b"") -> pa.Array:
    """The values of each text's words, joined, and ``end``; ``whole`` has the value of a text that is not split."""
    offsets, flat = bytes_of(column)
    n = len(column)
    kind = KIND[flat]
    special = {}
    for at in np.flatnonzero((flat[:-1] == ord("<")) & (flat[1:] == ord("|"))).tolist():
        i = int(np.searchsorted(offsets, at, "right")) - 1
        if i not in special and at + 1 < offsets[i + 1]:
            special[i] = whole(flat[offsets[i] : offsets[i + 1]].tobytes())
            kind[offsets[i] : offsets[i + 1]] = SPACE
    body = kind != SPACE
    # a word begins behind white space or at a text's begin, and at a mark behind a letter
    begins = np.empty(len(flat), bool)
    begins[1:] = ~body[:-1] | ((kind[:-1] == LETTER) & (kind[1:] == MARK))
    begins[offsets[:-1][offsets[:-1] < len(flat)]] = True
    begins &= body
    until = np.searchsorted(np.flatnonzero(begins), offsets)  # words before each text
    starts = np.flatnonzero(begins[body])
    data = LOWER[flat[body]]
    words = large_binary(np.append(starts, len(data)), data).dictionary_encode()
    found = values(words.dictionary)
    places = words.indices.to_numpy()
    extra = [*special.values(), end]
    if special:
        places = np.insert(places, until[list(special)], len(found) + np.arange(len(special)))
        more = np.zeros(n + 1, np.int64)
        more[np.array(list(special)) + 1] = 1
        until = until + more.cumsum()
    if end:
        places = np.insert(places, until[1:], len(found) + len(special))
        until = until + np.arange(n + 1)
    taken = pa.concat_arrays([found, pa.array(extra, pa.large_binary())]).take(pa.array(places))
    stops, ids = bytes_of(taken)
    return large_binary(stops[until], ids)
