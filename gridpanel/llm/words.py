"""Words and word windows of whole Arrow columns as 64-bit hashes, without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D. UTF-8 never uses these
bytes inside a character, so words are found on the raw bytes of a column.
Hashes are polynomials modulo 2**64, finished by a mixer. They depend on the
bytes alone, never on the process, so every executor gives the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = (1 << 20) - 1  # bytes that are held as arrays at once

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LETTERS_APART = np.ones(256, bool)  # for letter-and-digit words: all other ASCII bytes lie between words
LETTERS_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD6E8FEB86659FD93 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i below n."""
    found = _POWERS.get(base)
    if found is None or len(found[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, np.uint64(b), np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        found = _POWERS[base] = (both[0], both[1])
    return found


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 places where its texts begin and end; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[places[0]:places[-1]], places - places[0]


def _pieces(data: np.ndarray, places: np.ndarray, apart: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about CHUNK bytes that cut no word."""
    start, total = 0, len(data)
    while start < total:
        end = min(start + CHUNK, total)
        if end < total:
            edge = places[np.searchsorted(places, end, "right") - 1]
            if edge > start:
                end = int(edge)
            else:
                while end < total:
                    gaps = np.flatnonzero(apart[data[end:end + CHUNK]])
                    if len(gaps):
                        end += int(gaps[0])
                        break
                    end = min(end + CHUNK, total)
                end = min(end, int(places[np.searchsorted(places, start, "right")]) if end < total else end)
        yield start, end
        start = end


def hashed_words(column: pa.Array, lower: bool = False, spans: bool = False, between: np.ndarray = _SEPARATOR):
    """Hashes of all words in order, the n + 1 places where each text's words begin, and the spans if asked for."""
    data, places = text_bytes(column)
    fold = _LOWER if lower else _SAME
    out, firsts, lasts = [], [], []
    for low, high in _pieces(data, places, between):
        part = fold[data[low:high]]
        apart = between[part]
        before = np.empty(len(part), bool)
        before[0] = True
        before[1:] = apart[:-1]
        inner = places[np.searchsorted(places, low, "right"):np.searchsorted(places, high, "left")] - low
        before[inner] = True
        after = np.empty(len(part), bool)
        after[-1] = True
        after[:-1] = apart[1:]
        after[inner - 1] = True
        begins = np.flatnonzero(before & ~apart)
        ends = np.flatnonzero(after & ~apart) + 1
        up, down = powers(_BASE, len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:])
        h = (sums[ends] - sums[begins]) * down[begins]
        out.append(mix(h ^ ((ends - begins).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))))
        firsts.append(begins + low)
        lasts.append(ends + low)
    hashes = np.concatenate(out) if out else np.zeros(0, np.uint64)
    begins = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    starts = np.searchsorted(begins, places)
    if spans:
        return hashes, starts, data, begins, np.concatenate(lasts) if lasts else np.zeros(0, np.int64)
    return hashes, starts


def hash_spans(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans of bytes that follow each other without overlap."""
    out = np.empty(len(begins), np.uint64)
    first = 0
    while first < len(begins):
        low = int(begins[first])
        last = max(first + 1, int(np.searchsorted(ends, low + CHUNK, "right")))
        part = data[low:int(ends[last - 1])]
        up, down = powers(_BASE, len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:])
        a, b = begins[first:last] - low, ends[first:last] - low
        out[first:last] = mix(((sums[b] - sums[a]) * down[a]) ^ ((b - a).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
        first = last
    return out


def windows(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` words of one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if seed:
        hashes = mix(hashes ^ np.uint64(seed))
    up, down = powers(_WORD_BASE, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=sums[1:])
    return mix((sums[size:] - sums[:n]) * down[:n] + np.uint64(size))


def batches(batch: pa.RecordBatch, column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts sum to about ``limit`` bytes; a longer text stands alone."""
    n = batch.num_rows
    if not n:
        return
    _, places = text_bytes(batch.column(batch.schema.get_field_index(column)))
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(places, places[low] + limit, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high
