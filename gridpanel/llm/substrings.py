"""Substring dedup: words covered by a window that also starts in an earlier document.

Count-min prefilter. Documents are dealt into chunks. Each chunk counts its
windows in a sketch of one row whose cells are dealt into slices; the slices of
all chunks are merged, a task a slice, which overestimates the count of every
window. Cells seen twice go back to the chunks that touched them; only windows in
such cells are grouped exactly, by 96-bit hashes, again slice by slice. The width
of the sketch grows with the words of the corpus, and no part of it is broadcast
or gathered in one place, so its share of false alarms stays the same at any size.

Chunks and slices exchange packed arrays, one row per chunk and slice. A chunk
sends a window once, however many of its documents hold it, so a passage that a
third of the corpus shares weighs no more than the number of chunks.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.llm import words as W
from gridpanel.llm.common import tasks

CHUNK_BYTES = 8 << 20  # text of a chunk
CELL_BITS = 24  # cells of a slice
SPARSE = 16  # cells of the sketch per window

ENTRY = np.dtype([("h", "<u8"), ("g", "<u4"), ("doc", "<i8"), ("many", "<i4")])
ANSWER = np.dtype([("h", "<u8"), ("g", "<u4"), ("doc", "<i8")])


def pack(cells: np.ndarray) -> bytes:
    """Sorted cell numbers below 2**24 in about two bytes each."""
    if len(cells) < 512:
        return cells.astype("<u4").tobytes()
    sizes = np.bincount(cells >> 16, minlength=256).astype("<u4")
    return b"\x01" + sizes.tobytes() + cells.astype("<u2").tobytes()


def unpack(raw: bytes) -> np.ndarray:
    if len(raw) % 2 == 0:
        return np.frombuffer(raw, "<u4").astype(np.int64)
    sizes = np.frombuffer(raw, "<u4", 256, 1)
    return np.repeat(np.arange(256), sizes) * 65536 + np.frombuffer(raw, "<u2", -1, 1025)


def _spread(keys: np.ndarray, slices: int, bits: int):
    """The slice of each window hash and its cell there."""
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.int64) % slices, (keys >> np.uint64(64 - bits)).astype(np.int64)


def _windows(table: pa.Table, size: int, id_col: str, text_col: str):
    """Hashes of all windows of a chunk, the text each starts in, their places among the words, and the words' places."""
    hashes, starts = W.hashed_words(table.column(text_col))
    owner = np.repeat(np.arange(table.num_rows), np.diff(starts))
    keys = W.windows(hashes, size)
    ids = table.column(id_col)
    known = ~np.asarray(ids.is_null())
    whole = np.flatnonzero((owner[:len(keys)] == owner[size - 1:]) & known[owner[:len(keys)]]) if len(keys) else np.zeros(0, np.int64)
    return hashes, keys[whole], owner[whole], whole, starts


def _second(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """An independent 32-bit hash of the windows that start at the given words."""
    return (W.windows(hashes, size, seed=0x5851F42D4C957F2D)[at] >> np.uint64(32)).astype(np.uint32)


def _ids(table: pa.Table, id_col: str) -> np.ndarray:
    return table.column(id_col).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _by_slice(slices_of: np.ndarray, order: np.ndarray):
    """(slice, the places in ``order`` that belong to it) for sorted slice numbers."""
    edges = np.flatnonzero(np.r_[True, slices_of[1:] != slices_of[:-1], True]) if len(slices_of) else np.zeros(1, np.int64)
    for low, high in zip(edges[:-1], edges[1:]):
        yield int(slices_of[low]), order[low:high]


def remove_repeats(df: DataFrame, size: int = 50, id_col: str = "doc_id", text_col: str = "text", keep_untouched: bool = False) -> DataFrame:
    """``df`` with each text cut to its words that no earlier document has said, and n_words and n_removed.

    A window is ``size`` consecutive words of one document; a word goes when a
    window that covers it also starts in a document with a smaller id. Windows are
    judged on the input. Kept words are joined by one space; with
    ``keep_untouched`` a text that loses nothing stays as it is. A null text has no
    words and becomes empty (stays null with ``keep_untouched``). Documents with a
    null id are neither cut nor cause a cut; rows that repeat an id do not cut each
    other. Texts shorter than a window lose nothing. Other columns pass through,
    but for input columns called n_words or n_removed, which are replaced.
    """
    spark = df.sparkSession
    df = df.drop("n_words", "n_removed")
    total = df.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    chunks = tasks(spark, total, CHUNK_BYTES)
    bits = CELL_BITS
    slices = tasks(spark, total // 5 * SPARSE, 1 << bits)
    dealt = df.withColumn("__chunk", F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(chunks)))

    def sketch(table: pa.Table) -> pa.Table:
        _, keys, _, _, _ = _windows(table, size, id_col, text_col)
        keys = np.sort(keys)
        first = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
        second = np.zeros(len(keys), bool)
        second[1:] = first[:-1] & ~first[1:]
        keys = keys[first | second]  # twice is all that matters
        part, cell = _spread(keys, slices, bits)
        order = np.lexsort((cell, part))
        rows = [(s, pack(cell[at])) for s, at in _by_slice(part[order], order)]
        chunk = table.column("__chunk")[0].as_py()
        return pa.table({"slice": pa.array([s for s, _ in rows], pa.int64()), "chunk": pa.array([chunk] * len(rows), pa.int64()),
                         "data": pa.array([b for _, b in rows], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        parts = [unpack(b) for b in table.column("data").to_pylist()]
        cells = np.sort(np.concatenate(parts))
        twice = np.unique(cells[1:][cells[1:] == cells[:-1]])
        seen = np.zeros(1 << bits, bool)
        seen[twice] = True
        back = [pack(np.unique(p[seen[p]])) for p in parts]
        out = pa.table({"chunk": table.column("chunk"), "slice": table.column("slice"), "data": pa.array(back, pa.binary())})
        return out.filter(pa.array([len(b) > 0 for b in back]))

    def entries(texts: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        if answers.num_rows and texts.num_rows:
            hashes, keys, owner, at, _ = _windows(texts, size, id_col, text_col)
            part, cell = _spread(keys, slices, bits)
            alarm = np.zeros(len(keys), bool)
            order = np.argsort(part, kind="stable")
            sent = dict(zip(answers.column("slice").to_pylist(), answers.column("data").to_pylist()))
            seen = np.zeros(1 << bits, bool)
            for s, places in _by_slice(part[order], order):
                if s in sent:
                    touched = unpack(sent[s])
                    seen[touched] = True
                    alarm[places] = seen[cell[places]]
                    seen[touched] = False
            keys, owner, part = keys[alarm], owner[alarm], part[alarm]
            found = np.zeros(len(keys), ENTRY)
            found["h"], found["g"], found["doc"] = keys, _second(hashes, at[alarm], size), _ids(texts, id_col)[owner]
            order = np.lexsort((found["doc"], found["g"], found["h"], part))
            found, part = found[order], part[order]
            first = np.r_[True, (found["h"][1:] != found["h"][:-1]) | (found["g"][1:] != found["g"][:-1])] if len(found) else np.zeros(0, bool)
            group = np.cumsum(first) - 1
            heads = np.flatnonzero(first)
            many = np.zeros(len(heads), np.int32)
            np.maximum.at(many, group, (found["doc"] != found["doc"][heads][group]).astype(np.int32))
            found = found[heads]
            found["many"] = many
            chunk = texts.column("__chunk")[0].as_py()
            rows = [(s, chunk, found[p].tobytes()) for s, p in _by_slice(part[heads], np.arange(len(heads)))]
        return pa.table({"slice": pa.array([r[0] for r in rows], pa.int64()), "chunk": pa.array([r[1] for r in rows], pa.int64()),
                         "data": pa.array([r[2] for r in rows], pa.binary())})

    def settle(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b, ENTRY) for b in table.column("data").to_pylist()]
        rows = np.concatenate(parts)
        source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.lexsort((rows["doc"], rows["g"], rows["h"]))
        rows, source = rows[order], source[order]
        heads = np.flatnonzero(np.r_[True, (rows["h"][1:] != rows["h"][:-1]) | (rows["g"][1:] != rows["g"][:-1])])
        group = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, len(rows)]))
        earliest = rows["doc"][heads][group]
        tell = (rows["doc"] > earliest) | (rows["many"] > 0)
        out = np.zeros(int(tell.sum()), ANSWER)
        out["h"], out["g"], out["doc"], source = rows["h"][tell], rows["g"][tell], earliest[tell], source[tell]
        order = np.argsort(source, kind="stable")
        found = [(i, out[p].tobytes()) for i, p in _by_slice(source[order], order)]
        names = table.column("chunk").to_pylist()
        return pa.table({"chunk": pa.array([names[i] for i, _ in found], pa.int64()), "data": pa.array([b for _, b in found], pa.binary())})

    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, keys, owner, at, starts = _windows(texts, size, id_col, text_col)
        covered = np.zeros(len(hashes) + 1, np.int64)
        if answers.num_rows:
            told = np.concatenate([np.frombuffer(b, ANSWER) for b in answers.column("data").to_pylist()])
            told = told[np.lexsort((told["g"], told["h"]))]
            maybe = np.isin(keys, told["h"])
            keys, owner, at = keys[maybe], owner[maybe], at[maybe]
            second = _second(hashes, at, size)
            doc = _ids(texts, id_col)[owner]
            later = np.zeros(len(keys), bool)
            low = np.searchsorted(told["h"], keys, "left")
            high = np.searchsorted(told["h"], keys, "right")
            for step in range(int((high - low).max()) if len(keys) else 0):  # over 1 only where two windows share 64 bits
                place = np.minimum(low + step, len(told) - 1)
                later |= (low + step < high) & (told["g"][place] == second) & (doc > told["doc"][place])
            np.add.at(covered, at[later], 1)
            np.add.at(covered, at[later] + size, -1)
        gone = np.cumsum(covered)[:-1] > 0
        counts = np.diff(starts)
        lost = np.diff(np.r_[0, np.cumsum(gone)][starts])
        kept = []
        for row, text in enumerate(texts.column(text_col)):
            if keep_untouched and not lost[row]:
                kept.append(text.as_py())
                continue
            own = (text.as_py() or "").encode().split()  # bytes split at the same six characters
            if lost[row]:
                own = compress(own, ~gone[starts[row]:starts[row + 1]])
            kept.append(b" ".join(own).decode())
        out = {c: texts.column(c) for c in names}
        out[text_col] = pa.array(kept, pa.string())
        out["n_words"], out["n_removed"] = pa.array(counts, pa.int64()), pa.array(lost, pa.int64())
        return pa.table(out)

    names = df.columns
    texts = dealt.groupBy("__chunk")
    packed = "chunk long, slice long, data binary"
    cells = texts.applyInArrow(sketch, "slice long, chunk long, data binary").groupBy("slice").applyInArrow(merge, packed)
    found = texts.cogroup(cells.groupBy("chunk")).applyInArrow(entries, "slice long, chunk long, data binary")
    answers = found.groupBy("slice").applyInArrow(settle, "chunk long, data binary")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return texts.cogroup(answers.groupBy("chunk")).applyInArrow(cut, f"{schema}, n_words long, n_removed long")
