"""SentencePiece encoding and decoding as a relational lattice.

Texts fall into units at places that no piece of the vocabulary crosses, so units
are segmented on their own, and each distinct one only once. Of every unit, the
substrings up to the longest piece are exploded and joined with the piece table;
the pieces found are the edges of its lattice, grouped by unit, and a fold reads the
segmentation off them. For a unigram model that is Viterbi, the path with the
largest sum of scores, as a higher-order function. For a BPE model the same sum
gives other pieces than the model means, so there the fold applies the model's
rule, to a batch of units at once: again and again it joins the two neighbours
whose union is the edge with the best score.

Texts travel in compressed chunks, once; what they exchange with the units are
packed arrays per chunk and bucket of units.
"""

from __future__ import annotations

import ctypes
import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.llm import words as W
from gridpanel.llm.common import tasks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_BYTES = 4 << 20  # text of a chunk
LONG = 200  # code points of a unit from which it is segmented in a loop of its own, not in the fold, whose time is quadratic
BUCKET_UNITS = 60_000
WIDTHS = (4, 6, 8, 10, 12, 16, 24, 32, 48, 64, 96, 128, LONG)  # code points of units that are folded together
CELLS = 1 << 18  # starts and sizes of such units
FOLDED = 2_000  # units of a batch
_MARK = "▁".encode()
UNKNOWN_PENALTY = 10.0  # below the least score, as the library has it


@dataclass
class Model:
    """A vocabulary: pieces (a space for the mark of a word), their ids and scores, ids of bytes, and the rule."""

    pieces: dict[str, tuple[int, float]]
    spelled: list[bytes]
    byte_ids: list[int]
    unknown: int
    rule: str
    prefix: bool

    def crossed(self) -> np.ndarray:
        """Whether a piece goes on from a character that ends in one byte to one that begins with another."""
        found = np.zeros((256, 256), bool)
        for piece in self.pieces:
            raw = [c.encode() for c in piece]
            for a, b in zip(raw, raw[1:]):
                found[a[-1], b[0]] = True
        return found

    def longest(self) -> int:
        return max(map(len, self.pieces), default=1)

    def least(self) -> float:
        return min((s for _, s in self.pieces.values()), default=0.0)


def read_model(path: str = MODEL) -> Model:
    """Read a model file; only identity normalisation is supported, as whole texts must come back."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    with open(path, "rb") as f:
        spec.ParseFromString(f.read())
    if spec.normalizer_spec.name != "identity" or spec.normalizer_spec.remove_extra_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("the model rewrites its input; only identity normalisation is supported")
    rule = {1: "viterbi", 2: "merges"}.get(spec.trainer_spec.model_type)
    if rule is None:
        raise ValueError("only unigram and BPE models are supported")
    known = sentencepiece.SentencePieceProcessor(model_file=path)
    size = known.get_piece_size()
    names = [known.id_to_piece(i).replace("▁", " ") for i in range(size)]
    plain = [not (known.is_byte(i) or known.is_unknown(i) or known.is_control(i) or known.is_unused(i)) for i in range(size)]
    spelled = [bytes([int(n[3:5], 16)]) if known.is_byte(i) else n.encode() if plain[i] else b"" for i, n in enumerate(names)]
    spelled[known.unk_id()] = " ⁇ ".encode()
    byte_ids = [0] * 256
    for i, n in enumerate(names):
        if known.is_byte(i):
            byte_ids[int(n[3:5], 16)] = i
    return Model({n: (i, known.get_score(i)) for i, n in enumerate(names) if plain[i]}, spelled,
                 byte_ids if any(byte_ids) else [], known.unk_id(), rule, spec.normalizer_spec.add_dummy_prefix)


# --- packed tables --------------------------------------------------------------


def release() -> None:
    """Give freed memory back, which idle workers would otherwise keep beside the running ones."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def to_blob(table: pa.Table, level: int = 3) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", level))) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def from_blob(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all().combine_chunks()


def chunked(batches, text_col: str):
    """Tables of about CHUNK_BYTES of text, in the order of the rows."""
    held, size = [], 0
    for batch in batches:
        for part in W.batches(batch, text_col, CHUNK_BYTES // 4):
            held.append(part)
            size += part.column(part.schema.get_field_index(text_col)).nbytes
            if size >= CHUNK_BYTES:
                table, held, size = pa.Table.from_batches(held), [], 0
                del part
                yield table
                del table
                release()
    if held:
        yield pa.Table.from_batches(held)
        del held
        release()


def keyed_chunks(batches, text_col: str):
    """(key, table) of the chunks of a task: a hash of the texts in order, of the task's number and of the chunk's place.

    Chunks of equal texts have different keys, so they never meet in a task; a
    second read of the same rows gives the same keys.
    """
    task = TaskContext.get().partitionId()
    for place, table in enumerate(chunked(batches, text_col)):
        data, places = W.text_bytes(table.column(text_col))
        key = xxhash.xxh64(np.array([task, place]).tobytes())
        key.update(np.ascontiguousarray(places))
        key.update(np.ascontiguousarray(data))
        del data, places
        yield key.intdigest() - (1 << 63), table
        del table  # before the next chunk is read


def text_chunks(df: DataFrame, text_col: str) -> DataFrame:
    """(chunk, data): the rows of ``df`` in compressed chunks, each under a key of its own."""

    def send(batches):
        for key, table in keyed_chunks(batches, text_col):
            found = pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([to_blob(table, 9)], pa.binary())], ["chunk", "data"])
            del table
            yield found
            del found

    return df.mapInArrow(send, "chunk long, data binary")


class Units:
    """The units of a column: their spans, the distinct ones ordered by bucket and hash, and which one each is."""

    def __init__(self, column, crossed: np.ndarray, prefix: bool, buckets: int):
        data, places = W.text_bytes(column)
        raw, lead = data.tobytes(), b" " if prefix else b""
        texts = [lead + raw[a:b] if b > a else b"" for a, b in zip(places[:-1], places[1:])]
        if _MARK in raw:
            texts = [t.replace(_MARK, b" ") for t in texts]
        self.places = np.cumsum([0, *map(len, texts)])
        self.raw = b"".join(texts)
        del raw, texts
        data, n = np.frombuffer(self.raw, np.uint8), len(self.raw)
        cut, apart = np.zeros(n, bool), ~crossed.ravel()
        for low in range(0, n, W.CHUNK):
            part = data[low:low + W.CHUNK]
            pairs = part.astype(np.uint16)
            pairs[1:] |= part[:-1].astype(np.uint16) << 8
            if low:
                pairs[0] |= np.uint16(data[low - 1]) << 8
            cut[low:low + len(part)] = apart[pairs] & ((part & 0xC0) != 0x80)
        cut[self.places[:-1][np.diff(self.places) > 0]] = True
        self.begins = np.flatnonzero(cut)
        del cut
        self.ends = np.r_[self.begins[1:], n].astype(np.int64) if n else self.begins
        codes, distinct = pd.factorize(W.hash_spans(data, self.begins, self.ends))
        first = np.zeros(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        bucket = (distinct % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((distinct, bucket))
        self.first, self.bucket = first[order], bucket[order]
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        del distinct, first, bucket, order
        self.which = place[codes]
        del codes
        self.starts = np.searchsorted(self.begins, self.places)

    def strings(self) -> list[str]:
        """The distinct units in order."""
        return [self.raw[a:b].decode() for a, b in zip(self.begins[self.first].tolist(), self.ends[self.first].tolist())]


# --- the lattice ----------------------------------------------------------------


def lattice(units: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(bucket, unit, start, size, id, score): the pieces in each unit; the edge of size 0 stands in every unit."""
    starts = units.select("bucket", "unit", F.length("unit").alias("n")).select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("start"))
    sizes = F.sequence(F.when(F.col("start") == 0, 0).otherwise(1), F.least(F.lit(longest), F.col("n") - F.col("start")))
    spans = starts.select("bucket", "unit", "start", F.explode(sizes).alias("size"))
    spans = spans.withColumn("piece", F.expr("substring(unit, start + 1, size)"))
    return spans.join(F.broadcast(pieces), "piece")


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _joined(n: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Bounds of the segments of units of n code points, a row each, filled up with n.

    ``scores`` has the score of a piece by unit, start and size, and -inf where there is
    none. In each step every unit joins its pair of neighbours with the best union, the
    leftmost first; those without a pair are done.
    """
    width = scores.shape[1]
    out = np.minimum(np.arange(width + 1)[None, :], n[:, None])
    active, bounds = np.flatnonzero(n > 1), out[n > 1]
    flat, cells = scores.ravel(), width * (width + 1)
    while len(active):
        start, stop = bounds[:, :-2], bounds[:, 2:]
        pairs = flat[active[:, None] * cells + np.minimum(start, width - 1) * (width + 1) + stop - start]
        pairs[bounds[:, 1:-1] >= n[active][:, None]] = -np.inf
        best = pairs.argmax(axis=1)
        going = pairs[np.arange(len(best)), best] > -np.inf
        done = bounds[~going]
        out[active[~going], :done.shape[1]], out[active[~going], done.shape[1]:] = done, n[active[~going], None]
        active, bounds, best = active[going], bounds[going], best[going]
        keep = np.arange(bounds.shape[1] - 1)[None, :]
        bounds = np.take_along_axis(bounds, keep + (keep > best[:, None]), axis=1)
        if bounds.shape[1] < 3:
            out[active, :bounds.shape[1]], out[active, bounds.shape[1]:] = bounds, n[active, None]
            break
    return out


def packed() -> Column:
    """An edge as one number, so that a unit's edges are small to gather and to send; the score is known by the id."""
    return (F.col("start") * 256 + F.col("size")).cast("long") * 2**32 + F.col("id") + 1


class Merges:
    """The fold of a BPE model: ids of units, as an Arrow array, from their packed edges."""

    def __init__(self, model: Model):
        self.byte_ids, self.unknown = np.array(model.byte_ids, np.int32), model.unknown
        self.scores = np.full(max((i for i, _ in model.pieces.values()), default=0) + 1, -np.inf)
        for i, score in model.pieces.values():
            self.scores[i] = score

    def __call__(self, unit: pa.Array, edges: pa.Array) -> pa.Array:
        n = pc.utf8_length(unit).to_numpy(zero_copy_only=False).astype(np.int64)
        items, lengths = edges.flatten(), edges.value_lengths().to_numpy(zero_copy_only=False)
        begins = np.cumsum(lengths) - lengths
        edge = items.to_numpy(zero_copy_only=False)
        start, size, piece = edge >> 40, edge >> 32 & 255, (edge & (2**32 - 1)) - 1
        order = np.argsort(n, kind="stable")
        flats, counts, at = [], [], 0
        while at < len(order):
            width = next(w for w in (*WIDTHS, int(n[order[at:]].max())) if w >= n[order[at]])
            cells = width * (width + 1)
            end = min(int(np.searchsorted(n[order], width, "right")), at + max(1, CELLS // cells))
            own = order[at:end]
            places = np.repeat(begins[own] - (np.cumsum(lengths[own]) - lengths[own]), lengths[own]) + np.arange(lengths[own].sum())
            whose = np.repeat(np.arange(len(own)), lengths[own])
            real = size[places] > 0
            places, whose = places[real], whose[real]
            cell = whose * cells + start[places] * (width + 1) + size[places]
            scores, ids = np.full(len(own) * cells, -np.inf), np.full(len(own) * cells, -1, np.int32)
            scores[cell], ids[cell] = self.scores[piece[places]], piece[places]
            bounds = _joined(n[own], scores.reshape(len(own), width, width + 1))
            row, k = np.nonzero(bounds[:, :-1] < bounds[:, 1:])
            low, high = bounds[row, k], bounds[row, k + 1]
            found = ids[row * cells + low * (width + 1) + high - low]
            each = np.ones(len(found), np.int64)
            lost = np.flatnonzero(found < 0)
            spelt = []
            for i in lost.tolist():
                raw = unit[int(own[row[i]])].as_py()[low[i]:high[i]].encode()
                spelt.append(self.byte_ids[list(raw)] if len(self.byte_ids) else np.array([self.unknown], np.int32))
                each[i] = len(spelt[-1])
            flat = np.repeat(found, each)
            if spelt:
                flat[flat < 0] = np.concatenate(spelt)
            flats.append(flat)
            counts.append(np.bincount(row, each, len(own)).astype(np.int64))
            at = end
        offsets = np.r_[0, np.cumsum(np.concatenate(counts))] if counts else np.zeros(1)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(flats) if flats else [], pa.int32()))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return lists.take(pa.array(back))


def viterbi(least: float, unit: str = "unit", edges: str = "edges") -> Column:
    """Segments (start, size, id) of a unigram model: the path with the largest sum of scores; a character without a piece is unknown."""
    n = F.length(unit)
    state = F.struct(F.lit(0.0).cast("double").alias("score"), F.lit(0).alias("start"), F.lit(None).cast("int").alias("id"))

    def step(best: Column, end: Column) -> Column:
        ending = F.filter(edges, lambda e: (e["start"] + e["size"] == end) & (e["size"] > 0))
        ways = F.transform(ending, lambda e: F.struct(
            (F.get(best, e["start"])["score"] + e["score"]).alias("score"), e["start"].alias("start"), e["id"].alias("id")))
        lost = F.array(F.struct((F.get(best, end - 1)["score"] + F.lit(least - UNKNOWN_PENALTY)).alias("score"), (end - 1).alias("start"), F.lit(None).cast("int").alias("id")))
        single = F.exists(edges, lambda e: (e["start"] == end - 1) & (e["size"] == 1))
        return F.concat(best, F.array(F.array_max(F.when(single, ways).otherwise(F.concat(ways, lost)))))

    def back(best: Column) -> Column:
        empty = F.struct(n.alias("at"), F.expr("cast(array() as array<struct<start:int,size:int,id:int>>)").alias("found"))

        def previous(s: Column, _: Column) -> Column:
            way = F.get(best, s["at"])
            own = F.array(F.struct(way["start"].alias("start"), (s["at"] - way["start"]).alias("size"), way["id"].alias("id")))
            return F.when(s["at"] == 0, s).otherwise(F.struct(way["start"].alias("at"), F.concat(own, s["found"]).alias("found")))

        return F.aggregate(F.sequence(F.lit(1), n), empty, previous, lambda s: s["found"])

    return _let(F.aggregate(F.sequence(F.lit(1), n), F.array(state), step), back)


def piece_ids(segments: Column, model: Model, unit: str = "unit") -> Column:
    """Ids of segments; a character without a piece becomes its bytes, or the unknown id where the model has none for bytes."""
    if model.byte_ids:
        table = F.array(*[F.lit(i) for i in model.byte_ids])

        def spelt(s: Column) -> Column:
            raw = F.hex(F.encode(F.substring(F.col(unit), s["start"] + 1, s["size"]), "UTF-8"))
            return _let(raw, lambda h: F.transform(F.sequence(F.lit(1), F.length(h) - 1, F.lit(2)), lambda k: F.element_at(table, F.conv(F.substring(h, k, F.lit(2)), 16, 10).cast("int") + 1)))
    else:
        def spelt(s: Column) -> Column:
            return F.array(F.lit(model.unknown))
    return F.flatten(F.transform(segments, lambda s: F.when(s["id"].isNotNull(), F.array(s["id"])).otherwise(spelt(s))))


def long_ids(text: str, model: Model) -> list[int]:
    """The same segmentation of one long unit in a loop."""
    if model.rule == "viterbi":
        best, way, longest, least = [0.0], [0], model.longest(), model.least() - UNKNOWN_PENALTY
        for end in range(1, len(text) + 1):
            found = [(best[s] + model.pieces[text[s:end]][1], s) for s in range(max(0, end - longest), end) if text[s:end] in model.pieces]
            if not any(s == end - 1 for _, s in found):
                found.append((best[end - 1] + least, end - 1))
            score, start = max(found)
            best.append(score)
            way.append(start)
        cuts, at = [len(text)], len(text)
        while at:
            at = way[at]
            cuts.append(at)
        parts = [text[a:b] for a, b in zip(cuts[::-1], cuts[::-1][1:])]
    else:
        parts = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            if 0 <= i and j < len(parts) and (known := model.pieces.get(parts[i] + parts[j])):
                heapq.heappush(heap, (-known[1], i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i] if parts[i] else len(parts)
            if parts[i] != a or j >= len(parts) or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, ""
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        parts = [p for p in parts if p]
    out = []
    for part in parts:
        if part in model.pieces:
            out.append(model.pieces[part][0])
        else:
            out += [model.byte_ids[b] for b in part.encode()] if model.byte_ids else [model.unknown]
    return out


def segmented(units: DataFrame, model: Model) -> DataFrame:
    """(bucket, unit, ids) of distinct units of up to LONG code points, partitioned as they came; for BPE models edges, still to be folded."""
    spark = units.sparkSession
    rows = [("", -1, 0.0), *((p, i, float(s)) for p, (i, s) in model.pieces.items())]
    pieces = spark.createDataFrame(rows, "piece string, id int, score double")
    edges = lattice(units.where(F.length("unit") <= LONG), pieces, model.longest())
    if model.rule == "merges":
        return edges.groupBy("unit", "bucket").agg(F.collect_list(packed()).alias("edges"))
    edges = edges.groupBy("unit", "bucket").agg(F.collect_list(F.struct("start", "size", "id", "score")).alias("edges"))
    edges = edges.withColumn("edges", F.filter("edges", lambda e: e["size"] > 0))
    return edges.select("bucket", "unit", viterbi(model.least()).alias("segments")).select("bucket", "unit", piece_ids(F.col("segments"), model).alias("ids"))


def encode(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with ids, the piece ids of the text, and n_tokens.

    The ids are those of the model's own library. A null or empty text has none.
    Characters that no piece holds become byte pieces. Equal rows get equal ids;
    other columns pass through, but for input columns ids and n_tokens, which are
    replaced. ``df`` is read twice and has to give the same rows in the same order
    both times, as stored tables do; the call fails if it does not.
    """
    spark: SparkSession = df.sparkSession
    df = df.drop("ids", "n_tokens")
    total = df.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    buckets = tasks(spark, total // 60, BUCKET_UNITS)
    crossed, prefix = model.crossed(), model.prefix
    shared = spark.sparkContext.broadcast(crossed)
    rules = spark.sparkContext.broadcast(model)
    fold = spark.sparkContext.broadcast(Merges(model) if model.rule == "merges" else None)

    def ask(batches):
        for key, table in keyed_chunks(batches, text_col):
            units = Units(table.column(text_col), shared.value, prefix, buckets)
            strings, bucket = units.strings(), units.bucket
            del units, table
            edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(strings) else []
            blobs = [to_blob(pa.table({"unit": pa.array(strings[a:b], pa.string())})) for a, b in zip(edges[:-1], edges[1:])]
            found = pa.RecordBatch.from_arrays([
                pa.array(bucket[edges[:-1]] if len(strings) else [], pa.int64()), pa.array([key] * len(blobs), pa.int64()), pa.array(blobs, pa.binary())],
                ["bucket", "chunk", "data"])
            del strings, bucket, blobs
            yield found
            del found

    def distinct(table: pa.Table) -> pa.Table:
        found = set()
        for raw in table.column("data").to_pylist():
            found.update(from_blob(raw).column("unit").to_pylist())
        release()
        return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()] * len(found), pa.int64()), "unit": pa.array(sorted(found), pa.string())})

    def one(column: pa.ChunkedArray) -> pa.Array:
        found = column.combine_chunks()
        return found if isinstance(found, pa.Array) else pa.concat_arrays(found.chunks)

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        units = dict(zip(known.column("unit").to_pylist(), range(known.num_rows)))
        if fold.value:
            parts = [known.slice(low, FOLDED).combine_chunks() for low in range(0, known.num_rows, FOLDED)]
            folded = [fold.value(one(part.column("unit")), one(part.column("edges"))) for part in parts]
            ids = pa.concat_arrays(folded) if folded else pa.array([], pa.list_(pa.int32()))
            del parts, folded
        else:
            ids = one(known.column("ids"))
        more, blobs = [], []
        for raw in asked.column("data").to_pylist():
            places = []
            for unit in from_blob(raw).column("unit").to_pylist():
                place = units.get(unit)
                if place is None:
                    place = units[unit] = known.num_rows + len(more)
                    more.append(long_ids(unit, rules.value))
                places.append(place)
            if len(ids) < known.num_rows + len(more):
                own = pa.array(more[len(ids) - known.num_rows:], pa.list_(pa.int32()))
                ids = pa.concat_arrays([ids.cast(own.type), own])
            blobs.append(to_blob(pa.table({"ids": ids.take(pa.array(places, pa.int32()))})))
        release()
        return pa.table({"chunk": asked.column("chunk"), "bucket": asked.column("bucket"), "data": pa.array(blobs, pa.binary())})

    names = df.columns

    def fill(texts: pa.Table, answers: pa.Table) -> pa.Table:
        found = dict(zip(answers.column("bucket").to_pylist(), answers.column("data").to_pylist()))
        told = [from_blob(found[b]).column("ids").combine_chunks() for b in sorted(found)]
        told = pa.concat_arrays([t if isinstance(t, pa.Array) else pa.concat_arrays(t.chunks) for t in told]) if told else pa.array([], pa.list_(pa.int32()))
        flat, offsets = told.flatten().to_numpy(), np.r_[0, np.cumsum(told.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
        out = []
        for raw in texts.column("data").to_pylist():
            table = from_blob(raw)
            units = Units(table.column(text_col), shared.value, prefix, buckets)
            if len(units.first) != len(told):
                raise ValueError("the texts changed between two reads; store them first")
            lengths = np.diff(offsets)[units.which]
            ends = np.cumsum(lengths)
            total = int(ends[-1]) if len(ends) else 0
            bounds, shift = np.r_[0, ends][units.starts], (offsets[units.which] - (ends - lengths)).astype(np.int32)
            del units, ends
            ids = flat[np.arange(total, dtype=np.int32) + np.repeat(shift, lengths)] if total else flat[:0]
            del shift, lengths
            own = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            out.append(pa.table({**{c: table.column(c) for c in names}, "ids": own, "n_tokens": pa.array(np.diff(bounds), pa.int64())}))
            release()
        return pa.concat_tables(out)

    asked = df.mapInArrow(ask, "bucket long, chunk long, data binary").repartition(buckets, "bucket").groupBy("bucket")
    # Partitioned by bucket once, the units need no further exchange for their edges or their way back.
    known = segmented(asked.applyInArrow(distinct, "bucket long, unit string").repartition(buckets, "bucket"), model)
    answers = asked.cogroup(known.groupBy("bucket")).applyInArrow(answer, "chunk long, bucket long, data binary")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    texts = text_chunks(df, text_col).groupBy("chunk")
    return texts.cogroup(answers.groupBy("chunk")).applyInArrow(fill, f"{schema}, ids array<int>, n_tokens long")


def decode(df: DataFrame, model: Model, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids; bytes that are no valid text become U+FFFD, null ids stay null."""
    df = df.drop(out_col)
    table = df.sparkSession.sparkContext.broadcast((np.frombuffer(b"".join(model.spelled), np.uint8), np.cumsum([0, *map(len, model.spelled)]), model.prefix))

    def run(batches):
        raw, offsets, prefix = table.value
        sizes = np.diff(offsets)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            texts = []
            for low in range(0, batch.num_rows, 256):
                part = column.slice(low, 256)
                ids = part.flatten().to_numpy(zero_copy_only=False)
                lengths = sizes[ids]
                ends = np.cumsum(lengths)
                total = int(ends[-1]) if len(ends) else 0
                data = raw[np.arange(total) + np.repeat(offsets[:-1][ids] - (ends - lengths), lengths)].tobytes() if total else b""
                counts = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                bounds = np.r_[0, ends][np.r_[0, np.cumsum(counts)]]
                for a, b, null in zip(bounds, bounds[1:], part.is_null().to_pylist()):
                    own = data[a:b]
                    if prefix and own[:1] == b" ":
                        own = own[1:]
                    texts.append(None if null else own.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out_col])
        release()

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)
    return df.mapInArrow(run, f"{schema}`{out_col}` string")
