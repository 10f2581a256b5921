"""N-gram Jaccard join: documents whose sets of word n-grams overlap enough, and the groups they form.

Rare-first prefix filtering. All n-grams are put into one order, those known to
be frequent last; two sets that overlap enough share an n-gram among the first
few of each, so only these prefixes are joined. Length and positional filters
prune the pairs of a list, a suffix filter (n-gram counts by hash range) prunes
what is left, and each pair that remains is verified once on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.llm import words as W
from gridpanel.llm.common import BROADCAST_ROWS, components, tasks
from gridpanel.session import Stored, checkpointed

FREQUENT = 1 << 18  # n-grams whose frequency is kept; more would only make prefixes a little rarer, never change the result
BLOCK = 20_000  # documents of one list that meet in one task
NEAR = 32  # entries of a list whose pairs are all tried before it is stored
ENTRIES = 400_000  # prefix entries in a task
RANGES = 16  # hash ranges of the suffix filter


def ngram_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The distinct n-grams of each text, sorted; all words as one where there are fewer; empty without words."""
    hashes, starts = W.hashed_words(column, lower=True)
    for low, high in zip(starts[:-1], starts[1:]):
        own = hashes[low:high]
        if len(own) == 0:
            yield own
        else:
            yield np.unique(W.windows(own, min(size, len(own))))


def _rank(grams: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Known frequency of each n-gram, 0 when it is not among the frequent ones."""
    if not len(frequent):
        return np.zeros(len(grams), np.int64)
    at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
    return np.where(frequent[at] == grams, counts[at], 0)


def frequent_ngrams(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams, FREQUENT at most, and in how many documents each was seen.

    All documents are read; an n-gram that no task meets twice is rare enough. The
    least frequency is the lowest power of two that leaves few enough.
    """

    def count(batches):
        held, n = [], 0

        def flush():
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            keep = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(grams[keep].view(np.int64)), pa.array(counts[keep])], ["gram", "n"])

        for batch in batches:
            for part in W.batches(batch, "text"):
                for grams in ngram_sets(part.column("text"), size):
                    held.append(grams)
                    n += len(grams)
                if n >= 4_000_000:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    found = docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = Stored(found)
    sizes = dict(found.df.groupBy(F.floor(F.log2("n")).alias("power")).count().collect())
    power, kept = 64, 0
    while power and kept + sizes.get(power - 1, 0) <= FREQUENT:
        power -= 1
        kept += sizes.get(power, 0)
    rows = found.df.where(F.col("n") >= 2 ** power).toArrow()
    found.drop()
    grams = rows.column("gram").to_numpy().view(np.uint64)
    counts = rows.column("n").to_numpy()
    order = np.argsort(grams)
    return grams[order], counts[order]


def _needed(a, b, num: int, den: int):
    """Least intersection of sets of a and b that makes den * intersection >= num * union."""
    return -(-num * (a + b) // (num + den))


def _node(mixed: np.ndarray) -> int:
    """The key of a set of n-grams, from their mixed hashes."""
    return int(W.mix(np.array([mixed.sum(dtype=np.uint64) ^ np.uint64(len(mixed))])).view(np.int64)[0])


def prefixes(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """(doc_id, text_key, node, n, prefix): a node is a set of n-grams; its prefix holds the rarest of them, in order."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_ngrams(docs, size))

    def cut(batches):
        known, counts = frequent.value
        for batch in batches:
            for part in W.batches(batch, "text"):
                nodes, ns, firsts = [], [], []
                for grams in ngram_sets(part.column("text"), size):
                    n = len(grams)
                    ns.append(n)
                    if not n:
                        nodes.append(None)
                        firsts.append(None)
                        continue
                    own = W.mix(grams)
                    nodes.append(_node(own))
                    order = np.lexsort((own, _rank(grams, known, counts)))[:n - -(-num * n // den) + 1]
                    firsts.append(grams[order].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(nodes, pa.int64()), pa.array(ns, pa.int32()), pa.array(firsts, pa.binary())],
                    ["doc_id", "text_key", "node", "n", "prefix"])

    return docs.mapInArrow(cut, "doc_id long, text_key long, node long, n int, prefix binary"), frequent


def _passing(n, place, i, j, num: int, den: int):
    """Length and positional filter of the entries i and j of a list: whether the sets may still overlap enough."""
    near = den * np.minimum(n[i], n[j]) >= num * np.maximum(n[i], n[j])
    return near & (1 + np.minimum(n[i] - place[i] - 1, n[j] - place[j] - 1) >= _needed(n[i], n[j], num, den))


def shared_entries(sets: DataFrame, frequent, num: int, den: int) -> DataFrame:
    """(list, node, n, place) for prefix n-grams that two sets or more share.

    Entries of lists up to NEAR long stay only if the filters let one pair of
    theirs pass; longer lists stay whole.

    Entries travel packed, a binary per task and bucket. A list that is known to
    be longer than BLOCK is cut into blocks of nodes, and every two blocks meet in
    a bucket of their own, so no task holds a list of unbounded length.
    """
    spark = sets.sparkSession
    total = sets.agg(F.sum(F.length("prefix") / 8)).first()[0] or 0
    buckets = tasks(spark, int(total), ENTRIES)
    kind = np.dtype([("list", "u8"), ("node", "i8"), ("n", "i4"), ("place", "i4")])

    def deal(batches):
        known, counts = frequent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            grams = [np.frombuffer(p, np.uint64) for p in batch.column("prefix").to_pylist()]
            lengths = np.array([len(g) for g in grams])
            rows = np.zeros(lengths.sum(), kind)
            rows["list"] = np.concatenate(grams)
            rows["node"] = np.repeat(batch.column("node").to_numpy(), lengths)
            rows["n"] = np.repeat(batch.column("n").to_numpy(), lengths)
            rows["place"] = np.concatenate([np.arange(k) for k in lengths])
            blocks = -(-_rank(rows["list"], known, counts) // BLOCK)
            parts = [rows[blocks <= 1]]
            for many in np.unique(blocks[blocks > 1]):
                hot = rows[blocks == many]
                own = (W.mix(hot["node"].view(np.uint64)) % np.uint64(many)).astype(np.int64)
                for other in range(many):
                    copy = hot.copy()
                    pair = np.minimum(own, other) * many + np.maximum(own, other) + 1
                    copy["list"] = W.mix(copy["list"] + pair.astype(np.uint64))
                    parts.append(copy)
            rows = np.concatenate(parts)
            where = (W.mix(rows["list"]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            rows, where = rows[order], where[order]
            edges = np.flatnonzero(np.r_[True, where[1:] != where[:-1], True])
            yield pa.RecordBatch.from_arrays(
                [pa.array(where[edges[:-1]]), pa.array([rows[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())],
                ["bucket", "rows"])

    def gather(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(b, kind) for b in table.column("rows").to_pylist()])
        rows = np.unique(rows)
        n, place = rows["n"].astype(np.int64), rows["place"].astype(np.int64)
        edges = np.flatnonzero(np.r_[True, rows["list"][1:] != rows["list"][:-1], True])
        keep = np.repeat(np.diff(edges) > NEAR, np.diff(edges))
        for step in range(1, NEAR):
            at = np.flatnonzero(rows["list"][step:] == rows["list"][:-step])
            if not len(at):
                break
            at = at[_passing(n, place, at, at + step, num, den)]
            keep[at] = keep[at + step] = True
        rows = rows[keep]
        return pa.table({"list": rows["list"].view(np.int64), "node": rows["node"], "n": rows["n"], "place": rows["place"]})

    packed = sets.select("node", "n", "prefix").mapInArrow(deal, "bucket long, rows binary")
    return packed.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(gather, "list long, node long, n int, place int")


def candidate_pairs(entries: DataFrame, num: int, den: int, every: bool) -> DataFrame:
    """Pairs (a, b), a < b, that pass the length and positional filters.

    At first each list pairs all its nodes with its head: the one whose order the
    shared n-gram comes earliest in. It has the fewest rarer n-grams, so it is the
    text that the others of a group of copies were made from, or close to it, and
    the same one heads most lists of the group. With ``every``, entries carry the
    group found so far, and all pairs of different groups are made; pairs with the
    head have been judged already.
    """

    def pairs(table: pa.Table) -> pa.Table:
        lists, node = table.column("list").to_numpy(), table.column("node").to_numpy()
        n, place = table.column("n").to_numpy().astype(np.int64), table.column("place").to_numpy().astype(np.int64)
        group = table.column("root").to_numpy() if every else node
        order = np.lexsort((node, place, lists))
        lists, node, n, place, group = lists[order], node[order], n[order], place[order], group[order]
        edges = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1], True])

        def passing(i, j):
            keep = (group[i] != group[j]) & _passing(n, place, i, j, num, den)
            i, j = node[i[keep]], node[j[keep]]
            return np.stack([np.minimum(i, j), np.maximum(i, j)], 1)

        found = [np.zeros((0, 2), np.int64)]
        if not every:
            heads = np.repeat(edges[:-1], np.diff(edges))
            found.append(passing(heads, np.arange(len(lists))))
        else:
            for low, high in zip(edges[:-1], edges[1:]):
                for i in range(low + 1, high):
                    others = np.arange(i + 1, high)
                    found.append(passing(np.full(len(others), i), others))
        both = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": both[:, 0], "b": both[:, 1]})

    per_task = F.pmod(F.xxhash64("list"), F.lit(tasks(entries.sparkSession, entries.count(), ENTRIES)))
    grouped = entries.withColumn("bucket", per_task)
    return grouped.groupBy("bucket").applyInArrow(pairs, "a long, b long").distinct()


def verified(pairs: DataFrame, firsts: DataFrame, docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Those pairs of nodes whose whole sets overlap enough.

    ``firsts`` names one text of each node by id and key, and how often that row
    occurs. Whole texts travel to the pairs, compressed, since they take a third
    of the room of their n-grams' hashes; the sets are made again where a pair
    passes the suffix filter.
    """
    pairs = Stored(pairs)
    ids = pairs.df.select(F.col("a").alias("node")).union(pairs.df.select("b")).distinct()
    wanted = Stored(firsts.join(ids, "node", "left_semi").select("first_id", "first_key", "copies"))

    def read(batches):
        codec = pa.Codec("zstd", 3)
        for batch in batches:
            for part in W.batches(batch, "text"):
                nodes, ns, counts = [], [], []
                for grams in ngram_sets(part.column("text"), size):
                    nodes.append(_node(W.mix(grams)))
                    ns.append(len(grams))
                    counts.append(np.bincount((grams >> np.uint64(60)).astype(np.int64), minlength=RANGES).astype(np.int32).tobytes())
                raw = [(text or "").encode() for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array(ns, pa.int32()), pa.array(counts, pa.binary()), pa.array([len(r) for r in raw], pa.int32()),
                     pa.array([codec.compress(r, asbytes=True) for r in raw], pa.binary())],
                    ["node", "n", "counts", "bytes", "text"])

    few = wanted.df.limit(BROADCAST_ROWS // 2 + 1).count() <= BROADCAST_ROWS // 2
    chosen = docs.join(F.broadcast(wanted.df) if few else wanted.df,
                       (F.col("doc_id") == F.col("first_id")) & (F.col("text_key") == F.col("first_key")), "left_semi")
    sets = chosen.select("text").mapInArrow(read, "node long, n int, counts binary, bytes int, text binary")
    if wanted.df.where("copies > 1").limit(1).count():
        sets = sets.dropDuplicates(["node"])
    sets = Stored(sets)

    def judge(batches):
        codec = pa.Codec("zstd")
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            (a, na, ca, la, ta), (b, nb, cb, lb, tb) = (
                [batch.column(f"{c}_{side}" if c else side).to_pylist() for c in ("", "n", "counts", "bytes", "text")] for side in "ab")
            least = _needed(np.array(na, np.int64), np.array(nb, np.int64), num, den)
            ca, cb = (np.frombuffer(b"".join(c), np.int32).reshape(rows, RANGES) for c in (ca, cb))
            todo = np.flatnonzero(np.minimum(ca, cb).sum(axis=1) >= least)  # suffix filter
            keep = np.zeros(rows, bool)
            upto = np.cumsum([la[i] + lb[i] for i in todo])
            low = 0
            while low < len(todo):
                done = int(upto[low - 1]) if low else 0
                high = max(low + 1, int(np.searchsorted(upto, done + 4 * W.CHUNK, "right")))
                texts = {}
                for i in todo[low:high]:
                    for node, text, length in ((a[i], ta[i], la[i]), (b[i], tb[i], lb[i])):
                        if node not in texts:
                            texts[node] = codec.decompress(text, length, asbytes=True) if length else b""
                sets_of = dict(zip(texts, ngram_sets(pa.array(list(texts.values()), pa.large_binary()), size)))
                for i in todo[low:high]:
                    x, y = sets_of[a[i]], sets_of[b[i]]
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    keep[i] = int((y[at] == x).sum()) >= least[i]
                low = high
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    def side(name: str) -> DataFrame:
        return sets.df.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "counts", "bytes", "text")])

    out = Stored(pairs.df.join(side("b"), "b").join(side("a"), "a").mapInArrow(judge, "a long, b long"))
    for used in (pairs, wanted, sets):
        used.drop()
    return out


NAMELESS = 2**63 - 2**60  # from here on, ids stand for rows without one
_TEXT_KEY = 17


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.lit(_TEXT_KEY), F.col(text_col).cast("string"))


def jaccard_groups(df: DataFrame, size: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: the groups of documents linked by den * intersection >= num * union.

    A-Z is lower-cased; words are runs of bytes other than space and 0x09-0x0D.
    A document's set holds its distinct n-grams of ``size`` words; with fewer
    words, all of them as one. Null and empty texts have the empty set, are
    linked with nothing and are their own group. Equal sets are one node, however
    many documents share it, so copies are never paired. Repeated ids and rows
    are kept, each judged by its own text; a row without an id links like any
    other and gets its group's smallest id, or null if nobody in it has one. Ids
    lie below NAMELESS. An empty table gives an empty result, other columns are
    not read.
    """
    return _grouped(df, size, num, den, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def _grouped(df: DataFrame, size: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """``jaccard_groups`` with the key of the row's text and the root of its group, null for the empty set."""
    nameless = F.lit(NAMELESS) + F.shiftrightunsigned(_text_key(text_col), 4)
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), nameless).alias("doc_id"), F.col(text_col).cast("string").alias("text"), _text_key(text_col).alias("text_key"))
    cut, frequent = prefixes(docs, size, num, den)
    cut = checkpointed(cut)
    rows = cut.where("n > 0").groupBy("node", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    nodes = rows.groupBy("node").agg(F.min(F.struct("doc_id", "text_key", "copies")).alias("first"))
    nodes = Stored(nodes.select("node", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key"), F.col("first.copies").alias("copies")))
    same = (cut["node"] == nodes.df["node"]) & (cut["doc_id"] == nodes.df["first_id"]) & (cut["text_key"] == nodes.df["first_key"])
    one = cut.join(nodes.df, same).select(cut["node"], "n", "prefix")
    entries = Stored(shared_entries(one, frequent, num, den))
    links = verified(candidate_pairs(entries.df, num, den, False), nodes.df, docs, size, num, den)
    trees = components(links.df)
    rooted = entries.df.join(trees, "node", "left").select("list", "node", "n", "place", F.coalesce("root", "node").alias("root"))
    mixed = Stored(rooted.groupBy("list").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("list"))
    rooted = checkpointed(rooted.join(mixed.df, "list", "left_semi"))
    more = verified(candidate_pairs(rooted, num, den, True), nodes.df, docs, size, num, den)
    trees = components(links.df.unionByName(more.df))
    rooted = nodes.df.join(trees, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    least = Stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = Stored(rooted.join(least.df, "root").select("node", "root", "component_id"))
    result = cut.join(named.df, "node", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    ids = [F.when(F.col(c) < NAMELESS, F.col(c)).alias(c) for c in ("doc_id", "component_id")]
    return result.select(*ids, F.col("n").cast("long").alias("n_shingles"), "text_key", "root")


def first_of_groups(df: DataFrame, size: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose id is the smallest of their group, with all their columns.

    A row goes for its own text only: of rows that share an id and are linked, or
    equal, the one with the smallest text stays, and unlike rows of that id stay,
    too. Rows without an id stay.
    """
    groups = Stored(_grouped(df, size, num, den, id_col, text_col).where("doc_id IS NOT NULL").select(
        "doc_id", "text_key", "component_id", F.coalesce("root", "text_key").alias("root"), F.col("root").isNull().alias("empty")))
    later = Stored(groups.df.where("doc_id <> component_id").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct())
    first = groups.df.where("doc_id = component_id")
    several = first.groupBy(F.col("doc_id").alias("__id"), F.col("root").alias("__root"), F.col("empty").alias("__empty")).count().where("count > 1")
    again = Stored(first.join(several, (F.col("doc_id") == F.col("__id")) & (F.col("root") == F.col("__root")) & (F.col("empty") == F.col("__empty"))).select(
        "__id", F.col("text_key").alias("__key"), "__root", "__empty").distinct())

    def meet(rows: DataFrame, keys: Stored, how: str) -> DataFrame:
        few = keys.df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        side = F.broadcast(keys.df) if few else keys.df
        return rows.join(side, (F.col(id_col).cast("long") == F.col("__id")) & (_text_key(text_col) == F.col("__key")), how)

    kept = meet(df, later, "left_anti")
    if not again.df.limit(1).count():
        return kept
    order = Window.partitionBy("__id", "__root", "__empty").orderBy(text_col)
    one = meet(kept, again, "inner").withColumn("__place", F.row_number().over(order)).where("__place = 1").select(*df.columns)
    return meet(kept, again, "left_anti").unionByName(one)
