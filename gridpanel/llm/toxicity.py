"""Toxicity by nearest labelled examples.

Texts are TF-IDF vectors over the terms that tell the labels apart. The examples
lie in an inverted index whose postings are cut into blocks of examples; for each
term and block the largest weight is kept. A query bounds every block from these
maxima, scores the most promising blocks, and then only those whose bound still
exceeds the k-th best similarity, so its nearest examples are exact. Their votes,
weighted by closeness, are calibrated on the examples themselves, each judged
without its own vote.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.llm import words as W
from gridpanel.llm.common import BROADCAST_ROWS
from gridpanel.llm.langid import held_out
from gridpanel.session import Stored

EXAMPLES = 12_000  # expected distinct labelled texts in the index, drawn by hash; all of them where there are fewer
TERMS = 1024  # most terms of a vector
LEAST_CHI = 25.0  # least chi-squared of a term with the label: that it is no accident
LEAST_EFFECT = 0.0075  # least chi-squared over labelled texts: that it matters, whatever their number
LEAST_TEXTS = 4  # least labelled texts with a term
BLOCK = 64  # examples per block
NEAREST = 15  # votes
FIRST = 4  # blocks scored before bounds are compared
SOFT = 0.1  # added to a distance before it is inverted
BINS = 200  # steps of the calibration


def term_hashes(column: pa.Array):
    """Hashes of the lower-cased words of letters and digits, and where each text's begin."""
    return W.hashed_words(column, lower=True, between=W.LETTERS_APART)


def term_counts(column: pa.Array, vocabulary: np.ndarray):
    """(text, term, count) arrays over the vocabulary, in order of text and term."""
    hashes, starts = term_hashes(column)
    if not len(vocabulary) or not len(hashes):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[at] == hashes
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    keys, counts = np.unique(owner[known] * len(vocabulary) + at[known], return_counts=True)
    return keys // len(vocabulary), keys % len(vocabulary), counts


class Vectors:
    """Unit TF-IDF vectors of a column, text by text; a text without known terms has none."""

    def __init__(self, column: pa.Array, vocabulary: np.ndarray, idf: np.ndarray):
        text, self.term, counts = term_counts(column, vocabulary)
        weight = (1 + np.log(counts)) * idf[self.term]
        norms = np.sqrt(np.bincount(text, weight * weight, minlength=len(column)))
        self.weight = weight / norms[text] if len(text) else weight
        self.starts = np.searchsorted(text, np.arange(len(column) + 1))

    def __getitem__(self, i: int):
        low, high = self.starts[i], self.starts[i + 1]
        return self.term[low:high], self.weight[low:high]


class Index:
    """Postings of the examples by term, and the largest weight of each term in each block of examples."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: np.ndarray, terms: int):
        # Examples that share their heaviest term lie together, which makes the bounds of blocks tight.
        heaviest = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in vectors]
        order = np.lexsort((ids, labels, heaviest))
        self.labels, self.ids = labels[order].astype(float), ids[order]
        self.blocks = -(-len(order) // BLOCK)
        sizes = [len(vectors[i][0]) for i in order]
        example = np.repeat(np.arange(len(order)), sizes)
        term = np.concatenate([vectors[i][0] for i in order]) if len(order) else np.zeros(0, np.int64)
        weight = np.concatenate([vectors[i][1] for i in order]) if len(order) else np.zeros(0)
        by_term = np.lexsort((example, term))
        self.example, self.weight = example[by_term], weight[by_term]
        cell = term[by_term] * self.blocks + self.example // BLOCK
        self.pointer = np.searchsorted(cell, np.arange(terms * self.blocks + 1))
        most = np.zeros(terms * self.blocks)
        np.maximum.at(most, cell, self.weight)
        self.most = most.reshape(terms, self.blocks)

    def _score(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Similarity of the query to each example of the blocks, a row per block."""
        cells = terms[:, None] * self.blocks + blocks[None, :]
        low = self.pointer[cells].ravel()
        size = self.pointer[cells + 1].ravel() - low
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(low, size)
        query = np.repeat(np.repeat(weights, len(blocks)), size)
        place = np.repeat(np.tile(np.arange(len(blocks)), len(terms)), size) * BLOCK + self.example[at] % BLOCK
        return np.bincount(place, query * self.weight[at], minlength=len(blocks) * BLOCK)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEAREST, without: int | None = None):
        """Places and similarities of the k most similar examples with any similarity, nearest first; ties by place."""
        if not len(terms) or not self.blocks:
            return np.zeros(0, np.int64), np.zeros(0)
        bounds = weights @ self.most[terms]
        promising = np.argsort(-bounds, kind="stable")
        promising = promising[bounds[promising] > 0]
        places, values = np.zeros(0, np.int64), np.zeros(0)
        done = 0
        while done < len(promising):
            kth = values[k - 1] if len(values) >= k else 0.0
            rest = promising[done:]
            rest = rest[:int(np.searchsorted(-bounds[rest], -kth + 1e-12, "right"))] if kth else rest
            take = rest[:FIRST if done == 0 else 16 * FIRST]
            if not len(take):
                break
            done += len(take)
            found = self._score(terms, weights, take)
            hit = np.flatnonzero(found > 0)
            own = take[hit // BLOCK] * BLOCK + hit % BLOCK
            if without is not None:
                hit, own = hit[own != without], own[own != without]
            places, values = np.r_[places, own], np.r_[values, found[hit]]
            order = np.lexsort((places, -values))[:k]
            places, values = places[order], values[order]
        return places, values

    def vote(self, terms: np.ndarray, weights: np.ndarray, without: int | None = None):
        """Share of the votes for label 1 (-1 when no example is near), and the nearest examples with similarities."""
        places, values = self.nearest(terms, weights, without=without)
        if not len(places):
            return -1.0, places, values
        closeness = values / (SOFT + 1 - np.minimum(values, 1))
        return float(closeness @ self.labels[places] / closeness.sum()), places, values


def calibration(votes: np.ndarray, labels: np.ndarray):
    """Steps and values of a rising function from votes to the share of label 1 (pooled adjacent violators)."""
    steps = np.round(votes * BINS)
    levels, at = np.unique(steps, return_inverse=True)
    total = np.bincount(at).astype(float)
    ones = np.bincount(at, labels)
    pools: list[list[float]] = []
    for level, n, y in zip(levels, total, ones):
        pools.append([level, n, y])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            top = pools.pop()
            pools[-1] = [pools[-1][0], pools[-1][1] + top[1], pools[-1][2] + top[2]]
    return np.array([p[0] for p in pools]), np.array([(p[2] + 0.5 * p[2] / max(p[1], 1)) / (p[1] + 0.5) for p in pools])


class Model:
    def __init__(self, vocabulary, idf, index, steps, values, prior):
        self.vocabulary, self.idf, self.index, self.steps, self.values, self.prior = vocabulary, idf, index, steps, values, prior

    def calibrated(self, vote: float) -> float:
        if not len(self.steps):
            return self.prior
        at = np.searchsorted(self.steps, np.round(vote * BINS), "right") - 1
        return float(self.values[max(0, at)])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from labelled texts; ``labels`` has (id, label), of which rows without a 0/1 label are ignored.

    Terms are chosen by their chi-squared over all labelled texts: it must be
    significant, and large for their number, so that more labels do not let in
    weaker terms. Their idf is
    taken over all of ``docs``, and about EXAMPLES distinct labelled texts, drawn by
    a hash of the text, become the index. Copies are one example, under their
    smallest id, whose label is the share of 1 among them; it votes and is calibrated
    once. An id labelled twice counts as 1 if any says so.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    count = known.agg(F.count(F.lit(1)), F.sum("y")).first()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    side = F.broadcast(known) if count[0] <= BROADCAST_ROWS else known
    train = texts.join(side, texts["doc_id"] == known["__id"]).select("doc_id", "text", "y")

    def spread(batches):
        for batch in batches:
            for part in W.batches(batch, "text", 4 * W.CHUNK):
                hashes, starts = term_hashes(part.column("text"))
                y = part.column("y").to_numpy().astype(np.int64)
                owner = np.repeat(np.arange(len(y)), np.diff(starts))
                order = np.lexsort((owner, hashes))
                hashes, owner = hashes[order], owner[order]
                new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])] if len(hashes) else np.zeros(0, bool)
                hashes, owner = hashes[new], owner[new]
                terms, at = np.unique(hashes, return_inverse=True)
                ones = np.bincount(at, y[owner], minlength=len(terms)).astype(np.int64)
                n = np.bincount(at, minlength=len(terms)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n), pa.array(ones)], ["term", "n", "ones"])

    total, ones = int(count[0] or 0), int(count[1] or 0)
    prior = ones / total if total else 0.0
    if not total or not ones or ones == total:
        return Model(np.zeros(0, np.uint64), np.zeros(0), Index([], np.zeros(0), np.zeros(0, np.int64), 0), np.zeros(0), np.zeros(0), prior)
    terms = train.select("text", "y").mapInArrow(spread, "term long, n long, ones long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("ones").alias("p"))
    a, b = F.col("p").cast("double"), (F.col("n") - F.col("p")).cast("double")
    c, d = F.lit(float(ones)) - a, F.lit(float(total - ones)) - b
    chi = F.lit(float(total)) * (a * d - b * c) * (a * d - b * c) / (F.lit(float(ones) * (total - ones)) * F.col("n") * F.greatest(F.lit(1.0), F.lit(float(total)) - F.col("n")))
    chosen = terms.where(F.col("n") >= LEAST_TEXTS).withColumn("chi", chi).where(F.col("chi") >= max(LEAST_CHI, LEAST_EFFECT * total))
    vocabulary = np.sort(np.array([r[0] for r in chosen.orderBy(F.desc("chi"), "term").limit(TERMS).select("term").collect()], np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(vocabulary)

    def frequency(batches):
        found, rows = np.zeros(len(shared.value), np.int64), 0
        for batch in batches:
            for part in W.batches(batch, "text"):
                rows += part.num_rows
                found += np.bincount(term_counts(part.column("text"), shared.value)[1], minlength=len(found))
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, np.arange(len(found))]), pa.array(np.r_[rows, found])], ["at", "n"])

    seen = dict(texts.select("text").mapInArrow(frequency, "at long, n long").groupBy("at").agg(F.sum("n")).collect())
    idf = np.log((1 + seen.get(-1, 0)) / (1 + np.array([seen.get(i, 0) for i in range(len(vocabulary))]))) if len(vocabulary) else np.zeros(0)
    idf = np.maximum(idf, 1e-3)
    train = train.withColumns({"key": F.xxhash64(F.lit(29), F.col("text")), "key2": F.xxhash64(F.lit(31), F.col("text"))})
    folded = Stored(train.groupBy("key", "key2").agg(F.min("doc_id").alias("first_id"), F.avg("y").alias("share")))
    share = F.lit(min(1.0, EXAMPLES / max(1, folded.df.count())))
    drawn = folded.df.where(F.pmod("key", F.lit(1 << 30)) < share * (1 << 30))
    drawn = train.join(F.broadcast(drawn), ["key", "key2"]).where("doc_id = first_id")

    def vectors(batches):
        for batch in batches:
            for part in W.batches(batch, "text"):
                own = Vectors(part.column("text"), shared.value, idf)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("share"), part.column("key"), part.column("key2"),
                    pa.array([own[i][0].tobytes() for i in range(part.num_rows)], pa.binary()),
                    pa.array([own[i][1].tobytes() for i in range(part.num_rows)], pa.binary())], ["doc_id", "share", "key", "key2", "terms", "weights"])

    vectored = drawn.select("doc_id", "text", "share", "key", "key2").mapInArrow(vectors, "doc_id long, share double, key long, key2 long, terms binary, weights binary")
    rows = vectored.dropDuplicates(["key", "key2"]).select("doc_id", "share", "terms", "weights", "key", "key2").collect()  # a row may stand twice
    folded.drop()
    rows.sort(key=lambda r: (r[0], r[2], r[3], r[4], r[5]))
    held = [(np.frombuffer(r[2], np.int64), np.frombuffer(r[3])) for r in rows]
    ids = np.array([r[0] for r in rows], np.int64)
    index = Index(held, np.array([r[1] for r in rows], float), np.arange(len(rows)), len(vocabulary))
    # Each example votes on all others; a task takes a share of them.
    place_of = np.argsort(index.ids)
    index.ids = ids[index.ids]
    both = spark.sparkContext.broadcast((index, held))
    jobs = spark.range(len(rows)).repartition(4 * spark.sparkContext.defaultParallelism) if len(rows) else spark.range(0)

    def alone(batches):
        index, held = both.value
        for batch in batches:
            at = batch.column("id").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([index.vote(*held[i], without=int(place_of[i]))[0] for i in at], pa.float64())], ["id", "vote"])

    votes = dict(jobs.mapInArrow(alone, "id long, vote double").collect())
    votes, y = np.array([votes[i] for i in range(len(rows))]), np.array([r[1] for r in rows], float)
    steps, values = calibration(votes, y) if len(rows) else (np.zeros(0), np.zeros(0))
    return Model(vocabulary, idf, index, steps, values, prior)


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with score (0 to 1), predicted (1 from 0.5), and the nearest examples as evidence.

    The score depends on the text alone; texts without a known term, null and empty
    ones among them, get the share of label 1 among such examples. ``evidence``
    lists the ids of the three nearest examples, ``similarity`` their cosines.
    Input columns of these four names are replaced.
    """
    df = df.drop("score", "predicted", "evidence", "similarity")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in W.batches(batch, text_col):
                own = Vectors(part.column(part.schema.get_field_index(text_col)), model.vocabulary, model.idf)
                scores, evidence, near, known = [], [], [], {}
                for i in range(part.num_rows):
                    terms, weights = own[i]
                    key = (terms.tobytes(), weights.tobytes())
                    if key not in known:
                        vote, places, values = model.index.vote(terms, weights)
                        known[key] = (min(1.0, max(0.0, model.calibrated(vote))), model.index.ids[places[:3]].tolist(), values[:3].tolist())
                    a, b, c = known[key]
                    scores.append(a)
                    evidence.append(b)
                    near.append(c)
                yield pa.RecordBatch.from_arrays([
                    *part.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array(evidence, pa.list_(pa.int64())), pa.array(near, pa.list_(pa.float64()))],
                    [*part.schema.names, "score", "predicted", "evidence", "similarity"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)
    return df.mapInArrow(run, f"{schema}score double, predicted int, evidence array<long>, similarity array<double>")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``docs`` with held_out and the columns of ``score``; labels of the held-out fifth are not read."""
    model = fit(docs, labels.where(~held_out(id_col, 5, 0)), id_col, text_col, label_col)
    return score(docs.withColumn("held_out", held_out(id_col, 5, 0)), model, text_col)
