"""Language ID by string kernels.

The kernel of two texts is the number of letter n-grams (1 to ORDER) that both
contain, over the root of the product of their own numbers: a blended-spectrum
presence kernel. A few landmark texts per language span it (Nyström), and one
ridge regression per language is fitted in that space from sums that the tasks
make, so the driver only solves a system as wide as there are landmarks. Since
the kernel is linear in the presence of n-grams, a batch of texts is scored by
one product of its presence matrix with the weights.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 3  # longest n-gram
LETTERS = 100  # letters told apart, the most frequent of the landmarks; all others are one class
LANDMARKS = 24  # texts per language
SAMPLE = 400  # expected texts per language that the regression is fitted on
LONGEST = 20_000  # code points of a text that it is fitted on; predictions have no such limit
SEGMENT = 1 << 20  # code points that are held as arrays at once
ROWS = 128  # texts of one matrix product
SIZE_GROUPS, GROUP_ROWS = 16, 30  # most groups of texts of about the same size, and least texts of one
STRANGERS, LOST = 0.05, 0.005  # share of texts of other languages that may stay, and of the model's own that may go


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _folded(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


class Grams:
    """Distinct n-grams of texts as numbers below ``size``; runs of other characters are one mark."""

    def __init__(self, alphabet: np.ndarray):
        self.kind = np.where(_letters(), np.int32(1), np.int32(0)).astype(np.int32)
        self.kind[alphabet] = np.arange(2, len(alphabet) + 2)
        self.base = len(alphabet) + 2
        self.offsets = np.cumsum([0] + [self.base ** n for n in range(1, ORDER + 1)])
        self.size = int(self.offsets[-1])
        self.seen = np.zeros(self.size, bool)
        self.at = np.zeros(self.size, np.int64)

    def __call__(self, text: str | None) -> np.ndarray | None:
        """None for a text without letters."""
        if not text:
            return None
        found, tail, letters = [], np.zeros(0, np.int32), False
        for low in range(0, len(text), SEGMENT):
            kinds = self.kind[_folded(text[low:low + SEGMENT])]
            letters = letters or bool((kinds > 0).any())
            kinds = np.r_[tail if low else np.zeros(1, np.int32), kinds]
            if low + SEGMENT >= len(text):
                kinds = np.r_[kinds, np.int32(0)]
            kinds = kinds[np.r_[True, (kinds[1:] > 0) | (kinds[:-1] > 0)]]
            tail = kinds[-(ORDER - 1):]
            codes = np.zeros(len(kinds), np.int64)
            for n in range(1, ORDER + 1):
                if len(kinds) < n:
                    break
                codes = codes[:len(kinds) - n + 1] * self.base + kinds[n - 1:]
                own = codes + self.offsets[n - 1]
                own = own[~self.seen[own]]
                self.at[own] = np.arange(len(own))
                own = own[self.at[own] == np.arange(len(own))]
                self.seen[own] = True
                found.append(own)
        grams = np.concatenate(found)
        self.seen[grams] = False
        return grams if letters else None


class Levels:
    """How typical a text must be of a language, by its number of distinct n-grams.

    A text is as typical as the mean share of the language's landmarks that have its
    n-grams. Below ``least`` it is not in the language; at ``sure`` or above in one and
    below ``least`` in all others its language is beyond doubt. Both are read off training rows of about the same
    size: how typical they are of their own language, and at most of another.
    ``least`` never takes more than LOST of them.
    """

    def __init__(self, sizes: np.ndarray, own: np.ndarray, strange: np.ndarray):
        groups = max(1, min(SIZE_GROUPS, len(sizes) // GROUP_ROWS))
        self.begins, self.least, self.sure = [], [], []
        for at in np.array_split(np.argsort(sizes, kind="stable"), groups):
            reject, keep = float(np.quantile(strange[at], 1 - STRANGERS)), float(np.quantile(own[at], LOST))
            self.begins.append(float(sizes[at[0]]))
            self.least.append(min(reject, keep))
            self.sure.append(max(reject, keep))

    def of(self, size: float) -> tuple[float, float]:
        at = max(0, int(np.searchsorted(self.begins, size, "right")) - 1)
        return self.least[at], self.sure[at]


class Model:
    """Languages, the n-grams of the landmarks, and a weight for each of them and language."""

    def __init__(self, names: list[str], alphabet: np.ndarray, vocabulary: np.ndarray, weights: np.ndarray):
        self.names, self.alphabet, self.vocabulary, self.weights = names, alphabet, vocabulary, weights
        self.levels: Levels | None = None

    def scorer(self, sizes: bool = False):
        """A function of texts; with ``sizes`` it also returns the number of distinct n-grams of each."""
        grams = Grams(self.alphabet)
        place = np.full(grams.size, -1, np.int32)
        place[self.vocabulary] = np.arange(len(self.vocabulary))

        def score(texts: list[str | None]) -> np.ndarray:
            """A row per text and a column per language; nan for texts without letters."""
            out, count = np.full((len(texts), self.weights.shape[1]), np.nan), np.zeros(len(texts))
            for low in range(0, len(texts), ROWS):
                part = texts[low:low + ROWS]
                present = np.zeros((len(part), len(self.vocabulary)), np.float32)
                norms = np.full(len(part), np.nan)
                for i, text in enumerate(part):
                    own = grams(text)
                    if own is not None:
                        norms[i] = np.sqrt(len(own))
                        at = place[own]
                        present[i, at[at >= 0]] = 1
                out[low:low + len(part)] = (present @ self.weights) / norms[:, None]
                count[low:low + len(part)] = np.nan_to_num(norms) ** 2
            return (out, count) if sizes else out

        return score


def _landmark_side(texts: list[str]):
    """Alphabet, vocabulary, the presence of its n-grams over the norm, per landmark, and the landmarks' kernel."""
    points, counts = np.unique(np.concatenate([_folded(t) for t in texts]), return_counts=True)
    keep = _letters()[points]
    points, counts = points[keep], counts[keep]
    alphabet = np.sort(points[np.lexsort((points, -counts))[:LETTERS]])
    grams = Grams(alphabet)
    sets = [grams(t) for t in texts]
    vocabulary = np.unique(np.concatenate(sets))
    side = np.zeros((len(vocabulary), len(texts)), np.float32)
    for j, own in enumerate(sets):
        side[np.searchsorted(vocabulary, own), j] = 1 / np.sqrt(len(own))
    return alphabet, vocabulary, side, side.T.astype(float) @ side


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", ridge: float = 1e-3, levels: bool = False) -> Model:
    """Fit on about SAMPLE texts per language, drawn by a hash of id and text; LANDMARKS of them span the kernel.

    Rows without a language or letters and texts over LONGEST code points are not
    drawn. The counts that set the shares are taken over all rows. With ``levels``
    the model also learns how typical its own texts are of their language and of others.
    """
    usable = train.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & (F.length(text_col) <= LONGEST))
    usable = usable.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
                           (F.pmod(F.xxhash64(F.lit(17), F.col(id_col), F.col(text_col)), F.lit(1 << 30)) / (1 << 30)).alias("draw"))
    sizes = dict(usable.groupBy("lang").count().collect())
    names = sorted(sizes)
    if not names:
        return Model([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0), np.float32))
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(SAMPLE / n)) for k, n in sizes.items()])
    drawn = usable.where(F.col("draw") < share)
    lead = F.coalesce(*[F.when(F.col("lang") == k, F.lit(LANDMARKS / n)) for k, n in sizes.items()])
    leads = drawn.where(F.col("draw") < lead).select("text", "lang").orderBy("draw").limit(2 * LANDMARKS * len(names)).collect()
    if not leads:
        leads = usable.select("text", "lang").orderBy("draw").limit(LANDMARKS).collect()
    texts = [r[0] for r in leads]
    alphabet, vocabulary, side, kernel = _landmark_side(texts)
    values, vectors = np.linalg.eigh(kernel)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    span = Model(names, alphabet, vocabulary, (side @ root).astype(np.float32))
    wide = root.shape[1]

    def sums(batches):
        score = span.scorer()
        both, cross = np.zeros((wide + 1, wide + 1)), np.zeros((wide + 1, len(names)))
        for batch in batches:
            x = score(batch.column("text").to_pylist())
            x = np.c_[x, np.ones(len(x))]
            y = np.array([[float(lang == k) for k in names] for lang in batch.column("lang").to_pylist()]).reshape(len(x), len(names))
            both += x.T @ x
            cross += x.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([both.tobytes()]), pa.array([cross.tobytes()])], ["both", "cross"])

    parts = drawn.select("text", "lang").mapInArrow(sums, "both binary, cross binary").collect()
    both = sum(np.frombuffer(r[0]).reshape(wide + 1, wide + 1) for r in parts)
    cross = sum(np.frombuffer(r[1]).reshape(wide + 1, len(names)) for r in parts)
    solved = np.linalg.solve(both + ridge * np.trace(both) / len(both) * np.eye(wide + 1), cross)
    model = Model(names, alphabet, vocabulary, (side @ (root @ solved[:-1])).astype(np.float32))
    model.shift = solved[-1]
    if levels:
        whose = np.array([[float(r[1] == k) for k in names] for r in leads])
        typical = ((side > 0) @ (whose / np.maximum(1, whose.sum(0)))).astype(np.float32)
        judge = Model(names, alphabet, vocabulary, typical)

        def judged(batches):
            score = judge.scorer(sizes=True)
            for batch in batches:
                found, size = score(batch.column("text").to_pylist())
                own = np.array([[lang == k for k in names] for lang in batch.column("lang").to_pylist()], bool).reshape(found.shape)
                found /= np.sqrt(size)[:, None]
                other = np.where(own, 0.0, found).max(1) if len(found) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([pa.array(size), pa.array(np.where(own, found, 0.0).sum(1)), pa.array(other)], ["size", "own", "other"])

        rows = drawn.select("text", "lang").mapInArrow(judged, "size double, own double, other double").collect()
        if rows:
            model.levels = Levels(*np.array([tuple(r) for r in rows]).T)
            model.weights = np.c_[model.weights, typical]
    return model


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with lang_pred and score; the score is the best language's regression value, cut to 0..1.

    Null texts and texts without a letter are ``und`` with score 0, and so is every
    text when the model has no languages. Ties go to the first language by name.
    The columns lang_pred and score of ``df`` are replaced, others pass through. A
    model with levels adds ``known``, whether the text is in one of its languages,
    and ``sure``, whether lang_pred is beyond doubt.
    """
    df = df.drop("lang_pred", "score", *(["known", "sure"] if model.levels else []))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        score = model.scorer(sizes=True) if model.names else None
        for batch in batches:
            langs, best, inside, sure = [], [], [], []
            texts = batch.column(batch.schema.get_field_index(text_col))
            for low in range(0, batch.num_rows, 4 * ROWS):
                part = texts.slice(low, 4 * ROWS).to_pylist()
                values, grams = score(part) if model.names else (np.full((len(part), 1), np.nan), np.zeros(len(part)))
                if model.levels:
                    values, typical = np.split(values, 2, axis=1)
                values = values + model.shift if model.names else values
                if model.levels:
                    for n, row, own in zip(grams, values, typical):
                        low, high = model.levels.of(n)
                        own, top = own / np.sqrt(max(1, n)), int(row.argmax())
                        inside.append(bool(n and own[top] >= low))
                        sure.append(bool(n and own[top] >= high and np.delete(own, top).max(initial=-1.0) < low))
                for row in values:
                    known = not np.isnan(row[0])
                    top = int(row.argmax()) if known else 0
                    langs.append(model.names[top] if known else "und")
                    best.append(min(1.0, max(0.0, float(row[top]))) if known else 0.0)
            told = {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(best, pa.float64())}
            if model.levels:
                told |= {"known": pa.array(inside, pa.bool_()), "sure": pa.array(sure, pa.bool_())}
            yield pa.RecordBatch.from_arrays([*batch.columns, *told.values()], [*batch.schema.names, *told])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)
    return df.mapInArrow(run, f"{schema}lang_pred string, score double" + (", known boolean, sure boolean" if model.levels else ""))


def held_out(id_col: Column | str, folds: int, fold: int) -> Column:
    """Whether a row belongs to the held-out fold: crc32 of the id as text; a null id never does."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``df`` with held_out, lang_pred and score, the model learnt from the rows that are not held out."""
    apart = held_out(id_col, 4, 2)
    return predict(df.withColumn("held_out", apart), fit(df.where(~apart), id_col, text_col, lang_col), text_col)
