"""From raw documents to encoded training text, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of ``documents``. Stages keep the order of the work: what no model can
read goes first, then copies of whole documents, then repeated passages; the
budget is set on what is left, and only what is chosen is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.llm import langid, mixing, ngram_join, pieces, substrings
from gridpanel.session import stored, tune

WINDOW = 50  # words of a repeated passage
WEIGHTS = {"lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}
SHARE, EPOCHS, SEED = 0.8, 2, 7

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learnt; a label that is missing, or surely wrong, is the predicted one.

    Texts that are null or have no letter go, and texts that are less typical of the
    language than its own texts of their size (``langid.Levels``).
    """
    tune(spark)
    train = docs.where(~langid.held_out("doc_id", 4, 2))
    model = langid.fit(train, levels=True)
    found = langid.predict(docs.withColumn("__lang", F.col("lang")), model, "text").where(F.col("lang_pred") != "und")
    label = F.coalesce("__lang", "lang_pred")
    if model.levels:
        found, label = found.where("known"), F.when(F.col("sure"), F.col("lang_pred")).otherwise(label)
    return found.withColumn("lang", label).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group linked by five-word shingles at 0.8 or more."""
    return ngram_join.first_of_groups(docs, 5, 80, 100)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that an earlier one has; emptied ones go."""
    cut = substrings.remove_repeats(docs, WINDOW, keep_untouched=True)
    kept = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions wanted, a row for each time that one is read."""
    levels = {"domain": F.regexp_extract("source", "^([^0-9]*)", 1), "lang": "lang", "source": "source"}
    return mixing.mix(docs, levels, WEIGHTS, SHARE, EPOCHS, SEED).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the piece ids of the text and their number."""
    found = pieces.encode(docs.select("doc_id", "lang", "source", "text"), pieces.read_model())
    return found.select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language), ("ngram_jaccard_join", near_duplicates), ("substring_dedup", repeated_passages),
    ("mixing", mixed), ("sentencepiece", encoded)]

#: Language ID and the piece ids are no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two of them is stored in the shared folder."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs)
    return docs
