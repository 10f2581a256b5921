"""Registered corpus queries against their SQL, and the pipeline stage by stage against brute force."""

import os
import random
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from gridpanel.llm import queries
from tools.check import TABLES, rows_of

FOLDER = os.environ.get("GRIDPANEL_SF_DIR", "/root/testdata/sf0.001")


def test_registered():
    names = sorted(n for n in entry_module.queries() if n.startswith("op"))
    assert [int(n[2:].split("_")[0]) for n in sorted(names, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert "pipeline" in entry_module.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = entry_module.queries()[name](spark, FOLDER)
    cur = con.execute(entry_module.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cur.fetchall())


def test_pipeline(spark, tmp_path):
    from test_text_operators import cut_of, groups_of, words

    from gridpanel.llm import pieces

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(8001, None, "en", "src1", 0), (8002, "", "en", "src1", 0), (8003, "12 34", "en", "src1", 5), (None, "no id of its own", "en", None, 16), (8004, "plain words of no great length", None, None, 30)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    seen = {}
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(place))
        before = docs.columns
        stage(spark, docs, FOLDER).write.parquet(path)
        seen[name] = (docs, docs := spark.read.parquet(path))
        if place < 4:
            assert docs.columns == before
    given, kept = (x.collect() for x in seen["language_id"])
    gone = {r["doc_id"] for r in given} - {r["doc_id"] for r in kept}
    assert {8001, 8002, 8003} <= gone and len(gone) < 0.05 * len(given) and all(r["lang"] for r in kept)
    given, kept = (x.collect() for x in seen["ngram_jaccard_join"])
    groups = groups_of([(r["doc_id"], r["text"]) for r in given], 5, 80, 100)
    assert Counter(r["doc_id"] for r in kept) == Counter(i for i, _, c in groups if i is None or i == c)
    given, kept = (x.collect() for x in seen["substring_dedup"])
    want = {i: (t, gone) for i, t, n, gone in cut_of([(r["doc_id"], r["text"]) for r in given], 50) if not n or gone < n}
    assert {r["doc_id"] for r in kept} == set(want)
    for r in kept:
        text, gone = want[r["doc_id"]]
        assert " ".join(words(r["text"])) == text and (not gone or r["n_chars"] == len(r["text"]))
    given, kept = (x.collect() for x in seen["mixing"])
    total = sum(len(words(r["text"])) for r in given)
    assert {r["doc_id"] for r in kept} <= {r["doc_id"] for r in given} and sum(len(words(r["text"])) for r in kept) <= corpus_pipeline.SHARE * total + 1
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = {r["doc_id"]: r["text"] for r in kept}
    last = seen["sentencepiece"][1].collect()
    assert len(last) == len(kept) and all(list(r["ids"]) == model.encode(texts[r["doc_id"]]) for r in last)


def test_foreign_texts_go(spark):
    """Unlabelled texts in no language that was learnt go, and most labels that are surely wrong are replaced."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rng = random.Random(3)
    words = {
        "pl": "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem",
        "ru": "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью",
        "fi": "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto",
        "zh": "人 人 生 而 自 由 在 尊 严 和 权 利 上 一 律 平 等",
        "none": " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 10))) for _ in range(400))}
    foreign = [(7000 + 10 * i + k, " ".join(rng.choices(w.split(), k=n)), None, "s", 1)
               for i, w in enumerate(words.values()) for k, n in enumerate((10, 40, 150, 600))]
    own = [(r["doc_id"], r["lang"], r["text"]) for r in docs.where("doc_id IS NOT NULL AND length(text) > 300 AND lang IN ('de', 'es')").orderBy("doc_id").limit(8).collect()]
    wrong = [(7500 + i, text, "en", "s", 1) for i, (_, _, text) in enumerate(own)]
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language(spark, docs.unionByName(spark.createDataFrame(foreign + wrong, docs.schema)), FOLDER).collect()}
    assert not set(kept) & {r[0] for r in foreign}
    assert sum(r["doc_id"] not in kept for r in docs.collect()) < 0.02 * docs.count()
    assert sum(kept.get(7500 + i) == lang for i, (_, lang, _) in enumerate(own)) > len(own) // 2


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
        docs = spark.createDataFrame([], docs.schema)
