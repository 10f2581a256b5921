"""One query per corpus operator over its whole table, and its SQL counterpart where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridpanel.llm import (fingerprint, hard_negatives, html_tree, langid, licenses, mixing, ngram_join, pieces, substrings, top_k, toxicity,
                           vector_codes, vector_links)
from gridpanel.llm.common import ORACLES, QUERIES, load, query

__all__ = ["ORACLES", "QUERIES"]

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op1_html_extraction")
def op1(spark, d):
    return html_tree.main_text(load(spark, d, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


@query("op2_sentencepiece")
def op2(spark, d):
    model = pieces.read_model()
    found = pieces.encode(load(spark, d, "documents").select("doc_id", "text"), model)
    found = found.select("doc_id", "n_tokens", "ids", F.xxhash64(F.coalesce("text", F.lit(""))).alias("given"))
    found = pieces.decode(found, model)
    return found.select("doc_id", "n_tokens", "ids", (F.xxhash64("decoded") == F.col("given")).alias("round_trip"))


@query("op3_language_id")
def op3(spark, d):
    found = langid.identify(load(spark, d, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query("op4_document_fingerprints")
def op4(spark, d):
    return fingerprint.fingerprints(load(spark, d, "documents").select("doc_id", "text"))


@query("op5_license_scans")
def op5(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.fit(docs))


@query("op6_embedding_near_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  AND list_cosine_similarity(a.x, b.x) >= 0.93),
r AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, e.b FROM r JOIN e ON r.other = e.a),
c AS (SELECT vec_id, min(other) AS component_id FROM r GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n FROM e GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)""")
def op6(spark, d):
    return vector_links.link_vectors(load(spark, d, "embeddings").select("vec_id", "embedding", "label"))


@query("op7_ngram_jaccard_join", f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4
    THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY 1) c USING (doc_id)""")
def op7(spark, d):
    return ngram_join.jaccard_groups(load(spark, d, "documents"), size=4, num=85, den=100)


@query("op8_toxicity")
def op8(spark, d):
    found = toxicity.judge(load(spark, d, "documents").select("doc_id", "text"), load(spark, d, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", "evidence", "similarity")


@query("op9_substring_dedup", f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM w WHERE len(ws) >= 50),
g AS (SELECT doc_id, i, array_to_string(ws[i:i+49], ' ') AS g FROM p),
m AS (SELECT g, min(doc_id) AS first_id FROM g GROUP BY 1 HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM g JOIN m USING (g) WHERE doc_id > first_id),
k AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
  sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(ws) + 1), lambda j: gone IS NULL OR NOT list_contains(gone, j)),
    lambda j: ws[j]), ' '), '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)""")
def op9(spark, d):
    kept = substrings.remove_repeats(load(spark, d, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


MIX_WEIGHTS = {"domain": {"d0": 3, "d1": 2, "d2": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 1}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.5, 2, 7


def _mix_sql() -> str:
    """The budgets level by level, then the epochs."""
    levels, parts, parent = ["domain", "lang", "source"], [], "root"
    for depth, level in enumerate(levels):
        path, up = ", ".join(levels[:depth + 1]), ", ".join(levels[:depth]) or "1"
        cases = "".join(f" WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS.get(level, {}).items())
        weight = f"CAST(CASE {level}{cases} ELSE 1 END AS DOUBLE)" if cases else "CAST(1 AS DOUBLE)"
        join = f"JOIN b{depth - 1} USING ({up})" if depth else f"CROSS JOIN (SELECT least(CAST(floor({MIX_SHARE} * sum(tokens)) AS BIGINT), {MIX_EPOCHS} * sum(tokens)) AS budget FROM leaf) q"
        over = f"OVER (PARTITION BY {up} ORDER BY capacity / weight, {level} ROWS BETWEEN"
        parts.append(f"""
n{depth} AS (SELECT *, {weight} AS weight FROM (SELECT {path}, CAST({MIX_EPOCHS} * sum(tokens) AS BIGINT) AS capacity FROM leaf GROUP BY {path}) {join}),
f{depth} AS (SELECT *, capacity / weight <= (budget - coalesce(sum(capacity) {over} UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) {over} CURRENT ROW AND UNBOUNDED FOLLOWING) AS is_full FROM n{depth}),
b{depth} AS (SELECT {path}, CAST(CASE WHEN is_full THEN capacity ELSE floor(weight * (
  (budget - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER (PARTITION BY {up}))
  / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY {up}))) END AS BIGINT) AS budget FROM f{depth})""")
    return f"""
WITH d AS (SELECT doc_id, coalesce('d' || CAST(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 3 AS VARCHAR), '(none)') AS domain,
  coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source, len({WORDS}) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM d GROUP BY ALL),{",".join(parts)},
g AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN CAST(budget // tokens AS BIGINT) ELSE 0 END AS whole, budget, leaf.tokens AS all_tokens
  FROM b2 JOIN leaf USING (domain, lang, source)),
k AS (SELECT *, budget - whole * all_tokens AS rest, md5('{MIX_SEED}-' || CAST(whole AS VARCHAR) || '-' || CAST(doc_id AS VARCHAR)) AS k FROM d JOIN g USING (domain, lang, source)),
c AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY k) <= rest AND rest > 0 AS part FROM k)
SELECT doc_id, domain, lang, source, unnest(range(0, whole + CAST(part AS BIGINT))) AS epoch, tokens FROM c"""


@query("op10_mixing", _mix_sql())
def op10(spark, d):
    domain = F.concat(F.lit("d"), (F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int") % 3).cast("string"))
    docs = load(spark, d, "documents").select("doc_id", "text", "lang", "source").withColumn("domain", domain)
    mixed = mixing.mix(docs, {"domain": "domain", "lang": "lang", "source": "source"}, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    names = [F.coalesce(F.col(c), F.lit(mixing.NONE)).alias(c) for c in ("domain", "lang", "source")]
    return mixed.select("doc_id", *names, "epoch", "tokens")


WHOLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0"
FLOORS = "list_transform(embedding, lambda y: floor(256 * y::DOUBLE))"
PRODUCT = "CAST(list_inner_product(a.x, b.x) AS BIGINT)"


@query("op11_hard_negatives", f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {FLOORS} AS x
  FROM embeddings WHERE label IS NOT NULL AND {WHOLE}),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, {PRODUCT} AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5""")
def op11(spark, d):
    rows = load(spark, d, "embeddings").select("vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


@query("op12_exact_top_k", f"""
WITH v AS (SELECT vec_id, {FLOORS} AS x FROM embeddings WHERE {WHOLE}),
s AS (SELECT a.vec_id AS query_id, b.vec_id, {PRODUCT} AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 5""")
def op12(spark, d):
    return top_k.top_k(load(spark, d, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, 5)


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The rounds one after another: assign every part to its nearest entry, then move the entries."""
    assign = """
a{n} AS (SELECT p.vec_id, p.label, p.part, p.x, min(list_sum(list_transform(list_zip(p.x, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 256 + c.entry) AS best
  FROM p JOIN c{n} c USING (part) GROUP BY ALL)"""
    move = """
m{n} AS (SELECT part, CAST(best % 256 AS BIGINT) AS entry, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{n}),
f{n} AS (SELECT part, entry, list(y ORDER BY i) AS c FROM (SELECT part, entry, i, CAST(floor(sum(y)::DOUBLE / count(*)) AS BIGINT) AS y FROM m{n} GROUP BY ALL) GROUP BY ALL),
c{next} AS (SELECT part, entry, coalesce(f{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN f{n} USING (part, entry))"""
    steps = ",".join(assign.format(n=n) + "," + move.format(n=n, next=n + 1) for n in range(rounds)) + "," + assign.format(n=rounds)
    return f"""
WITH v AS (SELECT vec_id, label, list_transform({FLOORS}, lambda y: CAST(y AS BIGINT)) AS x FROM embeddings WHERE {WHOLE}),
p AS (SELECT vec_id, label, j AS part, x[j * (len(x) // {parts}) + 1:(j + 1) * (len(x) // {parts})] AS x FROM v, range({parts}) t(j)),
c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries})),{steps},
e AS (SELECT vec_id, label, string_agg(printf('%02x', CAST(best % 256 AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM e, h"""


@query("op13_vector_codes", _codes_sql())
def op13(spark, d):
    return vector_codes.compress(load(spark, d, "embeddings").select("vec_id", "embedding", "label"))
