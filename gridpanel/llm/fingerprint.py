"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

For every sample and every word of a text, with its count as weight S, draw r and
c from Gamma(2, 1) and b uniformly, all three functions of the word and the number
of the sample alone. With t = floor(ln S / r + b) and y = exp(r (t - b)), the word
with the smallest c / (y e^r) is sampled, together with t. Two texts agree in a
sample with the probability of the generalised Jaccard similarity of their word
counts, so the share of equal samples estimates it.

Draws come from hashes: a Gamma(2, 1) variate is minus the log of a product of two
uniforms. A sample is one long, ln(c / (y e^r)) in the high bits and the identity
of word and t in the low ones, so that a plain minimum keeps the winner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.llm.common import tasks
from gridpanel.session import Stored

GROUP = 8  # samples drawn in one generated method; more would be too long to be compiled
GROUPS = 4
SAMPLES = GROUP * GROUPS
TASK_CHARS = 4_000_000
ABSENT = -400.0  # log weight of a word that a text lacks: it loses every sample
_MASK, _STEP = (1 << 24) - 1, 1.0 / (1 << 24)


def words_of(text: Column) -> Column:
    """Pieces between white space; empty ones are still among them."""
    return F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " ")


def _uniform(bits: Column) -> Column:
    return bits.bitwiseAND(F.lit(_MASK)) * F.lit(_STEP) + F.lit(_STEP / 2)


def _draws(word: str, number: Column) -> tuple[Column, Column, Column, Column]:
    """Hash bits, r, ln c and b of a word for one sample."""
    x, y = F.xxhash64(F.col(word), number), F.xxhash64(number, F.col(word))
    r = -F.ln(_uniform(x) * _uniform(F.shiftrightunsigned(x, 40)))
    c = F.ln(-F.ln(_uniform(y) * _uniform(F.shiftrightunsigned(y, 40))))
    return y, r, c, _uniform(F.shiftrightunsigned(x.bitwiseXOR(y), 16))


def _sample(bits: str, r: str, c: str, b: str, log_weight: str) -> Column:
    t = F.floor(F.col(log_weight) / F.col(r) + F.col(b))
    value = F.col(c) - F.col(r) * (t - F.col(b) + 1.0)
    who = F.shiftrightunsigned(F.col(bits), 33).bitwiseXOR(t.bitwiseAND(F.lit(0xFFFF)))
    return F.min(F.shiftleft(F.floor((value + 64) * F.lit(float(1 << 20))), 31).bitwiseOR(who))


def signatures(terms: DataFrame, key: str, term: str, weights: dict[str, str], extra: list[Column]) -> DataFrame:
    """One row per key with an array of SAMPLES samples for each named weight column, and the extra aggregates.

    ``terms`` must be partitioned by ``key``; then nothing is shuffled here. A
    weight of 0 means that the term is absent; without any term the samples are
    those of nothing and the caller has to know.
    """
    logs = [F.when(F.col(w) > 0, F.ln(F.col(w).cast("double"))).otherwise(F.lit(ABSENT)).alias(f"__l_{n}") for n, w in weights.items()]
    rows = terms.select("*", *logs, F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))).alias("__group"))
    draws, samples = [], {n: [] for n in weights}
    for i in range(GROUP):
        parts = dict(zip("yrcb", _draws(term, F.col("__group") * GROUP + i)))
        draws += [part.alias(f"__{k}{i}") for k, part in parts.items()]
        for n in weights:
            samples[n].append(_sample(f"__y{i}", f"__r{i}", f"__c{i}", f"__b{i}", f"__l_{n}").alias(f"__{n}{i}"))
    found = rows.select("*", *draws).groupBy(key, "__group").agg(*[s for own in samples.values() for s in own], *extra)
    names = [e for e in found.columns if not e.startswith("__") and e != key]
    low = F.lit((1 << 31) - 1)
    arrays = [F.array(*[F.col(f"__{n}{i}").bitwiseAND(low).cast("int") for i in range(GROUP)]).alias(n) for n in weights]
    packed = found.select(key, F.struct("__group", *arrays).alias("__part"), *names)
    merged = packed.groupBy(key).agg(F.sort_array(F.collect_list("__part")).alias("__parts"), *[F.max(n).alias(n) for n in names])
    return merged.select(key, *[F.flatten(F.col(f"__parts.{n}")).alias(n) for n in weights], *names)


def likeness(a: str, b: str, empty_a: Column, empty_b: Column) -> Column:
    """Share of equal samples; two empty texts are equal, an empty one is unlike any other."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(empty_a & empty_b, F.lit(1.0)).when(empty_a | empty_b, F.lit(0.0)).otherwise(equal / F.lit(float(SAMPLES)))


def spelled(sample: str, empty: Column) -> Column:
    """Samples as a string of 8 hex digits each; empty for a text without words."""
    return F.when(empty, F.lit("")).otherwise(F.array_join(F.transform(sample, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), ""))


def next_keys(rows: DataFrame, spread: int) -> DataFrame:
    """(key, n_chars, next_key): the next row in descending doc_id, then by key; null ids last; after the last the first.

    Rows are range-partitioned and ordered within a range. Only the first row of
    each range, as many as there are partitions, is ordered in one place.
    """
    dealt = rows.repartitionByRange(spread, F.desc_nulls_last("doc_id"), "key").withColumn("part", F.spark_partition_id())
    dealt = Stored(dealt)
    by = Window.partitionBy("part").orderBy(F.desc_nulls_last("doc_id"), "key")
    inside = dealt.df.select("key", "n_chars", "part", F.lead("key").over(by).alias("after"), F.row_number().over(by).alias("place"))
    inside = Stored(inside)
    dealt.drop()
    firsts = inside.df.where("place = 1").select("part", F.col("key").alias("first_key"))
    over = Window.partitionBy(F.lit(0)).orderBy("part")
    firsts = firsts.select("part", F.coalesce(F.lead("first_key").over(over), F.first("first_key").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("wrap"))
    return inside.df.join(F.broadcast(firsts), "part").select("key", "n_chars", F.coalesce("after", "wrap").alias("next_key"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document's are.

    The edited text has the last floor(n_chars / 2) code points replaced by the
    first as many of the next document in descending id. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next, one
    row per input row. Null texts are empty; rows that repeat id and text count
    once in the order and get equal results; documents that share an id are ordered
    by a hash. A null id comes last. The next document of a single one is itself.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    base = base.withColumn("key", F.xxhash64("doc_id", "text")).withColumn("n_chars", F.length("text").cast("long"))
    rows = Stored(base.select("key", "doc_id", "n_chars"))
    once = rows.df.dropDuplicates(["key"])
    count, chars, repeats = rows.df.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_chars"), F.lit(0)), F.count(F.lit(1)) - F.count_distinct("key")).first()
    if repeats:
        base = base.dropDuplicates(["key"])
    links = Stored(next_keys(once, tasks(spark, count, 100_000)))
    half = F.floor(F.col("n_chars") / 2)
    spread = tasks(spark, chars, TASK_CHARS)
    texts = base.select("key", "text").repartition(spread, "key")
    asked = links.df.select(F.col("next_key").alias("key"), F.col("key").alias("for_key"), half.cast("int").alias("want")).repartition(spread, "key")
    heads = texts.join(asked.hint("merge"), "key").select(F.col("for_key").alias("key"), "want", F.expr("substring(text, 1, want)").alias("head"))
    both = texts.join(heads.repartition(spread, "key").hint("merge"), "key")
    edited = F.concat(F.expr("substring(text, 1, length(text) - want)"), "head")
    both = both.select("key", "text", edited.alias("edited"))
    # The digest rides along as four numbers in rows of their own, marked by ``part``.
    digest = F.sha2("edited", 256)
    quarters = [F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("long") for i in range(4)]

    def hashed(column: str, side: int) -> Column:
        return F.transform(words_of(F.col(column)), lambda w: F.struct(F.lit(side).alias("part"), F.when(w != "", F.xxhash64(w)).alias("term")))

    words = [hashed("text", 0), hashed("edited", 1)]
    marked = [F.struct(F.lit(i + 2).alias("part"), q.alias("term")) for i, q in enumerate(quarters)]
    terms = both.select("key", F.explode(F.concat(*words, F.array(*marked))).alias("w")).select("key", "w.part", "w.term").where("term IS NOT NULL")
    terms = terms.groupBy("key", "term", F.greatest(F.col("part"), F.lit(1)).alias("part")).agg(
        F.sum((F.col("part") == 0).cast("int")).alias("own"), F.sum((F.col("part") == 1).cast("int")).alias("other"))
    extra = [F.max(F.when(F.col("part") == i + 2, F.col("term"))).alias(f"q{i}") for i in range(4)]
    extra += [F.max("own").alias("own_words"), F.max("other").alias("other_words")]
    terms = terms.withColumn("own", F.when(F.col("part") == 1, F.col("own")).otherwise(0)).withColumn("other", F.when(F.col("part") == 1, F.col("other")).otherwise(0))
    signed = Stored(signatures(terms, "key", "term", {"a": "own", "b": "other"}, extra))
    after = signed.df.select(F.col("key").alias("next_key"), F.col("a").alias("c"), (F.col("own_words") == 0).alias("no_c"))
    whole = signed.df.join(links.df, "key").join(after, "next_key")
    no_a, no_b = F.col("own_words") == 0, F.col("other_words") == 0
    result = whole.select(
        "key", F.lower(F.concat(*[F.lpad(F.hex(f"q{i}"), 16, "0") for i in range(4)])).alias("edited_sha256"),
        spelled("a", no_a).alias("fingerprint"), spelled("b", no_b).alias("edited_fingerprint"),
        likeness("a", "b", no_a, no_b).alias("near_edited"), likeness("a", "c", no_a, F.col("no_c")).alias("near_next"))
    return rows.df.join(result, "key").drop("key")
