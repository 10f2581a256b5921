"""Group tests, classifiers and their scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.functions.expressions import normal_tail, quoted, ratio
from gridpanel.operators.forest import Forest, balanced_forest, random_forest
from gridpanel.operators.ordered import exact_quantiles, running, to_long
from gridpanel.operators.vector_neighbors import knn_vectors


def rank_sum_test(df: DataFrame, group: str, columns: Sequence[str], positive=1, **how) -> DataFrame:
    """Two-sided rank-sum test and both medians per column.

    Equal values are folded with their class counts before anything is ordered,
    and the ranks come from block-wise running counts.
    """
    flagged = df.where(F.col(group).isNotNull()).withColumn("__g", (F.col(group) == F.lit(positive)).cast("int"))
    long = to_long(flagged, ["__g"], columns, "feature", "value").where("value IS NOT NULL")
    counts = long.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("__g").alias("n1")
    )
    ranked = running(counts, ["feature"], "value", {"upto": ("sum", "n")}, **how)
    rank = F.col("upto") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)
    n = F.col("n").cast("double")
    stats = ranked.groupBy("feature").agg(
        F.sum("n").cast("double").alias("nn"), F.sum("n1").cast("double").alias("n1"),
        F.sum(rank * F.col("n1")).alias("r1"), F.sum(n * n * n - n).alias("ties"),
    )
    n1, n2 = F.col("n1"), F.col("nn") - F.col("n1")
    u1 = F.col("r1") - n1 * (n1 + 1) / 2.0
    var = n1 * n2 / 12.0 * (F.col("nn") + 1 - ratio(F.col("ties"), F.col("nn") * (F.col("nn") - 1)))
    z = ratio(F.greatest(u1, n1 * n2 - u1) - n1 * n2 / 2.0 - 0.5, F.sqrt(var))
    out = stats.select("feature", u1.alias("u"), z.alias("z"))
    out = out.withColumn("p_value", F.least(2.0 * normal_tail(F.greatest("z", F.lit(0.0))), F.lit(1.0)))
    medians = exact_quantiles(long, ["feature", "__g"], "value", {"m": 0.5}, **how)
    wide = medians.groupBy("feature").agg(
        F.max(F.when(F.col("__g") == 1, F.col("m"))).alias("median_with"),
        F.max(F.when(F.col("__g") == 0, F.col("m"))).alias("median_without"),
    )
    return out.join(wide, "feature", "left")


def fdr_bh(df: DataFrame, p: str = "p_value", alpha: float = 0.05, **how) -> DataFrame:
    """Benjamini-Hochberg adjusted p and reject flag; NULL p stays NULL.

    Equal p-values share a rank, so the tests are folded by p first.
    """
    counts = df.where(F.col(p).isNotNull()).groupBy(F.col(p).alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    upto = running(counts, [], "__p", {"__upto": ("sum", "__n")}, **how).withColumn("__one", F.lit(1))
    total = counts.withColumn("__one", F.lit(1)).groupBy("__one").agg(F.sum("__n").alias("__m"))
    q = upto.join(F.broadcast(total), "__one").select("__p", (F.col("__p") * F.col("__m") / F.col("__upto")).alias("__q"))
    adjusted = running(q, [], "__p", {"__a": ("min", "__q")}, descending=True, **how).select("__p", "__a")
    out = df.join(adjusted, F.col(p) == F.col("__p"), "left").drop("__p")
    out = out.withColumn("p_adjusted", F.least(F.col("__a"), F.when(F.col("__a").isNotNull(), F.lit(1.0)))).drop("__a")
    return out.withColumn("is_significant", F.coalesce(F.col("p_adjusted") <= alpha, F.lit(False)))


def group_boxes(df: DataFrame, group: str, columns: Sequence[str], **how) -> DataFrame:
    """Minimum, quartiles and maximum per column and group."""
    long = to_long(df, [group], columns, "feature", "value")
    return exact_quantiles(
        long, [group, "feature"], "value", {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q4": 1.0}, **how
    )


# --- classifiers ------------------------------------------------------------------


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """n / (classes * rows of the class) on every row."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in sizes)
    pairs = [F.lit(v) for r in sizes for v in (r[label], total / (len(sizes) * r["n"]))]
    return df.withColumn(out, F.create_map(*pairs)[F.col(label)])


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip").transform(df)


def logistic(df: DataFrame, label: str, features: Sequence[str], balanced: bool = True, c: float = 1.0,
             rounds: int = 200):
    """L2-penalised logistic regression; returns the model and its coefficient table.

    The penalty 1/c per unit of total weight is the usual single-machine scale.
    """
    data = balanced_weights(df, label) if balanced else df.withColumn("weight", F.lit(1.0))
    data = assemble(data.select(label, "weight", *[quoted(f) for f in features]), features)
    total = data.agg(F.sum("weight")).first()[0]
    model = LogisticRegression(
        featuresCol="features", labelCol=label, weightCol="weight", maxIter=rounds, tol=1e-9,
        regParam=1.0 / (c * total), elasticNetParam=0.0, standardization=False,
    ).fit(data)
    rows = [("Intercept", float(model.intercept))]
    rows += [(f, float(v)) for f, v in zip(features, model.coefficients.toArray(), strict=True)]
    return model, df.sparkSession.createDataFrame(rows, "term string, coef double")


def feature_importance(spark, model, features: Sequence[str]) -> DataFrame:
    rows = sorted(zip(features, map(float, model.featureImportances.toArray()), strict=True), key=lambda r: -r[1])
    return spark.createDataFrame(rows, "feature string, importance double")


def predict(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds ``predicted`` (0/1) and ``score`` (probability of class 1)."""
    if isinstance(model, Forest):
        return model.predict(df)
    out = model.transform(assemble(df, features))
    score = vector_to_array("probability")[1]
    return out.withColumns({"score": score, "predicted": F.col("prediction").cast("int")}).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def classification_report(df: DataFrame, actual: str, predicted: str, part: str | None = None) -> DataFrame:
    """Confusion counts, accuracy and true-positive rate, per part if given."""
    y, p = F.col(actual) == 1, F.col(predicted) == 1
    grouped = df.groupBy(part) if part else df.groupBy()
    return grouped.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"),
        ratio(F.count_if(F.col(actual) == F.col(predicted)), F.count(F.lit(1))).alias("accuracy"),
        ratio(F.count_if(y & p), F.count_if(y)).alias("true_positive_rate"),
    )


def roc_auc(df: DataFrame, label: str, score: str, **how) -> DataFrame:
    """Exact area under the curve from average ranks, as a one-row frame."""
    counts = df.dropna(subset=[label, score]).groupBy(score).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col(label) == 1).cast("int")).alias("n1")
    )
    ranked = running(counts, [], score, {"upto": ("sum", "n")}, **how)
    rank = F.col("upto") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)
    sums = ranked.agg(
        F.sum(rank * F.col("n1")).alias("r"), F.sum("n1").cast("double").alias("n1"),
        F.sum("n").cast("double").alias("n"),
    )
    n1, n0 = F.col("n1"), F.col("n") - F.col("n1")
    return sums.select(ratio(F.col("r") - n1 * (n1 + 1) / 2.0, n1 * n0).alias("auc"))


def vote_shares(near: DataFrame, rows: DataFrame, key: str, label: str, k: int) -> DataFrame:
    """Predicted label per row for every 1..k from its ranked neighbours."""
    voted = near.join(rows.select(F.col(key).alias("neighbor"), F.col(label).alias("__vote")), "neighbor")
    # Per row there are k neighbours, so these windows are bounded by k rows.
    running_votes = Window.partitionBy(key, "__vote").orderBy("rank")
    steps = voted.withColumn("__votes", F.row_number().over(running_votes))
    # A label's count holds from its rank until the label's next vote.
    until = F.coalesce(F.lead("rank").over(running_votes), F.lit(k + 1))
    spans = steps.withColumn("__until", until - 1).withColumn("k", F.explode(F.sequence("rank", "__until")))
    best = F.max(F.struct(F.col("__votes").alias("n"), (-F.col("__vote")).alias("l")))
    return spans.groupBy(key, "k").agg((-best["l"]).alias("predicted"))


def knn_predict(train: DataFrame, test: DataFrame, key: str, vector: str, label: str, k: int) -> DataFrame:
    """Majority label of the k nearest training rows (lowest label on ties)."""
    near = knn_vectors(test, train, k, vector, key, key)
    return vote_shares(near, train, key, label, k).where(F.col("k") == k).drop("k")


def knn_classify(
    df: DataFrame, key: str, vector: str, label: str, fold: str, kmax: int = 74
) -> DataFrame:
    """Cross-validated accuracy for every k from 1 to kmax, from one neighbour search.

    The accuracy is the mean over folds, as cross-validation reports it.
    """
    near = knn_vectors(df, df, kmax, vector, key, key, apart=fold)
    votes = vote_shares(near, df, key, label, kmax)
    scored = votes.join(df.select(key, label, fold), key)
    per_fold = scored.groupBy("k", fold).agg(
        ratio(F.count_if(F.col(label) == F.col("predicted")), F.count(F.lit(1))).alias("a")
    )
    return per_fold.groupBy("k").agg(F.avg("a").alias("accuracy"))


def column_errors(df: DataFrame, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Mean squared error per feature from (feature, actual, predicted) columns."""
    row = df.agg(F.array(*[
        F.struct(
            F.lit(name).alias("feature"),
            F.avg(F.pow(F.col(quoted(a)).cast("double") - F.col(quoted(p)).cast("double"), F.lit(2.0))).alias("mse"),
        ) for name, a, p in pairs
    ]).alias("r"))
    return row.select(F.inline("r"))


def hardest(errors: DataFrame, n: int = 10, easiest: bool = False) -> DataFrame:
    order = F.col("mse").asc() if easiest else F.col("mse").desc()
    return errors.orderBy(order, "feature").limit(n)
