"""Components, clusters and regression on components."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.functions.expressions import ratio
from gridpanel.operators.aggregate import entity_mode
from gridpanel.operators.lloyd import Model, best_of, fit_many, silhouettes, vectors
from gridpanel.operators.regression import Fit, ols


def as_vector(df: DataFrame, features: Sequence[str] | str, out: str = "vec") -> DataFrame:
    """Feature columns, or one array column, as an ML vector."""
    if isinstance(features, str):
        return df.where(F.col(features).isNotNull()).withColumn(out, array_to_vector(F.col(features).cast("array<double>")))
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip").transform(df)


def scaled_vector(df: DataFrame, features, train: DataFrame | None = None, out: str = "scaled") -> DataFrame:
    """Vectors with mean 0 and deviation 1, both taken from the training rows."""
    fitted = StandardScaler(inputCol="vec", outputCol=out, withMean=True, withStd=True).fit(
        as_vector(train if train is not None else df, features)
    )
    return fitted.transform(as_vector(df, features)).drop("vec")


class Components:
    """Fitted principal components with a fixed sign: the largest loading is positive."""

    def __init__(self, model, keep: int, vector: str, total: float) -> None:
        matrix = model.pc.toArray()[:, :keep]
        flip = np.sign(matrix[np.abs(matrix).argmax(axis=0), np.arange(keep)])
        self.signs = [float(s) if s else 1.0 for s in flip]
        self.matrix = matrix * np.array(self.signs)
        self.share = [float(v) for v in model.explainedVariance.toArray()[:keep]]
        self.variance = [s * total for s in self.share]
        self.model, self.keep, self.vector = model, keep, vector

    def scores(self, df: DataFrame) -> DataFrame:
        """Adds ``pc1``, ``pc2``, ... for vectors centred like the training rows."""
        out = self.model.transform(df).withColumn("__pc", vector_to_array("__pca"))
        return out.withColumns(
            {f"pc{i + 1}": F.col("__pc")[i] * s for i, s in enumerate(self.signs)}
        ).drop("__pca", "__pc")

    def loadings(self, spark, names: Sequence[str]) -> DataFrame:
        """Component entries times the root of the component's variance."""
        rows = [
            (str(n), i + 1, float(self.matrix[j, i] * np.sqrt(self.variance[i])))
            for j, n in enumerate(names) for i in range(self.keep)
        ]
        return spark.createDataFrame(rows, "feature string, component int, loading double")


def pca(df: DataFrame, vector: str = "scaled", k: int | None = None, share: float | None = None) -> Components:
    """A number of components, or as many as explain a share of the variance.

    ``df`` holds centred vectors (``scaled_vector``), since the projection does
    not centre by itself.
    """
    width = len(df.select(vector).first()[0])
    model = PCA(k=width if share is not None else k, inputCol=vector, outputCol="__pca").fit(df)
    keep = k
    if share is not None:
        keep = int(np.searchsorted(np.cumsum(model.explainedVariance.toArray()), share) + 1)
        keep = min(keep, width)
    squares = F.aggregate(vector_to_array(vector), F.lit(0.0), lambda total, x: total + x * x)
    row = df.where(F.col(vector).isNotNull()).agg(F.sum(squares), F.count(F.lit(1))).first()
    return Components(model, keep, vector, row[0] / max(row[1] - 1, 1))


def kmeans(df: DataFrame, k: int, vector: str = "scaled", restarts: int = 10, seed: int = 42, rounds: int = 300) -> Model:
    """Best of several starts by within-cluster cost, all starts fitted in the same passes."""
    rows = vectors(df, vector)
    found = best_of(fit_many(rows.df, [k], restarts, seed, rounds))
    rows.drop()
    return found[k]


def cluster_labels(model: Model, df: DataFrame, out: str = "cluster", vector: str = "scaled") -> DataFrame:
    """Labels numbered by the clusters' centres, so that reruns agree."""
    centres = [tuple(map(float, c)) for c in model.clusterCenters()]
    place = {old: new for new, old in enumerate(sorted(range(len(centres)), key=lambda i: centres[i]))}
    pairs = [F.lit(v) for kv in place.items() for v in kv]
    return model.transform(df, vector, out).withColumn(out, F.create_map(*pairs)[F.col(out)])


def entity_cluster(labelled: DataFrame, entity: str, out: str = "cluster") -> DataFrame:
    """Most common cluster of an entity's rows."""
    return entity_mode(labelled, entity, out)


def silhouette(model: Model, df: DataFrame, vector: str = "scaled") -> float | None:
    """Mean silhouette on squared distances, which needs two passes and no pairs."""
    rows = vectors(df, vector)
    found = silhouettes(rows.df, [model])
    rows.drop()
    return found[0]


def silhouette_sweep(
    train: DataFrame, ks: Sequence[int], vector: str = "scaled", test: DataFrame | None = None, restarts: int = 10,
    seed: int = 42,
) -> DataFrame:
    """Silhouette per number of clusters, on the training rows and optional test rows.

    All numbers and restarts are fitted in the same passes, so the sweep takes as
    many jobs as its slowest model has rounds.
    """
    rows = vectors(train, vector)
    best = best_of(fit_many(rows.df, list(ks), restarts, seed))
    models = [best[k] for k in ks]
    found = [silhouettes(rows.df, models), [None] * len(models)]
    rows.drop()
    if test is not None:
        others = vectors(test, vector)
        found[1] = silhouettes(others.df, models)
        others.drop()
    table = [(k, a, b) for k, a, b in zip(ks, *found, strict=True)]
    return train.sparkSession.createDataFrame(table, "k int, train_silhouette double, test_silhouette double")


def pc_regression(train: DataFrame, test: DataFrame, y: str, components: Sequence[str] = ("pc1", "pc2")) -> tuple[Fit, DataFrame]:
    """Least squares on components with train and test R2 and test error."""
    fit = ols(train, y, list(components))
    value = F.lit(float(fit.coef[0]))
    for t, b in zip(fit.terms[1:], fit.coef[1:], strict=True):
        value = value + F.col(t) * float(b)

    def scored(df: DataFrame, part: str) -> DataFrame:
        truth = F.col(y).cast("double")
        return df.dropna(subset=[y, *components]).select(truth.alias("y"), value.alias("f")).agg(
            F.avg(F.pow(F.col("y") - F.col("f"), F.lit(2.0))).alias("mse"), F.var_pop("y").alias("v")
        ).select(F.lit(part).alias("part"), (1.0 - ratio("mse", "v")).alias("r2"), F.sqrt("mse").alias("rmse"))

    return fit, scored(train, "train").unionByName(scored(test, "test"))
