"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins here are followed by group-bys on other keys, so a split of a hot
    # join key is worth the extra exchange it may cost.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Rows of whole texts go to Python in batches of some megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the operators count on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", name: str = "gridpanel") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="gridpanel-wh-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    It is ``spark.checkpoint.dir`` or the folder given to ``setCheckpointDir``.
    A local session without either gets a folder of its own; on a cluster that
    would lie on one machine, so there it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if named or context.getCheckpointDir():
        return named or context.getCheckpointDir()
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="gridpanel-ck-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's checkpoint folder and cut its lineage.

    The folder is shared, so the rows outlive a lost executor.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of ours on whatever store it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Stored:
    """A frame written to the shared folder as Parquet, and how to get rid of it.

    Unlike a checkpoint it keeps no partitioning, has a known size, so that Spark
    joins small ones by broadcast on its own, and can be deleted when a loop has
    moved on.
    """

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.folder = f"{shared_folder(self.spark).rstrip('/')}/gridpanel-{uuid.uuid4().hex}"
        df.write.parquet(self.folder)
        self.df = self.spark.read.schema(df.schema).parquet(self.folder)

    def drop(self) -> None:
        delete_folder(self.spark, self.folder)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again; the files stay for the session's user to clear."""
    return Stored(df).df
