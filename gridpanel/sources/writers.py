"""Storing tables, archiving raw files and restoring them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.functions.expressions import quoted, ratio
from gridpanel.session import shared_folder
from gridpanel.sources.readers import read_delimited, read_lines


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the folder that driver and executors share."""
    return f"{shared_folder(spark).rstrip('/')}/gridpanel/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def save_table(
    df: DataFrame, name: str, schema: str | None = None, partition_by: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Replace a stored table; the database is created when it is missing.

    With a path the table's files live there and not in the warehouse folder.
    """
    if schema:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(schema)}")
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(f"{quoted(schema)}.{quoted(name)}" if schema else quoted(name))


def drop_tables(spark: SparkSession, names: Sequence[str], schema: str | None = None) -> None:
    for name in names:
        full = f"{quoted(schema)}.{quoted(name)}" if schema else quoted(name)
        spark.sql(f"DROP TABLE IF EXISTS {full}")


def folder_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Bytes and files below a path; the listing alone is read, not the content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("files"))


def archive(
    spark: SparkSession, sources: Sequence[tuple[str, str, str]], out: str, skip: Sequence[str] = ()
) -> DataFrame:
    """Raw files to zstd Parquet with all columns as text; returns the ledger.

    ``sources`` lists (name, path, kind), the kind being ``lines``, ``latin-1``
    for comma files in that encoding, or the separator of a delimited file.
    Names in ``skip`` are left out, such as big files whose filtered copy is
    archived. The ledger has the bytes before and after and the share saved.
    """
    rows = None
    for name, path, kind in sources:
        if name in skip:
            continue
        if kind == "lines":
            raw = read_lines(spark, path)
        elif kind == "latin-1":
            raw = read_delimited(spark, path, encoding="ISO-8859-1")
        else:
            raw = read_delimited(spark, path, sep=kind)
        target = f"{out.rstrip('/')}/{name}.parquet"
        raw.write.mode("overwrite").option("compression", "zstd").parquet(target)
        before = folder_bytes(spark, path).select(F.col("bytes").alias("orig_bytes"), F.lit(name).alias("file"))
        after = folder_bytes(spark, target).select(F.col("bytes").alias("pq_bytes"), F.lit(name).alias("file"))
        entry = before.join(after, "file")
        rows = entry if rows is None else rows.unionByName(entry)
    saved = ratio(F.col("orig_bytes") - F.col("pq_bytes"), "orig_bytes") * 100.0
    return rows.select("file", "orig_bytes", "pq_bytes", saved.alias("saved_pct"))


def restore(spark: SparkSession, path: str, out: str, sep: str = ",") -> None:
    """Archived Parquet back to text: lines as they were, or delimited with a header."""
    df = spark.read.parquet(path)
    if df.columns == ["raw_line"]:
        df.write.mode("overwrite").text(out)
    else:
        df.write.mode("overwrite").option("header", True).option("sep", sep).csv(out)
