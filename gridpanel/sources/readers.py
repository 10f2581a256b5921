"""Reading raw files and stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpanel.functions.expressions import nan_to_null, quoted


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: str | None = None, sep: str = ",",
    encoding: str = "UTF-8", header: bool = True,
) -> DataFrame:
    """Comma, pipe or tab files. Without a schema every column is text, so ids
    keep their leading zeros and no job runs to guess types.

    A schema names the columns wanted, any of them and in any order, and their
    types. With a header they are found by name, without one by place. A value
    that is not of its type is NULL, and so is a NaN.
    """
    reader = spark.read.option("sep", sep).option("encoding", encoding).option("header", header)
    if not schema:
        return reader.csv(path)
    wanted = T.StructType.fromDDL(schema).fields
    raw = reader.csv(path)
    if not header:
        raw = raw.toDF(*[f.name for f in wanted], *raw.columns[len(wanted):])
    return raw.select(*[_typed(F.col(quoted(f.name)), f.dataType).alias(f.name) for f in wanted])


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    value = F.trim(text).try_cast(kind)
    return nan_to_null(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def scan_filtered(df: DataFrame, columns: Sequence[str], predicate: Column | str) -> DataFrame:
    """Rows of a scan that meet a predicate, reduced to some columns.

    Both reach the file reader: Parquet gets row-group filters and a short read
    schema, CSV drops rows while parsing.
    """
    return df.where(predicate).select(*[F.col(quoted(c)) for c in columns])


def read_lines(spark: SparkSession, path: str | list[str], column: str = "raw_line") -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", column)


Slice = tuple[int, int, int | None, str]


def parse_fixed_width(lines: DataFrame, slices: Mapping[str, Slice], column: str = "raw_line") -> DataFrame:
    """Fields split at white space, then character slices of a field.

    A slice is (field, start, length, type). A negative start counts from the
    end, as in ``text[-8:]``; length None takes the rest of the field.
    """
    fields = F.split(F.trim(F.col(column)), r"\s+")
    out = []
    for name, (place, start, length, kind) in slices.items():
        text = F.get(fields, F.lit(place))
        if start < 0:
            # Text shorter than the slice is taken whole.
            text = F.when(F.length(text) <= -start, text).otherwise(F.substring(text, start, -start))
            text = F.substring(text, 1, length) if length else text
        else:
            text = F.substring(text, start + 1, length if length is not None else 1 << 30)
        out.append((text if kind == "string" else text.try_cast(kind)).alias(name))
    return lines.select(*out)


def read_fixed_width(spark: SparkSession, path: str | list[str], slices: Mapping[str, Slice]) -> DataFrame:
    return parse_fixed_width(read_lines(spark, path), slices)


def load_table(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    """A whole stored table, NaN as NULL; columns not used later are pruned from the scan."""
    table = spark.table(f"{schema}.{name}" if schema else name)
    floats = [f.name for f in table.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return table.withColumns({c: nan_to_null(F.col(quoted(c))) for c in floats}) if floats else table


def _header_line(spark: SparkSession, path: str, encoding: str) -> str:
    """The first line of a file that is not blank, read through the store's own client without a job."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    if codec is not None:
        stream = codec.createInputStream(stream)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
    try:
        line = lines.readLine()
        while line is not None and not line.strip():
            line = lines.readLine()
        return line or ""
    finally:
        lines.close()


def read_yearly_files(
    spark: SparkSession, paths: Mapping[str, Sequence[str]] | str, year_pattern: str, century: int = 0,
    names: Mapping[str, str] | None = None, sep: str = ",", encoding: str = "UTF-8",
) -> DataFrame:
    """One file per period, stacked, the period taken from the file's path.

    ``paths`` is a glob, or several sets of paths by any name. The layout may
    drift: the first line of every file is read from the driver without a Spark
    job, and the files that share one are one scan, so jobs and scans are as many
    as layouts. Headers are lower-cased and renamed by ``names`` before the scans
    are stacked by column name; a column that a file lacks is NULL. Empty and
    blank files are passed over; without any other file it is an error.
    """
    given = [paths] if isinstance(paths, str) else [p for group in paths.values() for p in group]
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(given)
    files = sorted(r[0] for r in found.where("length > 0").select("path").collect())
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for line, file in zip(pool.map(lambda f: _header_line(spark, f, encoding), files), files, strict=True):
            if line:
                groups.setdefault(line, []).append(file)
    if not groups:
        raise ValueError(f"no file with a header among {given}")

    def one(group: Sequence[str]) -> DataFrame:
        raw = read_delimited(spark, list(group), None, sep, encoding)
        raw = raw.select(*[F.col(quoted(c)).alias(c.lower()) for c in raw.columns],
                         F.regexp_extract(F.col("_metadata.file_path"), year_pattern, 1).alias("__y"))
        raw = raw.withColumnsRenamed({k: v for k, v in (names or {}).items() if k in raw.columns})
        return raw.withColumn("year", F.col("__y").try_cast("int") + F.lit(century)).drop("__y")

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [one(g) for g in groups.values()])


FEATURE = "id string, geometry struct<type: string, coordinates: array<array<array<double>>>>"


def explode_features(features: DataFrame, column: str = "feature", recode: Mapping[str, str] | None = None) -> DataFrame:
    """Boundary features, one JSON text per row, to one row per vertex (id, ring, point, lon, lat)."""
    parsed = features.select(F.from_json(column, FEATURE).alias("f")).select(
        F.col("f.id").alias("id"), F.posexplode("f.geometry.coordinates").alias("ring", "pts")
    )
    points = parsed.select("id", "ring", F.posexplode("pts").alias("point", "xy"))
    out = points.select("id", "ring", "point", F.col("xy")[0].alias("lon"), F.col("xy")[1].alias("lat"))
    if recode:
        pairs = [F.lit(v) for kv in recode.items() for v in kv]
        out = out.withColumn("id", F.coalesce(F.create_map(*pairs)[F.col("id")], F.col("id")))
    return out


def bounding_boxes(vertices: DataFrame) -> DataFrame:
    return vertices.groupBy("id").agg(
        F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
        F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
        F.count(F.lit(1)).alias("n_vertices"),
    )


def lookup_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal dimension. It has as many rows as the code lists, so it may be broadcast."""
    return spark.createDataFrame(list(rows), schema)
