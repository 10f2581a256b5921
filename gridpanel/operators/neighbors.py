"""Nearest neighbours and radius pairs without all-pairs joins.

Points on the globe use a grid of halving latitude/longitude cells, which gives
exact results; vectors of any width have ``vector_neighbors``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, MapType, StructField, StructType

from gridpanel.functions.expressions import haversine_sql
from gridpanel.functions.fixed_values import EARTH_RADIUS_KM, MILES_PER_KM
from gridpanel.session import Stored

# A degree of latitude is at least this long, so a box drawn with it never
# misses a point of the circle it stands for.
MILES_PER_DEGREE = 69.0
_MOST_MILES = 69.2
_HALF_WAY = 12_451.0
EARTH_MILES = 2.0 * EARTH_RADIUS_KM * MILES_PER_KM  # twice the radius
LEVELS = 20
CELL_PAIRS = 4_000_000  # pairs of one cell that a task tries; the points of a fuller cell are dealt to several
PAIR_BLOCK = 8192  # points of a block of the full table of pairs
PAIR_TASKS = 10_000
PAIR_ROWS = 65_536  # pairs that a task makes at a time
HELD_ROWS = 250_000  # candidates that a task holds before it drops all but the nearest


def _cell(lat: str, lon: str, level: str) -> list[str]:
    """Row and column of the cell at a level: 180/2^level by 360/2^level degrees."""
    n = f"pow(2.0D, {level})"
    return [
        f"cast(least(floor(({lat} + 90.0D) / 180.0D * {n}), {n} - 1) as bigint)",
        f"cast(pmod(floor(({lon} + 180.0D) / 360.0D * {n}), {n}) as bigint)",
    ]


def _boxes(df: DataFrame, miles: str, level: str) -> DataFrame:
    """One row per cell (__r, __c) that may hold points within ``miles`` of (__la, __lo).

    The span of longitudes is the exact one of a circle on the sphere; a circle
    that reaches a pole spans all of them.
    """
    spans = df.selectExpr(
        "*", f"{miles} / {MILES_PER_DEGREE}D + 1e-9D as __dy", f"pow(2.0D, {level}) as __n"
    ).selectExpr(
        "*",
        "least(sin(radians(least(__dy, 90.0D))) / greatest(cos(radians(__la)), 1e-12D), 1.0D) as __reach",
    ).selectExpr(
        "*",
        "case when abs(__la) + __dy >= 90.0D or __reach >= 1.0D then 180.0D"
        " else degrees(asin(__reach)) + 1e-9D end as __dx",
    )
    row = "cast(greatest(least(floor((__la {} __dy + 90.0D) / 180.0D * __n), __n - 1), 0) as bigint)"
    west = "cast(floor((__lo - __dx + 180.0D) / 360.0D * __n) as bigint)"
    east = "cast(floor((__lo + __dx + 180.0D) / 360.0D * __n) as bigint)"
    rows = spans.selectExpr("*", f"explode(sequence({row.format('-')}, {row.format('+')})) as __r")
    cells = rows.selectExpr("*", f"explode(sequence({west}, least({east}, {west} + cast(__n as bigint) - 1))) as __x")
    return cells.selectExpr("*", "pmod(__x, cast(__n as bigint)) as __c").drop("__dy", "__dx", "__n", "__reach", "__x")


def within_distance(
    a: DataFrame,
    b: DataFrame,
    miles: float,
    a_id: str,
    b_id: str,
    lat: str = "lat",
    lon: str = "lon",
    same: bool = False,
) -> DataFrame:
    """Pairs (a_id, b_id, distance) at most ``miles`` apart.

    Cells are at least a quarter of ``miles`` high, so a point of ``a`` looks into a
    few dozen cells that hold little beyond the radius. Few bytes make many pairs, so
    cells are dealt to all tasks and the points of full cells to several of them.
    With ``same`` the two frames hold the same entities and self pairs are left out.
    """
    level = max(0, min(LEVELS, 2 + math.floor(math.log2(180.0 / (miles / MILES_PER_DEGREE + 1e-9)))))
    asked = a.selectExpr(
        f"`{a_id}` as __a", f"cast(`{lat}` as double) as __la", f"cast(`{lon}` as double) as __lo"
    ).dropna()
    asked = _boxes(asked, f"{float(miles)!r}D", f"{level}D")
    stored = b.selectExpr(
        f"`{b_id}` as __b", f"cast(`{lat}` as double) as __lb", f"cast(`{lon}` as double) as __ob"
    ).dropna()
    r, c = _cell("__lb", "__ob", f"{level}D")
    stored = stored.selectExpr("*", f"{r} as __r", f"{c} as __c")
    cell = ["__r", "__c"]
    load = asked.groupBy(cell).agg(F.count(F.lit(1)).alias("__na")).join(stored.groupBy(cell).agg(F.count(F.lit(1)).alias("__nb")), cell)
    full = load.selectExpr(*cell, f"ceil(__na / {CELL_PAIRS}D * __nb) as __s").where("__s > 1")
    asked = asked.join(full, cell, "left").selectExpr("*", "explode(sequence(0L, coalesce(__s, 1L) - 1L)) as __k").drop("__s")
    stored = stored.join(full, cell, "left").selectExpr("*", "pmod(xxhash64(__b, __lb, __ob), coalesce(__s, 1L)) as __k").drop("__s")
    parts = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = stored.repartition(parts, *cell, "__k").join(asked.repartition(parts, *cell, "__k"), [*cell, "__k"])
    if same:
        pairs = pairs.where("__a <> __b")
    left, right = (a_id, b_id) if a_id != b_id else (a_id, "neighbor")
    return (
        pairs.selectExpr(
            f"__a as `{left}`", f"__b as `{right}`", f"{haversine_sql('__la', '__lo', '__lb', '__ob')} as distance"
        )
        .where(F.col("distance") <= miles)
    )


def pair_distances(
    points: DataFrame, entity: str, miles: float | None = None, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """All ordered pairs, self excluded; with ``miles`` only those at most that far apart.

    The full table grows with the square of the points, what is moved for it much
    less: points are stored once in blocks, and a task makes the pairs of two blocks
    some thousand at a time. A pair with a point that has no place has no distance.
    """
    if miles is not None:
        return within_distance(points, points, miles, entity, entity, lat, lon, same=True)
    place = "radians(case when abs(cast(`{0}` as double)) < double('infinity') then cast(`{0}` as double) end)"
    known = points.selectExpr(f"`{entity}` as __i", f"{place.format(lat)} as __a", f"{place.format(lon)} as __o").where("__i is not null")
    n = known.count()
    blocks = max(1, min(16, -(-n // 1024)), -(-n // PAIR_BLOCK))
    packed = known.repartition(blocks).withColumn("__block", F.spark_partition_id())
    # Written once, so that both sides of every pair come from the same blocks.
    packed = Stored(packed.groupBy("__block").agg(F.collect_list(F.struct("__i", "__a", "__o")).alias("__p"))).df
    parts = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(blocks * blocks, PAIR_TASKS))

    def side(own: str, met: str, name: str) -> DataFrame:
        copied = packed.selectExpr(f"__block as {own}", f"__p as {name}", f"explode(sequence(0, {blocks - 1})) as {met}")
        return copied.repartition(parts, "__x", "__y")

    both = side("__x", "__y", "__l").hint("merge").join(side("__y", "__x", "__r"), ["__x", "__y"]).select("__l", "__r")
    made = both.mapInArrow(_pairs_of_blocks, _pair_schema(known))
    return made.where("__a <> __b").selectExpr(f"__a as `{entity}`", "__b as neighbor", "distance")


def _pair_schema(known: DataFrame) -> StructType:
    kind = known.schema["__i"].dataType
    return StructType([StructField("__a", kind), StructField("__b", kind), StructField("distance", DoubleType())])


def _pairs_of_blocks(batches):
    """Rows of two blocks to all their pairs, some thousand at a time."""
    for batch in batches:
        for row in range(batch.num_rows):
            left, right = (batch.column(n)[row].values for n in ("__l", "__r"))
            (ids, a, o), (ids2, a2, o2) = (
                (b.field("__i"), *(b.field(n).to_numpy(zero_copy_only=False) for n in ("__a", "__o"))) for b in (left, right))
            step, c, c2 = max(1, PAIR_ROWS // len(ids2)), np.cos(a), np.cos(a2)
            for i in range(0, len(ids), step):
                n = min(step, len(ids) - i)
                cut = slice(i, i + n)
                h = np.sin((a2 - a[cut, None]) * 0.5) ** 2 + c[cut, None] * c2 * np.sin((o2 - o[cut, None]) * 0.5) ** 2
                miles = np.arcsin(np.sqrt(np.minimum(h, 1.0))).ravel() * EARTH_MILES
                first = pa.array(np.repeat(np.arange(i, i + n, dtype=np.int32), len(ids2)))
                second = pa.array(np.tile(np.arange(len(ids2), dtype=np.int32), n))
                yield pa.RecordBatch.from_arrays([ids.take(first), ids2.take(second), pa.array(miles, from_pandas=True)], ["__a", "__b", "distance"])


def _nearest_in_task(k: int):
    """Of the candidates (__id, __nid, distance, __d) that pass through a task, those that may be among the k nearest of an id."""

    def cut(batches: list[pa.RecordBatch]) -> pa.Table:
        t = pa.Table.from_batches(batches).combine_chunks()
        ids = pc.dictionary_encode(t["__id"].combine_chunks()).indices.to_numpy()
        other = t["__nid"]
        ties = other.to_numpy() if pa.types.is_integer(other.type) else pc.rank(other, tiebreaker="dense").to_numpy()
        order = np.lexsort((ties, t["__d"].to_numpy(), ids))
        ids = ids[order]
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
        return t.take(order[place < k])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            n += len(batch)
            if n >= HELD_ROWS:
                kept = cut(held)
                held, n = kept.to_batches(), len(kept)
                if 2 * n > HELD_ROWS:
                    yield from held
                    held, n = [], 0
        if n:
            yield from cut(held).to_batches()

    return run


def knn_edges(
    points: DataFrame,
    entity: str,
    k: int = 10,
    lat: str = "lat",
    lon: str = "lon",
    levels: int = LEVELS,
) -> DataFrame:
    """The k nearest other points as edges (entity, neighbor, rank, distance).

    Exact, ties broken by id, and close to linear in the points:

    1. Points at one location are folded: only the k+1 lowest ids of a location
       can ever be among anybody's k nearest.
    2. Every location finds the smallest cell around it that holds k+1 points.
       The cell's extent bounds the distance of the k-th neighbour.
    3. Only the cells of that level inside the bound are searched. The next
       smaller cell holds at most k points, so few locations ask at any cell.
    4. Tasks drop what is beyond the k nearest they have seen, so no candidates
       are sorted or moved but k per point and task.
    """
    leaf = _cell("__la", "__lo", f"{levels}D")
    pts = points.selectExpr(
        f"`{entity}` as __id", f"cast(`{lat}` as double) as __la", f"cast(`{lon}` as double) as __lo"
    ).dropna().selectExpr("*", f"{leaf[0]} as __lr", f"{leaf[1]} as __lc")
    # Folding is done inside the leaf cell, so that the exchange it needs also
    # serves the counts per leaf and the join of points to their level.
    same_place = Window.partitionBy("__lr", "__lc", "__la", "__lo").orderBy("__id")
    kept = pts.withColumn("__rn", F.row_number().over(same_place)).where(F.col("__rn") <= k + 1).drop("__rn")
    leaves = kept.groupBy("__lr", "__lc").agg(F.count(F.lit(1)).alias("__n"))
    climbed = leaves.selectExpr("*", f"explode(sequence(0, {levels})) as __up").selectExpr(
        "*", "shiftright(__lr, __up) as __ar", "shiftright(__lc, __up) as __ac"
    )
    full = climbed.groupBy("__up", "__ar", "__ac").agg(F.sum("__n").alias("__m")).where(F.col("__m") >= k + 1)
    # With fewer than k+1 points in all no cell is full: the whole globe is searched.
    level = (
        climbed.join(full, ["__up", "__ar", "__ac"])
        .groupBy("__lr", "__lc").agg((F.lit(levels) - F.min("__up")).alias("__level"))
    )
    # A point's level bounds its reach: height plus width of its cell, the width
    # taken at the edge that is nearest to the equator.
    asked = pts.join(level, ["__lr", "__lc"], "left").selectExpr(
        "__id", "__la", "__lo", "coalesce(__level, 0) as __level",
        "180.0D / pow(2.0D, coalesce(__level, 0)) as __h",
    ).selectExpr("*", "floor((__la + 90.0D) / __h) * __h - 90.0D as __s").selectExpr(
        "__id", "__la", "__lo", "__level",
        f"case when __level = 0 then {_HALF_WAY}D else (__h + 2.0D * __h * cos(radians("
        f"case when __s <= 0 and __s + __h >= 0 then 0.0D else least(abs(__s), abs(__s + __h)) end)))"
        f" * {_MOST_MILES}D end as __miles",
    )
    # Few bytes make many candidates: whichever side is broadcast, the other one is dealt to all cores.
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = _boxes(asked.repartition(parts, "__id"), "__miles", "cast(__level as double)")
    offered = kept.repartition(parts, "__id").selectExpr(
        "__id as __nid", "__la as __lb", "__lo as __ob", "__lr", "__lc", f"explode(sequence(0, {levels})) as __level"
    ).selectExpr(
        "__nid", "__lb", "__ob", "__level", f"shiftright(__lr, {levels} - __level) as __r",
        f"shiftright(__lc, {levels} - __level) as __c",
    )
    # A cell that holds a large share of the points is a hot key of one side;
    # adaptive execution splits that partition.
    near = offered.join(cells, ["__level", "__r", "__c"]).where("__id <> __nid").selectExpr(
        "__id", "__nid", f"{haversine_sql('__la', '__lo', '__lb', '__ob')} as distance", "__miles"
    ).where("distance <= __miles").selectExpr("__id", "__nid", "distance", "round(distance, 9) as __d")
    if not isinstance(near.schema["__id"].dataType, (ArrayType, MapType, StructType)):  # Arrow orders plain values only
        near = near.mapInArrow(_nearest_in_task(k), near.schema)
    w = Window.partitionBy("__id").orderBy("__d", "__nid")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).selectExpr(
        f"__id as `{entity}`", "__nid as neighbor", "rank", "distance"
    )
