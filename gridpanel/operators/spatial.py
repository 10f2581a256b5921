"""Neighbour statistics and radius exposure on panels."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gridpanel.functions.expressions import EARTH_RADIUS_KM, MILES_PER_KM, numeric_columns, quoted, ratio, zero_sum
from gridpanel.operators.clean import per_capita
from gridpanel.operators.joins import neighbor_values, panel_grid, unique_on
from gridpanel.operators.neighbors import within_distance
from gridpanel.operators.windows import yoy_change
from gridpanel.session import stored

HOW = ("weighted_avg", "avg", "median")
SIDES = 16  # sides up to which a polygon travels whole to the cells of its box
CARRIED = 1 << 16  # sides times cells up to which one of more sides does, too
BLOCK_POINTS, BLOCK_SIDES = 1024, 2048  # of a cell, that meet in one row
AT_ONCE = 1 << 16  # sides of pairs that are computed together


def _stat(value: Column, distance: Column, how: str) -> Column:
    """Aggregate over at most k neighbours; missing values carry no weight."""
    if how == "avg":
        return F.avg(value)
    if how == "median":
        return F.median(value)
    known = value.isNotNull()
    at_zero = F.avg(F.when(distance == 0, value))
    weight = F.when(known, F.try_divide(F.lit(1.0), distance))
    return F.coalesce(at_zero, F.try_divide(F.sum(F.try_divide(value, distance)), F.sum(weight)))


def neighbor_stat(
    panel: DataFrame,
    edges: DataFrame,
    entity: str,
    time: str,
    values: Sequence[str],
    k: int = 5,
    how: str = "weighted_avg",
    extra: Sequence[str] = (),
    neighbor: str = "neighbor",
    salts: int = 0,
) -> DataFrame:
    """Per (entity, time, extra) the statistic of the k nearest neighbours' values.

    All value columns go through one join and one group-by. Groups hold at most
    k rows, so the exact median is safe.
    """
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}")
    near = edges.where(F.col("rank") <= k).select(entity, neighbor, "distance")
    rows = neighbor_values(panel, near, entity, time, values, extra, neighbor, salts)
    return rows.groupBy(entity, time, *extra).agg(*[
        _stat(F.col(quoted(v)).cast("double"), F.col("distance"), how).alias(v) for v in values
    ])


def blend(own: Column, around: Column, self_weight: float) -> Column:
    """w * own + (1 - w) * neighbours, or the neighbours alone where own is missing."""
    if not self_weight or self_weight <= 0:
        return around
    mixed = own * self_weight + around * max(0.0, 1.0 - self_weight)
    return F.when(own.isNull(), around).otherwise(mixed)


def spatial_fill(
    panel: DataFrame,
    edges: DataFrame,
    entity: str,
    time: str,
    values: Sequence[str] | None = None,
    mode: str = "new_col",
    how: str = "weighted_avg",
    k: int = 5,
    self_weight: float = 0.0,
    extra: Sequence[str] = (),
    neighbor: str = "neighbor",
    parity: bool = False,
    check: bool = True,
    salts: int = 0,
) -> DataFrame:
    """Add ``{col}_spatial_{how}_{k}`` columns, or fill only the missing values.

    The panel is read twice, for its own rows and as the neighbours' values.
    Hand in a stored or checkpointed one where it is costly to derive.
    ``parity`` gives 0 instead of NULL for a weighted average without any
    neighbour value. ``check`` makes the query fail where the panel repeats a key.
    """
    if mode not in ("new_col", "fill_na"):
        raise ValueError("mode must be 'new_col' or 'fill_na'")
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}")
    if not 1 <= k <= 10:
        raise ValueError("k must be between 1 and 10")
    keys = [entity, time, *extra]
    values = list(values) if values is not None else numeric_columns(panel, keys)
    if check:
        panel = unique_on(panel, keys, "panel")
    stats = neighbor_stat(panel, edges, entity, time, values, k, how, extra, neighbor, salts)
    stats = stats.withColumnsRenamed({v: f"__s{i}" for i, v in enumerate(values)})
    out = panel.join(stats, keys, "left")
    added = {}
    for i, v in enumerate(values):
        around = F.col(f"__s{i}")
        if how == "weighted_avg":
            if parity:
                around = F.coalesce(around, F.lit(0.0))
            around = blend(F.col(quoted(v)).cast("double"), around, self_weight)
        if mode == "new_col":
            added[f"{v}_spatial_{how}_{k}"] = around
        else:
            added[v] = F.coalesce(F.col(quoted(v)).cast("double"), around)
    return out.withColumns(added).drop(*[f"__s{i}" for i in range(len(values))])


def spatial_then_yoy(
    panel: DataFrame,
    edges: DataFrame,
    entity: str,
    time: str,
    values: Sequence[str] | None = None,
    extra: Sequence[str] = (),
    hot: bool = True,
    **fill,
) -> DataFrame:
    """Neighbour columns, then the change to the previous row of the base columns."""
    if values is None:
        values = [
            c for c in numeric_columns(panel, [entity, time, *extra])
            if not c.endswith("_yoy_change") and "_spatial_" not in c
        ]
    filled = spatial_fill(panel, edges, entity, time, values, extra=extra, **fill)
    return yoy_change(filled, entity, time, values, extra, hot=hot)


def radius_overlap(
    cells: DataFrame, miles: float, entity: str, cell: str, lat: str = "lat", lon: str = "lon",
    area: str = "area", land_share: str = "land_share", neighbor: str = "neighbor",
) -> DataFrame:
    """Area of every neighbour that lies within ``miles`` of an entity.

    Entities are sets of area cells; a neighbour's cell counts once when it is
    near any cell of the target, so cells of one entity at one place ask once.
    The entity itself is left out.
    """
    owned = cells.select(entity, cell, lat, lon, area, land_share)
    asked = owned.select(F.col(entity).alias("__t"), lat, lon).distinct()
    offered = owned.select(
        F.struct(F.col(entity).alias("e"), F.col(cell).alias("c"), F.col(area).alias("a"),
                 F.col(land_share).alias("s")).alias("__n"), lat, lon,
    )
    pairs = within_distance(asked, offered, miles, "__t", "__n", lat, lon)
    near = pairs.select(
        F.col("__t").alias(entity), F.col("__n.e").alias(neighbor),
        F.col("__n.c").alias("__c"), F.col("__n.a").alias("__a"), F.col("__n.s").alias("__s"),
    ).where(F.col(entity) != F.col(neighbor)).distinct()
    whole = cells.groupBy(F.col(entity).alias(neighbor)).agg(
        F.sum(area).alias("neighbor_area"),
        F.sum(F.col(area) * F.col(land_share)).alias("neighbor_land_area"),
    )
    overlap = near.groupBy(entity, neighbor).agg(
        F.sum("__a").alias("overlap_area"),
        F.sum(F.col("__a") * F.col("__s")).alias("effective_land_overlap"),
    )
    return overlap.join(whole, neighbor).select(
        entity, neighbor, "neighbor_area",
        ratio("neighbor_land_area", "neighbor_area").alias("neighbor_land_share"),
        "neighbor_land_area", "overlap_area", "effective_land_overlap",
    )


def equal_area(df: DataFrame, lat: str = "lat", lon: str = "lon", x: str = "x", y: str = "y",
               parallels: tuple[float, float] = (29.5, 45.5), origin: tuple[float, float] = (23.0, -96.0)) -> DataFrame:
    """Add plane coordinates in miles in which areas on the sphere are kept (the conic projection of Albers)."""
    first, second, middle = (math.radians(v) for v in (*parallels, origin[0]))
    n = (math.sin(first) + math.sin(second)) / 2
    c = math.cos(first) ** 2 + 2 * n * math.sin(first)
    size = EARTH_RADIUS_KM * MILES_PER_KM / n
    apex = size * math.sqrt(c - 2 * n * math.sin(middle))
    reach = F.sqrt(F.lit(c) - F.lit(2 * n) * F.sin(F.radians(F.col(quoted(lat)).cast("double")))) * size
    turn = F.radians(F.col(quoted(lon)).cast("double") - origin[1]) * n
    return df.withColumns({x: reach * F.sin(turn), y: F.lit(apex) - reach * F.cos(turn)})


def _ring_edges(vertices: DataFrame, region: str, x: str, y: str) -> DataFrame:
    """One row per side (__px, __py) to (__qx, __qy) of every ring; the last vertex meets the first."""
    v = vertices.selectExpr(f"`{region}` as __g", "ring as __ring", "point as __p",
                            f"cast(`{x}` as double) as __px", f"cast(`{y}` as double) as __py").where("__g is not null")
    # A vertex starts the side of its number and ends the one before.
    ends = v.withColumn("__k", F.explode(F.array(F.lit(0), F.lit(1))))
    at = lambda k, c: F.max(F.when(F.col("__k") == k, F.col(c)))
    sides = ends.groupBy("__g", "__ring", (F.col("__p") - F.col("__k")).alias("__p")).agg(
        at(0, "__px").alias("__px"), at(0, "__py").alias("__py"), at(1, "__px").alias("__qx"), at(1, "__py").alias("__qy"))
    spot = F.struct("__px", "__py")
    whole = v.groupBy("__g", "__ring").agg(
        F.max_by(spot, "__p").alias("__last"), F.min_by(spot, "__p").alias("__first"),
        (F.count(F.col("__px") + F.col("__py")) == F.max("__p") - F.min("__p") + 1).alias("__ok"))
    # A missing vertex would open the ring and change its area unseen.
    closing = whole.select(
        "__g", "__ring", F.when(F.col("__ok"), F.col("__last.__px")).otherwise(
            F.raise_error(F.concat(F.lit("a ring has gaps or repeated vertex numbers: "), F.col("__g").cast("string")))).alias("__px"),
        F.col("__last.__py").alias("__py"), F.col("__first.__px").alias("__qx"), F.col("__first.__py").alias("__qy"))
    return sides.where("__px is not null and __qx is not null").drop("__p").unionByName(closing)


def _shared_areas(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray, r: float) -> np.ndarray:
    """Signed area of a disc round the origin between each side a to b and the centre, the arc where the side lies outside."""
    dx, dy = bx - ax, by - ay
    dd, ad = dx * dx + dy * dy, ax * dx + ay * dy
    inside = ad * ad - dd * (ax * ax + ay * ay - r * r)
    dd = np.where(dd > 0, dd, 1.0)
    root = np.sqrt(np.maximum(inside, 0.0))
    enter, leave = np.maximum((-ad - root) / dd, 0.0), np.minimum((-ad + root) / dd, 1.0)
    angle = lambda px, py, qx, qy: np.arctan2(px * qy - py * qx, px * qx + py * qy)
    out = np.empty(len(ax))
    cut = (inside > 0) & (enter < leave)
    far = ~cut
    out[far] = r * r * angle(ax[far], ay[far], bx[far], by[far])
    ax, ay, bx, by, dx, dy, enter, leave = (v[cut] for v in (ax, ay, bx, by, dx, dy, enter, leave))
    ux, uy, vx, vy = ax + enter * dx, ay + enter * dy, ax + leave * dx, ay + leave * dy
    # A side that begins, or ends, within the disc has no arc there.
    arcs = np.zeros(len(ax))
    for at, p in ((np.flatnonzero(enter > 0), (ax, ay, ux, uy)), (np.flatnonzero(leave < 1), (vx, vy, bx, by))):
        arcs[at] += angle(*(v[at] for v in p))
    out[cut] = r * r * arcs + ux * vy - uy * vx
    return out / 2


def _runs(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places begin, begin + 1, ... of every run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - lengths), lengths)


def _items(lists) -> tuple[pa.StructArray, np.ndarray]:
    """The items of a column of lists and where each list begins."""
    return lists.flatten(), np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)


def _met(points: pa.StructArray, polygons: pa.StructArray, r: float, cx: int, cy: int):
    """Row places and shared area of the points and polygons of a cell that meet there."""
    numbers = lambda items, c: items.field(c).to_numpy(zero_copy_only=False).astype(float)
    x, y = numbers(points, "__x"), numbers(points, "__y")
    x0, x1, y0, y1 = (numbers(polygons, c) for c in ("__x0", "__x1", "__y0", "__y1"))
    sides, begins = _items(polygons.field("__sides"))
    ring = sides.field("__ring").to_numpy(zero_copy_only=False)
    px, py, qx, qy = (numbers(sides, c) for c in ("__px", "__py", "__qx", "__qy"))
    counts = np.diff(begins)
    step = max(1, AT_ONCE // max(1, len(x0)))
    for low in range(0, len(x), step):
        xs, ys = x[low:low + step, None], y[low:low + step, None]
        # Discs and boxes meet in the cell of the south-west corner of what they share.
        near = (np.floor(np.maximum(xs - r, x0) / (2 * r)) == cx) & (np.floor(np.maximum(ys - r, y0) / (2 * r)) == cy)
        near &= np.maximum(np.maximum(x0 - xs, xs - x1), 0.0) ** 2 + np.maximum(np.maximum(y0 - ys, ys - y1), 0.0) ** 2 < r * r
        i, j = np.nonzero(near)
        if not len(i):
            continue
        i += low
        upto = np.cumsum(counts[j])
        cuts = np.unique(np.r_[0, np.searchsorted(upto, np.arange(AT_ONCE, upto[-1], AT_ONCE)), len(i)])
        for first, last in zip(cuts[:-1], cuts[1:]):
            who, which = i[first:last], j[first:last]
            n = counts[which]
            at, own = _runs(begins[which], n), np.repeat(np.arange(len(who)), n)
            sx, sy = x[who][own], y[who][own]
            areas = _shared_areas(px[at] - sx, py[at] - sy, qx[at] - sx, qy[at] - sy, r)
            rings = ring[at]
            new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (rings[1:] != rings[:-1])])
            whole = np.abs(np.add.reduceat(areas, new))
            yield who, which, np.bincount(own[new], np.where(rings[new] == 0, whole, -whole), len(who))


def _blocks(df: DataFrame, sizes: DataFrame, most: int, key: Sequence[str], item: Sequence[str], name: str) -> DataFrame:
    """(__cx, __cy, name): the items of every cell in lists of about ``most`` in size, dealt by a hash of their key; sizes are (__cx, __cy, __n)."""
    cell = ["__cx", "__cy"]
    parts = sizes.groupBy(*cell).agg(F.ceil(F.sum("__n") / most).alias("__parts"))
    dealt = df.join(parts, cell).withColumn("__block", F.pmod(F.xxhash64(*key), F.col("__parts")))
    return dealt.groupBy(*cell, "__block").agg(F.collect_list(F.struct(*item)).alias(name)).drop("__block")


def disc_overlap(
    points: DataFrame, vertices: DataFrame, radius: float, entity: str, region: str = "id",
    x: str = "x", y: str = "y", same: bool = False,
) -> DataFrame:
    """Exact area that the disc around each point shares with each polygon: entity, region, region_area, overlap_area.

    ``vertices`` has a row per vertex (region, ring, point, x, y) as ``explode_features``
    gives it: ring 0 is the outline, the others are holes, points are numbered without
    gaps, in either sense; a ring need not repeat its first vertex. Coordinates are
    plane, in the unit of ``radius`` (see ``equal_area``). Only pairs with a common
    area are returned. Points without coordinates have none, repeated rows count once,
    an entity with several points gets a row for each. A ring with a gap is an error.
    With ``same`` the region called like the entity is left out.

    Discs meet the boxes of polygons in cells of the disc's width, each pair in one
    cell only. A side adds the area between itself, or the arc where it lies outside,
    and the centre, signed. Polygons travel whole to their cells, where they meet the
    points in blocks, so pairs are neither moved nor grouped; adaptive execution
    splits hot cells. Those of too many sides for that (``SIDES``, ``CARRIED``) are
    joined to their pairs side by side and summed on the map side, so a polygon of
    very many vertices is in no single task.
    """
    if not radius > 0:
        raise ValueError("the radius must be positive")
    r, side = f"{float(radius)!r}D", f"{2.0 * radius!r}D"
    edges = stored(_ring_edges(vertices, region, x, y))
    spots = points.selectExpr(f"`{entity}` as __e", f"cast(`{x}` as double) as __x", f"cast(`{y}` as double) as __y").dropna().distinct()
    outline = lambda f, c: f(F.when(F.col("__ring") == 0, F.col(c)))
    part = F.when(F.col("__ring") == 0, F.col("__s")).otherwise(-F.col("__s"))
    rings = edges.groupBy("__g", "__ring").agg(
        outline(F.min, "__px").alias("__x0"), outline(F.max, "__px").alias("__x1"), outline(F.min, "__py").alias("__y0"),
        outline(F.max, "__py").alias("__y1"), F.abs(F.sum(F.expr("(__px + __qx) * (__qy - __py) / 2D"))).alias("__s"),
        F.count(F.lit(1)).alias("__n"))
    place = lambda c: f"cast(floor(({c}) / {side}) as bigint)"
    across = lambda low, high: f"({place(high)} - {place(low)} + 1)"
    regions = rings.groupBy("__g").agg(
        *[F.max(c).alias(c) for c in ("__x0", "__x1", "__y0", "__y1")], F.sum(part).alias("__area"), F.sum("__n").alias("__n"),
    ).where("__x0 is not null").withColumn("__whole", F.expr(
        f"__n <= {SIDES} or __n * cast({across('__x0', '__x1')} as double) * {across('__y0', '__y1')} <= {CARRIED}"))
    regions = stored(regions)

    def cells(df: DataFrame, west: str, east: str, south: str, north: str) -> DataFrame:
        out = df.selectExpr("*", f"explode(sequence({place(west)}, {place(east)})) as __cx")
        return out.selectExpr("*", f"explode(sequence({place(south)}, {place(north)})) as __cy")

    asked = cells(spots, f"__x - {r}", f"__x + {r}", f"__y - {r}", f"__y + {r}")
    near = lambda chosen: cells(regions.where(chosen).drop("__whole"), "__x0", "__x1", "__y0", "__y1")
    sides = F.sort_array(F.collect_list(F.struct("__ring", "__px", "__py", "__qx", "__qy"))).alias("__sides")
    spot, polygon = ["__e", "__x", "__y"], ["__g", "__area", "__x0", "__x1", "__y0", "__y1", "__sides"]
    polygons = near("__whole").join(edges.groupBy("__g").agg(sides), "__g")
    here = _blocks(asked, asked.withColumn("__n", F.lit(1)), BLOCK_POINTS, spot, spot, "__points").join(
        _blocks(polygons, near("__whole"), BLOCK_SIDES, ["__g"], polygon, "__polygons"), ["__cx", "__cy"])

    def meet(batches):
        for batch in batches:
            (asking, asking_at), (offered, offered_at) = _items(batch.column("__points")), _items(batch.column("__polygons"))
            for k, (cx, cy) in enumerate(zip(batch.column("__cx").to_pylist(), batch.column("__cy").to_pylist())):
                own, around = asking[asking_at[k]:asking_at[k + 1]], offered[offered_at[k]:offered_at[k + 1]]
                e, g, area = own.field("__e"), around.field("__g"), around.field("__area")
                for who, which, shared in _met(own, around, float(radius), cx, cy):
                    who, which = pa.array(who), pa.array(which)
                    yield pa.RecordBatch.from_arrays([e.take(who), g.take(which), area.take(which), pa.array(shared)], found.names)

    found = StructType([StructField("__e", spots.schema["__e"].dataType), StructField("__g", edges.schema["__g"].dataType)]).add(
        "__area", "double").add("overlap_area", "double")
    shared = here.mapInArrow(meet, found)
    if regions.where("not __whole").limit(1).count():
        shared = shared.unionByName(_by_side(asked, near("not __whole"), edges, r, side, part))
    if same:
        shared = shared.where("not (__e <=> __g)")
    # Rounding leaves about 1e-16 of the disc where a polygon only touches it.
    return shared.where(F.col("overlap_area") > radius * radius * 1e-12).select(
        F.col("__e").alias(entity), F.col("__g").alias(region if region != entity else "neighbor"),
        F.col("__area").alias("region_area"), "overlap_area")


def _by_side(asked: DataFrame, regions: DataFrame, edges: DataFrame, r: str, side: str, part: Column) -> DataFrame:
    """``disc_overlap`` of polygons of many sides: a row per pair and side, summed on the map side."""
    pairs = asked.join(regions, ["__cx", "__cy"]).where(
        f"__cx = floor(greatest(__x - {r}, __x0) / {side}) and __cy = floor(greatest(__y - {r}, __y0) / {side}) and "
        f"pow(greatest(__x0 - __x, __x - __x1, 0D), 2) + pow(greatest(__y0 - __y, __y - __y1, 0D), 2) < {r} * {r}")
    sides = pairs.select("__e", "__x", "__y", "__g", "__area").join(edges, "__g").selectExpr(
        "__e", "__x", "__y", "__g", "__area", "__ring", "__px - __x as ax", "__py - __y as ay", "__qx - __x as bx", "__qy - __y as by",
    ).selectExpr("*", "bx - ax as dx", "by - ay as dy").selectExpr("*", "dx * dx + dy * dy as dd", "ax * dx + ay * dy as ad").where("dd > 0").selectExpr(
        "*", f"ad * ad - dd * (ax * ax + ay * ay - {r} * {r}) as inside",
    ).selectExpr(
        "*", "greatest((-ad - sqrt(greatest(inside, 0D))) / dd, 0D) as enter", "least((-ad + sqrt(greatest(inside, 0D))) / dd, 1D) as leave",
    ).selectExpr("*", "ax + enter * dx as ux", "ay + enter * dy as uy", "ax + leave * dx as vx", "ay + leave * dy as vy")
    angle = lambda p, q: f"atan2({p}x * {q}y - {p}y * {q}x, {p}x * {q}x + {p}y * {q}y)"
    signed = (f"case when inside > 0 and enter < leave then {r} * {r} * ({angle('a', 'u')} + {angle('v', 'b')}) + ux * vy - uy * vx"
              f" else {r} * {r} * {angle('a', 'b')} end / 2D")
    pair = ["__e", "__x", "__y", "__g", "__area"]
    shared = sides.groupBy(*pair, "__ring").agg(F.abs(F.sum(F.expr(signed))).alias("__s"))
    return shared.groupBy(*pair).agg(F.sum(part).alias("overlap_area")).select("__e", "__g", "__area", "overlap_area")


def nearby_density(
    overlap: DataFrame, fact: DataFrame, entities: DataFrame, entity: str, time: str, value: str,
    first: int, last: int, neighbor: str = "neighbor", salts: int = 0,
) -> DataFrame:
    """Neighbours' counts, spread over their land and cut to the radius.

    The target's own count is not part of it. Every entity and period of the
    grid appears, with NULLs where no neighbour has data.
    """
    rows = neighbor_values(fact.where(F.col(time).isNotNull()), overlap, entity, time, [value],
                           neighbor=neighbor, salts=salts)
    contribution = ratio(value, "neighbor_land_area") * F.col("effective_land_overlap")
    near = rows.groupBy(entity, time).agg(
        zero_sum(contribution).cast("double").alias("nearby_landadj"),
        F.count_distinct(F.col(neighbor)).alias("contributing_entities"),
        F.sum("overlap_area").alias("raw_overlap_sqmi"),
        F.sum("effective_land_overlap").alias("effective_land_overlap_sqmi"),
    )
    grid = panel_grid(entities.select(entity).distinct(), time, first, last)
    per = ratio("nearby_landadj", "effective_land_overlap_sqmi")
    return grid.join(near, [entity, time], "left").withColumns(
        {"nearby_per_sqmi": per, "nearby_per_100_sqmi": per * 100.0}
    )


def density_features(
    panel: DataFrame, entities: DataFrame, entity: str, time: str, value: str, area: str,
    first: int, last: int,
) -> DataFrame:
    """Count per square mile and per 100 square miles on the full grid."""
    grid = panel_grid(entities.select(entity, area), time, first, last)
    out = grid.join(panel, [entity, time], "left")
    out = per_capita(out, [value], area, suffix="per_sqmi", keep=True)
    return out.withColumn(f"{value}_per_100_sqmi", F.col(f"{value}_per_sqmi") * 100.0).drop(area)
