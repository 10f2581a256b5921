"""Neighbours: exactness against brute force, and the edge rules of the statistics."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import close, rows
from gridpanel.functions import expressions as X
from gridpanel.operators import neighbors, spatial, vector_neighbors


def miles(a, b, c, d):
    p1, l1, p2, l2 = map(math.radians, (a, b, c, d))
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 2 * 6371.0088 * 0.621371192 * math.asin(min(1, math.sqrt(h)))


@pytest.fixture(scope="module")
def points():
    """Spread points, a dense third, a pile of copies and two across the date line."""
    rnd = random.Random(1)
    out = []
    for i in range(240):
        if i % 3 == 0:
            out.append((i, 30 + rnd.random() * 0.01, -100 + rnd.random() * 0.01))
        else:
            out.append((i, 25 + rnd.random() * 25, -125 + rnd.random() * 60))
    out += [(1000 + i, 30.0, -100.0) for i in range(25)]
    return [*out, (2000, -80.0, 179.95), (2001, -80.0, -179.95)]


def test_knn_is_exact(spark, points):
    df = spark.createDataFrame(points, "id int, lat double, lon double").repartition(8)
    got = {}
    for r in neighbors.knn_edges(df, "id", 6).collect():
        got.setdefault(r["id"], {})[r["rank"]] = r["neighbor"]
    for i, a, b in points:
        want = sorted((round(miles(a, b, c, d), 9), j) for j, c, d in points if j != i)[:6]
        assert [got[i][n] for n in range(1, 7)] == [j for _, j in want], i


def test_knn_with_few_points(spark):
    df = spark.createDataFrame([(1, 30.0, -100.0), (2, 31.0, -100.0), (3, None, 0.0)], "id int, lat double, lon double")
    assert [r[:2] for r in rows(neighbors.knn_edges(df, "id", 5))] == [(1, 2), (2, 1)]


def test_pairs_within(spark, points):
    df = spark.createDataFrame(points, "id int, lat double, lon double")
    got = {(r[0], r[1]) for r in neighbors.pair_distances(df, "id", 60.0).collect()}
    assert got == {(i, j) for i, a, b in points for j, c, d in points if i != j and miles(a, b, c, d) <= 60}


def test_all_pairs_without_a_radius(spark, points, monkeypatch):
    """Every ordered pair, far ones too; a point without a place has no distances."""
    monkeypatch.setattr(neighbors, "PAIR_BLOCK", 50)  # several blocks on small data
    df = spark.createDataFrame([*points, (5000, None, 1.0), (5001, float("nan"), 1.0), (None, 1.0, 1.0)], "id int, lat double, lon double")
    got = {(r[0], r[1]): r[2] for r in neighbors.pair_distances(df, "id").collect()}
    want = {(i, j): miles(a, b, c, d) for i, a, b in points for j, c, d in points if i != j}
    assert all(abs(got.pop(p) - far) < 1e-6 for p, far in want.items())
    ids = [p[0] for p in points]
    assert got == {p: None for j in (5000, 5001) for i in [*ids, 5000, 5001] if i != j for p in ((i, j), (j, i))}


@pytest.mark.parametrize("apart", ["id", "fold", None])
@pytest.mark.parametrize("kind", ["cloud", "ties"])
def test_vector_knn_is_exact(spark, apart, kind, monkeypatch):
    for name, value in (("BLOCK_ROWS", 20), ("SLAB_ROWS", 16), ("TASK_BLOCKS", 3)):  # several of each on small data
        monkeypatch.setattr(vector_neighbors, name, value)
    rnd = random.Random(2)
    draw = (lambda: rnd.gauss(0, 1)) if kind == "cloud" else (lambda: float(rnd.randrange(3)))
    data = [(f"n{i:03}", [draw() for _ in range(5)], i % 4) for i in range(150)]
    df = spark.createDataFrame([*data, ("none", None, 1)], "id string, vec array<double>, fold int")
    got = {}
    for r in vector_neighbors.knn_vectors(df, df, 5, apart=apart, pivots=6).collect():
        got.setdefault(r["id"], {})[r["rank"]] = r["neighbor"]
    assert sorted(got) == [i for i, _, _ in data]
    for i, q, f in data:
        pool = [(round(math.dist(q, p), 9), j) for j, p, g in data
                if apart is None or (apart == "id" and i != j) or (apart == "fold" and f != g)]
        assert [got[i][n] for n in range(1, 6)] == [j for _, j in sorted(pool)[:5]]


def test_vector_knn_with_few_points(spark):
    """Fewer eligible points than k: all of them; the same fold everywhere: none."""
    df = spark.createDataFrame([(i, [float(i)], i % 2) for i in range(4)], "id int, vec array<double>, fold int")
    got = vector_neighbors.knn_vectors(df, df, 9, apart="fold")
    assert sorted((r["id"], r["neighbor"]) for r in got.collect()) == [(i, j) for i in range(4) for j in range(4) if (i - j) % 2]
    assert vector_neighbors.knn_vectors(df.where("fold = 0"), df.where("fold = 0"), 3, apart="fold").count() == 0


def test_vector_knn_task_output_is_bounded(spark, monkeypatch):
    """k rows per query and salt leave the tasks, and blocks beyond every bar are passed over."""
    import numpy as np
    import pyarrow as pa

    rnd = np.random.default_rng(4)
    x = rnd.normal(0, 1, (60, 3))
    queries = {"ids": pa.scalar(list(range(60))), "vs": pa.scalar(x.ravel().tolist()), "marks": pa.scalar([0] * 60), "thetas": pa.scalar([math.inf] * 60)}
    met = []
    monkeypatch.setattr(vector_neighbors._Slab, "meet", lambda self, row, meet=vector_neighbors._Slab.meet: (met.append(1), meet(self, row), self.settle())[1])
    rows_ = [dict(__slab=0, __salt=0, __least=-1.0, __qids=queries["ids"].as_py(), __qvs=queries["vs"].as_py(), __qmarks=[0] * 60, __qthetas=[math.inf] * 60,
                  __pids=None, __pvs=None, __pmarks=None)]
    for n, least in enumerate((0.0, 0.0, 50.0, 60.0)):
        y = rnd.normal(0, 1, (40, 3)) + least
        rows_.append(dict(__slab=0, __salt=0, __least=least, __qids=None, __qvs=None, __qmarks=None, __qthetas=None,
                          __pids=list(range(100 * n, 100 * n + 40)), __pvs=y.ravel().tolist(), __pmarks=[1] * 40))
    out = pa.Table.from_batches(vector_neighbors._meet(4, True)(pa.Table.from_pylist(rows_).to_batches()))
    assert out.num_rows == 60 * 4 and len(met) == 2


@pytest.mark.parametrize("shift", [0.0, 3000.0, 1e20])
def test_vector_knn_works_on_some_queries_of_a_slab_at_a_time(monkeypatch, shift):
    """One copy of the points serves a slab of many queries; single precision drops no neighbour."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(vector_neighbors, "MEET_ROWS", 16)
    monkeypatch.setattr(vector_neighbors, "BUFFER", 100)
    rnd = np.random.default_rng(6)
    x, marks = rnd.normal(shift, max(1.0, shift / 1e3), (300, 8)), [i % 3 for i in range(300)]
    row = {"ids": pa.scalar(list(range(300))), "vs": pa.scalar(x.ravel().tolist()), "marks": pa.scalar(marks), "thetas": pa.scalar([math.inf] * 300)}
    assert [len(s.x) for s in vector_neighbors._slabs(row, 5, True)] == [16] * 18 + [12]
    rows_ = [dict(__slab=0, __salt=0, __least=-1.0, __qids=list(range(300)), __qvs=x.ravel().tolist(), __qmarks=marks, __qthetas=[math.inf] * 300,
                  __pids=None, __pvs=None, __pmarks=None)]
    for n in range(0, 300, 50):
        rows_.append(dict(__slab=0, __salt=0, __least=0.0, __qids=None, __qvs=None, __qmarks=None, __qthetas=None,
                          __pids=list(range(n, n + 50)), __pvs=x[n:n + 50].ravel().tolist(), __pmarks=marks[n:n + 50]))
    got = {}
    for r in pa.Table.from_batches(vector_neighbors._meet(5, True)(pa.Table.from_pylist(rows_).to_batches())).to_pylist():
        got.setdefault(r["__id"], []).append(r["__nid"])
    for i in range(300):
        far = sorted((round(float(np.sqrt(((x[i] - x[j]) ** 2).sum())), 9), j) for j in range(300) if marks[i] != marks[j])
        assert sorted(got[i]) == sorted(j for _, j in far[:5])


EDGES = [("a", "b", 1, 1.0), ("a", "c", 2, 3.0), ("b", "c", 1, 0.0), ("b", "a", 2, 2.0), ("c", "d", 1, 1.0)]
PANEL = [("a", 1, 10.0), ("b", 1, 4.0), ("c", 1, 8.0), ("d", 1, None), ("a", 2, None), ("b", 2, None), ("c", 2, 6.0)]


@pytest.fixture(scope="module")
def frames(spark):
    return (spark.createDataFrame(PANEL, "e string, t int, v double"),
            spark.createDataFrame(EDGES, "e string, neighbor string, rank int, distance double"))


def test_weighted_average(frames):
    panel, edges = frames
    out = {r[:2]: r[3] for r in rows(spatial.spatial_fill(panel, edges, "e", "t", k=2))}
    assert close(out["a", 1], (4.0 + 8.0 / 3) / (1 + 1 / 3))
    assert out["b", 1] == 8.0  # a neighbour at distance zero counts alone
    assert out["a", 2] == 6.0  # the weight of the missing one is dropped
    assert out["c", 1] is None and out["d", 1] is None
    same = {r[:2]: r[3] for r in rows(spatial.spatial_fill(panel, edges, "e", "t", k=2, salts=4))}
    assert same == out
    parity = {r[:2]: r[3] for r in rows(spatial.spatial_fill(panel, edges, "e", "t", k=2, parity=True))}
    assert parity["c", 1] == 0.0 and parity["d", 1] == 0.0


def test_other_statistics_and_modes(frames):
    panel, edges = frames
    avg = {r[:2]: r[3] for r in rows(spatial.spatial_fill(panel, edges, "e", "t", how="avg", k=2, parity=True))}
    assert avg["a", 1] == 6.0 and avg["c", 1] is None
    filled = {r[:2]: r[2] for r in rows(spatial.spatial_fill(panel, edges, "e", "t", mode="fill_na", k=2))}
    assert filled["a", 1] == 10.0 and filled["a", 2] == 6.0 and filled["d", 1] is None
    blended = {r[:2]: r[3] for r in rows(spatial.spatial_fill(panel, edges, "e", "t", k=1, self_weight=0.25))}
    assert blended["a", 1] == 0.25 * 10 + 0.75 * 4 and blended["a", 2] is None
    out = spatial.spatial_then_yoy(panel, edges, "e", "t", k=2, hot=False)
    assert out.columns == ["e", "t", "v", "v_spatial_weighted_avg_2", "v_yoy_change"]


def test_arguments_are_checked(frames):
    panel, edges = frames
    for bad in ({"mode": "x"}, {"how": "x"}, {"k": 11}):
        with pytest.raises(ValueError):
            spatial.spatial_fill(panel, edges, "e", "t", **bad)


def _vertices(spark, shapes):
    data = [(g, ring, i, float(x), float(y)) for g, rings in shapes.items() for ring, pts in enumerate(rings) for i, (x, y) in enumerate(pts)]
    return spark.createDataFrame(data, "id string, ring int, point int, x double, y double").repartition(5)


def test_disc_overlap_equals_closed_forms(spark):
    big, small = [(-9, -9), (9, -9), (9, 9), (-9, 9)], [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]
    shapes = {
        "around": [big], "inside": [small], "reversed": [small[::-1]], "holed": [big, small[::-1]], "holed_same_sense": [big, small],
        "half": [[(0, -9), (9, -9), (9, 9), (0, 9)]], "quarter": [[(0, 0), (9, 0), (9, 9), (0, 9)]],
        "slice": [[(0, 0), (20, 0), (20, 20)]], "triangle": [[(0, 0), (1, 0), (0, 1)]], "cap": [[(1, -9), (9, -9), (9, 9), (1, 9)]],
        "touching": [[(2, -9), (9, -9), (9, 9), (2, 9)]], "far": [[(40, 40), (41, 40), (41, 41)]], "corner": [[(1.9, 1.9), (9, 1.9), (9, 9), (1.9, 9)]]}
    points = spark.createDataFrame([("p", 0.0, 0.0), ("p", 0.0, 0.0), ("q", 100.0, 0.0), ("n", None, 0.0)], "e string, x double, y double")
    vertices = _vertices(spark, shapes)
    found = {r["id"]: r for r in spatial.disc_overlap(points, vertices, 2.0, "e").collect()}
    disc = 4 * math.pi
    cap = 4 * math.acos(0.5) - math.sqrt(3)
    want = {"around": disc, "inside": 4, "reversed": 4, "holed": disc - 4, "holed_same_sense": disc - 4, "half": disc / 2,
            "quarter": disc / 4, "slice": disc / 8, "triangle": 0.5, "cap": cap}
    assert set(found) == set(want)
    assert all(close(found[g]["overlap_area"], v) for g, v in want.items())
    assert close(found["holed"]["region_area"], 320.0) and close(found["triangle"]["region_area"], 0.5)
    # The same far from the origin, with several cells between the discs, and none with itself.
    moved = vertices.withColumns({"x": F.col("x") + 1e6, "y": F.col("y") - 1e6})
    there = spark.createDataFrame([("cap", 1e6, -1e6)], "id string, x double, y double")
    apart = {r["neighbor"]: r["overlap_area"] for r in spatial.disc_overlap(there, moved, 2.0, "id", same=True).collect()}
    assert set(apart) == set(want) - {"cap"} and all(close(apart[g], want[g], 1e-7) for g in apart)


def test_disc_overlap_of_parts_adds_up(spark):
    rnd = random.Random(4)
    shapes = {}
    for i in range(12):  # stars, cut in two through their centre
        cx, cy = rnd.uniform(-3, 3), rnd.uniform(-3, 3)
        reach = [rnd.uniform(0.5, 4) for _ in range(20)]
        ring = [(cx + v * math.cos(math.pi * j / 10), cy + v * math.sin(math.pi * j / 10)) for j, v in enumerate(reach)]
        shapes[f"w{i}"] = [ring]
        shapes[f"a{i}"], shapes[f"b{i}"] = [[*ring[:11], (cx, cy)]], [[*ring[10:], ring[0], (cx, cy)]]
    points = spark.createDataFrame([("p", 0.3, -0.2)], "e string, x double, y double")
    found = {r["id"]: r["overlap_area"] for r in spatial.disc_overlap(points, _vertices(spark, shapes), 1.5, "e").collect()}
    assert len(found) > 12
    for i in range(12):
        assert close(found.get(f"w{i}", 0.0), found.get(f"a{i}", 0.0) + found.get(f"b{i}", 0.0))


def test_disc_overlap_edge_cases(spark):
    empty = spark.createDataFrame([], "id string, ring int, point int, x double, y double")
    points = spark.createDataFrame([("p", 0.0, 0.0)], "e string, x double, y double")
    assert spatial.disc_overlap(points, empty, 1.0, "e").count() == 0
    assert spatial.disc_overlap(points.limit(0), _vertices(spark, {"a": [[(0, 0), (1, 0), (0, 1)]]}), 1.0, "e").count() == 0
    gap = _vertices(spark, {"a": [[(0, 0), (1, 0), (1, 1), (0, 1)]]}).where("point <> 2")
    with pytest.raises(Exception, match="gaps"):
        spatial.disc_overlap(points, gap, 1.0, "e").collect()
    with pytest.raises(ValueError):
        spatial.disc_overlap(points, empty, 0.0, "e")


def test_equal_area_keeps_areas(spark):
    ring = [(lon / 10, 40.0) for lon in range(-1000, -980)] + [(-98.0, 40 + i / 10) for i in range(20)]
    ring += [(lon / 10, 42.0) for lon in range(-980, -1000, -1)] + [(-100.0, 42 - i / 10) for i in range(20)]
    vertices = spatial.equal_area(_vertices(spark, {"a": [ring]}).withColumnsRenamed({"x": "lon", "y": "lat"}))
    points = spatial.equal_area(spark.createDataFrame([("p", 41.0, -99.0)], "e string, lat double, lon double"))
    out = spatial.disc_overlap(points, vertices, 500.0, "e").first()
    size = X.EARTH_RADIUS_KM * X.MILES_PER_KM
    true = size * size * math.radians(2) * (math.sin(math.radians(42)) - math.sin(math.radians(40)))
    assert close(out["region_area"], true, 1e-4) and close(out["overlap_area"], out["region_area"])


def test_radius_overlap_and_density(spark):
    step = 10 / 69.0934  # ten miles of latitude, roughly
    cells = [("a", 1, 30.0, -100.0, 4.0, 1.0), ("b", 2, 30.0 + step, -100.0, 6.0, 0.5), ("b", 3, 30.0 + 6 * step, -100.0, 2.0, 1.0),
             ("c", 4, 35.0, -100.0, 1.0, 1.0)]
    df = spark.createDataFrame(cells, "e string, c int, lat double, lon double, area double, land_share double")
    out = spatial.radius_overlap(df, 15.0, "e", "c")
    assert rows(out.select("e", "neighbor", "neighbor_area", "neighbor_land_area", "overlap_area", "effective_land_overlap")) == [
        ("a", "b", 8.0, 5.0, 6.0, 3.0), ("b", "a", 4.0, 4.0, 4.0, 4.0)]
    fact = spark.createDataFrame([("b", 1, 10.0), ("a", 1, None), ("b", None, 3.0)], "e string, t int, n double")
    dense = {(r["e"], r["t"]): r for r in spatial.nearby_density(out, fact, df, "e", "t", "n", 1, 2).collect()}
    assert len(dense) == 6 and close(dense["a", 1]["nearby_landadj"], 10.0 / 5.0 * 3.0)
    assert close(dense["a", 1]["nearby_per_sqmi"], 2.0) and dense["b", 1]["nearby_landadj"] == 0.0
    assert dense["c", 1]["nearby_landadj"] is None and dense["a", 2]["contributing_entities"] is None


def test_knn_tasks_keep_few_candidates(spark, points, monkeypatch):
    monkeypatch.setattr(neighbors, "HELD_ROWS", 100)
    df = spark.createDataFrame(points, "id int, lat double, lon double").repartition(8)
    for kind in ("int", "string"):
        got = neighbors.knn_edges(df.withColumn("id", F.col("id").cast(kind)), "id", 4)
        assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
        found = {}
        for r in got.collect():
            found.setdefault(int(r["id"]), {})[r["rank"]] = int(r["neighbor"])
        order = int if kind == "int" else str
        for i, a, b in points:
            want = sorted((round(miles(a, b, c, d), 9), order(j)) for j, c, d in points if j != i)[:4]
            assert [found[i][n] for n in range(1, 5)] == [int(j) for _, j in want], i


def test_knn_tasks_hand_on_k_of_each_point():
    import pyarrow as pa
    rnd = random.Random(5)
    table = [(rnd.randrange(50), j, float(j), round(rnd.random(), 1)) for j in range(5_000)]
    batches = pa.table({n: [r[i] for r in table] for i, n in enumerate(("__id", "__nid", "distance", "__d"))}).to_batches(max_chunksize=300)
    got = [tuple(r.values()) for b in neighbors._nearest_in_task(3)(iter(batches)) for r in b.to_pylist()]
    want = [r for i in range(50) for r in sorted((r for r in table if r[0] == i), key=lambda r: (r[3], r[1]))[:3]]
    assert sorted(got) == sorted(want)


def test_pairs_of_a_full_cell_go_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "CELL_PAIRS", 100)
    rnd = random.Random(9)
    spots = [(i, 30 + rnd.random() * 0.01, -100 + rnd.random() * 0.01) for i in range(80)] + [(90, 30.4, -100.0), (91, None, 0.0)]
    df = spark.createDataFrame(spots, "id int, lat double, lon double")
    got = neighbors.within_distance(df, df.withColumnRenamed("id", "other"), 20.0, "id", "other")
    assert got.select(F.spark_partition_id()).distinct().count() > 1
    near = [(i, j) for i, a, b in spots[:81] for j, c, d in spots[:81] if miles(a, b, c, d) <= 20]
    assert rows(got.select("id", "other")) == sorted(near)


def test_equal_places_of_an_entity_ask_once(spark):
    cells = spark.createDataFrame([("a", i, 30.0, -100.0, 1.0, 0.5) for i in range(40)] + [("b", 50, 30.1, -100.0, 2.0, 0.25), ("b", 51, 40.0, -100.0, 3.0, 1.0)],
                                  "e string, c int, lat double, lon double, area double, land_share double")
    got = rows(spatial.radius_overlap(cells, 25.0, "e", "c"))
    assert got == [("a", "b", 5.0, 0.7, 3.5, 2.0, 0.5), ("b", "a", 40.0, 0.5, 20.0, 40.0, 20.0)]


def _crowd(spark):
    """Stars with a hole, and points, that mostly meet."""
    rnd = random.Random(7)
    shapes = {}
    for i in range(40):
        cx, cy = rnd.uniform(-3, 3), rnd.uniform(-3, 3)
        ring = [(cx + v * math.cos(math.pi * j / 6), cy + v * math.sin(math.pi * j / 6)) for j, v in enumerate(rnd.uniform(0.8, 4) for _ in range(12))]
        hole = [(cx - 0.2, cy - 0.2), (cx + 0.2, cy - 0.2), (cx, cy + 0.3)]
        shapes[f"s{i}"] = [ring[::-1] if i % 3 else ring, *([hole] if i % 2 else [])]
    points = spark.createDataFrame([(i, rnd.uniform(-3, 3), rnd.uniform(-3, 3)) for i in range(50)], "e long, x double, y double")
    return points, _vertices(spark, shapes)


def test_disc_overlap_of_wide_polygons_equals_that_of_small_blocks(spark, monkeypatch):
    points, vertices = _crowd(spark)
    key = lambda df: {(r["e"], r["id"]): (r["region_area"], r["overlap_area"]) for r in df.collect()}
    whole = key(spatial.disc_overlap(points, vertices, 1.5, "e"))
    assert len(whole) > 1000
    for limits in ({"SIDES": 0, "CARRIED": 0}, {"SIDES": 12, "CARRIED": 0}, {"BLOCK_POINTS": 3, "BLOCK_SIDES": 20, "AT_ONCE": 30}):
        with monkeypatch.context() as m:
            for k, v in limits.items():
                m.setattr(spatial, k, v)
            other = key(spatial.disc_overlap(points, vertices, 1.5, "e"))
        assert set(other) == set(whole)
        assert all(close(a, b) for k in whole for a, b in zip(whole[k], other[k]))


def test_disc_overlap_moves_no_pairs(spark):
    points, vertices = _crowd(spark)
    plan = spatial.disc_overlap(points, vertices, 1.5, "e")._jdf.queryExecution().executedPlan().toString()
    # What a plan lists first is done last: the pairs are made after the last exchange.
    assert "MapInArrow" in plan and "Exchange" not in plan[:plan.index("MapInArrow")]
