"""Hard negatives, exact top-k and vector codes against brute force, with odd rows and small limits."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpanel.llm import hard_negatives, top_k, vector_codes, vector_scan
from gridpanel.llm.hard_negatives import Residues, balanced

SCHEMA = "vec_id long, embedding array<double>, label int, k string, v int, l int, score string, rank string, place int"
NAN, INF = float("nan"), float("inf")


def floors(x):
    return [int(np.floor(256 * y)) for y in x]


def whole(x):
    return x is not None and all(y is not None and np.isfinite(y) for y in x)


def product(a, b):
    return sum(p * q for p, q in zip(a, b, strict=False))


def frame(spark, rows, parts=5):
    """Rows of (vec_id, embedding, label) beside columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, 2, "y", "z", 3) for r in rows], SCHEMA).repartition(parts)


def odd_rows(seed, n=260, width=5, spread=0.4):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(0, spread, width)], int(rng.integers(0, 4))) for i in range(n)]
    rows[3] = (3, None, 1)
    rows[4] = (4, [0.1, None, 0.2, 0.3, 0.1], 1)
    rows[5] = (5, [0.1, NAN, 0.2, 0.3, 0.1], 1)
    rows[6] = (6, [0.1, INF, 0.2, 0.3, 0.1], 1)
    rows[8] = (8, [0.5, 0.25], 2)
    rows[9] = (9, [], 2)
    rows[11] = (11, rows[11][1], None)
    rows += [(None, rows[0][1], 1), rows[20], rows[20], rows[40]]
    rows += [(300 + i, rows[60][1], int(i % 4)) for i in range(90)]  # ties
    return rows


def brute_top(rows, every, k):
    known = [(i, floors(x)) for i, x, _ in rows if i is not None and whole(x)]
    out = set()
    for q, x in {(i, tuple(x)) for i, x in known if i % every == 0}:
        best = sorted((-product(x, y), i) for i, y in known if i != q)[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("bins,enough,bytes_,k", [(128, 64, 1 << 20, 5), (3, 0, 1 << 20, 5), (4, 1, 200, 3), (2, 0, 1 << 20, 500)])
def test_top_k(spark, monkeypatch, bins, enough, bytes_, k):
    monkeypatch.setattr(top_k, "BINS", bins)
    monkeypatch.setattr(top_k, "ENOUGH", enough)
    monkeypatch.setattr(vector_scan, "PASS_BYTES", bytes_)
    monkeypatch.setattr(top_k, "QUERIES", 3)
    rows = odd_rows(1)
    got = top_k.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert {tuple(r) for r in got.collect()} == brute_top(rows, 20, k)


def test_top_k_all_equal_and_repeated(spark, monkeypatch):
    monkeypatch.setattr(top_k, "ENOUGH", 2)
    rows = [(i, [1.0, -1.0], 0) for i in range(500)] + [(7, [1.0, -1.0], 0)] * 400
    got = top_k.top_k(frame(spark, rows), F.col("vec_id") == 0, 10).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2, 3, 4, 5, 6, 7, 7, 7, 7]


def test_top_k_large_components(spark):
    rows = [(i, [1000.0 * i, 7.0 - 3000.0 * i], 0) for i in range(60)]
    got = top_k.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, 4)
    assert {tuple(r) for r in got.collect()} == brute_top(rows, 20, 4)
    with pytest.raises(ValueError, match="too large"):
        top_k.top_k(frame(spark, [(0, [1e30], 0)]), F.col("vec_id") == 0, 1)


@pytest.mark.parametrize("rows", [[], [(None, [1.0], 1)], [(50, [1.0], 1)], [(50, None, 1), (51, [2.0], 1)]])
def test_nothing_to_find(spark, rows):
    df = frame(spark, rows)
    assert top_k.top_k(df, F.col("vec_id") % 50 == 0, 5).count() == 0
    assert hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0).count() == 0


def brute_negatives(rows, every, n_pos, n_neg, low, high, per):
    known = [(i, floors(x), c) for i, x, c in rows if i is not None and c is not None and whole(x)]
    out = []
    for a, x, c in {(i, tuple(x), c) for i, x, c in known if i % every == 0}:
        scored = sorted((-product(x, y), i, d) for i, y, d in known)
        for p, i, _ in [t for t in scored if t[2] == c and t[1] != a][:n_pos]:
            near = [t for t in scored if t[2] != c and low * -p <= per * -t[0] <= high * -p][:n_neg]
            out += [(a, i, n + 1, j, -p, -s) for n, (s, j, _) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("bytes_,low,high,n_pos,n_neg", [(1 << 20, 80, 100, 5, 5), (100, 80, 100, 5, 5), (1 << 20, -50, 120, 2, 7)])
def test_hard_negatives(spark, monkeypatch, bytes_, low, high, n_pos, n_neg):
    monkeypatch.setattr(vector_scan, "PASS_BYTES", bytes_)
    monkeypatch.setattr(hard_negatives, "QUERIES", 3)
    rows = odd_rows(2)
    got = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 20 == 0, n_pos, n_neg, low, high)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows, 20, n_pos, n_neg, low, high, 100)


@pytest.mark.parametrize("width,largest", [(1, 5), (64, 160), (64, 2**20), (3, 2**28), (2500, 300)])
def test_residues(width, largest):
    rng = np.random.default_rng(width)
    a, b = (rng.integers(-largest, largest + 1, (6, width)) for _ in range(2))
    a[0], b[0], a[1], b[1] = largest, largest, -largest, largest
    bound = width * largest * largest
    residues = Residues(width, bound)
    assert all((p // 2) ** 2 * min(width, hard_negatives.COLUMNS) < 2**24 for p in residues.primes)
    assert (residues.products(residues.split(a), residues.split(b)) == a @ b.T).all()


def test_balanced():
    x = np.arange(-(2**24) + 2**13, 2**24 - 2**13, 977, dtype=np.int64)
    for p in (3, 509, 2039):
        want = (x + p // 2) % p - p // 2
        assert (balanced(x.astype(np.float32), p) == want).all()


def brute_codes(rows, parts, entries, rounds):
    kept = [(i, floors(x), c) for i, x, c in rows if whole(x)]
    width = max(-(-max(len(x) for _, x, _ in kept) // parts), 1)
    x = np.array([v + [0] * (parts * width - len(v)) for _, v, _ in kept]).reshape(len(kept), parts, width)
    seeds = sorted(n for n, r in enumerate(kept) if r[0] is not None)
    seeds = sorted(seeds, key=lambda n: (kept[n][0], [r for r in rows if whole(r[1])][n][1]))[:entries]
    books = x[seeds].swapaxes(0, 1).copy()
    for turn in range(rounds + 1):
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(-1)
        codes = d.argmin(-1)
        if turn < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    mine = x[codes[:, p] == e, p]
                    if len(mine):
                        books[p, e] = [int(s) // len(mine) for s in mine.sum(0)]
    errors = d.min(-1).sum(-1)
    by_label = {c: int(sum(e for e, r in zip(errors, kept, strict=True) if r[2] == c)) for c in {r[2] for r in kept}}
    digest = hashlib.sha256(",".join(str(v) for v in books.ravel()).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{v:02x}" for v in code), int(e), by_label[r[2]], digest) for r, code, e in zip(kept, codes, errors, strict=True)), key=str)


@pytest.mark.parametrize("chunk,leaf,entries,width", [(4096, 8, 64, 16), (37, 1, 9, 16), (50, 3, 200, 19), (64, 2, 16, 3)])
def test_vector_codes(spark, monkeypatch, chunk, leaf, entries, width):
    monkeypatch.setattr(vector_codes, "CHUNK", chunk)
    monkeypatch.setattr(vector_codes, "LEAF", leaf)
    rows = odd_rows(3, width=width, spread=0.02)  # few distinct integers: many ties
    got = vector_codes.compress(frame(spark, rows), 4, entries, 2)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_codes(rows, 4, entries, 2)


def test_vector_codes_of_little(spark):
    assert vector_codes.compress(frame(spark, [])).count() == 0
    assert vector_codes.compress(frame(spark, [(None, [1.0], 1), (1, None, 2)])).count() == 0
    rows = [(1, [], 1), (2, [], None), (None, [], None)]
    assert sorted((tuple(r) for r in vector_codes.compress(frame(spark, rows)).collect()), key=str) == brute_codes(rows, 16, 64, 2)


def test_subtrees_go_whole():
    """Clustered points are assigned through node sums, with few points compared."""
    rng = np.random.default_rng(5)
    centers = rng.integers(-1000, 1000, (20, 8))
    x = centers[rng.integers(0, 20, 4000)] + rng.integers(-3, 4, (4000, 8))
    forest = vector_codes.Forest(x, 2)
    books = np.ascontiguousarray(centers.reshape(20, 2, 4).swapaxes(0, 1))
    compared = sum(len(at) for kind, at, *_ in forest.walk(books) if kind == "point")
    assert compared == sum(len(at) for kind, at, *_ in forest.walk(books, 7) if kind == "point")
    assert compared < 0.05 * 2 * len(x)
    for node in range(len(forest.start)):
        points = forest.points[forest.start[node]:forest.end[node]]
        assert (points.sum(0) == forest.sums[node]).all()
        assert np.sqrt(((points - points[0]) ** 2).sum(1)).max() <= forest.radius[node] + 1e-9
