"""Whitening and Orchard clustering: against brute force, exact integers and SQL."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from compare import expected, same
from helpers import SMALL

from tidemark.llm import orchard, whitening

INF, NAN = float("inf"), float("nan")


def table(spark, vectors):
    """(vec_id, vector) with extra columns whose names the operators use themselves."""
    extra = ("x", "rows", "dim", "weight", "white", "n", "component", "cluster", "distance", "measured", "draw", "at")
    rows = [(i, v, 1, *extra) for i, v in vectors]
    schema = "vec_id long, embedding array<float>, label int, " + ", ".join(f"`{c}` string" for c in extra)
    return spark.createDataFrame(rows, schema).repartition(3)


def cloud(rng, n, d, scale=1.0):
    mix = rng.normal(size=(d, d)) * scale
    return (rng.normal(size=(n, d)) @ mix).astype(np.float32)


def whitened_by_hand(vectors, most=32):
    """x, S, eigenvectors and values over the list of vectors, in doubles."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], np.int64)
    n, s = len(x), x.sum(axis=0)
    a = (n * x - s) / n
    v = a.T @ a / n
    values, q = np.linalg.eigh(v)
    order = np.argsort(-values)[:most]
    return n, ((n * x - s).astype(object) ** 2).sum(axis=1), a @ q[:, order] / np.sqrt(values[order]), values[order] / np.trace(v)


def check_whitening(got, vectors):
    """``got``: rows of the operator for (id, vector) with different ids."""
    n, deviation, white, explained = whitened_by_hand([v for _, v in vectors])
    k = white.shape[1]
    precise = k == 8        # eigenvalues on such scales are beyond the plain method by hand
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(got) == len(vectors) * k and set(by_id) == {i for i, _ in vectors}
    mine = np.array([[by_id[i][c]["whitened"] for c in range(1, k + 1)] for i, _ in vectors])
    signs = np.sign((mine * white).sum(axis=0))
    np.testing.assert_allclose(mine * signs, white, atol=1e-2 if precise else 1e-6)
    np.testing.assert_allclose(mine.T @ mine / n - np.outer(mine.mean(axis=0), mine.mean(axis=0)), np.eye(k), atol=1e-6)
    for (i, _), d in zip(vectors, deviation.tolist(), strict=True):
        assert {(r["n"], int(r["deviation"])) for r in by_id[i].values()} == {(n, d)}
    np.testing.assert_allclose([by_id[vectors[0][0]][c]["explained"] for c in range(1, k + 1)], explained, rtol=1e-3 if precise else 1e-6)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-6


def test_whitening_by_hand(spark):
    rng = np.random.default_rng(1)
    points = cloud(rng, 150, 40)
    copies = [points[7]] * 70 + [points[11]] * 5        # one vector holds a third of all rows
    vectors = [(i, v.tolist()) for i, v in enumerate([*points, *copies])]
    bad = [(900, None), (901, [1.0] * 39 + [None]), (902, [NAN] + [1.0] * 39), (903, [INF] * 40), (904, [])]
    check_whitening(whitening.whiten_table(table(spark, vectors + bad)).collect(), vectors)


def test_whitening_of_uneven_scales(spark):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(300, 8)) @ rng.normal(size=(8, 8)) * 10.0 ** np.arange(-1, 7)
    check_whitening(whitening.whiten_table(table(spark, list(enumerate(points.astype(np.float32).tolist())))).collect(), list(enumerate(points.astype(np.float32).tolist())))


def test_each_length_is_a_space_of_its_own(spark):
    rng = np.random.default_rng(3)
    short, long = cloud(rng, 40, 3).tolist(), cloud(rng, 60, 5).tolist()
    vectors = [(i, v) for i, v in enumerate(short + long)]
    got = whitening.whiten_table(table(spark, vectors)).collect()
    check_whitening([r for r in got if r["vec_id"] < 40], vectors[:40])
    check_whitening([r for r in got if r["vec_id"] >= 40], vectors[40:])


def test_whitening_without_variance_and_repeated_ids(spark):
    got = whitening.whiten_table(table(spark, [(1, [1.0, 5.0]), (1, [2.0, 5.0]), (None, [4.0, 5.0])])).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (1, 1), (1, 1)]
    assert all(r["explained"] == pytest.approx(1) and r["n"] == 3 for r in got)
    assert whitening.whiten_table(table(spark, [(1, [1.0, 5.0])] * 3)).count() == 0
    assert whitening.whiten_table(table(spark, [(1, [1.0])]).limit(0)).count() == 0


def test_weights_of_one(spark):
    """Each distinct vector counts once in the fit, and every row is still returned."""
    vectors = [(0, [0.0]), (1, [1.0]), (2, [1.0]), (3, [1.0])]
    got = {r["vec_id"]: r for r in whitening.whiten_table(table(spark, vectors), weights="one").collect()}
    assert got[0]["n"] == 2 and [got[i]["whitened"] for i in (1, 2, 3)] == [-got[0]["whitened"]] * 3 and abs(got[0]["whitened"]) == pytest.approx(1)


def test_large_entries_are_exact(spark):
    vectors = [(i, [float(np.float32(3.5e14 * (i % 7))), float(i)]) for i in range(40)]
    got = whitening.whiten_table(table(spark, vectors)).collect()
    n, deviation, _, _ = whitened_by_hand([v for _, v in vectors])
    assert {(r["vec_id"], int(r["deviation"])) for r in got} == {(i, d) for (i, _), d in zip(vectors, deviation.tolist(), strict=True)}
    assert whitening.whiten_table(table(spark, [(1, [3e38]), (2, [-3e38])])).count() == 2


def clusters_by_hand(vectors, k=8, rounds=10):
    ints = [(i, [math.floor(1024 * float(c)) for c in v]) for i, v in vectors]
    start = sorted(ints, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        to = [nearest(v)[1] for _, v in ints]
        for j in set(to):
            own = [v for (_, v), t in zip(ints, to, strict=True) if t == j]
            centroids[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    final = [(i, *nearest(v)[::-1]) for i, v in ints]
    per = Counter()
    for _, j, d in final:
        per[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, per[j], sum(per.values()), digest[j]) for i, j, d in final), key=str)


def test_clusters_sql(spark):
    name = "op12_centroid_clustering"
    assert not same(orchard.QUERIES[name](spark, SMALL).toPandas(), expected(orchard.ORACLES[name], SMALL))


def test_clusters_by_hand(spark):
    rng = np.random.default_rng(4)
    points = np.round(cloud(rng, 120, 64, 0.02), 2)
    points[60:90] = points[3]       # copies, so that clusters tie and some may stay empty
    vectors = [(i, v.tolist()) for i, v in enumerate(points)] + [(5, points[80].tolist()), (None, points[9].tolist()), (None, points[9].tolist())]
    bad = [(900, None), (901, [1.0] * 63), (902, [1.0] * 65), (903, [NAN] * 64), (904, [None] + [0.0] * 63), (905, []), (906, [INF] * 64)]
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    got = orchard.summary(table(spark, vectors + bad)).select(*columns).collect()
    assert sorted((tuple(r) for r in got), key=str) == clusters_by_hand(vectors)


def test_few_and_no_vectors(spark):
    few = [(i, [float(i)] * 64) for i in range(3)]
    got = orchard.summary(table(spark, few)).collect()
    assert sorted(r["cluster"] for r in got) == [0, 1, 2] and {r["inertia"] for r in got} == {0}
    assert orchard.summary(table(spark, few).limit(0)).count() == 0
    huge = [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)]
    assert orchard.summary(table(spark, huge)).count() == 3


@pytest.mark.parametrize(("k", "width"), [(1, 4), (2, 2), (40, 3), (40, 12), (200, 2)])
def test_orchard_equals_all_distances(k, width):
    """Small integers in few dimensions, so that ties, and gaps of exactly twice the distance, abound."""
    rng = np.random.default_rng(k + width)
    centroids, x = rng.integers(-6, 7, (k, width)), rng.integers(-6, 7, (3000, width))
    to, distance, measured = orchard.Orchard(centroids.tolist()).search(x)
    every = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (to == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()     # argmin: smallest number
    assert measured <= x.shape[0] * k
    if k == 200:
        assert measured < 0.35 * x.shape[0] * k


def test_orchard_of_large_integers():
    centroids, x = [[2**61, 0], [-(2**61), 5], [0, 0]], np.array([[2**62, 1], [1, 2], [-(2**60), 0], [3, -3]])
    to, distance, _ = orchard.Orchard(centroids).search(x)
    every = [[sum((int(a) - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for v in x]
    assert to.tolist() == [e.index(min(e)) for e in every] and distance.tolist() == [min(e) for e in every]
