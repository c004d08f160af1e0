"""Centroid clustering: SQL on the smallest tables, whole-number brute force, awkward vectors."""

import hashlib
import random

import numpy as np
import oracle
import pytest

from tenura.llm import centroids, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<double>, cluster string, id string, v string, distance string"


def brute_force(rows, k, rounds, dims):
    """(id, cluster, distance) of each kept row and the centroids, with Python numbers; rows: (id, vector)."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((vec_id, [int(np.floor(256 * float(x))) for x in v], v))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[2]))
    centers = [r[1] for r in order[:k]]

    def nearest(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centers]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        groups = {}
        for _, v, _ in kept:
            groups.setdefault(nearest(v)[0], []).append(v)
        for i, vs in groups.items():
            centers[i] = [sum(c) // len(vs) for c in zip(*vs)]
    return [(vec_id, *nearest(v)) for vec_id, v, _ in kept], [tuple(c) for c in centers]


def table(spark, rows):
    return spark.createDataFrame([(i, v, "mine", "mine", "mine", "mine") for i, v in rows], SCHEMA)


def result(df):
    return sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in df.collect()), key=str)


def test_query_matches_sql(spark):
    con = oracle.connect(SF)
    assert oracle.compare(queries.QUERIES["op13_centroids"](spark, SF), con, queries.ORACLES["op13_centroids"]) is None


@pytest.mark.parametrize("k,rounds", [(1, 2), (5, 0), (5, 3), (40, 2)])
def test_brute_force(spark, k, rounds):
    """On a coarse grid, so that ties, repeated vectors and empty clusters occur."""
    rng = random.Random(k)
    rows = [(i, [rng.choice([-0.01, 0.0, 0.004, 0.5]) for _ in range(3)]) for i in range(120)]
    found, made = centroids.cluster(table(spark, rows).repartition(5), k, rounds, dims=3)
    want, centers = brute_force(rows, k, rounds, 3)
    assert result(found) == sorted(want, key=str) and made == centers
    sums = {}
    for _, c, d in want:
        sums[c] = sums.get(c, 0) + d
    for r in found.collect():
        assert r["cluster_inertia"] == sums[r["cluster"]] and r["inertia"] == sum(sums.values())
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centers[r["cluster"]])).encode()).hexdigest()


def test_awkward_vectors(spark):
    """Nulls, wrong lengths, non-finite components, equal and null ids, repeated rows, columns named like results."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [-inf, 0.0]),
            (8, [1.0, 2.0, 3.0]), (9, [1.0, 1.0]), (9, [1.0, 1.0]), (9, [0.5, 1.0]), (None, [3.0, 3.0]),
            (None, [-3.0, 3.0]), (10, [-0.0, 0.0]), (11, [-1e-9, 1e-9])]
    for k in (1, 3, 40):
        found, made = centroids.cluster(table(spark, rows), k, 2, dims=2)
        want, centers = brute_force(rows, k, 2, 2)
        assert result(found) == sorted(want, key=str) and made == centers


def test_large_components(spark):
    """Beyond the range of quick arithmetic results stay exact; beyond 64 bits they are the largest long."""
    rows = [(i, [x, -x]) for i, x in enumerate([1e3, 5e5, 6e5, 1e6, 1e6 + 1, 2e6])]
    found, _ = centroids.cluster(table(spark, rows), 2, 3, dims=2)
    assert result(found) == sorted(brute_force(rows, 2, 3, 2)[0], key=str)
    found, made = centroids.cluster(table(spark, [(0, [1e300, 0.0]), (1, [-1e300, 0.0])]), 1, 1, dims=2)
    assert {r["distance"] for r in found.collect()} == {centroids.LONG}


def test_nothing(spark):
    for rows in ([], [(1, None)]):
        found, made = centroids.cluster(table(spark, rows), dims=2)
        assert found.count() == 0 and made == []
        assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_too_many_centroids(spark):
    with pytest.raises(ValueError):
        centroids.cluster(table(spark, []), k=10_000)


def test_tournament_keeps_the_smaller_number():
    planes = centroids.Bisectors([(0, 0), (2, 0), (0, 0), (1, 0)])
    best, far = planes.place(np.array([[0, 0], [1, 0], [2, 0], [3, 0]]))
    assert best.tolist() == [0, 3, 1, 1] and far.tolist() == [0, 0, 0, 1]
