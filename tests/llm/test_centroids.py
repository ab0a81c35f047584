"""Clusters in whole numbers, against brute force and SQL."""

import hashlib
import math

import numpy as np
import pytest

from countersign.llm import oracle
from countersign.llm.centroids import CentroidSettings, clusters, nearest
from countersign.llm.queries import op13_centroids
from tests.compare_engines import problem

DATA = "/root/testdata/sf0.001"


def brute(rows, settings):
    """The contract, vector by vector, in Python's integers."""
    kept = [
        (i, [math.floor(settings.scale * x) if abs(x) < 2**53 else int(x) * settings.scale for x in v])
        for i, v in rows
        if v is not None and len(v) == settings.dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    drawn = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{settings.draw}:{r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in drawn[: settings.k]]

    def assign():
        found = []
        for _, v in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in points]
            found.append((distances.index(min(distances)), min(distances)))
        return found

    for _ in range(settings.rounds):
        found = assign()
        for number in range(len(points)):
            own = [v for (_, v), (c, _) in zip(kept, found) if c == number]
            if own:
                points[number] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    return sorted(((i, c, d) for (i, _), (c, d) in zip(kept, found)), key=repr), points


@pytest.mark.parametrize("dimensions, k, spread", [(64, 8, 300), (3, 8, 4), (2, 5, 2), (1, 4, 6), (5, 1, 9), (4, 6, 10**12)])
def test_threshold_search_against_all_distances(dimensions, k, spread):
    drawn = np.random.default_rng(dimensions)
    vectors = drawn.integers(-spread, spread, (700, dimensions))
    points = drawn.integers(-spread, spread, (k, dimensions)).tolist()
    found, distance = nearest(vectors, points)
    apart = ((vectors.astype(object)[:, None, :] - np.array(points, object)[None]) ** 2).sum(axis=2)
    assert distance.tolist() == apart.min(axis=1).tolist()
    assert found.tolist() == [row.index(min(row)) for row in apart.tolist()]


def test_query_against_sql(spark):
    assert problem(spark, DATA, op13_centroids, oracle.centroids()) is None


def test_odd_vectors(spark):
    settings = CentroidSettings(dimensions=2, k=3, rounds=4)
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.0, 0.0]), (2, [0.5, -0.25]), (2, [0.5, -0.25]), (3, [1.0, 1.0]), (None, [2.0, 2.0]), (4, None), (5, []),
        (6, [1.0]), (7, [None, 1.0]), (8, [nan, 1.0]), (9, [1.0, -inf]), (10, [1.0, 2.0, 3.0]), (11, [-0.0001, 0.0001]),
        (12, [1e9, -1e9]),
    ]
    df = spark.createDataFrame(
        [(i, v, "x", 5, "y") for i, v in rows], "vec_id bigint, embedding array<double>, vector string, cluster int, distance string"
    )
    found, points = clusters(df, settings)
    expected, expected_points = brute(rows, settings)
    got = found.collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=repr) == expected
    assert points == expected_points
    for row in got:
        own = [d for _, c, d in expected if c == row.cluster]
        assert (row.cluster_inertia, row.inertia) == (sum(own), sum(d for _, _, d in expected))
        assert row.centroid_sha256 == hashlib.sha256(",".join(map(str, points[row.cluster])).encode()).hexdigest()


def test_distances_beyond_64_bits_are_null(spark):
    settings = CentroidSettings(dimensions=2, k=1, rounds=1)
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 1.0])]
    found, points = clusters(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), settings)
    assert {(r.cluster, r.distance, r.inertia) for r in found.collect() if r.vec_id != 3} == {(0, None, None)}
    assert points == [[0, 341]]


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    found, points = clusters(df, CentroidSettings(dimensions=2))
    assert [(r.vec_id, r.cluster, r.distance) for r in found.collect()] == [(1, 0, 0)] * 2 and len(points) == 2
    found, points = clusters(df.limit(0), CentroidSettings(dimensions=2))
    assert found.count() == 0 and points == []
