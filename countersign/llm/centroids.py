"""Clusters around centroids in whole numbers, the nearest one found by the threshold algorithm.

Vectors become integers, floor(scale * x), so every distance and every mean is exact and no result depends
on the order of addition. A round assigns each vector to its nearest centroid and then moves each centroid
to the floored mean of its vectors; a centroid without vectors stays.

The nearest centroid is found by the threshold algorithm: each dimension keeps the centroids sorted by their
value there. Each list is walked outward from the vector's value, all dimensions one step at a time. A centroid
met for the first time gets its exact distance. A centroid that no list has shown yet is at least as far away, in
every dimension, as that list's last step: once the sum of these squares strictly exceeds the best exact
distance, the search ends. At equal sums it goes on, as a centroid of a smaller number may be equally far.

A task adds up its own vectors and hands on one row for each centroid, dimension and half of the sum (32 bits
each, so that sums of any number of rows fit), however many vectors a centroid has. The driver holds the
centroids only, ``k`` times ``dimensions`` integers, and the tasks get them with their code.

The table is read ``rounds + 2`` times: give a stored one, not a long lineage.

Results in special cases: vectors that are NULL, of another length, or hold NULL, NaN or an infinite value are left
out; zero vectors and repeated rows are vectors like others. Rows without an id have a NULL id, are assigned
and counted, and start a centroid only after all others. With fewer vectors than ``k`` there are as many centroids as
vectors; an empty table gives no row. Components too large for 64-bit distances are computed with Python's
integers; a distance or a sum beyond 64 bits is NULL in its column. Other columns are ignored.
"""

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countersign.llm.shared import written

LONG = 1 << 63
#: Sums travel in digits of so many bits.
DIGIT = 32


@dataclass(frozen=True)
class CentroidSettings:
    dimensions: int = 64
    k: int = 8
    rounds: int = 10
    scale: int = 1024
    #: Names the draw of the first centroids.
    draw: str = "3"


Centroids = list[list[int]]


def usable(df: DataFrame, settings: CentroidSettings, column: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that can be clustered."""
    vector = df[column].cast("array<double>")
    unfit = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.filter((F.size(vector) == settings.dimensions) & ~unfit).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector")
    )


def _whole(x: float, scale: int) -> int:
    """floor(scale * x), exactly. Beyond 2^53 a double is an integer itself."""
    return int(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale)


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """The vectors as integers: 64 bits wide where all distances fit, else Python's."""
    wide = math.isqrt((1 << 61) // max(vectors.shape[1], 1))
    if not len(vectors) or np.abs(vectors).max() * scale < wide:
        return np.floor(vectors * scale).astype(np.int64)
    return np.array([[_whole(x, scale) for x in row] for row in vectors.tolist()], object)


def nearest(vectors: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Number of each vector's nearest centroid and the squared distance, by the threshold algorithm."""
    n, dimensions = vectors.shape
    limit = math.isqrt((1 << 61) // max(dimensions, 1))
    large = vectors.dtype == object or max(abs(x) for c in centroids for x in c) >= limit
    kind = object if large else np.int64
    x, points = vectors.astype(kind), np.array(centroids, kind)
    k = len(points)
    order = np.argsort(points, axis=0, kind="stable")
    values = np.take_along_axis(points, order, axis=0)
    best, found = np.full(n, -1, kind), np.full(n, -1, np.int64)
    seen = np.zeros((n, k), bool)
    # First list entry at or above the vector's value, in each dimension.
    right = (x[:, None, :] > values[None, :, :]).sum(axis=1) if large else np.stack(
        [np.searchsorted(values[:, j], x[:, j]) for j in range(dimensions)], axis=1
    )
    left = right - 1
    active, columns = np.arange(n), np.arange(dimensions)
    while active.size:
        at, low, high = x[active], left[active], right[active]
        below, above = values[np.maximum(low, 0), columns], values[np.minimum(high, k - 1), columns]
        go_left = (low >= 0) & ((high >= k) | (at - below <= above - at))
        step = np.where(go_left, at - below, above - at)
        shown = order[np.where(go_left, low, np.minimum(high, k - 1)), columns]
        left[active] = low - go_left
        right[active] = high + ~go_left
        for number in range(k):
            new = active[(shown == number).any(axis=1) & ~seen[active, number]]
            if not new.size:
                continue
            seen[new, number] = True
            apart = x[new] - points[number]
            distance = (apart * apart).sum(axis=1)
            nearer = (found[new] < 0) | (distance < best[new]) | ((distance == best[new]) & (number < found[new]))
            best[new[nearer]], found[new[nearer]] = distance[nearer], number
        frontier = (step * step).sum(axis=1)
        going = ~(frontier > best[active]).astype(bool) & ~seen[active].all(axis=1)
        active = active[going]
    return found, best


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dimensions)


def _parts(batch: pa.RecordBatch, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def first_centroids(vectors: DataFrame, settings: CentroidSettings) -> Centroids:
    """The ``k`` vectors with the smallest SHA-256 of ``<draw>:<vec_id>``, in the order of the hash."""
    drawn = F.sha2(F.concat(F.lit(settings.draw + ":"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(drawn.asc_nulls_last(), "vector").limit(settings.k).collect()  # k rows
    return [[_whole(x, settings.scale) for x in row.vector] for row in rows]


def moved(vectors: DataFrame, centroids: Centroids, settings: CentroidSettings) -> Centroids:
    """The centroids after one round."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [0] * len(centroids)
        totals = [[0] * settings.dimensions for _ in centroids]
        for batch in batches:
            for part in _parts(batch):
                x = whole_numbers(_matrix(part, settings.dimensions), settings.scale)
                found, _ = nearest(x, centroids)
                for number in np.unique(found):
                    own = x[found == number]
                    counts[number] += len(own)
                    totals[number] = [a + int(b) for a, b in zip(totals[number], own.sum(axis=0))]
        rows = []
        for number, (count, total) in enumerate(zip(counts, totals)):
            if count:
                rows.append((number, -1, 0, count))
                rows.extend((number, d, *digit) for d, value in enumerate(total) for digit in _digits(value))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(SUMS.names, row)) for row in rows], schema=SUMS
        )

    added = (
        vectors.select("vector").mapInArrow(sums, "number int, dimension int, place int, value bigint")
        .groupBy("number", "dimension", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    )
    totals: dict[tuple[int, int], int] = {}
    for row in added.collect():  # k * dimensions rows, times the digits of a sum
        key = row.number, row.dimension
        totals[key] = totals.get(key, 0) + (int(row.value) << (DIGIT * row.place))
    return [
        [totals[number, d] // totals[number, -1] for d in range(settings.dimensions)] if (number, -1) in totals else old
        for number, old in enumerate(centroids)
    ]


SUMS = pa.schema([("number", pa.int32()), ("dimension", pa.int32()), ("place", pa.int32()), ("value", pa.int64())])


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """``place, digit`` of a sum; the last digit has the sign."""
    place = 0
    while not -(1 << DIGIT) <= value < 1 << DIGIT:
        yield place, value & ((1 << DIGIT) - 1)
        value, place = value >> DIGIT, place + 1
    yield place, value


def assigned(vectors: DataFrame, centroids: Centroids, settings: CentroidSettings) -> DataFrame:
    """``vec_id, cluster, distance``; the distance is a decimal text, as it may exceed 64 bits."""
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.string())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                x = whole_numbers(_matrix(part, settings.dimensions), settings.scale)
                found, distance = nearest(x, centroids)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(found, pa.int32()), pa.array([str(d) for d in distance.tolist()])],
                    schema=schema,
                )

    return vectors.mapInArrow(each, "vec_id bigint, cluster int, distance string")


def clusters(
    df: DataFrame, settings: CentroidSettings = CentroidSettings(), column: str = "embedding"
) -> tuple[DataFrame, Centroids]:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each usable vector, and the final
    centroids. The inertias are sums of squared distances, over the cluster and over all."""
    vectors = usable(df, settings, column)
    spark = df.sparkSession
    centroids = first_centroids(vectors, settings)
    for _ in range(settings.rounds if centroids else 0):
        centroids = moved(vectors, centroids, settings)
    if not centroids:
        found = spark.createDataFrame([], "vec_id bigint, cluster int, distance string")
    else:
        found = written(assigned(vectors, centroids, settings), "assigned")
    number = F.expr("try_cast(distance AS decimal(38,0))")
    summed = found.groupBy("cluster").agg(F.try_sum(number).alias("inertia"), F.count_if(number.isNull()).alias("unfit"))
    sums = {r.cluster: None if r.unfit or r.inertia is None else int(r.inertia) for r in summed.collect()}  # k rows
    whole = None if None in sums.values() else sum(sums.values())
    rows = [
        (number, _long(total), _long(whole), hashlib.sha256(",".join(map(str, centroids[number])).encode()).hexdigest())
        for number, total in sums.items()
    ]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    joined = found.join(F.broadcast(known), "cluster").select(  # k rows
        "vec_id", "cluster", F.expr("try_cast(distance AS bigint)").alias("distance"),
        "cluster_inertia", "inertia", "centroid_sha256",
    )
    return joined, centroids


def _long(value: int | None) -> int | None:
    return value if value is not None and value < LONG else None
