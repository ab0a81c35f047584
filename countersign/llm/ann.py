"""Nearest neighbours by a forest of random-projection trees.

Each tree splits at the median of the projections on a random direction, as fitted on a bounded sample
(``sample_rows``); every vector is then indexed in a leaf of every tree. A query walks down all
trees at once, through one queue shared by them that always opens the branch whose planes lie nearest,
until it has visited ``visits`` leaves. Vectors of these leaves are ranked by their exact inner product.

For inner products, vectors get one more component that brings all of them to the same length, so
the nearest in angle is the one with the largest product.

Spark deals out the work: leaves are joined with the queries that visit them, large ones in blocks
of ``block_rows`` vectors by ``block_queries`` queries. Equal vectors are indexed once, with their k + 1 smallest
ids, of which no more can be in a result; every row that is a query gets its own result.

Results in special cases: NULL, empty and zero vectors, those that hold NULL or non-finite components or
have another number of components than most take no part, neither as queries nor as candidates; rows without
an id neither; repeated rows count once; ties go to the smaller id; with k or fewer candidates in
the visited leaves, all of them are returned; an empty table gives no row.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countersign.llm.shared import bounded_sample, written

#: Pairs of vectors whose exact products are made at once.
EXACT_PAIRS = 20_000


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 10
    leaf_rows: int = 64
    sample_rows: int = 20_000
    visits: int = 400
    block_rows: int = 4096
    block_queries: int = 2048
    seed: int = 2


@dataclass(frozen=True)
class Forest:
    """Flat trees: a child below zero is the leaf ``-child - 1``."""

    planes: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    roots: np.ndarray
    longest: float

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (x**2).sum(axis=1), 0)
        return np.column_stack([x, np.sqrt(rest)])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree."""
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        sides = self.lifted(x) @ self.planes.T > self.offsets
        rows = np.arange(len(x))[:, None]
        while (at >= 0).any():
            inner = np.maximum(at, 0)
            at = np.where(at >= 0, self.children[inner, sides[rows, inner].astype(int)], at)
        return -at - 1

    def visited(self, query: np.ndarray, visits: int) -> list[int]:
        """The leaves that the shared queue opens first."""
        scaled = np.append(query * (self.longest / np.linalg.norm(query)), 0.0)
        margins = self.planes @ scaled - self.offsets
        queue = [(0.0, int(root)) for root in self.roots]
        heapq.heapify(queue)
        found: list[int] = []
        while queue and len(found) < visits:
            gap, node = heapq.heappop(queue)
            while node >= 0:
                margin = margins[node]
                near = int(margin > 0)
                heapq.heappush(queue, (max(gap, abs(margin)), int(self.children[node, 1 - near])))
                node = int(self.children[node, near])
            found.append(-node - 1)
        return found


def grow_forest(sample: np.ndarray, longest: float, settings: ForestSettings) -> Forest:
    rng = np.random.default_rng(settings.seed)
    planes, offsets, children = [], [], []
    n_leaves = 0
    bare = Forest(np.zeros((0, 0)), np.zeros(0), np.zeros((0, 2)), np.zeros(0), longest)
    lifted = bare.lifted(sample)

    def grow(rows: np.ndarray) -> int:
        nonlocal n_leaves
        if len(rows) > settings.leaf_rows:
            direction = rng.standard_normal(lifted.shape[1])
            direction /= np.linalg.norm(direction)
            projected = lifted[rows] @ direction
            middle = float(np.median(projected))
            above = projected > middle
            if above.any() and not above.all():
                node = len(planes)
                planes.append(direction)
                offsets.append(middle)
                children.append([0, 0])
                children[node] = [grow(rows[~above]), grow(rows[above])]
                return node
        n_leaves += 1
        return -n_leaves

    roots = [grow(np.arange(len(sample))) for _ in range(settings.trees)]
    width = lifted.shape[1]
    return Forest(
        np.array(planes).reshape(-1, width), np.array(offsets), np.array(children, int).reshape(-1, 2),
        np.array(roots), longest,
    )


def usable(vector: Column) -> Column:
    """Does the vector take part: not NULL, not zero, all components finite?"""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """``vec, first_id, ids``: each different vector once, with its k + 1 smallest ids."""
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    return (
        vectors.distinct().withColumn("rank", rank).filter(F.col("rank") <= k + 1)
        .groupBy("vec").agg(F.min("vec_id").alias("first_id"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )


def _leaves_of(rows: DataFrame, forest: Forest, visits: int | None) -> DataFrame:
    """``first_id, vec, leaves``: a leaf of each tree, or the leaves that a query visits. Spark, not Python, repeats vectors."""
    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                found = forest.leaves(x) if visits is None else [forest.visited(q, visits) for q in x]
                leaves = pa.array([np.asarray(f, np.int32) for f in found], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, leaves], names=["first_id", "vec", "leaves"])

    return rows.select("first_id", "vec").mapInArrow(routed, "first_id bigint, vec array<double>, leaves array<int>")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, settings: ForestSettings = ForestSettings()
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k nearest other rows that were found.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    taken = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec")
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    widths = taken.groupBy(F.size("vec").alias("width")).count().orderBy(F.desc("count"), "width").limit(1)
    width = [r.width for r in widths.collect()]
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if not width:
        return spark.createDataFrame([], result)
    taken = taken.filter(F.size("vec") == width[0])
    distinct = written(distinct_vectors(taken, k), "vectors")
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    longest = float(distinct.agg(F.max(F.sqrt(squares))).first()[0])
    sample = bounded_sample(distinct.select("first_id", "vec"), "first_id", settings.sample_rows, settings.seed)
    forest = grow_forest(np.array([r.vec for r in sample.collect()]), longest, settings)

    members = taken.filter(is_query).select(F.col("vec_id").alias("query_id"), "vec").distinct()
    asked = written(
        members.join(distinct, "vec").select("query_id", "first_id"), "queries"
    )
    queries = distinct.join(asked.select("first_id").distinct(), "first_id", "left_semi")
    def by_leaf(routes: DataFrame) -> DataFrame:
        return routes.select(F.explode("leaves").alias("leaf"), "first_id", "vec")

    indexed = by_leaf(_leaves_of(distinct, forest, None))
    visiting = by_leaf(written(_leaves_of(queries, forest, settings.visits), "visits"))

    # One row a leaf, at most trees * 2 * sample_rows / leaf_rows of them.
    sizes = (
        indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n_rows"))
        .join(visiting.groupBy("leaf").agg(F.count(F.lit(1)).alias("n_queries")), "leaf")
        .select(
            "leaf", F.ceil(F.col("n_rows") / settings.block_rows).cast("int").alias("row_blocks"),
            F.ceil(F.col("n_queries") / settings.block_queries).cast("int").alias("query_blocks"),
        )
    )
    sizes = F.broadcast(written(sizes, "leaves"))

    def block(count: str) -> Column:
        return F.pmod(F.xxhash64("first_id"), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = indexed.join(sizes, "leaf").select(
        "leaf", block("row_blocks").alias("b"), every("query_blocks").alias("q"), "first_id", "vec"
    )
    right = visiting.join(sizes, "leaf").select(
        "leaf", every("row_blocks").alias("b"), block("query_blocks").alias("q"), "first_id", "vec"
    )

    def ranked(rows: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asking):
            return pd.DataFrame({"first_id": [], "found_id": [], "score": []})
        rows = rows.sort_values("first_id")
        x, ids = np.stack(rows["vec"].to_list()), rows["first_id"].to_numpy()
        out = []
        for at in range(0, len(asking), 256):
            part = asking.iloc[at : at + 256]
            q = np.stack(part["vec"].to_list())
            rough = q @ x.T
            keep = min(k + 1, len(ids))
            least = -np.partition(-rough, keep - 1, axis=1)[:, keep - 1]
            # Rounding may shift a product by a few units of its last place: take those too.
            near = rough >= (least - 1e-12 * longest**2)[:, None]
            who, which = np.nonzero(near)
            # There may be any number of ties, so products are made some at a time and those beyond the k + 1 best dropped.
            cuts = range(0, len(who), EXACT_PAIRS)
            score = np.concatenate([(q[who[i : i + EXACT_PAIRS]] * x[which[i : i + EXACT_PAIRS]]).sum(axis=1) for i in cuts])
            order = np.lexsort((which, -score, who))
            place = np.arange(len(who)) - np.searchsorted(who, who[order])
            best = order[place < keep]
            out.append(pd.DataFrame({
                "first_id": part["first_id"].to_numpy()[who[best]], "found_id": ids[which[best]], "score": score[best],
            }))
        return pd.concat(out)

    scored = (
        left.groupBy("leaf", "b", "q").cogroup(right.groupBy("leaf", "b", "q"))
        .applyInPandas(ranked, "first_id bigint, found_id bigint, score double")
        .groupBy("first_id", "found_id").agg(F.max("score").alias("score"))
    )
    by_score = Window.partitionBy("first_id").orderBy(F.desc("score"), "found_id")
    best = scored.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= k + 1)
    named = distinct.select(F.col("first_id").alias("found_id"), "ids")
    rows = best.join(named, "found_id").select("first_id", "score", F.explode("ids").alias("vec_id"))
    by_vector = Window.partitionBy("first_id").orderBy(F.desc("score"), "vec_id")
    rows = written(
        rows.withColumn("place", F.row_number().over(by_vector)).filter(F.col("place") <= k + 1), "nearest"
    )
    by_query = Window.partitionBy("query_id").orderBy("place")
    return (
        asked.join(rows, "first_id").filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
