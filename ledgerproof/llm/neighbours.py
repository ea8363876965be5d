"""Approximate nearest neighbours by stable projections, a kd-tree, and a chi-square stop.

Vectors are scaled to unit length, so the largest cosine is the smallest distance, and
projected to ``DIMS`` Gaussian (2-stable) directions: a squared projected distance is the
squared distance times a chi-square variable with ``DIMS`` degrees of freedom. A kd-tree
over the projections, fitted on at most ``SAMPLE`` vectors, deals all of them to cells.

A query visits cells in the order of their projected distance, 1 at first and then three
times as many as before in each round, and inside a cell the vectors in the order of
theirs, and verifies their true distances. It stops where the next projected distance is so
large that a vector nearer than the present k-th would have stayed below it with
probability ``CONFIDENCE``: ``r ** 2 > d_k ** 2 * quantile``. Visiting all cells is the end
in any case. The test looks at a query's own distances only, so recall does not depend on
the number of vectors.

Equal vectors are indexed once with their ``k + 1`` smallest ids, which is all that any
answer can use, so one very frequent vector makes no large cell. Cells and their visitors
are cut into blocks of bounded size that meet in tasks of their own.

Cases: vectors that are null, zero, hold null or non-finite components, or have another
length than most take no part, nor do rows with a null id; ties go to the smaller id;
repeated rows of one id and vector count once; fewer than ``k`` candidates are all
returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerproof.llm.common import settle

DIMS = 16
CONFIDENCE = 0.96
SAMPLE = 65_536
LEAF = 1024
MAX_LEAVES = 4096
BLOCK = 2048
PACK = 512
STEP = 128
SEED = 23


def chi_square_quantile(p: float, dims: int) -> float:
    """For an even number of degrees of freedom."""

    def cdf(x: float) -> float:
        term = total = 1.0
        for i in range(1, dims // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 20.0 * dims
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


@dataclass
class Tree:
    """A kd-tree by arrays: inner nodes (dim, cut, children), leaves as ~cell, regions of the cells."""

    dim: np.ndarray
    cut: np.ndarray
    child: np.ndarray  # nodes x 2: node number, or ~cell
    low: np.ndarray  # cells x dims
    high: np.ndarray

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64) if len(self.dim) else np.full(len(points), -1)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            node[inner] = self.child[at, (points[inner, self.dim[at]] >= self.cut[at]).astype(int)]
        return ~node

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of every point to every cell's region."""
        out = np.zeros((len(points), len(self.low)))
        for d in range(self.low.shape[1]):
            x = points[:, d : d + 1]
            out += np.maximum(0, np.maximum(self.low[:, d] - x, x - self.high[:, d])) ** 2
        return out


def grow(points: np.ndarray, leaves: int) -> Tree:
    """Splits the fullest cell at the median of its widest direction, ``leaves`` cells at most."""
    dims = points.shape[1]
    dim, cut, child, low, high = [], [], [], [], []
    depth = max(0, math.ceil(math.log2(max(1, leaves))))

    def split(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, level: int) -> int:
        own = points[rows]
        if level and len(rows) > 1:
            d = int(own.var(0).argmax())
            at = float(np.median(own[:, d]))
            right = own[:, d] >= at
            if 0 < right.sum() < len(rows):
                me = len(dim)
                dim.append(d)
                cut.append(at)
                child.append([0, 0])
                upper, lower = hi.copy(), lo.copy()
                upper[d] = lower[d] = at
                child[me] = [split(rows[~right], lo, upper, level - 1), split(rows[right], lower, hi, level - 1)]
                return me
        low.append(lo)
        high.append(hi)
        return ~(len(low) - 1)

    split(np.arange(len(points)), np.full(dims, -np.inf), np.full(dims, np.inf), depth)
    return Tree(
        np.array(dim, np.int64), np.array(cut), np.array(child, np.int64).reshape(-1, 2), np.array(low), np.array(high)
    )


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def exact_scores(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines in double precision, the same for equal vectors wherever they stand."""
    return (x * query).sum(1) / (np.sqrt((x * x).sum(1)) * math.sqrt((query * query).sum()))


def verify(
    query: np.ndarray, reach: float, x: np.ndarray, unit: np.ndarray, projected: np.ndarray, quantile: float, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` that may be among the query's k + 1 nearest, and their cosines.

    ``projected``: squared projected distances of the rows to the query. ``reach``: the
    squared distance of the query's k-th neighbour so far.
    """
    within = np.flatnonzero(projected <= reach * quantile)
    within = within[np.argsort(projected[within], kind="stable")]
    own = query / math.sqrt((query * query).sum())
    rows = np.zeros(0, np.int64)
    near = np.zeros(0)
    for at in range(0, len(within), STEP):
        part = within[at : at + STEP]
        if projected[part[0]] > reach * quantile:
            break
        rows, near = np.concatenate([rows, part]), np.concatenate([near, unit[part] @ own])
        if len(rows) > k + 1:
            least = np.partition(near, -k - 1)[-k - 1] - 1e-9
            rows, near = rows[near >= least], near[near >= least]
            reach = min(reach, max(0.0, 2 - 2 * least))
    return rows, exact_scores(x[rows], query)


def _clean(vectors: DataFrame) -> DataFrame:
    value = F.col("embedding")
    usable = (
        F.col("vec_id").isNotNull()
        & F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(value, lambda v: v != 0)
    )
    return vectors.select("vec_id", value.cast("array<double>").alias("embedding")).where(usable)


def nearest(vectors: DataFrame, is_query: Column, *, k: int = 5, confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of every row where ``is_query`` holds."""
    spark = vectors.sparkSession
    clean = _clean(vectors)
    sizes = clean.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    width, quantile = sizes.n, chi_square_quantile(confidence, DIMS)
    clean = settle(clean.where(F.size("embedding") == width).distinct(), "knn-vectors")
    total = clean.count()
    directions = np.random.default_rng(SEED).normal(size=(width, DIMS))

    share = min(1.0, SAMPLE / total)
    picked = clean.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    sample = _matrix(picked.select("embedding").limit(SAMPLE).toArrow().column(0).combine_chunks())
    tree = grow(_unit(sample) @ directions if len(sample) else np.zeros((0, DIMS)), min(MAX_LEAVES, total // LEAF))
    # The tree has MAX_LEAVES cells of DIMS bounds at most.
    shared = spark.sparkContext.broadcast((directions, vars(tree)))

    # Equal vectors: one row with the k + 1 smallest ids. The ranks are cut in the map tasks first.
    alike = Window.partitionBy("hash", "embedding").orderBy("vec_id")
    different = (
        clean.withColumn("hash", F.xxhash64("embedding"))
        .withColumn("place", F.row_number().over(alike))
        .where(F.col("place") <= k + 1)
        .groupBy("hash", "embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select("ids", "embedding")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, parts = shared.value
        tree = Tree(**parts)
        for batch in batches:
            cell = tree.cells(_unit(_matrix(batch.column("embedding"))) @ directions) if len(batch) else []
            columns = [batch.column("ids"), batch.column("embedding"), pa.array(cell, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["ids", "embedding", "cell"])

    points = settle(different.mapInArrow(place, "ids array<long>, embedding array<double>, cell long"), "knn-cells")
    blocks = {r.cell: -(-r["count"] // BLOCK) for r in points.groupBy("cell").count().collect()}
    cells = spark.createDataFrame([(c, n) for c, n in blocks.items()], "cell long, blocks int")
    points = points.join(F.broadcast(cells), "cell").withColumn(
        "block", F.pmod(F.xxhash64(F.get("ids", F.lit(0))), "blocks").cast("int")
    )

    queries = clean.where(is_query).select(F.col("vec_id").alias("query_id"), "embedding")
    hits = spark.createDataFrame([], "query_id long, vec_id long, score double")
    done, step = 0, 1
    while done < len(tree.low):
        routed = settle(_route(queries, hits, shared, done, step, quantile, k), "knn-routes")
        visitors = {r.cell: r["count"] for r in routed.groupBy("cell").count().collect()}
        if not visitors:
            break
        hits = settle(_visit(routed, points, visitors, blocks, hits, shared, quantile, k), "knn-hits")
        done += step
        step *= 3
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score")


def _route(queries: DataFrame, hits: DataFrame, shared, done: int, step: int, quantile: float, k: int) -> DataFrame:
    """The next ``step`` cells of each query that the stopping test leaves open."""
    kth = hits.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.greatest(F.lit(0.0), 2 - 2 * F.min("score")) + 1e-9).alias("reach")
    )
    rows = queries.join(kth, "query_id", "left").withColumn("reach", F.coalesce("reach", F.lit(5.0)))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, parts = shared.value
        tree = Tree(**parts)
        for batch in batches:
            if not len(batch):
                continue
            lower = tree.distances(_unit(_matrix(batch.column("embedding"))) @ directions)
            order = np.argsort(lower, 1, kind="stable")[:, done : done + step]
            reach = batch.column("reach").to_numpy()
            # A query that has fewer than k neighbours so far goes on in any case.
            limit = np.where(reach < 5, reach * quantile, np.inf)
            row, col = np.nonzero(np.take_along_axis(lower, order, 1) <= limit[:, None])
            some = batch.take(pa.array(row))
            columns = [*some.columns, pa.array(order[row, col].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "embedding", "reach", "cell"])

    return rows.select("query_id", "embedding", "reach").mapInArrow(
        route, "query_id long, embedding array<double>, reach double, cell long"
    )


def _visit(routed, points, visitors, blocks, hits, shared, quantile: float, k: int) -> DataFrame:
    """The k best hits of every query after its visits."""
    spark = routed.sparkSession
    # One row per visited cell; there are MAX_LEAVES at most.
    plan = [(c, -(-n // PACK), blocks.get(c, 0)) for c, n in visitors.items()]
    plan = F.broadcast(spark.createDataFrame(plan, "cell long, packs int, into int"))
    left = (
        routed.join(plan, "cell")
        .where("into > 0")
        .withColumn("pack", F.pmod(F.xxhash64("query_id"), "packs").cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("into") - 1)))
        .select("cell", "block", "pack", "query_id", "embedding", "reach")
    )
    right = (
        points.join(plan, "cell")
        .withColumn("pack", F.explode(F.sequence(F.lit(0), F.col("packs") - 1)))
        .select("cell", "block", "pack", "ids", "embedding")
    )

    def search(visiting: pa.Table, held: pa.Table) -> pa.Table:
        found: list[list] = [[], [], []]
        if len(visiting) and len(held):
            directions, _ = shared.value
            x = _matrix(held.column("embedding").combine_chunks())
            q = _matrix(visiting.column("embedding").combine_chunks())
            unit = _unit(x)
            px, pq = unit @ directions, _unit(q) @ directions
            apart = (pq * pq).sum(1)[:, None] + (px * px).sum(1)[None] - 2 * pq @ px.T
            ids = held.column("ids").to_pylist()
            for i, (query, reach) in enumerate(
                zip(visiting.column("query_id").to_pylist(), visiting.column("reach").to_pylist(), strict=True)
            ):
                reach = reach if reach < 5 else math.inf
                rows, score = verify(q[i], reach, x, unit, apart[i], quantile, k)
                near = [(-s, v) for r, s in zip(rows.tolist(), score.tolist(), strict=True) for v in ids[r] if v != query]
                for s, v in sorted(near)[:k]:
                    for column, value in zip(found, (query, v, -s), strict=True):
                        column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.float64())
        arrays = [pa.array(f, t) for f, t in zip(found, kinds, strict=True)]
        return pa.Table.from_arrays(arrays, ["query_id", "vec_id", "score"])

    keys = ("cell", "block", "pack")
    new = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    new = new.applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.unionAll(new).withColumn("place", F.row_number().over(best))
    return ranked.where(F.col("place") <= k).drop("place")
