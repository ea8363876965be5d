import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerproof.llm import neighbours as nn
from ledgerproof.llm.queries import QUERIES


def by_hand(rows, k):
    usable = {
        i: np.array(v, float)
        for i, v in rows
        if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)
    }
    out = {}
    for q in (i for i in usable if i % 50 == 0):
        near = sorted(
            (-float(usable[q] @ v / math.sqrt((usable[q] @ usable[q]) * (v @ v))), i) for i, v in usable.items() if i != q
        )
        out[q] = near[:k]
    return out


def test_quantile_of_chi_square():
    # Known values of the distribution.
    assert abs(nn.chi_square_quantile(0.95, 2) - 5.991) < 1e-3
    assert abs(nn.chi_square_quantile(0.95, 16) - 26.296) < 1e-3
    assert abs(nn.chi_square_quantile(0.5, 10) - 9.342) < 1e-3


def test_tree_deals_and_bounds():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(500, 4))
    tree = nn.grow(points[:200], 16)
    cells = tree.cells(points)
    assert len(tree.low) == 16 and set(cells) == set(range(16))
    lower = tree.distances(points[:20])
    for i in range(20):
        true = ((points - points[i]) ** 2).sum(1)
        assert all(lower[i, c] <= true[cells == c].min() + 1e-12 for c in range(16))
        assert lower[i, cells[i]] == 0
    assert len(nn.grow(np.ones((50, 4)), 16).low) == 1
    assert (nn.grow(np.zeros((0, 4)), 16).cells(points) == 0).all()


@pytest.mark.parametrize("confidence", [0.96, 1 - 1e-9])
def test_recall_with_many_cells(spark, monkeypatch, confidence):
    monkeypatch.setattr(nn, "LEAF", 40)
    monkeypatch.setattr(nn, "BLOCK", 60)
    monkeypatch.setattr(nn, "PACK", 3)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    x = centres[rng.integers(0, 12, 1500)] + 0.6 * rng.normal(size=(1500, 24))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    found = nn.nearest(vectors, F.col("vec_id") % 50 == 0, confidence=confidence).collect()
    wanted, hits = by_hand(rows, 5), 0
    for r in found:
        hits += r.vec_id in {i for _, i in wanted[r.query_id]}
    share = hits / sum(map(len, wanted.values()))
    assert share >= 0.9 if confidence < 0.99 else share == 1


def test_cases(spark):
    rows = [(i, [1.0, float(i % 7), 2.0]) for i in range(1, 160)]
    rows += [(150, [1.0, 3.0, 2.0])]  # the same row twice
    rows += [(200, None), (250, []), (300, [0.0, 0.0, 0.0]), (350, [1.0, None, 1.0]), (400, [1.0, float("nan"), 1.0])]
    rows += [(450, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (0, [2.0, 4.0, 4.0]), (500, [-1.0, -1.0, -1.0])]
    vectors = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, cell string, score int")
    got = nn.nearest(vectors, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    wanted = by_hand(dict.fromkeys((i, tuple(v) if v is not None else None) for i, v in rows), 5)
    assert [r.query_id for r in got] == [q for q in sorted(wanted) for _ in range(5)]
    for r in got:
        score, vec = wanted[r.query_id][r.rank - 1]
        assert abs(r.score + score) < 1e-12
    # Equal vectors tie; the smaller id comes first.
    assert [r.vec_id for r in got if r.query_id == 50] == [1, 8, 15, 22, 29]


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(50, [1.0, 0.0]), (7, [0.0, 1.0]), (100, [1.0, 1.0])], schema)
    got = nn.nearest(few, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(50, 1, 100), (50, 2, 7), (100, 1, 7), (100, 2, 50)]
    alone = spark.createDataFrame([(50, [1.0, 0.0])], schema)
    assert nn.nearest(alone, F.col("vec_id") % 50 == 0).count() == 0
    assert nn.nearest(spark.createDataFrame([], schema), F.lit(True)).count() == 0


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    wanted = by_hand(rows, 5)
    found = QUERIES["op2_projected_neighbours"](spark, sf).collect()
    hits = sum(r.vec_id in {i for _, i in wanted[r.query_id]} for r in found)
    assert hits >= 0.9 * sum(map(len, wanted.values()))
