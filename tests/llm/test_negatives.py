"""Hard negatives against brute force and SQL: odd shapes, ties, windows, rows that take no part."""

import math

import numpy as np
import pytest

from riskloom.llm import negatives
from riskloom.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (33, 64, 70), (65, 31, 129), (0, 8, 4), (40, 0, 40)])
def test_product_of_every_shape(shape):
    m, k, n = shape
    rng = np.random.default_rng(m)
    a, b = rng.integers(-(2**20), 2**20, (m, k)), rng.integers(-(2**20), 2**20, (k, n))
    assert (negatives.product(a, b, leaf=4) == a @ b).all()


def test_product_is_exact_where_sums_on_the_way_do_not_fit():
    a = np.full((8, 8), 2**31 - 1)
    b = np.where(np.eye(8, dtype=bool), 2**31 - 1, -3)
    exact = a.astype(object) @ b.astype(object)
    assert (negatives.product(a, b, leaf=2).astype(object) == exact).all()


def test_heap_takes_the_first_of_equal_scores_and_all_if_fewer():
    scores = np.array([[5, 7, 7, 1], [2, 2, 2, 2]])
    allowed = np.array([[True, True, True, True], [False, False, True, False]])
    row, column = negatives.heap(scores, allowed, 3)
    assert [(r, c) for r, c in zip(row.tolist(), column.tolist()) if r == 0] == [(0, 1), (0, 2), (0, 0)]
    assert [(r, c) for r, c in zip(row.tolist(), column.tolist()) if r == 1] == [(1, 2)]


def brute(rows):
    """Row by row, with plain numbers; ``rows`` are (vec_id, vector, label)."""
    held = {}
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        row = (label, [math.floor(256 * float(np.float32(x))) for x in vector])
        held[vec_id] = min(held.get(vec_id, row), row)
    found = []
    for anchor, (own, a) in held.items():
        if anchor % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, label) for i, (label, v) in held.items() if i != anchor)
        for score, positive, _ in [row for row in scored if row[2] == own][:5]:
            inside = [r for r in scored if r[2] != own and 50 * -score <= 100 * -r[0] <= 95 * -score][:3]
            found += [(anchor, positive, rank, r[1], -score, -r[0]) for rank, r in enumerate(inside, 1)]
    return sorted(found)


def test_edge_cases(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(0, 4, 6) / 4).tolist(), int(i % 3)) for i in range(120)]
    rows += [(i, [0.5] * 6, 1) for i in range(120, 160)]  # equal vectors
    rows += [(150, [0.5] * 6, 1), (150, [0.25] * 6, 0)]  # repeated ids
    rows += [(200, None, 1), (201, [1.0, None], 1), (202, [math.nan, 1.0], 1), (203, [math.inf], 2), (None, [1.0], 1)]
    rows += [(204, [1.0, 0.5], 2), (205, [], 1), (250, [-1.0] * 6, 1), (206, [0.1] * 6, None), (300, [0.3, 0.2], 0)]
    schema = "vec_id long, embedding array<float>, label int, id string, vector int, slot string, block int"
    wide = spark.createDataFrame([(*row, "x", 1, "s", 2) for row in rows], schema)
    wide.write.parquet(str(tmp_path / "full" / "embeddings.parquet"))
    found = sorted(map(tuple, negatives.query(spark, str(tmp_path / "full")).collect()))
    assert found == brute(rows) and found
    wide.where("false").write.parquet(str(tmp_path / "none" / "embeddings.parquet"))
    assert negatives.query(spark, str(tmp_path / "none")).count() == 0


def test_too_large_components_take_no_part(spark):
    rows = spark.createDataFrame([(1, 0, [1e300]), (2, 0, [1.0]), (3, 0, [1e18])], "id long, label int, vector array<double>")
    assert [row.id for row in negatives.prepared(rows).collect()] == [2]


def test_query_equals_sql(spark, folder):
    name = "op12_strassen_negatives"
    assert compare(spark, connect(folder), QUERIES[name], ORACLES[name], folder) is None
