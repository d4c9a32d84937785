import math

import numpy as np
import pytest

from periodica.llm.embedding_join import GridRules, near_vectors, op7_grid_order
from .brute import cosine_groups

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def _rows(n, dims, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    rows = []
    for i in range(n):
        x = centres[i % 12] + spread * rng.normal(size=dims) * rng.random()
        rows.append((i, x.astype(np.float32).tolist(), int(rng.integers(0, 3)) if i % 17 else None))
    return rows


def _compare(spark, rows, rules):
    got = near_vectors(spark.createDataFrame(rows, SCHEMA), rules).collect()
    want = cosine_groups(rows, rules.cosine)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and len(got) == len(rows)
    return sum(n for n, _ in want.values())


@pytest.mark.parametrize("dims,spread", [(2, 0.3), (5, 0.25), (16, 0.12)])
def test_matches_brute_force(spark, dims, spread):
    rules = GridRules(directions=3, block=16, leaf=4)
    assert _compare(spark, _rows(400, dims, dims, spread), rules) > 100


def test_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = op7_grid_order(spark, SF).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == cosine_groups(rows, 0.98)


def test_edges(spark):
    x = [1.0, 2.0, 3.0]
    rows = [(1, x, 0), (2, x, 0), (3, [2.0, 4.0, 6.0], 0), (4, x, None), (5, None, 0), (6, [0.0, 0.0, 0.0], 0), (7, [math.nan, 1.0, 1.0], 0),
            (8, [None, 1.0, 1.0], 0), (9, [math.inf, 1.0, 1.0], 0), (10, [], 0), (11, [1.0, 2.0], 0), (12, x, 1), (13, [-1.0, -2.0, -3.0], 0)]
    rules = GridRules(block=2, leaf=1)
    assert _compare(spark, rows, rules) == 6
    same = near_vectors(spark.createDataFrame([(5, x, 0), (5, x, 0), (None, x, 0), (None, [3.0, 0.0, 0.0], 0)], SCHEMA), rules).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id) for r in same if r.component_id) == [(-1, 2, 5), (5, 2, 5), (5, 2, 5)]
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    wide = spark.createDataFrame([(1, x, 0, "a", 2)], SCHEMA + ", cid string, size int")
    assert near_vectors(wide).collect()[0].kept
