"""Exact search against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import topk


def plain(rows, k, every):
    def q(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * x) for x in v]

    vectors = [(i, q(v)) for i, v in rows if i is not None and q(v) is not None]
    out = []
    for i, a in vectors:
        if i % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in vectors if j != i)
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string, score string")
    got = topk.top_k(df, df.filter("vec_id % 10 = 0"), 5, **how)
    return sorted(map(tuple, got.collect()))


def test_equals_brute_force_with_ties_and_odd_rows(spark):
    random.seed(1)
    rows = [(i, [random.choice([-0.5, 0.0, 0.25, 0.75]) for _ in range(6)]) for i in range(300)]
    # A third of the rows hold one vector.
    rows += [(i, [0.5, 0.5, -0.25, 0.0, 0.1, 0.2]) for i in range(300, 450)]
    odd = [(450, None), (460, []), (470, [0.1] * 5 + [None]), (480, [float("nan")] + [0.0] * 5), (490, [float("inf")] + [0.0] * 5), (500, [1.0, 1.0]), (None, [1.0] * 6)]
    # The engine takes floats as doubles.
    import numpy as np

    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows] + odd
    want = plain(rows, 5, 10)
    full = [(i, v, "x", "y") for i, v in rows]
    random.shuffle(full)
    assert run(spark, full) == want
    assert run(spark, full, block_rows=64, group_queries=7) == want


def test_large_values_few_rows_and_empty_table(spark):
    rows = [(0, [3000.0, -7.5], "", ""), (10, [-2999.0, 1.0], "", ""), (3, [0.001, 0.0], "", "")]
    got = run(spark, rows)
    assert [r[:3] for r in got] == [r[:3] for r in plain([r[:2] for r in rows], 5, 10)]
    assert run(spark, []) == []
    # No finite vector is left out; only a score that no long holds is an error.
    rows = [(0, [2.0**40, 0.0]), (1, [0.0, 2.0**40]), (2, [2.0**-8, 3.0]), (3, [1e-30, 2.0]), (10, [1.0, 16.0]), (4, [-2.0, 1.0])]
    assert run(spark, [(*r, "", "") for r in rows]) == plain(rows, 5, 10) != []
    with pytest.raises(Exception, match="does not fit a long"):
        run(spark, [(0, [1e30], "", ""), (1, [1.0], "", "")])


def test_query_columns(spark):
    got = topk.op3_topk(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    n = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").filter("vec_id % 50 = 0").count()
    assert got.groupBy("query_id").agg(F.count("*").alias("n")).filter("n = 5").count() == n


def test_no_block_becomes_one_row(spark):
    df = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(300)], "vec_id long, embedding array<float>")
    plan = topk.top_k(df, df, 5, block_rows=64, group_queries=7)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "MapInArrow" in plan


def test_copies_of_a_row_do_not_grow_a_block(spark):
    block = topk.Block(2, 100)
    for i in range(200):
        block.add(np.arange(20), np.arange(40.0).reshape(20, 2) + i % 2)
        assert block.held <= 240
    assert block.best(np.array([19]), np.array([[1.0, 1.0, 9.0]])) == [(19, 18, 75), (19, 18, 75)]


def test_repeated_rows_odd_widths_and_large_values_in_small_blocks(spark):
    random.seed(2)
    rows = [(random.randrange(40), [random.choice([-3.0, 0.5, 2.0]) for _ in range(random.randrange(5))]) for _ in range(400)]
    rows += [(10, [1.0, 2.0])] * 90 + [(7, [2.0**24, -1.0])] * 3 + [(8, [0.0, 2.0**33, 0.0])] * 7
    # Queries that share an id are one query that scores with each of its vectors.
    padded = [(i, [math.floor(256 * x) for x in v] + [0] * (4 - len(v))) for i, v in rows]
    best = {}
    for q, a in {(q, tuple(a)) for q, a in padded if q % 10 == 0}:
        best.setdefault(q, []).extend((-sum(x * y for x, y in zip(a, b)), i) for i, b in padded if i != q)
    want = sorted((q, n + 1, i, -s) for q, found in best.items() for n, (s, i) in enumerate(sorted(found)[:5]))
    full = [(*r, "", "") for r in rows]
    assert run(spark, full) == want
    assert run(spark, full, block_rows=16, group_queries=3) == want
