import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulelake.llm.common import read_table
from rulelake.llm.hardneg import bins, bounds, centroids_of, angles, directions, hard_negatives, op13_hard_negatives, packed, products, unpacked

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                     T.StructField("label", T.IntegerType())])
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, scale=256, k=5):
    live = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        live.append((i, label, [math.floor(scale * float(x)) for x in v]))
    out = []
    for n, (i, label, v) in enumerate(live):
        if i % 100:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), j, m == label, at) for at, (j, m, w) in enumerate(live)]
        scores.sort()
        for ps, pj, *_ in [s for s in scores if s[2] and s[3] != n][:k]:
            inside = [s for s in scores if not s[2] and 80 * -ps <= 100 * -s[0] <= 100 * -ps][:k]
            out += [(i, pj, r + 1, s[1], -ps, -s[0]) for r, s in enumerate(inside)]
    return sorted(out)


def shown(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def mine(spark, rows, **how):
    return shown(hard_negatives(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 100 == 0, **how))


def relabelled(rows):
    return [(i, v, None if m is None else (m + 1) % 10 if i % 7 == 0 else m) for i, v, m in rows]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in read_table(spark, sf, "embeddings").select("vec_id", "embedding", "label").collect()]
    want = brute(relabelled(rows))
    assert want and shown(op13_hard_negatives(spark, sf)) == want


@pytest.mark.parametrize("how", [dict(cluster=3, head=40, segment=30, chunk=2), dict(cluster=1, head=10, segment=500, chunk=1)])
def test_lists_in_parts(spark, how):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((6, 8))
    rows = [(i * 20, (centre[i % 6] * rng.uniform(0.2, 3) + 0.3 * rng.standard_normal(8)).tolist(), int(rng.integers(3)))
            for i in range(120)]
    want = brute(rows)
    assert want and mine(spark, rows, **how) == want


def test_hot_vector_ties_and_repeated_rows(spark):
    rng = np.random.default_rng(4)
    same = [0.5, -0.25, 0.125]
    rows = [(i, same, i % 3) for i in range(60)] + [(100, same, 1), (100, same, 1)]
    rows += [(i, (rng.standard_normal(3) * 0.5).tolist(), i % 4) for i in range(60, 130) if i != 100]
    want = brute(rows)
    assert want and mine(spark, rows, cluster=1, head=8, segment=8, chunk=1) == want


def test_rows_that_take_no_part_and_few_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [float("nan"), 1.0], 2), (4, [float("inf"), 1.0], 2),
            (5, [0.9, 0.1], None), (None, [0.9, 0.1], 2), (6, [1.0, 0.2], 1), (7, [0.95, 0.3], 2), (8, [0.0, 0.0], 1),
            (100, [0.0, 0.0], 2), (9, [-1.0, 0.1], 2), (200, [-1.0, 0.0], 3)]
    want = brute(rows)
    assert {w[0] for w in want} == {0, 100} and mine(spark, rows) == want


def test_empty_table_and_no_anchor(spark):
    assert mine(spark, []) == [] and mine(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_large_and_small_numbers(spark):
    rows = [(0, [3.0e6, 1.0], 1), (1, [3.0e6, 2.0], 1), (2, [2.9e6, 5.0], 2), (3, [2.5e6, 1e9], 2), (4, [1e-300, 1.0], 2),
            (100, [1e-300, 1e-200], 1), (200, [1e-3, 1.0], 2), (5, [7.0, 1.0], 2), (6, [6.5, 1.0], 1)]
    big = brute(rows)
    limit = 2 ** 63 - 1
    assert max(max(w[4:]) for w in big) > 2 ** 53 and mine(spark, rows) == big
    assert mine(spark, [(0, [1e200, 1.0], 1), (1, [1e200, 1.0], 1), (2, [1e199, 1.0], 2)]) == [(0, 1, 1, 2, limit, limit)]


def test_clashing_columns(spark):
    rows = [(0, [1.0, 0.0], 1), (6, [1.0, 0.2], 1), (7, [0.95, 0.3], 2)]
    df = spark.createDataFrame(rows, ROWS)
    for c in ("row", "id", "vec", "ask", "cluster", "need", "rank"):
        df = df.withColumn(c, F.lit("x"))
    assert shown(hard_negatives(df, F.col("vec_id") % 100 == 0)) == brute(rows)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x, a = rng.standard_normal((300, 5)) * 100, rng.standard_normal((40, 5)) * 7
    centre = centroids_of(a, 4)
    unit, length = directions(a)
    apart = angles(unit, centre)
    own = apart.argmin(1)
    widths = np.array([apart[own == c, c].max(initial=0) for c in range(4)])
    top = bounds(x, centre, widths)
    assert (a @ x.T <= length[:, None] * top[:, own].T * (1 + 1e-9) + 1e-9).all()
    order = np.sort(top[:, 0])
    assert (np.diff(bins(order)) >= 0).all()


def test_packed_round_trip_and_exact_products():
    x = np.array([[1.0, -32767.0], [40000.0, 2.0]])
    assert (unpacked(packed(x)) == x).all()
    a, b = np.array([[2.0 ** 40, 1.0]]), np.array([[2.0 ** 20, 3.0]])
    assert products(a, b)[0, 0] == 2 ** 60 + 3
