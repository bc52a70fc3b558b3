import math
import random

import numpy as np
import pytest
from conftest import SF01
from parity import compare, duck
from pyspark.sql import functions as F
from sessionmart.llm.hard_negatives import Vectors, mine, primes_for, scores
from sessionmart.llm.registry import ORACLE, QUERIES

SHAPE = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor, positives=5, negatives=3):
    """Results by plain integers; rows: (id, vector, label), a missing id counts as the largest."""
    ok = [(math.inf if i is None else i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
          if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v, y) in enumerate(ok):
        if i == math.inf or not anchor(i):
            continue
        near = sorted((-sum(p * q for p, q in zip(v, w)), j, z) for b, (j, w, z) in enumerate(ok) if b != a)
        for s, p, _ in [x for x in near if x[2] == y][:positives]:
            inside = [x for x in near if x[2] != y and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(i, p, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(inside)]
    return sorted((a, None if p == math.inf else p, r, None if n == math.inf else n, s, t) for a, p, r, n, s, t in out)


def key(t):
    return tuple((x is None, x or 0) for x in t)


@pytest.mark.parametrize("size, dim", [(1, 3), (40, 64), (3000, 200), (2e5, 300), (6e7, 130)])
def test_residue_products_are_exact(size, dim):
    r = np.random.default_rng(3)
    x = [np.floor(r.normal(size=dim) * size) for _ in range(40)] + [np.zeros(0), np.full(dim // 2, -size), np.full(dim, size)]
    primes = primes_for(max(float((v * v).sum()) for v in x))
    a = Vectors(x, primes, 1.0)
    got = scores(a, a.take(np.arange(5, len(x))), primes)
    for i, v in enumerate(x):
        for j, w in enumerate(x[5:]):
            assert int(got[i, j]) == sum(int(p) * int(q) for p, q in zip(v, w))


def test_scores_beyond_sixty_bits_are_refused(spark):
    rows = [(0, [1e9, 1e9], 1), (1, [1e9, 1.0], 1)]
    with pytest.raises(ValueError):
        mine(spark.createDataFrame(rows, SHAPE), F.col("vec_id") == 0)


@pytest.mark.parametrize("block_values", [1 << 20, 300])
def test_results_equal_plain_integers(spark, block_values):
    r = random.Random(4)
    base = [[r.gauss(0, 0.3) for _ in range(9)] for _ in range(6)]
    near = lambda v: [x + r.gauss(0, 0.2) for x in v]
    rows = [(i, near(base[r.randrange(6)]), r.randrange(4)) for i in range(700)]
    rows += [(r.randrange(700), [round(4 * x) / 4 for x in near(base[0])], r.randrange(4)) for _ in range(300)]  # ties and repeated ids
    rows += [(800 + i, base[1], i % 2) for i in range(400)] + rows[:60]  # copies of one vector; repeated rows
    rows += [(None, base[2], 1), (None, base[2], 2), (2000, None, 1), (2010, base[0], None), (2020, [0.1, None], 1),
             (2030, [float("nan")] * 9, 1), (2040, [float("inf")] * 9, 1), (2050, [], 1), (2060, base[3][:4], 2),
             (2070, base[3] + [1.0] * 300, 2), (2080, [0.0] * 9, 7)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]
    docs = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 as id", "'x' as hash", "2 as line", "3 as vector", "4 as slot", "5 as rank").repartition(5)
    got = mine(docs, F.col("vec_id") % 10 == 0, block_values=block_values)
    want = brute(rows, lambda i: i % 10 == 0)
    assert sorted((tuple(x) for x in got.collect()), key=key) == sorted(want, key=key)
    assert len(want) > 500
    assert mine(docs, F.col("vec_id") < 0).collect() == []
    assert mine(docs.where("false"), F.col("vec_id") % 10 == 0).collect() == []


def test_few_rows_give_few_results(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.75, 1.0], 2), (3, [-1.0, 0.0], 2)]
    got = mine(spark.createDataFrame(rows, SHAPE), F.col("vec_id") == 0).collect()
    assert [tuple(x) for x in got] == [(0, 1, 1, 2, 65536, 49152)]
    assert mine(spark.createDataFrame(rows[:1], SHAPE), F.lit(True)).collect() == []
    assert QUERIES["op11_hard_negatives"](spark, SF01).columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert compare(QUERIES["op11_hard_negatives"](spark, "/root/testdata/sf0.1"), duck("/root/testdata/sf0.1"), ORACLE["op11_hard_negatives"])["values_match"]
