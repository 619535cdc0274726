import math
import random

import numpy as np
import pytest

from tallycast.llm import queries, topk
from tests import oracle


def brute(rows, count=5, step=50):
    sound = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (query, q) in enumerate(sound):
        if query % step:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), i) for other, (i, v) in enumerate(sound) if other != at]
        out += [(query, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:count])]
    return sorted(out)


def result(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def make(spark, rows, extra=False):
    schema = "vec_id bigint, embedding array<float>" + (", id int, `rank` string, block int, `values` int" if extra else "")
    return spark.createDataFrame([(*r, 1, "x", 2, 3) if extra else r for r in rows], schema)


@pytest.mark.parametrize("block", [20, 2048])
def test_search_follows_the_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "LEAST_BLOCK", 10)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.5, rng.uniform(-1, 1)]) for _ in range(rng.choice([4, 6]))]) for i in range(300)]
    rows += [(i, list(rows[7][1])) for i in range(300, 420)]  # a very common vector
    rows += [(450, [0.0] * 6), (500, [1e9, -3.0, 0.5]), (501, []), (550, []), (-50, [1.0] * 5)]
    rng.shuffle(rows)
    assert result(topk.top_products(make(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.1, 0.2]), (0, [0.1, 0.2]), (1, None), (2, [None, 0.5]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [0.3, -0.2])]
    rows += [(None, [0.5, 0.5]), (50, [0.7, 0.1]), (50, [0.2, 0.9])]
    assert result(topk.top_products(make(spark, rows, extra=True))) == brute(rows)
    assert topk.top_products(make(spark, [])).count() == 0
    assert topk.top_products(make(spark, [(1, [0.5])])).count() == 0
    assert topk.top_products(make(spark, [(50, [0.5])])).count() == 0


def test_reading_stops_early():
    rng = np.random.default_rng(2)
    vectors = rng.integers(0, 4, (2000, 6))
    vectors[100:110] = 100
    lists = topk.SortedLists(np.arange(2000), vectors)
    top, scores, depth = lists.best(np.array([1, 2, 1, 1, 0, 3]), 5)
    assert top.tolist() == [100, 101, 102, 103, 104] and (scores == 800).all() and depth < 100


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    name = "op1_top_products"
    assert oracle.compare(queries.QUERIES[name](spark, folder), oracle.connect(folder), queries.ORACLES[name]) is None
