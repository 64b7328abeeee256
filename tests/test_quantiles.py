import math
import random

import pytest

from orderflow.operators import quantiles
from orderflow.operators.drift import bin_edges
from orderflow.operators.quantiles import exact_quantiles, rank


def columns(seed, n=4000):
    rnd = random.Random(seed)
    heavy = [math.exp(rnd.gauss(0, 40)) * rnd.choice((-1, 1)) for _ in range(n)]
    ties = [float(rnd.choice((0, 0, 0, 1, 7, -0.0))) for _ in range(n)]
    even = [float(i) for i in range(n)]
    gaps = [rnd.random() if rnd.random() < 0.3 else rnd.choice((None, math.nan)) for _ in range(n)]
    close = [math.nextafter(1.0, 2.0) if rnd.random() < 0.5 else 1.0 for _ in range(n)]
    ends = [rnd.choice((math.inf, -math.inf, 0.0, 5.0, -5.0)) for _ in range(n)]
    return {"heavy": heavy, "ties": ties, "even": even, "gaps": gaps, "close": close, "ends": ends, "nothing": [None] * n}


def expected(values, n):
    top = math.nextafter(math.inf, 0)
    known = sorted(min(max(v, -top), top) + 0.0 for v in values if v is not None and not math.isnan(v))
    return {i: known[rank(i, n, len(known)) - 1] for i in range(1, n)} if known else {}


@pytest.mark.parametrize("few,n", [(50_000, 10), (60, 10), (5, 4), (1, 100)])
def test_equals_sorting(spark, few, n):
    data = columns(few)
    df = spark.createDataFrame(list(zip(*data.values(), strict=True)), ", ".join(f"{c} double" for c in data)).repartition(3)
    got = {}
    for row in exact_quantiles(df, list(data), n, few).collect():
        assert (row.feature, row.position) not in got
        got[row.feature, row.position] = row.edge
    assert got == {(c, i): v for c, values in data.items() for i, v in expected(values, n).items()}


def test_few_rows_reach_the_last_pass(spark, monkeypatch):
    seen = []
    plain = quantiles._read_off
    monkeypatch.setattr(quantiles, "_read_off", lambda df, small, rows, n: seen.append((df, small)) or plain(df, small, rows, n))
    df = spark.range(100_000).selectExpr("cast(id % 9973 as double) as x", "rand(1) as y")
    exact_quantiles(df, ["x", "y"], 10, few=2000).collect()
    (df, small), = seen
    held = quantiles._placed(df, small).where("bin % 2 = 1").groupBy("feature", "bin").count()
    assert max(r["count"] for r in held.collect()) <= 2000
    assert quantiles._placed(df, small).where("bin % 2 = 1").count() < 40_000


def test_edges_are_distinct_and_every_column_has_a_row(spark):
    df = spark.createDataFrame([(float(i % 3), None) for i in range(30)], "x double, empty double")
    assert {r.feature: r.edges for r in bin_edges(df, ["x", "empty"]).collect()} == {"x": [0.0, 1.0, 2.0], "empty": []}
    assert {r.feature: r.edges for r in bin_edges(df.limit(0), ["x"]).collect()} == {"x": []}
