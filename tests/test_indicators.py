import math
import random
from itertools import permutations

import pytest
from faunagrid.functions.stats import lgamma
from faunagrid.operators.indicators import calc_indicators, summary
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

UNIT = [("a", "sp1", 60.0), ("a", "sp2", 30.0), ("a", "sp3", 10.0), ("b", "sp1", 5.0)]


def by_cell(df):
    return {r.cell: r for r in df.collect()}


def test_unit_frame(spark):
    got = by_cell(calc_indicators(spark.createDataFrame(UNIT, "cell string, species string, records double")))
    a, b = got["a"], got["b"]
    assert {*got} == {"a", "b"}
    assert (a.n, a.sp, a.maxp) == (100, 3, 0.6)
    assert a.shannon == pytest.approx(0.8979457248567797) and a.simpson == pytest.approx(0.46) and a.es == pytest.approx(2.9994065803258)
    assert (b.n, b.sp, b.shannon, b.simpson, b.es) == (5, 1, 0, 1, None)
    assert a.hill_1 == pytest.approx(math.exp(a.shannon)) and a.hill_2 == pytest.approx(1 / 0.46) and a.hill_inf == pytest.approx(1 / 0.6)


@pytest.mark.parametrize("kind", ["long", "double"])
def test_simpson_does_not_depend_on_the_order_of_species(spark, kind):
    orders = [*enumerate(permutations((14, 17, 13, 20, 16)))]  # 1310 / 6400 = 0.2046875, a tie of six places
    rows = [(cell, f"s{i}", n) for cell, counts in orders for i, n in enumerate(counts)]
    df = spark.createDataFrame(rows, "cell long, species string, records long").withColumn("records", F.col("records").cast(kind))
    got = calc_indicators(df).select("simpson", "hill_2", F.round("simpson", 6)).distinct().collect()
    assert [tuple(r) for r in got] == [(1310 / 6400, 6400 / 1310, 0.204688)]


def test_simpson_of_large_counts(spark):
    counts = [2**62, 2**61 + 1, 2**40 + 3, 94906267, 1]  # squares beyond 2^53, and beyond 2^64
    df = spark.createDataFrame([(c, f"s{(i + c) % 5}", n) for c in range(5) for i, n in enumerate(counts)], "cell long, species string, records long")
    squares, whole = sum(n * n for n in counts), sum(counts) ** 2
    assert {(r.simpson, r.hill_2) for r in calc_indicators(df).collect()} == {(float(squares) / float(whole), float(whole) / float(squares))}


def test_other_columns_and_nulls(spark):
    rows = [("a", None, 3, 1), ("a", "x", None, 2), ("a", "x", 7, 3), (None, "x", 2, 4)]
    got = by_cell(calc_indicators(spark.createDataFrame(rows, "cell string, species string, records long, n int")))
    assert (got["a"].n, got["a"].sp) == (10, 2)
    assert (got[None].n, got[None].sp) == (2, 1)


def test_no_records_at_all(spark):
    got = by_cell(calc_indicators(spark.createDataFrame([("a", "x", 0), ("b", "x", 0), ("b", "y", 4)], "cell string, species string, records long")))
    assert (got["a"].n, got["a"].sp, got["a"].simpson, got["a"].hill_2) == (0, 1, None, None)
    assert (got["b"].n, got["b"].sp, got["b"].shannon) == (4, 2, 0)
    assert calc_indicators(spark.createDataFrame([], "cell string, species string, records long")).count() == 0


@pytest.mark.parametrize("esn", ["50", None, -1, True, float("inf")])
def test_bad_sample_size(spark, esn):
    with pytest.raises(ValueError, match="sample size"):
        calc_indicators(spark.createDataFrame(UNIT, "cell string, species string, records double"), esn)


def test_bad_input(spark):
    with pytest.raises(ValueError, match="records"):
        calc_indicators(spark.createDataFrame([("a", "x")], "cell string, species string"))
    with pytest.raises(TypeError):
        calc_indicators([1])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 40), min_size=1, max_size=8))
def test_properties(spark, counts):
    df = spark.createDataFrame([("c", f"s{i}", n) for i, n in enumerate(counts)], "cell string, species string, records long")
    n, sp = sum(counts), len(counts)
    es = {m: calc_indicators(df, m).first().es for m in (0, 1, 2, 1.5, n)}
    assert es[0] == 0 and es[1] == pytest.approx(1)
    assert es[n] == pytest.approx(sp)
    if n >= 2:
        assert es[2] == pytest.approx(2 - sum(k * (k - 1) for k in counts) / (n * (n - 1)))
        assert 1 - 1e-9 <= es[1.5] <= es[2] + 1e-9
    r = calc_indicators(df).first()
    assert 1 - 1e-9 <= r.hill_inf <= r.hill_2 + 1e-9 and r.hill_2 <= r.hill_1 + 1e-9 and r.hill_1 <= sp + 1e-9


def test_lgamma(spark):
    xs = [1.0, 2.0, 3.5, 10.0, 1234.5, 1e6]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", lgamma(F.col("x")).alias("y")).collect()
    for r in got:
        assert r.y == pytest.approx(math.lgamma(r.x), abs=1e-9, rel=1e-13)


def test_summary(spark):
    values = [random.Random(1).random() for _ in range(200)]
    got = summary(spark.createDataFrame([(v,) for v in values] + [(None,)], "value double")).first()
    assert (got.min, got.max, got.n) == (min(values), max(values), 200)
    assert got.p02 <= got.p98
