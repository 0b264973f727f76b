"""WIN-5/6/7: the window formulation equals the definition of the centred mean, position by
position."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seasonflow.operators import seasonality as S


def naive_ma(values, order):
    """From the definition: position p is the mean over max(0, p-h) .. min(n-1, p+h), with
    h = order // 2; an even order's full windows weigh their two ends by half."""
    n, h = len(values), order // 2
    if order > n or order <= 2:
        raise ValueError
    out = []
    for p in range(n):
        window = {i: 1.0 for i in range(max(0, p - h), min(n - 1, p + h) + 1)}
        if order % 2 == 0 and h <= p < n - h:
            window[p - h] = window[p + h] = 0.5
        out.append(sum(values[i] * w for i, w in window.items()) / sum(window.values()))
    return out


def spark_ma(spark, values, order):
    rows = [("R", "P", str(200000 + 100 * (i // 52) + (i % 52) + 1), float(v))
            for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "regionid string, product string, yearweek string, qty double")
    out = S.moving_average(df, order=order).orderBy(F.col("yearweek").cast("int")).collect()
    return [r["ma"] for r in out]


@settings(max_examples=12, deadline=None)
@given(st.integers(min_value=3, max_value=18), st.integers(min_value=0, max_value=10**6))
def test_window_equals_naive(spark, order, seed):
    rnd = random.Random(seed)
    n = rnd.randint(order, order + 60)
    values = [float(rnd.randint(0, 500)) for _ in range(n)]
    got = spark_ma(spark, values, order)
    want = naive_ma(values, order)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w, rel=1e-12, abs=1e-9)


def test_order_17_reference_length(spark):
    values = [float(v) for v in range(1, 157)]  # 3 years x 52 weeks
    assert spark_ma(spark, values, 17) == pytest.approx(naive_ma(values, 17))


def test_order_must_exceed_two():
    with pytest.raises(ValueError):
        S.centred_ma(order=2)
