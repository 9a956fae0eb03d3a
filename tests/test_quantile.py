"""Exact quantiles by selection against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerscope.functions import quantile


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_order_statistics(spark, monkeypatch, bins):
    monkeypatch.setattr(quantile, "BINS", bins)
    r = random.Random(bins)
    rows = [(r.choice([True, False, None]), r.choice([None, -5, r.randrange(10), r.randrange(10**9)])) for _ in range(300)] + [(True, 10**12)]
    df = spark.createDataFrame(rows, "g boolean, v long").repartition(5)
    for q in (0.0, 0.5, 0.95, 1.0):
        got = quantile.grid_quantiles(df, F.col("v"), q, 100, F.col("g"))
        assert got.keys() == {True, False, None}
        for g, x in got.items():
            want = np.quantile([v / 100 for h, v in rows if h is g and v is not None], q)
            assert x == pytest.approx(want, rel=1e-12, abs=1e-9)


def test_no_rows_and_one_value(spark):
    df = spark.createDataFrame([(7,), (7,), (7,)], "v long")
    assert quantile.grid_quantiles(df, F.col("v"), 0.3, 1) == {0: 7.0}
    assert quantile.grid_quantiles(df.limit(0), F.col("v"), 0.3, 1) == {}
