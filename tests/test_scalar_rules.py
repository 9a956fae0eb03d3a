"""Scalar rule columns on tiny hand-made tables (edge cases)."""

from pyspark.sql import functions as F

from ledgerscope.functions import scalar as S


def test_alert_levels_boundaries(spark):
    rows = [(0.9, 0.1, "CRITICAL"), (0.15, 0.1, "HIGH"), (0.11, 0.1, "MEDIUM"), (0.05, 0.1, "LOW"), (0.3, 0.1, "CRITICAL")]
    df = spark.createDataFrame(rows, "score double, thr double, want string")
    got = df.select(S.alert_level(F.col("score"), F.col("thr")).alias("lvl"), "want").collect()
    assert all(r.lvl == r.want for r in got)


def test_customer_risk_label_and_priority(spark):
    df = spark.createDataFrame([(0.9,), (0.5,), (0.2,), (None,)], "s double")
    got = [r[0] for r in df.select(S.customer_risk_label(F.col("s"))).collect()]
    assert got == ["HIGH", "MEDIUM", "LOW", "UNKNOWN"]
    df2 = spark.createDataFrame([(0.9,), (0.7,), (0.65,)], "s double")
    assert [r[0] for r in df2.select(S.sar_priority(F.col("s"))).collect()] == ["CRITICAL", "HIGH", "MEDIUM"]


def test_cross_border_nulls_count_as_different(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "B"), (None, "A"), (None, None)], "o string, d string")
    got = [r[0] for r in df.select(S.is_cross_border(F.col("o"), F.col("d"))).collect()]
    assert got == [0.0, 1.0, 1.0, 1.0]


def test_zscore_single_row_sender_is_zero_and_clipped(spark):
    from ledgerscope.operators.features import with_sender_zscore

    rows = [("t1", "A", 100, 1.0), ("t2", "B", 100, 1.0), ("t3", "B", 100, 1.0), ("t4", "B", 10**9, 1e7)]
    df = spark.createDataFrame(rows, "transaction_id string, sender_id string, amount_cents long, amount_usd double")
    z = {r.transaction_id: r.amount_z_score_sender for r in with_sender_zscore(df).collect()}
    assert z["t1"] == 0.0
    assert -5.0 <= z["t2"] <= 5.0 and z["t4"] <= 5.0


def test_day_of_week_monday_zero(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23),), (dt.datetime(2024, 1, 7, 0),)], "ts timestamp_ntz")
    got = df.select(S.day_of_week(F.col("ts")), S.hour_of_day(F.col("ts"))).collect()
    assert got[0][0] == 0.0 and got[1][0] == 1.0 and got[0][1] == 1.0


def test_required_columns_assertion(spark):
    import pytest

    from ledgerscope.sources.tables import assert_required_columns

    df = spark.createDataFrame([(1,)], "a int")
    assert_required_columns(df, ["a"])
    with pytest.raises(ValueError):
        assert_required_columns(df, ["a", "b"], "t")
