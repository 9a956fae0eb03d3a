"""Plan guards (no pair-emitting joins anywhere) and exact rounding helpers
checked against Python's Decimal on generated inputs."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerscope.functions import money as M


def test_no_cartesian_or_nested_loop_joins(spark, sf):
    import __spark_entry__ as E

    bad = []
    for key, fn in sorted(E.queries().items()):
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        bad += [(key, p) for p in ("CartesianProduct", "BroadcastNestedLoopJoin") if p in plan]
    assert bad == []


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(1, 10**6)), min_size=1, max_size=20))
def test_integer_ratio_rounding_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(M.ratio_dp(F.col("a"), F.col("b"), 6)).collect()]
    want = [float((Decimal(a) / Decimal(b)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)) for a, b in pairs]
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 5 * 10**8), min_size=1, max_size=30))
def test_avg_usd_is_half_up_mean_of_cents(spark, cents):
    df = spark.createDataFrame([(c,) for c in cents], "c long")
    got = df.select(M.avg_usd(F.col("c"))).first()[0]
    want = float((Decimal(sum(cents)) / Decimal(len(cents))).quantize(Decimal(1), rounding=ROUND_HALF_UP) / 100)
    assert got == want
