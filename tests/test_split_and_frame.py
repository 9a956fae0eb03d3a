"""Splits by a selected border and the training frame, against the joins that they stand for."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerscope.functions.constants import TRANSACTION_FEATURES as FEATS
from ledgerscope.operators import learning as LE
from ledgerscope.operators import sampling as SA
from ledgerscope.operators.features import transaction_features
from ledgerscope.session import cut_lineage


def _ledger(spark, ids, classes=(False, False, True, None)):
    """One transfer per id (None: no id), every seventh without an amount."""
    rows = [(i, f"CUST_{n % 5}", f"CUST_{n % 3}", None if n % 7 == 3 else 100 * n + 50, classes[n % len(classes)]) for n, i in enumerate(ids)]
    t = spark.createDataFrame(rows, "transaction_id string, sender_id string, receiver_id string, amount_cents long, is_suspicious boolean")
    return cut_lineage(
        t.select(
            "*", (F.col("amount_cents") / 100.0).alias("amount_usd"), F.timestamp_ntz_from_parts(2024, 1, 3, F.lit(4), 5, 6).alias("timestamp")
            if hasattr(F, "timestamp_ntz_from_parts") else F.lit("2024-01-03 04:05:06").cast("timestamp_ntz").alias("timestamp"),
            F.lit("A").alias("country_origin"), F.when(F.col("receiver_id") == "CUST_1", "B").otherwise("A").alias("country_dest"),
            F.lit(False).alias("round_amount"), F.lit(False).alias("rapid_movement"), (F.col("amount_cents") > 3000).alias("structuring_flag"),
        )
    )


def _border_id(n):
    """The id whose hash is at the 15 % border of ids 0..n-1 of one class."""
    import hashlib
    import math

    return sorted((hashlib.md5(f"T{i}:42".encode()).hexdigest(), f"T{i}") for i in range(n))[math.ceil(0.15 * n) - 1][1]


@pytest.mark.parametrize(
    "ids",
    [
        [f"T{i}" for i in range(200)],
        [f"T{i % 150}" for i in range(200)] + [None] * 5,
        [f"T{i}" for i in range(100)] + [_border_id(100)] * 4,
        [None] * 8 + ["T1"],
        ["T1"],
    ],
    ids=["once", "again", "again at the border", "without id", "one"],
)
@pytest.mark.parametrize("classes", [(False, False, True, None), (False,)], ids=["classes", "one class"])
def test_split_is_that_of_the_joined_ranks(spark, ids, classes):
    t = _ledger(spark, ids, classes)
    rows = cut_lineage(t.select("transaction_id", "is_suspicious", "amount_cents", SA.hash_place().alias("_place")))
    wanted = t.select("transaction_id", F.col("is_suspicious").alias("own"), "amount_cents").join(SA.stratified_split(t).select("transaction_id", "split"), "transaction_id")
    got = SA.with_split(rows, rows.select("is_suspicious", "_place"))
    count = lambda df, *c: Counter(map(tuple, df.select(*c).collect()))
    assert count(got, "transaction_id", "is_suspicious", "amount_cents", "split") == count(wanted, "transaction_id", "own", "amount_cents", "split")


def test_training_frame_is_the_join_of_features_and_split(spark):
    t = _ledger(spark, [f"T{i % 90}" for i in range(120)])
    f = transaction_features(t, keep=["is_suspicious"]).join(SA.stratified_split(t).select("transaction_id", "split"), "transaction_id")
    got = LE.training_frame(t)
    cols = ["transaction_id", "is_suspicious", *FEATS, "split"]
    assert got.columns == cols
    key = lambda df: Counter((r[0], r[1], *(round(x, 6) for x in r[2:-1]), r[-1]) for r in df.select(*cols).collect())
    assert key(got) == key(f)


def test_training_frame_sorts_no_rows_by_id(spark, monkeypatch):
    """Rows whose ids differ are neither ranked in hash order nor joined by id."""
    t = _ledger(spark, [f"T{i}" for i in range(400)], (False, False, True))
    monkeypatch.setattr(SA, "prefix_sums", lambda *a, **k: pytest.fail("rows are ranked"))
    plan = LE.training_frame(t)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_fitted_scores_of_ids_that_come_again(spark):
    """An id of n transfers has n rows for each of its n x n rows of the training frame."""
    t = _ledger(spark, [f"T{i % 60}" for i in range(80)], (False, False, True))
    got = Counter(r[0] for r in LE.fitted_scores(t).collect())
    assert got == Counter({f"T{i}": 8 if i < 20 else 1 for i in range(60)})
