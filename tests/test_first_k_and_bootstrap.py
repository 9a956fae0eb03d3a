"""First-k sums against brute force; the folded bootstrap against the cells' one."""

import datetime as dt
import random

import pytest

from ledgerscope.operators import causal as CA


@pytest.fixture(scope="module")
def ledger(spark):
    r = random.Random(2)
    t0 = dt.datetime(2024, 1, 1)
    # few days, one of which holds half of all rows, and seconds shared by many rows
    times = [t0 + dt.timedelta(days=r.choice([0, 1, 1, 1, 5]), seconds=r.choice([3, 3, 3, 77, 4000]), microseconds=r.choice([0, 5])) for _ in range(400)]
    rows = [(f"T{i:03}", t, r.randrange(1, 10**6), r.random() < 0.3, r.random() < 0.5) for i, t in enumerate(times)]
    return rows, spark.createDataFrame(rows, "transaction_id string, timestamp timestamp_ntz, amount_cents long, is_suspicious boolean, structuring_flag boolean")


def test_first_k_sums(ledger):
    rows, df = ledger
    order = sorted(rows, key=lambda x: (x[1], x[0]))
    ks = [0, 1, 57, 199, 200, 399, 400, 1000]
    assert CA.first_k_sums(df, ks) == [sum(x[2] for x in order[:k]) for k in ks]
    assert CA.first_k_sums(df.limit(0), [0, 3]) == [0, 0]


def test_no_sort_of_the_whole_ledger(ledger, monkeypatch):
    rows, df = ledger
    seen = []
    real = CA.prefix_sums
    monkeypatch.setattr(CA, "prefix_sums", lambda d, *a: seen.append(d.count()) or real(d, *a))
    CA.first_k_sums(df, [150])
    assert seen and max(seen) < len(rows) / 2


def test_folded_bootstrap_agrees_with_the_cells(ledger):
    _, df = ledger
    a = CA.did_bootstrap(df, policy_date="2024-01-02").first()
    b = CA.did_bootstrap(df, policy_date="2024-01-02", method="poisson").first()
    assert a.replicates == b.replicates == 500 and a.ate == b.ate
    assert abs(a.se - b.se) < 0.25 * a.se
    again = CA.did_bootstrap(df.repartition(13), policy_date="2024-01-02", method="poisson").first()
    assert abs(again.se - b.se) < 1e-5
