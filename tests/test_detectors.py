"""Typology detectors vs brute force on small ledgers, incl. chunk borders."""

import datetime as dt
import random

from ledgerscope.operators import detectors as DT

T0 = dt.datetime(2024, 1, 6, 20, 0, 0)  # near a 7-day chunk border of the epoch


def ledger(spark, rows):
    return spark.createDataFrame(
        [(f"T{i}", ts, s, r, c, c / 100.0, "ACH") for i, (ts, s, r, c) in enumerate(rows)],
        "transaction_id string, timestamp timestamp_ntz, sender_id string, receiver_id string, amount_cents long, "
        "amount_usd double, transaction_type string",
    )


def test_smurfing_window_across_chunk_border(spark):
    h = dt.timedelta(hours=1)
    rows = [(T0 + i * 10 * h, "A", "B", 900000) for i in range(8)]
    got = DT.smurfing_windows(ledger(spark, rows), window_hours=56, min_count=5).collect()
    # brute force
    want = set()
    for i, (ts, *_ ) in enumerate(rows):
        n = sum(1 for t2, *_ in rows if ts - dt.timedelta(hours=56) <= t2 <= ts)
        if n >= 5:
            want.add((f"T{i}", n))
    assert {(r.transaction_id, r.txn_count) for r in got} == want


def test_rapid_movement_next_out_only(spark):
    h = dt.timedelta(hours=1)
    rows = [
        (T0, "X", "A", 100),  # in to A
        (T0, "A", "Y", 100),  # same second: not after
        (T0 + 3 * h, "A", "Z", 100),  # first out after: 3h
        (T0 + 30 * h, "Q", "A", 100),  # in, next out never -> none
    ]
    got = [(r.in_txn, r.out_txn, r.delay_hours) for r in DT.rapid_movement(ledger(spark, rows)).collect()]
    assert got == [("T0", "T2", 3.0)]


def test_round_trip_depth_two(spark):
    h = dt.timedelta(hours=1)
    rows = [(T0, "A", "B", 100), (T0 + 5 * h, "B", "A", 100), (T0 + 300 * h, "B", "A", 100)]
    got = DT.round_trips(ledger(spark, rows), depth=2, max_hop_days=7).collect()
    assert [(r.txn_1, r.txn_2) for r in got] == [("T0", "T1")]


def test_round_trips_ignore_one_directional_hub(spark):
    h = dt.timedelta(hours=1)
    rows = [(T0, "A", "B", 100), (T0 + 2 * h, "B", "C", 100), (T0 + 4 * h, "C", "A", 100)]
    rows += [(T0 + i * h, "HUB", f"X{i}", 100) for i in range(30)]  # never receives: pruned
    got = DT.round_trips(ledger(spark, rows), depth=3, max_hop_days=7).collect()
    assert sorted((r.txn_1, r.txn_2, r.txn_3) for r in got) == [("T0", "T1", "T2")]


def test_one_account_with_half_of_all_rows(spark):
    """Windows and next transfers against brute force, in one task and in many."""
    r = random.Random(4)
    names = ["HOT"] * 6 + [f"A{i}" for i in range(6)]
    rows = [(T0 + dt.timedelta(seconds=r.choice([1, 600]) * r.randrange(400)), r.choice(names), r.choice(names), r.choice([100, 900_000, 2_000_000])) for _ in range(500)]
    sec = lambda t: int((t - T0).total_seconds())
    small = [(f"T{i}", s, sec(t), c) for i, (t, s, _, c) in enumerate(rows) if c < 1_000_000]
    want = {}
    for i, s, t, _ in small:
        inside = [c for _, s2, t2, c in small if s2 == s and t - 7200 <= t2 <= t]
        if len(inside) >= 5:
            want[i] = (len(inside), sum(inside) / 100)
    nexts = {}
    for i, (t, _, x, _) in enumerate(rows):
        later = [(sec(t2), f"T{j}") for j, (t2, s2, _, _) in enumerate(rows) if s2 == x and sec(t) < sec(t2) <= sec(t) + 3600]
        if later:
            nexts[f"T{i}"] = (min(later)[1], (min(later)[0] - sec(t)) / 3600)
    for parts in ("2", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            df = ledger(spark, rows).repartition(5)
            assert {x.transaction_id: (x.txn_count, x.total_usd) for x in DT.smurfing_windows(df, window_hours=2).collect()} == want
            assert {x.in_txn: (x.out_txn, x.delay_hours) for x in DT.rapid_movement(df, within_hours=1).collect()} == nexts
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
