"""Round-trip chains with hop and amount rules; components, labels that settle, the run report."""

import datetime as dt
import random

import pytest

from ledgerscope.operators import detectors as DT
from ledgerscope.operators import graph as GR
from ledgerscope.operators import io_jobs as IO


def _ledger(spark, hops):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(f"T{i}", a, b, c, t0 + dt.timedelta(hours=h)) for i, (a, b, c, h) in enumerate(hops)]
    return spark.createDataFrame(rows, "transaction_id string, sender_id string, receiver_id string, amount_cents long, timestamp timestamp_ntz")


@pytest.mark.parametrize("depth", [2, 3, 4, 5])
def test_planted_chains_are_found(spark, depth):
    names = [f"A{i}" for i in range(depth)] + ["A0"]
    planted = [(names[i], names[i + 1], int(1_000_000 * 0.95**i), 5 * i) for i in range(depth)]
    slow = [(a + "s", b + "s", c, h * 30) for a, b, c, h in planted]  # hops of over 24 hours
    skim = [(a + "k", b + "k", int(c * 0.5 ** (h / 5)), h) for a, b, c, h in planted]  # loses half at each hop
    quick = [(a + "q", b + "q", c, h / 50) for a, b, c, h in planted]  # hops of under an hour
    rules = {"max_hop_days": 1, "min_hop_hours": 1, "kept": (90, 99)}
    got = DT.round_trips(_ledger(spark, planted + slow + skim + quick), depth, **rules).collect()
    assert [r.origin_id for r in got] == ["A0"] and got[0][f"txn_{depth}"] == f"T{depth - 1}"


@pytest.mark.parametrize("depth", [2, 5])
def test_registered_chains_apply_the_rules(spark, monkeypatch, depth):
    from ledgerscope.plans import registry

    names = [f"A{i}" for i in range(depth)] + ["A0"]
    planted = [(names[i], names[i + 1], int(1_000_000 * 0.95**i), 5 * i) for i in range(depth)]
    other = [(a + "s", b + "s", c, h * 30) for a, b, c, h in planted] + [(a + "z", b + "z", 0, h) for a, b, c, h in planted]
    monkeypatch.setattr(registry, "planted", lambda s, d: _ledger(s, planted + other))
    assert [r.origin_id for r in registry.REGISTRY[f"round_trips_rules_{depth}"](spark, "").collect()] == ["A0"]


def test_chains_as_launderers_make_them_are_found(spark):
    """Each hop's own share compounds from the first amount: hop i carries share_i ** i of it."""
    r = random.Random(6)
    rows, t0 = [], dt.datetime(2024, 1, 1)
    for c in range(500):
        first, at = round(r.uniform(100_000, 2_000_000), 2), t0 + dt.timedelta(days=r.uniform(0, 300))
        names = [f"{c}:{i}" for i in range(5)] + [f"{c}:0"]
        for i in range(5):
            at += dt.timedelta(hours=r.uniform(1, 24))
            rows.append((f"{c}.{i}", names[i], names[i + 1], round(round(first * r.uniform(0.90, 0.99) ** i, 2) * 100), at))
    df = spark.createDataFrame(rows, "transaction_id string, sender_id string, receiver_id string, amount_cents long, timestamp timestamp_ntz")
    got = DT.round_trips(df, 5, max_hop_days=1, min_hop_hours=1, kept=(90, 99)).collect()
    assert len({x.txn_1 for x in got if x.txn_1.endswith(".0")}) >= 495


def _graph(spark, pairs):
    nodes = sorted({x for p in pairs for x in p})
    return spark.createDataFrame([(*p, 1) for p in pairs], "src string, dst string, weight long"), spark.createDataFrame([(n,) for n in nodes], "node string")


def test_two_joined_nodes_are_one_community(spark):
    assert len({r.community for r in GR.label_propagation(*_graph(spark, [("a", "b")])).collect()}) == 1


def test_labels_are_settled(spark):
    r = random.Random(1)
    pairs = [(f"n{i}", f"n{i + 1}") for i in range(8)] + [(f"c{a}", f"c{b}") for a in range(5) for b in range(a)] + [("c0", "n0")]
    pairs += [(f"r{r.randrange(9)}", f"r{r.randrange(9)}") for _ in range(14)]
    edges, nodes = _graph(spark, pairs)
    label = {x.node: x.community for x in GR.label_propagation(edges, nodes).collect()}
    weight = {}
    for x in GR.undirected_pairs(edges).collect():
        for a, b in ((x.u, x.v), (x.v, x.u)):
            weight.setdefault(a, {}).setdefault(label[b], 0)
            weight[a][label[b]] += x.weight
    assert all(w.get(label[n], 0) == max(w.values()) for n, w in weight.items())
    assert len({label[f"c{i}"] for i in range(5)}) == 1


def test_components_of_chains_and_rings(spark):
    chain = [(f"d{i}", f"d{i - 1}") for i in range(1, 9)]
    ring = [("x", "y"), ("y", "z"), ("z", "x"), ("z", "d0")]
    edges, nodes = _graph(spark, chain + ring)
    counts = GR.component_counts(edges, nodes).first()
    assert (counts.weak_components, counts.strong_components) == (1, 10)


def test_run_report(spark, sf):
    def broken(s, d):
        raise ValueError("x" * 500)

    got = {r.name: r for r in IO.preset_manifest(spark, sf, {"good": lambda s, d: s.range(3), "bad": broken, "gone": broken}, needs={"gone": ["no_such"], "good": ["orders"]}).collect()}
    assert (got["good"].status, got["good"].rows) == ("ok", 3) and got["gone"].status == "skipped"
    assert got["bad"].status == "failed" and "x" * 500 in got["bad"].error
    assert all(r.seconds >= 0 and r.ended_at >= r.started_at for r in got.values())


def test_fitted_scores_feed_the_alerts(spark, sf):
    import __spark_entry__ as E

    rows = E.queries()["fitted_scores"](spark, sf).toPandas()
    assert rows.combined_score.std() > 0.01 and 0 < rows.is_flagged.mean() < 0.2
    assert len(E.queries()["fitted_top_suspects"](spark, sf).collect()) > 0
