"""Detector metrics against brute force on small label/score arrays."""

import numpy as np
import pytest

from ledgerscope.operators import evaluation as EV


def frame(spark, y, p, s):
    return spark.createDataFrame(
        [(int(a), int(b), float(c)) for a, b, c in zip(y, p, s)], "y_true int, y_pred int, y_score double"
    )


def test_perfect_and_all_missed(spark):
    y = [1, 1, 0, 0]
    m = EV.classification_metrics(frame(spark, y, y, [0.9, 0.8, 0.1, 0.2])).first()
    assert m.precision == 1.0 and m.recall == 1.0 and m.f1_score == 1.0
    m2 = EV.classification_metrics(frame(spark, y, [0, 0, 1, 1], [0.1, 0.2, 0.9, 0.8])).first()
    assert m2.recall == 0.0 and m2.true_positives == 0


def _auc_bruteforce(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_and_ap_match_bruteforce(spark, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) * 0.5 + y * 0.3, 2)  # ties on purpose
    df = frame(spark, y, (s > 0.5).astype(int), s)
    auc = EV.roc_auc(df).first().roc_auc
    assert abs(auc - _auc_bruteforce(y, s)) < 1e-6
    # step-wise average precision by brute force over distinct thresholds
    ap = 0.0
    P = y.sum()
    for t in sorted(set(s), reverse=True):
        sel = s >= t
        tp = (y[sel] == 1).sum()
        ap += ((y[s == t] == 1).sum() / P) * tp / sel.sum()
    assert abs(EV.average_precision(df).first().average_precision - round(ap, 6)) < 1e-6


def test_auc_null_with_one_class(spark):
    df = frame(spark, [1, 1], [1, 0], [0.2, 0.3])
    assert EV.roc_auc(df).first().roc_auc is None


def test_optimal_threshold_honours_min_recall(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) * 0.6 + y * 0.4, 3)
    r = EV.optimal_threshold(frame(spark, y, y, s), min_recall=0.9).first()
    assert r.recall >= 0.9


def test_cost_model(spark):
    c = spark.createDataFrame([(10, 50, 0, 1)], "true_positives long, false_positives long, true_negatives long, false_negatives long")
    r = EV.detection_cost(c).first()
    assert r.total_cost_usd == 1 * 100000 + 50 * 500
    assert r.cost_per_true_positive_usd == pytest.approx(r.total_cost_usd / 10)


def test_bootstrap_se_agrees_with_analytic(spark, sf):
    from ledgerscope.operators import causal as CA
    from ledgerscope.sources import ledger as L

    tx = L.transactions(spark, "/root/testdata/sf0.01")
    a = CA.did_effect(tx).first()
    b = CA.did_bootstrap(tx, replicates=400).first()
    p = CA.did_bootstrap(tx, replicates=60, method="poisson").first()
    assert (a.n_00, a.n_01, a.n_10, a.n_11) == (28833, 25766, 2878, 2523)
    assert abs(b.se - a.se) / a.se < 0.2 and abs(p.se - a.se) / a.se < 0.35
    assert b.ate == a.ate and b.ate_lower < b.ate < b.ate_upper


def test_fingerprint_invariant_under_repartitioning(spark, sf):
    from ledgerscope.sources import ledger as L
    from ledgerscope.sources.tables import table_fingerprint

    tx = L.transactions(spark, sf)
    a = table_fingerprint(tx).first()
    b = table_fingerprint(tx.repartition(7, "sender_id")).first()
    assert (a.rows, a.fingerprint) == (b.rows, b.fingerprint)


def test_whatif_threshold_monotone(spark, sf):
    from ledgerscope.operators import causal as CA
    from ledgerscope.sources import ledger as L

    sc = CA.fallback_scores(L.transactions(spark, sf), current=0.01)
    lower = CA.whatif_threshold(sc, current=0.01, new=0.005).first()
    higher = CA.whatif_threshold(sc, current=0.01, new=0.02).first()
    assert lower.counterfactual_alerts >= lower.baseline_alerts
    assert higher.counterfactual_alerts <= higher.baseline_alerts
    assert lower.recommendation.startswith("Lowering") and higher.recommendation.startswith("Raising")


def test_keyset_page_equals_offset_page(spark, sf):
    import __spark_entry__ as E
    from ledgerscope.operators import profiles as PR
    from ledgerscope.plans.registry import _scores

    sc = _scores(spark, sf)
    page1 = PR.alerts_after(sc, None, None, page_size=20, min_score=0.1).collect()
    last = page1[-1]
    page2 = PR.alerts_after(sc, last.combined_score, last.transaction_id, page_size=20, min_score=0.1).collect()
    off = PR.alerts_page(sc, page=2, page_size=20, min_score=0.1).collect()
    assert [r.transaction_id for r in page2] == [r.transaction_id for r in off]
    assert E.queries()["alerts_page"](spark, sf).count() <= 50
