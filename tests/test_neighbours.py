"""Nearest neighbours against brute force, oversampling, Shapley values of the trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerscope.functions.constants import TRANSACTION_FEATURES as FEATS
from ledgerscope.operators import learning as LE
from ledgerscope.operators.features import apply_standardizer, fit_standardizer, transaction_features
from ledgerscope.operators.neighbours import nearest
from ledgerscope.sources import ledger as L


def _recall(ids, groups, x, got, k):
    hit = want = 0
    at = {i: n for n, i in enumerate(ids)}
    groups = np.array(groups, dtype=object)
    for n, i in enumerate(ids):
        d = ((x - x[n]) ** 2).sum(1)
        d[(groups != groups[n]) | (np.arange(len(x)) == n)] = np.inf
        best = np.sort(d)[:k]
        best = best[np.isfinite(best)]
        want += len(best)
        mine = sorted(d[at[j]] for j in got.get(i, []))
        assert len(mine) <= k and all(np.isfinite(mine))
        hit += sum(m <= b + 1e-12 for m, b in zip(mine, best))
    return hit / want


@pytest.fixture(scope="module")
def ledger(spark, sf):
    return LE.cut_lineage(L.transactions(spark, sf))


def test_recall_on_suspicious_rows(spark, sf):
    big = L.transactions(spark, sf.replace("0.001", "0.01"))
    f = LE.cut_lineage(transaction_features(big, keep=["is_suspicious", "label"]).filter("is_suspicious"))
    s = LE.cut_lineage(apply_standardizer(f, fit_standardizer(f, FEATS), FEATS, ["transaction_id", "label"]))
    got = {r.id: r.near for r in nearest(s, "transaction_id", "label", FEATS, block=64).collect()}
    rows = s.collect()
    x = np.array([[r[c] for c in FEATS] for r in rows])
    recall = _recall([r.transaction_id for r in rows], [r.label for r in rows], x, got, 5)
    assert len(rows) > 500 and recall >= 0.9, recall


def test_small_blocks_ties_equal_rows_and_lone_groups(spark):
    rng = np.random.default_rng(3)
    rows = [(f"r{i}", "a" if i < 60 else None, float(rng.normal()), float(i % 3)) for i in range(90)]
    rows += [(f"same{i}", "b", 1.0, 1.0) for i in range(40)] + [("lone", "c", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id string, g string, x double, y double")
    got = {r.id: r.near for r in nearest(df, "id", "g", ["x", "y"], k=3, block=8, reach=6).collect()}
    assert "lone" not in got and len(got) == 130
    assert all(len(v) == 3 and set(v) <= {f"same{i}" for i in range(40)} - {i} for i, v in got.items() if i.startswith("same"))
    x = np.array([r[2:] for r in rows[:-1]])
    assert _recall([r[0] for r in rows[:-1]], [r[1] for r in rows[:-1]], x, got, 3) >= 0.9
    assert nearest(df.limit(0), "id", "g", ["x", "y"]).count() == 0


def test_synthetic_rows_lie_between_neighbours(spark, ledger):
    syn = LE.minority_oversample(ledger, per_row=2)
    n = ledger.filter("is_suspicious").count()
    assert syn.count() == 2 * n and syn.select("transaction_id").distinct().count() == 2 * n
    f = transaction_features(ledger, keep=["is_suspicious"]).filter("is_suspicious")
    low, high = ({c: f.agg(g(c)).first()[0] for c in FEATS} for g in (F.min, F.max))
    out = syn.filter(" or ".join(f"{c} < {low[c] - 1e-9!r} or {c} > {high[c] + 1e-9!r}" for c in FEATS))
    assert out.isEmpty()


def test_shapley_values_sum_to_score_minus_base(spark, ledger):
    t = LE.cut_lineage(LE.tree_attribution(ledger, top=40, permutations=4))
    per = t.groupBy("transaction_id").agg(F.count("feature").alias("n"), F.sum("attribution").alias("a"), F.first("score").alias("s"), F.first("base").alias("b"))
    rows = per.collect()
    assert len(rows) == 40 and {r.n for r in rows} == {len(FEATS)}
    assert max(abs(r.a - (r.s - r.b)) for r in rows) < 1e-9
    assert len({round(r.b, 12) for r in rows}) == 1 and max(abs(r.a) for r in rows) > 0.01
