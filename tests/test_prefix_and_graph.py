"""Distributed prefix sums, dense index and graph algorithms vs brute force."""

import numpy as np
from pyspark.sql import functions as F

from ledgerscope.operators import graph as GR
from ledgerscope.operators.strong import strong_components
from ledgerscope.operators.prefix import dense_index, prefix_sums


def test_prefix_sums_match_cumsum(spark):
    rng = np.random.default_rng(0)
    vals = rng.integers(0, 100, 2000)
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(vals)], "k long, v long").repartition(7)
    for desc in (False, True):
        order = [F.col("k").desc()] if desc else [F.col("k")]
        got = {r.k: r.v_cum for r in prefix_sums(df, order, ["v"], n_partitions=5).collect()}
        seq = list(range(len(vals)))[::-1] if desc else list(range(len(vals)))
        acc = 0
        for k in seq:
            acc += int(vals[k])
            assert got[k] == acc


def test_dense_index_strings(spark):
    keys = [f"CUST_{i:06d}" for i in range(300)] + ["A", "b", "zz"]
    df = spark.createDataFrame([(k,) for k in keys] * 2, "id string")
    got = {r.id: r.idx for r in dense_index(df, "id", n_partitions=4).collect()}
    assert got == {k: i for i, k in enumerate(sorted(set(keys)))}


def _edges(spark, pairs):
    return spark.createDataFrame([(a, b, 1) for a, b in pairs], "src string, dst string, weight long")


def _nodes(spark, pairs):
    ns = sorted({x for p in pairs for x in p})
    return spark.createDataFrame([(n,) for n in ns], "node string")


def test_components_and_strong_components(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("e", "f"), ("f", "e"), ("g", "g")]
    e, n = _edges(spark, pairs), _nodes(spark, pairs)
    cc = {r.node: r.component for r in GR.connected_components(e, n).collect()}
    assert cc == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e", "f": "e", "g": "g"}
    scc = {r.node: r.component for r in strong_components(e, n).collect()}
    assert scc == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e", "f": "e", "g": "g"}


def test_triangles_and_clustering(spark):
    # a square with one diagonal: triangles abc, acd
    pairs = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "a"), ("a", "c"), ("c", "a"), ("d", "d")]
    t = {r.node: (r.triangles, r.clustering) for r in GR.triangles(_edges(spark, pairs)).collect()}
    assert t["a"] == (2, 0.666667) and t["c"] == (2, 0.666667) and t["b"] == (1, 1.0) and t["d"] == (1, 1.0)


def test_propagation_one_round(spark):
    x = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "customer_id string, f double")
    tx = spark.createDataFrame([("a", "b"), ("a", "b")], "sender_id string, receiver_id string")
    got = {r.customer_id: r.f for r in GR.propagate_features(x, tx, ["f"], rounds=1).collect()}
    assert got["a"] == 0.5  # no in-neighbours: (1 + 0) / 2
    assert got["b"] == (3.0 + 2.0) / 3  # two in-edges from a
