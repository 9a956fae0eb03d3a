"""Derived tables that many keys share: written once, joined in their narrowest form."""

from pyspark.sql import functions as F

from ledgerscope.operators import evaluation as EV
from ledgerscope.operators import features as FE
from ledgerscope.operators import graph as GR
from ledgerscope.operators import scoring as SCO
from ledgerscope.plans import registry as R


def test_finished_scores_follow_from_the_raw_ones_without_a_second_copy(spark, sf):
    scores = R.REGISTRY["anomaly_scores"](spark, sf)
    assert scores.inputFiles() and all("/raw_scores-" in f or "/score_fit-" in f for f in scores.inputFiles())
    raw = SCO.raw_scores(R.tx(spark, sf))
    fitted = SCO.score_fit(raw).first()
    assert fitted.vae_max == raw.agg(F.max("vae_score")).first()[0]
    assert {r.threshold for r in SCO.finish_scores(raw).select("threshold").distinct().collect()} == {fitted.threshold}


def test_roles_come_from_one_sum_by_pair(spark):
    txns = spark.createDataFrame([("a", "b", 5), ("a", "b", 7), ("b", "a", 1), ("a", "a", 2), (None, "a", 4)], "sender_id string, receiver_id string, amount_cents long")
    got = {r[0]: tuple(r)[1:] for r in FE.role_stats(txns).filter("_nid is not null").collect()}
    assert got == {"a": (3, 14, 2, 3, 7, 3), "b": (1, 1, 1, 2, 12, 1)}
    plan = FE.role_stats(txns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.rindex("Aggregate")  # pairs first, roles after


def test_propagated_rounds_are_written_not_nested(spark):
    x = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "customer_id string, f double")
    txns = spark.createDataFrame([("a", "b"), ("a", "b")], "sender_id string, receiver_id string")
    p = GR.propagate_features(x, txns, ["f"], rounds=2)
    assert "Join" not in p._jdf.queryExecution().optimizedPlan().toString()
    assert {r.customer_id: round(r.f, 6) for r in p.collect()} == {"a": 0.25, "b": round(((3 + 2 * 1.0) / 3 + 2 * 0.5) / 3, 6)}


def test_hops_are_pruned_once_for_all_joins(spark):
    from ledgerscope.operators import detectors as DT

    rows = [("t1", "a", "b", 0), ("t2", "b", "c", 60), ("t3", "c", "a", 120), ("t4", "c", "z", 90)]
    txns = spark.createDataFrame(rows, "transaction_id string, sender_id string, receiver_id string, s long")
    txns = txns.select("*", F.lit(100).cast("long").alias("amount_cents"), F.timestamp_seconds("s").alias("timestamp"))
    trips = DT.round_trips(txns, depth=3)
    assert "LeftSemi" not in trips._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(r)[:6] for r in trips.collect()) == [("a", "b", "c", "t1", "t2", "t3")]


def test_labels_run_on_numbers_and_name_the_smallest_account(spark):
    pairs = [("b", "a"), ("c", "b"), ("a", "c"), ("x", "y"), ("y", "x")]
    edges = spark.createDataFrame([(u, v, 5) for u, v in pairs], "src string, dst string, weight long")
    nodes = spark.createDataFrame([(n,) for n in ["a", "b", "c", "x", "y", "lone", None]], "node string")
    got = GR.label_propagation(edges, nodes)
    assert "weight" not in got._jdf.queryExecution().optimizedPlan().toString()
    com = {r.node: r.community for r in got.collect()}
    assert len({com[n] for n in "abc"}) == 1 and com["x"] == com["y"] and com["lone"] == "lone" and com[None] is None


def test_derived_tables_are_written_by_as_many_tasks_as_their_rows_need(spark, sf, monkeypatch):
    """A fixed number of tasks spills once the ledger outgrows it."""
    from ledgerscope import session as SE

    monkeypatch.setattr(SE, "ROWS_A_TASK", 100)
    monkeypatch.setattr(R, "_WRITTEN", {})
    name = "spark.sql.shuffle.partitions"
    was, seen = spark.conf.get(name), []

    def build():
        seen.append(int(spark.conf.get(name)))
        return spark.range(5)

    assert R.written(spark, sf, "sized", build).count() == 5
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert seen == [-(-lines // 100)] and spark.conf.get(name) == was
    try:
        R.written(spark, sf, "failing", lambda: 1 / 0)
    except ZeroDivisionError:
        assert spark.conf.get(name) == was
    monkeypatch.setattr(SE, "ROWS_A_TASK", 10**9)  # few rows: the session's own number
    R.written(spark, sf, "small", build)
    assert seen[1] == int(was)


def test_threshold_is_selected_not_gathered_in_one_map(spark):
    """The p95 of the normal rows without a map of all scores in one task."""
    raw = spark.range(1000).select((F.col("id") * 0.001).alias("vae_score"), (F.col("id") % 10 == 3).alias("is_suspicious"))
    fit = SCO.score_fit(raw)
    want = raw.filter("not is_suspicious").agg(F.percentile(F.round(F.col("vae_score") / (F.lit(0.999) + 1e-9), 6), 0.95)).first()[0]
    assert "percentile" not in fit._jdf.queryExecution().optimizedPlan().toString()
    assert fit.first().vae_max == 0.999 and abs(fit.first().threshold - want) < 1e-9
    assert SCO.score_fit(raw.filter("id < 0")).first().threshold is None


def test_shuffled_partitions_are_not_joined_into_tasks_that_spill(spark):
    """partitions joined up to 64 MB of narrow rows gave tasks of 1.6 million ledger rows."""
    from ledgerscope import session as SE

    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    first = spark.conf.get(name)
    try:
        for was, within in (("64m", f"{SE.BYTES_A_TASK}b"), ("67108864b", f"{SE.BYTES_A_TASK}b"), ("8m", "8m")):
            spark.conf.set(name, was)
            with SE.shuffles_for(spark, 1):  # few rows: the number of partitions stays
                assert spark.conf.get(name) == within
            assert spark.conf.get(name) == was
            try:
                with SE.shuffles_for(spark, 10**9):
                    raise KeyError
            except KeyError:
                assert spark.conf.get(name) == was
    finally:
        spark.conf.set(name, first)


def _written_by(spark, sf, monkeypatch, *names):
    monkeypatch.setattr(R, "_WRITTEN", {})
    got = [sorted(map(str, R.REGISTRY[n](spark, sf).collect())) for n in names]
    return {k[2] for k in R._WRITTEN}, got


def test_curves_and_counts_move_no_ids_of_transfers(spark, sf, monkeypatch):
    """all columns of the ledger's transfers were shuffled by sender and written for a curve."""
    keys = ["roc_auc", "detector_metadata_flat", "score_histogram", "score_summary", "cost_comparison"]
    tables, narrow = _written_by(spark, sf, monkeypatch, *keys)
    assert "raw_scores" not in tables and "sender_scores" in tables
    assert set(R._sender_scores(spark, sf).columns) == {"sender_id", "is_suspicious", "vae_score", "combined_score", "threshold", "is_flagged"}
    # where the whole table lies written already, it is read and gives the same
    monkeypatch.setattr(R, "_WRITTEN", {})
    whole = R._scores(spark, sf)
    tables = {k[2] for k in R._WRITTEN}
    assert [sorted(map(str, R.REGISTRY[n](spark, sf).collect())) for n in keys] == narrow
    assert {k[2] for k in R._WRITTEN} == tables and "sender_scores" not in tables
    auc = whole.select(F.col("is_suspicious").cast("int").alias("y_true"), F.col("combined_score").alias("y_score"))
    assert narrow[0] == [str(EV.roc_auc(auc).first())]


def test_both_tables_of_scores_hold_the_same(spark, sf, monkeypatch):
    monkeypatch.setattr(R, "_WRITTEN", {})
    cols = ["sender_id", "is_suspicious", "vae_score", "combined_score", "threshold", "is_flagged"]
    narrow = R._sender_scores(spark, sf).select(cols)
    whole = R._scores(spark, sf).select(cols)
    assert narrow.count() == whole.count() > 0
    assert narrow.exceptAll(whole).isEmpty()


def test_reports_and_alerts_by_sender_move_no_ids_of_transfers(spark, sf, monkeypatch):
    """the mean scores of senders need none of the transfers' ids and partners."""
    keys = ["sar_summary", "sar_lookup", "customer_alerts", "alerts_with_truth", "anomaly_flagged_customers"]
    tables, narrow = _written_by(spark, sf, monkeypatch, *keys)
    assert "raw_scores" not in tables and "sender_scores" in tables
    monkeypatch.setattr(R, "_WRITTEN", {})
    R._scores(spark, sf)
    assert [sorted(map(str, R.REGISTRY[n](spark, sf).collect())) for n in keys] == narrow and all(narrow)
    assert "sender_scores" not in {k[2] for k in R._WRITTEN}
