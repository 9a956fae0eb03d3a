"""What queries read, parse, write and leave behind: counts that grow too fast at size."""

import hashlib
import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerscope.operators import communities as CM
from ledgerscope.operators import detectors as DT
from ledgerscope.operators import features as FE
from ledgerscope.operators import graph as GR
from ledgerscope.operators import learning as LE
from ledgerscope.operators import link_blocks as LB
from ledgerscope.plans import registry as R
from ledgerscope.session import cut_lineage, ensure_checkpoint_dir, options, passing_cuts
from ledgerscope.sources import planted as PL
from ledgerscope.sources import tables as TB
from ledgerscope.sources import validate as VA


def test_records_are_parsed_once_though_rules_name_many_fields(spark):
    good = {"transaction_id": "a", "sender_id": "s", "receiver_id": "r", "amount_usd": 5.0, "timestamp": "2024-03-01T10:00:00"}
    texts = [json.dumps(good), json.dumps(good | {"amount_usd": -1}), "no json", None, json.dumps(good | {"transaction_id": None})]
    rows = VA.parse_records(spark.createDataFrame([(t,) for t in texts], "record string"))
    assert rows.count() == 5  # broken and null texts stay rows
    valid = VA.validate_valid(rows)
    assert valid._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert [r.transaction_id for r in valid.collect()] == ["a"]
    assert VA.validate_quarantine(rows).count() == 4


def _cuts(spark):
    path = os.path.join(ensure_checkpoint_dir(spark), "cuts", spark.sparkContext.applicationId)
    return set(os.listdir(path)) if os.path.isdir(path) else set()


def test_derived_tables_leave_no_cuts(spark, sf, monkeypatch):
    """only the table itself and one row of fitted values stay."""
    monkeypatch.setattr(R, "_WRITTEN", {})
    R.tx(spark, sf)
    before = _cuts(spark)
    scores = R._fitted(spark, sf)
    assert _cuts(spark) == before
    assert {name for _, _, name, _ in R._WRITTEN} == {"transactions", "fitted_rows", "fitted_fit"}
    assert scores.count() == R.tx(spark, sf).count()


def test_a_cut_that_outlives_its_block_belongs_to_the_one_around(spark):
    before = _cuts(spark)
    with passing_cuts(spark):
        with passing_cuts(spark) as keep:
            cut_lineage(spark.range(3))
            kept = keep(spark.range(5))
        assert len(_cuts(spark) - before) == 1 and kept.count() == 5
    assert _cuts(spark) == before


def test_shuffled_rows_of_the_frame_hold_no_feature_but_the_amount(spark, sf):
    plan = FE.transaction_features(R.tx(spark, sf))._jdf.queryExecution().optimizedPlan()
    join = plan.toString().split("Join ")[1].split("\n+- Aggregate")[0]
    assert "_few" in join and "LOG1P" not in join.upper()


def test_fitted_scores_are_joined_with_no_ids(spark, sf, monkeypatch):
    monkeypatch.setattr(LE, "fit_second_detector", lambda sc, seed=7: None)
    monkeypatch.setattr(LE, "_unreal", lambda model, sc: sc.withColumn("gan_score", F.lit(0.5)))
    rows = LE.fitted_rows(R.tx(spark, sf))
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.join(R.tx(spark, sf), ["transaction_id", "sender_id", "receiver_id", "amount_cents", "amount_usd", "is_suspicious"]).count() == R.tx(spark, sf).count()


def _hops(spark, rows):
    t = spark.createDataFrame(rows, "transaction_id string, sender_id string, receiver_id string, amount_cents long, h int")
    return t.withColumn("timestamp", F.timestamp_seconds(F.col("h") * 3600).cast("timestamp_ntz")).drop("h")


def test_paths_of_round_trips_are_numbers_and_only_the_result_stays(spark, monkeypatch):
    """transfers alike are found once and listed each."""
    seen, before = [], _cuts(spark)
    monkeypatch.setattr(DT, "cut_lineage", lambda df: seen.append(dict(df.dtypes)) or cut_lineage(df))
    rows = [("t1", "a", "b", 1000, 0), ("t2", "b", "c", 950, 5), ("t2", "b", "c", 950, 5), ("t3", "b", "c", 10, 5), (None, "c", "a", None, 9), ("t5", "c", "z", 900, 9), ("t6", "a", "b", 1, 400)]
    got = DT.round_trips(_hops(spark, rows), 3)
    assert sorted((r.origin_id, r.via_1, r.via_2, r.txn_1, r.txn_2, r.txn_3, r.first_amount_usd, r.last_amount_usd) for r in got.collect()) == [
        ("a", "b", "c", "t1", t, None, 10.0, None) for t in ("t2", "t2", "t3")
    ]
    assert {"a": "bigint", "b": "bigint", "s": "bigint"} in seen
    assert len(_cuts(spark) - before) == 1
    monkeypatch.undo()
    kept = DT.round_trips(_hops(spark, [*rows, ("t7", "c", "a", 902, 9), ("t8", "c", "a", 902, 9)]), 3, max_hop_days=1, min_hop_hours=1, kept=(90, 99))
    assert sorted((r.txn_2, r.txn_3) for r in kept.collect()) == [("t2", "t7"), ("t2", "t7"), ("t2", "t8"), ("t2", "t8")]


def test_planted_ledger_is_no_second_copy_of_the_ledger(spark, sf):
    assert any("/transactions-" in f for f in R.planted(spark, sf).inputFiles())
    assert PL.planted_ledger(spark, sf, R.tx(spark, sf)).exceptAll(R.planted(spark, sf)).isEmpty()


def test_detectors_of_the_alert_count_leave_one_row_each(spark, sf):
    R.tx(spark, sf)
    before = _cuts(spark)
    assert R.typology_alerts(spark, sf).count() == 7
    assert len(_cuts(spark) - before) == 7


def test_json_batch_is_written_compressed_and_scored_whole(spark, sf):
    """as plain text the batch is some ten times the ledger."""
    folder = os.path.join(ensure_checkpoint_dir(spark), "io")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    scored = R.REGISTRY["score_json_batch"](spark, sf)
    assert scored.count() == R.tx(spark, sf).count()
    (made,) = (n for n in set(os.listdir(folder)) - before if n.startswith("json-array-"))
    parts = [n for n in os.listdir(os.path.join(folder, made)) if n.startswith("part-")]
    assert parts and all(n.endswith(".gz") for n in parts)


def test_digests_of_files_beyond_what_one_value_holds(spark, tmp_path):
    """F8: whole contents as values end at ``maxLength``, 2 GB by default."""
    files = {"feed": b"\n", "feeds": b"x\r\n\n\xff\xfey\n\n", "none": b"no feed", "noise": os.urandom(300_000), "long": b"0" * 200_000 + b"\n1"}
    for name, content in files.items():
        (tmp_path / f"{name}.parquet").write_bytes(content)
    with options(spark, {"spark.sql.sources.binaryFile.maxLength": "1000", "spark.sql.files.maxPartitionBytes": "5000"}):
        got = {r.file: (r.bytes, r.sha256) for r in TB.file_manifest(spark, str(tmp_path)).collect()}
    assert got == {f"{n}.parquet": (len(c), hashlib.sha256(c).hexdigest()) for n, c in files.items()}


def _random_graph(spark, seed):
    r = random.Random(seed)
    nodes = [f"n{i}" for i in range(60)] + [None]
    pairs = {(f"n{r.randrange(50)}", f"n{min(49, max(0, r.randrange(50) // 7 * 7 + r.randrange(7)))}") for _ in range(160)}
    edges = spark.createDataFrame([(a, b, r.choice([1, 2, 5])) for a, b in sorted(pairs)], "src string, dst string, weight long")
    return edges, spark.createDataFrame([(n,) for n in nodes], "node string")


@pytest.mark.parametrize("find", [CM.communities, GR.label_propagation])
def test_sweeps_over_packed_links_make_the_moves_of_the_joins(spark, monkeypatch, find):
    """F5, F6, F12."""
    monkeypatch.setattr(LB, "BLOCK_LINKS", 16)
    edges, nodes = _random_graph(spark, 4)
    before = _cuts(spark)
    swept = sorted(map(tuple, find(edges, nodes).collect()), key=str)
    assert len(_cuts(spark) - before) == 1  # rounds leave nothing but the result
    monkeypatch.setattr(LB, "MAX_NODES", 0)
    assert swept == sorted(map(tuple, find(edges, nodes).collect()), key=str)


def test_hashes_are_those_of_spark(spark):
    rows = spark.range(-3, 2000).withColumn("t", F.concat(F.lit("x"), "id")).select("id", F.xxhash64("id", F.lit(7)).alias("h"), F.xxhash64("t").alias("s"), F.xxhash64("t", F.lit(9)).alias("s9")).collect()
    ids, s = np.array([r.id for r in rows]), np.array([r.s for r in rows])
    assert LB.hash_int(7, LB.hash_long(ids, 42)).astype(np.int64).tolist() == [r.h for r in rows]
    assert LB.hash_int(9, s).astype(np.int64).tolist() == [r.s9 for r in rows]
