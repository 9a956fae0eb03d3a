"""Saved pipelines, states that expire, the classifier's recall, scores of JSON layouts."""

import datetime as dt
import json
import subprocess
import sys

from pyspark.sql import functions as F

from ledgerscope.operators import io_jobs as IO
from ledgerscope.operators import learning as LE
from ledgerscope.operators import ml_stages as MS
from ledgerscope.operators import scoring as SCO
from ledgerscope.sources import ledger as L
from ledgerscope.streaming import jobs as ST

ELSEWHERE = """
import sys
from pyspark.ml import PipelineModel
from ledgerscope.session import build_session
spark = build_session(master="local[2]", shuffle_partitions=2)
model, rows, out = sys.argv[1:]
PipelineModel.load(model).transform(spark.read.parquet(rows)).write.parquet(out)
"""


def test_a_saved_pipeline_gives_equal_rows_in_a_new_session(spark, sf, tmp_path):
    tx = L.transactions(spark, sf)
    tx.write.parquet(str(tmp_path / "tx"))
    tx = spark.read.parquet(str(tmp_path / "tx"))
    estimator = MS.TransactionFeatureScaler(["log_amount", "amount_usd"], keep=["label"])
    estimator.write().save(str(tmp_path / "estimator"))
    estimator = MS.TransactionFeatureScaler.load(str(tmp_path / "estimator"))
    from pyspark.ml import Pipeline

    model = Pipeline(stages=[estimator]).fit(tx)
    model.save(str(tmp_path / "model"))
    subprocess.run([sys.executable, "-c", ELSEWHERE, *[str(tmp_path / n) for n in ("model", "tx", "out")]], check=True, timeout=300)
    want, got = model.transform(tx), spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == ["transaction_id", "label", "log_amount", "amount_usd"]
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def _events(spark, folder, *files):
    from ledgerscope.sources.schemas import RAW

    day, k = dt.datetime(2024, 1, 1), 0
    for i, rows in enumerate(files):
        full = [(k + j, user, day + dt.timedelta(hours=h), value) for j, (user, h, value) in enumerate(rows)]
        k += len(rows)
        df = spark.createDataFrame(full, "event_id long, user_id long, ts timestamp_ntz, value double")
        df = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW["events"]])
        df.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    return str(folder)


def test_the_state_of_an_idle_user_is_gone(spark, tmp_path):
    folder = _events(
        spark, tmp_path, [(1, 0, 10.0), (2, 0, 5.0), (1, 1, 30.0)], [(2, 5, 7.0)], [(2, 10, 9.0)], [(2, 15, 1.0)], [(2, 20, 2.0), (1, 20, 8.0)], [(2, 21, 1.0)]
    )
    st = ST.expiring_state(ST.event_stream(spark, folder))
    base, q = ST.run_to_sink(st, "expiring-test")
    rows = spark.read.schema(st.schema).parquet(f"{base}/out").collect()
    # user 1: two events, gone six hours after the second; a new state began at hour 20
    assert [(r.user_id, r.n, r.mean_value, r.sd_value, r.expired_at.hour) for r in rows] == [(1, 2, 20.0, 14.142136, 7)]
    left = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert left == 2  # user 2's open state and user 1's new one


def test_recall_of_the_classifier_over_whole_folds(spark):
    rows = [("a", 0.9, 1, "val"), ("b", 0.5, 0, "val"), ("c", 0.1, 1, "val"), ("d", 0.9, 0, "train")]
    got = LE.risk_model_recall(spark.createDataFrame(rows, "customer_id string, gnn_risk_score double, is_suspicious_true long, split string"))
    by = {r.split: tuple(r)[1:] for r in got.collect()}
    assert by == {"val": (3, 2, 2, 1, 0.5, 0.5), "train": (1, 0, 1, 0, None, 0.0)}


def test_the_classifier_finds_a_signal(spark):
    from ledgerscope.functions.constants import NODE_FEATURES

    bad = "id % 9 = 0"
    x = spark.range(600).selectExpr("concat('C', id) AS customer_id", *[f"IF({bad}, 2.0, -0.2) + (id * 37 % 11) / 20.0 AS {c}" for c in NODE_FEATURES])
    custs = spark.range(600).selectExpr("concat('C', id) AS customer_id", f"{bad} AS is_suspicious")
    scored = LE.cut_lineage(LE.customer_risk_model(x, x, custs))
    got = {r.split: r for r in LE.risk_model_recall(scored).collect()}
    assert got["val"].recall >= 0.95 and got["val"].precision >= 0.95 and got["val"].suspicious > 5


def test_array_lines_and_object_files_score_alike(spark, tmp_path):
    rng = [round(50 + 37.77 * i % 900, 2) for i in range(60)]
    rows = [
        {"transaction_id": f"T{i}", "timestamp": "2024-06-15T10:30:00", "sender_id": f"C{i % 4}", "receiver_id": "C9", "amount_usd": a} for i, a in enumerate(rng)
    ]
    broken = {"transaction_id": "X", "sender_id": "C1", "amount_usd": -5}
    (tmp_path / "array.json").write_text(json.dumps([*rows, broken], indent=1))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, [broken, *rows])))
    (tmp_path / "objects").mkdir()
    for r in rows:
        (tmp_path / "objects" / f"{r['transaction_id']}.json").write_text(json.dumps(r))
    fitted = spark.createDataFrame([(0.8, 0.4)], "vae_max double, threshold double")
    scores = [
        sorted(tuple(r) for r in SCO.batch_scores(IO.score_json(spark, str(tmp_path / n), fitted)).collect()) for n in ("array.json", "lines.json", "objects")
    ]
    assert len(scores[0]) == 60 and scores[0] == scores[1] == scores[2]
    assert {r[3] for r in scores[0]} == {True, False}
    (tmp_path / "none.json").write_text("[]")
    assert IO.score_json(spark, str(tmp_path / "none.json"), fitted).count() == 0
