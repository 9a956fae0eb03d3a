"""Faults that leave small tables right: long keys, folders of files, common prefixes, empty input."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerscope.operators import evaluation as EV
from ledgerscope.operators import learning as LE
from ledgerscope.operators import sampling as SA
from ledgerscope.operators import sar as SR
from ledgerscope.operators import scoring as SC
from ledgerscope.operators.io_jobs import dataset_manifest
from ledgerscope.operators.prefix import dense_index, prefix_sums
from ledgerscope.session import ensure_checkpoint_dir
from ledgerscope.sources import ledger as L
from ledgerscope.sources import validate as VA
from ledgerscope.sources.tables import table_fingerprint
from ledgerscope.streaming import jobs as ST


def test_long_customer_keys_stay_apart(spark):
    keys = [7, 999_999, 100_000, 1_000_000, 1_000_009]
    got = [r.k for r in spark.createDataFrame([(k,) for k in keys], "c long").select(L.customer_key_to_id(F.col("c")).alias("k")).collect()]
    assert got == ["CUST_000007", "CUST_999999", "CUST_100000", "CUST_1000000", "CUST_1000009"]


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    """events as a folder of three part files."""
    out = tmp_path_factory.mktemp("tables")
    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(f"{out}/events.parquet")
    return str(out)


def test_streams_read_folders_of_files(spark, sf, folder):
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(ST.stream_alert_sink(spark, folder)) == rows(ST.stream_alert_sink(spark, sf)) != []
    assert ST.stream_velocity(spark, folder).count() > 0  # which windows are late depends on the files' order
    assert rows(ST.stream_sender_state(spark, folder)) == rows(ST.stream_sender_state(spark, sf)) != []
    counted = ST.stream_counters(spark, folder).collect()
    assert len(counted) == 3 and sum(r.events for r in counted) == spark.read.parquet(f"{sf}/events.parquet").count()


def test_manifest_lists_every_file(spark, sf, folder):
    whole = {r.file: r for r in dataset_manifest(spark, sf).collect()}
    assert len(whole) == 14 and whole["lineitem.parquet"].rows == spark.read.parquet(f"{sf}/lineitem.parquet").count()
    parts = dataset_manifest(spark, folder).collect()
    assert len(parts) == 3 and sum(r.rows for r in parts) == whole["events.parquet"].rows


def test_keys_with_a_common_prefix_spread_over_tasks(spark):
    keys = spark.range(3000).select(F.format_string("CUSTOMER_ACCOUNT_%08d", "id").alias("k"))
    got = dense_index(keys, "k", n_partitions=6)
    assert [r.idx for r in got.orderBy("k").collect()] == list(range(3000))
    ranged = keys.repartitionByRange(6, "k").groupBy(F.spark_partition_id()).count().collect()
    assert len(ranged) == 6


def test_prefix_sums_with_one_leading_value(spark):
    df = spark.range(500).select(F.lit(1).alias("t"), "id", F.lit(2).alias("v"))
    assert [r.v_cum for r in prefix_sums(df, [F.col("t"), F.col("id").desc()], ["v"], n_partitions=4).orderBy(F.desc("id")).collect()] == [2 * (i + 1) for i in range(500)]


def test_shuffle_rows_keeps_all_and_has_no_limit(spark, sf):
    df = SA.shuffle_rows(spark.range(100).select(F.col("id").cast("string").alias("transaction_id")))
    assert df.count() == 100 and "Limit" not in df._jdf.queryExecution().executedPlan().toString()


def test_malformed_times_become_the_default(spark):
    rows = [('{"transaction_id":"a","timestamp":"not a time"}',), ('{"transaction_id":"b","timestamp":"2024-02-03T04:05:06"}',), ('{"transaction_id":"c"}',)]
    got = {r.transaction_id: str(r.timestamp) for r in VA.parse_records(spark.createDataFrame(rows, "record string")).collect()}
    assert got == {"a": VA.DEFAULT_TIMESTAMP, "b": "2024-02-03 04:05:06", "c": VA.DEFAULT_TIMESTAMP}


def test_auc_beyond_bigint(spark):
    df = spark.createDataFrame([(0.1, 0, 60_000_000_000), (0.9, 800_000_000, 0), (0.5, 1, 1)], "score double, pos long, neg long")
    num = F.sum(F.col("pos").cast("decimal(17,0)") * (F.col("neg") * 2).cast("decimal(20,0)"))
    assert df.agg(num).first()[0] is not None
    flat = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.4)], "y_true int, y_score double")
    assert EV.roc_auc(flat).first().roc_auc == 0.875


def test_equal_rows_do_not_cancel_in_a_fingerprint(spark):
    one = spark.createDataFrame([(1,)], "a int")
    prints = {str(table_fingerprint(df).first().fingerprint) for df in (one.limit(0), one, one.unionAll(one), one.unionAll(one).unionAll(one))}
    assert len(prints) == 4


@pytest.mark.parametrize("name", ["transaction_summary", "command_center_kpis", "prevalence_baseline", "classification_metrics", "roc_auc", "average_precision", "detection_cost", "sar_kpis", "did_effect", "score_summary", "label_counts", "class_distribution", "daily_alert_trend", "hourly_velocity", "near_threshold", "fan_out"])
def test_aggregates_of_an_empty_ledger(spark, sf, name, tmp_path_factory):
    import __spark_entry__ as E

    out = _empty(spark, sf, tmp_path_factory)
    assert E.queries()[name](spark, out).collect() is not None


_EMPTY = []


def _empty(spark, sf, factory):
    if not _EMPTY:
        out = factory.mktemp("empty")
        for t in ("region", "nation", "customer", "orders", "lineitem", "events"):
            spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{out}/{t}.parquet")
        _EMPTY.append(str(out))
    return _EMPTY[0]


def test_second_detector_tells_rows_apart(spark, sf):
    got = LE.real_vs_permuted_scores(L.transactions(spark, sf)).agg(F.stddev("gan_score").alias("sd"), F.avg("gan_score").alias("m")).first()
    assert got.sd > 0.02 and 0 < got.m < 0.5


def test_permutation_does_not_depend_on_partitions(spark):
    from ledgerscope.functions.constants import TRANSACTION_FEATURES as FEATS

    df = spark.range(200).select(*[(F.col("id") * (i + 1)).cast("double").alias(c) for i, c in enumerate(FEATS)])
    rows = [sorted(map(tuple, LE.permuted_rows(df.repartition(n)).collect())) for n in (1, 7)]
    assert rows[0] == rows[1] and len(rows[0]) == 200
    assert sum(abs(r[1] - 2 * r[0]) < 1e-9 for r in rows[0]) < 20  # columns no longer belong together


def test_fused_scores_lose_no_row(spark):
    df = spark.createDataFrame([("a", 1.0, 0.5, 1.0), ("b", 1.0, 0.5, None)], "transaction_id string, vae_score double, combined_score double, gan_score double")
    assert {r.transaction_id: r.combined_score for r in SC.fused_scores(df).collect()} == {"a": 0.7, "b": 0.5}


def test_sar_ids_do_not_depend_on_the_batch(spark, sf):
    import __spark_entry__ as E

    ids = [r.sar_id for r in E.queries()["sar_summary"](spark, sf).collect()]
    assert all(len(i) == len("SAR-") + 16 for i in ids) and SR is not None and not any(math.isnan(len(i)) for i in ids)


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        ensure_checkpoint_dir(Session())
