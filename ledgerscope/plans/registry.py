"""Named query registry: key -> function(spark, sf_dir) -> DataFrame.

Each entry reads the raw tables under ``sf_dir`` and derives everything else
with Spark, so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerscope.operators import presets as P
from ledgerscope.sources import ledger as L

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


_WRITTEN: dict[tuple, str] = {}


def _version(spark: SparkSession, sf: str) -> str:
    """Names, sizes and times of what lies in the source folder: refreshed input
    is derived anew."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return "|".join(sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in fs.listStatus(path)))


def _key(spark: SparkSession, sf: str, name: str) -> tuple:
    return spark.sparkContext.applicationId, sf.rstrip("/"), name, _version(spark, sf)


def written(spark: SparkSession, sf: str, name: str, build, by: str | None = None) -> DataFrame:
    """A derived table written once per Spark application into the shared
    checkpoint folder and read back by every later query (the pipeline's
    materialised tables: ledger, customers, scores, graph risk). The key
    includes the application id and the source directory, so a new
    application or another scale directory derives it afresh. ``by`` partitions the
    folder by a column, so that filters on it skip files; rows are written by the tasks
    that hold them, without another shuffle. Derivation and write get shuffles for the
    rows of the ledger; what they cut and shuffled goes once the table is written."""
    from ledgerscope.session import DROP_SHUFFLES, ensure_checkpoint_dir, options, passing_cuts, shuffles_for
    from ledgerscope.sources.tables import read_raw

    key = _key(spark, sf, name)
    path = _WRITTEN.get(key)
    if path is None:
        import uuid

        # one folder per application, so a whole run's tables expire together
        app = spark.sparkContext.applicationId
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{app}/{name}-{uuid.uuid4().hex[:12]}"
        rows = read_raw(spark, sf, "lineitem").count()  # from the footers
        with shuffles_for(spark, rows), options(spark, DROP_SHUFFLES), passing_cuts(spark):
            df = build()
            if by:
                df = df.select(*[c for c in df.columns if c != by], by)
                df.write.mode("overwrite").partitionBy(by).parquet(path)
            else:
                df.write.mode("overwrite").parquet(path)
        _WRITTEN[key] = path
        _SCHEMAS[key] = df.schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


_SCHEMAS: dict[tuple, object] = {}


def tx_quarterly(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger with its partition column ``txn_quarter``."""
    return written(spark, sf, "transactions", lambda: L.with_quarter(L.transactions(spark, sf)), by="txn_quarter")


def tx(spark: SparkSession, sf: str) -> DataFrame:
    return tx_quarterly(spark, sf).drop("txn_quarter")


def planted(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger with planted patterns, for rules that the ledger alone never meets."""
    from ledgerscope.sources import planted as PL

    ledger = tx(spark, sf).select(*PL.COLUMNS)
    return ledger.unionByName(written(spark, sf, "planted", lambda: PL.planted_rows(spark, sf)))


def cu(spark: SparkSession, sf: str) -> DataFrame:
    return written(spark, sf, "customers", lambda: L.customers(spark, sf))


# --- scans / projections ---------------------------------------------------------------
register("scan_transactions")(lambda s, d: tx(s, d))
register("scan_customers")(lambda s, d: cu(s, d))
register("transaction_edges")(lambda s, d: L.transaction_edges(tx(s, d)))

# --- presets ------------------------------------------------------------------------------
register("transaction_summary")(lambda s, d: P.transaction_summary(tx(s, d)))
register("top_suspicious_customers")(lambda s, d: P.top_suspicious_customers(tx(s, d)))
register("daily_alert_trend")(lambda s, d: P.daily_alert_trend(tx_quarterly(s, d)))
register("typology_breakdown")(lambda s, d: P.typology_breakdown(tx(s, d)))
register("cross_border_corridors")(lambda s, d: P.cross_border_corridors(tx(s, d)))
register("structuring_alerts")(lambda s, d: P.structuring_alerts(tx(s, d)))
register("hourly_velocity")(lambda s, d: P.hourly_velocity(tx(s, d)))
register("weekly_alert_timeline")(lambda s, d: P.weekly_alert_timeline(tx(s, d)))
register("label_counts")(lambda s, d: P.label_counts(tx(s, d)))
register("class_distribution")(lambda s, d: P.class_distribution(tx(s, d)))
register("hour_class_crosstab")(lambda s, d: P.hour_class_crosstab(tx(s, d)))
register("suspicion_by_jurisdiction")(lambda s, d: P.suspicion_by_jurisdiction(tx(s, d), cu(s, d)))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for keys compared after rounding)."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


from pyspark.sql import functions as F  # noqa: E402

from ledgerscope.functions import scalar as SC  # noqa: E402
from ledgerscope.operators import features as FE  # noqa: E402
from ledgerscope.operators import scoring as SCO  # noqa: E402


def _sender_stats(s, d):
    return written(s, d, "sender_stats", lambda: FE.sender_stats(tx(s, d)))


def _finished(s, d, raw):
    """What is fitted is one written row; the finished scores follow from it and the raw
    ones by column arithmetic. Both raw tables rest on the same written sender statistics,
    so their scores, and what is fitted on them, are the same."""
    return SCO.finish_scores(raw, written(s, d, "score_fit", lambda: SCO.score_fit(raw)))


def _scores(s, d):
    """The raw scores, written once: downstream keys read them several times
    (fitted max, p95 threshold, sweeps, curves), and a lost executor resumes
    from the written table instead of re-deriving it."""
    keep = ["transaction_type", "gan_score"]
    return _finished(s, d, written(s, d, "raw_scores", lambda: SCO.raw_scores(tx(s, d), keep=keep, stats=_sender_stats(s, d))))


def _sender_scores(s, d):
    """The same scores with sender and truth alone, for what lists no transfers (curves,
    counts, sums by sender): ids, partners and amounts are most of the bytes that the join
    by sender shuffles. Where the whole table is written already, it is read instead."""
    if _key(s, d, "raw_scores") in _WRITTEN:
        return _scores(s, d).select("sender_id", "is_suspicious", "vae_score", "combined_score", "threshold", "is_flagged")
    base = ["sender_id", "is_suspicious"]
    return _finished(s, d, written(s, d, "sender_scores", lambda: SCO.raw_scores(tx(s, d), base=base, stats=_sender_stats(s, d))))


def _risk(s, d):
    return written(s, d, "risk", lambda: SCO.customer_risk_scores(tx(s, d), cu(s, d)))


register("txn_features")(lambda s, d: round_doubles(FE.transaction_features(tx(s, d))))
register("sender_zscore")(lambda s, d: FE.sender_zscore(tx(s, d)))
register("node_features")(lambda s, d: round_doubles(FE.node_features(tx(s, d), cu(s, d))))
register("node_features_scaled")(lambda s, d: round_doubles(FE.node_features_scaled(tx(s, d), cu(s, d))))
register("weighted_edges")(lambda s, d: round_doubles(FE.weighted_edges(tx(s, d))))
register("customer_risk_scores")(_risk)
register("anomaly_scores")(
    lambda s, d: _scores(s, d).select("transaction_id", "vae_score", "combined_score", "threshold", "is_flagged")
)
register("anomaly_threshold")(lambda s, d: SCO.anomaly_threshold(_sender_scores(s, d)))
register("customer_alerts")(lambda s, d: SCO.customer_alerts(_sender_scores(s, d)))
register("flagged_transactions")(lambda s, d: SCO.flagged_transactions(_scores(s, d)))
register("fused_scores")(lambda s, d: SCO.fused_scores(_scores(s, d)))
register("batch_scores")(lambda s, d: SCO.batch_scores(_scores(s, d)))
register("high_risk_network")(lambda s, d: P.high_risk_network(tx(s, d), _risk(s, d)))
register("anomaly_flagged_customers")(lambda s, d: P.anomaly_flagged_customers(SCO.customer_alerts(_sender_scores(s, d))))

from ledgerscope.operators import prefix as PX  # noqa: E402
from ledgerscope.operators import profiles as PR  # noqa: E402


def _scores_t(s, d):
    return _scores(s, d)


def _flagged(s, d):
    return _scores_t(s, d).filter("is_flagged = 1")


register("alert_levels")(
    lambda s, d: SCO.batch_scores(_scores(s, d)).groupBy("alert_level").count().withColumnRenamed("count", "txn_count")
)
register("customer_risk_labels")(lambda s, d: PR.customer_risk_labels(_risk(s, d), cu(s, d)))
register("round_amount_flag")(
    lambda s, d: tx(s, d).select(
        "transaction_id", "amount_usd", SC.round_amount_flag(F.col("amount_cents")).alias("round_amount")
    )
)
register("jurisdiction_risk")(lambda s, d: PR.country_jurisdiction(tx(s, d), PR.jurisdiction_lookup(s, cu(s, d))))
register("recent_alerts")(lambda s, d: PR.recent_alerts(tx(s, d)))
register("alerts_page")(lambda s, d: PR.alerts_page(_scores(s, d)))
register("alerts_with_truth")(lambda s, d: PR.alerts_with_truth(SCO.customer_alerts(_sender_scores(s, d)), tx(s, d)))
register("fallback_alert_scores")(lambda s, d: PR.fallback_alert_scores(tx(s, d)))
register("sender_activity_profile")(lambda s, d: PR.sender_activity_profile(tx(s, d)))
register("score_histogram")(lambda s, d: PR.score_histogram(_sender_scores(s, d)))
register("winsorized_amounts")(lambda s, d: PR.winsorized_amounts(tx(s, d)))
register("score_summary")(lambda s, d: PR.score_summary(_sender_scores(s, d)))
register("top_risk_customers")(lambda s, d: PR.top_risk_customers(_risk(s, d), cu(s, d)))
register("rule_vs_graph")(lambda s, d: PR.rule_vs_graph(_risk(s, d), cu(s, d)))
register("high_risk_by_jurisdiction")(lambda s, d: PR.high_risk_by_jurisdiction(_risk(s, d), cu(s, d)))
register("involved_customers")(lambda s, d: PR.involved_customers(_flagged(s, d)))
register("flagged_sender_context")(lambda s, d: PR.flagged_sender_context(_flagged(s, d)))
register("investigation_summary")(lambda s, d: PR.investigation_summary(_flagged(s, d), _risk(s, d)))
register("batch_risk_summary")(lambda s, d: PR.batch_risk_summary(_scores(s, d), _risk(s, d)))
register("edge_coo")(
    lambda s, d: (
        lambda t, ix: t.join(ix.withColumnRenamed("customer_id", "sender_id").withColumnRenamed("idx", "src_idx"), "sender_id")
        .join(ix.withColumnRenamed("customer_id", "receiver_id").withColumnRenamed("idx", "dst_idx"), "receiver_id")
        .select("transaction_id", "src_idx", "dst_idx")
    )(tx(s, d), PX.dense_index(cu(s, d), "customer_id"))
)
register("node_index")(lambda s, d: PX.dense_index(cu(s, d), "customer_id"))

from ledgerscope.operators import causal as CA  # noqa: E402
from ledgerscope.operators import evaluation as EV  # noqa: E402


def _eval(s, d):
    return _sender_scores(s, d).select(
        F.col("is_suspicious").cast("int").alias("y_true"),
        F.col("is_flagged").alias("y_pred"),
        F.col("combined_score").alias("y_score"),
    )


register("classification_metrics")(lambda s, d: EV.classification_metrics(_eval(s, d)))
register("roc_auc")(lambda s, d: EV.roc_auc(_eval(s, d)))
register("average_precision")(lambda s, d: EV.average_precision(_eval(s, d)))
register("pr_curve")(lambda s, d: EV.pr_curve(_eval(s, d)))
register("optimal_threshold")(lambda s, d: EV.optimal_threshold(_eval(s, d)))
register("optimal_threshold_metrics")(lambda s, d: EV.optimal_metrics(_eval(s, d)))
register("threshold_sensitivity")(lambda s, d: EV.threshold_sensitivity(_eval(s, d)))
register("detection_cost")(lambda s, d: EV.detection_cost(EV.confusion_counts(_eval(s, d))))
register("confusion_matrix")(lambda s, d: EV.confusion_matrix(_eval(s, d)))
register("classification_report")(lambda s, d: EV.classification_report(_eval(s, d)))
register("prevalence_baseline")(lambda s, d: EV.prevalence(_eval(s, d)))
register("did_effect")(lambda s, d: CA.did_effect(tx(s, d)))
register("rule_effect")(lambda s, d: CA.rule_effect(tx(s, d)))
register("did_bootstrap")(lambda s, d: CA.did_bootstrap(tx(s, d)))
register("whatif_threshold")(lambda s, d: CA.whatif_threshold(_scores(s, d)))
register("whatif_sweep")(lambda s, d: CA.whatif_sweep(_scores(s, d)))
register("whatif_rule")(lambda s, d: CA.whatif_rule(tx(s, d), "Flag all cash deposits near $10K (structuring)", 0.15, 35.0))
register("whatif_rules_table")(lambda s, d: CA.whatif_rules_table(tx(s, d)))

from ledgerscope.operators import detectors as DT  # noqa: E402

register("smurfing_windows")(lambda s, d: DT.smurfing_windows(tx(s, d)))
register("round_trips_2")(lambda s, d: DT.round_trips(tx(s, d), depth=2))
register("round_trips_3")(lambda s, d: DT.round_trips(tx(s, d), depth=3))
# deeper chains need a wider hop here: the derived ledger's amounts and times are unrelated from hop to hop
register("round_trips_4")(lambda s, d: DT.round_trips(tx(s, d), depth=4, max_hop_days=20))
register("round_trips_5")(lambda s, d: DT.round_trips(tx(s, d), depth=5, max_hop_days=20))
# the same chains under the laundering rules, over the ledger with planted chains: hops of
# 1 to 24 h, hop i with (0.90 to 0.99)^i of the first amount
for _depth in range(2, 6):
    register(f"round_trips_rules_{_depth}")(
        lambda s, d, n=_depth: DT.round_trips(planted(s, d), depth=n, max_hop_days=1, min_hop_hours=1, kept=(90, 99))
    )
register("rapid_movement")(lambda s, d: DT.rapid_movement(tx(s, d)))
register("tbml_pairs")(lambda s, d: DT.tbml_pairs(tx(s, d)))
register("fan_out")(lambda s, d: DT.fan_out(tx(s, d)))
register("fan_in")(lambda s, d: DT.fan_in(planted(s, d)))
register("near_threshold")(lambda s, d: DT.near_threshold(tx(s, d)))
register("rule_risk_score")(lambda s, d: DT.rule_risk_score(tx(s, d), cu(s, d)))

from ledgerscope.operators import communities as CM  # noqa: E402
from ledgerscope.operators import graph as GR  # noqa: E402
from ledgerscope.operators import strong as SG  # noqa: E402

EGO_CENTER = "CUST_000025"


def _g(s, d):
    t = tx(s, d)
    return GR.graph_edges(t), GR.graph_nodes(t)


register("graph_edges")(lambda s, d: GR.graph_edges(tx(s, d)))
register("graph_nodes")(lambda s, d: GR.graph_nodes(tx(s, d)))
register("connected_components")(lambda s, d: GR.connected_components(*_g(s, d)))
register("strong_components")(lambda s, d: SG.strong_components(*_g(s, d)))
register("graph_component_counts")(lambda s, d: GR.component_counts(*_g(s, d)))
register("graph_clustering")(lambda s, d: GR.triangles(GR.graph_edges(tx(s, d))))
register("graph_stats")(lambda s, d: GR.graph_stats(*_g(s, d), risk=_risk(s, d)))
register("ego_subgraph")(lambda s, d: GR.ego_subgraph(GR.graph_edges(tx(s, d)), EGO_CENTER))
register("propagated_features")(
    lambda s, d: round_doubles(GR.propagate_features(FE.node_features_scaled(tx(s, d), cu(s, d)), tx(s, d)))
)
register("communities")(lambda s, d: CM.communities(*_g(s, d)))
register("label_communities")(lambda s, d: GR.label_propagation(*_g(s, d)))
register("modularity")(
    lambda s, d: (lambda e, n: GR.modularity(e, GR.connected_components(e, n), "component"))(*_g(s, d))
)
register("community_modularity")(lambda s, d: (lambda e, n: GR.modularity(e, CM.communities(e, n)))(*_g(s, d)))

from ledgerscope.operators import sampling as SA  # noqa: E402
from ledgerscope.operators import sar as SR  # noqa: E402


def _suspects(s, d):
    return SR.top_suspects(cu(s, d), _risk(s, d), SCO.customer_alerts(_sender_scores(s, d)))


def _sar_base(s, d):
    return SR.sar_base(tx(s, d), _suspects(s, d))


register("top_suspects")(_suspects)
register("sar_summary")(lambda s, d: SR.sar_summary(_sar_base(s, d)))
register("sar_narratives")(lambda s, d: SR.sar_narratives(_sar_base(s, d)))
register("sar_narratives_short")(lambda s, d: SR.sar_narratives_short(_sar_base(s, d)))
register("sar_filtered")(lambda s, d: SR.sar_filtered(SR.sar_summary(_sar_base(s, d))))
register("sar_lookup")(lambda s, d: SR.sar_lookup(SR.sar_reports(_sar_base(s, d))))
register("sar_kpis")(lambda s, d: SR.sar_kpis(SR.sar_summary(_sar_base(s, d))))
register("engine_usage")(lambda s, d: SR.engine_usage(SR.sar_summary(_sar_base(s, d))))
register("command_center_kpis")(lambda s, d: SR.command_center_kpis(tx(s, d), SR.sar_summary(_sar_base(s, d))))
register("sample_scatter")(lambda s, d: SA.sample_n(tx(s, d), 5000).select("transaction_id", "sender_id", "receiver_id", "amount_usd"))
register("balanced_sample")(
    lambda s, d: SA.balanced_sample(tx(s, d), "is_suspicious", {True: 200, False: 200}).select(
        "transaction_id", "is_suspicious", "amount_usd"
    )
)
register("stratified_split")(lambda s, d: SA.stratified_split(tx(s, d)))
register("stratified_split_3way")(lambda s, d: SA.stratified_split_3way(tx(s, d)))

from ledgerscope.operators import io_jobs as IO  # noqa: E402
from ledgerscope.sources import validate as VA  # noqa: E402


def _records(s, d):
    return VA.parse_records(VA.to_records(tx(s, d)))


def feature_correlation(df, cols):
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    stacked = one.select(
        F.explode(
            F.array(*[F.struct(F.lit(a).alias("feature_1"), F.lit(b).alias("feature_2"), F.col(f"{a}__{b}").alias("r")) for a, b in pairs])
        ).alias("x")
    ).select("x.*")
    return stacked.select("feature_1", "feature_2", F.when(~F.isnan("r"), F.round("r", 6)).alias("correlation"))


def graph_view_nodes(txns, risk, n_edges=1500):
    smp = SA.sample_n(txns, n_edges)
    e = smp.select(F.col("sender_id").alias("src"), F.col("receiver_id").alias("dst")).distinct()
    deg = GR.degrees(e.withColumn("weight", F.lit(1)))
    mx = deg.select(F.max("degree")).scalar()
    r = risk.select(F.col("customer_id").alias("node"), "gnn_risk_score")
    return deg.join(r, "node", "left").select(
        "node", "degree",
        F.round(F.lit(15.0) + F.lit(180) * F.col("degree") / mx, 6).alias("node_size"),
        F.coalesce("gnn_risk_score", F.lit(0.15)).alias("colour_score"),
    )


def _flawed(s, d):
    from ledgerscope.sources.planted import flawed_records

    r = _records(s, d)
    return flawed_records(r, F.round(F.col("amount_usd") * 100).cast("long"))


def high_risk_clusters(flagged, risk, txns, min_risk=0.6):
    inv = PR.involved_customers(flagged)
    hr = inv.join(risk.filter(F.col("gnn_risk_score") > min_risk).select("customer_id"), "customer_id", "left_semi")
    e = GR.graph_edges(txns)
    sub = GR.ego_edges(e, hr.withColumnRenamed("customer_id", "node"))
    cc = GR.connected_components(sub, hr.withColumnRenamed("customer_id", "node"))
    sizes = cc.groupBy("component").agg(F.count(F.lit(1)).alias("cluster_size"))
    return cc.join(sizes, "component").withColumnRenamed("component", "cluster_id")


register("roundtrip_parquet")(lambda s, d: IO.roundtrip_parquet(tx(s, d)))
register("roundtrip_csv")(lambda s, d: IO.roundtrip_csv(tx(s, d)))
register("roundtrip_json")(lambda s, d: IO.roundtrip_json_records(tx(s, d)))
register("score_json_batch")(lambda s, d: SCO.batch_scores(IO.score_json_roundtrip(tx(s, d), SCO.fitted_scale(_sender_scores(s, d)))))
register("score_result_files")(
    lambda s, d: IO.score_result_roundtrip(PR.batch_risk_summary(_scores(s, d), _risk(s, d)), SCO.flagged_transactions(_scores(s, d)))
)
register("parse_records")(_records)
register("validate_valid")(lambda s, d: VA.validate_valid(_records(s, d)))
register("validate_quarantine")(lambda s, d: VA.validate_quarantine(_flawed(s, d)))
register("validate_flawed")(lambda s, d: VA.validate_valid(_flawed(s, d)))
register("sar_reports_json")(lambda s, d: IO.sar_reports_roundtrip(SR.sar_reports(_sar_base(s, d))))
register("sar_reports_flat")(lambda s, d: IO.sar_reports_flat(REGISTRY["sar_reports_json"](s, d)))
register("dataset_manifest")(lambda s, d: IO.dataset_manifest(s, d))
register("manifest_rows")(lambda s, d: IO.manifest_rows(REGISTRY["dataset_manifest"](s, d)))
register("evaluation_report_fields")(
    lambda s, d: IO.report_fields(REGISTRY["evaluation_report"](s, d), EV.classification_metrics(_eval(s, d)))
)
register("detector_metadata_flat")(lambda s, d: IO.detector_metadata_flat(REGISTRY["detector_metadata"](s, d)))
register("evaluation_report")(
    lambda s, d: IO.evaluation_report(EV.classification_metrics(_eval(s, d)), "zscore-standin", "2024-01-01T00:00:00Z")
)
register("detector_metadata")(
    lambda s, d: IO.detector_metadata(SCO.anomaly_threshold(_sender_scores(s, d)), EV.confusion_matrix(_eval(s, d)))
)
register("valid_edges")(
    lambda s, d: GR.ego_edges(GR.graph_edges(tx(s, d)), cu(s, d).select(F.col("customer_id").alias("node"))).select(
        "src", "dst", "weight"
    )
)
register("orphan_edges")(
    lambda s, d: GR.graph_edges(planted(s, d))
    .join(cu(s, d).select(F.col("customer_id").alias("src")), "src", "left_anti")
    .unionByName(GR.graph_edges(planted(s, d)).join(cu(s, d).select(F.col("customer_id").alias("dst")), "dst", "left_anti"))
    .select("src", "dst", "weight")
    .distinct()
)
register("feature_correlation")(
    lambda s, d: feature_correlation(
        FE.transaction_features(tx(s, d), keep=["is_suspicious"]).withColumn("is_suspicious", F.col("is_suspicious").cast("double")),
        list(FE.TRANSACTION_FEATURES) + ["is_suspicious"],
    )
)
register("graph_view_nodes")(lambda s, d: graph_view_nodes(tx(s, d), _risk(s, d)))
register("high_risk_clusters")(lambda s, d: high_risk_clusters(_flagged(s, d), _risk(s, d), tx(s, d)))
_PRESETS = [
    "transaction_summary", "top_suspicious_customers", "daily_alert_trend", "typology_breakdown", "cross_border_corridors",
    "structuring_alerts", "hourly_velocity", "high_risk_network", "anomaly_flagged_customers",
]
register("preset_manifest")(
    lambda s, d: IO.preset_manifest(
        s, d, {k: REGISTRY[k] for k in _PRESETS}, needs={k: ["orders", "lineitem", "customer", "nation"] for k in _PRESETS}
    )
)
register("preset_rows")(
    lambda s, d: REGISTRY["preset_manifest"](s, d).select(F.col("name").alias("preset"), "status", "rows")
)

from ledgerscope.operators import learning as LE  # noqa: E402


def _scaled(s, d):
    fr = LE.training_frame(tx(s, d))
    return fr, LE.fit_scaler(fr)


def _fitted(s, d):
    rows = written(s, d, "fitted_rows", lambda: LE.fitted_rows(tx(s, d)))
    return LE.finish_fitted(rows, written(s, d, "fitted_fit", lambda: LE.fitted_fit(rows)))


register("scaled_features")(lambda s, d: (lambda fr, m: round_doubles(LE.scaled_features(fr, m)))(*_scaled(s, d)))
register("unscaled_features")(
    lambda s, d: (lambda fr, m: round_doubles(LE.unscaled_features(LE.scaled_features(fr, m), m)))(*_scaled(s, d))
)
register("pca_anomaly_scores")(lambda s, d: LE.anomaly_scores(tx(s, d)))
register("real_vs_permuted_scores")(lambda s, d: LE.real_vs_permuted_scores(tx(s, d)))
register("fitted_scores")(
    lambda s, d: _fitted(s, d).select("transaction_id", "vae_score", "gan_score", "combined_score", "threshold", "is_flagged")
)
register("fitted_customer_alerts")(lambda s, d: SCO.customer_alerts(_fitted(s, d)))


def _fitted_suspects(s, d):
    return SR.top_suspects(cu(s, d), _risk_model(s, d), SCO.customer_alerts(_fitted(s, d)))


def _fitted_checks(s, d):
    """Counts that hold for any fit: every transfer has a score in [0, 1] and the flag
    follows the threshold."""
    f = _fitted(s, d)
    score = F.col("combined_score")
    return f.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_if(score.isNull() | (score < 0) | (score > 1)).alias("out_of_range"),
        F.count_if((score >= F.col("threshold")).cast("int") != F.col("is_flagged")).alias("wrong_flags"),
        F.sum("amount_cents").alias("amount_cents"),
    )


def _fitted_eval(s, d):
    return _fitted(s, d).select(
        F.col("is_suspicious").cast("int").alias("y_true"), F.col("is_flagged").alias("y_pred"), F.col("combined_score").alias("y_score")
    )


register("fitted_top_suspects")(_fitted_suspects)
register("fitted_checks")(_fitted_checks)
register("fitted_sar_summary")(lambda s, d: SR.sar_summary(SR.sar_base(tx(s, d), _fitted_suspects(s, d))))
register("fitted_classification_metrics")(lambda s, d: EV.classification_metrics(_fitted_eval(s, d)))
register("fitted_whatif_threshold")(lambda s, d: CA.whatif_threshold(_fitted(s, d)))
register("fitted_batch_risk_summary")(lambda s, d: PR.batch_risk_summary(_fitted(s, d), _risk_model(s, d)))
register("anomaly_attribution")(lambda s, d: LE.anomaly_attribution(tx(s, d)))
register("tree_attribution")(lambda s, d: LE.tree_attribution(tx(s, d)))
register("feature_importance")(lambda s, d: LE.feature_importance(LE.anomaly_attribution(tx(s, d))))
register("minority_oversample")(lambda s, d: LE.minority_oversample(tx(s, d)))
register("oversample_checks")(
    lambda s, d: LE.minority_oversample(tx(s, d)).agg(
        F.count(F.lit(1)).alias("synthetic"), F.countDistinct("transaction_id").alias("ids"),
        F.count_if(F.col("amount_usd").isNull() | (F.col("amount_usd") < 0)).alias("broken"),
    )
)
register("projection_2d")(lambda s, d: LE.projection_2d(tx(s, d)))
register("background_centres")(lambda s, d: LE.background_centres(tx(s, d)))


def _risk_model(s, d):
    from ledgerscope.session import cut_lineage

    def build():
        x = cut_lineage(FE.node_features_scaled(tx(s, d), cu(s, d)))
        return LE.customer_risk_model(x, GR.propagate_features(x, tx(s, d)), cu(s, d))

    return written(s, d, "risk_model", build)


register("customer_risk_model")(_risk_model)
register("customer_risk_recall")(lambda s, d: LE.risk_model_recall(_risk_model(s, d)))
register("customer_risk_checks")(
    lambda s, d: LE.risk_model_recall(_risk_model(s, d)).agg(
        F.sum("customers").alias("customers"), F.sum("suspicious").alias("suspicious"), F.count_if(F.col("caught") > F.col("flagged")).alias("impossible")
    )
)
register("dr_effect")(lambda s, d: LE.dr_effect(tx(s, d)))

from ledgerscope.streaming import jobs as ST  # noqa: E402



def _events(s, d, name):
    """A folder whose events table is the named derivation of the given one."""
    import uuid

    from ledgerscope.session import ensure_checkpoint_dir
    from ledgerscope.sources import planted as PL

    base = f"{ensure_checkpoint_dir(s).rstrip('/')}/tables/{s.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    getattr(PL, name)(s, d).write.parquet(f"{base}/events.parquet")
    return base


register("stream_velocity")(ST.stream_velocity)
register("stream_structuring")(ST.stream_structuring)
register("stream_sessions")(ST.stream_sessions)
register("stream_dedup")(lambda s, d: ST.stream_dedup(s, _events(s, d, "resent_events")))
register("stream_scores")(ST.stream_scores)
register("stream_sender_state")(ST.stream_sender_state)
register("stream_sender_state_expiring")(ST.stream_sender_state_expiring)
register("stream_alert_sink")(lambda s, d: ST.stream_alert_sink(s, _events(s, d, "refused_events")))
register("stream_quarantine_sink")(lambda s, d: ST.stream_alert_sink(s, _events(s, d, "refused_events"), part="quarantine"))
register("stream_counters")(ST.stream_counters)

from ledgerscope.operators import ml_stages as MS  # noqa: E402


def adhoc_sql(s, d, query=None):
    """Register the ledger views and run a Spark SQL query over them."""
    from ledgerscope.sources.tables import register_views

    register_views(s, {"transactions": tx(s, d), "customers": cu(s, d)})
    return s.sql(
        query
        or """
        SELECT c.jurisdiction_risk, t.transaction_type, COUNT(*) AS txn_count,
               SUM(t.amount_cents) / 100.0D AS total_usd
        FROM transactions t JOIN customers c ON t.sender_id = c.customer_id
        WHERE t.is_suspicious
        GROUP BY c.jurisdiction_risk, t.transaction_type"""
    )


def batch_counters(s, d):
    """Running counters over a batch via Observation (metrics collected with
    the action, no second pass)."""
    from pyspark.sql import Observation

    obs = Observation("counters")
    t = tx(s, d).observe(obs, F.count(F.lit(1)).alias("requests"), F.count_if("is_suspicious").alias("alerts"))
    t.write.format("noop").mode("overwrite").save()
    m = obs.get
    return s.createDataFrame([(int(m["requests"]), int(m["alerts"]))], "requests long, alerts long")


def typology_alerts(s, d):
    from ledgerscope.session import passing_cuts

    t = tx(s, d)
    parts = [
        ("smurfing", DT.smurfing_windows),
        ("round_trip_2", lambda t: DT.round_trips(t, 2)),
        ("round_trip_3", lambda t: DT.round_trips(t, 3)),
        ("rapid_movement", DT.rapid_movement),
        ("tbml", DT.tbml_pairs),
        ("fan_out", DT.fan_out),
        ("near_threshold", DT.near_threshold),
    ]
    out = None
    for name, detect in parts:
        # one by one: what a detector cut and shuffled goes before the next one runs
        with passing_cuts(s) as keep:
            one = keep(detect(t).agg(F.count(F.lit(1)).alias("alerts")).select(F.lit(name).alias("typology"), "alerts"))
        out = one if out is None else out.unionByName(one)
    return out


def cost_comparison(s, d, ratio=0.9):
    sc = _sender_scores(s, d)
    out = None
    for name, thr in (("current", F.col("threshold")), ("lowered", F.col("threshold") * F.lit(ratio))):
        ev = sc.select(
            F.col("is_suspicious").cast("int").alias("y_true"),
            (F.col("combined_score") >= thr).cast("int").alias("y_pred"),
        )
        one = EV.detection_cost(EV.confusion_counts(ev)).select(F.lit(name).alias("operating_point"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def metrics_from_matrix(s, d):
    """Metrics re-derived from a stored confusion matrix (long form)."""
    cm = EV.confusion_matrix(_eval(s, d))
    c = cm.agg(
        F.sum(F.when((F.col("true_label") == 1) & (F.col("pred_label") == 1), F.col("count")).otherwise(0)).alias("true_positives"),
        F.sum(F.when((F.col("true_label") == 0) & (F.col("pred_label") == 1), F.col("count")).otherwise(0)).alias("false_positives"),
        F.sum(F.when((F.col("true_label") == 0) & (F.col("pred_label") == 0), F.col("count")).otherwise(0)).alias("true_negatives"),
        F.sum(F.when((F.col("true_label") == 1) & (F.col("pred_label") == 0), F.col("count")).otherwise(0)).alias("false_negatives"),
    )
    return EV.metrics_from_counts(c)


def udf_scores(s, d):
    """The reconstruction score through the Arrow batch scorer, beside the
    column-arithmetic score; the two agree."""
    frame = LE.training_frame(tx(s, d))
    sc = LE.scaled_features(frame)
    load = LE.fit_pca_loadings(sc, 4)
    scorer = MS.batch_scorer(MS.reconstruction_error_model(load), len(FE.TRANSACTION_FEATURES))
    x = [F.col(c) for c in FE.TRANSACTION_FEATURES]
    return sc.select("transaction_id", scorer(*x).alias("udf_score"), LE.reconstruction_error(load).alias("column_score"))


register("adhoc_sql")(adhoc_sql)
register("batch_counters")(batch_counters)
register("typology_alerts")(typology_alerts)
register("ego_edges")(
    lambda s, d: (lambda e: GR.ego_edges(e, GR.ego_subgraph(e, EGO_CENTER)).select("src", "dst", "weight"))(GR.graph_edges(tx(s, d)))
)
register("did_confidence")(lambda s, d: CA.did_effect(tx(s, d)).select("ate", "se", "ate_lower", "ate_upper"))
register("cost_comparison")(cost_comparison)
register("metrics_from_matrix")(metrics_from_matrix)
register("feature_pipeline")(
    lambda s, d: round_doubles(MS.build_transaction_pipeline().fit(tx(s, d)).transform(tx(s, d)))
)
register("saved_feature_pipeline")(
    lambda s, d: round_doubles(
        MS.saved_and_loaded(MS.build_transaction_pipeline().fit(tx(s, d)), IO.scratch(s, "pipeline")).transform(tx(s, d))
    )
)
register("udf_scores")(udf_scores)
register("shuffle_rows")(lambda s, d: SA.shuffle_rows(tx(s, d)).select("transaction_id", "amount_usd"))
register("did_bootstrap_poisson")(lambda s, d: CA.did_bootstrap(tx(s, d), replicates=500, method="poisson"))

from ledgerscope.sources import tables as TB  # noqa: E402

register("table_fingerprint")(lambda s, d: TB.table_fingerprint(tx(s, d)))
register("whatif_threshold_fallback")(
    lambda s, d: CA.whatif_threshold(CA.fallback_scores(tx(s, d), current=0.01), current=0.01, new=0.008)
)
