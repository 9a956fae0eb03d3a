"""Customer and sender profiles, alert views and batch assessment summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions import scalar as S
from ledgerscope.functions.constants import (
    GRAPH_RISK_CLUSTER_MIN,
    HIGH_RISK_MIN,
    JURISDICTION_COUNTRIES,
    NORMAL_LABEL,
)
from ledgerscope.functions.money import grid_avg, idiv, sum_usd
from ledgerscope.functions.quantile import grid_quantiles


def jurisdiction_lookup(spark, custs: DataFrame | None = None) -> DataFrame:
    """Country -> jurisdiction risk. The fixed code table, extended with the
    (country, level) pairs the customer table carries. Its size is bounded by
    the number of countries, so it is broadcast."""
    rows = [(c, lvl) for lvl, cs in JURISDICTION_COUNTRIES.items() for c in cs]
    fixed = spark.createDataFrame(rows, "country string, jurisdiction_risk string")
    if custs is None:
        return fixed
    derived = custs.select("country", "jurisdiction_risk").where(F.col("country").isNotNull()).distinct()
    return fixed.unionByName(derived).groupBy("country").agg(F.min("jurisdiction_risk").alias("jurisdiction_risk"))


def country_jurisdiction(txns: DataFrame, lookup: DataFrame) -> DataFrame:
    lk = F.broadcast(lookup.select(F.col("country").alias("_c"), F.col("jurisdiction_risk").alias("_j")))
    j = txns.join(lk, txns.country_dest == lk._c, "left")
    return j.groupBy("country_dest", F.coalesce("_j", F.lit("medium")).alias("jurisdiction_risk")).agg(
        F.count(F.lit(1)).alias("txn_count")
    )


def recent_alerts(txns: DataFrame, n: int = 15) -> DataFrame:
    return (
        txns.filter(F.col("is_suspicious"))
        .orderBy(F.desc("amount_cents"), "transaction_id")
        .limit(n)
        .select(
            "transaction_id",
            "timestamp",
            "sender_id",
            "receiver_id",
            "amount_usd",
            S.money_text(F.col("amount_usd")).alias("amount_text"),
            "label",
        )
    )


def alerts_page(scores: DataFrame, page: int = 2, page_size: int = 50, min_score: float = 0.3) -> DataFrame:
    """Page ``page`` (1-based) of alerts with score >= min_score, highest first,
    plus the total count as a scalar subquery (no global window)."""
    f = scores.filter(F.col("combined_score") >= min_score)
    total = f.select(F.count(F.lit(1))).scalar()
    return (
        f.orderBy(F.desc("combined_score"), "transaction_id")
        .offset((page - 1) * page_size)
        .limit(page_size)
        .select("transaction_id", "sender_id", "amount_usd", "combined_score", total.alias("total"))
    )


def alerts_after(scores: DataFrame, after_score: float | None, after_id: str | None, page_size: int = 50,
                 min_score: float = 0.3) -> DataFrame:
    """Keyset page for deep pagination: the next ``page_size`` alerts after the
    last (score, id) seen -- a filter plus a top-k, no offset scan."""
    f = scores.filter(F.col("combined_score") >= min_score)
    if after_score is not None:
        f = f.filter(
            (F.col("combined_score") < after_score)
            | ((F.col("combined_score") == after_score) & (F.col("transaction_id") > after_id))
        )
    return f.orderBy(F.desc("combined_score"), "transaction_id").limit(page_size).select(
        "transaction_id", "sender_id", "amount_usd", "combined_score"
    )


def sender_truth(txns: DataFrame) -> DataFrame:
    return txns.groupBy(F.col("sender_id").alias("_tid")).agg(F.bool_or("is_suspicious").alias("_truth"))


def alerts_with_truth(alerts: DataFrame, txns: DataFrame) -> DataFrame:
    t = sender_truth(txns)
    j = alerts.join(t, alerts.customer_id == t._tid, "left")
    return j.select(
        "customer_id", "combined_score", "is_flagged", F.coalesce("_truth", F.lit(False)).alias("is_suspicious_true")
    )


def fallback_alert_scores(txns: DataFrame) -> DataFrame:
    """Mean suspicious amount / 1e5 per sender, on a 1e-6 grid (exact)."""
    g = txns.filter(F.col("is_suspicious")).groupBy(F.col("sender_id").alias("customer_id"))
    s, n = F.sum("amount_cents"), F.count(F.lit(1))
    return g.agg((idiv(s * 2 + n * 10, n * 20) / F.lit(1e6)).alias("vae_score"))


def sender_activity_profile(txns: DataFrame, senders: DataFrame | None = None) -> DataFrame:
    """Per-sender SAR profile. ``cross_border`` keeps the reference's proxy
    (any suspicious transfer); ``cross_border_count`` and ``flagged_amount_usd``
    are the true measures."""
    t = txns
    if senders is not None:
        t = t.join(senders.select(F.col("customer_id").alias("sender_id")), "sender_id", "left_semi")
    return t.groupBy(F.col("sender_id").alias("customer_id")).agg(
        sum_usd(F.col("amount_cents")).alias("total_amount"),
        F.count(F.lit(1)).alias("txn_count"),
        F.min("timestamp").alias("min_date"),
        F.max("timestamp").alias("max_date"),
        F.bool_or("structuring_flag").alias("structuring"),
        F.bool_or("is_suspicious").alias("cross_border"),
        F.array_join(
            F.sort_array(F.collect_set(F.when(F.col("label") != NORMAL_LABEL, F.col("label")))), ", "
        ).alias("typologies"),
        F.count_if(F.coalesce(F.col("country_origin") != F.col("country_dest"), F.lit(True))).alias("cross_border_count"),
        sum_usd(F.when(F.col("is_suspicious"), F.col("amount_cents")).otherwise(F.lit(0))).alias("flagged_amount_usd"),
    )


def score_histogram(scores: DataFrame, bins: int = 60, col: str = "combined_score") -> DataFrame:
    """Equal-width histogram over the data range by class; the last bin is
    closed on the right. The range is a scalar subquery."""
    rng = scores.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("r")).scalar()
    lo, hi = rng["lo"], rng["hi"]
    w = (hi - lo) / F.lit(float(bins))
    b = F.least(F.floor((F.col(col) - lo) / w), F.lit(bins - 1)).cast("int")
    return (
        scores.select(F.col("is_suspicious"), F.when(w > 0, b).otherwise(F.lit(0)).alias("bin"))
        .groupBy("is_suspicious", "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def winsorized_amounts(txns: DataFrame, q: float = 0.99) -> DataFrame:
    """Clip amounts at the per-class p99 (exact, by selection on the cents)."""
    p99 = grid_quantiles(txns, F.col("amount_cents"), q, 100, F.col("is_suspicious"))
    limit = F.lit(None).cast("double")
    for cls, x in p99.items():  # classes of a boolean
        limit = F.when(F.col("is_suspicious").eqNullSafe(F.lit(cls)), F.round(F.lit(float(x)), 6)).otherwise(limit)
    j = txns.select("transaction_id", "is_suspicious", limit.alias("p99_amount"), "amount_usd")
    return j.select("transaction_id", "is_suspicious", "p99_amount", F.least("amount_usd", "p99_amount").alias("amount_clipped"))


def score_summary(scores: DataFrame, col: str = "combined_score") -> DataFrame:
    return scores.agg(
        F.count(F.lit(1)).alias("n"),
        grid_avg(F.col(col)).alias("mean_score"),
        F.max(col).alias("max_score"),
        F.round(F.percentile(col, 0.95), 9).alias("p95_score"),
    )


def top_risk_customers(risk: DataFrame, custs: DataFrame, n: int = 20) -> DataFrame:
    c = custs.select("customer_id", "name", "country", "risk_score")
    return (
        risk.join(c, "customer_id", "left")
        .orderBy(F.desc("gnn_risk_score"), "customer_id")
        .limit(n)
        .select("customer_id", "name", "country", "gnn_risk_score", "risk_score", "is_suspicious_true")
    )


def rule_vs_graph(risk: DataFrame, custs: DataFrame) -> DataFrame:
    j = risk.join(custs.select("customer_id", "risk_score"), "customer_id")
    return j.agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.corr("risk_score", "gnn_risk_score"), 6).alias("correlation"),
        grid_avg(F.col("risk_score")).alias("mean_rule_score"),
        grid_avg(F.col("gnn_risk_score")).alias("mean_graph_score"),
    )


def high_risk_by_jurisdiction(risk: DataFrame, custs: DataFrame, min_score: float = HIGH_RISK_MIN) -> DataFrame:
    j = risk.filter(F.col("gnn_risk_score") >= min_score).join(custs.select("customer_id", "jurisdiction_risk"), "customer_id")
    return j.groupBy("jurisdiction_risk").agg(F.count(F.lit(1)).alias("count"))


def customer_risk_labels(risk: DataFrame, custs: DataFrame) -> DataFrame:
    r = risk.select(F.col("customer_id").alias("_rid"), "gnn_risk_score")
    j = custs.select("customer_id").join(r, F.col("customer_id") == F.col("_rid"), "left")
    return j.select("customer_id", "gnn_risk_score", S.customer_risk_label(F.col("gnn_risk_score")).alias("risk_level"))


def involved_customers(flagged: DataFrame) -> DataFrame:
    return (
        flagged.select(F.col("sender_id").alias("customer_id"))
        .union(flagged.select(F.col("receiver_id").alias("customer_id")))
        .distinct()
    )


def flagged_sender_context(flagged: DataFrame, limit: int | None = None) -> DataFrame:
    out = flagged.groupBy("sender_id").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        sum_usd(F.col("amount_cents")).alias("total_amount_usd"),
        grid_avg(F.col("combined_score")).alias("vae_score"),
        F.array_join(F.sort_array(F.collect_set("transaction_type")), ", ").alias("transaction_types"),
    )
    if limit:
        out = out.orderBy("sender_id").limit(limit)
    return out


def investigation_summary(flagged: DataFrame, risk: DataFrame) -> DataFrame:
    inv = involved_customers(flagged)
    r = risk.select(F.col("customer_id").alias("_rid"), "gnn_risk_score")
    j = inv.join(r, inv.customer_id == r._rid, "left").select(
        "customer_id", F.coalesce("gnn_risk_score", F.lit(0.0)).alias("g")
    )
    amt = flagged.select(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("amount_cents"), F.lit(0)).alias("c")
    ).select(F.struct("n", "c").alias("s")).scalar()
    return j.agg(
        F.count(F.lit(1)).alias("customers_involved"),
        F.count_if(F.col("g") > GRAPH_RISK_CLUSTER_MIN).alias("high_risk_count"),
        F.coalesce(grid_avg(F.col("g")), F.lit(0.0)).alias("avg_gnn_risk"),
    ).select(
        "customers_involved",
        "high_risk_count",
        "avg_gnn_risk",
        amt["n"].alias("flagged_txn_count"),
        (amt["c"] / F.lit(100.0)).alias("total_flagged_usd"),
    )


def batch_risk_summary(scores: DataFrame, risk: DataFrame) -> DataFrame:
    """0.5 x min(10 x flag rate, 1) + 0.3 x mean fused score + 0.2 x mean graph
    risk of the involved customers, on 4 places, with level and action. An
    empty batch flows through as zeros (LOW)."""
    flagged = scores.filter(F.col("is_flagged") == 1)
    inv = involved_customers(flagged)
    r = risk.select(F.col("customer_id").alias("_rid"), "gnn_risk_score")
    g = (
        inv.join(r, inv.customer_id == r._rid, "left")
        .select(F.coalesce("gnn_risk_score", F.lit(0.0)).alias("g"))
        .select(F.coalesce(grid_avg(F.col("g")), F.lit(0.0)))
        .scalar()
    )
    base = scores.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("is_flagged") == 1).alias("n_flagged"),
        F.coalesce(grid_avg(F.col("combined_score")), F.lit(0.0)).alias("avg_combined_score"),
    ).withColumn("avg_gnn_risk", g)
    rate = F.col("n_flagged") / F.greatest(F.col("n_total"), F.lit(1))
    score = F.round(
        F.lit(0.5) * F.least(rate * 10, F.lit(1.0)) + F.lit(0.3) * F.col("avg_combined_score") + F.lit(0.2) * F.col("avg_gnn_risk"),
        4,
    )
    return base.select(
        "n_total",
        "n_flagged",
        F.round(rate, 6).alias("flag_rate"),
        "avg_combined_score",
        "avg_gnn_risk",
        score.alias("final_risk_score"),
    ).select("*", S.batch_risk_level(F.col("final_risk_score")).alias("final_risk_level"),
             S.batch_risk_action(F.col("final_risk_score")).alias("action_recommendation"))
