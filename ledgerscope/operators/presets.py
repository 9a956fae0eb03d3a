"""Preset surveillance queries over the ledger (KPIs, top-N, trends, rules).

All of them are single-pass aggregates: map-side partial aggregation, one
shuffle on the group key, then a ``TakeOrderedAndProject`` for the top-N ones.
Every limited output carries tie keys so the N rows are well defined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions.constants import SAR_THRESHOLD_USD, STRUCTURING_MIN_COUNT, VELOCITY_MIN_COUNT
from ledgerscope.functions.money import avg_usd, pct_4dp, sum_usd
from ledgerscope.functions.scalar import trunc_hour_ntz, week_start_date
from ledgerscope.sources.ledger import quarter_text

def _susp():
    return F.col("is_suspicious").cast("long")


def transaction_summary(txns: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return txns.agg(
        n.alias("total_transactions"),
        F.sum(_susp()).alias("suspicious_count"),
        pct_4dp(F.sum(_susp()), n).alias("suspicious_pct"),
        sum_usd(F.col("amount_cents")).alias("total_volume_usd"),
        avg_usd(F.col("amount_cents")).alias("avg_amount_usd"),
        F.min("timestamp").alias("earliest_txn"),
        F.max("timestamp").alias("latest_txn"),
    )


def top_suspicious_customers(txns: DataFrame, n: int = 20) -> DataFrame:
    return (
        txns.filter(F.col("is_suspicious"))
        .groupBy(F.col("sender_id").alias("customer_id"))
        .agg(
            F.count(F.lit(1)).alias("suspicious_txn_count"),
            sum_usd(F.col("amount_cents")).alias("total_suspicious_usd"),
            avg_usd(F.col("amount_cents")).alias("avg_amount_usd"),
            F.countDistinct("receiver_id").alias("unique_counterparties"),
        )
        .orderBy(F.desc("suspicious_txn_count"), F.asc("customer_id"))
        .limit(n)
    )


def daily_alert_trend(txns: DataFrame, days: int = 90, as_of=None) -> DataFrame:
    """Daily totals in a trailing window ending at ``as_of`` (a date or
    timestamp literal); by default the last day present in the data, as a
    scalar subquery (no join). A ledger partitioned by ``txn_quarter`` is read
    from the cutoff's quarter on, and its last day looked up in its last quarter."""
    quarterly = "txn_quarter" in txns.columns
    if as_of is None:
        latest = txns.filter(F.col("txn_quarter") == txns.select(F.max("txn_quarter")).scalar()) if quarterly else txns
        as_of_col = latest.select(F.to_date(F.max("timestamp"))).scalar()
    else:
        as_of_col = F.to_date(F.lit(as_of))
    cutoff = F.date_sub(as_of_col, days).cast("timestamp_ntz")
    if quarterly:
        txns = txns.filter(F.col("txn_quarter") >= quarter_text(cutoff))
    return (
        txns.filter(F.col("timestamp") >= cutoff)
        .groupBy(F.to_date("timestamp").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("total_txns"),
            F.sum(_susp()).alias("suspicious"),
            sum_usd(F.when(F.col("is_suspicious"), F.col("amount_cents")).otherwise(F.lit(0))).alias("flagged_usd"),
        )
        .orderBy("date")
    )


def typology_breakdown(txns: DataFrame) -> DataFrame:
    return (
        txns.filter(F.col("is_suspicious"))
        .groupBy(F.col("label").alias("typology"))
        .agg(
            F.count(F.lit(1)).alias("count"),
            sum_usd(F.col("amount_cents")).alias("total_usd"),
            avg_usd(F.col("amount_cents")).alias("avg_usd"),
        )
        .orderBy(F.desc("count"), "typology")
    )


def cross_border_corridors(txns: DataFrame, n: int = 30) -> DataFrame:
    return (
        txns.filter(F.col("is_suspicious") & (F.col("country_origin") != F.col("country_dest")))
        .groupBy("country_origin", "country_dest")
        .agg(F.count(F.lit(1)).alias("count"), sum_usd(F.col("amount_cents")).alias("total_usd"))
        .orderBy(F.desc("count"), "country_origin", "country_dest")
        .limit(n)
    )


def structuring_alerts(
    txns: DataFrame, threshold_usd: float = SAR_THRESHOLD_USD, min_count: int = STRUCTURING_MIN_COUNT, n: int = 100
) -> DataFrame:
    threshold_cents = int(round(threshold_usd * 100))
    return (
        txns.filter((F.col("amount_cents") < threshold_cents) & F.col("structuring_flag"))
        .groupBy("sender_id", F.to_date("timestamp").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            sum_usd(F.col("amount_cents")).alias("total_daily_usd"),
            (F.max("amount_cents") / F.lit(100.0)).alias("max_single_txn"),
        )
        .filter(F.col("txn_count") >= min_count)
        .orderBy(F.desc("txn_count"), "sender_id", "date")
        .limit(n)
    )


def hourly_velocity(txns: DataFrame, min_count: int = VELOCITY_MIN_COUNT, n: int = 100) -> DataFrame:
    return (
        txns.groupBy("sender_id", trunc_hour_ntz(F.col("timestamp")).alias("hour_bucket"))
        .agg(F.count(F.lit(1)).alias("txn_per_hour"), sum_usd(F.col("amount_cents")).alias("hourly_usd"))
        .filter(F.col("txn_per_hour") >= min_count)
        .orderBy(F.desc("txn_per_hour"), "sender_id", "hour_bucket")
        .limit(n)
    )


def high_risk_network(txns: DataFrame, risk: DataFrame, min_risk: float = 0.5, n: int = 50) -> DataFrame:
    """Senders whose graph risk exceeds ``min_risk``. The reference's LEFT JOIN
    plus a filter on the right side is an inner join (Catalyst rewrites it)."""
    r = risk.select(F.col("customer_id").alias("_rid"), "gnn_risk_score").filter(F.col("gnn_risk_score") > min_risk)
    return (
        txns.join(r, txns.sender_id == r._rid, "inner")
        .groupBy(F.col("sender_id").alias("customer_id"))
        .agg(
            F.round(F.avg("gnn_risk_score"), 4).alias("gnn_risk_score"),
            F.count("transaction_id").alias("txn_count"),
            sum_usd(F.col("amount_cents")).alias("total_usd"),
            F.sum(_susp()).alias("suspicious_count"),
        )
        .orderBy(F.desc("gnn_risk_score"), "customer_id")
        .limit(n)
    )


def anomaly_flagged_customers(alerts: DataFrame, n: int = 100) -> DataFrame:
    return (
        alerts.filter(F.col("is_flagged") == 1)
        .groupBy("customer_id")
        .agg(
            F.round(F.avg("vae_score"), 6).alias("avg_vae_score"),
            F.round(F.avg("combined_score"), 6).alias("avg_combined_score"),
            F.max(F.col("is_flagged").cast("long")).alias("is_flagged"),
        )
        .orderBy(F.desc("avg_combined_score"), "customer_id")
        .limit(n)
    )


def weekly_alert_timeline(txns: DataFrame) -> DataFrame:
    """Weekly totals labelled by the week's Sunday (weeks run Monday-Sunday);
    weeks without rows appear with zeros via a calendar spine. The spine is
    one row per week of the covered range, so its size is bounded by the
    calendar, not by the data."""
    wk = txns.select(week_start_date(F.col("timestamp")).alias("week_start"), "is_suspicious")
    counts = wk.groupBy("week_start").agg(
        F.count(F.lit(1)).alias("total"), F.sum(F.col("is_suspicious").cast("long")).alias("suspicious")
    )
    spine = counts.agg(F.min("week_start").alias("lo"), F.max("week_start").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 7 DAYS"))).alias("week_start")
    )
    return spine.join(counts, "week_start", "left").select(
        F.date_add("week_start", 6).alias("week"),
        F.coalesce("total", F.lit(0)).cast("long").alias("total"),
        F.coalesce("suspicious", F.lit(0)).cast("long").alias("suspicious"),
    )


def label_counts(txns: DataFrame, column: str = "label") -> DataFrame:
    return txns.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def class_distribution(txns: DataFrame) -> DataFrame:
    counts = txns.groupBy("is_suspicious").agg(F.count(F.lit(1)).alias("count"))
    total = txns.select(F.count(F.lit(1))).scalar()
    return counts.select("is_suspicious", "count", F.round(F.col("count") / total, 6).alias("share"))


def hour_class_crosstab(txns: DataFrame) -> DataFrame:
    """Hour of day x class counts, each class column normalised to sum 1.
    24 x 2 cells: the normalising window runs over 24 rows."""
    from pyspark.sql import Window

    ct = (
        txns.groupBy(F.hour("timestamp").alias("hour"))
        .pivot("is_suspicious", [False, True])
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )
    w = Window.partitionBy()
    return ct.select(
        "hour",
        F.round(F.col("false") / F.sum("false").over(w), 6).alias("normal_share"),
        F.round(F.col("true") / F.sum("true").over(w), 6).alias("suspicious_share"),
    )


def suspicion_by_jurisdiction(txns: DataFrame, custs: DataFrame) -> DataFrame:
    c = custs.select(F.col("customer_id").alias("_cid"), "jurisdiction_risk")
    return (
        txns.join(c, txns.sender_id == c._cid, "left")
        .filter(F.col("jurisdiction_risk").isNotNull())
        .groupBy("jurisdiction_risk")
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            F.round(F.avg(F.col("is_suspicious").cast("double")), 6).alias("suspicion_rate"),
        )
        .orderBy(F.desc("suspicion_rate"))
    )
