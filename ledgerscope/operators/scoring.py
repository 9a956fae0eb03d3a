"""Transaction anomaly scores, thresholds and per-customer roll-ups.

Two kinds of scorer feed the same downstream operators:

* SQL-expressible stand-ins (the absolute per-sender z-score, and a customer
  graph-risk score from neighbours' risk) so the relational operators can be
  checked exactly;
* fitted detectors in ``ledgerscope.operators.learning`` (linear autoencoder
  reconstruction error, real-vs-permuted classifier).

Fitted quantities (a max, a p95 threshold) are one row, read back as scalar
subqueries. The exact threshold of the scores, rounded to a 1e-6 grid, is selected
by counts of bounded intervals (``functions.quantile``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions import scalar as S
from ledgerscope.functions.constants import ANOMALY_PERCENTILE, NORMALISE_EPS
from ledgerscope.functions.money import grid_avg, grid_mid
from ledgerscope.functions.quantile import grid_quantiles
from ledgerscope.operators.features import with_sender_zscore


def customer_risk_scores(txns: DataFrame, custs: DataFrame) -> DataFrame:
    """Graph-risk stand-in: mean of the customer's own risk and the mean risk of
    the senders of its incoming transfers (own risk when it has none)."""
    cr = custs.select(F.col("customer_id").alias("_sid"), F.col("risk_score").alias("_srisk"))
    inbound = (
        txns.select("sender_id", "receiver_id")
        .join(cr, F.col("sender_id") == F.col("_sid"), "inner")
        .groupBy(F.col("receiver_id").alias("_rid"))
        .agg(grid_avg(F.col("_srisk")).alias("_nbr"))
    )
    c = custs.select("customer_id", "risk_score", "is_suspicious")
    j = c.join(inbound, c.customer_id == inbound._rid, "left")
    return j.select(
        "customer_id",
        grid_mid(F.col("risk_score"), F.coalesce("_nbr", "risk_score")).alias("gnn_risk_score"),
        F.col("is_suspicious").cast("long").alias("is_suspicious_true"),
    )


#: What a list of scored transfers carries of each.
ROW_COLUMNS = ["transaction_id", "sender_id", "receiver_id", "amount_cents", "amount_usd", "is_suspicious"]


def raw_scores(txns: DataFrame, keep: list[str] | None = None, base: list[str] | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Stand-in raw score = |sender z-score| / 5 on a 1e-6 grid; the second
    detector's stand-in (``gan_score``) is another column of the same row. ``base`` names
    the columns carried along: all of them are shuffled by sender. ``stats`` are the
    senders' statistics where they are written already."""
    base, keep = base or ROW_COLUMNS, keep or []
    if "gan_score" in keep:  # before the join by sender: one number travels instead of its inputs
        txns = txns.withColumn("gan_score", secondary_score())
    return with_sender_zscore(txns, stats).select(
        *base,
        *[c for c in keep if c not in base],
        F.round(F.abs("amount_z_score_sender") / 5.0, 6).alias("vae_score"),
    )


def score_fit(scored: DataFrame) -> DataFrame:
    """What the finished scores need of all rows, one row: the maximum raw score, and the
    p95 of the normal rows' normalised scores (exact, selected by counts: no task holds a
    map of all scores)."""
    vmax = F.lit(scored.agg(F.max("vae_score")).first()[0]).cast("double")
    combined = F.round(S.normalise(F.col("vae_score"), vmax, NORMALISE_EPS), 6)
    at = grid_quantiles(scored.filter(~F.col("is_suspicious")), F.round(combined * 1_000_000), ANOMALY_PERCENTILE, 1_000_000).get(0)
    return scored.sparkSession.range(1).select(vmax.alias("vae_max"), F.round(F.lit(at).cast("double"), 9).alias("threshold"))


def finish_scores(scored: DataFrame, fit: DataFrame | None = None) -> DataFrame:
    """Normalise by the fitted max, threshold at the p95 of the normal rows,
    flag score >= threshold. Both are scalar subqueries over the one row of ``fit``, by
    default ``score_fit(scored)`` (write it first when it is expensive to recompute)."""
    fit = score_fit(scored) if fit is None else fit
    m = fit.select(F.struct("vae_max", "threshold").alias("m")).scalar()
    scored = scored.withColumn("combined_score", F.round(S.normalise(F.col("vae_score"), m["vae_max"], NORMALISE_EPS), 6))
    return scored.withColumn("threshold", m["threshold"]).withColumn("is_flagged", (F.col("combined_score") >= F.col("threshold")).cast("int"))


def anomaly_threshold(scores: DataFrame, score_col: str = "combined_score", q: float = ANOMALY_PERCENTILE) -> DataFrame:
    """Quantile of the normal rows' scores, which lie on a 1e-6 grid (exact, by selection)."""
    normal = scores.filter(~F.col("is_suspicious"))
    at = grid_quantiles(normal, F.round(F.col(score_col) * 1_000_000), q, 1_000_000).get(0)
    return normal.agg(F.count(F.lit(1)).alias("normal_rows")).select(F.round(F.lit(at).cast("double"), 9).alias("threshold"), "normal_rows")


def customer_alerts(scores: DataFrame) -> DataFrame:
    """Per-sender roll-up: mean raw score, mean fused score, max flag."""
    return scores.groupBy(F.col("sender_id").alias("customer_id")).agg(
        grid_avg(F.col("vae_score")).alias("vae_score"),
        grid_avg(F.col("combined_score")).alias("combined_score"),
        F.max("is_flagged").alias("is_flagged"),
    )


def flagged_transactions(scores: DataFrame) -> DataFrame:
    return scores.filter(F.col("is_flagged") == 1).select(
        "transaction_id", "sender_id", "receiver_id", "amount_usd", "combined_score", "threshold"
    )


def secondary_score() -> Column:
    """Stand-in for the second detector in [0, 1]: mean of the structuring and
    cross-border flags."""
    return (F.col("structuring_flag").cast("double") + S.is_cross_border(F.col("country_origin"), F.col("country_dest"))) / 2.0


def fused_scores(scores: DataFrame, secondary: str | None = "gan_score") -> DataFrame:
    """0.6 x normalised primary + 0.4 x secondary; primary alone without one.
    Both are columns of the same row, so no row can be lost; a row without a
    second score keeps its primary one."""
    alone = F.col("combined_score")
    both = alone if secondary is None else F.coalesce(F.round(S.fuse(alone, F.col(secondary)), 6), alone)
    return scores.select("transaction_id", "vae_score", both.alias("combined_score"))


def batch_scores(scores: DataFrame) -> DataFrame:
    """Per-transaction scoring report: score, threshold, flag and alert level."""
    return scores.select(
        "transaction_id",
        F.col("combined_score").alias("anomaly_score"),
        "threshold",
        (F.col("is_flagged") == 1).alias("is_flagged"),
        S.alert_level(F.col("combined_score"), F.col("threshold")).alias("alert_level"),
    )


def fitted_scale(scores: DataFrame) -> DataFrame:
    """What a scored ledger leaves for later batches, one row: maximum and threshold."""
    return scores.agg(F.max("vae_score").alias("vae_max"), F.max("threshold").alias("threshold"))


def score_batch(records: DataFrame, fitted: DataFrame) -> DataFrame:
    """Score a batch of valid records against a ``fitted_scale``: z-scores are those of
    the batch's own senders, maximum and threshold the fitted ones. An empty batch
    gives no row."""
    txns = records.withColumns({"amount_cents": F.round(F.col("amount_usd") * 100).cast("long"), "is_suspicious": F.lit(False)})
    s = fitted.select(F.struct("vae_max", "threshold").alias("m")).scalar()
    scored = raw_scores(txns).withColumn("combined_score", F.round(S.normalise(F.col("vae_score"), s["vae_max"], NORMALISE_EPS), 6))
    return scored.withColumn("threshold", s["threshold"]).withColumn("is_flagged", (F.col("combined_score") >= F.col("threshold")).cast("int"))
