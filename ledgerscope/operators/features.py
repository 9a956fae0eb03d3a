"""Transaction and customer (node) features.

Per-sender statistics are computed with one grouped aggregate (partial
aggregation absorbs a hot sender) and joined back by key; AQE splits a skewed
sender partition on the join. A ``Window.partitionBy(sender)`` would instead
buffer the hot sender's rows in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions import scalar as S
from ledgerscope.functions.constants import NODE_FEATURES, TRANSACTION_FEATURES
from ledgerscope.session import cut_lineage


def sender_stats(txns: DataFrame) -> DataFrame:
    return txns.groupBy("sender_id").agg(
        F.count(F.lit(1)).alias("sender_n"),
        (F.avg("amount_cents") / F.lit(100.0)).alias("sender_mean"),
        F.stddev_samp("amount_usd").alias("sender_sd"),
    )


def with_sender_zscore(txns: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    st = (sender_stats(txns) if stats is None else stats).withColumnRenamed("sender_id", "_zs_sender")
    j = txns.join(st, txns.sender_id == st._zs_sender, "left")
    return j.withColumn(
        "amount_z_score_sender", S.zscore(F.col("amount_usd"), F.col("sender_mean"), F.col("sender_sd"))
    ).drop("_zs_sender")


#: Features that take few values: bits of a value's number, and the last number (value 1.0).
FEW = {"hour_of_day": (5, 23), "day_of_week": (3, 6), "is_cross_border": (1, 1), "round_amount": (1, 1), "rapid_movement": (1, 1), "structuring_flag": (1, 1)}


def transaction_features(txns: DataFrame, keep: list[str] | None = None, feature_cols: list[str] | None = None) -> DataFrame:
    """The nine model features, in fixed order, nulls -> 0; keyed by transaction_id. The join
    by sender moves the amount, from which three are made after it, and one number that
    holds the other six."""
    cols = feature_cols or TRANSACTION_FEATURES
    exprs = {
        "amount_usd": F.col("amount_usd"),
        "log_amount": S.log_amount(F.col("amount_usd")),
        "hour_of_day": S.hour_of_day(F.col("timestamp")),
        "day_of_week": S.day_of_week(F.col("timestamp")),
        "is_cross_border": S.is_cross_border(F.col("country_origin"), F.col("country_dest")),
        "round_amount": F.col("round_amount").cast("double"),
        "rapid_movement": F.col("rapid_movement").cast("double"),
        "structuring_flag": F.col("structuring_flag").cast("double"),
    }
    z = "amount_z_score_sender"
    filled = lambda x: F.coalesce(x.cast("double"), F.lit(0.0))
    keep = ["transaction_id"] + (keep or [])
    carried = dict.fromkeys([*keep, "sender_id", "amount_usd"])
    few, packed, at, value = [c for c in cols if c in FEW], F.lit(0).cast("long"), 0, {}
    for c in few:
        bits, last = FEW[c]
        packed = packed + F.shiftleft(F.rint(filled(exprs[c]) * last).cast("long"), at)
        value[c] = F.shiftright("_few", at).bitwiseAND((1 << bits) - 1) / F.lit(float(last))
        at += bits
    own = txns.select(*carried, *([packed.alias("_few")] if few else []))
    j = with_sender_zscore(own, sender_stats(txns))
    return j.select(*keep, *[value.get(c, filled(F.col(z) if c == z else exprs[c])).alias(c) for c in cols])


def sender_zscore(txns: DataFrame) -> DataFrame:
    z = with_sender_zscore(txns)
    return z.select(
        "transaction_id",
        "sender_id",
        F.round("sender_mean", 6).alias("sender_mean"),
        F.round(F.coalesce("sender_sd", F.lit(0.0)), 6).alias("sender_sd"),
        F.round("amount_z_score_sender", 6).alias("amount_z_score_sender"),
    )


def role_stats(txns: DataFrame) -> DataFrame:
    """Sent and received count / cents / distinct partners per account in two
    shuffles: transfers are reduced per (sender, receiver) -- which also spreads a
    hot account over its partners -- and each pair counts once for either role."""
    pairs = txns.groupBy("sender_id", "receiver_id").agg(F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("c"))
    sides = [F.struct(F.col(f"{x}_id").alias("id"), F.lit(x[0]).alias("role"), "n", "c") for x in ("sender", "receiver")]
    pairs = pairs.select(F.explode(F.array(*sides)).alias("e")).select("e.*")
    s_, r_ = F.col("role") == "s", F.col("role") == "r"
    return pairs.groupBy(F.col("id").alias("_nid")).agg(
        F.sum(F.when(s_, F.col("n"))).alias("sent_count"),
        F.sum(F.when(s_, F.col("c"))).alias("sent_cents"),
        F.count_if(s_).alias("sent_unique"),
        F.sum(F.when(r_, F.col("n"))).alias("recv_count"),
        F.sum(F.when(r_, F.col("c"))).alias("recv_cents"),
        F.count_if(r_).alias("recv_unique"),
    )


def node_features(txns: DataFrame, custs: DataFrame, feature_cols: list[str] | None = None) -> DataFrame:
    """Per-customer graph features: degree, log total, counterparties, risk,
    jurisdiction ordinal, mean amount, txn_count (customers with no transfers
    get zeros)."""
    st = role_stats(txns)
    c = custs.select("customer_id", "risk_score", "jurisdiction_risk")
    j = c.join(st, c.customer_id == st._nid, "left")
    sc = F.coalesce("sent_count", F.lit(0))
    rc = F.coalesce("recv_count", F.lit(0))
    total_cents = F.coalesce("sent_cents", F.lit(0)) + F.coalesce("recv_cents", F.lit(0))
    n = sc + rc
    exprs = {
        "degree": n.cast("double"),
        "total_amount": F.log1p(total_cents / F.lit(100.0)),
        "unique_counterparties": (F.coalesce("sent_unique", F.lit(0)) + F.coalesce("recv_unique", F.lit(0))).cast("double"),
        "risk_score": F.coalesce("risk_score", F.lit(0.0)),
        "jurisdiction_risk": S.jurisdiction_ordinal(F.col("jurisdiction_risk")),
        "avg_txn_amount": (total_cents / F.lit(100.0)) / F.greatest(n, F.lit(1)),
        "txn_count": n.cast("double"),
    }
    cols = feature_cols or NODE_FEATURES
    return j.select("customer_id", *[exprs[k].alias(k) for k in cols])


def fit_standardizer(df: DataFrame, cols: list[str], population: bool = True) -> DataFrame:
    """One-row frame of (mean, sd) per column; sd = 0 is replaced by 1."""
    sd = F.stddev_pop if population else F.stddev_samp
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), sd(c).alias(f"{c}__sd")]
    return df.agg(*aggs)


def apply_standardizer(df: DataFrame, model: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """Scale columns with a fitted one-row model, read as a scalar subquery
    (a single struct, merged into one job by the optimizer)."""
    s = model.select(F.struct(*model.columns).alias("m")).scalar()
    out = [F.col(k) for k in keep]
    for c in cols:
        mean, sd = s[f"{c}__mean"], s[f"{c}__sd"]
        sd = F.when((sd.isNull()) | (sd == 0), F.lit(1.0)).otherwise(sd)
        out.append(((F.col(c) - mean) / sd).alias(c))
    return df.select(*out)


def invert_standardizer(df: DataFrame, model: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    s = model.select(F.struct(*model.columns).alias("m")).scalar()
    out = [F.col(k) for k in keep]
    for c in cols:
        mean, sd = s[f"{c}__mean"], s[f"{c}__sd"]
        sd = F.when((sd.isNull()) | (sd == 0), F.lit(1.0)).otherwise(sd)
        out.append((F.col(c) * sd + mean).alias(c))
    return df.select(*out)


def node_features_scaled(txns: DataFrame, custs: DataFrame) -> DataFrame:
    nf = cut_lineage(node_features(txns, custs))  # the fit and the scaled rows read it
    model = fit_standardizer(nf, NODE_FEATURES, population=True)
    return apply_standardizer(nf, model, NODE_FEATURES, ["customer_id"])


def weighted_edges(txns: DataFrame) -> DataFrame:
    """One edge per transfer (multi-edges kept), weight log1p(amount)."""
    return txns.select(
        "transaction_id",
        F.col("sender_id").alias("src"),
        F.col("receiver_id").alias("dst"),
        F.log1p("amount_usd").alias("weight"),
    )
