"""Suspicious Activity Report assembly: suspect ranking, nested SAR rows,
flat summary, narratives, filters and KPIs -- all column expressions, no
driver loop over suspects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions import constants as K
from ledgerscope.functions import scalar as S
from ledgerscope.functions.money import fmt_fixed, ratio_dp, sum_usd
from ledgerscope.operators.profiles import sender_activity_profile


def top_suspects(custs: DataFrame, risk: DataFrame, alerts: DataFrame, n: int = K.SAR_TOP_N) -> DataFrame:
    """customers + graph risk (default: own risk score) + anomaly score
    (default 0); composite = 0.5 risk + 0.5 graph risk; top ``n``."""
    r = risk.select(F.col("customer_id").alias("_rid"), F.col("gnn_risk_score").alias("_g"))
    a = alerts.select(F.col("customer_id").alias("_aid"), F.col("vae_score").alias("_v"))
    j = custs.join(r, custs.customer_id == r._rid, "left").join(a, custs.customer_id == a._aid, "left")
    g = F.coalesce("_g", "risk_score")
    return (
        j.select(
            *[c for c in custs.columns],
            g.alias("gnn_risk_score"),
            F.coalesce("_v", F.lit(0.0)).alias("vae_score"),
            (F.lit(0.5) * F.col("risk_score") + F.lit(0.5) * g).alias("combined_score"),
        )
        .orderBy(F.desc("combined_score"), "customer_id")
        .limit(n)
    )


def _typology_array(col):
    return F.when(F.col(col) == "", F.array().cast("array<string>")).otherwise(F.split(F.col(col), ", "))


def long_narrative(cid, txn_count, total_usd, types_text, vae, gnn):
    types = F.when(types_text == "", F.lit(K.LONG_NARRATIVE_NO_TYPES)).otherwise(types_text)
    return F.format_string(
        K.LONG_NARRATIVE_TEMPLATE,
        cid,
        txn_count,
        F.format_number(total_usd, 2),
        types,
        fmt_fixed(vae, 4),
        fmt_fixed(gnn, 4),
        F.concat(F.lit("Typologies: "), types_text),
    )


def short_narrative(cid, account_type, country, date_range, txn_count, total_usd, types_text, structuring, cross_border, vae, gnn, risk):
    types = F.when(types_text == "", F.lit(K.SHORT_NARRATIVE_NO_TYPES)).otherwise(types_text)
    return F.concat(
        F.lit("The filer reports suspicious activity by customer "), cid,
        F.lit(" ("), account_type, F.lit(", "), country, F.lit("). "),
        F.lit("During "), date_range, F.lit(", the subject executed "), txn_count.cast("string"),
        F.lit(" transactions totalling USD "), F.format_number(total_usd, 2), F.lit(". "),
        F.lit("Detected typologies: "), types, F.lit(". "),
        F.when(structuring, F.lit(K.SHORT_NARRATIVE_STRUCTURING)).otherwise(F.lit("")),
        F.when(cross_border, F.lit(K.SHORT_NARRATIVE_CROSS_BORDER)).otherwise(F.lit("")),
        F.lit("AI anomaly score: "), fmt_fixed(vae, 4), F.lit(" (VAE), "),
        F.lit("Graph risk score: "), fmt_fixed(gnn, 4), F.lit(" (GNN), "),
        F.lit("Customer risk rating: "), fmt_fixed(risk, 4), F.lit(". "),
        F.lit("Filing made under 31 U.S.C. § 5318(g)."),
    )


def sar_base(txns: DataFrame, suspects: DataFrame, generated_at=None) -> DataFrame:
    """One flat row per suspect with the activity profile joined (profile
    computed only for the suspects: a semi join to the bounded top-N first).
    ``generated_at`` defaults to the last transfer time in the ledger."""
    prof = sender_activity_profile(txns, suspects.select("customer_id"))
    j = suspects.join(prof, "customer_id", "left")
    gen = (
        F.lit(generated_at).cast("timestamp_ntz")
        if generated_at is not None
        else txns.select(F.max("timestamp")).scalar()
    )
    ts_text = F.concat(F.date_format(gen, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return j.select(
        S.deterministic_id("SAR-", F.col("customer_id"), F.date_format(gen, "yyyy-MM-dd"), width=16).alias("sar_id"),
        ts_text.alias("generated_at"),
        F.date_format(gen, "yyyy-MM-dd").alias("report_date"),
        S.sar_priority(F.col("combined_score")).alias("priority"),
        F.lit(K.NARRATIVE_ENGINE).alias("llm_used"),
        F.lit(K.SAR_STATUS).alias("status"),
        "customer_id", "name", "country", "jurisdiction_risk", "account_type", "annual_income_usd", "pep",
        "risk_score", "gnn_risk_score", "vae_score", "combined_score",
        F.coalesce("typologies", F.lit("")).alias("typologies"),
        F.coalesce("total_amount", F.lit(0.0)).alias("total_flagged_amount_usd"),
        F.coalesce("txn_count", F.lit(0)).alias("flagged_transaction_count"),
        S.date_text(F.col("min_date")).alias("date_range_start"),
        S.date_text(F.col("max_date")).alias("date_range_end"),
        F.coalesce("structuring", F.lit(False)).alias("structuring_detected"),
        F.coalesce("cross_border", F.lit(False)).alias("cross_border"),
        F.coalesce("cross_border_count", F.lit(0)).alias("cross_border_count"),
        F.coalesce("flagged_amount_usd", F.lit(0.0)).alias("flagged_amount_usd"),
    ).withColumn(
        "narrative",
        long_narrative(
            F.col("customer_id"), F.col("flagged_transaction_count"), F.col("total_flagged_amount_usd"),
            F.col("typologies"), F.col("vae_score"), F.col("gnn_risk_score"),
        ),
    )


def sar_reports(base: DataFrame) -> DataFrame:
    """Nested SAR rows: filer, suspect and activity structs."""
    return base.select(
        "sar_id", "generated_at", "priority", "llm_used", "status",
        F.struct(
            F.lit(K.FILER_INSTITUTION_NAME).alias("institution_name"),
            F.lit(K.FILER_EIN).alias("ein"),
            F.lit(K.FILER_CONTACT).alias("contact"),
            F.col("report_date").alias("report_date"),
            F.lit(K.FILER_FILING_TYPE).alias("filing_type"),
        ).alias("filer"),
        F.struct(
            "customer_id", F.col("name").alias("customer_name"), "country", "jurisdiction_risk", "account_type",
            "annual_income_usd", "pep", "risk_score", "gnn_risk_score", "vae_score",
        ).alias("suspect"),
        F.struct(
            _typology_array("typologies").alias("typologies_detected"),
            "total_flagged_amount_usd",
            F.col("flagged_transaction_count").alias("flagged_transaction_count"),
            "date_range_start", "date_range_end", "structuring_detected", "cross_border",
            F.col("narrative").alias("activity_description"),
        ).alias("activity"),
    )


def sar_summary(base: DataFrame) -> DataFrame:
    return base.select(
        "sar_id", "customer_id", "priority", "llm_used", "total_flagged_amount_usd",
        F.col("flagged_transaction_count").alias("flagged_txn_count"),
        "gnn_risk_score", "vae_score", "typologies", "status", "generated_at",
    )


def sar_narratives(base: DataFrame) -> DataFrame:
    return base.select("sar_id", "customer_id", "llm_used", S.truncate_text(F.col("narrative"), 500).alias("narrative"))


def sar_narratives_short(base: DataFrame) -> DataFrame:
    rng = F.concat(F.col("date_range_start"), F.lit(" to "), F.col("date_range_end"))
    return base.select(
        "sar_id",
        short_narrative(
            F.col("customer_id"), F.col("account_type"), F.col("country"), rng, F.col("flagged_transaction_count"),
            F.col("total_flagged_amount_usd"), F.col("typologies"), F.col("structuring_detected"), F.col("cross_border"),
            F.col("vae_score"), F.col("gnn_risk_score"), F.col("risk_score"),
        ).alias("narrative"),
    )


def sar_filtered(summary: DataFrame, priorities=("CRITICAL", "HIGH")) -> DataFrame:
    return summary.filter(F.col("priority").isin(*priorities))


def sar_lookup(reports: DataFrame, sar_id: str | None = None) -> DataFrame:
    """One SAR by id (default: the first by priority rank then id) with its
    selector label line."""
    rank = F.when(F.col("priority") == "CRITICAL", 0).when(F.col("priority") == "HIGH", 1).otherwise(2)
    r = reports.filter(F.col("sar_id") == sar_id) if sar_id else reports.orderBy(rank, "sar_id").limit(1)
    return r.select(
        "sar_id", "priority", F.col("suspect.customer_id").alias("customer_id"),
        F.format_string("[%-8s] %s  —  %s", F.col("priority"), F.col("sar_id"), F.col("suspect.customer_id")).alias("label"),
        F.col("activity.total_flagged_amount_usd").alias("total_flagged_amount_usd"),
    )


def sar_kpis(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("total_sars"),
        F.count_if(F.col("priority") == "CRITICAL").alias("critical"),
        F.count_if(F.col("priority") == "HIGH").alias("high"),
        F.mode("llm_used", deterministic=True).alias("llm_engine"),
    )


def engine_usage(summary: DataFrame) -> DataFrame:
    return summary.groupBy(F.col("llm_used").alias("engine")).agg(F.count(F.lit(1)).alias("reports"))


def command_center_kpis(txns: DataFrame, summary: DataFrame) -> DataFrame:
    sars = summary.select(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col("priority") == "CRITICAL").alias("c")).alias("s")
    ).scalar()
    n = F.count(F.lit(1))
    susp = F.count_if("is_suspicious")
    return txns.agg(
        n.alias("total_transactions"),
        susp.alias("alerts_triggered"),
        ratio_dp(susp * 100, n, 2).alias("flag_rate_pct"),
        sum_usd(F.col("amount_cents")).alias("total_volume_usd"),
        sum_usd(F.when(F.col("is_suspicious"), F.col("amount_cents")).otherwise(F.lit(0))).alias("flagged_volume_usd"),
    ).select("*", sars["n"].alias("total_sars"), sars["c"].alias("critical_sars"))
