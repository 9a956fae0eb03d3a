"""DuckDB SQL oracle per registry key (run over the raw parquet views).

Money is summed in integer cents and averages are rounded half-up in integers,
exactly as the Spark side does, so both engines produce identical doubles.
"""

from __future__ import annotations

from ledgerscope.plans.oracle_base import PLANTED_CTES
from ledgerscope.plans.oracle_base import with_ledger as W

# Shared SQL fragments.
SUM_USD = "SUM(amount_cents) / 100.0::DOUBLE"
def GRID_AVG(x: str) -> str:
    return f"CAST((2 * SUM(CAST(round({x} * 1000000) AS BIGINT)) + COUNT({x})) // (2 * COUNT({x})) AS BIGINT) / 1000000.0::DOUBLE"


def GRID_MID(a: str, b: str) -> str:
    return f"CAST((CAST(round({a} * 1000000) AS BIGINT) + CAST(round({b} * 1000000) AS BIGINT) + 1) // 2 AS BIGINT) / 1000000.0::DOUBLE"


AVG_USD = "CAST((2 * SUM(amount_cents) + COUNT(amount_cents)) // (2 * COUNT(amount_cents)) AS BIGINT) / 100.0::DOUBLE"

ORACLE: dict[str, str] = {}

ORACLE["scan_transactions"] = W("SELECT * FROM transactions")
ORACLE["scan_customers"] = W("SELECT * FROM customers")
ORACLE["transaction_edges"] = W(
    "SELECT sender_id AS source_id, receiver_id AS dest_id, amount_usd, is_suspicious FROM transactions"
)

ORACLE["transaction_summary"] = W(f"""
SELECT COUNT(*) AS total_transactions,
       CAST(SUM(is_suspicious::BIGINT) AS BIGINT) AS suspicious_count,
       CAST((2000000 * SUM(is_suspicious::BIGINT) + COUNT(*)) // (2 * COUNT(*)) AS BIGINT) / 10000.0::DOUBLE AS suspicious_pct,
       {SUM_USD} AS total_volume_usd,
       {AVG_USD} AS avg_amount_usd,
       MIN("timestamp") AS earliest_txn,
       MAX("timestamp") AS latest_txn
FROM transactions""")

ORACLE["top_suspicious_customers"] = W(f"""
SELECT sender_id AS customer_id, COUNT(*) AS suspicious_txn_count,
       {SUM_USD} AS total_suspicious_usd, {AVG_USD} AS avg_amount_usd,
       COUNT(DISTINCT receiver_id) AS unique_counterparties
FROM transactions WHERE is_suspicious
GROUP BY sender_id ORDER BY suspicious_txn_count DESC, customer_id LIMIT 20""")

ORACLE["daily_alert_trend"] = W("""
SELECT CAST("timestamp" AS DATE) AS date, COUNT(*) AS total_txns,
       CAST(SUM(is_suspicious::BIGINT) AS BIGINT) AS suspicious,
       SUM(CASE WHEN is_suspicious THEN amount_cents ELSE 0 END) / 100.0::DOUBLE AS flagged_usd
FROM transactions
WHERE "timestamp" >= (SELECT CAST(MAX("timestamp") AS DATE) FROM transactions) - INTERVAL 90 DAY
GROUP BY 1 ORDER BY 1""")

ORACLE["typology_breakdown"] = W(f"""
SELECT label AS typology, COUNT(*) AS count, {SUM_USD} AS total_usd, {AVG_USD} AS avg_usd
FROM transactions WHERE is_suspicious GROUP BY label ORDER BY count DESC""")

ORACLE["cross_border_corridors"] = W(f"""
SELECT country_origin, country_dest, COUNT(*) AS count, {SUM_USD} AS total_usd
FROM transactions WHERE is_suspicious AND country_origin != country_dest
GROUP BY 1, 2 ORDER BY count DESC, country_origin, country_dest LIMIT 30""")

ORACLE["structuring_alerts"] = W(f"""
SELECT sender_id, CAST("timestamp" AS DATE) AS date, COUNT(*) AS txn_count,
       {SUM_USD} AS total_daily_usd, MAX(amount_cents) / 100.0::DOUBLE AS max_single_txn
FROM transactions WHERE amount_cents < 1000000 AND structuring_flag
GROUP BY 1, 2 HAVING COUNT(*) >= 3
ORDER BY txn_count DESC, sender_id, date LIMIT 100""")

ORACLE["hourly_velocity"] = W(f"""
SELECT sender_id, date_trunc('hour', "timestamp") AS hour_bucket, COUNT(*) AS txn_per_hour,
       {SUM_USD} AS hourly_usd
FROM transactions GROUP BY 1, 2 HAVING COUNT(*) >= 5
ORDER BY txn_per_hour DESC, sender_id, hour_bucket LIMIT 100""")

ORACLE["weekly_alert_timeline"] = W(
    """
SELECT CAST(s.week_start + INTERVAL 6 DAY AS DATE) AS week,
       CAST(COALESCE(c.total, 0) AS BIGINT) AS total,
       CAST(COALESCE(c.suspicious, 0) AS BIGINT) AS suspicious
FROM (SELECT CAST(UNNEST(generate_series(MIN(week_start), MAX(week_start), INTERVAL 7 DAY)) AS DATE) AS week_start
      FROM wk_counts) s
LEFT JOIN wk_counts c ON s.week_start = c.week_start""",
    """
wk_counts AS (
    SELECT CAST(date_trunc('week', "timestamp") AS DATE) AS week_start, COUNT(*) AS total,
           SUM(is_suspicious::BIGINT) AS suspicious
    FROM transactions GROUP BY 1
)""",
)

ORACLE["label_counts"] = W("SELECT label, COUNT(*) AS count FROM transactions GROUP BY label")

ORACLE["class_distribution"] = W("""
SELECT is_suspicious, COUNT(*) AS count,
       round(COUNT(*) / (SELECT COUNT(*) FROM transactions)::DOUBLE, 6) AS share
FROM transactions GROUP BY is_suspicious""")

ORACLE["hour_class_crosstab"] = W(
    """
SELECT hour, round(n_false / SUM(n_false) OVER (), 6) AS normal_share,
       round(n_true / SUM(n_true) OVER (), 6) AS suspicious_share
FROM ct""",
    """
ct AS (
    SELECT CAST(hour("timestamp") AS INTEGER) AS hour,
           COUNT(*) FILTER (WHERE NOT is_suspicious) AS n_false,
           COUNT(*) FILTER (WHERE is_suspicious) AS n_true
    FROM transactions GROUP BY 1
)""",
)

ORACLE["suspicion_by_jurisdiction"] = W("""
SELECT c.jurisdiction_risk, COUNT(*) AS txn_count,
       round(AVG(CASE WHEN t.is_suspicious THEN 1.0 ELSE 0.0 END::DOUBLE), 6) AS suspicion_rate
FROM transactions t LEFT JOIN customers c ON t.sender_id = c.customer_id
WHERE c.jurisdiction_risk IS NOT NULL
GROUP BY 1""")

# --- features and stand-in scores ---------------------------------------------------
ZS_CTES = """
_st AS (
    SELECT sender_id AS _sid, AVG(amount_cents) / 100.0::DOUBLE AS sender_mean,
           STDDEV_SAMP(amount_usd) AS sender_sd
    FROM transactions GROUP BY 1
),
tz AS (
    SELECT t.*, sender_mean, sender_sd,
           least(greatest(coalesce((amount_usd - sender_mean) / greatest(sender_sd, 1e-6), 0.0), -5.0), 5.0)
               AS amount_z_score_sender
    FROM transactions t LEFT JOIN _st ON t.sender_id = _st._sid
)"""

SCORE_CTES = ZS_CTES + f""",
_sc AS (
    SELECT transaction_id, sender_id, receiver_id, amount_cents, amount_usd, is_suspicious,
           round(abs(amount_z_score_sender) / 5.0, 6) AS vae_score
    FROM tz
),
_sc2 AS (
    SELECT *, round(vae_score / ((SELECT MAX(vae_score) FROM _sc) + 1e-9), 6) AS combined_score FROM _sc
),
scores AS (
    SELECT *, (SELECT round(quantile_cont(combined_score, 0.95), 9) FROM _sc2 WHERE NOT is_suspicious) AS threshold
    FROM _sc2
),
scores_f AS (
    SELECT *, CAST(combined_score >= threshold AS INTEGER) AS is_flagged FROM scores
),
alerts AS (
    SELECT sender_id AS customer_id, {GRID_AVG('vae_score')} AS vae_score,
           {GRID_AVG('combined_score')} AS combined_score, MAX(is_flagged) AS is_flagged
    FROM scores_f GROUP BY 1
)"""

RISK_CTES = f"""
_inb AS (
    SELECT t.receiver_id AS _rid, {GRID_AVG('c.risk_score')} AS _nbr
    FROM transactions t JOIN customers c ON t.sender_id = c.customer_id GROUP BY 1
),
risk AS (
    SELECT c.customer_id, {GRID_MID('c.risk_score', 'COALESCE(_nbr, c.risk_score)')} AS gnn_risk_score,
           CAST(c.is_suspicious AS BIGINT) AS is_suspicious_true
    FROM customers c LEFT JOIN _inb ON c.customer_id = _inb._rid
)"""

NODE_CTES = """
_sent AS (
    SELECT sender_id AS _id, COUNT(*) AS sent_count, SUM(amount_cents) AS sent_cents,
           COUNT(DISTINCT receiver_id) AS sent_unique
    FROM transactions GROUP BY 1
),
_recv AS (
    SELECT receiver_id AS _id, COUNT(*) AS recv_count, SUM(amount_cents) AS recv_cents,
           COUNT(DISTINCT sender_id) AS recv_unique
    FROM transactions GROUP BY 1
),
nodes AS (
    SELECT c.customer_id,
           CAST(COALESCE(sent_count, 0) + COALESCE(recv_count, 0) AS DOUBLE) AS degree,
           ln(1 + (COALESCE(sent_cents, 0) + COALESCE(recv_cents, 0)) / 100.0::DOUBLE) AS total_amount,
           CAST(COALESCE(sent_unique, 0) + COALESCE(recv_unique, 0) AS DOUBLE) AS unique_counterparties,
           COALESCE(c.risk_score, 0.0) AS risk_score,
           CAST(CASE c.jurisdiction_risk WHEN 'low' THEN 0.0 WHEN 'medium' THEN 1.0 WHEN 'high' THEN 2.0 ELSE 1.0 END
                AS DOUBLE) AS jurisdiction_risk,
           ((COALESCE(sent_cents, 0) + COALESCE(recv_cents, 0)) / 100.0::DOUBLE)
               / greatest(COALESCE(sent_count, 0) + COALESCE(recv_count, 0), 1) AS avg_txn_amount,
           CAST(COALESCE(sent_count, 0) + COALESCE(recv_count, 0) AS DOUBLE) AS txn_count
    FROM customers c LEFT JOIN _sent s ON c.customer_id = s._id LEFT JOIN _recv r ON c.customer_id = r._id
)"""

NODE_COLS = ["degree", "total_amount", "unique_counterparties", "risk_score", "jurisdiction_risk", "avg_txn_amount", "txn_count"]

ORACLE["txn_features"] = W(
    """
SELECT transaction_id,
       round(amount_usd, 6) AS amount_usd,
       round(ln(1 + amount_usd), 6) AS log_amount,
       round(hour("timestamp") / 23.0::DOUBLE, 6) AS hour_of_day,
       round((isodow("timestamp") - 1) / 6.0::DOUBLE, 6) AS day_of_week,
       CAST(COALESCE(country_origin != country_dest, TRUE) AS DOUBLE) AS is_cross_border,
       CAST(round_amount AS DOUBLE) AS round_amount,
       CAST(rapid_movement AS DOUBLE) AS rapid_movement,
       CAST(structuring_flag AS DOUBLE) AS structuring_flag,
       round(amount_z_score_sender, 6) AS amount_z_score_sender
FROM tz""",
    ZS_CTES,
)

ORACLE["sender_zscore"] = W(
    """
SELECT transaction_id, sender_id, round(sender_mean, 6) AS sender_mean,
       round(COALESCE(sender_sd, 0.0), 6) AS sender_sd,
       round(amount_z_score_sender, 6) AS amount_z_score_sender
FROM tz""",
    ZS_CTES,
)

ORACLE["node_features"] = W(
    "SELECT customer_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in NODE_COLS) + " FROM nodes", NODE_CTES
)

ORACLE["node_features_scaled"] = W(
    "SELECT customer_id, "
    + ", ".join(
        f"round(({c} - (SELECT AVG({c}) FROM nodes)) / (SELECT CASE WHEN STDDEV_POP({c}) = 0 OR STDDEV_POP({c}) IS NULL "
        f"THEN 1.0 ELSE STDDEV_POP({c}) END FROM nodes), 6) AS {c}"
        for c in NODE_COLS
    )
    + " FROM nodes",
    NODE_CTES,
)

ORACLE["weighted_edges"] = W("""
SELECT transaction_id, sender_id AS src, receiver_id AS dst, round(ln(1 + amount_usd), 6) AS weight
FROM transactions""")

ORACLE["customer_risk_scores"] = W("SELECT * FROM risk", RISK_CTES)

ORACLE["anomaly_scores"] = W(
    "SELECT transaction_id, vae_score, combined_score, threshold, is_flagged FROM scores_f", SCORE_CTES
)
ORACLE["anomaly_threshold"] = W(
    """
SELECT round(quantile_cont(combined_score, 0.95), 9) AS threshold, COUNT(*) AS normal_rows
FROM scores_f WHERE NOT is_suspicious""",
    SCORE_CTES,
)
ORACLE["customer_alerts"] = W("SELECT * FROM alerts", SCORE_CTES)
ORACLE["flagged_transactions"] = W(
    """
SELECT transaction_id, sender_id, receiver_id, amount_usd, combined_score, threshold
FROM scores_f WHERE is_flagged = 1""",
    SCORE_CTES,
)
ORACLE["fused_scores"] = W(
    """
SELECT s.transaction_id, s.vae_score,
       round(0.6 * s.combined_score
             + 0.4 * ((CAST(t.structuring_flag AS DOUBLE)
                      + CAST(COALESCE(t.country_origin != t.country_dest, TRUE) AS DOUBLE)) / 2.0), 6)
           AS combined_score
FROM scores_f s JOIN transactions t ON s.transaction_id = t.transaction_id""",
    SCORE_CTES,
)
ORACLE["batch_scores"] = W(
    """
SELECT transaction_id, combined_score AS anomaly_score, threshold, is_flagged = 1 AS is_flagged,
       CASE WHEN round(combined_score / threshold, 9) >= 3.0 THEN 'CRITICAL'
            WHEN round(combined_score / threshold, 9) >= 1.5 THEN 'HIGH'
            WHEN round(combined_score / threshold, 9) >= 1.0 THEN 'MEDIUM'
            ELSE 'LOW' END AS alert_level
FROM scores_f""",
    SCORE_CTES,
)
ORACLE["high_risk_network"] = W(
    f"""
SELECT t.sender_id AS customer_id, round(AVG(r.gnn_risk_score), 4) AS gnn_risk_score,
       COUNT(t.transaction_id) AS txn_count, {SUM_USD} AS total_usd,
       CAST(SUM(t.is_suspicious::BIGINT) AS BIGINT) AS suspicious_count
FROM transactions t LEFT JOIN risk r ON t.sender_id = r.customer_id
WHERE r.gnn_risk_score > 0.5
GROUP BY t.sender_id ORDER BY gnn_risk_score DESC, customer_id LIMIT 50""",
    RISK_CTES,
)
ORACLE["anomaly_flagged_customers"] = W(
    """
SELECT customer_id, round(AVG(vae_score), 6) AS avg_vae_score,
       round(AVG(combined_score), 6) AS avg_combined_score, CAST(MAX(is_flagged) AS BIGINT) AS is_flagged
FROM alerts WHERE is_flagged = 1
GROUP BY customer_id ORDER BY avg_combined_score DESC, customer_id LIMIT 100""",
    SCORE_CTES,
)

# --- profiles, alerts and summaries -------------------------------------------------
FLAG_CTES = SCORE_CTES + """,
flagged AS (
    SELECT f.*, t.transaction_type FROM scores_f f JOIN transactions t USING (transaction_id) WHERE f.is_flagged = 1
),
involved AS (
    SELECT sender_id AS customer_id FROM flagged UNION SELECT receiver_id FROM flagged
)"""

ORACLE["alert_levels"] = W(
    """
SELECT CASE WHEN round(combined_score / threshold, 9) >= 3.0 THEN 'CRITICAL'
            WHEN round(combined_score / threshold, 9) >= 1.5 THEN 'HIGH'
            WHEN round(combined_score / threshold, 9) >= 1.0 THEN 'MEDIUM'
            ELSE 'LOW' END AS alert_level, COUNT(*) AS txn_count
FROM scores_f GROUP BY 1""",
    SCORE_CTES,
)
ORACLE["customer_risk_labels"] = W(
    """
SELECT c.customer_id, r.gnn_risk_score,
       CASE WHEN r.gnn_risk_score IS NULL THEN 'UNKNOWN' WHEN r.gnn_risk_score > 0.7 THEN 'HIGH'
            WHEN r.gnn_risk_score > 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM customers c LEFT JOIN risk r ON c.customer_id = r.customer_id""",
    RISK_CTES,
)
ORACLE["round_amount_flag"] = W(
    "SELECT transaction_id, amount_usd, amount_cents % 10000 = 0 AS round_amount FROM transactions"
)
ORACLE["jurisdiction_risk"] = W(
    """
SELECT t.country_dest, COALESCE(l.jurisdiction_risk, 'medium') AS jurisdiction_risk, COUNT(*) AS txn_count
FROM transactions t LEFT JOIN lk l ON t.country_dest = l.country GROUP BY 1, 2""",
    """
lk AS (
    SELECT country, MIN(jurisdiction_risk) AS jurisdiction_risk FROM (
        SELECT * FROM (VALUES ('US','low'),('UK','low'),('DE','low'),('JP','low'),('AU','low'),
                              ('MX','medium'),('BR','medium'),('ZA','medium'),('IN','medium'),('TH','medium'),
                              ('PA','high'),('KY','high'),('BZ','high'),('VU','high'),('LB','high')) v(country, jurisdiction_risk)
        UNION SELECT DISTINCT country, jurisdiction_risk FROM customers WHERE country IS NOT NULL
    ) GROUP BY country
)""",
)
ORACLE["recent_alerts"] = W("""
SELECT transaction_id, "timestamp", sender_id, receiver_id, amount_usd,
       '$' || format('{:,.2f}', amount_usd) AS amount_text, label
FROM transactions WHERE is_suspicious ORDER BY amount_cents DESC, transaction_id LIMIT 15""")
ORACLE["alerts_page"] = W(
    """
SELECT transaction_id, sender_id, amount_usd, combined_score,
       (SELECT COUNT(*) FROM scores_f WHERE combined_score >= 0.3) AS total
FROM scores_f WHERE combined_score >= 0.3
ORDER BY combined_score DESC, transaction_id LIMIT 50 OFFSET 50""",
    SCORE_CTES,
)
ORACLE["alerts_with_truth"] = W(
    """
SELECT a.customer_id, a.combined_score, a.is_flagged, COALESCE(t.truth, FALSE) AS is_suspicious_true
FROM alerts a LEFT JOIN (SELECT sender_id, bool_or(is_suspicious) AS truth FROM transactions GROUP BY 1) t
  ON a.customer_id = t.sender_id""",
    SCORE_CTES,
)
ORACLE["fallback_alert_scores"] = W("""
SELECT sender_id AS customer_id,
       CAST((2 * SUM(amount_cents) + 10 * COUNT(*)) // (20 * COUNT(*)) AS BIGINT) / 1e6::DOUBLE AS vae_score
FROM transactions WHERE is_suspicious GROUP BY 1""")
ORACLE["sender_activity_profile"] = W(f"""
SELECT sender_id AS customer_id, {SUM_USD} AS total_amount, COUNT(*) AS txn_count,
       MIN("timestamp") AS min_date, MAX("timestamp") AS max_date,
       bool_or(structuring_flag) AS structuring, bool_or(is_suspicious) AS cross_border,
       COALESCE(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE label != 'normal'))), ', '), '')
           AS typologies,
       COUNT(*) FILTER (WHERE COALESCE(country_origin != country_dest, TRUE)) AS cross_border_count,
       SUM(CASE WHEN is_suspicious THEN amount_cents ELSE 0 END) / 100.0::DOUBLE AS flagged_amount_usd
FROM transactions GROUP BY 1""")
ORACLE["score_histogram"] = W(
    """
SELECT is_suspicious,
       CAST(CASE WHEN (r.hi - r.lo) / 60.0 > 0
            THEN least(floor((combined_score - r.lo) / ((r.hi - r.lo) / 60.0)), 59) ELSE 0 END AS INTEGER) AS bin,
       COUNT(*) AS count
FROM scores_f, (SELECT MIN(combined_score) AS lo, MAX(combined_score) AS hi FROM scores_f) r
GROUP BY 1, 2""",
    SCORE_CTES,
)
ORACLE["winsorized_amounts"] = W(
    """
SELECT t.transaction_id, t.is_suspicious, p.p99_amount, least(t.amount_usd, p.p99_amount) AS amount_clipped
FROM transactions t LEFT JOIN p ON t.is_suspicious = p.cls""",
    """
p AS (SELECT is_suspicious AS cls, round(quantile_cont(amount_usd, 0.99), 6) AS p99_amount FROM transactions GROUP BY 1)""",
)
ORACLE["score_summary"] = W(
    f"""
SELECT COUNT(*) AS n, {GRID_AVG('combined_score')} AS mean_score, MAX(combined_score) AS max_score,
       round(quantile_cont(combined_score, 0.95), 9) AS p95_score
FROM scores_f""",
    SCORE_CTES,
)
ORACLE["top_risk_customers"] = W(
    """
SELECT r.customer_id, c.name, c.country, r.gnn_risk_score, c.risk_score, r.is_suspicious_true
FROM risk r LEFT JOIN customers c ON r.customer_id = c.customer_id
ORDER BY r.gnn_risk_score DESC, r.customer_id LIMIT 20""",
    RISK_CTES,
)
ORACLE["rule_vs_graph"] = W(
    f"""
SELECT COUNT(*) AS customers, round(corr(c.risk_score, r.gnn_risk_score), 6) AS correlation,
       {GRID_AVG('c.risk_score')} AS mean_rule_score, {GRID_AVG('r.gnn_risk_score')} AS mean_graph_score
FROM risk r JOIN customers c ON r.customer_id = c.customer_id""",
    RISK_CTES,
)
ORACLE["high_risk_by_jurisdiction"] = W(
    """
SELECT c.jurisdiction_risk, COUNT(*) AS count
FROM risk r JOIN customers c ON r.customer_id = c.customer_id
WHERE r.gnn_risk_score >= 0.7 GROUP BY 1""",
    RISK_CTES,
)
ORACLE["involved_customers"] = W("SELECT customer_id FROM involved", FLAG_CTES)
ORACLE["flagged_sender_context"] = W(
    f"""
SELECT sender_id, COUNT(*) AS transaction_count, {SUM_USD} AS total_amount_usd,
       {GRID_AVG('combined_score')} AS vae_score,
       array_to_string(list_sort(list_distinct(list(transaction_type))), ', ') AS transaction_types
FROM flagged GROUP BY 1""",
    FLAG_CTES,
)
ORACLE["investigation_summary"] = W(
    f"""
SELECT COUNT(*) AS customers_involved, COUNT(*) FILTER (WHERE g > 0.6) AS high_risk_count,
       COALESCE({GRID_AVG('g')}, 0.0) AS avg_gnn_risk,
       (SELECT COUNT(*) FROM flagged) AS flagged_txn_count,
       (SELECT COALESCE(SUM(amount_cents), 0) FROM flagged) / 100.0::DOUBLE AS total_flagged_usd
FROM (SELECT i.customer_id, COALESCE(r.gnn_risk_score, 0.0) AS g
      FROM involved i LEFT JOIN risk r ON i.customer_id = r.customer_id)""",
    FLAG_CTES + "," + RISK_CTES,
)
_RISK_SUMMARY = f"""
SELECT n_total, n_flagged, round(n_flagged / greatest(n_total, 1)::DOUBLE, 6) AS flag_rate,
       avg_combined_score, avg_gnn_risk, final_risk_score,
       CASE WHEN final_risk_score >= 0.75 THEN 'CRITICAL' WHEN final_risk_score >= 0.5 THEN 'HIGH'
            WHEN final_risk_score >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END AS final_risk_level,
       CASE WHEN final_risk_score >= 0.75 THEN 'Immediate escalation to Chief Compliance Officer. Freeze implicated accounts pending investigation. File SAR with FinCEN within 30 days. Notify BSA officer.'
            WHEN final_risk_score >= 0.5 THEN 'Priority review by senior AML analyst within 24 hours. Enhanced due diligence (EDD) required. SAR filing recommended.'
            WHEN final_risk_score >= 0.25 THEN 'Schedule analyst review within 5 business days. Document findings. Continue enhanced monitoring.'
            ELSE 'Standard automated monitoring. No immediate action required.' END AS action_recommendation
FROM (
    SELECT *, round(0.5 * least(n_flagged / greatest(n_total, 1)::DOUBLE * 10, 1.0)
                    + 0.3 * avg_combined_score + 0.2 * avg_gnn_risk, 4) AS final_risk_score
    FROM (
        SELECT COUNT(*) AS n_total, COUNT(*) FILTER (WHERE is_flagged = 1) AS n_flagged,
               COALESCE({GRID_AVG('combined_score')}, 0.0) AS avg_combined_score,
               (SELECT COALESCE({GRID_AVG('COALESCE(r.gnn_risk_score, 0.0)')}, 0.0)
                FROM involved i LEFT JOIN risk r ON i.customer_id = r.customer_id) AS avg_gnn_risk
        FROM scores_f
    )
)"""
ORACLE["batch_risk_summary"] = W(_RISK_SUMMARY, FLAG_CTES + "," + RISK_CTES)
ORACLE["score_result_files"] = W(
    f"""
SELECT s.*, f.* FROM ({_RISK_SUMMARY}) s,
     (SELECT COUNT(*) AS flagged_rows, COALESCE({SUM_USD}, 0.0) AS flagged_usd FROM scores_f WHERE is_flagged = 1) f""",
    FLAG_CTES + "," + RISK_CTES,
)
ORACLE["fitted_checks"] = W(
    "SELECT COUNT(*) AS transactions, 0::BIGINT AS out_of_range, 0::BIGINT AS wrong_flags, CAST(SUM(amount_cents) AS BIGINT) AS amount_cents FROM transactions"
)
ORACLE["oversample_checks"] = W(
    "SELECT COUNT(*) AS synthetic, COUNT(*) AS ids, 0::BIGINT AS broken FROM transactions WHERE is_suspicious"
)
ORACLE["customer_risk_checks"] = W(
    "SELECT COUNT(*) AS customers, COUNT(*) FILTER (WHERE is_suspicious) AS suspicious, 0::BIGINT AS impossible FROM customers"
)
ORACLE["node_index"] = W("SELECT customer_id, row_number() OVER (ORDER BY customer_id) - 1 AS idx FROM customers")
ORACLE["edge_coo"] = W(
    """
SELECT t.transaction_id, s.idx AS src_idx, r.idx AS dst_idx
FROM transactions t JOIN ix s ON t.sender_id = s.customer_id JOIN ix r ON t.receiver_id = r.customer_id""",
    "ix AS (SELECT customer_id, row_number() OVER (ORDER BY customer_id) - 1 AS idx FROM customers)",
)

# --- evaluation ---------------------------------------------------------------------


def R(a: str, b: str, d: int = 6) -> str:
    p = 10**d
    return f"CAST(({a} * {2 * p} + ({b})) // (2 * ({b})) AS BIGINT) / {p}.0::DOUBLE"


def HU(x: str, d: int) -> str:
    p = 10**d
    return f"floor(({x}) * {p}.0 + 0.5) / {p}.0"


EV_CTES = SCORE_CTES + """,
ev AS (SELECT CAST(is_suspicious AS INTEGER) AS y, is_flagged AS p, combined_score AS s FROM scores_f),
cc AS (
    SELECT COUNT(*) FILTER (WHERE y = 1 AND p = 1) AS tp, COUNT(*) FILTER (WHERE y <> 1 AND p = 1) AS fp,
           COUNT(*) FILTER (WHERE y <> 1 AND p <> 1) AS tn, COUNT(*) FILTER (WHERE y = 1 AND p <> 1) AS fn
    FROM ev
),
sc AS (SELECT s AS score, COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y <> 1) AS neg FROM ev GROUP BY 1),
cum AS (
    SELECT score, pos, neg,
           CAST(SUM(pos) OVER (ORDER BY score DESC) AS BIGINT) AS pos_cum,
           CAST(SUM(neg) OVER (ORDER BY score DESC) AS BIGINT) AS neg_cum
    FROM sc
),
tot AS (SELECT COUNT(*) FILTER (WHERE y = 1) AS P, COUNT(*) FILTER (WHERE y <> 1) AS N FROM ev)"""

_p = "(tp / greatest(tp + fp, 1))"
_r = "(tp / greatest(tp + fn, 1))"
ORACLE["classification_metrics"] = W(
    f"""
SELECT tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives,
       {R('tp', 'greatest(tp + fp, 1)', 4)} AS precision, {R('tp', 'greatest(tp + fn, 1)', 4)} AS recall,
       {R('tn', 'greatest(tn + fp, 1)', 4)} AS specificity,
       {HU(f'2.0::DOUBLE * {_p} * {_r} / greatest({_p} + {_r}, 1e-9)', 4)} AS f1_score,
       {HU(f'5.0::DOUBLE * {_p} * {_r} / greatest(4.0::DOUBLE * {_p} + {_r}, 1e-9)', 4)} AS f2_score,
       {R('fp', 'greatest(fp + tn, 1)', 4)} AS false_positive_rate,
       {R('fn', 'greatest(fn + tp, 1)', 4)} AS false_negative_rate
FROM cc""",
    EV_CTES,
)
ORACLE["roc_auc"] = W(
    """
SELECT CASE WHEN P > 0 AND N > 0 THEN round(num / (2.0::DOUBLE * P * N), 6) END AS roc_auc
FROM (SELECT SUM(pos * (2 * (CAST(SUM(neg) OVER (ORDER BY score) AS BIGINT) - neg) + neg)) AS num FROM sc) x
     , tot""".replace(
        "SELECT SUM(pos * (2 * (CAST(SUM(neg) OVER (ORDER BY score) AS BIGINT) - neg) + neg)) AS num FROM sc",
        "SELECT SUM(pos * (2 * (nc - neg) + neg)) AS num FROM (SELECT pos, neg, CAST(SUM(neg) OVER (ORDER BY score) AS BIGINT) AS nc FROM sc)",
    ),
    EV_CTES,
)
ORACLE["average_precision"] = W(
    "SELECT round(SUM((pos / (SELECT P FROM tot)) * (pos_cum / (pos_cum + neg_cum))), 6) AS average_precision FROM cum",
    EV_CTES,
)
ORACLE["pr_curve"] = W(
    f"""
SELECT score AS threshold, pos_cum AS tp, neg_cum AS fp, {R('pos_cum', 'pos_cum + neg_cum')} AS precision,
       CASE WHEN (SELECT P FROM tot) > 0 THEN {R('pos_cum', '(SELECT P FROM tot)')} ELSE 1.0 END AS recall
FROM cum""",
    EV_CTES,
)
ORACLE["optimal_threshold"] = W(
    f"""
SELECT threshold, {HU('p', 4)} AS precision, {HU('r', 4)} AS recall, {HU('m', 4)} AS score
FROM (SELECT score AS threshold, p, r, 5.0::DOUBLE * p * r / greatest(4.0::DOUBLE * p + r, 1e-9) AS m
      FROM (SELECT score, pos_cum / (pos_cum + neg_cum) AS p, pos_cum / (SELECT P FROM tot) AS r FROM cum))
WHERE r >= 0.9 ORDER BY m DESC, threshold ASC LIMIT 1""",
    EV_CTES,
)
_BEST = """,
best AS (
    SELECT score AS threshold
    FROM (SELECT score, pos_cum / (pos_cum + neg_cum) AS p, pos_cum / (SELECT P FROM tot) AS r FROM cum)
    WHERE r >= 0.9 ORDER BY 5.0::DOUBLE * p * r / greatest(4.0::DOUBLE * p + r, 1e-9) DESC, score ASC LIMIT 1
),
cc_best AS (
    SELECT threshold, COUNT(*) FILTER (WHERE y = 1 AND s >= threshold) AS tp, COUNT(*) FILTER (WHERE y <> 1 AND s >= threshold) AS fp,
           COUNT(*) FILTER (WHERE y <> 1 AND s < threshold) AS tn, COUNT(*) FILTER (WHERE y = 1 AND s < threshold) AS fn
    FROM ev, best GROUP BY threshold
)"""
ORACLE["optimal_threshold_metrics"] = (
    ORACLE["classification_metrics"].replace(EV_CTES, EV_CTES + _BEST).replace("SELECT tp AS true_positives", "SELECT threshold, tp AS true_positives").replace("FROM cc", "FROM cc_best")
)
ORACLE["threshold_sensitivity"] = W(
    f"""
SELECT k, round(t, 9) AS threshold, tp, fp, {R('tp', 'greatest(tp + fp, 1)')} AS precision,
       {R('tp', 'greatest((SELECT P FROM tot), 1)')} AS recall,
       {HU('2.0::DOUBLE * pr * rc / greatest(pr + rc, 1e-9)', 6)} AS f1
FROM (
    SELECT k, t, tp, fp, tp / greatest(tp + fp, 1) AS pr, tp / greatest((SELECT P FROM tot), 1) AS rc
    FROM (
        SELECT g.k, g.t, COUNT(*) FILTER (WHERE ev.y = 1) AS tp, COUNT(*) FILTER (WHERE ev.y <> 1) AS fp
        FROM (SELECT k, lo + k * ((hi - lo) / 199.0::DOUBLE) AS t
              FROM range(200) r(k),
                   (SELECT MIN(s) AS lo, round(quantile_cont(s, 0.99), 9) AS hi FROM ev) b) g
        LEFT JOIN ev ON ev.s >= g.t
        GROUP BY g.k, g.t
    )
)""",
    EV_CTES,
)
ORACLE["detection_cost"] = W(
    """
SELECT tp AS true_positives, fp AS false_positives, fn AS false_negatives,
       fn * 100000.0::DOUBLE + fp * 500.0::DOUBLE AS total_cost_usd,
       fn * 100000.0::DOUBLE AS missed_laundering_cost_usd, fp * 500.0::DOUBLE AS false_alert_cost_usd,
       round((fn * 100000.0::DOUBLE + fp * 500.0::DOUBLE) / greatest(tp, 1), 6) AS cost_per_true_positive_usd
FROM cc""",
    EV_CTES,
)
ORACLE["confusion_matrix"] = W(
    f"""
SELECT true_label, pred_label, count, {R('count', 'SUM(count) OVER (PARTITION BY true_label)')} AS share
FROM (SELECT y AS true_label, CAST(p AS INTEGER) AS pred_label, COUNT(*) AS count FROM ev GROUP BY 1, 2)""",
    EV_CTES,
)
_cls = """
    SELECT '{lab}' AS label, {a} / greatest({a} + {b}, 1) AS precision, {a} / greatest({a} + {c}, 1) AS recall,
           {a} + {c} AS support FROM cc"""
ORACLE["classification_report"] = W(
    f"""
SELECT label, {HU('precision', 4)} AS precision, {HU('recall', 4)} AS recall, {HU('f1', 4)} AS f1,
       CAST(support AS BIGINT) AS support
FROM (
    SELECT * FROM cls
    UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1), SUM(support) FROM cls
    UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
                     SUM(f1 * support) / SUM(support), SUM(support) FROM cls
)""",
    EV_CTES
    + """,
cls0 AS ("""
    + _cls.format(lab="0", a="tn", b="fn", c="fp")
    + " UNION ALL "
    + _cls.format(lab="1", a="tp", b="fp", c="fn")
    + """),
cls AS (SELECT label, precision, recall,
               CASE WHEN precision + recall > 0 THEN 2.0::DOUBLE * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
               support FROM cls0)""",
)
ORACLE["prevalence_baseline"] = W(
    f"SELECT COUNT(*) AS n, {R('COUNT(*) FILTER (WHERE y = 1)', 'COUNT(*)')} AS prevalence FROM ev", EV_CTES
)

# --- causal and what-if -------------------------------------------------------------
DID_CTES = """
cells AS (
    SELECT CAST(structuring_flag AS INTEGER) AS treated,
           CAST("timestamp" >= TIMESTAMP '1998-07-01' AS INTEGER) AS post,
           COUNT(*) AS n, SUM(CAST(is_suspicious AS DOUBLE)) AS s, var_samp(CAST(is_suspicious AS DOUBLE)) AS v
    FROM transactions GROUP BY 1, 2
),
one AS (
    SELECT MAX(n) FILTER (WHERE treated = 0 AND post = 0) AS n_00, MAX(n) FILTER (WHERE treated = 0 AND post = 1) AS n_01,
           MAX(n) FILTER (WHERE treated = 1 AND post = 0) AS n_10, MAX(n) FILTER (WHERE treated = 1 AND post = 1) AS n_11,
           MAX(s) FILTER (WHERE treated = 0 AND post = 0) / MAX(n) FILTER (WHERE treated = 0 AND post = 0) AS m_00,
           MAX(s) FILTER (WHERE treated = 0 AND post = 1) / MAX(n) FILTER (WHERE treated = 0 AND post = 1) AS m_01,
           MAX(s) FILTER (WHERE treated = 1 AND post = 0) / MAX(n) FILTER (WHERE treated = 1 AND post = 0) AS m_10,
           MAX(s) FILTER (WHERE treated = 1 AND post = 1) / MAX(n) FILTER (WHERE treated = 1 AND post = 1) AS m_11,
           sqrt(SUM(v / n)) AS se,
           SUM(s) FILTER (WHERE post = 0) / SUM(n) FILTER (WHERE post = 0) AS baseline_mean
    FROM cells
),
did AS (
    SELECT n_00, n_01, n_10, n_11,
           round(m_00, 6) AS mean_00, round(m_01, 6) AS mean_01, round(m_10, 6) AS mean_10, round(m_11, 6) AS mean_11,
           round(((m_11 - m_10) - (m_01 - m_00)), 6) AS ate, round(se, 6) AS se,
           round(((m_11 - m_10) - (m_01 - m_00)) - 1.96::DOUBLE * se, 6) AS ate_lower,
           round(((m_11 - m_10) - (m_01 - m_00)) + 1.96::DOUBLE * se, 6) AS ate_upper,
           round(((m_11 - m_10) - (m_01 - m_00)) / greatest(abs(baseline_mean), 1e-9) * 100.0::DOUBLE, 6)
               AS relative_effect_pct
    FROM one
)"""
ORACLE["did_effect"] = W("SELECT * FROM did", DID_CTES)


def FMT(x: str, d: int) -> str:
    return f"printf('%.{d}f', {HU(x, d)})"


ORACLE["rule_effect"] = W(
    f"""
SELECT 'DiD' AS estimator, 'Enhanced Structuring Rule' AS treatment, 'is_suspicious' AS outcome,
       ate, ate_lower, ate_upper, relative_effect_pct,
       'Implementing ''Enhanced Structuring Rule'' is estimated to have '
       || CASE WHEN ate < 0 THEN 'reduced' ELSE 'increased' END
       || ' suspicious activity by ' || {FMT('abs(relative_effect_pct)', 1)}
       || '% (ATE=' || {FMT('ate', 4)} || ', 95% CI [' || {FMT('ate_lower', 4)} || ', ' || {FMT('ate_upper', 4)}
       || ']). This effect is '
       || CASE WHEN NOT (ate_lower <= 0 AND ate_upper >= 0) THEN 'statistically significant'
               ELSE 'not statistically significant at 95% confidence' END || '.' AS interpretation
FROM did""",
    DID_CTES,
)


def SGN_TH(x: str) -> str:
    return f"(CASE WHEN ({x}) < 0 THEN '-' ELSE '+' END || format('{{:,}}', CAST(abs({x}) AS BIGINT)))"


def SGN_FX(x: str, d: int) -> str:
    return f"(CASE WHEN {HU(x, d)} < 0 THEN '-' ELSE '+' END || printf('%.{d}f', abs({HU(x, d)})))"


def _whatif(cur: str, new: str, scores: str) -> str:
    return W(
        f"""
SELECT 'Threshold ' || CASE WHEN nt < ct THEN 'lower' ELSE 'higher' END || ': ' || {FMT('ct', 5)} || ' → ' || {FMT('nt', 5)}
           AS scenario,
       b AS baseline_alerts, c AS counterfactual_alerts, c - b AS delta_alerts,
       {HU('(c - b) / greatest(b, 1) * 100.0::DOUBLE', 2)} AS delta_pct,
       bc / 100.0::DOUBLE AS baseline_flagged_amount, cc_ / 100.0::DOUBLE AS counterfactual_flagged_amount,
       CASE WHEN nt < ct THEN
           'Lowering threshold by ' || {FMT('abs(ct - nt) / ct * 100.0::DOUBLE', 1)} || '% would increase alerts by '
           || {SGN_TH('c - b')} || ' (' || {SGN_FX('(c - b) / greatest(b, 1) * 100.0::DOUBLE', 1)} || '%), capturing USD '
           || {SGN_TH('dd')} || ' more in flagged volume. Consider analyst capacity before implementing.'
       ELSE
           'Raising threshold by ' || {FMT('abs(ct - nt) / ct * 100.0::DOUBLE', 1)} || '% would reduce alerts by '
           || format('{{:,}}', CAST(abs(c - b) AS BIGINT)) || ' (' || {FMT('(c - b) / greatest(b, 1) * 100.0::DOUBLE', 1)}
           || '%), but risks missing USD ' || format('{{:,}}', CAST(abs(dd) AS BIGINT)) || ' in suspicious activity.'
       END AS recommendation
FROM (
    SELECT *, ((abs(cc_ - bc) + 50) // 100) * CASE WHEN cc_ < bc THEN -1 ELSE 1 END AS dd
    FROM (
        SELECT MAX({cur}) AS ct, MAX({new}) AS nt,
               COUNT(*) FILTER (WHERE combined_score >= {cur}) AS b,
               COUNT(*) FILTER (WHERE combined_score >= {new}) AS c,
               COALESCE(SUM(amount_cents) FILTER (WHERE combined_score >= {cur}), 0) AS bc,
               COALESCE(SUM(amount_cents) FILTER (WHERE combined_score >= {new}), 0) AS cc_
        FROM {scores}
    )
)""",
        SCORE_CTES,
    )


ORACLE["whatif_threshold"] = _whatif("threshold", "threshold * 0.9::DOUBLE", "scores_f")
# seeded stand-in scores: 13 hex digits of a hash as a fraction
_UNIT = "CAST(CAST('0x' || substr(md5(transaction_id || ':42'), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE"
ORACLE["whatif_threshold_fallback"] = _whatif(
    "0.01::DOUBLE",
    "0.008::DOUBLE",
    f"""(SELECT amount_cents, CASE WHEN is_suspicious THEN 0.01::DOUBLE + {_UNIT} * 0.04::DOUBLE ELSE {_UNIT} * 0.008::DOUBLE END
                 AS combined_score FROM transactions)""",
)
ORACLE["whatif_sweep"] = W(
    f"""
SELECT pct_change, round(ct * (1.0::DOUBLE + pct_change / 100.0::DOUBLE), 9) AS new_threshold, alerts,
       {HU('(alerts - (SELECT alerts FROM sw WHERE pct_change = 0)) / greatest((SELECT alerts FROM sw WHERE pct_change = 0), 1) * 100.0::DOUBLE', 2)}
           AS delta_pct,
       cents / 100.0::DOUBLE AS flagged_amount
FROM sw""",
    SCORE_CTES
    + """,
sw AS (
    SELECT g.pct_change, MAX(f.threshold) AS ct0, (SELECT MAX(threshold) FROM scores_f) AS ct,
           COUNT(f.transaction_id) AS alerts, COALESCE(SUM(f.amount_cents), 0) AS cents
    FROM (SELECT CAST(p AS INTEGER) AS pct_change FROM range(-50, 55, 5) r(p)) g
    LEFT JOIN scores_f f ON f.combined_score >= f.threshold * (1.0::DOUBLE + g.pct_change / 100.0::DOUBLE)
    GROUP BY g.pct_change
)""",
)

_RULES = [
    ("Flag all wire transfers > $50K from PA/KY", 0.08, 25.0),
    ("Flag all cash deposits near $10K (structuring)", 0.15, 35.0),
    ("Flag rapid succession transfers (< 1 hr apart)", 0.12, 20.0),
    ("Flag all TBML trade payment anomalies", 0.06, 18.0),
]


def _rule_sql(name: str, frac: float, pct: float) -> str:
    q = name.replace("'", "''")
    k = f"CAST(trunc(total * {frac!r}::DOUBLE * {pct / 100.0!r}::DOUBLE) AS BIGINT)"
    return f"""
SELECT '{q}' AS rule_name, {frac * 100:.0f} AS frac_pct, total, cur, bc, {k} AS k,
       (SELECT COALESCE(SUM(amount_cents), 0) FROM ranked WHERE rn <= {k.replace("total", "(SELECT total FROM base)")})
           AS extra
FROM base"""


RULE_BASE = """
ranked AS (SELECT amount_cents, row_number() OVER (ORDER BY "timestamp", transaction_id) AS rn FROM transactions),
base AS (
    SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE is_suspicious) AS cur,
           COALESCE(SUM(amount_cents) FILTER (WHERE is_suspicious), 0) AS bc
    FROM transactions
)"""


def _rule_out(name: str, frac: float, pct: float) -> str:
    q = name.replace("'", "''")
    return f"""
SELECT 'New rule: ''{q}''' AS scenario, cur AS baseline_alerts, cur + k AS counterfactual_alerts, k AS delta_alerts,
       {HU('k * 100.0::DOUBLE / greatest(cur, 1)', 2)} AS delta_pct,
       bc / 100.0::DOUBLE AS baseline_flagged_amount, (bc + extra) / 100.0::DOUBLE AS counterfactual_flagged_amount,
       'Adding ''{q}'' targeting {frac * 100:.0f}% of transactions is estimated to uncover '
       || format('{{:,}}', k) || ' additional alerts (+' || {FMT('k * 100.0::DOUBLE / greatest(cur, 1)', 1)}
       || '%). Estimated incremental flagged amount: USD ' || format('{{:,}}', CAST((extra + 50) // 100 AS BIGINT)) || '.'
           AS recommendation
FROM ({_rule_sql(name, frac, pct)})"""


ORACLE["whatif_rule"] = W(_rule_out(*_RULES[1]), RULE_BASE)
ORACLE["whatif_rules_table"] = W(
    " UNION ALL ".join(
        f"""SELECT '{n[:45].replace("'", "''")}' AS rule, counterfactual_alerts AS new_alerts, delta_alerts AS delta, delta_pct,
                   counterfactual_flagged_amount FROM ({_rule_out(n, f, p)})"""
        for n, f, p in _RULES
    ),
    RULE_BASE,
)

# --- typology detectors -------------------------------------------------------------
H_CTE = """
h AS (
    SELECT transaction_id, sender_id, receiver_id, amount_cents, CAST(epoch("timestamp") AS BIGINT) AS s
    FROM transactions WHERE sender_id != receiver_id
)"""

ORACLE["smurfing_windows"] = W(
    """
SELECT sender_id, transaction_id, window_end, txn_count, c / 100.0::DOUBLE AS total_usd
FROM (
    SELECT sender_id, transaction_id, "timestamp" AS window_end,
           COUNT(*) OVER w AS txn_count, SUM(amount_cents) OVER w AS c
    FROM (SELECT *, CAST(epoch("timestamp") AS BIGINT) AS s FROM transactions WHERE amount_cents < 1000000)
    WINDOW w AS (PARTITION BY sender_id ORDER BY s RANGE BETWEEN 201600 PRECEDING AND CURRENT ROW)
) WHERE txn_count >= 5"""
)
ORACLE["round_trips_2"] = W(
    """
SELECT h1.sender_id AS origin_id, h1.receiver_id AS via_1, h1.transaction_id AS txn_1, h2.transaction_id AS txn_2,
       h1.amount_cents / 100.0::DOUBLE AS first_amount_usd, h2.amount_cents / 100.0::DOUBLE AS last_amount_usd,
       (h2.s - h1.s) / 3600.0::DOUBLE AS span_hours
FROM h h1 JOIN h h2 ON h2.sender_id = h1.receiver_id AND h2.receiver_id = h1.sender_id
                   AND h2.s > h1.s AND h2.s <= h1.s + 604800""",
    H_CTE,
)
ORACLE["round_trips_3"] = W(
    """
SELECT h1.sender_id AS origin_id, h1.receiver_id AS via_1, h2.receiver_id AS via_2,
       h1.transaction_id AS txn_1, h2.transaction_id AS txn_2, h3.transaction_id AS txn_3,
       h1.amount_cents / 100.0::DOUBLE AS first_amount_usd, h3.amount_cents / 100.0::DOUBLE AS last_amount_usd,
       (h3.s - h1.s) / 3600.0::DOUBLE AS span_hours
FROM h h1
JOIN h h2 ON h2.sender_id = h1.receiver_id AND h2.s > h1.s AND h2.s <= h1.s + 604800
         AND h2.receiver_id NOT IN (h1.sender_id, h1.receiver_id)
JOIN h h3 ON h3.sender_id = h2.receiver_id AND h3.receiver_id = h1.sender_id
         AND h3.s > h2.s AND h3.s <= h2.s + 604800""",
    H_CTE,
)
def _chain_sql(depth: int, gap: int, rules: str = "") -> str:
    """Chains of ``depth`` hops back to their origin, ``gap`` seconds a hop at most;
    ``rules`` holds for each hop {b} after hop {a}, the {i}th after the first."""
    hops = range(1, depth + 1)
    joins = []
    for i in hops[1:]:
        on = f"h{i}.sender_id = h{i - 1}.receiver_id AND h{i}.s > h{i - 1}.s AND h{i}.s <= h{i - 1}.s + {gap}"
        seen = ", ".join(["h1.sender_id", *[f"h{j}.receiver_id" for j in range(1, i)]])
        on += f" AND h{i}.receiver_id = h1.sender_id" if i == depth else f" AND h{i}.receiver_id NOT IN ({seen})"
        joins.append(f"JOIN h h{i} ON {on}" + rules.format(a=f"h{i - 1}", b=f"h{i}", i=i - 1, low=2 * 90 ** (i - 1), high=2 * 99 ** (i - 1), whole=100 ** (i - 1)))
    return f"""
SELECT h1.sender_id AS origin_id, {", ".join(f"h{i}.receiver_id AS via_{i}" for i in hops[:-1])},
       {", ".join(f"h{i}.transaction_id AS txn_{i}" for i in hops)},
       h1.amount_cents / 100.0::DOUBLE AS first_amount_usd, h{depth}.amount_cents / 100.0::DOUBLE AS last_amount_usd,
       (h{depth}.s - h1.s) / 3600.0::DOUBLE AS span_hours
FROM h h1 {" ".join(joins)}"""


ORACLE["round_trips_4"] = W(_chain_sql(4, 20 * 86400), H_CTE)
ORACLE["round_trips_5"] = W(_chain_sql(5, 20 * 86400), H_CTE)
for _depth in range(2, 6):
    ORACLE[f"round_trips_rules_{_depth}"] = W(
        _chain_sql(
            _depth, 86400,
            " AND {b}.s >= {a}.s + 3600 AND h1.amount_cents > 0"
            " AND CAST({b}.amount_cents AS HUGEINT) * 2 * {whole} BETWEEN CAST(h1.amount_cents AS HUGEINT) * {low} - {whole}"
            " AND CAST(h1.amount_cents AS HUGEINT) * {high} + {whole}",
        ),
        PLANTED_CTES + "," + H_CTE.replace("FROM transactions", "FROM planted"),
    )
ORACLE["rapid_movement"] = W(
    """
SELECT c.account_id, c.in_txn, MIN(o.transaction_id) AS out_txn, (c.os - c.s) / 3600.0::DOUBLE AS delay_hours
FROM (
    SELECT i.receiver_id AS account_id, i.transaction_id AS in_txn, i.s, MIN(o.s) AS os
    FROM ev i JOIN ev o ON o.sender_id = i.receiver_id AND o.s > i.s AND o.s <= i.s + 86400
    GROUP BY 1, 2, 3
) c JOIN ev o ON o.sender_id = c.account_id AND o.s = c.os
GROUP BY c.account_id, c.in_txn, c.os, c.s""",
    """
ev AS (SELECT transaction_id, sender_id, receiver_id, CAST(epoch("timestamp") AS BIGINT) AS s FROM transactions)""",
)
ORACLE["tbml_pairs"] = W(
    f"""
SELECT sender_id, receiver_id, COUNT(*) AS payment_count, {SUM_USD} AS total_usd,
       round(MIN(gap), 6) AS min_gap_days, round(MAX(gap), 6) AS max_gap_days,
       bool_and(COALESCE(gap >= 1 AND gap <= 14, TRUE)) AS gaps_in_range
FROM (
    SELECT *, (s - lag(s) OVER (PARTITION BY sender_id, receiver_id ORDER BY s, transaction_id)) / 86400.0::DOUBLE AS gap
    FROM (SELECT *, CAST(epoch("timestamp") AS BIGINT) AS s FROM transactions
          WHERE transaction_type = 'TRADE_PAYMENT' AND amount_cents >= 1000000)
) GROUP BY 1, 2 HAVING COUNT(*) >= 2"""
)
ORACLE["fan_out"] = W(f"""
SELECT sender_id, CAST("timestamp" AS DATE) AS date, COUNT(DISTINCT receiver_id) AS distinct_receivers,
       COUNT(*) AS txn_count, {SUM_USD} AS total_usd
FROM transactions GROUP BY 1, 2 HAVING COUNT(DISTINCT receiver_id) >= 5""")
ORACLE["fan_in"] = W(f"""
SELECT receiver_id, CAST("timestamp" AS DATE) AS date, COUNT(DISTINCT sender_id) AS distinct_senders,
       COUNT(*) AS txn_count, {SUM_USD} AS total_usd
FROM planted GROUP BY 1, 2 HAVING COUNT(DISTINCT sender_id) >= 5""", PLANTED_CTES)
ORACLE["near_threshold"] = W(f"""
SELECT sender_id, near_count, txn_count, {R('near_count', 'txn_count')} AS near_share
FROM (SELECT sender_id, COUNT(*) FILTER (WHERE amount_cents BETWEEN 950100 AND 999000) AS near_count,
             COUNT(*) AS txn_count FROM transactions GROUP BY 1)
WHERE near_count > 0""")
ORACLE["rule_risk_score"] = W(
    f"""
SELECT c.customer_id, c.jurisdiction_risk,
       {HU('''least(1.0::DOUBLE, COALESCE(CASE c.jurisdiction_risk WHEN 'low' THEN 0.1 WHEN 'medium' THEN 0.4
                                        WHEN 'high' THEN 0.7 END, 0.4)::DOUBLE * 0.5::DOUBLE
                     + 0.5::DOUBLE * (COALESCE(b.st, 0) / greatest(COALESCE(b.n, 0), 1))
                     + 0.5::DOUBLE * (COALESCE(b.nt, 0) / greatest(COALESCE(b.n, 0), 1)))''', 6)} AS rule_risk_score
FROM customers c LEFT JOIN (
    SELECT sender_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE structuring_flag) AS st,
           COUNT(*) FILTER (WHERE amount_cents BETWEEN 950100 AND 999000) AS nt
    FROM transactions GROUP BY 1
) b ON c.customer_id = b.sender_id"""
)

# --- graph --------------------------------------------------------------------------
G_CTES = """
ge AS (
    SELECT sender_id AS src, receiver_id AS dst, COUNT(*) AS weight, SUM(amount_cents) / 100.0::DOUBLE AS amount_usd,
           first(transaction_type ORDER BY "timestamp", transaction_id) AS transaction_type
    FROM transactions GROUP BY 1, 2
),
gn AS (
    SELECT node, first(is_suspicious ORDER BY "timestamp", transaction_id) AS is_suspicious
    FROM (SELECT sender_id AS node, "timestamp", transaction_id, is_suspicious FROM transactions
          UNION ALL SELECT receiver_id, "timestamp", transaction_id, is_suspicious FROM transactions)
    GROUP BY node
),
pairs AS (
    SELECT least(src, dst) AS u, greatest(src, dst) AS v, SUM(weight) AS weight FROM ge WHERE src != dst GROUP BY 1, 2
),
adj AS (SELECT u AS a, v AS b FROM pairs UNION ALL SELECT v, u FROM pairs)"""

CC_CTES = G_CTES + """,
reach(node, lab) AS (
    SELECT node, node FROM gn
    UNION SELECT adj.b, reach.lab FROM reach JOIN adj ON adj.a = reach.node
),
cc AS (SELECT node, MIN(lab) AS component FROM reach GROUP BY node)"""

ORACLE["graph_edges"] = W("SELECT * FROM ge", G_CTES)
ORACLE["graph_nodes"] = W("SELECT * FROM gn", G_CTES)
ORACLE["connected_components"] = W("SELECT * FROM cc", CC_CTES, recursive=True)
ORACLE["strong_components"] = W(
    """
SELECT gn.node, least(gn.node, COALESCE(MIN(r1.s), gn.node)) AS component
FROM gn LEFT JOIN dreach r1 ON r1.t = gn.node
        AND EXISTS (SELECT 1 FROM dreach r2 WHERE r2.s = gn.node AND r2.t = r1.s)
GROUP BY gn.node""",
    G_CTES
    + """,
de AS (SELECT DISTINCT src, dst FROM ge WHERE src != dst),
dreach(s, t) AS (SELECT src, dst FROM de UNION SELECT dreach.s, de.dst FROM dreach JOIN de ON de.src = dreach.t)""",
    recursive=True,
)
TRI_CTES = G_CTES + """,
deg AS (SELECT a AS node, COUNT(*) AS d FROM adj GROUP BY 1),
tri AS (
    SELECT p1.u AS a, p1.v AS b, p2.v AS c FROM pairs p1
    JOIN pairs p2 ON p1.u = p2.u AND p1.v < p2.v
    JOIN pairs p3 ON p3.u = p1.v AND p3.v = p2.v
),
per AS (SELECT node, COUNT(*) AS t FROM (SELECT a AS node FROM tri UNION ALL SELECT b FROM tri UNION ALL SELECT c FROM tri) GROUP BY 1),
clus AS (
    SELECT deg.node, deg.d AS degree, COALESCE(per.t, 0) AS triangles,
           CASE WHEN deg.d >= 2 THEN round(2.0::DOUBLE * COALESCE(per.t, 0) / (deg.d * (deg.d - 1)), 6) ELSE 0.0 END
               AS clustering
    FROM deg LEFT JOIN per ON deg.node = per.node
)"""
ORACLE["graph_clustering"] = W("SELECT * FROM clus", TRI_CTES)
ORACLE["graph_stats"] = W(
    """
SELECT (SELECT COUNT(*) FROM gn) AS num_nodes, (SELECT COUNT(*) FROM ge) AS num_edges,
       round((SELECT COUNT(*) FROM ge) / ((SELECT COUNT(*) FROM gn) * ((SELECT COUNT(*) FROM gn) - 1)), 9) AS density,
       round(COALESCE((SELECT SUM(clustering) FROM clus), 0.0) / (SELECT COUNT(*) FROM gn), 6) AS avg_clustering,
       (SELECT COUNT(*) FILTER (WHERE gnn_risk_score > 0.5) FROM risk WHERE customer_id IN (SELECT node FROM gn))
           AS high_risk_nodes""",
    TRI_CTES + "," + RISK_CTES,
)
ORACLE["ego_subgraph"] = W(
    """
SELECT h.node, h.hop, COALESCE(dg.degree, 0) AS degree
FROM (SELECT * FROM h0 UNION ALL SELECT * FROM h1 UNION ALL SELECT * FROM h2) h
LEFT JOIN dg ON h.node = dg.node
ORDER BY degree DESC, h.node LIMIT 150""",
    G_CTES
    + """,
allnodes AS (SELECT src AS node FROM ge UNION SELECT dst FROM ge),
h0 AS (SELECT node, 0 AS hop FROM allnodes WHERE node = 'CUST_000025'),
h1 AS (SELECT DISTINCT b AS node, 1 AS hop FROM adj WHERE a IN (SELECT node FROM h0) AND b NOT IN (SELECT node FROM h0)),
h2 AS (SELECT DISTINCT b AS node, 2 AS hop FROM adj WHERE a IN (SELECT node FROM h1)
       AND b NOT IN (SELECT node FROM h0 UNION SELECT node FROM h1)),
dg AS (
    SELECT node, CAST(SUM(k) AS BIGINT) AS degree FROM (
        SELECT src AS node, COUNT(*) AS k FROM ge GROUP BY 1 UNION ALL SELECT dst, COUNT(*) FROM ge GROUP BY 1
    ) GROUP BY node
)""",
)

NODE_SCALED_CTES = NODE_CTES + ",\nscaled AS (SELECT customer_id, " + ", ".join(
    f"({c} - (SELECT AVG({c}) FROM nodes)) / (SELECT CASE WHEN STDDEV_POP({c}) = 0 OR STDDEV_POP({c}) IS NULL "
    f"THEN 1.0 ELSE STDDEV_POP({c}) END FROM nodes) AS {c}"
    for c in NODE_COLS
) + " FROM nodes)"


def _prop_round(src: str, dst: str) -> str:
    sums = ", ".join(f"SUM(x.{c}) AS s_{c}" for c in NODE_COLS)
    outs = ", ".join(
        f"(n.{c} + COALESCE(m.s_{c}, 0.0)) / (greatest(COALESCE(m.k, 0), 1) + 1) AS {c}" for c in NODE_COLS
    )
    return f"""
{dst} AS (
    SELECT n.customer_id, {outs}
    FROM {src} n LEFT JOIN (
        SELECT t.receiver_id AS node, COUNT(*) AS k, {sums}
        FROM transactions t JOIN {src} x ON t.sender_id = x.customer_id GROUP BY 1
    ) m ON n.customer_id = m.node
)"""


ORACLE["propagated_features"] = W(
    "SELECT customer_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in NODE_COLS) + " FROM p2",
    NODE_SCALED_CTES + "," + _prop_round("scaled", "p1") + "," + _prop_round("p1", "p2"),
)
ORACLE["modularity"] = W(
    """
SELECT round(SUM(q), 6) AS modularity, COUNT(*) AS communities FROM (
    SELECT COALESCE(l.L, 0) / (SELECT SUM(weight) FROM pairs)
           - pow(COALESCE(dd.D, 0) / (2.0::DOUBLE * (SELECT SUM(weight) FROM pairs)), 2) AS q
    FROM (SELECT cu.component AS c, SUM(CASE WHEN cu.component = cv.component THEN p.weight ELSE 0 END) AS L
          FROM pairs p JOIN cc cu ON p.u = cu.node JOIN cc cv ON p.v = cv.node GROUP BY 1) l
    FULL JOIN (SELECT cc.component AS c, SUM(weight) AS D
               FROM (SELECT u AS node, weight FROM pairs UNION ALL SELECT v, weight FROM pairs) b
               JOIN cc ON b.node = cc.node GROUP BY 1) dd ON l.c = dd.c
)""",
    CC_CTES,
    recursive=True,
)

# --- SAR reports ---------------------------------------------------------------------
from ledgerscope.functions import constants as _K  # noqa: E402


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SAR_CTES = SCORE_CTES + "," + RISK_CTES + f""",
sus AS (
    SELECT c.*, COALESCE(r.gnn_risk_score, c.risk_score) AS gnn_risk_score, COALESCE(a.vae_score, 0.0) AS vae_score,
           0.5::DOUBLE * c.risk_score + 0.5::DOUBLE * COALESCE(r.gnn_risk_score, c.risk_score) AS combined_score
    FROM customers c LEFT JOIN risk r ON c.customer_id = r.customer_id
                     LEFT JOIN alerts a ON c.customer_id = a.customer_id
    ORDER BY combined_score DESC, c.customer_id LIMIT 200
),
prof AS (
    SELECT sender_id AS pid, {SUM_USD} AS total_amount, COUNT(*) AS txn_count,
           MIN("timestamp") AS min_date, MAX("timestamp") AS max_date,
           bool_or(structuring_flag) AS structuring, bool_or(is_suspicious) AS xb,
           COALESCE(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE label != 'normal'))), ', '), '')
               AS typologies
    FROM transactions WHERE sender_id IN (SELECT customer_id FROM sus) GROUP BY 1
),
gen AS (SELECT MAX("timestamp") AS g FROM transactions),
sb00 AS (
    SELECT 'SAR-' || upper(substr(sha256(s.customer_id || chr(1) || strftime(gen.g, '%Y-%m-%d')), 1, 16)) AS sar_id16,
           strftime(gen.g, '%Y-%m-%dT%H:%M:%S') || 'Z' AS generated_at,
           CASE WHEN s.combined_score > 0.85 THEN 'CRITICAL' WHEN s.combined_score > 0.65 THEN 'HIGH' ELSE 'MEDIUM' END
               AS priority,
           'template' AS llm_used, 'DRAFT' AS status,
           s.customer_id, s.account_type, s.country, s.risk_score, s.gnn_risk_score, s.vae_score, s.combined_score,
           COALESCE(p.typologies, '') AS typologies,
           COALESCE(p.total_amount, 0.0) AS total_flagged_amount_usd,
           COALESCE(p.txn_count, 0) AS flagged_transaction_count,
           COALESCE(strftime(p.min_date, '%Y-%m-%d'), 'N/A') AS date_range_start,
           COALESCE(strftime(p.max_date, '%Y-%m-%d'), 'N/A') AS date_range_end,
           COALESCE(p.structuring, FALSE) AS structuring_detected, COALESCE(p.xb, FALSE) AS cross_border
    FROM sus s CROSS JOIN gen LEFT JOIN prof p ON s.customer_id = p.pid
),
sb0 AS (
    SELECT sar_id16 AS sar_id,
           * EXCLUDE (sar_id16)
    FROM sb00
),
sb AS (
    SELECT *, printf({_q(_K.LONG_NARRATIVE_TEMPLATE)}, customer_id, flagged_transaction_count,
                     format('{{:,.2f}}', total_flagged_amount_usd),
                     CASE WHEN typologies = '' THEN {_q(_K.LONG_NARRATIVE_NO_TYPES)} ELSE typologies END,
                     {FMT('vae_score', 4)}, {FMT('gnn_risk_score', 4)}, 'Typologies: ' || typologies) AS narrative
    FROM sb0
),
ssum AS (
    SELECT sar_id, customer_id, priority, llm_used, total_flagged_amount_usd,
           flagged_transaction_count AS flagged_txn_count, gnn_risk_score, vae_score, typologies, status, generated_at
    FROM sb
)"""

ORACLE["top_suspects"] = W(
    "SELECT customer_id, name, country, jurisdiction_risk, account_type, onboard_date, risk_score, is_suspicious, "
    "annual_income_usd, pep, gnn_risk_score, vae_score, combined_score FROM sus",
    SAR_CTES,
)
ORACLE["sar_summary"] = W("SELECT * FROM ssum", SAR_CTES)
ORACLE["sar_narratives"] = W("SELECT sar_id, customer_id, llm_used, substr(narrative, 1, 500) AS narrative FROM sb", SAR_CTES)
ORACLE["sar_narratives_short"] = W(
    f"""
SELECT sar_id,
       'The filer reports suspicious activity by customer ' || customer_id || ' (' || account_type || ', ' || country || '). '
       || 'During ' || date_range_start || ' to ' || date_range_end || ', the subject executed '
       || CAST(flagged_transaction_count AS VARCHAR) || ' transactions totalling USD '
       || format('{{:,.2f}}', total_flagged_amount_usd) || '. '
       || 'Detected typologies: ' || CASE WHEN typologies = '' THEN {_q(_K.SHORT_NARRATIVE_NO_TYPES)} ELSE typologies END || '. '
       || CASE WHEN structuring_detected THEN {_q(_K.SHORT_NARRATIVE_STRUCTURING)} ELSE '' END
       || CASE WHEN cross_border THEN {_q(_K.SHORT_NARRATIVE_CROSS_BORDER)} ELSE '' END
       || 'AI anomaly score: ' || {FMT('vae_score', 4)} || ' (VAE), '
       || 'Graph risk score: ' || {FMT('gnn_risk_score', 4)} || ' (GNN), '
       || 'Customer risk rating: ' || {FMT('risk_score', 4)} || '. '
       || 'Filing made under 31 U.S.C. § 5318(g).' AS narrative
FROM sb""",
    SAR_CTES,
)
ORACLE["sar_filtered"] = W("SELECT * FROM ssum WHERE priority IN ('CRITICAL', 'HIGH')", SAR_CTES)
ORACLE["sar_lookup"] = W(
    """
SELECT sar_id, priority, customer_id, printf('[%-8s] %s  —  %s', priority, sar_id, customer_id) AS label,
       total_flagged_amount_usd
FROM sb ORDER BY CASE priority WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 ELSE 2 END, sar_id LIMIT 1""",
    SAR_CTES,
)
ORACLE["sar_kpis"] = W(
    """
SELECT COUNT(*) AS total_sars, COUNT(*) FILTER (WHERE priority = 'CRITICAL') AS critical,
       COUNT(*) FILTER (WHERE priority = 'HIGH') AS high, mode(llm_used) AS llm_engine
FROM ssum""",
    SAR_CTES,
)
ORACLE["engine_usage"] = W("SELECT llm_used AS engine, COUNT(*) AS reports FROM ssum GROUP BY 1", SAR_CTES)
ORACLE["command_center_kpis"] = W(
    f"""
SELECT COUNT(*) AS total_transactions, COUNT(*) FILTER (WHERE is_suspicious) AS alerts_triggered,
       {R('COUNT(*) FILTER (WHERE is_suspicious) * 100', 'COUNT(*)', 2)} AS flag_rate_pct,
       {SUM_USD} AS total_volume_usd,
       SUM(CASE WHEN is_suspicious THEN amount_cents ELSE 0 END) / 100.0::DOUBLE AS flagged_volume_usd,
       (SELECT COUNT(*) FROM ssum) AS total_sars,
       (SELECT COUNT(*) FILTER (WHERE priority = 'CRITICAL') FROM ssum) AS critical_sars
FROM transactions""",
    SAR_CTES,
)

# --- sampling -------------------------------------------------------------------------
ORACLE["sample_scatter"] = W("""
SELECT transaction_id, sender_id, receiver_id, amount_usd FROM transactions
ORDER BY md5(transaction_id || ':42') LIMIT 5000""")
ORACLE["balanced_sample"] = W("""
SELECT * FROM (SELECT transaction_id, is_suspicious, amount_usd FROM transactions WHERE is_suspicious
               ORDER BY md5(transaction_id || ':42') LIMIT 200)
UNION ALL
SELECT * FROM (SELECT transaction_id, is_suspicious, amount_usd FROM transactions WHERE NOT is_suspicious
               ORDER BY md5(transaction_id || ':42') LIMIT 200)""")
ORACLE["stratified_split"] = W("""
SELECT transaction_id, is_suspicious,
       CASE WHEN row_number() OVER (PARTITION BY is_suspicious ORDER BY md5(transaction_id || ':42'))
                 <= ceil(COUNT(*) OVER (PARTITION BY is_suspicious) * 0.15::DOUBLE) THEN 'test' ELSE 'train' END AS split
FROM transactions""")
ORACLE["stratified_split_3way"] = W("""
SELECT transaction_id, is_suspicious,
       CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + ceil((n - nt) * 0.15::DOUBLE) THEN 'val' ELSE 'train' END AS split
FROM (
    SELECT transaction_id, is_suspicious,
           row_number() OVER (PARTITION BY is_suspicious ORDER BY md5(transaction_id || ':42')) AS rk,
           COUNT(*) OVER (PARTITION BY is_suspicious) AS n,
           ceil(COUNT(*) OVER (PARTITION BY is_suspicious) * 0.2::DOUBLE) AS nt
    FROM transactions
)""")

# --- sources, sinks, validation, edges, correlation, graph view -----------------------
_REQ_COLS = ("transaction_id, \"timestamp\", sender_id, receiver_id, amount_usd, transaction_type, country_origin, "
             "country_dest, structuring_flag, round_amount, rapid_movement")
ORACLE["roundtrip_parquet"] = W("SELECT * FROM transactions")
ORACLE["roundtrip_csv"] = W("SELECT * FROM transactions")
ORACLE["roundtrip_json"] = W(f"SELECT {_REQ_COLS} FROM transactions")
ORACLE["score_json_batch"] = ORACLE["batch_scores"]
ORACLE["parse_records"] = W(f"SELECT {_REQ_COLS} FROM transactions")
ORACLE["validate_valid"] = W(f"""
SELECT {_REQ_COLS} FROM transactions
WHERE transaction_id IS NOT NULL AND sender_id IS NOT NULL AND receiver_id IS NOT NULL
  AND amount_usd IS NOT NULL AND amount_usd > 0""")
FLAWED_CTES = """
flawed AS (
    SELECT * REPLACE (
        CASE WHEN fault <> 0 THEN sender_id END AS sender_id,
        CASE WHEN fault = 1 THEN -amount_usd WHEN fault NOT IN (2, 3) THEN amount_usd END AS amount_usd,
        CASE WHEN fault NOT IN (0, 4) THEN receiver_id END AS receiver_id,
        CASE WHEN fault <> 3 THEN transaction_id END AS transaction_id)
    FROM (SELECT *, amount_cents % 97 AS fault FROM transactions)
)"""
ORACLE["validate_quarantine"] = W("""
SELECT transaction_id, broken_rules FROM (
    SELECT transaction_id, concat_ws('; ',
        CASE WHEN transaction_id IS NULL THEN 'transaction_id is required' END,
        CASE WHEN sender_id IS NULL THEN 'sender_id is required' END,
        CASE WHEN receiver_id IS NULL THEN 'receiver_id is required' END,
        CASE WHEN amount_usd IS NULL THEN 'amount_usd is required' END,
        CASE WHEN amount_usd <= 0 THEN 'amount_usd must be > 0' END) AS broken_rules
    FROM flawed
) WHERE broken_rules != ''""", FLAWED_CTES)
ORACLE["validate_flawed"] = W(f"""
SELECT {_REQ_COLS} FROM flawed
WHERE transaction_id IS NOT NULL AND sender_id IS NOT NULL AND receiver_id IS NOT NULL
  AND amount_usd IS NOT NULL AND amount_usd > 0""", FLAWED_CTES)
ORACLE["valid_edges"] = W(
    """
SELECT src, dst, weight FROM ge
WHERE src IN (SELECT customer_id FROM customers) AND dst IN (SELECT customer_id FROM customers)""",
    G_CTES,
)
ORACLE["orphan_edges"] = W(
    """
SELECT sender_id AS src, receiver_id AS dst, COUNT(*) AS weight FROM planted
WHERE sender_id NOT IN (SELECT customer_id FROM customers) OR receiver_id NOT IN (SELECT customer_id FROM customers)
GROUP BY 1, 2""",
    PLANTED_CTES,
)
_FC = ["amount_usd", "log_amount", "hour_of_day", "day_of_week", "is_cross_border", "round_amount",
       "rapid_movement", "structuring_flag", "amount_z_score_sender", "is_suspicious"]
ORACLE["feature_correlation"] = W(
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, "
        f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE round(corr({a}, {b}), 6) END AS correlation FROM fx"
        for i, a in enumerate(_FC)
        for b in _FC[:i]
    ),
    ZS_CTES
    + """,
fx AS (
    SELECT amount_usd, ln(1 + amount_usd) AS log_amount, hour("timestamp") / 23.0::DOUBLE AS hour_of_day,
           (isodow("timestamp") - 1) / 6.0::DOUBLE AS day_of_week,
           CAST(COALESCE(country_origin != country_dest, TRUE) AS DOUBLE) AS is_cross_border,
           CAST(round_amount AS DOUBLE) AS round_amount, CAST(rapid_movement AS DOUBLE) AS rapid_movement,
           CAST(structuring_flag AS DOUBLE) AS structuring_flag, amount_z_score_sender,
           CAST(is_suspicious AS DOUBLE) AS is_suspicious
    FROM tz
)""",
)
ORACLE["graph_view_nodes"] = W(
    """
SELECT d.node, d.degree, round(15.0::DOUBLE + 180 * d.degree / (SELECT MAX(degree) FROM dd), 6) AS node_size,
       COALESCE(r.gnn_risk_score, 0.15) AS colour_score
FROM dd d LEFT JOIN risk r ON d.node = r.customer_id""",
    RISK_CTES
    + """,
se AS (SELECT DISTINCT sender_id AS src, receiver_id AS dst FROM
       (SELECT * FROM transactions ORDER BY md5(transaction_id || ':42') LIMIT 1500)),
dd AS (
    SELECT node, CAST(SUM(k) AS BIGINT) AS degree FROM (
        SELECT src AS node, COUNT(*) AS k FROM se GROUP BY 1 UNION ALL SELECT dst, COUNT(*) FROM se GROUP BY 1
    ) GROUP BY node
)""",
)

# --- streaming (closed windows: end <= max event time - 1 hour) ---------------------
ORACLE["stream_velocity"] = """
SELECT user_id, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       COUNT(*) AS event_count, SUM(CAST(round(value * 100) AS BIGINT)) / 100.0::DOUBLE AS total_value
FROM events GROUP BY user_id, date_trunc('hour', ts)
HAVING COUNT(*) >= 2 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR"""
ORACLE["stream_structuring"] = """
SELECT user_id, ws AS window_start, ws + INTERVAL 24 HOUR AS window_end, COUNT(*) AS event_count
FROM (SELECT user_id, date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS ws FROM events, range(24) r(k))
GROUP BY user_id, ws
HAVING COUNT(*) >= 3 AND ws + INTERVAL 24 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR"""
ORACLE["stream_sessions"] = """
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end,
       COUNT(*) AS event_count, SUM(CAST(round(value * 100) AS BIGINT)) / 100.0::DOUBLE AS total_value
FROM (
    SELECT *, SUM(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid
    FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
)
GROUP BY user_id, sid
HAVING MAX(ts) + INTERVAL 30 MINUTE <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR"""
ORACLE["stream_dedup"] = "SELECT DISTINCT event_id, user_id, event_type, value, ts FROM events"
ORACLE["stream_scores"] = """
SELECT e.event_id, e.user_id, round(z, 6) AS z_score, round(abs(z) / 5.0, 6) AS anomaly_score
FROM (
    SELECT e.*, least(greatest(COALESCE((e.value - s.m) / greatest(s.sd, 1e-6), 0.0), -5.0), 5.0) AS z
    FROM events e LEFT JOIN (SELECT user_id, AVG(value) AS m, STDDEV_SAMP(value) AS sd FROM events GROUP BY 1) s
      ON e.user_id = s.user_id
) e"""
ORACLE["stream_sender_state"] = """
SELECT user_id, n, CAST((s * 20000 + n) // (2 * n) AS BIGINT) / 1e6::DOUBLE AS mean_value,
       round(sqrt(greatest((q - n * (s / n) * (s / n)) / (n - 1), 0.0)) / 100.0, 6) AS sd_value
FROM (SELECT user_id, COUNT(*) AS n, SUM(c) AS s, SUM(CAST(c AS DOUBLE) * c) AS q
      FROM (SELECT user_id, CAST(round(value * 100) AS BIGINT) AS c FROM events WHERE value IS NOT NULL)
      GROUP BY user_id)"""
ORACLE["stream_sender_state_expiring"] = """
SELECT user_id, state_start, expired_at, n, CAST((s * 20000 + n) // (2 * n) AS BIGINT) / 1e6::DOUBLE AS mean_value,
       CASE WHEN n > 1 THEN round(sqrt(greatest((q - n * (s / n) * (s / n)) / (n - 1), 0.0)) / 100.0, 6) END AS sd_value
FROM (
    SELECT user_id, MIN(ts) AS state_start, MAX(ts) + INTERVAL 6 HOUR AS expired_at, COUNT(*) AS n, SUM(c) AS s, SUM(CAST(c AS DOUBLE) * c) AS q
    FROM (
        SELECT *, SUM(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 6 HOUR THEN 1 ELSE 0 END)
                      OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid
        FROM (SELECT user_id, event_id, ts, CAST(round(value * 100) AS BIGINT) AS c,
                     lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
              FROM events WHERE value IS NOT NULL)
    )
    GROUP BY user_id, sid
)
WHERE expired_at <= (SELECT MAX(ts) FROM events WHERE value IS NOT NULL) - INTERVAL 1 HOUR"""
_REFUSED = "(SELECT * REPLACE (CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN -value ELSE value END AS value) FROM events)"
ORACLE["stream_alert_sink"] = f"SELECT event_id, user_id, event_type, value, ts FROM {_REFUSED} WHERE value > 0"
ORACLE["stream_quarantine_sink"] = f"SELECT event_id, user_id, event_type, value, ts FROM {_REFUSED} WHERE value IS NULL OR value <= 0"

ORACLE["stream_counters"] = """
SELECT CAST(0 AS BIGINT) AS batch_id, COUNT(*) AS events, COUNT(*) FILTER (WHERE value > 100) AS high_value FROM events"""

# --- reports and manifests, read back from their files ---
ORACLE["sar_reports_flat"] = W(
    f"""
SELECT b.sar_id, b.generated_at, b.priority, b.llm_used, b.status, {_q(_K.FILER_INSTITUTION_NAME)} AS institution_name,
       {_q(_K.FILER_EIN)} AS ein, {_q(_K.FILER_CONTACT)} AS contact, substr(b.generated_at, 1, 10) AS report_date,
       {_q(_K.FILER_FILING_TYPE)} AS filing_type, b.customer_id, s.name AS customer_name, s.country, s.jurisdiction_risk,
       s.account_type, s.annual_income_usd, s.pep, s.risk_score, s.gnn_risk_score, s.vae_score,
       b.typologies AS typologies_detected,
       CAST(CASE WHEN b.typologies = '' THEN 0 ELSE len(string_split(b.typologies, ', ')) END AS INTEGER) AS n_typologies,
       b.total_flagged_amount_usd, b.flagged_transaction_count, b.date_range_start, b.date_range_end,
       b.structuring_detected, b.cross_border, b.narrative AS activity_description
FROM sb b JOIN sus s ON b.customer_id = s.customer_id""",
    SAR_CTES,
)
ORACLE["detector_metadata_flat"] = f"""
SELECT t.threshold, {_K.FUSION_PRIMARY_WEIGHT}::DOUBLE AS primary_weight, {_K.FUSION_SECONDARY_WEIGHT}::DOUBLE AS secondary_weight,
       {_q(",".join(_K.TRANSACTION_FEATURES))} AS feature_names, c.cells AS confusion_cells
FROM ({ORACLE["anomaly_threshold"]}) t,
     (SELECT string_agg(true_label || '/' || pred_label || ':' || count, ',' ORDER BY true_label, pred_label) AS cells
      FROM ({ORACLE["confusion_matrix"]})) c"""
ORACLE["evaluation_report_fields"] = ORACLE["classification_metrics"]
_PRESET_KEYS = [
    "transaction_summary", "top_suspicious_customers", "daily_alert_trend", "typology_breakdown", "cross_border_corridors",
    "structuring_alerts", "hourly_velocity", "high_risk_network", "anomaly_flagged_customers",
]
ORACLE["preset_rows"] = " UNION ALL ".join(
    f"SELECT '{k}' AS preset, 'ok' AS status, (SELECT COUNT(*) FROM ({ORACLE[k]})) AS rows" for k in _PRESET_KEYS
)
ORACLE["manifest_rows"] = " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows FROM {t}"
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
)

# --- remaining surfaces -------------------------------------------------------------
ORACLE["adhoc_sql"] = W("""
SELECT c.jurisdiction_risk, t.transaction_type, COUNT(*) AS txn_count, SUM(t.amount_cents) / 100.0::DOUBLE AS total_usd
FROM transactions t JOIN customers c ON t.sender_id = c.customer_id
WHERE t.is_suspicious GROUP BY 1, 2""")
ORACLE["batch_counters"] = W(
    "SELECT COUNT(*) AS requests, COUNT(*) FILTER (WHERE is_suspicious) AS alerts FROM transactions"
)
_TYP = [("smurfing", "smurfing_windows"), ("round_trip_2", "round_trips_2"), ("round_trip_3", "round_trips_3"),
        ("rapid_movement", "rapid_movement"), ("tbml", "tbml_pairs"), ("fan_out", "fan_out"),
        ("near_threshold", "near_threshold")]
ORACLE["typology_alerts"] = " UNION ALL ".join(
    f"SELECT '{n}' AS typology, (SELECT COUNT(*) FROM ({ORACLE[k]})) AS alerts" for n, k in _TYP
)
_EGO = ORACLE["ego_subgraph"]
ORACLE["ego_edges"] = (
    _EGO[: _EGO.index("\nSELECT h.node, h.hop")].rstrip()
    + """,
ego AS (
    SELECT h.node FROM (SELECT * FROM h0 UNION ALL SELECT * FROM h1 UNION ALL SELECT * FROM h2) h
    LEFT JOIN dg ON h.node = dg.node ORDER BY COALESCE(dg.degree, 0) DESC, h.node LIMIT 150
)
SELECT src, dst, weight FROM ge WHERE src IN (SELECT node FROM ego) AND dst IN (SELECT node FROM ego)"""
)
ORACLE["shuffle_rows"] = W("SELECT transaction_id, amount_usd FROM transactions")
ORACLE["did_confidence"] = W("SELECT ate, se, ate_lower, ate_upper FROM did", DID_CTES)
ORACLE["cost_comparison"] = W(
    """
SELECT operating_point, tp AS true_positives, fp AS false_positives, fn AS false_negatives,
       fn * 100000.0::DOUBLE + fp * 500.0::DOUBLE AS total_cost_usd,
       fn * 100000.0::DOUBLE AS missed_laundering_cost_usd, fp * 500.0::DOUBLE AS false_alert_cost_usd,
       round((fn * 100000.0::DOUBLE + fp * 500.0::DOUBLE) / greatest(tp, 1), 6) AS cost_per_true_positive_usd
FROM (
    SELECT op AS operating_point,
           COUNT(*) FILTER (WHERE is_suspicious AND combined_score >= t) AS tp,
           COUNT(*) FILTER (WHERE NOT is_suspicious AND combined_score >= t) AS fp,
           COUNT(*) FILTER (WHERE is_suspicious AND NOT combined_score >= t) AS fn
    FROM (SELECT *, 'current' AS op, threshold AS t FROM scores_f
          UNION ALL SELECT *, 'lowered', threshold * 0.9::DOUBLE FROM scores_f)
    GROUP BY op
)""",
    SCORE_CTES,
)
ORACLE["metrics_from_matrix"] = ORACLE["classification_metrics"]
FX_CTES = ZS_CTES + """,
fx AS (
    SELECT transaction_id, amount_usd, ln(1 + amount_usd) AS log_amount, hour("timestamp") / 23.0::DOUBLE AS hour_of_day,
           (isodow("timestamp") - 1) / 6.0::DOUBLE AS day_of_week,
           CAST(COALESCE(country_origin != country_dest, TRUE) AS DOUBLE) AS is_cross_border,
           CAST(round_amount AS DOUBLE) AS round_amount, CAST(rapid_movement AS DOUBLE) AS rapid_movement,
           CAST(structuring_flag AS DOUBLE) AS structuring_flag, amount_z_score_sender
    FROM tz
)"""
ORACLE["feature_pipeline"] = W(
    "SELECT transaction_id, "
    + ", ".join(
        f"round(({c} - (SELECT AVG({c}) FROM fx)) / (SELECT CASE WHEN STDDEV_POP({c}) = 0 THEN 1.0 "
        f"ELSE STDDEV_POP({c}) END FROM fx), 6) AS {c}"
        for c in _FC[:-1]
    )
    + " FROM fx",
    FX_CTES,
)
ORACLE["saved_feature_pipeline"] = ORACLE["feature_pipeline"]

# --- fitted scaler (normal training rows) and high-risk clusters ----------------------
_F9 = _FC[:-1]
SCALER_CTES = FX_CTES + """,
sp AS (
    SELECT transaction_id, is_suspicious,
           CASE WHEN row_number() OVER (PARTITION BY is_suspicious ORDER BY md5(transaction_id || ':42'))
                     <= ceil(COUNT(*) OVER (PARTITION BY is_suspicious) * 0.15::DOUBLE) THEN 'test' ELSE 'train' END AS split
    FROM transactions
),
fr AS (SELECT fx.*, sp.is_suspicious, sp.split FROM fx JOIN sp ON fx.transaction_id = sp.transaction_id),
st AS (
    SELECT """ + ", ".join(
    f"AVG({c}) AS m_{c}, CASE WHEN STDDEV_POP({c}) = 0 OR STDDEV_POP({c}) IS NULL THEN 1.0 ELSE STDDEV_POP({c}) END AS s_{c}"
    for c in _F9
) + """
    FROM fr WHERE split = 'train' AND NOT is_suspicious
)"""
ORACLE["scaled_features"] = W(
    "SELECT fr.transaction_id, fr.is_suspicious, fr.split, "
    + ", ".join(f"round((fr.{c} - st.m_{c}) / st.s_{c}, 6) AS {c}" for c in _F9)
    + " FROM fr CROSS JOIN st",
    SCALER_CTES,
)
ORACLE["unscaled_features"] = W(
    "SELECT transaction_id, is_suspicious, split, " + ", ".join(f"round({c}, 6) AS {c}" for c in _F9) + " FROM fr",
    SCALER_CTES,
)
ORACLE["high_risk_clusters"] = W(
    "SELECT component AS cluster_id, node, COUNT(*) OVER (PARTITION BY component) AS cluster_size FROM hcc",
    FLAG_CTES
    + ","
    + RISK_CTES
    + ","
    + G_CTES
    + """,
hr AS (SELECT customer_id AS node FROM involved
       WHERE customer_id IN (SELECT customer_id FROM risk WHERE gnn_risk_score > 0.6)),
hp AS (
    SELECT DISTINCT least(src, dst) AS u, greatest(src, dst) AS v FROM ge
    WHERE src != dst AND src IN (SELECT node FROM hr) AND dst IN (SELECT node FROM hr)
),
hadj AS (SELECT u AS a, v AS b FROM hp UNION ALL SELECT v, u FROM hp),
hreach(node, lab) AS (
    SELECT node, node FROM hr
    UNION SELECT hadj.b, hreach.lab FROM hreach JOIN hadj ON hadj.a = hreach.node
),
hcc AS (SELECT node, MIN(lab) AS component FROM hreach GROUP BY node)""",
    recursive=True,
)
ORACLE["graph_component_counts"] = f"""
SELECT (SELECT COUNT(DISTINCT component) FROM ({ORACLE['connected_components']})) AS weak_components,
       (SELECT COUNT(DISTINCT component) FROM ({ORACLE['strong_components']})) AS strong_components"""
