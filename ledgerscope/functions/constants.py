"""Fixed values that results depend on.

These are domain constants (type lists, rule thresholds, weights and the text
of report templates). They are stated once here, in their natural order, and
imported everywhere else.
"""

# --- fixed values: ledger vocabulary -------------------------------------------------
TRANSACTION_TYPES = [
    "WIRE_TRANSFER",
    "ACH",
    "CASH_DEPOSIT",
    "CASH_WITHDRAWAL",
    "TRADE_PAYMENT",
    "INTERNAL_TRANSFER",
    "CRYPTO_EXCHANGE",
    "CHECK",
]
TYPOLOGY_LABELS = ["structuring", "layering", "tbml"]
NORMAL_LABEL = "normal"
JURISDICTION_LEVELS = ["low", "medium", "high"]

# --- fixed values: features ----------------------------------------------------------
TRANSACTION_FEATURES = [
    "amount_usd",
    "log_amount",
    "hour_of_day",
    "day_of_week",
    "is_cross_border",
    "round_amount",
    "rapid_movement",
    "structuring_flag",
    "amount_z_score_sender",
]
NODE_FEATURES = [
    "degree",
    "total_amount",
    "unique_counterparties",
    "risk_score",
    "jurisdiction_risk",
    "avg_txn_amount",
    "txn_count",
]
ZSCORE_CLIP = 5.0
ZSCORE_SD_FLOOR = 1e-6

# --- fixed values: rules and thresholds ----------------------------------------------
SAR_THRESHOLD_USD = 10_000.0
STRUCTURING_MIN_COUNT = 3
VELOCITY_MIN_COUNT = 5
ALERT_LEVEL_MULTIPLIERS = [("CRITICAL", 3.0), ("HIGH", 1.5), ("MEDIUM", 1.0)]
CUSTOMER_RISK_BANDS = [("HIGH", 0.7), ("MEDIUM", 0.4)]
SAR_PRIORITY_BANDS = [("CRITICAL", 0.85), ("HIGH", 0.65)]
SAR_TOP_N = 200
ANOMALY_PERCENTILE = 0.95
FUSION_PRIMARY_WEIGHT = 0.6
FUSION_SECONDARY_WEIGHT = 0.4
NORMALISE_EPS = 1e-9
GRAPH_RISK_NETWORK_MIN = 0.5
GRAPH_RISK_CLUSTER_MIN = 0.6
HIGH_RISK_MIN = 0.7
COST_FALSE_NEGATIVE_USD = 100_000.0
COST_FALSE_POSITIVE_USD = 500.0
MIN_RECALL = 0.90
JURISDICTION_BASE_RISK = {"low": 0.1, "medium": 0.4, "high": 0.7}

# --- fixed values: batch risk assessment ---------------------------------------------
BATCH_RISK_LEVELS = [
    (
        "CRITICAL",
        0.75,
        "Immediate escalation to Chief Compliance Officer. "
        "Freeze implicated accounts pending investigation. "
        "File SAR with FinCEN within 30 days. Notify BSA officer.",
    ),
    (
        "HIGH",
        0.50,
        "Priority review by senior AML analyst within 24 hours. "
        "Enhanced due diligence (EDD) required. SAR filing recommended.",
    ),
    (
        "MEDIUM",
        0.25,
        "Schedule analyst review within 5 business days. "
        "Document findings. Continue enhanced monitoring.",
    ),
    ("LOW", 0.0, "Standard automated monitoring. No immediate action required."),
]

# --- fixed values: SAR filer block ---------------------------------------------------
FILER_INSTITUTION_NAME = "Acme Financial Services Inc."
FILER_EIN = "12-3456789"
FILER_CONTACT = "AML Compliance | aml@acmefs.com | +1-800-555-0100"
FILER_FILING_TYPE = "INITIAL"
SAR_STATUS = "DRAFT"
NARRATIVE_ENGINE = "template"

# --- fixed values: narrative templates (printf style, see operators/sar.py) ----------
LONG_NARRATIVE_TEMPLATE = (
    "The filer is reporting suspicious financial activity associated with account "
    "%s. Between the dates referenced herein, this account conducted "
    "%d transactions totalling USD %s via %s. "
    "AI-based anomaly detection flagged this account with a Variational Autoencoder "
    "reconstruction score of %s and a Graph Neural Network risk score "
    "of %s, both indicating materially elevated risk. "
    "Network analysis findings: %s "
    "The pattern of activity is consistent with layering and/or structuring under "
    "the Bank Secrecy Act. The filer recommends enhanced due diligence and has "
    "preserved all relevant transaction records. This SAR is filed voluntarily "
    "and in good faith pursuant to 31 U.S.C. § 5318(g) and FinCEN guidance. "
    "The filer requests confidentiality as provided by law."
)
LONG_NARRATIVE_NO_TYPES = "various transaction types"
SHORT_NARRATIVE_NO_TYPES = "anomalous patterns"
SHORT_NARRATIVE_STRUCTURING = "Structuring below $10,000 threshold observed. "
SHORT_NARRATIVE_CROSS_BORDER = "Cross-border transactions to high-risk jurisdictions identified. "

# --- fixed values: country code -> jurisdiction risk (unknown codes are "medium") ----
JURISDICTION_COUNTRIES = {
    "low": ["US", "UK", "DE", "JP", "AU"],
    "medium": ["MX", "BR", "ZA", "IN", "TH"],
    "high": ["PA", "KY", "BZ", "VU", "LB"],
}
JURISDICTION_ORDINAL = {"low": 0, "medium": 1, "high": 2}
