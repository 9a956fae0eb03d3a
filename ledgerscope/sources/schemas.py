"""Explicit schemas applied on read (no inference at scale)."""

from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("sender_id", T.StringType()),
        T.StructField("receiver_id", T.StringType()),
        T.StructField("amount_cents", T.LongType()),
        T.StructField("amount_usd", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("country_origin", T.StringType()),
        T.StructField("country_dest", T.StringType()),
        T.StructField("is_suspicious", T.BooleanType()),
        T.StructField("label", T.StringType()),
        T.StructField("structuring_flag", T.BooleanType()),
        T.StructField("round_amount", T.BooleanType()),
        T.StructField("rapid_movement", T.BooleanType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("jurisdiction_risk", T.StringType()),
        T.StructField("account_type", T.StringType()),
        T.StructField("onboard_date", T.DateType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("is_suspicious", T.BooleanType()),
        T.StructField("annual_income_usd", T.DoubleType()),
        T.StructField("pep", T.BooleanType()),
    ]
)

# One request record as the scoring surface accepts it (no truth columns).
TRANSACTION_REQUEST = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("sender_id", T.StringType()),
        T.StructField("receiver_id", T.StringType()),
        T.StructField("amount_usd", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("country_origin", T.StringType()),
        T.StructField("country_dest", T.StringType()),
        T.StructField("structuring_flag", T.BooleanType()),
        T.StructField("round_amount", T.BooleanType()),
        T.StructField("rapid_movement", T.BooleanType()),
    ]
)

CUSTOMER_RISK_SCORES = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("gnn_risk_score", T.DoubleType()),
        T.StructField("is_suspicious_true", T.LongType()),
    ]
)

# The driver's raw tables that the ledger is derived from.
RAW = {
    "lineitem": T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("l_partkey", T.LongType()),
            T.StructField("l_suppkey", T.LongType()),
            T.StructField("l_linenumber", T.IntegerType()),
            T.StructField("l_quantity", T.DoubleType()),
            T.StructField("l_extendedprice", T.DoubleType()),
            T.StructField("l_discount", T.DoubleType()),
            T.StructField("l_tax", T.DoubleType()),
            T.StructField("l_returnflag", T.StringType()),
            T.StructField("l_linestatus", T.StringType()),
            T.StructField("l_shipdate", T.TimestampNTZType()),
        ]
    ),
    "orders": T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.TimestampNTZType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    ),
    "customer": T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_nationkey", T.IntegerType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    ),
    "nation": T.StructType(
        [
            T.StructField("n_nationkey", T.IntegerType()),
            T.StructField("n_name", T.StringType()),
            T.StructField("n_regionkey", T.IntegerType()),
        ]
    ),
    "events": T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    ),
}
