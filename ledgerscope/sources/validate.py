"""Record parsing and rule validation as whole-table jobs.

Valid rows continue; broken rows go to a quarantine table with the list of
rules they break. Nothing is raised per row and nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.sources.schemas import TRANSACTION_REQUEST

DEFAULT_TIMESTAMP = "2024-01-01 00:00:00"
FLAGS = ["structuring_flag", "round_amount", "rapid_movement"]
REQUIRED = ["transaction_id", "sender_id", "receiver_id", "amount_usd"]


def to_records(txns: DataFrame) -> DataFrame:
    """The ledger as JSON request records (one text value per row)."""
    return txns.select(
        F.to_json(
            F.struct(
                "transaction_id",
                F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
                "sender_id", "receiver_id", "amount_usd", "transaction_type", "country_origin", "country_dest",
                *FLAGS,
            )
        ).alias("record")
    )


def parse_records(records: DataFrame, col: str = "record") -> DataFrame:
    """JSON text -> typed rows; a missing or unparsable timestamp becomes the
    fixed default; missing flags become False. A generator gives the fields: a filter on
    them (``validate_valid``) moves below a projection and would then parse the text
    once for every field it names."""
    r = records.select(F.inline(F.array(F.from_json(F.col(col), TRANSACTION_REQUEST))))
    ts = F.coalesce(F.col("timestamp").try_cast("timestamp_ntz"), F.lit(DEFAULT_TIMESTAMP).cast("timestamp_ntz"))
    return r.select(
        "transaction_id", ts.alias("timestamp"), "sender_id", "receiver_id", "amount_usd", "transaction_type",
        "country_origin", "country_dest", *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in FLAGS],
    )


def broken_rules(df: DataFrame) -> DataFrame:
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c} is required")) for c in REQUIRED]
    checks.append(F.when(F.col("amount_usd") <= 0, F.lit("amount_usd must be > 0")))
    return df.withColumn("_broken", F.array_compact(F.array(*checks)))


def validate_valid(df: DataFrame) -> DataFrame:
    b = broken_rules(df)
    return b.filter(F.size("_broken") == 0).drop("_broken").select(
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) if c in FLAGS else F.col(c) for c in df.columns]
    )


def validate_quarantine(df: DataFrame) -> DataFrame:
    b = broken_rules(df)
    return b.filter(F.size("_broken") > 0).select("transaction_id", F.array_join("_broken", "; ").alias("broken_rules"))
