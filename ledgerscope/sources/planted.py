"""The ledger with planted patterns, and records with planted faults.

Derived from the tables like the ledger itself (``plans/oracle_base.py`` has the same in
DuckDB SQL), so that detectors and rules whose pattern the derived ledger never
shows have rows to find and rows to leave:

* layering chains of 2 to 5 hops, from every 40th order key: each hop 1 to 24 hours
  after the last, hop i carrying (0.90 to 0.99)^i of the first amount; in every fifth
  chain the last hop carries half of that, so it isn't one;
* 3 to 7 senders that pay one account on one day, for every 50th customer;
* a payment from an account that is no customer, for every 50th customer;
* records without an id, a sender or a receiver, or with no amount or one below zero;
* events that are sent again, and events with a negative value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.functions.money import idiv
from ledgerscope.sources.ledger import customer_key_to_id
from ledgerscope.sources.tables import read_raw

COLUMNS = ["transaction_id", "timestamp", "sender_id", "receiver_id", "amount_cents", "transaction_type"]


def _rows(df: DataFrame, ident: Column, day: Column, seconds: Column, sender: Column, receiver: Column, cents: Column) -> DataFrame:
    at = day + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return df.select(
        ident.alias("transaction_id"), at.alias("timestamp"), sender.alias("sender_id"), receiver.alias("receiver_id"),
        cents.cast("long").alias("amount_cents"), F.lit("WIRE_TRANSFER").alias("transaction_type"),
    )


def _text(prefix: str, *keys: Column) -> Column:
    return F.concat(F.lit(prefix), F.concat_ws("_", *[k.cast("string") for k in keys]))


def layering_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_raw(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp_ntz").alias("day"))
    key = F.col("o_orderkey")
    number = idiv(key, F.lit(40))
    o = o.filter(key % 40 == 0).withColumn("n", (number % 4 + 2).cast("int"))
    o = o.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    i = F.col("i")
    gaps = [F.when(i >= k, 3600 + (key * 31 + k * 7919) % 82801).otherwise(0) for k in range(1, 5)]
    seconds = (key % 24) * 3600 + sum(gaps[1:], gaps[0])
    block = idiv(F.col("o_custkey"), F.lit(50)) * 50
    account = lambda step: customer_key_to_id((block + (F.col("o_custkey") + step * 7) % 50).cast("long"))
    kept = (90 + (key * 17 + i * 23) % 10).cast("long")
    power = lambda x: F.when(i == 0, F.lit(1).cast("long")).when(i == 1, x).when(i == 2, x * x).when(i == 3, x * x * x).otherwise(x * x * x * x)
    hundred = power(F.lit(100).cast("long"))
    cents = idiv(2 * (10_000_000 + (key % 1000) * 12345) * power(kept) + hundred, hundred * 2)
    cents = F.when((number % 5 == 0) & (i == F.col("n") - 1), idiv(cents, F.lit(2))).otherwise(cents)
    return _rows(o, _text("PLT_", key, i), F.col("day"), seconds, account(i), account((i + 1) % F.col("n")), cents)


def fan_ins(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    c = read_raw(spark, sf_dir, "customer").select("c_custkey").filter(k % 50 == 7)
    block = idiv(k, F.lit(50))
    c = c.select("*", F.explode(F.sequence(F.lit(1), (3 + block % 5).cast("int"))).alias("j"))
    j = F.col("j")
    day = F.lit("1996-01-01").cast("timestamp_ntz")
    return _rows(c, _text("FAN_", k, j), day, (k % 1000) * 86400 + j * 3600, customer_key_to_id((block * 50 + (7 + j) % 50).cast("long")), customer_key_to_id(k), 100_000 + j * 1_000)


def outsiders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    c = read_raw(spark, sf_dir, "customer").select("c_custkey").filter(k % 50 == 11)
    return _rows(c, _text("EXT_", k), F.lit("1997-01-01").cast("timestamp_ntz"), (k % 1000) * 86400, _text("OUT_", k % 400), customer_key_to_id(k), 250_000 + k)


def planted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planted transfers, with the columns that detectors read."""
    out = layering_chains(spark, sf_dir).select(*COLUMNS)
    for part in (fan_ins, outsiders):
        out = out.unionByName(part(spark, sf_dir).select(*COLUMNS))
    return out


def planted_ledger(spark: SparkSession, sf_dir: str, txns: DataFrame) -> DataFrame:
    """``txns`` and the planted transfers."""
    return txns.select(*COLUMNS).unionByName(planted_rows(spark, sf_dir))


def flawed_records(records: DataFrame, cents: Column) -> DataFrame:
    """``records`` with every 97th amount's faults; ``cents`` picks them."""
    fault = cents % 97
    return records.withColumns(
        {
            "sender_id": F.when(fault != 0, F.col("sender_id")),
            "amount_usd": F.when(fault == 1, -F.col("amount_usd")).when(~fault.isin(2, 3), F.col("amount_usd")),
            "receiver_id": F.when(~fault.isin(0, 4), F.col("receiver_id")),
            "transaction_id": F.when(fault != 3, F.col("transaction_id")),
        }
    )


def resent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, each third one twice and each ninth one three times."""
    e = read_raw(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.withColumn("_again", F.explode(F.array_repeat(F.lit(0), (1 + (k % 3 == 0).cast("int") + (k % 9 == 0).cast("int"))))).drop("_again")


def refused_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which each eleventh lacks its value and each thirteenth has a negative one."""
    k = F.col("event_id")
    value = F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, -F.col("value")).otherwise(F.col("value"))
    return read_raw(spark, sf_dir, "events").withColumn("value", value)
