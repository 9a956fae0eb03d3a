"""The ledger of transfers and the customer table, derived from the raw tables.

``transactions``: one transfer per line item. The sender is the order's
customer; the receiver is a customer in the sender's block of 50 keys, so the
graph has communities, components and cycles. Money is carried as integer
cents (``amount_cents``) so sums are exact in every engine; ``amount_usd`` is
``amount_cents / 100``.

Plan shape at scale: ``lineitem`` and ``orders`` are both fact-sized and meet in
one shuffle join on the order key; the sender's nation comes along with its order. The
receiver's nation is looked up in one more join of the still narrow rows, by block of
keys, which also lays a block's transfers together: later sums by account or by pair of
accounts find most of a group in one file. Names and ids are spelled out last, so no
shuffle carries them. ``nation`` (25 rows by the TPC-H definition) is the only side
broadcast by hand; AQE broadcasts others only when their measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and else splits a hot block of the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.functions.constants import NORMAL_LABEL, TRANSACTION_TYPES, TYPOLOGY_LABELS
from ledgerscope.sources.tables import read_raw


#: Keys in a block: a receiver lies in its sender's.
BLOCK = 50


def customer_key_to_id(col: Column) -> Column:
    """``CUST_`` and the key, padded to six digits; longer keys stay whole (a bare
    lpad would also cut them and merge accounts)."""
    key = col.cast("string")
    return F.concat(F.lit("CUST_"), F.when(F.length(key) < 6, F.lpad(key, 6, "0")).otherwise(key))


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 25 rows by definition of the schema: a bounded broadcast.
    return F.broadcast(read_raw(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))


def _nation_blocks(nations: DataFrame) -> DataFrame:
    """One row per block of keys: each customer key of the block -> the nation keys
    of its rows (one, unless the key repeats)."""
    per = nations.filter("c_custkey is not null").groupBy("c_custkey").agg(F.collect_list(F.struct("c_nationkey")).alias("_nk"))
    entry = F.struct("c_custkey", F.col("_nk.c_nationkey").alias("_nk"))
    return per.groupBy(F.floor(F.col("c_custkey") / BLOCK).alias("_block")).agg(F.map_from_entries(F.collect_list(entry)).alias("_blk"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_raw(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("_price_cents"),
        (F.col("l_returnflag") == "R").alias("_returned"),
    )
    nations = read_raw(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = read_raw(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    orders = orders.join(
        nations.select(F.col("c_custkey").alias("_s_ck"), F.col("c_nationkey").alias("_s_nk")), F.col("o_custkey") == F.col("_s_ck"), "left"
    ).drop("_s_ck")
    base = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner").drop("l_orderkey")
    r_key = F.floor(F.col("o_custkey") / BLOCK) * BLOCK + (F.col("l_partkey") + F.col("l_suppkey")) % BLOCK
    base = base.withColumn("_r_key", r_key.cast("bigint")).withColumn("_block", F.floor(F.col("_r_key") / BLOCK))
    t = base.join(_nation_blocks(nations), "_block", "left").select("*", F.explode_outer(F.col("_blk")[F.col("_r_key")]).alias("_r_nk"))
    # 25 rows by definition of the schema: bounded broadcasts
    nation = read_raw(spark, sf_dir, "nation")
    for side, name in (("_s_nk", "country_origin"), ("_r_nk", "country_dest")):
        key = f"{side}_key"
        t = t.join(F.broadcast(nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))), F.col(side) == F.col(key), "left")

    amount_cents = F.floor(F.col("_price_cents") / 5).cast("bigint")
    ttype = F.element_at(
        F.array(*[F.lit(x) for x in TRANSACTION_TYPES]), (F.pmod(F.col("l_partkey"), F.lit(8)) + 1).cast("int")
    )
    suspicious = F.col("_returned") & (F.col("o_custkey") % 25 == 0)
    typ_idx = F.pmod(F.floor(F.col("o_custkey") / 25), F.lit(3))
    label = F.when(~suspicious, F.lit(NORMAL_LABEL))
    for i, name in enumerate(TYPOLOGY_LABELS):
        label = label.when(typ_idx == i, F.lit(name))
    offset_s = (F.col("o_orderkey") % 24) * 3600 + (F.col("l_linenumber") * 521 + F.col("l_partkey")) % 3600
    ts = F.timestamp_add("SECOND", offset_s, F.col("o_orderdate"))

    out = t.select(
        F.concat(
            F.lit("TXN_"),
            F.col("o_orderkey"),
            F.lit("_"),
            F.col("l_linenumber"),
            F.lit("_"),
            F.col("l_partkey"),
            F.lit("_"),
            F.col("l_suppkey"),
            F.lit("_"),
            F.col("_price_cents"),
        ).alias("transaction_id"),
        ts.alias("timestamp"),
        customer_key_to_id(F.col("o_custkey")).alias("sender_id"),
        customer_key_to_id(F.col("_r_key")).alias("receiver_id"),
        amount_cents.alias("amount_cents"),
        (amount_cents / F.lit(100.0)).alias("amount_usd"),
        ttype.alias("transaction_type"),
        "country_origin",
        "country_dest",
        suspicious.alias("is_suspicious"),
        label.alias("label"),
        (
            amount_cents.between(500000, 999999)
            & ttype.isin("CASH_DEPOSIT", "WIRE_TRANSFER", "ACH")
        ).alias("structuring_flag"),
        (amount_cents % 10000 == 0).alias("round_amount"),
        ((label == "layering") & (F.col("l_linenumber") <= 2)).alias("rapid_movement"),
    )
    return out


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_raw(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    nat = _nation(spark, sf_dir)
    c = cust.join(nat, cust.c_nationkey == nat.n_nationkey, "left")
    k = F.col("c_custkey")
    rk = F.col("n_regionkey")
    jur = F.when(rk.isin(0, 1, 2), "low").when(rk == 3, "medium").when(rk == 4, "high")
    acct = F.when(k % 20 <= 13, "retail").when(k % 20 <= 18, "corporate").otherwise("correspondent")
    return c.select(
        customer_key_to_id(k).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("country"),
        jur.alias("jurisdiction_risk"),
        acct.alias("account_type"),
        F.date_add(F.lit("1990-01-01").cast("date"), (k % 1500).cast("int")).alias("onboard_date"),
        (((k * 7919) % 10000) / F.lit(10000.0)).alias("risk_score"),
        (k % 25 == 0).alias("is_suspicious"),
        ((F.round(F.col("c_acctbal") * 100).cast("bigint") + 100000) * 10 / F.lit(100.0)).alias("annual_income_usd"),
        (k % 50 == 0).alias("pep"),
    )


def transaction_edges(txns: DataFrame) -> DataFrame:
    """Edge-table projection (source, destination, amount, truth)."""
    return txns.select(
        F.col("sender_id").alias("source_id"),
        F.col("receiver_id").alias("dest_id"),
        "amount_usd",
        "is_suspicious",
    )


def quarter_text(ts: Column) -> Column:
    """``yyyy-Qn``, in the order of time."""
    return F.concat(F.date_format(ts, "yyyy"), F.lit("-Q"), F.quarter(ts))


def with_quarter(txns: DataFrame) -> DataFrame:
    """Adds ``txn_quarter``, by which the written ledger is partitioned: a trailing
    window of 90 days reads two quarters at most, and a short history stays in few files."""
    return txns.withColumn("txn_quarter", quarter_text(F.col("timestamp")))


def materialize_ledger(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, str]:
    """Write the derived ledger once, partitioned by quarter so time filters prune
    files, and the customer table beside it."""
    from ledgerscope.sources.tables import safe_write_parquet

    tp = safe_write_parquet(with_quarter(transactions(spark, sf_dir)), f"{out_dir}/transactions", ["txn_quarter"])
    cp = safe_write_parquet(customers(spark, sf_dir), f"{out_dir}/customers")
    return {"transactions": tp, "customers": cp}
