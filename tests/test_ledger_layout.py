"""The written ledger is partitioned by quarter: same rows, and time filters skip files."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from ledgerscope.operators import presets as P
from ledgerscope.plans import registry as R
from ledgerscope.sources import ledger as L
from ledgerscope.sources.schemas import RAW


def test_same_rows_and_columns(spark, sf):
    plain = L.transactions(spark, sf)
    assert R.tx(spark, sf).schema.simpleString() == plain.schema.simpleString()
    assert R.tx(spark, sf).exceptAll(plain).isEmpty() and plain.exceptAll(R.tx(spark, sf)).isEmpty()


def test_trend_reads_the_quarters_of_its_window(spark, sf):
    quarterly = R.tx_quarterly(spark, sf)
    for as_of in (None, "1995-06-15"):
        pruned, whole = P.daily_alert_trend(quarterly, as_of=as_of), P.daily_alert_trend(quarterly.drop("txn_quarter"), as_of=as_of)
        assert pruned.collect() == whole.collect()
        out = io.StringIO()
        with redirect_stdout(out):
            pruned.explain("formatted")
        assert "PartitionFilters: [isnotnull(txn_quarter" in out.getvalue()
    assert 0 < len(set(quarterly.inputFiles())) and quarterly.select("txn_quarter").distinct().count() > 8


def test_names_and_ids_are_spelled_out_after_the_shuffles(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = io.StringIO()
        with redirect_stdout(out):
            L.with_quarter(L.transactions(spark, sf)).explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    carried = re.findall(r"\n\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", out.getvalue())
    assert len(carried) >= 4 and not [c for c in carried if "name#" in c or "country" in c or "transaction_id" in c]


def test_nations_of_missing_repeated_and_null_customers(spark, tmp_path):
    d = str(tmp_path)
    raw = lambda df, name: df.select(*[F.col(f.name).cast(f.dataType) for f in RAW[name].fields if f.name in df.columns]).write.parquet(f"{d}/{name}.parquet")
    raw(spark.createDataFrame([(1, "A"), (2, "B"), (2, "C")], "n_nationkey long, n_name string"), "nation")
    rows = [(3, 1), (3, 2), (7, None), (None, 1), (60, 1)]
    raw(spark.createDataFrame(rows, "c_custkey long, c_nationkey long"), "customer")
    raw(spark.sql("select * from values (1L, 3L, timestamp'2000-01-01'), (2L, 7L, timestamp'2000-01-01'), (3L, null, timestamp'2000-01-01') t(o_orderkey, o_custkey, o_orderdate)"), "orders")
    raw(spark.sql("select * from values (1L, 1, 3L, 4L, 1.0D, 'R'), (1L, 2, 3L, null, 1.0D, 'N'), (2L, 1, 1L, 2L, 1.0D, 'N'), (3L, 1, 1L, 2L, 1.0D, 'N'), (9L, 1, 1L, 2L, 1.0D, 'N') t(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag)"), "lineitem")
    got = sorted((str(r.receiver_id), str(r.country_origin), str(r.country_dest)) for r in L.transactions(spark, d).collect())
    own = ["A", "B", "C"]  # customer 3 comes twice, and one of its nations as well
    want = [("CUST_000007", c, "None") for c in own] + [("None", c, "None") for c in own] + [("CUST_000003", "None", c) for c in own] + [("None", "None", "None")]
    assert got == sorted(want)
