"""Running sums within keys over a range-sorted table, without a task that sees them all.

Rows are range-partitioned by (keys, order) and sorted, so a hot key spreads
over as many partitions as its rows need; each partition adds up its own rows;
the totals of each partition and key (a few rows a partition) give the offsets.
The sorted table is written once, because the range bounds are sampled anew by
every execution.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.llm.common import map_arrow, written


def running_sums(df: DataFrame, key: str, order: list[str], value: str, before: str = "before") -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the rows of the same ``key``
    (null is a key) that come earlier by ``order``. ``order`` must be total;
    equal rows may share places in any order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ordered = df.repartitionByRange(n, key, *order).sortWithinPartitions(key, *order)
    names = df.columns

    def run(batches):
        from pyspark import TaskContext

        pid, last, carry = TaskContext.get().partitionId(), (None, False), 0
        for b in batches:
            if not b.num_rows:
                continue
            v = np.asarray(pc.fill_null(b.column(names.index(value)), 0), dtype=np.int64)
            code = np.asarray(pc.fill_null(b.column(names.index(key)).dictionary_encode(null_encoding="encode").indices, -1))
            new = np.concatenate([[True], code[1:] != code[:-1]])
            k = b.column(names.index(key))
            if last == (k[0].as_py(), True):
                new[0] = False
            total = np.cumsum(v) - v
            starts = np.flatnonzero(new)
            base = np.full(len(v), -carry, np.int64)  # rows of the key carried over
            if len(starts):
                run_no = np.cumsum(new) - 1
                base = np.where(run_no >= 0, total[starts][np.maximum(run_no, 0)], -carry)
            local = total - base
            last, carry = (k[b.num_rows - 1].as_py(), True), int(local[-1] + v[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(local), pa.array(np.full(len(v), pid, np.int32))], names=[*names, "_local", "_pid"])

    schema = T.StructType([*df.schema.fields, T.StructField("_local", T.LongType()), T.StructField("_pid", T.IntegerType())])
    local = written(map_arrow(ordered, run, schema), "sorted")
    totals = local.groupBy("_pid", key).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_pid").alias("_opid"), F.col(key).alias("_okey"), F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_off"))
    both = local.join(offsets, (F.col("_pid") == F.col("_opid")) & F.col(key).eqNullSafe(F.col("_okey")), "left")
    return both.select(*names, (F.col("_local") + F.coalesce("_off", F.lit(0))).alias(before))
