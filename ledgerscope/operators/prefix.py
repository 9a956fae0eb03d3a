"""Global running totals and dense indexes without a single-task window.

``Window.orderBy(x)`` with no partition moves every row to one task. Here the
rows are range-partitioned and sorted by the whole order key, so neither a common
prefix of the keys nor many rows with one leading value fill a task; each task adds
up its rows as they stream past (Arrow batches, one number carried per column), and
the totals of the partitions (one row each) become offsets that are added back:
one shuffle in all. The result of the tasks is checkpointed, because range bounds
are sampled anew by every execution, and a retried task must see the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.session import cut_lineage


def _parts(df: DataFrame, n: int | None) -> int:
    return n or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 2)


def prefix_sums(
    df: DataFrame,
    order: list[Column],
    values: list[str],
    suffix: str = "_cum",
    n_partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``values`` (whole numbers; null adds nothing) in the
    total order ``order`` (unique per row; columns may be descending)."""
    at = [df.columns.index(v) for v in values]
    names = [*df.columns, *[f"_{v}_loc" for v in values], "_pid"]

    def running(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        pid, carry = TaskContext.get().partitionId(), [0] * len(at)
        for b in batches:
            if not b.num_rows:
                continue
            sums = [np.cumsum(np.asarray(pc.fill_null(b.column(i), 0), dtype=np.int64)) + c for i, c in zip(at, carry)]
            carry = [int(s[-1]) for s in sums]
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, sums), pa.array(np.full(b.num_rows, pid, np.int32))], names=names)

    local = [T.StructField(f"_{v}_loc", T.LongType()) for v in values]
    schema = T.StructType([*df.schema.fields, *local, T.StructField("_pid", T.IntegerType())])
    ranged = df.repartitionByRange(_parts(df, n_partitions), *order).sortWithinPartitions(*order)
    b = cut_lineage(ranged.mapInArrow(running, schema))
    totals = b.groupBy("_pid").agg(*[F.sum(v).alias(f"_{v}_tot") for v in values])
    wo = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_{v}_tot").over(wo), F.lit(0)).alias(f"_{v}_off") for v in values])
    j = b.join(F.broadcast(offsets), "_pid", "left")  # one row per partition
    return j.select(
        *df.columns,
        *[(F.col(f"_{v}_loc") + F.coalesce(F.col(f"_{v}_off"), F.lit(0))).alias(f"{v}{suffix}") for v in values],
    )


def dense_index(df: DataFrame, key: str, name: str = "idx", n_partitions: int | None = None) -> DataFrame:
    """Map each distinct ``key`` to 0..k-1 in sorted key order."""
    keys = df.select(key).distinct().withColumn("_one", F.lit(1))
    cum = prefix_sums(keys, [F.col(key)], ["_one"], n_partitions=n_partitions)
    return cum.select(key, (F.col("_one_cum") - 1).cast("long").alias(name))
