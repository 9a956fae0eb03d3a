"""Groups of rows with one key, streamed through tasks in blocks of bounded size.

A bucket of a hash table can hold any number of rows. Buckets beyond ``block``
rows are cut into blocks by a hash of the row's id, and every pair of blocks
becomes a run of its own, so that a task holds two blocks at a time and a hot
bucket spreads over many tasks. Runs come out of one shuffle and sort.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 2048


def into_runs(rows: DataFrame, keys: list[str], ident: str, block: int = BLOCK, carry: DataFrame | None = None) -> DataFrame:
    """``rows`` with the columns run (long), side (0 or 1) and whole (boolean).

    Buckets of one row are left out: they hold no pair. In a run that isn't
    ``whole``, only pairs of unequal ``side`` belong to it. ``carry`` has further
    columns by ``ident``, joined once the single rows are gone.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    j = rows.join(counts, keys)
    if carry is not None:
        j = j.join(carry, ident)
    blocks = F.ceil(F.col("_n") / block).cast("int")
    own = F.pmod(F.xxhash64(F.lit(7), F.col(ident)), blocks).cast("int")
    j = j.withColumn("_b", own).withColumn("_o", F.explode(F.sequence(F.lit(0), blocks - 1)))
    lo, hi = F.least("_b", "_o"), F.greatest("_b", "_o")
    j = j.withColumn("run", F.xxhash64(*keys, lo, hi)).withColumn("side", (F.col("_b") == hi).cast("int")).withColumn("whole", lo == hi)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return j.drop("_n", "_b", "_o").repartition(n, "run").sortWithinPartitions("run")


def whole_runs(batches: Iterator[pa.RecordBatch], least: int = 1 << 16) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete runs, with each row's run number; sorted by ``run``."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def out(t: pa.Table):
        run = np.asarray(t["run"])
        return t, np.cumsum(np.concatenate([[0], run[1:] != run[:-1]]))

    for b in batches:
        if not b.num_rows:
            continue
        run = np.asarray(b.column(b.schema.get_field_index("run")))
        held.append(b)
        rows += b.num_rows
        cut = int(np.searchsorted(run, run[-1]))
        if rows < least or cut == 0:
            continue
        tail = held.pop()
        if cut:
            held.append(tail.slice(0, cut))
        yield out(pa.Table.from_batches(held))
        held, rows = [tail.slice(cut)], tail.num_rows - cut
    if held:
        yield out(pa.Table.from_batches(held))


class Sets:
    """Disjoint sets of 0..n-1; the smallest member names a set."""

    def __init__(self, n: int):
        self.top = np.arange(n)

    def flat(self) -> np.ndarray:
        while True:
            up = self.top[self.top]
            if (up == self.top).all():
                return up
            self.top = up

    def find(self, x: int) -> int:
        while self.top[x] != x:
            self.top[x] = self.top[self.top[x]]
            x = int(self.top[x])
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            x, y = self.find(x), self.find(y)
            if x != y:
                self.top[max(x, y)] = min(x, y)
