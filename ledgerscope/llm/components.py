"""Connected components of a links table, by alternating star contraction.

Each round hangs every node's larger neighbours on its smallest one (large
star), then its smaller neighbours (small star); the number of links never
grows and rounds are logarithmic in the longest path. A node's links are summed
up before they are shuffled; joins on a hot node can be split by the optimizer.
Every round is written to the shared folder and read back, so lost executors
reread it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) of every node in the
    links (columns a, b; long). Self links and repeats are harmless."""
    e = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    e = written(e, "links")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        large = both.filter("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.least("m", F.col("n")).alias("b")).distinct()
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        e = written(small.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct(), "links")
        seen = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == (seen["n"], seen["h"]):
            break
        state = (seen["n"], seen["h"])
    # e: stars, each node linked to its smallest
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
