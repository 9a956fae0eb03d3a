"""Reproducible sampling and splitting.

Rows are ranked by md5(id || ':' || seed): stable across partitioning and
file order, and computable in any SQL engine. Fixed-size samples are
distributed top-k (``TakeOrderedAndProject``: each partition keeps k rows);
exact stratified splits rank rows inside their class with the bucketed
prefix count, so the big class never sits in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.functions.quantile import order_statistics
from ledgerscope.operators.prefix import prefix_sums
from ledgerscope.session import cut_lineage


def hash_key(id_col: str, seed: int):
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def sample_n(df: DataFrame, n: int, id_col: str = "transaction_id", seed: int = 42) -> DataFrame:
    return df.withColumn("_h", hash_key(id_col, seed)).orderBy("_h").limit(n).drop("_h")


def shuffle_rows(df: DataFrame, id_col: str = "transaction_id", seed: int = 42) -> DataFrame:
    """All rows in hash order: a distributed range sort, no limit."""
    return df.withColumn("_h", hash_key(id_col, seed)).orderBy("_h").drop("_h")


def balanced_sample(df: DataFrame, class_col: str, per_class: dict, id_col: str = "transaction_id", seed: int = 42) -> DataFrame:
    """Fixed counts per class (classes and counts are given, so bounded)."""
    out = None
    for value, n in per_class.items():
        part = sample_n(df.filter(F.col(class_col) == F.lit(value)), n, id_col, seed)
        out = part if out is None else out.unionByName(part)
    return out


def hash_place(id_col: str = "transaction_id", seed: int = 42) -> Column:
    """The first 60 bits of ``hash_key``, in its order."""
    return F.conv(F.substring(hash_key(id_col, seed), 1, 15), 16, 10).cast("long")


def _class_ranks(df: DataFrame, class_col: str, classes: list, id_col: str, seed: int) -> DataFrame:
    h = hash_key(id_col, seed)
    base = df.select(
        id_col, class_col, h.alias("_h"),
        hash_place(id_col, seed).alias("_hn"),
        *[(F.col(class_col) == F.lit(c)).cast("long").alias(f"_c{i}") for i, c in enumerate(classes)],
    )
    cum = prefix_sums(base, [F.col("_hn"), F.col("_h"), F.col(id_col)], [f"_c{i}" for i in range(len(classes))])
    rank = None
    for i, c in enumerate(classes):
        e = F.when(F.col(class_col) == F.lit(c), F.col(f"_c{i}_cum"))
        rank = e if rank is None else F.coalesce(rank, e)
    # one row per declared class: a bounded broadcast
    sizes = (
        df.filter(F.col(class_col).isin(*classes))
        .groupBy(F.col(class_col).alias("_k"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return cum.select(id_col, class_col, rank.alias("_rank")).join(F.broadcast(sizes), F.col(class_col) == F.col("_k")).drop("_k")


def stratified_split(df: DataFrame, class_col: str = "is_suspicious", classes=(False, True), test_frac: float = 0.15,
                     id_col: str = "transaction_id", seed: int = 42) -> DataFrame:
    """Exact per-class test share: the first ceil(test_frac x n_class) rows of
    each class in hash order are 'test'."""
    r = _class_ranks(df, class_col, list(classes), id_col, seed)
    return r.select(
        id_col, class_col,
        F.when(F.col("_rank") <= F.ceil(F.col("_n") * F.lit(test_frac)), F.lit("test")).otherwise(F.lit("train")).alias("split"),
    )


def with_split(rows: DataFrame, places: DataFrame, class_col: str = "is_suspicious", classes=(False, True), test_frac: float = 0.15,
               id_col: str = "transaction_id", seed: int = 42, carried: Sequence[str] = ()) -> DataFrame:
    """What joining ``rows`` with their own ``stratified_split`` by id gives, without ranking
    or joining the rows: the last place of the test rows of each class is selected by
    counts, and each row compares its own. Only ids that come again are joined, each copy
    with each. ``rows`` carry ``_place`` (``hash_place``); ``places`` has each row's class
    and place, written, since it is read several times. ``carried`` columns are what one more
    join by id would bring: of an id that comes again, those of each copy."""
    known = places.filter(F.col(class_col).isin(*classes))
    size = {r[0]: (r["n"], r["n"] - r["placed"]) for r in known.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"), F.count("_place").alias("placed")).collect()}
    # of each class, the test rows that have an id (those without one are first in hash order)
    test = {c: math.ceil(n * test_frac) - null for c, (n, null) in size.items()}
    last = order_statistics(known, F.col("_place"), lambda c, n: min(test[c], n) - 1, F.col(class_col))
    border = F.lit(-1).cast("long")
    for c, (at, _, _) in last.items():
        border = F.when(F.col(class_col) == F.lit(c), F.lit(at).cast("long")).otherwise(border)
    side = F.when(F.col("_place") <= border, F.lit("test")).otherwise(F.lit("train"))
    placed = rows.filter(F.col("_place").isNotNull())
    again = cut_lineage(places.filter(F.col("_place").isNotNull()).groupBy(F.col("_place").alias("_p")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_p"))
    once = placed.filter(F.col(class_col).isin(*classes))
    if again.isEmpty():
        return once.select(*rows.columns, side.alias("split"))
    several = F.col("_place") == F.col("_p")
    copies = rows.filter(F.col(class_col).isin(*classes)).join(again, several, "left_semi").select(id_col, class_col, "_place")
    parts = copies.filter(F.col("_place") != border).select(id_col, side.alias("split"))
    for c, (at, _, _) in last.items():  # copies of the last test row's id, some of which may be beyond it
        mine = F.col(class_col) == F.lit(c)
        left = test[c] - known.filter(mine & (F.col("_place") < at)).count()
        w = Window.partitionBy("_place").orderBy(hash_key(id_col, seed), id_col)
        here = copies.filter(mine & (F.col("_place") == at)).withColumn("_r", F.row_number().over(w))
        parts = parts.unionByName(here.select(id_col, F.when(F.col("_r") <= left, F.lit("test")).otherwise(F.lit("train")).alias("split")))
    pairs = placed.join(again, several, "left_semi").drop(*carried).join(parts, id_col)
    if carried:
        pairs = pairs.join(placed.join(again, several, "left_semi").select(id_col, *carried), id_col)
    pairs = pairs.select(*rows.columns, "split")
    return once.join(again, several, "left_anti").select(*rows.columns, side.alias("split")).unionByName(pairs)


def stratified_split_3way(df: DataFrame, class_col: str = "is_suspicious", classes=(False, True), test_frac: float = 0.2,
                          val_frac: float = 0.15, id_col: str = "transaction_id", seed: int = 42) -> DataFrame:
    """Nested split: test = first ceil(test_frac n); of the rest, val = the next
    ceil(val_frac (n - n_test)); others train."""
    r = _class_ranks(df, class_col, list(classes), id_col, seed)
    nt = F.ceil(F.col("_n") * F.lit(test_frac))
    nv = F.ceil((F.col("_n") - nt) * F.lit(val_frac))
    return r.select(
        id_col, class_col,
        F.when(F.col("_rank") <= nt, F.lit("test")).when(F.col("_rank") <= nt + nv, F.lit("val")).otherwise(F.lit("train")).alias("split"),
    )
