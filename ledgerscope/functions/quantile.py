"""Exact quantiles by distributed selection.

An exact ``percentile`` keeps a map of all different values of a group in one
task. Here an order statistic is narrowed down instead: counts of at most BINS
equal parts of the interval in which it lies (partial sums in every task, BINS
rows at the driver) name the part to look into next, until one value is left. A
range of a trillion different values takes four passes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096


def order_statistics(df: DataFrame, value: Column, q: float | Callable, group: Column | None = None) -> dict:
    """{group: (lower, upper, share)} of the whole numbers ``value``: its two order
    statistics around place q (n - 1), and how far the place lies between them. A function
    q(group, n) gives the place itself (from 0; a group placed outside its rows is left out).
    Null values don't count; a null group is a group; groups are few (classes)."""
    rows = df.select((group if group is not None else F.lit(0)).alias("g"), value.cast("long").alias("v")).filter("v is not null")
    out, open_places = {}, []
    for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
        place = q(r["g"], r["n"]) if callable(q) else q * (r["n"] - 1)
        if not 0 <= place < r["n"]:
            continue
        for side, rank in enumerate((math.floor(place), math.ceil(place))):
            # [group, interval, values of the group below it, wanted rank, side, share]
            open_places.append([r["g"], r["lo"], r["hi"], 0, rank, side, place - math.floor(place)])
    found: dict = {}
    while open_places:
        intervals = sorted({(p[0] is None, str(p[0]), p[1], p[2]): (p[0], p[1], p[2]) for p in open_places if p[1] < p[2]}.items())
        cases = []
        for k, (_, (g, lo, hi)) in enumerate(intervals):
            width = -(-(hi - lo + 1) // BINS)
            mine = F.col("g").eqNullSafe(F.lit(g)) & F.col("v").between(lo, hi)
            cases.append(F.when(mine, F.struct(F.lit(k).alias("k"), F.call_function("div", F.col("v") - F.lit(lo).cast("long"), F.lit(width).cast("long")).alias("bin"))))
        counts: dict = {}
        if cases:
            bins = rows.select(F.explode(F.array_compact(F.array(*cases))).alias("x")).groupBy("x.k", "x.bin").agg(F.count(F.lit(1)).alias("n"))
            for r in bins.collect():
                counts.setdefault(r["k"], []).append((r["bin"], r["n"]))
        number = {i: k for k, (_, i) in enumerate(intervals)}
        left = []
        for p in open_places:
            g, lo, hi, below, rank, side, share = p
            if lo == hi:
                found.setdefault(g, {})[side] = lo
                out[g] = share
                continue
            width = -(-(hi - lo + 1) // BINS)
            for b, n in sorted(counts[number[(g, lo, hi)]]):
                if below + n > rank:
                    left.append([g, lo + b * width, min(hi, lo + (b + 1) * width - 1), below, rank, side, share])
                    break
                below += n
        open_places = left
    return {g: (found[g][0], found[g][1], share) for g, share in out.items()}


def grid_quantiles(df: DataFrame, value: Column, q: float, scale: int, group: Column | None = None) -> dict:
    """{group: quantile} with linear interpolation, of values given in 1 / ``scale``."""
    between = lambda lo, hi, s: lo / scale if lo == hi else (1 - s) * (lo / scale) + s * (hi / scale)
    return {g: between(lo, hi, s) for g, (lo, hi, s) in order_statistics(df, value, q, group).items()}
