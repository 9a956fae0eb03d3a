"""Nearest neighbours within a group by shifted space-filling curves and exact rerank.

Every vector is put on several Z-order curves, each over its own random shift and order
of the axes. Rows that lie close in space lie close on most curves, so the rows within
``reach`` places on any curve are compared by exact distance. Nothing depends on the
size of a bucket: curves are sorted by range, cut into blocks of ``block`` places, and a
block gets copies of the first ``reach`` rows of the next, so one group or one value may
hold all rows. A row has at most 2 x curves x reach candidates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.operators.prefix import prefix_sums

BITS = 6  # a side; 9 axes of 6 bits fit a long


def _on_curves(names: list[str], curves: int, seed: int, span: float):
    """Arrow batches (id, grp, x) -> one row a curve with its place ``z`` on it."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            x = np.array(b.column(2).to_pylist(), dtype=float)
            bits = max(1, min(BITS, 62 // x.shape[1]))
            for c in range(curves):
                rng = np.random.default_rng([seed, c])
                shift, axes = rng.uniform(0, span / 4, x.shape[1]), rng.permutation(x.shape[1])
                cell = ((np.clip(x, -span, span) + span + shift) / (2.25 * span) * (1 << bits)).astype(np.int64)
                z = np.zeros(len(x), np.int64)
                for level in range(bits - 1, -1, -1):
                    for d in axes:
                        z = z << 1 | cell[:, d] >> level & 1
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(x), c, np.int32)), pa.array(z)], names=names)

    return run


def _near(k: int, reach: int):
    """One block of a curve, in order: for each row its k nearest within reach."""

    def run(rows):
        import numpy as np
        import pandas as pd

        rows = rows.sort_values("at")
        x = np.array(rows["x"].tolist(), dtype=float)
        ids, own = rows["id"].to_numpy(), rows["own"].to_numpy()
        side = pd.factorize(pd.MultiIndex.from_arrays([rows["curve"], rows["grp"].fillna("")]))[0] * 2 + rows["grp"].isna().to_numpy()
        found = []
        for step in range(1, min(reach, len(rows) - 1) + 1):
            i = np.flatnonzero((side[step:] == side[:-step]) & own[:-step])
            d = ((x[i + step] - x[i]) ** 2).sum(1)
            found += [(i, i + step, d), (i + step, i, d)]
        if not found:
            return pd.DataFrame({"id": [], "near": [], "d": []})
        a, b, d = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((ids[b].astype(str), d, a))
        a, b, d = a[order], b[order], d[order]
        start = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.array([], int)
        rank = np.arange(len(a)) - np.repeat(start, np.diff(np.r_[start, len(a)]))
        kept = rank < k
        return pd.DataFrame({"id": ids[a[kept]], "near": ids[b[kept]], "d": d[kept]})

    return run


def nearest(
    rows: DataFrame, ident: str, group: str, cols: list[str], k: int = 5, curves: int = 6, reach: int = 8, block: int = 4096, seed: int = 17, span: float = 4.0
) -> DataFrame:
    """(id, near): for each row the ids of its ``k`` nearest rows of the same ``group``
    (a null group is one of its own), nearest first, ties by id; fewer where the group
    has fewer. ``ident`` is text and unique, ``cols`` are standardised (places beyond
    ``span`` deviations share the outermost cells of a curve; distances stay exact). A
    row without another in its group is left out."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    base = rows.select(F.col(ident).alias("id"), F.col(group).alias("grp"), x.alias("x"))
    names = ["id", "grp", "x", "curve", "z"]
    placed = base.mapInArrow(_on_curves(names, curves, seed, span), "id string, grp string, x array<double>, curve int, z long")
    order = [F.col(c) for c in ("curve", "grp", "z", "id")]
    at = prefix_sums(placed.withColumn("_one", F.lit(1).cast("long")), order, ["_one"])
    at = at.select("id", "grp", "x", "curve", (F.col("_one_cum") - 1).alias("at"))
    home, first = F.floor(F.col("at") / block), F.col("at") % block < reach
    blocks = F.when(first, F.array(home, home - 1)).otherwise(F.array(home))
    dealt = at.select("*", F.explode(blocks).alias("blk")).withColumn("own", F.col("blk") == home)
    pairs = dealt.groupBy("blk").applyInPandas(_near(k, reach), "id string, near string, d double")
    best = pairs.groupBy("id").agg(F.slice(F.sort_array(F.collect_set(F.struct("d", "near"))), 1, k).alias("b"))
    return best.select("id", F.transform("b", lambda s: s["near"]).alias("near"))
