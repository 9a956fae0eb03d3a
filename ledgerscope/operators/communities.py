"""Communities by modularity: local moving, then contraction, level by level.

A round looks at every account at once: the weight of its links to each
neighbouring community (one join and one partial sum over the links), the gain of
moving there, and its best move. Accounts that move at the same time can spoil each
other's gains, so a round allows only moves to a smaller (or, in turn, a larger)
community number, and is kept only if the modularity of the whole, which the next
round's sums give for nothing, has grown; else the same moves are tried by a half,
a quarter, ... of the accounts (picked by hash), at last by the one of largest gain,
which can't fail. When no account gains by moving, communities become the accounts
of a smaller weighted graph, until nothing joins any more. Modularity never falls.

Accounts are numbered once; every round works on two ids and a weight. Up to
``link_blocks.MAX_NODES`` accounts, a round is one sweep over packed links; beyond, it is joins
and sums whose results are checkpointed to the shared folder. Both make the same moves.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.operators import link_blocks as LB
from ledgerscope.operators.graph import undirected_pairs
from ledgerscope.operators.prefix import dense_index
from ledgerscope.session import cut_lineage, passing_cuts

#: Least growth of modularity for which a round is kept.
LEAST_GAIN = 1e-9


def _links(adj: DataFrame, com: DataFrame) -> DataFrame:
    """(id, k, c, other, w): weight of each node's links to each community near it."""
    far = com.select(F.col("id").alias("v"), F.col("c").alias("other"))
    near = adj.join(far, "v").groupBy(F.col("u").alias("id"), "other").agg(F.sum("w").alias("w"))
    return near.join(com.select("id", "k", "c"), "id")


def _quality(links: DataFrame, com: DataFrame, m2: int) -> float:
    inner = links.filter("other = c").agg(F.coalesce(F.sum("w"), F.lit(0)).alias("x")).first()["x"]
    totals = com.groupBy("c").agg(F.sum("k").alias("t"), F.sum("loop").alias("loop"))
    r = totals.agg(F.sum("loop").alias("loop"), F.sum(F.pow(F.col("t") / F.lit(float(m2)), 2)).alias("square")).first()
    return (inner + r["loop"]) / m2 - r["square"]


def _moves(links: DataFrame, com: DataFrame, m2: int, up: bool) -> DataFrame:
    """(id, to, gain) of each node that gains by its best move in the round's direction."""
    totals = com.groupBy("c").agg(F.sum("k").cast("double").alias("t"))
    own = F.coalesce(F.max(F.when(F.col("other") == F.col("c"), F.col("w"))), F.lit(0))
    direction = F.col("other") > F.col("c") if up else F.col("other") < F.col("c")
    value = F.col("w") - F.col("k") * F.col("t") / F.lit(float(m2))
    best = F.max(F.when(direction, F.struct(value.alias("value"), (-F.col("other")).alias("order"))))
    j = links.join(totals.select(F.col("c").alias("other"), "t"), "other")
    per = j.groupBy("id").agg(F.first("c").alias("c"), F.first("k").alias("k"), own.alias("own"), best.alias("best"))
    per = per.filter("best is not null").join(totals, "c")
    stay = F.col("own") - F.col("k") * (F.col("t") - F.col("k")) / F.lit(float(m2))
    return per.select("id", (-F.col("best.order")).alias("to"), (F.col("best.value") - stay).alias("gain")).filter(F.col("gain") > 1e-9)


def _local_moving(adj: DataFrame, nodes: DataFrame, m2: int) -> tuple[DataFrame, bool]:
    """Communities (id, k, loop, c) that no single move betters, and whether any node moved."""
    com = cut_lineage(nodes.withColumn("c", F.col("id")))
    links = cut_lineage(_links(adj, com))
    q, moved, idle, up, turn = _quality(links, com, m2), False, 0, False, 0
    while idle < 2:
        moves = cut_lineage(_moves(links, com, m2, up))
        kept = False
        if n := moves.count():
            share = 1
            while not kept:
                turn += 1
                if share >= 2 * n:
                    some = moves.orderBy(F.desc("gain"), "id").limit(1)
                else:
                    some = moves.filter(F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(share)) == 0) if share > 1 else moves
                to = some.select("id", "to")
                new = cut_lineage(com.join(to, "id", "left").select("id", "k", "loop", F.coalesce("to", "c").alias("c")))
                new_links = cut_lineage(_links(adj, new))
                q_new = _quality(new_links, new, m2)
                if q_new > q + LEAST_GAIN:
                    com, links, q, kept, moved = new, new_links, q_new, True, True
                elif share >= 2 * n:
                    break  # a gain too small to count
                else:
                    share = share * 2 if share < 8 else 2 * n
        idle = 0 if kept else idle + 1
        up = not up
    return com, moved


def communities(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, community): communities of the undirected weighted graph, named by
    their smallest account. An account without links is a community of its own."""
    with passing_cuts(nodes.sparkSession) as keep:
        index = cut_lineage(dense_index(nodes, "node", "id"))
        adj = cut_lineage(_adjacency(edges, index))
        n = index.count()
        return keep(_by_sweeps(adj, index, n) if n <= LB.MAX_NODES else _by_joins(adj, index))


def _adjacency(edges: DataFrame, index: DataFrame) -> DataFrame:
    ids = lambda c: index.select(F.col("node").alias(c), F.col("id").alias(f"{c}_id"))
    pairs = undirected_pairs(edges).join(ids("u"), "u").join(ids("v"), "v").select(F.col("u_id").alias("u"), F.col("v_id").alias("v"), F.col("weight").alias("w"))
    return pairs.select(F.explode(F.array(F.struct("u", "v", "w"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"), "w"))).alias("x")).select("x.*")


def _sweeps_settle(blocks: DataFrame, ids: np.ndarray, k: np.ndarray, loops: int, m2: int) -> tuple[np.ndarray, bool]:
    """``_local_moving`` with every round one sweep over packed links: the sweep that weighs a
    trial's modularity also finds the next round's moves, in the other direction."""

    def swept(c, up):
        t = np.bincount(c, weights=k, minlength=len(c))
        *moves, inner = LB.sweep(blocks, c, up, k, t, float(m2))
        return moves, (inner + loops) / m2 - float(np.sum((t / m2) ** 2))

    c = ids.copy()
    known = {}
    known[False], q = swept(c, False)
    moved, idle, up, turn = False, 0, False, 0
    while idle < 2:
        if up not in known:
            known[up], _ = swept(c, up)
        at, to, gain = known[up]
        kept = False
        if n := len(at):
            share = 1
            while not kept:
                turn += 1
                if share >= 2 * n:
                    some = np.array([np.lexsort((at, -gain))[0]])
                else:
                    some = np.flatnonzero(LB.hash_int(turn, LB.hash_long(at, 42)).astype(np.int64) % share == 0) if share > 1 else np.arange(n)
                new = c.copy()
                new[at[some]] = to[some]
                moves, q_new = swept(new, not up)
                if q_new > q + LEAST_GAIN:
                    c, q, kept, moved = new, q_new, True, True
                    known = {not up: moves}
                elif share >= 2 * n:
                    break  # a gain too small to count
                else:
                    share = share * 2 if share < 8 else 2 * n
        idle = 0 if kept else idle + 1
        up = not up
    return c, moved


def _by_sweeps(adj: DataFrame, index: DataFrame, n: int) -> DataFrame:
    ids = np.arange(n)
    member, loop = ids, np.zeros(n, np.int64)
    (k,) = LB.arrays(adj.groupBy(F.col("u").alias("id")).agg(F.sum("w").alias("k")), n, "k")
    m2 = int(k.sum())
    while m2:
        with passing_cuts(adj.sparkSession) as keep:
            blocks = LB.pack(adj)
            c, moved = _sweeps_settle(blocks, ids, k, int(loop.sum()), m2)
            if not moved:
                break
            member = c[member]
            grown = keep(LB.contracted(blocks, c))
        (inner,) = LB.arrays(grown.filter("u = v").select(F.col("u").alias("id"), F.col("w").alias("inner")), n, "inner")
        k, loop = (np.bincount(c, weights=x, minlength=n).astype(np.int64) for x in (k, loop))
        loop += inner
        adj = grown.filter("u <> v")
    _, first, of = np.unique(member, return_index=True, return_inverse=True)  # numbers are in the order of names
    return LB.named(index, first[of])


def _by_joins(adj: DataFrame, index: DataFrame) -> DataFrame:
    level = adj.groupBy(F.col("u").alias("id")).agg(F.sum("w").alias("k")).withColumn("loop", F.lit(0).cast("long"))
    m2 = adj.agg(F.sum("w")).first()[0]
    member = index.withColumn("c", F.col("id"))
    while m2:
        com, moved = _local_moving(adj, level, m2)
        if not moved:
            break
        to = com.select(F.col("id").alias("c"), F.col("c").alias("to"))
        member = cut_lineage(member.join(to, "c", "left").select("node", "id", F.coalesce("to", "c").alias("c")))
        side = lambda x: com.select(F.col("id").alias(x), F.col("c").alias(f"c{x}"))
        grown = cut_lineage(adj.join(side("u"), "u").join(side("v"), "v").groupBy("cu", "cv").agg(F.sum("w").alias("w")))
        inner = grown.filter("cu = cv").select(F.col("cu").alias("c"), F.col("w").alias("inner"))
        sums = com.groupBy("c").agg(F.sum("k").alias("k"), F.sum("loop").alias("loop"))
        level = cut_lineage(sums.join(inner, "c", "left").select(F.col("c").alias("id"), "k", (F.col("loop") + F.coalesce("inner", F.lit(0))).alias("loop")))
        adj = grown.filter("cu <> cv").select(F.col("cu").alias("u"), F.col("cv").alias("v"), "w")
    lowest = member.groupBy("c").agg(F.min("node").alias("community"))
    return member.join(lowest, "c").select("node", "community")
