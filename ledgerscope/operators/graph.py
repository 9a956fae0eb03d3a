"""Account graph: build, measure and partition.

Vertices and edges are DataFrames (``node``; ``src``, ``dst``, weights).
Iterative algorithms (components, strong components, label propagation) run
one join + aggregate per round, stop when nothing changes, cut lineage with a
reliable checkpoint every few rounds (written to ``spark.checkpoint.dir``, so
a lost executor does not replay the whole history) and raise if a round cap
is hit without convergence.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions.constants import NODE_FEATURES
from ledgerscope.operators import link_blocks as LB
from ledgerscope.operators.prefix import dense_index
from ledgerscope.session import cut_lineage, passing_cuts

CHECKPOINT_EVERY = 3


def _round_result(df: DataFrame, i: int) -> DataFrame:
    """Materialise one round: a reliable checkpoint every few rounds, a cache
    otherwise (recomputable from the last checkpoint)."""
    if (i + 1) % CHECKPOINT_EVERY == 0:
        return cut_lineage(df)
    return df.cache()


def graph_edges(txns: DataFrame) -> DataFrame:
    """Weighted simple digraph: one edge per (sender, receiver) with the
    transfer count, the USD sum and the type of the first transfer."""
    return txns.groupBy(F.col("sender_id").alias("src"), F.col("receiver_id").alias("dst")).agg(
        F.count(F.lit(1)).alias("weight"),
        (F.sum("amount_cents") / F.lit(100.0)).alias("amount_usd"),
        F.min_by("transaction_type", F.struct("timestamp", "transaction_id")).alias("transaction_type"),
    )


def graph_nodes(txns: DataFrame) -> DataFrame:
    """Every account seen as sender or receiver, with the suspicious flag of
    the first transfer it appears in."""
    both = txns.select(
        F.explode(F.array("sender_id", "receiver_id")).alias("node"), "timestamp", "transaction_id", "is_suspicious"
    )
    return both.groupBy("node").agg(
        F.min_by("is_suspicious", F.struct("timestamp", "transaction_id")).alias("is_suspicious")
    )


def undirected_pairs(edges: DataFrame) -> DataFrame:
    """Canonical undirected simple graph (u < v), self-loops dropped, with the
    summed weight of both directions."""
    e = edges.filter(F.col("src") != F.col("dst"))
    return e.groupBy(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).agg(
        F.sum("weight").alias("weight")
    )


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
        pairs.select(F.col("v").alias("a"), F.col("u").alias("b"))
    )


def connected_components(edges: DataFrame, nodes: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Weakly connected components labelled by their smallest node id:
    min-label propagation plus pointer jumping (label <- label of label).
    Convergence is read off the propagation aggregate itself (did any node's
    minimum drop below its current label?), so a round is one job."""
    adj = _both_ways(undirected_pairs(edges)).cache()  # short lineage: cached, recomputable
    lab = nodes.select("node", F.col("node").alias("label")).cache()
    for i in range(max_rounds):
        cand = adj.join(lab, adj.a == lab.node).select(F.col("b").alias("node"), "label", F.lit(False).alias("_self"))
        prop = (
            lab.select("node", "label", F.lit(True).alias("_self"))
            .unionByName(cand)
            .groupBy("node")
            .agg(F.min("label").alias("label"), F.min(F.when(F.col("_self"), F.col("label"))).alias("_old"))
        )
        prop = _round_result(prop, i)
        changed = prop.filter(F.col("label") < F.col("_old")).limit(1).count()
        if changed == 0:
            out = prop.select("node", F.col("label").alias("component"))
            adj.unpersist()
            return out
        p = prop.select(F.col("node").alias("_p"), F.col("label").alias("_pl"))
        new = prop.join(p, prop.label == p._p, "left").select(
            "node", F.least("label", F.coalesce("_pl", "label")).alias("label")
        )
        lab = new
    raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")


def degrees(edges: DataFrame) -> DataFrame:
    """Directed simple-graph degree (in + out distinct partners; a self-loop
    counts twice)."""
    out = edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("out_degree"))
    inn = edges.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("in_degree"))
    return out.join(inn, "node", "full").select(
        "node",
        F.coalesce("out_degree", F.lit(0)).alias("out_degree"),
        F.coalesce("in_degree", F.lit(0)).alias("in_degree"),
        (F.coalesce("out_degree", F.lit(0)) + F.coalesce("in_degree", F.lit(0))).alias("degree"),
    )


def triangles(edges: DataFrame) -> DataFrame:
    """Per-node triangle count and local clustering on the undirected simple
    graph. Edges are oriented from lower to higher (degree, id), so every node
    enumerates wedges only among its higher-ranked neighbours (at most
    sqrt(2m) of them) and each triangle is found once."""
    pairs = undirected_pairs(edges).select("u", "v")
    both = _both_ways(pairs)
    deg = both.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("d"))
    o = pairs.join(deg.select(F.col("node").alias("u"), F.col("d").alias("du")), "u").join(
        deg.select(F.col("node").alias("v"), F.col("d").alias("dv")), "v"
    )
    lo_first = (F.col("du") < F.col("dv")) | ((F.col("du") == F.col("dv")) & (F.col("u") < F.col("v")))
    oriented = o.select(
        F.when(lo_first, F.col("u")).otherwise(F.col("v")).alias("x"),
        F.when(lo_first, F.col("v")).otherwise(F.col("u")).alias("y"),
    )
    w1 = oriented.select(F.col("x"), F.col("y").alias("p"))
    w2 = oriented.select(F.col("x"), F.col("y").alias("q"))
    wedges = w1.join(w2, "x").filter(F.col("p") < F.col("q"))
    closed = wedges.join(pairs, (F.col("u") == F.col("p")) & (F.col("v") == F.col("q")), "left_semi")
    per = (
        closed.select(F.explode(F.array("x", "p", "q")).alias("node"))
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("triangles"))
    )
    d = F.col("d")
    return deg.join(per, "node", "left").select(
        "node",
        d.alias("degree"),
        F.coalesce("triangles", F.lit(0)).alias("triangles"),
        F.when(d >= 2, F.round(F.lit(2.0) * F.coalesce("triangles", F.lit(0)) / (d * (d - 1)), 6))
        .otherwise(F.lit(0.0))
        .alias("clustering"),
    )


def graph_stats(edges: DataFrame, nodes: DataFrame, risk: DataFrame | None = None, risk_min: float = 0.5) -> DataFrame:
    """Nodes, edges, density m / (n (n - 1)), mean clustering over all nodes,
    and (given risk scores) the count of nodes above ``risk_min``."""
    n = nodes.select(F.count(F.lit(1))).scalar()
    m = edges.select(F.count(F.lit(1))).scalar()
    tri = triangles(edges)
    clust = tri.select(F.sum("clustering")).scalar()
    out = nodes.sparkSession.range(1).select(
        n.alias("num_nodes"),
        m.alias("num_edges"),
        F.round(m / F.nullif(n * (n - 1), F.lit(0).cast("long")), 9).alias("density"),
        F.round(F.coalesce(clust, F.lit(0.0)) / F.nullif(n, F.lit(0).cast("long")), 6).alias("avg_clustering"),
    )
    if risk is not None:
        hr = risk.join(nodes.select(F.col("node").alias("customer_id")), "customer_id", "left_semi").select(
            F.count_if(F.col("gnn_risk_score") > risk_min)
        ).scalar()
        out = out.withColumn("high_risk_nodes", hr)
    return out


def ego_subgraph(edges: DataFrame, center: str, radius: int = 2, max_nodes: int = 150) -> DataFrame:
    """Nodes within ``radius`` undirected hops of ``center`` (frontier joins),
    capped to the ``max_nodes`` of highest directed degree (ties: id). An
    unknown centre gives an empty frame."""
    spark = edges.sparkSession
    adj = _both_ways(undirected_pairs(edges))
    seen = spark.createDataFrame([(center, 0)], "node string, hop int").join(
        _both_ways(edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))).select(F.col("a").alias("node")).distinct(),
        "node",
        "left_semi",
    )
    frontier = seen
    for h in range(1, radius + 1):
        nxt = frontier.join(adj, frontier.node == adj.a).select(F.col("b").alias("node")).distinct()
        nxt = nxt.join(seen, "node", "left_anti").withColumn("hop", F.lit(h))
        seen = seen.unionByName(nxt)
        frontier = nxt
    deg = degrees(edges)
    return (
        seen.join(deg, "node", "left")
        .orderBy(F.desc("degree"), F.asc("node"))
        .limit(max_nodes)
        .select("node", "hop", F.coalesce("degree", F.lit(0)).alias("degree"))
    )


def ego_edges(edges: DataFrame, ego_nodes: DataFrame) -> DataFrame:
    """Induced edges among the ego nodes (two semi joins)."""
    k = ego_nodes.select("node")
    return edges.join(k.withColumnRenamed("node", "src"), "src", "left_semi").join(
        k.withColumnRenamed("node", "dst"), "dst", "left_semi"
    )


def propagate_features(x: DataFrame, txns: DataFrame, cols: list[str] | None = None, rounds: int = 2) -> DataFrame:
    """Weight-free mean-neighbour message passing over transfers (multi-edges
    count): x <- (x + sum of in-neighbour x) / (1 + max(in-degree, 1))."""
    cols = cols or NODE_FEATURES
    e = cut_lineage(txns.groupBy(F.col("sender_id").alias("src"), F.col("receiver_id").alias("dst")).agg(F.count(F.lit(1)).alias("_m")))
    cur = x.select(F.col("customer_id").alias("node"), *cols)
    for _ in range(rounds):
        msg = e.join(cur.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node")).agg(
            F.sum("_m").alias("_k"), *[F.sum(F.col(c) * F.col("_m")).alias(f"_s_{c}") for c in cols]
        )
        j = cur.join(msg, "node", "left")
        k = F.greatest(F.coalesce("_k", F.lit(0)), F.lit(1))
        # written: the next round reads it twice
        cur = cut_lineage(j.select("node", *[((F.col(c) + F.coalesce(F.col(f"_s_{c}"), F.lit(0.0))) / (k + 1)).alias(c) for c in cols]))
    return cur.withColumnRenamed("node", "customer_id")


def label_propagation(edges: DataFrame, nodes: DataFrame, max_rounds: int = 500) -> DataFrame:
    """Weighted label propagation on the undirected graph. A node is settled if no
    neighbouring label outweighs its own; each round, half of the unsettled nodes
    (a hash of node and round picks them, so two neighbours don't keep swapping)
    take the label of largest weight (ties: smallest). Ends when all are settled;
    raises if ``max_rounds`` don't suffice."""
    with passing_cuts(nodes.sparkSession) as keep:
        # numbers in the order of the names: ties stay, and no round moves a name of a link
        index = cut_lineage(dense_index(nodes, "node", "id"))
        pairs = cut_lineage(_numbered_pairs(edges, index))
        n = index.count()
        return keep(_labels_by_sweeps(pairs, index, n, max_rounds) if n <= LB.MAX_NODES else _labels_by_joins(pairs, index, max_rounds))


def _numbered_pairs(edges: DataFrame, index: DataFrame) -> DataFrame:
    ids = lambda c: index.select(F.col("node").alias(c), F.col("id").alias(f"{c}_id"))
    return undirected_pairs(edges).join(ids("u"), "u").join(ids("v"), "v").select(F.col("u_id").alias("u"), F.col("v_id").alias("v"), "weight")


def _labels_by_sweeps(pairs: DataFrame, index: DataFrame, n: int, max_rounds: int) -> DataFrame:
    ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    blocks = LB.pack(pairs.select(F.explode(ends).alias("x"), F.col("weight").alias("w")).select("x.*", "w"))
    (name,) = LB.arrays(index.select("id", F.xxhash64("node").alias("name")), n, "name")
    label = np.arange(n)
    for i in range(max_rounds):
        at, to, _, _ = LB.sweep(blocks, label)
        if not len(at):
            return LB.named(index, label)
        mine = LB.hash_int(i, name[at]).astype(np.int64) % 2 == 0
        label[at[mine]] = to[mine]
    raise RuntimeError(f"labels did not settle in {max_rounds} rounds")


def _labels_by_joins(pairs: DataFrame, index: DataFrame, max_rounds: int) -> DataFrame:
    adj = pairs.select(F.col("u").alias("a"), F.col("v").alias("b"), "weight").unionByName(
        pairs.select(F.col("v").alias("a"), F.col("u").alias("b"), "weight")
    )
    adj = adj.repartition("b").cache()  # laid out once for every round's join
    lab = index.select("id", "node", F.col("id").alias("label"))
    for i in range(max_rounds):
        votes = adj.join(lab.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id"), "label").agg(F.sum("weight").alias("w"))
        mine = lab.select("id", F.col("label").alias("own"))
        best = votes.join(mine, "id").groupBy("id").agg(
            F.min(F.struct((-F.col("w")).alias("nw"), F.col("label").alias("l"))).alias("best"),
            F.coalesce(F.max(F.when(F.col("label") == F.col("own"), F.col("w"))), F.lit(0)).alias("held"),
        )
        turn = F.pmod(F.xxhash64("node", F.lit(i)), F.lit(2)) == 0
        unsettled = F.coalesce(-F.col("best.nw") > F.col("held"), F.lit(False))
        new = lab.join(best, "id", "left").select(
            "id", "node", F.when(unsettled & turn, F.col("best.l")).otherwise(F.col("label")).alias("label"), unsettled.alias("unsettled")
        )
        new = _round_result(new, i)
        if not new.filter("unsettled").limit(1).count():
            adj.unpersist()
            return new.select("node", "label").join(index.select(F.col("id").alias("label"), F.col("node").alias("community")), "label").select("node", "community")
        lab = new.select("id", "node", "label")
    raise RuntimeError(f"labels did not settle in {max_rounds} rounds")


def component_counts(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Numbers of weak and strong components, for the graph statistics."""
    from ledgerscope.operators.strong import strong_components

    weak = connected_components(edges, nodes).select(F.count_distinct("component")).scalar()
    strong = strong_components(edges, nodes).select(F.count_distinct("component")).scalar()
    return nodes.sparkSession.range(1).select(weak.alias("weak_components"), strong.alias("strong_components"))


def modularity(edges: DataFrame, partition: DataFrame, label_col: str = "community") -> DataFrame:
    """Newman modularity of a partition of the undirected weighted graph:
    sum over communities of L_c / m - (D_c / 2m)^2."""
    pairs = cut_lineage(undirected_pairs(edges))  # read three times
    p = partition.select(F.col("node"), F.col(label_col).alias("c"))
    m = pairs.select(F.sum("weight")).scalar()
    lc = (
        pairs.join(p.withColumnRenamed("node", "u").withColumnRenamed("c", "cu"), "u")
        .join(p.withColumnRenamed("node", "v").withColumnRenamed("c", "cv"), "v")
        .groupBy("cu")
        .agg(F.sum(F.when(F.col("cu") == F.col("cv"), F.col("weight")).otherwise(0)).alias("L"))
    )
    both = pairs.select(F.col("u").alias("node"), "weight").unionByName(pairs.select(F.col("v").alias("node"), "weight"))
    dc = both.join(p, "node").groupBy(F.col("c").alias("cu")).agg(F.sum("weight").alias("D"))
    q = lc.join(dc, "cu", "full").select(
        (F.coalesce("L", F.lit(0)) / m - F.pow(F.coalesce("D", F.lit(0)) / (F.lit(2.0) * m), 2)).alias("q")
    )
    return q.agg(F.round(F.sum("q"), 6).alias("modularity"), F.count(F.lit(1)).alias("communities"))
