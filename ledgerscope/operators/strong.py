"""Strongly connected components in few rounds, also on long chains.

Two kinds of work alternate until no account is left:

* Chains. An account with one edge in and one out belongs to a component only with
  both its neighbours, so whole runs of such accounts are replaced by one edge at
  once; pointer doubling finds a run's two ends in a logarithmic number of joins
  (a run that closes on itself is a ring, a component). Accounts with no edge in or
  none out are components of their own and leave. Chains and trees of any length
  are gone after a logarithmic number of turns.
* Colours. Every account gets the largest number that reaches it; the account of
  that number is the pivot of all accounts of its colour, and those that reach it
  within the colour form its component. All pivots are treated at once. Both
  searches double their paths: a reacher's own largest reacher reaches as well.

Accounts are numbered once, edges are pairs of longs. Rounds are checkpointed to the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.operators.prefix import dense_index
from ledgerscope.session import cut_lineage


def _any(df: DataFrame) -> bool:
    return bool(df.limit(1).count())


def largest_reacher(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, c): the largest id from which edges (src, dst) lead to each id, itself included."""
    lab = cut_lineage(nodes.select("id", F.col("id").alias("c")))
    while True:
        near = edges.join(lab.select(F.col("id").alias("src"), "c"), "src").groupBy(F.col("dst").alias("id")).agg(F.max("c").alias("near"))
        new = lab.join(near, "id", "left").select("id", F.col("c").alias("old"), F.greatest("c", "near").alias("c"))
        ahead = lab.select(F.col("id").alias("c"), F.col("c").alias("far"))
        new = cut_lineage(new.join(ahead, "c").select("id", "old", F.greatest("c", "far").alias("c")))
        lab = new.select("id", "c")
        if not _any(new.filter("c > old")):
            return lab


def _runs(e: DataFrame, inner: DataFrame) -> DataFrame:
    """(id, before, after, low, ring) of every id in ``inner`` (one edge in, one out):
    the ends of its run of such ids, outside the run; a ring has none, only its smallest id."""
    one = inner.join(e.select(F.col("src").alias("id"), F.col("dst").alias("after")), "id").join(e.select(F.col("dst").alias("id"), F.col("src").alias("before")), "id")
    run = cut_lineage(one.withColumn("low", F.col("id")).withColumn("open", F.lit(True)))
    n = inner.count()
    reach = 1
    while reach <= 2 * n:  # a run is at most n long, so what is still open then is a ring
        fwd = run.select(F.col("id").alias("after"), F.col("after").alias("after2"), F.col("low").alias("low2"))
        back = run.select(F.col("id").alias("before"), F.col("before").alias("before2"))
        j = run.join(fwd, "after", "left").join(back, "before", "left")
        more = F.col("after2").isNotNull() | F.col("before2").isNotNull()
        run = cut_lineage(
            j.select("id", F.coalesce("before2", "before").alias("before"), F.coalesce("after2", "after").alias("after"), F.least("low", F.coalesce("low2", "low")).alias("low"), more.alias("open"))
        )
        if not _any(run.filter("open")):
            break
        reach *= 2
    ends = inner.select(F.col("id").alias("after"), F.lit(True).alias("ring"))
    return cut_lineage(run.drop("open").join(ends, "after", "left").select("id", "before", "after", "low", F.coalesce("ring", F.lit(False)).alias("ring")))


def _shrunk(e: DataFrame, nodes: DataFrame, done: list[DataFrame], runs: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Edges and nodes without runs, rings, sources and sinks; those go to ``runs`` and ``done``."""
    while True:
        ends = e.select(F.explode(F.array(F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("x"))
        deg = ends.groupBy("x.id").agg(F.sum("x.o").alias("o"), F.sum("x.i").alias("i"))
        deg = cut_lineage(nodes.join(deg, "id", "left").select("id", F.coalesce("o", F.lit(0)).alias("o"), F.coalesce("i", F.lit(0)).alias("i")))
        lone = deg.filter("o = 0 or i = 0").select("id")
        inner = deg.filter("o = 1 and i = 1").select("id")
        some_lone, some_inner = _any(lone), _any(inner)
        if not (some_lone or some_inner):
            return e, nodes
        if some_inner:
            run = _runs(e, inner)
            done.append(run.filter("ring").select("id", F.col("low").alias("c")))
            open_run = run.filter("not ring").select("id", "before", "after")
            runs.append(open_run)
            joined = open_run.select(F.col("before").alias("src"), F.col("after").alias("dst")).distinct()
            gone = inner
            e = e.join(gone.withColumnRenamed("id", "src"), "src", "left_anti").join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti")
            e = e.select("src", "dst").unionByName(joined.filter("src <> dst")).distinct()
            nodes = nodes.join(gone, "id", "left_anti")
        if some_lone:
            done.append(lone.select("id", F.col("id").alias("c")))
            e = e.join(lone.withColumnRenamed("id", "src"), "src", "left_anti").join(lone.withColumnRenamed("id", "dst"), "dst", "left_anti").select("src", "dst")
            nodes = nodes.join(lone, "id", "left_anti")
        e, nodes = cut_lineage(e), cut_lineage(nodes)


def strong_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component): strongly connected components, named by their smallest node."""
    index = cut_lineage(dense_index(nodes, "node", "id"))
    ids = lambda c: index.select(F.col("node").alias(c), F.col("id").alias(f"{c}_id"))
    e = edges.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct()
    e = cut_lineage(e.join(ids("src"), "src").join(ids("dst"), "dst").select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst")))
    left = index.select("id")
    done: list[DataFrame] = []
    runs: list[DataFrame] = []
    while True:
        e, left = _shrunk(e, left, done, runs)
        if not _any(left):
            break
        colour = largest_reacher(e, left)
        side = lambda x: colour.select(F.col("id").alias(x), F.col("c").alias(f"c_{x}"))
        e = cut_lineage(e.join(side("src"), "src").join(side("dst"), "dst").filter("c_src = c_dst").select("src", "dst"))
        back = largest_reacher(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")), left)
        found = cut_lineage(colour.join(back.select("id", F.col("c").alias("b")), "id").filter("b = c").select("id", "c"))
        done.append(found)
        left = cut_lineage(left.join(found, "id", "left_anti"))
        out = found.select("id")
        e = cut_lineage(e.join(out.withColumnRenamed("id", "src"), "src", "left_anti").join(out.withColumnRenamed("id", "dst"), "dst", "left_anti").select("src", "dst"))
    if not done:
        return index.select("node", F.col("node").alias("component"))
    labels = done[0]
    for part in done[1:]:
        labels = labels.unionByName(part)
    labels = cut_lineage(labels)
    for run in reversed(runs):  # an account of a run belongs to its two ends' component, if they have one
        end = lambda x: labels.select(F.col("id").alias(x), F.col("c").alias(f"c_{x}"))
        own = F.when(F.col("c_before") == F.col("c_after"), F.col("c_before")).otherwise(F.col("id"))
        labels = cut_lineage(labels.unionByName(run.join(end("before"), "before").join(end("after"), "after").select("id", own.alias("c"))))
    named = index.join(labels, "id")
    lowest = named.groupBy("c").agg(F.min("node").alias("component"))
    return named.join(lowest, "c").select("node", "component")
