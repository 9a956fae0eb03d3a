"""Mixing sources to target weights.

Every document gets a hash-random key; the rows are range-sorted by (source,
key); distributed running sums of sizes within each source meet the source's
budget at one document. Sources are taken whole once or twice where the budget
exceeds them, and the rest of the budget goes to the documents in front of the
cut; the one at the cut gives the words that are missing, so a source's taken
words equal its target rounded down.

Targets: the sources in code point order, null last, weigh 5, 2, 1, repeating,
and share 150 % of all words; no target exceeds twice its source, the excess is
shared again by weight. That is the level L where sum(min(2 size, L weight)) is
the budget, found by sorting the sources by size / weight.

Defined cases: null and empty texts have size 0 and give 0 words; a null source
is a source; equal documents differ by their id, and rows equal in id too share
the places that follow one another; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerscope.llm.common import WORD, fresh, table, written
from ledgerscope.llm.prefix import running_sums

WEIGHTS = (5, 2, 1)


def source_targets(sizes: DataFrame, share: tuple[int, int] = (3, 2), weights: tuple[int, ...] = WEIGHTS, most: int = 2) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of (source, size).

    ``share`` is the mix's size over all sizes as a fraction. One row a source;
    sources are names, so their number doesn't grow with the documents."""
    per = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * most)
    w = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    everything = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    s = per.select(
        "*",
        F.coalesce(F.sum("cap").over(earlier), F.lit(0)).alias("capped"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))).alias("open_weight"),
        F.sum("source_size").over(everything).alias("all_size"),
    )
    budget = F.col("all_size") * float(share[0]) / float(share[1])
    level = (budget - F.col("capped")) / F.col("open_weight")  # if this source and all after it are below their caps
    s = s.withColumn("level", level).withColumn("holds", F.col("level") * F.col("weight") <= F.col("cap"))
    s = s.withColumn("final", F.min(F.when(F.col("holds"), F.struct(F.col("capped"), F.col("level")))).over(everything))
    target = F.when(F.col("final").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("final.level") * F.col("weight")))
    return s.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 8, most: int = 2) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, text_hash) of every document."""
    size = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        size.alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), ident)).alias("key"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
    )
    rows = written(rows, "sizes")
    cut = running_sums(rows, "source", ["key", "doc_id", "text_hash"], "size")
    targets = source_targets(rows, most=most).select(F.col("source").alias("_s"), "source_size", "target")
    out = cut.join(targets, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    size, whole = F.col("source_size"), F.floor(F.col("target")).cast("long")
    epochs = F.when(size > 0, F.floor(whole / size)).otherwise(0).cast("long")
    rest = whole - epochs * size
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return out.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "text_hash")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 8) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document once for each
    full time it is taken; the one at a source's cut ends after its taken words.
    Rows equal in id, text and source have places that follow one another: each
    is dealt the words of a place, so together they give just what the plan takes."""
    n, h, src, size, deal, rows = fresh(docs.columns, "mix_id", "mix_hash", "mix_source", "mix_size", "mix_deal", "mix_rows")
    plan = mix(docs, id_col, text_col, source_col, seed).filter("taken > 0")
    keys = [F.col("doc_id").alias(n), F.col("text_hash").alias(h), F.col("source").alias(src), F.col("size").alias(size)]
    # a group of equal rows takes all, part and none of a copy: three different values at most
    plan = plan.groupBy(*keys, "taken").agg(F.count(F.lit(1)).alias("rows"))
    plan = plan.groupBy(n, h, src, size).agg(F.sort_array(F.collect_list(F.struct("taken", "rows")), False).alias(deal))
    plan = written(plan, "mix-plan")
    alone = (F.size(deal) == 1) & (F.element_at(deal, 1)["rows"] == 1)
    mine = docs.withColumn(rows, F.xxhash64(F.col(text_col)))
    same = F.col(id_col).eqNullSafe(F.col(n)) & (F.col(rows) == F.col(h)) & F.col(source_col).cast("string").eqNullSafe(F.col(src))
    row = F.struct(*docs.columns).alias("row")
    both = mine.join(plan.filter(alone), same).select(row, F.col(size).alias("size"), F.element_at(deal, 1)["taken"].alias("taken"))
    groups = plan.filter(~alone)
    if groups.limit(1).count():
        # rows are numbered within their group; a group of any size spreads over tasks
        whole = [F.col(f"row.`{c}`") for c, t in docs.dtypes if "map<" not in t]
        group = F.md5(F.to_json(F.array(F.col(n).cast("string"), F.col(h).cast("string"), F.col(src))))
        many = mine.join(groups, same).select(row, F.col(size).alias("size"), F.col(deal).alias("deal"), group.alias("group"), F.lit(1).alias("one"))
        many = running_sums(many.withColumn("order", F.xxhash64(*whole)), "group", ["order"], "one", "place")
        first, second = (F.coalesce(F.try_element_at("deal", F.lit(i))["rows"], F.lit(0)) for i in (1, 2))
        which = F.when(F.col("place") < first, 1).when(F.col("place") < first + second, 2).otherwise(3)
        both = both.unionByName(many.select("row", "size", F.coalesce(F.try_element_at("deal", which)["taken"], F.lit(0)).alias("taken")))
    both = both.filter("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.greatest("size", F.lit(1))).cast("int"))))
    words = (F.col("taken") - (F.col("copy") - 1) * F.col("size")).cast("int")
    old = F.col(f"row.`{text_col}`")
    text = F.when(words >= F.col("size"), old).otherwise(F.array_join(F.slice(F.regexp_extract_all(old, F.lit("[ \\t-\\r]*[^ \\t-\\r]+"), F.lit(0)), F.lit(1), words), ""))
    return both.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('8:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
ranked AS (
  SELECT *, [5, 2, 1][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)] AS weight
  FROM per),
s AS (
  SELECT *, 2 * source_size AS cap,
         coalesce(sum(2 * source_size) OVER before, 0) AS capped,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight,
         sum(source_size) OVER () AS all_size
  FROM ranked
  WINDOW before AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT *, (CAST(all_size AS DOUBLE) * 3.0::DOUBLE / 2.0::DOUBLE - CAST(capped AS DOUBLE)) / CAST(open_weight AS DOUBLE) AS level FROM s),
f AS (
  SELECT *, (SELECT arg_min(level, capped) FROM l WHERE level * CAST(weight AS DOUBLE) <= CAST(cap AS DOUBLE)) AS final FROM l),
t AS (
  SELECT source, source_size,
         CASE WHEN final IS NULL THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), final * CAST(weight AS DOUBLE)) END AS target
  FROM f),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS whole,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN (whole // source_size) * size ELSE 0 END
            + greatest(0, least(size, whole - CASE WHEN source_size > 0 THEN (whole // source_size) * source_size ELSE 0 END - prior)) AS BIGINT) AS taken
FROM c
"""
