"""Detector evaluation: confusion counts, ratios, ROC AUC, average precision,
PR curve, threshold choice, threshold grid, cost model, per-class report.

Input is a DataFrame with a 0/1 truth column, a 0/1 prediction column and a
score column. Curves are built from per-distinct-score counts (a partial
aggregate, bounded by the score grid) and a distributed prefix sum; nothing
runs as a single-task global window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.functions.constants import COST_FALSE_NEGATIVE_USD, COST_FALSE_POSITIVE_USD, MIN_RECALL
from ledgerscope.functions.money import ratio_4dp, ratio_dp, round_hu
from ledgerscope.operators.prefix import prefix_sums


def confusion_counts(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    yt, yp = F.col(y) == 1, F.col(p) == 1
    return df.agg(
        F.count_if(yt & yp).alias("true_positives"),
        F.count_if(~yt & yp).alias("false_positives"),
        F.count_if(~yt & ~yp).alias("true_negatives"),
        F.count_if(yt & ~yp).alias("false_negatives"),
    )


def metrics_from_counts(c: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(x) for x in ("true_positives", "false_positives", "true_negatives", "false_negatives"))
    prec = tp / F.greatest(tp + fp, F.lit(1))
    rec = tp / F.greatest(tp + fn, F.lit(1))
    f1 = F.lit(2.0) * prec * rec / F.greatest(prec + rec, F.lit(1e-9))
    f2 = F.lit(5.0) * prec * rec / F.greatest(F.lit(4.0) * prec + rec, F.lit(1e-9))
    return c.select(
        "true_positives",
        "false_positives",
        "true_negatives",
        "false_negatives",
        ratio_4dp(tp, tp + fp).alias("precision"),
        ratio_4dp(tp, tp + fn).alias("recall"),
        ratio_4dp(tn, tn + fp).alias("specificity"),
        round_hu(f1, 4).alias("f1_score"),
        round_hu(f2, 4).alias("f2_score"),
        ratio_4dp(fp, fp + tn).alias("false_positive_rate"),
        ratio_4dp(fn, fn + tp).alias("false_negative_rate"),
    )


def classification_metrics(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    return metrics_from_counts(confusion_counts(df, y, p))


def score_counts(df: DataFrame, y: str = "y_true", s: str = "y_score") -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(F.col(s).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")
    )


def _descending_cumulative(df: DataFrame, y: str, s: str) -> DataFrame:
    """tp/fp at threshold = each distinct score (score >= t), via prefix sums
    in descending score order."""
    sc = score_counts(df, y, s)
    return prefix_sums(sc, [F.col("score").desc()], ["pos", "neg"])


def pr_curve(df: DataFrame, y: str = "y_true", s: str = "y_score") -> DataFrame:
    cum = _descending_cumulative(df, y, s)
    total_pos = df.select(F.count_if(F.col(y) == 1)).scalar()
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    return cum.select(
        F.col("score").alias("threshold"),
        tp.alias("tp"),
        fp.alias("fp"),
        ratio_dp(tp, tp + fp).alias("precision"),
        F.when(total_pos > 0, ratio_dp(tp, total_pos)).otherwise(F.lit(1.0)).alias("recall"),
    )


def average_precision(df: DataFrame, y: str = "y_true", s: str = "y_score") -> DataFrame:
    """Step-wise AP = sum over thresholds of (recall step) x precision."""
    cum = _descending_cumulative(df, y, s)
    total_pos = df.select(F.count_if(F.col(y) == 1)).scalar()
    term = (F.col("pos") / total_pos) * (F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum")))
    return cum.agg(F.round(F.sum(term), 6).alias("average_precision"))


def roc_auc(df: DataFrame, y: str = "y_true", s: str = "y_score") -> DataFrame:
    """Rank-sum AUC with tied scores sharing their average rank:
    sum over scores of pos x (negatives below + negatives tied / 2), over P x N.
    Null when only one class is present."""
    sc = score_counts(df, y, s)
    cum = prefix_sums(sc, [F.col("score").asc()], ["neg"])
    below = F.col("neg_cum") - F.col("neg")
    tot = df.select(
        F.struct(F.count_if(F.col(y) == 1).alias("p"), F.count_if(F.col(y) != 1).alias("n")).alias("t")
    ).scalar()
    # the products outgrow BIGINT at some 1e9 positives times 1e10 negatives
    num = F.sum(F.col("pos").cast("decimal(17,0)") * (below * 2 + F.col("neg")).cast("decimal(20,0)")).cast("double")
    return cum.agg(
        F.when((tot["p"] > 0) & (tot["n"] > 0), F.round(num / (F.lit(2.0) * tot["p"] * tot["n"]), 6)).alias("roc_auc")
    )


def optimal_threshold(df: DataFrame, y: str = "y_true", s: str = "y_score", metric: str = "f2", min_recall: float = MIN_RECALL) -> DataFrame:
    """Best threshold by f1 / f2 / precision subject to recall >= min_recall;
    the lowest threshold wins ties (the first best in ascending order)."""
    cum = _descending_cumulative(df, y, s)
    total_pos = df.select(F.count_if(F.col(y) == 1)).scalar()
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    p = tp / (tp + fp)
    r = tp / total_pos
    if metric == "f1":
        m = F.lit(2.0) * p * r / F.greatest(p + r, F.lit(1e-9))
    elif metric == "f2":
        m = F.lit(5.0) * p * r / F.greatest(F.lit(4.0) * p + r, F.lit(1e-9))
    else:
        m = p
    cand = cum.select(F.col("score").alias("threshold"), p.alias("p"), r.alias("r"), m.alias("m")).filter(
        F.col("r") >= min_recall
    )
    return (
        cand.orderBy(F.desc("m"), F.asc("threshold"))
        .limit(1)
        .select(
            "threshold",
            round_hu(F.col("p"), 4).alias("precision"),
            round_hu(F.col("r"), 4).alias("recall"),
            round_hu(F.col("m"), 4).alias("score"),
        )
    )


def optimal_metrics(df: DataFrame, y: str = "y_true", s: str = "y_score", metric: str = "f2", min_recall: float = MIN_RECALL) -> DataFrame:
    """The full metrics at the best threshold (none where no threshold qualifies)."""
    best = optimal_threshold(df, y, s, metric, min_recall).select(F.max("threshold")).scalar()
    at = df.select(F.col(y).alias("y"), (F.col(s) >= best).cast("int").alias("p"))
    return classification_metrics(at, "y", "p").select(best.alias("threshold"), "*").filter("threshold is not null")


def threshold_sensitivity(df: DataFrame, y: str = "y_true", s: str = "y_score", points: int = 200, hi_q: float = 0.99) -> DataFrame:
    """Recall, precision and F1 on a grid of ``points`` thresholds from the
    minimum score to its p99, in one pass: each row finds the last grid point
    at or below its score (floor, then an exact correction against the same
    grid expression), rows are counted per grid index, and a suffix sum over
    the grid (``points`` rows) gives the counts at every threshold."""
    rng = df.select(F.struct(F.min(s).alias("lo"), F.round(F.percentile(s, hi_q), 9).alias("hi")).alias("r")).scalar()
    lo, hi = rng["lo"], rng["hi"]
    step = (hi - lo) / F.lit(float(points - 1))

    def t(k):
        return lo + k * step

    k0 = F.floor((F.col(s) - lo) / step).cast("long")
    k1 = k0 + F.when(t(k0 + 1) <= F.col(s), 1).otherwise(0) - F.when(t(k0) > F.col(s), 1).otherwise(0)
    kk = F.when(step > 0, F.least(k1, F.lit(points - 1))).otherwise(F.lit(points - 1))
    per = (
        df.select(kk.alias("k"), (F.col(y) == 1).alias("pos"))
        .filter(F.col("k") >= 0)
        .groupBy("k")
        .agg(F.count_if("pos").alias("pos"), F.count_if(~F.col("pos")).alias("neg"))
    )
    spark = df.sparkSession
    grid = F.broadcast(spark.range(points).withColumnRenamed("id", "k"))
    g = grid.join(per, "k", "left").na.fill(0, ["pos", "neg"])
    w = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # over `points` rows
    total_pos = df.select(F.count_if(F.col(y) == 1)).scalar()
    g = g.select("k", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"))
    prec = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))
    rec = F.col("tp") / F.greatest(total_pos, F.lit(1))
    return g.select(
        "k",
        F.round(t(F.col("k")), 9).alias("threshold"),
        "tp",
        "fp",
        ratio_dp(F.col("tp"), F.greatest(F.col("tp") + F.col("fp"), F.lit(1))).alias("precision"),
        ratio_dp(F.col("tp"), F.greatest(total_pos, F.lit(1))).alias("recall"),
        round_hu(F.lit(2.0) * prec * rec / F.greatest(prec + rec, F.lit(1e-9)), 6).alias("f1"),
    )


def detection_cost(counts: DataFrame, cost_fn: float = COST_FALSE_NEGATIVE_USD, cost_fp: float = COST_FALSE_POSITIVE_USD) -> DataFrame:
    fn, fp, tp = F.col("false_negatives"), F.col("false_positives"), F.col("true_positives")
    total = fn * F.lit(cost_fn) + fp * F.lit(cost_fp)
    return counts.select(
        "true_positives",
        "false_positives",
        "false_negatives",
        total.alias("total_cost_usd"),
        (fn * F.lit(cost_fn)).alias("missed_laundering_cost_usd"),
        (fp * F.lit(cost_fp)).alias("false_alert_cost_usd"),
        F.round(total / F.greatest(tp, F.lit(1)), 6).alias("cost_per_true_positive_usd"),
    )


def confusion_matrix(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Long form (true, pred, count, row share); the share window spans at
    most two rows per truth class."""
    c = df.groupBy(F.col(y).cast("int").alias("true_label"), F.col(p).cast("int").alias("pred_label")).agg(
        F.count(F.lit(1)).alias("count")
    )
    w = Window.partitionBy("true_label")
    return c.select("true_label", "pred_label", "count", ratio_dp(F.col("count"), F.sum("count").over(w)).alias("share"))


def classification_report(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Per-class precision / recall / F1 / support, plus macro and weighted averages."""
    c = confusion_counts(df, y, p)
    tp, fp, tn, fn = (F.col(x) for x in ("true_positives", "false_positives", "true_negatives", "false_negatives"))

    def cls(name, tp_, fp_, fn_):
        pr = tp_ / F.greatest(tp_ + fp_, F.lit(1))
        rc = tp_ / F.greatest(tp_ + fn_, F.lit(1))
        f1 = F.when(pr + rc > 0, F.lit(2.0) * pr * rc / (pr + rc)).otherwise(F.lit(0.0))
        return F.struct(F.lit(name).alias("label"), pr.alias("precision"), rc.alias("recall"), f1.alias("f1"), (tp_ + fn_).alias("support"))

    rows = c.select(F.array(cls("0", tn, fn, fp), cls("1", tp, fp, fn)).alias("a")).select(F.explode("a").alias("r")).select("r.*")
    n = F.sum("support")
    avgs = rows.agg(
        F.struct(
            F.lit("macro avg").alias("label"),
            F.avg("precision").alias("precision"),
            F.avg("recall").alias("recall"),
            F.avg("f1").alias("f1"),
            n.alias("support"),
        ).alias("m"),
        F.struct(
            F.lit("weighted avg").alias("label"),
            (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
            (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
            (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"),
            n.alias("support"),
        ).alias("w"),
    )
    allrows = rows.unionByName(avgs.select("m.*")).unionByName(avgs.select("w.*"))
    return allrows.select(
        "label",
        round_hu(F.col("precision"), 4).alias("precision"),
        round_hu(F.col("recall"), 4).alias("recall"),
        round_hu(F.col("f1"), 4).alias("f1"),
        F.col("support").cast("long").alias("support"),
    )


def prevalence(df: DataFrame, y: str = "y_true") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), ratio_dp(F.count_if(F.col(y) == 1), F.count(F.lit(1))).alias("prevalence"))
