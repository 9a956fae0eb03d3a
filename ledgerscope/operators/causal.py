"""Causal and what-if analysis: difference-in-differences with analytic and
bootstrap intervals, threshold and rule what-ifs, one-pass sweeps.

Every estimator is a handful of grouped aggregates (four DiD cells, bins of
scores); scenario tables are tiny and bounded by their definition (21 sweep
points, 4 rules), so they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.functions.money import (
    fmt_fixed,
    fmt_signed_fixed,
    fmt_signed_thousands,
    fmt_thousands,
    idiv,
    round_hu,
)
from ledgerscope.operators.prefix import prefix_sums

# --- fixed values: named new-rule scenarios (name, affected fraction, expected %) ----
RULE_SCENARIOS = [
    ("Flag all wire transfers > $50K from PA/KY", 0.08, 25.0),
    ("Flag all cash deposits near $10K (structuring)", 0.15, 35.0),
    ("Flag rapid succession transfers (< 1 hr apart)", 0.12, 20.0),
    ("Flag all TBML trade payment anomalies", 0.06, 18.0),
]
SWEEP_PCT = list(range(-50, 55, 5))


def did_cells(df: DataFrame, outcome: str, treated: str, policy_date: str, ts: str = "timestamp") -> DataFrame:
    """Per (treated, post) cell: rows, outcome sum, outcome sample variance."""
    y = F.col(outcome).cast("double")
    return df.select(
        F.col(treated).cast("int").alias("treated"),
        (F.col(ts) >= F.lit(policy_date).cast("timestamp_ntz")).cast("int").alias("post"),
        y.alias("y"),
    ).groupBy("treated", "post").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.var_samp("y").alias("v")
    )


def did_effect(df: DataFrame, outcome: str = "is_suspicious", treated: str = "structuring_flag", policy_date: str = "1998-07-01") -> DataFrame:
    """2x2 DiD: ATT = (post_treated - pre_treated) - (post_control - pre_control),
    with the analytic standard error sqrt(sum of cell variance / n)."""
    cells = did_cells(df, outcome, treated, policy_date)

    def cell(t, p, col):
        return F.max(F.when((F.col("treated") == t) & (F.col("post") == p), F.col(col)))

    one = cells.agg(
        *[cell(t, p, "n").alias(f"n_{t}{p}") for t in (0, 1) for p in (0, 1)],
        *[(cell(t, p, "s") / cell(t, p, "n")).alias(f"m_{t}{p}") for t in (0, 1) for p in (0, 1)],
        F.sqrt(F.sum(F.col("v") / F.col("n"))).alias("se"),
        (F.sum(F.when(F.col("post") == 0, F.col("s"))) / F.sum(F.when(F.col("post") == 0, F.col("n")))).alias("baseline_mean"),
    )
    att = (F.col("m_11") - F.col("m_10")) - (F.col("m_01") - F.col("m_00"))
    return one.select(
        *[F.col(f"n_{t}{p}") for t in (0, 1) for p in (0, 1)],
        *[F.round(F.col(f"m_{t}{p}"), 6).alias(f"mean_{t}{p}") for t in (0, 1) for p in (0, 1)],
        F.round(att, 6).alias("ate"),
        F.round(F.col("se"), 6).alias("se"),
        F.round(att - F.lit(1.96) * F.col("se"), 6).alias("ate_lower"),
        F.round(att + F.lit(1.96) * F.col("se"), 6).alias("ate_upper"),
        F.round(att / F.greatest(F.abs("baseline_mean"), F.lit(1e-9)) * 100.0, 6).alias("relative_effect_pct"),
    )


def interpret(rule: str, ate, lower, upper, relative):
    significant = ~((lower <= 0) & (upper >= 0))
    direction = F.when(ate < 0, F.lit("reduced")).otherwise(F.lit("increased"))
    sig = F.when(significant, F.lit("statistically significant")).otherwise(
        F.lit("not statistically significant at 95% confidence")
    )
    return F.concat(
        F.lit(f"Implementing '{rule}' is estimated to have "),
        direction,
        F.lit(" suspicious activity by "),
        fmt_fixed(F.abs(relative), 1),
        F.lit("% (ATE="),
        fmt_fixed(ate, 4),
        F.lit(", 95% CI ["),
        fmt_fixed(lower, 4),
        F.lit(", "),
        fmt_fixed(upper, 4),
        F.lit("]). This effect is "),
        sig,
        F.lit("."),
    )


def rule_effect(
    df: DataFrame,
    rule_name: str = "Enhanced Structuring Rule",
    policy_date: str = "1998-07-01",
    treated: str = "structuring_flag",
    outcome: str = "is_suspicious",
) -> DataFrame:
    if treated not in df.columns:
        if "risk_score" not in df.columns:
            raise ValueError(f"treatment column {treated!r} is missing and there is no risk_score to derive it")
        med = df.select(F.percentile("risk_score", 0.5)).scalar()
        df = df.withColumn(treated, F.col("risk_score") > med)
    d = did_effect(df, outcome, treated, policy_date)
    return d.select(
        F.lit("DiD").alias("estimator"),
        F.lit(rule_name).alias("treatment"),
        F.lit(outcome).alias("outcome"),
        "ate",
        "ate_lower",
        "ate_upper",
        "relative_effect_pct",
        interpret(rule_name, F.col("ate"), F.col("ate_lower"), F.col("ate_upper"), F.col("relative_effect_pct")).alias(
            "interpretation"
        ),
    )


def did_bootstrap(
    df: DataFrame,
    outcome: str = "is_suspicious",
    treated: str = "structuring_flag",
    policy_date: str = "1998-07-01",
    replicates: int = 500,
    seed: int = 42,
    method: str = "cells",
) -> DataFrame:
    """Bootstrap CI for the DiD estimate.

    ``cells`` (binary outcome): a row bootstrap of the whole table only moves
    the four cells' sizes (multinomial) and successes (binomial given the
    size), so replicates are drawn from the cells' sufficient statistics -- one
    grouped aggregate over the data, 8 numbers fitted, the same bootstrap
    distribution as resampling rows.

    ``poisson`` (any outcome): each row gets a Poisson(1) weight per replicate
    from a hash of (row id, replicate, seed); each task folds the replicates'
    weighted sums into one array, so no row is copied.
    """
    import numpy as np

    if method == "cells":
        cells = did_cells(df, outcome, treated, policy_date).collect()  # at most 4 rows
        key = {(r["treated"], r["post"]): (int(r["n"]), float(r["s"])) for r in cells}
        order = [(1, 1), (1, 0), (0, 1), (0, 0)]
        n = np.array([key.get(c, (0, 0.0))[0] for c in order])
        s = np.array([key.get(c, (0, 0.0))[1] for c in order])
        p = np.divide(s, n, out=np.zeros(4), where=n > 0)
        rng = np.random.default_rng(seed)
        sizes = rng.multinomial(int(n.sum()), n / max(n.sum(), 1), size=replicates)
        succ = rng.binomial(sizes, p)
        with np.errstate(invalid="ignore", divide="ignore"):
            m = succ / sizes
        att = (m[:, 0] - m[:, 1]) - (m[:, 2] - m[:, 3])
        att = att[np.isfinite(att)]
        point = float((p[0] - p[1]) - (p[2] - p[3]))
        se = float(np.std(att)) if att.size else float("nan")
        spark = df.sparkSession
        return spark.createDataFrame(
            [(int(att.size), round(point, 6), round(se, 6), round(point - 1.96 * se, 6), round(point + 1.96 * se, 6))],
            "replicates long, ate double, se double, ate_lower double, ate_upper double",
        )
    base = df.select(
        F.col(treated).cast("int").alias("treated"),
        (F.col("timestamp") >= F.lit(policy_date).cast("timestamp_ntz")).cast("int").alias("post"),
        F.col(outcome).cast("double").alias("y"),
        F.xxhash64(F.col("transaction_id"), F.lit(seed)).alias("_h"),
    )
    folded = base.mapInArrow(_poisson_folder(replicates), "sums array<double>")  # one row a task
    sums = folded.select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()  # 8 a replicate
    cells = np.zeros(8 * replicates)
    for r in sums:
        cells[r["at"]] = r["x"]
    weight, total = cells.reshape(2, 4, replicates)  # cell: 2 treated + post
    with np.errstate(invalid="ignore", divide="ignore"):
        m = total / weight
    att = (m[3] - m[2]) - (m[1] - m[0])
    att = att[np.isfinite(att)]
    se = round(float(np.std(att)), 6) if att.size else float("nan")
    point = did_effect(df, outcome, treated, policy_date).select("ate").scalar()
    return df.sparkSession.range(1).select(
        F.lit(int(att.size)).cast("long").alias("replicates"),
        point.alias("ate"),
        F.lit(se).alias("se"),
        F.round(point - F.lit(1.96 * se), 6).alias("ate_lower"),
        F.round(point + F.lit(1.96 * se), 6).alias("ate_upper"),
    )


def _poisson_folder(replicates: int):
    """Task function: rows (treated, post, y, hash) -> the task's weighted counts and sums of
    y for the four cells and all replicates, folded batch by batch into one array. A weight
    is Poisson(1) by the inverse of its distribution at 16 bits of splitmix64(hash, replicate)."""

    def run(batches):
        import math

        import numpy as np
        import pyarrow as pa

        ends = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)])
        table = np.searchsorted(ends, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)
        step = np.arange(1, replicates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        acc = np.zeros((8, replicates))
        for b in batches:
            t, p = (np.asarray(b.column(i).fill_null(0), dtype=np.int64) for i in (0, 1))
            y = np.asarray(b.column(2).fill_null(float("nan")), dtype=np.float64)
            h = np.asarray(b.column(3), dtype=np.int64).view(np.uint64)
            cell = np.where(np.isnan(y), -1, 2 * t + p)
            y = np.nan_to_num(y)
            for at in range(0, len(h), 2048):
                z = h[at : at + 2048, None] + step
                z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                w = table[(z ^ (z >> np.uint64(31))) >> np.uint64(48)]
                mine = (cell[at : at + 2048] == np.arange(4)[:, None]).astype(np.float32)
                acc[:4] += mine @ w
                acc[4:] += (mine * y[at : at + 2048].astype(np.float32)) @ w
        yield pa.RecordBatch.from_arrays([pa.array([acc.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])

    return run


def fallback_scores(txns: DataFrame, current: float, seed: int = 42) -> DataFrame:
    """Scores for a what-if without a fitted detector: suspicious transfers get
    a value in [current, 5 x current), others in [0, 0.8 x current), from a
    seeded hash of the id (replayable, no random generator)."""
    u = F.conv(F.substring(F.md5(F.concat(F.col("transaction_id"), F.lit(f":{seed}"))), 1, 13), 16, 10).cast("double") / F.lit(
        float(16**13)
    )
    score = F.when(F.col("is_suspicious"), F.lit(current) + u * F.lit(4.0 * current)).otherwise(u * F.lit(0.8 * current))
    return txns.select("transaction_id", "amount_cents", "is_suspicious", score.alias("combined_score"))


def whatif_threshold(scores: DataFrame, current: float | None = None, new: float | None = None, new_ratio: float = 0.9) -> DataFrame:
    """Alerts and flagged USD under the current and a proposed threshold, in
    one pass. Defaults: current = the fitted threshold column, new = 0.9 x it."""
    cur = F.lit(current) if current is not None else F.col("threshold")
    nxt = F.lit(new) if new is not None else cur * F.lit(new_ratio)
    s = scores.select("combined_score", "amount_cents", cur.alias("cur"), nxt.alias("new"))
    a = s.agg(
        F.first("cur").alias("current_threshold"),
        F.first("new").alias("new_threshold"),
        F.count_if(F.col("combined_score") >= F.col("cur")).alias("baseline_alerts"),
        F.count_if(F.col("combined_score") >= F.col("new")).alias("counterfactual_alerts"),
        F.coalesce(F.sum(F.when(F.col("combined_score") >= F.col("cur"), F.col("amount_cents"))), F.lit(0)).alias("b_c"),
        F.coalesce(F.sum(F.when(F.col("combined_score") >= F.col("new"), F.col("amount_cents"))), F.lit(0)).alias("c_c"),
    )
    delta = F.col("counterfactual_alerts") - F.col("baseline_alerts")
    dpct = delta / F.greatest(F.col("baseline_alerts"), F.lit(1)) * 100.0
    diff_dollars = idiv(F.abs(F.col("c_c") - F.col("b_c")) + 50, F.lit(100)) * F.when(F.col("c_c") < F.col("b_c"), -1).otherwise(1)
    lower = F.col("new_threshold") < F.col("current_threshold")
    chg = F.abs(F.col("current_threshold") - F.col("new_threshold")) / F.col("current_threshold") * 100.0
    rec = F.when(
        lower,
        F.concat(
            F.lit("Lowering threshold by "), fmt_fixed(chg, 1), F.lit("% would increase alerts by "),
            fmt_signed_thousands(delta), F.lit(" ("), fmt_signed_fixed(dpct, 1), F.lit("%), capturing USD "),
            fmt_signed_thousands(diff_dollars), F.lit(" more in flagged volume. Consider analyst capacity before implementing."),
        ),
    ).otherwise(
        F.concat(
            F.lit("Raising threshold by "), fmt_fixed(chg, 1), F.lit("% would reduce alerts by "),
            fmt_thousands(F.abs(delta)), F.lit(" ("), fmt_fixed(dpct, 1), F.lit("%), but risks missing USD "),
            fmt_thousands(F.abs(diff_dollars)), F.lit(" in suspicious activity."),
        )
    )
    scen = F.concat(
        F.lit("Threshold "), F.when(lower, F.lit("lower")).otherwise(F.lit("higher")), F.lit(": "),
        fmt_fixed(F.col("current_threshold"), 5), F.lit(" → "), fmt_fixed(F.col("new_threshold"), 5),
    )
    return a.select(
        scen.alias("scenario"),
        "baseline_alerts",
        "counterfactual_alerts",
        delta.alias("delta_alerts"),
        round_hu(dpct, 2).alias("delta_pct"),
        (F.col("b_c") / F.lit(100.0)).alias("baseline_flagged_amount"),
        (F.col("c_c") / F.lit(100.0)).alias("counterfactual_flagged_amount"),
        rec.alias("recommendation"),
    )


def whatif_sweep(scores: DataFrame, current: float | None = None) -> DataFrame:
    """21 thresholds (-50% .. +50% of the current one) in one pass: each row
    counts the sweep points at or below its score (21 comparisons, no join),
    rows are counted per point, and windows over the 21 points give the
    suffix sums and the baseline."""

    cur = F.lit(current) if current is not None else F.col("threshold")
    pts = [(i, p) for i, p in enumerate(SWEEP_PCT)]

    def t(p):
        return cur * (F.lit(1.0) + F.lit(p) / F.lit(100.0))

    k = sum(F.when(F.col("combined_score") >= t(p), 1).otherwise(0) for _, p in pts) - 1
    per = scores.select(k.alias("k"), "amount_cents", cur.alias("_t")).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("c"), F.max("_t").alias("_t")
    )
    spark = scores.sparkSession
    grid = spark.createDataFrame(pts, "k int, pct_change int")
    everything = Window.partitionBy()  # over at most 22 rows
    per = per.select("*", F.max("_t").over(everything).alias("cur"))
    g = F.broadcast(grid).join(per.filter(F.col("k") >= 0), "k", "left").na.fill(0, ["n", "c"])
    g = g.select("k", "pct_change", "n", "c", F.max("cur").over(everything).alias("cur"))
    w = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # 21 rows
    g = g.select("k", "pct_change", "cur", F.sum("n").over(w).alias("alerts"), F.sum("c").over(w).alias("cents"))
    g = g.select("*", F.max(F.when(F.col("pct_change") == 0, F.col("alerts"))).over(everything).alias("_base"))
    return g.select(
        "pct_change",
        F.round(F.col("cur") * (F.lit(1.0) + F.col("pct_change") / F.lit(100.0)), 9).alias("new_threshold"),
        "alerts",
        round_hu((F.col("alerts") - F.col("_base")) / F.greatest(F.col("_base"), F.lit(1)) * 100.0, 2).alias("delta_pct"),
        (F.col("cents") / F.lit(100.0)).alias("flagged_amount"),
    )


def first_k_sums(txns: DataFrame, ks: list[int]) -> list[int]:
    """Cents of the first k transfers in (timestamp, transaction_id) order, for each k.

    A cut search: counts a day find the day in which the k-th transfer lies, counts a
    second that day's second, and only that second's rows are sorted. What reaches
    the driver is one row a step."""
    at = txns.select(F.to_date("timestamp").alias("d"), F.unix_timestamp("timestamp").alias("s"), "timestamp", "transaction_id", "amount_cents")

    def cut(counts: DataFrame, key: str, over, wanted: dict) -> dict:
        """(key of the border, rows, cents before it) of each wanted place; counts: (key, n, c) by day or second."""
        run = counts.select("*", F.sum("n").over(over).alias("cn"), F.sum("c").over(over).alias("cc"))
        cols = []
        for i, (k, where) in wanted.items():
            cols.append(F.min(F.when(where & (F.col("cn") > k), F.struct(key, (F.col("cn") - F.col("n")).alias("n"), (F.col("cc") - F.col("c")).alias("c")))).alias(f"b{i}"))
            cols.append(F.max(F.when(where, F.struct("cn", "cc"))).alias(f"e{i}"))
        row = run.agg(*cols).first()
        return {i: (row[f"b{i}"], row[f"e{i}"]) for i in wanted}

    per = lambda df, *keys: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("amount_cents"), F.lit(0)).alias("c"))
    out = [0] * len(ks)
    days = cut(per(at, "d"), "d", Window.orderBy("d"), {i: (k, F.lit(True)) for i, k in enumerate(ks)})  # one row a day
    left = {}
    for i, k in enumerate(ks):
        border, whole = days[i]
        if border is None:
            out[i] = int(whole["cc"]) if whole else 0  # k is all there are, or more
        else:
            out[i], left[i] = int(border["c"]), (k - border["n"], border["d"])
    if not left:
        return out
    day_rows = at.filter(F.col("d").isin(sorted({d for _, d in left.values()})))
    seconds = cut(per(day_rows, "d", "s"), "s", Window.partitionBy("d").orderBy("s"), {i: (k, F.col("d") == F.lit(d)) for i, (k, d) in left.items()})
    for i, (k, _) in left.items():
        border, _whole = seconds[i]
        out[i] += int(border["c"])
        rest = k - border["n"]
        if rest:
            rows = at.filter(F.col("s") == border["s"]).select("timestamp", "transaction_id", "amount_cents", F.lit(1).alias("_one"))
            ranked = prefix_sums(rows, [F.col("timestamp"), F.col("transaction_id")], ["_one"])
            out[i] += int(ranked.filter(F.col("_one_cum") <= rest).agg(F.coalesce(F.sum("amount_cents"), F.lit(0))).first()[0])
    return out


def _rule_parts(txns: DataFrame, scenarios: list[tuple[str, float, float]]):
    """Shared pass for rule what-ifs: totals, k per scenario, and the sum of the
    first k amounts in (timestamp, transaction_id) order for each k."""
    agg = txns.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_suspicious").alias("current_flagged"),
        F.coalesce(F.sum(F.when(F.col("is_suspicious"), F.col("amount_cents"))), F.lit(0)).alias("b_c"),
    )
    ks = [(F.col("total") * F.lit(frac) * F.lit(pct / 100.0)).cast("long") for _, frac, pct in scenarios]
    k_row = agg.select(*[k.alias(f"k{i}") for i, k in enumerate(ks)]).first()
    sums = first_k_sums(txns, [k_row[f"k{i}"] for i in range(len(ks))])
    return agg, ks, {f"e{i}": F.lit(x).cast("long") for i, x in enumerate(sums)}


def _rule_row(agg: DataFrame, name: str, frac: float, k, extra) -> DataFrame:
    pct = k * 100.0 / F.greatest(F.col("current_flagged"), F.lit(1))
    extra_dollars = idiv(extra + 50, F.lit(100))
    return agg.select(
        F.lit(f"New rule: '{name}'").alias("scenario"),
        F.col("current_flagged").alias("baseline_alerts"),
        (F.col("current_flagged") + k).alias("counterfactual_alerts"),
        k.alias("delta_alerts"),
        round_hu(pct, 2).alias("delta_pct"),
        (F.col("b_c") / F.lit(100.0)).alias("baseline_flagged_amount"),
        ((F.col("b_c") + extra) / F.lit(100.0)).alias("counterfactual_flagged_amount"),
        F.concat(
            F.lit(f"Adding '{name}' targeting {frac * 100:.0f}% of transactions is estimated to uncover "),
            fmt_thousands(k),
            F.lit(" additional alerts (+"),
            fmt_fixed(pct, 1),
            F.lit("%). Estimated incremental flagged amount: USD "),
            fmt_thousands(extra_dollars),
            F.lit("."),
        ).alias("recommendation"),
    )


def whatif_rule(txns: DataFrame, rule_name: str, affected_fraction: float = 0.20, expected_reduction_pct: float = 15.0) -> DataFrame:
    """New-rule what-if: catches = int(n x fraction x pct / 100); the extra
    amount is the sum of the first k transfers in (timestamp, id) order."""
    agg, ks, extras = _rule_parts(txns, [(rule_name, affected_fraction, expected_reduction_pct)])
    return _rule_row(agg, rule_name, affected_fraction, ks[0], extras["e0"])


def whatif_rules_table(txns: DataFrame, scenarios: list[tuple[str, float, float]] | None = None) -> DataFrame:
    scenarios = scenarios or RULE_SCENARIOS
    agg, ks, extras = _rule_parts(txns, scenarios)
    out = None
    for i, (name, frac, _) in enumerate(scenarios):
        r = _rule_row(agg, name, frac, ks[i], extras[f"e{i}"]).select(
            F.lit(name[:45]).alias("rule"),
            F.col("counterfactual_alerts").alias("new_alerts"),
            F.col("delta_alerts").alias("delta"),
            "delta_pct",
            "counterfactual_flagged_amount",
        )
        out = r if out is None else out.unionByName(r)
    return out
