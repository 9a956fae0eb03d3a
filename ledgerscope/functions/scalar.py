"""Column expressions for the scalar rules (all JVM-side, inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerscope.functions.constants import (
    ALERT_LEVEL_MULTIPLIERS,
    BATCH_RISK_LEVELS,
    CUSTOMER_RISK_BANDS,
    JURISDICTION_ORDINAL,
    SAR_PRIORITY_BANDS,
    ZSCORE_CLIP,
)


def trunc_hour_ntz(ts: Column) -> Column:
    """Start of the hour of a TIMESTAMP_NTZ, as TIMESTAMP_NTZ (no session zone
    involved; ``date_trunc`` would return a zoned TIMESTAMP)."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))


def week_start_date(ts: Column) -> Column:
    """Monday of the week of a TIMESTAMP_NTZ (pure date arithmetic)."""
    return F.date_sub(F.to_date(ts), F.weekday(ts))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts) / F.lit(23.0)


def day_of_week(ts: Column) -> Column:
    """Monday = 0 ... Sunday = 6, scaled to [0, 1]."""
    return F.weekday(ts) / F.lit(6.0)


def is_cross_border(origin: Column, dest: Column) -> Column:
    """1.0 when the countries differ; a null on either side counts as different."""
    return F.coalesce(origin != dest, F.lit(True)).cast("double")


def log_amount(amount: Column) -> Column:
    return F.log1p(amount)


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def zscore(x: Column, mean: Column, sd: Column, floor: float = 1e-6, bound: float = ZSCORE_CLIP) -> Column:
    """(x - mean) / max(sd, floor), clipped to [-bound, bound], null -> 0."""
    z = F.coalesce((x - mean) / F.greatest(sd, F.lit(floor)), F.lit(0.0))
    return clip(z, -bound, bound)


def jurisdiction_ordinal(level: Column) -> Column:
    m = F.create_map(*[x for k, v in JURISDICTION_ORDINAL.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(m[level], F.lit(1.0))


def alert_level(score: Column, threshold: Column) -> Column:
    """CRITICAL / HIGH / MEDIUM / LOW by score / threshold, compared after
    rounding the ratio to 9 places so boundary values land on the higher level."""
    ratio = F.round(score / threshold, 9)
    expr = None
    for name, mult in ALERT_LEVEL_MULTIPLIERS:
        cond = ratio >= F.lit(mult)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("LOW"))


def customer_risk_label(score: Column) -> Column:
    expr = F.when(score.isNull(), F.lit("UNKNOWN"))
    for name, lo in CUSTOMER_RISK_BANDS:
        expr = expr.when(score > F.lit(lo), F.lit(name))
    return expr.otherwise(F.lit("LOW"))


def sar_priority(score: Column) -> Column:
    expr = None
    for name, lo in SAR_PRIORITY_BANDS:
        cond = score > F.lit(lo)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("MEDIUM"))


def batch_risk_level(score: Column) -> Column:
    expr = None
    for name, lo, _ in BATCH_RISK_LEVELS:
        cond = score >= F.lit(lo)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def batch_risk_action(score: Column) -> Column:
    expr = None
    for _, lo, action in BATCH_RISK_LEVELS:
        cond = score >= F.lit(lo)
        expr = F.when(cond, F.lit(action)) if expr is None else expr.when(cond, F.lit(action))
    return expr


def round_amount_flag(amount_cents: Column) -> Column:
    return amount_cents % 10000 == 0


def money_text(x: Column) -> Column:
    """$1,234.56"""
    return F.concat(F.lit("$"), F.format_number(x, 2))


def date_text(d: Column) -> Column:
    return F.coalesce(F.date_format(d, "yyyy-MM-dd"), F.lit("N/A"))


def truncate_text(s: Column, n: int = 500) -> Column:
    return F.substring(s, 1, n)


def normalise(score: Column, fitted_max: Column, eps: float = 1e-9) -> Column:
    return score / (fitted_max + F.lit(eps))


def fuse(primary: Column, secondary: Column | None, w1: float = 0.6, w2: float = 0.4) -> Column:
    if secondary is None:
        return primary
    return F.lit(w1) * primary + F.lit(w2) * secondary


def deterministic_id(prefix: str, *cols: Column, width: int = 8) -> Column:
    """Replay-safe id: prefix + upper hex digest of the key columns."""
    key = F.concat_ws("\u0001", *[c.cast("string") for c in cols])
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(key, 256), 1, width)))
