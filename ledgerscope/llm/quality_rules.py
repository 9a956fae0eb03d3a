"""Quality rules by weak supervision.

Ten rules vote good (1), bad (-1) or abstain (0) on each document. The counts
of vote patterns (at most 3^10 rows, whatever the corpus) go to expectation-
maximisation: every rule gets the chance of each vote given a good or a bad
document, and each pattern a posterior probability of good. A document is kept
if the base rules of the contract hold and its posterior reaches ``keep_at``,
instead of having to pass every rule.

Defined cases: a null or empty text has zero words, fails the base and is not
kept; repeated rows and ids get a row each; an empty table gives no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm.common import map_arrow, slices, table, written
from ledgerscope.llm.text_stats import stats

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower", "n_punct", "n_lines", "n_closed_lines", "n_distinct_words", "n_bare_words"]


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the COUNTS of every whole text."""

    def run(batches):
        for b in slices(batches, 1):
            s = stats(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(s[c]) for c in COUNTS]], names=["id", *COUNTS])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    return map_arrow(d, run, f"id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _vote(value: Column, bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules: a vote from the counts alone."""
    sym, rep, dup = _ratio("n_symbols", "n_words"), _ratio("n_repeat_words", "n_words"), _ratio("n_dup_lines", "n_lines")
    mean, uniq, bare = _ratio("word_chars", "n_words"), _ratio("n_distinct_words", "n_words"), _ratio("n_bare_words", "n_words")
    upper = F.col("n_upper") / F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1))
    punct = _ratio("n_punct", "word_chars")
    closed = _ratio("n_closed_lines", "n_lines")
    return {
        "symbols": _vote(sym, sym > 0.2, sym <= 0.02),
        "repeats": _vote(rep, rep > 0.2, rep <= 0.02),
        "dup_lines": _vote(dup, (dup > 0.3) & (F.col("n_lines") > 3), (dup == 0) & (F.col("n_lines") > 1)),
        "distinct": _vote(uniq, (uniq < 0.25) & (F.col("n_words") >= 50), uniq >= 0.4),
        "word_length": _vote(mean, (mean < 2.5) | (mean > 14), mean.between(3.5, 11)),
        "upper_case": _vote(upper, upper > 0.5, upper <= 0.2),
        "punctuation": _vote(punct, punct > 0.12, punct <= 0.06),
        "bare_words": _vote(bare, bare > 0.15, bare <= 0.02),
        "line_ends": _vote(closed, (closed < 0.1) & (F.col("n_lines") > 2), closed >= 0.6),
        "length": _vote(F.col("n_words"), F.col("n_words") < 20, F.col("n_words") >= 40),
    }


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, prior: float = 0.8, outweigh: float = 5.0, rounds: int = 500, tolerance: float = 1e-9) -> dict:
    """Expectation-maximisation over vote patterns.

    ``patterns`` is (k, rules) of -1/0/1 and ``counts`` how many documents have
    each. A document starts as bad in so far as its bad votes, ``outweigh`` to
    one, exceed its good ones: rules look for one kind of fault each, so most of
    them vote good on a bad document as well. One pseudo-count a vote; ends when
    the log-likelihood a document changes by less than ``tolerance``.
    """
    n_rules = patterns.shape[1]
    if not len(patterns):
        return {"prior": prior, "chance": np.full((2, n_rules, 3), 1 / 3)}
    counts = counts.astype(float)
    start = (patterns > 0).sum(1) - outweigh * (patterns < 0).sum(1)
    post = 1 / (1 + np.exp(-start - np.log(prior / (1 - prior))))
    last = -np.inf
    for _ in range(rounds):
        prior = float(np.clip((counts @ post + 1) / (counts.sum() + 2), 1e-3, 1 - 1e-3))
        chance = np.empty((2, n_rules, 3))
        for y, w in ((0, counts * (1 - post)), (1, counts * post)):
            for v in (-1, 0, 1):
                chance[y, :, v + 1] = (w @ (patterns == v) + 1) / (w.sum() + 3)
        log = np.array([np.log(chance[y])[np.arange(n_rules), patterns + 1].sum(1) for y in (0, 1)])
        log += np.log([1 - prior, prior])[:, None]
        total = np.logaddexp(log[0], log[1])
        post = np.exp(log[1] - total)
        now = counts @ total / counts.sum()
        if abs(now - last) < tolerance:
            break
        last = now
    if (chance[1, :, 2] - chance[0, :, 2]).sum() < 0:  # the classes are named by the rules' votes
        prior, chance = 1 - prior, chance[::-1]
    return {"prior": prior, "chance": chance}


def posterior(model: dict, names: list[str]) -> Column:
    """P(good | votes) as an expression over the vote columns."""
    log = F.lit(float(np.log(model["prior"] / (1 - model["prior"]))))
    for i, n in enumerate(names):
        w = np.log(model["chance"][1, i] / model["chance"][0, i])
        log = log + F.when(F.col(n) == -1, float(w[0])).when(F.col(n) == 1, float(w[2])).otherwise(float(w[1]))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-log))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.5) -> DataFrame:
    """Counts, votes, posterior and verdict of every document."""
    rules = votes()
    rows = written(document_counts(docs, id_col, text_col).select("*", *[v.cast("int").alias(f"v_{k}") for k, v in rules.items()]), "rules")
    names = [f"v_{k}" for k in rules]
    seen = rows.groupBy(*names).count().collect()  # at most 3^10 rows
    model = fit_label_model(np.array([[r[n] for n in names] for r in seen], int).reshape(-1, len(names)), np.array([r["count"] for r in seen], float))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = rows.withColumn("base_failed", failed).withColumn("posterior", posterior(model, names))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_at))
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")
