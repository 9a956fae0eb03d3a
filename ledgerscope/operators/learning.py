"""Fitted detectors and models on Spark ML, re-aimed from single-machine
neural models (see README): a linear (PCA) autoencoder for reconstruction
error, a real-vs-column-permuted classifier as the second detector, exact
per-feature attribution of the reconstruction error and sampled Shapley values
of the second detector, interpolation between nearest neighbours
for minority oversampling, a 2-D projection, k-means background centres, a
class-weighted customer risk classifier and a cross-fitted doubly robust
effect estimate.

Models are fitted by Spark ML (distributed aggregation over partitions);
small fitted matrices (9 x k loadings) are applied as literal column
arithmetic, which stays inside whole-stage codegen.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, Bucketizer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions import scalar as S
from ledgerscope.functions.constants import NODE_FEATURES, TRANSACTION_FEATURES
from ledgerscope.functions.quantile import grid_quantiles
from ledgerscope.operators.features import apply_standardizer, fit_standardizer, invert_standardizer, transaction_features
from ledgerscope.operators.neighbours import nearest
from ledgerscope.operators.prefix import prefix_sums
from ledgerscope.operators.sampling import hash_place, with_split
from ledgerscope.session import cut_lineage, passing_cuts

FEATS = TRANSACTION_FEATURES


def training_frame(txns: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Features + truth + train/test split (exact per-class 85/15), written
    once as a checkpoint: every fit below reads it several times. ``carried`` columns of the
    transfers come along as if joined by id."""
    held = [c for c in FEATS if c != "log_amount"]  # which follows from the amount
    with passing_cuts(txns.sparkSession) as keep:
        places = cut_lineage(txns.select("is_suspicious", hash_place().alias("_place")))
        rows = transaction_features(txns, keep=["is_suspicious", *carried]).withColumn("_place", hash_place())
        frame = keep(with_split(rows, places, carried=carried).select("transaction_id", "is_suspicious", *carried, *held, "split"))
    frame = frame.withColumn("log_amount", F.coalesce(S.log_amount(F.col("amount_usd")), F.lit(0.0)))
    return frame.select("transaction_id", "is_suspicious", *carried, *FEATS, "split")


def fit_scaler(frame: DataFrame) -> DataFrame:
    """Standardiser fitted on normal training rows (population sd)."""
    normals = frame.filter((F.col("split") == "train") & ~F.col("is_suspicious"))
    return fit_standardizer(normals, FEATS, population=True)


def scaled_features(frame: DataFrame, model: DataFrame | None = None, carried: Sequence[str] = ()) -> DataFrame:
    model = model if model is not None else cut_lineage(fit_scaler(frame))  # one row, read by every pass
    return apply_standardizer(frame, model, FEATS, ["transaction_id", "is_suspicious", *carried, "split"])


def unscaled_features(scaled: DataFrame, model: DataFrame) -> DataFrame:
    return invert_standardizer(scaled, model, FEATS, ["transaction_id", "is_suspicious", "split"])


def logistic_probability(model, cols: list[str]):
    """P(class 1) of a fitted binary logistic model as a column expression
    (coefficients as literals: no model object is shipped to the tasks)."""
    w = model.coefficients.toArray()
    b = float(model.intercept)
    margin = sum((F.col(c) * float(wi) for c, wi in zip(cols, w)), F.lit(b))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def _assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def fit_pca_loadings(scaled: DataFrame, k: int = 4) -> np.ndarray:
    """Principal directions of the normal training rows (9 x k)."""
    normals = scaled.filter((F.col("split") == "train") & ~F.col("is_suspicious"))
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(_assemble(normals, FEATS))
    return model.pc.toArray()


def reconstruction(scaled: DataFrame, loadings: np.ndarray) -> DataFrame:
    """Per-feature squared residual (x - x V V^T)^2 / d; they sum to the score."""
    d, k = loadings.shape
    z = [sum(F.col(FEATS[i]) * float(loadings[i, j]) for i in range(d)) for j in range(k)]
    proj = scaled.select("*", *[z[j].alias(f"_z{j}") for j in range(k)])
    xhat = [sum(F.col(f"_z{j}") * float(loadings[i, j]) for j in range(k)) for i in range(d)]
    res = [F.pow(F.col(FEATS[i]) - xhat[i], 2) / float(d) for i in range(d)]
    return proj.select("transaction_id", "is_suspicious", "split", *[res[i].alias(f"r_{FEATS[i]}") for i in range(d)])


def reconstruction_error(loadings: np.ndarray):
    """The score alone, as one column over the scaled features."""
    d, k = loadings.shape
    z = [sum(F.col(FEATS[i]) * float(loadings[i, j]) for i in range(d)) for j in range(k)]
    return sum(F.pow(F.col(FEATS[i]) - sum(z[j] * float(loadings[i, j]) for j in range(k)), 2) for i in range(d)) / float(d)


def anomaly_scores(txns: DataFrame, k: int = 4) -> DataFrame:
    """Reconstruction-error score, normalised by its max on training rows; the
    threshold is the p95 of normal training scores (on a 1e-6 grid)."""
    frame = training_frame(txns)
    sc = scaled_features(frame)
    rec = reconstruction(sc, fit_pca_loadings(sc, k))
    score = sum(F.col(f"r_{f}") for f in FEATS)
    s = rec.select("transaction_id", "is_suspicious", "split", F.round(score, 9).alias("vae_score"))
    vmax = s.filter(F.col("split") == "train").select(F.max("vae_score")).scalar()
    s = s.withColumn("combined_score", F.round(F.col("vae_score") / (vmax + F.lit(1e-9)), 6))
    thr = s.filter((F.col("split") == "train") & ~F.col("is_suspicious")).select(F.percentile("combined_score", 0.95)).scalar()
    return s.withColumn("threshold", thr).withColumn("is_flagged", (F.col("combined_score") >= F.col("threshold")).cast("int"))


def anomaly_attribution(txns: DataFrame, k: int = 4) -> DataFrame:
    """Long form (transaction_id, feature, attribution); per row the
    attributions sum to the reconstruction score."""
    frame = training_frame(txns)
    sc = scaled_features(frame)
    return attribution_long(reconstruction(sc, fit_pca_loadings(sc, k)))


def attribution_long(rec: DataFrame) -> DataFrame:
    stack = ", ".join(f"'{f}', r_{f}" for f in FEATS)
    return rec.select("transaction_id", F.expr(f"stack({len(FEATS)}, {stack}) as (feature, attribution)"))


def feature_importance(attribution: DataFrame) -> DataFrame:
    return (
        attribution.groupBy("feature")
        .agg(F.round(F.avg(F.abs("attribution")), 9).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def permuted_rows(scaled: DataFrame, seed: int = 7) -> DataFrame:
    """Rows whose feature columns are permuted against each other: every row gets
    a place in a hash order, and column i of the row at place p goes to the new
    row at place p + i n / k (k columns, n rows, around the end). Marginals are
    kept exactly, the dependence between columns is broken, and the result does
    not depend on partitions or batches. One shuffle of narrow rows."""
    n_cols = len(FEATS)
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in FEATS])
    base = scaled.select(*FEATS, h.alias("_h"), F.lit(1).cast("long").alias("_one"))
    placed = prefix_sums(base, [F.col("_h"), *[F.col(c) for c in FEATS]], ["_one"])
    n = scaled.select(F.count(F.lit(1))).scalar()
    shift = lambda i: F.call_function("div", n * i, F.lit(n_cols))
    parts = F.array(*[F.struct(F.lit(i).alias("c"), F.pmod(F.col("_one_cum") - 1 + shift(i), n).alias("p"), F.col(c).alias("v")) for i, c in enumerate(FEATS)])
    long = placed.select(F.explode(parts).alias("x")).select("x.*")
    return long.groupBy("p").agg(*[F.max(F.when(F.col("c") == i, F.col("v"))).alias(c) for i, c in enumerate(FEATS)]).select(*FEATS)


#: Bits of a bin's number in a packed row; numbers begin at 1, so a packed row is never 0.
BIN_BITS = 6
#: Candidate bins of a feature, as many as Spark's trees try by default.
MAX_BINS = 32
#: Neighbouring places that one task puts together.
PLACES = 1 << 16


def bin_edges(rows: DataFrame) -> list[list[float]]:
    """Inner edges of each feature's bins: midpoints of its values where they are at most
    MAX_BINS, else quantiles of all rows (at most MAX_BINS - 1 numbers a feature)."""
    several = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in FEATS]).first()
    few, many = [c for c in FEATS if several[c] <= MAX_BINS], [c for c in FEATS if several[c] > MAX_BINS]
    values = rows.agg(F.lit(0), *[F.sort_array(F.collect_set(c)).alias(c) for c in few]).first()
    edges = {c: [(a + b) / 2 for a, b in zip(values[c], values[c][1:])] for c in few}
    if many:
        cuts = rows.approxQuantile(many, [i / MAX_BINS for i in range(1, MAX_BINS)], 0.001)
        edges |= {c: sorted(set(q)) for c, q in zip(many, cuts)}
    return [edges[c] for c in FEATS]


def _binner(edges: list[list[float]]) -> Bucketizer:
    inf = float("inf")  # a feature without an edge gets one that splits nothing
    return Bucketizer(splitsArray=[[-inf, *(e or [0.0]), inf] for e in edges], inputCols=FEATS, outputCols=[f"_b_{c}" for c in FEATS], handleInvalid="keep")


def _packed_bins(binned: DataFrame, *others: Column) -> DataFrame:
    number = lambda i: F.shiftleft(F.col(f"_b_{FEATS[i]}").cast("long") + 1, BIN_BITS * i)
    return binned.select(*others, sum((number(i) for i in range(1, len(FEATS))), number(0)).alias("k"))


def permuted_groups(packed: DataFrame) -> DataFrame:
    """``permuted_rows`` of packed rows (``_h``, ``k``), as counts of equal ones (k, weight).

    Rows in hash order move as slices: a task cuts its run of places, column by column,
    at the borders of blocks of PLACES, and a block's slices are laid over each other.
    One byte a row and column is shuffled, in place of a record."""
    n, cols = packed.count(), len(FEATS)
    placed = prefix_sums(packed.withColumn("_one", F.lit(1).cast("long")), [F.col("_h"), F.col("k")], ["_one"])

    def cut(batches):
        import pyarrow as pa

        for b in batches:
            p, k = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            out = []
            for run in np.split(np.arange(len(p)), np.flatnonzero(np.diff(p) != 1) + 1):
                for i in range(cols if len(run) else 0):
                    column = ((k[run[0] : run[-1] + 1] >> (BIN_BITS * i)) & ((1 << BIN_BITS) - 1)).astype(np.uint8)
                    to, done = (int(p[run[0]]) + n * i // cols) % n, 0
                    while done < len(column):
                        m = min(len(column) - done, PLACES - to % PLACES, n - to)
                        out.append((to // PLACES, i, to % PLACES, column[done : done + m].tobytes()))
                        to, done = (to + m) % n, done + m
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=["block", "c", "at", "bins"])

    def laid(block):
        import pyarrow as pa

        rows = np.zeros(PLACES, np.int64)
        for c, at, v in zip(*(block.column(x).to_pylist() for x in ("c", "at", "bins"))):
            rows[at : at + len(v)] |= np.frombuffer(v, np.uint8).astype(np.int64) << (BIN_BITS * c)
        k, weight = np.unique(rows[rows > 0], return_counts=True)
        return pa.table({"k": k, "weight": weight.astype(np.int64)})

    slices = placed.select((F.col("_one_cum") - 1).alias("p"), "k").mapInArrow(cut, "block long, c int, at int, bins binary")
    return slices.groupBy("block").applyInArrow(laid, "k long, weight long").groupBy("k").agg(F.sum("weight").alias("weight"))


def _binned_training(real: DataFrame, binner: Bucketizer, seed: int) -> DataFrame:
    """Real and permuted rows in bins, equal ones as one row with their number as weight."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in FEATS]).alias("_h")
    packed = cut_lineage(_packed_bins(binner.transform(real), h))
    groups = packed.groupBy("k").agg(F.count(F.lit(1)).alias("weight")).withColumn("label", F.lit(1.0))
    both = groups.unionByName(permuted_groups(packed).withColumn("label", F.lit(0.0)))
    number = lambda i: F.shiftright("k", BIN_BITS * i).bitwiseAND((1 << BIN_BITS) - 1) - 1
    return both.select("label", F.col("weight").cast("double").alias("weight"), *[number(i).cast("double").alias(f"_b_{c}") for i, c in enumerate(FEATS)])


def fit_second_detector(scaled: DataFrame, seed: int = 7, grouped_above: int = 200_000) -> PipelineModel:
    """A classifier of real normal training rows against rows with permuted
    columns. Permuting keeps each column's distribution, so only the dependence
    between columns tells the two apart: boosted trees, which a linear model
    can't replace here.

    Trees see nothing of a feature but its bin, and each of their 90 or so passes reads
    every row. Beyond ``grouped_above`` rows, the rows are therefore binned first and equal
    ones become one weighted row: their number is bounded by the bins, not by the ledger.
    Below, Spark bins the rows itself and grouping would save nothing."""
    real = scaled.filter((F.col("split") == "train") & ~F.col("is_suspicious")).select(*FEATS)
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=15, maxDepth=5, seed=seed)
    if real.count() <= grouped_above:
        assembler = VectorAssembler(inputCols=FEATS, outputCol="features", handleInvalid="keep")
        both = real.withColumn("label", F.lit(1.0)).unionByName(permuted_rows(real, seed).withColumn("label", F.lit(0.0)))
        rows = cut_lineage(assembler.transform(both))  # each boosting round reads it again
        return PipelineModel([assembler, trees.fit(rows)])
    binner = _binner(bin_edges(real))
    assembler = VectorAssembler(inputCols=binner.getOutputCols(), outputCol="features", handleInvalid="keep")
    with passing_cuts(scaled.sparkSession) as keep:
        rows = keep(assembler.transform(_binned_training(real, binner, seed)).select("label", "weight", "features"))
    # maxBins: room for every bin, so that Spark's own binning joins none
    return PipelineModel([binner, assembler, trees.setWeightCol("weight").setMaxBins(1 << BIN_BITS).fit(rows)])


def _unreal(model: PipelineModel, scaled: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return model.transform(scaled).withColumn("gan_score", F.lit(1.0) - vector_to_array("probability")[1])


def real_vs_permuted_scores(txns: DataFrame, seed: int = 7) -> DataFrame:
    """Second detector: 1 - P(real) of every row."""
    sc = scaled_features(training_frame(txns))
    return _unreal(fit_second_detector(sc, seed), sc).select("transaction_id", "is_suspicious", "gan_score")


def fitted_scores(txns: DataFrame, k: int = 4) -> DataFrame:
    """Both fitted detectors on the same row, fused, thresholded and flagged: the
    columns that alerts, reports and what-if jobs read, in place of the stand-ins.

    combined = 0.6 x reconstruction score over its training maximum + 0.4 x
    second score; the threshold is the p95 of the normal training rows."""
    rows = cut_lineage(fitted_rows(txns, k))
    return finish_fitted(rows, cut_lineage(fitted_fit(rows)))


def fitted_rows(txns: DataFrame, k: int = 4) -> DataFrame:
    """Every transfer with the raw scores of both detectors and its split. What reports read
    of a transfer comes along in the training frame, so that neither is joined by id."""
    own = {"_usd": "amount_usd", "_truth": "is_suspicious"}  # beside the frame's columns of these names
    carried = ["sender_id", "receiver_id", "amount_cents", *own]
    sc = scaled_features(training_frame(txns.withColumns({c: F.col(x) for c, x in own.items()}), carried), carried=carried)
    load = fit_pca_loadings(sc, k)
    return _unreal(fit_second_detector(sc), sc).select(
        "transaction_id", *[F.col(c).alias(own.get(c, c)) for c in carried], "split",
        F.round(reconstruction_error(load), 9).alias("vae_score"), F.round("gan_score", 9).alias("gan_score"),
    )


def _combined(vmax: Column) -> Column:
    norm = F.least(F.col("vae_score") / (vmax + F.lit(1e-9)), F.lit(1.0))
    return F.round(S.fuse(norm, F.col("gan_score")), 6)


def fitted_fit(rows: DataFrame) -> DataFrame:
    """What finished scores need of all ``fitted_rows`` (written: they are read several times), one row."""
    vmax = F.lit(rows.filter("split = 'train'").agg(F.max("vae_score")).first()[0]).cast("double")
    normal = rows.filter((F.col("split") == "train") & ~F.col("is_suspicious"))
    thr = grid_quantiles(normal, F.round(_combined(vmax) * 1_000_000), 0.95, 1_000_000).get(0)
    return rows.sparkSession.range(1).select(vmax.alias("vae_max"), F.lit(thr).cast("double").alias("threshold"))


def finish_fitted(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """Fused scores, threshold and flags: columns over the raw ones, no second copy of them."""
    m = fit.select(F.struct("vae_max", "threshold").alias("m")).scalar()
    rows = rows.withColumn("combined_score", _combined(m["vae_max"])).withColumn("threshold", m["threshold"])
    return rows.withColumn("is_flagged", (F.col("combined_score") >= F.col("threshold")).cast("int")).drop("split")


def minority_oversample(txns: DataFrame, per_row: int = 1, seed: int = 11, k: int = 5) -> DataFrame:
    """Synthetic suspicious rows: each suspicious row moves a hash-derived part of the
    way, in [0, 1), towards one of its ``k`` nearest suspicious rows of the same
    typology, which a hash picks. Neighbours are nearest by standardised features
    (``neighbours.nearest``: measured, not exact); a typology's only row stays put."""
    f = cut_lineage(transaction_features(txns, keep=["is_suspicious", "label"]).filter(F.col("is_suspicious")))
    scaled = apply_standardizer(f, fit_standardizer(f, FEATS, population=True), FEATS, ["transaction_id", "label"])
    near = cut_lineage(nearest(scaled, "transaction_id", "label", FEATS, k=k))
    partner = f.select(F.col("transaction_id").alias("_pid"), *[F.col(c).alias(f"_n_{c}") for c in FEATS])
    out = None
    for r in range(per_row):
        pick = F.pmod(F.xxhash64("id", F.lit(seed), F.lit(r)), F.size("near"))
        chosen = near.select("id", F.element_at("near", (pick + 1).cast("int")).alias("_pid")).join(partner, "_pid")
        both = f.join(chosen, F.col("transaction_id") == F.col("id"), "left")
        wt = F.pmod(F.xxhash64("transaction_id", F.lit(seed + r)), F.lit(10**6)) / F.lit(1e6)
        one = both.select(
            F.concat(F.lit("SYN_"), F.col("transaction_id"), F.lit(f"_{r}")).alias("transaction_id"),
            *[(F.col(c) + wt * (F.coalesce(f"_n_{c}", F.col(c)) - F.col(c))).alias(c) for c in FEATS],
            F.lit(True).alias("is_suspicious"),
            F.lit("synthetic").alias("label"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def shapley_attribution(model, rows: DataFrame, permutations: int = 16, seed: int = 5) -> DataFrame:
    """Sampled Shapley values of the second detector's score (1 - P(real)) for
    ``rows`` (transaction_id and scaled features): features are put in place of the
    background (the mean normal row, zero after scaling) one by one, in random orders and
    their reverses, and each gets the mean change of the score. Within an order the
    changes telescope, so a row's values sum to its score minus the base score.

    Each row is scored permutations x (features + 1) times by Spark: give it the rows of
    a report. Columns: transaction_id, feature, attribution, score, base."""
    d = len(FEATS)
    rng = np.random.default_rng(seed)
    orders = [o for _ in range((permutations + 1) // 2) for o in (lambda p: (p, p[::-1]))(rng.permutation(d))]
    steps = []
    for o in orders:
        rank = np.argsort(o)
        for t in range(d + 1):
            # the feature that came in last gains this score, the next one to come loses it
            gain, loss = (FEATS[o[t - 1]] if t else None), (FEATS[o[t]] if t < d else None)
            steps.append({"present": [bool(rank[i] < t) for i in range(d)], "gain": gain, "loss": loss, "t": t})
    table = F.from_json(F.lit(json.dumps(steps)), "array<struct<present: array<boolean>, gain: string, loss: string, t: int>>")
    wide = rows.select("transaction_id", *FEATS, F.explode(table).alias("s")).select("transaction_id", *FEATS, "s.*")
    mixed = wide.select(
        "transaction_id", "gain", "loss", "t", *[F.when(F.col("present")[i], F.col(c)).otherwise(0.0).alias(c) for i, c in enumerate(FEATS)]
    )
    scored = cut_lineage(_unreal(model, mixed).select("transaction_id", "gain", "loss", "t", "gan_score"))
    ends = scored.groupBy("transaction_id").agg(F.max(F.when(F.col("t") == d, F.col("gan_score"))).alias("score"), F.max(F.when(F.col("t") == 0, F.col("gan_score"))).alias("base"))
    share = F.explode(F.array(F.struct(F.col("gain").alias("feature"), F.col("gan_score").alias("v")), F.struct(F.col("loss").alias("feature"), (-F.col("gan_score")).alias("v"))))
    parts = scored.select("transaction_id", share.alias("s")).select("transaction_id", "s.*").filter(F.col("feature").isNotNull())
    values = parts.groupBy("transaction_id", "feature").agg((F.sum("v") / len(orders)).alias("attribution"))
    return values.join(ends, "transaction_id")


def tree_attribution(txns: DataFrame, top: int = 300, permutations: int = 16) -> DataFrame:
    """Report: Shapley values of the ``top`` rows by the second detector's score."""
    sc = scaled_features(training_frame(txns))
    model = fit_second_detector(sc)
    first = _unreal(model, sc).orderBy(F.desc("gan_score"), "transaction_id").limit(top)
    return shapley_attribution(model, cut_lineage(first.select("transaction_id", *FEATS)), permutations)


def projection_2d(txns: DataFrame) -> DataFrame:
    frame = training_frame(txns)
    sc = scaled_features(frame)
    load = fit_pca_loadings(sc, 2)
    return sc.select(
        "transaction_id", "is_suspicious",
        *[sum(F.col(FEATS[i]) * float(load[i, j]) for i in range(len(FEATS))).alias(f"pc{j + 1}") for j in range(2)],
    )


def background_centres(txns: DataFrame, k: int = 200, seed: int = 42) -> DataFrame:
    frame = training_frame(txns)
    sc = scaled_features(frame)
    normals = _assemble(sc.filter(~F.col("is_suspicious")), FEATS)
    model = KMeans(k=k, seed=seed, maxIter=10, featuresCol="features").fit(normals)
    centres = model.clusterCenters()
    spark = txns.sparkSession
    rows = [(i, *[float(x) for x in c]) for i, c in enumerate(centres)]
    return spark.createDataFrame(rows, "centre int, " + ", ".join(f"{c} double" for c in FEATS))


def customer_risk_model(node_x: DataFrame, propagated: DataFrame, custs: DataFrame) -> DataFrame:
    """Class-weighted logistic classifier on node features and their
    propagated versions; probability of the suspicious class as graph risk,
    with the label and the split of each customer."""
    node_x = cut_lineage(node_x)
    p = propagated.select("customer_id", *[F.col(c).alias(f"p_{c}") for c in NODE_FEATURES])
    y = custs.select("customer_id", F.col("is_suspicious").cast("double").alias("label"))
    d = node_x.join(p, "customer_id").join(y, "customer_id")
    d = d.withColumn("w", F.when(F.col("label") == 1.0, F.lit(0.75)).otherwise(F.lit(0.25)))
    d = cut_lineage(d.withColumn("_fold", F.pmod(F.xxhash64("customer_id", F.lit(3)), F.lit(5))))  # the fit and the scores read it
    cols = list(NODE_FEATURES) + [f"p_{c}" for c in NODE_FEATURES]
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="w", maxIter=100, regParam=1e-2)
    model = lr.fit(_assemble(d.filter(F.col("_fold") != 0), cols))
    return d.select(
        "customer_id",
        F.round(logistic_probability(model, cols), 6).alias("gnn_risk_score"),
        F.col("label").cast("long").alias("is_suspicious_true"),
        F.when(F.col("_fold") == 0, F.lit("val")).otherwise(F.lit("train")).alias("split"),
    )


def risk_model_recall(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Recall (and precision) of the risk classifier over each whole fold; only ``val``
    was kept from the fit. A fold without suspicious customers has null recall."""
    hit, true = F.col("gnn_risk_score") >= threshold, F.col("is_suspicious_true") == 1
    n = scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(true).alias("suspicious"),
        F.count_if(hit).alias("flagged"), F.count_if(hit & true).alias("caught"),
    )
    share = lambda d: F.round(F.col("caught") / F.nullif(F.col(d), F.lit(0)), 6)
    return n.select("*", share("suspicious").alias("recall"), share("flagged").alias("precision"))


def dr_effect(txns: DataFrame, treated: str = "structuring_flag", outcome: str = "is_suspicious",
              covariates: list[str] | None = None, folds: int = 2) -> DataFrame:
    """Doubly robust (AIPW) average effect with cross-fitting: propensity and
    two outcome models are fitted on the other folds and applied to each
    fold; one aggregate gives the mean and its standard error."""
    covariates = covariates or ["log_amount", "hour_of_day", "day_of_week", "is_cross_border"]
    keep = [c for c in (treated, outcome) if c not in FEATS]
    f = transaction_features(txns, keep=keep)
    d = f.select(
        "transaction_id", *covariates,
        F.col(treated).cast("double").alias("t"), F.col(outcome).cast("double").alias("y"),
        F.pmod(F.xxhash64("transaction_id", F.lit(5)), F.lit(folds)).alias("_fold"),
    )
    d = cut_lineage(_assemble(d, covariates))  # six fits and the scores read it
    parts = None
    for k in range(folds):
        tr, te = d.filter(F.col("_fold") != k), d.filter(F.col("_fold") == k)
        ps = LogisticRegression(labelCol="t", maxIter=50).fit(tr)
        m1 = LogisticRegression(labelCol="y", maxIter=50).fit(tr.filter("t = 1"))
        m0 = LogisticRegression(labelCol="y", maxIter=50).fit(tr.filter("t = 0"))
        e = te.select(
            "t", "y",
            F.least(F.greatest(logistic_probability(ps, covariates), F.lit(0.01)), F.lit(0.99)).alias("e"),
            logistic_probability(m1, covariates).alias("mu1"),
            logistic_probability(m0, covariates).alias("mu0"),
        )
        parts = e if parts is None else parts.unionByName(e)
    psi = (F.col("mu1") - F.col("mu0") + F.col("t") * (F.col("y") - F.col("mu1")) / F.col("e")
           - (F.lit(1.0) - F.col("t")) * (F.col("y") - F.col("mu0")) / (F.lit(1.0) - F.col("e")))
    return parts.select(psi.alias("psi")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("psi"), 6).alias("ate"),
        F.round(F.stddev_samp("psi") / F.sqrt(F.count(F.lit(1))), 6).alias("se"),
    ).select("n", "ate", "se", F.round(F.col("ate") - 1.96 * F.col("se"), 6).alias("ate_lower"),
             F.round(F.col("ate") + 1.96 * F.col("se"), 6).alias("ate_upper"))
