"""Properties of the fitted re-aims (no SQL oracle for these)."""

from pyspark.sql import functions as F

from ledgerscope.functions.constants import TRANSACTION_FEATURES as FEATS
from ledgerscope.operators import learning as LE
from ledgerscope.sources import ledger as L


def test_attribution_sums_to_score_and_scaler_inverts(spark, sf):
    tx = L.transactions(spark, sf)
    fr = LE.training_frame(tx)
    model = LE.fit_scaler(fr)
    sc = LE.scaled_features(fr, model)
    back = LE.unscaled_features(sc, model)
    b = back.select("transaction_id", *[F.col(c).alias(f"b_{c}") for c in FEATS])
    diff = b.join(fr, "transaction_id").select(
        F.max(F.greatest(*[F.abs(F.col(f"b_{c}") - F.col(c)) for c in FEATS])).alias("d")
    ).first().d
    assert diff < 1e-6
    rec = LE.reconstruction(sc, LE.fit_pca_loadings(sc, 3))
    tot = rec.select("transaction_id", sum(F.col(f"r_{f}") for f in FEATS).alias("s"))
    att = LE.attribution_long(rec).groupBy("transaction_id").agg(F.sum("attribution").alias("a"))
    worst = tot.join(att, "transaction_id").select(F.max(F.abs(F.col("s") - F.col("a")))).first()[0]
    assert worst < 1e-9


def test_permutation_keeps_marginals(spark, sf):
    tx = L.transactions(spark, sf)
    sc = LE.scaled_features(LE.training_frame(tx))
    real = sc.select(*FEATS)
    fake = LE.permuted_rows(real)
    for c in FEATS[:3]:
        a = sorted(r[0] for r in real.select(c).collect())
        b = sorted(r[0] for r in fake.select(c).collect())
        assert a == b


def test_batch_udf_scorer_equals_column_score(spark, sf):
    import __spark_entry__ as E

    d = E.queries()["udf_scores"](spark, sf)
    worst = d.select(F.max(F.abs(F.col("udf_score") - F.col("column_score")))).first()[0]
    assert worst < 1e-9


def test_feature_pipeline_is_an_estimator(spark, sf):
    from pyspark.ml import PipelineModel

    from ledgerscope.operators.ml_stages import build_transaction_pipeline

    tx = L.transactions(spark, sf)
    model = build_transaction_pipeline(["amount_usd", "log_amount"]).fit(tx)
    assert isinstance(model, PipelineModel)
    out = model.transform(tx)
    m = out.agg(F.avg("amount_usd"), F.stddev_pop("log_amount")).first()
    assert abs(m[0]) < 1e-9 and abs(m[1] - 1.0) < 1e-9


def _groups(df, label=None):
    df = df if label is None else df.filter(F.col("label") == label)
    return {tuple(r[:-1]): r[-1] for r in df.groupBy([f"_b_{c}" for c in FEATS]).agg(F.sum("weight")).collect()}


def test_grouped_rows_are_the_permuted_rows_in_bins(spark, monkeypatch):
    monkeypatch.setattr(LE, "PLACES", 64)  # many blocks, and slices around the end
    real = spark.range(1003).select(*[(F.col("id") * (i + 3) % (7 + 40 * i)).cast("double").alias(c) for i, c in enumerate(FEATS)])
    binner = LE._binner(LE.bin_edges(real))
    got = LE._binned_training(real, binner, 7)
    for label, rows in ((1.0, real), (0.0, LE.permuted_rows(real, 7))):
        assert _groups(got, label) == _groups(binner.transform(rows).withColumn("weight", F.lit(1.0)))
    assert got.count() == got.dropDuplicates(["label", *[f"_b_{c}" for c in FEATS]]).count()


def test_repeated_rows_make_the_training_heavier_not_longer(spark, monkeypatch):
    """Eight times the rows: the trees read as many rows as before (F8)."""
    read = []
    fit = LE.GBTClassifier.fit
    monkeypatch.setattr(LE.GBTClassifier, "fit", lambda self, rows: read.append((rows.count(), rows.agg(F.sum("weight")).first()[0])) or fit(self, rows))
    one = spark.range(4000).select(*[F.pmod(F.hash("id", F.lit(i)), F.lit(2)).cast("double").alias(c) for i, c in enumerate(FEATS)], F.lit("train").alias("split"), F.lit(False).alias("is_suspicious"))
    more = one.crossJoin(spark.range(8).select(F.col("id").alias("_n"))).drop("_n")
    for rows in (one, more):
        LE.fit_second_detector(rows, grouped_above=1000)
    assert [w for _, w in read] == [8000.0, 64000.0]
    assert read[1][0] <= 2 * 2 ** len(FEATS)


def test_trees_on_bins_score_like_trees_on_rows(spark):
    """Features of few values: bins lose nothing, so both ways give the same trees."""
    noise = lambda i: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(5))
    sc = LE.cut_lineage(spark.range(3000).select("id", *[((F.col("id") % 13 * (i + 1) + noise(i)) % 17 - 8.0).alias(c) for i, c in enumerate(FEATS)], F.lit("train").alias("split"), F.lit(False).alias("is_suspicious")))
    two = [LE._unreal(LE.fit_second_detector(sc, grouped_above=n), sc).select("id", F.col("gan_score").alias(f"g{n}")) for n in (0, 10**6)]
    r = two[0].join(two[1], "id").agg(F.max(F.abs(F.col("g0") - F.col("g1000000"))), F.count(F.lit(1)), F.stddev("g0")).first()
    assert r[1] == 3000 and r[2] > 0.05
    assert r[0] < 1e-6
