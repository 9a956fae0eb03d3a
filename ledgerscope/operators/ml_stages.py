"""Spark ML stages: a fit/transform feature transformer usable in a Pipeline,
and an Arrow-batched scorer that applies a bring-your-own numpy model.

The transformer derives the nine transaction features and standardises them
with the population mean / sd fitted on its input (a one-row fit: 18 numbers).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions.constants import TRANSACTION_FEATURES
from ledgerscope.operators.features import fit_standardizer, transaction_features


class _ScalerParams(Params):
    """What both stages carry, as ML params, so that Spark's own writer saves it."""

    feature_cols = Param(Params._dummy(), "feature_cols", "features, in order", TypeConverters.toListString)
    keep = Param(Params._dummy(), "keep", "columns passed through", TypeConverters.toListString)

    def _columns(self) -> tuple[list[str], list[str]]:
        return self.getOrDefault(self.feature_cols), self.getOrDefault(self.keep)


class TransactionFeatureScalerModel(Model, _ScalerParams, DefaultParamsWritable, DefaultParamsReadable):
    means = Param(Params._dummy(), "means", "mean of each feature", TypeConverters.toListFloat)
    sds = Param(Params._dummy(), "sds", "population deviation of each feature", TypeConverters.toListFloat)

    def __init__(self, cols: list[str] | None = None, means: list[float] | None = None, sds: list[float] | None = None, keep: list[str] | None = None):
        super().__init__()
        self._set(feature_cols=cols or [], means=means or [], sds=sds or [], keep=keep or [])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols, keep = self._columns()
        f = transaction_features(dataset, keep=keep, feature_cols=cols)
        fitted = zip(cols, self.getOrDefault(self.means), self.getOrDefault(self.sds))
        return f.select("transaction_id", *keep, *[((F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)).alias(c) for c, m, s in fitted])


class TransactionFeatureScaler(Estimator, _ScalerParams, DefaultParamsWritable, DefaultParamsReadable):
    """Estimator: ledger rows -> scaled feature columns (caller-chosen list)."""

    def __init__(self, feature_cols: list[str] | None = None, keep: list[str] | None = None):
        super().__init__()
        self._set(feature_cols=list(feature_cols or TRANSACTION_FEATURES), keep=list(keep or []))

    def _fit(self, dataset: DataFrame) -> TransactionFeatureScalerModel:
        cols, keep = self._columns()
        stats = fit_standardizer(transaction_features(dataset, feature_cols=cols), cols, population=True).first()
        means = [float(stats[f"{c}__mean"] or 0.0) for c in cols]
        sds = [float(stats[f"{c}__sd"] or 0.0) for c in cols]
        return TransactionFeatureScalerModel(cols, means, sds, keep)


def build_transaction_pipeline(feature_cols: list[str] | None = None) -> Pipeline:
    return Pipeline(stages=[TransactionFeatureScaler(feature_cols)])


def saved_and_loaded(model: PipelineModel, path: str) -> PipelineModel:
    """The fitted pipeline written by Spark's ML writer to a shared folder and read back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def batch_scorer(load_model: Callable[[], Callable[[np.ndarray], np.ndarray]], n_features: int):
    """Iterator pandas UDF: the model is loaded once per task (per Python
    worker), then applied to Arrow batches as a matrix -> vector call."""

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = load_model()
        for cols in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
            yield pd.Series(np.asarray(model(x), dtype=float))

    def apply(*cols: Column) -> Column:
        assert len(cols) == n_features
        return score(*cols)

    return apply


def reconstruction_error_model(loadings: np.ndarray) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """A numpy scorer for the batch UDF: mean squared PCA reconstruction error."""
    v = np.asarray(loadings, dtype=float)

    def load():
        def f(x: np.ndarray) -> np.ndarray:
            r = x - (x @ v) @ v.T
            return (r * r).mean(axis=1)

        return f

    return load
