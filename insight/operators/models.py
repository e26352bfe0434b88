"""Models: linear regression, binary logistic regression, k-means.

Scoring adds plain columns; the vectors that MLlib works on are dropped again.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from insight.functions import all_of, ident, literal, named
from insight.sources import local_table

_VECTOR, _SCALED, _RAW, _PROBABILITY = "_features", "_scaled", "_raw", "_probability"
_ASSIGNED = "_cluster"


@dataclass(frozen=True)
class LinearModel:
    """A fitted regression: ``intercept + sum(coefficient * feature)``."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        terms = [f"{ident(f)} * {literal(c)}" for f, c in zip(self.features, self.coefficients)]
        return F.expr(" + ".join([literal(self.intercept), *terms]))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=_VECTOR)


_UNFIT = "[rows to fit lack a value or hold an infinite one]"


def _prepared(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """The columns of a fit as doubles. One condition checks each row, once: a null, NaN or infinite
    value stops the task that meets it, in the pass that reads it anyway."""
    columns = [*features] if label is None else [*features, label]
    rows = df.selectExpr(*(f"CAST({ident(c)} AS double) AS {ident(c)}" for c in columns))
    good = all_of(f"abs({ident(c)}) < double('infinity')" for c in columns)
    return rows.where(f"CASE WHEN {good} THEN true ELSE raise_error({literal(_UNFIT)}) END")


@contextmanager
def _fitting(columns: Sequence[str]):
    """Say what is wrong with the rows in the same words for every model and every width."""
    try:
        yield
    except Exception as error:
        text = str(error)
        if _UNFIT in text:
            raise ValueError(
                f"null, NaN or infinite values among {list(columns)}; clean them first"
            ) from error
        if re.search("(dataset|instances).{0,40}(empty|zero)|empty (dataset|collection|RDD)|nothing has been added", text, re.I):
            raise ValueError("there are no rows to fit") from error
        raise


def fit_regression(df: DataFrame, features: Sequence[str], label: str = "label") -> LinearModel:
    """Least squares with intercept, without regularisation, by MLlib at every width.

    The input is read once, into columns that are kept (``MEMORY_AND_DISK``) until the fit ends:
    the means, the normal equations of the centred columns and MLlib's summary all come from these.
    As the columns are centred first, those far from zero keep their digits. A feature with one
    value only gets the coefficient 0, and features that depend on each other share theirs. Null,
    NaN or infinite values, and no rows, are a ValueError.
    """
    features = tuple(features)
    columns = [*features, label]
    with _fitting(columns), _kept(_prepared(df, features, label)) as rows:
        moments = rows.selectExpr(
            *(f"avg({ident(c)}) AS m{i}" for i, c in enumerate(columns)),
            *(f"min({ident(c)}) < max({ident(c)}) AS v{i}" for i, c in enumerate(columns)),
        ).first()
        means = [moments[f"m{i}"] for i in range(len(columns))]
        if means[-1] is None:
            raise ValueError("there are no rows to fit")
        centred = rows.selectExpr(
            *(
                f"{ident(c)} - {literal(m)} AS {ident(c)}" if moments[f"v{i}"] else f"0D AS {ident(c)}"
                for i, (c, m) in enumerate(zip(columns, means))
            )
        )
        slopes, rest = [0.0] * len(features), 0.0
        if moments[f"v{len(features)}"]:
            learner = LinearRegression(featuresCol=_VECTOR, labelCol=label)
            vectors = _assembler(features).transform(centred).select(_VECTOR, named(label))
            fitted = learner.fit(vectors)
            slopes, rest = [float(c) for c in fitted.coefficients], float(fitted.intercept)
    shift = sum(c * m for c, m in zip(slopes, means))
    return LinearModel(features, tuple(slopes), means[-1] - shift + rest)


@contextmanager
def _kept(rows: DataFrame):
    """``rows`` persisted for as long as a fit iterates over them."""
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def fit_classifier(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    max_iter: int = 30,
    tol: float = 1e-6,
) -> PipelineModel:
    """Binary logistic regression for labels 0.0 and 1.0, without regularisation.

    The input is read once, into vectors that are kept (``MEMORY_AND_DISK``) until the fit ends.
    Raises ValueError if only one of the labels occurs, which MLlib answers with an infinite
    intercept before it iterates, for null, NaN or infinite values, and for no rows.
    """
    learner = LogisticRegression(
        featuresCol=_VECTOR,
        labelCol=label,
        probabilityCol=_PROBABILITY,
        rawPredictionCol=_RAW,
        family="binomial",
        maxIter=max_iter,
        tol=tol,
    )
    assembler = _assembler(features)
    rows = assembler.transform(_prepared(df, features, label)).select(_VECTOR, named(label))
    with _fitting([*features, label]), _kept(rows):
        fitted = learner.fit(rows)
    if math.isinf(fitted.intercept):
        raise ValueError(f"column {label!r} holds one class only; two are needed")
    return PipelineModel(stages=[assembler, fitted])


def predict(model: LinearModel | PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction`` and, of a classifier, ``probability`` (an array)."""
    if isinstance(model, LinearModel):
        return df.withColumn("prediction", model.score())
    return (
        model.transform(df)
        .withColumn("probability", vector_to_array(_PROBABILITY))
        .drop(_VECTOR, _RAW, _PROBABILITY)
    )


def coefficients(model: LinearModel | PipelineModel) -> DataFrame:
    """``(term, estimate)`` of a regression or classifier, ``(intercept)`` last."""
    if isinstance(model, LinearModel):
        names, values, intercept = model.features, model.coefficients, model.intercept
    else:
        names = model.stages[0].getInputCols()
        values, intercept = model.stages[-1].coefficients, model.stages[-1].intercept
    rows = [(n, float(v)) for n, v in zip(names, values)]
    rows.append(("(intercept)", float(intercept)))
    return local_table(SparkSession.active(), rows, "term string, estimate double")


def fit_clusters(
    df: DataFrame,
    features: Sequence[str],
    k: int = 5,
    seed: int = 42,
    scale: bool = True,
    max_iter: int = 20,
    tol: float = 1e-4,
) -> PipelineModel:
    """k-means, by default on features scaled to mean 0 and standard deviation 1.

    The input is read once, into vectors that are kept (``MEMORY_AND_DISK``) until the fit ends:
    the scale, the iterations and the cluster sizes all come from these. Null, NaN or infinite
    values, and no rows, are a ValueError.
    """
    stages = [_assembler(features)]
    learner = KMeans(
        k=k,
        seed=seed,
        featuresCol=_SCALED if scale else _VECTOR,
        predictionCol=_ASSIGNED,
        maxIter=max_iter,
        tol=tol,
    )
    # Every iteration runs a task for each partition of the vectors, and each task sends its
    # result to the driver: as many partitions as there are cores keep that from growing with
    # the input. Coalescing merges partitions without a shuffle.
    cores = SparkSession.active().sparkContext.defaultParallelism
    rows = stages[0].transform(_prepared(df, features)).select(_VECTOR).coalesce(cores)
    with _fitting(features), _kept(rows):
        seen = rows
        if scale:
            scaler = StandardScaler(
                inputCol=_VECTOR, outputCol=_SCALED, withMean=True, withStd=True
            ).fit(rows)
            stages.append(scaler)
            seen = scaler.transform(rows)
        fitted = learner.fit(seen)
        fitted.summary.clusterSizes  # noqa: B018 - counted now, while the vectors are kept
    return PipelineModel(stages=[*stages, fitted])


def _scaler(model: PipelineModel) -> StandardScalerModel | None:
    return next((s for s in model.stages if isinstance(s, StandardScalerModel)), None)


def assign_clusters(
    model: PipelineModel,
    df: DataFrame,
    cluster: str = "cluster",
    scaled_suffix: str | None = None,
) -> DataFrame:
    """``df`` with the number of the nearest centre.

    ``scaled_suffix`` adds the features as the model sees them, for ``silhouette``.
    """
    assigned = model.transform(df)
    added = {cluster: F.col(_ASSIGNED)}
    if scaled_suffix is not None:
        seen = vector_to_array(_VECTOR if _scaler(model) is None else _SCALED)
        for i, name in enumerate(model.stages[0].getInputCols()):
            added[name + scaled_suffix] = F.get(seen, F.lit(i))
    return assigned.withColumns(added).drop(_VECTOR, _SCALED, _ASSIGNED)


def cluster_centers(model: PipelineModel) -> DataFrame:
    """``(cluster, feature, scaled, original)``: every centre coordinate in both units."""
    fitted: KMeansModel = model.stages[-1]
    features = model.stages[0].getInputCols()
    scaler = _scaler(model)
    mean = [0.0] * len(features) if scaler is None else scaler.mean.toArray()
    std = [1.0] * len(features) if scaler is None else scaler.std.toArray()
    rows = [
        (number, feature, float(value), float(value * s + m))
        for number, center in enumerate(fitted.clusterCenters())
        for feature, value, m, s in zip(features, center, mean, std)
    ]
    return local_table(
        SparkSession.active(),
        rows,
        "cluster int, feature string, scaled double, original double",
    )


def fitted_sizes(model: PipelineModel) -> DataFrame:
    """``cluster_sizes`` of the training rows as the fit counted them; no further pass."""
    sizes = enumerate(model.stages[-1].summary.clusterSizes)
    rows = sorted(((number, int(size)) for number, size in sizes), key=lambda r: (-r[1], r[0]))
    return local_table(SparkSession.active(), rows, "cluster int, count bigint")
