"""What a set of analyses works on: derived columns, and columns and bounds per analysis."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from insight.functions import Range, elapsed, encode_label


@dataclass(frozen=True)
class ProfileSpec:
    """Numeric columns (all by default) and the category whose frequent values are counted."""

    numeric: tuple[str, ...] | None = None
    category: str | None = None
    top_nulls: int = 20
    top_k: int = 10
    sample: int = 50
    order_by: tuple = ()


@dataclass(frozen=True)
class RegressionSpec:
    features: tuple[str, ...]
    label: str
    rules: tuple[Range, ...] = ()
    sample: int = 50
    order_by: tuple = ()


@dataclass(frozen=True)
class ClassificationSpec:
    features: tuple[str, ...]
    label: str
    rules: tuple[Range, ...] = ()
    max_iter: int = 30
    tol: float = 1e-6
    meaning: str = ""
    sample: int = 50
    order_by: tuple = ()


@dataclass(frozen=True)
class ClusterSpec:
    features: tuple[str, ...]
    rules: tuple[Range, ...] = ()
    k: int = 5
    seed: int = 42
    sample: int = 200
    order_by: tuple = ()


@dataclass(frozen=True)
class OutlierSpec:
    columns: tuple[str, ...]
    rules: tuple[Range, ...] = ()
    z: float = 3.0
    scope: str = "all"
    sample: int = 200
    order_by: tuple = ()


@dataclass(frozen=True)
class AnalysisPlan:
    """The analyses that can be run over one input.

    ``derive`` adds columns first (see ``DataFrame.transform``); ``require`` names the source
    columns without which a derived one is absent. A spec's ``order_by`` fixes which rows its
    sample takes; without one it takes any. ``split`` says how train and
    test are told apart: ``hash`` by the values of ``split_keys`` (of the features and the
    label where none are given), the same for every layout of the input, with equal rows on
    the same side; ``random`` row by row from ``seed``, repeatable for one layout only.
    """

    derive: Callable[[DataFrame], DataFrame] = lambda df: df
    stats: ProfileSpec = ProfileSpec()
    regression: RegressionSpec | None = None
    classification: ClassificationSpec | None = None
    kmeans: ClusterSpec | None = None
    outliers: OutlierSpec | None = None
    split: str = "hash"
    split_keys: tuple[str, ...] = ()
    train_pct: int = 80
    seed: int = 42
    require: tuple[str, ...] = ()

    def __post_init__(self):
        if self.split not in ("hash", "random"):
            raise ValueError(f"split must be 'hash' or 'random', not {self.split!r}")


# The column names, bounds, k and z of the trip analyses, as defaults below.
def trip_plan(
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
    distance: str = "trip_distance",
    passengers: str = "passenger_count",
    fare: str = "fare_amount",
    tip: str = "tip_amount",
    total: str = "total_amount",
    payment: str = "payment_type",
    unit_seconds: float = 60.0,
    max_duration: float = 300.0,
    max_distance: float = 200.0,
    max_passengers: int = 10,
    k: int = 5,
    z: float = 3.0,
    scope: str = "all",
    split: str = "hash",
    split_keys: tuple[str, ...] = (),
) -> AnalysisPlan:
    """Analyses of a table of taxi trips; column names, units and bounds can be replaced.

    Derives ``trip_duration`` in units of ``unit_seconds`` and ``paid_by_card``: 1.0 for
    payment type 1 (card), 0.0 for 2 (cash), NULL for others.
    """
    duration, card = "trip_duration", "paid_by_card"
    trips = (Range(distance, gt=0, lt=max_distance), Range(duration, gt=0, lt=max_duration))

    def derive(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                duration: elapsed(pickup, dropoff, unit_seconds),
                card: encode_label(payment, {1: 1.0, 2: 0.0}),
            }
        )

    return AnalysisPlan(
        derive=derive,
        stats=ProfileSpec(numeric=(distance, fare, total, tip), category=payment),
        regression=RegressionSpec(
            features=(distance, passengers, duration),
            label=total,
            rules=(*trips, Range(total, gt=0)),
        ),
        classification=ClassificationSpec(
            features=(distance, passengers, duration, fare),
            label=card,
            rules=(*trips, Range(fare, gt=0)),
            meaning=f"1 where {payment} is 1 (card), 0 where it is 2 (cash)",
        ),
        kmeans=ClusterSpec(
            features=(distance, duration, fare, tip, passengers),
            rules=(
                *trips,
                Range(fare, gt=0),
                Range(tip, ge=0),
                Range(passengers, gt=0, lt=max_passengers),
            ),
            k=k,
        ),
        outliers=OutlierSpec(
            columns=(distance, total, duration),
            rules=(*trips, Range(total, gt=0)),
            z=z,
            scope=scope,
        ),
        split=split,
        split_keys=split_keys,
        require=(pickup, dropoff),
    )
