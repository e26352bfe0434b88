"""Analyses put together from the operators."""

from insight.plans.analysis import (
    AnalysisPlan,
    ClassificationSpec,
    ClusterSpec,
    OutlierSpec,
    ProfileSpec,
    RegressionSpec,
    trip_plan,
)
from insight.plans.run import ANALYSES, AnalysisRun, run_analyses

__all__ = [
    "ANALYSES",
    "AnalysisPlan",
    "AnalysisRun",
    "ClassificationSpec",
    "ClusterSpec",
    "OutlierSpec",
    "ProfileSpec",
    "RegressionSpec",
    "run_analyses",
    "trip_plan",
]
