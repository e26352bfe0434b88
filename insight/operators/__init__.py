"""Operators: DataFrames in, lazy DataFrames out."""

from insight.operators.evaluate import (
    class_balance,
    classification_metrics,
    cluster_sizes,
    confusion_matrix,
    regression_metrics,
    silhouette,
)
from insight.operators.models import (
    LinearModel,
    assign_clusters,
    cluster_centers,
    coefficients,
    fit_classifier,
    fit_clusters,
    fit_regression,
    fitted_sizes,
    predict,
)
from insight.operators.moments import zscore_stats
from insight.operators.outliers import (
    add_zscores,
    flag_outliers,
    outlier_report,
    outliers,
)
from insight.operators.prepare import (
    assemble,
    clean,
    part,
    split_hash,
    split_random,
    split_sizes,
    standardize,
)
from insight.operators.profile import (
    Profile,
    column_profile,
    null_counts,
    numeric_summary,
    profile,
    schema_table,
    table_summary,
    top_null_columns,
    top_values,
)

__all__ = [
    "LinearModel",
    "Profile",
    "add_zscores",
    "assemble",
    "assign_clusters",
    "class_balance",
    "classification_metrics",
    "clean",
    "cluster_centers",
    "cluster_sizes",
    "coefficients",
    "column_profile",
    "confusion_matrix",
    "fit_classifier",
    "fit_clusters",
    "fit_regression",
    "fitted_sizes",
    "flag_outliers",
    "null_counts",
    "numeric_summary",
    "outlier_report",
    "outliers",
    "part",
    "predict",
    "profile",
    "regression_metrics",
    "schema_table",
    "silhouette",
    "split_hash",
    "split_random",
    "split_sizes",
    "standardize",
    "table_summary",
    "top_null_columns",
    "top_values",
    "zscore_stats",
]
