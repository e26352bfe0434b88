"""Evaluation of predictions and clusterings, as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insight.functions import all_of, ident, named, present


def regression_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """``rows``, ``rmse`` and ``r2`` from one aggregate, overall or per group of ``by``.

    Rows without label or prediction do not count. ``r2`` is NULL if the label is constant.
    """
    y, p = ident(label), ident(prediction)
    error = f"power({y} - {p}, 2D)"
    return (
        df.where(f"{y} IS NOT NULL AND {p} IS NOT NULL")
        .groupBy(*map(named, by))
        .agg(
            F.expr("count(1) AS rows"),
            F.expr(f"sqrt(avg({error})) AS rmse"),
            F.expr(f"1D - try_divide(sum({error}), count({y}) * var_pop({y})) AS r2"),
        )
    )


def confusion_matrix(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """``(label, prediction, count)`` with integer classes, in order; only cells that occur."""
    keys = [
        *map(named, by),
        F.expr(f"CAST({ident(label)} AS int) AS label"),
        F.expr(f"CAST({ident(prediction)} AS int) AS prediction"),
    ]
    return df.groupBy(*keys).count().orderBy(*map(ident, by), "label", "prediction")


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """``rows``, ``accuracy`` and support-weighted ``f1``, overall or per group of ``by``.

    The rows are read once, into one record per (label, prediction); the rest works on these
    records. Rows without label or prediction do not count. ``weight`` names a column that
    says how many rows a record stands for, such as ``count`` of a ``confusion_matrix``.
    """
    groups = [ident(c) for c in by]
    l, p = ident(label), ident(prediction)
    cells = (
        df.where(f"{l} IS NOT NULL AND {p} IS NOT NULL")
        .groupBy(*groups, F.expr(f"{l} AS label"), F.expr(f"{p} AS prediction"))
        .agg(F.expr(f"{'count(1)' if weight is None else f'sum({ident(weight)})'} AS n"))
    )
    # Each cell counts once for its label and once for its prediction.
    per_class = (
        cells.selectExpr(
            *groups,
            """inline(array(
                 struct(CAST(label AS double) AS class, n AS support, 0L AS predicted,
                        if(label = prediction, n, 0L) AS hits),
                 struct(CAST(prediction AS double) AS class, 0L AS support, n AS predicted,
                        0L AS hits)))""",
        )
        .groupBy(*groups, "class")
        .agg(
            F.expr("sum(support) AS support"),
            F.expr("sum(predicted) AS predicted"),
            F.expr("sum(hits) AS hits"),
        )
    )
    return per_class.groupBy(*groups).agg(
        F.expr("coalesce(sum(support), 0L) AS rows"),
        F.expr("try_divide(sum(hits), sum(support)) AS accuracy"),
        F.expr(
            "try_divide(sum(support * 2D * hits / (support + predicted)), sum(support)) AS f1"
        ),
    )


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, count)``, ordered by label."""
    return (
        df.groupBy(named(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("label")
    )


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``(cluster, count)``, largest first; clusters that tie are in ascending order."""
    return (
        df.groupBy(named(cluster).alias("cluster"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "cluster")
    )


def silhouette(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """One row ``(rows, clusters, silhouette)``: the mean silhouette, squared Euclidean.

    Linear in the rows. The mean squared distance from a point to a cluster is its squared
    distance to the cluster's mean plus the cluster's total variance, so one aggregate per
    cluster takes the place of all pairs. A point alone in its cluster scores 0. NULL if
    there are fewer than two clusters. Rows with an absent feature or cluster do not count.

    Lazy. The clusters' aggregates reach the points as one scalar subquery, an array of one
    struct for each cluster, and the expression over it does not depend on their number.
    """
    x = [f"x{i}" for i in range(len(features))]
    points = df.where(all_of(present(df.schema[c]) for c in [*features, cluster])).selectExpr(
        *[f"CAST({ident(c)} AS double) AS {n}" for c, n in zip(features, x)],
        f"{ident(cluster)} AS cluster",
    )
    stats = points.groupBy("cluster").agg(
        F.expr("count(1) AS n"),
        F.expr(" + ".join(f"var_pop({n})" for n in x) + " AS variance"),
        *[F.expr(f"avg({n}) AS {n}") for n in x],
    )
    clusters = stats.selectExpr(
        f"collect_list(struct(cluster, n, variance, {', '.join(x)})) AS clusters"
    ).scalar()
    squares = " + ".join(f"({n} - s.{n}) * ({n} - s.{n})" for n in x)
    return (
        points.withColumn("_clusters", clusters)
        .selectExpr(
            *x,
            "size(_clusters) AS clusters",
            "filter(_clusters, s -> s.cluster = cluster)[0] AS own",
            # the others' distances as plain numbers, no struct for each cluster
            f"""array_min(transform(_clusters, s -> if(s.cluster = cluster, CAST(NULL AS double),
                {squares} + s.variance))) AS nearest""",
        )
        .selectExpr(
            "clusters",
            "own.n AS n",
            f"try_divide(({squares.replace('s.', 'own.')} + own.variance) * own.n, own.n - 1) AS within",
            "nearest",
        )
        .selectExpr(
            "count(1) AS rows",
            "coalesce(max(clusters), 0) AS clusters",
            """CASE WHEN max(clusters) > 1 THEN avg(
                 CASE WHEN n = 1 OR greatest(within, nearest) = 0D THEN 0D
                      ELSE (nearest - within) / greatest(within, nearest) END) END AS silhouette""",
        )
        .selectExpr("rows", "CAST(clusters AS bigint) AS clusters", "silhouette")
    )
