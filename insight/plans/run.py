"""Several analyses over one input, in one session."""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insight.functions import named
from insight.operators import (
    assign_clusters,
    class_balance,
    classification_metrics,
    clean,
    cluster_centers,
    coefficients,
    confusion_matrix,
    fit_classifier,
    fit_clusters,
    fit_regression,
    fitted_sizes,
    outlier_report,
    outliers,
    part,
    predict,
    profile,
    regression_metrics,
    silhouette,
    split_hash,
    split_random,
    zscore_stats,
)
from insight.operators.prepare import TEST, TRAIN
from insight.plans.analysis import AnalysisPlan
from insight.sources import local_table, sample_rows, settled, write_report

ANALYSES = ("stats", "regression", "classification", "kmeans", "outliers")

_STATUS = (
    "analysis string, status string, error string, warning string, input string, "
    "started_utc string, duration_seconds double"
)


@dataclass
class AnalysisRun:
    """``status`` has one row per requested analysis; ``reports[analysis][name]`` are tables.

    Every report is computed and small whatever the input: its rows are columns, classes,
    clusters or metrics. ``samples[analysis]`` are a few example rows: lazy, or read from
    the output folder.
    """

    status: DataFrame
    reports: dict[str, dict[str, DataFrame]] = field(default_factory=dict)
    samples: dict[str, DataFrame] = field(default_factory=dict)


def run_analyses(
    df: DataFrame,
    names: Iterable[str],
    plan: AnalysisPlan,
    output: str | None = None,
    source: str | None = None,
) -> AnalysisRun:
    """Run the named analyses of ``plan`` over ``df``, in the order of ``ANALYSES``.

    Each analysis derives and cleans its rows from ``df`` itself, so its bounds reach the reader
    of the source; only the cleaned columns of the models, which read them several
    times, are kept until that analysis ends. The first failure stops the run: what was
    finished stays, the failed analysis carries the error text, the rest are ``skipped``. The
    status warns if a hash split leaves the share that was asked for by more than 1 %.
    With ``output``, reports and samples are also written below that folder. ``source`` says
    in the status table where ``df`` came from.
    """
    wanted = set(names)
    unknown = sorted(wanted - set(ANALYSES))
    if unknown:
        raise ValueError(f"unknown analyses: {unknown}; known are {list(ANALYSES)}")
    chosen = [a for a in ANALYSES if a in wanted]
    undefined = [a for a in chosen if getattr(plan, a) is None]
    if undefined:
        raise ValueError(f"the plan does not define: {undefined}")

    run = AnalysisRun(status=local_table(df.sparkSession, [], _STATUS))
    status = []
    failed = False
    # With several analyses, each reads the input again; it is then made once (a join, say)
    # and kept until the run ends, so that no pass makes it again. Lazy samples read it anew.
    keep = len(chosen) > 1
    kept = df.persist(StorageLevel.MEMORY_AND_DISK) if keep else df
    try:
        for name in chosen:
            if failed:
                status.append((name, "skipped", None, None, source, None, None))
                continue
            started, clock = datetime.now(timezone.utc).isoformat(), time.monotonic()
            error = warning = None
            try:
                step = _STEPS[name](kept, plan)
                sample, warning = step.pop("sample"), step.pop("warning", None)
                if output is not None:
                    sample = _written(sample, step, f"{output}/{name}")
                run.reports[name], run.samples[name] = step, sample
            except Exception as failure:  # noqa: BLE001 - the status table reports it
                error, failed = str(failure), True
            took = time.monotonic() - clock
            outcome = "failed" if failed else "done"
            status.append((name, outcome, error, warning, source, started, took))
    finally:
        if keep:
            kept.unpersist()
    run.status = local_table(df.sparkSession, status, _STATUS)
    if output is not None:
        write_report(run.status, f"{output}/status")
    return run


def _cleaned(df: DataFrame, plan: AnalysisPlan, spec, columns: Sequence[str]) -> DataFrame:
    """The rows of one analysis, cleaned where they are read.

    Bounds on columns of the source, and the presence of what the derived ones are made of,
    reach its reader.
    """
    derived = df.transform(plan.derive)
    inputs = [c for c in plan.require if c in df.columns and _uses_derived(spec, columns, df)]
    return clean(derived, columns, spec.rules, require=inputs)


def _uses_derived(spec, columns: Sequence[str], df: DataFrame) -> bool:
    """Whether an analysis needs a column that the source does not have."""
    return any(c not in df.columns for c in (*columns, *(r.column for r in spec.rules)))


def _described(metrics: DataFrame, method: str, spec, **more) -> DataFrame:
    """``metrics`` with what they were made of and by."""
    columns = getattr(spec, "columns", None) or spec.features
    fields = {"method": method, "features": ", ".join(columns), **more}
    return metrics.withColumns({k: F.lit(v) for k, v in fields.items()})


def _written(sample: DataFrame, reports: dict[str, DataFrame], folder: str) -> DataFrame:
    """Write the outcome of one analysis; the sample then comes from its file."""
    for name, report in reports.items():
        write_report(report, f"{folder}/{name}")
    sample.write.mode("overwrite").parquet(f"{folder}/sample")
    return sample.sparkSession.read.parquet(f"{folder}/sample")


def _stats(df: DataFrame, plan: AnalysisPlan):
    spec = plan.stats
    report = profile(df, spec.numeric, spec.category, spec.top_nulls, spec.top_k)
    return {
        "columns": report.columns,
        "summary": report.summary,
        "top_null_columns": report.top_null_columns,
        "numeric_summary": report.numeric_summary,
        "top_values": settled(report.top_values),
        "sample": sample_rows(df, spec.sample, spec.order_by),
    }


def _training_rows(df: DataFrame, plan: AnalysisPlan, spec) -> DataFrame:
    """Cleaned rows, marked train or test."""
    columns = [*spec.features, spec.label]
    if plan.split == "random":
        shares = (plan.train_pct / 100, 1 - plan.train_pct / 100)
        parts = split_random(_cleaned(df, plan, spec, columns), shares, plan.seed)
        train, test = (p.withColumn("split", F.lit(s)) for p, s in zip(parts, (TRAIN, TEST)))
        return train.union(test)
    if plan.split_keys:
        keys = [c for c in plan.split_keys if c not in columns]
        rows = _cleaned(df, plan, spec, [*columns, *keys])
        return split_hash(rows, plan.split_keys, plan.train_pct).drop(*keys)
    return split_hash(_cleaned(df, plan, spec, columns), columns, plan.train_pct, "xxhash64")


def _share_warning(plan: AnalysisPlan, metrics: DataFrame) -> str | None:
    """What to say if the training rows are not the share that was asked for."""
    rows = {r["split"]: r["rows"] for r in metrics.collect()}
    share = 100 * rows.get(TRAIN, 0) / max(1, sum(rows.values()))
    if plan.split == "hash" and abs(share - plan.train_pct) > 1:
        return (
            f"{share:.1f} % of the rows are for training, not {plan.train_pct} %: equal keys "
            "stay together; name split keys that tell rows apart"
        )
    return None


def _regression(df: DataFrame, plan: AnalysisPlan):
    spec = plan.regression
    rows = _training_rows(df, plan, spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:  # cleaned and marked rows, read three times for the fit and again for the scores
        model = fit_regression(part(rows, TRAIN), spec.features, spec.label)
        scored = predict(model, rows)
        metrics = settled(regression_metrics(scored, spec.label, by=["split"]))
    finally:
        rows.unpersist()
    return {
        "metrics": _described(metrics, "linear regression", spec, label=spec.label),
        "coefficients": coefficients(model),
        "sample": sample_rows(
            part(scored, TEST).select(named(spec.label).alias("label"), "prediction"),
            spec.sample,
            spec.order_by,
        ),
        "warning": _share_warning(plan, metrics),
    }


def _classification(df: DataFrame, plan: AnalysisPlan):
    spec = plan.classification
    rows = _training_rows(df, plan, spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:  # cleaned and marked rows, read for the fit and again for the scores
        model = fit_classifier(
            part(rows, TRAIN), spec.features, spec.label, spec.max_iter, spec.tol
        )
        scored = predict(model, rows)
        # One pass over the scored rows; metrics, confusion and balance all follow from it.
        cells = settled(confusion_matrix(scored, spec.label, by=["split"]))
    finally:
        rows.unpersist()
    metrics = settled(classification_metrics(cells, by=["split"], weight="count"))
    return {
        "metrics": _described(
            metrics, "logistic regression", spec, label=spec.label, meaning=spec.meaning
        ),
        "confusion": cells,
        "class_balance": settled(
            cells.groupBy("label").agg(F.sum("count").alias("count")).orderBy("label")
        ),
        "coefficients": coefficients(model),
        "sample": sample_rows(
            part(scored, TEST).select(
                named(spec.label).alias("label"), "prediction", "probability"
            ),
            spec.sample,
            spec.order_by,
        ),
        "warning": _share_warning(plan, metrics),
    }


def _kmeans(df: DataFrame, plan: AnalysisPlan):
    spec = plan.kmeans
    rows = _cleaned(df, plan, spec, spec.features).persist(StorageLevel.MEMORY_AND_DISK)
    try:  # cleaned rows, read for the fit and twice for the silhouette
        model = fit_clusters(rows, spec.features, spec.k, spec.seed)
        assigned = assign_clusters(model, rows, scaled_suffix="_scaled")
        points = assigned.select(*[named(f + "_scaled") for f in spec.features], "cluster")
        metrics = settled(silhouette(points, [f + "_scaled" for f in spec.features]))
    finally:
        rows.unpersist()
    return {
        "metrics": _described(metrics, "k-means", spec, k=spec.k),
        "sizes": fitted_sizes(model),
        "centers": cluster_centers(model),
        "sample": sample_rows(
            assigned.select(*map(named, spec.features), "cluster"), spec.sample, spec.order_by
        ),
    }


def _outliers(df: DataFrame, plan: AnalysisPlan):
    spec = plan.outliers
    baseline = _cleaned(df, plan, spec, spec.columns)
    stats = settled(zscore_stats(baseline, spec.columns))
    everything = df.transform(plan.derive)
    examined = everything if spec.scope == "all" else baseline
    found = outliers(
        examined.select(*[named(c) for c in spec.columns]), spec.columns, spec.z, stats=stats
    )
    return {
        "metrics": _described(
            settled(
                outlier_report(everything, spec.columns, spec.z, baseline, stats, spec.scope)
            ),
            "z-score",
            spec,
        ),
        "moments": stats,
        "sample": sample_rows(found, spec.sample, spec.order_by),
    }


_STEPS = {
    "stats": _stats,
    "regression": _regression,
    "classification": _classification,
    "kmeans": _kmeans,
    "outliers": _outliers,
}
