"""Drift alerts, drift over time, and the choice between two models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisect.functions.keys import join_groups
from trisect.operators.drift import BINS, divergences, histogram_by_edges, reference_edges, stability_report
from trisect.session import lookup

# Fixed values
PSI_ALERT = 0.2
KS_ALERT = 0.1


def drift_alert(
    both: DataFrame, columns: Sequence[str], psi_limit: float = PSI_ALERT, ks_limit: float = KS_ALERT, bins: int = BINS
) -> DataFrame:
    """The stability report with ``alert`` where PSI or the KS statistic exceeds its limit."""
    report = stability_report(both, columns, bins)
    over = (F.col("psi") > psi_limit) | (F.col("ks_stat") > ks_limit)
    return report.withColumn("alert", F.coalesce(over, F.lit(False)))


def drift_by_period(
    df: DataFrame, time: str, period: str, is_reference: Column, columns: Sequence[str], bins: int = BINS
) -> DataFrame:
    """PSI and Jensen-Shannon divergence of every period against the reference rows.

    The rows are binned and counted per period once; the reference counts are the sum of the
    counts of its own rows, so periods and reference come from the same pass. A period without values has null indices.
    """
    kind = df.schema[time].dataType
    rows = df.select(
        F.date_trunc(period, time).cast(kind).alias("period"), is_reference.alias("is_ref"), *columns
    )
    edges = reference_edges(rows, columns, bins)
    everything = lookup(histogram_by_edges(rows, edges, by=["period"], missing=True))
    counted = everything.where("NOT missing").drop("missing")
    reference = counted.groupBy("column", "bin").agg(F.sum("n_ref").alias("n_ref")).where("n_ref > 0")
    current = counted.select("period", "column", "bin", (F.col("n_ref") + F.col("n_cur")).alias("n_cur"))
    # Every period needs the reference bins, also those in which it has no rows of its own.
    periods = current.select("period", "column").distinct()
    expected = periods.join(reference, "column").withColumn("n_cur", F.lit(0))
    counts = (
        current.withColumn("n_ref", F.lit(0))
        .unionByName(expected)
        .groupBy("period", "column", "bin")
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )
    every = everything.select("period", "column").distinct()
    return join_groups(every, lookup(divergences(counts, by=["period", "column"])), ["period", "column"], "left").select(
        "period", "column", "psi", "js_divergence"
    )


def compare_models(new: DataFrame, old: DataFrame, decisive: str = "ROC AUC", least_gain: float = 0.0) -> DataFrame:
    """Two metric tables side by side: ``metric, new_value, old_value, delta, accept``.

    ``accept`` repeats the decision on every row: the new model wins if the decisive metric rises
    by at least ``least_gain``.
    """
    joined = new.withColumnRenamed("value", "new_value").join(old.withColumnRenamed("value", "old_value"), "metric")
    deltas = lookup(joined.withColumn("delta", F.col("new_value") - F.col("old_value")))
    decision = deltas.agg(F.max(F.when(F.col("metric") == decisive, F.col("delta") >= least_gain)).alias("accept"))
    return join_groups(deltas, decision, [])


def validate_model(
    new: DataFrame,
    old: DataFrame,
    both: DataFrame,
    columns: Sequence[str],
    decisive: str = "ROC AUC",
    least_gain: float = 0.0,
    psi_limit: float = PSI_ALERT,
    ks_limit: float = KS_ALERT,
    difference: DataFrame | None = None,
) -> DataFrame:
    """One table for the decision on a model: ``check, name, value, reference, passed, accept``.

    ``new`` and ``old`` are metric tables, ``both`` the marked reference and current rows. A metric passes if it does not
    fall by more than ``least_gain`` asks for, a column if it raises no drift alert. ``accept`` repeats the decision: the
    decisive metric passes and no column has drifted. With ``difference``, a row of ``auc_difference`` of the new and the old
    score, the decisive gain must hold at the lower end of its interval, not just as measured.
    """
    metrics = compare_models(new, old, decisive, least_gain).select(
        F.lit("metric").alias("check"), F.col("metric").alias("name"), F.col("new_value").alias("value"),
        F.col("old_value").alias("reference"), F.coalesce(F.col("delta") >= least_gain, F.lit(False)).alias("passed"),
    )
    drift = drift_alert(both, columns, psi_limit, ks_limit).select(
        F.lit("drift").alias("check"), F.col("column").alias("name"), F.col("psi").alias("value"),
        F.lit(psi_limit).alias("reference"),
        # No index (an empty side) is no proof of stability.
        (~F.col("alert") & F.col("psi").isNotNull()).alias("passed"),
    )
    checks = metrics.unionByName(drift)
    if difference is not None:
        checks = checks.unionByName(difference.select(
            F.lit("difference").alias("check"), F.lit(decisive).alias("name"), F.col("low").alias("value"),
            F.lit(float(least_gain)).alias("reference"), F.coalesce(F.col("low") >= least_gain, F.lit(False)).alias("passed"),
        ))
    checks = lookup(checks)
    counts = (F.col("check") != "metric") | (F.col("name") == decisive)
    decision = checks.agg((F.min(F.when(counts, F.col("passed"))) & F.max(F.col("name") == decisive)).alias("accept"))
    return join_groups(checks, decision, [])
