"""Feature tables: projections, fitted transformers, selection, reduction."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    PCA,
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisect.functions.keys import ordinal
from trisect.operators.drift import divergences, histogram_by_edges
from trisect.operators.quantiles import edge_lists, edge_probabilities, quantiles
from trisect.session import lookup


def project(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """The feature columns chosen at run time, and the target."""
    missing = [c for c in [*columns, target] if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the table: {', '.join(missing)}")
    return df.select(*dict.fromkeys([*columns, target]))


def display_names(df: DataFrame, column: str, names: dict[str, str], output: str) -> DataFrame:
    """Replace known values by their display name; others stay as they are."""
    pairs = [F.lit(v) for pair in names.items() for v in pair]
    return df.withColumn(output, F.coalesce(F.element_at(F.create_map(*pairs), F.col(column)), F.col(column)))


def date_parts(df: DataFrame, column: str) -> DataFrame:
    """Year, month, day of week and day of year of a date column, as features."""
    return df.withColumns({
        f"{column}_year": F.year(column),
        f"{column}_month": F.month(column),
        f"{column}_weekday": F.dayofweek(column),
        f"{column}_yearday": F.dayofyear(column),
    })


def impute_and_scale(columns: Sequence[str], strategy: str = "mean", output: str = "scaled") -> Pipeline:
    """Missing values replaced, then centred and scaled to unit deviation, as one vector."""
    filled = [f"{c}_filled" for c in columns]
    return Pipeline(stages=[
        Imputer(inputCols=list(columns), outputCols=filled, strategy=strategy),
        VectorAssembler(inputCols=filled, outputCol=f"{output}_raw"),
        StandardScaler(inputCol=f"{output}_raw", outputCol=output, withMean=True, withStd=True),
    ])


def index_and_onehot(columns: Sequence[str]) -> Pipeline:
    """Text categories to indices by falling frequency (ties in text order) and indicator vectors."""
    indices = [f"{c}_index" for c in columns]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(columns), outputCols=indices, handleInvalid="keep"),
        OneHotEncoder(inputCols=indices, outputCols=[f"{c}_onehot" for c in columns], dropLast=False),
    ])


def information_value(df: DataFrame, columns: Sequence[str], target: str, bins: int = 10, positive=1) -> DataFrame:
    """Information value of each feature for a binary target: ``column, information_value``.

    The same sum as the stability index, between the positive and the negative rows, on
    equal-frequency edges of all rows.
    """
    edges = edge_lists(quantiles(df, columns, edge_probabilities(bins)), columns)
    sides = df.withColumn("is_ref", F.col(target) == positive).where("is_ref IS NOT NULL")
    counts = histogram_by_edges(sides.select(*columns, "is_ref"), edges)
    return divergences(counts).select("column", F.col("psi").alias("information_value"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one pass: ``feature_a, feature_b, correlation``.

    A pair is correlated over the rows where both have a value.
    """
    values = {c: ordinal(df, c) for c in columns}
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(values[a], values[b]).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"_{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ])))


def univariate_tests(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Variance and F value of every column against a class label: ``feature, variance, f_value``.

    Each column leaves out its own nulls only; rows without label count for the variance. One pass: count, sum and sum of
    squared deviations per label and column.
    """
    values = F.array(*[F.struct(F.lit(c).alias("feature"), ordinal(df, c).alias("value")) for c in columns])
    long = df.select(F.col(label).alias("_label"), F.inline(values)).where("value IS NOT NULL")
    groups = lookup(long.groupBy("feature", "_label").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.coalesce(F.var_pop("value"), F.lit(0.0)).alias("spread")
    ))
    known = groups.where("_label IS NOT NULL")
    centre = known.groupBy("feature").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"))
    tested = known.join(centre, "feature").groupBy("feature").agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2)).alias("between"),
        F.sum(F.col("n") * F.col("spread")).alias("within"), F.count("n").alias("k"), F.sum("n").alias("rows"),
    )
    f_value = (F.col("between") / (F.col("k") - 1)) / (F.col("within") / (F.col("rows") - F.col("k")))
    usable = (F.col("k") > 1) & (F.col("rows") > F.col("k")) & (F.col("within") > 0)
    whole = long.groupBy("feature").agg(F.var_samp("value").alias("variance"))
    names = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(columns)], "feature string, place int")
    return (
        names.join(whole, "feature", "left").join(tested, "feature", "left").orderBy("place")
        .select("feature", "variance", F.when(usable, f_value).alias("f_value"))
    )


def feature_selection(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    least_variance: float = 0.0,
    most_correlation: float = 0.95,
    top: int | None = None,
) -> DataFrame:
    """The decision for every column: ``feature, variance, f_value, most_correlated, kept``.

    A column must vary more than ``least_variance``. Of two columns correlated more than ``most_correlation`` the
    earlier one stays; ``most_correlated`` names the kept column that removed it. Of the rest the ``top`` F values are kept,
    the earlier column of equals. No row is left out for a null in another column.
    """
    tests = {r["feature"]: r for r in univariate_tests(df, columns, label).collect()}
    names = [c for c in columns if (tests[c]["variance"] or 0.0) > least_variance]
    removed: dict[str, str] = {}
    if len(names) > 1:
        # One row per pair of columns.
        for row in correlations(df, names).collect():
            a, b = row["feature_a"], row["feature_b"]
            if a not in removed and b not in removed and abs(row["correlation"] or 0.0) > most_correlation:
                removed[b] = a
    left = [c for c in names if c not in removed]
    by_value = sorted(left, key=lambda c: -(tests[c]["f_value"] if tests[c]["f_value"] is not None else -1.0))
    kept = set(by_value[:top])
    return df.sparkSession.createDataFrame(
        [(c, tests[c]["variance"], tests[c]["f_value"], removed.get(c), c in kept) for c in columns],
        "feature string, variance double, f_value double, most_correlated string, kept boolean",
    )


def select_features(df: DataFrame, columns: Sequence[str], label: str, **limits) -> list[str]:
    """Names of the columns that ``feature_selection`` keeps, in their order."""
    return [r["feature"] for r in feature_selection(df, columns, label, **limits).collect() if r["kept"]]


def keep_important(importances: Sequence[float], top: int, features: str = "features", output: str = "reduced") -> VectorSlicer:
    """A slicer to the ``top`` features by importance, in their original order."""
    best = sorted(range(len(importances)), key=lambda i: (-importances[i], i))[:top]
    return VectorSlicer(inputCol=features, outputCol=output, indices=sorted(best))


def principal_components(k: int, features: str = "features", output: str = "components") -> PCA:
    """Projection to the first ``k`` principal components."""
    return PCA(k=k, inputCol=features, outputCol=output)
