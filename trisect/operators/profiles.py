"""Profiles of a table: small, mergeable, kept as versions, good for quantiles and drift without reading the rows again.

A profile has one row per group and column of numbers, with a quantile sketch, and one per group, column and value of categories, with its count.
Profiles of parts add up to that of the whole, so profiles by day give those of a month, and a stored reference profile serves for ever.

Counts, extremes, sums and categories are exact. Ranks from a sketch of ``size`` k are off by a share of the rows, at 4096 by less than 0.002 with
high probability; up to about k rows they are exact. The index of a bin's share p is thus off by about 2 * 0.002 * |ln(p / q)| per bin. Sketches
choose at random what they keep, so that two of the same rows differ, within the bound.

Null and NaN values are counted in ``n_null`` and are in no sketch; a null category is a value of its own, with value null. An empty
table has an empty profile. A profile row's ``value`` is text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisect.functions.keys import ordinal
from trisect.operators.drift import BINS, Edges, divergences
from trisect.operators.quantiles import edge_probabilities
from trisect.operators.ranking import SKETCH_FAN

SIZE = 4096
MEASURES = ("n", "n_null", "low", "high", "total", "squares", "sketch")
NUMBER, CATEGORY = "number", "category"


def _merged_numbers(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def _numbers(df: DataFrame, columns: Sequence[str], by: Sequence[str], size: int) -> DataFrame:
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), ordinal(df, c).alias("x")) for c in columns]))
    x = F.col("x")
    parts = df.select(*by, values).groupBy(*by, "column", (F.spark_partition_id() % SKETCH_FAN).alias("_part")).agg(
        F.count(x).alias("n"), F.count_if(x.isNull()).alias("n_null"), F.min(x).alias("low"), F.max(x).alias("high"),
        F.sum(x).alias("total"), F.sum(x * x).alias("squares"), F.kll_sketch_agg_double(x, F.lit(size)).alias("sketch"),
    )
    table = _merged_numbers(parts, [*by, "column"])
    return table.select(*by, "column", F.lit(NUMBER).alias("kind"), F.lit(None).cast("string").alias("value"), *MEASURES)


def _categories(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    counts = df.select(*by, values).groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("double")
    return counts.select(
        *by, "column", F.lit(CATEGORY).alias("kind"), "value", "n", F.lit(0).cast("long").alias("n_null"),
        *[none.alias(c) for c in ("low", "high", "total", "squares")], F.lit(None).cast("binary").alias("sketch"),
    )


def profile(
    df: DataFrame, columns: Sequence[str], categories: Sequence[str] = (), by: Sequence[str] = (), size: int = SIZE
) -> DataFrame:
    """The profile of numeric ``columns`` and of ``categories``, per group of ``by`` or of the whole table."""
    if not columns and not categories:
        raise ValueError("name the columns to profile")
    tables = ([_numbers(df, columns, by, size)] if columns else []) + ([_categories(df, categories, by)] if categories else [])
    return tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])


def merge(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The profile of coarser groups, from the rows of profiles of finer ones."""
    key = [*by, "column", "kind", "value"]
    numbers = _merged_numbers(profiles.where(F.col("kind") == NUMBER), key)
    categories = profiles.where(F.col("kind") == CATEGORY).groupBy(*key).agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), *[F.min(m).alias(m) for m in MEASURES[2:]]
    )
    return numbers.unionByName(categories)


def moments(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and sample variance of numbers, and extremes: ``by, column, n, n_null, low, high, mean, variance``."""
    n, total = F.col("n"), F.col("total")
    spread = F.greatest(F.col("squares") - total * total / n, F.lit(0.0))
    return profiles.where(F.col("kind") == NUMBER).select(
        *by, "column", "n", "n_null", "low", "high", (total / F.when(n > 0, n)).alias("mean"),
        F.when(n > 1, spread / (n - 1)).alias("variance"),
    )


def profile_quantiles(profiles: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Approximate quantiles, each a value that occurs: ``by, column, n, i, quantile``."""
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    some = profiles.where((F.col("kind") == NUMBER) & (F.col("n") > 0))
    found = some.select(*by, "column", "n", F.posexplode(F.kll_sketch_get_quantile_double("sketch", asked)).alias("i", "quantile"))
    return found


def profile_edges(reference: DataFrame, bins: int = BINS) -> Edges:
    """Equal-frequency edges of every column of numbers: ``bins + 1`` numbers per column reach the driver."""
    rows = profile_quantiles(reference, edge_probabilities(bins)).groupBy("column").agg(
        F.array_sort(F.collect_list(F.struct("i", "quantile"))).alias("e")
    ).collect()
    return {r["column"]: [e["quantile"] for e in r["e"]] for r in rows}


def _bin_counts(profiles: DataFrame, edges: Edges, by: Sequence[str], name: str) -> DataFrame:
    """``by, column, bin, name``: numbers per bin from the sketches' ranks, null for those outside; categories as they are."""
    categories = profiles.where((F.col("kind") == CATEGORY) & F.col("value").isNotNull()).select(
        *by, "column", F.col("value").alias("bin"), F.col("n").cast("double").alias(name)
    )
    if not edges:
        return categories
    # A rank counts the values up to and with a number, so the one just below an edge counts those before it.
    cuts = {c: [*(math.nextafter(x, -math.inf) for x in e[:-1]), e[-1]] for c, e in edges.items()}
    ranks = [
        F.when(F.col("column") == c, F.kll_sketch_get_rank_double("sketch", F.array(*map(F.lit, e)))) for c, e in cuts.items()
    ]
    some = profiles.where((F.col("kind") == NUMBER) & (F.col("n") > 0) & F.col("column").isin(*edges))
    ranked = some.withColumn("_r", F.coalesce(*ranks))
    inside = F.transform(
        F.sequence(F.lit(1), F.size("_r") - 1),
        lambda i: F.struct((i - 1).cast("string").alias("bin"), (F.element_at("_r", i + 1) - F.element_at("_r", i)).alias("share")),
    )
    outside = F.array(F.struct(
        F.lit(None).cast("string").alias("bin"), (F.element_at("_r", 1) + 1.0 - F.element_at("_r", -1)).alias("share")
    ))
    shares = ranked.select(*by, "column", "n", F.inline(F.concat(inside, outside)))
    return shares.select(*by, "column", "bin", (F.col("share") * F.col("n")).alias(name)).unionByName(categories)


def profile_drift(reference: DataFrame, current: DataFrame, by: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """PSI and Jensen-Shannon divergence of every group of ``current`` against the reference: ``by, column, psi, js_divergence``.

    Numbers are compared over the reference's equal-frequency bins, categories value by value, nulls left out.
    """
    edges = profile_edges(reference, bins)
    zero: Column = F.lit(0.0)
    now = _bin_counts(current, edges, by, "n_cur")
    groups = now.select(*by, "column").distinct()
    expected = groups.join(_bin_counts(reference, edges, (), "n_ref"), "column").withColumn("n_cur", zero)
    counts = now.withColumn("n_ref", zero).unionByName(expected).groupBy(*by, "column", "bin").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )
    return divergences(counts, by=[*by, "column"])
