"""Distribution summaries: histograms, box summaries, empirical CDF, profiles of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisect.functions.keys import join_groups, ordinal, present
from trisect.functions.stats import ratio
from trisect.operators.quantiles import (
    bucketed_long,
    edge_bin,
    edge_lists,
    edge_probabilities,
    long_quantiles,
    quantiles,
)
from trisect.operators.ranking import running_totals
from trisect.session import lookup

# Fixed values
PLOT_BINS = 20
WHISKER = 1.5


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    values = [F.struct(F.lit(c).alias("column"), ordinal(df, c).alias("value")) for c in dict.fromkeys(columns)]
    return df.select(*by, F.inline(F.array(*values))).where(F.col("value").isNotNull())


def histogram_equal_width(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bins: int = PLOT_BINS
) -> DataFrame:
    """Equal-width histogram over each group's own range: ``by, column, bin, low, high, n``.

    All bins are listed, empty ones too. A constant column is widened by half a unit each way.
    """
    keys = [*by, "column"]
    long = _long(df, columns, by)
    ranges = long.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ranges = lookup(ranges.select(
        *keys,
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ))
    edge = lambda i: F.when(i == bins, F.col("hi")).otherwise(F.col("lo") + i * ((F.col("hi") - F.col("lo")) / bins))
    guess = F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int"), F.lit(bins - 1))
    # The guess may be one off where rounding puts a value on the other side of an edge.
    moved = (
        join_groups(long, ranges, keys)
        .withColumn("guess", guess)
        .withColumn("bin", F.col("guess")
                    - (F.col("value") < edge(F.col("guess"))).cast("int")
                    + ((F.col("value") >= edge(F.col("guess") + 1)) & (F.col("guess") < bins - 1)).cast("int"))
    )
    counts = moved.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    listed = join_groups(frame, counts, [*keys, "bin"], "left")
    return listed.select(
        *keys, "bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_summary(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Box plot figures: ``by, column, n, q1, median, q3, whisker_low, whisker_high, outliers``.

    Whiskers reach to the last value within 1.5 interquartile ranges of the box.
    """
    keys = [*by, "column"]
    found = quantiles(df, columns, [0.25, 0.5, 0.75], by)
    pick = lambda i: F.max(F.when(F.col("i") == i, F.col("quantile")))
    boxes = lookup(found.groupBy(*keys).agg(
        F.max("n").alias("n"), pick(0).alias("q1"), pick(1).alias("median"), pick(2).alias("q3")
    ))
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    value = F.col("value")
    whiskers = join_groups(_long(df, columns, by), boxes, keys).groupBy(*keys).agg(
        F.min(F.when(value >= low, value)).alias("w_low"),
        F.max(F.when(value <= high, value)).alias("w_high"),
        F.count_if((value < low) | (value > high)).alias("outliers"),
    )
    return join_groups(boxes, whiskers, keys, "left").select(
        *keys, "n", "q1", "median", "q3",
        F.least("w_low", "q1").alias("whisker_low"),
        F.greatest("w_high", "q3").alias("whisker_high"),
        "outliers",
    )


def ecdf(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Empirical CDF points ``(value, i / n)`` with i from 0: ``by, column, value, n, cdf_low, cdf_high``.

    Equal values share one row: their points run from ``cdf_low`` to ``cdf_high`` in steps of one
    over the group size, so nothing is lost and a frequent value is not repeated.
    """
    keys = [*by, "column"]
    long, _ = bucketed_long(df, columns, extra=by)
    counts = long.groupBy(*keys, "bucket", "value").agg(F.count("*").alias("n"))
    ranked = running_totals(counts, keys, "bucket", [F.col("value")], ["n"])
    sizes = lookup(long.groupBy(*keys).agg(F.count("*").alias("size")))
    before, size = F.col("n_before"), F.col("size")
    return join_groups(ranked, sizes, keys).select(
        *keys, "value", "n",
        (before.cast("double") / size).alias("cdf_low"),
        ((before + F.col("n") - 1).cast("double") / size).alias("cdf_high"),
    )


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Profile per numeric column: counts, nulls, distinct, moments, range and quartiles."""
    names = list(dict.fromkeys(columns))
    values = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.when(present(df, c), ordinal(df, c)).alias("value")) for c in names
    ]))
    long = df.select(values)
    value = F.col("value")
    moments = long.groupBy("column").agg(
        F.count("*").alias("n_rows"),
        F.count_if(value.isNull()).alias("nulls"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("sd"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.skewness(value).alias("skewness"),
        F.kurtosis(value).alias("kurtosis"),
    )
    distinct = (
        long.where(value.isNotNull()).groupBy("column", "value").agg(F.lit(1).alias("one"))
        .groupBy("column").agg(F.count("*").alias("distinct"))
    )
    pick = lambda i: F.max(F.when(F.col("i") == i, F.col("quantile")))
    quartiles = quantiles(df, names, [0.25, 0.5, 0.75]).groupBy("column").agg(
        pick(0).alias("q1"), pick(1).alias("median"), pick(2).alias("q3")
    )
    return moments.join(distinct, "column", "left").join(quartiles, "column", "left")


def outlier_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Values beyond the box plot whiskers: ``by, column, n, outliers, outlier_share``."""
    return box_summary(df, columns, by).select(
        *by, "column", "n", "outliers", ratio(F.col("outliers"), F.col("n")).alias("outlier_share")
    )


def target_by_bin(df: DataFrame, columns: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Target mean per equal-frequency bin of each feature: ``column, bin, n, low, high, target_mean``."""
    names = list(dict.fromkeys(columns))
    long, _ = bucketed_long(df, names)
    edges = edge_lists(long_quantiles(long, ["column"], edge_probabilities(bins)), names)
    values = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), ordinal(df, c).alias("value"), edge_bin(ordinal(df, c), e).alias("bin"))
        for c, e in edges.items()
    ]))
    return df.select(F.col(target).cast("double").alias("target"), values).where(F.col("bin").isNotNull()).groupBy(
        "column", "bin"
    ).agg(
        F.count("*").alias("n"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.avg("target").alias("target_mean"),
    )


def visual_report(assigned: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """The tables behind histogram, box plot and CDF of every subset of an assigned table."""
    rows = assigned.where(F.col("subset").isNotNull())
    return {
        "histogram": histogram_equal_width(rows, columns, ["subset"]),
        "box": box_summary(rows, columns, ["subset"]),
        "ecdf": ecdf(rows, columns, ["subset"]),
    }
