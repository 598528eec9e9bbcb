"""Distance between two tables, column by column: PSI, Jensen-Shannon, Kolmogorov-Smirnov, moments.

Both tables are read as one, with a boolean ``is_ref`` column that tells the sides apart; every
statistic treats all columns in the same jobs. Bin edges come from the reference side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trisect.functions.keys import join_groups, ordinal
from trisect.functions.stats import js_term, ks_pvalue, psi_term, ratio
from trisect.operators.quantiles import bucketed_long, edge_bin, edge_lists, edge_probabilities, long_quantiles
from trisect.operators.ranking import Buckets
from trisect.session import lookup

# Fixed values
BINS = 10
STATISTICS = ("psi", "js_divergence", "ks_stat", "ks_pvalue", "mean_diff", "var_diff")

Edges = dict[str, list[float]]


def both_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The compared columns of two tables, stacked, with ``is_ref``."""
    return reference.select(*columns, F.lit(True).alias("is_ref")).unionByName(
        current.select(*columns, F.lit(False).alias("is_ref"))
    )


def marked(df: DataFrame, is_reference: Column, columns: Sequence[str], is_current: Column | None = None) -> DataFrame:
    """The compared columns of one table whose two sides are told apart by conditions."""
    both = df.withColumn("is_ref", F.when(is_reference, True).when(
        F.lit(True) if is_current is None else is_current, False
    ))
    return both.select(*columns, "is_ref").where("is_ref IS NOT NULL")


def _check_columns(columns: Sequence[str]) -> list[str]:
    names = [c for c in dict.fromkeys(columns) if c]
    if not names:
        raise ValueError("name the columns to compare, or a target")
    return names


class _Prepared:
    """Bucketed values of both sides and their bucket counts, shared by quantiles and KS."""

    def __init__(self, both: DataFrame, columns: Sequence[str], buckets: dict[str, Buckets] | None = None):
        self.columns = _check_columns(columns)
        self.both = both
        self.long, self.buckets = bucketed_long(both, self.columns, extra=["is_ref"], buckets=buckets)

        # Counted once: both the quantiles and the KS statistic look at the counts of buckets first.
        self.counts = lookup(self.long.groupBy("column", "bucket").agg(
            F.count_if("is_ref").alias("ref"), F.count_if(~F.col("is_ref")).alias("cur")
        ))

    def edges(self, bins: int) -> Edges:
        reference = self.long.where("is_ref").drop("is_ref")
        counts = self.counts.where("ref > 0").select("column", "bucket", F.col("ref").alias("_rows"))
        return edge_lists(long_quantiles(reference, ["column"], edge_probabilities(bins), counts), self.columns)


def reference_edges(both: DataFrame, columns: Sequence[str], bins: int = BINS) -> Edges:
    """Equal-frequency edges of the reference side: ``bins + 1`` numbers per column."""
    return _Prepared(both, columns).edges(bins)


def histogram_by_edges(
    both: DataFrame, edges: Edges, by: Sequence[str] = (), open_ends: bool = False, missing: bool = False
) -> DataFrame:
    """Counts per column and bin: ``by``, ``column``, ``bin`` (null outside), ``n_ref``, ``n_cur``.

    Bins are half open but for the last; repeated edges leave empty bins. Bins that are empty on
    both sides have no row. With ``missing``, null and NaN values are counted too, in rows of their own marked by that column.
    """
    binned = [
        F.struct(F.lit(c).alias("column"), ordinal(both, c).alias("value"), edge_bin(ordinal(both, c), e, open_ends).alias("bin"))
        for c, e in edges.items()
    ]
    values = both.select(*by, "is_ref", F.inline(F.array(*binned)))
    if missing:
        values, by = values.withColumn("missing", F.col("value").isNull()), [*by, "missing"]
    else:
        values = values.where(F.col("value").isNotNull())
    return (
        values.groupBy(*by, "column", "bin")
        .agg(F.count_if("is_ref").alias("n_ref"), F.count_if(~F.col("is_ref")).alias("n_cur"))
    )


def category_counts(both: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same counts for categorical columns: each category is a bin."""
    values = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("bin")) for c in _check_columns(columns)]
    return (
        both.select("is_ref", F.inline(F.array(*values)))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count_if("is_ref").alias("n_ref"), F.count_if(~F.col("is_ref")).alias("n_cur"))
    )


def divergences(counts: DataFrame, by: Sequence[str] = ("column",)) -> DataFrame:
    """``psi`` and ``js_divergence`` from bin counts.

    Shares are taken of all values, those outside the edges included. For Jensen-Shannon the
    shares of both sides and their mean are then each normalised to sum to one over the bins.
    """
    # Read twice, so computed once; totals are joined, since one column may have many categories.
    counts = lookup(counts)
    inside = F.col("bin").isNotNull()
    totals = counts.groupBy(*by).agg(
        F.sum("n_ref").alias("all_ref"),
        F.sum("n_cur").alias("all_cur"),
        F.sum(F.when(inside, F.col("n_ref"))).alias("in_ref"),
        F.sum(F.when(inside, F.col("n_cur"))).alias("in_cur"),
    )
    share = lambda part, whole: ratio(F.col(part), F.col(whole))
    shares = join_groups(counts.where(inside), lookup(totals), by).select(
        *by,
        share("n_ref", "all_ref").alias("p"),
        share("n_cur", "all_cur").alias("q"),
        share("n_ref", "in_ref").alias("p1"),
        share("n_cur", "in_cur").alias("q1"),
        (share("in_ref", "all_ref") + share("in_cur", "all_cur")).alias("both"),
    )
    p, q = F.col("p"), F.col("q")
    return shares.groupBy(*by).agg(
        F.sum(psi_term(p, q)).alias("psi"),
        F.sum(js_term(F.col("p1"), F.col("q1"), (p + q) / F.col("both"))).alias("js_divergence"),
    )


def psi(both: DataFrame, columns: Sequence[str], bins: int = BINS, open_ends: bool = False) -> DataFrame:
    """Population stability index per column."""
    edges = reference_edges(both, columns, bins)
    return divergences(histogram_by_edges(both, edges, open_ends=open_ends)).select("column", "psi")


def js_divergence(both: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """Jensen-Shannon divergence (natural logarithm) per column."""
    edges = reference_edges(both, columns, bins)
    return divergences(histogram_by_edges(both, edges)).select("column", "js_divergence")


def ks(both: DataFrame, columns: Sequence[str], prepared: _Prepared | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov: ``column``, ``ks_stat``, ``ks_pvalue``, ``n_ref``, ``n_cur``.

    Bucket counts give the distance at every bucket end and a bound on the distance inside every
    bucket. Only buckets whose bound exceeds the largest end distance are looked into, so two
    clearly different samples are compared without sorting them.
    """
    prepared = prepared or _Prepared(both, columns)
    sides = [F.count_if("is_ref").alias("ref"), F.count_if(~F.col("is_ref")).alias("cur")]
    counts = prepared.counts
    so_far = Window.partitionBy("column").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    column = Window.partitionBy("column")
    share = lambda part, whole: ratio(F.col(part), F.col(whole))
    ends = lookup(
        counts.withColumns({
            "ref_end": F.sum("ref").over(so_far),
            "cur_end": F.sum("cur").over(so_far),
            "n_ref": F.sum("ref").over(column),
            "n_cur": F.sum("cur").over(column),
        })
        .withColumn("at_end", F.abs(share("ref_end", "n_ref") - share("cur_end", "n_cur")))
        .withColumn("known", F.max("at_end").over(column))
        .withColumns({"ref_start": F.col("ref_end") - F.col("ref"), "cur_start": F.col("cur_end") - F.col("cur")})
        .withColumn("bound", F.greatest(
            share("ref_end", "n_ref") - share("cur_start", "n_cur"),
            share("cur_end", "n_cur") - share("ref_start", "n_ref"),
        ))
    )
    open_buckets = lookup(ends.where("bound > known").select(
        "column", "bucket", "ref_start", "cur_start", "n_ref", "n_cur"
    ))
    keys = ["column", "bucket"]
    values = (
        join_groups(prepared.long, open_buckets.select(*keys), keys, "left_semi")
        .groupBy(*keys, "value")
        .agg(*sides)
    )
    inside = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    running = values.select(*keys, F.sum("ref").over(inside).alias("ref"), F.sum("cur").over(inside).alias("cur"))
    looked_into = join_groups(running, open_buckets, keys).select("column", F.abs(
        ratio(F.col("ref_start") + F.col("ref"), F.col("n_ref")) - ratio(F.col("cur_start") + F.col("cur"), F.col("n_cur"))
    ).alias("distance"))
    at_ends = ends.select("column", F.col("known").alias("distance"))
    stat = at_ends.unionByName(looked_into).groupBy("column").agg(F.max("distance").alias("ks_stat"))
    sizes = ends.groupBy("column").agg(F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"))
    return stat.join(sizes, "column").select(
        "column", "ks_stat", ks_pvalue(F.col("ks_stat"), F.col("n_ref"), F.col("n_cur")).alias("ks_pvalue"), "n_ref", "n_cur"
    )


def mean_var_diff(both: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Difference of means and of sample variances, reference minus current, per column."""
    names = _check_columns(columns)
    values = {c: ordinal(both, c) for c in names}
    side = lambda f, c, ref: f(F.when(F.col("is_ref") == ref, values[c]))
    row = both.agg(*[
        (side(f, c, True) - side(f, c, False)).alias(f"{what}_{i}")
        for i, c in enumerate(names)
        for what, f in (("mean", F.avg), ("var", F.var_samp))
    ])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"mean_{i}").alias("mean_diff"), F.col(f"var_{i}").alias("var_diff"))
        for i, c in enumerate(names)
    ])))


def stability_report(both: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """All statistics, one row per column; what cannot be computed for lack of values is null."""
    prepared = _Prepared(both, columns)
    counts = histogram_by_edges(both, prepared.edges(bins))
    tables = [
        mean_var_diff(both, columns),
        divergences(counts),
        ks(both, columns, prepared).select("column", "ks_stat", "ks_pvalue"),
    ]
    joined = reduce(lambda a, b: a.join(b, "column", "left"), tables)
    return joined.select("column", *STATISTICS)


def split_report(
    assigned: DataFrame, columns: Sequence[str], reference: str = "train", current: str = "test", bins: int = BINS
) -> DataFrame:
    """Stability report between two subsets of an assigned table, train against test by default."""
    rows = assigned.where(F.col("subset").isin(reference, current))
    both = rows.select(*columns, (F.col("subset") == reference).alias("is_ref"))
    return stability_report(both, columns, bins)
