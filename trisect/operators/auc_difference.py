"""Whether one score separates two classes better than another on the same rows, with its uncertainty.

The variance of the difference of two correlated areas comes from placement values: for each positive row the share of negatives
it beats, for each negative row the share of positives that beat it, ties counting half. The values are ranks, so they are found per distinct
score, by running totals over buckets, and joined to the distinct pairs of scores.

Rows where a score is null or NaN are left out; a null label is negative. With fewer than two rows of a class there is no
variance, and interval and p-value are null. Two scores that order all rows alike have no difference and a p-value of 1.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisect.functions.keys import join_groups
from trisect.functions.stats import normal_two_sided, ratio
from trisect.operators.ranking import add_buckets, fit_buckets, running_totals
from trisect.session import lookup


def _placements(pairs: DataFrame, score: str, totals: DataFrame) -> DataFrame:
    """Per distinct score: the share of negatives below it and of positives above it."""
    counts = pairs.groupBy(score).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    binned = add_buckets(counts, fit_buckets(counts, [score]), {score: "bucket"})
    ranked = join_groups(running_totals(binned, [], "bucket", [F.col(score)], ["pos", "neg"]), totals, [])
    before = lambda side: F.coalesce(F.col(f"{side}_before"), F.lit(0)) + F.col(side) / 2
    return ranked.select(
        score,
        ratio(before("neg"), F.col("n_neg")).alias(f"{score}_beats"),
        (1.0 - ratio(before("pos"), F.col("n_pos"))).alias(f"{score}_beaten"),
    )


def auc_difference(
    df: DataFrame, label: str, first: Column | str, second: Column | str, positive=1, level: float = 0.95
) -> DataFrame:
    """One row: ``n_pos, n_neg, auc_first, auc_second, delta, std_error, low, high, z, p_value``.

    ``delta`` is the first area less the second, ``low`` to ``high`` its interval at the level, ``p_value`` that of the two-sided test.
    """
    value = lambda s: (F.col(s) if isinstance(s, str) else s).cast("double")
    rows = df.select(
        F.coalesce(F.col(label) == F.lit(positive), F.lit(False)).alias("hit"), value(first).alias("a"), value(second).alias("b")
    ).where("a IS NOT NULL AND b IS NOT NULL AND NOT isnan(a) AND NOT isnan(b)")
    pairs = lookup(rows.groupBy("a", "b").agg(F.count_if("hit").alias("pos"), F.count_if(~F.col("hit")).alias("neg")))
    totals = lookup(pairs.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")))
    joined = pairs.join(_placements(pairs, "a", totals), "a").join(_placements(pairs, "b", totals), "b")
    sums = [F.sum(F.col("pos") * F.col(f"{s}_beats")).alias(f"auc_{s}") for s in "ab"]
    for side, kind in (("pos", "beats"), ("neg", "beaten")):
        gap = F.col(f"a_{kind}") - F.col(f"b_{kind}")
        sums += [F.sum(F.col(side) * gap).alias(f"{side}_sum"), F.sum(F.col(side) * gap * gap).alias(f"{side}_squares")]
    row = join_groups(joined.agg(*sums), totals, [])

    def variance(side: str) -> Column:
        n = F.col(f"n_{side}")
        spread = F.col(f"{side}_squares") - F.col(f"{side}_sum") * F.col(f"{side}_sum") / n
        return F.when(n > 1, F.greatest(spread, F.lit(0.0)) / (n - 1) / n)

    table = row.select(
        F.coalesce("n_pos", F.lit(0).cast("long")).alias("n_pos"), F.coalesce("n_neg", F.lit(0).cast("long")).alias("n_neg"),
        *[F.when(F.col("n_neg") > 0, ratio(F.col(f"auc_{s}"), F.col("n_pos"))).alias(name) for s, name in (("a", "auc_first"), ("b", "auc_second"))],
        F.sqrt(variance("pos") + variance("neg")).alias("std_error"),
    ).withColumn("delta", F.col("auc_first") - F.col("auc_second"))
    reach = NormalDist().inv_cdf(0.5 + level / 2)
    z = F.when(F.col("std_error") > 0, F.col("delta") / F.col("std_error"))
    table = table.withColumn("z", z)
    p = F.when(F.col("std_error") > 0, normal_two_sided(F.col("z"))).when(F.col("std_error") == 0, F.when(F.col("delta") == 0, 1.0).otherwise(0.0))
    return table.select(
        "n_pos", "n_neg", "auc_first", "auc_second", "delta", "std_error",
        (F.col("delta") - reach * F.col("std_error")).alias("low"), (F.col("delta") + reach * F.col("std_error")).alias("high"),
        "z", p.alias("p_value"),
    )
