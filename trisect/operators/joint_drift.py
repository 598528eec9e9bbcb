"""Drift of several columns together: maximum mean discrepancy by random Fourier features.

Column by column two tables may look alike while the columns hang together differently. The rows' values, scaled by the reference, become
cosines of random projections; the squared distance between the two sides' mean cosines is the discrepancy under a Gaussian kernel, and 0
only if the sides agree. It takes one aggregate of sums.

For the p-value the rows of each side are dealt to blocks of the same size by a hash; the sums of a block are all that is kept, and blocks
change sides at random. As many numbers as there are blocks times features reach the driver, whatever the number of rows.

Rows with a null, NaN or infinite value in one of the columns are left out. A column that does not vary on the reference side is only centred.
With an empty side there is no discrepancy, with fewer than two blocks on a side no p-value. Equal rows are in the same block.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisect.functions.keys import ordinal
from trisect.operators.drift import _check_columns

SCHEMA = "mmd2 double, p_value double, n_ref long, n_cur long"
# Blocks of both sides together, and rows a block should have at least.
BLOCKS = 256
LEAST_BLOCK = 8


def fourier_features(n_columns: int, features: int, seed: int, bandwidth: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Projections and phases; the bandwidth, in standard deviations, is by default the root of the number of columns."""
    rng = np.random.default_rng(seed)
    width = math.sqrt(n_columns) if bandwidth is None else bandwidth
    return rng.normal(size=(features, n_columns)) / width, rng.uniform(0, 2 * math.pi, features)


def _scales(rows: DataFrame, n_columns: int) -> tuple[int, int, list[float], list[float]]:
    """Rows of both sides; mean and deviation of the reference side."""
    of_ref = lambda i: F.when(F.col("is_ref"), F.col(f"x{i}"))
    row = rows.agg(
        F.count_if("is_ref").alias("n_ref"), F.count_if(~F.col("is_ref")).alias("n_cur"),
        *[F.avg(of_ref(i)).alias(f"m{i}") for i in range(n_columns)],
        *[F.stddev_samp(of_ref(i)).alias(f"s{i}") for i in range(n_columns)],
    ).first()
    return row["n_ref"], row["n_cur"], [row[f"m{i}"] for i in range(n_columns)], [row[f"s{i}"] or 1.0 for i in range(n_columns)]


def permuted_distances(sums: np.ndarray, counts: np.ndarray, n_first: int, permutations: int, seed: int) -> np.ndarray:
    """Squared distances of mean features after dealing the blocks anew, ``n_first`` of them to the first side."""
    rng = np.random.default_rng([seed, 1])
    first = np.zeros((permutations, len(counts)))
    for r in range(permutations):
        first[r, rng.permutation(len(counts))[:n_first]] = 1.0
    mean = lambda side: (side @ sums) / (side @ counts)[:, None]
    return ((mean(first) - mean(1.0 - first)) ** 2).sum(axis=1)


def joint_drift(
    both: DataFrame, columns: Sequence[str], features: int = 64, seed: int = 7, bandwidth: float | None = None,
    permutations: int = 499, blocks: int = BLOCKS,
) -> DataFrame:
    """One row: ``mmd2, p_value, n_ref, n_cur``, for rows marked by ``is_ref``."""
    names = _check_columns(columns)
    rows = both.select("is_ref", *[ordinal(both, c).alias(f"x{i}") for i, c in enumerate(names)])
    finite = [F.abs(F.col(f"x{i}")) < F.lit(float("inf")) for i in range(len(names))]
    for condition in finite:
        rows = rows.where(condition)
    spark = both.sparkSession
    n_ref, n_cur, mean, deviation = _scales(rows, len(names))
    if not n_ref or not n_cur:
        return spark.createDataFrame([(None, None, n_ref, n_cur)], SCHEMA)
    weights, phases = fourier_features(len(names), features, seed, bandwidth)

    def feature(j: int) -> Column:
        parts = [(F.col(f"x{i}") - mean[i]) / deviation[i] * float(weights[j, i]) for i in range(len(names))]
        return F.cos(sum(parts[1:], parts[0]) + float(phases[j]))

    n = n_ref + n_cur
    per_side = [max(1, min(round(blocks * k / n), k // LEAST_BLOCK)) for k in (n_ref, n_cur)]
    mark = F.xxhash64(F.lit(seed), *[f"x{i}" for i in range(len(names))])
    block = F.pmod(mark, F.when(F.col("is_ref"), per_side[0]).otherwise(per_side[1]))
    kept = rows.groupBy("is_ref", block.alias("block")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(feature(j)).alias(f"f{j}") for j in range(features)]
    ).orderBy("is_ref", "block").collect()
    side = np.array([r["is_ref"] for r in kept])
    counts = np.array([r["n"] for r in kept], float)
    sums = np.array([[r[f"f{j}"] for j in range(features)] for r in kept]) * math.sqrt(2 / features)
    gap = sums[side].sum(axis=0) / counts[side].sum() - sums[~side].sum(axis=0) / counts[~side].sum()
    found = float((gap**2).sum())
    p = None
    if min(side.sum(), (~side).sum()) > 1:
        others = permuted_distances(sums, counts, int(side.sum()), permutations, seed)
        p = float((1 + (others >= found).sum()) / (1 + permutations))
    return spark.createDataFrame([(found, p, n_ref, n_cur)], SCHEMA)
