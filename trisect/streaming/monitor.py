"""Continuous monitoring: bin counts of a stream per time window, against fixed reference edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisect.functions.keys import ordinal, present
from trisect.operators.drift import Edges, divergences
from trisect.operators.quantiles import edge_bin


def windowed_bin_counts(stream: DataFrame, time: str, window: str, lateness: str, edges: Edges) -> DataFrame:
    """Rows per window, column and bin: ``window_start, column, bin, n_cur``.

    The state is one counter per open window, column and bin, whatever the rate of the stream;
    rows later than ``lateness`` are left to the batch report.
    """
    values = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), edge_bin(ordinal(stream, c), e).alias("bin"), present(stream, c).alias("there"))
        for c, e in edges.items()
    ]))
    return (
        stream.withWatermark(time, lateness)
        .select(time, values)
        .where("there")
        .groupBy(F.window(time, window), "column", "bin")
        .agg(F.count("*").alias("n_cur"))
        .select(F.col("window.start").alias("window_start"), "column", "bin", "n_cur")
    )


def window_divergences(counts: DataFrame, reference: DataFrame) -> DataFrame:
    """PSI and Jensen-Shannon divergence of each closed window: ``window_start, column, psi, js_divergence``.

    ``counts`` is the written output of the stream, ``reference`` the bin counts (``column, bin,
    n_ref``) of the reference table; both are as small as the number of bins and windows.
    """
    windows = counts.select("window_start", "column").distinct()
    expected = windows.join(reference.select("column", "bin", "n_ref"), "column").withColumn("n_cur", F.lit(0))
    both = (
        counts.withColumn("n_ref", F.lit(0))
        .unionByName(expected)
        .groupBy("window_start", "column", "bin")
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )
    return divergences(both, by=["window_start", "column"])
