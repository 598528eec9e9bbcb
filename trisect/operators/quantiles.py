"""Exact interpolated quantiles, per column and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisect.functions.keys import ordinal
from trisect.functions.stats import lerp
from trisect.operators.ranking import BUCKETS, Buckets, add_buckets, at_positions, fit_buckets


def bucketed_long(
    df: DataFrame,
    columns: Sequence[str],
    extra: Sequence[str] = (),
    buckets: dict[str, Buckets] | None = None,
    n_buckets: int = BUCKETS,
) -> tuple[DataFrame, dict[str, Buckets]]:
    """One row per value: ``extra``, ``column``, ``bucket``, ``value``; nulls and NaN dropped."""
    narrow = df.select(*extra, *[ordinal(df, c).alias(f"_v{i}") for i, c in enumerate(columns)])
    names = {f"_v{i}": f"_b{i}" for i in range(len(columns))}
    if buckets is None:
        fitted = fit_buckets(narrow, list(names), n_buckets)
        buckets = {c: fitted[f"_v{i}"] for i, c in enumerate(columns)}
    wide = add_buckets(narrow, {f"_v{i}": buckets[c] for i, c in enumerate(columns)}, names)
    long = wide.select(*extra, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_b{i}").alias("bucket"), F.col(f"_v{i}").alias("value"))
        for i, c in enumerate(columns)
    ]))).where(F.col("value").isNotNull())
    return long, buckets


def long_quantiles(
    long: DataFrame, by: Sequence[str], probabilities: Sequence[float], counts: DataFrame | None = None
) -> DataFrame:
    """Quantiles of a long table with ``bucket`` and ``value``: ``by``, ``n``, ``i``, ``quantile``.

    ``counts`` (``by``, ``bucket``, ``_rows``) spares the counting of buckets where they are counted already.
    """
    place = lambda q: lambda n: (n - 1) * F.lit(float(q))
    positions = {}
    for i, q in enumerate(probabilities):
        positions[f"{i}_low"] = lambda n, q=q: F.floor(place(q)(n)) + 1
        positions[f"{i}_high"] = lambda n, q=q: F.ceil(place(q)(n)) + 1
    found = at_positions(long, by, "bucket", ["value"], positions, counts=counts)
    parts = F.split("label", "_")
    pairs = found.groupBy(*by, "n", parts[0].cast("int").alias("i")).agg(
        F.max(F.when(parts[1] == "low", F.col("value"))).alias("low"),
        F.max(F.when(parts[1] == "high", F.col("value"))).alias("high"),
    )
    q = F.element_at(F.array(*[F.lit(float(p)) for p in probabilities]), F.col("i") + 1)
    where = (F.col("n") - 1) * q
    return pairs.select(*by, "n", "i", lerp(F.col("low"), F.col("high"), where - F.floor(where)).alias("quantile"))


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles: ``by``, ``column``, ``n``, ``i`` (index of the probability), ``quantile``."""
    long, _ = bucketed_long(df, columns, extra=by)
    return long_quantiles(long, [*by, "column"], probabilities)


def edge_probabilities(bins: int) -> list[float]:
    """Equally spaced probabilities from 0 to 1, ``bins + 1`` of them."""
    return [i / bins for i in range(bins + 1)]


def edge_lists(edges: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """Bring the quantiles of whole columns to the driver: one short list per column.

    A column without values has an empty list.
    """
    rows = edges.groupBy("column").agg(F.array_sort(F.collect_list(F.struct("i", "quantile"))).alias("e")).collect()
    found = {row["column"]: [e["quantile"] for e in row["e"]] for row in rows}
    return {c: found.get(c, []) for c in columns}


def edge_bin(value: Column, edges: Sequence[float], open_ends: bool = False) -> Column:
    """0-based bin of a value on literal, possibly repeated, edges; the last bin is closed.

    Values outside the edges give null, or with ``open_ends`` the first or last bin.
    """
    if not edges:
        return F.lit(None).cast("int")
    reached = sum(((value >= e).cast("int") for e in edges[1:-1]), F.lit(0))
    if open_ends:
        return F.when(value.isNotNull(), reached)
    return F.when(value.between(edges[0], edges[-1]), reached)
