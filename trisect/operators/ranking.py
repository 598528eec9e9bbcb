"""Exact ranks, prefix sums and order statistics without a one-task sort.

Rows get an order-respecting bucket, buckets are counted, and only then is anything sorted: all
buckets (``running_totals``) or just those that hold a wanted position (``at_positions``). No
group of rows, however hot, is sorted in one piece: a group spreads over the buckets, and equal
values are counted before they are sorted.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trisect.functions.keys import hash_prefix, join_groups, ordinal, prefix_digits, present
from trisect.session import lookup

# Quantile buckets of a large table, and the even parts each may further be cut into.
BUCKETS = 1024
MOST_PARTS = 4096
# Large tables get so many parts that a bucket holds at most about this many rows.
BUCKET_ROWS = 1_000_000
# Small tables make do with fewer buckets, of this many rows.
SMALL_BUCKET_ROWS = 10_000
MIN_BUCKETS = 64
# Size parameter of the sketches: about 30 KB each, ranks right to about a tenth of a percent.
SKETCH_SIZE = 2048
# Partial sketches are merged in this many groups before the final merge.
SKETCH_FAN = 64
# Largest magnitude up to which every whole number is its own double.
EXACT_DOUBLE = 2.0**53
# Columns that order_by_value orders by.
VALUE_ORDER = ("_missing", "_at", "_tie")
# Hash digits by which the null values are spread.
MISSING_DIGITS = 4


@dataclass(frozen=True)
class Buckets:
    """Order-respecting buckets of one double column.

    ``edges`` runs from minus to plus infinity; each interval is cut evenly into ``parts``.
    ``single`` maps the intervals that hold exactly one, frequent value to the number of hash
    digits that spread its rows well. Null values have an interval of their own, after all others.
    """

    edges: tuple[float, ...]
    single: dict[int, int]
    parts: int = 1

    @property
    def missing(self) -> int:
        return len(self.edges)

    def bucket(self, interval: Column, value: Column) -> Column:
        """Number of the bucket, given the interval."""
        if self.parts == 1:
            return interval
        edges = F.expr("array(" + ", ".join(f"double('{e!r}')" for e in self.edges) + ")")
        low = F.try_element_at(edges, interval + 1)
        width = F.try_element_at(edges, interval + 2) - low
        place = F.when(
            (width > 0) & (width < math.inf), F.floor((value - low) / width * self.parts).cast("int")
        )
        return interval * self.parts + F.least(F.coalesce(place, F.lit(0)), F.lit(self.parts - 1))

    def cuts(self) -> np.ndarray:
        """The finite edges and those of the even parts between them, ascending, for use in tasks."""
        inner = np.array(self.edges[1:-1])
        places = np.arange(self.parts) / self.parts
        between = (inner[:-1, None] + (inner[1:] - inner[:-1])[:, None] * places).ravel()
        return np.sort(np.append(between, inner[-1:]))

    def spread(self, bucket: Column, tie: Column) -> Column:
        """Order-respecting sub-bucket by row hash for rows that share one value, empty for others."""
        by_digits: dict[int, list[int]] = {MISSING_DIGITS: [self.missing * self.parts]}
        for interval, digits in self.single.items():
            by_digits.setdefault(digits, []).append(interval * self.parts)
        spread = [F.when(bucket.isin(*numbers), hash_prefix(tie, digits)) for digits, numbers in by_digits.items()]
        return F.coalesce(*spread, F.lit(""))


def fit_buckets(df: DataFrame, columns: Sequence[str], buckets: int = BUCKETS, *, share: float = 1.0) -> dict[str, Buckets]:
    """Bucket edges of double columns from mergeable quantile sketches, in one job.

    The edges only steer how evenly later work is spread. At most ``buckets`` numbers per column
    reach the driver; being literals from then on, retried tasks see the same edges. ``share`` is that of
    the rows to be bucketed that ``df`` holds.
    """
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns
    ]))).where(F.col("value").isNotNull())
    sketches = (
        long.groupBy("column", (F.spark_partition_id() % SKETCH_FAN).alias("part"))
        .agg(F.kll_sketch_agg_double("value", F.lit(SKETCH_SIZE)).alias("sketch"))
        .groupBy("column")
        .agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    )
    ranks = F.expr("array(" + ", ".join(f"{i / buckets!r}D" for i in range(buckets + 1)) + ")")
    rows = sketches.select(
        "column",
        F.kll_sketch_get_quantile_double("sketch", ranks).alias("q"),
        F.kll_sketch_get_n_double("sketch").alias("n"),
    ).collect()
    found = {row["column"]: (row["q"], math.ceil(row["n"] / share)) for row in rows}
    return {c: _buckets(*found.get(c, ((), 0))) for c in columns}


def _buckets(quantiles: Sequence[float], n: int) -> Buckets:
    """Buckets from equally spaced, ascending quantiles of ``n`` values.

    A value met more than once in a row is frequent and gets an interval of its own.
    """
    step = 1
    while (len(quantiles) - 1) // step > max(MIN_BUCKETS, n / SMALL_BUCKET_ROWS):
        step *= 2
    thinned = quantiles[::step]
    parts = 1
    while parts < MOST_PARTS and parts * len(thinned) * BUCKET_ROWS < n:
        parts *= 2
    met = Counter(q for q in thinned if math.isfinite(q))
    frequent = {v: times for v, times in met.items() if times > 1 and abs(v) < EXACT_DOUBLE}
    cuts = set(met) | {math.nextafter(v, math.inf) for v in frequent}
    edges = (-math.inf, *sorted(cuts or {0.0}), math.inf)
    # A value met k times holds less than k + 1 of the equal shares.
    share = n / max(1, len(thinned) - 1)
    single = {
        i: prefix_digits(math.ceil((frequent[e] + 1) * share), BUCKET_ROWS) for i, e in enumerate(edges) if e in frequent
    }
    return Buckets(edges, single, parts)


def add_buckets(df: DataFrame, buckets: dict[str, Buckets], outputs: dict[str, str]) -> DataFrame:
    """Add an integer bucket column (named by ``outputs``) for each bucketed double column."""
    names = list(buckets)
    binned = Bucketizer(
        inputCols=names,
        outputCols=[outputs[c] for c in names],
        splitsArray=[list(buckets[c].edges) for c in names],
        handleInvalid="keep",
    ).transform(df)
    interval = {c: F.coalesce(F.col(outputs[c]).cast("int"), F.lit(buckets[c].missing)) for c in names}
    return binned.withColumns({outputs[c]: buckets[c].bucket(interval[c], F.col(c)) for c in names})


def running_totals(
    rows: DataFrame, by: Sequence[str], bucket: str, order: Sequence[Column], sums: Sequence[str]
) -> DataFrame:
    """Add ``<sum>_before``: the total of all earlier rows of the group in (bucket, order) order.

    Each bucket starts with a carried row that brings in the total of the buckets before it, so
    rows are shuffled once, by group and bucket. ``order`` must be unique within a bucket.
    """
    totals = rows.groupBy(*by, bucket).agg(*[F.sum(s).alias(s) for s in sums])
    earlier = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *by, bucket, F.lit(0).alias("_row"), *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(s) for s in sums]
    )
    inside = (
        Window.partitionBy(*by, bucket).orderBy("_row", *order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("_row", F.lit(1))
        .unionByName(carried, allowMissingColumns=True)
        .withColumns({f"{s}_before": F.sum(s).over(inside) for s in sums})
        .where(F.col("_row") == 1)
        .drop("_row")
    )


def at_positions(
    rows: DataFrame,
    by: Sequence[str],
    bucket: str,
    order: Sequence[str],
    positions: dict[str, Callable[[Column], Column]],
    limits: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The rows standing at given 1-based positions of each group, in (bucket, order) order.

    ``positions`` maps a label to a function of the group's row count (column ``n``, or any column
    of the per-group table ``limits``). Result: ``by``, ``label``,
    ``n`` and the ``order`` columns; positions outside 1..n give no row.

    Buckets are counted first, unless ``counts`` has their ``_rows``; then only rows in a bucket with a wanted position are sorted.
    """
    counts = counts if counts is not None else rows.groupBy(*by, bucket).agg(F.count("*").alias("_rows"))
    group = Window.partitionBy(*by)
    placed = counts.select(
        *by,
        bucket,
        "_rows",
        F.sum("_rows").over(group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)).alias("_end"),
        F.sum("_rows").over(group).alias("n"),
    )
    wanted = placed if limits is None else join_groups(placed, limits, by)
    targets = (
        wanted.withColumn("_target", F.explode(F.array(*[
            F.struct(F.lit(label).alias("label"), make(F.col("n")).cast("long").alias("position"))
            for label, make in positions.items()
        ])))
        .where(F.col("_target.position").between(F.col("_end") - F.col("_rows") + 1, F.col("_end")))
        .groupBy(*by, bucket, "n", (F.col("_end") - F.col("_rows")).alias("_start"))
        .agg(F.collect_list("_target").alias("_targets"))
    )
    targets = lookup(targets)
    keys = [*by, bucket]
    candidates = (
        join_groups(rows, targets.select(*keys), keys, "left_semi")
        .groupBy(*keys, *order)
        .agg(F.count("*").alias("_rows"))
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = candidates.withColumn("_inside", F.sum("_rows").over(inside))
    return (
        join_groups(ranked, targets, keys)
        .withColumn("_end", F.col("_start") + F.col("_inside"))
        .withColumn("_target", F.explode("_targets"))
        .where(F.col("_target.position").between(F.col("_end") - F.col("_rows") + 1, F.col("_end")))
        .select(*by, F.col("_target.label").alias("label"), "n", *order)
    )


def order_by_value(df: DataFrame, name: str, tie: Column, keep_columns: Sequence[str] = ()) -> DataFrame:
    """Prepare rows for ranking by a column and, among equals, by a row hash; null and NaN come last.

    Adds ``_bucket`` and the columns to order by within it: ``_missing``, ``_at``, ``_tie``. A bucket
    that holds one frequent value, or the missing ones, is spread out by row hash, so that a value
    shared by many rows is not ranked in one task.
    """
    rows = df.select(
        *keep_columns,
        (~present(df, name)).alias("_missing"),
        F.col(name).alias("_at"),
        ordinal(df, name).alias("_ordinal"),
        tie.alias("_tie"),
    )
    fitted = fit_buckets(rows, ["_ordinal"])["_ordinal"]
    return add_buckets(rows, {"_ordinal": fitted}, {"_ordinal": "_part"}).select(
        *keep_columns,
        *VALUE_ORDER,
        F.struct(
            F.col("_part").alias("part"), fitted.spread(F.col("_part"), F.col("_tie")).alias("spread")
        ).alias("_bucket"),
    )


def up_to(df: DataFrame, name: str, tie: Column, cut: Column) -> Column:
    """Whether a row stands at or before a cut, a struct of the VALUE_ORDER columns.

    The hash is only computed for rows level with the cut.
    """
    missing, at = ~present(df, name), F.col(name)
    level = F.when(cut["_missing"], missing).otherwise(~missing & (at == cut["_at"]))
    before = ~missing & (cut["_missing"] | (at < cut["_at"]))
    return before | (level & (tie <= cut["_tie"]))
