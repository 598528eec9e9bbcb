"""Three-way splits: stratified at random, chronological, by quantiles, and within groups.

A split is fitted, then assigned. Fitting looks only at the few columns that decide (group,
order, key) and ends in a small table of cut values; assigning is one narrow pass over the whole
table that compares each row with its cuts, so wide rows are never sorted or ranked.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisect.functions.keys import (
    SEED,
    bound,
    hash_number,
    hash_prefix,
    join_groups,
    literal,
    ordinal,
    prefix_digits,
    present,
    row_hash,
)
from trisect.operators.quantiles import long_quantiles
from trisect.operators.ranking import (
    VALUE_ORDER,
    add_buckets,
    at_positions,
    fit_buckets,
    order_by_value,
    running_totals,
    up_to,
)
from trisect.session import BROADCAST_ROWS, keep, lookup

# Fixed values
METHODS = ("random", "time", "metric")
SUBSETS = ("train", "test", "backtest")
SIZES = (0.6, 0.2, 0.2)

# Strata are ranked by remainder in this many buckets.
REMAINDER_BUCKETS = 1024


@dataclass(frozen=True)
class SplitSpec:
    """What to split by. Sizes are shares; for ``time``, train and test may be cut points instead.

    ``key`` names the columns that identify a row: they break ties and seed the random order. Rows
    that share a key stay together, so sizes are met exactly only if the key is unique.
    ``by`` splits every group of these columns on its own.
    """

    method: str = "random"
    target: str | None = None
    stratify: tuple[str, ...] = ()
    time: str | None = None
    metric: str | None = None
    train: float | str | dt.datetime = SIZES[0]
    test: float | str | dt.datetime = SIZES[1]
    backtest: float | str | dt.datetime = SIZES[2]
    key: tuple[str, ...] = ()
    by: tuple[str, ...] = ()
    seed: int = SEED

    def __post_init__(self) -> None:
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {', '.join(METHODS)}")
        needed = {"random": ("target", self.target), "time": ("time", self.time), "metric": ("metric", self.metric)}
        name, column = needed[self.method]
        if not column:
            raise ValueError(f"a {self.method} split needs a {name} column")
        if self.by_cut_points:
            self._check_cuts()
        else:
            self._check_shares()
            if self.method != "metric" and not self.key:
                raise ValueError(f"a {self.method} split by shares needs the key columns")

    def _check_cuts(self) -> None:
        cuts = [_as_time(cut) for cut in (self.train, self.test)]
        if (cuts[0].tzinfo is None) != (cuts[1].tzinfo is None):
            raise ValueError("cut points must both have a time zone or none")
        if cuts[0] > cuts[1]:
            raise ValueError("the test cut point must not lie before the train cut point")

    def _check_shares(self) -> None:
        shares = (self.train, self.test) if self.method == "time" else (self.train, self.test, self.backtest)
        if not all(_is_number(s) and s >= 0 for s in shares):
            raise ValueError("shares must be numbers from 0 to 1")
        total = sum(shares)
        if self.method == "time":
            if total > 1 and not math.isclose(total, 1.0):
                raise ValueError("train and test shares add up to more than 1")
        elif not math.isclose(total, 1.0, rel_tol=1e-5, abs_tol=1e-8):
            raise ValueError("train, test and backtest shares must add up to 1")

    @property
    def by_cut_points(self) -> bool:
        return self.method == "time" and not (_is_number(self.train) and _is_number(self.test))

    @property
    def strata(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([*self.by, *([self.target] if self.target else []), *self.stratify]))


def _is_number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _as_time(cut) -> dt.datetime:
    """A cut point as a datetime; text in ISO form only, so that no job is needed to refuse it."""
    if isinstance(cut, dt.datetime):
        return cut
    if isinstance(cut, dt.date):
        return dt.datetime(cut.year, cut.month, cut.day)
    if isinstance(cut, str):
        try:
            return dt.datetime.fromisoformat(cut.strip())
        except ValueError:
            raise ValueError(f"cut point {cut!r} is not a date or time") from None
    raise ValueError("train and test must both be shares or both be cut points")


@dataclass(frozen=True)
class Parts:
    """The three parts as separate DataFrames."""

    train: DataFrame
    test: DataFrame
    backtest: DataFrame


def parts(assigned: DataFrame) -> Parts:
    """Separate an assigned table; rows without a subset are in no part."""
    return Parts(*[assigned.where(F.col("subset") == s).drop("subset") for s in SUBSETS])


def split(df: DataFrame, spec: SplitSpec) -> DataFrame:
    """Add column ``subset``: train, test, backtest, or null where the split leaves a row out."""
    return fit_split(df, spec).assign(df)


@dataclass(frozen=True)
class FittedSplit:
    """A split whose cuts are known. It also assigns rows that were not there when it was fitted.

    ``cuts`` has columns ``first`` and ``second``, per group of ``by``; it is None for cut points.
    """

    spec: SplitSpec
    by: tuple[str, ...] = ()
    cuts: DataFrame | None = None

    def assign(self, df: DataFrame) -> DataFrame:
        """Add ``subset`` by comparing each row with the cuts of its group."""
        if self.cuts is None:
            kind = df.schema[self.spec.time].dataType
            first, second = (literal(cut, kind) for cut in (self.spec.train, self.spec.test))
            return df.withColumn("subset", _between_cuts(F.col(self.spec.time), first, second))
        table = self.cuts.withColumnsRenamed({"first": "_first", "second": "_second"})
        joined = join_groups(df, table, self.by, "left")
        return joined.withColumn("subset", self._rule(df)).select(*df.columns, "subset")

    def _rule(self, df: DataFrame) -> Column:
        first, second = F.col("_first"), F.col("_second")
        if self.spec.method == "metric":
            return _between_cuts(ordinal(df, self.spec.metric), first, second)
        tie = row_hash(self.spec.key, self.spec.seed)
        # A missing cut (a share of no rows) has nothing before it.
        if self.spec.method == "random":
            return F.when(tie <= first, "backtest").when(tie <= second, "test").otherwise("train")
        until = lambda cut: up_to(df, self.spec.time, tie, cut)
        return F.when(until(first), "train").when(until(second), "test").otherwise("backtest")

    def parts(self, df: DataFrame) -> Parts:
        """The three parts. Those cut by one column carry a plain range on it as well.

        The range repeats what the subset says, in a form that reaches the scan: a part of a table
        that is stored by time is read without the files of the other parts.
        """
        assigned = self.assign(df)
        ranges = self._ranges(df) or dict.fromkeys(SUBSETS, F.lit(True))
        return Parts(*[
            assigned.where(ranges[s] & (F.col("subset") == s)).drop("subset") for s in SUBSETS
        ])

    def _ranges(self, df: DataFrame) -> dict[str, Column] | None:
        name = self.spec.time if self.spec.method == "time" else self.spec.metric
        if self.spec.method == "random" or self.by:
            return None
        col, kind = F.col(name), df.schema[name].dataType
        if self.cuts is None:
            first, second = (literal(cut, kind) for cut in (self.spec.train, self.spec.test))
            return {"train": col <= first, "test": (col > first) & (col <= second), "backtest": col > second}
        row = self.cuts.first()
        if row is None or row["first"] is None or row["second"] is None:
            return None
        if self.spec.method == "metric":
            (low1, high1), (low2, high2) = [[bound(row[c], kind, up) for up in (True, False)] for c in ("first", "second")]
        else:
            low1, low2 = [None if row[c]["_missing"] else literal(row[c]["_at"], kind) for c in ("first", "second")]
            high1, high2 = low1, low2
        if low1 is None or low2 is None:
            return None
        return {
            "train": col <= high1,
            "test": (col >= low1) & (col <= high2),
            "backtest": (col >= low2) | ~present(df, name),
        }


def _between_cuts(value: Column, first: Column, second: Column) -> Column:
    return F.when(value <= first, "train").when(value <= second, "test").when(value > second, "backtest")


def fit_split(df: DataFrame, spec: SplitSpec) -> FittedSplit:
    """Find the cuts of a table. Only the columns that decide are read; rows stay where they are."""
    if not isinstance(df, DataFrame):
        raise ValueError("a split needs a Spark DataFrame")
    if spec.by_cut_points:
        return FittedSplit(spec)
    fit = {"random": _fit_random, "time": _fit_time, "metric": _fit_metric}[spec.method]
    by = spec.strata if spec.method == "random" else spec.by
    return FittedSplit(spec, by, lookup(fit(df, spec)))


def _first_and_second(found: DataFrame, by: Sequence[str], which: Column, names: Sequence, value: Column) -> DataFrame:
    """One row of cuts per group, from rows told apart by ``which``."""
    return found.groupBy(*by).agg(*[
        F.max(F.when(which == name, value)).alias(cut) for name, cut in zip(names, ("first", "second"))
    ])


def _fit_time(df: DataFrame, spec: SplitSpec) -> DataFrame:
    """Chronological cuts by shares; equal times are ordered by row hash, null times come last."""
    rows = order_by_value(df, spec.time, row_hash(spec.key, spec.seed), spec.by)
    positions = {
        "first": lambda n: F.floor(F.lit(float(spec.train)) * n),
        "second": lambda n: F.floor(F.lit(float(spec.train + spec.test)) * n),
    }
    found = at_positions(rows, spec.by, "_bucket", VALUE_ORDER, positions)
    return _first_and_second(found, spec.by, F.col("label"), list(positions), F.struct(*VALUE_ORDER))


def _fit_metric(df: DataFrame, spec: SplitSpec) -> DataFrame:
    """Two exact quantiles; a null metric belongs nowhere."""
    narrow = df.select(*spec.by, ordinal(df, spec.metric).alias("value"))
    rows = add_buckets(narrow, fit_buckets(narrow, ["value"]), {"value": "bucket"}).where("value IS NOT NULL")
    found = long_quantiles(rows, spec.by, [float(spec.train), min(1.0, float(spec.train + spec.test))])
    return _first_and_second(found, spec.by, F.col("i"), (0, 1), F.col("quantile"))


def _fit_random(df: DataFrame, spec: SplitSpec) -> DataFrame:
    """Stratified cuts: in the hash order of each stratum, first backtest, then test, then train."""
    rows = df.select(*spec.strata, row_hash(spec.key, spec.seed).alias("tie"))
    quotas = stratum_quotas(rows, spec)
    largest = quotas.agg(F.max("n")).first()[0] or 0
    rows = rows.withColumn("bucket", hash_prefix(F.col("tie"), prefix_digits(largest)))
    positions = {
        "first": lambda _: F.col("n_backtest"),
        "second": lambda _: F.col("n_backtest") + F.col("n_test"),
    }
    found = at_positions(rows, spec.strata, "bucket", ["tie"], positions, limits=quotas.drop("n"))
    return _first_and_second(found, spec.strata, F.col("label"), list(positions), F.col("tie"))


def stratum_quotas(rows: DataFrame, spec: SplitSpec, small: int | None = None) -> DataFrame:
    """Rows per stratum and part: strata columns, ``n``, ``n_backtest``, ``n_test``.

    Part sizes are rounded up for the whole table (or ``by`` group), then shared out among the
    strata in proportion to their size, spare rows going to the largest remainders. A short list
    of strata (up to ``small``) is ranked by a plain window, a long one in buckets.
    """
    sizes = lookup(rows.groupBy(*spec.strata).agg(F.count("*").alias("n")))
    few = sizes.count() <= (BROADCAST_ROWS if small is None else small)
    share_out = _share_out_few if few else _share_out_many
    first = share_out(sizes, spec, "n", "n_backtest", float(spec.backtest)).withColumn(
        "_rest", F.col("n") - F.col("n_backtest")
    )
    rest = spec.train + spec.test
    if not few:
        first = keep(first)
    second = share_out(first, spec, "_rest", "n_test", float(spec.test / rest) if rest else 0.0)
    return lookup(second.drop("_rest"))


def _exact_share(count: str) -> dict[str, Column]:
    """Whole part and remainder of ``count * _draws / _total``, in whole numbers."""
    whole = T.DecimalType(18, 0)
    product = F.col(count).cast(whole) * F.col("_draws").cast(whole)
    total = F.greatest(F.col("_total"), F.lit(1)).cast(whole)
    return {
        "_whole": ((product - product % total) / total).cast("long"),
        "_left": product % total,
        "_part": (product % total).cast("double") / total.cast("double"),
    }


def _line_order(spec: SplitSpec) -> list[Column]:
    """Strata in line for a spare row: largest remainder first, then by hash."""
    return [F.desc("_left"), row_hash(spec.strata, spec.seed), *map(F.col, spec.strata)]


def _share_out_few(strata: DataFrame, spec: SplitSpec, count: str, quota: str, share: float) -> DataFrame:
    """Add ``quota``: ceil(share * total) rows shared out in proportion to ``count``."""
    group = Window.partitionBy(*spec.by)
    shared = (
        strata.withColumn("_total", F.sum(count).over(group))
        .withColumn("_draws", F.ceil(F.lit(share) * F.col("_total")))
        .withColumns(_exact_share(count))
    )
    spare = F.row_number().over(group.orderBy(*_line_order(spec))) <= F.col("_draws") - F.sum("_whole").over(group)
    return shared.select(*strata.columns, (F.col("_whole") + spare.cast("long")).alias(quota))


def _share_out_many(strata: DataFrame, spec: SplitSpec, count: str, quota: str, share: float) -> DataFrame:
    """The same for a list of strata too long for one task: ranked in buckets of remainder."""
    totals = strata.groupBy(*spec.by).agg(F.sum(count).alias("_total"))
    totals = totals.withColumn("_draws", F.ceil(F.lit(share) * F.col("_total")))
    shared = join_groups(strata, totals, spec.by).withColumns(_exact_share(count)).withColumns({
        "_bucket": -F.floor(F.col("_part") * REMAINDER_BUCKETS), "_one": F.lit(1)
    })
    given = shared.groupBy(*spec.by).agg(F.sum("_whole").alias("_given"))
    ranked = running_totals(shared, spec.by, "_bucket", _line_order(spec), ["_one"])
    spare = F.col("_one_before") < F.col("_draws") - F.col("_given")
    return join_groups(ranked, given, spec.by).select(
        *strata.columns, (F.col("_whole") + spare.cast("long")).alias(quota)
    )


def random_split_by_hash(df: DataFrame, key: Sequence[str], spec_sizes=SIZES, seed: int = SEED) -> DataFrame:
    """Approximate random split without counting: each row is placed by its own hash.

    Sizes differ from the shares by sampling noise; no shuffle takes place.
    """
    train, test, _ = spec_sizes
    place = hash_number(row_hash(key, seed))
    first, second = (int(share * 16**8) for share in (train, train + test))
    return df.withColumn(
        "subset", F.when(place < first, "train").when(place < second, "test").otherwise("backtest")
    )


def add_blocks(df: DataFrame, order: str, key: Sequence[str], block_rows: int, name: str = "block") -> DataFrame:
    """Number consecutive blocks of ``block_rows`` rows in the order of a column, from 0.

    Every row needs its own rank here, so the table is shuffled once, by order bucket. The key must identify
    a row: it orders rows that are level in ``order``, and rows alike in both are numbered arbitrarily.
    """
    if not key:
        raise ValueError("blocks need the key columns")
    rows = order_by_value(df, order, row_hash(key), df.columns).withColumn("_one", F.lit(1))
    ranked = running_totals(rows, [], "_bucket", [F.col(c) for c in VALUE_ORDER], ["_one"])
    return ranked.select(*df.columns, F.floor(F.col("_one_before") / block_rows).cast("long").alias(name))


def split_in_blocks(df: DataFrame, spec: SplitSpec, order: str, block_rows: int) -> DataFrame:
    """Split every block of consecutive rows on its own; keeps the ``block`` column. Needs ``spec.key``."""
    blocks = add_blocks(df, order, spec.key, block_rows)
    return split(blocks, replace(spec, by=(*spec.by, "block")))
