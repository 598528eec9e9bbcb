"""Rules that one row cannot tell: references between tables, functional dependencies, numbers of children, totals.

Every rule counts its keys first, so a key with a third of all rows is one row from there on, and only keys travel to the other table. All
rules give the same columns: ``rule, subject, checked, violations, offenders, passed, sample``. ``checked`` and ``violations`` count
rows (parents for the last two rules), ``offenders`` distinct keys; ``sample`` holds the keys with most violations as text with their count.

A key with a null part refers to nothing and is not checked. Empty tables pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisect.session import lookup

SAMPLES = 5
KEYS = "_key_{0}".format


def _whole(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _named(df: DataFrame, key: Sequence[str], *more: Column) -> DataFrame:
    """Rows whose key is whole, its columns under neutral names."""
    return df.where(_whole(key)).select(*[F.col(c).alias(KEYS(i)) for i, c in enumerate(key)], *more)


def _result(rule: str, subject: str, checked: DataFrame, offenders: DataFrame, width: int, samples: int) -> DataFrame:
    """The rule's row, from a table with one sum ``checked`` and one of offending keys with their violations ``n``."""
    text = F.concat_ws("|", *[F.col(KEYS(i)).cast("string") for i in range(width)])
    found = lookup(offenders.select(text.alias("key"), F.col("n").cast("long").alias("n")))
    sums = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"), F.count(F.lit(1)).alias("offenders"))
    top = found.orderBy(F.desc("n"), "key").limit(samples).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "key"))).alias("top")
    )
    one = lambda t: t.withColumn("_one", F.lit(1))  # three tables of one row each
    row = one(checked).join(one(sums), "_one").join(one(top), "_one")
    return row.select(
        F.lit(rule).alias("rule"), F.lit(subject).alias("subject"), F.coalesce("checked", F.lit(0)).cast("long").alias("checked"),
        "violations", "offenders", (F.col("violations") == 0).alias("passed"),
        F.transform("top", lambda t: F.struct(t["key"].alias("key"), (-t["n"]).alias("n"))).alias("sample"),
    )


def refers_to(
    subject: str, child: DataFrame, child_key: Sequence[str], parent: DataFrame, parent_key: Sequence[str], samples: int = SAMPLES
) -> DataFrame:
    """Every whole key of the child is a key of the parent."""
    names = [KEYS(i) for i in range(len(child_key))]
    counts = _named(child, child_key).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    missing = counts.join(_named(parent, parent_key), names, "left_anti")
    return _result("refers_to", subject, counts.agg(F.sum("n").alias("checked")), missing, len(names), samples)


def determines(
    subject: str, df: DataFrame, key: Sequence[str], dependent: Sequence[str], samples: int = SAMPLES
) -> DataFrame:
    """Rows with the same key have the same values of the dependent columns; null is a value.

    Violations of a key are its rows beyond those of its most frequent values.
    """
    names = [KEYS(i) for i in range(len(key))]
    values = [F.col(c).alias(f"_value_{i}") for i, c in enumerate(dependent)]
    pairs = _named(df, key, *values).groupBy(*names, *[f"_value_{i}" for i in range(len(dependent))]).agg(F.count(F.lit(1)).alias("n"))
    keys = pairs.groupBy(*names).agg(F.sum("n").alias("rows"), (F.sum("n") - F.max("n")).alias("n"))
    return _result("determines", subject, keys.agg(F.sum("rows").alias("checked")), keys.where("n > 0"), len(names), samples)


def _per_parent(child: DataFrame, child_key, parent: DataFrame, parent_key, of_child: Column, *of_parent: Column) -> DataFrame:
    """One row per distinct whole parent key, with the aggregate ``_of_child`` of its children, null if it has none."""
    names = [KEYS(i) for i in range(len(child_key))]
    children = _named(child, child_key, F.lit(1).alias("_one"), *[F.col(c) for c in child.columns if c not in child_key])
    sums = children.groupBy(*names).agg(of_child.alias("_of_child"))
    parents = _named(parent, parent_key, *of_parent).dropDuplicates(names)
    return parents.join(sums, names, "left")


def has_children(
    subject: str, parent: DataFrame, parent_key: Sequence[str], child: DataFrame, child_key: Sequence[str], least: int = 1,
    most: int | None = None, samples: int = SAMPLES,
) -> DataFrame:
    """Every parent has at least ``least`` and at most ``most`` children; violations are children too few or too many."""
    table = _per_parent(child, child_key, parent, parent_key, F.count(F.lit(1)))
    n = F.coalesce("_of_child", F.lit(0))
    over = F.lit(0) if most is None else F.greatest(n - most, F.lit(0))
    off = table.withColumn("n", F.greatest(F.lit(least) - n, F.lit(0)) + over)
    return _result("has_children", subject, off.agg(F.count(F.lit(1)).alias("checked")), off.where("n > 0"), len(parent_key), samples)


def adds_up(
    subject: str, parent: DataFrame, parent_key: Sequence[str], total: str, child: DataFrame, child_key: Sequence[str], amount: str,
    tolerance: float = 0.0, samples: int = SAMPLES,
) -> DataFrame:
    """A parent's total is the sum of its children's amounts, give or take the tolerance; a null total is a violation.

    Children without an amount add nothing, a parent without children has the sum 0.
    """
    table = _per_parent(child, child_key, parent, parent_key, F.sum(amount), F.col(total).alias("_total"))
    gap = F.abs(F.col("_total") - F.coalesce("_of_child", F.lit(0)))
    off = table.withColumn("n", F.when(F.coalesce(gap <= tolerance, F.lit(False)), 0).otherwise(1))
    return _result("adds_up", subject, off.agg(F.count(F.lit(1)).alias("checked")), off.where("n > 0"), len(parent_key), samples)


def report(*rules: DataFrame) -> DataFrame:
    """The rows of several rules."""
    return reduce(DataFrame.unionByName, rules)
