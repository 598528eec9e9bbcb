"""Column expressions for row identity, ordering and missing values."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED = 42


def row_hash(key: Sequence[str], seed: int = SEED) -> Column:
    """A repeatable shuffle order: md5 of the row key and the seed, independent of partitioning.

    Every part is written with its length, and a null as ``n``, so that different keys are different texts.
    """
    texts = [F.col(c).cast("string") for c in key]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("n")) for t in texts]
    return F.md5(F.concat(*parts, F.lit(f"seed:{seed}")))


def hash_prefix(row_hash: Column, digits: int = 4) -> Column:
    """Leading hex digits of a row hash, as a bucket that respects the order of the hashes."""
    return F.substring(row_hash, 1, digits)


def hash_number(row_hash: Column) -> Column:
    """The leading 32 bits of a row hash as a number."""
    return F.conv(F.substring(row_hash, 1, 8), 16, 10).cast("long")


def prefix_digits(n: int, rows_per_bucket: int = 1_000_000) -> int:
    """Hex digits of a hash that cut ``n`` rows into buckets of at most ``rows_per_bucket``.

    Up to three digits more buckets than that are used, as counting them costs next to nothing
    and the fewer rows are then sorted.
    """
    digits = 1
    while digits < 7 and n / 16**digits > (rows_per_bucket if digits >= 3 else rows_per_bucket / 500):
        digits += 1
    return digits


def ordinal(df: DataFrame, name: str) -> Column:
    """An order-preserving double for a numeric, boolean or temporal column; NaN becomes null.

    Equal values stay equal and a larger value never gets a smaller double. Timestamps without
    zone are counted in local seconds, so the session time zone plays no part.
    """
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        since = col - F.lit("1970-01-01").cast(kind)
        return since.cast("interval second").cast("decimal(18,6)").cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col.cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    raise ValueError(f"column {name!r} of type {kind.simpleString()} has no numeric order")


def bound(value: float, kind: T.DataType, up: bool) -> Column | None:
    """A number as literal of a numeric type, rounded up or down to it; None for other types."""
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.lit(math.ceil(value) if up else math.floor(value)).cast(kind)
    return F.lit(value) if isinstance(kind, T.DoubleType) else None


def present(df: DataFrame, name: str) -> Column:
    """True where the column is neither null nor NaN."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.col(name).isNotNull() & ~F.isnan(name)
    return F.col(name).isNotNull()


def literal(value, kind: T.DataType) -> Column:
    """A typed literal of a Python value, structs included.

    A datetime for a column without zone is taken as written, whatever the session time zone.
    """
    if value is not None and isinstance(kind, T.StructType):
        return F.struct(*[literal(value[f.name], f.dataType).alias(f.name) for f in kind])
    if isinstance(value, dt.datetime) and isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(" ")).cast(kind)
    return F.lit(value).cast(kind)


def join_groups(rows: DataFrame, table: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a per-group table to rows on null-safe equality of the group columns.

    Without group columns the table has one row, which is attached as literals.
    """
    if not by:
        row = table.first()
        return rows.withColumns({
            f.name: literal(row[f.name] if row else None, f.dataType) for f in table.schema
        })
    names = {c: f"_of_{c}" for c in by}
    condition = None
    for name, other in names.items():
        # Plain equality, the cheaper join key, does the same where one side has no nulls.
        nulls = rows.schema[name].nullable and table.schema[name].nullable
        equal = F.col(name).eqNullSafe(F.col(other)) if nulls else F.col(name) == F.col(other)
        condition = equal if condition is None else condition & equal
    joined = rows.join(table.withColumnsRenamed(names), condition, how)
    return joined if how == "left_semi" else joined.drop(*names.values())
