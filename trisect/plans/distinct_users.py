"""Distinct entities per month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisect.functions.keys import literal


def monthly_distinct(
    df: DataFrame, time: str, key: Sequence[str], start=None, end: Column | str | None = None
) -> DataFrame:
    """Number of distinct composite keys per month, in month order: ``month``, ``distinct_entities``.

    A key with null parts counts as a key. With ``start`` only rows from then to ``end`` (today
    by default) are read; the range is on the raw column, so it reaches the file scan.
    """
    if start is not None:
        kind = df.schema[time].dataType
        last = F.current_date() if end is None else end
        last = last.cast(kind) if isinstance(last, Column) else literal(last, kind)
        df = df.where(F.col(time).between(literal(start, kind), last))
    month = F.date_trunc("month", time).cast(df.schema[time].dataType).alias("month")
    return (
        df.groupBy(month)
        .agg(F.count_distinct(F.struct(*key)).alias("distinct_entities"))
        .orderBy("month")
    )
