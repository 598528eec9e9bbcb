"""What a model's scores depend on: permutation importance and partial dependence, for any function that adds scores to rows.

For permutation importance a feature's values are exchanged among the rows, and the area under the ROC curve is measured
again. Rows are ranked by the hash of their key within hash buckets, and each takes the value of the row some ranks further on, round its bucket;
feature, repeat and bucket decide how many. So the exchange is one shuffle by bucket for all features and repeats, every value is used once per
feature and repeat, and any partitioning gives the same result. Missing values are exchanged like others.

The scored table has a copy of the rows for every feature and repeat, and one unchanged; copies are made after the shuffle, scored in one pass, and
only packed scores are shuffled again. Rows with equal keys are neighbours in an order their values decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisect.functions.keys import hash_prefix, join_groups, prefix_digits, row_hash
from trisect.functions.stats import ratio
from trisect.operators.metrics import roc_auc_by
from trisect.operators.quantiles import quantiles
from trisect.operators.ranking import fit_buckets
from trisect.session import lookup

# Feature of the rows whose values are not exchanged.
UNCHANGED = "(none)"
# Text features with more values than this are refused in partial dependence.
MOST_VALUES = 1000
# About so many rows are scored to find how scores are spread.
EDGE_ROWS = 100_000

Predict = Callable[[DataFrame], DataFrame]


def _turner(columns: Sequence[str], repeats: int, seed: int):
    """A function from a bucket's rows, in order, to the same rows with a column for each feature and repeat: its values turned round the bucket."""
    turns = [(c, r) for c in columns for r in range(repeats)]

    def run(key, table):
        (bucket,), n = key, table.num_rows
        table = table.drop_columns(["_bucket"]).combine_chunks()
        for i, (c, r) in enumerate(turns):
            digest = hashlib.md5(f"{c}|{r}|{bucket.as_py()}|{seed}".encode()).hexdigest()
            shift = 1 + int(digest[:8], 16) % (n - 1) if n > 1 else 0
            values = table.column(c)
            table = table.append_column(f"_new_{i}", pa.chunked_array([*values.slice(shift).chunks, *values.slice(0, shift).chunks], values.type))
        return table

    return run


def exchanged(
    df: DataFrame, key: Sequence[str], columns: Sequence[str], repeats: int = 1, seed: int = 0, n: int | None = None
) -> DataFrame:
    """The rows once unchanged, and once per feature and repeat with that feature's values exchanged: adds ``_feature, _repeat``.

    ``n`` is the number of rows, if the caller knows it.
    """
    digits = prefix_digits(df.count() if n is None else n, 1_000_000)
    tie = row_hash(key, seed)
    # The rows are shuffled without their hash, which takes more room than most keys; it is made again to order them.
    ranked = df.withColumn("_bucket", hash_prefix(tie, digits)).repartition("_bucket").withColumn("_tie", F.unhex(tie))
    ranked = ranked.sortWithinPartitions("_bucket", "_tie", *columns).drop("_tie")
    turns = [(c, r) for c in columns for r in range(repeats)]
    fields = [*df.schema, *[T.StructField(f"_new_{i}", df.schema[c].dataType) for i, (c, _) in enumerate(turns)]]
    wide = ranked.groupBy("_bucket").applyInArrow(_turner(columns, repeats, seed), T.StructType(fields))
    copies = F.array(*[
        F.struct(F.lit(i).alias("_turn"), F.lit(c).alias("_feature"), F.lit(r).alias("_repeat"))
        for i, (c, r) in enumerate([*turns, (UNCHANGED, 0)])
    ])
    return wide.select("*", F.inline(copies)).select(*[_turned(c, turns) for c in df.columns], "_feature", "_repeat")


def _turned(column: str, turns: Sequence[tuple[str, int]]) -> Column:
    """The values that a column has in each copy of the rows."""
    value = None
    for i, (c, _) in enumerate(turns):
        if c == column:
            value = (F if value is None else value).when(F.col("_turn") == i, F.col(f"_new_{i}"))
    return F.col(column) if value is None else value.otherwise(F.col(column)).alias(column)


def permutation_importance(
    df: DataFrame, key: Sequence[str], columns: Sequence[str], label: str, predict: Predict, scores: dict[object, Column],
    repeats: int = 3, seed: int = 0,
) -> DataFrame:
    """One row per feature: ``feature, auc, auc_exchanged, importance, std, repeats``, averaged over the repeats.

    ``predict`` adds columns to rows and keeps the others; ``scores`` maps each class to its score among them. With two classes the area is
    that of the second, else the areas of all classes against the rest are averaged with their frequencies. ``importance`` is the area lost.
    All columns of ``df`` are shuffled, so leave out what neither the key nor ``predict`` needs.
    """
    columns = list(dict.fromkeys(columns))
    if not columns or repeats < 1:
        raise ValueError("name the features, and repeat once or more")
    classes = list(scores)[1:] if len(scores) == 2 else list(scores)
    groups = [(UNCHANGED, 0), *[(c, r) for c in columns for r in range(repeats)]]
    n = df.count()

    def scored(rows: DataFrame, n: int | None) -> DataFrame:
        """Scores of every copy of the rows, in a numbered part for each copy and class."""
        place = F.create_map(*[x for i, (c, r) in enumerate(groups) for x in (F.lit(f"{c}|{r}"), F.lit(i * len(classes)))])
        first = F.element_at(place, F.concat_ws("|", "_feature", F.col("_repeat").cast("string")))
        return predict(exchanged(rows, key, columns, repeats, seed, n)).select(F.inline(F.array(*[
            F.struct(
                (first + i).alias("part"), scores[c].cast("double").alias("score"),
                F.coalesce(F.col(label) == F.lit(c), F.lit(False)).alias("positive"),
            )
            for i, c in enumerate(classes)
        ])))

    # Where the scores of some rows lie is enough to spread the work evenly.
    share = min(1.0, EDGE_ROWS / max(n, 1))
    some = df if share == 1.0 else df.sample(share, seed=0)
    buckets = fit_buckets(scored(some, None if share < 1.0 else n), ["score"], share=share)["score"]
    areas = roc_auc_by(scored(df, n), buckets)
    named = F.array(*[F.struct(F.lit(c).alias("_feature"), F.lit(r).alias("_repeat")) for c, r in groups])
    group = F.element_at(named, (F.floor(F.col("part") / len(classes)) + 1).cast("int")).alias("group")
    weight = F.when(F.col("auc").isNotNull(), F.col("n_pos"))
    table = lookup(areas.select("*", group).groupBy("group._feature", "group._repeat").agg(
        ratio(F.sum(F.col("auc") * weight), F.sum(weight)).alias("area")
    ))
    unchanged = table.where(F.col("_feature") == UNCHANGED).select(F.col("area").alias("auc"))
    rows = join_groups(table.where(F.col("_feature") != UNCHANGED), unchanged, [])
    return rows.groupBy(F.col("_feature").alias("feature")).agg(
        F.max("auc").alias("auc"), F.avg("area").alias("auc_exchanged"), F.avg(F.col("auc") - F.col("area")).alias("importance"),
        F.coalesce(F.stddev_samp("area"), F.lit(0.0)).alias("std"), F.count(F.lit(1)).alias("repeats"),
    )


def _values(df: DataFrame, columns: Sequence[str], points: int) -> dict[str, list]:
    """The values at which features are held: quantiles of numbers, all values of text."""
    text = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [c for c in columns if c not in text]
    found: dict[str, list] = {c: [] for c in columns}
    if numbers:
        cuts = quantiles(df, numbers, [i / (points - 1) for i in range(points)])
        for row in cuts.groupBy("column").agg(F.sort_array(F.collect_set("quantile")).alias("q")).collect():
            found[row["column"]] = row["q"]
    for c in text:
        values = [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().limit(MOST_VALUES + 1).collect()]
        if len(values) > MOST_VALUES:
            raise ValueError(f"column {c!r} has more than {MOST_VALUES} values")
        found[c] = sorted(values)
    return found


def partial_dependence(
    df: DataFrame, columns: Sequence[str], predict: Predict, score: Column, points: int = 10
) -> DataFrame:
    """Mean score of all rows with a feature held at a value: ``feature, value, mean_score, n``.

    Numbers are held at ``points`` exact quantiles, equal ones once, text at each of its values; ``value`` is text. A feature without
    values has no row.
    """
    if points < 2:
        raise ValueError("points must be 2 or more")
    columns = list(dict.fromkeys(columns))
    grid = [(c, str(v), v) for c, values in _values(df, columns, points).items() for v in values]
    if not grid:
        return df.sparkSession.createDataFrame([], "feature string, value string, mean_score double, n long")
    held = {c: F.create_map(*[x for f, shown, v in grid if f == c for x in (F.lit(shown), F.lit(v))]) for c in columns if any(f == c for f, *_ in grid)}
    turns = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(shown).alias("value")) for f, shown, _ in grid])
    copies = df.select("*", F.inline(turns).alias("_feature", "_value"))
    copies = copies.withColumns({
        c: F.when(F.col("_feature") == c, F.element_at(values, F.col("_value")).cast(df.schema[c].dataType)).otherwise(F.col(c))
        for c, values in held.items()
    })
    return predict(copies).groupBy(F.col("_feature").alias("feature"), F.col("_value").alias("value")).agg(
        F.avg(score.cast("double")).alias("mean_score"), F.count(score).alias("n")
    )
