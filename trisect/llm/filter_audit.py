"""What filters remove together and alone, in every order: an audit by a Gray-code walk over all subsets of filters.

A document fails a filter or not, whatever the others do, so the pattern of failures, one bit per filter, says all. Documents
are counted by part and pattern. In a Gray-code walk over the subsets one filter is switched on or off at a time; every
pattern keeps a counter of its failures that are switched on, and documents leave the running survivors when their counter
leaves zero and come back when it returns to it. The survivors of each subset are kept, and the steps of all
orders are differences of two of them.

The filters on a text's words (maximal runs without ASCII white space) and characters are ``FILTERS``; the last one, identical to the text
of a smaller id, needs the whole table. Texts are compared by SHA-256. Copies of a text are counted before they meet, so a
group of any size is a few rows; nothing but 2 ** filters numbers per part reaches a worker at once.

A null text counts as empty, a null part as ''. Equal empty texts are copies like others. A null id neither has a
smaller one nor is one; repeated rows of the smallest id all pass. Labels that occur several times for an id count once, as 1 if
any row says so; null labels are 0. An empty table gives no rows. Columns other than id, text, part and labels are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trisect.llm.tables import text_or_empty

SPACES = r"[\x20\x09-\x0D]+"
# Letter and condition of failure, in the order of their bits.
FILTERS: tuple[tuple[str, str], ...] = (
    ("A", "size(words) < 200"),
    ("B", "100 * size(array_distinct(words)) < 50 * size(words)"),
    ("C", "100 * length(regexp_replace(text, '[^A-Z]+', '')) > 3 * length(text)"),
    ("D", "text RLIKE '[#$%&*|]'"),
)
COPY = "E"
LETTERS = "".join(letter for letter, _ in FILTERS) + COPY
MEASURES = ("kept", "good", "toxic")


def patterns(documents: DataFrame, part: str = "lang", id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, part, digest, mask, n): rows that agree in all of these, with the bits of failed filters but for copies."""
    rows = documents.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        text_or_empty(text).alias("text"),
    ).withColumn("words", F.filter(F.split("text", SPACES), lambda w: w != ""))
    mask = F.lit(0)
    for bit, (_, fails) in enumerate(FILTERS):
        mask = mask + F.when(F.expr(fails), 1 << bit).otherwise(0)
    rows = rows.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), mask.alias("mask"))
    return rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))


def _flag(name: str) -> Column:
    return F.max(F.when(F.col(name) == 1, 1).otherwise(0))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with ``good`` and ``toxic``, 0 or 1. Null ids have no label and are spread by their digest."""
    flags = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        _flag("quality").alias("good"), _flag("toxic").alias("toxic")
    ).withColumn("spread", F.lit(0).cast("long"))
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0).cast("long")
    joined = rows.withColumn("spread", spread).join(flags, ["doc_id", "spread"], "left")
    return joined.drop("spread").fillna(0, ["good", "toxic"])


def cells(rows: DataFrame) -> DataFrame:
    """(part, mask, kept, good, toxic): documents per part and complete pattern, and how many of them bear each label."""
    key = ["digest", "part", "mask", "good", "toxic"]
    known = F.col("doc_id").isNotNull()
    groups = rows.groupBy(*key).agg(
        F.sum("n").alias("n"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("n_known"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
    )
    smallest = F.min("first.doc_id").over(W.partitionBy("digest"))
    groups = groups.withColumn(
        "copies", F.col("n_known") - F.when(F.col("first.doc_id") == smallest, F.col("first.n")).otherwise(0)
    )
    both = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct((F.col("mask") + (1 << len(FILTERS))).alias("mask"), F.col("copies").alias("n")),
    ))
    split = groups.select("part", "good", "toxic", both.alias("cell")).select("part", "good", "toxic", "cell.*")
    return split.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("kept"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )


def gray_walk(counts: np.ndarray, filters: int) -> np.ndarray:
    """Survivors of every subset of filters, by the subset's bits; ``counts`` has one row per pattern of failures."""
    masks = np.arange(1 << filters)
    active = np.zeros(len(counts), np.int64)
    running = counts.sum(axis=0)
    states = np.empty_like(counts)
    states[0] = running
    subset = 0
    for step in range(1, 1 << filters):
        toggled = step & -step
        failing = (masks & toggled) != 0
        subset ^= toggled
        if subset & toggled:
            running = running - counts[failing & (active == 0)].sum(axis=0)
            active[failing] += 1
        else:
            active[failing] -= 1
            running = running + counts[failing & (active == 0)].sum(axis=0)
        states[subset] = running
    return states


def survivors(counted: DataFrame, filters: int = len(LETTERS)) -> DataFrame:
    """(part, kept, good, toxic): per part an array of each measure, by the bits of the subset of filters that is on."""
    schema = "part string, " + ", ".join(f"{m} array<long>" for m in MEASURES)
    lists = counted.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))

    def run(batches):
        for batch in batches:
            found = []
            for part in batch.column("cells").to_pylist():
                counts = np.zeros((1 << filters, len(MEASURES)), np.int64)
                for cell in part:
                    counts[cell["mask"]] = [cell[m] for m in MEASURES]
                found.append(gray_walk(counts, filters))
            columns = [pa.array([states[:, i] for states in found], pa.list_(pa.int64())) for i in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([batch.column("part"), *columns], names=["part", *MEASURES])

    return lists.mapInArrow(run, schema)


def steps(states: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step in it; every number is a difference of survivors."""
    filters, every = len(letters), (1 << len(letters)) - 1
    orders = list(permutations(range(filters)))
    names = ["".join(letters[f] for f in order) for order in orders for _ in order]
    number = np.tile(np.arange(1, filters + 1), len(orders)).astype(np.int32)
    which = np.array(orders).reshape(-1)
    bits = 1 << which
    after = np.cumsum(bits.reshape(-1, filters), axis=1).reshape(-1)
    before = after - bits
    measures = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    schema = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in measures)

    def run(batches):
        for batch in batches:
            for part, *lists in zip(*(batch.column(c).to_pylist() for c in ("part", *MEASURES)), strict=True):
                kept, good, toxic = map(np.array, lists)
                removed = kept[before] - kept[after]
                sums = np.zeros(filters, np.int64)
                np.add.at(sums, which, removed)
                columns = [
                    kept[after], removed, kept[0] - kept[bits] - removed, kept[every - bits] - kept[every],
                    good[before] - good[after], toxic[before] - toxic[after], sums[which],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(names)), pa.array(names), pa.array(number), *map(pa.array, columns)],
                    names=["part", "filter_order", "step", *measures],
                )

    return states.mapInArrow(run, schema)


def audit(
    documents: DataFrame, labels: DataFrame, part: str = "lang", id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All orders of the filters, step by step, for every part of the documents."""
    return steps(survivors(cells(with_labels(patterns(documents, part, id_column, text), labels))))


ORACLE = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), l AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), w AS (
    SELECT d.*, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           min(d.doc_id) OVER (PARTITION BY t) AS smallest
    FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), m AS (
    SELECT part, good, toxic, unnest([
        {'f': 'A', 'fails': len(words) < 200},
        {'f': 'B', 'fails': 100 * len(list_distinct(words)) < 50 * len(words)},
        {'f': 'C', 'fails': 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t)},
        {'f': 'D', 'fails': regexp_matches(t, '[#$%&*|]')},
        {'f': 'E', 'fails': coalesce(smallest < doc_id, false)}
    ]) AS x, row_number() OVER () AS r FROM w
), failing AS (
    SELECT r, part, any_value(good) AS good, any_value(toxic) AS toxic,
           coalesce(string_agg(CASE WHEN x.fails THEN x.f END, '' ORDER BY x.f), '') AS failed
    FROM m GROUP BY r, part
), cells AS (
    SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, failed
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), s AS (
    SELECT filter_order, i::INT AS step, substr(filter_order, i, 1) AS f, substr(filter_order, 1, i - 1) AS earlier
    FROM orders, (SELECT unnest(range(1, 6)) AS i)
), counted AS (
    SELECT part, filter_order, step, f,
           sum(CASE WHEN hit OR was THEN 0 ELSE n END)::BIGINT AS kept,
           sum(CASE WHEN hit AND NOT was THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN hit AND was THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN failed = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN hit AND NOT was THEN good ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN hit AND NOT was THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM (
        SELECT *, contains(failed, f) AS hit, length(translate(failed, earlier, '')) < length(failed) AS was FROM cells, s
    ) GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
