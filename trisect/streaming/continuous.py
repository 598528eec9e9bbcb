"""Continuous drift monitoring: mergeable window counts kept per micro-batch, late rows corrected, alerts with hysteresis.

Every micro-batch is aggregated to counts per time window, column and bin, and only these are kept, in a folder named by the
batch's number. Counts add up, so the state of a window is their sum over all batches: a row that comes late, however late, is
added to its own window and corrects what was reported about it. A batch that is run again after a failure writes the same folder
again, so nothing counts twice. The folders may be merged (``CountLog.compact``); their size depends on windows and bins, not on rows.

A window is judged once the stream has moved ``lateness`` beyond its end and it holds ``least_rows`` values. The alert of a column
goes on when ``up`` judged windows in a row have a PSI of ``high`` or more, and off when ``down`` in a row are below ``low``;
in between it stays as it was. What a batch changes about alerts is written to a log, withdrawals included.

Rows without a time are in no window. Null and NaN values are counted apart as ``n_null``. Values outside the edges count in the total
but in no bin. An empty stream gives an empty report.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trisect.functions.keys import join_groups, ordinal, present
from trisect.operators.drift import Edges
from trisect.operators.quantiles import edge_bin
from trisect.plans.monitoring import PSI_ALERT
from trisect.session import lookup
from trisect.streaming.monitor import window_divergences


@dataclass(frozen=True)
class Watch:
    """What is watched, and when it raises an alert."""

    time: str
    window: str
    edges: Edges
    high: float = PSI_ALERT
    low: float = PSI_ALERT / 2
    up: int = 1
    down: int = 1
    least_rows: int = 1
    lateness: str = "0 seconds"

    def __post_init__(self):
        if self.low > self.high or min(self.up, self.down, self.least_rows) < 1:
            raise ValueError("low must not exceed high, and up, down and least_rows must be 1 or more")


KEY = ("window_start", "column", "bin", "missing")


def window_counts(rows: DataFrame, watch: Watch) -> DataFrame:
    """Rows per window, column and bin: ``window_start, column, bin, missing, n, last`` (the latest time seen)."""
    cells = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), edge_bin(ordinal(rows, c), e).alias("bin"), (~present(rows, c)).alias("missing"))
        for c, e in watch.edges.items()
    ]))
    values = rows.where(F.col(watch.time).isNotNull()).select(F.col(watch.time).alias("_time"), cells)
    start = F.window("_time", watch.window)["start"].alias("window_start")
    return values.groupBy(start, "column", "bin", "missing").agg(F.count(F.lit(1)).alias("n"), F.max("_time").alias("last"))


def reference_counts(rows: DataFrame, edges: Edges) -> DataFrame:
    """Bin counts of the reference rows: ``column, bin, n_ref``."""
    cells = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), edge_bin(ordinal(rows, c), e).alias("bin"), present(rows, c).alias("there"))
        for c, e in edges.items()
    ]))
    return lookup(rows.select(cells).where("there").groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n_ref")))


def merged(counts: DataFrame) -> DataFrame:
    """Counts of several batches as those of one."""
    return counts.groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("last").alias("last"))


def _in_a_row(condition: Column, times: int, order: W) -> Column:
    recent = order.rowsBetween(1 - times, 0)
    return (F.min(F.coalesce(condition, F.lit(False)).cast("int")).over(recent) == 1) & (F.count(F.lit(1)).over(recent) == times)


def report(counts: DataFrame, reference: DataFrame, watch: Watch) -> DataFrame:
    """One row per window and column: ``n``, ``n_null``, ``psi``, ``js_divergence``, ``alert`` (null while not judged)."""
    counts = lookup(merged(counts))
    sizes = counts.groupBy("window_start", "column").agg(
        F.sum(F.when(~F.col("missing"), F.col("n")).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("missing"), F.col("n")).otherwise(0)).alias("n_null"),
    )
    distances = window_divergences(
        counts.where("NOT missing").select("window_start", "column", "bin", F.col("n").alias("n_cur")), reference
    )
    key = ["window_start", "column"]
    table = join_groups(sizes, lookup(distances), key, "left")
    table = join_groups(table, counts.agg(F.max("last").alias("_mark")), [])
    end = F.expr(f"window_start + INTERVAL {watch.window}")
    judged = (end <= F.expr(f"_mark - INTERVAL {watch.lateness}")) & (F.col("n") >= watch.least_rows)
    table = lookup(table.withColumn("judged", judged).drop("_mark"))
    order = W.partitionBy("column").orderBy("window_start")
    on, off = _in_a_row(F.col("psi") >= watch.high, watch.up, order), _in_a_row(F.col("psi") < watch.low, watch.down, order)
    turned = table.where("judged").withColumn("_turn", F.when(on, True).when(off, False))
    held = F.last("_turn", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))
    alerts = turned.select(*key, F.coalesce(held, F.lit(False)).alias("alert"))
    return join_groups(table.drop("judged"), alerts, key, "left").select(
        *key, "n", "n_null", "psi", "js_divergence", "alert"
    )


class CountLog:
    """Tables written once per batch under a root folder. A folder counts when Spark's writer has finished it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _folders(self, kind: str) -> dict[int, str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        top = path(self.root)
        system = top.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not system.exists(top):
            return {}
        found = {}
        for status in system.listStatus(top):
            name = status.getPath().getName()
            if re.fullmatch(kind + r"=\d+", name) and system.exists(path(status.getPath(), "_SUCCESS")):
                found[int(name.split("=")[1])] = f"{self.root}/{name}"
        return found

    def write(self, table: DataFrame, batch: int) -> None:
        """Keep a batch's table, in place of what an earlier attempt at the batch has left."""
        table.write.mode("overwrite").parquet(f"{self.root}/batch={batch}")

    def paths(self, before: int | None = None) -> list[str]:
        """Folders that together hold every batch once: the last merged one, and the batches after it."""
        upto = {k: p for k, p in self._folders("upto").items() if before is None or k < before}
        first = max(upto, default=-1)
        late = {k: p for k, p in self._folders("batch").items() if k > first and (before is None or k < before)}
        return [p for _, p in sorted(upto.items())[-1:]] + [p for _, p in sorted(late.items())]

    def read(self, before: int | None = None) -> DataFrame | None:
        """The rows of all batches, or of those before one; None if there are none."""
        paths = self.paths(before)
        return self.spark.read.parquet(*paths) if paths else None

    def compact(self) -> None:
        """Merge all batches so far into one folder; the stream may go on meanwhile. Old folders are no longer read."""
        batches = self._folders("batch")
        if batches:
            last = max(batches)
            merged(self.read(last + 1)).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/upto={last}")


@dataclass(frozen=True)
class Monitor:
    """A stream's monitor: state, alert log and stream checkpoint below ``root``."""

    root: str
    watch: Watch
    reference: DataFrame

    def counts(self, spark: SparkSession) -> CountLog:
        return CountLog(spark, f"{self.root}/counts")

    def log(self, spark: SparkSession) -> CountLog:
        return CountLog(spark, f"{self.root}/alerts")

    def process(self, rows: DataFrame, batch: int) -> None:
        """Take in one micro-batch and log what it changes about alerts."""
        spark = rows.sparkSession
        state, log = self.counts(spark), self.log(spark)
        state.write(window_counts(rows, self.watch), batch)
        now = report(state.read(batch + 1), self.reference, self.watch).where("alert IS NOT NULL")
        earlier = log.read(batch)
        key = ["window_start", "column"]
        if earlier is None:
            changed = now.where("alert")
        else:
            known = earlier.groupBy(*key).agg(F.max_by("alert", "batch").alias("known"))
            changed = join_groups(now, lookup(known), key, "left").where("alert <> coalesce(known, false)")
        log.write(changed.select(F.lit(batch).cast("long").alias("batch"), *key, "alert", "psi"), batch)

    def start(self, stream: DataFrame, **trigger) -> StreamingQuery:
        """Run over a stream; by default over all that is there now. Goes on where an earlier run stopped."""
        return (
            stream.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def report(self, spark: SparkSession) -> DataFrame | None:
        """The report on all windows so far; None before the first batch."""
        counts = self.counts(spark).read()
        return None if counts is None else report(counts, self.reference, self.watch)

    def alerts(self, spark: SparkSession) -> DataFrame | None:
        """The log: ``batch, window_start, column, alert, psi``; a later batch may withdraw an alert. None before the first batch."""
        return self.log(spark).read()
