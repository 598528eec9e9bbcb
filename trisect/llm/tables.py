"""Shared helpers: null-safe text columns, tables kept on the shared folder, row keys, columns made in Python."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from trisect.session import scratch_path, shared_folder

# ASCII white space; words are runs of anything else.
SPACE_CLASS = r"[\x20\x09-\x0D]"


# Bytes of a batch whose columns are made at once.
MOST_AT_ONCE = 2_000_000

_kept: list = []


def kept_between_tasks(cached):
    """Register a cache that a reused worker process carries from task to task."""
    _kept.append(cached)
    return cached


_frozen = False


def trim_worker() -> None:
    """Give back memory that this worker process holds but no longer uses, from this task or earlier ones."""
    global _frozen
    gc.collect()
    if not _frozen:
        # What the imports made stays for good; the collector need not walk through it in every task.
        gc.freeze()
        _frozen = True
    pa.default_memory_pool().release_unused()
    # Only some C libraries have it; without it the memory goes back when the worker ends.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def fresh_worker() -> None:
    """Give back all that earlier tasks have left in this worker process, of any stage: their caches too.

    A reused worker otherwise holds the sum of what the stages of a job need. Tasks call it that have no use for the caches.
    """
    for cached in _kept:
        cached.cache_clear()
    trim_worker()


def light(run: Callable) -> Callable:
    """A function over batches that begins in a fresh worker and leaves none of its own memory behind."""

    def wrapped(batches):
        fresh_worker()
        yield from run(batches)
        trim_worker()

    return wrapped


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from here; a cluster ships it with --py-files."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    root = str(Path(__file__).resolve().parents[2])
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(table: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, lost executors lose nothing."""
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def row_key(*columns: str) -> Column:
    """A 128-bit key of a row's content; equal rows get equal keys. Lengths mark where a part ends."""
    parts = [
        F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("n"))
        for c in columns
    ]
    return F.md5(F.concat(*parts))


def slices(batch: pa.RecordBatch, most: int | None = None):
    """Consecutive parts of a batch of about that many bytes, a longer row alone: values made of a part take many times its room."""
    rows = max(1, batch.num_rows * (most or MOST_AT_ONCE) // max(batch.nbytes, 1))
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def with_columns(table: DataFrame, added: str, make: Callable) -> DataFrame:
    """Append columns made in Python. ``make()`` returns a function from a record batch to a list of columns.

    Columns of the same names are replaced, all others pass through untouched. Batches are cut into slices, both for the
    function and on their way back to Spark, which holds each that it gets in memory of its own.
    """
    fields = T._parse_datatype_string(added)
    table = table.drop(*fields.fieldNames())
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches):
        trim_worker()
        columns_of = make()
        for batch in batches:
            for part in slices(batch):
                arrays = [pa.array(a, t) for a, t in zip(columns_of(part), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *arrays], names=[*part.schema.names, *fields.fieldNames()]
                )
        columns_of = batch = part = arrays = None  # noqa: F841
        trim_worker()

    return table.mapInArrow(run, T.StructType([*table.schema.fields, *fields.fields]))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; nulls are empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def shared_file(spark: SparkSession, content: bytes, name: str) -> str:
    """Put bytes in the shared folder and have every executor fetch them; returns the name for ``SparkFiles``."""
    name = f"{name}-{uuid.uuid4().hex}"
    jvm, context = spark._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    context.addFile(path.toString())
    return name


def local_file(name: str) -> str:
    """Where this executor has a shared file."""
    return SparkFiles.get(name)


def up_to_share(n: int, most: int) -> int:
    """The largest 64-bit hash of the share ``most / n`` of all hashes; all of them where there are no more rows than that."""
    return 2**63 - 1 if n <= most else int(2**64 * most / n) - 2**63


def sample_of_texts(documents: DataFrame, most: int, text: str = "text") -> DataFrame:
    """(text): about ``most`` distinct texts, or all where there are no more rows; the choice is the hash's alone.

    Every task decides for itself, and copies of a text are one before they leave their task.
    """
    order = F.xxhash64(text_or_empty(text))
    rows = documents.select(order.alias("_order"), text_or_empty(text).alias("text"))
    chosen = rows.where(F.col("_order") <= up_to_share(documents.count(), most))
    return chosen.groupBy("_order").agg(F.first("text").alias("text")).select("text")


def most_frequent(counts: DataFrame, count: str, most: int) -> DataFrame:
    """The rows of the largest counts, down to a level of frequency that keeps within ``most`` rows."""
    level = F.floor(F.log2(count) * 64)
    room, lowest = most, None
    for row in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        room -= row["count"]
        if room < 0:
            break
        lowest = row["level"]
    return counts.where(F.lit(False) if lowest is None else level >= lowest)


def stored_in_order(table: DataFrame, order: list, name: str) -> DataFrame:
    """Write a table sorted over all tasks, with ``place``: a number that rises with the order and is each row's own.

    The upper bits (above 33) are the task, the lower ones count within it. No key, however hot, is sorted in one task,
    as long as its rows differ in the columns of the order.
    """
    ranged = table.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.withColumn("place", F.monotonically_increasing_id()), name)
