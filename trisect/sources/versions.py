"""Versions of a table that are published whole and can be compared without reading what is equal.

A version is a folder of rows, dealt by a hash of their key to a power of two of buckets, a table of digests per bucket, and a
manifest. The manifest is written last and makes the version exist: a job that dies before leaves files that nobody reads, and may be run again.
A version is never overwritten.

Two versions are compared by their digests first; only buckets that differ are read and joined by key. Digests do not depend on the order of rows.
Versions with different numbers of buckets are compared at the smaller one. Rows with the same key are compared as a
bag: a key is changed if the rows under it differ in number or content. Null is a key and a value like others. Columns that one version lacks make
all its rows differ, and a column of another type as well.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisect.functions.keys import join_groups
from trisect.session import lookup
from trisect.sources.tables import artifact_path

BUCKET = "_bucket"
MANIFEST = "manifest.json"
# Rows that a bucket should hold, and the least and most buckets.
BUCKET_ROWS = 500_000
LEAST_BUCKETS, MOST_BUCKETS = 16, 1 << 17


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _write_new(spark: SparkSession, path: str, text: str) -> None:
    """Create a file with a text; fails if it is there already."""
    hadoop, system = _file_system(spark, path)
    out = system.create(hadoop, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    hadoop, system = _file_system(spark, path)
    return spark.read.option("wholetext", True).text(path).first()["value"] if system.exists(hadoop) else None


@dataclass(frozen=True)
class Version:
    """A published version: where its rows are, and what its manifest says."""

    spark: SparkSession
    path: str
    key: tuple[str, ...]
    buckets: int
    n_rows: int
    schema: T.StructType
    parent: str | None

    def rows(self, buckets: Sequence[int] | None = None, of: int | None = None) -> DataFrame:
        """The rows, or those of some buckets out of ``of``; other folders are not read."""
        table = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(f"{self.path}/rows")
        if buckets is not None:
            wanted = [b for b in range(self.buckets) if b % (of or self.buckets) in set(buckets)]
            table = table.where(F.col(BUCKET).isin(*wanted))
        return table.select(*self.schema.fieldNames())

    def digests(self) -> DataFrame:
        """``_bucket, n, first, second``: two sums of row hashes per bucket."""
        return self.spark.read.parquet(f"{self.path}/digests")


def _hash(columns: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(c).isNull() for c in columns], *columns).cast("decimal(20,0)")


def _digest(columns: Sequence[str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"), F.sum(_hash(columns, 1)).alias("first"), F.sum(_hash(columns, 2)).alias("second")
    ]


def _columns(schema: T.StructType) -> str:
    """Names and types in a fixed order; whether nulls are declared is left out."""
    return json.dumps(sorted((f.name, f.dataType.simpleString()) for f in schema))


def publish(
    df: DataFrame, root: str, name: str, version: str, key: Sequence[str], parent: str | None = None, buckets: int | None = None
) -> Version:
    """Write a version and make it visible at once; an error if it is there already.

    The number of buckets is that of the ``parent`` version, or follows the number of rows.
    """
    spark, path = df.sparkSession, artifact_path(root, name, version)
    if _read_text(spark, f"{path}/{MANIFEST}") is not None:
        raise ValueError(f"version {version!r} of {name!r} is there already")
    if BUCKET in df.columns or not key or set(key) - set(df.columns):
        raise ValueError(f"the key must name columns of the table, and none may be called {BUCKET}")
    if buckets is None and parent is not None:
        buckets = open_version(spark, root, name, parent).buckets
    if buckets is None:
        buckets = LEAST_BUCKETS
        n = df.count()
        while buckets < MOST_BUCKETS and buckets * BUCKET_ROWS < n:
            buckets *= 2
    if buckets < 1 or buckets & (buckets - 1):
        raise ValueError("the number of buckets must be a power of two")
    # Every attempt has a folder of its own, so that what a failed one left is never read.
    attempt = f"{path}/attempt-{uuid.uuid4().hex}"
    bucket = F.pmod(F.xxhash64(*[F.col(k).isNull() for k in key], *key), F.lit(buckets)).cast("int")
    # Adaptive execution splits a bucket that a frequent key has made large over several tasks and files.
    df.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{attempt}/rows")
    written = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(f"{attempt}/rows")
    names = sorted(df.columns)
    written.groupBy(BUCKET).agg(*_digest(names)).coalesce(1).write.parquet(f"{attempt}/digests")
    n_rows = spark.read.parquet(f"{attempt}/digests").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    manifest = {
        "attempt": attempt.rsplit("/", 1)[1], "key": list(key), "buckets": buckets, "n_rows": n_rows, "parent": parent,
        "schema": df.schema.jsonValue(),
    }
    _write_new(spark, f"{path}/{MANIFEST}", json.dumps(manifest))
    return open_version(spark, root, name, version)


def open_version(spark: SparkSession, root: str, name: str, version: str) -> Version:
    """A published version; an error if there is none of that name."""
    path = artifact_path(root, name, version)
    text = _read_text(spark, f"{path}/{MANIFEST}")
    if text is None:
        raise ValueError(f"there is no version {version!r} of {name!r}")
    found = json.loads(text)
    return Version(
        spark, f"{path}/{found['attempt']}", tuple(found["key"]), found["buckets"], found["n_rows"],
        T.StructType.fromJson(found["schema"]), found["parent"],
    )


def versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """Published versions of a name, in text order."""
    top, system = _file_system(spark, f"{root}/name={name}")
    if not system.exists(top):
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path
    folders = [s.getPath() for s in system.listStatus(top) if s.getPath().getName().startswith("version=")]
    return sorted(p.getName().removeprefix("version=") for p in folders if system.exists(path(p, MANIFEST)))


def changed_buckets(old: Version, new: Version) -> tuple[list[int], int]:
    """The buckets whose digests differ, and out of how many. As many numbers as there are buckets reach the driver."""
    of = min(old.buckets, new.buckets)
    if _columns(old.schema) != _columns(new.schema):
        return list(range(of)), of
    sides = [
        v.digests().groupBy((F.col(BUCKET) % of).alias(BUCKET)).agg(*[F.sum(c).alias(f"{c}_{s}") for c in ("n", "first", "second")])
        for s, v in (("old", old), ("new", new))
    ]
    same = [F.col(f"{c}_old").eqNullSafe(F.col(f"{c}_new")) for c in ("n", "first", "second")]
    rows = sides[0].join(sides[1], BUCKET, "full").where(~(same[0] & same[1] & same[2])).select(BUCKET).collect()
    return sorted(r[0] for r in rows), of


def compare(old: Version, new: Version) -> DataFrame:
    """Keys that differ: the key's columns, ``change`` (added, removed or changed), ``n_old``, ``n_new`` (rows under the key)."""
    if old.key != new.key:
        raise ValueError("versions with different keys cannot be compared")
    buckets, of = changed_buckets(old, new)
    key = list(old.key)
    sides = []
    for suffix, v in (("old", old), ("new", new)):
        digest = _digest(sorted(v.schema.fieldNames()))
        sums = v.rows(buckets, of).groupBy(*key).agg(*digest)
        sides.append(sums.select(*key, *[F.col(c).alias(f"{c}_{suffix}") for c in ("n", "first", "second")]))
    other = sides[1].withColumnsRenamed({k: f"_new_{k}" for k in key})
    match = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in key]
    joined = sides[0].join(other, match, "full")
    there = F.col("n_old").isNotNull()
    differ = F.col("n_old").isNull() | F.col("n_new").isNull() | (F.col("n_old") != F.col("n_new"))
    if _columns(old.schema) != _columns(new.schema):
        differ = F.lit(True)
    else:
        differ = differ | (F.col("first_old") != F.col("first_new")) | (F.col("second_old") != F.col("second_new"))
    change = F.when(~there, "added").when(F.col("n_new").isNull(), "removed").otherwise("changed")
    return joined.where(differ).select(
        *[F.when(there, F.col(k)).otherwise(F.col(f"_new_{k}")).alias(k) for k in key], change.alias("change"),
        F.coalesce("n_old", F.lit(0).cast("long")).alias("n_old"), F.coalesce("n_new", F.lit(0).cast("long")).alias("n_new"),
    )


def summary(old: Version, new: Version) -> DataFrame:
    """Rows per kind of change: ``change, keys, rows_old, rows_new``; kinds that do not occur have a row of zeros."""
    counts = lookup(compare(old, new).groupBy("change").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("n_old").alias("rows_old"), F.sum("n_new").alias("rows_new")
    ))
    kinds = old.spark.range(1).select(F.explode(F.array(*map(F.lit, ("added", "changed", "removed")))).alias("change"))
    return join_groups(kinds, counts, ["change"], "left").fillna(0)
