"""Reading and writing: tables, dated CSV, versioned artifacts, feature metadata, arrays, ingestion."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_ROW = "_bad_row"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A parquet path (anything with a slash) or a catalog table of one to three parts."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, timestamp_format: str | None = None) -> DataFrame:
    """CSV with a header and typed columns; dates are parsed while reading."""
    options = {"header": True}
    if timestamp_format:
        options |= {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format}
    return spark.read.schema(schema).options(**options).csv(path)


def artifact_path(root: str, name: str, version: str) -> str:
    return f"{root}/name={name}/version={version}"


def write_artifact(df: DataFrame, root: str, name: str, version: str) -> str:
    """Write a table under a name and version; a version is never overwritten."""
    path = artifact_path(root, name, version)
    df.write.mode("errorifexists").parquet(path)
    return path


def read_artifact(spark: SparkSession, root: str, name: str, version: str) -> DataFrame:
    return spark.read.parquet(artifact_path(root, name, version))


def write_model(model, root: str, name: str, version: str) -> str:
    """Save a fitted MLlib model or pipeline under a name and version."""
    path = artifact_path(root, name, version)
    model.write().save(path)
    return path


def metadata_list(document, key: str):
    """A list of strings from a JSON metadata column: text becomes a list of one, missing an empty list.

    Any other kind of value is an error when the row is read.
    """
    field = F.try_variant_get(F.parse_json(document), f"$.{key}", "variant")
    kind = F.schema_of_variant(field)
    return (
        F.when(field.isNull() | (kind == "VOID"), F.array().cast("array<string>"))
        .when(kind == "STRING", F.array(F.variant_get(field, "$", "string")))
        .when(kind.startswith("ARRAY"), F.variant_get(field, "$", "array<string>"))
        .otherwise(F.raise_error(F.concat(F.lit(f"metadata key {key!r} must be a list, found "), kind)))
    )


def read_metadata(df: DataFrame, document: str) -> DataFrame:
    """Feature metadata from a JSON text column: adds ``target`` (first value or null) and ``features``."""
    text = F.col(document)
    return df.withColumns({
        "target": F.try_element_at(metadata_list(text, "target"), F.lit(1)),
        "features": metadata_list(text, "all"),
    })


def from_arrays(spark: SparkSession, x: np.ndarray | pd.DataFrame, y, label: str = "label") -> DataFrame:
    """A DataFrame from feature and label arrays that the caller holds in memory."""
    frame = x.copy() if isinstance(x, pd.DataFrame) else pd.DataFrame(np.asarray(x))
    labels = np.asarray(y)
    if frame.empty or labels.size == 0:
        raise ValueError("features and labels must not be empty")
    if len(frame) != len(labels):
        raise ValueError("features and labels differ in length")
    if not isinstance(x, pd.DataFrame):
        frame.columns = [f"f{i}" for i in range(frame.shape[1])]
    frame[label] = labels
    return spark.createDataFrame(frame)


@dataclass(frozen=True)
class Ingested:
    """Rows that fit the schema, and the raw rows that do not, with the columns at fault."""

    valid: DataFrame
    rejected: DataFrame


def ingest(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "json", **options) -> Ingested:
    """Typed read of flat JSON or CSV files; rows with a value that does not fit are set apart.

    Values are read as text and cast one by one, so a bad value is told from a missing one. In
    ``rejected`` the column ``faults`` lists the columns at fault; for a line that cannot be
    parsed at all it holds the name of the raw text column, ``_bad_row``.
    """
    raw = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema], T.StructField(BAD_ROW, T.StringType())])
    reader = spark.read.schema(raw).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_ROW)
    if file_format == "csv":
        reader = reader.option("header", True)
    rows = reader.options(**options).format(file_format).load(path)
    fault = lambda name, bad: F.when(bad, F.lit(name))
    faults = [fault(BAD_ROW, F.col(BAD_ROW).isNotNull())] + [
        fault(f.name, F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()) for f in schema
    ]
    checked = rows.withColumn("faults", F.array_compact(F.array(*faults)))
    return Ingested(
        checked.where(F.size("faults") == 0).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]),
        checked.where(F.size("faults") > 0),
    )


def ingest_version(
    spark: SparkSession, path: str, schema: T.StructType, root: str, name: str, version: str, file_format: str = "json", **options
) -> Ingested:
    """``ingest``, and store both sides under a version: ``name`` and ``name_rejected``. Returns what was stored."""
    found = ingest(spark, path, schema, file_format, **options)
    for rows, kind in ((found.valid, name), (found.rejected, f"{name}_rejected")):
        write_artifact(rows, root, kind, version)
    return Ingested(read_artifact(spark, root, name, version), read_artifact(spark, root, f"{name}_rejected", version))


def read_jdbc(
    spark: SparkSession, url: str, table: str, split_column: str, low, high, partitions: int, **options
) -> DataFrame:
    """A database table, read in parallel ranges of a column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=split_column, lowerBound=low, upperBound=high,
                 numPartitions=partitions, **options)
        .load()
    )
