"""Session helpers: a local session for tests, and where intermediate tables are kept."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table is only hinted for broadcast after it was counted and found no longer than this.
BROADCAST_ROWS = 100_000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and the local bench; on a cluster the caller brings their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("trisect")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` as the session has it.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        # Executors of local-cluster are processes of their own, which need not share a temporary folder.
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="trisect-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_run: ContextVar[str | None] = ContextVar("trisect_run", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, or below that of the run it is asked for in."""
    return f"{_run.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession):
    """Intermediate tables that are written inside are deleted at the end, also after an error.

    What is to outlive them must be written, or fetched, inside: results are read from these tables when they are computed.
    """
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    mark = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(mark)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def keep(table: DataFrame) -> DataFrame:
    """Compute a table of unknown size once, on reliable storage, and cut its lineage."""
    shared_folder(table.sparkSession)
    return table.checkpoint(eager=True)


def keep_columns(table: DataFrame, name: str) -> DataFrame:
    """As ``keep``, but written as Parquet: for long tables of a few numbers, which take less room by column."""
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def lookup(table: DataFrame, max_rows: int | None = None) -> DataFrame:
    """An aggregate computed once, to join against or to read again.

    Up to ``max_rows`` rows it is held by the driver and broadcast; the limit is part of the query
    that fetches it. Beyond that it is kept on reliable storage and joins shuffle.
    """
    limit = BROADCAST_ROWS if max_rows is None else max_rows
    # A null struct makes its fields null, whatever they were declared as.
    table = table.select(*[F.col(f.name).cast(_nullable_inside(f.dataType)).alias(f.name) for f in table.schema])
    rows = table.limit(limit + 1).toArrow()
    if rows.num_rows > limit:
        return keep(table)
    return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema))


def _nullable_inside(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable_inside(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable_inside(kind.elementType))
    return kind
