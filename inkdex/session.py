"""Shared folder for data that several jobs read."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Spark's setting to remove the files of an execution's exchanges when it ends.
FREE_EXCHANGES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Measured size up to which a stored table is broadcast.
BROADCAST_BYTES = 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables.

    Only a local session may go without the setting; it then gets a temporary folder of its own,
    because driver and executors are one machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="inkdex-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A new path, below one folder per application, which can be removed when that has ended."""
    return f"{shared_dir(spark)}/inkdex-{spark.sparkContext.applicationId}/{purpose}-{uuid4().hex}"


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Within it, what jobs exchanged is removed from the disks as soon as their result is stored or collected.

    Otherwise it stays until the driver happens to collect its objects, so that a build of many steps holds the exchanges of all of
    them at once. For DataFrames that are executed once.
    """
    before = spark.conf.get(FREE_EXCHANGES, None)
    spark.conf.set(FREE_EXCHANGES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_EXCHANGES)
        else:
            spark.conf.set(FREE_EXCHANGES, before)


def settle(df: DataFrame, purpose: str = "settled") -> DataFrame:
    """Write a DataFrame to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, keeps later reads columnar, and gives the
    planner the true size of the data, so that what is broadcast is decided by that size.
    """
    path = new_folder(df.sparkSession, purpose)
    with freeing(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_sized(df: DataFrame, purpose: str = "settled") -> tuple[DataFrame, bool]:
    """``settle``, and whether the table is small enough to broadcast.

    The size is summed while the table is written: the length of texts, of lists in text form, and
    eight bytes for anything else.
    """

    def width(field: T.StructField):
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0))
        if isinstance(field.dataType, (T.ArrayType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0))
        return F.lit(8)

    written = Observation()
    row = sum((width(field) for field in df.schema), F.lit(8)).cast("bigint")
    stored = settle(df.observe(written, F.sum(row).alias("bytes")), purpose)
    return stored, (written.get["bytes"] or 0) <= BROADCAST_BYTES


def side(table: DataFrame, small: bool) -> DataFrame:
    """A table of ``settle_sized`` as a side of a join: broadcast if it is small, and else exchanged.

    Spark would go by the size of its files, which may be a hundredth of what the rows take in the driver's memory.
    """
    return F.broadcast(table) if small else table.hint("merge")
