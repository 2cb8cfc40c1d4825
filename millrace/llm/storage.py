"""Cutting the lineage of a result that several later steps read; giving workers the package."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

import millrace
from millrace.session import run_dir, shared_dir
from millrace.streaming.folders import remove

_shipped: set[str] = set()
_folders: dict[int, tuple[DataFrame, str]] = {}


def settled(df: DataFrame) -> DataFrame:
    """The frame, computed once and read back from the shared checkpoint folder.

    The files survive lost executors. Spark removes them with the frame if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The same for large frames: a table in the shared folder, a third as large, typed and with
    sizes the planner knows. It goes when the driver's process ends."""
    spark = df.sparkSession
    folder = run_dir(spark, "stored")
    df.write.parquet(folder)
    atexit.register(_drop, spark, folder)
    table = spark.read.schema(df.schema).parquet(folder)
    _folders[id(table)] = (table, folder)  # the frame is kept, so that its id stays its own
    return table


def discard(*frames: DataFrame) -> None:
    """Delete ``stored`` tables whose last reader has been written."""
    for df in frames:
        spark, folder = df.sparkSession, _folders.pop(id(df), (None, None))[1]
        if folder:
            remove(spark, folder)
    if frames:
        free_shuffles(frames[0].sparkSession)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the files of shuffles that nothing refers to any more.

    It does when the driver's garbage collector has noticed, which is asked to look.
    """
    gc.collect()
    spark._jvm.System.gc()


def _drop(spark: SparkSession, folder: str) -> None:
    if SparkContext._active_spark_context is spark.sparkContext:  # else its storage is gone
        remove(spark, folder)


def ship_package(spark: SparkSession) -> None:
    """Sends this library to the Python workers, once per application.

    Needed where the workers can't import it, as it isn't installed or on their path.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(millrace.__file__).parent
        folder = tempfile.mkdtemp(prefix="millrace-code-")  # Spark hands it on from the driver
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        name = f"{folder}/{package.name}"
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
