"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
SHUFFLE_PARTITIONS_CONF = "spark.sql.shuffle.partitions"
TIME_ZONE_CONF = "spark.sql.session.timeZone"
SHARED_DIR_CONF = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}


def build_session(
    app: str = "millrace",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    rocksdb: bool = False,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC time, adaptive execution and, if asked for, RocksDB state.

    ``shuffle_partitions`` also fixes the number of state partitions of a streaming query for
    its whole life, so size it for the state expected, not for the first batch.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if rocksdb:
        builder = builder.config(STATE_PROVIDER_CONF, ROCKSDB_PROVIDER)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting inside the block; a streaming query keeps those it was started with."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def rocksdb_state(spark: SparkSession) -> AbstractContextManager[None]:
    """Streaming queries started inside the block keep their state in RocksDB."""
    return setting(spark, STATE_PROVIDER_CONF, ROCKSDB_PROVIDER)


def state_partitions(spark: SparkSession, partitions: int) -> AbstractContextManager[None]:
    """Streaming queries started inside the block split their state into so many partitions.

    The number holds for the whole life of a query, so the caller sizes it for the state expected.
    """
    return setting(spark, SHUFFLE_PARTITIONS_CONF, str(partitions))


def utc(spark: SparkSession) -> AbstractContextManager[None]:
    """Frames made inside the block read and print wall-clock times as UTC.

    Spark fixes the zone of a time expression when the frame is made, so a frame keeps it after
    the block, and the caller's own zone is back.
    """
    return setting(spark, TIME_ZONE_CONF, "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a scratch folder of its own that
    goes away with the process.
    """
    named = spark.conf.get(SHARED_DIR_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_DIR_CONF} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def run_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
