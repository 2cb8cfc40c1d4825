"""Names of result folders, through Hadoop's file system so that any shared storage will do."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders inside ``path``; none if it does not exist."""
    where, files = _open(spark, path)
    if not files.exists(where):
        return []
    return [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()]


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path``; none if it does not exist."""
    where, files = _open(spark, path)
    return files.getContentSummary(where).getLength() if files.exists(where) else 0


def attempts(spark: SparkSession, root: str, kind: str) -> dict[int, str]:
    """The newest finished attempt at each ``root/kind=<id>``, by ascending id.

    Every attempt at a batch has a folder of its own, ``root/kind=<id>/attempt=<n>``, so a frame
    that reads one still does when the batch runs again.
    """
    newest = {}
    for name in subfolders(spark, root):
        if name.startswith(f"{kind}="):
            done = [n for n in _attempts(spark, f"{root}/{name}") if n[1]]
            if done:
                newest[int(name.split("=", 1)[1])] = f"{root}/{name}/attempt={max(done)[0]}"
    return dict(sorted(newest.items()))


def _attempts(spark: SparkSession, folder: str) -> list[tuple[int, bool]]:
    found = []
    for name in subfolders(spark, folder):
        where, files = _open(spark, f"{folder}/{name}/_SUCCESS")
        found.append((int(name.split("=", 1)[1]), files.exists(where)))
    return found


def next_attempt(spark: SparkSession, folder: str) -> str:
    """A folder for one more attempt at the batch of ``folder``."""
    taken = [n for n, _ in _attempts(spark, folder)]
    return f"{folder}/attempt={max(taken, default=-1) + 1}"


def finished(spark: SparkSession, root: str, kind: str) -> list[int]:
    """Ids of the batches with an attempt that a Spark write has completed, ascending."""
    return list(attempts(spark, root, kind))


def age(spark: SparkSession, attempt: str) -> float:
    """Seconds since a finished attempt was completed."""
    where, files = _open(spark, f"{attempt}/_SUCCESS")
    return time.time() - files.getFileStatus(where).getModificationTime() / 1000


def claim(spark: SparkSession, root: str) -> None:
    """Bind ``root`` to the streaming query that calls, which keeps its id across restarts.

    Another query, or the same one started from a new checkpoint, counts its batches anew and
    would mix them with those in ``root``; it is refused. Outside a stream nothing is bound.
    """
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if query is None:
        return
    owners = [name for name in subfolders(spark, root) if name.startswith("query=")]
    if not owners:
        where, files = _open(spark, f"{root}/query={query}")
        files.mkdirs(where)
    elif owners != [f"query={query}"]:
        raise ValueError(f"{root} holds the batches of another query or checkpoint")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    where, files = _open(spark, path)
    files.delete(where, True)
