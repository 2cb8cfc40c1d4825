"""Results that micro-batches keep up to date on plain Parquet.

Both classes write each batch to a folder of its own and never to a path that is being read. A
batch that is run again after a failure writes the same rows to a new folder, and the newest
finished one counts, so its effect is there once and frames that read the older one still do.
What is out of date is deleted only when it has been so for ``keep_for`` seconds, by default an
hour: give the longest time that a reader may take. Batch ids restart at 0 with a new checkpoint,
so a root belongs to the query and checkpoint that first wrote to it, and others are refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.logs import newest_rows
from millrace.operators.upsert import add_up, check_rule, has_null
from millrace.streaming.folders import age, attempts, claim, next_attempt, remove, subfolders

KEEP_FOR = 3600.0


class Snapshots:
    """The whole result of a complete-mode stream, one folder per batch, newest read."""

    def __init__(self, root: str, keep_for: float = KEEP_FOR):
        self.root = root.rstrip("/")
        self.keep_for = keep_for

    def save(self, df: DataFrame, batch_id: int) -> None:
        """Write the result of a batch and drop results that have long been replaced."""
        spark = df.sparkSession
        claim(spark, self.root)
        df.write.parquet(next_attempt(spark, f"{self.root}/batch={batch_id}"))
        done = attempts(spark, self.root, "batch")
        ids = list(done)
        for old, newer in zip(ids, ids[1:]):
            if age(spark, done[newer]) >= self.keep_for:
                remove(spark, f"{self.root}/batch={old}")

    def read(self, spark: SparkSession) -> DataFrame:
        """Result after the newest finished batch."""
        batches = attempts(spark, self.root, "batch")
        if not batches:
            raise LookupError(f"no finished batch under {self.root}")
        return spark.read.parquet(batches[max(batches)])

    def as_view(self, spark: SparkSession, name: str) -> None:
        """Let SQL read the present result as ``name``; call it again to move to a newer one."""
        self.read(spark).createOrReplaceTempView(name)


class UpsertStore:
    """A keyed result to which each micro-batch adds its changes.

    ``apply`` writes only the rows of its batch, so its cost does not grow with the result.
    ``read`` folds them by key: the newest row for ``replace``, sums for ``accumulate``. Every
    ``roll_up_every`` batches the folded result is written out, so that a read never folds more
    batches than that.

    ``part`` is an expression of the keys, such as the day of a time among them. With it a read
    folds, and a roll-up rewrites, only the parts that lately had changes; the rest of the
    result is a plain scan. Its number of values should stay in the thousands.
    """

    def __init__(
        self,
        root: str,
        keys: Sequence[str],
        rule: str = "replace",
        part: Column | None = None,
        null_safe: bool = True,
        roll_up_every: int = 20,
        keep_for: float = KEEP_FOR,
    ):
        check_rule(rule)
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.rule = rule
        self.part = part
        self.null_safe = null_safe
        self.roll_up_every = roll_up_every
        self.keep_for = keep_for

    def apply(self, df: DataFrame, batch_id: int) -> None:
        """Record the rows of a batch; for ``replace`` one per key, or it is refused."""
        if taken := {"part", "batch", "attempt", "_batch"} & set(df.columns):
            raise ValueError(f"the store's folders use the column names {sorted(taken)}")
        claim(df.sparkSession, self.root)
        written = self._write(df, f"batch={batch_id}")
        if self.rule == "replace":
            self._refuse_repeats(df.sparkSession, written)
        if (batch_id + 1) % self.roll_up_every == 0:
            self.roll_up(df.sparkSession, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        """The result after every finished batch."""
        still, moving = self._layers(spark, attempts(spark, self.root, "rolled"))
        settled = self._scan(spark, still)
        folded = self._fold(spark, moving)
        if settled is None and folded is None:
            raise LookupError(f"no rows yet under {self.root}")
        if settled is None or folded is None:
            return settled if folded is None else folded
        return settled.unionByName(folded)

    def as_view(self, spark: SparkSession, name: str) -> None:
        """Let SQL read the present result as ``name``; call it again to move to a newer one."""
        self.read(spark).createOrReplaceTempView(name)

    def roll_up(self, spark: SparkSession, batch_id: int) -> None:
        """Fold all batches up to ``batch_id`` into the parts they touch.

        Then batches that an earlier roll-up had folded are dropped, and so are versions of parts
        that it had replaced, if it was finished at least ``keep_for`` seconds ago.
        """
        rolled = attempts(spark, self.root, "rolled")
        earlier = {i: folder for i, folder in rolled.items() if i < batch_id}
        _, moving = self._layers(spark, earlier, batch_id)
        folded = self._fold(spark, moving)
        if folded is None:
            return
        self._write(folded, f"rolled={batch_id}")
        settled = [i for i, f in earlier.items() if age(spark, f) >= self.keep_for]
        if not settled:
            return
        for old in attempts(spark, self.root, "batch"):
            if old <= settled[-1]:
                remove(spark, f"{self.root}/batch={old}")
        replaced: set[str] = set()
        for i in reversed(settled):
            parts = set(subfolders(spark, earlier[i]))
            for part in parts & replaced:
                remove(spark, f"{earlier[i]}/{part}")
            if parts <= replaced:
                remove(spark, f"{self.root}/rolled={i}")
            replaced |= parts

    def _refuse_repeats(self, spark: SparkSession, written: str) -> None:
        """Look for a repeated key in what was written; only the key columns are read."""
        if not subfolders(spark, written):
            return
        rows = spark.read.parquet(written)
        known = rows if self.null_safe else rows.where(~has_null(self.keys))
        counts = known.groupBy(*self.keys).agg(F.count("*").alias("_n"))
        if not counts.where("_n > 1").isEmpty():
            remove(spark, written)
            raise ValueError(f"a batch has several rows of one key of {self.keys}")

    def _write(self, df: DataFrame, folder: str) -> str:
        part = F.lit("all") if self.part is None else self.part.cast("string")
        rows = df.withColumn("part", part)
        if self.part is not None:
            # Few files per part, yet a part much larger than the rest still gets many tasks.
            # Where adaptive execution is off Spark ignores this and writes rows where they are.
            rows = rows.hint("rebalance", F.col("part"))
        attempt = next_attempt(df.sparkSession, f"{self.root}/{folder}")
        rows.write.partitionBy("part").parquet(attempt)
        return attempt

    def _layers(
        self, spark: SparkSession, rolled: dict[int, str], through: int | None = None
    ) -> tuple[list[str], list[str]]:
        """Folders of parts without changes since the last roll-up, and of parts with some."""
        newest: dict[str, str] = {}
        for folder in rolled.values():
            for part in subfolders(spark, folder):
                newest[part] = f"{folder}/{part}"
        last = max(rolled, default=-1)
        moving, touched = [], set()
        for i, folder in attempts(spark, self.root, "batch").items():
            if i > last and (through is None or i <= through):
                parts = subfolders(spark, folder)
                moving += [f"{folder}/{part}" for part in parts]
                touched.update(parts)
        moving += [path for part, path in newest.items() if part in touched]
        return [path for part, path in newest.items() if part not in touched], moving

    def _scan(self, spark: SparkSession, folders: list[str]) -> DataFrame | None:
        return spark.read.parquet(*folders) if folders else None

    def _fold(self, spark: SparkSession, folders: list[str]) -> DataFrame | None:
        bases = self._scan(spark, [f for f in folders if f.startswith(f"{self.root}/rolled=")])
        changes = [f for f in folders if f.startswith(f"{self.root}/batch=")]
        if not changes:
            return bases
        # The folder names give each change its batch id; rolled-up rows are older than any.
        rows = spark.read.option("basePath", self.root).parquet(*changes).drop("part", "attempt")
        rows = rows.withColumn("_batch", F.col("batch").cast("bigint")).drop("batch")
        columns = [name for name in rows.columns if name != "_batch"]
        if bases is not None:
            rows = rows.unionByName(bases.withColumn("_batch", F.lit(-1)))
        if self.rule == "accumulate":
            return add_up(rows.select(*columns), self.keys, self.null_safe)
        if self.null_safe:
            return newest_rows(rows, self.keys, "_batch").select(*columns)
        # A null key equals no other, so its rows stay as they are.
        known = newest_rows(rows.where(~has_null(self.keys)), self.keys, "_batch")
        return known.select(*columns).unionByName(rows.where(has_null(self.keys)).select(*columns))
