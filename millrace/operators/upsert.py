"""Keyed upserts of one frame into another."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = ("replace", "accumulate")
_SIDE, _ALONE = "_side", "_alone"


def check_rule(rule: str) -> None:
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}, not {rule!r}")


def has_null(keys: Sequence[str]) -> Column:
    """True if any of the key columns is null."""
    return reduce(lambda a, b: a | b, [F.col(name).isNull() for name in keys])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    rule: str = "replace",
    null_safe: bool = True,
    order: Sequence[str] = (),
) -> DataFrame:
    """``target`` after the rows of ``source`` are merged in by ``keys``.

    ``replace`` takes the source row where both have the key, ``accumulate`` adds the other
    columns up (nulls count as nothing); keys of one side only stay as they are. ``target`` has
    one row per key. If ``source`` repeats a key, ``accumulate`` adds all its rows, and ``replace``
    takes the row with the highest values of ``order``, columns of the source that the target need
    not have; without ``order`` the repetition is an error when the result is computed. Null keys
    match each other unless ``null_safe`` is false, which is how ``=`` in a SQL merge works.

    Either rule reads each side once and is one aggregate over both, folded map-side.
    """
    check_rule(rule)
    sides = target.withColumn(_SIDE, F.lit(0))
    added = source.withColumn(_SIDE, F.lit(1))
    if rule == "accumulate":
        rows = target.unionByName(source.select(*target.columns))
        return add_up(rows, keys, null_safe)
    ranks = [f"_order{i}" for i in range(len(order))]
    for rank, name in zip(ranks, order):
        sides = sides.withColumn(rank, F.lit(None).cast(source.schema[name].dataType))
        added = added.withColumn(rank, F.col(name))
    rows = sides.unionByName(added.select(*sides.columns))
    values = [name for name in target.columns if name not in keys]
    newest = F.max_by(F.struct(*values), F.struct(_SIDE, *ranks)) if values else F.lit(None)
    repeated = F.lit(False) if order else F.sum(_SIDE) > 1
    refuse = F.raise_error(F.lit(f"the source has several rows of one key of {list(keys)}"))
    return _per_key(rows, keys, null_safe, F.when(repeated, refuse).otherwise(newest), values).select(
        *target.columns
    )


def _per_key(
    rows: DataFrame, keys: Sequence[str], null_safe: bool, value: Column, names: Sequence[str]
) -> DataFrame:
    """One row per key with the fields of ``value``; a null key is only itself if not null-safe."""
    alone = F.when(has_null(keys), F.monotonically_increasing_id()) if not null_safe else F.lit(0)
    groups = rows.withColumn(_ALONE, alone).groupBy(*keys, _ALONE).agg(value.alias("_value"))
    fields = [F.col("_value")[name].alias(name) for name in names]
    # Without other columns the value is still asked for, as it may be an error.
    asked = groups if fields else groups.where(F.col("_value").isNull())
    return asked.select(*keys, *fields)


def add_up(df: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """One row per key with all other columns summed in their own types."""
    values = [name for name in df.columns if name not in keys]
    sums = [F.sum(name).cast(df.schema[name].dataType).alias(name) for name in values]
    if null_safe:
        return df.groupBy(*keys).agg(*sums).select(*df.columns)
    alone = F.when(has_null(keys), F.monotonically_increasing_id())
    return df.withColumn(_ALONE, alone).groupBy(*keys, _ALONE).agg(*sums).select(*df.columns)


def merge_into(
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    rule: str = "replace",
    null_safe: bool = True,
) -> None:
    """The same upsert into a catalog table whose format has row-level operations."""
    check_rule(rule)
    values = [name for name in source.columns if name not in keys]
    old, new = (lambda n: F.col(f"{table}.{n}")), (lambda n: F.col(f"source.{n}"))
    same = reduce(
        lambda a, b: a & b,
        [old(n).eqNullSafe(new(n)) if null_safe else old(n) == new(n) for n in keys],
    )
    if rule == "replace":
        changes = {name: new(name) for name in values}
    else:
        changes = {
            name: F.coalesce(old(name) + new(name), old(name), new(name)) for name in values
        }
    merge = source.alias("source").mergeInto(table, same)
    merge.whenMatched().update(changes).whenNotMatched().insertAll().merge()
