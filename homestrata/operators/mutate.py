"""Table changes as pure functions (target, changes) -> new target.

Nothing is written here: the result goes to a new place, never over the files being
read. ``changes`` must hold one row per key (see ``ordered.latest_by``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_replace(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Changed rows replace the stored ones whole; new keys are added."""
    kept = target.join(changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def upsert_partial(
    target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """Set ``columns`` from the changes, creating rows for new keys.

    A NULL in the change overwrites; other columns are kept.
    """
    values = F.struct(*columns).alias("_set")
    joined = target.join(changes.select(*keys, values), keys, "full_outer")
    changed = F.col("_set").isNotNull()
    out = [c for c in target.columns if c not in columns] + columns
    return joined.select(
        *[_chosen(c, columns, target.columns, changed) for c in out],
    )


def update_existing(
    target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """Set ``columns`` only on rows that exist; unmatched changes have no effect."""
    values = F.struct(*columns).alias("_set")
    joined = target.join(changes.select(*keys, values), keys, "left")
    changed = F.col("_set").isNotNull()
    out = target.columns + [c for c in columns if c not in target.columns]
    return joined.select(
        *[_chosen(c, columns, target.columns, changed) for c in out],
    )


def _chosen(name, columns, stored, changed):
    if name not in columns:
        return F.col(name)
    new = F.when(changed, F.col("_set")[name])
    return (new.otherwise(F.col(name)) if name in stored else new).alias(name)


def unmatched(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Changes whose key is not stored: failed updates, deletes of nothing."""
    return changes.join(target.select(*keys), keys, "left_anti")


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add rows whose key is not stored yet; stored rows win."""
    added = rows.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(added, allowMissingColumns=True)


def delete_keys(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(rows.select(*keys), keys, "left_anti")


def mark_processed(tracked: DataFrame, urls: DataFrame) -> DataFrame:
    """Flag the given URLs; a URL that was not tracked becomes a tracked one."""
    done = urls.select("url").distinct().withColumn("processed", F.lit(True))
    return upsert_partial(tracked, done, ["url"], ["processed"])
