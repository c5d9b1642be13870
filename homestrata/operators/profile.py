"""Quality profiles of collected listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestrata.functions.common import round_exact


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def flag_duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``duplicate`` = yes/no per row.

    Counting and joining back instead of a count over (partition by key): counts
    combine before the exchange and the join can split a huge key, a window cannot.
    NULL keys are equal to each other, as they are when grouped.
    """
    own = [f"_key_{i}" for i in range(len(keys))]
    marks = duplicates(rows, keys).select(*[F.col(k).alias(o) for k, o in zip(keys, own)], F.lit("yes").alias("_mark"))
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own)]
    joined = rows.join(marks, same, "left")
    return joined.withColumn("duplicate", F.coalesce("_mark", F.lit("no"))).drop("_mark", *own)


def uniqueness(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, distinct keys, keys that repeat."""
    return (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
            F.count("*").alias("unique_keys"),
            F.count_if(F.col("_n") > 1).alias("repeated_keys"),
        )
    )


def zero_price_profile(rows: DataFrame, low: int = 40, high: int = 120) -> DataFrame:
    """One row: how many listings lack a price, and whether the count is plausible."""
    total, zero = F.col("total"), F.col("zero_price")
    counted = rows.agg(F.count("*").alias("total"), F.count_if(F.col("price") == 0).alias("zero_price"))
    return counted.select(
        "total",
        "zero_price",
        F.when(total > 0, round_exact(zero / total * 100, 1)).alias("zero_price_pct"),
        total.between(low, high).alias("count_in_range"),
    )
