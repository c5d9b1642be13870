"""Order-dependent work that must survive one key holding a large share of all rows.

``row_number() over (partition by key)`` puts a whole key into one task. The helpers
here get the same answers from aggregates that combine on the map side, or split a
large key into runs of time first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from homestrata.sources.staging import stage


def _pick(rows: DataFrame, keys: list[str], order: list[Column | str], pick) -> DataFrame:
    values = [c for c in rows.columns if c not in keys]
    chosen = pick(F.struct(*values), F.struct(*order)).alias("_row")
    picked = rows.groupBy(*keys).agg(chosen)
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in values])


def first_by(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """First row per key in ``order``: one aggregate, combined before the exchange, no window."""
    return _pick(rows, keys, order, F.min_by)


def latest_by(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Last row per key in ``order``."""
    return _pick(rows, keys, order, F.max_by)


# Units of time a large key may be cut at, tried in turn until none is too large.
GRAINS = ("day", "hour", "minute", "second")


def large_key_segments(
    rows: DataFrame, key: str, ts: str, target_rows: int = 5_000_000
) -> tuple[DataFrame, str] | None:
    """Where to cut keys of more than ``target_rows`` rows: (key, unit, segment), and the grain.

    ``unit`` is ``ts`` truncated to the grain, NULL being a unit of its own before all
    others; ``segment`` increases over time and holds about ``target_rows`` rows. The
    grain is the coarsest that gives such segments, a second at the finest. None when no
    key is that large, which is the rule, so that callers can plan without cuts.

    Counts are exact and staged: every use sees the same cuts, on retries as well.
    """
    totals = rows.groupBy(key).agg(F.count("*").alias("_n"))
    large = stage(totals.where(F.col("_n") > target_rows).select(key), "large-keys")
    if large.isEmpty():
        return None
    by_time = Window.partitionBy(key).orderBy("unit")
    for grain in GRAINS:
        units = (
            rows.join(large, key, "left_semi")
            .groupBy(key, F.date_trunc(grain, ts).alias("unit"))
            .agg(F.count("*").alias("_n"))
        )
        units = stage(units, "units")
        if grain == GRAINS[-1] or units.where(F.col("_n") > target_rows).isEmpty():
            break
    before = F.sum("_n").over(by_time) - F.col("_n")
    cuts = units.withColumn("_before", before).select(
        key, "unit", F.floor(F.col("_before") / target_rows).alias("segment")
    )
    return stage(cuts, "segments"), grain


def with_segments(rows: DataFrame, segments: DataFrame, key: str, ts: str, grain: str) -> DataFrame:
    """Add ``segment``: NULL for ordinary keys, increasing over time within a large one.

    Joined by key and time unit, so a large key is spread over its units; NULL joins NULL.
    """
    cut = segments.select(F.col(key).alias("_cut_key"), F.col("unit").alias("_cut_unit"), "segment")
    unit = F.date_trunc(grain, ts)
    joined = rows.join(cut, (F.col(key) == F.col("_cut_key")) & unit.eqNullSafe(F.col("_cut_unit")), "left")
    return joined.drop("_cut_key", "_cut_unit")


def placed(rows: DataFrame, order: list[Column | str], name: str = "rank") -> DataFrame:
    """``rows`` with their place from 1 on in ``order``, which is to be total.

    Spark deals the rows into ranges; a row's place in its range comes with the write, and
    one count per range says where the range begins, so no task orders all rows.
    """
    lying = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    held = stage(lying.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = held.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # as many rows as there are ranges
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    joined = held.withColumn("_part", part).join(starts, "_part")
    return joined.select(*rows.columns, (F.col("_start") + inside + 1).alias(name))


# Rows that one task merges from all tasks' first ones; more are found by their last key.
HEAP_ROWS = 10_000

Keys = list[tuple[Column, bool]]  # expression, descending; NULL is before all values


def _up_to(keys: Keys, last: Row, inclusive: bool) -> Column:
    """Rows whose keys are at most, or before, those of ``last``."""
    within, same = F.lit(False), F.lit(True)
    for (key, descending), value in zip(keys, last):
        if value is None:
            before = key.isNotNull() if descending else F.lit(False)
        elif descending:
            before = key > F.lit(value)
        else:
            before = key.isNull() | (key < F.lit(value))
        within = within | (same & before)
        same = same & key.eqNullSafe(F.lit(value))
    return within | same if inclusive else within


def first_rows(rows: DataFrame, keys: Keys, n: int) -> DataFrame:
    """The first ``n`` rows in the order of ``keys``, which tell rows apart; in no order.

    For few rows every task sends its first ones. For more only the keys are dealt into
    ranges, which finds the ``n``-th key, and a filter keeps the rows up to it.
    """
    order = [k.desc_nulls_last() if descending else k.asc_nulls_first() for k, descending in keys]
    if n <= HEAP_ROWS:
        return rows.orderBy(*order).limit(n)
    names = [f"_k{i}" for i in range(len(keys))]
    bare = rows.select(*[k.alias(c) for (k, _), c in zip(keys, names)])
    in_order = [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_first() for c, (_, d) in zip(names, keys)]
    last = placed(bare, in_order, "_rank").where(F.col("_rank") == n).select(*names).first()
    if last is None:
        return rows
    # of rows that repeat the last key as many as are wanted
    before = rows.where(_up_to(keys, last, False))
    more = rows.where(_up_to(keys, last, True) & ~_up_to(keys, last, False)).limit(n - before.count())
    return before.unionByName(more)
