"""Tables that streams write: Parquet partitioned by run and epoch.

A run is a stream with its checkpoint, an epoch one of its batches. ``foreachBatch`` may
see a batch again after a failure, and then overwrites that batch's partition; a batch
reads only what is before it, so repeating it gives the same rows. Nothing else is ever
changed in place. A batch that was cut off is to be repeated by its own stream before
another run begins.

``EpochLog`` keeps rows as they come. ``BucketTable`` keeps rows by key: a batch rewrites
the hash buckets its keys fall into, so reading takes the newest partition of every bucket
and neither reads nor joins what came before. ``compact_to`` is the ordinary job that
copies the current rows into a new table once the old partitions are to go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestrata.sources.staging import stage

# sorts before the runs of streams, which begin with a number
_GIVEN = "-"
BUCKETS = 64


class EpochLog:
    """Rows by run and epoch under ``path``."""

    _extra: list[T.StructField] = []

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        marks = [T.StructField("run", T.StringType()), T.StructField("epoch", T.LongType())]
        self._stored = T.StructType([*schema.fields, *self._extra, *marks])
        # the folder alone: no rows, so no partition
        empty = spark.createDataFrame([], self._stored)
        empty.write.mode("ignore").partitionBy("run", "epoch").parquet(self.path)

    def _partition(self, run: str, epoch: int) -> str:
        return f"{self.path}/run={run}/epoch={epoch}"

    def stored(self) -> DataFrame:
        """All rows with ``run`` and ``epoch``."""
        return self.spark.read.schema(self._stored).parquet(self.path)

    def read(self) -> DataFrame:
        return self.stored().select(*self.schema.fieldNames())

    def run_of(self, query: str) -> str:
        """The run of a stream: the one it has written before, or the next one."""
        runs = self.stored().where(F.col("run") != _GIVEN).agg(
            F.max(F.when(F.col("run").endswith(f"-{query}"), F.col("run"))).alias("own"), F.max("run").alias("last")
        )
        own, last = runs.first()
        return own or f"{int((last or '0').partition('-')[0]) + 1:08d}-{query}"

    def write(self, rows: DataFrame, run: str = _GIVEN, epoch: int = 0) -> None:
        """Store a batch's rows in place of what an earlier attempt has stored."""
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(self._partition(run, epoch))


class BucketTable(EpochLog):
    """Current rows by ``keys``; keys may be NULL, and NULLs are equal.

    ``by`` are the keys that buckets are made of, all of them if not given.
    """

    _extra = [T.StructField("_deleted", T.BooleanType()), T.StructField("bucket", T.IntegerType())]

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: list[str],
        buckets: int = BUCKETS,
        by: list[str] | None = None,
    ) -> None:
        self.keys, self.buckets, self.by = keys, buckets, by or keys
        super().__init__(spark, path, schema)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int").alias("bucket")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """Buckets that ``rows`` fall into, ``buckets`` numbers at most."""
        return sorted(r.bucket for r in rows.select(self._bucket()).distinct().collect())

    def current(self, before: tuple[str, int] | None = None, among: list[int] | None = None) -> DataFrame:
        """Rows of the newest partition of every bucket, or of those ``among``."""
        rows = self.stored()
        if before is not None:
            run, epoch = F.lit(before[0]), F.lit(before[1])
            rows = rows.where((F.col("run") < run) | ((F.col("run") == run) & (F.col("epoch") < epoch)))
        if among is not None:
            rows = rows.where(F.col("bucket").isin(among))
        newest = rows.groupBy("bucket").agg(F.max(F.struct("run", "epoch")).alias("at"))
        # one row per bucket, a number that never grows
        newest = F.broadcast(newest.select("bucket", "at.run", "at.epoch"))
        alive = rows.join(newest, ["bucket", "run", "epoch"]).where(~F.col("_deleted"))
        return alive.select(*self.schema.fieldNames())

    def read(self) -> DataFrame:
        return self.current()

    def of(self, rows: DataFrame, run: str = _GIVEN, epoch: int = 0) -> DataFrame:
        """What was stored before this batch in the buckets that its ``rows`` fall into."""
        return self.current((run, epoch), self.buckets_of(rows))

    def write(self, rows: DataFrame, run: str = _GIVEN, epoch: int = 0, deleted: DataFrame | None = None) -> None:
        """Rewrite the buckets of changed rows (one per key) and of the keys to end."""
        changed = rows.select(*self.schema.fieldNames()).withColumn("_deleted", F.lit(False))
        if deleted is not None:
            gone = deleted.select(*self.keys).distinct().withColumn("_deleted", F.lit(True))
            changed = changed.unionByName(gone, allowMissingColumns=True)
        changed = stage(changed, "changed")
        kept = self.without(self.of(changed, run, epoch), changed)
        self._put(changed.unionByName(kept.withColumn("_deleted", F.lit(False))), run, epoch)

    def without(self, stored: DataFrame, touched: DataFrame) -> DataFrame:
        """Rows of ``stored`` whose keys are not among ``touched``."""
        same = F.lit(True)
        for key in self.keys:
            same &= F.col(f"s.{key}").eqNullSafe(F.col(f"c.{key}"))
        return stored.alias("s").join(touched.select(*self.keys).alias("c"), same, "left_anti")

    def replace(self, rows: DataFrame, run: str, epoch: int, deleted: DataFrame) -> None:
        """Write buckets whose rows are all given; whichever loses its last row has a key among ``deleted``."""
        gone = deleted.select(*self.keys).withColumn("_deleted", F.lit(True))
        whole = rows.select(*self.schema.fieldNames()).withColumn("_deleted", F.lit(False))
        self._put(whole.unionByName(gone, allowMissingColumns=True), run, epoch)

    def _put(self, whole: DataFrame, run: str, epoch: int) -> None:
        # a bucket's rows together, and split where they are many
        dealt = whole.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(self._partition(run, epoch))

    def compact_to(self, path: str, keep: Column | None = None, buckets: int | None = None) -> BucketTable:
        """The current rows as a new table.

        ``keep`` leaves out what has expired; ``buckets`` suits a table that has grown.
        """
        rows = self.read() if keep is None else self.read().where(keep)
        table = BucketTable(self.spark, path, self.schema, self.keys, buckets or self.buckets, self.by)
        table.write(rows)
        return table
