"""Importance resampling towards a target: documents drawn by hashed n-gram weights.

1. A text's separators collapse to single spaces. For every length up to ``n`` one pattern
   with boundary look-arounds is scanned with overlapping matches, so each match is the
   span of one n-gram; the CRC of its bytes gives the bucket. The buckets of every text are
   written once, in the fewest bytes that hold them.
2. Bucket counts of corpus and target are summed in a tree of tasks: two arrays of
   ``buckets`` numbers, whatever the corpus.
3. A text's weight is the sum of its buckets' gains; with a Gumbel number from the id's hash
   added, the highest scores are a draw without replacement in proportion to exp(weight).
4. Ranks come from sorted ranges and the counts of those before each, so no task holds more
   than one range.

Defined cases: a null text has no features; a row with a null id is drawn like others, its
hash that of an empty id, after all others in a tie; rows that repeat an id are rows of
their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homestrata.llm.sums import sum_over
from homestrata.sources.staging import stage

BUCKETS = 10_000
SCALE = 1000
_SPACE = ord(" ")
# digits, letters and what is not ASCII make words; A-Z are lower-cased
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else _SPACE for b in range(256)
)


def spans_of(n: int) -> regex.Pattern:
    """All runs of ``n`` words of a text whose words one space parts, when matches overlap."""
    return regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (n - 1))


def collapsed(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split())


def buckets_of(line: bytes, patterns: list[regex.Pattern], buckets: int) -> list[int]:
    """The bucket of every n-gram, from its span."""
    crc = zlib.crc32
    return [crc(line[m.start() : m.end()]) % buckets for p in patterns for m in p.finditer(line, overlapped=True)]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, buckets) per row: little-endian unsigned integers of 16 bits, or of 32
    where there are more buckets than that."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [spans_of(k) for k in range(1, n + 1)]
        for batch in batches:
            words, found = [], []
            for text in batch.column(1):
                line = collapsed(text.as_py())
                words.append(line.count(b" ") + 1 if line else 0)
                found.append(np.array(buckets_of(line, patterns, buckets), kind).tobytes())
            columns = [batch.column(0), pa.array(words, pa.int64()), pa.array(found, pa.binary())]
            yield pa.record_batch(columns, names=["id", "n_words", "buckets"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id bigint, n_words bigint, buckets binary")


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    kind = _kind(buckets)

    def add(total: np.ndarray, values: list) -> None:
        total += np.bincount(np.frombuffer(b"".join(values), kind), minlength=buckets)

    return sum_over(found.select("buckets"), (buckets,), np.int64, add)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled logarithm of target over corpus share per bucket, one added to every count."""
    size, all_s, all_t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(SCALE * math.log(float(t + 1) * float(all_s + size) / (float(s + 1) * float(all_t + size))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight)."""
    kind = _kind(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(raw, kind) for raw in batch.column(2).to_pylist()]
            sizes = pa.array([len(x) for x in lists], pa.int64())
            sums = pa.array([int(gain[x].sum()) for x in lists], pa.int64())
            columns = [batch.column(0), batch.column(1), sizes, sums]
            yield pa.record_batch(columns, names=["id", "n_words", "n_features", "weight"])

    rows = found.select("id", "n_words", "buckets")
    return rows.mapInArrow(run, "id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(key: Column, seed: int) -> Column:
    """A scaled Gumbel number from the first 32 bits of the hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    share = (bits.cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log(share))).cast("bigint")


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``place`` from 1 on in the order given, without one task for all.

    Ranges are sorted where they lie; a row's place in its range comes with the write, and
    one count per range says where the range begins.
    """
    lying = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    held = stage(lying.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = held.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # as many rows as there are ranges
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    joined = held.withColumn("_part", part).join(starts, "_part")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_start") + inside + 1).alias("place"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 1,
    buckets: int = BUCKETS,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) per row of ``docs``.

    Of the documents with at least ``least_words`` words the ``percent`` with the highest
    scores are drawn and ranked, ties to the smaller id; ``rank`` is null for all others.
    ``target`` has texts in ``text_col``.
    """
    found = stage(features(docs, id_col, text_col, n, buckets), "features")
    wanted = features(target.select(F.lit(None).cast("bigint").alias("id"), F.col(text_col).alias("text")), "id", "text", n, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))
    scored = weights(found, gain).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    scored = stage(scored, "scored")
    may = scored.where(F.col("n_words") >= least_words)
    drawn = may.count() * percent // 100
    order = F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("weight")
    placed = ranked(may, *order)
    placed = placed.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("place")
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return placed.unionByName(rest).withColumnRenamed("id", id_col)
