"""Exact top-k by inner product with MaxScore, shard by shard.

Vectors of integers are documents whose terms are their dimensions. Candidates are dealt
into shards by a hash of their id; a shard keeps one posting column per dimension with its
largest and smallest value. For a query these bound what each dimension can add above the
least it must add. Dimensions are taken by falling bound: as long as a candidate with the
least values in those read so far could still reach the query's k-th best score, the next
dimension is essential and its postings are traversed for all candidates; the others are
probed only for candidates whose bound is still competitive. A shard's first candidates
are scored in full to start the threshold. Shards' results are merged by score.

Queries meet shards in blocks: block rows are copied once per shard and joined on the
shard, so a task holds one shard and one block whatever the tables' sizes. The merge
keeps k rows per query and task before its exchange.

Defined cases: vectors that are null or hold a null or a non-finite component, and rows
with a null id, take no part; missing trailing components count as zero; rows that repeat
an id are all candidates but never for a query of that id; equal scores go to the smaller
id; with fewer than k candidates all are returned; empty tables give no rows; scores must
fit 64 bits; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homestrata.sources.staging import stage

SHARD_ROWS = 8192
BLOCK_ROWS = 1024
FIRST_ROWS = 512
STEP = 8  # dimensions probed between two looks at who is still competitive


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, scale: float = 64.0) -> DataFrame:
    """(id, v): floor(scale * x) of the vectors that take part."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(math.inf)))
    return table.where(F.col(id_col).isNotNull() & v.isNotNull() & ~bad).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("bigint")).alias("v"),
    )


def _pack(rows: DataFrame, group: str, parts: int) -> DataFrame:
    """One row per group: ids and the matrix (one row per vector) as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, held = None, [], []

        def close() -> pa.RecordBatch:
            dims = max(map(len, held))
            matrix = np.zeros((len(held), dims), "<i8")
            for i, v in enumerate(held):
                matrix[i, : len(v)] = v
            columns = [pa.array([now], pa.int64()), pa.array([dims], pa.int64())]
            columns += [pa.array([x.tobytes()], pa.binary()) for x in (np.array(ids, "<i8"), matrix)]
            return pa.record_batch(columns, names=[group, "dims", "ids", "matrix"])

        for batch in batches:
            for g, key, v in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if g != now and held:
                    yield close()
                    ids, held = [], []
                now = g
                ids.append(key)
                held.append(v)
        if held:
            yield close()

    dealt = rows.select(F.col(group).cast("bigint").alias(group), "id", "v")
    dealt = dealt.repartition(parts, group).sortWithinPartitions(group, "id")
    return dealt.mapInArrow(run, f"{group} bigint, dims bigint, ids binary, matrix binary")


def _matrix(raw: bytes, dims: int, rows: int) -> np.ndarray:
    return np.frombuffer(raw, "<i8").reshape(rows, dims)


def search_shard(
    q_ids: np.ndarray, queries: np.ndarray, c_ids: np.ndarray, candidates: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, candidate ids, scores) of each query's k best in one shard."""
    dims = max(queries.shape[1], candidates.shape[1])
    queries = np.pad(queries, ((0, 0), (0, dims - queries.shape[1])))
    candidates = np.pad(candidates, ((0, 0), (0, dims - candidates.shape[1])))
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(dims, 1)
    kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64
    postings = np.ascontiguousarray(candidates.T.astype(kind))
    if dims == 0 or not len(c_ids):
        postings = np.zeros((1, len(c_ids)), kind)
        queries = np.zeros((len(q_ids), 1), np.int64)
    top, bottom = postings.max(1, initial=0), postings.min(1, initial=0)
    for q_id, row in zip(q_ids.tolist(), queries):
        q = row.astype(kind)
        high, low = np.maximum(q * top, q * bottom), np.minimum(q * top, q * bottom)
        order = np.argsort(-(high - low), kind="stable")
        # best[j]: the most that the dimensions from the j-th on can add
        best = np.append(np.cumsum(high[order][::-1])[::-1], 0)
        first = min(len(c_ids), FIRST_ROWS)
        scores = q @ postings[:, :first]
        own = c_ids[:first] != q_id
        ids, scores = _best(c_ids[:first][own], scores[own], k)
        if first < len(c_ids):
            least = scores[-1] if len(ids) == k else -np.inf
            # essential: with the least values in the first j dimensions the rest could still reach the k-th best
            floor = np.append(0, np.cumsum(low[order]))
            essential = int(np.argmax(floor + best < least)) if (floor + best < least).any() else len(order)
            use = order[:essential]
            partial = q[use] @ postings[use, first:]
            alive = np.flatnonzero((partial + best[essential] >= least) & (c_ids[first:] != q_id))
            partial = partial[alive]
            for at in range(essential, len(order), STEP):
                use = order[at : at + STEP]
                partial = partial + q[use] @ postings[use[:, None], first + alive]
                keep = partial + best[at + len(use)] >= least
                alive, partial = alive[keep], partial[keep]
            ids, scores = _best(np.append(ids, c_ids[first:][alive]), np.append(scores, partial), k)
        yield q_id, ids, scores.astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= least
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def top_k(queries: DataFrame, candidates: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, id, score) for tables of (id, v)."""
    candidates, queries = stage(candidates, "maxscore-candidates"), stage(queries, "maxscore-queries")
    shards = max(1, math.ceil(candidates.count() / shard_rows))
    blocks = max(1, math.ceil(queries.count() / BLOCK_ROWS))
    packed = _pack(candidates.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards))), "shard", shards)
    asked = _pack(queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))), "block", blocks)
    asked = asked.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"),
        F.col("dims").alias("q_dims"),
        F.col("ids").alias("q_ids"),
        F.col("matrix").alias("q_matrix"),
    )
    pairs = packed.join(asked.hint("merge"), "shard").select("ids", "dims", "matrix", "q_ids", "q_dims", "q_matrix")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, dims, matrix, q_ids, q_dims, q_matrix = (batch.column(n)[i].as_py() for n in range(6))
                ids, q_ids = np.frombuffer(ids, "<i8"), np.frombuffer(q_ids, "<i8")
                out: list[list] = [[], [], []]
                found = search_shard(
                    q_ids, _matrix(q_matrix, q_dims, len(q_ids)), ids, _matrix(matrix, dims, len(ids)), k
                )
                for q_id, got, scores in found:
                    out[0].append(np.full(len(got), q_id))
                    out[1].append(got)
                    out[2].append(scores)
                columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in out]
                yield pa.record_batch(columns, names=["query_id", "id", "score"])

    found = pairs.mapInArrow(run, "query_id bigint, id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
