"""Exact Jaccard join on word shingles with a token-group matrix.

A document is its set of hashed word shingles (64 bits). Documents with equal sets are one
class and only the class's first document goes on.

1. Similar documents are brought together by the least hash of their sets, and each is
   compared with the first of its kind: most near copies are linked by that one comparison.
2. Two linked documents share one of their first tokens in a global order, rare ones first
   (prefix filter). Tokens that lie within one linked group only are done. Documents that
   hold others are partitioned into groups of similar ones, of about ``GROUP`` documents and
   ``GROUP_TOKENS`` tokens at most.
   A group stores the union of its members' tokens and, over it, the sparse matrix of which
   member has which; a document asks the groups with which it shares a token. The overlap with the
   union bounds that with any member, and only groups where the bound suffices are opened:
   their matrix gives all members' exact overlaps at once.
3. The links join classes into components.

No pair is formed inside a linked group, however large it is. Groups, and questions to one
group, are cut into pieces by counts, so no task holds an unbounded group; the order of
tokens comes from counts in a bounded number of buckets. Texts are kept compressed with
what is computed from them, and those of classes' first rows are shuffled, twice to meet
their questions and twice to meet their groups. Equal sets are told by their number and two
64-bit sums of hashes, shingles by 64-bit hashes.

Defined cases: texts that are null or without words have the empty set and no links; with
fewer words than a shingle the whole sequence is one; a row with a null id gets its size
and no component; of rows that repeat an id each has the component of its own text; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestrata.llm.batches import let_go
from homestrata.llm.components import components
from homestrata.llm.rolling import blocks, mix, shingles
from homestrata.llm.sums import sum_over
from homestrata.sources.staging import stage

TOKENS_PER_BUCKET = 64
LEAST_BITS, MOST_BITS = 16, 22
GROUP = 512
GROUP_TOKENS = 300_000
QUESTIONS = 1024
_SALT = np.uint64(0x5851F42D4C957F2D)


def token_counts(texts: DataFrame, words: int) -> np.ndarray:
    """How many shingles of the table fall into each bucket of hashes.

    There are about as many buckets as keep chance company small, so that a shingle of a
    few dozen texts stands out at any size, and never more than 2**MOST_BITS.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = round(math.log2(size / (6 * TOKENS_PER_BUCKET) + 1))  # a word is about six bytes
    bits = min(MOST_BITS, max(LEAST_BITS, bits))

    def add(total: np.ndarray, values: list) -> None:
        for _, data, starts in blocks(range(len(values)), values):
            tokens, _ = shingles(data, starts, words)
            np.add.at(total, tokens >> np.uint64(64 - bits), 1)

    return sum_over(texts, (1 << bits,), np.int32, add)


def _sets(data: np.ndarray, starts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, ordered by text, then hash."""
    tokens, owner = shingles(data, starts, words)
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    keep = np.ones(len(tokens), bool)
    keep[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    return tokens[keep], owner[keep]


def _group_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def signatures(docs: DataFrame, words: int, share: tuple[int, int], counts: np.ndarray) -> DataFrame:
    """(id, mark, n, h1, h2, like, prefix, packed) of documents (id, mark, text); ``packed`` is
    the text compressed for the way to its comparisons."""
    num, den = share
    shift = np.uint64(65 - len(counts).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            at = 0
            for held, data, starts in blocks(range(batch.num_rows), batch.column(2).to_pylist()):
                tokens, owner = _sets(data, starts, words)
                sizes = np.bincount(owner, minlength=len(held))
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                h1, h2 = _group_sums(mix(tokens), offsets), _group_sums(mix(tokens ^ _SALT), offsets)
                like = np.zeros(len(held), np.uint64)
                full = np.flatnonzero(sizes)
                if len(full):
                    like[full] = np.minimum.reduceat(mix(tokens + _SALT), offsets[full])
                # the first n - least overlap + 1 tokens, rare buckets first
                rare = np.lexsort((tokens, counts[tokens >> shift], owner))
                wanted = np.where(sizes > 0, sizes - -(-num * sizes // den) + 1, 0)
                rank = np.arange(len(tokens)) - offsets[owner]
                first = tokens[rare][rank < wanted[owner]].astype(np.int64)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(wanted)]), pa.int32()), pa.array(first, pa.int64())
                )
                columns = [batch.column(k).slice(at, len(held)) for k in (0, 1)] + [pa.array(sizes, pa.int64())]
                columns += [pa.array(x.astype(np.int64), pa.int64()) for x in (h1, h2, like)]
                packed = pa.array([compress(data[s:e].tobytes()) for s, e in zip(starts, starts[1:])], pa.binary())
                names = ["id", "mark", "n", "h1", "h2", "like", "prefix", "packed"]
                yield pa.record_batch([*columns, lists, packed], names=names)
                at += len(held)
        let_go()

    numbers = "id bigint, mark bigint, n bigint, h1 bigint, h2 bigint, like bigint"
    return docs.mapInArrow(run, f"{numbers}, prefix array<bigint>, packed binary")


def _linked(overlap: np.ndarray, n: int, sizes: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    return share[1] * overlap >= share[0] * (n + sizes - overlap)


class Group:
    """Members' tokens as a sparse matrix over their union: per token the members that have it."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]]) -> None:
        self.ids = np.array([m[0] for m in members], np.int64)
        self.kinds = np.array([m[1] for m in members], np.int64)
        self.sizes = np.array([len(m[2]) for m in members], np.int64)
        tokens = np.concatenate([m[2] for m in members])
        holder = np.repeat(np.arange(len(members)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.union, first = np.unique(tokens[order], return_index=True)
        self.holders, self.first = holder[order].astype(np.int32), np.append(first, len(tokens))

    def ask(self, tokens: np.ndarray, share: tuple[int, int]) -> np.ndarray:
        """Indices of the members that ``tokens`` links with."""
        if not len(tokens) or not len(self.union):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        shared = at[self.union[at] == tokens]
        if share[1] * len(shared) < share[0] * len(tokens):  # no member can overlap enough
            return np.zeros(0, np.int64)
        start, count = self.first[shared], self.first[shared + 1] - self.first[shared]
        rows = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())
        overlap = np.bincount(self.holders[rows], minlength=len(self.ids))
        return np.flatnonzero(_linked(overlap, len(tokens), self.sizes, share))


def _compare(rows: DataFrame, words: int, share: tuple[int, int], parts: int) -> DataFrame:
    """(a, b, kind_a, kind_b) links from rows (piece, asks, id, kind, packed).

    A piece's members come before those that ask it; of members of one kind the first that
    is linked stands for all, as they are linked already.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        now, members, group = None, [], None
        for batch in batches:
            pieces, asks, ids, kinds, packed = (batch.column(k).to_pylist() for k in range(5))
            out: list[list[int]] = [[], [], [], []]
            at = 0
            for held, data, starts in blocks(range(len(ids)), map(lambda p: expand(p).decode("utf-8", "surrogatepass"), packed)):
                tokens, owner = _sets(data, starts, words)
                offsets = np.searchsorted(owner, np.arange(len(held) + 1))
                for k in range(len(held)):
                    i, own = at + k, tokens[offsets[k] : offsets[k + 1]]
                    if pieces[i] != now:
                        now, members, group = pieces[i], [], None
                    if not asks[i]:
                        members.append((ids[i], kinds[i], own))
                        continue
                    if group is None:
                        group = Group(members) if members else False
                    if group is False:
                        continue
                    seen = set()
                    for m in group.ask(own, share).tolist():
                        kind = int(group.kinds[m])
                        if kind != kinds[i] and kind not in seen:
                            seen.add(kind)
                            for column, value in zip(out, (ids[i], int(group.ids[m]), kinds[i], kind)):
                                column.append(value)
                at += len(held)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in out], names=["a", "b", "kind_a", "kind_b"])
        group, members = None, []
        let_go()

    dealt = rows.select("piece", "asks", "id", "kind", "packed").repartition(parts, "piece")
    dealt = dealt.sortWithinPartitions("piece", "asks", "id")
    return dealt.mapInArrow(run, "a bigint, b bigint, kind_a bigint, kind_b bigint")


def _pieces(needed: DataFrame, asked: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows for ``_compare``: members (piece_of, id, kind) repeated for every cut of the
    questions (piece_of, id, kind) to them, with their texts."""
    cuts = stage(
        asked.groupBy("piece_of").agg(F.ceil(F.count("*") / F.lit(QUESTIONS)).cast("int").alias("cuts")), "cuts"
    )
    cut = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    members = needed.join(cuts, "piece_of").select("piece_of", "id", "kind", cut.alias("cut"), F.lit(False).alias("asks"))
    salt = F.pmod(F.xxhash64("id"), F.col("cuts").cast("bigint")).cast("int")
    asking = asked.join(cuts, "piece_of").select("piece_of", "id", "kind", salt.alias("cut"), F.lit(True).alias("asks"))
    rows = stage(members.unionByName(asking), "questions")
    # always by sort and merge: neither side's size is bounded, whatever it is estimated to be
    return rows.join(texts.hint("merge"), "id").select(
        F.xxhash64("piece_of", "cut").alias("piece"), "asks", "id", "kind", "packed"
    )


def join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, share: tuple[int, int] = (90, 100)
) -> DataFrame:
    """(id, n_shingles, component, text_hash) per row of ``docs``; ``share`` is the least similarity.

    ``text_hash`` is the hash of the row's text by ``xxhash64``, to find the row again where
    an id is repeated.
    """
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    counts = token_counts(texts.select("text"), words)
    # rows are told apart by a number of their own, as ids may repeat with other texts
    numbered = signatures(texts, words, share, counts).withColumn("row", F.monotonically_increasing_id())
    signed = stage(numbered, "signatures")
    known = signed.where("id IS NOT NULL AND n > 0")

    # classes of equal sets, each held by its first row
    classes = known.groupBy("h1", "h2", "n").agg(F.min("row").alias("rep"), F.min("id").alias("least"))
    classes = stage(classes, "classes")
    reps = known.select(F.col("row").alias("id"), "n", "like", "prefix", "packed")
    reps = stage(reps.join(classes.select(F.col("rep").alias("id")), "id"), "representatives")
    packed = reps.select("id", "packed")

    # 1: each against the first of its kind
    kinds = reps.groupBy("like").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub <> last")
    kinds = stage(kinds.select("like", "hub"), "kinds")
    asked = reps.join(kinds, "like").where("id <> hub").select(F.col("hub").alias("piece_of"), "id", F.col("id").alias("kind"))
    hubs = kinds.select("hub").distinct().select(F.col("hub").alias("piece_of"), F.col("hub").alias("id"), F.col("hub").alias("kind"))
    links = stage(_compare(_pieces(hubs, asked, packed), words, share, parts), "hub-links")
    near = links.select(F.col("a").alias("id"), F.col("b").alias("star")).distinct()
    starred = reps.join(near.groupBy("id").agg(F.min("star").alias("star")), "id", "left").join(kinds, "like", "left")
    starred = starred.select("id", "n", "prefix", F.coalesce("star", "id").alias("kind"), "hub")

    # 2: tokens that reach across kinds, and the groups that hold them
    tokens = starred.select("id", "n", "kind", "hub", F.explode("prefix").alias("token"))
    open_tokens = tokens.groupBy("token").agg(F.min("kind").alias("k0"), F.max("kind").alias("k1")).where("k0 <> k1")
    open_tokens = stage(open_tokens.select("token"), "open-tokens")
    rows = stage(tokens.join(open_tokens.hint("merge"), "token"), "open-rows")
    lone = F.xxhash64(F.lit(2), F.min("token"), _band(share))
    keyed = rows.groupBy("id", "n", "kind", "hub").agg(
        F.when(F.col("hub").isNotNull(), F.xxhash64(F.lit(1), "hub")).otherwise(lone).alias("key")
    )
    keyed = stage(keyed.select("id", "n", "kind", "key"), "keyed")
    chunks = F.greatest(F.count("*") / F.lit(GROUP), F.sum("n") / F.lit(GROUP_TOKENS))
    per_key = keyed.groupBy("key").agg(F.ceil(chunks).cast("bigint").alias("chunks"))
    placed = stage(
        keyed.join(per_key, "key").select(
            "id", "n", "kind", F.xxhash64("key", F.pmod(F.xxhash64("id"), F.col("chunks"))).alias("piece_of")
        ),
        "groups",
    )
    ranges = placed.groupBy("piece_of").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("kind").alias("k0"), F.max("kind").alias("k1")
    )
    in_group = rows.select("id", "n", "kind", "token").join(placed.select("id", F.col("piece_of").alias("own")), "id")
    matrix = in_group.select("token", F.col("own").alias("piece_of")).distinct()
    matrix = stage(matrix.join(ranges, "piece_of"), "token-groups")
    num, den = share
    fits = (F.col("n") * num <= F.col("most") * den) & (F.col("least") * num <= F.col("n") * den)
    # of two groups one asks the other; a group of one kind is not asked by its own
    turn = (F.col("own") <= F.col("piece_of")) & ((F.col("k0") != F.col("k1")) | (F.col("kind") != F.col("k0")))
    asked = in_group.join(matrix, "token").where(fits & turn).select("piece_of", "id", "kind").distinct()
    asked = stage(asked, "group-questions")
    members = placed.select("piece_of", "id", "kind")
    links = links.unionByName(_compare(_pieces(members, asked, packed), words, share, parts))

    # 3: components of classes
    reached = components(links.select("a", "b"))
    of_class = classes.join(reached, classes["rep"] == reached["node"], "left").select(
        "h1", "h2", "n", "least", F.coalesce("component", "rep").alias("c")
    )
    of_class = stage(of_class, "class-components")
    least = stage(of_class.groupBy("c").agg(F.min("least").alias("component")), "least-ids")
    named = stage(of_class.join(least, "c").select("h1", "h2", "n", "component"), "named-classes")
    found = signed.select("id", "mark", "n", "h1", "h2").join(named, ["h1", "h2", "n"], "left")
    return found.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"),
        F.col("mark").alias("text_hash"),
    )


def _band(share: tuple[int, int]) -> Column:
    """Documents of one band differ in size by less than what two linked ones may."""
    return F.floor(F.log("n") / F.lit(math.log(share[1] / share[0]) if share[0] < share[1] else 1.0))
