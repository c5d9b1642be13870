"""Near-duplicate documents by SuperMinHash signatures, bands, verification and union-find.

1. *Signature.* Every shingle draws a random permutation of the ``REGISTERS`` registers and
   one random fraction per step: in step j it offers j + fraction to the j-th register of
   its permutation, and every register keeps its least offer. All shingles of a block of
   texts take a step together; as later offers are larger, a text stops as soon as all its
   registers are filled, which for an ordinary text is after a few steps. Only texts that go
   on hold permutations. Two sets agree in a register with the probability of their
   similarity, with less variance than by independent hashes.
2. *Classes.* Documents with equal sets (number and two 64-bit sums) are one class, and its
   first row stands for it, so copies cost nothing further.
3. *Bands.* ``ROWS`` registers make a band, ``BANDS`` bands a signature. Two sets that are
   85 % alike share no band once in ten million. In every band each class is compared with
   the least of its bucket, which by the order of a hash is mostly the same one for all its
   bands.
4. *The rest, exactly.* Buckets whose classes are then still in several components go on,
   each bucket of the same classes once, without the class that was compared with all.
   Every class outside the bucket's largest component is compared with all others of the
   bucket, in pieces of ``PIECE`` members and ``ASKING`` questions. So every pair that shares
   a bucket is linked, or already connected, or was compared.
5. *Verification.* A comparison looks at the signatures first (one byte per register). Only
   where at least ``SCREEN`` of similarity is seen, six deviations below the least share, the
   full sets are intersected; this decides.
6. *Groups.* Links are merged within tasks by union-find, across tasks by rounds of stars.

Defined cases: texts that are null or without words have the empty set and no links; with
fewer words than a shingle the whole sequence is one; a row with a null id gets its size,
takes no part and has neither component nor mark; of rows that repeat an id each has the
component of its own text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestrata.llm.components import components
from homestrata.llm.rolling import blocks, mix, shingles
from homestrata.sources.staging import stage

ROWS, BANDS = 5, 28
REGISTERS = ROWS * BANDS
SCREEN = 0.65
PIECE = 256
ASKING = 1024
FOREST = 500_000
_SALT = np.uint64(0x2545F4914F6CDD1D)
_STEPS = np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sets_of(data: np.ndarray, starts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a block, ordered by text, then hash, and where each text's begin."""
    tokens, owner = shingles(data, starts, words)
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    return tokens[new], np.searchsorted(owner[new], np.arange(len(starts)))


def signatures_of(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``REGISTERS`` numbers per set: the step in the upper 32 bits, the fraction below."""
    n, registers = len(offsets) - 1, REGISTERS
    owner = np.repeat(np.arange(n), np.diff(offsets))
    held = np.full(n * registers, _EMPTY)
    permutation = None
    for step in range(registers):
        drawn = mix(tokens + _STEPS[step])
        place = step + ((drawn & _LOW) * np.uint64(registers - step) >> np.uint64(32)).astype(np.int64)
        if permutation is None:
            register = place
        else:
            row = np.arange(len(tokens))
            register = permutation[row, place].astype(np.int64)
            permutation[row, place] = permutation[:, step]
        np.minimum.at(held, owner * registers + register, np.uint64(step) << np.uint64(32) | drawn >> np.uint64(32))
        goes_on = (held.reshape(n, registers) == _EMPTY).any(axis=1)[owner]
        if not goes_on.any():
            break
        if permutation is None:
            # the first step swapped register 0 into the place that was drawn
            permutation = np.tile(np.arange(registers, dtype=np.uint16), (int(goes_on.sum()), 1))
            permutation[np.arange(len(permutation)), place[goes_on]] = 0
            tokens, owner = tokens[goes_on], owner[goes_on]
        elif 2 * goes_on.sum() < len(tokens):
            permutation, tokens, owner = permutation[goes_on], tokens[goes_on], owner[goes_on]
    return held.reshape(n, registers)


def _bands(signature: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every band."""
    cut = mix(signature).reshape(len(signature), BANDS, ROWS)
    out = np.zeros(cut.shape[:2], np.uint64)
    for k in range(ROWS):
        out = mix(out + cut[:, :, k])
    return mix(out + np.arange(BANDS, dtype=np.uint64))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def signed(docs: DataFrame, words: int) -> DataFrame:
    """(id, n, h1, h2, bands, look, packed) of documents (id, text); ``look`` has one byte per
    register, ``packed`` is the compressed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        names = ["id", "n", "h1", "h2", "bands", "look", "packed"]
        for batch in batches:
            at = 0
            for held, data, starts in blocks(range(batch.num_rows), batch.column(1).to_pylist()):
                tokens, offsets = sets_of(data, starts, words)
                signature = signatures_of(tokens, offsets)
                bands = _bands(signature).astype(np.int64)
                look = mix(signature).astype(np.uint8)
                h1, h2 = _sums(mix(tokens), offsets), _sums(mix(tokens ^ _SALT), offsets)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(held) + 1) * BANDS, pa.int32()), pa.array(bands.ravel(), pa.int64())
                )
                packed = [compress(data[s:e].tobytes()) for s, e in zip(starts, starts[1:])]
                columns = [batch.column(0).slice(at, len(held)), pa.array(np.diff(offsets), pa.int64())]
                columns += [pa.array(x.astype(np.int64), pa.int64()) for x in (h1, h2)]
                columns += [lists, pa.array([x.tobytes() for x in look], pa.binary()), pa.array(packed, pa.binary())]
                yield pa.record_batch(columns, names=names)
                at += len(held)

    schema = "id bigint, n bigint, h1 bigint, h2 bigint, bands array<bigint>, look binary, packed binary"
    return docs.mapInArrow(run, schema)


class UnionFind:
    """Disjoint sets of numbers; the least number of a set is its root."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.parent
        top = x
        while (above := up.setdefault(top, top)) != top:
            top = above
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


class _Texts:
    """Sets of packed texts, made when first asked for."""

    def __init__(self, words: int) -> None:
        self.words, self.expand = words, zstandard.ZstdDecompressor().decompress

    def set_of(self, packed: bytes) -> np.ndarray:
        data = np.frombuffer(self.expand(packed), np.uint8)
        return sets_of(data, np.array([0, len(data)]), self.words)[0]


def linked(a: np.ndarray, b: np.ndarray, share: tuple[int, int]) -> bool:
    """Whether two sorted sets are alike enough."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return share[1] * both >= share[0] * (len(a) + len(b) - both)


def verified(rows: DataFrame, words: int, share: tuple[int, int], parts: int) -> DataFrame:
    """(a, b) links from rows (piece, asks, node, group, look, packed).

    A piece's members come before those that ask. What the piece has connected so far is kept
    by union-find, so members of a group that the asking row is connected with are passed
    over, the likeliest are looked at first, and a piece gives fewer links than it has rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _Texts(words)
        now, members, looks, sets, joined = None, [], None, {}, UnionFind()
        for batch in batches:
            a, b = [], []
            for piece, asks, node, group, look, packed in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if piece != now:
                    now, members, looks, sets, joined = piece, [], None, {}, UnionFind()
                if not asks:
                    members.append((node, group, look, packed))
                    continue
                if not members:
                    continue
                if looks is None:
                    looks = np.frombuffer(b"".join(m[2] for m in members), np.uint8).reshape(len(members), REGISTERS)
                alike = (looks == np.frombuffer(look, np.uint8)).sum(axis=1)
                own, near = None, np.flatnonzero(alike >= SCREEN * REGISTERS)
                for k in near[np.argsort(-alike[near], kind="stable")].tolist():
                    other, of, _, kept = members[k]
                    if joined.root(of) == joined.root(group):
                        continue
                    if own is None:
                        own = texts.set_of(packed)
                    if k not in sets:
                        sets[k] = texts.set_of(kept)
                    if linked(own, sets[k], share):
                        joined.join(of, group)
                        a.append(node)
                        b.append(other)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    dealt = rows.select("piece", "asks", "node", "group", "look", "packed").repartition(parts, "piece")
    return dealt.sortWithinPartitions("piece", "asks", "node").mapInArrow(run, "a bigint, b bigint")


def forest(links: DataFrame) -> DataFrame:
    """(a, b): as few links per task as keep what the task's links connect.

    A task holds at most ``FOREST`` nodes at once and then starts anew, which leaves some
    links more and no connection less.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = UnionFind()

        def out() -> pa.RecordBatch:
            pairs = [(x, sets.root(x)) for x in list(sets.parent) if sets.root(x) != x]
            columns = zip(*pairs) if pairs else ([], [])
            return pa.record_batch([pa.array(list(c), pa.int64()) for c in columns], names=["a", "b"])

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sets.join(x, y)
            if len(sets.parent) > FOREST:
                yield out()
                sets = UnionFind()
        yield out()

    return links.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def _with_texts(rows: DataFrame, reps: DataFrame) -> DataFrame:
    # always by sort and merge: neither side's size is bounded, whatever it is estimated to be
    return rows.join(reps.select("node", "look", "packed").hint("merge"), "node")


def _order(node: str) -> Column:
    """A fixed order of nodes that has nothing to do with their numbers."""
    return F.struct(F.xxhash64(F.lit(7), F.col(node)).alias("o"), F.col(node).alias("node"))


def _asked_first(in_bands: DataFrame, reps: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows for ``verified``: every class and the first ones of its buckets."""
    asked = in_bands.join(firsts.where("held > 1").select("band", "first"), "band").where("node <> first")
    asked = stage(asked.select("node", "first").distinct(), "first-questions")
    cuts = stage(asked.groupBy("first").agg(F.ceil(F.count("*") / F.lit(ASKING)).cast("bigint").alias("cuts")), "first-cuts")
    cut = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cuts") - 1))
    members = cuts.select(F.col("first"), cut.alias("cut"), F.lit(False).alias("asks"), F.col("first").alias("node"))
    asking = asked.join(cuts, "first").select(
        "first", F.pmod(F.xxhash64("node"), F.col("cuts")).alias("cut"), F.lit(True).alias("asks"), "node"
    )
    rows = members.unionByName(asking).select(
        F.xxhash64("first", "cut").alias("piece"), "asks", "node", F.col("node").alias("group")
    )
    return _with_texts(rows, reps)


def _asked_rest(in_bands: DataFrame, reps: DataFrame, firsts: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows for ``verified``: buckets that still hold several components, without their first."""
    many = in_bands.join(firsts.where("held > 2").select("band", "first"), "band").where("node <> first")
    many = many.join(groups, "node", "left").select("band", "node", F.coalesce("group", "node").alias("group"))
    of_group = many.groupBy("band", "group").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark")
    )
    open_bands = of_group.groupBy("band").agg(
        F.count("*").alias("groups"),
        F.sum("n").alias("n"),
        F.sum("mark").alias("mark"),
        F.max_by("group", F.struct("n", "group")).alias("largest"),
    )
    # buckets of the same classes are one
    alone = open_bands.where("groups > 1").groupBy("n", "mark").agg(F.min_by(F.struct("band", "largest"), "band").alias("x"))
    alone = stage(alone.select("x.band", "x.largest", F.ceil(F.col("n") / PIECE).alias("pieces")), "open-buckets")
    inside = stage(many.join(alone, "band"), "open-members")
    piece = F.pmod(F.xxhash64("node"), F.col("pieces"))
    asking = inside.where("group <> largest").select(
        "band", "node", "group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)).alias("part")
    )
    members = inside.select("band", "node", "group", piece.alias("part"))
    per = asking.groupBy("band", "part").agg(F.ceil(F.count("*") / F.lit(ASKING)).cast("bigint").alias("cuts"))
    cuts = stage(per, "open-cuts")
    cut = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cuts") - 1)).alias("cut")
    members = members.join(cuts, ["band", "part"]).select("band", "part", cut, F.lit(False).alias("asks"), "node", "group")
    asking = asking.join(cuts, ["band", "part"]).select(
        "band", "part", F.pmod(F.xxhash64("node"), F.col("cuts")).alias("cut"), F.lit(True).alias("asks"), "node", "group"
    )
    rows = members.unionByName(asking).select(F.xxhash64("band", "part", "cut").alias("piece"), "asks", "node", "group")
    return _with_texts(rows, reps)


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, share: tuple[int, int] = (85, 100)
) -> DataFrame:
    """(id, n_shingles, component, kept) per row of ``docs``; ``share`` is the least similarity.

    The bands are laid out for shares from 0.8 on.
    """
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = stage(signed(texts, words).withColumn("row", F.monotonically_increasing_id()), "signed")

    # classes of equal sets, each held by its first row
    known = rows.where("id IS NOT NULL AND n > 0")
    classes = known.groupBy("h1", "h2", "n").agg(F.min("row").alias("node"), F.min("id").alias("least"))
    classes = stage(classes, "classes")
    held = classes.select(F.col("node").alias("row"))
    reps = rows.select("row", "bands", "look", "packed").join(held, "row").withColumnRenamed("row", "node")
    reps = stage(reps, "representatives")
    in_bands = stage(reps.select("node", F.explode("bands").alias("band")), "bands")

    firsts = in_bands.groupBy("band").agg(F.count("*").alias("held"), F.min(_order("node")).alias("f"))
    firsts = stage(firsts.where("held > 1").select("band", "held", F.col("f.node").alias("first")), "firsts")
    links = stage(forest(verified(_asked_first(in_bands, reps, firsts), words, share, parts)), "first-links")
    groups = components(links).select("node", F.col("component").alias("group"))
    rest = stage(forest(verified(_asked_rest(in_bands, reps, firsts, groups), words, share, parts)), "rest-links")
    reached = components(links.unionByName(rest))

    of_class = classes.join(reached, "node", "left").select("h1", "h2", "n", "least", F.coalesce("component", "node").alias("c"))
    of_class = stage(of_class, "class-components")
    least = stage(of_class.groupBy("c").agg(F.min("least").alias("component")), "least-ids")
    named = stage(of_class.join(least, "c").select("h1", "h2", "n", "component"), "named-classes")
    found = rows.select("id", "n", "h1", "h2").join(named, ["h1", "h2", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return found.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component"),
        (F.col("id") == component).alias("kept"),
    )
