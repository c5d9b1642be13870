"""Removal of repeated byte strings with common-prefix interval trees over suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with
a smaller id. Matches never cross documents.

*Which suffixes.* Every string of ``LENGTH`` bytes holds an anchor: the ``GRAM`` bytes in
it with the least hash. Equal strings have equal anchors, so only suffixes that start at
anchors are sorted, about one byte in fourteen, each with the ``LEFT`` bytes before it.

*Which anchors.* Documents are dealt into groups by a hash of their id. A group sends the
shortened hashes of its anchors, sorted and as differences, to where ranges of hashes
meet; those found in two documents or more are sent back.

*Enhanced suffix arrays.* Only anchors found elsewhere send their bytes. Where the same
anchors meet, their suffixes are sorted and the lengths of the prefixes neighbours share
are scanned with a stack into the tree of common-prefix intervals. An interval of length p
holds all suffixes that share p bytes. Its members are told apart by what stands on their
left: those that agree on the LENGTH - p bytes before the anchor, and no longer on the one
before that, are one maximal repeat with all its occurrences (``maximal_repeats``). A
member is covered where its group has one in a smaller document.

*Sizes.* A group of documents sends one suffix per text around an anchor, that of its
smallest document; the others are covered by it. An anchor that is common in a group
(``COMMON``) sends the strings around it apart, each keyed by itself, so a passage in a
third of all documents does not meet in one place. Compressed texts are shuffled three
times, to find anchors, to send suffixes, and to be cut; suffixes once.

Defined cases: null texts count as empty; texts shorter than LENGTH keep all; rows with a
null id are compared with nothing and keep all; rows that repeat an id are never smaller
than each other; ties do not occur otherwise; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestrata.llm.batches import let_go
from homestrata.llm.rolling import BLOCK_BYTES, Prefix, mix, slide
from homestrata.sources.staging import stage

LENGTH = 50
GRAM = 24
LEFT = LENGTH - GRAM
COMMON = 64
GROUP_BYTES = 24 << 20  # of text that one group of documents holds, about
BUCKET_BYTES = 6 << 20  # of text whose anchors meet in one bucket, about
_CONTEXT = LEFT + LENGTH
_BLOB = "tag bigint, bucket bigint, kind int, blob binary"
_NAMES = ["tag", "bucket", "kind", "blob"]
_PLACE = np.dtype([("row", "<u4"), ("pos", "<u4"), ("mask", "<u4")])
_SUFFIX = np.dtype(
    [("key", "<u8"), ("id", "<i8"), ("row", "<u4"), ("pos", "<u4"), ("left", "u1"), ("right", "u1"), ("bytes", "u1", _CONTEXT)]
)


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _expand(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _blobs(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    columns = zip(*rows) if rows else [[]] * 4
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=_NAMES)


def anchors(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all strings of LENGTH bytes in the texts."""
    hashes = Prefix(data).every(GRAM)
    width = LENGTH - GRAM + 1
    if len(hashes) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = slide(hashes, width, np.minimum)
    # strings that reach into the next text have no anchor
    edge = np.zeros(len(data) + 1, np.int64)
    edge[starts[1:-1]] = 1
    inner = np.cumsum(edge)
    least = np.where(inner[: len(least)] == inner[LENGTH - 1 : LENGTH - 1 + len(least)], least, np.uint64(0))
    around = np.zeros(width - 1, np.uint64)
    top = slide(np.concatenate([around, least, around]), width, np.maximum)
    at = np.flatnonzero((top == hashes) & (top > 0))
    return at, hashes[at]


def lcp_intervals(lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(low, high, length, outer length) of the common-prefix intervals of at least ``least``.

    ``lcp[i]`` is the length shared by suffixes i-1 and i; intervals are high-exclusive.
    """
    low, high, length, outer = [], [], [], []
    stack: list[tuple[int, int]] = []  # (length, low) of the open intervals, growing
    for i, shared in enumerate([*lcp.tolist()[1:], 0], 1):
        begin = i - 1
        while stack and stack[-1][0] > shared:
            size, begin = stack.pop()
            low.append(begin)
            high.append(i)
            length.append(size)
            outer.append(max(stack[-1][0] if stack else 0, shared))
        if shared >= least and (not stack or stack[-1][0] < shared):
            stack.append((shared, begin))
    return tuple(np.array(x, np.int64) for x in (low, high, length, outer))


def _words(rows: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as big-endian integers, to sort by."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return list(padded.view(">u8").astype(np.uint64).T)


def _shared(rows: np.ndarray) -> np.ndarray:
    """How many bytes each row shares with the one before."""
    out = np.zeros(len(rows), np.int64)
    for at in range(1, len(rows), 1 << 18):
        end = min(at + (1 << 18), len(rows))
        differ = rows[at:end] != rows[at - 1 : end - 1]
        out[at:end] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def repeat_groups(suffixes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(o, members, group) for o = 0..LEFT: suffixes whose LENGTH bytes from o bytes before
    the anchor on are equal, by group; groups of one are left out."""
    n = len(suffixes)
    right, left = suffixes["bytes"][:, LEFT:], suffixes["bytes"][:, LEFT - 1 :: -1]
    order = np.lexsort([*_words(right)[::-1], suffixes["key"]])
    key = suffixes["key"][order]
    lcp = _shared(right[order])
    lcp[1:][key[1:] != key[:-1]] = 0
    low, high, length, outer = lcp_intervals(lcp, GRAM)
    backward = np.lexsort(_words(left)[::-1])
    shared_left = _shared(left[backward])
    for o in range(LEFT + 1):
        use = np.flatnonzero((length >= LENGTH - o) & (outer < LENGTH - o))
        if not len(use):
            continue
        sizes = high[use] - low[use]
        at = np.repeat(low[use] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        member, node = order[at], np.repeat(np.arange(len(use)), sizes)
        fits = (suffixes["left"][member] >= o) & (suffixes["right"][member] >= LENGTH - o)
        member, node = member[fits], node[fits]
        same_left = np.empty(n, np.int64)
        same_left[backward] = np.cumsum(shared_left < o)
        group = node * (n + 1) + same_left[member]
        by = np.argsort(group, kind="stable")
        member, group = member[by], group[by]
        new = np.append(True, group[1:] != group[:-1]) if len(group) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1 if len(group) else new
        yield o, member[many], group[many]


def maximal_repeats(suffixes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(o, members) of the groups that differ in the byte further left, or begin a text:
    the left ends of maximal repeats, each with all its occurrences."""
    for o, member, group in repeat_groups(suffixes):
        for part in np.split(member, np.flatnonzero(np.diff(group)) + 1):
            before = {(int(suffixes["left"][m]) > o, int(suffixes["bytes"][m, LEFT - o - 1]) if o < LEFT else -1) for m in part}
            if len(part) and (len(before) > 1 or not next(iter(before))[0] or o == LEFT):
                yield o, part


def covered(suffixes: np.ndarray) -> np.ndarray:
    """Bit o of each suffix: its string from o bytes before the anchor is in a smaller document."""
    mask = np.zeros(len(suffixes), np.uint32)
    for o, member, group in repeat_groups(suffixes):
        if not len(member):
            continue
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        least = np.minimum.reduceat(suffixes["id"][member], first)
        later = suffixes["id"][member] > least[np.cumsum(np.append(True, group[1:] != group[:-1])) - 1]
        np.bitwise_or.at(mask, member[later], np.uint32(1 << o))
    return mask


def _documents(texts: DataFrame, groups: int) -> DataFrame:
    """(tag, kind 1, id, blob): compressed texts with the group they are dealt to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [_squeeze((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
            kind = pa.array(np.ones(len(blobs), np.int32))
            yield pa.record_batch(
                [batch.column(0), kind, batch.column(1), pa.array(blobs, pa.binary())], names=["tag", "kind", "id", "blob"]
            )

    tag = F.coalesce(F.pmod(F.xxhash64("id"), F.lit(groups)), F.lit(0)).cast("bigint")
    return texts.select(tag.alias("tag"), "id", "text").mapInArrow(run, "tag bigint, kind int, id bigint, blob binary")


class _Group:
    """Documents of one group, streamed in blocks; ``row`` numbers them in order."""

    def __init__(self) -> None:
        self.ids: list = []
        self.parts: list[bytes] = []
        self.total, self.row = 0, 0

    def add(self, key, blob: bytes) -> bool:
        raw = _expand(blob)
        self.ids.append(key)
        self.parts.append(raw)
        self.total += len(raw)
        return self.total >= BLOCK_BYTES

    def block(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """(ids, has an id, flat bytes, starts, first row)"""
        starts = np.concatenate([[0], np.cumsum([len(p) for p in self.parts])]).astype(np.int64)
        data = np.frombuffer(b"".join(self.parts), np.uint8)
        known = np.array([i is not None for i in self.ids], bool)
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        first = self.row
        self.row += len(self.ids)
        self.ids, self.parts, self.total = [], [], 0
        return ids, known, data, starts, first


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, object, bytes]]:
    for batch in batches:
        yield from zip(*(batch.column(k).to_pylist() for k in range(4)))


def _anchor_hashes(batches: Iterator[pa.RecordBatch], bits: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Per group of documents and range of hashes: sorted (hash, common, in two documents)."""
    cut = np.uint64(64 - bits)
    group, tag, held = _Group(), None, []

    def read() -> None:
        ids, known, data, starts, _ = group.block()
        at, key = anchors(data, starts)
        owner = np.searchsorted(starts, at, side="right") - 1
        use = known[owner]
        held.append((key[use] >> cut, ids[owner[use]]))

    def close() -> pa.RecordBatch:
        if group.ids:
            read()
        key, ids = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((ids, key))
        key, ids = key[order], ids[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        end = np.append(first[1:], len(key))
        two = ids[first] != ids[end - 1] if len(key) else np.zeros(0, bool)
        values = key[first] << np.uint64(2) | (end - first >= COMMON).astype(np.uint64) << np.uint64(1) | two.astype(np.uint64)
        bucket = _range_of(key[first], bits, buckets)
        return _blobs(
            [
                (tag, int(bucket[part[0]]), 0, _squeeze(np.diff(values[part], prepend=np.uint64(0)).tobytes()))
                for part in np.split(np.arange(len(values)), np.flatnonzero(np.diff(bucket)) + 1)
                if len(part)
            ]
        )

    for now, _, key, blob in _by_group(batches):
        if now != tag:
            if tag is not None:
                yield close()
                let_go()
            group, tag, held = _Group(), now, []
        if group.add(key, blob):
            read()
    if tag is not None:
        yield close()


def _range_of(key: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(max(0, bits - 30))).astype(np.int64) * buckets) >> min(bits, 30)


def _found_twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group of documents: (hash, common) of those of its hashes that others have too."""
    bucket, held = None, []

    def close() -> pa.RecordBatch:
        values = np.concatenate([v for _, v in held])
        key = values >> np.uint64(2)
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        flags = np.bitwise_or.reduceat(values[order], first) & np.uint64(3)
        count = np.diff(np.append(first, len(key)))
        again = (count > 1) | (flags & np.uint64(1) > 0)
        result = np.zeros(len(key), np.int8)  # 0 alone, 1 found twice, 2 common
        result[order] = np.repeat(np.where(again, 1 + (flags >> np.uint64(1)).astype(np.int8), 0), count)
        out, at = [], 0
        for tag, part in held:
            mine = result[at : at + len(part)]
            keep = (part >> np.uint64(2))[mine > 0] << np.uint64(1) | (mine[mine > 0] == 2).astype(np.uint64)
            at += len(part)
            if len(keep):
                out.append((tag, bucket, 0, _squeeze(np.diff(keep, prepend=np.uint64(0)).tobytes())))
        return _blobs(out)

    for tag, now, _, blob in _by_group(batches):
        if now != bucket:
            if held:
                yield close()
                let_go()
            bucket, held = now, []
        held.append((tag, np.cumsum(np.frombuffer(_expand(blob), np.uint64))))
    if held:
        yield close()


def _suffixes(batches: Iterator[pa.RecordBatch], bits: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Per group of documents: suffixes that others may have too, by bucket (kind 0), and
    places already known to be covered (kind 1)."""
    cut = np.uint64(64 - bits)
    group, tag, known_keys, held, wanted = _Group(), None, [], [], np.zeros(0, np.uint64)

    def read() -> None:
        ids, known, data, starts, row = group.block()
        at, key = anchors(data, starts)
        owner = np.searchsorted(starts, at, side="right") - 1
        short = key >> cut
        place = np.minimum(np.searchsorted(wanted, short << np.uint64(1)), max(len(wanted) - 1, 0))
        found = (wanted[place] >> np.uint64(1) == short) & known[owner] if len(wanted) else np.zeros(len(at), bool)
        common = (wanted[place[found]] & np.uint64(1)) > 0 if len(wanted) else np.zeros(0, bool)
        at, key, owner = at[found], key[found], owner[found]
        left = np.minimum(at - starts[owner], LEFT)
        right = np.minimum(starts[owner + 1] - at, LENGTH)
        padded = np.concatenate([np.zeros(LEFT, np.uint8), data, np.zeros(LENGTH, np.uint8)])
        spread = np.flatnonzero(common)
        # common anchors: each string around them stands for itself
        o = np.arange(LEFT + 1)
        mine, back = np.nonzero((left[spread][:, None] >= o) & (right[spread][:, None] >= LENGTH - o))
        begin = at[spread][mine] - back
        own = owner[spread][mine]
        once = np.unique(begin, return_index=True)[1]
        begin, own = begin[once], own[once]
        plain = ~common
        out = np.zeros(int(plain.sum()) + len(begin), _SUFFIX)
        p = int(plain.sum())
        out["key"][:p], out["key"][p:] = key[plain], mix(Prefix(data).span(begin, begin + LENGTH))
        place, who = np.concatenate([at[plain], begin]), np.concatenate([owner[plain], own])
        out["id"], out["row"], out["pos"] = ids[who], row + who, place - starts[who]
        out["left"][:p], out["right"][:p], out["right"][p:] = left[plain], right[plain], LENGTH
        around = np.lib.stride_tricks.sliding_window_view(padded, _CONTEXT)[place] if len(place) else np.zeros((0, _CONTEXT), np.uint8)
        column = np.arange(_CONTEXT)
        inside = (column >= LEFT - out["left"][:, None].astype(int)) & (column < LEFT + out["right"][:, None].astype(int))
        out["bytes"] = np.where(inside, around, 0)
        held.append(out)

    def close() -> pa.RecordBatch:
        if group.ids:
            read()
        suffixes = np.concatenate(held) if held else np.zeros(0, _SUFFIX)
        held.clear()
        if not len(suffixes):
            return _blobs([])
        # of equal surroundings only the smallest document's go on, the others are covered by it
        same = _surroundings(suffixes)
        order = np.lexsort((suffixes["id"], same))
        first = np.append(True, same[order][1:] != same[order][:-1])
        least = np.empty(len(suffixes), np.int64)
        least[order] = suffixes["id"][order][np.flatnonzero(first)][np.cumsum(first) - 1]
        later = suffixes["id"] > least
        rows = []
        if later.any():
            done = np.zeros(int(later.sum()), _PLACE)
            done["row"], done["pos"] = suffixes["row"][later], suffixes["pos"][later]
            o = np.arange(LEFT + 1)
            fits = (suffixes["left"][later][:, None] >= o) & (suffixes["right"][later][:, None].astype(int) >= LENGTH - o)
            done["mask"] = (fits.astype(np.uint32) << o.astype(np.uint32)).sum(1, dtype=np.uint32)
            rows.append((tag, tag % buckets, 1, _squeeze(done.tobytes())))
        go = suffixes[~later] if later.any() else suffixes
        del suffixes, same, order, first, least
        bucket = (go["key"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(part):
                rows.append((tag, int(bucket[part[0]]), 0, _squeeze(_by_column(go[part]))))
        return _blobs(rows)

    for now, kind, key, blob in _by_group(batches):
        if now != tag:
            if tag is not None:
                yield close()
                let_go()
            group, tag, known_keys, held, wanted = _Group(), now, [], [], np.zeros(0, np.uint64)
        if kind == 0:
            known_keys.append(np.cumsum(np.frombuffer(_expand(blob), np.uint64)))
            continue
        if known_keys:
            wanted, known_keys = np.sort(np.concatenate(known_keys)), []
        if group.add(key, blob):
            read()
    if tag is not None:
        yield close()


def _surroundings(suffixes: np.ndarray) -> np.ndarray:
    """Hash of the bytes around each anchor and of how many there are, some rows at a time."""
    out = mix(suffixes["left"].astype(np.uint64) << np.uint64(8) | suffixes["right"])
    step = BLOCK_BYTES // (2 * _CONTEXT)
    for at in range(0, len(suffixes), step):
        part = np.ascontiguousarray(suffixes["bytes"][at : at + step])
        begin = np.arange(len(part)) * _CONTEXT
        out[at : at + step] ^= Prefix(part.reshape(-1)).span(begin, begin + _CONTEXT)
    return out


def _by_column(rows: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(rows[name]).tobytes() for name in rows.dtype.names)


def _from_columns(raw: bytes) -> np.ndarray:
    n = len(raw) // _SUFFIX.itemsize
    out, at = np.zeros(n, _SUFFIX), 0
    for name in _SUFFIX.names:
        kind, shape = (_SUFFIX[name].subdtype or (_SUFFIX[name], ()))[:2]
        size = n * _SUFFIX[name].itemsize
        out[name] = np.frombuffer(raw[at : at + size], kind).reshape(n, *shape)
        at += size
    return out


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group of documents: (row, place, mask) of what is covered."""
    bucket, held, done = None, [], []

    def close() -> pa.RecordBatch:
        nonlocal held
        rows = [(tag, bucket, 0, blob) for tag, blob in done]
        if held:
            parts = [_from_columns(_expand(blob)) for _, blob in held]
            held = [(tag, None) for tag, _ in held]
            mask = covered(np.concatenate(parts))
            at = 0
            for (tag, _), part in zip(held, parts):
                mine = mask[at : at + len(part)]
                at += len(part)
                out = np.zeros(int((mine > 0).sum()), _PLACE)
                out["row"], out["pos"], out["mask"] = part["row"][mine > 0], part["pos"][mine > 0], mine[mine > 0]
                if len(out):
                    rows.append((tag, bucket, 0, _squeeze(out.tobytes())))
        return _blobs(rows)

    for tag, now, kind, blob in _by_group(batches):
        if now != bucket:
            if bucket is not None:
                yield close()
                let_go()
            bucket, held, done = now, [], []
        (done if kind else held).append((tag, blob))
    if bucket is not None:
        yield close()


def cut(text: bytes, places: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Starts and ends of the covered stretches, and the bytes that are left."""
    which, o = np.nonzero(masks[:, None] >> np.arange(LEFT + 1, dtype=np.uint32) & np.uint32(1))
    begin = places[which].astype(np.int64) - o
    steps = np.bincount(begin, minlength=len(text) + 1)[: len(text) + 1] - np.bincount(begin + LENGTH, minlength=len(text) + 1)[: len(text) + 1]
    inside = np.cumsum(steps[:-1]) > 0
    turns = np.diff(inside.astype(np.int8), prepend=0, append=0)
    left = np.frombuffer(text, np.uint8)[~inside].tobytes()
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1), left


def _cut_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tag, places, held, row = None, np.zeros(0, _PLACE), [], 0
    nothing = np.zeros(0, np.uint32)
    out: list[list] = [[], [], [], [], []]
    size = 0

    def rows() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], names=["id", "n_bytes", "starts", "ends", "kept"])

    for now, kind, key, blob in _by_group(batches):
        if now != tag:
            tag, places, held, row = now, np.zeros(0, _PLACE), [], 0
        if kind == 0:
            held.append(np.frombuffer(_expand(blob), _PLACE))
            continue
        if held:
            places, held = np.concatenate(held), []
            places = places[np.argsort(places["row"], kind="stable")]
        text = _expand(blob)
        mine = slice(*np.searchsorted(places["row"], [row, row + 1]))
        row += 1
        starts, ends, left = cut(text, places["pos"][mine], places["mask"][mine]) if mine.stop > mine.start else (nothing, nothing, text)
        for column, value in zip(out, (key, len(text), starts, ends, left)):
            column.append(value)
        size += len(left)
        if size >= BLOCK_BYTES:
            yield rows()
            out[:], size = [[], [], [], [], []], 0
    if out[0]:
        yield rows()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, starts, ends, kept): per row its size, the removed stretches and the bytes left."""
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # short hashes: about one anchor in a hundred meets another by chance, which costs but does no harm
    bits = min(60, max(24, math.ceil(math.log2(total / 14 + 2)) + 7))
    # what a task holds at once follows from bytes, not from how many tasks there are
    groups, buckets = max(parts, math.ceil(total / GROUP_BYTES)), max(parts, math.ceil(total / BUCKET_BYTES))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "tag").sortWithinPartitions("tag", "kind", "id", "blob")

    def with_documents(blobs: DataFrame) -> DataFrame:
        back = blobs.select("tag", "kind", F.lit(None).cast("bigint").alias("id"), "blob")
        return dealt(back.unionByName(_documents(texts, groups)))

    def met(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind", "tag", "blob")

    hashes = dealt(_documents(texts, groups)).mapInArrow(lambda b: _anchor_hashes(b, bits, buckets), _BLOB)
    twice = stage(met(hashes).mapInArrow(lambda b: _found_twice(b), _BLOB), "repeat-hashes")
    suffixes = with_documents(twice).mapInArrow(lambda b: _suffixes(b, bits, buckets), _BLOB)
    places = stage(met(suffixes).mapInArrow(lambda b: _cover(b), _BLOB), "repeat-places")
    schema = "id bigint, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary"
    return with_documents(places).mapInArrow(_cut_documents, schema).withColumnRenamed("id", id_col)
