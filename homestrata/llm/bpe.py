"""Byte-level BPE: encoding and decoding with the ranks of a public vocabulary.

A text is split by the vocabulary's pattern and each piece is merged on its own. The
merge state of a piece is a segment tree over its byte positions whose nodes hold the
smallest (rank, position) of the adjacent pairs below them: the root names the leftmost
pair of least rank, and a merge is a handful of point updates, each up one path. Pieces
of similar length are merged side by side, one tree per row of an array; pieces too long
for that are merged alone in the same way. Merged pieces are kept in a bounded cache.

Runs as narrow Arrow stages: no shuffle, memory by block of texts and cache size.

Defined cases: a null text counts as empty; an empty text has no ids; ids that are not
in the vocabulary cannot be decoded and raise; null ids decode to no bytes; rows are
neither merged nor dropped, so repeated rows, null ids and empty tables pass through.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_PIECES = 150_000
BLOCK_CHARS = 1 << 20
_SIDE_BY_SIDE = 64
_NONE = np.int64(1) << np.int64(62)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Vocabulary:
    """Ranks, the bytes of each id, and which pairs of ids merge into which."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = rank
        self._keys = np.fromiter(pairs, np.int64, len(pairs))
        self._merged = np.fromiter(pairs.values(), np.int64, len(pairs))
        order = np.argsort(self._keys)
        self._keys, self._merged = self._keys[order], self._merged[order]

    @cached_property
    def pairs(self) -> dict[int, int]:
        """The same as a table, for pieces that are merged alone; few texts have any."""
        return dict(zip(self._keys.tolist(), self._merged.tolist()))

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair, ``_NONE`` where the two do not merge."""
        if not len(self._keys):
            return np.full(left.shape, _NONE)
        key = (left << np.int64(32)) | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where((self._keys[at] == key) & (left >= 0) & (right >= 0), self._merged[at], _NONE)


def _merge_rows(vocabulary: Vocabulary, pieces: list[bytes], width: int) -> list[bytes]:
    """Merge pieces of at most ``width`` (a power of two) bytes, one segment tree per row."""
    rows, shift = len(pieces), np.int64(width.bit_length() - 1)
    ids = np.full((rows, width + 1), -1, np.int64)
    for i, piece in enumerate(pieces):
        ids[i, : len(piece)] = vocabulary.byte_ids[np.frombuffer(piece, np.uint8)]
    size = np.array([len(p) for p in pieces])
    after = np.broadcast_to(np.arange(1, width + 2), (rows, width + 1)).copy()
    after[after >= size[:, None]] = width  # column ``width`` stands for "no neighbour"
    before = np.broadcast_to(np.arange(-1, width), (rows, width + 1)).copy()
    before[:, 0] = width
    place = np.arange(width, dtype=np.int64)
    rank = vocabulary.rank_of(ids[:, :width], np.take_along_axis(ids, after[:, :width], 1))
    tree = np.full((rows, 2 * width), _NONE)
    tree[:, width:] = np.where(rank < _NONE, (rank << shift) | place, _NONE)
    level = width
    while level > 1:
        half = level // 2
        tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level = half

    def update(row: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        node = leaf + width
        tree[row, node] = value
        while node[0] > 1:
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    live = np.arange(rows)
    while True:
        root = tree[live, 1]
        live = live[root < _NONE]
        if not len(live):
            break
        root = root[root < _NONE]
        at, new = root & np.int64(width - 1), root >> shift
        gone = after[live, at]
        right, left = after[live, gone], before[live, at]
        ids[live, at], after[live, at] = new, right
        ids[live, gone] = -1
        before[live, right] = at
        update(live, gone, np.full(len(live), _NONE))
        rank = vocabulary.rank_of(new, ids[live, right])
        update(live, at, np.where(rank < _NONE, (rank << shift) | at, _NONE))
        has = left < width
        row, at_left = live[has], left[has]
        if len(row):
            rank = vocabulary.rank_of(ids[row, at_left], new[has])
            update(row, at_left, np.where(rank < _NONE, (rank << shift) | at_left, _NONE))
    left_over = ids[:, :width]
    flat = left_over[left_over >= 0].astype("<u4")
    ends = np.cumsum((left_over >= 0).sum(1)) * 4
    raw = flat.tobytes()
    return [raw[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]


def _merge_one(vocabulary: Vocabulary, piece: bytes) -> bytes:
    """Merge one long piece with a segment tree in flat lists."""
    n = len(piece)
    width = 1 << (n - 1).bit_length()
    none = (1 << 62, 0)
    ids = vocabulary.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs = vocabulary.pairs

    def pair(at: int) -> tuple[int, int]:
        if at < 0 or after[at] >= n:
            return none
        rank = pairs.get((ids[at] << 32) | ids[after[at]])
        return none if rank is None else (rank, at)

    tree = [none] * (2 * width)
    tree[width : width + n] = [pair(i) for i in range(n)]
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def update(leaf: int, value: tuple[int, int]) -> None:
        node = leaf + width
        tree[node] = value
        while node > 1:
            node >>= 1
            best = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best

    while tree[1] is not none and tree[1] != none:
        rank, at = tree[1]
        gone = after[at]
        right = after[gone]
        ids[at], after[at], ids[gone] = rank, right, -1
        if right < n:
            before[right] = at
        update(gone, none)
        update(at, pair(at))
        if before[at] >= 0:
            update(before[at], pair(before[at]))
    return np.array([i for i in ids if i >= 0], "<u4").tobytes()


class Encoder:
    """Encodes blocks of texts; pieces seen lately are looked up, not merged again."""

    def __init__(self, path: str, pattern: str, cache_pieces: int = CACHE_PIECES) -> None:
        self.vocabulary = Vocabulary(path)
        self._split = regex.compile(pattern).findall
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._limit = cache_pieces

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self._split(t) for t in texts]
        found: dict[str, bytes] = {}
        missing: dict[str, None] = {}
        for pieces in split:
            for piece in set(pieces):
                if piece not in found:
                    ids = self._young.get(piece)
                    if ids is None:
                        ids = self._old.get(piece)
                        if ids is None:
                            missing[piece] = None
                            continue
                    found[piece] = ids
        found.update(self._merge(list(missing)))
        self._keep(found)
        return [b"".join(map(found.__getitem__, pieces)) for pieces in split]

    def _merge(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            whole = self.vocabulary.ranks.get(raw)
            if whole is not None:
                yield piece, whole.to_bytes(4, "little")
            elif len(raw) > _SIDE_BY_SIDE:
                yield piece, _merge_one(self.vocabulary, raw)
            else:
                by_width.setdefault(max(2, 1 << (len(raw) - 1).bit_length()), []).append((piece, raw))
        for width, group in by_width.items():
            for i in range(0, len(group), 8192):
                part = group[i : i + 8192]
                yield from zip((p for p, _ in part), _merge_rows(self.vocabulary, [r for _, r in part], width))

    def forget(self) -> None:
        """Let go of all pieces, so that an idle worker holds little."""
        self._young, self._old = {}, {}

    def _keep(self, found: dict[str, bytes]) -> None:
        for piece, ids in found.items():
            if len(piece) <= _SIDE_BY_SIDE:
                self._young[piece] = ids
        if len(self._young) > self._limit:
            self._old, self._young = self._young, {}


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _in_blocks(texts: list[str | None]) -> Iterator[list[str]]:
    held, total = [], 0
    for text in texts:
        held.append(text or "")
        total += len(held[-1])
        if total >= BLOCK_CHARS:
            yield held
            held, total = [], 0
    if held:
        yield held


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    pattern: str | None = None,
    round_trip: bool = False,
) -> DataFrame:
    """(id, ids): ids as packed little-endian unsigned 32-bit integers.

    With ``round_trip`` also ``decoded``, the bytes that the ids decode to, from the same
    Python worker: two Python stages in a row keep two workers a core.
    """
    path, pattern = path or default_path(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            at = 0
            for block in _in_blocks(batch.column(1).to_pylist()):
                ids = encoder.encode(block)
                columns = [batch.column(0).slice(at, len(block)), pa.array(ids, pa.binary())]
                if round_trip:
                    columns.append(pa.array([_decoded(encoder.vocabulary, i) for i in ids], pa.binary()))
                yield pa.record_batch(columns, names=[id_col, "ids", "decoded"][: len(columns)])
                at += len(block)
        encoder.forget()
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids binary" + ", decoded binary" * round_trip)


def _decoded(vocabulary: Vocabulary, ids: bytes) -> bytes:
    return b"".join(map(vocabulary.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id, ids, decoded): the bytes behind packed ids."""
    path, pattern = path or default_path(), default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _encoder(path, pattern).vocabulary
        for batch in batches:
            decoded = [_decoded(vocabulary, ids or b"") for ids in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(decoded, pa.binary())], names=[id_col, ids_col, "decoded"]
            )

    kind = encoded.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, `{ids_col}` binary, decoded binary"
    return encoded.select(id_col, ids_col).mapInArrow(run, schema)
