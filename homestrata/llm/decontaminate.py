"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages of ``WINDOW`` words, which are TF-IDF vectors of hashed words; a
randomised SVD over all passages of the corpus gives a latent space of ``RANK`` dimensions.
In it items are searched by cosine: items of about equal length are a class, and every text
is seen through windows of a class's length, a quarter of it apart. A word has a place in
the latent space and a window is the sum of its words', so all windows of all lengths are
differences of one running sum. Every candidate that shares enough dimensions with its item
is then checked on its words: the longest common subsequence of item and passage, over all
stretches not much longer than the item, and whether the item's answer is there too. Copies
pass by the first alone, paraphrases need both. Nothing comes in but by its cosine; how many paraphrases that finds is tested and
stated in the README.

The SVD needs two passes over the corpus, one for document frequencies and one for the
sketch A'A(omega); each task sums its own part and the sums are added in a tree, so no
task and not the driver sees more than some matrices of ``DIMENSIONS`` x ``RANK``. The
benchmark meets the corpus in blocks of at most ``BLOCK_ITEMS`` items, one narrow pass
each; nothing of the corpus is shuffled.

Defined cases: null and empty texts contain nothing; items without words are never found;
without an answer column the last sentence, or else the last quarter, is the answer;
repeated items and rows are all reported; an empty corpus or benchmark gives no rows;
other columns are not read by ``find_leaks`` and kept by ``leaks_column``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import accumulate, batched

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestrata.llm.batches import let_go
from homestrata.llm.rolling import blocks, word_hashes
from homestrata.llm.sums import sum_over

DIMENSIONS = 512
RANK = 96
OVERSAMPLE = 8
WINDOW = 32
BLOCK_ITEMS = 10_000
BLOCK_BYTES = 1 << 18
CLASS_RATIO = 1.4  # of the longest to the shortest item that share windows, about
STRIDE = 4  # windows begin a fourth of their length apart
CHUNK = 2048  # windows compared with a class of items at once
SUM_CHUNK = 256  # words summed up at once
PLACES = 1 << 17  # words and dimensions of candidates looked at at once
COSINE = 0.48
COPY_SHARE = 0.8  # share of an item's words in one common subsequence that makes a copy
PARAPHRASE_SHARE = 0.55
ANSWER_SHARE = 0.6


@dataclass
class Space:
    """``weights``: inverse document frequency; ``basis``: right singular vectors over their values."""

    weights: np.ndarray
    basis: np.ndarray


def _dimension(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int64)


def _passages(owner: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end word of the windows of each text; the last one ends with its text."""
    if not len(owner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cuts = np.flatnonzero(np.diff(owner)) + 1
    first, end = np.append(0, cuts), np.append(cuts, len(owner))
    # a window that would lie wholly within the one before is left out
    counts = np.maximum(1, -(-(end - first - WINDOW) // stride) + 1)
    text = np.repeat(np.arange(len(first)), counts)
    k = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = first[text] + k * stride
    return start, np.minimum(start + WINDOW, end[text])


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the range and place of every word of the ranges."""
    sizes = end - start
    row = np.repeat(np.arange(len(start)), sizes)
    return row, np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(row))


def _matrix(dims: np.ndarray, start: np.ndarray, end: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A row per passage: the weight of every dimension that one of its words falls on."""
    row, word = _ranges(start, end)
    at = dims[word]
    out = np.zeros(len(start) * DIMENSIONS, weights.dtype)
    out[row * DIMENSIONS + at] = weights[at]
    return out.reshape(len(start), DIMENSIONS)


def _text_passages(texts: list, stride: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for _, data, starts in blocks(range(len(texts)), texts, BLOCK_BYTES):
        hashes, owner = word_hashes(data, starts)
        start, end = _passages(owner, stride)
        if len(start):
            yield _dimension(hashes), start, end


def fit_space(docs: DataFrame, text_col: str, seed: int = 5) -> Space:
    """Document frequencies, then the randomised SVD, over all passages of all texts."""
    texts = docs.select(F.col(text_col).cast("string"))

    present = np.ones(DIMENSIONS, np.uint8)

    def count(total: np.ndarray, batch: list) -> None:
        for dims, start, end in _text_passages(batch, WINDOW):
            total[:-1] += _matrix(dims, start, end, present).sum(0, dtype=np.int64)
            total[-1] += len(start)

    seen = sum_over(texts, (DIMENSIONS + 1,), np.float64, count)
    weights = (np.log((1 + seen[-1]) / (1 + seen[:-1])) + 0.01).astype(np.float32)
    omega = np.random.default_rng(seed).standard_normal((DIMENSIONS, RANK + OVERSAMPLE)).astype(np.float32)

    def sketch(total: np.ndarray, batch: list) -> None:
        for dims, start, end in _text_passages(batch, WINDOW):
            a = _matrix(dims, start, end, weights)
            total += a.T @ (a @ omega / np.maximum(np.einsum("ij,ij->i", a, a), 1e-12)[:, None])

    z = sum_over(texts, omega.shape, np.float64, sketch)
    # A'A is close to z (omega'z)^-1 z'; its leading eigenvectors are the basis
    middle = omega.T.astype(np.float64) @ z
    values, vectors = np.linalg.eigh((middle + middle.T) / 2)
    keep = values > max(values.max(), 1e-12) * 1e-10
    half = z @ (vectors[:, keep] / np.sqrt(values[keep]))
    if not keep.any():
        return Space(weights, np.zeros((DIMENSIONS, 1), np.float32))
    left, singular, _ = np.linalg.svd(half, full_matrices=False)
    # coordinates of nearly equal variance, or the words that all passages share would decide
    # every cosine; the mean keeps directions that are hardly there from doing so instead
    power = singular[:RANK] ** 2
    return Space(weights, (left[:, :RANK] / np.sqrt(power + power.mean())).astype(np.float32))


def word_vectors(space: Space) -> np.ndarray:
    """What a word of every dimension adds to a passage's place in the latent space."""
    return (space.weights[:, None] * space.basis).astype(np.float32)


def running_sums(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Row i is the sum of the vectors of the first i words, added one after the other.

    Some rows at a time, as numpy goes down a column after the other, and with two coordinates
    in one complex number, which is half as many additions of the same values.
    """
    rank = words.shape[1]
    pairs = np.pad(words, ((0, 0), (0, rank % 2))).view(np.complex64)
    dims = _dimension(hashes)
    out = np.empty((len(dims) + 1, pairs.shape[1]), np.complex64)
    out[0] = 0
    for at in range(0, len(dims), SUM_CHUNK):
        part = dims[at : at + SUM_CHUNK]
        rows = out[at : at + 1 + len(part)]
        np.take(pairs, part, axis=0, out=rows[1:], mode="clip")
        np.cumsum(rows, axis=0, out=rows)
    return np.ascontiguousarray(out.view(np.float32)[:, :rank])


def _unit(rows: np.ndarray) -> np.ndarray:
    """The rows, which are overwritten, at length one."""
    rows /= np.maximum(np.sqrt(np.add.reduce(rows * rows, axis=1, keepdims=True)), 1e-9)
    return rows


def common_subsequence(item: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over the item."""
    return _common(len(item), map(_masks(item).get, words))


def _masks(item: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def _common(n: int, matches: Iterable[int | None]) -> int:
    """``matches``: for every word its places in the item of ``n`` words as a mask, None without any."""
    full = (1 << n) - 1
    row = full
    for match in matches:
        if match is not None:
            u = row & match
            row = ((row + u) | (row - u)) & full
    return n - row.bit_count()


def _answer(text: str) -> str:
    """The last sentence if there are several, else the last quarter of the words."""
    flat = " ".join(text.split())
    cut = max(flat[:-1].rfind(c + " ") for c in ".!?")
    if cut >= 0 and len(flat[cut + 1 :].split()) >= 3:
        return flat[cut + 2 :]
    words = flat.split()
    return " ".join(words[-max(3, len(words) // 4) :])


@dataclass
class Item:
    key: int
    words: list[int]
    answer: list[int]

    @cached_property
    def masks(self) -> dict[int, int]:
        return _masks(self.words)

    @cached_property
    def dims(self) -> np.ndarray:
        return _dimension(np.array(self.words, np.uint64))


def _words(text: str) -> list[int]:
    _, data, starts = next(blocks([0], [text]))
    return word_hashes(data, starts)[0].tolist()


def read_items(rows: list[tuple[int, str, str | None]]) -> list[Item]:
    items = [Item(key, _words(text), _words(answer or _answer(text))) for key, text, answer in rows if text]
    return [i for i in items if i.words]


def _need(n: int) -> int:
    """Words of an item of ``n`` that a stretch must have in order."""
    return math.ceil(PARAPHRASE_SHARE * n)


def _stretch(n: int) -> int:
    """Words of a stretch in which an item of ``n`` words is looked for."""
    return n + max(4, n // 2)


def check(item: Item, words: list[int], start: int, end: int) -> tuple[float, bool] | None:
    """(share, answer found) of the best stretch that touches ``start``..``end`` and holds the item."""
    n = len(item.words)
    need, length = _need(n), _stretch(n)
    low, high = max(0, start - length), min(len(words), end + length)
    places = list(map(item.masks.get, words[low:high]))
    if _common(n, places) < need:
        return None
    shared = [0, *accumulate(place is not None for place in places)]
    best = None
    for at in range(low, max(low, high - length) + 1):
        if shared[min(at + length, high) - low] - shared[at - low] < need:
            continue
        share = _common(n, places[at - low : at - low + length]) / n
        if share < PARAPHRASE_SHARE or (best and (share, True) <= best):
            continue
        around = words[at : at + length + len(item.answer)]
        answered = common_subsequence(item.answer, around) >= ANSWER_SHARE * len(item.answer)
        if share >= COPY_SHARE or answered:
            best = max(best or (0.0, False), (share, answered))
    return best


@dataclass
class ItemClass:
    """Items of about equal length: their places among all, their unit vectors, their windows' length."""

    items: np.ndarray
    vectors: np.ndarray
    length: int


def item_classes(space: Space, items: list[Item]) -> list[ItemClass]:
    words = word_vectors(space)
    kinds: dict[int, list[int]] = {}
    for i, item in enumerate(items):
        kinds.setdefault(math.floor(math.log(len(item.words)) / math.log(CLASS_RATIO)), []).append(i)
    out = []
    for _, held in sorted(kinds.items()):
        sums = [words[items[i].dims].sum(0) for i in held]
        length = round(sum(len(items[i].words) for i in held) / len(held))
        out.append(ItemClass(np.array(held), _unit(np.array(sums)), length))
    return out


def _windows(offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end word of all windows of texts whose words begin at ``offsets``."""
    stride = max(1, length // STRIDE)
    first, sizes = offsets[:-1], np.diff(offsets)
    counts = np.where(sizes > 0, np.maximum(1, -(-(sizes - length) // stride) + 1), 0)
    text = np.repeat(np.arange(len(first)), counts)
    start = first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * stride
    return start, np.minimum(start + length, offsets[1:][text])


def candidates(
    words: np.ndarray, classes: list[ItemClass], hashes: np.ndarray, offsets: np.ndarray, cosine: float
) -> Iterator[tuple[int, int, int, float]]:
    """(item, first, end word, cosine) of all stretches near an item; overlapping windows are one."""
    sums = running_sums(words, hashes)
    text_end = offsets[1:]
    for kind in classes:
        start, end = _windows(offsets, kind.length)
        found = []
        for at in range(0, len(start), CHUNK):
            places = sums.take(end[at : at + CHUNK], axis=0)
            places -= sums.take(start[at : at + CHUNK], axis=0)
            near = (_unit(places) @ kind.vectors.T).ravel()
            pairs = np.flatnonzero(near >= cosine)
            if len(pairs):
                p, q = np.divmod(pairs, len(kind.items))
                found.append((p + at, q, near[pairs]))
        p, q, near = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((p, q))
        p, q, near = p[order], q[order], near[order]
        if not len(p):
            continue
        text = np.searchsorted(text_end, start[p], side="right")
        new = np.append(True, (q[1:] != q[:-1]) | (text[1:] != text[:-1]) | (start[p[1:]] > end[p[:-1]]))
        runs = np.flatnonzero(new)
        best = np.maximum.reduceat(near, runs)
        for a, b, cos in zip(runs.tolist(), [*runs[1:].tolist(), len(p)], best.tolist()):
            yield int(kind.items[q[a]]), int(start[p[a]]), int(end[p[b - 1]]), cos


def may_hold(
    items: list[Item], dims: np.ndarray, offsets: np.ndarray, found: Iterable[tuple[int, int, int, float]]
) -> Iterator[tuple[int, int, int, float]]:
    """The candidates that ``check`` can accept at all.

    No common subsequence has more words than the item has places whose word, or one of the
    same dimension, is in the stretch that ``check`` looks at.
    """
    for part in batched(found, CHUNK):
        asked = [items[item] for item, *_ in part]
        sizes = np.array([len(item.words) for item in asked])
        need, reach = (np.array([f(len(item.words)) for item in asked]) for f in (_need, _stretch))
        first, stop = (np.array([c[i] for c in part]) for i in (1, 2))
        text = np.searchsorted(offsets, first, side="right")
        low, high = np.maximum(first - reach, offsets[text - 1]), np.minimum(stop + reach, offsets[text])
        cost = np.cumsum(high - low + DIMENSIONS)
        for some in np.split(np.arange(len(part)), np.flatnonzero(np.diff(cost // PLACES)) + 1):
            there = np.zeros((len(some), DIMENSIONS), bool)
            row, word = _ranges(low[some], high[some])
            there[row, dims[word]] = True
            wanted = np.concatenate([asked[i].dims for i in some.tolist()])
            shared = there[np.repeat(np.arange(len(some)), sizes[some]), wanted]
            begins = np.cumsum(sizes[some]) - sizes[some]
            for i in some[np.add.reduceat(shared, begins, dtype=np.int64) >= need[some]].tolist():
                yield part[i]


def leaks_column(space: Space, items: list[Item], text: Column) -> Column:
    """array of struct(item_id, cosine, share, answered) of a text column; at most one per item."""
    classes, words_at = item_classes(space, items), word_vectors(space)
    threshold = COSINE

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            found: list[list] = [[] for _ in range(len(series))]
            texts = series.tolist()
            for keys, data, starts in blocks(range(len(texts)), texts, BLOCK_BYTES):
                hashes, text_of = word_hashes(data, starts)
                if not len(hashes):
                    continue
                best: dict[tuple[int, int], tuple] = {}
                offsets = np.searchsorted(text_of, np.arange(len(keys) + 1))
                words_of: dict[int, list[int]] = {}
                near = candidates(words_at, classes, hashes, offsets, threshold)
                for item, first, stop, cosine in may_hold(items, _dimension(hashes), offsets, near):
                    t = int(text_of[first])
                    if t not in words_of:
                        words_of[t] = hashes[offsets[t] : offsets[t + 1]].tolist()
                    hit = check(items[item], words_of[t], int(first - offsets[t]), int(stop - offsets[t]))
                    if hit:
                        best[t, item] = max(best.get((t, item), (0.0,)), (hit[0], hit[1], cosine))
                for (t, item), (share, answered, cosine) in sorted(best.items()):
                    found[keys[t]].append(
                        {"item_id": items[item].key, "cosine": cosine, "share": share, "answered": answered}
                    )
            yield pd.Series(found)
        let_go()

    kind = "array<struct<item_id:bigint,cosine:double,share:double,answered:boolean>>"
    return F.pandas_udf(run, kind, F.PandasUDFType.SCALAR_ITER)(text.cast("string"))


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, answer_col: str | None = None) -> Iterator[list[Item]]:
    """The benchmark, at most ``BLOCK_ITEMS`` items at a time."""
    answer = F.lit(None).cast("string") if answer_col is None else F.col(answer_col).cast("string")
    rows = benchmark.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("key"), F.col(text_col).cast("string").alias("text"), answer.alias("answer")
    )
    count = max(1, math.ceil(rows.count() / (BLOCK_ITEMS / 2)))
    for k in range(count):
        block = rows.where(F.pmod(F.xxhash64("key", "text"), F.lit(count)) == k) if count > 1 else rows
        items = read_items([(r.key, r.text, r.answer) for r in block.orderBy("key", "text").collect()])
        if items:
            yield items


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
) -> DataFrame:
    """(id, item_id, cosine, share, answered): a row per text and item found in it."""
    space = fit_space(docs, text_col)
    out = None
    for items in item_blocks(benchmark, item_col, item_text_col, answer_col):
        found = docs.select(F.col(id_col), F.explode(leaks_column(space, items, F.col(text_col))).alias("leak"))
        rows = found.select(id_col, "leak.*")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return docs.select(
            F.col(id_col),
            F.lit(0).cast("bigint").alias("item_id"),
            F.lit(0.0).alias("cosine"),
            F.lit(0.0).alias("share"),
            F.lit(False).alias("answered"),
        ).where(F.lit(False))
    return out
