"""Vectorised hashes over the bytes of many texts at once.

All functions work on one flat ``uint8`` array holding several texts one after the
other and the start of each, so that the cost per text is a few array operations.
Hashes are sums of a random 64-bit value per byte times powers of an odd number,
modulo 2**64; the hash of any span is a difference of two prefix sums, put back to
power zero and mixed. They depend on nothing but the bytes, so every executor agrees.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BLOCK_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the odd base and of its inverse."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        base = np.full(size, _ODD, np.uint64)
        inverse = np.full(size, pow(_ODD, -1, 1 << 64), np.uint64)
        base[0] = inverse[0] = 1
        _powers["up"], _powers["down"] = np.cumprod(base), np.cumprod(inverse)
    return _powers["up"], _powers["down"]


class Prefix:
    """Prefix sums of one block; ``span(s, e)`` hashes bytes s..e-1 (arrays allowed)."""

    def __init__(self, data: np.ndarray) -> None:
        up, self._down = _power_table(len(data))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self._sums[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start])

    def every(self, length: int) -> np.ndarray:
        """Hashes of all spans of that length."""
        n = len(self._sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self._sums[length:] - self._sums[:n]) * self._down[:n])


def blocks(ids: Iterable, texts: Iterable, size: int = BLOCK_BYTES) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(ids, flat bytes, starts with the end appended); null texts count as empty.

    A block holds whole texts of about ``size`` bytes together, so memory follows the
    block or a single longer text, not the batch.
    """
    held, parts, total = [], [], 0
    for key, text in zip(ids, texts):
        raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
        held.append(key)
        parts.append(raw)
        total += len(raw)
        if total >= size:
            yield _block(held, parts)
            held, parts, total = [], [], 0
    if held:
        yield _block(held, parts)


def _block(held: list, parts: list[bytes]) -> tuple[list, np.ndarray, np.ndarray]:
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return held, np.frombuffer(b"".join(parts), np.uint8), starts


def slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum (``pick``) over every run of ``width`` values."""
    done = 1
    out = values
    while done * 2 <= width:
        out = pick(out[: len(out) - done], out[done:])
        done *= 2
    if done < width:
        rest = width - done
        out = pick(out[: len(out) - rest], out[rest:])
    return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_NO_WORD = np.array([not (b >= 128 or chr(b).isalnum()) for b in range(256)])


def word_hashes(
    data: np.ndarray, starts: np.ndarray, gaps: np.ndarray = _NO_WORD
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lower-cased, and the text it is in.

    Words are maximal runs of bytes that are no gap; by default letters, digits and
    whatever is not ASCII.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~gaps[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    edges = starts[:-1][starts[:-1] < len(data)]
    begins[edges] = word[edges]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    cuts = starts[1:][starts[1:] > 0] - 1
    ends[cuts] = word[cuts]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Prefix(_LOWER[data]).span(s, e), np.searchsorted(starts, s, side="right") - 1


def shingles(data: np.ndarray, starts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``words`` words, and the text each belongs to.

    Words are maximal runs without ASCII white space, A-Z lower-cased. A text with fewer
    words gives its whole sequence as one shingle, a text without words none.
    """
    hashes, text = word_hashes(data, starts, _SPACE)
    # a sum over the words of a run, each times a power of its place, tells order
    up, _ = _power_table(words + 1)
    if len(hashes) >= words:
        runs = len(hashes) - words + 1
        out = np.zeros(runs, np.uint64)
        for k in range(words):
            out += mix(hashes[k : k + runs] + np.uint64(k)) * up[k + 1]
        inside = text[:runs] == text[words - 1 :]
        full, owner = mix(out[inside]), text[:runs][inside]
    else:
        full, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    counts = np.bincount(text, minlength=len(starts) - 1)
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        first = np.searchsorted(text, short)
        more = np.zeros(len(short), np.uint64)
        for i, (at, n) in enumerate(zip(first, counts[short])):
            places = np.arange(n)
            more[i] = (mix(hashes[at : at + n] + places.astype(np.uint64)) * up[places + 1]).sum() ^ np.uint64(n)
        full = np.concatenate([full, mix(more)])
        owner = np.concatenate([owner, short])
    return full, owner
