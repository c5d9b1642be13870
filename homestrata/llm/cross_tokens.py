"""Alignment of two tokenizations of the same text by pointer jumping.

Both tokenizations cut the same bytes. Every token points to the token, of either side,
that overlaps it and ends farthest right; the token that holds its last byte is that one.
A token whose end is an end of both sides points to nothing beyond it, and of the two that
end there the one of side B is the terminal. Replacing every pointer by its target's
pointer doubles the distance each round, so all tokens of a component hold its terminal
after as many rounds as the component's length has binary digits. All texts of a block are
aligned in one go; documents end where both sides end, so no component crosses them.

Two tokens that end together are equal or one is a suffix of the other. The vocabularies
alone thus give every pair that can ever be linked: ``Vocabularies.pairs``, some hundred
thousand whatever the corpus. Links are kept as places in that list and counted in arrays
of its length, so counting needs no shuffle of links and what is sent to tasks is bounded.

Side A is byte-level BPE. Texts of ASCII and Latin letters are encoded from the rank file,
which holds the same vocabulary; all others by the library of the JSON file itself, as the
two libraries may know different versions of Unicode. Neither encodes special tokens.

Defined cases: a null or empty text, and one that a side does not give back byte for byte,
has no tokens: zeros and an empty string; rows with a null or repeated id are rows like
others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestrata.llm.bpe import default_path as default_ranks
from homestrata.llm.bpe import default_pattern
from homestrata.llm.sums import sum_over

BLOCK_CHARS = 1 << 19
_BLANK = "▁"
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>").fullmatch
_OTHER_LETTERS = re.compile("[^\u0000-ɏ‐-‧€]").search


def default_files() -> tuple[str, str, str]:
    """Byte-level JSON file, its rank file, piece model."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), default_ranks(), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for every byte: itself if it prints,
    otherwise the next unused one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and every pair that can end together."""

    def __init__(self, files: tuple[str, str, str]) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        shown, ranks, pieces = files
        self._library = Tokenizer.from_file(shown)
        self._library.encode_special_tokens = True
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("a", pat_str=default_pattern(), mergeable_ranks=merges, special_tokens={})
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters = _byte_letters()
        with open(shown, encoding="utf-8") as held:
            entries = json.load(held)["model"]["vocab"]
        self.a = [b""] * (max(entries.values()) + 1)
        for entry, key in entries.items():
            if all(c in letters for c in entry):
                self.a[key] = bytes(letters[c] for c in entry)
        self.b = [self._piece(k) for k in range(self._pieces.get_piece_size())]
        self.a_length, self.b_length = (np.array([len(t) for t in side], np.int64) for side in (self.a, self.b))
        keys = np.unique(np.fromiter(self._suffixes(), np.int64))
        self.pairs, self.pair_b = keys, keys % len(self.b)
        # decimal ids with what follows them: nothing, ',', '|' or ';'
        self.shown = [f"{k}{end}" for side in (self.a, self.b) for k in range(len(side)) for end in ("", ",", "|", ";")]

    def _piece(self, key: int) -> bytes:
        if self._pieces.is_control(key) or self._pieces.is_unknown(key):
            return b""
        piece = self._pieces.id_to_piece(key)
        single = _BYTE_PIECE(piece)
        return bytes([int(single[1], 16)]) if single else piece.replace(_BLANK, " ").encode()

    def _suffixes(self) -> Iterator[int]:
        """a * |B| + b of all tokens of which one ends with the other."""
        at_a, at_b = {}, {}
        for held, side in ((at_a, self.a), (at_b, self.b)):
            for key, token in enumerate(side):
                if token:
                    held.setdefault(token, []).append(key)
        size = len(self.b)
        for a, token in enumerate(self.a):
            for cut in range(len(token)):
                for b in at_b.get(token[cut:], ()):
                    yield a * size + b
        for b, token in enumerate(self.b):
            for cut in range(1, len(token)):
                for a in at_a.get(token[cut:], ()):
                    yield a * size + b

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [
            self._library.encode(" " + t, add_special_tokens=False).ids
            if _OTHER_LETTERS(t)
            else self._fast.encode_ordinary(" " + t)
            for t in texts
        ]
        return a, self._pieces.encode(texts, num_threads=1) if texts else []


@lru_cache(maxsize=2)
def vocabularies(files: tuple[str, str, str]) -> Vocabularies:
    return Vocabularies(files)


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token of both sides the place, in B, of its component's terminal.

    Ends grow strictly on both sides and share the last one.
    """
    n_a, n_b = len(a_ends), len(b_ends)
    holds_a = np.searchsorted(b_ends, a_ends)
    holds_b = np.searchsorted(a_ends, b_ends)
    own = np.arange(n_a, n_a + n_b)
    if n_b:
        points = np.concatenate([n_a + holds_a, np.where(a_ends[holds_b] > b_ends, holds_b, own)])
    else:
        points = own
    while True:
        jumped = points[points]
        if np.array_equal(jumped, points):
            return points[:n_a] - n_a, points[n_a:] - n_a
        points = jumped


class Aligned:
    """Groups and links of a block of texts."""

    def __init__(self, known: Vocabularies, texts: list[str]) -> None:
        a, b = known.encode(texts)
        for k, text in enumerate(texts):
            raw = (" " + text).encode()
            if not text or b"".join(map(known.a.__getitem__, a[k])) != raw or b"".join(map(known.b.__getitem__, b[k])) != raw:
                a[k] = b[k] = ()
        self.known = known
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        self.a, self.b = (np.fromiter(chain.from_iterable(s), np.int64, n.sum()) for s, n in ((a, self.n_a), (b, self.n_b)))
        a_ends, b_ends = np.cumsum(known.a_length[self.a]), np.cumsum(known.b_length[self.b])
        last_a, last_b = terminals(a_ends, b_ends)
        ends = last_b == np.arange(len(last_b))
        number = np.cumsum(ends) - 1
        self.group_a, self.group_b = number[last_a], number[last_b]
        # groups of each text, and the tokens that end each group together
        edges = np.concatenate([[0], np.cumsum(self.n_b)])
        self.n_groups = np.diff(np.concatenate([[0], np.cumsum(ends)])[edges])
        linked_b = np.flatnonzero(ends)
        linked_a = np.searchsorted(a_ends, b_ends[linked_b])
        self.links = np.searchsorted(known.pairs, self.a[linked_a] * len(known.b) + self.b[linked_b]).astype("<u4")

    def shown(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every text."""
        n_a, n_b, groups = len(self.a), len(self.b), int(self.n_groups.sum())
        to_a = np.cumsum(np.bincount(self.group_a, minlength=groups)) if groups else np.zeros(0, np.int64)
        to_b = np.cumsum(np.bincount(self.group_b, minlength=groups)) if groups else np.zeros(0, np.int64)
        end_a, end_b = np.ones(n_a, np.int64), np.ones(n_b, np.int64)
        end_a[to_a - 1], end_b[to_b - 1] = 2, 3
        end_b[(np.cumsum(self.n_b) - 1)[self.n_b > 0]] = 0
        codes = np.empty(n_a + n_b, np.int64)
        before = np.concatenate([[0], to_b])[:-1] if groups else to_b
        codes[np.arange(n_a) + before[self.group_a]] = self.a * 4 + end_a
        codes[np.arange(n_b) + to_a[self.group_b]] = (self.b + len(self.known.a)) * 4 + end_b
        cuts = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        show = self.known.shown.__getitem__
        return ["".join(map(show, codes[s:e].tolist())) for s, e in zip(cuts, cuts[1:])]


def _blocks(texts: list[str | None]) -> Iterator[list[str]]:
    held, total = [], 0
    for text in texts:
        held.append(text or "")
        total += len(held[-1])
        if total >= BLOCK_CHARS:
            yield held
            held, total = [], 0
    if held:
        yield held


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", files: tuple[str, str, str] | None = None) -> DataFrame:
    """(id, n_a, n_b, n_groups, groups, links) per row of ``docs``.

    ``groups`` lists all groups; ``links`` has one place in ``Vocabularies.pairs`` per link,
    as little-endian unsigned 32-bit integers.
    """
    files = files or default_files()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabularies(files)
        for batch in batches:
            at = 0
            for texts in _blocks(batch.column(1).to_pylist()):
                found = Aligned(known, texts)
                cuts = np.concatenate([[0], np.cumsum(found.n_groups)])
                links = [found.links[s:e].tobytes() for s, e in zip(cuts, cuts[1:])]
                columns = [batch.column(0).slice(at, len(texts))]
                columns += [pa.array(x, pa.int64()) for x in (found.n_a, found.n_b, found.n_groups)]
                columns += [pa.array(found.shown(), pa.string()), pa.array(links, pa.binary())]
                yield pa.record_batch(columns, names=["id", "n_a", "n_b", "n_groups", "groups", "links"])
                at += len(texts)

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id bigint, n_a bigint, n_b bigint, n_groups bigint, groups string, links binary")


def link_counts(aligned: DataFrame, files: tuple[str, str, str] | None = None) -> np.ndarray:
    """How many links of the table hold each of ``Vocabularies.pairs``."""
    size = len(vocabularies(files or default_files()).pairs)

    def add(total: np.ndarray, values: list) -> None:
        for raw in values:
            np.add.at(total, np.frombuffer(raw, "<u4"), 1)

    return sum_over(aligned.select("links"), (size,), np.int64, add)


def pair_table(counts: np.ndarray, files: tuple[str, str, str] | None = None) -> list[tuple[int, int, int]]:
    """(a, b, count) of every pair that is linked anywhere."""
    known = vocabularies(files or default_files())
    seen = np.flatnonzero(counts)
    return list(zip((known.pairs[seen] // len(known.b)).tolist(), known.pair_b[seen].tolist(), counts[seen].tolist()))


def score_links(aligned: DataFrame, counts: np.ndarray, files: tuple[str, str, str] | None = None) -> DataFrame:
    """``aligned`` with n_links, n_best and count_sum in place of ``links``.

    ``counts`` has one number per pair that the vocabularies allow, not per pair seen.
    """
    files = files or default_files()
    known = vocabularies(files)
    highest = np.zeros(len(known.b), np.int64)
    np.maximum.at(highest, known.pair_b, counts)
    is_best = counts == highest[known.pair_b]
    kept = [c for c in aligned.columns if c != "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(raw, "<u4") for raw in batch.column("links").to_pylist()]
            columns = [batch.column(c) for c in kept]
            for numbers in (
                [len(x) for x in found], [int(is_best[x].sum()) for x in found], [int(counts[x].sum()) for x in found]
            ):
                columns.append(pa.array(numbers, pa.int64()))
            yield pa.record_batch(columns, names=[*kept, "n_links", "n_best", "count_sum"])

    schema = ", ".join(f"`{c}` {aligned.schema[c].dataType.simpleString()}" for c in kept)
    return aligned.mapInArrow(run, f"{schema}, n_links bigint, n_best bigint, count_sum bigint")
