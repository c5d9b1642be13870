"""Secret scan: known shapes, and values in credential context by the cost of guessing them.

Three shapes are found by pattern (``assign``, ``access``, ``hex``). In addition every
value given to an identifier with a credential word in it is priced as a password guesser would: the cheapest
way to cut it into common words, dates, repeated stretches, keyboard walks and brute
force, by dynamic programming over positions, gives the bits a guesser needs. Values of
at least ``LEAST_BITS`` are spans of kind ``guess``: real-looking secrets, while
``changeme2024`` or ``aaaaaaaaaaaa`` are not.

Values that only name a variable or a place of settings are no secrets and are not priced.

One narrow stage; the programme runs for values in credential context only, in time
linear in the value's length (words, dates and walks are of bounded length). Places are
code points, ends exclusive.

Defined cases: a null text counts as empty; texts without spans give empty lists; the
same text gives the same spans, whatever its row; other columns are not read.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "guess")
LEAST_BITS = 40.0

# fixed values: the shapes to be found
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

# an identifier that is given a value; the value is read only behind a credential's identifier,
# as it may hold identifiers again
GIVEN = re.compile(r"""(?<![A-Za-z0-9_.-])([A-Za-z0-9_.-]++)["']?[\x20\t]*+[:=][\x20\t]*+["']?""", re.A)
VALUE = re.compile(r"""[^\s"',;<>]+""", re.A)
# a value that only says where the secret is kept
REFERENCE = re.compile(
    r"\$\{?[A-Za-z_][\w.]*\}?|\$\(.*|\{\{.*|%[A-Za-z_]\w*%"
    r"|(?:process\.env|os\.environ|os\.getenv|getenv|System\.getenv|ENV|env|config|settings|vault)(?:[.(\[].*)?",
    re.A,
)
# words in an identifier that make its value a credential: none that goes on, such as author
CONTEXT = re.compile(
    r"(?:password|passwd|pwd|passphrase|secret|token|credential|auth"
    r"|(?:api|access|secret|private|encryption|signing)[_.-]?key)s?"
    r"(?=$|[_.0-9-]|(?-i:(?<=[a-z])[A-Z]))",
    re.I | re.A,
)
_HINTS = ("passw", "pwd", "passphrase", "secret", "token", "credential", "key", "auth")

# common words in passwords, most common first; a word's place is its price. The words of a
# vocabulary come behind them.
WORDS = (
    "password admin welcome letmein login master secret changeme default user test guest root dragon monkey "
    "sunshine princess football baseball shadow superman batman hello love charlie michael jordan ashley "
    "daniel computer internet server database service account example sample token access public private key "
    "pass word my the your our demo dev prod staging system manager company summer winter spring autumn "
    "january february march april may june july august september october november december monday friday "
    "orange apple banana coffee cheese cookie flower freedom ginger hunter killer lovely magic mustang ninja "
    "pepper pokemon purple qazwsx rainbow silver soccer starwars tigger trustno whatever angel baby blink "
    "bailey biteme buster access thomas robert george andrew joshua matthew anthony william jessica nicole "
    "hannah amanda jennifer michelle house money dollar happy lucky crystal diamond google github amazon "
    "client api data null none empty placeholder redacted insert here value string text"
).split()
LEAST_LETTERS, MOST_LETTERS = 4, 16
_WORD_END = "</w>"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def word_ranks(path: str) -> dict[str, int]:
    """Places of words: those above, then the whole words of a vocabulary in its order.

    Its entries that end a word and are all letters are words; of ``LEAST_LETTERS`` to
    ``MOST_LETTERS`` letters, as shorter ones are in any random text.
    """
    ranks = {w: i + 1 for i, w in reversed(list(enumerate(WORDS)))}
    with open(path, encoding="utf-8") as held:
        entries = json.load(held)["model"]["vocab"]
    for entry in sorted(entries, key=entries.__getitem__):
        word = entry.removesuffix(_WORD_END)
        if word != entry and LEAST_LETTERS <= len(word) <= MOST_LETTERS and word.isascii() and word.isalpha():
            ranks.setdefault(word, len(ranks) + 1)
    return ranks


_LEET = str.maketrans("@4831!0$57", "aaebiiosst")

# rows of keys; a walk goes along a row, either way
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
_NEXT = {a + b for row in _ROWS for x in (row, row[::-1]) for a, b in zip(x, x[1:])}

_DATE = re.compile(
    r"(?:(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d)",
    re.A,
)
_DATE_BITS = {4: 7.0, 6: 10.5, 7: 10.5, 8: 15.5, 9: 15.5, 10: 15.5}
_PIECE_BITS = 1.5  # for saying what kind of piece comes next


def _alphabet(value: str) -> float:
    """Bits per character for a guesser who knows which kinds of characters occur."""
    size = 0
    size += 10 * any(c.isdigit() for c in value)
    size += 26 * any("a" <= c <= "z" for c in value)
    size += 26 * any("A" <= c <= "Z" for c in value)
    size += 33 * any(c < "\x80" and not c.isalnum() for c in value)
    size += 128 * any(c >= "\x80" for c in value)
    if all(c in "0123456789abcdef" for c in value):
        size = 16 if any(c in "abcdef" for c in value) else 10
    return math.log2(max(size, 2))


def guess_bits(value: str, ranks: dict[str, int] | None = None) -> tuple[float, list[tuple[str, int, int]]]:
    """Bits of the cheapest segmentation, and its pieces (kind, start, end)."""
    ranks = ranks or word_ranks(default_vocabulary())
    n = len(value)
    low = value.lower()
    low = low if len(low) == n else value
    plain = low.translate(_LEET)
    per_char = _alphabet(value)
    best = [0.0] + [math.inf] * n
    back: list[tuple[str, int]] = [("", 0)] * (n + 1)
    brute, brute_from = math.inf, 0  # the cheapest way that ends here in a brute-force piece, and its start

    def offer(kind: str, start: int, end: int, bits: float) -> None:
        total = best[start] + bits
        if total < best[end] - 1e-9:
            best[end], back[end] = total, (kind, start)

    walk = [1] * n  # length of the walk along a row that starts at each place
    for i in range(n - 2, -1, -1):
        if low[i : i + 2] in _NEXT:
            way = ord(low[i + 1]) > ord(low[i])
            same = i + 2 < n and low[i + 1 : i + 3] in _NEXT and (ord(low[i + 2]) > ord(low[i + 1])) == way
            walk[i] = walk[i + 1] + 1 if same or walk[i + 1] == 1 or not low[i].isdigit() else 2
    for i in range(n):
        if best[i] + _PIECE_BITS < brute:
            brute, brute_from = best[i] + _PIECE_BITS, i
        brute += per_char
        if brute < best[i + 1] - 1e-9:
            best[i + 1], back[i + 1] = brute, ("brute", brute_from)
        for length in range(3, min(MOST_LETTERS, n - i) + 1):
            for text, leet in ((low, 0.0), (plain, 1.0)):
                rank = ranks.get(text[i : i + length])
                if rank:
                    cased = 0.0 if value[i : i + length].islower() else 1.0
                    offer("word", i, i + length, math.log2(rank) + cased + leet + _PIECE_BITS)
        date = _DATE.match(value, i)
        if date:
            for end in {date.end(), i + 4}:
                if end - i in _DATE_BITS and end <= n:
                    offer("date", i, end, _DATE_BITS[end - i] + _PIECE_BITS)
        if walk[i] >= 3:
            offer("walk", i, i + walk[i], 5.3 + math.log2(walk[i]) + _PIECE_BITS)
        for unit in (1, 2, 3, 4):
            count, piece = 1, value[i : i + unit]
            if len(piece) == unit and (i < unit or value[i - unit : i] != piece):
                while value.startswith(piece, i + count * unit):
                    count += 1
                if count >= 3 or (unit > 1 and count == 2):
                    offer("repeat", i, i + count * unit, unit * per_char + math.log2(count) + _PIECE_BITS)
    pieces, at = [], n
    while at:
        kind, start = back[at]
        pieces.append((kind, start, at))
        at = start
    return best[n], pieces[::-1]


def find(
    text: str, least_bits: float = LEAST_BITS, ranks: dict[str, int] | None = None
) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, bits) in order of start, then kind; bits 0 for the shapes."""
    ranks = ranks or word_ranks(default_vocabulary())
    out = []
    low = text.lower()
    if any(hint in low for hint in _HINTS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LEAST:
                out.append(("assign", m.start(), m.end(), 0.0))
        done = 0
        for m in GIVEN.finditer(text):
            if m.start() < done or not CONTEXT.search(m[1]):
                continue
            value = VALUE.match(text, m.end())
            if not value:
                continue
            done = value.end()
            if REFERENCE.fullmatch(value[0]):
                continue
            bits, _ = guess_bits(value[0], ranks)
            if bits >= least_bits:
                out.append(("guess", *value.span(), bits))
    out += [("access", *m.span(), 0.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [("hex", *m.span(), 0.0) for m in HEX.finditer(text)]
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_bits: float = LEAST_BITS,
    vocabulary: str | None = None,
) -> DataFrame:
    """(id, spans): array of struct(kind, start, end, bits) per row; ``vocabulary`` is a tokenizer's file with word ends."""
    vocabulary = vocabulary or default_vocabulary()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = word_ranks(vocabulary)
        for batch in batches:
            found = [
                [dict(zip(("kind", "start", "end", "bits"), s)) for s in find(t or "", least_bits, ranks)]
                for t in batch.column(1).to_pylist()
            ]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(span))], names=[id_col, "spans"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,`end`:bigint,bits:double>>")
