"""Token ids on disk: documents in id order, each compressed alone with a shared dictionary.

A store is a folder of three Parquet tables, so any store Spark can write will do and the
committer deals with lost executors:

``dictionary``  one row: the zstandard dictionary, its SHA-256 and its origin. It is trained
                on the serialized id arrays of pieces of ``DICTIONARY_CHARS`` characters at
                most, of the ``DICTIONARY_DOCS`` documents with the smallest hashes of their
                ids; ``origin`` says on how many, or why there is none.
``chunks``      ``payload`` holds the frames of consecutive documents one after the other,
                ``index`` one fixed-size record per document (id, offset, size, tokens), so
                a short document is read by seeking in one chunk. ``dict_hash`` names the
                dictionary that its frames need. ``part``, ``chunk`` and the first and last
                id order the chunks and let a lookup skip the others.
``parts``       the number of ids before each part: one row per written partition.

Ids are little-endian unsigned 32-bit integers. Texts are encoded where they are read and
only compressed frames are shuffled, once, by range of id; the frames are staged first, as
sampling for the ranges would otherwise encode every text twice.

Defined cases: a null text counts as empty, so its array is the end id alone; null ids
come first; rows that repeat an id are all kept, the shorter first; an empty table gives
an empty store that reads back as an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homestrata.sources.staging import stage, staging_root

END_ID = 1
DICTIONARY_DOCS = 512
DICTIONARY_CHARS = 8192
DICTIONARY_SIZE = 65536
CHUNK_BYTES = 4 << 20
LEVEL = 3
LIBRARY_CHARS = 1 << 16
_WORD_END = "</w>"
_END = "\x01"
# letters, in lower case, and numbers among the characters of _PLAIN
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u02af\u0400-\u0481\u048a-\u052f\u2c65\u2c66\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fef"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
# characters whose composition and lower case depend on nothing around them, alike in all versions of Unicode
_PLAIN = (
    "\t\n\r\x20-\x7e\xa1-\xac\xae-\u012f\u0131-\u02af\u0400-\u0481\u048a-\u052f\u2010-\u2027\u2030-\u203a\u20ac"
    "\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fef"
)
# The endings that the vocabulary's pattern splits off first.
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_not_plain = re.compile(f"[^{_PLAIN}]|<\\|").search
_words = re.compile(f"{_ENDINGS}|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+").findall
# the letters that byte-level vocabularies write for bytes
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
_BYTES = {chr(b): b for b in _SHOWN} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*_SHOWN}))}

INDEX = np.dtype([("null", "u1"), ("id", "<i8"), ("offset", "<u8"), ("size", "<u4"), ("tokens", "<u4")])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """The library's ids of whole texts.

    The vocabulary merges bytes within words whose last byte is marked, and every merge's
    rank is the id it makes. So with a byte of its own behind each word, which the lowest
    ranks merge into the word's last byte, tiktoken makes the same merges from the same
    ranks. Texts with other characters than those of ``_PLAIN`` or with what may be a
    special token go to the library itself, in blocks of words, as it drops white space.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        model = json.loads(self._library.to_str())["model"]
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        least = len(model["vocab"]) - len(made)
        self._ranked = made == [*range(least, least + len(made))] and model["end_of_word_suffix"] == _WORD_END
        if not self._ranked:  # another vocabulary, whose ranks are not its ids
            return
        ranks = {}
        for token, number in model["vocab"].items():
            ends = token.endswith(_WORD_END)
            shown = token[: -len(_WORD_END)] if ends else token
            ranks[bytes(_BYTES[c] for c in shown) + _END.encode() * ends] = number
        own = tiktoken.Encoding("words", pat_str=f"[^{_END}]+{_END}", mergeable_ranks=ranks, special_tokens={})
        self._encode = own.encode_ordinary

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self._one(t) if self._ranked and not _not_plain(t) else self._by_library(t) for t in texts]

    def _one(self, text: str) -> bytes:
        words = _words(text.lower())
        return array("I", self._encode(_END.join(words) + _END) if words else []).tobytes()

    def _by_library(self, text: str) -> bytes:
        out = array("I")
        held, size = [], 0
        for word in text.replace("\n", " ").split(" "):
            held.append(word)
            size += len(word) + 1
            if size >= LIBRARY_CHARS:
                out.extend(self._library.encode(" ".join(held), add_special_tokens=False).ids)
                held, size = [], 0
        out.extend(self._library.encode(" ".join(held), add_special_tokens=False).ids)
        return out.tobytes()


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordEncoder(path)


def _arrays(texts: list[str | None], path: str, block: int = 1 << 18) -> Iterator[list[bytes]]:
    """Serialized id arrays with the end id, by blocks of texts."""
    end = np.array([END_ID], "<u4").tobytes()
    held, total = [], 0
    for text in texts:
        held.append(text or "")
        total += len(held[-1])
        if total >= block:
            yield [a + end for a in _encoder(path).encode(held)]
            held, total = [], 0
    if held:
        yield [a + end for a in _encoder(path).encode(held)]


def train_dictionary(docs: DataFrame, id_col: str, text_col: str, path: str) -> tuple[bytes, str]:
    """A dictionary from a bounded sample, and how it came about; empty if nothing can be learned.

    The sample is one piece of each of ``DICTIONARY_DOCS`` documents, at a place that the
    id's hash gives; where there are fewer documents, more pieces of each.
    """
    known = docs.select(F.col(text_col).cast("string").alias("text"), F.xxhash64(id_col).alias("h"))
    known = known.where(F.length("text") > 0)
    # the hashes alone say where the sample ends, so that only its own texts are moved
    last = known.select("h").orderBy("h").limit(DICTIONARY_DOCS).agg(F.max("h")).first()[0]
    few = known.where(F.col("h") <= F.lit(last)).orderBy("h", "text").limit(DICTIONARY_DOCS)
    few = stage(few, "dictionary-sample")
    each = math.ceil(DICTIONARY_DOCS / max(1, few.count()))
    room = F.greatest(F.length("text") - DICTIONARY_CHARS, F.lit(0)) + 1
    at = F.pmod(F.xxhash64("h", "k"), room.cast("bigint")).cast("int") + 1
    pieces = few.select("text", "h", F.explode(F.sequence(F.lit(1), F.lit(each))).alias("k"))
    pieces = pieces.select(F.substring("text", at, F.lit(DICTIONARY_CHARS)).alias("text")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for arrays in _arrays(batch.column(0).to_pylist(), path):
                yield pa.record_batch([pa.array(arrays, pa.binary())], names=["ids"])

    samples = sorted(bytes(r.ids) for r in pieces.mapInArrow(run, "ids binary").collect())
    try:
        raw = zstandard.train_dictionary(DICTIONARY_SIZE, samples).as_bytes()
        return raw, f"trained on {len(samples)} pieces"
    except (zstandard.ZstdError, ValueError) as why:  # the library refuses too small samples
        return b"", f"none: {len(samples)} pieces of {sum(map(len, samples))} bytes are too little ({why})"


def _dict(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_store(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, folder: str | None = None
) -> str:
    """Encode and write all rows; returns the store's folder."""
    spark = docs.sparkSession
    path = path or default_path()
    folder = folder or f"{staging_root(spark)}/tokens-{uuid.uuid4().hex}"
    raw, origin = train_dictionary(docs, id_col, text_col, path)
    dict_hash = hashlib.sha256(raw).hexdigest()
    row = (dict_hash, bytearray(raw), origin)
    held = spark.createDataFrame([row], "dict_hash string, dictionary binary, origin string").coalesce(1)
    held.write.mode("errorifexists").parquet(f"{folder}/dictionary")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dict(raw)).compress
        for batch in batches:
            at = 0
            for arrays in _arrays(batch.column(1).to_pylist(), path):
                ids = batch.column(0).slice(at, len(arrays))
                sizes = pa.array([len(a) // 4 for a in arrays], pa.int64())
                yield pa.record_batch(
                    [ids, sizes, pa.array([compress(a) for a in arrays], pa.binary())], names=["id", "tokens", "frame"]
                )
                at += len(arrays)

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    staged = stage(rows.mapInArrow(frames, "id bigint, tokens bigint, frame binary"), "token-frames")
    ordered = staged.repartitionByRange("id").sortWithinPartitions("id", "tokens", "frame")
    schema = (
        "part int, chunk int, first_id bigint, last_id bigint, n_docs bigint, start_in_part bigint, "
        "n_tokens bigint, dict_hash string, index binary, payload binary"
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, start = TaskContext.get().partitionId(), 0, 0
        entries: list[tuple] = []
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            tokens = sum(e[4] for e in entries)
            row = (
                part, chunk, entries[0][1], entries[-1][1], len(entries), start, tokens, dict_hash,
                np.array([(e[0], e[1] or 0, *e[2:]) for e in entries], INDEX).tobytes(), b"".join(held),
            )
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.binary()]
            names = [f.split()[0] for f in schema.split(", ")]
            return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                key, tokens, frame = (batch.column(k)[i].as_py() for k in range(3))
                entries.append((key is None, key, size, len(frame), tokens))
                held.append(frame)
                size += len(frame)
                if size >= CHUNK_BYTES:
                    yield close()
                    start += sum(e[4] for e in entries)
                    chunk, entries, held, size = chunk + 1, [], [], 0
        if entries:
            yield close()

    ordered.mapInArrow(pack, schema).write.mode("errorifexists").parquet(f"{folder}/chunks")
    chunks = spark.read.schema(schema).parquet(f"{folder}/chunks")
    parts = chunks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per written partition
    parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")).write.mode(
        "errorifexists"
    ).parquet(f"{folder}/parts")
    return folder


def read_store(spark: SparkSession, folder: str, ids: list[int] | None = None) -> DataFrame:
    """(id, start, ids) of all documents, or of those with the given ids.

    ``start`` counts the ids of all documents before it.
    """
    schema = (
        "part int, chunk int, first_id bigint, last_id bigint, start_in_part bigint, "
        "dict_hash string, index binary, payload binary"
    )
    chunks = spark.read.schema(schema).parquet(f"{folder}/chunks")
    if ids is not None:
        wanted = F.lit(False)
        for key in ids:
            wanted = wanted | ((F.col("first_id") <= key) & (F.col("last_id") >= key))
        chunks = chunks.where(wanted)
    parts = spark.read.schema("part int, part_start bigint").parquet(f"{folder}/parts")
    row = spark.read.parquet(f"{folder}/dictionary").first()
    raw, dict_hash = bytes(row.dictionary), row.dict_hash
    only = None if ids is None else set(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor(dict_data=_dict(raw)).decompress
        for batch in batches:
            for i in range(batch.num_rows):
                named, index, payload, start = (batch.column(k)[i].as_py() for k in range(4))
                if named != dict_hash:
                    raise ValueError(f"chunk needs dictionary {named}, the store has {dict_hash}")
                entries = np.frombuffer(index, INDEX)
                starts = start + np.concatenate([[0], np.cumsum(entries["tokens"].astype(np.int64))])
                view = memoryview(payload)
                out: list[tuple] = []
                held = 0
                for k, (null, key, offset, size, tokens) in enumerate(entries.tolist()):
                    if only is not None and (null or key not in only):
                        continue
                    array = expand(view[offset : offset + size], max_output_size=4 * tokens)
                    out.append((None if null else key, int(starts[k]), array))
                    held += len(array)
                    if held > 4 << 20:
                        yield _rows(out)
                        out, held = [], 0
                if out:
                    yield _rows(out)

    joined = chunks.join(parts, "part").select(
        "dict_hash", "index", "payload", (F.col("part_start") + F.col("start_in_part")).alias("start")
    )
    return joined.mapInArrow(run, "id bigint, start bigint, ids binary")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["id", "start", "ids"])
