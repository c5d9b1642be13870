"""Operators 1 and 10: exact against the public libraries, and round trips."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from homestrata.llm import bpe, token_store

ENCODER = bpe.Encoder(bpe.default_path(), bpe.default_pattern(), cache_pieces=50)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=bpe.default_pattern(), mergeable_ranks=ENCODER.vocabulary.ranks, special_tokens={}
)
WORDS = token_store.WordEncoder(token_store.default_path())
TOKENIZER = Tokenizer.from_file(token_store.default_path())


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_encoder_agrees_with_the_library(texts):
    assert [ids(r) for r in ENCODER.encode(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyz", "aé漢😀", "0 \n\t'"])
@pytest.mark.parametrize("size", [1, 2, 63, 64, 65, 66, 1000, 20_000])
def test_long_pieces(letters, size):
    rnd = random.Random(size)
    text = "".join(rnd.choice(letters) for _ in range(size))
    assert ids(ENCODER.encode([text])[0]) == LIBRARY.encode_ordinary(text)
    assert ids(ENCODER.encode(["a" * size])[0]) == LIBRARY.encode_ordinary("a" * size)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_words_agree_with_the_library(texts):
    want = [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    assert [ids(r) for r in WORDS.encode(texts)] == want


def test_words_with_letters_that_change(spark):
    texts = ["İSTANBUL ΣΑΣ. ŸÖ, é É! ẞ ĸ ŉ K ſ", "It's <|endoftext|>x 12.5 a_b --", "x\x1cy z", "W" * 99 + "."]
    want = [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    assert [ids(r) for r in WORDS.encode(texts)] == want


def test_words_of_every_plain_character():
    """Each character alone, in a word, at its end and beside marks, and long runs."""
    plain = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and not token_store._not_plain(chr(c))]
    assert len(plain) > 20_000
    texts = [f"{c} a{c} {c}b x{c}y .{c} {c}' 7{c}'s" for c in plain]
    rnd = random.Random(1)
    texts += ["".join(rnd.choices(plain[:400] if k % 2 else plain, k=300)) for k in range(300)]
    texts += ["".join(rnd.choices("abcdet '.,-s", k=400)) for _ in range(300)]
    want = [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    assert [ids(r) for r in WORDS.encode(texts)] == want


def test_words_of_the_whole_vocabulary():
    """Every entry, as a word, inside one, and behind another."""
    vocab = [v.removesuffix("</w>") for v in TOKENIZER.get_vocab()]
    raw = [bytes(token_store._BYTES[c] for c in v).decode(errors="ignore") for v in vocab]
    texts = [f"{v} {v}x x{v} {v}{w}" for v, w in zip(raw, raw[1:] + raw[:1])]
    want = [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    assert [ids(r) for r in WORDS.encode(texts)] == want


@pytest.mark.parametrize("text", ["a" * 200_000, "ab" * 50_000 + "é.", "x " * 70_000 + "Σ", "漢字" * 40_000, "\x01 \x01a\x01"])
def test_words_of_long_and_marked_texts(text):
    assert ids(WORDS.encode([text])[0]) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_encode_and_decode_rows(odd):
    rows = bpe.decode(bpe.encode(odd)).collect()
    texts = {(r.doc_id, r.text) for r in odd.collect()}
    assert len(rows) == odd.count()
    for r in rows:
        text = bytes(r.decoded).decode()
        assert (r.doc_id, text) in texts or (r.doc_id, None) in texts
        assert ids(r.ids) == LIBRARY.encode_ordinary(text)


def test_ids_outside_the_vocabulary_do_not_decode(spark):
    bad = spark.createDataFrame([(1, bytearray(np.array([999_999], "<u4").tobytes()))], "doc_id bigint, ids binary")
    with pytest.raises(Exception, match="999999"):
        bpe.decode(bad).collect()


def test_store_round_trip(odd, spark, tmp_path):
    folder = token_store.write_store(odd, folder=str(tmp_path / "store"))
    got = sorted(token_store.read_store(spark, folder).collect(), key=lambda r: r.start)
    order = lambda x: (x is not None, x or 0)
    assert [r.id for r in got] == sorted((r.id for r in got), key=order)
    at = 0
    for r in got:
        assert r.start == at
        at += len(r.ids) // 4
    want = sorted(
        (order(r.doc_id), zlib.crc32(np.array([*TOKENIZER.encode(r.text or "").ids, 1], "<u4").tobytes())) for r in odd.collect()
    )
    assert sorted((order(r.id), zlib.crc32(bytes(r.ids))) for r in got) == want


def test_store_lookup_small_chunks_and_empty(docs, spark, tmp_path, monkeypatch):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(300)]
    folder = token_store.write_store(docs(rows), folder=str(tmp_path / "a"))
    all_rows = {r.id: (r.start, bytes(r.ids)) for r in token_store.read_store(spark, folder).collect()}
    some = {r.id: (r.start, bytes(r.ids)) for r in token_store.read_store(spark, folder, ids=[0, 17, 299]).collect()}
    assert some == {k: all_rows[k] for k in (0, 17, 299)}
    empty = token_store.write_store(docs([]), folder=str(tmp_path / "b"))
    assert token_store.read_store(spark, empty).count() == 0


def test_store_rejects_another_dictionary(docs, spark, tmp_path):
    folder = token_store.write_store(docs([(1, "a b c")]), folder=str(tmp_path / "s"))
    spark.createDataFrame([("other", bytearray(b""))], "dict_hash string, dictionary binary").write.mode(
        "overwrite"
    ).parquet(f"{folder}/dictionary")
    with pytest.raises(Exception, match="dictionary"):
        token_store.read_store(spark, folder).collect()


def test_empty_table(docs):
    assert bpe.decode(bpe.encode(docs([]))).count() == 0


def test_round_trip_in_one_pass(odd):
    rows = bpe.encode(odd, round_trip=True).collect()
    apart = bpe.decode(bpe.encode(odd)).collect()
    key = lambda r: (r.doc_id or -1, bytes(r.ids), bytes(r.decoded))
    assert sorted(map(key, rows)) == sorted(map(key, apart))


def test_dictionary_of_documents_that_are_all_long(docs, spark, tmp_path):
    rnd = random.Random(4)
    words = [f"{a}{b}" for a in ("house", "tree", "river", "mill", "stone") for b in ("s", "ing", "ed", "", "er")]
    rows = [(k, " ".join(rnd.choice(words) for _ in range(2000))) for k in range(20)]
    folder = token_store.write_store(docs(rows), folder=str(tmp_path / "long"))
    row = spark.read.parquet(f"{folder}/dictionary").first()
    assert len(row.dictionary) > 1000 and row.origin.startswith("trained on")
    assert {r.id: ids(r.ids)[:-1] for r in token_store.read_store(spark, folder).collect()} == {
        k: e.ids for (k, _), e in zip(rows, TOKENIZER.encode_batch([t for _, t in rows], add_special_tokens=False))
    }
    few = token_store.write_store(docs([(1, "a")]), folder=str(tmp_path / "few"))
    row = spark.read.parquet(f"{few}/dictionary").first()
    assert len(row.dictionary) == 0 and row.origin.startswith("none: ")
