"""The pipeline's stages, each on its own input, and the whole against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import tiktoken

import corpus_pipeline as pipeline
from homestrata.llm import bpe, queries

from .test_models import SYLLABLES, speech
from .test_repeats import brute_join, brute_lines


@pytest.fixture
def corpus(docs, spark, tmp_path):
    rnd = random.Random(11)
    item = "The question is which of the seven gates was closed first. It was the northern gate"
    rows = []
    for i in range(120):
        lang = list(SYLLABLES)[i % 3]
        rows.append((i, "\n".join(speech(rnd, lang, rnd.randint(4, 20)) for _ in range(rnd.randint(1, 8))), lang))
    rows += [(200 + i, rows[i][1], rows[i][2]) for i in range(5)]  # copies
    rows += [(300, rows[7][1] + " " + item + " " + rows[8][1], rows[7][2]), (301, "12 34", None), (302, None, None), (303, "", "aa")]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return rows, str(tmp_path)


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_and_run(corpus, spark):
    rows, folder = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    given = texts(docs)
    kept = pipeline.known_language(spark, docs, folder)
    assert kept.columns == names and texts(kept) == {i: t for i, t in given.items() if i not in (301, 302, 303)}
    lines = pipeline.drop_lines(spark, kept, folder)
    assert lines.columns == names
    want = {i: v[2] for i, v in brute_lines(texts(kept).items()).items()}
    assert texts(lines) == want and all(r.n_chars == len(r.text) for r in lines.collect())
    single = pipeline.drop_near_copies(spark, lines, folder)
    groups = brute_join(list(want.items()), 5, 80, 100)
    want = {i: t for i, t in want.items() if groups[i][1] == i}
    assert single.columns == names and texts(single) == want
    clean = pipeline.drop_leaks(spark, single, folder)
    want.pop(300)
    assert clean.columns == names and texts(clean) == want
    library = tiktoken.Encoding(
        "own", pat_str=bpe.default_pattern(), mergeable_ranks=bpe.Vocabulary(bpe.default_path()).ranks, special_tokens={}
    )
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in pipeline.run(spark, folder).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in want.items()}


def test_stages_on_odd_and_empty_tables(odd, docs, spark, corpus):
    _, folder = corpus
    for table in (odd, docs([])):
        for _, step in pipeline.STAGES[:-1]:
            out = step(spark, table, folder)
            assert out.columns == table.columns
            assert out.count() <= table.count()
    assert pipeline.drop_near_copies(spark, odd, folder).where("doc_id IS NULL").count() == 2


def test_no_text_is_lost_with_a_repeated_id(spark, docs, corpus):
    words = lambda c: [f"{c}{k}" for k in range(80)]
    a, b = " ".join(words("a")), " ".join(words("b"))
    rows = [(3, a + " near"), (5, a), (5, b), (9, b + " near")]
    kept = pipeline.drop_near_copies(spark, docs(rows), corpus[1]).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(3, a + " near"), (5, b)]


def test_all_queries_are_registered():
    assert [n.split("_")[0] for n in queries.REGISTRY] == [f"op{i}" for i in range(1, 14)]
