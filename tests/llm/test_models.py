"""Operators 3 to 7: held-out accuracy, brute force, and defined cases."""

from __future__ import annotations

import base64
import itertools
import math
import random
import re
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from homestrata.llm import decontaminate, language_id, maxscore, page_content, rolling, secrets_scan
from homestrata.llm.page_samples import labelled_pages

SYLLABLES = {"aa": "ba be bi bo bu".split(), "bb": "kra kre kri ñot ñat".split(), "cc": "schu scha ung keit lich".split()}


def speech(rnd, lang, words):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(words))


# 3: language ID


def test_language_held_out_accuracy_and_rejection(docs):
    rnd = random.Random(1)
    rows = [(i, speech(rnd, lang, rnd.randint(3, 80)), lang) for i, lang in enumerate(itertools.islice(itertools.cycle(SYLLABLES), 240))]
    table = docs(rows)
    model = language_id.fit(table.where("doc_id % 4 <> 2"), "text", "lang")
    out = table.where("doc_id % 4 = 2").select("lang", language_id.predict(model, F.col("text")).alias("p")).collect()
    assert sum(r.p.lang == r.lang for r in out) >= 0.98 * len(out)
    assert not any(r.p.rejected for r in out)
    assert all(0 <= r.p.score <= 1 for r in out)
    strange = docs([(1, "\u3053\u308c\u306f\u65e5\u672c\u8a9e\u306e\u6587\u7ae0\u3067\u3059"), (2, None), (3, ""), (4, "12 34 !?"), (5, rows[0][1])])
    got = {r.doc_id: r.p for r in strange.select("doc_id", language_id.predict(model, F.col("text")).alias("p")).collect()}
    assert got[1].rejected and got[1].lang in SYLLABLES
    assert all(got[i].lang == "und" and got[i].score == 0 and got[i].rejected for i in (2, 3, 4))
    assert got[5].lang == "aa" and not got[5].rejected


def test_language_rejects_unknown_languages_and_gibberish_but_no_short_texts(docs):
    rnd = random.Random(5)
    lengths = [1, 2, 4, 9, 20, 60, 150]
    rows = [(i, speech(rnd, lang, lengths[i // 3 % 7]), lang) for i, lang in enumerate(itertools.islice(itertools.cycle(SYLLABLES), 420))]
    model = language_id.fit(docs(rows), "text", "lang")
    letters = "".join(map(chr, range(97, 123)))
    ask = {}
    for n in (20, 60, 200):
        ask[f"letters {n}"] = " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9))) for _ in range(n))
        ask[f"base64 {n}"] = base64.b64encode(rnd.randbytes(4 * n)).decode()
        ask[f"unknown {n}"] = " ".join("".join(rnd.choice("bal kri schi tub ung lan eit".split()) for _ in range(3)) for _ in range(n))
    ask["Turkish"] = "Bu kitap benim için çok önemli, çünkü onu bana dedem uzun yıllar önce bir bayram sabahı vermişti."
    ask["Polish"] = "Wczoraj wieczorem poszliśmy nad rzekę, żeby zobaczyć, jak słońce zachodzi za starym młynem."
    ask["Finnish"] = "Kesällä me menemme usein järven rannalle, jossa lapset uivat ja vanhemmat istuvat auringossa."
    clean = {f"short {i}": speech(rnd, lang, n) for i, (lang, n) in enumerate(itertools.product(SYLLABLES, (1, 1, 2, 3, 5)))}
    names = [*ask, *clean]
    table = docs([(i, (ask | clean)[name]) for i, name in enumerate(names)])
    out = {names[r.doc_id]: r.p.rejected for r in table.select("doc_id", language_id.predict(model, F.col("text")).alias("p")).collect()}
    assert out == {name: name in ask for name in names}


def test_language_document_frequencies_cover_all_rows(docs):
    rows = [(i, "ab" if i % 3 else "ac x") for i in range(50)] + [(99, None)]
    seen = {r.gram: r.docs for r in language_id.document_frequencies(docs(rows).select("text"), "text").collect()}
    assert seen[-1] == 50
    assert max(v for k, v in seen.items() if k >= 0) == 50


def test_language_without_labels(docs, odd):
    model = language_id.fit(docs([(1, "a b", None)]), "text", "lang")
    assert {r.p.lang for r in odd.select(language_id.predict(model, F.col("text")).alias("p")).collect()} == {"und"}
    assert language_id.fit(docs([]), "text", "lang").labels == []
    one = language_id.fit(docs([(1, "some text", "xx")]), "text", "lang")
    assert {r.p.lang for r in docs([(1, "some text")]).select(language_id.predict(one, F.col("text")).alias("p")).collect()} == {"xx"}


# 4: MaxScore


def brute_top(rows, k):
    out = []
    for q, v in rows:
        best = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in rows if c != q)[:k]
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("scale,shard", [(40, 7), (40, 1000), (3, 11), (10**6, 50), (10**8, 50)])
def test_top_k_brute_force(spark, monkeypatch, scale, shard):
    monkeypatch.setattr(maxscore, "FIRST_ROWS", 5)
    monkeypatch.setattr(maxscore, "BLOCK_ROWS", 9)
    rnd = random.Random(scale)
    rows = [(i * 2, [rnd.randint(-scale, scale) for _ in range(12)]) for i in range(60)]
    rows += [(1000 + i, rows[0][1]) for i in range(8)]  # ties
    rows += [(2000, [0] * 12), (2001, [5, -5])]
    table = spark.createDataFrame(rows, "id bigint, v array<bigint>")
    got = sorted((r.query_id, r["rank"], r.id, r.score) for r in maxscore.top_k(table, table, 5, shard).collect())
    assert got == brute_top(rows, 5)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.01]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [-inf, 1.0]), (None, [1.0, 1.0]), (5, [0.25, 0.25]), (6, [])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, shard int")
    vectors = maxscore.integer_vectors(table, "vec_id", "embedding")
    assert {r.id: r.v for r in vectors.collect()} == {0: [32, -1], 5: [16, 16], 6: []}
    got = sorted((r.query_id, r["rank"], r.id, r.score) for r in maxscore.top_k(vectors, vectors, 20).collect())
    assert got == [(0, 1, 5, 496), (0, 2, 6, 0), (5, 1, 0, 496), (5, 2, 6, 0), (6, 1, 0, 0), (6, 2, 5, 0)]
    assert maxscore.top_k(vectors.where("false"), vectors, 3).count() == 0
    assert maxscore.top_k(vectors, vectors.where("false"), 3).count() == 0


def test_repeated_ids_are_not_found_by_themselves(spark):
    table = spark.createDataFrame([(1, [1]), (1, [2]), (2, [3])], "id bigint, v array<bigint>")
    got = {(r.query_id, r.id, r.score) for r in maxscore.top_k(table.where("id = 2"), table, 5).collect()}
    assert got == {(2, 1, 3), (2, 1, 6)}


# 5: decontamination


def test_common_subsequence_brute_force():
    rnd = random.Random(2)
    for _ in range(200):
        a = [rnd.randrange(5) for _ in range(rnd.randint(0, 12))]
        b = [rnd.randrange(5) for _ in range(rnd.randint(0, 12))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_subsequence(a, b) == table[-1][-1]


def test_copies_and_paraphrases_are_found_and_clean_texts_are_not(docs, spark):
    rnd = random.Random(3)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(3000)]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, say(rnd.randint(14, 90)) + ".") for i in range(40)] + [(98, None), (99, ""), (100, "...")]
    rows, truth = [], set()
    for i in range(300):
        text = say(rnd.randint(0, 400))
        if i % 4 == 0:
            item = rnd.randrange(40)
            passage = items[item][1].split()
            if i % 8 == 0:  # one word in six replaced, none in the answer
                passage = [rnd.choice(vocabulary) if k % 6 == 3 and k < 0.7 * len(passage) else w for k, w in enumerate(passage)]
            text = f"{text} {' '.join(passage).upper()} {say(rnd.randint(0, 400))}"
            truth.add((i, item))
        rows.append((i, text))
    rows += [(500, None), (501, ""), (502, " ")]
    benchmark = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, cosine int")
    found = decontaminate.find_leaks(docs(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == truth
    assert all(r.share >= decontaminate.PARAPHRASE_SHARE for r in found)


def test_paraphrase_needs_its_answer(docs, spark):
    item = "which river runs through the old town and past the mill. it is the amber river"
    near = "which stream runs through the new town and by the mill. it is the {} river"
    benchmark = spark.createDataFrame([(1, item, "the amber river")], "item_id bigint, text string, answer string")
    filler = [(i, f"some other words {i} about things {i * 7} and more {i * 13}") for i in range(3, 60)]
    table = docs([(1, near.format("amber")), (2, "which stream runs past a town and by a mill it was in a dream"), *filler])
    found = decontaminate.find_leaks(table, benchmark, answer_col="answer").collect()
    assert [(r.doc_id, r.answered) for r in found] == [(1, True)]


def test_paraphrases_are_found_by_their_cosine(docs, spark, monkeypatch):
    """Against the check over all stretches: at least nine in ten, nothing else, none without the cosine."""
    rnd = random.Random(8)
    common = ["".join(rnd.choice("klmno") for _ in range(3)) for _ in range(40)]
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(3000)]
    word = lambda: rnd.choice(common if rnd.random() < 0.4 else vocabulary)
    say = lambda n: " ".join(word() for _ in range(n))
    texts = [(i, say(rnd.choice([8, 15, 17, 20, 33, 40, 59, 90]))) for i in range(40)]
    rows = []
    for i in range(240):
        passage, kept = texts[i % 40][1].split(), rnd.choice([0.56, 0.6, 0.65, 0.7, 0.8])
        n = len(passage) - len(passage) // 4
        lost = set(rnd.sample(range(n), min(n, int((1 - kept) * len(passage)))))
        passage = [word() if k in lost else w for k, w in enumerate(passage)]
        rows.append((i, f"{say(rnd.randint(0, 150))} {' '.join(passage)} {say(rnd.randint(0, 150))}"))
    items = decontaminate.read_items([(*r, None) for r in texts])
    truth = {}
    for key, text in rows:
        words = decontaminate._words(text)
        for item in items:
            n = len(item.words)
            length = n + max(4, n // 2)
            for at in range(max(0, len(words) - length) + 1):
                share = decontaminate.common_subsequence(item.words, words[at : at + length]) / n
                around = words[at : at + length + len(item.answer)]
                answered = decontaminate.common_subsequence(item.answer, around) >= 0.6 * len(item.answer)
                if share >= 0.8 or (share >= 0.55 and answered):
                    truth[key, item.key] = max(truth.get((key, item.key), (0.0, False)), (share, answered))
    assert len(truth) > 200
    benchmark = spark.createDataFrame(texts, "item_id bigint, text string")
    found = decontaminate.find_leaks(docs(rows), benchmark).collect()
    got = {(r.doc_id, r.item_id): (r.share, r.answered) for r in found}
    assert set(got) <= set(truth) and all(got[k] <= truth[k] for k in got)
    assert len(got) >= 0.9 * len(truth)
    assert sum(got[k] == truth[k] for k in got) >= 0.98 * len(got)
    assert all(r.cosine >= decontaminate.COSINE - 1e-6 for r in found)
    monkeypatch.setattr(decontaminate, "COSINE", 2.0)
    assert decontaminate.find_leaks(docs(rows), benchmark).count() == 0


def test_passages_cover_all_words():
    for sizes in ([0, 1, 31, 32, 33, 48, 49, 200], [5], []):
        owner = np.repeat(np.arange(len(sizes)), sizes)
        for stride in (16, 32):
            start, end = decontaminate._passages(owner, stride)
            seen = np.zeros(len(owner), bool)
            for s, e in zip(start, end):
                assert 0 < e - s <= decontaminate.WINDOW and owner[s] == owner[e - 1]
                seen[s:e] = True
            assert seen.all()


def test_windows_cover_all_words():
    for sizes in ([0, 1, 31, 32, 33, 48, 0, 49, 200], [5], [0]):
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        for length in (3, 8, 30, 100):
            start, end = decontaminate._windows(offsets, length)
            seen = np.zeros(offsets[-1], bool)
            for a, b in zip(start, end):
                assert 0 < b - a <= length
                assert np.searchsorted(offsets, a, "right") == np.searchsorted(offsets, b - 1, "right")
                seen[a:b] = True
            assert seen.all()


def test_word_hashes_brute_force():
    rnd = random.Random(9)
    for size in range(40):
        texts = ["".join(rnd.choice("aB9é -.\n\x00") for _ in range(rnd.randint(0, size))) for _ in range(rnd.randint(1, 9))]
        for gaps, shape in ((rolling._NO_WORD, rb"[0-9a-z\x80-\xff]+"), (rolling._SPACE, rb"[^\x20\x09-\x0d]+")):
            _, data, starts = next(rolling.blocks(range(len(texts)), texts))
            hashes, owner = rolling.word_hashes(data, starts, gaps)
            plain = [(w, t) for t, text in enumerate(texts) for w in re.findall(shape, text.encode().lower())]
            assert owner.tolist() == [t for _, t in plain]
            names = {w: rolling.word_hashes(np.frombuffer(w, np.uint8), np.array([0, len(w)]), gaps)[0][0] for w, _ in plain}
            assert hashes.tolist() == [names[w] for w, _ in plain] and len(set(names.values())) == len(names)


def test_running_sums_add_one_word_after_the_other():
    rnd = np.random.default_rng(4)
    for rank in (1, 7, 96):
        words = rnd.normal(size=(decontaminate.DIMENSIONS, rank)).astype(np.float32)
        for n in (0, 1, decontaminate.SUM_CHUNK, 3 * decontaminate.SUM_CHUNK + 5):
            hashes = rnd.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
            plain = np.cumsum(words[decontaminate._dimension(hashes)], axis=0)
            assert np.array_equal(decontaminate.running_sums(words, hashes), np.concatenate([np.zeros((1, rank)), plain]))


def test_running_sums_are_held_once():
    rnd = np.random.default_rng(5)
    words = rnd.normal(size=(decontaminate.DIMENSIONS, 96)).astype(np.float32)
    hashes = rnd.integers(0, 1 << 63, 40_000, dtype=np.uint64) * np.uint64(2)
    tracemalloc.start()
    assert not list(decontaminate.candidates(words, [], hashes, np.array([0, len(hashes)]), 0.5))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1.3 * len(hashes) * words[0].nbytes


def test_only_candidates_that_the_check_refuses_are_left_out(monkeypatch):
    rnd = random.Random(6)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = decontaminate.read_items([(i, say(n), None) for i, n in enumerate([1, 2, 8, 15, 30, 60] * 4)])
    texts = [" ".join([say(rnd.randint(0, 90)), *[w for w in rnd.choice([say(40), say(9)]).split() if rnd.random() < 0.7]]) for _ in range(20)]
    texts += [say(rnd.randint(0, 30)) + f" {vocabulary[7]}" * 300 for _ in range(4)] + ["", "x"]
    words = [decontaminate._words(t) if t else [] for t in texts]
    words += [item.words[: len(item.words) * 2 // 3] + item.answer for item in items]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    found = []
    for t, held in enumerate(words):
        for item in range(len(items)):
            if held:
                first = rnd.randrange(len(held))
                stop = rnd.randint(first + 1, len(held))
                found.append((item, int(offsets[t]) + first, int(offsets[t]) + stop, 0.5))
    dims = decontaminate._dimension(np.array([w for held in words for w in held], np.uint64))

    def accepted(candidate):
        item, first, stop, _ = candidate
        t = int(np.searchsorted(offsets, first, side="right")) - 1
        return decontaminate.check(items[item], words[t], first - int(offsets[t]), stop - int(offsets[t])) is not None

    for places in (1, 2000, decontaminate.PLACES):
        monkeypatch.setattr(decontaminate, "PLACES", places)
        kept = list(decontaminate.may_hold(items, dims, offsets, iter(found)))
        assert [c for c in found if accepted(c)] == [c for c in kept if accepted(c)]
        assert len(kept) < len(found) / 2
    assert any(map(accepted, found)) and not list(decontaminate.may_hold(items, dims, offsets, []))


def test_leaks_of_odd_and_empty_tables(odd, docs, spark):
    benchmark = spark.createDataFrame([(1, "nothing of this is anywhere in there")], "item_id bigint, text string")
    assert decontaminate.find_leaks(odd, benchmark).count() == 0
    assert decontaminate.find_leaks(docs([]), benchmark).count() == 0
    assert decontaminate.find_leaks(odd, benchmark.where("false")).count() == 0


# 6: page content


def test_held_out_pages():
    learned = page_content.default_potentials()
    pages = labelled_pages(150, seed=4242)
    forest = page_content.read_pages(pages, labelled=True)
    content = page_content.marginals(forest, learned) >= 0.5
    right = [content[node] == (forest.label[node] == 1) for blocks in forest.texts for node, _ in blocks]
    assert np.mean(right) >= 0.98


def test_given_pages_may_have_labels_of_their_own(spark):
    page = "<html><body><nav><a href=x>Home</a></nav><table><tr><td data-label='Price'>1 2 3</td></tr></table></body></html>"
    plain = page.replace(" data-label='Price'", "")
    rows = spark.createDataFrame([(1, page), (2, plain), (3, page.replace("Price", "1"))], "page_id bigint, html string")
    got = {r.page_id: r.text for r in page_content.extract(rows, ["page_id"]).collect()}
    assert got[1] == got[2] == got[3]
    assert set(page_content.read_pages([page, page.replace("Price", "1")]).label) == {-1}


def test_marginals_brute_force():
    page = "<body><nav><a>x</a></nav><div><p>one two</p><p>three</p></div><footer>f</footer></body>"
    forest = page_content.read_pages([page])
    rnd = np.random.default_rng(1)
    learned = page_content.Potentials(rnd.normal(size=page_content._FEATURES), rnd.normal(size=(page_content._EDGES, 2, 2)))
    n, own = len(forest.parent), forest.features @ learned.unary
    total, one = 0.0, np.zeros(n)
    for labels in itertools.product((0, 1), repeat=n):
        score = sum(own[i] for i in range(n) if labels[i])
        score += sum(learned.pair[forest.edge[i], labels[forest.parent[i]], labels[i]] for i in range(n) if forest.parent[i] >= 0)
        total += math.exp(score)
        one += np.array(labels) * math.exp(score)
    assert np.allclose(page_content.marginals(forest, learned), one / total)


def test_pages_by_hand(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<nav><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></nav>"
        '<div class="cookie-notice"><p>We use cookies here.</p><button>OK</button></div>'
        "<article><h1>A  title &amp; more</h1><p><b>First part of the\n text, with a <a href=z>link</a> in it.<br>"
        '<p>Second &eacute;part, a little longer than the first one was.</p><div class="ad">Buy now.</div>'
        "<p>Third part, which closes what there is to be said here.</article>"
        '<section class="comments"><h3>Comments</h3><div class="comment"><p>I think that this is wrong.</p></div></section>'
        "<aside class=sidebar><h3>Related</h3><ul><li><a href=q>Else</a></li></ul></aside>"
        "<form><label>Mail</label><input><button>Subscribe</button></form><footer>&copy; Site. All rights.</footer></body></html>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<div><<<p>"), (5, "u", page), (None, "u", "<nav>" * 3000)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    got = {r.page_id: r.text for r in page_content.extract(table, ["page_id", "url"]).collect()}
    assert got[1] == (
        "A title & more\nFirst part of the text, with a link in it.\n"
        "Second épart, a little longer than the first one was.\n"
        "Third part, which closes what there is to be said here."
    )
    assert got[5] == got[1] and got[2] == got[3] == got[None] == ""
    assert page_content.extract(table.where("false"), ["page_id"]).count() == 0


@pytest.mark.parametrize(
    "page,texts",
    [
        ("<html><head><title>x</title><body><p>one</p></body></html>", ["one"]),
        ("<head><meta charset=utf-8><script>s()</script><p>one<p>two", ["one", "two"]),
        ("<head><title>x</title>one</html>", ["one"]),
        ("<p>one <svg class=i /> two</p><div>three</div>", ["one two", "three"]),
        ("<div><svg><path d=x /><title>t</title><text>s</text></svg>one</div>", ["one"]),
        ("<div><svg><path d=x></div><p>one", ["one"]),
        ("<p hidden>a<p>one</p>two", ["one", "two"]),
        ("<p hidden>a<p hidden>b<div>one</div>", ["one"]),
        ("<ul><li style='display: none'>a<li>one</ul>two", ["one", "two"]),
        ("<ul><li hidden>a</ul><p>one", ["one"]),
        ("<div>one<span hidden>a</div>two", ["one", "two"]),
        ("<div hidden>a<div>b</div>c<p>d</div>one", ["one"]),
        ("<div>one<template><p>a</div>b</template> two</div>three", ["one two", "three"]),
        ("<noscript><p>a</noscript><iframe><p>b</iframe><p>one", ["one"]),
        ("<p>one<br><span hidden>a<br></span>two", ["one two"]),
    ],
)
def test_hidden_elements_end_where_a_browser_ends_them(page, texts):
    assert [text for _, text in page_content.read_pages([page]).texts[0]] == texts


def test_an_article_and_a_footer_at_level_300():
    words = "This is a rather long paragraph of an article, which goes on for some time and says what there is to say. "
    inner = f"<article class=post><p>{words * 3}</p><p>{words * 2}</p></article><footer class=footer><p>&copy; Site. All rights.</p></footer>"
    page = "<body>" + "<div>" * 300 + inner
    forest = page_content.read_pages([page])
    assert len(forest.parent) == 302 + 5 and forest.depth.max() == 303
    article = f"{(words * 3).strip()}\n{(words * 2).strip()}"
    assert page_content.main_texts([page, inner], page_content.default_potentials()) == [article, article]


# 7: secrets


def brute_bits(value):
    """Cheapest segmentation by trying them all."""
    best = math.inf
    for cuts in range(1 << (len(value) - 1)):
        edges = [0, *(i + 1 for i in range(len(value) - 1) if cuts >> i & 1), len(value)]
        best = min(best, sum(_piece_bits(value, a, b) for a, b in zip(edges, edges[1:])))
    return best


def _piece_bits(value, a, b):
    piece, per = value[a:b], secrets_scan._alphabet(value)
    out = len(piece) * per + secrets_scan._PIECE_BITS
    rank = secrets_scan.word_ranks(secrets_scan.default_vocabulary()).get(piece.lower())
    if rank and len(piece) >= 3:
        out = min(out, math.log2(rank) + (0 if piece.islower() else 1) + secrets_scan._PIECE_BITS)
    return out


@pytest.mark.parametrize("value", ["passwordzq", "xAdminq7", "lovebabyzz", "qzxtestqzx", "zwtoken"])
def test_guess_cost_brute_force(value):
    assert secrets_scan.guess_bits(value)[0] <= brute_bits(value) + 1e-9
    if not any(k in ("date", "walk", "repeat") for k, _, _ in secrets_scan.guess_bits(value)[1]):
        assert secrets_scan.guess_bits(value)[0] == pytest.approx(brute_bits(value))


def test_guess_cost_by_kind():
    cheap = "changeme2024 aaaaaaaaaaaa qwertyuiop123 password123! abcabcabcabc 20240102-1234".split()
    dear = "x7Kq9zLm2PwT d41d8cd98f00b204e9800998ecf8427e sk_live_9aKx8Qz71mNbvR".split()
    assert all(secrets_scan.guess_bits(v)[0] < secrets_scan.LEAST_BITS for v in cheap)
    assert all(secrets_scan.guess_bits(v)[0] >= secrets_scan.LEAST_BITS for v in dear)
    for v in cheap + dear:
        pieces = secrets_scan.guess_bits(v)[1]
        assert "".join(v[a:b] for _, a, b in pieces) == v


def base_spans(text):
    """The three shapes, straight from their rules."""
    import re

    rules = (
        (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 12),
        (r"AKIA[A-Z0-9]+", 0, 0, 18),
        (r"[0-9a-f]+", 0, 0, 16),
    )
    found = []
    for n, (rule, flags, group, least) in enumerate(rules):
        found += [(m.start(), n, m.end()) for m in re.finditer(rule, text, flags) if len(m[group]) >= least]
    return [(secrets_scan.KINDS[n], a, b) for a, n, b in sorted(found)]


def test_base_spans_against_the_rules():
    rnd = random.Random(9)
    parts = ["password", "PASSWD", "Secret", "api_key", "APIKEY", "token", '"', "'", " ", "=", ":", "AKIA", "ABCDEFGH12345678", "abcdef0123456789", "x", "é", "\n", "toKen=", "K", "ſ"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert [s[:3] for s in secrets_scan.find(text) if s[0] != "guess"] == base_spans(text)


@pytest.mark.parametrize(
    "before",
    [
        "SECRET_KEY = '", "private_key: ", "encryption_key=", "signingKey: ", "DB_PASSWORD_PROD=", "credentials: ", "password:\t",
        "api.key\t=\t", "authToken=", '{"access_keys": "', "url=https://a.b/?q=1&token=", "my-pwd2: ", "x = auth:",
    ],
)
def test_values_of_identifiers_with_a_credential_word(before):
    value = "x7Kq9zLm2PwTb4Rc"
    guessed = lambda text: [s[1:3] for s in secrets_scan.find(text) if s[0] == "guess"]
    assert guessed(f"some {before}{value}' end") == [(len(before) + 5, len(before) + 21)]
    assert guessed(f"some {before}tR7!kq9 end") == [(len(before) + 5, len(before) + 12)]
    assert guessed(f"some {before}changeme2024 end") == guessed(f"author: {value} AUTHORS={value} secretary={value}") == []


@pytest.mark.parametrize(
    "text",
    [
        "token: international", "password=Elephantgiraffe", "x_token = process.env.GITHUB_TOKEN_VALUE",
        "api_key: ${API_KEY_FROM_ENV}", 'secret = os.environ["ABCDEFGHQWZX"]', "pwd: {{ vault_password }}", "auth_token=$TOKEN_OF_CI",
    ],
)
def test_words_and_references_are_no_secrets(text):
    assert not [s for s in secrets_scan.find(text) if s[0] == "guess"]


def test_long_unbroken_texts_take_linear_time():
    for text in ("secret " + "a=b&" * 250_000, "password" + " " * 1_000_000, "x" * 1_000_000 + " token"):
        began = time.process_time()
        assert secrets_scan.find(text) == []
        assert time.process_time() - began < 2


def test_scan_odd_rows(odd, docs):
    assert {len(r.spans) for r in secrets_scan.scan(odd).collect()} == {0}
    assert secrets_scan.scan(odd).count() == odd.count()
    row = secrets_scan.scan(docs([(1, "é pwd: tR7!kq92Lmz0 and password=changeme2024 end")])).first()
    assert [(s.kind, s.start, s.end) for s in row.spans] == [("guess", 7, 19), ("assign", 24, 45)]
    assert secrets_scan.scan(docs([])).count() == 0
