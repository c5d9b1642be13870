"""Operators 11 to 13: against brute force over the same definitions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from homestrata.llm import cross_tokens, importance, super_minhash
from homestrata.llm.queries import REGISTRY

WORD = re.compile("[^\x20\x09-\x0d]+")
VOCABULARIES = cross_tokens.vocabularies(cross_tokens.default_files())
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- 11: near copies --------------------------------------------------------------------------


def shingle_set(text, words=5):
    found = WORD.findall((text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[k : k + words]) for k in range(max(1, len(found) - words + 1)))


def brute_components(rows, words=5, share=(85, 100)):
    """(id, n_shingles, component, kept) by comparing all pairs."""
    sets = [shingle_set(t, words) for _, t in rows]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None:
                if share[1] * len(a & b) >= share[0] * len(a | b):
                    up[root(i)] = root(j)
    least = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            least[root(k)] = min(least.get(root(k), key), key)
    return [
        (key, len(sets[k]), least[root(k)] if key is not None else None, key == least[root(k)] if key is not None else None)
        for k, (key, _) in enumerate(rows)
    ]


def edited(rnd, words, n, kind):
    out = list(words)
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"{kind}{rnd.randrange(10**6)}"
    return out


def sort_rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_near_copies_equal_all_pairs(spark, docs):
    rnd = random.Random(11)
    rows = []
    for base in range(25):
        words = [f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([3, 5, 9, 60, 200, 700]))]
        for _ in range(rnd.choice([1, 2, 9])):
            few = edited(rnd, words, rnd.choice([0, 0, 1, 1, 2, 4, 9]), "x")
            rows.append((len(rows) * 3 % 997, " ".join(few)))
    # a chain whose ends are not alike, and one hot group around a base
    chain = [f"c{k}" for k in range(300)]
    for k in range(12):
        rows.append((2000 + k, " ".join(chain[4 * k : 4 * k + 200])))
    hot = [f"h{k}" for k in range(150)]
    for k in range(80):
        rows.append((3000 + k, " ".join(edited(rnd, hot, k % 4, "y"))))
    rnd.shuffle(rows)
    got = super_minhash.near_copies(docs(rows)).collect()
    assert sort_rows(got) == sort_rows(brute_components(rows))


def test_buckets_without_a_common_neighbour_are_searched_in_pieces(spark, docs, monkeypatch):
    """Two groups of near copies that share bands with a text linked to neither."""
    monkeypatch.setattr(super_minhash, "PIECE", 4)
    monkeypatch.setattr(super_minhash, "ASKING", 3)
    rnd = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = [(k, " ".join(edited(rnd, base, 3 + k % 3, f"z{k % 5}_"))) for k in range(60)]
    got = super_minhash.near_copies(docs(rows)).collect()
    assert sort_rows(got) == sort_rows(brute_components(rows))


def test_repeated_ids_keep_their_own_texts(docs):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(3, a + " end"), (5, a), (5, b), (9, b + " end"), (5, b)]
    got = super_minhash.near_copies(docs(rows)).collect()
    assert sort_rows(got) == sort_rows(brute_components(rows))
    assert {r.doc_id: r.component for r in got if r.doc_id != 5} == {3: 3, 9: 5}


def test_near_copies_of_odd_and_empty_tables(odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert sort_rows(super_minhash.near_copies(odd).collect()) == sort_rows(brute_components(rows))
    assert super_minhash.near_copies(docs([])).collect() == []


def plain_signature(tokens):
    """Every element by itself, with a whole permutation and no early stop."""
    m = super_minhash.REGISTERS
    held = [(1 << 64) - 1] * m
    for token in tokens.tolist():
        order = list(range(m))
        for step in range(m):
            drawn = int(super_minhash.mix(np.array([token], np.uint64) + super_minhash._STEPS[step])[0])
            at = step + ((drawn & 0xFFFFFFFF) * (m - step) >> 32)
            order[step], order[at] = order[at], order[step]
            held[order[step]] = min(held[order[step]], step << 32 | drawn >> 32)
    return held


def test_signature_equals_the_plain_one():
    sizes = [1, 2, 7, 150, 0, 400]
    tokens = np.random.default_rng(1).integers(0, 1 << 63, sum(sizes), dtype=np.uint64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    got = super_minhash.signatures_of(tokens, offsets)
    for k in range(len(sizes)):
        assert got[k].tolist() == plain_signature(tokens[offsets[k] : offsets[k + 1]])


def test_registers_agree_as_often_as_sets_are_alike_and_vary_less():
    rnd = np.random.default_rng(2)
    shares = []
    for _ in range(300):
        pool = rnd.integers(0, 1 << 63, 60, dtype=np.uint64)
        both = np.concatenate([pool[:50], pool[10:]])
        a, b = super_minhash.signatures_of(both, np.array([0, 50, 100]))
        shares.append((a == b).mean())
    alike = 40 / 60
    independent = math.sqrt(alike * (1 - alike) / super_minhash.REGISTERS)
    assert abs(np.mean(shares) - alike) < 0.01
    assert np.std(shares) < 0.85 * independent


def test_union_find_keeps_connections():
    rnd = random.Random(3)
    sets, pairs = super_minhash.UnionFind(), [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)]
    near = {k: {k} for k in range(60)}
    for a, b in pairs:
        sets.join(a, b)
        if near[a] is not near[b]:
            near[a] |= near[b]
            for k in near[a]:
                near[k] = near[a]
    assert all(sets.root(k) == min(near[k]) for k in sets.parent)


# -- 12: importance resampling ----------------------------------------------------------------


def brute_resample(rows, targets, n=1, buckets=10_000, percent=10, least=20, seed=2024):
    def grams(text):
        words = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", (text or "").translate(LOWER))
        runs = [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    found = [grams(t) for _, t in rows]
    s, t = Counter(b for _, f in found for b in f), Counter(b for x in targets for b in grams(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for (key, _), (words, f) in zip(rows, found):
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append([key, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, r in enumerate(may[: len(may) * percent // 100]):
        r[5] = place + 1
    return [tuple(r) for r in out]


@pytest.mark.parametrize("n", [1, 3])
def test_resample_equals_brute_force(spark, docs, n):
    rnd = random.Random(n)
    words = ["alpha", "Beta", "naïve", "ÉCOLE", "x1", "7", "漢字", "it's", "a-b"]
    rows = [(k, " ,".join(rnd.choice(words) for _ in range(rnd.randrange(60)))) for k in range(150)]
    targets = ["alpha alpha x1", "Beta naïve", "", None]
    target = spark.createDataFrame([(k, t) for k, t in enumerate(targets)], "item_id bigint, text string")
    got = importance.resample(docs(rows), target, n=n)
    want = brute_resample(rows, targets, n)
    assert sort_rows(got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()) == sort_rows(want)


def test_resample_of_odd_and_empty_tables(spark, odd, docs):
    target = spark.createDataFrame([(1, "word1 word2 and3"), (2, None)], "item_id bigint, text string")
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = importance.resample(odd, target, percent=100, least_words=0)
    got = got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()
    assert sort_rows(got) == sort_rows(brute_resample(rows, ["word1 word2 and3", None], percent=100, least=0))
    assert importance.resample(docs([]), target).collect() == []
    assert importance.resample(odd, target.limit(0)).count() == len(rows)


def test_overlapping_spans_are_all_runs():
    line = importance.collapsed("One  two--THREE\tfour\x00five")
    assert line == b"one two three four five"
    runs = [line[m.start() : m.end()] for m in importance.spans_of(2).finditer(line, overlapped=True)]
    assert runs == [b"one two", b"two three", b"three four", b"four five"]


def test_ranked_numbers_all_rows_in_order(spark):
    from pyspark.sql import functions as F

    rows = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("v"), "id").repartition(7)
    got = importance.ranked(rows, F.col("v").desc(), F.col("id")).collect()
    want = sorted(((r.v, r.id) for r in got), key=lambda x: (-x[0], x[1]))
    assert [(r.v, r.id) for r in sorted(got, key=lambda r: r.place)] == want
    assert sorted(r.place for r in got) == list(range(1, 5001))


# -- 13: alignment of two tokenizers ----------------------------------------------------------


def brute_alignment(texts):
    """(groups, links) of every text, by walking both sides."""
    out = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = VOCABULARIES._library.encode(" " + (text or ""), add_special_tokens=False).ids
        b = VOCABULARIES._pieces.encode(text or "")
        in_a, in_b = [VOCABULARIES.a[i] for i in a], [VOCABULARIES.b[i] for i in b]
        if not text or b"".join(in_a) != raw or b"".join(in_b) != raw:
            out.append(("", [], 0, 0))
            continue
        ends = lambda side: np.cumsum([len(t) for t in side]).tolist()
        e_a, e_b = ({end: k + 1 for k, end in enumerate(ends(side))} for side in (in_a, in_b))
        i, j, groups, links = 0, 0, [], []
        for end in sorted(e_a.keys() & e_b.keys()):
            p, q = e_a[end], e_b[end]
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            links.append((a[p - 1], b[q - 1]))
            i, j = p, q
        out.append((";".join(groups), links, len(a), len(b)))
    return out


TEXTS = [None, "", " ", "a  b ​ ①  ﬁ\tx\n y ", "<|endoftext|></s><unk><0x41>", "漢字 مرحبا 😀 naïve Straße", "x" * 300, "one",
         "The quick brown fox isn't here.\n\nNext   line 12345", "▁ blank", "one"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_alignment_of_any_texts(texts):
    found = cross_tokens.Aligned(VOCABULARIES, texts)
    assert found.shown() == [g for g, _, _, _ in brute_alignment(texts)]


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F), max_size=80))
def test_rank_file_and_library_agree_on_latin_texts(text):
    fast = VOCABULARIES._fast.encode_ordinary(" " + text)
    assert fast == VOCABULARIES._library.encode(" " + text, add_special_tokens=False).ids


def test_alignment_rows(spark, docs, tmp_path):
    rows = [(k if k != 7 else None, t) for k, t in enumerate(TEXTS)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = REGISTRY["op13_cross_tokens"](spark, str(tmp_path)).collect()
    brute = brute_alignment(TEXTS)
    counts = Counter(pair for _, links, _, _ in brute for pair in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    want = []
    for (key, _), (groups, links, n_a, n_b) in zip(rows, brute):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        n_best = sum(counts[x] == best[x[1]] for x in links)
        want.append((key, n_a, n_b, len(links), len(links), n_best, sum(counts[x] for x in links), digest))
    assert sort_rows(got) == sort_rows(want)


def test_alignment_of_odd_and_empty_tables(odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = cross_tokens.align(odd)
    brute = brute_alignment([t for _, t in rows])
    want = [(key, n_a, n_b, len(links), groups) for (key, _), (groups, links, n_a, n_b) in zip(rows, brute)]
    assert sort_rows(got.select("id", "n_a", "n_b", "n_groups", "groups").collect()) == sort_rows(want)
    counts = cross_tokens.link_counts(got)
    pairs = Counter(x for _, links, _, _ in brute for x in links)
    assert {(a, b): n for a, b, n in cross_tokens.pair_table(counts)} == pairs
    empty = cross_tokens.align(docs([]))
    assert cross_tokens.score_links(empty, cross_tokens.link_counts(empty)).collect() == []


def test_pointers_reach_terminals():
    rnd = random.Random(9)
    for _ in range(50):
        total = rnd.randrange(1, 60)
        cut = lambda: np.array(sorted({total, *(rnd.randrange(1, total + 1) for _ in range(rnd.randrange(20)))}))
        a, b = cut(), cut()
        common = np.intersect1d(a, b)
        last_a, last_b = cross_tokens.terminals(a, b)
        assert (b[last_a] == common[np.searchsorted(common, a)]).all()
        assert (b[last_b] == common[np.searchsorted(common, b)]).all()
