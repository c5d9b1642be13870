"""Operators 2, 8 and 9 against brute force."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

from homestrata.llm import components, line_dedup, ngram_join, repeats


def brute_repeats(rows):
    """(kept, spans) by id: every string of 50 bytes looked up in smaller ids."""
    least, out = {}, {}
    texts = {i: (t or "").encode() for i, t in rows}
    for i, raw in texts.items():
        for p in range(len(raw) - 49):
            least[raw[p : p + 50]] = min(i, least.get(raw[p : p + 50], i))
    for i, raw in texts.items():
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - 49):
            if least[raw[p : p + 50]] < i:
                gone[p : p + 50] = True
        out[i] = (bytes(b for b, g in zip(raw, gone) if not g), int((np.diff(gone.astype(int), prepend=0) == 1).sum()))
    return out


def noisy_texts(seed, n=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 7)))
    passages = [" ".join(word() for _ in range(rnd.randint(5, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else " ".join(word() for _ in range(rnd.randint(1, 30))) for _ in range(rnd.randint(0, 6))]
        rows.append((i * 3 + 1, rnd.choice([" ", "\n"]).join(parts)))
    rows += [(i + 1000, rows[i][1]) for i in range(0, n, 5)]
    rows += [(i + 2000, rows[i][1].replace("a", "b", 1)) for i in range(0, n, 4)]
    return rows


def found(df):
    return {r.doc_id: (bytes(r.kept), len(r.starts)) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("common", [1, 3, 64])
def test_repeats_brute_force(docs, monkeypatch, seed, common):
    monkeypatch.setattr(repeats, "COMMON", common)
    rows = noisy_texts(seed)
    assert found(repeats.remove_repeats(docs(rows))) == brute_repeats(rows)


def test_repeats_periodic_and_boundaries(docs):
    rows = [(5, "ab" * 200), (9, "ab" * 100), (2, "x" * 50), (3, "x" * 49), (7, "x" * 51), (8, "y" + "x" * 50 + "z"), (1, "q" * 10)]
    assert found(repeats.remove_repeats(docs(rows))) == brute_repeats(rows)


def test_repeats_odd_rows(odd):
    rows = repeats.remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    want = brute_repeats(texts.items())
    assert {k: bytes(r.kept) for k, r in by_id.items()} == {k: v[0] for k, v in want.items()}
    assert sorted(bytes(r.kept).decode() for r in rows if r.doc_id is None) == ["", "one two\nthree"]


def test_repeats_empty_table(docs):
    assert repeats.remove_repeats(docs([])).count() == 0


def test_intervals_by_hand():
    lcp = np.array([0, 3, 5, 5, 2, 0, 4])
    low, high, length, outer = repeats.lcp_intervals(lcp, 1)
    assert sorted(zip(low.tolist(), high.tolist(), length.tolist(), outer.tolist())) == [
        (0, 4, 3, 2), (0, 5, 2, 0), (1, 4, 5, 3), (5, 7, 4, 0),
    ]


def test_maximal_repeats_have_all_occurrences():
    text = b"0123456789" * 2 + b"the quick brown fox jumps over the lazy dog again and again!"
    texts = [b"A" + text, b"B" + text, b"B" + text + b"tail"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])
    at, key = repeats.anchors(data, starts)
    own = np.searchsorted(starts, at, side="right") - 1
    rows = np.zeros(len(at), repeats._SUFFIX)
    rows["key"], rows["id"], rows["pos"] = key, own, at - starts[own]
    rows["left"], rows["right"] = np.minimum(at - starts[own], repeats.LEFT), np.minimum(starts[own + 1] - at, 50)
    for r, a in zip(rows, at):
        raw = data[a - r["left"] : a + r["right"]]
        r["bytes"][repeats.LEFT - r["left"] : repeats.LEFT + r["right"]] = raw
    groups = {tuple(sorted((int(rows["id"][m]), int(rows["pos"][m]) - o) for m in part)) for o, part in repeats.maximal_repeats(rows)}
    assert ((0, 1), (1, 1), (2, 1)) in groups  # the shared text, wherever it is
    assert ((1, 0), (2, 0)) in groups  # with the B before it


def brute_lines(rows, k=3):
    seen, out = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        if t is None:
            out[i] = (0, 0, None)
            continue
        lines, gone = t.split("\n"), set()
        for p in range(len(lines) - k + 1):
            w = tuple(lines[p : p + k])
            if any(x.strip(" ") for x in w):
                if w in seen:
                    gone |= set(range(p, p + k))
                else:
                    seen[w] = (i, p)
        out[i] = (len(lines), len(gone), "\n".join(x for n, x in enumerate(lines) if n not in gone))
    return out


def test_lines_brute_force(docs):
    rnd = random.Random(3)
    rows = [(i, "\n".join(rnd.choice(["a", "b", "", "c c", " "]) for _ in range(rnd.randint(0, 14)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "a\n" * 40)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.line_dedup(docs(rows)).collect()}
    assert got == brute_lines(rows)


def test_lines_odd_rows_and_columns(odd, docs):
    out = line_dedup.drop_repeated_lines(odd, "doc_id", "text")
    assert out.columns == odd.columns
    got = sorted(((r.doc_id or -1), r.text or "-") for r in out.collect())
    assert len(got) == odd.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    # the ten lines are one kept window's first line and the last, shorter window
    assert texts[9].count("\n") < 9 and texts[10] == ""
    assert [r.text for r in out.collect() if r.doc_id is None and r.text] == ["one two\nthree"]
    assert line_dedup.line_dedup(docs([])).count() == 0


def brute_join(rows, k, num, den):
    sets = {}
    for i, t in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    of = {i: i for i in sets}

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    of[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_texts(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows, key = [], 10
    for _ in range(25):
        base = [rnd.choice(words) for _ in range(rnd.randint(1, 90))]
        for _ in range(rnd.randint(1, 9)):
            copy = list(base)
            for _ in range(rnd.randint(0, 2)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            base = copy if rnd.random() < 0.5 else base
            rows.append((key, " ".join(copy).capitalize()))
            key += rnd.randint(1, 3)
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,k,share", [(1, 3, (90, 100)), (2, 5, (80, 100)), (3, 3, (80, 100)), (4, 1, (50, 100))])
def test_join_brute_force(docs, monkeypatch, seed, k, share):
    monkeypatch.setattr(ngram_join, "GROUP", 4)
    monkeypatch.setattr(ngram_join, "QUESTIONS", 3)
    rows = near_texts(seed)
    got = {r.doc_id: (r.n_shingles, r.component) for r in ngram_join.join(docs(rows), words=k, share=share).collect()}
    assert got == brute_join(rows, k, *share)


def test_join_odd_rows(odd, docs):
    rows = ngram_join.join(odd).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: (r.n_shingles, r.component) for r in rows if r.doc_id is not None}
    want = brute_join([(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None], 3, 90, 100)
    assert got == want
    assert got[7] == (got[6][0], 6) and got[8][1] == 6 and got[2] == (0, 2)
    assert {(r.n_shingles, r.component) for r in rows if r.doc_id is None} == {(0, None), (1, None)}
    assert ngram_join.join(docs([])).count() == 0


def test_join_of_repeated_ids_with_other_texts(docs):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(3, a + " end"), (5, a), (5, b), (9, b + " end"), (5, b)]
    got = sorted((r.doc_id, r.component) for r in ngram_join.join(docs(rows)).collect())
    assert got == [(3, 3), (5, 3), (5, 5), (5, 5), (9, 5)]


def test_group_bound_never_hides_a_link():
    rnd = random.Random(5)
    for _ in range(200):
        members = [(i, i, np.unique([rnd.randrange(40) for _ in range(20)]).astype(np.uint64)) for i in range(5)]
        asked = np.unique([rnd.randrange(40) for _ in range(20)]).astype(np.uint64)
        got = set(ngram_join.Group(members).ask(asked, (60, 100)).tolist())
        want = {
            i for i, _, m in members
            if 100 * len(set(m) & set(asked)) >= 60 * len(set(m) | set(asked))
        }
        assert got == want


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (102, 101), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = collections.ChainMap({i: 1 for i in range(2, 41)}, {101: 100, 102: 100})
    assert got == dict(want)
