"""Spelling variants: the composition against all pairs, words and forms against a plain reading."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from zonepulse.llm import spelling


def one_edit(u, v):
    if len(u) < len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(u) == len(v) + 1 and any(u[:i] + u[i + 1:] == v for i in range(len(u)))


def plain_forms(counts, ratio=5):
    out = {}
    for word, n in counts.items():
        near = sorted((-m, other) for other, m in counts.items() if one_edit(word, other))
        best = near[0] if near and -near[0][0] >= ratio * n else None
        out[word] = [best[1] if best else None, None, n, len(near), -best[0] if best else None]
    for word, row in out.items():
        root = word
        while out[root][0] is not None:
            root = out[root][0]
        row[1] = root
    return {word: tuple(row) for word, row in out.items()}


def forms_of(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("letters,seed", [("ab", 1), ("abc", 2), ("aé😀", 3)])
def test_composition_equals_all_pairs(letters, seed):
    rng = random.Random(seed)
    for _ in range(60):
        groups = [sorted({"".join(rng.choices(letters, k=rng.randint(0, 6))) for _ in range(rng.randint(1, 25))})
                  for _ in range(rng.randint(1, 4))]
        groups.append(list(groups[0]))         # the same rests: one initial state
        words = [(g, w) for g, ws in enumerate(groups) for w in ws]
        if not any(w for _, w in words):
            continue
        rng.shuffle(words)
        points = np.frombuffer("".join(w for _, w in words).encode("utf-32-le"), "<u4").astype(np.int64)
        a = spelling.Acceptor(np.array([g for g, _ in words]), points, np.array([len(w) for _, w in words]))
        row_at = np.empty(len(words), int)
        row_at[a.slots] = np.arange(len(words))
        found = []
        for root, i, j, _ in spelling.one_edit_pairs(a):
            for r, x, y in zip(root, i, j):
                for g in np.flatnonzero(a.initial == r):
                    found.append((g, *sorted(words[row_at[a.start[g] + k]][1] for k in (x, y))))
        expected = [(g, u, v) for g, ws in enumerate(groups) for u in ws for v in ws if u < v and one_edit(u, v)]
        assert sorted(found) == sorted(expected)
        assert a.initial[0] == a.initial[-1]


def test_acceptor_is_minimal():
    words = ["cats", "cat", "bats", "bat", "rats", "rat"]
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    a = spelling.Acceptor(np.zeros(6, int), points, np.array([len(w) for w in words]))
    assert len(a.final) == 5 and len(a.label) == 6        # one path "at(s)" behind three letters


@pytest.mark.parametrize("group", [spelling.GROUP, 4])
def test_forms_equal_plain_reading(spark, monkeypatch, group):
    monkeypatch.setattr(spelling, "GROUP", group)          # small groups are halved again and again
    rng = random.Random(4)
    counts = {"".join(rng.choices("ab", k=rng.randint(1, 9))): 5 ** rng.randint(0, 6) * rng.randint(1, 3) for _ in range(250)}
    counts |= {"aaaaaaaaaaa" + c: 7 for c in "aàßÿ×"} | {"x" * 300: 9, "x" * 299: 900, "x" * 150 + "y" + "x" * 149: 5000}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert forms_of(spelling.spelling_forms(df)) == plain_forms(counts)


def test_forms_of_nothing(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.spelling_forms(empty).count() == 0
    assert forms_of(spelling.spelling_forms(spark.createDataFrame([("single", 6)], "word string, n long"))) == {
        "single": (None, "single", 6, 0, None)}


def test_words_of_odd_texts(spark, rows):
    texts = [(1, None), (2, ""), (None, "keyless keyless"), (3, "Straße STRAßE Straße"), (4, "short été"), (5, "naïveté " * 40000),
             (6, "under_score under-score ABCDEF1abcdef"), (6, "under_score under-score ABCDEF1abcdef")]
    got = {r.word: r.n for r in spelling.word_counts(rows(texts), least_count=1, edit_one_in=3).collect()}
    expected = Counter()
    for key, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 3 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                expected[run] += 1
    assert got == expected
    assert spelling.word_counts(rows([])).count() == 0
