"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from areaprice.llm import spelling

COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_groups(counts, factor):
    made = {}
    for word, n in counts.items():
        near = [other for other in counts if one_edit(word, other)]
        form = min(near, key=lambda w: (-counts[w], w), default=None)
        made[word] = (n, len(near), form if form is not None and counts[form] >= factor * n else None)
    rows = []
    for word, (n, n_near, form) in made.items():
        root = word
        while made[root][2] is not None:
            root = made[root][2]
        rows.append((word, n, n_near, form, counts.get(form), root))
    return sorted(rows)


def plain_counts(rows, min_chars, min_count, damage):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").encode("utf-8", "replace").lower().decode()):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_chars:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= min_count}


def variants(seed, size, letters="abeöz", longest=9):
    rng = random.Random(seed)
    counts = {}
    while len(counts) < size:
        word = "".join(rng.choice(letters) for _ in range(rng.randint(1, longest)))
        for _ in range(rng.randint(1, 6)):
            at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
            word = word[:at] + rng.choice(letters) * (kind < 2) + word[at + (kind > 0) :]
            counts[word or "a"] = int(10 ** rng.uniform(0, 5))
    return counts


@pytest.mark.parametrize(
    ("seed", "size", "letters", "subtree", "searched", "compared"),
    [(1, 300, "abeöz", 1 << 16, 4096, 1 << 21), (2, 400, "abcdefghijklmnop", 20, 7, 64), (3, 150, "ab", 3, 50, 500), (4, 60, "aq", 2, 4096, 1)],
)
def test_groups_as_plain_python_does(spark, monkeypatch, seed, size, letters, subtree, searched, compared):
    monkeypatch.setattr(spelling, "SUBTREE", subtree)
    monkeypatch.setattr(spelling, "SEARCHED", searched)
    monkeypatch.setattr(spelling, "COMPARED", compared)
    counts = variants(seed, size, letters) | {"x" * 40: 7, "x" * 41: 90, "x" * 40 + "y": 1, "y" + "x" * 39: 5}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    found = spelling.spelling_groups(words, factor=3)
    assert sorted(map(tuple, found.select(COLUMNS).collect())) == plain_groups(counts, 3)


def test_compares_all_kinds_of_edits():
    words = ["abc", "abd", "ab", "abcd", "xabc", "bac", "abcde", "", "a" * 300, "a" * 301, "a" * 150 + "b" + "a" * 149]
    codes, starts = spelling.letters(words)
    pairs = [(a, b) for a in range(len(words)) for b in range(len(words)) if a != b]
    a, b = (np.array(side) for side in zip(*pairs))
    near = [one_edit(words[x], words[y]) for x, y in pairs]
    assert spelling.one_apart(codes, starts, a, b).tolist() == near
    kept = spelling.share_half(np.diff(starts), spelling.halves(codes, starts), a, b)
    assert set(np.flatnonzero(near)) <= set(kept.tolist()) and len(kept) < len(pairs) / 2


@pytest.mark.parametrize(("min_chars", "min_count", "damage"), [(7, 2, 31), (1, 1, 3), (3, 1, 0)])
def test_counts_words_of_all_texts(spark, docs, rows, monkeypatch, min_chars, min_count, damage):
    monkeypatch.setattr(spelling, "REMEMBERED", 100)
    found = spelling.word_counts(docs, min_chars, min_count, damage)
    expected = plain_counts([(row[0], row[1]) for row in rows], min_chars, min_count, damage)
    assert dict(found.collect()) == expected


def test_groups_of_texts(spark, docs, rows):
    counts = plain_counts([(row[0], row[1]) for row in rows], 4, 1, 5)
    found = spelling.spelling_groups(spelling.word_counts(docs, 4, 1, 5), factor=2)
    assert sorted(map(tuple, found.select(COLUMNS).collect())) == plain_groups(counts, 2)


def test_nothing_and_null_words(spark, nothing):
    assert spelling.spelling_groups(spelling.word_counts(nothing)).count() == 0
    words = spark.createDataFrame([(None, 5), ("abcdefg", 2)], "word string, n long")
    assert list(map(tuple, spelling.spelling_groups(words).select(COLUMNS).collect())) == [("abcdefg", 2, 0, None, None, "abcdefg")]
    with pytest.raises(ValueError, match="above 1"):
        spelling.spelling_groups(words, factor=1)
