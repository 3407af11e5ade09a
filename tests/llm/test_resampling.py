"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib

import pytest

from areaprice.llm import resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TARGET = ["Same words, ab ab", None, "", "漢字 z9"]


def plain_features(text, n):
    words = WORDS.findall((text or "").encode().lower().decode())
    return words, [" ".join(words[i : i + size]) for size in range(1, n + 1) for i in range(len(words) - size + 1)]


def plain(rows, target, percent, seed, n, buckets, min_words):
    def counts(texts):
        total = [0] * buckets
        for text in texts:
            for feature in plain_features(text, n)[1]:
                total[zlib.crc32(feature.encode()) % buckets] += 1
        return total

    s, t = counts([row[1] for row in rows]), counts(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    made = []
    for doc_id, text in rows:
        words, features = plain_features(text, n)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in features)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        made.append([doc_id, len(words), len(features), weight, score, None])
    fit = sorted((row for row in made if row[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, -r[2]))
    for rank, row in enumerate(fit[: len(fit) * percent // 100], 1):
        row[5] = rank
    return sorted(map(tuple, made), key=repr)


@pytest.mark.parametrize(("n", "buckets", "percent", "min_words"), [(1, 10_000, 10, 20), (3, 50, 60, 1), (2, 7, 100, 0)])
def test_draws_as_plain_python_does(spark, docs, rows, n, buckets, percent, min_words):
    target = spark.createDataFrame([(text,) for text in TARGET], "text string")
    found = resampling.resample(docs, target, percent, 7, n, buckets, min_words)
    assert "row" in found.columns and found.schema["row"].dataType.names == [c for c in docs.columns if c != "text"]
    got = sorted(map(tuple, found.select("row.doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)
    assert got == plain([(row[0], row[1]) for row in rows], TARGET, percent, 7, n, buckets, min_words)


def test_runs_go_across_slices(monkeypatch):
    monkeypatch.setattr(resampling, "SLICE", 5)
    split, text = resampling.splitter(), "One two,three\n\n四四四四四四四 five--- six   7even " * 3
    for n in (1, 2, 4):
        slices = list(resampling.windows(text, split, n))
        assert len(slices) > 3
        words, features = plain_features(text, n)
        assert sum(count for count, _ in slices) == len(words)
        assert sorted(f for _, some in slices for f in some) == sorted(features)


def test_nothing_to_draw_from_and_no_target(spark, docs, nothing):
    target = spark.createDataFrame([], "text string")
    assert resampling.resample(nothing, target).count() == 0
    drawn = resampling.resample(docs, target, percent=50)
    assert drawn.count() == docs.count()
    assert drawn.where("rank is not null and n_words < 20").isEmpty()


def test_draws_lean_to_the_target(spark):
    texts = [("alpha beta gamma " if i % 4 == 0 else "delta epsilon zeta ") * 30 for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    target = spark.createDataFrame([("alpha beta",)], "text string")
    drawn = [row["doc_id"] for row in resampling.resample(docs, target, percent=20).where("rank is not null").select("row.doc_id").collect()]
    assert len(drawn) == 80 and all(i % 4 == 0 for i in drawn)
