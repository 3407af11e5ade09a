"""Suffix arrays, repeats and chunks against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from areaprice.llm import catalog, chunks, repeats
from areaprice.llm.suffixes import SuffixArray
from areaprice.scratch import stored


def random_texts(rng, n):
    alphabet = rng.choice([b"a", b"ab", b"ab\x00", bytes(range(256))])
    texts = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return texts + [rng.choice(texts)[rng.randint(0, 5) :] + rng.choice(texts) for _ in range(n)]


@pytest.mark.parametrize("seed", range(12))
def test_suffix_array(seed):
    rng = random.Random(seed)
    texts = random_texts(rng, 6)
    least = rng.randint(1, 6)
    array = SuffixArray(texts, least)
    suffixes = [(text[i:], row, i) for row, text in enumerate(texts) for i in range(len(text) - least + 1)]
    rows = array.starts.searchsorted(array.order, side="right") - 1
    # Empty texts share their start with the next one, which is the last of them.
    found = [texts[row][at - array.starts[row] :] for row, at in zip(rows.tolist(), array.order.tolist(), strict=True)]
    assert found == sorted(s for s, _, _ in suffixes)
    for before, here, common in zip(found, found[1:], array.common[1:].tolist(), strict=False):
        assert common == next((i for i, (a, b) in enumerate(zip(before, here, strict=False)) if a != b), min(len(before), len(here)))


@pytest.mark.parametrize("seed", range(12))
def test_maximal_repeats_with_all_occurrences(seed):
    rng = random.Random(100 + seed)
    texts = [text for text in random_texts(rng, 5) if text]
    least = rng.randint(1, 6)
    array = SuffixArray(texts, least)
    data = b"".join(texts)
    found = Counter((data[places[0] : places[0] + size], tuple(sorted(places.tolist()))) for size, places in array.repeats(least))
    starts = dict(zip(array.starts.tolist(), texts, strict=True))
    occurrences = {}
    for start, text in starts.items():
        for i in range(len(text)):
            for j in range(i + least, len(text) + 1):
                occurrences.setdefault(text[i:j], []).append((start + i, start + j))
    ends = {start + len(text) for start, text in starts.items()}
    expected = Counter()
    for string, places in occurrences.items():
        lefts = {("start", a) if a in starts else data[a - 1] for a, _ in places}
        rights = {("end", b) if b in ends else data[b] for _, b in places}
        if len(places) > 1 and len(rights) > 1 and (len(lefts) > 1 or any(a in starts for a, _ in places)):
            expected[string, tuple(sorted(a for a, _ in places))] += 1
    assert found == expected


@pytest.mark.parametrize("seed", range(8))
def test_shared_runs_are_all_strings_that_occur_twice(seed):
    rng = random.Random(200 + seed)
    texts, length = random_texts(rng, 5), rng.randint(1, 8)
    times = Counter(text[i : i + length] for text in texts for i in range(len(text) - length + 1))
    expected = {(row, i) for row, text in enumerate(texts) for i in range(len(text) - length + 1) if times[text[i : i + length]] > 1}
    runs = repeats.shared_runs(texts, length)
    assert {(row, at + i) for row, at, run in runs for i in range(len(run) - length + 1)} == expected
    assert all(texts[row][at : at + len(run)] == run for row, at, run in runs)


def test_arrays_take_whole_groups():
    rng = random.Random(1)
    marks = sorted(rng.choice(range(400)) for _ in range(3000))
    texts = [bytes(rng.randint(400, 900)) for _ in marks]
    table = pa.table({"mark": pa.array(marks, pa.int64()), "text": pa.array(texts, pa.binary())})
    parts = [table.slice(0, 5).to_batches(1), table.slice(5, 995).to_batches(97), table.slice(1000).to_batches(700)]
    found = list(repeats._arrays(batch for part in parts for batch in part))
    assert pa.concat_tables(found).equals(table)
    groups = [set(part.column("mark").to_pylist()) for part in found]
    assert sum(map(len, groups)) == len(set(marks)) and len(found) > 3


def removed_by_brute_force(texts, length):
    """Bytes covered by a string of some length that starts anywhere else too."""
    texts = [(text or "").encode() for text in texts]
    times = Counter(text[i : i + length] for text in texts for i in range(len(text) - length + 1))
    found = []
    for text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if times[text[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        found.append((len(text), sum(gone), runs, bytes(b for b, g in zip(text, gone, strict=True) if not g)))
    return found


@pytest.mark.parametrize("length, group_bytes", [(400, 1 << 20), (400, 1), (100, 5000)])
def test_repeats_against_brute_force(docs, rows, monkeypatch, length, group_bytes):
    monkeypatch.setattr(repeats, "GROUP_BYTES", group_bytes)
    expected = Counter((row[0], *rest) for row, rest in zip(rows, removed_by_brute_force([r[1] for r in rows], length), strict=True))
    found = repeats.drop_repeats(docs, length).collect()
    assert Counter((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == expected
    assert sum(r.n_removed for r in found) > 1000


@pytest.mark.parametrize("length, shorter, group_bytes", [(400, 200, 1 << 20), (400, 200, 1), (200, 100, 5000), (100, 300, 5000), (150, 150, 1)])
def test_bytes_in_shorter_repeats_against_brute_force(docs, rows, monkeypatch, length, shorter, group_bytes):
    monkeypatch.setattr(repeats, "GROUP_BYTES", group_bytes)
    texts = [r[1] for r in rows]
    both = zip(rows, removed_by_brute_force(texts, length), removed_by_brute_force(texts, shorter), strict=True)
    expected = Counter((row[0], *rest, short[1]) for row, rest, short in both)
    found = repeats.drop_repeats(docs, length, shorter=shorter).collect()
    assert Counter((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.n_repeated) for r in found) == expected


@pytest.mark.parametrize("seed", range(4))
def test_shorter_repeats_of_near_copies(spark, monkeypatch, seed):
    rng = random.Random(300 + seed)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    pool = [noise(rng.randint(90, 420)) for _ in range(12)] + ["z" * 700, "ab" * 300]
    texts = ["".join(rng.choice(pool) if rng.random() < 0.6 else noise(rng.randint(1, 150)) for _ in range(rng.randint(1, 7))) for _ in range(60)]
    texts += [text[:n] + "!" + text[n + 1 :] for text in texts[:20] for n in [rng.randrange(len(text))]]
    monkeypatch.setattr(repeats, "GROUP_BYTES", rng.choice([1 << 20, 3000]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.row.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.n_repeated) for r in repeats.drop_repeats(docs, shorter=200).collect()}
    both = zip(removed_by_brute_force(texts, 400), removed_by_brute_force(texts, 200), strict=True)
    assert found == {i: (*long, short[1]) for i, (long, short) in enumerate(both)}
    assert sum(f[4] for f in found.values()) > sum(f[1] for f in found.values()) > 0


def test_op7_tells_passages_of_over_50_words(spark, tmp_path):
    rng = random.Random(31)
    noise = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(n))
    passages = [noise(51) for _ in range(20)]
    texts = [f"{noise(40)} {passage} {noise(40)}" for passage in passages * 2] + [noise(120) for _ in range(20)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in catalog.QUERIES["op7_suffix_array_dedup"](spark, str(tmp_path)).collect()}
    assert all(found[i].n_removed == 0 and len(passages[i % 20]) <= found[i].n_repeated <= len(passages[i % 20]) + 4 for i in range(40))
    assert not any(found[i].n_removed or found[i].n_repeated for i in range(40, 60))


def test_texts_of_copies_are_not_read_again(spark, monkeypatch):
    asked = []
    read = repeats._segment_texts
    monkeypatch.setattr(repeats, "_segment_texts", lambda texts, distinct: asked.append(distinct) or read(texts, distinct))
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(3000)) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts * 3)), "doc_id long, text string")
    assert all(r.n_removed == r.n_repeated == 3000 for r in repeats.drop_repeats(docs, shorter=200).collect())
    assert asked[0].count() == 0


def test_repeat_groups_have_all_occurrences(spark):
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(460)
    texts = [noise(50) + "<" + passage + ">" + noise(70), noise(10) + "(" + passage + ")" + noise(5), passage]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for row in repeats.repeat_groups(docs).collect():
        found.setdefault(bytes(row.repeat), set()).add((row.doc_id, row.start, row.size))
    covered = {(i, text.find(passage) + at) for i, text in enumerate(texts) for at in range(len(passage))}
    assert {(i, at) for places in found.values() for i, start, size in places for at in range(start, start + size)} == covered
    for places in found.values():
        assert len({texts[i][start : start + size] for i, start, size in places}) == 1
        string = next(texts[i][start : start + size] for i, start, size in places)
        assert {i for i, _, _ in places} == {i for i, text in enumerate(texts) if string in text} == {0, 1, 2}


def test_common_passage_in_many_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP_BYTES", 20_000)
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(450)
    texts = [noise(rng.randint(0, 600)) + passage + noise(rng.randint(0, 600)) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.row.doc_id: tuple(r)[1:] for r in repeats.drop_repeats(docs).collect()}
    for number, expected in enumerate(removed_by_brute_force(texts, 400)):
        assert (*found[number][:3], bytes(found[number][3])) == expected


def test_gear_hash_is_the_sum_of_shifts():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (0, 1, 31, 200, 33, 0)]
    cutting = chunks.Cutting()
    gear = chunks._gear()
    for text, ends in zip(texts, chunks.cut_points(texts, cutting), strict=True):
        expected, start, state = [], 0, 0
        for i, byte in enumerate(text):
            state = ((state << 1) + int(gear[byte])) % 2**32
            size = i + 1 - start
            if size >= cutting.least and state >> (32 - cutting.bits) == 0 or size == cutting.most or i + 1 == len(text):
                expected.append(i + 1)
                start = i + 1
        assert ends == expected


def test_inserted_text_moves_chunks_and_no_more():
    rng = np.random.default_rng(4)
    text = rng.integers(97, 123, 5000, dtype=np.uint8).tobytes()
    cut = lambda t: {t[a:b] for ends in chunks.cut_points([t]) for a, b in zip([0, *ends], ends, strict=False)}
    assert len(cut(text) & cut(text[:100] + b"inserted" + text[100:])) >= len(cut(text)) - 4


def test_chunk_dedup_against_brute_force(docs, rows):
    cutting = chunks.Cutting()
    texts = sorted({(row[0] is not None, row[0] or 0, row[1] or "") for row in rows})
    cut = {t: [(a, b) for a, b in zip([0, *ends], ends, strict=False)] for t in texts for ends in chunks.cut_points([t[2].encode()], cutting)}
    hashes = {r.text: r.h for r in docs.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    seen, gone = set(), {t: [] for t in texts}
    for t in sorted(texts, key=lambda t: (t[0], t[1], hashes[t[2]])):
        for a, b in cut[t]:
            piece = t[2].encode()[a:b]
            if piece in seen:
                gone[t].append((a, b))
            seen.add(piece)
    expected = {}
    for t, spans in gone.items():
        runs = [run for run in chunks.merged(spans) if run["end"] - run["start"] >= cutting.least_run]
        expected[t] = chunks._without(t[2].encode(), runs)
    found = chunks.dedup_substrings(docs).collect()
    assert Counter((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == Counter(
        (row[0], *expected[row[0] is not None, row[0] or 0, row[1] or ""]) for row in rows
    )


def test_short_passages_and_short_copies_are_dropped(spark):
    rng = random.Random(12)
    noise = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 9))) for _ in range(n))
    passages = [noise(51) for _ in range(400)]
    texts = [f"{noise(40)} {passage} {noise(40)}" for passage in passages * 2] + ["a short text", "a short text", "other"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    removed = {r.row.doc_id: r.n_removed for r in chunks.dedup_substrings(docs).collect()}
    assert sum(removed[i] == 0 for i in range(400, 800)) <= 4
    assert [removed[i] for i in (800, 801, 802)] == [0, 12, 0]


def test_only_chunks_found_again_are_stored(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(chunks, "stored", lambda df: tables.append(stored(df)) or tables[-1])
    rng = random.Random(21)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(600)
    texts = [noise(4000) for _ in range(40)] + [noise(300) + passage + noise(300) for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    removed = {r.row.doc_id: r.n_removed for r in chunks.dedup_substrings(docs).collect()}
    pieces = Counter(t.encode()[a:b] for t in texts for ends in chunks.cut_points([t.encode()]) for a, b in zip([0, *ends], ends, strict=False))
    again = {piece: n for piece, n in pieces.items() if n > 1}
    assert 400 < removed[41] == sum(map(len, again)) and sum(removed.values()) == removed[41]
    assert sum(table.count() for table in tables) == sum(again.values()) < 40 < sum(pieces.values())


def test_nothing(nothing):
    assert repeats.drop_repeats(nothing).count() == 0 and chunks.dedup_substrings(nothing).count() == 0
