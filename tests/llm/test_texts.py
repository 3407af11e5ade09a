"""Packing, personal data, quality, language and token counts."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from areaprice.llm import language, mixing, packing, pii, quality, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# Packing


def test_ids_are_those_of_the_vocabulary_file(rows):
    theirs = Tokenizer.from_file(BPE)
    texts = [row[1] or "" for row in rows]
    texts += ["a<|endoftext|> b<|endoftext|>", " " * 5000 + "x", "\n\n  \n", "it's IT'S 12345 !?", "a" * 5000, "ab́ ퟿"]
    for text in texts:
        ids = np.frombuffer(b"".join(p[2] for p in packing._pieces(packing.encoding(BPE), text, 2, 1024)), dtype="<u4")
        assert ids.tolist() == [*theirs.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("run", [" " * 2_000_000, "\n" * 2_000_000, " \n\u3000\x85" * 300_000, "\x1c" * 100_000 + "\t" * 1_100_000])
def test_ids_of_very_long_white_space(run):
    theirs = Tokenizer.from_file(BPE)
    for text in (run, f"head{run}tail", f"{run}\n5", f"a {run}<|endoftext|>{run}<|endoftext|>'s"):
        assert packing._ids(packing.encoding(BPE), text) == theirs.encode(text, add_special_tokens=False).ids


def test_packed_sequences_hold_every_piece_once(docs, rows):
    theirs = Tokenizer.from_file(BPE)
    pieces = packing.tokenized_pieces(docs.select("doc_id", "n_chars", "text"), BPE, capacity=256)
    placed = packing.pack(pieces, capacity=256)
    found = placed.collect()
    expected = Counter()
    for row in rows:
        ids = [*theirs.encode(row[1] or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 256 or 256
        cuts = [0, *range(first, len(ids) + 1, 256)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            raw = np.array(ids[a:b], dtype="<u4").tobytes()
            expected[row[0], piece, a, b - a, raw, zlib.crc32(raw)] += 1
    assert Counter((r.row.doc_id, r.piece, r.start, r.length, bytes(r.ids), r.ids_crc32) for r in found) == expected
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
    for members in by_sequence.values():
        members.sort()
        assert [m[0] for m in members] == [sum(m[1] for m in members[:i]) for i in range(len(members))]
        assert sum(m[1] for m in members) <= 256
    total = sum(r.length for r in found)
    assert len(by_sequence) == max(by_sequence) + 1 <= total / 256 * 1.03
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(placed).collect()}
    assert whole == {number: b"".join(m[2] for m in members) for number, members in by_sequence.items()}


def slow_best_two_fit(lengths, capacity):
    """One bin after the other, item by item."""
    left = sorted(lengths, reverse=True)
    bins = []
    while left:
        bin_, gap = [], capacity
        while any(n <= gap for n in left):
            n = next(n for n in left if n <= gap)
            left.remove(n)
            bin_.append(n)
            gap -= n
        room = gap + min(bin_)
        pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1 :] if a + b <= room]
        if gap and pairs and max(pairs)[0] > min(bin_):
            # Put in before the smallest is given back, so they are two others.
            smallest = min(bin_)
            best = max(pairs)[0]
            _, a, b = min((p for p in pairs if p[0] == best), key=lambda p: min(p[1:]))
            for n in (a, b):
                left.remove(n)
            bin_ = [*bin_[: bin_.index(smallest)], *bin_[bin_.index(smallest) + 1 :], a, b]
            left = sorted([*left, smallest], reverse=True)
        bins.append(tuple(sorted(bin_, reverse=True)))
    return bins


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=40))
def test_best_two_fit_in_bulk_equals_item_by_item(lengths):
    counts = np.bincount(lengths, minlength=25) if lengths else np.zeros(25, dtype=np.int64)
    made = [bin_ for bin_, n in packing.best_two_fit(counts, 24) for _ in range(n)]
    assert Counter(n for bin_ in made for n in bin_) == Counter(lengths)
    assert all(sum(bin_) <= 24 for bin_ in made)
    assert Counter(made) == Counter(slow_best_two_fit(lengths, 24))


def test_lengths_must_fit(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(5,), (0,)], "length long"), 10)
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(None,), (3,)], "length long"), 10)


# Personal data


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def digits(text):
    return re.sub("[^0-9]", "", text)


PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
}

TOUGH = [
    "a@b.c_d@e.f x@y a@b..c é@x.y user.name+tag@sub-1.example.org.",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 00001.2.3.255 1.2.3 999999999999999999999.1.1.1 12.34.56.78.9",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111 4111  1111 1111 1111 0000 0000 0000 0000 000",
    "+1 (555) 010-9999 +49.30.1234567 ++4412345678 +1 +12 +1234567 +123456789012345678 (+44 20 7946 0958)",
    "\U0001f600 漢字 a@b.cc \U0001f600 +15550109999 4111111111111111\n192.168.0.1",
    "@" * 50 + "a@" * 300 + "b.c" + ".d" * 4000,
    "7" * 30000 + " " + "1.1." * 3000 + " +" + "1 " * 2000,
    "a" * 60000,
]


def plain_spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, (pattern, valid) in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if valid(m[0])
    ]


def random_data(rng):
    parts = ["a@b.c", "@", ".", "-", " ", "+1", "555", "4111111111111111", "1.2.3.4", "é", "(", ")", "_", "x", "0", "12"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))


def test_base_spans_against_plain_patterns(spark, rows):
    rng = random.Random(9)
    texts = [row[1] for row in rows] + TOUGH + [random_data(rng) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, spans int")
    base = [kind.name for kind in pii.KINDS if kind.base]
    assert base == list(PLAIN)
    for row in pii.find_personal_data(docs).collect():
        found = [(s.kind, s.start, s.end) for s in row.spans if s.kind in base]
        assert found == plain_spans(texts[row.row.doc_id]), texts[row.row.doc_id][:80]
        assert all(s.value == texts[row.row.doc_id][s.start : s.end] and 0 < s.score <= 1 for s in row.spans)


def test_checksums_and_context(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00, GB82WEST12345698765432.",
        "IBAN DE89 3704 0044 0532 0130 01",
        "my ssn is 123-45-6789",
        "part 123-45-6789",
        "SSN 000-45-6789 and 123-00-6789",
        "call (555) 010-9999 now",
        "see 555 010 9999",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.row.doc_id: [(s.kind, s.value) for s in r.spans if s.kind not in PLAIN] for r in pii.find_personal_data(docs).collect()}
    assert found[0] == [("account", "DE89 3704 0044 0532 0130 00"), ("account", "GB82WEST12345698765432")]
    assert found[2] == [("security_number", "123-45-6789")] and found[5] == [("local_phone", "(555) 010-9999")]
    assert not any(found[i] for i in (1, 3, 4, 6))
    hidden = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert hidden[2] == "my ssn is " + "█" * 11 and hidden[3] == texts[3]


# Quality


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_counts_against_brute_force(spark, docs, rows):
    rng = random.Random(2)
    more = [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 90))) for _ in range(60)]
    more += ["\n".join(rng.choice(["a b", "", " ", "#|<>", "c"]) for _ in range(30)) for _ in range(20)]
    made = spark.createDataFrame([(i, t, "en", 5) for i, t in enumerate(more)], "doc_id int, text string, lang string, n_words int")
    for table, texts in ((docs, [row[1] for row in rows]), (made, more)):
        found = quality.judged(table).collect()
        assert Counter((*[r[name] for name in quality.COUNTS], r.base_failed) for r in found) == Counter(map(slow_counts, texts))
        assert not any(r.kept and r.base_failed for r in found)
    kept = quality.keep_good(docs)
    verdicts = Counter(r.row.asDict()["row"] for r in quality.judged(docs).where("kept").collect())
    assert kept.columns == docs.columns and Counter(r["row"] for r in kept.collect()) == verdicts


def test_no_row_that_is_good_goes(spark):
    rng = random.Random(1)
    good = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(200))
    made = [("null", good, "a"), (None, good, "b"), (None, good, "c"), ("x", good, "d"), ("x", good, "e"), ("x", "too short", "f")]
    docs = spark.createDataFrame([(*row, None) for row in made], "doc_id string, text string, url string, lang string")
    assert sorted(r.url for r in quality.keep_good(docs).collect()) == list("abcde")


def test_divergence_from_the_language(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
    sentence = lambda: " ".join(rng.choice(["the", "of", "and", "in", word(), word(), word()]) for _ in range(200)) + "."
    good = [sentence() for _ in range(30)]
    symbols = " ".join(f"{word()}{rng.choice('#*$%&|<>') * 4}" for _ in range(200))
    names = " ".join(word() for _ in range(200))
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*good, symbols, names])], "doc_id int, text string, lang string")
    kept = {r.row.doc_id: r.kept for r in quality.judged(docs).collect()}
    assert all(kept[i] for i in range(30)) and not kept[30] and not kept[31]


def test_languages_without_listed_words(spark):
    rng = random.Random(6)
    made = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 8)))
    latin, cyrillic, han = "etaoinshrdlu", "абвгдежзиклмнопрст", [chr(0x4E00 + i) for i in range(800)]
    prose = lambda common, letters, n=200: " ".join(rng.choice([*common, *[made(letters) for _ in common]]) for _ in range(n))
    good = [("en", prose(["the", "of", "and", "in"], latin)) for _ in range(30)]
    good += [("it", prose(["il", "che", "non", "per"], latin)) for _ in range(40)]
    good += [("ru", prose(["и", "не", "что", "это"], cyrillic)) for _ in range(40)]
    good += [("zh", prose(["，"], han)) for _ in range(40)]
    good += [("few", prose(["jy", "wo", "ek"], latin)), (None, prose(["il", "che", "non"], latin)), ("en", prose(["il", "che", "non", "per"], latin))]
    bad = [("it", " ".join(made(latin) for _ in range(200))), ("ru", " ".join(made(cyrillic) for _ in range(200)))]
    bad += [("it", " ".join(f"{made(latin)}{rng.choice('#*$%&|<>') * 9}" for _ in range(200)))]
    docs = spark.createDataFrame([(i, lang, text) for i, (lang, text) in enumerate(good + bad)], "doc_id int, lang string, text string")
    kept = {r.row.doc_id: r.kept for r in quality.judged(docs).collect()}
    assert [i for i in range(len(good)) if not kept[i]] == []
    assert [i for i in range(len(good), len(good + bad)) if kept[i]] == []
    assert quality.keep_good(docs).count() == len(good)


def test_distance_is_that_of_jensen_and_shannon(spark):
    row = spark.range(1).select(
        quality.js_distance(F.array(F.lit(0.5), F.lit(0.5), F.lit(0.0)), [0.0, 0.5, 0.5]).alias("a"),
        quality.js_distance(F.array(F.lit(1.0), F.lit(0.0)), [0.0, 1.0]).alias("b"),
        quality.js_distance(F.array(F.lit(0.25), F.lit(0.75)), [0.25, 0.75]).alias("c"),
    ).first()
    assert row.a == pytest.approx(0.5**0.5) and row.b == 1.0 and row.c == 0.0


# Mixing


def test_mix_meets_its_targets(docs, rows):
    found = mixing.mix(docs).collect()
    sizes = Counter(len((row[1] or "").encode().split()) for row in rows)
    assert Counter(r["size"] for r in found) == sizes
    by_source = {}
    for r in found:
        assert r.taken == r.copies * r["size"] + sum(p.n for p in r.parts) <= 2 * r["size"]
        by_source.setdefault(r.source, []).append(r)
    total = sum(r["size"] for r in found)
    targets = slow_targets({s: sum(r["size"] for r in own) for s, own in by_source.items()}, total)
    for source, own in by_source.items():
        assert {r.source_size for r in own} == {sum(r["size"] for r in own)}
        assert len({r.target for r in own}) == 1 and own[0].target == pytest.approx(targets[source])
        assert abs(sum(r.taken for r in own) - targets[source]) <= mixing.BLOCK_WORDS
    again = mixing.mix(docs.repartition(7)).collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in found)


def slow_targets(sizes, total):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weights = {source: (5, 2, 1)[i % 3] for i, source in enumerate(order)}
    capped = set()
    while True:
        free = [s for s in order if s not in capped]
        rate = (1.5 * total - sum(2 * sizes[s] for s in capped)) / sum(weights[s] for s in free) if free else 0
        over = {s for s in free if rate * weights[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in capped else rate * weights[s] for s in order}
        capped |= over


def test_mixed_rows_have_the_taken_words(docs):
    unique = docs.dropDuplicates(["doc_id"]).where("doc_id is not null")
    mixed = mixing.mix(unique, shard_words=500)
    rows = mixing.mixed_rows(unique, mixed, computed={"n_chars": lambda text: F.char_length(text).cast("long")})
    assert rows.columns == unique.columns
    words = Counter()
    for row in rows.collect():
        assert row.n_chars == len(row.text)
        words[row.doc_id] += len(row.text.encode().split())
    assert words == +Counter({r.doc_id: r.taken for r in mixed.collect()})


def slow_quotas(wanted, n):
    seats = [0] * len(wanted)
    for _ in range(n):
        best = max(range(len(wanted)), key=lambda i: (wanted[i] / (2 * seats[i] + 1), -seats[i], -i))
        seats[best] += 1
    return seats


@pytest.mark.parametrize("seed", range(4))
def test_block_quotas_are_the_highest_quotients(spark, seed):
    rng = random.Random(seed)
    wanted = [float(rng.choice([0, 1, 50, 64, 100, 333, 5000]) + rng.randint(0, 3)) for _ in range(25)]
    for extra in (0, 4, -4):
        n = max(0, int(sum(wanted) / 64 + 0.5) + extra)
        cells = spark.createDataFrame([(0, i, w) for i, w in enumerate(wanted)], "place long, shard long, wanted double")
        found = {r.shard: r.blocks for r in mixing.block_quotas(cells, n).collect()}
        assert [found[i] for i in range(25)] == slow_quotas(wanted, n)


# Language


def test_gradient_is_that_of_the_likelihood():
    """Marginals and pairs against sums over all label sequences."""
    rng = np.random.default_rng(0)
    scores, transitions, start = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    mask = np.array([[True, True, True, False]])
    marginal, pairs = language.forward_backward(scores, mask, transitions, start)
    expected, expected_pairs, total = np.zeros((3, 3)), np.zeros((3, 3)), 0.0
    for labels in np.ndindex(3, 3, 3):
        energy = start[labels[0]] + sum(scores[0, t, label] for t, label in enumerate(labels))
        weight = np.exp(energy + sum(transitions[a, b] for a, b in zip(labels, labels[1:], strict=False)))
        total += weight
        for t, label in enumerate(labels):
            expected[t, label] += weight
        for a, b in zip(labels, labels[1:], strict=False):
            expected_pairs[a, b] += weight
    assert marginal[0, :3] == pytest.approx(expected / total) and pairs == pytest.approx(expected_pairs / total)
    model = language.Model(["a", "b", "c"], np.zeros((1, 3)), transitions, start)
    assert language._marginals(scores, mask, model)[0, :3] == pytest.approx(expected / total)


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return docs.where(~held_out), docs.where(held_out)


@pytest.fixture(scope="module")
def model(labelled):
    return language.learn(labelled[0], language.Training(documents=400, rounds=25))


def test_held_out_accuracy(labelled, model):
    found = language.predict(labelled[1].select("lang", "text"), model).collect()
    assert np.mean([r.row.lang == r.lang_pred for r in found]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_words_of_mixed_text(spark, labelled, model):
    texts = {r.lang: r.text for r in labelled[1].where("length(text) > 400").collect()}
    parts = [(lang, texts[lang].split()[:15]) for lang in ("en", "fr", "de")]
    mixed = spark.createDataFrame([(" ".join(word for _, words in parts for word in words),)], "text string").withColumn("i", F.lit(1))
    row = language.predict(mixed, model, word_labels=True).first()
    truth = [lang for lang, words in parts for _ in words]
    assert np.mean([a == b for a, b in zip(row.labels, truth, strict=True)]) > 0.85


def test_language_of_awkward_texts(spark, docs, rows, model, nothing):
    found = language.predict(docs, model).collect()
    assert len(found) == len(rows)
    letters = Counter(any(map(str.isalpha, row[1] or "")) for row in rows)
    assert Counter(r.lang_pred != language.UNKNOWN for r in found) == letters
    assert all(r.score == 0 for r in found if r.lang_pred == language.UNKNOWN)
    assert language.predict(nothing, model).count() == 0
    empty = language.learn(nothing)
    assert {(r.lang_pred, r.score) for r in language.predict(docs, empty).collect()} == {("und", 0.0)}


# Token counts


def slow_pieces(pieces, word):
    text, n = "▁" + word, 0
    while text:
        size = next((k for k in range(len(text), 0, -1) if text[:k] in pieces), 0)
        n += 1 if size else len(text[0].encode())
        text = text[max(size, 1) :]
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("ab▁é", min_size=1, max_size=6), max_size=12), st.text("abcé▁", max_size=14))
def test_automaton_equals_greedy_match(pieces, word):
    assert token_counts.LongestMatch(pieces).count(word) == slow_pieces(pieces, word)


def test_token_counts(docs, rows):
    pieces = token_counts.vocabulary_pieces(PIECES)
    expected = Counter()
    for row in rows:
        words = [word.decode() for word in (row[1] or "").encode().split()]
        times = Counter(words)
        expected[row[0], len(words), sum(n * slow_pieces(pieces, w[:]) for w, n in times.items() if len(w) < 3000)] += 1
    found = token_counts.token_counts(docs.where("length(text) <> 20000 or text is null"), PIECES).collect()
    long = next(row for row in rows if row[1] and len(row[1]) == 20000)
    expected[long[0], 1, 0] -= 1
    assert Counter((r.row.doc_id, r.n_words, r.n_tokens) for r in found) == +expected


def test_nothing(nothing):
    assert packing.pack(packing.tokenized_pieces(nothing, BPE)).count() == 0
    assert pii.find_personal_data(nothing).count() == 0 and token_counts.token_counts(nothing, PIECES).count() == 0
    assert quality.judged(nothing).count() == 0 and quality.keep_good(nothing).count() == 0
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_rows(nothing, mixing.mix(nothing)).count() == 0


def test_language_sample_without_ids(spark, monkeypatch):
    """Rows without an id are told apart by their texts, and copies of a text count once."""
    seen = []
    monkeypatch.setattr(language, "fit", lambda spans, training: seen.append(spans))
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(40)) for _ in range(1500)] + ["same words " * 20] * 1500
    docs = spark.createDataFrame([(None, "xy"[i % 2], text) for i, text in enumerate(texts)], "doc_id long, lang string, text string")
    language.learn(docs, language.Training(documents=600, spans=2))
    assert 400 < len(seen[0]) < 1400 and sum(b"same" in span for _, span in seen[0]) <= 4
    with pytest.raises(ValueError, match="More than 1 labels"):
        language.learn(docs, language.Training(labels=1))
