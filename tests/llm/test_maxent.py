"""The maximum-entropy model against plain Python."""

import math
import random
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from areaprice.llm import maxent
from areaprice.scratch import stored

SMALL = maxent.Shape(classes=4, members=6, pairs=32, followers=8, rounds=3, smoothing=3.0)


def tokens(text):
    return [*(text or "").encode("utf-8", "replace").lower().split(), b""]


def words_of(words):
    return pa.array(words, pa.binary())


def toy(spark, n=120, seed=4):
    """Sentences in two languages, so that a word tells the next."""
    rng = random.Random(seed)
    speech = [["the cat", "sat on", "a mat", "and slept"], ["der hund", "lief", "um das", "haus herum"]]
    texts = [" ".join(rng.choice(speech[i % 2]) for _ in range(rng.randint(1, 40))) for i in range(n)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def random_model(shape, seed=1):
    rng = np.random.default_rng(seed)
    weights = [rng.normal(0, 0.5, table).astype(np.float32) for table in shape.tables]
    shares = rng.dirichlet(np.ones(shape.classes)), rng.dirichlet(np.ones(shape.members), shape.classes)
    return maxent.Model(shape, *(share.astype(np.float32) for share in shares), weights)


def plain_log_p(model, history, symbol):
    """Natural logarithm of the probability of a symbol after all symbols before it."""
    shape = model.shape
    last, second = ([shape.symbols] * 2 + history)[-1], ([shape.symbols] * 2 + history)[-2]
    pair = (last * 40503 + second * 30011 + last * second % 8191) % shape.pairs
    rows = [last, second, pair]
    classes = [math.log(model.class_share[c]) + sum(model.weights[k][c, row] for k, row in enumerate(rows)) for c in range(shape.classes)]
    of, member = divmod(symbol, shape.members)
    rows = [of * shape.followers + last * 40503 % 65521 % shape.followers, of * (shape.classes + 1) + second // shape.members]
    members = [math.log(model.member_share[of, m]) + sum(model.weights[3 + k][m, row] for k, row in enumerate(rows)) for m in range(shape.members)]
    norm = [math.log(sum(map(math.exp, scores))) for scores in (classes, members)]
    return classes[of] - norm[0] + members[member] - norm[1]


def test_softmax_as_plain_python_does():
    words = tokens("a few words that come again and again a few times")
    model = random_model(SMALL)
    symbol = maxent.Symbols(SMALL, words[:7]).of(words_of(words))
    found = maxent.log_probabilities(SMALL, symbol, np.arange(len(symbol)), maxent.model_factors(model))
    expected = [plain_log_p(model, symbol[:i].tolist(), int(symbol[i])) for i in range(len(symbol))]
    assert found == pytest.approx(expected, abs=1e-5)
    for history in ([], [3], [3, 9, 20, 1]):
        assert sum(math.exp(plain_log_p(model, history, s)) for s in range(SMALL.symbols)) == pytest.approx(1, abs=1e-5)


def test_gradient_is_observed_less_expected():
    words = tokens("so it goes and so it goes on and on so it is")
    model = random_model(SMALL, seed=2)
    symbol, place = maxent.Symbols(SMALL, words[:7]).of(words_of(words)), np.arange(len(words))
    wanted = np.arange(len(words))
    seen = maxent.observed(SMALL, symbol, place, wanted)
    expects = maxent.expected(SMALL, symbol, place, wanted, maxent.model_factors(model))
    assert all(table.sum() == pytest.approx(len(words)) for table in [*seen, *expects])
    for number, table in enumerate(model.weights):
        for at in [np.unravel_index(np.argmax(seen[number]), table.shape), (0, 0), (1, 3)]:
            sides = []
            for by in (1e-2, -1e-2):
                table[at] += by
                sides.append(maxent.log_probabilities(SMALL, symbol, place, maxent.model_factors(model)).sum())
                table[at] -= by
            slope = (sides[0] - sides[1]) / 2e-2
            assert slope == pytest.approx(seen[number][at] - expects[number][at], abs=2e-2)


@pytest.mark.parametrize(("block", "piece", "common"), [(2 << 20, 1 << 20, 5), (300, 40, 1 << 17), (1, 1, 30)])
def test_scores_as_plain_python_does(spark, docs, rows, monkeypatch, block, piece, common):
    shape = replace(SMALL, common=common)
    monkeypatch.setattr(maxent, "BLOCK", block)
    monkeypatch.setattr(maxent, "PIECE", piece)
    if block < 1000:
        rows = [(*row[:1], (row[1] or "")[:600], *row[2:]) for row in rows]
        docs = spark.createDataFrame(rows, docs.schema).repartition(2)
    learned = F.col("row") % 3 != 0
    found = maxent.lm_scores(docs, learned, shape)
    train = Counter(token for row in rows if row[5] % 3 != 0 for token in tokens(row[1]))
    total, different = sum(train.values()), len(train)

    blocks = stored(maxent.tokenised(docs, learned))
    counts = maxent.word_counts(blocks)
    assert {bytes(word): n for word, n in counts.collect()} == train
    known = maxent.lexicon(counts, total, different, shape)
    model = maxent.learn(stored(maxent.encoded(blocks, known)), shape)
    mass = Counter()
    for word, n in train.items():
        mass[int(known.symbols.of(words_of([word]))[0])] += n + 1
    expected, single = [], set(known.symbols.single.to_pylist())
    for row in rows:
        words = tokens(row[1])
        symbols = known.symbols.of(words_of(words)).tolist()
        base = sum(math.log10((train[word] + 1) / (total + different + 1)) for word in words)
        score = 0.0
        for i, (word, symbol) in enumerate(zip(words, symbols)):
            score += plain_log_p(model, symbols[max(0, i - 2) : i], symbol) / math.log(10) if i < 700 else math.nan
            if word not in single:
                score += math.log10((train[word] + 1) / (mass[symbol] + 1))
        expected.append((row[0], row[5] % 3 != 0, len(words), sum(train[w] > 0 for w in words), total, base, score))
    got = found.select("row.doc_id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    order = lambda row: (row[0] is None, row[0] or 0, row[2], round(row[5], 3))
    got, expected = sorted(map(tuple, got), key=order), sorted(expected, key=order)
    assert [row[:5] for row in got] == [row[:5] for row in expected]
    assert [row[5] for row in got] == pytest.approx([row[5] for row in expected])
    for mine, plain in zip(got, expected):
        assert math.isnan(plain[6]) or mine[6] == pytest.approx(plain[6], rel=1e-4, abs=1e-4)


def test_learns_what_follows_what(spark):
    texts = toy(spark)
    found = maxent.lm_scores(texts, F.col("doc_id") % 5 != 0, SMALL)
    held = found.where(~F.col("learned")).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert held[0] / held[2] > held[1] / held[2] + 0.3
    blocks = stored(maxent.tokenised(texts, F.lit(True)))
    counts = maxent.word_counts(blocks)
    likelihood = []
    for rounds in (0, 1, 3):
        shape = maxent.Shape(classes=4, members=6, pairs=32, followers=8, rounds=rounds, rate=0.25, smoothing=3.0)
        known = maxent.lexicon(counts, 1, 1, shape)
        model = maxent.learn(stored(maxent.encoded(blocks, known)), shape)
        lists = [tokens(row["text"]) for row in texts.collect()]
        factors = maxent.model_factors(model)
        likelihood.append(sum(maxent.log_probabilities(SMALL, known.symbols.of(words_of(w)), np.arange(len(w)), factors).sum() for w in lists))
    assert likelihood[0] < likelihood[1] < likelihood[2] < 0


def test_the_same_however_rows_are_dealt(spark):
    texts = toy(spark, 40).coalesce(1)
    scores = [sorted(map(tuple, maxent.lm_scores(texts, F.lit(True), SMALL).select("row.doc_id", "score").collect())) for _ in range(2)]
    assert scores[0] == scores[1]


def test_nothing_to_score_and_nothing_learned(spark, docs, nothing):
    assert maxent.lm_scores(nothing, F.lit(True), SMALL).count() == 0
    found = maxent.lm_scores(docs, F.lit(None).cast("boolean"), SMALL).collect()
    assert len(found) == docs.count()
    for row in found:
        assert not row["learned"] and row["n_known"] == 0 and row["train_tokens"] == 0 and row["base_score"] == 0
        assert row["score"] < 0 and math.isfinite(row["score"])
    assert found[0]["row"].asDict().keys() == set(docs.columns) - {"text"}


def test_symbols_are_bounded_and_stable():
    head = [b"", b"the", b"of"]
    words = [f"w{i}".encode() for i in range(500)] + [b"x", *head]
    found = maxent.Symbols(SMALL, head).of(words_of(words))
    assert found.max() < SMALL.symbols and (found == maxent.Symbols(SMALL, head).of(words_of(words))).all()
    assert (found[100:] == maxent.Symbols(SMALL, head).of(words_of(words).slice(100))).all()
    assert len({*found[-3:].tolist()}) == 3 and not {*found[-3:].tolist()} & {*found[:-3].tolist()}
    assert (~maxent.Symbols(SMALL, head).is_shared()).sum() == 3
    assert maxent.Symbols(SMALL, []).of(words_of([])).tolist() == []


def test_sums_travel_whole():
    numbers = np.array([0, 1, -1, 255, -256, 2**62, -(2**62), 7], dtype=np.int64)
    assert maxent._unpacked(maxent._packed(numbers)).tolist() == numbers.tolist()
    assert len(maxent._packed(np.arange(-(1 << 15), 1 << 15))) < 3 << 16
