import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, kept string, size int, text_hash string"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def prose(rng, n_words, lines=9):
    words = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 9))) for _ in range(n_words)]
    return " ".join(word + ("\n" if rng.random() < 1 / lines else "") for word in words)


def awkward_texts(rng):
    """Missing, empty, blank, tiny, odd and very long texts, copies of all sorts."""
    base = prose(rng, 200)
    return [
        None,
        "",
        " \t\n\x0b\x0c\r ",
        "x",
        "a b c",
        "\x00\x1f control",
        "Ünïcode ÀÉ ß 漢字 \U0001f600    ",
        base,
        base,
        base.upper(),
        base.replace(" ", "  ", 3),
        base + " tail",
        "head " + base,
        prose(rng, 5000),
        "same " * 3000,
        "z" * 20000,
        "ab" * 700,
        prose(rng, 60) + base[100:800] + prose(rng, 60),
        prose(rng, 30) + "\n" + base[100:800],
    ]


@pytest.fixture(scope="package")
def rows():
    """Documents with columns that clash with what operators add, rows that repeat, ids that are null or repeat."""
    rng = random.Random(5)
    texts = awkward_texts(rng)
    made = [
        (i, text, (None, "en", "de")[i % 3], (None, "b", "a", "ä", "Z")[i % 5], len(text or ""), i, "k", 1, "h")
        for i, text in enumerate(texts)
    ]
    made += [made[7], made[7], made[1], (None, texts[7], "en", "a", 1, 0, "k", 1, "h"), (3, texts[13][:999], None, None, 1, 0, "k", 1, "h")]
    return made


@pytest.fixture(scope="package")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="package")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
