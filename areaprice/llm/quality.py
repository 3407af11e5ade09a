"""Quality rules: counts on each text, and its distance from what texts of its language look like.

DataFrame functions only; nothing here leaves the JVM.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import stored
from .rows import SPACE, WORD, computed_once, renamed, row_key, whole_row, whole_text, words

# Character classes of what words have beside lower-case letters, each character in one.
LOWER = r"[a-zß-öø-ÿ\p{Ll}]+"
CLASSES = {
    "upper": r"\p{Lu}+",
    "digit": r"\p{Nd}+",
    "symbol": r"[#*$%&|<>]+",
    "mark": r"[.,;:!?'\"()-]+",
}

# Frequent words of each language.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "with"),
    "de": ("der", "die", "und", "den", "von", "zu", "das", "mit", "ist", "nicht", "ein", "eine"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "une", "est", "que", "dans"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "del", "se", "las", "un", "con"),
}
VOCABULARY = tuple(sorted({word for listed in COMMON_WORDS.values() for word in listed}))

# For languages that are not listed, common words are learned: up to so many, each at least so large a share of the words
# of the language, if it has enough; a text is far if it is beyond that share of the distance of one with none of them.
LEARNED_WORDS = 12
LEARNED_SHARE = 0.005
LEAST_WORDS = 5000
FAR_SHARE = 0.95

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
HISTOGRAMS = ("classes", "common")


class Limits(NamedTuple):
    """Greatest distances from the nearest reference, and the sizes below which a histogram says too little."""

    class_distance: float = 0.3
    word_distance: float = 0.285
    min_chars: int = 200
    min_words: int = 100


def _length_without(text: Column, pattern: Column | str) -> Column:
    return F.char_length(F.regexp_replace(text, pattern, F.lit(""))).cast("long")


def learned_words(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> dict[str, list[str]]:
    """Most frequent words of letters in each language that is not listed and has :data:`LEAST_WORDS` words or more.

    None for a language whose words are all rarer than :data:`LEARNED_SHARE`, as where no white space parts them. Words
    are counted before the shuffle; at most ``1 / LEARNED_SHARE`` of each language come to the driver. The texts are not
    read where all languages are listed.
    """
    lang = F.col(lang_column).cast("string")
    unlisted = lang.isNotNull() & ~lang.isin(*COMMON_WORDS)
    if docs.where(unlisted).agg(F.count(F.lit(1))).first()[0] == 0:
        return {}
    spoken = docs.where(unlisted).select(lang.alias("lang"), F.explode(words(whole_text(text_column))).alias("word"))
    counts = stored(spoken.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).where(F.col("total") >= LEAST_WORDS)
    joined = counts.join(F.broadcast(totals), "lang")  # a row per language
    common = joined.where((F.col("n") >= LEARNED_SHARE * F.col("total")) & F.col("word").rlike(r"^[\p{L}\p{M}]+$"))
    found: dict[str, list[str]] = {row.lang: [] for row in totals.select("lang").collect()}
    for row in sorted(common.collect(), key=lambda row: (row.lang, -row.n, row.word)):
        if len(found[row.lang]) < LEARNED_WORDS:
            found[row.lang].append(row.word)
    return dict(sorted(found.items()))


def text_counts(docs: DataFrame, text_column: str = "text", learned: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Counts of :func:`quality` and two histograms of every whole text, beside ``row``, the other columns.

    ``classes`` counts the characters that are white space, lower-case letters, in each of :data:`CLASSES`, and
    others; ``common`` counts each word of :data:`VOCABULARY` and, last, all other words. ``learned`` has such a
    histogram for each language of :func:`learned_words`, in their order. Words are compared by 64-bit hashes. Steps are kept apart by :func:`computed_once`, and loops are over arrays, for written out they
    make code too long to be compiled.
    """
    others = docs.drop(text_column)
    rows = renamed(docs)
    text = whole_text(f"_doc{docs.columns.index(text_column)}")
    kept = [f"_doc{i}" for i, name in enumerate(docs.columns) if name != text_column]
    rows = rows.select(*kept, text.alias("text"))
    rows = computed_once(rows, words=F.array_remove(F.split("text", f"{SPACE}+", -1), ""))
    rows = computed_once(
        rows,
        hashes=F.transform("words", lambda word: F.xxhash64(word)),
        joined=F.array_join("words", ""),
        lines=F.split("text", "\n", -1),
        n_chars=F.char_length("text").cast("long"),
        n_words=F.size("words").cast("long"),
    ).drop("text", "words")
    hashed, n = F.col("hashes"), F.size("hashes")
    window = F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(hashed, i), F.get(hashed, i + 1), F.get(hashed, i + 2))
    )
    listed = F.array(*[F.xxhash64(F.lit(word)) for word in VOCABULARY])
    none = F.array().cast("array<bigint>")
    by_language = [F.concat(none, *[F.array(F.xxhash64(F.lit(word))) for word in known]) for known in (learned or {}).values()]
    any_learned = sorted({word for known in (learned or {}).values() for word in known})
    hits = F.filter(hashed, lambda h: h.isin(*[F.xxhash64(F.lit(word)) for word in any_learned])) if any_learned else none
    # Most texts have no line twice; only in others are the lines without a word told apart.
    with_word = F.filter("lines", lambda line: line.rlike(WORD))
    n_dup_lines = F.when(
        F.size(F.array_distinct("lines")) < F.size("lines"), F.size(with_word) - F.size(F.array_distinct(with_word))
    ).otherwise(0)
    rows = computed_once(
        rows,
        windows=F.when(n >= 3, window).otherwise(F.array().cast("array<bigint>")),
        known=F.transform(listed, lambda word: (n - F.size(F.array_remove(hashed, word))).cast("long")),
        word_chars=F.char_length("joined").cast("long"),
        residue=F.regexp_replace("joined", LOWER, ""),
        n_dup_lines=n_dup_lines.cast("long"),
        hits=hits,
    ).drop("hashes", "joined", "lines")
    # Windows by hash and place; those that have an equal neighbour occur twice or more.
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    size = F.char_length("residue").cast("long")
    patterns = F.array(*[F.lit(pattern) for pattern in CLASSES.values()])
    rows = computed_once(
        rows,
        placed=F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed),
        in_class=F.transform(patterns, lambda pattern: size - _length_without(F.col("residue"), pattern)),
        in_none=_length_without(F.col("residue"), "|".join(CLASSES.values())),
        n_lower=F.col("word_chars") - size,
    ).drop("windows", "residue")

    def equal(x: Column, neighbour: Column) -> Column:
        return F.coalesce(x["h"] == F.get(F.col("placed"), neighbour)["h"], F.lit(False))

    again = F.filter("placed", lambda x, i: equal(x, i - 1) | equal(x, i + 1))
    covered = F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    zero = F.lit(0).cast("long")
    total = lambda counts: F.aggregate(counts, zero, lambda a, x: a + x)

    def histogram(known: Column) -> Column:
        hits = F.col("hits")
        counts = F.transform(known, lambda word: (F.size(hits) - F.size(F.array_remove(hits, word))).cast("long"))
        return F.concat(counts, F.array(F.col("n_words") - total(counts)))

    learned_counts = F.transform(F.array(*by_language), histogram) if by_language else F.array().cast("array<array<bigint>>")
    rows = computed_once(
        rows,
        learned=learned_counts,
        n_symbols=F.get("in_class", F.lit(list(CLASSES).index("symbol"))),
        n_repeat_words=F.coalesce(F.size(F.array_distinct(covered)).cast("long"), zero),
        classes=F.concat(F.array(F.col("n_chars") - F.col("word_chars"), "n_lower"), "in_class", F.array("in_none")),
        common=F.concat("known", F.array(F.col("n_words") - total(F.col("known")))),
    )
    struct = F.struct(*[F.col(place).alias(name) for place, name in zip(kept, others.columns, strict=True)])
    return rows.select(struct.alias("row"), "n_chars", *COUNTS, *HISTOGRAMS, "learned")


class Reference(NamedTuple):
    """Shares of the bins of either histogram in all texts of a language; ``place`` in ``learned``, if it is not listed."""

    classes: list[float]
    common: list[float]
    place: int | None = None


def references(
    counted: DataFrame,
    languages: Sequence[str] = tuple(COMMON_WORDS),
    lang_column: str = "lang",
    learned: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, Reference]:
    """References from all documents of the given and the learned languages; one without a word in any document has none.

    ``counted`` comes from :func:`text_counts`. One aggregate with a row per language and bin comes to the driver,
    as many whatever the size of the data.
    """
    lang = F.col("row")[lang_column].cast("string")
    places = {language: place for place, language in enumerate(learned or {})}
    common = F.col("common")
    if places:
        place = F.element_at(F.create_map(*[F.lit(part) for pair in places.items() for part in pair]), lang)
        common = F.when(lang.isin(*places), F.get("learned", place)).otherwise(common)
    histograms = counted.where(lang.isin(*languages, *places)).select(lang.alias("lang"), F.concat("classes", common).alias("ns"))
    bins = histograms.select("lang", F.posexplode("ns").alias("bin", "n"))
    sums: dict[str, dict[int, int]] = {}
    for language, place, n in bins.groupBy("lang", "bin").agg(F.sum("n")).collect():
        sums.setdefault(language, {})[place] = n
    n_classes = len(CLASSES) + 3
    found = {}
    for language, by_place in sorted(sums.items()):
        counts = [by_place[place] for place in sorted(by_place)]
        parts = counts[:n_classes], counts[n_classes:]
        if all(sum(part) for part in parts):
            found[language] = Reference(*[[n / sum(part) for n in part] for part in parts], places.get(language))
    return found


def js_distance(shares: Column, reference: Sequence[float]) -> Column:
    """Jensen-Shannon distance, 0 to 1, between the shares of two histograms; NULL if the first is."""
    zero = F.lit(0.0)

    def part(p: Column, q: Column) -> Column:
        own = F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(zero)
        return own + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(zero)

    parts = F.zip_with(shares, F.array(*[F.lit(float(share)) for share in reference]), part)
    return F.sqrt(F.greatest(F.aggregate(parts, zero, lambda a, x: a + x) / 2, zero))


def distance_without_words(common: Sequence[float]) -> float:
    """Jensen-Shannon distance from a reference of common words, the last of all others, of a text that has none of them."""
    rest = common[-1]
    own = math.log2(2 / (1 + rest))
    theirs = sum(common[:-1]) + (rest * math.log2(2 * rest / (1 + rest)) if rest else 0)
    return math.sqrt(max((own + theirs) / 2, 0))


def quality(counted: DataFrame, known: Mapping[str, Reference], limits: Limits = Limits(), lang_column: str = "lang") -> DataFrame:
    """Verdict on every row of :func:`text_counts`, given references of languages.

    Returns ``row`` (a struct of the document's columns but the text) and:

    * ``n_words``, ``word_chars`` (characters in words), ``n_symbols``, ``n_dup_lines`` (lines with a word, equal to
      an earlier line), ``n_repeat_words`` (words in three-word windows found twice or more);
    * ``base_failed``: fewer than 50 words, or more than half of them repeated;
    * ``class_distance`` and ``word_distance``: Jensen-Shannon distance of the character-class and the common-word
      histogram from the nearest of the ``known`` languages; NULL without a character or word, or a reference;
    * ``kept``: not ``base_failed``, and neither distance above its limit. A distance counts only for texts of at
      least ``min_chars`` characters or ``min_words`` words, below which histograms say little, and only where the
      document's own ``lang`` has a reference: without, nothing tells a clean text from a bad one.

    The limit of the word distance is that of ``limits`` for the listed languages, and :data:`FAR_SHARE` of
    :func:`distance_without_words` for each learned one; a text is far if it is beyond the limit of every language. So a
    document of one language that is labelled as another is compared with both. A null text has no words. Each
    row is judged alone: rows that repeat give rows that repeat, an empty table gives none.
    """
    zero = F.lit(0).cast("long")
    shared = computed_once(
        counted,
        all_classes=F.aggregate("classes", zero, lambda a, n: a + n),
        all_common=F.aggregate("common", zero, lambda a, n: a + n),
    )
    shared = computed_once(
        shared,
        class_shares=F.when(F.col("all_classes") > 0, F.transform("classes", lambda n: n / F.col("all_classes"))),
        common_shares=F.when(F.col("all_common") > 0, F.transform("common", lambda n: n / F.col("all_common"))),
    )

    def nearest(distances: list[Column]) -> Column:
        return F.array_min(F.array(*distances)) if distances else F.lit(None).cast("double")

    listed = [reference for reference in known.values() if reference.place is None]
    # A learned language without common words has a reference of characters alone.
    learned = [reference for reference in known.values() if reference.place is not None and len(reference.common) > 1]

    def learned_distance(reference: Reference) -> Column:
        shares = F.transform(F.get("learned", F.lit(reference.place)), lambda n: n / F.col("all_common"))
        return F.when(F.col("all_common") > 0, js_distance(shares, reference.common))

    judged = computed_once(
        shared,
        class_distance=nearest([js_distance(F.col("class_shares"), reference.classes) for reference in known.values()]),
        listed_distance=nearest([js_distance(F.col("common_shares"), reference.common) for reference in listed]),
        learned_distances=F.array(*[learned_distance(reference) for reference in learned]).cast("array<double>"),
        base_failed=(F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    ).withColumn("word_distance", F.least("listed_distance", F.array_min("learned_distances")))
    beyond = [F.col("listed_distance") > limits.word_distance] if listed else []
    for i, reference in enumerate(learned):
        beyond.append(F.get("learned_distances", F.lit(i)) > FAR_SHARE * distance_without_words(reference.common))
    far_words = functools.reduce(Column.__and__, beyond) if beyond else F.lit(False)
    lang = F.col("row")[lang_column].cast("string")
    with_words = [language for language, reference in known.items() if reference.place is None or len(reference.common) > 1]
    far = (lang.isin(*known) & (F.col("n_chars") >= limits.min_chars) & (F.col("class_distance") > limits.class_distance)) | (
        lang.isin(*with_words) & (F.col("n_words") >= limits.min_words) & far_words
    )
    kept = ~F.col("base_failed") & ~F.coalesce(far, F.lit(False))
    return judged.select("row", *COUNTS, "base_failed", "class_distance", "word_distance", kept.alias("kept"))


def judged(docs: DataFrame, limits: Limits = Limits(), lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """:func:`quality` of all documents against references from all of them.

    The texts are read once, those of languages that are not listed before that for :func:`learned_words`.
    """
    learned = learned_words(docs, lang_column, text_column)
    counted = stored(text_counts(docs, text_column, learned))
    return quality(counted, references(counted, lang_column=lang_column, learned=learned), limits, lang_column)


def keep_good(docs: DataFrame, limits: Limits = Limits(), id_column: str = "doc_id", lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """The documents that :func:`judged` keeps, with all their columns.

    Rows that repeat an id, a text or both are judged each by its text and language, and stay each or go each.
    """

    def key() -> Column:
        lang = F.coalesce(F.concat(F.lit("="), F.col(lang_column).cast("string")), F.lit(""))
        return F.concat_ws(":", row_key(F.col(id_column), F.col(text_column)), lang).alias("key")

    narrow = docs.select(key(), F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    keys = judged(narrow, limits).where("kept").select("row.key").distinct()
    return docs.select(whole_row(docs), key()).join(keys, "key", "left_semi").select("row.*")
