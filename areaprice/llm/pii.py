"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their scores.

DataFrame functions only; nothing here leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import computed_once, renamed, renamed_row, whole_text

SPANS = "array<struct<start:int,end:int,value:string>>"
# Characters before and after a span in which context words count.
BEFORE, AFTER = 48, 24
CONTEXT_BONUS = 0.4
THRESHOLD = 0.5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def weighed(i: Column) -> Column:
        digit = F.substr(digits, -i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, digit).otherwise(2 * digit - F.when(digit > 4, 9).otherwise(0))

    places = F.sequence(F.lit(1), F.char_length(digits))
    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an international account number (capitals and digits) leaves 1 when divided by 97."""
    turned = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))

    def shifted(rest: Column, i: Column) -> Column:
        symbol = F.substr(turned, i, F.lit(1))
        number = F.when(symbol.between("0", "9"), symbol.cast("int")).otherwise(F.ascii(symbol) - 55)
        return (rest * F.when(number > 9, 100).otherwise(10) + number) % 97

    places = F.sequence(F.lit(1), F.char_length(turned))
    return F.aggregate(places, F.lit(0), shifted) == 1


def _small_parts(value: Column) -> Column:
    def small(part: Column) -> Column:
        number = F.regexp_replace(part, "^0+", "")
        return (F.char_length(number) <= 3) & (F.coalesce(number.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(value, r"\."), small)


def _card(value: Column) -> Column:
    digits = _digits(value)
    return F.char_length(digits).between(16, 19) & luhn(digits)


def _account(value: Column) -> Column:
    code = F.regexp_replace(value, " ", "")
    return F.char_length(code).between(15, 34) & mod97(code)


def _security_number(value: Column) -> Column:
    return ~value.rlike("^(000|666|9)") & ~value.rlike("-00-") & ~value.rlike("-0000$")


class Kind(NamedTuple):
    """How spans of a kind are found: guard (a substring or pattern without which there is none), pattern,
    validator, score, and words that add to the score. A base kind keeps all valid spans, whatever the score."""

    name: str
    guard: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True


# Patterns match what their plain forms do: a run is entered at its start only (or where the last match ended)
# and never given back, so that a text is read once however long its runs are.
KINDS = (
    Kind(
        "email",
        "@",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda value: F.lit(True),
        0.9,
        "mail|contact|write",
    ),
    Kind("ip", ".", r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", _small_parts, 0.6, "ip|host|server|address|login"),
    Kind("card", "", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", _card, 0.8, "card|visa|credit|debit|payment|pay"),
    Kind(
        "phone",
        "+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda value: F.char_length(_digits(value)).between(8, 15),
        0.7,
        "phone|call|tel|mobile|fax|whatsapp",
    ),
    Kind("account", "", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", _account, 0.9, "iban|account|bank", False),
    Kind(
        "security_number",
        "-",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        _security_number,
        0.3,
        "ssn|social|security|taxpayer",
        False,
    ),
    Kind(
        "local_phone",
        "",
        r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
        lambda value: F.lit(True),
        0.3,
        "phone|call|tel|mobile|fax|whatsapp",
        False,
    ),
)


def _located(matches: Column, gaps: Column) -> Column:
    """Spans of matches, in code points, from the matches and the texts before them."""
    pairs = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.struct(m.alias("m"), g.alias("g")))

    def after(done: Column, pair: Column) -> Column:
        start = done["at"] + F.char_length(pair["g"])
        end = start + F.char_length(pair["m"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    return F.aggregate(pairs, start, after, lambda done: done["spans"])


def _confirmed(kind: Kind) -> Column:
    return F.filter(f"{kind.name}_s", lambda span: kind.valid(span["value"]))


def _scored(kind: Kind, text: Column, spans: Column) -> Column:
    """Spans with their kind and score; of kinds that are not base, those whose score reaches the threshold."""

    def scored(span: Column) -> Column:
        from_ = F.greatest(span["start"] - BEFORE, F.lit(0))
        before = F.substr(text, from_ + 1, span["start"] - from_)
        near = F.lower(F.concat(before, F.lit(" "), F.substr(text, span["end"] + 1, F.lit(AFTER))))
        bonus = F.when(near.rlike(f"(?<![a-z])(?:{kind.context})"), CONTEXT_BONUS).otherwise(0.0)
        score = F.least(F.lit(kind.score) + bonus, F.lit(1.0))
        return F.struct(F.lit(kind.name).alias("kind"), span["start"], span["end"], span["value"], score.alias("score"))

    found = F.transform(spans, scored)
    return found if kind.base else F.filter(found, lambda span: span["score"] >= THRESHOLD)


def find_personal_data(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Spans of personal data in every whole text.

    Returns ``row`` (a struct of the document's columns) and ``spans``: ``kind, start, end`` (code points, end
    exclusive), ``value`` and ``score``, kinds in the order of :data:`KINDS`, then by start. Spans of a kind do
    not overlap, those of different kinds may. Base kinds (email, ip, card, phone) are all matches that pass
    their check; accounts must pass mod-97, and security numbers and local phones need a context word nearby.

    A null or empty text has no spans. Each row is read alone, so rows that repeat give the same spans; an empty
    table gives no rows. Work per row grows with the length of the text, and with the square of the number of
    matches in it, by a tiny factor (a copied reference).
    """
    text = whole_text(f"_doc{docs.columns.index(text_column)}")
    rows = computed_once(renamed(docs).withColumn("text", text), digits=F.col("text").rlike("[0-9]"))
    text = F.col("text")

    def possible(kind: Kind) -> Column:
        found = text.contains(kind.guard) if kind.guard else F.lit(True)
        return found if kind.name == "email" else F.col("digits") & found

    none = F.array().cast("array<string>")
    rows = computed_once(
        rows,
        **{
            f"{kind.name}_m": F.when(possible(kind), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))).otherwise(none)
            for kind in KINDS
        },
    )
    rows = computed_once(
        rows,
        **{
            f"{kind.name}_g": F.when(F.size(f"{kind.name}_m") > 0, F.split(text, kind.pattern, -1)).otherwise(none)
            for kind in KINDS
        },
    )
    rows = computed_once(rows, **{f"{k.name}_s": _located(F.col(f"{k.name}_m"), F.col(f"{k.name}_g")) for k in KINDS})
    rows = rows.select(
        *[f"_doc{i}" for i in range(len(docs.columns))],
        "text",
        *[_confirmed(kind).alias(kind.name) for kind in KINDS],
    )
    parts = [_scored(kind, text, F.col(kind.name)) for kind in KINDS]
    return computed_once(rows, spans=reduce(F.concat, parts)).select(renamed_row(docs), "spans")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, separated by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(names: list[str]) -> Column:
    """The ``spans`` of some kinds."""
    return F.filter("spans", lambda span: span["kind"].isin(names))


def redact(docs: DataFrame, text_column: str = "text", mark: str = "█") -> DataFrame:
    """The documents with every character of a span replaced by ``mark``; other columns as they are."""
    found = find_personal_data(docs, text_column)
    masked = F.aggregate(
        "spans",
        F.col("row")[text_column],
        lambda text, s: F.overlay(text, F.repeat(F.lit(mark), s["end"] - s["start"]), s["start"] + 1),
    )
    return found.select([(masked if name == text_column else F.col("row")[name]).alias(name) for name in docs.columns])
