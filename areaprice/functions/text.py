"""Column expressions for encodings and markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Each byte above 127 as Latin-1 and as windows-1251 sees it (byte 0x98 is not assigned there). Spark reads
# and writes Latin-1 in every session, so a text translation gives windows-1251 without a session setting.
_HIGH_BYTES = bytes(b for b in range(128, 256) if b != 0x98)
_AS_LATIN1 = _HIGH_BYTES.decode("latin-1")
_AS_CP1251 = _HIGH_BYTES.decode("cp1251")


# Latin-1 characters that windows-1251 lacks; written as they are, they would come back as other letters.
_ONLY_LATIN1 = "".join(c for c in bytes(range(128, 256)).decode("latin-1") if c not in _AS_CP1251)


def _is_ascii(text: Column) -> Column:
    """Whether all characters are one byte, which is quicker to see than by a pattern."""
    return F.octet_length(text) == F.char_length(text)


def _unless_ascii(text: Column, changed: Column) -> Column:
    """Most cells are plain ASCII and are passed on as they are, which is quicker than looking up each letter."""
    return F.when(_is_ascii(text), text).otherwise(changed)


def cp1251_from_latin1(text: Column) -> Column:
    """Text whose windows-1251 bytes were read as Latin-1, put right."""
    return _unless_ascii(text, F.translate(text, _AS_LATIN1, _AS_CP1251))


def cp1251_to_latin1(text: Column) -> Column:
    """Inverse of :func:`cp1251_from_latin1`, to be written as Latin-1.

    What windows-1251 lacks becomes ``?``, here or, if Latin-1 lacks it too, in the writer.
    """
    unknown = "?" * len(_ONLY_LATIN1)
    return _unless_ascii(text, F.translate(text, _AS_CP1251 + _ONLY_LATIN1, _AS_LATIN1 + unknown))


def latin1_bytes(text: Column) -> Column:
    """The bytes that were read as Latin-1, taken for UTF-8, valid or not."""
    return F.encode(text, "ISO-8859-1").cast("string")


# Bytes, as Latin-1, that go on a character in UTF-8 and are no letters of words in windows-1251. Those that begin one are
# letters there, and of those that go on only Ё and ё: all else that is valid UTF-8 has signs in the middle of words.
_UTF8_ALONE = r"[\u0080-\u00A7\u00A9-\u00B7\u00B9-\u00BF]"


def tells_encoding(text: Column) -> Column:
    """Whether valid UTF-8 can't be windows-1251 as well; NULL for plain ASCII and for what is not valid."""
    as_latin1 = F.decode(text.cast("binary"), "ISO-8859-1")
    return F.when(~_is_ascii(text) & F.is_valid_utf8(text), as_latin1.rlike(_UTF8_ALONE))


def utf8_or_cp1251_by(text: Column, utf8: Column) -> Column:
    """Text read as Latin-1, put right as UTF-8 where ``utf8`` is true, else as windows-1251."""
    return _unless_ascii(text, F.when(utf8, latin1_bytes(text)).otherwise(F.translate(text, _AS_LATIN1, _AS_CP1251)))


def utf8_or_cp1251(text: Column) -> Column:
    """Text read as Latin-1 of unknown encoding: UTF-8 where its bytes are valid UTF-8, else windows-1251.

    Decided for each value by itself; a short windows-1251 value may happen to be valid UTF-8.
    """
    return utf8_or_cp1251_by(text, F.is_valid_utf8(latin1_bytes(text)))


def decode_names(names: list[str]) -> list[str]:
    """Column names of a header read as Latin-1: UTF-8 if all of them are, else windows-1251."""
    raw = [name.encode("latin-1") for name in names]
    try:
        return [name.decode("utf-8") for name in raw]
    except UnicodeDecodeError:
        return [name.decode("cp1251", "replace") for name in raw]


def escape_html(text: Column) -> Column:
    """Make text safe inside HTML."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text
