"""Texts shown on a map, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import key_suffix
from .numbers import whole_text
from .text import escape_html

# Texts and style of labels and popups.
PLACEHOLDER = "—"
LABEL_MEDIAN = "мед: "
LABEL_COUNT = "n="
POPUP_UNIT_PRICE = "Цена за кв.м: "
POPUP_PRICE = "Цена объекта: "
POPUP_CURRENCY = " руб."
LABEL_STYLE = "font-size:10px; font-weight:bold; color:black; text-shadow:1px 1px 2px white;"


def or_placeholder(number: Column) -> Column:
    """The number as text, or a dash if it is missing."""
    return F.coalesce(number.cast("string"), F.lit(PLACEHOLDER))


def area_label(key: Column, median_round: Column, count: Column, long: bool = False, html: bool = False) -> Column:
    """Three-line label: key (its suffix unless ``long``), rounded median and count."""
    title = F.coalesce(key, F.lit("")) if long else key_suffix(key)
    lines = F.concat_ws(
        "<br>",
        escape_html(title) if html else title,
        F.concat(F.lit(LABEL_MEDIAN), or_placeholder(median_round)),
        F.concat(F.lit(LABEL_COUNT), or_placeholder(count)),
    )
    return F.concat(F.lit(f"<div style='{LABEL_STYLE}'>"), lines, F.lit("</div>")) if html else lines


def bid_popup(address: Column, price_per_sqm: Column, price: Column | None = None) -> Column:
    """Popup of an offer: address, price per square metre and, if given, the price of the object."""
    lines = [
        escape_html(address),
        F.concat(F.lit(POPUP_UNIT_PRICE), whole_text(price_per_sqm), F.lit(POPUP_CURRENCY)),
    ]
    if price is not None:
        lines.append(F.concat(F.lit(POPUP_PRICE), escape_html(price.cast("string"))))
    return F.concat_ws("<br>", *lines)
