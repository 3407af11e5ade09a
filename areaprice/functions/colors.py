"""Colour scales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The public ColorBrewer nine-colour palettes.
PALETTES = {
    "YlOrRd": "ffffcc ffeda0 fed976 feb24c fd8d3c fc4e2a e31a1c bd0026 800026",
    "Blues": "f7fbff deebf7 c6dbef 9ecae1 6baed6 4292c6 2171b5 08519c 08306b",
    "Greys": "ffffff f0f0f0 d9d9d9 bdbdbd 969696 737373 525252 252525 000000",
}
# ColorBrewer YlGnBu by number of classes.
CLASS_PALETTES = {
    3: "edf8b1 7fcdbb 2c7fb8",
    4: "ffffcc a1dab4 41b6c4 225ea8",
    5: "ffffcc a1dab4 41b6c4 2c7fb8 253494",
    6: "ffffcc c7e9b4 7fcdbb 41b6c4 2c7fb8 253494",
    7: "ffffcc c7e9b4 7fcdbb 41b6c4 1d91c0 225ea8 0c2c84",
    8: "ffffd9 edf8b1 c7e9b4 7fcdbb 41b6c4 1d91c0 225ea8 0c2c84",
    9: "ffffd9 edf8b1 c7e9b4 7fcdbb 41b6c4 1d91c0 225ea8 253494 081d58",
}
# Fill of an area without a value, on a ramp and among classes.
MISSING_COLOR = "#dddddd"
MISSING_CLASS_COLOR = "black"


def ramp_color(df: DataFrame, name: str, value: str, lo: str, hi: str, palette: str = "YlOrRd") -> DataFrame:
    """Add a column with the ``#rrggbbaa`` of a value on a linear scale from ``lo`` to ``hi``.

    ``value``, ``lo`` and ``hi`` are SQL expressions. Colours between two palette entries are interpolated and
    each channel is cut to a byte. Values outside the scale take its end colours, a scale of one single value
    has only the first colour, and a missing value gives NULL. The steps are columns of their own, so that
    each is computed once per row.
    """
    colors = PALETTES[palette].split()
    steps = len(colors) - 1
    edge = f"({lo} + ({hi} - {lo}) * (({{}}) / {steps}D))".format
    segment = " + ".join(f"int({value} > {edge(step)})" for step in range(1, steps))
    share = (
        f"case when {value} <= {lo} then 0D when {value} >= {hi} then 1D "
        f"else ({value} - {edge('_segment')}) / ({edge('_segment + 1')} - {edge('_segment')}) end"
    )
    channels = []
    for channel in range(3):
        levels = [f"{int(color[2 * channel : 2 * channel + 2], 16) / 255!r}D" for color in colors]
        low, high = (f"get(array({', '.join(part)}), _segment)" for part in (levels[:-1], levels[1:]))
        channels.append(f"floor(((1D - _share) * {low} + _share * {high}) * 255.9999D) * {256 ** (3 - channel)}L")
    packed = " + ".join([*channels, "255L"])
    return (
        df.selectExpr("*", f"{segment} as _segment")
        .selectExpr("*", f"{share} as _share")
        .selectExpr("*", f"'#' || lower(lpad(hex({packed}), 8, '0')) as {name}")
        .drop("_segment", "_share")
    )


def class_index(value: str, lo: str, hi: str, classes: int = 6) -> Column:
    """Equal-width class 0 to ``classes - 1`` of a value between ``lo`` and ``hi``; NULL if missing.

    An edge belongs to the upper class, the greatest value to the last one; with a single value there is only
    class 0.
    """
    passed = " + ".join(f"int({value} >= {lo} + (({hi} - {lo}) / {classes}D) * {step}D)" for step in range(1, classes))
    return F.expr(f"case when {value} is null then null when {hi} > {lo} then {passed} else 0 end")


def class_color(index: str, classes: int = 6) -> Column:
    """Colour of a class; NULL index gives the colour of missing values."""
    colors = ", ".join(f"'#{color}'" for color in CLASS_PALETTES[classes].split())
    return F.expr(f"coalesce(get(array({colors}), {index}), '{MISSING_CLASS_COLOR}')")
