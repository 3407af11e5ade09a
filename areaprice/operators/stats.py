"""Statistics per area, safe for areas that hold a large share of all rows."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import geometric_mean, nan_to_null, quoted, round_half_even
from ..scratch import stored, stored_and_observed

STATS = ("arith_mean", "median", "count", "geom_mean")

# Resolution of the exact median: logarithmic cells per factor e, then equal cells within one of those.
LOG_CELLS = 64
LINEAR_CELLS = 1 << 20
# Of a key whose middle values are not both known.
IS_OPEN = "_lower is null or _upper is null"
APPROX_ACCURACY = 10_000


def area_stats(
    deals: DataFrame,
    key: str = "quarter_cad_number",
    price: str = "price_per_sqm",
    stats: Iterable[str] = STATS,
    method: str = "exact",
    times: str | None = None,
) -> DataFrame:
    """Mean, median, count and geometric mean of the prices of each area; rows without a price do not count.

    A NULL key is a group of its own. ``times`` names a column of whole numbers that says how often a row counts, as in
    a table of counted prices; it needs the exact method. ``method`` concerns the median only:

    * ``exact`` finds the two middle values through counts per price cell, see :func:`_stats_with_exact_median`. No
      task ever holds a whole area, so it suits areas of any size.
    * ``single_shuffle`` gives the same values with Spark's ``median``, which keeps all distinct prices of
      an area in one task: quicker when every area is known to be small.
    * ``approx`` uses ``approx_percentile``.
    """
    stats = list(stats)
    unknown = set(stats) - set(STATS)
    if unknown:
        raise ValueError(f"Unknown statistics {sorted(unknown)}")
    weight = [F.col(quoted(times)).cast("long").alias("_w")] if times else []
    rows = deals.select(F.col(quoted(key)).alias("_area"), nan_to_null(F.col(quoted(price)).cast("double")).alias("_v"), *weight)
    value = F.col("_v")
    if times and method != "exact":
        raise ValueError(f"Rows that count several times need the exact method, not {method!r}")
    if times or "median" in stats and method == "exact":
        return _stats_with_exact_median(rows, "_area", stats).toDF(key, *stats)
    median = {
        "exact": F.median(value),
        "single_shuffle": F.median(value),
        "approx": F.approx_percentile(value, 0.5, APPROX_ACCURACY),
    }[method]
    plain = {
        "arith_mean": F.avg(value),
        "median": median,
        "count": F.count(value),
        "geom_mean": geometric_mean(value),
    }
    grouped = rows.groupBy("_area").agg(F.count(value).alias("_n"), *[plain[name].alias(name) for name in stats])
    return grouped.where("_n > 0").drop("_n").toDF(key, *stats)


def area_median(deals: DataFrame, key: str = "quarter_cad_number", price: str = "price_per_sqm") -> DataFrame:
    """Median, its rounded value and count per area."""
    return with_median_round(area_stats(deals, key, price, ("median", "count")))


def with_median_round(metrics: DataFrame) -> DataFrame:
    """Add ``median_round``, the median as a whole number (half to even)."""
    return metrics.withColumn("median_round", round_half_even(F.col("median")))


def _log_cell(value: Column) -> Column:
    """Number of the price cell of a value; grows with the value. All doubles there are fit in 97,000 cells."""
    span = 750 * LOG_CELLS
    positive = F.floor(F.least(F.ln(value) * LOG_CELLS, F.lit(float(span)))) + span
    negative = -F.floor(F.least(F.ln(-value) * LOG_CELLS, F.lit(float(span)))) - span
    return F.when(value > 0, positive).when(value < 0, negative).when(value == 0, 0).cast("int")


def _linear_cell(value: Column, lo: Column, hi: Column) -> Column:
    """Number of the cell among ``LINEAR_CELLS`` between ``lo`` and ``hi``; grows with the value."""
    share = (value - lo) / (hi - lo)
    return F.when((share > 0) & (share <= 1), F.floor(share * LINEAR_CELLS)).otherwise(0).cast("int")


def _locate_middle(cells: DataFrame, key: str, extra: Iterable[str] = ()) -> DataFrame:
    """Per key: the two middle values, as far as known, and the cell to search if one is not.

    ``cells`` has the distinct cells of each key in order of value: ``_cell``, row count ``_n``, least and
    greatest value ``_lo``/``_hi``, and per key the rank ``_base`` of its first row and the two middle ranks
    ``_r0``/``_r1``. A middle row is known if it is the first or last of its cell. Two different middle cells
    leave nothing open, for the middle rows are then last of the one and first of the other.
    """
    in_order = Window.partitionBy(key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = cells.withColumn("_upto", F.sum("_n").over(in_order)).selectExpr(
        "*", "_base + _upto - _n as _start", "_base + _upto as _end"
    )
    holds = "({0} >= _start and {0} < _end)".format
    known = (
        "max(case when not {1} then null when {0} = _start then _lo when {0} = _end - 1 or _lo = _hi then _hi end) as {2}"
    ).format
    middle = ranked.where(f"{holds('_r0')} or {holds('_r1')}").groupBy(key)
    search = ["max(_start) as _base", "max(_n) as _size"]
    search += [f"max({name}) as {name}" for name in ("_cell", "_lo", "_hi", "_r0", "_r1", *extra)]
    ends = [known("_r0", holds("_r0"), "_lower"), known("_r1", holds("_r1"), "_upper")]
    return middle.agg(*[F.expr(text) for text in ends + search])


def _open(located: DataFrame, key: str) -> DataFrame:
    """Keys with a middle value not yet known, the cell to search, its size and the ranks to look for."""
    renamed = [F.col(key).alias("_key"), F.col("_cell").alias("_in"), F.col("_size").alias("_want")]
    return located.where(IS_OPEN).select(*renamed, "_base", "_r0", "_r1", "_lo", "_hi")


def _stats_with_exact_median(rows: DataFrame, key: str, stats: list[str]) -> DataFrame:
    """All statistics from counts and sums per price cell, then the exact middle values.

    Rows are counted per (area, logarithmic price cell). Partial counts are combined before the shuffle, a
    large area is spread over its cells, and the window over an area sees cells, not rows. The outcome, one
    row per area, is stored; where it leaves a middle value open, the rows of one cell are read again.
    """
    celled = rows.withColumn("_cell", _log_cell(F.col("_v")))
    weighted = "_w" in rows.columns
    count = "coalesce(sum(case when _v is not null then _w end), 0L)" if weighted else "count(_v)"
    by_weight = " * _w" if weighted else ""
    sums = [f"{count} as _n", "min(_v) as _lo", "max(_v) as _hi"]
    if "arith_mean" in stats:
        sums.append(f"sum(_v{by_weight}) as _sum")
    if "geom_mean" in stats:
        sums.append(f"sum(case when _v > 0 then ln(_v){by_weight} end) as _sum_log")
    # Missing values drop out here and not by a filter on the rows, which Catalyst would push down through
    # the parsing of the price and so parse it once more.
    cells = celled.groupBy(key, "_cell").agg(*[F.expr(text) for text in sums]).where("_n > 0")

    whole = Window.partitionBy(key)
    totals = {name: name for name in ("_n", "_sum", "_sum_log") if name in cells.columns}
    if "geom_mean" in stats:
        totals["_n_log"] = "if(_cell > 0, _n, 0L)"  # cells of positive values have positive numbers
    cells = cells.withColumns({f"_all{name}": F.sum(F.expr(text)).over(whole) for name, text in totals.items()}).selectExpr(
        "*", "0L as _base", "(_all_n - 1) div 2 as _r0", "_all_n div 2 as _r1"
    )
    all_names = [f"_all{name}" for name in totals]
    located, seen = stored_and_observed(_locate_middle(cells, key, all_names), n_open=F.count_if(F.expr(IS_OPEN)))
    if seen["n_open"]:
        middles = _middle_values(celled, key, _open(located, key), seen["n_open"])
        located = located.join(middles, F.col(key).eqNullSafe(F.col("_found")), "left").selectExpr(
            quoted(key), "coalesce(_lower_found, _lower) as _lower", "coalesce(_upper_found, _upper) as _upper", *all_names
        )
    result = {
        "arith_mean": "_all_sum / _all_n",
        "median": "(_lower + _upper) / 2",
        "count": "_all_n",
        "geom_mean": "case when _all_n_log > 0 then exp(_all_sum_log / _all_n_log) end",
    }
    return located.selectExpr(quoted(key), *[f"{result[name]} as {name}" for name in stats])


def _middle_values(celled: DataFrame, key: str, wanted: DataFrame, n_open: int) -> DataFrame:
    """The two middle values of the keys in ``wanted``: ``_found`` (the key), ``_lower_found``, ``_upper_found``.

    Reads the rows of the one wanted cell per key, a small part of the data, and narrows the cell to one of
    ``LINEAR_CELLS`` equal parts. Where that leaves a middle value open, the rows of these parts, far fewer, are
    stored as counts per distinct price and narrowed again, until every middle value is an end of its part. A part
    that holds two prices is always split, and one step divides the width of a part by ``LINEAR_CELLS``, so the
    precision of a double bounds the steps; no task ranks more than the parts of a key. The counts must agree
    from step to step: a source that changed between the reads is an error.
    """
    inside = F.col(key).eqNullSafe(F.col("_key"))
    in_cell = inside & F.col("_cell").eqNullSafe(F.col("_in"))
    in_part = inside & F.expr("_v between _lo and _hi")
    part = _linear_cell(F.col("_v"), F.col("_lo"), F.col("_hi")).alias("_cell")
    once = F.col("_w") if "_w" in celled.columns else F.lit(1)
    prices, done = None, []
    while n_open:
        if not done:
            wanted_rows = celled.withColumn("_n", once).join(wanted, in_cell)
        else:
            if prices is None:
                counted = celled.join(wanted, in_part).groupBy(key, "_v").agg(F.sum(once).alias("_n"))
                prices = stored(counted)
            wanted_rows = prices.join(wanted, in_part)
        parts = wanted_rows.groupBy(key, part, "_base", "_r0", "_r1", "_want").agg(
            F.sum("_n").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
        )
        parts = parts.withColumn("_seen", F.sum("_n").over(Window.partitionBy(key)))
        located, seen = stored_and_observed(
            _locate_middle(parts, key, ("_seen", "_want")),
            keys=F.count(F.lit(1)),
            other=F.count_if(F.expr("_seen <> _want")),
            n_open=F.count_if(F.expr(IS_OPEN)),
        )
        if seen["keys"] != n_open or seen["other"]:
            raise RuntimeError("The prices changed while their median was computed; store them first")
        done.append(located.where(f"not ({IS_OPEN})"))
        wanted, n_open = _open(located, key), seen["n_open"]
    ends = [f"{quoted(key)} as _found", "_lower as _lower_found", "_upper as _upper_found"]
    return functools.reduce(DataFrame.union, [part.selectExpr(ends) for part in done])


def metric_domain(df: DataFrame, column: str) -> DataFrame:
    """One row with the least and greatest value of a column, ``lo`` and ``hi``."""
    return df.agg(F.min(nan_to_null(F.col(quoted(column)).cast("double"))).alias("lo"),
                  F.max(nan_to_null(F.col(quoted(column)).cast("double"))).alias("hi"))


def area_keys(df: DataFrame, key: str = "quarter_cad_number") -> DataFrame:
    """Distinct area keys."""
    return df.select(quoted(key)).distinct()


def keys_union(left: DataFrame, right: DataFrame, key: str = "quarter_cad_number") -> DataFrame:
    """Distinct keys of either table."""
    return left.select(quoted(key)).union(right.select(quoted(key))).distinct()
