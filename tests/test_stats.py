import math
import random
import statistics

import pytest

from areaprice import scratch
from areaprice.operators import stats
from areaprice.operators.clean import clean_prices, filter_period, require_columns, require_rows
from areaprice.operators.joins import join_features, lookup_stats
from areaprice.operators.stats import STATS, area_keys, area_median, area_stats, keys_union, metric_domain

GOLDEN_DEALS = {
    "78:10:0005203": [156351.79, 128865.98],
    "78:10:0005224": [72368.42, 59900.17, 150586.70, 178343.95, 119782.21, 143805.31],
    "78:10:0005225": [28021.02, 27397.26, 143149.28, 122699.39, 38374.72, 118101.55, 130708.86],
}
GOLDEN_STATS = {  # mean, median, count, geometric mean
    "78:10:0005203": (142608.885, 142608.885, 2, 141945.15364430108),
    "78:10:0005224": (120797.79333333333, 131793.76, 6, 112296.15799023148),
    "78:10:0005225": (86921.72571428571, 118101.55, 7, 69695.39271473004),
}
SCHEMA = "quarter_cad_number string, price_per_sqm double"


def by_key(df):
    return {row.quarter_cad_number: row for row in df.collect()}


@pytest.mark.parametrize("method", ["exact", "single_shuffle"])
def test_golden_statistics(spark, method):
    deals = spark.createDataFrame([(k, v) for k, values in GOLDEN_DEALS.items() for v in values], SCHEMA)
    found = by_key(area_stats(deals, method=method))
    assert found.keys() == GOLDEN_STATS.keys()
    for key, (mean, median, count, geometric) in GOLDEN_STATS.items():
        row = found[key]
        assert row["count"] == count and row.median == median
        assert row.arith_mean == pytest.approx(mean, rel=1e-12) and row.geom_mean == pytest.approx(geometric, rel=1e-12)


def test_small_groups(spark):
    rows = [("even", 1.0), ("even", 2.0), ("gap", 1.0), ("gap", 2.0), ("gap", None), ("odd", 1.0), ("odd", 2.0), ("odd", 3.0)]
    rows += [("geo", 2.0), ("geo", 8.0), ("low", 0.0), ("low", -1.0), ("none", None), ("nan", float("nan")), (None, 5.0), (None, 7.0)]
    for method in ("exact", "single_shuffle"):
        found = by_key(area_stats(spark.createDataFrame(rows, SCHEMA), method=method))
        assert set(found) == {"even", "gap", "odd", "geo", "low", None}
        assert [found[k].median for k in ("even", "gap", "odd", None)] == [1.5, 1.5, 2.0, 6.0]
        assert found["geo"].geom_mean == pytest.approx(4.0) and found["low"].geom_mean is None
        assert found["low"].median == -0.5


def _awkward_rows():
    """Groups that are skewed, tied, tightly packed, spread over all magnitudes, negative or infinite."""
    rng = random.Random(7)
    makers = {
        "huge": lambda: round(rng.lognormvariate(11, 0.5), 2),
        "tied": lambda: float(rng.randint(1, 4)),
        "packed": lambda: 100000 + rng.random() * 1e-7,
        "wide": lambda: 10.0 ** rng.randint(-300, 300),
        "signs": lambda: rng.uniform(-10, 10),
        "ends": lambda: rng.choice([0.0, -0.0, 1.0, math.inf, -3.0, None, math.nan]),
        None: lambda: rng.gauss(0, 1),
    }
    sizes = {"huge": 4000, "tied": 501, "packed": 800, "wide": 300, "signs": 700, "ends": 200, None: 350}
    return [(key, make()) for key, make in makers.items() for _ in range(sizes[key])]


@pytest.mark.parametrize("log_cells, linear_cells", [(64, 1 << 20), (64, 4096), (1, 16), (4, 64)])
def test_exact_median_against_brute_force(spark, monkeypatch, log_cells, linear_cells):
    monkeypatch.setattr(stats, "LOG_CELLS", log_cells)
    monkeypatch.setattr(stats, "LINEAR_CELLS", linear_cells)
    rows = _awkward_rows()
    found = by_key(area_stats(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    groups = {}
    for key, value in rows:
        if value is not None and not math.isnan(value):
            groups.setdefault(key, []).append(value)
    assert found.keys() == groups.keys()
    for key, values in groups.items():
        assert found[key].median == statistics.median(values), key
        assert found[key]["count"] == len(values)


def test_exact_median_without_broadcast(spark):
    deals = spark.createDataFrame(_awkward_rows(), SCHEMA)
    expected = {k: r.median for k, r in by_key(area_stats(deals, method="single_shuffle")).items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {k: r.median for k, r in by_key(area_stats(deals)).items()} == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("reads", [1, 2])
@pytest.mark.parametrize("changed", ["", "a,100000.05\n", "a,7.0\n" * 10])
def test_prices_that_change_between_the_reads_are_an_error(spark, monkeypatch, tmp_path, changed, reads):
    monkeypatch.setattr(stats, "LINEAR_CELLS", 3)
    path = tmp_path / "deals.csv"
    path.write_text("".join(f"a,{100000.0 + i / 100}\n" for i in range(10)))
    write = scratch.stored_and_observed
    done = []

    def then_change(df, **measures):
        found = write(df, **measures)
        done.append(1)
        if len(done) == reads:
            path.write_text(changed)
        return found

    monkeypatch.setattr(stats, "stored_and_observed", then_change)
    with pytest.raises(RuntimeError, match="changed"):
        area_stats(spark.read.schema(SCHEMA).csv(str(path)))


def test_approximate_median_is_close(spark):
    deals = spark.createDataFrame([("a", float(i)) for i in range(10001)], SCHEMA)
    assert area_stats(deals, stats=["median"], method="approx").first().median == pytest.approx(5000, abs=2)


def test_selected_statistics_and_rounding(spark):
    deals = spark.createDataFrame([("a", 2.0), ("a", 3.0), ("b", 3.0), ("b", 4.0)], SCHEMA)
    found = by_key(area_median(deals))
    assert [(r.median, r.median_round, r["count"]) for r in (found["a"], found["b"])] == [(2.5, 2, 2), (3.5, 4, 2)]
    assert area_stats(deals, stats=["count"]).columns == ["quarter_cad_number", "count"]
    with pytest.raises(ValueError, match="mode"):
        area_stats(deals, stats=["mode"])


def test_price_policies(spark):
    deals = spark.createDataFrame([("a", "-5"), ("a", "0"), ("a", "10"), ("a", None), ("a", "n/a")], "quarter_cad_number string, price_per_sqm string")
    assert clean_prices(deals).count() == 1
    assert clean_prices(deals, policy="present").count() == 3
    with pytest.raises(ValueError):
        clean_prices(deals, policy="any")


def test_period_filter_is_inclusive(spark):
    rows = [(1963, "01.07.2025"), (1964, "01.07.2025"), (1972, "01.07.2025"), (1973, "01.07.2025"), (1970, "01.04.2025"), (None, "01.07.2025")]
    deals = spark.createDataFrame(rows, "year_build int, period_start_date string")
    assert [r.year_build for r in filter_period(deals, (1964, 1972), "01.07.2025").collect()] == [1964, 1972]
    assert filter_period(deals).count() == 6


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_period_of_a_typed_column(spark, kind):
    days = ["2025-07-01", "2025-04-01", None]
    deals = spark.createDataFrame([(d,) for d in days], "period_start_date string").selectExpr(f"cast(period_start_date as {kind}) as period_start_date")
    assert filter_period(deals, period="01.07.2025").count() == 1


def test_domain_keys_and_checks(spark):
    deals = spark.createDataFrame([("a", 2.0), ("b", None), ("c", float("nan")), ("a", 9.0)], SCHEMA)
    assert tuple(metric_domain(deals, "price_per_sqm").first()) == (2.0, 9.0)
    other = spark.createDataFrame([("d", 1.0), ("a", 1.0)], SCHEMA)
    assert sorted(r[0] for r in keys_union(deals, other).collect()) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="nothing"):
        require_rows(deals.where("price_per_sqm > 100 and not isnan(price_per_sqm)"), "nothing")
    with pytest.raises(ValueError, match="median"):
        require_columns(deals, ["quarter_cad_number", "median"])


@pytest.mark.parametrize("method", ["exact", "single_shuffle"])
def test_names_with_dots(spark, method):
    deals = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 2.0), (None, 3.0)], "`area.key` string, `price, m.` double")
    found = area_stats(deals, "area.key", "price, m.", method=method)
    assert found.columns == ["area.key", *STATS]
    medians = {r["area.key"]: r["median"] for r in found.collect()}
    assert medians == {"a": 2.5, "b": 2.0, None: 3.0}
    assert area_keys(deals, "area.key").count() == keys_union(deals, deals, "area.key").count() == 3
    features = spark.createDataFrame([("a",), ("c",)], "cadnum string")
    looked = lookup_stats(features, found, ["median"], key="area.key")
    assert {r.cadnum: r["median"] for r in looked.collect()} == {"a": 2.5, "c": None}
    assert join_features(found, deals, "area.key", "outer").count() == 5  # NULLs match nothing
    assert metric_domain(deals, "price, m.").first()["hi"] == 4.0
