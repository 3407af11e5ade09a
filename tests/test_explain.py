"""What the physical plans must look like for the library to hold at scale."""

import re

import pytest

from areaprice.checks import tables
from areaprice.checks.queries import QUERIES
from areaprice.operators import centers, joins, layers, stats
from areaprice.operators.clean import clean_prices, filter_period
from areaprice.scratch import stored
from areaprice.sources.sinks import write_csv
from areaprice.sources.tables import read_deals

SF = "/root/testdata/sf0.01"


@pytest.fixture
def plan(capsys):
    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


def count(pattern, text):
    return len(re.findall(pattern, text))


def test_mean_and_count_take_one_shuffle(spark, plan):
    deals = clean_prices(tables.deals(spark, SF))
    text = plan(stats.area_stats(deals, stats=["arith_mean", "count", "geom_mean"]))
    assert count(r"\) Exchange", text) == 1 and "partial_" in text


def test_exact_median_reads_rows_of_one_cell_per_area(spark, plan):
    text = plan(stats.area_stats(clean_prices(tables.deals(spark, SF))))
    # The deals were read while the plan was built; what is left are one-row-per-area tables.
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "lineitem" not in text


def test_scans_read_only_needed_columns(spark, plan, tmp_path):
    path = str(tmp_path / "deals.parquet")
    clean_prices(tables.deals(spark, SF)).write.parquet(path)
    deals = filter_period(clean_prices(spark.read.parquet(path)), (1964, 1972), "01.07.1999")
    text = plan(stats.area_stats(deals, stats=["count"]))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {field.split(":")[0] for field in schema.split(",")} == {
        "quarter_cad_number", "price_per_sqm", "year_build", "period_start_date",
    }
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(year_build,1964)" in pushed and "EqualTo(period_start_date,01.07.1999)" in pushed
    assert "GreaterThan(price_per_sqm,0.0)" in pushed


@pytest.mark.parametrize("encoding", ["UTF-8", "cp1251", "auto_value"])
def test_delimited_scans_read_only_needed_columns(spark, plan, tmp_path, encoding):
    path = write_csv(tables.deals(spark, SF), str(tmp_path / "deals.csv"), sep=";")
    text = plan(stats.area_stats(clean_prices(read_deals(spark, path, encoding=encoding)), stats=["count"]))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert schema == "quarter_cad_number:string,price_per_sqm:string"


def test_lookup_in_a_small_table_shuffles_no_features(spark, plan):
    metrics = QUERIES["color_ramp"](spark, SF)
    looked_up = joins.lookup_stats(tables.keyed_features(spark, SF), metrics, ["median"], unique=True)
    text = plan(looked_up)
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_scale_of_a_ramp_is_one_scalar_subquery(spark, plan):
    medians = stored(stats.area_median(clean_prices(tables.deals(spark, SF))))
    text = plan(layers.color_ramp(medians, "median", stats.metric_domain(medians, "median")))
    assert "Subquery" in text and "Join" not in text


MAPS = {  # scans of features and of offers: once for the rows, once for the centre or the scale
    "map_quick": (2, 0), "map_deals_bids": (1, 2), "map_bids": (1, 2), "map_median": (2, 0), "map_median_bids": (2, 1),
    "map_two_periods": (2, 0), "map_labeled": (2, 0), "map_labeled_filtered": (2, 0),
}


@pytest.mark.parametrize("name", MAPS)
def test_maps_read_features_and_offers_at_most_twice(spark, monkeypatch, capsys, name):
    """Counts the scans of all jobs that the query starts, and of the one that its result takes."""
    plans = []
    writer = type(spark.range(0).write)
    write = writer.parquet

    def recorded(self, *args, **options):
        capsys.readouterr()
        self._df.explain("formatted")
        plans.append(capsys.readouterr().out)
        return write(self, *args, **options)

    monkeypatch.setattr(writer, "parquet", recorded)
    result = QUERIES[name](spark, SF)
    capsys.readouterr()
    result.explain("formatted")
    plans.append(capsys.readouterr().out)
    scans = re.findall(r"Location: .*/(\w+)\.parquet", "\n".join(plans))
    features, bids = MAPS[name]
    assert scans.count("supplier") == features and scans.count("customer") == bids


def test_union_centre_shuffles_no_geometry(spark, plan):
    text = plan(centers.union_center(tables.features(spark, SF)))
    assert count(r"\) Scan parquet", text) == 1
    for exchange in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text):
        assert "coordinates" not in exchange and "geometry" not in exchange
