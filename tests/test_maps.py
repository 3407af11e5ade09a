import pytest

from areaprice.plans import maps
from areaprice.sources.features import with_properties
from areaprice.sources.tables import clean_bids

MEDIAN_LAYER = "Сделки: медиана цены за кв.м"


def square(x, y):
    return ("Polygon", f"[[[{x},{y}],[{x + 1},{y}],[{x + 1},{y + 1}],[{x},{y + 1}],[{x},{y}]]]")


@pytest.fixture
def features(spark):
    rows = [
        ("1", "Feature", square(0, 0), '{"externalKey":"q:a"}'),
        ("2", "Feature", square(2, 0), '{"label":"q:b"}'),
        ("3", "Feature", square(9, 9), '{"options":{"cad_num":"q:unsold"}}'),
        ("4", "Feature", None, '{"label":"q:a"}'),
        ("5", "Feature", square(20, 20), "{}"),
    ]
    return spark.createDataFrame(rows, "id string, type string, geometry struct<type:string,coordinates:string>, properties string")


@pytest.fixture
def deals(spark):
    rows = [("q:a", 1964, "01.07.2025", "100"), ("q:a", 1970, "01.07.2025", "200"), ("q:a", 1980, "01.07.2025", "900")]
    rows += [("q:b", 1972, "01.07.2025", "400"), ("q:b", 1972, "01.07.2025", "0"), ("q:b", 1972, "01.04.2025", "1000")]
    rows += [("q:far", 1970, "01.07.2025", "800"), ("q:a", 1970, "01.07.2025", "n/a")]
    return spark.createDataFrame(rows, "quarter_cad_number string, year_build int, period_start_date string, price_per_sqm string")


@pytest.fixture
def bids(spark):
    rows = [("д. 1", 60.0, 30.0, 5000000, "100 000"), ("д. 2", 60.2, 30.4, 6000000, "200 000"), ("д. 3", None, 30.0, 1, "1")]
    return clean_bids(spark.createDataFrame(rows, "`Адрес` string, `Широта` double, `Долгота` double, `Цена, руб` long, `Цена за кв.м, руб.` string"))


@pytest.fixture
def metrics(spark):
    rows = [("q:a", 10.0, 9.0, 8.0, 3), ("q:b", 20.0, 19.0, 18.0, 4)]
    return spark.createDataFrame(rows, "quarter_cad_number string, arith_mean double, geom_mean double, median double, count long")


def by_key(df):
    return {row.cadnum: row for row in df.collect()}


def test_quick(spark, features):
    keyed = features.selectExpr("id as area_id", "geometry", "1 as note")
    table = spark.createDataFrame([("1", "5"), ("2", "x"), ("3", "11"), ("3", "17"), ("9", "99")], "area_id string, price string")
    built = maps.map_quick(keyed, table, "area_id", "price", ["area_id", "price"])
    found = [(r.area_id, r.price, r["class"], r.fill_color) for r in built.areas.orderBy("area_id", "price").collect()]
    # The value of area 9 has no feature, so it is not part of the scale of this map.
    assert found == [("1", 5.0, 0, "#ffffcc"), ("2", None, None, "black"), ("3", 11.0, 3, "#41b6c4"), ("3", 17.0, 5, "#253494"), ("4", None, None, "black"), ("5", None, None, "black")]
    assert built.areas.where("area_id = '1'").first().tooltip == {"area_id": "1", "price": "5.0"}
    assert tuple(built.center.first()) == pytest.approx(((0.5 + 0.5 + 9.5 + 20.5) / 4, (0.5 + 2.5 + 9.5 + 20.5) / 4))
    plain = maps.map_quick(keyed, table, "area_id")
    assert plain.points is None and "fill_color" not in plain.areas.columns
    with pytest.raises(ValueError, match="absent"):
        maps.map_quick(keyed, table, "area_id", tooltip_columns=["absent"])


def test_deals_and_bids(features, deals, bids):
    built = maps.map_deals_bids(deals, bids, features)
    rows = built.areas.collect()
    assert {r.layer for r in rows} == set(maps.HEAT_LAYERS.values())
    # Features without a geometry stay on this map, and two features may share an area.
    assert sorted((r.cadnum, r.value) for r in rows if r.layer == "Медиана цены сделок") == [("q:a", 200.0), ("q:a", 200.0), ("q:b", 700.0)]
    assert {r.fill_opacity for r in rows} == {0.7}
    assert tuple(built.center.first()) == pytest.approx((60.1, 30.2))
    texts = [r.text for r in built.points.orderBy("lat").collect()]
    assert texts == ["д. 1<br>Цена за кв.м: 100000 руб.", "д. 2<br>Цена за кв.м: 200000 руб."]
    assert built.rows().count() == len(rows) + 2


def test_bids_over_metrics(features, bids, metrics):
    built = maps.map_bids(bids, metrics, features)
    found = {(r.layer, r.cadnum): r for r in built.areas.where("geometry is not null").collect()}
    assert len(found) == 12
    assert (found[MEDIAN_LAYER, "q:a"].fill_color, found[MEDIAN_LAYER, "q:b"].fill_color) == ("#ffffccff", "#800026ff")
    assert (found[MEDIAN_LAYER, "q:unsold"].fill_color, found[MEDIAN_LAYER, "q:unsold"].fill_opacity) == ("#dddddd", 0.1)
    assert built.points.first().text.endswith("<br>Цена объекта: 5000000")
    alone = maps.map_bids(bids, None, features)
    assert alone.areas is None and alone.rows().count() == 2
    with pytest.raises(ValueError, match="No offers"):
        maps.map_bids(bids.where("lat > 90"), metrics, features)


def test_median_with_and_without_bids(features, bids, metrics):
    built = maps.map_median(metrics, features)
    assert by_key(built.areas.where("geometry is not null"))["q:b"].value == 18.0
    assert tuple(built.center.first()) == (10.5, 10.5)
    both = maps.map_median_bids(metrics, bids, features)
    assert {r.fill_color for r in both.points.collect()} == {"black"}
    assert tuple(both.center.first()) == (10.5, 10.5)


def test_two_periods(features, deals):
    early, late = deals.where("year_build <= 1969"), deals.where("year_build >= 1970")
    first, second, together = maps.map_two_periods(early, late, features)
    a, b = by_key(first.areas), by_key(second.areas)
    # Only q:a has early deals; q:b is still on the early map. Zero prices count on these maps.
    assert set(a) == set(b) == {"q:a", "q:b"}
    assert (a["q:a"].value, a["q:b"].value, a["q:b"].fill_color) == (100.0, None, "#dddddd")
    assert (b["q:a"].value, b["q:b"].value, b["q:b"]["count"]) == (550.0, 400.0, 3)
    assert {r.text for r in first.points.collect()} == {"q:a<br>мед: 100<br>n=1", "q:b<br>мед: —<br>n=—"}
    assert tuple(first.center.first()) == tuple(second.center.first()) == (0.5, 1.5)
    assert together.groupBy("map", "layer").count().count() == 4 and first.rows().count() == 4


def test_labeled(features, deals):
    built = maps.map_labeled(deals, features)
    found = by_key(built.areas)
    assert {k: (r.value, r["count"]) for k, r in found.items()} == {"q:a": (200.0, 3), "q:b": (700.0, 2)}
    labels = by_key(built.points)
    assert labels["q:b"].text == "b<br>мед: 700<br>n=2" and (labels["q:b"].lat, labels["q:b"].lon) == pytest.approx((0.4, 2.4))
    grey = by_key(maps.map_labeled_filtered(deals, features).areas)
    assert {k: (r.value, r["count"], r.fill_color[1:3] == r.fill_color[3:5]) for k, r in grey.items()} == {
        "q:a": (150.0, 2, True),
        "q:b": (400.0, 1, True),
    }
    with pytest.raises(ValueError, match="No deals"):
        maps.map_labeled(deals, features, period="01.01.1900")


def test_metrics_without_values_have_no_layer(spark, features, bids, metrics):
    empty = metrics.where("count < 0")
    assert maps.map_median(empty, features).areas.count() == 0
    without = metrics.selectExpr("quarter_cad_number", "arith_mean", "geom_mean", "cast(null as double) as median", "count")
    layers = {r.layer for r in maps.map_bids(bids, without, features).areas.collect()}
    assert len(layers) == 2 and MEDIAN_LAYER not in layers


def test_no_features_are_an_error(spark, features):
    table = spark.createDataFrame([("1", 5.0)], "id string, price double")
    with pytest.raises(ValueError, match="No features"):
        maps.map_quick(features.where("id = 'none'"), table, "id", "price")


def test_property_in_the_tooltip_of_a_quick_map(spark, features):
    table = spark.createDataFrame([("q:b", 5.0)], "label string, price double")
    built = maps.map_quick(with_properties(features, ["label"]), table, "label", "price", ["label"], unique=True)
    assert {r.tooltip["label"]: r.price for r in built.areas.collect()} == {"q:b": 5.0, "q:a": None, None: None}
