import pytest
from pyspark.sql import functions as F

from areaprice.functions.colors import CLASS_PALETTES, MISSING_COLOR, PALETTES
from areaprice.functions.labels import area_label, bid_popup
from areaprice.operators.layers import area_layers, bids_layer, class_bins, color_ramp, labels_layer, tooltip
from areaprice.operators.stats import metric_domain


def expected_color(value, lo, hi, palette):
    """Brute force: find the segment by walking the edges, mix the two ends channel by channel."""
    colors = PALETTES[palette].split()
    if value <= lo:
        return f"#{colors[0]}ff"
    if value >= hi:
        return f"#{colors[-1]}ff"
    edges = [lo + (hi - lo) * (i / 8) for i in range(9)]
    i = next(i for i in range(1, 9) if value <= edges[i])
    share = (value - edges[i - 1]) / (edges[i] - edges[i - 1])
    channels = []
    for c in (0, 2, 4):
        a, b = int(colors[i - 1][c : c + 2], 16) / 255, int(colors[i][c : c + 2], 16) / 255
        channels.append(int(((1 - share) * a + share * b) * 255.9999))
    return "#" + "".join(f"{c:02x}" for c in channels) + "ff"


@pytest.mark.parametrize("palette", sorted(PALETTES))
def test_ramp_against_brute_force(spark, palette):
    values = [3.0 + i * 0.37 for i in range(60)] + [3.0 + 22.0 * i / 8 for i in range(9)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = color_ramp(df, "v", metric_domain(df, "v"), palette).collect()
    for row in found:
        assert row.fill_color == expected_color(row.v, min(values), max(values), palette)
        assert row.fill_opacity == 0.65


def test_ramp_edge_cases(spark):
    one = spark.createDataFrame([(5.0,), (None,), (float("nan"),)], "v double")
    found = color_ramp(one, "v", metric_domain(one, "v"), opacity=(0.7, 0.2)).collect()
    assert [(r.fill_color, r.fill_opacity) for r in found] == [("#ffffccff", 0.7), (MISSING_COLOR, 0.2), (MISSING_COLOR, 0.2)]
    empty = one.where("v is null")
    assert color_ramp(empty, "v", metric_domain(empty, "v")).first().fill_color == MISSING_COLOR


def test_classes(spark):
    df = spark.createDataFrame([(float(v),) for v in range(13)] + [(None,)], "v double")
    found = {r.v: r for r in class_bins(df, "v", metric_domain(df, "v")).collect()}
    assert [found[float(v)]["class"] for v in range(13)] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 5]
    assert found[0.0].fill_color == "#ffffcc" and found[12.0].fill_color == "#253494"
    assert (found[None]["class"], found[None].fill_color) == (None, "black")
    single = df.where("v = 3")
    assert class_bins(single, "v", metric_domain(single, "v")).first()["class"] == 0
    for classes, colors in CLASS_PALETTES.items():
        assert len(colors.split()) == classes
        assert class_bins(df, "v", metric_domain(df, "v"), classes).agg(F.max("class")).first()[0] == classes - 1


def test_labels(spark):
    df = spark.createDataFrame([("78:10:0005203", 142609, 2), ("a<b", None, None), (None, None, None)], "k string, m long, n long")
    short = [r[0] for r in df.select(area_label(F.col("k"), F.col("m"), F.col("n"))).collect()]
    assert short == ["0005203<br>мед: 142609<br>n=2", "a<b<br>мед: —<br>n=—", "<br>мед: —<br>n=—"]
    long = [r[0] for r in df.select(area_label(F.col("k"), F.col("m"), F.col("n"), long=True, html=True)).collect()]
    assert long[0].startswith("<div style='font-size:10px;") and long[0].endswith(">78:10:0005203<br>мед: 142609<br>n=2</div>")
    assert ">a&lt;b<br>" in long[1]


def test_popups(spark):
    df = spark.createDataFrame([("<b>Дом</b> & \"7'\"", 2.5, "8800000")], "a string, p double, o string")
    full, short = df.select(bid_popup(F.col("a"), F.col("p"), F.col("o")), bid_popup(F.col("a"), F.col("p"))).first()
    address = "&lt;b&gt;Дом&lt;/b&gt; &amp; &quot;7&#x27;&quot;"
    assert full == f"{address}<br>Цена за кв.м: 2 руб.<br>Цена объекта: 8800000"
    assert short == f"{address}<br>Цена за кв.м: 2 руб."


def test_tooltip(spark):
    df = spark.createDataFrame([("k", None)], "cadnum string, `a.b` long")
    assert df.select(tooltip({"cadnum": "Key", "a.b": "Value"}).alias("t")).first().t == {"Key": "k", "Value": None}
    with pytest.raises(Exception, match="absent"):
        df.select(tooltip({"absent": "X"}))


def test_scale_spans_areas_without_a_feature(spark):
    features = spark.createDataFrame([("a", "g"), ("b", "g"), ("z", "g")], "cadnum string, geometry string")
    metrics = spark.createDataFrame([("a", 0.0, 1), ("b", 5.0, 2), ("far", 10.0, 3)], "quarter_cad_number string, median double, count long")
    found = {r.cadnum: r for r in area_layers(features, metrics, {"median": "M"}).collect()}
    assert found["a"].fill_color == "#ffffccff"
    assert found["b"].fill_color == expected_color(5.0, 0.0, 10.0, "YlOrRd")
    assert (found["z"].fill_color, found["z"].fill_opacity, found["z"]["count"]) == (MISSING_COLOR, 0.1, None)
    assert found["b"].tooltip == {"Кадастровый квартал": "b", "M": "5.0", "Сделок": "2"}
    assert area_layers(features, metrics, {"median": "M"}, how="inner").count() == 2


def test_bids_layer(spark):
    bids = spark.createDataFrame([("a", 1.0, 2.0, 10.0), ("b", 1.0, 2.0, 20.0)], "addr string, lat double, lon double, price_per_sqm double")
    colors = [r.fill_color for r in bids_layer(bids, "Blues", 0.8, "addr").orderBy("value").collect()]
    assert colors == ["#f7fbffff", "#08306bff"]
    assert {r.fill_color for r in bids_layer(bids, None, 0.9, "addr").collect()} == {"black"}


def test_labels_layer(spark):
    shown = spark.createDataFrame(
        [("78:1", 5, 2, ("Point", "[30,60]")), ("78:2", None, None, None)],
        "cadnum string, median_round long, count long, geometry struct<type:string,coordinates:string>",
    )
    found = {r.cadnum: r for r in labels_layer(shown).collect()}
    assert (found["78:1"].lat, found["78:1"].lon, found["78:1"].text) == (60.0, 30.0, "1<br>мед: 5<br>n=2")
    assert (found["78:2"].lat, found["78:2"].lon) == (None, None)
