import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from areaprice.operators import joins
from areaprice.operators.joins import features_with_keys, join_features, lookup_stats, with_area_key


@pytest.fixture
def features(spark):
    return spark.createDataFrame([(1, "p1", 0.5), (2, "p2", 0.6), (None, "p3", 0.7)], "id int, geometry string, x0 double")


def test_left_join_keeps_features(spark, features):
    table = spark.createDataFrame([(1, 10)], "id int, val int")
    joined = join_features(features.where("id is not null"), table, "id")
    assert joined.columns == ["id", "geometry", "x0", "val"]
    assert sorted((r.id, r.val) for r in joined.collect()) == [(1, 10), (2, None)]


def test_overlap_gets_suffixes(spark, features):
    table = spark.createDataFrame([(1, 9.0)], "id int, x0 double")
    row = join_features(features, table, "id", "inner").first()
    assert (row.x0, row.x0_other) == (0.5, 9.0)
    renamed = join_features(features, table, "id", "inner", suffixes=("_l", "_r"))
    assert renamed.columns == ["id", "geometry", "x0_l", "x0_r"]
    with pytest.raises(ValueError, match="x0"):
        join_features(features, table, "id", suffixes=("", ""))


@pytest.mark.parametrize(
    "how, nulls, expected",
    [
        ("left", False, [(1, "p1", 10), (1, "p1", 11), (2, "p2", None), (None, "p3", None)]),
        ("inner", False, [(1, "p1", 10), (1, "p1", 11)]),
        ("right", False, [(1, "p1", 10), (1, "p1", 11), (3, None, 30), (None, None, 40)]),
        ("outer", False, [(1, "p1", 10), (1, "p1", 11), (2, "p2", None), (None, "p3", None), (3, None, 30), (None, None, 40)]),
        ("inner", True, [(1, "p1", 10), (1, "p1", 11), (None, "p3", 40)]),
        ("outer", True, [(1, "p1", 10), (1, "p1", 11), (2, "p2", None), (None, "p3", 40), (3, None, 30)]),
    ],
)
def test_join_kinds(spark, features, how, nulls, expected):
    table = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (None, 40)], "id int, val int")
    joined = join_features(features, table, "id", how, null_keys_match=nulls)
    assert sorted(map(repr, joined.select("id", "geometry", "val").collect())) == sorted(
        map(repr, spark.createDataFrame(expected, "id int, geometry string, val int").collect())
    )


def test_join_refuses_bad_input(spark, features):
    with pytest.raises(TypeError, match="string"):
        join_features(features, spark.createDataFrame([("1", 1)], "id string, val int"), "id")
    with pytest.raises(ValueError, match="cross"):
        join_features(features, features, "id", "cross")


def test_features_with_keys(spark):
    rows = [('{"label":"a"}', "g"), ('{"label":"a"}', None), ('{"label":"b"}', "g"), ("{}", "g")]
    keyed = with_area_key(spark.createDataFrame(rows, "properties string, geometry string"))
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "quarter_cad_number string")
    assert features_with_keys(keyed, keys).count() == 1
    assert features_with_keys(keyed, keys, require_geometry=False).count() == 2


def test_lookup_needs_unique_keys(spark):
    features = spark.createDataFrame([("a",), ("b",), (None,)], "cadnum string")
    metrics = spark.createDataFrame([("a", 1.5, 3), (None, 2.0, 1), (None, 4.0, 1)], "quarter_cad_number string, median double, count long")
    found = {r.cadnum: (r.median, r["count"]) for r in lookup_stats(features, metrics).collect()}
    assert found == {"a": (1.5, 3), "b": (None, None), None: (None, None)}
    with pytest.raises(PySparkException, match="Duplicate area key a"):
        lookup_stats(features, metrics.union(metrics.where("median = 1.5")), ["count"]).collect()


def test_numeric_keys_meet_text_keys(spark):
    features = spark.createDataFrame([("7", 1), ("8", 2)], "cadnum string, geometry int")
    metrics = spark.createDataFrame([(7, 5.0)], "quarter_cad_number long, median double")
    assert [(r.cadnum, r.median) for r in joins.lookup_stats(features, metrics).orderBy("cadnum").collect()] == [("7", 5.0), ("8", None)]
    assert [r.cadnum for r in joins.features_with_keys(features, metrics).collect()] == ["7"]


def test_left_join_of_a_unique_table(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, x int")
    right = spark.createDataFrame([("a", 9), (None, 8)], "k string, x int")
    found = joins.join_features(left, right, "k", unique=True)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, joins.join_features(left, right, "k").collect()), key=repr)


def skewed(spark, seed, size, nulls):
    """Rows of which a third has one key, some in copies, others a key that the other side may lack."""
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "warm", f"k{rng.randint(0, 30)}", None if nulls else "x"]), i // 3 * (i % 2)) for i in range(size)]
    return spark.createDataFrame(rows, "k string, v int").repartition(3)


def plain_join(left, right, how, nulls):
    found, matched = [], set()
    for k, v in left:
        others = [(i, w) for i, (key, w) in enumerate(right) if key == k and (nulls or k is not None)]
        found += [(k, v, w) for _, w in others]
        matched |= {i for i, _ in others}
        if not others and how in ("left", "outer"):
            found.append((k, v, None))
    if how in ("right", "outer"):
        found += [(k, None, w) for i, (k, w) in enumerate(right) if i not in matched]
    return sorted(found, key=repr)


@pytest.mark.parametrize("how", joins.HOW)
@pytest.mark.parametrize(("seed", "sizes", "nulls"), [(1, (60, 90), True), (2, (90, 12), False), (3, (7, 120), True), (4, (80, 0), False), (5, (0, 80), True)])
def test_hot_keys_are_split_over_cells(spark, monkeypatch, how, seed, sizes, nulls):
    monkeypatch.setattr(joins, "HOT_ROWS", 8)
    left = skewed(spark, seed, sizes[0], nulls)
    right = skewed(spark, seed + 50, sizes[1], nulls).where("k <> 'warm' or k is null" if seed % 2 else "true").withColumnRenamed("v", "w")
    found = join_features(left, right, "k", how, null_keys_match=nulls and seed == 3)
    assert found.columns == ["k", "v", "w"]
    expected = plain_join(list(map(tuple, left.collect())), list(map(tuple, right.collect())), how, nulls and seed == 3)
    assert sorted(map(tuple, found.collect()), key=repr) == expected


def test_hot_keys_are_counted_exactly(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    left = spark.createDataFrame([("a",)] * 50 + [(None,)] * 30 + [("b",)] * 20, "key string")
    right = spark.createDataFrame([("a",)] * 3 + [("c",)] * 21, "key string")
    found = joins.hot_keys(left, right)
    assert sorted(map(tuple, found.drop("null_matches").collect()), key=repr) == [("a", 50, 3), ("c", 0, 21), (None, 30, 0)]
    assert joins.hot_keys(left.limit(0), right.limit(0)) is None
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    assert joins.hot_keys(left, right) is None


@pytest.mark.parametrize("how", joins.HOW)
@pytest.mark.parametrize("hot_rows", [5, 1000])
def test_each_side_is_read_once(spark, monkeypatch, tmp_path, capsys, how, hot_rows):
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    for name in ("one", "two"):
        spark.range(100).selectExpr("id % 7 as k", f"id as {name}").write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / name)) for name in ("one", "two"))
    join_features(left, right, "k", how).explain("formatted")
    plan = capsys.readouterr().out.split("\n(1) ")[0]
    assert plan.count("Scan parquet") == 2 and "Cartesian" not in plan


def test_a_hot_key_on_both_sides_is_shared_among_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 200)
    rows = [("hot", 1)] * 3000 + [(f"k{i}", 1) for i in range(3000)]  # rows of the hot key are all alike
    left, right = spark.createDataFrame(rows, "k string, v int").repartition(5), spark.createDataFrame(rows[::-6], "k string, w int")
    left_cells = joins._in_cells(left, F.col("k"), joins.hot_keys(left.selectExpr("k key"), right.selectExpr("k key")), "left", "n_left", "n_right")
    per_cell = left_cells.groupBy("k", "_left_cell").count().agg(F.max("count"), F.count("*")).first()
    assert per_cell[0] <= 200 * 1.2 and per_cell[1] >= 3000 + 3000 / 200
    assert join_features(left, right, "k", "outer").count() == 3000 * 500 + 3000
