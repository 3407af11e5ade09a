import pytest
from pyspark.sql import functions as F

from areaprice.functions.numbers import lenient_double, missing_to_null, round_half_even, whole_text, without_spaces
from areaprice.functions.keys import area_key, key_suffix


def test_lenient_double(spark):
    cases = {
        " 3 ": 3.0, "1e3": 1000.0, "12d": None, "1f": None, "": None, "1,5": None, "nan": None, "n/a": None,
        "-5": -5.0, ".5": 0.5, "2.": 2.0, "+7": 7.0, "inf": None, "1.2.3": None, "0x1A": None, "н/д": None,
    }
    rows = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string").select("t", lenient_double(F.col("t")).alias("v"))
    assert {r.t: r.v for r in rows.collect()} == {**cases, None: None}


def test_spaces_between_digits(one):
    assert one(lenient_double(without_spaces(F.col("x"))), "x string", "195 556") == 195556.0
    # A no-break space is not a plain space.
    assert one(lenient_double(without_spaces(F.col("x"))), "x string", "195 556") is None


@pytest.mark.parametrize("value, rounded", [(0.5, 0), (1.5, 2), (2.5, 2), (3.5, 4), (-0.5, 0), (-1.5, -2), (7.49, 7), (None, None)])
def test_round_half_even(one, value, rounded):
    assert one(round_half_even(F.col("x")), "x double", value) == rounded
    assert one(whole_text(F.col("x")), "x double", value) == (None if rounded is None else str(rounded))


def test_missing_markers(spark):
    rows = spark.createDataFrame([("NA",), ("nan",), ("Nan street",), (None,), ("",)], "t string")
    assert [r.v for r in rows.select(missing_to_null(F.col("t")).alias("v")).collect()] == [None, None, "Nan street", None, ""]


@pytest.mark.parametrize(
    "properties, key",
    [
        ('{"externalKey":"","label":"A"}', "A"),
        ('{"externalKey":"E","label":"A"}', "E"),
        ('{"externalKey":null,"options":{"cad_num":"C"}}', "C"),
        ('{"options":"text"}', None),
        ("{}", None),
        (None, None),
    ],
)
def test_area_key(one, properties, key):
    assert one(area_key(F.col("x")), "x string", properties) == key


@pytest.mark.parametrize("key, suffix", [("78:10:0005203", "0005203"), ("plain", "plain"), (None, ""), ("a:", "")])
def test_key_suffix(one, key, suffix):
    assert one(key_suffix(F.col("x")), "x string", key) == suffix
