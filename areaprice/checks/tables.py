"""Deals, offers, features and an area table derived from the test tables, row by row over whole tables.

The SQL of each view is given once where Spark and DuckDB understand the same text, else once for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AREA = "concat('78:10:', lpad(cast({} as string), 7, '0'))"

_DEALS = f"""
select {AREA.format("l_partkey % 97")} as quarter_cad_number,
       concat('ул. ', l_returnflag, ' «', l_linestatus, '»') as street,
       case when l_linenumber % 2 = 0 then 'Кирпичные' else 'Крупнопанельные' end as wall_material_code,
       cast(1950 + l_suppkey % 40 as int) as year_build, cast(l_linenumber as int) as floor, l_quantity as area,
       {{period}} as period_start_date, l_extendedprice as deal_price,
       case when l_orderkey % 50 = 0 then 'n/a' when l_orderkey % 50 = 1 then '0' when l_orderkey % 50 = 2 then '-5'
            else cast(l_extendedprice / l_quantity as string) end as price_per_sqm
from lineitem"""
DEALS_SPARK = _DEALS.format(period="date_format(date_trunc('quarter', l_shipdate), 'dd.MM.yyyy')")
DEALS_DUCKDB = _DEALS.format(period="strftime(date_trunc('quarter', l_shipdate), '%d.%m.%Y')")

_BIDS = """
select concat('"', c_name, '", д. <', cast(c_custkey % 7 as string), '> & ', c_mktsegment) as {q}Адрес{q},
       59.9e0 + cast(c_custkey % 200 as double) / 1e4 as {q}Широта{q},
       30.3e0 + cast(c_custkey % 173 as double) / 1e4 as {q}Долгота{q},
       cast(floor(abs(c_acctbal)) as bigint) * 1000 as {q}Цена, руб{q},
       case when c_custkey % 41 = 0 then 'н/д'
            else concat(cast(cast(floor(abs(c_acctbal)) as bigint) as string), ' ',
                        lpad(cast(c_custkey % 1000 as string), 3, '0'))
       end as {q}Цена за кв.м, руб.{q},
       cast(20 + c_custkey % 100 as double) as {q}Площадь, кв.м{q}
from customer"""
BIDS_SPARK = _BIDS.format(q="`")
BIDS_DUCKDB = _BIDS.format(q='"')

FEATURES = f"""
select s_suppkey as id, {AREA.format("s_suppkey")} as cadnum,
       30e0 + cast(s_suppkey % 10 as double) / 1e2 as x0, 59.9e0 + floor(cast(s_suppkey as double) / 1e1) / 1e2 as y0,
       s_suppkey % 20 <> 19 as has_geometry,
       case when s_suppkey % 25 = 24 then '{{}}'
            when s_suppkey % 4 = 0 then concat('{{"externalKey":"', {AREA.format("s_suppkey")}, '"}}')
            when s_suppkey % 4 = 1 then concat('{{"externalKey":"","label":"', {AREA.format("s_suppkey")}, '"}}')
            when s_suppkey % 4 = 2 then concat('{{"options":{{"cad_num":"', {AREA.format("s_suppkey")}, '"}}}}')
            else concat('{{"externalKey":null,"label":"', {AREA.format("s_suppkey")}, '"}}') end as properties
from supplier"""

AREA_TABLE = f"""
select {AREA.format("p_partkey + 40")} as cadnum, p_retailprice as val, cast(p_size as double) as x0 from part"""

# Shapes of features, by s_suppkey modulo their number: kind, and rings of offsets from (x0, y0), each ring in a
# polygon (or line, or point) that has a number.
_FIVE = ((0.0, 0.0), (9e-3, 0.0), (9e-3, 4e-3), (3e-3, 8e-3), (0.0, 0.0))
_FOUR = ((0.0, 0.0), (8e-3, 0.0), (8e-3, 8e-3), (0.0, 0.0))
_HOLE = ((2e-3, 1e-3), (2e-3, 2e-3), (4e-3, 2e-3), (4e-3, 1e-3), (2e-3, 1e-3))
_AWAY = ((1e-2, 1e-2), (1.5e-2, 1e-2), (1.2e-2, 1.6e-2), (1e-2, 1e-2))
SHAPES = (
    ("Polygon", ((0, _FIVE),)),
    ("Polygon", ((0, _FIVE), (0, _HOLE))),
    ("MultiPolygon", ((0, _FOUR), (1, _AWAY))),
    ("Polygon", ((0, _FOUR),)),
    ("Point", ((0, ((4e-3, 4e-3),)),)),
    ("LineString", ((0, _FOUR[:3]),)),
    ("MultiPolygon", ((0, _FIVE), (0, _HOLE), (1, _AWAY))),
)

# Brackets fewer than a MultiPolygon has around its coordinates.
DEPTHS = {"MultiPolygon": 0, "Polygon": 1, "LineString": 2, "Point": 3}


def _select(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace(f"from {table}", f"from parquet.`{sf_dir}/{table}.parquet`"))


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sales with the price per square metre still as text."""
    return _select(spark, sf_dir, "lineitem", DEALS_SPARK)


def raw_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers as they come in a file."""
    return _select(spark, sf_dir, "customer", BIDS_SPARK)


def keyed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with ``cadnum``, origin and GeoJSON geometry."""
    rows = _select(spark, sf_dir, "supplier", FEATURES)
    def of_shape(values: list) -> Column:
        return F.element_at(F.lit(values), (F.col("id") % len(SHAPES) + 1).cast("int"))

    def listed(parts: Column, text) -> Column:
        """JSON text of a list."""
        return F.concat(F.lit("["), F.array_join(F.transform(parts, text), ","), F.lit("]"))

    def vertex(v: Column) -> Column:
        return F.concat(F.lit("["), (F.col("x0") + v[0]).cast("string"), F.lit(","), (F.col("y0") + v[1]).cast("string"), F.lit("]"))

    def ring(vertices: Column) -> Column:
        return listed(vertices, vertex)

    # Every shape is written as polygons of rings of vertices, and the brackets that its kind lacks are cut off.
    polygons = listed(of_shape([_polygons(rings) for _, rings in SHAPES]), lambda polygon: listed(polygon, ring))
    depth = of_shape([DEPTHS[kind] for kind, _ in SHAPES])
    coordinates = F.substr(polygons, depth + 1, F.char_length(polygons) - 2 * depth)
    shape = F.struct(of_shape([kind for kind, _ in SHAPES]).alias("type"), coordinates.alias("coordinates"))
    # One row of each, through a generator, so that the text is not written out again wherever it is used.
    return rows.select("*", F.inline(F.array(F.struct(F.when(F.col("has_geometry"), shape).alias("geometry")))))


def _polygons(rings) -> list[list[list[list[float]]]]:
    parts: dict[int, list] = {}
    for part, ring in rings:
        parts.setdefault(part, []).append([list(offsets) for offsets in ring])
    return list(parts.values())


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as they come from GeoJSON: the key is only in the properties."""
    return keyed_features(spark, sf_dir).select(
        F.col("id").cast("string").alias("id"), F.lit("Feature").alias("type"), "geometry", "properties"
    )


def area_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with a value per area; its ``x0`` is also a column of the features."""
    return _select(spark, sf_dir, "part", AREA_TABLE)
