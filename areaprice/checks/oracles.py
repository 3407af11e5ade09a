"""DuckDB SQL with the expected result of each query, written apart from the Spark code it checks."""

from __future__ import annotations

from .queries import CENTER_POINT, CLASSES, PERIOD
from .tables import AREA_TABLE, BIDS_DUCKDB, DEALS_DUCKDB, FEATURES, SHAPES

# Palettes as the Spark side must use them.
YLORRD = "ffffcc ffeda0 fed976 feb24c fd8d3c fc4e2a e31a1c bd0026 800026"
BLUES = "f7fbff deebf7 c6dbef 9ecae1 6baed6 4292c6 2171b5 08519c 08306b"
GREYS = "ffffff f0f0f0 d9d9d9 bdbdbd 969696 737373 525252 252525 000000"
YLGNBU6 = "ffffcc c7e9b4 7fcdbb 41b6c4 2c7fb8 253494"

MEDIAN = "Сделки: медиана цены за кв.м"
LABEL_STYLE = "font-size:10px; font-weight:bold; color:black; text-shadow:1px 1px 2px white;"


def number(text: str) -> str:
    pattern = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"
    return f"case when regexp_full_match({text}, '{pattern}') then try_cast(trim({text}) as double) end"


def whole(number_sql: str) -> str:
    return f"cast(round_even({number_sql}, 0) as bigint)"


def ramp(value: str, lo: str, hi: str, palette: str) -> str:
    """Colour of ``value``: nine colours, eight equal segments, channels cut to bytes, opaque."""
    colors = palette.split()
    cases = [f"when {value} is null then '#dddddd'", f"when {value} <= {lo} then '#{colors[0]}ff'",
             f"when {value} >= {hi} then '#{colors[-1]}ff'"]
    for i in range(8):
        start, end = f"({lo} + ({hi} - {lo}) * ({i} / 8e0))", f"({lo} + ({hi} - {lo}) * ({i + 1} / 8e0))"
        share = f"(({value} - {start}) / ({end} - {start}))"
        parts = []
        for c in range(3):
            a, b = (int(color[2 * c : 2 * c + 2], 16) for color in (colors[i], colors[i + 1]))
            level = f"((1e0 - {share}) * ({a} / 255e0) + {share} * ({b} / 255e0))"
            parts.append(f"lpad(lower(to_hex(cast(floor({level} * 255.9999e0) as bigint))), 2, '0')")
        cases.append(f"when {value} <= {end} then concat('#', {', '.join(parts)}, 'ff')")
    return f"case {' '.join(cases)} end"


def classed(value: str, lo: str, hi: str) -> str:
    steps = " + ".join(
        f"cast({value} >= {lo} + (({hi} - {lo}) / {CLASSES}e0) * {step}e0 as int)" for step in range(1, CLASSES)
    )
    return f"case when {value} is null then null when {hi} > {lo} then {steps} else 0 end"


def opacity(value: str, present: float, missing: float) -> str:
    return f"case when {value} is null then cast({missing} as double) else cast({present} as double) end"


def escaped(text: str) -> str:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        text = f"replace({text}, '{plain}', '{entity}')"
    return text


def stats(name: str, source: str, condition: str) -> str:
    return f"""{name} as (
        select quarter_cad_number, avg(p) as arith_mean, median(p) as median, count(p) as count,
               exp(avg(ln(case when p > 0 then p end))) as geom_mean, {whole("median(p)")} as median_round
        from {source} where {condition} group by quarter_cad_number)"""


_SUFFIXED_KEY = """coalesce(nullif(json_extract_string(properties, '$.externalKey'), ''),
    nullif(json_extract_string(properties, '$.label'), ''), nullif(json_extract_string(properties, '$.options.cad_num'), ''))"""



def _shape_rows() -> list[str]:
    """Vertices of each shape in order, with the polygon and the ring in it that they belong to."""
    rows = []
    for shape, (kind, rings) in enumerate(SHAPES):
        number = 0
        for place, (part, ring) in enumerate(rings):
            in_part = sum(1 for other, _ in rings[:place] if other == part)
            for dx, dy in ring:
                rows.append(f"({shape}, '{kind}', {part}, {in_part}, {number}, {dx:e}, {dy:e})")
                number += 1
    return rows


CTES = {
    "deals": f"deals as ({DEALS_DUCKDB})",
    "typed": f"typed as (select * replace ({number('price_per_sqm')} as price_per_sqm) from deals)",
    "prices": "prices as (select *, price_per_sqm as p from typed)",
    "metrics": stats("metrics", "prices", "p > 0"),
    "early": stats("early", "prices", "p is not null and year_build <= 1969"),
    "late": stats("late", "prices", "p is not null and year_build >= 1970"),
    "filtered": stats("filtered", "prices", f"p > 0 and year_build between 1964 and 1972 and period_start_date = '{PERIOD}'"),
    "raw_bids": f"raw_bids as ({BIDS_DUCKDB})",
    "bids": f"""bids as (select "Адрес" as address, "Широта" as lat, "Долгота" as lon, "Цена, руб" as price,
        {number('''replace("Цена за кв.м, руб.", ' ', '')''')} as price_per_sqm from raw_bids where price_per_sqm is not null)""",
    "features": f"features as ({FEATURES})",
    "keyed": f"keyed as (select * replace ({_SUFFIXED_KEY} as cadnum) from features)",
    "area_table": f"area_table as ({AREA_TABLE})",
    "shapes": "shapes(shape, kind, part, ring, i, dx, dy) as (values " + ", ".join(_shape_rows()) + ")",
    "vertices": f"""vertices as (select id, kind, part, ring, i, x0 + dx as x, y0 + dy as y
        from features join shapes on id % {len(SHAPES)} = shape where has_geometry)""",
    "spots": "spots as (select id, any_value(kind) as kind, count(*) as n, avg(x) as lon, avg(y) as lat from vertices group by id)",
    "edges": """edges as (select id, part, ring, x - x1 as x, y - y1 as y, x1, y1, lead(x) over w - x1 as u, lead(y) over w - y1 as v
        from (select *, first_value(x) over (partition by id, part, ring order by i) as x1,
              first_value(y) over (partition by id, part, ring order by i) as y1 from vertices where kind like '%Polygon')
        window w as (partition by id, part, ring order by i))""",
    "rings": """rings as (select id, sum(x * v - u * y) / 2 as a, sum((x * v - u * y) * (x + u)) / 6 as ax,
        sum((x * v - u * y) * (y + v)) / 6 as ay, any_value(x1) as x1, any_value(y1) as y1,
        sign(sum(x * v - u * y)) * case when ring = 0 then 1 else -1 end as turn
        from edges where u is not null group by id, part, ring)""",
    "moments": """moments as (select id, sum(turn * a) as area, sum(turn * (ax + a * x1)) / sum(turn * a) as cx,
        sum(turn * (ay + a * y1)) / sum(turn * a) as cy from rings group by id)""",
    "bids_middle": "bids_middle as (select round(avg(lat), 9) as center_lat, round(avg(lon), 9) as center_lon from bids)",
}

# What each common table needs before it.
NEEDS = {
    "typed": ["deals"], "prices": ["typed"], "metrics": ["prices"], "early": ["prices"], "late": ["prices"],
    "filtered": ["prices"], "bids": ["raw_bids"], "keyed": ["features"], "vertices": ["features", "shapes"], "edges": ["vertices"],
    "spots": ["vertices"], "rings": ["edges"], "moments": ["rings"], "bids_middle": ["bids"],
}


def sql(body: str, *names: str, extra: str = "") -> str:
    """``body`` after the common tables it uses, in the order they build on each other."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [CTES[name] for name in ordered] + ([extra] if extra else [])
    return f"with {', '.join(parts)} {body}" if parts else body


def rounded_stats(source: str) -> str:
    return f"""select quarter_cad_number, round(arith_mean, 4) as arith_mean, round(geom_mean, 4) as geom_mean, median,
        median_round, count from {source}"""


def domain(source: str, column: str = "median", name: str = "domain") -> str:
    return f"{name} as (select min({column}) as lo, max({column}) as hi from {source})"


def area_rows(layer: str, metric: str, source: str, features: str, palette: str, shown: tuple[float, float], join: str) -> str:
    """Rows of one area layer with all columns of a map row."""
    return f"""select '{layer}' as layer, cadnum, count, {ramp(metric, "lo", "hi", palette)} as fill_color,
        {opacity(metric, *shown)} as fill_opacity, {metric if metric == "median" else f"round({metric}, 4)"} as value, null::double as lat, null::double as lon,
        null::varchar as text
        from {features} {join} join {source} on cadnum = quarter_cad_number,
        (select min({metric}) as lo, max({metric}) as hi from {source})"""


def bid_rows(palette: str | None, shown: float, with_price: bool) -> str:
    color = ramp("price_per_sqm", "lo", "hi", palette) if palette else "'black'"
    return f"""select 'Предложения (точки)' as layer, null as cadnum, null as count, {color} as fill_color,
        cast({shown} as double) as fill_opacity, round(price_per_sqm, 4) as value, round(lat, 9) as lat, round(lon, 9) as lon,
        {popup(with_price)} as text
        from bids, (select min(price_per_sqm) as lo, max(price_per_sqm) as hi from bids)"""


def popup(with_price: bool) -> str:
    price = ", '<br>Цена объекта: ', cast(price as varchar)" if with_price else ""
    return f"""concat({escaped("address")}, '<br>Цена за кв.м: ', cast({whole("price_per_sqm")} as varchar), ' руб.'{price})"""


def label(title: str) -> str:
    return f"""concat({title}, '<br>мед: ', coalesce(cast(median_round as varchar), '—'),
        '<br>n=', coalesce(cast(count as varchar), '—'))"""


SHORT_TITLE = "coalesce(split_part(cadnum, ':', -1), '')"
LONG_TITLE = "coalesce(cadnum, '')"


def label_rows(source: str, features: str, title: str, join: str) -> str:
    return f"""select 'Подписи' as layer, cadnum, null as count, null as fill_color, null as fill_opacity, null as value,
        round(spot.lat, 9) as lat, round(spot.lon, 9) as lon, {label(title)} as text
        from {features} {join} join {source} on cadnum = quarter_cad_number
        join (select id, avg(x) as lon, avg(y) as lat from vertices group by id) spot using (id)"""


def box(features: str) -> str:
    return f"""(select round((min(y) + max(y)) / 2, 9) as center_lat, round((min(x) + max(x)) / 2, 9) as center_lon
        from vertices where id in (select id from {features}))"""


def joined(how: str) -> str:
    key = {"left": "f.cadnum", "inner": "f.cadnum", "right": "t.cadnum", "outer": "coalesce(f.cadnum, t.cadnum)"}[how]
    kind = "full outer" if how == "outer" else how
    return sql(
        f"""select f.id, {key} as cadnum, f.x0, f.y0, t.val, t.x0 as x0_other
            from features f {kind} join area_table t on f.cadnum = t.cadnum""",
        "features",
        "area_table",
    )


def labels(title: str) -> str:
    text = label(title)
    return sql(
        f"""select cast(id as varchar) as id, {text} as text, concat('<div style=''{LABEL_STYLE}''>', {text}, '</div>') as html
            from keyed left join metrics on cadnum = quarter_cad_number""",
        "keyed",
        "metrics",
    )


def union(*parts: str) -> str:
    return " union all ".join(f"({part})" for part in parts)


METRIC_ROWS = [("median", MEDIAN), ("arith_mean", "Сделки: среднее арифм. цены за кв.м"), ("geom_mean", "Сделки: среднее геом. цены за кв.м")]
HEAT_ROWS = [("arith_mean", "Среднее арифм. цены сделок"), ("geom_mean", "Среднее геом. цены сделок"), ("median", "Медиана цены сделок")]
WITH_GEOMETRY = "with_geometry as (select * from keyed where has_geometry and cadnum is not null)"


def two_periods(source: str, name: str) -> str:
    shown = "(select * from with_geometry where cadnum in (select quarter_cad_number from early union select quarter_cad_number from late))"
    rows = union(
        area_rows("Медиана цены за кв.м", "median", source, shown, YLORRD, (0.65, 0.1), "left"),
        label_rows(source, shown, LONG_TITLE, "left"),
    )
    return f"select *, '{name}' as map from ({rows}), {box(shown)}"


def labeled(source: str, palette: str) -> str:
    shown = f"(select * from with_geometry where cadnum in (select quarter_cad_number from {source}))"
    rows = union(
        area_rows("Медиана цены за кв.м", "median", source, shown, palette, (0.65, 0.1), "left"),
        label_rows(source, shown, SHORT_TITLE, "left"),
    )
    return sql(f"select * from ({rows}), {box(shown)}", "keyed", "vertices", source, extra=WITH_GEOMETRY)


DEAL_COLUMNS = "quarter_cad_number, street, wall_material_code, year_build, floor, area, period_start_date, deal_price, price_per_sqm"

ORACLES = {
    "read_table": sql(
        "select f as format, cadnum, val, x0 from area_table, (values ('csv'), ('tsv'), ('parquet')) formats(f)", "area_table"
    ),
    "read_deals": sql(f"select {DEAL_COLUMNS} from typed", "typed"),
    "read_cp1251": sql(f"select {DEAL_COLUMNS} from typed", "typed"),
    "read_probed": sql(f"select {DEAL_COLUMNS}, f as file from typed, (values ('old'), ('new')) files(f)", "typed"),
    "read_bids": sql("select address, lat, lon, price_per_sqm from bids", "bids"),
    "read_metrics": sql(
        """select quarter_cad_number, round(arith_mean, 4) as arith_mean, median,
            round(geom_mean, 4) as geom_mean, count from metrics""",
        "metrics",
    ),
    "metrics_reuse": sql("select quarter_cad_number, median, count from metrics", "metrics"),
    "metrics_updated": sql(rounded_stats("metrics").replace("median_round, ", ""), "metrics"),
    "read_geojson": sql(
        """select cast(id as varchar) as id, 'Feature' as type, json_extract_string(properties, '$.label') as label,
            json_extract_string(properties, '$.externalKey') as "externalKey",
            json_extract_string(properties, '$.options.cad_num') as cad_num, cadnum, kind, cast(n as int) as n
            from keyed left join spots using (id)""",
        "keyed",
        "spots",
    ),
    "read_geojson_collections": sql(
        """select cast(id as varchar) as id, 'Feature' as type, json_extract_string(properties, '$.label') as label,
            json_extract_string(properties, '$.externalKey') as "externalKey",
            json_extract_string(properties, '$.options.cad_num') as cad_num, cadnum, kind, cast(n as int) as n
            from keyed left join spots using (id)""",
        "keyed",
        "spots",
    ),
    "write_csv": sql(
        """select "Адрес" as address, "Широта" as lat, "Долгота" as lon, "Цена, руб" as price,
            "Цена за кв.м, руб." as price_raw from raw_bids""",
        "raw_bids",
    ),
    "write_geojson": sql(
        """select cast(id as varchar) as id, kind, cast(n as int) as n, round(lon, 9) as lon, round(lat, 9) as lat, cadnum,
            json_extract_string(properties, '$.label') as label, cast(median_round as varchar) as median_round,
            cast(count as varchar) as count, median_round is null as null_kept
            from keyed left join metrics on cadnum = quarter_cad_number left join spots using (id)""",
        "keyed",
        "metrics",
        "spots",
    ),
    "write_layer": sql(
        "select layer, cadnum, count, fill_color, fill_opacity, value from ("
        + union(*[area_rows(name, m, "metrics", "features", YLORRD, (0.65, 0.1), "left") for m, name in METRIC_ROWS])
        + ")",
        "features",
        "metrics",
    ),
    "lenient_number": sql("select quarter_cad_number, year_build, price_per_sqm as price from typed", "typed"),
    "bids_clean": sql("select address, lat, lon, price_per_sqm from bids", "bids"),
    "bid_popups": sql(f"select lat, lon, {popup(False)} as short_text, {popup(True)} as text from bids", "bids"),
    "area_stats": sql(rounded_stats("metrics"), "metrics"),
    "area_stats_all_prices": sql(rounded_stats("everything"), "prices", extra=stats("everything", "prices", "p is not null")),
    "area_stats_filtered": sql(rounded_stats("filtered"), "filtered"),
    "area_stats_on_dates": sql(rounded_stats("filtered"), "filtered"),
    "area_median": sql("select quarter_cad_number, median, count, median_round from metrics", "metrics"),
    "metric_domain": sql("select min(median) as lo, max(median) as hi from metrics", "metrics"),
    "area_keys": sql("select distinct quarter_cad_number from prices where p > 0", "prices"),
    "keys_union": sql("select quarter_cad_number from early union select quarter_cad_number from late", "early", "late"),
    "bids_center": sql("select center_lat as lat, center_lon as lon from bids_middle", "bids_middle"),
    "feature_key": sql(f"select cast(id as varchar) as id, cadnum, {SHORT_TITLE} as suffix from keyed", "keyed"),
    "features_with_deals": sql(
        """select cast(id as varchar) as id, cadnum from keyed
            where has_geometry and cadnum in (select quarter_cad_number from prices where p > 0)""",
        "keyed",
        "prices",
    ),
    **{f"join_features_{how}": joined(how) for how in ("left", "right", "inner", "outer")},
    "join_features_hot_keys": """select coalesce(l_returnflag, k) as flag, l_orderkey, l_linenumber, r_name as name from lineitem full join
            (select *, case r_regionkey when 0 then 'A' when 1 then 'R' when 2 then 'X' when 3 then 'A' end as k from region)
            on l_returnflag = k""",
    "vertex_count": sql("select cast(id as varchar) as id, cast(n as int) as n from features left join spots using (id)", "spots"),
    "label_point": sql(
        """select cast(f.id as varchar) as id, round(lon, 9) as lon, round(lat, 9) as lat from features f
            left join (select id, avg(x) as lon, avg(y) as lat from vertices group by id) v on f.id = v.id""",
        "vertices",
    ),
    "area_centroid": sql(
        """select cast(f.id as varchar) as id, round(cx, 9) as centroid_lon, round(cy, 9) as centroid_lat
            from features f left join moments m on f.id = m.id""",
        "moments",
    ),
    "bbox_center": sql("select center_lat as lat, center_lon as lon from " + box("features"), "vertices"),
    "union_center": sql(
        "select round(sum(area * cy) / sum(area), 9) as lat, round(sum(area * cx) / sum(area), 9) as lon from moments", "moments"
    ),
    # Between all heights at which an edge ends or two cross, edges from left to right enter and leave their polygons.
    "union_center_dissolved": sql(
        """select round(sum(h * (b * (w0 + w1) / 2 + h * (w0 / 6 + w1 / 3))) / sum(h * (w0 + w1) / 2) + 5.99e1, 9) as lat,
               round(sum(h * (r0 * r0 + r0 * r1 + r1 * r1 - l0 * l0 - l0 * l1 - l1 * l1) / 6) / sum(h * (w0 + w1) / 2) + 3e1, 9) as lon
           from (select *, t - b as h, r0 - l0 as w0, r1 - l1 as w1 from covered where n > 0 and r0 is not null)""",
        "vertices",
        extra="""sides as (select id, part, x - 3e1 as x, y - 5.99e1 as y, lead(x) over w - 3e1 as u, lead(y) over w - 5.99e1 as v
                from vertices where kind like '%Polygon' window w as (partition by id, part, ring order by i)),
            ups as (select row_number() over () as e, concat(id, '-', part) as p, case when y < v then x else u end as xa, least(y, v) as ya,
                greatest(y, v) as yb, (u - x) / (v - y) as s, least(x, u) as west, greatest(x, u) as east from sides where y <> v),
            crossings as (select a.ya + (a.xa - b.xa - b.s * (a.ya - b.ya)) / (b.s - a.s) as y,
                    greatest(a.ya, b.ya) as low, least(a.yb, b.yb) as high
                from ups a join ups b on a.e < b.e and a.s <> b.s and a.west <= b.east and b.west <= a.east and a.ya < b.yb and b.ya < a.yb),
            heights as (select ya as y from ups union select yb from ups union select y from crossings where y > low and y < high),
            slabs as (select y as b, lead(y) over (order by y) as t from heights),
            active as (select b, t, p, xa + s * (b - ya) as l0, xa + s * (t - ya) as l1 from slabs join ups on ya <= b and yb >= t),
            entered as (select *, case when row_number() over (partition by b, p order by l0 + l1) % 2 = 1 then 1 else -1 end as turn from active),
            covered as (select *, sum(turn) over (w rows unbounded preceding) as n, lead(l0) over w as r0, lead(l1) over w as r1
                from entered window w as (partition by b order by l0 + l1, turn desc, p))""",
    ),
    "distance_from_point": sql(
        f"""select "Адрес" as address, round(sqrt(power(m * radians("Широта" - {CENTER_POINT[0]}e0), 2)
                + power(n * cos(ph) * radians("Долгота" - {CENTER_POINT[1]}e0), 2)), 4) as distance_m
            from raw_bids, lateral (select radians(("Широта" + {CENTER_POINT[0]}e0) / 2) as ph),
                 lateral (select 1 - 0.00669437999014e0 * power(sin(ph), 2) as w),
                 lateral (select 6378137e0 * (1 - 0.00669437999014e0) / power(w, 1.5e0) as m, 6378137e0 / sqrt(w) as n)""",
        "raw_bids",
    ),
    "color_ramp": sql(
        f"""select quarter_cad_number, median, count, {ramp("median", "lo", "hi", YLORRD)} as fill_color,
            cast(0.65 as double) as fill_opacity from metrics, domain""",
        "metrics",
        extra=domain("metrics"),
    ),
    "class_bins": sql(
        f"""select cadnum, median, {classed("median", "lo", "hi")} as class,
            coalesce(list_extract([{", ".join(f"'#{c}'" for c in YLGNBU6.split())}], {classed("median", "lo", "hi")} + 1), 'black')
                as fill_color, cast(0.7 as double) as fill_opacity
            from features left join metrics on cadnum = quarter_cad_number, domain""",
        "features",
        "metrics",
        extra=domain("metrics"),
    ),
    "area_layer": sql(
        f"""select '{MEDIAN}' as layer, cadnum, count, {ramp("median", "lo", "hi", YLORRD)} as fill_color,
            {opacity("median", 0.65, 0.1)} as fill_opacity, median as value
            from features left join metrics on cadnum = quarter_cad_number, domain""",
        "features",
        "metrics",
        extra=domain("metrics"),
    ),
    "layer_tooltip": sql(
        """select cadnum, cast(median_round as varchar) as median_round, cast(count as varchar) as count
            from features left join metrics on cadnum = quarter_cad_number""",
        "features",
        "metrics",
    ),
    "area_labels": labels(SHORT_TITLE),
    "area_labels_long": labels(LONG_TITLE),
    "map_quick": sql(
        f"""select cadnum, val, {classed("val", "lo", "hi")} as class,
            coalesce(list_extract([{", ".join(f"'#{c}'" for c in YLGNBU6.split())}], {classed("val", "lo", "hi")} + 1), 'black')
                as fill_color, cast(0.7 as double) as fill_opacity, cadnum as tip, center_lat, center_lon
            from joined, (select min(val) as lo, max(val) as hi from joined),
            (select round(sum(area * cy) / sum(area), 9) as center_lat, round(sum(area * cx) / sum(area), 9) as center_lon from moments)""",
        "moments",
        "area_table",
        extra="joined as (select f.cadnum, val from features f left join area_table t on f.cadnum = t.cadnum)",
    ),
    "map_deals_bids": sql(
        "select * from ("
        + union(
            *[area_rows(name, m, "metrics", "keyed", YLORRD, (0.7, 0.2), "inner") for m, name in HEAT_ROWS],
            bid_rows(BLUES, 0.8, with_price=False),
        )
        + "), bids_middle",
        "keyed",
        "metrics",
        "bids_middle",
    ),
    "map_bids": sql(
        "select * from ("
        + union(
            *[area_rows(name, m, "metrics", "features", YLORRD, (0.6, 0.1), "left") for m, name in METRIC_ROWS],
            bid_rows(YLORRD, 0.9, with_price=True),
        )
        + "), bids_middle",
        "features",
        "metrics",
        "bids_middle",
    ),
    "map_bids_without_medians": sql(
        "select * from ("
        + union(
            *[area_rows(name, m, "metrics", "features", YLORRD, (0.6, 0.1), "left") for m, name in METRIC_ROWS if m != "median"],
            bid_rows(YLORRD, 0.9, with_price=True),
        )
        + "), bids_middle",
        "features",
        "metrics",
        "bids_middle",
    ),
    "map_median": sql(
        f"""select * from ({area_rows(MEDIAN, "median", "metrics", "features", YLORRD, (0.65, 0.1), "left")}), {box("features")}""",
        "vertices",
        "metrics",
    ),
    "map_median_bids": sql(
        "select * from ("
        + union(
            area_rows(MEDIAN, "median", "metrics", "features", YLORRD, (0.65, 0.1), "left"), bid_rows(None, 0.9, with_price=True)
        )
        + f"), {box('features')}",
        "vertices",
        "metrics",
        "bids",
    ),
    "map_two_periods": sql(
        union(two_periods("early", "a"), two_periods("late", "b")), "keyed", "vertices", "early", "late", extra=WITH_GEOMETRY
    ),
    "map_labeled": labeled("metrics", YLORRD),
    "map_labeled_filtered": labeled("filtered", GREYS),
}
