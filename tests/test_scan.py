"""The structural scan of GeoJSON against a plain JSON parser, in byte ranges of any size."""

import json
import random

import pytest

from areaprice.sources import scan
from areaprice.sources.features import read_features
from areaprice.sources.sinks import write_features


def feature(i, rng):
    words = ["}", "{", "[", "]", '"', "\\", '\\"', "é", "漢", "plain", '"features": [', "\n", ",", " "]
    text = "".join(rng.choice(words) for _ in range(rng.randint(0, 12)))
    point = [round(rng.uniform(-9, 9), 3), 1.5]
    shapes = [
        None,
        {"type": "Point", "coordinates": point},
        {"type": "Polygon", "coordinates": [[point, [1, 2], [3, 4], point]] * rng.randint(1, 9)},
    ]
    properties = rng.choice([None, {}, {"label": text, "features": [{"a": text}, []], "options": {"cad_num": text, "deep": [[{}]]}}])
    return {"type": "Feature", "id": i, "geometry": rng.choice(shapes), "properties": properties}


def collection(features, extra=()):
    head = {"type": "FeatureCollection", "name": '"features": [', "crs": {"type": "name", "properties": {"features": "x"}}}
    tail = {"bbox": [0, 1], "meta": [{"not": "a feature"}, {"features": [{"type": "x"}]}]}
    order = [("head", head), ("features", {"features": features}), ("tail", tail)]
    return {key: value for name, part in order if name not in extra for key, value in part.items()}


def layouts(features):
    many = "\n".join(json.dumps(f, ensure_ascii=False) for f in features)
    return {
        "document": json.dumps(collection(features)),
        "bare": json.dumps({"features": features}, separators=(",", ":")),
        "no tail": json.dumps(collection(features, ["tail"]), ensure_ascii=False) + "\n\n",
        "late features": json.dumps(dict(reversed(collection(features).items())), ensure_ascii=False),
        "pretty": json.dumps(collection(features), indent=2),
        "windows": "﻿" + json.dumps(collection(features), indent=1, ensure_ascii=False).replace("\n", "\r\n"),
        "lines": many,
        "sequence": "\n".join("\x1e" + line for line in many.split("\n")) + "\n",
        "two collections": json.dumps(collection(features[::2])) + "\n" + json.dumps(collection(features[1::2])),
    }


def plain_scan(data, ranges):
    """Feature texts by the functions of the scan, with the text cut into records and ranges of them."""
    records = data.split(scan.END)
    unfinished = True
    if not records[-1]:
        records.pop()
        unfinished = False
    cuts = sorted({0, *(c for c in ranges if c < len(records)), len(records)})
    texts = [scan.END.join(records[a:b]) for a, b in zip(cuts, cuts[1:])]
    whole, parts, state, since = [], {}, scan.Summary(), []
    for number, text in enumerate(texts):
        cut_short = unfinished and number == len(texts) - 1
        found = scan._Range("f", number, state.inside, state.opened, since[0] if since else None, since[2] if len(since) > 2 else None)
        found.scan(text)
        found.end(cut_short)
        whole += [text for _, text in found.whole]
        for _, top, began, _, void, part in found.parts:
            parts.setdefault((top, began), []).append((void, part))
        part = scan.summarise(text + (b"" if cut_short else scan.END), state.inside)
        state = state.then(part)
        since = since[: len(state.opened) - len(part.opened)] + [number] * len(part.opened)
    whole += ["".join(part for _, part in some) for some in parts.values() if not any(void for void, _ in some)]
    return whole


@pytest.mark.parametrize("seed", range(12))
def test_ranges_of_any_size_give_the_same_features(seed):
    rng = random.Random(seed)
    features = [feature(i, rng) for i in range(rng.choice([0, 1, 2, 15]))]
    for name, text in layouts(features).items():
        data = text.encode()
        for size in (1, 2, 7, 10**6):
            step = list(range(0, len(data), size))
            found = plain_scan(data, step if size > 1 else [c for c in step if rng.random() < 0.7])
            assert sorted(map(json.loads, found), key=lambda f: f["id"]) == features, (name, size)


def test_summaries_can_be_put_together_in_any_order():
    rng = random.Random(3)
    for name, text in layouts([feature(i, rng) for i in range(6)]).items():
        data = text.encode()
        cuts = sorted(rng.sample(range(len(data)), 9))
        # Cuts lie where records end, as a key and its bracket or a backslash and its quote are not cut apart.
        cuts = [0, *sorted({data.rfind(scan.END, 0, c) + 1 for c in cuts}), len(data)]
        parts = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        whole = scan.summarise(data, False)
        for split in range(1, len(parts)):
            left, right = scan.Summary(), None
            for part in parts[:split]:
                left = left.then(scan.summarise(part, left.inside))
            right = scan.Summary(left.inside)
            for part in parts[split:]:
                right = right.then(scan.summarise(part, right.inside))
            assert left.then(right) == whole == scan.Summary(), name


@pytest.fixture
def small_ranges(spark):
    kept = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for name, value in kept.items():
        spark.conf.set(name, value)


def test_one_line_is_read_by_several_tasks(spark, tmp_path, small_ranges):
    rng = random.Random(8)
    features = [feature(i, rng) for i in range(60)]
    features[7]["properties"] = {"label": "x" * 3000}  # longer than ranges are
    for name, text in layouts(features).items():
        folder = tmp_path / name.replace(" ", "-")
        folder.mkdir()
        (folder / "a.geojson").write_bytes(text.encode())
        (folder / "b.geojson").write_bytes(text.encode() + b"\n")
        read = read_features(spark, str(folder))
        assert scan._records(spark, str(folder)).rdd.getNumPartitions() > 10, name
        rows = sorted(read.collect(), key=lambda r: int(r["id"]))
        assert [int(r["id"]) for r in rows] == [f["id"] for f in features for _ in "ab"], name
        for row, f in zip(rows, [f for f in features for _ in "ab"]):
            assert row["type"] == "Feature"
            assert json.loads(row["properties"] or "null") == f["properties"]
            if f["geometry"] is None:
                assert row["geometry"] is None
            else:
                assert row["geometry"]["type"] == f["geometry"]["type"]
                assert json.loads(row["geometry"]["coordinates"]) == f["geometry"]["coordinates"]


GOOD = '{"type":"Feature","id":1,"geometry":null,"properties":{}}'


@pytest.mark.parametrize(
    ("text", "message"),
    [
        ('{"type":"Point","coordinates":[1,2]}', "Neither"),
        ('{"type":"FeatureCollection"}', "Neither"),
        ('{"type":"FeatureCollection","features":null}', "Neither"),
        ('{"type":"FeatureCollection","features":[1]}', "should be"),
        ('{"type":"FeatureCollection","features":[[]]}', "should be"),
        (f"[{GOOD}]", "should be"),
        ("null", "should be"),
        (GOOD[:-1], "too early"),
        (GOOD[:-2], "too early"),
        (f'{{"features":[{GOOD},{GOOD}]', "too early"),
        (f'{{"features":[{GOOD},{GOOD}', "too early"),
        (GOOD + "}", "didn't open"),
        (f'{GOOD}\n{GOOD[:30]}"', "too early|should be"),
        (f'{{"features":[{GOOD}, x]}}', "should be"),
        ('{"features":[{"type":"Feature","id":01}]}', "(?i)malformed|parse"),
    ],
)
def test_what_is_no_geojson_is_an_error(spark, tmp_path, text, message):
    path = tmp_path / "f.geojson"
    path.write_text(text)
    with pytest.raises(Exception, match=message):
        read_features(spark, str(path)).collect()


def test_a_collection_on_a_line_is_an_error_with_lines(spark, tmp_path):
    path = tmp_path / "f.geojson"
    path.write_text(f'{{"type":"FeatureCollection","features":[{GOOD}]}}')
    with pytest.raises(Exception, match="without lines"):
        read_features(spark, str(path), lines=True).collect()
    assert read_features(spark, str(path)).count() == 1
    path.write_text('{"type":"Point","coordinates":[1,2]}')
    with pytest.raises(Exception, match="Neither"):
        read_features(spark, str(path), lines=True).collect()


def test_nothing_in_a_file(spark, tmp_path):
    for name, text in {"a": "", "b": " \n", "c": '{"type":"FeatureCollection","features":[]}'}.items():
        (tmp_path / f"{name}.geojson").write_text(text)
        assert read_features(spark, str(tmp_path / f"{name}.geojson")).count() == 0
    (tmp_path / "d.geojson").write_text(GOOD)
    assert read_features(spark, str(tmp_path)).count() == 1


def test_compressed_documents(spark, tmp_path):
    import gzip

    for end in ("", "\n"):
        path = tmp_path / "f.geojson.gz"
        path.write_bytes(gzip.compress((json.dumps(collection([feature(i, random.Random(i)) for i in range(9)])) + end).encode()))
        assert read_features(spark, str(path)).count() == 9


@pytest.mark.parametrize("partitions", [1, 3])
def test_collections_are_documents_and_read_back(spark, tmp_path, small_ranges, partitions):
    rng = random.Random(5)
    features = [feature(i, rng) for i in range(25)]
    (tmp_path / "in").write_text(json.dumps(collection(features)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        table = read_features(spark, str(tmp_path / "in")).repartition(partitions)
        for name, options in {"lines": {}, "one": {"lineSep": " "}}.items():
            out = write_features(table, str(tmp_path / name), collections=True, **options)
            documents = [json.loads(part.read_text()) for part in (tmp_path / name).glob("part-*")]
            assert len(documents) == partitions and all(d["type"] == "FeatureCollection" for d in documents)
            assert sorted((f for d in documents for f in d["features"]), key=lambda f: f["id"]) == [
                {**f, "properties": f["properties"] or {}} for f in features
            ]
            assert read_features(spark, out).count() == read_features(spark, out, lines=name == "lines").count() == 25
        empty = write_features(table.where("id = 'x'"), str(tmp_path / "empty"), collections=True)
        assert read_features(spark, empty).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
