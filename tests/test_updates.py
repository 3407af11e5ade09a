"""Metrics that notice new files, against statistics of all deals."""

import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from areaprice.operators import stats
from areaprice.operators.clean import clean_prices
from areaprice.operators.stats import area_stats
from areaprice.sources import updates
from areaprice.sources.tables import read_deals

HEADER = "quarter_cad_number;street;wall_material_code;year_build;floor;area;period_start_date;deal_price;price_per_sqm\n"


def write(folder, name, seed, n=60):
    rng = random.Random(seed)
    prices = ["n/a", "-5", "100", "100.5", "1e3"]
    lines = [f"78:10:{rng.randint(0, 4)};s;w;1960;1;40;01.07.2025;1;{rng.choice(prices + [str(rng.randint(90, 110))])}" for _ in range(n)]
    (folder / name).write_text(HEADER + "\n".join(lines) + "\n")


def everything(spark, folder):
    return area_stats(clean_prices(read_deals(spark, str(folder))))


def same(found, expected):
    a, b = ({r["quarter_cad_number"]: r for r in df.collect()} for df in (found, expected))
    assert a.keys() == b.keys() and found.columns == expected.columns
    for key, row in a.items():
        assert (row["median"], row["count"]) == (b[key]["median"], b[key]["count"])
        assert (row["arith_mean"], row["geom_mean"]) == pytest.approx((b[key]["arith_mean"], b[key]["geom_mean"]))


@pytest.fixture
def reads(monkeypatch):
    """Names of the files that each update has read."""
    seen = []
    plain = updates._clean_deals

    def spy(spark, files):
        seen.append([os.path.basename(file) for file in files])
        return plain(spark, files)

    spy.seen = seen
    return spy


def test_only_new_files_are_counted(spark, tmp_path, reads, monkeypatch):
    monkeypatch.setattr(updates, "MERGE_AT", 2)
    folder, store = tmp_path / "deals", str(tmp_path / "store")
    folder.mkdir()
    for turn, names in enumerate([["a.csv"], ["b.csv", "c.csv"], [], ["d.csv"], ["e.csv"]]):
        for name in names:
            write(folder, name, f"{turn}{name}")
        same(updates.updated_metrics(spark, str(folder), store, reads), everything(spark, folder))
        if names:
            assert reads.seen[-1] == names
    assert len(reads.seen) == 4


def test_changed_and_removed_files_are_counted_anew(spark, tmp_path, reads):
    folder, store = tmp_path / "deals", str(tmp_path / "store")
    folder.mkdir()
    for name in ("a.csv", "b.csv"):
        write(folder, name, name)
    updates.update_counts(spark, str(folder), store, reads)
    write(folder, "a.csv", "other", 70)
    same(updates.updated_metrics(spark, str(folder), store, reads), everything(spark, folder))
    assert reads.seen[-1] == ["a.csv", "b.csv"]
    write(folder, "c.csv", "c")
    (folder / "b.csv").unlink()
    same(updates.updated_metrics(spark, str(folder), store, reads), everything(spark, folder))
    assert reads.seen[-1] == ["a.csv", "c.csv"]
    (folder / "c.csv").unlink()
    (folder / "a.csv").unlink()
    (folder / "d.csv").write_text(HEADER)
    assert updates.updated_metrics(spark, str(folder), store, reads).count() == 0


def test_a_failed_update_counts_for_nothing(spark, tmp_path, reads, monkeypatch):
    folder, store = tmp_path / "deals", str(tmp_path / "store")
    folder.mkdir()
    write(folder, "a.csv", "a")
    updates.update_counts(spark, str(folder), store, reads)
    write(folder, "b.csv", "b")

    def broken(spark, files):
        broken_at = F.when(F.col("price_per_sqm") > 0, F.raise_error(F.lit("lost"))).otherwise(1.0)
        return updates._clean_deals(spark, files).withColumn("price_per_sqm", broken_at.cast("double"))

    with pytest.raises(Exception, match="lost"):
        updates.update_counts(spark, str(folder), store, broken)
    same(updates.updated_metrics(spark, str(folder), store, reads), everything(spark, folder))
    assert reads.seen == [["a.csv"], ["b.csv"]]
    with pytest.raises(FileNotFoundError):
        updates.update_counts(spark, str(tmp_path / "nope"), store)


def test_statistics_of_counted_prices(spark, monkeypatch):
    monkeypatch.setattr(stats, "LINEAR_CELLS", 2)
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, float("nan"), 0.0, -3.0, rng.uniform(1, 1.01), rng.uniform(1, 9)]), rng.randint(1, 5)) for _ in range(300)]
    counted = spark.createDataFrame(rows, "k string, v double, n int").repartition(3)
    found = {r["k"]: r for r in area_stats(counted, "k", "v", times="n").collect()}
    for key in ("a", "b", None):
        values = [v for k, v, n in rows if k == key and v is not None and v == v for _ in range(n)]
        assert found[key]["count"] == len(values) and found[key]["median"] == pytest.approx(statistics.median(values), rel=1e-15)
        assert found[key]["arith_mean"] == pytest.approx(statistics.mean(values))
        assert found[key]["geom_mean"] == pytest.approx(statistics.geometric_mean([v for v in values if v > 0]))
    for wanted in (["count"], ["arith_mean"], ["geom_mean", "count"]):
        assert area_stats(counted, "k", "v", wanted, times="n").columns == ["k", *wanted]
    with pytest.raises(ValueError, match="exact"):
        area_stats(counted, "k", "v", method="approx", times="n")
