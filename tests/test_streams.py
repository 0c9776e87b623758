from datetime import datetime

import pytest
from pyspark.sql import functions as F

from statcube.sources import store as St
from statcube.streaming.landing import import_landed
from statcube.streaming.releases import import_releases, notices

CUBE = "10-10-0001"


def land(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(["COORDINATE,GEO,VALUE", *lines, ""]))


def test_good_and_bad_records_are_registered_together_or_not_at_all(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "store")

    def run(transform=None):
        return import_landed(
            spark, str(landing), ["COORDINATE", "GEO", "VALUE"], root, CUBE, partition_by=["GEO"], progress=str(tmp_path / "log"), quarantine=True, transform=transform
        )

    land(landing, "a.csv", "1.1,A,5", "short", "1.2,B,6,long", "1.3,A,F")
    broken = lambda df: df.withColumn("VALUE", F.raise_error(F.lit("stop")).cast("double"))
    with pytest.raises(Exception, match="stop"):
        run(broken)
    assert St.registry_entries(spark, root).count() == 0
    assert sorted(r.COORDINATE for r in run().collect()) == ["1.1", "1.3"]
    bad = St.open_quarantine(spark, root, CUBE)
    assert sorted(map(tuple, bad.collect())) == [("1.2,B,6,long", "a.csv"), ("short", "a.csv")]
    land(landing, "b.csv", "1.4,B,7")
    assert run().count() == 3 and run().count() == 3
    assert St.open_quarantine(spark, root, CUBE).count() == 2
    log = St._log(spark, St._registry_path(root)).filter("action IN ('stored', 'appended')")
    per_commit = log.groupBy("commit").agg(F.countDistinct("cube_id").alias("cubes")).collect()
    assert len(per_commit) == 2 and {r.cubes for r in per_commit} == {2}


def test_releases_are_imported_once(spark, tmp_path):
    root, landing = str(tmp_path / "store"), tmp_path / "landing"
    landing.mkdir()
    asked = []

    def read(place):
        asked.append(place)
        return spark.createDataFrame([(place, "1")], "REF_DATE string, VALUE string")

    def run(name, *told):
        (landing / name).write_text("\n".join(f'{{"cube_id": "{c}", "released": "{t}", "path": "{p}"}}' for c, t, p in told))
        import_releases(notices(spark, str(landing), 1), read, root, str(tmp_path / "log"))

    run("1.json", ("a", "2020-01-02T00:00:00", "x"), ("a", "2020-01-02T00:00:00", "y"), ("b", "2020-01-02T00:00:00", "z"))
    run("2.json", ("a", "2020-01-02T00:00:00", "again"), ("a", "1990-01-01T00:00:00", "late"))
    assert sorted(asked) == ["late", "x", "z"]
    assert sorted(r.REF_DATE for r in St.open_cube(spark, root, "a").collect()) == ["late", "x"]
    # A release that was imported does not come back when its cube was dropped.
    St.drop_cubes(spark, root, ["b"])
    run("3.json", ("b", "2020-01-02T00:00:00", "z"), ("b", "2021-01-02T00:00:00", "new"))
    assert [r.REF_DATE for r in St.open_cube(spark, root, "b").collect()] == ["new"]
    assert St.registry_entries(spark, root).filter(F.col("time_cached") > F.lit(datetime(2020, 1, 1))).count() == 2
