from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from statcube.sources import store as St
from statcube.streaming.landing import import_landed


def facts(spark):
    return spark.createDataFrame(
        [("2020", "A", "2016A000201", "1.1", "1.5"), ("2020", "B", "2016A000202", "2.1", "F"),
         ("2021", "A", "2016A000201", "1.1", "2")],
        "REF_DATE string, GEO string, DGUID string, COORDINATE string, VALUE string",
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_store_and_open_keep_types_and_partition_text(spark, tmp_path):
    root = str(tmp_path)
    stored = St.store_cube(facts(spark), root, "20-10-0001", partition_by=["GeoUID"], cluster_by=["COORDINATE"])
    assert dict(stored.dtypes)["GeoUID"] == "string" and dict(stored.dtypes)["VALUE"] == "double"
    assert rows(stored.select("GeoUID", "REF_DATE", "VALUE")) == [
        ("01", "2020", 1.5), ("01", "2021", 2.0), ("02", "2020", None),
    ]
    plan = St.open_cube(spark, root, "20-10-0001").filter("GeoUID = '01' AND REF_DATE = '2020'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(GeoUID" in text and "EqualTo(REF_DATE,2020)" in text


def test_store_checks_its_input(spark, tmp_path):
    with pytest.raises(ValueError, match="lacks columns"):
        St.store_cube(facts(spark), str(tmp_path), "20-10-0001", partition_by=["Sex"])
    twice = facts(spark).withColumn("x", F.lit(1)).toDF("REF_DATE", "GEO", "DGUID", "COORDINATE", "VALUE", "geo")
    with pytest.raises(ValueError, match="Duplicated column names"):
        St.store_cube(twice, str(tmp_path), "20-10-0001")
    with pytest.raises(ValueError, match="not in the store"):
        St.open_cube(spark, str(tmp_path), "20-10-0009")


def test_repartition(spark, tmp_path):
    root = str(tmp_path)
    before = rows(St.store_cube(facts(spark), root, "20-10-0001", partition_by=["GEO", "REF_DATE"], title="T"))
    assert not St.repartition_cube(spark, root, "20-10-0001", ["REF_DATE", "GEO"])
    assert St.repartition_cube(spark, root, "20-10-0001", ["REF_DATE"])
    after = St.open_cube(spark, root, "20-10-0001")
    assert rows(after) == before
    entry = St.registry_entries(spark, root).first()
    assert entry.partitioning == ["REF_DATE"] and entry.title == "T"
    assert len(list((tmp_path / "data").iterdir())) == 2
    assert St.release_versions(spark, root) == 1 and St.release_versions(spark, root) == 0
    assert len(list((tmp_path / "data").iterdir())) == 1 and rows(St.open_cube(spark, root, "20-10-0001")) == before


def test_registry_freshness_and_drop(spark, tmp_path):
    root = str(tmp_path)
    assert St.cube_registry(spark, root).count() == 0
    for cube in ("20-10-0001", "20-10-0002"):
        St.store_cube(facts(spark), root, cube, title=cube)
    St.store_cube(facts(spark), root, "20-10-0001", "fra", typed=False)
    catalog = spark.createDataFrame(
        [("20-10-0001", datetime(2020, 1, 1)), ("20-10-0002", datetime(2999, 1, 1))],
        "cube_id string, releaseTime timestamp",
    )
    listed = {(r.cube_id, r.language): r for r in St.cube_registry(spark, root, catalog).collect()}
    assert listed[("20-10-0001", "eng")].up_to_date and not listed[("20-10-0002", "eng")].up_to_date
    assert all(r.bytes > 0 and r.size for r in listed.values())
    stale = St.stale_cubes(
        St.registry_entries(spark, root), catalog.withColumnRenamed("releaseTime", "last_release")
    )
    assert [r.cube_id for r in stale.collect()] == ["20-10-0002"]
    chosen = St.registry_entries(spark, root).filter("language = 'fra'")
    assert St.drop_cubes(spark, root, chosen) == 1
    assert St.drop_cubes(spark, root, ["20-10-0002", "20-10-0077"], ["english"]) == 1
    assert [(r.cube_id, r.language) for r in St.registry_entries(spark, root).collect()] == [("20-10-0001", "eng")]


def test_append(spark, tmp_path):
    root = str(tmp_path)
    St.store_cube(facts(spark).filter("REF_DATE = '2020'"), root, "20-10-0001", partition_by=["GEO"])
    St.append_to_cube(facts(spark).filter("REF_DATE = '2021'"), root, "20-10-0001")
    whole = St.store_cube(facts(spark), root, "20-10-0002", partition_by=["GEO"])
    assert rows(St.open_cube(spark, root, "20-10-0001")) == rows(whole)


def test_refresh_policy(spark, tmp_path):
    root, loads = str(tmp_path), []

    def load():
        loads.append(1)
        return facts(spark)

    def opened(**options):
        return St.open_current(spark, root, "20-10-0001", load, partition_by=["GEO"], **options).count()

    assert opened() == 3 and opened() == 3 and len(loads) == 1
    assert opened(refresh="auto", released=datetime(2020, 1, 1)) == 3 and len(loads) == 1
    with pytest.warns(UserWarning, match="out of date"):
        assert opened(released=datetime(2999, 1, 1)) == 3
    assert len(loads) == 1
    assert opened(refresh="auto", released=datetime(2999, 1, 1)) == 3 and len(loads) == 2
    assert opened(refresh=True) == 3 and len(loads) == 3
    assert len(list((tmp_path / "data").iterdir())) == 1


def test_only_datasets_of_the_store_can_be_removed(spark, tmp_path):
    with pytest.raises(ValueError, match="outside the store"):
        St._remove_folder(spark, str(tmp_path / "store"), str(tmp_path / "elsewhere" / "cube_part=0"))


def test_landed_files_are_imported_once(spark, tmp_path):
    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")
    facts(spark).repartition(3).write.option("header", True).csv(landing)
    cube = import_landed(
        spark, landing, facts(spark).columns, str(tmp_path / "store"), "20-10-0001",
        transform=lambda df: df.withColumn("year", F.col("REF_DATE").cast("int")),
        partition_by=["GEO"], files_per_step=1, progress=progress,
    )
    assert cube.count() == 3 and dict(cube.dtypes)["year"] == "int"
    assert dict(cube.dtypes)["VALUE"] == "double" and "GeoUID" in cube.columns


def test_imports_go_on_and_take_appends(spark, tmp_path):
    """A repeated import, an append and a failed step keep every row once."""
    landing, progress, root = str(tmp_path / "landing"), str(tmp_path / "progress"), str(tmp_path / "store")

    def land():
        facts(spark).repartition(2).write.mode("append").option("header", True).csv(landing)

    def run(transform=None):
        return import_landed(
            spark, landing, facts(spark).columns, root, "20-10-0001", transform=transform,
            partition_by=["GEO"], files_per_step=1, progress=progress,
        )

    land()
    assert run().count() == 3 and run().count() == 3
    St.append_to_cube(facts(spark), root, "20-10-0001")
    assert St.open_cube(spark, root, "20-10-0001").count() == 6
    land()
    broken = lambda df: df.withColumn("VALUE", F.when(F.col("VALUE").isNotNull(), F.raise_error(F.lit("stop")).cast("double")))
    with pytest.raises(Exception, match="stop"):
        run(broken)
    assert St.open_cube(spark, root, "20-10-0001").count() >= 6
    assert run().count() == 9
    sizes = St.cube_registry(spark, root).collect()
    assert len(sizes) == 1 and sizes[0].bytes > 0


def test_appends_at_once_are_all_there(spark, tmp_path):
    root = str(tmp_path)
    St.store_cube(facts(spark), root, "20-10-0001", partition_by=["GEO"])
    with ThreadPoolExecutor(5) as pool:
        list(pool.map(lambda _: St.append_to_cube(facts(spark), root, "20-10-0001"), range(5)))
    assert St.open_cube(spark, root, "20-10-0001").count() == 18
    entry = St.registry_entries(spark, root).first()
    assert entry.n_parts == 6
    files = [f for f in (tmp_path / "data").rglob("*.parquet")]
    assert entry.bytes == sum(f.stat().st_size for f in files)


def test_cost_of_an_append_does_not_grow(spark, tmp_path):
    """An append reads what opened the layout, not the log of earlier appends."""
    root = str(tmp_path)
    St.store_cube(facts(spark), root, "20-10-0001")
    read = []
    for _ in range(3):
        St.append_to_cube(facts(spark), root, "20-10-0001")
        read.append(len(St._log_of(spark, root, "20-10-0001", "eng", appends=False).inputFiles()))
    assert read == [1, 1, 1]
    assert len(St._log_of(spark, root, "20-10-0001", "eng").inputFiles()) == 4


def test_two_replacements_at_once_conflict(spark, tmp_path):
    root = str(tmp_path)
    St.store_cube(facts(spark), root, "20-10-0001")
    with St._replacing(spark, root, "20-10-0001", "eng"):
        for replace in (lambda: St.store_cube(facts(spark), root, "20-10-0001"), lambda: St.refresh_cube(facts(spark), root, "20-10-0001"), lambda: St.repartition_cube(spark, root, "20-10-0001", ["GEO"])):
            with pytest.raises(St.StoreConflict):
                replace()
        St.store_cube(facts(spark), root, "20-10-0002")
        assert St.append_to_cube(facts(spark), root, "20-10-0001").count() == 6
    assert St.repartition_cube(spark, root, "20-10-0001", ["GEO"])
    assert St.open_cube(spark, root, "20-10-0001").count() == 6


def test_refresh_writes_what_differs(spark, tmp_path):
    root = str(tmp_path)
    before = St.store_cube(facts(spark), root, "20-10-0001", partition_by=["GEO"])
    first = rows(before)
    assert St.refresh_cube(facts(spark).orderBy(F.rand(1)), root, "20-10-0001") == []
    odd = spark.createDataFrame([("2022", None, None, "9.9", None), ("2022", "é [*]/x", None, "9.8", "4")], facts(spark).schema)
    for new in (facts(spark).filter("GEO = 'A'").unionByName(odd), odd, facts(spark).limit(0), facts(spark)):
        assert St.refresh_cube(new, root, "20-10-0001")
        want = St.typed_for_store(new).select(*before.columns)
        assert rows(St.open_cube(spark, root, "20-10-0001")) == rows(want)
    steps = St.cube_versions(spark, root, "20-10-0001").orderBy("time_cached").collect()
    assert [(s.pieces_added, s.pieces_removed) for s in steps] == [(2, 0), (2, 1), (0, 1), (0, 2), (2, 0)]
    # The first version is whole until it is released.
    assert rows(St.open_cube(spark, root, "20-10-0001", as_of=steps[0].time_cached)) == first
    assert St.release_versions(spark, root) == 4
    assert rows(St.open_cube(spark, root, "20-10-0001")) == first


def test_drops_are_read_until_released(spark, tmp_path):
    root = str(tmp_path)
    cube = St.store_cube(facts(spark), root, "20-10-0001")
    kept = St.store_cube(facts(spark), root, "20-10/0*2")
    assert St.drop_cubes(spark, root, ["20-10-0001"]) == 1 and St.drop_cubes(spark, root, ["20-10-0001"]) == 0
    with pytest.raises(ValueError, match="not in the store"):
        St.open_cube(spark, root, "20-10-0001")
    assert cube.count() == 3 and kept.count() == 3
    assert St.release_versions(spark, root, before=datetime(2000, 1, 1)) == 0
    assert St.release_versions(spark, root) == 1
    assert [r.cube_id for r in St.registry_entries(spark, root).collect()] == ["20-10/0*2"]
    assert St.store_cube(facts(spark), root, "20-10-0001").count() == 3
    assert St.open_cube(spark, root, "20-10-0001").count() == 3
