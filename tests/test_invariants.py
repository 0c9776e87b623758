"""Properties that must hold whatever path a cube takes."""

from pyspark.sql import functions as F

from conftest import SMALL
from cube_queries.cubes import ORDERS_CUBE, orders_facts, orders_members
from cube_queries.landing import land_csv
from cube_queries.members import orders_meta
from cube_queries.series import observations
from statcube.functions import expressions as X
from statcube.functions.names import rename_language
from statcube.operators.analysis import diff_tables, missing_cells
from statcube.operators.enrich import describe_cube, fold_in_metadata, order_categories
from statcube.operators.members import categories_for_level
from statcube.operators.reshape import cube_pivot, wide_to_long
from statcube.plans.pipelines import normalize_cube, series_by_vector
from statcube.sources.delimited import read_cube_csv
from statcube.sources.scratch import scratch_path
from statcube.sources.store import _laid_out, add_geo_uid, store_cube

KEY = ["COORDINATE", "REF_DATE"]


def differences(left, right):
    return sum(diff_tables(left, right, KEY).first())


def test_every_path_gives_the_same_cube(spark):
    meta = orders_meta(spark, SMALL)
    raw = add_geo_uid(orders_facts(spark, SMALL))
    memory = normalize_cube(raw, meta)
    text = normalize_cube(add_geo_uid(wide_to_long(read_cube_csv(spark, land_csv(orders_facts(spark, SMALL))))), meta)
    assert text.columns == memory.columns and text.count() == memory.count()
    assert differences(text, memory) == 0
    for partitioning in ([], ["GEO"], ["GeoUID", "Statistic"]):
        stored = store_cube(orders_facts(spark, SMALL), scratch_path(spark, "store"), ORDERS_CUBE, partition_by=partitioning)
        got = normalize_cube(stored, meta)
        assert got.columns == memory.columns and got.count() == memory.count()
        assert differences(got, memory) == 0
        assert sum(missing_cells(got, ["GEO", "Priority", "Statistic", "Date"]).first()) == 0


def test_filters_after_normalization_reach_the_scan(spark):
    stored = store_cube(orders_facts(spark, SMALL), scratch_path(spark, "store"), ORDERS_CUBE, partition_by=["GEO"])
    cube = normalize_cube(stored, orders_meta(spark, SMALL), categories=False)
    plan = cube.filter("GEO = 'NATION_3' AND Statistic = 'Value'").select("val_norm", "Hierarchy for GEO")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(GEO" in text
    assert "EqualTo(Statistic,Value)" in text
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_languages_agree(spark):
    english = normalize_cube(orders_facts(spark, SMALL))
    units = F.replace("UOM", F.lit("Percent"), F.lit("Pourcent"))
    translated = orders_facts(spark, SMALL).withColumn("UOM", units)
    french = normalize_cube(rename_language(translated, "eng", "fra"))
    assert differences(rename_language(french, "fra", "eng").drop("UOM"), english) == 0
    assert len(french.columns) == len(english.columns) and french.count() == english.count()


def test_vectors_agree_with_the_table(spark):
    meta = orders_meta(spark, SMALL)
    table = normalize_cube(orders_facts(spark, SMALL), meta).filter(F.col("VECTOR").isin("v1007012", "v1008052"))
    series = series_by_vector(observations(spark, SMALL), orders_members(spark, SMALL), ["1007012", "v1008052"])
    assert series.count() == table.count() > 0
    common = [c for c in series.columns if c in table.columns and c != "SCALAR_ID"]
    assert differences(series.select(*common), table.select(*common)) == 0


def test_normalization_can_be_repeated(spark):
    meta = orders_meta(spark, SMALL)
    once = normalize_cube(orders_facts(spark, SMALL), meta, categories=False)
    twice = normalize_cube(once, meta, categories=False)
    assert once.columns == twice.columns and differences(once, twice) == 0


def test_replaced_values_drop_the_scale(spark):
    cube = normalize_cube(orders_facts(spark, SMALL), replacement=None)
    assert not {"SCALAR_ID", "SCALAR_FACTOR", "val_norm"} & set(cube.columns)
    assert "Date" in cube.columns


def test_cubes_without_scale_get_no_date(spark):
    cube = normalize_cube(orders_facts(spark, SMALL).drop("SCALAR_ID", "UOM"))
    assert not {"Date", "val_norm"} & set(cube.columns)


def test_large_member_sets_give_the_same_facts(spark, unbounded):
    facts = orders_facts(spark, SMALL)
    large = describe_cube(orders_members(spark, SMALL), ORDERS_CUBE, broadcast_rows=-1)
    assert not large.bounded
    folded = fold_in_metadata(facts, large)
    path = F.col("`Hierarchy for Priority`") == X.coordinate_part(F.col("COORDINATE"), 2)
    assert folded.count() == facts.count() and folded.filter(~F.coalesce(path, F.lit(False))).isEmpty()
    ordered = order_categories(facts.withColumn("Priority", X.strip_code(F.col("Priority"))), large)
    assert ordered.filter("Priority IS NULL OR GEO__ord IS NULL").isEmpty()


def test_awkward_dimension_names(spark):
    """Names with dots, brackets, commas and quotes go through every step."""
    odd = "Age. group [x], 'y' = z"
    schema = "cube_id string, dim_id int, dim_name string, member_id string, member_name string, parent_id string, code string"
    members = spark.createDataFrame(
        [("20-10-0001", 1, odd, "1", "All", None, None), ("20-10-0001", 1, odd, "2", "Old", "1", "[b]"),
         ("20-10-0001", 1, odd, "3", "All", "1", None)], schema,
    )
    facts = spark.createDataFrame(
        [("2020", "All", "1", "5", "0"), ("2020", "Old [b]", "2", "2", "3"), ("2020", "All", "3", "1", "0")],
        f"REF_DATE string, `{odd}` string, COORDINATE string, VALUE string, SCALAR_ID string",
    )
    stored = store_cube(facts, scratch_path(spark, "store"), "20-10-0001", partition_by=[odd], cluster_by=["COORDINATE"])
    for limit in (None, -1):
        meta = describe_cube(members, "20-10-0001", broadcast_rows=limit)
        cube = normalize_cube(stored, meta).orderBy("COORDINATE").collect()
        assert [(r[odd], r[f"{odd}__ord"], r.val_norm) for r in cube] == [
            ("All [1]", 1, 5.0), ("Old", 2, 2000.0), ("All ==> All", 3, 1.0),
        ]
        assert [r[f"Hierarchy for {odd}"] for r in cube] == ["1", "1.2", "1.3"]
    wide = cube_pivot(stored.filter("COORDINATE <> '3'").select("REF_DATE", f"`{odd}`", "VALUE"), odd, "VALUE", ["All", "Old [b]"])
    assert wide.first().asDict() == {"REF_DATE": "2020", "All": 5.0, "Old [b]": 2.0}
    assert categories_for_level(normalize_cube(stored, meta), odd, 1).count() == 2


def test_partitioned_writes_are_rebalanced(spark):
    laid_out = _laid_out(orders_facts(spark, SMALL), ["GEO"], ["COORDINATE"])
    assert "REBALANCE" in laid_out._jdf.queryExecution().executedPlan().toString()
