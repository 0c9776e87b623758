import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from statcube.operators import analysis, joins
from statcube.operators.enrich import attach_member_names
from statcube.operators.joins import lookup_join, number_rows
from statcube.sources.scratch import materialize_measured


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def hot_frame(spark):
    """Two thirds of the rows share one key, some have none."""
    k = F.when(F.col("id") % 3 < 2, F.lit("hot")).when(F.col("id") % 100 == 2, None).otherwise(F.col("id").cast("string"))
    return spark.range(3000).select(k.alias("k"), "id")


def test_lookup_equals_plain_join(spark):
    left = hot_frame(spark)
    right = left.select("k").distinct().filter("k IS NOT NULL").withColumn("v", F.length("k"))
    right = right.filter("k <> '5'")
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain = left.join(right, ["k"], how)
        assert rows(lookup_join(left, right, ["k"], how, bounded=False)) == rows(plain)
        assert rows(lookup_join(left, right, ["k"], how)) == rows(plain)


def test_a_hot_key_of_a_large_lookup_is_split(spark):
    left = spark.range(200_000).select(F.when(F.col("id") % 3 < 2, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.sha1(F.col("id").cast("string")).alias("t"))
    # Written, so that the join's own shuffle is the only one below it.
    right, size = materialize_measured(left.select("k").distinct().withColumn("v", F.col("k") + 1), "right")
    assert size.rows > 60_000
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = lookup_join(left, right, ["k"], "left", bounded=False)
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_row_numbers_over_ranges_equal_a_window(spark):
    df = hot_frame(spark)
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("id"))))
    split = number_rows(df, ["k"], [F.desc("id")], "n", group_rows=0)
    assert rows(split) == rows(plain)
    assert rows(number_rows(df, ["k"], [F.desc("id")], "n")) == rows(plain)


def test_lookups_are_measured_by_rows_and_bytes(spark):
    texts = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    _, size = materialize_measured(texts, "texts")
    assert size.rows == 10 and size.bytes == 10 * 1008
    assert joins.fits_broadcast(size) and not joins.fits_broadcast(size, 9)


def test_wide_lookups_are_not_broadcast(spark, monkeypatch):
    left = hot_frame(spark)
    right = left.select("k").distinct().withColumn("text", F.lit("some text"))
    plain = rows(left.join(right, ["k"], "left"))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10)
    plan = lookup_join(left, right, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert rows(lookup_join(left, right, ["k"])) == plain


def test_scratch_is_empty_after_release(spark, tmp_path, monkeypatch):
    import statcube.sources.scratch as scratch

    monkeypatch.setattr(scratch, "_own_folder", lambda session: str(tmp_path / "app"))
    assert scratch.materialize(spark.range(5), "five").count() == 5
    assert list(tmp_path.rglob("*.parquet"))
    scratch.release_scratch(spark)
    assert not list(tmp_path.rglob("*.parquet"))


@pytest.mark.parametrize("many", [False, True])
def test_names_of_any_number_of_cubes_take_a_join_per_position(spark, many, request):
    if many:
        request.getfixturevalue("unbounded")
    cubes = spark.range(60).selectExpr("concat('c', id) AS cube_id", "id")
    members = cubes.selectExpr("cube_id", "explode(array(1, 2, 3)) AS dim_id", "id").selectExpr(
        "cube_id", "dim_id", "concat('Dim ', id + dim_id) AS dim_name", "'7' AS member_id", "concat(cube_id, '-', dim_id) AS member_name", "CAST(NULL AS string) AS parent_id"
    )
    twice = spark.createDataFrame([("c0", 4, "Dim 1", "7", "second", None)], members.schema)
    rows = cubes.selectExpr("cube_id", "'7.7.7.7' AS COORDINATE").unionByName(spark.createDataFrame([("c1", "7.8")], "cube_id string, COORDINATE string"))
    named = attach_member_names(rows, members.unionByName(twice))
    plan = named._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= (5 if many else 4)
    found = {(r.cube_id, r.COORDINATE): {k: v for k, v in r.asDict().items() if v is not None and k.startswith("Dim")} for r in named.collect()}
    assert len(named.columns) == 2 + 62
    assert found[("c5", "7.7.7.7")] == {"Dim 6": "c5-1", "Dim 7": "c5-2", "Dim 8": "c5-3"}
    assert found[("c1", "7.8")] == {"Dim 2": "c1-1"} and found[("c0", "7.7.7.7")]["Dim 1"] == "c0-1"


def test_differences_join_only_what_differs(spark):
    left = spark.range(2000).selectExpr("if(id % 500 = 0, NULL, id) AS k", "id AS n", "CAST(id AS double) AS v", "CAST(id AS string) AS w")
    right = left.withColumn("v", F.when(F.col("n") == 77, -1.0).otherwise(F.col("v"))).filter("n <> 1500")
    a, b = (analysis._digested(df, ["k", "n"], ["v", "w"], 512) for df in (left, right))
    assert analysis.changed_buckets(a, b.orderBy(F.rand(3))).count() in (1, 2)
    assert analysis.changed_buckets(a, a).isEmpty()
    for buckets in (1, 512):
        assert tuple(analysis.diff_tables(left, right, ["k", "n"], buckets).first()) == (1, 0, 1, 0)
    assert tuple(analysis.diff_tables(left.limit(0), left.limit(0), ["k", "n"]).first()) == (0, 0, 0, 0)
