from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from statcube.operators import analysis as A
from statcube.operators import catalog as C
from statcube.operators import series as S
from statcube.plans.pipelines import series_by_coordinate

CUBE = "35-10-0003"


def observations(spark):
    rows = [
        (CUBE, f"1.{k}.0.0.0.0.0.0.0.0", f"v{k}", f"20{10 + y}", None if (k, y) == (1, 5) else float(k * 100 + y))
        for k in (1, 10, 12) for y in range(6)
    ]
    return spark.createDataFrame(rows, "cube_id string, COORDINATE string, VECTOR string, REF_DATE string, VALUE double")


def members(spark):
    rows = [(CUBE, 1, "Geography", "1", "Canada", None)] + [
        (CUBE, 2, "Kind", str(k), name, None) for k, name in ((1, "A"), (10, "B"), (12, "B"), (14, "C"))
    ]
    schema = "cube_id string, dim_id int, dim_name string, member_id string, member_name string, parent_id string"
    return spark.createDataFrame(rows, schema).withColumn("code", F.lit(None).cast("string"))


def years(df):
    return sorted((r.VECTOR, r.REF_DATE) for r in df.collect())


@pytest.mark.parametrize("limit", [1000, 0])
def test_latest_periods_with_data(spark, monkeypatch, limit):
    monkeypatch.setattr(S, "GROUP_LIMIT", limit)
    assert years(S.latest_n(observations(spark), 2)) == [
        ("v1", "2013"), ("v1", "2014"), ("v10", "2014"), ("v10", "2015"), ("v12", "2014"), ("v12", "2015"),
    ]
    assert S.latest_n(observations(spark)).count() == 18


def test_latest_n_is_cut_before_the_shuffle(spark):
    plan = S.latest_n(observations(spark), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_requests(spark):
    wanted = spark.createDataFrame(
        [("35100003", "1.1", 1), ("35-10-0003", "1.10.0", None), ("9810000301", "2", 3), ("35100003", "1.14", 2)],
        "cube_id string, COORDINATE string, periods int",
    )
    clean = {(r.cube_id, r.COORDINATE): (r.periods, r.is_census) for r in S.normalize_requests(wanted).collect()}
    assert clean[(CUBE, "1.1.0.0.0.0.0.0.0.0")] == (1, False)
    assert clean[(CUBE, "1.10.0.0.0.0.0.0.0.0")] == (None, False)
    assert clean[("98-10-0003", "2.0.0.0.0.0.0.0.0.0")] == (3, True)
    found, missing = series_by_coordinate(observations(spark), members(spark), wanted)
    got = {}
    for r in found.collect():
        got.setdefault(r.COORDINATE, []).append(r.REF_DATE)
    assert {k: len(v) for k, v in got.items()} == {"1.1": 1, "1.10": 6}
    assert got["1.1"] == ["2014"]
    implied = {r.COORDINATE: r.implied_value for r in missing.collect()}
    assert implied == {"1.14.0.0.0.0.0.0.0.0": None, "2.0.0.0.0.0.0.0.0.0": 0.0}


def test_requests_for_all_periods_need_no_window(spark):
    found, missing = series_by_coordinate(observations(spark), members(spark), {CUBE: ["1.1", "1.12"]})
    assert found.count() == 12 and missing.count() == 0
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


def test_names_are_attached_with_numbers_for_repeats(spark):
    found, _ = series_by_coordinate(observations(spark), members(spark), {CUBE: ["1.10", "1.12", "1.1"]}, 1)
    assert sorted((r.COORDINATE, r.GEO, r.Kind) for r in found.collect()) == [
        ("1.1", "Canada", "A"), ("1.10", "Canada", "B (1)"), ("1.12", "Canada", "B (2)"),
    ]


def test_large_lookups_give_the_same(spark, unbounded):
    test_names_are_attached_with_numbers_for_repeats(spark)
    test_template(spark)


def test_template(spark):
    t = S.cube_template(members(spark), CUBE)
    assert t.columns == ["cube_id", "COORDINATE", "Geography", "Kind"]
    assert sorted(r.COORDINATE for r in t.collect()) == ["1.1", "1.10", "1.12", "1.14"]
    few = S.cube_template(members(spark), CUBE, keep={"Kind": ["B"]})
    assert sorted(r.COORDINATE for r in few.collect()) == ["1.10", "1.12"]
    none = S.cube_template(members(spark), CUBE, keep={"Kind": ["Z"]})
    assert none.columns == t.columns and none.count() == 0


def test_series_are_attached_per_cube(spark):
    template = spark.createDataFrame([("a", "1.1"), ("b", "1.1"), ("a", "1.10")], "cube_id string, COORDINATE string")
    info = spark.createDataFrame(
        [("a", "1.1.0.0", "v1"), ("b", "1.1", "v2")], "cube_id string, COORDINATE string, VECTOR string"
    )
    got = {(r.cube_id, r.COORDINATE): r.VECTOR for r in S.attach_series(template, info).collect()}
    assert got == {("a", "1.1"): "v1", ("b", "1.1"): "v2", ("a", "1.10"): None}
    with pytest.raises(ValueError, match="is empty"):
        S.attach_series(template.limit(0), info)
    with pytest.raises(ValueError, match="COORDINATE"):
        S.attach_series(template.drop("COORDINATE"), info)


def test_ranges_of_mixed_period_shapes(spark):
    periods = ["2014", "2014/2015", "2015-03", "2015-03-09", "2016", "2015/2016"]
    df = spark.createDataFrame([(p,) for p in periods], "REF_DATE string")
    got = sorted(r[0] for r in S.series_range(df, "2015-01-01", "2015-12-31").collect())
    assert got == ["2014/2015", "2015-03", "2015-03-09"]
    assert S.series_range(df).count() == len(periods)


def test_batches(spark):
    requests = spark.createDataFrame([("a", f"{i:04d}") for i in range(700)] + [("b", "1")], "cube_id string, COORDINATE string")
    for size in (None, 0):
        sizes = S.batch_ids(requests, 300, size).groupBy("cube_id", "batch").count().collect()
        assert sorted(tuple(r) for r in sizes) == [("a", 1, 300), ("a", 2, 300), ("a", 3, 100), ("b", 1, 1)]


def test_changed_cubes_dates(spark):
    log = spark.createDataFrame([("a", datetime(2024, 1, d, 23, 59)) for d in range(1, 11)], "cube_id string, releaseTime timestamp")
    before_nine = datetime(2024, 1, 9, 13, 0, tzinfo=timezone.utc)
    after_nine = datetime(2024, 1, 9, 15, 0, tzinfo=timezone.utc)
    assert C.last_available_date(before_nine) == date(2024, 1, 8)
    assert C.last_available_date(after_nine) == date(2024, 1, 9)
    assert C.changed_cubes(log, date(2024, 1, 3), now=after_nine).count() == 1
    assert C.changed_cubes(log, date(2024, 1, 3), date(2024, 1, 20), before_nine).count() == 6
    assert C.changed_cubes(log, date(2024, 1, 5), date(2024, 1, 3), after_nine).count() == 3
    with pytest.raises(ValueError, match="2024-01-08"):
        C.changed_cubes(log, date(2024, 1, 9), now=before_nine)


def test_top_k_with_ties_and_missing_values(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 2.0), ("c", 2.0), ("d", 1.0), ("e", None)], "k string, v double")
    assert sorted(r.k for r in A.top_k_ties(df, 2, "v").collect()) == ["a", "b", "c"]
    assert A.top_k_ties(df, 10, "v").count() == 4


def test_sums_with_missing_values(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("b", None)], "k string, v double")
    sums = df.groupBy("k").agg(A.sum_na_zero(F.col("v")).alias("zero"), A.sum_complete(F.col("v")).alias("whole"))
    assert sorted(tuple(r) for r in sums.collect()) == [("a", 0.0, None), ("b", 1.0, None)]
    assert A.annualize_complete(df, ["k"], "v", 2).count() == 0


def test_legacy_ids(spark):
    table = spark.createDataFrame([(260018, 34100013)], "legacy_id int, product_id int")
    df = spark.createDataFrame([("026-0018",), ("999-0001",)], "id string")
    matched, unmatched = C.map_legacy_ids(df, table, "id")
    assert [tuple(r) for r in matched.collect()] == [("026-0018", "34-10-0013")]
    assert [r.id for r in unmatched.collect()] == ["999-0001"]
