from datetime import date

import pytest
from pyspark.sql import functions as F

from statcube.functions import expressions as X
from statcube.functions import names as N


def one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_reference_dates(spark):
    shapes = ["2015", "2014/2015", "2015-03", "2015-03-09", "Q1 2015", None, "2015-13", "2015-02-30"]
    assert one(spark, shapes, X.reference_date) == [
        date(2015, 7, 1), date(2015, 7, 1), date(2015, 3, 1), date(2015, 3, 9), None, None, None, None,
    ]
    assert one(spark, ["2015", "2015-03"], lambda c: X.reference_date(c, "01", "15")) == [
        date(2015, 1, 15), date(2015, 3, 15),
    ]


def test_coordinates(spark):
    values = ["1.12", "1.10.0.0.0.0.0.0.0.0", "1.2.3.4.5.6.7.8.9.10", "20"]
    assert one(spark, values, X.pad_coordinate) == [
        "1.12.0.0.0.0.0.0.0.0", "1.10.0.0.0.0.0.0.0.0", "1.2.3.4.5.6.7.8.9.10", "20.0.0.0.0.0.0.0.0.0",
    ]
    assert one(spark, values, X.strip_coordinate) == ["1.12", "1.10", "1.2.3.4.5.6.7.8.9.10", "20"]
    assert one(spark, values, lambda c: X.coordinate_part(c, 2)) == ["12", "10", "2", None]


def test_values_and_tokens(spark):
    raw = ["1.5", "F", "..", "", "-3", "NA", "<NA>", None]
    assert one(spark, raw, X.to_number) == [1.5, None, None, None, -3.0, None, None, None]
    assert one(spark, raw, X.null_if_missing) == ["1.5", None, "..", None, "-3", None, None, None]
    assert one(spark, ["0", "3", "6", None, "x"], lambda c: X.scaled(F.lit(2.5), c)) == [
        2.5, 2500.0, 2500000.0, None, None,
    ]


def test_percent_rule(spark):
    units = ["Percent", "Percentage change", "Dollars", None, "Pourcent"]
    assert one(spark, units, lambda c: X.percent_to_rate(F.lit(50.0), c)) == [0.5, 0.5, 50.0, 50.0, 50.0]
    assert one(spark, units, lambda c: X.percent_to_rate(F.lit(50.0), c, "fra"))[4] == 0.5


def test_codes_paths_and_labels(spark):
    assert one(spark, ["Construction [23]", "A [b] c", "A [b] [1]", "Plain"], X.strip_code) == [
        "Construction", "A [b] c", "A", "Plain",
    ]
    assert one(spark, ["1", "1.2.3", None], X.path_depth) == [0, 2, 0]
    assert one(spark, ["1.2.30"], X.path_leaf) == ["30"]
    assert one(spark, ["1.2", "1.25", "1.2.7", "11.2"], lambda c: X.is_under(c, "1.2")) == [
        True, False, True, False,
    ]
    assert one(spark, ["2016A000259"], X.geo_uid_from_dguid) == ["59"]
    assert one(spark, ["T1", "23", None], lambda c: X.not_matching(c, r"T\d+")) == [False, True, True]
    assert one(spark, ["Toronto, Ontario", "Ontario"], X.place_name) == ["Toronto", "Ontario"]


def test_ids(spark):
    ids = ["14-10-0293", "14100293", "1410029301", "1410029302", "98-10-0036-01"]
    assert one(spark, ids, X.clean_cube_id) == ["14-10-0293"] * 4 + ["98-10-0036"]
    assert one(spark, ids, X.is_derived_id) == [False, False, False, True, False]
    assert one(spark, ids, X.is_census_cube) == [False, False, False, False, True]
    assert one(spark, ["026-0018"], X.is_legacy_id) == [True]
    assert one(spark, [0, 12], X.vector_name, "bigint") == [None, "v12"]
    assert one(spark, [2, 9], X.response_text, "int") == ["Invalid cube and series combination", None]


def test_series_labels(spark):
    label = lambda c: X.series_label(c, {"first": "v1", "second": 2})
    assert one(spark, ["v1", "v2", "v3"], label) == ["first", "second", "v3"]


def test_release_time_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seconds = one(spark, ["2025-03-01T08:30"], lambda c: F.unix_seconds(X.release_instant(c)))
            assert seconds == [1740835800]
            wall = one(spark, ["2025-03-01T08:30"], lambda c: X.publisher_time(X.release_instant(c)).cast("string"))
            assert wall == ["2025-03-01 08:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_readable_size(spark):
    sizes = [0, 1023, 1024, 1536, 1048576, 1234567890, None]
    assert one(spark, sizes, X.readable_size, "bigint") == [
        "0 bytes", "1023 bytes", "1 Kb", "1.5 Kb", "1 Mb", "1.1 Gb", None,
    ]


def test_languages():
    assert [N.language_code(x) for x in ("English", "en", "FRA", "fr", "de", None)] == [
        "eng", "eng", "fra", "fra", None, None,
    ]
    with pytest.raises(ValueError):
        N.names_for("de")


def test_canonical_order():
    columns = ["COORDINATE", "Hierarchy for GEO", "Age", "VALUE", "Date", "GEO", "GeoUID", "DGUID", "val_norm",
               "REF_DATE", "Sex", "UOM", "STATUS", "Classification Code for Age"]
    assert N.canonical_columns(columns, "eng") == [
        "REF_DATE", "Date", "GEO", "DGUID", "GeoUID", "Age", "Sex", "VALUE", "val_norm", "UOM", "COORDINATE",
        "STATUS", "Hierarchy for GEO", "Classification Code for Age",
    ]


def test_column_helpers():
    assert N.data_column("Geography", ["GEO", "Age"], "eng") == "GEO"
    assert N.data_column("Geography", ["Geography", "GEO"], "eng") == "Geography"
    assert N.data_column("Sex", ["GEO"], "eng") is None
    assert N.same_columns(["a", "b"], ["b", "a"]) and not N.same_columns(["a"], ["a", "b"])
    with pytest.raises(ValueError, match="Age, AGE"):
        N.reject_duplicate_columns(["Age", "AGE", "Sex"])
