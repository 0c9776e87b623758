import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from statcube.operators.reshape import cube_pivot, wide_to_long
from statcube.plans.pipelines import load_cube
from statcube.sources import service_json as J
from statcube.sources.delimited import malformed, read_cube_csv, repair_header, well_formed
from statcube.sources.metadata_text import cube_members_of, parse_cube_metadata


def test_header_repair():
    assert repair_header(["A", "Symbol", "B", "Symbol"]) == ["A", "Symbol 1", "B", "Symbol 2"]
    assert repair_header(["A", "Symbols", "Symboles"], "fra") == ["A", "Symbol 1", "Symbol 2"]
    assert repair_header(["Coordinate", "Symbol"]) == ["COORDINATE", "Symbol"]
    assert repair_header(["Coordonnée"], "fra") == ["COORDONNÉES"]
    assert repair_header(["Coordinate", "coordinate"]) == ["Coordinate", "coordinate"]


def test_extract_is_read_as_text_with_missing_tokens(spark, tmp_path):
    path = tmp_path / "cube.csv"
    path.write_text(
        '﻿"REF_DATE","GEO","Age, group","VALUE","STATUS"\n'
        '"2015","Ontario","All ""x"", y","1.5",""\n"2015","F","NA","F",".."\n',
        encoding="utf-8",
    )
    rows = [tuple(r) for r in read_cube_csv(spark, str(path)).collect()]
    assert rows == [("2015", "Ontario", 'All "x", y', "1.5", None), ("2015", None, None, None, "..")]
    long = wide_to_long(read_cube_csv(spark, str(path)))
    assert [r.VALUE for r in long.collect()] == [1.5, None]


def test_malformed_records_are_not_lost_in_silence(spark, tmp_path):
    path = tmp_path / "cube.csv"
    path.write_text('"A","B"\n"1","x"\n"2"\n"3","y","z"\n"4","two\nlines"\n', encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_cube_csv(spark, str(path)).select("A").collect()
    marked = read_cube_csv(spark, str(path), multi_line=True, quarantine=True).cache()
    assert sorted(tuple(r) for r in well_formed(marked).collect()) == [("1", "x"), ("4", "two\nlines")]
    assert malformed(marked).count() == 2


def wide(spark, columns, row):
    return spark.createDataFrame([row], ", ".join(f"`{c}` string" for c in columns))


def test_semi_wide_extract(spark):
    columns = [
        "REF_DATE", "GEO", "Coordinate, ", "COORDINATE",
        "Gender (3a): Total, all [1]", "Symbol 1", "Gender (3a): Men.[2]", "Symbol 2",
        "Gender (3a): Women+ [3]", "Symbol 3",
    ]
    df = wide(spark, columns, ("2021", "A", "k", "1.2", "10", None, "4", "x", "..", "r"))
    long = wide_to_long(df)
    assert long.columns == ["REF_DATE", "GEO", "Coordinate, ", "COORDINATE", "VALUE", "Symbol", "Gender (3a)"]
    assert sorted((r.COORDINATE, r.VALUE, r.Symbol, r["Gender (3a)"]) for r in long.collect()) == [
        ("1.2.1", 10.0, None, "Total, all"), ("1.2.2", 4.0, "x", "Men."), ("1.2.3", None, "r", "Women+"),
    ]


def test_unclear_semi_wide_extracts_are_left_alone(spark):
    shifted = ["Symbol 1", "A (2): x[1]", "Symbol 2", "A (2): y[2]"]
    with pytest.warns(UserWarning, match="do not alternate"):
        assert wide_to_long(wide(spark, shifted, ("1",) * 4)).columns == shifted
    mixed = ["A (2): x[1]", "Symbol 1", "B (2): y[2]", "Symbol 2"]
    with pytest.warns(UserWarning, match="several dimensions"):
        assert wide_to_long(wide(spark, mixed, ("1",) * 4)).columns == mixed
    with pytest.warns(UserWarning, match="neither a long"):
        assert wide_to_long(wide(spark, ["A", "Symbol"], ("1", "2"))).columns == ["A", "Symbol"]


def test_pivot_rejects_two_values_for_a_cell(spark):
    df = spark.createDataFrame([("x", "a", 1.0), ("x", "b", 2.0)], "k string, s string, v double")
    assert cube_pivot(df, "s", "v", ["a", "b"]).first().asDict() == {"k": "x", "a": 1.0, "b": 2.0}
    with pytest.raises(Exception, match="Several values"):
        cube_pivot(df.unionAll(df), "s", "v", ["a", "b"]).collect()


def test_pivot_rejects_unlisted_levels(spark):
    df = spark.createDataFrame([("x", "a", 1.0), ("x", "c", 2.0), ("x", None, 3.0)], "k string, s string, v double")
    for rows in (df, df.filter("s = 'c'"), df.filter("s IS NULL")):
        with pytest.raises(Exception, match="Unlisted level"):
            cube_pivot(rows, "s", "v", ["a", "b"]).collect()


METADATA = {
    "eng": '''"Cube Title","Product Id","Archive Status"
"Sales, monthly","20100001","CURRENT"

"Dimension ID","Dimension name","Dimension Notes"
"1","Geography","1"
"2","Industry",

"Dimension ID","Member Name","Classification Code","Member ID","Parent Member ID","Terminated","Member Notes",
"1","Canada","[11124]","1",,,"1;2",
"1","Ontario","[35]","2","1",,,
"2",“Trade, ""all""”,,"1",,,,
"2","Retail","[44-45]","10","1","t","3",

Symbol Legend
"Description","Symbol"
"not available",".."

"Survey Code","Survey Name"
"2303","Survey of
two lines"

"Subject Code","Subject Name"
"16","Manufacturing"

"Note ID","Note"
1,"First, with a comma"
2,"A note on
two lines"
3,Plain

"Correction ID","Correction Date","Correction Note"
"7","2020-01-01","Fixed"
''',
    "fra": '''"Titre du cube";"Identificateur"
"Ventes";"20100001"
"Numéro d'identification de la dimension";"Nom de la dimension";"Notes sur la dimension"
"1";"Géographie";
"Numéro d'identification de la dimension";"Nom du membre";"Code sur la classification";"Numéro d'identification du membre";"Numéro d'identification du membre parent"
"1";"Canada";;"1";
"1";"Québec";"[24]";"2";"1"
Légende Symbole
"Description";"Symbole"
"Code d'enquête";"Nom"
"1";"E"
"Code du sujet";"Nom"
"2";"S"
"Numéro d'identification de la note";"Note"
5;"Une note, avec virgule"
''',
}


def landed(tmp_path, language, ending="\n"):
    path = tmp_path / f"20100001_{language}_MetaData.csv"
    path.write_bytes(METADATA[language].replace("\n", ending).encode("utf-8"))
    return str(path)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_metadata_sections(spark, tmp_path, ending):
    s = parse_cube_metadata(spark, landed(tmp_path, "eng", ending))
    assert s.cube.first().fields == {
        "Cube Title": "Sales, monthly", "Product Id": "20100001", "Archive Status": "CURRENT",
    }
    assert sorted(tuple(r)[1:] for r in s.dimensions.collect()) == [(1, "Geography", "1"), (2, "Industry", None)]
    members = sorted((r.dim_id, r.member_id, r.member_name, r.parent_id, r.code, r.note_ids) for r in s.members.collect())
    assert members == [
        (1, "1", "Canada", None, "[11124]", "1;2"),
        (1, "2", "Ontario", "1", "[35]", None),
        (2, "1", 'Trade, "all"', None, None, None),
        (2, "10", "Retail", "1", "[44-45]", "3"),
    ]
    assert s.surveys.first().fields["Survey Name"] == "Survey of\ntwo lines"
    assert s.subjects.first().fields == {"Subject Code": "16", "Subject Name": "Manufacturing"}
    assert sorted((r.note_id, r.note) for r in s.notes.collect()) == [
        ("1", "First, with a comma"), ("2", "A note on\ntwo lines"), ("3", "Plain"),
    ]
    assert s.corrections.first().fields["Correction Note"] == "Fixed"
    rows = cube_members_of(s)
    assert {(r.cube_id, r.dim_name) for r in rows.collect()} == {("20-10-0001", "Geography"), ("20-10-0001", "Industry")}
    (tmp_path / "other").mkdir()
    other = METADATA["eng"].replace("20100001", "35100003")
    (tmp_path / "other" / "35100003_MetaData.csv").write_text(other, encoding="utf-8")
    both = cube_members_of(parse_cube_metadata(spark, str(tmp_path)))
    assert {(r.cube_id, r.n) for r in both.groupBy("cube_id").agg(F.count("*").alias("n")).collect()} == {("20-10-0001", 4), ("35-10-0003", 4)}


def test_french_metadata(spark, tmp_path):
    s = parse_cube_metadata(spark, landed(tmp_path, "fra"), "fra")
    assert sorted((r.member_name, r.code) for r in s.members.collect()) == [("Canada", None), ("Québec", "[24]")]
    assert [(r.note_id, r.note) for r in s.notes.collect()] == [("5", "Une note, avec virgule")]
    assert s.corrections.count() == 0


def test_long_quoted_texts_parse_in_linear_time(spark, tmp_path):
    text = 'word ""quoted"" ' * 40_000
    path = tmp_path / "x_MetaData.csv"
    path.write_text(f'"Cube Title"\n"T"\n"Note ID","Note"\n1,"{text}"\n2,"b"\n', encoding="utf-8")
    notes = {r.note_id: r.note for r in parse_cube_metadata(spark, str(path)).notes.collect()}
    assert notes == {"1": text, "2": "b"}


def test_whole_cube_from_landed_files(spark, tmp_path):
    data = tmp_path / "20100001.csv"
    data.write_text(
        '"REF_DATE","GEO","DGUID","Industry","UOM","SCALAR_FACTOR","SCALAR_ID","VECTOR","COORDINATE","VALUE"\n'
        '"2015-03","Canada","2016A000011124","Retail [44-45]","Percent","units ","0","v1","1.10","50"\n'
        '"2015","Ontario","2016A000235","Unknown","Dollars","thousands ","3","v2","2.1","2.5"\n',
        encoding="utf-8",
    )
    cube = load_cube(spark, str(data), landed(tmp_path, "eng"), "20-10-0001")
    assert cube.columns == [
        "REF_DATE", "Date", "GEO", "DGUID", "GeoUID", "Industry", "GEO__ord", "Industry__ord", "VALUE",
        "val_norm", "UOM", "SCALAR_FACTOR", "SCALAR_ID", "VECTOR", "COORDINATE", "Hierarchy for GEO",
        "Classification Code for Industry", "Hierarchy for Industry",
    ]
    a, b = cube.orderBy("VECTOR").collect()
    assert (a.Date, a.Industry, a.val_norm, a.GeoUID) == (date(2015, 3, 1), "Retail", 0.5, "11124")
    assert (a["Hierarchy for Industry"], a["Classification Code for Industry"]) == ("1.10", "[44-45]")
    # A label that is no category becomes missing.
    assert (b.Date, b.Industry, b.val_norm, b["Hierarchy for GEO"]) == (date(2015, 7, 1), None, 2500.0, "1.2")


def records(spark, tmp_path, rows, schema, **options):
    path = tmp_path / "records.json"
    path.write_text(json.dumps(rows), encoding="utf-8")
    return J.read_records(spark, str(path), schema, multi_line=True, **options)


def test_observations(spark, tmp_path):
    point = {"refPer": "2020-01-01", "refPer2": "", "value": 1.5, "decimals": 1, "scalarFactorCode": 3}
    rows = [
        {"status": "SUCCESS", "object": {"productId": 20100001, "coordinate": "1.1.0.0.0.0.0.0.0.0", "vectorId": 7,
                                          "vectorDataPoint": [point, {**point, "refPer": "2020-02-01", "value": None}]}},
        {"status": "SUCCESS", "object": {"productId": 20100001, "coordinate": "1.2.0.0.0.0.0.0.0.0", "vectorId": 0,
                                          "vectorDataPoint": [point]}},
        {"status": "SUCCESS", "object": {"productId": 20100001, "coordinate": "9.9", "vectorId": 8, "vectorDataPoint": []}},
        {"status": "FAILED", "object": {"responseStatusCode": 4, "vectorId": 9}},
    ]
    read = records(spark, tmp_path, rows, J.OBSERVATION_OBJECT)
    found = J.observation_rows(read)
    assert "REF_DATE_2" not in found.columns
    assert sorted((r.VECTOR or "", r.REF_DATE, r.VALUE, r.cube_id) for r in found.collect()) == [
        ("", "2020-01-01", 1.5, "20-10-0001"),
        ("v7", "2020-01-01", 1.5, "20-10-0001"),
        ("v7", "2020-02-01", None, "20-10-0001"),
    ]
    assert "REF_DATE_2" in J.observation_rows(read, with_second_period=True).columns
    _, failures = J.route_records(read)
    assert [r.reason for r in failures.collect()] == ["Vector is invalid"]


def test_metadata_records(spark, tmp_path):
    cube = {
        "productId": "20100001", "cubeTitleEn": "Sales", "releaseTime": "2025-03-01T08:30",
        "surveyCode": ["1", "2"], "subjectCode": ["3"], "oldNumber": "079-0003",
        "dimension": [{"dimensionPositionId": 1, "dimensionNameEn": "Geography", "dimensionNameFr": "Géographie",
                       "member": [{"memberId": 1, "memberNameEn": "Canada", "memberNameFr": "Canada", "terminated": 0},
                                  {"memberId": 2, "parentMemberId": 1, "memberNameEn": "Quebec", "memberNameFr": "Québec"}]}],
        "footnote": [{"footnoteId": 1, "footnotesEn": "n", "footnotesFr": "m",
                      "link": [{"footnoteId": 1, "dimensionPositionId": 0, "memberId": 0},
                               {"footnoteId": 1, "dimensionPositionId": 1, "memberId": 2}]},
                     {"footnoteId": 2, "footnotesEn": "o"}],
    }
    read = records(spark, tmp_path, [{"status": "SUCCESS", "object": cube}, {"status": "FAILED"}],
                   J.METADATA_OBJECT, more_fields=["oldNumber string"])
    overview = J.cube_overviews(read).first()
    assert (overview.productId, overview.surveyCode, overview.oldNumber) == ("20-10-0001", "1, 2", "079-0003")
    members = J.members_for_language(J.cube_member_rows(read), "fra")
    assert sorted((r.member_id, r.member_name, r.parent_id) for r in members.collect()) == [
        ("1", "Canada", None), ("2", "Québec", "1"),
    ]
    links = sorted((r.footnoteId, r.dimensionPositionId, r.memberId) for r in J.cube_notes(read).fillna("-").collect())
    assert links == [("1", "0", "0"), ("1", "1", "2"), ("2", "-", "-")]


def test_code_sets(spark, tmp_path):
    path = tmp_path / "codes.json"
    path.write_text(json.dumps({"object": {"survey": [{"surveyCode": "1", "surveyEn": "A", "surveyFr": "NULL"}]}}))
    assert tuple(J.read_code_set(spark, str(path), "survey").first()) == ("1", "A", None)
    with pytest.raises(ValueError, match="Unknown code set"):
        J.read_code_set(spark, str(path), "colour")


def test_catalog(spark, tmp_path):
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps([
        {"productId": "20100001", "cubeTitleEn": "Sales", "cubeStartDate": "1946-01-01", "archived": "1",
         "releaseTime": "2025-03-01T08:30:00Z", "subjectCode": ["16"], "surveyCode": [],
         "dimensions": [{"dimensionNameEn": "Geography"}, {"dimensionNameEn": "Sales"}]}]))
    row = J.read_catalog(spark, str(path), multi_line=True).first()
    assert (row.cube_id, row.cubeStartDate, row.archived, row.dimensionNameEn, row.surveyCode) == (
        "20-10-0001", date(1946, 1, 1), True, "Geography, Sales", "",
    )
    lite = J.read_catalog(spark, str(path), lite=True, multi_line=True)
    assert "dimensionNameEn" not in lite.columns
    assert lite.filter(F.col("cube_id") == "20-10-0001").count() == 1
