"""Landed files: extracts, metadata texts and JSON records written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cube_queries.cubes import (
    ORDERS_CUBE,
    RETURNS_CUBE,
    catalog,
    cube_of_sql,
    orders_facts,
    orders_members,
    releases,
    returns_wide,
    table,
    text,
)
from cube_queries.members import NORMALIZED_SQL
from cube_queries.registry import query, with_tables
from statcube.functions import expressions as X
from statcube.functions.names import names_for, rename_language
from statcube.operators.reshape import wide_to_long
from statcube.plans.metadata import store_metadata, stored_members
from statcube.plans.pipelines import load_cube
from statcube.sources import metadata_text as Mt
from statcube.sources import service_json as J
from statcube.sources.delimited import MALFORMED, read_cube_csv
from statcube.sources.scratch import scratch_path
from statcube.sources.store import append_to_cube
from statcube.streaming.landing import import_landed


def land_csv(df, language="eng"):
    """Write a frame the way extracts are published: header, quoted text."""
    path = scratch_path(df.sparkSession, "extract")
    writer = df.write.option("header", True).option("sep", names_for(language).delimiter)
    writer = writer.option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False)
    writer.option("quoteAll", True).option("escape", '"').csv(path)
    return path


def land_json(df):
    path = scratch_path(df.sparkSession, "records")
    df.write.json(path)
    return path


# --- extracts ----------------------------------------------------------------------------------

_RAW = """SELECT * REPLACE ("VALUE"::DOUBLE AS "VALUE") FROM orders_facts"""


@query("csv_roundtrip", with_tables(["orders_facts"], _RAW))
def csv_roundtrip(spark, folder):
    path = land_csv(orders_facts(spark, folder))
    return wide_to_long(read_cube_csv(spark, path))


@query(
    "csv_french",
    with_tables(
        ["orders_facts"],
        """SELECT "REF_DATE", "GEO", "VALUE", "COORDINATE", "UOM", "SCALAR_ID" FROM orders_facts""",
    ),
)
def csv_french(spark, folder):
    facts = orders_facts(spark, folder).select("REF_DATE", "GEO", "VALUE", "COORDINATE", "UOM", "SCALAR_ID")
    path = land_csv(rename_language(facts, "eng", "fra"), "fra")
    return rename_language(wide_to_long(read_cube_csv(spark, path, "fra"), "fra"), "fra", "eng")


@query(
    "csv_null_tokens",
    """SELECT doc_id::VARCHAR AS doc_id, CASE WHEN text NOT IN ('', 'NA', 'F', '<NA>') THEN text END AS text,
              CASE lang WHEN 'en' THEN NULL ELSE lang END AS lang FROM documents""",
)
def csv_null_tokens(spark, folder):
    """Whole texts with quotes and line breaks; English is written as a null token."""
    docs = table(spark, folder, "documents").select(
        "doc_id",
        "text",
        F.when(F.col("lang") == "en", F.lit("F")).otherwise(F.col("lang")).alias("lang"),
    )
    return read_cube_csv(spark, land_csv(docs), multi_line=True)


@query(
    "csv_wide",
    with_tables(
        ["returns_long"],
        """SELECT * REPLACE (nullif("Line status", 'F') AS "Line status") FROM returns_long""",
    ),
)
def csv_wide(spark, folder):
    """Semi-wide extract with a differently spelled coordinate; status F is a null token."""
    extract = returns_wide(spark, folder).withColumnRenamed("COORDINATE", "Coordinate")
    path = land_csv(extract)
    return wide_to_long(read_cube_csv(spark, path))


@query(
    "stream_import",
    with_tables(
        ["returns_long"],
        """SELECT "REF_DATE", nullif("Line status", 'F') AS "Line status", "COORDINATE", "VALUE", "Return flag (3)"
           FROM returns_long""",
    ),
)
def stream_import(spark, folder):
    extract = returns_wide(spark, folder)
    landing = scratch_path(spark, "landing")
    extract.repartition(4).write.option("header", True).option("quoteAll", True).csv(landing)
    cube = import_landed(
        spark, landing, extract.columns, scratch_path(spark, "store"), RETURNS_CUBE,
        partition_by=["Line status"], files_per_step=2,
    )
    return cube.select("REF_DATE", "Line status", "COORDINATE", "VALUE", "Return flag (3)")


# --- metadata texts ----------------------------------------------------------------------------


def _quoted_line(*columns):
    """Delimited record with every field quoted; a missing field stays empty."""
    cells = [
        F.coalesce(F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"')), F.lit("")) for c in columns
    ]
    return F.concat_ws(",", *cells)


def _land_metadata(spark, folder):
    """One metadata file per block of documents: they are its members, and its notes."""
    lit, line = F.lit, _quoted_line
    doc, lang = text(F.col("doc_id")), F.col("lang")
    documents = table(spark, folder, "documents").withColumn("block", F.floor(F.col("doc_id") / 250))
    head = [
        (0, line(lit("Cube Title"), lit("Product Id"))),
        (1, line(F.concat(lit("Cube "), text(F.col("block"))), text(F.lit(20100000) + F.col("block")))),
        (2, line(lit("Dimension ID"), lit("Dimension name"), lit("Dimension Notes"))),
        (3, line(lit("1"), lit("Document"), lit("1;2"))),
        (4, line(lit("Dimension ID"), lit("Member Name"), lit("Classification Code"), lit("Member ID"),
                 lit("Parent Member ID"), lit("Terminated"), lit("Member Notes"))),
        (6, lit("Symbol Legend")),
        (7, line(lit("Description"), lit("Symbol"))),
        (8, line(lit("Survey Code"), lit("Survey Name"))),
        (9, line(lit("12"), lit("Survey, the twelfth"))),
        (10, line(lit("Subject Code"), lit("Subject Name"))),
        (11, line(lit("34"), lit("Subject"))),
        (12, line(lit("Note ID"), lit("Note"))),
        (14, line(lit("Correction ID"), lit("Correction Date"), lit("Correction Note"))),
    ]
    # Lines of one document: a member record and a note record.
    own = F.array(
        F.struct(
            lit(5).alias("s"),
            F.col("doc_id").alias("p"),
            line(lit("1"), F.col("source"), F.when(lang != "en", F.concat(lit("["), lang, lit("]"))), doc,
                 F.when(F.col("doc_id") % 250 != 0, text(F.floor(F.col("doc_id") / 250) * 250)),
                 lit(None).cast("string"), doc).alias("t"),
        ),
        F.struct(
            lit(13).alias("s"), F.col("doc_id").alias("p"), F.concat(doc, lit(","), line(F.col("text"))).alias("t")
        ),
    )
    fixed = F.array(*[F.struct(lit(s).alias("s"), lit(0).cast("bigint").alias("p"), t.alias("t")) for s, t in head])
    lines = documents.select("block", F.inline(own)).unionByName(
        documents.select("block").distinct().select("block", F.inline(fixed))
    )
    # A file holds at most 250 documents, so its lines fit in one row.
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("s", "p", "t"))), lambda r: r["t"])
    path = scratch_path(spark, "metadata")
    whole = lines.groupBy("block").agg(F.array_join(ordered, "\n").alias("value"))
    whole.write.partitionBy("block").text(path)
    return path


def _block(c):
    return F.regexp_extract(c, r"block=(\d+)", 1).cast("bigint")


@query(
    "metadata_sections",
    """SELECT doc_id // 250 AS block, 1 AS dim_id, 'Document' AS dim_name, doc_id::VARCHAR AS member_id,
              source AS member_name, CASE WHEN doc_id % 250 <> 0 THEN (doc_id // 250 * 250)::VARCHAR END AS parent_id,
              CASE WHEN lang <> 'en' THEN '[' || lang || ']' END AS code, doc_id::VARCHAR AS note_ids
       FROM documents""",
)
def metadata_sections(spark, folder):
    sections = Mt.parse_cube_metadata(spark, _land_metadata(spark, folder))
    names = sections.dimensions.select("file", "dim_id", "dim_name")
    return sections.members.join(names, ["file", "dim_id"]).select(
        _block(F.col("file")).alias("block"),
        "dim_id", "dim_name", "member_id", "member_name", "parent_id", "code", "note_ids",
    )


@query(
    "metadata_notes",
    """SELECT doc_id // 250 AS block, doc_id::VARCHAR AS note_id, replace(text, '"', '""') AS note FROM documents""",
)
def metadata_notes(spark, folder):
    notes = Mt.parse_cube_metadata(spark, _land_metadata(spark, folder)).notes
    return notes.select(_block(F.col("file")).alias("block"), "note_id", "note")


@query(
    "load_cube",
    with_tables(
        ["orders_facts", "orders_members"],
        f"""SELECT * EXCLUDE (rank_geo) FROM ({NORMALIZED_SQL})""",
    ),
)
def loaded(spark, folder):
    data = land_csv(orders_facts(spark, folder))
    line = _quoted_line
    members = orders_members(spark, folder)
    lit = F.lit
    first = spark.range(0, 1, 1, 1)
    sections = (
        first.select(lit(0).alias("s"), lit(0).cast("bigint").alias("p"), line(lit("Cube Title")).alias("t"))
        .unionAll(first.select(lit(0), lit(1), line(lit("Orders"))))
        .unionAll(first.select(lit(1), lit(0), line(lit("Dimension ID"), lit("Dimension name"))))
        .unionAll(
            members.select("dim_id", "dim_name").distinct().select(
                lit(1), F.col("dim_id"), line(text(F.col("dim_id")), F.col("dim_name"))
            )
        )
        .unionAll(
            first.select(
                lit(2), lit(0),
                line(lit("Dimension ID"), lit("Member Name"), lit("Classification Code"), lit("Member ID"),
                     lit("Parent Member ID")),
            )
        )
        .unionAll(
            members.select(
                lit(2), F.col("dim_id") * 100000 + F.col("member_id").cast("bigint"),
                line(text(F.col("dim_id")), F.col("member_name"), F.col("code"), F.col("member_id"),
                     F.col("parent_id")),
            )
        )
        .unionAll(first.select(lit(3), lit(0), lit("Symbol Legend")))
    )
    path = scratch_path(spark, "metadata")
    sections.orderBy("s", "p").coalesce(1).select("t").write.text(path)
    return load_cube(spark, data, path, ORDERS_CUBE)


# --- JSON records ------------------------------------------------------------------------------


def _observation_records(spark, folder):
    """A record holds the points of one series in one year, at most twelve."""
    facts = orders_facts(spark, folder)
    point = F.struct(
        F.col("REF_DATE").alias("refPer"),
        F.lit("").alias("refPer2"),
        F.col("VALUE").alias("value"),
        F.lit(2).alias("decimals"),
        F.col("SCALAR_ID").cast("int").alias("scalarFactorCode"),
        F.lit(6).alias("frequencyCode"),
        F.concat("REF_DATE", F.lit("-09T08:30")).alias("releaseTime"),
    )
    series = facts.groupBy("VECTOR", "COORDINATE", F.substring("REF_DATE", 1, 4).alias("year")).agg(
        F.collect_list(point).alias("points")
    )
    priority = X.coordinate_part(F.col("COORDINATE"), 2)
    statistic = X.coordinate_part(F.col("COORDINATE"), 3)
    failed = priority == "4"
    return series.select(
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.struct(
            F.when(failed, 4).otherwise(0).alias("responseStatusCode"),
            F.lit(14100001).alias("productId"),
            X.pad_coordinate(F.col("COORDINATE")).alias("coordinate"),
            F.when(priority == "5", F.lit(0)).otherwise(X.bare_vector(F.col("VECTOR")).cast("int")).alias("vectorId"),
            F.when(failed | (statistic == "3"), F.array().cast(f"array<{point_type()}>"))
            .otherwise(F.col("points")).alias("vectorDataPoint"),
        ).alias("object"),
    )


def point_type() -> str:
    return (
        "struct<refPer:string,refPer2:string,value:double,decimals:int,scalarFactorCode:int,"
        "frequencyCode:int,releaseTime:string>"
    )


@query(
    "observations_json",
    with_tables(
        ["orders_facts"],
        f"""SELECT 2 AS "DECIMALS", "VALUE", "REF_DATE", "REF_DATE" || '-09T08:30' AS "releaseTime",
              NULL::INT AS "SYMBOL", 6 AS "frequencyCode", "SCALAR_ID"::INT AS "SCALAR_ID",
              "COORDINATE" || '.0.0.0.0.0.0.0' AS "COORDINATE",
              CASE WHEN "COORDINATE" NOT LIKE '%.5._' THEN "VECTOR" END AS "VECTOR", '{ORDERS_CUBE}' AS cube_id
            FROM orders_facts WHERE "COORDINATE" NOT LIKE '%.4._' AND "Statistic" <> 'Share with status F' """,
    ),
)
def observations_json(spark, folder):
    path = land_json(_observation_records(spark, folder))
    return J.observation_rows(J.read_records(spark, path, J.OBSERVATION_OBJECT))


@query(
    "route_failures",
    with_tables(
        ["orders_facts"],
        """SELECT DISTINCT "COORDINATE" || '.0.0.0.0.0.0.0' AS coordinate, 'Vector is invalid' AS reason
           FROM orders_facts WHERE "COORDINATE" LIKE '%.4._' """,
    ),
)
def route_failures(spark, folder):
    path = land_json(_observation_records(spark, folder))
    _, failures = J.route_records(J.read_records(spark, path, J.OBSERVATION_OBJECT))
    return failures.select("object.coordinate", "reason").distinct()


@query(
    "series_info_json",
    """SELECT p_size AS "DECIMALS", 'v' || p_partkey::VARCHAR AS "VECTOR", '14-10-0001' AS "table",
              '1.' || (p_partkey * 10 + 10)::VARCHAR AS "COORDINATE", p_name AS title_en, upper(p_name) AS title_fr,
              NULL::INT AS "UOM", 6 AS "frequencyCode", 3 AS "SCALAR_ID", p_name AS title FROM part""",
)
def series_info_json(spark, folder):
    part = table(spark, folder, "part")
    records = part.select(
        F.lit("SUCCESS").alias("status"),
        F.struct(
            F.lit(0).alias("responseStatusCode"),
            F.lit(14100001).alias("productId"),
            F.concat(F.lit("1."), text(F.col("p_partkey") * 10 + 10), F.lit(".0.0.0.0.0.0.0.0")).alias("coordinate"),
            F.col("p_partkey").alias("vectorId"),
            F.col("p_size").alias("decimals"),
            F.col("p_name").alias("SeriesTitleEn"),
            F.upper("p_name").alias("SeriesTitleFr"),
            F.lit(6).alias("frequencyCode"),
            F.lit(3).alias("scalarFactorCode"),
        ).alias("object"),
    )
    return J.series_info_rows(J.read_records(spark, land_json(records), J.SERIES_OBJECT))


def _metadata_records(spark, folder):
    """One cube per block of a hundred documents: members are documents, notes their texts."""
    documents = table(spark, folder, "documents")
    doc = F.col("doc_id").cast("int")
    member = F.struct(
        doc.alias("memberId"),
        F.floor(doc / 10).cast("int").alias("parentMemberId"),
        F.col("source").alias("memberNameEn"),
        F.upper("source").alias("memberNameFr"),
        F.col("lang").alias("classificationCode"),
        F.lit(0).alias("terminated"),
    )
    own = F.struct(doc.alias("footnoteId"), F.lit(1).alias("dimensionPositionId"), doc.alias("memberId"))
    cube_level = F.struct(
        doc.alias("footnoteId"), F.lit(0).alias("dimensionPositionId"), F.lit(0).alias("memberId")
    )
    note = F.struct(
        doc.alias("footnoteId"),
        F.col("text").alias("footnotesEn"),
        F.upper("lang").alias("footnotesFr"),
        F.when(F.col("lang") == "de", F.array().cast("array<struct<footnoteId:int,dimensionPositionId:int,memberId:int>>"))
        .when(F.col("lang") == "en", F.array(own, cube_level))
        .otherwise(F.array(own, own)).alias("link"),
    )
    correction = F.struct(
        doc.alias("correctionId"),
        F.lit("2024-01-01").alias("correctionDate"),
        F.col("source").alias("correctionNoteEn"),
    )
    block = F.floor(F.col("doc_id") / 100)
    cubes = documents.groupBy(block.alias("block")).agg(
        F.collect_list(member).alias("member"),
        F.collect_list(note).alias("footnote"),
        F.collect_list(F.when(F.col("lang") == "fr", correction)).alias("correctionFootnote"),
        F.count(F.lit(1)).alias("n"),
    )
    return cubes.select(
        F.lit("SUCCESS").alias("status"),
        F.struct(
            text(F.lit(30000000) + F.col("block")).alias("productId"),
            F.concat(F.lit("Cube "), text(F.col("block"))).alias("cubeTitleEn"),
            F.concat(F.lit("Le cube "), text(F.col("block"))).alias("cubeTitleFr"),
            F.lit("1995-01-01").alias("cubeStartDate"),
            F.col("n").alias("nbSeriesCube"),
            F.lit("2024-03-01T08:30").alias("releaseTime"),
            F.array(text(F.col("block")), F.lit("7")).alias("subjectCode"),
            F.array(F.lit("3701"), F.lit("3702")).alias("surveyCode"),
            F.lit(6).alias("frequencyCode"),
            F.array(
                F.struct(
                    F.lit(1).alias("dimensionPositionId"),
                    F.lit("Document").alias("dimensionNameEn"),
                    F.lit("Le document").alias("dimensionNameFr"),
                    "member",
                )
            ).alias("dimension"),
            "footnote",
            "correctionFootnote",
        ).alias("object"),
    )


def metadata_records(spark, folder):
    return J.read_records(spark, land_json(_metadata_records(spark, folder)), J.METADATA_OBJECT)


_BLOCK_ID = """'30-00-' || lpad((doc_id // 100)::VARCHAR, 4, '0')"""


@query(
    "overview_json",
    f"""SELECT {_BLOCK_ID} AS "productId", 'Cube ' || (doc_id // 100)::VARCHAR AS "cubeTitleEn", count(*) AS "nbSeriesCube",
              (doc_id // 100)::VARCHAR || ', 7' AS "subjectCode", '3701, 3702' AS "surveyCode", 6 AS "frequencyCode",
              epoch_us(TIMESTAMP '2024-03-01 13:30:00') // 1000000 AS released
        FROM documents GROUP BY doc_id // 100""",
)
def overview_json(spark, folder):
    overview = J.cube_overviews(metadata_records(spark, folder))
    return overview.select(
        "productId", "cubeTitleEn", "nbSeriesCube", "subjectCode", "surveyCode", "frequencyCode",
        F.unix_seconds("releaseTime").alias("released"),
    )


@query(
    "members_json",
    f"""SELECT {_BLOCK_ID} AS cube_id, '1' AS "dimensionPositionId", 'Document' AS "dimensionNameEn",
              'Le document' AS "dimensionNameFr", doc_id::VARCHAR AS "memberId", (doc_id // 10)::VARCHAR AS "parentMemberId",
              source AS "memberNameEn", upper(source) AS "memberNameFr", lang AS "classificationCode",
              NULL::VARCHAR AS "geoLevel", '0' AS terminated FROM documents""",
)
def members_json(spark, folder):
    return J.cube_member_rows(metadata_records(spark, folder))


@query(
    "notes_json",
    f"""SELECT {_BLOCK_ID} AS cube_id, doc_id::VARCHAR AS "footnoteId", text AS "footnotesEn", upper(lang) AS "footnotesFr",
              CASE WHEN lang <> 'de' THEN '1' END AS "dimensionPositionId",
              CASE WHEN lang <> 'de' THEN doc_id::VARCHAR END AS "memberId" FROM documents
        UNION ALL SELECT {_BLOCK_ID}, doc_id::VARCHAR, text, upper(lang), '0', '0' FROM documents WHERE lang = 'en' """,
)
def notes_json(spark, folder):
    return J.cube_notes(metadata_records(spark, folder))


@query(
    "corrections_json",
    f"""SELECT {_BLOCK_ID} AS cube_id, doc_id::INT AS "correctionId", '2024-01-01' AS "correctionDate",
              source AS "correctionNoteEn", NULL::VARCHAR AS "correctionNoteFr" FROM documents WHERE lang = 'fr' """,
)
def corrections_json(spark, folder):
    return J.cube_corrections(metadata_records(spark, folder))


@query(
    "catalog_json",
    with_tables(
        ["catalog"],
        """SELECT c.cube_id, c."cubeTitleEn", c."cubeTitleFr", c."productId", DATE '1990-01-01' AS "cubeStartDate",
                  c."surveyCode", c."subjectCode", c_acctbal < 0 AS archived, 'Name, Segment' AS "dimensionNameEn"
           FROM catalog c JOIN customer ON c_custkey = c."productId"::BIGINT - 10000000""",
    ),
)
def catalog_json(spark, folder):
    balance = table(spark, folder, "customer").select(
        text(F.lit(10000000) + F.col("c_custkey")).alias("productId"), "c_acctbal"
    )
    raw = catalog(spark, folder).join(balance, "productId").select(
        "productId",
        "cubeTitleEn",
        "cubeTitleFr",
        F.lit("1990-01-01").alias("cubeStartDate"),
        F.when(F.col("c_acctbal") < 0, "1").otherwise("2").alias("archived"),
        F.array("subjectCode").alias("subjectCode"),
        F.split("surveyCode", ", ").alias("surveyCode"),
        F.array(
            F.struct(F.lit("Name").alias("dimensionNameEn")), F.struct(F.lit("Segment").alias("dimensionNameEn"))
        ).alias("dimensions"),
    )
    back = J.read_catalog(spark, land_json(raw))
    return back.select(
        "cube_id", "cubeTitleEn", "cubeTitleFr", "productId", "cubeStartDate", "surveyCode", "subjectCode",
        "archived", "dimensionNameEn",
    )


@query(
    "codeset_json",
    """SELECT s_suppkey::VARCHAR AS "surveyCode", s_name AS "surveyEn",
              CASE WHEN s_nationkey <> 3 THEN upper(s_name) END AS "surveyFr" FROM supplier""",
)
def codeset_json(spark, folder):
    """A code set in pieces of a hundred codes; NULL is written as text."""
    code = F.struct(
        text(F.col("s_suppkey")).alias("surveyCode"),
        F.col("s_name").alias("surveyEn"),
        F.when(F.col("s_nationkey") == 3, "NULL").otherwise(F.upper("s_name")).alias("surveyFr"),
    )
    pieces = (
        table(spark, folder, "supplier")
        .groupBy(F.floor(F.col("s_suppkey") / 100).alias("piece"))
        .agg(F.collect_list(code).alias("survey"))
        .select(F.struct("survey").alias("object"))
    )
    return J.read_code_set(spark, land_json(pieces), "survey", multi_line=False)


@query(
    "release_records",
    f"""SELECT {cube_of_sql('user_id')} AS cube_id, date_trunc('minute', ts)::VARCHAR AS released FROM events""",
)
def release_records(spark, folder):
    log = table(spark, folder, "events").select(
        text(F.lit(10000000) + F.col("user_id")).alias("productid"),
        F.array(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("releasedate"))).alias("result"),
    )
    back = J.read_release_records(spark, land_json(log))
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("releaseTime").cast("timestamp_ntz"))
    return back.select("cube_id", F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("released"))


@query(
    "release_schedule",
    """SELECT event_id::VARCHAR AS title, ts::DATE AS date FROM events""",
)
def release_schedule(spark, folder):
    planned = table(spark, folder, "events").select(
        text(F.col("event_id")).alias("title"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("date")
    )
    return J.read_release_schedule(spark, land_json(planned), multi_line=False)


@query(
    "json_releases",
    with_tables(
        ["releases"],
        """SELECT cube_id, event_type, sum(k)::BIGINT AS k FROM (
             SELECT r.cube_id, r.event_type, json_extract_string(props, '$.k')::BIGINT AS k
             FROM events e JOIN (SELECT DISTINCT cube_id, event_type FROM releases) r
               ON r.event_type = e.event_type AND r.cube_id = substr((10000000 + user_id)::VARCHAR, 1, 2) || '-'
                  || substr((10000000 + user_id)::VARCHAR, 3, 2) || '-' || substr((10000000 + user_id)::VARCHAR, 5, 4))
           GROUP BY 1, 2""",
    ),
)
def json_releases(spark, folder):
    """Field of a JSON column, summed per cube and kind of release."""
    events = table(spark, folder, "events")
    k = F.from_json("props", "k bigint")["k"]
    return (
        events.select(
            X.clean_cube_id(text(F.lit(10000000) + F.col("user_id"))).alias("cube_id"), "event_type", k.alias("k")
        )
        .groupBy("cube_id", "event_type")
        .agg(F.sum("k").alias("k"))
    )


@query(
    "csv_malformed",
    """SELECT (SELECT count(*) FROM orders WHERE o_orderkey % 5 <> 0)::BIGINT AS well_formed,
              (SELECT count(*) FROM orders WHERE o_orderkey % 5 = 0)::BIGINT AS malformed""",
)
def csv_malformed(spark, folder):
    """Records with a field too few or too many are set apart."""
    key = text(F.col("o_orderkey"))
    line = (
        F.when(F.col("o_orderkey") % 10 == 0, key)
        .when(F.col("o_orderkey") % 10 == 5, F.concat_ws(",", key, key, key))
        .otherwise(F.concat_ws(",", key, text(F.col("o_custkey"))))
    )
    path = scratch_path(spark, "extract")
    table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    marked = read_cube_csv(spark, path, header=["KEY", "CUSTOMER"], quarantine=True, first_line=False)
    return marked.agg(
        F.count_if(F.col(MALFORMED).isNull()).alias("well_formed"), F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed")
    )


@query(
    "import_twice",
    with_tables(
        ["returns_long"],
        """SELECT "REF_DATE", nullif("Line status", 'F') AS "Line status", "COORDINATE", "VALUE" FROM returns_long
           UNION ALL SELECT "REF_DATE", nullif("Line status", 'F'), "COORDINATE", "VALUE" FROM returns_long
           WHERE "REF_DATE" >= '1998' """,
    ),
)
def import_twice(spark, folder):
    """An import, more files, the import again, and once more without new files."""
    extract = returns_wide(spark, folder)
    landing, progress, root = scratch_path(spark, "landing"), scratch_path(spark, "progress"), scratch_path(spark, "store")

    def land(rows):
        rows.repartition(2).write.mode("append").option("header", True).option("quoteAll", True).csv(landing)

    def run():
        return import_landed(spark, landing, extract.columns, root, RETURNS_CUBE, partition_by=["Line status"], progress=progress)

    land(extract)
    run()
    land(extract.filter("REF_DATE >= '1998'"))
    run()
    return run().select("REF_DATE", "Line status", "COORDINATE", "VALUE")


@query(
    "append_after_import",
    with_tables(
        ["returns_long"],
        """SELECT "REF_DATE", nullif("Line status", 'F') AS "Line status", "COORDINATE", "VALUE" FROM returns_long
           UNION ALL SELECT "REF_DATE", "Line status", "COORDINATE", "VALUE" FROM returns_long WHERE "REF_DATE" < '1994' """,
    ),
)
def append_after_import(spark, folder):
    """Rows that are appended to an imported cube are read with it."""
    extract = returns_wide(spark, folder)
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "store")
    extract.repartition(2).write.option("header", True).option("quoteAll", True).csv(landing)
    import_landed(spark, landing, extract.columns, root, RETURNS_CUBE, partition_by=["Line status"])
    more = wide_to_long(extract.filter("REF_DATE < '1994'"))
    return append_to_cube(more, root, RETURNS_CUBE).select("REF_DATE", "Line status", "COORDINATE", "VALUE")


@query(
    "stored_metadata",
    """SELECT '20-10-' || lpad((doc_id // 250)::VARCHAR, 4, '0') AS cube_id, doc_id::VARCHAR AS member_id,
              CASE WHEN doc_id % 250 = 0 THEN doc_id::VARCHAR
                   ELSE (doc_id // 250 * 250)::VARCHAR || '.' || doc_id::VARCHAR END AS hierarchy FROM documents""",
)
def stored_metadata(spark, folder):
    """Members of all metadata files of a folder, prepared and stored in one job and read back; stored twice, read once."""
    root = scratch_path(spark, "store")
    members = Mt.cube_members_of(Mt.parse_cube_metadata(spark, _land_metadata(spark, folder))).drop("terminated")
    store_metadata(members, root)
    store_metadata(members, root)
    return stored_members(spark, root).select("cube_id", "member_id", "hierarchy")


@query(
    "metadata_of_cubes",
    """SELECT '20-10-' || lpad((doc_id // 250)::VARCHAR, 4, '0') AS cube_id, count(*)::BIGINT AS n FROM documents GROUP BY 1""",
)
def metadata_of_cubes(spark, folder):
    """Members of many metadata files in one job, each with the cube that its file names."""
    members = Mt.cube_members_of(Mt.parse_cube_metadata(spark, _land_metadata(spark, folder)))
    return members.groupBy("cube_id").agg(F.count(F.lit(1)).alias("n"))
