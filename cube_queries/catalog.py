"""Catalog, notes, releases and freshness."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from cube_queries.cubes import (
    catalog,
    cube_of_sql,
    orders_members,
    releases,
    subjects,
    surveys,
    table,
    text,
)
from cube_queries.registry import query, with_tables
from statcube.functions import expressions as X
from statcube.operators import catalog as C
from statcube.sources.store import stale_cubes, with_freshness


def full_catalog(spark, folder):
    return C.label_catalog(catalog(spark, folder), surveys(spark, folder), subjects(spark, folder))


@query("label_codes", with_tables(["catalog_full"], "SELECT * FROM catalog_full"))
def label_codes(spark, folder):
    return full_catalog(spark, folder)


@query(
    "search_catalog",
    with_tables(
        ["catalog_full"],
        """SELECT cube_id, "cubeTitleEn" FROM catalog_full
           WHERE regexp_matches(concat_ws('|', "cubeTitleEn", "cubeTitleFr", "surveyEn", "surveyFr", "subjectEn",
             "subjectFr", "subjectCode", "surveyCode", cube_id, "productId"), '(?i)nation_1;|machin|00-0007')""",
    ),
)
def search_catalog(spark, folder):
    return C.search_catalog(full_catalog(spark, folder), "nation_1;|machin|00-0007").select(
        "cube_id", "cubeTitleEn"
    )


@query(
    "cube_info",
    with_tables(
        ["catalog"],
        """SELECT "cubeTitleFr" AS "Titre du cube", "productId" AS "Product Id" FROM catalog""",
    ),
)
def cube_info(spark, folder):
    return C.cube_info(catalog(spark, folder), "fra")


@query(
    "survey_list",
    with_tables(["catalog"], """SELECT "surveyCode" AS "Survey Code" FROM catalog"""),
)
def survey_list(spark, folder):
    return C.cube_surveys(catalog(spark, folder))


@query(
    "subject_explode",
    with_tables(
        ["catalog"],
        """SELECT unnest(string_split("surveyCode", ', ')) AS "Subject Code" FROM catalog""",
    ),
)
def subject_explode(spark, folder):
    lists = catalog(spark, folder).select(F.col("surveyCode").alias("subjectCode"))
    return C.cube_subjects(lists)


# Documents serve as notes: their source is the member they are linked to.
def notes(spark, folder):
    return table(spark, folder, "documents").select(
        text(F.col("doc_id")).alias("footnoteId"),
        F.col("text").alias("footnotesEn"),
        F.upper("lang").alias("footnotesFr"),
        F.lit("1").alias("dimensionPositionId"),
        F.substring("source", 4, 10).alias("memberId"),
    )


def source_members(spark, folder):
    return (
        table(spark, folder, "documents")
        .filter(F.col("source") != "src7")
        .select(
            F.lit(1).alias("dim_id"),
            F.lit("Source").alias("dim_name"),
            F.substring("source", 4, 10).alias("member_id"),
            F.upper("source").alias("member_name"),
        )
        .distinct()
    )


@query(
    "short_notes",
    """SELECT DISTINCT doc_id::VARCHAR AS "Note ID", text AS "Note" FROM documents""",
)
def short_notes(spark, folder):
    return C.short_notes(notes(spark, folder))


@query(
    "notes_members",
    """SELECT doc_id::VARCHAR AS "Note ID", text AS "Note",
              CASE WHEN source <> 'src7' THEN 'Source' END AS "Dimension name",
              CASE WHEN source <> 'src7' THEN upper(source) END AS "Member Name"
       FROM documents""",
)
def notes_members(spark, folder):
    return C.notes_with_members(notes(spark, folder), source_members(spark, folder))


@query(
    "notes_full",
    """WITH refs AS (
         SELECT 'Language ' || lang AS d, NULL::VARCHAR AS m, min(doc_id)::VARCHAR AS id FROM documents GROUP BY lang
         UNION ALL SELECT 'Label', 'Label ' || doc_id::VARCHAR, doc_id::VARCHAR FROM labels
         UNION ALL SELECT 'Label', 'Label ' || doc_id::VARCHAR, (doc_id + 100000000)::VARCHAR FROM labels)
       SELECT d AS "Dimension name", m AS "Member Name", coalesce(id, doc_id::VARCHAR) AS "Note ID", text AS "Note"
       FROM refs FULL JOIN documents ON doc_id::VARCHAR = id""",
)
def notes_full(spark, folder):
    documents = table(spark, folder, "documents")
    dimensions = documents.groupBy("lang").agg(text(F.min("doc_id")).alias("note_ids")).select(
        F.concat(F.lit("Language "), "lang").alias("dim_name"), "note_ids"
    )
    doc = F.col("doc_id")
    members = table(spark, folder, "labels").select(
        F.lit("Label").alias("dim_name"),
        F.concat(F.lit("Label "), text(doc)).alias("member_name"),
        F.concat_ws(";", text(doc), text(doc + 100000000)).alias("note_ids"),
    )
    texts = documents.select(F.col("doc_id").alias("note_id"), F.col("text").alias("note"))
    return C.notes_by_reference(dimensions, members, texts)


@query(
    "legacy_ids",
    f"""SELECT l_orderkey, l_linenumber, {cube_of_sql('s_suppkey * 3')} AS cube_id FROM lineitem
        JOIN supplier ON l_suppkey = s_suppkey AND s_nationkey <> 3""",
)
def legacy_ids(spark, folder):
    correspondence = (
        table(spark, folder, "supplier")
        .filter("s_nationkey <> 3")
        .select(
            F.col("s_suppkey").alias("legacy_id"), (F.lit(10000000) + F.col("s_suppkey") * 3).alias("product_id")
        )
    )
    padded = F.lpad(text(F.col("l_suppkey")), 7, "0")
    facts = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat_ws("-", F.substring(padded, 1, 3), F.substring(padded, 4, 4)).alias("legacy"),
    )
    matched, _ = C.map_legacy_ids(facts, correspondence, "legacy")
    return matched.drop("legacy")


@query(
    "legacy_unmatched",
    """SELECT l_orderkey, l_linenumber FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey = 3""",
)
def legacy_unmatched(spark, folder):
    correspondence = (
        table(spark, folder, "supplier")
        .filter("s_nationkey <> 3")
        .select(F.col("s_suppkey").alias("legacy_id"), (F.lit(10000000) + F.col("s_suppkey")).alias("product_id"))
    )
    facts = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return C.map_legacy_ids(facts, correspondence, "l_suppkey")[1].drop("l_suppkey")


@query(
    "last_release",
    with_tables(
        ["releases", "catalog"],
        """SELECT c.cube_id, epoch_us(max(r."releaseTime")) AS last_release FROM catalog c
           LEFT JOIN releases r ON r.cube_id = c.cube_id GROUP BY 1""",
    ),
)
def last_release(spark, folder):
    latest = C.last_release(releases(spark, folder), catalog(spark, folder))
    return latest.select("cube_id", micros(F.col("last_release")).alias("last_release"))


def micros(c):
    """Microseconds of a wall-clock time, whatever the session zone."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", origin, c.cast("timestamp_ntz"))


@query(
    "changed_cubes",
    with_tables(
        ["releases"],
        """SELECT cube_id, event_type, value FROM releases
           WHERE "releaseTime"::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-21' """,
    ),
)
def changed_cubes(spark, folder):
    now = datetime(2024, 1, 21, 20, 0, tzinfo=timezone.utc)
    changed = C.changed_cubes(releases(spark, folder), date(2024, 1, 5), date(2024, 2, 9), now)
    return changed.select("cube_id", "event_type", "value")


def _registry(spark, folder):
    """Cubes as stored at their first click."""
    return (
        releases(spark, folder)
        .filter("event_type = 'click'")
        .groupBy("cube_id")
        .agg(F.min("releaseTime").alias("time_cached"))
    )


_REGISTRY = """SELECT cube_id, min("releaseTime") AS time_cached FROM releases
               WHERE event_type = 'click' GROUP BY 1"""


@query(
    "stale_cubes",
    with_tables(
        ["releases"],
        f"""SELECT cube_id, epoch_us(time_cached) AS time_cached, epoch_us(last) AS last_release
            FROM ({_REGISTRY}) JOIN (SELECT cube_id, max("releaseTime") AS last FROM releases GROUP BY 1) USING (cube_id)
            WHERE time_cached < last""",
    ),
)
def stale(spark, folder):
    found = stale_cubes(_registry(spark, folder), C.last_release(releases(spark, folder)))
    return found.select(
        "cube_id",
        micros(F.col("time_cached")).alias("time_cached"),
        micros(F.col("last_release")).alias("last_release"),
    )


@query(
    "freshness",
    with_tables(
        ["releases"],
        f"""SELECT cube_id, epoch_us(time_cached) AS time_cached, t < time_cached AS up_to_date
            FROM ({_REGISTRY}) LEFT JOIN (SELECT cube_id, max("releaseTime") AS t FROM releases
              WHERE event_type = 'error' GROUP BY 1) USING (cube_id)""",
    ),
)
def freshness(spark, folder):
    listed = (
        releases(spark, folder)
        .filter("event_type = 'error'")
        .groupBy("cube_id")
        .agg(F.max("releaseTime").alias("releaseTime"))
    )
    result = with_freshness(_registry(spark, folder), listed)
    return result.select("cube_id", micros(F.col("time_cached")).alias("time_cached"), "up_to_date")


@query(
    "places",
    with_tables(
        ["orders_members"],
        """SELECT member_id, regexp_replace(place, ', .+', '') AS name FROM (SELECT member_id,
             member_name || CASE WHEN parent_id IS NULL THEN '' ELSE ', part of ' || parent_id END AS place
             FROM orders_members)""",
    ),
)
def places(spark, folder):
    part_of = F.when(F.col("parent_id").isNull(), "").otherwise(F.concat(F.lit(", part of "), "parent_id"))
    return orders_members(spark, folder).select(
        "member_id", X.place_name(F.concat("member_name", part_of)).alias("name")
    )
