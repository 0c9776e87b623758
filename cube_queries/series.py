"""Selection of series and templates."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Window
from pyspark.sql import functions as F

from cube_queries.cubes import ORDERS_CUBE, orders_facts, orders_members, releases, table, text
from cube_queries.catalog import micros
from cube_queries.registry import query, with_tables
from statcube.functions import expressions as X
from statcube.functions.names import CUBE_ID, rename_language
from statcube.operators import series as S
from statcube.plans.pipelines import latest_series, series_by_coordinate, series_by_vector

_LABELS = {"Urgent in nation 0": "v1007012", "Low in nation 1": "1008052"}


def observations(spark, folder):
    """Facts of the orders cube without names, as the data service returns them."""
    return orders_facts(spark, folder).select(
        F.lit(ORDERS_CUBE).alias(CUBE_ID),
        "REF_DATE",
        "VALUE",
        F.col("SCALAR_ID").cast("int").alias("SCALAR_ID"),
        "VECTOR",
        X.pad_coordinate(F.col("COORDINATE")).alias("COORDINATE"),
    )


_FINISHED = f"""SELECT '{ORDERS_CUBE}' AS cube_id, "REF_DATE", ("REF_DATE" || '-01')::DATE AS "Date", "GEO",
     regexp_replace("Priority", ' \\[.+\\]$', '') AS "Priority", "Statistic", "VALUE",
     "VALUE" * pow(10.0::DOUBLE, "SCALAR_ID"::INT) AS val_norm, "SCALAR_ID"::INT AS "SCALAR_ID", "VECTOR",
     "COORDINATE", split_part("COORDINATE", '.', 1)::INT AS "GEO__ord",
     split_part("COORDINATE", '.', 2)::INT AS "Priority__ord", split_part("COORDINATE", '.', 3)::INT AS "Statistic__ord" """


@query(
    "select_vectors",
    with_tables(
        ["orders_facts"],
        _FINISHED
        + """, CASE "VECTOR" WHEN 'v1007012' THEN 'Urgent in nation 0' ELSE 'Low in nation 1' END AS label
             FROM orders_facts WHERE "VECTOR" IN ('v1007012', 'v1008052')
               AND "REF_DATE" BETWEEN '1996-05' AND '1999-08' """,
    ),
)
def select_vectors(spark, folder):
    return series_by_vector(
        observations(spark, folder), orders_members(spark, folder), _LABELS, "1996-05-01", "1999-08-01"
    )


@query(
    "label_series",
    with_tables(
        ["orders_facts"],
        """SELECT "VECTOR", "REF_DATE", CASE "VECTOR" WHEN 'v1007012' THEN 'Urgent in nation 0'
             WHEN 'v1008052' THEN 'Low in nation 1' ELSE "VECTOR" END AS label FROM orders_facts""",
    ),
)
def label_series(spark, folder):
    facts = orders_facts(spark, folder).select("VECTOR", "REF_DATE")
    return S.label_series(facts, _LABELS)


@query(
    "series_range",
    with_tables(
        ["orders_facts"],
        """SELECT "VECTOR", "REF_DATE", "VALUE" FROM orders_facts
           WHERE ("REF_DATE" || '-01')::DATE BETWEEN DATE '1996-03-01' AND DATE '1998-11-15' """,
    ),
)
def series_range(spark, folder):
    facts = orders_facts(spark, folder).select("VECTOR", "REF_DATE", "VALUE")
    return S.series_range(facts, "1996-03-01", "1998-11-15")


@query(
    "release_range",
    with_tables(
        ["releases"],
        """SELECT cube_id, event_type, value FROM releases
           WHERE "releaseTime" BETWEEN TIMESTAMP '2024-01-03 08:30:00' AND TIMESTAMP '2024-01-19 17:00:00' """,
    ),
)
def release_range(spark, folder):
    log = releases(spark, folder)
    chosen = S.release_range(log, datetime(2024, 1, 3, 8, 30), datetime(2024, 1, 19, 17, 0))
    return chosen.select(CUBE_ID, "event_type", "value")


@query(
    "latest_n",
    with_tables(
        ["orders_facts"],
        """SELECT "VECTOR", "REF_DATE", "VALUE" FROM orders_facts
           QUALIFY row_number() OVER (PARTITION BY "VECTOR" ORDER BY "REF_DATE" DESC) <= 12""",
    ),
)
def latest_n(spark, folder):
    return S.latest_n(orders_facts(spark, folder).select("VECTOR", "REF_DATE", "VALUE"), 12)


@query(
    "latest_n_large",
    with_tables(
        ["releases"],
        """SELECT cube_id, epoch_us("releaseTime") AS released, value FROM releases
           QUALIFY row_number() OVER (PARTITION BY cube_id ORDER BY "releaseTime" DESC) <= 5000""",
    ),
)
def latest_n_large(spark, folder):
    """Beyond the per-task limit the series are cut into pieces first."""
    log = releases(spark, folder).withColumnRenamed("value", "VALUE")
    newest = S.latest_n(log, 5000, [CUBE_ID], "releaseTime")
    return newest.select(
        CUBE_ID,
        micros(F.col("releaseTime")).alias("released"),
        F.col("VALUE").alias("value"),
    )


@query(
    "latest_n_per_series",
    with_tables(
        ["orders_facts"],
        """SELECT "COORDINATE", "REF_DATE", "VALUE" FROM orders_facts
           QUALIFY row_number() OVER (PARTITION BY "COORDINATE" ORDER BY "REF_DATE" DESC)
             <= 2 * split_part("COORDINATE", '.', 2)::INT""",
    ),
)
def latest_n_per_series(spark, folder):
    facts = observations(spark, folder)
    requests = (
        facts.select(CUBE_ID, "COORDINATE")
        .distinct()
        .withColumn("periods", X.coordinate_part(F.col("COORDINATE"), 2).cast("int") * 2)
    )
    chosen = S.select_coordinates(facts, requests)
    return chosen.select(X.strip_coordinate(F.col("COORDINATE")).alias("COORDINATE"), "REF_DATE", "VALUE")


@query(
    "latest_vectors",
    with_tables(
        ["orders_facts"],
        _FINISHED
        + """FROM orders_facts
             QUALIFY row_number() OVER (PARTITION BY "VECTOR" ORDER BY "REF_DATE" DESC) <= 3""",
    ),
)
def latest_vectors(spark, folder):
    facts = observations(spark, folder)
    every = facts.select("VECTOR").distinct()
    return latest_series(facts, orders_members(spark, folder), every, 3)


@query(
    "series_french",
    with_tables(
        ["orders_facts"],
        f"""SELECT '{ORDERS_CUBE}' AS cube_id, "REF_DATE" AS "PÉRIODE DE RÉFÉRENCE", "VALUE" AS "VALEUR",
                   "SCALAR_ID"::INT AS "IDENTIFICATEUR SCALAIRE", "VECTOR", "COORDINATE" AS "COORDONNÉES"
            FROM orders_facts""",
    ),
)
def series_french(spark, folder):
    facts = observations(spark, folder).withColumn("COORDINATE", X.strip_coordinate(F.col("COORDINATE")))
    return rename_language(facts, "eng", "fra")


@query(
    "coordinates_answered",
    with_tables(
        ["orders_facts"],
        _FINISHED
        + """FROM orders_facts WHERE "COORDINATE" IN ('7.1.1', '8.2.3', '9.10')
             QUALIFY row_number() OVER (PARTITION BY "COORDINATE" ORDER BY "REF_DATE" DESC) <= 5""",
    ),
)
def coordinates_answered(spark, folder):
    requests = {ORDERS_CUBE: ["7.1.1", "8.2.3.0.0", "9.10"]}
    return series_by_coordinate(
        observations(spark, folder), orders_members(spark, folder), requests, 5
    )[0]


_TEMPLATE = f"""SELECT '{ORDERS_CUBE}' AS cube_id, g.member_id || '.' || p.member_id || '.' || s.member_id AS "COORDINATE",
       g.member_name AS "Geography", p.member_name AS "Priority", s.member_name AS "Statistic"
     FROM (SELECT * FROM orders_members WHERE dim_id = 1) g, (SELECT * FROM orders_members WHERE dim_id = 2) p,
          (SELECT * FROM orders_members WHERE dim_id = 3) s"""


@query("template", with_tables(["orders_members"], _TEMPLATE))
def template(spark, folder):
    return S.cube_template(orders_members(spark, folder), ORDERS_CUBE)


@query(
    "template_filtered",
    with_tables(
        ["orders_members"],
        _TEMPLATE + """ WHERE g.parent_id <> '1' AND s.member_name IN ('Orders', 'Value') """,
    ),
)
def template_filtered(spark, folder):
    keep = {
        "Geography": F.coalesce(F.col("parent_id") != "1", F.lit(False)),
        "Statistic": ["Orders", "Value"],
    }
    return S.cube_template(orders_members(spark, folder), ORDERS_CUBE, keep=keep)


@query(
    "attach_series",
    with_tables(
        ["orders_members", "orders_facts"],
        f"""SELECT t.*, f."VECTOR" FROM ({_TEMPLATE}) t
            LEFT JOIN (SELECT DISTINCT "COORDINATE", "VECTOR" FROM orders_facts) f USING ("COORDINATE")""",
    ),
)
def attach_series(spark, folder):
    info = observations(spark, folder).select(CUBE_ID, "COORDINATE", "VECTOR").distinct()
    return S.attach_series(S.cube_template(orders_members(spark, folder), ORDERS_CUBE), info)


_PADDED = """"COORDINATE" || '.0.0.0.0.0.0.0' AS "COORDINATE" """


@query(
    "missing_series",
    with_tables(
        ["orders_members", "orders_facts"],
        f"""SELECT cube_id, {_PADDED}, false AS is_census, NULL::DOUBLE AS implied_value FROM ({_TEMPLATE}) t
            WHERE NOT EXISTS (SELECT 1 FROM orders_facts f WHERE f."COORDINATE" = t."COORDINATE")""",
    ),
)
def missing_series(spark, folder):
    wanted = S.cube_template(orders_members(spark, folder), ORDERS_CUBE)
    return S.missing_series(observations(spark, folder), wanted)


@query(
    "missing_census_series",
    """SELECT '98-10-0002' AS cube_id, s.s_suppkey::VARCHAR || '.' || f.flag || '.0.0.0.0.0.0.0.0' AS "COORDINATE",
              true AS is_census, 0.0::DOUBLE AS implied_value
       FROM supplier s, (SELECT DISTINCT l_linenumber::VARCHAR AS flag FROM lineitem) f
       WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_suppkey = s.s_suppkey
           AND l.l_linenumber::VARCHAR = f.flag AND l.l_returnflag = 'R' AND l.l_discount = 0.1)""",
)
def missing_census_series(spark, folder):
    """Suppliers and line numbers without a return at the highest discount."""
    cube = F.lit("98-10-0002").alias(CUBE_ID)
    lineitem = table(spark, folder, "lineitem")
    members = (
        table(spark, folder, "supplier")
        .select(cube, F.lit(1).alias("dim_id"), F.lit("Supplier").alias("dim_name"),
                text(F.col("s_suppkey")).alias("member_id"), F.col("s_name").alias("member_name"))
        .unionByName(
            lineitem.select("l_linenumber").distinct()
            .select(cube, F.lit(2).alias("dim_id"), F.lit("Line").alias("dim_name"),
                    text(F.col("l_linenumber")).alias("member_id"), text(F.col("l_linenumber")).alias("member_name"))
        )
    )
    found = lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_discount") == 0.1)).select(
        cube, F.concat_ws(".", text(F.col("l_suppkey")), text(F.col("l_linenumber"))).alias("COORDINATE")
    )
    return S.missing_series(found, S.cube_template(members, "98-10-0002"))


@query(
    "batch_ids",
    """WITH r AS (SELECT DISTINCT l_suppkey::VARCHAR AS cube_id,
                    l_partkey::VARCHAR || '.' || l_linenumber::VARCHAR AS "COORDINATE" FROM lineitem)
       SELECT *, ceil(row_number() OVER (PARTITION BY cube_id ORDER BY "COORDINATE") / 300.0)::BIGINT AS batch FROM r""",
)
def batch_ids(spark, folder):
    requests = (
        table(spark, folder, "lineitem")
        .select(
            text(F.col("l_suppkey")).alias(CUBE_ID),
            F.concat_ws(".", text(F.col("l_partkey")), text(F.col("l_linenumber"))).alias("COORDINATE"),
        )
        .distinct()
    )
    return S.batch_ids(requests)


@query(
    "series_info",
    with_tables(
        ["orders_facts"],
        """SELECT DISTINCT "COORDINATE", "VECTOR" FROM orders_facts WHERE "COORDINATE" LIKE '%.1.%' """,
    ),
)
def series_info(spark, folder):
    """Series of requested coordinates; other answers are marked as invalid combinations."""
    facts = observations(spark, folder)
    info = facts.select(
        F.lit("14100001").alias("productId"),
        F.col("COORDINATE").alias("coordinate"),
        "VECTOR",
        F.when(X.coordinate_part(F.col("COORDINATE"), 2) == "1", 0).otherwise(2).alias("responseStatusCode"),
    ).distinct()
    wanted = facts.select("COORDINATE").distinct()
    chosen = S.select_series_info(info, ORDERS_CUBE, wanted)
    return chosen.select(X.strip_coordinate(F.col("coordinate")).alias("COORDINATE"), "VECTOR")


@query(
    "mixed_requests",
    with_tables(
        ["orders_facts"],
        """SELECT "COORDINATE", "REF_DATE", "VALUE" FROM (
             SELECT *, split_part("COORDINATE", '.', 2)::INT AS kind FROM orders_facts)
           QUALIFY kind = 2 OR row_number() OVER (PARTITION BY "COORDINATE" ORDER BY "REF_DATE" DESC) <= 3""",
    ),
)
def mixed_requests(spark, folder):
    """All rows of some series and the last three periods of the others, in one request."""
    facts = observations(spark, folder)
    kind = X.coordinate_part(F.col("COORDINATE"), 2).cast("int")
    requests = facts.select(CUBE_ID, "COORDINATE").distinct().withColumn("periods", F.when(kind != 2, F.lit(3)))
    chosen = S.select_coordinates(facts, requests)
    return chosen.select(X.strip_coordinate(F.col("COORDINATE")).alias("COORDINATE"), "REF_DATE", "VALUE")


@query(
    "release_from",
    with_tables(
        ["releases"],
        """SELECT cube_id, event_type, value FROM releases
           WHERE date_trunc('minute', "releaseTime") >= TIMESTAMP '2024-01-10 12:00:00' """,
    ),
)
def release_from(spark, folder):
    """One bound only, on release times as the service gives them: text in the publisher's wall-clock time."""
    log = releases(spark, folder).withColumn("releaseTime", F.date_format("releaseTime", "yyyy-MM-dd'T'HH:mm"))
    start = datetime(2024, 1, 10, 12, 0, tzinfo=ZoneInfo(X.PUBLISHER_ZONE))
    return S.release_range(log, start).select(CUBE_ID, "event_type", "value")


@query(
    "undated_periods",
    """SELECT count(*)::BIGINT AS undated FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 7 = 0)""",
)
def undated_periods(spark, folder):
    """Periods of an unknown shape, which no range holds."""
    orders = table(spark, folder, "orders").select(
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("Q1 1997")).otherwise(F.lit("1997")).alias("REF_DATE")
    )
    return S.undated_periods(orders).agg(F.count(F.lit(1)).alias("undated"))


@query(
    "sort_requests",
    with_tables(
        ["orders_facts"],
        f"""SELECT '{ORDERS_CUBE}' AS cube_id, "COORDINATE", row_number() OVER (ORDER BY "COORDINATE") AS place
            FROM (SELECT DISTINCT "COORDINATE" FROM orders_facts)""",
    ),
)
def sort_requests(spark, folder):
    """Requests in their order, with the place of each."""
    wanted = observations(spark, folder).select(CUBE_ID, X.strip_coordinate(F.col("COORDINATE")).alias("COORDINATE"))
    ordered = S.sort_requests(wanted.distinct())
    return ordered.select("*", F.row_number().over(Window.partitionBy(CUBE_ID).orderBy("COORDINATE")).cast("bigint").alias("place"))


@query(
    "coordinates_french",
    with_tables(
        ["orders_facts"],
        """SELECT "REF_DATE" AS "PÉRIODE DE RÉFÉRENCE", "VALUE" AS "VALEUR", "COORDINATE" AS "COORDONNÉES",
                  regexp_replace("Priority", ' \\[.+\\]$', '') AS "Priority", "Statistic" FROM orders_facts
           QUALIFY row_number() OVER (PARTITION BY "COORDINATE" ORDER BY "REF_DATE" DESC) <= 2""",
    ),
)
def coordinates_french(spark, folder):
    """The whole way of a request by coordinate, under French headings."""
    facts = observations(spark, folder)
    wanted = facts.select(CUBE_ID, "COORDINATE").distinct()
    found, _ = series_by_coordinate(facts, orders_members(spark, folder), wanted, 2, "fra")
    return found.select("PÉRIODE DE RÉFÉRENCE", "VALEUR", "COORDONNÉES", "Priority", "Statistic")
