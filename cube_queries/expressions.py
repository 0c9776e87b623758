"""Scalar rules over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cube_queries.cubes import orders_facts, orders_members, table, text
from cube_queries.registry import query, with_tables
from statcube.functions import expressions as X


@query(
    "scale_values",
    with_tables(
        ["orders_facts"],
        """SELECT "VECTOR", "REF_DATE", "VALUE" * pow(10.0::DOUBLE, "SCALAR_ID"::INT) AS val_norm FROM orders_facts""",
    ),
)
def scale_values(spark, folder):
    return orders_facts(spark, folder).select(
        "VECTOR", "REF_DATE", X.scaled(F.col("VALUE"), F.col("SCALAR_ID")).alias("val_norm")
    )


@query(
    "percent_to_rate",
    with_tables(
        ["orders_facts"],
        """SELECT "VECTOR", "REF_DATE", "UOM",
                  CASE WHEN regexp_matches("UOM", '^Percent') THEN "VALUE" / 100.0::DOUBLE ELSE "VALUE" END AS rate
           FROM orders_facts""",
    ),
)
def percent_to_rate(spark, folder):
    return orders_facts(spark, folder).select(
        "VECTOR", "REF_DATE", "UOM", X.percent_to_rate(F.col("VALUE"), F.col("UOM")).alias("rate")
    )


@query(
    "parse_ref_date",
    """WITH shaped AS (
         SELECT o_orderkey, o_orderdate AS d, CASE substr(o_orderpriority, 1, 1)
           WHEN '1' THEN strftime(o_orderdate, '%Y')
           WHEN '2' THEN strftime(o_orderdate, '%Y') || '/' || (year(o_orderdate) + 1)::VARCHAR
           WHEN '3' THEN strftime(o_orderdate, '%Y-%m')
           WHEN '4' THEN strftime(o_orderdate, '%Y-%m-%d')
           ELSE 'Q' || quarter(o_orderdate)::VARCHAR || ' ' || strftime(o_orderdate, '%Y') END AS ref_date,
           substr(o_orderpriority, 1, 1) AS shape FROM orders)
       SELECT o_orderkey, ref_date, CASE shape
           WHEN '1' THEN make_date(year(d), 7, 1) WHEN '2' THEN make_date(year(d) + 1, 7, 1)
           WHEN '3' THEN make_date(year(d), month(d), 1) WHEN '4' THEN d::DATE END AS "Date"
       FROM shaped""",
)
def parse_ref_date(spark, folder):
    year = F.date_format("o_orderdate", "yyyy")
    shape = F.substring("o_orderpriority", 1, 1)
    ref = (
        F.when(shape == "1", year)
        .when(shape == "2", F.concat(year, F.lit("/"), text(F.year("o_orderdate") + 1)))
        .when(shape == "3", F.date_format("o_orderdate", "yyyy-MM"))
        .when(shape == "4", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("Q"), text(F.quarter("o_orderdate")), F.lit(" "), year))
    )
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", ref.alias("ref_date"))
        .withColumn("Date", X.reference_date(F.col("ref_date")))
    )


_LINE_SQL = """SELECT l_orderkey::VARCHAR || '.' || (l_linenumber * 10)::VARCHAR || '.' || l_suppkey::VARCHAR
                 || CASE l_returnflag WHEN 'A' THEN '.0.0' WHEN 'N' THEN '.0' ELSE '' END AS c FROM lineitem"""


def _line_coordinates(spark, folder):
    zeros = F.when(F.col("l_returnflag") == "A", ".0.0").when(F.col("l_returnflag") == "N", ".0").otherwise("")
    body = F.concat_ws(
        ".", text(F.col("l_orderkey")), text(F.col("l_linenumber") * 10), text(F.col("l_suppkey"))
    )
    return table(spark, folder, "lineitem").select(F.concat(body, zeros).alias("c"))


@query(
    "coord_pick",
    f"""SELECT c, split_part(c, '.', 2) AS second, nullif(split_part(c, '.', 5), '') AS fifth FROM ({_LINE_SQL})""",
)
def coord_pick(spark, folder):
    return _line_coordinates(spark, folder).select(
        "c", X.coordinate_part(F.col("c"), 2).alias("second"), X.coordinate_part(F.col("c"), 5).alias("fifth")
    )


@query(
    "coord_pad",
    f"""SELECT c, c || repeat('.0', 10 - len(string_split(c, '.'))::INT) AS padded FROM ({_LINE_SQL})""",
)
def coord_pad(spark, folder):
    return _line_coordinates(spark, folder).select("c", X.pad_coordinate(F.col("c")).alias("padded"))


@query(
    "coord_strip",
    f"""SELECT c, regexp_replace(c, '(\\.0)+$', '') AS stripped FROM ({_LINE_SQL})""",
)
def coord_strip(spark, folder):
    return _line_coordinates(spark, folder).select("c", X.strip_coordinate(F.col("c")).alias("stripped"))


_ID_SQL = """SELECT c_custkey, CASE c_mktsegment
      WHEN 'BUILDING' THEN d || '02' WHEN 'FURNITURE' THEN d || '01' WHEN 'MACHINERY' THEN d
      ELSE substr(d, 1, 2) || '-' || substr(d, 3, 2) || '-' || substr(d, 5, 4) END AS raw_id
    FROM (SELECT *, (98100000 + c_custkey)::VARCHAR AS d FROM customer)"""


@query(
    "clean_cube_id",
    f"""SELECT c_custkey, raw_id,
          substr(b, 1, 2) || '-' || substr(b, 3, 2) || '-' || substr(b, 5, 4) AS cube_id, b AS bare_id,
          length(b) = 10 AND substr(b, 9, 2) <> '01' AS is_derived, b LIKE '9810%' AS is_census,
          length(b) <= 7 AS is_legacy
        FROM (SELECT *, replace(raw_id, '-', '') AS b FROM ({_ID_SQL}))""",
)
def clean_cube_id(spark, folder):
    digits = text(F.lit(98100000) + F.col("c_custkey"))
    dashed = F.concat_ws("-", F.substring(digits, 1, 2), F.substring(digits, 3, 2), F.substring(digits, 5, 4))
    segment = F.col("c_mktsegment")
    raw = (
        F.when(segment == "BUILDING", F.concat(digits, F.lit("02")))
        .when(segment == "FURNITURE", F.concat(digits, F.lit("01")))
        .when(segment == "MACHINERY", digits)
        .otherwise(dashed)
    )
    c = F.col("raw_id")
    return table(spark, folder, "customer").select("c_custkey", raw.alias("raw_id")).select(
        "c_custkey",
        "raw_id",
        X.clean_cube_id(c).alias("cube_id"),
        X.bare_cube_id(c).alias("bare_id"),
        X.is_derived_id(c).alias("is_derived"),
        X.is_census_cube(c).alias("is_census"),
        X.is_legacy_id(c).alias("is_legacy"),
    )


@query(
    "geo_uid",
    with_tables(
        ["orders_facts", "orders_members"],
        """SELECT DISTINCT "GEO", "DGUID", substr("DGUID", 10) AS "GeoUID",
                  replace(replace(code, '[', ''), ']', '') AS code_uid
           FROM orders_facts JOIN orders_members ON member_name = "GEO" AND dim_id = 1""",
    ),
)
def geo_uid(spark, folder):
    places = orders_facts(spark, folder).select("GEO", "DGUID").distinct()
    codes = orders_members(spark, folder).filter("dim_id = 1").select(F.col("member_name").alias("GEO"), "code")
    return places.join(codes, "GEO").select(
        "GEO",
        "DGUID",
        X.geo_uid_from_dguid(F.col("DGUID")).alias("GeoUID"),
        X.without_brackets(F.col("code")).alias("code_uid"),
    )


@query(
    "strip_code",
    with_tables(
        ["orders_facts"],
        """SELECT "VECTOR", "REF_DATE", "Priority", regexp_replace("Priority", ' \\[.+\\]$', '') AS plain
           FROM orders_facts""",
    ),
)
def strip_code(spark, folder):
    return orders_facts(spark, folder).select(
        "VECTOR", "REF_DATE", "Priority", X.strip_code(F.col("Priority")).alias("plain")
    )


@query(
    "path_depth",
    """SELECT l_orderkey, l_linenumber, path, len(string_split(path, '.')) - 1 AS depth,
              list_extract(string_split(path, '.'), -1) AS leaf
       FROM (SELECT l_orderkey, l_linenumber, CASE l_returnflag
               WHEN 'A' THEN l_suppkey::VARCHAR WHEN 'N' THEN l_suppkey::VARCHAR || '.' || l_partkey::VARCHAR
               ELSE l_suppkey::VARCHAR || '.' || l_partkey::VARCHAR || '.' || l_linenumber::VARCHAR END AS path
             FROM lineitem)""",
)
def path_depth(spark, folder):
    supp, part_, line = (text(F.col(c)) for c in ("l_suppkey", "l_partkey", "l_linenumber"))
    flag = F.col("l_returnflag")
    path = (
        F.when(flag == "A", supp)
        .when(flag == "N", F.concat_ws(".", supp, part_))
        .otherwise(F.concat_ws(".", supp, part_, line))
    )
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", path.alias("path")).select(
        "*",
        X.path_depth(F.col("path")).cast("bigint").alias("depth"),
        X.path_leaf(F.col("path")).alias("leaf"),
    )


@query(
    "null_tokens",
    """SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('<NA>', 'NA', '', 'F') THEN o_orderstatus END AS status,
              CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price
       FROM orders""",
)
def null_tokens(spark, folder):
    raw = F.when(F.col("o_orderstatus") == "P", "..").otherwise(text(F.col("o_totalprice")))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        X.null_if_missing(F.col("o_orderstatus")).alias("status"),
        X.to_number(raw).alias("price"),
    )


@query(
    "release_times",
    """SELECT event_id, epoch(timezone('America/Toronto', date_trunc('minute', ts)))::BIGINT AS released FROM events""",
)
def release_times(spark, folder):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    return table(spark, folder, "events").select(
        "event_id", F.unix_seconds(X.release_instant(stamp)).alias("released")
    )


@query(
    "readable_sizes",
    """WITH s AS (SELECT doc_id, n_chars * n_chars AS b FROM documents),
       u AS (SELECT *, CASE WHEN b < 1024 THEN b::DOUBLE WHEN b < 1048576 THEN round(b / 1024.0::DOUBLE, 1)
             WHEN b < 1073741824 THEN round(b / 1048576.0::DOUBLE, 1) ELSE round(b / 1073741824.0::DOUBLE, 1) END AS x,
             CASE WHEN b < 1024 THEN ' bytes' WHEN b < 1048576 THEN ' Kb' WHEN b < 1073741824 THEN ' Mb' ELSE ' Gb' END AS unit FROM s)
       SELECT doc_id, b, CASE WHEN x = floor(x) THEN x::BIGINT::VARCHAR ELSE x::VARCHAR END || unit AS size FROM u""",
)
def readable_sizes(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", (F.col("n_chars") * F.col("n_chars")).alias("b"))
    return docs.withColumn("size", X.readable_size(F.col("b")))


@query(
    "language_codes",
    """SELECT doc_id, CASE lang WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fra' END AS language FROM documents""",
)
def language_codes(spark, folder):
    return table(spark, folder, "documents").select("doc_id", X.language_column(F.col("lang")).alias("language"))


@query(
    "vector_names",
    """SELECT p_partkey, CASE WHEN p_partkey <> 0 THEN 'v' || p_partkey::VARCHAR END AS vector,
              CASE p_size % 10 WHEN 0 THEN 'Success' WHEN 1 THEN 'Invalid date'
                WHEN 2 THEN 'Invalid cube and series combination' WHEN 3 THEN 'Request failed'
                WHEN 4 THEN 'Vector is invalid' WHEN 5 THEN 'Cube product id is invalid'
                WHEN 6 THEN 'Cube is currently being published. Please try again later.'
                WHEN 7 THEN 'Cube is currently unavailable.'
                WHEN 8 THEN 'Invalid number of reference periods' END AS response
       FROM part""",
)
def vector_names(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        X.vector_name(F.col("p_partkey")).alias("vector"),
        X.response_text(F.col("p_size") % 10).alias("response"),
    )


@query(
    "regex_negated",
    """SELECT doc_id, source FROM documents LEFT JOIN labels USING (doc_id)
       WHERE NOT coalesce(regexp_matches(quality::VARCHAR, '^1'), false)""",
)
def regex_negated(spark, folder):
    joined = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return joined.filter(X.not_matching(text(F.col("quality")), "^1")).select("doc_id", "source")


@query(
    "quote_cleanup",
    """SELECT doc_id, replace(replace(q, '“', '"'), '”', '"') AS cleaned, rtrim(source || '  ') AS trimmed
       FROM (SELECT doc_id, source, '“' || text || '”' AS q FROM documents)""",
)
def quote_cleanup(spark, folder):
    quoted = F.concat(F.lit("“"), F.col("text"), F.lit("”"))
    return table(spark, folder, "documents").select(
        "doc_id",
        X.straight_quotes(quoted).alias("cleaned"),
        F.rtrim(F.concat("source", F.lit("  "))).alias("trimmed"),
    )
