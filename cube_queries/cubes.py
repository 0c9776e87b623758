"""Cubes derived from the given tables, as frames and as the same tables in SQL.

orders cube     long cube: geography x order priority x statistic by month
returns extract semi-wide extract: line status by month, one column per return flag
part cube       long cube: part tree (type, brand, part) x return flag by year
releases        event log read as releases of cubes
catalog         one published cube per customer
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statcube.operators.joins import lookup_join

ORDERS_CUBE = "14-10-0001"
PART_CUBE = "27-10-0003"
RETURNS_CUBE = "98-10-0002"

STATISTICS = (
    # id, name, unit, scalar factor, scalar id
    (1, "Orders", "Number", "units ", "0"),
    (2, "Value", "Dollars", "thousands", "3"),
    (3, "Share with status F", "Percent", "units ", "0"),
)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once per session."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def text(c: Column) -> Column:
    return c.cast("string")


# --- orders cube -------------------------------------------------------------------------------


def orders_cells(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy(
            "c_nationkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("ref_date")
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
            F.count_if(F.col("o_orderstatus") == "F").alias("n_f"),
        )
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
    )


def orders_facts(spark: SparkSession, folder: str) -> DataFrame:
    cells = orders_cells(spark, folder)
    values = {
        1: F.col("n").cast("double"),
        2: F.col("total").cast("double") / 1000.0,
        3: F.col("n_f").cast("double") * 100.0 / F.col("n").cast("double"),
    }
    statistics = F.array(
        *[
            F.struct(
                F.lit(i).alias("stat"),
                F.lit(name).alias("Statistic"),
                F.lit(uom).alias("UOM"),
                F.lit(factor).alias("SCALAR_FACTOR"),
                F.lit(scale).alias("SCALAR_ID"),
                values[i].alias("VALUE"),
            )
            for i, name, uom, factor, scale in STATISTICS
        ]
    )
    priority = F.substring("o_orderpriority", 1, 1)
    geo = F.col("n_nationkey") + 7
    return (
        cells.select(
            "ref_date",
            "n_name",
            "n_nationkey",
            geo.alias("geo"),
            priority.alias("prio"),
            F.substring("o_orderpriority", 3, 40).alias("prio_name"),
            F.inline(statistics),
        )
        .select(
            F.col("ref_date").alias("REF_DATE"),
            F.col("n_name").alias("GEO"),
            F.concat(F.lit("2016A0002"), F.lpad(text(F.col("n_nationkey")), 2, "0")).alias("DGUID"),
            F.concat("prio_name", F.lit(" [P"), "prio", F.lit("]")).alias("Priority"),
            "Statistic",
            "VALUE",
            "UOM",
            "SCALAR_FACTOR",
            "SCALAR_ID",
            F.concat(
                F.lit("v"),
                text(F.lit(1000000) + F.col("geo") * 1000 + F.col("prio").cast("int") * 10 + F.col("stat")),
            ).alias("VECTOR"),
            F.concat_ws(".", text(F.col("geo")), "prio", text(F.col("stat"))).alias("COORDINATE"),
            F.lit("2").alias("DECIMALS"),
        )
    )


def orders_members(spark: SparkSession, folder: str) -> DataFrame:
    region, nation = table(spark, folder, "region"), table(spark, folder, "nation")
    priorities = table(spark, folder, "orders").select("o_orderpriority").distinct()
    nothing = F.lit(None).cast("string")

    def rows(source: DataFrame, dim: int, name: str, member, label, parent, code) -> DataFrame:
        return source.select(
            F.lit(ORDERS_CUBE).alias("cube_id"),
            F.lit(dim).alias("dim_id"),
            F.lit(name).alias("dim_name"),
            text(member).alias("member_id"),
            label.alias("member_name"),
            text(parent).alias("parent_id"),
            code.alias("code"),
        )

    world = rows(
        spark.range(0, 1, 1, 1), 1, "Geography", F.lit(1), F.lit("World"), nothing, F.lit("[W]")
    )
    regions = rows(
        region, 1, "Geography", F.col("r_regionkey") + 2, F.col("r_name"), F.lit(1),
        F.concat(F.lit("[R"), text(F.col("r_regionkey")), F.lit("]")),
    )
    nations = rows(
        nation, 1, "Geography", F.col("n_nationkey") + 7, F.col("n_name"), F.col("n_regionkey") + 2,
        F.concat(F.lit("["), F.lpad(text(F.col("n_nationkey")), 2, "0"), F.lit("]")),
    )
    prio = F.substring("o_orderpriority", 1, 1)
    prios = rows(
        priorities, 2, "Priority", prio, F.substring("o_orderpriority", 3, 40), nothing,
        F.concat(F.lit("[P"), prio, F.lit("]")),
    )
    stats = rows(
        spark.range(0, 1, 1, 1).select(
            F.inline(F.array(*[F.struct(F.lit(i).alias("id"), F.lit(name).alias("name")) for i, name, *_ in STATISTICS]))
        ),
        3, "Statistic", F.col("id"), F.col("name"), nothing, nothing,
    )
    return world.unionByName(regions).unionByName(nations).unionByName(prios).unionByName(stats)


# --- returns extract ---------------------------------------------------------------------------

FLAGS = (("A", 1), ("N", 2), ("R", 3))


def returns_wide(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    cells = []
    for flag, i in FLAGS:
        here = F.col("l_returnflag") == flag
        cells.append(
            F.sum(F.when(here, F.col("l_quantity").cast("decimal(18,2)"))).cast("double")
            .alias(f"Return flag (3):{flag}[{i}]")
        )
        cells.append(F.when(F.count_if(here) < 5, F.lit("x")).alias(f"Symbol {i}"))
    return (
        lineitem.groupBy(
            F.date_format("l_shipdate", "yyyy-MM").alias("REF_DATE"),
            F.col("l_linestatus").alias("Line status"),
        )
        .agg(*cells)
        .withColumn("COORDINATE", F.when(F.col("Line status") == "F", "1").otherwise("2"))
        .select(
            "REF_DATE",
            "Line status",
            "COORDINATE",
            *[f"`{c}`" for flag, i in FLAGS for c in (f"Return flag (3):{flag}[{i}]", f"Symbol {i}")],
        )
    )


# --- part cube ---------------------------------------------------------------------------------


def part_members(spark: SparkSession, folder: str) -> DataFrame:
    """Type -> brand within type -> part; names repeat heavily."""
    part = table(spark, folder, "part")
    types = part.groupBy("p_type").agg((F.min("p_partkey") * 3 + 3).alias("type_id"))
    brands = part.groupBy("p_type", "p_brand").agg((F.min("p_partkey") * 3 + 2).alias("brand_id"))
    nothing = F.lit(None).cast("string")

    def rows(source: DataFrame, member, label, parent) -> DataFrame:
        return source.select(
            F.lit(PART_CUBE).alias("cube_id"),
            F.lit(1).alias("dim_id"),
            F.lit("Part").alias("dim_name"),
            text(member).alias("member_id"),
            label.alias("member_name"),
            text(parent).alias("parent_id"),
            nothing.alias("code"),
        )

    return (
        rows(types, F.col("type_id"), F.col("p_type"), nothing)
        .unionByName(
            rows(
                lookup_join(brands, types, ["p_type"]),
                F.col("brand_id"), F.col("p_brand"), F.col("type_id"),
            )
        )
        .unionByName(
            rows(
                lookup_join(part, brands, ["p_type", "p_brand"]),
                F.col("p_partkey") * 3 + 1, F.col("p_name"), F.col("brand_id"),
            )
        )
    )


def flag_members(spark: SparkSession, folder: str) -> DataFrame:
    flags = table(spark, folder, "lineitem").select("l_returnflag").distinct()
    nothing = F.lit(None).cast("string")
    return flags.select(
        F.lit(PART_CUBE).alias("cube_id"),
        F.lit(2).alias("dim_id"),
        F.lit("Return flag").alias("dim_name"),
        text(flag_id(F.col("l_returnflag"))).alias("member_id"),
        F.col("l_returnflag").alias("member_name"),
        nothing.alias("parent_id"),
        nothing.alias("code"),
    )


def flag_id(c: Column) -> Column:
    return F.ascii(c) - 64


def part_facts(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    sums = (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey", "l_returnflag", F.date_format("l_shipdate", "yyyy").alias("REF_DATE"))
        .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("VALUE"))
    )
    return sums.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "REF_DATE",
        F.col("p_name").alias("Part"),
        F.col("l_returnflag").alias("Return flag"),
        "VALUE",
        F.lit("Number").alias("UOM"),
        F.lit("0").alias("SCALAR_ID"),
        F.concat_ws(".", text(F.col("l_partkey") * 3 + 1), text(flag_id(F.col("l_returnflag")))).alias(
            "COORDINATE"
        ),
    )


# --- releases and catalog ----------------------------------------------------------------------


def cube_of(key: Column) -> Column:
    digits = text(F.lit(10000000) + key)
    return F.concat_ws(
        "-", F.substring(digits, 1, 2), F.substring(digits, 3, 2), F.substring(digits, 5, 4)
    )


def releases(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        cube_of(F.col("user_id")).alias("cube_id"), F.col("ts").alias("releaseTime"), "event_type", "value"
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    key = F.col("c_nationkey")
    return customer.select(
        cube_of(F.col("c_custkey")).alias("cube_id"),
        text(F.lit(10000000) + F.col("c_custkey")).alias("productId"),
        F.concat("c_name", F.lit(" by "), "c_mktsegment").alias("cubeTitleEn"),
        F.concat("c_name", F.lit(" selon "), "c_mktsegment").alias("cubeTitleFr"),
        F.concat_ws(", ", text(key), text(F.pmod(key + 1, F.lit(25))), F.lit("99")).alias("surveyCode"),
        F.substring("c_mktsegment", 1, 2).alias("subjectCode"),
    )


def surveys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        text(F.col("n_nationkey")).alias("surveyCode"),
        F.col("n_name").alias("surveyEn"),
        F.lower("n_name").alias("surveyFr"),
    )


def subjects(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "customer")
        .select("c_mktsegment")
        .distinct()
        .select(
            F.substring("c_mktsegment", 1, 2).alias("subjectCode"),
            F.col("c_mktsegment").alias("subjectEn"),
            F.lower("c_mktsegment").alias("subjectFr"),
        )
    )


# --- the same tables in SQL --------------------------------------------------------------------

_STATS_SQL = ", ".join(
    f"({i}, '{name}', '{uom}', '{factor}', '{scale}')" for i, name, uom, factor, scale in STATISTICS
)
_CUBE_OF = "substr((10000000 + {k})::VARCHAR, 1, 2) || '-' || substr((10000000 + {k})::VARCHAR, 3, 2) || '-' || substr((10000000 + {k})::VARCHAR, 5, 4)"


def cube_of_sql(key: str) -> str:
    return _CUBE_OF.format(k=key)


DERIVED_NEEDS = {
    "orders_facts": ("orders_cells", "statistics"),
    "orders_members": ("statistics",),
    "part_brands": ("part_types",),
    "part_members": ("part_types", "part_brands"),
    "catalog_full": ("catalog", "surveys", "subjects"),
}

DERIVED_SQL = {
    "statistics": f"SELECT * FROM (VALUES {_STATS_SQL}) AS s(stat, stat_name, uom, factor, scale)",
    "orders_cells": """
        SELECT n_nationkey, n_name, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS ref_date,
               count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total,
               count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1, 2, 3, 4""",
    "orders_facts": """
        SELECT ref_date AS "REF_DATE", n_name AS "GEO",
               '2016A0002' || lpad(n_nationkey::VARCHAR, 2, '0') AS "DGUID",
               substr(o_orderpriority, 3) || ' [P' || substr(o_orderpriority, 1, 1) || ']' AS "Priority",
               stat_name AS "Statistic",
               CASE stat WHEN 1 THEN n::DOUBLE WHEN 2 THEN total::DOUBLE / 1000.0::DOUBLE
                    ELSE n_f::DOUBLE * 100.0::DOUBLE / n::DOUBLE END AS "VALUE",
               uom AS "UOM", factor AS "SCALAR_FACTOR", scale AS "SCALAR_ID",
               'v' || (1000000 + (n_nationkey + 7) * 1000 + substr(o_orderpriority, 1, 1)::INT * 10 + stat)::VARCHAR
                 AS "VECTOR",
               (n_nationkey + 7)::VARCHAR || '.' || substr(o_orderpriority, 1, 1) || '.' || stat::VARCHAR
                 AS "COORDINATE",
               '2' AS "DECIMALS"
        FROM orders_cells CROSS JOIN statistics""",
    "orders_members": f"""
        SELECT '{ORDERS_CUBE}' AS cube_id, 1 AS dim_id, 'Geography' AS dim_name, '1' AS member_id,
               'World' AS member_name, NULL::VARCHAR AS parent_id, '[W]' AS code
        UNION ALL SELECT '{ORDERS_CUBE}', 1, 'Geography', (r_regionkey + 2)::VARCHAR, r_name, '1',
               '[R' || r_regionkey::VARCHAR || ']' FROM region
        UNION ALL SELECT '{ORDERS_CUBE}', 1, 'Geography', (n_nationkey + 7)::VARCHAR, n_name,
               (n_regionkey + 2)::VARCHAR, '[' || lpad(n_nationkey::VARCHAR, 2, '0') || ']' FROM nation
        UNION ALL SELECT '{ORDERS_CUBE}', 2, 'Priority', substr(p, 1, 1), substr(p, 3), NULL,
               '[P' || substr(p, 1, 1) || ']' FROM (SELECT DISTINCT o_orderpriority AS p FROM orders)
        UNION ALL SELECT '{ORDERS_CUBE}', 3, 'Statistic', stat::VARCHAR, stat_name, NULL, NULL
          FROM statistics""",
    "returns_long": """
        SELECT strftime(l_shipdate, '%Y-%m') AS "REF_DATE", l_linestatus AS "Line status",
               CASE l_linestatus WHEN 'F' THEN '1' ELSE '2' END || '.' || id AS "COORDINATE",
               sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = flag)::DOUBLE AS "VALUE",
               CASE WHEN count(*) FILTER (WHERE l_returnflag = flag) < 5 THEN 'x' END AS "Symbol",
               flag AS "Return flag (3)"
        FROM lineitem CROSS JOIN (VALUES ('A', '1'), ('N', '2'), ('R', '3')) AS f(flag, id)
        GROUP BY 1, 2, 3, flag""",
    "part_types": "SELECT p_type, min(p_partkey) * 3 + 3 AS type_id FROM part GROUP BY p_type",
    "part_brands": """
        SELECT p_type, p_brand, min(p_partkey) * 3 + 2 AS brand_id FROM part GROUP BY p_type, p_brand""",
    "part_members": f"""
        SELECT '{PART_CUBE}' AS cube_id, 1 AS dim_id, type_id::VARCHAR AS member_id,
               p_type AS member_name, NULL::VARCHAR AS parent_id FROM part_types
        UNION ALL SELECT '{PART_CUBE}', 1, brand_id::VARCHAR, p_brand, type_id::VARCHAR
          FROM part_brands JOIN part_types USING (p_type)
        UNION ALL SELECT '{PART_CUBE}', 1, (p_partkey * 3 + 1)::VARCHAR, p_name, brand_id::VARCHAR
          FROM part JOIN part_brands USING (p_type, p_brand)""",
    "part_facts": """
        SELECT strftime(l_shipdate, '%Y') AS "REF_DATE", p_name AS "Part", l_returnflag AS "Return flag",
               sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS "VALUE",
               (l_partkey * 3 + 1)::VARCHAR || '.' || (ascii(l_returnflag) - 64)::VARCHAR AS "COORDINATE",
               l_partkey * 3 + 1 AS part_member
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, l_partkey""",
    "releases": f"""
        SELECT {cube_of_sql('user_id')} AS cube_id, ts AS "releaseTime", event_type, value FROM events""",
    "catalog": f"""
        SELECT {cube_of_sql('c_custkey')} AS cube_id, (10000000 + c_custkey)::VARCHAR AS "productId",
               c_name || ' by ' || c_mktsegment AS "cubeTitleEn",
               c_name || ' selon ' || c_mktsegment AS "cubeTitleFr",
               c_nationkey::VARCHAR || ', ' || ((c_nationkey + 1) % 25)::VARCHAR || ', 99' AS "surveyCode",
               substr(c_mktsegment, 1, 2) AS "subjectCode", c_nationkey
        FROM customer""",
    "surveys": """
        SELECT n_nationkey::VARCHAR AS "surveyCode", n_name AS "surveyEn", lower(n_name) AS "surveyFr"
        FROM nation""",
    "subjects": """
        SELECT DISTINCT substr(c_mktsegment, 1, 2) AS "subjectCode", c_mktsegment AS "subjectEn",
               lower(c_mktsegment) AS "subjectFr" FROM customer""",
    "catalog_full": """
        SELECT c.* EXCLUDE (c_nationkey), a."surveyEn" || '; ' || b."surveyEn" AS "surveyEn",
               a."surveyFr" || '; ' || b."surveyFr" AS "surveyFr", s."subjectEn", s."subjectFr"
        FROM catalog c JOIN surveys a ON a."surveyCode" = c_nationkey::VARCHAR
        JOIN surveys b ON b."surveyCode" = ((c_nationkey + 1) % 25)::VARCHAR
        JOIN subjects s ON s."subjectCode" = c."subjectCode" """,
}
