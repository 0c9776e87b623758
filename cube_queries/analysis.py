"""Analysts' questions, reshaping and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cube_queries.cubes import (
    orders_facts,
    orders_members,
    part_facts,
    returns_wide,
    table,
)
from cube_queries.members import NORMALIZED_SQL, orders_meta
from cube_queries.registry import query, with_tables
from statcube.functions import expressions as X
from statcube.functions.names import (
    canonical_order,
    same_columns,
    union_by_name,
)
from statcube.operators import analysis as A
from statcube.operators.reshape import cube_pivot, wide_to_long
from statcube.plans.pipelines import normalize_cube, normalize_values


def normal_facts(spark, folder):
    return normalize_values(orders_facts(spark, folder))


NORMAL = """SELECT *, ("REF_DATE" || '-01')::DATE AS "Date",
     CASE WHEN "UOM" = 'Percent' THEN "VALUE" / 100.0::DOUBLE
          ELSE "VALUE" * pow(10.0::DOUBLE, "SCALAR_ID"::INT) END AS val_norm FROM orders_facts"""


@query(
    "filter_members",
    with_tables(
        ["orders_facts", "orders_members"],
        f"""SELECT "VECTOR", "REF_DATE", val_norm, "Hierarchy for GEO" FROM ({NORMALIZED_SQL})
            WHERE "GEO" IN ('NATION_3', 'NATION_14') AND "Statistic" = 'Value' """,
    ),
)
def filter_members(spark, folder):
    """Written after the enrichment; the filter still reaches the scans."""
    cube = normalize_cube(orders_facts(spark, folder), orders_meta(spark, folder), categories=False)
    return cube.filter(F.col("GEO").isin("NATION_3", "NATION_14") & (F.col("Statistic") == "Value")).select(
        "VECTOR", "REF_DATE", "val_norm", "Hierarchy for GEO"
    )


@query(
    "canonical_columns",
    with_tables(["orders_facts"], NORMAL),
)
def canonical_columns(spark, folder):
    return canonical_order(normal_facts(spark, folder))


@query(
    "signed_values",
    with_tables(
        ["orders_facts"],
        """SELECT "VECTOR", "REF_DATE", CASE WHEN "Priority" LIKE 'LOW%' OR "Priority" LIKE 'MEDIUM%'
             THEN -"VALUE" ELSE "VALUE" END AS signed FROM orders_facts""",
    ),
)
def signed_values(spark, folder):
    negative = F.col("Priority").startswith("LOW") | F.col("Priority").startswith("MEDIUM")
    value = F.when(negative, -F.col("VALUE")).otherwise(F.col("VALUE"))
    return orders_facts(spark, folder).select("VECTOR", "REF_DATE", value.alias("signed"))


@query(
    "distinct_members",
    with_tables(["orders_facts"], """SELECT DISTINCT "Priority" FROM orders_facts"""),
)
def distinct_members(spark, folder):
    return orders_facts(spark, folder).select("Priority").distinct()


@query(
    "sum_na_zero",
    """SELECT l_suppkey, l_returnflag, coalesce(sum(CASE WHEN l_discount > 0.08 THEN l_quantity::DECIMAL(18,2) END), 0)::DOUBLE
         AS discounted FROM lineitem GROUP BY 1, 2""",
)
def sum_na_zero(spark, folder):
    amount = F.when(F.col("l_discount") > 0.08, F.col("l_quantity").cast("decimal(18,2)"))
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", "l_returnflag")
        .agg(A.sum_na_zero(amount).cast("double").alias("discounted"))
    )


@query(
    "annualize_complete",
    with_tables(
        ["orders_facts"],
        """SELECT "GEO", "Year", sum(v)::DOUBLE AS total, count(*)::BIGINT AS n FROM (
             SELECT "GEO", substr("REF_DATE", 1, 4) AS "Year", sum("VALUE"::DECIMAL(18,2)) AS v
             FROM orders_facts WHERE "Statistic" = 'Orders' GROUP BY "GEO", "REF_DATE")
           GROUP BY 1, 2 HAVING count(*) = 12""",
    ),
)
def annualize_complete(spark, folder):
    monthly = (
        normal_facts(spark, folder)
        .filter("Statistic = 'Orders'")
        .groupBy("GEO", "Date")
        .agg(F.sum(F.col("val_norm").cast("decimal(18,2)")).alias("v"))
        .withColumn("Year", F.date_format("Date", "yyyy"))
    )
    yearly = A.annualize_complete(monthly, ["GEO", "Year"], "v")
    return yearly.select("GEO", "Year", F.col("v").cast("double").alias("total"), "n")


_MONTH_GEO = """SELECT "GEO", "REF_DATE", sum("VALUE"::DECIMAL(18,2)) AS v FROM orders_facts
                WHERE "Statistic" = 'Orders' GROUP BY 1, 2"""


@query(
    "share_of_total",
    with_tables(
        ["orders_facts"],
        f"""SELECT f."VECTOR", f."REF_DATE", f."VALUE", t.v::DOUBLE AS "Total", f."VALUE" / t.v::DOUBLE AS "Share"
            FROM orders_facts f JOIN ({_MONTH_GEO}) t USING ("GEO", "REF_DATE") WHERE f."Statistic" = 'Orders' """,
    ),
)
def share_of_total(spark, folder):
    counts = orders_facts(spark, folder).filter("Statistic = 'Orders'")
    totals = counts.groupBy("GEO", "REF_DATE").agg(
        F.sum(F.col("VALUE").cast("decimal(18,2)")).cast("double").alias("Total")
    )
    return A.share_of_total(counts, totals, ["GEO", "REF_DATE"], "VALUE").select(
        "VECTOR", "REF_DATE", "VALUE", "Total", "Share"
    )


@query(
    "index_to_base",
    with_tables(
        ["orders_facts"],
        """SELECT "VECTOR", "REF_DATE", "VALUE", first AS first_value,
             "VALUE" / nullif(first, 0) - 1 AS change
           FROM (SELECT *, first_value("VALUE") OVER (PARTITION BY "VECTOR" ORDER BY "REF_DATE") AS first FROM orders_facts)""",
    ),
)
def index_to_base(spark, folder):
    """Over all series; those that begin with zero have no index."""
    return A.index_to_base(orders_facts(spark, folder), ["VECTOR"], "VALUE", "REF_DATE", "change").select(
        "VECTOR", "REF_DATE", "VALUE", "first_value", "change"
    )


_TOP = """SELECT * FROM (SELECT *, rank() OVER (ORDER BY v DESC) AS k FROM (
            SELECT l_partkey, l_suppkey, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS v FROM lineitem GROUP BY 1, 2))"""


@query("topk_ties", f"SELECT l_partkey, l_suppkey, v FROM ({_TOP}) WHERE k <= 8")
def topk_ties(spark, folder):
    sums = (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("v"))
    )
    return A.top_k_ties(sums, 8, "v")


@query(
    "topk_rest",
    with_tables(
        ["orders_facts"],
        """SELECT "REF_DATE", CASE WHEN "GEO" IN (
              SELECT "GEO" FROM (SELECT "GEO", rank() OVER (ORDER BY sum("VALUE"::DECIMAL(18,2)) DESC) AS k
                FROM orders_facts WHERE "Statistic" = 'Orders' GROUP BY 1) WHERE k <= 8)
             THEN "GEO" ELSE 'Rest' END AS place, sum("VALUE"::DECIMAL(18,2))::DOUBLE AS orders
           FROM orders_facts WHERE "Statistic" = 'Orders' GROUP BY 1, 2""",
    ),
)
def topk_rest(spark, folder):
    counts = orders_facts(spark, folder).filter("Statistic = 'Orders'").select(
        "REF_DATE", F.col("GEO").alias("place"), F.col("VALUE").cast("decimal(18,2)").alias("orders")
    )
    totals = counts.groupBy("place").agg(F.sum("orders").alias("orders"))
    pooled = A.top_k_rest(counts, A.top_k_ties(totals, 8, "orders"), "place", ["REF_DATE"], ["orders"])
    return pooled.withColumn("orders", F.col("orders").cast("double"))


@query(
    "diff_tables",
    with_tables(
        ["orders_facts"],
        """SELECT count(*) FILTER (WHERE "Statistic" = 'Value' AND "VALUE" <> 0 AND "REF_DATE" <> '1995-01')::BIGINT AS "VALUE",
                  0::BIGINT AS "UOM", 0::BIGINT AS "SCALAR_FACTOR",
                  count(*) FILTER (WHERE "REF_DATE" = '1995-01')::BIGINT AS only_left, 0::BIGINT AS only_right
           FROM orders_facts""",
    ),
)
def diff_tables(spark, folder):
    """Raw values against values in units, which lack a month: only scaled ones differ."""
    raw = orders_facts(spark, folder).select("VECTOR", "REF_DATE", "VALUE", "UOM", "SCALAR_FACTOR", "SCALAR_ID")
    scaled = raw.withColumns(
        {
            "VALUE": X.scaled(F.col("VALUE"), F.col("SCALAR_ID")),
            "SCALAR_FACTOR": F.rtrim("SCALAR_FACTOR"),
        }
    ).drop("SCALAR_ID")
    trimmed = raw.withColumn("SCALAR_FACTOR", F.rtrim("SCALAR_FACTOR"))
    return A.diff_tables(trimmed, scaled.filter("REF_DATE <> '1995-01'"), ["VECTOR", "REF_DATE"])


@query(
    "diff_deliveries",
    """WITH a AS (SELECT nullif(o_orderkey % 1000, 0) AS k, o_orderkey AS n, o_totalprice AS price, o_orderstatus AS status FROM orders WHERE o_orderkey % 7 <> 3),
            b AS (SELECT nullif(o_orderkey % 1000, 0) AS k, o_orderkey AS n, CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
                         CASE WHEN o_orderkey % 40 <> 0 THEN o_orderstatus END AS status FROM orders WHERE o_orderkey % 11 <> 5)
       SELECT count(*) FILTER (WHERE a.price <> b.price)::BIGINT AS price, count(*) FILTER (WHERE a.status <> b.status)::BIGINT AS status,
              count(*) FILTER (WHERE b.n IS NULL)::BIGINT AS only_left, count(*) FILTER (WHERE a.n IS NULL)::BIGINT AS only_right
       FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k AND a.n = b.n""",
)
def diff_deliveries(spark, folder):
    """Two deliveries of a cube: equal, changed and missing cells, rows of one side, and keys with a missing part."""
    key, n = F.nullif(F.col("o_orderkey") % 1000, F.lit(0)).alias("k"), F.col("o_orderkey").alias("n")
    orders = table(spark, folder, "orders")
    first = orders.filter("o_orderkey % 7 <> 3").select(key, n, F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    price = F.when(n % 50 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    second = orders.filter("o_orderkey % 11 <> 5").select(key, n, price.alias("price"), F.when(n % 40 != 0, F.col("o_orderstatus")).alias("status"))
    return A.diff_tables(first, second, ["k", "n"])


@query(
    "missing_cells",
    with_tables(
        ["orders_members"],
        """SELECT count(*) FILTER (WHERE parent_id IS NULL)::BIGINT AS parent_id,
                  count(*) FILTER (WHERE code IS NULL)::BIGINT AS code, 0::BIGINT AS member_name FROM orders_members""",
    ),
)
def missing_cells(spark, folder):
    return A.missing_cells(orders_members(spark, folder), ["parent_id", "code", "member_name"])


@query(
    "union_by_name",
    """SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS price FROM customer
       UNION ALL SELECT p_partkey, p_name, NULL, p_retailprice FROM part""",
)
def union_of_frames(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    parts = table(spark, folder, "part").select(
        F.col("p_retailprice").alias("price"), F.col("p_partkey").alias("key"), F.col("p_name").alias("name")
    )
    assert not same_columns(customers.columns, parts.columns)
    return union_by_name(customers, parts)


@query("wide_to_long", with_tables(["returns_long"], "SELECT * FROM returns_long"))
def unpivoted(spark, folder):
    return wide_to_long(returns_wide(spark, folder))


@query(
    "pivot_members",
    with_tables(
        ["orders_facts"],
        """SELECT "GEO", "REF_DATE", "Priority", max("VALUE") FILTER (WHERE "Statistic" = 'Orders') AS "Orders",
             max("VALUE") FILTER (WHERE "Statistic" = 'Value') AS "Value",
             max("VALUE") FILTER (WHERE "Statistic" = 'Share with status F') AS "Share with status F"
           FROM orders_facts GROUP BY 1, 2, 3""",
    ),
)
def pivot_members(spark, folder):
    facts = orders_facts(spark, folder).select("GEO", "REF_DATE", "Priority", "Statistic", "VALUE")
    return cube_pivot(facts, "Statistic", "VALUE", ["Orders", "Value", "Share with status F"])


@query(
    "part_shares",
    with_tables(
        ["part_facts"],
        """SELECT "COORDINATE", "REF_DATE", "VALUE" / t::DOUBLE AS "Share" FROM part_facts
           JOIN (SELECT "REF_DATE", sum("VALUE"::DECIMAL(18,2)) AS t FROM part_facts GROUP BY 1) USING ("REF_DATE")""",
    ),
)
def part_shares(spark, folder):
    facts = part_facts(spark, folder)
    totals = facts.groupBy("REF_DATE").agg(
        F.sum(F.col("VALUE").cast("decimal(18,2)")).cast("double").alias("Total")
    )
    return A.share_of_total(facts, totals, ["REF_DATE"], "VALUE").select("COORDINATE", "REF_DATE", "Share")


@query(
    "pivot_unlisted",
    with_tables(
        ["orders_facts"],
        """SELECT "GEO", "REF_DATE", "Priority", max("VALUE") FILTER (WHERE "Statistic" = 'Orders') AS "Orders",
             max("VALUE") FILTER (WHERE "Statistic" = 'Value') AS "Value", 1::BIGINT AS refused
           FROM orders_facts WHERE "Statistic" IN ('Orders', 'Value') GROUP BY 1, 2, 3""",
    ),
)
def pivot_unlisted(spark, folder):
    """Levels have to be listed; the table with one more level is refused."""
    facts = orders_facts(spark, folder).select("GEO", "REF_DATE", "Priority", "Statistic", "VALUE")
    refused = 0
    try:
        cube_pivot(facts, "Statistic", "VALUE", ["Orders", "Value"]).write.format("noop").mode("overwrite").save()
    except Exception as error:
        refused = int("Unlisted level" in str(error))
    listed = facts.filter(F.col("Statistic").isin("Orders", "Value"))
    return cube_pivot(listed, "Statistic", "VALUE", ["Orders", "Value"]).withColumn("refused", F.lit(refused).cast("bigint"))
