"""The Parquet store: partitioned writing, pruned reading, repartitioning, registry."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cube_queries.cubes import ORDERS_CUBE, PART_CUBE, orders_facts, orders_members, part_facts, returns_wide
from cube_queries.members import NORMALIZED_SQL
from cube_queries.registry import query, with_tables
from statcube.operators.reshape import wide_to_long
from statcube.operators.series import latest_n
from statcube.plans.metadata import open_metadata, store_metadata
from statcube.plans.pipelines import normalize_cube, query_stored_cube
from statcube.sources import store as St
from statcube.sources.scratch import scratch_path


def new_store(spark) -> str:
    return scratch_path(spark, "store")


_STORED = """SELECT *, substr("DGUID", 10) AS "GeoUID" FROM orders_facts"""
_CHOSEN = """ WHERE "GeoUID" IN ('03', '14') AND "Statistic" = 'Value' """


def _store_orders(spark, folder, **options):
    root = new_store(spark)
    St.store_cube(orders_facts(spark, folder), root, ORDERS_CUBE, title="Orders", **options)
    return root


def _store_orders_and_members(spark, folder, **options):
    """The cube, and its members together with those of another cube."""
    root = _store_orders(spark, folder, **options)
    members = orders_members(spark, folder)
    other = members.withColumn("cube_id", F.lit("20-10-0999")).filter("dim_id = 1")
    store_metadata(members.unionByName(other), root)
    return root


def _choose(df):
    return df.filter(F.col("GeoUID").isin("03", "14") & (F.col("Statistic") == "Value"))


@query("stored_filter", with_tables(["orders_facts"], f"SELECT * FROM ({_STORED}) {_CHOSEN}"))
def stored_filter(spark, folder):
    root = _store_orders(spark, folder, partition_by=["GeoUID"], cluster_by=["COORDINATE", "REF_DATE"])
    return _choose(St.open_cube(spark, root, ORDERS_CUBE))


@query("repartitioned_filter", with_tables(["orders_facts"], f"SELECT * FROM ({_STORED}) {_CHOSEN}"))
def repartitioned_filter(spark, folder):
    root = _store_orders(spark, folder, partition_by=["GeoUID"])
    St.repartition_cube(spark, root, ORDERS_CUBE, ["Statistic"], cluster_by=["GeoUID"])
    return _choose(St.open_cube(spark, root, ORDERS_CUBE))


@query(
    "stored_cube_query",
    with_tables(
        ["orders_facts", "orders_members"],
        f"""SELECT "VECTOR", "REF_DATE", "Date", val_norm, "GEO", "Priority", "Hierarchy for GEO", "Priority__ord"
            FROM ({NORMALIZED_SQL}) WHERE "GEO" = 'NATION_3' """,
    ),
)
def stored_cube_query(spark, folder):
    root = _store_orders_and_members(spark, folder, partition_by=["GEO"])
    cube = query_stored_cube(
        spark, root, ORDERS_CUBE, F.col("GEO") == "NATION_3"
    )
    return cube.select(
        "VECTOR", "REF_DATE", "Date", "val_norm", "GEO", "Priority", "Hierarchy for GEO", "Priority__ord"
    )


@query(
    "latest_normalized",
    with_tables(
        ["orders_facts", "orders_members"],
        f"""SELECT "VECTOR", "REF_DATE", "Date", "GEO", "Priority", "Statistic", val_norm, "Hierarchy for GEO",
                   "Classification Code for Priority" FROM ({NORMALIZED_SQL}) WHERE "Statistic" = 'Value'
            QUALIFY row_number() OVER (PARTITION BY "VECTOR" ORDER BY "REF_DATE" DESC) <= 12""",
    ),
)
def latest_normalized(spark, folder):
    root = _store_orders_and_members(spark, folder, partition_by=["GEO"])
    stored = St.open_cube(spark, root, ORDERS_CUBE).filter("Statistic = 'Value'")
    cube = normalize_cube(latest_n(stored, 12), open_metadata(spark, root, ORDERS_CUBE), default_month="07")
    return cube.select(
        "VECTOR", "REF_DATE", "Date", "GEO", "Priority", "Statistic", "val_norm", "Hierarchy for GEO",
        "Classification Code for Priority",
    )


@query(
    "registry",
    with_tables(
        ["orders_facts", "part_facts"],
        f"""SELECT '{ORDERS_CUBE}' AS cube_id, 'eng' AS language, 'parquet' AS format, 'Orders' AS title,
                   'GEO' AS partitions, true AS up_to_date, true AS has_size, count(*) AS n FROM orders_facts
            UNION ALL SELECT '{PART_CUBE}', 'eng', 'parquet', 'Parts', '', NULL, true, count(*) FROM part_facts""",
    ),
)
def registry(spark, folder):
    root = _store_orders(spark, folder, partition_by=["GEO"])
    St.store_cube(part_facts(spark, folder), root, PART_CUBE, title="Parts")
    St.store_cube(wide_to_long(returns_wide(spark, folder)), root, "98-10-0002", title="Returns")
    St.drop_cubes(spark, root, ["98-10-0002"])
    released = spark.createDataFrame([(ORDERS_CUBE, "2024-01-01 00:00:00")], "cube_id string, t string").select(
        "cube_id", F.col("t").cast("timestamp").alias("releaseTime")
    )
    sizes = St.open_cube(spark, root, ORDERS_CUBE).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(ORDERS_CUBE).alias("cube_id"), "n"
    ).unionByName(
        St.open_cube(spark, root, PART_CUBE).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(PART_CUBE).alias("cube_id"), "n"
        )
    )
    listed = St.cube_registry(spark, root, released).join(sizes, "cube_id")
    return listed.select(
        "cube_id",
        "language",
        "format",
        "title",
        F.array_join("partitioning", ",").alias("partitions"),
        "up_to_date",
        ((F.col("bytes") > 0) & F.col("size").isNotNull()).alias("has_size"),
        "n",
    )


@query(
    "append_import",
    with_tables(
        ["returns_long"],
        """SELECT "REF_DATE", "COORDINATE", "VALUE", "Line status" FROM returns_long""",
    ),
)
def append_import(spark, folder):
    """Two halves of a semi-wide extract, reshaped on the way into one stored cube."""
    root = new_store(spark)
    extract = returns_wide(spark, folder)
    late = F.col("REF_DATE") >= "1999"
    St.store_cube(wide_to_long(extract.filter(~late)), root, "98-10-0002", partition_by=["Line status"])
    St.append_to_cube(wide_to_long(extract.filter(late)), root, "98-10-0002")
    return St.open_cube(spark, root, "98-10-0002").select("REF_DATE", "COORDINATE", "VALUE", "Line status")


@query("open_current", with_tables(["orders_facts"], 'SELECT "VECTOR", "REF_DATE", "VALUE" FROM orders_facts'))
def open_current(spark, folder):
    """Stored at the first call, only opened at the second, whose loader must not be asked."""
    root = new_store(spark)

    def refuse():
        raise AssertionError("The stored cube is there")

    St.open_current(spark, root, ORDERS_CUBE, lambda: orders_facts(spark, folder), partition_by=["GEO"])
    return St.open_current(spark, root, ORDERS_CUBE, refuse).select("VECTOR", "REF_DATE", "VALUE")


@query(
    "stored_sizes",
    with_tables(
        ["orders_facts", "part_facts"],
        f"""SELECT '{ORDERS_CUBE}' AS cube_id, true AS plausible FROM (SELECT count(*) FROM orders_facts)
            UNION ALL SELECT '{PART_CUBE}', true FROM (SELECT count(*) FROM part_facts)""",
    ),
)
def stored_sizes(spark, folder):
    """Bytes of a stored cube against the lengths of its files."""
    root = _store_orders(spark, folder, partition_by=["GEO"])
    St.store_cube(part_facts(spark, folder), root, PART_CUBE, title="Parts")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        .load(f"{root}/data").select(F.regexp_extract("path", r"/data/(\d\d-\d\d-\d{4})-", 1).alias("cube_id"), "length")
    )
    sizes = files.groupBy("cube_id").agg(F.sum("length").alias("length"))
    listed = St.cube_registry(spark, root).join(sizes, "cube_id")
    # The listed bytes also hold the checksums and marker files of the folder.
    return listed.select("cube_id", F.col("bytes").between(F.col("length"), F.col("length") * 1.2 + 100_000).alias("plausible"))


@query(
    "concurrent_appends",
    with_tables(["orders_facts"], """SELECT "VECTOR", "REF_DATE", "VALUE", "GEO" FROM orders_facts"""),
)
def concurrent_appends(spark, folder):
    """A cube in one stored and six appended parts; the appends run at the same time, and a rewrite of the cube among them."""
    root = new_store(spark)
    facts = orders_facts(spark, folder).withColumn("__share", F.pmod(F.xxhash64("VECTOR", "REF_DATE"), F.lit(7)))
    St.store_cube(facts.filter("__share = 0").drop("__share"), root, ORDERS_CUBE, partition_by=["GEO"])

    def work(share):
        if share == 7:
            St.compact_cube(spark, root, ORDERS_CUBE)
        else:
            St.append_to_cube(facts.filter(F.col("__share") == share).drop("__share"), root, ORDERS_CUBE)

    with ThreadPoolExecutor(7) as pool:
        list(pool.map(work, range(1, 8)))
    return St.open_cube(spark, root, ORDERS_CUBE).select("VECTOR", "REF_DATE", "VALUE", "GEO")


_REVISED = """SELECT "VECTOR", "REF_DATE", "GEO", CASE WHEN "GEO" = 'NATION_3' THEN "VALUE" + 1 ELSE "VALUE" END AS "VALUE"
              FROM orders_facts WHERE "GEO" <> 'NATION_5' """


def _revised(spark, folder):
    """The orders cube as published again: one place changed, one gone."""
    value = F.when(F.col("GEO") == "NATION_3", F.col("VALUE") + 1).otherwise(F.col("VALUE"))
    return orders_facts(spark, folder).filter("GEO <> 'NATION_5'").withColumn("VALUE", value)


@query("refresh_changed", with_tables(["orders_facts"], _REVISED))
def refresh_changed(spark, folder):
    """A refresh after a new release; only partitions that differ are written."""
    root = _store_orders(spark, folder, partition_by=["GEO"])
    released = datetime(2999, 1, 1)
    rows = St.open_current(spark, root, ORDERS_CUBE, lambda: _revised(spark, folder), refresh="auto", released=released)
    return rows.select("VECTOR", "REF_DATE", "GEO", "VALUE")


@query(
    "refresh_log",
    with_tables(
        ["orders_facts"],
        """SELECT 1 AS step, count(DISTINCT "GEO")::BIGINT AS written, 0::BIGINT AS removed FROM orders_facts
           UNION ALL SELECT 2, (max("GEO" = 'NATION_3'))::BIGINT, max("GEO" = 'NATION_3')::BIGINT + max("GEO" = 'NATION_5')::BIGINT FROM orders_facts
           UNION ALL SELECT 3, 0, 0""",
    ),
)
def refresh_log(spark, folder):
    """What the log says of a store, a refresh with one place changed and one gone, and a refresh without a change."""
    root = _store_orders(spark, folder, partition_by=["GEO"])
    for _ in range(2):
        St.open_current(spark, root, ORDERS_CUBE, lambda: _revised(spark, folder), refresh=True)
    steps = St.cube_versions(spark, root, ORDERS_CUBE)
    step = F.row_number().over(Window.orderBy("time_cached"))
    return steps.select(step.alias("step"), F.col("pieces_added").alias("written"), F.col("pieces_removed").alias("removed"))


@query(
    "dropped_by_frame",
    with_tables(
        ["orders_facts", "part_facts"],
        f"""SELECT 'dropped, as of before' AS state, count(*) AS n FROM part_facts
            UNION ALL SELECT 'kept', count(*) FROM orders_facts
            UNION ALL SELECT 'listed', 1""",
    ),
)
def dropped_by_frame(spark, folder):
    """Drop the cubes of a filtered registry frame; the dropped one can still be read as of before, until it is released."""
    root = _store_orders(spark, folder, partition_by=["GEO"])
    St.store_cube(part_facts(spark, folder), root, PART_CUBE, title="Parts")
    listed = St.registry_entries(spark, root)
    before = listed.agg(F.max("time_cached")).first()[0]
    St.drop_cubes(spark, root, listed.filter("title = 'Parts'"))
    counts = {
        "dropped, as of before": St.open_cube(spark, root, PART_CUBE, as_of=before),
        "kept": St.open_cube(spark, root, ORDERS_CUBE),
        "listed": St.cube_registry(spark, root),
    }
    frames = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("state"), "n") for name, df in counts.items()]
    return reduce(DataFrame.unionByName, frames)
