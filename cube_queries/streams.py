"""Imports with quarantine, releases that land repeatedly, stale cubes from a stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cube_queries.cubes import table, text
from cube_queries.registry import query
from statcube.sources.scratch import materialize, scratch_path
from statcube.sources.store import open_cube, open_quarantine, store_cube
from statcube.streaming.landing import import_landed
from statcube.streaming.releases import follow_stale, import_releases, notices

_LANDED_CUBE = "10-10-0001"


def _land_orders(spark, folder) -> str:
    """Records of orders; every fifth has a field too few or too many."""
    key = text(F.col("o_orderkey"))
    good = F.concat_ws(",", key, F.concat(F.lit("S"), F.col("o_orderstatus")), text(F.col("o_custkey")))
    line = F.when(F.col("o_orderkey") % 10 == 0, key).when(F.col("o_orderkey") % 10 == 5, F.concat_ws(",", key, key, key, key)).otherwise(good)
    landing = scratch_path(spark, "landing")
    lines = table(spark, folder, "orders").select(line.alias("value"))
    lines.repartition(4).write.option("header", True).option("quote", "").option("sep", "\t").csv(landing)
    return landing


def _quarantined_import(spark, folder) -> str:
    landing, root = _land_orders(spark, folder), scratch_path(spark, "store")
    progress = scratch_path(spark, "progress")
    for _ in range(2):
        # The second call finds nothing new.
        import_landed(spark, landing, ["COORDINATE", "GEO", "VALUE"], root, _LANDED_CUBE, partition_by=["GEO"], progress=progress, files_per_step=2, quarantine=True)
    return root


@query("import_quarantine", """SELECT o_orderkey::VARCHAR AS "COORDINATE", 'S' || o_orderstatus AS "GEO", o_custkey::DOUBLE AS "VALUE" FROM orders WHERE o_orderkey % 5 <> 0""")
def import_quarantine(spark, folder):
    """Well-formed records of an import whose files also hold others."""
    return open_cube(spark, _quarantined_import(spark, folder), _LANDED_CUBE).select("COORDINATE", "GEO", "VALUE")


@query(
    "quarantined_records",
    """SELECT CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey::VARCHAR
                   ELSE concat_ws(',', o_orderkey, o_orderkey, o_orderkey, o_orderkey) END AS record FROM orders WHERE o_orderkey % 5 = 0""",
)
def quarantined_records(spark, folder):
    """The records that the same import set apart, word for word."""
    return open_quarantine(spark, _quarantined_import(spark, folder), _LANDED_CUBE).select("record")


_YEAR = "extract(year FROM o_orderdate)::VARCHAR"
_CUBE_OF_ORDER = "'10-20-000' || (o_custkey % 3)::VARCHAR"


@query(
    "stream_releases",
    f"""SELECT {_CUBE_OF_ORDER} AS cube_id, {_YEAR} AS "REF_DATE", o_orderkey::VARCHAR AS "COORDINATE", o_totalprice::DOUBLE AS "VALUE" FROM orders""",
)
def stream_releases(spark, folder):
    """A release per cube and year. Notices are repeated, some years late, land out of order, and the import is restarted with and without its progress."""
    extracts, landing, root = (scratch_path(spark, x) for x in ("extracts", "landing", "store"))
    orders = table(spark, folder, "orders").select(
        F.concat(F.lit("10-20-000"), text(F.col("o_custkey") % 3)).alias("cube_id"), text(F.year("o_orderdate")).alias("year"),
        text(F.col("o_orderkey")).alias("COORDINATE"), F.col("o_totalprice").cast("double").alias("VALUE"),
    )
    orders.write.partitionBy("cube_id", "year").parquet(extracts)
    path = F.concat(F.lit(f"{extracts}/cube_id="), F.col("cube_id"), F.lit("/year="), F.col("year"))
    told = materialize(orders.select("cube_id", "year").distinct().select("cube_id", F.concat("year", F.lit("-12-31T00:00:00")).alias("released"), path.alias("path"), "year"), "told")

    def read(place: str) -> DataFrame:
        return spark.read.parquet(place).select(F.lit(place[-4:]).alias("REF_DATE"), "COORDINATE", "VALUE")

    def run(chosen, progress):
        told.filter(chosen).drop("year").write.mode("append").json(landing)
        import_releases(notices(spark, landing), read, root, progress)

    first, second = scratch_path(spark, "progress"), scratch_path(spark, "progress")
    run("year IN ('1995', '1996', '1997')", first)
    run("year NOT IN ('1995', '1993')", first)
    run("year <= '1996'", second)
    cubes = sorted(r[0] for r in told.select("cube_id").distinct().collect())
    found = [open_cube(spark, root, c).select(F.lit(c).alias("cube_id"), "REF_DATE", "COORDINATE", "VALUE") for c in cubes]
    return reduce(DataFrame.unionByName, found)


@query(
    "stream_stale",
    """SELECT '10-30-000' || (user_id % 4)::VARCHAR AS cube_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_release FROM events WHERE user_id % 4 < 2 GROUP BY 1""",
)
def stream_stale(spark, folder):
    """Stored cubes that the release events of a landing folder made stale; events repeat, and of the four cubes three are stored, one of them later than all events."""
    landing, root, progress = (scratch_path(spark, x) for x in ("landing", "store", "progress"))
    events = table(spark, folder, "events").select(
        F.concat(F.lit("10-30-000"), text(F.col("user_id") % 4)).alias("cube_id"), F.col("ts").cast("timestamp").alias("ts")
    )
    for k in range(3):
        store_cube(spark.range(3).select(F.lit("2020").alias("REF_DATE"), F.col("id").cast("double").alias("VALUE")), root, f"10-30-000{k}")
    # The registry holds the present; notices are moved ahead of it, but for the third cube.
    ahead = F.when(F.col("cube_id") == "10-30-0002", F.expr("ts - INTERVAL 100 YEARS")).otherwise(F.expr("ts + INTERVAL 200 YEARS"))
    land = events.select("cube_id", ahead.alias("released"), F.lit("").alias("path"))
    seen: list[DataFrame] = []

    def act(stale: DataFrame) -> None:
        seen.append(materialize(stale.select("cube_id", "last_release"), "stale"))

    for share in ("minute(released) < 30", "minute(released) >= 20"):
        land.filter(share).write.mode("append").json(landing)
        follow_stale(notices(spark, landing, 3), root, act, progress)
    latest = reduce(DataFrame.unionByName, seen).groupBy("cube_id").agg(F.max("last_release").alias("t"))
    return latest.select("cube_id", F.date_format(F.expr("t - INTERVAL 200 YEARS"), "yyyy-MM-dd HH:mm:ss").alias("last_release"))
