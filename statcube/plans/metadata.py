"""Member metadata in the store: parsed, prepared and written once, for all cubes in one job.

``<root>/metadata`` is partitioned by language and cube; every call of ``store_metadata`` adds a version, and a cube
is read in its latest one.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statcube.functions.names import CUBE_ID, language_code
from statcube.operators.enrich import CubeMetadata, cube_metadata, prepare_members
from statcube.operators.joins import fits_broadcast
from statcube.sources.scratch import Size

SCHEMA = (
    "dim_id int, member_id string, dim_name string, member_name string, parent_id string, code string, hierarchy string, "
    f"level_name string, original boolean, ord int, version timestamp, language string, {CUBE_ID} string"
)


def _path(root: str) -> str:
    return f"{root.rstrip('/')}/metadata"


def store_metadata(members: DataFrame, root: str, language: str = "eng") -> None:
    """Prepare the members of all given cubes together and add them to the store."""
    ready, _ = prepare_members(members)
    now = F.lit(datetime.now(timezone.utc))
    named = ready.withColumns({"version": now, "language": F.lit(language_code(language)), "dim_id": F.col("dim_id").cast("int"), "ord": F.col("ord").cast("int")})
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    named.select(*columns).hint("rebalance", CUBE_ID).write.mode("append").partitionBy("language", CUBE_ID).parquet(_path(root))


def stored_members(spark: SparkSession, root: str, language: str = "eng") -> DataFrame:
    """Prepared members of all cubes of a language, each cube in its latest version."""
    rows = spark.read.schema(SCHEMA).parquet(_path(root)).filter(F.col("language") == language_code(language))
    latest = rows.groupBy(CUBE_ID).agg(F.max("version").alias("version"))
    return rows.join(latest, [CUBE_ID, "version"])


def open_metadata(spark: SparkSession, root: str, cube_id: str, language: str = "eng") -> CubeMetadata:
    """Metadata of one cube; only its partition is read."""
    rows = (
        spark.read.schema(SCHEMA)
        .parquet(_path(root))
        .filter((F.col("language") == language_code(language)) & (F.col(CUBE_ID) == cube_id))
    )
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("member_name", "level_name", "hierarchy", "code", "dim_name")]
    width = sum(texts, F.lit(40))
    found = rows.groupBy("version").agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).orderBy(F.desc("version")).first()
    if found is None:
        raise ValueError(f"No metadata of cube {cube_id} in the store")
    own = rows.filter(F.col("version") == F.lit(found.version)).drop("version")
    return cube_metadata(own, cube_id, language_code(language), fits_broadcast(Size(found.n, found.bytes)))
