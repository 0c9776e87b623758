"""Streams of release notices: import each release once, and name the stored cubes that a release made stale."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statcube.functions.names import CUBE_ID, language_code
from statcube.sources.scratch import materialize, scratch_path
from statcube.sources.store import PART, listed_parts, register_part, registry_entries, stale_cubes, typed_for_store

NOTICE_SCHEMA = f"{CUBE_ID} string, released timestamp, path string"


def notices(spark: SparkSession, landing: str, files_per_step: int = 1000) -> DataFrame:
    """Stream of the notices (cube, time of release, place of the extract) that land as JSON lines."""
    return spark.readStream.schema(NOTICE_SCHEMA).option("maxFilesPerTrigger", files_per_step).json(landing)


def import_releases(
    stream: DataFrame,
    read: Callable[[str], DataFrame],
    root: str,
    progress: str | None = None,
    language: str = "eng",
    partition_by: Sequence[str] = (),
) -> None:
    """Append the extract of every (cube, release) once, however often and however late its notices land, then stop.

    A release has a part of its own whose name follows from cube and release. The store's log is the memory of what was imported: notices of a listed part
    are passed over, so neither a lost ``progress`` folder nor a notice that is years late brings rows twice or loses them, and no
    watermark has to be guessed. Of several notices of one release in a step the first path counts. ``read`` gives the
    rows of a place; all extracts of a cube have the same columns.
    """
    spark, lang = stream.sparkSession, language_code(language)

    def place(cube_id: str, released) -> str:
        dataset = uuid.uuid5(uuid.NAMESPACE_URL, f"{root.rstrip('/')} {cube_id} {lang} releases").hex
        return f"{root.rstrip('/')}/data/{cube_id}-{lang}-{dataset}/{PART}={released:%Y%m%dT%H%M%S%f}"

    def import_step(step: DataFrame, number: int) -> None:
        new = step.filter(F.col(CUBE_ID).isNotNull() & F.col("released").isNotNull()).groupBy(CUBE_ID, "released").agg(F.min("path").alias("path"))
        # One row per release that the step brings; its rows are read by Spark below.
        for notice in materialize(new, "notices").orderBy("released", CUBE_ID).toLocalIterator():
            part = place(notice[CUBE_ID], notice.released)
            if part in listed_parts(spark, root, notice[CUBE_ID], lang):
                continue
            rows = typed_for_store(read(notice.path), lang)
            rows.write.mode("overwrite").partitionBy(*partition_by).parquet(part)
            register_part(spark, root, notice[CUBE_ID], lang, part, rows.schema, partition_by)

    _run(stream.writeStream.foreachBatch(import_step), spark, progress)


def follow_stale(stream: DataFrame, root: str, act: Callable[[DataFrame], None], progress: str | None = None) -> None:
    """Hand the stored cubes that new notices made stale to ``act``, one frame a step, then stop.

    The state of the stream is the latest release of each cube, a row per cube whatever the number of notices; only cubes whose latest
    release changes in a step are looked up in the registry. Repeated and late notices change nothing.
    """
    spark = stream.sparkSession
    latest = stream.filter(F.col(CUBE_ID).isNotNull()).groupBy(CUBE_ID).agg(F.max("released").alias("last_release"))

    def step(changed: DataFrame, number: int) -> None:
        act(stale_cubes(registry_entries(spark, root), materialize(changed, "released")))

    _run(latest.writeStream.outputMode("update").foreachBatch(step), spark, progress)


def _run(writer, spark: SparkSession, progress: str | None) -> None:
    log = progress or scratch_path(spark, "progress")
    writer.option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()
