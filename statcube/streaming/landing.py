"""Import of extracts that keep landing in a folder, a bounded number of files at a time."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statcube.functions import expressions as X
from statcube.functions.names import column, language_code, names_for
from statcube.operators.reshape import wide_to_long
from statcube.sources.delimited import MALFORMED
from statcube.sources.scratch import materialize, scratch_path
from statcube.sources.store import PART, QUARANTINE, open_cube, register_part, typed_for_store


def import_landed(
    spark: SparkSession,
    landing: str,
    header: Sequence[str],
    root: str,
    cube_id: str,
    language: str = "eng",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    title: str | None = None,
    files_per_step: int = 1000,
    progress: str | None = None,
    quarantine: bool = False,
) -> DataFrame:
    """Append all landed files of a cube to the store, each exactly once, then stop.

    Every step takes at most ``files_per_step`` files, reshapes them to long form, applies
    ``transform`` (row-wise) and writes a part of its own, which is then registered. The file log in ``progress`` lets
    a broken import go on where it stopped: a step that was not finished writes the same part again. A later call with
    the same ``progress`` adds the files that have landed since; with another one, or none, the cube is imported anew.
    Records whose number of fields differs from the header end the import; with ``quarantine`` they are set apart instead, in a part of their own that is
    registered together with the good one of the same step (``open_quarantine``). A step is then parsed and written once before it is split.
    """
    n = names_for(language)
    kept = [*header, MALFORMED] if quarantine else list(header)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in kept])
    raw = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("sep", n.delimiter)
        .option("escape", '"')
        .option("mode", "PERMISSIVE" if quarantine else "FAILFAST")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)
        .option("maxFilesPerTrigger", files_per_step)
        .csv(landing)
    )

    def shaped(records: DataFrame) -> DataFrame:
        clean = records.select(*[X.null_if_missing(column(c)).alias(c) for c in header])
        rows = typed_for_store(wide_to_long(clean, language), language)
        return transform(rows) if transform else rows

    log = progress or scratch_path(spark, "import")
    # The same log always leads to the same folders.
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{root.rstrip('/')} {cube_id} {language_code(language)} {log}").hex
    stem = f"{root.rstrip('/')}/data/{cube_id}-{language_code(language)}-{name}"

    def store_step(step: DataFrame, number: int) -> None:
        spark, part = step.sparkSession, f"{stem}/{PART}={number}"
        apart = None
        if quarantine:
            step = materialize(step, "step")
            records = step.filter(column(MALFORMED).isNotNull()).select(column(MALFORMED).alias("record"), "file")
            apart = f"{stem}{QUARANTINE}/{PART}={number}"
            records.write.mode("overwrite").parquet(apart)
            step = step.filter(column(MALFORMED).isNull())
        rows = shaped(step)
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(part)
        register_part(spark, root, cube_id, language, part, rows.schema, partition_by, title, apart, records.schema if quarantine else None)

    source = raw.withColumn("file", F.col("_metadata.file_name")) if quarantine else raw
    query = (
        source.writeStream.foreachBatch(store_step)
        .option("checkpointLocation", log)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return open_cube(spark, root, cube_id, language)
