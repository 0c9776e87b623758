"""Written intermediates in the shared checkpoint folder.

A written table cuts lineage, survives the loss of executors and gives Catalyst exact sizes for
what follows. The folder is the one the cluster names in ``spark.checkpoint.dir``. Everything lies below a
folder of the application, which ``release_scratch`` deletes when the results are written.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
# In local mode without the setting: one folder of this process.
_LOCAL_ROOT: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get(_SETTING, None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError(f"Set {_SETTING} to a folder that all executors share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="statcube-"))
    return _LOCAL_ROOT[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the application's own part of the shared folder; never one that was used before."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/statcube/{spark.sparkContext.applicationId}"


def release_scratch(spark: SparkSession) -> None:
    """Delete all intermediates of this application; frames that were derived from them can't be read after that.

    For the end of a job, or between jobs whose results are written.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once and return it as a scan of the written files."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Size:
    """Measured rows and text bytes of a written table."""

    rows: int
    bytes: int


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: the length of texts and of nested values as text, 8 for anything else."""
    total = F.lit(0).cast("bigint")
    for name, kind in df.dtypes:
        c = F.col("`" + name.replace("`", "``") + "`")
        if kind == "string" or kind.startswith(("array", "map", "struct")):
            total = total + F.coalesce(F.octet_length(c.cast("string")), F.lit(0))
        else:
            total = total + 8
    return total


def materialize_measured(df: DataFrame, label: str) -> tuple[DataFrame, Size]:
    """Write a frame and measure it in the same job.

    A task that is retried may be measured again, so the size is an upper bound.
    """
    seen = Observation()
    measured = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes"))
    written = materialize(measured, label)
    values = seen.get
    return written, Size(int(values.get("rows") or 0), int(values.get("bytes") or 0))


def materialize_counted(df: DataFrame, label: str, condition: Column) -> tuple[DataFrame, int]:
    """Write a frame and count the rows that meet a condition in the same job."""
    seen = Observation()
    written = materialize(df.observe(seen, F.count_if(condition).alias("n")), label)
    return written, int(seen.get.get("n") or 0)
