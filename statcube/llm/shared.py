"""Small helpers that several operators of this subpackage use."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import suppress
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark application, so that their Python finds it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    place = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
    with zipfile.ZipFile(place, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(place))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_fold(identifier: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a missing id has no fold (NULL)."""
    return F.crc32(identifier.cast("string").cast("binary")) % folds


def texts_of(column: pa.Array) -> Iterator[str]:
    """The texts of an Arrow column one at a time, a missing one as empty."""
    for value in column:
        yield value.as_py() or ""


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches that are sorted by them.

    Holds one group at a time, so callers have to bound the size of a group.
    """
    held: list[pa.Table] = []
    held_key: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        found = list(zip(*columns))
        start = 0
        for end in range(1, len(found) + 1):
            if end < len(found) and found[end] == found[start]:
                continue
            piece = pa.Table.from_batches([batch.slice(start, end - start)])
            if held and found[start] != held_key:
                yield pa.concat_tables(held)
                held = []
            held.append(piece)
            held_key = found[start]
            start = end
    if held:
        yield pa.concat_tables(held)


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    place = public_tokenizers.path(name)
    if not os.path.exists(place):
        raise FileNotFoundError(place)
    return place


def one_thread() -> None:
    """Keep numeric and tokenizer libraries of a task to the one core that Spark gives it."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    with suppress(Exception):
        pa.set_cpu_count(1)
