"""Physical building blocks that keep hot keys and growing lookups under control."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statcube.functions.names import column
from statcube.sources.scratch import Size, materialize, materialize_measured

# A lookup is broadcast only if it was measured and stays below both.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024**2
# Rows of one group that a single task may sort.
GROUP_ROWS = 5_000_000

def fits_broadcast(size: Size, max_rows: int | None = None) -> bool:
    limit = BROADCAST_ROWS if max_rows is None else max_rows
    return size.rows <= limit and size.bytes <= BROADCAST_BYTES


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    bounded: bool | Size | None = None,
) -> DataFrame:
    """Join a large frame to a lookup (inner, left, left_semi or left_anti).

    A lookup of measured small size is broadcast: no shuffle of the large side. Any other lookup takes a
    plain equi-join. Adaptive execution measures the shuffled keys and cuts the partitions that are really skewed, so a
    key (or the NULL key) that holds a large share of all rows is spread over many tasks, in as many pieces as its
    size asks for, and only the lookup rows of that partition are repeated.

    A lookup that was not measured is written once and counted in the same job, so what it is derived from is
    not computed again by the join. ``bounded`` passes on an earlier measurement, or its outcome.
    """
    on = list(on)
    if bounded is None:
        lookup, bounded = materialize_measured(lookup, "lookup")
    if isinstance(bounded, Size):
        bounded = fits_broadcast(bounded)
    return large.join(F.broadcast(lookup) if bounded else lookup, on, how)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    group_rows: int | None = None,
    bounded: bool = False,
) -> DataFrame:
    """``row_number`` within groups that no single task has to sort as a whole.

    The rows are written once, so that they are not computed again for the measurement. If there are more than a task may sort, the
    largest group is measured; groups of moderate size take a plain window. If one is larger, rows are range-partitioned on (keys, order), numbered inside each range, and shifted
    by the number of rows of the same group in earlier ranges. ``bounded`` tells that the whole
    frame was measured to be small.
    """
    keys = list(keys)
    limit = GROUP_ROWS if group_rows is None else group_rows
    largest = 0
    if not bounded:
        df, size = materialize_measured(df, "numbered")
        if size.rows > limit:
            largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    if largest is None or largest <= limit:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))

    ranged = df.repartitionByRange(*[column(k) for k in keys], *order).withColumn(
        "__range", F.spark_partition_id()
    )
    # The range of a row must not change between the two uses below.
    ranged = materialize(ranged, "ranges")
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*keys, "__range")
        .count()
        .withColumn("__offset", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    inside = Window.partitionBy(*keys, "__range").orderBy(*order)
    numbered = ranged.withColumn("__inside", F.row_number().over(inside))
    null_safe = [numbered[k].eqNullSafe(offsets[k]) for k in [*keys, "__range"]]
    joined = numbered.join(offsets, null_safe, "left")
    kept = [numbered[c] for c in df.columns]
    return joined.select(*kept, (F.col("__offset") + F.col("__inside")).cast("int").alias(name))
