"""Questions analysts ask of a cube: sums, roll-ups, shares, indexes, top categories, differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statcube.functions.names import column
from statcube.operators.joins import lookup_join
from statcube.sources.scratch import materialize, materialize_measured


def sum_na_zero(c: Column) -> Column:
    """Sum that skips missing values; a group without any value gives 0."""
    return F.coalesce(F.sum(c), F.lit(0))


def sum_complete(c: Column) -> Column:
    """Sum that is missing as soon as one value of the group is missing."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def annualize_complete(df: DataFrame, keys: Sequence[str], value: str, periods: int = 12) -> DataFrame:
    """Roll up to groups that have all their periods and no missing value."""
    grouped = df.groupBy(*[column(k) for k in keys]).agg(
        sum_complete(column(value)).alias(value), F.count(F.lit(1)).alias("n")
    )
    return grouped.filter((F.col("n") == periods) & column(value).isNotNull())


def share_of_total(
    df: DataFrame, totals: DataFrame, keys: Sequence[str], value: str, total: str = "Total", share: str = "Share"
) -> DataFrame:
    """Attach the total of the row's keys and divide by it; a share of a zero total is NULL."""
    return lookup_join(df, totals.select(*[column(k) for k in keys], column(total)), keys).withColumn(
        share, F.try_divide(column(value), column(total))
    )


def index_to_base(
    df: DataFrame, keys: Sequence[str], value: str, period: str = "Date", name: str = "index"
) -> DataFrame:
    """Change against the first period of the group: ``value / first - 1``, NULL if the first is zero.

    The first value is an aggregate that is combined before the shuffle, so no group has to be
    sorted in one task.
    """
    first = df.groupBy(*[column(k) for k in keys]).agg(
        F.min_by(column(value), column(period)).alias("first_value")
    )
    joined = lookup_join(df, first, keys)
    return joined.withColumn(name, F.try_divide(column(value), F.col("first_value")) - 1)


def top_k_ties(df: DataFrame, k: int, by: str) -> DataFrame:
    """Rows whose value is among the k largest, ties with the k-th included.

    The k-th value is found with a distributed top-k; the rows are then a plain filter.
    """
    best = df.select(column(by).alias("v")).filter(F.col("v").isNotNull()).orderBy(F.desc("v")).limit(k)
    return df.filter(column(by) >= best.agg(F.min("v")).scalar())


def top_k_rest(
    df: DataFrame,
    top: DataFrame,
    category: str,
    keys: Sequence[str],
    sums: Sequence[str],
    rest: str = "Rest",
) -> DataFrame:
    """Pool categories outside ``top`` (a frame with the category column) and sum per group."""
    flagged = top.select(column(category)).distinct().withColumn("__top", F.lit(True))
    joined = lookup_join(df, flagged, [category])
    pooled = joined.withColumn(category, F.when(F.col("__top"), column(category)).otherwise(F.lit(rest)))
    groups = [column(k) for k in [*keys, category]]
    return pooled.groupBy(*groups).agg(*[sum_na_zero(column(c)).alias(c) for c in sums])


DIFF_BUCKETS = 65_536


def _digested(df: DataFrame, keys: Sequence[str], compared: Sequence[str], buckets: int) -> DataFrame:
    """Rows with ``__key`` (the keys as text, so that a missing key is a key like any other), ``__bucket`` and two row hashes."""
    key = F.to_json(F.struct(F.lit(0).alias("__"), *[column(k) for k in keys]), {"ignoreNullFields": "false"})
    cells = [x for c in compared for x in (column(c), column(c).isNull())]
    with_key = df.select(key.alias("__key"), *[column(c) for c in compared])
    return with_key.withColumns(
        {
            "__bucket": F.pmod(F.xxhash64("__key"), F.lit(buckets)),
            "__first": F.xxhash64(F.lit(1), "__key", *cells),
            "__second": F.xxhash64(F.lit(2), "__key", *cells),
        }
    )


def _bucket_digests(rows: DataFrame, side: str) -> DataFrame:
    return rows.groupBy("__bucket").agg(
        F.struct(
            F.count(F.lit(1)), F.sum(F.col("__first").cast("decimal(38,0)")), F.sum(F.col("__second").cast("decimal(38,0)"))
        ).cast("struct<n:bigint,a:decimal(38,0),b:decimal(38,0)>").alias(side)
    )


def changed_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Buckets (``__bucket``) whose digests differ; at most one small row per bucket is shuffled for each task."""
    both = _bucket_digests(left, "l").join(_bucket_digests(right, "r"), "__bucket", "full")
    return both.filter(~F.col("l").eqNullSafe(F.col("r"))).select("__bucket")


def diff_tables(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = DIFF_BUCKETS) -> DataFrame:
    """Number of differing cells per common column; missing values do not count as different.

    ``only_left`` and ``only_right`` count the rows whose keys the other side lacks. Keys identify the rows of a side; a missing key equals a missing
    key. Both sides are first reduced to order-free digests per bucket of keys, then the rows of buckets that differ to digests per row; only rows that
    differ or stand alone are joined (all, where a column has another type on the other side). Each side is read up to three times, so it should be stored.
    """
    compared = [c for c in left.columns if c in right.columns and c not in keys]
    a, b = (_digested(df, keys, compared, buckets) for df in (left, right))
    suspects = materialize(changed_buckets(a, b), "buckets")
    narrow = [lookup_join(df.select("__bucket", "__key", "__first", "__second"), suspects, ["__bucket"], "left_semi") for df in (a, b)]
    sides = narrow[0].withColumn("__side", F.lit(1)).unionByName(narrow[1].withColumn("__side", F.lit(-1)))
    unequal = sides.groupBy("__key", "__first", "__second").agg(F.sum("__side").alias("n")).filter("n <> 0")
    chosen, size = materialize_measured(unequal.select("__key").distinct(), "unequal")
    here = F.lit(True)
    parts = []
    for df, side in ((a, "l"), (b, "r")):
        rows = lookup_join(df, chosen, ["__key"], "left_semi", bounded=size)
        parts.append(rows.select("__key", here.alias(f"__{side}"), *[column(c).alias(f"__{side}{i}") for i, c in enumerate(compared)]))
    joined = parts[0].join(parts[1], "__key", "full")
    return joined.agg(
        *[
            F.count_if(F.col(f"__l{i}") != F.col(f"__r{i}")).alias(c)
            for i, c in enumerate(compared)
        ],
        F.count_if(F.col("__r").isNull()).alias("only_left"),
        F.count_if(F.col("__l").isNull()).alias("only_right"),
    )


def missing_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of missing values per column, as an integrity check."""
    return df.agg(*[F.count_if(column(c).isNull()).alias(c) for c in columns or df.columns])
