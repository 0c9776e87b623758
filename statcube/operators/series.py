"""Selection of time series: by vector, by coordinate, by period range, latest N, templates."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statcube.functions import expressions as X
from statcube.functions.names import CUBE_ID, column, names_for
from statcube.operators.joins import fits_broadcast, lookup_join, number_rows
from statcube.operators.members import member_order
from statcube.sources.scratch import materialize, materialize_measured

BATCH_SIZE = 300
# Up to this N Spark cuts every task to the first N rows per series before the shuffle.
GROUP_LIMIT = 1000


def select_vectors(df: DataFrame, vectors: Iterable[str | int] | Mapping[str, str] | DataFrame) -> DataFrame:
    """Rows of the given vectors; a leading ``v`` is optional.

    Names on the list (a mapping label -> vector) add a ``label`` column.
    """
    if isinstance(vectors, DataFrame):
        wanted = vectors.select(
            F.concat(F.lit("v"), X.bare_vector(column(vectors.columns[0]).cast("string"))).alias("VECTOR")
        ).distinct()
        return lookup_join(df, wanted, ["VECTOR"], "left_semi")
    named = vectors if isinstance(vectors, Mapping) else None
    ids = ["v" + str(v).removeprefix("v") for v in (named.values() if named else vectors)]
    chosen = df.filter(F.col("VECTOR").isin(ids))
    return label_series(chosen, named) if named else chosen


def label_series(df: DataFrame, vectors: Mapping[str, str]) -> DataFrame:
    """Add ``label`` from a mapping label -> vector; unnamed vectors keep their id."""
    return df.withColumn("label", X.series_label(F.col("VECTOR"), vectors))


def request_frame(spark: SparkSession, requests: Mapping[str, Sequence[str]]) -> DataFrame:
    """(cube, coordinate) rows of a mapping cube -> coordinates."""
    rows = [(cube, c) for cube, coordinates in requests.items() for c in coordinates]
    if not rows or len(rows) > 1000:
        return spark.createDataFrame(rows, f"{CUBE_ID} string, COORDINATE string")
    # A short list is part of the plan, which spares the start of Python workers.
    cells = [F.struct(F.lit(a).alias(CUBE_ID), F.lit(b).alias("COORDINATE")) for a, b in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*cells)))


def normalize_requests(requests: DataFrame, periods: int | None = None) -> DataFrame:
    """Requests with clean cube id, padded coordinate, census flag and number of periods (NULL: all).

    Of repeated requests the one for the most periods counts.
    """
    wanted = F.col("periods") if "periods" in requests.columns else F.lit(periods).cast("int")
    return requests.groupBy(
        X.clean_cube_id(F.col(CUBE_ID)).alias(CUBE_ID),
        X.pad_coordinate(F.col("COORDINATE")).alias("COORDINATE"),
    ).agg(F.when(F.count_if(wanted.isNull()) == 0, F.max(wanted)).cast("int").alias("periods")).withColumn(
        "is_census", X.is_census_cube(F.col(CUBE_ID))
    )


def sort_requests(requests: DataFrame) -> DataFrame:
    """Requests of regular cubes first, then by cube and coordinate."""
    return requests.orderBy(X.is_census_cube(F.col(CUBE_ID)), CUBE_ID, "COORDINATE")


def series_range(
    df: DataFrame, start: date | str | None = None, end: date | str | None = None, column_name: str = "REF_DATE"
) -> DataFrame:
    """Reference periods in [start, end], both ends included, compared as dates.

    The bounds also go to the scan as text: a period of any shape starts with a year, at most
    one before the year of its date. With a bound, periods of unknown shape, which have no date, are
    outside; ``undated_periods`` gives these rows.
    """
    result = df
    ref = column(column_name)
    day = X.reference_date(ref, "01", "01")
    if start is not None:
        result = result.filter(day >= F.lit(str(start)).cast("date"))
        result = result.filter(ref >= F.lit(f"{int(str(start)[:4]) - 1:04d}"))
    if end is not None:
        result = result.filter(day <= F.lit(str(end)).cast("date"))
        result = result.filter(ref < F.lit(f"{int(str(end)[:4]) + 1:04d}"))
    return result


def undated_periods(df: DataFrame, column_name: str = "REF_DATE") -> DataFrame:
    """Rows that no range of reference periods holds, as their period has no date."""
    return df.filter(X.reference_date(column(column_name), "01", "01").isNull())


def release_range(
    df: DataFrame, start: datetime | None = None, end: datetime | None = None, column_name: str = "releaseTime"
) -> DataFrame:
    """Rows released between two instants, both included; a bound that is not given does not limit.

    A release time that is text is wall-clock time of the publisher and is read as such. Rows without
    a release time are outside any bound.
    """
    time = column(column_name)
    if dict(df.dtypes)[column_name] == "string":
        time = X.release_instant(time)
    result = df
    if start is not None:
        result = result.filter(time >= F.lit(start))
    if end is not None:
        result = result.filter(time <= F.lit(end))
    return result


def latest_n(
    df: DataFrame,
    n: int | Column | None = None,
    series: Sequence[str] = ("VECTOR",),
    order: str = "REF_DATE",
    value: str | None = "VALUE",
    largest: int | None = None,
) -> DataFrame:
    """The last N periods with data of every series; None keeps all rows as they are.

    ``n`` may be a column that differs by series; ``largest`` is then its known maximum. For N up
    to 1000 Spark drops all but N rows per series in every task before the shuffle. Beyond that
    a series is cut into pieces by its periods, each piece is reduced on its own, and only the
    remains of the pieces meet.
    """
    if n is None:
        return df
    present = df if value is None else df.filter(column(value).isNotNull())
    newest = column(order).desc()
    limit = n if isinstance(n, Column) else F.lit(n)
    most = largest if isinstance(n, Column) else n

    def first_rows(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
        window = Window.partitionBy(*[column(k) for k in keys]).orderBy(newest)
        ranked = frame.withColumn("__rank", F.row_number().over(window))
        if most is not None and most <= GROUP_LIMIT:
            ranked = ranked.filter(F.col("__rank") <= most)
        return ranked.filter(F.col("__rank") <= limit).drop("__rank")

    if most is None or most > GROUP_LIMIT:
        # As many pieces as the shuffle has partitions, which is set by the size of the data.
        pieces = max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        piece = F.pmod(F.xxhash64(column(order)), F.lit(pieces))
        present = first_rows(present.withColumn("__piece", piece), [*series, "__piece"]).drop("__piece")
    return first_rows(present, series)


def select_coordinates(df: DataFrame, requests: DataFrame, language: str = "eng") -> DataFrame:
    """Latest periods of requested (cube, coordinate) series; coordinates may lack trailing zeros.

    A request without a number of periods gets all rows of its series as they are, whatever other requests ask for.
    """
    coordinate = names_for(language).coordinate
    wanted, size = materialize_measured(normalize_requests(requests), "requests")
    unlimited, largest = wanted.agg(F.count_if(F.col("periods").isNull()), F.max("periods")).first()
    lookup = wanted.select(
        CUBE_ID, X.strip_coordinate(F.col("COORDINATE")).alias("__series"), F.col("periods").alias("__periods")
    )
    keyed = df.withColumn("__series", X.strip_coordinate(column(coordinate)))
    bounded = fits_broadcast(size)
    key = [CUBE_ID, "__series"]
    n = names_for(language)
    value = n.value if n.value in df.columns else None
    parts = []
    if unlimited or largest is None:
        whole = lookup.filter(F.col("__periods").isNull())
        parts.append(lookup_join(keyed, whole, key, "inner", bounded=bounded))
    if largest is not None:
        limited = lookup.filter(F.col("__periods").isNotNull())
        found = lookup_join(keyed, limited, key, "inner", bounded=bounded)
        parts.append(latest_n(found, F.col("__periods"), key, n.ref_date, value, largest))
    chosen = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return chosen.select(*[column(c) for c in df.columns])


def missing_series(df: DataFrame, requests: DataFrame) -> DataFrame:
    """Requested series without an answer and what that implies.

    A census cube publishes no zeros, so its missing series mean zero; elsewhere they are unknown.
    """
    key = [CUBE_ID, "COORDINATE"]
    wanted, size = materialize_measured(normalize_requests(requests), "requests")
    # The facts are narrowed to the requests before they are made distinct.
    found = df.select(
        X.clean_cube_id(F.col(CUBE_ID)).alias(CUBE_ID),
        X.pad_coordinate(F.col("COORDINATE")).alias("COORDINATE"),
    )
    found = lookup_join(found, wanted.select(*key), key, "left_semi", bounded=fits_broadcast(size)).distinct()
    return (
        wanted.join(found, key, "left_anti")
        .select(
            CUBE_ID,
            "COORDINATE",
            "is_census",
            F.when(F.col("is_census"), F.lit(0.0)).alias("implied_value"),
        )
    )


def batch_ids(
    requests: DataFrame, size: int = BATCH_SIZE, group_rows: int | None = None
) -> DataFrame:
    """Number requests of a cube in batches of fixed size, in coordinate order."""
    ordered = number_rows(requests, [CUBE_ID], [F.col("COORDINATE")], "__n", group_rows)
    return ordered.withColumn("batch", F.ceil(F.col("__n") / size).cast("bigint")).drop("__n")


def cube_template(
    members: DataFrame,
    cube_id: str,
    language: str = "eng",
    keep: Mapping[str, Sequence[str] | Column] | None = None,
) -> DataFrame:
    """Every combination of members of a cube with its coordinate, without values.

    Combinations are numbered 0..N-1 and each number is decoded into one member per dimension,
    so tasks get equal shares whatever the sizes of the dimensions are, and no pairs are formed.
    ``keep`` restricts dimensions (names, or a condition on the member columns) before the
    product.
    """
    spark = members.sparkSession
    own = members.filter(F.col(CUBE_ID) == cube_id)
    for name, rule in (keep or {}).items():
        condition = rule if isinstance(rule, Column) else F.col("member_name").isin(list(rule))
        own = own.filter((F.col("dim_name") != name) | condition)
    distinct = own.select("dim_id", "dim_name", "member_id", "member_name").distinct()
    order = [member_order(), F.col("member_id"), F.col("member_name")]
    chosen, size = materialize_measured(distinct, "template")
    bounded = fits_broadcast(size)
    numbered = materialize(number_rows(chosen, ["dim_id"], order, "n", bounded=bounded), "template")
    sizes = {r.dim_id: r["count"] for r in numbered.groupBy("dim_id").count().collect()}
    every = members.filter(F.col(CUBE_ID) == cube_id) if keep else numbered
    # At most ten positions.
    dimensions = every.select("dim_id", "dim_name").distinct().orderBy("dim_id").collect()

    total = math.prod(sizes.get(d.dim_id, 0) for d in dimensions) if dimensions else 0
    tasks = max(spark.sparkContext.defaultParallelism, total // 2_000_000)
    result = spark.range(0, total, 1, int(tasks)).withColumnRenamed("id", "__i")
    stride = total
    for d in dimensions:
        n = max(sizes.get(d.dim_id, 0), 1)
        stride = max(stride // n, 1)
        lookup = numbered.filter(F.col("dim_id") == d.dim_id).select(
            F.col("n").alias("__n"),
            F.col("member_name").alias(d.dim_name),
            F.col("member_id").alias(f"__id{d.dim_id}"),
        )
        keyed = result.withColumn("__n", F.expr(f"CAST((__i div {stride}) % {n} AS INT) + 1"))
        result = lookup_join(keyed, lookup, ["__n"], "inner", bounded=bounded).drop("__n")
    ids = [F.col(f"__id{d.dim_id}") for d in dimensions]
    return result.select(
        F.lit(cube_id).alias(CUBE_ID),
        F.concat_ws(".", *ids).alias("COORDINATE"),
        *[column(d.dim_name) for d in dimensions],
    )


def attach_series(template: DataFrame, series_info: DataFrame) -> DataFrame:
    """Add the vector of each template row, matched on (cube, coordinate without trailing zeros)."""
    for needed in (CUBE_ID, "COORDINATE"):
        if needed not in template.columns:
            raise ValueError(f"A template needs a column {needed}")
    if template.isEmpty():
        raise ValueError("The template is empty")
    info = series_info.select(
        CUBE_ID, X.strip_coordinate(F.col("COORDINATE")).alias("COORDINATE"), "VECTOR"
    )
    front = [CUBE_ID, "COORDINATE"]
    rest = [c for c in template.columns if c not in front]
    joined = template.join(info, front, "left")
    return joined.select(*front, "VECTOR", *[column(c) for c in rest])


def select_series_info(series_info: DataFrame, cube_id: str, coordinates: DataFrame) -> DataFrame:
    """Series records of requested coordinates; invalid combinations are dropped."""
    wanted = coordinates.select(X.pad_coordinate(F.col("COORDINATE")).alias("coordinate")).distinct()
    return (
        series_info.filter(X.clean_cube_id(F.col("productId").cast("string")) == cube_id)
        .filter(F.coalesce(F.col("responseStatusCode") != 2, F.lit(True)))
        .withColumn("coordinate", X.pad_coordinate(F.col("coordinate")))
        .join(wanted, "coordinate", "left_semi")
        .drop("responseStatusCode")
    )
