"""JSON records of the data service, landed as files.

Schemas are explicit, so nothing is inferred and only the fields that are used are parsed.
JSON lines are split over tasks; set ``multi_line`` for files that hold one array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statcube.functions import expressions as X
from statcube.functions.names import CUBE_ID, column

SUCCESS = "SUCCESS"

# --- fixed values: record formats of the service ------------------------------------------------
_MEMBER = (
    "memberId int, parentMemberId int, memberNameEn string, memberNameFr string, "
    "classificationCode string, geoLevel int, terminated int"
)
_NOTE_LINK = "footnoteId int, dimensionPositionId int, memberId int"
METADATA_OBJECT = (
    "productId string, cubeTitleEn string, cubeTitleFr string, cubeStartDate string, "
    "cubeEndDate string, nbSeriesCube bigint, nbDatapointsCube bigint, archiveStatusCode string, "
    "archiveStatusEn string, archiveStatusFr string, frequencyCode int, releaseTime string, "
    "subjectCode array<string>, surveyCode array<string>, "
    "dimension array<struct<dimensionPositionId int, dimensionNameEn string, "
    f"dimensionNameFr string, member array<struct<{_MEMBER}>>>>, "
    "footnote array<struct<footnoteId int, footnotesEn string, footnotesFr string, "
    "link string>>, "
    "correctionFootnote array<struct<correctionId int, correctionDate string, "
    "correctionNoteEn string, correctionNoteFr string>>"
)
OBSERVATION_OBJECT = (
    "responseStatusCode int, productId bigint, coordinate string, vectorId bigint, "
    "vectorDataPoint array<struct<refPer string, refPer2 string, value double, decimals int, "
    "scalarFactorCode int, symbolCode int, frequencyCode int, releaseTime string>>"
)
SERIES_OBJECT = (
    "responseStatusCode int, productId bigint, coordinate string, vectorId bigint, decimals int, "
    "SeriesTitleEn string, SeriesTitleFr string, memberUomCode int, frequencyCode int, "
    "scalarFactorCode int"
)
CATALOG_RECORD = (
    "productId string, cubeTitleEn string, cubeTitleFr string, cubeStartDate string, "
    "cubeEndDate string, releaseTime string, archived string, subjectCode array<string>, "
    "surveyCode array<string>, frequencyCode int, issueDate string, "
    "dimensions array<struct<dimensionNameEn string, dimensionNameFr string>>"
)
CODE_SETS = {
    "scalar": "scalarFactorCode string, scalarFactorDescEn string, scalarFactorDescFr string",
    "frequency": "frequencyCode string, frequencyDescEn string, frequencyDescFr string",
    "symbol": "symbolCode string, symbolRepresentationEn string, symbolRepresentationFr string, "
    "symbolDescEn string, symbolDescFr string",
    "status": "statusCode string, statusRepresentationEn string, statusRepresentationFr string, "
    "statusDescEn string, statusDescFr string",
    "uom": "memberUomCode string, memberUomEn string, memberUomFr string",
    "survey": "surveyCode string, surveyEn string, surveyFr string",
    "subject": "subjectCode string, subjectEn string, subjectFr string",
    "wdsResponseStatus": "codeId string, codeTextEn string, codeTextFr string",
}
# --- end of fixed values ------------------------------------------------------------------------


def read_records(
    spark: SparkSession,
    path: str,
    object_schema: str,
    multi_line: bool = False,
    more_fields: Sequence[str] = (),
) -> DataFrame:
    """Records ``{status, object}``; ``more_fields`` adds fields ("name type") of the object."""
    inside = ", ".join([object_schema, *more_fields])
    schema = f"status string, object struct<{inside}>"
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def route_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into successful records and failures; failures carry the text of their code."""
    succeeded = F.coalesce(F.col("status") == SUCCESS, F.lit(False))
    failures = records.filter(~succeeded)
    if "responseStatusCode" in records.select("object.*").columns:
        failures = failures.withColumn("reason", X.response_text(F.col("object.responseStatusCode")))
    return records.filter(succeeded), failures


def cube_overviews(records: DataFrame) -> DataFrame:
    """Scalar fields of the cubes; survey and subject codes joined to lists."""
    cubes = route_records(records)[0].select("object.*")
    lists = {"surveyCode", "subjectCode"}
    kept = []
    for name, kind in cubes.dtypes:
        if name in lists:
            kept.append(F.array_join(name, ", ").alias(name))
        elif name == "productId":
            kept.append(X.clean_cube_id(F.col(name)).alias(name))
        elif name == "releaseTime":
            kept.append(X.release_instant(F.col(name)).alias(name))
        elif not kind.startswith(("array", "struct")):
            kept.append(column(name))
    return cubes.select(*kept)


def cube_member_rows(records: DataFrame) -> DataFrame:
    """One row per cube, dimension and member, both languages, ids as text."""
    return (
        route_records(records)[0]
        .select(F.col("object.productId").alias("productId"), F.inline("object.dimension"))
        .select(
            X.clean_cube_id(F.col("productId")).alias(CUBE_ID),
            "dimensionPositionId",
            "dimensionNameEn",
            "dimensionNameFr",
            F.inline("member"),
        )
        .withColumns(
            {
                c: F.col(c).cast("string")
                for c in ("dimensionPositionId", "memberId", "parentMemberId", "geoLevel", "terminated")
            }
        )
    )


def members_for_language(rows: DataFrame, language: str = "eng") -> DataFrame:
    """Member rows in the column set of the member operators."""
    suffix = "Fr" if language == "fra" else "En"
    return rows.select(
        CUBE_ID,
        F.col("dimensionPositionId").cast("int").alias("dim_id"),
        F.col(f"dimensionName{suffix}").alias("dim_name"),
        F.col("memberId").alias("member_id"),
        F.col(f"memberName{suffix}").alias("member_name"),
        F.col("parentMemberId").alias("parent_id"),
        F.col("classificationCode").alias("code"),
        "terminated",
    )


def cube_notes(records: DataFrame) -> DataFrame:
    """Distinct notes of the cubes with the dimension and member they are linked to."""
    notes = route_records(records)[0].select(
        X.clean_cube_id(F.col("object.productId")).alias(CUBE_ID), F.inline("object.footnote")
    )
    # A note with one link may hold it as a record instead of a list; both are read as a list.
    links = F.from_json("link", f"array<struct<{_NOTE_LINK}>>")
    # Links that carry another note's id do not belong to the note.
    own = F.filter(links, lambda l: l["footnoteId"] == F.col("footnoteId"))
    return (
        notes.select(CUBE_ID, "footnoteId", "footnotesEn", "footnotesFr", F.explode_outer(own).alias("l"))
        .select(
            CUBE_ID,
            F.col("footnoteId").cast("string").alias("footnoteId"),
            "footnotesEn",
            "footnotesFr",
            F.col("l.dimensionPositionId").cast("string").alias("dimensionPositionId"),
            F.col("l.memberId").cast("string").alias("memberId"),
        )
        .distinct()
    )


def cube_corrections(records: DataFrame) -> DataFrame:
    return route_records(records)[0].select(
        X.clean_cube_id(F.col("object.productId")).alias(CUBE_ID), F.inline("object.correctionFootnote")
    )


def observation_rows(records: DataFrame, with_second_period: bool | None = None) -> DataFrame:
    """One row per data point; a series without points gives no row.

    The second reference period is dropped if it is empty throughout; pass
    ``with_second_period`` to decide this without looking at the data.
    """
    rows = (
        route_records(records)[0]
        .select(
            F.col("object.productId").alias("productId"),
            F.col("object.coordinate").alias("COORDINATE"),
            F.col("object.vectorId").alias("vectorId"),
            F.inline("object.vectorDataPoint"),
        )
        .select(
            F.col("decimals").alias("DECIMALS"),
            F.col("value").alias("VALUE"),
            F.col("refPer").alias("REF_DATE"),
            F.col("refPer2").alias("REF_DATE_2"),
            "releaseTime",
            F.col("symbolCode").alias("SYMBOL"),
            "frequencyCode",
            F.col("scalarFactorCode").alias("SCALAR_ID"),
            "COORDINATE",
            X.vector_name(F.col("vectorId")).alias("VECTOR"),
            X.clean_cube_id(F.col("productId").cast("string")).alias(CUBE_ID),
        )
    )
    keep = with_second_period
    if keep is None:
        keep = not rows.filter(F.coalesce(F.col("REF_DATE_2") != "", F.lit(True))).isEmpty()
    return rows if keep else rows.drop("REF_DATE_2")


def series_info_rows(records: DataFrame) -> DataFrame:
    """One row per series: vector, cube, coordinate without trailing zeros, titles, codes."""
    series = route_records(records)[0].select("object.*")
    return series.select(
        F.col("decimals").alias("DECIMALS"),
        F.concat(F.lit("v"), F.col("vectorId").cast("string")).alias("VECTOR"),
        X.clean_cube_id(F.col("productId").cast("string")).alias("table"),
        X.strip_coordinate(F.col("coordinate")).alias("COORDINATE"),
        F.col("SeriesTitleEn").alias("title_en"),
        F.col("SeriesTitleFr").alias("title_fr"),
        F.col("memberUomCode").alias("UOM"),
        "frequencyCode",
        F.col("scalarFactorCode").alias("SCALAR_ID"),
        F.col("SeriesTitleEn").alias("title"),
    )


def read_catalog(
    spark: SparkSession, path: str, lite: bool = False, multi_line: bool = False, more_fields: Sequence[str] = ()
) -> DataFrame:
    """Published cubes; ``lite`` leaves out the dimension names."""
    schema = ", ".join([CATALOG_RECORD, *more_fields])
    return catalog_rows(spark.read.schema(schema).option("multiLine", multi_line).json(path), lite)


def catalog_rows(raw: DataFrame, lite: bool = False) -> DataFrame:
    """Typed catalog rows: joined code lists, dates, release instant, archived flag."""
    kept = []
    for name, kind in raw.dtypes:
        if name == "dimensions" or name in ("cubeTitleEn", "cubeTitleFr"):
            continue
        if kind == "array<string>":
            kept.append(F.array_join(name, ", ").alias(name))
        elif name.endswith("Date"):
            kept.append(F.try_to_date(F.substring(name, 1, 10), "yyyy-MM-dd").alias(name))
        elif name == "releaseTime":
            kept.append(X.release_instant(F.substring(name, 1, 16)).alias(name))
        elif name == "archived":
            kept.append((F.col(name).try_cast("int") == 1).alias(name))
        else:
            kept.append(column(name))
    names = []
    if not lite and "dimensions" in raw.columns:
        # A field of an array of structs is the array of that field.
        for field in ("dimensionNameEn", "dimensionNameFr"):
            names.append(F.array_join(f"dimensions.{field}", ", ").alias(field))
    return raw.select(
        X.clean_cube_id(F.col("productId")).alias(CUBE_ID), "cubeTitleEn", "cubeTitleFr", *kept, *names
    )


def read_code_set(spark: SparkSession, path: str, code_set: str, multi_line: bool = True) -> DataFrame:
    """One of the eight code sets; the text ``NULL`` means missing."""
    if code_set not in CODE_SETS:
        raise ValueError(f"Unknown code set; there are {', '.join(CODE_SETS)}")
    schema = f"object struct<{code_set} array<struct<{CODE_SETS[code_set]}>>>"
    rows = (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .json(path)
        .select(F.inline(f"object.{code_set}"))
    )
    return rows.select(*[F.nullif(F.col(c), F.lit("NULL")).alias(c) for c in rows.columns])


def read_release_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Release instants of cubes from records ``{productid, result: [{releasedate}]}``."""
    schema = "productid string, result array<struct<releasedate string>>"
    raw = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return raw.select(
        X.clean_cube_id(F.col("productid")).alias(CUBE_ID), F.inline("result")
    ).select(
        CUBE_ID,
        F.try_to_timestamp(
            F.concat(F.substring("releasedate", 1, 16), F.lit(" UTC")), F.lit("yyyy-MM-dd'T'HH:mm VV")
        ).alias("releaseTime"),
    )


def read_release_schedule(
    spark: SparkSession, path: str, fields: str = "date string, title string", multi_line: bool = True
) -> DataFrame:
    """Scheduled releases with ``date`` as a date; ``fields`` lists the flat fields to read."""
    raw = spark.read.schema(fields).option("multiLine", multi_line).json(path)
    return raw.withColumn("date", F.try_to_date(F.substring("date", 1, 10), "yyyy-MM-dd"))
