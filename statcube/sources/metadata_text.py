"""Metadata files: one text file per cube with several delimited sections.

A whole lake of files is parsed in one map-only job: a file is cut into sections and records by
regular expressions, and every record becomes a map from section header to field.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statcube.functions import expressions as X
from statcube.functions.names import names_for

# A record ends at a line break outside quotes. Possessive loops keep long texts linear.
_RECORD = r'[^"\n]*+(?:"[^"]*+"[^"\n]*+)*+'
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_NOTE = r'^"?(\d+)"?'
_PRODUCT = r"^\d{8}(\d{2})?$"


@dataclass(frozen=True)
class MetadataSections:
    """Records of all files; every frame starts with the source ``file``."""

    cube: DataFrame
    dimensions: DataFrame
    members: DataFrame
    surveys: DataFrame
    subjects: DataFrame
    notes: DataFrame
    corrections: DataFrame


def _field(name: str, alias: str) -> Column:
    return F.try_element_at("fields", F.lit(name)).alias(alias)


def parse_cube_metadata(spark: SparkSession, path: str, language: str = "eng") -> MetadataSections:
    """Read all metadata files below ``path``.

    Sections are recognized by their header line. Blank lines at their ends, columns without a
    header and curly quotes are cleaned.
    """
    n = names_for(language)
    starts = "|".join(
        [
            f'"{n.dimension_id}"',
            n.symbol_legend,
            f'"{n.symbol_legend}',
            f'"{n.survey_code}"',
            f'"{n.subject_code}"',
            f'"{n.note_id}"',
            f'"{n.correction_id}"',
        ]
    )
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    text = F.regexp_replace(X.straight_quotes(F.col("value")), "\r\n?", "\n")
    text = F.regexp_replace(text, "^﻿", "")
    sections = files.select(
        F.col("_metadata.file_path").alias("file"),
        F.explode(F.split(text, rf"\n(?=(?:{starts}))")).alias("section"),
    )
    records = sections.select(
        "file",
        F.filter(
            F.regexp_extract_all("section", F.lit(_RECORD), F.lit(0)), lambda r: F.trim(r) != ""
        ).alias("records"),
    ).filter(F.size("records") > 0)
    titled = records.select("file", "records", F.col("records")[0].alias("title"))
    def fields(record: str) -> Column:
        """Fields of a record; quoted ones are unquoted, empty ones are missing."""
        d = n.delimiter
        raw = F.regexp_extract_all(
            F.concat(F.lit(d), F.col(record)), F.lit(f"{d}({_QUOTED}|[^{d}]*+)"), F.lit(1)
        )
        return F.transform(
            raw,
            lambda f: F.nullif(
                F.when(
                    f.startswith('"'),
                    F.replace(F.regexp_replace(f, '^"|"$', ""), F.lit('""'), F.lit('"')),
                ).otherwise(f),
                F.lit(""),
            ),
        )

    def table(condition: Column) -> DataFrame:
        rows = titled.filter(condition).select(
            "file", fields("title").alias("names"), F.posexplode("records").alias("pos", "record")
        )
        # Columns without a header are dropped; of repeated headers the first counts.
        pairs = F.filter(
            F.zip_with("names", fields("record"), lambda k, v: F.struct(k.alias("key"), v.alias("value"))),
            lambda c, i: c["key"].isNotNull() & (F.array_position("names", c["key"]) == i + 1),
        )
        return rows.filter("pos > 0").select("file", "pos", F.map_from_entries(pairs).alias("fields"))

    title = F.col("title")
    is_dimension = title.startswith(f'"{n.dimension_id}"')
    is_member = is_dimension & title.contains(n.member_name)
    known = title.rlike(rf"^(?:{starts})")
    notes = (
        titled.filter(title.startswith(f'"{n.note_id}"'))
        .select("file", F.posexplode("records").alias("pos", "record"))
        .filter("pos > 0")
        .select(
            "file",
            F.regexp_extract("record", _NOTE, 1).alias("note_id"),
            F.regexp_replace(
                F.regexp_replace("record", rf"{_NOTE}[{n.delimiter}]", ""), r'^"|"$', ""
            ).alias("note"),
        )
    )
    dimensions = table(is_dimension & ~is_member)
    members = table(is_member)
    return MetadataSections(
        cube=table(~known),
        dimensions=dimensions.select(
            "file",
            _field(n.dimension_id, "dim_id").try_cast("int").alias("dim_id"),
            _field(n.dimension_name, "dim_name"),
            _field(n.dimension_notes, "note_ids"),
        ),
        members=members.select(
            "file",
            _field(n.dimension_id, "dim_id").try_cast("int").alias("dim_id"),
            _field(n.member_id, "member_id"),
            _field(n.member_name, "member_name"),
            _field(n.parent_member_id, "parent_id"),
            _field(n.code_column, "code"),
            _field(n.terminated, "terminated"),
            _field(n.member_notes, "note_ids"),
        ),
        surveys=table(title.startswith(f'"{n.survey_code}"')),
        subjects=table(title.startswith(f'"{n.subject_code}"')),
        notes=notes,
        corrections=table(title.startswith(f'"{n.correction_id}"')),
    )


def cube_members_of(sections: MetadataSections, cube_id: str | None = None) -> DataFrame:
    """Members of all files in the column set of the member operators.

    Every file belongs to the cube that its cube section names; give ``cube_id`` only for the files of one cube.
    """
    names = sections.dimensions.select("file", "dim_id", "dim_name")
    members = sections.members.join(names, ["file", "dim_id"])
    if cube_id is not None:
        members = members.withColumn("cube_id", F.lit(cube_id))
    else:
        # The heading of the id differs by language; it is the first field of eight or ten digits.
        named = F.get(F.filter(F.map_values("fields"), lambda v: v.rlike(_PRODUCT)), F.lit(0))
        owner = sections.cube.groupBy("file").agg(X.clean_cube_id(F.min_by(named, "pos")).alias("cube_id"))
        members = members.join(owner, "file")
    return members.select(
        "cube_id",
        "dim_id",
        "dim_name",
        "member_id",
        "member_name",
        "parent_id",
        "code",
        "terminated",
    )
