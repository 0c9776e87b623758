"""Delimited cube extracts: header repair, all-text scan, null tokens."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from statcube.functions import expressions as X
from statcube.functions.names import column, names_for
from statcube.sources.scratch import materialize

MALFORMED = "_corrupt_record"

# --- fixed values: spellings in published headers ----------------------------------------------
_SYMBOL_NAMES = (("Symbol",), ("Symbols", "Symboles"))
_COORDINATE_SPELLINGS = ("Coordonnées", "Coordonnée")
# --- end of fixed values -----------------------------------------------------------------------


def repair_header(header: list[str], language: str = "eng") -> list[str]:
    """Number repeated symbol columns and bring the coordinate column to its canonical name."""
    n = names_for(language)
    fixed = list(header)
    for spellings in _SYMBOL_NAMES:
        symbols = [i for i, c in enumerate(fixed) if c in spellings]
        if symbols:
            if len(symbols) > 1:
                for number, i in enumerate(symbols, start=1):
                    fixed[i] = f"Symbol {number}"
            break
    if n.coordinate not in fixed:
        hits = [i for i, c in enumerate(fixed) if n.coordinate.lower() in c.lower()]
        hits = hits or [i for i, c in enumerate(fixed) if c in _COORDINATE_SPELLINGS]
        if len(hits) == 1:
            fixed[hits[0]] = n.coordinate
    return fixed


def read_header(spark: SparkSession, path: str, language: str = "eng") -> list[str]:
    """Repaired names from the first line of an extract."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"No header in {path}")
    line = first[0].removeprefix("﻿")
    return repair_header(next(csv.reader([line], delimiter=names_for(language).delimiter)), language)


def read_cube_csv(
    spark: SparkSession,
    path: str,
    language: str = "eng",
    header: list[str] | None = None,
    missing: tuple[str, ...] = X.MISSING_TOKENS,
    multi_line: bool = False,
    quarantine: bool = False,
    first_line: bool = True,
) -> DataFrame:
    """Scan an extract with every column as text and the null tokens replaced.

    The schema comes from the header, so Spark infers nothing and the files are read once, in
    splits. Pass ``header`` when a folder holds several files of one cube, and ``first_line=False`` if files do not begin with it. ``multi_line`` reads quoted fields with
    line breaks; a file is then not split. A record with more or fewer fields than the header ends the job, or, with
    ``quarantine``, is marked: its text is in ``_corrupt_record``, see ``well_formed`` and ``malformed``. The parsed
    records are then written once, as Spark can't be asked for the marks of raw files alone.
    """
    names = header or read_header(spark, path, language)
    kept = [*names, MALFORMED] if quarantine else names
    schema = T.StructType([T.StructField(c, T.StringType()) for c in kept])
    raw = (
        spark.read.schema(schema)
        .option("header", first_line)
        .option("enforceSchema", True)
        .option("sep", names_for(language).delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE" if quarantine else "FAILFAST")
        .option("columnNameOfCorruptRecord", MALFORMED)
        # The shape of a record is checked whatever columns are asked for.
        .option("columnPruning", False)
        .csv(path)
    )
    marked = [column(MALFORMED)] if quarantine else []
    if quarantine:
        raw = materialize(raw, "extract")
    return raw.select(*[X.null_if_missing(column(c), missing).alias(c) for c in names], *marked)


def well_formed(extract: DataFrame) -> DataFrame:
    """The records of a quarantine scan that fit the header."""
    return extract.filter(column(MALFORMED).isNull()).drop(MALFORMED)


def malformed(extract: DataFrame) -> DataFrame:
    """The text of the records that do not fit the header."""
    return extract.filter(column(MALFORMED).isNotNull()).select(MALFORMED)
