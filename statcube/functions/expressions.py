"""Scalar rules of the cube model as pure Column expressions.

All of them stay inside whole-stage code generation. Raw text is never cast with a throwing
cast: ANSI mode is on by default, so ``try_cast``, ``get`` and ``try_to_date`` are used.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from statcube.functions.names import names_for

COORDINATE_PARTS = 10
PUBLISHER_ZONE = "America/Toronto"
MISSING_TOKENS = ("<NA>", "NA", "", "F")
CENSUS_PREFIX = "9810"

# --- fixed values: response codes of the data service ----------------------------------------
RESPONSE_TEXT = {
    0: "Success",
    1: "Invalid date",
    2: "Invalid cube and series combination",
    3: "Request failed",
    4: "Vector is invalid",
    5: "Cube product id is invalid",
    6: "Cube is currently being published. Please try again later.",
    7: "Cube is currently unavailable.",
    8: "Invalid number of reference periods",
}
# --- end of fixed values ---------------------------------------------------------------------


def literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


# --- values ----------------------------------------------------------------------------------


def null_if_missing(c: Column, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    return F.when(~c.isin(*tokens), c)


def to_number(c: Column) -> Column:
    return c.try_cast("double")


def scaled(value: Column, scalar_id: Column) -> Column:
    """Value in units: ``value * 10^scalar_id``."""
    return value * F.pow(F.lit(10.0), scalar_id.try_cast("int"))


def percent_to_rate(value: Column, uom: Column, language: str = "eng") -> Column:
    """Divide percentages by 100; an unknown unit leaves the value as it is."""
    return F.when(uom.startswith(names_for(language).percent_prefix), value / 100).otherwise(value)


# --- reference dates and release times -------------------------------------------------------


def reference_date(ref: Column, default_month: str = "07", default_day: str = "01") -> Column:
    """Date of a reference period, decided row by row from its shape.

    ``YYYY`` and ``YYYY/YYYY`` (second year) take the default month and day, ``YYYY-MM`` takes
    the default day, ``YYYY-MM-DD`` is kept, any other shape gives NULL.
    """

    def as_date(text: Column) -> Column:
        return F.try_to_date(text, "yyyy-MM-dd")

    month_day = F.lit(f"-{default_month}-{default_day}")
    return (
        F.when(ref.rlike(r"^\d{4}$"), as_date(F.concat(ref, month_day)))
        .when(ref.rlike(r"^\d{4}/\d{4}$"), as_date(F.concat(F.substring(ref, 6, 4), month_day)))
        .when(ref.rlike(r"^\d{4}-\d{2}$"), as_date(F.concat(ref, F.lit(f"-{default_day}"))))
        .when(ref.rlike(r"^\d{4}-\d{2}-\d{2}$"), as_date(ref))
    )


def release_instant(c: Column) -> Column:
    """``YYYY-MM-DDTHH:MM`` wall-clock time of the publisher -> instant, whatever the session zone."""
    return F.try_to_timestamp(
        F.concat(c, F.lit(f" {PUBLISHER_ZONE}")), F.lit("yyyy-MM-dd'T'HH:mm VV")
    )


def publisher_time(instant: Column) -> Column:
    """Instant -> wall-clock time of the publisher, as TIMESTAMP_NTZ."""
    return F.convert_timezone(F.current_timezone(), F.lit(PUBLISHER_ZONE), instant.cast("timestamp_ntz"))


# --- coordinates and vectors -----------------------------------------------------------------


def coordinate_parts(c: Column) -> Column:
    return F.split(c, r"[.]")


def coordinate_part(c: Column, position: int) -> Column:
    """Member id at a 1-based dimension position; NULL beyond the end."""
    return F.get(coordinate_parts(c), position - 1)


def pad_coordinate(c: Column) -> Column:
    """Extend with ``.0`` to ten positions; longer coordinates are kept."""
    parts = coordinate_parts(c)
    fill = F.array_repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(COORDINATE_PARTS) - F.size(parts)))
    return F.array_join(F.concat(parts, fill), ".")


def strip_coordinate(c: Column) -> Column:
    """Drop trailing ``.0`` positions only; ``1.10`` stays ``1.10``."""
    return F.regexp_replace(c, r"(\.0)+$", "")


def vector_name(vector_id: Column) -> Column:
    """``v<id>``; id 0 means that the series has no vector."""
    return F.nullif(F.concat(F.lit("v"), vector_id.cast("string")), F.lit("v0"))


def bare_vector(c: Column) -> Column:
    return F.regexp_replace(c, "^v", "")


def series_label(vector: Column, vectors: Mapping[str, str]) -> Column:
    """Label from a mapping label -> vector; vectors without one keep their id."""
    by_vector = {"v" + str(v).removeprefix("v"): label for label, v in vectors.items()}
    return F.coalesce(F.try_element_at(literal_map(by_vector), vector), vector)


# --- cube ids --------------------------------------------------------------------------------


def bare_cube_id(c: Column) -> Column:
    return F.regexp_replace(c, "-", "")


def clean_cube_id(c: Column) -> Column:
    """``AA-BB-CCCC`` of a current id, with or without dashes and derived-table suffix.

    An id of the old numbering has no such form and gives NULL; ``legacy_ids`` maps those.
    """
    d = bare_cube_id(c)
    return F.when(~is_legacy_id(c), F.concat_ws("-", F.substring(d, 1, 2), F.substring(d, 3, 2), F.substring(d, 5, 4)))


def is_legacy_id(c: Column) -> Column:
    """Ids of up to seven digits belong to the old numbering."""
    return F.length(bare_cube_id(c)) <= 7


def is_derived_id(c: Column) -> Column:
    """Ten-digit ids whose suffix is not 01 name derived tables, which are not published."""
    d = bare_cube_id(c)
    return (F.length(d) == 10) & (F.substring(d, 9, 2) != "01")


def is_census_cube(c: Column) -> Column:
    return bare_cube_id(c).startswith(CENSUS_PREFIX)


# --- codes, paths and labels -----------------------------------------------------------------


def geo_uid_from_dguid(c: Column) -> Column:
    return F.substring(c, 10, 2_147_483_647)


def without_brackets(c: Column) -> Column:
    return F.regexp_replace(c, r"[\[\]]", "")


def strip_code(c: Column) -> Column:
    """Remove a trailing `` [code]`` from a member label."""
    return F.regexp_replace(c, r" \[.+\]$", "")


def path_depth(path: Column) -> Column:
    """Number of ancestors in a dotted path; a missing path counts as depth 0."""
    return F.coalesce(F.size(coordinate_parts(path)) - 1, F.lit(0))


def path_leaf(path: Column) -> Column:
    return F.element_at(coordinate_parts(path), -1)


def path_ancestors(path: Column) -> Column:
    parts = coordinate_parts(path)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def path_prefixes(path: Column) -> Column:
    """Every root-first prefix of a path, itself included."""
    parts = coordinate_parts(path)
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), ".")
    )


def is_under(path: Column, root: str) -> Column:
    """Exact subtree test on dotted paths (``1.2`` does not hold ``1.25``)."""
    return (path == root) | path.startswith(root + ".")


def member_label(name: Column, code: Column, is_geography: Column) -> Column:
    return F.when(code.isNull() | is_geography, name).otherwise(F.concat_ws(" ", name, code))


def straight_quotes(c: Column) -> Column:
    return F.translate(c, "“”", '""')


def language_column(c: Column) -> Column:
    low = F.lower(c)
    return F.when(low.isin("english", "eng", "en"), F.lit("eng")).when(
        low.isin("french", "fra", "fr"), F.lit("fra")
    )


def response_text(code: Column) -> Column:
    return F.try_element_at(literal_map(RESPONSE_TEXT), code.cast("int"))


def not_matching(c: Column, pattern: str) -> Column:
    """Negated regular expression that keeps rows without a value."""
    return ~F.coalesce(c.rlike(pattern), F.lit(False))


def place_name(geo: Column) -> Column:
    """Place without its province: everything before the first ``, ``."""
    return F.regexp_replace(geo, ", .+", "")


def readable_size(size: Column) -> Column:
    """Bytes as text with 1024-based units and one digit, trailing zero dropped."""
    units = ("bytes", "Kb", "Mb", "Gb", "Tb", "Pb")

    def number(power: int) -> Column:
        rounded = F.round(size.cast("double") / float(1024**power), 1)
        whole = rounded == F.floor(rounded)
        return F.when(whole, rounded.cast("bigint").cast("string")).otherwise(rounded.cast("string"))

    steps = F.when(size < 1024, F.concat_ws(" ", number(0), F.lit(units[0])))
    for power in range(1, len(units) - 1):
        steps = steps.when(
            size < 1024 ** (power + 1), F.concat_ws(" ", number(power), F.lit(units[power]))
        )
    last = len(units) - 1
    return F.when(size.isNotNull(), steps.otherwise(F.concat_ws(" ", number(last), F.lit(units[last]))))
