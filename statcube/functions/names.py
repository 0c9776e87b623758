"""Column names of published cubes in both languages, and helpers on column-name lists.

Cube schemas are dynamic (dimension names *are* column names), so everything here works on
``df.columns`` on the driver; no data is touched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENGLISH = "eng"
FRENCH = "fra"

CUBE_ID = "cube_id"
DATE = "Date"
GEO_UID = "GeoUID"
NORMALIZED = "val_norm"


@dataclass(frozen=True)
class Names:
    """Every language-dependent column name of the long-cube format."""

    language: str
    delimiter: str
    ref_date: str
    geo: str
    value: str
    scalar_id: str
    scalar_factor: str
    uom: str
    coordinate: str
    code_column: str
    percent_prefix: str
    code_prefix: str
    hierarchy_prefix: str
    geography_names: tuple[str, ...]
    dimension_id: str
    dimension_name: str
    dimension_notes: str
    member_id: str
    member_name: str
    member_notes: str
    parent_member_id: str
    hierarchy: str
    terminated: str
    note_id: str
    cube_title: str
    start_period: str
    end_period: str
    frequency: str
    subject_code: str
    survey_code: str
    symbol_legend: str
    correction_id: str

    def code_for(self, dimension: str) -> str:
        return self.code_prefix + dimension

    def hierarchy_for(self, dimension: str) -> str:
        return self.hierarchy_prefix + dimension


# --- fixed values: names used by the publisher's files in each language ---------------------
_NAMES = {
    ENGLISH: Names(
        language=ENGLISH,
        delimiter=",",
        ref_date="REF_DATE",
        geo="GEO",
        value="VALUE",
        scalar_id="SCALAR_ID",
        scalar_factor="SCALAR_FACTOR",
        uom="UOM",
        coordinate="COORDINATE",
        code_column="Classification Code",
        percent_prefix="Percent",
        code_prefix="Classification Code for ",
        hierarchy_prefix="Hierarchy for ",
        geography_names=("Geography", "Geographic name", "Geography of origin"),
        dimension_id="Dimension ID",
        dimension_name="Dimension name",
        dimension_notes="Dimension Notes",
        member_id="Member ID",
        member_name="Member Name",
        member_notes="Member Notes",
        parent_member_id="Parent Member ID",
        hierarchy="Hierarchy",
        terminated="Terminated",
        note_id="Note ID",
        cube_title="Cube Title",
        start_period="Start Reference Period",
        end_period="End Reference Period",
        frequency="Frequency",
        subject_code="Subject Code",
        survey_code="Survey Code",
        symbol_legend="Symbol Legend",
        correction_id="Correction ID",
    ),
    FRENCH: Names(
        language=FRENCH,
        delimiter=";",
        ref_date="PÉRIODE DE RÉFÉRENCE",
        geo="GÉO",
        value="VALEUR",
        scalar_id="IDENTIFICATEUR SCALAIRE",
        scalar_factor="FACTEUR SCALAIRE",
        uom="UNITÉ DE MESURE",
        coordinate="COORDONNÉES",
        code_column="Code sur la classification",
        percent_prefix="Pourcent",
        code_prefix="Code de classification pour ",
        hierarchy_prefix="Hiérarchie pour ",
        geography_names=("Géographie", "Nom géographique", "Géographie d'origine"),
        dimension_id="Numéro d'identification de la dimension",
        dimension_name="Nom de la dimension",
        dimension_notes="Notes sur la dimension",
        member_id="Numéro d'identification du membre",
        member_name="Nom du membre",
        member_notes="Notes sur le membre",
        parent_member_id="Numéro d'identification du membre parent",
        hierarchy="Hiérarchie",
        terminated="Terminé",
        note_id="Numéro d'identification de la note",
        cube_title="Titre du cube",
        start_period="Début de la période de référence",
        end_period="Fin de la période de référence",
        frequency="Fréquence",
        subject_code="Code du sujet",
        survey_code="Code d'enquête",
        symbol_legend="Légende Symbole",
        correction_id="Numéro d'identification de la correction",
    ),
}

_LANGUAGE_SPELLINGS = {
    ENGLISH: ("english", "eng", "en"),
    FRENCH: ("french", "fra", "fr"),
}
# --- end of fixed values ---------------------------------------------------------------------


def language_code(language: str | None) -> str | None:
    """``english/eng/en`` -> ``eng``, ``french/fra/fr`` -> ``fra``, anything else -> None."""
    wanted = (language or "").lower()
    return next((code for code, forms in _LANGUAGE_SPELLINGS.items() if wanted in forms), None)


def names_for(language: str) -> Names:
    code = language_code(language)
    if code is None:
        raise ValueError(f"Unknown language {language!r}")
    return _NAMES[code]


def language_of(df: DataFrame) -> str:
    """Language of a cube frame, told by the name of its value column."""
    return FRENCH if _NAMES[FRENCH].value in df.columns else ENGLISH


def quoted(name: str) -> str:
    """Backtick-quoted name: dimension names hold blanks, commas, dots and brackets."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def rename_language(df: DataFrame, from_language: str, to_language: str) -> DataFrame:
    """Rename the fixed columns that are present from one language to the other."""
    source, target = names_for(from_language), names_for(to_language)
    fixed = (
        "ref_date",
        "code_column",
        "value",
        "scalar_id",
        "scalar_factor",
        "uom",
        "coordinate",
        "geo",
    )
    mapping = {getattr(source, f): getattr(target, f) for f in fixed}
    return df.withColumnsRenamed({a: b for a, b in mapping.items() if a in df.columns})


def canonical_columns(columns: list[str], language: str) -> list[str]:
    """The published order: time and place, dimensions, value and attributes, metadata."""
    n = names_for(language)
    # --- fixed values: published order of the columns
    head = ["REF_DATE", n.ref_date, DATE, "REF_DATE2", n.geo, "DGUID", GEO_UID]
    tail = [
        n.value,
        NORMALIZED,
        n.uom,
        "UOM_ID",
        n.scalar_factor,
        n.scalar_id,
        "VECTOR",
        CUBE_ID,
        n.coordinate,
        "STATUS",
        "SYMBOL",
        "releaseTime",
        "frequencyCode",
        "TERMINATED",
        "DECIMALS",
    ]
    # --- end of fixed values
    present = set(columns)
    first = [c for c in dict.fromkeys(head) if c in present]
    third = [c for c in tail if c in present]
    last = [c for c in columns if c.startswith((n.hierarchy_prefix, n.code_prefix))]
    placed = {*first, *third, *last}
    return first + [c for c in columns if c not in placed] + third + last


def canonical_order(df: DataFrame, language: str | None = None) -> DataFrame:
    return df.select(*[column(c) for c in canonical_columns(df.columns, language or language_of(df))])


def data_column(dimension: str, columns: list[str], language: str) -> str | None:
    """Column that holds a dimension: its own name, or GEO/GÉO for a geography dimension."""
    if dimension in columns:
        return dimension
    n = names_for(language)
    is_geography = dimension in n.geography_names or any(
        g in dimension for g in n.geography_names[:2]
    )
    return n.geo if is_geography and n.geo in columns else None


def same_columns(left: list[str] | tuple[str, ...], right: list[str] | tuple[str, ...]) -> bool:
    """Set equality of two partitionings."""
    return sorted(left) == sorted(right)


def reject_duplicate_columns(columns: list[str]) -> None:
    """Names that differ only by case cannot be stored."""
    seen: dict[str, list[str]] = {}
    for c in columns:
        seen.setdefault(c.upper(), []).append(c)
    clashes = [c for group in seen.values() if len(group) > 1 for c in group]
    if clashes:
        raise ValueError(f"Duplicated column names: {', '.join(clashes)}")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; columns a frame lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def any_match(columns: list[str], pattern: str) -> list[str]:
    return [c for c in columns if re.search(pattern, c)]
