"""Semi-wide and wide forms of a cube."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statcube.functions import expressions as X
from statcube.functions.names import column, names_for, quoted

_SYMBOL = re.compile(r"^Symbol( \d+)*$")


def wide_to_long(df: DataFrame, language: str = "eng") -> DataFrame:
    """Long form of a cube, value column numeric.

    A semi-wide cube holds one dimension in columns ``<Dim> (<n>X):<member>[<id>]``, each
    followed by its symbol column. Every row is turned into n rows in the same task; the member
    name travels with the value, so no join is needed. The member id is appended to the
    coordinate.
    """
    n = names_for(language)
    columns = df.columns
    symbols = [i for i, c in enumerate(columns) if _SYMBOL.match(c)]
    if n.value in columns:
        return _numeric_value(df, n.value)
    if len(symbols) <= 1:
        warnings.warn("The columns are neither a long nor a semi-wide cube")
        return df

    shape = re.compile(rf"^(?P<dim>.+) (?P<kind>\({len(symbols)}[A-Za-z]*\)):(?P<name>.+)\[(?P<id>\d+)\]$")
    found = [(i, m) for i, c in enumerate(columns) if (m := shape.match(c))]
    if [i + 1 for i, _ in found] != symbols:
        warnings.warn("Value columns and symbol columns do not alternate")
        return df
    dimensions = {m["dim"] for _, m in found}
    if len(dimensions) != 1:
        warnings.warn("Value columns name several dimensions")
        return df

    dimension = f"{dimensions.pop()} {found[0][1]['kind']}"
    used = {i for i, _ in found} | set(symbols)
    rest = [c for i, c in enumerate(columns) if i not in used]
    cells = F.array(
        *[
            F.struct(
                F.lit(m["id"]).alias("id"),
                F.lit(m["name"].strip()).alias("member"),
                X.to_number(column(columns[i])).alias("value"),
                column(columns[i + 1]).cast("string").alias("symbol"),
            )
            for i, m in found
        ]
    )
    long = df.select(*[column(c) for c in rest], F.explode(cells).alias("__cell"))
    fixed = []
    for c in rest:
        if c == n.coordinate:
            fixed.append(F.concat_ws(".", column(c), F.col("__cell.id")).alias(c))
        else:
            fixed.append(column(c))
    return long.select(
        *fixed,
        F.col("__cell.value").alias(n.value),
        F.col("__cell.symbol").alias("Symbol"),
        F.col("__cell.member").alias(dimension),
    )


def _numeric_value(df: DataFrame, value: str) -> DataFrame:
    if dict(df.dtypes)[value] == "double":
        return df
    return df.withColumn(value, X.to_number(column(value)))


def cube_pivot(df: DataFrame, key: str, value: str, levels: Sequence[str] | None = None) -> DataFrame:
    """Spread one dimension over columns; two values for one cell are an error.

    Give the ``levels`` when they are known: otherwise Spark needs a job to find them. A row whose level
    is missing or not among the given ones is an error, too: it would vanish without a trace.
    """
    rest = [c for c in df.columns if c not in (key, value)]
    if levels:
        unlisted = F.raise_error(F.concat(F.lit("Unlisted level: "), F.coalesce(column(key).cast("string"), F.lit("NULL"))))
        listed = F.when(column(key).isin(list(levels)), column(key)).otherwise(unlisted.cast(df.schema[key].dataType))
        df = df.withColumn(key, listed)
    grouped = df.groupBy(*[column(c) for c in rest]).pivot(quoted(key), list(levels) if levels else None)
    cell = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit("Several values for one cell")).cast(df.schema[value].dataType)
    ).otherwise(F.first(column(value)))
    return grouped.agg(cell)
