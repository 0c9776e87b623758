"""Member trees: hierarchy paths, levels, subtrees, unambiguous names and category order.

Members of any number of cubes and dimensions are handled together. Working columns are
``cube_id, dim_id, dim_name, member_id, member_name, parent_id, code`` (ids are text).
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statcube.functions import expressions as X
from statcube.functions.names import column, names_for
from statcube.operators.joins import fits_broadcast, lookup_join, number_rows
from statcube.sources.scratch import materialize, materialize_counted, materialize_measured

DIMENSION_KEY = ("cube_id", "dim_id")


def member_order(name: str = "member_id") -> Column:
    """Ids are text but order as numbers; ids that are no numbers come last."""
    return column(name).try_cast("bigint").asc_nulls_last()


def in_numeric_order(df: DataFrame, *ids: str) -> DataFrame:
    """Sort by text ids as numbers, for member rows and notes; missing ids come last."""
    return df.orderBy(*[member_order(c) for c in ids])


def in_category_order(df: DataFrame, *columns: str) -> DataFrame:
    """Sort by the order of categories instead of the alphabet; needs ``<column>__ord``."""
    return df.orderBy(*[column(c + "__ord").asc_nulls_last() for c in columns])


def _written(df: DataFrame, label: str, bounded: bool | None) -> tuple[DataFrame, bool]:
    """The frame as a written table, and whether it is small enough to broadcast.

    ``bounded`` tells that it comes from a table that is written and measured already.
    """
    if bounded is None:
        df, size = materialize_measured(df, label)
        bounded = fits_broadcast(size)
    return df, bounded


def build_hierarchy(members: DataFrame, bounded: bool | None = None) -> DataFrame:
    """Add ``hierarchy``: the root-first dotted path of member ids.

    A parent id that is no member of its dimension is prepended once. A path that runs into a
    cycle ends where an ancestor would come up again, with a warning. Paths double in length per
    round, until no path has a parent above it; each round joins only the members whose top
    still has a parent. ``bounded`` is given if the members are a written, measured table.
    """
    key = list(DIMENSION_KEY)
    start = members.select(
        *key,
        "member_id",
        F.array("member_id").alias("path"),
        F.col("parent_id").alias("above"),
        F.lit(False).alias("cyclic"),
    )
    state, bounded = _written(start, "hierarchy", bounded)
    open_ends = 1
    while open_ends:
        tops = state.select(
            *key,
            F.col("member_id").alias("above"),
            F.col("path").alias("top_path"),
            F.col("above").alias("next_above"),
        )
        # A small set is joined as a whole; of a large one only the members that still grow.
        above = F.col("above")
        growing = state if bounded else state.filter(above.isNotNull())
        # The part of the top's path that is nearer than any id that the path holds already.
        top = F.coalesce("top_path", F.array(above))
        again = F.array_max(F.transform(top, lambda m, i: F.when(F.array_contains("path", m), i + 1).otherwise(0)))
        nearer = F.slice(top, F.col("again") + 1, F.size(top))
        grown = (
            lookup_join(growing, tops, [*key, "above"], bounded=bounded)
            .withColumn("again", F.when(above.isNull(), F.lit(0)).otherwise(again))
            .select(
                *key,
                "member_id",
                F.when(above.isNull(), F.col("path")).otherwise(F.concat(nearer, "path")).alias("path"),
                F.when(F.col("again") == 0, F.col("next_above")).alias("above"),
                (F.col("cyclic") | (F.col("again") > 0)).alias("cyclic"),
            )
        )
        merged = grown if bounded else state.filter(above.isNull()).unionByName(grown)
        state, open_ends = materialize_counted(merged, "hierarchy", above.isNotNull())
    if not state.filter("cyclic").isEmpty():
        warnings.warn("Some members are their own ancestors; their paths end where the cycle closes.")
    paths = state.select(*key, "member_id", F.array_join("path", ".").alias("hierarchy"))
    return lookup_join(members, paths, [*key, "member_id"], bounded=bounded)


def add_member_labels(members: DataFrame) -> DataFrame:
    """Add ``label``: name with its code, or the name alone for geography or without code."""
    geography = F.lit(False)
    for language in ("eng", "fra"):
        geography = geography | F.col("dim_name").isin(*names_for(language).geography_names)
    return members.withColumn("label", X.member_label(F.col("member_name"), F.col("code"), geography))


def cube_dimensions(members: DataFrame, language: str = "eng") -> DataFrame:
    """Distinct dimensions of every cube under their published headings."""
    n = names_for(language)
    return members.select(
        "cube_id", F.col("dim_id").alias(n.dimension_id), F.col("dim_name").alias(n.dimension_name)
    ).distinct()


def cube_members(members: DataFrame, dimension: str, language: str = "eng") -> DataFrame:
    """Members of one dimension of every cube with their hierarchy, under published headings."""
    n = names_for(language)
    chosen = members.filter(F.col("dim_name") == dimension)
    if chosen.isEmpty():
        raise ValueError(f"No cube has a dimension {dimension}")
    extra = [F.col("terminated").alias(n.terminated)] if "terminated" in members.columns else []
    return build_hierarchy(chosen).select(
        "cube_id",
        F.col("dim_id").alias(n.dimension_id),
        F.col("dim_name").alias(n.dimension_name),
        F.col("member_id").alias(n.member_id),
        F.col("member_name").alias(n.member_name),
        F.col("parent_id").alias(n.parent_member_id),
        *extra,
        F.col("hierarchy").alias(n.hierarchy),
    )


def cube_overview(members: DataFrame, shown: int = 10) -> DataFrame:
    """Per dimension the number of members and the first names, ``...`` if there are more."""
    key = [*DIMENSION_KEY, "dim_name"]
    sizes = members.groupBy(*key).agg(F.count(F.lit(1)).alias("n_members"))
    # row_number <= constant lets Spark cut every task to the first rows before the shuffle.
    first = (
        members.withColumn(
            "n", F.row_number().over(Window.partitionBy(*key).orderBy(member_order(), "member_name"))
        )
        .filter(F.col("n") <= shown)
        .groupBy(*key)
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("n", "member_name"))),
                    lambda s: s["member_name"],
                ),
                ", ",
            ).alias("first_names")
        )
    )
    more = F.when(F.col("n_members") > shown, F.lit(", ...")).otherwise(F.lit(""))
    return sizes.join(first, key).select(
        *key, "n_members", F.concat("first_names", more).alias("first_members")
    )


def _flag_duplicates(levels: DataFrame, bounded: bool) -> DataFrame:
    """Recount names within each dimension. Counts are aggregated before any shuffle."""
    key = [*DIMENSION_KEY, "name"]
    repeated = levels.groupBy(*key).count().filter("count > 1").select(*key, F.lit(True).alias("hit"))
    exempt = X.is_census_cube(F.col("cube_id")) & (F.col("dim_id") == 1)
    return (
        lookup_join(levels.drop("duplicated"), repeated, key, bounded=bounded)
        .withColumn("clash", F.coalesce("hit", F.lit(False)))
        .withColumn("duplicated", F.col("clash") & ~exempt)
        .drop("hit")
    )


def dedupe_members(members: DataFrame, bounded: bool | None = None) -> DataFrame:
    """Unambiguous member names: ``cube_id, dim_id, member_id, level_name, original, member_name``.

    A name that occurs more than once in its dimension gets `` ==> <parent name>``, or
    `` [id]`` at the root; counts are refreshed and the next ancestor is used until all names
    are unique. All rows of a round see the state of the round before. A member whose id has been added has
    nothing more to add; if names clash even so (repeated ids), a warning tells. Geographies of census cubes are left as they are.
    """
    key = list(DIMENSION_KEY)
    start = members.select(
        *key,
        "member_id",
        F.col("member_name").alias("name"),
        "member_name",
        F.col("parent_id").alias("above"),
        F.lit(False).alias("spent"),
    )
    start, bounded = _written(start, "names", bounded)
    open_clash = F.col("duplicated") & ~F.col("spent")
    flagged = _flag_duplicates(start, bounded).withColumn("original", ~F.col("clash"))
    levels, clashes = materialize_counted(flagged.drop("clash"), "names", open_clash)
    renamed_some = bool(clashes)
    while clashes:
        ancestors = levels.select(
            *key,
            F.col("member_id").alias("above"),
            F.col("member_name").alias("above_name"),
            F.col("above").alias("next_above"),
        )
        clash = open_clash
        longer = F.coalesce(
            F.concat("name", F.lit(" ==> "), "above_name"),
            F.concat("name", F.lit(" ["), "member_id", F.lit("]")),
        )
        touched = levels if bounded else levels.filter(clash)
        renamed = (
            lookup_join(touched, ancestors, [*key, "above"], bounded=bounded)
            .withColumns(
                {
                    "name": F.when(clash, longer).otherwise(F.col("name")),
                    "above": F.when(clash, F.col("next_above")).otherwise(F.col("above")),
                    "spent": F.col("spent") | (clash & F.col("above_name").isNull()),
                }
            )
            .drop("above_name", "next_above")
        )
        merged = renamed if bounded else levels.filter(~clash).unionByName(renamed)
        levels, clashes = materialize_counted(
            _flag_duplicates(merged, bounded).drop("clash"), "names", open_clash
        )
    if renamed_some and not levels.filter("duplicated").isEmpty():
        warnings.warn("Some member names are ambiguous even with their ids.")
    return levels.select(
        *key, "member_id", F.col("name").alias("level_name"), "original", "member_name"
    )


def category_levels(levels: DataFrame, bounded: bool = False) -> DataFrame:
    """Order of the categories of each dimension: (dimension, numeric member id)."""
    order = [member_order(), F.col("member_id")]
    return number_rows(levels, DIMENSION_KEY, order, "ord", bounded=bounded)


def categories_for_level(
    df: DataFrame,
    dimension: str,
    level: int | None = None,
    strict: bool = False,
    remove_duplicates: bool = True,
    language: str = "eng",
) -> DataFrame:
    """Categories of a cube down to a depth of its hierarchy.

    ``level`` None or beyond the deepest level means the deepest. ``strict`` keeps exactly that
    depth. Otherwise members that are ancestors of kept members are dropped, so that leaves
    above the level stay.
    """
    n = names_for(language)
    path = column(n.hierarchy_for(dimension))
    # Few rows per cube, used several times below, so they are written once.
    levels = materialize(
        df.select(column(dimension).alias("category"), path.alias("path"))
        .distinct()
        .withColumn("depth", X.path_depth(F.col("path"))),
        "levels",
    )
    deepest = levels.agg(F.max("depth").alias("depth")).scalar()
    wanted = deepest if level is None else F.least(F.lit(level), deepest)
    if strict:
        kept = levels.filter(F.col("depth") == wanted)
    else:
        kept = levels.filter(F.col("depth") <= wanted)
        if remove_duplicates:
            kept = kept.withColumn("leaf", X.path_leaf(F.col("path")))
            ancestors = kept.select(F.explode(X.path_ancestors(F.col("path"))).alias("leaf")).distinct()
            kept = kept.join(ancestors, "leaf", "left_anti")
    return kept.select(F.col("category").alias(dimension))


def subtree(
    df: DataFrame, dimension: str, roots: Iterable[str] | DataFrame, language: str = "eng"
) -> DataFrame:
    """Rows at or below the chosen paths.

    A list of paths becomes a predicate that reaches the Parquet scan. A frame of paths (its
    first column) is matched against the prefixes of the distinct paths of ``df``.
    """
    name = names_for(language).hierarchy_for(dimension)
    if not isinstance(roots, DataFrame):
        chosen = F.lit(False)
        for root in roots:
            chosen = chosen | X.is_under(column(name), root)
        return df.filter(chosen)
    root_paths = roots.select(column(roots.columns[0]).alias("prefix")).distinct()
    hits = (
        df.select(column(name).alias("path"))
        .filter(F.col("path").isNotNull())
        .distinct()
        .withColumn("prefix", F.explode(X.path_prefixes(F.col("path"))))
        .join(root_paths, "prefix", "left_semi")
        .select(F.col("path").alias(name))
        .distinct()
    )
    return lookup_join(df, hits, [name], "left_semi")


#: Numbers of a tree that one task adds up.
SPAN_ROWS = 1_000_000


def member_intervals(members: DataFrame) -> DataFrame:
    """Add ``hierarchy``, ``entry`` and ``exit``: numbers of every dimension's tree from the root down, siblings in numeric order.

    The members at or below a member are those whose ``entry`` lies from its ``entry`` to its ``exit``. Members are numbered
    in ranges of their sorted paths and counted under each of their path's prefixes, so no task walks a tree. Of
    repeated rows of a member one stays; an ancestor that is no member gets no numbers; members of a cycle are numbered by the paths that
    end where it closes.
    """
    key = list(DIMENSION_KEY)
    tree = materialize(build_hierarchy(members.dropDuplicates([*key, "member_id"])), "tree")
    paths = tree.select(*key, "hierarchy").distinct()
    number = lambda part: F.struct(
        part.try_cast("bigint").isNull().alias("other"), part.try_cast("bigint").alias("number"), part.alias("id")
    )
    ordered = paths.withColumn("__order", F.transform(F.split("hierarchy", r"\."), number))
    numbered = number_rows(ordered, key, [F.col("__order")], "entry").drop("__order")
    sizes = (
        paths.select(*key, F.explode(X.path_prefixes(F.col("hierarchy"))).alias("hierarchy"))
        .groupBy(*key, "hierarchy")
        .agg(F.count(F.lit(1)).alias("size"))
    )
    spans = lookup_join(numbered, sizes, [*key, "hierarchy"]).select(
        *key, "hierarchy", "entry", (F.col("entry") + F.col("size") - 1).cast("int").alias("exit")
    )
    return lookup_join(tree, spans, [*key, "hierarchy"])


def in_interval(intervals: Iterable[tuple[int, int]], name: str = "entry") -> Column:
    """Predicate of rows within any of the given (entry, exit) pairs; it reaches the Parquet scan of rows that store their entry."""
    chosen = F.lit(False)
    for entry, last in intervals:
        chosen = chosen | column(name).between(entry, last)
    return chosen


def members_under(intervals: DataFrame, roots: DataFrame, span_rows: int = SPAN_ROWS) -> DataFrame:
    """Members at or below the members of a frame (``cube_id, dim_id, member_id``) of any size, by their intervals.

    Every root opens its interval at ``entry`` and closes it after ``exit``; a member is chosen where the running sum of openings and
    closings is above 0. The sum runs inside spans of the numbers and is shifted by the sums of earlier spans.
    """
    key = list(DIMENSION_KEY)
    intervals = materialize(intervals, "intervals")
    places = intervals.select(*key, "entry", "exit").distinct()
    wanted = roots.select(*key, "member_id").distinct()
    chosen = lookup_join(intervals, wanted, [*key, "member_id"], "left_semi").select(*key, "entry", "exit").distinct()
    edges = F.array(
        F.struct(F.col("entry").alias("entry"), F.lit(1).alias("step")),
        F.struct((F.col("exit") + 1).alias("entry"), F.lit(-1).alias("step")),
    )
    steps = chosen.select(*key, F.inline(edges)).groupBy(*key, "entry").agg(F.sum("step").alias("step"))
    stepped = lookup_join(places, steps, [*key, "entry"]).select(
        *key, "entry", F.coalesce("step", F.lit(0)).alias("step"), F.floor(F.col("entry") / span_rows).alias("span")
    )
    stepped = materialize(stepped, "steps")
    earlier = Window.partitionBy(*key).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        stepped.groupBy(*key, "span")
        .agg(F.sum("step").alias("sum"))
        .select(*key, "span", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("shift"))
    )
    inside = Window.partitionBy(*key, "span").orderBy("entry").rowsBetween(Window.unboundedPreceding, 0)
    running = stepped.withColumn("open", F.sum("step").over(inside))
    hits = lookup_join(running, shifts, [*key, "span"]).filter(F.col("open") + F.col("shift") > 0)
    return lookup_join(intervals, hits.select(*key, "entry"), [*key, "entry"], "left_semi")


def roll_up(cells: DataFrame, members: DataFrame, keys: Iterable[str], value: str = "VALUE") -> DataFrame:
    """Sum and number of values at or below every member, per ``keys`` (other dimensions and the period).

    ``cells`` hold ``cube_id, dim_id, member_id``, the keys and the value; ``members`` are those of ``member_intervals`` or
    ``build_hierarchy``. Cells are added up per member first; each sum is then added to the members on its path, all levels in one
    aggregate that combines before the shuffle. Cells of ids that are no members are left out; missing values count as none.
    """
    key, keys = list(DIMENSION_KEY), list(keys)
    named = [column(k) for k in keys]
    tree = materialize(members.select(*key, "member_id", "hierarchy").distinct(), "tree")
    own = cells.groupBy(*key, "member_id", *named).agg(F.sum(column(value)).alias("sum"), F.count(column(value)).alias("n"))
    above = tree.select(*key, "member_id", F.explode(X.path_prefixes(F.col("hierarchy"))).alias("hierarchy"))
    # Ancestors that are no members get no sum.
    above = lookup_join(above, tree.select(*key, "hierarchy"), [*key, "hierarchy"], "left_semi").select(
        *key, "member_id", X.path_leaf(F.col("hierarchy")).alias("ancestor")
    )
    return (
        lookup_join(own, above, [*key, "member_id"], "inner")
        .groupBy(*key, F.col("ancestor").alias("member_id"), *named)
        .agg(F.sum("sum").alias(value), F.sum("n").alias("n_values"))
    )


def children_against_parent(
    cells: DataFrame, members: DataFrame, keys: Iterable[str], value: str = "VALUE"
) -> DataFrame:
    """Published value of every parent beside the sum of its children's values, per ``keys``.

    One row per parent and keys that a parent or a child has a cell for: ``published``, ``children``, ``n_children`` (with a value) and
    ``difference`` (NULL if a side is missing). Both sides meet in one aggregate, so missing keys meet too.
    """
    key, keys = list(DIMENSION_KEY), list(keys)
    named = [column(k) for k in keys]
    links = members.filter("parent_id IS NOT NULL").select(*key, "member_id", "parent_id").distinct()
    links, size = materialize_measured(links, "links")
    parents = links.select(*key, F.col("parent_id").alias("member_id")).distinct()
    nothing = F.lit(None).cast(cells.schema[value].dataType)
    own = lookup_join(cells, parents, [*key, "member_id"], "left_semi", bounded=size).select(
        *key, "member_id", *named, column(value).alias("published"), nothing.alias("children")
    )
    below = lookup_join(cells, links, [*key, "member_id"], "inner", bounded=size).select(
        *key, F.col("parent_id").alias("member_id"), *named, nothing.alias("published"), column(value).alias("children")
    )
    return (
        own.unionByName(below)
        .groupBy(*key, "member_id", *named)
        .agg(F.sum("published").alias("published"), F.sum("children").alias("children"), F.count("children").alias("n_children"))
        .withColumn("difference", F.col("published") - F.col("children"))
    )
