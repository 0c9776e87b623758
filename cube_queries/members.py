"""Member trees, names, levels and enrichment of the facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cube_queries.cubes import (
    DERIVED_SQL,
    ORDERS_CUBE,
    PART_CUBE,
    flag_members,
    orders_facts,
    orders_members,
    part_facts,
    part_members,
    table,
    text,
)
from cube_queries.registry import query, with_tables
from statcube.functions import expressions as X
from statcube.functions.names import names_for
from statcube.operators import members as M
from statcube.operators.enrich import (
    add_geo_abbreviation,
    attach_member_names,
    coordinate_names,
    describe_cube,
    fold_in_metadata,
)
from statcube.operators.joins import number_rows
from statcube.plans.pipelines import normalize_cube

#: Members beyond which their places are numbered in ranges.
PLACED_ROWS = 1000

_PATHS = """paths AS (
    SELECT member_id, member_name, parent_id, member_id AS path, parent_id AS above FROM part_members
    UNION ALL
    SELECT p.member_id, p.member_name, p.parent_id, p.above || '.' || p.path, m.parent_id
    FROM paths p JOIN part_members m ON m.member_id = p.above)"""
_PART_PATHS = with_tables(["part_members"], "", recursive=True) + ",\n" + _PATHS


@query(
    "build_hierarchy",
    _PART_PATHS
    + "\nSELECT member_id, member_name, parent_id, path AS hierarchy FROM paths WHERE above IS NULL",
)
def build_hierarchy(spark, folder):
    return M.build_hierarchy(part_members(spark, folder)).select(
        "member_id", "member_name", "parent_id", "hierarchy"
    )


@query(
    "dimension_list",
    with_tables(
        ["orders_members"],
        'SELECT DISTINCT cube_id, dim_id AS "Dimension ID", dim_name AS "Dimension name" FROM orders_members',
    ),
)
def dimension_list(spark, folder):
    return M.cube_dimensions(orders_members(spark, folder))


@query(
    "member_list",
    with_tables(
        ["orders_members"],
        """SELECT cube_id, dim_id AS "Dimension ID", dim_name AS "Dimension name", m.member_id AS "Member ID",
                  member_name AS "Member Name", parent_id AS "Parent Member ID",
                  CASE WHEN parent_id IS NULL THEN member_id
                       WHEN parent_id = '1' THEN '1.' || member_id
                       ELSE '1.' || parent_id || '.' || member_id END AS "Hierarchy"
           FROM orders_members m WHERE dim_name = 'Geography'""",
    ),
)
def member_list(spark, folder):
    return M.cube_members(orders_members(spark, folder), "Geography")


@query(
    "member_labels",
    with_tables(
        ["orders_members"],
        """SELECT dim_id, member_id, CASE WHEN code IS NULL OR dim_name = 'Geography' THEN member_name
                  ELSE member_name || ' ' || code END AS label FROM orders_members""",
    ),
)
def member_labels(spark, folder):
    return M.add_member_labels(orders_members(spark, folder)).select("dim_id", "member_id", "label")


@query(
    "overview",
    with_tables(
        ["part_members"],
        """SELECT cube_id, dim_id, 'Part' AS dim_name, count(*) AS n_members,
                  string_agg(member_name, ', ' ORDER BY n) FILTER (WHERE n <= 10)
                    || CASE WHEN count(*) > 10 THEN ', ...' ELSE '' END AS first_members
           FROM (SELECT *, row_number() OVER (ORDER BY member_id::BIGINT, member_name) AS n FROM part_members)
           GROUP BY 1, 2""",
    ),
)
def overview(spark, folder):
    return M.cube_overview(part_members(spark, folder))


def dedupe_sql(rounds: int = 8) -> str:
    """The renaming loop unrolled; rounds without clashes change nothing."""
    steps = [
        """r0 AS (SELECT member_id, member_name, member_name AS name, parent_id AS above,
                   count(*) OVER (PARTITION BY member_name) > 1 AS dup FROM part_members)"""
    ]
    for i in range(1, rounds + 1):
        steps.append(
            f"""r{i} AS (SELECT member_id, member_name, name, above, count(*) OVER (PARTITION BY name) > 1 AS dup
              FROM (SELECT a.member_id, a.member_name,
                      CASE WHEN NOT a.dup THEN a.name WHEN b.member_id IS NULL THEN a.name || ' [' || a.member_id || ']'
                           ELSE a.name || ' ==> ' || b.member_name END AS name,
                      CASE WHEN a.dup THEN b.above ELSE a.above END AS above
                    FROM r{i - 1} a LEFT JOIN r{i - 1} b ON b.member_id = a.above))"""
        )
    final = f"""names AS (SELECT r.member_id, r.name AS level_name, NOT o.dup AS original, r.member_name
                FROM r{rounds} r JOIN r0 o USING (member_id))"""
    return ",\n".join([*steps, final])


_DEDUPED = with_tables(["part_members", "part_facts"], "") + ",\n" + dedupe_sql()


@query("dedupe_members", _DEDUPED + "\nSELECT * FROM names")
def dedupe_members(spark, folder):
    return M.dedupe_members(part_members(spark, folder)).select(
        "member_id", "level_name", "original", "member_name"
    )


@query(
    "category_order",
    _DEDUPED
    + """
      SELECT member_id, level_name, row_number() OVER (ORDER BY member_id::BIGINT)::INT AS ord FROM names""",
)
def category_order(spark, folder):
    levels = M.dedupe_members(part_members(spark, folder))
    return M.category_levels(levels).select("member_id", "level_name", "ord")


def _part_meta(spark, folder):
    members = part_members(spark, folder).unionByName(flag_members(spark, folder))
    return describe_cube(members, PART_CUBE)


@query(
    "ordered_categories",
    _DEDUPED
    + """
      SELECT "REF_DATE", level_name AS "Part", "Return flag", "VALUE", "COORDINATE", ord AS "Part__ord",
             CASE "Return flag" WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END::INT AS "Return flag__ord"
      FROM part_facts JOIN (SELECT *, row_number() OVER (ORDER BY member_id::BIGINT)::INT AS ord FROM names)
        ON member_id = part_member::VARCHAR""",
)
def ordered_categories(spark, folder):
    facts = part_facts(spark, folder)
    result = normalize_cube(facts, _part_meta(spark, folder))
    return result.select(
        "REF_DATE", "Part", "Return flag", "VALUE", "COORDINATE", "Part__ord", "Return flag__ord"
    )


_GEO_PATH = """CASE WHEN g.parent_id IS NULL THEN g.member_id WHEN g.parent_id = '1' THEN '1.' || g.member_id
               ELSE '1.' || g.parent_id || '.' || g.member_id END"""
_FOLDED = f"""SELECT f.*, replace(replace(g.code, '[', ''), ']', '') AS "GeoUID",
        {_GEO_PATH} AS "Hierarchy for GEO", p.code AS "Classification Code for Priority",
        p.member_id AS "Hierarchy for Priority", NULL::VARCHAR AS "Classification Code for Statistic",
        s.member_id AS "Hierarchy for Statistic"
      FROM orders_facts f
      LEFT JOIN orders_members g ON g.dim_id = 1 AND g.member_id = split_part("COORDINATE", '.', 1)
      LEFT JOIN orders_members p ON p.dim_id = 2 AND p.member_id = split_part("COORDINATE", '.', 2)
      LEFT JOIN orders_members s ON s.dim_id = 3 AND s.member_id = split_part("COORDINATE", '.', 3)"""


def orders_meta(spark, folder):
    return describe_cube(orders_members(spark, folder), ORDERS_CUBE)


@query("fold_in_metadata", with_tables(["orders_facts", "orders_members"], _FOLDED))
def fold_in(spark, folder):
    return fold_in_metadata(orders_facts(spark, folder), orders_meta(spark, folder))


NORMALIZED_SQL = f"""SELECT * REPLACE (regexp_replace("Priority", ' \\[.+\\]$', '') AS "Priority"),
        CASE WHEN "UOM" = 'Percent' THEN "VALUE" / 100.0::DOUBLE
             ELSE "VALUE" * pow(10.0::DOUBLE, "SCALAR_ID"::INT) END AS val_norm,
        ("REF_DATE" || '-01')::DATE AS "Date",
        rank_geo::INT AS "GEO__ord", split_part("COORDINATE", '.', 2)::INT AS "Priority__ord",
        split_part("COORDINATE", '.', 3)::INT AS "Statistic__ord"
      FROM ({_FOLDED}) JOIN (SELECT member_name AS "GEO", row_number() OVER (ORDER BY member_id::BIGINT) AS rank_geo
                             FROM orders_members WHERE dim_id = 1) USING ("GEO")"""


@query(
    "normalize_cube",
    with_tables(["orders_facts", "orders_members"], f"SELECT * EXCLUDE (rank_geo) FROM ({NORMALIZED_SQL})"),
)
def normalized(spark, folder):
    return normalize_cube(orders_facts(spark, folder), orders_meta(spark, folder))


@query(
    "abbreviations",
    with_tables(
        ["orders_facts"],
        """SELECT "VECTOR", "REF_DATE", place AS "GEO",
             CASE place WHEN 'Canada' THEN 'CAN' WHEN 'British Columbia' THEN 'BC' WHEN 'Quebec' THEN 'QC'
                        WHEN 'Nunavut' THEN 'NU' END AS "GEO.abb",
             CASE place WHEN 'Canada' THEN 1 WHEN 'British Columbia' THEN 2 WHEN 'Quebec' THEN 7
                        WHEN 'Nunavut' THEN 14 END::INT AS "GEO.abb__ord"
           FROM (SELECT *, CASE "GEO" WHEN 'NATION_0' THEN 'Canada' WHEN 'NATION_1' THEN 'British Columbia'
                   WHEN 'NATION_2' THEN 'Quebec' WHEN 'NATION_3' THEN 'Nunavut' ELSE "GEO" END AS place FROM orders_facts)""",
    ),
)
def abbreviations(spark, folder):
    names = {"NATION_0": "Canada", "NATION_1": "British Columbia", "NATION_2": "Quebec", "NATION_3": "Nunavut"}
    place = F.coalesce(F.try_element_at(X.literal_map(names), F.col("GEO")), F.col("GEO"))
    facts = orders_facts(spark, folder).select("VECTOR", "REF_DATE", place.alias("GEO"))
    return add_geo_abbreviation(facts)


@query(
    "coordinate_names",
    with_tables(
        ["part_members"],
        """SELECT member_id, CASE WHEN count(*) OVER (PARTITION BY member_name) > 1
              THEN member_name || ' (' || (row_number() OVER (PARTITION BY member_name ORDER BY member_id::BIGINT))::VARCHAR || ')'
              ELSE member_name END AS member_label FROM part_members""",
    ),
)
def coordinate_labels(spark, folder):
    return coordinate_names(part_members(spark, folder)).select("member_id", "member_label")


@query(
    "attach_member_names",
    with_tables(
        ["part_members", "part_facts"],
        """SELECT "REF_DATE", "COORDINATE", "VALUE", label AS "Part", "Return flag"
           FROM part_facts JOIN (SELECT member_id, CASE WHEN count(*) OVER (PARTITION BY member_name) > 1
                THEN member_name || ' (' || (row_number() OVER (PARTITION BY member_name ORDER BY member_id::BIGINT))::VARCHAR || ')'
                ELSE member_name END AS label FROM part_members) ON member_id = part_member::VARCHAR""",
    ),
)
def names_attached(spark, folder):
    bare = part_facts(spark, folder).select(
        F.lit(PART_CUBE).alias("cube_id"), "REF_DATE", "COORDINATE", "VALUE"
    )
    members = part_members(spark, folder).unionByName(flag_members(spark, folder))
    return attach_member_names(bare, members).drop("cube_id")


_MANY = 500
_CUBE_OF_CUSTOMER = f"'30-10-' || lpad((c_custkey % {_MANY})::VARCHAR, 4, '0')"


@query(
    "names_of_many_cubes",
    f"""SELECT c_custkey AS id, {_CUBE_OF_CUSTOMER} AS cube_id,
               CASE WHEN c_nationkey < 20 THEN 'Place ' || (c_custkey % 50)::VARCHAR || '=' || 'N' || (c_nationkey + 1)::VARCHAR || '; ' ELSE '' END
               || 'Kind ' || (c_custkey % {_MANY})::VARCHAR || '=' || 'K' || (length(c_mktsegment) % 7)::VARCHAR AS names
        FROM customer""",
)
def names_of_many_cubes(spark, folder):
    """Rows of 500 cubes with dimension names of their own: members of the first dimension beyond the twentieth are not in the metadata."""
    number = F.col("c_custkey") % _MANY
    cube = F.concat(F.lit("30-10-"), F.lpad(text(number), 4, "0"))
    customers = table(spark, folder, "customer")
    rows = customers.select(
        F.col("c_custkey").alias("id"), cube.alias("cube_id"), F.concat_ws(".", text(F.col("c_nationkey") + 1), text(F.length("c_mktsegment") % 7)).alias("COORDINATE")
    )
    cubes = customers.select(number.alias("k"), cube.alias("cube_id")).distinct()

    def dimension(d, name, first, last, letter):
        member = cubes.withColumn("m", F.explode(F.sequence(F.lit(first), F.lit(last))))
        return member.select(
            "cube_id", F.lit(d).alias("dim_id"), name.alias("dim_name"), text(F.col("m")).alias("member_id"),
            F.concat(F.lit(letter), text(F.col("m"))).alias("member_name"), F.lit(None).cast("string").alias("parent_id"),
        )

    places = dimension(1, F.concat(F.lit("Place "), text(F.col("k") % 50)), 1, 20, "N")
    kinds = dimension(2, F.concat(F.lit("Kind "), text(F.col("k"))), 0, 6, "K")
    named = attach_member_names(rows, places.unionByName(kinds))
    added = [c for c in named.columns if c not in rows.columns]
    pairs = F.filter(F.array(*[F.concat(F.lit(f"{c}="), F.col(f"`{c}`")) for c in added]), lambda x: x.isNotNull())
    return named.select("id", "cube_id", F.array_join(F.reverse(F.array_sort(pairs)), "; ").alias("names"))


def _part_categories(spark, folder):
    paths = M.build_hierarchy(part_members(spark, folder)).select(
        F.concat("member_name", F.lit(" #"), "member_id").alias("Part"),
        F.col("hierarchy").alias(names_for("eng").hierarchy_for("Part")),
    )
    return paths


_LEVELS = (
    _PART_PATHS
    + """, levels AS (SELECT member_name || ' #' || member_id AS "Part", path, member_id,
                     len(string_split(path, '.')) - 1 AS depth FROM paths WHERE above IS NULL)"""
)


@query(
    "categories_level",
    _LEVELS
    + """
      SELECT "Part" FROM levels l WHERE depth <= 1 AND NOT EXISTS (
        SELECT 1 FROM levels m WHERE m.depth = 1 AND split_part(m.path, '.', 1) = l.member_id)""",
)
def categories_level(spark, folder):
    return M.categories_for_level(_part_categories(spark, folder), "Part", 1)


@query("categories_strict", _LEVELS + """ SELECT "Part" FROM levels WHERE depth = 1""")
def categories_strict(spark, folder):
    return M.categories_for_level(_part_categories(spark, folder), "Part", 1, strict=True)


@query("categories_deepest", _LEVELS + """ SELECT "Part" FROM levels WHERE depth = 2""")
def categories_deepest(spark, folder):
    """No level given: the leaves of the tree."""
    return M.categories_for_level(_part_categories(spark, folder), "Part")


@query(
    "subtree",
    _LEVELS
    + """
      SELECT l."Part", l.path AS "Hierarchy for Part" FROM levels l
      JOIN (SELECT type_id::VARCHAR AS root FROM part_types WHERE p_type IN ('PROMO', 'SMALL'))
        ON l.path = root OR starts_with(l.path, root || '.')""",
)
def subtree(spark, folder):
    tree = _part_categories(spark, folder)
    hierarchy = names_for("eng").hierarchy_for("Part")
    roots = tree.filter(F.col("Part").rlike("^(PROMO|SMALL) #")).select(F.col(hierarchy).alias("root"))
    return M.subtree(tree, "Part", roots)


@query(
    "subtree_of_paths",
    _LEVELS
    + """
      SELECT "Part", path AS "Hierarchy for Part" FROM levels
      WHERE path IN ('3', '6') OR starts_with(path, '3.') OR starts_with(path, '6.')""",
)
def subtree_of_paths(spark, folder):
    return M.subtree(_part_categories(spark, folder), "Part", ["3", "6"])


@query(
    "ancestors_removed",
    with_tables(
        ["part_members"],
        """SELECT member_id FROM part_members m
           WHERE NOT EXISTS (SELECT 1 FROM part_members c WHERE c.parent_id = m.member_id)""",
    ),
)
def ancestors_removed(spark, folder):
    members = part_members(spark, folder)
    parents = members.select(F.col("parent_id").alias("member_id")).distinct()
    return members.join(parents, "member_id", "left_anti").select("member_id")


@query(
    "deep_hierarchy",
    """SELECT 'c-' || (p_partkey // 400)::VARCHAR AS chain, p_partkey::VARCHAR AS member_id, (p_partkey % 400 + 1)::BIGINT AS depth,
              CASE WHEN p_partkey % 400 = 0 THEN p_partkey::VARCHAR
                   ELSE (p_partkey // 400 * 400)::VARCHAR END AS top
       FROM part""",
)
def deep_hierarchy(spark, folder):
    """Chains of up to 400 members: every path reaches its root."""
    key = F.col("p_partkey")
    chain = F.floor(key / 400).cast("bigint")
    members = table(spark, folder, "part").select(
        F.concat(F.lit("c-"), chain.cast("string")).alias("cube_id"),
        F.lit(1).alias("dim_id"),
        key.cast("string").alias("member_id"),
        F.col("p_name").alias("member_name"),
        F.when(key % 400 > 0, (key - 1).cast("string")).alias("parent_id"),
    )
    path = F.split("hierarchy", r"[.]")
    # The first chain has no member 0, so its path begins with that id.
    return M.build_hierarchy(members).select(
        F.col("cube_id").alias("chain"), "member_id", F.size(path).cast("bigint").alias("depth"), path[0].alias("top")
    )


@query(
    "numeric_order",
    with_tables(
        ["part_members"],
        """SELECT member_id, rank() OVER (ORDER BY member_id::BIGINT) AS place FROM part_members""",
    ),
)
def numeric_order(spark, folder):
    """Text ids in the order of their numbers, with the place of each."""
    # Ids are unique, so the row number is the rank; all members lie in one group, so even a small one is numbered in ranges.
    placed = number_rows(part_members(spark, folder), ["dim_id"], [M.member_order()], "place", group_rows=PLACED_ROWS)
    return M.in_numeric_order(placed, "member_id").select("member_id", F.col("place").cast("bigint").alias("place"))


_INTERVALS = (
    _PART_PATHS
    + """, parts AS (SELECT member_id, parent_id, path, string_split(path, '.') AS ids FROM paths WHERE above IS NULL),
      sizes AS (SELECT prefix, count(*) AS size FROM (
        SELECT unnest(list_transform(range(1, len(ids) + 1), lambda i: array_to_string(ids[1:i], '.'))) AS prefix FROM parts)
        GROUP BY 1),
      intervals AS (SELECT member_id, parent_id, path, ids,
        (row_number() OVER (ORDER BY list_transform(ids, lambda x: x::BIGINT)))::INT AS entry, size FROM parts JOIN sizes ON prefix = path),
      leaves AS (SELECT part_member::VARCHAR AS member_id, "REF_DATE", "Return flag", sum("VALUE") AS v, count("VALUE") AS n
        FROM part_facts GROUP BY 1, 2, 3),
      rolled AS (SELECT a.ancestor AS member_id, l."REF_DATE", l."Return flag", sum(l.v) AS v, sum(l.n)::BIGINT AS n
        FROM leaves l JOIN (SELECT member_id, unnest(ids) AS ancestor FROM parts) a USING (member_id) GROUP BY 1, 2, 3)"""
)
_INTERVALS = _INTERVALS.replace("WITH RECURSIVE ", "WITH RECURSIVE part_cells AS (" + DERIVED_SQL["part_facts"] + "), ", 1).replace(
    "FROM part_facts GROUP", "FROM part_cells GROUP"
)


def _part_intervals(spark, folder):
    return M.member_intervals(part_members(spark, folder))


def _part_cells(spark, folder):
    return part_facts(spark, folder).select(
        F.lit(PART_CUBE).alias("cube_id"),
        F.lit(1).alias("dim_id"),
        X.coordinate_part(F.col("COORDINATE"), 1).alias("member_id"),
        "REF_DATE",
        "Return flag",
        "VALUE",
    )


@query(
    "member_intervals",
    _INTERVALS + """ SELECT member_id, parent_id, path AS hierarchy, entry, (entry + size - 1)::INT AS "exit" FROM intervals""",
)
def member_intervals(spark, folder):
    return _part_intervals(spark, folder).select("member_id", "parent_id", "hierarchy", "entry", "exit")


@query(
    "subtree_by_interval",
    _INTERVALS
    + """ SELECT member_id, entry FROM intervals
          WHERE ids[1] IN (SELECT type_id::VARCHAR FROM part_types WHERE p_type IN ('PROMO', 'SMALL')) OR ids[2]::BIGINT % 5 = 0""",
)
def subtree_by_interval(spark, folder):
    """Roots on two levels of the tree, some of them below others."""
    tree = _part_intervals(spark, folder)
    depth = X.path_depth(F.col("hierarchy"))
    brands = (depth == 1) & (F.col("member_id").cast("bigint") % 5 == 0)
    roots = tree.filter(((depth == 0) & F.col("member_name").isin("PROMO", "SMALL")) | brands)
    return M.members_under(tree, roots, span_rows=PLACED_ROWS).select("member_id", "entry")


@query(
    "roll_up_members",
    _INTERVALS + """ SELECT member_id, "REF_DATE", "Return flag", v AS "VALUE", n AS n_values FROM rolled""",
)
def roll_up_members(spark, folder):
    """Values of the parts, added up to brands and types."""
    rolled = M.roll_up(_part_cells(spark, folder), _part_intervals(spark, folder), ["REF_DATE", "Return flag"])
    return rolled.select("member_id", "REF_DATE", "Return flag", "VALUE", "n_values")


@query(
    "children_against_parent",
    _INTERVALS
    + """, published AS (SELECT *, CASE WHEN member_id::BIGINT % 7 = 0 THEN v + 1 ELSE v END AS p FROM rolled),
      below AS (SELECT m.parent_id AS member_id, "REF_DATE", "Return flag", sum(p) AS children, count(p) AS n_children
        FROM published JOIN parts m USING (member_id) WHERE m.parent_id IS NOT NULL GROUP BY 1, 2, 3)
      SELECT member_id, "REF_DATE", "Return flag", p AS published, children, n_children, p - children AS difference
      FROM below JOIN published USING (member_id, "REF_DATE", "Return flag")""",
)
def children_against_parent(spark, folder):
    """Published values of all levels, every seventh of them revised, against the sums of the level below."""
    tree = _part_intervals(spark, folder)
    keys = ["REF_DATE", "Return flag"]
    revised = F.when(F.col("member_id").cast("bigint") % 7 == 0, F.col("VALUE") + 1).otherwise(F.col("VALUE"))
    published = M.roll_up(_part_cells(spark, folder), tree, keys).withColumn("VALUE", revised)
    return M.children_against_parent(published, tree, keys).select(
        "member_id", *keys, "published", "children", "n_children", "difference"
    )
