import random

import pytest
from pyspark.sql import functions as F

from statcube.operators import members as M

SCHEMA = (
    "cube_id string, dim_id int, dim_name string, member_id string, member_name string, "
    "parent_id string, code string"
)


def frame(spark, rows, cube="14-10-0001", dim=1):
    return spark.createDataFrame([(cube, dim, "D", *r, None) for r in rows], SCHEMA)


def paths(df):
    return {r.member_id: r.hierarchy for r in M.build_hierarchy(df).collect()}


TREE = [
    ("1", "All", None), ("2", "Goods", "1"), ("10", "Steel", "2"), ("3", "Services", "1"),
    ("5", "Orphan", "9"),
]


def test_hierarchy(spark):
    assert paths(frame(spark, TREE)) == {
        "1": "1", "2": "1.2", "10": "1.2.10", "3": "1.3", "5": "9.5",
    }


def walk(rows):
    """Brute force: prepend the parent of the top, until there is none or it is in the path."""
    parent = {m: p for m, _, p in rows}
    found = {}
    for m in parent:
        path = [m]
        while parent.get(path[0]) is not None and parent[path[0]] not in path:
            path.insert(0, parent[path[0]])
        found[m] = ".".join(path)
    return found


@pytest.mark.parametrize("depth", [1, 5, 40, 130])
def test_hierarchy_equals_brute_force(spark, depth):
    rng = random.Random(depth)
    rows = [("1", "m", None)]
    for i in range(2, 200):
        low = max(1, i - 1 if depth > 100 else i - 200 // depth)
        rows.append((str(i), "m", str(rng.randint(low, i - 1))))
    assert paths(frame(spark, rows)) == walk(rows)


def test_cycles_end_where_they_close(spark):
    rows = [("1", "a", "2"), ("2", "b", "1"), ("3", "c", "1"), ("4", "self", "4"), ("7", "free", None), ("9", "d", "3")]
    rows += [(str(k), "long", str(k + 1 if k < 115 else 108)) for k in range(100, 116)]
    with pytest.warns(UserWarning, match="own ancestors"):
        got = paths(frame(spark, rows))
    assert got == walk(rows)
    assert got["1"] == "2.1" and got["3"] == "2.1.3" and got["4"] == "4" and got["7"] == "7"


def test_names_that_stay_ambiguous_are_told(spark):
    rows = [("1", "a", None), ("1", "a", None), ("2", "b", None)]
    with pytest.warns(UserWarning, match="ambiguous"):
        assert {r.level_name for r in M.dedupe_members(frame(spark, rows)).collect()} == {"a [1]", "b"}


def rename(rows, census=False, rounds=30):
    """Brute force of the renaming rule on one dimension."""
    state = {m: {"name": n, "orig": n, "above": p} for m, n, p in rows}

    def clashing():
        names = [s["name"] for s in state.values()]
        return {m for m, s in state.items() if names.count(s["name"]) > 1}

    dup = clashing()
    original = {m: m not in dup for m in state}
    while dup and not census and rounds:
        rounds -= 1
        before = {m: dict(s) for m, s in state.items()}
        for m in dup:
            up = before.get(before[m]["above"])
            if up is None:
                state[m]["name"] += f" [{m}]"
                state[m]["above"] = None
            else:
                state[m]["name"] += f" ==> {up['orig']}"
                state[m]["above"] = up["above"]
        dup = clashing()
    return {m: (s["name"], original[m]) for m, s in state.items()}


DUPLICATES = [
    ("1", "Total", None), ("2", "Total", None), ("3", "A", "1"), ("4", "A", "2"), ("5", "B", "3"),
    ("6", "B", "4"), ("7", "C", "1"), ("8", "C", "1"), ("10", "Unique", "2"),
]


def renamed(df):
    return {r.member_id: (r.level_name, r.original) for r in M.dedupe_members(df).collect()}


def test_names_are_made_unique(spark):
    got = renamed(frame(spark, DUPLICATES))
    assert got == rename(DUPLICATES)
    assert got["1"] == ("Total [1]", False) and got["10"] == ("Unique", True)
    names = [n for n, _ in got.values()]
    assert len(set(names)) == len(names)


def test_names_equal_brute_force_on_random_trees(spark):
    for seed in range(3):
        rng = random.Random(seed)
        rows = [(str(i), rng.choice("abcd"), str(rng.randint(1, i - 1)) if i > 3 else None) for i in range(1, 60)]
        assert renamed(frame(spark, rows)) == rename(rows)


def test_census_geography_keeps_its_names(spark):
    census = frame(spark, DUPLICATES, cube="98-10-0036")
    assert renamed(census) == rename(DUPLICATES, census=True)
    other = frame(spark, DUPLICATES, cube="98-10-0036", dim=2)
    assert renamed(other) == rename(DUPLICATES)


def test_several_cubes_at_once(spark):
    both = frame(spark, DUPLICATES).unionByName(frame(spark, TREE, cube="14-10-0002", dim=3))
    got = {(r.cube_id, r.member_id): r.level_name for r in M.dedupe_members(both).collect()}
    assert got[("14-10-0002", "10")] == "Steel" and got[("14-10-0001", "1")] == "Total [1]"
    assert len(paths(both)) == len({m for m, *_ in DUPLICATES + TREE})


def test_large_member_sets_give_the_same(spark, unbounded):
    assert paths(frame(spark, TREE)) == walk(TREE)
    assert renamed(frame(spark, DUPLICATES)) == rename(DUPLICATES)
    levels = M.category_levels(M.dedupe_members(frame(spark, DUPLICATES)))
    order = [r.member_id for r in levels.orderBy("ord").collect()]
    assert order == ["1", "2", "3", "4", "5", "6", "7", "8", "10"]


def tree_facts(spark):
    h = M.build_hierarchy(frame(spark, TREE))
    return h.select(F.col("member_name").alias("D"), F.col("hierarchy").alias("Hierarchy for D"))


def categories(df, *args, **options):
    return sorted(r[0] for r in M.categories_for_level(df, "D", *args, **options).collect())


def test_categories_for_level(spark):
    facts = tree_facts(spark)
    facts = facts.unionByName(facts)
    assert categories(facts, 0) == ["All"]
    assert categories(facts, 1) == ["Goods", "Orphan", "Services"]
    assert categories(facts, 1, remove_duplicates=False) == ["All", "Goods", "Orphan", "Services"]
    assert categories(facts, 2) == ["Orphan", "Services", "Steel"]
    assert categories(facts) == categories(facts, 99) == categories(facts, 2)
    assert categories(facts, 2, strict=True) == ["Steel"]


def test_subtrees(spark):
    facts = tree_facts(spark)
    listed = sorted(r[0] for r in M.subtree(facts, "D", ["1.2"]).select("D").collect())
    assert listed == ["Goods", "Steel"]
    roots = facts.filter("D = 'Goods'").select("`Hierarchy for D`")
    framed = sorted(r[0] for r in M.subtree(facts, "D", roots).select("D").collect())
    assert framed == listed


def test_member_lists(spark):
    df = frame(spark, TREE)
    assert M.cube_members(df, "D").count() == 5
    assert M.cube_members(df, "D", "fra").columns[-1] == "Hiérarchie"
    with pytest.raises(ValueError, match="No cube has"):
        M.cube_members(df, "E")
    overview = M.cube_overview(frame(spark, [(str(i), f"m{i}", None) for i in range(1, 13)])).first()
    assert overview.n_members == 12
    assert overview.first_members == ", ".join(f"m{i}" for i in range(1, 11)) + ", ..."


def test_orders(spark):
    ids = [r.member_id for r in M.in_numeric_order(frame(spark, TREE), "dim_id", "member_id").collect()]
    assert ids == ["1", "2", "3", "5", "10"]
    levels = M.category_levels(M.dedupe_members(frame(spark, DUPLICATES))).withColumnRenamed("ord", "D__ord")
    names = [r.level_name for r in M.in_category_order(levels, "D").collect()]
    assert names[0] == "Total [1]" and names[-1] == "Unique" and len(names) == len(DUPLICATES)


def spans(df):
    return {r.member_id: (r.entry, r.exit) for r in M.member_intervals(df).collect()}


@pytest.mark.parametrize("depth", [1, 6, 40])
def test_intervals_hold_the_subtrees(spark, depth):
    rng = random.Random(depth)
    rows = [("1", "m", None), ("900", "m", "999")]
    rows += [(str(i), "m", str(rng.randint(max(1, i - 1 - 120 // depth), i - 1))) for i in range(2, 120)]
    tree = walk(rows)
    found = spans(frame(spark, rows))
    assert sorted(e for e, _ in found.values()) == list(range(1, len(rows) + 1))
    for m, (entry, last) in found.items():
        under = {o for o, path in tree.items() if (path + ".").startswith(tree[m] + ".")}
        assert under == {o for o, (e, _) in found.items() if entry <= e <= last}


def test_intervals_in_ranges(spark, unbounded):
    rows = [("2", "a", None), ("10", "b", None), ("x", "c", None), ("3", "d", "10"), ("21", "e", "2"), ("3", "d", "10")]
    found = spans(frame(spark, rows))
    assert found == {"2": (1, 2), "21": (2, 2), "10": (3, 4), "3": (4, 4), "x": (5, 5)}


@pytest.mark.parametrize("span_rows", [1, 3, 1000])
def test_members_under_nested_roots(spark, span_rows):
    rows = [("1", "a", None), ("2", "b", "1"), ("3", "c", "2"), ("3", "c", "2"), ("4", "d", "1"), ("5", "e", None), ("6", "f", "5")]
    members = M.member_intervals(frame(spark, rows))
    for roots, wanted in ((["2", "3"], "23"), (["1", "2"], "1234"), (["6", "nobody"], "6"), ([], ""), (["4", "5"], "456")):
        chosen = frame(spark, [(r, "", None) for r in roots]) if roots else members.limit(0)
        got = M.members_under(members, chosen, span_rows)
        assert "".join(sorted(r.member_id for r in got.collect())) == wanted
    assert {r.member_id for r in members.filter(M.in_interval([(2, 3)])).collect()} == {"2", "3"}
    assert members.filter(M.in_interval([])).count() == 0


def test_sums_over_the_tree(spark):
    members = M.member_intervals(frame(spark, TREE))
    rows = [("1", "t", 9.0), ("10", "t", 1.0), ("10", "t", 2.0), ("3", "t", None), ("5", "t", 4.0), ("7", "t", 8.0), ("2", None, 6.0), ("1", None, 6.5)]
    cells = spark.createDataFrame([("14-10-0001", 1, *r) for r in rows], "cube_id string, dim_id int, member_id string, `a.b` string, VALUE double")
    got = {(r["member_id"], r["a.b"]): (r["VALUE"], r["n_values"]) for r in M.roll_up(cells, members, ["a.b"]).collect()}
    assert got == {
        ("1", "t"): (12.0, 3), ("2", "t"): (3.0, 2), ("10", "t"): (3.0, 2), ("3", "t"): (None, 0), ("5", "t"): (4.0, 1),
        ("1", None): (12.5, 2), ("2", None): (6.0, 1),
    }
    pairs = M.children_against_parent(cells, members, ["a.b"]).collect()
    assert {(r["member_id"], r["a.b"]): (r["published"], r["children"], r["n_children"], r["difference"]) for r in pairs} == {
        ("1", "t"): (9.0, None, 0, None), ("2", "t"): (None, 3.0, 2, None), ("9", "t"): (None, 4.0, 1, None),
        ("1", None): (6.5, 6.0, 1, 0.5), ("2", None): (6.0, None, 0, None),
    }


def test_intervals_of_no_members(spark):
    members = M.member_intervals(frame(spark, TREE).limit(0))
    assert members.count() == 0 and {"entry", "exit"} <= set(members.columns)
