"""Exact copies, near copies and the pipeline."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from statcube.llm import exact_dedup, jaccard_join
from statcube.llm.queries import QUERIES
from statcube.llm.shared import ship_package, sorted_groups, table


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    ship_package(spark)


def odd_docs(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "a", None), (4, "a", 1), (4, "a", 1), (None, "a", 2), (None, "only", 2), (5, "A", 3), (6, "a ", 3), (7, "x " * 40_000, 1), (8, "x " * 40_000, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, group_size long")


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("runs", [1, 3, 70])
def test_exact_copies_of_odd_rows(spark, keep, runs):
    docs = odd_docs(spark)
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r.text or ""].append(r.doc_id)
    want = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        want += [(i, best, len(ids), i == best) for i in ids]
    found = exact_dedup.exact_dedup(docs, keep=keep, runs=runs, fan_in=3).collect()
    assert sorted((tuple(r)[:4] for r in found), key=repr) == sorted(want, key=repr)
    assert exact_dedup.exact_dedup(docs.limit(0), runs=runs).count() == 0


def test_exact_dedup_runs_no_python(spark):
    for frame in (QUERIES["op6_exact_dedup"](spark, SMALL), exact_dedup.digest_rows(table(spark, SMALL, "documents"), "doc_id", F.col("text"))):
        assert "Python" not in frame._jdf.queryExecution().toString()


def brute_force(rows):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").split()
        sets[doc_id] = frozenset(zip(*(words[k:] for k in range(5)))) if len(words) >= 5 else frozenset([tuple(words)] if words else [])
    holders = defaultdict(list)
    for doc_id, found in sets.items():
        for s in found:
            holders[s].append(doc_id)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links, texts = Counter(), Counter()
    for i, found in sets.items():
        shared = Counter()
        for s in found:
            shared.update(holders[s])
        partners = {j for j, n in shared.items() if j != i and n / (len(found) + len(sets[j]) - n) >= 0.8}
        links[i] = len(partners)
        texts[i] = len({sets[j] for j in partners} - {found})
        for j in partners:
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return {i: (root(i), links[i], texts[i]) for i in sets}


def near_copies(n, seed=4):
    """A large group of near copies around one text, chains of copies, and exact copies."""
    rng = np.random.default_rng(seed)
    rows, base = [], [f"w{k}" for k in rng.integers(0, 5000, 120)]
    for k in range(n):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            words[at] = f"z{rng.integers(0, 9000)}"
        rows.append((k, " ".join(words)))
    chain = [f"c{k}" for k in range(150)]
    for k in range(12):
        rows.append((n + k, " ".join(chain[4 * k : 4 * k + 80])))
    rows += [(n + 20 + k, "short one") for k in range(3)] + [(n + 30, ""), (n + 31, None), (n + 32, "one two three four five")]
    return rows


@pytest.mark.parametrize("block", [40, 1000])
def test_near_copies_against_brute_force(spark, block):
    rows = near_copies(250)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, class_id int").repartition(7)
    found = {r.doc_id: (r.class_id, r.n_links, r.n_text_links) for r in jaccard_join.near_duplicates(docs, block=block).collect()}
    assert found == brute_force(rows)


def test_near_copies_of_the_documents(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    found = {r.doc_id: (r.class_id, r.n_links, r.n_text_links) for r in QUERIES["op8_jaccard_join"](spark, SMALL).collect()}
    assert found == brute_force(rows)


def test_near_copies_of_odd_rows(spark):
    docs = odd_docs(spark)
    found = jaccard_join.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[1].class_id == 1 and by_id[2].class_id == 2 and by_id[8].class_id == 7 and by_id[3].n_links == 3
    assert all(r.class_id is None and r.n_links == 0 for r in found if r.doc_id is None)
    assert jaccard_join.near_duplicates(docs.limit(0)).count() == 0


def test_recall_sets_the_depth():
    assert jaccard_join.stop_depth(0.8, 40, 6, 0.9) == 6
    depth = jaccard_join.stop_depth()
    assert 1 - (1 - 0.8**depth) ** jaccard_join.TREES >= jaccard_join.TARGET_RECALL


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(7, 9)]
    frame = spark.createDataFrame(edges, "u long, v long")
    found = {r.node: r.root for r in jaccard_join.connected(frame).collect()}
    assert found == {**{k: 100 for k in range(100, 161)}, **{k: 500 for k in range(500, 560)}, 7: 7, 9: 7}


def test_sorted_groups_cross_batches():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"k": k}) for k in ([1, 1], [1, 2], [2], [3, 4])]
    assert [t.column("k").to_pylist() for t in sorted_groups(iter(batches), ["k"])] == [[1, 1, 1], [2, 2], [3], [4]]


def test_pipeline_stages_against_brute_force(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs = table(spark, folder, "documents")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    added = spark.createDataFrame([(10**6, "1234 5678 ...", "en", "s", 13), (10**6 + 1, None, None, None, None)], docs.schema)
    kept = docs.unionByName(added)
    before = kept.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.materialize(stage(spark, kept, folder), name)
        assert kept.columns == columns
        after, gone = kept.collect(), {r.doc_id for r in before} - {r.doc_id for r in kept.collect()}
        assert {tuple(r) for r in after} <= {tuple(r) for r in before}
        if name == "language_id":
            assert {10**6, 10**6 + 1} <= gone and len(gone) <= 2 + 0.01 * len(before)
        if name == "quality_classifier":
            wrong = sum(labels.get(i) == 1 for i in gone) + sum(labels.get(r.doc_id) == 0 for r in after)
            assert any(labels.get(i) == 0 for i in gone) and wrong < 0.03 * len(labels)
        if name == "exact_dedup":
            stay = {}
            for r in before:
                stay[r.text] = max(stay.get(r.text, -1), r.doc_id)
            assert {r.doc_id for r in after} == set(stay.values())
        if name == "near_dedup":
            classes = brute_force([(r.doc_id, r.text) for r in before])
            assert {r.doc_id for r in after} == {c for c, _, _ in classes.values()}
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, folder).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in before}


def test_stages_judge_rows_not_ids(spark):
    """Shared ids, missing ids and repeated rows: one row per text, and no text is lost."""
    near = [f"w{k}" for k in range(60)]
    texts = {"a": "a", "b": "b", "n": " ".join(near), "m": " ".join(near[:-1] + ["z"]), "u": " ".join(near[::-1])}
    rows = [(4, "a"), (4, "b"), (9, "a"), (None, "a"), (5, "n"), (6, "m"), (6, "u"), (None, "m"), (7, "c"), (7, "c"), (None, "d"), (None, "d"), (1, None), (None, "")]
    docs = spark.createDataFrame([(i, texts.get(t, t), k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k int").repartition(3)
    exact = corpus_pipeline.materialize(corpus_pipeline.exact_stage(spark, docs, SMALL), "exact")
    named = {v: k for k, v in texts.items()}
    assert exact.columns == docs.columns
    want = [(1, None), (4, "b"), (5, "n"), (6, "m"), (6, "u"), (7, "c"), (9, "a"), (None, "d")]
    assert sorted(((r.doc_id, named.get(r.text, r.text)) for r in exact.collect()), key=repr) == sorted(want, key=repr)
    # The near stage alone, on all rows: those without words link to nothing.
    alone = corpus_pipeline.near_stage(spark, docs, SMALL)
    assert alone.columns == docs.columns
    want = [(1, None), (None, ""), (4, "a"), (4, "b"), (5, "n"), (6, "u"), (7, "c"), (None, "d")]
    assert sorted(((r.doc_id, named.get(r.text, r.text)) for r in alone.collect()), key=repr) == sorted(want, key=repr)


def test_language_stage_without_any_language_keeps_texts_with_letters(spark):
    texts = ["clean text", "éa", "1 2", "", None, "-", "7 字"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language_stage(spark, docs, SMALL)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {0, 1, 6}


def test_stages_cope_with_no_documents(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_every_operator_has_a_query():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES}
    assert numbers == set(range(1, 14))


def test_repeated_rows_with_a_near_copy_count_once(spark):
    words = [f"w{k}" for k in range(60)]
    near = " ".join([*words[:-1], "other"])
    for rows in ([(1, words), (1, words), (2, near)], [(1, words), (3, words), (2, near)]):
        docs = spark.createDataFrame([(i, t if isinstance(t, str) else " ".join(t)) for i, t in rows], "doc_id long, text string")
        found = jaccard_join.near_duplicates(docs).select("class_id", "n_links", "n_text_links").collect()
        assert [tuple(r) for r in found] == [(1, 2, 1)] * 3
