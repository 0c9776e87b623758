"""Quality rules, URL filters, language ID and the quality classifier."""

import re
import tracemalloc
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from compare import check, duck
from conftest import SMALL
from statcube.llm import language_id, quality_classifier, quality_rules, url_filters
from statcube.llm.queries import ORACLES, QUERIES
from statcube.llm.shared import ship_package, table

ODD_TEXTS = [None, "", " \t\n", "a", "a b a b a b a b", "x\u00a0y\u2003z", "é" * 3, "line\nline\n \n\nline", "w " * 30_000, "#*$%&|<> a", "日本語 テキスト", "\ud7ff \U0001f600"]


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def odd_docs(spark):
    """Odd texts, repeated rows and missing ids, with extra columns that clash with result names."""
    rows = [(k, t, "x", 1.0) for k, t in enumerate(ODD_TEXTS)] + [(0, None, "x", 1.0), (None, "no id", None, None), (3, "a", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, score double")


def signals(text):
    """Brute force of the base signals."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_signals_equal_brute_force(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text").unionByName(odd_docs(spark).select("doc_id", "text").filter("doc_id IS NOT NULL").distinct().selectExpr("-1 - doc_id AS doc_id", "text"))
    found = {r["doc_id"]: r for r in quality_rules.quality_signals(docs).collect()}
    for doc_id, text in docs.collect():
        r, want = found[doc_id], signals(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_rule_order_changes_work_not_result(spark):
    docs = table(spark, SMALL, "documents")
    rules = quality_rules.BASE_RULES + quality_rules.METHOD_RULES
    measured = quality_rules.profile_rules(docs, rules)
    assert set(measured) == {r.name for r in rules}
    ordered = quality_rules.order_rules(rules, measured)
    rates = [measured[r.name].rejection_per_cost for r in ordered]
    assert rates == sorted(rates, reverse=True)
    asked = []
    first = quality_rules.Rule("first", lambda v: True)
    second = quality_rules.Rule("second", lambda v: asked.append(v) or True)
    assert quality_rules.first_rejection(quality_rules.TextView("a"), [first, second]) == "first" and not asked
    kept = {r.doc_id for r in quality_rules.quality_cascade(docs, rules).collect()}
    assert kept == {r.doc_id for r in docs.collect() if not any(rule.rejects(quality_rules.TextView(r.text)) for rule in rules)}


def test_junk_goes_and_clean_documents_stay(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SMALL.replace("0.001", "0.01"), "labels").collect()}
    found = quality_rules.quality_signals(table(spark, SMALL.replace("0.001", "0.01"), "documents")).collect()
    clean = [r.kept for r in found if labels.get(r.doc_id) == 1 and not r.base_failed]
    junk = [r.kept for r in found if labels.get(r.doc_id) == 0]
    assert np.mean(clean) > 0.99 and np.mean(junk) < 0.05


def test_quality_rules_on_odd_and_empty_tables(spark):
    docs = odd_docs(spark)
    assert quality_rules.quality_signals(docs).count() == docs.count()
    assert quality_rules.quality_signals(docs.limit(0)).count() == 0
    assert quality_rules.quality_cascade(docs).columns == docs.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, con, name):
    rows, difference = check(spark, con, SMALL, QUERIES[name], ORACLES[name])
    assert difference is None and rows > 0


URLS = [
    None, "", "no scheme", "http://NET/", "http://a.net", "http://a.net/", "http://a.net?x/", "https://b.EXAMPLE.net/en/1", "https://example.net/en", "https://xexample.com/de/",
    "https://example.com/de/x?y#z", "https://m.example.com/DE/", "ftp://a.org/fr/", "a://b://c.org/fr/", "http://casino.org/en", "http://x.org/my-ads/1", "http://x.org/roads/", "http://ads-track.org/", "http://a.net:80/",
]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        rule, verdict = max(fits, key=lambda x: len(x[0]))
        return host, path, rule, verdict
    word = any(re.search(rf"(?:^|[^a-z0-9]){w}(?:[^a-z0-9]|$)", (host + path).lower()) for w in url_filters.BLOCKED_WORDS)
    return host, path, None, "block" if word else "allow"


@pytest.mark.parametrize("inline", [url_filters.INLINE_TOKENS, 0])
def test_urls_against_brute_force(spark, inline):
    rows = [(k, u, "x") for k, u in enumerate(URLS)] + [(3, URLS[3], None), (None, "http://a.net/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    extra = url_filters.UrlRule(r"\d{9}", r"\d{9}", "block", ())
    found = url_filters.judge_urls(pages, [*url_filters.HOST_RULES, *url_filters.WORD_RULES, extra], inline_tokens=inline).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule, r.verdict) == judged(URLS[r.page_id])
    assert url_filters.judge_urls(pages.limit(0), url_filters.HOST_RULES, inline_tokens=inline).count() == 0
    assert url_filters.judge_urls(pages, [], inline_tokens=inline).filter("verdict <> 'allow'").count() == 0


def test_rules_lie_under_their_rarest_token(spark):
    pages = table(spark, SMALL, "pages").selectExpr("split(lower(url), '[^a-z0-9]+') AS __tokens")
    place = url_filters.rarest_tokens(pages, [url_filters.host_rule("block", "example.com", "/zzz/")])
    assert list(place.values()) == ["zzz"]


def test_url_query_runs_no_python(spark):
    plan = QUERIES["op10_url_filters"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "html" not in plan.split("== Physical Plan ==")[1]


def fold(doc_id, folds):
    return crc32(str(doc_id).encode()) % folds


def test_languages_of_held_out_documents(spark):
    folder = SMALL.replace("0.001", "0.01")
    truth = {r.doc_id: r.lang for r in table(spark, folder, "documents").collect()}
    found = QUERIES["op4_language_id"](spark, folder).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in found)
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in found if r.held_out]) > 0.97


def test_languages_of_odd_texts(spark):
    model = language_id.learn_languages(language_id.training_rows(table(spark, SMALL, "documents")))
    docs = odd_docs(spark)
    found = language_id.predict_languages(docs, model).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[0].lang_pred == by_id[1].lang_pred == by_id[2].lang_pred == "und" and by_id[0].score == 0
    assert by_id[None].held_out and by_id[4].lang_pred in model.languages
    nothing = language_id.learn_languages(docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang"))
    assert {r.lang_pred for r in language_id.predict_languages(docs, nothing).collect()} == {"und"}
    single = language_id.learn_languages(docs.selectExpr("text", "'xx' AS lang"))
    assert single.predict("abc") == ("xx", 1.0, False)


def test_rare_languages_are_learned(spark):
    """A language is known whatever its share of the labelled rows, and if most of its texts have no letter."""
    rows = spark.range(6000).selectExpr("concat('the house number ', id) AS text", "IF(id % 2 = 0, 'en', 'xx') AS lang")
    rare = spark.createDataFrame([("ein seltenes wort", "de")], "text string, lang string")
    bare = spark.range(3000).selectExpr("IF(id = 2999, 'un mot', concat('1 ', id)) AS text", "'fr' AS lang")
    model = language_id.learn_languages(rows.unionByName(rare).unionByName(bare), sample_rows=40)
    assert model.languages == ("de", "en", "fr", "xx")


def test_codewords_differ():
    for n in (2, 4, 6, 30):
        code = language_id.codewords(n)
        apart = (code.shape[1] - code @ code.T) / 2
        assert apart[~np.eye(n, dtype=bool)].min() >= (1 if n == 2 else 2)
        assert len({tuple(c) for c in code.T} | {tuple(-c) for c in code.T}) == 2 * code.shape[1] or n == 30


def test_quality_of_held_out_documents(spark):
    folder = SMALL.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    found = QUERIES["op5_quality_classifier"](spark, folder).collect()
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert np.mean([labels[r.doc_id] == r.predicted for r in found if r.held_out and r.doc_id in labels]) > 0.95


def test_quality_of_odd_texts_and_without_labels(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(0, None), (None, 1), (999, 1)], "doc_id long, quality int")
    model = quality_classifier.learn_quality(docs, labels)
    found = quality_classifier.score_documents(docs, model).collect()
    assert len(found) == docs.count() and {r.score for r in found} == {0.5}
    labelled = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS quality")
    scores = quality_classifier.score_documents(docs, quality_classifier.learn_quality(docs, labelled)).collect()
    assert all(0 <= r.score <= 1 for r in scores)


def test_gradients_of_the_attention_model():
    """Scores follow the labels when one passage of a bag tells them apart."""
    rng = np.random.default_rng(0)
    bags, labels = [], []
    for k in range(400):
        bag = rng.normal(size=(rng.integers(1, 9), quality_classifier._SIZE)).astype(np.float32)
        if k % 2:
            bag[rng.integers(len(bag)), :3] += 4
        bags.append(bag)
        labels.append(k % 2)
    model = quality_classifier.fit(bags, np.asarray(labels, float))
    right = 0
    for bag, label in zip(bags, labels):
        rows = np.clip((bag - model.mean) / model.spread, -8, 8)
        logit = quality_classifier._forward(model.layers, rows, np.zeros(1, np.int64))[-1][0]
        right += (logit > 0) == bool(label)
    assert right / len(bags) > 0.95


def test_passages_in_slices_and_in_bounded_memory(monkeypatch):
    texts = ["", " \n", "a", "é " * 300 + " x", "a b c " * 700, "\x0b\x85 q " * 500, " ".join(f"w{k % 150}" for k in range(2000))]
    whole = [quality_classifier.passages(t) for t in texts]
    long = " ".join(f"w{k % 5000}" for k in range(1_500_000))
    tracemalloc.start()
    assert quality_classifier.passages(long).shape[0] == -(-1_500_000 // quality_classifier.PASSAGE_WORDS)
    assert tracemalloc.get_traced_memory()[1] < 25 * len(long)
    tracemalloc.stop()
    monkeypatch.setattr(quality_classifier, "_SLICE", 2)
    for text, rows in zip(texts, whole):
        assert np.allclose(quality_classifier.passages(text), rows, atol=1e-5)


def test_quality_sample_is_drawn_from_labels_with_a_document(spark):
    docs = spark.createDataFrame([(k, "plain words in a row " * 3 if k % 2 else "## %% $$ || " * 9) for k in range(40)] * 2, "doc_id long, text string")
    labels = spark.range(100_000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality").unionAll(spark.range(40).selectExpr("id", "CAST(id % 2 AS int)"))
    model = quality_classifier.learn_quality(docs, labels, sample_rows=100)
    assert model.score("plain words in a row " * 3) > 0.5 > model.score("## %% $$ || " * 9)
