"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ranklab.llm import (decontaminate, html_text, licenses, near_dup, packing, quality_knn, quality_rules,
                         secret_scan, toxicity, url_filter)
from ranklab.llm.queries import tokenizer

# names that operators use inside, as additional columns
CLASHING = ("key", "rules", "row", "spans", "words", "hits", "items", "node", "bucket", "score", "task", "label", "host", "x0",
            "g_lang", "template", "_", "rest", "p1", "found")
LONG = "the long tale of thon and ther " * 20000
TEXTS = [None, "", " \n\t", "!!!", "one", "one", LONG, "token = abcdef123 here", "thin then than thou there was a tale to tell",
         "thin then than thou there was a tale to tell", "\0 nul \x85 and   some é ünï 漢字 🙂 text"]


def extra(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING if c not in df.columns])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "src", 0) for i, t in enumerate(TEXTS)]
    rows += [(None, "a text without an id", None, None, None), (None, None, None, None, None), rows[8], rows[8]]
    return extra(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3))


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, h) for i, (u, h) in enumerate([(None, None), ("", ""), ("no scheme", "<p>a"), ("http://", "plain"),
            ("http://A.com", "<" * 2000), ("http://a.com/de/x", "<div>" * 3000 + "deep"), ("http://a.com/de/x", "<article><p>x &amp; y</article>")])]
    return extra(spark.createDataFrame([*rows, rows[-1], (None, None, None)], "page_id long, url string, html string"))


@pytest.fixture(scope="module")
def benchmark(spark):
    return extra(spark.createDataFrame([(1, "long tale of thon"), (2, None), (3, ""), (None, "thin then than"), (1, "one")],
                                       "item_id long, text string"))


@pytest.fixture(scope="module")
def labels(spark):
    return extra(spark.createDataFrame([(0, 1, 0), (4, 1, 0), (6, 0, 1), (8, 1, 0), (8, 0, 1), (None, 1, 1), (5, None, None)],
                                       "doc_id long, quality int, toxic int"))


def per_row(out, docs):
    assert sorted(map(str, (r["doc_id"] for r in out))) == sorted(map(str, (r["doc_id"] for r in docs.select("doc_id").collect())))


def run(which, docs, benchmark, labels):
    if which == "packing":
        return packing.pack(docs, tokenizer())
    if which == "secrets":
        return secret_scan.digest(secret_scan.scan(docs))
    if which == "toxicity":
        return toxicity.score(docs, toxicity.fit(docs, labels))
    if which == "decontaminate":
        return decontaminate.digest(decontaminate.matches(docs, benchmark))
    if which == "near":
        return near_dup.classes(docs)
    if which == "rules":
        return quality_rules.judge(docs)
    if which == "licenses":
        return licenses.scan(docs)
    return quality_knn.score(docs, quality_knn.fit(docs, labels)).select("doc_id", "held_out", "score", "predicted")


DOCUMENT_OPERATORS = ["packing", "secrets", "toxicity", "decontaminate", "near", "rules", "licenses", "knn"]


@pytest.mark.parametrize("which", DOCUMENT_OPERATORS)
def test_odd_documents(which, docs, benchmark, labels):
    out = run(which, docs, benchmark, labels).collect()
    if which == "packing":
        out = [r for r in out if r["piece"] == 0]
    per_row(out, docs)
    by = {r["doc_id"]: r for r in out}
    if which == "packing":
        assert all(by[i]["length"] == 1 for i in (0, 1))                    # the end id alone
    if which == "secrets":
        assert by[7]["n_assign"] == 1 and by[0]["spans"] == by[1]["spans"] == ""
    if which == "decontaminate":
        assert by[6]["n_hit"] == 4 * 20000 and by[0]["n_words"] == 0 and by[8]["longest_item"] is None and by[8]["n_hit"] == 3
    if which == "near":
        first = [r for r in out if r["first"]]
        assert by[5]["class_id"] == 4 and by[9]["class_id"] == 8 and by[0]["class_id"] == by[1]["class_id"] == 0
        assert by[3]["class_id"] == 3 and sum(r["doc_id"] == 8 for r in first) == 3
    if which == "rules":
        assert by[0]["n_words"] == 0 and by[0]["base_failed"] and by[6]["n_repeat_words"] == by[6]["n_words"]
    if which == "licenses":
        assert by[0]["n_words"] == by[1]["n_words"] == 0 and by[0]["labels"] == ""
    if which == "knn":
        assert by[0]["score"] == by[1]["score"] == by[2]["score"] and all(0 <= r["score"] <= 1 for r in out)
    if which == "toxicity":
        assert by[0]["severity"] == by[1]["severity"]


@pytest.mark.parametrize("which", DOCUMENT_OPERATORS)
def test_empty_documents(which, docs, benchmark, labels):
    assert run(which, docs.limit(0), benchmark, labels).count() == 0


def test_no_labels_no_benchmark(docs, benchmark, labels):
    assert {r["toxic"] for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {False}
    assert {r["score"] for r in quality_knn.score(docs, quality_knn.fit(docs, labels.limit(0))).collect()} == {0.5}
    assert {r["n_hit"] for r in decontaminate.digest(decontaminate.matches(docs, benchmark.limit(0))).collect()} == {0}


def test_pages(spark, pages):
    by = {}
    for r in html_text.extract(pages).collect():
        by.setdefault(r["page_id"], []).append(r)
    assert [by[i][0]["text"] for i in (0, 1, 2, 3, 5, 6)] == ["", "", "a", "plain", "deep", "x & y"]
    assert len(by[6]) == 2 and len(by[4][0]["text"]) == by[4][0]["n_chars"] == 2000
    assert html_text.extract(pages.limit(0)).count() == 0
    rules = url_filter.base_rules(spark)
    judged = url_filter.judge(pages, rules).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in judged if r["page_id"] is not None) == [
        (0, "", "", None, "allow"), (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "a.com", "", None, "allow"), (5, "a.com", "/de/x", "com/de/", "block"), (6, "a.com", "/de/x", "com/de/", "block"),
        (6, "a.com", "/de/x", "com/de/", "block")]
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {r["rule"] for r in url_filter.judge(pages, rules.limit(0)).collect()} == {None}


def test_stages_keep_all_columns(docs, benchmark):
    assert decontaminate.remove(docs, benchmark).columns == docs.columns
    kept = near_dup.first_of_class(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert ids.count(8) == 1 and 9 not in ids and 5 not in ids and ids.count(None) == 1
    clean = secret_scan.redact(secret_scan.scan(docs)).where("doc_id = 7").first()["text"]
    assert clean == "[secret] here"
    assert sorted(secret_scan.scan(docs).columns) == sorted(docs.columns)
    assert secret_scan.scan(docs, into="other").columns == [*docs.columns, "other"]


def test_pipeline_on_odd_documents(spark, docs, benchmark, labels, tmp_path):
    for name, table in (("benchmark", benchmark), ("labels", labels)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    for rows in (docs, docs.limit(0)):
        out = rows
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.keep(stage(spark, out, str(tmp_path)))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
