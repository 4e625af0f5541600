"""Properties that must hold whatever the layout: partitions, copies, broadcast or not."""

import math
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ranklab import session
from ranklab.compat import REFERENCE, Compat
from ranklab.functions import text as tx
from ranklab.operators import index as ix, scoring as sc
from ranklab.registry import setup
from ranklab.session import join_small, shared_folder
from ranklab.sinks import index_store as store

LARGE = 10 ** 12


@pytest.fixture(scope="module")
def parts(spark):
    """Documents where one word is in every document and a third of all words."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(["the"] * (i % 9) + rng.choices(words, k=rng.randint(1, 30)))) for i in range(300)]
    topics = [(q, " ".join(["the"] + rng.choices(words, k=5))) for q in range(12)]
    return docs, topics


@pytest.fixture(scope="module")
def frames(spark, parts):
    docs, topics = parts
    return (spark.createDataFrame(docs, "doc_id bigint, contents string"),
            spark.createDataFrame(topics, "query_id bigint, text string"))


def brute(docs, topics, k):
    """TF-IDF by plain loops."""
    counts = {d: Counter(t.split()) for d, t in docs}
    df = Counter(w for c in counts.values() for w in c)
    out = {}
    for q, text in topics:
        scores = {}
        for d, c in counts.items():
            length = sum(c.values())
            parts = [n * math.sqrt(c[w] / length) * (math.log((len(docs) + 1) / (df[w] + 1)) + 1)
                     for w, n in Counter(text.split()).items() if w in c]
            if parts:
                scores[d] = sum(parts)
        out[q] = sorted(scores, key=lambda d: (-round(scores[d], 9), d))[:k]
    return out


def ranking(run):
    rows = run.select("query_id", "rank", "row_id", F.round("score", 9).alias("score")).collect()
    return sorted(map(tuple, rows))


def test_against_plain_loops(frames, parts):
    docs, topics = frames
    rows = sc.run(ix.build_index(docs), sc.measure_terms(topics), 10).orderBy("query_id", "rank").collect()
    got = {}
    for r in rows:
        got.setdefault(r.query_id, []).append(r.doc_id)
    assert got == brute(*parts, 10)


def test_independent_of_partitioning(spark, frames):
    docs, topics = frames
    terms = sc.measure_terms(topics)
    runs = [ranking(sc.run(ix.build_index(docs.repartition(n)), terms, 10)) for n in (1, 5, 23)]
    path = shared_folder(spark)
    store.create_index(docs, path, buckets=5)
    runs.append(ranking(sc.run(store.open_index(spark, path), terms, 10)))
    assert all(r == runs[0] for r in runs)


def test_salted_join_when_topics_are_too_large_to_broadcast(frames):
    docs, topics = frames
    index, terms = ix.build_index(docs), sc.measure_terms(topics)
    large = sc.TopicTerms(terms.terms, terms.n_rows, LARGE, LARGE)
    found = sc.run(index, large, 10)
    assert "(salt" in found._jdf.queryExecution().optimizedPlan().toString()
    assert ranking(found) == ranking(sc.run(index, terms, 10))


def test_bounds_change_nothing(frames):
    """Dropping documents below the bound of the leading ones gives the full sort's ranking."""
    docs, topics = frames
    index, terms = ix.build_index(docs), sc.measure_terms(topics)
    for k in (1, 10, 1000):
        some = sc.best_hits(index, terms, k, lambda i: sc.score(i, terms), bounded=True)
        assert ranking(some) == ranking(sc.top_k(sc.score(index, terms), k))
    for copies in (1, 2):
        compat = Compat(copies=copies)
        grid = sc.best_hits(index, terms, 5, lambda i: sc.score_grid(i, terms, compat=compat),
                            ("query_id", "lam"), 10, copies, True)
        full = sc.top_k(sc.score_grid(index, terms, compat=Compat(copies=copies)), 5, ("query_id", "lam"), copies)
        assert grid.exceptAll(full.select(grid.columns)).count() == 0 and grid.count() == full.count()


def test_join_small_keeps_all_rows_of_a_hot_key(spark):
    big = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("k"),
                                   F.col("id").alias("row_id"))
    small = spark.range(100).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v")) \
        .unionByName(spark.createDataFrame([("hot", -1), ("hot", -2)], "k string, v bigint"))
    wide, salted = join_small(big, small, "k", 0), join_small(big, small, "k", LARGE)
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, salted.collect()))


def test_copies_are_equal_to_stored_copies(frames):
    """Scaling the statistics gives what indexing every document twice gives."""
    docs, topics = frames
    terms = sc.measure_terms(topics)
    for model in ("tfidf", "jm"):
        compat = Compat(copies=2, quantize=True)
        virtual = ranking(sc.run(ix.build_index(docs), terms, 7, model, 0.3, compat))
        twice = sc.score(ix.build_index(docs, copies=2), terms, model, 0.3, Compat(quantize=True))
        assert virtual == ranking(sc.top_k(twice, 7))
        assert all(n % 2 == 0 for _, n in sc.count_matches(sc.any_term_match(ix.build_index(docs), terms), 2).collect())


def test_append_equals_create(spark, frames):
    docs, topics = frames
    whole, grown = shared_folder(spark), shared_folder(spark)
    store.create_index(docs, whole, buckets=3)
    for part in ("doc_id < 100", "doc_id between 100 and 199", "doc_id > 199"):
        store.write_index(docs.where(part), grown, "create_or_append")
    a, b = store.open_index(spark, whole), store.open_index(spark, grown)
    assert store.count_documents(a).first() == store.count_documents(b).first()
    terms = sc.measure_terms(topics)
    names = ("query_id", "rank", "doc_id")
    assert sorted(map(tuple, sc.run(a, terms, 10).select(*names).collect())) == \
        sorted(map(tuple, sc.run(b, terms, 10).select(*names).collect()))


def test_merged_and_upserted_index(frames):
    docs, topics = frames
    terms = sc.measure_terms(topics)
    whole = ranking(sc.run(ix.build_index(docs), terms, 10))
    low, high = docs.where("doc_id < 150"), docs.where("doc_id >= 150")
    assert whole == ranking(sc.run(ix.merge_index(ix.build_index(low), ix.build_index(high)), terms, 10))
    stale = ix.build_index(docs.withColumn("contents", F.when(F.col("doc_id") < 50, F.lit("w1 w2 stale")).otherwise(F.col("contents"))))
    # replaced documents stand behind the others, so ties may be ordered otherwise: all hits are compared by document
    hits = lambda index: sorted((r.query_id, r.doc_id, round(r.score, 8)) for r in sc.run(index, terms, 1000).collect())
    assert hits(ix.build_index(docs)) == hits(ix.upsert_index(stale, ix.build_index(docs.where("doc_id < 50"))))


def test_create_replaces(spark, frames):
    docs, _ = frames
    path = shared_folder(spark)
    store.write_index(docs, path, "create")
    store.write_index(docs.where("doc_id < 10"), path, "create")
    index = store.open_index(spark, path)
    assert store.count_documents(index).first().n_docs == 10
    assert index.postings.where("row_id >= 10").count() == 0
    with pytest.raises(ValueError):
        store.write_index(docs, path, "replace")


def test_no_shuffle_before_the_local_top_k(spark, frames):
    """From the stored postings to the k best rows of a task nothing is exchanged."""
    docs, topics = frames
    path = shared_folder(spark)
    store.create_index(docs, path, buckets=4)
    terms = sc.measure_terms(topics)
    best = sc.top_k(sc.score(store.open_index(spark, path), terms), 10)
    plan = best._jdf.queryExecution().executedPlan().toString()
    local = plan[plan.index("row_number(), 10, Partial"):plan.index("BroadcastHashJoin")]
    assert "Exchange" not in local and "Bucketed: true" in plan


def test_a_bucket_holds_what_a_task_can_score(spark):
    """Buckets grow in number with the text and with the documents, not in size."""
    for n_bytes, n_docs in ((6 << 30, 2_400_000), (60 << 30, 24_000_000), (1 << 30, 50_000_000)):
        buckets = store.bucket_count(spark, n_bytes, n_docs)
        assert n_bytes / buckets <= 32 << 20 and n_docs / buckets <= 16384
    assert store.bucket_count(spark, 0, 0) == spark.sparkContext.defaultParallelism


def test_a_bucket_is_as_large_in_a_larger_collection(spark):
    """From 0.1 GB on a task of a search holds the same number of documents; only the tasks become more."""
    held = [(n * 51282) / store.bucket_count(spark, n * 103_000_000, n * 51282) for n in (1, 10, 60)]
    assert max(held) <= 4096 and max(held) < 1.1 * min(held)


def test_many_short_documents_have_many_buckets(spark, monkeypatch):
    path = shared_folder(spark)
    monkeypatch.setattr(store, "BUCKET_DOCS", 20, raising=False)
    store.create_index(spark.createDataFrame([(i, f"w{i % 7} the") for i in range(400)], "doc_id bigint, contents string"), path)
    assert spark.read.parquet(f"{path}/layout").first()["buckets"] == 20
    assert store.open_index(spark, path).documents.count() == 400


def test_stored_matches_are_counted_without_a_sort(spark, frames):
    docs, topics = frames
    path = shared_folder(spark)
    store.create_index(docs, path, buckets=4)
    index, terms = store.open_index(spark, path), sc.measure_terms(topics)
    counts = sc.count_by_bitmaps(index, terms, 2)
    assert "SortAggregate" not in counts._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, sc.count_by_bitmaps(ix.build_index(docs), terms, 2).collect()))


def test_several_models_from_one_scan(spark, frames):
    docs, topics = frames
    path = shared_folder(spark)
    store.create_index(docs, path, buckets=4)
    index, terms = store.open_index(spark, path), sc.measure_terms(topics)
    scores = sc.score_models(index, terms, ("tfidf", "jm", "x"), 0.3, Compat(lenient_names=True))
    assert scores._jdf.queryExecution().executedPlan().toString().count("Bucketed: true") == 1
    with pytest.raises(ValueError):
        sc.score_models(index, terms, ("x",))
    both = sc.run_models(index, terms, 7, ("tfidf", "jm"), 0.3)
    rows = both.select("model", "query_id", "rank", "row_id", F.round("score", 9)).collect()
    for model in ("tfidf", "jm"):
        assert sorted(tuple(r)[1:] for r in rows if r["model"] == model) == ranking(sc.run(index, terms, 7, model, 0.3))


def test_logarithms_are_taken_before_topics_are_joined(spark, frames):
    """A posting's ten logarithms are the same for all topics that share its term; nothing is exchanged for that."""
    docs, topics = frames
    path = shared_folder(spark)
    store.create_index(docs, path, buckets=4)
    plan = sc.score_grid(store.open_index(spark, path), sc.measure_terms(topics))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("BroadcastHashJoin") < plan.index("LOG1P") and plan.count("Bucketed: true") == 1
    assert "Exchange" not in plan[:plan.index("BroadcastHashJoin")]


def test_documents_behind_the_bounds_go_before_rows_are_opened_up(frames):
    docs, topics = frames
    index, terms = ix.build_index(docs), sc.measure_terms(topics)
    lenient = Compat(lenient_names=True)
    for k, copies in ((5, 2), (1000, 1)):
        compat = Compat(copies=copies)
        grid = lambda i, bounds=None: sc.score_grid(i, terms, compat=compat, bounds=bounds)
        models = lambda i, bounds=None: sc.score_models(i, terms, ("tfidf", "jm", "x"), 0.3, replace(lenient, copies=copies), bounds)
        for by, groups, scorer in ((("query_id", "lam"), 10, grid), (("query_id", "model"), 3, models)):
            some = sc.best_hits(index, terms, k, scorer, by, groups, copies, True, takes_bounds=True)
            full = sc.top_k(scorer(index), k, by, copies).select(some.columns)
            assert sorted(map(tuple, some.collect())) == sorted(map(tuple, full.collect()))
    plan = sc.best_hits(index, terms, 5, scorer, by, groups, 1, True, takes_bounds=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate inline") < plan.index("BroadcastHashJoin [query_id")


def test_words_are_sorted_outside_of_lambda_functions(spark, frames):
    """Generated code sorts a document's words to store; each text is cut into words once."""
    plan = store._nested(frames[0], None, 1, 4, "b")._jdf.queryExecution().optimizedPlan().toString()
    sorts = [line for line in plan.splitlines() if "sort_array(" in line]
    assert len(sorts) == 1 and "lambda" not in sorts[0] and plan.count("sort_array(") == 1
    assert plan.count("regexp_extract_all(") == 1


def test_stored_words_and_places_equal_a_count_by_hand(spark):
    texts = ["b a b", "", None, "a", "x x x", "é e É a.b a.b", " ... ", "the " * 50 + "end"]
    path = shared_folder(spark)
    store.create_index(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, contents string"), path, buckets=3)
    words = [[] if t is None else [w for w in t.lower().split() if w != "..."] for t in texts]
    rows = {r["doc_id"]: r for r in spark.table(store._name(path)).collect()}
    assert len(rows) == len(texts)
    for i, ws in enumerate(words):
        found = {t["term"]: (t["tf"], p) for t, p in zip(rows[i]["terms"] or [], rows[i]["positions"] or [])}
        places = {w: [j for j, x in enumerate(ws) if x == w] for w in ws}
        assert rows[i]["dl"] == len(ws) and found == {w: (len(p), p) for w, p in places.items()}
        assert (rows[i]["terms"] is None) == (not ws) and list(found) == sorted(found, key=str.encode)
    lists = spark.createDataFrame([(i, ws) for i, ws in enumerate(words)], "i int, words array<string>")
    runs = lists.select("i", F.inline(tx.term_positions(F.col("words")))).collect()
    assert sorted((r["i"], r["term"], r["tf"], r["positions"]) for r in runs) == sorted(
        (i, w, ws.count(w), [j for j, x in enumerate(ws) if x == w]) for i, ws in enumerate(words) for w in set(ws))


def test_counting_words_needs_no_shuffle(spark, frames):
    plan = ix.postings(ix.with_row_ids(frames[0]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_shared_folder_needs_a_setting_on_a_cluster(spark, monkeypatch):
    class Cluster:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        conf, sparkContext = {}, Cluster

    with pytest.raises(ValueError):
        session.shared_folder(Session)


def test_every_metric_is_a_share(spark, sf):
    from ranklab.registry.queries import _search
    for compat in (Compat(), REFERENCE):
        rows = _search(spark, sf, compat=compat)[1].metrics.collect()
        assert rows and all(0 <= r.p <= 1 and (r.r is None or 0 <= r.r <= 1) for r in rows)


def test_halves_cover_all_topics(spark, sf):
    e = setup.experiment(spark, sf)
    low, high = e.halves()
    ids = [r.query_id for half in (low, high) for r in half.topics.collect()]
    assert sorted(ids) == sorted(r.query_id for r in e.topics.collect())
