"""The layout by term: same rows as the layout by document, fewer of them read."""

import random

import pytest
from pyspark.sql import functions as F

from ranklab.compat import Compat
from ranklab.operators import index as ix, scoring as sc, term_layout as tl
from ranklab.registry import setup
from ranklab.registry.queries import REGISTRY
from ranklab.session import shared_folder, table_name
from ranklab.sinks import index_store as store


@pytest.fixture(scope="module")
def parts(spark):
    """A word in every document, rare words, equal documents (ties) and blocks that differ a lot."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(80)]
    docs = [(i, " ".join(["the"] * (1 + i % 5) + rng.choices(words[:20 + i // 10], k=rng.randint(1, 25)) + ["rare"] * (i % 97 == 5))) for i in range(600)]
    docs += [(600 + i, docs[3][1]) for i in range(40)] + [(700, ""), (701, None)]
    topics = [(q, " ".join(["the"] * (q % 2) + rng.choices(words, k=4) + ["rare"])) for q in range(9)] + [(20, "unknown"), (21, "")]
    index = ix.build_index(spark.createDataFrame(docs, "doc_id bigint, contents string"))
    path = shared_folder(spark)
    tl.write_layout(index, path, folders=16, block_rows=16)
    return index, tl.open_layout(spark, path, index), sc.measure_terms(spark.createDataFrame(topics, "query_id bigint, text string"))


def rows(run):
    return sorted(map(tuple, run.select("query_id", "rank", "row_id", F.round("score", 9).alias("s")).collect()))


@pytest.mark.parametrize("model, lam, compat", [("tfidf", 0.5, Compat()), ("jm", 0.3, Compat()), ("jm", 1.0, Compat()), ("tfidf", 0.5, Compat(copies=2, quantize=True))])
@pytest.mark.parametrize("k", [1, 7, 1000])
def test_same_hits(parts, model, lam, compat, k):
    index, layout, topics = parts
    whole = sc.best_hits(index, topics, k, lambda part: sc.score(part, topics, model, lam, compat), copies=compat.copies, bounded=False)
    assert rows(tl.top_k_by_blocks(layout, topics, k, model, lam, compat)) == rows(whole)


def test_few_blocks_are_read(parts, monkeypatch):
    index, layout, topics = parts
    seen = []
    plain = tl._scores
    monkeypatch.setattr(tl, "_scores", lambda layout, weights, part, wanted, *rest: seen.append(wanted) or plain(layout, weights, part, wanted, *rest))
    one = sc.measured(topics.terms.where("query_id = 4"))
    tl.top_k_by_blocks(layout, one, 3).collect()
    blocks = layout.blocks.join(one.terms, "term").select("block").distinct().count()
    assert seen[1].count() < blocks


def test_folders_are_pruned(spark, parts):
    index, layout, topics = parts
    rare = sc.measured(topics.terms.where("term = 'rare'"))
    plan = tl.rare_term_postings(layout, rare, 20)._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if "PartitionFilters" in line and "part#" in line]
    assert len(filters) >= 2 and all("part#" in f.split("PartitionFilters: [")[1].split("]")[0] for f in filters)
    assert tl.rare_term_postings(layout, rare, 20).count() == 9 * 7 and tl.rare_term_postings(layout, rare, 2).count() == 0


def test_searches_run_on_the_layout(parts):
    index, layout, topics = parts
    pruned = layout.pruned(topics).as_index()
    assert rows(sc.best_hits(pruned, topics, 5, lambda part: sc.score(part, topics))) == rows(sc.best_hits(index, topics, 5, lambda part: sc.score(part, topics)))


@pytest.mark.parametrize("factor", [1, 1 << 40])
def test_counts_by_bitmaps(spark, factor):
    rng = random.Random(2)
    docs = [(i * factor, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 4)))) for i in range(300)]
    topics = sc.measure_terms(spark.createDataFrame([(1, "a b a"), (2, "h"), (3, "zz")], "query_id bigint, text string"))
    index = ix.build_index(spark.createDataFrame(docs, "doc_id bigint, contents string"))
    want = sorted(map(tuple, sc.count_matches(sc.any_term_match(index, topics), 2).collect()))
    assert sorted(map(tuple, sc.count_by_bitmaps(index, topics, 2).collect())) == want
    empty = ix.build_index(spark.createDataFrame([], "doc_id bigint, contents string"))
    assert sc.count_by_bitmaps(empty, topics).collect() == []


def test_no_pair_leaves_a_task(spark, sf):
    plan = REGISTRY["count_matches"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert exchanged and not any("row_id" in line for line in exchanged)


def test_a_task_sorts_a_bounded_share_of_the_postings(spark, parts, monkeypatch):
    """Postings are cut into as many sorted ranges as their bytes ask for, and none is lost."""
    monkeypatch.setattr(tl, "SORT_BYTES", 2048, raising=False)
    index, layout, _ = parts
    path = shared_folder(spark)
    asked = []
    whole = tl._sorted
    monkeypatch.setattr(tl, "_sorted", lambda rows, tasks, *by: asked.append(tasks) or whole(rows, tasks, *by))
    tl.write_layout(index, path, folders=4, block_rows=16)
    n = index.coll_stats.agg(F.sum("n_tokens")).first()[0]
    assert min(asked) >= n * tl.POSTING_BYTES / 2048 > spark.sparkContext.defaultParallelism
    assert tl.open_layout(spark, path, index).postings.count() == layout.postings.count()


def test_few_terms_are_named_in_the_scan(parts):
    index, layout, topics = parts
    for where, named in (("query_id = 4", True), ("query_id < 9", False), ("query_id = 20", True), ("query_id = 99", True)):
        some = sc.measured(topics.terms.where(where))
        best = tl.top_k_by_blocks(layout, some, 5)
        assert ("In(term, [" in _plan(best) or "EqualTo(term," in _plan(best) or some.n_rows == 0) == named
        assert rows(best) == rows(sc.best_hits(index, some, 5, lambda part: sc.score(part, some), bounded=False))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [None, 0])
def test_no_posting_leaves_its_bucket(parts, monkeypatch, limit):
    """Blocks are bounded and documents scored in their bucket; with too many blocks to broadcast, these come to the buckets."""
    index, layout, topics = parts
    if limit is not None:
        monkeypatch.setattr(tl, "BROADCAST_BYTES", limit)
    best = tl.top_k_by_blocks(layout, topics, 7)
    plan = _plan(best)
    exchanged = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert "Bucketed: true" in plan and "SortMergeJoin" not in plan and exchanged
    assert not any("row_id" in line or "term#" in line for line in exchanged)
    assert ("ShuffledHashJoin" in plan) == (limit == 0)
    assert rows(best) == rows(sc.best_hits(index, topics, 7, lambda part: sc.score(part, topics), bounded=False))
    assert "Exchange" not in _plan(ix.term_stats(layout.postings, "part", "block"))


def test_more_topics_than_bits_in_a_word(spark, parts):
    index, layout, _ = parts
    topics = sc.measure_terms(spark.createDataFrame([(q * 7 - 300, f"w{q % 80} w{q * 3 % 80} rare") for q in range(150)], "query_id bigint, text string"))
    assert topics.n_topics > 2 * tl.TOPIC_BITS
    assert rows(tl.top_k_by_blocks(layout, topics, 3)) == rows(sc.best_hits(index, topics, 3, lambda part: sc.score(part, topics), bounded=False))


def test_documents_of_a_stored_index_move_before_they_are_opened_up(spark, monkeypatch):
    """What moves is a row per document; the layout of a stored index holds its postings, also when it is written and opened again."""
    path, stored = shared_folder(spark), shared_folder(spark)
    docs = spark.createDataFrame([(i, f"the w{i % 7} w{i % 3} w{i % 3}, it's 3.5 été") for i in range(300)] + [(300, ""), (301, None)], "doc_id bigint, contents string")
    store.create_index(docs, stored, buckets=3)
    index = store.open_index(spark, stored)
    plan = _plan(tl._by_block(index, F.floor(F.col("row_id") / 16).alias("block"), 5))
    assert plan.index("Generate inline") < plan.index("Exchange hashpartitioning(block") and plan.count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(tl, "BUCKET_DOCS", 40)
    for _ in range(2):
        tl.write_layout(index, path, folders=4, block_rows=16)
    layout = tl.open_layout(spark, path, index)
    assert spark.read.parquet(f"{path}/layout").first()["buckets"] == max(spark.sparkContext.defaultParallelism, 8)
    want = sorted(map(tuple, index.postings.select("term", "row_id", "tf", "dl").collect()))
    assert sorted(map(tuple, layout.as_index().postings.collect())) == want and len(want) == 300 * 6 - len([i for i in range(300) if i % 7 == i % 3])
    for name in ("postings", "blocks"):
        spark.sql(f"DROP TABLE {table_name(f'{path}/{name}')}")
    assert sorted(map(tuple, tl.open_layout(spark, path, index).as_index().postings.collect())) == want
