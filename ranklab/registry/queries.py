"""One registered query per operator. All read the given tables in full."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ranklab.compat import REFERENCE, Compat
from ranklab.functions import text as tx
from ranklab.operators import evaluate as ev, index as ix, scoring as sc, significance as sg, tune, term_layout as tl
from ranklab.plans import experiments as ex
from ranklab.registry import setup
from ranklab.registry.setup import CUT, TRAIN_CUT, experiment
from ranklab.session import broadcast_if, keep, shared_folder
from ranklab.sinks import index_store as store, reports
from ranklab.sources import judgments as js, records, samples, tagged

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

COPIES = Compat(copies=2, quantize=True)
ALPHA = 0.05


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def r6(name: str, alias: str | None = None):
    return F.round(F.col(name).cast("double"), 6).alias(alias or name)


def raw_documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


# ---- sources -------------------------------------------------------------------

@query
def src_tagged_collection(spark, sf):
    path = f"{shared_folder(spark)}/collection"
    tagged.tagged_lines(raw_documents(spark, sf)).write.text(path)
    return tagged.read_tagged(spark, path)


@query
def src_collection_routing(spark, sf):
    folder = shared_folder(spark)
    docs = raw_documents(spark, sf)
    tagged.tagged_lines(docs).write.text(f"{folder}/docs.ALL")
    records.record_lines(docs).select("value").write.text(f"{folder}/docfiles")
    parts = [records.read_collection(spark, f"{folder}/{name}").withColumn("route", F.lit(route))
             for name, route in (("docs.ALL", "tagged"), ("docfiles", "files"))]
    return parts[0].unionByName(parts[1])


@query
def src_doc_files(spark, sf):
    path = f"{shared_folder(spark)}/nested"
    lines = records.record_lines(raw_documents(spark, sf)).select("source", "lang", "value")
    lines.write.partitionBy("source", "lang").text(path)
    return records.read_records(spark, path).select(
        F.regexp_extract("path", r"source=([^/]*)/", 1).alias("source"),
        F.regexp_extract("path", r"lang=([^/]*)/", 1).alias("lang"), "doc_id", "contents")


@query
def src_doc_records(spark, sf):
    noisy = raw_documents(spark, sf).select(F.concat(
        F.lit("no id yet\n"), F.col("doc_id").cast("string"), F.lit("\n"), F.col("text"),
        F.lit("\n / \r\nleft over")).alias("value"))
    return records.records_in(noisy)


@query
def src_topics(spark, sf):
    path = f"{shared_folder(spark)}/topics"
    tagged.tagged_lines(setup.bodies(spark, sf), text="body").write.text(path)
    return tagged.read_topics(spark, path)


@query
def src_qrels(spark, sf):
    path = f"{shared_folder(spark)}/qrels"
    js.qrels_lines(experiment(spark, sf).qrels).write.text(path)
    return js.read_qrels(spark, path)


@query
def src_index(spark, sf):
    return experiment(spark, sf).index.postings.select("term", "row_id", "tf", "dl")


@query
def src_samples(spark, sf):
    path = f"{shared_folder(spark)}/scores"
    (raw_documents(spark, sf).orderBy("doc_id")
     .select(F.concat_ws(" ", "doc_id", "n_chars").alias("value")).write.text(path))
    return samples.read_samples(spark, path)


# ---- sinks ---------------------------------------------------------------------

def _stored_terms(spark, path):
    index = store.open_index(spark, path)
    n = index.coll_stats.agg(F.sum("n_docs").alias("n")).scalar()
    return ix.merge_term_stats(index.term_stats).select("term", "df", "cf", n.alias("n_docs"))


def _languages(spark, sf):
    docs = raw_documents(spark, sf).select("doc_id", F.col("text").alias("contents"), "lang")
    return docs.where("lang = 'en'"), docs.where("not (lang <=> 'en')")


@query
def snk_index_create(spark, sf):
    path = shared_folder(spark)
    store.create_index(_languages(spark, sf)[0], path)
    store.create_index(setup.documents(spark, sf), path)
    return _stored_terms(spark, path)


@query
def snk_index_append(spark, sf):
    path = shared_folder(spark)
    english, others = _languages(spark, sf)
    store.create_index(english, path)
    store.append_index(others, path)
    return _stored_terms(spark, path)


@query
def snk_index_create_or_append(spark, sf):
    path = shared_folder(spark)
    for part in _languages(spark, sf):
        store.write_index(part, path, "create_or_append")
    return store.open_index(spark, path).documents.select("doc_id", "dl")


def _revised(spark, sf):
    labels = keep(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id").distinct())
    return setup.documents(spark, sf).join(broadcast_if(labels, labels.count() * 32), "doc_id").withColumn("contents", F.concat(F.lit("revised "), F.col("contents")))


@query
def op_upsert_docs(spark, sf):
    return ix.upsert_docs(setup.documents(spark, sf), _revised(spark, sf))


@query
def snk_index_upsert(spark, sf):
    path = shared_folder(spark)
    store.create_index(setup.documents(spark, sf), path)
    store.write_index(_revised(spark, sf), path, "upsert")
    return _stored_terms(spark, path)


@query
def snk_index_count(spark, sf):
    return store.count_documents(experiment(spark, sf).index)


def _written(spark, lines, name):
    path = f"{shared_folder(spark)}/{name}"
    reports.write_lines(lines, path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def _search(spark, sf, model="tfidf", lam=0.5, compat=Compat(), cut=CUT):
    e = experiment(spark, sf)
    terms = e.fused_terms if compat.fuse_lines else e.terms
    ranked = setup.stored_run(spark, sf, "tfidf") if model == "tfidf" and compat == Compat() and cut <= CUT else None
    return e, ex.search_and_evaluate(e.index, e.topics, e.qrels, model, lam, cut, compat, terms, ranked)


@query
def snk_ranking_report(spark, sf):
    e, found = _search(spark, sf)
    return _written(spark, found.ranking_lines(CUT, CUT),
                    reports.ranking_name("documents", "tfidf", CUT, 0.5, "all"))


@query
def snk_metrics_csv(spark, sf):
    _, found = _search(spark, sf)
    return _written(spark, found.metrics_lines(CUT), reports.metrics_name("documents", "tfidf", CUT, "all"))


def _training(spark, sf, compat=Compat()):
    e = experiment(spark, sf)
    train, test = e.halves()
    ranked = setup.stored_run(spark, sf, "grid").join(F.broadcast(train.topics.select("query_id")), "query_id", "left_semi")
    return ex.train_and_test(e.index, train.topics, test.topics, e.qrels, TRAIN_CUT, "MAP", compat,
                             train.terms, test.terms, ranked)


@query
def snk_grid_csv(spark, sf):
    grid = _training(spark, sf).grid
    means = tune.grid_pivot(tune.lambda_means(grid).select(
        F.lit(0).alias("query_id"), "lam", F.col("mean_value").alias("value")))
    lines = reports.grid_csv(tune.grid_pivot(grid), means, "MAP", TRAIN_CUT)
    return _written(spark, lines, reports.training_name("documents", "low", "high", "MAP", TRAIN_CUT, "training"))


@query
def snk_heldout_csv(spark, sf):
    t = _training(spark, sf)
    return _written(spark, reports.heldout_csv(t.best, t.heldout, "MAP", TRAIN_CUT),
                    reports.training_name("documents", "low", "high", "MAP", TRAIN_CUT, "test"))


@query
def snk_tfidf_eval_csv(spark, sf):
    e = experiment(spark, sf)
    values = ex.evaluate_tfidf(e.index, e.topics, e.qrels, TRAIN_CUT, "MAP", terms=e.terms,
                               ranked=setup.stored_run(spark, sf, "tfidf"))
    return _written(spark, reports.tfidf_eval_csv(values, "MAP", TRAIN_CUT),
                    reports.training_name("documents", None, "all", "MAP", TRAIN_CUT, "test"))


@query
def snk_test_table(spark, sf):
    tests = sg.paired_tests(keep(_pairs(spark, sf)), ["metric", "lam"], ALPHA)
    return _written(spark, reports.test_table(tests, ["metric", "lam"]), "tests.tsv")


@query
def snk_named_outputs(spark, sf):
    folder = shared_folder(spark)
    for model, lam in (("tfidf", 0.5), ("jm", 0.2)):
        _, found = _search(spark, sf, model, lam)
        reports.write_lines(found.metrics_lines(CUT), f"{folder}/{reports.metrics_name('documents', model, CUT, 'all')}")
    lines = (spark.read.option("recursiveFileLookup", True).text(folder)
             .select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("name")))
    return lines.groupBy("name").agg(F.count("*").alias("n_lines"))


# ---- projections, filters ------------------------------------------------------

@query
def prj_doc_fields(spark, sf):
    return raw_documents(spark, sf).select(
        F.col("doc_id").cast("string").alias("doc_key"), F.col("text").alias("contents"))


@query
def flt_topic_one(spark, sf):
    return tagged.select_topics(setup.topics(spark, sf), "3")


@query
def flt_topic_range(spark, sf):
    return tagged.select_topics(setup.topics(spark, sf), "11-15")


@query
def flt_topic_all(spark, sf):
    return tagged.select_topics(setup.topics(spark, sf), "all")


@query
def flt_qrels_topic(spark, sf):
    return experiment(spark, sf).qrels.where("query_id = 3")


@query
def flt_parse_or_skip(spark, sf):
    lines = raw_documents(spark, sf).select("doc_id", F.explode(F.split("text", r"[ \n]")).alias("line"))
    return (lines.select("doc_id", tx.parse_int(F.col("line")).alias("number")).where("number is not null")
            .groupBy("doc_id").agg(F.count("*").alias("n_numbers"), F.sum("number").alias("total")))


@query
def flt_any_term_match(spark, sf):
    e = experiment(spark, sf)
    return sc.any_term_match(e.index, e.terms)


@query
def flt_topics_with_hits(spark, sf):
    _, found = _search(spark, sf)
    return ev.topics_with_hits(found.metrics).select("query_id", "n_rel")


def _hits(run, *extra):
    return run.select(*extra, "query_id", "rank", "doc_id", r6("score"))


@query
def sel_model(spark, sf):
    e = experiment(spark, sf)
    ranked = sc.run_models(e.index, e.terms, CUT, ("tfidf", "jm", "bm25"), 0.5, Compat(lenient_names=True))
    return _hits(ranked, "model")


@query
def sel_metric(spark, sf):
    metrics = _search(spark, sf)[1].metrics
    names = ("P", "R", "MAP", "F1")
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), ev.metric_column(n).cast("double").alias("value")) for n in names])
    return metrics.select("query_id", F.inline(cells)).select("query_id", "metric", r6("value"))


# ---- scalar functions ----------------------------------------------------------

@query
def fn_tokenize(spark, sf):
    return setup.doc_rows(spark, sf).select("doc_id", F.posexplode(tx.tokens(F.col("contents"))).alias("pos", "token"))


@query
def fn_lower(spark, sf):
    return raw_documents(spark, sf).select("doc_id", tx.lower(F.col("text")).alias("lowered"))


@query
def fn_trim(spark, sf):
    padded = F.concat(F.lit(" \t\n"), F.col("text"), F.lit("\r\n "))
    return raw_documents(spark, sf).select("doc_id", tx.trim_controls(padded).alias("trimmed"))


@query
def fn_join_lines_space(spark, sf):
    return raw_documents(spark, sf).select("doc_id", tx.join_lines_space(F.split("text", "\n")).alias("contents"))


@query
def fn_join_lines_fused(spark, sf):
    return raw_documents(spark, sf).select("doc_id", tx.join_lines_fused(F.split("text", "\n")).alias("fused"))


@query
def fn_escape_query(spark, sf):
    grammar = F.concat(F.lit('+('), F.col("text"), F.lit(') AND -"title:x*"~2^3'))
    return reports.query_texts(setup.topics(spark, sf).withColumn("text", grammar)).select(
        "query_id", F.col("shown").alias("words"))


@query
def fn_split_pick(spark, sf):
    text = F.col("text")
    return raw_documents(spark, sf).select("doc_id", *[
        tx.split_pick(text, n).alias(name) for n, name in ((1, "first"), (3, "third"), (-1, "last"))])


@query
def fn_parse_num(spark, sf):
    return raw_documents(spark, sf).select(
        "doc_id", tx.parse_int(F.col("n_chars").cast("string")).alias("as_int"),
        tx.parse_int(F.col("source")).alias("not_int"),
        tx.parse_double(F.concat(F.col("n_chars").cast("string"), F.lit(".25"))).alias("as_double"),
        tx.parse_double(F.col("lang")).alias("not_double"))


@query
def fn_query_tf(spark, sf):
    return sc.query_terms(setup.topics(spark, sf))


@query
def fn_quantize_length(spark, sf):
    rows = ix.doc_lengths(setup.doc_rows(spark, sf))
    return rows.select("doc_id", "dl", tx.quantize_length(F.col("dl")).alias("norm_dl"))


@query
def fn_float32_sum(spark, sf):
    tenths = F.transform(tx.tokens(F.col("contents")), lambda w: (F.length(w) / F.lit(10.0)).cast("float"))
    return setup.doc_rows(spark, sf).select("doc_id", F.round(tx.float32_sum(tenths).cast("double"), 4).alias("total"))


# ---- index building ------------------------------------------------------------

@query
def ix_postings(spark, sf):
    return ix.postings(setup.doc_rows(spark, sf)).select("term", "row_id", "tf")


@query
def ix_positions(spark, sf):
    posts = store.positions_of(experiment(spark, sf).index.rows)
    return posts.select("term", "row_id", F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"))


@query
def ix_term_vectors(spark, sf):
    vectors = store.vectors_of(experiment(spark, sf).index.rows)
    return vectors.select("row_id", F.explode("vector").alias("term", "at")).select(
        "row_id", "term", F.array_join(F.col("at").cast("array<string>"), ",").alias("positions"))


@query
def ix_stored_fields(spark, sf):
    e = experiment(spark, sf)
    hits = setup.stored_run(spark, sf, "tfidf").select("query_id", "rank", "row_id")
    return store.fetch(e.index, hits, e.terms.n_topics * CUT).select("query_id", "rank", "doc_id", "contents")


@query
def ix_doc_length(spark, sf):
    return ix.doc_lengths(setup.doc_rows(spark, sf)).select("row_id", "dl")


@query
def ix_doc_freq(spark, sf):
    return ix.build_index(setup.documents(spark, sf)).term_stats.select("term", "df")


@query
def ix_coll_freq(spark, sf):
    return ix.build_index(setup.documents(spark, sf)).term_stats.select("term", "cf")


@query
def ix_coll_stats(spark, sf):
    stats = ix.build_index(setup.documents(spark, sf)).coll_stats
    return stats.select("n_docs", "n_tokens", F.round(F.col("n_tokens") / F.col("n_docs"), 6).alias("mean_dl"))


@query
def ix_copies(spark, sf):
    return ix.build_index(setup.documents(spark, sf), copies=2).term_stats.select("term", "df", "cf")


# ---- joins ---------------------------------------------------------------------

@query
def jn_terms_postings(spark, sf):
    e = experiment(spark, sf)
    return sc.matches(e.index, e.terms.terms, e.terms).select("query_id", "term", "row_id", "qtf", "tf")


@query
def jn_rare_terms_postings(spark, sf):
    """Postings of topic terms that at most three documents hold, from the layout by term."""
    return tl.rare_term_postings(setup.layout(spark, sf), experiment(spark, sf).terms, 3)


@query
def jn_hits_docs(spark, sf):
    return _search(spark, sf)[1].run.select("query_id", "rank", "row_id", "doc_id")


@query
def jn_hits_qrels(spark, sf):
    e, found = _search(spark, sf)
    return ev.judge(found.run, e.qrels).select("query_id", "rank", "doc_id", "relevant")


@query
def jn_topics_grid(spark, sf):
    e = experiment(spark, sf)
    return _hits(sc.run_grid(e.index, e.terms, TRAIN_CUT), "lam")


def _metric_values(metrics, *by):
    return metrics.unpivot([*by, "query_id"], list(ev.METRICS), "metric", "value")


def _pairs(spark, sf):
    """(metric, lam, query_id, a, b): Jelinek-Mercer under each lambda against TF-IDF."""
    e = experiment(spark, sf)
    by = ("query_id", "lam")
    jm = ev.evaluate(ev.judge(setup.stored_run(spark, sf, "grid"), e.qrels), e.qrels,
                     tune.grid_topics(e.topics), TRAIN_CUT, by)
    tfidf = _search(spark, sf, cut=TRAIN_CUT)[1].metrics
    return sg.pair_samples(_metric_values(jm, "lam"), _metric_values(tfidf), ["query_id", "metric"])


@query
def jn_pair_samples(spark, sf):
    return _pairs(spark, sf).select("metric", "lam", "query_id", r6("a"), r6("b"))


# ---- scoring, top k ------------------------------------------------------------

def _scores(rows):
    return rows.select("query_id", "row_id", r6("score"))


@query
def score_tfidf(spark, sf):
    e = experiment(spark, sf)
    return _scores(sc.score(e.index, e.terms))


@query
def score_tfidf_compat(spark, sf):
    e = experiment(spark, sf)
    return _scores(sc.expand_copies(sc.score(e.index, e.fused_terms, compat=REFERENCE), REFERENCE.copies))


@query
def score_jm(spark, sf):
    e = experiment(spark, sf)
    return _scores(sc.score(e.index, e.terms, "jm", 0.5))


@query
def count_matches(spark, sf):
    e = experiment(spark, sf)
    return sc.count_by_bitmaps(e.index, e.terms)


@query
def topk_hits(spark, sf):
    e = experiment(spark, sf)
    best = sc.best_hits(e.index, e.terms, CUT, lambda index: sc.score(index, e.terms))
    return best.select("query_id", "rank", "row_id", r6("score"))


@query
def topk_hits_by_blocks(spark, sf):
    best = tl.top_k_by_blocks(setup.layout(spark, sf), experiment(spark, sf).terms, CUT)
    return best.select("query_id", "rank", "row_id", r6("score"))


@query
def topk_jm_by_blocks(spark, sf):
    best = tl.top_k_by_blocks(setup.layout(spark, sf), experiment(spark, sf).terms, TRAIN_CUT, "jm", 0.4)
    return best.select("query_id", "rank", "row_id", r6("score"))


@query
def topk_display(spark, sf):
    return _hits(sc.display_top(_search(spark, sf)[1].run, 3, CUT))


@query
def sort_topics(spark, sf):
    return setup.topics(spark, sf).orderBy("query_id")


# ---- evaluation ----------------------------------------------------------------

def _metric(spark, sf, name, compat=Compat()):
    return _search(spark, sf, compat=compat)[1].metrics.select("query_id", r6(name))


@query
def ev_precision_at_k(spark, sf):
    return _metric(spark, sf, "p")


@query
def ev_recall_at_k(spark, sf):
    return _metric(spark, sf, "r")


@query
def ev_ap_at_k_compat(spark, sf):
    return _metric(spark, sf, "ap", REFERENCE)


@query
def ev_ap_at_k(spark, sf):
    return _metric(spark, sf, "ap")


@query
def ev_running_precision(spark, sf):
    e, found = _search(spark, sf)
    rows = ev.running_precision(ev.judge(found.run, e.qrels)).where("relevant = 1")
    return rows.select("query_id", "rank", "doc_id", r6("precision"))


def _means(df):
    return df.select(*[r6(c) for c in df.columns])


@query
def ev_mean_metrics(spark, sf):
    return _means(_search(spark, sf)[1].means())


@query
def ev_mean_metrics_compat(spark, sf):
    return _means(_search(spark, sf, compat=REFERENCE)[1].means())


@query
def ev_pooled_mean(spark, sf):
    e, found = _search(spark, sf)
    return _means(ev.pooled_mean(found.metrics, e.topics))


@query
def ev_report_with_total(spark, sf):
    rows = ev.report_with_total(_search(spark, sf)[1].metrics)
    return rows.select("query_id", "is_total", r6("p"), r6("r"), r6("ap"))


@query
def ev_tfidf_topics(spark, sf):
    e = experiment(spark, sf)
    return ex.evaluate_tfidf(e.index, e.topics, e.qrels, TRAIN_CUT, "MAP", terms=e.terms,
                             ranked=setup.stored_run(spark, sf, "tfidf")).select("query_id", r6("value"))


# ---- training ------------------------------------------------------------------

@query
def tr_grid_scores(spark, sf):
    e = experiment(spark, sf)
    return sc.score_grid(e.index, e.terms).select("query_id", "lam", "row_id", r6("score"))


@query
def tr_grid_metric(spark, sf):
    return _training(spark, sf).grid.select("query_id", "lam", r6("value"))


@query
def tr_grid_pivot(spark, sf):
    wide = tune.grid_pivot(_training(spark, sf).grid)
    return wide.select("query_id", *[r6(c) for c in wide.columns if c != "query_id"])


@query
def tr_lambda_mean(spark, sf):
    return tune.lambda_means(_training(spark, sf).grid).select("lam", r6("mean_value"))


@query
def tr_best_lambda(spark, sf):
    return _training(spark, sf).best.select("lam", r6("value"))


@query
def tr_best_lambda_compat(spark, sf):
    e = experiment(spark, sf)
    train = replace(e, terms=e.fused_terms).halves()[0]
    grid = tune.grid_metrics(e.index, train.topics, train.terms, e.qrels, TRAIN_CUT, compat=COPIES_TRAINING)
    return tune.best_lambda(grid, COPIES_TRAINING).select("lam", r6("value"))


COPIES_TRAINING = Compat(copies=2, quantize=True, fuse_lines=True, hits_over_cut=True, best_single_cell=True, dedupe_judgments=False)


@query
def tr_heldout(spark, sf):
    return _training(spark, sf).heldout.select("query_id", r6("value"))


# ---- paired tests --------------------------------------------------------------

BY = ["metric", "lam"]


@query
def st_paired_t(spark, sf):
    return sg.paired_t(_pairs(spark, sf), BY).select(*BY, "n", "df", r6("t"))


@query
def st_paired_t_pvalue(spark, sf):
    return sg.paired_t(_pairs(spark, sf), BY).select(*BY, r6("p_t"))


@query
def st_reject(spark, sf):
    rows = sg.paired_t(_pairs(spark, sf), BY)
    return rows.select(*BY, sg.reject(F.col("p_t"), ALPHA).alias("reject"))


@query
def st_abs_diff_ranks(spark, sf):
    return sg.abs_diff_ranks(keep(_pairs(spark, sf)), BY).select(*BY, "query_id", r6("avg_rank"))


@query
def st_wilcoxon(spark, sf):
    return sg.wilcoxon(_pairs(spark, sf), BY).select(*BY, "n", r6("w_plus"), r6("w"))


@query
def st_wilcoxon_pvalue(spark, sf):
    return sg.wilcoxon(_pairs(spark, sf), BY).select(*BY, r6("z"), r6("p_w"))


# ---- set operations ------------------------------------------------------------

@query
def set_relevant_retrieved(spark, sf):
    e, found = _search(spark, sf)
    return ev.relevant_retrieved(found.run, e.qrels)


@query
def set_union_topics(spark, sf):
    topics = setup.topics(spark, sf)
    later, last = [tagged.select_topics(topics, ids).withColumn("text", F.concat(F.lit(word), "text"))
                   for ids, word in (("2-10", "later "), ("3", "last "))]
    return tagged.union_topics(topics, later, last)
