"""Small hand-made inputs with known results."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklab.compat import REFERENCE, Compat
from ranklab.functions import distributions as ds, text as tx
from ranklab.operators import evaluate as ev, index as ix, scoring as sc, significance as sg, tune
from ranklab.sinks import reports
from ranklab.sources import judgments, records, samples, tagged


@pytest.fixture(scope="module")
def lens(spark):
    docs = spark.createDataFrame([(1, "lens of the eye"), (2, "lens lens protein"), (3, "the liver")],
                                 "doc_id bigint, contents string")
    topics = spark.createDataFrame([(1, "the lens")], "query_id bigint, text string")
    return ix.build_index(docs), topics, sc.measure_terms(topics)


@pytest.mark.parametrize("model,copies,expected", [
    ("tfidf", 1, {1: 1.287682, 2: 1.051388, 3: 0.910529}),
    ("tfidf", 2, {1: 1.336472, 2: 1.091225, 3: 0.945029}),
    ("jm", 1, {1: 1.091644, 2: 0.980829, 3: 0.980829}),
    ("jm", 2, {1: 1.185772, 2: 1.033015, 3: 1.064711}),
])
def test_scores(lens, model, copies, expected):
    index, _, terms = lens
    rows = sc.run(index, terms, 10, model, 0.5, Compat(copies=copies)).collect()
    assert len(rows) == 3 * copies
    for r in rows:
        assert r.score == pytest.approx(expected[r.doc_id], abs=1e-6)


def test_ties_stand_in_document_order(lens):
    index, _, terms = lens
    rows = sc.run(index, terms, 10, "jm").orderBy("rank").collect()
    assert [r.doc_id for r in rows] == [1, 2, 3]


def test_lambda_one_scores_zero(lens):
    index, _, terms = lens
    rows = sc.run_grid(index, terms, 10).where("lam = 1.0").orderBy("rank").collect()
    assert [(r.doc_id, r.score) for r in rows] == [(1, 0.0), (2, 0.0), (3, 0.0)]


def test_unknown_model(lens):
    index, _, terms = lens
    with pytest.raises(ValueError):
        sc.score(index, terms, "bm25")


def test_tokens(spark):
    row = spark.sql("select \"Gerstmann's i.e. up x-ray 3.5 mg. 1,000\" t").select(tx.tokens(F.col("t")).alias("w")).first()
    assert row.w == ["gerstmann's", "i.e", "up", "x", "ray", "3.5", "mg", "1,000"]


def test_token_runs_of_empty_text(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "b a b")], "row_id int, contents string")
    assert {(r.term, r.row_id, r.tf, r.dl) for r in ix.postings(df).collect()} == {("a", 3, 1, 3), ("b", 3, 2, 3)}
    placed = {(r.term, tuple(r.positions)) for r in ix.postings(df, positions=True).collect()}
    assert placed == {("a", (1,)), ("b", (0, 2))}
    assert {r.row_id: r.vector for r in ix.term_vectors(df).collect()} == {1: {}, 2: {}, 3: {"a": [1], "b": [0, 2]}}


def test_length_grid(spark):
    lengths = {0: 0, 39: 39, 40: 40, 41: 40, 55: 54, 63: 60, 95: 88, 111: 104, 215: 200}
    df = spark.createDataFrame([(k,) for k in lengths], "dl bigint")
    got = {r.dl: r.q for r in df.select("dl", tx.quantize_length(F.col("dl")).alias("q")).collect()}
    assert got == lengths


def test_float32_sum(spark):
    row = spark.range(1).select((tx.float32_sum(F.array(*[F.lit(0.4)] * 8)) / F.lit(4).cast("float"))
                                .cast("float").cast("string").alias("v")).first()
    assert row.v == "0.8000001"


def write(path, text):
    path.write_text(text, newline="")
    return str(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_tagged_collection(spark, tmp_path, end):
    text = ".I 1\n.W\nfirst line of\ntext one\n.I 2\n.W\nsecond doc\n.I 4\n.W\nlast\n".replace("\n", end)
    path = write(tmp_path / "docs.ALL", text)
    rows = {r.doc_id: r.body for r in tagged.read_tagged(spark, path).collect()}
    assert rows == {1: "first line of\ntext one", 2: "second doc", 4: "last"}
    fused = {r.query_id: r.text for r in tagged.read_topics(spark, path, (1, 2), fuse_lines=True).collect()}
    assert fused == {1: "first line oftext one", 2: "second doc"}


def test_tagged_collection_in_many_splits(spark, tmp_path):
    bodies = {n: f"body {n}\nsecond line {'x' * (n % 50)}" for n in range(1, 2001)}
    path = write(tmp_path / "big.ALL", "".join(f".I {n}\n.W\n{b}\n" for n, b in bodies.items()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = tagged.read_tagged(spark, path)
        assert df.rdd.getNumPartitions() > 5
        assert {r.doc_id: r.body for r in df.collect()} == bodies
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_record_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    write(tmp_path / "deep" / "1.txt", "noise\n7\nline a\nline b\n/\nmore noise\n8\n9\n / \n10\n")
    write(tmp_path / "2.txt", "/\n+11\r\nlast\r\n/")
    rows = {(r.doc_id, r.contents) for r in records.read_records(spark, str(tmp_path)).collect()}
    assert rows == {(7, "line a line b "), (8, "9 "), (10, ""), (11, "last ")}


def test_qrels_and_samples(spark, tmp_path):
    qrels = judgments.read_qrels(spark, write(tmp_path / "rel", "1 0 13 1\n2 0 5 1\n"))
    assert {tuple(r) for r in qrels.collect()} == {(1, 13), (2, 5)}
    values = [i / 8 for i in range(3000)]
    path = write(tmp_path / "scores", "".join(f"topic {i} {v}\n" for i, v in enumerate(values)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = samples.read_samples(spark, path).orderBy("pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.pos, r.value) for r in rows] == list(enumerate(values))


@pytest.mark.parametrize("text,ids", [("3", (3, 3)), ("2-10", (2, 10)), ("all", None)])
def test_topic_selection(text, ids):
    assert tagged.parse_topic_range(text) == ids


def test_bad_topic_selection():
    with pytest.raises(ValueError):
        tagged.parse_topic_range("1-2-3")


# ---- evaluation: known arithmetic ------------------------------------------------

P10 = {1: .5, 2: .4, 3: .4, 4: .2, 5: .5, 6: .3, 7: .4, 8: .3, 9: .5, 10: .2, 11: .4, 12: .3, 13: .5, 14: .3, 15: .3,
       16: .4, 17: .3, 18: .2, 19: .4, 20: .1, 21: .3, 22: .2, 23: .5, 24: .4, 25: .4, 27: .5, 28: .3, 29: .5, 30: .3}


def test_compat_report(spark):
    """Ten hits per topic, pairs of copies; precision P10 gives the printed columns and means."""
    hits = [(q, r, d) for q in range(1, 31) for r, d in ((i + 1, i // 2) for i in range(10))]
    run = spark.createDataFrame(hits, "query_id bigint, rank int, doc_id bigint")
    rel = [(q, d) for q, p in P10.items() for d in range(round(p * 10))] + [(26, 99)]
    qrels = spark.createDataFrame(rel, "query_id bigint, doc_id bigint")
    topics = spark.range(1, 31).withColumnRenamed("id", "query_id")
    metrics = ev.evaluate(ev.judge(run, qrels), qrels, topics, 10, compat=REFERENCE)
    rows = {r.query_id: r for r in metrics.collect()}
    assert set(rows) == set(P10)
    for q, p in P10.items():
        assert rows[q].p == pytest.approx(p) and rows[q].ap == pytest.approx(2 * p, abs=1e-6)
    mean = ev.mean_metrics(metrics, topics, REFERENCE).first()
    # The printed means.
    assert [str(np.float32(x)) for x in (mean.mean_p, mean.mean_ap)] == ["0.11444445", "0.2288889"]
    assert mean.mean_ap == pytest.approx(0.228889, abs=1e-6)
    line = reports.metrics_csv(metrics.where("query_id = 2"), ev.mean_metrics(metrics, topics, REFERENCE), 10, reports.single)
    values = [r.value for r in line.orderBy("section", "query_id").collect()]
    assert values[0] == "Query I; P@10; R@10; AP@10"
    assert values[1] == " 2 ; 0.4; 1.0; 0.8000001"


def test_average_precision(spark):
    run = spark.createDataFrame([(1, r, d) for r, d in enumerate([10, 20, 30, 40], 1)], "query_id bigint, rank int, doc_id bigint")
    qrels = spark.createDataFrame([(1, 10), (1, 10), (1, 30), (1, 99)], "query_id bigint, doc_id bigint")
    topics = spark.createDataFrame([(1,), (2,)], "query_id bigint")
    pairs = ev.judgments(qrels)
    rows = {r.query_id: r for r in ev.evaluate(ev.judge(run, pairs), pairs, topics, 4).collect()}
    assert rows[1].ap == pytest.approx((1 + 2 / 3) / 3)
    assert (rows[1].p, rows[1].r) == (0.5, pytest.approx(2 / 3))
    assert (rows[2].p, rows[2].r, rows[2].ap) == (0.0, None, 0.0)


# The published training rows, a topic each, lambda 0.1 to 1.0.
GRID = {
    11: [0.8, 0.8, 0.8, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0],
    12: [0.6, 0.6, 0.6, 0.6, 0.6, 0.6, 0.6, 0.6, 0.6, 0.0],
    13: [1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0],
    14: [0.8, 0.6, 0.4, 0.4, 0.4, 0.4, 0.4, 0.4, 0.4, 0.0],
    15: [1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0],
}


def test_training_grid(spark):
    rows = [(q, lam, float(v)) for q, vs in GRID.items() for lam, v in zip(sc.LAMBDAS, vs)]
    grid = spark.createDataFrame(rows, "query_id bigint, lam double, value double")
    compat = {r.lam: r.mean_value for r in tune.lambda_means(grid, REFERENCE).collect()}
    # fixed values
    expected = [0.381818, 0.363636, 0.345455, 0.363636, 0.363636, 0.363636, 0.363636, 0.363636, 0.363636, 0.0]
    assert [compat[x] for x in sc.LAMBDAS] == pytest.approx(expected, abs=1e-6)
    assert tune.best_lambda(grid, REFERENCE).first().lam == 0.4
    best = tune.best_lambda(grid).first()
    assert (best.lam, best.value) == (0.1, pytest.approx(0.84))
    wide = tune.grid_pivot(grid).where("query_id = 14").first()
    assert wide.l_0_1 == 0.8 and wide.l_1_0 == 0.0
    means = tune.grid_pivot(tune.lambda_means(grid, REFERENCE).select(
        F.lit(0).alias("query_id"), "lam", F.col("mean_value").alias("value")))
    lines = reports.grid_csv(tune.grid_pivot(grid), means, "MAP", 5, number=reports.single)
    text = [r.value for r in lines.orderBy("section", "query_id", "line_no").collect()]
    assert text[3] == "12;0.6;0.6;0.6;0.6;0.6;0.6;0.6;0.6;0.6;0.0;"
    assert text[-1] == ("Promedio:;0.38181818;0.36363637;0.34545454;0.36363637;0.36363637;0.36363637;"
                        "0.36363637;0.36363637;0.36363637;0.0;")


# ---- paired tests ----------------------------------------------------------------

A = [.6, 1, .2, 1, .6, 1, .4, 1, .6]
B = [.8, 1, .2, 1, .6, 1, .6, 1, .6]


@pytest.fixture(scope="module")
def paired(spark):
    return spark.createDataFrame([("ab", i, float(a), float(b)) for i, (a, b) in enumerate(zip(A, B))],
                                 "pair string, query_id bigint, a double, b double")


def test_paired_tests(paired):
    row = sg.paired_tests(paired, ["pair"], 0.05).first()
    assert (row.n, row.df, row.reject) == (9, 8, False)
    assert row.t == pytest.approx(-1.511858, abs=1e-6) and row.p_t == pytest.approx(0.169020, abs=1e-6)
    assert (row.w_plus, row.w) == (17.0, 28.0)
    assert row.z == pytest.approx(-0.710819, abs=1e-6) and row.p_w == pytest.approx(0.477197, abs=1e-6)
    ranks = [r.avg_rank for r in sg.abs_diff_ranks(paired, ["pair"]).orderBy("query_id").collect()]
    assert ranks == [8.5, 4, 4, 4, 4, 4, 8.5, 4, 4]


def test_equal_runs_have_no_t(spark):
    same = spark.createDataFrame([("x", i, 0.5, 0.5) for i in range(4)], "pair string, query_id bigint, a double, b double")
    row = sg.paired_tests(same, ["pair"], 0.05).first()
    assert row.t is None and row.p_t is None and row.reject is None


def test_zero_differences_dropped(paired):
    row = sg.wilcoxon(paired, ["pair"], "drop").first()
    assert (row.n, row.w_plus, row.w) == (2, 3.0, 3.0)


def test_alpha_range(paired):
    with pytest.raises(ValueError):
        sg.paired_tests(paired, ["pair"], 0.0)


def t_tail(t, df):
    """Two-sided tail by numeric integration."""
    c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    n = 20000
    h = abs(t) / n
    f = lambda x: c * (1 + x * x / df) ** (-(df + 1) / 2)
    area = sum((4 if i % 2 else 2) * f(i * h) for i in range(1, n)) + f(0) + f(abs(t))
    return 1 - 2 * area * h / 3


@pytest.mark.parametrize("t,df", [(0.0, 5), (1.3, 1), (1.3, 2), (-2.1, 3), (0.7, 8), (2.5, 9), (3.0, 39), (1.1, 200)])
def test_t_distribution(spark, t, df):
    p = spark.range(1).select(ds.t_two_sided(F.lit(t), F.lit(df).cast("bigint")).alias("p")).first().p
    assert p == pytest.approx(t_tail(t, df), abs=1e-9)


@pytest.mark.parametrize("z", [0.0, 0.5, -1.96, 3.0, 6.0, 9.0, 15.0])
def test_normal_distribution(spark, z):
    p = spark.range(1).select(ds.normal_two_sided(F.lit(z)).alias("p")).first().p
    assert p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-12)
