"""Repeated ids, merged indexes, and inputs that must not lose rows without a word."""

import math
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ranklab.operators import index as ix, scoring as sc, significance as sg
from ranklab.session import shared_folder
from ranklab.sinks import index_store as store
from ranklab.sources import judgments, records, samples, tagged

TEXTS = [(1, "lens of the eye"), (1, "lens lens protein"), (2, "the liver"), (2, "the liver"), (7, "an eye")]


def plain(texts, topic):
    """TF-IDF scores by loops: sorted (id, score)."""
    docs = [(i, Counter(t.split()), len(t.split())) for i, t in texts]
    out = []
    for i, words, size in docs:
        s = 0.0
        for w, q in Counter(topic.split()).items():
            df = sum(w in d for _, d, _ in docs)
            if words[w]:
                s += q * math.sqrt(words[w]) * (math.log((len(docs) + 1) / (df + 1)) + 1) / math.sqrt(size)
        if s:
            out.append((i, round(s, 6)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def terms(spark):
    return sc.measure_terms(spark.createDataFrame([(1, "the lens eye")], "query_id long, text string"))


def frame(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, contents string")


def found(index, terms):
    rows = sc.run(index, terms, 100).collect()
    assert len({r["row_id"] for r in rows}) == len(rows) and sorted(r["rank"] for r in rows) == list(range(1, len(rows) + 1))
    return sorted(((r["doc_id"], round(r["score"], 6)) for r in rows), key=str)


@pytest.mark.parametrize("texts", [TEXTS, [(i if i else None, t) for i, t in TEXTS] + [(None, "lens")],
                                   [(i - 5, t) for i, t in TEXTS], [((1 << 62) + i, t) for i, t in TEXTS]])
def test_ids_that_cannot_number_rows(spark, terms, texts):
    docs = frame(spark, texts)
    got = found(ix.build_index(docs), terms)
    assert got == plain(texts, "the lens eye")
    path = shared_folder(spark)
    store.create_index(docs, path)
    assert found(store.open_index(spark, path), terms) == got
    store.append_index(frame(spark, [(1, "a lens"), (1, "an eye")]), path)
    assert len(found(store.open_index(spark, path), terms)) == len(got) + 2


def test_merge_of_overlapping_ids(spark, terms):
    one, two = TEXTS[:3], [(2, "the lens"), (3, "lens and eye"), (1, "the eye")]
    both = ix.merge_index(ix.build_index(frame(spark, one)), ix.build_index(frame(spark, two)))
    assert found(both, terms) == plain(one + two, "the lens eye")
    assert found(ix.merge_index(both, ix.build_index(frame(spark, one))), terms) == plain(one + two + one, "the lens eye")


def test_upsert_replaces_and_subtracts(spark, terms):
    old = ix.build_index(frame(spark, [(1, "lens of the eye"), (2, "the liver"), (3, "the eye the eye"), (7, "an eye")]))
    new = ix.build_index(frame(spark, [(3, "a lens"), (9, "the lens")]))
    want = [(1, "lens of the eye"), (2, "the liver"), (7, "an eye"), (3, "a lens"), (9, "the lens")]
    assert found(ix.upsert_index(old, new), terms) == plain(want, "the lens eye")


@pytest.mark.parametrize("failing", ["term_stats", "coll_stats"])
def test_a_failed_write_is_never_seen(spark, terms, monkeypatch, failing):
    path = shared_folder(spark)
    store.create_index(frame(spark, TEXTS), path)
    before = found(store.open_index(spark, path), terms)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(store.ix, failing, fail)
        with pytest.raises(RuntimeError):
            store.append_index(frame(spark, [(8, "the lens"), (9, "an eye")]), path)
    assert found(store.open_index(spark, path), terms) == before
    more = [(8, "lens of a lens"), (3, "the eye")]
    store.append_index(frame(spark, more), path)
    assert found(store.open_index(spark, path), terms) == plain(TEXTS + more, "the lens eye")


def statistics(index):
    terms = sorted(map(tuple, ix.merge_term_stats(index.term_stats).collect()))
    return terms, ix.merge_coll_stats(index.coll_stats).first()


@pytest.mark.parametrize("parts", [1, 3])
def test_stored_upsert_equals_a_fresh_index(spark, terms, parts):
    """Repeated ids, an emptied text, a part that loses all its words, a null id, and an append that failed before."""
    path, fresh = shared_folder(spark), shared_folder(spark)
    store.create_index(frame(spark, TEXTS), path, buckets=2, parts=parts)
    store.append_index(frame(spark, [(0, "lens of a lens"), (3, "the eye"), (None, "the lens")]), path)
    store._nested(frame(spark, [(1, "lost"), (40, "lost")]), 100, parts, 2, "unfinished").write.insertInto(store._name(path))
    new = [(1, "an eye lens"), (0, None), (7, ""), (None, "eye"), (9, "the lens"), (9, "eyes")]
    store.write_index(frame(spark, new), path, "upsert")
    want = [(2, "the liver"), (2, "the liver"), (3, "the eye"), (None, "the lens"), (1, "an eye lens"), (0, ""), (7, ""),
            (None, "eye"), (9, "the lens"), (9, "eyes")]
    store.create_index(frame(spark, want), fresh)
    index = store.open_index(spark, path)
    assert found(index, terms) == plain(want, "the lens eye")
    assert statistics(index) == statistics(store.open_index(spark, fresh))
    assert sorted(((r["doc_id"], r["contents"] or "") for r in index.rows.collect()), key=str) == sorted(want, key=str)
    store.upsert_index(frame(spark, new[:0]), path)
    store.upsert_index(frame(spark, [(i, "") for i in (0, 1, 2, 3, 7, 9)]), path)
    assert statistics(store.open_index(spark, path)) == ([("eye", 1, 1, 1.0), ("lens", 1, 1, 0.5), ("the", 1, 1, 0.5)], (8, 3))


def test_an_upsert_moves_no_stored_row(spark, terms, monkeypatch):
    """Rows that stay are written by the task that reads their bucket, new ones move as texts; both end up in their bucket."""
    path, plans = shared_folder(spark), []
    store.create_index(frame(spark, [(i, f"lens eye w{i}") for i in range(60)]), path, buckets=4, parts=2)
    writer = type(spark.range(1).write)
    whole = writer.insertInto

    def spied(self, *args, **more):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return whole(self, *args, **more)

    monkeypatch.setattr(writer, "insertInto", spied)
    new = [(i, f"the new lens w{i}") for i in range(40, 70)] + [(None, "lens")]
    store.upsert_index(frame(spark, new), path)
    plan, = plans
    moved = [line for line in plan.split("\n") if "Exchange" in line]
    assert moved and "Bucketed: true" in plan and "SortMergeJoin" not in plan[:plan.index("Exchange")]
    lines = plan.split("\n")
    sides = [i for i, line in enumerate(lines) if "positions" in line and "FileScan" in line]
    assert len(sides) == 1 and not any("Exchange hashpartitioning" in line for line in lines[:sides[0]])
    stored = spark.table(store._name(path))
    files = stored.select("row_id", F.pmod(F.hash("row_id"), F.lit(4)).alias("bucket"), F.input_file_name().alias("f")).collect()
    assert len(files) == 71 and all(f"_{r['bucket']:05d}." in r["f"] for r in files)
    assert found(store.open_index(spark, path), terms) == plain([(i, f"lens eye w{i}") for i in range(40)] + new, "the lens eye")


def test_a_failed_upsert_is_mended_by_another(spark, terms, monkeypatch):
    path, new = shared_folder(spark), [(1, "an eye lens"), (9, "the lens")]
    store.create_index(frame(spark, TEXTS), path, parts=2)
    with monkeypatch.context() as broken:
        broken.setattr(store.ix, "coll_stats", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.upsert_index(frame(spark, new), path)
    store.upsert_index(frame(spark, new), path)
    assert found(store.open_index(spark, path), terms) == plain([t for t in TEXTS if t[0] != 1] + new, "the lens eye")


def test_stored_rows_give_positions_vectors_and_fields(spark, terms, monkeypatch):
    path = shared_folder(spark)
    store.create_index(frame(spark, [(1, "a lens a"), (2, None), (5, "lens")]), f"{path}/it's", buckets=3)
    index = store.open_index(spark, f"{path}/it's")
    assert sorted(map(tuple, store.positions_of(index.rows).collect())) == [(1, "a", [0, 2]), (1, "lens", [1]), (5, "lens", [0])]
    assert dict(map(tuple, store.vectors_of(index.rows).collect())) == {1: {"a": [0, 2], "lens": [1]}, 2: {}, 5: {"lens": [0]}}
    hits = sc.run(index, terms, 10).select("query_id", "row_id", "rank")
    few = store.fetch(index, hits, 2)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "row_id" in plan[plan.index("PushedFilters"):] and "positions" not in plan[plan.index("ReadSchema"):]
    monkeypatch.setattr(store, "NAMED_ROWS", 0)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, store.fetch(index, hits, 2).collect()))
    assert {r["contents"] for r in few.collect()} == {"a lens a", "lens"}


def write(spark, text):
    path = f"{tempfile.mkdtemp(prefix='ranklab-test-')}/lines.txt"
    with open(path, "w", newline="") as out:
        out.write(text)
    return path


def test_tagged_rejects(spark):
    path = write(spark, "before\n.I 1 \n.W \na\n.I 2\n.T\ntitle\n.W\nb\n.I 3\n.W\nc\n")
    with pytest.raises(Exception, match="no record"):
        tagged.read_tagged(spark, path).collect()
    assert [tuple(r) for r in tagged.read_tagged(spark, path, rejects="skip").orderBy("doc_id").collect()] == [(1, "a"), (3, "c")]
    assert tagged.rejected_records(spark, path).count() == 2


def test_bad_judgments_and_grades(spark):
    with pytest.raises(Exception):
        judgments.read_qrels(spark, write(spark, "1 0 5 1\nx 0 6 1\n")).collect()
    with pytest.raises(Exception):
        judgments.read_qrels(spark, write(spark, "1 0 5 1\n2 0\n")).collect()
    path = write(spark, "1 0 5 1\n1 0 6 0\n")
    assert judgments.read_qrels(spark, path).count() == 2 and judgments.read_qrels(spark, path, least_rel=1).count() == 1


def test_bad_score_lists(spark):
    with pytest.raises(Exception, match="no number"):
        samples.read_samples(spark, write(spark, "a 1.5\nb x\n")).collect()
    a, b = (samples.read_samples(spark, write(spark, t)) for t in ("a 1\nb 2\nc 3\n", "a 1\nb 2\n"))
    with pytest.raises(Exception, match="without b"):
        sg.pair_samples(a, b, ["pos"], strict=True).collect()
    assert tuple(sg.unpaired(a, b, ["pos"]).first()) == (1, 0)


def test_windows_line_ends_are_split(spark):
    path = write(spark, "".join(f"{i}\r\nbody {i}\r\n/\r\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = records.read_records(spark, path, line_end="\r\n")
        assert rows.rdd.getNumPartitions() > 5
        assert sorted(map(tuple, rows.select("doc_id", F.trim("contents")).collect())) == [(i, f"body {i}") for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("split", ["512", "4k", "1g"])
def test_records_cross_splits_with_any_line_ends(spark, tmp_path, split):
    """Windows and Unix line ends, blanks around the mark, slashes in bodies, long records, several files."""
    want = {}
    for name, mark, end in (("a", "/", "\r\n"), ("b", " / ", "\n"), ("c", "/\t", "\r")):
        told = "noise\n"
        for i in range(400):
            body = [f"{name} body {i}", "/usr/bin", "a / b", ""] + ["long line of a long record"] * (i % 97 == 0) * 120
            told += f"{i}\n" + "\n".join(body) + f"\n{mark}\nbetween\n"
            want[name, i] = "".join(f"{line} " for line in body)
        told += "9999\nlast"
        want[name, 9999] = "last "
        (tmp_path / name).write_bytes(told.replace("\n", end).encode())
    (tmp_path / "empty").write_bytes(b"")
    (tmp_path / "no_id").write_bytes(b"x\ny\n/\n/\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        if split == "4k":
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        rows = records.read_records(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {(r["path"].rsplit("/", 1)[1], r["doc_id"]): r["contents"] for r in rows} == want and len(rows) == len(want)


def test_later_topic_wins(spark):
    one, two = (spark.createDataFrame([(1, t), (n, t)], "query_id long, text string") for t, n in (("first", 2), ("second", 3)))
    assert sorted(map(tuple, tagged.union_topics(one, two).collect())) == [(1, "second"), (2, "first"), (3, "second")]


def test_null_texts_survive_writing(spark, tmp_path):
    from ranklab.sources import records, tagged

    docs = spark.createDataFrame([(1, "one\ntwo"), (2, None), (3, ""), (4, "four")], "doc_id long, text string").coalesce(1)
    tagged.tagged_lines(docs).write.text(f"{tmp_path}/t")
    assert sorted(map(tuple, tagged.read_tagged(spark, f"{tmp_path}/t").collect())) == [(1, "one\ntwo"), (2, ""), (3, ""), (4, "four")]
    records.record_lines(docs).select("value").write.text(f"{tmp_path}/r")
    assert sorted((r["doc_id"], r["contents"].strip()) for r in records.read_records(spark, f"{tmp_path}/r").collect()) == [
        (1, "one two"), (2, ""), (3, ""), (4, "four")]


def test_marks_stay_with_their_letters(spark):
    from pyspark.sql import functions as F
    from ranklab.functions import text as tx

    rows = {"Cafe\u0301 au lait": ["cafe\u0301", "au", "lait"], "हिन्दी में": ["हिन्दी", "में"], "it's 3.14, a.b": ["it's", "3.14", "a.b"], "\u0301x": ["x"]}
    df = spark.createDataFrame([(k,) for k in rows], "t string")
    assert {r["t"]: r["w"] for r in df.select("t", tx.tokens(F.col("t")).alias("w")).collect()} == rows


def test_ranks_over_ranges_and_sums_over_ranges(spark):
    import random

    from ranklab.compat import REFERENCE
    from ranklab.operators import evaluate as ev, significance as sg

    rng = random.Random(3)
    rows = [(p, i, 0.0, round(rng.choice([rng.random(), 0.5, 0.0, -0.25]), 3)) for p in ("x", "y") for i in range(3000)]
    pairs = spark.createDataFrame(rows, "pair string, query_id long, a double, b double").repartition(6)
    got = {(r["pair"], r["query_id"]): r["avg_rank"] for r in sg.abs_diff_ranks(pairs, ["pair"]).select("pair", "query_id", "avg_rank").collect()}
    for p in ("x", "y"):
        own = sorted(abs(b) for q, _, _, b in rows if q == p)
        low, high = {}, {}
        for n, v in enumerate(own, 1):
            low.setdefault(v, n)
            high[v] = n
        assert all(got[p, i] == (low[abs(b)] + high[abs(b)]) / 2 for q, i, _, b in rows if q == p)
    metrics = spark.createDataFrame([(i, rng.random(), rng.random(), rng.random()) for i in range(5000)], "query_id long, p double, r double, ap double")
    got = ev.mean_metrics(metrics, metrics.select("query_id"), REFERENCE).first()
    assert got["mean_p"] == pytest.approx(sum(r["p"] for r in metrics.collect()) / 15000, rel=1e-5)
