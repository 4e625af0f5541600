"""The same results in plain SQL, for checking on the same tables.

Each oracle is a chain of common table expressions, written independently of the
Spark code: copies of documents, for example, are really stored twice here.
"""

from __future__ import annotations

CUT, TRAIN_CUT = 10, 5
# What a word is, told for DuckDB on its own: a start, what goes on with it, and joined parts of letters or of digits.
_START, _LETTERS, _DIGITS = r"[\pL\pN_][\pL\pM\pN_]*", r"[\x27.\x{2019}:\x{B7}][\pL_][\pL\pM_]*", r"[.,;\x27]\pN[\pM\pN]*"
_TOK = f"'{_START}(?:{_LETTERS}|{_DIGITS})*'"
_LAMBDAS = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]::DOUBLE[]"

# ---- building blocks: name -> (needs, body) --------------------------------------

_PARTS: dict[str, tuple[str, str]] = {
    "docs": ("", "select doc_id, text contents, doc_id row_id from documents"),
    "docs2": ("", "select doc_id, text contents, doc_id * 2 + c row_id from documents, (select unnest([0, 1]) c)"),
    "topics": ("", "select item_id query_id, trim(lower(replace(text, chr(10), ' '))) text from benchmark"),
    "fused": ("", "select item_id query_id, trim(lower(replace(text, chr(10), ''))) text from benchmark"),
}


def _part(name: str, needs: str, body: str) -> None:
    _PARTS[name] = (needs, body)


for _c, _d in (("", "docs"), ("2", "docs2")):
    _part(f"tok{_c}", _d, f"""select row_id, unnest(regexp_extract_all(lower(contents), {_TOK}, 0)) term from {_d}""")
    _part(f"post{_c}", f"tok{_c}", f"select term, row_id, count(*) tf from tok{_c} group by term, row_id")
    _part(f"len{_c}", f"post{_c}", f"select row_id, sum(tf)::BIGINT dl from post{_c} group by row_id")
    _part(f"ts{_c}", f"post{_c}", f"select term, count(*) df, sum(tf)::BIGINT cf from post{_c} group by term")
    _part(f"cs{_c}", f"{_d} post{_c}", f"select (select count(*) from {_d}) n, (select sum(tf)::BIGINT from post{_c}) t")
_part("norm2", "len2", """select row_id, case when dl < 40 then dl else 24 + (((dl - 24)
    >> (floor(log2(dl - 24))::BIGINT - 3)) << (floor(log2(dl - 24))::BIGINT - 3)) end dl from len2""")
for _f, _t in (("", "topics"), ("f", "fused")):
    _part(f"qt{_f}", _t, f"""select query_id, term, count(*) qtf from
        (select query_id, unnest(regexp_extract_all(text, {_TOK}, 0)) term from {_t}) group by query_id, term""")

_TFIDF = """select query_id, row_id, sum(qtf * (ln((n + 1) / (df + 1)) + 1) * sqrt(tf) / sqrt(dl)) score
    from {q} join {ts} using (term) join {post} using (term) join {len} using (row_id), {cs} group by query_id, row_id"""
_JM = """select query_id, lam, row_id, sum(qtf * ln(1 + (1.0::DOUBLE - lam) / lam * (tf / dl / ((cf + 1) / (t + 1))))) score
    from {q} join {ts} using (term) join {post} using (term) join {len} using (row_id), {cs},
    (select unnest({lams}) lam) group by query_id, lam, row_id"""
_ONE = dict(q="qt", ts="ts", post="post", len="len", cs="cs")
_TWO = dict(q="qtf", ts="ts2", post="post2", len="norm2", cs="cs2")
_part("sc", "qt ts post len cs", _TFIDF.format(**_ONE))
_part("sc2", "qtf ts2 post2 norm2 cs2", _TFIDF.format(**_TWO))
_part("jm", "qt ts post len cs", _JM.format(**_ONE, lams=_LAMBDAS))
_part("jm2", "qtf ts2 post2 norm2 cs2", _JM.format(**_TWO, lams=_LAMBDAS))


def _rank(scores: str, by: str, cut: int, per_doc: str = "row_id") -> str:
    return f"""select *, {per_doc} doc_id from (select *, row_number() over (partition by {by}
        order by round(score, 9) desc, row_id) rank from {scores}) where rank <= {cut}"""


_part("run", "sc", _rank("sc", "query_id", CUT))
_part("run5", "sc", _rank("sc", "query_id", TRAIN_CUT))
_part("run2", "sc2", _rank("sc2", "query_id", CUT, "row_id // 2"))
_part("grid", "jm", _rank("jm", "query_id, lam", TRAIN_CUT))
_part("grid2", "jm2", _rank("jm2", "query_id, lam", TRAIN_CUT, "row_id // 2"))
_part("qrels", "ts post cs qt", """select query_id, row_id doc_id from post join ts using (term)
    join qt using (term), cs where df <= 0.02::DOUBLE * n group by query_id, row_id having count(*) >= 2""")
_part("counts", "qrels", "select query_id, count(*) n_judged from qrels group by query_id")


def _judge(run: str) -> str:
    return f"""select {run}.*, (q.doc_id is not null)::INT relevant from {run}
        left join qrels q on q.query_id = {run}.query_id and q.doc_id = {run}.doc_id"""


def _seen(judged: str, by: str) -> str:
    return f"""select *, sum(first_seen) over (partition by {by} order by rank) / rank::DOUBLE prec from
        (select *, case when row_number() over (partition by {by}, doc_id order by rank) = 1
         then relevant else 0 end first_seen from {judged})"""


def _metrics(seen: str, keys: str, by: str, cut: int) -> str:
    return f"""select k.*, coalesce(n_rel, 0) n_rel, coalesce(hits, 0) hits, coalesce(n_rel, 0) / {cut}.0::DOUBLE p,
        coalesce(n_rel, 0) / nullif(n_judged, 0)::DOUBLE r, coalesce(coalesce(ps, 0) / nullif(n_judged, 0), 0) ap
        from ({keys}) k left join (select {by}, sum(first_seen)::BIGINT n_rel, sum(relevant)::BIGINT hits,
        sum(case when first_seen = 1 then prec end) ps from {seen} group by {by}) s using ({by})
        left join counts using (query_id)"""


_KEYS = "select query_id from topics"
_GRID_KEYS = f"select query_id, unnest({_LAMBDAS}) lam from topics"
for _name, _by in (("run", "query_id"), ("run5", "query_id"), ("run2", "query_id"),
                   ("grid", "query_id, lam"), ("grid2", "query_id, lam")):
    _cut = CUT if _name in ("run", "run2") else TRAIN_CUT
    _part(f"{_name}_j", f"{_name} qrels", _judge(_name))
    _part(f"{_name}_s", f"{_name}_j", _seen(f"{_name}_j", _by))
    _part(f"{_name}_m", f"{_name}_s counts topics",
          _metrics(f"{_name}_s", _KEYS if _by == "query_id" else _GRID_KEYS, _by, _cut))

_part("half", "topics", "select min(query_id) + max(query_id) middle from topics")
_part("train", "grid_m half", "select query_id, lam, ap from grid_m, half where 2 * query_id <= middle")
_part("means", "train", "select lam, avg(ap) mean_value from train group by lam")
_part("best", "means", "select lam, mean_value from means order by round(mean_value, 9) desc, lam limit 1")
_part("held", "grid_m half best", """select query_id, ap from grid_m, half
    where 2 * query_id > middle and lam = (select lam from best)""")
_part("pairs", "grid_m run5_m", """select metric, lam, query_id, a, b from
    (unpivot (select query_id, lam, p, r, ap from grid_m) on p, r, ap into name metric value a)
    join (unpivot (select query_id, p, r, ap from run5_m) on p, r, ap into name metric value b)
    using (query_id, metric)""")
_part("diffs", "pairs", "select *, round(b - a, 9) d from pairs")
_part("tt", "diffs", """select *, case when sd > 1e-12 then -mean_d / (sd / sqrt(n)) end t, n - 1 df from
    (select metric, lam, count(*) n, avg(d) mean_d, stddev_samp(d) sd from diffs group by metric, lam)""")
# Student's t by the closed series: running products as a window over the series index.
_part("tp", "tt", """select metric, lam, t, df, greatest(0, 1 - case when df % 2 = 0
        then sin(th) * (1 + coalesce(s, 0)) else 2 / pi() * (th + sin(th) * cos(th) * (1 + coalesce(s, 0))) end) p_t
    from (select *, atan(abs(t) / sqrt(df)) th from tt) left join
    (select metric, lam, sum(term) s from (select metric, lam, i, product(pow(cos(atan(abs(t) / sqrt(df))), 2) *
        case when df % 2 = 0 then (2 * i - 1) / (2 * i) else 2 * i / (2 * i + 1) end)
        over (partition by metric, lam order by i) term
      from tt, range(1, 20000) r(i) where t is not null and i <= (case when df % 2 = 0 then df / 2 - 1 else (df - 3) / 2 end))
     group by metric, lam) using (metric, lam)""")
_part("ranks", "diffs", """select *, rank() over (partition by metric, lam order by abs(d))
    + (count(*) over (partition by metric, lam, abs(d)) - 1) / 2 avg_rank from diffs""")
_part("wx", "ranks", """select *, greatest(w_plus, n * (n + 1) / 2 - w_plus) w from (select metric, lam,
    count(*) n, coalesce(sum(avg_rank) filter (d > 0), 0) w_plus from ranks group by metric, lam)""")
_part("wz", "wx", """select *, (n * (n + 1) / 2 - w - n * (n + 1) / 4 - 0.5) /
    sqrt(n * (n + 1) * (2 * n + 1) / 24) z from wx""")
_part("wp", "wz", """select metric, lam, z, case when abs(z) > 12 then 0 else greatest(0, 1 - 2 * exp(-z * z / 2)
    / sqrt(2 * pi()) * abs(z) * (1 + s)) end p_w from wz join (select metric, lam, sum(term) s from
    (select metric, lam, product(z * z / (2 * i + 1)) over (partition by metric, lam order by i) term
     from wz, range(1, 251) r(i)) group by metric, lam) using (metric, lam)""")


def _chain(needs: str, seen: list[str] | None = None) -> list[str]:
    seen = [] if seen is None else seen
    for name in needs.split():
        if name not in seen:
            _chain(_PARTS[name][0], seen)
            seen.append(name)
    return seen


def _sql(needs: str, body: str) -> str:
    names = _chain(needs)
    head = ",\n".join(f"{n} as ({_PARTS[n][1]})" for n in names)
    return (f"with {head}\n" if head else "") + body


def _f(value: str) -> str:
    return f"coalesce(printf('%.6f', {value}), 'NaN')"


_JOINED = "replace(text, chr(10), ' ') || ' '"
_UPPER_GRID = ", ".join(f"round(max(ap) filter (lam = {i / 10}::DOUBLE), 6) l_{str(i / 10).replace('.', '_')}" for i in range(1, 11))
_GRID_CELLS = " || ';' || ".join(_f(f"max(v) filter (lam = {i / 10}::DOUBLE)") for i in range(1, 11))
_REPORT = f"""select '{{head}}' line union all
    select concat_ws('; ', ' ' || query_id || ' ', {_f('p')}, {_f('r')}, {_f('ap')}) from run_m union all
    select concat_ws(' ; ', 'Promedios: ', {_f('avg(p)')}, {_f('avg(r)')}, {_f('avg(ap)')}) from run_m"""
_MODEL = "select '{m}' model, query_id, rank::INT rank, doc_id, round(score, 6) score from {run}"

_part("jm5", "jm", "select * from jm where lam = 0.5::DOUBLE")
_part("jmrun", "jm5", _rank("jm5", "query_id", CUT))

ORACLES: dict[str, str] = {
    # sources
    "src_tagged_collection": "select doc_id, regexp_replace(text, '\\n+$', '') body from documents",
    "src_collection_routing": f"""select 'tagged' route, doc_id, {_JOINED} contents from documents
        union all select 'files', doc_id, {_JOINED} from documents""",
    "src_doc_files": f"select source, lang, doc_id, {_JOINED} contents from documents",
    "src_doc_records": f"select doc_id, {_JOINED} contents from documents",
    "src_topics": _sql("topics", "select query_id, text from topics"),
    "src_qrels": _sql("qrels", "select query_id, doc_id from qrels"),
    "src_index": _sql("post len", "select term, row_id, tf::INT tf, dl::INT dl from post join len using (row_id)"),
    "src_samples": "select row_number() over (order by doc_id) - 1 pos, n_chars::DOUBLE as value from documents",
    # sinks
    "snk_index_create": _sql("ts cs", "select term, df, cf, n n_docs from ts, cs"),
    "snk_index_append": _sql("ts cs", "select term, df, cf, n n_docs from ts, cs"),
    "snk_index_create_or_append": _sql("docs len", "select doc_id, coalesce(dl, 0)::INT dl from docs left join len using (row_id)"),
    "snk_index_upsert": f"""with post as (select doc_id, unnest(regexp_extract_all(lower(case when doc_id in
        (select doc_id from labels) then 'revised ' else '' end || text), {_TOK}, 0)) term from documents)
        select term, count(distinct doc_id) df, count(*) cf, (select count(*) from documents) n_docs from post group by term""",
    "op_upsert_docs": """select doc_id, case when doc_id in (select doc_id from labels) then 'revised ' || text
        else text end contents from documents""",
    "snk_index_count": "select count(*) n_docs from documents",
    "snk_ranking_report": _sql("topics sc run", f"""select 'Searching for: ' ||
        array_to_string(regexp_extract_all(text, {_TOK}, 0), ' ') line from topics union all
        select coalesce(n, 0) || ' total matching documents' from topics left join
            (select query_id, count(*) n from sc group by query_id) using (query_id) union all
        select rank || '. Doc ID: ' || doc_id || ' score = ' || {_f('score')} from run union all
        select '' from topics"""),
    "snk_metrics_csv": _sql("run_m", _REPORT.format(head="Query I; P@10; R@10; AP@10")),
    "snk_grid_csv": _sql("train means", f"""select 'MAP@5' line union all select
        'query;0.1;0.2;0.3;0.4;0.5;0.6;0.7;0.8;0.9;1.0' union all
        select query_id || ';' || {_GRID_CELLS} || ';' from (select query_id, lam, ap v from train) group by query_id
        union all select 'Promedio:;' || {_GRID_CELLS} || ';' from (select lam, mean_value v from means)"""),
    "snk_heldout_csv": _sql("held best", f"""select lam || ';MAP@5' line from best union all
        select query_id || ';' || {_f('ap')} from held union all select 'Promedio:;' || {_f('avg(ap)')} from held"""),
    "snk_tfidf_eval_csv": _sql("run5_m", f"""select 'MAP@5' line union all
        select query_id || ';' || {_f('ap')} from run5_m"""),
    "snk_test_table": _sql("tp wp", f"""select concat_ws(chr(9), 'metric', 'lam', 'Result', 'P-value t-test',
        'P-value Wilcoxon signed-rank test') line union all select concat_ws(chr(9), metric, lam,
        coalesce((p_t < 0.05)::VARCHAR, 'undefined'), {_f('p_t')}, {_f('p_w')}) from tp join wp using (metric, lam)"""),
    "snk_named_outputs": """select name, count(*) + 2 n_lines from benchmark,
        (select unnest(['documents.tfidf.10.qall.csv', 'documents.jm.10.qall.csv']) as name) group by name""",
    # projections, filters
    "prj_doc_fields": "select doc_id::VARCHAR doc_key, text contents from documents",
    "flt_topic_one": _sql("topics", "select * from topics where query_id = 3"),
    "flt_topic_range": _sql("topics", "select * from topics where query_id between 11 and 15"),
    "flt_topic_all": _sql("topics", "select * from topics"),
    "flt_qrels_topic": _sql("qrels", "select query_id, doc_id from qrels where query_id = 3"),
    "flt_parse_or_skip": """select doc_id, count(*) n_numbers, sum(number)::BIGINT total from
        (select doc_id, try_cast(line as INT) number from (select doc_id,
            unnest(regexp_split_to_array(text, '[ \\n]')) line from documents)
         where regexp_full_match(line, '[+-]?[0-9]+')) where number is not null group by doc_id""",
    "flt_any_term_match": _sql("qt post", "select distinct query_id, row_id from qt join post using (term)"),
    "flt_topics_with_hits": _sql("run_m", "select query_id, n_rel from run_m where n_rel > 0"),
    "sel_model": _sql("run jmrun", " union all ".join(_MODEL.format(m=m, run=r) for m, r in (
        ("tfidf", "run"), ("jm", "jmrun"), ("bm25", "run")))),
    "sel_metric": _sql("run_m", """select query_id, 'P' metric, round(p, 6) as value from run_m union all
        select query_id, 'R', round(r, 6) from run_m union all select query_id, 'MAP', round(ap, 6) from run_m
        union all select query_id, 'F1', 0::DOUBLE from run_m"""),
    # scalar functions
    "fn_tokenize": f"""select doc_id, (generate_subscripts(w, 1) - 1)::INT pos, unnest(w) token from
        (select doc_id, regexp_extract_all(lower(text), {_TOK}, 0) w from documents)""",
    "fn_lower": "select doc_id, lower(text) lowered from documents",
    "fn_trim": "select doc_id, regexp_replace(regexp_replace(text, '^[\\x00-\\x20]+', ''), '[\\x00-\\x20]+$', '') trimmed from documents",
    "fn_join_lines_space": f"select doc_id, {_JOINED} contents from documents",
    "fn_join_lines_fused": "select doc_id, replace(text, chr(10), '') fused from documents",
    "fn_escape_query": _sql("topics", f"""select query_id, array_to_string(regexp_extract_all(
        lower('+(' || text || ') AND -"title:x*"~2^3'), {_TOK}, 0), ' ') words from topics"""),
    "fn_split_pick": """select doc_id, w[1] as first, w[3] third, w[-1] as last from
        (select doc_id, string_split(text, ' ') w from documents)""",
    "fn_parse_num": """select doc_id, n_chars::INT as_int, null::INT not_int, n_chars + 0.25::DOUBLE as_double,
        null::DOUBLE not_double from documents""",
    "fn_query_tf": _sql("qt", "select query_id, term, qtf::INT qtf from qt"),
    "fn_quantize_length": _sql("docs len", """select doc_id, coalesce(dl, 0)::INT dl, (case when coalesce(dl, 0) < 40
        then coalesce(dl, 0) else 24 + ((dl - 24) - (dl - 24) % pow(2, floor(log2(dl - 24)) - 3)::BIGINT) end)::INT norm_dl
        from docs left join len using (row_id)"""),
    "fn_float32_sum": f"""select doc_id, round(coalesce(list_reduce(list_transform(w, lambda x: (length(x) / 10.0::DOUBLE)::FLOAT),
        lambda a, b: (a + b)::FLOAT, 0::FLOAT), 0)::DOUBLE, 4) total
        from (select doc_id, regexp_extract_all(lower(text), {_TOK}, 0) w from documents)""",
    # index
    "ix_postings": _sql("post", "select term, row_id, tf::INT tf from post"),
    "ix_positions": f"""select term, doc_id row_id, string_agg(i - 1, ',' order by i) positions from
        (select doc_id, generate_subscripts(w, 1) i, unnest(w) term from
         (select doc_id, regexp_extract_all(lower(text), {_TOK}, 0) w from documents)) group by term, doc_id""",
    "ix_stored_fields": _sql("run", """select query_id, rank::INT rank, run.doc_id, text contents from run
        join documents on documents.doc_id = run.doc_id"""),
    "ix_doc_length": _sql("docs len", "select row_id, coalesce(dl, 0)::INT dl from docs left join len using (row_id)"),
    "ix_doc_freq": _sql("ts", "select term, df from ts"),
    "ix_coll_freq": _sql("ts", "select term, cf from ts"),
    "ix_coll_stats": _sql("cs", "select n n_docs, t n_tokens, round(t / n, 6) mean_dl from cs"),
    "ix_copies": _sql("ts2", "select term, df, cf from ts2"),
    # joins
    "jn_terms_postings": _sql("qt post", "select query_id, term, row_id, qtf::INT qtf, tf::INT tf from qt join post using (term)"),
    "jn_rare_terms_postings": _sql("qt post ts", """select query_id, term, row_id, qtf::INT qtf, tf::INT tf
        from qt join post using (term) join ts using (term) where df <= 3"""),
    "jn_hits_docs": _sql("run", "select query_id, rank::INT rank, row_id, doc_id from run"),
    "jn_hits_qrels": _sql("run_j", "select query_id, rank::INT rank, doc_id, relevant from run_j"),
    "jn_topics_grid": _sql("grid", "select lam, query_id, rank::INT rank, doc_id, round(score, 6) score from grid"),
    "jn_pair_samples": _sql("pairs", "select metric, lam, query_id, round(a, 6) a, round(b, 6) b from pairs"),
    # scoring
    "score_tfidf": _sql("sc", "select query_id, row_id, round(score, 6) score from sc"),
    "score_tfidf_compat": _sql("sc2", "select query_id, row_id, round(score, 6) score from sc2"),
    "score_jm": _sql("jm5", "select query_id, row_id, round(score, 6) score from jm5"),
    "count_matches": _sql("qt post", "select query_id, count(distinct row_id) n_matches from qt join post using (term) group by query_id"),
    "topk_hits": _sql("run", "select query_id, rank::INT rank, row_id, round(score, 6) score from run"),
    "topk_hits_by_blocks": _sql("run", "select query_id, rank::INT rank, row_id, round(score, 6) score from run"),
    "topk_jm_by_blocks": _sql("jm", """select query_id, rank::INT rank, row_id, round(score, 6) score from (select *, row_number() over
        (partition by query_id order by round(score, 9) desc, row_id) rank from jm where lam = 0.4) where rank <= 5"""),
    "topk_display": _sql("run", "select query_id, rank::INT rank, doc_id, round(score, 6) score from run where rank <= 3"),
    "sort_topics": _sql("topics", "select * from topics order by query_id"),
    # evaluation
    "ev_precision_at_k": _sql("run_m", "select query_id, round(p, 6) p from run_m"),
    "ev_recall_at_k": _sql("run_m", "select query_id, round(r, 6) r from run_m"),
    "ev_ap_at_k": _sql("run_m", "select query_id, round(ap, 6) ap from run_m"),
    "ev_ap_at_k_compat": _sql("run2_m", """select query_id, round((list_reduce(list_transform(range(0, hits),
        lambda i: (n_rel / 10.0::DOUBLE)::FLOAT), lambda a, b: (a + b)::FLOAT, 0::FLOAT) / n_rel::FLOAT)::FLOAT::DOUBLE, 6) ap
        from run2_m where n_rel > 0"""),
    "ev_running_precision": _sql("run_s", "select query_id, rank::INT rank, doc_id, round(prec, 6) as precision from run_s where relevant = 1"),
    "ev_mean_metrics": _sql("run_m", "select round(avg(p), 6) mean_p, round(avg(r), 6) mean_r, round(avg(ap), 6) mean_ap from run_m"),
    "ev_mean_metrics_compat": _sql("run2_m topics", """select round(sum(p) / n, 6) mean_p, round(sum(r) / n, 6) mean_r,
        round(sum(hits / 10) / n, 6) mean_ap from run2_m, (select 3 * count(*) n from topics) where n_rel > 0 group by n"""),
    "ev_pooled_mean": _sql("run_m", "select round((sum(p) + sum(r) + sum(ap)) / (3 * count(*)), 6) pooled_mean from run_m"),
    "ev_report_with_total": _sql("run_m", """select query_id, grouping(query_id)::INT is_total, round(avg(p), 6) p,
        round(avg(r), 6) r, round(avg(ap), 6) ap from run_m group by rollup (query_id)"""),
    "ev_tfidf_topics": _sql("run5_m", "select query_id, round(ap, 6) as value from run5_m"),
    # training
    "tr_grid_scores": _sql("jm", "select query_id, lam, row_id, round(score, 6) score from jm"),
    "tr_grid_metric": _sql("train", "select query_id, lam, round(ap, 6) as value from train"),
    "tr_grid_pivot": _sql("train", f"select query_id, {_UPPER_GRID} from train group by query_id"),
    "tr_lambda_mean": _sql("means", "select lam, round(mean_value, 6) mean_value from means"),
    "tr_best_lambda": _sql("best", "select lam, round(mean_value, 6) as value from best"),
    "tr_best_lambda_compat": _sql("grid2_m half", """select case when hits > 0 then lam else 0.0::DOUBLE end as lam, round(hits / 5, 6) as value from grid2_m, half
        where 2 * query_id <= middle order by hits desc, query_id, lam limit 1"""),
    "tr_heldout": _sql("held", "select query_id, round(ap, 6) as value from held"),
    # paired tests
    "st_paired_t": _sql("tt", "select metric, lam, n, df, round(t, 6) t from tt"),
    "st_paired_t_pvalue": _sql("tp", "select metric, lam, round(p_t, 6) p_t from tp"),
    "st_reject": _sql("tp", "select metric, lam, p_t < 0.05 reject from tp"),
    "st_abs_diff_ranks": _sql("ranks", "select metric, lam, query_id, round(avg_rank, 6) avg_rank from ranks where d is not null"),
    "st_wilcoxon": _sql("wx", "select metric, lam, n, round(w_plus, 6) w_plus, round(w, 6) w from wx"),
    "st_wilcoxon_pvalue": _sql("wp", "select metric, lam, round(z, 6) z, round(p_w, 6) p_w from wp"),
    # set operations
    "set_relevant_retrieved": _sql("run qrels", "select query_id, doc_id from run intersect select query_id, doc_id from qrels"),
    "set_union_topics": _sql("topics", """select query_id, case when query_id = 3 then 'last ' when query_id between 2 and 10
        then 'later ' else '' end || text as text from topics"""),
}
ORACLES["ix_term_vectors"] = ORACLES["ix_positions"]
