"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# Words of both: A-Z lower-cased, then runs of what is no ASCII mark, blank or control character.
_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLES: dict[str, str] = {
    "op3_url_filters": r"""
        with parts as (select page_id, coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '') as raw,
                              coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path from pages),
             own as (select page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host from parts),
             rules(h, p, v) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                                       ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
             fitting as (select page_id, arg_max(struct_pack(rule := h || p, v := v), length(h || p)) as best from own, rules
                         where (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id)
        select page_id, host, path, best.rule as rule, coalesce(best.v, 'allow') as verdict from own left join fitting using (page_id)""",
}


def decontamination(columns: str) -> str:
    """Hit words by counting every window of the lengths that items have (10 words, or a shorter whole item).

    The longest match is the longest run of windows that stand one after another in both texts.
    """
    return f"""
        with d as (select doc_id, {_WORDS} as w from documents),
             b as (select item_id, {_WORDS} as w from benchmark),
             i as (select item_id, md5(array_to_string(w, ' ')) as body, least(10, len(w)) as k, unnest(range(1, len(w) - least(10, len(w)) + 2)) as pos, w from b where len(w) > 0),
             spots as (select distinct item_id, body, k, pos as spot, array_to_string(list_slice(w, pos, pos + k - 1), ' ') as s from i),
             windows as (select distinct item_id, k, s from spots),
             places as (select doc_id, k, unnest(range(1, len(w) - k + 2)) as pos, w from d, (select distinct k from windows) where len(w) >= k),
             texts as (select doc_id, k, pos, array_to_string(list_slice(w, pos, pos + k - 1), ' ') as s from places),
             found as (select doc_id, pos, p.k, item_id, p.s from texts p join windows x on p.s = x.s and p.k = x.k),
             pairs as (select doc_id, f.pos, f.k, f.item_id, body, spot,
                              f.pos - row_number() over (partition by doc_id, f.item_id, body, f.pos - spot order by f.pos) as run
                       from found f join spots x on f.s = x.s and f.k = x.k and f.item_id = x.item_id),
             runs as (select doc_id, item_id, min(pos) - 1 as doc_word, min(spot) - 1 as item_word, count(*) + k - 1 as n
                      from pairs group by doc_id, item_id, body, k, pos - spot, run),
             best as (select doc_id, item_id as longest_item, doc_word as longest_doc_word, item_word as longest_item_word, n as longest_words
                      from runs qualify row_number() over (partition by doc_id order by n desc, doc_word, item_id, item_word) = 1),
             hit as (select doc_id, count(distinct n) as n_hit from (select doc_id, unnest(range(pos, pos + k)) as n from found) group by doc_id),
             items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
                       from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
        select {columns} from d left join hit using (doc_id) left join items using (doc_id) left join best using (doc_id)"""


ORACLES["op6_benchmark_decontamination"] = decontamination(
    "doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, "
    "sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, "
    "longest_item, longest_doc_word, longest_item_word, longest_words")


# crc32 of a decimal number's text, byte by byte from the table of its polynomial
_CRC = """xor(list_reduce(list_transform(string_split({x}, ''), lambda s: ascii(s)::bigint),
                lambda c, b: xor(c >> 8, t.crc[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint)"""

# Every beginning of every rebuilt conversation, grouped; subtrees by joining each node with all its beginnings.
ORACLES["op12_conversation_prefix_trie"] = f"""
    with t as (select list(list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)
                           order by n) as crc from range(256) r(n)),
         own as (select conv_id, list(md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) order by turn nulls first) as turns,
                        list(strlen(coalesce(text, ''))::bigint order by turn nulls first) as sizes from conversations where conv_id is not null group by conv_id),
         picked as (select conv_id, turns, sizes, {_CRC.format(x="conv_id::varchar")} % 9 as h from own, t),
         built as (select p.conv_id, coalesce(b.turns[1:p.h], []) || p.turns[p.h + 1:] as turns, coalesce(b.sizes[1:p.h], []) || p.sizes[p.h + 1:] as sizes
                   from picked p left join own b on b.conv_id = p.conv_id - p.conv_id % 5),
         starts as (select conv_id, len(turns) as n, unnest(range(0, len(turns) + 1)) as depth, turns, sizes from built),
         named as (select conv_id, depth, n, md5(array_to_string(turns[1:depth], '/')) as key, turns[1:depth] as path, sizes[depth] as own_bytes,
                          case when depth > 0 then md5(array_to_string(turns[1:depth - 1], '/')) end as up from starts),
         nodes as (select key, any_value(up) as up, any_value(path) as path, depth, min(conv_id) as conv_id, count(*) as n_convs,
                          coalesce(any_value(own_bytes), 0) as bytes, string_agg(conv_id::varchar, ',' order by conv_id) filter (n = depth) as ends
                   from named group by key, depth),
         children as (select up as key, count(*) as n_children from nodes where up is not null group by up),
         full_nodes as (select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c using (key)),
         above as (select n_children, (n_convs - 1) * bytes as saved, unnest(range(0, depth + 1)) as e, path from full_nodes),
         sums as (select md5(array_to_string(path[1:e], '/')) as key, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved_tokens
                  from above group by 1)
    select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens::bigint as saved_tokens,
           sha256(coalesce(n.ends, '')) as ends_sha256
    from full_nodes n join sums s using (key) left join nodes p on p.key = n.up"""
