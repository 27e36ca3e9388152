"""DuckDB SQL of the operators that SQL can express, over unique ids."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


_BENCH_WORDS = words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_WORDS = words(r"[^\x20\x09-\x0D]+")
_PROBE = "<|im_end|><|im_start|>assistant ok"

CHAT = rf"""
with t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, k, r, '{_PROBE}' from (values (0, 'user'), (1, 'assistant')) p(k, r)
), s as (
    select *, length('<|im_start|>') + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1 as size,
        row_number() over (partition by conv_id order by turn desc, role desc, text desc) as behind from t
), e as (select *, sum(size) over (partition by conv_id order by turn, role, text rows unbounded preceding) as upto from s)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars, sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    coalesce(sum(upto) filter (role = 'assistant' or behind = 1), 0)::bigint as formatted_chars
from e group by conv_id"""

DECONTAMINATE = f"""
with d as (select doc_id, {_BENCH_WORDS} as w from documents), i as (select item_id::varchar as item_id, {_BENCH_WORDS} as w from benchmark),
iw as (select distinct item_id, n, array_to_string(w[k : k + n - 1], ' ') as g from (select item_id, w, least(13, len(w)) as n, unnest(range(1, len(w) - least(13, len(w)) + 2)) as k from i where len(w) > 0)),
sizes as (select distinct n from iw),
dw as (select doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') as g from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k from d, sizes where len(w) >= n)),
hit as (select doc_id, k, dw.n, item_id from dw join iw on iw.g = dw.g and iw.n = dw.n),
places as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + n)) as p from hit) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items from (select distinct doc_id, item_id from hit) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join places using (doc_id) left join named using (doc_id)"""

_REACH = "reach(id, root) as (select id, id from nodes union select e.b, r.root from reach r join edges e on e.a = r.id)"

NGRAM_JOIN = f"""
with recursive w as (select doc_id, {_WORDS} as w from documents),
sets as (select distinct doc_id, array_to_string(w[k : k + least(5, len(w)) - 1], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) as k from w where len(w) > 0)),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
edges as (select x.doc_id as a, y.doc_id as b from sets x join sets y on x.g = y.g and x.doc_id <> y.doc_id join sizes s on s.doc_id = x.doc_id join sizes t on t.doc_id = y.doc_id
    group by x.doc_id, y.doc_id, s.n, t.n having 100 * count(*) >= 75 * (s.n + t.n - count(*))),
nodes as (select distinct a as id from edges), {_REACH}
select w.doc_id, coalesce(n, 0) as n_shingles, coalesce(c.root, w.doc_id) as component_id
from w left join sizes using (doc_id) left join (select id, min(root) as root from reach group by id) c on c.id = w.doc_id"""

EMBEDDINGS = f"""
with recursive v as (select vec_id, embedding::double[] as x from embeddings where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0 and len(list_filter(embedding, lambda e: e <> 0)) > 0),
edges as (select p.vec_id as a, q.vec_id as b from v p join v q on p.vec_id <> q.vec_id and len(p.x) = len(q.x) where list_cosine_similarity(p.x, q.x) >= 0.9),
nodes as (select distinct a as id from edges), {_REACH},
c as (select id, min(root) as root from reach group by id), n as (select a as id, count(*) as n from edges group by a)
select vec_id, coalesce(n.n, 0) as n_links, coalesce(c.root, vec_id) as component_id, vec_id = coalesce(c.root, vec_id) as kept from embeddings left join n on n.id = vec_id left join c on c.id = vec_id"""

ORACLE = {"op4_chat_format": CHAT, "op5_decontaminate": DECONTAMINATE, "op8_embedding_dedup": EMBEDDINGS, "op9_ngram_join": NGRAM_JOIN}
