"""DuckDB SQL for the operators of this package that SQL can express."""

from __future__ import annotations

from prodlake.llm.licences import ENOUGH, templates

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def licence_scan() -> str:
    """Every start of every key phrase by comparing it with each stretch of the text."""
    known = templates()
    rows = ", ".join(f"({k}, '{t.label}', {_list(t.words)}, {_list(t.key)}, {t.offset}, {t.base})" for k, t in enumerate(known))
    return f"""with d as (select row_number() over () as r, doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w from documents),
    t as (select * from (values {rows}) as t(t, label, tw, key, o, base)),
    v as (select distinct unnest(tw) as word from t),
    f as (select word, count(*) as n from (select unnest(list_distinct(w)) as word from d) group by 1),
    i as (select map(list(word), list(greatest(0.01, ln(((select count(*) from d) + 1) / (coalesce(n, 0) + 0.5))))) as idf from v left join f using (word)),
    p as (select t.t, label, tw, key, o, base, list_transform(tw, lambda x: idf[x]) as weights from t, i),
    s as (select r, p.*, w, unnest(list_filter(range(len(w) - len(key) + 1), lambda k: w[k + 1 : k + len(key)] = key)) - o as s from d join p on list_has_all(w, key)),
    m as (select r, label, base, s, list_sum(list_transform(range(len(tw)), lambda j: case when s + j >= 0 and w[s + j + 1] = tw[j + 1] then weights[j + 1] else 0.0 end)) / list_sum(weights) as share from s),
    g as (select r, count(*) filter (base) as n_base, min(s) filter (base) as first_word, max(s) filter (base) as last_word, list(distinct label) filter (base) as b,
      list(distinct label) filter (base or share >= {ENOUGH}) as l, max(case when base then 1.0 when share >= {ENOUGH} then share end) as best from m group by r)
    select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(array_to_string(list_sort(b), ','), '') as base_labels,
    coalesce(array_to_string(list_sort(l), ','), '') as labels, round(least(1.0, coalesce(best, 0.0)), 6) as score from d left join g using (r)"""


TOP_K = """with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select q.vec_id as query_id, v.vec_id, cast(list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])) as bigint) as score
    from v q join v on q.vec_id <> v.vec_id and len(q.e) = len(v.e) where q.vec_id % 100 = 0)
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score from s
    qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10"""

JACCARD = f"""with recursive d as (select doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
    s as (select distinct doc_id, unnest(case when len(w) >= 3 then list_transform(range(len(w) - 2), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from d),
    n as (select doc_id, count(*) as n from s group by 1),
    l as (select a.doc_id as a, b.doc_id as b from s a join s b on a.g = b.g and a.doc_id < b.doc_id join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
      where 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n) group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 90 * (x.n + y.n - count(*))),
    e as (select a, b from l union all select b, a from l),
    r as (select a as doc_id, a as other from e union select r.doc_id, e.b from r join e on r.other = e.a)
    select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce((select min(other) from r where r.doc_id = d.doc_id), d.doc_id) as component_id from d left join n using (doc_id)"""

COLLOCATIONS = f"""with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
    w as (select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from p),
    n as (select lang, sum(len(w)) as n from w group by 1),
    g as (select lang, k, unnest(list_transform(range(len(w) - k + 1), lambda i: array_to_string(w[i + 1 : i + k], ' '))) as phrase from w, (select unnest([1, 2, 3, 4, 5]) as k) where len(w) >= k),
    f as (select lang, k, phrase, count(*) as f, string_split(phrase, ' ') as w from g group by 1, 2, 3 having count(*) >= 100),
    c as (select lang, k, phrase, f as a, w, unnest(range(1, k)) as j from f where k > 1),
    s as (select c.lang, c.k, c.phrase, a, l.f as l, r.f as r, n, cast((1000 * cast(a as hugeint) * n) // (cast(l.f as hugeint) * r.f) as bigint) as score
      from c join n using (lang) join f l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:j], ' ') join f r on r.lang = c.lang and r.phrase = array_to_string(c.w[j + 1 : c.k], ' ')
      qualify row_number() over (partition by c.lang, c.phrase order by score, j) = 1),
    x as (select distinct lang, array_to_string(w[i : i + m - 1], ' ') as phrase, f from (select *, unnest(range(1, k - m + 2)) as i from (select *, unnest(range(2, k)) as m from f where k > 2))),
    y as (select s.* from s where not exists (select 1 from x where x.lang = s.lang and x.phrase = s.phrase and 100 * x.f >= 100 * s.a))
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, cast(n as bigint) as n, score from y
    qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= 2000"""

CHATS = r"""with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
      union all select -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
    e as (select *, '(<\|turn\||<\|end\||<\|im_start\||<\|im_end\||<\|endoftext\||</?s|\[/?INST|<</?SYS>)(\\*)([>\]])' as p from t),
    z as (select conv_id, turn, role, text, role = 'assistant' as reply,
      16 + length(replace(replace(regexp_replace(role, p, '\1\\\2\3', 'g'), '\', '\\'), chr(10), '\n')) + length(regexp_replace(text, p, '\1\\\2\3', 'g')) as size from e),
    u as (select *, sum(size) over (partition by conv_id order by turn) as pre, sum(size) over (partition by conv_id) as total,
      row_number() over (partition by conv_id order by turn desc) as back from z)
    select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (reply), 0) as bigint) as loss_chars, sha256(coalesce(string_agg(text, '' order by turn) filter (reply), '')) as loss_sha256,
    cast(coalesce(sum(pre) filter (reply), 0) + coalesce(max(total) filter (back = 1 and not reply), 0) as bigint) as formatted_chars from u group by conv_id"""
