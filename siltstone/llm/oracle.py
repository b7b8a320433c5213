"""DuckDB SQL for the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op13_middles"] = """
with drawn as (
    select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n,
        sha256('1:' || coalesce(doc_id::varchar, '')) as h
    from documents
), numbers as (
    select doc_id, t, n, ('0x' || substr(h, 1, 8))::bigint % (n + 1) as x, ('0x' || substr(h, 9, 8))::bigint % (n + 1) as y,
        ('0x' || substr(h, 17, 8))::bigint % 100 as plain, ('0x' || substr(h, 25, 8))::bigint % 100 as late
    from drawn
), formed as (
    select doc_id, t, n, least(x, y) as a, greatest(x, y) as b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or plain >= 90 then 'plain'
             when late < 20 then 'spm' else 'psm' end as form
    from numbers
), cut as (
    select *, substr(t, 1, a) as p, substr(t, a + 1, b - a) as m, substr(t, b + 1) as s from formed
)
select doc_id, n, form,
    case when form <> 'plain' then a end as prefix_chars,
    case when form <> 'plain' then b - a end as middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
    sha256(t) as restored_sha256
from cut
"""


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Rounds of assignment by all distances, and of means, one CTE each."""
    ctes = [
        f"""kept as materialized (
    select row_number() over (order by vec_id) as r, vec_id, label,
        list_transform(embedding, lambda x: floor({scale} * x::double)) as v
    from embeddings
    where embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
)""",
        f"""part as materialized (
    select r, p, list_slice(v, p * w + 1, (p + 1) * w) as v
    from (select r, v, len(v) // {parts} as w from kept), (select unnest(range({parts})) as p)
)""",
        f"""book0 as materialized (
    select part.p, k.e, part.v as c
    from part join (select r, row_number() over (order by vec_id) - 1 as e from kept qualify e < {entries}) k on part.r = k.r
)""",
    ]
    for i in range(rounds + 1):
        # Whole numbers below 2**53, so the doubles are exact.
        ctes.append(f"""near{i} as materialized (
    select r, part.p, any_value(v) as v, min(struct_pack(d := list_inner_product(v, v) - 2 * list_inner_product(v, c)
        + list_inner_product(c, c), e := e)) as best
    from part join book{i} b on part.p = b.p
    group by r, part.p
)""")
        if i < rounds:
            ctes.append(f"""mean{i} as materialized (
    select p, e, list(m order by j) as c
    from (
        select p, best.e as e, j, floor(sum(x) / count(*)) as m
        from (select p, best, unnest(v) as x, generate_subscripts(v, 1) as j from near{i})
        group by all
    )
    group by p, e
)""")
            ctes.append(f"""book{i + 1} as materialized (
    select b.p, b.e, coalesce(m.c, b.c) as c from book{i} b left join mean{i} m on b.p = m.p and b.e = m.e
)""")
    ctes.append(f"""coded as (
    select r, string_agg(lower(printf('%02x', best.e)), '' order by p) as code, sum(best.d)::bigint as error
    from near{rounds} group by r
)""")
    ctes.append(f"""digest as (
    select sha256(string_agg(x::bigint::varchar, ',' order by p, e, j)) as codebooks_sha256
    from (select p, e, unnest(c) as x, generate_subscripts(c, 1) as j from book{rounds})
)""")
    return "with " + ",\n".join(ctes) + """
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from coded join kept using (r), digest
"""


ORACLE["op11_codes"] = _codes_sql()

# All pairs. The graph search is approximate; on the tables of the comparison it finds every neighbour.
ORACLE["op12_neighbours"] = """
with rows as (
    select distinct vec_id, list_transform(embedding, lambda x: x::double) as v
    from embeddings
    where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored as (
    select q.vec_id as query_id, q.v as q, c.vec_id,
        list_reduce(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]), lambda s, x: s + x, 0.0::double) as score
    from rows q join rows c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
)
select query_id, (row_number() over (partition by query_id, q order by score desc, vec_id))::integer as rank, vec_id, score
from scored
qualify rank <= 20
"""

ORACLE["op3_decontaminate"] = r"""
with item_words as (
    select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where text is not null
), starts as (
    select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from item_words where len(w) > 0
), windows as (
    select distinct item_id, least(len(w), 13) as k, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') as phrase
    from starts
), doc_words as (
    select row_number() over () as r, doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
    from documents
), places as (
    select r, k, w, unnest(range(1, len(w) - k + 2)) as i
    from doc_words, (select distinct k from windows)
    where len(w) >= k
), found as (
    select r, i, p.k, item_id
    from (select r, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as phrase from places) p
    join windows using (k, phrase)
), hits as (
    select r, count(distinct place) as n_hit from (select r, unnest(range(i, i + k)) as place from found) group by r
), items as (
    select r, count(*) as n_items, string_agg(item, ',' order by item) as listed
    from (select distinct r, item_id::varchar as item from found where item_id is not null) group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc_words left join hits using (r) left join items using (r)
"""

ORACLE["op6_quality"] = r"""
with texts as (
    select row_number() over () as r, doc_id, coalesce(text, '') as t from documents
), lists as (
    select r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from texts
), shingles as (
    select r, i, array_to_string(list_slice(w, i, i + 2), ' ') as s
    from (select r, w, unnest(range(1, len(w) - 1)) as i from lists where len(w) >= 3)
), repeated as (
    select r, count(distinct place) as n
    from (select r, unnest(range(i, i + 3)) as place from shingles
        qualify count(*) over (partition by r, s) > 1)
    group by r
), judged as (
    select r, line,
        regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g') as solid,
        len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as n
    from (select r, unnest(lines) as line from lists)
), kept_lines as (
    select r, count(*) as n_lines_kept, sum(length(solid)) as chars_kept
    from judged
    where regexp_matches(line, '[.!?:;…。]["'')\]”’»]*[\x20\x09-\x0D]*$')
        and length(regexp_replace(solid, '[^#*$%&|<>]+', '', 'g')) * 100 <= length(solid) * 10
        and not (n <= 12 and length(line) - length(regexp_replace(line, '[|>»·•/]', '', 'g')) >= 3)
        and not regexp_matches(line, '(?i)(all rights reserved|copyright|licensed under|public license|terms of (use|service)|privacy policy|accept cookies|use of cookies|enable javascript|lorem ipsum|click here|sign up for|subscribe to)')
    group by r
), counted as (
    select l.r, doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(repeated.n, 0)::bigint as n_repeat_words,
        len(lines)::bigint as n_lines, coalesce(n_lines_kept, 0)::bigint as n_lines_kept, coalesce(chars_kept, 0)::bigint as chars_kept
    from lists l left join repeated using (r) left join kept_lines using (r)
)
select * exclude (r), n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and chars_kept * 100 >= word_chars * 50 as kept
from counted
"""

ORACLE["op9_chats"] = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, n, who, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) v(n, who)
), numbered as (
    select *, lag(role, 1, '') over w as before, lead(role) over w as next, row_number() over w as n
    from turns window w as (partition by conv_id order by turn nulls first, role, text)
), each as (
    select *, role || chr(10) || text || chr(10) as said, case when role = 'assistant' then text else '' end as learned,
        case before when '' then n = 1 and role in ('system', 'user') when 'system' then role = 'user'
            when 'user' then role = 'assistant' when 'assistant' then role in ('user', 'tool')
            when 'tool' then role = 'assistant' else false end as fits,
        length('<turn>' || '<says>' || '</turn>' || chr(10)) + length(replace(replace(role, '\', '\\'), '<', '\l'))
            + length(replace(replace(text, '\', '\\'), '<', '\l')) as written
    from numbered
)
select conv_id, count(*) as n_turns, sha256(string_agg(said, '' order by n)) as turns_sha256,
    sum(length(learned))::bigint as loss_chars, sha256(string_agg(learned, '' order by n)) as loss_sha256,
    sum(written)::bigint as formatted_chars, bool_and(fits) and bool_or(next is null and role = 'assistant') as valid
from each group by conv_id
"""
