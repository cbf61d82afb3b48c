"""SQL for DuckDB over the same tables, for the queries that it can express."""

_WS = "' ' || chr(9) || chr(13) || chr(12) || chr(11)"

OP1 = f"""
with lines as (
  select doc_id, text, i - 1 as i, trim(l, {_WS}) as t
  from (select doc_id, text, unnest(string_split(text, chr(10))) as l,
               generate_subscripts(string_split(text, chr(10)), 1) as i
        from documents)
),
full_lines as (
  select doc_id, i, row_number() over (partition by doc_id order by i) - 1 as r,
         ('0x' || substr(md5(t), 1, 15))::bigint as h,
         len(string_split_regex(t, '[ \\t\\r\\f\\x0B]+')) as w
  from lines where t <> ''
),
sums as (
  select *, coalesce(sum(w) over (partition by doc_id order by r rows between unbounded preceding and 1 preceding), 0)::bigint
           as before,
         sum(w) over (partition by doc_id)::bigint as total
  from full_lines
),
framed as (
  select *, before + w as upto,
         list(h) over ahead as next_lines, max(i) over ahead as last,
         list(h) over behind as lines_before, min(i) over behind as first,
         lead(i) over line as next_i, lead(h) over line as next_h
  from sums
  window line as (partition by doc_id order by r),
         ahead as (partition by doc_id order by before range between current row and 49 following),
         behind as (partition by doc_id order by before + w range between 49 preceding and current row)
),
-- The least windows of 50 words from each line on and back from each, and a line of 50 words with the one after it.
windows as (
  select doc_id, i as lo, last as hi, next_lines as content from framed where total - before >= 50
  union all
  select doc_id, first, i, lines_before from framed where upto >= 50
  union all
  select doc_id, i, next_i, [h, next_h] from framed where w >= 50 and next_i is not null
),
firsts as (select content, min({{'doc_id': doc_id, 'lo': lo}}) as source from windows group by content having count(*) > 1),
runs as (
  select distinct w.doc_id, w.lo, w.hi from windows w join firsts f using (content)
  where w.doc_id > f.source.doc_id or (w.doc_id = f.source.doc_id and w.lo > f.source.lo)
),
gone as (select distinct l.doc_id, l.i from lines l join runs r on l.doc_id = r.doc_id and l.i between r.lo and r.hi),
rest as (
  select l.doc_id, string_agg(d.l, chr(10) order by l.i) as text
  from lines l
  join (select doc_id, unnest(string_split(text, chr(10))) as l,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents) d
    on d.doc_id = l.doc_id and d.i = l.i
  left join gone g on g.doc_id = l.doc_id and g.i = l.i
  where g.i is null group by l.doc_id
)
select d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines,
       (select count(*) from gone g where g.doc_id = d.doc_id) as n_removed,
       sha256(case when d.text is null then null else coalesce(r.text, '') end) as kept_sha256
from documents d left join rest r using (doc_id)
"""

_TREE = r"""
list_transform(string_split({text}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)),
  lambda p: list_transform(regexp_extract_all(p, '[ \t\r\f\x0B]*(?:[^ \t\r\f\x0B]+[ \t\r\f\x0B]*){{1,8}}|[ \t\r\f\x0B]+'), lambda x: md5(x))))
"""
_ROOT = """
sha256(array_to_string(list_transform({tree}, lambda s: md5(array_to_string(list_transform(s,
  lambda p: md5(array_to_string(p, ''))), ''))), ''))
"""
_PIECES = "list_transform(flatten(flatten({tree})), lambda x: substr(x, 1, 8))"
_LIKE = """
case when len(list_distinct({a})) + len(list_distinct({b})) = 0 then 1.0::double
     else 2.0::double * len(list_intersect(list_distinct({a}), list_distinct({b})))
          / (len(list_distinct({a})) + len(list_distinct({b}))) end
"""

OP6 = f"""
with texts as (
  select doc_id, coalesce(text, '') as text,
         coalesce(lead(coalesce(text, '')) over (order by doc_id), first_value(coalesce(text, '')) over (order by doc_id)) as next
  from documents
),
edited as (
  select *, left(text, length(text) - length(text) // 4) || left(next, length(text) // 4) as edited from texts
),
trees as (
  select *, {_TREE.format(text="text")} as a, {_TREE.format(text="edited")} as b, {_TREE.format(text="next")} as c from edited
),
parts as (
  select *, {_PIECES.format(tree="a")} as pa, {_PIECES.format(tree="b")} as pb, {_PIECES.format(tree="c")} as pc from trees
)
select doc_id, length(text)::bigint as n_chars, sha256(edited) as edited_sha256,
       {_ROOT.format(tree="a")} || ':' || array_to_string(pa, '') as fingerprint,
       {_ROOT.format(tree="b")} || ':' || array_to_string(pb, '') as edited_fingerprint,
       {_LIKE.format(a="pa", b="pb")} as near_edited, {_LIKE.format(a="pa", b="pc")} as near_next
from parts
"""


def _product_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every part against every entry, round by round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} as materialized (
  select r, p, part, min({{'d': d, 'e': e}}) as best
  from (select s.r, s.p, s.part, b.e,
               list_sum(list_transform(list_zip(s.part, b.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d
        from parts s join b{k} b using (p))
  group by r, p, part
)""")
        if k < rounds:
            steps.append(f"""
m{k} as (
  select p, e, i, sum(x)::bigint as total, count(*) as n
  from (select p, best.e as e, unnest(part) as x, generate_subscripts(part, 1) as i from a{k}) group by p, e, i
),
b{k + 1} as materialized (
  select b.p, b.e, coalesce(n.entry, b.entry) as entry
  from b{k} b left join (
    select p, e, list((total - ((total % n) + n) % n) // n order by i) as entry from m{k} group by p, e
  ) n using (p, e)
)""")
    return f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v,
         row_number() over (order by vec_id nulls last) as r
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
parts as materialized (
  select r, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] as part
  from kept, (select unnest(range({parts})) as p)
),
b0 as (select p, r - 1 as e, part as entry from parts where r <= {entries}),
{",".join(steps)},
codes as (
  select r, string_agg(lower(printf('%02x', best.e)), '' order by p) as code, sum(best.d)::bigint as error from a{rounds} group by r
),
labels as (select label, sum(error)::bigint as label_error from kept join codes using (r) group by label),
books as (select sha256(string_agg(array_to_string(entry, ','), ',' order by p, e)) as codebooks_sha256 from b{rounds})
select k.vec_id, c.code, c.error, l.label_error, books.codebooks_sha256
from kept k join codes c using (r) join labels l on l.label is not distinct from k.label, books
"""


OP12 = """
with usable as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scores as (
  select q.vec_id as query_id, r.vec_id, list_dot_product(q.v, r.v)::bigint as score
  from usable q join usable r on q.vec_id <> r.vec_id where q.vec_id % 50 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from scores qualify rank <= 5
"""

SQL = {
    "op1_line_dedup": OP1,
    "op6_merkle_fingerprints": OP6,
    "op11_vector_codes": _product_codes(),
    "op12_exact_top_k": OP12,
}
