"""DuckDB SQL for the operators that SQL can express, written the plain way."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP8 = """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from d
"""

_OP3 = f"""
with d as (
  select doc_id, source, len({_WORDS}) as size,
         case when coalesce(text, '') = '' then 0.1::double
              else 0.1::double + 0.9::double * length(translate(text, '0123456789#*$%&|<>', ''))::double / length(text)::double end as q,
         (('0x' || substr(md5('mix-1|' || coalesce(doc_id::varchar, '')), 1, 13))::bigint::double + 0.5::double) / 4503599627370496.0::double as u
  from documents),
e as (select doc_id, source, size, -ln(u) / q as e from d),
s as (
  select source, sum(size)::bigint as source_size,
         ([5, 2, 1])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as w
  from e group by source),
c as (
  select *, source_size * 3.0::double as cap,
         row_number() over (order by source_size * 3.0::double / w, source nulls last) as k
  from s),
l as (
  select *, (sum(source_size) over ()::double - coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0))
            / (sum(w) over () - coalesce(sum(w) over (order by k rows between unbounded preceding and 1 preceding), 0)) as level
  from c),
t as (
  select source, source_size, least(cap, w * (select level from l where level <= cap / w order by k limit 1)) as target from l),
r as (
  select source as src, source_size, target,
         case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from t),
o as (
  select e.*, r.*, coalesce(sum(size) over (partition by source order by e, doc_id, size
                                            rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from e join r on e.source is not distinct from r.src)
select doc_id, size, source_size, target,
       size * (epochs + case when target - epochs * source_size > 0
                              and before + size / 2.0::double <= target - epochs * source_size then 1 else 0 end) as taken
from o
"""

_OP4 = f"""
with d as (select doc_id, source, coalesce(text, '') as t, {_WORDS} as words from documents),
w as (select doc_id, i, words[i] as a, words[i + 1] as b, words[i + 2] as c
      from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from d)),
g as (select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from w),
r as (select doc_id, count(distinct i + k) as n_repeat_words from g, (values (0), (1), (2)) as v(k) where n > 1 group by doc_id),
l as (select doc_id, count(*) - count(distinct line) as n_dup_lines
      from (select doc_id, unnest(string_split(t, chr(10))) as line from d)
      where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by doc_id),
m as (
  select d.doc_id, source, len(words) as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from d left join l using (doc_id) left join r using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
h as (
  select source, count(*) as n,
         sum((base_failed or 100 * n_symbols > 10 * word_chars or n_dup_lines > 10)::int) as f from b group by source),
p as (select sum(n) as n, sum(f) as f, count(*) as k, sum(n * (f / n) * (f / n)) as q from h),
a as (select least(greatest(f / n, 1e-6), 1 - 1e-6) as m, greatest(q / n - (f / n) * (f / n)
             - least(greatest(f / n, 1e-6), 1 - 1e-6) * (1 - least(greatest(f / n, 1e-6), 1 - 1e-6)) * k / n, 1e-6) as v from p),
z as (select m, least(greatest(m * (1 - m) / v - 1, 1.0), 1e6) as strength from a),
x as (select source, m, n + strength as size, (f + m * strength) / (n + strength) as rate from h, z)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not (rate - 1.645 * sqrt(rate * (1 - rate) / (size + 1)) > 2.0 * m) as kept
from b join x on b.source is not distinct from x.source
"""

_OP6 = f"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w from documents),
g as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from g group by doc_id),
l as (
  select a.doc_id as a, b.doc_id as b from g a join g b on a.s = b.s and a.doc_id <> b.doc_id
  join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
  where 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)
  group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 80 * (x.n + y.n - count(*))),
r as (select doc_id as a, doc_id as b from d union select r.a, l.b from r join l on r.b = l.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id
from d left join n using (doc_id) join (select a as doc_id, min(b) as component_id from r group by a) c using (doc_id)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _h(text: str) -> str:
    """The leaf digest, with ``text`` for the text."""
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"
                                   for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_OP11 = f"""
with recursive d as (
  select doc_id, source, {_h('text')} as leaf, {_h(f"translate(text, '{_UPPER}', '{_LOWER}')")} as lowered,
         flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: list_transform(range(8), lambda k: (ascii(c) >> k::int) & 1))) as bits
  from documents),
c as (
  select *, xor(list_reduce(list_prepend(4294967295::bigint, bits::bigint[]),
                            lambda a, b: xor(a >> 1, case when xor(a, b) & 1 = 1 then 3988292384 else 0 end)), 4294967295) as crc from d),
leaves as (
  select doc_id, source, leaf, case when crc % 5 = 0 then lowered else leaf end as seen,
         row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
         row_number() over (order by source nulls first, doc_id nulls first, leaf) as rid
  from c),
low as (
  select source, 0 as level, pos, leaf as h from leaves
  union all
  select source, level + 1, pos // 16, sha256(string_agg(h, '' order by pos))
  from (select *, count(*) over (partition by source) as n from low) where n > 1 group by source, level, pos // 16),
subroots as (
  select source, max(level) as height, arg_max(h, level) as subroot, row_number() over (order by source nulls first) - 1 as place
  from low group by source),
top as (
  select 0 as level, place as pos, subroot as h from subroots
  union all
  select level + 1, pos // 16, sha256(string_agg(h, '' order by pos))
  from (select *, count(*) over () as n from top) where n > 1 group by level, pos // 16),
crown as (select max(level) as height, arg_max(h, level) as root from top),
runs as (
  select false as up, source, level, pos // 16 as run, list(h order by pos) as hs from low group by source, level, pos // 16
  union all
  select true, null, level, pos // 16, list(h order by pos) from top group by level, pos // 16),
steps as (
  select rid, false as up, l.source, unnest(range(s.height)) as level, unnest(range(s.height)) as step, pos, doc_id
  from leaves l join subroots s on l.source is not distinct from s.source
  union all
  select rid, true, null, unnest(range(k.height)), unnest(range(k.height)) + s.height, place, doc_id
  from leaves l join subroots s on l.source is not distinct from s.source, crown k),
proof as (
  select rid, step, hs, ((pos >> (4 * s.level)::int) % 16)::int as own
  from steps s join runs r on s.up = r.up and s.source is not distinct from r.source and s.level = r.level
   and (s.pos >> (4 * s.level + 4)::int) = r.run),
folded as (
  select rid, 0::bigint as step, seen as h from leaves
  union all
  select f.rid, f.step + 1, sha256(array_to_string(hs[1:own] || [f.h] || hs[own + 2:], ''))
  from folded f join proof p on f.rid = p.rid and f.step = p.step),
ends as (select rid, arg_max(h, step) as folded_root from folded group by rid),
digests as (select rid, sha256(string_agg(array_to_string(hs[1:own] || hs[own + 2:], ''), '' order by step)) as proof_sha256 from proof group by rid)
select l.doc_id, l.leaf, s.subroot, k.root, coalesce(g.proof_sha256, sha256('')) as proof_sha256, e.folded_root,
       e.folded_root = k.root as verified
from leaves l join subroots s on l.source is not distinct from s.source join ends e on l.rid = e.rid
left join digests g on l.rid = g.rid, crown k
"""

ORACLE = {"op11_merkle_manifest": _OP11, "op3_mixing": _OP3, "op4_host_rules": _OP4, "op6_ngram_join": _OP6, "op8_exact_dedup": _OP8}
