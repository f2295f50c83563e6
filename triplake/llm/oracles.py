"""SQL that gives the same rows, for the operators that SQL can express."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII string; the polynomial's bits are a fixed value."""
    byte = "list_reduce([xor(c, b)] || [0::bigint, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384::bigint * (x & 1)))"
    codes = f"[ord(ch)::bigint for ch in string_split({text}, '')]"
    return f"xor(list_reduce([4294967295::bigint] || {codes}, lambda c, b: {byte}), 4294967295::bigint)"


# Runs of the six white-space characters, and what a text is without them at its end.
_BLANKS = r"[\x20\x09-\x0D]"

CONVERSATION_REPAIR = rf"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
  from conversations),
hit as (select *, {_crc32("key")} % 20 as hit from keyed),
damaged as (
  select conv_id, turn, case when hit = 4 then 'user' else role end as role,
    case when hit = 1 then '' when hit = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from hit join (values (0), (1)) copies(copy) on copy = 0 or hit = 3
  where hit <> 0),
ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i
  from damaged),
seen as (
  select *, row_number() over (partition by conv_id, role, text order by i) as nth,
    right(regexp_replace(text, '{_BLANKS}+$', ''), 1) as last_char
  from ordered),
signed as (
  select conv_id, turn, role, text, i, left(role, 1) as initial,
    case when last_char = '' then 'b' when nth > 1 then 'd'
      when last_char not in ('.', '!', '?') then 't' else '.' end as fault
  from seen),
facts as (
  select conv_id, count(*) as n,
    coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (where fault = 'b') as blank, count(*) filter (where fault = 'd') as duplicate,
    count(*) filter (where fault = 't') as truncated
  from signed group by conv_id),
pairs as (
  select conv_id, count(*) filter (where before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from (select conv_id, initial, lag(initial) over (partition by conv_id order by i) as before from signed)
  group by conv_id),
inserts as (select * from (values (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''),
  (0, 2, 3, 'I'), (1, 2, 3, 'I'), (2, 3, 3, 'I'), (3, 2, 3, 'I'),
  (0, 3, 6, 'II'), (1, 3, 6, 'II'), (2, 2, 6, 'II'), (3, 3, 6, 'II')) t(q, p, cost, edits)),
steps as (select * from (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) t(q, given, p)),
edits as (
  select q, p, '=' || given as on_initial, 0 as cost, 'K' as edit from steps
  union all select q, p, '*' as on_initial, 3 as cost, 'R' as edit from steps where given in ('u', 'a')),
way as (
  select conv_id, 0::bigint as i, 0 as q, '000000000' as best from facts
  union all
  select w.conv_id, w.i + 1 as i, e.p as q,
    min(lpad((substr(w.best, 1, 9)::bigint + ins.cost + e.cost
        + case when e.edit <> 'D' and s.fault = 't' then 3 else 0 end)::varchar, 9, '0')
      || substr(w.best, 10) || ins.edits || e.edit) as best
  from way w
    join signed s on s.conv_id is not distinct from w.conv_id and s.i = w.i + 1
    join inserts ins on ins.q = w.q
    join (select * from edits union all select q, q as p, 'D' as on_initial, 4 as cost, 'D' as edit
          from (values (0), (1), (2), (3)) t(q)) e
      on e.q = ins.p and (e.on_initial = 'D'
        or s.fault not in ('b', 'd') and (e.on_initial = '*' or e.on_initial = '=' || s.initial))
  group by w.conv_id, w.i, e.p),
ends as (
  select w.conv_id, min(lpad((substr(w.best, 1, 9)::bigint + ins.cost)::varchar, 9, '0')
    || substr(w.best, 10) || ins.edits) as best
  from way w join facts f on f.conv_id is not distinct from w.conv_id and f.n = w.i
    join inserts ins on ins.q = w.q and ins.p in (0, 3)
  group by w.conv_id),
audits as (select conv_id, substr(best, 1, 9)::bigint as cost, substr(best, 10) as audit from ends),
spelled as (select conv_id, audit, unnest(range(1, length(audit) + 1)) as spot from audits),
placed as (
  select conv_id, spot, substr(audit, spot, 1) as edit, length(replace(audit, 'D', '')) as remain,
    length(replace(substr(audit, 1, spot), 'I', '')) as i, length(replace(substr(audit, 1, spot), 'D', '')) as o
  from spelled),
lines as (
  select p.conv_id, p.spot,
    case when p.edit = 'K' then s.role when (p.o + p.remain) % 2 = 1 then 'user' else 'assistant' end
      || ':' || case when p.edit = 'I' then '' else s.text end as line
  from placed p left join signed s on s.conv_id is not distinct from p.conv_id and s.i = p.i
  where p.edit <> 'D'),
joined as (select conv_id, string_agg(line, chr(10) order by spot) as whole from lines group by conv_id)
select c.conv_id, coalesce(f.gaps, 0)::bigint as gaps, coalesce(f.blank, 0)::bigint as blank,
  coalesce(f.duplicate, 0)::bigint as duplicate, coalesce(f.truncated, 0)::bigint as truncated,
  coalesce(p.illegal, 0)::bigint as illegal, coalesce(a.cost, 0)::bigint as cost, coalesce(a.audit, '') as audit,
  sha256(coalesce(j.whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) c
  left join facts f on f.conv_id is not distinct from c.conv_id
  left join pairs p on p.conv_id is not distinct from c.conv_id
  left join audits a on a.conv_id is not distinct from c.conv_id
  left join joined j on j.conv_id is not distinct from c.conv_id
"""

CIRCULANT_MINHASH = rf"""
with recursive worded as (
  select doc_id, list_filter(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BLANKS}+'),
    lambda w: w <> '') as words
  from documents),
windows as (
  select doc_id, unnest(case when len(words) >= 4
    then list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))
    when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as gram
  from worded),
grams as (select distinct doc_id, gram from windows),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
shared as (
  select a.doc_id as u, b.doc_id as v, count(*) as n
  from grams a join grams b on a.gram = b.gram and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
links as (
  select u, v from shared join sizes a on a.doc_id = u join sizes b on b.doc_id = v
  where 100 * shared.n >= 80 * (a.n + b.n - shared.n)),
both_ways as (select u, v from links union all select v, u from links),
reach as (
  select doc_id as u, doc_id as v from documents
  union
  select r.u, b.v from reach r join both_ways b on b.u = r.v),
least as (select u as doc_id, min(v) as component_id from reach group by u)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, l.component_id, d.doc_id = l.component_id as kept
from documents d left join sizes s on s.doc_id = d.doc_id join least l on l.doc_id = d.doc_id
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return f"sha256({' || '.join(map(_field, fields))})"


MERKLE_MANIFEST = f"""
with recursive rows as (
  select doc_id, source, {_leaf("text")} as leaf,
    {_leaf(f"(case when {_crc32('doc_id::varchar')} % 2 = 0 then replace(text, chr(10), '') else text end)")} as now
  from documents),
leaves as (
  select *, row_number() over (partition by source order by doc_id) - 1 as idx,
    count(*) over (partition by source) as n
  from rows),
nodes as (
  select source, 0 as level, idx, n, leaf as hash from leaves
  union all
  select source, level + 1 as level, idx // 3 as idx, (n + 2) // 3 as n, sha256(string_agg(hash, '' order by idx)) as hash
  from nodes where n > 1 group by source, level, idx // 3, n),
subroots as (select source, hash, level from nodes where n = 1),
tops as (
  select source, hash as subroot, level as depth, row_number() over (order by source nulls first) - 1 as idx,
    count(*) over () as n
  from subroots),
above as (
  select 0 as level, idx, n, subroot as hash from tops
  union all
  select level + 1 as level, idx // 3 as idx, (n + 2) // 3 as n, sha256(string_agg(hash, '' order by idx)) as hash
  from above where n > 1 group by level, idx // 3, n),
path as (
  select l.doc_id, l.leaf, t.subroot, 0 as level, l.idx as idx, t.idx as top_idx, l.n as n, t.n as top_n,
    t.source, t.depth, l.now as hash, '' as proof
  from leaves l join tops t on t.source is not distinct from l.source
  union all
  select p.doc_id, p.leaf, p.subroot, p.level + 1 as level,
    case when p.n > 1 then p.idx // 3 else 0 end as idx, case when p.n > 1 then p.top_idx else p.top_idx // 3 end as top_idx,
    case when p.n > 1 then (p.n + 2) // 3 else 1 end as n, case when p.n > 1 then p.top_n else (p.top_n + 2) // 3 end as top_n,
    p.source, p.depth,
    sha256(string_agg(case when x.own then p.hash else x.hash end, '' order by x.idx)) as hash,
    p.proof || coalesce(string_agg(x.hash, '' order by x.idx) filter (where not x.own), '') as proof
  from path p join lateral (
      select s.idx, s.hash, s.idx = p.idx as own from nodes s
      where p.n > 1 and s.source is not distinct from p.source and s.level = p.level and s.idx // 3 = p.idx // 3
      union all
      select a.idx, a.hash, a.idx = p.top_idx as own from above a
      where p.n = 1 and a.level = p.level - p.depth and a.idx // 3 = p.top_idx // 3) x on true
  where p.n > 1 or p.top_n > 1
  group by p.doc_id, p.leaf, p.subroot, p.level, p.idx, p.top_idx, p.n, p.top_n, p.source, p.depth, p.hash, p.proof),
root as (select hash as root from above where n = 1)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, hash as folded_root, hash = root as verified
from path cross join root where n = 1 and top_n = 1
"""

ORACLES: dict[str, str] = {
    "op11_conversation_repair": CONVERSATION_REPAIR,
    "op12_circulant_minhash": CIRCULANT_MINHASH,
    "op13_merkle_manifest": MERKLE_MANIFEST,
}
