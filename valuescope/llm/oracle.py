"""DuckDB texts of the training-data queries that SQL can state."""

from valuescope.llm.quality_rules import ALPHA, DELTA, RULES

_OP1 = """
with p as (
  select page_id, coalesce(html, '') as body, octet_length(encode(coalesce(html, ''))) as size from pages
), d as (select page_id, size, sha1(body) as digest from p),
f as (select digest, size, max(page_id) as first_id from d where size >= 1000 group by digest, size)
select d.page_id, d.size as payload_bytes, d.digest as payload_digest,
  case when f.first_id is not null and (d.page_id is null or d.page_id < f.first_id) then 'revisit' else 'response' end as record_type,
  case when f.first_id is not null and (d.page_id is null or d.page_id < f.first_id) then f.first_id end as refers_to,
  1 as n_requests
from d left join f on d.digest = f.digest and d.size = f.size
"""

_TURN = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"
_RUNS = "(length(role) + 13) || ':0,' || (length(text) + 11) || case when role = 'assistant' then ':1' else ':0' end"
_OP2 = f"""
with t as (
  select distinct conv_id as pair_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
), r as (
  select *, row_number() over (partition by pair_id order by turn nulls first, role, text) - 1 as k,
    lag(text) over (partition by pair_id order by turn nulls first, role, text) as prev from t
), l as (select pair_id, max(k) as last from r where role = 'assistant' group by pair_id),
a as (select r.pair_id, k, role, text, last from r join l on r.pair_id = l.pair_id),
b as (
  select pair_id, k, role, case when k = last then coalesce(prev, '') else text end as text, last
  from (select r.*, l.last from r join l on r.pair_id = l.pair_id) where k <= last
), n as (
  select a.pair_id, min(case when b.k is null or a.text <> b.text then a.k else a.n end) as n
  from (select *, count(*) over (partition by pair_id) as n from a) a left join b on a.pair_id = b.pair_id and a.k = b.k group by a.pair_id
), ra as (
  select a.pair_id, coalesce(string_agg({_TURN}, '' order by k) filter (where k < n), '') as prompt,
    coalesce(string_agg({_TURN}, '' order by k) filter (where k >= n), '') as chosen, coalesce(string_agg({_RUNS}, ',' order by k) filter (where k >= n), '') as chosen_mask
  from a join n on a.pair_id = n.pair_id group by a.pair_id
), rb as (
  select b.pair_id, coalesce(string_agg({_TURN}, '' order by k) filter (where k >= n), '') as rejected, coalesce(string_agg({_RUNS}, ',' order by k) filter (where k >= n), '') as rejected_mask
  from b join n on b.pair_id = n.pair_id group by b.pair_id
)
select ra.pair_id, n.n as n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask
from ra join rb on ra.pair_id = rb.pair_id join n on ra.pair_id = n.pair_id
"""

_CELLS = " union all ".join(f"select '{name}' as rule, {c} as cutoff, grp, digest, stratum, label, explore, ({measure.replace(' div ', ' // ')}) > {c} as over from one join grps using (stratum)" for name, (measure, cutoffs) in RULES.items() for c in cutoffs)
_BLANK = r"[\x20\x09-\x0D]"
_OP3 = rf"""
with t as (select row_number() over () as r, doc_id, coalesce(lang, 'und') as stratum, coalesce(text, '') as text from documents),
w as (select *, list_filter(regexp_split_to_array(text, '{_BLANK}+'), lambda x: x <> '') as words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from t),
g as (select r, unnest(range(1, len(words) - 6)) as i, words from w where len(words) >= 8),
h as (select r, i, list_slice(words, i, i + 7) as win from g),
dup as (select r, i from (select r, i, count(*) over (partition by r, win) as c from h) where c > 1),
cov as (select r, count(distinct pos) as n_repeat_words from (select r, unnest(range(i, i + 8)) as pos from dup) group by r),
m as (
  select w.r, doc_id, stratum, md5(text) as digest, len(words) as n_words, length(regexp_replace(text, '{_BLANK}', '', 'g')) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines, len(lines) as n_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words
  from w left join cov on w.r = cov.r
), lab as (select doc_id, max(quality) as label from labels where doc_id is not null and quality in (0, 1) group by doc_id),
one as (
  select stratum, digest, max(label) as label, substr(digest, 1, 1) < '8' as explore, {", ".join(f"any_value({c}) as {c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"))}
  from m join lab on m.doc_id = lab.doc_id group by stratum, digest
), sizes as (select stratum, coalesce(sum(label) filter (not explore), 0) as n from one group by stratum),
grps as (select stratum, case when n * ln(1 - {ALPHA}) <= ln({DELTA} / (select count(*) from sizes)) then 's:' || stratum else 'pool' end as grp from sizes),
tests as (select count(distinct grp) as tests from grps),
cells as ({_CELLS}),
explored as (select grp, rule, cutoff, sum(label) as k, sum(1 - label) as bad from cells where explore and over group by all having sum(1 - label) > 0),
steps as (select *, row_number() over (partition by grp order by k / bad, bad desc, rule, cutoff desc) as step from explored),
fallen as (select grp, stratum, digest, label, min(step) as step from cells join steps using (grp, rule, cutoff) where over and not explore group by all),
falls as (select grp, step, sum(label) as good from fallen group by all),
path as (
  select steps.grp, rule, cutoff, sum(coalesce(good, 0)) over (partition by steps.grp order by steps.step) as k, n
  from steps left join falls using (grp, step) join (select grp, sum(label) as n from one join grps using (stratum) where not explore group by grp) using (grp)
), tail as (
  select path.*, (select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({ALPHA}) + (n - i) * ln(1 - {ALPHA}))) from (select unnest(range(0, cast(k as bigint) + 1)) as i)) as p from path
), best as (
  select stratum, rule, min(cutoff) as cutoff from tail join grps using (grp), tests where k < n * {ALPHA} and p <= {DELTA} / tests group by stratum, rule
)
select m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and not exists (
    select 1 from best b where b.stratum = m.stratum and ({" or ".join(f"(b.rule = '{name}' and ({measure.replace(' div ', ' // ')}) > b.cutoff)" for name, (measure, _) in RULES.items())})) as kept
from m
"""

#: Unsigned crc32 of a list of bytes, bit by bit.
_CRC = "xor(list_reduce(list_prepend(4294967295::bigint, {0}), lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295)"
_LATIN_BYTES = "flatten(list_transform(string_split({0}, ''), lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [(192 + (unicode(c) >> 6))::bigint, (128 + (unicode(c) & 63))::bigint] end))"
_WORDS = r"len(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'))"

_OP11 = rf"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
), d as (select *, sha256(length(role) || ':' || role || text) as digest, {_WORDS.format('text')} as words from t),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, digest) as k from d),
c as (select conv_id, {_CRC.format(_LATIN_BYTES.format("conv_id::varchar"))} % 4 as h from (select distinct conv_id from t)),
r as (
  select c.conv_id, 0 as own, k, digest, words from c join o on o.conv_id = c.conv_id - c.conv_id % 20 and k <= h
  union all select c.conv_id, 1, k, digest, words from c join o on o.conv_id = c.conv_id and k > h
), s as (
  select conv_id, words, row_number() over w as depth, array_to_string(list(digest) over w, '') as node from r
  window w as (partition by conv_id order by own, k rows between unbounded preceding and current row)
), p as (select conv_id, depth, node, words from s union all select conv_id, 0, '', 0 from c),
e as (select *, max(depth) over (partition by conv_id) as n, lag(node) over (partition by conv_id order by depth) as above from p),
nodes as (
  select depth, node, any_value(above) as above, any_value(words) as words, min(conv_id) as conv_id, count(*) as n_convs,
    coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where n = depth), '') as ends
  from e group by depth, node
), kids as (select depth - 1 as depth, above as node, count(*) as n_children from nodes where depth > 0 group by all),
full_nodes as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (depth, node)),
below as (
  select p.depth, p.node, sum((u.n_convs - 1) * u.words)::bigint as saved_tokens, count(*) filter (where u.n_children = 0) as n_leaves
  from full_nodes u join p on p.conv_id = u.conv_id and p.depth <= u.depth group by p.depth, p.node
)
select f.conv_id, f.depth, a.conv_id as parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, sha256(f.ends) as ends_sha256
from full_nodes f join below using (depth, node) left join nodes a on a.depth = f.depth - 1 and a.node = f.above
"""

_OP13 = rf"""
with recursive r as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) as run from documents
), g as (select coalesce(doc_id::varchar, '') as doc_id, run, count(*) as n from r group by all),
h as (select run, n, {_CRC.format(_LATIN_BYTES.format("(doc_id || ':' || run)"))} as h from g),
w as (
  select case when h % 199 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word, sum(n)::bigint as n
  from h group by 1 having length(word) >= 6 and sum(n) >= 5
), gap as (select word, n, i, word[:i] || word[i + 2:] as rest from w, unnest(range(length(word))) as u(i)),
near as (
  select a.word, b.word as other, b.n as other_n from gap a join gap b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select a.word, b.word, b.n from gap a join w b on a.rest = b.word
  union select b.word, a.word, a.n from gap a join w b on a.rest = b.word
), best as (select word, count(*) as n_near, first(other order by other_n desc, other) as form, max(other_n) as form_n from near group by word),
f as (select w.word, case when form_n >= 5 * n then form end as form, n, coalesce(n_near, 0) as n_near, case when form_n >= 5 * n then form_n end as form_n from w left join best using (word)),
chain as (select word, word as root from f union all select chain.word, f.form from chain join f on chain.root = f.word where f.form is not null)
select f.word, f.form, chain.root, f.n, f.n_near, f.form_n
from f join chain on f.word = chain.word join f as last on chain.root = last.word and last.form is null
"""

ORACLE = {"op1_warc_transactions": _OP1, "op2_preference_pairs": _OP2, "op3_risk_controlled_rules": _OP3, "op11_conversation_trie": _OP11, "op13_spelling_variants": _OP13}
