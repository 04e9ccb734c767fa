"""SQL for DuckDB that gives the rows of the queries it can express."""

from __future__ import annotations

PREFERENCES = r"""
with turns as (
  select conv_id, conv_id >> 1 pair_id, conv_id & 1 side, coalesce(role, '') role, coalesce(text, '') text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) k
  from conversations where conv_id is not null),
pairs as (
  select pair_id, max(case when side = 0 then conv_id end) chosen_id, max(case when side = 1 then conv_id end) rejected_id
  from turns group by pair_id),
differing as (
  select coalesce(a.pair_id, b.pair_id) pair_id, min(coalesce(a.k, b.k)) k
  from (select * from turns where side = 0) a
  full join (select * from turns where side = 1) b on a.pair_id = b.pair_id and a.k = b.k
  where a.k is null or b.k is null or a.role <> b.role or a.text <> b.text
  group by 1),
lengths as (
  select pairs.*, coalesce(d.k - 1, (select count(*) from turns t where t.conv_id = pairs.chosen_id)) shared
  from pairs left join differing d using (pair_id)),
parts as (
  select l.pair_id, t.side, t.k, l.shared, '<|' || t.role || '|>' || chr(10) || t.text || chr(10) body,
         case when t.role = 'assistant' then '01' else '00' end mask
  from lengths l join turns t using (pair_id))
select l.pair_id, l.chosen_id, l.rejected_id, l.shared::bigint prompt_turns,
       coalesce(string_agg(body, '' order by k) filter (side = 0 and k <= l.shared), '') prompt,
       coalesce(string_agg(body, '' order by k) filter (side = 0 and k > l.shared), '') chosen,
       coalesce(string_agg(mask, '' order by k) filter (side = 0 and k > l.shared), '') chosen_mask,
       coalesce(string_agg(body, '' order by k) filter (side = 1 and k > l.shared), '') rejected,
       coalesce(string_agg(mask, '' order by k) filter (side = 1 and k > l.shared), '') rejected_mask
from lengths l join parts using (pair_id)
group by l.pair_id, l.chosen_id, l.rejected_id, l.shared
"""

_SPLIT = r"""list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

DECONTAMINATION = f"""
with item_words as (select item_id, {_SPLIT} w from benchmark where item_id is not null),
windows as (
  select distinct item_id, array_to_string(w[s : s + 9], ' ') win, least(len(w), 10) n
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) s from item_words where len(w) > 0)),
sizes as (select distinct n from windows),
doc_words as (select doc_id, {_SPLIT} w from documents),
places as (select doc_id, w, unnest(range(1, len(w) + 1)) s from doc_words where len(w) > 0),
runs as (
  select doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') win from places, sizes where s + n - 1 <= len(w)),
found as (select doc_id, s, n, item_id from runs join windows using (win, n)),
hit as (
  select doc_id, count(distinct p) n_hit
  from (select doc_id, unnest(range(s, s + n)) p from (select distinct doc_id, s, n from found)) group by doc_id),
items as (
  select doc_id, count(distinct item_id) n_items,
         string_agg(distinct item_id::varchar, ',' order by item_id::varchar) ids
  from found group by doc_id)
select d.doc_id, len(d.w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from doc_words d left join hit using (doc_id) left join items using (doc_id)
"""


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of an ASCII text: bytes one by one, their bits one by one."""
    codes = f"list_transform(string_split({text}, ''), lambda t: ascii(t)::bigint)"
    bits = "list_reduce([xor(crc, code), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda crc, code: {bits}), 4294967295)"


PREFIX_TRIE = rf"""
with turns as (
  select conv_id, role, text, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::bigint words, key,
         row_number() over (partition by conv_id order by turn nulls first, key) k
  from (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text,
               left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) key
        from conversations where conv_id is not null)),
convs as (select conv_id, {_crc32("conv_id::varchar")} % 4 h from (select distinct conv_id from turns)),
rebuilt as (
  select c.conv_id, 0 own, t.k, t.key, t.words from convs c join turns t on t.conv_id = c.conv_id - c.conv_id % 20 and t.k <= c.h
  union all
  select c.conv_id, 1, t.k, t.key, t.words from convs c join turns t on t.conv_id = c.conv_id and t.k > c.h),
paths as (
  select c.conv_id, coalesce(list(r.key order by own, k) filter (r.key is not null), []) keys,
         coalesce(list(r.words order by own, k) filter (r.key is not null), []) words
  from convs c left join rebuilt r using (conv_id) group by c.conv_id),
prefixes as (
  select conv_id, d, keys[1:d] keys, len(keys) = d ends, case when d > 0 then words[d] else 0 end words
  from (select *, unnest(range(0, len(keys) + 1)) d from paths)),
nodes as (
  select keys, d, min(conv_id) conv_id, count(*) n_convs, max(words) words,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) ends_sha256
  from prefixes group by keys, d),
children as (select keys[1:d - 1] keys, count(*) n from nodes where d > 0 group by 1),
full_nodes as (
  select n.*, coalesce(c.n, 0) n_children, (n_convs - 1) * words saved from nodes n left join children c on n.keys = c.keys),
subtrees as (
  select above, sum(saved)::bigint saved_tokens, count(*) filter (n_children = 0) n_leaves
  from (select keys[1:j] above, saved, n_children from (select *, unnest(range(0, d + 1)) j from full_nodes)) group by above)
select n.conv_id, n.d::bigint depth, p.conv_id parent_conv_id, n.n_convs, n.n_children::bigint n_children, s.n_leaves,
       s.saved_tokens, n.ends_sha256
from full_nodes n join subtrees s on s.above = n.keys left join nodes p on n.d > 0 and p.keys = n.keys[1:n.d - 1]
"""


def _leaf(n_chars: str) -> str:
    names = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(f"coalesce(strlen({name}::varchar) || ':' || {name}::varchar, '-')" for name in names) + ")"


_CHANGED = _leaf(f"(n_chars + coalesce(({_crc32('doc_id::varchar')} % 7 = 0)::int, 0))")
_TREES = """
  select {tree} tree, 0 level, (row_number() over (partition by {tree} order by {order}) - 1)::bigint pos,
         count(*) over (partition by {tree}) n, {digest} digest from {rows}
  union all
  select tree, level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' order by pos))
  from {name} where n > 1 group by tree, level, pos // 2"""

MERKLE = f"""
with recursive leaves as (
  select doc_id, lang, leaf, changed, (row_number() over (partition by lang order by doc_id nulls first, leaf) - 1)::bigint pos
  from (
    select doc_id, lang, {_leaf("n_chars")} leaf, {_CHANGED} changed
    from documents)),
own(tree, level, pos, n, digest) as ({_TREES.format(tree="lang", order="doc_id nulls first, leaf", digest="leaf", rows="leaves", name="own")}),
subroots as (select tree lang, digest from own where n = 1),
tops(tree, level, pos, n, digest) as ({_TREES.format(tree="0", order="lang nulls first", digest="digest", rows="subroots", name="tops")}),
placed as (
  select s.lang, s.digest subroot, (row_number() over (order by lang nulls first) - 1)::bigint pos from subroots s),
steps as (
  select l.doc_id, l.leaf, l.pos, l.lang, o.level height,
         case when s.digest is null then '-' when s.pos < o.pos then 'L' || s.digest else 'R' || s.digest end step
  from leaves l
  join own o on o.tree is not distinct from l.lang and o.pos = l.pos >> o.level and o.n > 1
  left join own s on s.tree is not distinct from o.tree and s.level = o.level and s.pos = xor(o.pos, 1)
  union all
  select l.doc_id, l.leaf, l.pos, l.lang, 1000 + o.level,
         case when s.digest is null then '-' when s.pos < o.pos then 'L' || s.digest else 'R' || s.digest end
  from leaves l join placed p on p.lang is not distinct from l.lang
  join tops o on o.pos = p.pos >> o.level and o.n > 1
  left join tops s on s.level = o.level and s.pos = xor(o.pos, 1)),
proofs as (select lang, pos, list(step order by height) steps from steps group by lang, pos),
folded as (
  select l.doc_id, l.leaf, p.subroot, (select digest from tops where n = 1) root,
         sha256(array_to_string(list_transform(list_filter(coalesce(steps, []), lambda s: s <> '-'), lambda s: s[2:]), '')) proof_sha256,
         list_reduce(list_concat([l.changed], coalesce(steps, [])), lambda node, s: sha256(
           case when s[1] = 'L' then s[2:] || node when s[1] = 'R' then node || s[2:] else node end)) folded_root
  from leaves l join placed p on p.lang is not distinct from l.lang
  left join proofs f on f.lang is not distinct from l.lang and f.pos = l.pos)
select *, folded_root = root verified from folded
"""
