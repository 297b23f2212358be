"""The same results in DuckDB SQL, for the queries that SQL can express."""

PERSPECTIVES = r"""
with turns as (
  select conv_id, turn, coalesce(role, 'unknown') as who, replace(coalesce(text, ''), '<|im_', '< |im_') as said from conversations
), ranked as (
  select *, row_number() over (partition by conv_id order by turn nulls first, who, md5(said)) - 1 as rank from turns
), views as (
  select distinct conv_id, who as speaker from turns where who <> 'system'
), lines as (
  select v.conv_id, v.speaker, t.rank, t.rank // 64 as part, t.who = v.speaker as own,
         '<|im_start|>' || case when t.who = v.speaker then 'assistant' when t.who = 'system' then 'system'
                                else 'user name=' || t.who end || chr(10) as head,
         t.said || '<|im_end|>' as body
  from views v join ranked t on t.conv_id is not distinct from v.conv_id
), placed as (
  select *, coalesce(sum(length(head) + length(body) + 1) over (
              partition by conv_id, speaker order by rank rows between unbounded preceding and 1 preceding), 0) as place
  from lines
), begun as (
  select *, min(place) over (partition by conv_id, speaker, part) as first from placed
)
select conv_id, part, speaker, min(first)::bigint as "offset", count(*)::bigint as n_turns, sum(own::int)::bigint as n_own,
       string_agg(head || body || chr(10), '' order by rank) as rendered,
       string_agg((place - first + length(head))::bigint || '-' || (place - first + length(head) + length(body))::bigint, ',' order by rank) filter (own) as mask
from begun group by conv_id, part, speaker
"""

DECONTAMINATE = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), windows as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') as win
  from (select *, unnest(range(1, len(w) - least(len(w), 10) + 2)) as k from item_words where len(w) > 0)
), places as (
  select doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k from words, (select distinct n from windows) where len(w) >= n)
), hits as (
  select doc_id, k, n, item_id from places join windows using (n, win)
), counted as (
  select doc_id, count(distinct word)::bigint as n_hit
  from (select doc_id, unnest(range(k, k + n)) as word from (select distinct doc_id, k, n from hits)) group by 1
), found as (
  select doc_id, count(*)::bigint as n_items, string_agg(item_id, ',' order by item_id) as items
  from (select distinct doc_id, item_id::varchar as item_id from hits) group by 1
)
select w.doc_id, len(w.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words w left join counted using (doc_id) left join found using (doc_id)
"""

QUALITY = r"""
with base as (
  select doc_id, coalesce(text, '') as text, coalesce('=' || lang, '') as lang, coalesce('=' || source, '') as source,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x : regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
), triples as (
  select doc_id, k, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] as t
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as k from base where len(w) >= 3)
), twice as (
  select doc_id, k from (select *, count(*) over (partition by doc_id, t) as n from triples) where n > 1
), repeated as (
  select doc_id, count(distinct word) as n from (select doc_id, unnest(range(k, k + 3)) as word from twice) group by 1
), counted as (
  select b.doc_id, lang, source, len(w)::bigint as n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words,
         len(lines)::bigint as n_lines
  from base b left join repeated r using (doc_id)
), rates as (
  select *, 1000 * n_symbols // greatest(n_words, 1) as symbols, 1000 * n_dup_lines // greatest(n_lines, 1) as dup_lines,
         1000 * n_repeat_words // greatest(n_words, 1) as repeats, 100 * word_chars // greatest(n_words, 1) as word_length
  from counted
), long as (
  unpivot (select lang, source, symbols, dup_lines, repeats, word_length from rates where n_words >= 50 and 100 * n_repeat_words <= 50 * n_words)
  on symbols, dup_lines, repeats, word_length into name metric value value
), cut as (
  select lang, source, metric, value >> greatest(length(bin(value)) - 7, 0) << greatest(length(bin(value)) - 7, 0) as value from long
), own as (select lang, source, metric, value, count(*) as n from cut group by all),
levels as (
  select 1 as level, lang, source, metric, value, n from own
  union all select 2, lang, null, metric, value, sum(n) from own group by all
  union all select 3, null, null, metric, value, sum(n) from own group by all
), run as (
  select *, sum(n) over (partition by level, lang, source, metric order by value) as upto, sum(n) over (partition by level, lang, source, metric) as rows from levels
), q as (
  select level, lang, source, metric, any_value(rows) as rows, min(value) filter (100 * upto >= 25 * rows) as q25, min(value) filter (100 * upto >= 50 * rows) as q50,
         min(value) filter (100 * upto >= 75 * rows) as q75, min(value) filter (100 * upto >= 90 * rows) as q90
  from run group by level, lang, source, metric
), f as (
  select level, lang, source, metric, rows, q90 + 10 * (q90 - q50) as share, q75 + 6 * greatest(q75 - q25, q75 // 64) as high, q25 - 6 * greatest(q75 - q25, q75 // 64) as low from q
), chosen as (
  select a.lang, a.source, a.metric,
         least(case when a.rows >= 200 then a.share end, case when b.rows >= 200 then b.share end, c.share) as share,
         coalesce(greatest(case when a.rows >= 200 then a.high end, case when b.rows >= 200 then b.high end), c.high) as high,
         coalesce(least(case when a.rows >= 200 then a.low end, case when b.rows >= 200 then b.low end), c.low) as low
  from f a join f b on b.level = 2 and b.lang = a.lang and b.metric = a.metric join f c on c.level = 3 and c.metric = a.metric where a.level = 1
), fences as (
  select lang, source, max(share) filter (metric = 'symbols') as s, max(share) filter (metric = 'dup_lines') as d, max(share) filter (metric = 'repeats') as r,
         max(high) filter (metric = 'word_length') as l, min(low) filter (metric = 'word_length') as m
  from chosen group by all
), beyond as (
  select *, (s * n_words::double) as es, (d * n_lines::double) as ed, (r * n_words::double) as er,
         1000 * n_symbols::double - es as bs, 1000 * n_dup_lines::double - ed as bd, 1000 * n_repeat_words::double - er as br
  from rates left join fences using (lang, source)
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         coalesce(bs > 0 and bs * bs > 9000.0 * (es + 1000) or bd > 0 and bd * bd > 9000.0 * (ed + 1000) or br > 0 and br * br > 9000.0 * (er + 1000)
                  or word_length > l or word_length < m, false) as outside
  from beyond
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not outside as kept
from judged
"""

COLLOCATIONS = r"""
with pieces as (
  select doc_id, row_number() over () as row, coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), words as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), places as (
  select lang, w, unnest(range(1, len(w) + 1)) as i from words
), phrases as (
  select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase
  from places, (values (1), (2), (3)) as lengths(k) where i + k - 1 <= len(w)
), f as (
  select lang, k, phrase, string_split(phrase, ' ') as ws, count(*)::hugeint as n from phrases group by lang, k, phrase having count(*) >= 10
), cuts as (
  select c.lang, c.k, c.phrase, c.ws, c.n as a, x.k as cut, x.n as l, y.n as r, (1000000::hugeint * c.n * c.n) // (x.n * y.n) as score
  from f c join f x on x.lang = c.lang and x.k < c.k and x.phrase = array_to_string(c.ws[1 : x.k], ' ')
           join f y on y.lang = c.lang and y.k = c.k - x.k and y.phrase = array_to_string(c.ws[x.k + 1 : c.k], ' ')
  where c.k >= 2
), lowest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), longest as (
  select lang, phrase, max(n) as n from (
    select lang, array_to_string(ws[1:2], ' ') as phrase, n from f where k = 3
    union all
    select lang, array_to_string(ws[2:3], ' '), n from f where k = 3
  ) group by lang, phrase
), ranked as (
  select lowest.*, row_number() over (partition by lowest.lang order by score desc, a desc, lowest.phrase) as rank
  from lowest left join longest on longest.lang = lowest.lang and longest.phrase = lowest.phrase
  where longest.n is null or 100 * longest.n < 50 * a
), totals as (
  select lang, sum(len(w))::bigint as n from words group by lang
)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, totals.n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""

PREFIX_TRIE = r"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
  from conversations where conv_id is not null
), convs as (
  select conv_id, conv_id - conv_id % 20 as base,
         xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda x: ord(x)::bigint)),
             lambda c, b: list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 4 as h
  from turns group by conv_id
), rebuilt as (
  select c.conv_id, 0 as own, t.place, t.role, t.text from convs c join turns t on t.conv_id = c.base and t.place <= c.h
  union all
  select c.conv_id, 1, t.place, t.role, t.text from convs c join turns t on t.conv_id = c.conv_id and t.place > c.h
), paths as (
  select c.conv_id, coalesce(list({'role': role, 'text': text} order by own, place) filter (role is not null), []) as path
  from convs c left join rebuilt using (conv_id) group by c.conv_id
), members as (
  select conv_id, d as depth, path[1:d] as node, path[1:d - 1] as parent, len(path) = d as ends
  from (select *, unnest(range(0, len(path) + 1)) as d from paths)
), nodes as (
  select node, depth, any_value(case when depth > 0 then parent end) as parent, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256,
         (count(*) - 1) * case when depth > 0 then len(regexp_extract_all(node[depth].text, '[^\x20\x09-\x0D]+')) else 0 end as saved
  from members group by node, depth
), kids as (
  select parent as node, count(*) as n from nodes where depth > 0 group by parent
), below as (
  select x.node, x.depth, sum(y.saved)::bigint as saved_tokens, count(*) filter (kids.n is null) as n_leaves
  from nodes x join nodes y on y.depth >= x.depth and y.node[1:x.depth] = x.node left join kids on kids.node = y.node
  group by x.node, x.depth
)
select nodes.conv_id, nodes.depth, p.conv_id as parent_conv_id, nodes.n_convs, coalesce(kids.n, 0) as n_children,
       below.n_leaves, below.saved_tokens, nodes.ends_sha256
from nodes left join nodes p on p.node = nodes.parent and p.depth = nodes.depth - 1
     left join kids on kids.node = nodes.node join below on below.node = nodes.node and below.depth = nodes.depth
"""

ORACLES: dict[str, str] = {
    "op2_perspectives": PERSPECTIVES,
    "op3_decontaminate": DECONTAMINATE,
    "op4_quality_rules": QUALITY,
    "op12_collocations": COLLOCATIONS,
    "op13_prefix_trie": PREFIX_TRIE,
}
