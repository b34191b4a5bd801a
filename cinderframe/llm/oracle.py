"""DuckDB SQL for the training-data queries that SQL can express."""

ORACLE = {
    "op8_minhash_near_dedup": r"""
with recursive words as (
  select doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                  'abcdefghijklmnopqrstuvwxyz'),
                                        '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select doc_id,
         case when len(w) = 0 then []
              when len(w) < 5 then [array_to_string(w, ' ')]
              else list_distinct(list_transform(range(1, len(w) - 3),
                                                lambda i: array_to_string(w[i:i + 4], ' '))) end as s
  from words),
shingles as (select doc_id, unnest(s) as shingle, len(s) as n from sets),
links as (
  select a.doc_id as src, b.doc_id as dst
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id
  having 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(node, seen) as (
  select doc_id, doc_id from documents
  union
  select r.node, l.dst from reach r join links l on l.src = r.seen),
least as (select node, min(seen) as component_id from reach group by node)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, l.component_id,
       s.doc_id = l.component_id as kept
from sets s join least l on l.node = s.doc_id
""",
    "op1_embedding_near_dedup": r"""
with recursive v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
u as (select vec_id, e, sqrt(list_dot_product(e, e)) as n from v),
links as (
  select a.vec_id as src, b.vec_id as dst
  from u a join u b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
reach(node, seen) as (
  select vec_id, vec_id from embeddings
  union
  select r.node, l.dst from reach r join links l on l.src = r.seen),
least as (select node, min(seen) as component_id from reach group by node),
degree as (select src, count(*) as n from links group by src)
select e.vec_id, coalesce(d.n, 0) as n_links, l.component_id, e.vec_id = l.component_id as kept
from embeddings e join least l on l.node = e.vec_id left join degree d on d.src = e.vec_id
""",
    "op2_url_filter": r"""
with pg as (
  select page_id, url,
         regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.+$', '') as host,
         regexp_replace(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/+$', '') as path,
         date '2023-01-01' + cast(page_id * 7919 % 730 as integer) as fetched_at
  from pages),
names as (select distinct host, string_split(host, '.') as labels, string_split(path, '/')[2] as section
          from pg where host <> ''),
entries as (
  select distinct list_name, entry, part from (
    select 'hosts' as list_name, host as entry, 2 as part from names
    union all select 'domains', array_to_string(labels[-2:], '.'), 3 from names
    union all select 'paths', host || '/' || section, 4 from names) where entry is not null),
coded as (select *, cast('0x' || md5(entry)[1:6] as bigint) as code from entries),
history as (
  select list_name, entry, date '2023-01-01' + cast(code % 500 as integer) as first_day
  from coded where code % part = 0),
valid as (
  select list_name, entry, first_day as valid_from, first_day + 200 as valid_to from history
  union all select list_name, entry, first_day + 300, date '9999-12-31' from history),
keys as (
  select distinct page_id, unnest(list_concat(
    case when host = '' then [] when len(string_split(host, '.')) < 2 then [host]
         else list_transform(range(1, len(string_split(host, '.'))),
                             lambda i: array_to_string(string_split(host, '.')[i:], '.')) end,
    list_transform(
      range(1, len(list_filter(string_split(path, '/'), lambda p: p <> '')) + 1),
      lambda i: host || '/' || array_to_string(list_filter(string_split(path, '/'), lambda p: p <> '')[1:i], '/'))
  )) as entry from pg where host <> ''),
found as (
  select p.page_id, count(*) as n, array_to_string(list_sort(list(distinct v.list_name)), ',') as lists,
         first(v.entry order by length(v.entry) desc, v.list_name, v.entry, v.valid_from) as entry,
         first(v.valid_from order by length(v.entry) desc, v.list_name, v.entry, v.valid_from) as since
  from pg p join keys k using (page_id) join valid v on v.entry = k.entry
   and v.valid_from <= p.fetched_at and p.fetched_at < v.valid_to
  group by p.page_id)
select p.page_id, p.url, p.host, strftime(p.fetched_at, '%Y-%m-%d') as fetched_at, f.n is not null as listed,
       coalesce(f.n, 0) as n_entries, coalesce(f.lists, '') as lists, f.entry,
       strftime(f.since, '%Y-%m-%d') as listed_since
from pg p left join found f using (page_id)
""",
    "op4_chat_format": r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped as (
  select *, regexp_matches(text, '[<\[]\\*(/?s>|/?INST\])') as conflict,
         regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\2\\\3', 'g') as body from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(length('<s>[INST] ') + length(role) + length(' [/INST]') + 1 + length(body)
                + length('</s>') + 1) as bigint) as formatted_chars,
       cast(count(*) filter (conflict) as bigint) as escaped_turns
from escaped group by conv_id
""",
    "op5_warc_derivatives": r"""
with src as (
  select page_id, coalesce(url, '') as target_uri, coalesce(html, '') as html from pages),
resp as (
  select *, 'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
            || 'Content-Length: ' || strlen(html) as http,
         md5('response' || chr(10) || coalesce(cast(page_id as varchar), '') || chr(10) || target_uri) as h
  from src),
ids as (
  select *, '<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-8' || h[18:20] || '-' || h[21:32] || '>' as rid,
         http || chr(13) || chr(10) || chr(13) || chr(10) || html as block0 from resp),
step1 as (
  select *, regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<template\b.*?</template\s*>|<head\b.*?</head\s*>', '', 'g'),
      '(?i)</?(?:p|div|article|section|main|header|footer|nav|aside|ul|ol|li|table|tr|h[1-6]|blockquote|pre|form|br|hr)\b[^>]*>', chr(10), 'g'),
      '<[a-zA-Z/!?][^>]*>', '', 'g') as t,
    regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["\x27]([^"\x27]*)["\x27]', 1) as l,
    trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(
      regexp_extract(html, '(?is)<title[^>]*>([^<]*)', 1), '&nbsp;', ' '), '&quot;', '"'),
      '&apos;', chr(39)), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'), ' ') as title,
    md5('conversion' || chr(10) || rid) as hc, md5('metadata' || chr(10) || rid) as hm from ids),
step2 as (
  select *, regexp_replace(regexp_replace(regexp_replace(
      replace(replace(replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&quot;', '"'),
        '&apos;', chr(39)), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'),
      '[ \t\r\f\x0B]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g') as text,
    '<urn:uuid:' || hc[1:8] || '-' || hc[9:12] || '-5' || hc[14:16] || '-8' || hc[18:20] || '-' || hc[21:32] || '>' as cid,
    '<urn:uuid:' || hm[1:8] || '-' || hm[9:12] || '-5' || hm[14:16] || '-8' || hm[18:20] || '-' || hm[21:32] || '>' as mid
  from step1),
both_kinds as (
  select page_id, cid as record_id, 'conversion' as warc_type, rid as refers_to, target_uri,
         'text/plain; charset=utf-8' as content_type, text as block from step2
  union all
  select page_id, mid, 'metadata', rid, target_uri, 'application/warc-fields',
    'source-record-id: ' || rid || chr(13) || chr(10)
    || 'source-content-length: ' || strlen(block0) || chr(13) || chr(10)
    || 'source-block-digest: sha256:' || sha256(block0) || chr(13) || chr(10)
    || 'source-payload-digest: sha256:' || sha256(html) || chr(13) || chr(10)
    || array_to_string(list_transform(string_split(http, chr(13) || chr(10)),
                                      lambda x: 'http-header: ' || x || chr(13) || chr(10)), '')
    || 'title: ' || title || chr(13) || chr(10)
    || coalesce(array_to_string(list_transform(list_filter(l, lambda x, i: list_position(l, x) = i),
                                      lambda x: 'outlink: ' || x || chr(13) || chr(10)), ''), '')
    || 'conversion-record-id: ' || cid || chr(13) || chr(10)
    || 'conversion-block-digest: sha256:' || sha256(text) || chr(13) || chr(10)
  from step2)
select page_id, record_id, warc_type, refers_to, target_uri, '2024-01-01T00:00:00Z' as warc_date, content_type,
       'sha256:' || sha256(block) as block_digest, cast(null as varchar) as payload_digest,
       cast(strlen(block) as bigint) as content_length, block
from both_kinds
""",
    "op10_decontamination": r"""
with item_words as (
  select item_id, list_filter(list_transform(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'),
           lambda x: regexp_replace(x, '[^\p{L}\p{N}]+', '', 'g')), lambda x: x <> '') as w from benchmark),
doc_words as (
  select doc_id, list_filter(list_transform(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'),
           lambda x: regexp_replace(x, '[^\p{L}\p{N}]+', '', 'g')), lambda x: x <> '') as w from documents),
items as (
  select item_id, len(w) as n, greatest(len(w) - 4, 1) as m,
         case when len(w) < 5 then [array_to_string(w, ' ')]
              else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end as s
  from item_words where len(w) > 0),
item_shingles as (
  select item_id, shingle, count(*) as c from (select item_id, unnest(s) as shingle from items) group by all),
docs as (
  select doc_id, len(w) as words,
         list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) as s
  from doc_words where len(w) >= 5),
doc_shingles as (
  select doc_id, words, unnest(s) as shingle, unnest(range(0, len(s))) as pos, len(s) as total from docs),
hits as (
  select d.doc_id, i.item_id, i.n, i.m, d.words, d.pos, d.shingle, x.c,
         least(i.m, d.total) as size, d.total - least(i.m, d.total) as last
  from doc_shingles d join item_shingles x on x.shingle = d.shingle join items i on i.item_id = x.item_id),
starts as (
  select doc_id, item_id, n, m, size, shingle, c,
         unnest(range(greatest(0, pos - size + 1), least(pos, last) + 1)) as start from hits),
common as (
  select doc_id, item_id, n, m, size, start, sum(shared) as shared from (
    select doc_id, item_id, n, m, size, start, shingle, least(count(*), any_value(c)) as shared
    from starts group by all) group by all),
judged as (
  select doc_id, item_id, n, start, cast(shared as double) / cast(m + size - shared as double) as similarity from common)
select doc_id, item_id, max(similarity) as similarity,
       arg_max(start, similarity * 1e9 - start) as start_word, arg_max(n, similarity) as n_words
from judged where 100 * similarity >= 80 group by doc_id, item_id
""",
    "op11_quality_rules": r"""
with d as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
w as (
  select row, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as word,
         generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) as pos from d),
per_words as (
  select row, count(*) as n_words, sum(length(word)) as word_chars,
         count(*) filter (lower(word) in (
           'the', 'be', 'to', 'of', 'and', 'that', 'have', 'with', 'der', 'die', 'und', 'das', 'den', 'von',
           'zu', 'mit', 'de', 'la', 'le', 'et', 'les', 'des', 'en', 'un', 'que', 'el', 'y', 'los', 'las',
           'del', 'por', 'con')) as stops,
         count(*) filter (regexp_matches(word, '\p{L}')) as letters
  from w group by row),
triples as (
  select row, pos, word as a, lead(word) over (partition by row order by pos) as b,
         lead(word, 2) over (partition by row order by pos) as c from w),
twice as (
  select row, pos from triples where c is not null
  qualify count(*) over (partition by row, a, b, c) > 1),
repeated as (
  select row, count(distinct pos + k) as n_repeat_words from twice, (select unnest([0, 1, 2]) as k) group by row),
l as (select row, unnest(string_split(text, chr(10))) as line from d),
per_lines as (
  select row, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines,
         count(*) filter (regexp_matches(line, '^[\x20\x09-\x0D]*[-*\x{2022}]')) as bullets,
         count(*) filter (regexp_matches(line, '(\.\.\.|\x{2026})[\x20\x09-\x0D]*$')) as dots
  from l where regexp_matches(line, '[^\x20\x09-\x0D]') group by row),
m as (
  select doc_id, coalesce(n_words, 0) as n, cast(coalesce(word_chars, 0) as bigint) as chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as symbols,
         coalesce(stops, 0) as stops, coalesce(letters, 0) as letters, coalesce(n_lines, 0) as lines,
         coalesce(n_dup_lines, 0) as dups, coalesce(bullets, 0) as bullets, coalesce(dots, 0) as dots,
         coalesce(n_repeat_words, 0) as reps
  from d left join per_words using (row) left join per_lines using (row) left join repeated using (row)),
judged as (
  select *, n < 50 or reps > 0.5 * n as base_failed,
         concat_ws(',', case when chars < 2.5 * n or chars > 12 * n then 'word_length' end,
                        case when symbols > 0.1 * n then 'symbols' end,
                        case when stops < 0.04 * n then 'stop_words' end,
                        case when letters < 0.8 * n then 'letters' end,
                        case when dups > 0.5 * lines then 'duplicate_lines' end,
                        case when bullets > 0.9 * lines then 'bullet_lines' end,
                        case when dots > 0.3 * lines then 'ellipsis_lines' end) as failed from m)
select doc_id, n as n_words, chars as word_chars, symbols as n_symbols, dups as n_dup_lines, reps as n_repeat_words,
       base_failed, not base_failed and failed = '' as kept, failed
from judged
""",
    "op13_periodic_runs": r"""
with d as (
  select row_number() over () as row, doc_id, cast(doc_id as varchar) as id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
crc as (
  select row, xor(list_reduce(
    list_concat([4294967295], list_transform(range(0, 8 * length(id)),
                lambda j: case when j % 8 = 0 then cast(ascii(id[j // 8 + 1]) as bigint) else 0 end)),
    lambda acc, b: xor(xor(acc, b) >> 1, 3988292384 * (xor(acc, b) & 1))), 4294967295) as h from d),
shape as (
  select d.row, doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as planted,
         (h // 10) % greatest(len(w), 1) as a, h // 10 as g from d join crc using (row)),
texts as (
  select row, doc_id, n, case when planted then list_transform(range(0, n), lambda i:
           w[cast(case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end as bigint) + 1])
         else w end as w from shape),
words as (select row, n, unnest(w) as word, unnest(range(0, n)) as pos from texts),
equal as (
  select x.row, x.pos, y.pos - x.pos as q from words x join words y
  on x.row = y.row and x.word = y.word and y.pos > x.pos and 4 * (y.pos - x.pos) <= x.n),
islands as (
  select row, q, pos, pos - row_number() over (partition by row, q order by pos) as island from equal),
stretches as (select row, q, min(pos) as s, max(pos) + 1 + q as e from islands group by row, q, island),
runs as (
  select row, s, e - s as len, min(q) as q from stretches where e - s >= greatest(6, 4 * q) group by row, s, e),
best as (
  select row, s, len, q from runs
  qualify row_number() over (partition by row order by cast(len as double) / q desc, s, q) = 1),
listed as (
  select row, count(*) as n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q) as lines
  from runs group by row),
dropped as (select distinct row, unnest(range(s + q, s + len)) as pos from runs),
kept as (
  select row, string_agg(word, ' ' order by pos) as body
  from words anti join dropped using (row, pos) group by row)
select t.doc_id, coalesce(l.n_runs, 0) as n_runs, b.s as start, b.len as length, b.q as period,
       1000 * b.len // b.q as exponent_milli, sha256(coalesce(l.lines, '')) as runs_sha256,
       sha256(coalesce(k.body, '')) as collapsed_sha256
from texts t left join listed l using (row) left join best b using (row) left join kept k using (row)
""",
}
