"""SQL of the training-data queries that SQL can express, for the correctness check."""

from siltstone.llm.pairs import LANGUAGE_OF

# White space as Unicode has it, for an engine whose patterns know only ASCII space.
SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_COMMON = "[" + ", ".join(f"'{w}'" for w in sorted(LANGUAGE_OF)) + "]"

SQL = {
    "p1_links": r"""with r as (select distinct pair_id, regexp_extract_all(lower(coalesce(question, '') || ' ' || coalesce(answer, '')), '[\p{L}\p{N}]+') as w from qa_pairs),
k as (select pair_id, list_sort(list_distinct(w)) as s from r), d as (select s, count(*) as copies, row_number() over (order by s) as id from k group by s),
w as (select id, unnest(s) as w, len(s) as n from d), c as (select a.id as x, b.id as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as c from w a join w b on a.w = b.w and a.id <> b.id group by a.id, b.id),
l as (select x, count(*) as links from c where c * 5 >= 4 * (nx + ny - c) group by x)
select k.pair_id, d.copies, coalesce(l.links, 0) as links from k join d using (s) left join l on l.x = d.id""",
    "p7_numbers": rf"""with t as (select distinct 'chunks' as origin, doc_id as row_id, chunk_ix as ix, content as text from chunks where content is not null union select distinct 'qa_pairs', pair_id, 0, context from qa_pairs where context is not null),
w as (select *, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') as w, list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{SPACE}+', '', 'g') <> '') as l, length(regexp_replace(text, '{SPACE}+', '', 'g')) as dense from t),
n as (select *, len(w) as n, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as letters from w)
select origin, row_id, ix, n as word_count, round(case when n = 0 then 0 else letters / n end, 6) as mean_word_length, round(case when dense = 0 then 0 else greatest(0, dense - letters) / dense end, 6) as symbol_share,
  round(case when len(l) = 0 then 0 else len(list_filter(l, lambda x: regexp_matches(right(regexp_replace(x, '{SPACE}+$', ''), 8), '[.!?…。！？؟।][\"''”’»“」』）)\]]*$'))) / len(l) end, 6) as closed_line_share,
  round(case when n = 0 then 0 else len(list_filter(w, lambda x: list_contains({_COMMON}, x))) / n end, 6) as common_word_share from n""",
    "p1_found": r"""with w as (select distinct pair_id, unnest(regexp_extract_all(lower(coalesce(question, '') || ' ' || coalesce(answer, '')), '[\p{L}\p{N}]+')) as w from qa_pairs),
n as (select pair_id, count(*) as n from w group by pair_id),
s as (select a.pair_id as x, b.pair_id as y, count(*) as c from w a join w b on a.w = b.w and a.pair_id < b.pair_id group by all)
select x as pair_id_a, y as pair_id_b from s join n p on p.pair_id = x join n q on q.pair_id = y where c * 5 >= 4 * (p.n + q.n - c)""",
    "p3_found": r"""with s as (select distinct source from qa_pairs where source is not null),
a as (select source, regexp_replace(regexp_replace(source, '^\s+|\s+$', '', 'g'), '#.*$', '') as k from s),
b as (select source, replace(lower(nfc_normalize(url_decode(k))), '\', '/') as k from a),
c as (select source, array_to_string(list_filter(string_split(regexp_replace(k, '^file:', ''), '/'), lambda x: x not in ('', '.')), '/') as k from b)
select x.source as source_a, y.source as source_b from c x join c y on x.k = y.k and x.source < y.source""",
    "p5_found": r"""select distinct doc_id, case when list_max(list_transform(regexp_extract_all(content, '[\p{L}\p{N}]+'), lambda w: length(w))) > max_chars then 'forced' else 'natural' end as cut
from docs join piece_limits l on lower(trim(docs.format)) = lower(trim(l.format)) where length(content) > max_chars""",
    "p8_found": r"""with i as (select item_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}]+') as w from eval_items),
g as (select distinct item_id, unnest(list_transform(range(1, greatest(len(w) - 6, 1)), lambda k: array_to_string(w[k : k + 7], ' '))) as g from i),
u as (select g, min(item_id) as item_id from g group by g having count(*) = 1),
d as (select doc_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}]+') as w from documents),
h as (select doc_id, unnest(list_transform(range(1, greatest(len(w) - 6, 1)), lambda k: array_to_string(w[k : k + 7], ' '))) as g from d)
select distinct doc_id, item_id from h join u using (g)""",
    "p9_found": r"""with t as (select source, coalesce(sum(length(text)), 0) as n from documents where source in (select source from mix_targets) group by source)
select m.source from mix_targets m left join t using (source) where coalesce(n, 0) * max_repeats < target_share * (select sum(n) from t)""",
}
