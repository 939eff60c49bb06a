"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

import string

# all pairs with a shared shingle, then all pairs that are reachable over links
NEAR_DUPLICATES = rf"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), shingles as (
  select doc_id, unnest(list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, chr(10))]
    else list_transform(range(1, len(w) - 1), lambda i: concat_ws(chr(10), w[i], w[i + 1], w[i + 2])) end)) as s
  from words
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as i from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
), links as (
  select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * i >= 85 * (p.n + q.n - i)
), edges as (
  select x, y from links union all select y, x from links
), reached as (
  select doc_id as x, doc_id as y from documents
  union
  select r.x, e.y from reached r join edges e on r.y = e.x
), lowest as (
  select x, min(y) as component_id from reached group by x
)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join sizes s on s.doc_id = d.doc_id join lowest l on l.x = d.doc_id"""

# all windows of 100 bytes, as 200 hexadecimal digits
REPEATED_BYTES = """
with texts as (
  select doc_id, coalesce(octet_length(encode(text)), 0) as n, coalesce(hex(encode(text)), '') as x from documents
), windows as (
  select doc_id, i, md5(substr(x, 2 * i + 1, 200)) as k from texts, unnest(range(0, n - 99)) t(i) where n >= 100
), firsts as (
  select k, min({'d': doc_id, 'i': i}) as f from windows group by k
), repeats as (
  select doc_id, i from windows join firsts using (k) where doc_id <> f.d or i <> f.i
), runs as (
  select doc_id, i, sum(case when i - before <= 100 then 0 else 1 end) over (partition by doc_id order by i) as g
  from (select *, lag(i) over (partition by doc_id order by i) as before from repeats)
), spans as (
  select doc_id, min(i) as s, max(i) + 100 as e from runs group by doc_id, g
), parts as (
  select doc_id, s, e, coalesce(lag(e) over (partition by doc_id order by s), 0) as b from spans
), left_over as (
  select doc_id, sum(e - s) as n_removed, count(*) as n_spans,
    string_agg(substr(x, 2 * b + 1, 2 * (s - b)), '' order by s) || substr(any_value(x), 2 * max(e) + 1) as kept
  from parts join texts using (doc_id) group by doc_id
)
select doc_id, cast(n as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(kept, x))) as kept_sha256
from texts left join left_over using (doc_id)"""

# each line with its key, then the first document of each shared key
REPEATED_LINES = rf"""
with pieces as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as p from documents
), lines as (
  select doc_id, i, p[i] as line,
    trim(translate(p[i], '{string.ascii_uppercase}', '{string.ascii_lowercase}'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as k
  from pieces, unnest(range(1, len(p) + 1)) r(i)
), shared as (
  select k, min(doc_id) as f from lines where length(k) >= 10 group by k having count(distinct doc_id) >= 2
), judged as (
  select doc_id, i, line, f is not null and f <> doc_id as dropped from lines left join shared using (k)
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not dropped), '')) as kept_sha256
from judged group by doc_id"""

# every term of every document, then every document that shares a term with an item
RANKED_SEARCH = rf"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) as t from documents
), counted as (
  select doc_id, t, count(*) as tf from words group by doc_id, t
), lengths as (
  select doc_id, cast(sum(tf) as bigint) as n from counted group by doc_id
), totals as (
  select count(*) as all_docs, cast(sum(n) as bigint) as all_terms from lengths
), weights as (
  select t, cast(floor(1000 * ln(cast(2 * any_value(all_docs) + 2 as double) / (2 * count(*) + 1))) as bigint) as w from counted, totals group by t
), asked as (
  select item_id, t, count(*) as c from (
    select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) as t from benchmark
  ) group by item_id, t
), scored as (
  select item_id, doc_id, cast(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * all_docs) // all_terms)))) as bigint) as score
  from asked join counted using (t) join weights using (t) join lengths using (doc_id), totals group by item_id, doc_id
), ranked as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score from scored where score > 0
)
select * from ranked where rank <= 10"""

# every anchor against every row
HARD_NEGATIVES = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select a.vec_id as anchor_id, r.vec_id, r.label = a.label as same, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * r.q[i])) as s
  from vectors a join vectors r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0
), positives as (
  select anchor_id, vec_id as positive_id, cast(s as bigint) as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by s desc, vec_id) <= 5
), ranked as (
  select p.anchor_id, positive_id, vec_id as negative_id, positive_score, cast(s as bigint) as negative_score,
    cast(row_number() over (partition by p.anchor_id, positive_id order by s desc, vec_id) as integer) as rank
  from positives p join pairs n on n.anchor_id = p.anchor_id and not same and 80 * positive_score <= 100 * s and 100 * s <= 100 * positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ranked where rank <= 5"""

ORACLES: dict[str, str] = {
    "op3_setsketch_near_duplicates": NEAR_DUPLICATES,
    "op10_suffix_sort_dedup": REPEATED_BYTES,
    "op11_line_dedup": REPEATED_LINES,
    "op12_automaton_search": RANKED_SEARCH,
    "op13_hard_negatives": HARD_NEGATIVES,
}
