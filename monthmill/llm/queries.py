"""The operators as queries on the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.llm import collisions, collocations, licenses, line_templates, neighbours, packing, piece_bpe, quality, resampling, simhash, token_files, url_rules, winnow
from monthmill.llm.common import hex16, table

Query = Callable[[SparkSession, str], DataFrame]

# The rules of the URL query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

QUERIES: dict[str, Query] = {}
#: The same in DuckDB SQL, where SQL can express it.
ORACLE_SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's ids and of its decoded text."""
    return piece_bpe.round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of every document and of its edited text."""
    return winnow.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat files whose documents end with id 50256."""
    return token_files.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 50256)


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, dropped lines (of any length), and size and digest of what stays of every document."""
    out = line_templates.dedup(table(spark, sf_dir, "documents", ["doc_id", "text"]), min_words=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


ORACLE_SQL["op5_line_dedup"] = r"""
with each as (
  select doc_id, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos
  from documents
), marked as (
  select doc_id, pos, line, string_split_regex(trim(line, e' \t\n\x0b\x0c\r'), '[\x20\x09-\x0D]+') as plain, string_split_regex(
    trim(regexp_replace(line, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), e' \t\n\x0b\x0c\r'),
    '[\x20\x09-\x0D]+') as words
  from each
), worded as (
  select doc_id, pos, line, case when len(words) < 4 and list_distinct(words) = ['<*>'] then plain else words end as words
  from marked where plain <> ['']
), sized as (
  select *, len(words) as n, least(len(words), 16) as r, least(len(words), 16) * 3 // 16 as d, words[:3] as lead
  from worded
), cut as (
  select *, list_transform(range(r), lambda i: words[i * n // r + 1 : (i + 1) * n // r]) as runs from sized
), found as (select * exclude (line, lead), lead as head from cut),
same as (select words, min(doc_id) as first from found group by words),
banded as (
  select words, n, head, runs, d, doc_id, unnest(range(d + 1)) as b,
    unnest(list_transform(range(d + 1), lambda b: runs[b * r // (d + 1) + 1 : (b + 1) * r // (d + 1)])) as band
  from (select words, n, head, runs, d, r, min(doc_id) as doc_id from found group by all) where d > 0
), templates as (
  select n, head, b, band, arg_min(runs, doc_id) as t_runs, min(doc_id) as first from banded group by all
), near as (
  select words, min(first) as first from banded join templates using (n, head, b, band)
  where len(list_filter(range(len(runs)), lambda i: runs[i + 1] <> t_runs[i + 1])) between 1 and d group by words
), dropped as (
  select distinct doc_id, pos from found left join same using (words) left join near using (words)
  where doc_id > same.first or doc_id > near.first
), kept as (
  select e.doc_id, count(*) as n_lines, count(d.pos) as n_dropped,
    coalesce(string_agg(e.line, chr(10) order by e.pos) filter (where d.pos is null), '') as text
  from each e left join dropped d on e.doc_id = d.doc_id and e.pos = d.pos group by e.doc_id
)
select doc_id, n_lines, n_dropped, length(text) as kept_chars, md5(text) as kept_md5 from kept
"""


@query
def op6_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of at most 3 differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return neighbours.search(table(spark, sf_dir, "embeddings"))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    items = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(items).drop("certified")


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and accepted templates of every document."""
    return licenses.report(licenses.scan(table(spark, sf_dir, "documents")))


@query
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rules_frame(spark, URL_RULES))


ORACLE_SQL["op10_url_filters"] = """
with parts as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), urls as (
  select page_id, row_number() over () as n,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
  from parts
), rules(r_host, r_path, verdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits as (
  select n, r_host || r_path as rule, verdict, row_number() over (partition by n order by length(r_host || r_path) desc) as k
  from urls join rules on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path)
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from urls left join (select * from fits where k = 1) f using (n)
"""


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each lang's 2000 strongest phrases of 2 to 3 words."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL["op11_phrase_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), worded as (
  select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as ws from pieces
), totals as (
  select lang, cast(sum(len(ws)) as bigint) as n from worded group by lang
), windows as (
  select lang, unnest(ws) as w1, unnest(list_resize(ws[2:], len(ws))) as w2, unnest(list_resize(ws[3:], len(ws))) as w3 from worded
), spelled as (
  select lang, 1 as m, w1 as phrase from windows
  union all select lang, 2, w1 || ' ' || w2 from windows where w2 is not null
  union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 from windows where w3 is not null
), f as materialized (
  select lang, m, phrase, string_split(phrase, ' ') as ws, count(*) as f from spelled group by all having count(*) >= 10
), halves as (
  select lang, phrase, f as a, k, array_to_string(ws[:k], ' ') as before, array_to_string(ws[k + 1 :], ' ') as after
  from f join (values (1), (2)) as x(k) on k < m
), cuts as (
  select h.lang, h.phrase, a, k, l.f as l, r.f as r, cast((1000000::hugeint * a * a) // (l.f::hugeint * r.f) as bigint) as score
  from halves h join f l on l.lang = h.lang and l.phrase = before join f r on r.lang = h.lang and r.phrase = after
), lowest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), around as (
  select lang, phrase, max(f) as f from (
    select lang, unnest([array_to_string(ws[:2], ' '), array_to_string(ws[2:], ' ')]) as phrase, f from f where m = 3) group by all
), kept as (
  select lowest.* from lowest left join around using (lang, phrase) where around.f is null or 100 * around.f < 50 * a
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join totals using (lang) qualify rank <= 2000
"""


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by how like the benchmark it is, and the ranks of the drawn 5 %."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op12_importance_resampling"] = r"""
with tokens as materialized (
  select 'd' as side, row_number() over () as row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents
  union all
  select 'b', null, null, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  from benchmark
), windows as (
  select side, row, unnest(ws) as w1, unnest(list_resize(ws[2:], len(ws))) as w2, unnest(list_resize(ws[3:], len(ws))) as w3 from tokens
), features as (
  select side, row, w1 as feature from windows
  union all select side, row, w1 || ' ' || w2 from windows where w2 is not null
  union all select side, row, w1 || ' ' || w2 || ' ' || w3 from windows where w3 is not null
), counted as materialized (
  select side, row, feature, count(*) as n from features group by all
), hashed as materialized (
  select feature, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(range(len(h) * 4), lambda i: (strpos('123456789ABCDEF', substr(h, 2 * (i // 8) + 2 - i // 4 % 2, 1)) >> (i % 4)) & 1)),
    lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384))) % 10000 as bucket
  from (select distinct feature, hex(feature) as h from counted)
), buckets as (
  select bucket, coalesce(sum(n) filter (side = 'd'), 0) as s, coalesce(sum(n) filter (side = 'b'), 0) as t
  from counted join hashed using (feature) group by bucket
), sums as (
  select sum(s)::double as s_all, sum(t)::double as t_all from buckets
), gains as (
  select bucket, cast(floor(1000 * ln((t::double + 1) * (s_all + 10000) / ((s::double + 1) * (t_all + 10000)))) as bigint) as gain from buckets, sums
), weights as (
  select row, cast(sum(n) as bigint) as n_features, cast(sum(n * gain) as bigint) as weight
  from counted join hashed using (feature) join gains using (bucket) where side = 'd' group by row
), scored as (
  select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296))) as bigint) as score
  from tokens left join weights using (row) where side = 'd'
), placed as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place,
    count(*) filter (n_words >= 20) over () as long_enough
  from scored
)
select doc_id, n_words, n_features, weight, score, case when n_words >= 20 and place <= 5 * long_enough // 100 then place end as rank from placed
"""


@query
def op13_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector under cosines of 0.9 or more."""
    return collisions.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op13_embedding_near_duplicates"] = """
with recursive usable as (
  select row_number() over () as row, vec_id, embedding,
    coalesce(len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0, false) as ok
  from embeddings
), units as (
  select row, vec_id, embedding::double[] as v, sqrt(list_inner_product(embedding::double[], embedding::double[])) as size from usable where ok
), pairs as (
  select a.row as u, b.row as v, b.vec_id from units a join units b on a.row <> b.row and len(a.v) = len(b.v)
  where list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.9
), reached as (
  select row, vec_id, row as at from usable
  union
  select p.v, reached.vec_id, p.v from reached join pairs p on p.u = reached.at
)
select vec_id, n_links, component_id, vec_id = component_id as kept from (
  select u.vec_id, (select count(*) from pairs p where p.u = u.row) as n_links, (select min(r.vec_id) from reached r where r.row = u.row) as component_id
  from usable u)
"""
