"""The operators as registered queries over the synthetic tables, and their DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import table
from conform.llm.decontaminate import contaminated
from conform.llm.filter_audit import audit_filters
from conform.llm.license_scan import PHRASES, TEMPLATES, scan_licenses
from conform.llm.merkle import audit, lowered_text
from conform.llm.mixing import mix
from conform.llm.packing import pack
from conform.llm.quality import classify
from conform.llm.sharding import place
from conform.llm.simhash import as_hex, near_duplicates
from conform.llm.stages import SHARDS
from conform.llm.suffix_dedup import repeated_passages
from conform.llm.topk_search import top_k
from conform.llm.url_filter import RULES, SUFFIXES, filter_urls, page_outcomes
from conform.llm.warc import archive_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op8_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                        "copies", "source")


ORACLE["op8_systematic_mix"] = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
by_source as (
  select source, sum(size)::bigint as source_size, 2 * sum(size)::bigint as cap from sized group by source),
weighted as (
  select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
  from by_source),
ordered as (
  select *, row_number() over o as turn, sum(source_size) over () * 1.5::double as budget,
    coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0)::double as capped,
    (sum(weight) over () - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0))::double as open
  from weighted window o as (order by cap::double / weight, source nulls last)),
levels as (select *, (budget - capped) / open as own_level from ordered),
level as (select arg_min(own_level, turn) as l from levels where own_level * weight <= cap),
targets as (
  select source, source_size, coalesce(least(cap::double, (select l from level) * weight), cap::double) as target from levels),
placed as (
  select s.*, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
    ('0x' || substr(md5('42:' || coalesce(s.source, '')), 1, 8))::bigint / 4294967296.0::double as u,
    row_number() over (partition by s.source order by s.size, s.doc_id nulls first) as pos
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (size * least(floor(pos * rate + u) - floor((pos - 1) * rate + u), 2))::bigint as taken,
  least(floor(pos * rate + u) - floor((pos - 1) * rate + u), 2)::int as copies, source
from placed
"""


@query
def op9_shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return place(docs, SHARDS, spare_key=("source", "lang", "n_chars")).select("doc_id", "slot", "shard")


@query
def op10_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, page_outcomes(pages, table(spark, sf_dir, "labels")), RULES)


ORACLE["op10_host_reputation"] = r"""
with cut as (
  select page_id, url, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) end as rest from pages),
parsed as (
  select page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*'), '') as path
  from cut),
marked as (
  select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad from labels
  where quality is not null or toxic is not null group by doc_id),
outcomes as (
  select p.host, m.bad from (select host, regexp_extract(path, '/(\d{1,18})[^/]*/?$', 1) as doc from parsed) p
  join marked m on p.doc <> '' and try_cast(p.doc as bigint) = m.doc_id),
hosts as (
  select host, case when regexp_matches(site, '^([0-9]{1,3}\.){3}[0-9]{1,3}$') or prefix(site, '[') then site
      else array_to_string(list_slice(string_split(site, '.'), case when list_contains(SUFFIXES, array_to_string(list_slice(string_split(site, '.'), -2, -1), '.')) then -3 else -2 end, -1), '.') end as domain,
    count(bad) as n, coalesce(sum(bad), 0) as b
  from (select host, regexp_replace(host, ':[0-9]*$', '') as site, bad from (select host, bad from outcomes union all select host, null from parsed)) group by 1, 2),
domains as (
  select domain, case when regexp_matches(domain, '^([0-9]{1,3}\.){3}[0-9]{1,3}$') or prefix(domain, '[') then 'address'
      else array_to_string(list_slice(string_split(domain, '.'), case when list_contains(SUFFIXES, array_to_string(list_slice(string_split(domain, '.'), -2, -1), '.')) then -2 else -1 end, -1), '.') end as suffix,
    sum(n) as n, sum(b) as b from hosts group by 1, 2),
suffixes as (select suffix, sum(n) as n, sum(b) as b from domains group by 1),
sums as (
  select lvl, count(*)::double as k, sum(n)::double as n, sum(b)::double as b, sum(n::double * n) as nn, sum(b::double * b / n) as r
  from (select 'h' as lvl, n, b from hosts union all select 'd', n, b from domains union all select 's', n, b from suffixes)
  where n > 0 group by 1),
rho as (
  select lvl, b / n as p, b / n * (1 - b / n) as noise, n - nn / n - (k - 1) as room,
    (r - n * (b / n) * (b / n) - b / n * (1 - b / n) * (k - 1)) / (b / n * (1 - b / n) * (n - nn / n - (k - 1))) as rho from sums),
strength as (
  select lvl, p, case when noise <= 0 or room <= 0 then 1000.0 when rho > 0 then least(greatest((1 - rho) / rho, 2.0), 1000.0) else 1000.0 end as m from rho),
par as (
  select coalesce((select p from strength where lvl = 's'), 0.5) as p0, coalesce((select m from strength where lvl = 's'), 2.0) as ms,
    coalesce((select m from strength where lvl = 'd'), 2.0) as md, coalesce((select m from strength where lvl = 'h'), 2.0) as mh),
s_rate as (select suffix, (ms * p0 + b) / (ms + n) as rate from suffixes, par),
d_rate as (select domain, (md * s.rate + b) / (md + n) as rate from domains d join s_rate s using (suffix), par),
h_rate as (select host, n, b, mh, (mh * d.rate + b) / (mh + n) as rate from hosts h join d_rate d using (domain), par),
bound as (select host, n, b, rate - 1.645 * sqrt(rate * (1 - rate) / (mh + n + 1)) as bound from h_rate),
ruled as (
  select p.page_id, p.host, p.path, b.n, b.b, b.bound,
    case when (host = 'example.net' or suffix(host, '.example.net')) and prefix(path, '/en/') then 'example.net/en/'
         when (host = 'example.com' or suffix(host, '.example.com')) and prefix(path, '/de/') then 'example.com/de/'
         when (host = 'org' or suffix(host, '.org')) and prefix(path, '/fr/') then 'org/fr/'
         when (host = 'net' or suffix(host, '.net')) and prefix(path, '/') then 'net/' end as rule
  from parsed p join bound b using (host))
select page_id, host, path, rule,
  case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
       when bound >= 0.5 then 'block' else 'allow' end as verdict,
  n::bigint as host_labelled, b::bigint as host_bad, round(bound, 4) as bad_bound
from ruled
""".replace("SUFFIXES", str(list(SUFFIXES)))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op2_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shortest=1, every_id=True)
    return found.select("doc_id", "item_id", "start_word", "n_words", "n_same", "item_words")


@query
def op5_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


@query
def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive_pages(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "position")


ORACLE["op7_warc_index"] = r"""
with cut as (
  select page_id, url, encode(coalesce(html, '')) as payload, sha1(coalesce(html, '')) as hex from pages),
shared as (select hex, max(page_id) as response from cut group by hex),
quints as (
  select hex, list_transform(range(0, 8), lambda i: ('0x' || substr(hex, 1 + 5 * i, 5))::bigint) as q from (select distinct hex from cut)),
digests as (
  select hex, array_to_string(list_transform(q, lambda v:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 15 & 31)::bigint + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 10 & 31)::bigint + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 5 & 31)::bigint + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31)::bigint + 1, 1)), '') as digest
  from quints),
parsed as (
  select c.*, contains(coalesce(url, ''), '://') as has, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from cut c),
keyed as (
  select *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    case when has then regexp_replace(rest, '^[^/?#]*', '') else coalesce(url, '') end as tail from parsed),
entries as (
  select k.page_id, octet_length(payload)::bigint as payload_bytes, d.digest as payload_digest,
    case when s.response is distinct from k.page_id and s.response is not null then 'revisit' else 'response' end as record_type,
    case when s.response is distinct from k.page_id then s.response end as refers_to,
    case when has then array_to_string(list_reverse(string_split(host, '.')), ',') else '' end || ')' || split_part(tail, '#', 1) as url_key,
    strftime(timestamp '2026-01-01' + to_seconds(((coalesce(k.page_id, 0) % 100000000) + 100000000) % 100000000), '%Y%m%d%H%M%S') as captured
  from keyed k join shared s using (hex) join digests d using (hex))
select *, row_number() over (order by url_key, captured, page_id nulls first) as position from entries
"""


@query
def op1_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE["op1_pivot_topk"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as x from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.x) = len(c.x) where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


@query
def op6_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    """The scan as joins of word positions: a start is a position less the word's place in a phrase or template."""
    def rows(items) -> str:
        return ", ".join("(" + ", ".join(repr(x) for x in r) + ")" for r in items)

    phrases = [(k, p, w) for k, (text, _) in enumerate(PHRASES) for p, w in enumerate(text.split())]
    templates = [(k, p, w) for k, (_, text, _) in enumerate(TEMPLATES) for p, w in enumerate(text.split())]
    keys = []
    for k, (_, text, parts) in enumerate(TEMPLATES):
        words = text.split()
        for part in (x.split() for x in parts):
            at = next(i for i in range(len(words)) if words[i:i + len(part)] == part)
            keys += [(k, at + i, w) for i, w in enumerate(part)]
    return rf"""
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents),
phrase_words(k, p, w) as (values {rows(phrases)}), template_words(k, p, w) as (values {rows(templates)}), key_words(k, p, w) as (values {rows(sorted(set(keys)))}),
phrase_labels(k, label) as (values {rows((k, x[1]) for k, x in enumerate(PHRASES))}), template_labels(k, label) as (values {rows((k, x[0]) for k, x in enumerate(TEMPLATES))}),
vocab as (select w from phrase_words union select w from template_words),
posts as (select * from (select r, unnest(ws) as w, unnest(range(len(ws))) as i from docs) where w in (select w from vocab)),
df as (select v.w, count(distinct r) as n from vocab v left join posts using (w) group by 1),
idf as (select w, n, ln(((select count(*) from docs) + 1) / (n + 1)) + 1e-9 as idf from df),
base as (
  select r, k, s from (select r, k, i - p as s from posts join phrase_words using (w)) join (select k, count(*) as c from phrase_words group by 1) using (k)
  group by r, k, s having count(*) = any_value(c)),
once as (select k, w, min(p) as p from template_words group by 1, 2 having count(*) = 1),
need as (select k, least(3, count(*)) as c from once group by 1),
rare as (
  select * from (select r, k, w, p, row_number() over (partition by r, k order by n, w) as place
    from (select distinct r, w from posts) join once using (w) join idf using (w)) join need using (k) where place <= c),
agreed as (select r, k, s from (select r, k, c, i - p as s from rare join posts using (r, w)) group by r, k, s having count(*) = any_value(c)),
verified as (
  select a.r, a.k, a.s from agreed a join key_words y on y.k = a.k join (select k, count(*) as c from key_words group by 1) z on z.k = a.k
  join posts q on q.r = a.r and q.w = y.w and q.i = a.s + y.p group by a.r, a.k, a.s having count(*) = any_value(z.c)),
first_at as (select r, k, min(s) as s from verified group by 1, 2),
total as (select k, sum(idf) as total from template_words join idf using (w) group by 1),
shares as (
  select f.r, f.k, sum(d.idf) / any_value(t.total) as share from first_at f join template_words y using (k) join idf d using (w)
  join posts q on q.r = f.r and q.w = y.w and q.i = f.s + y.p join total t on t.k = f.k group by 1, 2),
base_of as (
  select r, count(*) as n, min(s) as a, max(s) as b, string_agg(distinct label, ',' order by label) as labels from base join phrase_labels using (k) group by 1),
all_of as (
  select r, string_agg(distinct label, ',' order by label) as labels from (
    select r, label from base join phrase_labels using (k) union all select r, label from verified join template_labels using (k)) group by 1),
best as (select r, max(share) as best from shares group by 1)
select doc_id, len(ws)::bigint as n_words, coalesce(b.n, 0)::bigint as n_base, b.a::bigint as first_word, b.b::bigint as last_word,
  coalesce(b.labels, '') as base_labels, coalesce(x.labels, '') as labels,
  case when b.n > 0 then 1.0 else round(least(coalesce(m.best, 0.0), 1.0), 6) end::double as score
from docs d left join base_of b using (r) left join all_of x using (r) left join best m using (r)
"""


ORACLE["op6_license_index"] = _license_sql()


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return audit(docs, tampered=lowered_text())


ORACLE["op11_merkle_manifest"] = r"""
with recursive table_of as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) as t),
docs as (
  select *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lowered,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as crc
  from documents, table_of),
framed as (
  select doc_id, lang, crc, concat_ws('', f(doc_id), f(source), f(lang), f(n_chars)) as head, f(text) as body, f(lowered) as lowered from docs),
leaves as (
  select doc_id, lang, sha256(head || body) as leaf, sha256(head || case when crc % 3 = 0 then lowered else body end) as tampered from framed),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as size from leaves),
nodes as (
  select lang, 0 as h, pos, size as n, leaf as d from placed
  union all
  select lang, h, pos, n, sha256(string_agg(d, '' order by below)) as d
  from (select lang, h + 1 as h, pos // 8 as pos, (n + 7) // 8 as n, pos as below, d from nodes where n > 1) group by lang, h, pos, n),
subroots as (
  select lang, h, d, row_number() over (order by lang nulls first) - 1 as place, count(*) over () as groups from nodes where n = 1),
tops as (
  select 0 as h, place as pos, groups as n, d from subroots
  union all
  select h, pos, n, sha256(string_agg(d, '' order by below)) as d
  from (select h + 1 as h, pos // 8 as pos, (n + 7) // 8 as n, pos as below, d from tops where n > 1) group by h, pos, n),
runs as (
  select lang, h, pos, d, list(d) over (partition by lang, h, pos // 8 order by pos rows between unbounded preceding and unbounded following) as run from nodes where n > 1),
top_runs as (
  select h, pos, d, list(d) over (partition by h, pos // 8 order by pos rows between unbounded preceding and unbounded following) as run from tops where n > 1),
ways as (
  select p.lang, p.pos, s.d as subroot, list(list_concat([r.run[:(p.pos // (8 ** r.h)::bigint) % 8], r.run[(p.pos // (8 ** r.h)::bigint) % 8 + 2:]]) order by r.h) filter (r.h is not null) as segments
  from placed p join subroots s on s.lang is not distinct from p.lang
  left join runs r on r.lang is not distinct from p.lang and r.pos = p.pos // (8 ** r.h)::bigint group by 1, 2, 3),
top_ways as (
  select s.lang, list(list_concat([r.run[:(s.place // (8 ** r.h)::bigint) % 8], r.run[(s.place // (8 ** r.h)::bigint) % 8 + 2:]]) order by r.h) filter (r.h is not null) as segments
  from subroots s left join top_runs r on r.pos = s.place // (8 ** r.h)::bigint group by 1),
paths as (
  select w.lang, w.pos, w.subroot, list_transform(list_concat(coalesce(w.segments, []), coalesce(t.segments, [])), lambda s:
    {'before': array_to_string(s[1], ''), 'after': array_to_string(s[2], '')}) as path
  from ways w join top_ways t on t.lang is not distinct from w.lang)
select p.doc_id, p.leaf, w.subroot, r.d as root, sha256(array_to_string(list_transform(w.path, lambda s: s.before || s.after), '')) as proof_sha256,
  list_reduce(list_prepend({'before': '', 'after': p.tampered}, w.path), lambda a, s: {'before': '', 'after': sha256(s.before || a.after || s.after)}).after as folded_root,
  folded_root = r.d as verified
from placed p join paths w on w.lang is not distinct from p.lang and w.pos = p.pos join tops r on r.n = 1
"""


def _framed(sql: str) -> str:
    """f(x): a value as the leaf's digest takes it."""
    import re

    return re.sub(r"\bf\((\w+)\)", r"case when \1 is null then '-' else strlen(\1::varchar) || ':' || \1::varchar end", sql)


ORACLE["op11_merkle_manifest"] = _framed(ORACLE["op11_merkle_manifest"])


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op12_filter_audit"] = r"""
with docs as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
marks as (select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by doc_id),
failing as (
  select d.doc_id, part, coalesce(m.good, false) as good, coalesce(m.toxic, false) as toxic,
    (case when len(ws) < 200 then 1 else 0 end) + (case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 2 else 0 end)
    + (case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) then 4 else 0 end)
    + (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end)
    + (case when coalesce(d.doc_id > min(d.doc_id) over (partition by t), min(d.doc_id) over (partition by t) is not null) then 16 else 0 end) as mask
  from docs d left join marks m on m.doc_id = d.doc_id),
masks as (
  select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from failing group by 1, 2),
letters(l, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (
  select a.l || b.l || c.l || d.l || e.l as filter_order from letters a, letters b, letters c, letters d, letters e
  where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps as (
  select filter_order, strpos(filter_order, l) as step, bit, (select sum(y.bit) from letters y where strpos(filter_order, y.l) < strpos(filter_order, x.l)) as before
  from orders, letters x),
counted as (
  select part, filter_order, step, bit, sum(n) filter (mask & (coalesce(before, 0)::int | bit) = 0) as kept,
    sum(n) filter (mask & coalesce(before, 0)::int = 0 and mask & bit > 0) as removed, sum(n) filter (mask & bit > 0) as failed,
    sum(n) filter (mask = bit) as alone, sum(good) filter (mask & coalesce(before, 0)::int = 0 and mask & bit > 0) as good,
    sum(toxic) filter (mask & coalesce(before, 0)::int = 0 and mask & bit > 0) as toxic
  from masks, steps group by 1, 2, 3, 4)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
  (coalesce(failed, 0) - coalesce(removed, 0))::bigint as redundant, coalesce(alone, 0)::bigint as unique_fails, coalesce(good, 0)::bigint as good_lost,
  coalesce(toxic, 0)::bigint as toxic_lost, coalesce(sum(removed) over (partition by part, bit), 0)::bigint as shapley
from counted
"""


@query
def op13_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
