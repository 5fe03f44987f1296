"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    decontaminate, doubling, exact_dedup, hard_negatives, html_text, lm, quality, secret_scan,
    sentencepiece_viterbi, simhash, spelling, suffix_dedup, url_filter,
)
from daybook.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


ORACLE["op7_exact_dedup"] = r"""
with d as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm
  from documents
)
select doc_id, min(doc_id) over (partition by norm) as keep_id,
       count(*) over (partition by norm) as group_size,
       doc_id = min(doc_id) over (partition by norm) as kept,
       sha256(norm) as text_sha256
from d
"""


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, radius=4)


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=10
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE["op3_decontamination"] = r"""
with w as (
  select doc_id, text,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents
), b as (
  select item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from benchmark
), iw as (
  select distinct item_id, least(10, len(ws)) as n,
         array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') as win
  from (select item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) as i from b where len(ws) > 0)
), dp as (
  select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i
  from w, (select distinct n from iw) where len(ws) >= n
), h as (
  select doc_id, i, dp.n, item_id from dp join iw on dp.n = iw.n and array_to_string(ws[i:i + dp.n - 1], ' ') = win
), pos as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from h) group by doc_id
), its as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from h) group by doc_id
)
select w.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join pos using (doc_id) left join its using (doc_id)
"""


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), threshold=0.3
    )


@query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.encode_documents(read_table(spark, sf_dir, "documents"))


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def _number(value: Column, below: int) -> Column:
    """A number that a text always gives: the first four hex digits of its MD5."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 4), 16, 10).cast("int") % below


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures; the day of the fetch follows from the URL."""
    return read_table(spark, sf_dir, "pages").select(
        "page_id", "url",
        F.date_add(F.lit("2023-01-01").cast("date"), _number(F.col("url"), 730)).alias("fetched_on"),
    )


def _list_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated list changes for every host of the pages, its parent domain and its sections.

    A target is added, removed and added again; which list and when follows from its name.
    """
    url = F.col("url")
    host, section = url_filter.host_of(url), url_filter.section_of(url)
    targets = (
        read_table(spark, sf_dir, "pages").select(F.explode(F.array(
            host, F.regexp_replace(host, r"^[^.]*\.", ""), F.concat(host, F.lit("/"), section)
        )).alias("target")).distinct()
    )
    start = F.date_add(F.lit("2022-07-01").cast("date"), _number(F.col("target"), 400))
    days = _number(F.concat("target", F.lit("#days")), 300) + 1
    return targets.select(
        F.when(_number(F.concat("target", F.lit("#list")), 3) == 0, "allow").otherwise("block").alias("list"),
        "target", F.inline(F.array(
            F.struct(start.alias("at"), F.lit("add").alias("action")),
            F.struct(F.date_add(start, days).alias("at"), F.lit("remove").alias("action")),
            F.struct(F.date_add(start, days * 2).alias("at"), F.lit("add").alias("action")),
        )),
    )


@query
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.filter_captures(
        _captures(spark, sf_dir), _list_changes(spark, sf_dir), time_col="fetched_on"
    )
    return found.withColumn("entries", F.array_join("entries", " "))


ORACLE["op10_url_filters"] = r"""
with c as (
  select page_id, url, date '2023-01-01' + cast(('0x' || substr(md5(url), 1, 4))::int % 730 as int) as fetched_on,
         regexp_replace(lower(regexp_replace(regexp_replace(
           regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')),
           '\.$', '') as host,
         regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) as section,
         row_number() over () as r
  from pages
), targets as (
  select distinct unnest([host, regexp_replace(host, '^[^.]*\.', ''), host || '/' || section]) as target from c
), dated as (
  select target, case when ('0x' || substr(md5(target || '#list'), 1, 4))::int % 3 = 0 then 'allow' else 'block' end as list,
         date '2022-07-01' + cast(('0x' || substr(md5(target), 1, 4))::int % 400 as int) as s,
         cast(('0x' || substr(md5(target || '#days'), 1, 4))::int % 300 + 1 as int) as n
  from targets
), iv as (
  select list, target, s as since, s + n as until from dated
  union all select list, target, s + 2 * n, null from dated
), labels as (
  select r, page_id, url, fetched_on, host, section, string_split(host, '.') as l from c where host <> ''
), asked as (
  select r, fetched_on, array_to_string(l[i:], '.') as target
  from (select *, unnest(range(1, len(l) + 1)) as i from labels)
  union select r, fetched_on, host || '/' || section from labels where section <> ''
), met as (
  select distinct r, list, iv.target from asked join iv on asked.target = iv.target
  where since <= fetched_on and (until is null or fetched_on < until)
), best as (
  select r, string_agg(list || ':' || target, ' ' order by list || ':' || target) as entries,
         max({'n': length(target), 'a': list = 'allow', 't': target, 'l': list}) as b
  from met group by r
)
select page_id, url, fetched_on, host, coalesce(entries, '') as entries, b.t as target, coalesce(b.l, 'none') as verdict
from c left join best using (r)
"""


#: What a finding of a known form looks like: a key id, or a value with a digit assigned to a secret's
#: name, which may have a prefix and a suffix. Known not to be secrets are runs of one kind of
#: characters without such a name; all other forms have no label.
KEY_ID = r"^AKIA[A-Z2-7]{16}$"
ASSIGNED_SECRET = (
    r"(?i)(token|passw(or)?d|passphrase|pwd|secret|credential|(api|access|private|auth|secret)[_\-]?key)s?"
    r"([_\-][A-Za-z0-9_\-]{0,40}|[0-9]{0,4})[\"']?\s{0,8}(=>|:=|[=:])\s{0,8}[\"']?$"
)
PLAIN = r"^([0-9_+/\-]+|[A-Z]?[a-z_+/\-]+|[A-Z_+/\-]+)$"


def _secret_label() -> Column:
    candidate, named = F.col("candidate"), F.col("before").rlike(ASSIGNED_SECRET)
    return (
        F.when(candidate.rlike(KEY_ID) | (named & candidate.rlike("[0-9]")), 1)
        .when(candidate.rlike(PLAIN) & ~named, 0)
    )


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table holds labelled findings: known forms count as labelled, unknown forms have no label."""
    return secret_scan.scan(
        read_table(spark, sf_dir, "documents"), label=_secret_label(), learn=~quality.held_out(F.col("id"))
    )


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_spans(read_table(spark, sf_dir, "documents"), length=400, keep_first=False)
    removed = F.expr("aggregate(spans, 0L, (n, s) -> n + s.b - s.a)")
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )


@query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(read_table(spark, sf_dir, "documents"))


@query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = doubling.repeated_passages(read_table(spark, sf_dir, "documents"), window=50)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE["op11_substring_dedup"] = r"""
with d as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
  from documents
),
starts as (
  select doc_id, unnest(range(1, greatest(len(words) - 48, 1))) as i from d
),
hashed as (
  select s.doc_id, s.i, md5(array_to_string(d.words[s.i:s.i + 49], ' ')) as name
  from starts s join d using (doc_id)
),
gone as (
  select doc_id, i
  from (select *, min(doc_id) over (partition by name) as first from hashed)
  where first < doc_id
),
covered as (
  select doc_id, list_distinct(flatten(list(range(i, i + 50)))) as places from gone group by doc_id
),
kept as (
  select d.doc_id, len(d.words) as n_words, coalesce(len(c.places), 0) as n_removed,
         case when c.places is null then d.words
              else list_transform(list_sort(list_where(range(1, len(d.words) + 1),
                     list_transform(range(1, len(d.words) + 1), lambda k: not list_contains(c.places, k)))), lambda k: d.words[k])
         end as words
  from d left join covered c using (doc_id)
)
select doc_id, n_words, n_removed, sha256(array_to_string(words, ' ')) as kept_sha256 from kept
"""


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.vocabulary(read_table(spark, sf_dir, "documents")))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    number, label = F.col("vec_id"), F.col("label")
    noisy = F.when(number % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(
        read_table(spark, sf_dir, "embeddings"), label=noisy, anchor=number % 100 == 0
    )


ORACLE["op13_hard_negatives"] = r"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as ints
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
),
scored as (
  select a.vec_id as anchor_id, r.vec_id, r.label = a.label as same,
         list_inner_product(a.ints, r.ints)::bigint as score
  from v a join v r on a.vec_id <> r.vec_id
  where a.vec_id % 100 = 0
),
positive as (
  select anchor_id, vec_id as positive_id, score as positive_score
  from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.positive_id,
       row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id)::integer as rank,
       s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positive p join scored s on p.anchor_id = s.anchor_id
where not s.same and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) <= 10
"""
