"""One query for each operator, with production parameters over whole tables, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import table
from sluice.llm.decontaminate import contaminated
from sluice.llm.embedding_dedup import near_vectors
from sluice.llm.exact_dedup import exact_dedup
from sluice.llm.lm_score import score_texts
from sluice.llm.packing import pack_documents
from sluice.llm.periodic_runs import periodic_runs
from sluice.llm.phrases import collocations
from sluice.llm.pii import personal_data
from sluice.llm.quality import classify
from sluice.llm.secret_scan import scan
from sluice.llm.simhash import near_dedup
from sluice.llm.spans import repeated_spans
from sluice.llm.url_filter import filter_urls, host_of


#: The tables have neither fetch times nor lists.  Times follow from page ids; a third of the hosts
#: are listed, lifted and half of these listed again, a fifth of the domains and a quarter of the first
#: path segments are listed once.
_ENTRIES = """
with hosts as (
  select host, min(page_id) as m from seen where host <> '' group by host
), segments as (select host, segment, min(page_id) as m from seen where host <> '' and segment <> '' group by host, segment)
select 'hosts' as list_name, 'host' as kind, host as value, 'block' as action, m % 200 as day from hosts where m % 3 = 0
union all select 'hosts', 'host', host, 'lift', m % 200 + 60 from hosts where m % 3 = 0
union all select 'hosts', 'host', host, 'block', m % 200 + 120 from hosts where m % 6 = 0
union all select 'domains', 'domain', substring(host, instr(host, '.') + 1), 'block', m % 300 from hosts where m % 5 = 0
union all select 'paths', 'prefix', concat(host, '/', segment), 'block', m * 13 % 365 from segments where m % 4 = 0
"""


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    begin = F.lit("2024-01-01").cast("timestamp_ntz")
    day, hour = F.col("page_id") * 7919 % 365, F.col("page_id") % 24
    captures = pages.withColumn("fetched_at", begin + F.make_dt_interval(day.cast("int"), hour.cast("int")))
    segment = F.regexp_extract("url", "^[a-z]+://[^/?#]*/([^/?#]+)", 1)
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"), segment.alias("segment"))
    entries = spark.sql(_ENTRIES.replace("from seen", "from {seen}"), seen=seen)
    entries = entries.withColumn("effective_at", begin + F.make_dt_interval(F.col("day").cast("int")))
    shown = "yyyy-MM-dd HH:mm:ss"
    return filter_urls(spark, captures, entries).select(
        "page_id",
        "url",
        F.date_format("fetched_at", shown).alias("fetched_at"),
        F.col("verdict").isNotNull().alias("blocked"),
        "verdict.list_name",
        "verdict.kind",
        "verdict.value",
        F.date_format("verdict.since", shown).alias("since"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(spark, table(spark, sf_dir, "documents"), growing=True)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(spark, table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(spark, table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The tables have no labelled findings.  What a quoted assignment to a secret's name holds
    # is labelled a secret, what is all digits is labelled none, and the rest is left to the forest.
    before = F.concat_ws(" ", "before")
    label = F.when(before.rlike(r"(token|secret|password|key)\s*[=:]$") & F.col("word").startswith('"'), 1).when(
        F.col("candidate").rlike("^[0-9]+$"), 0
    )
    return scan(spark, table(spark, sf_dir, "documents"), label)


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark, table(spark, sf_dir, "embeddings"))


#: Every tenth document by the hash of its id is made periodic from some word on, so that there are runs to find.
_REPEATED = r"""
with t as (
  select doc_id, text, crc32(cast(doc_id as string)) as h,
    filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), w -> w <> '') as w
  from {docs}
), n as (select *, greatest(size(w), 1) as n, h div 10 as g from t
), p as (select *, g % n as a, 1 + (n - g % n) div (3 + g % 8) as p from n
)
select doc_id, case when h % 10 = 0 and size(w) > 0
  then array_join(transform(w, (x, i) -> case when i < a then x else w[int(a + (i - a) % p)] end), ' ')
  else text end as text
from p
"""


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(spark, spark.sql(_REPEATED, docs=docs))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("back"), (-r.period).alias("short"))))
    top = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    period = -F.col("top.short")
    return top.select(
        "doc_id", "n_runs", (-F.col("top.back")).alias("start"), "top.length", period.alias("period"),
        F.floor(F.col("top.length") * 1000 / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark, table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_exact_dedup, op3_quality, op4_decontaminate, op5_spans,
        op6_simhash, op7_packing, op8_pii, op9_lm_score, op10_secrets,
        op11_embedding_dedup, op12_periodic_runs, op13_phrases, pipeline,
    )
}

_EQUAL_TEXTS = r"""
with t as (
  select doc_id, coalesce(text, '') as text, regexp_replace(coalesce(text, ''), '[ \t-\r]', '', 'g') as norm
  from documents
)
select doc_id,
  first_value(doc_id) over w as keep_id,
  count(*) over (partition by norm) as group_size,
  row_number() over w = 1 as kept,
  sha256(norm) as text_sha256
from t
window w as (partition by norm order by length(text) desc, doc_id)
"""

_LEAKS = r"""
with d as (
  select doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from documents
), b as (
  select item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from benchmark
), ds as (
  select distinct doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) as s from d
), bs as (
  select distinct item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) as s from b
), n as (select item_id, count(*) as item_shingles from bs group by 1)
select doc_id, item_id, count(*) as matched, any_value(item_shingles) as item_shingles,
  count(*) / any_value(item_shingles) as containment
from ds join bs using (s) join n using (item_id)
group by doc_id, item_id
having count(*) * 10 >= any_value(item_shingles) * 8
"""

_LISTED = r"""
with seen as (
  select page_id, rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:@]*)', 1)), '.') as host,
    regexp_extract(url, '^[a-z]+://[^/?#]*/([^/?#]+)', 1) as segment
  from pages
), entries as (
""" + _ENTRIES + r"""
), dated as (
  select list_name, kind, value, day, max(action = 'block') as block from entries group by all
), intervals as (
  select *, lead(day) over (partition by list_name, kind, value order by day) as until from dated
), captures as (
  select p.page_id, p.url, s.host, p.page_id * 7919 % 365 * 24 + p.page_id % 24 as hour,
    s.host || regexp_extract(p.url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) as place
  from pages p join seen s using (page_id)
), hits as (
  select page_id, list_name, kind, value, day from captures c join intervals i
  on block and hour >= day * 24 and (until is null or hour < until * 24)
    and (kind = 'host' and host = value
      or kind = 'domain' and (host = value or ends_with(host, '.' || value))
      or kind = 'prefix' and (place = value or starts_with(place, value || '/')))
), best as (
  select *, row_number() over (partition by page_id order by
    case kind when 'prefix' then 3 when 'host' then 2 else 1 end desc, length(value) desc, list_name desc) as nth
  from hits
)
select c.page_id, url, strftime(timestamp '2024-01-01' + to_hours(hour), '%Y-%m-%d %H:%M:%S') as fetched_at,
  nth is not null as blocked, list_name, kind, value,
  strftime(timestamp '2024-01-01' + to_days(day::int), '%Y-%m-%d %H:%M:%S') as since
from captures c left join best b on c.page_id = b.page_id and nth = 1
"""

_PHRASES = r"""
with w as (
  select lang, piece, list_filter(string_split_regex(p, '[ \t]+'), lambda x: x <> '') as w from (
    select coalesce(lang, 'und') as lang, row_number() over () as piece,
      unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) as p
    from documents)
), n as (select lang, sum(len(w))::bigint as n from w group by 1
), grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) as phrase
  from w, (select unnest([1, 2, 3]) as k) where len(w) >= k
), f as (select lang, k, phrase, count(*) as a from grams group by all having count(*) >= 10
), cuts as (
  select f.lang, f.phrase, f.k as words, f.a, c.k,
    array_to_string(string_split(f.phrase, ' ')[1:c.k], ' ') as one, array_to_string(string_split(f.phrase, ' ')[c.k+1:], ' ') as two
  from f, (select unnest([1, 2]) as k) c where f.k > 1 and c.k < f.k
), scored as (
  select cuts.lang, cuts.phrase, cuts.a, cuts.k, l.a as l, r.a as r,
    (1000000::hugeint * cuts.a * cuts.a // (l.a::hugeint * r.a))::bigint as score
  from cuts join f l on l.lang = cuts.lang and l.phrase = one join f r on r.lang = cuts.lang and r.phrase = two
), weakest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_pairs as (
  select lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) as phrase
  from f where k = 3
), longer as (select lang, phrase, max(a) as most from inner_pairs group by all
), kept as (
  select w.* from weakest w left join longer g on w.lang = g.lang and w.phrase = g.phrase
  where g.most is null or 100 * g.most < 50 * w.a
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept
)
select lang, rank, phrase, a, l, r, n, score from ranked join n using (lang) where rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_url_filter": _LISTED,
    "op2_exact_dedup": _EQUAL_TEXTS,
    "op4_decontaminate": _LEAKS,
    "op13_phrases": _PHRASES,
}
