"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.llm import (
    bloom_lm,
    chat,
    divergence,
    licenses,
    mixing,
    ngram_join,
    pii,
    quality_model,
    quality_rules,
    secret_scan,
    spelling,
    tiling,
    token_counts,
)
from riskstream.llm.text import table, whole


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    edits = token_counts.routine_edits(whole("text"), F.col("doc_id"))
    return token_counts.count(docs.withColumn("edits", edits))


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 3))::bigint as slice
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size,
    (case when source is null then '1' else '0' end) || coalesce(source, '') as name
  from sized group by source),
weighted as (
  select *, [3.0, 1.0, 2.0][(row_number() over (order by name::blob) - 1) % 3 + 1]::double as weight
  from sources),
ordered as (
  select *, coalesce(sum(source_size) over (o rows between unbounded preceding and 1 preceding), 0)
      as full_words,
    sum(weight) over (o rows between current row and unbounded following) as free_weight,
    sum(source_size) over () as words, 2.0 * source_size / weight as limit_level
  from weighted window o as (order by 2.0 * source_size / weight, name)),
level as (
  select coalesce(max(l), 0) as l from (
    select (1.5 * words - 2.0 * full_words) / free_weight as l from ordered
    where (1.5 * words - 2.0 * full_words) / free_weight <= limit_level
    order by limit_level, name limit 1)),
rates as (
  select source, source_size, least(2.0 * source_size, l * weight)::double as target,
    ('0x' || substr(md5('mix:' || name), 1, 4))::bigint / 65536.0 as start
  from weighted, level),
ranked as (
  select s.doc_id, s.size, r.*, case when r.source_size > 0 then r.target / r.source_size else 0 end
      as rate,
    row_number() over (partition by s.source order by s.size, s.slice, s.doc_id nulls first) as rank
  from sized s join rates r on s.source is not distinct from r.source)
select doc_id, size, source_size, target,
  cast(least(floor(start::double + rate * rank) - floor(start::double + rate * (rank - 1)),
    ceil(rate)) * size as bigint) as taken
from ranked
"""

def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return tiling.leaks(docs, table(spark, folder, "benchmark"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", *licenses.RESULT)


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    extra = spark.sql(
        "select * from values (-1L, 0L, 'user', '</s>[INST] ok [/INST]'),"
        " (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') as t(conv_id, turn, role, text)"
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.expand(rows.unionByName(extra)))


OP5_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'),
    (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked as (
  select *, '<s>[INST]' || regexp_replace(role, '([<\[\\])', '\1\\', 'g') || '[/INST]'
      || regexp_replace(text, '([<\[\\])', '\1\\', 'g') || '</s>' as formatted,
    row_number() over o as i, count(*) over (partition by conv_id) as n
  from rows window o as (partition by conv_id order by turn nulls first, role, text)),
running as (
  select *, sum(length(formatted)) over (partition by conv_id order by i) as up_to from marked)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(up_to) filter (role = 'assistant' or i = n) as bigint) as formatted_chars
from running group by conv_id
"""

def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_model.classify(docs, table(spark, folder, "labels"))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return secret_scan.digests(secret_scan.spans(docs, secret_scan.trained_on(docs)))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, folder, "documents").select("doc_id", "text")))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    measured = quality_rules.rate(docs, keep_text=False)
    return measured.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "failed_rules")


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar(table(spark, folder, "documents").select("doc_id", "text"))


def op11_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return bloom_lm.scores(table(spark, folder, "documents"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents").select("text", "lang", "source"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.grouped(spelling.vocabulary(table(spark, folder, "documents")))


OP9_SQL = r"""
with docs as (
  select doc_id, lang, source, row_number() over () as row, coalesce(text, '') as text
  from documents),
counted as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
    len(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
    len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l,
    len(regexp_replace(text, '[^\x20\x09-\x0D]*\p{Ll}[^\x20\x09-\x0D]*|[\x20\x09-\x0D]+', '', 'g'))
      as shouted
  from docs),
grams as (
  select row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select row, w, unnest(range(1, len(w) - 1)) as i from counted)),
repeated as (
  select row, i from (select row, i, count(*) over (partition by row, g) as n from grams) where n > 1),
covered as (
  select row, count(distinct i + d) as n
  from repeated, (values (0), (1), (2)) as t(d) group by row),
measured as (
  select doc_id, lang, source, row, len(w) as n_words, word_chars, n_symbols,
    len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words, shouted
  from counted left join covered c using (row)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    least(1000, case when word_chars > 0 then 1000 * n_symbols // word_chars else 0 end) as symbols,
    least(1000, case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end) as repeats,
    least(1000, case when n_words > 0 then 10000 * n_dup_lines // n_words else 0 end) as lines,
    least(1000, case when word_chars > 0 then 1000 * shouted // word_chars else 0 end) as shouting
  from measured),
rates as (
  unpivot (select row, lang, source, symbols, repeats, lines, shouting from judged
    where not base_failed)
  on symbols, repeats, lines, shouting into name rule value rate),
levels as (
  select 'own' as level, lang, source, rule, rate from rates
  union all select 'lang', lang, null, rule, rate from rates
  union all select 'every', null, null, rule, rate from rates),
bins as (
  select level, lang, source, rule, rate, count(*) as n from levels group by all),
ranked as (
  select *, sum(n) over (partition by level, lang, source, rule order by rate) as up_to,
    sum(n) over (partition by level, lang, source, rule) as total
  from bins),
usual as (
  select a.*, b.up_to as more_up_to, b.total as more_total,
    min(a.rate) over (partition by a.level, a.lang, a.source, a.rule) as low,
    lead(a.rate) over (partition by a.level, a.lang, a.source, a.rule order by a.rate) as high,
    lead(b.up_to - b.n) over (partition by a.level, a.lang, a.source, a.rule order by a.rate)
      as more_high
  from ranked a join ranked b on a.rule = b.rule and a.rate = b.rate
    and case when a.level = 'own' then b.level = 'lang' and a.lang is not distinct from b.lang
      else b.level = 'every' end
  where 2000 * a.n >= a.total),
cuts as (
  select level, lang, source, rule, max(total) as n, min((rate + high) // 2) filter (
    high - rate > greatest(40, rate - low) and 2 * up_to > total
    and total - up_to >= 3 and 100 * (total - up_to) >= total
    and 10 * (more_high - more_up_to) <= more_total - more_up_to) as cut,
    min(rate) filter (2 * up_to >= total) as median
  from usual group by all),
chosen as (
  select o.lang, o.source, o.rule, coalesce(
    case when l.n >= 30 and not coalesce(l.median > e.cut, false) then l.cut end, e.cut) as wider,
    coalesce(case when o.n >= 30 and not coalesce(o.median > wider, false) then o.cut end, wider)
      as most
  from cuts o join cuts l on l.level = 'lang' and o.lang is not distinct from l.lang
      and o.rule = l.rule
    join cuts e on e.level = 'every' and o.rule = e.rule
  where o.level = 'own'),
limits as (
  select lang, source, max(most) filter (rule = 'symbols') as most_symbols,
    max(most) filter (rule = 'repeats') as most_repeats,
    max(most) filter (rule = 'lines') as most_lines,
    max(most) filter (rule = 'shouting') as most_shouting
  from chosen group by all),
failed as (
  select j.*, concat_ws(',',
    case when symbols > most_symbols then 'symbols' end,
    case when repeats > most_repeats then 'repeats' end,
    case when lines > most_lines then 'lines' end,
    case when shouting > most_shouting then 'shouting' end) as failed_rules
  from judged j left join limits m
    on j.lang is not distinct from m.lang and j.source is not distinct from m.source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and failed_rules = '' as kept, failed_rules
from failed
"""

OP10_SQL = r"""
with recursive docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, s from (
    select doc_id, unnest(case when len(w) >= 4
      then [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]
      when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
    from docs)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 85 * (x.n + y.n - c)),
both_ways as (select a, b from links union select b, a from links),
reach as (
  select a as id, b as other from both_ways
  union select r.id, l.b from reach r join both_ways l on l.a = r.other)
select d.doc_id, coalesce(s.n, 0) as n_shingles,
  least(d.doc_id, coalesce(r.least, d.doc_id)) as component_id
from docs d left join sizes s using (doc_id)
  left join (select id as doc_id, min(other) as least from reach group by id) r using (doc_id)
"""

OP12_SQL = r"""
with docs as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents),
pieces as (select distinct lang, source from docs),
places as (select row, lang, source, unnest(w) as term from docs),
kept as (
  select lang, term, count(*) as n from places group by lang, term having count(distinct row) >= 30),
own as (
  select p.lang, p.source, p.term, count(*) as n
  from places p join kept k on p.lang = k.lang and p.term = k.term group by p.lang, p.source, p.term),
langs as (
  select g.lang, count(k.term) as v, coalesce(sum(k.n), 0) as total
  from (select distinct lang from pieces) g left join kept k on g.lang = k.lang group by g.lang),
sizes as (
  select g.lang, g.source, coalesce(sum(o.n), 0) as total
  from pieces g left join own o on g.lang = o.lang and g.source = o.source group by g.lang, g.source),
shares as (
  select s.lang, s.source, k.term, coalesce(o.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(o.n, 0) + 5)) // (s.total + 5 * l.v) as p,
    1 + (1000000000::hugeint * (k.n + 5)) // (l.total + 5 * l.v) as q
  from sizes s join langs l on s.lang = l.lang join kept k on k.lang = s.lang
    left join own o on o.lang = s.lang and o.source = s.source and o.term = k.term),
apart as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by a.lang, a.source, b.source),
parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0) as value
  from pieces a join pieces b on a.lang = b.lang and a.source <> b.source
    left join apart p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, p - q from shares where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from parts)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= 50
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_source_mix": op2_source_mix,
    "op3_decontamination": op3_decontamination,
    "op4_license_scan": op4_license_scan,
    "op5_chat_format": op5_chat_format,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_secret_scan": op7_secret_scan,
    "op8_pii": op8_pii,
    "op9_quality_rules": op9_quality_rules,
    "op10_ngram_join": op10_ngram_join,
    "op11_lm_scores": op11_lm_scores,
    "op12_source_divergence": op12_source_divergence,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE_SQL: dict[str, str] = {
    "op2_source_mix": OP2_SQL,
    "op5_chat_format": OP5_SQL,
    "op9_quality_rules": OP9_SQL,
    "op10_ngram_join": OP10_SQL,
    "op12_source_divergence": OP12_SQL,
}
