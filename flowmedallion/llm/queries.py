"""The package's registered queries, each over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmedallion.llm import divergence, licenses, pitman_yor, sketches
from flowmedallion.llm.decontaminate import contained_items
from flowmedallion.llm.html_text import learn_weights, with_main_text
from flowmedallion.llm.language import held_out, learn_languages, with_languages
from flowmedallion.llm.pieces import encode_texts
from flowmedallion.llm.quality import BASE, fit_rules, judge
from flowmedallion.llm.runs import with_runs
from flowmedallion.llm.sharding import shard_rows
from flowmedallion.llm.simhash import near_duplicate_classes
from flowmedallion.llm.sketches import let
from flowmedallion.llm.url_rules import judge_urls, page_links
from flowmedallion.llm.registry import QUERIES, SQL, query, table  # noqa: F401


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, piece_model()).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit_rules(docs, table(spark, sf_dir, "labels"))
    return judge(docs, rules).select("doc_id", *BASE, "base_failed", "kept", "rule")


@query("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicate_classes(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn_languages(docs.filter(~held_out() & F.col("doc_id").isNotNull()))
    return with_languages(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "langs"
    )


OP7_SQL = r"""
with d as (
  select distinct doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') as w from documents
), i as (
  select item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') as w from benchmark
), sizes as (
  select distinct least(len(w), 5) as k from i where len(w) > 0
), ds as (
  select distinct doc_id, array_to_string(w[p:p+k-1], ' ') as s from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as p from d, sizes)
), js as (
  select distinct item_id, array_to_string(w[p:p+4], ' ') as s
  from (select item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as p from i where len(w) > 0)
), n as (select item_id, count(*) as n_shingles from js group by 1)
select doc_id, item_id, n_shingles, count(*) as n_found, count(*) / n_shingles as containment
from js join ds using (s) join n using (item_id)
group by doc_id, item_id, n_shingles having 10 * count(*) >= 8 * n_shingles
"""


@query("op7_benchmark_decontamination", OP7_SQL)
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contained_items(docs, table(spark, sf_dir, "benchmark"), short_items=True).drop("key")


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_rows(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op4_pitman_yor_score")
def op4_pitman_yor_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pitman_yor.held_out()
    model = pitman_yor.fit(docs.filter(~out & F.col("doc_id").isNotNull()).select("text"))
    return pitman_yor.score(docs, model, [F.col("doc_id"), out.alias("held_out")])


@query("op3_html_extraction")
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = with_main_text(pages, learn_weights(pages)).drop("html")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]

OP9_SQL = r"""
with recursive rules(told, rule_host, rule_path) as (
  values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), found as (
  select page_id, url,
    regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) as canonical,
    regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1) as refresh,
    translate(regexp_extract(url, '^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as site,
    regexp_extract(url, '^(.*?)://', 1) as scheme, regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1) as place
  from pages
), links as (
  select url, case when l like '%://%' then l when l like '//%' then scheme || ':' || l when l like '/%' then scheme || '://' || site || l
    else scheme || '://' || site || case when place like '/%' then regexp_replace(place, '[^/]*$', '') else '/' end || l end as target
  from (select url, scheme, site, place, replace(unnest([canonical, refresh]), '&amp;', '&') as l from found) where l <> ''
), addresses as (
  select url, translate(regexp_extract(url, '^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1) as path, regexp_extract(url, '^.*?://[^/?#]*([^#]*)', 1) as rest
  from (select url from pages union select target from links)
), nodes as (
  select url, host, path, case when host <> '' then host || case when rest like '/%' then '' else '/' end || rest end as node,
    (select arg_max(struct_pack(rule := rule_host || rule_path, told := told), length(rule_host || rule_path)) from rules
     where (host = rule_host or host like '%.' || rule_host) and starts_with(path, rule_path)) as r
  from addresses
), ties as (
  select a.node as a, b.node as b from links join nodes a on links.url = a.url join nodes b on links.target = b.url
  where a.node is not null and b.node is not null
), reach(a, b) as (
  select node, node from nodes where node is not null
  union
  select reach.a, t.b from reach join (select a, b from ties union select b, a from ties) t on reach.b = t.a
), shared as (
  select a as node, min(r.told) as told from reach join nodes on reach.b = nodes.node where r is not null group by 1
)
select page_id, coalesce(n.host, '') as host, coalesce(n.path, '') as path, n.r.rule as rule, coalesce(n.r.told, shared.told, 'allow') as verdict
from pages left join nodes n on pages.url = n.url left join shared on n.node = shared.node
"""


@query("op9_url_filters", OP9_SQL)
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, page_links(pages), URL_RULES)


@query("op8_license_scan", licenses.scan_sql())
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents, of which every tenth (by its id's checksum) has a repetition laid into it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    draw = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    place = F.floor(draw / 10).cast("long")

    def laid(words: Column) -> Column:
        n = F.size(words).cast("long")
        start = F.pmod(place, n)
        period = 1 + F.floor((n - start) / (3 + F.pmod(place, F.lit(8)))).cast("long")
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < start, i).otherwise(start + F.pmod(i - start, period)))
        return F.when(n > 0, F.array_join(F.transform(at, lambda i: F.get(words, i.cast("int"))), " ")).otherwise("")

    changed = let(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""), laid)
    texts = docs.select("doc_id", F.when(F.pmod(draw, F.lit(10)) == 0, changed).otherwise(F.col("text")).alias("text"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return (
        with_runs(texts)
        .withColumn("best", best)
        .select(
            "doc_id", F.size("runs").cast("long").alias("n_runs"),
            (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
            F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
            F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
        )
    )


OP12_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as text from documents
), o as (
  select doc_id, text, coalesce(lead(text) over (order by doc_id, text), first(text) over (order by doc_id, text)) as behind
  from d where doc_id is not null
  union all select doc_id, text, null from d where doc_id is null
), e as (
  select row_number() over () as nr, doc_id, text, behind,
    substring(text, 1, length(text) - length(text) // 4) || coalesce(substring(behind, 1, length(text) // 4), '') as edited from o
), words as (
  select nr, kind, list_filter(regexp_split_to_array(lower(t), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from (select nr, unnest(['own', 'next', 'edited']) as kind, unnest([text, behind, edited]) as t from e) where t is not null
), hashes as (
  select distinct nr, kind, left(md5(array_to_string(w[p:p+4], ' ')), 12) as h
  from (select nr, kind, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as p from words where len(w) > 0)
), ranked as (
  select nr, kind, h, row_number() over (partition by nr, kind order by h) as r from hashes
), sketches as (
  select nr, kind, string_agg(h, '' order by h) as print, count(*) as n, max(h) as last from ranked where r <= 128 group by nr, kind
), unions as (
  select nr, 'edited' as other, h, count(*) as n from ranked where r <= 128 and kind in ('own', 'edited') group by nr, h
  union all
  select nr, 'next', h, count(*) from ranked where r <= 128 and kind in ('own', 'next') group by nr, h
), near as (
  select nr, other, count(*) filter (n = 2) / count(*) as near
  from (select *, row_number() over (partition by nr, other order by h) as r from unions) where r <= 128 group by nr, other
), low as (
  select r.nr, count(*) as n, count(*) filter (exists (select 1 from ranked x where x.nr = r.nr and x.kind = 'edited' and x.h = r.h and x.r <= 128)) as found
  from ranked r left join (select nr, case when n < 128 then 'g' else last end as bound from sketches where kind = 'edited') b on r.nr = b.nr
  where r.kind = 'own' and r.r <= 128 and r.h <= coalesce(b.bound, 'g')
    and r.h <= (select case when n < 128 then 'g' else last end from sketches s where s.nr = r.nr and s.kind = 'own') group by r.nr
)
select e.doc_id, length(e.text) as n_chars, sha256(e.edited) as edited_sha256,
  coalesce(own.print, '') as fingerprint, coalesce(ed.print, '') as edited_fingerprint,
  coalesce(ne.near, 1.0)::double as near_edited, case when e.behind is null then null else coalesce(nn.near, 1.0) end::double as near_next,
  case when own.n is null then 1.0 else coalesce(low.found / low.n, 0.0) end::double as kept_share,
  (coalesce(own.n, 0) < 128) as whole
from e left join sketches own on own.nr = e.nr and own.kind = 'own' left join sketches ed on ed.nr = e.nr and ed.kind = 'edited'
left join near ne on ne.nr = e.nr and ne.other = 'edited' left join near nn on nn.nr = e.nr and nn.other = 'next'
left join low on low.nr = e.nr
"""


@query("op12_document_fingerprints", OP12_SQL)
def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketches.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
    own, changed, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return found.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketches.printed(own).alias("fingerprint"), sketches.printed(changed).alias("edited_fingerprint"),
        sketches.resemblance(own, changed).alias("near_edited"),
        F.when(following.isNotNull(), sketches.resemblance(own, following)).alias("near_next"),
        sketches.containment(own, changed).alias("kept_share"), (F.size(own) < sketches.KEPT).alias("whole"),
    )


OP13_SQL = r"""
with d as (
  select row_number() over () as nr, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents
), t as (
  select nr, lang, source, unnest(w) as term from d
), kept as (
  select lang, term, count(*) as c from t group by lang, term having count(distinct nr) >= 30
), langs as (
  select lang, count(*) as v, sum(c)::bigint as n from kept group by lang
), pools as (
  select distinct lang, source from d
), counts as (
  select lang, source, term, count(*) as c from t group by all
), cells as (
  select g.lang, g.source, k.term, coalesce(c.c, 0) as c, k.c as lang_c from pools g join kept k using (lang)
  left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), sizes as (
  select lang, source, sum(c)::bigint as n from cells group by all
), p as (
  select lang, source, term, c, (1 + 1000000000 * (c + 5)::hugeint // (s.n + 5 * l.v))::bigint as p,
    (1 + 1000000000 * (lang_c + 5)::hugeint // (l.n + 5 * l.v))::bigint as q
  from cells join sizes s using (lang, source) join langs l using (lang)
), parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0) as value
  from pools a join pools b on a.lang = b.lang and a.source <> b.source
  left join (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p))::bigint as value
             from p a join p b on a.lang = b.lang and a.term = b.term group by all) x
    on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all
  select lang, source, 'term', term, p - q from p where c > 0 and p > q
), ranked as (
  select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from parts
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
"""


@query("op13_source_divergence", OP13_SQL)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))
