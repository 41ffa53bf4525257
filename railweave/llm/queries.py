"""The registered queries of the text operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railweave.llm import (
    ann,
    collocations,
    exact_dedup,
    hard_negatives,
    html_diff,
    language,
    license_scan,
    mixing,
    near_dedup,
    packing,
    pii,
    toxicity,
    url_filter,
)
from railweave.llm.text import host_of, path_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

#: Host labels whose pages the url list of op2 names.
LISTED_LABELS = ("casino-win", "free-bets", "cheap-pills", "ads-track", "spam-farm", "adult-x")


def query(function: Callable) -> Callable:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_html_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_diff.main_texts(table(spark, sf_dir, "pages"), skip_copies=True)


def listed_urls(pages: DataFrame) -> DataFrame:
    """Canonical urls of the pages of listed hosts."""
    host = host_of(F.col("url"))
    listed = F.exists(F.split(host, r"\."), lambda label: label.isin(*LISTED_LABELS))
    return pages.where(listed).select(url_filter.canonical(host, path_of(F.col("url"))).alias("url"))


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, listed_urls(pages))


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def labelled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good documents weigh 2, bad ones 0.5; those without a label 1."""
    weight = F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5)
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), weight.alias("quality"))


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"), quality=labelled_quality(spark, sf_dir))
    return plan.select(
        F.col("id_").alias("doc_id"),
        F.col("source_").alias("source"),
        F.col("size_").alias("size"),
        F.col("source_size_").cast("long").alias("source_size"),
        F.col("target_").alias("target"),
        F.col("taken_").cast("long").alias("taken"),
    )


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_report(table(spark, sf_dir, "documents"))


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = language.identify(language.document_evidence(table(spark, sf_dir, "documents")))
    return judged.select(
        F.col("id_").alias("doc_id"),
        F.col("language_").alias("language"),
        F.round("confidence_", 6).alias("confidence"),
        F.col("text_language_").alias("text_language"),
        F.col("kept_").alias("kept"),
    )


@query
def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over pages, which declare languages and have addresses."""
    judged = language.identify(language.page_evidence(table(spark, sf_dir, "pages")))
    return judged.select(
        F.col("id_").alias("page_id"),
        F.col("language_").alias("language"),
        F.round("confidence_", 6).alias("confidence"),
        F.col("text_language_").alias("text_language"),
        F.col("kept_").alias("kept"),
    )


@query
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "n_matches")


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

CHECKS["op2_url_filter"] = f"""
with parts as (
    select page_id, {_LOWER.format(r"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} as host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
    from pages),
canonical as (
    select *, case when host <> '' then regexp_replace(host, '^(?:www|m)[.]', '')
        || regexp_replace(path, '(?:[.]html|/)$', '') end as form
    from parts),
listed as (
    select distinct form from canonical
    where len(list_intersect(string_split(host, '.'), {list(LISTED_LABELS)})) > 0),
rules (h, p, v) as (values {", ".join(str(rule) for rule in url_filter.RULES)}),
ruled as (
    select c.*, (select h || p from rules where (c.host = h or c.host like '%.' || h) and starts_with(c.path, p)
                 order by length(h || p) desc limit 1) as rule
    from canonical c)
select page_id, host, path, rule,
       coalesce((select v from rules where h || p = r.rule),
                case when form in (select form from listed) then 'block' else 'allow' end) as verdict,
       rule is null and form is not null and form in (select form from listed) as listed
from ruled r"""

CHECKS["op4_source_mix"] = r"""
with quality as (select doc_id, max(case quality when 1 then 2.0 when 0 then 0.5 end) as q from labels group by doc_id),
sized as (
    select d.doc_id, d.source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
           -ln((('0x' || substr(md5(d.doc_id::varchar), 1, 13))::bigint + 0.5) / 4503599627370496) / coalesce(q, 1.0) as k
    from documents d left join quality using (doc_id)),
sources as (
    select *, [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as w
    from (select source, sum(size)::double as source_size from sized group by source)),
levels as (
    select *, (1.5 * sum(source_size) over () - coalesce(sum(2 * source_size) over below, 0))
              / (sum(w) over () - coalesce(sum(w) over below, 0)) as level, 2 * source_size / w as ratio
    from sources
    window below as (order by 2 * source_size / w, source nulls last rows between unbounded preceding and 1 preceding)),
targets as (
    select source, source_size, round(least(2 * source_size,
           coalesce(max(case when level <= ratio then level end) over (), 'infinity'::double) * w), 6) as target
    from levels),
placed as (
    select s.*, source_size, target,
           case when source_size > 0 then floor(target / source_size) else 0 end as epochs,
           sum(size) over (partition by s.source order by k, doc_id rows unbounded preceding) as through
    from sized s join targets t on s.source is not distinct from t.source),
budgeted as (select *, target - epochs * source_size as budget from placed),
remaining as (
    select source, max(budget) - max(case when through <= budget then through else 0 end) as rest from budgeted group by source),
extra as (
    select b.source, arg_min(doc_id, {'m': abs(size - rest), 'k': k, 'i': doc_id}) as best
    from budgeted b join remaining r on b.source is not distinct from r.source
    where through > budget and size > 0 and abs(size - rest) < rest group by b.source)
select b.doc_id, b.source, size, source_size::bigint as source_size, target,
       (size * (epochs + case when through <= budget or doc_id = best then 1 else 0 end))::bigint as taken
from budgeted b left join extra e on b.source is not distinct from e.source"""

CHECKS["op6_exact_dedup"] = f"""
with normal as (select doc_id, sha256({_LOWER.format("coalesce(text, '')")}) as text_sha256 from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, text_sha256
from normal window same as (partition by text_sha256)"""

CHECKS["op9_near_dedup"] = f"""
with recursive words as (
    select doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} as w from documents),
shingles as (
    select distinct doc_id, s from (
        select doc_id, unnest(case when len(w) >= 5
            then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
            when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
    select a.doc_id as a, b.doc_id as b, count(*) as c
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
    select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * c >= 75 * (x.n + y.n - c)),
both_ways as (select a, b from links union select b, a from links),
reach as (
    select a as doc_id, b as seen from both_ways
    union select r.doc_id, l.b from reach r join both_ways l on l.a = r.seen)
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id,
       least(doc_id, coalesce(low, doc_id)) = doc_id as kept
from words left join sizes using (doc_id)
left join (select doc_id, min(seen) as low from reach group by doc_id) using (doc_id)"""

_PHRASES = " union all ".join(
    f"""select lang, {k} as k, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i : i + {k - 1}], ' '))) as p
    from pieces where len(w) >= {k}"""
    for k in range(1, 5)
)
CHECKS["op12_collocations"] = rf"""
with pieces as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from (
        select coalesce(lang, 'und') as lang,
               unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as piece
        from documents)),
words as (select lang, sum(len(w))::bigint as n from pieces group by lang),
frequent as (select lang, k, p, count(*) as f from ({_PHRASES}) group by lang, k, p having count(*) >= 30),
split as (select lang, k, p, f as a, string_split(p, ' ') as w from frequent where k >= 2),
inside as (
    select lang, p, max(f) as around from (
        select lang, a as f, unnest(case k
            when 3 then [array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]
            when 4 then [array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' '), array_to_string(w[3:4], ' '),
                         array_to_string(w[1:3], ' '), array_to_string(w[2:4], ' ')] else [] end) as p from split)
    group by lang, p),
alone as (
    select s.* from split s left join inside i on i.lang = s.lang and i.p = s.p
    where i.around is null or 100 * i.around::hugeint < 80 * s.a::hugeint),
cuts as (select *, unnest(range(1, k)) as c from alone),
scored as (
    select c.lang, c.p, c.a, h.f as l, t.f as r, c.c, (2000000 * c.a::hugeint) // (h.f::hugeint + t.f) as score
    from cuts c join frequent h on h.lang = c.lang and h.p = array_to_string(c.w[1 : c.c], ' ')
    join frequent t on t.lang = c.lang and t.p = array_to_string(c.w[c.c + 1 :], ' ')),
weakest as (select * from scored qualify row_number() over (partition by lang, p order by score, c) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, p) as rank from weakest)
select r.lang, r.rank, r.p as phrase, r.a, r.l, r.r, n, r.score::bigint as score
from ranked r join words using (lang) where r.rank <= 2000"""

CHECKS["op13_hard_negatives"] = """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and label is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
    select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
    from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)),
positives as (
    select * from pairs where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, p.id as positive_id,
       row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id)::int as rank,
       n.id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
     and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
qualify rank <= 5"""
