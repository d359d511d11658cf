"""The registered queries of the subpackage: name -> (function of session and data folder, checking SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotstats.llm import bands, boilerplate, centroids, decontaminate, language, licences, lines, mixing, ngram_join, quality, redirects, strata, weighting
from plotstats.llm import pipeline as stages
from plotstats.llm.text import remainder

RULES = [
    redirects.Rule("allow", "org", "/"),
    redirects.Rule("block", "example.org", "/es/"),
    redirects.Rule("block", "example.org", "/en/1"),
    redirects.Rule("allow", "com", "/fr/"),
    redirects.Rule("block", "com", "/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(table(spark, sf_dir, "documents"), "doc_id", "text", n=4, percent=85)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    learn = known.where(remainder(F.col("doc_id"), 4) != 2)
    model = quality.fit(docs, learn, "doc_id", "text", "quality")
    out = quality.score(docs, model, "doc_id", "text")
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    out = weighting.score(docs, ~held, "doc_id", "text")
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.judge(table(spark, sf_dir, "documents"), "doc_id", "text")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(table(spark, sf_dir, "documents"), "doc_id", "text", least_exact=1)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.judge(table(spark, sf_dir, "pages"), RULES, "page_id", "url", "html")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"), "doc_id", "text", "source")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    model = language.fit(docs.where(~held), "doc_id", "text", "lang")
    return language.identify(docs, model, "doc_id", "text").select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), "doc_id", "text")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strata.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.main_text(table(spark, sf_dir, "pages"), "page_id", "url", "html")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.run(spark, sf_dir)


LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
with recursive words as (
  select doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') as w from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) end as s from words
), columns_ as (
  select doc_id, len(s) as n, unnest(s) as c from sets
), shared as (
  select a.doc_id as x, b.doc_id as y, any_value(a.n) as na, any_value(b.n) as nb, count(*) as both_
  from columns_ a join columns_ b on a.c = b.c and a.doc_id < b.doc_id group by all
), links as (
  select x, y from shared where 100 * both_ >= 85 * (na + nb - both_)
), both_ways as (
  select x, y from links union select y, x from links
), reach as (
  select doc_id as x, doc_id as y from documents
  union
  select r.x, l.y from reach r join both_ways l on l.x = r.y
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, g.component_id
from sets s join (select x, min(y) as component_id from reach group by x) g on g.x = s.doc_id
"""

PAGE_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"


def _fits(host: str, path: str) -> str:
    whens = []
    for rule in sorted(RULES, key=lambda r: (-len(r.text), r.verdict)):
        whens.append(f"when ({host} = '{rule.host}' or ends_with({host}, '.{rule.host}')) and starts_with({path}, '{rule.path}') then ['{rule.text}', '{rule.verdict}']")
    return "case " + " ".join(whens) + " else null end"


_ROOT = "(?s)^(.*?://[^/?#]*)"


def _dotless_sql(url: str) -> str:
    path = f"regexp_extract({url}, '{PAGE_PARTS}', 2)"
    steps = f"string_split({path}[2:], '/')"
    taken = (
        f"list_reduce(list_prepend('', {steps}), lambda p, s: case s when '.' then p when '..' then regexp_replace(p, '/[^/]*$', '') else p || '/' || s end)"
        f" || case when {steps}[-1] in ('.', '..') then '/' else '' end"
    )
    return (
        f"case when regexp_matches({path}, '/\\.\\.?(/|$)') then regexp_extract({url}, '{_ROOT}', 1) || {taken}"
        f" || regexp_extract({url}, '(?s)^.*?://[^?#]*(.*)$', 1) else {url} end"
    )


def _resolved_sql(url: str, link: str) -> str:
    path = f"regexp_extract({url}, '{PAGE_PARTS}', 2)"
    return f"""case
    when regexp_matches({link}, '^[A-Za-z][A-Za-z0-9+.-]*:') then {link}
    when starts_with({link}, '//') then regexp_extract({url}, '(?s)^(.*?:)//', 1) || {link}
    when starts_with({link}, '/') then regexp_extract({url}, '{_ROOT}', 1) || {link}
    when starts_with({link}, '?') then regexp_extract({url}, '{_ROOT}', 1) || {path} || {link}
    when starts_with({link}, '#') then regexp_extract({url}, '(?s)^([^#]*)', 1) || {link}
    else regexp_extract({url}, '{_ROOT}', 1) || coalesce(nullif(regexp_extract({path}, '(?s)^(.*/)', 1), ''), '/') || {link} end"""


_AND = "'(?i)&(?:amp|#0*38|#x0*26);', '&', 'g'"

OP6_SQL = f"""
with recursive shown as (
  select url, regexp_replace(html, '(?s)<!--.*?-->', '', 'g') as html from pages where contains(url, '://')
), based as (
  select url, html, regexp_replace(regexp_extract(html, '(?is)<base\\b[^>]*\\bhref\\s*=\\s*["'']?\\s*([^"''\\s>]+)', 1), {_AND}) as href from shown
), rooted as (
  select url, html, case when href <> '' then {_resolved_sql("url", "href")} else url end as base from based
), tags as (
  select url, {_dotless_sql("base")} as base, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) as tag from rooted
), targets as (
  select url, base, regexp_replace(regexp_extract(tag, '(?is)\\bhref\\s*=\\s*["'']?\\s*([^"''\\s>]+)', 1), {_AND}) as link from tags
  where regexp_matches(tag, '(?is)^<link\\b.*\\brel\\s*=\\s*["'']?\\s*canonical\\b')
  union all
  select url, base, regexp_replace(regexp_extract(tag, '(?is)\\burl\\s*=\\s*["'']?\\s*([^"''\\s>]+)', 1), {_AND}) from tags
  where regexp_matches(tag, '(?is)^<meta\\b.*\\bhttp-equiv\\s*=\\s*["'']?\\s*refresh\\b')
), found as (
  select url, {_resolved_sql("base", "link")} as t from targets where link <> ''
), edges as (
  select distinct url as u, {_dotless_sql("t")} as t from found
), urls as (
  select distinct url as x from pages union select t from edges
), nodes as (
  select x, {LOWER.format(f"regexp_extract(x, '{PAGE_PARTS}', 1)")} as host, regexp_extract(x, '{PAGE_PARTS}', 2) as path,
    regexp_extract({_dotless_sql("x")}, '(?s)^.*?://[^/?#]*([^#]*)', 1) as rest from urls where contains(x, '://')
), named as (
  select x, host || case when starts_with(rest, '/') then rest else '/' || rest end as node, {_fits("host", "path")} as rule from nodes
), steps as (
  select a.node as a, b.node as b from edges e join named a on a.x = e.u join named b on b.x = e.t
), both_ways as (
  select a, b from steps union select b, a from steps
), reach as (
  select distinct a as x, a as y from both_ways
  union
  select r.x, s.b from reach r join both_ways s on s.a = r.y
), said as (
  select r.x as node, min(n.rule[2]) as verdict from reach r join named n on n.node = r.y where n.rule is not null group by r.x
)
select p.page_id, coalesce({LOWER.format(f"regexp_extract(p.url, '{PAGE_PARTS}', 1)")}, '') as host, coalesce(regexp_extract(p.url, '{PAGE_PARTS}', 2), '') as path,
  n.rule[1] as rule, coalesce(n.rule[2], s.verdict, 'allow') as verdict
from pages p left join named n on n.x = p.url left join said s on s.node = n.node
"""

_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _licence_sql() -> str:
    places = []
    for phrase, _ in licences.PHRASES:
        parts = phrase.split()
        test = " and ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(parts))
        places.append(f"[i for i in range(0, greatest(len(w) - {len(parts) - 1}, 0)) if {test}]")
    labels = [f"case when len(p{i}) > 0 then '{label}' end" for i, (_, label) in enumerate(licences.PHRASES)]
    telling = licences.telling_words(licences.TEMPLATES, licences.THRESHOLD)

    def listed(words) -> str:
        return f"cast([{', '.join(repr(w) for w in words)}] as varchar[])"

    templates = ", ".join(f"({i}, '{label}', {listed(sorted(set(licences.split_words(text))))}, {listed(telling[i])})" for i, (label, text) in enumerate(licences.TEMPLATES))
    lowered = LOWER.format("coalesce(text, '')")
    return f"""
with texts as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all({lowered}, '{_WORD}') as w from documents
), found as (
  select doc_id, w, {", ".join(f"{p} as p{i}" for i, p in enumerate(places))} from texts
), places as (
  select doc_id, len(w) as n, list_concat({", ".join(f"p{i}" for i in range(2))}) || p2 as p,
    list_distinct([x for x in [{", ".join(labels)}] if x is not null]) as base from found
), lines as (
  select row_number() over () as r, doc_id, list_distinct(regexp_extract_all({LOWER.format("line")}, '{_WORD}')) as w
  from (select doc_id, unnest(string_split(text, chr(10))) as line from texts)
), templates(template, label, words, telling) as (
  values {templates}
), shared as (
  select r, doc_id, list({{'label': label, 's': list_intersect(w, words), 'share': len(list_intersect(w, words)) / len(words)}}) as ms from lines, templates
  where len(list_intersect(w, words)) >= ceil({licences.THRESHOLD} * len(words) - 1e-9) and len(list_intersect(w, telling)) = len(telling) group by r, doc_id
), best as (
  select doc_id, unnest([m for m in ms if len([o for o in ms if o.label <> m.label and len(o.s) > len(m.s) and len(list_intersect(m.s, o.s)) = len(m.s)]) = 0]) as m from shared
), met as (
  select doc_id, m.label as label, m.share as share from best
), met_by as (
  select doc_id, list(distinct label) as labels, max(share) as share from met group by doc_id
)
select p.doc_id, cast(p.n as bigint) as n_words, cast(len(p.p) as bigint) as n_base, cast(list_min(p.p) as bigint) as first_word, cast(list_max(p.p) as bigint) as last_word,
  array_to_string(list_sort(p.base), ',') as base_labels, array_to_string(list_sort(list_distinct(p.base || coalesce(m.labels, []))), ',') as labels,
  case when len(p.p) > 0 then 1.0::double else coalesce(m.share, 0)::double end as score
from places p left join met_by m on m.doc_id = p.doc_id
"""


_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

OP11_SQL = f"""
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{_TERM}') as w from documents
), sized as (
  select r, doc_id, w, len(w) as n from docs where len(w) > 0
), facts as (
  select count(*)::bigint as big_n, sum(n)::bigint as big_l from sized
), items as (
  select row_number() over () as q, item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{_TERM}') as w from benchmark
), asked as (
  select q, t, count(*)::bigint as times from (select q, unnest(w) as t from items) group by all
), counted as (
  select r, t, count(*)::bigint as tf from (select r, unnest(w) as t from sized) where t in (select t from asked) group by all
), weights as (
  select t, floor(1000 * ln((2 * big_n + 2)::double / (2 * count(*) + 1)::double))::bigint as weight from counted, facts group by t, big_n
), normal as (
  select r, doc_id, (25 + (75 * n * big_n) // big_l)::bigint as m from sized, facts
), scored as (
  select a.q, c.r, sum(a.times * w.weight * ((1000000000 * c.tf) // (1000 * c.tf + 8 * d.m)))::bigint as score
  from asked a join counted c on c.t = a.t join weights w on w.t = a.t join normal d on d.r = c.r group by all
), ranked as (
  select s.q, d.doc_id, s.score, row_number() over (partition by s.q order by s.score desc, d.doc_id nulls last) as rank
  from scored s join normal d on d.r = s.r where s.score > 0
)
select i.item_id, cast(r.rank as integer) as rank, r.doc_id, r.score from ranked r join items i on i.q = r.q where r.rank <= 10
"""


def _clusters_sql() -> str:
    d = centroids.DIMENSIONS
    steps = []
    for i in range(centroids.ROUNDS + 1):
        steps.append(f"""own{i} as materialized (
  select r, v, k, dist from (
    select r, v, c.k, list_sum(list_transform(list_zip(v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as dist,
      row_number() over (partition by r order by list_sum(list_transform(list_zip(v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.k) as place
    from vectors, c{i} c) where place = 1
)""")
        if i < centroids.ROUNDS:
            # a whole remainder is taken off first, as the mean is rounded down
            means = ", ".join(f"cast((sum(v[{j}]) - ((sum(v[{j}]) % count(*)) + count(*)) % count(*)) // count(*) as bigint)" for j in range(1, d + 1))
            steps.append(f"""c{i + 1} as materialized (
  select c.k, coalesce(m.c, c.c) as c from c{i} c left join (select k, [{means}] as c from own{i} group by k) m on m.k = c.k
)""")
    return f"""
with vectors as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) as v from embeddings
  where len(embedding) = {d} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {d}
), c0 as materialized (
  select row_number() over (order by sha256('2:' || vec_id), v) - 1 as k, v as c from vectors
  qualify row_number() over (order by sha256('2:' || vec_id), v) <= {centroids.CENTROIDS}
), {', '.join(steps)}, sums as (
  select k, sum(dist)::bigint as cluster_inertia from own{centroids.ROUNDS} group by k
)
select v.vec_id, cast(o.k as integer) as cluster, o.dist::bigint as distance, s.cluster_inertia, (select sum(dist)::bigint from own{centroids.ROUNDS}) as inertia,
  sha256(array_to_string(c.c, ',')) as centroid_sha256
from own{centroids.ROUNDS} o join vectors v on v.r = o.r join sums s on s.k = o.k join c{centroids.ROUNDS} c on c.k = o.k
"""


QUERIES = {
    "op1_ngram_join": (op1_ngram_join, OP1_SQL),
    "op2_quality_classifier": (op2_quality_classifier, None),
    "op3_lm_scoring": (op3_lm_scoring, None),
    "op4_quality_rules": (op4_quality_rules, None),
    "op5_line_dedup": (op5_line_dedup, None),
    "op6_url_filters": (op6_url_filters, OP6_SQL),
    "op7_mixing": (op7_mixing, None),
    "op8_language_id": (op8_language_id, None),
    "op9_license_scan": (op9_license_scan, _licence_sql()),
    "op10_decontamination": (op10_decontamination, None),
    "op11_ranked_search": (op11_ranked_search, OP11_SQL),
    "op12_centroid_clustering": (op12_centroid_clustering, _clusters_sql()),
    "op13_html_extraction": (op13_html_extraction, None),
    "pipeline": (pipeline, None),
}
