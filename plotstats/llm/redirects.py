"""URL filters: rules on host and path, and block decisions that redirects and canonical links hand to aliases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotstats.llm.graph import components
from plotstats.llm.store import handy, saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: The whole url up to its path, and what follows the path.
ROOT, REST = r"(?s)^(.*?://[^/?#]*)", r"(?s)^.*?://[^?#]*(.*)$"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def lower(column: Column) -> Column:
    """A-Z lower-cased, all else unchanged."""
    return F.translate(column, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?`, `#` or the end; empty for null or another form."""
    return F.coalesce(lower(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(length, verdict, rule) of the longest rule that fits, else null; of equally long ones, the one that allows."""
    found = F.lit(None).cast("struct<size:int,allows:int,rule:string,verdict:string>")
    fitting = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(len(r.text)).alias("size"), F.lit(int(r.verdict == "allow")).alias("allows"), F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.greatest(found, found, *fitting)


def dotless(url: Column) -> Column:
    """The url with the steps `.` and `..` of its path taken; none leads above the root."""
    path = path_of(url)
    steps = F.split(F.substr(path, F.lit(2)), "/")
    last = F.element_at(steps, -1)
    taken = F.reduce(steps, F.lit(""), lambda done, s: F.when(s == ".", done).when(s == "..", F.regexp_replace(done, "/[^/]*$", "")).otherwise(F.concat(done, F.lit("/"), s)))
    plain = F.concat(F.regexp_extract(url, ROOT, 1), taken, F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit("")), F.regexp_extract(url, REST, 1))
    return F.when(path.rlike(r"/\.\.?(/|$)"), plain).otherwise(url)


def node_of(url: Column) -> Column:
    """The page that a url names: scheme, fragment and the dots of its path do not matter, an empty path is `/`. Null for another form."""
    rest = F.regexp_extract(dotless(url), r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    whole = F.concat(host_of(url), F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest)))
    return F.when(F.contains(url, F.lit("://")), F.md5(whole))


def resolved(url: Column, link: Column) -> Column:
    """A link of the page `url` as a whole url; of a link with another scheme, like `mailto:`, what it is.

    A link that is only a query or a fragment keeps the page's path, and a fragment its query too."""
    root = F.regexp_extract(url, ROOT, 1)
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    return dotless(
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^(.*?:)//", 1), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(root, path_of(url), link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(url, r"(?s)^([^#]*)", 1), link))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )


def seen(html: Column) -> Column:
    """The page without its comments."""
    return F.regexp_replace(html, r"(?s)<!--.*?-->", "")


def spelt(link: Column) -> Column:
    """A link as an attribute writes it, with its references to `&` decoded."""
    return F.regexp_replace(link, r"(?i)&(?:amp|#0*38|#x0*26);", "&")


def base_of(url: Column, html: Column) -> Column:
    """What the links of a page are relative to: its first `<base href>`, else the page itself."""
    base = spelt(F.regexp_extract(html, r"(?is)<base\b[^>]*\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1))
    return F.when(base != "", resolved(url, base)).otherwise(url)


def links_of(html: Column) -> Column:
    """Targets of canonical links and of refresh redirects in a page."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    canonical = F.transform(
        F.filter(tags, lambda t: t.rlike(r"(?is)^<link\b.*\brel\s*=\s*[\"']?\s*canonical\b")),
        lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1),
    )
    refresh = F.transform(
        F.filter(tags, lambda t: t.rlike(r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?\s*refresh\b")),
        lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)", 1),
    )
    return F.transform(F.filter(F.concat(canonical, refresh), lambda x: x != ""), spelt)


def judge(pages: DataFrame, rules: list[Rule], id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id_col, host, path, rule, verdict) for every row.

    The longest fitting rule decides a url. A url without one takes the decision of the pages it is an alias of, by any
    number of redirects and canonical links in either direction: allowed if a rule allows one of them, else
    blocked if a rule blocks one, else allowed. A null url, or one without `://`, has no alias and no rule and is allowed;
    null html has no links. Links are relative to the page or its `<base href>`; those within comments do not count. Repeated rows get the same answer.
    """
    url = F.col(url_col)
    own = pages.select(F.col(id_col).alias("_id"), url.alias("_url"))
    own = own.withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url")), "_node": node_of(F.col("_url"))})
    own = own.withColumn("_rule", rule_of(F.col("_host"), F.col("_path"), rules))

    shown = pages.select(url.alias("u"), seen(F.col(html_col)).alias("h")).where(F.contains(F.col("u"), F.lit("://")))
    links = shown.select("u", base_of(F.col("u"), F.col("h")).alias("base"), F.explode(links_of(F.col("h"))).alias("link"))
    links = saved(links.select("u", resolved(F.col("base"), F.col("link")).alias("t")).distinct())
    # both ends of each link, with what the rules say of them; ends that are no page count too
    ends = links.select(F.col("u").alias("x")).union(links.select(F.col("t").alias("x")))
    ends = ends.select(node_of(F.col("x")).alias("node"), rule_of(host_of(F.col("x")), path_of(F.col("x")), rules).getField("verdict").alias("v")).where("node is not null and v is not null")
    group = components(links.select(node_of(F.col("u")).alias("a"), node_of(F.col("t")).alias("b")))
    said = ends.join(group, "node").groupBy("component").agg(F.min("v").alias("alias_verdict"))  # "allow" sorts before "block"
    passed = handy(saved(group.join(said, "component").select("node", "alias_verdict")))
    verdict = F.coalesce(F.col("_rule.verdict"), F.col("alias_verdict"), F.lit("allow"))
    return own.join(passed, F.col("_node") == F.col("node"), "left").select(
        F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule.rule").alias("rule"), verdict.alias("verdict")
    )
