"""URL filtering with redirect equivalence.

Rules allow or block a host with all its subdomains below a path; the longest rule that fits
a URL decides. URLs that are names of one page form a component: they are linked by declared
canonical links and client redirects of the pages (``link rel=canonical``, ``og:url``,
``meta refresh``) and by the customary server redirects (scheme, a leading ``www.`` or
``m.``, trailing slashes, fragments and tracking parameters). A URL without a rule of its
own takes the decision of its component: allow if an alias is explicitly allowed, else block
if an alias is blocked, else allow.

Nulls: a null URL, or one without ``://``, has an empty host and path, fits no rule, has no
aliases and is allowed; a null html declares nothing. Repeated rows each get their row. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.llm.common import WHITE_SPACE, ascii_lower, broadcast_if_small, written
from rankfold.llm.components import connected_components

BROADCAST_RULES = 100_000

HAS_LINK = r"(?i)canonical|og:url|http-equiv"
RAW = "script|style|textarea|title"  # elements whose content is no markup
TAG = r"(?i)^(?:link|meta|base)[\s/]"
ATTRIBUTE = r"""(?i)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
REFRESH = r"""(?i)^[^;,]*[;,]\s*url\s*=\s*["']?([^"'\s]*)"""
AMPERSAND = r"(?i)&(?:amp|#0*38|#x0*26);"
ABSOLUTE, OTHER_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://", r"^[A-Za-z][A-Za-z0-9+.-]*:"
ALIAS_HOST = r"^(?:www|m)\."
TRACKING = r"&(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*"


def _rest(url: Column) -> Column:
    """The URL after the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def usual_form(url: Column) -> Column:
    """What a URL's customary redirects agree on; null for a URL without ``://``."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    form = F.concat(F.regexp_replace(host(url), ALIAS_HOST, ""), F.regexp_replace(path(url), r"/+$", ""), F.lit("?"),
                    F.regexp_replace(F.concat(F.lit("&"), query), TRACKING, ""))
    return F.when(F.instr(url, "://") > 0, form)


def markup(html: Column) -> Column:
    """``html`` without comments and the content of raw elements, by splitting: linear however many
    of them are left open (an open one takes all that follows, as in a browser)."""
    def after(part: Column, end: str) -> Column:
        at = F.regexp_instr(part, F.lit(end))
        return F.when(at > 0, F.substr(part, at)).otherwise(F.lit(""))

    def cut(text: Column, start: str, end: str) -> Column:
        parts = F.split(text, start)
        return F.array_join(F.transform(parts, lambda x, i: F.when(i == 0, x).otherwise(after(x, end))), "")

    return cut(cut(html, "<!--", "-->"), rf"(?i)<(?=(?:{RAW})[\s/>])", rf"(?i)</(?:{RAW})[\s/>]")


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value, white space around it trimmed and ampersands decoded; empty without one."""
    pattern = ATTRIBUTE.replace("{name}", name)
    value = F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])
    return F.btrim(F.regexp_replace(value, AMPERSAND, "&"), F.lit(WHITE_SPACE))


def without_dots(route: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved."""
    def step(done, x):
        return F.when(x == "..", F.regexp_replace(done, "/[^/]*$", "")).when(x == ".", done).otherwise(F.concat(done, F.lit("/"), x))

    plain = F.aggregate(F.split(F.regexp_replace(route, "^/", ""), "/"), F.lit(""), step)
    return F.when(route.rlike(r"(?:^|/)\.\.?(?:/|$)"), F.concat(plain, F.when(route.rlike(r"(?:^|/)\.\.?$"), F.lit("/")).otherwise(F.lit("")))
                  ).otherwise(route)


def resolved(target: Column, base: Column) -> Column:
    """An address as seen from the URL ``base``; null for an empty one, a fragment, or a scheme
    without ``//`` (mail, script)."""
    scheme = F.substring_index(base, "://", 1)
    origin = F.concat(scheme, F.lit("://"), host(base))
    folder = F.regexp_replace(path(base), "[^/]*$", "")
    t_path, t_rest = F.regexp_extract(target, "^([^?#]*)", 1), F.regexp_extract(target, "^[^?#]*(.*)", 1)
    relative = F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), t_path)
    return (F.when((target == "") | target.startswith("#"), F.lit(None))
            .when(target.rlike(ABSOLUTE), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.rlike(OTHER_SCHEME), F.lit(None))
            .when(target.startswith("?"), F.concat(origin, path(base), target))
            .when(target.startswith("/"), F.concat(origin, without_dots(t_path), t_rest))
            .otherwise(F.concat(origin, without_dots(relative), t_rest)))


def declared(pages: DataFrame) -> DataFrame:
    """(url, target) of the addresses that pages declare for themselves, in every ``link`` and
    ``meta`` tag outside comments, scripts, styles, text areas and titles. Relative ones are
    resolved against the page's first ``base`` or else its URL. A tag ends at its first ``>``."""
    pages = pages.select("url", "html").filter(F.col("html").rlike(HAS_LINK) & (F.instr("url", "://") > 0))
    pieces = F.filter(F.split(markup(F.col("html")), "<"), lambda x: x.rlike(TAG) & (F.instr(x, ">") > 0))
    tags = pages.select("url", F.transform(pieces, lambda x: F.substring_index(x, ">", 1)).alias("tags"))
    bases = F.filter(F.transform("tags", lambda x: F.when(x.rlike(r"(?i)^base[\s/]"), attribute(x, "href"))), lambda x: x != "")
    tags = tags.select("url", F.coalesce(resolved(F.get(bases, F.lit(0)), F.col("url")), F.col("url")).alias("base"), F.explode("tags").alias("tag"))
    tag = F.col("tag")
    link, meta = tag.rlike(r"(?i)^link[\s/]"), tag.rlike(r"(?i)^meta[\s/]")
    found = (F.when(link & attribute(tag, "rel").rlike(r"(?i)(?:^|\s)canonical(?:\s|$)"), attribute(tag, "href"))
             .when(meta & (F.lower(attribute(tag, "property")) == "og:url"), attribute(tag, "content"))
             .when(meta & (F.lower(attribute(tag, "http-equiv")) == "refresh"), F.regexp_extract(attribute(tag, "content"), REFRESH, 1)))
    return tags.select("url", resolved(found, F.col("base")).alias("target")).filter("target IS NOT NULL").distinct()


def rule_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) of the URLs that a rule fits; ``rules``: verdict, host, path."""
    rules = written(rules.select("verdict", F.col("host").alias("rule_host"), F.col("path").alias("rule_path")), "url-rules")
    parts = F.split(host(F.col("url")), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    keyed = urls.select("url", path(F.col("url")).alias("p"), F.explode(suffixes).alias("rule_host"))
    fit = keyed.join(broadcast_if_small(rules, rules.count(), BROADCAST_RULES), "rule_host").filter(F.col("p").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = F.max_by(F.struct(rule.alias("rule"), "verdict"), F.struct(F.length(rule), rule, "verdict"))
    return fit.groupBy("url").agg(best.alias("b")).select("url", "b.rule", "b.verdict")


def url_filter(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, alias_group (smallest alias; null if none)."""
    urls = written(pages.select("url").filter(F.instr("url", "://") > 0).distinct(), "urls")
    links = written(declared(pages), "url-links")
    nodes = written(urls.unionByName(links.select(F.col("target").alias("url"))).distinct(), "url-nodes")
    forms = nodes.select("url", usual_form(F.col("url")).alias("form"))
    first = forms.groupBy("form").agg(F.min("url").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    usual = forms.join(first, "form").select(F.col("url").alias("u"), F.col("first").alias("v"))
    groups = connected_components(usual.unionByName(links.select(F.col("url").alias("u"), F.col("target").alias("v"))), "url-groups")
    ruled = written(rule_verdicts(nodes, rules), "url-verdicts")
    members = groups.withColumnRenamed("node", "url").join(ruled, "url", "left")
    votes = members.groupBy("component").agg(F.max(F.col("verdict") == "allow").alias("allowed"),
                                             F.max(F.col("verdict") == "block").alias("blocked"))
    inherited = F.when(F.coalesce("allowed", F.lit(False)), F.lit("allow")).when(F.coalesce("blocked", F.lit(False)), F.lit("block"))
    decided = (groups.join(votes, "component").select(F.col("node").alias("url"), "component", inherited.alias("inherited")))
    table = (urls.join(ruled, "url", "left").join(decided, "url", "left")
             .select(F.col("url").alias("_u"), "rule", F.coalesce("verdict", "inherited").alias("verdict"), F.col("component").alias("alias_group")))
    u = F.coalesce("url", F.lit(""))
    return (pages.select("page_id", "url").join(table, F.col("url") == F.col("_u"), "left")
            .select("page_id", host(u).alias("host"), path(u).alias("path"), "rule",
                    F.coalesce("verdict", F.lit("allow")).alias("verdict"), "alias_group"))


def rules_from(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    """A rules table from (verdict, host, path) literals."""
    literal = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(r, ("verdict", "host", "path"))]) for r in rows])
    return spark.range(1).select(F.explode(literal).alias("r")).select("r.*")


# The rules of the registered query.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def _oracle() -> str:
    rest = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    hostname = rf"translate(regexp_extract({rest}, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    route = rf"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)"
    query = rf"regexp_extract({rest}, '^[^?#]*\?([^#]*)', 1)"
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    def on(expr, name):  # an expression over ``url`` for another column
        return re.sub(r"\burl\b", name, expr)

    def cut(text, split, end):
        return (f"array_to_string(list_transform({split}, lambda x, i: CASE WHEN i = 1 THEN x ELSE "
                f"coalesce(regexp_extract(x, '(?is){end}.*$'), '') END), '')")

    text = cut("html", "string_split(html, '<!--')", "-->")
    raw = cut("m", rf"string_split(regexp_replace(m, '(?i)<((?:{RAW})[\s/>])', chr(1) || '\1', 'g'), chr(1))", rf"</(?:{RAW})[\s/>]")
    def attr(name):
        pattern = ATTRIBUTE.replace("{name}", name).replace("'", "''")
        value = " || ".join(f"regexp_extract(tag, '{pattern}', {k})" for k in (1, 2, 3))
        return rf"trim(regexp_replace({value}, '{AMPERSAND}', '&', 'g'), e' \t\n\x0b\f\r')"

    def dots(route):
        fold = (f"list_reduce(list_prepend('', string_split(regexp_replace({route}, '^/', ''), '/')), lambda done, x: "
                "CASE WHEN x = '..' THEN regexp_replace(done, '/[^/]*$', '') WHEN x = '.' THEN done ELSE done || '/' || x END)")
        return (rf"CASE WHEN regexp_matches({route}, '(?:^|/)\.\.?(?:/|$)') THEN {fold} || CASE WHEN regexp_matches({route}, '(?:^|/)\.\.?$') "
                f"THEN '/' ELSE '' END ELSE {route} END")

    def resolve(t, base):
        origin = f"split_part({base}, '://', 1) || '://' || {on(hostname, base)}"
        folder = f"regexp_replace({on(route, base)}, '[^/]*$', '')"
        t_path, t_rest = f"regexp_extract({t}, '^([^?#]*)', 1)", f"regexp_extract({t}, '^[^?#]*(.*)', 1)"
        relative = f"(CASE WHEN {folder} = '' THEN '/' ELSE {folder} END || {t_path})"
        return (f"CASE WHEN {t} IS NULL OR {t} = '' OR starts_with({t}, '#') THEN NULL WHEN regexp_matches({t}, '{ABSOLUTE}') THEN {t} "
                f"WHEN starts_with({t}, '//') THEN split_part({base}, '://', 1) || ':' || {t} WHEN regexp_matches({t}, '{OTHER_SCHEME}') THEN NULL "
                f"WHEN starts_with({t}, '?') THEN {origin} || {on(route, base)} || {t} "
                f"WHEN starts_with({t}, '/') THEN {origin} || {dots(t_path)} || {t_rest} ELSE {origin} || {dots(relative)} || {t_rest} END")

    refresh = REFRESH.replace("'", "''")
    return rf"""
WITH RECURSIVE rules(verdict, rh, rp) AS (VALUES {values}),
texts AS (SELECT url, {text} AS m FROM pages WHERE strpos(url, '://') > 0),
pieces AS (SELECT url, list_transform(list_filter(string_split({raw}, '<'), lambda x: regexp_matches(x, '{TAG}') AND strpos(x, '>') > 0),
  lambda x: split_part(x, '>', 1)) AS tags FROM texts),
numbered AS (SELECT url, unnest(tags) AS tag, generate_subscripts(tags, 1) AS n FROM pieces),
hrefs AS (SELECT url, arg_min(h, n) AS t FROM (SELECT url, n, {attr('href')} AS h FROM numbered WHERE regexp_matches(tag, '(?i)^base[\s/]'))
  WHERE h <> '' GROUP BY url),
found AS (SELECT url, CASE
    WHEN regexp_matches(tag, '(?i)^link[\s/]') AND regexp_matches({attr('rel')}, '(?i)(?:^|\s)canonical(?:\s|$)') THEN {attr('href')}
    WHEN regexp_matches(tag, '(?i)^meta[\s/]') AND lower({attr('property')}) = 'og:url' THEN {attr('content')}
    WHEN regexp_matches(tag, '(?i)^meta[\s/]') AND lower({attr('http-equiv')}) = 'refresh' THEN regexp_extract({attr('content')}, '{refresh}', 1)
  END AS t FROM numbered),
based AS (SELECT f.url, f.t, coalesce({resolve('b.t', 'b.url')}, f.url) AS base FROM found f LEFT JOIN hrefs b ON b.url = f.url),
declared AS (SELECT DISTINCT url, {resolve('t', 'base')} AS target FROM based),
nodes AS (SELECT url FROM pages WHERE strpos(url, '://') > 0 UNION SELECT target FROM declared WHERE target IS NOT NULL),
parts AS (SELECT url, {hostname} AS host, {route} AS path,
  regexp_replace({hostname}, '{ALIAS_HOST}', '') || regexp_replace({route}, '/+$', '') || '?'
  || regexp_replace('&' || {query}, '{TRACKING}', '', 'g') AS form FROM nodes),
ruled AS (SELECT url, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
  FROM parts, rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY url),
one_way AS (SELECT a.url AS u, b.url AS v FROM parts a JOIN parts b USING (form) WHERE a.url <> b.url
  UNION SELECT url, target FROM declared WHERE target IS NOT NULL AND target <> url),
edges AS (SELECT u, v FROM one_way UNION SELECT v, u FROM one_way),
reach(u, v) AS (SELECT url, url FROM nodes UNION SELECT r.u, e.v FROM reach r JOIN edges e ON r.v = e.u),
groups AS (SELECT u AS url, CASE WHEN count(DISTINCT v) > 1 THEN min(v) END AS alias_group,
  CASE WHEN bool_or(verdict = 'allow') THEN 'allow' WHEN bool_or(verdict = 'block') THEN 'block' END AS inherited
  FROM reach LEFT JOIN ruled ON ruled.url = reach.v GROUP BY u)
SELECT page_id, coalesce({hostname.replace('url', 'p.url')}, '') AS host, coalesce({route.replace('url', 'p.url')}, '') AS path,
  rule, coalesce(verdict, inherited, 'allow') AS verdict, alias_group
FROM pages p LEFT JOIN ruled ON ruled.url = p.url LEFT JOIN groups g ON g.url = p.url
"""


ORACLE_SQL = _oracle()
