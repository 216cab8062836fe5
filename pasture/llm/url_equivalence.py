"""URL filters with redirect equivalence.

Rules (host, path) judge a url: a rule fits its host and all subdomains where the path starts with the rule's; the
longest wins.  Pages that lead to one another, by a canonical link or a redirect in their html, are aliases: connected
components over those edges carry a block to every alias without a rule of its own.  Explicit allow takes precedence:
a page's own rule is final, and a component that holds an explicitly allowed url is not blocked.

A page's links are all its canonical links and refreshes, relative ones resolved against its own url (a ``base`` element
is not read); a reference of another kind (``mailto:``) or to a place in the page itself leads nowhere.

A node is a url without scheme, fragment, tracking parameters and trailing slashes, so spellings of one page meet in
one node before any edge is followed.  Components run over the edges only, which are far fewer than the pages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasture.llm.graph import components
from pasture.llm.scratch import pick, stored

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TRACKING = r"(?:^|(?<=&))(?:utm_[^&=]*|ref)=[^&]*(?:&|$)"
_LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?\s*canonical\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?\s*refresh\b[^>]*>"
_REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)"
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """The page a url names; null for a url without ``://``."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.rtrim(F.regexp_replace(query, _TRACKING, ""), F.lit("&"))
    name = F.concat(host(url), F.rtrim(path(url), F.lit("/")))
    return F.when(_rest(url).isNotNull(), F.when(query != "", F.concat(name, F.lit("?"), query)).otherwise(name))


def judged(host_: Column, path_: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule; null where none fits."""
    fits = []
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        own = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        fits.append((own, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))))
    return reduce(lambda w, x: w.when(*x), fits[1:], F.when(*fits[0])) if fits else F.lit(None).cast(
        "struct<rule:string,verdict:string>")


def _plain(path_: Column) -> Column:
    """A path without ``.`` and ``..`` segments; one that ends in such a segment names a folder."""
    closed = F.split(F.regexp_replace(path_, r"(/\.\.?)$", "$1/"), "/")
    folded = F.aggregate(F.slice(closed, F.lit(2), F.size(closed)), F.lit(""), lambda done, part: (
        F.when(part == ".", done).when(part == "..", F.regexp_replace(done, "/[^/]*$", ""))
        .otherwise(F.concat(done, F.lit("/"), part))))
    return F.when(path_.rlike(r"/\.\.?(/|$)"), folded).otherwise(path_)


def resolved(url: Column, found: Column) -> Column:
    """The absolute url that a reference in the page ``url`` means; null where it leads nowhere."""
    scheme = F.regexp_extract(url, r"^([^:/?#]*)://", 1)
    root = F.concat(scheme, F.lit("://"), host(url))
    folder = F.regexp_extract(path(url), "(?s)^.*/", 0)
    own = F.regexp_extract(found, "^[^?#]*", 0)
    tail = F.substring(found, F.length(own) + 1, F.length(found))
    whole = F.when(own.startswith("/"), own).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), own))
    return (F.when((found == "") | found.startswith("#"), F.lit(None).cast("string"))
            .when(found.rlike(_SCHEME), F.when(found.rlike(_SCHEME + "//"), found))
            .when(found.startswith("//"), F.concat(scheme, F.lit(":"), found))
            .when(_rest(url).isNull(), F.lit(None).cast("string"))
            .when(found.startswith("?"), F.concat(root, path(url), found))
            .otherwise(F.concat(root, _plain(whole), tail)))


def targets(url: Column, html: Column) -> Column:
    """Absolute urls that a page names as its canonical form or redirects to, each once."""
    def named(tag: str, value: str) -> Column:
        return F.transform(F.regexp_extract_all(html, F.lit(tag), F.lit(0)), lambda x: F.regexp_extract(x, value, 1))

    found = F.transform(F.concat(named(_LINK, _HREF), named(_REFRESH, _REFRESH_URL)), lambda x: F.regexp_replace(x, "&amp;", "&"))
    return F.array_compact(F.transform(F.array_distinct(found), lambda x: resolved(url, x)))


def decisions(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages`` (page_id, url, html).

    A null url, or one without ``://``, has empty host and path, fits no rule, has no alias and is allowed.  Null html
    has no links; repeated rows each return a row; an empty table gives an empty result.
    """
    d = pick(pages, page_id="bigint", url="string", html="string")
    d = d.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
                 node(F.col("url")).alias("node"), F.coalesce(targets(F.col("url"), F.col("html")), F.array().cast("array<string>")).alias("to"))
    d = stored(d.withColumn("own", judged(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", "node", "to", "own.rule", "own.verdict"), "pages")
    far = d.where(F.size("to") > 0).select("node", F.explode("to").alias("url"))
    far = far.select("node", node(F.col("url")).alias("there"),
                     judged(host(F.col("url")), path(F.col("url")), rules)["verdict"].alias("verdict"))
    comp = stored(components(far.where("node is not null and there is not null")
                             .select(F.col("node").alias("u"), F.col("there").alias("v"))), "components")
    marks = d.select("node", "verdict").union(far.select("there", "verdict"))
    marks = marks.where("node is not null and verdict is not null").distinct()
    marks = marks.join(comp, "node", "left").groupBy(F.coalesce("component", "node").alias("group")).agg(
        F.bool_or(F.col("verdict") == "block").alias("block"), F.bool_or(F.col("verdict") == "allow").alias("allow"))
    blocked = marks.where("block and not allow").select("group")
    # the nodes of blocked groups: the group's members and, without any edge, the node itself
    members = comp.select("node", F.col("component").alias("group"))
    aliases = stored(members.join(blocked, "group", "left_semi").select("node")
                     .union(blocked.select(F.col("group").alias("node"))).distinct(), "aliases")
    aliases = aliases.withColumn("passed", F.lit("block"))
    return d.join(aliases, "node", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "passed", F.lit("allow")).alias("verdict"))


def _sql_rule(h: str, p: str) -> str:
    return f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"


def oracle_sql(rules=RULES) -> str:
    """DuckDB SQL for ``decisions``."""
    order = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule = "CASE " + " ".join(f"WHEN {_sql_rule(h, p)} THEN '{h}{p}'" for _, h, p in order) + " END"
    verdict = "CASE " + " ".join(f"WHEN {_sql_rule(h, p)} THEN '{v}'" for v, h, p in order) + " END"

    def parts(url: str, also: str) -> str:
        rest = f"CASE WHEN contains({url}, '://') THEN substr({url}, instr({url}, '://') + 3) END"
        return rf"""SELECT {also}, rest, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), '{_UPPER}', '{_LOWER}') AS host,
          coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
          list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
                      lambda x: NOT regexp_matches(x, '^(utm_[^&=]*|ref)=')) AS params
          FROM (SELECT *, {rest} AS rest FROM {{}})"""

    named = """CASE WHEN rest IS NOT NULL THEN host || rtrim(path, '/') ||
               CASE WHEN rtrim(array_to_string(params, '&'), '&') <> '' THEN '?' || rtrim(array_to_string(params, '&'), '&') ELSE '' END END"""
    return rf"""
WITH RECURSIVE p AS (SELECT *, {named} AS node, {rule} AS rule, {verdict} AS own FROM ({parts('url', 'page_id, url, html').format('pages')})),
f AS (SELECT DISTINCT node AS src, regexp_extract(url, '^([^:/?#]*)://', 1) AS scheme, host AS own_host, path AS own_path, rest AS own_rest,
        replace(unnest(list_transform(regexp_extract_all(html, '<link\b[^>]*\brel\s*=\s*["'']?\s*canonical\b[^>]*>', 0, 'is'),
                lambda x: regexp_extract(x, '\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1, 'is'))
          || list_transform(regexp_extract_all(html, '<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?\s*refresh\b[^>]*>', 0, 'is'),
                lambda x: regexp_extract(x, '\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1, 'is'))), '&amp;', '&') AS l FROM p),
g AS (SELECT *, regexp_extract(l, '^[^?#]*') AS l_path, substr(l, length(regexp_extract(l, '^[^?#]*')) + 1) AS l_tail,
        CASE WHEN starts_with(l, '/') THEN '' WHEN contains(own_path, '/') THEN regexp_extract(own_path, '^.*/', 0, 's') ELSE '/' END AS folder
      FROM f WHERE l <> '' AND NOT starts_with(l, '#')),
h AS (SELECT *, string_split(regexp_replace(folder || l_path, '(/\.\.?)$', '\1/'), '/')[2:] AS parts FROM g),
a AS (SELECT src, CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN l END
                  WHEN starts_with(l, '//') THEN scheme || ':' || l
                  WHEN own_rest IS NULL THEN NULL
                  WHEN starts_with(l, '?') THEN scheme || '://' || own_host || own_path || l
                  ELSE scheme || '://' || own_host || list_reduce(parts, lambda done, x: CASE WHEN x = '.' THEN done
                         WHEN x = '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || x END, '') || l_tail END AS url
      FROM h),
t AS (SELECT *, {named} AS node, {verdict} AS own FROM ({parts('url', 'src, url').format('(SELECT * FROM a WHERE url IS NOT NULL)')})),
e AS (SELECT src AS u, node AS v FROM t WHERE src IS NOT NULL AND node IS NOT NULL AND src <> node
      UNION SELECT node, src FROM t WHERE src IS NOT NULL AND node IS NOT NULL AND src <> node),
walk(x, y) AS (SELECT DISTINCT u, u FROM e UNION SELECT walk.x, e.v FROM walk JOIN e ON walk.y = e.u),
c AS (SELECT x AS node, min(y) AS component FROM walk GROUP BY x),
m AS (SELECT coalesce(component, node) AS grp, bool_or(own = 'block') AS block, bool_or(own = 'allow') AS allow
      FROM (SELECT node, own FROM p UNION ALL SELECT node, own FROM t) LEFT JOIN c USING (node)
      WHERE own IS NOT NULL AND node IS NOT NULL GROUP BY 1)
SELECT page_id, host, path, rule,
       coalesce(own, CASE WHEN block AND NOT allow THEN 'block' END, 'allow') AS verdict
FROM (SELECT p.*, coalesce(component, p.node) AS grp FROM p LEFT JOIN c ON p.node = c.node) LEFT JOIN m USING (grp)
"""
