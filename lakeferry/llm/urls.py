"""URL filters over redirect and canonical-link equivalence, with built-in functions only.

A page's own rule decides first. Redirects (``<meta http-equiv=refresh>``, or edges given)
and canonical links make URLs aliases; connected components over these edges carry a block
decision of any member, page or target, to all aliases without a rule of their own, unless
a member is explicitly allowed: then they stay allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .components import connected_components

#: (verdict, host, path): a rule fits its host and all subdomains, for paths that begin so.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UP, _LOW), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def no_dots(path: Column) -> Column:
    """``path`` without the segments ``.`` and ``..``, each ``..`` taking the one before it."""
    step = lambda done, x: F.when(x == ".", done).when(
        x == "..", F.regexp_replace(done, r"/[^/]*\z", "")).otherwise(F.concat(done, F.lit("/"), x))
    parts = F.split(path, "/")
    plain = F.concat(F.aggregate(F.slice(parts, 2, F.size(parts)), F.lit(""), step),
                     F.when(path.rlike(r"/\.\.?\z"), F.lit("/")).otherwise(F.lit("")))
    return F.when(F.contains(path, F.lit("/.")), plain).otherwise(path)


def node_of(url: Column) -> Column:
    """The resource of a url: host, path without dot segments and query, without scheme and
    fragment."""
    path = no_dots(path_of(url))
    query = F.coalesce(F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1), F.lit(""))
    return F.when(F.instr(url, "://") > 0, F.concat(
        host_of(url), F.when(path == "", F.lit("/")).otherwise(path), query))


def _first_fit(host: Column, path: Column, rules, value) -> Column:
    """The value of the longest rule (host and path together) that fits, or null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == r[1]) | host.endswith("." + r[1])) & path.startswith(r[2])
        out = F.when(fits, F.lit(value(r))).otherwise(out)
    return out


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    return _first_fit(host, path, rules, lambda r: r[1] + r[2])


def verdict_of(host: Column, path: Column, rules=RULES) -> Column:
    return _first_fit(host, path, rules, lambda r: r[0])


#: ``canonical`` as one of the words of rel; the attribute's name begins after a blank,
#: a quote or a slash, so ``data-rel`` is another.
_CANONICAL = (r"""(?i)[\s"'/]rel\s*=\s*(?:"(?:[^"]*\s)?canonical(?:\s[^"]*)?"|"""
              r"""'(?:[^']*\s)?canonical(?:\s[^']*)?'|canonical[\s/>])""")
_HREF = r"""(?i)[\s"'/]href\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?i)[\s"'/]http-equiv\s*=\s*["']?refresh\b"""
_TO = r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)"""


def _target(tag: Column) -> Column:
    canonical = tag.rlike(r"(?i)^<link") & tag.rlike(_CANONICAL)
    refresh = tag.rlike(r"(?i)^<meta") & tag.rlike(_REFRESH)
    url = F.when(canonical, F.regexp_extract(tag, _HREF, 1)).when(
        refresh, F.regexp_extract(tag, _TO, 1))
    return F.when(url != "", F.replace(url, F.lit("&amp;"), F.lit("&")))


def link_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) urls: each page's canonical link and meta refresh, made absolute; dot
    segments stay (``node_of`` resolves them)."""
    tags = F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    found = (pages.where("url is not null and html is not null")
             .where(F.col("html").rlike(r"(?i)canonical|http-equiv"))
             .select("url", F.explode(tags).alias("tag"))
             .select("url", _target(F.col("tag")).alias("to")).where("to is not null"))
    to = F.col("to")
    root = F.concat(F.lit("http://"), F.col("host"))
    found = found.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    found = found.withColumn("folder", F.regexp_extract("path", r"(?s)^.*/", 0))
    return found.select(F.col("url").alias("src"), F.when(F.instr(to, "://") > 0, to)
                        .when(to.startswith("//"), F.concat(F.lit("http:"), to))
                        .when(to.startswith("/"), F.concat(root, to))
                        .when(to.startswith("?"), F.concat(root, "path", to))
                        .when(F.col("folder") == "", F.concat(root, F.lit("/"), to))
                        .otherwise(F.concat(root, "folder", to)).alias("dst"))


def judge(pages: DataFrame, rules=RULES, edges: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    ``edges`` (src, dst urls, such as a redirect log) are added to those of the pages' html.
    A null url, or one without ``://``: empty host and path, no rule, no alias, allowed.
    Null or empty html has no links. A page's own rule sees its path as it stands, a link's
    target is judged by its path without dot segments. Repeated rows and equal urls are
    judged alike; other columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(pages.sparkSession)
    found = link_edges(pages.select("url", "html"))
    if edges is not None:
        found = found.unionByName(edges.select("src", "dst"))
    found = scratch.table(found.distinct(), "links")  # a page in many has a link
    for c, n in (("src", "a"), ("dst", "b")):
        path = path_of(F.col(c))
        found = found.withColumns({f"{n}_host": host_of(F.col(c)), n: node_of(F.col(c)),
                                   f"{n}_path": no_dots(path) if n == "b" else path})
    found = scratch.table(found, "nodes").where("a <> b")
    comp = connected_components(found.select("a", "b"), scratch, native=True)
    own = found.select(F.col("a").alias("node"), F.col("a_host").alias("host"),
                       F.col("a_path").alias("path")).unionByName(
        found.select(F.col("b").alias("node"), F.col("b_host").alias("host"),
                     F.col("b_path").alias("path"))).distinct()
    own = own.select("node", verdict_of(F.col("host"), F.col("path"), rules).alias("v")).where(
        "v is not null")
    says = own.join(comp, "node").groupBy("component").agg(
        F.when(F.bool_or(F.col("v") == "allow"), F.lit("allow")).otherwise("block").alias("passed"))
    alias = comp.join(says, "component").select("node", "passed")
    url = F.col("url").cast("string")
    host, path = F.col("host"), F.col("path")
    out = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"),
                       F.coalesce(node_of(url), F.concat(  # no node: a key of its own each
                           F.lit("\0"), F.col("page_id").cast("string"))).alias("node"))
    out = out.join(alias, "node", "left")
    return out.select(
        F.col("page_id").cast("long").alias("page_id"), "host", "path",
        rule_of(host, path, rules).alias("rule"),
        F.coalesce(verdict_of(host, path, rules), "passed", F.lit("allow")).alias("verdict"))


def _fit_sql(host: str, path: str, value) -> str:
    out = "NULL"
    for r in sorted(RULES, key=lambda r: len(r[1]) + len(r[2])):
        out = (f"CASE WHEN ({host} = '{r[1]}' OR ends_with({host}, '.{r[1]}')) AND "
               f"starts_with({path}, '{r[2]}') THEN '{value(r)}' ELSE {out} END")
    return out


def _dots_sql(path: str) -> str:
    return (f"CASE WHEN contains({path}, '/.') THEN list_reduce(list_prepend('', "
            f"string_split({path}, '/')[2:]), lambda done, x: CASE WHEN x = '.' THEN done "
            f"WHEN x = '..' THEN regexp_replace(done, '/[^/]*\\z', '') "
            f"ELSE done || '/' || x END) || "
            f"CASE WHEN regexp_matches({path}, '/\\.\\.?\\z') THEN '/' ELSE '' END ELSE {path} END")


def _parts_sql(url: str, p: str, target: bool = False) -> str:
    rest = f"CASE WHEN contains({url}, '://') THEN substr({url}, instr({url}, '://') + 3) END"
    host = f"coalesce(translate(regexp_extract({rest}, '^[^/?#]*', 0), '{_UP}', '{_LOW}'), '')"
    path = f"coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '')"
    plain = _dots_sql(path)
    node = (f"CASE WHEN contains({url}, '://') THEN {host} || CASE WHEN {path} = '' THEN '/' "
            f"ELSE {plain} END || coalesce(regexp_extract({rest}, '^[^?#]*(\\?[^#]*)', 1), '') END")
    return f"{host} AS {p}host, {plain if target else path} AS {p}path, {node} AS {p}node"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


ORACLE = f"""
WITH RECURSIVE p AS (SELECT page_id, url, html, {_parts_sql('url', '')} FROM pages),
tags AS (SELECT url, host, path, tag FROM p,
           unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) AS t(tag)
         WHERE url IS NOT NULL AND html IS NOT NULL),
hrefs AS (SELECT url, host, path, replace(CASE
    WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches(tag, {_quoted(_CANONICAL)})
      THEN regexp_extract(tag, {_quoted(_HREF)}, 1)
    WHEN regexp_matches(tag, '(?i)^<meta') AND regexp_matches(tag, {_quoted(_REFRESH)})
      THEN regexp_extract(tag, {_quoted(_TO)}, 1) END,
    '&amp;', '&') AS dest FROM tags),
full_urls AS (SELECT url, CASE WHEN contains(dest, '://') THEN dest
    WHEN starts_with(dest, '//') THEN 'http:' || dest
    WHEN starts_with(dest, '/') THEN 'http://' || host || dest
    WHEN starts_with(dest, '?') THEN 'http://' || host || path || dest
    ELSE 'http://' || host || CASE WHEN regexp_extract(path, '(?s)^.*/', 0) = '' THEN '/'
         ELSE regexp_extract(path, '(?s)^.*/', 0) END || dest END AS dst
  FROM hrefs WHERE dest <> ''),
e AS (SELECT {_parts_sql('url', 'a_')}, {_parts_sql('dst', 'b_', True)} FROM full_urls),
both_ways AS (SELECT a_node AS u, b_node AS v FROM e WHERE a_node <> b_node
              UNION SELECT b_node, a_node FROM e WHERE a_node <> b_node),
own AS (SELECT DISTINCT node, v FROM (
    SELECT a_node AS node, {_fit_sql('a_host', 'a_path', lambda r: r[0])} AS v FROM e
    UNION ALL SELECT b_node, {_fit_sql('b_host', 'b_path', lambda r: r[0])} FROM e)
  WHERE v IS NOT NULL),
reach(node, far) AS (SELECT u, u FROM both_ways UNION
                     SELECT r.node, w.v FROM reach r JOIN both_ways w ON r.far = w.u),
passed AS (SELECT r.node, CASE WHEN bool_or(o.v = 'allow') THEN 'allow' ELSE 'block' END AS passed
           FROM reach r JOIN own o ON r.far = o.node GROUP BY r.node)
SELECT page_id, host, path, {_fit_sql('host', 'path', lambda r: r[1] + r[2])} AS rule,
       coalesce({_fit_sql('host', 'path', lambda r: r[0])}, passed, 'allow') AS verdict
FROM p LEFT JOIN passed USING (node)
"""
