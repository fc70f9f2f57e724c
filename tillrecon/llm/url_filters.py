"""URL filters with redirect equivalence.

A rule is a host and a path; it fits its host and all subdomains where the path starts with the rule's,
and the longest one decides (allow, if two are as long). Redirects and canonical links make addresses
equivalent: connected components over these edges are found by distributed joins, and an address without a
rule of its own takes the decision of its component: allow if a member is explicitly allowed, else block
if a member is blocked, else allow.

DataFrame and SQL functions only. An address is its host, path and query; scheme and fragment do not count.
Hosts are expanded to their suffixes and joined with the rules on equality, so a list of any length works.

Defined cases: a null address or one without ``://`` has an empty host and path, no rule, no links and is allowed;
rows with the same id or address are judged alike, row by row. Links that are neither absolute nor rooted are left out.
Of rules that
fit, the longest decides, and two of one length can't both fit. Pages of any length are searched whole; an empty table
has no rows. Only the named columns are read; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillrecon.llm.common import components, stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\burl\s*=\s*["']?([^"'\s>]+)"""


def url_parts(url: Column | str) -> tuple[Column, Column, Column]:
    """Host in lower case, path, and query with its question mark."""
    url = F.col(url) if isinstance(url, str) else url
    host, path, query = (F.coalesce(F.regexp_extract(url, _PARTS, i), F.lit("")) for i in (1, 2, 3))
    return F.translate(host, _UPPER, _LOWER), path, query


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, target) of canonical links and of refresh redirects that pages declare."""
    found = F.concat(*[F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in (_CANONICAL, _REFRESH)])
    some = pages.where(F.col(html).rlike(r"(?i)\b(canonical|refresh)\b")).select(F.col(url).alias("url"), F.explode(found).alias("target"))
    scheme = F.regexp_extract("url", r"(?s)^(.*?)://", 1)
    host = F.regexp_extract("url", _PARTS, 1)
    target = (
        F.when(F.col("target").contains("://"), F.col("target"))
        .when(F.col("target").startswith("//"), F.concat(scheme, F.lit(":"), "target"))
        .when(F.col("target").startswith("/"), F.concat(scheme, F.lit("://"), host, "target"))
    )
    return some.select("url", target.alias("target")).where("target is not null")


def rules_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules from (action, host and path), such as ("block", "example.com/en/")."""
    split = [(r[: r.index("/")], r[r.index("/") :], a) for a, r in rules]
    return spark.createDataFrame(split, "host string, path string, action string")


def _best_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) for the distinct addresses that a rule fits."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = addresses.select("host", "path").where("host <> ''").distinct().select("host", "path", F.explode(suffixes).alias("suffix"))
    given = rules.select(F.col("host").alias("suffix"), F.col("path").alias("start"), "action")
    fit = each.join(given, "suffix").where(F.col("path").startswith(F.col("start")))
    rule = F.concat("suffix", "start")
    best = F.max(F.struct(F.length(rule).alias("n"), (F.col("action") == "allow").alias("allow"), rule.alias("rule"), "action"))
    return fit.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.action")


def judge_urls(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url).

    ``rules``: host, path, action (allow or block). ``links``: url, target; both ends count as aliases.
    """
    host, path, query = url_parts("url")
    rows = stage(pages.select("page_id", host.alias("host"), path.alias("path"), F.concat(host, path, query).alias("node")), "addresses")
    if links is None:
        best = _best_rules(rows, rules)
        flags = rows.sparkSession.createDataFrame([], "node string, allowed boolean, blocked boolean")
    else:
        ends = []
        for end in ("url", "target"):
            h, p, q = url_parts(end)
            ends.append(F.struct(h.alias("host"), p.alias("path"), F.concat(h, p, q).alias("node")).alias(end))
        edges = stage(links.select(*ends).where("url.host <> '' and target.host <> ''").distinct(), "links")
        known = rows.select("host", "path").union(edges.select("url.host", "url.path")).union(edges.select("target.host", "target.path"))
        best = stage(_best_rules(known, rules), "rules")
        found = components(edges.select(F.col("url.node").alias("a"), F.col("target.node").alias("b")))
        members = edges.select(F.explode(F.array("url", "target")).alias("e")).select("e.*").distinct()
        judged = members.join(best, ["host", "path"], "left").join(found, "node")
        by_component = judged.groupBy("component").agg(
            F.coalesce(F.bool_or(F.col("action") == "allow"), F.lit(False)).alias("allowed"),
            F.coalesce(F.bool_or(F.col("action") == "block"), F.lit(False)).alias("blocked"),
        )
        flags = found.join(by_component, "component").select("node", "allowed", "blocked")
    out = rows.join(best, ["host", "path"], "left").join(flags, "node", "left")
    alias = F.when(F.col("blocked") & ~F.col("allowed"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("action", alias).alias("verdict"))


RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge_urls(pages, rules_frame(spark, RULES), page_links(pages))


_SQL_PARTS = r"'(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?'"


def _sql_node(url: str) -> str:
    part = [f"coalesce(regexp_extract({url}, {_SQL_PARTS}, {i}), '')" for i in (1, 2, 3)]
    host = f"translate({part[0]}, '{_UPPER}', '{_LOWER}')"
    return f"{{'host': {host}, 'path': {part[1]}, 'node': {host} || {part[1]} || {part[2]}}}"


OP9_SQL = rf"""
WITH RECURSIVE rules(host, path, action) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), pages1 AS (
  SELECT page_id, url, html, unnest({_sql_node("url")}) FROM pages
), tags AS (
  SELECT url, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*>'), lambda t: regexp_matches(t, '(?is)\brel\s*=\s*["'']?canonical\b')),
      lambda t: regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
    list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*>'), lambda t: regexp_matches(t, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')),
      lambda t: regexp_extract(t, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)))) AS target
  FROM pages WHERE html IS NOT NULL
), links AS (
  SELECT url, CASE WHEN contains(target, '://') THEN target
    WHEN starts_with(target, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || target
    WHEN starts_with(target, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || target END AS target
  FROM tags WHERE target <> ''
), edges AS (
  SELECT {_sql_node("url")} AS u, {_sql_node("target")} AS t FROM links WHERE target IS NOT NULL AND url IS NOT NULL
), both_ways AS (
  SELECT u.node AS a, t.node AS b FROM edges WHERE u.host <> '' AND t.host <> ''
  UNION SELECT t.node, u.node FROM edges WHERE u.host <> '' AND t.host <> ''
), reach AS (
  SELECT a AS node, a AS other FROM both_ways
  UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.other
), addresses AS (
  SELECT DISTINCT host, path, node FROM (
    SELECT host, path, node FROM pages1 UNION ALL SELECT u.host, u.path, u.node FROM edges UNION ALL SELECT t.host, t.path, t.node FROM edges)
), best AS (
  SELECT a.host, a.path, a.node, max_by({{'rule': r.host || r.path, 'action': r.action}}, length(r.host || r.path)) AS b
  FROM addresses a JOIN rules r ON (a.host = r.host OR ends_with(a.host, '.' || r.host)) AND starts_with(a.path, r.path)
  GROUP BY ALL
), flags AS (
  SELECT r.node, bool_or(b.action = 'allow') AS allowed, bool_or(b.action = 'block') AS blocked
  FROM reach r JOIN best ON best.node = r.other GROUP BY r.node
)
SELECT p.page_id, p.host, p.path, best.b.rule AS rule,
  coalesce(best.b.action, CASE WHEN blocked AND NOT allowed THEN 'block' ELSE 'allow' END) AS verdict
FROM pages1 p LEFT JOIN best ON best.node = p.node AND best.path = p.path AND best.host = p.host LEFT JOIN flags f ON f.node = p.node
"""
