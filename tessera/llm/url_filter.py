"""URL filter with redirect equivalence.

Allow and block rules (host suffix + path prefix, longest rule wins) judge every URL. Pages
that name another URL as their canonical address, or forward to it, are aliases of it:
distributed connected components over these edges carry block decisions to every alias that
no rule judges. An explicit allow takes precedence: a URL whose own rule allows is never
blocked, and a component in which some URL is explicitly allowed passes no block on.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no rule
and is allowed; an empty or null page has no edges; repeated rows each get their verdict;
an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rule sets up to this many become one compiled expression; larger ones are joined by host.
COMPILED_RULES = 64

CANONICAL_TAG = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH_TAG = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
REFRESH_URL = r"""(?is)\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    action: str      # allow or block
    host: str        # the host itself and all subdomains
    path: str = "/"  # prefix of the path

    @property
    def text(self) -> str:
        return self.host + self.path


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null and for URLs without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def host_of(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def node_of(rest: Column) -> Column:
    """Identity of a URL among aliases: lower-cased host, path and query; no scheme or fragment."""
    return F.concat(host_of(rest), F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1))


def _fits(host: Column, path: Column, rule: Rule) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def with_rule(df: DataFrame, rules: list[Rule], host: str = "host", path: str = "path") -> DataFrame:
    """Add ``rule`` (text of the longest rule that fits, else null) and ``action``.

    Longest: by the length of host + path; on a tie the longer host, then block before allow.
    """
    ranked = sorted({(r.action, r.host, r.path) for r in rules},
                    key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    ranked = [Rule(*r) for r in ranked]
    if len(ranked) <= COMPILED_RULES:
        pick = F.lit(None).cast("struct<rule:string,action:string>")
        for r in reversed(ranked):
            hit = F.struct(F.lit(r.text).alias("rule"), F.lit(r.action).alias("action"))
            pick = F.when(_fits(F.col(host), F.col(path), r), hit).otherwise(pick)
        return df.withColumn("_pick", pick).select(
            "*", F.col("_pick.rule").alias("rule"), F.col("_pick.action").alias("action")).drop("_pick")
    # many rules: look the URL's host and its parent domains up in the rule table, each
    # distinct (host, path) once
    spark = df.sparkSession
    table = spark.createDataFrame([(i, r.action, r.host, r.path, r.text) for i, r in enumerate(ranked)],
                                  "_rank int, _action string, _suffix string, _prefix string, _text string")
    labels = F.split(F.col(host), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    best = (df.select(host, path).distinct()
            .withColumn("_suffix", F.explode(suffixes)).join(table, "_suffix")
            .where(F.col(path).startswith(F.col("_prefix")))
            .groupBy(host, path)
            .agg(F.min(F.struct("_rank", F.col("_text").alias("rule"), F.col("_action").alias("action"))).alias("_pick"))
            .select(host, path, "_pick.rule", "_pick.action"))
    return df.join(best, [host, path], "left")


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (src, dst) between URL nodes: canonical links and forwarding pages. Relative
    targets are resolved against the page (without removing dot segments)."""
    tag = F.regexp_extract(html, CANONICAL_TAG, 0)
    forward = F.regexp_extract(html, REFRESH_TAG, 0)
    rest = after_scheme(F.col(url))
    found = (pages.where(F.col(url).isNotNull()
                         & (F.lower(F.col(html)).contains("canonical") | F.lower(F.col(html)).contains("http-equiv")))
             .select(node_of(rest).alias("src"), host_of(rest).alias("_h"), path_of(rest).alias("_p"),
                     F.explode(F.array(F.regexp_extract(tag, HREF, 1),
                                       F.regexp_extract(forward, REFRESH_URL, 1))).alias("_t")))
    target = F.replace(F.col("_t"), F.lit("&amp;"), F.lit("&"))
    folder = F.regexp_extract("_p", r"^(.*/)", 1)
    absolute = (F.when(target.contains("://"), after_scheme(target))
                .when(target.startswith("//"), target.substr(F.lit(3), F.length(target)))
                .when(target.startswith("/"), F.concat("_h", target))
                .when(target.startswith("?"), F.concat("_h", "_p", target))
                .otherwise(F.concat("_h", F.when(folder == "", "/").otherwise(folder), target)))
    return (found.where((F.col("_t") != "") & ~F.col("_t").startswith("#"))
            .select("src", node_of(absolute).alias("dst")).where("src != '' and dst != '' and src != dst"))


def judge(pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url",
          html: str = "html", redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, reason (rule, alias or default).

    ``redirects``: optional table (src, dst) of URLs that answered with a redirect.
    """
    edges = page_edges(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(
            node_of(after_scheme(F.col("src"))).alias("src"), node_of(after_scheme(F.col("dst"))).alias("dst"))
            .where("src != '' and dst != ''"))
    comp = connected_components(edges)
    nodes = with_rule(comp.withColumn("host", F.regexp_extract("node", r"^[^/?]*", 0))
                      .withColumn("path", F.regexp_extract("node", r"^[^/?]*([^?]*)", 1)), rules)
    passed = (nodes.groupBy("component")
              .agg(F.max(F.col("action").eqNullSafe("allow")).alias("_allowed"),
                   F.max(F.col("action").eqNullSafe("block")).alias("_blocked"))
              .where("_blocked and not _allowed").select("component"))
    aliases = comp.join(passed, "component").select(F.col("node").alias("_node"), F.lit(True).alias("_alias"))
    rest = after_scheme(F.col(url))
    own = pages.select(F.col(page_id).alias("page_id"), host_of(rest).alias("host"),
                       path_of(rest).alias("path"), node_of(rest).alias("_node"))
    own = with_rule(own, rules)
    blocked = F.coalesce("_alias", F.lit(False))
    return own.join(aliases, "_node", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("action", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("action").isNotNull(), "rule").when(blocked, "alias").otherwise("default").alias("reason"))
