"""URL filters: host and path rules, with block decisions passed on over redirect equivalence.

A url's own rule decides first, the longest that fits; so an explicit allow is never overruled. Urls
without a rule that redirect to, or name as canonical, or are so named by, a blocked url (over any
number of steps) are blocked too; all others are allowed. Aliases are the connected components over edges
from each page to all its canonical links and refresh targets, found by distributed star contraction over numbers that
linked urls get in a stored table, never over their hashes.
Targets are decoded and, where relative, resolved against the page's url (a base tag is not read).
The rule list is a parameter of at most ``MAX_RULES`` entries and becomes one column expression.

Null urls and those without ``://`` have an empty host and path and fit no rule; null or empty html
holds no link. Rows may repeat; an empty table gives no rows; further columns stay untouched, but for those named
host, path, rule or verdict, whose place the results take.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doorledger.llm.common import RID, connected_components, map_rows, numbered, stored

MAX_RULES = 1000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: the rules of the registered query
RULES = (Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
         Rule("net", "/es/", "block"), Rule("net", "/fr/", "block"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What lies between the host after the first ``://`` and a query or fragment; empty without a slash."""
    rest = url.substr(F.instr(url, "://") + 3, F.length(url))
    return F.coalesce(F.when(F.contains(url, F.lit("://")), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; this form takes at most {MAX_RULES}")
    out = F.lit(None)
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _decoded(value: str) -> str:
    """Character references replaced, as in an attribute: names need their semicolon."""
    return re.sub(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;)",
                  lambda m: unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0], value, flags=re.ASCII)


def _without_dots(path: str) -> str:
    """The path without its ``.`` and ``..`` segments."""
    out, parts = [], path.split("/")
    for part in parts:
        if part == "..":
            if len(out) > 1:
                out.pop()
        elif part != ".":
            out.append(part)
    return "/".join(out) + ("/" if parts[-1] in (".", "..") else "")


def resolved(url: str, target: str) -> str | None:
    """The url that a link of the page ``url`` leads to; absolute ones as they are, None without ``://``."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", target):
        return target if "://" in target else None
    base = re.match(r"(?s)(.*?:)(//[^/?#]*)([^?#]*)(\?[^#]*)?", url)
    if base is None:
        return None
    scheme, host, path, query = base.groups(default="")
    if target.startswith("//"):
        return scheme + target
    own, tail = re.match(r"(?s)([^?#]*)(.*)", target).groups()
    if not own:
        return scheme + host + path + (tail if tail.startswith("?") else query + tail)
    whole = own if own.startswith("/") else (path[:path.rfind("/") + 1] or "/") + own
    return scheme + host + _without_dots(whole) + tail


def links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(url, target) of all canonical links and refresh redirects, decoded and resolved against the page's url."""
    def targets(pattern: str, value: str) -> Column:
        return F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(0)), lambda tag: F.regexp_extract(tag, value, 1))

    canonical = targets(r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)")
    refresh = targets(r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)")
    found = pages.where(F.col(url).isNotNull() & (F.contains(F.lower(html), F.lit("canonical")) | F.contains(F.lower(html), F.lit("refresh"))))

    def run(batches):
        for b in batches:
            own = b["url"].to_pylist()
            yield {"url": b["url"], "target": [resolved(u, _decoded(t)) for u, t in zip(own, b["_t"].to_pylist(), strict=True)]}

    named = found.select(F.col(url).alias("url"), F.explode(F.concat(canonical, refresh)).alias("_t")).where("_t <> ''")
    return map_rows(named, run, "url string, target string").where("target is not null").distinct()


def judged(pages: DataFrame, rules: tuple[Rule, ...], url: str = "url", html: str = "html") -> DataFrame:
    """All columns of ``pages`` with host, path, rule and verdict."""
    edges = stored(links(pages, url, html))
    urls = numbered(edges.select("url").union(edges.select("target")).distinct())
    ends = (edges.join(urls.select("url", F.col(RID).alias("src")), "url")
            .join(urls.select(F.col("url").alias("target"), F.col(RID).alias("dst")), "target"))
    nodes = urls.join(connected_components(ends.select("src", "dst")).withColumnRenamed("node", RID), RID)
    blocked = (nodes.where(rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)["verdict"] == "block")
               .select("component").distinct())
    aliases = nodes.join(blocked, "component", "left_semi").select(F.col("url").alias("__alias")).distinct()
    rows = (pages.join(aliases, F.col(url) == F.col("__alias"), "left")
            .withColumns({"__host": host_of(F.col(url)), "__path": path_of(F.col(url))}))
    own = rule_of(F.col("__host"), F.col("__path"), rules)
    found = {"host": F.col("__host"), "path": F.col("__path"), "rule": own["rule"],
             "verdict": F.coalesce(own["verdict"], F.when(F.col("__alias").isNotNull(), "block").otherwise("allow"))}
    return rows.withColumns(found).drop("__alias", "__host", "__path")
