"""URL filters with redirect equivalence."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.entities import html5
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from thermolens.llm.common import lookup, settle
from thermolens.llm.components import components

MOST_RULES = 1000
#: A name, and a value in double quotes, in single quotes or in none.
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)|'([^']*)|([^\s>]+))""")
#: What a page shows to nobody, and the tags that may hold links. A quoted value may hold a ``>``;
#: a tag whose quotes do not match ends at the first one.
TAG = re.compile(r"""(?is)<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript)\b.*?(?:</\1\s*>|\Z)
    |<(?P<kind>link|meta|base)(?=[\s/>])(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*>)""", re.VERBOSE)
#: The link in the content of a refresh tag: after the delay, or after url=, its quotes being optional.
REFRESH = re.compile(r"""(?i)(?:^\s*[\d.]+\s*(?:[;,]\s*|\s)(?:url\s*=\s*)?|url\s*=\s*)"""
                     r"""(?:"([^"]*)|'([^']*)|(\S+))""")
#: In an attribute, a name without semicolon is no entity before = or a letter or digit.
ENTITY = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*(?:;|(?![=A-Za-z0-9])))")


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        ours = (host == self.host) | host.endswith(f".{self.host}")
        return ours & path.startswith(self.path)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where there is no ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, upper.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def best_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """Struct of the name and verdict of the longest rule that fits; of equals, an allow."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == "allow")):
        made = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(rule.fits(host, path), made).otherwise(found)
    return found


def without_dots(path: Column) -> Column:
    """The path with its ``.`` and ``..`` segments resolved."""
    steps = F.split(path, "/", -1)
    kept = F.aggregate(
        F.slice(steps, 2, F.size(steps)), F.array().cast("array<string>"),
        lambda done, step: F.when(step == ".", done)
        .when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(step))))
    end = F.when(F.element_at(steps, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(
        F.array().cast("array<string>"))
    return F.when(path.rlike(r"^/(?:.*/)?\.\.?(?:/|$)"), F.concat(
        F.lit("/"), F.array_join(F.concat(kept, end), "/"))).otherwise(path)


def node_of(url: Column) -> Column:
    """What a url denotes: host without its scheme's own port, path without dot segments and query,
    without scheme and fragment."""
    host, path = split_url(url)
    host = F.when(url.rlike("(?i)^http:"), F.regexp_replace(host, ":80$", "")).when(
        url.rlike("(?i)^https:"), F.regexp_replace(host, ":443$", "")).otherwise(host)
    query = F.regexp_extract(url, r"^.*?://[^?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(
        host, F.when(path == "", "/").otherwise(without_dots(path)), query))


def target_of(url: Column, link: Column) -> Column:
    """An absolute url, without dot segments, for a link found on a page; null for a link of
    another kind, such as ``mailto:``."""
    root = F.regexp_extract(url, r"^(.*?://[^/?#]*)", 1)
    _, path = split_url(url)
    path = F.when(path == "", "/").otherwise(path)
    query = F.regexp_extract(url, r"^.*?://[^?#]*([^#]*)", 1)
    made = (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .when(link.startswith("//"), F.concat(F.lit("http:"), link))
            .when(link.startswith("/"), F.concat(root, link))
            .when(link.startswith("?"), F.concat(root, path, link))
            .when(link.startswith("#"), F.concat(root, path, query, link))
            .otherwise(F.concat(root, F.regexp_extract(path, r"^.*/", 0), link)))
    _, path = split_url(made)
    return F.concat(F.regexp_extract(made, r"^(.*?://[^/?#]*)", 1), without_dots(path),
                    F.regexp_extract(made, r"^.*?://[^?#]*(.*)", 1))


def attributes(tag: str) -> dict[str, str]:
    """The attributes of a tag's inside by lower-case name, the first of each name; values as the
    page means them, without quotes, entities and the white space that urls do not have."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(tag.removesuffix(">")):
        found.setdefault(name.lower(), ENTITY.sub(
            lambda m: html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0],
            "".join(values)))
    return found


def links_of(url: str, page: str) -> list[dict[str, str]]:
    """``link`` and ``base``, the url that it starts from, of every canonical link and every redirect
    by a refresh tag; comments, scripts and the like have none."""
    base, links = "", []
    for tag in TAG.finditer(page):
        if not tag["kind"]:
            continue
        kind, found = tag["kind"].lower(), attributes(tag["rest"])
        link = ""
        if kind == "base":
            base = base or found.get("href", "")
        elif kind == "link" and "canonical" in found.get("rel", "").lower().split():
            link = found.get("href", "")
        elif kind == "meta" and found.get("http-equiv", "").strip().lower() == "refresh":
            refresh = REFRESH.search(found.get("content", ""))
            link = "".join(x or "" for x in refresh.groups()) if refresh else ""
        if link := re.sub(r"[\t\r\n]", "", link).strip():
            links.append(link)
    try:
        base = urljoin(url, re.sub(r"[\t\r\n]", "", base).strip()) if base else url
    except ValueError:  # no url
        base = url
    base = base if "://" in base else url
    return [{"base": base, "link": link} for link in links]


def link_edges(pages: DataFrame) -> DataFrame:
    """url and target of every canonical link and every redirect by a refresh tag."""
    @F.pandas_udf("array<struct<base: string, link: string>>")
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for urls, texts in batches:
            yield pd.Series([links_of(*x) for x in zip(urls, texts)], dtype=object)

    some = pages.select(F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).filter(
        F.col("url").isNotNull() & F.col("html").rlike("(?i)canonical|refresh"))
    links = some.select("url", F.explode(found("url", "html")).alias("l"))
    return links.select("url", F.col("l.base").alias("base"), F.col("l.link").alias("link")).select(
        "url", target_of(F.col("base"), F.col("link")).alias("target"))


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``.

    A url's own longest rule decides. A url without one takes part in its group of aliases, the
    connected component over canonical links and redirects (whose targets need not be pages of the
    table): it is blocked if some alias is blocked by its own rule and none is allowed by one;
    otherwise it is allowed.

    A null url, or one without ``://``, has no host, path, rule or aliases and is allowed. Null
    html has no links. Repeated rows are judged each; an empty table gives no rows; other columns
    are not read. At most MOST_RULES rules; they are part of the plan.
    """
    edges = settle(link_edges(pages).select(
        "url", "target", node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b"))
        .filter("a is not null and b is not null"), "links")
    group = components(edges.select("a", "b"))
    host, path = split_url(F.col("url"))
    ends = edges.select("url", F.col("a").alias("node")).union(edges.select("target", "b"))
    told = ends.select("node", best_rule(rules, host, path).alias("own")).groupBy("node").agg(
        F.max(F.col("own.verdict") == "block").alias("blocked"),
        F.max(F.col("own.verdict") == "allow").alias("allowed"))
    spread = group.join(told, "node").groupBy("component").agg(
        F.max("blocked").alias("blocked"), F.max("allowed").alias("allowed"))
    caught = spread.filter("blocked and not coalesce(allowed, false)").select("component")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumn(
        "node", node_of(F.col("url")))
    aliases = group.join(caught, "component", "left_semi").select("node")
    counted = settle(rows.join(aliases, "node", "left_semi").groupBy("node").agg(
        F.count(F.lit(1)).alias("weight")).withColumn("alias_blocked", F.lit(True)), "aliases")
    own = best_rule(rules, host, path)
    return lookup(rows, counted, "node", "weight").select(
        "page_id", host.alias("host"), path.alias("path"), own["rule"].alias("rule"),
        F.coalesce(own["verdict"], F.when(F.col("alias_blocked"), "block").otherwise("allow"))
        .alias("verdict"))
