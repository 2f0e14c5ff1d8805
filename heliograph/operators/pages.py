"""Page extraction: native regular expressions for flat facts, an Arrow table function for HTML structure."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pyarrow as pa
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.functions import urls
from heliograph.runtime import ship_code

PEOPLE_SCHEMA = "url string, name string, title string, department string, profile_url string, emails array<string>, research_areas array<string>, method string, confidence double"


def html_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1))


def headings(html: Column) -> Column:
    """Texts of all h1 to h3 headings, tags stripped."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<h[1-3][^>]*>(.*?)</h[1-3]>"), F.lit(1))
    return F.transform(found, lambda h: F.trim(F.regexp_replace(h, "<[^>]+>", " ")))


def links(html: Column) -> Column:
    """Targets of all links, in order."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?i)<a\s[^>]*?href=[\"']([^\"']*)[\"']"), F.lit(1))


def visible_text(html: Column) -> Column:
    """Text without scripts, styles, comments and tags, white space collapsed."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</(script|style)>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "<[^>]*>", " "), r"\s+", " "))


#: What marks the block pages that answer 200, and what they are called. All marks of a row have to be there.
BLOCK_PAGES = [
    ("incapsula", ["_incapsula_resource", "request unsuccessful"]),
    ("incapsula", ["_incapsula_resource", "<empty body>"]),
    ("site_processing", ["requested page is currently unavailable", "site is processing for"]),
]


def interstitial_reason(html: Column) -> Column:
    """Which block page stands in place of the content, or null."""
    low = F.lower(F.coalesce(html, F.lit("")))
    marks = F.concat(low, F.when(low.rlike(r"<body[^>]*>\s*</body>"), F.lit("<empty body>")).otherwise(""))
    found = [F.when(reduce(lambda a, b: a & b, [F.contains(marks, F.lit(m)) for m in held]), F.lit(f"blocked_interstitial:{name}")) for name, held in BLOCK_PAGES]
    return F.coalesce(*found)


def is_interstitial(html: Column) -> Column:
    """Whether a page is a block page rather than content."""
    return interstitial_reason(html).isNotNull()


def discover_links(pages: DataFrame, include: list[str], limit: int = 25) -> DataFrame:
    """(page_id, link, n): the first `limit` distinct links of each page that hold one of the patterns."""
    found = pages.select("page_id", F.posexplode(F.array_distinct(links(F.col("html")))).alias("pos", "link"))
    kept = found.where(F.exists(F.array(*[F.lit(x) for x in include]), lambda p: F.contains(F.lower("link"), p)))
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("page_id").orderBy("pos"))
    return kept.withColumn("n", n).where(F.col("n") <= limit).select("page_id", "link", "n")


def pagination_links(pages: DataFrame) -> DataFrame:
    """(page_id, link): links that lead to another page of the same listing."""
    return pages.select("page_id", F.explode(F.array_distinct(links(F.col("html")))).alias("link")).where(F.col("link").rlike(r"(?i)[?&](?:page|paged|p|start|offset)=\d+|/page/\d+"))


def profile_identities(pages: DataFrame) -> DataFrame:
    """(page_id, canonical, slug, domain) of each page's url."""
    u = F.col("url")
    return pages.select("page_id", urls.canonical(u).alias("canonical"), urls.slug_key(u).alias("slug"), urls.registrable(urls.host(u)).alias("domain"))


class _Tree(HTMLParser):
    """Collects what people extraction needs: cells, cards, mail links, JSON-LD, headings and sections."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.jsonld: list[str] = []
        self.title = ""
        self.sections: dict[str, list[str]] = {}
        self._open: list[tuple[str, dict]] = []
        self._row: dict | None = None
        self._script = self._heading = None
        self._section = ""

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag not in ("br", "img", "meta", "link", "input", "hr"):
            self._open.append((tag, a))
        if tag == "script" and a.get("type", "").lower() == "application/ld+json":
            self._script = []
        if tag in ("h1", "h2", "h3", "h4"):
            self._heading = [tag, ""]
        if tag == "tr" or (tag in ("div", "li", "article") and re.search(r"(?i)\b(card|person|profile|staff|member|faculty)\b", a.get("class", ""))):
            if self._row is None:
                self._row = {"depth": len(self._open), "cells": [], "links": [], "mails": []}
        if tag == "a" and a.get("href"):
            if a["href"].lower().startswith("mailto:"):
                if self._row is not None:
                    self._row["mails"].append(a["href"][7:].split("?")[0].strip().lower())
            elif self._row is not None:
                self._row["links"].append(a["href"])

    def handle_endtag(self, tag):
        if tag == "script" and self._script is not None:
            self.jsonld.append("".join(self._script))
            self._script = None
        if self._heading and tag == self._heading[0]:
            text = " ".join(self._heading[1].split())
            if tag == "h1" and not self.title:
                self.title = text
            self._section, self._heading = text.lower(), None
        while self._open:
            name, _ = self._open.pop()
            if self._row is not None and len(self._open) < self._row["depth"]:
                self.rows.append(self._row)
                self._row = None
            if name == tag:
                break

    def handle_data(self, data):
        if self._script is not None:
            self._script.append(data)
            return
        if self._heading:
            self._heading[1] += data
        text = " ".join(data.split())
        if not text or any(t in ("script", "style", "nav") for t, _ in self._open):
            return
        if self._row is not None:
            self._row["cells"].append(text)
        elif self._section:
            self.sections.setdefault(self._section, []).append(text)


def _nodes(value):
    """Every object inside a JSON value."""
    if isinstance(value, dict):
        yield value
        for v in value.values():
            yield from _nodes(v)
    elif isinstance(value, list):
        for v in value:
            yield from _nodes(v)


def people_of(html: str) -> list[tuple]:
    """(name, title, department, profile_url, emails, areas, method, confidence) found on a page."""
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    out = []
    for text in tree.jsonld:
        try:
            graph = json.loads(text)
        except ValueError:
            continue
        for node in _nodes(graph):
            kinds = node.get("@type")
            if "Person" in (kinds if isinstance(kinds, list) else [kinds]) and isinstance(node.get("name"), str):
                mail = str(node.get("email") or "").lower().removeprefix("mailto:")
                knows = node.get("knowsAbout") or []
                out.append((node["name"].strip(), node.get("jobTitle"), None, node.get("url"), [mail] if mail else [],
                            [str(x) for x in (knows if isinstance(knows, list) else [knows])], "jsonld", 0.95))
    for row in tree.rows:
        name = next((c for c in row["cells"] if 2 <= len(c.split()) <= 5 and re.fullmatch(r"[^\W\d_][^\d|@#]*", c)), None)
        if name and (row["mails"] or row["links"]):
            rest = [c for c in row["cells"] if c != name]
            title = next((c for c in rest if re.search(r"(?i)\b(professor|lecturer|reader|fellow|dean|director)\b", c)), None)
            out.append((name, title, None, next(iter(row["links"]), None), sorted(set(row["mails"])), [], "directory", 0.8))
    areas = [x for key in ("research interests", "research areas", "research") for part in tree.sections.get(key, []) for x in re.split(r"\s*[;,]\s*", part) if x]
    if not out and tree.title and areas:
        out.append((tree.title, None, None, None, [], areas[:20], "profile", 0.7))
    return out


def extract_people(pages: DataFrame) -> DataFrame:
    """One row per person on each page: JSON-LD, directory rows and cards, or a profile page."""
    ship_code(pages.sparkSession)

    def run(batches):
        for batch in batches:
            found = [(url, *p) for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for p in people_of(html)]
            names = [x.split()[0] for x in PEOPLE_SCHEMA.split(", ")]
            lists = pa.list_(pa.string())
            kinds = [pa.string()] * 5 + [lists, lists, pa.string(), pa.float64()]
            columns = list(zip(*found)) or [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return pages.select("url", "html").mapInArrow(run, PEOPLE_SCHEMA)


def dedupe_people(found: DataFrame) -> DataFrame:
    """One row per (name, profile url, e-mails): the one with the highest confidence."""
    from heliograph.operators.lifecycle import latest

    keyed = found.withColumns({"_k": F.lower("name"), "_u": F.coalesce("profile_url", F.lit("")), "_e": F.array_join("emails", ",")})
    return latest(keyed, ["_k", "_u", "_e"], [F.col("confidence").desc(), F.col("method"), F.col("url")]).drop("_k", "_u", "_e")
