"""Fetch policies as pure functions, and a works connector with a proof of completeness. No request is made here."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.robotparser import RobotFileParser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def retry_delay(attempt: int, retry_after: float | None = None, base: float = 1.0, most: float = 60.0) -> float:
    """Seconds before the next try: exponential, but no less than the server asks for."""
    return max(min(most, base * 2**attempt), retry_after or 0.0)


def allowed(robots: str, url: str, agent: str = "*") -> tuple[bool, float]:
    """(whether a robots.txt allows a url, its crawl delay)."""
    rules = RobotFileParser()
    rules.parse(robots.splitlines())
    return rules.can_fetch(agent, url), float(rules.crawl_delay(agent) or 0)


def schedule(urls: DataFrame, interval: float) -> DataFrame:
    """(url, host, starts_after): starting times that keep an interval between a host's requests."""
    host = F.regexp_extract(F.lower("url"), r"^[a-z]+://([^/?#]*)", 1)
    place = F.row_number().over(Window.partitionBy("host").orderBy("url")) - 1
    return urls.select("url", host.alias("host")).withColumn("starts_after", place * F.lit(float(interval)))


def conditional_headers(etag: Column, modified: Column) -> Column:
    """Request headers that let a server answer 304."""
    return F.map_filter(F.create_map(F.lit("If-None-Match"), etag, F.lit("If-Modified-Since"), modified), lambda k, v: v.isNotNull())


def refresh_decision(known_hash: Column, new_hash: Column, known_parser: Column, parser: Column) -> Column:
    """struct(parse, reason): parse what is new, changed or read by another parser version."""
    out = lambda p, r: F.struct(F.lit(p).alias("parse"), F.lit(r).alias("reason"))
    return (
        F.when(known_hash.isNull(), out(True, "first_seen")).when(~known_parser.eqNullSafe(parser), out(True, "parser_changed"))
        .when(known_hash != new_hash, out(True, "body_changed")).otherwise(out(False, "unchanged"))
    )


def due(last_success: Column, now: Column, days: int, failures: Column, parser_changed: Column) -> Column:
    """Whether a source is due: never fetched, its interval over (doubled per failure, eight-fold at most), or read by an old parser."""
    wait = F.lit(days) * F.least(F.lit(8), F.pow(F.lit(2), F.coalesce(failures, F.lit(0)))).cast("int")
    return last_success.isNull() | parser_changed | (last_success + F.make_interval(days=wait) <= now)


class IncompleteInventory(ValueError):
    """A listing that can't be trusted to be whole."""


def pages_of(fetch: Callable[[str], dict], stop_before: str | None = None) -> Iterator[dict]:
    """Works from cursor pages, with proof of completeness.

    fetch(cursor) gives {"count", "next", "results"}. The count must not change, no cursor may come
    twice, and without a cutoff as many works must arrive as were announced. With `stop_before` (for
    results in descending order of updated_date) the listing ends at the first older work.
    """
    cursor, seen, announced, got = "*", set(), None, 0
    while cursor:
        if cursor in seen:
            raise IncompleteInventory("repeated cursor")
        seen.add(cursor)
        page = fetch(cursor)
        if announced is not None and page["count"] != announced:
            raise IncompleteInventory("count changed")
        announced = page["count"]
        for work in page["results"]:
            if stop_before and (work.get("updated_date") or "") < stop_before:
                return
            got += 1
            yield work
        cursor = page.get("next") if page["results"] else None
    if not stop_before and got != announced:
        raise IncompleteInventory(f"{got} of {announced} works")
