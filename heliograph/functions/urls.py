"""URL functions as Column expressions: host, path, canonical form, identity keys and predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
TRACKING_KEYS = "fbclid gclid ref source".split()
GENERIC_FRAGMENTS = "about bio biography contact content main overview profile publications research top".split()
GENERIC_SLUGS = "about academic-staff contact directory faculty home index people profile profiles staff team".split()
IDENTITY_HOSTS = "orcid.org researchgate.net scholar.google.com scopus.com".split()
IDENTITY_KEYS = "id person personid pid profile rp staff uid".split()
PERSON_MARKERS = "faculty people person persons profile profiles rp staff".split()
SECOND_LEVEL = "ac co com edu gov net org sch".split()

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), _URL, group)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def host(url: Column) -> Column:
    """Lower-case, without user, port and a leading 'www.'."""
    return F.regexp_replace(F.lower(F.regexp_replace(_part(url, 2), r"^[^@]*@|:\d*$", "")), r"^www\.", "")


def _port(url: Column) -> Column:
    port = F.regexp_extract(_part(url, 2), r":(\d+)$", 1)
    usual = ((scheme(url) == "http") & (port == "80")) | ((scheme(url) == "https") & (port == "443"))
    return F.when((port != "") & ~usual, F.concat(F.lit(":"), port)).otherwise("")


def path(url: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.replace(_part(url, 3), F.lit("+"), F.lit("%2B"))), _part(url, 3))


def segments(url: Column) -> Column:
    """The path's non-empty parts in lower case."""
    return F.filter(F.split(F.lower(path(url)), "/"), lambda s: s != "")


def _pairs(url: Column) -> Column:
    """(key, value) of the query's parts with a value."""
    parts = F.filter(F.split(_part(url, 4), "&"), lambda p: F.instr(p, "=") > 1)
    pair = lambda p: F.struct(F.lower(F.substring_index(p, "=", 1)).alias("k"), F.substr(p, F.instr(p, "=") + 1).alias("v"))
    return F.filter(F.transform(parts, pair), lambda x: x["v"] != "")


def canonical(url: Column) -> Column:
    """A form for comparison: host without www, clean path, sorted query without tracking, telling fragments.

    Null and empty give the empty string.
    """
    p = F.regexp_replace(F.regexp_replace(path(url), "/{2,}", "/"), "/+$", "")
    p = F.regexp_replace(F.when(p == "", "/").otherwise(p), r"(?i)^(.*/)index\.html$", "$1")
    p = F.when(F.length(p) > 1, F.regexp_replace(p, "/$", "")).otherwise(p)
    kept = F.filter(_pairs(url), lambda x: ~F.startswith(x["k"], F.lit("utm_")) & ~x["k"].isin(*TRACKING_KEYS))
    query = F.array_join(F.array_sort(F.transform(kept, lambda x: F.concat(x["k"], F.lit("="), F.trim(x["v"])))), "&")
    fragment = F.regexp_replace(F.lower(_part(url, 5)), "[^a-z0-9]+", "")
    out = F.concat(
        host(url), _port(url), p, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when((fragment != "") & ~fragment.isin(*GENERIC_FRAGMENTS), F.concat(F.lit("#"), fragment)).otherwise(""),
    )
    return F.when(F.coalesce(F.trim(url), F.lit("")) == "", "").otherwise(F.lower(out))


def registrable(name: Column) -> Column:
    """The last two labels of a host, three under a country's second level."""
    labels = F.filter(F.split(F.regexp_replace(F.lower(name), r"^www\.", ""), r"\."), lambda x: x != "")
    n = F.size(labels)
    country = (n > 2) & (F.length(F.element_at(labels, -1)) == 2) & F.element_at(labels, F.when(n > 1, -2).otherwise(-1)).isin(*SECOND_LEVEL)
    take = F.when(country, 3).otherwise(2)
    return F.array_join(F.slice(labels, F.greatest(n - take + 1, F.lit(1)), take), ".")


def slug_key(url: Column) -> Column:
    """domain|last path part, or the whole canonical url if it has a query; empty if neither."""
    c = canonical(url)
    last = F.substring_index(c, "/", -1)
    domain = registrable(host(url))
    return F.when(F.contains(c, F.lit("?")), c).when((domain != "") & (last != ""), F.concat(domain, F.lit("|"), last)).otherwise("")


def under(name: Column, domains: list[str]) -> Column:
    """Whether a host is one of the domains or below it."""
    out = F.lit(False)
    for d in domains:
        d = d.lower().removeprefix("www.")
        out = out | (name == d) | F.endswith(name, F.lit("." + d))
    return out


def is_official(url: Column, domains: list[str]) -> Column:
    return F.coalesce((scheme(url) == "file") | under(host(url), domains), F.lit(False))


def is_external_identity(url: Column) -> Column:
    return under(host(url), IDENTITY_HOSTS)


def is_unusable(url: Column) -> Column:
    """Whether a link can't be a person's page: no web address, an identity service, an error page, a portal's root."""
    bare = F.regexp_replace(F.lower(path(url)), "/+$", "")
    root = F.startswith(host(url), F.lit("scholars.")) & (bare == "") & (_part(url, 4) == "") & (_part(url, 5) == "")
    bad = ~scheme(url).isin("http", "https") | (host(url) == "") | is_external_identity(url) | F.endswith(bare, F.lit("/error/404")) | root
    return F.when(F.coalesce(url, F.lit("")) == "", False).otherwise(bad)


def is_person_specific(url: Column) -> Column:
    """Whether the path or an id in the query names one person."""
    s = segments(url)
    last = F.regexp_replace(F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit("")), r"\.html$", "")
    keyed = F.exists(_pairs(url), lambda x: x["k"].isin(*IDENTITY_KEYS))
    marked = F.exists(F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0))), lambda x: x.isin(*PERSON_MARKERS))
    return (F.size(s) > 0) & ~last.isin(*GENERIC_SLUGS) & (keyed | ((F.size(s) >= 2) & (marked | (F.size(s) >= 3))))


def profile_quality(url: Column) -> Column:
    """Points for depth and person-like paths; null scores -100."""
    c = canonical(url)
    depth = F.size(F.filter(F.split(F.substring_index(c, "?", 1), "/"), lambda x: x != ""))
    person = F.when(c.rlike(r"/(?:people|persons|profile|profiles|rp|staff)/[^/]+"), 20).otherwise(0)
    listing = F.when(F.substring_index(c, "/", -1).isin("academic-staff", "directory", "faculty", "people", "staff"), -30).otherwise(0)
    return F.when(F.coalesce(url, F.lit("")) == "", -100).otherwise(depth + person + listing)


def anomaly(url: Column) -> Column:
    """Why a stored profile link is unfit, or null."""
    return (
        F.when(F.coalesce(F.trim(url), F.lit("")) == "", F.lit(None)).when(~scheme(url).isin("http", "https"), "not_http")
        .when(host(url) == "", "no_host").when(is_external_identity(url), "external_identity").when(is_unusable(url), "error_or_portal_root")
    )
