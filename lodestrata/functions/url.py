"""Listing addresses: normal form, parts, titles and places taken from the path."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import location, patterns as P, text


@dataclass(frozen=True)
class Site:
    """The site whose listings are accepted: relative addresses are resolved on base, other hosts give null."""

    base: str = "https://www.listings.example"
    hosts: tuple[str, ...] = ("www.listings.example", "listings.example")


SITE = Site()


def normalize(c: Column, site: Site | None = SITE) -> Column:
    """Scheme, host and path without parameters, query, fragment and last slash; null for a foreign host. Host case is kept. site None: any host."""
    base = (site or SITE).base
    return text.once(text.once(F.trim(c), lambda x: _absolute(x, base)), lambda x: _normal(x, site))


def _absolute(c: Column, base: str) -> Column:
    absolute = F.when(c.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), c).when(c.startswith("//"), F.concat(F.lit(base.split(":")[0] + ":"), c)).when(c.startswith("/"), F.concat(F.lit(base), c)).otherwise(F.concat(F.lit(base + "/"), c))
    return F.when(c != "", absolute)


def _normal(absolute: Column, site: Site | None) -> Column:
    scheme = F.lower(F.regexp_extract(absolute, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.regexp_extract(absolute, "^[^:]+://([^/?#]*)", 1)
    path = F.regexp_extract(absolute, "^[^:]+://[^/?#]*([^?#]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, ";[^/]*$", ""), "/+$", "")
    return text.once(host, lambda h: F.when(F.lower(h).isin(*site.hosts) if site else h != "", F.concat(scheme, F.lit("://"), h, path)))


def path(c: Column) -> Column:
    """The decoded path of a normal address."""
    raw = F.regexp_extract(c, "^[^:]+://[^/]*(.*)$", 1)
    return text.once(raw, lambda r: F.coalesce(F.try_url_decode(F.replace(r, F.lit("+"), F.lit("%2B"))), r))


def title(c: Column) -> Column:
    """A title from the last segment: no ending, no trailing number, blanks for _ and -."""
    stem = F.regexp_replace(F.element_at(F.split(path(c), "/"), -1), r"(?<=.)\.[^.]*$", "")
    out = text.squeeze(F.regexp_replace(F.regexp_replace(stem, "_[0-9]+$", ""), "[_-]+", " "))
    return text.once(out, lambda t: F.when(~F.lower(t).isin("", "listing", "annonce"), F.concat(F.upper(F.left(t, F.lit(1))), F.substring(t, 2, 10_000))))


def place(c: Column) -> Column:
    """struct(city, district) from the path: the first segment that is no language or category, and not the last."""
    parts = F.filter(F.split(path(c), "/"), lambda p: (p != "") & ~F.lower(p).isin("fr", "ar"))
    labels = text.once(parts, lambda p: F.transform(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), lambda x: location.title_case(text.squeeze(F.regexp_replace(text.clean(x), "[_-]+", " ")))))
    slug = lambda x: F.replace(F.lower(x), F.lit(" "), F.lit("_"))
    useful = F.filter(labels, lambda p: p.isNotNull() & (p != "") & ~slug(p).isin(*P.CATEGORY_SLUGS))

    def split(first: Column) -> Column:
        is_city = slug(first).isin(*P.CITY_SLUGS)
        return F.struct(F.when(is_city, location.city(first)).alias("city"), F.when(~is_city, location.district(first)).alias("district"))

    return text.once(F.get(useful, F.lit(0)), split)


def looks_like_listing(c: Column) -> Column:
    """A detail page by its path: three levels, an .htm ending or a long number, no profile or shop page."""
    p = F.lower(F.regexp_extract(c, "^[^:]+://[^/]*(.*)$", 1))
    return ~p.rlike("/login|/profile|/boutiques|/shops") & (F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit(""))) >= 3) & (p.endswith(".htm") | p.rlike("_[0-9]{6,}"))
