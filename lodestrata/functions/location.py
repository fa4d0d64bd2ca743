"""Cities and districts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P, text


def title_case(c: Column) -> Column:
    """Every word with a capital, separators kept, particles in lower case wherever they stand."""
    words = F.regexp_extract_all(F.lower(c), F.lit(r"([^\s'-]+|[\s'-])"), 1)
    cased = F.transform(words, lambda w: F.when(w.isin(*P.PARTICLES), w).otherwise(F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 10_000))))
    return F.trim(F.array_join(cased, ""))


def city(c: Column) -> Column:
    """The city before a comma, bar or hyphen: its label if it is known under any spelling, else in title case."""
    alias = F.create_map(*[F.lit(x) for pair in P.CITY_ALIASES.items() for x in pair])
    return text.once(F.trim(F.regexp_extract(c, r"^([^,|-]*)", 1)), lambda head: F.when(head != "", F.coalesce(F.try_element_at(alias, text.key(head)), title_case(head))))


def district(c: Column) -> Column:
    """A district without noise phrases; null for noise, an address or more than 80 characters."""

    def read(busy: Column) -> Column:
        out = F.regexp_replace(c, P.words("Toute la ville|Autre secteur"), "")
        out = F.regexp_replace(F.regexp_replace(out, P.words("Premium|Star"), ""), "[0-9]+/[0-9]+", "")
        noise = lambda x: busy & (x.rlike(P.PLACE_NOISE) | x.rlike(P.ADDRESS))
        return text.once(text.stripped(F.when(busy, out).otherwise(c)), lambda x: F.when((x != "") & (F.length(x) <= 80) & ~noise(x), title_case(x)))

    return text.once(text.maybe(text.low(c), P.PLACE_BUSY), read)


def from_text(c: Column) -> Column:
    """struct(city, district) from a phrase such as 'appartements dans <city>, <district>'."""
    phrase = F.when(c.rlike(f"{P.I}dans"), c)
    return text.once(phrase, lambda x: F.struct(city(text.found(x, P.PLACE, 1)).alias("city"), district(text.found(x, P.PLACE, 2)).alias("district")))


def no_address(c: Column) -> Column:
    """A sanitized place, null if it looks like a street address (the wide list)."""
    return text.once(c, lambda x: F.when(~x.rlike(P.WIDE_ADDRESS), x))


def candidate(c: Column) -> Column:
    """struct(city, district) of a page's location text: the phrase, else the first pieces between commas, bars and dashes."""
    def piece(x: Column) -> Column:
        out = F.regexp_replace(F.regexp_replace(x, P.words("Toute la ville|Autre secteur"), ""), P.words("Premium|Star"), "")
        out = text.stripped(F.regexp_replace(out, "[0-9]+/[0-9]+", ""))
        return text.once(out, lambda x: F.when((x != "") & (F.length(x) <= 70) & ~x.rlike(P.PAGE_PLACE_NOISE), x))

    pieces = F.filter(F.transform(F.split(F.replace(F.replace(c, F.lit("|"), F.lit(",")), F.lit(" - "), F.lit(",")), ","), lambda x: piece(F.trim(x))), lambda x: x.isNotNull())
    phrase = c.rlike(P.PLACE)

    def pick(found: Column) -> Column:
        first, second = F.get(found, F.lit(0)), F.get(found, F.lit(1))
        ok = F.length(first) <= 60
        return F.struct(
            F.when(phrase, piece(text.found(c, P.PLACE, 1))).when(ok, first).alias("city"),
            F.when(phrase, piece(text.found(c, P.PLACE, 2))).when(ok & (F.length(second) <= 60), second).alias("district"),
        )

    return text.once(pieces, pick)
