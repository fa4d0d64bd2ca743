"""Kinds of property and listing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P, text


def _joined(values: list[Column]) -> Column:
    return F.concat_ws(" ", *(F.coalesce(v, F.lit("")) for v in values))


def _by_words(c: Column, order) -> Column:
    return text.once(text.low(c), lambda low: F.coalesce(*(F.when(text.maybe(low, P.TYPE_STEMS[k]) & c.rlike(P.words(P.TYPE_WORDS[k])), F.lit(k)) for k in order)))


def property_type(values: list[Column]) -> Column:
    """The first canonical name in the text, else the first kind, in priority order, with one of its words there."""
    named = lambda c: F.when(text.maybe(c, P.CANONICAL_TYPES), text.found(c, f"(?<![a-z])({'|'.join(P.CANONICAL_TYPES)})(?![a-z])"))
    return text.once(F.replace(F.replace(F.lower(_joined(values)), F.lit("_"), F.lit(" ")), F.lit("-"), F.lit(" ")), lambda c: F.coalesce(named(c), _by_words(c, P.TYPE_WORDS)))


def page_property_type(values: list[Column]) -> Column:
    """The kind as pages are read: words only, apartments first."""
    return text.once(F.translate(F.lower(F.concat_ws(" ", *values)), "_-", "  "), lambda c: _by_words(c, P.PAGE_TYPE_ORDER))


def listing_type(label: Column, combined: Column, price: Column, strict_label: bool = False) -> Column:
    """sale or rent: an exact label, sale words, rent words, a price under the sale range, else sale.

    The label is joined with the text before it is compared, so beside any text it has no effect; strict_label compares it alone.
    """
    def read(whole: Column) -> Column:
        alone = label if strict_label else whole
        exact = F.when(~alone.rlike("^(?:[^A-Za-z0-9]*+[A-Za-z0-9]){5}"), text.key(alone))  # with five letters it is neither
        words = lambda low: F.when(text.maybe(low, P.SALE_STEMS) & whole.rlike(P.SALE), "sale").when(text.maybe(low, P.RENT_STEMS) & whole.rlike(P.RENT), "rent")
        return F.coalesce(text.once(exact, lambda x: F.when(x.isin("sale", "rent"), x)), text.once(text.low(whole), words), F.when(price < P.SALE_PRICE[0], "rent").otherwise("sale"))

    return text.once(F.concat_ws(" ", label, combined), read)


def page_listing_type(values: list[Column]) -> Column:
    """sale or rent as pages are read: rent words first, then sale words, then the address; else null."""
    read = lambda c: F.when(c.rlike(P.PAGE_RENT), "rent").when(c.rlike(P.PAGE_SALE), "sale").when(c.rlike(P.PAGE_RENT_PATH), "rent").when(c.rlike(P.PAGE_SALE_PATH), "sale")
    return text.once(F.concat_ws(" ", *values), read)


def age_bucket(age: Column) -> Column:
    return F.when(age <= 2, "new").when(age <= 10, "recent").when(age <= 30, "established").when(age.isNotNull(), "old")


def rooms_total(kind: Column, bedrooms: Column, bathrooms: Column) -> Column:
    both = F.coalesce(bedrooms, F.lit(0)) + F.coalesce(bathrooms, F.lit(0))
    return F.when(kind == "land", F.lit(0)).when(bedrooms.isNull() & bathrooms.isNull(), F.lit(None)).when((bedrooms == 0) & (kind == "studio"), 1 + both).otherwise(both)


def share_present(values: list[Column]) -> Column:
    """Share of the values that are there, 4 places half up."""
    n = sum((v.isNotNull().cast("int") for v in values), F.lit(0))
    return F.round(n.cast("decimal(12,4)") / F.lit(len(values)), 4).cast("decimal(12,4)")
