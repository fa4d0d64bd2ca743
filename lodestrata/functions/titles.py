"""Listing titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P, text, url


def clean_title(c: Column, address: Column) -> Column:
    """A title without seller, badges, category and the tails that repeat price and features; the address' title where little is left; at most 220 characters."""

    def shortened(t: Column) -> Column:
        out = text.squeeze(F.regexp_replace(F.regexp_replace(t, P.TITLE_SELLER, ""), P.TITLE_BADGE, " "))
        for _ in range(2):
            out = F.regexp_replace(out, P.TITLE_CATEGORY, "")
        for tail in P.TITLE_TAILS:
            out = F.regexp_replace(out, tail, "")
        return F.when(text.maybe(text.low(t), P.TITLE_BUSY) | t.rlike("[0-9]"), out).otherwise(t)

    out = text.stripped(text.once(c, shortened))  # which squeezes it as well
    whole = text.once(out, lambda t: F.when((F.length(t) >= 8) & ~text.key(t).isin(*P.GENERIC_TITLES), F.left(t, F.lit(220))))
    return F.coalesce(whole, url.title(address), text.filled(out))


def is_card_noise(c: Column) -> Column:
    return F.coalesce(c.rlike(P.CARD_NOISE), F.lit(False))
