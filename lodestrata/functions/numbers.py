"""Prices, surfaces, counts, floors, years and coordinates read from sanitized text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import filled, found, once

#: A text that is one price in whole units, by the month or not, and nothing else.
_PRICE_ALONE = rf"^(?i)(?:[0-9]{{1,3}}(?: [0-9]{{3}})+|[0-9]{{2,15}}) *{P.CURRENCY}(?: */ *mois)?\z"
_PRICE = rf"{P.I}(?:{P.MILLION}|{P.MONEY})"


def token(c: Column, multiplier: Column | None = None) -> Column:
    """A number token as decimal(20,2), half up: of both , and . the last is the decimal sign, a lone comma only before one or two digits; grouped thousands collapse; the sign is dropped."""

    def read(t: Column) -> Column:
        comma, dot = F.instr(t, ","), F.instr(t, ".")
        last_comma = F.length(t) - F.instr(F.reverse(t), ",")
        last_dot = F.length(t) - F.instr(F.reverse(t), ".")
        plain = (
            F.when((comma > 0) & (dot > 0) & (last_comma > last_dot), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
            .when((comma > 0) & (dot > 0), F.replace(t, F.lit(","), F.lit("")))
            .when(comma > 0, F.when(t.rlike(",[^,]{1,2}$"), F.replace(t, F.lit(","), F.lit("."))).otherwise(F.replace(t, F.lit(","), F.lit(""))))
            .when(t.rlike(r"^[0-9]{1,3}(?:\.[0-9]{3})+(?:\.[0-9]{1,2})?$"), F.replace(t, F.lit("."), F.lit("")))
            .otherwise(t)
        )
        number = F.regexp_replace(plain, "[^0-9.]", "").try_cast("decimal(28,6)")
        return F.round(number if multiplier is None else number * multiplier, 2).try_cast("decimal(20,2)")

    return once(F.regexp_replace(c, r"\s+", ""), read)


def _digits(c: Column) -> Column:
    """Has a text a digit? A cheap test in front of the patterns, which most texts without numbers never meet."""
    return c.rlike("[0-9]")


def prices(c: Column) -> Column:
    """array of struct(amount, monthly) of the prices in a text, in order; none where the price is on request.

    monthly: rent words between 30 characters before and 60 after the end of the match. Ends come from the lengths of what lies between the matches.
    """

    def read(t: Column) -> Column:
        matches = F.regexp_extract_all(t, F.lit(f"({_PRICE})"), 1)
        between = F.transform(F.split(t, _PRICE, -1), lambda x: F.length(x))
        ends = F.transform(matches, lambda m, i: F.aggregate(F.slice(between, 1, i + 1), F.lit(0), lambda a, b: a + b) + F.aggregate(F.transform(F.slice(matches, 1, i + 1), lambda x: F.length(x)), F.lit(0), lambda a, b: a + b))

        def one(m: Column, end: Column) -> Column:
            around = F.substring(t, F.greatest(end - 30, F.lit(0)) + 1, end + 60 - F.greatest(end - 30, F.lit(0)))
            million = m.rlike(f"{P.I}million")
            amount = token(F.regexp_extract(m, "^([0-9][0-9 .,]*)", 1), F.when(million, F.lit(1_000_000)).otherwise(F.lit(1)).cast("decimal(8,0)"))
            return F.struct(amount.alias("amount"), (around.rlike(P.RENT) | around.rlike(P.MONTHLY)).alias("monthly"))

        return F.filter(F.zip_with(matches, ends, one), lambda x: x["amount"].isNotNull())

    none = F.array().cast("array<struct<amount:decimal(20,2),monthly:boolean>>")
    alone = F.array(F.struct(F.regexp_replace(c, "[^0-9]+", "").try_cast("decimal(20,2)").alias("amount"), F.contains(c, F.lit("/")).alias("monthly")))
    return F.when(c.isNull() | ~_digits(c), none).when((F.length(c) <= 24) & c.rlike(_PRICE_ALONE), alone).when(~c.rlike(_PRICE) | c.rlike(P.ON_REQUEST), none).otherwise(once(c, read))


def _preferred(found: Column) -> Column:
    """The prices that are not monthly, or all if all are."""
    return once(F.filter(found, lambda x: ~x["monthly"]), lambda x: F.when(F.size(x) > 0, x).otherwise(found))


def first_of(values: list[Column], read, kind: str) -> Column:
    """The first of read(value) that is not null, value by value; read is put into the plan once, however many values there are, and runs until it has one."""
    return F.aggregate(F.array(*values), F.lit(None).cast(kind), lambda found, c: F.coalesce(found, read(c)))


def _in(x: Column, bounds: tuple) -> Column:
    return x.between(F.lit(bounds[0]), F.lit(bounds[1]))


def any_decimal(c: Column, found: Column | None = None) -> Column:
    """The first price that is not monthly, else the first price, else the first number. found: the text's prices, where they are known."""
    return once(prices(c) if found is None else found, lambda p: F.coalesce(F.get(_preferred(p), F.lit(0))["amount"], token(filled(F.regexp_extract(c, f"({P.BARE_NUMBER})", 1)))))


def any_price(c: Column) -> Column:
    """The first price that is not monthly, else the first price."""
    return once(prices(c), lambda p: F.get(_preferred(p), F.lit(0))["amount"])


def price(values: list[Column], listing_type: Column, found: Column | None = None) -> Column:
    """The first price within the listing type's range, text by text; a text that is a number alone counts too. found: the first text's prices, where they are known."""
    rent = listing_type == "rent"

    def ok(x: Column) -> Column:
        return F.when(rent, _in(x, P.RENT_PRICE)).otherwise(_in(x, P.SALE_PRICE))

    def read(c: Column, found: Column | None = None) -> Column:
        listed = once(prices(c) if found is None else found, lambda p: F.get(F.filter(F.when(rent, p).otherwise(_preferred(p)), lambda x: ok(x["amount"])), F.lit(0))["amount"])
        bare = F.when(c.rlike(f"^(?:{P.BARE_PRICE})$"), token(c))
        return F.coalesce(listed, once(bare, lambda x: F.when(ok(x), x)))

    if found is None:
        return first_of(values, read, "decimal(20,2)")
    return F.coalesce(read(values[0], found), *(read(v) for v in values[1:]))


def surface(values: list[Column]) -> Column:
    """The first surface in range, text by text: numbers with a unit, then numbers after a keyword, then a number alone."""

    def read(c: Column) -> Column:
        listed = F.concat(F.regexp_extract_all(c, F.lit(P.AREA), 1), F.regexp_extract_all(c, F.lit(P.AREA_AFTER), 1))
        first = F.get(F.filter(F.transform(listed, lambda x: token(x)), lambda x: _in(x, P.SURFACE)), F.lit(0))
        bare = F.when(c.rlike(r"^[0-9]+(?:[,.][0-9]{1,2})?$"), token(c))
        return F.when(_digits(c), F.coalesce(first, once(bare, lambda x: F.when(_in(x, P.SURFACE), x))))

    return first_of(values, read, "decimal(20,2)")


def _whole(c: Column, pattern: str, group: int = 1) -> Column:
    """The whole number that a pattern captures. Without one the cast meets a null: try_cast of an empty text raises an error and catches it, which costs more than the parsing."""
    return found(c, pattern, group).try_cast("int")


def _count(c: Column, pattern: str, bounds: tuple, group: int = 1) -> Column:
    return once(F.when(_digits(c), _whole(c, pattern, group)), lambda n: F.when(_in(n, bounds), n))


def _any(values: list[Column], pattern: str) -> Column:
    return F.exists(F.array(*values), lambda c: F.coalesce(c.rlike(pattern), F.lit(False)))


def bedrooms(values: list[Column]) -> Column:
    """0 for a studio anywhere, else the count of bedrooms, else the count of rooms less one."""
    pieces = first_of(values, lambda c: _count(c, P.PIECES, (1, P.ROOMS[1] + 2)), "int") - 1
    return F.when(_any(values, P.STUDIO), F.lit(0)).otherwise(F.coalesce(first_of(values, lambda c: _count(c, P.BEDROOMS, P.ROOMS), "int"), pieces))


def bathrooms(values: list[Column]) -> Column:
    """The count of bathrooms, else 1 where the word stands alone."""
    return F.coalesce(first_of(values, lambda c: _count(c, P.BATHROOMS, P.ROOMS), "int"), F.when(_any(values, P.ONE_BATHROOM), F.lit(1)))


def floor(c: Column, focused: bool = False) -> Column:
    """0 for a ground floor, else the number with a floor word (an explicit 0 is null); focused: a number alone from 1 on as well."""
    n = F.coalesce(_whole(c, P.FLOOR_ANY, 1), _whole(c, P.FLOOR_ANY, 2))
    worded = once(n, lambda x: F.when(_in(x, (1, P.FLOOR[1])), x))
    alone = integer(c, (1, P.FLOOR[1])) if focused else F.lit(None).cast("int")
    return F.when(c.rlike(P.GROUND), F.lit(0)).when(_digits(c) & c.rlike(P.FLOOR_ANY), worded).otherwise(alone)


def year(values: list[Column], current_year: int) -> Column:
    """The year after a building keyword, else any year; not after current_year and at most 200 years before."""
    def read(c: Column) -> Column:
        return _count(F.when(_digits(c) & c.rlike(P.BUILT), F.regexp_extract(c, P.BUILT, 1)).otherwise(F.regexp_extract(c, P.YEAR, 1)), "^([0-9]+)$", (max(1800, current_year - 200), current_year))

    return first_of(values, read, "int")


def integer(c: Column, bounds: tuple) -> Column:
    """A whole number in range."""
    return once(any_decimal(c), lambda x: F.when((x == F.floor(x)) & _in(x, bounds), x.cast("int")))


def plain_decimal(c: Column, low=None, high=None, digits: int | None = None) -> Column:
    """A text that is a decimal number, comma or point, in range; rounded half up."""
    def read(x: Column) -> Column:
        ok = F.lit(True) if low is None else x >= low
        ok = ok if high is None else ok & (x <= high)
        return F.when(ok, x if digits is None else F.round(x, digits))

    return once(F.replace(c, F.lit(","), F.lit(".")).try_cast("decimal(28,10)"), read)


def coordinate(c: Column, bound: int) -> Column:
    return plain_decimal(c, -bound, bound, 6).cast("decimal(9,6)")


def ratio(a: Column, b: Column, digits: int, kind: str) -> Column:
    """a / b, half up; null for a missing or zero divisor."""
    return F.round(F.try_divide(a.cast("decimal(20,2)"), b.cast("decimal(20,2)")), digits).cast(kind)


def price_per_m2(price: Column, surface: Column, property_type: Column) -> Column:
    """price / surface where it lies in the property type's range."""

    def read(value: Column) -> Column:
        ok = _in(value, P.PPM2_OTHER)
        for kind, bounds in P.PPM2.items():
            ok = F.when(property_type == kind, _in(value, bounds)).otherwise(ok)
        return F.when(ok, value)

    return once(ratio(price, F.when(surface > 0, surface), 2, "decimal(20,2)"), read)
