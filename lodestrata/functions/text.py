"""Text sanitation as column expressions: entities, mojibake, tags, personal data, blanks, spellings of missing values."""

from __future__ import annotations

import html
import json
import re
import unicodedata
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P

#: Everything that Python's \s matches, for Java.
SPACES = r"[\s\x1c-\x1f\x85   -     　]+"
#: Between the texts of a row where they are looked at together; sanitizing leaves it alone.
BAR = "\x01"
_LETTER = r"[\x21-\x25\x27-\x3b\x3d-\x3f\x41-\x7e\u00a1-\u00c1\u00c4-\u024f]"  # visible, and neither & < @ nor a sign of mojibake
_PLAIN_TEXT = rf"^{_LETTER}++(?:[ {BAR}]{_LETTER}++)*+\z"
_PHONE_LIKE = r"(?:0|212)[ .\-]?[567][0-9 .\-]{7}"  # in every text that has a match of P.PHONE and no blank but " "
_MISSING_LIKE = rf"(?i)(?:^|{BAR}) *(?:(?:{'|'.join(map(re.escape, P.NULLS))}) *)?(?:{BAR}|\z)"


def _plain(c: str) -> str:
    """A character without its accents, compatibility forms resolved."""
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


# by rule: letters and digits beyond ASCII that are one ASCII letter or digit without accents
_ACCENTED = "".join(c for c in map(chr, range(0x80, 0xFFFF)) if len(_plain(c)) == 1 and _plain(c).isascii() and _plain(c).isalnum())
_PLAIN = "".join(map(_plain, _ACCENTED))
# by rule: the character references of HTML, with and without the semicolon
_NAMED = json.dumps({k: v for k, v in html5.items() if k.endswith(";")})
_BARE = {k: v for k, v in html5.items() if not k.endswith(";")}
_BARE_NAMES = "^(?:" + "|".join(sorted(_BARE, key=lambda k: (-len(k), k))) + ")"
# by rule: numbers that do not stand for their own code point
_NUMBERS = {str(n): html.unescape(f"&#{n};") for n in (*range(0x100), *range(0xFDD0, 0xFDF0), *(p << 16 | x for p in range(17) for x in (0xFFFE, 0xFFFF))) if html.unescape(f"&#{n};") != chr(n)}


def _table(values: str) -> Column:
    """A constant map; as one literal, which the optimizer folds, it costs a plan little."""
    return F.from_json(F.lit(values), "map<string,string>")


def once(value: Column, body) -> Column:
    """body(value) with value computed once, however often body uses it: keeps plans small where a parsed text is looked at several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def filled(c: Column) -> Column:
    """c, null if empty."""
    return once(c, lambda x: F.when(x != "", x))


def unescape(c: Column) -> Column:
    """HTML character references resolved, as the standard library's html.unescape does: named ones, bare old ones by their longest prefix, numbers."""

    def number(piece: Column) -> Column:
        """The number of a numeric reference, null if there is none; as large as it needs to be to be out of range."""
        digits, six = F.regexp_extract(piece, "^#0*([0-9]{1,8})", 1), F.regexp_extract(piece, "^#[xX]0*([0-9a-fA-F]{1,7})", 1)
        zero = F.when(piece.rlike("^#(?:[0-9]|[xX][0-9a-fA-F])"), F.lit(0))
        return F.coalesce(F.when(digits != "", digits.cast("bigint")), F.when(six != "", F.conv(six, 16, 10).cast("bigint")), zero)

    def character(n: Column) -> Column:
        beyond = F.when((n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit("\ufffd"))
        own = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.coalesce(F.try_element_at(_table(json.dumps(_NUMBERS)), n.cast("string")), beyond, own)

    def rest(piece: Column, found: Column) -> Column:
        return F.substring(piece, F.length(found) + 1, F.length(piece))

    def resolved(piece: Column) -> Column:
        """A text that follows an ampersand, with the ampersand."""
        numeric = F.regexp_extract(piece, "^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
        named, bare = F.regexp_extract(piece, r"^[^\t\n\f <&#;]{1,32};", 0), F.regexp_extract(piece, _BARE_NAMES, 0)
        by_number = once(number(piece), lambda n: F.concat(character(n), rest(piece, numeric)))
        by_name = F.concat(F.try_element_at(_table(_NAMED), named), rest(piece, named))
        by_prefix = F.concat(F.try_element_at(_table(json.dumps(_BARE)), bare), rest(piece, bare))
        return F.when(piece.startswith("#"), F.when(numeric != "", by_number).otherwise(F.concat(F.lit("&"), piece))).otherwise(F.coalesce(by_name, by_prefix, F.concat(F.lit("&"), piece)))

    def read(t: Column) -> Column:
        pieces = F.transform(F.split(t, "&", -1), lambda x, i: F.when(i == 0, x).otherwise(resolved(x)))
        return F.when(F.contains(t, F.lit("&")), F.array_join(pieces, "")).otherwise(t)

    return once(c, read)


def repair_mojibake(c: Column) -> Column:
    """Text whose UTF-8 bytes were read as Latin-1, read again; anything else as it is."""
    def read(t: Column) -> Column:
        raw = F.encode(F.when(t.rlike("[ÃÂ]") & t.rlike(r"^[\x00-\xFF]*$"), t), "ISO-8859-1").cast("string")
        return once(raw, lambda r: F.when(F.is_valid_utf8(r), r).otherwise(t))

    return once(c, read)


def redact(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, P.EMAIL, "[REDACTED_EMAIL]"), P.PHONE, "[REDACTED_PHONE]")


def has_personal_data(c: Column) -> Column:
    return F.coalesce(c.rlike(P.EMAIL) | c.rlike(P.PHONE), F.lit(False))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACES, " "))


def _needs_nothing(c: Column) -> Column:
    """Does sanitizing leave a text as it is? Never true where it does not; most texts pass these two tests and meet no others."""
    return c.rlike(_PLAIN_TEXT) & ~c.rlike(_PHONE_LIKE)


def sanitize(c: Column) -> Column:
    """Entities, mojibake, tags, personal data, blanks; an empty text is null."""

    def read(t: Column) -> Column:
        out = F.regexp_replace(repair_mojibake(unescape(t)), "<[^>]+>", " ")
        return F.when(_needs_nothing(t), t).otherwise(filled(squeeze(redact(squeeze(out)))))

    return once(c.cast("string"), read)


def each(df: DataFrame, columns: dict[str, Column], body, unless=None) -> DataFrame:
    """df with these columns passed through body: one expression over their array, so that the plan does not grow with their number.

    unless: a test of all texts of a row at once, joined by BAR; where it holds, body would change none of them.
    """
    texts = F.array(*(c.cast("string") for c in columns.values()))
    changed = F.transform(texts, body)
    if unless:
        changed = once(F.concat_ws(BAR, texts), lambda whole: F.when(unless(whole), texts).otherwise(F.transform(texts, body)))
    return df.withColumn("_texts", changed).withColumns({c: F.get("_texts", F.lit(i)) for i, c in enumerate(columns)}).drop("_texts")


def sanitized(df: DataFrame, columns: list[str]) -> DataFrame:
    return each(df, {c: F.col(c) for c in columns}, sanitize, _needs_nothing)


def all_known(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with these columns of sanitized texts, null where they spell a missing value."""
    return each(df, columns, known, lambda whole: ~whole.rlike(_MISSING_LIKE))


def known(c: Column) -> Column:
    """A sanitized text, null if it spells a missing value."""
    return once(c, lambda x: F.when(~F.lower(F.trim(x)).isin("", *P.NULLS), x))


def clean(c: Column) -> Column:
    return known(sanitize(c))


def without_accents(c: Column) -> Column:
    """Accents and combining marks gone, single compatibility forms resolved; ligatures and fractions stay as they are."""
    return once(c, lambda x: F.when(x.rlike(r"^\p{ASCII}*+\z"), x).otherwise(F.regexp_replace(F.translate(x, _ACCENTED, _PLAIN), r"\p{M}+", "")))


def key(c: Column) -> Column:
    """Lower case, no accents, only letters and digits between single blanks."""
    return F.trim(F.regexp_replace(F.lower(without_accents(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", " "))


def stripped(c: Column) -> Column:
    """Without blanks, commas and hyphens at both ends."""
    return F.regexp_replace(squeeze(c), "^[ ,-]+|[ ,-]+$", "")


def low(c: Column) -> Column:
    """A text in lower case, for `maybe`; null if it has letters beyond Latin-1, of which case-insensitive patterns take some for others (long s, Kelvin sign, dotted and dotless i)."""
    return F.when(c.rlike(r"^[\x00-\xFF]*+\z"), F.lower(c))


def maybe(lower: Column, stems: tuple[str, ...]) -> Column:
    """A cheap test in front of a pattern: false only where the text (lower: its `low`) has none of the stems, one of which is in every match."""

    def read(x: Column) -> Column:
        out = F.contains(x, F.lit(stems[0]))
        for s in stems[1:]:
            out = out | F.contains(x, F.lit(s))
        return F.coalesce(out, F.lit(True))

    return once(lower, read)


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one."""
    return filled(F.regexp_extract(c, pattern, group))


def python_escape(words: tuple[str, ...]) -> str:
    return "|".join(re.escape(w) for w in words)
