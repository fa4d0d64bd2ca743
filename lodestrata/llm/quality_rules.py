"""Quality rules (DataFrame functions only): word and line counts, then distance from language references.

The character classes and the common words of a document are counted into two histograms, each compared with the reference of
the document's language by the Jensen-Shannon distance (base 2, 0 to 1). A document far from its reference is rejected; each
comparison applies only from a least number of words, as short texts give ragged histograms. The references are derived from labelled documents
(`references`); where the language is null the nearest one counts, and a document in a language without a reference is judged by the base rules
alone. Everything is computed within the row: no shuffle, and a text is split once.

Defined cases: a null text has no words and fails the base rules, as does an empty one; very long texts take the same path
(n log n in the words); ties and repeated rows do not matter, rows are judged alone; an empty table gives an empty result;
a missing lang column counts as null; further columns pass through `judge` untouched unless they carry a result's name,
in which case they are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# What `python -m lodestrata.llm.references /root/testdata/sf0.1` prints; shares of character classes in good prose
# (lower case, upper case, digits, blanks, punctuation, symbols, other).
CLASSES = {
    "de": (0.8102, 0.01289, 0.00042, 0.15474, 0.02174, 2e-05, 0.0),
    "en": (0.79526, 0.01383, 0.00058, 0.16661, 0.0237, 2e-05, 0.0),
    "es": (0.80147, 0.0134, 0.00056, 0.16167, 0.02288, 1e-05, 0.0),
    "fr": (0.79445, 0.01413, 0.00066, 0.16683, 0.0239, 3e-05, 0.0),
}
# Fixed values, by the same command: common words of each language with their shares of running text, in per mille.
WORDS = {
    "de": {"der": 62, "die": 37, "und": 26, "in": 20, "den": 16, "von": 13, "zu": 11, "das": 11, "mit": 9, "sich": 9, "des": 8, "auf": 7, "für": 7, "ist": 6, "dem": 6, "im": 6, "nicht": 5, "ein": 5},
    "en": {"the": 63, "of": 36, "and": 27, "to": 20, "a": 16, "in": 14, "is": 12, "that": 11, "it": 9, "for": 9, "was": 8, "on": 7, "with": 7, "as": 6, "by": 6, "be": 5, "this": 5, "are": 5},
    "es": {"de": 62, "la": 37, "que": 25, "el": 20, "en": 16, "y": 14, "los": 12, "se": 10, "las": 9, "del": 9, "un": 8, "por": 8, "no": 7, "con": 6, "su": 6, "una": 6, "para": 5, "al": 5},
    "fr": {"de": 62, "la": 38, "le": 25, "et": 21, "les": 16, "des": 14, "en": 12, "un": 11, "du": 9, "une": 8, "que": 8, "pour": 7, "est": 7, "dans": 6, "qui": 6, "par": 5, "sur": 5, "pas": 5},
}
#: Least words for either comparison, and the largest distances that pass. The second bound is what the same command prints; a text with none of
#: the common words lies at 0.38 from each language's reference, so a bound of that or more would reject no foreign text.
CLASS_WORDS, CLASS_DISTANCE = 20, 0.18
COMMON_WORDS, COMMON_DISTANCE = 60, 0.28
LEAST_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5


def _once(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words that lie in a 5-word window found twice or more (the first time included)."""

    def hashed(w: Column) -> Column:
        return F.when(F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = _once(ordered, lambda s: F.filter(s, lambda x, i: x["h"].eqNullSafe(F.get(s, i - 1)["h"]) | x["h"].eqNullSafe(F.get(s, i + 1)["h"])))
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        steps = _once(places, lambda p: F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    return _once(_once(words, hashed), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))).cast("long")


def _distance(shares: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms of equal length, each with sum 1."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(shares, reference, lambda p, q: (part(p, (p + q) / 2) + part(q, (p + q) / 2)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)))


def _normal(values) -> list[float]:
    values = list(values)
    return [v / sum(values) for v in values]


def _by_language(lang: Column, of) -> Column:
    """of(language) for a language with a reference, the least over all where the language is null, else null."""
    every = {k: of(k) for k in CLASSES}
    out = F.when(lang == next(iter(every)), every[next(iter(every))])
    for k in list(every)[1:]:
        out = out.when(lang == k, every[k])
    return out.when(lang.isNull(), F.least(*every.values()))


def measured(docs: DataFrame) -> DataFrame:
    """docs with the base counts, and what the comparisons need: _lang, _n0 to _n6 (characters left by the chain below), _plain (bare words in lower case) and _n_plain."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    blank, lower = rf"[{common.BLANKS}]+", r"\p{Ll}+"
    text = common.text_or_empty()
    df = docs.withColumns({"_text": text, "_lang": lang})
    # what is left of the text as its classes of characters are taken away one after another
    df = df.withColumn("_solid", F.regexp_replace("_text", blank, ""))
    df = df.withColumn("_nolower", F.regexp_replace("_solid", lower, ""))
    df = df.withColumn("_noupper", F.regexp_replace("_nolower", r"\p{Lu}+", ""))
    df = df.withColumn("_nodigit", F.regexp_replace("_noupper", r"\p{Nd}+", ""))
    df = df.withColumn("_nopunct", F.regexp_replace("_nodigit", r"[.,;:!?'\"()¿¡«»-]+", ""))
    df = df.withColumn("_nosymbol", F.regexp_replace("_nopunct", r"[\p{S}\p{P}]+", ""))
    chain = ["_text", "_solid", "_nolower", "_noupper", "_nodigit", "_nopunct", "_nosymbol"]
    df = df.withColumns({f"_n{i}": F.length(c).cast("long") for i, c in enumerate(chain)})
    df = df.withColumn("_words", F.array_remove(F.split(F.translate("_text", "\t\n\x0b\x0c\r", "     "), " "), ""))
    df = df.withColumn("_plain", F.array_remove(F.split(F.translate(F.lower("_text"), "\t\n\x0b\x0c\r.,;:!?", "           "), " "), ""))
    filled = F.filter(F.split("_text", "\n"), lambda x: x.rlike(rf"[^{common.BLANKS}]"))
    return df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.col("_n1"),
            "n_symbols": (F.col("_n5") - F.length(F.translate("_nopunct", "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": _once(filled, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words")),
            "_n_plain": F.size("_plain"),
        }
    )


def class_counts() -> list[Column]:
    """Of measured rows the characters of each class: lower case, upper case, digits, blanks, punctuation, symbols, other."""
    n = [F.col(f"_n{i}") for i in range(7)]
    return [n[1] - n[2], n[2] - n[3], n[3] - n[4], n[0] - n[1], n[4] - n[5], n[5] - n[6], n[6]]


def judge(docs: DataFrame, class_distance: float = CLASS_DISTANCE, common_distance: float = COMMON_DISTANCE) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_js, common_js and kept."""
    df = measured(docs).withColumn("_known", F.filter("_plain", lambda w: w.isin(sorted({w for k in WORDS.values() for w in k}))))
    df = df.withColumn("_classes", F.transform(F.array(*class_counts()), lambda c: c / F.greatest(F.col("_n0"), F.lit(1))))
    df = df.withColumn("class_js", F.when(F.col("n_words") >= CLASS_WORDS, _by_language(F.col("_lang"), lambda k: _distance(F.col("_classes"), F.array(*map(F.lit, _normal(CLASSES[k])))))))

    def common_js(k: str) -> Column:
        reference = _normal([*WORDS[k].values(), 1000 - sum(WORDS[k].values())])
        known = _once(F.col("_known"), lambda x: F.transform(F.array(*map(F.lit, WORDS[k])), lambda w: F.size(x) - F.size(F.array_remove(x, w))))
        total = F.greatest(F.col("_n_plain"), F.lit(1))
        shares = _once(known, lambda c: F.transform(F.concat(c, F.array(total - F.aggregate(c, F.lit(0), lambda a, b: a + b))), lambda x: x / total))
        return _distance(shares, F.array(*map(F.lit, reference)))

    df = df.withColumn("common_js", F.when(F.col("_n_plain") >= COMMON_WORDS, _by_language(F.col("_lang"), common_js)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    near = F.coalesce(F.col("class_js") <= class_distance, F.lit(True)) & F.coalesce(F.col("common_js") <= common_distance, F.lit(True))
    df = df.withColumns({"base_failed": failed, "kept": ~failed & near})
    return df.drop(*[c for c in df.columns if c.startswith("_") and c not in docs.columns])


def select(docs: DataFrame) -> DataFrame:
    """The documents, all columns, that the rules keep."""
    # the partition's number keeps the filter above the projection: pushed below, it would compute every step anew at each use
    judged = judge(docs).withColumn("_partition", F.spark_partition_id())
    return judged.where(F.col("kept") & (F.col("_partition") >= 0)).select(*docs.columns)


def op7_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.read_documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES = {"op7_divergence": op7_divergence}


def _sql() -> str:
    """The same rules in DuckDB SQL; the distances are written out from the same references."""

    def distance(shares: str, reference: list[float]) -> str:
        part = lambda x: f"case when {x} > 0 then {x} * log2({x} / ((z[1] + z[2]) / 2)) else 0 end"
        return f"sqrt(greatest(0, list_sum(list_transform(list_zip({shares}, {reference!r}), lambda z: ({part('z[1]')} + {part('z[2]')}) / 2))))"

    def by_language(of) -> str:
        return "case " + " ".join(f"when lang = '{k}' then {of(k)}" for k in CLASSES) + f" when lang is null then least({', '.join(of(k) for k in CLASSES)}) end"

    def common_js(k: str) -> str:
        counts = ", ".join(f"len(list_filter(plain, lambda x: x = '{w}'))" for w in WORDS[k])
        shares = f"list_transform(list_concat([{counts}], [len(plain) - len(list_filter(plain, lambda x: x in {tuple(WORDS[k])!r}))]), lambda c: c / greatest(len(plain), 1)::double)"
        return distance(shares, _normal([*WORDS[k].values(), 1000 - sum(WORDS[k].values())]))

    blank = r"[\x20\x09-\x0D]"
    return rf"""
    with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, lang from documents),
    a as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words, regexp_extract_all(lower(t), '[^\x20\x09-\x0D.,;:!?]+') as plain, regexp_replace(t, '{blank}+', '', 'g') as c1,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as filled from d),
    b as (select *, regexp_replace(c1, '\p{{Ll}}+', '', 'g') as c2 from a), c as (select *, regexp_replace(c2, '\p{{Lu}}+', '', 'g') as c3 from b), e as (select *, regexp_replace(c3, '\p{{Nd}}+', '', 'g') as c4 from c),
    f as (select *, regexp_replace(c4, '[.,;:!?''\x22()¿¡«»-]+', '', 'g') as c5 from e), g as (select *, regexp_replace(c5, '[\pS\pP]+', '', 'g') as c6 from f),
    w as (select r, unnest(words) as w, generate_subscripts(words, 1) as i from a),
    n as (select r, i, w || chr(1) || lead(w, 1) over s || chr(1) || lead(w, 2) over s || chr(1) || lead(w, 3) over s || chr(1) || lead(w, 4) over s as five from w window s as (partition by r order by i)),
    o as (select r, i, count(*) over (partition by r, five) as often from n where five is not null),
    p as (select r, count(distinct i + j) as covered from o, range(5) k(j) where often > 1 group by r),
    q as (select g.*, coalesce(covered, 0) as covered, len(words) as nw, list_transform([length(c1) - length(c2), length(c2) - length(c3), length(c3) - length(c4), length(t) - length(c1), length(c4) - length(c5), length(c5) - length(c6), length(c6)], lambda c: c / greatest(length(t), 1)::double) as shares
          from g left join p using (r)),
    v as (select *, nw < {LEAST_WORDS} or 100 * covered > {REPEAT_PERCENT} * nw as base_failed, case when nw >= {CLASS_WORDS} then {by_language(lambda k: distance('shares', _normal(CLASSES[k])))} end as class_js,
            case when len(plain) >= {COMMON_WORDS} then {by_language(common_js)} end as common_js from q)
    select doc_id, nw as n_words, length(c1) as word_chars, length(c5) - length(regexp_replace(c5, '[#*$%&|<>]', '', 'g')) as n_symbols, len(filled) - len(list_distinct(filled)) as n_dup_lines, covered as n_repeat_words, base_failed,
      not base_failed and coalesce(class_js <= {CLASS_DISTANCE}, true) and coalesce(common_js <= {COMMON_DISTANCE}, true) as kept from v"""


ORACLES = {"op7_divergence": _sql()}
