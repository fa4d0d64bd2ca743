"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over the text: at-signs, digits, plus signs, URL schemes and identifier cues.
Local parsers expand each anchor to both sides, as far as the kind's characters go, and validate what they find. An expansion
never goes back behind the end of the kind's match before it, so the work is linear in the text. Kinds: email, ip, card, phone
as four fixed patterns define them; the method adds `account` (an IBAN with a right check sum, or a cue such as "account no."
and its number), `secret` (a cue such as "token =" and a quoted or long value) and `url` (a scheme and a host, with user
information or as mailto: or tel:).

Positions are code points, ends exclusive. Defined cases: a null text counts as empty and gives no spans; very long texts and
texts full of anchors take linear time; ties cannot occur within a kind (spans do not overlap there), and spans of
different kinds may overlap and are all given; repeated rows are judged alone; an empty table gives an empty result; further
columns pass through `redact`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

KINDS = ("email", "ip", "card", "phone", "account", "secret", "url")
BASE = KINDS[:4]
# Cues, in lower case, by what the parser after them expects.
ACCOUNT_CUES = ("iban", "account number", "account no", "acct no", "kontonummer", "numéro de compte", "número de cuenta")
SECRET_CUES = ("token", "api_key", "apikey", "api key", "secret", "password", "passwd")
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "tel:")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NUMBER = re.compile(r"[ :.#=]{1,4}([0-9][0-9 -]{4,}[0-9])")
_IBAN_AFTER = re.compile(r"[ :=]{1,3}")
_SECRET = re.compile(r"""\s{0,2}[:=]\s{0,2}(?:"([^"\s]{8,})"|'([^'\s]{8,})'|([A-Za-z0-9+/_.-]{16,}))""")
_URL = re.compile(r"[^\s<>\"']+")


def automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for word, kind in [("@", "@"), ("+", "+"), *((d, "0") for d in "0123456789"), *((c, "account") for c in ACCOUNT_CUES), *((c, "secret") for c in SECRET_CUES), *((s, "url") for s in SCHEMES)]:
        out.add_word(word, (kind, len(word)))
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    doubled = (int(x) for x in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(x * 2 - 9 * (x > 4) for x in doubled)) % 10 == 0


def iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def spans(text: str, finder: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) by kind as in KINDS, then start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email_end = chain_end = dotted_end = 0
    lower = text.lower()
    if len(lower) != len(text):  # a few letters grow in lower case: only ASCII is lowered then
        lower = "".join(c.lower() if c < "\x80" else c for c in text)
    for last, (kind, length) in finder.iter(lower):
        if kind == "0":
            if last >= dotted_end:
                whole = _DOTTED.match(text, last)
                dotted_end = whole.end()
                at = last
                while at < dotted_end and (m := _QUAD.match(text, at, dotted_end)):
                    if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                        found["ip"].append(m.span())
                    at = m.end() + 1
            if last >= chain_end:
                if m := _CHAIN.match(text, last):
                    chain_end = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append(m.span())
                else:
                    chain_end = last + 1
        elif kind == "@":
            start = last
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < last and (m := _DOMAIN.match(text, last)):
                email_end = m.end()
                found["email"].append((start, email_end))
        elif kind == "+":
            if (m := _PHONE.match(text, last)) and 8 <= sum(c in _DIGITS for c in m[0]) <= 15:
                found["phone"].append(m.span())
        elif kind == "account":
            gap = _IBAN_AFTER.match(text, last + 1)
            if (m := _IBAN.match(text, gap.end() if gap else last + 1)) and iban(m[0]):
                found["account"].append(m.span())
            elif m := _NUMBER.match(text, last + 1):
                found["account"].append(m.span(1))
        elif kind == "secret":
            if m := _SECRET.match(text, last + 1):
                found["secret"].append(m.span(m.lastindex))
        elif kind == "url":
            start = last - length + 1
            m = _URL.match(text, last + 1)
            if m and (text[start:].startswith(("mailto:", "tel:"), 0) if length < 8 and text[last] == ":" else "@" in m[0].split("/")[0]):
                found["url"].append((start, m.end()))
    out = []
    for kind in KINDS:
        end = 0
        for a, b in sorted(set(found[kind])):
            if a >= end or kind in BASE:
                out.append((kind, a, b))
                end = b
    return out


def _joined(items: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in items)


def _texts(batches, finder):
    for batch in batches:
        yield batch, [spans(t or "", finder) for t in batch.column("text").to_pylist()]


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span of the text replaced by [KIND]; where spans overlap, one label of the first kind covers them all.

    n_chars, if there, is counted anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = automaton()
        for batch, each in _texts(batches, finder):
            texts = []
            for text, found in zip(batch.column("text").to_pylist(), each, strict=True):
                if found:
                    out, at = [], 0
                    merged: list[list] = []
                    for kind, a, b in sorted(found, key=lambda x: (x[1], KINDS.index(x[0]))):
                        if merged and a < merged[-1][2]:
                            merged[-1][2] = max(merged[-1][2], b)
                        else:
                            merged.append([kind, a, b])
                    for kind, a, b in merged:
                        out += [text[at:a], f"[{kind.upper()}]"]
                        at = b
                    text = "".join([*out, text[at:]])
                texts.append(text)
            i = batch.schema.get_field_index("text")
            yield batch.set_column(i, batch.schema.field(i), pa.array(texts, batch.schema.field(i).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def find(docs: DataFrame) -> DataFrame:
    """doc_id, the four counts, base_sha256 and spans of every document."""
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(f"n_{k}", T.LongType()) for k in BASE), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = automaton()
        for batch, each in _texts(batches, finder):
            base = [[s for s in found if s[0] in BASE] for found in each]
            counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in BASE]
            hashes = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array(hashes, pa.string()), pa.array([_joined(f) for f in each], pa.string())], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op8_anchor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(common.read_documents(spark, sf_dir))


QUERIES = {"op8_anchor_expansion": op8_anchor_expansion}
ORACLES: dict[str, str] = {}
