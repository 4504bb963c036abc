"""Scalar functions on text columns; JVM expressions unless said otherwise."""

from __future__ import annotations

import html
import re
import urllib.parse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Spaces that titles know, and marks of direction that vanish into them.
ODD_SPACES = "[_ \\u00a0\\u200e\\u200f\\u2028\\u202a-\\u202e\\u3000]+"
PERCENT = {"#": "%23", "<": "%3C", ">": "%3E", "[": "%5B", "]": "%5D", "{": "%7B", "}": "%7D", "|": "%7C", "^": "%5E", "?": "%3F", '"': "%22", "\\": "%5C", "`": "%60"}


def clean_space(x: Column) -> Column:
    """Underscores and odd spaces become one space each run; ends are trimmed."""
    return F.trim(F.regexp_replace(x, ODD_SPACES, " "))


def wiki_encode(x: Column) -> Column:
    """A title as part of an address: clean spaces to underscores, what an address can't hold percent-encoded."""
    out = F.replace(clean_space(x), F.lit(" "), F.lit("_"))
    out = F.replace(out, F.lit("%"), F.lit("%25"))
    for a, b in PERCENT.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def wiki_decode(x: Column) -> Column:
    """The title that an address names. A plus sign is itself, not a space."""
    return clean_space(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))))


def remove_emphasis(x: Column) -> Column:
    for n in (5, 3, 2):
        x = F.regexp_replace(x, f"'{{{n}}}(.*?)'{{{n}}}", "$1")
    return x


def capitalize(x: Column) -> Column:
    return F.concat(F.upper(F.substring(x, 1, 1)), x.substr(F.lit(2), F.length(x)))


def uncapitalize(x: Column) -> Column:
    return F.concat(F.lower(F.substring(x, 1, 1)), x.substr(F.lit(2), F.length(x)))


def camel_case(x: Column, separators: str = r"[_\s/:\-]+") -> Column:
    """lower case first, then each later part with a capital."""
    parts = F.filter(F.split(F.lower(F.trim(x)), separators), lambda p: p != "")
    return uncapitalize(F.array_join(F.transform(parts, lambda p: capitalize(p)), ""))


def property_key(x: Column) -> Column:
    """The name of the property that a template key stands for: camel case, without trailing digits."""
    return F.regexp_replace(camel_case(x), r"\d+$", "")


def escape_xml(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def decode_entities(x: Column) -> Column:
    """The five entities that markup itself needs; see html_unescape for all."""
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


@F.pandas_udf(StringType())
def html_unescape(x: pd.Series) -> pd.Series:
    """All named and numeric entities."""
    return x.map(html.unescape, na_action="ignore")


def strip_tags(x: Column) -> Column:
    return F.regexp_replace(x, "<[^>]*>", "")


def turtle_escape(x: Column) -> Column:
    """Backslash, quote and white space signs; other letters stay as they are."""
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def turtle_unescape(x: Column) -> Column:
    x = F.replace(x, F.lit("\\\\"), F.lit("\u0000"))
    for a, b in (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\u0000", "\\")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def _ascii(s: str) -> str:
    return "".join(c if ord(c) < 128 else f"\\u{ord(c):04X}" if ord(c) < 0x10000 else f"\\U{ord(c):08X}" for c in s)


_CODE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})")


@F.pandas_udf(StringType())
def escape_non_ascii(x: pd.Series) -> pd.Series:
    return x.map(_ascii, na_action="ignore")


@F.pandas_udf(StringType())
def unescape_codes(x: pd.Series) -> pd.Series:
    """Numeric escapes of four and eight digits; impossible code points stay as written."""
    def one(m: re.Match) -> str:
        n = int(m[1] or m[2], 16)
        return chr(n) if n < 0x110000 and not 0xD800 <= n < 0xE000 else m[0]

    return x.map(lambda s: _CODE.sub(one, s), na_action="ignore")


@F.pandas_udf(StringType())
def to_ascii_uri(x: pd.Series) -> pd.Series:
    """Letters beyond ASCII percent-encoded, the rest untouched."""
    return x.map(lambda s: urllib.parse.quote(s, safe="".join(map(chr, range(33, 127)))), na_action="ignore")


@F.pandas_udf(StringType())
def to_iri(x: pd.Series) -> pd.Series:
    """Percent-encoded letters beyond ASCII as themselves; encoded ASCII signs and broken sequences stay."""
    def one(m: re.Match) -> str:
        try:
            text = bytes.fromhex(m[0].replace("%", "")).decode("utf-8")
        except UnicodeDecodeError:
            return m[0]
        return "".join(c if ord(c) > 127 else f"%{ord(c):02X}" for c in text)

    runs = re.compile(r"(?:%[89A-Fa-f][0-9A-Fa-f])+")
    return x.map(lambda s: runs.sub(one, s), na_action="ignore")


SCHEMES = "https?|ftps?|mailto|news|irc|sftp|gopher|telnet|nntp|svn|git|urn|ldap|gemini|bitcoin|magnet|sip|sips|xmpp"


def has_known_scheme(x: Column) -> Column:
    return x.rlike(f"^(?i:{SCHEMES}):")


def is_valid_iri(x: Column) -> Column:
    """An absolute address without the signs that none may hold."""
    return x.rlike(r'^[A-Za-z][A-Za-z0-9+.\-]*:[^\x00-\x20<>"{}|\\^`]*$')


def clean_url(x: Column) -> Column:
    """Trimmed, with a scheme; null if it isn't an address then."""
    x = F.trim(x)
    x = F.when(x.startswith("//"), F.concat(F.lit("http:"), x)).when(x.rlike("^www\\."), F.concat(F.lit("http://"), x)).otherwise(x)
    return F.when(has_known_scheme(x) & is_valid_iri(x), x)


def parse_link(x: Column, strict: bool = False) -> Column:
    """The first address in a text, bare or in brackets; if strict, only one that is all of the text."""
    found = F.regexp_extract(x, r"((?:https?|ftps?)://[^\s\]|}<\"]+|www\.[^\s\]|}<\"]+)", 1)
    alone = x.rlike(r"^\s*\[?\s*(?:(?:https?|ftps?)://|www\.)[^\s\]|}<\"]+(?:\s[^\]]*\]|\s*\])?\s*$")
    out = clean_url(F.nullif(found, F.lit("")))
    return F.when(alone, out) if strict else out


def relativize(x: Column, base: str) -> Column:
    return F.when(x.startswith(base), F.substring(x, len(base) + 1, 1 << 30)).otherwise(x)


def resource_iri(title: Column, language: Column, domain: str = "example.org") -> Column:
    return F.concat(F.lit("http://"), language, F.lit(f".{domain}/resource/"), wiki_encode(title))


def file_url(name: Column, language: Column, width: int | None = None, domain: str = "example.org") -> Column:
    """Where a media file is served, or its thumbnail of a width."""
    out = F.concat(F.lit("http://"), language, F.lit(f".{domain}/wiki/Special:FilePath/"), wiki_encode(name))
    return out if width is None else F.concat(out, F.lit(f"?width={width}"))


def short_hash(x: Column, n: int = 5) -> Column:
    return F.substring(F.md5(x), 1, n)


def fixed_hex(x: Column, width: int) -> Column:
    return F.lower(F.lpad(F.hex(x.cast("long")), width, "0"))


def iso_timestamp(x: Column) -> Column:
    return F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_timestamp(x: Column) -> Column:
    """Milliseconds since 1970; -1 for a blank or a broken one."""
    return F.coalesce(F.unix_millis(F.try_to_timestamp(F.nullif(F.trim(x), F.lit("")))), F.lit(-1))


def trim_split(x: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(x, pattern), lambda p: F.trim(p)), lambda p: p != "")


def short_text(x: Column, limit: int = 500) -> Column:
    """Whole if shorter than the limit; else the leading sentences that fit, at least the first one; trimmed."""
    sentences = F.split(x, r"(?<=\.\s)")
    start = F.struct(F.lit("").alias("text"), F.lit(False).alias("full"))

    def more(acc: Column, s: Column) -> Column:
        fits = ~acc["full"] & ((acc["text"] == "") | (F.length(acc["text"]) + F.length(s) <= limit))
        return F.struct(F.when(fits, F.concat(acc["text"], s)).otherwise(acc["text"]).alias("text"), (~fits).alias("full"))

    return F.trim(F.when(F.length(x) < limit, x).otherwise(F.aggregate(sentences, start, more, lambda acc: acc["text"])))


def broken_brackets(x: Column) -> Column:
    """Brackets that lost their content ("(; 1900)", "( , b)", "()") go, with the doubled spaces they leave."""
    x = F.regexp_replace(x, r"\(\s*[;,][^()]*\)", "")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"\(\s*\)", ""), " {2,}", " "))
