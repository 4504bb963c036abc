"""Statements as lines of text in seven formats, and back; policies that clean addresses on the way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.scalar import escape_xml, turtle_escape, turtle_unescape
from pagequarry.model import LANG_STRING, STATEMENT_COLUMNS, XSD

#: subject, predicate, object as an address or as a literal with a language or a type, and a context.
LINE = r'^\s*<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:@([a-z][a-z0-9-]*)|\^\^<([^>]*)>)?)\s*(?:<([^>]*)>)?\s*\.\s*$'


def parse_lines(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Statements of lines, ok (false for a line that is none) and the columns to keep. Comments and blank lines are skipped."""
    x = F.col(column)
    rows = lines.select(x.alias("line"), *keep).where(~F.col("line").rlike(r"^\s*(?:#.*)?$"))
    g = lambda k: F.regexp_extract("line", LINE, k)
    ok = F.col("line").rlike(LINE)
    resource = F.col("line").rlike(r"^\s*<[^>]*>\s+<[^>]*>\s+<")
    blank = lambda c: F.nullif(c, F.lit(""))
    return rows.select(
        *keep, "line", ok.alias("ok"), F.when(ok, g(1)).alias("subject"), F.when(ok, g(2)).alias("predicate"),
        F.when(ok, F.when(resource, g(3)).otherwise(turtle_unescape(g(4)))).alias("value"), blank(g(5)).alias("language"),
        F.when(ok & ~resource, F.coalesce(blank(g(6)), F.when(g(5) != "", LANG_STRING).otherwise(XSD + "string"))).alias("datatype"), blank(g(7)).alias("context"),
    )


def literal(value: Column, language: Column, datatype: Column) -> Column:
    tail = F.when(language.isNotNull() & (datatype == LANG_STRING), F.concat(F.lit("@"), language)).when(datatype == XSD + "string", "").otherwise(F.concat(F.lit("^^<"), datatype, F.lit(">")))
    return F.concat(F.lit('"'), turtle_escape(value), F.lit('"'), tail)


def _terse(quads: bool) -> Column:
    c = F.col
    value = F.when(c("datatype").isNull(), F.concat(F.lit("<"), c("value"), F.lit(">"))).otherwise(literal(c("value"), c("language"), c("datatype")))
    tail = F.when(c("context").isNotNull(), F.concat(F.lit(" <"), c("context"), F.lit(">"))).otherwise("") if quads else F.lit("")
    return F.concat(F.lit("<"), c("subject"), F.lit("> <"), c("predicate"), F.lit("> "), value, tail, F.lit(" ."))


def _trix(quads: bool) -> Column:
    c = F.col
    uri = lambda x: F.concat(F.lit("<uri>"), escape_xml(x), F.lit("</uri>"))
    typed = F.concat(F.lit('<typedLiteral datatype="'), escape_xml(c("datatype")), F.lit('">'), escape_xml(c("value")), F.lit("</typedLiteral>"))
    plain = F.concat(F.lit('<plainLiteral xml:lang="'), c("language"), F.lit('">'), escape_xml(c("value")), F.lit("</plainLiteral>"))
    value = F.when(c("datatype").isNull(), uri(c("value"))).when((c("datatype") == LANG_STRING) & c("language").isNotNull(), plain).otherwise(typed)
    triple = F.concat(F.lit("<triple>"), uri(c("subject")), uri(c("predicate")), value, F.lit("</triple>"))
    return F.concat(F.lit("<graph>"), F.when(c("context").isNotNull(), uri(c("context"))).otherwise("") if quads else F.lit(""), triple, F.lit("</graph>"))


def _rdf_json() -> Column:
    c = F.col
    kind = F.when(c("datatype").isNull(), "uri").otherwise("literal")
    lang = F.when(c("datatype") == LANG_STRING, c("language"))
    typed = F.when(c("datatype").isNotNull() & ~c("datatype").isin(LANG_STRING, XSD + "string"), c("datatype"))
    value = F.struct(kind.alias("type"), c("value").alias("value"), lang.alias("lang"), typed.alias("datatype"))
    return F.to_json(F.create_map(c("subject"), F.create_map(c("predicate"), F.array(value))))


FORMATS: dict[str, Callable[[], Column]] = {
    "turtle-triples": lambda: _terse(False),
    "turtle-quads": lambda: _terse(True),
    "n-triples": lambda: F.regexp_replace(_terse(False), "\u007f", ""),
    "n-quads": lambda: F.regexp_replace(_terse(True), "\u007f", ""),
    "trix-triples": lambda: _trix(False),
    "trix-quads": lambda: _trix(True),
    "rdf-json": _rdf_json,
}
#: Formats of which letters beyond ASCII are written as numbers.
ASCII_FORMATS = ("n-triples", "n-quads")


def render(statements: DataFrame, form: str) -> DataFrame:
    """dataset and line of each statement."""
    from pagequarry.functions.scalar import escape_non_ascii

    line = FORMATS[form]()
    return statements.select("dataset", (escape_non_ascii(line) if form in ASCII_FORMATS else line).alias("line"))


def edges(form: str, started: str, completed: str) -> tuple[list[str], list[str]]:
    """Lines before and after those of a file, by format: comments with times (ISO), or the root element."""
    if form.startswith("trix"):
        return ['<?xml version="1.0" encoding="UTF-8"?>', '<TriX xmlns="http://www.w3.org/2004/03/trix/trix-1/">'], ["</TriX>"]
    if form == "rdf-json":
        return [], []
    return [f"# started {started}"], [f"# completed {completed}"]


Policy = Callable[[Column], Column]


def reject_long(x: Column, limit: int = 500) -> Column:
    """Null for addresses beyond the limit."""
    return F.when(F.length(x) <= limit, x)


def generic(language: str, domain: str = "example.org") -> Policy:
    """The language's own part of an address gives way to the generic one."""
    return lambda x: F.when(x.startswith(f"http://{language}.{domain}/"), F.concat(F.lit(f"http://{domain}/"), F.substring(x, len(f"http://{language}.{domain}/") + 1, 1 << 30))).otherwise(x)


def xml_safe(x: Column) -> Column:
    """An underscore after a last segment that can't be a name in XML (it doesn't end in a letter, a digit or a dash after one)."""
    return F.when(x.rlike(r"[\p{L}_][\p{L}\p{N}._-]*$"), x).otherwise(F.concat(x, F.lit("_")))


def ascii_uri(x: Column) -> Column:
    from pagequarry.functions.scalar import to_ascii_uri

    return to_ascii_uri(x)


def apply_policies(statements: DataFrame, policies: list[tuple[str, Policy]]) -> DataFrame:
    """Policies in order, each at a position (all, subject, predicate, object, datatype, context); what they reject goes."""
    places = {"all": ["subject", "predicate", "value", "datatype", "context"], "object": ["value"]}
    for where, policy in policies:
        for c in places.get(where, [where]):
            new = policy(F.col(c))
            statements = statements.withColumn(c, F.when(F.col("datatype").isNull(), new).otherwise(F.col(c)) if c == "value" else new)
    return statements.where("subject is not null and predicate is not null and value is not null")


def marked(lines: DataFrame) -> DataFrame:
    """Lines with a bad address commented out."""
    outside = F.regexp_replace("line", r'"(?:[^"\\]|\\.)*"', '""')
    bad = outside.rlike(r'<[^>]*(?:[\s"{}|^`]|\\(?![uU]))[^>]*>')
    return lines.withColumn("line", F.when(bad, F.concat(F.lit("# BAD: "), F.col("line"))).otherwise(F.col("line")))


def sparql_update(diff: DataFrame) -> DataFrame:
    """op (added or deleted) and line of statements as update commands."""
    verb = F.when(F.col("op") == "added", "INSERT DATA { ").otherwise("DELETE DATA { ")
    return diff.select("op", F.concat(verb, _terse(False), F.lit(" }")).alias("line"))


__all__ = ["ASCII_FORMATS", "FORMATS", "STATEMENT_COLUMNS", "apply_policies", "edges", "generic", "marked", "parse_lines", "reject_long", "render", "sparql_update", "xml_safe"]
