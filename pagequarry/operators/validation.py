"""Validation of statements by rules: a trigger says what a rule covers, a validator what is valid.

Each statement gives three constructs (subject, predicate, object). Rules are few and become one
expression each, so all are scored in a single pass with one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.model import LANG_STRING


@dataclass(frozen=True)
class Rule:
    """trigger: iri (pattern), typed (datatype), literal, lang, plain, any_iri, blank (never).
    validator: pattern, vocab (a list), excludes (texts it must not hold), lang_tag, lang_string, is_iri, is_literal."""

    test: str
    trigger: str
    covers: str | None
    validator: str
    valid: str | Sequence[str] | None
    places: tuple[str, ...] = ("subject", "predicate", "object")

    def covered(self) -> Column:
        place = F.col("place").isin(*self.places)
        iri, kind = F.col("datatype").isNull(), F.col("datatype")
        return place & {
            "iri": lambda: iri & F.col("value").rlike(self.covers or ""),
            "any_iri": lambda: iri,
            "typed": lambda: ~iri & (kind == F.lit(self.covers)),
            "literal": lambda: ~iri,
            "lang": lambda: ~iri & F.col("language").isNotNull(),
            "plain": lambda: ~iri & F.col("language").isNull(),
            "blank": lambda: F.lit(False),
        }[self.trigger]()

    def passes(self) -> Column:
        v = F.col("value")
        listed = [self.valid] if isinstance(self.valid, str) or self.valid is None else list(self.valid)
        held = F.lit(False)
        if self.validator == "excludes":
            for x in listed:
                held = held | v.contains(x)
        return {
            "pattern": lambda: v.rlike(str(self.valid)),
            "vocab": lambda: v.isin(listed),
            "excludes": lambda: ~held,
            "lang_tag": lambda: F.col("language").rlike("^[a-z]{2,3}(-[a-z0-9]+)*$"),
            "lang_string": lambda: F.col("datatype") == LANG_STRING,
            "is_iri": lambda: v.rlike(r'^[A-Za-z][A-Za-z0-9+.\-]*:[^\x00-\x20<>"{}|\\^`]*$'),
            "is_literal": lambda: F.col("datatype").isNotNull(),
        }[self.validator]()


def constructs(statements: DataFrame) -> DataFrame:
    """place, value, datatype, language: three rows a statement."""
    none = F.lit(None).cast("string")
    one = lambda place, v, d, lang: F.struct(F.lit(place).alias("place"), v.alias("value"), d.alias("datatype"), lang.alias("language"))
    c = F.col
    rows = F.array(one("subject", c("subject"), none, none), one("predicate", c("predicate"), none, none), one("object", c("value"), c("datatype"), c("language")))
    return statements.select(F.explode(rows).alias("c")).select("c.*")


def scores(statements: DataFrame, rules: list[Rule]) -> DataFrame:
    """test, covered and valid: a row for each rule."""
    verdicts = F.array(*[F.struct(F.lit(r.test).alias("test"), r.covered().alias("covered"), r.passes().alias("valid")) for r in rules])
    each = constructs(statements).select(F.explode(verdicts).alias("v")).select("v.*").where("covered")
    return each.groupBy("test").agg(F.count(F.lit(1)).alias("covered"), F.sum(F.coalesce("valid", F.lit(False)).cast("long")).alias("valid"))


def failures(statements: DataFrame, rules: list[Rule]) -> DataFrame:
    """test and the constructs that fail it."""
    verdicts = F.array(*[F.when(r.covered() & ~F.coalesce(r.passes(), F.lit(False)), F.lit(r.test)) for r in rules])
    return constructs(statements).withColumn("test", F.explode(F.filter(verdicts, lambda t: t.isNotNull())))


def shapes(statements: DataFrame, constraints: DataFrame) -> DataFrame:
    """Constraints (target, path, least, most, pattern) that a target's statements break, with the number found."""
    found = statements.select(F.col("subject").alias("target"), F.col("predicate").alias("path"), "value")
    joined = constraints.join(found, ["target", "path"], "left")
    ok = F.expr("pattern is null or value rlike pattern")
    out = joined.groupBy("target", "path", "least", "most", "pattern").agg(F.count("value").alias("n"), F.sum(F.when(F.col("value").isNotNull() & ~ok, 1).otherwise(0)).alias("bad"))
    return out.where((F.col("n") < F.coalesce("least", F.lit(0))) | (F.col("n") > F.coalesce("most", F.lit(1 << 60))) | (F.col("bad") > 0))


# --- generated rules and reports ----------------------------------------------------------------------

#: Fixed value: the vocabulary of test definitions.
TEST = "http://example.org/test/"


def rules_of(definitions: DataFrame, most: int = 100_000) -> list[Rule]:
    """Rules that a model of tests defines: statements whose subject is a test and whose predicates are TEST + trigger,
    covers, validator, valid (one for each listed value), place. At most so many statements, since rules become expressions."""
    rows = definitions.where(F.col("predicate").startswith(TEST)).select("subject", F.expr(f"substring(predicate, {len(TEST) + 1})").alias("field"), "value").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} statements of tests")
    tests: dict[str, dict[str, list[str]]] = {}
    for r in rows:
        tests.setdefault(r["subject"], {}).setdefault(r["field"], []).append(r["value"])
    one = lambda t, f: (t.get(f) or [None])[0]
    out = []
    for name, t in sorted(tests.items()):
        valid = sorted(t.get("valid", []))
        listed = one(t, "validator") in ("vocab", "excludes")
        out.append(Rule(name.removeprefix(TEST), one(t, "trigger"), one(t, "covers"), one(t, "validator"), valid if listed else (valid or [None])[0], tuple(sorted(t.get("place", []))) or ("subject", "predicate", "object")))
    return out


#: What the text of a value of a type looks like.
LEXICAL = {"integer": r"^[+-]?\d+$", "nonNegativeInteger": r"^\+?\d+$", "double": r"^[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?$", "float": r"^[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?$", "boolean": "^(?:true|false|0|1)$", "date": r"^-?\d{4,}-\d{2}-\d{2}$", "gYear": r"^-?\d{4,}$", "gYearMonth": r"^-?\d{4,}-\d{2}$", "anyURI": r"^[A-Za-z][A-Za-z0-9+.\-]*:\S*$"}


def lexical_rules(xsd: str) -> list[Rule]:
    """A rule for each type: its literals look as they must."""
    return [Rule(name, "typed", xsd + name, "pattern", pattern) for name, pattern in LEXICAL.items()]


def report(scored: DataFrame) -> DataFrame:
    """test, covered, valid, failed and share of scores, the worst first."""
    out = scored.withColumn("failed", F.col("covered") - F.col("valid")).withColumn("share", F.round(F.col("valid") / F.col("covered"), 6))
    return out.orderBy("share", "test")


def report_statements(scored: DataFrame) -> DataFrame:
    """The report as statements, to be rendered in any format."""
    from pagequarry.model import XSD, statement, statements

    s = F.concat(F.lit(TEST), F.col("test"))
    number = lambda c: statement("report", s, TEST + c, F.col(c).cast("string"), datatype=XSD + "integer")
    return statements(report(scored), number("covered"), number("valid"), number("failed"))


def report_html(scored: DataFrame) -> DataFrame:
    """ord and line of a page with a table of the report."""
    from pyspark.sql import Window

    from pagequarry.functions.scalar import escape_xml

    cells = [escape_xml(F.col(c).cast("string")) for c in ("test", "covered", "valid", "failed", "share")]
    row = F.concat(F.lit("<tr>"), *[x for c in cells for x in (F.lit("<td>"), c, F.lit("</td>"))], F.lit("</tr>"))
    body = report(scored).select(F.row_number().over(Window.orderBy("share", "test")).alias("ord"), row.alias("line"))
    spark = scored.sparkSession
    edge = spark.createDataFrame([(0, "<table><tr><th>test</th><th>covered</th><th>valid</th><th>failed</th><th>share</th></tr>"), (1 << 30, "</table>")], "ord int, line string")
    return edge.unionByName(body)
