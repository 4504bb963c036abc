"""Schemas of the two universal tables, statements and pages, and helpers that keep to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The fields of a statement and of a page, and the addresses of public vocabularies.
STATEMENT_COLUMNS = ["language", "dataset", "subject", "predicate", "value", "context", "datatype"]
#: What makes two statements equal: neither the dataset nor the context.
STATEMENT_KEY = ["subject", "predicate", "value", "datatype", "language"]
STATEMENT_SCHEMA = ", ".join(f"{c} string" for c in STATEMENT_COLUMNS)
PAGE_SCHEMA = (
    "page_id long, title string, ns int, revision long, ts timestamp, contributor_id long, "
    "contributor_name string, redirect string, source string, format string, lang string"
)

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
FOAF = "http://xmlns.com/foaf/0.1/"
DCT = "http://purl.org/dc/terms/"
GEO = "http://www.w3.org/2003/01/geo/wgs84_pos#"
LANG_STRING = RDF + "langString"


def col(x: Column | str | None) -> Column:
    """A column as it is, a string as a literal."""
    return x if isinstance(x, Column) else F.lit(x)


def statement(dataset: str, subject: Column, predicate: Column | str, value: Column, *, datatype: Column | str | None = None, language: Column | str | None = None, context: Column | str | None = None) -> Column:
    """One statement as a struct; no datatype means that the value is a resource."""
    fields = dict(language=col(language), dataset=F.lit(dataset), subject=subject, predicate=col(predicate), value=value, context=col(context), datatype=col(datatype))
    return F.struct(*[fields[c].cast("string").alias(c) for c in STATEMENT_COLUMNS])


def statements(df: DataFrame, *built: Column) -> DataFrame:
    """The statements that each row gives; those without a subject, predicate or value are dropped."""
    out = df.select(F.explode(F.array(*built)).alias("s")).select("s.*")
    return out.where("subject is not null and predicate is not null and value is not null")


def distinct_statements(df: DataFrame) -> DataFrame:
    """Statements once each, by their key."""
    return df.dropDuplicates(STATEMENT_KEY)


def is_resource(datatype: str = "datatype") -> Column:
    return F.col(datatype).isNull()


def ordered(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in STATEMENT_KEY])
