"""Extractors over items of an item base, given as JSON in `source`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.functions.scalar import resource_iri, short_hash
from pagequarry.functions.values import julian_to_gregorian, let, with_once
from pagequarry.model import DCT, LANG_STRING, OWL, RDF, RDFS, SKOS, XSD, statement, statements
from pagequarry.operators.extractors import DOMAIN, extractor
from pagequarry.operators.post import small, spread

TERM = "struct<language: string, value: string>"
SNAK = "struct<snaktype: string, property: string, datavalue: struct<type: string, value: string>>"
CLAIM = f"struct<id: string, rank: string, mainsnak: {SNAK}, qualifiers: map<string, array<{SNAK}>>, references: array<struct<hash: string, snaks: map<string, array<{SNAK}>>>>>"
ITEM = f"struct<id: string, type: string, labels: map<string, {TERM}>, descriptions: map<string, {TERM}>, aliases: map<string, array<{TERM}>>, sitelinks: map<string, struct<site: string, title: string>>, claims: map<string, array<{CLAIM}>>>"
ENTITY = "http://www.wikidata.org/entity/"
#: Languages with datasets of their own; all others share one.
MAPPED = ("en", "de", "fr", "es")


def items(pages: DataFrame) -> DataFrame:
    """Pages of JSON with their item; empty lists that stand for empty maps are mended; redirects and broken ones are dropped."""
    mended = F.col("source")
    for name in ("labels", "descriptions", "aliases", "sitelinks", "claims"):
        mended = F.regexp_replace(mended, rf'"{name}"\s*:\s*\[\s*\]', f'"{name}":{{}}')
    rows = spread(pages.where("redirect is null and format = 'application/json'"))
    return with_once(rows, "item", F.from_json(mended, ITEM)).where("item.id is not null").withColumn("s__", F.concat(F.lit(ENTITY), F.col("item.id")))


def _terms(pages: DataFrame, field: str, predicate: str, dataset: str, many: bool = False) -> DataFrame:
    rows = items(pages).select("s__", F.explode(f"item.{field}").alias("lang__", "t__"))
    if many:
        rows = rows.select("s__", "lang__", F.explode("t__").alias("t__"))
    where = F.concat(F.lit(dataset), F.when(F.col("lang__").isin(*MAPPED), "").otherwise("_nmw"))
    return statements(rows, statement(dataset, F.col("s__"), predicate, F.col("t__.value"), datatype=LANG_STRING, language=F.col("lang__")).withField("dataset", where))


@extractor("item-labels", "json")
def labels(pages: DataFrame) -> DataFrame:
    return _terms(pages, "labels", RDFS + "label", "item_labels")


@extractor("item-descriptions", "json")
def descriptions(pages: DataFrame) -> DataFrame:
    return _terms(pages, "descriptions", DCT + "description", "item_descriptions")


@extractor("item-aliases", "json")
def aliases(pages: DataFrame) -> DataFrame:
    return _terms(pages, "aliases", SKOS + "altLabel", "item_aliases", many=True)


def site_links(pages: DataFrame) -> DataFrame:
    rows = items(pages).select("s__", F.explode("item.sitelinks").alias("site__", "l__")).where(F.col("site__").rlike("^[a-z_]+wiki$"))
    return rows.withColumn("lang__", F.regexp_extract("site__", "^(.*)wiki$", 1)).withColumn("iri__", resource_iri(F.col("l__.title"), F.col("lang__"), DOMAIN))


@extractor("item-same-as", "json")
def same_as(pages: DataFrame) -> DataFrame:
    return statements(site_links(pages), statement("item_same_as", F.col("s__"), OWL + "sameAs", F.col("iri__")))


@extractor("item-language-links", "json")
def language_links(pages: DataFrame) -> DataFrame:
    """Ordered pairs of an item's pages in different languages."""
    # An item has a link a wiki at most, so its links fit into a row.
    own = site_links(pages).groupBy("s__").agg(F.collect_set(F.struct(F.col("lang__").alias("l"), F.col("iri__").alias("i"))).alias("own"))
    pairs = own.select("own", F.explode("own").alias("a")).select("a", F.explode("own").alias("b")).where("a.l <> b.l")
    return statements(pairs, statement("item_language_links", F.col("a.i"), OWL + "sameAs", F.col("b.i")))


@extractor("item-namespace", "json")
def namespace_same_as(pages: DataFrame) -> DataFrame:
    return statements(items(pages), statement("item_namespace", F.replace("s__", F.lit(ENTITY), F.lit(f"http://wikidata.{DOMAIN}/resource/")), OWL + "sameAs", F.col("s__")))


def snak_value(snak: Column) -> Column:
    """value and datatype of a snak: items, text, time by its precision, coordinates, quantities; null for others."""

    def read(t: Column) -> Column:
        v, kind = t["v"], t["t"]
        get = lambda p: F.get_json_object(v, p)
        make = lambda x, d: F.struct(x.cast("string").alias("value"), (F.lit(d) if isinstance(d, str) else d).cast("string").alias("datatype"))
        time = get("$.time")
        y, m, d = (F.regexp_extract(time, r"^([+-]?\d+)-(\d\d)-(\d\d)", k).try_cast("int") for k in (1, 2, 3))
        julian = F.coalesce(get("$.calendarmodel"), F.lit("")).endswith("Q1985786") & (m > 0) & (d > 0)
        greg = let(F.when(julian, julian_to_gregorian(y, m, d)).otherwise(F.struct(y.alias("y"), m.alias("m"), d.alias("d"))), lambda g: F.concat(F.when(g["y"] < 0, "-").otherwise(""), F.lpad(F.abs(g["y"]).cast("string"), 4, "0"), F.lit("-"), F.lpad(g["m"].cast("string"), 2, "0"), F.lit("-"), F.lpad(g["d"].cast("string"), 2, "0")))
        p = get("$.precision").try_cast("int")
        year = F.regexp_extract(greg, r"^(-?\d+)", 1)
        # Coarser than a year: cut to the decade, century and so on.
        coarse = F.when(p < 9, (F.floor(y / F.pow(F.lit(10), F.greatest(9 - p, F.lit(0)))) * F.pow(F.lit(10), F.greatest(9 - p, F.lit(0)))).cast("int").cast("string"))
        when = F.when(p >= 12, make(F.concat(greg, F.regexp_extract(time, r"(T[\d:]+Z?)$", 1)), XSD + "dateTime")).when(p == 11, make(greg, XSD + "date")).when(p == 10, make(F.regexp_extract(greg, r"^(-?\d+-\d\d)", 1), XSD + "gYearMonth")).when(p == 9, make(year, XSD + "gYear")).otherwise(make(coarse, XSD + "gYear"))
        return (
            F.when(kind == "wikibase-entityid", make(F.concat(F.lit(ENTITY), F.coalesce(get("$.id"), F.concat(F.lit("Q"), get("$['numeric-id']")))), F.lit(None)))
            .when(kind == "string", F.when(v.rlike("^https?://"), make(v, F.lit(None))).otherwise(make(F.trim(v), XSD + "string")))
            .when(kind == "monolingualtext", make(get("$.text"), LANG_STRING))
            .when(kind == "quantity", make(F.regexp_replace(get("$.amount"), r"^\+", ""), XSD + "decimal"))
            .when(kind == "globecoordinate", make(F.concat_ws(" ", get("$.latitude"), get("$.longitude")), XSD + "string"))
            .when(kind == "time", when)
        )

    return let(F.struct(snak["datavalue"]["type"].alias("t"), snak["datavalue"]["value"].alias("v")), read)


def statement_iri(s: Column, prop: Column, value: Column, datatype: Column, claim: Column) -> Column:
    """The item, the property, the other item or a hash of the value, and five letters of the statement's id."""
    other = F.when(datatype.isNull() & value.startswith(ENTITY), F.regexp_replace(value, "^.*/", "")).otherwise(short_hash(value))
    return F.concat_ws("_", s, prop, other, F.substring(F.regexp_extract(claim, r"\$(.*)$", 1), 1, 5))


def claims(pages: DataFrame) -> DataFrame:
    """A row for each claim with a value: s__, prop__, claim__, value__, datatype__, iri__."""
    rows = items(pages).select("s__", F.explode("item.claims").alias("prop__", "c__")).select("s__", "prop__", F.posexplode("c__").alias("ord__", "claim__"))
    rows = with_once(rows.where("claim__.mainsnak.snaktype = 'value'"), "v__", snak_value(F.col("claim__.mainsnak"))).where("v__ is not null")
    return rows.select("*", F.col("v__.value").alias("value__"), F.col("v__.datatype").alias("datatype__")).withColumn("iri__", statement_iri(F.col("s__"), F.col("prop__"), F.col("value__"), F.col("datatype__"), F.col("claim__.id")))


def reified(dataset: str, predicate: Column) -> list[Column]:
    i = F.col("iri__")
    return [
        statement(dataset, i, RDF + "type", F.lit(RDF + "Statement")), statement(dataset, i, RDF + "subject", F.col("s__")),
        statement(dataset, i, RDF + "predicate", predicate), statement(dataset, i, RDF + "object", F.col("value__"), datatype=F.col("datatype__")),
    ]


@extractor("item-raw", "json")
def raw(pages: DataFrame) -> DataFrame:
    """Each claim plain, reified in four statements, and its qualifiers."""
    rows = claims(pages)
    p = F.concat(F.lit(ENTITY), F.col("prop__"))
    own = statements(rows, statement("item_raw", F.col("s__"), p, F.col("value__"), datatype=F.col("datatype__")), *reified("item_raw_reified", p))
    q = with_once(rows.select("iri__", F.explode("claim__.qualifiers").alias("q__", "s")).select("iri__", "q__", F.explode("s").alias("s")), "v__", snak_value(F.col("s"))).where("v__ is not null")
    qualified = statements(q, statement("item_raw_qualifiers", F.col("iri__"), F.concat(F.lit(ENTITY), F.col("q__")), F.col("v__.value"), datatype=F.col("v__.datatype")))
    return own.unionByName(qualified)


@extractor("item-references", "json")
def references(pages: DataFrame) -> DataFrame:
    rows = claims(pages).select("iri__", F.explode("claim__.references").alias("r")).select("iri__", F.explode("r.snaks").alias("p__", "s")).select("iri__", "p__", F.explode("s").alias("s"))
    rows = with_once(rows, "v__", snak_value(F.col("s"))).where("v__ is not null")
    return statements(rows, statement("item_references", F.col("iri__"), F.concat(F.lit(ENTITY), F.col("p__")), F.col("v__.value"), datatype=F.col("v__.datatype")))


@extractor("item-properties", "json")
def properties(pages: DataFrame) -> DataFrame:
    """Pages of properties: their terms and statements."""
    own = pages.where(F.get_json_object("source", "$.type") == "property")
    return labels(own).unionByName(descriptions(own)).unionByName(aliases(own)).unionByName(raw(own)).withColumn("dataset", F.lit("item_properties"))


def preferred(rows: DataFrame) -> DataFrame:
    """Of each item's claims of a property: the preferred ones, else the normal ones."""
    rank = F.when(F.col("claim__.rank") == "preferred", 0).when(F.col("claim__.rank") == "normal", 1)
    rows = rows.withColumn("rank__", rank).where("rank__ is not null")
    return rows.withColumn("best__", F.min("rank__").over(Window.partitionBy("s__", "prop__"))).where("rank__ = best__").drop("rank__", "best__")


def mapped(pages: DataFrame, commands: DataFrame, classes: DataFrame) -> DataFrame:
    """Claims under an ontology's properties.

    commands (prop, predicate, command): what to make of a value, by placeholders: $1 the value, $2 the
    value with underscores, $getLatitude, $getLongitude, $getGeoRss, $getClass. classes (item, class) map
    items to types. Addresses typed as text go to a dataset of errors.
    """
    rows = preferred(claims(pages)).join(small(commands), F.col("prop__") == F.col("prop")).join(small(classes), F.col("value__") == F.concat(F.lit(ENTITY), F.col("item")), "left")
    lat, lon = F.split("value__", " ")[0], F.get(F.split("value__", " "), F.lit(1))
    fill = {"$getLatitude": lat, "$getLongitude": lon, "$getGeoRss": F.col("value__"), "$getClass": F.col("class"), "$2": F.replace("value__", F.lit(" "), F.lit("_")), "$1": F.col("value__")}
    value = F.coalesce(F.col("command"), F.lit("$1"))
    for name, x in fill.items():
        value = F.when(F.contains(value, F.lit(name)), F.replace(value, F.lit(name), x)).otherwise(value)
    geo = F.col("command").isin("$getLatitude", "$getLongitude")
    kind = F.when(F.col("command") == "$getClass", F.lit(None)).when(geo, XSD + "float").otherwise(F.col("datatype__"))
    rows = rows.withColumn("value__", value).withColumn("datatype__", kind).where("value__ is not null")
    odd = F.col("datatype__").isNotNull() & F.col("value__").rlike("^https?://")
    return statements(rows, statement("item_mapped", F.col("s__"), F.col("predicate"), F.col("value__"), datatype=F.col("datatype__")).withField("dataset", F.when(odd, "item_mapped_errors").otherwise("item_mapped")))


LEXEME = f"struct<id: string, lemmas: map<string, {TERM}>, forms: array<struct<id: string, representations: map<string, {TERM}>>>, senses: array<struct<id: string, glosses: map<string, {TERM}>>>>"


@extractor("lexemes", "json")
def lexemes(pages: DataFrame) -> DataFrame:
    """Lemmas, written forms and glosses of lexemes."""
    rows = pages.where(F.get_json_object("source", "$.type") == "lexeme").withColumn("x", F.from_json("source", LEXEME))
    ontolex = "http://www.w3.org/ns/lemon/ontolex#"
    lemma = rows.select("x.id", F.explode("x.lemmas").alias("l", "t"), F.lit(RDFS + "label").alias("p"))
    form = rows.select(F.explode("x.forms").alias("f")).select("f.id", F.explode("f.representations").alias("l", "t"), F.lit(ontolex + "representation").alias("p"))
    sense = rows.select(F.explode("x.senses").alias("f")).select("f.id", F.explode("f.glosses").alias("l", "t"), F.lit(SKOS + "definition").alias("p"))
    every = lemma.unionByName(form).unionByName(sense)
    return statements(every, statement("lexemes", F.concat(F.lit(ENTITY), F.col("id")), F.col("p"), F.col("t.value"), datatype=LANG_STRING, language=F.col("l")))


