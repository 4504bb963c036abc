"""Extractors: functions from pages to statements, by name in a registry.

An extractor reads one of three views: pages as they are, pages with parsed nodes (`parsed`), or
items with JSON. `extract` runs any of them over one view that is parsed once and written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagequarry.functions import scalar as S
from pagequarry.functions import values as V
from pagequarry.functions.values import let, with_once
from pagequarry.model import DCT, FOAF, GEO, LANG_STRING, OWL, RDF, RDFS, SKOS, XSD, distinct_statements, statement, statements
from pagequarry.operators.post import cut, spread
from pagequarry.operators.wikitext import exploded, of_kind, parsed, title_parts

Extractor = Callable[[DataFrame], DataFrame]
REGISTRY: dict[str, tuple[str, Extractor]] = {}
DOMAIN = "example.org"
#: The names of properties under this address, here and in the modules that use it, are those of public datasets.
ONTOLOGY = f"http://{DOMAIN}/ontology/"
MAIN, FILE, TEMPLATE, CATEGORY = 0, 6, 10, 14


@dataclass(frozen=True)
class Note:
    """What is known of an extractor besides its code: the view it reads, what it says of itself, and hooks around its run."""

    name: str
    view: str
    text: str
    agent: str
    before: Callable[[DataFrame], None] | None = None
    after: Callable[[DataFrame], None] | None = None


NOTES: dict[str, Note] = {}


def extractor(name: str, view: str = "nodes", before: Callable[[DataFrame], None] | None = None, after: Callable[[DataFrame], None] | None = None) -> Callable[[Extractor], Extractor]:
    """Register an extractor; view: pages, nodes or json. before gets the pages, after the statements of each run that `extract` plans."""
    def register(f: Extractor) -> Extractor:
        REGISTRY[name] = (view, f)
        NOTES[name] = Note(name, view, " ".join((f.__doc__ or "").split()), f"{ONTOLOGY}agent/{name}", before, after)
        return f

    return register


def load(path: str) -> None:
    """Register what the function at `package.module:function` is, under its own name, read as nodes."""
    module, _, name = path.partition(":")
    extractor(name)(getattr(import_module(module), name))


def extract(pages: DataFrame, names: Sequence[str], *, distinct: bool = True) -> DataFrame:
    """The statements of the named extractors; wikitext is parsed once if any of them needs it."""
    views = {"pages": spread(pages), "json": pages}
    if any(REGISTRY[n][0] == "nodes" for n in names):
        views["nodes"] = cut(parsed(pages), "parsed")
    made = []
    for n in names:
        view, run = REGISTRY[n]
        if NOTES[n].before:
            NOTES[n].before(views[view])
        made.append(run(views[view]))
        if NOTES[n].after:
            NOTES[n].after(made[-1])
    out = reduce(DataFrame.unionByName, made)
    return distinct_statements(out) if distinct else out


def agents(spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
    """Statements about the extractors as software agents: their type, name and description."""
    rows = spark.createDataFrame([(n.agent, n.name, n.text or n.name) for k, n in sorted(NOTES.items()) if names is None or k in names], "agent string, name string, text string")
    a = F.col("agent")
    return statements(rows, statement("agents", a, RDF + "type", F.lit("http://www.w3.org/ns/prov#SoftwareAgent")), statement("agents", a, RDFS + "label", F.col("name"), datatype=XSD + "string"), statement("agents", a, DCT + "description", F.col("text"), datatype=XSD + "string"))


def subject() -> Column:
    return S.resource_iri(F.col("title"), F.col("lang"), DOMAIN)


def page_iri() -> Column:
    return F.concat(F.lit("http://"), F.col("lang"), F.lit(f".{DOMAIN}/wiki/"), S.wiki_encode(F.col("title")))


def source_iri(line: Column | None = None) -> Column:
    base = F.concat(page_iri(), F.lit("?oldid="), F.col("revision").cast("string"), F.lit("&ns="), F.col("ns").cast("string"))
    return base if line is None else F.concat(base, F.lit("#absolute-line="), line.cast("string"))


def resource(title: Column) -> Column:
    return S.resource_iri(title, F.col("lang"), DOMAIN)


def in_namespaces(pages: DataFrame, *ns: int) -> DataFrame:
    return pages.where(F.col("ns").isin(*ns) & F.col("redirect").isNull())


# --- metadata -----------------------------------------------------------------------------------


@extractor("labels", "pages")
def labels(pages: DataFrame) -> DataFrame:
    return statements(in_namespaces(pages, MAIN), statement("labels", subject(), RDFS + "label", F.col("title"), datatype=LANG_STRING, language=F.col("lang"), context=source_iri()))


@extractor("category-labels", "pages")
def category_labels(pages: DataFrame) -> DataFrame:
    return statements(in_namespaces(pages, CATEGORY), statement("category_labels", subject(), RDFS + "label", F.regexp_replace("title", "^[^:]+:", ""), datatype=LANG_STRING, language=F.col("lang")))


@extractor("page-ids", "pages")
def page_ids(pages: DataFrame) -> DataFrame:
    return statements(pages, statement("page_ids", subject(), ONTOLOGY + "wikiPageID", F.col("page_id").cast("string"), datatype=XSD + "integer"))


@extractor("revision-ids", "pages")
def revision_ids(pages: DataFrame) -> DataFrame:
    return statements(pages.where("revision >= 0"), statement("revision_ids", subject(), ONTOLOGY + "wikiPageRevisionID", F.col("revision").cast("string"), datatype=XSD + "integer"))


@extractor("provenance", "pages")
def provenance(pages: DataFrame) -> DataFrame:
    return statements(pages, statement("revision_uris", subject(), "http://www.w3.org/ns/prov#wasDerivedFrom", source_iri()))


@extractor("page-lengths", "pages")
def page_lengths(pages: DataFrame) -> DataFrame:
    return statements(in_namespaces(pages, MAIN), statement("page_length", subject(), ONTOLOGY + "wikiPageLength", F.length("source").cast("string"), datatype=XSD + "nonNegativeInteger"))


@extractor("redirects", "pages")
def redirects(pages: DataFrame) -> DataFrame:
    """Redirects whose target is of the page's own namespace."""
    target = title_parts(F.col("redirect"))
    rows = pages.where(F.col("redirect").isNotNull() & F.col("ns").isin(MAIN, TEMPLATE, CATEGORY))
    rows = with_once(rows, "to__", target).where("to__.ns = ns")
    return statements(rows, statement("redirects", subject(), ONTOLOGY + "wikiPageRedirects", resource(F.when(F.col("ns") == 0, F.col("to__.title")).otherwise(F.col("redirect")))))


@extractor("meta-information", "pages")
def meta_information(pages: DataFrame) -> DataFrame:
    """Modified, extracted (now), and the addresses of editing, of this revision and of the history."""
    script = F.concat(F.lit("http://"), F.col("lang"), F.lit(f".{DOMAIN}/w/index.php?title="), S.wiki_encode(F.col("title")))
    built = (
        statement("meta", subject(), DCT + "modified", S.iso_timestamp(F.col("ts")), datatype=XSD + "dateTime"),
        statement("meta", subject(), ONTOLOGY + "wikiPageExtracted", S.iso_timestamp(F.current_timestamp()), datatype=XSD + "dateTime"),
        statement("meta", subject(), ONTOLOGY + "wikiPageEditLink", F.concat(script, F.lit("&action=edit"))),
        statement("meta", subject(), ONTOLOGY + "wikiPageRevisionLink", F.concat(script, F.lit("&oldid="), F.col("revision").cast("string"))),
        statement("meta", subject(), ONTOLOGY + "wikiPageHistoryLink", F.concat(script, F.lit("&action=history"))),
    )
    return statements(in_namespaces(pages, MAIN), *built)


@extractor("contributors", "pages")
def contributors(pages: DataFrame) -> DataFrame:
    who = F.concat(F.lit("http://"), F.col("lang"), F.lit(f".{DOMAIN}/wiki/User:"), S.wiki_encode(F.col("contributor_name")))
    built = (
        statement("contributors", subject(), DCT + "contributor", who),
        statement("contributors", who, RDFS + "label", F.col("contributor_name"), datatype=XSD + "string"),
        statement("contributors", who, ONTOLOGY + "wikiPageUserID", F.col("contributor_id").cast("string"), datatype=XSD + "integer"),
    )
    return statements(in_namespaces(pages, MAIN).where("contributor_id > 0"), *built)


@extractor("article-pages", "pages")
def article_pages(pages: DataFrame) -> DataFrame:
    built = (
        statement("pages", subject(), FOAF + "isPrimaryTopicOf", page_iri()), statement("pages", page_iri(), FOAF + "primaryTopic", subject()),
        statement("pages", page_iri(), "http://purl.org/dc/elements/1.1/language", F.col("lang"), datatype=XSD + "string"), statement("pages", page_iri(), RDF + "type", F.lit(FOAF + "Document")),
    )
    return statements(in_namespaces(pages, MAIN), *built)


@extractor("iri-same-as-uri", "pages")
def iri_same_as_uri(pages: DataFrame) -> DataFrame:
    rows = pages.withColumn("iri__", subject()).withColumn("uri__", S.to_ascii_uri(F.col("iri__"))).where("iri__ <> uri__")
    return statements(rows, statement("iri_same_as_uri", F.col("iri__"), OWL + "sameAs", F.col("uri__")))


#: Endings of media files, and what they are.
FILE_TYPES = {"jpg": ("StillImage", "image/jpeg"), "jpeg": ("StillImage", "image/jpeg"), "png": ("StillImage", "image/png"), "gif": ("StillImage", "image/gif"), "svg": ("StillImage", "image/svg+xml"), "tif": ("StillImage", "image/tiff"), "ogg": ("Sound", "audio/ogg"), "oga": ("Sound", "audio/ogg"), "mp3": ("Sound", "audio/mpeg"), "wav": ("Sound", "audio/wav"), "flac": ("Sound", "audio/flac"), "ogv": ("MovingImage", "video/ogg"), "webm": ("MovingImage", "video/webm"), "pdf": ("Document", "application/pdf"), "djvu": ("Document", "image/vnd.djvu")}


@extractor("file-types", "pages")
def file_types(pages: DataFrame) -> DataFrame:
    ext = F.lower(F.regexp_extract("title", r"\.(\w+)$", 1))
    table = pages.sparkSession.createDataFrame([(k, c, m) for k, (c, m) in FILE_TYPES.items()], "ext__ string, class__ string, mime__ string")
    rows = in_namespaces(pages, FILE).withColumn("ext__", ext).where("ext__ <> ''").join(F.broadcast(table), "ext__", "left")
    name = F.regexp_replace("title", "^[^:]+:", "")
    still = F.col("class__") == "StillImage"
    built = (
        statement("file_information", subject(), ONTOLOGY + "fileURL", S.file_url(name, F.col("lang"), domain=DOMAIN)),
        statement("file_information", subject(), ONTOLOGY + "fileExtension", F.col("ext__"), datatype=XSD + "string"),
        statement("file_information", subject(), "http://purl.org/dc/elements/1.1/format", F.col("mime__"), datatype=XSD + "string"),
        statement("file_information", subject(), RDF + "type", F.concat(F.lit(ONTOLOGY), F.col("class__"))),
        statement("file_information", subject(), RDF + "type", F.when(F.col("class__").isNotNull(), F.lit(ONTOLOGY + "File"))),
        statement("file_information", subject(), FOAF + "depiction", F.when(still, S.file_url(name, F.col("lang"), domain=DOMAIN))),
        statement("file_information", subject(), FOAF + "thumbnail", F.when(still, S.file_url(name, F.col("lang"), 300, DOMAIN))),
    )
    return statements(rows, *built)


@extractor("kml", "pages")
def kml(pages: DataFrame) -> DataFrame:
    body = F.regexp_extract_all("source", F.lit(r'(?is)<source\s+lang="xml"\s*>(.*?)</source>'), 1)
    rows = pages.where(F.col("title").endswith("/overlay.kml")).select("*", F.explode(body).alias("kml__"))
    return statements(rows, statement("kml", resource(F.regexp_replace("title", "/overlay\\.kml$", "")), ONTOLOGY + "hasKMLData", F.trim(F.col("kml__")), datatype=RDF + "XMLLiteral"))


@extractor("galleries", "pages")
def galleries(pages: DataFrame) -> DataFrame:
    """Each file that a gallery lists, with its line."""
    lines = F.posexplode(F.split("source", "\n"))
    w = Window.partitionBy("page_id").orderBy("no__").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = pages.where(F.col("source").contains("<gallery")).select("*", lines.alias("no__", "line__"))
    rows = rows.withColumn("mark__", F.when(F.col("line__").rlike("(?i)<gallery"), F.lit("open")).when(F.col("line__").rlike("(?i)</gallery"), F.lit("closed"))).withColumn("in__", F.last("mark__", True).over(w))
    rows = rows.where((F.col("in__") == "open") & F.col("mark__").isNull()).withColumn("name__", F.trim(F.regexp_extract("line__", r"^\s*(?:[Ff]ile|[Ii]mage|[Dd]atei|[Ff]ichier):([^|]+)", 1))).where("name__ <> ''")
    return statements(rows, statement("galleries", subject(), ONTOLOGY + "galleryItem", resource(F.concat(F.lit("File:"), F.col("name__"))), context=source_iri(F.col("no__") + 1)))


# --- links, categories, templates -------------------------------------------------------------------


def internal_links(pages: DataFrame) -> DataFrame:
    """Pages with a row for each link; to__: what it names."""
    return with_once(exploded(pages, "link"), "to__", title_parts(F.col("node.name")))


@extractor("page-links")
def page_links(pages: DataFrame) -> DataFrame:
    rows = internal_links(in_namespaces(pages, MAIN)).where("to__.language is null and to__.title <> ''")
    full = F.when(F.col("to__.ns") == 0, F.col("to__.title")).otherwise(F.regexp_replace("node.name", "^:", ""))
    return statements(rows, statement("page_links", subject(), ONTOLOGY + "wikiPageWikiLink", resource(full), context=source_iri(F.col("node.line"))))


@extractor("anchor-texts")
def anchor_texts(pages: DataFrame) -> DataFrame:
    rows = internal_links(in_namespaces(pages, MAIN)).where("to__.ns = 0 and to__.language is null and node.text <> ''")
    return statements(rows, statement("anchor_text", resource(F.col("to__.title")), ONTOLOGY + "wikiPageWikiLinkText", F.col("node.text"), datatype=LANG_STRING, language=F.col("lang")))


@extractor("external-links")
def external_links(pages: DataFrame) -> DataFrame:
    rows = exploded(in_namespaces(pages, MAIN), "external")
    return statements(rows, statement("external_links", subject(), ONTOLOGY + "wikiPageExternalLink", S.clean_url(F.col("node.name")), context=source_iri(F.col("node.line"))))


@extractor("interlanguage-links")
def interlanguage_links(pages: DataFrame) -> DataFrame:
    rows = internal_links(pages.where(F.col("ns").isin(MAIN, TEMPLATE, CATEGORY))).where("to__.language is not null and node.depth = 0")
    return statements(rows, statement("interlanguage_links", subject(), OWL + "sameAs", S.resource_iri(F.col("to__.title"), F.col("to__.language"), DOMAIN)))


@extractor("out-degrees")
def out_degrees(pages: DataFrame) -> DataFrame:
    return statements(in_namespaces(pages, MAIN), statement("out_degree", subject(), ONTOLOGY + "wikiPageOutDegree", F.size(of_kind("link")).cast("string"), datatype=XSD + "nonNegativeInteger"))


@extractor("article-categories")
def article_categories(pages: DataFrame) -> DataFrame:
    rows = internal_links(in_namespaces(pages, MAIN)).where(f"to__.ns = {CATEGORY} and not to__.colon")
    return statements(rows, statement("article_categories", subject(), DCT + "subject", resource(F.concat(F.lit("Category:"), F.col("to__.title")))))


@extractor("skos-categories")
def skos_categories(pages: DataFrame) -> DataFrame:
    own = in_namespaces(pages, CATEGORY)
    name = F.regexp_replace("title", "^[^:]+:", "")
    base = statements(own, statement("skos_categories", subject(), RDF + "type", F.lit(SKOS + "Concept")), statement("skos_categories", subject(), SKOS + "prefLabel", name, datatype=LANG_STRING, language=F.col("lang")))
    rows = internal_links(own).where(f"to__.ns = {CATEGORY}")
    kind = F.when(F.col("to__.colon"), SKOS + "related").otherwise(SKOS + "broader")
    return base.unionByName(statements(rows, statement("skos_categories", subject(), kind, resource(F.concat(F.lit("Category:"), F.col("to__.title"))))))


def prop(name: str) -> Column:
    """The last value of a template's key; null if it has none."""
    return F.nullif(F.try_element_at(F.transform(F.filter("node.props", lambda p: F.lower(p["key"]) == name.lower()), lambda p: F.trim(p["value"])), F.lit(-1)), F.lit(""))


def templates(pages: DataFrame, *names: str, top: bool = False) -> DataFrame:
    rows = exploded(pages, "template", top)
    return rows.where(F.lower("node.name").isin([n.lower() for n in names])) if names else rows


#: Names of templates of all languages together.
MAIN_ARTICLE = ("cat main", "catmain", "hauptartikel", "article principal", "categoría principal")


@extractor("topical-concepts")
def topical_concepts(pages: DataFrame) -> DataFrame:
    rows = templates(in_namespaces(pages, CATEGORY), *MAIN_ARTICLE).withColumn("main__", F.coalesce(prop("1"), F.regexp_replace("title", "^[^:]+:", "")))
    return statements(rows, statement("topical_concepts", subject(), SKOS + "subject", resource(F.col("main__"))), statement("topical_concepts", resource(F.col("main__")), RDF + "type", F.lit(ONTOLOGY + "TopicalConcept")))


@extractor("article-templates")
def article_templates(pages: DataFrame) -> DataFrame:
    """Templates outside others, and in a second dataset those that occur inside others only."""
    name = lambda ns: F.transform(ns, lambda n: n["name"])
    top, every = F.array_distinct(name(of_kind("template", True))), F.array_distinct(name(of_kind("template")))
    rows = pages.select("*", F.explode(F.concat(F.transform(top, lambda t: F.struct(F.lit("article_templates").alias("set"), t.alias("name"))), F.transform(F.array_except(every, top), lambda t: F.struct(F.lit("article_templates_nested").alias("set"), t.alias("name"))))).alias("t__"))
    out = statement("article_templates", subject(), ONTOLOGY + "wikiPageUsesTemplate", resource(F.concat(F.lit("Template:"), F.col("t__.name"))))
    return statements(rows, out.withField("dataset", F.col("t__.set")))


@extractor("template-parameters")
def template_parameters(pages: DataFrame) -> DataFrame:
    """Distinct names of the parameters that a template page asks for."""
    found = F.array_distinct(F.regexp_extract_all("source", F.lit(r"\{\{\{\s*([^|{}<>]+?)\s*(?:\||\}\}\})"), 1))
    rows = in_namespaces(pages, TEMPLATE).select("*", F.explode(found).alias("p__"))
    return statements(rows, statement("template_parameters", subject(), ONTOLOGY + "templateUsesParameter", F.col("p__"), datatype=XSD + "string"))


#: Templates of disambiguation pages by language.
DISAMBIGUATIONS = {
    "en": ("disambiguation", "disambig", "dab", "hndis", "geodis", "surname", "given name", "numberdis", "letter-disambig", "human name disambiguation", "place name disambiguation", "airport disambiguation", "mathematical disambiguation", "species latin name disambiguation", "school disambiguation"),
    "de": ("begriffsklärung",), "fr": ("homonymie", "paronymie", "patronyme", "homonymes"), "es": ("desambiguación", "desambig"), "it": ("disambigua",), "pt": ("desambiguação", "desambig"), "nl": ("dp", "doorverwijspagina"), "pl": ("ujednoznacznienie", "disambig"),
    "ru": ("неоднозначность", "disambig"), "sv": ("förgrening", "gren"), "cs": ("rozcestník",), "tr": ("anlam ayrımı",), "el": ("αποσαφήνιση",), "hu": ("egyértelműsítő lap", "egyért"), "ja": ("aimai",), "ca": ("desambiguació",), "ko": ("동음이의",), "zh": ("disambig",), "uk": ("disambig", "неоднозначність"), "fi": ("täsmennyssivu",), "da": ("flertydig",),
}
DISAMBIGUATION = tuple(dict.fromkeys(x for xs in DISAMBIGUATIONS.values() for x in xs))


def disambiguations(pages: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Links of disambiguation pages (by template, or by ids) whose target holds the page's title or spells it as initials."""
    marked = F.exists(of_kind("template"), lambda n: F.lower(n["name"]).isin(*DISAMBIGUATION))
    own = in_namespaces(pages, MAIN)
    by_template = own.where(marked)
    rows = by_template if ids is None else by_template.unionByName(own.where(~marked).join(ids, "page_id", "left_semi"))
    title = F.upper(F.trim(F.regexp_replace("title", r"\s*\([^)]*\)\s*$", "")))
    initials = F.array_join(F.transform(F.filter(F.split("to__.title", r"[\s\-]+"), lambda w: w != ""), lambda w: F.upper(F.substring(w, 1, 1))), "")
    rows = internal_links(rows).where("to__.ns = 0 and to__.language is null").where(F.contains(F.upper("to__.title"), title) | (initials == title))
    return statements(rows, statement("disambiguations", subject(), ONTOLOGY + "wikiPageDisambiguates", resource(F.col("to__.title"))))


extractor("disambiguations")(disambiguations)


@extractor("commons-resources")
def commons_resources(pages: DataFrame) -> DataFrame:
    first = F.try_element_at(F.filter(of_kind("template"), lambda n: F.lower(n["name"]).isin("commons", "commonscat", "commons category")), F.lit(1))
    rows = in_namespaces(pages, MAIN).withColumn("node", first).where("node is not null")
    return statements(rows, statement("commons", subject(), OWL + "sameAs", S.resource_iri(F.coalesce(prop("1"), F.col("title")), F.lit("commons"), DOMAIN)))


@extractor("vernacular-resources")
def vernacular_resources(pages: DataFrame) -> DataFrame:
    """The language keys of the first template of vernacular names."""
    first = F.try_element_at(F.filter(of_kind("template"), lambda n: F.lower(n["name"]) == "vn"), F.lit(1))
    rows = in_namespaces(pages, MAIN).withColumn("node", first).where("node is not null").select("*", F.explode(F.filter("node.props", lambda p: p["key"].isin("de", "en", "fr"))).alias("p__"))
    return statements(rows, statement("vernacular", subject(), OWL + "sameAs", S.resource_iri(F.col("p__.value"), F.col("p__.key"), DOMAIN)))


@extractor("authority-ids")
def authority_ids(pages: DataFrame) -> DataFrame:
    rows = templates(in_namespaces(pages, MAIN), "normdaten", "pnd", "authority control").withColumn("id__", F.coalesce(prop("gnd"), prop("pnd"), prop("1")))
    return statements(rows.where(F.col("id__").rlike(r"^\d{7,9}-?[\dX]$")), statement("pnd", subject(), ONTOLOGY + "individualisedPnd", F.col("id__"), datatype=XSD + "string"))


@extractor("image-annotations")
def image_annotations(pages: DataFrame) -> DataFrame:
    """Notes on images: the nth opening template with the nth closing one, and the text between them."""
    marks = lambda word: F.filter(of_kind("template", True), lambda n: F.lower(n["name"]) == word)
    opened, closed = marks("imagenote"), marks("imagenoteend")
    rows = in_namespaces(pages, FILE).select("*", F.explode(F.arrays_zip(opened.alias("a"), closed.alias("b"))).alias("z__")).where("z__.a is not null and z__.b is not null").withColumn("node", F.col("z__.a"))
    between = F.array_join(F.transform(F.filter("nodes", lambda n: (n["depth"] == 0) & (n["id"] > F.col("z__.a.id")) & (n["id"] < F.col("z__.b.id"))), lambda n: F.coalesce(n["text"], F.lit(""))), "")
    part = F.concat(S.file_url(F.regexp_replace("title", "^[^:]+:", ""), F.col("lang"), domain=DOMAIN), F.lit("#xywh=pixel:"), F.concat_ws(",", prop("x"), prop("y"), prop("w"), prop("h")))
    return statements(rows, statement("image_annotations", subject(), ONTOLOGY + "hasAnnotation", part), statement("image_annotations", part, ONTOLOGY + "asWikiText", F.trim(between), datatype=XSD + "string"))


# --- infoboxes -------------------------------------------------------------------------------------------


#: Templates and keys that aren't data of an infobox.
IGNORED_TEMPLATES = ("persondata", "coord", "cite web", "cite book", "citation", "reflist", "main", "imagenote", "imagenoteend", "commons", "navbox", "r")
IGNORED_KEYS = ("image", "caption", "width", "height", "style", "class", "align", "colour", "color")
FEWEST_KEYS, NAMED_SHARE = 2, 0.75


def infobox_properties(pages: DataFrame) -> DataFrame:
    """A row for each named property of each infobox-like template: at least two named keys, and over three quarters of all."""
    named = lambda props: F.filter(props, lambda p: ~p["key"].rlike(r"^\d+$"))
    rows = templates(in_namespaces(pages, MAIN), top=True).where(~F.lower("node.name").isin(*IGNORED_TEMPLATES))
    rows = rows.withColumn("named__", named(F.col("node.props"))).where((F.size("named__") >= FEWEST_KEYS) & (F.size("named__") / F.size("node.props") > NAMED_SHARE))
    rows = rows.select("*", F.posexplode("named__").alias("at__", "p__")).where(F.trim("p__.value") != "")
    rows = rows.where(~F.lower("p__.key").isin(*IGNORED_KEYS)).withColumn("key__", S.property_key(F.col("p__.key"))).where("key__ <> ''")
    clean = F.regexp_replace(F.regexp_replace("p__.value", r"(?s)<ref[^>]*/>|<ref[^>]*>.*?</ref>|<!--.*?-->", ""), r"\s*\([^()\[\]]*\)", "")
    return rows.withColumn("raw__", F.trim(clean)).withColumn("value__", F.explode(S.trim_split(F.col("raw__"), r"<br\s*/?>|\n\s*\*|;(?![^\[]*\])")))


def surface_links(pages: DataFrame) -> DataFrame:
    """page_id, form (in lower case) and target: what a text links to where a page links it first, in the main namespace."""
    rows = internal_links(pages).where("to__.ns = 0 and to__.language is null and node.text <> ''")
    first = rows.groupBy("page_id", F.lower(F.trim("node.text")).alias("form")).agg(F.min_by(F.col("to__.title"), F.col("node.id")).alias("target"))
    return first.where("target <> ''")


def by_surface(rows: DataFrame, pages: DataFrame, text: str) -> DataFrame:
    """rows (with page_id) and target: what their text links to elsewhere on the page; null if nowhere."""
    links = surface_links(pages).withColumnRenamed("form", "form__")
    return rows.withColumn("form__", F.lower(F.trim(text))).join(links, ["page_id", "form__"], "left").drop("form__")


@extractor("infobox")
def infobox(pages: DataFrame) -> DataFrame:
    """Typed values of infobox properties, and the definition of each property once."""
    rows = with_once(infobox_properties(pages), "typed__", V.Cascade().typed(F.col("value__"))).where("typed__ is not null")
    linked = F.col("value__").rlike(r"^\s*\[\[")
    value = F.when(F.col("typed__.datatype").isNull() & linked, resource(F.col("typed__.value"))).otherwise(F.col("typed__.value"))
    predicate = F.concat(F.lit(f"http://{DOMAIN}/property/"), F.col("key__"))
    lang = F.when(F.col("typed__.datatype") == LANG_STRING, F.col("lang"))
    facts = statements(rows, statement("infobox_properties", subject(), predicate, value, datatype=F.col("typed__.datatype"), language=lang, context=F.concat(source_iri(F.col("p__.line")), F.lit("&template="), S.wiki_encode(F.col("node.name")), F.lit("&property="), F.col("p__.key"))))
    defined = rows.select(predicate.alias("p"), F.col("p__.key").alias("k"), "lang").groupBy("p", "lang").agg(F.min("k").alias("k"))
    definitions = statements(defined, statement("infobox_definitions", F.col("p"), RDF + "type", F.lit(RDF + "Property")), statement("infobox_definitions", F.col("p"), RDFS + "label", F.col("k"), datatype=LANG_STRING, language=F.col("lang")))
    return facts.unionByName(definitions)


def hybrid(raw: DataFrame, mapped: DataFrame) -> DataFrame:
    """raw statements, tagged by whether mapped ones stem from the same template, property and line of the page."""
    key = lambda c: F.struct(*[F.regexp_extract(c, p, 1).alias(n) for n, p in (("page", r"^([^?#]+)"), ("line", r"line=(\d+)"), ("template", r"template=([^&]*)"), ("property", r"property=([^&]*)"))])
    seen = mapped.where("context is not null").select(key("context").alias("k")).distinct().withColumn("hit", F.lit(True))
    out = raw.withColumn("k", key("context")).join(seen, "k", "left")
    tag = F.when(F.col("hit"), "mapped").otherwise("unmapped")
    return out.withColumn("dataset", F.concat(F.lit("infobox_"), tag)).withColumn("context", F.concat("context", F.lit("&"), tag, F.lit("=true"))).drop("k", "hit")


@extractor("infobox-references")
def infobox_references(pages: DataFrame) -> DataFrame:
    """References of infobox properties; a named one without a body takes that of its namesake on the page."""
    rows = infobox_properties(pages)
    body = F.regexp_extract_all("p__.value", F.lit(r"(?s)<ref[^>]*?(?:/>|>(.*?)</ref>)"), 1)
    name = F.regexp_extract_all("p__.value", F.lit(r"(?s)<ref(?:\s+name\s*=\s*\"?([^\"/>]*)\"?)?[^>]*?(?:/>|>.*?</ref>)"), 1)
    rows = rows.select("page_id", "title", "lang", "key__", F.explode(F.arrays_zip(body.alias("body"), name.alias("name"))).alias("r"))
    defined = pages.select("page_id", F.explode(F.arrays_zip(F.regexp_extract_all("source", F.lit(r"(?s)<ref\s+name\s*=\s*\"?([^\"/>]+?)\"?\s*>(.*?)</ref>"), 1).alias("name"), F.regexp_extract_all("source", F.lit(r"(?s)<ref\s+name\s*=\s*\"?([^\"/>]+?)\"?\s*>(.*?)</ref>"), 2).alias("body"))).alias("d"))
    defined = defined.select("page_id", F.trim("d.name").alias("name"), F.col("d.body").alias("full")).dropDuplicates(["page_id", "name"])
    out = rows.withColumn("name", F.trim("r.name")).join(defined, ["page_id", "name"], "left").withColumn("text", F.coalesce(F.nullif("r.body", F.lit("")), "full")).distinct()
    return statements(out, statement("infobox_references", subject(), F.concat(F.lit(f"http://{DOMAIN}/property/"), F.col("key__"), F.lit("Reference")), F.trim("text"), datatype=XSD + "string"))


#: Keys that identify a cited work, in order of trust, and what stands before them in an address.
CITATION_KEYS = ("doi", "isbn", "pmid", "url", "id")
CITATION_PREFIX = {"doi": "https://doi.org/", "isbn": "urn:isbn:", "pmid": "https://pubmed.ncbi.nlm.nih.gov/", "url": "", "id": "urn:id:"}


def citations(pages: DataFrame) -> DataFrame:
    """Pages with a row for each citation template, inside references too, and the address it stands for."""
    from pagequarry.operators.wikitext import parse_wikitext

    bare = F.regexp_replace("source", r"(?i)</?ref[^>]*>", " ")
    rows = exploded(in_namespaces(pages, MAIN).withColumn("nodes", parse_wikitext(bare)), "template").where(F.lower("node.name").rlike("^(?:cite |citation|literatur$|ouvrage$|article$|cita )"))
    ids = [F.concat(F.lit(CITATION_PREFIX[k]), S.wiki_encode(prop(k)) if k != "url" else prop(k)) for k in CITATION_KEYS]
    return rows.withColumn("cite__", F.coalesce(*ids, F.concat(F.lit(f"http://citation.{DOMAIN}/hash/"), F.md5("node.text"))))


@extractor("citations")
def citation_data(pages: DataFrame) -> DataFrame:
    # Links and data read the same rows, so they are parsed once.
    rows = cut(citations(pages).drop("nodes", "source"), "citations")
    links = statements(rows, statement("citation_links", F.col("cite__"), ONTOLOGY + "isCitedBy", subject(), context=source_iri(F.col("node.line"))))
    each = rows.select("*", F.explode(F.filter("node.props", lambda p: (F.trim(p["value"]) != "") & ~p["key"].rlike(r"^\d+$"))).alias("p__"))
    each = with_once(each, "typed__", V.Cascade(units=False).typed(F.col("p__.value"))).where("typed__ is not null")
    data = statement("citation_data", F.col("cite__"), F.concat(F.lit(f"http://{DOMAIN}/property/"), S.property_key(F.col("p__.key"))), F.col("typed__.value"), datatype=F.col("typed__.datatype"), language=F.when(F.col("typed__.datatype") == LANG_STRING, F.col("lang")))
    return links.unionByName(statements(each, data))


@extractor("geo")
def geo(pages: DataFrame) -> DataFrame:
    """The first coordinate template of a page."""
    first = F.try_element_at(F.filter(of_kind("template", True), lambda n: F.lower(n["name"]).isin("coord", "coordinate", "coordinates")), F.lit(1))
    rows = with_once(in_namespaces(pages, MAIN), "g__", V.parse_coordinates(first["text"])).where("g__ is not null")
    text = lambda c: F.col(c).cast("string")
    built = (
        statement("geo_coordinates", subject(), RDF + "type", F.lit(GEO + "SpatialThing")), statement("geo_coordinates", subject(), GEO + "lat", text("g__.lat"), datatype=XSD + "float"),
        statement("geo_coordinates", subject(), GEO + "long", text("g__.lon"), datatype=XSD + "float"), statement("geo_coordinates", subject(), "http://www.georss.org/georss/point", F.concat_ws(" ", text("g__.lat"), text("g__.lon")), datatype=XSD + "string"),
    )
    return statements(rows, *built)


def winner(counts: Mapping[str, Column], least: int, ratio: float) -> Column:
    """The name of the largest count if it is above `least` and above `ratio` times the second; null else."""
    ranked = F.reverse(F.array_sort(F.array(*[F.struct(c.alias("n"), F.lit(k).alias("name")) for k, c in counts.items()])))
    return let(ranked, lambda r: F.when((r[0]["n"] > least) & (r[0]["n"] > ratio * r[1]["n"]), r[0]["name"]))


#: Pronouns by language and gender.
PRONOUNS = {
    "en": {"male": "he|him|his|himself", "female": "she|her|hers|herself"}, "de": {"male": "er|ihm|ihn|sein|seine", "female": "sie|ihr|ihre"}, "fr": {"male": "il|lui", "female": "elle"}, "es": {"male": "él", "female": "ella"},
    "pt": {"male": "ele|dele|nele", "female": "ela|dela|nela"}, "it": {"male": "egli|lui", "female": "ella|lei"}, "nl": {"male": "hij|hem|zijn", "female": "zij|haar"}, "pl": {"male": "on|jego|jemu", "female": "ona|jej"}, "ru": {"male": "он|его|ему", "female": "она|её|ей"},
    "am": {"male": "እሱ|እርሱ", "female": "እሷ|እርሷ"}, "sv": {"male": "han|honom|hans", "female": "hon|henne|hennes"}, "cs": {"male": "on|jeho|jemu", "female": "ona|její"}, "el": {"male": "αυτός|του", "female": "αυτή|της"},
}


def genders(pages: DataFrame, persons: DataFrame) -> DataFrame:
    """Of pages whose subject is among persons (subject): the gender of the pronouns that clearly prevail."""
    best = F.lit(None).cast("string")
    for lang, words in PRONOUNS.items():
        counts = {g: F.regexp_count(F.lower("source"), F.lit(rf"(?<![\p{{L}}])(?:{p})(?![\p{{L}}])")) for g, p in words.items()}
        best = F.when(F.col("lang") == lang, winner(counts, 3, 2.0)).otherwise(best)
    rows = in_namespaces(pages, MAIN).withColumn("subject", subject()).join(persons, "subject", "left_semi").withColumn("g__", best)
    return statements(rows, statement("genders", F.col("subject"), FOAF + "gender", F.col("g__"), datatype=LANG_STRING, language="en"))


#: Keys of homepages, templates of official websites and words of links to them, by language.
HOMEPAGES: dict[str, tuple[tuple[str, ...], tuple[str, ...], str]] = {
    "en": (("homepage", "website", "url", "web"), ("official website", "official", "official site"), "official|homepage"), "de": (("webseite", "website", "homepage", "web", "webauftritt"), ("offizielle website",), "offiziell|homepage|webseite"),
    "fr": (("site web", "siteweb", "site internet", "url"), ("site officiel",), "officiel"), "es": (("sitio web", "web", "página web", "website", "url"), ("sitio oficial", "página oficial"), "oficial"), "it": (("sito", "homepage", "sito web"), ("sito ufficiale",), "ufficiale"),
    "pt": (("website", "site", "página oficial", "url"), ("site oficial", "oficial"), "oficial|página"), "nl": (("website", "site"), ("officiële website",), "officieel|officiële"), "pl": (("www", "strona", "strona internetowa"), ("oficjalna strona",), "oficjaln"), "ru": (("сайт", "website"), ("официальный сайт",), "официальный"),
    "ca": (("web", "lloc web"), ("web oficial",), "oficial"), "el": (("ιστοσελίδα", "ιστότοπος"), ("επίσημη ιστοσελίδα",), "επίσημ"), "sv": (("webbplats", "hemsida"), ("officiell webbplats",), "officiell"), "tr": (("website", "site", "internet sitesi"), ("resmî site",), "resm[iî]"),
}
HOMEPAGE_KEYS, OFFICIAL = (tuple(dict.fromkeys(x for of in HOMEPAGES.values() for x in of[k])) for k in (0, 1))
OFFICIAL_WORDS = "|".join(dict.fromkeys(w for of in HOMEPAGES.values() for w in of[2].split("|")))


@extractor("homepages")
def homepages(pages: DataFrame) -> DataFrame:
    """The first usable address of an infobox's homepage keys, of a template of official websites, or of an external link named official."""
    address = lambda x: S.clean_url(F.coalesce(F.nullif(F.regexp_extract(x, r"((?:https?://|www\.)[^\s\]|}<]+)", 1), F.lit("")), F.lit("")))
    every = F.flatten(F.transform(of_kind("template"), lambda n: F.transform(F.filter(n["props"], lambda p: F.lower(p["key"]).isin(*HOMEPAGE_KEYS)), lambda p: address(p["value"]))))
    official = F.transform(F.filter(of_kind("template"), lambda n: F.lower(n["name"]).isin(*OFFICIAL)), lambda n: address(n["text"]))
    named = F.transform(F.filter(of_kind("external"), lambda n: F.lower(n["text"]).rlike(OFFICIAL_WORDS)), lambda n: address(n["name"]))
    first = F.try_element_at(F.filter(F.concat(every, official, named), lambda x: x.isNotNull()), F.lit(1))
    return statements(in_namespaces(pages, MAIN), statement("homepages", subject(), FOAF + "homepage", first))


#: Templates with data of persons, and their keys by what they say, of all languages.
PERSON_TEMPLATES = ("persondata", "personendaten", "métadonnées personne", "dados de pessoa")
PERSON_KEYS = {
    "name": ("name", "nom", "nome"), "description": ("short description", "kurzbeschreibung", "courte description", "descrição curta"), "born": ("date of birth", "geburtsdatum", "date de naissance", "data de nascimento"),
    "died": ("date of death", "sterbedatum", "date de décès", "data de morte"), "born at": ("place of birth", "geburtsort", "lieu de naissance", "local de nascimento"), "died at": ("place of death", "sterbeort", "lieu de décès", "local de morte"),
}


@extractor("persondata")
def persondata(pages: DataFrame) -> DataFrame:
    rows = templates(in_namespaces(pages, MAIN), *PERSON_TEMPLATES).withColumn("n__", F.coalesce(*[prop(k) for k in PERSON_KEYS["name"]], F.col("title")))
    parts = F.split("n__", r"\s*,\s*")
    sur, given = F.when(F.size(parts) > 1, parts[0]), F.when(F.size(parts) > 1, F.get(parts, F.lit(1)))
    full = F.when(F.size(parts) > 1, F.concat_ws(" ", given, sur)).otherwise(F.col("n__"))
    date = lambda *k: V.parse_date(F.coalesce(*[prop(x) for x in k]))
    rows = rows.withColumn("b__", date(*PERSON_KEYS["born"])).withColumn("d__", date(*PERSON_KEYS["died"]))
    lang = dict(datatype=LANG_STRING, language=F.col("lang"))
    place = lambda *k: F.nullif(resource(F.regexp_extract(F.coalesce(*[prop(x) for x in k]), r"\[\[([^\]|#]+)", 1)), resource(F.lit("")))
    built = (
        statement("persondata", subject(), RDF + "type", F.lit(FOAF + "Person")), statement("persondata", subject(), FOAF + "name", full, **lang), statement("persondata", subject(), FOAF + "surname", sur, **lang),
        statement("persondata", subject(), FOAF + "givenName", given, **lang), statement("persondata", subject(), DCT + "description", F.coalesce(*[prop(k) for k in PERSON_KEYS["description"]]), **lang),
        statement("persondata", subject(), ONTOLOGY + "birthDate", V.date_text(F.col("b__")), datatype=F.col("b__.type")), statement("persondata", subject(), ONTOLOGY + "deathDate", V.date_text(F.col("d__")), datatype=F.col("d__.type")),
        statement("persondata", subject(), ONTOLOGY + "birthPlace", place(*PERSON_KEYS["born at"])), statement("persondata", subject(), ONTOLOGY + "deathPlace", place(*PERSON_KEYS["died at"])),
    )
    return statements(rows, *built)


@extractor("population")
def population(pages: DataFrame) -> DataFrame:
    rows = exploded(pages, "template").where(F.lower("node.name").rlike("population|données"))
    return statements(rows, statement("population", subject(), ONTOLOGY + "populationTotal", F.nullif(F.regexp_extract("node.text", r"pop\s*=\s*(\d+)", 1), F.lit("")), datatype=XSD + "nonNegativeInteger"))


# --- images and media -------------------------------------------------------------------------------------------


IMAGE = r"(?i)^(?:file|image|datei|bild|fichier|archivo):\s*(.+\.(?:jpe?g|png|gif|svg|tiff?))$"
MEDIA = r"(?i)^(?:file|image|media|datei|fichier|archivo):\s*(.+\.\w+)$"


def image_rows(pages: DataFrame) -> DataFrame:
    """A row for each image that a page shows by a link or by a template's value, in document order, with its section's number."""
    w = Window.partitionBy("page_id").orderBy("node.id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nodes = in_namespaces(pages, MAIN).select("page_id", "title", "lang", "revision", "ns", F.explode("nodes").alias("node")).withColumn("section__", F.sum((F.col("node.kind") == "section").cast("int")).over(w))
    by_link = F.when(F.col("node.kind") == "link", F.array(F.regexp_extract("node.name", IMAGE, 1)))
    by_value = F.when(F.col("node.kind") == "template", F.transform("node.props", lambda p: F.regexp_extract(F.trim(p["value"]), r"(?i)^(?:\[\[)?(?:(?:file|image|datei|fichier):)?\s*([^\[\]|{}<>\n]+\.(?:jpe?g|png|gif|svg|tiff?))", 1)))
    return nodes.select("*", F.posexplode(F.filter(F.coalesce(by_link, by_value, F.array().cast("array<string>")), lambda x: x != "")).alias("k__", "image__"))


def images(pages: DataFrame, not_free: DataFrame | None = None) -> DataFrame:
    """The first image in the first two sections that isn't among not_free (image), with its thumbnail."""
    rows = image_rows(pages).where("section__ < 2")
    if not_free is not None:
        rows = rows.join(not_free.select(F.col("image").alias("image__")), "image__", "left_anti")
    first = rows.groupBy("page_id", "title", "lang").agg(F.min_by("image__", F.struct(F.col("node.id"), F.col("k__"))).alias("image__"))
    url, thumb = S.file_url(F.col("image__"), F.col("lang"), domain=DOMAIN), S.file_url(F.col("image__"), F.col("lang"), 300, DOMAIN)
    built = (
        statement("images", subject(), FOAF + "depiction", url), statement("images", subject(), ONTOLOGY + "thumbnail", thumb), statement("images", url, FOAF + "thumbnail", thumb),
        statement("images", thumb, RDF + "type", F.lit(ONTOLOGY + "Image")), statement("images", url, RDF + "type", F.lit(ONTOLOGY + "Image")),
        statement("images", url, "http://purl.org/dc/elements/1.1/rights", F.concat(F.lit("http://"), F.col("lang"), F.lit(f".{DOMAIN}/wiki/File:"), S.wiki_encode(F.col("image__")))),
        statement("images", thumb, "http://purl.org/dc/elements/1.1/rights", F.concat(F.lit("http://"), F.col("lang"), F.lit(f".{DOMAIN}/wiki/File:"), S.wiki_encode(F.col("image__")))),
    )
    return statements(first, *built)


extractor("images")(images)


@extractor("all-images")
def all_images(pages: DataFrame) -> DataFrame:
    """Every image with what it shows: a flag, a coat of arms, a signature, a map, the main image, or any."""
    n = F.lower("image__")
    kind = F.when(n.rlike("flag|flagge|drapeau|bandera"), "flag").when(n.rlike("coat.?of.?arms|wappen|blason|escudo"), "coatOfArms").when(n.rlike("signature|unterschrift|firma"), "signature").when(n.rlike("map|karte|carte|mapa|locator"), "map")
    w = Window.partitionBy("page_id").orderBy("node.id", "k__")
    rows = image_rows(pages).withColumn("kind__", kind).withColumn("first__", F.row_number().over(Window.partitionBy("page_id", F.col("kind__").isNull()).orderBy("node.id", "k__")))
    name = F.coalesce("kind__", F.when(F.col("first__") == 1, "mainImage").otherwise("image"))
    return statements(rows.withColumn("rank__", F.row_number().over(w)), statement("images_all", subject(), F.concat(F.lit(ONTOLOGY), name), S.file_url(F.col("image__"), F.col("lang"), domain=DOMAIN)))


@extractor("media")
def media(pages: DataFrame) -> DataFrame:
    rows = exploded(in_namespaces(pages, MAIN), "link").withColumn("m__", F.regexp_extract("node.name", MEDIA, 1)).where("m__ <> ''")
    return statements(rows, statement("media", subject(), ONTOLOGY + "media", S.file_url(F.col("m__"), F.col("lang"), domain=DOMAIN)))


@extractor("infobox-mappings")
def infobox_mappings(pages: DataFrame) -> DataFrame:
    """Hints on template pages that link a parameter to a property of the item base (#property, #invoke, #if)."""
    rows = in_namespaces(pages, TEMPLATE)
    pair = r"\{\{\{\s*([^|{}]+?)\s*(?:\|[^{}]*)?(?:\|?\s*\{\{#(?:property:|invoke:[^{}]*?\|)\s*(P\d+)[^{}]*\}\})"
    both = F.arrays_zip(F.regexp_extract_all("source", F.lit(pair), 1).alias("k"), F.regexp_extract_all("source", F.lit(pair), 2).alias("p"))
    cond = r"\{\{#if:\s*\{\{\{\s*([^|{}]+?)\s*\|?\s*\}\}\}\s*\|[^#]*?\{\{#(?:property:|invoke:[^{}]*?\|)\s*(P\d+)"
    more = F.arrays_zip(F.regexp_extract_all("source", F.lit(cond), 1).alias("k"), F.regexp_extract_all("source", F.lit(cond), 2).alias("p"))
    rows = rows.select("*", F.explode(F.array_distinct(F.concat(both, more))).alias("m__"))
    return statements(rows, statement("template_mappings", subject(), ONTOLOGY + "mapsParameter", F.concat_ws("=", F.col("m__.k"), F.col("m__.p")), datatype=XSD + "string"))
