"""Queries over the wikitext and item fixtures; their SQL gives the rows expected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.model import FOAF, OWL, RDF, RDFS, SKOS
from pagequarry.operators import extractors, mapping, nif, wikidata
from pagequarry.operators.wikitext import exploded, parsed, table_grid
from pagequarry.plans import fixtures
from pagequarry.plans.catalogue import Tables, query

EN, DE = "http://en.example.org/resource/", "http://de.example.org/resource/"
O, P = "http://example.org/ontology/", "http://example.org/property/"
E = wikidata.ENTITY


def rows(columns: str, values: Sequence[tuple]) -> str:
    text = lambda v: "NULL" if v is None else str(v) if isinstance(v, int | float) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, v)) + ')' for v in values)}) v({columns})"


SPV = "subject, predicate, value"


def run(t: Tables, name: str) -> DataFrame:
    source = fixtures.items(t.spark) if extractors.REGISTRY[name][0] == "json" else fixtures.pages(t.spark)
    return extractors.extract(source, [name]).select("subject", "predicate", "value")


def golden(query_name: str, extractor: str, expected: Sequence[tuple]) -> None:
    """A query that runs one extractor over the fixtures."""
    def f(t: Tables) -> DataFrame:
        return run(t, extractor)

    f.__name__ = query_name
    query(rows(SPV, expected))(f)


MAIN_PAGES = ("Bruck", "Ada_Stein", "Mercury", "Broken_%7B%7B", "Zürich")
golden("wiki_labels", "labels", [(EN + n, RDFS + "label", t) for n, t in zip(MAIN_PAGES, ("Bruck", "Ada Stein", "Mercury", "Broken {{", "Zürich"), strict=True)])
golden("wiki_category_labels", "category-labels", [(EN + "Category:Towns_in_Styria", RDFS + "label", "Towns in Styria")])
golden("wiki_redirects", "redirects", [(EN + "Bruck_an_der_Mur", O + "wikiPageRedirects", EN + "Bruck")])
golden("wiki_page_links", "page-links", [(EN + "Bruck", O + "wikiPageWikiLink", EN + x) for x in ("Ada_Stein", "Ulm", "Graz", "Styria", "Mur_(river)", "History_of_Bruck", "Category:Towns_in_Styria", "Category:Rivers", "File:Bruck_view.jpg")] + [(EN + "Ada_Stein", O + "wikiPageWikiLink", EN + x) for x in ("Bruck", "Category:Poets")] + [(EN + "Mercury", O + "wikiPageWikiLink", EN + x) for x in ("Mercury_(planet)", "Mercury_(element)", "Hermes")])
golden("wiki_interlanguage_links", "interlanguage-links", [(EN + "Bruck", OWL + "sameAs", DE + "Bruck_an_der_Mur")])
golden("wiki_out_degrees", "out-degrees", [(EN + n, O + "wikiPageOutDegree", k) for n, k in zip(MAIN_PAGES, ("10", "3", "3", "0", "0"), strict=True)])
golden("wiki_article_categories", "article-categories", [(EN + "Bruck", "http://purl.org/dc/terms/subject", EN + "Category:Towns_in_Styria"), (EN + "Ada_Stein", "http://purl.org/dc/terms/subject", EN + "Category:Poets")])
golden("wiki_skos_categories", "skos-categories", [(EN + "Category:Towns_in_Styria", RDF + "type", SKOS + "Concept"), (EN + "Category:Towns_in_Styria", SKOS + "prefLabel", "Towns in Styria"), (EN + "Category:Towns_in_Styria", SKOS + "broader", EN + "Category:Styria"), (EN + "Category:Towns_in_Styria", SKOS + "related", EN + "Category:Towns")])
golden("wiki_topical_concepts", "topical-concepts", [(EN + "Category:Towns_in_Styria", SKOS + "subject", EN + "Styria"), (EN + "Styria", RDF + "type", O + "TopicalConcept")])
golden("wiki_disambiguations", "disambiguations", [(EN + "Mercury", O + "wikiPageDisambiguates", EN + x) for x in ("Mercury_(planet)", "Mercury_(element)")])
golden("wiki_template_parameters", "template-parameters", [(EN + "Template:Infobox_town", O + "templateUsesParameter", x) for x in ("name", "population", "area", "mayor")])
golden("wiki_infobox_mappings", "infobox-mappings", [(EN + "Template:Infobox_town", O + "mapsParameter", x) for x in ("area=P2046", "mayor=P6")])
golden("wiki_galleries", "galleries", [(EN + "Broken_%7B%7B", O + "galleryItem", EN + x) for x in ("File:One.png", "File:Two.png")])
golden("wiki_homepages", "homepages", [(EN + "Bruck", FOAF + "homepage", "http://bruck.example/"), (EN + "Ada_Stein", FOAF + "homepage", "http://www.stein.example")])
golden("wiki_geo", "geo", [(EN + "Bruck", RDF + "type", "http://www.w3.org/2003/01/geo/wgs84_pos#SpatialThing"), (EN + "Bruck", "http://www.w3.org/2003/01/geo/wgs84_pos#lat", "47.4"), (EN + "Bruck", "http://www.w3.org/2003/01/geo/wgs84_pos#long", "15.266666666666667"), (EN + "Bruck", "http://www.georss.org/georss/point", "47.4 15.266666666666667")])
golden("wiki_persondata", "persondata", [(EN + "Ada_Stein", p, v) for p, v in ((RDF + "type", FOAF + "Person"), (FOAF + "name", "Ada Stein"), (FOAF + "surname", "Stein"), (FOAF + "givenName", "Ada"), ("http://purl.org/dc/terms/description", "poet"), (O + "birthDate", "1901-03-01"), (O + "deathDate", "1980"), (O + "birthPlace", EN + "Bruck"))])
golden("wiki_infobox", "infobox", [(EN + "Bruck", P + k, v) for k, v in (("name", "Bruck"), ("population", "12345"), ("area", "42.5"), ("founded", "1250-05-03"), ("mayor", EN + "Ada_Stein"), ("website", "http://bruck.example/"), ("twin", EN + "Ulm"), ("twin", EN + "Graz"))] + [(P + k, q, v) for k in ("name", "population", "area", "founded", "mayor", "website", "twin") for q, v in ((RDF + "type", RDF + "Property"), (RDFS + "label", k))])
golden("wiki_citations", "citations", [("http://a.example/x", O + "isCitedBy", EN + "Bruck"), ("http://a.example/x", P + "url", "http://a.example/x"), ("http://a.example/x", P + "title", "On Bruck"), ("http://a.example/x", P + "year", "1999")])
golden("wiki_file_types", "file-types", [(EN + "File:Bruck_view.jpg", p, v) for p, v in ((O + "fileURL", "http://en.example.org/wiki/Special:FilePath/Bruck_view.jpg"), (O + "fileExtension", "jpg"), ("http://purl.org/dc/elements/1.1/format", "image/jpeg"), (RDF + "type", O + "StillImage"), (RDF + "type", O + "File"), (FOAF + "depiction", "http://en.example.org/wiki/Special:FilePath/Bruck_view.jpg"), (FOAF + "thumbnail", "http://en.example.org/wiki/Special:FilePath/Bruck_view.jpg?width=300"))])
golden("wiki_media", "media", [(EN + "Bruck", O + "media", "http://en.example.org/wiki/Special:FilePath/Bruck_view.jpg")])
golden("item_labels", "item-labels", [(E + "Q1", RDFS + "label", "Bruck"), (E + "Q1", RDFS + "label", "ブルック")])
golden("item_aliases", "item-aliases", [(E + "Q1", SKOS + "altLabel", "Brugg"), (E + "Q1", SKOS + "altLabel", "Bruk")])
golden("item_descriptions", "item-descriptions", [(E + "Q1", "http://purl.org/dc/terms/description", "town")])
golden("item_same_as", "item-same-as", [(E + "Q1", OWL + "sameAs", EN + "Bruck"), (E + "Q1", OWL + "sameAs", DE + "Bruck_an_der_Mur"), (E + "Q1", OWL + "sameAs", "http://commons.example.org/resource/Bruck")])


@query(rows(SPV, [(E + "Q1", E + "P31", E + "Q2"), (E + "Q1", E + "P571", "1250-05-10"), (E + "Q1", E + "P1082", "12000"), (E + "Q1", E + "P1082", "12345"), (E + "Q1", E + "P625", "47.4 15.27")]))
def item_claims(t: Tables) -> DataFrame:
    out = extractors.extract(fixtures.items(t.spark), ["item-raw"])
    return out.where("dataset = 'item_raw'").select("subject", "predicate", "value")


@query(rows(SPV, [(E + "Q1", O + "type", O + "Town"), (E + "Q1", O + "population", "12345"), (E + "Q1", "geo:lat", "47.4"), (E + "Q1", "geo:long", "15.27")]))
def item_mapped(t: Tables) -> DataFrame:
    commands = [("P31", O + "type", "$getClass"), ("P1082", O + "population", "$1"), ("P625", "geo:lat", "$getLatitude"), ("P625", "geo:long", "$getLongitude")]
    c = t.spark.createDataFrame(commands, "prop string, predicate string, command string")
    k = t.spark.createDataFrame([("Q2", O + "Town")], "item string, class string")
    return wikidata.mapped(fixtures.items(t.spark), c, k).select("subject", "predicate", "value")


@query(rows("page_id, kind, n", [(1, "section", 2), (1, "template", 3), (1, "link", 10), (1, "external", 3), (1, "table", 1), (2, "template", 2), (2, "link", 3), (4, "link", 3), (4, "template", 1)]))
def wiki_node_counts(t: Tables) -> DataFrame:
    nodes = parsed(fixtures.pages(t.spark).where("page_id in (1, 2, 4)")).select("page_id", F.explode("nodes").alias("n")).select("page_id", F.col("n.kind").alias("kind"))
    return nodes.where("kind not in ('text', 'parameter')").groupBy("page_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(rows("r, c, cell", [(0, 0, "Year"), (0, 1, "Event"), (1, 0, "1290"), (1, 1, "Siege"), (2, 0, "1290"), (2, 1, "Fire")]))
def wiki_table_grid(t: Tables) -> DataFrame:
    grid = exploded(parsed(fixtures.pages(t.spark).where("page_id = 1")), "table").select(F.posexplode(table_grid("node.rows")).alias("r", "row"))
    return grid.select("r", F.posexplode("row").alias("c", "cell"))


RULES = [
    ("Infobox town", "population", "simple", "populationTotal", "integer", True), ("Infobox town", "area", "simple", "areaTotal", "unit", True), ("Infobox town", "founded", "simple", "foundingDate", "date", True),
    ("Infobox town", "mayor", "simple", "leader", "object", True), ("Infobox town", "twin", "simple", "twinTown", "object", False),
]


@query(rows(SPV, [(EN + "Bruck", RDF + "type", O + "Town"), (EN + "Bruck", O + "populationTotal", "12345"), (EN + "Bruck", O + "areaTotal", "42.5"), (EN + "Bruck", O + "areaTotal", "4.25E7"), (EN + "Bruck", O + "foundingDate", "1250-05-03"), (EN + "Bruck", O + "leader", EN + "Ada_Stein"), (EN + "Bruck", O + "twinTown", EN + "Ulm"), (EN + "Bruck", O + "twinTown", EN + "Graz")]))
def wiki_mappings(t: Tables) -> DataFrame:
    names = [f.split()[0] for f in mapping.RULE_SCHEMA.split(", ")]
    made = [tuple(dict(zip(("template", "key", "kind", "predicate", "range", "functional"), r, strict=True)).get(n) for n in names) for r in RULES]
    rules = t.spark.createDataFrame(made, mapping.RULE_SCHEMA)
    classes = t.spark.createDataFrame([("Infobox town", "Town", "Place")], "template string, class string, root string")
    return mapping.map_templates(parsed(fixtures.pages(t.spark)), classes, rules).select("subject", "predicate", "value")


@query(rows(SPV, [(EN + "Bruck__table0__1", RDF + "type", O + "Event"), (EN + "Bruck__table0__2", RDF + "type", O + "Event"), (EN + "Bruck__table0__1", O + "year", "1290"), (EN + "Bruck__table0__2", O + "year", "1290"), (EN + "Bruck__table0__1", O + "name", "Siege"), (EN + "Bruck__table0__2", O + "name", "Fire")]))
def wiki_table_mappings(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame([("year", "year", "Event", "integer"), ("event", "name", "Event", "string")], "keyword string, predicate string, class string, range string")
    return mapping.map_tables(parsed(fixtures.pages(t.spark)), rules).select("subject", "predicate", "value")


@query(rows("page_id, abstract", [(1, "Bruck is a town in Styria. It lies on the Mur.")]))
def wiki_abstracts(t: Tables) -> DataFrame:
    return nif.short_abstracts(fixtures.pages(t.spark).where("page_id = 1")).select("page_id", F.col("short").alias("abstract"))


@query(rows("subject, predicate, value", [(EN + "Ada_Stein", FOAF + "gender", "female")]))
def wiki_genders(t: Tables) -> DataFrame:
    persons = t.spark.createDataFrame([(EN + "Ada_Stein",)], "subject string")
    return extractors.genders(fixtures.pages(t.spark), persons).select("subject", "predicate", "value")


@query()
def html_text_model(t: Tables) -> DataFrame:
    """Pieces of the rendered pages with their offsets."""
    return nif.model(t.pages).select("page_id", "ord", "kind", "section", "begin", "end")


@query()
def html_links(t: Tables) -> DataFrame:
    return nif.links(nif.model(t.pages))


@query()
def html_abstracts(t: Tables) -> DataFrame:
    return nif.abstracts(nif.model(t.pages))


