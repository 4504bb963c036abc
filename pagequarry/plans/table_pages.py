"""Queries that run extractors over pages written from the relational tables, at any scale.

Wikitext of a customer, a nation's category, a supplier's file and a region's template, and items of parts,
are concatenated from columns; the same pieces make the texts in SQL. So each expected statement
follows from the tables, not from a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.model import DCT, FOAF, OWL, RDF, RDFS, SKOS
from pagequarry.operators import extractors, nif, post, wikidata
from pagequarry.operators.mapping import RULE_SCHEMA, map_templates
from pagequarry.operators.wikitext import parsed
from pagequarry.plans.catalogue import Tables, query

EN = "http://en.example.org/resource/"
WIKI = "http://en.example.org/wiki/"
O, P = "http://example.org/ontology/", "http://example.org/property/"
E = wikidata.ENTITY
#: A column's name between guillemets is its value.
CUSTOMER = """{{Infobox customer
| name = Customer «k»
| segment = [[«seg»]]<ref name="s">Ledger «k»</ref>
| serial = «k7»
| website = http://c«k».example/
| note = {{Nobr|a «n»}}
}}
{{Normdaten|GND=«gnd»}}
{{Commons|Customer «k»}}
{{VN|de=Kunde «k»|la=Cliens «k»|fr=Client «k»}}
{{Coord|«lat»|33.25}}
{{Population|pop = «k7»}}
'''Customer «k»''' lives in [[Nation «n»|the nation]].<ref name="r">{{cite web|url=http://bank.example/«k»|title=On «k»}}</ref>

== Account ==
[[File:Flag «n».png|thumb|A flag]]
See [http://a«k».example/ its account].
[[Category:Segment «seg»]]
[[de:Kunde «k»]]
"""
#: Names of columns as expressions, which mean the same in both languages.
COLUMNS = {"k": "c_custkey", "seg": "c_mktsegment", "n": "c_nationkey", "k7": "c_custkey * 7", "gnd": "10000000 + c_custkey", "lat": "concat(c_custkey % 80, '.5')"}


def pieces(text: str) -> list[tuple[bool, str]]:
    """(is a column, name or words) in order."""
    out: list[tuple[bool, str]] = []
    for k, part in enumerate(text.replace("»", "«").split("«")):
        if part:
            out.append((k % 2 == 1, part))
    return out


def spark_text(text: str) -> Column:
    return F.concat(*[F.expr(COLUMNS[x]).cast("string") if named else F.lit(x) for named, x in pieces(text)])


def sql_text(text: str) -> str:
    return " || ".join(f"CAST({COLUMNS[x]} AS VARCHAR)" if named else "'" + x.replace("'", "''") + "'" for named, x in pieces(text))


def customers(t: Tables) -> DataFrame:
    """A page for each customer; every tenth redirects to the one before."""
    k, redirect = F.col("c_custkey"), F.col("c_custkey") % 10 == 0
    target = F.concat(F.lit("Customer "), (k - 1).cast("string"))
    return post.spread(t.customer, "c_custkey").select(
        k.alias("page_id"), F.concat(F.lit("Customer "), k.cast("string")).alias("title"), F.lit(0).alias("ns"), (k + 1000).alias("revision"),
        F.lit("2024-05-06 07:08:09").cast("timestamp").alias("ts"), F.col("c_nationkey").cast("long").alias("contributor_id"), F.concat(F.lit("Editor "), F.col("c_nationkey").cast("string")).alias("contributor_name"),
        F.when(redirect, target).alias("redirect"), F.when(redirect, F.concat(F.lit("#REDIRECT [["), target, F.lit("]]"))).otherwise(spark_text(CUSTOMER)).alias("source"),
        F.lit("text/x-wiki").alias("format"), F.lit("en").alias("lang"),
    )


ALL = f"(SELECT c_custkey AS k, c_mktsegment AS seg, c_nationkey AS n, '{EN}Customer_' || c_custkey AS s, '{WIKI}Customer_' || c_custkey AS page, c_custkey % 10 = 0 AS r FROM customer)"
#: Pages that aren't redirects.
OWN = f"(SELECT * FROM {ALL} WHERE NOT r)"
SPV = ["subject", "predicate", "value"]


def union(*rows: tuple[str, str, str], of: str = OWN) -> str:
    """SQL of statements: subject, predicate and value as expressions over a table."""
    return " UNION ALL ".join(f"SELECT {s} AS subject, '{p}' AS predicate, CAST({v} AS VARCHAR) AS value FROM {of}" for s, p, v in rows)


def checked(name: str, extractor: str, sql: str, leave_out: str | None = None) -> None:
    """A query that runs one extractor over the customers' pages."""

    def f(t: Tables) -> DataFrame:
        out = extractors.extract(customers(t), [extractor]).select(*SPV)
        return out.where(leave_out) if leave_out else out

    f.__name__ = name
    query(sql)(f)


checked("table_labels", "labels", union(("s", RDFS + "label", "'Customer ' || k")))
checked("table_page_ids", "page-ids", union(("s", O + "wikiPageID", "k"), of=ALL))
checked("table_revision_ids", "revision-ids", union(("s", O + "wikiPageRevisionID", "k + 1000"), of=ALL))
checked("table_provenance", "provenance", union(("s", "http://www.w3.org/ns/prov#wasDerivedFrom", "page || '?oldid=' || (k + 1000) || '&ns=0'"), of=ALL))
checked("table_page_lengths", "page-lengths", f"SELECT '{EN}Customer_' || c_custkey AS subject, '{O}wikiPageLength' AS predicate, CAST(length({sql_text(CUSTOMER)}) AS VARCHAR) AS value FROM customer WHERE c_custkey % 10 <> 0")
checked("table_redirects", "redirects", f"SELECT s AS subject, '{O}wikiPageRedirects' AS predicate, '{EN}Customer_' || (k - 1) AS value FROM {ALL} WHERE r")
checked(
    "table_meta_information", "meta-information",
    union(
        ("s", DCT + "modified", "'2024-05-06T07:08:09Z'"), ("s", O + "wikiPageEditLink", "'http://en.example.org/w/index.php?title=Customer_' || k || '&action=edit'"),
        ("s", O + "wikiPageRevisionLink", "'http://en.example.org/w/index.php?title=Customer_' || k || '&oldid=' || (k + 1000)"), ("s", O + "wikiPageHistoryLink", "'http://en.example.org/w/index.php?title=Customer_' || k || '&action=history'"),
    ),
    leave_out=f"predicate <> '{O}wikiPageExtracted'",
)
EDITED = f"(SELECT DISTINCT n, '{WIKI}User:Editor_' || n AS who FROM {OWN} WHERE n > 0)"
checked("table_contributors", "contributors", union(("s", DCT + "contributor", f"'{WIKI}User:Editor_' || n"), of=f"(SELECT * FROM {OWN} WHERE n > 0)") + " UNION ALL " + union(("who", RDFS + "label", "'Editor ' || n"), ("who", O + "wikiPageUserID", "n"), of=EDITED))
checked("table_article_pages", "article-pages", union(("s", FOAF + "isPrimaryTopicOf", "page"), ("page", FOAF + "primaryTopic", "s"), ("page", "http://purl.org/dc/elements/1.1/language", "'en'"), ("page", RDF + "type", f"'{FOAF}Document'")))
checked("table_page_links", "page-links", union(("s", O + "wikiPageWikiLink", f"'{EN}' || seg"), ("s", O + "wikiPageWikiLink", f"'{EN}Nation_' || n"), ("s", O + "wikiPageWikiLink", f"'{EN}File:Flag_' || n || '.png'"), ("s", O + "wikiPageWikiLink", f"'{EN}Category:Segment_' || seg")))
ANCHORS = union((f"'{EN}' || seg", O + "wikiPageWikiLinkText", "seg"), (f"'{EN}Nation_' || n", O + "wikiPageWikiLinkText", "'the nation'"))
checked("table_anchor_texts", "anchor-texts", f"SELECT DISTINCT * FROM ({ANCHORS})")
checked("table_external_links", "external-links", union(("s", O + "wikiPageExternalLink", "'http://c' || k || '.example/'"), ("s", O + "wikiPageExternalLink", "'http://bank.example/' || k"), ("s", O + "wikiPageExternalLink", "'http://a' || k || '.example/'")))
checked("table_interlanguage_links", "interlanguage-links", union(("s", OWL + "sameAs", "'http://de.example.org/resource/Kunde_' || k")))
checked("table_out_degrees", "out-degrees", union(("s", O + "wikiPageOutDegree", "5")))
checked("table_article_categories", "article-categories", union(("s", DCT + "subject", f"'{EN}Category:Segment_' || seg")))
USED = ("Infobox_customer", "Normdaten", "Commons", "VN", "Coord", "Population", "Cite_web", "Nobr")
checked("table_article_templates", "article-templates", union(*[("s", O + "wikiPageUsesTemplate", f"'{EN}Template:{x}'") for x in USED]))
checked("table_authority_ids", "authority-ids", union(("s", O + "individualisedPnd", "10000000 + k")))
checked("table_commons_resources", "commons-resources", union(("s", OWL + "sameAs", "'http://commons.example.org/resource/Customer_' || k")))
checked("table_vernacular_resources", "vernacular-resources", union(("s", OWL + "sameAs", "'http://de.example.org/resource/Kunde_' || k"), ("s", OWL + "sameAs", "'http://fr.example.org/resource/Client_' || k")))
checked("table_homepages", "homepages", union(("s", FOAF + "homepage", "'http://c' || k || '.example/'")))
checked("table_population", "population", union(("s", O + "populationTotal", "k * 7")))
checked("table_citations", "citations", union(("'http://bank.example/' || k", O + "isCitedBy", "s"), ("'http://bank.example/' || k", P + "url", "'http://bank.example/' || k"), ("'http://bank.example/' || k", P + "title", "'On ' || k")))
checked("table_infobox_references", "infobox-references", union(("s", P + "segmentReference", "'Ledger ' || k")))
FLAG = "'http://en.example.org/wiki/Special:FilePath/Flag_' || n || '.png'"
checked("table_all_images", "all-images", union(("s", O + "flag", FLAG)))
checked("table_media", "media", union(("s", O + "media", FLAG)))
FLAGS = f"(SELECT DISTINCT n FROM {OWN})"
RIGHTS = f"'{WIKI}File:Flag_' || n || '.png'"
checked(
    "table_images", "images",
    union(("s", FOAF + "depiction", FLAG), ("s", O + "thumbnail", f"{FLAG} || '?width=300'")) + " UNION ALL "
    + union((FLAG, FOAF + "thumbnail", f"{FLAG} || '?width=300'"), (f"{FLAG} || '?width=300'", RDF + "type", f"'{O}Image'"), (FLAG, RDF + "type", f"'{O}Image'"), (FLAG, "http://purl.org/dc/elements/1.1/rights", RIGHTS), (f"{FLAG} || '?width=300'", "http://purl.org/dc/elements/1.1/rights", RIGHTS), of=FLAGS),
)
GEO = "http://www.w3.org/2003/01/geo/wgs84_pos#"
LAT = "(k % 80) || '.5'"
checked("table_geo", "geo", union(("s", RDF + "type", f"'{GEO}SpatialThing'"), ("s", GEO + "lat", LAT), ("s", GEO + "long", "'33.25'"), ("s", "http://www.georss.org/georss/point", f"{LAT} || ' 33.25'")))


@query(f"""WITH raw AS ({union(("s", P + "name", "'Customer ' || k"), ("s", P + "segment", f"'{EN}' || seg"), ("s", P + "serial", "k * 7"), ("s", P + "website", "'http://c' || k || '.example/'"))})
SELECT subject, predicate, value, CASE WHEN predicate IN ('{P}serial', '{P}segment') THEN 'infobox_mapped' ELSE 'infobox_unmapped' END AS dataset FROM raw""")
def table_hybrid(t: Tables) -> DataFrame:
    """Raw statements of infoboxes, tagged by whether a mapping covers their source."""
    pages = post.cut(parsed(customers(t)), "parsed")
    raw = extractors.infobox(pages).where("dataset = 'infobox_properties'")
    names = [f.split()[0] for f in RULE_SCHEMA.split(", ")]
    rules = [("Infobox customer", "serial", "simple", "serial", "integer", True), ("Infobox customer", "segment", "simple", "segment", "object", True)]
    made = [tuple(dict(zip(("template", "key", "kind", "predicate", "range", "functional"), r, strict=True)).get(n) for n in names) for r in rules]
    classes = t.spark.createDataFrame([("Infobox customer", "Customer", "Agent")], "template string, class string, root string")
    mapped = map_templates(pages, classes, t.spark.createDataFrame(made, RULE_SCHEMA))
    return extractors.hybrid(raw, mapped).where(F.col("predicate").isin(*[P + x for x in ("name", "segment", "serial", "website")])).select(*SPV, "dataset")


@query(f"SELECT k AS page_id, 'Customer ' || k || ' lives in the nation.' AS abstract FROM {ALL} WHERE NOT r AND k % 3 <> 0")
def table_missing_abstracts(t: Tables) -> DataFrame:
    """Abstracts of the pages that have none yet; every third has one."""
    own = customers(t).where("redirect is null")
    return nif.missing_abstracts(own, own.where("page_id % 3 = 0").select("page_id")).select("page_id", F.col("short").alias("abstract"))


NATIONS = "(SELECT n_nationkey AS k, n_regionkey AS r, n_name AS name FROM nation)"


def nations(t: Tables) -> DataFrame:
    """A category page for each nation, with a letter beyond ASCII in its title."""
    k = F.col("n_nationkey").cast("string")
    source = F.concat(F.lit("{{Cat main|Nation "), k, F.lit("}}\n[[Category:Region "), F.col("n_regionkey").cast("string"), F.lit("]]\n[[:Category:Länder]]"))
    return t.nation.select(
        F.col("n_nationkey").cast("long").alias("page_id"), F.concat(F.lit("Category:Land Ü"), k).alias("title"), F.lit(14).alias("ns"), F.lit(1).cast("long").alias("revision"), F.lit(None).cast("timestamp").alias("ts"),
        F.lit(0).cast("long").alias("contributor_id"), F.lit("").alias("contributor_name"), F.lit(None).cast("string").alias("redirect"), source.alias("source"), F.lit("text/x-wiki").alias("format"), F.lit("en").alias("lang"),
    )


CAT = f"'{EN}Category:Land_Ü' || k"


@query(union((CAT, OWL + "sameAs", f"'{EN}Category:Land_%C3%9C' || k"), of=NATIONS))
def table_iri_same_as_uri(t: Tables) -> DataFrame:
    return extractors.extract(nations(t), ["iri-same-as-uri"]).select(*SPV)


@query(union((CAT, RDFS + "label", "'Land Ü' || k"), (CAT, RDF + "type", f"'{SKOS}Concept'"), (CAT, SKOS + "prefLabel", "'Land Ü' || k"), (CAT, SKOS + "broader", f"'{EN}Category:Region_' || r"), (CAT, SKOS + "related", f"'{EN}Category:Länder'"), (CAT, SKOS + "subject", f"'{EN}Nation_' || k"), (f"'{EN}Nation_' || k", RDF + "type", f"'{O}TopicalConcept'"), of=NATIONS))
def table_categories(t: Tables) -> DataFrame:
    return extractors.extract(nations(t), ["category-labels", "skos-categories", "topical-concepts"]).select(*SPV)


@query(f"""SELECT '{EN}Map_' || s_suppkey AS subject, '{O}hasKMLData' AS predicate, '<kml>' || s_name || '</kml>' AS value FROM supplier
UNION ALL SELECT '{EN}File:Supplier_' || s_suppkey || '.jpg', '{O}hasAnnotation', '{WIKI}Special:FilePath/Supplier_' || s_suppkey || '.jpg#xywh=pixel:1,2,' || s_nationkey || ',4' FROM supplier
UNION ALL SELECT '{WIKI}Special:FilePath/Supplier_' || s_suppkey || '.jpg#xywh=pixel:1,2,' || s_nationkey || ',4', '{O}asWikiText', 'the gate of ' || s_name FROM supplier""")
def table_media_pages(t: Tables) -> DataFrame:
    """Overlays of maps and notes on images of suppliers."""
    k, text = F.col("s_suppkey").cast("string"), F.lit(None).cast("string")
    page = lambda title, ns, source: t.supplier.select(
        F.col("s_suppkey").alias("page_id"), title.alias("title"), F.lit(ns).alias("ns"), F.lit(1).cast("long").alias("revision"), F.lit(None).cast("timestamp").alias("ts"),
        F.lit(0).cast("long").alias("contributor_id"), F.lit("").alias("contributor_name"), text.alias("redirect"), source.alias("source"), F.lit("text/x-wiki").alias("format"), F.lit("en").alias("lang"),
    )
    overlays = page(F.concat(F.lit("Map "), k, F.lit("/overlay.kml")), 0, F.concat(F.lit('<source lang="xml"><kml>'), "s_name", F.lit("</kml></source>")))
    note = F.concat(F.lit("{{ImageNote|x=1|y=2|w="), F.col("s_nationkey").cast("string"), F.lit("|h=4}}the gate of "), "s_name", F.lit("{{ImageNoteEnd}}"))
    files = page(F.concat(F.lit("File:Supplier "), k, F.lit(".jpg")), 6, note)
    return extractors.extract(overlays, ["kml"]).unionByName(extractors.extract(files, ["image-annotations"])).select(*SPV)


# --- items ------------------------------------------------------------------------------------------------


def part_items(t: Tables) -> DataFrame:
    """An item for each part: labels in two languages, an alias, site links, ranked claims of its size and maker, a reference."""
    k = F.col("p_partkey").cast("string")
    term = lambda lang, v: F.struct(F.lit(lang).alias("language"), v.alias("value"))
    claim = lambda prop, n, rank, kind, value, refs=None: F.struct(
        F.concat(F.lit("Q"), k, F.lit(f"$ABCDE{n}")).alias("id"), F.lit(rank).alias("rank"),
        F.struct(F.lit("value").alias("snaktype"), F.lit(prop).alias("property"), F.struct(F.lit(kind).alias("type"), value.alias("value")).alias("datavalue")).alias("mainsnak"),
        (F.lit(None).cast("string") if refs is None else refs).alias("references"),
    )
    amount = lambda c: F.struct(F.concat(F.lit("+"), c.cast("string")).alias("amount"), F.lit("1").alias("unit"))
    cited = F.array(F.struct(F.lit("h").alias("hash"), F.struct(F.array(F.struct(F.lit("value").alias("snaktype"), F.lit("P854").alias("property"), F.struct(F.lit("string").alias("type"), F.concat(F.lit("http://r.example/"), k).alias("value")).alias("datavalue"))).alias("P854")).alias("snaks")))
    claims = F.struct(
        F.array(claim("P1", 1, "normal", "quantity", amount(F.col("p_size"))), claim("P1", 2, "preferred", "quantity", amount(F.col("p_size") + 100)), claim("P1", 3, "deprecated", "quantity", amount(F.col("p_size") + 200))).alias("P1"),
        F.array(claim("P2", 4, "normal", "string", F.col("p_brand"), cited)).alias("P2"),
    )
    item = F.struct(
        F.concat(F.lit("Q"), k).alias("id"), F.when(F.col("p_partkey") % 5 == 0, "property").otherwise("item").alias("type"),
        F.struct(term("en", F.col("p_name")).alias("en"), term("xx", F.concat(F.lit("x "), "p_name")).alias("xx")).alias("labels"),
        F.struct(term("de", F.col("p_type")).alias("de")).alias("descriptions"), F.struct(F.array(term("en", F.concat(F.lit("part "), k))).alias("en")).alias("aliases"),
        F.struct(F.struct(F.lit("enwiki").alias("site"), F.concat(F.lit("Part "), k).alias("title")).alias("enwiki"), F.struct(F.lit("dewiki").alias("site"), F.concat(F.lit("Teil "), k).alias("title")).alias("dewiki"), F.struct(F.lit("frwiki").alias("site"), F.concat(F.lit("Pièce "), k).alias("title")).alias("frwiki")).alias("sitelinks"),
        claims.alias("claims"),
    )
    return post.spread(t.part, "p_partkey").select(F.col("p_partkey").alias("page_id"), F.concat(F.lit("Q"), k).alias("title"), F.lit(0).alias("ns"), F.lit(1).cast("long").alias("revision"), F.lit(None).cast("string").alias("redirect"), F.to_json(item).alias("source"), F.lit("application/json").alias("format"), F.lit("wikidata").alias("lang"))


PARTS = f"(SELECT *, '{E}Q' || p_partkey AS s FROM part)"
PROPERTY_PARTS = f"(SELECT * FROM {PARTS} WHERE p_partkey % 5 = 0)"


def items_query(name: str, names: list[str], sql: str, only: str | None = None) -> None:
    def f(t: Tables) -> DataFrame:
        out = extractors.extract(part_items(t), names)
        return (out.where(only) if only else out).select(*SPV)

    f.__name__ = name
    query(sql)(f)


LINKS = {"en": "'http://en.example.org/resource/Part_' || p_partkey", "de": "'http://de.example.org/resource/Teil_' || p_partkey", "fr": "'http://fr.example.org/resource/Pièce_' || p_partkey"}
TERMS = [("s", RDFS + "label", "p_name"), ("s", RDFS + "label", "'x ' || p_name"), ("s", DCT + "description", "p_type"), ("s", SKOS + "altLabel", "'part ' || p_partkey")]
items_query("table_item_terms", ["item-labels", "item-descriptions", "item-aliases"], union(*TERMS, of=PARTS))
items_query("table_item_language_links", ["item-language-links"], union(*[(LINKS[a], OWL + "sameAs", LINKS[b]) for a in LINKS for b in LINKS if a != b], of=PARTS))
items_query("table_item_same_as", ["item-same-as"], union(*[("s", OWL + "sameAs", x) for x in LINKS.values()], of=PARTS))
items_query("table_item_namespace", ["item-namespace"], union(("'http://wikidata.example.org/resource/Q' || p_partkey", OWL + "sameAs", "s"), of=PARTS))
CLAIMS = [("s", E + "P1", "p_size"), ("s", E + "P1", "p_size + 100"), ("s", E + "P1", "p_size + 200"), ("s", E + "P2", "p_brand")]
items_query("table_item_claims", ["item-raw"], union(*CLAIMS, of=PARTS), only="dataset = 'item_raw'")
@query("SELECT count(*) AS n, count(*) AS subjects, 'http://r.example/' || p_partkey AS value FROM part GROUP BY p_partkey")
def table_item_references(t: Tables) -> DataFrame:
    """How many statements cite each address."""
    out = extractors.extract(part_items(t), ["item-references"])
    return out.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("subject").alias("subjects"))


@query("""SELECT value, count(*) AS n FROM (SELECT p_size AS value FROM part UNION ALL SELECT p_size + 100 FROM part UNION ALL SELECT p_size + 200 FROM part) GROUP BY value""")
def table_item_reified(t: Tables) -> DataFrame:
    """Each quantity claim once as the object of a statement that has a type, a subject and a predicate too."""
    out = extractors.extract(part_items(t), ["item-raw"]).where("dataset = 'item_raw_reified'")
    wide = out.groupBy("subject").agg(F.count(F.lit(1)).alias("parts"), F.max(F.when(F.col("predicate") == RDF + "object", F.col("value"))).alias("value"), F.max(F.when(F.col("predicate") == RDF + "predicate", F.col("value"))).alias("p"))
    return wide.where(f"parts = 4 and p = '{E}P1'").groupBy(F.col("value").cast("int").alias("value")).agg(F.count(F.lit(1)).alias("n"))


items_query("table_item_properties", ["item-properties"], union(*TERMS, *CLAIMS, of=PROPERTY_PARTS), only="not (subject like '%$%') and predicate not like '%22-rdf-syntax-ns#%'")


@query(f"SELECT s, 'P1' AS prop, CAST(p_size + 100 AS VARCHAR) AS value FROM {PARTS} UNION ALL SELECT s, 'P2', p_brand FROM {PARTS}")
def table_item_preferred(t: Tables) -> DataFrame:
    """Of each item's claims of a property the preferred ones, else the normal ones."""
    return wikidata.preferred(wikidata.claims(part_items(t))).select(F.col("s__").alias("s"), F.col("prop__").alias("prop"), F.col("value__").alias("value"))


# --- rendered text ------------------------------------------------------------------------------------------


def rendered(t: Tables) -> DataFrame:
    """HTML of each customer: a lead, two sections of which the second is below the first, and a link in each paragraph but the lead."""
    k, n = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    lead = F.concat(F.lit("<p>Customer "), k, F.lit(" buys.</p><script>x()</script>"))
    first = F.concat(F.lit("<h2>Segment "), "c_mktsegment", F.lit('</h2><p>It is in <a href="/wiki/N'), n, F.lit('">nation '), n, F.lit("</a>.</p>"))
    second = F.concat(F.lit("<h3>More</h3><p>See <a href=\"/wiki/M\">there</a>.</p><p>End "), k, F.lit(".</p>"))
    return t.customer.select(F.col("c_custkey").alias("page_id"), F.concat(lead, first, second).alias("html"))


TEXTS = "['Customer ' || c_custkey || ' buys.', 'Segment ' || c_mktsegment, 'It is in nation ' || c_nationkey || '.', 'More', 'See there.', 'End ' || c_custkey || '.']"
MODEL = f"""(SELECT page_id, o - 1 AS ord, x[o] AS text, k[o] AS kind, CASE WHEN o >= 4 THEN 3 WHEN o >= 2 THEN 1 END AS section, CAST(coalesce(list_sum(list_transform(x[:o - 1], lambda y: length(y) + 2)), 0) AS INTEGER) AS begin_at
FROM (SELECT c_custkey AS page_id, {TEXTS} AS x, ['paragraph', 'title', 'paragraph', 'title', 'paragraph', 'paragraph'] AS k, unnest(range(1, 7)) AS o FROM customer))"""


@query(f"SELECT page_id, CAST(ord AS INTEGER) AS ord, kind, text, CAST(section AS INTEGER) AS section, begin_at, CAST(begin_at + length(text) AS INTEGER) AS end_at FROM {MODEL}")
def text_model(t: Tables) -> DataFrame:
    return nif.model(rendered(t)).select("page_id", "ord", "kind", "text", "section", F.col("begin").alias("begin_at"), F.col("end").alias("end_at"))


@query(f"SELECT page_id, CAST(ord AS INTEGER) AS ord, lag(CAST(ord AS INTEGER)) OVER w AS previous, lead(CAST(ord AS INTEGER)) OVER w AS following FROM {MODEL} WHERE kind = 'paragraph' WINDOW w AS (PARTITION BY page_id, section ORDER BY ord)")
def text_neighbours(t: Tables) -> DataFrame:
    return nif.neighbours(nif.model(rendered(t))).select("page_id", "ord", "previous", F.col("next").alias("following"))


@query("SELECT c_custkey AS page_id, 1 AS ord, CAST(NULL AS INTEGER) AS parent, 3 AS following FROM customer UNION ALL SELECT c_custkey, 3, 1, NULL FROM customer")
def text_sections(t: Tables) -> DataFrame:
    return nif.sections(nif.model(rendered(t))).select("page_id", "ord", "parent", F.col("next").alias("following"))


@query(f"""SELECT page_id, CAST(begin_at + 9 AS INTEGER) AS begin_at, CAST(begin_at + length(text) - 1 AS INTEGER) AS end_at, text[10:length(text) - 1] AS text, 'phrase' AS kind FROM {MODEL} WHERE ord = 2
UNION ALL SELECT page_id, begin_at + 4, begin_at + 9, 'there', 'word' FROM {MODEL} WHERE ord = 4""")
def text_links(t: Tables) -> DataFrame:
    return nif.links(nif.model(rendered(t))).select("page_id", F.col("begin").alias("begin_at"), F.col("end").alias("end_at"), "text", "kind")


@query(f"SELECT page_id, string_agg(text, chr(10) || chr(10) ORDER BY ord) AS text FROM {MODEL} GROUP BY page_id")
def text_context(t: Tables) -> DataFrame:
    return nif.context(nif.model(rendered(t)))


@query("SELECT c_custkey AS page_id, 'Customer ' || c_custkey || ' buys. It is in nation ' || c_nationkey || '.' AS long, 'Customer ' || c_custkey || ' buys. It is in nation ' || c_nationkey || '.' AS short FROM customer")
def text_abstracts(t: Tables) -> DataFrame:
    return nif.abstracts(nif.model(rendered(t)))


@query(f"SELECT page_id, CAST(ord AS INTEGER) AS ord, text FROM {MODEL} WHERE page_id % 3 = 0")
def text_corpus(t: Tables) -> DataFrame:
    """The pieces of a set of pages."""
    return nif.corpus(nif.model(rendered(t)), t.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("page_id"))).select("page_id", "ord", "text")


@query(f"""SELECT page_id, CAST(begin_at + 9 AS INTEGER) AS begin_at, text[10:length(text) - 1] AS text FROM {MODEL} WHERE ord = 2 UNION ALL SELECT page_id, begin_at + 4, 'there' FROM {MODEL} WHERE ord = 4
UNION ALL SELECT page_id, 0, 'Customer' FROM {MODEL} WHERE ord = 0 UNION ALL SELECT page_id, begin_at, 'Segment' FROM {MODEL} WHERE ord = 1 UNION ALL SELECT page_id, begin_at, 'End ' || page_id FROM {MODEL} WHERE ord = 5""")
def text_enriched(t: Tables) -> DataFrame:
    """Links, and the surface forms of a dictionary where no link is; the longer of two forms."""
    pieces = post.cut(nif.model(rendered(t)), "pieces")
    forms = t.spark.createDataFrame([("Customer", "C"), ("Segment", "S"), ("nation", "N"), ("End", "E")], "form string, href string")
    forms = forms.unionByName(t.customer.select(F.concat(F.lit("End "), F.col("c_custkey").cast("string")).alias("form"), F.lit("X").alias("href")))
    found = nif.enriched(nif.links(pieces), nif.surface_forms(pieces, forms))
    return found.select("page_id", F.col("begin").alias("begin_at"), "text")


@query("SELECT c_custkey AS page_id, 'table' AS kind, 'Segment ' || c_mktsegment AS text, 1 AS number, 6 AS begin_at FROM customer UNION ALL SELECT c_custkey, 'equation', 'x=' || c_nationkey, 1, 6 + length('Segment ' || c_mktsegment) + 2 FROM customer")
def text_structures(t: Tables) -> DataFrame:
    """Tables and equations with their offsets."""
    html = F.concat(F.lit("<p>Lead</p><table><tr><td>Segment </td><td>"), "c_mktsegment", F.lit("</td></tr></table><math>x="), F.col("c_nationkey").cast("string"), F.lit("</math>"))
    pieces = nif.model(t.customer.select(F.col("c_custkey").alias("page_id"), html.alias("html")))
    return nif.structures(pieces).select("page_id", "kind", "text", "number", F.col("begin").alias("begin_at"))


@query(f"SELECT k AS page_id, 'the nation' AS text, 'Nation ' || n AS target FROM {OWN} UNION ALL SELECT k, 'elsewhere', NULL FROM {OWN}")
def surface_forms_on_page(t: Tables) -> DataFrame:
    """Plain texts of a page that it links elsewhere."""
    pages = parsed(customers(t).where("redirect is null"))
    texts = pages.select("page_id", F.explode(F.array(F.lit("the nation"), F.lit("elsewhere"))).alias("text"))
    return extractors.by_surface(texts, pages, "text")
