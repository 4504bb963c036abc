"""Queries that write files and read them back, and that read pages, responses, ontologies and dictionaries made from tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.model import DCT, OWL, RDF, RDFS, XSD, statement, statements
from pagequarry.operators import dictionary, extractors, mapping, matching, ontology, post, validation
from pagequarry.operators.wikitext import TRANSFORMS, child_addresses, exploded, parsed, relative_lines, title_parts
from pagequarry.plans.catalogue import Tables, query
from pagequarry.plans.table_pages import ALL, EN, OWN, O, customers
from pagequarry.sources import pages as sources
from pagequarry.sources import sinks


def folder(t: Tables) -> str:
    """A new folder beside the checkpoints, which all executors see."""
    one = post.cut(t.spark.range(1), "files").inputFiles()[0]
    return f"{one.rpartition('/')[0]}-{uuid.uuid4().hex}"


def put(t: Tables, lines: DataFrame) -> str:
    """Lines of text as files; where they are."""
    path = folder(t)
    lines.write.text(path)
    return path


# --- pages ------------------------------------------------------------------------------------------------


@query(f"SELECT k AS page_id, 'Customer ' || k AS title, 0 AS ns, k + 1000 AS revision, CASE WHEN n > 0 THEN n ELSE 0 END AS contributor_id, 'Editor ' || n AS contributor_name, CASE WHEN r THEN 'Customer ' || (k - 1) END AS redirect, 'en' AS lang FROM {ALL}")
def io_xml_dump(t: Tables) -> DataFrame:
    """Pages written as compressed XML in several files and read as a dump."""
    path = folder(t)
    sources.split_dump(customers(t), path, 3)
    return sources.xml_dump(t.spark, path, "en").select("page_id", "title", "ns", "revision", F.col("contributor_id").cast("int").alias("contributor_id"), "contributor_name", "redirect", "lang")


@query("SELECT 'part ' || p_partkey AS title, p_name AS source, 'pl' AS lang FROM part WHERE p_partkey % 7 <> 0")
def io_from_xml(t: Tables) -> DataFrame:
    """Documents in a column, each of one page; every seventh isn't well formed."""
    k = F.col("p_partkey").cast("string")
    page = F.concat(F.lit("<page><title>part "), k, F.lit("</title><ns>0</ns><id>"), k, F.lit("</id><revision><id>1</id><text>"), "p_name", F.when(F.col("p_partkey") % 7 == 0, "</oops>").otherwise("</text>"), F.lit("</revision></page>"))
    documents = t.part.select(F.concat(F.lit('<mediawiki xml:lang="pl">'), page, F.lit("</mediawiki>")).alias("xml"))
    return sources.from_xml(documents).select("title", "source", "lang")


@query("SELECT count(*) FILTER (p_partkey % 7 <> 0) AS read, count(*) FILTER (p_partkey % 7 = 0) AS broken FROM part")
def io_malformed(t: Tables) -> DataFrame:
    k = F.col("p_partkey").cast("string")
    page = F.concat(F.lit("<page><title>x</title><id>"), k, F.when(F.col("p_partkey") % 7 == 0, "</oops>").otherwise("</id>"), F.lit("</page>"))
    return sources.malformed(t.part.select(page.alias("xml")))


@query("SELECT 'oai:' || s_suppkey AS identifier, s_suppkey % 4 = 0 AS deleted, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS title FROM supplier")
def io_oai_records(t: Tables) -> DataFrame:
    """Records of an update feed; every fourth says that its page is gone."""
    k, gone = F.col("s_suppkey").cast("string"), F.col("s_suppkey") % 4 == 0
    head = F.concat(F.lit("<record><header"), F.when(gone, ' status="deleted"').otherwise(""), F.lit("><identifier>oai:"), k, F.lit("</identifier><datestamp>2024-01-01T00:00:00Z</datestamp></header>"))
    page = F.when(gone, "").otherwise(F.concat(F.lit("<metadata><page><title>"), "s_name", F.lit("</title><ns>0</ns><id>"), k, F.lit("</id></page></metadata>")))
    return sources.oai_records(t.supplier.select(F.concat(F.lit('<OAI-PMH xml:lang="en">'), head, page, F.lit("</record></OAI-PMH>")).alias("xml"))).select("identifier", "deleted", "title")


@query("SELECT n_nationkey AS page_id, n_name AS title, 'of ' || n_regionkey AS source FROM nation WHERE n_nationkey % 5 <> 0 AND n_name < 'P'")
def io_api_pages(t: Tables) -> DataFrame:
    """Saved responses with a page each, some missing; the titles wanted are those before P."""
    k = F.col("n_nationkey")
    page = F.struct(k.alias("pageid"), F.lit(0).alias("ns"), F.col("n_name").alias("title"), F.array(F.struct(F.lit(1).alias("revid"), F.concat(F.lit("of "), F.col("n_regionkey").cast("string")).alias("content"))).alias("revisions"), (k % 5 == 0).alias("missing"))
    responses = t.nation.select(F.to_json(F.struct(F.struct(F.array(page).alias("pages")).alias("query"))).alias("json"))
    wanted = [r["n_name"] for r in t.nation.where("n_name < 'P'").select("n_name").collect()]
    return sources.api_pages(responses, "en", titles=wanted).select("page_id", "title", "source")


@query("SELECT 'Region ' || r_regionkey AS title, r_name AS source FROM region")
def io_page_files(t: Tables) -> DataFrame:
    """A file for each page."""
    path = folder(t)
    rows = t.region.select(F.concat(F.lit("Region_"), F.col("r_regionkey").cast("string")).alias("name"), F.col("r_name").alias("value"))
    for r in rows.collect():  # five regions
        one = f"{path}/{r['name']}.wiki"
        Path = t.spark._jvm.org.apache.hadoop.fs.Path  # noqa: N806
        out = Path(one).getFileSystem(t.spark._jsc.hadoopConfiguration()).create(Path(one))
        out.writeBytes(r["value"])
        out.close()
    return sources.page_files(t.spark, path, "en").select("title", "source")


@query("SELECT 'Customer ' || c_custkey AS src, 'Customer ' || (c_custkey - 1) AS dst FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT 'Kunde ' || n_nationkey, 'Land ' || n_nationkey FROM nation")
def io_redirect_scan(t: Tables) -> DataFrame:
    """Redirects by markup, and by the wikitext of other languages."""
    k = F.col("n_nationkey").cast("string")
    german = t.nation.select(F.concat(F.lit("Kunde "), k).alias("title"), F.lit(None).cast("string").alias("redirect"), F.concat(F.lit("#WEITERLEITUNG [[Land "), k, F.lit("#x]]")).alias("source"))
    polish = t.nation.select(F.concat(F.lit("Kto "), k).alias("title"), F.lit(None).cast("string").alias("redirect"), F.lit("no redirect").alias("source"))
    return sources.redirects(sources.composite(customers(t), german, polish).select("title", "redirect", "source"))


@query("SELECT s_suppkey AS page_id FROM supplier WHERE s_suppkey % 3 = 0")
def io_sql_dump_ids(t: Tables) -> DataFrame:
    """Ids of a property in an SQL dump; the other tuples have another property."""
    k = F.col("s_suppkey").cast("string")
    tuple_ = F.concat(F.lit("INSERT INTO `page_props` VALUES ("), k, F.when(F.col("s_suppkey") % 3 == 0, ",'disambiguation','');").otherwise(",'other','');"))
    return sources.sql_dump_ids(t.spark, put(t, t.supplier.select(tuple_.alias("value"))))


@query("SELECT CAST(p_partkey AS BIGINT) AS row, 'q' || p_partkey AS item, 'enwiki' AS site, p_name AS title FROM part")
def io_sitelinks(t: Tables) -> DataFrame:
    k = F.col("p_partkey").cast("string")
    return sources.sitelinks(t.spark, put(t, t.part.select(F.concat_ws("\t", k, F.concat(F.lit("q"), k), F.lit("enwiki"), "p_name").alias("value"))))


@query("SELECT 'm.0' || p_partkey AS topic, p_name || ' ' || p_partkey AS title FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 5 <> 0")
def io_foreign_links(t: Tables) -> DataFrame:
    """Topics of a foreign dump joined with pages, without redirects (every third) and disambiguations (every fifth)."""
    k = F.col("p_partkey").cast("string")
    keys = sources.foreign_keys(t.spark, put(t, t.part.select(F.concat(F.lit("<m.0"), k, F.lit('>\t<type.object.key>\t"/wikipedia/en_id/'), k, F.lit('"\t.')).alias("value"))))
    pages = t.part.select(F.col("p_partkey").alias("page_id"), F.concat_ws(" ", "p_name", k).alias("title"))
    redirected = t.part.where("p_partkey % 3 = 0").select(F.concat_ws(" ", "p_name", k).alias("src"))
    return sources.foreign_links(keys, pages, redirected, t.part.where("p_partkey % 5 = 0").select(F.col("p_partkey").alias("page_id")))


@query("SELECT 'http://n/' || n_nationkey AS topic, 'http://r/' || n_regionkey AS target FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier")
def io_crawled_links(t: Tables) -> DataFrame:
    """Bodies of crawled files, in JSON and in XML."""
    url = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    of_json = t.nation.select(F.to_json(F.struct(url("http://n/", "n_nationkey").alias("uri"), F.array(url("http://r/", "n_regionkey")).alias("same_as"))).alias("body"))
    of_xml = t.supplier.select(F.concat(F.lit("<r><id>s"), F.col("s_suppkey").cast("string"), F.lit("</id><see>n"), F.col("s_nationkey").cast("string"), F.lit("</see></r>")).alias("body"))
    return sources.crawled_links(of_json.unionByName(of_xml), "<id>([^<]*)</id><see>([^<]*)</see>")


@query("SELECT 'Pic ' || s_suppkey || '.png' AS image, CASE s_suppkey % 3 WHEN 0 THEN false WHEN 1 THEN true END AS free FROM supplier")
def io_image_licences(t: Tables) -> DataFrame:
    """Licences of images by the templates of their pages."""
    k = F.col("s_suppkey")
    text = F.when(k % 3 == 0, "{{Non-free logo}}{{PD}}").when(k % 3 == 1, "{{PD}}").otherwise("nothing")
    files = t.supplier.select(k.alias("page_id"), F.concat(F.lit("File:Pic "), k.cast("string"), F.lit(".png")).alias("title"), F.lit(6).alias("ns"), F.lit(None).cast("string").alias("redirect"), text.alias("source"))
    return sources.image_licences(parsed(files), ["non-free logo", "fair use"], ["pd", "cc-by"])


# --- statements and files -------------------------------------------------------------------------------------


def segments(t: Tables) -> DataFrame:
    s = F.concat(F.lit("http://e/"), F.col("c_custkey").cast("string"))
    return statements(t.customer, statement("segments", s, "http://e/segment", F.col("c_mktsegment"), datatype=XSD + "string"), statement("nations", s, "http://e/nation", F.concat(F.lit("http://e/n"), F.col("c_nationkey").cast("string"))))


SEGMENTS = f"(SELECT 'segments' AS dataset, 'http://e/' || c_custkey AS subject, 'http://e/segment' AS predicate, c_mktsegment AS value, '{XSD}string' AS datatype FROM customer UNION ALL SELECT 'nations', 'http://e/' || c_custkey, 'http://e/nation', 'http://e/n' || c_nationkey, NULL FROM customer)"


@query(f"SELECT subject, predicate, value, datatype FROM {SEGMENTS}")
def io_statement_files(t: Tables) -> DataFrame:
    """Statements written as compressed lines, a folder for each dataset, and read back."""
    path = folder(t)
    sinks.text(segments(t), path, "turtle-triples", codec="gzip")
    return sources.statement_files(t.spark, f"{path}/*").where("ok").select("subject", "predicate", "value", "datatype")


@query(f"SELECT dataset, count(*) AS n FROM {SEGMENTS} GROUP BY dataset")
def io_dataset_table(t: Tables) -> DataFrame:
    """Statements as a table with a folder for each dataset, through a sink that other steps stand before, with a marker of the run."""
    path = folder(t)
    write = sinks.wrapped(lambda df: sinks.table(df, path), sinks.distinct, lambda df: df.where("subject is not null"))
    sinks.marker(t.spark, f"{path}-running", lambda: write(segments(t).unionByName(segments(t))))
    return post.count_values(t.spark.read.parquet(path), "dataset")


@query("SELECT 'http://e/' || c_custkey AS subject, 2 AS n, c_mktsegment AS segment FROM customer")
def io_sorted_groups(t: Tables) -> DataFrame:
    """All statements of a subject in one row."""
    rows = sources.grouped(segments(t))
    return rows.select("subject", F.size("statements").alias("n"), F.filter("statements", lambda s: s["predicate"] == "http://e/segment")[0]["value"].alias("segment"))


@query("SELECT CAST(count(*) AS BIGINT) AS lines, CAST(sum(length(r_name) + 1) AS BIGINT) AS bytes, 1 AS kinds FROM region")
def io_file_catalogue(t: Tables) -> DataFrame:
    """Two equal files: their lines, bytes and checksum."""
    path, lines = folder(t), t.region.orderBy("r_regionkey").select(F.col("r_name").alias("value")).coalesce(1)
    for k in (1, 2):
        lines.write.text(f"{path}/{k}")
    files = sinks.file_catalogue(t.spark, path).where("path like '%/part-%'")
    return files.groupBy("lines", "bytes").agg(F.count_distinct("checksum").cast("int").alias("kinds"))


@query(f"SELECT '<http://e/' || c_custkey || '> <http://e/segment> \"' || c_mktsegment || '\" .' AS line, 'added' AS op FROM customer")
def io_changes(t: Tables) -> DataFrame:
    """Changes written as compressed lines, a folder for each operation."""
    path = folder(t)
    sinks.changes(segments(t).where("dataset = 'segments'").withColumn("op", F.lit("added")), path)
    return t.spark.read.text(path).select(F.col("value").alias("line"), "op")


@query(f"SELECT k AS page_id, 'Customer_' || k AS page_title, CAST(r AS INTEGER) AS page_is_redirect, k + 1000 AS page_latest FROM {ALL}")
def io_page_tables(t: Tables) -> DataFrame:
    """The page table of a wiki's own database."""
    return sinks.page_tables(customers(t))["page"].select("page_id", F.regexp_replace("page_title", " ", "_").alias("page_title"), "page_is_redirect", "page_latest")


@query("SELECT l_orderkey AS page, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1")
def io_distinct_per_page(t: Tables) -> DataFrame:
    s = statements(t.lineitem, statement("x", F.col("l_orderkey").cast("string"), "p", F.col("l_partkey").cast("string")))
    rows = s.unionByName(s).withColumn("page", F.col("subject").cast("long"))
    return post.count_values(sinks.distinct_per_page(rows, "page"), "page")


# --- parsing --------------------------------------------------------------------------------------------------


@query(f"SELECT k AS page_id, name, kind FROM (SELECT k, 'http://u' || k || '.example/' AS name, 'external' AS kind FROM {OWN} UNION ALL SELECT k, 'Nation ' || n, 'link' FROM {OWN} UNION ALL SELECT k, 'Paris', 'link' FROM {OWN} UNION ALL SELECT k, 'Kept', 'template' FROM {OWN})")
def template_transforms(t: Tables) -> DataFrame:
    """Templates rewritten while they are parsed: addresses, wrapped values, words of a language."""
    k, n = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    text = F.concat(F.lit("{{URL|http://u"), k, F.lit(".example/|site}} {{nowrap|[[Nation "), n, F.lit("]]}} {{lang|fr|[[Paris]]}} {{Kept|x}}"))
    pages = t.customer.where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("page_id"), F.lit("en").alias("lang"), text.alias("source"))
    nodes = parsed(pages, TRANSFORMS).select("page_id", F.explode("nodes").alias("n")).where("n.kind <> 'text'")
    return nodes.select("page_id", "n.name", "n.kind")


@query(f"SELECT k AS page_id, 'Account' AS section, 2 AS relative FROM {OWN} UNION ALL SELECT k, NULL, 4 FROM {OWN} UNION ALL SELECT k, NULL, 12 FROM {OWN}")
def lines_in_sections(t: Tables) -> DataFrame:
    """External links by section, and their lines since its heading."""
    pages = parsed(customers(t).where("redirect is null"))
    return relative_lines(exploded(pages, "external")).select("page_id", "section", "relative")


@query(f"SELECT s || '__Item_' || n || '__1' AS address FROM {OWN} UNION ALL SELECT s || '__Item_' || n || '__2' FROM {OWN} UNION ALL SELECT s || '__Other__1' FROM {OWN}")
def addresses_by_ordinal(t: Tables) -> DataFrame:
    """Nodes of a page by a cleaned name, and which of that name they are."""
    n = F.col("c_nationkey").cast("string")
    text = F.concat(F.lit("{{Item "), n, F.lit("}} {{Other}} {{Item "), n, F.lit("}}"))
    pages = t.customer.where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("page_id"), F.concat(F.lit(f"{EN}Customer_"), F.col("c_custkey").cast("string")).alias("base"), text.alias("source"))
    return child_addresses(exploded(parsed(pages), "template"), F.col("base"), F.col("node.name")).select("address")


@query("""SELECT * FROM (VALUES ('Paris', 'Paris', 0, NULL, NULL), ('kategorie:Orte', 'Orte', 14, NULL, NULL), ('Категория:Города', 'Города', 14, NULL, NULL), ('de:Ulm#Lage', 'Ulm', 0, 'Lage', 'de'), ('Benutzer: jo', 'Jo', 2, NULL, NULL),
('sq:Tirana', 'Tirana', 0, NULL, 'sq'), ('Αρχείο:x.png', 'X.png', 6, NULL, NULL), ('Special:Search', 'Search', -1, NULL, NULL)) v(x, title, ns, fragment, language)""")
def titles_in_languages(t: Tables) -> DataFrame:
    """Titles with namespaces and prefixes of several languages."""
    rows = ["Paris", "kategorie:Orte", "Категория:Города", "de:Ulm#Lage", "Benutzer: jo", "sq:Tirana", "Αρχείο:x.png", "Special:Search"]
    parts = t.spark.createDataFrame([(x,) for x in rows], "x string").select("x", title_parts(F.col("x")).alias("p"))
    return parts.select("x", "p.title", "p.ns", "p.fragment", "p.language")


# --- ontology and mappings ----------------------------------------------------------------------------------------


def ontology_pages(t: Tables) -> DataFrame:
    """A class for each segment and nation (a nation is below its region's class), and three properties."""
    page = lambda df, title, source: df.select(F.xxhash64(title).alias("page_id"), title.alias("title"), F.lit(None).cast("string").alias("redirect"), source.alias("source"))
    nation = F.concat(F.lit("OntologyClass:Nation"), F.col("n_nationkey").cast("string"))
    label = F.concat(F.lit("{{Class|labels={{label|en|"), "n_name", F.lit("}}{{label|de|Land "), F.col("n_nationkey").cast("string"), F.lit("}}|rdfs:subClassOf=Region"), F.col("n_regionkey").cast("string"), F.lit("|owl:disjointWith=Customer}}"))
    region = F.concat(F.lit("OntologyClass:Region"), F.col("r_regionkey").cast("string"))
    rows = page(t.nation, nation, label).unionByName(page(t.region, region, F.concat(F.lit("{{Class|rdfs:label@en="), "r_name", F.lit("}}"))))
    more = [
        ("OntologyClass:Customer", "{{Class|labels={{label|en|customer}}|rdfs:subClassOf=Agent|owl:equivalentClass=schema:Person}}"),
        ("OntologyProperty:serial", "{{DatatypeProperty|labels={{label|en|serial}}|rdfs:domain=Customer|rdfs:range=xsd:integer|rdf:type=owl:FunctionalProperty}}"),
        ("OntologyProperty:segment", "{{ObjectProperty|labels={{label|en|segment}}|rdfs:domain=Customer|rdfs:range=Segment}}"),
        ("OntologyProperty:note", "{{DatatypeProperty|rdfs:range=xsd:string}}"),
    ]
    given = t.spark.createDataFrame(more, "title string, source string")
    return parsed(rows.unionByName(page(given, F.col("title"), F.col("source"))))


@query("SELECT 'Nation' || n_nationkey AS class, 'Region' || n_regionkey AS base FROM nation UNION ALL SELECT 'Region' || r_regionkey, 'owl:Thing' FROM region UNION ALL SELECT 'Customer', 'Agent'")
def ontology_classes(t: Tables) -> DataFrame:
    return ontology.subclass_edges(ontology.ontology(ontology_pages(t))["classes"])


@query("SELECT * FROM (VALUES ('serial', 'datatype', 'Customer', 'xsd:integer', true), ('segment', 'object', 'Customer', 'Segment', false), ('note', 'datatype', NULL, 'xsd:string', false)) v(property, kind, domain, range, functional)")
def ontology_properties(t: Tables) -> DataFrame:
    return ontology.ontology(ontology_pages(t))["properties"]


@query("SELECT 'Region' || r_regionkey AS name FROM region UNION ALL SELECT x FROM (VALUES ('Customer'), ('serial'), ('segment'), ('note')) v(x)")
def ontology_missing_labels(t: Tables) -> DataFrame:
    """What has no German label."""
    return ontology.missing_labels(ontology.ontology(ontology_pages(t)), "de")


NATION_CLASS = f"'{O}Nation' || n_nationkey"


@query(f"""SELECT {NATION_CLASS} AS subject, '{RDF}type' AS predicate, '{OWL}Class' AS value FROM nation UNION ALL SELECT {NATION_CLASS}, '{RDFS}subClassOf', '{O}Region' || n_regionkey FROM nation
UNION ALL SELECT {NATION_CLASS}, '{OWL}disjointWith', '{O}Customer' FROM nation UNION ALL SELECT {NATION_CLASS}, '{RDFS}label', n_name FROM nation UNION ALL SELECT {NATION_CLASS}, '{RDFS}label', 'Land ' || n_nationkey FROM nation""")
def ontology_written(t: Tables) -> DataFrame:
    """Statements of the nations' classes."""
    out = ontology.ontology_statements(ontology.ontology(ontology_pages(t)))
    return out.where(F.col("subject").startswith(O + "Nation")).select("subject", "predicate", "value")


@query(f"""SELECT '<rdf:Description rdf:about="{O}Region' || r_regionkey || '"><p:label xmlns:p="{RDFS}" xml:lang="en">' || r_name || '</p:label><p:subClassOf xmlns:p="{RDFS}" rdf:resource="{OWL}Thing"/><p:type xmlns:p="{RDF}" rdf:resource="{OWL}Class"/></rdf:Description>' AS element FROM region""")
def ontology_owl_xml(t: Tables) -> DataFrame:
    out = ontology.owl_xml(ontology.ontology_statements(ontology.ontology(ontology_pages(t))))
    return out.where(F.col("subject").startswith(O + "Region")).select("element")


MAPPING = """{{TemplateMapping|mapToClass=Customer|mappings=
{{PropertyMapping|templateProperty=serial|ontologyProperty=serial}}
{{PropertyMapping|templateProperty=segment|ontologyProperty=segment}}
{{ConstantMapping|ontologyProperty=source|value=ledger}}
{{IntermediateNodeMapping|nodeClass=Contact|correspondingProperty=contact|mappings=
{{PropertyMapping|templateProperty=website|ontologyProperty=note}}
{{PropertyMapping|templateProperty=name|ontologyProperty=note}}}}}}"""


def mapping_rules(t: Tables) -> dict[str, DataFrame]:
    read = ontology.ontology(ontology_pages(t))
    pages = t.spark.createDataFrame([(1, "Mapping en:Infobox customer", MAPPING)], "page_id long, title string, source string")
    return ontology.mappings(parsed(pages), read["properties"], ontology.subclass_edges(read["classes"]))


@query("""SELECT * FROM (VALUES ('simple', 'serial', 'serial', 'integer', true, NULL), ('simple', 'segment', 'segment', 'object', false, NULL), ('constant', NULL, 'source', NULL, false, 'ledger'),
('node', 'website', 'note', 'string', false, 'contact'), ('node', 'name', 'note', 'string', false, 'contact')) v(kind, key, predicate, range, functional, value)""")
def mapping_pages(t: Tables) -> DataFrame:
    """The rules that a mapping page holds; ranges come from the ontology."""
    return mapping_rules(t)["property_rules"].select("kind", "key", "predicate", "range", "functional", "value")


CONTACT = "s || '__contact__1'"


@query(f"""SELECT s AS subject, '{RDF}type' AS predicate, '{O}Customer' AS value FROM {OWN} UNION ALL SELECT s, '{O}serial', CAST(k * 7 AS VARCHAR) FROM {OWN} UNION ALL SELECT s, '{O}segment', '{EN}' || seg FROM {OWN}
UNION ALL SELECT s, '{O}source', 'ledger' FROM {OWN} UNION ALL SELECT s, '{O}contactNode', {CONTACT} FROM {OWN} UNION ALL SELECT {CONTACT}, '{RDF}type', '{O}Contact' FROM {OWN}
UNION ALL SELECT {CONTACT}, '{O}note', 'Customer ' || k FROM {OWN} UNION ALL SELECT {CONTACT}, '{O}note', 'http://c' || k || '.example/' FROM {OWN}""")
def mapping_pages_applied(t: Tables) -> DataFrame:
    """The customers' infoboxes under the rules of a mapping page, with one node of two keys."""
    rules = mapping_rules(t)
    out = mapping.map_templates(parsed(customers(t)), rules["template_rules"], rules["property_rules"])
    return out.select("subject", "predicate", "value").distinct()


@query("""SELECT * FROM (VALUES ('Infobox_customer', 'simple', 'serial', 'serial', NULL), ('Infobox_customer', 'simple', 'segment', 'segment', NULL), ('Infobox_customer', 'constant', 'source', NULL, 'ledger')) v(template, kind, predicate, key, value)""")
def mapping_documents(t: Tables) -> DataFrame:
    """Rules written as the statements of a mapping document and read back."""
    rules = mapping_rules(t)
    document = ontology.rml(rules["template_rules"], rules["property_rules"].where("kind in ('simple', 'constant')"))
    return ontology.rules_of_rml(document)


# --- validation -------------------------------------------------------------------------------------------------------


@query("SELECT 'segment' AS test, count(*) AS covered, count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY')) AS valid FROM customer UNION ALL SELECT 'nation', count(*), count(*) FILTER (c_nationkey < 10) FROM customer")
def validation_generated(t: Tables) -> DataFrame:
    """Rules that a model of tests defines, applied."""
    T = validation.TEST  # noqa: N806
    model = [
        ("segment", "trigger", "typed"), ("segment", "covers", XSD + "string"), ("segment", "validator", "vocab"), ("segment", "valid", "BUILDING"), ("segment", "valid", "MACHINERY"),
        ("nation", "trigger", "iri"), ("nation", "covers", "^http://e/n"), ("nation", "validator", "pattern"), ("nation", "valid", "^http://e/n[0-9]$"), ("nation", "place", "object"),
    ]
    definitions = t.spark.createDataFrame([(T + s, T + p, v) for s, p, v in model], "subject string, predicate string, value string")
    return validation.scores(segments(t), validation.rules_of(definitions))


@query("""WITH s AS (SELECT 'integer' AS test, count(*) AS covered, count(*) FILTER (o_orderkey % 10 <> 0) AS valid FROM orders UNION ALL SELECT 'date', count(*), count(*) FROM orders)
SELECT test, covered, valid, covered - valid AS failed, round(valid / covered, 6) AS share FROM s""")
def validation_report(t: Tables) -> DataFrame:
    """How much of the literals looks as its type says."""
    k = F.col("o_orderkey").cast("string")
    number = F.when(F.col("o_orderkey") % 10 == 0, F.concat(k, F.lit(" pieces"))).otherwise(k)
    made = statements(t.orders, statement("x", k, "p", number, datatype=XSD + "integer"), statement("x", k, "p", F.date_format("o_orderdate", "yyyy-MM-dd"), datatype=XSD + "date"))
    return validation.report(validation.scores(made, validation.lexical_rules(XSD)))


@query("SELECT 1 AS ord, '<tr><td>any</td><td>' || count(*) || '</td><td>' || count(*) || '</td><td>0</td><td>1.0</td></tr>' AS line FROM customer")
def validation_html(t: Tables) -> DataFrame:
    made = validation.scores(segments(t).where("dataset = 'segments'"), [validation.Rule("any", "literal", None, "is_literal", None, ("object",))])
    return validation.report_html(made).where("ord between 1 and 1000")


# --- dictionary -------------------------------------------------------------------------------------------------------

WORD_BASE = "http://words.example.org/"


def entries(t: Tables) -> DataFrame:
    """A dictionary page for each nation: a section with its class, meanings that are numbered, and translations."""
    k = F.col("n_nationkey").cast("string")
    text = F.concat(
        F.lit("=== Noun ===\n'''"), F.lower("n_name"), F.lit("''' of class "), k, F.lit("\n# the [[land]] of "), k, F.lit("\n# its people ("), F.col("n_regionkey").cast("string"), F.lit(")\n==== Translations ====\n* German: Land"), k,
        F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("\n* Polish: kraj"), k)).otherwise(""), F.lit("\n"),
    )
    return t.nation.select(F.col("n_nationkey").cast("long").alias("page_id"), F.lower("n_name").alias("title"), F.lit("en").alias("lang"), text.alias("source"))


#: By block: a noun with its meanings, and translations.
PATTERNS = {"noun": "'''$word''' of class $class\nmeanings(# $meaning\n)*", "translations": "= Translations ====\npairs(* $language: $target\n)+"}


@query("SELECT n_nationkey AS page_id, 'noun' AS pattern, 'the [[land]] of ' || n_nationkey AS meaning, NULL AS target FROM nation UNION ALL SELECT n_nationkey, 'noun', 'its people (' || n_regionkey || ')', NULL FROM nation UNION ALL SELECT n_nationkey, 'translations', NULL, 'Land' || n_nationkey FROM nation UNION ALL SELECT n_nationkey, 'translations', NULL, 'kraj' || n_nationkey FROM nation WHERE n_nationkey % 2 = 0")
def dictionary_bindings(t: Tables) -> DataFrame:
    """Rows of variables that patterns bind in the blocks of pages."""
    rows = dictionary.bound(dictionary.blocks(entries(t)), PATTERNS)
    return rows.select("page_id", "pattern", F.try_element_at("vars", F.lit("meaning")).alias("meaning"), F.try_element_at("vars", F.lit("target")).alias("target"))


def dictionary_results(t: Tables) -> DataFrame:
    templates = [
        ("noun", WORD_BASE + "uri($word)", WORD_BASE + "meaning", "clean($meaning)"), ("noun", WORD_BASE + "uri($word)", WORD_BASE + "class", "assertNumeric($class)"), ("noun", WORD_BASE + "uri($word)", WORD_BASE + "form", "lastword($word)"),
        ("translations", WORD_BASE + "uri($title)", WORD_BASE + "map($language)", "$target"), ("translations", WORD_BASE + "uri($title)", WORD_BASE + "in", "assertMapped($language)"),
    ]
    return dictionary.results(dictionary.bound(dictionary.blocks(entries(t)), PATTERNS), templates, {"German": "de"}, WORD_BASE)


WORD = f"'{WORD_BASE}' || replace(lower(n_name), ' ', '_')"


@query(f"""SELECT {WORD} AS subject, '{WORD_BASE}meaning' AS predicate, 'the land of ' || n_nationkey AS value FROM nation UNION ALL SELECT {WORD}, '{WORD_BASE}meaning', 'its people (' || n_regionkey || ')' FROM nation
UNION ALL SELECT {WORD}, '{WORD_BASE}class', CAST(n_nationkey AS VARCHAR) FROM nation UNION ALL SELECT {WORD}, '{WORD_BASE}form', list_last(string_split(lower(n_name), ' ')) FROM nation
UNION ALL SELECT {WORD}, '{WORD_BASE}de', 'Land' || n_nationkey FROM nation UNION ALL SELECT {WORD}, '{WORD_BASE}in', 'de' FROM nation UNION ALL SELECT {WORD}, '{WORD_BASE}Polish', 'kraj' || n_nationkey FROM nation WHERE n_nationkey % 2 = 0""")
def dictionary_statements(t: Tables) -> DataFrame:
    """Statements of result templates, with their functions, assertions and vocabulary."""
    return dictionary_results(t).select("subject", "predicate", "value")


LEMON = "http://www.w3.org/ns/lemon/ontolex#"


@query(f"""SELECT {WORD} AS subject, '{RDF}type' AS predicate, '{LEMON}LexicalEntry' AS value FROM nation UNION ALL SELECT {WORD}, '{LEMON}sense', CAST(n_nationkey AS VARCHAR) FROM nation
UNION ALL SELECT {WORD}, '{LEMON}canonicalForm', {WORD} || '__form' FROM nation UNION ALL SELECT {WORD} || '__form', '{LEMON}writtenRep', list_last(string_split(lower(n_name), ' ')) FROM nation""")
def dictionary_lemon(t: Tables) -> DataFrame:
    return dictionary.lemon(dictionary_results(t), WORD_BASE + "class", WORD_BASE + "form").select("subject", "predicate", "value")


@query("""WITH n AS (SELECT DISTINCT p_name AS text FROM part) SELECT text, 'id of ' || text AS id FROM n""")
def entity_ids(t: Tables) -> DataFrame:
    """Texts that are known word for word keep their ids."""
    names = t.part.select(F.col("p_name").alias("text")).distinct()
    return matching.assign_ids(names, names.withColumn("id", F.concat(F.lit("id of "), "text")), 0.9).distinct()


@query(f"SELECT '{O}agent/labels' AS subject, '{RDF}type' AS predicate, 'http://www.w3.org/ns/prov#SoftwareAgent' AS value UNION ALL SELECT '{O}agent/labels', '{RDFS}label', 'labels' UNION ALL SELECT '{O}agent/labels', '{DCT}description', 'labels'")
def extractor_agents(t: Tables) -> DataFrame:
    return extractors.agents(t.spark, ["labels"]).select("subject", "predicate", "value")

