"""Ontology and mapping pages as tables, and back: classes, properties, rules; OWL, statements, rule documents.

Both kinds of pages are wikitext whose templates nest, so they are parsed once and read from their nodes;
a template's parts are joined to it by the parent that each node knows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.functions.scalar import escape_xml, trim_split
from pagequarry.model import LANG_STRING, OWL, RDF, RDFS, XSD, statement, statements
from pagequarry.operators.extractors import ONTOLOGY, exploded, prop
from pagequarry.operators.mapping import RULE_SCHEMA
from pagequarry.operators.post import class_closure, cut, small

#: The templates of ontology and mapping pages, and the ranges that readers exist for.
CLASS, OBJECT_PROPERTY, DATATYPE_PROPERTY, LABEL = "class", "objectproperty", "datatypeproperty", "label"
RANGES = {"xsd:integer": "integer", "xsd:nonNegativeInteger": "integer", "xsd:positiveInteger": "integer", "xsd:double": "double", "xsd:float": "double", "xsd:date": "date", "xsd:gYear": "date", "xsd:gYearMonth": "date", "xsd:boolean": "boolean", "xsd:anyURI": "link", "xsd:string": "string", "rdf:langString": "string"}


def named(pages: DataFrame) -> DataFrame:
    """Pages with a row for each template; kind: its name in lower case, page__: the title behind the namespace."""
    rows = exploded(pages, "template")
    kind = F.regexp_replace(F.lower("node.name"), r"\s+", "")
    return rows.withColumn("kind", kind).withColumn("page__", F.trim(F.regexp_replace("title", r"^[^:]*:", "")))


def ontology(pages: DataFrame) -> dict[str, DataFrame]:
    """classes (class, base, equivalent, disjoint: arrays), properties (property, kind, domain, range, functional) and labels (name, language, label) of parsed ontology pages."""
    rows = cut(named(pages).drop("nodes"), "ontology")
    listed = lambda *keys: trim_split(F.coalesce(*[prop(k) for k in keys], F.lit("")), ",")
    classes = rows.where(F.col("kind") == CLASS).select(F.col("page__").alias("class"), listed("rdfs:subClassOf").alias("base"), listed("owl:equivalentClass").alias("equivalent"), listed("owl:disjointWith").alias("disjoint"))
    own = rows.where(F.col("kind").isin(OBJECT_PROPERTY, DATATYPE_PROPERTY))
    properties = own.select(
        F.col("page__").alias("property"), F.when(F.col("kind") == OBJECT_PROPERTY, "object").otherwise("datatype").alias("kind"),
        prop("rdfs:domain").alias("domain"), prop("rdfs:range").alias("range"), F.coalesce(F.lower(prop("rdf:type")).contains("functional"), F.lit(False)).alias("functional"),
    )
    labels = rows.where(F.col("kind") == LABEL).select(F.col("page__").alias("name"), prop("1").alias("language"), prop("2").alias("label"))
    # The short form, a key for each language.
    short = rows.where(F.col("kind").isin(CLASS, OBJECT_PROPERTY, DATATYPE_PROPERTY)).select(F.col("page__").alias("name"), F.explode("node.props").alias("p")).where(F.col("p.key").rlike("^rdfs:label@"))
    labels = labels.unionByName(short.select("name", F.regexp_replace("p.key", "^rdfs:label@", "").alias("language"), F.trim("p.value").alias("label")))
    return {"classes": classes, "properties": properties, "labels": labels.where("label is not null").distinct()}


def subclass_edges(classes: DataFrame) -> DataFrame:
    """class and base; a class without a base is below Thing."""
    base = F.when(F.size("base") > 0, F.col("base")).otherwise(F.array(F.lit("owl:Thing")))
    return classes.select("class", F.explode(base).alias("base"))


def missing_labels(read: dict[str, DataFrame], language: str) -> DataFrame:
    """Names of classes and properties that have no label in a language."""
    names = read["classes"].select(F.col("class").alias("name")).union(read["properties"].select(F.col("property").alias("name"))).distinct()
    return names.join(read["labels"].where(F.col("language") == language).select("name"), "name", "left_anti")


def mappings(pages: DataFrame, properties: DataFrame, edges: DataFrame | None = None) -> dict[str, DataFrame]:
    """template_rules, property_rules and table_rules of parsed mapping pages, as `map_templates` and `map_tables` take them.

    properties: as `ontology` gives them, for the range that a value is read by. edges (class, base): the
    root of a class, which tells whether two templates describe one thing, is its topmost ancestor.
    """
    rows = named(pages).drop("nodes").withColumn("id", F.col("node.id")).withColumn("up", F.col("node.parent"))
    rows = cut(rows.withColumn("template", F.col("page__")), "mappings")
    above = rows.select("page_id", F.col("id").alias("up"), F.col("kind").alias("up_kind"), F.col("node").alias("up_node"))
    rows = rows.join(above, ["page_id", "up"], "left")
    upper = lambda key: _of("up_node", key)
    plain = rows.where("kind = 'templatemapping' and (up_kind is null or up_kind <> 'condition')").select("template", prop("mapToClass").alias("class"))
    default = rows.where("kind = 'conditionalmapping'").select("template", F.coalesce(prop("defaultClass"), F.lit("Thing")).alias("class"))
    templates = plain.unionByName(default).dropDuplicates(["template"])
    if edges is not None:
        depth = Window.partitionBy("class").orderBy(F.col("depth").desc(), "ancestor")
        roots = class_closure(edges.where("base <> 'owl:Thing'")).withColumn("k", F.row_number().over(depth)).where("k = 1").select("class", F.col("ancestor").alias("root"))
        templates = templates.join(small(roots), "class", "left").withColumn("root", F.coalesce("root", "class"))
    else:
        templates = templates.withColumn("root", F.col("class"))

    none, no = F.lit(None).cast("string"), F.lit(None).cast("double")
    names = [f.split()[0] for f in RULE_SCHEMA.split(", ")]

    def rule(sort: str, of: DataFrame, **given: Column) -> DataFrame:
        base = {n: no if n == "factor" else F.lit(None).cast("boolean") if n == "functional" else none for n in names}
        base |= {"template": F.col("template"), "kind": F.lit(sort)} | given
        return of.select(*[base[n].alias(n) for n in names], F.col("id").alias("ord"), F.col("page_id"))

    simple = rows.where("kind = 'propertymapping'")
    inner = F.col("up_kind") == "intermediatenodemapping"
    made = rule(
        "simple", simple, key=prop("templateProperty"), predicate=prop("ontologyProperty"), range=F.when(prop("unit").isNotNull(), F.lit("unit")), language=prop("language"), prefix=prop("prefix"), suffix=prop("suffix"),
        factor=prop("factor").try_cast("double"), pick=prop("select"), kind=F.when(inner, "node").otherwise("simple"), value=F.when(inner, upper("correspondingProperty")), **{"class": F.when(inner, upper("nodeClass"))},
    )
    made = made.unionByName(rule("constant", rows.where("kind = 'constantmapping'"), predicate=prop("ontologyProperty"), value=prop("value")))
    made = made.unionByName(rule("calculate", rows.where("kind = 'calculatemapping'"), key=prop("templateProperty1"), key2=prop("templateProperty2"), predicate=prop("ontologyProperty")))
    made = made.unionByName(rule("combine-date", rows.where("kind = 'combinedatemapping'"), key=prop("templateProperty1"), key2=prop("templateProperty2"), predicate=prop("ontologyProperty")))
    made = made.unionByName(rule("date-interval", rows.where("kind = 'dateintervalmapping'"), key=prop("templateProperty"), predicate=F.regexp_replace(prop("startDateOntologyProperty"), "StartDate$", "")))
    made = made.unionByName(rule("geo", rows.where("kind = 'geocoordinatesmapping'"), key=F.coalesce(prop("coordinates"), prop("latitude")), key2=prop("longitude"), predicate=F.lit("coordinates")))
    cases = rows.where("kind = 'condition'").join(rows.where("kind = 'templatemapping'").select("page_id", F.col("up").alias("id"), prop("mapToClass").alias("case_class")), ["page_id", "id"])
    made = made.unionByName(rule("condition", cases, key=F.coalesce(prop("templateProperty"), F.lit("1")), pick=prop("operator"), value=prop("value"), factor=F.col("id").cast("double"), **{"class": F.col("case_class")}))
    # What a property's range says of how its values are read, and whether it takes one value.
    table = F.create_map(*[F.lit(v) for kv in RANGES.items() for v in kv])
    ranges = properties.select(F.col("property").alias("predicate"), F.when(F.col("kind") == "object", "object").otherwise(F.coalesce(F.try_element_at(table, F.col("range")), F.lit("string"))).alias("by_range"), F.col("functional").alias("one")).dropDuplicates(["predicate"])
    made = made.join(small(ranges), "predicate", "left").withColumn("range", F.coalesce("range", "by_range")).withColumn("functional", F.coalesce("one", F.lit(False)))
    tables = rows.where("kind = 'propertymapping' and up_kind = 'tablemapping'").select(F.explode(trim_split(F.concat_ws(";", prop("templateProperty")), ";")).alias("keyword"), prop("ontologyProperty").alias("predicate"), upper("mapToClass").alias("class"))
    tables = tables.join(small(ranges.drop("one")), "predicate", "left").select("keyword", "predicate", "class", F.coalesce("by_range", F.lit("string")).alias("range"))
    in_table = rows.where("up_kind = 'tablemapping'").select("page_id", F.col("id").alias("ord"))
    return {"template_rules": templates.select("template", "class", "root"), "property_rules": made.join(in_table, ["page_id", "ord"], "left_anti").select(*names), "table_rules": tables}


def _of(node: str, name: str) -> Column:
    """A key's value in a node that isn't the row's own."""
    found = F.filter(f"{node}.props", lambda p: F.lower(p["key"]) == name.lower())
    return F.nullif(F.try_element_at(F.transform(found, lambda p: F.trim(p["value"])), F.lit(-1)), F.lit(""))


# --- writers ------------------------------------------------------------------------------------------------


def iri(name: Column) -> Column:
    """The address of a class, a property or a prefixed name."""
    known = {"owl:": OWL, "rdf:": RDF, "rdfs:": RDFS, "xsd:": XSD, "schema:": "http://schema.org/", "foaf:": "http://xmlns.com/foaf/0.1/"}
    out = F.concat(F.lit(ONTOLOGY), name)
    for prefix, base in known.items():
        out = F.when(name.startswith(prefix), F.concat(F.lit(base), F.substring(name, len(prefix) + 1, 1 << 30))).otherwise(out)
    return out


def ontology_statements(read: dict[str, DataFrame]) -> DataFrame:
    """The ontology as statements, to be rendered in any format."""
    classes, properties = read["classes"], read["properties"]
    c, p = iri(F.col("class")), iri(F.col("property"))
    out = statements(classes, statement("ontology", c, RDF + "type", F.lit(OWL + "Class")))
    edges = subclass_edges(classes)
    out = out.unionByName(statements(edges, statement("ontology", iri(F.col("class")), RDFS + "subClassOf", iri(F.col("base")))))
    for column, predicate in (("equivalent", OWL + "equivalentClass"), ("disjoint", OWL + "disjointWith")):
        each = classes.select("class", F.explode(column).alias("x"))
        out = out.unionByName(statements(each, statement("ontology", iri(F.col("class")), predicate, iri(F.col("x")))))
    kind = F.when(F.col("kind") == "object", OWL + "ObjectProperty").otherwise(OWL + "DatatypeProperty")
    out = out.unionByName(statements(
        properties, statement("ontology", p, RDF + "type", kind), statement("ontology", p, RDF + "type", F.when(F.col("functional"), OWL + "FunctionalProperty")),
        statement("ontology", p, RDFS + "domain", iri(F.col("domain"))), statement("ontology", p, RDFS + "range", iri(F.col("range"))),
    ))
    return out.unionByName(statements(read["labels"], statement("ontology", iri(F.col("name")), RDFS + "label", F.col("label"), datatype=LANG_STRING, language=F.col("language"))))


def owl_xml(made: DataFrame) -> DataFrame:
    """subject and the element that describes it, in the XML syntax; predicates are split into namespace and name."""
    space, name = F.regexp_extract("predicate", r"^(.*[/#])([^/#]+)$", 1), F.regexp_extract("predicate", r"^(.*[/#])([^/#]+)$", 2)
    opened = F.concat(F.lit("<p:"), name, F.lit(' xmlns:p="'), escape_xml(space), F.lit('"'))
    resource = F.concat(opened, F.lit(' rdf:resource="'), escape_xml(F.col("value")), F.lit('"/>'))
    literal = F.concat(opened, F.coalesce(F.concat(F.lit(' xml:lang="'), F.col("language"), F.lit('"')), F.lit("")), F.lit(">"), escape_xml(F.col("value")), F.lit("</p:"), name, F.lit(">"))
    each = made.select("subject", F.when(F.col("datatype").isNull(), resource).otherwise(literal).alias("line"))
    inner = F.array_join(F.array_sort(F.collect_list("line")), "")
    out = each.groupBy("subject").agg(inner.alias("inner"))
    return out.select("subject", F.concat(F.lit('<rdf:Description rdf:about="'), escape_xml(F.col("subject")), F.lit('">'), F.col("inner"), F.lit("</rdf:Description>")).alias("element"))


#: Names of the mapping vocabularies.
RR, RML = "http://www.w3.org/ns/r2rml#", "http://semweb.mmlab.be/ns/rml#"


def rml(template_rules: DataFrame, property_rules: DataFrame, language: str = "en") -> DataFrame:
    """Rules as the statements of a mapping document: a map of triples for each template, a predicate-object map for each rule."""
    base = F.concat(F.lit(f"http://mappings.example.org/{language}/"), F.regexp_replace("template", r"\s+", "_"))
    out = statements(
        template_rules, statement("rml", base, RDF + "type", F.lit(RR + "TriplesMap")), statement("rml", base, RR + "subjectMap", F.concat(base, F.lit("/subject"))),
        statement("rml", F.concat(base, F.lit("/subject")), RR + "class", F.concat(F.lit(ONTOLOGY), F.col("class"))),
    )
    own = property_rules.withColumn("at", F.md5(F.concat_ws("|", "kind", "predicate", "key", "key2", "value")))
    node = F.concat(base, F.lit("/"), F.col("kind"), F.lit("/"), F.substring("at", 1, 8))
    value = F.concat(node, F.lit("/object"))
    return out.unionByName(statements(
        own, statement("rml", base, RR + "predicateObjectMap", node), statement("rml", node, RR + "predicate", F.concat(F.lit(ONTOLOGY), F.col("predicate"))), statement("rml", node, RR + "objectMap", value),
        statement("rml", value, RML + "reference", F.col("key"), datatype=XSD + "string"), statement("rml", value, RML + "reference", F.col("key2"), datatype=XSD + "string"), statement("rml", value, RR + "constant", F.when(F.col("kind") == "constant", F.col("value")), datatype=XSD + "string"),
        statement("rml", value, RR + "class", F.concat(F.lit(ONTOLOGY), F.col("class"))),
    ))


def rules_of_rml(document: DataFrame) -> DataFrame:
    """template (with underscores), kind, predicate, key and value of the rules in a mapping document: what `rml` wrote for simple and constant rules."""
    links = lambda p, a, b: document.where(F.col("predicate") == p).select(F.col("subject").alias(a), F.col("value").alias(b))
    maps = links(RR + "predicateObjectMap", "map", "node").join(links(RR + "predicate", "node", "predicate"), "node").join(links(RR + "objectMap", "node", "object"), "node")
    maps = maps.join(links(RML + "reference", "object", "key"), "object", "left").join(links(RR + "constant", "object", "value"), "object", "left")
    last = lambda c: F.regexp_extract(c, r"([^/]+)$", 1)
    return maps.select(last("map").alias("template"), F.regexp_extract("node", r"/([^/]+)/[^/]+$", 1).alias("kind"), last("predicate").alias("predicate"), "key", "value")
