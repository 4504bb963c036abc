"""Rules from templates and tables to an ontology.

Rules are tables. template_rules: template, class, subclass_of_root. property_rules: template, key,
kind, predicate and what the kind needs. Templates are resolved through redirects before they meet
their rules; nested templates are mapped only where none above them gave anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.functions import values as V
from pagequarry.functions.scalar import trim_split, wiki_encode
from pagequarry.model import LANG_STRING, RDF, XSD, statement, statements
from pagequarry.operators.extractors import ONTOLOGY, exploded, in_namespaces, resource, source_iri, subject
from pagequarry.operators.post import cut, small
from pagequarry.operators.wikitext import table_grid

RULE_SCHEMA = "template string, key string, kind string, predicate string, range string, language string, prefix string, suffix string, factor double, functional boolean, pick string, value string, key2 string, class string"


def resolved(rows: DataFrame, redirects: DataFrame | None) -> DataFrame:
    """rows with template: the node's name, or what it redirects to (src, dst, closed)."""
    rows = rows.withColumn("template", F.lower("node.name"))
    if redirects is None:
        return rows
    r = redirects.select(F.lower("src").alias("template"), F.lower("dst").alias("to__")).dropDuplicates(["template"])
    return rows.join(small(r), "template", "left").withColumn("template", F.coalesce("to__", "template")).drop("to__")


def mapped_templates(pages: DataFrame, template_rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Templates with a rule, no mapped one above them, numbered on their page; the first describes the page itself.

    A later one describes the page too if its class is the same as, above or below the first one's
    (`closure` of classes is in the rules' column root) and its template is not the first's; else it
    describes an instance of its own.
    """
    rows = resolved(exploded(in_namespaces(pages, 0), "template"), redirects)
    rules = template_rules.select(F.lower("template").alias("template"), F.col("class").alias("class__"), F.col("root").alias("root__"))
    hit = rows.join(small(rules), "template").withColumn("up__", _ancestors()).drop("nodes")
    mapped = F.collect_set("node.id").over(Window.partitionBy("page_id"))
    top = hit.withColumn("mapped__", mapped).where(~F.arrays_overlap("up__", "mapped__")).drop("up__", "mapped__")
    w = Window.partitionBy("page_id").orderBy("node.id")
    top = top.withColumn("no__", F.row_number().over(w))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first(F.struct("class__", "root__", "template")).over(whole)
    own = (F.col("no__") == 1) | ((F.col("root__") == first["root__"]) & (F.col("template") != first["template"]))
    suffix = F.concat(F.lit("__"), F.regexp_replace("template", r"[^\p{L}\p{N}]+", "_"), F.lit("__"), (F.col("no__") - 1).cast("string"))
    return top.withColumn("own__", own).withColumn("s__", F.when(own, subject()).otherwise(F.concat(subject(), suffix)))


def _ancestors() -> Column:
    """Ids of the nodes above the row's node."""
    start = F.struct(F.col("node.parent").alias("at"), F.array().cast("array<int>").alias("path"))

    def step(acc: Column, n: Column) -> Column:
        hit = n["id"] == acc["at"]
        return F.struct(F.when(hit, n["parent"]).otherwise(acc["at"]).alias("at"), F.when(hit, F.concat(acc["path"], F.array(n["id"]))).otherwise(acc["path"]).alias("path"))

    return F.aggregate(F.reverse("nodes"), start, step, lambda acc: acc["path"])


def typed(value: Column) -> Column:
    """value and datatype by the range that the rule names: double, integer, boolean, date, duration, unit, object, link, string."""
    make = lambda v, d: F.struct(v.cast("string").alias("value"), (F.lit(d) if isinstance(d, str) else d).cast("string").alias("datatype"))
    plain = F.regexp_replace(F.regexp_replace(value, r"\[\[[^\]|]*\|([^\]]*)\]\]", "$1"), r"\[\[([^\]]*)\]\]", "$1")
    r = F.col("range")
    # Only what the rule's range asks for is read.
    seen = F.struct(
        r.alias("range"), F.coalesce("factor", F.lit(1.0)).alias("factor"),
        F.when(r.isin("double", "integer"), V.parse_double(value)).alias("number"), F.when(r == "unit", V.value_with_unit(value)).alias("unit"), F.when(r == "date", V.parse_date(value)).alias("date"),
        F.when(r == "boolean", V.parse_boolean(value)).alias("truth"), F.when(r == "duration", V.parse_duration(value)).alias("seconds"),
        F.when(r == "object", resource(F.nullif(F.trim(F.regexp_extract(value, r"\[\[([^\]|#]+)", 1)), F.lit("")))).alias("object"),
        F.when(r == "link", F.nullif(F.regexp_extract(value, r"(https?://[^\s\]|]+)", 1), F.lit(""))).alias("url"),
        F.concat(F.coalesce("prefix", F.lit("")), V.parse_string(plain), F.coalesce("suffix", F.lit(""))).alias("text"),
    )

    def first(t: Column) -> Column:
        return (
            F.when(t["number"].isNotNull() & (t["range"] == "double"), make(t["number"] * t["factor"], XSD + "double"))
            .when(t["number"].isNotNull(), make(F.round(t["number"] * t["factor"]).cast("long"), XSD + "integer"))
            .when(t["truth"].isNotNull(), make(t["truth"], XSD + "boolean"))
            .when(t["date"].isNotNull(), make(V.date_text(t["date"]), t["date"]["type"]))
            .when(t["seconds"].isNotNull(), make(t["seconds"], ONTOLOGY + "second"))
            .when(t["unit"].isNotNull(), make(t["unit"]["value"], t["unit"]["unit"]))
            .when(t["object"].isNotNull(), make(t["object"], F.lit(None)))
            .when(t["url"].isNotNull(), make(t["url"], F.lit(None)))
            .when((F.coalesce(t["range"], F.lit("string")) == "string") & t["text"].isNotNull(), make(t["text"], LANG_STRING))
        )

    return V.let(seen, first)


def _value(key: Column) -> Column:
    """The last value of the node's key; null if it has none."""
    names = F.reverse(F.transform("node.props", lambda p: F.lower(p["key"])))
    at = F.array_position(names, F.lower(key))
    return F.when(at > 0, F.nullif(F.trim(F.get(F.reverse(F.transform("node.props", lambda p: p["value"])), (at - 1).cast("int"))), F.lit("")))


def _line(key: Column) -> Column:
    """The line of the node's last value of a key; the node's own if it has none."""
    found = F.filter("node.props", lambda p: F.lower(p["key"]) == F.lower(key))
    return F.coalesce(F.try_element_at(F.transform(found, lambda p: p["line"]), F.lit(-1)), F.col("node.line"))


def map_templates(pages: DataFrame, template_rules: DataFrame, property_rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Types, correspondences and properties of mapped templates.

    Kinds of property rules: simple, constant, calculate (sum of two keys), combine-date (two keys),
    date-interval, geo, condition (isSet, equals, contains, hasLink, otherwise in `pick`; the first that
    holds gives the class), node (an intermediate node of its own: of each value if one rule of the
    template has the node's `value` as its name or it has none, one node of all their values if several have).
    """
    # Every kind of rule reads the mapped templates, so they are computed once.
    top = cut(mapped_templates(pages, template_rules, redirects), "templates")
    types = statements(
        top.withColumn("c__", F.col("class__")),
        statement("instance_types", F.col("s__"), RDF + "type", F.concat(F.lit(ONTOLOGY), F.col("c__"))),
        statement("instance_correspondences", F.when(~F.col("own__"), subject()), ONTOLOGY + "correspondence", F.col("s__")),
    )
    rules = property_rules.withColumn("template", F.lower("template"))
    shared = F.count(F.lit(1)).over(Window.partitionBy("template", "kind", "value"))
    rules = rules.withColumn("joint", (F.col("kind") == "node") & F.col("value").isNotNull() & (shared > 1))
    rows = top.join(small(rules), "template").withColumn("raw__", _value(F.col("key"))).withColumn("raw2__", _value(F.col("key2")))
    simple = rows.where("kind in ('simple', 'node') and raw__ is not null")
    split = F.when(F.col("functional"), F.array("raw__")).otherwise(trim_split(F.col("raw__"), r"<br\s*/?>|\n\s*\*|;"))
    picked = F.when(F.col("pick") == "first", F.slice(split, 1, 1)).when(F.col("pick") == "last", F.slice(split, -1, 1)).otherwise(split)
    simple = simple.select("*", F.posexplode(picked).alias("at__", "v__")).withColumn("t__", typed(F.col("v__")))
    simple = cut(simple, "typed").where("t__ is not null")
    # Several keys make one node; the values of a single key make one each.
    name = F.coalesce("value", "predicate")
    node = F.concat("s__", F.lit("__"), name, F.lit("__"), F.when(F.col("joint"), F.lit("1")).otherwise((F.col("at__") + 1).cast("string")))
    s = F.when(F.col("kind") == "node", node).otherwise(F.col("s__"))
    iri = F.concat(F.lit(ONTOLOGY), F.col("predicate"))
    note = F.concat(source_iri(_line(F.col("key"))), F.lit("&template="), wiki_encode(F.col("node.name")), F.lit("&property="), F.col("key"))
    lang = F.when(F.col("t__.datatype") == LANG_STRING, F.coalesce("language", F.col("lang")))
    out = statements(
        simple,
        statement("mappings", s, iri, F.col("t__.value"), datatype=F.col("t__.datatype"), language=lang, context=note),
        statement("mappings", F.when(F.col("kind") == "node", F.col("s__")), F.concat(F.lit(ONTOLOGY), name, F.lit("Node")), node),
        statement("instance_types", F.when(F.col("kind") == "node", node), RDF + "type", F.concat(F.lit(ONTOLOGY), F.col("class"))),
    )
    std = simple.where("range = 'unit'").withColumn("n__", F.col("t__.value").cast("double")).withColumn("u__", F.col("t__.datatype"))
    std = V.convert_units(std, "n__", "u__", V.unit_table(pages.sparkSession)).where("standard_value is not null")
    out = out.unionByName(statements(std, statement("mappings_standard", F.col("s__"), iri, F.col("standard_value").cast("string"), datatype=XSD + "double")))
    constant = F.when(F.col("value").rlike("^https?://"), F.lit(None)).otherwise(F.lit(XSD + "string"))
    out = out.unionByName(statements(rows.where("kind = 'constant'"), statement("mappings", F.col("s__"), iri, F.col("value"), datatype=constant)))
    total = V.parse_double(F.col("raw__")) + V.parse_double(F.col("raw2__"))
    out = out.unionByName(statements(rows.where("kind = 'calculate'"), statement("mappings", F.col("s__"), iri, total.cast("string"), datatype=XSD + "double")))
    dates = rows.where("kind = 'combine-date'").withColumn("d__", V.combine_dates(V.parse_date(F.col("raw__")), V.parse_date(F.col("raw2__"))))
    out = out.unionByName(statements(dates, statement("mappings", F.col("s__"), iri, V.date_text(F.col("d__")), datatype=F.col("d__.type"))))
    spans = rows.where("kind = 'date-interval'").withColumn("i__", V.parse_date_interval(F.col("raw__")))
    for end, p in (("start", "StartDate"), ("end", "EndDate")):
        out = out.unionByName(statements(spans, statement("mappings", F.col("s__"), F.concat(iri, F.lit(p)), V.date_text(F.col(f"i__.{end}")), datatype=F.col(f"i__.{end}.type"))))
    geo = rows.where("kind = 'geo'").withColumn("g__", F.coalesce(V.parse_coordinates(F.col("raw__")), _both(F.col("raw__"), F.col("raw2__")))).where("g__ is not null")
    for c in ("lat", "lon"):
        out = out.unionByName(statements(geo, statement("mappings", F.col("s__"), f"http://www.w3.org/2003/01/geo/wgs84_pos#{'long' if c == 'lon' else c}", F.col(f"g__.{c}").cast("string"), datatype=XSD + "float")))
    return types.unionByName(out).unionByName(_conditions(rows))


def _both(lat: Column, lon: Column) -> Column:
    """Latitude and longitude of two values, each a decimal or degrees with a hemisphere."""
    one = lambda x: F.coalesce(x.try_cast("double"), V.parse_single_coordinate(F.regexp_replace(x, r"[°′″'\" ]+", "/")))
    return V.let(F.struct(one(lat).alias("lat"), one(lon).alias("lon")), lambda g: F.when(g["lat"].between(-90, 90) & g["lon"].between(-180, 360), g))


def _conditions(rows: DataFrame) -> DataFrame:
    """The class of the first case (by value order in `factor`) that holds."""
    x, wanted = F.lower(F.trim("raw__")), F.lower(F.trim("value"))
    holds = (
        F.when(F.col("pick") == "isSet", x.isNotNull()).when(F.col("pick") == "equals", x == wanted).when(F.col("pick") == "contains", F.contains(x, wanted))
        .when(F.col("pick") == "hasLink", F.contains(F.lower("raw__"), F.concat(F.lit("[["), wanted))).otherwise(F.col("pick") == "otherwise")
    )
    hit = rows.where("kind = 'condition'").where(F.coalesce(holds, F.lit(False)))
    first = hit.groupBy("s__", "template").agg(F.min_by("class", F.coalesce("factor", F.lit(1e9))).alias("c__"))
    return statements(first, statement("instance_types", F.col("s__"), RDF + "type", F.concat(F.lit(ONTOLOGY), F.col("c__"))))


def map_tables(pages: DataFrame, table_rules: DataFrame, redirects: DataFrame | None = None, template_rules: DataFrame | None = None) -> DataFrame:
    """Rows of tables whose header has a rule's keyword: table_rules (keyword, predicate, class, range).

    Spans are expanded first. A column belongs to the rule whose keyword starts earliest in its header,
    of several to the longest. A table's rows belong to the last mapped template above it, if any.
    """
    rows = exploded(in_namespaces(pages, 0), "table", top=True).withColumn("grid__", table_grid("node.rows")).where(F.size("grid__") > 1)
    header = F.transform(F.col("grid__")[0], lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    cells = rows.select("page_id", "title", "lang", "revision", "ns", "ord", F.col("node.line").alias("line__"), "grid__", F.explode(header).alias("c"))
    rules = small(table_rules.withColumn("keyword", F.lower("keyword")))
    at = F.instr(F.lower("c.h"), F.col("keyword"))
    best = cells.join(rules, F.contains(F.lower("c.h"), F.col("keyword"))).withColumn("at__", at)
    best = best.withColumn("k__", F.row_number().over(Window.partitionBy("page_id", "ord", "c.i").orderBy("at__", -F.length("keyword"), "predicate"))).where("k__ = 1")
    body = best.select("*", F.posexplode(F.slice("grid__", F.lit(2), F.size("grid__"))).alias("r__", "row__")).withColumn("v__", F.get("row__", F.col("c.i"))).where("trim(v__) <> ''")
    none = [F.lit(None).cast("string").alias(n) for n in ("prefix", "suffix")]
    body = body.select("*", *none, F.lit(None).cast("double").alias("factor")).withColumn("t__", typed(F.col("v__"))).where("t__ is not null")
    s = F.concat(subject(), F.lit("__table"), F.col("ord").cast("string"), F.lit("__"), (F.col("r__") + 1).cast("string"))
    body = body.withColumn("s__", s)
    if template_rules is not None:
        marks = mapped_templates(pages, template_rules, redirects).select("page_id", F.col("node.line").alias("at_line"), F.col("s__").alias("above"))
        last = body.select("page_id", "line__").distinct().join(marks, "page_id", "left").where("at_line <= line__").groupBy("page_id", "line__").agg(F.max_by("above", "at_line").alias("above"))
        body = body.join(last, ["page_id", "line__"], "left")
    else:
        body = body.withColumn("above", F.lit(None).cast("string"))
    return statements(
        body,
        statement("instance_types", F.col("s__"), RDF + "type", F.concat(F.lit(ONTOLOGY), F.col("class"))),
        statement("mappings", F.col("s__"), F.concat(F.lit(ONTOLOGY), F.col("predicate")), F.col("t__.value"), datatype=F.col("t__.datatype"), language=F.when(F.col("t__.datatype") == LANG_STRING, F.col("lang"))),
        statement("instance_correspondences", F.col("above"), ONTOLOGY + "correspondence", F.col("s__")),
    ).distinct()
