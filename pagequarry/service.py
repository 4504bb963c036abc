"""Extraction, mappings, ontology and statistics for people and other programs: plain methods, and a small web server over them.

The server is for looking at single pages and at tables that are already made, not for bulk work; every
answer is bounded by `most` rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.operators import extractors, ontology, post, render
from pagequarry.operators.mapping import map_templates
from pagequarry.operators.post import redirect_closure
from pagequarry.operators.wikitext import parsed
from pagequarry.sources import pages as sources


@dataclass
class Service:
    """What the answers are made from: pages; pages of mappings and of the ontology by title; templates that don't count in statistics."""

    spark: SparkSession
    pages: DataFrame
    mapping_pages: dict[str, str] = field(default_factory=dict)
    ontology_pages: dict[str, str] = field(default_factory=dict)
    ignored: set[str] = field(default_factory=set)
    most: int = 10_000

    # --- extraction

    def find(self, title: str | None = None, revision: int | None = None, xml: str | None = None) -> DataFrame:
        """The page of a title, of a revision or of an export document."""
        if xml is not None:
            return sources.from_xml(self.spark.createDataFrame([(xml,)], "xml string"))
        if revision is not None:
            return self.pages.where(F.col("revision") == revision)
        return self.pages.where(F.col("title") == title)

    def extract(self, names: Sequence[str] = ("labels", "page-links", "infobox"), form: str = "turtle-triples", **which: object) -> list[str]:
        """Lines of a page's statements by the extractors named, in a format."""
        lines = render.render(extractors.extract(self.find(**which), list(names)), form)
        return sorted(r["line"] for r in lines.limit(self.most).collect())

    def extractors(self) -> list[dict[str, str]]:
        return [{"name": n.name, "view": n.view, "text": n.text} for _, n in sorted(extractors.NOTES.items())]

    # --- mappings and ontology

    def _frame(self, held: dict[str, str]) -> DataFrame:
        return parsed(self.spark.createDataFrame([(k, t, None, x) for k, (t, x) in enumerate(sorted(held.items()))], "page_id long, title string, redirect string, source string"))

    def ontology(self) -> dict[str, DataFrame]:
        return ontology.ontology(self._frame(self.ontology_pages))

    def rules(self) -> dict[str, DataFrame]:
        read = self.ontology()
        return ontology.mappings(self._frame(self.mapping_pages), read["properties"], ontology.subclass_edges(read["classes"]))

    def put_mapping(self, title: str, source: str) -> list[str]:
        """Takes a mapping page if it is valid; what is wrong with it otherwise."""
        wrong = self.validate(title, source)
        if not wrong:
            self.mapping_pages[title] = source
        return wrong

    def validate(self, title: str, source: str) -> list[str]:
        """Classes and properties that a mapping page names and the ontology lacks, or that it maps nothing."""
        read = self.ontology()
        made = ontology.mappings(self._frame({title: source}), read["properties"])
        classes = made["template_rules"].select(F.col("class").alias("name")).union(made["property_rules"].select("class")).where("name is not null").distinct()
        unknown = classes.join(read["classes"].select(F.col("class").alias("name")), "name", "left_anti").select(F.concat(F.lit("no class "), "name").alias("x"))
        properties = made["property_rules"].where("predicate is not null and kind not in ('geo')").select(F.col("predicate").alias("name")).distinct()
        missing = properties.join(read["properties"].select(F.col("property").alias("name")), "name", "left_anti").select(F.concat(F.lit("no property "), "name").alias("x"))
        out = sorted(r["x"] for r in unknown.union(missing).limit(self.most).collect())
        return out or (["nothing is mapped"] if made["template_rules"].isEmpty() and made["table_rules"].isEmpty() else [])

    def sample(self, title: str, pages: int = 10) -> list[str]:
        """Statements that the mappings make of a few pages that use a mapping page's template."""
        template = title.partition(":")[2].strip()
        rules = self.rules()
        using = self.pages.where(F.contains(F.lower("source"), F.lit("{{" + template.lower()))).orderBy("page_id").limit(pages)
        made = map_templates(parsed(using), rules["template_rules"], rules["property_rules"])
        return sorted(r["line"] for r in render.render(made, "turtle-triples").limit(self.most).collect())

    def redirects(self) -> dict[str, str]:
        """Templates and what they finally redirect to."""
        return {r["src"]: r["dst"] for r in redirect_closure(sources.template_redirects(self.pages)).limit(self.most).collect()}

    def missing_labels(self, language: str) -> list[str]:
        return sorted(r["name"] for r in ontology.missing_labels(self.ontology(), language).limit(self.most).collect())

    def ontology_text(self, form: str = "turtle-triples") -> list[str]:
        made = ontology.ontology_statements(self.ontology())
        if form == "owl":
            return sorted(r["element"] for r in ontology.owl_xml(made).limit(self.most).collect())
        return sorted(r["line"] for r in render.render(made, form).limit(self.most).collect())

    # --- statistics

    def template_statistics(self) -> list[dict[str, object]]:
        """template, n and mapped of the templates that pages use, the most used first, without the ignored ones; redirects count for their targets."""
        used = parsed(self.pages).select(F.explode("nodes").alias("n")).where("n.kind = 'template'").select(F.col("n.name").alias("template"))
        counts = post.usage_counts(used, redirect_closure(sources.template_redirects(self.pages)))
        mapped = self.rules()["template_rules"].select(F.lower("template").alias("key")).withColumn("mapped", F.lit(True))
        out = counts.where(~F.col("template").isin(sorted(self.ignored))) if self.ignored else counts
        out = out.withColumn("key", F.lower("template")).join(mapped, "key", "left").select("template", "n", F.coalesce("mapped", F.lit(False)).alias("mapped"))
        return [r.asDict() for r in out.orderBy(F.col("n").desc(), "template").limit(self.most).collect()]

    def property_statistics(self, template: str) -> list[dict[str, object]]:
        """key, n and mapped of a template's keys."""
        nodes = parsed(self.pages).select(F.explode("nodes").alias("n")).where((F.col("n.kind") == "template") & (F.lower("n.name") == template.lower()))
        keys = nodes.select(F.explode("n.props").alias("p")).select(F.lower("p.key").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        rules = self.rules()["property_rules"].where(F.lower("template") == template.lower()).select(F.lower("key").alias("key")).distinct().withColumn("mapped", F.lit(True))
        return [r.asDict() for r in keys.join(rules, "key", "left").select("key", "n", F.coalesce("mapped", F.lit(False)).alias("mapped")).orderBy(F.col("n").desc(), "key").limit(self.most).collect()]

    def coverage(self) -> dict[str, object]:
        """How much of the templates, and of their uses, is mapped."""
        rows = self.template_statistics()
        usage = self.spark.createDataFrame([(r["template"], r["n"]) for r in rows], "template string, n long")
        mapped = self.spark.createDataFrame([(r["template"],) for r in rows if r["mapped"]], "template string")
        return post.coverage(usage, mapped, "template", "n").first().asDict()

    def ignore(self, template: str, on: bool = True) -> list[str]:
        self.ignored = self.ignored | {template} if on else self.ignored - {template}
        return sorted(self.ignored)


def answer(service: Service, method: str, path: str, body: str = "") -> tuple[int, object]:
    """Status and answer of a request."""
    url = urlparse(path)
    given = {k: v[-1] for k, v in parse_qs(url.query).items()}
    names = given["extractors"].split(",") if "extractors" in given else ("labels", "page-links", "infobox")
    form = given.get("format", "turtle-triples")
    title = given.get("title", "")
    try:
        match method, url.path.rstrip("/"):
            case "GET", "/extraction/extractors":
                return 200, service.extractors()
            case "GET", "/extraction/extract":
                which = {"revision": int(given["revid"])} if "revid" in given else {"title": title}
                return 200, service.extract(names, form, **which)
            case "POST", "/extraction/extract":
                return 200, service.extract(names, form, xml=body)
            case "GET", "/mappings/pages":
                return (200, service.mapping_pages[title]) if title in service.mapping_pages else (200, sorted(service.mapping_pages)) if not title else (404, "no such page")
            case "PUT", "/mappings/pages":
                wrong = service.put_mapping(title, body)
                return (422 if wrong else 200), wrong
            case "DELETE", "/mappings/pages":
                return (200, "gone") if service.mapping_pages.pop(title, None) is not None else (404, "no such page")
            case "POST", "/mappings/validate":
                return 200, service.validate(title, body)
            case "GET", "/mappings/sample":
                return 200, service.sample(title)
            case "GET", "/mappings/redirects":
                return 200, service.redirects()
            case "GET", "/ontology/classes":
                return 200, [r["class"] for r in service.ontology()["classes"].orderBy("class").limit(service.most).collect()]
            case "GET", "/ontology/missing-labels":
                return 200, service.missing_labels(given.get("language", "en"))
            case "GET", "/ontology":
                return 200, service.ontology_text(form)
            case "GET", "/statistics/templates":
                return 200, service.template_statistics()
            case "GET", "/statistics/properties":
                return 200, service.property_statistics(given["template"])
            case "GET", "/statistics/coverage":
                return 200, service.coverage()
            case ("PUT" | "DELETE"), "/statistics/ignored":
                return 200, service.ignore(given["template"], method == "PUT")
    except KeyError as missing:
        return 400, f"missing or unknown: {missing}"
    return 404, "no such address"


def server(service: Service, port: int = 0, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """A web server over a service, to be run with serve_forever; port 0 takes a free one."""

    class Handler(BaseHTTPRequestHandler):
        def respond(self) -> None:
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0)).decode("utf-8")
            status, out = answer(service, self.command, self.path, body)
            data = json.dumps(out, ensure_ascii=False, default=str).encode("utf-8")
            self.send_response(status)
            self.send_header("Content-Type", "application/json; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_POST = do_PUT = do_DELETE = respond  # noqa: N815

        def log_message(self, *_: object) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
