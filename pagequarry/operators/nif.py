"""Rendered HTML as a text model: sections, paragraphs, links with offsets, tables, equations, abstracts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from pagequarry.functions.scalar import broken_brackets, short_text
from pagequarry.operators.post import PYTHON_ROWS, cut, small, spread

LINK = StructType([StructField("begin", IntegerType()), StructField("end", IntegerType()), StructField("text", StringType()), StructField("href", StringType())])
PIECE = StructType(
    [StructField(n, t) for n, t in (("ord", IntegerType()), ("kind", StringType()), ("depth", IntegerType()), ("text", StringType()), ("links", ArrayType(LINK)), ("section", IntegerType()), ("begin", IntegerType()))]
)
SKIP = {"script", "style", "sup", "noscript"}
BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "table", "math"}


class Walker(HTMLParser):
    """Titles, paragraphs, list items, tables and equations in document order; links inside them by offset."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[dict] = []
        self.block: dict | None = None
        self.skip = 0
        self.link: tuple[int, str] | None = None
        self.raw = 0

    def finish(self) -> None:
        b, self.block, self.link = self.block, None, None
        if b is not None and b["text"].strip():
            lead = len(b["text"]) - len(b["text"].lstrip())
            b["text"] = b["text"].strip()
            links = [x | {"begin": max(0, x["begin"] - lead), "end": min(len(b["text"]), x["end"] - lead)} for x in b["links"]]
            self.out.append(b | {"ord": len(self.out), "links": [x for x in links if x["begin"] < x["end"]]})

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SKIP:
            self.skip += 1
        elif tag in BLOCKS and not self.raw:
            self.finish()
            kind = "title" if tag[0] == "h" else {"p": "paragraph", "li": "item", "table": "table", "math": "equation"}[tag]
            self.block = {"kind": kind, "depth": int(tag[1]) if tag[0] == "h" else None, "text": "", "links": []}
            self.raw += tag in ("table", "math")
        elif tag == "a" and self.block is not None:
            self.link = (len(self.block["text"]), dict(attrs).get("href") or "")
        elif tag == "br" and self.block is not None:
            self.block["text"] += "\n"

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag == "a" and self.link and self.block is not None:
            begin, href = self.link
            text = self.block["text"][begin:]
            if text.strip():
                self.block["links"].append({"begin": begin, "end": len(self.block["text"]), "text": text, "href": href})
            self.link = None
        elif tag in BLOCKS:
            self.raw = max(0, self.raw - (tag in ("table", "math")))
            if not self.raw:
                self.finish()

    def handle_data(self, data: str) -> None:
        if not self.skip and self.block is not None:
            data = re.sub(r"\s+", " ", data)
            self.block["text"] += data.lstrip() if not self.block["text"] or self.block["text"].endswith((" ", "\n")) else data


def pieces_of(html: str | None) -> list[dict]:
    """Pieces with section (ord of the last title) and begin (texts are two letters apart)."""
    w = Walker()
    w.feed(html or "")
    w.close()
    w.finish()
    section, begin = None, 0
    for x in w.out:
        section = x["ord"] if x["kind"] == "title" else section
        x.update(section=section, begin=begin)
        begin += len(x["text"]) + 2
    return w.out


@F.arrow_udf(ArrayType(PIECE))
def html_pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Pieces of each page, a few pages at a time."""
    kind = to_arrow_type(ArrayType(PIECE))
    for html in batches:
        for at in range(0, len(html), PYTHON_ROWS):
            yield pa.array([pieces_of(x) for x in html.slice(at, PYTHON_ROWS).to_pylist()], kind)


def model(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """A row for each piece: key, ord, kind, depth, text, links, section (ord of its title), begin and end in the page's text."""
    rows = spread(pages.select(key, html), key).select(key, F.explode(html_pieces(html)).alias("x")).select(key, "x.*")
    return rows.withColumn("end", F.col("begin") + F.length("text"))


def sections(pieces: DataFrame, key: str = "page_id") -> DataFrame:
    """Titles with the next and previous one and the one above: the last before it of less depth."""
    w = Window.partitionBy(key).orderBy("ord")
    titles = pieces.where("kind = 'title'").withColumn("previous", F.lag("ord").over(w)).withColumn("next", F.lead("ord").over(w))
    above = None
    for d in range(1, 6):
        last = F.last(F.when(F.col("depth") <= d, F.col("ord")), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        above = F.when(F.col("depth") == d + 1, last) if above is None else above.when(F.col("depth") == d + 1, last)
    return titles.withColumn("parent", above)


def neighbours(pieces: DataFrame, key: str = "page_id") -> DataFrame:
    """Paragraphs with the previous and next one of their section."""
    w = Window.partitionBy(key, "section").orderBy("ord")
    return pieces.where("kind = 'paragraph'").withColumn("previous", F.lag("ord").over(w)).withColumn("next", F.lead("ord").over(w))


def structures(pieces: DataFrame, key: str = "page_id") -> DataFrame:
    """Tables and equations with their text, offsets, section and which of their kind on the page they are (from 1)."""
    rows = pieces.where("kind in ('table', 'equation')")
    nth = F.row_number().over(Window.partitionBy(key, "kind").orderBy("ord"))
    return rows.select(key, "ord", "kind", "text", "section", "begin", "end", nth.alias("number"))


def links(pieces: DataFrame, key: str = "page_id") -> DataFrame:
    """Links with offsets in the page's text; word or phrase."""
    rows = pieces.select(key, "ord", "begin", F.explode("links").alias("l"))
    kind = F.when(F.trim("l.text").rlike(r"\s"), "phrase").otherwise("word")
    return rows.select(key, "ord", (F.col("begin") + F.col("l.begin")).alias("begin"), (F.col("begin") + F.col("l.end")).alias("end"), F.col("l.text").alias("text"), F.col("l.href").alias("href"), kind.alias("kind"))


def context(pieces: DataFrame, key: str = "page_id") -> DataFrame:
    """The page's whole text."""
    return pieces.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("x")).select(key, F.array_join("x.text", "\n\n").alias("text"))


def abstracts(pieces: DataFrame, key: str = "page_id", limit: int = 500) -> DataFrame:
    """long: paragraphs before the second title; short: paragraphs until the limit is reached, cut at four times of it."""
    w = Window.partitionBy(key).orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    titles = F.sum((F.col("kind") == "title").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lead = pieces.withColumn("titles", titles).where("titles <= 1 and kind = 'paragraph'").withColumn("so_far", F.coalesce(F.sum(F.length("text")).over(w), F.lit(0)))
    part = lambda keep: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("ord", "text")))), lambda x: x["text"]), " ")
    out = lead.groupBy(key).agg(part(F.lit(True)).alias("long"), part(F.col("so_far") < limit).alias("short"))
    return out.select(key, broken_brackets(F.col("long")).alias("long"), F.substring(broken_brackets(F.col("short")), 1, 4 * limit).alias("short"))


def plain_abstract(wikitext: Column) -> Column:
    """The text before the first section, without templates, tables, references, links' targets and emphasis; first letter upper case."""
    x = F.regexp_replace(wikitext, r"(?s)\n==.*$", "")
    for p, to in ((r"(?s)<!--.*?-->|<ref[^>]*/>|<ref[^>]*>.*?</ref>", ""), (r"\{\{[^{}]*\}\}", ""), (r"\{\{[^{}]*\}\}", ""), (r"(?s)\{\|.*?\|\}", ""), (r"(?i)\[\[(?:file|image|category|datei|kategorie|fichier|cat[ée]gor[iy]e?a?):[^\]]*\]\]", ""), (r"\[\[[^\]|]*\|([^\]]*)\]\]", "$1"), (r"\[\[([^\]]*)\]\]", "$1"), (r"\[https?://\S+\s([^\]]*)\]", "$1"), (r"'{2,5}", ""), (r"<[^>]*>", ""), (r"\s+", " ")):
        x = F.regexp_replace(x, p, to)
    x = broken_brackets(F.trim(x))
    return F.concat(F.upper(F.substring(x, 1, 1)), x.substr(F.lit(2), F.length(x)))


def short_abstracts(pages: DataFrame, limit: int = 500) -> DataFrame:
    return pages.select("page_id", plain_abstract(F.col("source")).alias("long")).withColumn("short", short_text(F.col("long"), limit))


def missing_abstracts(pages: DataFrame, known: DataFrame) -> DataFrame:
    """Abstracts of pages that have none among the known ones (page_id)."""
    return short_abstracts(pages.join(known, "page_id", "left_anti"))


def surface_forms(pieces: DataFrame, forms: DataFrame, key: str = "page_id", longest: int = 6) -> DataFrame:
    """Candidate links: where a form (form, href; at most `longest` words) stands in a piece, whole words only.

    Every run of words of a piece is looked up by an equal join, so the dictionary may be of any size.
    """
    words = F.filter(F.transform(F.split("text", r"(?<=\W)(?=\w)"), lambda w: F.regexp_replace(w, r"\W+$", "")), lambda w: w != "")
    start = F.struct(F.array().cast("array<int>").alias("at"), F.lit(1).alias("next"))

    def place(acc: Column, w: Column) -> Column:
        at = F.call_function("locate", w, F.col("text"), acc["next"])
        return F.struct(F.concat(acc["at"], F.array(at)).alias("at"), (at + F.length(w)).alias("next"))

    rows = pieces.select(key, "ord", "begin", "text", words.alias("words"))
    rows = rows.withColumn("at", F.aggregate("words", start, place, lambda acc: acc["at"]))
    runs = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("words") - 1))).withColumn("n", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.size("words") - F.col("i")))))
    first, last = F.get("at", F.col("i")), F.get("at", F.col("i") + F.col("n") - 1) + F.length(F.get("words", F.col("i") + F.col("n") - 1))
    spans = runs.select(key, "ord", "begin", (first - 1).alias("a"), (last - 1).alias("z"), F.col("text").substr(first, last - first).alias("form"))
    found = spans.join(small(forms.select("form", "href").dropDuplicates(["form"])), "form")
    kind = F.when(F.col("form").rlike(r"\s"), "phrase").otherwise("word")
    return found.select(key, "ord", (F.col("begin") + F.col("a")).alias("begin"), (F.col("begin") + F.col("z")).alias("end"), F.col("form").alias("text"), "href", kind.alias("kind"))


def enriched(links: DataFrame, candidates: DataFrame, key: str = "page_id") -> DataFrame:
    """links with those candidate spans that overlap none of them, nor a longer or earlier candidate."""
    def clear(a: DataFrame, b: DataFrame) -> DataFrame:
        other = b.select(F.col(key).alias("k2"), F.col("begin").alias("b2"), F.col("end").alias("e2")).hint("merge")
        return a.join(other, (F.col(key) == F.col("k2")) & (F.col("begin") < F.col("e2")) & (F.col("b2") < F.col("end")), "left_anti")

    free = cut(clear(candidates, links), "free")
    rival = free.select(F.col(key).alias("k2"), F.col("begin").alias("b2"), F.col("end").alias("e2")).hint("merge")
    longer = (F.col("e2") - F.col("b2") > F.col("end") - F.col("begin")) | ((F.col("e2") - F.col("b2") == F.col("end") - F.col("begin")) & (F.col("b2") < F.col("begin")))
    best = free.join(rival, (F.col(key) == F.col("k2")) & (F.col("begin") < F.col("e2")) & (F.col("b2") < F.col("end")) & longer, "left_anti")
    return links.unionByName(best, allowMissingColumns=True)


def corpus(pieces: DataFrame, resources: DataFrame, key: str = "page_id") -> DataFrame:
    """The pieces of the pages wanted."""
    return pieces.join(resources, key, "left_semi")
