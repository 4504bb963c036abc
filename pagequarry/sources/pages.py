"""Readers of pages, statements and side tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagequarry.model import PAGE_SCHEMA
from pagequarry.operators.render import parse_lines
from pagequarry.operators.wikitext import title_parts

DUMP_SCHEMA = (
    "title string, ns int, id long, redirect struct<_title: string>, "
    "revision array<struct<id: long, timestamp: string, contributor: struct<username: string, id: long, ip: string>, format: string, text: struct<_VALUE: string, `_xml:space`: string>>>"
)


def memory(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Pages given as dictionaries; what is missing is null."""
    names = [f.split()[0] for f in PAGE_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], PAGE_SCHEMA)


def composite(first: DataFrame, *more: DataFrame) -> DataFrame:
    for df in more:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def xml_dump(spark: SparkSession, path: str, lang: str, namespaces: list[int] | None = None) -> DataFrame:
    """An XML dump (plain or compressed): the last revision of each page; rows that aren't well formed are dropped."""
    raw = spark.read.format("xml").option("rowTag", "page").option("mode", "DROPMALFORMED").schema(DUMP_SCHEMA).load(path)
    out = _of_dump(raw, F.lit(lang))
    return out if namespaces is None else out.where(F.col("ns").isin(namespaces))


def _of_dump(raw: DataFrame, lang: Column) -> DataFrame:
    r = F.element_at("revision", -1)
    return raw.select(
        F.col("id").alias("page_id"), "title", "ns", F.coalesce(r["id"], F.lit(-1)).cast("long").alias("revision"), F.try_to_timestamp(r["timestamp"]).alias("ts"),
        F.coalesce(r["contributor"]["id"], F.lit(-1)).cast("long").alias("contributor_id"), F.coalesce(r["contributor"]["username"], r["contributor"]["ip"]).alias("contributor_name"),
        F.col("redirect._title").alias("redirect"), F.coalesce(r["text"]["_VALUE"], F.lit("")).alias("source"), F.coalesce(r["format"], F.lit("text/x-wiki")).alias("format"), lang.alias("lang"),
    )


def from_xml(documents: DataFrame, column: str = "xml") -> DataFrame:
    """Pages of export documents held in a column; the language is the document's xml:lang. Elements that aren't well formed are dropped; see malformed."""
    page = F.regexp_extract_all(column, F.lit(r"(?s)(<page>.*?</page>)"), 1)
    rows = documents.select(F.regexp_extract(column, r"xml:lang=\"([^\"]+)\"", 1).alias("lang__"), F.explode(page).alias("page__"))
    return _of_dump(_parsed_pages(rows), F.col("lang__")).where("page_id is not null")


def _parsed_pages(rows: DataFrame) -> DataFrame:
    return rows.withColumn("x__", F.from_xml("page__", DUMP_SCHEMA, {"mode": "PERMISSIVE"})).select("lang__", "page__", "x__.*")


def malformed(documents: DataFrame, column: str = "xml") -> DataFrame:
    """The page elements of documents that can't be read, and how many pages there are: read and broken."""
    page = F.regexp_extract_all(column, F.lit(r"(?s)(<page>.*?</page>)"), 1)
    rows = _parsed_pages(documents.select(F.lit("").alias("lang__"), F.explode(page).alias("page__")))
    return rows.agg(F.count_if(F.col("id").isNotNull()).alias("read"), F.count_if(F.col("id").isNull()).alias("broken"))


def oai_records(documents: DataFrame, column: str = "xml") -> DataFrame:
    """Pages inside OAI envelopes, with the record's identifier and datestamp; deleted records have no page but deleted = true."""
    record = F.regexp_extract_all(column, F.lit(r"(?s)(<record>.*?</record>)"), 1)
    rows = documents.select(F.regexp_extract(column, r"xml:lang=\"([^\"]+)\"", 1).alias("lang__"), F.explode(record).alias("record__"))
    rows = rows.select(
        "lang__", F.regexp_extract("record__", r"<identifier>([^<]*)</identifier>", 1).alias("identifier"), F.try_to_timestamp(F.regexp_extract("record__", r"<datestamp>([^<]*)</datestamp>", 1)).alias("modified"),
        F.col("record__").rlike(r"<header[^>]*status=\"deleted\"").alias("deleted"), F.nullif(F.regexp_extract("record__", r"(?s)(<page>.*?</page>)", 1), F.lit("")).alias("page__"),
    )
    read = rows.withColumn("x__", F.from_xml("page__", DUMP_SCHEMA, {"mode": "PERMISSIVE"})).select("lang__", "identifier", "modified", "deleted", "x__.*")
    pages = _of_dump(read, F.col("lang__"))
    return read.select("identifier", "modified", "deleted", F.col("id").alias("page_id")).join(pages.where("page_id is not null"), "page_id", "left")


API_SCHEMA = "struct<query: struct<pages: array<struct<pageid: bigint, ns: int, title: string, revisions: array<struct<revid: bigint, timestamp: string, user: string, userid: bigint, content: string, contentformat: string>>, missing: boolean>>, continue: string>>"


def api_pages(responses: DataFrame, lang: str, *, ids: list[int] | None = None, revisions: list[int] | None = None, titles: list[str] | None = None, namespaces: list[int] | None = None, column: str = "json") -> DataFrame:
    """Pages of saved responses of a wiki's web interface (JSON, a response a row), those with the ids, revisions, titles or namespaces asked for; missing ones are left out.

    Fetching is outside an engine: whatever saves the responses (a row for each batch of a query) can feed this.
    """
    p = responses.select(F.explode(F.from_json(column, API_SCHEMA)["query"]["pages"]).alias("p")).select("p.*").where("not coalesce(missing, false)")
    r = F.try_element_at("revisions", F.lit(1))
    out = p.select(
        F.col("pageid").alias("page_id"), "title", "ns", F.coalesce(r["revid"], F.lit(-1)).cast("long").alias("revision"), F.try_to_timestamp(r["timestamp"]).alias("ts"), F.coalesce(r["userid"], F.lit(-1)).cast("long").alias("contributor_id"),
        r["user"].alias("contributor_name"), F.nullif(F.trim(F.regexp_extract(r["content"], REDIRECT, 1)), F.lit("")).alias("redirect"), F.coalesce(r["content"], F.lit("")).alias("source"), F.coalesce(r["contentformat"], F.lit("text/x-wiki")).alias("format"), F.lit(lang).alias("lang"),
    )
    for name, wanted in (("page_id", ids), ("revision", revisions), ("title", titles), ("ns", namespaces)):
        if wanted is not None:
            out = out.where(F.col(name).isin(wanted))
    return out


def split_dump(pages: DataFrame, path: str, chunks: int, codec: str = "bzip2") -> None:
    """Pages as compressed XML, a folder for each range of ids, of about equal size and readable on its own."""
    from pagequarry.functions.scalar import escape_xml

    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), escape_xml(c.cast("string")), F.lit(f"</{name}>"))
    redirect = F.coalesce(F.concat(F.lit('<redirect title="'), escape_xml(F.col("redirect")), F.lit('"/>')), F.lit(""))
    stamp = F.coalesce(tag("timestamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")), F.lit(""))
    who = F.when(F.col("contributor_id") >= 0, F.concat(F.lit("<contributor>"), tag("username", F.coalesce("contributor_name", F.lit(""))), tag("id", F.col("contributor_id")), F.lit("</contributor>"))).otherwise("")
    text = F.concat(F.lit('<text xml:space="preserve">'), escape_xml(F.col("source")), F.lit("</text>"))
    page = F.concat(F.lit("<page>"), tag("title", F.col("title")), tag("ns", F.col("ns")), tag("id", F.col("page_id")), redirect, F.lit("<revision>"), tag("id", F.col("revision")), stamp, who, tag("format", F.col("format")), text, F.lit("</revision></page>"))
    # Each chunk is a document of its own: its first page opens the root, its last one closes it.
    dealt = pages.repartitionByRange(chunks, "page_id").withColumn("chunk", F.spark_partition_id())
    order = Window.partitionBy("chunk").orderBy("page_id")
    first, last = F.lag("page_id").over(order).isNull(), F.lead("page_id").over(order).isNull()
    line = F.concat(F.when(first, "<mediawiki>\n").otherwise(""), page, F.when(last, "\n</mediawiki>").otherwise(""))
    dealt.select("chunk", line.alias("value")).write.mode("overwrite").partitionBy("chunk").option("compression", codec).text(path)


def image_licences(files: DataFrame, not_free: list[str], free: list[str]) -> DataFrame:
    """image and free of file pages (parsed): false with a template that says it isn't free, true with one that says so, null with neither."""
    names = F.transform(F.filter("nodes", lambda n: n["kind"] == "template"), lambda n: F.lower(n["name"]))
    lower = lambda xs: F.array(*[F.lit(x.lower()) for x in xs])
    verdict = F.when(F.arrays_overlap(names, lower(not_free)), F.lit(False)).when(F.arrays_overlap(names, lower(free)), F.lit(True))
    return files.where("ns = 6 and redirect is null").select(F.regexp_replace("title", "^[^:]+:", "").alias("image"), verdict.alias("free"))


def crawled_links(bodies: DataFrame, pattern: str, column: str = "body") -> DataFrame:
    """topic and target of crawled files: JSON with `uri` and `same_as`, or XML whose elements match a pattern with those two groups."""
    read = F.from_json(column, "struct<uri: string, same_as: array<string>>")
    of_json = bodies.where(F.ltrim(column).startswith("{")).select(read.alias("x")).select(F.col("x.uri").alias("topic"), F.explode("x.same_as").alias("target"))
    both = F.arrays_zip(F.regexp_extract_all(column, F.lit(pattern), 1).alias("topic"), F.regexp_extract_all(column, F.lit(pattern), 2).alias("target"))
    of_xml = bodies.where(F.ltrim(column).startswith("<")).select(F.explode(both).alias("x")).select("x.topic", "x.target")
    return of_json.unionByName(of_xml)


def page_files(spark: SparkSession, path: str, lang: str) -> DataFrame:
    """A folder tree with one page a file; the name without its ending is the title."""
    raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    name = F.regexp_replace(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1), r"\.[^.]*$", "")
    return raw.select(F.xxhash64(F.col("_metadata.file_path")).alias("page_id"), F.regexp_replace(F.try_url_decode(name), "_", " ").alias("title"), F.lit(0).alias("ns"), F.col("value").alias("source"), F.lit(lang).alias("lang"))


def statement_files(spark: SparkSession, path: str) -> DataFrame:
    """Lines of statements, compressed or not, with the dataset that their file is named for; ok: false for broken ones."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.[a-z0-9]+)+$", 1)
    rows = spark.read.text(path).select("value", F.regexp_replace(name, r"^[a-z]+wiki-\d+-", "").alias("dataset"))
    return parse_lines(rows, keep=("dataset",))


def grouped(statements: DataFrame) -> DataFrame:
    """All statements of a subject in one row."""
    return statements.groupBy("subject").agg(F.array_sort(F.collect_list(F.struct("predicate", "value", "datatype", "language"))).alias("statements"))


def sql_dump_ids(spark: SparkSession, path: str, prop: str = "disambiguation") -> DataFrame:
    """page_id of the tuples of a property in an SQL dump of page properties."""
    raw = spark.read.text(path).where(F.col("value").contains("INSERT INTO"))
    ids = F.regexp_extract_all("value", F.lit(rf"\((\d+),'{prop}',"), 1).cast("array<bigint>")
    return raw.select(F.explode(ids).alias("page_id")).distinct()


#: Words of redirects by language; every language knows the English one.
REDIRECT_WORDS = {"de": "weiterleitung", "fr": "redirection", "es": "redirección|redireccion", "it": "rinvia|rinvio", "pt": "redirecionamento", "nl": "doorverwijzing", "pl": "patrz|przekieruj|tam", "ru": "перенаправление|перенапр", "sv": "omdirigering", "cs": "přesměruj", "tr": "yönlendirme", "hu": "átirányítás", "fi": "ohjaus|uudelleenohjaus", "el": "ανακατευθυνση", "ja": "転送", "zh": "重定向", "ko": "넘겨주기", "ar": "تحويل", "he": "הפניה", "uk": "перенаправлення"}
REDIRECT = r"(?isu)^\s*#\s*(?:redirect|" + "|".join(REDIRECT_WORDS.values()) + r")\s*:?\s*\[\[([^\]|#]+)"


def redirects(pages: DataFrame) -> DataFrame:
    """src and dst titles of pages that are redirects by markup or by their wikitext."""
    found = F.coalesce(F.col("redirect"), F.nullif(F.trim(F.regexp_extract("source", REDIRECT, 1)), F.lit("")))
    return pages.select(F.col("title").alias("src"), found.alias("dst")).where("dst is not null")


def template_redirects(pages: DataFrame) -> DataFrame:
    """src and dst of redirects from a template to a template, without their namespace; other redirects of templates don't count."""
    target = title_parts(F.col("dst"))
    rows = redirects(pages.where("ns = 10")).withColumn("to", target).where("to.ns = 10 and to.language is null")
    return rows.select(F.regexp_replace("src", "^[^:]+:", "").alias("src"), F.col("to.title").alias("dst"))


def consistent(pages: DataFrame) -> DataFrame:
    """pages with agrees: whether the namespace that the title names is the one that the page says it is in (a prefix that names none is part of the title)."""
    named = title_parts(F.col("title"))["ns"]
    return pages.withColumn("agrees", named == F.col("ns"))


def sitelinks(spark: SparkSession, path: str) -> DataFrame:
    """row, item, site and title of a tab-separated table of site links."""
    return spark.read.csv(path, sep="\t", schema="row long, item string, site string, title string", quote="")


def foreign_keys(spark: SparkSession, path: str) -> DataFrame:
    """Foreign topic and page id of lines such as `<m.0abc> <key> "/wiki/en_id/123"`."""
    line = r"<([^>]+)>\s+<[^>]*key[^>]*>\s+\"/wiki[a-z]*/([a-z]+)_id/(\d+)\""
    x = spark.read.text(path).where(F.col("value").rlike(line))
    return x.select(F.regexp_extract("value", line, 1).alias("topic"), F.regexp_extract("value", line, 2).alias("lang"), F.regexp_extract("value", line, 3).cast("long").alias("page_id"))


def foreign_links(keys: DataFrame, pages: DataFrame, redirected: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """Topics of pages that are neither redirects nor disambiguations."""
    kept = pages.join(redirected.select(F.col("src").alias("title")), "title", "left_anti").join(ambiguous, "page_id", "left_anti")
    return keys.join(kept.select("page_id", "title"), "page_id").select("topic", "title")


def latest_folder(spark: SparkSession, base: str, wiki: str) -> str | None:
    """The newest of the folders <base>/<wiki>/<yyyymmdd>; None if there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{wiki}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(path))
    dates = [n for n in names if len(n) == 8 and n.isdigit()]
    return f"{base}/{wiki}/{dates[-1]}" if dates else None


def find_files(spark: SparkSession, base: str, wiki: str, pattern: str) -> list[str]:
    """Files of a wiki's newest folder whose name, behind `<wiki>-<date>-`, matches a pattern as a whole; in order."""
    newest = latest_folder(spark, base, wiki)
    if newest is None:
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(newest)
    names = [s.getPath().getName() for s in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]
    own = re.compile(rf"(?:{re.escape(wiki)}-\d{{8}}-)?(?:{pattern})")
    return sorted(f"{newest}/{n}" for n in names if own.fullmatch(n))
