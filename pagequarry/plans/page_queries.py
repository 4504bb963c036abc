"""Queries over pages, texts and literals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions import scalar as S
from pagequarry.functions import similarity as M
from pagequarry.functions import values as V
from pagequarry.operators.post import spread
from pagequarry.plans.catalogue import Tables, query

HREF = r'<a href="([^"]*)"'
HEADING = r"<h([1-6])>(.*?)</h[1-6]>"


def links(t: Tables) -> DataFrame:
    return t.pages.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("ord", "target"))


@query(r"""SELECT page_id, CAST(o - 1 AS INTEGER) AS ord, l[o] AS target FROM (
SELECT page_id, l, unnest(range(1, len(l) + 1)) AS o FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages))""")
def page_links(t: Tables) -> DataFrame:
    return links(t).select("page_id", "ord", "target")


@query(r"""SELECT page_id, CAST(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS INTEGER) AS out_degree FROM pages""")
def out_degree(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.size(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("out_degree"))


@query(r"""SELECT target, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS target FROM pages) GROUP BY target ORDER BY n DESC, target LIMIT 20""")
def in_degree_topk(t: Tables) -> DataFrame:
    return links(t).groupBy("target").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "target").limit(20)


@query(r"""SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS label FROM pages WHERE regexp_matches(html, '<title>')""")
def page_label(t: Tables) -> DataFrame:
    return t.pages.where(F.col("html").contains("<title>")).select("page_id", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("label"))


@query("SELECT doc_id, CAST(length(text) AS INTEGER) AS chars, n_chars = length(text) AS agrees FROM documents")
def document_length(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.length("text").alias("chars"), (F.col("n_chars") == F.length("text")).alias("agrees"))


@query(r"""SELECT page_id, CAST(o AS INTEGER) AS ord, CAST(d[o + 1] AS INTEGER) AS level, h[o + 1] AS heading FROM (SELECT page_id, d, h, unnest(range(0, len(d))) AS o FROM (
SELECT page_id, regexp_extract_all(html, '<h([1-6])>(.*?)</h[1-6]>', 1) AS d, regexp_extract_all(html, '<h([1-6])>(.*?)</h[1-6]>', 2) AS h FROM pages))""")
def headings(t: Tables) -> DataFrame:
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit(HEADING), 1).alias("d"), F.regexp_extract_all("html", F.lit(HEADING), 2).alias("h"))
    return t.pages.select("page_id", F.posexplode(both).alias("ord", "x")).select("page_id", "ord", F.col("x.d").cast("int").alias("level"), F.col("x.h").alias("heading"))


@query(r"""WITH s AS (SELECT doc_id, text, list_filter(regexp_split_to_array(regexp_replace(text, '\.(\s)', '.\1' || chr(1), 'g'), chr(1)), lambda x: true) AS parts FROM documents),
e AS (SELECT doc_id, text, parts, unnest(range(1, len(parts) + 1)) AS k FROM s),
c AS (SELECT doc_id, k, parts[k] AS part, sum(length(parts[k])) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM e),
g AS (SELECT doc_id, trim(string_agg(part, '' ORDER BY k), ' ') AS abstract FROM c WHERE k = 1 OR upto <= 500 GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN length(d.text) < 500 THEN trim(d.text, ' ') ELSE g.abstract END AS abstract FROM documents d JOIN g USING (doc_id)""")
def short_abstract(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", S.short_text(F.col("text")).alias("abstract"))


BRACKETS = ["Bern (; 1191)", "Ulm ( , x) city", "a () b", "plain (text) stays", "x (; a) y (, b) z"]


@query("""SELECT x, trim(regexp_replace(regexp_replace(regexp_replace(x, '\\(\\s*[;,][^()]*\\)', '', 'g'), '\\(\\s*\\)', '', 'g'), ' {2,}', ' ', 'g')) AS y FROM (
VALUES ('Bern (; 1191)'), ('Ulm ( , x) city'), ('a () b'), ('plain (text) stays'), ('x (; a) y (, b) z')) v(x)""")
def broken_brackets(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(x,) for x in BRACKETS], "x string").select("x", S.broken_brackets(F.col("x")).alias("y"))


@query("SELECT page_id, md5(regexp_replace(html, '<[^>]*>', '', 'g')) AS digest FROM pages")
def strip_tags(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.md5(S.strip_tags(F.col("html"))).alias("digest"))


@query("""SELECT page_id, md5(replace(replace(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')) AS digest FROM pages""")
def decode_entities(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.md5(S.decode_entities(F.col("html"))).alias("digest"))


@query("""SELECT p_partkey, replace(trim(regexp_replace(p_name || ' #' || p_brand, '[_ ]+', ' ', 'g')), ' ', '_') AS raw,
replace(replace(replace(trim(regexp_replace(p_name || ' #' || p_brand, '[_ ]+', ' ', 'g')), ' ', '_'), '%', '%25'), '#', '%23') AS encoded FROM part""")
def wiki_encode(t: Tables) -> DataFrame:
    name = F.concat("p_name", F.lit(" #"), "p_brand")
    return t.part.select("p_partkey", F.replace(S.clean_space(name), F.lit(" "), F.lit("_")).alias("raw"), S.wiki_encode(name).alias("encoded"))


@query("""SELECT p_partkey, regexp_replace(lower(w[1]) || array_to_string(list_transform(w[2:], lambda x: upper(x[1]) || x[2:]), ''), '[0-9]+$', '') AS key
FROM (SELECT p_partkey, list_filter(regexp_split_to_array(lower(trim(p_name || '_' || p_size)), '[_\\s/:-]+'), lambda x: x <> '') AS w FROM part)""")
def camel_case_key(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.property_key(F.concat("p_name", F.lit("_"), F.col("p_size").cast("string"))).alias("key"))


@query("""SELECT url, CASE WHEN length(u) <= 500 THEN u END AS kept FROM (SELECT url, CASE WHEN url LIKE 'http://%' THEN 'https://' || url[8:] ELSE url END AS u FROM pages)""")
def uri_policy(t: Tables) -> DataFrame:
    from pagequarry.operators.render import reject_long

    secure = F.when(F.col("url").startswith("http://"), F.concat(F.lit("https://"), F.substring("url", 8, 1 << 30))).otherwise(F.col("url"))
    return t.pages.select("url", reject_long(secure).alias("kept"))


# --- literals -------------------------------------------------------------------------------------


@query("""SELECT x, CAST(s AS DOUBLE) AS seconds FROM (VALUES ('1h 40min', 6000), ('4 hours, 7 minutes', 14820), ('90 s', 90), ('1:02:03', 3723), ('2:30', 150), ('none', NULL)) v(x, s)""")
def duration_seconds(t: Tables) -> DataFrame:
    rows = ["1h 40min", "4 hours, 7 minutes", "90 s", "1:02:03", "2:30", "none"]
    return t.spark.createDataFrame([(x,) for x in rows], "x string").select("x", V.parse_duration(F.col("x")).alias("seconds"))


@query("""SELECT x, CAST(regexp_extract(x, '([0-9.]+)', 1) AS DOUBLE) * CASE WHEN x LIKE '%million%' THEN 1e6 WHEN x LIKE '%billion%' THEN 1e9 WHEN x LIKE '%thousand%' THEN 1e3 ELSE 1 END AS y
FROM (VALUES ('1.5 million'), ('2 billion'), ('3 thousand'), ('42'), ('7.25')) v(x)""")
def large_numbers(t: Tables) -> DataFrame:
    rows = ["1.5 million", "2 billion", "3 thousand", "42", "7.25"]
    return t.spark.createDataFrame([(x,) for x in rows], "x string").select("x", V.parse_double(F.col("x")).alias("y"))


@query("""SELECT * FROM (VALUES ('12 km', '12.0', 'km'), ('1990', '1990', 'gYear'), ('1,234', '1234', 'integer'), ('2.5', '2.5', 'double'), ('3rd', '3', 'integer'), ('[[Paris|city]]', 'Paris', NULL),
('http://a.example/c', 'http://a.example/c', NULL), ('plain words', 'plain words', 'langString'), ('2001-02-03', '2001-02-03', 'date')) v(x, value, kind)""")
def value_cascade(t: Tables) -> DataFrame:
    rows = ["12 km", "1990", "1,234", "2.5", "3rd", "[[Paris|city]]", "http://a.example/c", "plain words", "2001-02-03"]
    typed = t.spark.createDataFrame([(x,) for x in rows], "x string").select("x", V.Cascade().typed(F.col("x")).alias("v"))
    return typed.select("x", F.col("v.value").alias("value"), F.regexp_extract("v.datatype", "([^#]*)$", 1).alias("kind"))


@query("""SELECT x, CASE WHEN regexp_matches(lower(x), '(^|[^a-z])(false|no)($|[^a-z])') THEN false WHEN regexp_matches(lower(x), '(^|[^a-z])(true|yes)($|[^a-z])') THEN true END AS truth,
CASE WHEN regexp_matches(lower(x), '(^|[^a-z])(left|sinister)($|[^a-z])') THEN 'left' WHEN regexp_matches(lower(x), '(^|[^a-z])(right)($|[^a-z])') THEN 'right' END AS side
FROM (VALUES ('yes, left'), ('No right'), ('true'), ('maybe sinister'), ('nothing')) v(x)""")
def bool_enum_parse(t: Tables) -> DataFrame:
    rows = ["yes, left", "No right", "true", "maybe sinister", "nothing"]
    df = t.spark.createDataFrame([(x,) for x in rows], "x string")
    return df.select("x", V.parse_boolean(F.col("x")).alias("truth"), V.parse_enumeration(F.col("x"), {"left": ("sinister",), "right": ()}).alias("side"))


@query("""SELECT x, round(lat, 6) AS lat, round(lon, 6) AS lon FROM (VALUES ('52°31′N 13°24′E', 52 + 31 / 60.0, 13 + 24 / 60.0), ('{{coord|33|51|S|151|12|E}}', -(33 + 51 / 60.0), 151 + 12 / 60.0),
('48.85, 2.35', 48.85, 2.35), ('no place', NULL, NULL)) v(x, lat, lon)""")
def geo_dms(t: Tables) -> DataFrame:
    rows = ["52°31′N 13°24′E", "{{coord|33|51|S|151|12|E}}", "48.85, 2.35", "no place"]
    df = t.spark.createDataFrame([(x,) for x in rows], "x string").select("x", V.parse_coordinates(F.col("x")).alias("g"))
    return df.select("x", F.round("g.lat", 6).alias("lat"), F.round("g.lon", 6).alias("lon"))


@query("""SELECT l_orderkey, l_linenumber, round(l_quantity * CASE l_linenumber % 4 WHEN 0 THEN 1000 WHEN 1 THEN 1609.344 WHEN 2 THEN 0.3048 ELSE 0.01 END, 4) AS metres FROM lineitem""")
def unit_convert(t: Tables) -> DataFrame:
    label = F.element_at(F.array(*map(F.lit, ("km", "mi", "ft", "cm"))), F.col("l_linenumber") % 4 + 1)
    df = V.convert_units(t.lineitem.withColumn("label_", label), "l_quantity", "label_", V.unit_table(t.spark))
    return df.select("l_orderkey", "l_linenumber", F.round("standard_value", 4).alias("metres"))


@query("""SELECT o_orderkey, strftime(a, '%Y-%m-%d') AS start_at, CASE WHEN k = 0 THEN NULL WHEN k = 1 THEN strftime(a, '%Y-%m-%d') WHEN k = 2 THEN strftime(a + INTERVAL 40 DAY, '%Y-%m-%d') ELSE NULL END AS end_at
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, o_orderkey % 4 AS k FROM orders)""")
def date_interval(t: Tables) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    k, a = F.col("o_orderkey") % 4, F.col("o_orderdate")
    text = (
        F.when(k == 0, F.concat(day(a), F.lit(" – present"))).when(k == 1, day(a))
        .when(k == 2, F.concat(day(a), F.lit(" to "), day(F.date_add(a, 40)))).otherwise(F.concat(day(a), F.lit(" to "), day(F.date_add(a, -40))))
    )
    df = t.orders.select("o_orderkey", V.parse_date_interval(text).alias("i"))
    return df.select("o_orderkey", V.date_text(F.col("i.start")).alias("start_at"), V.date_text(F.col("i.end")).alias("end_at"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS joined FROM orders""")
def combine_date(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    parts = V.combine_dates(V.partial_date(F.year(d)), V.partial_date(None, F.month(d)), V.partial_date(None, None, F.dayofmonth(d)))
    return t.orders.select("o_orderkey", V.date_text(parts).alias("joined"))


@query("""SELECT o_orderkey, y AS year, m AS month FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders)""")
def textual_dates(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", V.parse_date(F.date_format("o_orderdate", "d MMMM yyyy")).alias("d"))
    return df.select("o_orderkey", F.col("d.y").alias("year"), F.col("d.m").alias("month"))


@query("""SELECT o_orderkey, CAST(date_diff('day', DATE '2000-01-01', CAST(o_orderdate AS DATE)) + 2451545 AS BIGINT) AS day_number FROM orders""")
def julian_days(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", V.julian_day(F.year(d), F.month(d), F.dayofmonth(d)).cast("long").alias("day_number"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("""SELECT doc_id, the, of_, CASE WHEN the > 3 AND the > 2 * of_ THEN 'the' WHEN of_ > 3 AND of_ > 2 * the THEN 'of' END AS winner FROM (
SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '\\bthe\\b')) AS INTEGER) AS the, CAST(len(regexp_extract_all(lower(text), '\\bof\\b')) AS INTEGER) AS of_ FROM documents WHERE lang = 'en')""")
def winner_ratio(t: Tables) -> DataFrame:
    from pagequarry.operators.extractors import winner

    counts = t.documents.where("lang = 'en'").select("doc_id", F.regexp_count(F.lower("text"), F.lit(r"\bthe\b")).alias("the"), F.regexp_count(F.lower("text"), F.lit(r"\bof\b")).alias("of_"))
    return counts.withColumn("winner", winner({"the": F.col("the"), "of": F.col("of_")}, least=3, ratio=2.0))


# --- similarity ---------------------------------------------------------------------------------------


NGRAMS = "list_distinct(list_transform(range(1, length({0}) + 3), lambda i: ('##' || {0} || '##')[i:i + 2]))"


SHARING = f"""WITH p AS (SELECT DISTINCT p_name AS a FROM part), q AS (SELECT a, {NGRAMS.format("a")} AS g FROM p),
m AS (SELECT x.a AS a, y.a AS b, x.g AS g, y.g AS h, len(list_intersect(x.g, y.g)) AS i FROM q x JOIN q y ON x.a < y.a WHERE len(list_intersect(x.g, y.g)) > 0)"""


def sharing_pairs(t: Tables) -> DataFrame:
    """a, b, their numbers of n-grams and the number they share, of all pairs of names that share any; the other pairs score 0."""
    grams = t.part.select(F.col("p_name").alias("a")).distinct().withColumn("g", M.ngrams(F.col("a"))).select("a", F.size("g").alias("na"), F.explode("g").alias("gram"))
    other = grams.select(F.col("a").alias("b"), F.col("na").alias("nb"), "gram")
    return grams.join(other, "gram").where("a < b").groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("shared"))


@query(f"{SHARING} SELECT a, b, round(i / (len(g) + len(h) - i), 6) AS score FROM m")
def ngram_jaccard(t: Tables) -> DataFrame:
    return sharing_pairs(t).select("a", "b", F.round(F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared")), 6).alias("score"))


@query(f"{SHARING} SELECT a, b, round(2 * i / (len(g) + len(h)), 6) AS score FROM m")
def ngram_dice(t: Tables) -> DataFrame:
    return sharing_pairs(t).select("a", "b", F.round(2 * F.col("shared") / (F.col("na") + F.col("nb")), 6).alias("score"))


@query(f"{SHARING} SELECT a, b, round(i / least(len(g), len(h)), 6) AS score FROM m")
def ngram_overlap(t: Tables) -> DataFrame:
    return sharing_pairs(t).select("a", "b", F.round(F.col("shared") / F.least("na", "nb"), 6).alias("score"))


@query("""WITH p AS (SELECT DISTINCT p_name AS a FROM part), m AS (SELECT x.a AS a, y.a AS b, levenshtein(x.a, y.a) AS d, greatest(length(x.a), length(y.a)) AS n FROM p x JOIN p y ON x.a < y.a)
SELECT a, b, round(1 - d / n, 6) AS score FROM m WHERE 3 * d <= n""")
def levenshtein_ratio(t: Tables) -> DataFrame:
    """Pairs from a ratio of 2/3. One edit changes three of the n + 2 padded trigrams of a name of n letters at most,
    so names without a common one are (n + 2) / 3 edits apart at least, a ratio under 2/3: none is lost."""
    near = F.levenshtein("a", "b") * 3 <= F.greatest(F.length("a"), F.length("b"))
    return sharing_pairs(t).where(near).select("a", "b", F.round(M.levenshtein_ratio(F.col("a"), F.col("b")), 6).alias("score"))


@query(f"""WITH p AS (SELECT DISTINCT p_name AS a FROM part), q AS (SELECT a, {NGRAMS.format("a")} AS g FROM p),
c AS (SELECT x.a AS a, y.a AS b, round(len(list_intersect(x.g, y.g)) / len(list_distinct(list_concat(x.g, y.g))), 6) AS score FROM q x JOIN q y ON x.a <> y.a WHERE len(list_intersect(x.g, y.g)) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS k FROM c) SELECT a, b AS best, score FROM r WHERE k = 1 AND score >= 0.3""")
def similarity_join_best(t: Tables) -> DataFrame:
    from pagequarry.operators.matching import best_matches

    names = t.part.select("p_name").distinct()
    return best_matches(names, names, "p_name", "p_name", threshold=0.3)


# --- scalar functions ---------------------------------------------------------------------------------


@query("""SELECT p_partkey, p_name || ' is ' || p_brand AS plain, p_type || '|' || p_brand AS parts, lower(lpad(to_hex(p_partkey), 8, '0')) AS code FROM part""")
def text_scalars(t: Tables) -> DataFrame:
    """Emphasis removed, trimmed parts of a list, and numbers as hexadecimals of a fixed width."""
    marked = F.concat(F.lit("'''"), "p_name", F.lit("''' is ''"), "p_brand", F.lit("''"))
    parts = S.trim_split(F.concat(F.lit(" ; "), "p_type", F.lit(" ; ;"), "p_brand", F.lit(" ")), ";")
    return t.part.select("p_partkey", S.remove_emphasis(marked).alias("plain"), F.array_join(parts, "|").alias("parts"), S.fixed_hex(F.col("p_partkey"), 8).alias("code"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS written, CASE WHEN o_orderkey % 5 = 0 THEN -1 ELSE epoch_ms(o_orderdate) END AS millis FROM orders""")
def timestamps(t: Tables) -> DataFrame:
    """Timestamps as text and back; broken ones are -1."""
    written = S.iso_timestamp(F.col("o_orderdate"))
    return t.orders.select("o_orderkey", written.alias("written"), S.parse_timestamp(F.when(F.col("o_orderkey") % 5 == 0, F.lit("yesterday")).otherwise(written)).alias("millis"))


@query(r"""SELECT n_nationkey, 'Zürich ' || n_name AS text, 'Z\u00FCrich ' || n_name AS escaped, 'http://x/Z%C3%BCrich/' || n_nationkey AS uri, 'http://x/Zürich/' || n_nationkey AS iri FROM nation""")
def letters_beyond_ascii(t: Tables) -> DataFrame:
    """Numeric escapes and percent-encoding, both ways."""
    text, iri = F.concat(F.lit("Zürich "), "n_name"), F.concat(F.lit("http://x/Zürich/"), F.col("n_nationkey").cast("string"))
    return t.nation.select("n_nationkey", S.unescape_codes(S.escape_non_ascii(text)).alias("text"), S.escape_non_ascii(text).alias("escaped"), S.to_ascii_uri(iri).alias("uri"), S.to_iri(S.to_ascii_uri(iri)).alias("iri"))


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'http://www.x.example/' || page_id WHEN 2 THEN 'http://y.example/' || page_id END AS cleaned, page_id % 4 = 0 AS known, page_id % 4 = 0 AS absolute,
CASE WHEN page_id % 4 = 0 THEN regexp_replace(url, '^https?://', '') END AS relative FROM pages""")
def iri_scalars(t: Tables) -> DataFrame:
    """Addresses cleaned, judged and made relative; every fourth is whole, the others lack a scheme or aren't addresses."""
    k = F.col("page_id").cast("string")
    raw = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit(" "), "url", F.lit(" "))).when(F.col("page_id") % 4 == 1, F.concat(F.lit("www.x.example/"), k)).when(F.col("page_id") % 4 == 2, F.concat(F.lit("//y.example/"), k)).otherwise("not an <address>")
    tail = F.when(F.col("page_id") % 4 == 0, S.relativize(S.relativize(F.col("url"), "https://"), "http://"))
    return t.pages.select("page_id", S.clean_url(raw).alias("cleaned"), S.has_known_scheme(F.trim(raw)).alias("known"), S.is_valid_iri(F.trim(raw)).alias("absolute"), tail.alias("relative"))


@query(r"""SELECT p_partkey, p_name || ' & ' || p_brand || ' €' AS text, upper(p_name[1]) || p_name[2:] AS name FROM part""")
def unescape_entities(t: Tables) -> DataFrame:
    """Named and numeric entities of all kinds, and capitals."""
    coded = F.concat(F.regexp_replace("p_name", "a", "&#97;"), F.lit(" &amp; "), "p_brand", F.lit(" &euro;"))
    return t.part.select("p_partkey", S.html_unescape(coded).alias("text"), S.capitalize(S.uncapitalize(F.col("p_name"))).alias("name"))


@query("""SELECT o_orderkey, CAST(a AS DOUBLE) * 3600 + b * 60 AS seconds_en, CAST(a AS DOUBLE) * 3600 + b * 60 AS seconds_de, CAST(b AS DOUBLE) * 86400 AS seconds_ru FROM (SELECT o_orderkey, o_orderkey % 23 + 1 AS a, o_custkey % 59 + 1 AS b FROM orders)""")
def durations(t: Tables) -> DataFrame:
    """Durations in words of three languages."""
    a, b = ((F.col(c) % n + 1).cast("string") for c, n in (("o_orderkey", 23), ("o_custkey", 59)))
    read = lambda lang, *parts: V.parse_duration(F.concat(*parts), lang).alias(f"seconds_{lang}")
    return t.orders.select("o_orderkey", read("en", a, F.lit(" hours, "), b, F.lit(" minutes")), read("de", a, F.lit(" Stunden "), b, F.lit(" Minuten")), read("ru", b, F.lit(" дней")))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS de, strftime(o_orderdate, '%Y-%m-%d') AS pl, strftime(o_orderdate, '%Y-%m-%d') AS el FROM orders""")
def dates_in_languages(t: Tables) -> DataFrame:
    """Day, name of the month and year in three languages."""
    d = F.col("o_orderdate")

    def read(lang: str) -> Column:
        month = F.element_at(F.array(*map(F.lit, V.MONTHS[lang].split())), F.month(d))
        return V.date_text(V.parse_date(F.concat_ws(" ", F.dayofmonth(d).cast("string"), month, F.year(d).cast("string")), lang)).alias(lang)

    return t.orders.select("o_orderkey", read("de"), read("pl"), read("el"))


@query("""SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS value, CASE l_linenumber % 3 WHEN 0 THEN 'km' WHEN 1 THEN 'kg' ELSE 'ft' END AS unit FROM lineitem""")
def numbers_with_units(t: Tables) -> DataFrame:
    """The number that a unit follows, among other numbers; templates of conversion; feet and inches."""
    n, k = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber") % 3
    text = F.when(k == 0, F.concat(F.lit("in 1990 it had "), n, F.lit(" km"))).when(k == 1, F.concat(F.lit("about 3 houses, {{convert|"), n, F.lit("|kg|lb}}"))).otherwise(F.concat(n, F.lit(" ft 0 in")))
    lines = spread(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "l_orderkey")
    return lines.select("l_orderkey", "l_linenumber", V.value_with_unit(text).alias("u")).select("l_orderkey", "l_linenumber", "u.value", "u.unit")


@query("""SELECT s_suppkey, 'http://s' || s_suppkey || '.example/x' AS loose, CASE WHEN s_suppkey % 2 = 0 THEN 'http://s' || s_suppkey || '.example/x' END AS strict FROM supplier""")
def links_in_text(t: Tables) -> DataFrame:
    """The first address of a text, and, if strict, only one that is all of it."""
    url = F.concat(F.lit("http://s"), F.col("s_suppkey").cast("string"), F.lit(".example/x"))
    text = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("["), url, F.lit(" the site]"))).otherwise(F.concat(F.lit("see "), url, F.lit(" there")))
    return t.supplier.select("s_suppkey", S.parse_link(text).alias("loose"), S.parse_link(text, strict=True).alias("strict"))


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Germany' WHEN 1 THEN 'Sweden' ELSE 'New Land' END AS country FROM supplier")
def flags(t: Tables) -> DataFrame:
    k = F.col("s_suppkey") % 3
    return t.supplier.select("s_suppkey", V.parse_flag(F.when(k == 0, "{{GER}}").when(k == 1, "{{flagicon|SWE}}").otherwise("{{flag|New Land}}")).alias("country"))
