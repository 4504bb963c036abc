"""Operators beyond the query catalogue: parsing, rendering, closures, validation, sources, sinks, streams."""

import datetime
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagequarry.model import STATEMENT_COLUMNS, STATEMENT_SCHEMA
from pagequarry.operators import matching, nif, post, render, validation, wikidata
from pagequarry.operators.wikitext import TRANSFORMS, Parser, expand_spans, parsed, title_parts
from pagequarry.plans import fixtures
from pagequarry.sources import pages as sources
from pagequarry.sources import sinks
from pagequarry.streaming import live

ROWS = [
    ("en", "labels", "http://e/a", "http://e/p", 'say "x"\\n\n', None, "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString"),
    (None, "links", "http://e/a", "http://e/q", "http://e/ö", "http://e/c", None),
    (None, "sizes", "http://e/b", "http://e/r", "12", None, "http://www.w3.org/2001/XMLSchema#integer"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, STATEMENT_SCHEMA)


def test_round_trip(rows):
    lines = render.render(rows, "turtle-quads").withColumnRenamed("line", "value")
    back = render.parse_lines(lines, keep=("dataset",))
    assert back.where("not ok").count() == 0
    assert sorted(map(str, back.select(*STATEMENT_COLUMNS).collect())) == sorted(map(str, rows.collect()))


def test_broken_lines(spark):
    lines = spark.createDataFrame([("# note",), ("",), ("<a> <b> .",), ("<a> <b> <c> .",), ('<a> <b> "x"^^<t> .',)], "value string")
    got = render.parse_lines(lines).select("ok", "value").collect()
    assert [r[0] for r in got].count(False) == 1 and {r[1] for r in got if r[0]} == {"c", "x"}


@pytest.mark.parametrize("form", sorted(render.FORMATS))
def test_formats(rows, form):
    out = [r.line for r in render.render(rows, form).collect()]
    assert len(out) == 3 and all(out)
    if form in render.ASCII_FORMATS:
        assert all(x.isascii() for x in out)


def test_policies(spark):
    df = spark.createDataFrame([("http://en.example.org/resource/A", "p", "http://en.example.org/resource/" + "x" * 600), ("http://en.example.org/resource/A", "p", "v1")], "subject string, predicate string, value string")
    df = df.select(F.lit(None).cast("string").alias("language"), F.lit("d").alias("dataset"), "*", F.lit(None).cast("string").alias("context"), F.when(F.col("value") == "v1", "t").alias("datatype"))
    out = render.apply_policies(df, [("subject", render.generic("en")), ("object", render.reject_long)]).collect()
    assert [(r.subject, r.value) for r in out] == [("http://example.org/resource/A", "v1")]


def kinds(text):
    return [(n["kind"], n["name"]) for n in Parser(text).parse() if n["kind"] != "text"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("", []), ("[[a|b]] [http://x y]", [("link", "a"), ("external", "http://x")]), ("{{t|k=v|[[a]]}}", [("template", "T"), ("link", "a")]),
        ("{{a|{{b|{{c}}}}}}", [("template", "A"), ("template", "B"), ("template", "C")]), ("{{open [[a]]", [("link", "a")]), ("== S ==\n=== T ===", [("section", "S"), ("section", "T")]),
        ("{{{p|d}}}", [("parameter", "p")]), ("<!-- [[x]] --><nowiki>{{y}}</nowiki>", []), ("{{#if:x|y}}", [("function", "#if:x")]), ("see http://a.b/c.", [("external", "http://a.b/c")]),
    ],
)
def test_wikitext(text, expected):
    assert kinds(text) == expected


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="[]{}|=a \n<>'!-", max_size=60))
def test_wikitext_never_fails(text):
    nodes = Parser(text).parse()
    assert [n["id"] for n in nodes] == list(range(len(nodes))) and all(n["parent"] < n["id"] for n in nodes)


def test_open_brackets_take_linear_time():
    began = time.time()
    for text in ("{{a " * 20_000, "[[" * 40_000, "{{a|" * 1000 + "}}" * 1000, "{|" * 20_000, "[[x {{" * 20_000 + "]]"):
        Parser(text).parse()
    assert time.time() - began < 60


def test_deep_nesting():
    assert [n["depth"] for n in Parser("{{a|" * 150 + "}}" * 150).parse()] == list(range(150))
    Parser("{{a|" * 3000 + "}}" * 3000).parse()
    Parser("[[" * 5000).parse()


def test_spans():
    cell = lambda t, r=1, c=1: {"text": t, "rowspan": r, "colspan": c}
    assert expand_spans([[cell("a", 2), cell("b")], [cell("c")], [cell("d", 1, 2)]]) == [["a", "b"], ["a", "c"], ["d", "d"]]


def test_titles(spark):
    df = spark.createDataFrame([("category:towns#x",), (":de:Ulm",), ("de:Ulm",), ("a_b%20c",), ("File:x.png",)], "x string").select(title_parts(F.col("x")).alias("t")).select("t.*")
    assert [(r.title, r.ns, r.language) for r in df.collect()] == [("Towns", 14, None), ("Ulm", 0, None), ("Ulm", 0, "de"), ("A b c", 0, None), ("X.png", 6, None)]


def test_parsed_pages(spark):
    counts = {r.page_id: len(r.nodes) for r in parsed(fixtures.pages(spark)).collect()}
    assert counts[9] == 0 and counts[1] > 15


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.integers(0, 12), st.integers(0, 12), max_size=12))
def test_closure(spark, edges):
    expected = set()
    for src in edges:
        seen, at = set(), src
        while at in edges and at not in seen:
            seen.add(at)
            at = edges[at]
        if at not in edges:
            expected.add((src, at))
    df = spark.createDataFrame(list(edges.items()), "src long, dst long")
    assert {tuple(r) for r in post.redirect_closure(df).collect()} == expected


def test_difference(spark):
    make = lambda xs: spark.createDataFrame([("s", "p", x, None, None) for x in xs], "subject string, predicate string, value string, datatype string, language string")
    got = {(r.value, r.op) for r in post.set_difference(make("abc"), make("bcd")).collect()}
    assert got == {("a", "deleted"), ("b", "unmodified"), ("c", "unmodified"), ("d", "added")}


def test_validation(rows, spark):
    rules = [validation.Rule("iri", "any_iri", None, "is_iri", None), validation.Rule("int", "typed", "http://www.w3.org/2001/XMLSchema#integer", "pattern", "^-?\\d+$"), validation.Rule("tag", "lang", None, "vocab", ["nothing"]), validation.Rule("never", "blank", None, "pattern", "x")]
    assert {(r.test, r.covered, r.valid) for r in validation.scores(rows, rules).collect()} == {("iri", 7, 7), ("int", 1, 1), ("tag", 1, 0)}
    assert [r.test for r in validation.failures(rows, rules).collect()] == ["tag"]
    shape = spark.createDataFrame([("http://e/a", "http://e/p", 2, None, None), ("http://e/b", "http://e/r", 1, 1, "^\\d+$")], "target string, path string, least int, most int, pattern string")
    assert [r.target for r in validation.shapes(rows, shape).collect()] == ["http://e/a"]


def test_matching(spark):
    known = spark.createDataFrame([("a small town", "1"), ("river", "2")], "text string, id string")
    texts = spark.createDataFrame([("a small town",), ("a smaller town",), ("zzz",)], "text string")
    got = {r.text: r.id for r in matching.assign_ids(texts, known, 0.5).collect()}
    assert got["a small town"] == got["a smaller town"] == "1" and got["zzz"] not in ("1", "2")


def test_text_model(spark):
    html = "<html><body><h2>A</h2><p>One <a href='/x'>two three</a>.</p><h3>B</h3><p>Four</p><p>Five<script>no</script></p></body></html>"
    df = spark.createDataFrame([(1, html), (2, None), (3, "<p>un<b>closed")], "page_id long, html string")
    pieces = nif.model(df)
    text = nif.context(pieces).where("page_id = 1").first().text
    assert text == "A\n\nOne two three.\n\nB\n\nFour\n\nFive"
    link = nif.links(pieces).first()
    assert text[link.begin : link.end] == "two three" and link.kind == "phrase"
    assert [(r.depth, r.parent) for r in nif.sections(pieces).orderBy("ord").collect()] == [(2, None), (3, 0)]
    assert [(r.ord, r.previous, r.next) for r in nif.neighbours(pieces).where("page_id = 1").orderBy("ord").collect()] == [(1, None, None), (3, None, 4), (4, 3, None)]


def test_xml_dump(spark, tmp_path):
    page = lambda t, x, r="": f"<page><title>{t}</title><ns>0</ns><id>7</id>{r}<revision><id>9</id><timestamp>2024-01-02T03:04:05Z</timestamp><contributor><username>E</username><id>3</id></contributor><format>text/x-wiki</format><text xml:space=\"preserve\">{x}</text></revision></page>"
    (tmp_path / "d.xml").write_text("<mediawiki>" + page("A", "hello [[B]]") + page("C", "", '<redirect title="A" />') + "</mediawiki>")
    got = {r.title: r for r in sources.xml_dump(spark, str(tmp_path / "d.xml"), "en", [0]).collect()}
    assert got["A"].source == "hello [[B]]" and got["A"].revision == 9 and got["A"].ts == datetime.datetime(2024, 1, 2, 3, 4, 5)
    assert got["C"].redirect == "A"
    assert [tuple(r) for r in sources.redirects(sources.xml_dump(spark, str(tmp_path / "d.xml"), "en")).collect()] == [("C", "A")]


def test_files(spark, tmp_path, rows):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "Big_town.wiki").write_text("x [[y]]")
    assert sources.page_files(spark, str(tmp_path / "p"), "en").first().title == "Big town"
    (tmp_path / "props.sql").write_text("INSERT INTO x VALUES (1,'disambiguation',''),(2,'other',''),(3,'disambiguation','');\n")
    assert {r[0] for r in sources.sql_dump_ids(spark, str(tmp_path / "props.sql")).collect()} == {1, 3}
    counts = sinks.text(rows, str(tmp_path / "out"), "n-triples")
    assert counts == {"lines": 3, "bad": 0}
    sinks.table(rows, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 3
    (tmp_path / "enwiki-20240101-labels.ttl").write_text('<a> <b> "x"@en .\nbroken\n')
    got = sources.statement_files(spark, str(tmp_path / "enwiki-20240101-labels.ttl")).orderBy("ok").collect()
    assert [(r.dataset, r.ok) for r in got] == [("labels", False), ("labels", True)]
    one = sinks.file_catalogue(spark, str(tmp_path / "p")).first()
    assert (one.bytes, one.lines) == (8, 1)
    day = tmp_path / "base" / "enwiki" / "20240102"
    day.mkdir(parents=True)
    (tmp_path / "base" / "enwiki" / "20230102").mkdir()
    for n in ("enwiki-20240102-pages.xml.bz2", "enwiki-20240102-pages2.xml", "other"):
        (day / n).write_text("")
    assert [x.rpartition("/")[2] for x in sources.find_files(spark, str(tmp_path / "base"), "enwiki", r"pages\d*\.xml(\.bz2)?")] == ["enwiki-20240102-pages.xml.bz2", "enwiki-20240102-pages2.xml"]
    assert sources.find_files(spark, str(tmp_path / "base"), "dewiki", ".*") == []


def test_stream(spark, tmp_path):
    schema = "page string, version int, deleted boolean, subject string, predicate string, value string, datatype string, language string"
    steps = [[("A", 1, False, "s", "p", v, None, None) for v in "ab"], [("A", 2, False, "s", "p", v, None, None) for v in "bc"], [("A", 3, True, "s", "p", "c", None, None)]]
    for k, part in enumerate(steps):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        changes = live.page_differences(live.feed(spark, str(tmp_path / "in"), schema))
        live.publish(changes, str(tmp_path / f"out{k}"), str(tmp_path / "check")).awaitTermination()
    got = [sorted((r.value, r.op) for r in spark.read.option("basePath", str(tmp_path / f"out{k}")).parquet(str(tmp_path / f"out{k}")).select("value", "op").collect()) for k in range(3)]
    assert got == [[("a", "added"), ("b", "added")], [("a", "deleted"), ("c", "added")], [("b", "deleted"), ("c", "deleted")]]


def test_stream_of_null_and_empty_values(spark, tmp_path):
    """A null language isn't an empty one, in what is added and in what is deleted."""
    schema = "page string, version int, deleted boolean, subject string, predicate string, value string, datatype string, language string"
    for k, (value, lang) in enumerate((("", None), ("", ""), ("x", ""))):
        spark.createDataFrame([("A", k, False, "s", "p", value, None, lang)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        changes = live.page_differences(live.feed(spark, str(tmp_path / "in"), schema))
        live.publish(changes, str(tmp_path / f"out{k}"), str(tmp_path / "check")).awaitTermination()
    got = [sorted(((r.op, r.value, r.language) for r in spark.read.option("basePath", str(tmp_path / f"out{k}")).parquet(str(tmp_path / f"out{k}")).collect()), key=str) for k in range(3)]
    assert got == [[("added", "", None)], [("added", "", ""), ("deleted", "", None)], [("added", "x", ""), ("deleted", "", "")]]


def test_page_processor(spark, tmp_path):
    """Batches of edits: changes by batch, deleted pages, a page that fails, and what the state holds then."""
    schema = "item_id long, name string, modified timestamp, deleted boolean, xml string"
    at = lambda m: datetime.datetime(2024, 1, 1, 0, m)

    def extract(items):
        if items.where("xml like '%boom%'").count():
            raise ValueError("can't be extracted")
        words = items.select(F.col("name").alias("context"), F.explode(F.split("xml", " ")).alias("value"))
        none = F.lit(None).cast("string")
        return words.select(F.col("context").alias("subject"), F.lit("word").alias("predicate"), "value", none.alias("datatype"), none.alias("language"), "context")

    steps = [[(1, "A", at(1), False, "a b"), (2, "B", at(1), False, "x"), (3, "A", at(2), False, "a c")], [(4, "A", at(3), False, "a d"), (5, "B", at(3), True, "")], [(6, "A", at(4), False, "boom")], [(7, "A", at(5), False, "e")]]
    folder = str(tmp_path / "live")
    for part in steps:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        live.process(live.feed(spark, str(tmp_path / "in"), schema), extract, folder, str(tmp_path / "check"), parts=4).awaitTermination()
    diffs = spark.read.option("basePath", f"{folder}/diff").parquet(f"{folder}/diff").collect()
    got = sorted((r.batch, r.op, r.context, r.value) for r in diffs)
    assert got == [(0, "added", "A", "a"), (0, "added", "A", "c"), (0, "added", "B", "x"), (1, "added", "A", "d"), (1, "deleted", "A", "c"), (1, "deleted", "B", "x"), (3, "added", "A", "e"), (3, "deleted", "A", "a"), (3, "deleted", "A", "d")]
    state = {r.page: r for r in live.pages_of_state(spark, folder).collect()}
    assert set(state) == {"A"} and state["A"].times == 3 and [s.value for s in state["A"].statements] == ["e"] and state["A"].error is None


def test_backpressure():
    assert [live.files_per_trigger(n, 100, 50) for n in (0, 100, 200, 10_000)] == [50, 50, 25, 1]


def test_titles_and_namespaces_agree(spark):
    rows = [("Template:A", 10, "Template:B"), ("Template:C", 10, "Main page"), ("Vorlage:D", 10, "Vorlage:E"), ("Dune: part two", 0, None), ("File:x.png", 0, None)]
    pages = spark.createDataFrame(rows, "title string, ns int, redirect string").withColumn("source", F.lit(""))
    assert {tuple(r) for r in sources.template_redirects(pages).collect()} == {("A", "B"), ("D", "E")}
    assert [r.agrees for r in sources.consistent(pages).orderBy("title").collect()] == [True, False, True, True, True]


def test_best_matches_lose_no_pair(spark):
    rng = random.Random(6)
    names = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 10))) for _ in range(150)})
    grams = lambda n: {f"##{n}##"[k : k + 3] for k in range(len(n) + 2)}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for threshold in (0.3, 0.6):
        expected = {}
        for a in names:
            best = min(((-round(len(grams(a) & grams(b)) / len(grams(a) | grams(b)), 6), b) for b in names if a != b))
            if -best[0] >= threshold:
                expected[a] = (best[1], -best[0])
        got = {r.a: (r.best, r.score) for r in matching.best_matches(df, df, "n", "n", threshold).collect()}
        assert {a: b for a, (b, _) in got.items()} == {a: b for a, (b, _) in expected.items()}


def test_live_batch(spark):
    t = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame([(1, t(0), 10), (1, t(0), 10), (1, t(20), 11), (2, t(5), 12)], "k int, ts timestamp, v int")
    assert live.once_per_timestamp(df, "k", "ts").count() == 3
    assert sorted((r.k, r.n, r.latest) for r in live.debounced(df, "k", "ts", "v", "10 minutes").collect()) == [(1, 1, 11), (1, 2, 10), (2, 1, 12)]


# --- round 3 -------------------------------------------------------------------------------------------------


def tasks(df):
    return df.rdd.getNumPartitions()


def test_wikitext_in_one_file_is_parsed_in_many_tasks(spark):
    """Pages that arrive in one task are dealt out before they are parsed, plainly or with transforms."""
    pages = fixtures.pages(spark).coalesce(1)
    assert tasks(pages) == 1
    for made in (parsed(pages), parsed(pages, TRANSFORMS)):
        assert tasks(made) >= 4
        assert made.where("size(nodes) > 0").count() == parsed(pages.limit(100)).where("size(nodes) > 0").count() > 0


def test_split_at_signs():
    """Parts by a scan of the brackets give what a look at each letter gave."""
    assert Parser.split("a|{{b|c}}|[[d|e]]|f", "|") == ["a", "{{b|c}}", "[[d|e]]", "f"]
    assert Parser.split("k={{x|y=1}}=2", "=") == ["k", "{{x|y=1}}", "2"]
    assert Parser.split("|}}=1{|a=2|}=3", "=") == ["|}}", "1{|a=2|}", "3"]
    assert Parser.split("plain", "|") == ["plain"] and Parser.split("a|}|b", "|") == ["a", "}", "b"]


def test_rendered_pages_in_one_file_are_parsed_in_many_tasks(spark):
    """So are rendered ones, and sections and offsets need no other shuffle."""
    df = spark.createDataFrame([(k, f"<h2>T{k}</h2><p>Text <a href='/x'>of {k}</a></p>") for k in range(600)] + [(600, None)], "page_id long, html string").coalesce(1)
    pieces = nif.model(df)
    assert tasks(pieces) >= 4 and pieces.count() == 1200
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan
    assert nif.links(pieces).count() == 600


def test_enriched_broadcasts_no_large_table(spark):
    """neither the spans nor a dictionary beyond the limit goes to the driver."""
    links = spark.createDataFrame([(1, 0, 0, 4, "word")], "page_id long, ord int, begin int, end int, kind string")
    candidates = spark.createDataFrame([(1, 0, 2, 6, "phrase"), (1, 0, 5, 9, "word"), (1, 0, 8, 20, "phrase"), (2, 0, 0, 4, "word")], "page_id long, ord int, begin int, end int, kind string")
    out = nif.enriched(links, candidates)
    assert {(r.page_id, r.begin, r.end) for r in out.collect()} == {(1, 0, 4), (1, 8, 20), (2, 0, 4)}
    assert "Broadcast" not in out._jdf.queryExecution().sparkPlan().toString()
    many = spark.range(50).withColumnRenamed("id", "page_id")
    assert "Broadcast" not in links.join(post.small(many, rows=10), "page_id")._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" in links.join(post.small(many, rows=100), "page_id")._jdf.queryExecution().sparkPlan().toString()


def item_pages(spark, *sources):
    return spark.createDataFrame([(k, None, "application/json", s) for k, s in enumerate(sources)], "page_id long, redirect string, format string, source string").coalesce(1)


def test_items_are_read_once_in_many_tasks(spark):
    """An item's JSON is read after the pages are dealt out, once."""
    item = '{"id":"Q%d","sitelinks":{"enwiki":{"site":"enwiki","title":"A"},"dewiki":{"site":"dewiki","title":"B"},"frwiki":{"site":"frwiki","title":"C"}}}'
    pages = item_pages(spark, *[item % k for k in range(40)], "broken", '{"id":null}')
    items = wikidata.items(pages)
    assert tasks(items) >= 4 and items.count() == 40
    plan = wikidata.site_links(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.index("from_json(") < plan.index("RepartitionByExpression")


def test_language_links_of_an_item_on_two_pages(spark):
    """pairs come from an item's grouped links, those of its other page too."""
    one = '{"id":"Q1","sitelinks":{"%swiki":{"site":"%swiki","title":"%s"}}}'
    out = wikidata.language_links(item_pages(spark, one % ("en", "en", "A"), one % ("de", "de", "B")))
    r = "http://%s.example.org/resource/%s"
    assert {(x.subject, x.value) for x in out.collect()} == {(r % ("en", "A"), r % ("de", "B")), (r % ("de", "B"), r % ("en", "A"))}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
