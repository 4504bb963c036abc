"""Readers of values, case by case."""

import pytest
from pyspark.sql import functions as F

from pagequarry.functions import scalar as S
from pagequarry.functions import similarity as M
from pagequarry.functions import values as V

XSD = "http://www.w3.org/2001/XMLSchema#"


def read(spark, f, values, **more):
    df = spark.createDataFrame(list(enumerate(values)), "k int, x string").select("k", f(F.col("x"), **more).alias("y"))
    return [tuple(r["y"]) if hasattr(r["y"], "asDict") else r["y"] for r in df.orderBy("k").collect()]


@pytest.mark.parametrize(
    "reader, lang, cases",
    [
        (V.parse_double, "en", {"1,234.5": 1234.5, "-3.5": -3.5, "−7": -7.0, "about 2.5 million people": 2.5e6, "none": None, "": None, None: None}),
        (V.parse_double, "de", {"1.234,5": 1234.5, "2,5 Millionen": 2.5e6}),
        (V.parse_integer, "en", {"1,234": 1234, "3.6": 4, "x": None}),
        (V.parse_boolean, "en", {"yes": True, "No": False, "maybe": None, "nothing": None}),
        (V.parse_boolean, "fr", {"oui": True, "faux": False}),
    ],
)
def test_numbers(spark, reader, lang, cases):
    assert read(spark, reader, list(cases), lang=lang) == list(cases.values())


def test_integer_kinds(spark):
    assert read(spark, V.parse_integer, ["-1", "0", "1"], kind="positiveInteger") == [None, None, 1]
    assert read(spark, V.parse_integer, ["-1", "0", "1"], kind="nonPositiveInteger") == [-1, 0, None]


@pytest.mark.parametrize(
    "lang, cases",
    [
        ("en", {"2001-02-03": "2001-02-03", "3 February 2001": "2001-02-03", "February 3, 2001": "2001-02-03", "March 1999": "1999-03", "May 5": "--05-05", "1850": "1850", "300 BC": "-0300", "31 February 2001": None, "04/05/2006": "2006-04-05", "no date": None}),
        ("de", {"3. März 2001": "2001-03-03", "04.05.2006": "2006-05-04", "44 v. Chr.": "-0044"}),
        ("fr", {"1er mai 1900": "1900-05-01", "juin 1901": "1901-06"}),
        ("es", {"3 de mayo de 1900": "1900-05-03"}),
    ],
)
def test_dates(spark, lang, cases):
    text = lambda x: V.date_text(V.parse_date(x, lang))
    assert read(spark, text, list(cases)) == list(cases.values())


def test_date_interval(spark):
    cases = {"1990–1995": ("1990", "1995"), "1990 - present": ("1990", None), "since 2001": ("2001", None), "3 May 1990 – 4 June 1992": ("1990-05-03", "1992-06-04"), "1999": ("1999", "1999"), "1995–1990": ("1995", None)}
    f = lambda x: V.let(V.parse_date_interval(x), lambda i: F.struct(V.date_text(i["start"]), V.date_text(i["end"])))
    assert read(spark, f, list(cases)) == list(cases.values())


def test_durations(spark):
    cases = {"1h 40min., 17s": 6017.0, "4 hours, 7 minutes": 14820.0, "1:02:03": 3723.0, "2 years": 63072000.0, "-3 min": -180.0, "x": None}
    assert read(spark, V.parse_duration, list(cases)) == list(cases.values())


def test_units(spark):
    cases = {"12 km": (12.0, "km"), "5 ft 6 in": (5.5, "ft"), "€ 300": (300.0, "€"), "3.5 kg of": (3.5, "kg"), "12": None}
    assert read(spark, V.value_with_unit, list(cases)) == list(cases.values())
    df = V.convert_units(spark.createDataFrame([(20.0, "°C"), (1.0, "KM"), (3.0, "€"), (1.0, "?")], "v double, u string"), "v", "u", V.unit_table(spark))
    assert [r[0] for r in df.orderBy("v", "u").select("standard_value").collect()] == [None, 1000.0, None, 293.15]


def test_coordinates(spark):
    got = read(spark, V.parse_coordinates, ["52°31′N 13°24′E", "{{coord|52|31|N|13|24|E}}", "{{Coord|51.5|-0.12}}", "95.0, 2.0", "x"])
    assert got[0] == got[1] == pytest.approx((52 + 31 / 60, 13.4))
    assert got[2:] == [(51.5, -0.12), None, None]
    assert read(spark, V.parse_single_coordinate, ["13/24/W", "x"]) == [-13.4, None]


def test_calendars(spark):
    row = spark.range(1).select(V.julian_to_gregorian(F.lit(1582), F.lit(10), F.lit(5)), V.ethiopian_to_gregorian(F.lit(2000), F.lit(1), F.lit(1)), V.julian_day(F.lit(2000), F.lit(1), F.lit(1))).first()
    assert tuple(row[0]) == (1582, 10, 15) and tuple(row[1]) == (2007, 9, 12) and row[2] == 2451545
    assert read(spark, V.geez_number, ["፲፱፻፺፰", "፼", "፻", "፭", "5"]) == [1998, 10000, 100, 5, None]


def test_cascade(spark):
    cases = {"12 km": ("12.0", "km"), "3 May 1990": ("1990-05-03", XSD + "date"), "1,234": ("1234", XSD + "integer"), "2.5": ("2.5", XSD + "double"), "3rd": ("3", XSD + "integer"), "[[Paris|city]]": ("Paris", None), "http://a.b/c": ("http://a.b/c", None)}
    assert read(spark, V.Cascade().typed, list(cases)) == list(cases.values())


def test_scalars(spark):
    one = lambda f, x: read(spark, f, [x])[0]
    assert one(S.wiki_encode, "a  b_c?") == "a_b_c%3F" and one(S.wiki_decode, "a_b%3F+c") == "a b?+c"
    assert one(S.property_key, "birth_date2") == "birthDate" and one(S.remove_emphasis, "'''''a''''' ''b''") == "a b"
    assert one(S.to_iri, "http://x/%C3%A9%20%FF") == "http://x/é%20%FF" and one(S.to_ascii_uri, "http://x/é") == "http://x/%C3%A9"
    assert one(S.broken_brackets, "A (; b) c () d") == "A c d" and one(S.short_text, "short") == "short"
    assert read(spark, S.clean_url, ["//a.b", "www.a.b", "x", "http://a b"]) == ["http://a.b", "http://www.a.b", None, None]
    assert one(S.html_unescape, "&eacute;&#65;") == "éA" and one(S.parse_timestamp, "") == -1
    for text in ("a\"b\\c\n\t", "é\\n"):
        assert one(lambda x: S.turtle_unescape(S.turtle_escape(x)), text) == text
        assert one(lambda x: S.unescape_codes(S.escape_non_ascii(x)), "é😀") == "é😀"


def test_similarity(spark):
    df = spark.createDataFrame([("abc", "abc"), ("abcd", "abc"), ("kitten", "sitting")], "a string, b string")
    assert [round(r[0], 3) for r in df.select(M.similarity(F.col("a"), F.col("b"))).collect()] == [1.0, 0.9, 0.571]


def test_numbers_with_units(spark):
    cases = {
        "in 1990 it had 12 km": (12.0, "km"), "about 3 houses, 40 kg": (40.0, "kg"), "12.5 ft 2 in": (12.5 + 2 / 12, "ft"), "€ 3.5 million": (3.5e6, "€"), "{{convert|12|km|mi|abbr=on}}": (12.0, "km"), "{{height|ft=5|in=11}}": (5 + 11 / 12, "ft"),
        "{{height|m=1.75}}": (1.75, "m"), "2.5 million m2": (2.5e6, "m2"), "1990": None, "": None, "no number": None, None: None,
    }
    got = read(spark, V.value_with_unit, list(cases))
    assert [x if x is None else (round(x[0], 6), x[1]) for x in got] == [x if x is None else (round(x[0], 6), x[1]) for x in cases.values()]
    assert read(spark, V.value_with_unit, ["war 1.234,5 km lang", "2,5 Millionen m"], lang="de") == [(1234.5, "km"), (2.5e6, "m")]


@pytest.mark.parametrize(
    "lang, text, seconds",
    [("de", "2 Stunden 30 Minuten", 9000.0), ("fr", "1 heure 5 minutes", 3900.0), ("es", "3 días", 259200.0), ("it", "2 ore", 7200.0), ("pt", "10 minutos", 600.0), ("nl", "2 uur", 7200.0), ("pl", "5 godzin", 18000.0), ("ru", "3 дня", 259200.0), ("en", "1.5 hours", 5400.0), ("de", "1,5 Stunden", 5400.0)],
)
def test_durations_in_languages(spark, lang, text, seconds):
    assert read(spark, V.parse_duration, [text], lang=lang) == [seconds]


@pytest.mark.parametrize("lang, yes, no", [("it", "vero", "falso"), ("pl", "tak", "nie"), ("ru", "да", "нет"), ("pt", "sim", "não"), ("xx", "yes", "no")])
def test_truth_in_languages(spark, lang, yes, no):
    assert read(spark, V.parse_boolean, [yes, no, "?"], lang=lang) == [True, False, None]


def test_years_are_read_strictly(spark):
    """A number in words is no year; a year is."""
    df = spark.createDataFrame([(x,) for x in ("Customer 148", "1990", "44 BC", "May 1990")], "x string").select(V.Cascade().typed(F.col("x")).alias("v"))
    assert [(r.v.value, r.v.datatype.rpartition("#")[2]) for r in df.collect()] == [("Customer 148", "langString"), ("1990", "gYear"), ("-0044", "gYear"), ("1990-05", "gYearMonth")]
