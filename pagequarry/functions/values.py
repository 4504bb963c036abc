"""Typed readings of text: numbers, truth values, dates, durations, units, coordinates, flags.

Every reader is a column expression that is null where the text has no such value.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.model import LANG_STRING, XSD

#: Words of scale by language, and the zeros that they stand for.
SCALES = {
    "en": {"thousand": 3, "million": 6, "mio": 6, "mln": 6, "billion": 9, "bln": 9, "trillion": 12, "quadrillion": 15},
    "de": {"tausend": 3, "million": 6, "millionen": 6, "mio": 6, "milliarde": 9, "milliarden": 9, "mrd": 9, "billion": 12, "billionen": 12},
    "fr": {"mille": 3, "million": 6, "millions": 6, "milliard": 9, "milliards": 9, "billion": 12},
    "es": {"mil": 3, "millón": 6, "millones": 6, "millardo": 9, "billón": 12, "billones": 12},
    "it": {"mila": 3, "milione": 6, "milioni": 6, "miliardo": 9, "miliardi": 9},
    "pt": {"mil": 3, "milhão": 6, "milhões": 6, "bilhão": 9, "bilhões": 9, "trilhão": 12, "trilhões": 12},
    "nl": {"duizend": 3, "miljoen": 6, "mln": 6, "miljard": 9, "mld": 9, "biljoen": 12},
    "pl": {"tysiąc": 3, "tysiące": 3, "tysięcy": 3, "tys": 3, "milion": 6, "miliony": 6, "milionów": 6, "mln": 6, "miliard": 9, "miliardy": 9, "miliardów": 9, "mld": 9},
    "ru": {"тысяча": 3, "тысячи": 3, "тысяч": 3, "тыс": 3, "миллион": 6, "миллиона": 6, "миллионов": 6, "млн": 6, "миллиард": 9, "миллиарда": 9, "миллиардов": 9, "млрд": 9},
    "sv": {"tusen": 3, "miljon": 6, "miljoner": 6, "mn": 6, "miljard": 9, "miljarder": 9},
    "cs": {"tisíc": 3, "tisíce": 3, "milion": 6, "miliony": 6, "milionů": 6, "mil": 6, "miliarda": 9, "miliardy": 9, "miliard": 9, "mld": 9},
    "tr": {"bin": 3, "milyon": 6, "milyar": 9, "trilyon": 12},
}
#: Languages in which a comma marks decimals.
COMMA_DECIMALS = ("de", "fr", "es", "it", "pt", "nl", "pl", "ru", "sv", "cs", "tr", "el", "hu")

#: The months by language.
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "it": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
    "nl": "januari februari maart april mei juni juli augustus september oktober november december",
    "pl": "stycznia lutego marca kwietnia maja czerwca lipca sierpnia września października listopada grudnia",
    "ru": "января февраля марта апреля мая июня июля августа сентября октября ноября декабря",
    "sv": "januari februari mars april maj juni juli augusti september oktober november december",
    "cs": "ledna února března dubna května června července srpna září října listopadu prosince",
    "tr": "ocak şubat mart nisan mayıs haziran temmuz ağustos eylül ekim kasım aralık",
    "el": "ιανουαρίου φεβρουαρίου μαρτίου απριλίου μαΐου ιουνίου ιουλίου αυγούστου σεπτεμβρίου οκτωβρίου νοεμβρίου δεκεμβρίου",
    "hu": "január február március április május június július augusztus szeptember október november december",
}
BEFORE_CHRIST = r"(?:BCE|BC|B\.C\.|v\. ?Chr\.|av\. ?J\.-C\.|a\. ?C\.|p\.n\.e\.|до н\. ?э\.|f\.Kr\.|př\. ?n\. ?l\.|π\.Χ\.)"

#: (dimension, unit, labels, factor, offset): standard value = (value + offset) * factor; without a factor there is no conversion.
UNITS: list[tuple[str, str, tuple[str, ...], float | None, float]] = [
    ("Length", "metre", ("m", "metre", "meter", "metres", "meters"), 1.0, 0.0),
    ("Length", "kilometre", ("km", "kilometre", "kilometer", "kilometres", "kilometers"), 1000.0, 0.0),
    ("Length", "centimetre", ("cm", "centimetre", "centimeter"), 0.01, 0.0),
    ("Length", "millimetre", ("mm", "millimetre", "millimeter"), 0.001, 0.0),
    ("Length", "mile", ("mi", "mile", "miles"), 1609.344, 0.0),
    ("Length", "foot", ("ft", "foot", "feet"), 0.3048, 0.0),
    ("Length", "inch", ("in", "inch", "inches"), 0.0254, 0.0),
    ("Length", "yard", ("yd", "yard", "yards"), 0.9144, 0.0),
    ("Mass", "gram", ("g", "gram", "grams"), 1.0, 0.0),
    ("Mass", "kilogram", ("kg", "kilogram", "kilograms"), 1000.0, 0.0),
    ("Mass", "milligram", ("mg",), 0.001, 0.0),
    ("Mass", "tonne", ("t", "tonne", "tonnes"), 1e6, 0.0),
    ("Mass", "pound", ("lb", "lbs", "pound", "pounds"), 453.59237, 0.0),
    ("Mass", "ounce", ("oz", "ounce", "ounces"), 28.349523125, 0.0),
    ("Time", "second", ("s", "sec", "second", "seconds"), 1.0, 0.0),
    ("Time", "minute", ("min", "minute", "minutes"), 60.0, 0.0),
    ("Time", "hour", ("h", "hr", "hour", "hours"), 3600.0, 0.0),
    ("Time", "day", ("d", "day", "days"), 86400.0, 0.0),
    ("Area", "squareMetre", ("m2", "m²", "sqm"), 1.0, 0.0),
    ("Area", "squareKilometre", ("km2", "km²", "sqkm"), 1e6, 0.0),
    ("Area", "hectare", ("ha", "hectare", "hectares"), 1e4, 0.0),
    ("Area", "acre", ("acre", "acres"), 4046.8564224, 0.0),
    ("Area", "squareMile", ("sqmi", "mi2", "mi²"), 2589988.110336, 0.0),
    ("Volume", "cubicMetre", ("m3", "m³"), 1.0, 0.0),
    ("Volume", "litre", ("l", "litre", "liter", "litres", "liters"), 0.001, 0.0),
    ("Speed", "metrePerSecond", ("m/s",), 1.0, 0.0),
    ("Speed", "kilometrePerHour", ("km/h", "kmh", "kph"), 1 / 3.6, 0.0),
    ("Speed", "milePerHour", ("mph",), 0.44704, 0.0),
    ("Speed", "knot", ("kn", "knot", "knots"), 1852 / 3600, 0.0),
    ("Temperature", "kelvin", ("K", "kelvin"), 1.0, 0.0),
    ("Temperature", "degreeCelsius", ("°C", "celsius"), 1.0, 273.15),
    ("Temperature", "degreeFahrenheit", ("°F", "fahrenheit"), 5 / 9, 459.67),
    ("Power", "watt", ("W", "watt"), 1.0, 0.0),
    ("Power", "kilowatt", ("kW", "kilowatt"), 1000.0, 0.0),
    ("Power", "megawatt", ("MW", "megawatt"), 1e6, 0.0),
    ("Power", "horsepower", ("hp", "horsepower"), 745.69987158227022, 0.0),
    ("Energy", "joule", ("J", "joule"), 1.0, 0.0),
    ("Energy", "kilojoule", ("kJ",), 1000.0, 0.0),
    ("Energy", "kilowattHour", ("kWh",), 3.6e6, 0.0),
    ("Force", "newton", ("N", "newton"), 1.0, 0.0),
    ("Frequency", "hertz", ("Hz", "hertz"), 1.0, 0.0),
    ("Frequency", "kilohertz", ("kHz",), 1e3, 0.0),
    ("Frequency", "megahertz", ("MHz",), 1e6, 0.0),
    ("Pressure", "pascal", ("Pa", "pascal"), 1.0, 0.0),
    ("Pressure", "bar", ("bar",), 1e5, 0.0),
    ("Voltage", "volt", ("V", "volt", "volts"), 1.0, 0.0),
    ("ElectricCurrent", "ampere", ("A", "ampere", "amp"), 1.0, 0.0),
    ("InformationUnit", "byte", ("B", "byte", "bytes"), 1.0, 0.0),
    ("InformationUnit", "kilobyte", ("kB", "KB"), 1e3, 0.0),
    ("InformationUnit", "megabyte", ("MB",), 1e6, 0.0),
    ("InformationUnit", "gigabyte", ("GB",), 1e9, 0.0),
    ("Density", "kilogramPerCubicMetre", ("kg/m3", "kg/m³"), 1.0, 0.0),
    ("Density", "gramPerCubicCentimetre", ("g/cm3", "g/cm³"), 1000.0, 0.0),
    ("FlowRate", "cubicMetrePerSecond", ("m3/s", "m³/s"), 1.0, 0.0),
    ("FuelEfficiency", "litrePer100Kilometres", ("l/100km",), None, 0.0),
    ("PopulationDensity", "inhabitantsPerSquareKilometre", ("/km2", "/km²"), 1.0, 0.0),
    ("Torque", "newtonMetre", ("Nm", "N·m"), 1.0, 0.0),
    ("LinearMassDensity", "gramPerMetre", ("g/m",), 1.0, 0.0),
    ("Ratio", "percent", ("%", "percent"), 1.0, 0.0),
    ("Currency", "euro", ("€", "EUR", "euro", "euros"), None, 0.0),
    ("Currency", "usDollar", ("$", "USD", "dollar", "dollars"), None, 0.0),
    ("Currency", "poundSterling", ("£", "GBP"), None, 0.0),
]


def unit_table(spark: SparkSession) -> DataFrame:
    """dimension, unit, label, factor, offset: a row for each label."""
    rows = [(d, u, label, f, o) for d, u, labels, f, o in UNITS for label in labels]
    return spark.createDataFrame(rows, "dimension string, unit string, label string, factor double, offset double")


def convert_units(df: DataFrame, value: str, unit: str, units: DataFrame) -> DataFrame:
    """df with dimension, unit_name and standard_value: by the label as written, else in lower case; null without a conversion."""
    known = units.dropDuplicates(["label"]).select(*[F.col(c).alias(f"unit__{c}") for c in ("dimension", "unit", "label", "factor", "offset")])
    plain = known.select(*[F.col(c).alias(c.replace("unit__", "lower__")) for c in known.columns])
    found = df.join(F.broadcast(known), F.col(unit) == F.col("unit__label"), "left")
    found = found.join(F.broadcast(plain), F.col("unit__label").isNull() & (F.lower(unit) == F.col("lower__label")), "left")
    either = lambda c: F.coalesce(f"unit__{c}", f"lower__{c}")
    out = found.withColumn("dimension", either("dimension")).withColumn("unit_name", either("unit")).withColumn("standard_value", (F.col(value) + either("offset")) * either("factor"))
    return out.drop(*known.columns, *plain.columns)


def number_text(x: Column, lang: str = "en") -> Column:
    """The first number of a text as digits with a point, sign included; separators of thousands go."""
    sign = r"[-−–—]?\s?"
    if lang in COMMA_DECIMALS:
        raw = F.regexp_extract(x, rf"({sign}\d+(?:[.\u00a0\u202f ]\d{{3}})*(?:,\d+)?)", 1)
        plain = F.replace(F.regexp_replace(raw, r"[.\u00a0\u202f ]", ""), F.lit(","), F.lit("."))
    else:
        raw = F.regexp_extract(x, rf"({sign}(?:\d+(?:,\d{{3}})*(?:\.\d+)?|\.\d+))", 1)
        plain = F.regexp_replace(raw, r"[,\s]", "")
    plain = F.regexp_replace(plain, "[−–—]", "-")
    return F.nullif(plain, F.lit(""))


def scale_zeros(x: Column, lang: str = "en") -> Column:
    """Zeros that a word of scale after the first number adds; 0 without one."""
    words = F.create_map(*[F.lit(v) for kv in SCALES.get(lang, SCALES["en"]).items() for v in kv])
    return F.coalesce(F.try_element_at(words, F.lower(F.regexp_extract(x, r"\d\s*([\p{L}]+)", 1))), F.lit(0))


def parse_double(x: Column, lang: str = "en") -> Column:
    return number_text(x, lang).try_cast("double") * F.pow(F.lit(10.0), scale_zeros(x, lang))


INTEGER_RANGES = {"integer": None, "positiveInteger": (1, None), "nonNegativeInteger": (0, None), "nonPositiveInteger": (None, 0), "negativeInteger": (None, -1)}


def parse_integer(x: Column, lang: str = "en", kind: str = "integer", factor: float = 1.0) -> Column:
    """The first number, scaled and rounded; null outside the subtype's range."""
    low, high = INTEGER_RANGES[kind] or (None, None)

    def inside(n: Column) -> Column:
        ok = F.lit(True)
        if low is not None:
            ok = ok & (n >= low)
        if high is not None:
            ok = ok & (n <= high)
        return F.when(ok, n)

    return let(F.round(parse_double(x, lang) * factor).cast("long"), inside)


#: Words for true and false by language; languages without any have those of English.
TRUE_WORDS = {"en": "true|yes", "de": "wahr|ja|true", "fr": "vrai|oui|true", "es": "verdadero|s[ií]|true", "it": "vero|s[iì]|true", "pt": "verdadeiro|sim|true", "nl": "waar|ja|true", "pl": "prawda|tak|true", "ru": "истина|да|true", "sv": "sant|ja|true", "cs": "pravda|ano|true", "tr": "doğru|evet|true", "el": "αληθές|ναι|true"}
FALSE_WORDS = {"en": "false|no", "de": "falsch|nein|false", "fr": "faux|non|false", "es": "falso|no|false", "it": "falso|no|false", "pt": "falso|n[aã]o|false", "nl": "onwaar|nee|false", "pl": "fałsz|nie|false", "ru": "ложь|нет|false", "sv": "falskt|nej|false", "cs": "nepravda|ne|false", "tr": "yanlış|hayır|false", "el": "ψευδές|όχι|false"}


def parse_boolean(x: Column, lang: str = "en") -> Column:
    """Words for false are tried first."""
    word = lambda w: F.lower(x).rlike(rf"(?:^|[^\p{{L}}])(?:{w})(?:$|[^\p{{L}}])")
    return F.when(word(FALSE_WORDS.get(lang, FALSE_WORDS["en"])), F.lit(False)).when(word(TRUE_WORDS.get(lang, TRUE_WORDS["en"])), F.lit(True))


def parse_enumeration(x: Column, literals: dict[str, tuple[str, ...]]) -> Column:
    """The first literal of which the name or a keyword occurs as a word, whatever the case."""
    out = F.lit(None).cast("string")
    for name, words in reversed(literals.items()):
        pattern = "|".join(map(_quote, (name, *words)))
        out = F.when(F.lower(x).rlike(rf"(?:^|[^\p{{L}}\p{{N}}])(?:{pattern})(?:$|[^\p{{L}}\p{{N}}])"), name).otherwise(out)
    return out


def _quote(x: str) -> str:
    import re

    return re.escape(x.lower())


# --- partial dates ---------------------------------------------------------------------------

DATE_TYPE = "struct<y: int, m: int, d: int, type: string>"


def let(x: Column, body) -> Column:  # noqa: ANN001
    """body(x) with x evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(x), body), 1)


def with_once(df: DataFrame, name: str, x: Column) -> DataFrame:
    """df with a column that is evaluated once a row: a filter by it stays above, where Spark would evaluate x for the filter and again for the column."""
    return df.select("*", F.explode(F.array(x)).alias(name))


def month_table(lang: str) -> Column:
    """Numbers of months by their names, and by their first three letters where no other begins so."""
    names = MONTHS.get(lang, MONTHS["en"]).split()
    known = {name: k for k, name in enumerate(names, 1)}
    known |= {name[:3]: k for k, name in enumerate(names, 1) if sum(n[:3] == name[:3] for n in names) == 1}
    return F.expr("map(" + ", ".join(f"'{name}', {k}" for name, k in known.items()) + ")")


def month_number(word: Column, lang: str, table: Column | None = None) -> Column:
    """1 to 12 by the name of a month."""
    return F.try_element_at(month_table(lang) if table is None else table, F.lower(F.regexp_replace(word, r"\.$", "")))


def _dated(c: Column) -> Column:
    """The partial date of a struct of y, m and d."""
    y, m, d = c["y"], c["m"], c["d"]
    kind = (
        F.when(y.isNotNull() & m.isNotNull() & d.isNotNull(), XSD + "date")
        .when(y.isNotNull() & m.isNotNull(), XSD + "gYearMonth")
        .when(y.isNotNull() & d.isNull(), XSD + "gYear")
        .when(y.isNull() & m.isNotNull() & d.isNotNull(), XSD + "gMonthDay")
        .when(y.isNull() & m.isNotNull(), XSD + "gMonth")
        .when(y.isNull() & m.isNull() & d.isNotNull(), XSD + "gDay")
    )
    last = F.when(m.isin(4, 6, 9, 11), 30).when(m == 2, F.when(y.isNull() | ((y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))), 29).otherwise(28)).otherwise(31)
    fine = F.coalesce(m.between(1, 12), F.lit(True)) & F.coalesce(d.between(1, F.coalesce(last, F.lit(31))), F.lit(True)) & F.coalesce(y != 0, F.lit(True))
    return F.when(fine & (y.isNotNull() | m.isNotNull() | d.isNotNull()), F.struct(y.alias("y"), m.alias("m"), d.alias("d"), kind.alias("type")))


def _parts(y: Column | None, m: Column | None, d: Column | None) -> Column:
    parts = {"y": y, "m": m, "d": d}
    return F.struct(*[(F.lit(None) if c is None else c).try_cast("int").alias(k) for k, c in parts.items()])


def partial_date(y: Column | None = None, m: Column | None = None, d: Column | None = None) -> Column:
    """y, m, d and the type that the parts present make; null if they make none or aren't a date."""
    return let(_parts(y, m, d), lambda c: let(_dated(c), lambda p: F.when(p["type"].isNotNull(), p)))


def parse_date(x: Column, lang: str = "en") -> Column:
    """A partial date: ISO, day month year, month day year, numeric, month year, month day, year; years before Christ are negative."""

    def read(x: Column) -> Column:
        g = lambda p, k: F.nullif(F.regexp_extract(x, p, k), F.lit(""))
        era = F.when(x.rlike(rf"\d\s*{BEFORE_CHRIST}"), -1).otherwise(1)
        year = lambda c: c.try_cast("int") * era
        table = month_table(lang)
        month = lambda p, k: month_number(g(p, k), lang, table)
        name = r"(\p{L}{3,}\.?)"
        iso = r"(?<!\d)(-?\d{4})-(\d{1,2})-(\d{1,2})(?!\d)"
        dmy = rf"(?<!\d)(\d{{1,2}})(?:st|nd|rd|th|er|\.)?\s*(?:de\s+)?{name},?\s*(?:de\s+|del\s+)?(\d{{1,4}})(?!\d)"
        mdy = rf"{name}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{3,4}})(?!\d)"
        num = r"(?<!\d)(\d{1,2})[./](\d{1,2})[./](\d{4})(?!\d)"
        my = rf"{name},?\s+(?:de\s+|of\s+)?(\d{{3,4}})(?!\d)"
        dm = rf"(?<!\d)(\d{{1,2}})(?:st|nd|rd|th|er|\.)?\s*(?:of\s+|de\s+)?{name}"
        md = rf"{name}\s+(\d{{1,2}})(?:st|nd|rd|th)?(?!\d)"
        y = r"(?<![\d.,])(\d{3,4})(?![\d.,]\d|\d)"
        first, second = (2, 1) if lang == "en" else (1, 2)
        of_my, of_dm, of_md = month(my, 1), month(dm, 2), month(md, 1)
        found = (
            _parts(g(iso, 1), g(iso, 2), g(iso, 3)),
            _parts(year(g(dmy, 3)), month(dmy, 2), g(dmy, 1)),
            _parts(year(g(mdy, 3)), month(mdy, 1), g(mdy, 2)),
            _parts(g(num, 3), g(num, second), g(num, first)),
            _parts(F.when(of_my.isNotNull(), year(g(my, 2))), of_my, None),
            _parts(None, of_dm, F.when(of_dm.isNotNull(), g(dm, 1))),
            _parts(None, of_md, F.when(of_md.isNotNull(), g(md, 2))),
            _parts(year(F.coalesce(g(y, 1), F.when(x.rlike(rf"\d\s*{BEFORE_CHRIST}"), g(r"(\d{1,4})", 1)))), None, None),
        )

        def usable(parts: Column) -> Column:
            """Parts that make a kind of date: some, and not a day of a year without its month."""
            return let(parts, lambda c: F.when(c["m"].isNotNull() | (c["y"].isNotNull() != c["d"].isNotNull()), c))

        # One after another: what an earlier form reads, later ones needn't look at. A full date that
        # can't be (31 February) is none; it isn't read as its year.
        return let(F.coalesce(*map(usable, found)), _dated)

    return let(x, read)


def date_text(d: Column) -> Column:
    """The lexical form of a partial date under its type."""
    y = F.when(d["y"] < 0, F.concat(F.lit("-"), F.lpad((-d["y"]).cast("string"), 4, "0"))).otherwise(F.lpad(d["y"].cast("string"), 4, "0"))
    m, day = F.lpad(d["m"].cast("string"), 2, "0"), F.lpad(d["d"].cast("string"), 2, "0")
    kind = F.substring(d["type"], len(XSD) + 1, 20)
    return (
        F.when(kind == "date", F.concat_ws("-", y, m, day)).when(kind == "gYearMonth", F.concat_ws("-", y, m)).when(kind == "gYear", y)
        .when(kind == "gMonthDay", F.concat(F.lit("--"), m, F.lit("-"), day)).when(kind == "gMonth", F.concat(F.lit("--"), m)).when(kind == "gDay", F.concat(F.lit("---"), day))
    )


def combine_dates(*dates: Column) -> Column:
    """One date of the first year, the first month and the first day that are defined."""
    first = lambda ds, p: F.try_element_at(F.filter(F.transform(ds, lambda d: d[p]), lambda v: v.isNotNull()), F.lit(1))
    return let(F.array(*dates), lambda ds: partial_date(first(ds, "y"), first(ds, "m"), first(ds, "d")))


#: Words of open and closed intervals by language; languages without any have those of English.
PRESENT = {"en": "present|now", "de": "heute", "fr": "aujourd.hui|pr[ée]sent", "es": "presente|actualidad", "it": "oggi|presente", "pt": "presente|atualmente|hoje", "nl": "heden", "pl": "obecnie|dziś", "ru": "настоящее|н\\. ?в\\.", "sv": "nu|idag", "cs": "dosud|současnost", "tr": "günümüz"}
SINCE = {"en": "since|onwards?", "de": "seit|ab", "fr": "depuis", "es": "desde", "it": "dal|da", "pt": "desde", "nl": "sinds", "pl": "od", "ru": "с", "sv": "sedan", "cs": "od", "tr": "beri"}
UNTIL = {"en": "to|until", "de": "bis", "fr": "[àa]", "es": "hasta|a", "it": "al|a|fino", "pt": "a|até", "nl": "tot", "pl": "do", "ru": "по|до", "sv": "till", "cs": "do", "tr": "ile"}


def parse_date_interval(x: Column, lang: str = "en") -> Column:
    """start and end: "a – b", "a to b", "a – present" and "since a" (open end), one date (both), a reversed pair (start only)."""
    pattern = rf"\s*[-−–—]+\s*(?!\d{{2}}\b)|\s+(?:{UNTIL.get(lang, UNTIL['en'])})\s+|(?<=\d{{4}})[-−–—](?=\d{{4}})"
    none = F.lit(None).cast(DATE_TYPE)
    sortable = lambda d: d["y"] * 10000 + F.coalesce(d["m"], F.lit(0)) * 100 + F.coalesce(d["d"], F.lit(0))

    def read(t: Column) -> Column:
        a, b, open_ = t["dates"][0], F.get(t["dates"], F.lit(1)), t["open"]
        end = F.when(open_, none).when(F.size(t["dates"]) == 1, a).when(sortable(b) >= sortable(a), b)
        return F.when(a.isNotNull(), F.struct(a.alias("start"), end.alias("end")))

    dates = F.transform(F.slice(F.split(x, pattern), 1, 2), lambda p: parse_date(p, lang))
    open_ = x.rlike(rf"(?i)(?<!\p{{L}})(?:{PRESENT.get(lang, PRESENT['en'])}|{SINCE.get(lang, SINCE['en'])})(?!\p{{L}})")
    return let(F.struct(dates.alias("dates"), open_.alias("open")), read)


def _day_number(y: Column, m: Column, d: Column, gregorian_rule: bool) -> Column:
    def number(t: Column) -> Column:
        yy, mm = t["y"], t["m"]
        leap = F.floor(yy / 4) - F.floor(yy / 100) + F.floor(yy / 400) - 32045 if gregorian_rule else F.floor(yy / 4) - 32083
        return t["d"] + F.floor((153 * mm + 2) / 5) + 365 * yy + leap

    a = F.floor((14 - m) / 12)
    return let(F.struct((y + 4800 - a).alias("y"), (m + 12 * a - 3).alias("m"), d.alias("d")), number)


def julian_day(y: Column, m: Column, d: Column) -> Column:
    """Day number of a Gregorian date."""
    return _day_number(y, m, d, True)


def julian_calendar_day(y: Column, m: Column, d: Column) -> Column:
    """Day number of a date in the Julian calendar."""
    return _day_number(y, m, d, False)


def gregorian(day: Column) -> Column:
    """y, m, d of a day number."""
    cycle = lambda a: let(F.floor((4 * a + 3) / 146097), lambda b: F.struct(b.alias("b"), (a - F.floor(146097 * b / 4)).alias("c")))

    def in_cycle(t: Column) -> Column:
        e = F.floor((4 * t["c"] + 3) / 1461)
        return let(e, lambda e: let(t["c"] - F.floor(1461 * e / 4), lambda f: let(F.floor((5 * f + 2) / 153), lambda g: F.struct(
            (100 * t["b"] + e - 4800 + F.floor(g / 10)).cast("int").alias("y"), (g + 3 - 12 * F.floor(g / 10)).cast("int").alias("m"), (f - F.floor((153 * g + 2) / 5) + 1).cast("int").alias("d")))))

    return let(day + 32044, lambda a: let(cycle(a), in_cycle))


def julian_to_gregorian(y: Column, m: Column, d: Column) -> Column:
    return gregorian(julian_calendar_day(y, m, d))


def ethiopian_to_gregorian(y: Column, m: Column, d: Column) -> Column:
    return gregorian(F.lit(1724221) + 365 * (y - 1) + F.floor(y / 4) + 30 * (m - 1) + d - 1)


GEEZ = {c: n for n, c in enumerate("፩፪፫፬፭፮፯፰፱", 1)} | {c: 10 * n for n, c in enumerate("፲፳፴፵፶፷፸፹፺", 1)}


def geez_number(x: Column) -> Column:
    """The number that Ge'ez numerals write: pairs of tens and units, times hundred (፻) and ten thousand (፼)."""
    value = F.create_map(*[F.lit(v) for kv in GEEZ.items() for v in kv])
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("part"))

    def step(acc: Column, c: Column) -> Column:
        n = F.coalesce(value[c], F.lit(0)).cast("long")
        one = F.when(acc["part"] == 0, 1).otherwise(acc["part"])
        total = F.when(c == "፻", acc["total"] + one * 100).when(c == "፼", F.when(acc["total"] + acc["part"] == 0, 1).otherwise(acc["total"] + acc["part"]) * 10000).otherwise(acc["total"])
        return F.struct(total.cast("long").alias("total"), F.when(c.isin("፻", "፼"), F.lit(0)).otherwise(acc["part"] + n).cast("long").alias("part"))

    letters = F.filter(F.split(F.trim(x), ""), lambda c: c != "")
    return F.when(F.trim(x).rlike("^[፩-፼]+$"), F.aggregate(letters, start, step, lambda acc: acc["total"] + acc["part"]).cast("int"))


# --- durations, units, coordinates --------------------------------------------------------------

#: Words for units of time by language, and seconds.
DURATION_WORDS: dict[str, dict[int, str]] = {
    "en": {1: "second seconds sec secs s", 60: "minute minutes min mins m", 3600: "hour hours hr hrs h", 86400: "day days d", 604800: "week weeks", 2628000: "month months", 31536000: "year years yr yrs"},
    "de": {1: "sekunde sekunden sek s", 60: "minute minuten min", 3600: "stunde stunden std h", 86400: "tag tage tagen", 604800: "woche wochen", 2628000: "monat monate monaten", 31536000: "jahr jahre jahren"},
    "fr": {1: "seconde secondes sec s", 60: "minute minutes min mn", 3600: "heure heures h", 86400: "jour jours j", 604800: "semaine semaines", 2628000: "mois", 31536000: "an ans année années"},
    "es": {1: "segundo segundos seg s", 60: "minuto minutos min", 3600: "hora horas h", 86400: "día días", 604800: "semana semanas", 2628000: "mes meses", 31536000: "año años"},
    "it": {1: "secondo secondi sec s", 60: "minuto minuti min", 3600: "ora ore h", 86400: "giorno giorni", 604800: "settimana settimane", 2628000: "mese mesi", 31536000: "anno anni"},
    "pt": {1: "segundo segundos seg s", 60: "minuto minutos min", 3600: "hora horas h", 86400: "dia dias", 604800: "semana semanas", 2628000: "mês meses", 31536000: "ano anos"},
    "nl": {1: "seconde seconden sec s", 60: "minuut minuten min", 3600: "uur uren u", 86400: "dag dagen", 604800: "week weken", 2628000: "maand maanden", 31536000: "jaar jaren"},
    "pl": {1: "sekunda sekundy sekund s", 60: "minuta minuty minut min", 3600: "godzina godziny godzin h", 86400: "dzień dni", 604800: "tydzień tygodnie tygodni", 2628000: "miesiąc miesiące miesięcy", 31536000: "rok lata lat"},
    "ru": {1: "секунда секунды секунд сек с", 60: "минута минуты минут мин", 3600: "час часа часов ч", 86400: "день дня дней", 604800: "неделя недели недель", 2628000: "месяц месяца месяцев", 31536000: "год года лет"},
}


def parse_duration(x: Column, lang: str = "en") -> Column:
    """Seconds: h:mm:ss, m:ss, or numbers with units of time, summed; a leading minus counts for all."""
    text = F.lower(F.trim(x))
    sign = F.when(text.rlike("^[-−]"), -1.0).otherwise(1.0)
    clock = F.transform(F.split(F.regexp_extract(text, r"^[-−]?(\d+(?::\d{1,2}){1,2}(?:\.\d+)?)", 1), ":"), lambda p: p.try_cast("double"))
    timed = F.aggregate(clock, F.lit(0.0), lambda acc, p: acc * 60 + p)
    words = {w: n for n, ws in DURATION_WORDS.get(lang, DURATION_WORDS["en"]).items() for w in ws.split()}
    units = F.create_map(*[F.lit(v) for kv in words.items() for v in kv])
    number = r"\d[\d.]*(?:,\d+)?" if lang in COMMA_DECIMALS else r"\d[\d,]*(?:\.\d+)?"
    pieces = F.regexp_extract_all(text, F.lit(rf"({number}\s*\p{{L}}+)"), 1)
    seconds = F.transform(pieces, lambda p: number_text(p, lang).try_cast("double") * F.try_element_at(units, F.regexp_extract(p, r"(\p{L}+)$", 1)))
    known = F.filter(seconds, lambda s: s.isNotNull())
    return F.when(text.rlike(r"^[-−]?\d+(?::\d{1,2}){1,2}"), sign * timed).when(F.size(known) > 0, sign * F.aggregate(known, F.lit(0.0), lambda acc, s: acc + s))


def without_unit_templates(x: Column) -> Column:
    """Templates of conversion and of height as plain text: {{convert|12|km|mi}} is 12 km, {{height|ft=5|in=11}} is 5 ft 11 in."""
    number = r"([-−]?[\d.,]+)"
    x = F.regexp_replace(x, rf"(?i)\{{\{{\s*(?:convert|cvt|unit)\s*\|\s*{number}\s*\|\s*([^|{{}}]+?)\s*(?:\|[^{{}}]*)?\}}\}}", "$1 $2")
    x = F.regexp_replace(x, rf"(?i)\{{\{{\s*height\s*\|(?:[^{{}}]*\|)?\s*(?:ft|feet)\s*=\s*{number}\s*\|\s*(?:in|inch)\s*=\s*{number}[^{{}}]*\}}\}}", "$1 ft $2 in")
    return F.regexp_replace(x, rf"(?i)\{{\{{\s*height\s*\|(?:[^{{}}]*\|)?\s*(m|cm|ft)\s*=\s*{number}[^{{}}]*\}}\}}", "$2 $1")


def value_with_unit(x: Column, lang: str = "en") -> Column:
    """value and the unit's label of the first number that a known unit follows (or a currency sign precedes); feet and inches add up; templates of conversion and height count as text."""
    labels = sorted({label for _, _, ls, _, _ in UNITS for label in ls}, key=len, reverse=True)
    digits = r"(?<![\d.,])[-−–—]?\s?(?:\d{1,3}(?:[.\u00a0\u202f ]\d{3})+|\d+)(?:,\d+)?" if lang in COMMA_DECIMALS else r"(?<![\d.,])[-−–—]?\s?(?:\d+(?:,\d{3})*(?:\.\d+)?|\.\d+)"
    scale = "|".join(sorted(SCALES.get(lang, SCALES["en"]), key=len, reverse=True))
    number = rf"({digits}(?:\s*(?i:{scale})\.?(?!\p{{L}}))?)"
    one = "|".join(f"{_exact(k)}(?:{'|'.join(_exact(x[1:]) for x in labels if x[0] == k)})" for k in dict.fromkeys(x[0] for x in labels))
    followed = rf"{number}\s*({one})(?![\p{{L}}\p{{N}}])"
    preceded = rf"([€$£])\s?{number}"
    inches = r"(\d+(?:\.\d+)?)\s*(?:feet|foot|ft|['′])\s*(\d+(?:\.\d+)?)\s*(?:inches|inch|in|[\"″])"

    def read(t: Column) -> Column:
        g = lambda p, k: F.nullif(F.regexp_extract(t, p, k), F.lit(""))
        make = lambda v, u: F.struct(v.cast("double").alias("value"), u.alias("unit"))
        return (
            F.when(t.rlike(inches), make(g(inches, 1).try_cast("double") + g(inches, 2).try_cast("double") / 12, F.lit("ft")))
            .when(t.rlike("[€$£]") & t.rlike(preceded), make(parse_double(g(preceded, 2), lang), g(preceded, 1)))
            # The text is searched once: number and unit part alike in what was found.
            .otherwise(let(g(followed, 0), lambda m: F.when(m.isNotNull(), make(parse_double(F.regexp_extract(m, rf"^{number}\s*({one})\z", 1), lang), F.regexp_extract(m, rf"^{number}\s*({one})\z", 2)))))
        )

    return let(F.when(F.contains(x, F.lit("{{")), without_unit_templates(x)).otherwise(x), lambda t: let(read(t), lambda u: F.when(u["value"].isNotNull(), u)))


def _exact(x: str) -> str:
    import re

    return re.escape(x)


def dms(d: Column, m: Column, s: Column, hemisphere: Column) -> Column:
    """Degrees of degrees, minutes, seconds and a hemisphere; missing minutes and seconds are 0."""
    size = d.try_cast("double") + F.coalesce(F.nullif(m, F.lit("")).try_cast("double"), F.lit(0.0)) / 60 + F.coalesce(F.nullif(s, F.lit("")).try_cast("double"), F.lit(0.0)) / 3600
    return F.when(F.upper(hemisphere).isin("S", "W"), -size).when(F.upper(hemisphere).isin("N", "E", "O"), size)


def parse_single_coordinate(x: Column) -> Column:
    """dd/mm/ss/H, dd/mm/H or dd/H."""
    p = r"^\s*(\d+(?:\.\d+)?)/(?:(\d+(?:\.\d+)?)/)?(?:(\d+(?:\.\d+)?)/)?([NSEWOnsewo])\s*$"
    g = lambda k: F.regexp_extract(x, p, k)
    return F.when(x.rlike(p), dms(g(1), g(2), g(3), g(4)))


def parse_coordinates(x: Column) -> Column:
    """lat and lon of a coordinate template, of degrees, minutes and seconds in a text, or of two decimals; null out of range."""
    part = r"(\d{1,3}(?:\.\d+)?)\s*[°º]\s*(?:(\d{1,2}(?:\.\d+)?)\s*[′'’]\s*)?(?:(\d{1,2}(?:\.\d+)?)\s*[″\"”]\s*)?"
    text = part + r"([NS])[\s,;]*" + part + r"([EWO])"
    piece = r"(\d+(?:\.\d+)?)\|(?:(\d+(?:\.\d+)?)\|)?(?:(\d+(?:\.\d+)?)\|)?"
    template = r"(?i:\{\{coord\|)" + piece + r"([NS])\|" + piece + r"([EWO])"
    plain = r"(?:(?i:\{\{coord\|)|^\s*)(-?\d{1,3}\.\d+)\s*[|,;\s]\s*(-?\d{1,3}\.\d+)"
    g = lambda p, k: F.regexp_extract(x, p, k)
    eight = lambda p: F.struct(dms(g(p, 1), g(p, 2), g(p, 3), g(p, 4)).alias("lat"), dms(g(p, 5), g(p, 6), g(p, 7), g(p, 8)).alias("lon"))
    two = F.struct(g(plain, 1).try_cast("double").alias("lat"), g(plain, 2).try_cast("double").alias("lon"))
    found = F.when(x.rlike(template), eight(template)).when(x.rlike(text), eight(text)).when(x.rlike(plain), two)
    return let(found, lambda f: F.when(f["lat"].between(-90, 90) & f["lon"].between(-180, 360), f))


#: Codes of countries in flag templates.
FLAGS = {
    "DEU": "Germany", "GER": "Germany", "FRA": "France", "ESP": "Spain", "GBR": "United Kingdom", "UK": "United Kingdom", "USA": "United States", "ITA": "Italy", "AUT": "Austria", "CHE": "Switzerland", "SUI": "Switzerland", "NLD": "Netherlands", "NED": "Netherlands",
    "POL": "Poland", "RUS": "Russia", "JPN": "Japan", "CHN": "China", "BRA": "Brazil", "CAN": "Canada", "AUS": "Australia", "ARG": "Argentina", "BEL": "Belgium", "BGR": "Bulgaria", "BUL": "Bulgaria", "CHL": "Chile", "CHI": "Chile", "COL": "Colombia", "CUB": "Cuba",
    "CZE": "Czech Republic", "DNK": "Denmark", "DEN": "Denmark", "EGY": "Egypt", "EST": "Estonia", "ETH": "Ethiopia", "FIN": "Finland", "GRC": "Greece", "GRE": "Greece", "HRV": "Croatia", "CRO": "Croatia", "HUN": "Hungary", "IND": "India", "IDN": "Indonesia", "INA": "Indonesia",
    "IRL": "Ireland", "IRN": "Iran", "IRI": "Iran", "ISL": "Iceland", "ISR": "Israel", "JAM": "Jamaica", "KAZ": "Kazakhstan", "KEN": "Kenya", "KOR": "South Korea", "LTU": "Lithuania", "LUX": "Luxembourg", "LVA": "Latvia", "LAT": "Latvia", "MAR": "Morocco", "MEX": "Mexico",
    "MYS": "Malaysia", "MAS": "Malaysia", "NGA": "Nigeria", "NGR": "Nigeria", "NOR": "Norway", "NZL": "New Zealand", "PAK": "Pakistan", "PER": "Peru", "PHL": "Philippines", "PHI": "Philippines", "PRT": "Portugal", "POR": "Portugal", "ROU": "Romania", "SAU": "Saudi Arabia", "KSA": "Saudi Arabia",
    "SRB": "Serbia", "SVK": "Slovakia", "SVN": "Slovenia", "SLO": "Slovenia", "SWE": "Sweden", "THA": "Thailand", "TUN": "Tunisia", "TUR": "Turkey", "UKR": "Ukraine", "URY": "Uruguay", "URU": "Uruguay", "VEN": "Venezuela", "VNM": "Vietnam", "VIE": "Vietnam", "ZAF": "South Africa", "RSA": "South Africa",
}


def parse_flag(x: Column) -> Column:
    """The country of a flag template ({{flag|name}}, {{FRA}}, {{flagicon|FRA}})."""
    code = F.upper(F.coalesce(F.nullif(F.regexp_extract(x, r"\{\{([A-Z]{2,3})\}\}", 1), F.lit("")), F.regexp_extract(x, r"\{\{(?i:flag(?:icon|country|deco)?)\|([^|}]+)", 1)))
    known = F.create_map(*[F.lit(v) for kv in FLAGS.items() for v in kv])
    named = F.regexp_extract(x, r"\{\{(?i:flag(?:icon|country|deco)?)\|([^|}]+)", 1)
    return F.coalesce(F.try_element_at(known, code), F.when(named.rlike("^[A-Z][a-z]"), F.trim(named)))


def parse_string(x: Column) -> Column:
    """Text without small print, tags and emphasis; null if nothing is left."""
    x = F.regexp_replace(x, r"(?i)<small[^>]*>\(?([^<]*?)\)?</small>", "($1)")
    x = F.regexp_replace(F.regexp_replace(x, r"\{\{[^{}]*\}\}", ""), r"<[^>]*>", "")
    x = F.regexp_replace(F.replace(x, F.lit("&nbsp;"), F.lit(" ")), "'{2,5}", "")
    return F.nullif(F.trim(x), F.lit(""))


def parse_rank(x: Column) -> Column:
    """3rd, 21st."""
    return F.regexp_extract(x, r"^\s*(\d+)(?:st|nd|rd|th)\s*$", 1).try_cast("int")


@dataclass
class Cascade:
    """Readers in order of trust; the first that reads the whole value types it."""

    lang: str = "en"
    units: bool = True
    order: tuple[str, ...] = field(default=("unit", "date", "coordinate", "integer", "double", "rank", "object", "link", "string"))

    def typed(self, x: Column) -> Column:
        """value and datatype of a raw value; no datatype for resources."""
        seen = F.struct(
            x.alias("text"), parse_double(x, self.lang).alias("number"), scale_zeros(x, self.lang).alias("zeros"), value_with_unit(x, self.lang).alias("unit"),
            parse_date(x, self.lang).alias("date"), parse_single_coordinate(x).alias("coordinate"), parse_rank(x).alias("rank"), parse_string(x).alias("plain"),
        )
        return let(seen, self._first)

    def _first(self, t: Column) -> Column:
        x = t["text"]
        make = lambda v, kind: F.struct(v.cast("string").alias("value"), (F.lit(kind) if isinstance(kind, str) else kind).cast("string").alias("datatype"))
        linked = r"^\s*\[\[([^\]|#]+)(?:#[^\]|]*)?(?:\|[^\]]*)?\]\]\s*$"
        numeric = x.rlike(r"^\s*[-−–—]?[\d.,\u00a0 ]+(?:\s*\p{L}+\.?)?\s*$") & (x.rlike(r"^[^\p{L}]*$") | (t["zeros"] > 0))
        readers = {
            "unit": F.when(t["unit"].isNotNull() & x.rlike(r"^\s*[€$£]?\s?[\d.,]+\s*\S*\s*$"), make(t["unit"]["value"], t["unit"]["unit"])),
            "date": F.when(t["date"].isNotNull() & ((t["date"]["type"] != XSD + "gYear") | x.rlike(rf"^\s*-?\d{{1,4}}\s*(?:{BEFORE_CHRIST})?\s*$")) & x.rlike(r"(?i)^[\p{L}\d\s.,/\-]+$") & x.rlike(rf"\p{{L}}{{3}}|\d[-/.]\d|^\s*\d{{4}}\s*$|\d\s*{BEFORE_CHRIST}"), make(date_text(t["date"]), t["date"]["type"])),
            "coordinate": F.when(t["coordinate"].isNotNull(), make(t["coordinate"], XSD + "double")),
            "integer": F.when(numeric & (t["number"] == F.floor(t["number"])), make(t["number"].cast("long"), XSD + "integer")),
            "double": F.when(numeric & t["number"].isNotNull(), make(t["number"], XSD + "double")),
            "rank": F.when(t["rank"].isNotNull(), make(t["rank"], XSD + "integer")),
            "object": F.when(x.rlike(linked), make(F.trim(F.regexp_extract(x, linked, 1)), F.lit(None))),
            "link": F.when(x.rlike(r"^\s*\[?https?://\S+(?:\s[^\]]*)?\]?\s*$"), make(F.regexp_extract(x, r"(https?://[^\s\]]+)", 1), F.lit(None))),
            "string": F.when(t["plain"].isNotNull(), make(t["plain"], LANG_STRING)),
        }
        return F.coalesce(*[readers[k] for k in self.order if k != "unit" or self.units])
