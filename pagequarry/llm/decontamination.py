"""Benchmark decontamination by template windows, in DataFrame functions only.

Texts become sequences of words in which numbers (in digits or words), units that follow a number and
names (capitalised words that aren't function words, wherever they stand) are typed placeholders. Windows
of five words are hash-joined with those of the benchmark items, as templates and as plain words in lower
case, so an exact copy is found whatever stands around it. Items also offer windows in which only names
inside a sentence are placeholders, for first words that a document has in lower case. Matches of a
document with an item are gathered on diagonals (position in the document less position in the item).
Windows of equal words always count; of the others those don't count that hold an item value which has
several document values on the diagonal. So a question with other numbers or names is caught, while texts
that merely share a pattern are not.

An item leaks into a document if the windows that count cover at least CONTAINMENT of its windows, or
RUN of them stand in a row on a diagonal (13 words). Windows with fewer than MIN_LITERALS words that
aren't placeholders prove nothing as templates and match by equal words only; containment is the greater
of the share of all windows and the share of the others.

Each word is hashed once; a window's hash is that of its words' hashes. The windows of a text exist only
inside the stage that looks them up, so no more than the matches leave it.

Defined results: a null text counts as empty and leaks nothing; a text of fewer than five words is one
window, the whole of it, and an item that short is also found word for word anywhere in a longer text; an
item without words leaks nowhere; texts of any length are read whole; repeated rows get a result each time
if they differ in id, and one if they don't; null item ids are an id; an empty table of documents or of
items gives no rows; extra columns aren't read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.llm._common import fresh, row_key, text_col

WIDTH = 5
CONTAINMENT = 0.8
RUN = 9
MIN_LITERALS = 2
#: Windows of the benchmark that are broadcast at most; with more of them both sides are shuffled.
BROADCAST_WINDOWS = 500_000

NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
UNITS = """km m cm mm mile miles feet ft inch inches kg g mg lb lbs pound pounds ounce ounces ton tons l ml liter liters litre litres s ms sec second
seconds min minute minutes h hr hrs hour hours day days week weeks month months year years mph kmh percent dollar dollars euro euros cent cents usd eur
gb mb kb tb hz khz mhz ghz w kw mw v degree degrees""".split()
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty
thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dos tres
cuatro cinco seis siete ocho nueve diez doce deux trois quatre cinq sept huit neuf dix douze""".split()
#: Words that are no names when capitalised.
FUNCTION_WORDS = """The An And Or But If In On At Of To For From With By As Is Are Was Were Be Do Does Did Has Have Had Can Could Will Would Should May
Must How What Which Who Whose Whom When Where Why This That These Those There Then It Its He She They We You His Her Their Our Your My Each Every All
Some Any No Not So After Before While Since Let Find Given Der Die Das Den Dem Ein Eine Und Oder Aber Wenn Im Am Zu Mit Von Auf Für Ist Sind Wie Wer
Wann Wo Warum Es Er Sie Wir Ihr Nach El La Los Las Un Una Si En De Del Con Por Para Se Que Qué Cuánto Cuántos Cuántas Cuál Cómo Le Les Des Une Et Ou
Mais Dans Sur Avec Pour Est Quel Quelle Combien Il Elle""".split()
LETTER = r"\p{L}\p{M}\p{N}"
EDGE = f"(?![{LETTER}])"
CAPITALISED = r"\p{Lu}[\p{Ll}\p{M}]+"
#: Names inside a sentence.
INSIDE = rf"(?=\p{{Lu}})(?<=[\p{{Ll}}\p{{N}},;] )(?!(?:{'|'.join(FUNCTION_WORDS)}){EDGE}){CAPITALISED}{EDGE}"


def spaced(text: Column) -> Column:
    """The text with a space between a number and its unit."""
    return F.when(text.rlike(r"\p{N}"), F.regexp_replace(text, rf"(?<=\p{{N}})(?=(?i:{'|'.join(UNITS)}){EDGE})", " ")).otherwise(text)


def words(text: Column) -> Column:
    """Words as they are written; placeholders are words."""
    return F.array_remove(F.split(text, f"[^{LETTER}{NUMBER}{NAME}{UNIT}]+"), "")


def lowered(of: Column) -> Column:
    return F.transform(of, lambda w: F.lower(w))


def typed(written: Column, low: Column, plain: Column, kinds: dict[str, Column], names: bool = True) -> Column:
    """plain with what `kinds` has for a number, a unit or a name in its place; written, low, plain: a text's words in three forms."""
    # Only what doesn't begin with a letter from a to z needs a look at its digits.
    number = lambda x: x.isin(NUMBER_WORDS) | (~x.between("a", "z\uffff") & x.rlike(r"^\p{N}+$"))

    def kind(w: Column, i: Column) -> Column:
        x = F.get(low, i)
        out = F.when(number(x), kinds[NUMBER]).when(x.isin(UNITS) & (i > 0) & F.coalesce(number(F.get(low, i - 1)), F.lit(False)), kinds[UNIT])
        if names:
            out = out.when((w != x) & ~w.isin(FUNCTION_WORDS) & w.rlike(f"^{CAPITALISED}$"), kinds[NAME])
        return out.otherwise(F.get(plain, i))

    return F.transform(written, kind)


def is_slot(word: Column) -> Column:
    return word.isin(NUMBER, NAME, UNIT)


def window(of: str, at: Column | int, width: int = WIDTH) -> Column:
    """The hash of `width` words, or of those there are, from a place on; of: an array of the words' hashes."""
    return F.xxhash64(*[F.get(of, F.lit(at) + k if isinstance(at, int) else at + k) for k in range(width)])


def looked_up(texts: DataFrame, keep: list[str], short: list[int]) -> DataFrame:
    """keep, raw (words in lower case), doc_at and window of every window of texts, as template and as plain words, and as
    plain words of the lengths in `short`."""
    # The outer form keeps Catalyst from deriving a filter on the words' number, which it would push
    # below the projections and so evaluate every expression in them again.
    split = texts.select(*keep, words(spaced(F.col("text"))).alias("written"))
    low = split.select(*keep, "written", lowered(F.col("written")).alias("raw"))
    hashed = low.select(*keep, "written", "raw", F.transform("raw", lambda w: F.xxhash64(w)).alias("plain"))
    kinds = {k: F.xxhash64(F.lit(k)) for k in (NUMBER, NAME, UNIT)}
    shaped = hashed.select(*keep, "raw", "plain", typed(F.col("written"), F.col("raw"), F.col("plain"), kinds).alias("shape"))
    each = shaped.select(*keep, "raw", "plain", "shape", F.posexplode_outer("plain").alias("doc_at", "first"))
    at, n = F.col("doc_at"), F.size("plain")
    own = [F.when((at == 0) | (at <= n - WIDTH), window(c, at)) for c in ("plain", "shape")]
    own += [F.when((at <= n - k) & (n > k), window("plain", at, k)) for k in short]
    found = each.select(*keep, "raw", "doc_at", own[0].alias("own"), own[1].alias("typed"), *[x.alias(f"short{k}") for k, x in zip(short, own[2:], strict=True)])
    forms = F.array("own", F.when(F.col("own") != F.col("typed"), F.col("typed")), *[f"short{k}" for k in short])
    return found.select(*keep, "raw", "doc_at", F.explode_outer(forms).alias("window"))


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, of, size (words of the item), item_at, window (hash), slots (template), item_words and rich (a template that proves something)."""
    text = items.select("item_id", "of", spaced(F.col("text")).alias("text"))
    text = text.select("item_id", "of", words(F.col("text")).alias("written"), words(F.regexp_replace("text", INSIDE, NAME)).alias("inner"))
    text = text.select("item_id", "of", "written", "inner", lowered(F.col("written")).alias("raw"), lowered(F.col("inner")).alias("inner_low"))
    kinds = {k: F.lit(k) for k in (NUMBER, NAME, UNIT)}
    inside = typed(F.col("inner"), F.col("inner_low"), F.col("inner_low"), kinds, names=False)
    split = text.select("item_id", "of", "raw", typed(F.col("written"), F.col("raw"), F.col("raw"), kinds).alias("template"), inside.alias("inside"))
    n = F.when(F.size("raw") >= WIDTH, F.size("raw") - WIDTH + 1).otherwise((F.size("raw") > 0).cast("int"))
    at = split.withColumn("item_at", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1))))
    part = lambda c: F.slice(c, F.col("item_at") + 1, WIDTH)
    parts = at.select("item_id", "of", F.size("raw").alias("size"), "item_at", part("template").alias("template"), part("inside").alias("inside"), part("raw").alias("item_words"))
    proves = lambda form: F.size(F.filter(form, lambda x: ~is_slot(x))) >= F.least(F.lit(MIN_LITERALS), F.size(form))
    each = parts.withColumn("rich", proves(F.col("template"))).withColumn("form", F.explode(F.array_distinct(F.array("template", "inside", "item_words"))))
    plain = F.col("form") == F.col("item_words")
    hashed = each.where(plain | proves(F.col("form"))).withColumn("hashes", F.transform("form", lambda w: F.xxhash64(w)))
    return hashed.select("item_id", "of", "size", "item_at", window("hashes", 0).alias("window"), F.when(plain, F.col("template")).otherwise(F.col("form")).alias("slots"), "item_words", "rich")


def slot_pairs(template: Column, item_words: Column, doc_words: Column) -> Column:
    """(item value, document value) under each placeholder."""
    kind = lambda x: is_slot(F.element_at(template, x))
    at = F.filter(F.sequence(F.lit(1), F.size(template)), kind)
    pair = lambda i: F.struct(F.concat(F.element_at(template, i), F.element_at(item_words, i)).alias("item"), F.element_at(doc_words, i).alias("doc"))
    return F.transform(at, pair)


def longest_run(positions: Column) -> Column:
    """Longest run of consecutive numbers in an array of distinct ones."""
    zero = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(x == s["last"] + 1, s["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(F.array_sort(positions), zero, step, lambda s: s["best"])


def leaks(docs: DataFrame, benchmark: DataFrame, *, containment: float = CONTAINMENT, run: int = RUN) -> DataFrame:
    """A row for each document and item that leaks into it: row_key, doc_id, item_id, and the evidence."""
    items = benchmark.select("item_id", F.xxhash64("text").alias("of"), text_col().alias("text")).dropDuplicates()
    each = item_windows(items)
    totals = each.groupBy("item_id", "of").agg(F.count_distinct("item_at").cast("int").alias("item_windows"), F.count_distinct(F.when(F.col("rich"), F.col("item_at"))).alias("rich_windows"))
    side = F.broadcast(each) if each.count() <= BROADCAST_WINDOWS else each

    texts = docs.select("doc_id", row_key().alias("row_key"), text_col().alias("text"))
    short = sorted(r["size"] for r in each.where(F.col("size") < WIDTH).select("size").distinct().collect())
    own = looked_up(texts, ["doc_id", "row_key"], short)
    there = F.slice("raw", F.col("doc_at") + 1, F.size("item_words"))
    met = own.join(side, "window").select(
        "doc_id", "row_key", "item_id", "of", (F.col("doc_at") - F.col("item_at")).alias("diagonal"),
        F.struct("item_at", "rich", (F.col("item_words") == there).alias("exact"), slot_pairs(F.col("slots"), F.col("item_words"), there).alias("pairs")).alias("match"),
    )
    diagonals = met.groupBy("row_key", "doc_id", "item_id", "of", "diagonal").agg(F.collect_list("match").alias("matches"))
    paired = diagonals.withColumn("pairs", F.array_sort(F.array_distinct(F.flatten(F.col("matches.pairs")))))
    # Sorted, so the values of an item value stand next to each other.
    item_value = lambda i: F.element_at("pairs", i)["item"]
    torn = F.when(F.size("pairs") > 1, F.transform(F.filter(F.sequence(F.lit(2), F.size("pairs")), lambda i: item_value(i) == item_value(i - 1)), item_value)).otherwise(F.array().cast("array<string>"))
    judged = paired.withColumn("torn", torn)
    counts = judged.withColumn("matches", F.filter("matches", lambda m: m["exact"] | ~F.arrays_overlap(m["pairs"]["item"], F.col("torn")))).where(F.size("matches") > 0)
    changed = F.exists("matches", lambda m: F.exists(m["pairs"], lambda p: p["item"] != F.concat(F.substring(p["item"], 1, 1), p["doc"])))
    at = counts.select("row_key", "doc_id", "item_id", "of", F.array_distinct("matches.item_at").alias("at"), F.filter("matches", lambda m: m["rich"])["item_at"].alias("rich"), changed.alias("changed"))
    met_in_all = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))
    found = at.groupBy("row_key", "doc_id", "item_id", "of").agg(
        met_in_all("at").alias("matched"), met_in_all("rich").alias("rich"), F.max(longest_run(F.col("at"))).alias("longest_run"), F.max("changed").alias("reparameterised")
    )
    both = found.join(F.broadcast(totals) if side is not each else totals, [found.item_id.eqNullSafe(totals.item_id), found.of == totals.of])
    of_rich = F.when(F.col("rich_windows") > 0, F.col("rich") / F.col("rich_windows"))
    share = F.greatest(F.col("matched") / F.col("item_windows"), of_rich)
    return both.where((share >= containment) | (F.col("longest_run") >= run)).select(
        "row_key", "doc_id", found.item_id, "item_windows", "matched", F.round(share, 6).alias("containment"), "longest_run", "reparameterised"
    )


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """docs without the rows that an item leaks into."""
    key = fresh(docs, "key__")
    found = leaks(docs, benchmark, **settings).select(F.col("row_key").alias(key)).distinct()
    return docs.withColumn(key, row_key()).join(found, key, "left_anti").drop(key)
