"""Wikitext to nodes: the one grammar that is not regular, parsed in Arrow batches once per page.

A page becomes an array of flat nodes in document order. Each node has an id, the id of its parent
(-1: the page), its depth, its line, a kind and what that kind needs; the tree can be walked by id.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import repeat

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from pagequarry.operators.post import PYTHON_ROWS, spread

NODE = StructType(
    [
        StructField("id", IntegerType()), StructField("parent", IntegerType()), StructField("depth", IntegerType()), StructField("line", IntegerType()),
        StructField("kind", StringType()), StructField("name", StringType()), StructField("text", StringType()), StructField("level", IntegerType()),
        StructField("props", ArrayType(StructType([StructField("key", StringType()), StructField("value", StringType()), StructField("line", IntegerType())]))),
        StructField("rows", ArrayType(ArrayType(StructType([StructField("text", StringType()), StructField("rowspan", IntegerType()), StructField("colspan", IntegerType())])))),
    ]
)

SKIPPED = re.compile(r"<!--.*?(?:-->|\Z)|<(nowiki|math|code|source|syntaxhighlight|pre)\b[^>]*(?:/>|>.*?</\1\s*>)", re.S | re.I)
TOKEN = re.compile(r"\{\{\{|\{\{|\{\||\[\[|\[(?=https?://|//|mailto:|ftp://)|https?://[^\s\[\]<>\"|{}]+|^(=+)[^\S\n]*(.+?)[^\S\n]*\1[^\S\n]*$", re.M)
PAIRS = {"{{": "}}", "[[": "]]", "{{{": "}}}", "{|": "|}"}
BRACKET = re.compile(r"\{\{|\[\[|\{\||\}\}|\]\]|\|\}")
#: What `Parser.split` stops at, by the sign that parts a text.
STOPS = {sign: re.compile(r"\{\{|\[\[|\{\||\}\}|\]\]|" + own) for sign, own in (("|", r"\|"), ("=", r"\|\}|="))}
#: What every token has a part of; a text without any of these is plain.
SPECIAL = re.compile(r"[\[{=]|https?:")
#: Nesting beyond which brackets are text (each level takes three frames of Python's stack).
DEEPEST = 200


def brackets(s: str) -> dict[int, int]:
    """Where each bracket of a text ends, by where it begins; one pass. Those that never close aren't in it."""
    ends: dict[int, int] = {}
    if "[[" not in s and "{{" not in s and "{|" not in s:
        return ends
    stack: list[tuple[int, str]] = []
    open_ = dict.fromkeys(PAIRS.values(), 0)
    k = 0
    while m := BRACKET.search(s, k):
        k = m.start()
        if m[0] in PAIRS:
            sign = "{{{" if s.startswith("{{{", k) and not s.startswith("{{{{", k) else m[0]
            stack.append((k, PAIRS[sign]))
            open_[PAIRS[sign]] += 1
            k += len(sign)
            continue
        if stack and s.startswith(stack[-1][1], k):
            at, sign = stack.pop()
            open_[sign] -= 1
            k += len(sign)
            ends[at] = k
        elif m[0] != "|}" and open_[m[0]]:
            # Inner brackets were left open: they close with the outer one.
            while stack[-1][1] != m[0]:
                open_[stack.pop()[1]] -= 1
        else:
            k += 1
    return ends


#: What becomes of templates while they are parsed, by language: `external` (key of the address, key of the label), `unwrap`
#: (their values in their place), `children` (the values of some keys in their place), `text` (a fixed text), `last` (their last value).
Transforms = Mapping[str, Sequence[str]]
TRANSFORMS: dict[str, Transforms] = {
    "en": {"nowrap": ("unwrap",), "nobr": ("unwrap",), "flatlist": ("unwrap",), "plainlist": ("unwrap",), "lang": ("last",), "url": ("external", "1", "2"), "spaced ndash": ("text", " – "), "hlist": ("unwrap",), "small": ("unwrap",)},
    "de": {"lang": ("last",), "nowrap": ("unwrap",), "url": ("external", "1", "2")},
    "fr": {"langue": ("last",), "lien web": ("external", "url", "titre"), "nobr": ("unwrap",)},
    "es": {"url": ("external", "1", "2"), "lang": ("last",)},
}


@dataclass
class Parser:
    source: str
    nodes: list[dict] = field(default_factory=list)
    transforms: Transforms = field(default_factory=dict)

    def parse(self) -> list[dict]:
        text = SKIPPED.sub(lambda m: "\n" * m[0].count("\n"), self.source)
        self.walk(text, 0, len(text), -1, 0, 1)
        return self.nodes

    def add(self, parent: int, depth: int, line: int, kind: str, **more: object) -> int:
        node = {"id": len(self.nodes), "parent": parent, "depth": depth, "line": line, "kind": kind, "name": None, "text": None, "level": None, "props": None, "rows": None}
        node.update(more)
        self.nodes.append(node)
        return node["id"]

    def walk(self, s: str, at: int, end: int, parent: int, depth: int, line: int) -> None:
        """Nodes of s[at:end]; what lies between them is text."""
        if not SPECIAL.search(s, at, end):
            if s[at:end].strip():
                self.add(parent, depth, line, "text", text=s[at:end])
            return
        start, ends = at, brackets(s)
        while at < end:
            m = TOKEN.search(s, at, end)
            if not m:
                break
            close = ends.get(m.start(), 0) if m[0] in PAIRS else s.find("]", m.end(), end) + 1 if m[0] == "[" else m.end()
            here = line + s.count("\n", start if start < m.start() else m.start(), m.start())
            if close <= 0 or depth >= DEEPEST or (m[1] and depth):
                at = m.start() + (len(m[0]) if m[0] not in ("{{{", "{{", "[[", "{|") else 1)
                continue
            if s[start : m.start()].strip():
                self.add(parent, depth, line, "text", text=s[start : m.start()])
            self.node(s, m, close, parent, depth, here)
            line = here + s.count("\n", m.start(), close)
            at = start = close
        if s[start:end].strip():
            self.add(parent, depth, line, "text", text=s[start:end])

    @staticmethod
    def split(s: str, sign: str) -> list[str]:
        """Parts at a sign that stands in no bracket."""
        if sign not in s:
            return [s]
        parts, depth, last, k = [], 0, 0, 0
        stops = STOPS[sign]
        while m := stops.search(s, k):
            token, k = m[0], m.end()
            if token == sign:
                if not depth:
                    parts.append(s[last : k - 1])
                    last = k
            elif token in ("{{", "[[", "{|"):
                depth += 1
            elif token != "|}" or depth:
                depth = max(0, depth - 1)
            else:
                k -= 1
        return [*parts, s[last:]]

    def node(self, s: str, m: re.Match, close: int, parent: int, depth: int, line: int) -> None:
        token = m[0]
        if m[1]:
            self.add(parent, depth, line, "section", name=m[2].strip(), level=len(m[1]))
        elif token == "{{{":
            name, *default = self.split(s[m.end() : close - 3], "|")
            self.add(parent, depth, line, "parameter", name=name.strip(), text="|".join(default))
        elif token == "{{":
            self.template(s[m.end() : close - 2], parent, depth, line)
        elif token == "[[":
            target, *label = self.split(s[m.end() : close - 2], "|")
            me = self.add(parent, depth, line, "link", name=target.strip(), text=(label[-1] if label else target).strip(), props=[{"key": str(k), "value": x, "line": line} for k, x in enumerate(label, 1)])
            for part in label:
                self.walk(part, 0, len(part), me, depth + 1, line)
        elif token == "[":
            url, _, label = s[m.end() : close - 1].partition(" ")
            self.add(parent, depth, line, "external", name=url, text=label.strip())
        elif token == "{|":
            self.table(s[m.end() : close - 2], parent, depth, line)
        else:
            self.add(parent, depth, line, "external", name=token.rstrip(".,;:!?)"), text="")

    def template(self, body: str, parent: int, depth: int, line: int) -> None:
        name, *args = self.split(body, "|")
        kind = "function" if re.match(r"\s*#|\s*[A-Z]+:", name) else "template"
        props, number, at = [], 0, line + name.count("\n")
        for a in args:
            pieces = self.split(a, "=")
            if len(pieces) > 1 and kind == "template":
                key, value = pieces[0].strip(), "=".join(pieces[1:])
            else:
                number += 1
                key, value = str(number), a
            lead = len(a) - len(a.lstrip("\n "))
            props.append({"key": key, "value": value.strip(), "line": at + a[:lead].count("\n")})
            at += a.count("\n")
        shown = re.sub(r"\s+", " ", name.replace("_", " ")).strip()
        if kind == "template" and shown.lower() in self.transforms:
            self.transformed(self.transforms[shown.lower()], props, parent, depth, line)
            return
        me = self.add(parent, depth, line, kind, name=shown[:1].upper() + shown[1:] if kind == "template" else shown, text="{{" + body + "}}", props=props)
        for p in props:
            self.walk(p["value"], 0, len(p["value"]), me, depth + 1, p["line"])

    def transformed(self, rule: Sequence[str], props: list[dict], parent: int, depth: int, line: int) -> None:
        """What a template stands for, in its place."""
        kind, *keys = rule
        of = {p["key"]: p["value"] for p in props}
        if kind == "external":
            if url := of.get(keys[0], ""):
                self.add(parent, depth, line, "external", name=url, text=of.get(keys[1], "") if len(keys) > 1 else "")
        elif kind == "text":
            self.add(parent, depth, line, "text", text=keys[0])
        else:
            chosen = props if kind == "unwrap" else props[-1:] if kind == "last" else [p for p in props if p["key"] in keys]
            for p in chosen:
                self.walk(p["value"], 0, len(p["value"]), parent, depth, p["line"])

    def table(self, body: str, parent: int, depth: int, line: int) -> None:
        rows: list[list[dict]] = [[]]
        caption = ""
        for part in re.split(r"\n(?=[|!])", "\n" + body.partition("\n")[2])[1:]:
            if part.startswith("|-"):
                rows.append([])
                continue
            if part.startswith("|+"):
                caption = part[2:].strip()
                continue
            for cell in re.split(r"\|\||!!", part[1:]):
                bits = self.split(cell, "|")
                attributes, text = (bits[0], "|".join(bits[1:])) if len(bits) > 1 and re.search(r"\w+\s*=", bits[0]) else ("", cell)
                span = lambda n, a=attributes: max(1, min(1000, int(x[1]))) if (x := re.search(rf"{n}\s*=\s*\"?(\d+)", a)) else 1
                rows[-1].append({"text": text.strip(), "rowspan": span("rowspan"), "colspan": span("colspan")})
        me = self.add(parent, depth, line, "table", name=caption, rows=[r for r in rows if r])
        for r in rows:
            for cell in r:
                self.walk(cell["text"], 0, len(cell["text"]), me, depth + 1, line)


def nodes_of(sources: pa.Array, rules: Iterator[Transforms]) -> Iterator[pa.Array]:
    """Nodes of each source, a few pages at a time."""
    kind = to_arrow_type(ArrayType(NODE))
    for at in range(0, len(sources), PYTHON_ROWS):
        some = sources.slice(at, PYTHON_ROWS).to_pylist()
        yield pa.array([Parser(s, transforms=of).parse() if s is not None else [] for s, of in zip(some, rules, strict=False)], kind)


@F.arrow_udf(ArrayType(NODE))
def parse_wikitext(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Nodes of each source; a null source has none."""
    for source in batches:
        yield from nodes_of(source, repeat({}))


def parsed(pages: DataFrame, transforms: Mapping[str, Transforms] | None = None) -> DataFrame:
    """pages with their nodes; write the result if several extractors read it. transforms: by language, see TRANSFORMS."""
    pages = spread(pages)
    if transforms is None:
        return pages.withColumn("nodes", parse_wikitext("source"))
    rules = {lang: dict(of) for lang, of in transforms.items()}

    @F.arrow_udf(ArrayType(NODE))
    def parse(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for source, lang in batches:
            yield from nodes_of(source, iter([rules.get(of, {}) for of in lang.to_pylist()]))

    return pages.withColumn("nodes", parse("source", "lang"))


def relative_lines(rows: DataFrame) -> DataFrame:
    """Exploded nodes with section (its name) and relative (lines since its heading); before the first heading lines count from the page's start."""
    heads = F.filter("nodes", lambda n: (n["kind"] == "section") & (n["id"] <= F.col("node.id")))
    last = F.try_element_at(heads, F.lit(-1))
    return rows.withColumn("section", last["name"]).withColumn("relative", F.col("node.line") - F.coalesce(last["line"], F.lit(1)))


def child_addresses(rows: DataFrame, base: Column, name: Column, longest: int = 50) -> DataFrame:
    """Exploded nodes with address: that of the page, a cleaned name of at most so many letters, and which of that name on the page it is."""
    clean = F.substring(F.regexp_replace(F.regexp_replace(name, r"[^\p{L}\p{N}]+", "_"), "^_+|_+$", ""), 1, longest)
    rows = rows.withColumn("address", F.concat(base, F.lit("__"), clean))
    nth = F.row_number().over(Window.partitionBy("page_id", "address").orderBy("node.id"))
    return rows.withColumn("address", F.concat("address", F.lit("__"), nth.cast("string")))


def of_kind(kind: str, top: bool = False) -> Column:
    """The nodes of a kind, in document order; only those outside other nodes if `top`."""
    return F.filter("nodes", lambda n: (n["kind"] == kind) & ((n["depth"] == 0) if top else F.lit(True)))


def exploded(pages: DataFrame, kind: str, top: bool = False) -> DataFrame:
    return pages.select("*", F.posexplode(of_kind(kind, top)).alias("ord", "node"))


def expand_spans(rows: list[list[dict]]) -> list[list[str]]:
    """A table's cells with every cell repeated over the rows and columns that it spans."""
    grid: list[list[str]] = []
    pending: dict[int, tuple[int, str]] = {}
    for r in rows:
        out: list[str] = []
        cells = list(r)
        while cells or len(out) in pending:
            if len(out) in pending:
                left, text = pending.pop(len(out))
                if left > 1:
                    pending[len(out)] = (left - 1, text)
                out.append(text)
                continue
            c = cells.pop(0)
            for _ in range(c["colspan"]):
                if c["rowspan"] > 1:
                    pending[len(out)] = (c["rowspan"] - 1, c["text"])
                out.append(c["text"])
        grid.append(out)
    return grid


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def _grid(rows: pd.Series) -> pd.Series:
    return rows.map(lambda r: expand_spans(json.loads(r)) if isinstance(r, str) else None)


def table_grid(rows: str | Column) -> Column:
    """The expanded cells of a table node's rows, which cross into Python as JSON."""
    return _grid(F.to_json(rows))


#: Codes of languages with a wiki of their own.
LANGUAGES = """en de fr es it nl ru ja pl pt zh sv uk vi ar fa ca sr id ko no fi hu cs tr ro eu eo da bg hy he sk el hr lt sl et gl th hi ms az be ka la kk uz bn ur ta mk nn lv
af sq cy br oc bs is sw te ml mr tl lb ga mn jv yo am my ne pa gu kn si zu commons wikidata""".split()
#: Names of namespaces by language; English ones are known everywhere.
NAMESPACES: dict[str, dict[str, int]] = {
    "en": {"talk": 1, "user": 2, "user talk": 3, "wikipedia": 4, "project": 4, "file": 6, "image": 6, "file talk": 7, "mediawiki": 8, "template": 10, "template talk": 11, "help": 12, "category": 14, "category talk": 15, "portal": 100, "draft": 118, "module": 828, "special": -1, "media": -2},
    "de": {"diskussion": 1, "benutzer": 2, "benutzerin": 2, "datei": 6, "bild": 6, "vorlage": 10, "hilfe": 12, "kategorie": 14, "modul": 828, "spezial": -1},
    "fr": {"discussion": 1, "utilisateur": 2, "fichier": 6, "modèle": 10, "aide": 12, "catégorie": 14, "portail": 100, "spécial": -1},
    "es": {"discusión": 1, "usuario": 2, "archivo": 6, "imagen": 6, "plantilla": 10, "ayuda": 12, "categoría": 14, "módulo": 828, "especial": -1},
    "it": {"discussione": 1, "utente": 2, "file": 6, "immagine": 6, "template": 10, "aiuto": 12, "categoria": 14, "portale": 100, "speciale": -1},
    "pt": {"discussão": 1, "usuário": 2, "ficheiro": 6, "arquivo": 6, "imagem": 6, "predefinição": 10, "ajuda": 12, "categoria": 14},
    "nl": {"overleg": 1, "gebruiker": 2, "bestand": 6, "afbeelding": 6, "sjabloon": 10, "categorie": 14},
    "pl": {"dyskusja": 1, "wikipedysta": 2, "plik": 6, "grafika": 6, "szablon": 10, "pomoc": 12, "kategoria": 14},
    "ru": {"обсуждение": 1, "участник": 2, "файл": 6, "изображение": 6, "шаблон": 10, "справка": 12, "категория": 14, "портал": 100, "модуль": 828},
    "sv": {"diskussion": 1, "användare": 2, "fil": 6, "bild": 6, "mall": 10, "hjälp": 12, "kategori": 14},
    "cs": {"diskuse": 1, "wikipedista": 2, "soubor": 6, "šablona": 10, "nápověda": 12, "kategorie": 14},
    "tr": {"tartışma": 1, "kullanıcı": 2, "dosya": 6, "şablon": 10, "yardım": 12, "kategori": 14},
    "el": {"συζήτηση": 1, "χρήστης": 2, "αρχείο": 6, "πρότυπο": 10, "βοήθεια": 12, "κατηγορία": 14},
    "hu": {"vita": 1, "szerkesztő": 2, "fájl": 6, "kép": 6, "sablon": 10, "segítség": 12, "kategória": 14},
    "ja": {"ノート": 1, "利用者": 2, "ファイル": 6, "画像": 6},
}


def title_parts(title: Column, namespaces: dict[str, int] | None = None, languages: tuple[str, ...] = tuple(LANGUAGES)) -> Column:
    """What a link's target names: title, ns, fragment, language of an interlanguage link, and whether a colon leads.

    Namespaces are known by their names in all of NAMESPACES' languages, unless they are given."""
    known = namespaces or {name: n for of in reversed(NAMESPACES.values()) for name, n in of.items()}
    # Whole maps as text: one call each to the JVM while the plan is built.
    quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    table = F.expr("map(" + ", ".join(f"{quoted(name)}, {int(n)}" for name, n in known.items()) + ")")
    codes = F.expr("map(" + ", ".join(f"{quoted(c)}, {quoted(c)}" for c in languages) + ")")
    from pagequarry.functions.scalar import capitalize, clean_space
    from pagequarry.functions.values import let

    def read(x: Column) -> Column:
        body = F.regexp_replace(x, "^:", "")
        prefix = F.lower(F.trim(F.regexp_extract(body, r"^([^:\[\]#|]+):", 1)))
        code = F.try_element_at(codes, prefix)
        lang = F.when(~x.startswith(":"), code)
        ns = F.coalesce(F.try_element_at(table, prefix), F.lit(0))
        rest = F.when((ns != 0) | code.isNotNull(), F.regexp_replace(body, r"^[^:]+:", "")).otherwise(body)
        fragment = F.nullif(F.regexp_extract(rest, r"#(.*)$", 1), F.lit(""))
        name = capitalize(clean_space(F.regexp_replace(rest, r"#.*$", "")))
        return F.struct(name.alias("title"), ns.alias("ns"), fragment.alias("fragment"), lang.alias("language"), x.startswith(":").alias("colon"))

    from pagequarry.functions.scalar import decode_entities

    return let(F.trim(F.coalesce(F.try_url_decode(F.replace(decode_entities(title), F.lit("+"), F.lit("%2B"))), title)), read)
