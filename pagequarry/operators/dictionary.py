"""Dictionary entries by patterns: text with variables, optional and repeated parts, matched with backtracking.

A pattern is text in which $name is a variable, `(...)?` may be missing and `name(...)*` or `name(...)+`
repeats; a backslash takes a sign as it is; a line break also stands for the text's end. A variable takes as little as it can, at least a letter,
and never goes beyond its line unless it is written $$name. Each repeat binds variables of its own, so bindings form a tree; flattened, they are
the rows of the cross product of the repeats. Result templates turn rows into statements: text with
variables, and functions of one argument around them.

Patterns are tried on each block of a page, in order; the first that matches wins. Blocks go through
Python in Arrow batches, since matching with backtracking is no regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.scalar import wiki_encode
from pagequarry.model import statement, statements

TOKEN = re.compile(r"\\(.)|(\$\$?)(\w+)|(\w*)\((?!\?)|\)([?*+]?)", re.S)


@dataclass
class Part:
    """A literal, a variable or a group of parts."""

    kind: str
    text: str = ""
    parts: list[Part] = field(default_factory=list)
    least: int = 1
    most: int | None = 1


def compile_pattern(pattern: str) -> list[Part]:
    """The parts of a pattern."""
    stack: list[Part] = [Part("group")]
    at = 0

    def literal(text: str) -> None:
        if text:
            stack[-1].parts.append(Part("literal", text))

    for m in TOKEN.finditer(pattern):
        literal(pattern[at : m.start()])
        at = m.end()
        if m[1] is not None:
            literal(m[1])
        elif m[3] is not None:
            stack[-1].parts.append(Part("variable" if m[2] == "$" else "long", m[3]))
        elif m[0].endswith("("):
            stack.append(Part("group", m[4] or ""))
        else:
            if len(stack) == 1:
                raise ValueError(f"a bracket closes that never opened: {pattern}")
            group = stack.pop()
            group.least, group.most = {"": (1, 1), "?": (0, 1), "*": (0, None), "+": (1, None)}[m[5]]
            stack[-1].parts.append(group)
    if len(stack) > 1:
        raise ValueError(f"a bracket never closes: {pattern}")
    literal(pattern[at:])
    return stack[0].parts


Bindings = dict[str, object]


@lru_cache(maxsize=10_000)
def _literal(text: str) -> re.Pattern:
    """White space with a line break stands for any with one and for the text's end, other white space for any within a line."""
    parts = re.split(r"(\s+)", text)
    return re.compile("".join((r"(?:[^\S\n]*\n\s*|\s*\Z)" if "\n" in x else r"[^\S\n]+") if x.isspace() else re.escape(x) for x in parts))


def match_parts(parts: Sequence[Part], text: str, at: int) -> Iterator[tuple[int, Bindings]]:
    """Every way in which parts match from a place: where they end and what they bind, the shortest variables first."""
    if not parts:
        yield at, {}
        return
    first, rest = parts[0], parts[1:]
    if first.kind == "literal":
        m = _literal(first.text).match(text, at)
        if m:
            yield from match_parts(rest, text, m.end())
    elif first.kind in ("variable", "long"):
        line = text.find("\n", at)
        stop = len(text) if first.kind == "long" or line < 0 else line
        # A literal that follows says where the variable can end.
        sign = re.split(r"\s+", rest[0].text)[0] if rest and rest[0].kind == "literal" else ""
        end = at + 1
        while end <= stop:
            if sign:
                end = text.find(sign, end)
                if end < 0 or end > stop:
                    return
            for k, found in match_parts(rest, text, end):
                yield k, {first.text: text[at:end].strip()} | found
            end += 1
    else:
        for k, times in repeats(first, text, at, 0):
            for e, found in match_parts(rest, text, k):
                if first.text:
                    yield e, {first.text: times} | found
                else:
                    own: Bindings = {}
                    for t in times:
                        own |= t
                    yield e, own | found


def repeats(group: Part, text: str, at: int, done: int) -> Iterator[tuple[int, list[Bindings]]]:
    """Every number of repeats of a group from a place, the most first."""
    if group.most is None or done < group.most:
        for k, found in match_parts(group.parts, text, at):
            if k > at:
                for e, more in repeats(group, text, k, done + 1):
                    yield e, [found, *more]
    if done >= group.least:
        yield at, []


def bind(pattern: Sequence[Part], text: str) -> Bindings | None:
    """What a pattern binds in a block, from its first place that matches; None if it doesn't."""
    start = next((p for p in pattern if p.kind == "literal"), None)
    first = pattern[0] if pattern else None
    at = 0
    while at <= len(text):
        if first is not None and first is start:
            sign = re.split(r"\s+", first.text)[0]
            at = text.find(sign, at) if sign else at
            if at < 0:
                return None
        found = next(match_parts(pattern, text, at), None)
        if found is not None:
            return found[1]
        at += 1
    return None


def flattened(bindings: Bindings) -> list[dict[str, str]]:
    """Rows of the cross product of all repeats; a repeat that holds nothing leaves its variables out."""
    rows: list[dict[str, str]] = [{}]
    for name, value in bindings.items():
        if isinstance(value, list):
            inner = [row for one in value for row in flattened(one)]
            rows = [r | i for r in rows for i in inner] if inner else rows
        else:
            rows = [r | {name: str(value)} for r in rows]
    return rows


def blocks(pages: DataFrame, heading: str = r"\n(?=={2,}[^=])") -> DataFrame:
    """page_id, title, lang, ord and text of the pieces of a page between its headings."""
    return pages.select("page_id", "title", "lang", F.posexplode(F.split("source", heading)).alias("ord", "text"))


def bound(pieces: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """page_id, title, lang, ord, pattern (the first that matches), row and vars (its variables) of each block that a pattern matches."""
    compiled = {name: compile_pattern(p) for name, p in patterns.items()}

    def matched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                for name, pattern in compiled.items():
                    found = bind(pattern, r.text or "")
                    if found is not None:
                        out += [(r.page_id, r.title, r.lang, r.ord, name, k, row) for k, row in enumerate(flattened(found))]
                        break
            yield pd.DataFrame(out, columns=["page_id", "title", "lang", "ord", "pattern", "row", "vars"])

    return pieces.select("page_id", "title", "lang", "ord", "text").mapInPandas(matched, "page_id long, title string, lang string, ord int, pattern string, row int, vars map<string, string>")


# --- results ------------------------------------------------------------------------------------------------


def cleaned(x: str) -> str:
    """Without markup, brackets of links and doubled spaces."""
    x = re.sub(r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", r"\1", x)
    return re.sub(r"\s+", " ", re.sub(r"'{2,}|<[^>]*>|\{\{[^{}]*\}\}", "", x)).strip()


def _numeric(x: str) -> str | None:
    return x if re.fullmatch(r"[+-]?\d+(?:[.,]\d+)?", x.strip()) else None


#: Functions of result templates; None drops the statement. Unknown ones keep their argument.
FUNCTIONS: dict[str, Callable[[str], str | None]] = {
    "clean": cleaned,
    "uri": lambda x: re.sub(r"\s+", "_", cleaned(x)),
    "lastword": lambda x: (cleaned(x).split() or [""])[-1],
    "assertNumeric": _numeric,
    "lower": str.lower,
}
CALL = re.compile(r"(\w+)\(([^()]*)\)")


def filled(template: str, variables: Mapping[str, str], vocabulary: Mapping[str, str]) -> str | None:
    """A result template with its variables and functions carried out; None if a variable is missing or an assertion fails."""
    names = re.findall(r"\$(\w+)", template)
    if any(n not in variables for n in names):
        return None
    # Brackets of values aren't those of calls.
    held = [variables[n] for n in names]
    text = template
    for k, n in enumerate(names):
        text = text.replace(f"${n}", f"\x00{k}\x00", 1)
    back = lambda x: re.sub("\x00(\\d+)\x00", lambda m: held[int(m[1])], x)
    while m := CALL.search(text):
        value: str | None = back(m[2])
        if m[1] == "map":
            value = vocabulary.get(cleaned(value), value)
        elif m[1] == "assertMapped":
            value = vocabulary.get(cleaned(value))
        elif m[1] in FUNCTIONS:
            value = FUNCTIONS[m[1]](value)
        if value is None:
            return None
        held.append(value)
        text = text[: m.start()] + f"\x00{len(held) - 1}\x00" + text[m.end() :]
    return back(text)


def results(rows: DataFrame, templates: Sequence[tuple[str, str, str, str]], vocabulary: Mapping[str, str], base: str) -> DataFrame:
    """Statements of bound rows: templates (pattern, subject, predicate, value); a value that begins with `base` or http is a resource.

    vocabulary: cleaned words and what they stand for, for `map` and `assertMapped`.
    """
    plans = list(templates)

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                given = dict(r.vars) | {"title": r.title}
                for pattern, *parts in plans:
                    if pattern == r.pattern:
                        spo = [filled(x, given, vocabulary) for x in parts]
                        if all(spo):
                            out.append((r.lang, *spo))
            yield pd.DataFrame(out, columns=["lang", "s", "p", "o"])

    found = rows.select("title", "lang", "pattern", "vars").mapInPandas(made, "lang string, s string, p string, o string").distinct()
    resource = F.col("o").startswith(base) | F.col("o").rlike("^https?://")
    string = "http://www.w3.org/2001/XMLSchema#string"
    address = lambda c: F.when(F.col(c).startswith(base), F.concat(F.lit(base), wiki_encode(F.substring(c, len(base) + 1, 1 << 30)))).otherwise(F.col(c))
    return statements(found, statement("dictionary", address("s"), address("p"), F.when(resource, address("o")).otherwise(F.col("o")), datatype=F.when(resource, F.lit(None)).otherwise(F.lit(string))))


def lemon(statements_: DataFrame, sense: str, form: str) -> DataFrame:
    """An overlay of lexical entries: every subject with a sense (predicate) is an entry, its form (predicate) a written representation."""
    vocabulary = "http://www.w3.org/ns/lemon/ontolex#"
    entries = statements_.where(F.col("predicate") == sense).select("subject", "value").distinct()
    forms = statements_.where(F.col("predicate") == form).select("subject", F.col("value").alias("form")).distinct()
    out = statements(entries, statement("lemon", F.col("subject"), "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", F.lit(vocabulary + "LexicalEntry")), statement("lemon", F.col("subject"), vocabulary + "sense", F.col("value")))
    node = F.concat("subject", F.lit("__form"))
    of_forms = statements(forms, statement("lemon", F.col("subject"), vocabulary + "canonicalForm", node), statement("lemon", node, vocabulary + "writtenRep", F.col("form"), datatype="http://www.w3.org/2001/XMLSchema#string"))
    return out.unionByName(of_forms).distinct()
