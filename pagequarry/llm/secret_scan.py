"""Secrets in whole texts: fixed patterns, and the guess cost of values in a credential context.

Base spans are the leftmost non-overlapping matches of three patterns (an assignment, an access key,
a hexadecimal run) that are long enough. The method adds spans of kind `guess`: values that stand
after a credential word and that are dear to guess. The guess cost of a value is the least, over all
segmentations, of the summed costs (base-2 logarithms of guesses) of its parts; a shortest-path table
over positions finds it. Parts are

* a word of a ranked list, in any case and with digits or signs for letters,
* a date or a year,
* a block of one to four letters that repeats up to TIMES times, or as often as it goes,
* a keyboard walk of up to LONGEST_PART letters, or as long as it goes,
* a letter by brute force.

Within a long repetition positions further than DEEP from both its ends aren't where a part begins or
ends: whatever else covers DEEP letters costs more than the one repeat that covers them all. So a
value's time grows with its length. Once every way on costs what makes a secret, the table stops.

Defined results: offsets are code points, ends exclusive; a null text counts as empty and has no
spans; texts and values of any length are judged whole; repeated rows get equal results; an empty table
gives no rows; extra columns aren't read, whatever their names; base spans stay whatever the method
adds, and a value that a base span covers gets no second one.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pagequarry.llm._common import small_batches, text_col

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
#: Runs of the base patterns that are too short never hold a long enough match, so the least length is part of these.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: A credential word, a sign of assignment and a value without spaces.
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credential|api[_-]?key|auth|private[_-]?key|bearer)\b"
    r"[\"']?\x20*[:=]\x20*(?:Bearer\x20)?[\"']?([^\s\"'<>,;]{6,})",
    re.IGNORECASE | re.ASCII,
)
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "credential", "key", "auth", "bearer")
#: Values that take at least 2^40 guesses are secrets.
LEAST_BITS = 40.0
#: Longest word, and longest walk whose every shorter end counts.
LONGEST_PART = 24
TIMES = 16
DEEP = 512

#: Common passwords and words of them: first in rank, before the list that is given.
COMMON = """password passwd pass secret token key admin administrator root user login guest test demo example sample default
changeme letmein welcome monkey dragon master shadow sunshine princess football baseball iloveyou qwerty abc the and
for with your this that from none null true false value string here placeholder server client access public private
system service account data base mail web site home office summer winter spring autumn monday friday london paris
love god hello world secure security temp temporary computer internet samsung google apple orange banana house
blue green black white red yellow silver gold tiger lion eagle falcon star moon sun hunter killer ranger super""".split()
WALKS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz", "0123456789", "qazwsxedcrfvtgbyhnujmikolp")
NEXT = {(a, b) for row in WALKS for a, b in [*zip(row, row[1:]), *zip(row[::-1], row[::-1][1:])]}
LEET = str.maketrans("4@831!0$57+", "aabeiiosstt")
YEAR, MONTH, DAY = "(?:19|20)\\d\\d", "(?:0[1-9]|1[0-2])", "(?:0[1-9]|[12]\\d|3[01])"
DATES = [
    (re.compile(rf"{YEAR}[-/._]?{MONTH}[-/._]?{DAY}", re.ASCII), math.log2(365 * 130)),
    (re.compile(rf"{DAY}[-/._]?{MONTH}[-/._]?{YEAR}", re.ASCII), math.log2(365 * 130)),
    (re.compile(YEAR, re.ASCII), math.log2(130)),
]
#: Each part that isn't brute force costs a choice of what kind it is.
CHOICE = 1.0
WALK_BITS = math.log2(len(WALKS) * 2 * 12)


def ranked_words(path: str, shortest: int = 3) -> list[str]:
    """Whole words in ASCII letters of a byte-level vocabulary file, in the order of its ids, which is about that of frequency."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    words = (t[1:].lower() for t, _ in sorted(vocabulary.items(), key=lambda x: x[1]) if t.startswith("\u0120") and t[1:].isascii() and t[1:].isalpha())
    return list(dict.fromkeys(w for w in words if len(w) >= shortest))


def letter_bits(c: str) -> float:
    """Brute force of one letter: the size of its class."""
    return math.log2(10 if c.isdigit() else 26 if c.isalpha() else 33)


def ahead(holds: np.ndarray) -> np.ndarray:
    """How many places in a row hold from each one on."""
    n = len(holds)
    ends = np.where(holds, n, np.arange(n))
    return np.minimum.accumulate(ends[::-1])[::-1] - np.arange(n)


class GuessCosts:
    """Costs of values under a ranked word list."""

    def __init__(self, words: Iterable[str] = ()):
        self.rank = {w: k + 1 for k, w in enumerate(dict.fromkeys([*COMMON, *words]))}
        self.begins = {w[:3] for w in self.rank}

    def bits(self, value: str, enough: float = math.inf) -> float:
        """Base-2 logarithm of the guesses that the cheapest segmentation needs; `enough` if it is that or more."""
        n, low = len(value), "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
        if not n:
            return 0.0
        plain = low.translate(LEET)
        single = [letter_bits(c) for c in value]
        codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        periods = {u: np.append(ahead(codes[:-u] == codes[u:]), np.zeros(u, dtype=np.int64)) if n > u else np.zeros(n, dtype=np.int64) for u in (1, 2, 3, 4)}
        repeats = {u: x.tolist() for u, x in periods.items()}
        walks = np.append(ahead(np.array([p in NEXT for p in zip(low, low[1:])], dtype=bool)), 0).tolist() if n > 1 else [0]
        deep = np.zeros(n, dtype=bool)
        for u, x in periods.items():
            back = np.append(np.zeros(u, dtype=np.int64), ahead((codes[:-u] == codes[u:])[::-1])[::-1]) if n > u else np.zeros(n, dtype=np.int64)
            deep |= (x > DEEP) & (back > DEEP)
        best = [0.0] + [math.inf] * n
        reach = 0  # the furthest place that is cheaper than `enough`
        for i in range(n):
            if i > reach:
                return enough
            here = best[i]
            if here >= enough or deep[i]:
                continue
            for j, cost in self.parts(value, low, plain, single, repeats, walks, i):
                if here + cost < best[j]:
                    best[j] = here + cost
                    if j > reach and best[j] < enough:
                        reach = j
        return min(best[n], enough)

    def parts(self, value: str, low: str, plain: str, single: list[float], repeats: dict[int, list[int]], walks: list[int], i: int) -> Iterator[tuple[int, float]]:
        """(end, cost) of each part that begins at i."""
        n = len(value)
        yield i + 1, single[i]
        if plain[i : i + 3] in self.begins:
            for j in range(i + 3, min(n, i + LONGEST_PART) + 1):
                if rank := self.rank.get(plain[i:j]):
                    part = value[i:j]
                    case = 0 if part == low[i:j] else 1 if part == low[i:j].upper() or part[1:] == low[i + 1 : j] else j - i
                    yield j, CHOICE + math.log2(rank + 1) + case + (plain[i:j] != low[i:j])
        if walks[i] >= 2:
            for length in {*range(3, min(walks[i] + 1, LONGEST_PART) + 1), walks[i] + 1}:
                yield i + length, CHOICE + WALK_BITS + math.log2(length)
        for unit in (1, 2, 3, 4):
            most = repeats[unit][i] // unit + 1
            least = 3 if unit == 1 else 2
            if most >= least:
                block = sum(single[i : i + unit])
                for times in {*range(least, min(most, TIMES) + 1), most}:
                    yield i + unit * times, CHOICE + block + math.log2(times)
        if "0" <= value[i] <= "9":
            for date, bits in DATES:
                if m := date.match(value, i):
                    yield m.end(), CHOICE + bits


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    low = text.lower()
    if "pass" in low or "secret" in low or "token" in low or "key" in low:
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    return out + [(*m.span(), "hex") for m in HEX.finditer(text)]


def guessed_spans(text: str, base: list[tuple[int, int, str]], costs: GuessCosts, least: float) -> list[tuple[int, int, str]]:
    low = text.lower()
    if not any(w in low for w in CONTEXT_WORDS):
        return []
    out = []
    for m in CONTEXT.finditer(text):
        a, b = m.span(1)
        if not any(s <= a and b <= e for s, e, _ in base) and costs.bits(m[1], least) >= least:
            out.append((a, b, "guess"))
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    """kind:start:end by start, then kind as listed."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def secret_scan(docs: DataFrame, *, words: Iterable[str] = (), least_bits: float = LEAST_BITS) -> DataFrame:
    """doc_id, found (array of kind, start, end, value), counts of base spans by kind, base_sha256 and spans of every row.

    words: by rank, the commonest first; they travel to every worker, so they are to be a list for people (some ten thousand).
    """
    spark = docs.sparkSession
    small_batches(spark)
    costs = spark.sparkContext.broadcast(GuessCosts(words))
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, n, digest, all_spans = [], [[], [], []], [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                found = sorted(base + guessed_spans(text, base, costs.value, least_bits), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
                spans.append([{"kind": k, "start": a, "end": b, "value": text[a:b]} for a, b, k in found])
                for of, k in zip(n, KINDS, strict=False):
                    of.append(sum(s[2] == k for s in base))
                digest.append(hashlib.sha256(joined(base).encode()).hexdigest())
                all_spans.append(joined(found))
            arrays = [batch.column(0), pa.array(spans, pa.list_(span)), *(pa.array(x, pa.int64()) for x in n), pa.array(digest, pa.string()), pa.array(all_spans, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "found", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    fields = f"doc_id {kind}, found array<struct<kind: string, start: bigint, end: bigint, value: string>>, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select("doc_id", text_col().alias("text")).mapInArrow(scan, fields)

