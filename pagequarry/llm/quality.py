"""Quality of whole texts: ordinal cumulative-link regression on graded ratings.

A text is a vector of hashed terms: the shapes of its words (letters and digits reduced to their
kind, signs kept), the pairs of neighbouring shapes, and its words, each weighing the square root of
its share of the text. One weight vector serves all grades; ordered thresholds part them:
P(grade <= k) = logistic(threshold_k - w.x). From it follow the expected grade and the tail
probability that selects.

Defined results: a null or empty text has no terms, so the thresholds alone grade it; repeated rows
get equal grades; texts of any length are graded whole; without labelled rows, or with one grade only,
every text gets that grade (0 if there is none) and is kept; an empty table gives no rows; extra columns
are carried along, whatever their names, but for one named quality__, which the result replaces.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm._common import fresh, ragged, small_batches, text_col
from pagequarry.llm.labelled import training_rows

#: Labelled rows that the regression is fitted on at most.
FIT_ROWS = 10_000
MIN_DOCS = 3
#: Words and pairs of shapes that a worker, or the driver that fits, remembers.
REMEMBERED = 100_000

WORDLIKE, RUN = re.compile(r"\w+"), re.compile(r"(.{1,3}?)\1{3,}")


def shape(token: str) -> str:
    """a for a word in lower case, A in upper, Aa capitalised, 0 for digits; signs stay; what repeats does so three times."""
    def kind(m: re.Match) -> str:
        x = m[0]
        if x.isdigit():
            return "0"
        if x.islower():
            return "a"
        if x.isupper():
            return "A" if len(x) > 1 else "Aa"
        return "Aa" if x[1:].islower() else "m"

    return RUN.sub(r"\1\1\1", WORDLIKE.sub(kind, token))


class OrdinalRegression:
    def __init__(self, bits: int = 16, epochs: int = 12, batch: int = 128, step: float = 0.5, shrink: float = 1e-4, seed: int = 11):
        self.bits, self.epochs, self.batch, self.step, self.shrink, self.seed = bits, epochs, batch, step, shrink, seed
        self.grades = np.zeros(1, dtype=np.int64)
        self.thresholds = np.zeros(0)
        self.weights = np.zeros(1 << bits)

    def term(self, name: str) -> int:
        return zlib.crc32(name.encode("utf-8")) & ((1 << self.bits) - 1)

    def vector(self, text: str, known: dict[str, tuple[str, int]], pairs: dict[tuple[str, str], int]) -> tuple[np.ndarray, np.ndarray]:
        tokens = text.split()
        if not tokens:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        counts = Counter(tokens)
        for t in counts:
            if t not in known:
                known[t] = (shape(t), self.term(f"w {t.lower()}"))
        shapes = [known[t][0] for t in tokens]
        ids: list[int] = []
        n: list[int] = []
        for t, c in counts.items():
            ids.append(known[t][1])
            n.append(c)
        for s, c in Counter(shapes).items():
            ids.append(self.term(f"s {s}"))
            n.append(c)
        for p, c in Counter(zip(shapes, shapes[1:], strict=False)).items():
            if p not in pairs:
                pairs[p] = self.term(f"p {p[0]} {p[1]}")
            ids.append(pairs[p])
            n.append(c)
        if len(known) > REMEMBERED:
            known.clear()
        if len(pairs) > REMEMBERED:
            pairs.clear()
        at, inverse = np.unique(np.array(ids, dtype=np.int64), return_inverse=True)
        return at.astype(np.int32), np.sqrt(np.bincount(inverse, weights=n) / len(tokens)).astype(np.float32)

    def vectors(self, texts: list[str], known: dict, pairs: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        got = [self.vector(t, known, pairs) for t in texts]
        lengths = np.array([len(i) for i, _ in got], dtype=np.int64)
        if not got:
            return np.empty(0, np.int32), np.empty(0, np.float32), lengths
        return np.concatenate([i for i, _ in got]), np.concatenate([x for _, x in got]), lengths

    def fit(self, rows: Iterable[tuple[str, int]]) -> OrdinalRegression:
        """rows are read once; only their vectors are held."""
        held_ids, held_x, lengths, given = array("i"), array("f"), array("q"), array("q")
        known, pairs = {}, {}
        for text, grade in rows:
            own, value = self.vector(text, known, pairs)
            held_ids.frombytes(own.tobytes())
            held_x.frombytes(value.tobytes())
            lengths.append(len(own))
            given.append(grade)
        if not given:
            return self
        ids, x, lengths = np.frombuffer(held_ids, dtype=np.int32), np.frombuffer(held_x, dtype=np.float32), np.array(lengths)
        self.grades, y = np.unique(np.array(given), return_inverse=True)
        steps = len(self.grades) - 1
        below = np.array([(y <= k).mean() for k in range(steps)])
        if not steps:
            return self
        x[(np.bincount(ids, minlength=1 << self.bits) < MIN_DOCS)[ids]] = 0
        starts, _ = ragged(lengths)
        # Thresholds are a first one and positive gaps, so that they stay ordered.
        first = np.log(below / (1 - below))
        free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
        seen_w, seen_t = np.full(1 << self.bits, 1e-2), np.full(steps, 1.0)
        rng = np.random.default_rng(self.seed)
        logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        for _ in range(self.epochs):
            order = rng.permutation(len(y))
            for k in range(0, len(order), self.batch):
                part = np.sort(order[k : k + self.batch])
                at = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in part])
                own, value = ids[at], x[at]
                _, row = ragged(lengths[part])
                z = np.bincount(row, weights=self.weights[own] * value, minlength=len(part))
                theta = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
                edge = np.concatenate([[-np.inf], theta, [np.inf]])
                up, low = logistic(edge[y[part] + 1] - z), logistic(edge[y[part]] - z)
                up[y[part] == steps], low[y[part] == 0] = 1.0, 0.0
                p = np.maximum(up - low, 1e-9)
                du, dl = up * (1 - up) / p, low * (1 - low) / p
                gz = (du - dl) / len(part) ** 0.5
                terms, inverse = np.unique(own, return_inverse=True)
                gw = np.bincount(inverse, weights=gz[row] * value, minlength=len(terms))
                seen_w[terms] += gw * gw
                w = self.weights[terms] - self.step * gw / np.sqrt(seen_w[terms])
                self.weights[terms] = np.sign(w) * np.maximum(np.abs(w) - self.shrink, 0)
                gt = np.zeros(steps)
                np.add.at(gt, np.minimum(y[part], steps - 1), np.where(y[part] < steps, -du, 0))
                np.add.at(gt, np.maximum(y[part] - 1, 0), np.where(y[part] > 0, dl, 0))
                gf = np.cumsum(gt[::-1])[::-1] / len(part) ** 0.5  # a gap moves all thresholds after it
                gf[1:] *= np.exp(free[1:])
                seen_t += gf * gf
                free -= 0.2 * self.step * gf / np.sqrt(seen_t)
        self.thresholds = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        return self

    def tails(self, texts: list[str], known: dict, pairs: dict) -> np.ndarray:
        """P(grade > grades[k]) for each text and threshold."""
        ids, x, lengths = self.vectors(texts, known, pairs)
        _, row = ragged(lengths)
        z = np.bincount(row, weights=self.weights[ids] * x, minlength=len(texts))
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -40, 40)))


def quality(docs: DataFrame, labels: DataFrame, *, grade: int | None = None, cut: float = 0.5, fit_rows: int = FIT_ROWS, **settings) -> DataFrame:
    """All columns of docs and a column quality__ (expected_grade; tail: P(grade >= `grade`), by default of the best grade; keep: tail >= cut).

    labels: doc_id, quality.
    """
    spark = docs.sparkSession
    small_batches(spark)
    fitted = OrdinalRegression(**settings).fit(training_rows(docs, labels, "quality", fit_rows))
    model = spark.sparkContext.broadcast(fitted)
    best = len(fitted.grades) - 1 if grade is None else int(np.searchsorted(fitted.grades, grade))
    kept = [c for c in docs.columns if c != "quality__"]
    text, expected_as, tail_as = (fresh(docs, n) for n in ("text__", "expected__", "tail__"))

    def graded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pairs, m = {}, {}, model.value
        for batch in batches:
            tails = m.tails(batch.column(0).to_pylist(), known, pairs)
            expected = m.grades[0] + tails @ np.diff(m.grades).astype(float)
            tail = np.ones(len(batch)) if best == 0 else tails[:, best - 1] if best <= tails.shape[1] else np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(expected), pa.array(tail)], [*kept, expected_as, tail_as])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    out = docs.select(text_col().alias(text), *[F.col(f"`{c}`") for c in kept]).mapInArrow(graded, f"{fields}, `{expected_as}` double, `{tail_as}` double")
    verdict = F.struct(F.col(expected_as).alias("expected_grade"), F.col(tail_as).alias("tail"), (F.col(tail_as) >= cut).alias("keep"))
    return out.select(*[F.col(f"`{c}`") for c in kept], verdict.alias("quality__"))


def accepted(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of docs that are kept."""
    return quality(docs, labels, **settings).where("quality__.keep").drop("quality__").select(*[F.col(f"`{c}`") for c in docs.columns])
