"""Toxicity of whole texts: a factorization machine over hashed terms.

A text is the set of its hashed terms: words in lower case and word beginnings of four and five
letters (which catch inflected forms). The score is the logistic of a bias, a weight per term and the
inner products of the factor vectors of all pairs of terms, divided by the number of the text's terms
that have factors (so a long text's many pairs don't drown its weights). The pairs are where an insult
next to a mention of a group counts for more than both alone.

Linear weights go to terms whose share of toxic training texts departs from the mean by a chi-square
test. Factors go to every term met in at least MIN_DOCS training texts, whatever it tells alone, since
a term may tell something only in a pair; a penalty on the length of each factor vector lets those
that no pair needs die out. The weights are fitted for WARM rounds first, then both together.

Defined results: a null or empty text has no terms and gets the bias alone; repeated rows get equal
scores; texts of any length are read whole; an empty table gives no rows; extra columns of either
table aren't read; without any labelled row the bias is that of one toxic text in twenty.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm._common import WORD, ragged, small_batches, text_col
from pagequarry.llm.labelled import held_out, training_rows

#: Labelled rows that the machine is fitted on at most.
FIT_ROWS = 10_000
MIN_DOCS = 3
#: Words whose terms a worker remembers.
REMEMBERED = 200_000


@dataclass
class FactorizationMachine:
    """Binary features; a follow-the-regularised-leader step with an absolute penalty for the linear
    weights, so that terms without steady evidence weigh nothing, and squared-gradient scaled steps
    with a penalty on their length for the factor vectors."""

    bits: int = 18
    factors: int = 4
    warm: int = 3
    epochs: int = 9
    batch: int = 64
    step: float = 0.5
    penalty: float = 2.0
    least_chi: float = 15.0
    factor_start: float = 0.3
    factor_step: float = 0.4
    factor_penalty: float = 0.03
    seed: int = 7
    bias: float = 0.0
    linear: np.ndarray = field(default=None, repr=False)  # type: ignore[assignment]
    #: A row for each factor, a column for each term.
    latent: np.ndarray = field(default=None, repr=False)  # type: ignore[assignment]
    live: np.ndarray = field(default=None, repr=False)  # type: ignore[assignment]

    def terms(self, word: str) -> list[int]:
        mask = (1 << self.bits) - 1
        names = [f"w {word}", *(f"{n} {word[:n]}" for n in (4, 5) if len(word) >= n)]
        return [zlib.crc32(x.encode("utf-8", "surrogatepass")) & mask for x in names]

    def features(self, texts: Iterable[str], known: dict[str, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """Hashed terms of all texts, each text's once and in order, and their number for each text."""
        ids: list[np.ndarray] = []
        for text in texts:
            own: set[int] = set()
            for word in set(WORD.findall(text.lower())):
                if (got := known.get(word)) is None:
                    got = known[word] = self.active(word)
                if got:
                    own.update(got)
            ids.append(np.sort(np.fromiter(own, dtype=np.int32, count=len(own))))
        if len(known) > REMEMBERED:
            known.clear()
        return np.concatenate(ids) if ids else np.empty(0, np.int32), np.array([len(x) for x in ids], dtype=np.int64)

    def active(self, word: str) -> tuple[int, ...]:
        """The terms of a word, once fitted those that weigh anything."""
        terms = self.terms(word)
        return tuple(terms if self.live is None else [t for t in terms if self.linear[t] != 0 or self.live[t]])

    def raw(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score before the logistic; the sums of factors and the number of terms with factors, for each text."""
        starts, _ = ragged(counts)
        sums, z, terms = np.zeros((self.factors, len(counts))), np.full(len(counts), self.bias), np.ones(len(counts))
        some = np.flatnonzero(counts)
        if len(some):
            at, squares = starts[:-1][some], np.zeros(len(some))
            for f in range(self.factors):
                v = self.latent[f][ids]
                sums[f, some] = np.add.reduceat(v, at, dtype=float)
                squares += np.add.reduceat(v * v, at, dtype=float)
            terms[some] = np.maximum(np.add.reduceat(self.live[ids], at, dtype=float), 1)
            z[some] += np.add.reduceat(self.linear[ids], at, dtype=float) + 0.5 * ((sums[:, some] ** 2).sum(axis=0) - squares) / terms[some]
        return z, sums, terms

    def fit(self, rows: Iterable[tuple[str, int]]) -> FactorizationMachine:
        """rows are read once; only their terms are held."""
        size, known = 1 << self.bits, {}
        held, lengths, given = array("i"), array("q"), array("d")
        for text, label in rows:
            own, _ = self.features([text], known)
            held.frombytes(own.tobytes())
            lengths.append(len(own))
            given.append(min(1, max(0, label)))
        met_in, counts, y = np.frombuffer(held, dtype=np.int32) if held else np.empty(0, np.int32), np.array(lengths, dtype=np.int64), np.array(given)
        self.bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 19)))
        owner = ragged(counts)[1].astype(np.int32)
        found = np.bincount(met_in, minlength=size)
        telling = self.telling(found, np.bincount(met_in, weights=y[owner], minlength=size), y)
        rng = np.random.default_rng(self.seed)
        self.linear, self.latent, self.live = np.zeros(size), np.zeros((self.factors, size)), np.zeros(size, dtype=bool)
        lead, seen_w, seen_v, seen_b = np.zeros(size), np.zeros(size), np.ones(size), 1.0
        for epoch in range(self.warm + self.epochs):
            if epoch == self.warm:
                self.live = found >= MIN_DOCS
                self.latent = rng.normal(0, self.factor_start, (self.factors, size)) * self.live
            own = (telling | self.live)[met_in]  # terms whose factors have died and that have no weight take no more part
            ids, counts = met_in[own], np.bincount(owner[own], minlength=len(y))
            starts, _ = ragged(counts)
            order = rng.permutation(len(y))
            for k in range(0, len(order), self.batch):
                part = np.sort(order[k : k + self.batch])
                met = np.concatenate([ids[starts[i] : starts[i + 1]] for i in part])
                z, sums, share = self.raw(met, counts[part])
                error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[part]
                _, at = ragged(counts[part])
                terms, inverse = np.unique(met, return_inverse=True)
                each = error[at]
                g = np.bincount(inverse, weights=each, minlength=len(terms)) * telling[terms]
                grown = seen_w[terms] + g * g
                lead[terms] += g - (np.sqrt(grown) - np.sqrt(seen_w[terms])) / self.step * self.linear[terms]
                seen_w[terms] = grown
                beyond = np.maximum(np.abs(lead[terms]) - self.penalty, 0)
                self.linear[terms] = -np.sign(lead[terms]) * beyond / ((1 + np.sqrt(grown)) / self.step)
                if epoch >= self.warm:
                    self.turn(terms, inverse, met, at, each / share[at], sums, seen_v)
                seen_b += error.sum() ** 2
                self.bias -= self.step * error.sum() / seen_b**0.5
        self.linear, self.latent = self.linear.astype(np.float32), self.latent.astype(np.float32)
        return self

    def turn(self, terms: np.ndarray, inverse: np.ndarray, met: np.ndarray, at: np.ndarray, error: np.ndarray, sums: np.ndarray, seen: np.ndarray) -> None:
        """A step of the factor vectors of the terms met in a batch; those that the penalty shortens to nothing die."""
        g = np.stack([np.bincount(inverse, weights=error * (sums[f][at] - self.latent[f][met]), minlength=len(terms)) for f in range(self.factors)])
        seen[terms] += (g * g).sum(axis=0)
        v = self.latent[:, terms] - self.factor_step * g / np.sqrt(seen[terms])
        length = np.sqrt((v * v).sum(axis=0))
        v *= np.maximum(1 - self.factor_step * self.factor_penalty / np.maximum(length, 1e-12), 0) * self.live[terms]
        self.latent[:, terms] = v
        self.live[terms] = (v != 0).any(axis=0)

    def telling(self, found: np.ndarray, toxic: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Terms in enough texts whose share of toxic ones departs from the mean (chi-square)."""
        share = min(max(y.mean(), 1e-6), 1 - 1e-6) if len(y) else 0.5
        expected = found * share
        chi = (toxic - expected) ** 2 / np.maximum(expected * (1 - share), 1e-9)
        return (found >= MIN_DOCS) & (chi >= self.least_chi)

    def score(self, texts: list[str], known: dict[str, tuple[int, ...]]) -> np.ndarray:
        z, _, _ = self.raw(*self.features(texts, known))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def toxicity(docs: DataFrame, labels: DataFrame, *, fit_rows: int = FIT_ROWS, **settings) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs; labels: doc_id, toxic."""
    spark = docs.sparkSession
    small_batches(spark)
    machine = spark.sparkContext.broadcast(FactorizationMachine(**settings).fit(training_rows(docs, labels, "toxic", fit_rows)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            score = machine.value.score(batch.column(1).to_pylist(), known)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", text_col().alias("text")).mapInArrow(scored, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
