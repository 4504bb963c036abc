"""Token counts of whole texts under a byte-level BPE vocabulary.

Pre-tokens of a batch become ragged integer arrays in numpy; in each round every sequence merges
all non-overlapping occurrences, from the left, of its own lowest-rank pair, until no pair of any
sequence has a rank. The surviving symbols are the tokens. Distinct pre-tokens are merged once and
their counts kept in a bounded table, so that a word costs one look-up.

Defined results: a null text counts as empty (0 tokens); special strings of the vocabulary are cut
out first and count as one token each, as the library does by default; texts of any length are counted
whole; repeated rows get equal counts; an empty table gives no rows; extra columns aren't read, whatever
their names; a vocabulary with another kind of pre-tokens or with a normaliser is an error.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm._common import ragged, small_batches, text_col

#: Splits text before the merges, as byte-level vocabularies of this family do.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Distinct pre-tokens whose counts a worker remembers; the table is emptied when it is full.
REMEMBERED = 1_000_000
#: Pre-tokens merged in one batch of arrays.
MERGE_BATCH = 65_536


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabulary files, and the bytes."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in kept}
    return out | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(kept))}


class BytePairCounter:
    """Counts tokens of texts; built once from the vocabulary file, its arrays go to the workers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or spec.get("normalizer"):
            raise ValueError(f"{path}: only byte-level vocabularies without normalisation are counted")
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.start = np.zeros(256, dtype=np.int64)
        for letter, b in letters.items():
            self.start[b] = vocab[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.width = int(max(vocab.values())) + 1
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.none = len(merges)
        special = sorted((x["content"] for x in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.special_strings = special
        self.known: dict[str, int] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of adjacent pairs; `none` where there is no such merge."""
        keys = left * self.width + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.ranks[at], self.none)

    def merged(self, words: list[bytes]) -> np.ndarray:
        """Symbols that survive in each word (none empty)."""
        count = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        symbols = self.start[np.frombuffer(b"".join(words), dtype=np.uint8)]
        out, owner = count.copy(), np.arange(len(words))
        while len(owner):
            starts, row = ragged(count)
            pair = np.full(len(symbols), self.none, dtype=np.int64)
            inner = row[:-1] == row[1:]
            pair[:-1][inner] = self.rank(symbols[:-1][inner], symbols[1:][inner])
            lowest = np.minimum.reduceat(pair, starts[:-1])
            live = lowest < self.none
            hit = (pair == lowest[row]) & live[row]
            # Of overlapping hits ("aaa"), those at even distance from the first of their run merge.
            at = np.flatnonzero(hit)
            if len(at):
                first = np.ones(len(at), dtype=bool)
                first[1:] = at[1:] != at[:-1] + 1
                run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
                symbols[at] = self.made[lowest[row[at]]]
            keep = live[row]  # words without a pair are done
            keep[at + 1] = False
            out[owner] = count - np.bincount(row[at], minlength=len(count))
            symbols, count, owner = symbols[keep], out[owner][live], owner[live]
        return out

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        todo = sorted(words, key=len)  # like lengths together: few rounds for the short ones
        for k in range(0, len(todo), MERGE_BATCH):
            part = todo[k : k + MERGE_BATCH]
            self.known.update(zip(part, self.merged([w.encode("utf-8") for w in part]).tolist(), strict=True))

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        split, extra = [], []
        for text in texts:
            n = 0
            if self.special is not None and any(s in text for s in self.special_strings):
                parts = self.special.split(text)
                n = len(parts) - 1
                split.append([w for part in parts for w in PRETOKEN.findall(part)])
            else:
                split.append(PRETOKEN.findall(text))
            extra.append(n)
        known, new = self.known, set()
        for words in split:
            new.update(words)
        missing = {w for w in new if w not in known}
        if missing:
            if len(known) + len(missing) > REMEMBERED:
                missing = new
            self.learn(missing)
        get = self.known.__getitem__
        return [n + sum(map(get, words)) for n, words in zip(extra, split, strict=True)]


def token_counts(docs: DataFrame, vocabulary: str, *, limit: int = 1024, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row; vocabulary is a path that the driver can read."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(BytePairCounter(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared.value
        for batch in batches:
            tokens = pa.array(counter.counts(batch.column(2).to_pylist()), type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.octet_length(text_col(text)).cast("long").alias("n_bytes"), text_col(text).alias("text"))
    out = narrow.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
