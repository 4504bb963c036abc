"""Removal of passages of at least WINDOW bytes that occur more than once, by suffix arrays per shard.

Texts are UTF-8 bytes. Strings are judged at two lengths: those of WINDOW bytes are removed, those of
PASSAGE bytes (about fifty words) are reported. Every string of PASSAGE bytes has an anchor: the least
hash among the GRAM-byte strings in it (the leftmost of equal ones). Equal strings have equal anchors,
and so have longer ones that begin alike, so all that must be compared lies in regions around anchors
whose hash occurs more than once:

1. Each text's anchors are found by rolling hashes; a region is what the PASSAGE-byte strings of one
   anchor cover, and goes on as far as WINDOW-byte strings that begin in it reach.
2. Equal regions are one region that occurs several times, and are repeated throughout; sums over their
   digests show it, whatever the number of copies.
3. What is left are distinct regions of an anchor, where repeated passages begin and end. They go to
   shards by their anchor. Equal strings lie alike around it, so a shard needs only two sparse suffix
   arrays: the suffixes that begin at anchors, and backwards those that end there (not the suffix of
   each byte). They are sorted by refinement (groups of equal prefixes, eight bytes longer each time,
   until all are single), and the common prefixes of neighbours are measured. Those that a string
   agrees with before its anchor and those it agrees with from there on are runs of the two arrays;
   strings are equal if both runs are.
4. An anchor with more distinct regions than a shard takes is decided across shards. Its windows are
   taken in blocks of STEP, aligned at the anchor: a block whose bytes occur twice is repeated as a
   whole; one whose core, the bytes that all its windows hold, occurs once holds no repeated window.
   What is left open is merged by the digests of its windows, by binary search in sorted runs.
5. Each text loses the union of its repeated windows.

Defined results: a null text counts as empty; texts shorter than WINDOW lose nothing; a passage that
repeats inside one text, overlapping itself included, counts; rows equal in id and text count as two
occurrences; texts of any length are read whole, in pieces of PIECE bytes; an empty table gives no rows;
extra columns aren't read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm._common import mix64, row_key, scratch, small_batches, text_col, written

WINDOW = 400
PASSAGE = 256
GRAM = 64
#: Distinct regions of one anchor in a shard at most.
REGIONS = 1024
#: Windows of a block.
STEP = 32
#: Bytes whose suffixes are sorted at once (whole groups of one anchor: a block may exceed it by one group).
BLOCK = 1 << 20
#: Windows of a long text, and bytes of several short ones, whose anchors are found at once.
PIECE = 1 << 20

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
HIGH = np.uint64(0xFFFFFFFF00000000)


def rolling(b: np.ndarray, width: int) -> np.ndarray:
    """A hash of the `width` bytes from each position (modulo 2^64)."""
    n = len(b) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    powers = np.full(len(b), BASE)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
    back = np.full(n, INVERSE)
    back[0] = 1
    np.cumprod(back, out=back)
    return mix64((sums[width:] - sums[:-width]) * back)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each `width` neighbours."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(b: np.ndarray, starts: np.ndarray, window: int = PASSAGE, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, last window, place, hash) of each anchor in texts that lie one after another in b from `starts`."""
    lengths = np.diff(starts)
    hashes = rolling(b, gram)
    width = window - gram + 1
    if len(hashes) < width:
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)
    least = sliding_min((hashes & HIGH) | np.arange(len(hashes), dtype=np.uint64), width)
    at = (least & ~HIGH).astype(np.int64)
    windows = np.maximum(lengths - window + 1, 0)
    text = np.repeat(np.arange(len(lengths)), windows)
    before = np.cumsum(windows) - windows
    p = np.arange(windows.sum()) - before[text] + starts[:-1][text]
    at = at[p]
    new = np.ones(len(p), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    offset = starts[:-1][text[first]]
    return text[first], p[first] - offset, p[last] - offset, at[first] - offset, hashes[at[first]]


def eights(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, as one number that orders like them."""
    padded = np.concatenate([b, np.zeros(8, dtype=np.uint8)])
    return np.ndarray(len(b), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)


def suffix_array(b: np.ndarray, at: np.ndarray | None = None, group: np.ndarray | None = None, depth: int | None = None) -> np.ndarray:
    """Starts of all suffixes of b in order; or the indices of those that start `at`, in the order of their group and of their first `depth` bytes."""
    n = len(b)
    at = np.arange(n) if at is None else at
    group = np.zeros(len(at), dtype=np.int64) if group is None else group
    order = np.argsort(group, kind="stable")
    words = np.append(eights(b), np.uint64(0))
    slot, new = np.arange(len(at)), np.ones(len(at), dtype=bool)
    new[1:] = group[order[1:]] != group[order[:-1]]
    for h in range(0, n if depth is None else depth, 8):
        # Slots of classes whose bytes up to h are equal.
        shared = ~(new & np.append(new[1:], True))
        slot, new = slot[shared], new[shared]
        if not len(slot):
            break
        own = order[slot]
        ahead = np.minimum(at[own] + h, n)
        # Of suffixes that end within the next eight bytes the shorter comes first (bytes of 0 look like the padding).
        word, left = words[ahead], np.minimum(n - ahead, 8)
        kind = np.cumsum(new) - 1
        differ = np.flatnonzero(~new[1:] & ((word[1:] != word[:-1]) | (left[1:] != left[:-1])))
        torn = np.zeros(kind[-1] + 1, dtype=bool)
        torn[kind[differ]] = True
        i = np.flatnonzero(torn[kind])
        i_sorted = i[np.lexsort((left[i], word[i], kind[i]))]
        order[slot[i]] = own[i_sorted]
        x, y = i_sorted[1:], i_sorted[:-1]
        new[i[1:]] = (word[x] != word[y]) | (left[x] != left[y]) | (kind[x] != kind[y])
    return order


def common_prefixes(b: np.ndarray, sa: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Length of the common prefix (up to `depth` bytes) of each suffix and the one before it in order (0 for the first); of all suffixes or of some."""
    n = len(b)
    a, c = sa[1:], sa[:-1]
    length, most = np.zeros(len(a), dtype=np.int64), np.minimum(n - np.maximum(a, c), n if depth is None else depth)
    words = np.append(eights(b), np.uint64(0))
    todo = np.arange(len(a))
    while len(todo):
        x, y = words[np.minimum(a[todo] + length[todo], n)], words[np.minimum(c[todo] + length[todo], n)]
        differ = x ^ y
        whole = differ == 0
        # Equal leading bytes of the two numbers.
        bits = np.zeros(len(todo), dtype=np.int64)
        rest = differ[~whole]
        same = np.zeros(len(rest), dtype=np.int64)
        for k in range(1, 8):
            same += (rest >> np.uint64(64 - 8 * k)) == 0
        bits[~whole], bits[whole] = same, 8
        length[todo] = np.minimum(length[todo] + bits, most[todo])
        todo = todo[whole & (length[todo] < most[todo])]
    return np.append(0, length)


def alike(common: np.ndarray, place: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the suffixes at these places of a sorted array, of which `common` has the common prefixes: the first one that
    agrees with each in `depth` bytes, and whether others do."""
    least = depth.min(initial=0)
    depths = np.arange(least, depth.max(initial=0) + 1)
    first = np.where(common[:, None] < depths, np.arange(len(common), dtype=np.int32)[:, None], np.int32(0))
    own = np.maximum.accumulate(first, axis=0)[place, depth - least]
    return own.astype(np.int64), (own != place) | (np.append(common[1:], -1)[place] >= depth)


def repeated(b: np.ndarray, starts: np.ndarray, firsts: np.ndarray, widths: tuple[int, ...], anchor: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each width: the windows that begin in the first `firsts[i]` bytes of snippet i and end in it (their snippet and
    offset), and the number of equal ones. The snippets lie one after another in b from `starts`. `anchor` has the place
    and the hash of the anchor that all windows of a snippet share; without it anchors are found.

    Equal windows lie alike around equal anchors. So two windows are equal if they begin as far before their anchors, and
    their regions agree as far to the left and, from the anchor, as far to the right as they reach."""
    lengths = np.diff(starts)
    if anchor is None:
        snippet, low, high, place, hashed = anchors(b, starts)
    else:
        snippet, low, high, (place, hashed) = np.arange(len(lengths)), np.zeros(len(lengths), dtype=np.int64), firsts - 1, anchor
    at, high = starts[snippet] + place, np.minimum(high, firsts[snippet] - 1)
    sides = []
    for text, begin, depth in ((b[::-1], len(b) - at, int((place - low).max(initial=0))), (b, at, max(widths))):
        order = suffix_array(text, begin, hashed, depth)
        common = common_prefixes(text, begin[order], depth)
        common[np.append(True, hashed[order[1:]] != hashed[order[:-1]])[: len(order)]] = -1
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        sides.append((common, rank))
    for width in widths:
        windows = np.clip(np.minimum(high, lengths[snippet] - width) - low + 1, 0, None)
        region = np.repeat(np.arange(len(windows)), windows)
        offset = np.arange(len(region)) - (np.cumsum(windows) - windows - low)[region]
        back = place[region] - offset
        (left, more), (right, more_) = (alike(common, rank[region], depth) for (common, rank), depth in zip(sides, (back, width - back), strict=True))
        count = np.ones(len(region), dtype=np.int64)
        some = np.flatnonzero(more & more_)
        _, own, times = np.unique((back[some] * len(windows) + left[some]) * len(windows) + right[some], return_inverse=True, return_counts=True)
        count[some] = times[own]
        yield width, snippet[region], offset, count


def runs(owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, first, last) of runs of consecutive numbers with one owner; sorted."""
    if not len(at):
        return owner, at, at
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return owner[first], at[first], at[np.append(first[1:], len(at)) - 1]


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (row, offset, bytes) of about PIECE bytes; a long text's pieces overlap by what a window reaches."""
    group: list[tuple[int, int, bytes]] = []
    size = 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - PASSAGE + 1), PIECE):
            piece = t[at : at + PIECE + PASSAGE - 1]
            if group and size + len(piece) > PIECE + PASSAGE:
                yield group
                group, size = [], 0
            group.append((i, at, piece))
            size += len(piece)
    if group:
        yield group


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for group in _pieces(texts):
            starts = np.concatenate([[0], np.cumsum([len(x) for *_, x in group])]).astype(np.int64)
            piece, first, last, place, hashed = anchors(np.frombuffer(b"".join(x for *_, x in group), dtype=np.uint8), starts)
            row, offset = (np.array([x[k] for x in group], dtype=np.int64)[piece] for k in (0, 1))
            first, last, place = first + offset, last + offset, place + offset
            stop = np.minimum(last + WINDOW, np.array([len(t) for t in texts], dtype=np.int64)[row])
            digest = [blake2b(texts[r][i:j], digest_size=16).digest() for r, i, j in zip(row.tolist(), first.tolist(), stop.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), *(pa.array(x.astype(np.int32)) for x in (first, last, place, stop)), pa.array(hashed.view(np.int64)), pa.array(digest, pa.binary())],
                ["row_key", "first", "last", "place", "stop", "anchor", "region"],
            )


def _sorted_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row_key, first, last, place, anchor, wanted, bytes) come in the order of their anchor: blocks of whole groups, each with its suffix arrays."""

    def block(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        column = {c: t[c].chunk(0) for c in ("row_key", "bytes")} if t.num_rows else {}
        first, last, place, anchor, wanted = (t[c].to_numpy() for c in ("first", "last", "place", "anchor", "wanted"))
        own = column["bytes"]
        offsets = np.frombuffer(own.buffers()[1], dtype=np.int32)[own.offset : own.offset + len(own) + 1].astype(np.int64)
        b = np.frombuffer(own.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        for width, snippet, offset, count in repeated(b, offsets - offsets[0], (last - first + 1).astype(np.int64), (WINDOW, PASSAGE), ((place - first).astype(np.int64), anchor)):
            who, a, z = runs(*(x[(count > 1) & wanted[snippet].astype(bool)] for x in (snippet, offset)))
            spans = (first[who] + a, first[who] + z + width, np.full(len(who), width))
            yield pa.RecordBatch.from_arrays([column["row_key"].take(pa.array(who)), *(pa.array(x.astype(np.int32)) for x in spans)], ["row_key", "begin", "end", "width"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= BLOCK:
            t = pa.Table.from_batches(held)
            anchor = t["anchor"].to_numpy()
            before = np.flatnonzero(anchor != anchor[-1])
            if len(before):
                cut = int(before[-1]) + 1
                yield from block(t.slice(0, cut))
                held = t.slice(cut).combine_chunks().to_batches()
            size = sum(x.nbytes for x in held)
    if sum(map(len, held)):
        yield from block(pa.Table.from_batches(held))


def crowded(snippets: DataFrame, width: int) -> DataFrame:
    """Repeated windows of a width among regions (row_key, first, last, place, stop, wanted, bytes) of anchors that one shard can't take."""
    snippets = snippets.withColumn("last", F.least("last", F.col("stop") - width)).where("last >= first")
    span = lambda begin, length: F.substring("bytes", begin - F.col("first") + 1, length)
    step = F.lit(STEP)
    block = F.explode(F.sequence(F.floor((F.col("place") - F.col("last")) / step), F.floor((F.col("place") - F.col("first")) / step)))
    cut = snippets.withColumn("block", block).withColumn("core_at", (F.col("place") - F.col("block") * step).cast("int"))
    cut = cut.withColumn("low", F.greatest(F.col("first"), F.col("core_at") - (STEP - 1))).withColumn("high", F.least("last", "core_at"))
    digest = lambda begin, length, note: F.unhex(F.md5(F.concat(span(begin, length), note.cast("string").cast("binary"))))
    cut = cut.select(
        "row_key", "low", "high", "wanted", span(F.col("low"), F.col("high") - F.col("low") + width).alias("bytes"),
        digest(F.col("low"), F.col("high") - F.col("low") + width, F.col("place") - F.col("low")).alias("hull"), digest(F.col("core_at"), F.lit(width - STEP + 1), F.col("block")).alias("core"),
    )
    cut = written(cut, "blocks")
    hulls = cut.groupBy("hull").agg(F.count(F.lit(1)).alias("n"), F.first("core").alias("core"), F.min(F.struct("row_key", "low")).alias("one"))
    hulls = written(hulls, "hulls")
    several = hulls.groupBy("core").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    whole = cut.where("wanted").join(hulls.where("n > 1").select("hull"), "hull", "left_semi").select("row_key", F.col("low").alias("begin"), (F.col("high") + width).alias("end"))
    # One block of each kind whose core occurs in other kinds too, window by window; of those that occur once it is asked.
    open_ = hulls.join(several.select("core"), "core", "left_semi").select("one.row_key", "one.low", (F.col("n") == 1).alias("single"))
    asked = cut.join(open_, ["row_key", "low"]).withColumn("begin", F.explode(F.sequence("low", "high")))
    asked = asked.select("row_key", "begin", (F.col("begin") + width).cast("int").alias("end"), F.unhex(F.md5(F.substring("bytes", F.col("begin") - F.col("low") + 1, F.lit(width)))).alias("digest"), (F.col("single") & F.col("wanted")).alias("open"))
    merged = asked.repartition("digest").sortWithinPartitions("digest").mapInArrow(_merged, "row_key binary, begin int, end int")
    return whole.union(merged).withColumn("width", F.lit(width))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in the order of the digest: an open window with a partner is repeated."""
    rest: pa.Table | None = None

    def found(t: pa.Table) -> pa.RecordBatch:
        digests = np.array(t["digest"].to_pylist(), dtype="S16")
        partners = np.searchsorted(digests, digests, side="right") - np.searchsorted(digests, digests, side="left")
        t = t.filter(pa.array((partners > 1) & t["open"].to_numpy())).select(["row_key", "begin", "end"]).combine_chunks()
        return pa.RecordBatch.from_arrays([t[c].combine_chunks() if t.num_rows else pa.array([], t.schema.field(c).type) for c in t.schema.names], ["row_key", "begin", "end"])

    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t])
        digests = t["digest"].to_pylist()
        cut = len(digests)
        while cut and digests[cut - 1] == digests[-1]:
            cut -= 1
        rest = t.slice(cut)
        if cut:
            yield found(t.slice(0, cut))
    if rest is not None and rest.num_rows:
        yield found(rest)


def covered(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal runs of the union of (begin, end)."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            removed = covered([(s["begin"], s["end"]) for s in spans or () if s["width"] == WINDOW])
            passages = covered([(s["begin"], s["end"]) for s in spans or ()])
            edges = [0, *(x for r in removed for x in r), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if removed else text
            for of, x in zip(out, (len(text), len(text) - len(kept), len(removed), sha256(kept).hexdigest(), sum(b - a for a, b in passages), kept), strict=True):
                of.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(out, kinds, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_bytes", "kept"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """row_key, begin, end (bytes) and width of repeated windows, in runs that may overlap."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(row_key().alias("row_key"), text_col().cast("binary").alias("text"))
    long_enough = texts.where(F.length("text") >= PASSAGE)
    found = written(long_enough.mapInArrow(_anchored, "row_key binary, first int, last int, place int, stop int, anchor long, region binary"), "anchors")
    regions = written(found.groupBy("anchor", "region").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row_key", "first", "last", "place", "stop")).alias("one")), "regions")
    copied = regions.where("n > 1").select("region")
    wide = F.col("stop") - F.col("first") >= WINDOW
    whole = found.join(copied, "region").select("row_key", F.col("first").alias("begin"), F.when(wide, F.col("stop")).otherwise(F.col("last") + PASSAGE).alias("end"), F.when(wide, WINDOW).otherwise(PASSAGE).alias("width"))
    # Anchors with several regions, some of which occur once: those are wanted, one of each of the others is a partner.
    several = regions.groupBy("anchor").agg(F.count(F.lit(1)).alias("regions"), F.min("n").alias("least")).where("regions > 1 and least = 1")
    partly = regions.join(several.select("anchor", "regions"), "anchor").select("one.*", "anchor", (F.col("regions") > REGIONS).alias("crowd"), (F.col("n") == 1).alias("wanted"))
    partly = written(partly, "partly")
    piece = F.substring("text", F.col("first") + 1, F.col("stop") - F.col("first"))
    snippets = partly.join(texts, "row_key").select("row_key", "first", "last", "place", "stop", "anchor", "crowd", "wanted", piece.alias("bytes")).dropDuplicates(["row_key", "first"])
    snippets = written(snippets, "snippets")
    dealt = snippets.where("not crowd").select("row_key", "first", "last", "place", "anchor", "wanted", "bytes").repartition("anchor").sortWithinPartitions("anchor", "row_key", "first")
    out = whole.union(dealt.mapInArrow(_sorted_shards, "row_key binary, begin int, end int, width int"))
    crowds = snippets.where("crowd")
    if not crowds.isEmpty():
        for width in (WINDOW, PASSAGE):
            out = out.union(crowded(crowds, width))
    return out


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_bytes (bytes of PASSAGE-byte strings that also start elsewhere) and kept (the remaining bytes) of every row."""
    with scratch(docs.sparkSession):
        spans = repeated_spans(docs).groupBy("row_key").agg(F.collect_set(F.struct("begin", "end", "width")).alias("spans"))
        spans = written(spans, "spans", keep=True)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", row_key().alias("row_key"), text_col().cast("binary").alias("text")).join(spans, "row_key", "left")
    fields = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_bytes long, kept binary"
    return rows.select("doc_id", "text", "spans").mapInArrow(_cut, fields)
