"""The parts that need no session, against brute force."""

import itertools
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagequarry.llm import mixing, near_duplicates, quality, secret_scan, sharding, suffix_dedup, token_counts, toxicity, vector_search

tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def counter():
    return token_counts.BytePairCounter(vocabularies.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabularies.path("byte_bpe_50k.json"))


PIECES = ["a", "aa", "é", " ", "\n", "\t", "<|endoftext|>", "'s", "１", "²", "😀", "ß", "中文", "don't", "  ", " ", "​", "x" * 50, "123", "<|end", "\r\n", "ǅ", "\x00", "\x85"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), max_size=8))
def test_tokens_as_the_library(counter, library, texts):
    assert counter.counts(texts) == [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_tokens_of_long_texts(counter, library):
    texts = ["a" * 4000, "ab" * 3000, " " * 999, "the quick brown fox " * 2000]
    assert counter.counts(texts) == [len(library.encode(t, add_special_tokens=False)) for t in texts]


# --- secrets -----------------------------------------------------------------------------------


def brute_spans(text):
    out = []
    for kind, p, ok in (
        ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), lambda m: len(m[2]) >= 12),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    ):
        out += [(*m.span(), kind) for m in p.finditer(text) if ok(m)]
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["password", "TOKEN", ": ", "=", '"', "abc123", "0123456789abcdef", "AKIA", "ABCD1234EFGH5678", " ", "é", "api_key", "x"]), max_size=14).map("".join))
def test_base_spans(text):
    assert sorted(secret_scan.base_spans(text)) == sorted(brute_spans(text))


GUESSES = secret_scan.GuessCosts(["yesterday", "correct", "horse"])


def test_guess_costs():
    bits = GUESSES.bits
    assert bits("password") < bits("Password1") < bits("letmein123") < 20
    assert bits("qwertyuiop") < 20 and bits("aaaaaaaaaa") < 15 and bits("abcabcabc") < 20 and bits("20240131") < 20
    assert bits("x9F$kq2LpZ") > 40 and bits("") == 0.0 and bits("x9F$kq2LpZ", 30.0) == 30.0
    assert bits("abcdefghouse") < bits("abcdefg") + bits("house") + 1e-9  # a walk may end early
    text = "pwd: x9F$kq2LpZ and pwd: password1"
    assert [text[a:b] for a, b, _ in secret_scan.guessed_spans(text, [], GUESSES, 40.0)] == ["x9F$kq2LpZ"]


def test_ranked_words_are_cheap():
    words = secret_scan.ranked_words(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))
    bits = secret_scan.GuessCosts(words).bits
    assert len(words) > 10_000 and max(map(bits, ("yesterday", "documentation", "happiness", "correcthorse"))) < 30
    text = "pass: yesterday secret: documents"
    assert secret_scan.guessed_spans(text, [], secret_scan.GuessCosts(words), 40.0) == []


def test_long_values_take_time_by_their_length():
    rng = random.Random(1)
    began = time.time()
    for unit in ("xy", "a", "abcd", "as", "0123456789", "yesterday"):
        value = unit * (200_000 // len(unit))
        assert 0 < GUESSES.bits(value, 40.0) <= 40.0
    assert GUESSES.bits("".join(rng.choices("abcdefXYZ0189$%", k=200_000)), 40.0) == 40.0
    assert secret_scan.guessed_spans("pwd=" + "xy" * 100_000, [], GUESSES, 40.0) == []
    assert time.time() - began < 20


def cheapest(value, rank):
    """The least cost over all segmentations, one by one, with the parts defined anew."""
    walks = {w for row in secret_scan.WALKS for r in (row, row[::-1]) for w in zip(r, r[1:])}
    brute = lambda c: math.log2(10 if c.isdigit() else 26 if c.isalpha() else 33)

    def part(x):
        low, costs = x.lower(), []
        if len(x) == 1:
            costs.append(brute(x))
        plain = low.translate(secret_scan.LEET)
        if len(x) >= 3 and plain in rank:
            costs.append(1 + math.log2(rank[plain] + 1) + (0 if x == low else 1 if x == low.upper() or x[1:] == low[1:] else len(x)) + (plain != low))
        if len(x) >= 3 and all(p in walks for p in zip(low, low[1:])):
            costs.append(1 + math.log2(len(secret_scan.WALKS) * 24) + math.log2(len(x)))
        for unit in (1, 2, 3, 4):
            times = len(x) // unit
            if times * unit == len(x) and times >= (3 if unit == 1 else 2) and low == low[:unit] * times:
                costs.append(1 + sum(map(brute, x[:unit])) + math.log2(times))
        for y, m, d in ([x[:4], x[4:-2], x[-2:]], [x[-4:], x[2:-4], x[:2]]):
            m = m.strip("-/._") if 2 <= len(m) <= 4 and re.fullmatch(r"[-/._]?\d\d[-/._]?", m) else ""
            if re.fullmatch(r"(19|20)\d\d", y, re.A) and m and 1 <= int(m) <= 12 and re.fullmatch(r"\d\d", d, re.A) and 1 <= int(d) <= 31 and len(x) >= 8:
                costs.append(1 + math.log2(365 * 130))
        if re.fullmatch(r"(19|20)\d\d", x, re.A):
            costs.append(1 + math.log2(130))
        return min(costs, default=math.inf)

    best = math.inf
    for cuts in itertools.product([0, 1], repeat=len(value) - 1):
        at = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(value)]
        best = min(best, sum(part(value[i:j]) for i, j in zip(at, at[1:])))
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["dog", "D0G", "Pass", "a", "aa", "xy", "1", "9", "qwe", "asd", "2024", "01", "31-", "$", "ab"]), min_size=1, max_size=5).map(lambda x: "".join(x)[:11]))
def test_guess_costs_are_the_least(value):
    costs = secret_scan.GuessCosts(["dog"])
    assert math.isclose(costs.bits(value), cheapest(value, costs.rank))


# --- packing -------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 500), min_size=1, max_size=60), st.integers(1, 8))
def test_packing(sizes, bins):
    sizes = sorted(sizes, reverse=True)
    placed = sharding.pack(sizes, bins)
    loads = Counter()
    for s, b in zip(sizes, placed, strict=True):
        loads[b] += s
    assert set(placed) <= set(range(bins))
    # Best fit decreasing at the capacity found stays within 3/2 of the lower bounds.
    assert max(loads.values()) <= 1.5 * max(sizes[0], -(-sum(sizes) // bins)) + 1


def test_tightest_bin():
    assert sharding.best_fit_decreasing([6, 5, 4, 3], 10, 2) == [0, 1, 0, 1]
    assert sharding.best_fit_decreasing([6, 6, 6], 10, 2) is None


# --- mixing ---------------------------------------------------------------------------------------


def test_shortages_go_to_siblings_first():
    tokens = {("a", "x"): 10, ("a", "y"): 1000, ("b", "z"): 1000}
    got = mixing.budgets(tokens, {}, 400, 1)
    assert got[("a", "x")] == 10 and got[("a", "y")] == pytest.approx(190) and got[("b", "z")] == pytest.approx(200)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.tuples(st.sampled_from("ab"), st.sampled_from("xy"), st.sampled_from("123")), st.integers(0, 100), min_size=1), st.integers(0, 1000), st.integers(1, 3))
def test_budgets_add_up(tokens, budget, epochs):
    got = mixing.budgets(tokens, {("a",): 3.0, ("b", "y"): 0.5}, budget, epochs)
    assert all(-1e-6 <= v <= tokens[k] * epochs + 1e-6 for k, v in got.items())
    assert sum(got.values()) == pytest.approx(min(budget, epochs * sum(tokens.values())), abs=1e-3)


# --- suffix arrays -----------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab\x00", min_size=1, max_size=80))
def test_suffix_array(text):
    b = text.encode()
    sa = suffix_dedup.suffix_array(np.frombuffer(b, dtype=np.uint8))
    assert sa.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
    common = lambda x, y: next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
    lcp = suffix_dedup.common_prefixes(np.frombuffer(b, dtype=np.uint8), sa)
    assert lcp.tolist() == [0] + [common(b[i:], b[j:]) for i, j in zip(sa, sa[1:], strict=False)]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    passage = bytes(rng.randrange(97, 101) for _ in range(700))
    texts = [bytes(rng.randrange(97, 101) for _ in range(rng.randint(0, 900))) + passage + bytes(rng.randrange(97, 101) for _ in range(300)) for _ in range(3)]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    text, first, last, place, hashed = suffix_dedup.anchors(np.frombuffer(b"".join(texts), dtype=np.uint8), starts)
    owner = {}
    for t, a, z, p, h in zip(text, first, last, place, hashed, strict=True):
        for w in range(a, z + 1):
            owner[t, w] = (int(p) - w, int(h))
    width = suffix_dedup.PASSAGE
    assert len(owner) == sum(max(0, len(t) - width + 1) for t in texts)
    at = [t.index(passage) for t in texts]
    for k in range(701 - width):
        assert len({owner[i, at[i] + k] for i in range(3)}) == 1


def test_pieces_of_long_texts_change_no_anchor(monkeypatch):
    rng = random.Random(4)
    texts = [bytes(rng.randrange(97, 100) for _ in range(n)) for n in (0, 255, 256, 257, 999, 5000, 12000, 300)]

    def anchored():
        batch = pa.RecordBatch.from_arrays([pa.array([bytes([k]) for k in range(len(texts))]), pa.array(texts)], ["row_key", "text"])
        out = {}
        for got in suffix_dedup._anchored(iter([batch])):
            for r in got.to_pylist():
                assert r["stop"] == min(r["last"] + suffix_dedup.WINDOW, len(texts[r["row_key"][0]]))
                for w in range(r["first"], r["last"] + 1):
                    assert out.setdefault((r["row_key"], w), (r["place"], r["anchor"])) == (r["place"], r["anchor"])
        return out

    whole = anchored()
    assert len(whole) == sum(max(0, len(t) - suffix_dedup.PASSAGE + 1) for t in texts)
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    assert anchored() == whole


def test_both_widths_of_repeats():
    rng = random.Random(6)
    passage = bytes(rng.randrange(97, 123) for _ in range(500))
    snippets = [passage[k : k + n] + bytes(rng.randrange(97, 123) for _ in range(rng.randint(0, 80))) for k, n in ((0, 500), (10, 420), (100, 300), (0, 450), (200, 256))]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in snippets])])
    for width, snippet, offset, count in suffix_dedup.repeated(np.frombuffer(b"".join(snippets), dtype=np.uint8), starts, np.array([60] * 5), (400, 256)):
        got = dict(zip(zip(snippet.tolist(), offset.tolist()), count.tolist(), strict=True))
        windows = {(i, k): x[k : k + width] for i, x in enumerate(snippets) for k in range(min(60, len(x) - width + 1))}
        times = Counter(windows.values())
        assert got == {at: times[w] for at, w in windows.items()}


def test_windows_are_compared_around_their_anchors(monkeypatch):
    """All repeated windows of both widths are found, and one suffix a region is sorted to either side, not one a byte."""
    rng = random.Random(8)
    junk = lambda n, letters=b"abc\0": bytes(rng.choice(letters) for _ in range(n))
    passage = junk(900)
    texts = [junk(rng.randint(0, 300)) + passage[rng.randint(0, 300) : rng.randint(500, 900)] + junk(rng.randint(0, 300)) for _ in range(12)]
    texts += [b"ab" * 350, b"\0" * 500, b"\0" * 420 + junk(40), passage, passage[:255], passage[:256], passage[-400:]]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = suffix_dedup.anchors(np.frombuffer(b"".join(texts), dtype=np.uint8), starts)
    regions = sorted(zip(*(x.tolist() for x in found), strict=True), key=lambda r: (np.int64(np.uint64(r[4]).view(np.int64)), r[0], r[1]))
    stop = [min(z + suffix_dedup.WINDOW, len(texts[i])) for i, _, z, *_ in regions]
    columns = {
        "row_key": pa.array([bytes([i]) for i, *_ in regions], pa.binary()),
        **{c: pa.array([r[k] for r in regions], pa.int32()) for k, c in ((1, "first"), (2, "last"), (3, "place"))},
        "anchor": pa.array(np.array([r[4] for r in regions], dtype=np.uint64).view(np.int64)), "wanted": pa.array([True] * len(regions)),
        "bytes": pa.array([texts[r[0]][r[1] : end] for r, end in zip(regions, stop, strict=True)], pa.binary()),
    }
    batch = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    of, sorted_ = suffix_dedup.suffix_array, []
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda *a: sorted_.append(len(out := of(*a))) or out)
    for block in (1 << 20, 2000):
        monkeypatch.setattr(suffix_dedup, "BLOCK", block)
        sorted_.clear()
        got = {400: set(), 256: set()}
        for out in suffix_dedup._sorted_shards(iter([batch.slice(k, 7) for k in range(0, len(regions), 7)])):
            for r in out.to_pylist():
                got[r["width"]] |= {(r["row_key"][0], k) for k in range(r["begin"], r["end"] - r["width"] + 1)}
        assert sum(sorted_) == 2 * len(regions)
        for width, own in got.items():
            windows = {(i, k): t[k : k + width] for i, t in enumerate(texts) for k in range(len(t) - width + 1)}
            times = Counter(windows.values())
            assert own == {at for at, w in windows.items() if times[w] > 1}


# --- vectors --------------------------------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 300), st.integers(1, 9), st.sampled_from([1, 3, 100, 10**6, 10**7]))
def test_bounds_hold_and_exclude_no_best(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    v, ids = rng.integers(-spread, spread + 1, (n, dim)), rng.permutation(n).astype(np.int64)
    q_ids, q = ids[:3], v[:3]
    scan = vector_search.Scan(q_ids, q, 5)
    left = [set() for _ in q_ids]
    for k in range(0, n, 64):
        part = v[k : k + 64]
        who, at, lower, upper = scan.block(ids[k : k + 64], *vector_search.approximation(part))
        exact = (part[at] * q[who]).sum(axis=1)
        assert ((lower <= exact) & (exact <= upper)).all()
        for i, j, u in zip(who.tolist(), at.tolist(), upper.tolist(), strict=True):
            left[i].add((int(ids[k + j]), u))
    for i in range(len(q_ids)):
        best = sorted(((-int(v[j] @ q[i]), int(ids[j])) for j in range(n) if ids[j] != q_ids[i]))[:5]
        assert {j for _, j in best} <= {j for j, u in left[i] if u >= scan.kth[i]}


def test_few_vectors_are_left():
    rng = np.random.default_rng(3)
    v = np.floor(rng.normal(0, 1000, (20_000, 16))).astype(np.int64)
    scan = vector_search.Scan(np.arange(10), v[:10], 5)
    who, at, lower, upper = scan.block(np.arange(len(v)), *vector_search.approximation(v))
    assert (upper > lower).any() and len(who) < 10 * 100


# --- signatures ---------------------------------------------------------------------------------------------


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    for keep in (0.95, 0.7, 0.3):
        n = int(len(base) * keep)
        other = np.sort(np.concatenate([base[:n], rng.integers(0, 2**63, len(base) - n).astype(np.uint64)]))
        truth = n / (2 * len(base) - n)
        a, b = near_duplicates.signatures([base, other], 2000)
        assert abs((a == b).mean() - truth) < 0.05
    assert not near_duplicates.signatures([np.empty(0, np.uint64)], 8).any()


def test_regions_count_repeats():
    s = near_duplicates.Shingles()
    assert len(s.regions("a b c d e f")) == 2 and len(s.regions("a a a a a a a")) == 3 and len(s.regions("two words")) == 1 and not len(s.regions("... !"))
    assert set(s.regions("A, b c d E")) == set(s.regions("a b c d e"))


# --- classifiers ------------------------------------------------------------------------------------------------


def made(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_factorization_machine_learns():
    rng = random.Random(1)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(1500):
        text = made(rng, words, rng.randint(5, 80))
        rows.append((text + (f" scum{rng.choice('abc')}" if k % 5 == 0 else ""), int(k % 5 == 0)))
    m = toxicity.FactorizationMachine().fit(rows[:1200])
    score = m.score([t for t, _ in rows[1200:]] + ["", "never seen"], {})
    assert ((score[:-2] >= 0.5).astype(int) == [y for _, y in rows[1200:]]).mean() > 0.99
    assert 0 < score[-2] < 0.5 and np.isfinite(score).all()
    assert np.isfinite(toxicity.FactorizationMachine().fit([]).score(["", "x"], {})).all()


def test_pairs_of_terms_count():
    """Terms that tell nothing alone, with the default settings: only the factors can know, and without them nothing is known."""
    rng = random.Random(2)
    words = [f"w{k:03d}x" for k in range(300)]
    rows = []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        own = [*rng.choices(words, k=25), rng.choice(["insulting", "rude"] if a else ["polite", "kind"]), rng.choice(["groupa", "folk"] if b else ["tree", "stone"])]
        rng.shuffle(own)
        rows.append((" ".join(own), int(a == b)))
    m = toxicity.FactorizationMachine().fit(rows[:2400])
    texts, y = [t for t, _ in rows[2400:]], np.array([y for _, y in rows[2400:]])
    with_pairs = ((m.score(texts, {}) >= 0.5) == y).mean()
    assert with_pairs > 0.95
    m.latent[:] = 0
    without = ((m.score(texts, {}) >= 0.5) == y).mean()
    assert without < 0.6


def test_pairs_beside_weights():
    """An insult and a mention of a group that are harmless alone, in mostly clean texts."""
    rng = random.Random(2)
    rows = []
    for _ in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((" ".join([*(["insulting"] if a else []), *(["grouping"] if b else []), made(rng, ["x1", "x2", "x3", "x4"], 3)]), int(a and b)))
    m = toxicity.FactorizationMachine().fit(rows)
    score = m.score(["insulting x1 x2", "grouping x1 x2", "insulting grouping x1 x2"], {})
    assert score[2] > 0.5 > max(score[:2])


def test_ordinal_regression_learns_three_grades():
    rng = random.Random(4)
    words = [f"word{k}" for k in range(50)]
    rows = []
    for k in range(1500):
        g = k % 3
        rows.append((" ".join(w + ("!!" if rng.random() < (0.8, 0.4, 0.0)[g] else "") for w in made(rng, words, 40).split()), g))
    m = quality.OrdinalRegression().fit(rows[:1200])
    assert (np.diff(m.thresholds) > 0).all()
    tails = m.tails([t for t, _ in rows[1200:]], {}, {})
    assert (np.diff(tails, axis=1) <= 1e-12).all()
    assert (np.rint(tails.sum(axis=1)).astype(int) == [g for _, g in rows[1200:]]).mean() > 0.9
    assert quality.OrdinalRegression().fit([]).tails(["a"], {}, {}).shape == (1, 0)
    assert quality.OrdinalRegression().fit([("a", 1)] * 5).tails(["a", ""], {}, {}).shape == (2, 0)


def test_shapes():
    assert quality.shape("HELLO!!!!!!") == "A!!!" and quality.shape("Abc,") == "Aa," and quality.shape("|") == "|"


# --- crowds -------------------------------------------------


@pytest.mark.parametrize("n, span", [(1, 5), (5, 9), (60, 40), (90, 3000)])
def test_common_regions(n, span):
    rng = random.Random(n)
    lists = [np.array(sorted(rng.sample(range(span), rng.randint(0, min(span, 80)))), dtype=np.int64) for _ in range(n)]
    expected = [[len(set(a.tolist()) & set(b.tolist())) for b in lists] for a in lists]
    got = near_duplicates.common(lists)
    off = ~np.eye(n, dtype=bool)
    assert (got[off] == np.array(expected)[off]).all()


def test_joining_links_join_what_all_links_join():
    rng = random.Random(4)
    lists = [np.array(sorted(rng.sample(range(30), rng.randint(20, 29))), dtype=np.int64) for _ in range(50)]
    root = [bytes([k % 20]) for k in range(50)]

    def classes(pairs):
        of = {r: r for r in root}
        for i, j in pairs:
            x, y = of[root[i]], of[root[j]]
            of = {r: x if c == y else c for r, c in of.items()}
        return {frozenset(r for r in of if of[r] == c) for c in of.values()}

    def near(i, j):
        a, b = set(lists[i].tolist()), set(lists[j].tolist())
        return len(a & b) >= 0.8 * len(a | b)

    found = list(zip(*near_duplicates.joining_links(root, lists, 0.8), strict=True))
    assert all(near(i, j) and root[i] != root[j] for i, j in found) and len(found) < 20
    assert classes(found) == classes((i, j) for i in range(50) for j in range(i) if near(i, j))
