"""Each operator on awkward tables (nulls, empty and long texts, ties, repeats, clashing columns, no rows) and against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from pagequarry.llm import mixing, near_duplicates, sharding
from pagequarry.llm.decontamination import clean, leaks
from pagequarry.llm.mixing import DEFAULT_WEIGHTS, DOMAINS, budgets, default_levels, mix
from pagequarry.llm.near_duplicates import classes, deduplicated
from pagequarry.llm.quality import accepted, quality
from pagequarry.llm.secret_scan import secret_scan
from pagequarry.llm.sharding import shards
from pagequarry.llm.suffix_dedup import without_repeats
from pagequarry.llm.token_counts import token_counts
from pagequarry.llm.toxicity import toxicity
from pagequarry.llm.vector_search import top_k

vocabularies = pytest.importorskip("public_tokenizers")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, key string, tokens string, node string, bucket string, root string, draw string, n int, row_key string, text_key string, `range` string, key__ string, text__ string, expected__ string, tail__ string, epoch int, whole string, rest string, edge string, `row` string, label int, window string, `raw` string"
#: Names that the operators use themselves, with values that none of them must read.
EXTRA = (1, "s", "k", "t", "n", "b", "r", "d", 2, "rk", "tk", "x", "kk", "tt", "ee", "ta", 3, "w", "re", "ed", "ro", 4, "wi", "ra")


def frame(spark, rows):
    full = [(i, t, lang, src, None if t is None else len(t), *EXTRA) for i, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA)


WORDS = [f"{a}{b}" for a in ("ba", "co", "di", "fu", "ge", "ha", "lo", "mi") for b in ("r", "st", "nd", "le", "ther", "mo", "x")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


ITEMS = ["if Anna has 12 apples and buys 30 kg of pears for 12 friends how much does each of them carry home", "tiny item", None, ""]


def awkward():
    rng = random.Random(11)
    base = prose(rng, 150)
    near = base.split()
    near[70] = "changed"
    passage = prose(rng, 110)
    other = ITEMS[0].replace("12", "7").replace("30", "45").replace("Anna", "Marta")
    broken = ITEMS[0].replace("12 apples", "7 apples").replace("12 friends", "8 friends")
    texts = [
        None, "", "   ", "one", "two words", "x" * 3000, base, base, " ".join(near), f"{prose(rng, 40)} {passage} {prose(rng, 40)}", f"{passage} {prose(rng, 60)}", prose(rng, 4000),
        f"before {ITEMS[0]} after", f"before then {other} after", f"before then {broken} after", "Tiny item", "password = abcdefghijkl pwd: zX9$kq!72Lpw", "é ﬀ 中文 😀 \x00 end\x00\x00", "ab" * 600,
    ]
    rows = [(k, t, ("en", "de", None)[k % 3], ("src1", "src2", None)[k % 3]) for k, t in enumerate(texts)]
    return [*rows, rows[6], (None, base, "en", "src1"), (None, None, None, None), (3, "another of id three", "en", "src1")]


ROWS = awkward()


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, (k % 4 > 0) * 1, (k % 5 == 1) * 1) for k in range(19)] + [(7, None, None), (None, 1, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(k, t) for k, t in enumerate(ITEMS)] + [(0, ITEMS[0]), (None, "a b c d e f g h")], "item_id long, text string")


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    path = vocabularies.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    got = Counter(tuple(r) for r in token_counts(docs, path).collect())
    expect = lambda i, x: (i, len(x.encode()), (n := len(t.encode(x, add_special_tokens=False))), n > 1024)
    assert got == Counter(expect(i, x or "") for i, x, *_ in ROWS)
    assert token_counts(empty, path).count() == 0


def test_leaks(docs, empty, benchmark):
    got = {(r.doc_id, r.item_id, r.reparameterised) for r in leaks(docs, benchmark).collect()}
    assert got == {(12, 0, False), (13, 0, True), (15, 1, False)}
    kept = clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3
    assert leaks(empty, benchmark).count() == 0 and clean(empty, benchmark).count() == 0
    assert leaks(docs, benchmark.limit(0)).count() == 0


def test_leaks_of_plain_passages(spark):
    """Without placeholders: the containment of five-word windows, by brute force."""
    rng = random.Random(5)
    items = [(k, prose(rng, rng.randint(5, 40))) for k in range(12)]
    texts = []
    for k in range(60):
        w = items[k % 12][1].split()
        cut = w[: max(1, int(len(w) * rng.choice([0.2, 0.5, 0.85, 1.0])))]
        texts.append((k, " ".join([prose(rng, rng.randint(0, 30)), *cut, prose(rng, rng.randint(0, 30))]).strip()))
    expected = set()
    for d, t in texts:
        words = t.split()
        have = defaultdict(set)
        for p in range(len(words) - 4):
            have[tuple(words[p : p + 5])].add(p)
        for i, x in items:
            w = x.split()
            n = len(w) - 4
            found = [k for k in range(n) if tuple(w[k : k + 5]) in have]
            run = best = 0
            for k in range(n):
                run = run + 1 if k in found else 0
                best = max(best, run)
            if len(found) >= 0.8 * n or best >= 9:
                expected.add((d, i))
    got = leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == expected


def leaking(spark, item, text):
    got = leaks(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(2, item)], "item_id long, text string"))
    return got.count() == 1


NUMBERS = {"three", "four", "five", "seven"}
UNIT_WORDS = {"kg", "km", "litres"}
PLACES = {"The", "How", "In"}


def brute_leaks(docs, items):
    """Leaks with slots, from the docstring: typed words, windows, diagonals, torn values, containment and runs."""
    def typed(words, k, names=True):
        w = words[k]
        is_number = lambda x: x.isdigit() or x.lower() in NUMBERS
        if is_number(w):
            return "<n>"
        if w.lower() in UNIT_WORDS and k and is_number(words[k - 1]):
            return "<u>"
        return "<name>" if names and w.istitle() and w not in PLACES else w.lower()

    def inside(words, k):
        before = words[k - 1] if k else ""
        after_word = k and (before[-1].islower() or before[-1].isdigit())
        return typed(words, k) if not words[k].istitle() or after_word else typed(words, k, names=False)

    found = set()
    slots = {"<n>", "<u>", "<name>"}
    for i, item in items:
        iw = item.split()
        low = [w.lower() for w in iw]
        forms = {"template": [typed(iw, k) for k in range(len(iw))], "inside": [inside(iw, k) for k in range(len(iw))]}
        n = len(iw) - 4
        proves = lambda form: sum(w not in slots for w in form) >= 2
        rich = {a for a in range(n) if proves(forms["template"][a : a + 5])}
        for d, text in docs:
            dw = text.split()
            dl, dt = [w.lower() for w in dw], [typed(dw, k) for k in range(len(dw))]
            diagonals = defaultdict(list)
            for p in range(len(dw) - 4):
                for a in range(n):
                    exact = dl[p : p + 5] == low[a : a + 5]
                    for form in {tuple(f[a : a + 5]) for f in forms.values()} | {tuple(low[a : a + 5])}:
                        plain = list(form) == low[a : a + 5]
                        if (plain or proves(form)) and list(form) in (dl[p : p + 5], dt[p : p + 5]):
                            shown = forms["template"][a : a + 5] if plain else form
                            pairs = {(shown[k], low[a + k], dl[p + k]) for k in range(5) if shown[k] in slots}
                            diagonals[p - a].append((a, exact, pairs))
            at, best, reparameterised = set(), 0, False
            for matches in diagonals.values():
                values = defaultdict(set)
                for _, _, pairs in matches:
                    for kind, x, y in pairs:
                        values[kind, x].add(y)
                torn = {k for k, v in values.items() if len(v) > 1}
                good = [m for m in matches if m[1] or not any((kind, x) in torn for kind, x, _ in m[2])]
                own = {m[0] for m in good}
                at |= own
                reparameterised |= any(x != y for m in good for _, x, y in m[2])
                run = [sum(1 for _ in g) for _, g in itertools.groupby(sorted(own), key=lambda a, c=itertools.count(): a - next(c))]
                best = max([best, *run])
            share = max(len(at) / n, len(at & rich) / len(rich) if rich else 0)
            if share >= 0.8 or best >= 9:
                found.add((d, i, reparameterised))
    return found


def test_leaks_by_brute_force(spark):
    """Copies with other numbers, names and units, whole, cut, torn and mixed with prose."""
    rng = random.Random(8)
    vocabulary = ["the", "of", "carries", "boats", "to", "market", "and", "then", "sells", "How", "In", "The"]
    fill = lambda: rng.choice([str(rng.randint(2, 40)), rng.choice(sorted(NUMBERS)), rng.choice(["Anna", "Marta", "Jon"]), f"{rng.randint(2, 9)} kg", f"{rng.randint(2, 9)} km"])
    items, docs = [], []
    for k in range(10):
        words = []
        for _ in range(rng.randint(6, 16)):
            words += rng.choices(vocabulary, k=rng.randint(1, 3)) + ([fill()] if rng.random() < 0.7 else [])
        items.append((k, " ".join(words)))
    for k in range(60):
        words = items[k % 10][1].split()
        values = {}
        for j, w in enumerate(words):
            if w.isdigit() and rng.random() < 0.9:
                words[j] = values.setdefault(w, str(rng.randint(50, 99))) if rng.random() < 0.8 else str(rng.randint(50, 99))
            elif w in ("Anna", "Marta", "Jon"):
                words[j] = values.setdefault(w, rng.choice(["Lena", "Ivo"]))
        cut = words[: max(5, int(len(words) * rng.choice([0.5, 0.9, 1.0])))]
        docs.append((k, " ".join([*rng.choices(vocabulary, k=rng.randint(0, 5)), *cut, *rng.choices(vocabulary, k=rng.randint(0, 5))])))
    got = leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    expected = brute_leaks(docs, items)
    assert {(r.doc_id, r.item_id, r.reparameterised) for r in got.collect()} == expected
    assert len(expected) > 20 and any(r for *_, r in expected) and len({d for d, *_ in expected}) < len(docs)


def test_leaks_with_torn_slots(spark):
    """Equal words count whatever the slots say; two item values may get one document value."""
    rng = random.Random(3)
    tail = prose(rng, 50)
    assert leaking(spark, f"we saw 12 boats and then 12 more {tail}", f"we saw 12 boats and then 8 more {tail}")
    assert leaking(spark, "she has 3 red apples and then buys 4 green pears at the market", "she has 5 red apples and then buys 5 green pears at the market")


def test_leaks_of_names_and_numbers_anywhere(spark):
    item = "Anna has 12 apples. Anna buys 30 more. How many apples does Anna have?"
    other = item.replace("Anna", "Marta").replace("12", "7").replace("30", "45")
    for before in ("", "some text\n", 'he said "', "so then "):
        assert leaking(spark, item, before + other)
    assert leaking(spark, "How many legs has a spider", "so tell me How many legs has a spider and why")
    assert leaking(spark, "Suppose Anna walks to the old mill", "so suppose Marta walks to the old mill")
    assert leaking(spark, "a farmer keeps three goats on the hill", "a farmer keeps five goats on the hill")
    assert not leaking(spark, item, "Marta has 7 dogs. Marta sold 45 of them. Where are the dogs of Marta now?")


def test_leaks_of_short_and_literal_poor_items(spark):
    assert leaking(spark, "3 14 15 92 65 35", "the digits are 3 14 15 92 65 35 and so on")
    assert leaking(spark, "What is 7 + 8?", "the teacher asked them what is 7 + 8 and left")
    assert not leaking(spark, "3 14 15 92 65 35", "the digits are 2 71 82 81 82 84 and so on")
    assert not leaking(spark, "What is 7 + 8?", "the teacher asked them what is 7 + 9 and left")


def test_toxicity(docs, empty, labels):
    got = toxicity(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) for r in got)
    assert toxicity(empty, labels).count() == 0 and toxicity(docs, labels.limit(0)).count() == len(ROWS)


def test_held_out_labels_teach_nothing(spark):
    rows = [(k, f"word{k % 3} " + ("scum" if k % 4 == 0 else "fine"), None, None) for k in range(200)]
    d = frame(spark, rows)
    held = lambda k: zlib.crc32(str(k).encode()) % 5 == 0
    right = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(200)], "doc_id long, toxic int")
    wrong = spark.createDataFrame([(k, int(k % 4 == 0) ^ int(held(k))) for k in range(200)], "doc_id long, toxic int")
    scores = lambda x: {r.doc_id: round(r.score, 9) for r in toxicity(d, x).collect()}
    assert scores(right) == scores(wrong)


def test_quality(docs, empty, labels):
    out = quality(docs, labels)
    assert out.columns == [*docs.columns, "quality__"] and out.count() == len(ROWS)
    assert all(0 <= r.quality__.tail <= 1 and r.quality__.keep == (r.quality__.tail >= 0.5) for r in out.collect())
    assert accepted(docs, labels).columns == docs.columns
    assert accepted(empty, labels).count() == 0 and accepted(docs, labels.limit(0)).count() == len(ROWS)


def test_sharding(docs, empty):
    got = shards(docs, count=5).collect()
    assert len(got) == len(ROWS) and all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 5 for r in got)
    sizes = Counter((r.doc_id, r["size"], r.text_crc32) for r in got)
    assert sizes == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in ROWS)
    slots = defaultdict(list)
    where = defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        where[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in where.values())
    assert shards(empty, count=5).count() == 0


def test_sharding_is_even(spark):
    rng = random.Random(1)
    d = frame(spark, [(k, prose(rng, rng.randint(1, 60)), None, None) for k in range(800)])
    for fine in (512, 4):  # each group an item, and small ones in bundles
        loads = Counter()
        for r in shards(d, count=8, fine=fine).collect():
            loads[r.shard] += r["size"]
        assert max(loads.values()) <= (1.01 if fine == 512 else 1.25) * sum(loads.values()) / 8


def test_secrets(docs, empty):
    got = {(r.doc_id, r.spans): r for r in secret_scan(docs).collect()}
    found = next(r for r in got.values() if r.doc_id == 16)
    assert found.n_assign == 1 and [(s.kind, s.value) for s in found.found] == [("assign", "password = abcdefghijkl"), ("guess", "zX9$kq!72Lpw")]
    assert found.base_sha256 == hashlib.sha256(b"assign:0:23").hexdigest()
    assert secret_scan(docs).count() == len(ROWS) and secret_scan(empty).count() == 0


@pytest.mark.parametrize("epochs, part", [(1, 1.0), (1, 0.5), (3, 2.0)])
def test_mixing(spark, epochs, part):
    rng = random.Random(7)
    rows = [(k, prose(rng, rng.randint(1, 30)), rng.choice(["en", "de"]), f"src{rng.choice([0, 0, 0, 1, 2, 3])}") for k in range(900)]
    d = frame(spark, rows)
    got = mix(d, levels=default_levels(), weights=DEFAULT_WEIGHTS, budget_share=part, max_epochs=epochs, seed=3).collect()
    held, longest = Counter(), Counter()
    leaf = lambda lang, src: (DOMAINS[zlib.crc32(src.encode()) % 4], lang, src)
    for _, t, lang, src in rows:
        n = len(t.split())
        held[leaf(lang, src)] += n
        longest[leaf(lang, src)] = max(longest[leaf(lang, src)], n)
    goal = budgets(held, DEFAULT_WEIGHTS, sum(held.values()) * part, epochs)
    taken, times = Counter(), Counter()
    for r in got:
        m = r.mix__
        taken[m.domain, m.lang, m.source] += m.tokens
        times[r.doc_id] += 1
    assert all(abs(taken[k] - v) <= longest[k] for k, v in goal.items()) and max(times.values()) <= epochs
    again = mix(d.repartition(5), levels=default_levels(), weights=DEFAULT_WEIGHTS, budget_share=part, max_epochs=epochs, seed=3)
    assert Counter(r.doc_id for r in again.collect()) == times


@pytest.mark.parametrize("epochs, part", [(1, 0.37), (2, 1.3)])
def test_mixing_row_by_row(spark, epochs, part):
    """Every row and its epoch, by brute force: the prefix of each leaf's order of draws, equal rows included."""
    rng = random.Random(17)
    rows = [(k, prose(rng, rng.randint(0, 25)), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None])) for k in range(500)]
    rows += [rows[3]] * 7 + [(None, "x y", "en", "a")] * 3
    got = Counter((r.doc_id, r.text, r.mix__.epoch) for r in mix(frame(spark, rows), levels=default_levels(), weights=DEFAULT_WEIGHTS, budget_share=part, max_epochs=epochs, seed=5).collect())
    leaves = defaultdict(list)
    for i, t, lang, src in rows:
        domain = "(none)" if src is None else DOMAINS[zlib.crc32(src.encode()) % 4]
        leaves[domain, lang or "(none)", src or "(none)"].append((i, t, len(t.split())))
    held = {leaf: sum(n for *_, n in of) for leaf, of in leaves.items()}
    goal = budgets(held, DEFAULT_WEIGHTS, sum(held.values()) * part, epochs)
    expected = Counter()
    for leaf, of in leaves.items():
        n = held[leaf]
        whole = int(goal[leaf] // n) if n else int(goal[leaf] > 0 or part >= 1)
        rest = goal[leaf] - whole * n
        if n and n - rest < 1e-6 * n:
            whole, rest = whole + 1, 0.0
        whole = min(whole, epochs)
        for e in range(whole):
            expected.update((i, t, e) for i, t, _ in of)
        if rest > 0 and whole < epochs:
            def order(row):
                key = hashlib.md5(f"{'-' if row[0] is None else row[0]}:{row[1]}".encode()).digest()
                return hashlib.md5(f"5:{whole}:{key.hex().upper()}".encode()).hexdigest(), key

            upto = 0
            for i, t, tokens in sorted(of, key=order):
                upto += tokens
                if upto - tokens / 2 <= rest:
                    expected[i, t, whole] += 1
    assert got == expected


def test_mixing_awkward(docs, empty):
    out = mix(docs, levels=default_levels(), weights={}, budget_share=1.0, max_epochs=1)
    assert out.columns == [*docs.columns, "mix__"] and out.count() == len(ROWS)
    assert mix(empty, levels=default_levels(), weights={}).count() == 0
    assert mixing.share(10, {"a": 0.0, "b": 1.0}, {"a": 5, "b": 3}) == {"a": 0.0, "b": 3}


def brute_repeats(rows, window=400, passage=256):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]

    def covered(width):
        seen = Counter(t[k : k + width] for _, t in texts for k in range(len(t) - width + 1))
        for _, t in texts:
            hit = bytearray(len(t))
            for k in range(len(t) - width + 1):
                if seen[t[k : k + width]] > 1:
                    hit[k : k + width] = b"\1" * width
            yield hit

    out = []
    for (i, t), hit, near in zip(texts, covered(window), covered(passage), strict=True):
        kept = bytes(c for c, h in zip(t, hit, strict=True) if not h)
        out.append((i, len(t), sum(hit), len(re.findall(b"\1+", bytes(hit))), hashlib.sha256(kept).hexdigest(), sum(near)))
    return Counter(out)


@pytest.mark.parametrize("regions", [1024, 2])
def test_repeats(spark, docs, empty, regions, monkeypatch):
    from pagequarry.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "REGIONS", regions)
    rng = random.Random(9)
    passage = prose(rng, 140)
    more = [(100 + k, f"{prose(rng, rng.randint(0, 90))} {passage[rng.randint(0, 200) :]} {prose(rng, rng.randint(0, 90))}", None, None) for k in range(25)]
    d = docs.unionByName(frame(spark, more))
    got = Counter(tuple(r) for r in without_repeats(d).drop("kept").collect())
    assert got == brute_repeats([*ROWS, *more])
    if regions == 1024:
        assert without_repeats(empty).count() == 0


def test_vectors(spark):
    rng = random.Random(2)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(6)]) for k in range(300)]
    rows += [(1000, [0.0] * 6), (1001, [0.0] * 6), (1002, None), (1003, [float("nan")] * 6), (1004, [float("inf"), *[0.0] * 5]), (1005, [None, *[1.0] * 5]), (1006, []), (1007, [1.0, 2.0]), (None, [1.0] * 6), rows[3]]
    v = spark.createDataFrame([(i, x, 1) for i, x in rows], "vec_id long, embedding array<float>, label int")
    got = [tuple(r) for r in top_k(v.where("vec_id % 50 = 0"), v, block=64, query_block=2).orderBy("query_id", "rank").collect()]
    import numpy as np

    whole = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in x]) for i, x in rows if i is not None and x and all(c is not None and np.isfinite(c) for c in x)]
    expected = []
    for q, x in sorted({(i, tuple(x)) for i, x in whole if i % 50 == 0}):
        best = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in whole if i != q and len(y) == len(x))[:5]
        expected += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert got == expected
    assert top_k(v.limit(0), v).count() == 0 and top_k(v.where("vec_id = 50"), v.limit(0)).count() == 0
    beyond = spark.createDataFrame([(1, [1e9]), (2, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="exceeds"):
        top_k(beyond, beyond).count()


def brute_classes(rows, least=0.8):
    def bag(t):
        w = re.findall(r"\w+", (t or "").lower())
        n = min(5, len(w))
        return Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else None

    bags = [bag(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            same = (rows[a][1] or "") == (rows[b][1] or "")
            if not same and bags[a] and bags[b]:
                both = sum((bags[a] & bags[b]).values())
                same = both >= least * (sum(bags[a].values()) + sum(bags[b].values()) - both)
            if same:
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = defaultdict(list)
    for k, r in enumerate(rows):
        groups[find(k)].append(r[0])
    return [[(i, min((x for x in g if x is not None), default=None)) for i in g] for g in groups.values()]


def near_rows():
    rng = random.Random(21)
    rows = list(ROWS)
    for g in range(4):
        base = prose(rng, 120).split()
        for k in range(25):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            rows.append((200 + 25 * g + k, " ".join(w), "en", "src1"))
    return rows


def test_near_duplicates(spark, empty):
    rows = near_rows()
    d = frame(spark, rows)
    groups = brute_classes(rows)
    assert Counter((r.doc_id, r.class_id) for r in classes(d).select("doc_id", "class_id").collect()) == Counter(x for g in groups for x in g)
    kept = deduplicated(d)
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(str(g[0][1]) for g in groups)
    assert classes(empty).count() == 0 and deduplicated(empty).count() == 0


@pytest.mark.parametrize("part", [1024, 16])
def test_near_duplicates_in_crowds(spark, monkeypatch, part):
    """Pairs inside a crowd that shares most of its text are found, also where it is dealt into parts."""
    monkeypatch.setattr(near_duplicates, "SMALL", 2)
    monkeypatch.setattr(near_duplicates, "PART_NODES", part)
    rng = random.Random(8)
    shared = prose(rng, 70).split()
    rows = []
    for k in range(40):
        own = [*shared, *prose(rng, 30).split()]
        rows.append((2 * k, " ".join(own), None, None))
        own[-1] = "other"
        rows.append((2 * k + 1, " ".join(own), None, None))
    got = {r.doc_id: r.class_id for r in classes(frame(spark, rows)).collect()}
    assert got == {i: c for g in brute_classes(rows) for i, c in g}


def test_pipeline(spark, tmp_path, labels, benchmark):
    d = frame(spark, near_rows())
    d.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs, counts = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out-{name}"))
        docs = spark.read.parquet(str(tmp_path / f"out-{name}"))
        counts.append(docs.count())
        if name != "sharding":
            assert docs.columns == d.columns
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > 0
    assert Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == Counter(map(tuple, docs.collect()))


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)] * 3, [(k, t, "en", "s") for k, t in enumerate([None, "", " ", "x" * 200_000, "same words here as there", "same words here as there"])]])
def test_pipeline_of_awkward_tables(spark, tmp_path, labels, benchmark, rows):
    """No rows, nulls alone, and empty and very long texts, with clashing names, through all stages."""
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(out) <= len(rows) and all(r.slot is not None for r in out)


def test_results_keep_the_columns_that_clash(spark, docs, labels, benchmark):
    whole = {tuple(r) for r in docs.collect()}
    for kept in (accepted(docs, labels), deduplicated(docs), clean(docs, benchmark), mix(docs, levels=default_levels(), weights={}).drop("mix__")):
        assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} <= whole


def test_nothing_is_left_behind(spark, docs):
    """Tables that only lead to a result are gone when it is there; those that it reads stay."""
    import os

    home = spark.conf.get("spark.checkpoint.dir") + "/pagequarry"
    before = set(os.listdir(home)) if os.path.isdir(home) else set()
    assert classes(docs.select("doc_id", "text")).count() == without_repeats(docs).count() == len(ROWS)
    left = {x.rpartition("-")[0] for x in set(os.listdir(home)) - before}
    assert left == {"least", "roots", "spans"}


def test_bins_hold():
    assert sharding.pack([], 4) == []
