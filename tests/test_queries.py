"""Every query with SQL against DuckDB on the smallest tables; the others give rows."""

import datetime
import os
import random

import pytest

import __spark_entry__
from pagequarry.plans.catalogue import ORACLES, QUERIES, Tables
from pagequarry.plans.table_pages import customers

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    if name not in ORACLES:
        assert got
        return
    rows = duck.execute(ORACLES[name]).fetchall()
    names = [d[0] for d in duck.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in rows)


def written(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_overlap_links(spark, tmp_path):
    """Rows of any order and line number, by brute force."""
    rng = random.Random(2)
    rows = [(9000 + k // 7, k % 7 + 1, rng.randint(1, 30), rng.randint(1, 3)) for k in range(200)]
    folder = written(spark, tmp_path, "lineitem", rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long")
    spans = [(g, o * 10 + n, p * 37 % 20000, p * 37 % 20000 + n * 9) for o, n, p, g in rows]
    expected = {(x[0], x[1], y[1]) for x in spans for y in spans if x[0] == y[0] and x[1] < y[1] and x[2] < y[3] and y[2] < x[3]}
    assert expected and {tuple(r) for r in QUERIES["overlap_links"](spark, folder).collect()} == expected


def test_live_diff(spark, tmp_path):
    rows = [(k, k % 7, ("a", "b", "c")[k % 3]) for k in range(30)] + [(36, 90, "a"), (37, 91, "a"), (90, 92, "b"), (91, 92, "b")]
    folder = written(spark, tmp_path, "events", rows, "event_id long, user_id long, event_type string")
    sides = [{(u, e) for k, u, e in rows if k % 2 == odd} for odd in (0, 1)]
    expected = {(*x, "unmodified" if x in sides[0] & sides[1] else "deleted" if x in sides[0] else "added") for x in sides[0] | sides[1]}
    assert {tuple(r) for r in QUERIES["live_diff"](spark, folder).collect()} == expected


def test_release_drift(spark, tmp_path):
    rows = [(1, "A"), (2, "A"), (7, "A"), (1, "N"), (5, "R")]
    folder = written(spark, tmp_path, "lineitem", rows, "l_linenumber int, l_returnflag string")
    assert {tuple(r) for r in QUERIES["release_drift"](spark, folder).collect()} == {("A", 3, 2, 0.5), ("R", 1, 0, 1.0)}


def test_name_pairs_whole(spark, tmp_path):
    """Names that differ in the first letter too, by brute force."""
    rng = random.Random(4)
    names = {"lantern", "mantern", "banana", "canana", "ab", "bb", "", "x"} | {"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(60)}
    folder = written(spark, tmp_path, "part", [(n,) for n in names], "p_name string")

    def grams(n):
        padded = f"##{n}##"
        return {padded[k : k + 3] for k in range(len(padded) - 2)}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    pairs = [(a, b, grams(a), grams(b)) for a in names for b in names if a < b]
    sharing = [(a, b, g, h) for a, b, g, h in pairs if g & h]
    expected = {
        "ngram_jaccard": {(a, b): len(g & h) / len(g | h) for a, b, g, h in sharing},
        "ngram_dice": {(a, b): 2 * len(g & h) / (len(g) + len(h)) for a, b, g, h in sharing},
        "ngram_overlap": {(a, b): len(g & h) / min(len(g), len(h)) for a, b, g, h in sharing},
        "levenshtein_ratio": {(a, b): 1 - distance(a, b) / max(len(a), len(b)) for a, b, _, _ in pairs if 3 * distance(a, b) <= max(len(a), len(b))},
    }
    for name, want in expected.items():
        got = {(r.a, r.b): r.score for r in QUERIES[name](spark, folder).collect()}
        assert got == pytest.approx(want, abs=1e-6)
        assert ("lantern", "mantern") in got


def test_constructs_validate_of_odd_balances(spark, tmp_path):
    """zero with a sign isn't below zero, what is no number is above all, and a missing balance fails."""
    rows = [(1, "a#1", -0.0, "s"), (2, "a#2", 0.0, "s"), (3, "a#3", -1.5, "s"), (4, "a#4", None, "s"), (5, "a#5", float("nan"), "s")]
    folder = written(spark, tmp_path, "customer", rows, "c_custkey long, c_name string, c_acctbal double, c_mktsegment string")
    import duckdb

    c = duckdb.connect()
    c.execute(f"create view customer as select * from read_parquet('{folder}/customer.parquet/*.parquet')")
    got = {tuple(r) for r in QUERIES["constructs_validate"](spark, folder).select("test", "covered", "valid").collect()}
    assert got == set(c.execute(ORACLES["constructs_validate"]).fetchall()) == {("iri", 15, 9), ("number", 5, 3)}


def test_lines_in_sections_are_those_of_the_text(spark, tmp_path):
    """lines as the operator counts them, without fixed values."""
    folder = written(spark, tmp_path, "customer", [(1, "BUILDING", 5)], "c_custkey long, c_mktsegment string, c_nationkey int")
    source = customers(Tables(spark, folder)).first()["source"].split("\n")
    at = lambda x: next(k for k, line in enumerate(source) if x in line)
    expected = {(None, at("http://c1.")), (None, at("http://bank.")), ("Account", at("http://a1.") - at("== Account"))}
    assert {(r.section, r.relative) for r in QUERIES["lines_in_sections"](spark, folder).collect()} == expected


def test_units_are_read_in_many_tasks(spark, tmp_path):
    """lines of a single file are dealt out."""
    folder = written(spark, tmp_path, "lineitem", [(k, 1, 5.0) for k in range(50)], "l_orderkey long, l_linenumber int, l_quantity double")
    spark.read.parquet(f"{folder}/lineitem.parquet").coalesce(1).write.parquet(f"{folder}/one/lineitem.parquet")
    out = QUERIES["numbers_with_units"](spark, f"{folder}/one")
    assert out.rdd.getNumPartitions() >= 4 and {(r.value, r.unit) for r in out.collect()} == {(5.0, "kg")}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
