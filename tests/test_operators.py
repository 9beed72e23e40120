"""Core operators against direct computation on small tables, and the query registry."""

import importlib
import random
import sys

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators import boxes as B
from millrace.operators import catalog as C
from millrace.operators import lines as L
from millrace.operators import repeats as R
from millrace.operators import stages as K
from millrace.operators import web as U


def test_latest_and_ties(spark):
    rows = [("a", "1", "2020", "x"), ("a", "1", "2021", "y"), ("a", "1", "2021", "z"), ("a", "2", None, "n"), ("b", "1", "", "e")]
    df = spark.createDataFrame(rows, "version string, id string, t string, v string")
    got = {(r.version, r.id): r.v for r in C.latest(df, ["version", "id"], F.col("t"), [F.col("v")]).collect()}
    assert got == {("a", "1"): "z", ("a", "2"): "n", ("b", "1"): "e"}


def test_ranked_equals_the_window(spark):
    r = random.Random(1)
    rows = [("hot" if r.random() < 0.7 else r.choice(["b", None]), f"{r.randint(0, 10**6):07d}-{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "version string, id string")
    want = {(x.version, x.id): x.n for x in df.withColumn("n", F.row_number().over(W.partitionBy("version").orderBy("id"))).collect()}
    assert {(x.version, x.id): x.rank for x in C.ranked(df, "version", ["id"]).collect()} == want
    assert C.ranked(df.limit(0), "version", ["id"]).count() == 0


def test_batches_of_ten_rows(spark):
    df = spark.createDataFrame([("v", f"{i:02d}") for i in range(10)], "version string, id string")
    got = C.batches(C.ranked(df, "version", ["id"]), "version").orderBy("batch_no").collect()
    assert [len(r["items"]) for r in got] == [4, 4, 2] and [r.taken_end for r in got] == [4, 8, 12]


def test_extensions_and_prefixes(spark):
    df = spark.createDataFrame([(None,), ("PDF",), ("azw3",), ("exe",)], "x string")
    assert [r.y for r in df.select(C.normal_extension(F.col("x")).alias("y")).collect()] == [".pdf", ".pdf", ".epub", None]
    df = spark.createDataFrame([("a/b/c",), ("a",), (None,)], "x string")
    assert [r.y for r in df.select(C.key_prefix(F.col("x"), "d/e").alias("y")).collect()] == ["a/b", "d/e", "d/e"]


LINES = ["# Title here", "", "THIS IS ALL CAPS", "x", "An ordinary line of some more words that stays.", "[START_TABLE]", "1", "[END_TABLE]", "see http://a.example/b", "[1] A ref http://a.example/long/path"]


def test_line_rules(spark):
    df = spark.createDataFrame([(1, "\n".join(LINES)), (2, ""), (3, None)], "doc long, text string")
    rows = L.fill_gaps(L.seed_lines(L.to_lines(df, "doc", "text"), "doc"), "doc").orderBy("doc", "idx").collect()
    kinds = [r.kind for r in rows if r.doc == 1]
    assert kinds == ["title", "blank", "delete", "text", "text", "token", "token", "token", "delete", "text"]
    assert [r.idx for r in rows if r.doc == 1 and r.removed] == [1, 2, 8, 9]
    assert [r.kind for r in rows if r.doc == 2] == ["blank"] and not any(r.doc == 3 for r in rows)
    runs = {r.idx: r.longest_run for r in L.longest_runs(spark.createDataFrame([(1, 0, "a a a b b a")], "doc long, idx int, line string"), "doc").collect()}
    assert runs == {0: 3}


def boxes(spark, n=60, pages=3):
    r = random.Random(9)
    rows = []
    for p in range(pages):
        for b in range(n // pages):
            x, y = r.randint(0, 60), r.randint(0, 60)
            rows.append((p, b, r.choice([1, 3, 14]), r.choice([0.5, 0.9]), float(x), float(y), float(x + r.randint(1, 30)), float(y + r.randint(1, 30))))
    return rows, spark.createDataFrame(rows, "page long, box long, cat int, score double, xmin double, ymin double, xmax double, ymax double")


def common(a, b):
    return max(0, min(a[6], b[6]) - max(a[4], b[4])) * max(0, min(a[7], b[7]) - max(a[5], b[5]))


def size(a):
    return (a[6] - a[4]) * (a[7] - a[5])


def test_pairs_and_bands(spark):
    rows, df = boxes(spark)
    want = {(a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] != b[1] and common(a, b) > 0}
    for band in (None, 7.0):
        got = [(r.page, r.a_box, r.b_box) for r in B.pairs(df, ["page"], banded=band).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_suppression(spark):
    rows, df = boxes(spark)
    want = set()
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[1] != b[1]:
                a_in, b_in = common(a, b) > 0.8 * size(a), common(a, b) > 0.8 * size(b)
                if a_in and (not b_in or a[3] < b[3] or (a[3] == b[3] and a[1] > b[1])):
                    want.add((a[0], a[1]))
    assert {(r.page, r.box) for r in B.suppressed(df, ["page"]).collect()} == want


def test_merge_chain(spark):
    rows = [(0, i, 13, 0.5 + i / 10, 10.0 * i, 0.0, 10.0 * i + 9.8, 10.0) for i in range(3)] + [(0, 9, 1, 0.1, 500.0, 500.0, 510.0, 510.0)]
    df = spark.createDataFrame(rows, "page long, box long, cat int, score double, xmin double, ymin double, xmax double, ymax double")
    got = {r.box: (r.n, r.score, r.xmax) for r in B.merged(df, ["page"]).collect()}
    assert got == {0: (3, 0.5, 29.8), 9: (1, 0.1, 510.0)}


def test_intervals(spark):
    df = spark.createDataFrame([(1, 2.0, 4.0, 0.0, 10.0), (1, 3.0, 6.0, 0.0, 10.0), (1, 8.0, 12.0, 0.0, 10.0)], "page long, xmin double, xmax double, lo double, hi double")
    assert sorted((r["from"], r["to"]) for r in B.free_intervals(df, ["page"]).collect()) == [(0.0, 2.0), (6.0, 8.0)]


def test_reachable(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "s string, t string")
    got = {(r.node, r.depth) for r in U.reachable(edges, spark.createDataFrame([("a",)], "n string"), "s", "t").collect()}
    assert got == {("a", 0), ("b", 1), ("c", 2)}


PHRASES = [
    ("a b b b b b c", "a b c"),
    ("x y x y x y x y x y z", "x y z"),
    ("b b b b c", "b b b b c"),
    ("[START_TABLE] b b b b b b [END_TABLE]", "[START_TABLE] b b b b b b [END_TABLE]"),
    ("[START_TABLE]\nb b b b b b\n[END_TABLE]\nb b b b b b c", "[START_TABLE]\nb b b b b b\n[END_TABLE]\nb c"),
    ("p q r p q r p q r p q r p q r s", "p q r s"),
]


@pytest.mark.parametrize("text,want", PHRASES)
def test_phrases(text, want):
    assert R.collapse_phrases(text)[0] == want


def test_tails_and_slices():
    tail = "this phrase is long enough to count as one. "
    assert R.cut_repeating_tail("Start. " + tail * 5).count("long enough") <= 2
    assert R.cut_repeating_tail("short") == "short" and R.cut_repeating_tail(None) is None and R.collapse_phrases(None) == (None, [])
    assert R.repeated_slices([f"the same line again {i}" for i in range(20)]) == [(0, 20)] and R.repeated_slices(["a", "b"]) == []
    assert R.alike("abcd", "abed") == 0.75 and R.alike("", "") == 1.0


def test_stages(spark):
    df = spark.createDataFrame([(1, " a1  b "), (2, None), (3, "12")], "id long, text string")
    got = {r.id: (r.status, r.message, r.text) for r in K.run_stages(df, "text", [("parse", "0"), ("clean", "0,1"), ("tag", "9")]).collect()}
    assert got[1] == (True, "", "a b") and got[2][:2] == (False, "no text") and got[3][:2] == (False, "empty after clean 1")


def test_recognition_contract(spark):
    df = spark.createDataFrame([("p", bytearray(b"xx")), ("q", bytearray()), ("r", None)], "k string, image binary")
    got = K.recognise(df, "k", "image", lambda b: [(1, 0.5, [0.0] * 8, str(len(b)))]).collect()
    assert [(r.k, r.text) for r in got] == [("p", "2")]


def test_registry_without_the_llm_folder(monkeypatch):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    for name in [m for m in sys.modules if m.startswith("millrace.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "millrace.llm", None)
    importlib.invalidate_caches()
    names = set(entry.queries())
    assert "p3_found" in names and "p1_found" not in names and set(entry.oracle_sql()) <= names


def test_components_of_long_chains(spark):
    from millrace.operators.graph import components

    chain = [(f"n{k:03d}", f"k{k // 2 if k % 2 else k // 2}") for k in range(60)] + [(f"n{k:03d}", f"m{(k + 1) // 2}") for k in range(1, 59)]
    rows = [*chain, ("x", "lone"), ("y", None), (None, "k0"), ("z", "hub"), *[(f"z{k}", "hub") for k in range(50)]]
    got = {r.node: r.label for r in components(spark.createDataFrame(rows, "node string, key string")).collect()}
    assert {got[f"n{k:03d}"] for k in range(60)} == {"n000"} and got["x"] == "x" and "y" not in got and got["z49"] == "z"
    assert components(spark.createDataFrame([], "node string, key string")).count() == 0


def test_reach_beyond_a_hundred_steps(spark):
    from millrace.operators.web import reachable

    edges = spark.createDataFrame([(k, k + 1) for k in range(104)], "a long, b long")
    got = reachable(edges, spark.createDataFrame([(0,)], "a long"), "a", "b")
    assert got.count() == 105 and got.agg({"depth": "max"}).first()[0] == 104
