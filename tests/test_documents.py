"""Readers of TEI and HTML papers, assembly of regions, alignment."""

import itertools
import random
from collections import Counter

from millrace.operators import align as A
from millrace.operators import assemble as G
from millrace.operators.latexml import pages_to_markdown, to_markdown
from millrace.operators.tei_body import read_document, read_documents, render

TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><titleStmt><title>On <hi>things</hi></title></titleStmt><abstract><p>Short.</p></abstract></teiHeader>
<text><body><div><head n="1.">Start</head><p>See <ref type="bibr" target="#b0">[1]</ref> and <ref target="#zz">[9]</ref> with <formula>x = 1</formula>.</p></div>
<div><head n="1.2">Deeper</head><p><s>One.</s><s>Two.</s></p></div><figure xml:id="f1"><head>Figure 1</head><figDesc>A plot</figDesc></figure>
<figure type="table"><label>2</label><figDesc>Data</figDesc><table><row><cell>a</cell><cell cols="2">b</cell></row><row><cell>1</cell></row></table></figure><note>Aside</note></body>
<back><listBibl><biblStruct xml:id="b0"><analytic><title level="a">A work</title><author><persName><forename type="first">Ann</forename><surname>Bell</surname></persName></author><idno type="DOI">https://doi.org/10.1/x</idno></analytic>
<monogr><title level="j">J. Works</title><imprint><date when="1999">1999</date><biblScope unit="page" from="3" to="9"/></imprint></monogr></biblStruct></listBibl></back></text></TEI>"""


def test_tei_document():
    d = read_document(TEI)
    assert d["title"] == "On things" and d["abstract"] == "Short." and d["contents"] == "1 Start\n\t1.2 Deeper"
    assert "[START_REF][1][END_REF]" in d["body"] and "[9]" in d["body"] and "[START_REF][9]" not in d["body"] and "[START_FORMULA]x = 1[END_FORMULA]" in d["body"]
    assert d["tables"] == ["[START_TABLE]\nTable 2\n\nData\n\n|a|b|b|\n|-|-|-|\n|1|None|None|\n\n[END_TABLE]"] and d["notes"] == ["[START_NOTE]Aside[END_NOTE]"]
    assert d["references"] == ["0.[0](<b0>Ann Bell.A work,J. Works)"] and render(d).startswith("#Title\nOn things")
    for bad in (None, "", "<a>", "text"):
        assert read_document(bad) is None


def test_tei_table(spark):
    df = spark.createDataFrame([("x", TEI), ("y", None), ("z", "<broken")], "k string, xml string")
    got = {r.id: r.title for r in read_documents(df, "k", "xml").collect()}
    assert got == {"x": "On things", "y": None, "z": None}


HTML = """<html><head><title>x</title></head><body><article><h1 class="ltx_title">Big</h1><section><h2>One</h2><div class="ltx_para"><p class="ltx_p">A <b>bold</b> and <math alttext="x^2">..</math> word <cite>[<a>3</a>]</cite></p></div>
<ul><li>p</li><li>q</li></ul><figure id="S1.F1"><figcaption>Plot</figcaption></figure><table><tr><td rowspan="2">a</td><td>b</td></tr><tr><td>c</td></tr></table></section>
<section><ul><li class="ltx_bibitem">Ref one</li></ul></section></article></body></html>"""


def test_html(spark):
    text, figures, references = to_markdown(HTML)
    for part in ("# Big", "## One", "A **bold** and \\(x^2\\) word [3]", "* p\n* q", "[FIGURE:S1.F1]\nPlot\n[ENDFIGURE]", "\\begin{tabular}{ll}\n\\multirow{2}{*}{a} & b \\\\\n & c \\\\\n\\end{tabular}", "* Ref one"):
        assert part in text, part
    assert figures == 1 and references == 1 and to_markdown("<p>no article</p>") is None and to_markdown(None) is None
    df = spark.createDataFrame([("a", HTML), ("b", None)], "k string, h string")
    assert {r.id: r.n_figures for r in pages_to_markdown(df, "k", "h").collect()} == {"a": 1, "b": None}


def test_monotone_bounds_leave_the_least_impurity():
    r = random.Random(2)
    for _ in range(60):
        n, k = r.randint(1, 8), r.randint(2, 4)
        labels = [r.randint(0, k - 1) for _ in range(n)]

        def cost(b):
            ends = [0, *b, n]
            impurity = sum(A.gini(Counter(labels[i:j])) for i, j in zip(ends, ends[1:]))
            return round(impurity, 6), sum(labels[i] != sum(i >= x for x in b) for i in range(n))  # noqa: B023

        best = min(cost(b) for b in itertools.combinations_with_replacement(range(n + 1), k - 1))
        got = A.monotone_bounds(labels, k)
        assert got == sorted(got) and cost(got) == best


def test_edit_distances_and_searches():
    r = random.Random(4)

    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            diagonal, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                diagonal, row[j] = row[j], min(diagonal + (x != y), row[j] + 1, row[j - 1] + 1)
        return row[-1]

    for _ in range(400):
        a, b = ("".join(r.choice("abc") for _ in range(r.randint(0, 12))) for _ in range(2))
        assert A.edit_distance(a, b) == slow(a, b)
        if a and a not in b:
            best = min(slow(a, b[i:j]) for j in range(len(b) + 1) for i in range(j + 1))
            found = A.find_phrase(a, b, 12)
            assert found is None or found[1] == min(slow(a, b[i : found[0]]) for i in range(found[0] + 1)) == min(best, found[1])
    assert A.edit_share("abcd", "abce") == 0.25 and A.edit_share("abc", "abcd") is None and A.edit_distance("", "xy") == 2


def test_cut_of_uniform_scores():
    from millrace.operators.structure import repeat_cut

    r = random.Random(5)
    wild = [r.random() * 60 for _ in range(300)]
    assert repeat_cut(None) is None and repeat_cut([1.0] * 12) is None and repeat_cut(wild) is None
    assert repeat_cut([1.0] * 600) == 0
    cut = repeat_cut(wild + [5.0] * 900)
    assert cut is not None and 300 < cut < 600


def test_states_of_jobs(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from millrace.operators import jobs as J

    now = dt.datetime(2024, 1, 1, 1)
    start = dt.datetime(2024, 1, 1, 0)
    rows = [(1, 10, start, 3600, 5, 4), (2, 10, start, 3599, 5, 4), (3, 20, start, 1, 5, 4), (4, 10, None, 1, 5, 4), (5, 10, start, 9999, 0, 4)]
    df = spark.createDataFrame(rows, "id long, job_status int, start_time timestamp, timeout long, cluster_id int, total_pod_num int").selectExpr("*", "0 as exit_pod_num", "cast(null as timestamp) as end_time")
    got = {r.id: (r.job_status, r.exit_pod_num, r.warning) for r in J.swept(df, F.lit(now)).collect()}
    assert got == {1: (10, 0, None), 2: (20, 4, None), 3: (20, 0, None), 4: (10, 0, "no start time"), 5: (10, 0, None)}
    asked = spark.createDataFrame([(1,), (3,), (5,), (1,)], "id long")
    assert {r.id for r in J.stopped(df, asked, F.lit(now)).filter("changed").collect()} == {1}
    assert df.limit(0).count() == J.swept(df.limit(0), F.lit(now)).count() == 0


def test_phrases_and_scores():
    assert A.find_phrase("the quick fox", "see the quikc fox run", 3) == (17, 2) and A.find_phrase("zzzzzzz", "abc", 2) is None
    assert A.find_phrase("abc", "xabcx") == (4, 0) and A.boundary_score("abc", None) == 0.0 and A.boundary_score("abc", (4, 0)) == 1.0
    assert A.bleu("a b c d", "a b c d") == 1.0 and A.bleu("", "a") == 0.0 and 0 < A.bleu("a b c x", "a b c d") < 1
    assert A.gini({"a": 3, "b": 1}) == 4 - 10 / 4 and A.gini({}) == 0


def test_align(spark):
    text = "alpha beta gamma delta. epsilon zeta eta theta iota. kappa lamda mu nu xi omicron pi rho."
    df = spark.createDataFrame([("d", ["alpha beta gamma delta.", "epsilon zetta eta theta iota.", "kappa lamda mu nu"], text), ("e", [], None)], "k string, pages array<string>, t string")
    got = A.align_pages(df, "k", "pages", "t").orderBy("page_no").collect()
    assert [r.page_no for r in got] == [0, 1, 2] and got[0].start == 0 and got[1].score > 0.5 and text[got[2].start :].startswith("kappa")


def test_regions(spark):
    line = lambda i, x, w, t: (float(x), 12.0 * i, float(x + w), 12.0 * i + 10, t)
    region = [line(0, 20, 180, "First"), line(1, 10, 190, "goes on"), line(2, 10, 60, "ends."), line(3, 20, 180, "Second"), line(4, 10, 190, "goes on"), line(5, 10, 50, "too.")]
    assert G.region_text(region) == "First goes on ends.\n\nSecond goes on too."
    assert G.region_text([(0, 0, 9, 10, "汉"), (10, 0, 19, 10, "字"), (20, 1, 29, 11, "x")]) == "汉字 x" and G.region_text([]) == ""
    df = spark.createDataFrame([("r", *b) for b in region], "r string, xmin double, ymin double, xmax double, ymax double, text string")
    assert G.assemble(df, "r").first().text == G.region_text(region)


def test_stages_of_documents(spark):
    from millrace.operators.stages import run_documents

    rows = [(1, "a b. so so so so so so so end"), (2, None), (3, "x"), (3, "x")]
    df = spark.createDataFrame(rows, "k long, t string")
    got = {r.id: (r.text, r.status, r.message) for r in run_documents(df, "k", "t", [("parse", "1"), ("clean", "0")]).collect()}
    assert got == {"1": ("a b. so end", True, ""), "2": (None, False, "no text"), "3": ("x", True, "")}
    wrong = run_documents(df, "k", "t", [("parse", "9"), ("clean", "0")]).filter("id = '3'").first()
    assert (wrong.status, wrong.message) == (False, "parse 9: no such stage") and run_documents(df.limit(0), "k", "t", []).count() == 0
