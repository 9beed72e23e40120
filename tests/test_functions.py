"""Golden cases of the scalar functions, each evaluated by Spark."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import tei as X
from millrace.operators import web as U

CASES = [
    (T.collapse_blank, "a  b \r\n\n c ", "a b\nc"),
    (T.undouble_spaces, "a b  c   d", "ab c d"),
    (T.close_environments, "\\begin{table} x", "\\begin{table} x\\end{table}"),
    (T.without_numbers, " a1_**b ", "ab"),
    (T.next_punctuation, "ab. c?", 3),
    (T.last_punctuation, "ab. c? d", 6),
    (T.last_punctuation, "ab", 0),
    (T.dehyphenate, "re-\nflow it", "reflow\nit"),
    (T.plain_lower, "\\left( A_b^{2} ", "(ab2"),
    (T.escape_latex_signs, "a_b < 5 % \\x", "a\\_b \\textless{} 5 \\% \\textbackslash{}x"),
    (T.first_words, "a b c d e f g h i", "a b c d e f g h"),
    (T.last_words, "a b c d e f g h i", "b c d e f g h i"),
    (T.digit_share, "", 0.0),
    (T.escape_pattern, "a.b*(c)", "a.b\\*\\(c\\)"),
    (T.clean_url, "http://a.example/x.pdf.Lastaccessed", "http://a.example/x.pdf"),
    (T.clean_url, "<http://a.example>", "http://a.example"),
    (T.clean_url, "   http://a.example>", "http://a.example"),
    (T.clean_url, "", None),
    (T.csl_date, "1998", [1998]),
    (T.csl_date, "1998-03", [1998, 3]),
    (T.csl_date, "1998-03-12", [1998, 3, 12]),
    (T.csl_date, "1998-blah", [1998]),
    (T.csl_date, "asdf", None),
    (T.script_family, "de", "latin"),
    (T.script_family, "zh", "zh"),
    (T.heading_level, "2.1.3.", 3),
    (T.to_subscript, "H2", "H₂"),
    (T.to_superscript, "x2", "x²"),
    (T.has_math, "a ≤ b", True),
    (T.split_tags, "a[START_REF]b[END_REF]", ["a", "[START_REF]", "b", "[END_REF]"]),
    (U.normal_url, "http://h/a/b/a/", "http://h/a/b"),
    (U.normal_url, "http://h/a//b/a/", "http://h/a"),
    (U.is_page, "http://h/a/b.jpg?x=1", False),
    (U.is_page, "http://h/a.b/c", True),
    (U.host, "https://h.example:80/a", "h.example:80"),
    (U.html_text, "<p>a &amp; b</p><script>x</script> c<br/>d", "a & b c d"),
    (X.year_of, "12 May 1998", 1998),
]


@pytest.mark.parametrize("function,value,want", CASES)
def test_case(spark, function, value, want):
    df = spark.createDataFrame([(value,)], "x string")
    assert df.select(function(F.col("x")).alias("y")).first().y == want


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "x string")
    for function in {f for f, *_ in CASES}:
        assert df.select(function(F.col("x")).alias("y")).first().y is None, function


def test_join_url(spark):
    cases = [("https://h/a/b.html", "c.html", "https://h/a/c.html"), ("https://h/a/b", "/c", "https://h/c"), ("https://h", "c", "https://h/c"), ("https://h/a", "http://x/y", "http://x/y")]
    df = spark.createDataFrame(cases, "base string, link string, want string")
    assert all(r.want == r.got for r in df.withColumn("got", U.join_url(F.col("base"), F.col("link"))).collect())


def test_tei_round_trip(spark):
    rows = [("A & <B>", ["X Y", "Z"], "k1; k2", "1999"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "t string, a array<string>, k string, d string")
    f = X.read_header("xml")
    got = df.select(X.tei_header(F.col("t"), F.col("a"), F.col("k"), F.col("d")).alias("xml")).select(f["title"].alias("t"), f["authors"].alias("a"), f["keywords"].alias("k"), f["pub_date"].alias("d")).collect()
    assert tuple(got[0]) == rows[0] and tuple(got[1]) == (None, [], None, None)
