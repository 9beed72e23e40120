"""Sources, sinks, and the clean-up of recognised pages."""

from pyspark.sql import functions as F

from millrace.operators import pages as P
from millrace.sources import files as S
from millrace.sources.tables import columns_or_null


def test_jsonl_and_whole_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1, "y": "b"}\n{broken\n')
    got = S.read_jsonl(spark, str(tmp_path / "a.jsonl"), "x int, y string").collect()
    assert [(r.x, r._corrupt) for r in got] == [(1, None), (None, "{broken")]
    assert S.read_whole(spark, str(tmp_path), "*.jsonl").first().length == 27


def test_results_and_merged(spark, tmp_path):
    df = spark.createDataFrame([("v1", "a", 1), ("v1", "b", None), ("v2", "c", 3)], "version string, id string, n int")
    for _ in range(2):
        S.write_results(df, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).filter("version = 'v1'").count() == 4
    S.write_jsonl(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    assert {r.version: r.json for r in S.merged_json(df, "version").collect()}["v1"] == '[{"id":"a","n":1},{"id":"b"}]'


def test_offsets_and_columns(spark):
    df = spark.createDataFrame([("f", 0, "äb"), ("f", 1, ""), ("f", 2, "c")], "file string, k int, line string")
    assert [r.offset for r in S.line_offsets(df, "file", "k", "line").orderBy("k").collect()] == [0, 4, 5]
    assert columns_or_null(df, {"line": "string", "absent": "long"}).first() == ("äb", None)


def test_pages(spark):
    long = "# " + "w" * 200
    table = "\\begin{table}" + "&" * 500 + "\\end{table}"
    refs = "Text before.\n## References\n" + "\n".join(f"* [{i}] The same entry again and again, 19{i}" for i in range(10, 40)) + "\nThe end 5"
    rows = [("a", f"{long}\n#  \ntext é\n\n\n\nmore\n# End"), ("b", f"x {table} y"), ("c", refs), ("d", None), ("e", "")]
    got = {r.id: r.text for r in P.clean_pages(spark.createDataFrame(rows, "k string, t string"), "k", "t").collect()}
    assert got["a"] == "w" * 200 + "\n\ntext é\n\nmore" and got["b"] == "" and got["d"] is None and got["e"] == ""
    assert got["c"] == "Text before.\n\n[MISSING_PAGE_POST]\n\nhe end 5"  # up to and with the first letter that differs
    df = spark.createDataFrame([("$$ a \\le b % note\n$$",)], "x string")
    assert df.select(P.normal_tex(F.col("x")).alias("y")).first().y == "\\(a \\leq b % note\\)"  # a comment ends with its line
    assert P.offset_in_original("a *b* c", 2) == 6 and P.offset_in_original("ab", 9) == 2
