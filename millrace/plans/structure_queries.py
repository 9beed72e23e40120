"""Queries over parts of generated documents (survey ids D12, K2 to K4, L9, L11, M5, M7, M8, M12, M15, T10, T13, T16, T22, E3, G2b, G8, G17, X4), with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.runtime import scratch_folder
from millrace.operators import align as A
from millrace.operators import boxes as B
from millrace.operators import lines as L
from millrace.operators import pages as P
from millrace.operators import structure as S
from millrace.operators.latexml import plain_text
from millrace.operators.stages import run_documents
from millrace.operators.tei_body import latex_tables, read_documents
from millrace.plans.case_queries import Cases, _by_id, _paged, _query, _sql
from millrace.sources.files import merged_json, read_jsonl
from millrace.sources.tables import table

_TOP = "# {T} of one title here\nA. Author\n\n"
BODY: Cases = [
    (
        f"{_TOP}###### Abstract\n\nThe abstract {{T}}.\n\n## 1 Intro\n\nText one.\nTable 1: cap\n\\begin{{table}}\na & b\n\\end{{table}}\nFigure 2: cap\n* [1] A. One\n[2] . x\n**Keywords:** a, b\n"
        "see Smith et al. (1999)\nFootnote 1: x\nPublisher 12345 6789\nPublisher of it\n## References\nText two.",
        "[START_ABSTRACT]\nThe abstract {T}.\n[END_ABSTRACT]\n## 1 Intro\nText one.\nPublisher of it\nText two.",
    ),
    ("No title\n\nplain {T}\n## Head\nend", "No title\nplain {T}\n## Head\nend"),
    ("## Abstract\nfirst\n# Abstract\n## 1 Head\nsecond {T}\nthird", "## 1 Head\n[START_ABSTRACT]\nsecond {T}\n[END_ABSTRACT]\nthird"),
    ("\\begin{table}\nTable 1: in {T}\nrow\n## Abstract\nlost\n\\end{table}\nkept {T}", "[START_ABSTRACT]\nkept {T}\n[END_ABSTRACT]"),
]
TABLES: Cases = [
    ("x\n\\begin{table}\na & {T}\n\\end{table}\nTable 3: The {T}\ny", "\\begin{table*}[h]\n\\caption{\nThe {T}\n}\n\\label{tbl:3}\na & {T}\n\\end{table*}\n"),
    ("\\begin{table}\n\\end{table}\nother {T}", "\\begin{table*}[h]\n\\caption{\n}\n\\label{tbl:}\n\\end{table*}\n"),
    ("\\begin{table}\na {T}\n\\end{table}\nTable 1: A\n\\begin{table}\nb", "\\begin{table*}[h]\n\\caption{\nA\n}\n\\label{tbl:1}\na {T}\n\\end{table*}\n\\begin{table*}[h]\n\\caption{\n}\n\\label{tbl:}\nb\n\\end{table*}\n"),
    ("no table {T}", ""),
]
HYPHENS: Cases = [
    ("a bro-\nken line {T}\nand well-known", "a broken\n line {T}\nand well-known"),
    ("x-\ny-\nz {T}", "xy-\nz\n {T}"),
    ("{T} end-  \nnext one", "{T} endnext\n one"),
    ("{T} -\n\nx-", "{T} \n\nx-"),
]
TEX: Cases = [
    ("$\\displaystyle a \\le b$ {T}", "\\(\\displaystyle a \\le b$ {T}\\)"),
    ("\\[x \\rightarrow y % note\n\\texttimes {T}\\]", "\\(x \\to y  \\times {T}\\)"),
    ("$$ {T} \\scriptstyle \\ne 1 $$", "\\({T}  \\neq 1\\)"),
    (" $ $ ", ""),
]
TEX[0] = ("$\\displaystyle {T} \\le b$", "\\( {T} \\leq b\\)")
_CELL = "<cell>{0}</cell>"
_TABLE = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><figure type="table" xml:id="tab_1"><head>Table 1</head><label>1</label><figDesc>{T}</figDesc><table>%s</table></figure></body></text></TEI>'
_HEAD = "\\begin{table*}[h]\n\\caption{\n{T}\n\\label{tbl:1}}\n"
GRIDS: Cases = [
    (
        _TABLE % "<row><cell>a</cell><cell>b</cell><cell>c</cell></row><row><cell cols=\"2\">x</cell><cell/></row><row><cell>1</cell><cell>2</cell><cell>3</cell><cell>4</cell></row><row><cell>z</cell></row>",
        _HEAD + "\\begin{tabular}{lll}\n\\toprule\na & b & c \\\\\n\\midrule\nx & x & empty \\\\\n1 & 2 & 3 \\\\\nz &   &   \\\\\n\\bottomrule\n\\end{tabular}\n\\end{table*}",
    ),
    (_TABLE % "<row><cell>only head {T}</cell></row>", _HEAD + "\\end{table*}"),
]


_TEI = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><titleStmt><title>On {T}</title></titleStmt></teiHeader><text><body><div><head n="1">Intro</head><p>%s</p></div>%s</body></text></TEI>'
STAGED: Cases = [
    (_TEI % ("We say {T} of it.", ""), "true||0|0|#Title\nOn {T}\n##Contents\n1 Intro\n#Main Body\n## 1 Intro We say {T} of it."),
    (_TEI % ("so so so so so so so end", '<figure xml:id="f1"><head>Figure 1</head><figDesc>{T}</figDesc></figure>'), "true||1|0|#Title\nOn {T}\n##Contents\n1 Intro\n##Figures\n[START_FIGURE]\nFigure 1\n\n{T}\n\n[END_FIGURE]\n#Main Body\n## 1 Intro so so so so so so so end"),
    ("<TEI>{T}", "false|parse 0: no readable TEI|||<TEI>{T}"),
    ("  ", "false|no text|||  "),
]


_FULL = (
    '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><titleStmt><title>On <hi>{T}</hi></title></titleStmt><abstract><p>Short {T}.</p></abstract></teiHeader><text><body><div><head n="1.">Start</head>'
    '<p>See <ref type="bibr" target="#b0">[1]</ref> and <ref target="#zz">[9]</ref> with <formula>x = 1</formula>.</p></div><div><head n="1.2">Deeper</head><p><s>One {T}.</s><s>Two.</s></p><formula>y</formula></div>'
    '<figure xml:id="f1"><head>Figure 1</head><figDesc>A plot</figDesc></figure><figure type="table"><label>2</label><figDesc>Data</figDesc><table><row><cell>a</cell><cell cols="2">b</cell></row><row><cell>1</cell></row></table>'
    '</figure><note>Aside {T}</note></body><back><listBibl><biblStruct xml:id="b0"><analytic><title level="a">A {T}</title><author><persName><forename type="first">Ann</forename><surname>Bell</surname></persName></author>'
    '</analytic><monogr><title level="j">J. Works</title><imprint><date when="1999">1999</date></imprint></monogr></biblStruct></listBibl></back></text></TEI>'
)
WHOLE: Cases = [
    (
        _FULL,
        "#Title\nOn {T}\n##Contents\n1 Start\n\t1.2 Deeper\n##Figures\n[START_FIGURE]\nFigure 1\n\nA plot\n\n[END_FIGURE]\n##Tables\n[START_TABLE]\nTable 2\n\nData\n\n|a|b|b|\n|-|-|-|\n|1|None|None|\n\n[END_TABLE]\n"
        "##Reference\n0.[0](<b0>Ann Bell.A {T},J. Works)\n#Main Body\nShort {T}.\n\n## 1 Start\n\nSee [START_REF][1][END_REF] and [9] with [START_FORMULA]x = 1[END_FORMULA].\n\n### 1.2 Deeper\n\nOne {T}. Two.\n\n"
        "[START_FORMULA]y[END_FORMULA]\n[START_NOTE]Aside {T}[END_NOTE]",
    ),
    ("<TEI>{T}", ""),
]
PLAIN_HTML: Cases = [
    ("<html><head><style>p {}</style><script>var a = '<b>';</script></head><body><p>One <b>{T}</b></p>\n\n\n<p>two &amp; three</p></body></html>", "One {T}\ntwo & three"),
    ("{T}  no   tags", "{T} no tags"),
    ("<p>{T}<!-- gone --><br/>next</p>", "{T} next"),
]


def _whole(df: DataFrame) -> DataFrame:
    docs = read_documents(df, "doc_id", "text")
    return docs.select(F.col("id").alias("doc_id"), F.concat_ws("\n", "text", F.array_join("notes", "\n")).alias("text"))


def s20_json_lines(spark: SparkSession, root: str) -> DataFrame:
    """Documents as JSON lines, every tenth line broken, read again by name: broken ones give nulls."""
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    line = F.when(F.col("doc_id") % 10 == 0, "{\"doc_id\": 1, \"text\": \"cut").otherwise(F.to_json(F.struct("doc_id", "source", "text")))
    table(spark, root, "documents").select(line.alias("value")).write.text(path)
    rows = read_jsonl(spark, path, "doc_id long, source string, text string")
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.count("doc_id").alias("n_read"), F.sum(F.length("text")).alias("n_chars"), F.count("_corrupt").alias("n_broken"))


def s21_merged_json(spark: SparkSession, root: str) -> DataFrame:
    """The detections of each page as one JSON array."""
    rows = table(spark, root, "layout_dets").select(F.concat_ws(" ", "data_id", "page").alias("page"), "det_id", "category_id").distinct()
    return merged_json(rows, "page").select("page", F.md5("json").alias("digest"))


def _staged(df: DataFrame) -> DataFrame:
    """K2 to K5; the clean stage would collapse loops in the documents' own words, and is tested apart."""
    out = run_documents(df, "doc_id", "text", [("parse", "0"), ("tag", "0")])
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("status", "message", "n_figures", "n_tables", "text")]
    return out.select(F.col("id").alias("doc_id"), F.concat_ws("|", *shown).alias("text"))


def _body(df: DataFrame) -> DataFrame:
    lines = L.to_lines(df, "doc_id", "text")
    first = F.regexp_replace(F.regexp_replace("line", r"^#+|#+$", ""), r"^\*+|\*+$", "")
    titles = lines.filter((F.col("idx") < 3) & F.col("line").rlike(r"^[#*]+\s*[\p{L}\p{N}_]+") & (F.size(F.filter(F.split(first, r"\s+"), lambda w: w != "")) > 3))
    titles = titles.groupBy("doc_id").agg(F.min_by(T.strip(first), "idx").alias("title"))
    out = S.main_body(lines.join(titles, "doc_id", "left"), "doc_id")
    return df.select("doc_id").join(out, "doc_id", "left").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


_CASES = {
    "m8_body_text": (BODY, _body),
    "m5_table_blocks": (TABLES, lambda df: df.select("doc_id", S.table_blocks(F.col("text")).alias("text"))),
    "t10_dehyphenate_lines": (HYPHENS, lambda df: _by_id(S.each_text(df, "doc_id", "text", S.dehyphenated))),
    "t13_normal_tex": (TEX, lambda df: df.select("doc_id", P.normal_tex(F.col("text")).alias("text"))),
    "x20_tei_documents": (WHOLE, _whole),
    "h1_parsed_text": (PLAIN_HTML, lambda df: _by_id(S.each_text(df, "doc_id", "text", plain_text).withColumn("text", T.strip(T.collapse_blank(F.col("text")))))),
    "k3_document_stages": (STAGED, _staged),
    "x4_latex_tables": (GRIDS, lambda df: latex_tables(df, "doc_id", "text").select(F.col("id").alias("doc_id"), F.array_join("tables", "\n").alias("text"))),
}


def d12_first_places(spark: SparkSession, root: str) -> DataFrame:
    """The first line of an order at which each class of parts stands; class 0 is dropped."""
    rows = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_partkey") % 4).alias("class"))
    return S.first_places(rows, "l_orderkey", ["l_linenumber", "l_partkey"], "class")


def d12_inverted(spark: SparkSession, root: str) -> DataFrame:
    return S.inverted(table(spark, root, "lineitem").select("l_orderkey", (F.col("l_partkey") % 100).alias("class")), "l_orderkey", "class")


def d12_maximal_sets(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "lineitem").select("l_orderkey", (F.col("l_partkey") % 9).alias("class"))
    return S.maximal_sets(rows, "l_orderkey", "class").select(F.array_join("members", ",").alias("members"), "n_keys")


def l9_sentences(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").filter("text is not null").select("doc_id", S.sentences_of(F.col("text")).alias("s"))
    return docs.select("doc_id", F.size("s").alias("n_sentences"), F.md5(F.array_join("s", "|")).alias("digest"))


def l11_strict_rules(spark: SparkSession, root: str) -> DataFrame:
    """The line rules of the stricter profile: addresses count in references too, tags are no words, short is under twenty words."""
    c = F.col("line")
    untagged = F.regexp_replace(c, r"\[?(?:START|END)_[A-Z]+\]?", "")
    rows = L.to_lines(table(spark, root, "documents").filter("text is not null"), "doc_id", "text")
    place = c.rlike(r"^[a-zA-Z\- ,]+, [0-9\- ,]+$") & (F.length(c) < 100)
    return rows.select("doc_id", "idx", L.uppercase_rule(untagged).alias("l1"), L.capitalised_rule(untagged).alias("l2"), L.address_rule(c, exempt=False).alias("l4"), L.is_short(c, 20).alias("l5"), place.alias("place"))


def t22_bracket_pieces(spark: SparkSession, root: str) -> DataFrame:
    """The words of elements cut at their brackets."""
    words = table(spark, root, "grobid_elements").filter("text is not null").select("element_id", F.explode(F.split("text", r"\s+")).alias("word")).distinct()
    return words.select("element_id", "word", F.array_join(S.bracket_pieces(F.col("word")), " ").alias("pieces"))


def m12_page_marks(spark: SparkSession, root: str) -> DataFrame:
    """Documents as pages; their ids tell what was recognised and where it was cut."""
    k = F.col("doc_id") % 5
    docs = table(spark, root, "documents").select("doc_id", F.when(k == 0, " [MISSING_PAGE_POST]\n").otherwise(F.col("text")).alias("output"), F.when(k == 1, 7).when(k == 2, 0).alias("repeats"))
    return docs.select("doc_id", F.md5(S.page_status(F.col("output"), F.col("repeats"), F.col("doc_id") + 1)).alias("digest"))


def m15_repeat_cuts(spark: SparkSession, root: str) -> DataFrame:
    """The lengths of a document's words as scores: where they turn uniform."""
    scores = F.transform(F.split("text", r"\s+"), lambda w: F.length(w).cast("double"))
    rows = table(spark, root, "documents").select("doc_id", F.slice(scores, 1, S.MOST_LENGTH).alias("scores"))
    return S.each_text(rows, "doc_id", "scores", S.repeat_cut, "cut long").select(F.col("id").cast("long").alias("doc_id"), "cut")


def t16_offsets(spark: SparkSession, root: str) -> DataFrame:
    """The offset in each document's text of its middle letter once the marks are removed."""
    docs = table(spark, root, "documents").filter("text is not null").select("doc_id", "text")
    step = lambda t: P.offset_in_original(t, len([c for c in t if c not in " *_{}#-\n"]) // 2)
    return S.each_text(docs, "doc_id", "text", step, "place long").select(F.col("id").cast("long").alias("doc_id"), "place")


def e3_bleu(spark: SparkSession, root: str) -> DataFrame:
    """BLEU of each detection's joined text against its lines."""
    rows = table(spark, root, "layout_dets").filter("content is not null and size(ptrmfr_texts) > 0").select("det_id", F.array("content", F.array_join("ptrmfr_texts", " ")).alias("both")).distinct()
    return S.each_text(rows, "det_id", "both", lambda x: A.bleu(x[0], x[1]), "bleu double").select(F.col("id").cast("long").alias("det_id"), F.round("bleu", 6).alias("bleu"))


def _rects(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "layout_dets").filter("size(poly) = 8").select("det_id", "data_id", "page", "box_id", "category_id", "score", *B.rect_of_poly(F.col("poly")))
    return rows.distinct()


def g2b_rect_algebra(spark: SparkSession, root: str) -> DataFrame:
    """Area, bounding union with the unit box, whether (100, 100) lies inside, and the box shrunk by a tenth at each side."""
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    return _rects(spark, root).select(
        "det_id", F.round(B.area(), 4).alias("area"), *[F.round(c, 4).alias(n) for n, c in B.bounding({s: F.col(s) for s in B.SIDES}, {"xmin": F.lit(0.0), "ymin": F.lit(0.0), "xmax": F.lit(1.0), "ymax": F.lit(1.0)}).items()],
        B.holds(F.lit(100.0), F.lit(100.0)).alias("holds"), F.round(F.col("xmin") + 0.1 * w, 4).alias("core_x"), F.round(F.col("ymax") - 0.1 * h, 4).alias("core_y"),
    ).distinct()


def g8_cut_texts(spark: SparkSession, root: str) -> DataFrame:
    """Text boxes cut at the formula boxes on their line; the pieces keep the number of their box."""
    rows = _rects(spark, root)
    one = lambda df: df.select("data_id", "page", F.col("det_id").alias("box"), *B.SIDES).dropDuplicates(["data_id", "page", "box"])
    pieces = B.cut_around(one(rows.filter("category_id = 1")), one(rows.filter("category_id in (8, 14)")), ["data_id", "page"])
    return pieces.select(F.col("box").alias("det_id"), F.round("xmin", 3).alias("xmin"), F.round("xmax", 3).alias("xmax"))


def g17_page_order(spark: SparkSession, root: str) -> DataFrame:
    """The regions of a page in the order of given positions (here: the tops), equal ones by number."""
    order = W.partitionBy("data_id", "page").orderBy("ymin", "xmin", "det_id")
    return _rects(spark, root).groupBy("data_id", "page", "det_id").agg(F.min("ymin").alias("ymin"), F.min("xmin").alias("xmin")).select("det_id", "data_id", "page", F.row_number().over(order).alias("place"))


QUERIES = {name: _query(name, *case) for name, case in _CASES.items()} | {
    f.__name__: f
    for f in (
        d12_first_places, d12_inverted, d12_maximal_sets, l9_sentences, l11_strict_rules, t22_bracket_pieces, m12_page_marks, m15_repeat_cuts, t16_offsets, e3_bleu, g2b_rect_algebra, g8_cut_texts,
        g17_page_order, s20_json_lines, s21_merged_json,
    )
}
_RECTS = """(SELECT DISTINCT det_id, data_id, page, box_id, category_id, list_min([poly[1], poly[3], poly[5], poly[7]]) AS xmin, list_min([poly[2], poly[4], poly[6], poly[8]]) AS ymin,
  list_max([poly[1], poly[3], poly[5], poly[7]]) AS xmax, list_max([poly[2], poly[4], poly[6], poly[8]]) AS ymax FROM layout_dets WHERE len(poly) = 8)"""
_ROWS = "(SELECT doc_id, (i - 1)::INT AS idx, parts[i] AS line FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)))"
_PLAIN = r"regexp_replace(line, '\[?(?:START|END)_[A-Z]+\]?', '', 'g')"
_HITS = " + ".join(f"len(array_to_string(regexp_extract_all(line, '{p}'), ''))" for p in (L.URL, L.EMAIL, L.DOI))
_TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
SQL = {name: _sql(cases) for name, (cases, _) in _CASES.items()} | {
    "d12_first_places": """SELECT l_orderkey, l_partkey % 4 AS class, min({'a': l_linenumber, 'b': l_partkey}).a AS l_linenumber, min({'a': l_linenumber, 'b': l_partkey}).b AS l_partkey
      FROM lineitem WHERE l_partkey % 4 > 0 GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY 1, 2"),
    "d12_inverted": "SELECT DISTINCT l_partkey % 100 AS class, l_orderkey FROM lineitem",
    "d12_maximal_sets": """WITH s AS (SELECT l_orderkey, list_sort(list_distinct(list(l_partkey % 9))) AS m FROM lineitem GROUP BY 1), d AS (SELECT m, count(*) AS n_keys FROM s GROUP BY 1)
      SELECT array_to_string(m, ',') AS members, n_keys FROM d WHERE NOT EXISTS (SELECT 1 FROM d AS o WHERE len(o.m) > len(d.m) AND list_has_all(o.m, d.m))""",
    "l11_strict_rules": rf"""SELECT doc_id, idx,
      CASE WHEN len(regexp_replace({_PLAIN}, '[^\pL]', '', 'g')) = 0 THEN -1 WHEN len(regexp_replace({_PLAIN}, '[^\p{{Lu}}]', '', 'g')) > 0.6 * len(regexp_replace({_PLAIN}, '[^\pL]', '', 'g')) THEN 0 ELSE 1 END AS l1,
      CASE WHEN {_TRIM.format(_PLAIN)} = '' THEN -1 WHEN len(regexp_extract_all({_PLAIN}, '[\pL\pN_]+')) = 0 THEN 0
        WHEN len(list_filter(regexp_extract_all({_PLAIN}, '[\pL\pN_]+'), lambda w: regexp_matches(w, '^[\p{{Lu}}\pN_]'))) > 0.6 * len(regexp_extract_all({_PLAIN}, '[\pL\pN_]+')) THEN 0 ELSE 1 END AS l2,
      CASE WHEN len(regexp_replace(line, '\s', '', 'g')) > 0 AND {_HITS} > 0.3 * len(regexp_replace(line, '\s', '', 'g')) THEN 0 ELSE 1 END AS l4,
      len(string_split(regexp_replace({_TRIM.format('line')}, '^[0-9\-,.:; ]+', ''), ' ')) < 20 AS l5,
      regexp_matches(line, '^[a-zA-Z\- ,]+, [0-9\- ,]+$') AND len(line) < 100 AS place FROM {_ROWS}""",
    "t22_bracket_pieces": r"""SELECT element_id, word, CASE WHEN contains(word, '[') THEN array_to_string(list_filter(regexp_extract_all(word, '\[[^\[\]]*\]?|[^\[\]]+\]?|\]'), lambda x: x <> ''), ' ') ELSE word END AS pieces
      FROM (SELECT DISTINCT element_id, unnest(string_split_regex(text, '\s+')) AS word FROM grobid_elements WHERE text IS NOT NULL)""",
    "m12_page_marks": r"""SELECT doc_id, md5(CASE WHEN doc_id % 5 IN (0, 2) THEN chr(10) || chr(10) || '[MISSING_PAGE_EMPTY:' || (doc_id + 1) || ']' || chr(10) || chr(10)
      WHEN regexp_replace(text, '^\s+|\s+$', '', 'g') = '[MISSING_PAGE_POST]' THEN chr(10) || chr(10) || '[MISSING_PAGE_EMPTY:' || (doc_id + 1) || ']' || chr(10) || chr(10)
      WHEN doc_id % 5 = 1 THEN chr(10) || chr(10) || '[MISSING_PAGE_FAIL:' || (doc_id + 1) || ']' || chr(10) || chr(10) ELSE text END) AS digest FROM documents""",
    "g2b_rect_algebra": f"""SELECT DISTINCT det_id, round((xmax - xmin) * (ymax - ymin), 4) AS area, round(least(xmin, 0.0), 4) AS xmin, round(least(ymin, 0.0), 4) AS ymin, round(greatest(xmax, 1.0), 4) AS xmax,
      round(greatest(ymax, 1.0), 4) AS ymax, 100 BETWEEN xmin AND xmax AND 100 BETWEEN ymin AND ymax AS holds, round(xmin + 0.1 * (xmax - xmin), 4) AS core_x, round(ymax - 0.1 * (ymax - ymin), 4) AS core_y FROM {_RECTS}""",
    "s20_json_lines": """SELECT CASE WHEN doc_id % 10 <> 0 THEN source END AS source, count(*) AS n, count(*) FILTER (doc_id % 10 <> 0) AS n_read, sum(CASE WHEN doc_id % 10 <> 0 THEN len(text) END)::BIGINT AS n_chars,
      count(*) FILTER (doc_id % 10 = 0) AS n_broken FROM documents GROUP BY 1""",
    "s21_merged_json": """SELECT page, md5('[' || string_agg(row, ',' ORDER BY row) || ']') AS digest FROM (SELECT DISTINCT concat_ws(' ', data_id, page) AS page,
      '{"det_id":' || det_id || CASE WHEN category_id IS NULL THEN '' ELSE ',"category_id":' || category_id END || '}' AS row FROM layout_dets) GROUP BY page""",
    "g17_page_order": f"""SELECT det_id, data_id, page, row_number() OVER (PARTITION BY data_id, page ORDER BY ymin, xmin, det_id)::INT AS place
      FROM (SELECT data_id, page, det_id, min(ymin) AS ymin, min(xmin) AS xmin FROM {_RECTS} GROUP BY ALL)""",
}
