"""Queries over whole documents (survey ids T5, T28, T29, D9, D12, L10, M7, X7, X20, H5, G9, G12, A8, A13, E3), with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import align as A
from millrace.operators import assemble as G
from millrace.operators import lines as L
from millrace.operators.classify import page_bounds
from millrace.operators.latexml import pages_to_markdown
from millrace.operators.pages import clean_pages
from millrace.operators.repeats import alike
from millrace.operators.structure import each_text
from millrace.operators.tei import xml_escape
from millrace.operators.tei_body import read_documents
from millrace.sources.tables import table


def t5_markdown(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", F.md5(T.markdown_compatible(F.col("text"))).alias("digest"))


def t28_document_language(spark: SparkSession, root: str) -> DataFrame:
    meta = table(spark, root, "tei_meta").distinct()
    return meta.select("doc_id", T.document_language(F.col("language"), F.col("title")).alias("script"))


def t29_language(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", T.language_by_words(F.col("text")).alias("language"))


def d9_label_suffix(spark: SparkSession, root: str) -> DataFrame:
    """Labels of a record's elements made distinct by a letter for each earlier one."""
    rows = table(spark, root, "grobid_elements").select("element_id", "rec_id", F.coalesce("figure_lable", F.lit("")).alias("label")).distinct()
    earlier = F.row_number().over(W.partitionBy("rec_id", "label").orderBy("element_id")) - 1
    return rows.select("element_id", F.concat("label", F.repeat(F.lit("a"), earlier)).alias("label"))


def d12_first_values(spark: SparkSession, root: str) -> DataFrame:
    """The distinct lines of a detection, first ones kept."""
    return table(spark, root, "layout_dets").select("det_id", F.array_join(F.array_distinct("ptrmfr_texts"), "|").alias("lines")).distinct()


def l10_place_date_lines(spark: SparkSession, root: str) -> DataFrame:
    """Short lines of words, a comma and numbers, which the stricter profile deletes."""
    rows = L.to_lines(table(spark, root, "documents"), "doc_id", "text")
    return rows.filter(F.col("line").rlike(r"^[a-zA-Z\- ,]+, [0-9\- ,]+$") & (F.length("line") < 100)).groupBy("doc_id").agg(F.count("*").alias("n"))


def _tei(spark: SparkSession, root: str) -> DataFrame:
    """A TEI document for each record, with its citations as references."""
    element = lambda tag, c, attrs="": F.coalesce(F.concat(F.lit(f"<{tag}{attrs}>"), xml_escape(c), F.lit(f"</{tag}>")), F.lit(""))
    b = table(spark, root, "biblio").select("rec_id", "biblio_id", "ref_index", "title", "journal", "date").distinct()
    one = F.concat(F.lit('<biblStruct xml:id="b'), F.col("ref_index").cast("string"), F.lit('">'), element("title", F.col("title"), ' level="a"'), element("title", F.col("journal"), ' level="j"'), element("date", F.col("date")), F.lit("</biblStruct>"))
    parts = F.array_sort(F.collect_list(F.struct("biblio_id", one.alias("x"))))
    body = F.array_join(F.transform(parts, lambda p: p["x"]), "")
    head = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><titleStmt><title>Record</title></titleStmt></teiHeader><text><body><div><head n="1">One</head><p>Text.</p></div></body><back><listBibl>'
    docs = b.groupBy("rec_id").agg(body.alias("body"))
    return docs.select("rec_id", F.concat(F.lit(head), "body", F.lit("</listBibl></back></text></TEI>")).alias("xml"))


def x7_tei_documents(spark: SparkSession, root: str) -> DataFrame:
    """Every record as TEI, read back: section list and number of references."""
    docs = read_documents(_tei(spark, root), "rec_id", "xml")
    return docs.select(F.col("id").cast("long").alias("rec_id"), "contents", F.size("references").cast("long").alias("n_references"))


def h5_markdown(spark: SparkSession, root: str) -> DataFrame:
    """H3 to H5, H9: HTML pages made of titles and venues, as Markdown."""
    b = table(spark, root, "biblio").filter("title is not null and journal is not null").select("biblio_id", "title", "journal").distinct()
    html = F.concat(F.lit("<html><body><article><h1>"), xml_escape(F.col("title")), F.lit("</h1><p>"), xml_escape(F.col("journal")), F.lit("</p></article></body></html>"))
    return pages_to_markdown(b.select("biblio_id", html.alias("html")), "biblio_id", "html").select(F.col("id").cast("long").alias("biblio_id"), "markdown")


def g12_region_text(spark: SparkSession, root: str) -> DataFrame:
    """The lines of a detection put at their places in its region and assembled."""
    rows = table(spark, root, "layout_dets").select("det_id", "poly", "ptrmfr_texts").distinct()
    lines = rows.select("det_id", F.try_element_at("poly", F.lit(1)).alias("x"), F.try_element_at("poly", F.lit(2)).alias("y"), F.posexplode("ptrmfr_texts").alias("i", "text"))
    boxes = lines.select("det_id", F.col("x").alias("xmin"), (F.col("y") + 12 * F.col("i")).alias("ymin"), (F.col("x") + 400).alias("xmax"), (F.col("y") + 12 * F.col("i") + 10).alias("ymax"), "text")
    return G.assemble(boxes, "det_id").select(F.col("region").cast("long").alias("det_id"), "text")


def x15_flagged_boxes(spark: SparkSession, root: str) -> DataFrame:
    """Boxes of orders that cover one of the even-numbered ones of their page."""
    from millrace.plans.box_queries import _boxes

    df = _boxes(spark, root).groupBy("page", "box").agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))
    return G.flagged_boxes(df.filter("box % 2 = 1"), df.filter("box % 2 = 0"), ["page"]).groupBy("page").agg(F.sum("flag").alias("n_flagged"), F.count("*").alias("n"))


def a8_aligned_pages(spark: SparkSession, root: str) -> DataFrame:
    """Each item's pages found again in its whole text."""
    rows = table(spark, root, "layout_dets").select("data_id", "page", "box_id", "det_id", "content").distinct().filter("content is not null")
    pages = rows.groupBy("data_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("box_id", "det_id", "content"))), lambda x: x["content"]), " ").alias("text"))
    items = pages.groupBy("data_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]).alias("pages"))
    return A.align_pages(items.withColumn("text", F.array_join("pages", " ")), "data_id", "pages", "text").select("id", "page_no", F.round("score", 6).alias("score"))


def a13_training_index(spark: SparkSession, root: str) -> DataFrame:
    """One row per page with text: image name and length of its lines of more than ten characters."""
    rows = table(spark, root, "layout_dets").select("det_id", "data_id", "page", "ptrmfr_texts").distinct()
    lines = F.filter(F.coalesce("ptrmfr_texts", F.array().cast("array<string>")), lambda x: F.length(x) > 10)
    per = rows.select("data_id", "page", F.aggregate(lines, F.lit(0), lambda n, x: n + F.length(x)).alias("n")).groupBy("data_id", "page").agg(F.sum("n").alias("n_chars"))
    return per.filter("n_chars > 0").select(F.concat("data_id", F.lit("/"), F.lpad(F.col("page").cast("string"), 2, "0"), F.lit(".png")).alias("image"), "n_chars")


def m14_clean_pages(spark: SparkSession, root: str) -> DataFrame:
    """M14/M16, D5, D6 over all texts (partly sequential, so without SQL)."""
    return clean_pages(table(spark, root, "documents"), "doc_id", "text").select(F.col("id").cast("long").alias("doc_id"), F.length("text").alias("n_chars"))


def h2_page_rows(spark: SparkSession, root: str) -> DataFrame:
    """H2: crawled pages as rows of host, language by words and size."""
    docs = table(spark, root, "documents").filter("site is not null")
    return docs.select("doc_id", "site", T.language_by_words(F.col("text")).alias("language"), F.length("text").alias("n_chars"))


def a7_bounds(spark: SparkSession, root: str) -> DataFrame:
    """Page bounds of every item from the page numbers of its lines with neighbours exchanged (dynamic programming, so without SQL)."""
    rows = table(spark, root, "layout_dets").select("det_id", "data_id", "page", "box_id").distinct()
    noisy = rows.withColumn("guess", F.when(F.col("det_id") % 7 == 0, F.greatest(F.col("page") - 1, F.lit(1))).otherwise(F.col("page")))
    ordered = noisy.withColumn("at", F.col("page") * 1000 + F.col("box_id"))
    return page_bounds(ordered, "data_id", "at", "guess").select(F.col("id").alias("data_id"), F.size("bounds").alias("n_pages"), F.element_at("bounds", -1).alias("last_bound"))


def a11_best_caption(spark: SparkSession, root: str) -> DataFrame:
    """For each figure text of a record the element of the same record that shares most words, ties to the smaller id."""
    rows = table(spark, root, "grobid_elements").filter("text is not null").select("element_id", "rec_id", "element_type", F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) > 3)).alias("words")).distinct()
    a = rows.filter("element_type = 'figure'").select("rec_id", F.col("element_id").alias("figure"), F.col("words").alias("x"))
    b = rows.select("rec_id", F.col("element_id").alias("other"), F.col("words").alias("y"))
    pairs = a.join(b, "rec_id").filter("figure != other").withColumn("n", F.size(F.array_intersect("x", "y")))
    return pairs.groupBy("figure").agg(F.max_by("other", F.struct(F.col("n"), -F.col("other"))).alias("other"), F.max("n").cast("long").alias("n_shared"))


def a11_placed_captions(spark: SparkSession, root: str) -> DataFrame:
    """Each figure text with the other text of its record that is most alike, if it is at least CAPTION_RATIO so."""
    rows = table(spark, root, "grobid_elements").filter("text is not null and rec_id is not null").select("element_id", "rec_id", "element_type", "text").distinct()
    a = rows.filter("element_type = 'figure'").select("rec_id", F.col("element_id").alias("figure"), F.col("text").alias("x"))
    b = rows.select("rec_id", F.col("element_id").alias("other"), F.col("text").alias("y"))
    # twice the shorter length over both is the most that the ratio can be
    most = 2 * F.least(F.length("x"), F.length("y")) / F.greatest(F.length("x") + F.length("y"), F.lit(1))
    pairs = a.join(b, "rec_id").filter((F.col("figure") != F.col("other")) & (most >= A.CAPTION_RATIO)).select(F.concat_ws(" ", "figure", "other").alias("pair"), F.array("x", "y").alias("both"))
    ratios = each_text(pairs, "pair", "both", lambda t: alike(t[0], t[1]), "ratio double").filter(F.col("ratio") >= A.CAPTION_RATIO)
    parts = F.split("id", " ")
    return ratios.groupBy(parts[0].cast("long").alias("figure")).agg(F.max_by(parts[1].cast("long"), F.struct(F.round("ratio", 9), -parts[1].cast("long"))).alias("other"), F.round(F.max("ratio"), 6).alias("ratio"))


def a9_found_figures(spark: SparkSession, root: str) -> DataFrame:
    """The captions of each scanned item found in its running text with them, as recognised."""
    rows = table(spark, root, "layout_dets").select("data_id", "page", "box_id", "det_id", "category_id", "content").distinct().filter("content is not null")
    ordered = F.array_sort(F.collect_list(F.struct("page", "box_id", "det_id", "content", "category_id")))
    items = rows.groupBy("data_id").agg(ordered.alias("parts"))
    captions = F.transform(F.filter("parts", lambda p: p["category_id"].isin(4, 6)), lambda p: p["content"])
    items = items.select("data_id", captions.alias("captions"), F.array_join(F.transform("parts", lambda p: p["content"]), " ").alias("text")).filter(F.size("captions") > 0)
    return A.find_figures(items, "data_id", "captions", "text").select(F.col("id").alias("data_id"), "caption_no", F.col("end").alias("place"), F.round("score", 6).alias("score"))


QUERIES = {
    f.__name__: f
    for f in (
        m14_clean_pages, h2_page_rows, a7_bounds, a11_best_caption, a11_placed_captions, a9_found_figures, t5_markdown, t28_document_language, t29_language, d9_label_suffix, d12_first_values, l10_place_date_lines, x7_tei_documents, h5_markdown, g12_region_text, x15_flagged_boxes,
        a8_aligned_pages, a13_training_index,
    )
}


def _language_sql(column: str) -> str:
    words = f"string_split_regex(lower({column}), '[^\\pL]+')"
    hits = ", ".join(f"{{'n': len(list_filter({words}, lambda w: w IN ({', '.join(repr(x) for x in v.split())}))), 'k': {i}}}" for i, (_, v) in enumerate(sorted(T.LANGUAGE_WORDS.items())))
    names = ", ".join(f"'{k}'" for k in sorted(T.LANGUAGE_WORDS))
    best = f"list_sort([(-x.n, x.k) FOR x IN [{hits}]])[1]"
    return f"CASE WHEN {column} IS NULL THEN NULL WHEN ({best})[1] < 0 THEN [{names}][({best})[2] + 1] ELSE 'other' END"


_SCRIPT = "CASE " + " ".join(f"WHEN x IN ({', '.join(repr(c) for c in v.split())}) THEN '{k}'" for k, v in T.SCRIPT_LANGUAGES.items()) + " ELSE x END"
_LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL)"
_T5 = r"""regexp_replace(regexp_replace(text, '(?m)^\(([0-9.]+[a-zA-Z]?)\) \\\[(.+?)\\\]$', '\\[\2 \\tag{\1}\\]', 'g'), '(?m)^\\\[(.+?)\\\] \(([0-9.]+[a-zA-Z]?)\)$', '\\[\1 \\tag{\2}\\]', 'g')"""
_COVERS = """greatest(least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin), 0) * greatest(least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin), 0) > 0
  AND abs((a.ymax + a.ymin) / 2 - (b.ymax + b.ymin) / 2) <= least(a.ymax - a.ymin, b.ymax - b.ymin) / 2
  AND (least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin) + 1) * (least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin) + 1)
    / least((a.xmax - a.xmin + 1) * (a.ymax - a.ymin + 1), (b.xmax - b.xmin + 1) * (b.ymax - b.ymin + 1)) >= 0.5"""
_LINE_BOXES = """(SELECT l_orderkey AS page, l_linenumber::BIGINT AS box, min(l_partkey % 40)::DOUBLE AS xmin, min(l_suppkey % 30)::DOUBLE AS ymin,
  max(l_partkey % 40 + 5 + l_quantity)::DOUBLE AS xmax, max(l_suppkey % 30 + 4 + l_linenumber * 3)::DOUBLE AS ymax FROM lineitem GROUP BY 1, 2)"""
SQL = {
    "x15_flagged_boxes": f"""WITH k AS {_LINE_BOXES} SELECT page, count(*) FILTER (EXISTS (SELECT 1 FROM k AS b WHERE b.page = a.page AND b.box % 2 = 0 AND {_COVERS}))::BIGINT AS n_flagged, count(*) AS n
      FROM k AS a WHERE box % 2 = 1 GROUP BY page""",
    "t5_markdown": rf"SELECT doc_id, md5(regexp_replace(replace(replace({_T5}, '\. ', '. '), '\bm{{', '\mathbf{{'), '(https?://[\w_-]+(?:\.[\w_-]+)+[\w.,@?^=%&:/~+#-]*[\w@?^=%&/~+#-])', '[\1](\1)', 'g')) AS digest FROM documents",
    "h2_page_rows": f"SELECT doc_id, site, {_language_sql('text')} AS language, len(text)::INT AS n_chars FROM documents WHERE site IS NOT NULL",
    "a11_best_caption": """WITH w AS (SELECT DISTINCT element_id, rec_id, element_type, list_distinct(list_filter(string_split_regex(lower(text), '[^\\pL]+'), lambda w: len(w) > 3)) AS words FROM (SELECT DISTINCT element_id, rec_id, element_type, text FROM grobid_elements WHERE text IS NOT NULL)),
      p AS (SELECT a.element_id AS figure, b.element_id AS other, len(list_intersect(a.words, b.words)) AS n FROM w a JOIN w b ON a.rec_id = b.rec_id AND a.element_id <> b.element_id WHERE a.element_type = 'figure')
      SELECT figure, arg_max(other, (n, -other)) AS other, max(n) AS n_shared FROM p GROUP BY 1""",
    "t28_document_language": f"""SELECT doc_id, {_SCRIPT} AS script FROM (SELECT doc_id, CASE WHEN language IS NULL OR language = 'other' THEN coalesce(nullif({_language_sql('title')}, 'other'), 'en') WHEN language = 'chinese' THEN 'ch' ELSE language END AS x
      FROM (SELECT DISTINCT * FROM tei_meta))""",
    "t29_language": f"SELECT doc_id, {_language_sql('text')} AS language FROM documents",
    "d9_label_suffix": """SELECT element_id, label || repeat('a', (row_number() OVER (PARTITION BY rec_id, label ORDER BY element_id) - 1)::INT) AS label
      FROM (SELECT DISTINCT element_id, rec_id, coalesce(figure_lable, '') AS label FROM grobid_elements)""",
    "d12_first_values": "SELECT DISTINCT det_id, array_to_string(list_filter(ptrmfr_texts, lambda x, i: list_position(ptrmfr_texts, x) = i), '|') AS lines FROM layout_dets",
    "l10_place_date_lines": f"SELECT doc_id, count(*) AS n FROM {_LINES} WHERE regexp_matches(line, '^[a-zA-Z\\- ,]+, [0-9\\- ,]+$') AND len(line) < 100 GROUP BY 1",
    "x7_tei_documents": "SELECT rec_id, '1 One' AS contents, count(DISTINCT biblio_id) AS n_references FROM biblio GROUP BY 1",
    "h5_markdown": """SELECT DISTINCT biblio_id, '# ' || regexp_replace(regexp_replace(title, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g') || chr(10) || chr(10) || regexp_replace(regexp_replace(journal, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS markdown
      FROM biblio WHERE title IS NOT NULL AND journal IS NOT NULL""",
    "g12_region_text": """SELECT DISTINCT det_id, array_to_string(list_filter(list_transform(ptrmfr_texts, lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> ''), ' ') AS text FROM layout_dets WHERE len(ptrmfr_texts) > 0""",
    "a13_training_index": """SELECT data_id || '/' || lpad(page::VARCHAR, 2, '0') || '.png' AS image, sum(n)::BIGINT AS n_chars FROM (SELECT DISTINCT det_id, data_id, page, list_sum(list_transform(list_filter(ptrmfr_texts, lambda x: len(x) > 10), lambda x: len(x))) AS n FROM layout_dets)
      GROUP BY data_id, page HAVING sum(n) > 0""",
}
