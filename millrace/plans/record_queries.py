"""Queries over TEI, records, alignment, scores and stages (survey ids X*, A*, E*, K*, M15, O*, T14, T19), with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import stages as K
from millrace.operators import tei as X
from millrace.operators.align import edit_share
from millrace.operators.structure import each_text
from millrace.sources.tables import table


def _meta(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "tei_meta").distinct()


def x2_get_meta(spark: SparkSession, root: str) -> DataFrame:
    """TEI headers written and read again."""
    xml = _meta(spark, root).select("doc_id", X.tei_header(F.col("title"), F.col("author"), F.col("keywords"), F.col("pub_date")).alias("xml"))
    f = X.read_header("xml")
    return xml.select("doc_id", f["title"].alias("title"), F.array_join(f["authors"], "; ").alias("authors"), f["keywords"].alias("keywords"), f["pub_date"].alias("pub_date"))


def x8_biblio_fields(spark: SparkSession, root: str) -> DataFrame:
    b = table(spark, root, "biblio").drop("authors").distinct()
    return b.select("biblio_id", X.year_of(F.col("date")).alias("year"), *X.page_range(F.col("pages")))


def x12_csl_fields(spark: SparkSession, root: str) -> DataFrame:
    """Records as CSL-like JSON without empty fields, as the number of fields that remain."""
    b = table(spark, root, "biblio").drop("authors").distinct()
    fields = {"title": "title", "container-title": "journal", "volume": "volume", "issue": "issue", "page": "pages", "publisher": "publisher"}
    struct = F.struct(*[F.nullif(F.col(v), F.lit("")).alias(k) for k, v in fields.items()])
    return b.select("biblio_id", F.coalesce(F.size(F.json_object_keys(F.to_json(struct))), F.lit(0)).alias("n_fields"))


def x13_references(spark: SparkSession, root: str) -> DataFrame:
    b = table(spark, root, "biblio")
    names = F.transform(F.coalesce("authors", F.array().cast(b.schema["authors"].dataType)), lambda a: F.coalesce(a["full_name"], F.lit("")))
    kind = F.when(F.col("journal").isNotNull(), "J").when(F.col("book_title").isNotNull(), "A").otherwise("OWL")
    entry = X.reference_entry(F.col("ref_index"), F.concat(F.lit("b"), F.col("ref_index").cast("string")), names, F.coalesce("title", F.lit("")), F.col("journal"), kind)
    return b.select("biblio_id", entry.alias("entry")).distinct()


def _coords(spark: SparkSession, root: str) -> DataFrame:
    """Coordinate strings of an order: one box per line."""
    box = F.concat_ws(",", F.col("l_linenumber").cast("string"), (F.col("l_partkey") % 500).cast("string"), (F.col("l_suppkey") % 700).cast("string"), (F.col("l_partkey") % 90 + 1).cast("string"), (F.col("l_suppkey") % 13).cast("string"))
    rows = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", box.alias("box"))
    parts = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "box")))
    return rows.groupBy("l_orderkey").agg(F.array_join(F.transform(parts, lambda x: x["box"]), ";").alias("coords"))


def x14_relative_coords(spark: SparkSession, root: str) -> DataFrame:
    return _coords(spark, root).select("l_orderkey", X.relative_coords(F.col("coords"), 640.0, 800.0).alias("coords"))


def x16_split_coords(spark: SparkSession, root: str) -> DataFrame:
    return _coords(spark, root).select("l_orderkey", F.posexplode(X.coords(F.col("coords"))).alias("pos", "b")).select("l_orderkey", F.col("pos").cast("long"), F.col("b")[0].cast("long").alias("page"), (F.col("b")[1] + F.col("b")[3]).alias("x_end"))


def x18_full_names(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "author_mentions").select("mention_id", X.full_name(F.col("given_name"), F.col("middle_name"), F.col("surname")).alias("name")).distinct()


def x1_scanned(spark: SparkSession, root: str) -> DataFrame:
    """Items of whose first eight pages all but five or more are without text."""
    rows = table(spark, root, "layout_dets").filter("page <= 8").groupBy("data_id", "page").agg(F.max(F.coalesce(F.length("content") > 0, F.lit(False))).alias("has_text"))
    return rows.groupBy("data_id").agg(F.count("*").alias("pages"), F.count_if("has_text").alias("text_pages")).withColumn("scanned", F.col("text_pages") < F.col("pages") - 5)


def a1_stem_join(spark: SparkSession, root: str) -> DataFrame:
    """A1/A2: documents with their catalog rows (inner) and TEI rows (left), without those already parsed."""
    docs = table(spark, root, "documents").select("doc_id", "data_id", "parse_type")
    cat = table(spark, root, "data_catalog").select(F.col("id").alias("data_id")).distinct()
    meta = table(spark, root, "tei_meta").select("doc_id", F.lit(True).alias("meta")).distinct()
    done = docs.filter("parse_type = '2'").select("doc_id")
    return docs.join(cat, "data_id").join(meta, "doc_id", "left").join(done, "doc_id", "left_anti").select("doc_id", "data_id", F.coalesce("meta", F.lit(False)).alias("has_meta"))


def a4_recognised_share(spark: SparkSession, root: str) -> DataFrame:
    """A3/A4: share of pages kept per dataset, pages with an unresolved mark dropped."""
    rows = table(spark, root, "layout_dets").groupBy("version", "data_id", "page").agg(F.max(F.coalesce(F.col("content").contains("[??]"), F.lit(False))).alias("bad"), F.count("content").alias("n"))
    kept = F.count_if(~F.col("bad") & (F.col("n") > 0))
    return rows.groupBy("version").agg(F.round(kept / F.greatest(F.count("*"), F.lit(1)), 6).alias("share"), F.count("*").alias("n_pages"))


def a7a_gini(spark: SparkSession, root: str) -> DataFrame:
    """N - sum(c^2) / n of the event types of each user."""
    counts = table(spark, root, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("c"))
    return counts.groupBy("user_id").agg(F.round(F.sum("c") - F.sum(F.col("c") * F.col("c")) / F.sum("c"), 6).alias("gini"))


def a12_tags(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "grobid_elements").select("element_id", X.without_figure_tags(F.col("text")).alias("text"))


def a15_reverse(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "layout_dets").select("det_id", F.array_join(F.transform(F.reverse("ptrmfr_texts"), lambda x: F.reverse(x)), "|").alias("lines")).distinct()


def t19_buckets(spark: SparkSession, root: str) -> DataFrame:
    """The line of a document in which its middle falls."""
    docs = table(spark, root, "documents").filter("text is not null")
    lengths = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("idx", "line")).select("doc_id", "idx", (F.length("line") + 1).alias("length"))
    middle = docs.select("doc_id", F.floor(F.length("text") / 2).alias("offset"))
    return X.bucket_of(middle, lengths, "doc_id").select("doc_id", F.col("offset").cast("long"), F.col("idx").cast("long"))


def e1_edit_share(spark: SparkSession, root: str) -> DataFrame:
    """Recognised lines against the joined content."""
    rows = table(spark, root, "layout_dets").filter("content is not null and ptrmfr_texts is not null").select("det_id", F.array("content", F.array_join("ptrmfr_texts", " ")).alias("both"))
    shares = each_text(rows, "det_id", "both", lambda x: edit_share(x[0], x[1]), "share double").filter("share is not null")
    return shares.select(F.col("id").cast("long").alias("det_id"), F.round("share", 6).alias("share")).distinct()


def e2_token_scores(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "biblio").filter("title is not null and unstructured is not null").select("biblio_id", *X.token_scores(F.col("title"), F.col("unstructured"))).distinct()


def e4_text_parts(spark: SparkSession, root: str) -> DataFrame:
    """Inline and displayed formulas and the rest of each element's text."""
    shown, inline = r"\$\$[^$]+\$\$|\\\[[^\n]*?\\\]", r"\\\([^\n]*?\\\)"
    df = table(spark, root, "grobid_elements").filter("text is not null")
    rest = F.regexp_replace(F.regexp_replace("text", shown, ""), inline, "")
    return df.select("element_id", F.size(F.regexp_extract_all("text", F.lit(shown), F.lit(0))).cast("long").alias("n_shown"), F.size(F.regexp_extract_all("text", F.lit(inline), F.lit(0))).cast("long").alias("n_inline"), F.length(rest).alias("n_text")).distinct()


def e5_means(spark: SparkSession, root: str) -> DataFrame:
    scores = e2_token_scores(spark, root)
    return scores.agg(*[F.round(F.avg(c), 6).alias(c) for c in ("precision", "recall", "f1")], F.count("*").alias("n"))


def k2_stages(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "grobid_elements").select("element_id", "text")
    return K.run_stages(docs, "text", [("parse", "0"), ("tag", "0"), ("clean", "0,1")]).select("element_id", "status", "message", F.when(F.col("status"), F.length("text")).alias("n_chars"))


def k1_job_types(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "lineitem").groupBy((F.col("l_linenumber") - 1).alias("code")).agg(F.count("*").alias("n")).select("code", K.job_type(F.col("code")).alias("job_type"), "n")


def m15_variance(spark: SparkSession, root: str) -> DataFrame:
    """Population variance of the last fifteen values of each user's events."""
    order = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-14, 0)
    return table(spark, root, "events").select("event_id", F.round(F.var_pop("value").over(order) / 15, 4).alias("var15"))


def o5_formulas(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "layout_dets").filter("category_id in (8, 14) and content is not null")
    return rows.select("det_id", K.wrap_formula(T.strip(F.col("content")), F.col("category_id")).alias("formula")).distinct()


QUERIES = {
    f.__name__: f
    for f in (
        x1_scanned, x2_get_meta, x8_biblio_fields, x12_csl_fields, x13_references, x14_relative_coords, x16_split_coords, x18_full_names, a1_stem_join, a4_recognised_share, a7a_gini, a12_tags,
        a15_reverse, t19_buckets, e1_edit_share, e2_token_scores, e4_text_parts, e5_means, k1_job_types, k2_stages, m15_variance, o5_formulas,
    )
}
_M = "(SELECT DISTINCT * FROM tei_meta)"
_B = "(SELECT DISTINCT * EXCLUDE (authors) FROM biblio)"
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_TOK = "list_distinct(list_filter(string_split_regex({0}, '\\s+'), lambda w: w <> ''))"
_E2 = f"""(SELECT DISTINCT biblio_id, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS f1 FROM
  (SELECT biblio_id, CASE WHEN len(x) = 0 THEN 0.0 ELSE len(list_intersect(x, y)) / len(x) END AS p, CASE WHEN len(y) = 0 THEN 0.0 ELSE len(list_intersect(x, y)) / len(y) END AS r FROM
  (SELECT biblio_id, {_TOK.format('title')} AS x, {_TOK.format('unstructured')} AS y FROM biblio WHERE title IS NOT NULL AND unstructured IS NOT NULL)))"""
_BOX = "SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS pos, l_linenumber AS page, l_partkey % 500 AS x, l_suppkey % 700 AS y, l_partkey % 90 + 1 AS w, l_suppkey % 13 AS h FROM lineitem"
_STAGED = f"""(SELECT element_id, text, {_STRIP.format("regexp_replace(regexp_replace(regexp_replace(text, ' +', ' ', 'g'), ' *[\\r\\n]+', chr(10), 'g'), '\\n+ *', chr(10), 'g')")} AS p FROM grobid_elements)"""
_LIG = "p"
for _a, _b in T.LIGATURES:
    _LIG = f"replace({_LIG}, '{_a}', '{_b}')"
_NUM = _STRIP.format(f"regexp_replace({_LIG}, '[0-9_]|\\*\\*', '', 'g')")
SQL = {
    "x1_scanned": """SELECT data_id, count(*) AS pages, count(*) FILTER (t) AS text_pages, count(*) FILTER (t) < count(*) - 5 AS scanned
      FROM (SELECT data_id, page, bool_or(coalesce(len(content) > 0, FALSE)) AS t FROM layout_dets WHERE page <= 8 GROUP BY 1, 2) GROUP BY 1""",
    "x2_get_meta": f"SELECT doc_id, nullif(title, '') AS title, array_to_string(coalesce(author, []), '; ') AS authors, nullif(keywords, '') AS keywords, nullif(pub_date, '') AS pub_date FROM {_M}",
    "x8_biblio_fields": f"SELECT biblio_id, try_cast(nullif(regexp_extract(date, '\\d{{4}}'), '') AS INT) AS year, nullif(regexp_extract(pages, '\\d+'), '') AS page_from, nullif(regexp_extract(pages, '\\d+\\s*[-–]+\\s*(\\d+)', 1), '') AS page_to FROM {_B}",
    "x12_csl_fields": f"SELECT biblio_id, ({' + '.join(f'(coalesce({c}, {chr(39) * 2}) <> {chr(39) * 2})::INT' for c in ('title', 'journal', 'volume', 'issue', 'pages', 'publisher'))})::INT AS n_fields FROM {_B}",
    "x13_references": """SELECT DISTINCT biblio_id, ref_index || '.[' || ref_index || '](<b' || ref_index || '>' || array_to_string([coalesce(a.full_name, '') FOR a IN coalesce(authors, [])], ',') || '.' || coalesce(title, '') || '.['
      || CASE WHEN journal IS NOT NULL THEN 'J' WHEN book_title IS NOT NULL THEN 'A' ELSE 'OWL' END || ']' || coalesce(',' || journal, '') || ')' AS entry FROM biblio""",
    "x16_split_coords": f"SELECT l_orderkey, pos, page, (x + w)::DOUBLE AS x_end FROM ({_BOX})",
    "x18_full_names": "SELECT DISTINCT mention_id, concat_ws(' ', given_name, middle_name, surname) AS name FROM author_mentions",
    "a1_stem_join": """SELECT d.doc_id, d.data_id, EXISTS (SELECT 1 FROM tei_meta t WHERE t.doc_id = d.doc_id) AS has_meta FROM documents d
      WHERE EXISTS (SELECT 1 FROM data_catalog c WHERE c.id = d.data_id) AND NOT EXISTS (SELECT 1 FROM documents x WHERE x.doc_id = d.doc_id AND x.parse_type = '2')""",
    "a4_recognised_share": """SELECT version, round(count(*) FILTER (NOT bad AND n > 0) / count(*), 6) AS share, count(*) AS n_pages
      FROM (SELECT version, data_id, page, bool_or(coalesce(contains(content, '[??]'), FALSE)) AS bad, count(content) AS n FROM layout_dets GROUP BY 1, 2, 3) GROUP BY 1""",
    "a7a_gini": "SELECT user_id, round(sum(c) - sum(c * c) / sum(c), 6) AS gini FROM (SELECT user_id, event_type, count(*) AS c FROM events GROUP BY 1, 2) GROUP BY 1",
    "a12_tags": f"SELECT element_id, {_STRIP.format(chr(39).join(['regexp_replace(regexp_replace(text, ', '\\[(?:END)?(?:FIGURE|TABLE)(?::[^\\]]*)?\\]|\\[(?:START|END)_(?:FIGURE|TABLE)\\]', ', ', '', ', ', 'g', '), ', '\\[(?:START|END)_NOTE\\]', ', ', '', ', ', 'g', ')']))} AS text FROM grobid_elements",
    "a15_reverse": "SELECT DISTINCT det_id, array_to_string([reverse(x) FOR x IN list_reverse(ptrmfr_texts)], '|') AS lines FROM layout_dets",
    "t19_buckets": """WITH l AS (SELECT doc_id, text, unnest(range(0, len(string_split(text, chr(10))))) AS idx FROM documents WHERE text IS NOT NULL),
      s AS (SELECT doc_id, text, idx, sum(len(string_split(text, chr(10))[idx + 1]) + 1) OVER (PARTITION BY doc_id ORDER BY idx) AS e FROM l)
      SELECT doc_id, len(text) // 2 AS "offset", min(idx) AS idx FROM s WHERE e > len(text) // 2 GROUP BY doc_id, text""",
    "e1_edit_share": """SELECT DISTINCT det_id, round(levenshtein(array_to_string(ptrmfr_texts, ' '), content) / greatest(len(array_to_string(ptrmfr_texts, ' ')), len(content)), 6) AS share
      FROM layout_dets WHERE len(content) >= 4 AND len(array_to_string(ptrmfr_texts, ' ')) >= 4""",
    "e2_token_scores": f"SELECT * FROM {_E2}",
    "e4_text_parts": """SELECT DISTINCT element_id, len(regexp_extract_all(text, '\\$\\$[^$]+\\$\\$|\\\\\\[[^\\n]*?\\\\\\]')) AS n_shown, len(regexp_extract_all(text, '\\\\\\([^\\n]*?\\\\\\)')) AS n_inline,
      len(regexp_replace(regexp_replace(text, '\\$\\$[^$]+\\$\\$|\\\\\\[[^\\n]*?\\\\\\]', '', 'g'), '\\\\\\([^\\n]*?\\\\\\)', '', 'g'))::INT AS n_text FROM grobid_elements WHERE text IS NOT NULL""",
    "e5_means": f"SELECT round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1, count(*) AS n FROM {_E2}",
    "k1_job_types": "SELECT (l_linenumber - 1)::INT AS code, CASE l_linenumber - 1 WHEN 0 THEN 'normal' WHEN 1 THEN 'pdfParse' WHEN 2 THEN 'cc' WHEN 3 THEN 'crawler' END AS job_type, count(*) AS n FROM lineitem GROUP BY 1, 2",
    "k2_stages": f"""SELECT element_id, coalesce(p <> '', FALSE) AND coalesce({_NUM} <> '', FALSE) AS status, CASE WHEN NOT coalesce(p <> '', FALSE) THEN 'no text' WHEN {_NUM} = '' THEN 'empty after clean 1' ELSE '' END AS message,
      CASE WHEN coalesce(p <> '', FALSE) AND {_NUM} <> '' THEN len({_NUM})::INT END AS n_chars FROM {_STAGED}""",
    "m15_variance": "SELECT event_id, round(var_pop(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) / 15, 4) AS var15 FROM events",
    "o5_formulas": f"""SELECT DISTINCT det_id, CASE WHEN category_id = 13 THEN '$' || b || '$' ELSE '$$' || b || '$$' END AS formula FROM
      (SELECT det_id, category_id, replace({_STRIP.format('content')}, '$', '\\$') AS b FROM layout_dets WHERE category_id IN (8, 14) AND content IS NOT NULL)""",
}
