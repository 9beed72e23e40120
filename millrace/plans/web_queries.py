"""Queries over links, HTML and repeated text (survey ids C*, H*, D1 to D4, D7), with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import repeats as R
from millrace.operators import web as X
from millrace.sources.tables import table


def _urls(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "site", F.explode(X.links(F.col("text"))).alias("url"))
    return docs.filter("url != ''")


def c1_pages(spark: SparkSession, root: str) -> DataFrame:
    return _urls(spark, root).select("doc_id", "url", X.is_page(F.col("url")).alias("is_page"), X.host(F.col("url")).alias("host")).distinct()


def c2_normal_urls(spark: SparkSession, root: str) -> DataFrame:
    return _urls(spark, root).select(X.normal_url(F.col("url")).alias("url")).groupBy("url").agg(F.count("*").alias("n"))


def c3_links(spark: SparkSession, root: str) -> DataFrame:
    return _urls(spark, root).groupBy("doc_id").agg(F.count("*").alias("n_links"), F.count_distinct("url").alias("n_distinct"))


def c4_join_url(spark: SparkSession, root: str) -> DataFrame:
    base = F.concat(F.lit("https://"), "site", F.lit("/a/b.html"))
    rows = table(spark, root, "documents").filter("site is not null").select("doc_id", base.alias("base"), F.explode(F.array(F.lit("x.html"), F.lit("/y/z"), F.lit("http://other.example/q"))).alias("link"))
    return rows.select("doc_id", "link", X.join_url(F.col("base"), F.col("link")).alias("url"))


def c5_same_host(spark: SparkSession, root: str) -> DataFrame:
    return _urls(spark, root).filter(X.host(F.col("url")) == F.col("site")).groupBy("site").agg(F.count("*").alias("n"))


def _edges(spark: SparkSession, root: str) -> DataFrame:
    return _urls(spark, root).select("site", X.host(F.col("url")).alias("to")).filter("site is not null and site != to").distinct()


def c6_reachable(spark: SparkSession, root: str) -> DataFrame:
    """Hosts that can be reached over the links of crawled pages from the first host by name."""
    edges = _edges(spark, root)
    start = edges.agg(F.min("site").alias("site")).filter("site is not null")
    return X.reachable(edges, start, "site", "to")


def c7_file_names(spark: SparkSession, root: str) -> DataFrame:
    return _urls(spark, root).select("url", X.file_name(F.col("url")).alias("file_name")).distinct()


def d7_visited(spark: SparkSession, root: str) -> DataFrame:
    """The first document by id that leads to each normal URL."""
    return _urls(spark, root).groupBy(X.normal_url(F.col("url")).alias("url")).agg(F.min("doc_id").alias("doc_id"))


def h1_html_text(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "grobid_elements").select("element_id", X.html_text(F.col("text")).alias("text"))


def h7_white_space(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "grobid_elements").select("element_id", F.regexp_replace("text", r"\s+", " ").alias("text"))


def h6_column_mode(spark: SparkSession, root: str) -> DataFrame:
    """H6: the most frequent number of cells per row of each table's grid, ties to the larger."""
    rows = table(spark, root, "grobid_elements").filter("element_type = 'table'").select("element_id", "text").distinct()
    lines = rows.select("element_id", F.posexplode(F.split("text", "\n")).alias("idx", "line")).filter(F.col("line").rlike(r"^\|.*\|$"))
    cells = lines.select("element_id", (F.size(F.split("line", r"\|")) - 2).cast("long").alias("n_cells"))
    counts = cells.groupBy("element_id", "n_cells").agg(F.count("*").alias("n"))
    return counts.groupBy("element_id").agg(F.max_by("n_cells", F.struct("n", "n_cells")).alias("columns"))


def h10_filled_lists(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "layout_dets").select("det_id", F.coalesce(X.outer_blanks(F.col("ptrmfr_texts")), F.lit(False)).alias("filled")).distinct()


def d1_d4_repeats(spark: SparkSession, root: str) -> DataFrame:
    """D1 to D4 over all texts (sequential scans, so without SQL): characters cut, and stretches of alike lines."""
    return R.clean_repeats(table(spark, root, "documents")).select("doc_id", F.length("text").alias("n_chars"), "n_cut", "n_slices")


QUERIES = {
    f.__name__: f
    for f in (c1_pages, c2_normal_urls, c3_links, c4_join_url, c5_same_host, c6_reachable, c7_file_names, d7_visited, h1_html_text, h7_white_space, h6_column_mode, h10_filled_lists, d1_d4_repeats)
}
_U = """(SELECT doc_id, site, url FROM (SELECT doc_id, site, unnest(list_transform(regexp_extract_all(text, 'https?://[^\\s)\\]"''<>]+'), lambda x: regexp_replace(x, '[\\\\"''.,;]+$', ''))) AS url FROM documents) WHERE url <> '')"""
_N = """(SELECT doc_id, string_split(url, '//')[1] || '//' || array_to_string(list_filter(p, lambda x, i: x <> '' AND list_position(p, x) = i), '/') AS url
  FROM (SELECT doc_id, url, string_split(coalesce(string_split(url, '//')[2], ''), '/') AS p FROM {0}))""".format(_U)
_HOST = "regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)"
_TEXT = "regexp_replace(regexp_replace(text, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), '</?[a-zA-Z][^<>]*>', ' ', 'g')"
for _a, _b in X.ENTITIES:
    _TEXT = f"replace({_TEXT}, '{_a}', '{_b.replace(chr(39), chr(39) * 2)}')"
_CLEAN = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({_TEXT}, ' +', ' ', 'g'), ' *[\\r\\n]+', chr(10), 'g'), '\\n+ *', chr(10), 'g'), '^\\s+|\\s+$', '', 'g')"
SQL = {
    "c1_pages": f"SELECT DISTINCT doc_id, url, NOT regexp_extract(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '[^/]\\.([^./]+)$', 1) IN {X.MEDIA} AS is_page, {_HOST} AS host FROM {_U}",
    "c2_normal_urls": f"SELECT url, count(*) AS n FROM {_N} GROUP BY 1",
    "c3_links": f"SELECT doc_id, count(*) AS n_links, count(DISTINCT url) AS n_distinct FROM {_U} GROUP BY 1",
    "c4_join_url": """SELECT doc_id, link, CASE link WHEN 'x.html' THEN 'https://' || site || '/a/x.html' WHEN '/y/z' THEN 'https://' || site || '/y/z' ELSE link END AS url
      FROM (SELECT doc_id, site, unnest(['x.html', '/y/z', 'http://other.example/q']) AS link FROM documents WHERE site IS NOT NULL)""",
    "c5_same_host": f"SELECT site, count(*) AS n FROM {_U} WHERE {_HOST} = site GROUP BY 1",
    "c6_reachable": f"""WITH RECURSIVE e AS (SELECT DISTINCT site, {_HOST} AS t FROM {_U} WHERE site IS NOT NULL AND site <> {_HOST}),
      r(node, depth) AS (SELECT min(site), 0::BIGINT FROM e UNION SELECT e.t, r.depth + 1 FROM r JOIN e ON e.site = r.node WHERE r.depth < 12) SELECT node, min(depth) AS depth FROM r WHERE node IS NOT NULL GROUP BY 1""",
    "c7_file_names": f"SELECT DISTINCT url, replace(replace(replace(regexp_replace(url, '^https?://', ''), '/', '_'), '?', '_'), '&', '_') AS file_name FROM {_U}",
    "d7_visited": f"SELECT url, min(doc_id) AS doc_id FROM {_N} GROUP BY 1",
    "h1_html_text": f"SELECT element_id, {_CLEAN} AS text FROM grobid_elements",
    "h7_white_space": "SELECT element_id, regexp_replace(text, '\\s+', ' ', 'g') AS text FROM grobid_elements",
    "h6_column_mode": """WITH l AS (SELECT element_id, unnest(string_split(text, chr(10))) AS line FROM (SELECT DISTINCT element_id, text FROM grobid_elements WHERE element_type = 'table')),
      c AS (SELECT element_id, len(string_split(line, '|')) - 2 AS n_cells, count(*) AS n FROM l WHERE regexp_matches(line, '^\\|.*\\|$') GROUP BY 1, 2)
      SELECT element_id, arg_max(n_cells, (n, n_cells))::BIGINT AS columns FROM c GROUP BY 1""",
    "h10_filled_lists": "SELECT DISTINCT det_id, coalesce(len(list_filter(ptrmfr_texts, lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g') <> '')) > 0, FALSE) AS filled FROM layout_dets",
}
