"""Queries over boxes (survey ids G*), with their SQL; boxes are computed from order lines, and taken from scanned pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import boxes as B
from millrace.sources.tables import table

PAGE = ["page"]
_BOXES = """(SELECT l_orderkey AS page, l_linenumber::BIGINT AS box, (l_suppkey % 15)::BIGINT AS cat, l_discount AS score, (l_partkey % 40)::DOUBLE AS xmin, (l_suppkey % 30)::DOUBLE AS ymin,
  (l_partkey % 40 + 5 + l_quantity)::DOUBLE AS xmax, (l_suppkey % 30 + 4 + l_linenumber * 3)::DOUBLE AS ymax FROM lineitem)"""


def _boxes(spark: SparkSession, root: str) -> DataFrame:
    """Boxes that lines of orders stand for: several to a page, overlapping and nested."""
    x, y = F.col("l_partkey") % 40, F.col("l_suppkey") % 30
    return table(spark, root, "lineitem").select(
        F.col("l_orderkey").alias("page"), F.col("l_linenumber").cast("long").alias("box"), (F.col("l_suppkey") % 15).alias("cat"), F.col("l_discount").alias("score"),
        x.cast("double").alias("xmin"), y.cast("double").alias("ymin"), (x + 5 + F.col("l_quantity")).cast("double").alias("xmax"), (y + 4 + F.col("l_linenumber") * 3).cast("double").alias("ymax"),
    )


def _dets(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "layout_dets").select("det_id", "data_id", "page", F.col("box_id").cast("long").alias("box"), F.col("category_id").alias("cat"), "score", "poly", "content").distinct()


def g1_rects(spark: SparkSession, root: str) -> DataFrame:
    return _dets(spark, root).select("det_id", *B.rect_of_poly(F.col("poly")))


def g2_intersections(spark: SparkSession, root: str) -> DataFrame:
    return B.pairs(_boxes(spark, root), PAGE).select("page", "a_box", "b_box", F.round(B.common_area(), 6).alias("area"))


def g2_intersections_banded(spark: SparkSession, root: str) -> DataFrame:
    return B.pairs(_boxes(spark, root), PAGE, banded=8.0).select("page", "a_box", "b_box", F.round(B.common_area(), 6).alias("area"))


def g3_free_intervals(spark: SparkSession, root: str) -> DataFrame:
    rows = _boxes(spark, root).withColumn("lo", F.lit(0.0)).withColumn("hi", F.lit(100.0))
    return B.free_intervals(rows, PAGE).select("page", F.col("from").alias("free_from"), F.col("to").alias("free_to"))


def g4_suppress(spark: SparkSession, root: str) -> DataFrame:
    df = _boxes(spark, root)
    return df.join(B.suppressed(df, PAGE), ["page", "box"], "left_anti").select("page", "box")


def g5_suppress_layout(spark: SparkSession, root: str) -> DataFrame:
    df = _boxes(spark, root)
    return df.join(B.suppressed(df, PAGE, figures_apart=True), ["page", "box"], "left_anti").select("page", "box")


def g6_merge(spark: SparkSession, root: str) -> DataFrame:
    return B.merged(_boxes(spark, root), PAGE)


def g7_union(spark: SparkSession, root: str) -> DataFrame:
    """Isolated formulas appended to the layout set with score 1."""
    df = _boxes(spark, root)
    layout, formulas = df.filter(f"cat <> {B.FORMULA}"), df.filter(f"cat = {B.FORMULA}").withColumn("score", F.lit(1.0))
    return layout.unionByName(formulas).groupBy("page").agg(F.count("*").alias("n"), F.round(F.sum("score"), 6).alias("score"))


def g10_attach(spark: SparkSession, root: str) -> DataFrame:
    df = _boxes(spark, root)
    return B.attached(df.filter("cat < 7"), df.filter("cat >= 7"), PAGE)


def g12a_lines(spark: SparkSession, root: str) -> DataFrame:
    return B.line_numbers(_boxes(spark, root), PAGE).select("page", "box", "line_no")


def g12b_edges(spark: SparkSession, root: str) -> DataFrame:
    return B.left_edge_clusters(_boxes(spark, root), PAGE).select("page", "box", F.col("cluster").cast("long"))


def _scanned(spark: SparkSession, root: str) -> DataFrame:
    return _dets(spark, root).select("data_id", "page", "box", "cat", *B.rect_of_poly(F.col("poly")))


def g13_captions(spark: SparkSession, root: str) -> DataFrame:
    """Captions of figures and of tables with their nearest figure or table."""
    df = _scanned(spark, root)
    return B.captions(df, ["data_id", "page"], [3, 5], [4, 6]).select("data_id", "page", "a_box", "b_box", F.round("gap", 6).alias("gap"))


def g15_render(spark: SparkSession, root: str) -> DataFrame:
    df = _dets(spark, root).filter("content is not null")
    return B.render(df, ["data_id", "page"], "content").select("data_id", "page", F.length("content").alias("n_chars"), F.md5("content").alias("digest"))


def g16_crop_names(spark: SparkSession, root: str) -> DataFrame:
    xmin, ymin, xmax, ymax = (F.col(c) for c in B.SIDES)
    df = _boxes(spark, root)
    part = lambda c: F.bround(c / 100, 4).cast("string")
    return df.select("page", "box", F.concat_ws("_", part(xmax - xmin), part(ymax - ymin), part(xmin), part(ymin), F.col("page").cast("string")).alias("name"))


def g18_numbering(spark: SparkSession, root: str) -> DataFrame:
    """Figures numbered over the pages of an item."""
    from pyspark.sql import Window as W

    df = _scanned(spark, root).filter("cat = 3")
    return df.select("data_id", "page", "box", F.row_number().over(W.partitionBy("data_id").orderBy("page", "box")).cast("long").alias("figure_no"))


def g19_page_ids(spark: SparkSession, root: str) -> DataFrame:
    df = _dets(spark, root).groupBy("data_id").agg(F.max("page").alias("n_pages"))
    return df.select("data_id", F.lpad(F.lit("1"), F.length(F.col("n_pages").cast("string")), "0").alias("first_page_id"))


def g21_page_buckets(spark: SparkSession, root: str) -> DataFrame:
    """Figures per page from 1 to the last, empty pages too."""
    df = _scanned(spark, root)
    pages = df.groupBy("data_id").agg(F.max("page").alias("last")).select("data_id", F.explode(F.sequence(F.lit(1), "last")).alias("page"))
    figures = df.filter("cat = 3").groupBy("data_id", "page").agg(F.count("*").alias("n"))
    return pages.join(figures, ["data_id", "page"], "left").select("data_id", "page", F.coalesce("n", F.lit(0)).alias("n_figures"))


QUERIES = {
    f.__name__: f
    for f in (
        g1_rects, g2_intersections, g2_intersections_banded, g3_free_intervals, g4_suppress, g5_suppress_layout, g6_merge, g7_union, g10_attach, g12a_lines, g12b_edges, g13_captions,
        g15_render, g16_crop_names, g18_numbering, g19_page_ids, g21_page_buckets,
    )
}
_OV = "greatest(least(a.{0}max, b.{0}max) - greatest(a.{0}min, b.{0}min), 0)"
_COMMON = f"({_OV.format('x')} * {_OV.format('y')})"
_AREA = "(({0}.xmax - {0}.xmin) * ({0}.ymax - {0}.ymin))"
_PAIR = f"{_BOXES} a JOIN {_BOXES} b ON a.page = b.page AND a.box <> b.box AND a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax"
_A_IN, _B_IN = f"({_COMMON} > 0.8 * {_AREA.format('a')})", f"({_COMMON} > 0.8 * {_AREA.format('b')})"
_WORSE = "(a.score < b.score OR (a.score = b.score AND a.box > b.box))"
_DROP = "SELECT page, box FROM {0} k WHERE NOT EXISTS (SELECT 1 FROM (SELECT a.page, a.box FROM {1} WHERE {2}) d WHERE d.page = k.page AND d.box = k.box)"
_INTERSECTIONS = f"SELECT a.page, a.box AS a_box, b.box AS b_box, round({_COMMON}, 6) AS area FROM {_PAIR}"
_D = "(SELECT DISTINCT det_id, data_id, page, box_id::BIGINT AS box, category_id AS cat, score, poly, content FROM layout_dets)"
_XS, _YS = ("[poly[i] for i in [1, 3, 5, 7]]", "[poly[i] for i in [2, 4, 6, 8]]")
_S = f"(SELECT data_id, page, box, cat, list_min({_XS}) AS xmin, list_min({_YS}) AS ymin, list_max({_XS}) AS xmax, list_max({_YS}) AS ymax FROM {_D})"
_W, _H = "least(a.xmax - a.xmin, b.xmax - b.xmin)", "least(a.ymax - a.ymin, b.ymax - b.ymin)"
_GAP = "greatest(greatest(a.{0}min, b.{0}min) - least(a.{0}max, b.{0}max), 0)"
_UH = "(greatest(a.ymax, b.ymax) - least(a.ymin, b.ymin))"
_EDGE = f"""(({_OV.format('y')} > 0.6 * {_UH} AND greatest(a.xmin, b.xmin) - least(a.xmax, b.xmax) < 0.1 * {_H} AND NOT (a.cat = 14 AND b.cat = 14))
  OR {_COMMON} > 0.6 * (greatest(a.xmax, b.xmax) - least(a.xmin, b.xmin)) * {_UH})"""
SQL = {
    "g1_rects": f"SELECT det_id, list_min({_XS}) AS xmin, list_min({_YS}) AS ymin, list_max({_XS}) AS xmax, list_max({_YS}) AS ymax FROM {_D}",
    "g2_intersections": _INTERSECTIONS,
    "g2_intersections_banded": _INTERSECTIONS,
    "g3_free_intervals": f"""WITH r AS (SELECT page, xmin, xmax, max(xmax) OVER (PARTITION BY page ORDER BY xmin, xmax ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM {_BOXES}),
      f AS (SELECT page, greatest(coalesce(seen, 0.0), 0.0) AS free_from, least(xmin, 100.0) AS free_to FROM r UNION ALL SELECT page, greatest(max(xmax), 0.0), 100.0 FROM {_BOXES} GROUP BY page)
      SELECT * FROM f WHERE free_from < free_to""",
    "g4_suppress": _DROP.format(_BOXES, _PAIR, f"({_A_IN} AND NOT {_B_IN}) OR ({_A_IN} AND {_B_IN} AND {_WORSE})"),
    "g5_suppress_layout": _DROP.format(_BOXES, _PAIR, f"({_A_IN} AND NOT {_B_IN} AND (a.cat = 3) = (b.cat = 3)) OR ({_A_IN} AND {_B_IN} AND {_WORSE})"),
    "g6_merge": f"""WITH RECURSIVE n AS (SELECT * FROM {_BOXES}), e AS (SELECT a.page, a.box AS p, b.box AS q FROM n a JOIN n b ON a.page = b.page AND a.box <> b.box AND {_EDGE}),
      r(page, box, label) AS (SELECT page, box, box FROM n UNION SELECT r.page, e.q, r.label FROM r JOIN e ON r.page = e.page AND r.box = e.p),
      c AS (SELECT page, box, min(label) AS label FROM r GROUP BY 1, 2)
      SELECT n.page, label AS box, max(cat) AS cat, min(score) AS score, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax, count(*) AS n FROM n JOIN c ON n.page = c.page AND n.box = c.box GROUP BY 1, 2""",
    "g7_union": f"SELECT page, count(*) AS n, round(sum(CASE WHEN cat = 14 THEN 1.0 ELSE score END), 6) AS score FROM {_BOXES} GROUP BY 1",
    "g10_attach": f"""WITH c AS (SELECT page, box, xmin + 0.1 * (xmax - xmin) AS xmin, xmax - 0.1 * (xmax - xmin) AS xmax, ymin + 0.1 * (ymax - ymin) AS ymin, ymax - 0.1 * (ymax - ymin) AS ymax FROM {_BOXES} WHERE cat < 7)
      SELECT a.page, a.box AS a_box, b.box AS b_box FROM c a JOIN {_BOXES} b ON a.page = b.page AND b.cat >= 7 WHERE {_AREA.format('a')} > 0 AND {_COMMON} > 0.7 * {_AREA.format('a')}""",
    "g12a_lines": f"""WITH o AS (SELECT *, lag(ymin) OVER w AS t, lag(ymax) OVER w AS l FROM {_BOXES} WINDOW w AS (PARTITION BY page ORDER BY ymin, xmin, box)),
      m AS (SELECT *, CASE WHEN t IS NULL OR greatest(least(ymax, l) - greatest(ymin, t), 0) <= 0.5 * least(ymax - ymin, l - t) THEN 1 ELSE 0 END AS new FROM o)
      SELECT page, box, sum(new) OVER (PARTITION BY page ORDER BY ymin, xmin, box ROWS UNBOUNDED PRECEDING)::BIGINT AS line_no FROM m""",
    "g12b_edges": f"""WITH o AS (SELECT *, 0.5 * avg(ymax - ymin) OVER (PARTITION BY page) AS eps, lag(xmin) OVER (PARTITION BY page ORDER BY xmin, box) AS p FROM {_BOXES}),
      c AS (SELECT *, sum(CASE WHEN xmin - p <= eps THEN 0 ELSE 1 END) OVER (PARTITION BY page ORDER BY xmin, box ROWS UNBOUNDED PRECEDING) AS k FROM o)
      SELECT page, box, (CASE WHEN count(*) OVER (PARTITION BY page, k) < 2 THEN -1 ELSE k END)::BIGINT AS cluster FROM c""",
    "g13_captions": f"""WITH p AS (SELECT a.data_id, a.page, a.box AS a_box, b.box AS b_box, CASE WHEN {_OV.format('x')} > 0.7 * {_W} AND {_OV.format('y')} > 0.7 * {_H} THEN 0.0
        WHEN {_OV.format('x')} > 0.7 * {_W} THEN {_GAP.format('y')} WHEN {_OV.format('y')} > 0.7 * {_H} THEN {_GAP.format('x')} END AS gap
        FROM {_S} a JOIN {_S} b ON a.data_id = b.data_id AND a.page = b.page AND a.cat IN (4, 6) AND b.cat IN (3, 5) AND abs(a.box - b.box) <= 2)
      SELECT data_id, page, a_box, arg_min(b_box, (gap, b_box)) AS b_box, round(min(gap), 6) AS gap FROM p WHERE gap IS NOT NULL GROUP BY 1, 2, 3""",
    "g15_render": f"""SELECT data_id, page, len(t)::INT AS n_chars, md5(t) AS digest FROM (SELECT data_id, page, string_agg(CASE WHEN cat = 0 THEN chr(10) || chr(10) || '#  ' || content || chr(10) || chr(10)
        ELSE chr(10) || chr(10) || content || chr(10) || chr(10) END, '' ORDER BY box, content) AS t FROM {_D} WHERE content IS NOT NULL AND cat IN (0, 1, 4, 6, 7, 8, 9, 14) GROUP BY 1, 2)""",
    "g18_numbering": f"SELECT data_id, page, box, row_number() OVER (PARTITION BY data_id ORDER BY page, box) AS figure_no FROM {_S} WHERE cat = 3",
    "g19_page_ids": f"SELECT data_id, lpad('1', len(max(page)::VARCHAR)::INT, '0') AS first_page_id FROM {_D} GROUP BY 1",
    "g21_page_buckets": f"""WITH p AS (SELECT data_id, unnest(range(1, max(page) + 1))::INT AS page FROM {_S} GROUP BY 1), f AS (SELECT data_id, page, count(*) AS n FROM {_S} WHERE cat = 3 GROUP BY 1, 2)
      SELECT data_id, page, coalesce(n, 0) AS n_figures FROM p LEFT JOIN f USING (data_id, page)""",
}
