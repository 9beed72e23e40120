"""Boxes on pages: rectangle algebra, suppression, merging, assignment, reading order.

Boxes are rows with a page key and xmin, ymin, xmax, ymax. Pairs are formed within a page only, by an
equi-join on the page and on bands of height with the geometric condition on top, so that a page with very
many boxes is no large group; every overlapping pair still meets. Boxes with a null side meet nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.graph import components as connected

SIDES = ("xmin", "ymin", "xmax", "ymax")
COVER, MERGE_LINE, MERGE_AREA, MERGE_GAP, ATTACH, SHRINK = 0.8, 0.6, 0.6, 0.1, 0.7, 0.1
FIGURE, FORMULA = 3, 14
#: Height of the bands in which boxes of a page are paired, in the unit of the boxes.
BAND = 100.0


def rect_of_poly(poly: Column) -> list[Column]:
    """G1: the rectangle around a polygon given as x1, y1, x2, y2, ..."""
    xs, ys = F.filter(poly, lambda x, i: i % 2 == 0), F.filter(poly, lambda x, i: i % 2 == 1)
    return [F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax")]


def area(p: str = "") -> Column:
    return (F.col(f"{p}xmax") - F.col(f"{p}xmin")) * (F.col(f"{p}ymax") - F.col(f"{p}ymin"))


def bounding(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """The rectangle around two."""
    return {s: (F.least if s.endswith("min") else F.greatest)(a[s], b[s]) for s in SIDES}


def holds(x: Column, y: Column) -> Column:
    """Whether a point lies in the box, its edges included."""
    return x.between(F.col("xmin"), F.col("xmax")) & y.between(F.col("ymin"), F.col("ymax"))


def overlap(axis: str, a: str = "a_", b: str = "b_") -> Column:
    """Length of the common stretch of two boxes on an axis, 0 if they don't meet."""
    return F.greatest(F.least(F.col(f"{a}{axis}max"), F.col(f"{b}{axis}max")) - F.greatest(F.col(f"{a}{axis}min"), F.col(f"{b}{axis}min")), F.lit(0.0))


def common_area(a: str = "a_", b: str = "b_") -> Column:
    return overlap("x", a, b) * overlap("y", a, b)


def _side(df: DataFrame, prefix: str, page: list[str]) -> DataFrame:
    return df.select(*page, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in page])


def neighbours(a: DataFrame, b: DataFrame, page: list[str], axis: str = "y", banded: float = BAND) -> DataFrame:
    """All (a, b) of a page whose stretches on an axis touch, columns prefixed a_ and b_.

    Boxes are copied to every band they touch and each pair is taken in the first common one, so that a page
    with very many boxes is split and boxes far from each other never meet.
    """
    low, high = f"{axis}min", f"{axis}max"
    keys = [*page, "band"]
    spread = lambda df: df.withColumn("band", F.explode(F.sequence(F.floor(F.col(low) / banded), F.floor(F.greatest(low, high) / banded))))
    found = _side(spread(a), "a_", keys).join(_side(spread(b), "b_", keys), keys)
    first = F.greatest(F.floor(F.col(f"a_{low}") / banded), F.floor(F.col(f"b_{low}") / banded))
    touch = (F.col(f"a_{low}") <= F.col(f"b_{high}")) & (F.col(f"b_{low}") <= F.col(f"a_{high}"))
    return found.filter((F.col("band") == first) & touch).drop("band")


def pairs(df: DataFrame, page: list[str], banded: float | None = None) -> DataFrame:
    """Ordered pairs of different boxes of a page that meet (strictly), columns prefixed a_ and b_."""
    meets = (F.col("a_xmin") < F.col("b_xmax")) & (F.col("b_xmin") < F.col("a_xmax")) & (F.col("a_ymin") < F.col("b_ymax")) & (F.col("b_ymin") < F.col("a_ymax"))
    return neighbours(df, df, page, banded=banded or BAND).filter((F.col("a_box") != F.col("b_box")) & meets)


def suppressed(df: DataFrame, page: list[str], figures_apart: bool = False) -> DataFrame:
    """Boxes that another covers, and of mutual duplicates the one of lower score (ties: later box)."""
    p = pairs(df, page)
    a_in_b, b_in_a = common_area() > COVER * area("a_"), common_area() > COVER * area("b_")
    inside = a_in_b & ~b_in_a
    if figures_apart:
        inside = inside & ((F.col("a_cat") == FIGURE) == (F.col("b_cat") == FIGURE))
    worse = (F.col("a_score") < F.col("b_score")) | ((F.col("a_score") == F.col("b_score")) & (F.col("a_box") > F.col("b_box")))
    return p.filter(inside | (a_in_b & b_in_a & worse)).select(*page, F.col("a_box").alias("box")).distinct()


def merge_edges(df: DataFrame, page: list[str]) -> DataFrame:
    """Pairs on one line with a small gap (not two isolated formulas), and pairs that share most of their union box."""
    p = neighbours(df, df, page).filter(F.col("a_box") < F.col("b_box"))  # both rules ask for a common stretch of height
    height = lambda k: F.col(f"{k}ymax") - F.col(f"{k}ymin")
    union_height = F.greatest("a_ymax", "b_ymax") - F.least("a_ymin", "b_ymin")
    union_area = (F.greatest("a_xmax", "b_xmax") - F.least("a_xmin", "b_xmin")) * union_height
    gap = F.greatest("a_xmin", "b_xmin") - F.least("a_xmax", "b_xmax")
    line = (overlap("y") > MERGE_LINE * union_height) & (gap < MERGE_GAP * F.least(height("a_"), height("b_"))) & ~((F.col("a_cat") == FORMULA) & (F.col("b_cat") == FORMULA))
    return p.filter(line | (common_area() > MERGE_AREA * union_area)).select(*page, "a_box", "b_box")


def components(nodes: DataFrame, edges: DataFrame, page: list[str]) -> DataFrame:
    """Smallest box of each connected component; a box without an edge is its own."""
    ends = edges.select(F.explode(F.array(F.struct(*page, F.col("a_box").alias("box")), F.struct(*page, F.col("b_box").alias("box")))).alias("node"), F.struct(*page, "a_box", "b_box").alias("key"))
    joined = connected(ends).select(*[F.col(f"node.{c}").alias(c) for c in (*page, "box")], F.col("label.box").alias("label"))
    alone = nodes.select(*page, "box").distinct().join(joined, [*page, "box"], "left")
    return alone.select(*page, "box", F.coalesce("label", "box").alias("label"))


def merged(df: DataFrame, page: list[str]) -> DataFrame:
    """Components with their highest category, lowest score and bounding box."""
    labels = components(df, merge_edges(df, page), page)
    return df.join(labels, [*page, "box"]).groupBy(*page, F.col("label").alias("box")).agg(
        F.max("cat").alias("cat"), F.min("score").alias("score"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
        F.count("*").alias("n"),
    )


def free_intervals(df: DataFrame, page: list[str]) -> DataFrame:
    """The stretches of [lo, hi] of each page that no interval (xmin, xmax) covers, by running maxima."""
    order = W.partitionBy(*page).orderBy("xmin", "xmax")
    seen = F.max("xmax").over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = df.withColumn("from", F.greatest(F.coalesce(seen, F.col("lo")), F.col("lo"))).withColumn("to", F.least("xmin", "hi"))
    tail = df.groupBy(*page, "lo", "hi").agg(F.max("xmax").alias("last")).select(*page, F.greatest("last", "lo").alias("from"), F.col("hi").alias("to"))
    return rows.select(*page, "from", "to").union(tail).filter(F.col("from") < F.col("to"))


def cut_around(texts: DataFrame, cutters: DataFrame, page: list[str], ratio: float = 0.5) -> DataFrame:
    """The stretches of each text box that no box on its line covers; a box on its line shares more than ``ratio`` of the smaller height. Pieces keep the number of their box."""
    met = neighbours(texts, cutters, page)
    height = lambda k: F.col(f"{k}ymax") - F.col(f"{k}ymin")
    met = met.filter((overlap("y") > ratio * F.least(height("a_"), height("b_"))) & (overlap("x") > 0))
    spans = met.select(*page, F.col("a_box").alias("box"), F.col("a_xmin").alias("lo"), F.col("a_xmax").alias("hi"), F.col("b_xmin").alias("xmin"), F.col("b_xmax").alias("xmax"))
    cut = free_intervals(spans, [*page, "box"]).select(*page, "box", F.col("from").alias("xmin"), F.col("to").alias("xmax"))
    whole = texts.join(spans.select(*page, "box").distinct(), [*page, "box"], "left_anti").select(*page, "box", "xmin", "xmax")
    return cut.union(whole)


def attached(inner: DataFrame, outer: DataFrame, page: list[str]) -> DataFrame:
    """Boxes assigned to the regions that hold most of their middle (both shrunk by a tenth at each side)."""
    w, h = F.col("a_xmax") - F.col("a_xmin"), F.col("a_ymax") - F.col("a_ymin")
    p = neighbours(inner, outer, page)
    core = p.withColumns({"c_xmin": F.col("a_xmin") + SHRINK * w, "c_xmax": F.col("a_xmax") - SHRINK * w, "c_ymin": F.col("a_ymin") + SHRINK * h, "c_ymax": F.col("a_ymax") - SHRINK * h})
    return core.filter((area("c_") > 0) & (common_area("c_", "b_") > ATTACH * area("c_"))).select(*page, "a_box", "b_box")


def captions(df: DataFrame, page: list[str], holders: list[int], caption: list[int], ranks: int = 2) -> DataFrame:
    """Each caption's nearest figure or table by the gap on an axis, among neighbours in reading order; ties to the first."""
    # a caption looks up the few boxes around it by their numbers
    asks = _side(df.filter(F.col("cat").isin(*caption)), "a_", page).withColumn("b_box", F.explode(F.sequence(F.col("a_box") - ranks, F.col("a_box") + ranks)))
    p = asks.join(_side(df.filter(F.col("cat").isin(*holders)), "b_", page), [*page, "b_box"])
    width = F.least(F.col("a_xmax") - F.col("a_xmin"), F.col("b_xmax") - F.col("b_xmin"))
    height = F.least(F.col("a_ymax") - F.col("a_ymin"), F.col("b_ymax") - F.col("b_ymin"))
    over, beside = overlap("x") > ATTACH * width, overlap("y") > ATTACH * height
    gap_y = F.greatest(F.greatest("a_ymin", "b_ymin") - F.least("a_ymax", "b_ymax"), F.lit(0.0))
    gap_x = F.greatest(F.greatest("a_xmin", "b_xmin") - F.least("a_xmax", "b_xmax"), F.lit(0.0))
    gap = F.when(over & beside, 0.0).when(over, gap_y).when(beside, gap_x)
    near = p.withColumn("gap", gap).filter(F.col("gap").isNotNull())
    return near.groupBy(*page, "a_box").agg(F.min_by("b_box", F.struct("gap", "b_box")).alias("b_box"), F.min("gap").alias("gap"))


def line_numbers(df: DataFrame, page: list[str], ratio: float = 0.5) -> DataFrame:
    """Boxes in order of their tops; a new line where the overlap with the box before is at most half the smaller height."""
    order = W.partitionBy(*page).orderBy("ymin", "xmin", "box")
    top, low = F.lag("ymin").over(order), F.lag("ymax").over(order)
    meet = F.greatest(F.least("ymax", low) - F.greatest("ymin", top), F.lit(0.0))
    new = F.when(top.isNull() | (meet <= ratio * F.least(F.col("ymax") - F.col("ymin"), low - top)), 1).otherwise(0)
    return df.withColumn("new", new).withColumn("line_no", F.sum("new").over(order)).drop("new")


def left_edge_clusters(df: DataFrame, page: list[str]) -> DataFrame:
    """Clusters of left edges within half the mean height of each other; edges alone are noise (-1)."""
    order = W.partitionBy(*page).orderBy("xmin", "box")
    eps = 0.5 * F.avg(F.col("ymax") - F.col("ymin")).over(W.partitionBy(*page))
    rows = df.withColumn("eps", eps).withColumn("new", F.when(F.col("xmin") - F.lag("xmin").over(order) <= F.col("eps"), 0).otherwise(1))
    rows = rows.withColumn("cluster", F.sum("new").over(order))
    size = F.count("*").over(W.partitionBy(*page, "cluster"))
    return rows.withColumn("cluster", F.when(size < 2, -1).otherwise(F.col("cluster"))).drop("eps", "new")


def render(df: DataFrame, page: list[str], text: str) -> DataFrame:
    """Each page's regions in order as text: titles as headings, discarded kinds left out."""
    piece = F.when(F.col("cat") == 0, F.concat(F.lit("\n\n#  "), F.col(text), F.lit("\n\n"))).when(F.col("cat").isin(1, 4, 6, 7, 8, 9, 14), F.concat(F.lit("\n\n"), F.col(text), F.lit("\n\n")))
    rows = df.withColumn("piece", piece).filter("piece is not null")
    parts = F.array_sort(F.collect_list(F.struct("box", "piece")))
    return rows.groupBy(*page).agg(F.array_join(F.transform(parts, lambda x: x["piece"]), "").alias("content"))
