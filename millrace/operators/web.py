"""Web pages: URL rules, links, text of HTML, reachability over links."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.runtime import materialize
from millrace.functions.text import collapse_blank, strip

# Extensions of pages that are not fetched.
MEDIA = ("jpg", "jpeg", "png", "gif", "pdf", "mp4", "mp3", "avi", "mov", "xml")
LINK = r"https?://[^\s)\]\"'<>]+"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def links(text: Column) -> Column:
    """The links of a text, clean of quotes and backslashes."""
    return F.transform(F.regexp_extract_all(text, F.lit(LINK), F.lit(0)), lambda x: F.regexp_replace(x, r"[\\\"'.,;]+$", ""))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1)


def is_page(url: Column) -> Column:
    """Not a media file by its (case-sensitive) extension."""
    return ~F.regexp_extract(url_path(url), r"[^/]\.([^./]+)$", 1).isin(*MEDIA)


def normal_url(url: Column) -> Column:
    """Scheme and the distinct non-empty steps, first ones kept; what follows a second // is lost."""
    parts = F.split(url, "//")
    steps = F.array_distinct(F.filter(F.split(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), "/"), lambda x: x != ""))
    return F.concat(F.get(parts, F.lit(0)), F.lit("//"), F.array_join(steps, "/"))


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#]*)", 1)


def join_url(base: Column, link: Column) -> Column:
    """C4: a link as seen from a page: absolute, host-relative or relative to the page's folder."""
    root = F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]*)", 1)
    folder = F.regexp_extract(F.concat(root, F.when(url_path(base) == "", "/").otherwise(url_path(base))), r"^(.*/)", 1)
    return F.when(link.rlike("^[a-zA-Z]+://"), link).when(link.startswith("/"), F.concat(root, link)).otherwise(F.concat(folder, link))


def file_name(url: Column) -> Column:
    """C7."""
    return F.replace(F.replace(F.replace(F.regexp_replace(url, "^https?://", ""), F.lit("/"), F.lit("_")), F.lit("?"), F.lit("_")), F.lit("&"), F.lit("_"))


def html_text(c: Column) -> Column:
    """H1: text of HTML by pattern: scripts, styles, comments and tags away, common entities read."""
    c = F.regexp_replace(c, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    c = F.regexp_replace(c, r"</?[a-zA-Z][^<>]*>", " ")
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return collapse_blank(c)


def reachable(edges: DataFrame, start: DataFrame, source: str, target: str) -> DataFrame:
    """(node, depth) of all nodes that can be reached, breadth first; each round joins only the newest nodes; it ends when none is new."""
    seen = materialize(start.select(F.col(start.columns[0]).alias("node")).distinct().withColumn("depth", F.lit(0).cast("long")))
    front = seen
    for depth in count(1):
        nodes = front.select(F.col("node").alias(source))
        new = edges.join(nodes, source).select(F.col(target).alias("node")).distinct().join(seen, "node", "left_anti")
        front = materialize(new.withColumn("depth", F.lit(depth).cast("long")))
        if front.isEmpty():
            break
        seen = materialize(seen.union(front))
    return seen


def cell_align(classes: Column) -> Column:
    """Alignment of a table cell from its classes."""
    return F.when(classes.contains("ltx_align_center"), "c").when(classes.contains("ltx_align_right"), "r").otherwise("l")


def outer_blanks(items: Column) -> Column:
    """Whether any of a list of strings holds more than white space."""
    return F.exists(items, lambda x: strip(x) != "")
