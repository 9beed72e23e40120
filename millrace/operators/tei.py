"""TEI documents and bibliographic records: reading, reference strings, coordinates, alignment and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import strip

# Fixed value: the name space of TEI.
NAMESPACE = "http://www.tei-c.org/ns/1.0"


def xml_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def tei_header(title: Column, authors: Column, keywords: Column, date: Column) -> Column:
    """A TEI header of these fields; null ones leave their element out."""
    people = F.array_join(F.transform(F.coalesce(authors, F.array().cast("array<string>")), lambda a: F.concat(F.lit("<author><persName>"), xml_escape(a), F.lit("</persName></author>"))), "")
    element = lambda name, c: F.coalesce(F.concat(F.lit(f"<{name}>"), xml_escape(c), F.lit(f"</{name}>")), F.lit(""))
    return F.concat(F.lit(f'<TEI xmlns="{NAMESPACE}"><teiHeader>'), element("title", title), people, element("keywords", keywords), element("date", date), F.lit("</teiHeader></TEI>"))


def read_header(xml: str) -> dict[str, Column]:
    """The fields of a TEI header, as native XPath expressions over a column; absent elements give null."""
    first = lambda name: F.nullif(F.xpath_string(F.col(xml), F.lit(f"//{name}")), F.lit(""))
    return {"title": first("title"), "authors": F.xpath(F.col(xml), F.lit("//persName/text()")), "keywords": first("keywords"), "pub_date": first("date")}


def full_name(*parts: Column) -> Column:
    """Name parts with single spaces, null ones skipped."""
    return F.concat_ws(" ", *parts)


def page_range(c: Column) -> list[Column]:
    """First and last page."""
    return [F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")).alias("page_from"), F.nullif(F.regexp_extract(c, r"\d+\s*[-–]+\s*(\d+)", 1), F.lit("")).alias("page_to")]


def year_of(c: Column) -> Column:
    return F.try_to_number(F.nullif(F.regexp_extract(c, r"(\d{4})", 1), F.lit("")), F.lit("9999")).cast("int")


def reference_entry(i: Column, key: Column, authors: Column, title: Column, journal: Column, kind: Column) -> Column:
    """I.[i](<key>authors.title.[kind],journal)."""
    n = i.cast("string")
    return F.concat(n, F.lit(".["), n, F.lit("](<"), key, F.lit(">"), F.concat_ws(".", F.array_join(authors, ","), title), F.lit(".["), kind, F.lit("]"), F.coalesce(F.concat(F.lit(","), journal), F.lit("")), F.lit(")"))


def coords(c: Column) -> Column:
    """The boxes of a string page,x,y,w,h;..., as arrays of numbers."""
    return F.transform(F.filter(F.split(c, ";"), lambda x: x != ""), lambda x: F.transform(F.split(x, ","), lambda v: v.cast("double")))


def relative_coords(c: Column, width: float, height: float) -> Column:
    """Page, left, top, right, bottom by page size, rounded to five places; boxes with under five numbers or no height are skipped."""
    kept = F.filter(coords(c), lambda b: (F.size(b) >= 5) & (b[4] >= 1))
    r = lambda v, size: F.round(v / size, 5).cast("string")
    return F.array_join(F.transform(kept, lambda b: F.concat_ws(",", b[0].cast("int").cast("string"), r(b[1], width), r(b[2], height), r(b[1] + b[3], width), r(b[2] + b[4], height))), ";")


def token_scores(a: Column, b: Column) -> list[Column]:
    """Precision, recall and F of the sets of white-space tokens of a prediction and a truth; 0 where undefined."""
    x, y = (F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != "")) for c in (a, b))
    hit = F.size(F.array_intersect(x, y))
    p = F.when(F.size(x) == 0, 0.0).otherwise(hit / F.size(x))
    r = F.when(F.size(y) == 0, 0.0).otherwise(hit / F.size(y))
    f = F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r))
    return [F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f, 6).alias("f1")]


def bucket_of(offsets: DataFrame, lengths: DataFrame, doc: str) -> DataFrame:
    """The piece of a document in which an offset falls: a range join with running lengths."""
    from pyspark.sql import Window as W

    order = W.partitionBy(doc).orderBy("idx")
    spans = lengths.withColumn("end", F.sum("length").over(order)).withColumn("begin", F.col("end") - F.col("length"))
    return offsets.join(spans, doc).filter((F.col("offset") >= F.col("begin")) & (F.col("offset") < F.col("end"))).select(doc, "offset", "idx")


def without_figure_tags(c: Column) -> Column:
    """Figure and table marks away, footnote marks as text."""
    c = F.regexp_replace(c, r"\[(?:END)?(?:FIGURE|TABLE)(?::[^\]]*)?\]|\[(?:START|END)_(?:FIGURE|TABLE)\]", "")
    return strip(F.regexp_replace(c, r"\[(?:START|END)_NOTE\]", ""))
