"""Lines of documents: quality rules, seeds and gap filling, repeated words.

A document's lines are rows (doc, idx, line). State that runs over lines is a window over the document;
a document's lines are as many as its text holds, which is the largest group that is ever sorted.
Null texts have no lines; the empty text has one empty line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import strip

# Patterns of addresses and references, and thresholds.
URL, EMAIL, DOI = r"https?://\S+|www\.\S+", r"[\p{L}\p{N}_]+@[\p{L}\p{N}_]+\.[\p{L}\p{N}_]+", r"10\.[0-9]{4,}/[-._;()/:a-zA-Z0-9]+"
REFERENCE = r"^\**\s*\[[0-9]+\]\s*[\p{L}\p{N}_]+"
CAPTION = r"(?i)Figure\s+([A.0-9]+)\s*[:.]\s*"
RATIO, URL_RATIO, SHORT, CAPITAL_SHORT, GAP = 0.6, 0.3, 5, 10, 3


def to_lines(df: DataFrame, doc: str, text: str, *keep: str) -> DataFrame:
    return df.filter(F.col(text).isNotNull()).select(doc, *keep, F.posexplode(F.split(text, "\n")).alias("idx", "line"))


def from_lines(lines: DataFrame, doc: str) -> DataFrame:
    """The text of each document's lines in order."""
    parts = F.array_sort(F.collect_list(F.struct("idx", "line")))
    return lines.groupBy(doc).agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("text"))


def _without(c: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(c, pattern, ""))


def uppercase_rule(c: Column) -> Column:
    """L1: 0 if more than RATIO of the letters are capitals, -1 without letters, else 1."""
    letters, capitals = _without(c, r"[^\p{L}]"), _without(c, r"[^\p{Lu}]")
    return F.when(letters == 0, -1).when(capitals > RATIO * letters, 0).otherwise(1)


def capitalised_rule(c: Column) -> Column:
    """L2: 0 if more than RATIO of the words start with a capital, digit or underscore, or there is no word; -1 for a blank line."""
    words = F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    high = F.size(F.filter(words, lambda w: w.rlike(r"^[\p{Lu}\p{N}_]")))
    return F.when(strip(c) == "", -1).when(F.size(words) == 0, 0).when(high > RATIO * F.size(words), 0).otherwise(1)


def symbol_rule(c: Column) -> Column:
    """L3: 0 if more than RATIO of the characters other than blanks are no letters; -1 for a blank line."""
    solid, letters = _without(c, r"[ \t]"), _without(c, r"[^\p{L}]")
    return F.when(solid == 0, -1).when(solid - letters > RATIO * solid, 0).otherwise(1)


def address_rule(c: Column, exempt: bool = True) -> Column:
    """L4: 0 if addresses (URL, e-mail, DOI; overlaps count twice) make up more than URL_RATIO and the line is no (exempt) reference, else 1."""
    hit = sum(F.length(F.array_join(F.regexp_extract_all(c, F.lit(p), F.lit(0)), "")) for p in (URL, EMAIL, DOI))
    solid = _without(c, r"\s")
    return F.when((solid > 0) & (hit > URL_RATIO * solid) & (~c.rlike(REFERENCE) if exempt else F.lit(True)), 0).otherwise(1)


def is_short(c: Column, words: int) -> Column:
    """Fewer than ``words`` words after leading numbers and marks; the empty line has one."""
    rest = F.regexp_replace(strip(c), r"^[0-9\-,.:; ]+", "")
    return F.size(F.split(rest, " ")) < words


def is_title(c: Column) -> Column:
    """L6."""
    return c.startswith("#") | c.rlike(r"^\*.*\*$") | c.rlike(r"^_.*_$")


def seed_lines(lines: DataFrame, doc: str) -> DataFrame:
    """``kind`` of each line: token (kept, splits gaps), title, delete or text."""
    c = F.col("line")
    opens = c.contains("[START_FIGURE]") | c.contains("[START_TABLE]") | c.startswith("\\begin{table}") | c.rlike(CAPTION)
    before = (strip(c) == "") | c.contains("[MISSING_PAGE") | (address_rule(c) == 0) | is_title(c) | c.rlike(r"\[(START|END)_(REF|FORMULA)\]")
    event = F.when(opens & ~before, 1).when(c.contains("[END_FIGURE]") | c.contains("[END_TABLE]"), 0)
    state = F.last("event", ignorenulls=True).over(W.partitionBy(doc).orderBy("idx").rowsBetween(W.unboundedPreceding, -1))
    kind = (
        F.when(F.coalesce("inside", F.lit(0)) == 1, "token")
        .when(strip(c) == "", "blank")
        .when(c.contains("[MISSING_PAGE"), "token")
        .when(address_rule(c) == 0, "delete")
        .when(is_title(c), "title")
        .when(c.rlike(r"\[(START|END)_(REF|FORMULA)\]") | opens, "token")
        .when((capitalised_rule(c) == 0) & is_short(c, CAPITAL_SHORT), "delete")
        .when(is_short(c, SHORT) & ((uppercase_rule(c) == 0) | (symbol_rule(c) == 0)), "delete")
        .otherwise("text")
    )
    return lines.withColumn("event", event).withColumn("inside", state).withColumn("kind", kind).drop("event", "inside")


def fill_gaps(seeded: DataFrame, doc: str) -> DataFrame:
    """``removed``: seeds, and short lines within gaps of GAP lines next to or between seeds."""
    order = W.partitionBy(doc).orderBy("idx")
    seed = F.when(F.col("kind") == "delete", F.col("idx"))
    rows = seeded.withColumn("prev", F.max(seed).over(order.rowsBetween(W.unboundedPreceding, -1)))
    rows = rows.withColumn("next", F.min(seed).over(order.rowsBetween(1, W.unboundedFollowing))).withColumn("n", F.count("*").over(W.partitionBy(doc)))
    able = F.col("kind").isin("blank", "text") & is_short(F.col("line"), SHORT)
    near = (
        F.when(F.col("prev").isNull(), F.col("next") <= GAP).when(F.col("next").isNull(), F.col("n") - F.col("prev") - 1 <= GAP).otherwise(F.col("next") - F.col("prev") <= GAP)
    )
    return rows.withColumn("removed", (F.col("kind") == "delete") | (able & F.coalesce(near, F.lit(False)))).drop("prev", "next", "n")


def longest_runs(lines: DataFrame, doc: str) -> DataFrame:
    """Per line the longest run of one word following itself, by gaps and islands."""
    words = lines.select(doc, "idx", F.posexplode(F.filter(F.split("line", r"\s+"), lambda w: w != "")).alias("pos", "word"))
    at, same = W.partitionBy(doc, "idx").orderBy("pos"), W.partitionBy(doc, "idx", "word").orderBy("pos")
    islands = words.withColumn("island", F.row_number().over(at) - F.row_number().over(same))
    runs = islands.groupBy(doc, "idx", "word", "island").agg(F.count("*").alias("run"))
    return runs.groupBy(doc, "idx").agg(F.max("run").alias("longest_run"))
