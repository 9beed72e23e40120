"""Parts of a generated document: lines of the main body, abstract, table blocks, status of pages, repetition by scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import text as T

# Lines of a document that are no main body, after its title and what comes before its abstract.
ABSTRACT = r"^#+\s*Abstract"
NO_BODY = (
    r"^Table\s*\d+\s*:", r"^Figure\s+[A.\d]+\s*[:.]\s*", r"^#+ References", r"^\**\s*\[\d+\]\s*\.+", r"(?i)^\**Keywords\**\s*:\s*", r"^\**\s*\[\d+\]\s*\w+",
    r"\**\[*\s*(\w[\w\s])*\s*(et al.)*\s*\((\d{4}\w*)\)\]*", r"^Footnote\s*",
)
# Of the score's variance.
SCORE_WINDOW, LEAST_SUFFIX, LOW_VARIANCE, LEAST_LENGTH, MOST_LENGTH = 15, 10, 0.045, 120, 4095


def kept_lines(lines: DataFrame, doc: str) -> DataFrame:
    """M7: the lines (doc, idx, line, title) of the body: from the last abstract on, without title, captions, references, keywords, footnotes, publisher lines and tables.

    ``title`` is null or empty where the document has none.
    """
    c = F.col("line")
    titled = F.coalesce((F.col("title") != "") & c.contains(F.col("title")), F.lit(False))
    abstract = c.rlike(ABSTRACT) & ~titled
    # the first rule that fits a line decides; a table's ends come after captions
    caption = c.rlike(NO_BODY[0])
    event = F.when(titled | abstract | caption, None).when(c.rlike(r"^\\begin\{table\}"), 1).when(c.rlike(r"^\\end\{table\}"), 0)
    order = W.partitionBy(doc).orderBy("idx")
    rows = lines.withColumn("abstract", abstract).withColumn("event", event)
    rows = rows.withColumn("inside", F.coalesce(F.last("event", ignorenulls=True).over(order), F.lit(0))).withColumn("start", F.max(F.when(F.col("abstract"), F.col("idx"))).over(W.partitionBy(doc)))
    other = F.lit(False)
    for pattern in NO_BODY:
        other = other | c.rlike(pattern)
    other = other | (c.contains("Publisher") & (T.digit_share(c) > 0.2))
    kept = F.col("abstract") | (~titled & F.col("event").isNull() & ~other & (F.col("inside") == 0))
    return rows.filter(kept & (F.coalesce("start", F.lit(0)) <= F.col("idx"))).select(doc, "idx", "line", "abstract")


def main_body(lines: DataFrame, doc: str) -> DataFrame:
    """M8: (doc, text): the kept lines that are not empty; the first one after the abstract's heading that is no heading comes between the abstract's tags."""
    order = W.partitionBy(doc).orderBy("idx")
    rows = kept_lines(lines, doc).filter("line != ''")
    rows = rows.withColumn("part", F.sum(F.col("abstract").cast("int")).over(order)).filter("not abstract")
    plain = ~F.col("line").rlike(r"^[*#]+")
    first = F.min(F.when(plain & (F.col("part") > 0), F.col("idx"))).over(W.partitionBy(doc, "part"))
    line = F.when(F.col("idx") == F.col("first"), F.concat(F.lit("[START_ABSTRACT]\n"), "line", F.lit("\n[END_ABSTRACT]"))).otherwise(F.col("line"))
    parts = F.array_sort(F.collect_list(F.struct("idx", line.alias("line"))))
    return rows.withColumn("first", first).groupBy(doc).agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("text"))


def table_blocks(c: Column) -> Column:
    r"""M5: the table environments of a text, one after the other, with the caption and number of the line after each."""
    block = r"(?ms)^\\begin\{table\}[^\n]*\n?(.*?)(?:^\\end\{table\}[^\n]*(?:\n([^\n]*))?|\z)"
    c = T.strip(c)
    both = F.arrays_zip(F.regexp_extract_all(c, F.lit(block), F.lit(1)).alias("body"), F.regexp_extract_all(c, F.lit(block), F.lit(2)).alias("after"))

    def shown(x: Column) -> Column:
        label, caption = (F.regexp_extract(x["after"], r"Table\s*(\d+)\s*:\s*(.+)", k) for k in (1, 2))
        body = F.when(T.strip(x["body"]) != "", F.when(x["body"].endswith("\n"), x["body"]).otherwise(F.concat(x["body"], F.lit("\n")))).otherwise("")
        return F.concat(F.lit("\\begin{table*}[h]\n\\caption{\n"), F.when(label != "", F.concat(caption, F.lit("\n"))).otherwise(""), F.lit("}\n\\label{tbl:"), label, F.lit("}\n"), body, F.lit("\\end{table*}\n"))

    return F.array_join(F.transform(both, shown), "")


def page_status(output: Column, repeats: Column, page: Column) -> Column:
    """A page's text, or a mark: EMPTY where all of it was taken as repetition or it was given up at once (0), FAIL where it was cut at a repetition."""
    mark = lambda kind: F.concat(F.lit(f"\n\n[MISSING_PAGE_{kind}:"), page.cast("string"), F.lit("]\n\n"))
    return F.when(T.strip(output) == "[MISSING_PAGE_POST]", mark("EMPTY")).when(repeats > 0, mark("FAIL")).when(repeats == 0, mark("EMPTY")).otherwise(output)


def bracket_pieces(word: Column) -> Column:
    """A word cut before each [ and after each ]; one without [ stays whole."""
    pieces = F.filter(F.regexp_extract_all(word, F.lit(r"\[[^\[\]]*\]?|[^\[\]]+\]?|\]"), F.lit(0)), lambda x: x != "")
    return F.when(word.contains("["), pieces).otherwise(F.array(word))


def dehyphenated(text: str) -> str:
    """A line that ends with a hyphen takes the first word of the next one, line by line."""
    lines = [x.rstrip() for x in text.split("\n")]
    for k in [k for k, x in enumerate(lines[:-1]) if x.endswith("-")]:
        word = lines[k + 1].split(" ")[0]
        lines[k], lines[k + 1] = lines[k][:-1] + word, lines[k + 1][len(word) :]
    return "\n".join(lines)


def repeat_cut(scores: list[float] | None) -> int | None:
    """Where a sequence of token scores begins to repeat itself, None if it does not.

    The variances of all windows of the scores (over their length) are taken, then the variance of these from each
    place to the end; a repetition is one stretch of places at which that is low. It is cut some way after its start.
    """
    values = np.asarray(scores if scores is not None else [], float)
    if len(values) <= SCORE_WINDOW:
        return None
    first = np.lib.stride_tricks.sliding_window_view(values, SCORE_WINDOW)[:-1].var(axis=1) / SCORE_WINDOW
    if len(first) < LEAST_SUFFIX:
        return None
    back = first[::-1]
    n = np.arange(1, len(back) + 1)
    suffix = np.cumsum(back**2) / n - (np.cumsum(back) / n) ** 2
    second = suffix[LEAST_SUFFIX - 1 : -1][::-1]
    low = np.flatnonzero(second < LOW_VARIANCE)
    if len(low) <= 1 or np.any(np.diff(low) > 1):
        return None
    cut = int(min(max(low[0], 1) * 1.08 + LEAST_LENGTH, MOST_LENGTH))
    if cut / len(values) > 0.9:
        return None
    return 0 if low[0] < 30 else cut


def each_text(df: DataFrame, key: str, column: str, step, out: str = "text string") -> DataFrame:
    """(id, result) of a function of one value, in Arrow batches; null stays null."""
    kind = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "array<string>": pa.list_(pa.string())}[out.split(" ", 1)[1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [None if v is None else step(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, kind)], names=["id", out.split(" ", 1)[0]])

    return df.select(F.col(key).cast("string").alias("id"), F.col(column)).mapInArrow(run, f"id string, {out}")


def sentences_of(text: Column) -> Column:
    """The sentences of a text: cut after a full stop, question or exclamation mark before a capital or digit."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+(?=[\p{Lu}\d])"), T.strip), lambda x: x != "")


def first_places(df: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """Of each positive value of a group its first place; values of 0 and less are dropped."""
    return df.filter(F.col(value) > 0).groupBy(group, value).agg(F.min(F.struct(*order)).alias("at")).select(group, value, *[F.col(f"at.{c}").alias(c) for c in order])


def inverted(df: DataFrame, key: str, value: str) -> DataFrame:
    """(value, key) rows, each once: in which keys a value occurs."""
    return df.select(value, key).distinct()


def maximal_sets(df: DataFrame, key: str, member: str) -> DataFrame:
    """The distinct sets that no other distinct set holds; (sets, n_keys) with sorted members.

    Sets are compared by members they share only: a set is held by another if as many members are shared as it has.
    """
    sets = df.groupBy(key).agg(F.array_sort(F.collect_set(member)).alias("members"))
    distinct = sets.groupBy("members").agg(F.count("*").alias("n_keys")).withColumn("set_id", F.xxhash64("members"))
    rows = distinct.select("set_id", F.size("members").alias("size"), F.explode("members").alias("member"))
    shared = rows.join(rows.select(F.col("set_id").alias("other"), F.col("size").alias("size_other"), "member"), "member").filter("size_other > size")
    held = shared.groupBy("set_id", "size", "other").agg(F.count("*").alias("n")).filter("n = size").select("set_id").distinct()
    return distinct.join(held, "set_id", "left_anti").select("members", "n_keys")
