"""Stages of a document pipeline: a registry of named steps over DataFrames, status carried along (survey ids K*, O*, T30).

A stage takes and gives rows with ``status`` and ``message``. A row that failed is passed on untouched. Codes
without a stage are skipped. Recognition and other models are plugged in as functions over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T

Stage = Callable[[Column], Column]
STAGES: dict[tuple[str, str], Stage] = {}
# Job types by code.
JOB_TYPES = {0: "normal", 1: "pdfParse", 2: "cc", 3: "crawler"}


def stage(kind: str, code: str) -> Callable[[Stage], Stage]:
    """Registers a text-to-text column function under a kind (parse, tag, clean) and a code."""

    def add(f: Stage) -> Stage:
        STAGES[kind, code] = f
        return f

    return add


@stage("parse", "0")
def parse_blank(c: Column) -> Column:
    return T.collapse_blank(c)


@stage("clean", "0")
def clean_ligatures(c: Column) -> Column:
    return T.replace_all(c, T.LIGATURES)


@stage("clean", "1")
def clean_numbers(c: Column) -> Column:
    return T.without_numbers(c)


def job_type(code: Column) -> Column:
    """Q18/K1: name of a job type, null for unknown codes."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in JOB_TYPES.items() for x in pair]), code)


def run_stages(df: DataFrame, column: str, plan: list[tuple[str, str]]) -> DataFrame:
    """K2: the stages of ``plan`` (kind, comma-separated codes) one after the other; null or blank text fails the row."""
    df = df.withColumn("status", F.coalesce(T.strip(F.col(column)) != "", F.lit(False)))
    df = df.withColumn("message", F.when(F.col("status"), "").otherwise("no text"))
    for kind, codes in plan:
        for code in codes.split(","):
            step = STAGES.get((kind, code.strip()))
            if step is None:
                continue
            new = step(F.col(column))
            df = df.withColumn(column, F.when(F.col("status"), new).otherwise(F.col(column)))
            failed = F.col("status") & F.coalesce(T.strip(F.col(column)) == "", F.lit(True))
            df = df.withColumn("message", F.when(failed, f"empty after {kind} {code}").otherwise(F.col("message"))).withColumn("status", F.col("status") & ~failed)
    return df


RECOGNISED = "cat int, score double, poly array<double>, text string"


def recognise(images: DataFrame, key: str, content: str, model: Callable[[bytes], Iterator[tuple]]) -> DataFrame:
    """O*: rows of ``RECOGNISED`` per image, from a model called in Arrow batches; empty images give no rows."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "cat", "score", "poly", "text"]
        types = [pa.string(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.string()]
        for batch in batches:
            rows = [(k, *r) for k, image in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if image for r in model(image)]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return images.select(F.col(key).cast("string"), F.col(content)).mapInArrow(run, f"{key} string, {RECOGNISED}")


def wrap_formula(c: Column, category: Column) -> Column:
    """Dollar signs of recognised formulas escaped, inline ones (13) between $, others between $$."""
    body = F.replace(c, F.lit("$"), F.lit("\\$"))
    mark = F.when(category == 13, "$").otherwise("$$")
    return F.concat(mark, body, mark)


def tei_text(text: str) -> str:
    """parse 0: a TEI document as one text with its sections, its body finished."""
    from millrace.operators.body_steps import finished
    from millrace.operators.tei_body import read_document, render

    doc = read_document(text)
    if doc is None:
        raise ValueError("no readable TEI")
    return finished(render(doc)) or ""


def page_text(text: str) -> str:
    """parse 1: recognised pages: made-up references and repeating tails away, items on lines of their own."""
    from millrace.operators.pages import items_apart, without_made_up_references
    from millrace.operators.repeats import cut_repeating_tail

    return items_apart(without_made_up_references(cut_repeating_tail(text) or ""))


def region_text(text: str) -> str:
    """parse 2: the text of page regions: where blanks between words are doubled, lone ones go; hyphens at line ends are closed."""
    import re

    from millrace.operators.structure import dehyphenated

    if "  " in text:
        text = re.sub(r"(?<! ) (?! )", "", text).replace("  ", " ")
    return dehyphenated(text)


def without_phrases(text: str) -> str:
    """clean 0: phrases repeated over and over collapsed to one."""
    from millrace.operators.repeats import collapse_phrases

    return collapse_phrases(text)[0] or ""


#: Stages of whole documents by kind and code; a tag stage changes no text.
DOCUMENT_STAGES: dict[tuple[str, str], Callable[[str], str]] = {("parse", "0"): tei_text, ("parse", "1"): page_text, ("parse", "2"): region_text, ("clean", "0"): without_phrases}


def run_documents(df: DataFrame, key: str, column: str, plan: list[tuple[str, str]]) -> DataFrame:
    """K2 to K5: (id, text, status, message, n_figures, n_tables): the stages of ``plan`` one after the other, in one narrow pass.

    A document that fails at a stage (an error, or nothing left) keeps the text it had, takes no further stage and
    says where it failed. ``tag`` 0 counts figures and tables in the project's tags. Codes without a stage fail.
    """
    import re

    import pyarrow as pa

    steps = [(kind, code.strip()) for kind, codes in plan for code in codes.split(",") if code.strip()]

    def one(text: str | None) -> tuple:
        figures = tables = None
        if not text or not text.strip():
            return text, False, "no text", figures, tables
        for kind, code in steps:
            if (kind, code) == ("tag", "0"):
                figures, tables = (len(re.findall(rf"\[START_{name}\]|\[{name}:|\\begin\{{{name.lower()}", text)) for name in ("FIGURE", "TABLE"))
                continue
            step = DOCUMENT_STAGES.get((kind, code))
            if step is None:
                return text, False, f"{kind} {code}: no such stage", figures, tables
            try:
                new = step(text)
            except Exception as error:  # noqa: BLE001  one document's failure is its own
                return text, False, f"{kind} {code}: {error}", figures, tables
            if not new.strip():
                return text, False, f"{kind} {code}: empty", figures, tables
            text = new
        return text, True, "", figures, tables

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int64())
        for batch in batches:
            rows = [one(t) for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=["id", "text", "status", "message", "n_figures", "n_tables"])

    rows = df.select(F.col(key).cast("string").alias("id"), F.col(column).cast("string").alias("text"))
    return rows.mapInArrow(run, "id string, text string, status boolean, message string, n_figures long, n_tables long")
