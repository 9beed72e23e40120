"""Which page a line comes from, by tf-idf words and linear margins.

The classifier is fitted on labelled lines with Spark ML; its guesses along a document are then made
monotone (``align.monotone_bounds``), as lines never go back a page.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.align import monotone_bounds

FEATURES, ROUNDS = 1024, 10


def fit_pages(lines: DataFrame, text: str = "line", page: str = "page") -> PipelineModel:
    """Words, tf-idf, one linear support-vector machine per page number."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="words", pattern=r"\W+", minTokenLength=2),
            HashingTF(inputCol="words", outputCol="tf", numFeatures=FEATURES),
            IDF(inputCol="tf", outputCol="features"),
            OneVsRest(classifier=LinearSVC(maxIter=ROUNDS, regParam=0.01), labelCol=page, featuresCol="features", predictionCol="guess"),
        ]
    ).fit(lines.filter(F.col(text).isNotNull()))


def guess_pages(model: PipelineModel, lines: DataFrame) -> DataFrame:
    return model.transform(lines).drop("words", "tf", "features").withColumn("guess", F.col("guess").cast("int"))


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for labels in batch.column(1).to_pylist():
            values = sorted(set(labels))
            rank = {v: k for k, v in enumerate(values)}
            out.append([0, *monotone_bounds([rank[v] for v in labels], len(values))] if labels else [])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["id", "bounds"])


def page_bounds(guesses: DataFrame, key: str, order: str, guess: str) -> DataFrame:
    """(id, bounds): where each guessed page begins, in order of pages; a document's guesses are one small number per line."""
    rows = guesses.groupBy(F.col(key).cast("string").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, guess))), lambda x: x[guess]).alias("labels"))
    return rows.mapInArrow(_bounds, "id string, bounds array<bigint>")
