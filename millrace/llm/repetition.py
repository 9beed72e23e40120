"""Repetition inside a single document (p4), with risk-controlled cutoffs.

A word is an unbroken run of letters, case ignored. A window is five consecutive words; it is
repeated if the same five words start earlier in the text. A word is a repeat if it lies in a
repeated window. ``word_share`` is the share of such words, ``window_share`` that of repeated windows.

Documents are screened by ``window_share``, for which windows are compared by hashes, before the exact share is
taken with the windows themselves. The cutoff of the screen is risk-controlled per stratum (source): a screened-out
case is a false rejection; of a labelled holdout (the documents whose hashed ids are even, labelled by the
exact share) the cases are counted that each cutoff of a fixed grid would reject; the cutoff taken is the
highest up to which none is rejected and an exact (Clopper-Pearson) bound keeps the rate at or below ``max_risk``,
with the error level split over all strata and grid values (Bonferroni). A stratum that certifies no value of
the grid has the cutoff FLOOR, below which no case can lie by proof. The other half of the documents tells
how many cases were rejected in truth (``p4_cutoffs``).

Null, empty and short texts (under five words) have share 0. Repeated rows are measured each. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.runtime import broadcast_if_small, materialize
from millrace.sources.tables import columns_or_null, table

WINDOW = 5
CASE_SHARE = 0.30
#: A text with word_share of CASE_SHARE has at least this window_share: each repeated window covers at most five words.
FLOOR = CASE_SHARE / WINDOW
GRID = tuple(round(FLOOR + 0.02 * i, 2) for i in range(13))
MAX_RISK, LEVEL = 0.02, 0.05

_LETTERS = regex.compile(r"\p{L}+")
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def repeat_counts(text: str | None) -> tuple[int, int, int]:
    """Words, repeated words and repeated windows of one text."""
    words = _LETTERS.findall(text or "")
    n = len(words)
    if n <= WINDOW:
        return n, 0, 0
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w.lower(), len(known)) for w in words), np.uint64, n) + np.uint64(1)
    spread = ids * ids * _MULTIPLIERS[0] + ids
    windows = sum((spread[k : n - WINDOW + 1 + k] * m for k, m in enumerate(_MULTIPLIERS)), np.zeros(n - WINDOW + 1, np.uint64))
    _, first, inverse = np.unique(windows, return_index=True, return_inverse=True)
    again = np.flatnonzero(first[inverse] != np.arange(len(windows)))
    if not len(again):
        return n, 0, 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    return n, int((np.cumsum(edge[:-1]) > 0).sum()), len(again)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = np.array([repeat_counts(t) for t in batch.column(2).to_pylist()], np.int64).reshape(-1, 3)
        columns = [batch.column(0), batch.column(1), *(pa.array(counts[:, k]) for k in range(3))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "stratum", "n_words", "n_repeat", "n_windows_repeat"])


def measure_repetition(documents: DataFrame, stratum_col: str = "source") -> DataFrame:
    """Counts and shares of repetition per document; one narrow pass, no shuffle."""
    df = columns_or_null(documents, {"doc_id": "long", stratum_col: "string", "text": "string"})
    df = df.select("doc_id", F.coalesce(stratum_col, F.lit("")).alias("stratum"), "text")
    counts = df.mapInArrow(_measure, "doc_id long, stratum string, n_words long, n_repeat long, n_windows_repeat long")
    windows = F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(1))
    return counts.select(
        "*",
        (F.col("n_repeat") / F.greatest("n_words", F.lit(1))).alias("word_share"),
        (F.col("n_windows_repeat") / windows).alias("window_share"),
    )


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), by the continued fraction of the incomplete beta function."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    return _beta_share(n - k, k + 1, 1 - p)


def _beta_share(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_share(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), 1e-300)
    total = d
    for m in range(1, 10_000):
        for numerator in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + numerator * d or 1e-300)
            c = 1 + numerator / c or 1e-300
            total *= c * d
        if abs(c * d - 1) < 1e-12:
            break
    return front * total / a


def exact_share(text: str | None) -> tuple[int, int]:
    """Words and repeated words of one text, by the windows themselves."""
    words = [w.lower() for w in _LETTERS.findall(text or "")]
    seen: set[tuple[str, ...]] = set()
    n_repeat = end = 0  # words before ``end`` are counted
    for k in range(len(words) - WINDOW + 1):
        window = tuple(words[k : k + WINDOW])
        if window in seen:
            n_repeat += k + WINDOW - max(k, end)
            end = k + WINDOW
        else:
            seen.add(window)
    return len(words), n_repeat


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = np.array([exact_share(t) for t in batch.column(1).to_pylist()], np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts[:, 0]), pa.array(counts[:, 1])], names=["doc_id", "n_words", "n_repeat"])


def controlled_cutoffs(labelled: DataFrame, max_risk: float = MAX_RISK, level: float = LEVEL) -> DataFrame:
    """(stratum, cutoff, certified, n_cases, bound): the screen's cutoff per stratum.

    ``labelled``: stratum, window_share and the label is_case, of the holdout. Counts are taken over all rows by
    partial aggregation; what is gathered is one row per stratum. ``bound`` is the upper bound of the share of cases
    that the cutoff rejects, at the level split over all tests.
    """
    counts = labelled.groupBy("stratum").agg(
        F.count_if("is_case").alias("n_cases"),
        F.array(*[F.count_if(F.col("is_case") & (F.col("window_share") < c)) for c in GRID]).alias("n_lost"),
    )

    def choose(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for stratum, n, lost, tests in zip(frame["stratum"], frame["n_cases"], frame["n_lost"], frame["tests"]):
                sure = [c for c, k in zip(GRID, lost) if k == 0 and binomial_cdf(0, int(n), max_risk) <= level / tests]
                bound = 1 - (level / tests) ** (1 / n) if n else 1.0
                rows.append((stratum, max(sure, default=FLOOR), bool(sure), int(n), bound if sure else 0.0))
            yield pd.DataFrame(rows, columns=["stratum", "cutoff", "certified", "n_cases", "bound"])

    tests = counts.agg((F.count("*") * len(GRID)).alias("tests"))
    return counts.crossJoin(F.broadcast(tests)).mapInPandas(choose, "stratum string, cutoff double, certified boolean, n_cases long, bound double")


def in_holdout(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(2)) == 0


def screened(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The measures of all documents with ``cutoff`` and ``kept`` (not screened out), and the cutoffs."""
    measured = materialize(measure_repetition(documents)).withColumn("is_case", F.col("word_share") >= CASE_SHARE)
    cutoffs = materialize(controlled_cutoffs(measured.filter(in_holdout(F.col("doc_id")))))
    # a stratum without a holdout row is certified by none
    joined = measured.join(F.broadcast(cutoffs.select("stratum", "cutoff")), "stratum", "left").withColumn("cutoff", F.coalesce("cutoff", F.lit(FLOOR)))
    return joined.withColumn("kept", F.col("window_share") >= F.col("cutoff")), cutoffs


def flag_repetition(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_repeat, word_share): the exact measure of every document that the screen keeps."""
    kept = screened(documents)[0].filter("kept").select("doc_id").distinct()
    texts = columns_or_null(documents, {"doc_id": "long", "text": "string"}).join(broadcast_if_small(materialize(kept)), "doc_id", "left_semi")
    exact = texts.mapInArrow(_exact, "doc_id long, n_words long, n_repeat long")
    return exact.withColumn("word_share", F.col("n_repeat") / F.greatest("n_words", F.lit(1)))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    flagged = flag_repetition(table(spark, root, "documents"))
    return flagged.filter(F.col("word_share") >= CASE_SHARE).select("doc_id").distinct()


def p4_shares(spark: SparkSession, root: str) -> DataFrame:
    return measure_repetition(table(spark, root, "documents")).select(
        "doc_id", "n_words", "n_repeat", F.round("word_share", 6).alias("word_share")
    )


def p4_cutoffs(spark: SparkSession, root: str) -> DataFrame:
    """The cutoffs with what they do on the half of the documents that is not the holdout: cases, cases rejected, others kept."""
    rows, cutoffs = screened(table(spark, root, "documents"))
    test = rows.filter(~in_holdout(F.col("doc_id"))).groupBy("stratum").agg(
        F.count_if("is_case").alias("n_test_cases"), F.count_if(F.col("is_case") & ~F.col("kept")).alias("n_test_rejected"), F.count_if(~F.col("is_case") & F.col("kept")).alias("n_test_others_kept"),
    )
    return cutoffs.join(test, "stratum", "left")


_SQL_WORDS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '\p{L}+') AS words FROM documents),
p AS (SELECT doc_id, lower(words[i]) AS word, i FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w)),
g AS (SELECT doc_id, i, word, lead(word, 4) OVER o AS last,
             concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS window5
      FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
d AS (SELECT doc_id, i, CASE WHEN last IS NOT NULL AND row_number() OVER (PARTITION BY doc_id, window5 ORDER BY i) > 1 THEN 1 ELSE 0 END AS again FROM g),
c AS (SELECT doc_id, max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM d),
s AS (SELECT doc_id, count(*) AS n_words, sum(hit)::BIGINT AS n_repeat FROM c GROUP BY doc_id)
"""
QUERIES = {"p4_found": p4_found, "p4_shares": p4_shares, "p4_cutoffs": p4_cutoffs}
SQL = {
    "p4_found": _SQL_WORDS + "SELECT doc_id FROM s WHERE n_repeat >= 0.30 * n_words",
    "p4_shares": _SQL_WORDS
    + """SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_repeat, 0) AS n_repeat,
    round(coalesce(n_repeat::DOUBLE / n_words, 0.0), 6) AS word_share FROM w LEFT JOIN s USING (doc_id)""",
}
