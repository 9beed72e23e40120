"""Alignment of a document's lines with its pages, and scores of recognised text.

``monotone_bounds`` finds the page boundaries of a sequence of page guesses: labels along a document never
fall, so the boundaries are the steps that leave the least summed Gini impurity, by dynamic programming over
positions. ``find_phrase`` looks up a page's first words approximately, and corrects a boundary. Edit distances
are taken with all letters of the shorter text at once in the bits of an integer.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gini(counts: Counter | dict) -> float:
    """n - sum(c^2) / n."""
    n = sum(counts.values())
    return n - sum(c * c for c in counts.values()) / n if n else 0.0


def monotone_bounds(labels: list[int], classes: int) -> list[int]:
    """Positions b[1] <= ... <= b[classes - 1] at which label k begins, with the least summed Gini impurity of the stretches.

    Of equal ones those with the fewest labels out of place are taken, and of these the later boundaries.
    """
    n = len(labels)
    if classes <= 1:
        return []
    kinds = np.asarray(labels, np.int64)
    counts = np.zeros((n + 1, max(classes, int(kinds.max(initial=0)) + 1)))
    counts[np.arange(1, n + 1), kinds] = 1
    counts = np.cumsum(counts, axis=0)

    def cost(k: int, end: int) -> np.ndarray:
        """Of giving [i, end) to class k, for every i up to ``end``; labels out of place weigh so little that they only part ties."""
        inner = counts[end] - counts[: end + 1]
        size = inner.sum(axis=1)
        impurity = size - (inner**2).sum(axis=1) / np.maximum(size, 1)
        return impurity + (size - inner[:, k]) * 1e-6

    best = np.array([cost(0, j)[0] for j in range(n + 1)])
    choice: list[np.ndarray] = []
    for k in range(1, classes):
        new, pick = np.zeros(n + 1), np.zeros(n + 1, np.int64)
        for j in range(n + 1):
            total = np.round(best[: j + 1] + cost(k, j), 9)
            pick[j] = j - int(np.argmin(total[::-1]))
            new[j] = total[pick[j]]
        best = new
        choice.append(pick)
    out, at = [], n
    for pick in reversed(choice):
        at = int(pick[at])
        out.append(at)
    return out[::-1]


def _distances(pattern: str, text: str, anywhere: bool) -> Iterator[int]:
    """Edit distance of ``pattern`` to the text up to each of its letters, from its start or from ``anywhere``."""
    m = len(pattern)
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    every, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = every, 0, m  # steps of the column that rise and fall
    for c in text:
        equal = at.get(c, 0)
        across = equal | down
        diagonal = (((equal & up) + up) ^ up) | equal
        rise, fall = down | ~(diagonal | up) & every, up & diagonal
        score += bool(rise & high) - bool(fall & high)
        rise, fall = rise << 1 | (not anywhere), fall << 1
        up, down = (fall | ~(across | rise)) & every, rise & across & every
        yield score


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance; common ends are taken off first."""
    if a == b:
        return 0
    head = len(os.path.commonprefix((a, b)))
    a, b = a[head:], b[head:]
    tail = len(os.path.commonprefix((a[::-1], b[::-1])))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not a or not b:
        return len(a) + len(b)
    score = 0
    for score in _distances(a, b, False):
        pass
    return score


def edit_share(a: str, b: str) -> float | None:
    """Edit distance over the longer length; null where either is shorter than four characters."""
    return edit_distance(a, b) / max(len(a), len(b)) if min(len(a), len(b)) >= 4 else None


def find_phrase(needle: str, text: str, most: int | None = None) -> tuple[int, int] | None:
    """(end, distance) of the place in ``text`` that ``needle`` is nearest to, within ``most`` edits; the first of equals."""
    if not needle:
        return (0, 0)
    most = min(len(needle) - 1, int(0.025 * len(needle)) + 5) if most is None else most
    exact = text.find(needle)
    if exact >= 0:
        return exact + len(needle), 0
    found: tuple[int, int] | None = None
    for j, distance in enumerate(_distances(needle, text, True), 1):
        if distance <= most and (found is None or distance < found[1]):
            found = (j, distance)
    return found


def boundary_score(needle: str, found: tuple[int, int] | None) -> float:
    """A10: 1 - distance / most edits; 0 without a match."""
    if found is None:
        return 0.0
    most = min(len(needle) - 1, int(0.025 * len(needle)) + 5)
    return 1.0 - found[1] / most if most > 0 else float(found[1] == 0)


def bleu(prediction: str, truth: str, order: int = 4) -> float:
    """Geometric mean of clipped n-gram precisions (one added to both from bigrams on) with the brevity penalty."""
    a, b = prediction.split(), truth.split()
    if not a or not b:
        return 0.0
    total = 0.0
    for n in range(1, order + 1):
        x, y = (Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1)) for t in (a, b))
        hit, all_ = (x & y).total(), max(x.total(), 0)
        if n > 1:
            hit, all_ = hit + 1, all_ + 1
        if not hit or not all_:
            return 0.0
        total += math.log(hit / all_)
    return min(1.0, math.exp(1 - len(b) / len(a))) * math.exp(total / order)


def _first_words(text: str, n: int = 22) -> str:
    return " ".join(re.sub(r"[\s*_^{}#-]+", " ", text).lower().split()[:n])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, pages, truth in zip(*(c.to_pylist() for c in batch.columns)):
            text, at = " ".join(re.sub(r"[\s*_^{}#-]+", " ", truth or "").lower().split()), 0
            for k, page in enumerate(pages or []):
                needle = _first_words(page or "")
                found = find_phrase(needle, text[at:]) if needle else None
                end = at + found[0] if found else None
                rows.append((key, k, end - len(needle) if end is not None and needle else None, boundary_score(needle, found) if needle else 0.0, bleu(_first_words(page or ""), _first_words(text[max(0, (end or 0) - len(needle)) :])) if end else 0.0))
                at = end if end is not None else at
        columns = list(zip(*rows)) if rows else [()] * 5
        types = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["id", "page_no", "start", "score", "bleu"])


def align_pages(df: DataFrame, key: str, pages: str, text: str) -> DataFrame:
    """(id, page_no, start, score, bleu): where each page begins in the document's text, pages in order."""
    rows = df.select(F.col(key).cast("string").alias("id"), F.col(pages).cast("array<string>"), F.col(text).cast("string"))
    return rows.mapInArrow(_aligned, "id string, page_no long, start long, score double, bleu double")


FIGURE_SCORE, CAPTION_RATIO = 0.8, 0.8


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, captions, truth in zip(*(c.to_pylist() for c in batch.columns)):
            text = " ".join((truth or "").split())
            for k, caption in enumerate(captions or []):
                needle = " ".join((caption or "").split())
                found = find_phrase(needle, text) if needle else None
                if needle and (score := boundary_score(needle, found)) > FIGURE_SCORE:
                    rows.append((key, k, found[0], score))
        columns = list(zip(*rows)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.float64()))], names=["id", "caption_no", "end", "score"])


def find_figures(df: DataFrame, key: str, captions: str, text: str) -> DataFrame:
    """(id, caption_no, end, score): where each caption of a document stands in its text, by a score above FIGURE_SCORE."""
    rows = df.select(F.col(key).cast("string").alias("id"), F.col(captions).cast("array<string>"), F.col(text).cast("string"))
    return rows.mapInArrow(_found, "id string, caption_no long, end long, score double")
