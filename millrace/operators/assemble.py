"""Text of a region from its recognised boxes: lines, paragraph starts, joining."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.boxes import area, common_area, neighbours, overlap

_CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
RAGGED = 15


def covers(a: str = "a_", b: str = "b_") -> Column:
    """Boxes that meet, with centres within half the smaller height, and half of the smaller box in common (sides inclusive)."""
    height = lambda k: F.col(f"{k}ymax") - F.col(f"{k}ymin")
    centre = lambda k: (F.col(f"{k}ymax") + F.col(f"{k}ymin")) / 2
    inclusive = (overlap("x", a, b) + 1) * (overlap("y", a, b) + 1)
    size = lambda k: (F.col(f"{k}xmax") - F.col(f"{k}xmin") + 1) * (height(k) + 1)
    near = F.abs(centre(a) - centre(b)) <= F.least(height(a), height(b)) / 2
    return (common_area(a, b) > 0) & near & (inclusive / F.least(size(a), size(b)) >= 0.5) & (area(a) > 0)


def flagged_boxes(boxes: DataFrame, spans: DataFrame, page: list[str]) -> DataFrame:
    """1 for each box that covers a mathematical span of its page, else 0."""
    hits = neighbours(boxes, spans, page).filter(covers()).select(*page, F.col("a_box").alias("box")).distinct().withColumn("flag", F.lit(1))
    return boxes.join(hits, [*page, "box"], "left").withColumn("flag", F.coalesce("flag", F.lit(0)))


def order_lines(boxes: list[tuple]) -> list[list[tuple]]:
    """Boxes (xmin, ymin, xmax, ymax, text) as lines from top to bottom, each from left to right."""
    lines: list[list[tuple]] = []
    for b in sorted(boxes, key=lambda b: (b[1], b[0])):
        if lines:
            last = lines[-1][-1]
            meet = min(b[3], last[3]) - max(b[1], last[1])
            if meet > 0.5 * min(b[3] - b[1], last[3] - last[1]):
                lines[-1].append(b)
                continue
        lines.append([b])
    return [sorted(line) for line in lines]


def paragraph_starts(lines: list[list[tuple]]) -> list[bool]:
    """Whether each line starts a paragraph: left edges in two clusters of which one follows short lines, or a line after a short one."""
    n = len(lines)
    if n < 2:
        return [True] * n
    left = np.array([line[0][0] for line in lines])
    right = np.array([line[-1][2] for line in lines])
    eps = 0.5 * float(np.mean([b[3] - b[1] for line in lines for b in line]))
    order = np.argsort(left, kind="stable")
    cluster = np.empty(n, int)
    cluster[order] = np.cumsum(np.concatenate(([0], np.diff(left[order]) > eps)))
    starts = [False] * n
    starts[0] = True
    sizes = np.bincount(cluster)
    if len(sizes) == 2 and (sizes >= 2).all():
        before = [right[[i - 1 for i in range(1, n) if cluster[i] == c]] for c in (0, 1)]
        if all(len(b) for b in before):
            short = int(before[1].mean() < before[0].mean())
            spread = float(np.abs(before[1 - short] - before[1 - short].mean()).mean())
            if before[1 - short].mean() - before[short].mean() > 5 * max(spread, 1e-9):
                for i in range(1, n):
                    starts[i] = cluster[i] == short
                return starts
    if n > 5:
        edge = np.median(right)
        for i in range(1, n):
            starts[i] = bool(right[i - 1] < edge - RAGGED * eps)
    return starts


def region_text(boxes: list[tuple]) -> str:
    """Paragraphs of a region; lines are joined with a space, but not between two CJK characters."""
    lines = order_lines(boxes)
    out = ""
    for line, start in zip(lines, paragraph_starts(lines)):
        text = ""
        for b in line:
            piece = (b[4] or "").strip()
            text += ("" if not text or not piece or (_CJK.match(piece) and _CJK.match(text[-1])) else " ") + piece
        if not text:
            continue
        glue = "" if not out else "\n\n" if start else "" if _CJK.match(out[-1]) and _CJK.match(text) else " "
        out += glue + text
    return out


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [region_text([(b["xmin"], b["ymin"], b["xmax"], b["ymax"], b["text"]) for b in boxes]) for boxes in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["region", "text"])


def assemble(boxes: DataFrame, region: str) -> DataFrame:
    """(region, text) from rows of region, xmin, ymin, xmax, ymax and text. A region's boxes are a few dozen."""
    rows = boxes.groupBy(F.col(region).cast("string").alias("region")).agg(F.collect_list(F.struct("xmin", "ymin", "xmax", "ymax", "text")).alias("boxes"))
    return rows.mapInArrow(_run, "region string, text string")
