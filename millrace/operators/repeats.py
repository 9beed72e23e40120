"""Broken repetition of generated text: collapse of phrases, cut of repeating tails, runs of alike lines.

Each works on one text at a time, in Arrow batches. Null gives null, the empty text itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNITS, MOST_REPEATS = 4, 4
TAIL_LEAST = 30
_TAG = re.compile(r"(\[(?:START|END)_[A-Z]+\])")
_EXEMPT = ("TABLE", "FORMULA", "FIGURE")


def _line_tokens(line: str) -> list[str]:
    return [t for part in line.split() for t in _TAG.split(part) if t]


def collapse_phrases(text: str | None, exempt: bool = True) -> tuple[str | None, list[str]]:
    """Phrases of one to four words that follow themselves more than four times are cut to one; with what was cut.

    With ``exempt`` nothing between START and END of tables, formulas and figures is touched, over line ends too.
    """
    if not text:
        return text, []
    out, cut, closing = [], [], ""
    for line in text.split("\n"):
        tokens = _line_tokens(line)
        patterns: list[str] = []
        i = 0
        while i < len(tokens):
            t = tokens[i]
            if exempt and closing:
                closing = "" if t == closing else closing
                i += 1
                continue
            opened = re.fullmatch(r"\[START_([A-Z]+)\]", t)
            if exempt and opened and opened.group(1) in _EXEMPT:
                closing = f"[END_{opened.group(1)}]"
                i += 1
                continue
            if exempt and t.startswith("[MISSING_PAGE"):
                i += 1
                continue
            step = 1
            for size in range(1, UNITS + 1):
                unit, n = tokens[i : i + size], 1
                while len(unit) == size and tokens[i + n * size : i + (n + 1) * size] == unit:
                    n += 1
                if n > MOST_REPEATS:
                    body = r"\s+".join(re.escape(x) for x in unit)
                    patterns.append(rf"(?:{body}\s+){{{n - 1}}}")
                    step = n * size
                    break
            i += step
        spans = []
        for p in dict.fromkeys(patterns):
            if m := re.search(p, line):
                spans.append(m.span())
        kept, at = [], 0
        for a, b in sorted(spans):
            if b <= at:
                continue
            a = max(a, at)
            kept.append(line[at:a])
            cut.append(line[a:b])
            at = b
        out.append("".join(kept) + line[at:])
    return "\n".join(out), cut


def cut_repeating_tail(text: str | None, least: int = TAIL_LEAST) -> str | None:
    """D3: the longest repeating end (case ignored) kept once, and on to the end of its sentence."""
    if not text or len(text) < 2 * least:
        return text
    low = text.lower()
    n = len(low)
    # a repeating end of r letters has its last ``least`` letters once more, r before
    mark, size, at = low[n - least :], 0, low.find(low[n - least :], max(0, n - 2 * ((n - 1) // 2)))
    while 0 <= at < n - least and not size:
        r = n - least - at
        size = r if least <= r <= (n - 1) // 2 and low.startswith(low[n - r :], n - 2 * r) else 0
        at = low.find(mark, at + 1)
    if not size:
        return text
    tail = low[n - size :]
    end = n
    while end >= size and low[end - size : end] == tail:
        end -= size
    kept = text[:end]
    rest = text[end:]
    at = 0
    while m := re.compile(r"[.?!\n]").search(rest, at):
        kept += rest[at : m.end()]
        at = m.end()
        following = re.compile(r"[.?!\n]").search(rest, at)
        sentence = rest[at : following.end() if following else len(rest)]
        if sentence.lower() in tail:
            break
    return kept


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence, all letters of ``a`` at once in the bits of an integer."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    every = open_bits = (1 << len(a)) - 1
    for c in b:
        met = open_bits & at.get(c, 0)
        open_bits = ((open_bits + met) | (open_bits - met)) & every
    return len(a) - open_bits.bit_count()


def alike(a: str, b: str) -> float:
    """Twice the longest common subsequence over both lengths."""
    return 2 * common_letters(a, b) / (len(a) + len(b)) if a or b else 1.0


def _may_be_alike(a: str, b: str, least: float) -> bool:
    """False if the letters the two have in common already rule ``alike`` above ``least`` out."""
    if 2 * min(len(a), len(b)) <= least * (len(a) + len(b)):
        return False
    return 2 * (Counter(a) & Counter(b)).total() > least * (len(a) + len(b))


def repeated_slices(lines: list[str], least: int = 15, gap: int = 3) -> list[tuple[int, int]]:
    """Stretches (first, end) of more than ``least`` lines in which neighbours are alike."""
    clean = [re.sub(r"[0-9_]|\*\*", "", x).strip() for x in lines]
    marked: set[int] = set()
    for i in range(len(lines) - 1):
        j = i + 1
        while j < len(lines) - 1 and not clean[j]:
            j += 1
        a, b = clean[i], clean[j]
        if 3 < len(a) < 200 and 3 < len(b) < 200 and not lines[i].startswith("[MISSING_PAGE") and (a == b or _may_be_alike(a, b, 0.9) and alike(a, b) > 0.9):
            marked |= set(range(i, j))
    out: list[tuple[int, int]] = []
    start = last = None
    for i in [*sorted(marked), None]:
        if last is not None and (i is None or i - last > gap):
            if last + 2 - start > least:
                out.append((start, last + 2))
            start = None
        if i is not None:
            start = i if start is None else start
            last = i
    return out


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        collapsed = [collapse_phrases(t) for t in texts]
        rest = [cut_repeating_tail(t) for t, _ in collapsed]
        columns = [
            batch.column(0), pa.array(rest, pa.string()), pa.array([sum(map(len, c)) for _, c in collapsed], pa.int64()),
            pa.array([len(repeated_slices(t.split("\n"))) if t else 0 for t in rest], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_cut", "n_slices"])


def clean_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, text, n_cut, n_slices) for every text; one narrow pass."""
    df = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return df.mapInArrow(_run, "doc_id long, text string, n_cut long, n_slices long")
