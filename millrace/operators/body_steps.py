"""Steps over the assembled text of a document (survey ids X4, X17 with X17a to X17i, X21).

A document is the lines of its front (title, meta data, figures, tables, references) and those of its body, which follow the line
``#Main Body``. Each step takes and gives both, so that any choice and order of steps can be run; ``STEPS`` is the
usual order and ``OPTIONAL`` holds two that are off by default. A text without a body passes unchanged.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Lines = list[str]
Step = Callable[[Lines, Lines], tuple[Lines, Lines]]

# Marks of the assembled text.
BODY, FIGURES, TABLES, REFERENCES, META, TITLE = "#Main Body", "##Figures", "##Tables", "##Reference", "#Meta", "#Title"
_FLAG = r"\[START_EQU_FLAG\]<\d+>\[END_EQU_FLAG\]"
_NUMBER = r"\(\d+(?:\.\d+)*\)"
_REF = re.compile(r'<ref type="(?P<kind>[^"]*)"(?P<rest>[^>]*)>(?P<text>.*?)</ref>')
_TARGET = re.compile(r'target="#?([^"]*)"')
_MATH_ENDS = re.compile(r"^\\\(|\\\)$")


def without_loose_figures(front: Lines, body: Lines) -> tuple[Lines, Lines]:
    """A paragraph that opens with the name of a figure but refers to none is a stray caption and goes."""
    out: Lines = []
    k = 0
    while k < len(body):
        end = next((i for i in range(k, len(body)) if body[i] == "</p>"), None) if body[k] == "<p>" else None
        if end is None:
            out.append(body[k])
            k += 1
            continue
        first = body[k + 1]
        if not (re.search(r"Figure \d", first) and 'ref type="figure"' not in first):
            out += body[k : end + 1]
        k = end + 1
    return front, out


def bare_formulas(front: Lines, body: Lines) -> tuple[Lines, Lines]:
    """The inline delimiters inside a formula that has a line of its own go."""

    def bare(line: str) -> str:
        m = re.match(r"(<formula[^>]*>)(.*?)((?:\[START_EQU_FLAG\].*?)?)(</formula>.*)$", line)
        return m.group(1) + _MATH_ENDS.sub("", m.group(2).strip()).strip() + m.group(3).strip() + m.group(4) if m else line

    return front, [bare(x) for x in body]


def tagged_formulas(front: Lines, body: Lines) -> tuple[Lines, Lines]:
    r"""Inline formulas \(...\) or \[...\] with a number flag come between the project's tags."""
    flagged = re.compile(rf"(\\\((?:(?!\\\)).)*\\\)|\\\[(?:(?!\\\]).)*\\\]){_FLAG}")
    return front, [x if x.startswith("<formula") else flagged.sub(lambda m: f"[START_EQU]{m.group()}[END_EQU]", x) for x in body]


def numbered(label: str, seen: Counter, mark: str) -> str:
    """A label that is used again gets as many marks as it was used before."""
    label, n = label + mark * seen[label], label
    seen[n] += 1
    return label


def equations(front: Lines, body: Lines) -> tuple[Lines, Lines]:
    """Formulas of their own with a target or a printed number become labelled equations, and references to them links; others are tagged."""
    seen: Counter = Counter()
    known: dict[str, str] = {}
    out: Lines = []
    for line in body:
        m = re.search(r"<formula([^>]*)>(.*?)</formula>", line)
        if not m:
            out.append(line)
            continue
        content, label = m.group(2).strip(), None
        if target := _TARGET.search(m.group(1)):
            label = known[target.group(1)] = "eq:" + target.group(1)
        elif number := re.search(rf"({_NUMBER}){_FLAG}$", content):
            content = content.replace(number.group(1), "").strip().strip(",")
            label = "eq:" + numbered(number.group(1)[1:-1], seen, "a")
        if label:
            out += ["\\begin{equation}", content, f"\\label{{{label}}}", "\\end{equation}", ""]
        else:
            inner = content.replace("[START_EQU_FLAG]", "\\)[START_EQU_FLAG]")
            out.append(line[: m.start()] + "[START_EQU]\\(" + inner + "[END_EQU]" + line[m.end() :])

    def link(m: re.Match) -> str:
        target = _TARGET.search(m.group("rest"))
        label = known.get(target.group(1)) if m.group("kind") == "formula" and target else None
        return f"[{m.group('text')}]({label})" if label else m.group()

    return front, [_REF.sub(link, x) for x in out]


def sections(front: Lines) -> dict[str, tuple[int, int]]:
    """Begin and end of the figures, tables and references among the lines of the front."""
    heads = [(i, x) for i, x in enumerate(front) if x in (FIGURES, TABLES, REFERENCES)] + [(len(front), "")]
    return {x: (i + 1, heads[k + 1][0]) for k, (i, x) in enumerate(heads[:-1])}


def own_labels(front: Lines, body: Lines) -> tuple[Lines, Lines]:
    r"""X17d: a figure's or table's label is that of its target (fig_3 gives \label{fig:3}) and stands after its caption."""
    for name, kind in ((FIGURES, "fig"), (TABLES, "tbl")):
        begin, end = sections(front).get(name, (0, 0))
        blocks: list[Lines] = []
        for line in front[begin:end]:
            if line.startswith("\\begin") or not blocks:
                blocks.append([])
            blocks[-1].append(line)
        for block in blocks:
            target = re.search(r"<target>(\w+)<\\target>", "\n".join(block))
            at = next((i for i, x in enumerate(block) if "\\label{" in x), None)
            if at is None:
                continue
            if target and "_" in target.group(1):
                block[at] = re.sub(r"\\label\{.*?\}", lambda _: f"\\label{{{kind}:{target.group(1).split('_')[1]}}}", block[at])
            if block[at].endswith("}}"):  # the label closes the caption; it moves out of it
                block[at : at + 1] = ["}", block[at][:-1]]
        front = front[:begin] + [x for b in blocks for x in b] + front[end:]
    return front, body


def resolved_references(front: Lines, body: Lines) -> tuple[Lines, Lines]:
    """X17d: references become the number of their citation or a link to their figure or table.

    A citation without a known target goes; any other reference without one keeps its text.
    """
    at = sections(front)
    places: dict[str, dict[str, str]] = {"bibr": {}, "figure": {}, "table": {}}
    for name, kind in ((FIGURES, "figure"), (TABLES, "table")):
        target = None
        label = None
        for line in front[slice(*at.get(name, (0, 0)))]:
            if line.startswith("\\begin"):
                target = label = None
            target = m.group(1) if (m := re.search(r"<target>(\w+)<\\target>", line)) else target
            label = m.group(1) if (m := re.search(r"\\label\{(.*?)\}", line)) else label
            if target and label:
                places[kind][target] = label
    for line in front[slice(*at.get(REFERENCES, (0, 0)))]:
        if (number := re.search(r"\[(.*?)\]", line)) and (key := re.search(r"<(b\d+)>", line)):
            places["bibr"][key.group(1)] = number.group(1)

    def resolve(m: re.Match) -> str:
        kind, text, word = m.group("kind"), m.group("text"), m.group("word") or ""
        target = _TARGET.search(m.group("rest"))
        found = places.get(kind, {}).get(target.group(1)) if target else None
        if kind == "bibr":
            return word + (f"<START_REF>{found}<END_REF>" if found else "")
        if found and kind in ("figure", "table"):
            return f"[{kind.title()} {text}]({found})" if word.strip().lower().rstrip(".") in ("", "fig", "tbl", kind) else f"{word}[{kind.title()} {text}]({found})"
        return word + text

    pattern = re.compile(r"(?P<word>(?:[Ff]ig(?:ure|\.)|[Tt]able|tbl\.?) )?" + _REF.pattern)
    return front, [pattern.sub(resolve, x) for x in body]


def whole_references(front: Lines, body: Lines) -> tuple[Lines, Lines]:
    """X17d: a reference on several lines becomes one, up to the line that ends with a bracket; its key goes."""
    begin, end = sections(front).get(REFERENCES, (0, 0))
    out, held = [], ""
    for line in front[begin:end]:
        held += re.sub(r"<b\d+>\s*", "", line).strip("\t")
        if line.endswith(")"):
            out.append(held)
            held = ""
    return front[:begin] + out + ([held] if held else []) + front[end:], body


def without_coords(front: Lines, body: Lines) -> tuple[Lines, Lines]:
    """X17e: coordinates go, and every heading of the body gets a blank line before it."""
    body = [re.sub(r' coords="[^"]+"', "", x) for x in body]
    return front, [y for x in body for y in (("", x) if re.match(r"#+\w", x) else (x,))]


def _environment(name: str) -> Step:
    def step(front: Lines, body: Lines) -> tuple[Lines, Lines]:
        out, inside = [], False
        for line in front:
            if line.startswith(f"\\begin{{{name}"):
                inside = True
            elif line.startswith(f"\\end{{{name}"):
                inside = False
            elif inside:
                line = re.sub(r"<\\?[sp]>|<head>.*<\\head>|<label>.*<\\label>|<target>.*<\\target>", "", line)
                if not line or line.startswith("coords="):
                    continue
            out.append(line)
        return out, body

    step.__doc__ = f"X17f: markup and coordinates inside {name} environments go, and the lines they leave empty."
    return step


clean_figures, clean_tables = _environment("figure"), _environment("table")


def spliced(front: Lines, body: Lines) -> tuple[Lines, Lines]:
    """X17g: the sentences of a paragraph on one line; an equation number on a line of its own labels the formula before it."""
    rows: Lines = []
    held: Lines = []

    def close() -> None:
        if held:
            rows.append(" ".join(held))
            held.clear()

    for line in body:
        if "[START_ABSTRACT]" in line or "[END_ABSTRACT]" in line:
            close()
            rows.append(line)
        elif line in ("<p>", "</p>"):
            close()
        elif re.match(r"#+\w", line):
            close()
            rows.append("\n" + line)
        elif line:
            held.append(line.replace("<s>", "").replace("</s>", ""))
    close()
    seen = Counter(m for x in body for m in re.findall(r"\\label\{eq:(\d+(?:\.\d+)?)\}", x))
    out: Lines = []
    for line in rows:
        line = re.sub(r"^•+", "", line)
        if out and re.fullmatch(_NUMBER, line) and (m := re.search(r"\[START_EQU\](.*?)\[END_EQU\]", out[-1])):
            content = re.sub(rf"^\\\(|\\\)(?=(?:{_FLAG})?$)", "", m.group(1).strip()).strip()
            label = numbered(line[1:-1], seen, "b")
            out[-1] = f"{out[-1][: m.start()]}\\begin{{equation}} {content} \\label{{eq:{label}}} \\end{{equation}}{out[-1][m.end() :]}"
        else:
            out.append(line)
    return front, out


def titled(front: Lines, body: Lines) -> tuple[Lines, Lines]:
    """X17h: the title without its mark (an unknown one is empty) over a double line."""
    if META not in front:
        return front, body
    at = front.index(META)
    head = [("" if x == "None" else x) for x in (y.replace(TITLE, "") for y in front[:at])]
    return [*head, "=============", "", *front[at:]], body


def without_tables(front: Lines, body: Lines) -> tuple[Lines, Lines]:
    """X17i/X21: the section of tables is emptied."""
    begin, end = sections(front).get(TABLES, (0, 0))
    return front[:begin] + front[end:], body


def renumbered(front: Lines, body: Lines) -> tuple[Lines, Lines]:
    """X17i/X21: references numbered anew from one, without the number and key they had and their last bracket."""
    begin, end = sections(front).get(REFERENCES, (0, 0))
    out, n = [], 0
    for line in front[begin:end]:
        if m := re.match(r"\d+\.\[\d+\]\((.*)\)$", line):
            n += 1
            line = f"[{n}]" + re.sub(r"^<b\d+>", "", m.group(1))
        out.append(line)
    return front[:begin] + out + front[end:], body


STEPS: tuple[Step, ...] = (
    without_loose_figures, bare_formulas, tagged_formulas, equations, own_labels, resolved_references, whole_references, without_coords, clean_figures, clean_tables, spliced, titled,
)
OPTIONAL = {"without_tables": without_tables, "renumbered": renumbered}


def finished(text: str | None, steps: tuple[Step, ...] = STEPS) -> str | None:
    """The steps one after the other."""
    lines = text.split("\n") if text else []
    if BODY not in lines:
        return text
    at = lines.index(BODY)
    front, body = lines[:at], lines[at + 1 :]
    for step in steps:
        front, body = step(front, body)
    return "\n".join([*front, BODY, *body])


def latex_table(caption: list[str], rows: list[list[str | None]], spans: list[list[int]], label: str = "", target: str = "") -> str:
    """A table as LaTeX: cells over several columns repeated, rows cut or filled with blanks to the width of the head, missing cells ``empty``."""
    wide = [["empty" if c is None else c for c, n in zip(r, ns) for _ in range(max(1, n))] for r, ns in zip(rows, spans)]
    out = ["\\begin{table*}[h]", "\\caption{", *caption, f"\\label{{tbl:{label or target}}}}}"]
    if len(wide) > 1 and wide[0]:
        width = len(wide[0])
        body = [(r + [" "] * width)[:width] for r in wide[1:]]
        line = lambda r: " & ".join(r) + " \\\\"
        out += [f"\\begin{{tabular}}{{{'l' * width}}}", "\\toprule", line(wide[0]), "\\midrule", *map(line, body), "\\bottomrule", "\\end{tabular}"]
    return "\n".join([*out, "\\end{table*}"])


def _finish(names: tuple[str, ...]):
    steps = (*STEPS, *(OPTIONAL[n] for n in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([finished(t, steps) for t in batch.column(1).to_pylist()], pa.string())], names=["id", "text"])

    return run


def finished_documents(df: DataFrame, key: str, text: str, optional: tuple[str, ...] = ()) -> DataFrame:
    """(id, text) with the usual steps and the chosen optional ones; one narrow pass."""
    return df.select(F.col(key).cast("string").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(_finish(optional), "id string, text string")
