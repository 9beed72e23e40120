"""Clean-up of recognised pages as Markdown."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators.repeats import alike, cut_repeating_tail, repeated_slices

# Limits of the clean-up.
LONG_HEADING, MOST_TABULAR, MOST_MULTICOLUMN, MOST_CELLS = 100, 15, 60, 400
MISSING = "[MISSING_PAGE_POST]"
# Spellings of one LaTeX command, in order.
TEX_SYNONYMS = (
    ("\\rbrack ", "] "), ("\\lbrack ", "[ "), ("\\lbrace ", "\\} "), ("\\rbrace ", "\\{ "), ("\\lnot ", "\\neg "), ("\\land ", "\\wedge "), ("\\vee ", "\\lor "), ("\\doublecup ", "\\Cup "),
    ("\\doublecap ", "\\Cap "), ("\\llless ", "\\lll "), ("\\gggtr ", "\\ggg "), ("\\doteqdot ", "\\Doteq "), ("\\ne ", "\\neq "), ("\\le ", "\\leq "), ("\\ge ", "\\geq "),
    ("\\leftarrow ", "\\gets "), ("\\rightarrow ", "\\to "), ("\\restriction ", "\\upharpoonright "), ("\\owns ", "\\ni "), ("\\textlnot ", "\\neg "), ("\\textellipsis ", "\\ldots "),
    ("\\textbullet ", "\\bullet "), ("\\plusmn ", "\\pm "), ("\\texttimes", "\\times"), ("\\textmu", "\\mu"), ("\\textendash", "-"), ("\\textemdash", "---"), ("\\>", "\\:"),
    ("\\medspace", "\\:"), ("\\thinspace", "\\,"), ("\\negthinspace", "\\!"), ("\\thickspace", "\\;"),
)
TEX_STYLES = ("\\displaystyle", "\\scriptstyle", "\\scriptscriptstyle", "\\textstyle")
# Rewrites before repetition is looked for, as (pattern, replacement), in order.
BEFORE = (
    (rf"(?:\n|^)#+ \d*[^\w\n]? ?([^\n]{{{LONG_HEADING},}})", "\n$1"),
    (r"^\s+|\s+$", ""),
    (r"\n\* \[leftmargin=\*\]\n", "\n"),
    (r"(?m)^#+ (?:\.?[\dixv]+)*\s*(?:$|\n\s*)", ""),
    (r"\n#+ [^\n]*$", ""),
)
# Rewrites of references, formulas and footnotes.
MIDDLE = (
    (r"(?m)^\* \[\d+\](?:\s?[A-W]\.+\s?){10,}[^\n]*$", ""),
    (r"(?m)^(\* \[\d+\])\[\]([^\n]*)$", "$1$2"),
    (r"^\w\n\n|\n\n\w$", ""),
    (r"([\s.,()])_([a-zA-Z0-9])__([a-zA-Z0-9]){1,3}_([\s.,:()])", r"$1\\($2_{$3}\\)$4"),
    (r"([\s.,\d])_([a-zA-Z0-9])_([\s.,\d;])", r"$1\\($2\\)$3"),
    (r"(\nFootnote [^\n]*?:) (?:footnotetext|thanks):[^\w\n]*([^\n]*(?:\n\n|$))", "$1 $2"),
    (r"\[FOOTNOTE:[^\n]+?\]([^\n]*?)\[ENDFOOTNOTE\]", ""),
)
# Rewrites of tables and empty lines at the end.
AFTER = (
    (r"\\begin\{table\} \\begin\{tabular\}", r"\\begin{table}" + "\n" + r"\\begin{tabular}"),
    (r"\\end\{tabular\} \\end\{table\}", r"\\end{tabular}" + "\n" + r"\\end{table}"),
    (r"\\end\{table\} Tab", r"\\end{table}" + "\nTab"),
    (r"(?m)^([^\n]+)\\begin\{tab", "$1\n" + r"\\begin{tab"),
    (r"\\begin\{tabular\}\{l l\}  & \\\\ \\end\{tabular\}|\\begin\{tabular\}\{\}\n\n\\end\{tabular\}", ""),
    (r"\\begin\{array\}\[\]\{", r"\\begin{array}{"),
    (r"\\begin\{tabular\}\{[clr ]{2,}\}\s*[& ]*\s*(?:\\\\)? \\end\{tabular\}", ""),
    (r"(?:\*\*S\. A\. B\.\*\*\n+){2,}", ""),
    (r"(?m)^#+(?: [\[\w])?$", ""),
    (r"(?m)^\.[^\S\n]*$", ""),
    (r"\n{3,}", "\n\n"),
)


def rewritten(c: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The rules one after the other; only a newline ends a line, and ``$`` is the very end of a text."""
    for pattern, to in rules:
        lines = pattern.startswith("(?m)")
        pattern = "(?md)" + pattern[4:] if lines else "(?d)" + pattern.replace("$)", r"\z)").removesuffix("$") + (r"\z" if pattern.endswith("$") else "")
        c = F.regexp_replace(c, pattern, to)
    return c


def without_wrong_tables(c: Column) -> Column:
    """Lines of too many table begins, spans or cells are recognition run wild: they are emptied."""
    count = lambda x, word: (F.length(x) - F.length(F.replace(x, F.lit(word), F.lit("")))) / len(word)
    wrong = lambda x: (count(x, "\\begin{tabular}") > MOST_TABULAR) | (count(x, "\\multicolumn") > MOST_MULTICOLUMN) | (count(x, "&") > MOST_CELLS)
    return F.array_join(F.transform(F.split(c, "\n"), lambda x: F.when(wrong(x), "").otherwise(x)), "\n")


def spaced_ends(c: Column) -> Column:
    """Space at the ends of a page, so that pages can be joined: blank lines around headings, captions and full stops, a space after an open word (letters only; no word list is needed)."""
    c = F.when(c.endswith(".") | c.endswith("}"), F.concat(c, F.lit("\n\n"))).otherwise(c)
    last = F.element_at(F.split(c, "\n"), -1)
    starts = lambda x, *marks: F.coalesce(*[F.nullif(x.startswith(m), F.lit(False)) for m in marks], F.lit(False))
    return (
        F.when(c.rlike(r"^[A-Z0-9,;:]$"), F.concat(c, F.lit(" ")))
        .when(starts(c, "#", "**", "\\begin"), F.concat(F.lit("\n\n"), c))
        .when(starts(last, "#", "Figure", "Table"), F.concat(c, F.lit("\n\n")))
        .when(c.rlike(r"(?:^| )[A-Za-z]+\z"), F.concat(c, F.lit(" ")))
        .otherwise(c)
    )


def even_spacing(c: Column) -> Column:
    """Blank lines to one, spaces at line ends away, white space off both ends."""
    return T.strip(F.regexp_replace(F.regexp_replace(c, r"(?m)[ \t]+$", ""), r"\n{3,}", "\n\n"))


def normal_tex(c: Column, inline: bool = True) -> Column:
    """A formula without its delimiters and comments, on one line, one spelling per command, no styles; then between delimiters anew. A blank one is empty."""
    body = T.strip(F.regexp_replace(F.regexp_replace(T.strip(c), r"^(?:\\\(|\\\[|\$\$|\$)", ""), r"(?:\\\)|\\\]|\$\$|\$)\z", ""))
    line = F.replace(F.regexp_replace(body, r"(?<!\\)%[^\n]*\n", "\n"), F.lit("\n"), F.lit(" "))
    plain = T.replace_all(line, (*TEX_SYNONYMS, *[(x, "") for x in TEX_STYLES]))
    opened, closed = ("\\(", "\\)") if inline else ("\\[", "\\]")
    return F.when(body == "", "").otherwise(F.concat(F.lit(opened), plain, F.lit(closed)))


def plain_letters(text: str | None) -> str | None:
    """Compatibility forms and accents folded to base letters."""
    return None if text is None else "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def offset_in_original(text: str, clean_offset: int, removed: str = " *_{}#-\n") -> int:
    """The offset in a text of the character that stands at an offset of the text without the removed marks."""
    seen = 0
    for i, c in enumerate(text):
        if c in removed:
            continue
        if seen == clean_offset:
            return i
        seen += 1
    return len(text)


def _stretch(lines: list[str], clean: list[str], first: int, end: int) -> str:
    """The text of a stretch of alike lines that is to go: back to the first line unlike them, on to the next, less what that line adds."""
    base = clean[first]
    start, checked = first, False
    for i in range(max(0, first - 1), max(0, first - 5), -1):
        if not lines[i]:
            continue
        if lines[i] == "## References":
            start = i
            break
        if alike(base, clean[i]) < 0.9:
            before = clean[max(0, i - 1)].rpartition("* [")[2]
            start = i if len(before) >= 0.75 * len(base) and alike(base, before) < 0.9 else i + 1
            checked = True
            break
    stop = next((i for i in range(min(len(lines), end), min(len(lines), end + 5)) if alike(base, clean[i]) < 0.9), end)
    stop = min(stop, len(lines) - 1)
    text = "\n".join(lines[start : stop + 1])
    if checked and "* [" in text:
        text = "* [" + text.partition("* [")[2]
    letters = [(i, c) for i, c in enumerate(lines[stop]) if not c.isnumeric()]
    same = 0
    for (_, c), d in zip(letters, (d for d in lines[stop - 1] if not d.isnumeric())):
        if c != d:
            break
        same += 1
    if same < len(letters):  # what differs is of the next page
        added = len(lines[stop]) - letters[same][0] - 1
        text = text[: len(text) - added] if added > 0 else text
    return text.strip()


def without_made_up_references(text: str) -> str:
    """Long stretches of alike lines (a list of references that goes on by itself) become a mark of missing text."""
    lines = text.split("\n")
    clean = [re.sub(r"[0-9_]|\*\*", "", x).strip() for x in lines]
    for first, end in reversed(repeated_slices(lines)):
        if part := _stretch(lines, clean, first, end):
            text = text.replace(part, f"\n\n{MISSING}\n\n")
    return re.sub(r"## References\n+\[MISSING_PAGE_POST(:\d+)?\]", lambda m: f"\n\n[MISSING_PAGE_POST{m.group(1) or ''}]", text)


# Fixed value: a list item that holds further items on its line.
_ITEMS = re.compile(r"^([-*])(?![-*]) ?(?:(?:\d|[ixv])+ )?[^\n]+? ([-*]) (?:(?:(?:\d|[ixv])+)\.(?:\d|[ixv]) )?[^\n]*$", re.I | re.M)
_NUMERAL = re.compile(r"[\dixv]+(?:\.[\dixv]?)*\Z", re.I)


def items_apart(text: str) -> str:
    """Items that stand on one line get a line each, indented by the depth of their numbering."""

    def apart(m: re.Match) -> str:
        mark = m.group(2) + " "
        out = []
        for i, item in enumerate(m.group().split(mark)[1:]):
            number, _, rest = item.strip().partition(" ")
            if rest:
                level = number.count(".") if _NUMERAL.match(number) else 0
                out.append(("\n" if i else "") + "\t" * level + (mark if i or m.start() == 0 else m.group(1) + " ") + item.strip())
        return "".join(out)

    return _ITEMS.sub(apart, text)


def _sequential(step):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [step(t) if t else t for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["id", "text"])

    return run


def clean_pages(df: DataFrame, key: str, text: str) -> DataFrame:
    """Native rewrites around the steps that read a page in order. Null stays null, empty text empty."""
    kept = lambda c: F.when(F.col("text") != "", c).otherwise(F.col("text"))
    rows = df.select(F.col(key).cast("string").alias("id"), rewritten(F.col(text), BEFORE).alias("text"))
    rows = rows.mapInArrow(_sequential(lambda t: without_made_up_references(cut_repeating_tail(t) or "")), "id string, text string")
    rows = rows.withColumn("text", rewritten(F.col("text"), MIDDLE)).mapInArrow(_sequential(items_apart), "id string, text string")
    return rows.withColumn("text", kept(T.markdown_compatible(rewritten(without_wrong_tables(spaced_ends(F.col("text"))), AFTER))))
