"""Markup residue in text (p1): HTML, Markdown, MediaWiki and LaTeX to plain structured text.

``find_markup`` names the families a text carries; ``clean_markup`` rewrites them. Structure stays:
headings become lines of ``#`` marks, list items lines of ``- ``, code a block between ``` fences,
formulas text between ``$`` (``$$`` for displayed ones), table rows lines of ``|`` cells. The
project's own [START_...]/[END_...] tags and pipe grids pass through unchanged.

The families are read in one fixed order (comments and code first), so that code and formulas are
not read as markup of another family. Null text gives null and no family, empty text itself;
repeated rows are treated each; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.tables import columns_or_null, table

FAMILIES = ("html", "markdown", "wiki", "latex")

# Element names of HTML and MathML that may be left over in text.
TAGS = (
    "a abbr address article aside b big blockquote body br button caption center cite code col colgroup dd del details dfn div dl dt em "
    "figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main map mark math "
    "menu meta mfrac mi mn mo mrow msqrt msub msubsup msup mtable mtd mtext mtr nav noscript ol option p pre q s samp script section select "
    "small source span strike strong style sub summary sup svg table tbody td textarea tfoot th thead time title tr tt u ul var video wbr"
)
# Signs named by LaTeX commands, besides the Greek letters.
SYMBOLS = {
    "times": "×", "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "pm": "±", "mp": "∓", "cdot": "·", "ldots": "…", "dots": "…", "infty": "∞", "partial": "∂", "nabla": "∇",
    "neq": "≠", "approx": "≈", "sim": "∼", "propto": "∝", "equiv": "≡", "to": "→", "rightarrow": "→", "leftarrow": "←", "in": "∈", "sum": "∑", "prod": "∏", "int": "∫", "circ": "∘",
    "degree": "°", "ell": "ℓ", "hbar": "ℏ", "forall": "∀", "exists": "∃", "cup": "∪", "cap": "∩", "subset": "⊂", "textbackslash": "\\", "S": "§", "P": "¶", "ss": "ß", "o": "ø", "ae": "æ",
}
# Commands that set type or space and stand for no text.
LAYOUT = frozenset(
    "centering raggedright raggedleft noindent indent newline linebreak pagebreak newpage clearpage par quad qquad hfill vfill smallskip medskip bigskip hline toprule midrule "
    "bottomrule tiny scriptsize footnotesize small normalsize large Large LARGE huge Huge bf it em tt sc rm sl bfseries itshape ttfamily scshape rmfamily upshape mdseries nonumber "
    "maketitle tableofcontents protect relax displaystyle textstyle limits nolimits left right".split()
)


def _greek(name: str) -> str | None:
    """The Greek letter a command names, var forms too; a capital if its name begins with one."""
    plain = name.removeprefix("var")
    spelt = {"lambda": "lamda"}.get(plain.lower(), plain.lower())
    try:
        return unicodedata.lookup(f"GREEK {'CAPITAL' if plain[:1].isupper() else 'SMALL'} LETTER {spelt.upper()}")
    except KeyError:
        return None


_TAG = re.compile(rf"</?(?:{'|'.join(TAGS.split())})(?:\s[^<>]*)?/?>", re.I)
_COMMENT = re.compile(r"<!--.*?-->|<!DOCTYPE[^>]*>|<!\[CDATA\[|\]\]>", re.S | re.I)
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_OWN = re.compile(r"\[(?:START|END)_[A-Z]+\]")
_PATH = re.compile(r"\b[A-Za-z]:\\[\w\\.\-]+|(?<!\\)\\\\\w+\\[\w\\.\-]+")
_FENCE = re.compile(r"^[ \t]*(```|~~~)[^\n`]*\n(.*?)(?:^[ \t]*\1[ \t]*$|\Z)", re.S | re.M)
_GRID = re.compile(r"^\|[\-:| ]+\|[ \t]*$", re.M)

_MATH = re.compile(
    r"\\\[(?P<a>.+?)\\\]|\\\((?P<b>.+?)\\\)|\$\$(?P<c>[^$]+?)\$\$|(?<![\\\w$])\$(?P<d>(?=[^\s$])[^$\n]*?(?<=[^\s\\]))\$(?![\d$])"
    r"|\\begin\{(?P<env>equation|align|gather|displaymath|math|eqnarray|multline)(?P<star>\*?)\}(?P<e>.*?)\\end\{(?P=env)(?P=star)\}",
    re.S,
)
_COMMAND = re.compile(r"\\(?:[A-Za-z]{2,}\*?|[A-Za-z](?=\{)|[,;%&#_{}$])")

_MARKDOWN = [
    re.compile(p, re.M)
    for p in (
        r"^[ \t]*```|^[ \t]*~~~[ \t]*\w*$",
        r"(?<![\w*\\])\*{1,3}(?=[^\s*])[^*\n]+?(?<=[^\s*])\*{1,3}(?![\w*])",
        r"(?<![\w_\\])__(?=[^\s_])(?![A-Z]{3,}__)[^\n]+?(?<=[^\s_])__(?![\w])",
        r"(?<![\w_\\{^])_(?=[^\s_])[^_\n]+?(?<=[^\s_])_(?!\w)",
        r"~~(?=[^\s~])[^~\n]+?(?<=[^\s~])~~",
        r"`[^`\n]+`",
        r"^[ \t]{0,3}#{1,6}[ \t]+\S",
        r"^[ \t]{0,3}(?![|>\-=])\S[^\n]*\n[ \t]{0,3}(?:-{3,}|={3,})[ \t]*$",
        r"^[ \t]{0,3}>[ \t]?\S",
        r"^[ \t]*(?:[-*+]|\d+[.)])[ \t]+\[[ xX]\][ \t]",
        r"\[[^\]\n]*\]\([^()\s]*(?:\([^()\s]*\)[^()\s]*)*(?:[ \t]+\"[^\"\n]*\")?\)",
        r"(?<!\])\[(?!START_|END_)[^\[\]\n]*[^\W\d_][^\[\]\n]*\]\[(?!START_|END_)[^\[\]\n]*[^\W\d_][^\[\]\n]*\]",
        r"\[\^[^\]\s]+\]",
    )
]
_WIKI = [
    re.compile(p, re.M)
    for p in (
        r"'''?(?=[^'\s])[^\n]*?(?<=[^'\s])'''?",
        r"^[ \t]*(={2,6})[ \t]*[^=\n]+?[ \t]*\1[ \t]*$",
        r"\[\[[^\[\]\n]+\]\]",
        r"\{\{[^{}\n]+\}\}",
        r"^[ \t]*\{\||^[ \t]*\|\}",
        r"__[A-Z]{3,}__",
        r"\[(?:https?|ftp)://[^\s\]]+(?:[ \t][^\]\n]*)?\]",
        r"#REDIRECT\b",
        r"^;[ \t]*\S[^\n]*\n:",
        r"</?(?:ref|nowiki|gallery|references)\b[^<>]*>",
    )
]


def find_markup(text: str | None) -> list[str]:
    """The families of which the text carries at least one piece, in the order of FAMILIES."""
    if not text:
        return []
    found = []
    body = _OWN.sub(" ", text)
    if _COMMENT.search(body) or _TAG.search(body) or any(html.unescape(m.group()) != m.group() for m in _ENTITY.finditer(body)):
        found.append("html")
    body = _PATH.sub(" ", body)
    math = bool(_MATH.search(body))
    latex = math or bool(_COMMAND.search(body))
    prose = _MATH.sub(" ", body) if math else body
    prose = _GRID.sub("", prose)
    markdown = any(p.search(_quiet(prose)) for p in _MARKDOWN)
    fenceless = _FENCE.sub(" ", prose)
    if markdown:
        found.append("markdown")
    if any(p.search(fenceless) for p in _WIKI):
        found.append("wiki")
    if latex:
        found.append("latex")
    return found


_TEX_CODE = re.compile(r"\\begin\{(lstlisting|verbatim)\}.*?\\end\{\1\}|\\verb(\W).*?\2", re.S)
_WIKI_LINK = re.compile(r"\[\[[^\[\]\n]+\]\]|\{\{[^{}\n]+\}\}|\[(?:https?|ftp)://[^\]\n]*\]|https?://\S+")
_HTML_CODE = re.compile(r"<pre\b.*?</pre>|<code\b.*?</code>|<[a-z][^<>]*>", re.S | re.I)


def _quiet(text: str) -> str:
    """Text without pieces of other families in which Markdown marks may stand: links, templates, code, attributes."""
    if "\\" in text:
        text = _TEX_CODE.sub(" ", text)
    if "<" in text:
        text = _HTML_CODE.sub(" ", text)
    if "[[" in text or "{{" in text or "[http" in text:
        text = _WIKI_LINK.sub(" ", text)
    return text


class _Store:
    """Keeps finished pieces (code, formulas) out of reach of later rules."""

    def __init__(self):
        self.kept: list[str] = []

    def put(self, piece: str) -> str:
        self.kept.append(piece)
        return f"\ue000{len(self.kept) - 1}\ue001"

    def restore(self, text: str) -> str:
        while "\ue000" in text:
            text = re.sub("\ue000(\\d+)\ue001", lambda m: self.kept[int(m.group(1))], text)
        return text


def _code(store: _Store, body: str) -> str:
    return "\n" + store.put("```\n" + body.strip("\n") + "\n```") + "\n"


def _from_html(text: str, store: _Store) -> str:
    text = re.sub(r"<(script|style)\b.*?</\1\s*>", " ", text, flags=re.S | re.I)
    text = re.sub(r"<!--.*?-->|<!DOCTYPE[^>]*>|<!\[CDATA\[|\]\]>", "", text, flags=re.S | re.I)
    text = re.sub(
        r"<pre\b[^>]*>\s*(?:<code\b[^>]*>)?(.*?)(?:</code>\s*)?</pre>",
        lambda m: _code(store, html.unescape(_TAG.sub("", m.group(1)))),
        text,
        flags=re.S | re.I,
    )
    text = re.sub(r"<math\b[^>]*>(.*?)</math>", lambda m: store.put("$" + html.unescape(re.sub(r"<[^>]+>", "", m.group(1))).strip() + "$"), text, flags=re.S | re.I)
    while "&" in text:  # written over and over, entities are read until none is left
        new = _ENTITY.sub(lambda m: html.unescape(m.group()), text)
        if new == text:
            break
        text = new
    text = text.replace("\u00ad", "").replace("\u00a0", " ")
    text = re.sub(r"<h([1-6])\b[^>]*>\s*", lambda m: "\n" + "#" * int(m.group(1)) + " ", text, flags=re.I)
    text = re.sub(r"\s*<li\b[^>]*>\s*", "\n- ", text, flags=re.I)
    text = re.sub(r"\s*<(?:td|th)\b[^>]*>\s*", "|", text, flags=re.I)
    text = re.sub(r"\s*<tr\b[^>]*>\s*", "\n", text, flags=re.I)
    text = re.sub(r"</(?:td|th)\s*>", "", text, flags=re.I)
    text = re.sub(r"<img\b[^<>]*?\balt=(?:\"([^\"]*)\"|'([^']*)')[^<>]*>", lambda m: m.group(1) or m.group(2) or "", text, flags=re.I)
    text = re.sub(r"<(?:br|hr)\b[^<>]*>|</(?:h[1-6]|p|div|ul|ol|table|tr|li|blockquote)\s*>|<(?:p|div|ul|ol|table|blockquote)\b[^<>]*>", "\n", text, flags=re.I)
    return _TAG.sub("", text)


def _cite(m: re.Match) -> str:
    """A template's readable part: a title or the unnamed values of a conversion; else its name."""
    name, *values = m.group(1).split("|")
    named = dict(v.split("=", 1) for v in values if "=" in v)
    if "title" in named:
        return named["title"].strip()
    plain = [v.strip() for v in values if "=" not in v]
    return " ".join(plain) or name.strip()


def _link(m: re.Match) -> str:
    target, *rest = m.group(1).split("|")
    if re.match(r"\s*(?:category|kategorie|catégorie)\s*:", target, re.I):
        return ""
    if re.match(r"\s*(?:file|image|datei)\s*:", target, re.I):
        return rest[-1].strip() if rest else ""
    return (rest[-1] if rest else target).strip()


def _from_wiki(text: str) -> str:
    text = re.sub(r"<ref\b[^<>]*/>|<ref\b[^<>]*>.*?</ref>", "", text, flags=re.S | re.I)
    text = re.sub(r"</?(?:nowiki|gallery|references)\b[^<>]*>", "", text, flags=re.I)
    text = re.sub(r"#REDIRECT[ \t]*(?=\[\[)", "", text, flags=re.I)
    text = re.sub(r"__[A-Z]{3,}__[ \t]?", "", text)
    text = re.sub(r"\{\{([^{}\n]+)\}\}", _cite, text)
    text = re.sub(r"\[\[([^\[\]\n]+)\]\]", _link, text)
    text = re.sub(r"\[(?:https?|ftp)://[^\s\]]+[ \t]+([^\]\n]*)\]", r"\1", text)
    text = re.sub(r"\[((?:https?|ftp)://[^\s\]]+)\]", r"\1", text)
    text = re.sub(r"^[ \t]*\{\|(.*?)^[ \t]*\|\}", _wiki_table, text, flags=re.S | re.M)
    text = re.sub(r"^[ \t]*(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$", lambda m: "#" * len(m.group(1)) + " " + m.group(2), text, flags=re.M)
    text = re.sub(r"^;[ \t]*([^\n]+)\n:[ \t]*", r"- \1: ", text, flags=re.M)
    text = re.sub(r"^[*#]+[ \t]+(?='')", "- ", text, flags=re.M)
    return re.sub(r"'''?(?=[^'\s])([^\n]*?[^'\s])'''?", r"\1", text)


def _wiki_table(m: re.Match) -> str:
    rows: list[list[str]] = [[]]
    for line in m.group(1).split("\n")[1:]:
        line = line.strip()
        if line.startswith("|-"):
            rows.append([])
        elif line[:1] in "|!" and line:
            rows[-1] += [c.strip() for c in re.split(r"\|\||!!", line[1:])]
    return "\n".join("|" + "|".join(r) + "|" for r in rows if r)


def _from_latex(text: str, store: _Store) -> str:
    def formula(m: re.Match) -> str:
        inner = next(m.group(k) for k in "abcde" if m.group(k) is not None)
        inner = re.sub(r"\\label\{[^}]*\}|\\nonumber", "", inner).strip()
        mark = "$" if m.group("b") or m.group("d") else "$$"
        return store.put(mark + inner + mark)

    text = re.sub(r"\\begin\{(lstlisting|verbatim)\}(?:\[[^\]]*\])?(.*?)\\end\{\1\}", lambda m: _code(store, m.group(2)), text, flags=re.S)
    text = re.sub(r"\\verb(\W)(.*?)\1", lambda m: store.put(m.group(2)), text)
    text = _MATH.sub(formula, text)
    if "\\" not in text:
        return text
    kept = _PATH.findall(text)
    text = _PATH.sub(lambda m: store.put(m.group()), text) if kept else text
    depth = {"part": 1, "chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4}
    text = re.sub(r"\\(part|chapter|section|subsection|subsubsection|paragraph)\*?\{([^{}]*)\}", lambda m: "\n" + "#" * depth[m.group(1)] + " " + m.group(2) + "\n", text)
    text = re.sub(r"\s*\\item\b[ \t]*(?:\[([^\]]*)\])?", lambda m: "\n- " + (m.group(1) + ": " if m.group(1) else ""), text)
    text = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]]*\])?", "\n", text)
    text = re.sub(r"~?\\(?:label|cite[a-z]*|vspace|hspace|includegraphics)\*?(?:\[[^\]]*\])?\{[^{}]*\}", "", text)
    text = re.sub(r"~?\\(?:eq|auto|page)?ref\{(?:[a-z]+:)?([^{}]*)\}", r" \1", text)
    text = re.sub(r"\\footnote\{([^{}]*)\}", r" (\1)", text)
    text = re.sub(r"\{\\(?:it|bf|em|tt|sc|rm|sl)\b[ \t]*([^{}]*)\}", r"\1", text)
    while True:  # nested arguments from the inside out
        new = re.sub(r"\\[A-Za-z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}", r"\1", text)
        if new == text:
            break
        text = new
    text = re.sub(r"\\([A-Za-z]+)\b", lambda m: "" if m.group(1) in LAYOUT else SYMBOLS.get(m.group(1)) or _greek(m.group(1)) or m.group(), text)
    text = re.sub(r"\\[,;]", " ", text)
    return re.sub(r"\\([%&#_{}$])", r"\1", text)


def _from_markdown(text: str, store: _Store) -> str:
    text = _FENCE.sub(lambda m: _code(store, m.group(2)), text)
    text = re.sub(r"`([^`\n]+)`", lambda m: store.put(m.group(1)), text)
    text = re.sub(r"^[ \t]{0,3}(?![|>\-=#])(\S[^\n]*)\n[ \t]{0,3}(-{3,}|={3,})[ \t]*$", lambda m: ("# " if m.group(2)[0] == "=" else "## ") + m.group(1), text, flags=re.M)
    text = re.sub(r"^[ \t]{0,3}>[ \t]?", "", text, flags=re.M)
    text = re.sub(r"^([ \t]*)(?:[-*+]|\d+[.)])[ \t]+\[[ xX]\][ \t]+", r"\1- ", text, flags=re.M)
    text = re.sub(r"!?\[([^\]\n]*)\]\([^()\s]*(?:\([^()\s]*\)[^()\s]*)*(?:[ \t]+\"[^\"\n]*\")?\)", r"\1", text)
    text = re.sub(r"(?<!\])\[(?!START_|END_)([^\[\]\n]*[^\W\d_][^\[\]\n]*)\]\[(?!START_|END_)[^\[\]\n]*[^\W\d_][^\[\]\n]*\]", r"\1", text)
    text = re.sub(r"\[\^[^\]\s]+\]", "", text)
    text = re.sub(r"(?<![\w*\\])(\*{1,3})(?=[^\s*])([^*\n]+?)(?<=[^\s*])\1(?![\w*])", r"\2", text)
    text = re.sub(r"(?<![\w_\\])__(?=[^\s_])(?![A-Z]{3,}__)([^\n]+?)(?<=[^\s_])__(?!\w)", r"\1", text)
    text = re.sub(r"(?<![\w_\\{^])_(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?!\w)", r"\1", text)
    return re.sub(r"~~(?=[^\s~])([^~\n]+?)~~", r"\1", text)


def clean_markup(text: str | None) -> str | None:
    """The text with every family rewritten; text without markup comes back unchanged."""
    families = find_markup(text)
    if not families or text is None:
        return text
    parts = re.split(r"(\[(?:START|END)_[A-Z]+\])", text)
    return "".join(part if k % 2 else _clean_part(part, families) for k, part in enumerate(parts))


def _clean_part(text: str, families: list[str]) -> str:
    """A stretch of text between the project's own tags, so that line starts and ends are those of the markup."""
    if not text.strip():
        return text
    store = _Store()
    text = text.replace("\ue000", "").replace("\ue001", "")
    if "markdown" in families:
        text = _FENCE.sub(lambda m: _code(store, m.group(2)), text)
    if "latex" in families:
        text = _from_latex(text, store)
    if "html" in families:
        text = _from_html(text, store)
    if "wiki" in families:
        text = _from_wiki(text)
    if "markdown" in families:
        text = _from_markdown(text, store)
    text = re.sub(r"[ \t]{2,}", " ", text)
    text = re.sub(r"[ \t]+\n", "\n", text)
    return store.restore(re.sub(r"\n{3,}", "\n\n", text))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        columns = [batch.column(0), pa.array([find_markup(t) for t in texts], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["element_id", "families"])


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        columns = [batch.column(0), pa.array([find_markup(t) for t in texts], pa.list_(pa.string())), pa.array([clean_markup(t) for t in texts], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["element_id", "families", "clean_text"])


def markup_families(elements: DataFrame) -> DataFrame:
    """element_id and its families (empty for none); one narrow pass."""
    df = columns_or_null(elements, {"element_id": "long", "text": "string"})
    return df.mapInArrow(_scan, "element_id long, families array<string>")


def clean_elements(elements: DataFrame) -> DataFrame:
    """element_id, families and the cleaned text; one narrow pass."""
    df = columns_or_null(elements, {"element_id": "long", "text": "string"})
    return df.mapInArrow(_clean, "element_id long, families array<string>, clean_text string")


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    found = markup_families(table(spark, root, "grobid_elements"))
    return found.select("element_id", F.explode("families").alias("markup")).distinct()


def p1_clean_text(spark: SparkSession, root: str) -> DataFrame:
    return clean_elements(table(spark, root, "grobid_elements")).select("element_id", "clean_text")


QUERIES = {"p1_found": p1_found, "p1_clean_text": p1_clean_text}
SQL: dict[str, str] = {}
