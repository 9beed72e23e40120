"""HTML pages of papers to Markdown, read with the standard HTML parser.

Each element has one kind, the first of KINDS that its name and classes fit, and each kind one way to be written.
Sections, emphasis, formulas (from their alternative text), lists, definitions, listings, tables (as LaTeX), figures,
footnotes (after their paragraph), citations and the list of references are kept. A page without an article, or with a
citation that leads nowhere, gives null.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

# The kind of an element by its names and classes (any of them; none: any), in order of precedence.
KINDS: tuple[tuple[str, str, str], ...] = (
    ("nothing", "script style head nav", ""), ("nothing", "", "ltx_author_before ltx_role_pubyear ltx_role_pagerange ltx_ERROR"),
    ("paragraph", "p", ""), ("paragraph", "", "ltx_p"), ("paragraph", "div span", "ltx_para"), ("paragraph", "section", "ltx_paragraph"),
    ("tag", "", "ltx_tag"), ("note", "", "ltx_note_outer"), ("note_mark", "", "ltx_note_mark"), ("sup", "sup", ""), ("sub", "sub", ""), ("math", "math", ""),
    ("missing", "", "ltx_missing_citation ltx_missing_label"), ("line", "", "ltx_bibblock ltx_role_author ltx_contact ltx_role_email ltx_role_affiliation"),
    ("paragraph", "", "ltx_authors ltx_personname ltx_date ltx_engrafo_author_notes ltx_author_notes"), ("title", "h1", "ltx_title_document"),
    ("clause", "h1 h2 h3 h4 h5 h6", "ltx_title_theorem ltx_title_proof"), ("heading", "h1 h2 h3 h4 h5 h6", ""), ("contents", "", "ltx_toc_toc"),
    ("references", "ul", "ltx_biblist"), ("list", "ul ol", ""), ("cite", "cite", ""), ("link", "a", ""), ("equations", "", "ltx_eqn_table ltx_equation ltx_equationgroup"),
    ("tabular", "table", ""), ("tabular", "span div", "ltx_tabular"), ("italic", "i em", ""), ("italic", "", "ltx_font_italic"), ("bold", "b strong", ""), ("bold", "", "ltx_font_bold"),
    ("table", "figure", "ltx_table"), ("inside", "figure", "ltx_float"), ("figure", "figure", ""), ("listing", "", "ltx_listing"), ("definitions", "dl", ""),
    ("caption", "figcaption", ""), ("break", "br", ""), ("break", "", "ltx_break"),
)
_RULES = [(kind, frozenset(tags.split()), frozenset(classes.split())) for kind, tags, classes in KINDS]
SUPERSCRIPTS, SUBSCRIPTS = str.maketrans("0123456789", "⁰¹²³⁴⁵⁶⁷⁸⁹"), str.maketrans("0123456789", "₀₁₂₃₄₅₆₇₈₉")


class Node:
    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def text(self) -> str:
        return re.sub(r"\s+", " ", "".join(c if isinstance(c, str) else c.text() for c in self.children))

    def find(self, tag: str) -> list[Node]:
        out = []
        for c in self.children:
            if isinstance(c, Node):
                out += ([c] if c.tag == tag else []) + c.find(tag)
        return out

    def walk(self) -> Iterator[Node]:
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("root", {})
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].children.append(node)
        if tag not in _VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.stack[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


class DeadReference(ValueError):
    """A citation that has no number and leads to none."""


def kind_of(node: Node) -> str:
    own = set(node.classes)
    return next((kind for kind, tags, classes in _RULES if (not tags or node.tag in tags) and (not classes or classes & own)), "inside")


def _wrapped(text: str, mark: str) -> str:
    """Emphasis around the text itself, outside the blanks at its ends."""
    inner = text.strip()
    lead, tail = text[: len(text) - len(text.lstrip())], text[len(text.rstrip()) :]
    return f"{lead}{mark}{' '.join(inner.split())}{mark}{tail}" if inner else text


def _number(node: Node) -> str | None:
    """The number of a citation: its text, or else that of its target."""
    text = node.text().strip()
    return text if text.isnumeric() else re.sub(r"\D", "", node.attrs.get("href", "").partition(".bib")[2]) or None


class Writer:
    """Writes one page; holds what moves: footnotes to the end of their paragraph, the depth of lists, figures."""

    def __init__(self):
        self.notes: list[str] = []
        self.level = 0
        self.figures: dict[str, str] = {}

    def inside(self, node: Node) -> str:
        return "".join(self.text(c) if isinstance(c, str) else self.write(c) for c in node.children)

    def write(self, node: Node) -> str:
        return getattr(self, kind_of(node))(node)

    @staticmethod
    def text(c: str) -> str:
        c = re.sub(r"^\n+|\n+$", "\n", c) if c.strip() else c.strip("\n")
        return re.sub(r"[ \t]+", " ", c)

    def nothing(self, node: Node) -> str:
        return ""

    def paragraph(self, node: Node) -> str:
        held, self.notes = self.notes, []
        out = self.inside(node) + "\n\n" + "".join(self.notes)
        self.notes = held
        return out

    def tag(self, node: Node) -> str:
        own = set(node.classes)
        if "ltx_tag_note" in own or "ltx_tag_subsection" in own:
            return ""
        return self.inside(node).upper() if "ltx_tag_section" in own else self.inside(node)

    def note(self, node: Node) -> str:
        mark = next((x.text().strip() for x in node.walk() if "ltx_note_mark" in x.classes), "")
        self.notes.append(f"\n[FOOTNOTE:{mark}]Footnote {mark}: {self.inside(node).strip()}[ENDFOOTNOTE]\n\n")
        return ""

    def note_mark(self, node: Node) -> str:
        return ""

    def sup(self, node: Node) -> str:
        text = node.text()
        return text.translate(SUPERSCRIPTS) if text.strip().isdigit() else self.inside(node)

    def sub(self, node: Node) -> str:
        text = node.text()
        return text.translate(SUBSCRIPTS) if text.strip().isdigit() else self.inside(node)

    def math(self, node: Node) -> str:
        tex = re.sub(r"\s+", " ", node.attrs.get("alttext", node.text())).strip()
        return f"\\({tex}\\)" if node.attrs.get("display", "inline") == "inline" else f"\n\n\\[{tex}\\]\n\n"

    def missing(self, node: Node) -> str:
        if (number := _number(node)) is None:
            raise DeadReference(node.text())
        return number

    def line(self, node: Node) -> str:
        return self.inside(node) + "\n"

    def title(self, node: Node) -> str:
        return f"\n\n# {' '.join(self.inside(node).split())}\n\n"

    def heading(self, node: Node) -> str:
        return f"\n\n{'#' * int(node.tag[1])} {' '.join(self.inside(node).split())}\n\n"

    def clause(self, node: Node) -> str:
        return self.inside(node) + ": "

    def contents(self, node: Node) -> str:
        return "\n\n###### Contents\n\n" + self.inside(node) + "\n\n"

    def _items(self, node: Node) -> list[str]:
        self.level += 1
        items = [" ".join(self.inside(x).split()) if not x.find("li") else re.sub(r"\n+(?! *(?:\*|\d+\.) )", " ", self.inside(x).strip()).rstrip() for x in node.children if isinstance(x, Node) and x.tag == "li"]
        self.level -= 1
        return items

    def list(self, node: Node) -> str:
        items = self._items(node)
        return "\n" + "".join(f"{'  ' * self.level}{f'{i}.' if node.tag == 'ol' else '*'} {x}\n" for i, x in enumerate(items, 1)) + "\n"

    def references(self, node: Node) -> str:
        return "\n" + "".join(f"* {x}\n" for x in self._items(node)) + "\n"

    def cite(self, node: Node) -> str:
        """H4: brackets around a citation that has neither brackets nor letters of its own."""
        text = self.inside(node)
        return text if "[" in text and "]" in text or re.search("[A-Za-z]", text) else f"[{text}]"

    def link(self, node: Node) -> str:
        if not node.attrs.get("href", "").startswith("#bib"):
            return self.inside(node)
        text = node.text().strip()
        if not text.isnumeric() and not re.search(r"[A-Za-z][:;.,_]?\d", text):
            raise DeadReference(text)
        return _number(node) or ""

    def equations(self, node: Node) -> str:
        rows = [x for x in node.walk() if "ltx_eqn_row" in x.classes] or [node]
        out = []
        for row in rows:
            parts = [p for c in row.children for p in [" ".join((self.text(c) if isinstance(c, str) else self.inside(c) if c.tag in ("td", "th") else self.write(c)).split())] if p]
            # the formulas of a row are shown as one
            out.append(re.sub(r"\\([\])]) \\([\[(])", " ", " ".join(parts)).replace("\\(", "\\[").replace("\\)", "\\]"))
        return "\n" + "".join(x + "\n" for x in out if x) + "\n"

    def tabular(self, node: Node) -> str:
        return latex_tabular(node, self)

    def italic(self, node: Node) -> str:
        return _wrapped(self.inside(node), "_")

    def bold(self, node: Node) -> str:
        return _wrapped(self.inside(node), "**")

    def table(self, node: Node) -> str:
        return self._float(node, "TABLE", "\\begin{table}\n", "\\end{table}\n")

    def figure(self, node: Node) -> str:
        return self._float(node, "FIGURE", "", "")

    def _float(self, node: Node, name: str, begin: str, end: str) -> str:
        key = node.attrs.get("id") or f"F{len(self.figures) + 1}"
        caption = "".join(" ".join(self.inside(x).split()) for x in node.children if isinstance(x, Node) and x.tag == "figcaption")
        rest = "".join(self.write(x) for x in node.children if isinstance(x, Node) and x.tag != "figcaption") if begin else ""
        text = f"[{name}:{key}]\n{begin}{rest.strip()}{chr(10) if rest.strip() else ''}{end}{caption}\n[END{name}]\n\n"
        self.figures[key] = text
        return "\n\n" + text

    def caption(self, node: Node) -> str:
        return self.inside(node) + "\n"

    def listing(self, node: Node) -> str:
        lines = [x for x in node.walk() if "ltx_listingline" in x.classes]
        rows = [x.text().strip("\n").rstrip() for x in lines] or [node.text().strip()]
        return "\n```\n" + "".join(x + "\n" for x in rows if x) + "```\n\n"

    def definitions(self, node: Node) -> str:
        out, term = [], ""
        for x in node.children:
            if isinstance(x, Node) and x.tag == "dt":
                term = self.inside(x).strip().rstrip(" :\n\t")
            elif isinstance(x, Node) and x.tag == "dd":
                out.append(": ".join(v for v in (term, " ".join(self.inside(x).split())) if v) + "\n")
                term = ""
        return "\n" + "\n".join(out) + "\n"

    def __getattr__(self, name: str) -> Callable[[Node], str]:
        if name == "break":  # a word of the language cannot name a method
            return lambda node: "\n\n"
        raise AttributeError(name)


def _span(cell: Node, name: str) -> int:
    value = cell.attrs.get(name, "1")
    return int(value) if value.isdigit() and 0 < int(value) < 100 else 1


def alignment(cell: Node) -> str:
    """The alignment that a cell's classes name first; a justified cell has its width."""
    for c in cell.classes:
        if c in ("ltx_align_center", "ltx_align_left", "ltx_align_right"):
            return c[10]
        if c == "ltx_align_justify":
            width = re.search(r"width:\s*([\d.]+\w+)", cell.attrs.get("style", ""))
            return f"p{{{width.group(1)}}}" if width else "l"
    return "l"


def borders(cell: Node, side: str) -> int:
    """Border lines of a cell at a side (t, b, l, r): as many as the letter is repeated in its border class."""
    return max((len(c[11:]) for c in cell.classes if c.startswith("ltx_border_") and set(c[11:]) == {side}), default=0)


def latex_tabular(table: Node, writer: Writer) -> str:
    """H6: a table as a LaTeX tabular. A column is aligned as most of its cells; lines stand where all cells of a row have them."""
    rows = [[c for c in r.children if isinstance(c, Node) and c.tag in ("td", "th")] for r in table.walk() if r.tag == "tr"]
    covered: Counter = Counter()
    columns: dict[int, Counter] = {}
    lines = []
    for r, row in enumerate(rows):
        at, cells = 0, []
        for cell in row:
            while covered[r, at]:
                cells.append("")
                at += 1
            down, across = _span(cell, "rowspan"), _span(cell, "colspan")
            columns.setdefault(at, Counter())[alignment(cell)] += 1
            text = " ".join(writer.inside(cell).split()).replace("&", "\\&").replace("%", "\\%")
            text = f"\\multirow{{{down}}}{{*}}{{{text}}}" if down > 1 else text
            cells.append(f"\\multicolumn{{{across}}}{{{alignment(cell)}}}{{{text}}}" if across > 1 else text)
            for i in range(1, down):
                for j in range(across):
                    covered[r + i, at + j] = 1
            at += across
        while covered[r, at]:
            cells.append("")
            at += 1
        rule = lambda side: "\\hline" * min((borders(c, side) for c in row), default=0)
        above, below = rule("t"), rule("b")
        lines.append((above + "\n" if above else "") + " & ".join(cells) + " \\\\" + (" " + below if below else ""))
        for j in range(at):
            columns.setdefault(j, Counter())
    spec = "".join(columns[j].most_common(1)[0][0] if columns[j] else "l" for j in sorted(columns))
    return f"\\begin{{tabular}}{{{spec}}}\n" + "\n".join(lines) + "\n\\end{tabular}\n"


def square(table: Node) -> list[list[str]]:
    """H6: rows of equal width; cells that span rows or columns stand in each place they cover."""
    grid: list[dict[int, str]] = []
    for r, row in enumerate(table.find("tr")):
        while len(grid) <= r:
            grid.append({})
        at = 0
        for cell in [c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")]:
            while at in grid[r]:
                at += 1
            down, across = _span(cell, "rowspan"), _span(cell, "colspan")
            for i in range(down):
                while len(grid) <= r + i:
                    grid.append({})
                for j in range(across):
                    grid[r + i].setdefault(at + j, cell.text().strip())
            at += across
    width = max((max(row, default=-1) + 1 for row in grid), default=0)
    return [[row.get(j, "") for j in range(width)] for row in grid]


def reference_fields(article: Node) -> list[dict[str, str]]:
    """The entries of the list of references: id and text."""
    return [{"id": x.attrs.get("id", ""), "title": " ".join(x.text().split())} for x in article.find("li") if "ltx_bibitem" in x.classes]


def plain_text(html: str | None) -> str | None:
    """H1: all text of a page but styles and scripts, its pieces with a blank between them."""
    if not html:
        return html
    tree = _Tree()
    tree.feed(html)
    tree.close()

    def pieces(node: Node) -> Iterator[str]:
        for c in node.children:
            if isinstance(c, str):
                yield c
            elif c.tag not in ("style", "script"):
                yield from pieces(c)

    return " ".join(pieces(tree.root))


def to_markdown(html: str | None) -> tuple[str, int, int] | None:
    """Markdown, number of figures and tables, and of references; null without an article or with a dead citation."""
    if not html:
        return None
    tree = _Tree()
    tree.feed(html)
    tree.close()
    article = next(iter(tree.root.find("article")), None)
    if article is None:
        return None
    writer = Writer()
    try:
        text = writer.inside(article) + "".join(writer.notes)
    except DeadReference:
        return None
    text = re.sub(r"[ \t]+\n", "\n", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip(), len(writer.figures), len(reference_fields(article))


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [to_markdown(t) for t in batch.column(1).to_pylist()]
        columns = [batch.column(0), pa.array([g and g[0] for g in got], pa.string()), *(pa.array([g and g[k] for g in got], pa.int64()) for k in (1, 2))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "markdown", "n_figures", "n_references"])


def pages_to_markdown(df: DataFrame, key: str, html: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("id"), F.col(html).cast("string")).mapInArrow(_run, "id string, markdown string, n_figures long, n_references long")
