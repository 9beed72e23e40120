"""Queries that put every document's words into literal pages (survey ids T5, M14, M16, D5, D6, X4, X17, X21, H3 to H6, H9, H12), with what must come out.

The given tables hold no Markdown pages, assembled documents or HTML of papers. So each document takes one of the literal pages
below by its id, and all its words stand in it where ``{T}`` is. What must come out is written down by hand, and SQL puts the words in there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators.body_steps import finished_documents
from millrace.operators.latexml import pages_to_markdown
from millrace.operators.pages import clean_pages
from millrace.sources.tables import table

Cases = list[tuple[str, str]]
LONG = "a heading of so many words that it can be no heading but is a sentence of the text that was set in large type by mistake"
PAGES: Cases = [
    (f"Text {{T}} end.\n# 1. {LONG}\nBody.", f"Text {{T}} end.\n{LONG}\nBody.\n\n"),
    ("Text {T} end\n* [leftmargin=*]\nmore 5.", "Text {T} end\nmore 5.\n\n"),
    ("Text {T} end\n# 3.1\nBody 5\n## Made up", "Text {T} end\n\nBody 5"),
    ("Text {T} end\n* [3] A.B.C.D.E.F.G.H.I.J.K. x\n* [4][] Smith 7", "Text {T} end\n\n* [4] Smith 7"),
    ("Text {T} where _x_ and _y__2_ are 9.", "Text {T} where \\(x\\) and \\(y_{2}\\) are 9.\n\n"),
    ("Text {T} end\nFootnote 1: footnotetext: the note 3\n\nnext [FOOTNOTE:2]in[ENDFOOTNOTE] 5", "Text {T} end\nFootnote 1: the note 3\n\nnext  5"),
    ("Text {T} end\n- first one - second one - 1.2 third one.", "Text {T} end\n- first one\n- second one\n\t- 1.2 third one.\n\n"),
    ("# Intro\nText {T} end.", "\n\n# Intro\nText {T} end.\n\n"),
    ("Text {T} end\nFigure 3: a plot 4", "Text {T} end\nFigure 3: a plot 4\n\n"),
    ("\\begin{table} \\begin{tabular}{l l} a & b \\\\ \\end{tabular} \\end{table} Table 1\nText {T} 5", "\n\n\\begin{table}\n\\begin{tabular}{l l} a & b \\\\ \\end{tabular}\n\\end{table}\nTable 1\nText {T} 5"),
    (f"Text {{T}} end\nx & y {'& ' * 401}\nkept 5", "Text {T} end\n\nkept 5"),
    (
        "Text {T} end\n(2.1a) \\[x = y\\]\n\\[x = y\\] (3) \\[z = w\\]\n\\[x = y\\] (3)\nthe $\\bm{x}$ and \\mbox{\\boldmath$y$} at ftp://a.bc.de/x-1. And\\. So 5",
        "Text {T} end\n\\[x = y \\tag{2.1a}\\]\n\\[x = y \\tag{3}\\] \\[z = w\\]\n\\[x = y \\tag{3}\\]\nthe $\\mathbf{x}$ and \\mathbf{y} at [ftp://a.bc.de/x-1](ftp://a.bc.de/x-1). And. So 5",
    ),
    ("Text {T} end\n#\nword 5\n.\nother word", "Text {T} end\n\nword 5\n\nother word "),
    ("Text {T} end 5\n\nb", "Text {T} end 5"),
    ("**S. A. B.**\n\n**S. A. B.**\nText {T} }", "\n\nText {T} }\n\n"),
]
MARKDOWN: Cases = [
    ("(1) \\[a\\]\n{T}", "\\[a \\tag{1}\\]\n{T}"),
    ("{T}\n\\[a\\] (1.2b)", "{T}\n\\[a \\tag{1.2b}\\]"),
    ("\\[a\\] (2) \\[b\\]\n{T}", "\\[a \\tag{2}\\] \\[b\\]\n{T}"),
    ("x (1) \\[a\\]\n\\[a\\] 1\n{T}", "x (1) \\[a\\]\n\\[a\\] 1\n{T}"),
    ("{T} \\bm{v} {\\\\bm v} a\\. b", "{T} \\mathbf{v} \\mathbf{v} a. b"),
    ("{T} \\mbox{ \\boldmath$v$} \\mbox{w}", "{T} \\mathbf{v} \\mbox{w}"),
    ("{T} https://a-b.cd/e?f=g. http://x", "{T} [https://a-b.cd/e?f=g](https://a-b.cd/e?f=g). http://x"),
    ("```python {T}   ``` and ```\n\nx```", "```\npython {T}\n``` and ```\nx\n```"),
]
_FRONT = "#Title\nOn {T}\n#Meta\nm\n##Figures\n\\begin{figure}\n\\caption{\n<p>\n<s>\ncoords=\"1,2,3\"\nThe plot {T}\n<\\s>\n<\\p>\n<head>H<\\head>\n<label>1<\\label>\n<target>fig_0<\\target>\n\\label{fig:1}}\n\\end{figure}\n"
_TABLES = "##Tables\n\\begin{table*}[h]\n\\caption{\nCap\n<target>tab_2<\\target>\n\\label{tbl:9}}\n\\end{table*}\n##Reference\n0.[0](<b0>A. One\n,J. {T})\n1.[1](<b1>B. Two)\n"
_FRONT_OUT = "\nOn {T}\n=============\n\n#Meta\nm\n##Figures\n\\begin{figure}\n\\caption{\nThe plot {T}\n}\n\\label{fig:0}\n\\end{figure}\n"
_TABLES_OUT = "##Tables\n\\begin{table*}[h]\n\\caption{\nCap\n}\n\\label{tbl:2}\n\\end{table*}\n##Reference\n0.[0](A. One,J. {T})\n1.[1](B. Two)\n"
DOCUMENTS: Cases = [
    (
        f"{_FRONT}{_TABLES}#Main Body\n[START_ABSTRACT]\nThe abstract\n[END_ABSTRACT]\n<p>\nFigure 3 stray caption\n</p>\n#1 Intro\n<p>\n"
        '<s coords="1,1">We cite <ref type="bibr" target="#b1">[1]</ref> and <ref type="bibr">[9]</ref>.</s>\n<s>We say {T} of it.</s>\n</p>',
        f"{_FRONT_OUT}{_TABLES_OUT}#Main Body\n[START_ABSTRACT]\nThe abstract\n[END_ABSTRACT]\n\n#1 Intro\nWe cite <START_REF>1<END_REF> and . We say {{T}} of it.",
    ),
    (
        f'{_FRONT}{_TABLES}#Main Body\n<p>\n<s>See Figure <ref type="figure" target="#fig_0">1</ref>, Table <ref type="table" target="#tab_2">2</ref>, <ref type="table">7</ref> {{T}}.</s>\n'
        '<s>By <ref type="formula" target="#f1">(1)</ref> and \\(x\\)[START_EQU_FLAG]<0>[END_EQU_FLAG] too.</s>\n</p>\n<formula coords="1" target="f1">\\(a = b\\)</formula>',
        f"{_FRONT_OUT}{_TABLES_OUT}#Main Body\nSee [Figure 1](fig:0), [Table 2](tbl:2), 7 {{T}}. By [(1)](eq:f1) and [START_EQU]\\(x\\)[START_EQU_FLAG]<0>[END_EQU_FLAG][END_EQU] too.\n"
        "\\begin{equation} a = b \\label{eq:f1} \\end{equation}",
    ),
    (
        "#Title\nNone\n#Meta\nm\n#Main Body\n<p>\n{T} one\n</p>\n<formula coords=\"2\">e = f (2.1)[START_EQU_FLAG]<1>[END_EQU_FLAG]</formula>\n<p>\n• two\n</p>\n"
        '<formula coords="2">g = h, (2.1)[START_EQU_FLAG]<1>[END_EQU_FLAG]</formula>\n<p>\n<formula coords="3">k = l[START_EQU_FLAG]<0>[END_EQU_FLAG]</formula>\n</p>\n<p>\n(3)\n</p>',
        "\n\n=============\n\n#Meta\nm\n#Main Body\n{T} one\n\\begin{equation} e = f [START_EQU_FLAG]<1>[END_EQU_FLAG] \\label{eq:2.1} \\end{equation}\n two\n"
        "\\begin{equation} g = h, [START_EQU_FLAG]<1>[END_EQU_FLAG] \\label{eq:2.1a} \\end{equation}\n\\begin{equation} k = l[START_EQU_FLAG]<0>[END_EQU_FLAG] \\label{eq:3} \\end{equation}",
    ),
    ("no body {T}", "no body {T}"),
]
OPTIONS: Cases = [
    (f"{_FRONT}{_TABLES}#Main Body\n<p>\n{{T}}\n</p>", f"{_FRONT_OUT}##Tables\n##Reference\n[1]A. One,J. {{T}}\n[2]B. Two\n#Main Body\n{{T}}"),
]
_PARA = '<article class="ltx_document"><p class="ltx_p">{T} '
HTML: Cases = [
    (
        '<html><head><title>x</title></head><body><nav>menu</nav><article><h1 class="ltx_title ltx_title_document">On {T}</h1><div class="ltx_abstract"><h6 class="ltx_title">Abstract</h6>'
        '<p class="ltx_p">We study {T}.</p></div><section class="ltx_section"><h2 class="ltx_title ltx_title_section"><span class="ltx_tag ltx_tag_section">i </span>Intro</h2><p>x</p></section></article></body></html>',
        "# On {T}\n\n###### Abstract\n\nWe study {T}.\n\n## I Intro\n\nx",
    ),
    (
        f'{_PARA}<span class="ltx_text ltx_font_bold">bold</span> and <em class="ltx_emph ltx_font_italic">soft</em> H<sub>2</sub>O, 10<sup>3</sup>, <math alttext="a  = b" display="inline">a</math></p>'
        '<math alttext="c" display="block">c</math></article>',
        "{T} **bold** and _soft_ H₂O, 10³, \\(a = b\\)\n\n\\[c\\]",
    ),
    (
        f'{_PARA}a<span class="ltx_note"><sup class="ltx_note_mark">1</sup><span class="ltx_note_outer"><span class="ltx_note_content"><sup class="ltx_note_mark">1</sup><span class="ltx_tag ltx_tag_note">1</span>'
        "A note.</span></span></span> b.</p><p>next</p></article>",
        "{T} a b.\n\n[FOOTNOTE:1]Footnote 1: A note.[ENDFOOTNOTE]\n\nnext",
    ),
    (
        f'{_PARA}<cite><a href="#bib.bib3" class="ltx_ref">3</a></cite>, <cite>[<a href="#bib.bib4" class="ltx_ref">Ab4</a>]</cite>, <a class="ltx_ref" href="#S1">Section 1</a>, '
        '<a class="ltx_ref ltx_missing_citation" href="#bib.bib7">key</a><span class="ltx_ERROR">undefined</span>.</p></article>',
        "{T} [3], [4], Section 1, 7.",
    ),
    (
        f'{_PARA}:</p><table class="ltx_equation ltx_eqn_table"><tbody><tr class="ltx_eqn_row"><td class="ltx_eqn_cell"><math alttext="x" display="block"></math></td><td class="ltx_eqn_cell">'
        '<math alttext="=y" display="block"></math></td><td class="ltx_eqn_cell">(1)</td></tr></tbody></table></article>',
        "{T} :\n\n\\[x =y\\] (1)",
    ),
    (
        '<article><ul class="ltx_itemize"><li class="ltx_item"><p>one {T}</p></li><li class="ltx_item"><p>two</p><ol class="ltx_enumerate"><li>inner</li></ol></li></ul>'
        '<dl class="ltx_description"><dt class="ltx_item">Term:</dt><dd class="ltx_item"><p>meaning</p></dd></dl><div class="ltx_listing"><div class="ltx_listingline">a = 1</div><div class="ltx_listingline">run(a)</div></div></article>',
        "* one {T}\n* two\n  1. inner\n\nTerm: meaning\n\n```\na = 1\nrun(a)\n```",
    ),
    (
        '<article><figure class="ltx_table" id="T1"><figcaption>Table 1: {T}</figcaption><table class="ltx_tabular"><thead><tr class="ltx_tr"><th class="ltx_align_left ltx_border_tt" colspan="2">H &amp; I</th>'
        '<th class="ltx_align_center ltx_border_tt">K</th></tr></thead><tbody><tr><td class="ltx_align_left" rowspan="2">a</td><td class="ltx_align_right">b</td><td class="ltx_align_center">5%</td></tr>'
        '<tr><td class="ltx_align_right ltx_border_b">c</td><td class="ltx_align_center ltx_border_b">d</td></tr></tbody></table></figure></article>',
        "[TABLE:T1]\n\\begin{table}\n\\begin{tabular}{lrc}\n\\hline\\hline\n\\multicolumn{2}{l}{H \\& I} & K \\\\\n\\multirow{2}{*}{a} & b & 5\\% \\\\\n & c & d \\\\ \\hline\n\\end{tabular}\n\\end{table}\nTable 1: {T}\n[ENDTABLE]",
    ),
    (
        '<article><figure class="ltx_figure" id="F2"><img src="a.png"/><figcaption>Figure 2: {T}.</figcaption></figure><div class="ltx_theorem"><h6 class="ltx_title ltx_title_theorem">Theorem 1</h6><p>It holds.</p></div>'
        '<section class="ltx_bibliography"><h2 class="ltx_title">References</h2><ul class="ltx_biblist"><li class="ltx_bibitem" id="bib.bib3"><span class="ltx_tag ltx_tag_bibitem">[3]</span> <span class="ltx_bibblock">A. One.</span></li></ul></section></article>',
        "[FIGURE:F2]\nFigure 2: {T}.\n[ENDFIGURE]\n\nTheorem 1: It holds.\n\n## References\n\n* [3] A. One.",
    ),
    (f'{_PARA}<span class="ltx_ref ltx_missing_citation">key</span></p></article>', ""),
    ("<p>no article {T}</p>", ""),
]


def _paged(spark: SparkSession, root: str, cases: Cases) -> DataFrame:
    """(doc_id, text): each document's page with its words in it."""
    docs = table(spark, root, "documents").select("doc_id", F.coalesce(F.trim(F.regexp_replace("text", r"[^\p{L}]+", " ")), F.lit("")).alias("words"))
    pages = F.array(*[F.lit(c) for c, _ in cases])
    return docs.select("doc_id", F.replace(F.element_at(pages, (F.col("doc_id") % len(cases) + 1).cast("int")), F.lit("{T}"), F.when(F.col("words") != "", F.col("words")).otherwise("none")).alias("text"))


def _query(name: str, cases: Cases, run: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, root: str) -> DataFrame:
        out = run(_paged(spark, root, cases))
        return out.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"))

    query.__name__ = name
    return query


def _sql(cases: Cases) -> str:
    quoted = [out.replace("'", "''") for _, out in cases]
    pages = " ".join(f"WHEN {k} THEN '{out}'" for k, out in enumerate(quoted))
    return f"""SELECT doc_id, md5(replace(CASE doc_id % {len(cases)} {pages} END, '{{T}}', CASE WHEN words <> '' THEN words ELSE 'none' END)) AS digest
    FROM (SELECT doc_id, coalesce(trim(regexp_replace(text, '[^\\pL]+', ' ', 'g')), '') AS words FROM documents)"""


def _by_id(df: DataFrame, text: str = "text") -> DataFrame:
    return df.select(F.col("id").alias("doc_id"), F.col(text).alias("text"))


_ALL: dict[str, tuple[Cases, Callable[[DataFrame], DataFrame]]] = {
    "m14_page_cases": (PAGES, lambda df: _by_id(clean_pages(df, "doc_id", "text"))),
    "t5_markdown_cases": (MARKDOWN, lambda df: df.select("doc_id", T.markdown_compatible(F.col("text")).alias("text"))),
    "x17_finished_documents": (DOCUMENTS, lambda df: _by_id(finished_documents(df, "doc_id", "text"))),
    "x21_optional_steps": (OPTIONS, lambda df: _by_id(finished_documents(df, "doc_id", "text", ("without_tables", "renumbered")))),
    "h3_html_pages": (HTML, lambda df: _by_id(pages_to_markdown(df, "doc_id", "text"), "markdown")),
}
QUERIES = {name: _query(name, *case) for name, case in _ALL.items()}
SQL = {name: _sql(cases) for name, (cases, _) in _ALL.items()}
