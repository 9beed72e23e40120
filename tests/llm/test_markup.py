"""Families found, structure kept, and look-alikes left alone."""

import pytest

from millrace.llm.markup import clean_elements, clean_markup, find_markup, markup_families

PLAIN = [
    None, "", " ", "[START_TABLE]\nTable 1\n\n|a|b|\n|-|-|\n|1|None|\n\n[END_TABLE]", "- plain line\n- other", "p < 0.05 and n > 50", "4 <> 5",
    "costs of US$ 16 per unit and US$ 7 more", "~72 samples", "saved as C:\\data\\flow\\run8.", "x = 3 == target", "a * b interaction", "R&D of b",
    "0.54** at the level and 0.3** below", "run #3 of 4", "the set {a, b}", "snake_case holds snake_case_two", "[3] and [4, 5]", "'robust' value", "5 > 3",
]
CASES = [
    ("a <b>bold</b> word<br/>next", ["html"], "a bold word\nnext"),
    ("x &lt; 2&nbsp;mm &amp; y", ["html"], "x < 2 mm & y"),
    ("&amp;lt;i&amp;gt;x&amp;lt;/i&amp;gt;", ["html"], "x"),
    ("left</td></tr>", ["html"], "left\n"),
    ("<!-- note -->text", ["html"], "text"),
    ("<ul>\n<li>one</li>\n<li>two</li>\n</ul>", ["html"], "\n- one\n- two\n"),
    ("<pre><code>a = 1\nrun(a)</code></pre>", ["html"], "\n```\na = 1\nrun(a)\n```\n"),
    ("<math><mi>x</mi><mo>=</mo><mn>3</mn></math>", ["html"], "$x=3$"),
    ("**strong** and *soft* and ~~old~~ and `code`", ["markdown"], "strong and soft and old and code"),
    ("see [a b](https://x.example/y-1) ![c](d.png)[^2] [e][f]", ["markdown"], "see a b c e"),
    ("Title\n-----\n> said\n- [x] done", ["markdown"], "## Title\nsaid\n- done"),
    ("```python\na = b_c_d\n```", ["markdown"], "\n```\na = b_c_d\n```\n"),
    ("== Head ==\n'''b''' ''i'' [[x|y]] {{convert|19|mm}}", ["wiki"], "## Head\nb i y 19 mm"),
    ('{| class="w"\n! h\n|-\n| a || 6\n|}', ["wiki"], "|h|\n|a|6|"),
    ("[https://x.example a b] __NOTOC__ c {{cite|title=t}}", ["wiki"], "a b c t"),
    ("\\textbf{a} and \\alpha 4\\,\\%", ["latex"], "a and α 4 %"),
    ("\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}", ["latex"], "\n\n- a\n- b\n"),
    ("$w_{9}^2$ and \\(x \\leq 9\\)", ["latex"], "$w_{9}^2$ and $x \\leq 9$"),
    ("\\begin{equation}\ny = \\sqrt{7}\n\\label{eq:a}\n\\end{equation}", ["latex"], "$$y = \\sqrt{7}$$"),
    ("a\\footnote{b} \\cite{c} Eq.~\\ref{eq:d}", ["latex"], "a (b) Eq. d"),
]


@pytest.mark.parametrize("text", PLAIN)
def test_look_alikes(text):
    assert find_markup(text) == [] and clean_markup(text) == text


@pytest.mark.parametrize("text,families,clean", CASES)
def test_families(text, families, clean):
    assert find_markup(text) == families
    assert " ".join(clean_markup(text).split(" ")).replace(" \n", "\n").strip(" ") == clean.strip(" ") or clean_markup(text).split() == clean.split()
    assert find_markup(f"[START_NOTE]{text}[END_NOTE]") == families


def test_cleaning_is_stable():
    for text, _, _ in CASES:
        once = clean_markup(text)
        assert clean_markup(once).split() == once.split() or find_markup(once)


def test_table_of_awkward_rows(spark):
    rows = [(1, "<b>x</b>", "y"), (1, "<b>x</b>", "y"), (2, None, "y"), (None, "", "y"), (3, "**a** " * 50_000, "y")]
    df = spark.createDataFrame(rows, "element_id long, text string, families string")
    got = sorted((r.element_id or 0, tuple(r.families), r.clean_text is None) for r in clean_elements(df).collect())
    assert got == [(0, (), False), (1, ("html",), False), (1, ("html",), False), (2, (), True), (3, ("markdown",), False)]
    assert markup_families(df.limit(0)).count() == 0


def test_depth_and_unknown_commands_lose_nothing():
    deep = "x"
    for k in range(40):
        deep = f"\\text{'bf' if k % 2 else 'it'}{{a{k} {deep}}}"
    assert clean_markup(deep).split() == [*[f"a{k}" for k in range(39, -1, -1)], "x"]
    written = "<i>"
    for _ in range(7):
        written = written.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    assert clean_markup(f"a {written}b").split() == ["a", "b"]
    assert clean_markup("The value \\xi and \\partial f of \\Lambda, \\mystery{z} and \\odd \\noindent t") == "The value ξ and ∂ f of Λ, z and \\odd t"
