"""Scalar text functions as native column expressions. All return null for null input unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters, environments, languages and marks, with their replacements in the order in which they apply.
LIGATURES = (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "ft"), ("ﬆ", "st"), ("ꜳ", "aa"))
LATEX_ESCAPES = (
    ("\\", "\\textbackslash"), ("&", "\\&"), ("%", "\\%"), ("#", "\\#"), ("}", "\\}"), ("{", "\\{"), ("_", "\\_{}"), ("$", "\\$"), ("~", "\\~{}"), ("^", "\\^{}"),
    ("≥", "\\geq"), ("≤", "\\leq"),
)
LATEX_SIGNS = {
    "&": "\\&", "%": "\\%", "$": "\\$", "#": "\\#", "_": "\\_", "{": "\\{", "}": "\\}", "~": "\\textasciitilde{}", "^": "\\^{}", "\\": "\\textbackslash{}",
    "<": "\\textless{}", ">": "\\textgreater{}",
}
ENVIRONMENTS = ("bmatrix", "pmatrix", "matrix", "tabular", "table")
SCRIPT_LANGUAGES = {
    "latin": "af az bs cs cy da de es et fr ga hr hu id is it ku la lt lv mi ms mt nl no oc pi pl pt ro rs_latin sk sl sq sv sw tl tr uz vi french german",
    "arabic": "ar fa ug ur",
    "cyrillic": "ru rs_cyrillic be bg uk mn abq ady kbd ava dar inh che lbe lez tab",
    "devanagari": "hi mr ne bh mai ang bho mah sck new gom sa bgc",
}
FONT_FLAGS = ((1, "superscript", None), (2, "italic", None), (4, "serifed", "sans"), (8, "monospaced", "proportional"), (16, "bold", None))
SUBSCRIPTS, SUPERSCRIPTS = "₀₁₂₃₄₅₆₇₈₉", "⁰¹²³⁴⁵⁶⁷⁸⁹"
MARKS_REMOVED = (
    ("\\ ", ""), (" ", ""), ("\n", ""), ("*", ""), ("_", ""), ("^", ""), ("\\[", ""), ("\\]", ""), ("\\(", ""), ("\\)", ""), ("\\right", ""), ("\\left", ""),
    ("\\sum", "X"), ("{", ""), ("}", ""), ("#", ""), ("[REF]", ""), ("[ENDREF]", ""), ("\\varphi", "\\phi"), ("\\quad", ""), ("\\qquad", ""), ("\\hskip", ""),
    ("\\vskip", ""), ("\\frac", ""), ("\\rm", ""), ("\\,", ""), ("-", ""),
)


def strip(c: Column) -> Column:
    """White space of every kind off both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def collapse_blank(c: Column) -> Column:
    """Runs of spaces to one, blank lines and spaces around line ends away."""
    c = F.regexp_replace(c, r" +", " ")
    c = F.regexp_replace(c, r" *[\r\n]+", "\n")
    return strip(F.regexp_replace(c, r"\n+ *", "\n"))


def undouble_spaces(c: Column) -> Column:
    """Lone spaces away, runs of spaces to one, blank lines to one."""
    c = F.regexp_replace(c, r"(?<! ) (?! )", "")
    c = F.regexp_replace(c, r" {2,}", " ")
    return strip(F.regexp_replace(c, r" ?\n{2,} ?", "\n\n"))


def replace_all(c: Column, pairs) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape_latex(c: Column) -> Column:
    """Characters with a meaning in LaTeX, one after the other."""
    return replace_all(c, LATEX_ESCAPES)


def escape_latex_signs(c: Column) -> Column:
    """T4: the same characters all at once, so that no replacement is replaced again."""
    table = F.create_map(*[F.lit(x) for pair in LATEX_SIGNS.items() for x in pair])
    return F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")


def close_environments(c: Column) -> Column:
    """An end for every environment that is begun more often than ended."""
    for name in ENVIRONMENTS:
        begun, ended = f"\\begin{{{name}}}", f"\\end{{{name}}}"
        count = lambda x: (F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))) / len(x)  # noqa: E731, B023
        c = F.concat(c, F.repeat(F.lit(ended), F.greatest(count(begun) - count(ended), F.lit(0)).cast("int")))
    return c


def without_numbers(c: Column) -> Column:
    """Digits, underscores and double asterisks away."""
    return strip(F.regexp_replace(c, r"[0-9_]|\*\*", ""))


def last_punctuation(c: Column) -> Column:
    """Place (from 1) of the last sentence mark or line end, 0 without."""
    reverse = F.reverse(c)
    at = F.regexp_instr(reverse, F.lit(r"[.?!\n]"))
    return F.when(at > 0, F.length(c) - at + 1).when(c.isNotNull(), 0)


def next_punctuation(c: Column) -> Column:
    """Place (from 1) of the first sentence mark or line end, 0 without."""
    return F.regexp_instr(c, F.lit(r"[.?!\n]"))


def dehyphenate(c: Column) -> Column:
    """The first word of the next line joins a line that ends with a hyphen."""
    return F.regexp_replace(c, r"-[ ]*\n(\S+) ?", "$1\n")


def paragraphs(c: Column) -> Column:
    """Array of paragraphs."""
    return F.split(F.regexp_replace(c, r"\n{3,}", "\n\n"), "\n\n")


def join_pretty_lines(c: Column) -> Column:
    """A single line end before ordinary text becomes a space."""
    return F.regexp_replace(c, r"(?<!\n)\n([^\n0-9*#\[])", " $1")


def plain_lower(c: Column) -> Column:
    """Marks away, lower case."""
    return F.lower(replace_all(c, MARKS_REMOVED))


def first_words(c: Column, n: int = 8) -> Column:
    """The first n space-separated words."""
    return F.array_join(F.slice(F.split(c, " "), 1, n), " ")


def last_words(c: Column, n: int = 8) -> Column:
    """The last n space-separated words."""
    words = F.split(c, " ")
    return F.array_join(F.slice(words, F.greatest(F.size(words) - n + 1, F.lit(1)), n), " ")


def longer_than(c: Column, least: int = 10) -> Column:
    """Strings of an array longer than ``least``."""
    return F.filter(c, lambda x: F.length(x) > least)


def digit_share(c: Column) -> Column:
    """Digits per character; 0 for the empty text."""
    return F.when(F.length(c) == 0, 0.0).otherwise(F.length(F.regexp_replace(c, "[^0-9]", "")) / F.length(c))


def split_tags(c: Column) -> Column:
    """The [START_x] and [END_x] tags as pieces of their own, empty pieces away."""
    marked = F.regexp_replace(c, r"(\[(?:START|END)_[A-Z]+\])", "\u0001$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda x: x != "")


def escape_pattern(c: Column) -> Column:
    """Regular-expression signs escaped, all but the dot."""
    return F.regexp_replace(c, r"([\\*+?()\[\]{}|^$])", r"\\$1")


def clean_url(c: Column) -> Column:
    """Trimmed, without a leading < and what follows >, without a .Lastaccessed tail; empty gives null."""
    c = F.regexp_replace(strip(c), r"\.Lastaccessed$", "")
    c = F.regexp_replace(F.regexp_replace(c, r"^<", ""), r">.*$", "")
    return F.nullif(strip(c), F.lit(""))


def csl_date(c: Column) -> Column:
    """[year], [year, month] or [year, month, day] of an ISO-like date, as far as it is numeric; else null."""
    year, month, day = (F.regexp_extract(c, r"^(\d{4})(?:-(\d{1,2})(?:-(\d{1,2}))?)?", k) for k in (1, 2, 3))
    parts = F.array(*[F.nullif(p, F.lit("")).cast("int") for p in (year, month, day)])
    return F.when(year != "", F.filter(parts, lambda x: x.isNotNull()))


def is_heading_name(c: Column) -> Column:
    """A usable section name: not empty, no acknowledgements, and more than one in a hundred characters are letters."""
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    return (F.length(c) > 0) & ~F.lower(c).rlike("^acknowledge?ments?") & (letters > 0.01 * F.length(c))


def script_family(c: Column) -> Column:
    """Script family of a language code; the code itself where it has none."""
    table = F.create_map(*[F.lit(x) for family, codes in SCRIPT_LANGUAGES.items() for code in codes.split() for x in (code, family)])
    return F.coalesce(F.try_element_at(table, c), c)


def font_flags(c: Column) -> Column:
    """Names of the bits of a font's flags, and of some bits that are not set."""
    return F.concat_ws(", ", *[F.when(c.bitwiseAND(bit) != 0, F.lit(name)).otherwise(F.lit(other)) for bit, name, other in FONT_FLAGS])


def has_math(c: Column) -> Column:
    """Any Greek letter, mathematical operator or mathematical alphabet character."""
    return c.rlike("[Ͱ-Ͽ∀-⋿⨀-⫿±×÷≠≤≥∞]")


def points_to_pixels(c: Column, dpi: int) -> Column:
    """Rounded half to even."""
    return F.bround(c * dpi / 72).cast("int")


def heading_level(c: Column) -> Column:
    """Depth of a section number such as 2.1.3."""
    return F.size(F.split(F.regexp_replace(c, r"^\.+|\.+$", ""), r"\."))


def to_subscript(c: Column) -> Column:
    """T35."""
    return F.translate(c, "0123456789", SUBSCRIPTS)


def to_superscript(c: Column) -> Column:
    return F.translate(c, "0123456789", SUPERSCRIPTS)


# Words that tell languages apart.
LANGUAGE_WORDS = {
    "de": "der die das und ist nicht mit ein eine von den im",
    "en": "the and of is are was with that this from which for",
    "es": "el los las y es una por con que del para como",
    "fr": "le les des et est une dans pour avec que sur par",
    "it": "il gli di e che una per con della nel sono dal",
    "nl": "het een en van niet met voor dat zijn ook naar bij",
    "pt": "o os uma e com para que do da em não mais",
}


def language_by_words(c: Column) -> Column:
    """The language most of whose telling words a text holds, ties to the first by code; other without any."""
    words = F.split(F.lower(c), r"[^\p{L}]+")

    def hits(known: str) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(*known.split())))

    counts = [F.struct(hits(known).alias("n"), F.lit(code).alias("code")) for code, known in LANGUAGE_WORDS.items()]
    ordered = F.array_sort(F.array(*counts), lambda a, b: F.when(a["n"] != b["n"], b["n"] - a["n"]).when(a["code"] < b["code"], -1).otherwise(1))
    return F.when(c.isNotNull(), F.when(ordered[0]["n"] > 0, ordered[0]["code"]).otherwise("other"))


def document_language(label: Column, title: Column) -> Column:
    """The label; without one or for other, the language of the title's words, else en; chinese as ch; then the script family."""
    guess = F.nullif(language_by_words(title), F.lit("other"))
    named = F.when(label.isNull() | (label == "other"), F.coalesce(guess, F.lit("en"))).otherwise(label)
    return script_family(F.when(named == "chinese", "ch").otherwise(named))


# Rewrites to Markdown, as (pattern, replacement), in order: equation tags inside their equations, escaped full
# stops plain, bold formulas as mathbf, addresses as links, code between fences of their own.
MARKDOWN_RULES = (
    (r"(?md)^\(([0-9.]+[a-zA-Z]?)\) \\\[([^\n]+?)\\\]$", r"\\[$2 \\tag{$1}\\]"),
    (r"(?md)^\\\[([^\n]+?)\\\] \(([0-9.]+[a-zA-Z]?)\)$", r"\\[$1 \\tag{$2}\\]"),
    (r"(?md)^\\\[([^\n]+?)\\\] \(([0-9.]+[a-zA-Z]?)\) (\\\[[^\n]+?\\\])$", r"\\[$1 \\tag{$2}\\] $3"),
    (r"\\\. ", ". "),
    (r"\\bm\{|\{\\\\bm ", r"\\mathbf{"),
    (r"\\mbox\{ ?\\boldmath\$([^\n]*?)\$\}", r"\\mathbf{$1}"),
    (r"((?:https?|ftp)://[\w_-]+(?:\.[\w_-]+)+[\w.,@?^=%&:/~+#-]*[\w@?^=%&/~+#-])", "[$1]($1)"),
    (r"(?s)```\s*(.+?)\s*```", "```\n$1\n```"),
)


def markdown_compatible(c: Column) -> Column:
    """T5."""
    for pattern, to in MARKDOWN_RULES:
        c = F.regexp_replace(c, pattern, to)
    return c
