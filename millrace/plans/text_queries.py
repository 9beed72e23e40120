"""Queries of the scalar text functions (survey ids T*), with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.sources.tables import table

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}
_SHORT = "WHERE text IS NOT NULL"


def _add(name: str, source: str, key: str, column: str, expr: Callable[[Column], Column], sql: str, where: str | None = None) -> None:
    """A query (key, out) that applies one function to a column of a whole table."""

    def query(spark: SparkSession, root: str) -> DataFrame:
        df = table(spark, root, source)
        if where:
            df = df.filter(where)
        return df.select(key, expr(F.col(column)).alias("out"))

    QUERIES[name] = query
    SQL[name] = f"SELECT {key}, {sql} AS out FROM {source}" + (f" WHERE {where}" if where else "")


def _rep(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


def _strip(x: str) -> str:
    return _rep(x, r"^\s+|\s+$", "")


def _q(x: str) -> str:
    return "chr(10)" if x == "\n" else f"'{x}'"


def _chain(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, {_q(a)}, '{b}')"
    return x


_add("t1_collapse_blank", "documents", "doc_id", "text", T.collapse_blank,
     _strip("regexp_replace(regexp_replace(regexp_replace(text, ' +', ' ', 'g'), ' *[\\r\\n]+', chr(10), 'g'), '\\n+ *', chr(10), 'g')"))
_add("t2_undouble_spaces", "layout_dets", "det_id", "content", T.undouble_spaces,
     _strip("regexp_replace(replace(replace(regexp_replace(content, ' {2,}', chr(1), 'g'), ' ', ''), chr(1), ' '), ' ?\\n{2,} ?', chr(10) || chr(10), 'g')"))
_add("t3_escape_latex", "grobid_elements", "element_id", "text", T.escape_latex, _chain("text", T.LATEX_ESCAPES))
_add("t4_escape_latex_signs", "grobid_elements", "element_id", "text", T.escape_latex_signs,
     "array_to_string([coalesce(MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in T.LATEX_SIGNS.items()) + "}[x], x) for x in string_split(text, '')], '')")
_add("t6_close_environments", "grobid_elements", "element_id", "text", T.close_environments,
     "text || " + " || ".join(
         f"repeat('\\end{{{n}}}', greatest(((len(text) - len(replace(text, '\\begin{{{n}}}', ''))) // {len(n) + 8} - (len(text) - len(replace(text, '\\end{{{n}}}', ''))) // {len(n) + 6})::INT, 0))"
         for n in T.ENVIRONMENTS))
_add("t7_without_numbers", "documents", "doc_id", "text", T.without_numbers, _strip("regexp_replace(text, '[0-9_]|\\*\\*', '', 'g')"))
_add("t8_next_punctuation", "documents", "doc_id", "text", T.next_punctuation,
     "CASE WHEN regexp_matches(text, '[.?!\\n]') THEN len(regexp_extract(text, '^[^.?!\\n]*')) + 1 ELSE 0 * len(text) END")
_add("t8_last_punctuation", "documents", "doc_id", "text", T.last_punctuation,
     "CASE WHEN regexp_matches(text, '[.?!\\n]') THEN len(text) - len(regexp_extract(text, '[^.?!\\n]*$')) ELSE 0 * len(text) END")
_add("t9_ligatures", "layout_dets", "det_id", "content", lambda c: T.replace_all(c, T.LIGATURES), _chain("content", T.LIGATURES))
_add("t10_dehyphenate", "layout_dets", "det_id", "content", T.dehyphenate, "regexp_replace(content, '-[ ]*\\n(\\S+) ?', '\\1' || chr(10), 'g')")
_add("t11_paragraphs", "documents", "doc_id", "text", lambda c: F.size(T.paragraphs(c)).cast("long"),
     "len(string_split(regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g'), chr(10) || chr(10)))", "text IS NOT NULL")
_add("t15_plain_lower", "grobid_elements", "element_id", "text", T.plain_lower, "lower(" + _chain("text", T.MARKS_REMOVED) + ")")
_add("t17_first_words", "tei_meta", "doc_id", "title", T.first_words, "array_to_string(string_split(title, ' ')[1:8], ' ')")
_add("t17_last_words", "tei_meta", "doc_id", "title", T.last_words, "array_to_string(string_split(title, ' ')[-8:], ' ')")
_add("t18_longer_than", "layout_dets", "det_id", "ptrmfr_texts", lambda c: F.array_join(T.longer_than(c, 30), "|"),
     "array_to_string(list_filter(ptrmfr_texts, lambda x: len(x) > 30), '|')")
_add("t20_digit_share", "biblio", "biblio_id", "pages", lambda c: F.round(T.digit_share(c), 6),
     "round(CASE WHEN pages IS NULL THEN NULL WHEN len(pages) = 0 THEN 0.0 ELSE len(regexp_replace(pages, '[^0-9]', '', 'g')) / len(pages) END, 6)")
_add("t21_split_tags", "grobid_elements", "element_id", "text", lambda c: F.array_join(T.split_tags(c), "¦"),
     "array_to_string(list_filter(string_split(regexp_replace(text, '(\\[(?:START|END)_[A-Z]+\\])', chr(1) || '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> ''), '¦')")
_add("t23_escape_pattern", "biblio", "biblio_id", "title", T.escape_pattern, "regexp_replace(title, '([\\\\*+?()\\[\\]{}|^$])', '\\\\\\1', 'g')")
_add("t24_clean_url", "documents", "doc_id", "site", T.clean_url, f"nullif({_strip('regexp_replace(regexp_replace(regexp_replace(' + _strip('site') + chr(44) + chr(39) + '[.]Lastaccessed$' + chr(39) + chr(44) + chr(39) * 2 + '), ' + chr(39) + '^<' + chr(39) + ', ' + chr(39) * 2 + '), ' + chr(39) + '>.*$' + chr(39) + ', ' + chr(39) * 2 + ')')}, '')")
_add("t25_csl_date", "biblio", "biblio_id", "date", lambda c: F.array_join(T.csl_date(c).cast("array<string>"), "-"),
     "CASE WHEN regexp_matches(date, '^\\d{4}') THEN array_to_string(list_filter([try_cast(nullif(regexp_extract(date, '^(\\d{4})(?:-(\\d{1,2})(?:-(\\d{1,2}))?)?', k), '') AS INT) FOR k IN [1, 2, 3]], lambda x: x IS NOT NULL), '-') END")
SQL["t25_csl_date"] = """SELECT biblio_id, CASE WHEN regexp_matches(date, '^\\d{4}') THEN concat_ws('-',
  try_cast(nullif(regexp_extract(date, '^(\\d{4})(?:-(\\d{1,2})(?:-(\\d{1,2}))?)?', 1), '') AS INT),
  try_cast(nullif(regexp_extract(date, '^(\\d{4})(?:-(\\d{1,2})(?:-(\\d{1,2}))?)?', 2), '') AS INT),
  try_cast(nullif(regexp_extract(date, '^(\\d{4})(?:-(\\d{1,2})(?:-(\\d{1,2}))?)?', 3), '') AS INT)) END AS out FROM biblio"""
_add("t26_heading_name", "layout_dets", "det_id", "content", T.is_heading_name,
     "len(content) > 0 AND NOT regexp_matches(lower(content), '^acknowledge?ments?') AND len(regexp_replace(content, '[^\\pL]', '', 'g')) > 0.01 * len(content)", "content IS NOT NULL")
_add("t27_script_family", "tei_meta", "doc_id", "language", T.script_family,
     "CASE " + " ".join(f"WHEN language IN ({', '.join(repr(x) for x in v.split())}) THEN '{k}'" for k, v in T.SCRIPT_LANGUAGES.items()) + " ELSE language END")
_add("t31_font_flags", "lineitem", "l_orderkey", "l_linenumber", T.font_flags,
     "concat_ws(', ', " + ", ".join(f"CASE WHEN l_linenumber & {b} <> 0 THEN '{n}' ELSE {repr(o) if o else 'NULL'} END" for b, n, o in T.FONT_FLAGS) + ")")
_add("t32_has_math", "layout_dets", "det_id", "content", T.has_math, "regexp_matches(content, '[\\x{370}-\\x{3ff}\\x{2200}-\\x{22ff}\\x{2a00}-\\x{2aff}±×÷≠≤≥∞]')")
_add("t33_points_to_pixels", "lineitem", "l_orderkey", "l_quantity", lambda c: T.points_to_pixels(c, 96), "round_even(l_quantity * 96 / 72, 0)::INT")
_add("t34_heading_level", "layout_dets", "det_id", "content", lambda c: T.heading_level(F.regexp_extract(c, r"^\s*([\d.]+)", 1)),
     "len(string_split(regexp_replace(regexp_extract(content, '^\\s*([\\d.]+)', 1), '^\\.+|\\.+$', '', 'g'), '.'))::INT", "content IS NOT NULL")
_add("t35_subscript", "biblio", "biblio_id", "volume", T.to_subscript, "translate(volume, '0123456789', '₀₁₂₃₄₅₆₇₈₉')")


def t12_join_pretty_lines(spark: SparkSession, root: str) -> DataFrame:
    """T12 on text whose blank lines are set apart first, where both regex engines agree."""
    df = table(spark, root, "documents").filter("text IS NOT NULL")
    one = F.regexp_replace("text", r"\n{2,}", "\n\n")
    return df.select("doc_id", F.length(T.join_pretty_lines(one)).alias("n_chars_out"), (F.length(one) - F.length(F.replace(one, F.lit("\n"), F.lit("")))).alias("n_lines_in"))


QUERIES["t12_join_pretty_lines"] = t12_join_pretty_lines
SQL["t12_join_pretty_lines"] = """SELECT doc_id, len(regexp_replace(t, '([^\\n])\\n([^\\n0-9*#\\[])', '\\1 \\2', 'g'))::INT AS n_chars_out,
(len(t) - len(replace(t, chr(10), '')))::INT AS n_lines_in
FROM (SELECT doc_id, regexp_replace(text, '\\n{2,}', chr(10) || chr(10), 'g') AS t FROM documents WHERE text IS NOT NULL)"""
