"""Queries over document lines (survey ids L*, D1a, D11, M*, A5), with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import strip
from millrace.operators import lines as L
from millrace.sources.tables import table


def _lines(spark: SparkSession, root: str) -> DataFrame:
    return L.to_lines(table(spark, root, "documents"), "doc_id", "text", "source")


def l1_l6_line_rules(spark: SparkSession, root: str) -> DataFrame:
    c = F.col("line")
    return _lines(spark, root).select(
        "doc_id", "idx", L.uppercase_rule(c).alias("l1"), L.capitalised_rule(c).alias("l2"), L.symbol_rule(c).alias("l3"), L.address_rule(c).alias("l4"),
        L.is_short(c, L.SHORT).alias("l5"), L.is_title(c).alias("l6"),
    )


def l7_seed_lines(spark: SparkSession, root: str) -> DataFrame:
    return L.seed_lines(_lines(spark, root), "doc_id").select("doc_id", "idx", "kind")


def l8_gap_fill(spark: SparkSession, root: str) -> DataFrame:
    rows = L.fill_gaps(L.seed_lines(_lines(spark, root), "doc_id"), "doc_id")
    return rows.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if("removed").alias("n_removed"))


def l8_clean_text(spark: SparkSession, root: str) -> DataFrame:
    """The texts without the removed lines, as lengths per source."""
    rows = L.fill_gaps(L.seed_lines(_lines(spark, root), "doc_id"), "doc_id").filter("not removed")
    return L.from_lines(rows, "doc_id").select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


def d1a_longest_runs(spark: SparkSession, root: str) -> DataFrame:
    return L.longest_runs(_lines(spark, root), "doc_id").select("doc_id", "idx", "longest_run")


def d11_exact_copies(spark: SparkSession, root: str) -> DataFrame:
    """Documents of one text under white-space-free lower case: the class and its size, by hashing before the shuffle."""
    plain = F.md5(F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")))
    rows = table(spark, root, "documents").select("doc_id", plain.alias("digest"))
    size = rows.groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_copies"))
    return rows.join(size, "digest").select("doc_id", "class_id", "n_copies")


def m1_title(spark: SparkSession, root: str) -> DataFrame:
    """M1: of the first three lines the first heading of more than three words."""
    body = F.regexp_replace(F.regexp_replace("line", r"^#+|#+$", ""), r"^\*+|\*+$", "")
    rows = _lines(spark, root).filter("idx < 3").withColumn("body", body)
    hits = rows.filter(F.col("line").rlike(r"^[#*]+\s*[\p{L}\p{N}_]+") & (F.size(F.filter(F.split("body", r"\s+"), lambda w: w != "")) > 3))
    return hits.groupBy("doc_id").agg(F.min_by(strip(F.col("body")), "idx").alias("title"))


def m2_keywords(spark: SparkSession, root: str) -> DataFrame:
    """M2: keywords of the first line that names them (of the line after a bare heading)."""
    order = W.partitionBy("doc_id").orderBy("idx")
    rows = _lines(spark, root).withColumn("after", F.lead("line").over(order)).filter(F.col("line").contains("Keywords"))
    inline = strip(F.regexp_replace("line", r"^.*Keywords:?", ""))
    rows = rows.withColumn("words", F.when(inline != "", inline).otherwise(F.coalesce("after", F.lit(""))))
    return rows.groupBy("doc_id").agg(F.min_by("words", "idx").alias("words")).select(
        "doc_id", F.array_join(F.transform(F.split("words", r"[,;]"), strip), "|").alias("keywords")
    )


def m3_contents(spark: SparkSession, root: str) -> DataFrame:
    """M3: headings of level two and more after the last Abstract, indented by level."""
    rows = _lines(spark, root)
    last = rows.filter(F.col("line").rlike("(?i)^#+ *abstract")).groupBy("doc_id").agg(F.max("idx").alias("start"))
    heads = rows.join(last, "doc_id", "left").filter(F.col("line").rlike(r"^##+") & (F.col("idx") > F.coalesce("start", F.lit(-1))))
    level = F.length(F.regexp_extract("line", r"^(#+)", 1))
    entry = F.concat(F.repeat(F.lit("\t"), level - 2), strip(F.regexp_replace("line", r"^#+", "")))
    parts = F.array_sort(F.collect_list(F.struct("idx", entry.alias("e"))))
    return heads.groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda x: x["e"]), "\n").alias("contents"))


def m4_figures(spark: SparkSession, root: str) -> DataFrame:
    """M4: figure captions as environments, from the captions of scanned pages."""
    text = table(spark, root, "layout_dets").filter(F.col("content").rlike(r"^\s*Fig")).select("det_id", F.trim("content").alias("line"))
    text = text.withColumn("line", strip(F.regexp_replace("line", r"^Fig\. ", "Figure "))).filter(F.col("line").startswith("Figure"))
    label = F.regexp_extract("line", L.CAPTION, 1)
    caption = F.regexp_replace(strip(F.regexp_replace("line", "^" + L.CAPTION[4:], "")), r"^\*+|\*+$", "")
    env = F.concat(F.lit("\\begin{figure}\n\\caption{\n"), caption, F.lit("\n}\n\\label{fig:"), label, F.lit("}\n\\end{figure}"))
    return text.filter(label != "").select("det_id", env.alias("figure")).distinct()


def m6_references(spark: SparkSession, root: str) -> DataFrame:
    """M6: numbered reference lines of each document, numbered anew from 0; without a heading the first is lost."""
    rows = _lines(spark, root).filter("line != ''").withColumn("head", F.col("line").rlike("#+ References"))
    order = W.partitionBy("doc_id").orderBy("idx")
    rows = rows.withColumn("hit", F.col("line").rlike(L.REFERENCE)).withColumn("flag", F.max(F.col("head") | F.col("hit")).over(order.rowsBetween(W.unboundedPreceding, -1)))
    kept = rows.filter(F.col("hit") & ~F.col("head") & F.coalesce("flag", F.lit(False)))
    number = F.row_number().over(order) - 1
    body = strip(F.regexp_replace("line", r"^[*_]+|[*_]+$", ""))
    return kept.select(
        "doc_id", number.cast("long").alias("ref_no"),
        F.concat(number.cast("string"), F.lit(".["), F.regexp_extract(body, r"\[([0-9]+)\]", 1), F.lit("]("), F.regexp_replace(body, r"^.*?\[[0-9]+\]\s*", ""), F.lit(")")).alias("entry"),
    )


def m11_page_concat(spark: SparkSession, root: str) -> DataFrame:
    """The pages of every scanned item as one text."""
    rows = table(spark, root, "layout_dets").select("data_id", "page", "box_id", "det_id", "content").distinct().filter("content is not null")
    parts = F.array_sort(F.collect_list(F.struct("page", "box_id", "det_id", "content")))
    text = strip(F.regexp_replace(F.array_join(F.transform(parts, lambda x: x["content"]), "\n\n"), r"\n{3,}", "\n\n"))
    return rows.groupBy("data_id").agg(text.alias("text")).select("data_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


def m13_patch_failed(spark: SparkSession, root: str) -> DataFrame:
    """Detections whose content is missing patched from a second source by position."""
    rows = table(spark, root, "layout_dets").select("det_id", "data_id", "page", "content").distinct()
    base = table(spark, root, "layout_dets").select("det_id", F.array_join("ptrmfr_texts", " ").alias("second")).distinct()
    bad = rows.filter("content is null").select("det_id").join(base, "det_id")
    return rows.join(bad, "det_id", "left").select("det_id", F.coalesce("second", "content").alias("content"))


def a5_header_words(spark: SparkSession, root: str) -> DataFrame:
    """A5: words among the first ten of at least 40 % of an item's pages."""
    rows = table(spark, root, "layout_dets").select("det_id", "data_id", "page", "box_id", "content").distinct().filter("content is not null")
    first = rows.groupBy("data_id", "page").agg(F.min_by("content", F.struct("box_id", "det_id")).alias("content"))
    words = F.slice(F.filter(F.split(F.lower("content"), r"\s+"), lambda w: w != ""), 1, 10)
    pages = first.groupBy("data_id").agg(F.count("*").alias("n_pages"))
    counts = first.select("data_id", "page", F.explode(F.array_distinct(words)).alias("word")).groupBy("data_id", "word").agg(F.count("*").alias("n"))
    return counts.join(pages, "data_id").filter((F.col("n") >= 0.4 * F.col("n_pages")) & ~F.col("word").startswith("\\") & (F.col("n_pages") > 1)).select("data_id", "word", "n")


QUERIES = {
    f.__name__: f
    for f in (
        l1_l6_line_rules, l7_seed_lines, l8_gap_fill, l8_clean_text, d1a_longest_runs, d11_exact_copies, m1_title, m2_keywords, m3_contents, m4_figures, m6_references,
        m11_page_concat, m13_patch_failed, a5_header_words,
    )
}

_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_LINES = """WITH ln AS (SELECT doc_id, source, (i - 1)::INT AS idx, parts[i] AS line FROM
  (SELECT doc_id, source, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)))"""
_LEN = "len(regexp_replace(line, '{0}', '', 'g'))"
_HIT = " + ".join(f"len(array_to_string(regexp_extract_all(line, '{p}'), ''))" for p in (L.URL, L.EMAIL, L.DOI))
_L = {
    "l1": rf"CASE WHEN {_LEN.format(r'[^\pL]')} = 0 THEN -1 WHEN {_LEN.format(r'[^\p{Lu}]')} > 0.6 * {_LEN.format(r'[^\pL]')} THEN 0 ELSE 1 END",
    "l2": rf"""CASE WHEN {_STRIP.format('line')} = '' THEN -1 WHEN len(regexp_extract_all(line, '[\pL\pN_]+')) = 0 THEN 0
      WHEN len(list_filter(regexp_extract_all(line, '[\pL\pN_]+'), lambda w: regexp_matches(w, '^[\p{{Lu}}\pN_]'))) > 0.6 * len(regexp_extract_all(line, '[\pL\pN_]+')) THEN 0 ELSE 1 END""",
    "l3": rf"CASE WHEN {_LEN.format(r'[ \t]')} = 0 THEN -1 WHEN {_LEN.format(r'[ \t]')} - {_LEN.format(r'[^\pL]')} > 0.6 * {_LEN.format(r'[ \t]')} THEN 0 ELSE 1 END",
    "l4": rf"CASE WHEN {_LEN.format(r'\s')} > 0 AND {_HIT} > 0.3 * {_LEN.format(r'\s')} AND NOT regexp_matches(line, '{L.REFERENCE}') THEN 0 ELSE 1 END",
    "l5": r"len(string_split(regexp_replace(regexp_replace(line, '^\s+|\s+$', '', 'g'), '^[0-9\-,.:; ]+', ''), ' ')) < {0}",
    "l6": r"(starts_with(line, '#') OR regexp_matches(line, '^\*.*\*$') OR regexp_matches(line, '^_.*_$'))",
}
_OPENS = r"(contains(line, '[START_FIGURE]') OR contains(line, '[START_TABLE]') OR starts_with(line, '\begin{table}') OR regexp_matches(line, '(?i)Figure\s+([A.0-9]+)\s*[:.]\s*'))"
_MARK = r"regexp_matches(line, '\[(START|END)_(REF|FORMULA)\]')"
_SEEDED = f"""{_LINES}, ru AS (SELECT *, {_L['l1']} AS l1, {_L['l2']} AS l2, {_L['l3']} AS l3, {_L['l4']} AS l4, {_L['l5'].format(5)} AS s5, {_L['l5'].format(10)} AS s10, {_L['l6']} AS l6,
  {_STRIP.format('line')} = '' AS blank, contains(line, '[MISSING_PAGE') AS missing, {_OPENS} AS opens, {_MARK} AS mark FROM ln),
ev AS (SELECT *, CASE WHEN opens AND NOT (blank OR missing OR l4 = 0 OR l6 OR mark) THEN 1 WHEN contains(line, '[END_FIGURE]') OR contains(line, '[END_TABLE]') THEN 0 END AS event FROM ru),
st AS (SELECT *, last_value(event IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS inside FROM ev),
kd AS (SELECT *, CASE WHEN coalesce(inside, 0) = 1 THEN 'token' WHEN blank THEN 'blank' WHEN missing THEN 'token' WHEN l4 = 0 THEN 'delete' WHEN l6 THEN 'title' WHEN mark OR opens THEN 'token'
  WHEN l2 = 0 AND s10 THEN 'delete' WHEN s5 AND (l1 = 0 OR l3 = 0) THEN 'delete' ELSE 'text' END AS kind FROM st),
gp AS (SELECT *, max(CASE WHEN kind = 'delete' THEN idx END) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
  min(CASE WHEN kind = 'delete' THEN idx END) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt, count(*) OVER (PARTITION BY doc_id) AS n FROM kd),
rm AS (SELECT *, kind = 'delete' OR (kind IN ('blank', 'text') AND s5 AND coalesce(CASE WHEN prev IS NULL THEN nxt <= 3 WHEN nxt IS NULL THEN n - prev - 1 <= 3 ELSE nxt - prev <= 3 END, FALSE)) AS removed FROM gp)"""
_DETS = "(SELECT DISTINCT det_id, data_id, page, box_id, content FROM layout_dets)"
SQL = {
    "l1_l6_line_rules": f"{_LINES} SELECT doc_id, idx, {_L['l1']} AS l1, {_L['l2']} AS l2, {_L['l3']} AS l3, {_L['l4']} AS l4, {_L['l5'].format(5)} AS l5, {_L['l6']} AS l6 FROM ln",
    "l7_seed_lines": f"{_SEEDED} SELECT doc_id, idx, kind FROM kd",
    "l8_gap_fill": f"{_SEEDED} SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed FROM rm GROUP BY doc_id",
    "l8_clean_text": f"{_SEEDED} SELECT doc_id, len(string_agg(line, chr(10) ORDER BY idx))::INT AS n_chars, md5(string_agg(line, chr(10) ORDER BY idx)) AS digest FROM rm WHERE NOT removed GROUP BY doc_id",
    "d1a_longest_runs": f"""{_LINES}, w AS (SELECT doc_id, idx, ws, unnest(range(1, len(ws) + 1)) AS pos FROM (SELECT doc_id, idx, list_filter(string_split_regex(line, '\\s+'), lambda w: w <> '') AS ws FROM ln)),
      v AS (SELECT doc_id, idx, pos, ws[pos] AS word FROM w), i AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, idx, word ORDER BY pos) AS island FROM v)
      SELECT doc_id, idx, max(run) AS longest_run FROM (SELECT doc_id, idx, word, island, count(*) AS run FROM i GROUP BY ALL) GROUP BY ALL""",
    "d11_exact_copies": """SELECT doc_id, min(doc_id) OVER (PARTITION BY d) AS class_id, count(*) OVER (PARTITION BY d) AS n_copies
      FROM (SELECT doc_id, md5(lower(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) AS d FROM documents)""",
    "m1_title": f"""{_LINES}, b AS (SELECT *, regexp_replace(regexp_replace(line, '^#+|#+$', '', 'g'), '^\\*+|\\*+$', '', 'g') AS body FROM ln WHERE idx < 3)
      SELECT doc_id, arg_min({_STRIP.format('body')}, idx) AS title FROM b
      WHERE regexp_matches(line, '^[#*]+\\s*[\\pL\\pN_]+') AND len(list_filter(string_split_regex(body, '\\s+'), lambda w: w <> '')) > 3 GROUP BY doc_id""",
    "m2_keywords": f"""{_LINES}, a AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY idx) AS after FROM ln),
      k AS (SELECT *, {_STRIP.format("regexp_replace(line, '^.*Keywords:?', '')")} AS inl FROM a WHERE contains(line, 'Keywords')),
      m AS (SELECT doc_id, arg_min(CASE WHEN inl <> '' THEN inl ELSE coalesce(after, '') END, idx) AS words FROM k GROUP BY doc_id)
      SELECT doc_id, array_to_string(list_transform(string_split_regex(words, '[,;]'), lambda x: {_STRIP.format('x')}), '|') AS keywords FROM m""",
    "m3_contents": f"""{_LINES}, s AS (SELECT doc_id, max(idx) AS start FROM ln WHERE regexp_matches(line, '(?i)^#+ *abstract') GROUP BY 1),
      h AS (SELECT ln.* FROM ln LEFT JOIN s USING (doc_id) WHERE regexp_matches(line, '^##+') AND idx > coalesce(start, -1))
      SELECT doc_id, string_agg(repeat(chr(9), len(regexp_extract(line, '^#+')) - 2) || {_STRIP.format("regexp_replace(line, '^#+', '')")}, chr(10) ORDER BY idx) AS contents FROM h GROUP BY 1""",
    "m4_figures": f"""WITH t AS (SELECT det_id, {_STRIP.format("regexp_replace(trim(content), '^Fig[.] ', 'Figure ')")} AS line FROM layout_dets WHERE regexp_matches(content, '^\\s*Fig')),
      u AS (SELECT det_id, regexp_extract(line, '(?i)Figure\\s+([A.0-9]+)\\s*[:.]\\s*', 1) AS label,
        regexp_replace({_STRIP.format("regexp_replace(line, '^Figure\\s+([A.0-9]+)\\s*[:.]\\s*', '')")}, '^\\*+|\\*+$', '', 'g') AS caption FROM t WHERE starts_with(line, 'Figure'))
      SELECT DISTINCT det_id, '\\begin{{figure}}' || chr(10) || '\\caption{{' || chr(10) || caption || chr(10) || '}}' || chr(10) || '\\label{{fig:' || label || '}}' || chr(10) || '\\end{{figure}}' AS figure FROM u WHERE label <> ''""",
    "m6_references": f"""{_LINES}, h AS (SELECT *, regexp_matches(line, '#+ References') AS head, regexp_matches(line, '{L.REFERENCE}') AS hit FROM ln WHERE line <> ''),
      f AS (SELECT *, bool_or(head OR hit) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS flag FROM h),
      r AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS ref_no, {_STRIP.format("regexp_replace(line, '^[*_]+|[*_]+$', '', 'g')")} AS body FROM f WHERE hit AND NOT head AND coalesce(flag, FALSE))
      SELECT doc_id, ref_no, ref_no || '.[' || regexp_extract(body, '\\[([0-9]+)\\]', 1) || '](' || regexp_replace(body, '^.*?\\[[0-9]+\\]\\s*', '') || ')' AS entry FROM r""",
    "m11_page_concat": f"""SELECT data_id, len(t)::INT AS n_chars, md5(t) AS digest FROM (SELECT data_id, {_STRIP.format("regexp_replace(string_agg(content, chr(10) || chr(10) ORDER BY page, box_id, det_id, content), '\\n{3,}', chr(10) || chr(10), 'g')")} AS t
      FROM {_DETS} WHERE content IS NOT NULL GROUP BY 1)""",
    "m13_patch_failed": "SELECT DISTINCT det_id, CASE WHEN content IS NULL THEN array_to_string(ptrmfr_texts, ' ') ELSE content END AS content FROM layout_dets",
    "a5_header_words": f"""WITH f AS (SELECT data_id, page, arg_min(content, (box_id, det_id)) AS content FROM {_DETS} WHERE content IS NOT NULL GROUP BY 1, 2),
      w AS (SELECT DISTINCT data_id, page, unnest(list_filter(string_split_regex(lower(content), '\\s+'), lambda w: w <> '')[1:10]) AS word FROM f),
      p AS (SELECT data_id, count(*) AS n_pages FROM f GROUP BY 1)
      SELECT data_id, word, count(*) AS n FROM w JOIN p USING (data_id) WHERE NOT starts_with(word, '\\') AND n_pages > 1 GROUP BY data_id, word, n_pages HAVING count(*) >= 0.4 * n_pages""",
}
