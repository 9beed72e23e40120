"""Noise in text from scanned pages (p6): broken words, misread glyphs, running headers, page numbers.

Method. Words of the whole corpus are grouped by a confusable-glyph skeleton; in a group a rare form
that glyph confusions turn into a much more frequent form is a misreading of it. Numbers and letters set apart have no
group of words; they are judged by their own shape. A line-end break
is mended if the joined word is the supported form, and kept if the hyphenated compound is. Lines
with digits masked that come first on several pages of an item are its running headers; numbers
that keep a constant distance from the page index are its page numbers. Paragraphs are then
reflowed with SQL windows over page and position.

Word counts, skeleton groups, header and page statistics cover all rows and are built by partial
aggregation; no group of rows is gathered on one task except the few header and number lines of an item.

Null or empty lines give no defect and no paragraph; copies give the same defects once; several
texts under one det_id are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.runtime import broadcast_if_small, materialize
from millrace.sources.tables import columns_or_null, table

#: A form is a misreading if its frequent form is at least so many times as common, and this common itself.
SUPPORT_RATIO, SUPPORT_COUNT = 5, 4
#: A line-end pair that recurs so often while its joined form never occurs is a compound.
COMPOUND_PAIRS = 3
#: A first line is an item's header if so many of its detections have it; one of so many items is a journal's.
HEADER_ROWS, JOURNAL_ITEMS = 2, 3
#: Categories that are no header by their place: captions and formulas.
NO_HEADER = (4, 6, 8, 14)

# What a recogniser reads (right) for what is printed (left).
CONFUSIONS = (
    ("e", "c"), ("a", "@"), ("s", "5"), ("i", "!"), ("t", "†"), ("n", "ri"), ("o", "0"), ("l", "|"), ("l", "i"), ("l", "1"), ("i", "1"), ("i", "l"),
    ("u", "ii"), ("d", "cl"), ("cl", "d"), ("m", "rn"), ("rn", "m"), ("b", "6"), ("g", "9"), ("h", "li"), ("h", "b"), ("w", "vv"), ("i", "|"), ("s", "$"),
)
HYPHENS = "-‐‑¬­"

#: Each glyph written out so that all confusions of the list become equal.
_FOLD = str.maketrans({
    "c": "e", "@": "a", "5": "s", "$": "s", "!": "i", "†": "t", "0": "o", "|": "i", "1": "i", "l": "i", "9": "g",
    "n": "ri", "m": "rri", "u": "ii", "h": "ii", "b": "ii", "6": "ii", "d": "ei", "w": "vv",
})

_TOKEN = re.compile(r"[^\s.,;:()\[\]{}\"“”„«»?=+<>/\\]+")
_TRIM = "!'’‘*_~^&#%-–—‐­¬|†@"
#: A form with a sign or digit among its letters is no word of its own, however frequent (part numbers as b12 and 3b are).
_GLYPH_INSIDE = r"\p{L}[@†|!01569]\p{L}|\p{L}{2}[@†|]|[@†|!]\p{L}{2}"
_PART_NUMBER = r"^(?:[a-z]{1,2}\d+[a-z]?|[a-z]\d[a-z]|\d+[a-z])$"
_MISREAD_NUMBER = re.compile(r"(?<![\w.,])(?=[\dlOoI|]*\d)(?=[\d.,]*[lOoI|])[\dlOoI|]+(?:[.,][\dlOoI|]+)?(?![\w|])|(?<![\w.,])\d+[.,](?=\d*[lOoI|])[\dlOoI|]+(?![\w|])")
_DIGIT_NEXT = re.compile(r"\d[.,]?[lOoI|]|[lOoI|][.,]?\d")  # without it no number is misread
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_] ){3,}[^\W\d_](?!\w)")
_BREAK = re.compile(rf"([^\W\d_]+(?:['’][^\W\d_]+)?)([{HYPHENS}])\s*$")
_NEXT = re.compile(r"\s*([^\W\d_]+)")
_NUMBER_LINE = re.compile(
    r"^[\[(\-–—\s]*(p(?:age|\.|ág\.?|ágina)?|seite|s\.|pagina|pag\.?)?\s*([\dOol|]{1,5})(?:\s*/\s*([\dOol|]{1,5}))?[\])\-–—\s]*$", re.I
)
_NUMBER_EDGE = re.compile(r"^([\dOol]{1,5})\s{2,}\S|\S\s{2,}([\dOol]{1,5})\s*$")
_DIGITS = re.compile(r"^[^\w@†|!$]*\d[\dOolI|.,:/\-–—]*[^\w@†|!$]*$")


def skeleton(word: str) -> str:
    """One form for all spellings that glyph confusions may turn into each other (others may share it)."""
    return word.translate(_FOLD)


def explains(seen: str, true: str, limit: int = 6) -> bool:
    """Whether ``seen`` is ``true`` with at least one and at most ``limit`` confusions of the list."""
    n, m = len(seen), len(true)
    best = [[limit + 1] * (m + 1) for _ in range(n + 1)]
    best[0][0] = 0
    for i in range(n + 1):
        for j in range(m + 1):
            cost = best[i][j]
            if cost > limit:
                continue
            if i < n and j < m and seen[i] == true[j] and cost < best[i + 1][j + 1]:
                best[i + 1][j + 1] = cost
            for right, wrong in CONFUSIONS:
                if true.startswith(right, j) and seen.startswith(wrong, i) and cost + 1 < best[i + len(wrong)][j + len(right)]:
                    best[i + len(wrong)][j + len(right)] = cost + 1
    return 1 <= best[n][m] <= limit


def _key(line: str) -> str:
    """A header line with numbers masked, case, spaces and glyph confusions undone; numbers at its edges (pages, volumes) go."""
    tokens = ("#" if _DIGITS.match(t) else skeleton("".join(c for c in t if c.isalnum() or c in "@†|!$")) for t in line.lower().split())
    return "" if _NUMBER_LINE.match(line) else "".join(tokens).strip("#")


def _number(text: str) -> int | None:
    digits = text.translate(str.maketrans("OolI|", "00111"))
    return int(digits) if digits.isdigit() else None


def words_of(lines: list[str]) -> tuple[list[str], list[tuple[str, str, str]]]:
    """Distinct lower-case words that stand whole, and the (left, mark, right) of words broken at line ends."""
    words: set[str] = set()
    pairs: list[tuple[str, str, str]] = []
    skip = None
    for k, line in enumerate(lines):
        tokens = _TOKEN.findall(line)
        m = _BREAK.search(line) if line and line.rstrip()[-1:] in HYPHENS else None
        after = _NEXT.match(lines[k + 1]) if m and k + 1 < len(lines) else None
        if skip is not None and tokens:
            tokens = tokens[1:]
        skip = None
        if m and after and after.group(1)[:1].islower():
            pairs.append((m.group(1).lower(), m.group(2), after.group(1).lower()))
            tokens = tokens[:-1]
            skip = k
        for t in tokens:
            t = t.lower()
            kept = t.strip(_TRIM) if t[-1] in _TRIM or t[0] in "'’‘*_~^&#%-–—‐¬" else t
            if t[:1] in "@†|!" and len(t) > 2:
                kept = t.rstrip("!'’*_-–—‐¬")
            if len(kept) > 1:
                words.add(kept)
    return list(words), pairs


def _has_spaced(text: str) -> bool:
    """Whether a word is set in spaced letters; at least two of them stand alone between spaces."""
    return sum(len(w) == 1 for w in text.split(" ")) >= 2 and _SPACED.search(text) is not None


def _facts(lines: list[str]) -> tuple:
    text = " ".join(lines)
    words, pairs = words_of(lines)
    direct = _has_spaced(text) or bool(_DIGIT_NEXT.search(text) and _MISREAD_NUMBER.search(text))
    first, last = lines[0].strip(), lines[-1].strip()
    numbers = []
    for place, line in (("first", first), ("last", last)) if len(lines) > 1 else (("only", first),):
        m = _NUMBER_LINE.match(line)
        if m and (n := _number(m.group(2))) is not None:
            explicit = bool(m.group(1) or m.group(3) or re.match(r"^[-–—]\s*\w+\s*[-–—]$", line))
            numbers.append((place, n, explicit))
        elif e := _NUMBER_EDGE.search(line):
            if (n := _number(e.group(1) or e.group(2))) is not None:
                numbers.append((place + "-edge", n, False))
    return words, pairs, direct, _key(first), len(lines), numbers


_FACT_TYPES = [
    ("words", pa.list_(pa.string())),
    ("pairs", pa.list_(pa.struct([("a", pa.string()), ("mark", pa.string()), ("b", pa.string())]))),
    ("direct", pa.bool_()),
    ("key", pa.string()),
    ("n_lines", pa.int32()),
    ("numbers", pa.list_(pa.struct([("place", pa.string()), ("n", pa.int64()), ("explicit", pa.bool_())]))),
]
_FACT_SCHEMA = (
    "det_id long, data_id string, page int, y double, height double, category_id int, words array<string>, pairs array<struct<a:string,mark:string,b:string>>, "
    "direct boolean, key string, n_lines int, numbers array<struct<place:string,n:bigint,explicit:boolean>>"
)
_TABLE = {
    "det_id": "long", "data_id": "string", "page": "int", "box_id": "int", "category_id": "int", "poly": "array<double>",
    "ptrmfr_texts": "array<string>", "content": "string",
}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[] for _ in _FACT_TYPES]
        for lines in batch.column(6).to_pylist():
            facts = _facts(lines)
            for column, value in zip(out, facts):
                column.append(value)
        out[1] = [[dict(zip(("a", "mark", "b"), p)) for p in ps] for ps in out[1]]
        out[5] = [[dict(zip(("place", "n", "explicit"), p)) for p in ps] for ps in out[5]]
        arrays = [*(batch.column(k) for k in range(6)), *(pa.array(c, t) for c, (_, t) in zip(out, _FACT_TYPES))]
        yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:6], *(n for n, _ in _FACT_TYPES)])


def _lines(detections: DataFrame) -> DataFrame:
    """Detections with their non-blank lines (of content where the list of lines is missing)."""
    df = columns_or_null(detections, _TABLE)
    lines = F.when(F.size("ptrmfr_texts") > 0, F.col("ptrmfr_texts")).otherwise(F.split("content", "\n"))
    df = df.withColumn("lines", F.filter(lines, lambda x: F.trim(x) != ""))
    return df.filter(F.size("lines") > 0)


def scan_facts(detections: DataFrame) -> DataFrame:
    """What each detection's lines show on their own; one narrow pass."""
    y = F.try_element_at("poly", F.lit(2))
    rows = _lines(detections).select("det_id", "data_id", "page", y.alias("y"), (F.try_element_at("poly", F.lit(6)) - y).alias("height"), "category_id", "lines")
    return rows.mapInArrow(_scan, _FACT_SCHEMA)


def vocabulary(facts: DataFrame) -> DataFrame:
    """(word, n): in how many detections each word stands whole."""
    return facts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _skeletons(word: str) -> Column:
    """``skeleton`` as a native expression; no glyph that is written out stands in what others are written out as."""
    single = {chr(c): to for c, to in _FOLD.items() if len(to) == 1}
    folded = F.translate(word, "".join(single), "".join(single.values()))
    for c, to in _FOLD.items():
        if len(to) > 1:
            folded = F.replace(folded, F.lit(chr(c)), F.lit(to))
    return folded


@F.pandas_udf(T.BooleanType())
def _explained(seen, true):
    return seen.combine(true, explains).astype(bool)


def misreadings(vocab: DataFrame) -> DataFrame:
    """(word, right): rare forms, and forms with a glyph inside, with the most frequent form of their skeleton group that explains them."""
    keyed = vocab.filter(F.length("word") >= 3).withColumn("skeleton", _skeletons("word"))
    letters = F.col("word").rlike(r"^[\p{L}'’\-]+$")
    right = keyed.filter(letters & (F.col("n") >= SUPPORT_COUNT)).select("skeleton", F.col("word").alias("right"), F.col("n").alias("n_right"))
    glyph = F.col("word").rlike(_GLYPH_INSIDE) & (F.length(F.regexp_replace("word", r"[^\p{L}]", "")) >= 3) & ~F.col("word").rlike(_PART_NUMBER)
    pairs = keyed.join(right, "skeleton").filter((F.col("word") != F.col("right")) & ((F.col("n") * SUPPORT_RATIO <= F.col("n_right")) | glyph))
    pairs = pairs.filter(_explained("word", "right"))
    return pairs.groupBy("word").agg(F.max_by("right", F.struct("n_right", "right")).alias("right"))


def breaks(facts: DataFrame, vocab: DataFrame) -> DataFrame:
    """(a, mark, b, broken): every distinct line-end pair with the decision whether one word was broken there."""
    pairs = facts.select(F.explode("pairs").alias("p")).groupBy("p.a", "p.mark", "p.b").agg(F.count("*").alias("n_pair"))
    forms = {"joined": F.concat("a", "b"), "hyphened": F.concat_ws("-", "a", "b"), "left": F.col("a"), "right": F.col("b")}
    long = pairs.select("*", F.explode(F.create_map(*[x for k, v in forms.items() for x in (F.lit(k), v)])).alias("form", "word"))
    counted = long.join(vocab, "word", "left").groupBy("a", "mark", "b", "n_pair").agg(
        *[F.max(F.when(F.col("form") == k, F.coalesce("n", F.lit(0)))).alias(k) for k in forms]
    )
    soft = F.col("mark").isin("¬", "­")
    compound = (F.col("hyphened") > 0) | (F.col("n_pair") >= COMPOUND_PAIRS) | ((F.col("left") > 0) & (F.col("right") > 0))
    broken = F.when(F.col("joined") > F.col("hyphened"), True).when(soft & (F.col("joined") >= F.col("hyphened")) & (F.col("n_pair") < COMPOUND_PAIRS), True)
    return counted.select("a", "mark", "b", broken.otherwise(~compound).alias("broken"))


def headers(facts: DataFrame) -> DataFrame:
    """(det_id, alone): detections whose first line is a running header; alone: the line is the whole text.

    A key is an item's own if it comes first in at least HEADER_ROWS of its detections and stands alone at the
    top of a page; it is confirmed if it does so at least once not as a title, caption or formula. The usual height
    of confirmed keys is the item's header level. Headers are the lines alone at the top of a page and on that level
    (so a title below it is none), and body text that begins with an own key. An item without a confirmed key has
    a header where a line alone at the top of a page is one of many items (a journal), or is no title and stands
    on the level most items have. Captions and formulas never are headers by their place. Rows without data_id, page or height are no headers by their place.
    """
    lines = facts.filter(F.length("key") >= 4).select("det_id", "data_id", "page", "y", "height", "category_id", "n_lines", "key")
    tops = facts.groupBy("data_id", "page").agg(F.min("y").alias("top"))
    at_top = (F.col("n_lines") == 1) & (F.col("y") <= F.col("top"))
    lines = lines.join(tops, ["data_id", "page"], "left").withColumn("at_top", F.coalesce(at_top, F.lit(False)))
    keys = lines.groupBy("data_id", "key").agg(
        F.count_distinct("det_id").alias("n_rows"), F.count_if("at_top").alias("n_top"),
        F.count_if(F.col("at_top") & ~F.col("category_id").isin(0, *NO_HEADER)).alias("n_plain"), F.percentile_approx(F.when(F.col("at_top"), F.col("y")), 0.5).alias("y_top")
    )
    known = materialize(keys.filter((F.col("n_rows") >= HEADER_ROWS) & (F.col("n_top") > 0)).select("data_id", "key", "n_top", "n_plain", "y_top"))
    confirmed = known.filter("n_plain > 0")
    levels = confirmed.groupBy("data_id").agg(F.max_by("y_top", F.struct("n_top", -F.col("y_top"))).alias("level"))
    usual = levels.agg(F.percentile_approx("level", 0.5, 1000).alias("usual"))
    journals = confirmed.groupBy("key").agg(F.count("*").alias("n_items")).filter(F.col("n_items") >= JOURNAL_ITEMS).select("key", F.lit(True).alias("journal"))
    marked = (
        lines.join(known.select("data_id", "key", F.lit(True).alias("own")), ["data_id", "key"], "left")
        .join(levels, "data_id", "left")
        .join(broadcast_if_small(materialize(journals)), "key", "left")
        .crossJoin(F.broadcast(usual))  # one row
    )
    own, journal = F.coalesce("own", F.lit(False)), F.coalesce("journal", F.lit(False))
    on = lambda level: F.abs(F.col("y") - F.col(level)) <= F.greatest("height", F.lit(0.0)) / 2
    placed = F.when(F.col("level").isNotNull(), on("level") & (own | ~F.col("category_id").isin(*NO_HEADER))).otherwise(
        on("usual") & (journal | F.col("category_id").isin(1, 2))
    )
    merged = (F.col("n_lines") > 1) & (own | journal) & ~F.col("category_id").isin(0, *NO_HEADER)
    return marked.filter((F.col("at_top") & placed) | merged).select("det_id", (F.col("n_lines") == 1).alias("alone")).distinct()


def page_numbers(facts: DataFrame) -> DataFrame:
    """(det_id, place): printed page numbers; the distance from the page index is the item's usual one, or the form says so."""
    found = facts.select("det_id", "data_id", "page", F.explode("numbers").alias("x")).select("det_id", "data_id", "page", "x.*")
    found = found.withColumn("shift", F.col("n") - F.col("page"))
    shifts = found.groupBy("data_id", "shift").agg(F.count_distinct("page").alias("n_pages"))
    usual = shifts.groupBy("data_id").agg(F.max_by("shift", F.struct("n_pages", F.col("shift") * -1)).alias("usual"), F.max("n_pages").alias("n_pages"))
    regular = (F.col("shift") == F.col("usual")) & (F.col("n_pages") >= 2)
    # a lone number has no distance to compare; on a line of its own a year is more likely
    year = (F.col("place") == "only") & F.col("n").between(1800, 2100)
    lone = (F.col("n_pages") < 2) & (F.col("explicit") | ~year)
    kept = found.join(usual, "data_id").filter(regular | lone)
    return kept.select("det_id", "place").distinct()


def scan_defects(detections: DataFrame) -> DataFrame:
    """(det_id, defect) for the defects hyphen, misread, header and page_number."""
    facts = materialize(scan_facts(detections))
    vocab = materialize(vocabulary(facts))
    wrong = materialize(misreadings(vocab)).select("word")
    cut = materialize(breaks(facts, vocab)).filter("broken").select("a", "mark", "b")
    words = facts.select("det_id", F.explode("words").alias("word")).join(broadcast_if_small(wrong), "word", "left_semi")
    joined = facts.select("det_id", F.explode("pairs").alias("p"))
    mended = joined.select("det_id", F.concat("p.a", "p.b").alias("word")).join(broadcast_if_small(wrong), "word", "left_semi")
    misread = facts.filter("direct").select("det_id").union(words.select("det_id")).union(mended.select("det_id"))
    hyphen = joined.select("det_id", "p.*").join(broadcast_if_small(cut), ["a", "mark", "b"], "left_semi")
    parts = {"hyphen": hyphen, "misread": misread, "header": headers(facts), "page_number": page_numbers(facts)}
    rows = [df.select("det_id", F.lit(name).alias("defect")) for name, df in parts.items()]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3]).distinct()


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for lines, fixes, cuts, drop_first, drop_last in zip(*(batch.column(k).to_pylist() for k in range(6, 11))):
            lines = [x.strip() for x in lines]
            lines = lines[1:] if drop_first else lines
            lines = lines[:-1] if drop_last and lines else lines
            texts.append(repair_lines(lines, dict((f["word"], f["right"]) for f in fixes or []), {(c["a"], c["mark"], c["b"]) for c in cuts or []}))
        names = [*batch.schema.names[:6], "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(6)), pa.array(texts, pa.string())], names=names)


def repair_lines(lines: list[str], fixes: dict[str, str], cuts: set[tuple[str, str, str]]) -> str:
    """One running text: broken words joined, misread words replaced with their case kept, spaced letters closed."""
    out: list[str] = []
    for line in lines:
        end = out[-1] if out else ""
        if end[-1:] and end[-1:] in HYPHENS and (after := _NEXT.match(line)):
            m = _BREAK.search(end)
            if m and (m.group(1).lower(), m.group(2), after.group(1).lower()) in cuts:
                out[-1] = end[: m.start(2)]
                out.append(line)
                continue
            if after.group(1)[:1].islower():
                out.append(line)
                continue
        out += [" ", line] if out else [line]
    text = "".join(out)
    if _has_spaced(text):
        text = _SPACED.sub(lambda m: m.group().replace(" ", ""), text)

    def fix(m: re.Match) -> str:
        word = m.group()
        kept = word.strip(_TRIM) if word.lower() not in fixes else word
        right = fixes.get(kept.lower())
        if not right:
            return word
        cased = right.upper() if kept.isupper() and len(kept) > 1 else right[:1].upper() + right[1:] if kept[:1].isupper() else right
        return word.replace(kept, cased)

    if fixes:
        text = _TOKEN.sub(fix, text)
    if not _DIGIT_NEXT.search(text):
        return text
    return _MISREAD_NUMBER.sub(lambda m: m.group().translate(str.maketrans("OolI|", "00111")), text)


def reflow(detections: DataFrame) -> DataFrame:
    """(data_id, paragraph_no, first_page, text): continuous paragraphs of each item, in reading order.

    Headers and page numbers are dropped, words repaired. A detection goes on with the paragraph
    before it, across boxes and pages, if both are plain text and the former has no sentence end.
    Figures, tables, formulas and discarded regions take no part.
    """
    facts = materialize(scan_facts(detections))
    vocab = materialize(vocabulary(facts))
    wrong, cut = materialize(misreadings(vocab)), materialize(breaks(facts, vocab)).filter("broken").select("a", "mark", "b")
    # what is to be done to a detection, gathered first; it is far smaller than the lines, which are shuffled once
    none = {"fix": "struct<word:string,right:string>", "cut": "struct<a:string,mark:string,b:string>", "head": "boolean", "tail": "boolean"}

    def notes(df: DataFrame, **given) -> DataFrame:
        return df.select("det_id", *[given.get(k, F.lit(None)).cast(t).alias(k) for k, t in none.items()])

    words = facts.select("det_id", F.explode(F.concat("words", F.transform("pairs", lambda p: F.concat(p.a, p.b)))).alias("word")).join(broadcast_if_small(wrong), "word")
    broken = facts.select("det_id", F.explode("pairs").alias("p")).select("det_id", "p.*").join(broadcast_if_small(cut), ["a", "mark", "b"])
    numbers = page_numbers(facts).withColumn("place", F.regexp_replace("place", "-edge", ""))
    todo = (
        notes(words, fix=F.struct("word", "right"))
        .union(notes(broken, cut=F.struct("a", "mark", "b")))
        .union(notes(headers(facts), head=F.lit(True)))
        .union(notes(numbers, head=F.col("place").isin("first", "only"), tail=F.col("place") == "last"))
        .groupBy("det_id")
        .agg(F.collect_set("fix").alias("fixes"), F.collect_set("cut").alias("cuts"), F.max("head").alias("head"), F.max("tail").alias("tail"))
    )
    source = _lines(detections).filter(F.col("category_id").isin(0, 1)).dropDuplicates(["det_id"])
    rows = source.join(todo, "det_id", "left").select(
        "det_id", "data_id", "page", F.coalesce(F.try_element_at("poly", F.lit(2)), F.lit(0.0)).alias("y"), "box_id", "category_id", "lines", "fixes", "cuts",
        F.coalesce("head", F.lit(False)).alias("drop_first"), F.coalesce("tail", F.lit(False)).alias("drop_last"),
    )
    texts = rows.mapInArrow(_repair, "det_id long, data_id string, page int, y double, box_id int, category_id int, text string").filter("text != ''")
    order = W.partitionBy("data_id").orderBy("page", "y", "box_id", "det_id")
    before, kind = F.lag("text").over(order), F.lag("category_id").over(order)
    goes_on = (F.col("category_id") == 1) & (kind == 1) & ~before.rlike(r"[.!?。！？:][\"”»)\]]*$")
    numbered = texts.withColumn("start", F.when(goes_on, 0).otherwise(1)).withColumn("paragraph_no", F.sum("start").over(order))
    # an item's paragraph is a few boxes; only those are gathered
    return numbered.groupBy("data_id", "paragraph_no").agg(
        F.min("page").alias("first_page"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "y", "box_id", "det_id", "text"))), lambda x: x["text"]), " ").alias("text"),
    )


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return scan_defects(table(spark, root, "layout_dets"))


def p6_paragraphs(spark: SparkSession, root: str) -> DataFrame:
    return reflow(table(spark, root, "layout_dets"))


QUERIES = {"p6_found": p6_found, "p6_paragraphs": p6_paragraphs}
SQL: dict[str, str] = {}
