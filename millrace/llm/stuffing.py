"""Keyword-stuffed and link-list pages (p10) by robust Mahalanobis distance per language.

Each text gives six features: the density of characters in links with their captions, tags, stuffed clauses and
priced goods; mark density (tags and list separators); word entropy; repetition (share of stuffed words);
function-word share; and share of words outside sentences. Per language a robust centre and scale (median, MAD)
and one reweighting step give a location and covariance; languages of under LEAST_PAGES pages take those of
all pages. A page is found if its squared distance exceeds the chi-square quantile OUTLIER and its deviation
points the spam way: as a whole (cosine with the spam direction in the metric of the covariance) and in the
density. Words in loops (a phrase repeated back to back) are broken generation, not stuffing.

Null and blank texts have no spam characters and are never flagged; repeated rows give
repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re as standard
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex as re
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.runtime import materialize
from millrace.sources.tables import columns_or_null, table

# Common function words per language.
FUNCTION_WORDS = {
    "en": "the of a an and in to is are was were be by for with on at from this that these each which as it its or not but so than because although while if before after under over than there between our your we has have",
    "de": "der die das den dem des und in im von mit zu zur zum ist sind war nicht auf für ein eine einen einem einer aus bei durch nach über unter zwischen als auch wird werden dass ohne sich hinweg am an",
    "fr": "le la les l d de du des un une et en à au aux dans par pour sur avec est sont ne pas mais plus que qui se ce cette sans pendant entre chez comme malgré",
    "es": "el la los las un una y en de del al a por para con no es son pero más que se su sin durante entre como lo",
    "it": "il lo la i gli le un una e in di del della dei delle nel nella al alla per con non è sono ma più che si senza tra come da dalla l d",
    "pt": "o a os as um uma e em de do da dos das no na nos nas por para com não é são mas mais que se sem durante entre como ao à",
    "nl": "de het een en in van op met voor niet is zijn maar dat die door bij naar over onder tussen als ook wordt zonder na om te tot aan",
}
HAN_FUNCTION = "的了在是与和对被把从也而但并"
#: The features that grow with spam, and those that shrink.
SPAM_SIGN = (1.0, 1.0, -1.0, 1.0, -1.0, 1.0)
#: Least scale of each feature, where most pages share one value.
SCALE_FLOOR = (0.1, 0.1, 0.1, 0.1, 0.1, 0.2)
#: Chi-square quantiles of six features: for the pages that make the location, and for outliers (one in a million).
INNER, OUTLIER = 14.449, 38.258
LEAST_COSINE, LEAST_PAGES = 0.2, 30
STUFFED_UNIT, SPAM_SHARE = 0.4, 0.5
DIMS = len(SPAM_SIGN)

_WORD = standard.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")
_LINK = standard.compile(r"https?://\S+|www\.\S+|\b(?:[\w\-]+\.)+(?:[a-z]{2,8})\b(?:/\S*)?(?<!\be\.g)(?<!\bi\.e)")
_PRICE = standard.compile(r"(?:[£$€]|\b(?:EUR|USD|GBP)\b)\s?\d[\d.,]*|\b\d[\d.,]*\s?(?:€|EUR\b|USD\b)")
_CURRENCIES = ("£", "$", "€", "EUR", "USD", "GBP")
_DOTTED = standard.compile(r"\.[a-z]{2}|www\.")
_TAG = standard.compile(r"(?<!\S)#\w{3,}")
_MARKDOWN_LINK = standard.compile(r"\[([^\]\n]*)\]\([^)\n]*\)")
_SENTENCE = re.compile(r"(?<=[.!?])\s+(?=\p{Lu})|(?<=[。！？])|\n")
_CLAUSE = re.compile(r"\s*[,;:|/·•»«›→、，；]\s*|\s+[-–—]\s+")
_EXEMPT = re.compile(
    r"\s*\[\d+\]\s|.*\.{4,}\s*\d+\s*$|\s*(?:key\s?words?|index terms|schlagw\w+|mots[- ]cl\w+|palabras clave|parole chiave|palavras-chave|trefwoorden|关键词)\b|\s*\#{1,6}\s?[^#\n]*$|[^\d\n]{1,60}[ ,]\d{1,4}(?:[-–]\d+)?(?:, ?\d{1,4}(?:[-–]\d+)?)*\s*$|\s*={4,}",
    re.IGNORECASE,
)
_HAN_PHRASE = re.compile(r"\p{Han}{7,}|[" + HAN_FUNCTION + "]")
FUNCTION_OF = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in _words.split():
        FUNCTION_OF.setdefault(_w, []).append(_lang)


def _loops(ids: np.ndarray) -> np.ndarray:
    """Words inside a phrase of up to eight words that follows itself at least three times more."""
    n = len(ids)
    out = np.zeros(n, bool)
    for p in range(1, 9):
        if n < 4 * p:
            break
        equal = ids[p:] == ids[:-p]
        if np.count_nonzero(equal) < 3 * p:
            continue
        turn = np.flatnonzero(np.diff(np.concatenate(([0], equal.astype(np.int8), [0]))))
        for a, b in zip(turn[::2], turn[1::2]):
            if b - a >= 3 * p:
                out[a : b + p] = True
    return out


def _contexts(items: np.ndarray, around: np.ndarray) -> np.ndarray:
    """For each position the number of distinct surroundings its item has in the text."""
    _, at = np.unique(items * np.uint64(0x9E3779B97F4A7C15) ^ around * np.uint64(0xC2B2AE3D27D4EB4F), return_index=True)
    found, number = np.unique(items[at], return_counts=True)
    return number[np.searchsorted(found, items)]


def _sentence_like(words: list[str]) -> bool:
    return len(words) >= 5 and sum(w in FUNCTION_OF for w in words) >= max(2, 0.15 * len(words))


def page_features(text: str | None) -> tuple[str | None, tuple[float, ...], float]:
    """Language by function words (null if none stand out), features, and the share of spam characters."""
    text = text or ""
    size = len(text) - text.count(" ")
    low = text.lower()
    links = [m.span() for m in _LINK.finditer(text)] if "://" in text or _DOTTED.search(text) else []
    bare = _LINK.sub(" ", low) if links else low
    words = _WORD.findall(bare)
    n = len(words)
    if n + len(links) < 5 or not size:  # too short for statistics, but may be two links, tags or goods
        several = len(links) > 1 or text.count("#") > 1 or any(c in text for c in _CURRENCIES)
        spam = _spam_share(text, set(), set()) if size and several else 0.0
        return None, (spam, 0.0, 1.0 - spam, spam, 0.3 * (1 - spam), spam), spam
    hits: Counter = Counter()
    counts = Counter(words)
    function = 0
    for w in counts.keys() & FUNCTION_OF.keys():
        function += counts[w]
        for lang in FUNCTION_OF[w]:
            hits[lang] += counts[w]
    han = 0 if text.isascii() or max(text) < "\u2e80" else len(re.findall(r"\p{Han}", text))
    if han > 0.3 * size:
        lang = "zh"
        function = sum(k for w, k in counts.items() if any(c in HAN_FUNCTION for c in w))
    else:
        lang = hits.most_common(1)[0][0] if hits and function >= max(3, 0.08 * n) else None
    known = {w: i for i, w in enumerate(counts)}
    ids = np.array([known[w] for w in words], np.int64)
    content = np.array([w not in FUNCTION_OF for w in counts], bool)
    if lang == "zh":
        content &= ~np.array([bool(_HAN_PHRASE.search(w)) for w in counts], bool)
    loop = _loops(ids) if n >= 4 else np.zeros(n, bool)
    live = ~loop
    stuffed, listed = np.zeros(n, bool), np.zeros(n, bool)
    if n >= 8:
        # stuffing sets the same words into ever new contexts; copied sentences keep theirs
        size_v = np.uint64(len(counts) + 1)
        wide = np.concatenate(([size_v - np.uint64(1)], ids.astype(np.uint64), [size_v - np.uint64(1)]))
        tally = np.bincount(ids[live], minlength=len(counts))  # an item has no more contexts than occurrences
        single = content[ids] & live
        frequent = single & (tally >= max(4, 0.025 * n))[ids]
        if frequent.any():
            contexts = _contexts(wide[1:-1][frequent], wide[:-2][frequent] * size_v + wide[2:][frequent])
            stuffed[np.flatnonzero(frequent)[contexts >= max(4, 0.025 * n)]] = True
        common = single & (tally >= max(3, 0.008 * n))[ids]
        pair_ok = common[:-1] & common[1:]
        if pair_ok.any():
            pair = wide[1:-2] * size_v + wide[2:-1]
            contexts = _contexts(pair[pair_ok], wide[:-3][pair_ok] * size_v + wide[3:][pair_ok])
            often = np.flatnonzero(pair_ok)[contexts >= max(3, 0.008 * n)]
            stuffed[often] = True
            stuffed[often + 1] = True
        # the same for terms with function words inside, looked for in short list items only
        terms = np.flatnonzero(single)
        if len(terms) > 2:
            t = np.concatenate(([size_v - np.uint64(1)], ids[terms].astype(np.uint64), [size_v - np.uint64(1)]))
            both = np.flatnonzero(common[terms[:-1]] & common[terms[1:]])
            if len(both):
                contexts = _contexts(t[1:-2][both] * size_v + t[2:-1][both], t[:-3][both] * size_v + t[3:][both])
                often = both[contexts >= max(3, 0.008 * n)]
                listed[terms[often]] = True
                listed[terms[often + 1]] = True
    tags = _TAG.findall(text) if "#" in text else []
    marks = len(tags) + sum(text.count(c) for c in "|»·•")
    freq = np.fromiter(counts.values(), float, len(counts)) / max(n, 1)
    entropy = float(-(freq * np.log(freq)).sum() / math.log(n)) if n > 1 else 1.0
    listed |= stuffed
    share = float(stuffed.mean()) if n else 0.0
    function_share = function / max(n, 1)
    # without a listed word, a link, two tags and a price no line can count
    spam = 0.0
    if listed.any() or links or len(tags) >= 2 or any(c in text for c in _CURRENCIES):
        spam = _spam_share(text, {words[i] for i in np.flatnonzero(stuffed)}, {words[i] for i in np.flatnonzero(listed)})
    outside = 1.0 - min(1.0, function_share / 0.25)
    return lang, (spam, marks / max(n + len(links), 1), entropy, share, function_share, outside), spam


def _spam_share(text: str, stuffed: set[str], listed: set[str]) -> float:
    """Share of characters in links with their captions, tags and stuffed clauses."""
    total = spam = 0
    linked = "://" in text or _DOTTED.search(text) is not None
    priced = any(c in text for c in _CURRENCIES)
    # a sentence counts by a stuffed word or two listed ones, so one in which no such word stands is passed over
    named = standard.compile("|".join(map(standard.escape, sorted(listed)))) if listed else None
    for line in text.split("\n"):
        line = line.strip()
        if not line:
            continue
        total += len(line)
        has_tags = "#" in line
        if not (linked or priced or has_tags) and (named is None or not named.search(line.lower())):
            continue
        found = linked and _LINK.search(line)
        if not found and _EXEMPT.match(line):
            continue
        flat = _MARKDOWN_LINK.sub(r"\1 http://x.example", line) if "](" in line else line
        if found or flat is not line and _LINK.search(flat):
            spam += _linked_chars(line, flat, stuffed, listed)
            continue
        tags = _TAG.findall(line) if has_tags else []
        if len(tags) >= 2:
            spam += sum(map(len, tags)) + len(tags)
            line = _TAG.sub(" ", line)
        if priced and _PRICE.search(line) and line[-1] not in ".!?" and len(_WORD.findall(line)) <= 10:
            spam += len(line)  # a good with its price
            continue
        if named is None:
            continue
        for sentence in _SENTENCE.split(line):
            low = sentence.lower()
            if named.search(low):
                spam += _keyword_chars(sentence, low, stuffed, listed)
    return spam / total if total else 0.0


def _linked_chars(line: str, flat: str, stuffed: set[str], listed: set[str]) -> int:
    """Characters of a line with links that are links or their captions; a sentence that cites a link has none."""
    spam = 0
    parts = re.split(r"(?<=[.!?])\s+(?=\p{Lu})", flat)
    for part in parts:
        words = _WORD.findall(_LINK.sub(" ", part).lower())
        m = list(_LINK.finditer(part))
        if not m:
            spam += _keyword_chars(part, part.lower(), stuffed, listed)
            continue
        ends = part.rstrip()
        in_sentence = _sentence_like(words) and m[-1].end() < len(ends) - 3 and ends[-1:] in ".!?" and m[0].start() > 8
        if not in_sentence:
            spam += len(line) if len(parts) == 1 else len(part)
        elif sum(w in stuffed for w in words) >= STUFFED_UNIT * len(words):
            spam += len(part)
    return min(spam, len(line))


def _keyword_chars(sentence: str, low: str, stuffed: set[str], listed: set[str]) -> int:
    """Characters of the clauses that are stuffed keywords, or of the whole sentence if most of it is."""
    words = _WORD.findall(low)
    if not words:
        return 0
    hit = sum(w in stuffed for w in words)
    function = sum(w in FUNCTION_OF for w in words)
    if hit >= STUFFED_UNIT * len(words):
        # a sentence around keywords names them over and over; a copied sentence names each word once
        if function <= 0.1 * len(words) or hit >= 0.45 * len(words) and hit >= 1.25 * len({w for w in words if w in stuffed}):
            return len(sentence)
    if sum(w in listed for w in words) < 2:
        return 0
    spam = 0
    for clause in _CLAUSE.split(sentence):
        inner = _WORD.findall(clause.lower())
        if not inner:
            continue
        own = [w for w in inner if w not in FUNCTION_OF]
        if len(own) == len(inner) and sum(w in stuffed for w in inner) >= STUFFED_UNIT * len(inner):
            spam += len(clause) + 2
        elif len(inner) <= 6 and inner[0] not in FUNCTION_OF and len(inner) - len(own) <= 1 and sum(w in listed for w in own) >= 0.5 * len(own):
            spam += len(clause) + 2
    return min(spam, len(sentence))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [page_features(t) for t in batch.column(2).to_pylist()]
        lang = [g[0] or given or "en" for g, given in zip(got, batch.column(1).to_pylist())]
        x = np.array([g[1] for g in got], float).reshape(-1, DIMS)
        columns = [batch.column(0), pa.array(lang, pa.string()), *(pa.array(x[:, j]) for j in range(DIMS))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "language", *(f"x{j}" for j in range(DIMS))])


def spam_features(documents: DataFrame) -> DataFrame:
    """doc_id, language and the six features x0 (density) to x5; one narrow pass."""
    df = columns_or_null(documents, {"doc_id": "long", "lang": "string", "text": "string"})
    return df.mapInArrow(_features, "doc_id long, language string, " + ", ".join(f"x{j} double" for j in range(DIMS)))


def robust_location(features: DataFrame) -> DataFrame:
    """One row per language: location and inverse covariance after one reweighting step from median and MAD.

    Three partial aggregations over all rows; a language's statistics are a few dozen numbers.
    """
    xs = [f"x{j}" for j in range(DIMS)]
    medians = features.groupBy("language").agg(*[F.percentile_approx(x, 0.5, 1000).alias(f"m{j}") for j, x in enumerate(xs)])
    centred = features.join(F.broadcast(medians), "language")
    mads = centred.groupBy("language").agg(
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{j}")), 0.5, 1000).alias(f"s{j}") for j, x in enumerate(xs)]
    )
    scaled = centred.join(F.broadcast(mads), "language")
    z2 = sum(
        ((F.col(x) - F.col(f"m{j}")) / F.greatest(F.col(f"s{j}") * 1.4826, F.lit(SCALE_FLOOR[j]))) ** 2 for j, x in enumerate(xs)
    )
    inner = scaled.filter(z2 <= INNER)
    products = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
    sums = inner.groupBy("language").agg(
        F.count("*").alias("n"),
        *[F.avg(x).alias(f"a{j}") for j, x in enumerate(xs)],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in products],
    )

    def invert(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for r in frame.to_dict("records"):
                cov = np.zeros((DIMS, DIMS))
                for i, j in products:
                    cov[i, j] = cov[j, i] = r[f"c{i}_{j}"]
                floor = np.array(SCALE_FLOOR)
                cov += np.diag(floor**2)  # keeps it regular where features are constant or collinear
                rows.append((r["language"], int(r["n"]), [float(r[f"a{j}"]) for j in range(DIMS)], np.linalg.inv(cov).ravel().tolist(), np.sqrt(np.diag(cov)).tolist()))
            yield pd.DataFrame(rows, columns=["language", "n", "centre", "inverse", "scale"])

    return sums.mapInPandas(invert, "language string, n long, centre array<double>, inverse array<double>, scale array<double>")


def spam_scores(documents: DataFrame) -> DataFrame:
    """doc_id, language, distance (squared), direction (cosine), spam_share (the density) and flagged, for every document."""
    features = materialize(spam_features(documents))
    own = robust_location(features).filter(F.col("n") >= LEAST_PAGES)
    every = robust_location(features.withColumn("language", F.lit("*")))
    places = ("centre", "inverse", "scale")
    scored = features.join(F.broadcast(own), "language", "left").join(
        F.broadcast(every.select(*[F.col(c).alias(f"{c}_all") for c in places])), F.lit(True), "left"  # one row, or none
    )
    scored = scored.withColumns({c: F.coalesce(c, f"{c}_all") for c in places})
    dev = [F.col(f"x{j}") - F.element_at("centre", j + 1) for j in range(DIMS)]
    toward = [SPAM_SIGN[j] * F.element_at("scale", j + 1) for j in range(DIMS)]
    form = lambda u, v: sum(u[i] * v[j] * F.element_at("inverse", i * DIMS + j + 1) for i in range(DIMS) for j in range(DIMS))
    scored = scored.select("doc_id", "language", F.col("x0").alias("spam_share"), form(dev, dev).alias("distance"), form(dev, toward).alias("along"), form(toward, toward).alias("norm"), (dev[0] / F.element_at("scale", 1)).alias("denser"))
    cosine = F.col("along") / F.sqrt(F.greatest(F.col("distance") * F.col("norm"), F.lit(1e-12)))
    out = scored.select("doc_id", "language", "distance", cosine.alias("direction"), "spam_share", "denser")
    return out.withColumn("flagged", (F.col("distance") > OUTLIER) & (F.col("direction") > LEAST_COSINE) & (F.col("denser") > 1)).drop("denser")


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return spam_scores(table(spark, root, "documents")).filter("flagged").select("doc_id").distinct()


def p10_scores(spark: SparkSession, root: str) -> DataFrame:
    return spam_scores(table(spark, root, "documents"))


QUERIES = {"p10_found": p10_found, "p10_scores": p10_scores}
SQL: dict[str, str] = {}
