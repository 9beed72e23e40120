"""Document and segment languages by compression (p5).

A sentence is encoded with one zstandard raw-content dictionary per language; the language whose
dictionary gives the smallest code wins, and the sentence is left open if the runner-up is close.
Dictionaries are built from a bounded sample of labelled documents (SAMPLE_PER_LABEL texts a label
of at most SAMPLE_CHARS characters each); as labels are noisy, only sentences whose function words
agree with the label are used, and cross-fitting drops those the other half's dictionaries reject.

Sentences are counted over the whole text without reference entries, header lines and quotations.
Null and blank texts have no languages; texts without a full sentence are judged by their lines;
repeated rows are judged each; an empty table gives an empty result (and empty dictionaries).
"""

from __future__ import annotations

import re as standard
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex as re
import zstandard as zs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.runtime import broadcast_if_small, materialize
from millrace.llm.stuffing import FUNCTION_OF, SPAM_SHARE, page_features
from millrace.sources.tables import columns_or_null, table

LANGUAGES = ("en", "de", "fr", "es", "it", "pt", "nl", "zh")
SAMPLE_PER_LABEL, SAMPLE_CHARS = 200, 20_000
DICTIONARY_BYTES = 24_000
ROUNDS = 2
MARGIN = 0.05
LEVEL = 3
LEAST_SENTENCES = 3

# How labels name a language, besides its two-letter code with or without a region.
LABEL_NAMES = {
    "en": "eng english englisch anglais inglés inglese inglês engels 英文 英语",
    "de": "deu ger german deutsch allemand alemán tedesco alemão duits 德文 德语",
    "fr": "fra fre french französisch français francais francés francese francês frans 法文 法语",
    "es": "spa spanish spanisch espagnol español espanol castellano castilian spagnolo espanhol spaans 西班牙文 西班牙语",
    "it": "ita italian italienisch italien italiano italiaans 意大利文 意大利语",
    "pt": "por portuguese portugiesisch portugais portugués portoghese português portugues portugees 葡萄牙文 葡萄牙语",
    "nl": "nld dut dutch niederländisch néerlandais neerlandés olandese holandês nederlands flemish vlaams 荷兰文 荷兰语",
    "zh": "zho chi chinese chinesisch chinois chino cinese chinês chinees mandarin 中文 汉语 漢語 普通话 cmn",
}

_REFERENCE = re.compile(r"\s*(?:\[\d+\]|\(\d+\)\s+\p{Lu}\.|\d+\.\s+\p{Lu}\. \p{Lu})")
# a quotation of any length on its line; as it holds no further opening mark, the search is linear
_QUOTE = re.compile(r"“[^“”\n]*”|„[^„“”\n]*[“”]|«[^«»\n]*»|»[^«»\n]*«|「[^「」\n]*」|(?<!\w)\"[^\"\n]*\"(?!\w)|(?<!\w)‘[^‘’\n]*’(?!\w)")
_END = standard.compile(r"(?<=[.!?])[\"”»]?\s+|(?<=[。！？])")
_TERMINAL = ".!?。！？"
_LINK = re.compile(r"https?://\S+")
_HAN = re.compile(r"\p{Han}")
_LETTER = re.compile(r"\p{L}")
_TOKEN = re.compile(r"\p{L}+")


def label_language(column):
    """A label as one of LANGUAGES, or null: codes of two or three letters, regions, and names."""
    flat = F.lower(F.trim(column))
    head = F.regexp_extract(flat, r"^([^\-_;,/ (]+)", 1)
    pairs = [F.lit(x) for lang, names in LABEL_NAMES.items() for name in (lang, *names.split()) for x in (name, lang)]
    return F.try_element_at(F.create_map(*pairs), head)


def sentences(text: str | None) -> list[str]:
    """Sentences of the running text; of a text without any, its lines; of bare reference lists, those."""
    if not text or not text.strip():
        return []
    out: list[str] = []
    rest: list[str] = []
    entries: list[str] = []
    for line in text.split("\n"):
        line = line.strip()
        if not line or line[0] == "#" or line[0] == "=":
            continue
        if _REFERENCE.match(line):
            entries.append(line)
            continue
        if "http" in line:
            line = _LINK.sub(" ", line)
        if any(q in line for q in "“„«»「\"‘"):
            line = _QUOTE.sub(" ", line)
        for part in _END.split(line):
            part = part.strip()
            if len(part) < 4 or not _LETTER.search(part):
                continue
            if part[-1] in _TERMINAL and (len(part) >= 20 or _HAN.search(part)):
                out.append(part)
            else:
                rest.append(part)
    return out or entries and len(entries) > len(rest) and entries or [x for x in rest if len(x) >= 8] or rest


class Judge:
    """One compressor per language; made once in each Python worker."""

    _made: dict[int, Judge] = {}

    def __init__(self, dictionaries: dict[str, bytes]):
        self.coders = []
        for lang, raw in sorted(dictionaries.items()):
            if len(raw) >= 8:
                d = zs.ZstdCompressionDict(raw, dict_type=zs.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(LEVEL)
                coder = zs.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
                self.coders.append((lang, coder.compress))
        self.latin = [c for c in self.coders if c[0] != "zh"]

    @classmethod
    def of(cls, dictionaries: dict[str, bytes]) -> Judge:
        key = hash(tuple(sorted(dictionaries.items())))
        if key not in cls._made:
            cls._made.clear()
            cls._made[key] = cls(dictionaries)
        return cls._made[key]

    def __call__(self, sentence: str) -> tuple[str | None, float]:
        """The language with the smallest code, and by how much of its size the runner-up is larger."""
        if not self.coders:
            return None, 0.0
        raw = sentence.encode("utf-8", "replace")
        # a text in one script is not encoded with the dictionary of the other: nothing in it would match
        coders = self.latin if len(raw) == len(sentence) or not _HAN.search(sentence) else self.coders
        sizes = [len(code(raw)) for _, code in coders]
        if not sizes:
            return None, 0.0
        best = min(sizes)
        lang = coders[sizes.index(best)][0]
        sizes.remove(best)
        margin = 1 - best / min(sizes) if sizes else 1.0
        return (lang if margin >= MARGIN else None), margin


def _fit(sentence_lists: dict[str, list[str]]) -> dict[str, bytes]:
    """Dictionaries of like size from distinct sentences; the end of a dictionary is the cheapest to refer to."""
    out = {}
    for lang, found in sentence_lists.items():
        raw = b"\n".join(s.encode("utf-8", "replace") for s in dict.fromkeys(found))
        out[lang] = raw[:DICTIONARY_BYTES]
    return out


def _seed_language(sentence: str) -> str | None:
    """The language whose function words stand out in a sentence; it only cleans the training sample."""
    if len(_HAN.findall(sentence)) > 0.3 * len(sentence):
        return "zh"
    hits: Counter = Counter(lang for w in _TOKEN.findall(sentence.lower()) for lang in FUNCTION_OF.get(w, ()))
    ranked = hits.most_common(2)
    if not ranked or ranked[0][1] < 2 or len(ranked) > 1 and ranked[1][1] == ranked[0][1]:
        return None
    return ranked[0][0]


def fit_dictionaries(sample: list[tuple[str, str]]) -> dict[str, bytes]:
    """Dictionaries from (label, text) pairs.

    Only sentences whose function words agree with the label are used. Cross-fitting then drops those
    that the other half's dictionaries judge to be of another language.
    """
    halves: list[list[tuple[str, str]]] = [[], []]
    for i, (label, text) in enumerate(sample):
        halves[i % 2] += [(label, s) for s in sentences(text) if _seed_language(s) == label]
    for _ in range(ROUNDS):
        judges = []
        for half in halves:
            by: dict[str, list[str]] = {}
            for label, s in half:
                by.setdefault(label, []).append(s)
            judges.append(Judge(_fit(by)))
        halves = [[(label, s) for label, s in half if judges[1 - h](s)[0] in (label, None)] for h, half in enumerate(halves)]
    by = {}
    for label, s in halves[0] + halves[1]:
        by.setdefault(label, []).append(s)
    return _fit(by)


def train(documents: DataFrame) -> dict[str, bytes]:
    """Fit on the bounded sample: per label the texts with the smallest hashes of their ids."""
    docs = columns_or_null(documents, {"doc_id": "long", "lang": "string", "text": "string"})
    narrow = docs.filter(F.col("lang").isin(*LANGUAGES) & F.length("text").between(100, SAMPLE_CHARS)).select("doc_id", "lang")
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = narrow.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= SAMPLE_PER_LABEL)
    rows = docs.join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_semi").select("doc_id", "lang", "text").collect()
    seen = {r.doc_id: (r.lang, r.text) for r in rows}
    return fit_dictionaries([seen[k] for k in sorted(seen)])


def _judged(dictionaries: dict[str, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge.of(dictionaries)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                votes: Counter = Counter()
                margins: Counter = Counter()
                known: dict[str, tuple] = {}
                n = 0
                for s in sentences(text):
                    if s not in known:
                        known[s] = judge(s)
                    lang, margin = known[s]
                    n += 1
                    if lang is not None:
                        votes[lang] += 1
                        margins[lang] += margin
                for lang, k in votes.items():
                    out.append((doc_id, lang, k, n, k / n, margins[lang] / k))
            columns = list(zip(*out)) if out else [()] * 6
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            names = ["doc_id", "lang", "n_sentences", "n_all", "confidence", "margin"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def sentence_votes(documents: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """Per document and language: sentences, their share of all sentences (confidence) and mean margin."""
    docs = columns_or_null(documents, {"doc_id": "long", "text": "string"}).filter("text is not null")
    schema = "doc_id long, lang string, n_sentences long, n_all long, confidence double, margin double"
    return docs.mapInArrow(_judged(dictionaries), schema)


def document_languages(documents: DataFrame, dictionaries: dict[str, bytes] | None = None) -> DataFrame:
    """The languages that count: those of at least three sentences; without any, the most frequent."""
    votes = sentence_votes(documents, train(documents) if dictionaries is None else dictionaries).distinct()
    by = W.partitionBy("doc_id").orderBy(F.desc("n_sentences"), F.desc("margin"), "lang")
    ranked = votes.withColumn("rank", F.row_number().over(by))
    return ranked.filter((F.col("n_sentences") >= LEAST_SENTENCES) | (F.col("rank") == 1))


def _segments(dictionaries: dict[str, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge.of(dictionaries)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                runs: list[list] = []
                for s in sentences(text):
                    lang, margin = judge(s)
                    if lang is None and runs:
                        lang = runs[-1][0]  # an open sentence goes with the one before it
                    if runs and runs[-1][0] == lang:
                        runs[-1][1] += 1
                        runs[-1][2] += margin
                        runs[-1][3] += len(s)
                    elif lang is not None:
                        runs.append([lang, 1, margin, len(s)])
                out += [(doc_id, i, lang, k, chars, m / k) for i, (lang, k, m, chars) in enumerate(runs)]
            columns = list(zip(*out)) if out else [()] * 6
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64())
            names = ["doc_id", "segment_no", "lang", "n_sentences", "n_chars", "confidence"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def language_segments(documents: DataFrame, dictionaries: dict[str, bytes] | None = None) -> DataFrame:
    """Runs of sentences in one language, in text order, with their mean margin as confidence."""
    dictionaries = train(documents) if dictionaries is None else dictionaries
    docs = columns_or_null(documents, {"doc_id": "long", "text": "string"}).filter("text is not null")
    schema = "doc_id long, segment_no long, lang string, n_sentences long, n_chars long, confidence double"
    return docs.mapInArrow(_segments(dictionaries), schema)


def mislabelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, lang) of documents whose label names no language or another one, or whose text has several."""
    found = materialize(document_languages(documents))
    labels = columns_or_null(labels, {"doc_id": "long", "language": "string"})
    named = labels.groupBy("doc_id").agg(F.collect_set(label_language(F.col("language"))).alias("named"))
    per = found.groupBy("doc_id").agg(F.collect_set("lang").alias("langs")).join(named, "doc_id", "left")
    right = (F.size("langs") == 1) & (F.size("named") == 1) & F.arrays_overlap("langs", "named")
    cases = materialize(per.filter(~F.coalesce(right, F.lit(False))).select("doc_id", "langs"))
    # stuffed pages are another problem; the exact share is taken of the cases only
    docs = columns_or_null(documents, {"doc_id": "long", "text": "string"})
    texts = docs.join(broadcast_if_small(cases.select("doc_id")), "doc_id", "left_semi")

    def stuffed(batches):
        for batch in batches:
            hit = [page_features(t)[2] > SPAM_SHARE for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(hit, pa.bool_()))], names=["doc_id"])

    spam = texts.mapInArrow(stuffed, "doc_id long")
    return cases.join(spam, "doc_id", "left_anti").select("doc_id", F.explode("langs").alias("lang"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return mislabelled(table(spark, root, "documents"), table(spark, root, "tei_meta"))


def p5_languages(spark: SparkSession, root: str) -> DataFrame:
    return document_languages(table(spark, root, "documents"))


def p5_segments(spark: SparkSession, root: str) -> DataFrame:
    return language_segments(table(spark, root, "documents"))


QUERIES = {"p5_found": p5_found, "p5_languages": p5_languages, "p5_segments": p5_segments}
SQL: dict[str, str] = {}
