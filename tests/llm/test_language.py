"""Labels, sentences, and held-out accuracy of the compression judge."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.llm.language import Judge, fit_dictionaries, label_language, language_segments, document_languages, mislabelled, sentences

PARTS = {
    "en": ("The old house|A small river|This new engine|The quiet garden", "stands behind|slowly crosses|clearly shows|never reaches", "the wide valley|each of the towers|this cold morning|the market in the town"),
    "de": ("Das alte Haus|Ein kleiner Fluss|Die neue Maschine|Der stille Garten", "steht hinter|kreuzt langsam|zeigt deutlich|erreicht nie", "das weite Tal|jeden der Türme|diesen kalten Morgen|den Markt in der Stadt"),
    "fr": ("La vieille maison|Une petite rivière|Cette nouvelle machine|Le jardin calme", "se trouve derrière|traverse lentement|montre clairement|n'atteint jamais", "la large vallée|chacune des tours|ce matin froid|le marché dans la ville"),
}


def text(lang, seed, n):
    r = random.Random(seed)
    return " ".join(" ".join(r.choice(p.split("|")) for p in PARTS[lang]) + f" {r.choice('abcdef')}{r.randint(1, 99)}." for _ in range(n))


@pytest.fixture(scope="module")
def fitted():
    noisy = [(lang if i % 7 else "de", text(lang, i, 12)) for i in range(60) for lang in PARTS]
    return fit_dictionaries(noisy)


def test_held_out_accuracy(fitted):
    judge, right, total = Judge(fitted), 0, 0
    for lang in PARTS:
        for s in sentences(text(lang, 999, 100)):
            right += judge(s)[0] == lang
            total += 1
    assert right / total > 0.97


def test_what_counts_as_a_sentence():
    got = sentences("#Title\nA title line\n[1] A. Smith. Some cited work. J. Hist.\nThis is a sentence of the text. He said “Dies ist nur ein Zitat im Text.” and left the old house.\nKeywords: a; b")
    assert all("Zitat" not in s and "Smith" not in s and "Keywords" not in s for s in got) and len(got) >= 1
    assert sentences(None) == sentences(" \n") == []
    assert sentences("no full sentence here\nbut two lines") == ["no full sentence here", "but two lines"]


def test_labels(spark):
    want = {"en-GB": "en", "ENG": "en", "Deutsch": "de", "français": "fr", "中文": "zh", "zh_CN": "zh", " pt-BR ": "pt", "und": None, "": None, "n/a": None, None: None, "other": None}
    df = spark.createDataFrame([(k,) for k in want], "label string").withColumn("found", label_language(F.col("label")))
    assert {r.label: r.found for r in df.collect()} == want


def test_documents_segments_and_cases(spark, fitted):
    mixed = text("en", 1, 5) + "\n\n" + text("fr", 2, 4) + "\n\n" + text("de", 3, 1)
    rows = [(1, text("en", 5, 6)), (2, mixed), (3, text("de", 6, 1)), (4, None), (5, " "), (1, text("en", 5, 6)), (6, text("fr", 7, 4000))]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string")
    got = {(r.doc_id, r.lang) for r in document_languages(docs, fitted).collect()}
    assert got == {(1, "en"), (2, "en"), (2, "fr"), (3, "de"), (6, "fr")}
    runs = [(r.segment_no, r.lang) for r in language_segments(docs, fitted).filter("doc_id = 2").orderBy("segment_no").collect()]
    assert runs == [(0, "en"), (1, "fr"), (2, "de")]
    assert document_languages(docs.limit(0), fitted).count() == 0
    labels = spark.createDataFrame([(1, "de"), (2, "en"), (3, "deu"), (3, "deu"), (6, "und")], "doc_id long, language string")
    train = [(100 + i, text(lang, i, 12), lang) for i, lang in enumerate(list(PARTS) * 30)]
    both = docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang")).union(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    cases = {(r.doc_id, r.lang) for r in mislabelled(both, labels).filter("doc_id < 100").collect()}
    assert cases == {(1, "en"), (2, "en"), (2, "fr"), (6, "fr")}


def test_long_quotations_are_no_sentences():
    from millrace.llm.language import sentences

    quoted = "Das ist ein langer Satz aus einer anderen Quelle. " * 60
    for a, b in ("“”", "„“", "«»", "»«", '""'):
        assert sentences(f"The plain text says little about it. They wrote {a}{quoted}{b} and went on.") == ["The plain text says little about it.", "They wrote   and went on."]
