"""Stuffed pages against ordinary ones, and the robust statistics."""

import random

from millrace.llm.stuffing import page_features, robust_location, spam_features, spam_scores

NOUNS = "river stone valley forest engine window market garden planet signal copper winter".split()
VERBS = "moves shows holds turns keeps meets".split()


def prose(seed, n=12):
    r = random.Random(seed)
    return " ".join(f"The {r.choice(NOUNS)} of the {r.choice(NOUNS)} {r.choice(VERBS)} in a {r.choice(NOUNS)} and {r.choice(VERBS)} with {seed}." for _ in range(n))


def keywords(seed, n=40):
    r = random.Random(seed)
    return ", ".join(f"{r.choice(['cheap', 'best', 'new', 'top', 'online'])} {r.choice(['green tea', 'desk lamp'])} {r.choice(NOUNS)}" for _ in range(n))


def share(text):
    return page_features(text)[2]


def test_kinds_of_pages():
    links = "\n".join(f"- [desk lamp {i}](https://a{i}.example/x)" for i in range(9))
    goods = "\n".join(f"NEW desk lamp EUR {i}.20 add to cart" for i in range(9))
    tags = " ".join(f"#tea_{i}" for i in range(20))
    for spam in (keywords(1), keywords(2).replace(", ", " "), links, goods, tags):
        assert share(spam) > 0.8, spam
    cited = " ".join(f"The data of the valley are kept at https://a{i}.example/x and shown there." for i in range(9))
    contents = "\n".join(f"{i}.1 The {n} of the river ........ {i}" for i, n in enumerate(NOUNS))
    index = "\n".join(f"{n}, {m} 12, 1{i}" for i, (n, m) in enumerate(zip(NOUNS, reversed(NOUNS))))
    references = "\n".join(f"[{i}] A. Smith. The {n}. J. Hist. 5 (1990), 3-4. https://a.example" for i, n in enumerate(NOUNS))
    loop = prose(3) + " near neutral" * 200
    for fine in (prose(4), cited, contents, index, loop, prose(5) * 6, None, "", "x", "的" * 500):
        assert share(fine) < 0.3, fine
    assert share(references) <= 1.0


def test_flags_and_awkward_rows(spark):
    rows = [(i, "en", prose(i), "x") for i in range(60)] + [(100 + i, "en", keywords(i), "x") for i in range(5)]
    rows += [(100, "en", keywords(0), "x"), (200, None, None, "x"), (None, None, "", "x"), (201, "en", prose(1) * 500, "x")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, language string")
    got = spam_scores(df)
    assert got.count() == len(rows)
    assert sorted(r.doc_id for r in got.filter("flagged and spam_share > 0.5").collect()) == [100, 100, 101, 102, 103, 104]
    assert spam_scores(df.limit(0)).count() == 0


def test_location_is_robust(spark):
    rows = [(i, "en", prose(i)) for i in range(80)] + [(100 + i, "en", keywords(i) + prose(i, 2)) for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    clean = robust_location(spam_features(df.filter("doc_id < 100"))).first()
    mixed = robust_location(spam_features(df)).filter("language = 'en'").first()
    assert max(abs(a - b) for a, b in zip(clean.centre, mixed.centre)) < 0.05


def test_distance_alone_decides_and_no_short_page_is_passed_over(spark):
    short = {300: "www.a-shop.example www.b-shop.example", 301: "#tea_one #tea_two #tea_three", 302: "Desk lamp JPY 5", 303: "see www.a.example"}
    rows = [(i, "en", prose(i)) for i in range(200)] + [(k, "en", t) for k, t in short.items()] + [(400, "nl", keywords(9)), (401, "en", prose(7) * 9), (402, "en", prose(8) + " near neutral" * 200)]
    found = {r.doc_id for r in spam_scores(spark.createDataFrame(rows, "doc_id long, lang string, text string")).filter("flagged").collect()}
    assert found == {300, 301, 400}
