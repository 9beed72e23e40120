"""Pages guessed from words, and made monotone."""

from millrace.operators.classify import fit_pages, guess_pages, page_bounds


def test_pages_from_words(spark):
    words = {0: "river stone valley", 1: "engine window market", 2: "planet signal copper"}
    lines = [(p * 10 + i, p, f"{w} number {i}") for p, w in words.items() for i in range(10)]
    df = spark.createDataFrame(lines, "idx int, page int, line string")
    got = guess_pages(fit_pages(df), df)
    assert got.filter("guess = page").count() >= 28
    noisy = spark.createDataFrame([("d", i, g) for i, g in enumerate([0, 0, 1, 0, 1, 1, 2, 1, 2, 2])], "d string, idx int, guess int")
    bounds = page_bounds(noisy, "d", "idx", "guess").first().bounds
    assert bounds[0] == 0 and bounds == sorted(bounds) and 2 <= bounds[1] <= 4 and 6 <= bounds[2] <= 8
