"""Repetition measures against a direct reading of the definition, and the exact bound."""

import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.repetition import CASE_SHARE, FLOOR, GRID, MAX_RISK, binomial_cdf, controlled_cutoffs, exact_share, flag_repetition, measure_repetition, repeat_counts


def direct(text):
    words = [w.lower() for w in re.findall(r"[^\W\d_]+", text)]
    seen, hit = set(), set()
    for i in range(len(words) - 4):
        run = tuple(words[i : i + 5])
        if run in seen:
            hit |= set(range(i, i + 5))
        seen.add(run)
    return len(words), len(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "b", "c", "7", ".", "ä"]), max_size=60))
def test_counts_follow_the_definition(parts):
    text = " ".join(parts)
    assert repeat_counts(text)[:2] == direct(text)


def test_edges_of_texts():
    assert repeat_counts(None) == (0, 0, 0) and repeat_counts("") == (0, 0, 0)
    assert repeat_counts("a b c d") == (4, 0, 0)
    assert repeat_counts("x " * 100_000)[:2] == (100_000, 99_999)


def test_binomial_bound():
    for n, k, p in ((10, 3, 0.2), (200, 0, 0.02), (500, 12, 0.02), (40, 39, 0.9)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(binomial_cdf(k, n, p) - want) < 1e-9


def test_cutoffs_keep_the_risk(spark):
    rows = [("a", 0.30, True)] * 1000 + [("a", 0.13, True)] * 3 + [("a", 0.05, False)] * 50 + [("b", 0.30, True)] * 20 + [("c", 0.01, False)] * 900 + [("d", 0.30, True)] * 700 + [("d", 0.07, True)]
    df = spark.createDataFrame(rows, "stratum string, window_share double, is_case boolean")
    got = {r.stratum: (r.cutoff, r.certified) for r in controlled_cutoffs(df).collect()}
    assert got == {"a": (0.12, True), "b": (FLOOR, False), "c": (FLOOR, False), "d": (FLOOR, True)}
    for n in (376, 700):  # too few cases certify nothing; the bound of those that do is the exact one
        one = controlled_cutoffs(df.filter("stratum = 'd' and window_share > 0.2").limit(n)).first()
        need = math.log(0.05 / len(GRID)) / math.log(1 - MAX_RISK)
        assert one.certified == (n >= need) and (not one.certified or abs((1 - one.bound) ** n - 0.05 / len(GRID)) < 1e-9)


def test_no_case_lies_below_the_floor():
    for gap in range(4, 9):  # windows repeated as far apart as they can be
        words = [w for k in range(60) for w in (*"abcde", *(f"x{chr(97 + k % 26)}{chr(97 + k // 26)}{'q' * j}" for j in range(gap)))]
        n, repeat, windows = repeat_counts(" ".join(words))
        assert repeat < CASE_SHARE * n or windows / (n - 4) >= FLOOR


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "b", "c", "7", ".", "ä"]), max_size=60))
def test_exact_share_follows_the_definition(parts):
    assert exact_share(" ".join(parts)) == direct(" ".join(parts))


def test_empty_nulls_copies_and_clashing_columns(spark):
    text = "one two three four five six one two three four five six"
    rows = [(1, text, "s", "x"), (1, text, "s", "x"), (2, None, None, "x"), (None, "", "s", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, stratum string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_repeat) for r in flag_repetition(df).collect())
    assert got == [(1, 12, 6), (1, 12, 6)]  # the others are screened out
    assert flag_repetition(df.limit(0)).count() == 0
    assert measure_repetition(df.select("doc_id")).count() == 4
