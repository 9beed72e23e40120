"""Record matching on a small invented library, with every candidate checked against brute force."""

import random
import time

import pytest

from millrace.functions.runtime import materialize
from millrace.llm.matching import B_LENGTH, K1, LEAST_SHARE, _near, match_records, read_citations, read_title, read_works, scored_pairs, searched, weighted
from millrace.llm.name_parts import distance

AUTHOR = "struct<full_name:string>"
WORDS = "copper river winter signal garden planet engine market forest marble canyon violet".split()


def library(spark, n=60):
    r = random.Random(3)
    cites, works = [], []
    for i in range(n):
        words = r.sample(WORDS, 4)
        title = f"The {words[0]} {words[1]} of {words[2]} and {words[3]} {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}inium"
        people = [f"{r.choice(['Ann', 'Bob', 'Eve'])} {r.choice('BCDFGHKLMN')}{r.choice(['arlo', 'erni', 'osta', 'unde'])}{r.choice(['wick', 'berg', 'son', 'ley'])}{i % 7}" for _ in range(2)]
        year, first = 1980 + i % 30, 10 + 13 * i
        works.append((10_000 + i, title, "; ".join(people), f"Journal of {words[0]} Studies", f"03/{year}", f"{first}--{first + 9}", str(i % 9)))
        for k in range(2):
            noisy = title.replace("and", "&") if k else title.upper()
            cites.append((2 * i + k, noisy, [(p,) for p in people], f"J. {words[0][:4]}. Stud.", None, str(year), f"{first}-{first + 9}" if k else None, str(i % 9)))
    b = spark.createDataFrame(cites, f"biblio_id long, title string, authors array<{AUTHOR}>, journal string, book_title string, date string, pages string, volume string")
    e = spark.createDataFrame(works, "ext_id long, work_title string, creators string, venue string, issued string, page_range string, vol string")
    return b, e


def test_titles():
    assert read_title("A probe of winter, part 2")[1] == "2" == read_title("A probe of winter II")[1] == read_title("a probe of winter, prt 2.")[1]
    assert read_title("On winter: theory")[1] == "theory" and read_title("On winter")[1] is None
    assert read_title(None) == ([], None, "") and read_title(" ") == ([], None, "")
    assert read_title("Diﬀuse light & Air")[2] == read_title("diffuse light and the air")[2]


def test_library_is_matched(spark):
    b, e = library(spark)
    b = b.union(b.limit(20)).selectExpr("*", "'x' as id", "'y' as venue")
    got = {(r.biblio_id, r.ext_id) for r in match_records(b, e).collect()}
    assert got == {(2 * i + k, 10_000 + i) for i in range(60) for k in range(2)}


def test_sequels_and_awkward_rows(spark):
    b, e = library(spark, 12)
    part = [(900 + k, f"The copper kettle of the marble hall, part {k}", [("Ann Zimmerle",)], "J. Kettles", None, "1999", None, None) for k in (1, 2)]
    part += [(950, None, None, None, None, None, None, None), (951, "", [], "", "", "", "", ""), (None, "x", None, None, None, None, None, None), (952, "word " * 5000, [("A",)], None, None, None, None, None)]
    works = [(20_000 + k, f"The copper kettle of the marble hall {'I' * k}", "Zimmerle, A.", "Journal of Kettles", "1999", None, None) for k in (1, 2)]
    works += [(30_000, None, None, None, None, None, None)]
    both = match_records(b.union(b.sparkSession.createDataFrame(part, b.schema)), e.union(e.sparkSession.createDataFrame(works, e.schema)))
    got = {(r.biblio_id, r.ext_id) for r in both.collect() if r.biblio_id >= 900}
    assert got == {(901, 20_001), (902, 20_002)}
    assert match_records(b.limit(0), e).count() == 0 and match_records(b, e.limit(0)).count() == 0


@pytest.mark.parametrize("gap", [0.0])
def test_confidence_is_a_share(spark, gap):
    b, e = library(spark)
    assert all(gap <= r.confidence <= 1 for r in match_records(b, e).collect())


def test_search_finds_every_pair_of_enough_weight(spark, monkeypatch):
    """Recall of retrieval against brute force over all pairs is 1, over several blocks and shards."""
    import millrace.llm.matching as m

    monkeypatch.setattr(m, "SHARD", 17)
    monkeypatch.setattr(m, "BLOCK", 23)
    b, e = library(spark, 40)
    short = [(5000, "Copper river", [], None, None, None, None, None), (5001, "Signal garden", [("Ann Unseen",)], None, None, "1985", None, None), (5002, "word " * 3000 + "copper", [], None, None, None, None, None)]
    works = [(50_000, "copper river", None, None, None, None, None), (50_001, "signal garden", None, None, "1985", None, None), (50_002, "word", None, None, None, None, None)]
    left, right = weighted(read_citations(b.union(spark.createDataFrame(short, b.schema))), read_works(e.union(spark.createDataFrame(works, e.schema))))
    got = {(r.a, r.b): r.shared for r in searched(left, right).collect()}
    bag = lambda t: {r.id: dict(zip(r.hashes, r.weights)) for r in t.collect()}
    xs, ys = bag(left), bag(right)
    every = {(i, j): sum(w for h, w in x.items() if h in y) for i, x in xs.items() for j, y in ys.items()}
    want = {k: v for k, v in every.items() if v > 0 and v >= LEAST_SHARE * min(sum(xs[k[0]].values()), sum(ys[k[1]].values()))}
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-9 for k, v in want.items())
    assert {(5000, 50_000), (5001, 50_001), (5002, 50_002)} <= got.keys()
    usual = sum(map(len, ys.values())) / len(ys)
    for r in scored_pairs(left, right).collect():
        length = 1 - B_LENGTH + B_LENGTH * len(ys[r.b]) / usual
        assert abs(r.score - want[r.a, r.b] * (K1 + 1) / (1 + K1 * length)) < 1e-6


@pytest.mark.parametrize("postings, most_marks", [(0.001, 30), (5, 30), (0.001, 10)])
def test_keys_of_several_terms_find_every_pair(spark, monkeypatch, postings, most_marks):
    """as brute force, with keys of up to three terms and with a crowded bitmap."""
    import millrace.llm.matching as m

    monkeypatch.setattr(m, "POSTINGS", postings)
    monkeypatch.setattr(m, "MOST_MARKS", most_marks)
    monkeypatch.setattr(m, "SHARD", 17)
    b, e = library(spark, 40)
    short = [(5000, "Copper river", [], None, None, None, None, None), (5001, "Signal garden", [("Ann Unseen",)], None, None, "1985", None, None), (5002, " ".join(WORDS), [], None, None, None, None, None)]
    left, right = weighted(read_citations(b.union(spark.createDataFrame(short, b.schema))), read_works(e))
    got = {(r.a, r.b): r.shared for r in searched(left, right).collect()}
    xs, ys = ({r.id: dict(zip(r.hashes, r.weights)) for r in t.collect()} for t in (left, right))
    every = {(i, j): (sum(w for h, w in x.items() if h in y), min(sum(x.values()), sum(y.values()))) for i, x in xs.items() for j, y in ys.items()}
    want = {k: v for k, (v, least) in every.items() if v > 0 and v >= LEAST_SHARE * least}
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_search_moves_data_in_proportion(spark, monkeypatch):
    """four times the records move about four times the data; each block used to meet each shard, which made it near sixteen times."""
    import millrace.llm.matching as m

    monkeypatch.setattr(m, "SHARD", 5)
    monkeypatch.setattr(m, "BLOCK", 5)
    context = spark.sparkContext._jsc.sc()

    def moved(n):
        left, right = (materialize(t) for t in weighted(*(f(t) for f, t in zip((read_citations, read_works), library(spark, n)))))

        def now():
            context.listenerBus().waitUntilEmpty()
            time.sleep(0.5)
            return context.statusStore().executorSummary("driver").totalShuffleWrite()

        before = now()
        assert searched(left, right).count() >= 2 * n
        return now() - before

    assert moved(100) < 6 * moved(25)


def test_near_titles_as_by_distance():
    r = random.Random(5)
    for _ in range(3000):
        a = "".join(r.choices("abcdefgh", k=r.randrange(50)))
        b = list(a)
        for _ in range(r.randrange(6)):
            k = r.randrange(len(b) + 1)
            b[k : k + r.randrange(3)] = r.choices("abcdefgh", k=r.randrange(3))
        b = "".join(b)
        assert all(_near(a, b, limit) == (distance(a, b, limit) <= limit) for limit in (2, 3))
