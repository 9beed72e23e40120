"""Reading of typed names, the radius join against all pairs, and links of people and organisations."""

import random

from millrace.llm.name_parts import Register, distance, fold, read_person
from millrace.llm.names import components, link_names, radius_join

GIVEN = frozenset(["anna", "peter", "maria", "thomas", "richard"])


def test_persons():
    for name in ("Richard Anna Berglund", "Berglund, Richard A.", "BERGLUND R.A.", "R. A. Berglund", "Berglund Richard A.", "Prof. Dr. Richard A. Berglund1,2", "RichardBerglund", "Dick Berglund*", "Rihcard Berglund"):
        p = read_person(name, GIVEN)
        assert p.surname == "berglund" and p.initial == "r", name
    assert read_person("Müller, Ä.", GIVEN).surname == read_person("A. Mueller", GIVEN).surname == "muller"
    assert read_person(None, GIVEN) is None and read_person("  ", GIVEN) is None and read_person("A. B.", GIVEN) is None


UNITS = [(1, None, "institution", "University of Northfield", "Northfield"), (2, None, "institution", "National Laboratory for Soil Science Eastham", "Eastham"),
         (3, None, "institution", "Northfield Medical School", "Northfield"), (10, 1, "department", "Department of Geology", "Northfield"), (11, 2, "department", "School of Computer Science", "Eastham")]


def test_register():
    r = Register(UNITS)
    for text in ("Univ. of Northfield", "NORTHFIELD, UNIVERSITY OF", "The Universty of Norhtfield", "U. Northfield", "Northfield University, Northfield Spain"):
        assert r.institution(text)[0] == 1, text
    assert r.institution("Nat. Lab. Soil Sci., Eastham")[0] == 2 and r.institution("Northfield Med. School")[0] == 3
    assert r.institution("Northfield Water Board")[0] is None and r.institution(None)[0] is None and r.institution("Retired")[0] is None
    uid, rest = r.institution("Dept. of Geology, University of Northfield")
    assert (uid, r.department(uid, rest)) == (1, 10)
    assert r.department(2, "Comp. Sci. Dept.") == 11 and r.department(1, "Physics") is None and r.department(1, "") is None


def test_distance():
    assert distance("abcd", "abdc", 2) == 1 and distance("abcd", "abXd", 2) == 1 and distance("abcd", "wxyz", 2) == 3


def test_distance_within_its_band():
    def full(a, b):
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    r = random.Random(4)
    for _ in range(3000):
        a, b = ("".join(r.choice("abc") for _ in range(r.randint(0, 9))) for _ in range(2))
        for limit in (1, 2, 3):
            assert distance(a, b, limit) == min(full(a, b), limit + 1), (a, b)


def test_radius_join_is_exact(spark):
    r = random.Random(5)
    base = ["".join(r.choice("abcde") for _ in range(7)) for _ in range(90)]
    names = sorted({*base, *("".join(x for k, x in enumerate(w) if k != r.randint(0, 6)) for w in base)})
    rows = [("g", n) for n in names] + [("h", "abc"), ("h", "abd")]
    got = {(x.g, x.name, x.other) for x in radius_join(spark.createDataFrame(rows, "g string, n string"), ["g"], "n", 2).collect()}

    def levenshtein(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    want = {("g", a, b) for a in names for b in names if a != b and levenshtein(a, b) <= 2} | {("h", "abc", "abd"), ("h", "abd", "abc")}
    assert got == want


def test_components(spark):
    edges = [(9, "a"), (7, "a"), (7, "b"), (5, "b"), (5, "c"), (3, "c"), (20, "z"), (21, "y"), (20, "y")]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "node long, key string")).collect()}
    assert got == {9: 3, 7: 3, 5: 3, 3: 3, 20: 20, 21: 20}


COLUMNS = "mention_id long, full_name string, email string, orcid string, institution string, department string, settlement string, person string"


def test_links(spark):
    rows = [
        (1, "Peter Longstocking", "p.longstocking1@northfield.example", None, "University of Northfield", "Department of Geology", None, "x"),
        (2, "P. Longstockng", None, None, "Univ. of Northfield", "Geology", None, "x"),
        (3, "LONGSTOCKING P.", None, "0-1", "Geology, Department of, University Northfield", None, None, "x"),
        (4, "Peter Longstocking", "p.longstocking1@northfield.example", None, "National Laboratory for Soil Science Eastham", None, None, "x"),
        (5, "Longstocking, P.", None, "0-1", None, None, None, "x"),
        (6, "Thomas Longstocking", None, None, "University of Northfield", None, None, "x"),
        (7, None, None, None, None, None, None, "x"),
        (8, None, None, None, None, None, None, "x"),
        (9, "Anna " + "very" * 2000, None, None, " ", "", "", "x"),
    ]
    rows += [(100 + i, f"{g} Filler{chr(97 + i)}", None, None, None, None, "Eastham", "x") for i, g in enumerate(["Peter", "Thomas", "Anna", "Maria"] * 5)]
    rows += [rows[1]]
    df = spark.createDataFrame(rows, COLUMNS)
    units = spark.createDataFrame(UNITS, "unit_id long, parent_id long, unit_level string, unit_name string, settlement string")
    got = {tuple(r) for r in link_names(df, units).collect()}
    people = {(a, b) for k, a, b in got if k == "person"}
    assert {(1, 2), (1, 3), (1, 4), (1, 5), (2, 3)} <= people and not any(6 in p or 7 in p or 8 in p for p in people)
    assert {(k, a, b) for k, a, b in got if k != "person"} == {("institution", 1, 2), ("institution", 1, 3), ("department", 10, 2), ("department", 10, 3)}
    assert link_names(df.limit(0), units).count() == 0
    assert fold("Größe") == "grosse"


def test_misspelt_surname_without_place(spark):
    rows = [(i, "Peter Longstocking", None, None, "University of Northfield", None, None, "x") for i in range(1, 7)]
    rows += [(20, "Peter Longstokcing", None, None, "Retired", None, None, "x"), (21, "Peter Longsticking", None, None, None, None, None, "x"), (22, "Peter Wintermark", None, None, None, None, None, "x")]
    rows += [(100 + i, f"{g} Filler{chr(97 + i)}", None, None, None, None, "Eastham", "x") for i, g in enumerate(["Peter", "Thomas", "Anna", "Maria"] * 5)]
    units = spark.createDataFrame(UNITS, "unit_id long, parent_id long, unit_level string, unit_name string, settlement string")
    people = {(r.key_a, r.key_b) for r in link_names(spark.createDataFrame(rows, COLUMNS), units).collect() if r.kind == "person"}
    assert {(1, 20), (1, 21), (6, 20)} <= people and not any(22 in p for p in people)
