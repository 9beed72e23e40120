"""The structural index against the standard JSON reader, and the flat tables it gives."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.operators.nested import flatten_records, index_all

ADDRESS = {"post_code": "12", "settlement": " ", "country": None}


def valid(text):
    return [bool(ix.valid[k]) for _, ix in index_all([text]) for k in range(1)][0]


def strict(text):
    def refuse(_):
        raise ValueError

    try:
        json.loads(text, parse_constant=refuse)
        return True
    except ValueError:
        return False


json_values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=6),
    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3),
    max_leaves=12,
)


@settings(max_examples=150, deadline=None)
@given(json_values, st.integers(0, 80), st.sampled_from('{}[]:,"\\x1 '))
def test_validity_as_json(value, at, mark):
    text = json.dumps(value, ensure_ascii=False).encode("utf-8", "replace").decode()
    assert valid(text)
    for broken in (text[:at], text[:at] + mark + text[at:], text[:at] + text[at + 1 :]):
        if broken:
            assert valid(broken) == strict(broken), broken


def test_batch_members_do_not_disturb_each_other():
    texts = ['{"a": "', '{"a": [1, 2]}', '"', '{"b": {"c": "x\\\\"}}', "[", '{"a": 1}']
    got = {r: bool(ix.valid[k]) for rows, ix in index_all(texts) for k, r in enumerate(rows)}
    assert got == {0: False, 1: True, 2: False, 3: True, 4: False, 5: True}


def rows(spark, payloads, **kw):
    df = spark.createDataFrame(list(enumerate(payloads)), "rec_id long, payload string")
    return flatten_records(df, **kw).collect()


def cases(spark, *payloads):
    got = rows(spark, payloads, levels=("address",))
    return {(r.rec_id, r.biblio_no, r.person_role, r.person_no, r.affil_no) for r in got}


def test_shapes(spark):
    person = {"full_name": "A", "affiliation": [{"address": {}}, None, {"address": ADDRESS}, {"address": "x"}]}
    lone = {"surname": "B", "affiliation": {"address": {"postCode": "1"}}}
    doc = {"header": {"authors": [None, person], "editors": lone}, "citations": {"b0": {"index": 4, "authors": lone}}}
    want = {(1, 0, "author", 2, 3), (1, 0, "author", 2, 4), (1, 0, "editor", 1, 1), (1, 5, "author", 1, 1)}
    for shaped in (doc, {"status": "ok", "document": doc}, {"record": doc}, [doc]):
        for text in (json.dumps(shaped), json.dumps(json.dumps(shaped)), json.dumps(shaped, indent=1)):
            assert cases(spark, None, text) == want
    flat = {"title": "T", "authors": [lone], "citations": None}
    assert cases(spark, json.dumps(flat)) == {(0, 0, "author", 1, 1)}


def test_awkward_payloads_give_no_rows(spark):
    assert cases(spark, None, "", " ", "{", "[]", "1", "null", '"x"', "{'a': 1}", '{"a": 1,}') == set()
    assert rows(spark, [json.dumps({"header": None, "citations": [None, 3]})])[0].level == "document"


def test_long_repeated_and_clashing_columns(spark):
    people = [{"full_name": "é\"\\" * 50, "affiliation": {"address": "s"}}] * 3000
    text = json.dumps({"header": {"authors": people}})
    df = spark.createDataFrame([(7, text, "x"), (7, text, "y")], "rec_id long, payload string, level string")
    got = flatten_records(df, levels=("address",))
    assert got.count() == 6000 and got.distinct().count() if "fields" not in got.columns else got.count() == 6000


def test_child_rows_point_to_parents(spark):
    doc = {"header": {"authors": [{"full_name": "A", "affiliation": {"institution": "I", "address": {"country": "C"}}}]}}
    got = {r.level: r for r in rows(spark, [json.dumps(doc)])}
    assert got["address"].fields == {"country": "C"} and got["affiliation"].fields == {"institution": "I"}
    assert (got["address"].person_no, got["address"].affil_no) == (got["affiliation"].person_no, got["affiliation"].affil_no)
    assert got["person"].fields == {"fullname": "A"} and got["biblio"].biblio_no == 0


def test_biblio_authors_as_three_tables(spark, tmp_path):
    from millrace.plans.nested_queries import QUERIES

    address = "struct<addr_line: string, post_code: string, settlement: string, country: string>"
    author = f"struct<full_name: string, given_name: string, middle_name: string, surname: string, email: string, orcid: string, affiliation: struct<institution: string, department: string, laboratory: string, address: {address}>>"
    full = ("Ann B. Coe", "Ann", "B.", "Coe", "a@x", "0-1", ("I", "D", "L", ("1 Road", "99", "Town", "Land")))
    blank = ("Eve", None, None, None, None, None, ("J", None, None, (" ", None, "", None)))
    rows = [(1, [None, full, blank, ("Bob", *[None] * 6)]), (1, [None, full, blank, ("Bob", *[None] * 6)]), (2, None), (3, [])]
    spark.createDataFrame(rows, f"biblio_id long, authors array<{author}>").write.parquet(str(tmp_path / "biblio.parquet"))
    got = {k: sorted(map(tuple, QUERIES[f"p3_biblio_{k}"](spark, str(tmp_path)).collect())) for k in ("people", "affiliations", "addresses")}
    assert got["people"] == [(1, 2, *full[:6]), (1, 3, *blank[:6]), (1, 4, "Bob", *[None] * 5)]
    assert got["affiliations"] == [(1, 2, 1, "I", "D", "L"), (1, 3, 1, "J", None, None)]
    assert got["addresses"] == [(1, 2, 1, "1 Road", "99", "Town", "Land")]


def test_long_keys_stay_apart(spark):
    stem = "acquisition_information_of_the_"
    doc = {"header": {"title": "T", f"{stem}first": "1", f"{stem}second": "2"}}
    fields = next(r.fields for r in rows(spark, [json.dumps(doc)]) if r.level == "biblio")
    assert fields == {"title": "T", "acquisitioninformationofthefirst": "1", "acquisitioninformationofthesecond": "2"}


def test_json_in_strings_at_every_level(spark):
    address = {"post_code": "1", "settlement": "a \"quoted\" place"}
    affiliation = {"institution": "I", "address": json.dumps(address)}
    person = {"full_name": "A", "affiliation": json.dumps([json.dumps(affiliation), "{broken", None])}
    title = "[1, 2] {} of sets"
    for authors in (json.dumps([json.dumps(person)]), [person], json.dumps(person)):
        doc = {"header": json.dumps({"title": title, "authors": authors}), "citations": json.dumps([json.dumps({"index": 2, "authors": authors})])}
        for text in (json.dumps(doc), json.dumps({"document": json.dumps(json.dumps(doc))})):
            got = rows(spark, [text])
            assert {(r.biblio_no, r.person_no, r.affil_no) for r in got if r.level == "address"} == {(0, 1, 1), (3, 1, 1)}
            assert all(r.fields == {"postcode": "1", "settlement": address["settlement"]} for r in got if r.level == "address")
            assert {r.fields["institution"] for r in got if r.level == "affiliation"} == {"I", "{broken"}
            assert [r.fields["title"] for r in got if r.level == "biblio" and r.biblio_no == 0] == [title]
