"""Queries of the nested-record operator (p3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.nested import flatten_records
from millrace.sources.tables import table

KEYS = ("rec_id", "biblio_no", "person_role", "person_no", "affil_no")


#: Columns of each level by the normalised names of their fields; what else a record holds stands in ``other``.
COLUMNS = {
    "document": {"grobid_version": "grobidversion", "grobid_timestamp": "grobidtimestamp", "language_code": "languagecode", "abstract": "abstract"},
    "biblio": {
        "title": "title", "date": "date", "journal": "journal", "journal_name": "journal.name", "journal_volume": "journal.volume", "volume": "volume", "pages": "pages", "url": "url",
        "id": "id",
    },
    "person": {"full_name": "fullname", "name": "name", "given_name": "givenname", "middle_name": "middlename", "surname": "surname", "email": "email", "orcid": "orcid"},
    "affiliation": {"institution": "institution", "department": "department", "laboratory": "laboratory"},
    "address": {"addr_line": "addrline", "post_code": "postcode", "settlement": "settlement", "country": "country", "text": "text"},
}
#: A payload without a header mixes both levels; a citation's index is its key.
ELSEWHERE = {"document": tuple(COLUMNS["biblio"].values()), "biblio": (*COLUMNS["document"].values(), "index")}


def _level(spark: SparkSession, root: str, level: str, keys: tuple[str, ...]) -> DataFrame:
    """One flat table: the keys of the row and its parents, the known fields as columns, all others as JSON in ``other`` (null if none)."""
    rows = flatten_records(table(spark, root, "grobid_docs"), levels=(level,))
    known = COLUMNS[level]
    other = F.map_filter("fields", lambda k, _: ~k.isin(*known.values(), *ELSEWHERE.get(level, ())))
    columns = [F.try_element_at("fields", F.lit(name)).alias(c) for c, name in known.items()]
    return rows.select(*keys, *columns, F.when(F.size(other) > 0, F.to_json(other)).alias("other")).distinct()


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    rows = flatten_records(table(spark, root, "grobid_docs"), levels=("address",))
    return rows.select(*KEYS).distinct()


def p3_documents(spark: SparkSession, root: str) -> DataFrame:
    return _level(spark, root, "document", KEYS[:1])


def p3_biblios(spark: SparkSession, root: str) -> DataFrame:
    return _level(spark, root, "biblio", KEYS[:2])


def p3_people(spark: SparkSession, root: str) -> DataFrame:
    return _level(spark, root, "person", KEYS[:4])


def p3_affiliations(spark: SparkSession, root: str) -> DataFrame:
    return _level(spark, root, "affiliation", KEYS)


def p3_addresses(spark: SparkSession, root: str) -> DataFrame:
    return _level(spark, root, "address", KEYS)


def p3_biblio_authors(spark: SparkSession, root: str) -> DataFrame:
    """biblio.authors as a flat table of people with their affiliation and address."""
    b = table(spark, root, "biblio").select("biblio_id", F.posexplode("authors").alias("pos", "a"))
    return b.select(
        "biblio_id",
        (F.col("pos") + 1).cast("long").alias("person_no"),
        F.col("a.full_name").alias("full_name"),
        F.col("a.affiliation.institution").alias("institution"),
        F.col("a.affiliation.address.country").alias("country"),
    ).distinct()


PERSON_FIELDS = ("full_name", "given_name", "middle_name", "surname", "email", "orcid")
AFFILIATION_FIELDS = ("institution", "department", "laboratory")
ADDRESS_FIELDS = ("addr_line", "post_code", "settlement", "country")


def _biblio_people(spark: SparkSession, root: str) -> DataFrame:
    """(biblio_id, person_no, a): every author of biblio that is not null; person_no is its place from 1."""
    b = table(spark, root, "biblio").select("biblio_id", F.posexplode("authors").alias("pos", "a"))
    return b.filter("a is not null").select("biblio_id", (F.col("pos") + 1).cast("long").alias("person_no"), "a")


def p3_biblio_people(spark: SparkSession, root: str) -> DataFrame:
    """biblio.authors: people with all their fields."""
    return _biblio_people(spark, root).select("biblio_id", "person_no", *[F.col(f"a.{c}").alias(c) for c in PERSON_FIELDS]).distinct()


def _biblio_affiliations(spark: SparkSession, root: str) -> DataFrame:
    """(biblio_id, person_no, affil_no, f): a person of biblio has one affiliation or null, so affil_no is 1."""
    people = _biblio_people(spark, root).filter("a.affiliation is not null")
    return people.select("biblio_id", "person_no", F.lit(1).cast("long").alias("affil_no"), F.col("a.affiliation").alias("f"))


def p3_biblio_affiliations(spark: SparkSession, root: str) -> DataFrame:
    """biblio.authors: affiliations, with the keys of their person."""
    return _biblio_affiliations(spark, root).select("biblio_id", "person_no", "affil_no", *[F.col(f"f.{c}").alias(c) for c in AFFILIATION_FIELDS]).distinct()


def p3_biblio_addresses(spark: SparkSession, root: str) -> DataFrame:
    """biblio.authors: addresses with a value that is not blank, with the keys of their affiliation."""
    rows = _biblio_affiliations(spark, root).select("biblio_id", "person_no", "affil_no", *[F.col(f"f.address.{c}").alias(c) for c in ADDRESS_FIELDS])
    return rows.filter(F.concat_ws("", *ADDRESS_FIELDS).rlike(r"\S")).distinct()


P3_BIBLIO_AUTHORS_SQL = """
SELECT DISTINCT biblio_id, pos AS person_no, authors[pos].full_name AS full_name,
       authors[pos].affiliation.institution AS institution, authors[pos].affiliation.address.country AS country
FROM (SELECT biblio_id, authors, unnest(range(1, len(authors) + 1)) AS pos FROM biblio)
"""

_BIBLIO_PEOPLE_SQL = """
SELECT biblio_id, pos AS person_no, authors[pos] AS a
FROM (SELECT biblio_id, authors, unnest(range(1, len(authors) + 1)) AS pos FROM biblio) WHERE authors[pos] IS NOT NULL
"""
P3_BIBLIO_PEOPLE_SQL = f"""
SELECT DISTINCT biblio_id, person_no, a.full_name, a.given_name, a.middle_name, a.surname, a.email, a.orcid FROM ({_BIBLIO_PEOPLE_SQL})
"""
P3_BIBLIO_AFFILIATIONS_SQL = f"""
SELECT DISTINCT biblio_id, person_no, 1::BIGINT AS affil_no, a.affiliation.institution, a.affiliation.department, a.affiliation.laboratory
FROM ({_BIBLIO_PEOPLE_SQL}) WHERE a.affiliation IS NOT NULL
"""
P3_BIBLIO_ADDRESSES_SQL = f"""
SELECT DISTINCT biblio_id, person_no, 1::BIGINT AS affil_no, d.addr_line, d.post_code, d.settlement, d.country
FROM (SELECT biblio_id, person_no, a.affiliation.address AS d FROM ({_BIBLIO_PEOPLE_SQL}))
WHERE regexp_matches(concat(d.addr_line, d.post_code, d.settlement, d.country), '\\S')
"""


def _sql_open(x: str, times: int = 2) -> str:
    """A JSON value with a string that holds JSON put in its place."""
    for _ in range(times):
        x = f"(CASE WHEN json_type({x}) = 'VARCHAR' AND json_valid({x} ->> '$') THEN CAST({x} ->> '$' AS JSON) ELSE {x} END)"
    return x


def _sql_field(x: str, *names: str) -> str:
    return _sql_open("coalesce(" + ", ".join(f"json_extract({x}, '$.{n}')" for n in names) + ", NULL)", 1)


def _sql_list(x: str) -> str:
    """An array's elements; any other value that is not null is an array of one."""
    return f"(CASE WHEN {x} IS NULL OR json_type({x}) = 'NULL' THEN [] WHEN json_type({x}) = 'ARRAY' THEN from_json({x}, '[\"JSON\"]') ELSE [{x}] END)"


def _sql_each(source: str, keep: str, column: str, value: str, number: str) -> str:
    """Rows of ``source`` with each element of a list column, strings that hold JSON opened, and its place from 1."""
    return f"""SELECT {keep}, {number}, {_sql_open("e", 1)} AS {value} FROM (
    SELECT {keep}, {number}, {column}[{number}] AS e FROM (SELECT {keep}, {column}, unnest(range(1, len({column}) + 1)) AS {number} FROM ({source})))"""


_SQL_LEVELS = f"""
WITH raw AS (SELECT DISTINCT rec_id, CAST(payload AS JSON) AS p FROM grobid_docs WHERE json_valid(payload)),
whole AS (SELECT rec_id, {_sql_open("p")} AS p FROM raw),
lone AS (SELECT rec_id, CASE WHEN json_type(p) = 'ARRAY' THEN {_sql_open("json_extract(p, '$[0]')", 1)} ELSE p END AS p FROM whole),
record AS (SELECT rec_id, CASE WHEN json_exists(p, '$.header') OR json_exists(p, '$.citations') OR json_exists(p, '$.authors') OR json_exists(p, '$.title') THEN p
           ELSE coalesce({_sql_field("p", "document", "record")}, p) END AS p FROM lone WHERE json_type(p) = 'OBJECT'),
top AS (SELECT rec_id, 0::BIGINT AS biblio_no, CASE WHEN json_exists(p, '$.header') THEN {_sql_field("p", "header")} ELSE p END AS b FROM record),
listed AS (SELECT rec_id, CASE WHEN json_type(c) = 'OBJECT' AND NOT json_exists(c, '$.index') THEN list_transform(json_keys(c), lambda k: json_extract(c, '$."' || k || '"')) ELSE {_sql_list("c")} END AS cs
           FROM (SELECT rec_id, {_sql_field("p", "citations")} AS c FROM record)),
cited AS ({_sql_each("SELECT * FROM listed", "rec_id", "cs", "b", "place")}),
biblios AS (SELECT * FROM top WHERE json_type(b) = 'OBJECT' UNION ALL
            SELECT rec_id, coalesce(TRY_CAST(json_extract_string(b, '$.index') AS BIGINT), place - 1) + 1, b FROM cited WHERE json_type(b) = 'OBJECT'),
roles AS (SELECT rec_id, biblio_no, 'author' AS person_role, {_sql_list("a")} AS ps FROM (SELECT rec_id, biblio_no, {_sql_field("b", "authors", "author")} AS a FROM biblios)
          UNION ALL SELECT rec_id, biblio_no, 'editor', {_sql_list("a")} FROM (SELECT rec_id, biblio_no, {_sql_field("b", "editors", "editor")} AS a FROM biblios)),
people AS ({_sql_each("SELECT * FROM roles", "rec_id, biblio_no, person_role", "ps", "person", "person_no")}),
belong AS (SELECT rec_id, biblio_no, person_role, person_no, {_sql_list("a")} AS fs FROM (SELECT *, {_sql_field("person", "affiliation", "affiliations")} AS a FROM people WHERE json_type(person) = 'OBJECT')),
affils AS ({_sql_each("SELECT * FROM belong", "rec_id, biblio_no, person_role, person_no", "fs", "affil", "affil_no")}),
places AS (SELECT rec_id, biblio_no, person_role, person_no, affil_no, unnest({_sql_list("d")}) AS d
           FROM (SELECT *, {_sql_field("affil", "address")} AS d FROM affils WHERE json_type(affil) = 'OBJECT'))
"""
_SQL_KEYS = "rec_id, biblio_no, person_role, person_no, affil_no"
P3_FOUND_SQL = (
    _SQL_LEVELS
    + f"""SELECT DISTINCT {_SQL_KEYS} FROM places WHERE (json_type(d) = 'VARCHAR' AND trim(d ->> '$') <> '')
    OR (json_type(d) = 'OBJECT' AND len(list_filter(json_keys(d), lambda k: regexp_matches(coalesce(json_extract_string(d, '$."' || k || '"'), ''), '\\S'))) > 0)"""
)


def _sql_text(x: str, column: str) -> str:
    """A field under its written names, as text."""
    head, *rest = column.split("_")
    names = dict.fromkeys((column, head + "".join(w.title() for w in rest)))
    return "coalesce(" + ", ".join(f"json_extract_string({x}, '$.{n}')" for n in names) + ", NULL)"


def _sql_table(level: str, source: str, keys: str, x: str, where: str) -> str:
    special = {
        "journal": f"CASE WHEN json_type({x}, '$.journal') = 'OBJECT' THEN NULL ELSE json_extract_string({x}, '$.journal') END",
        "journal_name": f"json_extract_string({x}, '$.journal.name')",
        "journal_volume": f"json_extract_string({x}, '$.journal.volume')",
    }
    columns = ", ".join(f"{special.get(c) or _sql_text(x, c)} AS {c}" for c in COLUMNS[level])
    if level == "affiliation":  # one given as text is the institution's name
        columns = f"CASE WHEN json_type(affil) = 'VARCHAR' THEN affil ->> '$' ELSE affil ->> '$.institution' END AS institution, {_sql_text(x, 'department')} AS department, {_sql_text(x, 'laboratory')} AS laboratory"
    if level == "person":
        columns = columns.replace(_sql_text(x, "full_name"), f"CASE WHEN json_type({x}) = 'VARCHAR' THEN {x} ->> '$' ELSE {_sql_text(x, 'full_name')} END")
    if level == "address":  # blank values are none; an address given as text stands in ``text``
        part = lambda c: f"CASE WHEN trim({_sql_text(x, c)}) <> '' THEN {_sql_text(x, c)} END"
        columns = ", ".join(f"max({part(c)}) AS {c}" for c in list(COLUMNS[level])[:-1]) + f", max(CASE WHEN json_type({x}) = 'VARCHAR' AND trim({x} ->> '$') <> '' THEN {x} ->> '$' END) AS text"
        return _SQL_LEVELS + f"SELECT {keys}, {columns}, NULL::VARCHAR AS other FROM {source} GROUP BY ALL HAVING coalesce(addr_line, post_code, settlement, country, text) IS NOT NULL"
    return _SQL_LEVELS + f"SELECT DISTINCT {keys}, {columns}, NULL::VARCHAR AS other FROM {source} WHERE {where}"


P3_TABLES_SQL = {
    "p3_documents": _sql_table("document", "record", "rec_id", "p", "true"),
    "p3_biblios": _sql_table("biblio", "biblios", "rec_id, biblio_no", "b", "true"),
    "p3_people": _sql_table("person", "people", "rec_id, biblio_no, person_role, person_no", "person", "json_type(person) = 'VARCHAR' OR json_keys(person) <> []"),
    "p3_affiliations": _sql_table("affiliation", "affils", _SQL_KEYS, "affil", "json_type(affil) = 'VARCHAR' OR json_keys(affil) <> []"),
    "p3_addresses": _sql_table("address", "places", _SQL_KEYS, "d", "true"),
}

QUERIES = {
    "p3_found": p3_found,
    "p3_documents": p3_documents,
    "p3_biblios": p3_biblios,
    "p3_people": p3_people,
    "p3_affiliations": p3_affiliations,
    "p3_addresses": p3_addresses,
    "p3_biblio_authors": p3_biblio_authors,
    "p3_biblio_people": p3_biblio_people,
    "p3_biblio_affiliations": p3_biblio_affiliations,
    "p3_biblio_addresses": p3_biblio_addresses,
}
SQL = {
    "p3_found": P3_FOUND_SQL,
    **P3_TABLES_SQL,
    "p3_biblio_authors": P3_BIBLIO_AUTHORS_SQL,
    "p3_biblio_people": P3_BIBLIO_PEOPLE_SQL,
    "p3_biblio_affiliations": P3_BIBLIO_AFFILIATIONS_SQL,
    "p3_biblio_addresses": P3_BIBLIO_ADDRESSES_SQL,
}
