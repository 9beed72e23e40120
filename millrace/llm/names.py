"""Variant spellings of typed names (p2): mentions of one person, and mentions of registered organisations.

Organisations: a typed name is read into kind, field and place words, each within an edit radius of the
register's words, and resolved to the unit of that place whose words it covers. The register is a
fixed list; every distinct typed name is read once.

People: names are read into surname, given and middle parts. Within a cell (place, initial) surnames
are joined to each other by metric-space partitioning: every surname is assigned to its nearest
pivot, copied to the pivots that the triangle inequality cannot rule out for the radius, and compared
within the cells by Levenshtein distance. A rare form is a misspelling of a frequent one in its
radius. Mentions of one surname, initial and place are one person; shared email addresses and ORCIDs
tie them across places (connected components); mentions without a place go to the
only person their name fits.

Null names are linked by email or ORCID only; null organisations are not resolved; copies of a mention
count once; empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.runtime import broadcast_if_small, materialize
from millrace.llm.name_parts import TITLES, Register, fold, read_person
from millrace.operators.graph import components
from millrace.sources.tables import columns_or_null, table

RADIUS = 2
#: A form is a misspelling of another in its radius if that is at least so many times as frequent.
SUPPORT_RATIO = 5
#: A form so rare may be one of a form of like support, if the given names agree.
RARE_FORM = 2
#: Names per pivot in smaller cells; a cell of n names has at most PIVOT_ROOTS times the root of n pivots, so that work grows as n to 1.5.
PIVOT_NAMES, PIVOT_ROOTS = 64, 2.0
#: Parts that the names of a cell are spread over to meet the pivots.
PIVOT_SALT = 16
#: Names and organisations whose reading a task remembers.
REMEMBERED = 50_000
#: A token is a given name if it opens at least this share of names (and at least LEAST_GIVEN).
GIVEN_SHARE, LEAST_GIVEN = 0.0005, 4
#: Same names in two places are one person only if most such pairs with known addresses are.
SAME_SHARE = 0.6

_COLUMNS = {
    "mention_id": "long", "full_name": "string", "given_name": "string", "middle_name": "string", "surname": "string", "email": "string", "orcid": "string",
    "institution": "string", "department": "string", "settlement": "string",
}


def radius_join(names: DataFrame, group: list[str], name: str, radius: int = RADIUS, others: DataFrame | None = None) -> DataFrame:
    """(group, name, other, distance): all ordered pairs of different names of a group within the radius; ``other`` is of ``others`` if given.

    Metric-space partitioning. Pivots are names with small hashes, more in larger groups. With p the
    home (nearest) pivot of y, a name x within the radius of y has d(x, p) <= d(y, p) + r <= d(y, q) + r <= d(x, q) + 2 r
    for every pivot q; so x is copied to each pivot within 2 r of its nearest, and no pair is lost.
    """
    asked = names.select(*group, F.col(name).alias("name"), F.lit(True).alias("asks"), F.lit(others is None).alias("answers"))
    if others is not None:
        asked = asked.union(others.select(*group, F.col(name).alias("name"), F.lit(False), F.lit(True)))
    distinct = asked.groupBy(*group, "name").agg(F.max("asks").alias("asks"), F.max("answers").alias("answers"))
    digest = F.pmod(F.xxhash64("name"), F.lit(1 << 30))
    sizes = distinct.groupBy(*group).agg(F.count("*").alias("n_names"), F.min_by("name", F.struct(digest, "name")).alias("one"))
    sizes = sizes.withColumn("n_pivots", F.least(F.ceil(F.lit(PIVOT_ROOTS) * F.sqrt("n_names")), F.ceil(F.col("n_names") / PIVOT_NAMES)))
    drawn = digest * F.col("n_names") < F.col("n_pivots") * F.lit(1 << 30)  # about n_pivots names, without ranking a cell
    pivots = distinct.join(sizes, group).filter(drawn | (F.col("name") == F.col("one"))).select(*group, F.col("name").alias("pivot"))
    # a cell's pivots go as one list to each of its names, so that no row per name and pivot is made or shuffled
    lists = pivots.groupBy(*group).agg(F.array_sort(F.collect_list("pivot")).alias("pivots")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(PIVOT_SALT - 1))))
    # names are few bytes but much work, so that adaptive execution must not put them into a few tasks
    spark = names.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    salted = distinct.withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(PIVOT_SALT)).cast("int")).repartition(tasks, *group, "salt").join(lists, [*group, "salt"])
    apart = F.transform(F.array(F.transform("pivots", lambda p: F.levenshtein("name", p))), lambda d: F.struct(d.alias("d"), F.array_min(d).alias("least")))
    homed = F.transform(apart, lambda x: F.array_position(x["d"], x["least"]))[0].cast("int")
    near = F.transform(apart, lambda x: F.filter(F.sequence(F.lit(1), F.size(x["d"])), lambda i: F.element_at(x["d"], i) <= x["least"] + 2 * radius))[0]
    copies = salted.filter("asks").select(*group, "name", F.explode(near).alias("pivot_no"))
    homes = salted.filter("answers").select(*group, homed.alias("pivot_no"), F.col("name").alias("other"))
    pairs = copies.join(homes, [*group, "pivot_no"]).filter((F.col("name") != F.col("other")) & (F.abs(F.length("name") - F.length("other")) <= radius))
    pairs = pairs.withColumn("distance", F.levenshtein("name", "other", radius)).filter("distance >= 0")
    return pairs.select(*group, "name", "other", "distance")


def given_names(mentions: DataFrame) -> frozenset[str]:
    """Tokens that open names much more often than they close them; a bounded list by GIVEN_SHARE."""
    plain = mentions.filter(F.col("full_name").isNotNull() & ~F.col("full_name").contains(","))
    words = plain.select(F.filter(F.split("full_name", r"[\s.]+"), lambda x: F.length(x) > 2).alias("w"))
    titles = F.array(*[F.lit(t) for t in sorted(TITLES)])
    words = words.select(F.filter("w", lambda x: ~F.array_contains(titles, F.lower(x))).alias("w")).filter(F.size("w") >= 2)
    ends = words.select(F.explode(F.array(F.struct(F.col("w")[0].alias("t"), F.lit(1).alias("o"), F.lit(0).alias("c")), F.struct(F.element_at("w", -1).alias("t"), F.lit(0).alias("o"), F.lit(1).alias("c")))).alias("x"))
    tally = ends.groupBy(F.lower("x.t").alias("t")).agg(F.sum("x.o").alias("opens"), F.sum("x.c").alias("closes"))
    total = mentions.count()
    kept = tally.filter((F.col("opens") >= max(LEAST_GIVEN, GIVEN_SHARE * total)) & (F.col("opens") > 3 * F.col("closes")))
    return frozenset(fold(r.t) for r in kept.collect())


def _reader(units: list[tuple], givens: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        register = Register(units)
        place_of = {uid: place for place, rows in register.at.items() for uid, *_ in rows}
        names: dict[str | None, tuple] = {}
        orgs: dict[tuple, tuple] = {}
        for batch in batches:
            out: list[tuple] = []
            for mid, full, _, _, _, email, orcid, inst, dept, town in zip(*(c.to_pylist() for c in batch.columns)):
                if len(names) > REMEMBERED:
                    names.clear()
                if len(orgs) > REMEMBERED:
                    orgs.clear()
                if full not in names:
                    names[full] = tuple(read_person(full, givens) or (None,) * 5)
                key = (inst, town)
                if key not in orgs:
                    orgs[key] = register.institution(inst, town)
                unit, rest = orgs[key]
                named = register.department(unit, dept)
                inside = register.department(unit, rest)
                local, _, domain = (email or "").lower().partition("@")
                head, _, tail = local.partition(".")
                address = fold(tail.rstrip("0123456789")) if len(head) == 1 and tail else None
                place = place_of.get(unit) or (fold(town.strip()) if town and town.strip() else None)
                if place is None and inst:
                    place = register.place_in(inst)
                if place is None and domain:
                    place = fold(domain.split(".")[0]) if fold(domain.split(".")[0]) in register.at else None
                sur, given, initial, middle, middle_initial = names[full]
                if address:
                    sur, initial = address, head
                out.append((mid, sur, given, initial, middle, middle_initial, bool(address), email and email.lower(), orcid, place, unit, inst, named, dept, inside))
            columns = list(zip(*out)) if out else [()] * len(_PARSED)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t, _) in zip(columns, _PARSED)], names=[n for n, *_ in _PARSED])

    return run


_S, _L = pa.string(), pa.int64()
_PARSED = [
    ("mention_id", _L, "long"), ("typed", _S, "string"), ("given", _S, "string"), ("initial", _S, "string"), ("middle", _S, "string"), ("middle_initial", _S, "string"),
    ("certain", pa.bool_(), "boolean"), ("email", _S, "string"), ("orcid", _S, "string"), ("place", _S, "string"), ("unit", _L, "long"), ("institution", _S, "string"),
    ("named", _L, "long"), ("department", _S, "string"), ("inside", _L, "long"),
]


def read_mentions(mentions: DataFrame, org_units: DataFrame) -> DataFrame:
    """One row per mention_id with its name parts, its place and the units it names; one narrow pass after the copies are dropped."""
    units = columns_or_null(org_units, {"unit_id": "long", "parent_id": "long", "unit_level": "string", "unit_name": "string", "settlement": "string"})
    rows = [tuple(r) for r in units.filter("unit_id is not null and unit_name is not null").collect()]  # the register is a fixed list
    people = columns_or_null(mentions, _COLUMNS).filter("mention_id is not null").dropDuplicates(["mention_id"])
    return people.mapInArrow(_reader(rows, given_names(people)), ", ".join(f"{n} {t}" for n, _, t in _PARSED))


def spelled_right(parsed: DataFrame) -> DataFrame:
    """(place, initial, typed, surname): the surname each typed form stands for in its cell."""
    counts = parsed.filter("typed is not null").groupBy("typed").agg(F.count("*").alias("n"), F.max("certain").alias("certain"))
    cells = parsed.filter("typed is not null and place is not null and initial is not null")
    cells = cells.groupBy("place", "initial", "typed").agg(F.collect_set("given").alias("givens"))  # of one initial: a few
    near = radius_join(cells, ["place", "initial"], "typed")
    here = cells.join(counts, "typed")
    one = here.select("place", "initial", F.col("typed").alias("name"), "n", "certain", "givens")
    two = here.select("place", "initial", F.col("typed").alias("other"), F.col("n").alias("n_other"), F.col("certain").alias("sure"), F.col("givens").alias("givens_other"))
    near = near.join(one, ["place", "initial", "name"]).join(two, ["place", "initial", "other"]).filter(~F.col("certain"))
    rarer = (F.col("n") < F.col("n_other")) | ((F.col("n") == F.col("n_other")) & (F.col("sure") | (F.col("name") > F.col("other"))))
    same_given = F.arrays_overlap("givens", "givens_other")
    slip = (F.col("distance") == 1) & ((F.size("givens") == 0) | (F.size("givens_other") == 0))
    agree = same_given | (F.size("givens") == 0) | (F.size("givens_other") == 0)
    frequent = (F.col("n") * SUPPORT_RATIO <= F.col("n_other")) & (agree | (F.col("distance") == 1))
    alike = (F.col("n") <= RARE_FORM) & (same_given | slip | (F.col("sure") & agree))
    near = near.filter(rarer & (frequent | alike))
    order = F.struct(-F.col("distance"), F.col("sure"), F.col("n_other"), F.col("other"))
    return near.groupBy("place", "initial", F.col("name").alias("typed")).agg(F.max_by("other", order).alias("surname"))


def spelled_anywhere(people: DataFrame, stray: DataFrame, placed: DataFrame) -> DataFrame:
    """(surname, initial, right): for strays' surnames that no placed person of the initial has, the nearest that one has.

    The rules are those within a cell; as there is no place to tell names apart, two nearest ones leave the surname as it is.
    """
    counts = people.filter("surname is not null").groupBy("surname").agg(F.count("*").alias("n"))
    book = placed.filter("surname is not null and initial is not null").groupBy("initial", "surname").agg(F.collect_set("given").alias("givens_other"))
    asks = stray.groupBy("initial", "surname").agg(F.collect_set("given").alias("givens")).join(book, ["initial", "surname"], "left_anti")
    near = radius_join(asks, ["initial"], "surname", others=book)
    near = near.join(asks.withColumnRenamed("surname", "name"), ["initial", "name"]).join(book.withColumnRenamed("surname", "other"), ["initial", "other"])
    near = near.join(counts.withColumnRenamed("surname", "name"), "name").join(counts.select(F.col("surname").alias("other"), F.col("n").alias("n_other")), "other")
    same_given = F.arrays_overlap("givens", "givens_other")
    open_given = (F.size("givens") == 0) | (F.size("givens_other") == 0)
    frequent = (F.col("n") * SUPPORT_RATIO <= F.col("n_other")) & (same_given | open_given | (F.col("distance") == 1))
    alike = (F.col("n") <= F.least(F.lit(RARE_FORM), "n_other")) & (same_given | ((F.col("distance") == 1) & open_given))
    near = near.filter(frequent | alike)
    by = near.groupBy("initial", F.col("name").alias("surname"), "distance").agg(F.count("*").alias("n_right"), F.min("other").alias("right"))
    best = by.groupBy("initial", "surname").agg(F.min_by(F.struct("n_right", "right"), "distance").alias("x"))
    return best.filter("x.n_right = 1").select("surname", "initial", "x.right")


def link_people(parsed: DataFrame) -> DataFrame:
    """(mention_id, person): mentions of one person share the number."""
    right = spelled_right(parsed)
    known = parsed.join(right, ["place", "initial", "typed"], "left").withColumn("surname", F.coalesce("surname", "typed"))
    local = F.when(
        F.col("place").isNotNull() & F.col("initial").isNotNull() & F.col("surname").isNotNull(), F.xxhash64("surname", "initial", "place")
    ).otherwise(F.xxhash64(F.lit("mention"), "mention_id"))
    known = materialize(
        known.select("mention_id", "surname", "given", "initial", "middle", "middle_initial", "email", "orcid", "place", local.alias("node"))
    )
    keys = F.explode(F.array_compact(F.array(F.concat(F.lit("e "), "email"), F.concat(F.lit("o "), "orcid"))))
    ids = known.select("node", keys.alias("key"))
    # the same full name in two places: as often one person as pairs with known addresses tell
    named = known.filter("given is not null and place is not null").select("node", "surname", "given", "initial", "middle_initial", "email")
    spots = named.groupBy("surname", "given", "node").agg(F.max("email").alias("email"), F.max("middle_initial").alias("middle_initial"))
    spots = spots.withColumn("exact", F.col("middle_initial").isNotNull())
    groups = spots.groupBy("surname", "given", F.coalesce("middle_initial", F.lit("")).alias("mi")).agg(
        F.count("*").alias("n"), F.count("email").alias("n_known"), F.count_distinct("email").alias("n_email")
    )
    told = groups.filter("n_known >= 2").groupBy((F.col("mi") != "").alias("exact")).agg(F.avg((F.col("n_email") < F.col("n_known")).cast("double")).alias("share"))
    trusted = [r.exact for r in told.collect() if r.share is not None and r.share >= SAME_SHARE]
    free = groups.filter((F.col("n") >= 2) & (F.col("n_email") <= 1) & (F.col("mi") != "").isin(trusted) if trusted else F.lit(False))
    alike = spots.withColumn("mi", F.coalesce("middle_initial", F.lit(""))).join(free.select("surname", "given", "mi"), ["surname", "given", "mi"])
    ties = alike.select("node", F.concat_ws(" ", F.lit("n"), "surname", "given", "mi").alias("key"))
    labels = components(ids.union(ties))
    people = known.join(labels, "node", "left").withColumn("person", F.coalesce("label", "node")).drop("label")
    people = materialize(people)
    # mentions without place and without address: to the only person whose name fits
    placed = people.filter("place is not null or email is not null or orcid is not null")
    stray = people.filter("place is null and email is null and orcid is null and surname is not null and initial is not null")
    # a misspelt surname without a place is in no cell: it is sought among all surnames of its initial
    stray = stray.join(spelled_anywhere(people, stray, placed), ["surname", "initial"], "left").withColumn("surname", F.coalesce("right", "surname")).drop("right")
    persons = placed.filter("surname is not null and initial is not null").groupBy("surname", "initial", "person").agg(
        F.collect_set("given").alias("givens"), F.collect_set("middle_initial").alias("middles")
    )
    # a person answers to each of its names, or to "*" without one, and to "any"; so every stray looks up at most
    # four keys, each with the number of its persons, and no stray meets all persons of a frequent surname
    answers = lambda c: F.concat(F.when(F.size(c) == 0, F.array(F.lit("*"))).otherwise(F.col(c)), F.array(F.lit("any")))
    asks = lambda c: F.when(F.col(c).isNull(), F.array(F.lit("any"))).otherwise(F.array(F.col(c), F.lit("*")))
    keyed = persons.withColumn("g", F.explode(answers("givens"))).withColumn("m", F.explode(answers("middles")))
    book = keyed.groupBy("surname", "initial", "g", "m").agg(F.count("*").alias("n"), F.min("person").alias("only"))
    looked = stray.select("mention_id", "surname", "initial", F.explode(asks("given")).alias("g"), "middle_initial").withColumn("m", F.explode(asks("middle_initial")))
    found = looked.join(book, ["surname", "initial", "g", "m"]).groupBy("mention_id").agg(F.sum("n").alias("n"), F.min("only").alias("only"))
    sole = found.filter("n = 1").select("mention_id", "only")
    return people.join(sole, "mention_id", "left").select("mention_id", F.coalesce("only", "person").alias("person"))


def person_pairs(people: DataFrame) -> DataFrame:
    """(key_a, key_b): all pairs of mentions of one person, which is what the links are."""
    people = materialize(people)
    a = people.select("person", F.col("mention_id").alias("key_a"))
    b = people.select("person", F.col("mention_id").alias("key_b"))
    return a.join(b, "person").filter("key_a < key_b").select("key_a", "key_b")


def organisation_links(parsed: DataFrame, org_units: DataFrame) -> DataFrame:
    """(kind, key_a, key_b): unit and mention, where the mention names the unit in another text than its clean name."""
    names = columns_or_null(org_units, {"unit_id": "long", "unit_name": "string"}).distinct()
    rows = parsed.select(
        "mention_id",
        F.explode(
            F.array(
                F.struct(F.lit("institution").alias("kind"), F.col("unit").alias("key_a"), F.col("institution").alias("text")),
                F.struct(F.lit("department").alias("kind"), F.col("named").alias("key_a"), F.col("department").alias("text")),
                F.struct(F.lit("department").alias("kind"), F.col("inside").alias("key_a"), F.lit(None).cast("string").alias("text")),
            )
        ).alias("x"),
    ).select("x.*", F.col("mention_id").alias("key_b"))
    rows = rows.filter("key_a is not null").join(broadcast_if_small(names), rows["key_a"] == names["unit_id"])
    return rows.filter(F.col("text").isNull() | (F.col("text") != F.col("unit_name"))).select("kind", "key_a", "key_b").distinct()


def link_names(mentions: DataFrame, org_units: DataFrame) -> DataFrame:
    """(kind, key_a, key_b) for persons, institutions and departments."""
    parsed = materialize(read_mentions(mentions, org_units))
    people = person_pairs(link_people(parsed)).select(F.lit("person").alias("kind"), "key_a", "key_b")
    return people.union(organisation_links(parsed, org_units))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return link_names(table(spark, root, "author_mentions"), table(spark, root, "org_units"))


QUERIES = {"p2_found": p2_found}
SQL: dict[str, str] = {}
