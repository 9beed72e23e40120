"""Matching records of two tables without a common key (p7): BM25 retrieval over all attributes.

Every record becomes a bag of terms: title words, author words, venue prefixes, year, page range, volume.
Term weights are BM25's inverse document frequencies over both tables; the score of a pair is the weight of the
terms they share, with BM25's saturation and length normalisation for the outside record. Retrieval is exact:
it finds every pair whose shared weight is at least LEAST_SHARE of the weight of the record that has less of it.
The index has keys of one to DEPTH terms: the heaviest shared terms, as many as make a key rare by their frequencies.
The lighter record of a pair is looked up only under keys by which it can reach its least weight, the other one under
all of its keys that some lighter record has; signatures of the terms behind the key bound what can be added, and the
pairs that are left are weighed. So the work follows the records and the pairs of like terms, not the product of both tables.
A pair must then be the citation's best or tie with it, and near the best of the outside record as well (several
citations may be of one work, so nearness is relative to the record's best score). Confidence is a logistic
function of score, gap and agreement, fitted on a bounded sample (SAMPLE_PAIRS) of clear cases; a pair is a match
if its confidence is LEAST_CONFIDENCE or more.

Null attributes give no terms; records without terms match nothing; copies count once; ties go to the
smaller id, and a tie between two outside records of like agreement keeps both; empty tables give an
empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.runtime import materialize
from millrace.llm.name_parts import distance, fold
from millrace.sources.tables import columns_or_null, table

#: A citation's outside record must reach this share of the citation's own and of the record's best score.
NEAR_BEST = 0.6
#: Share of a citation's best rating from which another outside record ties with it.
TIE = 0.85
#: Least share of the lighter record's weight that a pair has in common.
LEAST_SHARE = 0.5
#: Outside records and citations whose keys make one part, on an average.
SHARD, BLOCK = 25_000, 25_000
#: Records that a key is to have, by the frequencies of its terms, and the most terms of a key.
POSTINGS, DEPTH = 100, 3
#: Records, and keys or pairs, that are handled at once.
PIECE, PORTION = 5_000, 500_000
#: Bits of the bitmap for a key of a lighter record; logarithms of its most bits and of those of a slice.
MARK_BITS, MOST_MARKS, SLICE = 12, 30, 20
#: Weight by which sums in another order may differ.
SLACK = 1e-6
#: BM25's saturation and length normalisation.
K1, B_LENGTH = 1.2, 0.3
SAMPLE_PAIRS = 20_000
#: Letters that two titles of one work may differ in.
TITLE_SLIPS = 3
LEAST_CONFIDENCE = 0.5
#: The title feature of a pair one of whose titles breaks off: its part is unknown.
CUT_TITLE, CUT_LETTERS = 0.5, 12

# Words that carry no content in titles and venues.
STOP = frozenset("the a an of in on and for with is how under by to at from as et al jr part".split())
_LIGATURES = str.maketrans({"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"})
_GLUED = re.compile(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ])")
_YEAR = re.compile(r"(?<!\d)(1[5-9]\d\d|20\d\d)(?!\d)")
_RANGE = re.compile(r"(\d+)\s*[-–—]+\s*(\d+)")
_PART = re.compile(r"[\s,:(\-–]+(?:(?:p\w{0,3}t|pt\.|teil|vol\.?)\s*(\d+|[ivx]+)|([ivx]+)|:?\s*(theory|experiment|methods|results|data|review|simulation|practice|applications?))[\s.)”\"']*$", re.I)
_ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "vii": "7", "viii": "8", "ix": "9", "x": "10"}


def _folded(text: str) -> str:
    """``fold``, with a short way for texts without accents."""
    return text.lower().replace("ae", "a").replace("oe", "o").replace("ue", "u") if text.isascii() else fold(text)


def read_title(title: str | None) -> tuple[list[str], str | None, str]:
    """Content words, the marker of a part or sequel, and the letters in a row (without the marker)."""
    if not title or not title.strip():
        return [], None, ""
    flat = title.translate(_LIGATURES).strip().replace("&", " and ")
    m = _PART.search(flat)
    marker = None
    if m:
        marker = (m.group(1) or m.group(2) or m.group(3)).lower()
        marker = _ROMAN.get(marker, marker)
        flat = flat[: m.start()]
    words = re.findall(r"[^\W\d_]+", _folded(flat))
    kept = [w for w in words if w not in STOP and len(w) > 1]
    return kept, marker, "".join(w for w in words if w not in ("the", "a", "an", "and"))


def read_record(title, creators, venue, date, pages, volume) -> tuple:
    words, marker, letters = read_title(title)
    authors = sorted({w for w in re.findall(r"[^\W\d_]{4,}", _folded(_GLUED.sub(" ", creators or ""))) if w not in STOP and w != "prof"})
    prefixes = sorted({w[:4] for w in re.findall(r"[^\W\d_]+", _folded(venue or "")) if w not in STOP and len(w) > 1})
    y = _YEAR.search(date or "")
    r = _RANGE.search(pages or "")
    v = re.search(r"\d+", volume or "")
    return (
        words, marker, letters, authors, prefixes,
        int(y.group(1)) if y else None, f"{int(r.group(1))}-{int(r.group(2))}" if r else None, v.group() if v else None,
    )


_READ = [
    ("id", pa.int64(), "long"), ("words", pa.list_(pa.string()), "array<string>"), ("marker", pa.string(), "string"), ("letters", pa.string(), "string"),
    ("authors", pa.list_(pa.string()), "array<string>"), ("venue", pa.list_(pa.string()), "array<string>"), ("year", pa.int32(), "int"),
    ("pages", pa.string(), "string"), ("volume", pa.string(), "string"),
]
_READ_SCHEMA = ", ".join(f"{n} {t}" for n, _, t in _READ)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(i, *read_record(*rest)) for i, *rest in zip(*(c.to_pylist() for c in batch.columns))]
        columns = list(zip(*rows)) if rows else [()] * len(_READ)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t, _) in zip(columns, _READ)], names=[n for n, *_ in _READ])


def read_citations(biblio: DataFrame) -> DataFrame:
    b = biblio.select("biblio_id", "title", F.array_join(F.transform("authors", lambda a: a["full_name"]), " | ").alias("creators"), F.coalesce("journal", "book_title").alias("venue"), "date", "pages", "volume")
    b = b.filter("biblio_id is not null").dropDuplicates(["biblio_id"])
    return b.mapInArrow(_read, _READ_SCHEMA)


def read_works(ext: DataFrame) -> DataFrame:
    columns = {"ext_id": "long", "work_title": "string", "creators": "string", "venue": "string", "issued": "string", "page_range": "string", "vol": "string"}
    e = columns_or_null(ext, columns).filter("ext_id is not null").dropDuplicates(["ext_id"])
    return e.mapInArrow(_read, _READ_SCHEMA)


def _terms(df: DataFrame) -> DataFrame:
    def tag(prefix, column):
        return F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda x: F.concat(F.lit(prefix), x))

    one = F.array_compact(F.array(F.concat(F.lit("y "), F.col("year").cast("string")), F.concat(F.lit("p "), "pages"), F.concat(F.lit("n "), "volume")))
    bag = F.array_distinct(F.concat(tag("t ", F.col("words")), tag("a ", F.col("authors")), tag("v ", F.col("venue")), one))
    return df.select("id", F.explode(F.transform(bag, lambda t: F.xxhash64(t))).alias("term"))


def weighted(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with ``hashes`` and ``weights`` of the terms that occur in both, from the rarest on; hashes are shorter than terms."""
    a, b = _terms(left), _terms(right)
    n = left.count() + right.count()
    df = a.groupBy("term").agg(F.count("*").alias("n_a")).join(b.groupBy("term").agg(F.count("*").alias("n_b")), "term")
    weight = F.log1p((F.lit(n) - F.col("n_a") - F.col("n_b") + 0.5) / (F.col("n_a") + F.col("n_b") + 0.5))
    idf = materialize(df.select("term", weight.alias("weight")))
    out = []
    for rows, terms in ((left, a), (right, b)):
        bags = terms.join(idf, "term").groupBy("id").agg(F.reverse(F.array_sort(F.collect_list(F.struct("weight", "term")))).alias("terms"))
        out.append(materialize(rows.join(bags.select("id", F.col("terms.term").alias("hashes"), F.col("terms.weight").alias("weights")), "id")))
    return out[0], out[1]


_FEATURES = ("title", "people", "years", "pages", "volume", "venue")


def _share(a: list[str], b: list[str], slack: int) -> float:
    """Share of the shorter list's words that the other has, within ``slack`` edits for long words; -1 if one is empty."""
    if not a or not b:
        return -1.0
    few, many = (a, b) if len(a) <= len(b) else (b, a)
    rest = set(many)
    hit = 0
    for w in few:
        if w in rest:
            hit += 1
        elif len(w) > 5 and any(len(x) > 5 and distance(w, x, slack) <= slack for x in rest):
            hit += 1
    return hit / len(few)


def _near(a: str, b: str, limit: int) -> bool:
    """Whether ``distance`` is within ``limit``. A step changes at most two neighbouring pieces of ``a``, so one of 2 * limit + 1 stands in ``b`` as it is, near its place."""
    n = len(a) // (2 * limit + 1)
    if n > 1 and a != b and all(b.find(a[k : k + n], max(0, k - limit), k + n + limit) < 0 for k in range(0, (2 * limit + 1) * n, n)):
        return False
    return distance(a, b, limit) <= limit


def same_title(a: dict, b: dict) -> float:
    """1 same, 0 unknown, CUT_TITLE if one breaks off, -1 other."""
    if not a["letters"] or not b["letters"]:
        return 0.0
    if _near(a["letters"], b["letters"], TITLE_SLIPS):
        return 1.0 if a["marker"] == b["marker"] else -1.0
    short, long = sorted((a, b), key=lambda r: len(r["letters"]))
    n = len(short["letters"])
    return CUT_TITLE if n >= CUT_LETTERS and not short["marker"] and _near(short["letters"], long["letters"][:n], 2) else -1.0


def compare(a: dict, b: dict) -> tuple[float, ...]:
    """Features of a pair. title: 1 same, 0 unknown, -1 other; pages, volume: 1 equal, 0 unknown, -1 unequal; years: difference, -1 unknown."""
    title = same_title(a, b)
    agree = lambda k: 0.0 if not a[k] or not b[k] else 1.0 if a[k] == b[k] else -1.0
    years = abs(a["year"] - b["year"]) if a["year"] and b["year"] else -1
    return title, _share(a["authors"], b["authors"], 2), float(years), agree("pages"), agree("volume"), _share(a["venue"], b["venue"], 0)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [compare(x, y) for x, y in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist())]
        f = np.array(rows, float).reshape(-1, len(_FEATURES))
        columns = [*(batch.column(k) for k in range(5)), *(pa.array(f[:, k]) for k in range(f.shape[1]))]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:5], *_FEATURES])


class Bags:
    """Bags of terms in a row, each from its heaviest term on."""

    def __init__(self, batch: pa.RecordBatch):
        lists, column = batch.column("hashes"), lambda k: batch.column(k).flatten().to_numpy(zero_copy_only=False)
        self.ids = batch.column("id").to_numpy()
        self.end = np.cumsum(np.asarray(pc.list_value_length(lists)), dtype=np.int64)
        self.of = np.repeat(np.arange(len(self.ids)), np.diff(self.end, prepend=0))
        self.terms, self.weights = column("hashes").view(np.uint64), column("weights")
        self.upto = np.cumsum(self.weights)  # over all bags in a row; differences within a bag are used
        self.least = LEAST_SHARE * np.bincount(self.of, self.weights, len(self.ids)) - SLACK
        bits = np.uint64(1) << (self.terms >> np.uint64(58))
        #: Signature of the terms after each one in its bag.
        self.after = np.zeros(len(bits), np.uint64)
        left = self.end[self.of] - np.arange(len(bits)) - 1
        at = np.arange(len(bits))
        for k in range(1, int(left.max(initial=0)) + 1):
            at = at[left[at] >= k]
            self.after[at] |= bits[at + k]


def _mixed(key: np.ndarray, term: np.ndarray) -> np.ndarray:
    x = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + term
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _runs(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, as many as its count, in a row."""
    return np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())


def _portions(count: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of portions of a list whose counts add up to about PORTION each."""
    portion = np.cumsum(count) // PORTION
    bounds = [*np.flatnonzero(np.diff(portion, prepend=-1)).tolist(), len(count)]
    return zip(bounds[:-1], bounds[1:])


def keys_of(bags: Bags, enough: float, known=None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(key, place of its last term, weight so far, False): keys under which a bag is found, in parts of bounded size.

    What a pair shares, from the heaviest term on, begins with a key: its first terms until they weigh ``enough``, or DEPTH
    of them, or all that is shared. The lighter record of a pair has only the keys by which it can reach its least weight, and
    True with the starts that it carries on; a heavier record carries on only those that are ``known`` as some lighter one's.
    """

    def from_(key, at, weight, depth):
        of = bags.of[at]
        if known is None:
            can = weight + bags.upto[bags.end[of] - 1] - bags.upto[at] >= bags.least[of]
            key, at, weight, of = key[can], at[can], weight[can], of[can]
        more = weight < enough if depth < DEPTH else np.zeros(len(at), bool)
        given = ~more | (weight >= bags.least[of]) if known is None else slice(None)
        yield key[given], at[given], weight[given], False
        more &= at + 1 < bags.end[of]
        key, at, weight, count = key[more], at[more], weight[more], bags.end[of[more]] - at[more] - 1
        if known is None:
            yield key, at, weight, True
        else:
            more = known(key)
            key, at, weight, count = key[more], at[more], weight[more], count[more]
        for i, j in _portions(count):
            n = count[i:j]
            one, place = np.repeat(np.arange(i, j), n), _runs(at[i:j] + 1, n)
            yield from from_(_mixed(key[one], bags.terms[place]), place, weight[one] + bags.weights[place], depth + 1)

    yield from from_(_mixed(np.uint64(0), bags.terms), np.arange(len(bags.terms)), bags.weights, 1)


def _further(bags: Bags, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """How many bits the signatures after a key must share at least, that the lighter record can reach its least weight."""
    of = bags.of[at]
    # its next terms are its heaviest ones; they are counted until they suffice
    wanted = bags.upto[at] + bags.least[of] - weight
    place = np.minimum(np.searchsorted(bags.upto, wanted - SLACK), bags.end[of] - 1)
    rest = bags.end[of] - at - 1
    return np.maximum(place - at, 0) - (rest - np.bitwise_count(bags.after[at]))  # terms of one bit count once


#: Keys of a citation that is the lighter one, and of an outside record that is, are apart.
_ROLES = (np.uint64(0), np.uint64(0x5851F42D4C957F2D))
#: Marks of starts of keys are apart from those of keys.
_STARTS = np.uint64(0x2545F4914F6CDD1D)


_DEALT = "part long, role int, keys array<long>, ids array<long>, signs array<long>, least array<int>"


def _dealt(found: Iterator[tuple[np.ndarray, ...]], role: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Keys, ids, signatures and least common bits as one row for each part, whenever PORTION of them have come."""
    rows: list[tuple[np.ndarray, ...]] = []
    for last, row in chain(((False, x) for x in found), [(True, None)]):
        rows += [] if row is None else [row]
        if not rows or not last and sum(len(x[0]) for x in rows) < PORTION:
            continue
        key, ids, sign, least = (np.concatenate(c) for c in zip(*rows))
        rows = []
        part = (key % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        own, begin = np.unique(part[order], return_index=True)
        offsets = pa.array(np.append(begin, len(order)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(c[order])) for c in (key.view(np.int64), ids, sign.view(np.int64), least.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), role, np.int32)), *lists], names=["part", "role", "keys", "ids", "signs", "least"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[Bags]:
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            yield Bags(batch.slice(at, PIECE))


def _lighter(role: int, enough: float, parts: int, starts: bool):
    def found(batches):
        for bags in _pieces(batches):
            for key, at, weight, start in keys_of(bags, enough):
                if start == starts:
                    yield key ^ _ROLES[role] ^ (_STARTS if start else _ROLES[0]), bags.ids[bags.of[at]], bags.after[at], _further(bags, at, weight)

    return lambda batches: _dealt(found(batches), role, parts)


def _heavier(role: int, enough: float, parts: int, marks):
    def found(batches):
        bits = np.frombuffer(marks.value, np.uint8)
        shift = np.uint64(64 - (len(bits) * 8 - 1).bit_length())
        def marked(key):
            place = key >> shift
            return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

        for bags in _pieces(batches):
            for key, at, _, _ in keys_of(bags, enough, lambda start: marked(start ^ _ROLES[role] ^ _STARTS)):
                key = key ^ _ROLES[role]
                met = marked(key)
                yield key[met], bags.ids[bags.of[at[met]]], bags.after[at[met]], np.zeros(met.sum())

    return lambda batches: _dealt(found(batches), role, parts)


def _marked(width: int):
    """Bits of the keys in a slice of 2**SLICE bits; ``width`` is the logarithm of all bits."""

    def split(batches):
        for batch in batches:
            place = np.unique(batch.column("keys").flatten().to_numpy().view(np.uint64) >> np.uint64(64 - width))
            slices, begin = np.unique(place >> np.uint64(SLICE), return_index=True)
            low = pa.array((place & np.uint64((1 << SLICE) - 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(slices.astype(np.int64)), pa.ListArray.from_arrays(pa.array(np.append(begin, len(place)).astype(np.int32)), low)], names=["slice", "places"])

    def joined(key, rows):
        bits = np.zeros(1 << min(width, SLICE), np.uint8)
        bits[rows.column("places").combine_chunks().flatten().to_numpy()] = 1
        return pa.table({"slice": [key[0].as_py()], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    return split, joined


def marks_of(lighter: DataFrame) -> bytes:
    """A bitmap of the lighter records' keys and starts, of MARK_BITS bits a key but at most 2**MOST_MARKS; keys of heavier records are dropped if unmarked, as none meets them."""
    n = lighter.agg(F.sum(F.size("keys"))).first()[0] or 1
    width = min(MOST_MARKS, max(10, (MARK_BITS * n - 1).bit_length()))
    split, joined = _marked(width)
    marks = bytearray((1 << width) // 8)
    step = (1 << min(width, SLICE)) // 8
    for row in lighter.select("keys").mapInArrow(split, "slice long, places array<int>").groupBy("slice").applyInArrow(joined, "slice long, bits binary").toLocalIterator():
        marks[row["slice"] * step : (row["slice"] + 1) * step] = row["bits"]
    return bytes(marks)


def _meet(key: tuple, lighter: pa.Table, heavier: pa.Table) -> pa.Table:
    """Pairs of one key whose signatures have enough in common for the lighter record, by role."""
    out = []
    for role in (0, 1):
        (key_l, id_l, sign_l, least), (key_h, id_h, sign_h, _) = ([rows.column(c).combine_chunks().flatten().to_numpy() for c in ("keys", "ids", "signs", "least")] for rows in (t.filter(pc.equal(t.column("role"), role)) for t in (lighter, heavier)))
        order = np.argsort(key_h)
        key_h, id_h, sign_h = key_h[order], id_h[order], sign_h[order]
        begin = np.searchsorted(key_h, key_l)
        count = np.searchsorted(key_h, key_l, "right") - begin
        for i, j in _portions(count):
            one, other = np.repeat(np.arange(i, j), count[i:j]), _runs(begin[i:j], count[i:j])
            met = np.bitwise_count((sign_l[one] & sign_h[other]).view(np.uint64)) >= least[one]
            pair = (id_l[one[met]], id_h[other[met]])
            out.append(np.unique(np.stack(pair[::-1] if role else pair), axis=1))
    a, b = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight that two bags share, if it is enough."""
    for batch in batches:
        terms_a, terms_b = batch.column("hashes"), batch.column("hashes_b")
        (of_a, of_b), n = (np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(x))) for x in (terms_a, terms_b)), batch.num_rows
        weights_a, weights_b = (batch.column(k).flatten().to_numpy() for k in ("weights", "weights_b"))
        terms, of = np.concatenate((terms_a.flatten().to_numpy(), terms_b.flatten().to_numpy())), np.concatenate((of_a, of_b))
        order = np.lexsort((terms, of))  # a term stands once in a bag, so equal neighbours are of both bags
        twice = np.flatnonzero((np.diff(terms[order]) == 0) & (np.diff(of[order]) == 0))
        at = np.sort(order[twice])  # stable: the first is of bag a
        shared = np.bincount(of_a[at], weights_a[at], n)
        least = LEAST_SHARE * np.minimum(np.bincount(of_a, weights_a, n), np.bincount(of_b, weights_b, n)) - 1e-9
        kept = np.flatnonzero((shared >= least) & (shared > 0))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept)), batch.column(1).take(pa.array(kept)), pa.array(shared[kept])], names=["a", "b", "shared"])


def searched(queries: DataFrame, records: DataFrame) -> DataFrame:
    """(a, b, shared): all pairs of a query and a record that share at least LEAST_SHARE of the lighter one's weight.

    Both sides meet under keys of one to DEPTH shared terms, as many as make a key rare, so that the work follows the
    number of records and not the product of both tables. Keys are dealt to parts of bounded numbers of records.
    """
    n_queries, n_records = queries.count(), records.count()
    parts = max(1, -(-n_records // SHARD), -(-n_queries // BLOCK))
    enough = math.log(max(1.0, (n_queries + n_records) / POSTINGS))
    bags = [df.select("id", "hashes", "weights") for df in (queries, records)]
    dealt = lambda starts: bags[0].mapInArrow(_lighter(0, enough, parts, starts), _DEALT).union(bags[1].mapInArrow(_lighter(1, enough, parts, starts), _DEALT))
    lighter = materialize(dealt(False))
    marks = queries.sparkSession.sparkContext.broadcast(marks_of(lighter.select("keys").union(dealt(True).select("keys"))))
    heavier = bags[1].mapInArrow(_heavier(0, enough, parts, marks), _DEALT).union(bags[0].mapInArrow(_heavier(1, enough, parts, marks), _DEALT))
    met = lighter.groupBy("part").cogroup(heavier.groupBy("part")).applyInArrow(_meet, "a long, b long").distinct()
    sides = bags[0].withColumnRenamed("id", "a"), bags[1].select(F.col("id").alias("b"), F.col("hashes").alias("hashes_b"), F.col("weights").alias("weights_b"))
    return met.join(sides[0], "a").join(sides[1], "b").select("a", "b", "hashes", "weights", "hashes_b", "weights_b").mapInArrow(_shared, "a long, b long, shared double")


def scored_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """All pairs of enough shared weight, with their BM25 score and agreement."""
    own = F.aggregate("weights", F.lit(0.0), lambda x, w: x + w)
    length = right.agg(F.avg(F.size("hashes")).alias("usual"))
    attributes = ("letters", "marker", "year", "pages", "volume", "authors", "venue")
    side = lambda df, name, *more: df.select(F.col("id").alias(name), own.alias(f"own_{name}"), *more, F.struct(*attributes).alias(f"r{name}"))
    pairs = searched(left, right).join(side(left, "a"), "a").join(side(right, "b", F.size("hashes").alias("n_terms")), "b").crossJoin(F.broadcast(length))  # one row
    # a term stands once in a bag, so its saturation depends on the length of the bag only
    saturation = (K1 + 1) / (1 + K1 * (1 - B_LENGTH + B_LENGTH * F.col("n_terms") / F.col("usual")))
    pairs = pairs.select("a", "b", (F.col("shared") * saturation).alias("score"), "own_a", "own_b", "ra", "rb")
    return pairs.mapInArrow(_compare, "a long, b long, score double, own_a double, own_b double, " + ", ".join(f"{n} double" for n in _FEATURES))


def rated(pairs: DataFrame) -> DataFrame:
    """``pairs`` with a rating: agreement and disagreement in whole attributes move the score, so that parts of one work part."""
    turn = 1 + 0.5 * F.col("title") + 0.2 * F.col("pages") + 0.05 * F.col("volume") - F.when(F.col("years") > 1, 0.1).otherwise(0.0)
    return pairs.withColumn("rating", F.col("score") * turn)


def nearest(pairs: DataFrame) -> DataFrame:
    """Pairs that are the citation's best or tie with it, near the record's best, with the gap to the next."""
    of_a = W.partitionBy("a")  # a citation's candidates are few; an outside record may have very many, so its best is aggregated
    pairs = rated(pairs)
    best_b = pairs.groupBy("b").agg(F.max("rating").alias("best_b"))
    pairs = pairs.join(best_b, "b").withColumn("best_a", F.max("rating").over(of_a))
    order = of_a.orderBy(F.desc("rating"), "b")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("next", F.lead("rating").over(order))
    second = F.when(F.col("rank") == 1, F.coalesce("next", F.lit(0.0))).otherwise(F.col("best_a"))
    kept = pairs.withColumn("gap", (F.col("rating") - second) / F.greatest("best_a", F.lit(1e-9)))
    return kept.filter((F.col("rating") >= TIE * F.col("best_a")) & (F.col("rating") >= NEAR_BEST * F.least("best_b", "own_a")))


def _design(df: DataFrame) -> DataFrame:
    whole = F.col("score") / F.greatest(F.least("own_a", "own_b"), F.lit(1e-9))
    return df.withColumn("x", F.array(F.lit(1.0), whole, "gap", "title", F.greatest("people", F.lit(0.0)), (F.col("people") == 0).cast("double"), (F.col("years") > 1).cast("double"), "pages", "volume", F.greatest("venue", F.lit(0.0))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


#: Designs of a full agreement and a full disagreement, which stand in every sample, so that it has both kinds.
PROTOTYPES = (((1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 1.0, 1.0, 1.0), 1.0), ((1.0, 0.0, 0.0, -1.0, 0.0, 1.0, 1.0, -1.0, -1.0, 0.0), 0.0))


def calibrated(near: DataFrame) -> DataFrame:
    """``near`` with a confidence. Clear cases of a bounded sample: equal pages and titles against unequal ones."""
    designed = _design(near)
    clear = designed.withColumn("y", F.when((F.col("title") == 1) & (F.col("pages") == 1), 1.0).when((F.col("title") == -1) | (F.col("pages") == -1), 0.0)).filter("y is not null")
    rows = [*((r.x, r.y) for r in clear.orderBy(F.xxhash64("a", "b"), "a", "b").limit(SAMPLE_PAIRS).select("x", "y").collect()), *PROTOTYPES]
    weights = fit_logistic(np.array([x for x, _ in rows]), np.array([y for _, y in rows])).tolist()
    logit = sum(F.col("x")[k] * w for k, w in enumerate(weights))
    return designed.withColumn("confidence", 1 / (1 + F.exp(-logit)))


def match_records(biblio: DataFrame, ext: DataFrame) -> DataFrame:
    """(biblio_id, ext_id, confidence): citations with the outside record of the same work."""
    left, right = weighted(materialize(read_citations(biblio)), materialize(read_works(ext)))
    near = calibrated(materialize(nearest(materialize(scored_pairs(left, right)))))
    return near.filter(F.col("confidence") >= LEAST_CONFIDENCE).select(F.col("a").alias("biblio_id"), F.col("b").alias("ext_id"), "confidence")


def p7_matches(spark: SparkSession, root: str) -> DataFrame:
    return match_records(table(spark, root, "biblio"), table(spark, root, "ext_records"))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return p7_matches(spark, root).select("biblio_id", "ext_id")


QUERIES = {"p7_found": p7_found, "p7_matches": p7_matches}
SQL: dict[str, str] = {}
