"""Nested JSON records to linked flat tables, by vectorised structural indexing.

A batch of payloads is laid out as one byte array. Bitmaps mark escapes, quotes and the
delimiters outside strings; prefix sums give string membership and nesting depth; a sort by
(document, depth, position) gives every token its container. Grammar checks, key lookup and
array positions are array operations over all tokens of the batch. Only the spans that end up
in output rows are decoded one by one.

Results for awkward input: null, blank or invalid JSON gives no rows; JSON inside a JSON string,
be it the payload or any level below, is unwrapped as often as needed; a lone object stands for an array of one; nulls in arrays keep
their position but give no row; repeated payloads give repeated rows (callers make them distinct).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that are indexed together in one pass.
CHUNK_BYTES = 4 << 20
#: Bytes of a key that are compared as fixed-width rows; longer keys are decoded one by one.
KEY_BYTES = 24

# Field names as written by the program versions, without underscores and in lower case.
HEADER_KEYS = ("header",)
CITATION_KEYS = ("citations",)
ROLE_KEYS = {"authors": "author", "author": "author", "editors": "editor", "editor": "editor"}
AFFILIATION_KEYS = ("affiliation", "affiliations")
ADDRESS_KEYS = ("address",)
INDEX_KEY = "index"
LEVEL_KEYS = frozenset((*HEADER_KEYS, *CITATION_KEYS, *ROLE_KEYS, *AFFILIATION_KEYS, *ADDRESS_KEYS))
RECORD_KEYS = frozenset((*HEADER_KEYS, *CITATION_KEYS, "authors", "title", "grobidversion"))

_NUMBER = re.compile(rb"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?\Z")
_OPEN, _CLOSE, _COLON, _COMMA, _STRING, _SCALAR = range(6)

NODE_SCHEMA = T.StructType(
    [
        T.StructField("rec_id", T.LongType()),
        T.StructField("level", T.StringType()),
        T.StructField("biblio_no", T.LongType()),
        T.StructField("person_role", T.StringType()),
        T.StructField("person_no", T.LongType()),
        T.StructField("affil_no", T.LongType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    ]
)


class Index:
    """Structural index of a list of payloads (bytes)."""

    def __init__(self, texts: list[bytes]):
        n = len(texts)
        lens = np.fromiter((len(t) for t in texts), np.int64, n)
        begin = np.zeros(n + 1, np.int64)
        np.cumsum(lens + 1, out=begin[1:])
        self.begin = begin
        self.blob = b"\n".join(texts) + b"\n"
        b = np.frombuffer(self.blob, np.uint8)
        size = len(b)
        at = np.arange(size)
        # escapes: a byte after an odd run of backslashes
        back = b == 0x5C
        first = back & ~np.concatenate(([False], back[:-1]))
        run = np.maximum.accumulate(np.where(first, at, -1))
        escaped = np.zeros(size, bool)
        prev = np.flatnonzero(back[:-1])
        escaped[prev + 1] = ((prev - run[prev]) & 1) == 0
        quote = (b == 0x22) & ~escaped
        parity = np.cumsum(quote, dtype=np.int64)
        base = np.concatenate(([0], parity[begin[1:] - 1]))[:-1]
        doc_of = np.repeat(np.arange(n), lens + 1)
        odd = ((parity - base[doc_of]) & 1) == 1
        opening, closing = quote & odd, quote & ~odd
        inside = odd & ~opening  # string content
        bad = np.zeros(n, bool)
        # an unfinished string, a control byte or a bad escape in a string
        bad[odd[begin[1:] - 1]] = True
        bad[doc_of[inside & (b < 0x20)]] = True
        esc = np.flatnonzero(escaped & inside)
        known = np.isin(b[esc], np.frombuffer(b'"\\/bfnrtu', np.uint8))
        bad[doc_of[esc[~known]]] = True
        u = esc[b[esc] == ord("u")]
        if len(u):
            hexes = b[np.minimum(u[:, None] + np.arange(1, 5), size - 1)]
            good = ((hexes >= 48) & (hexes <= 57)) | ((hexes | 32) >= 97) & ((hexes | 32) <= 102)
            bad[doc_of[u[~good.all(1)]]] = True
        outside = ~inside & ~quote
        kind = np.full(size, -1, np.int8)
        for chars, k in ((b"{[", _OPEN), (b"}]", _CLOSE), (b":", _COLON), (b",", _COMMA)):
            kind[outside & np.isin(b, np.frombuffer(chars, np.uint8))] = k
        kind[opening] = _STRING
        space = (b == 0x20) | (b == 0x0A) | (b == 0x0D) | (b == 0x09)
        scalar = outside & (kind == -1) & ~space
        # the separator after each document ends a scalar
        scalar_first = scalar & ~np.concatenate(([False], scalar[:-1]))
        kind[scalar_first] = _SCALAR
        pos = np.flatnonzero(kind >= 0)
        self.pos, self.kind, self.doc = pos, kind[pos], doc_of[pos]
        m = len(pos)
        self.end = np.full(m, -1, np.int64)  # last byte of the token
        ends = np.flatnonzero(closing)
        strings = self.kind == _STRING
        nth = np.searchsorted(ends, pos[strings])
        self.end[strings] = ends[np.minimum(nth, len(ends) - 1)] if len(ends) else -1
        scalars = np.flatnonzero(self.kind == _SCALAR)
        stops = np.flatnonzero(scalar & ~np.concatenate((scalar[1:], [False])))
        self.end[scalars] = stops
        self.byte = b[pos]
        for i in scalars.tolist():
            word = self.blob[pos[i] : self.end[i] + 1]
            if word not in (b"null", b"true", b"false") and not _NUMBER.match(word):
                bad[self.doc[i]] = True
        # depth by prefix sums, taken anew for each document
        step = (self.kind == _OPEN).astype(np.int64) - (self.kind == _CLOSE)
        total = np.cumsum(step)
        tok_begin = np.searchsorted(self.doc, np.arange(n))
        tok_end = np.searchsorted(self.doc, np.arange(n), "right")
        zero = np.where(tok_begin > 0, total[np.maximum(tok_begin - 1, 0)] if m else 0, 0)
        depth = total - zero[self.doc] if m else total
        level = np.where(self.kind == _OPEN, depth - 1, np.where(self.kind == _CLOSE, depth, depth))
        bad[self.doc[depth < 0]] = True
        has = tok_end > tok_begin
        bad[~has] = True
        bad[np.flatnonzero(has)[depth[tok_end[has] - 1] != 0]] = True
        # container: the last opener of the level below, by a sort over (document, level, position)
        self.parent = np.full(m, -1, np.int64)
        tok = np.arange(m)
        opener = np.flatnonzero(self.kind == _OPEN)
        inner = np.where(self.kind == _CLOSE, level + 1, level)  # a closer belongs to the container it closes
        docs = np.concatenate((self.doc, self.doc[opener]))
        levels = np.concatenate((inner, level[opener] + 1))
        toks = np.concatenate((tok, opener))
        mark = np.concatenate((np.zeros(m, bool), np.ones(len(opener), bool)))
        order = np.lexsort((mark, toks, levels, docs))
        marks = np.where(mark[order], np.arange(len(order)), -1)
        last = np.maximum.accumulate(marks) if len(marks) else marks
        group = np.flatnonzero(np.diff(docs[order], prepend=-1) | np.diff(levels[order], prepend=-1))
        group_of = np.repeat(group, np.diff(np.append(group, len(order)))) if len(order) else group
        valid = (last >= group_of) & ~mark[order]
        self.parent[toks[order][valid]] = toks[order][last[valid]]
        par_byte = np.where(self.parent >= 0, self.byte[self.parent], 0) if m else np.zeros(0, np.uint8)
        closes = self.kind == _CLOSE
        bad[self.doc[closes & (par_byte + 2 != self.byte)]] = True
        # grammar: each token against the one before it
        before = np.full(m, -1, np.int8)
        before[1:] = np.where(self.doc[1:] == self.doc[:-1], self.kind[:-1], -1)
        in_object, in_array = par_byte == 0x7B, par_byte == 0x5B
        self.key = strings & in_object & ((before == _OPEN) | (before == _COMMA))
        key_before = np.zeros(m, bool)
        key_before[1:] = self.key[:-1] & (self.doc[1:] == self.doc[:-1])
        value_end = ((before == _STRING) & ~key_before) | (before == _SCALAR) | (before == _CLOSE)
        self.value = ((strings & ~self.key) | (self.kind == _SCALAR) | (self.kind == _OPEN))
        fine = np.where(
            self.value,
            np.where(in_object, before == _COLON, np.where(in_array, (before == _OPEN) | (before == _COMMA), before == -1)),
            np.where(
                self.key,
                True,
                np.where(
                    self.kind == _COLON,
                    key_before & in_object,
                    np.where(self.kind == _COMMA, value_end & (self.parent >= 0), value_end | (before == _OPEN)),
                ),
            ),
        )
        bad[self.doc[~fine]] = True
        self.valid = ~bad
        self.replaced = np.zeros(n, bool)  # set where a text comes again with its strings unwrapped
        self.root = np.where(has, tok_begin, -1)
        # key of a value: the string two tokens before it
        self.name = np.full(m, -1, np.int64)
        if m:
            spans = np.flatnonzero(self.key)
            ids, self.names = self._names(spans)
            of = np.full(m, -1, np.int64)
            of[spans] = ids
            vals = np.flatnonzero(self.value & in_object)
            vals = vals[vals >= 2]
            self.name[vals] = of[vals - 2]
        else:
            self.names = []
        # children of each container in order
        kids = np.flatnonzero(self.value & (self.parent >= 0))
        self.kids = kids[np.argsort(self.parent[kids], kind="stable")]
        # what is read node by node, as plain lists
        self._begin = np.searchsorted(self.parent[self.kids], np.arange(m + 1)).tolist()
        self._kids, self._name, self._kind = self.kids.tolist(), self.name.tolist(), self.kind.tolist()
        self._pos, self._end, self._byte = pos.tolist(), self.end.tolist(), self.byte.tobytes()

    def _names(self, spans: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """Distinct normalised keys, compared as fixed-width byte rows."""
        if not len(spans):
            return np.zeros(0, np.int64), []
        b = np.frombuffer(self.blob, np.uint8)
        start = self.pos[spans] + 1
        length = self.end[spans] - start
        grid = b[np.minimum(start[:, None] + np.arange(KEY_BYTES), len(b) - 1)]
        grid = np.where(np.arange(KEY_BYTES) < length[:, None], grid, 0).astype(np.uint8)
        rows = np.ascontiguousarray(grid).view(f"V{KEY_BYTES}").ravel()
        found, inverse = np.unique(rows, return_inverse=True)
        plain = lambda x: x.decode("utf-8", "replace").replace("_", "").lower()
        names = [plain(bytes(x).rstrip(b"\0")) for x in found]
        longer: dict[bytes, int] = {}
        for k in np.flatnonzero(length > KEY_BYTES).tolist():
            whole = self.blob[start[k] : start[k] + length[k]]
            if whole not in longer:
                longer[whole] = len(names)
                names.append(plain(whole))
            inverse[k] = longer[whole]
        return inverse, names

    def key_above(self, node: int) -> str:
        """The key of a value, or of the arrays it is in."""
        while node >= 0 and self.name[node] < 0:
            node = int(self.parent[node])
        return self.names[self.name[node]] if node >= 0 else ""

    def children(self, node: int) -> list[int]:
        return self._kids[self._begin[node] : self._begin[node + 1]]

    def is_open(self, node: int) -> bool:
        return self._kind[node] == _OPEN

    def is_object(self, node: int) -> bool:
        return self._byte[node] == 0x7B

    def is_array(self, node: int) -> bool:
        return self._byte[node] == 0x5B

    def members(self, node: int) -> dict[str, int]:
        """Fields of an object by normalised name; of a repeated name the last counts."""
        if node < 0 or not self.is_object(node):
            return {}
        names, name = self.names, self._name
        return {names[name[k]]: k for k in self.children(node) if name[k] >= 0}

    def items(self, node: int) -> list[int]:
        """Elements of an array; any other value is an array of one; null is none."""
        if self.is_array(node):
            return self.children(node)
        return [] if self.text(node) is None else [node]

    def text(self, node: int) -> str | None:
        """A scalar as text (null: none); a container as its JSON."""
        kind = self._kind[node]
        if kind == _STRING:
            raw = self.blob[self._pos[node] : self._end[node] + 1]
            return raw[1:-1].decode("utf-8", "replace") if b"\\" not in raw else json.loads(raw)
        if kind == _SCALAR:
            raw = self.blob[self._pos[node] : self._end[node] + 1].decode()
            return None if raw == "null" else raw
        return self.blob[self._pos[node] : self.close(node) + 1].decode("utf-8", "replace")

    def close(self, node: int) -> int:
        """Byte of the bracket that closes a container."""
        depth, i = 0, node
        while True:
            depth += (self._kind[i] == _OPEN) - (self._kind[i] == _CLOSE)
            if depth == 0:
                return self._pos[i]
            i += 1


def _wrapped(index: Index) -> Iterator[tuple[int, bytes]]:
    """(token, content) of the strings that may hold nested JSON: the whole payload, objects anywhere, arrays at the levels of the record."""
    if not len(index.pos):
        return
    head = np.frombuffer(index.blob, np.uint8)[index.pos + 1]  # the byte after the token's first; each text ends in a separator
    some = (index.kind == _STRING) & index.value & index.valid[index.doc] & np.isin(head, np.frombuffer(b"{[ \\\"", np.uint8))
    for node in np.flatnonzero(some).tolist():
        inner = (index.text(node) or "").strip()
        while inner[:1] == '"':  # wrapped more than once
            try:
                inner = json.loads(inner).strip()
            except ValueError:
                break
        if inner[:1] == "{" or inner[:1] == "[" and (index.parent[node] < 0 or index.key_above(node) in LEVEL_KEYS):
            yield node, inner.encode("utf-8", "surrogatepass")


def _unwrapped(index: Index) -> dict[int, bytes]:
    """New texts of the payloads in which strings hold valid JSON, with these put in their place."""
    found = list(_wrapped(index))
    inner = Index([t for _, t in found])
    fits = [(node, t) for k, (node, t) in enumerate(found) if inner.valid[k] and inner.kind[inner.root[k]] == _OPEN]
    parts: dict[int, list[bytes]] = {}
    done: dict[int, int] = {}
    for node, text in fits:  # in order of position
        doc = int(index.doc[node])
        parts.setdefault(doc, []).extend((index.blob[done.get(doc, index.begin[doc]) : index.pos[node]], text))
        done[doc] = int(index.end[node]) + 1
    return {doc: b"".join(p) + index.blob[done[doc] : index.begin[doc + 1] - 1] for doc, p in parts.items()}


def index_all(texts: list[str | None]) -> Iterator[tuple[list[int], Index]]:
    """Structural indexes over ``texts`` in chunks, with the row of each indexed text.

    Strings that hold JSON, at any depth and as often as they are wrapped, are put in place and indexed again;
    an index marks the texts that do so as replaced.
    """
    todo = [(i, t.encode("utf-8", "surrogatepass")) for i, t in enumerate(texts) if t]
    while todo:
        again: list[tuple[int, bytes]] = []
        at = 0
        while at < len(todo):
            stop, size = at, 0
            while stop < len(todo) and (stop == at or size + len(todo[stop][1]) <= CHUNK_BYTES):
                size += len(todo[stop][1])
                stop += 1
            part = todo[at:stop]
            index = Index([t for _, t in part])
            for k, text in _unwrapped(index).items():
                again.append((part[k][0], text))
                index.replaced[k] = True
            yield [row for row, _ in part], index
            at = stop
        todo = again


def _record(index: Index, root: int) -> int:
    """The record inside wrapper objects and arrays of one: the first node downwards that has a record's fields; -1 if none."""
    level = [root]
    while level:
        for node in level:
            if index.is_object(node) and RECORD_KEYS & index.members(node).keys():
                return node
        level = [k for node in level if index.is_open(node) for k in index.children(node) if index.is_open(k)]
    return -1


def _scalars(index: Index, members: dict[str, int], skip: frozenset[str], above: str = "") -> dict[str, str]:
    """Scalar fields by name; those of an object inside by dotted names; an array as its JSON."""
    out = {}
    for name, node in members.items():
        if name in skip:
            continue
        if index.is_object(node):
            out |= _scalars(index, index.members(node), frozenset(), f"{above}{name}.")
        elif (text := index.text(node)) is not None:
            out[above + name] = text
    return out


_DOC_SKIP = frozenset((*HEADER_KEYS, *CITATION_KEYS, *ROLE_KEYS))
_PERSON_SKIP = frozenset(AFFILIATION_KEYS)
_AFFIL_SKIP = frozenset(ADDRESS_KEYS)


_UPPER = frozenset(("document", "biblio"))
LEVELS = frozenset(("document", "biblio", "person", "affiliation", "address"))


def _first(members: dict[str, int], names: tuple[str, ...]) -> int:
    return next((members[n] for n in names if n in members), -1)


def _nodes(index: Index, root: int, wanted: frozenset[str]) -> Iterator[tuple]:
    """Rows (level, biblio_no, role, person_no, affil_no, fields) of the wanted levels of one valid payload."""
    record = _record(index, root)
    if record < 0:
        return
    top = index.members(record)
    if "document" in wanted:
        yield "document", None, None, None, None, _scalars(index, top, _DOC_SKIP)
    head = _first(top, HEADER_KEYS)
    biblios: list[tuple[int, dict[str, int]]] = []
    if head >= 0:
        heads = [x for x in index.items(head) if index.is_object(x)]
        biblios += [(0, index.members(x)) for x in heads[:1]]
    else:
        biblios.append((0, top))
    cites = _first(top, CITATION_KEYS)
    if cites >= 0:
        nodes = index.items(cites)
        if index.is_object(cites):
            inner = index.children(cites)
            if INDEX_KEY not in index.members(cites) and all(index.is_object(x) for x in inner):
                nodes = inner  # a map from citation id to citation
        for place, node in enumerate(nodes):
            if index.is_object(node):
                members = index.members(node)
                given = index.text(members[INDEX_KEY]) if INDEX_KEY in members else None
                number = int(given) if given is not None and re.fullmatch(r"\s*\d+\s*", given) else place
                biblios.append((number + 1, members))
    for number, members in biblios:
        if "biblio" in wanted:
            yield "biblio", number, None, None, None, _scalars(index, members, _DOC_SKIP)
        if wanted <= _UPPER:
            continue
        for name, role in ROLE_KEYS.items():
            if name not in members:
                continue
            for p, person in enumerate(index.items(members[name]), 1):
                fields = index.members(person)
                text = None if index.is_open(person) else index.text(person)
                if not fields and text is None:
                    continue
                if "person" in wanted:
                    yield "person", number, role, p, None, _scalars(index, fields, _PERSON_SKIP) if fields else {"fullname": text}
                affils = _first(fields, AFFILIATION_KEYS)
                for a, affil in enumerate(index.items(affils) if affils >= 0 else [], 1):
                    inner = index.members(affil)
                    if not index.is_open(affil):
                        if "affiliation" in wanted and (text := index.text(affil)) is not None:
                            yield "affiliation", number, role, p, a, {"institution": text}
                        continue
                    if not inner:
                        continue
                    if "affiliation" in wanted:
                        yield "affiliation", number, role, p, a, _scalars(index, inner, _AFFIL_SKIP)
                    if "address" not in wanted:
                        continue
                    address = _first(inner, ADDRESS_KEYS)
                    values: dict[str, str] = {}
                    for x in index.items(address) if address >= 0 else []:
                        if index.is_object(x):
                            values |= {k: v for k, v in _scalars(index, index.members(x), frozenset()).items() if v.strip()}
                        elif (text := index.text(x)) is not None and text.strip():
                            values["text"] = text
                    if values:
                        yield "address", number, role, p, a, values


def _flatten(levels: frozenset[str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("rec_id", pa.int64()),
                ("level", pa.string()),
                ("biblio_no", pa.int64()),
                ("person_role", pa.string()),
                ("person_no", pa.int64()),
                ("affil_no", pa.int64()),
                ("fields", pa.map_(pa.string(), pa.string())),
            ]
        )
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for rows, index in index_all(texts):
                out: list[list] = [[] for _ in schema]
                for k, row in enumerate(rows):
                    if index.valid[k] and not index.replaced[k] and index.kind[index.root[k]] == _OPEN:
                        for level, *keys, fields in _nodes(index, int(index.root[k]), levels or LEVELS):
                            for column, value in zip(out, (ids[row], level, *keys, list(fields.items()))):
                                column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return run


def flatten_records(df: DataFrame, id_col: str = "rec_id", payload_col: str = "payload", levels: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of every level of each payload: document, biblio, person, affiliation, address.

    A child row carries the keys of its parents (rec_id, biblio_no, person_role, person_no, affil_no);
    ``fields`` holds the scalar fields under normalised names, those of objects inside under dotted ones. One narrow pass, no shuffle.
    Null, blank and invalid payloads give no rows; an empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).cast("long").alias("rec_id"), F.col(payload_col).cast("string").alias("payload"))
    rows = rows.filter(F.col("payload").isNotNull() & (F.length("payload") > 0))
    return rows.mapInArrow(_flatten(frozenset(levels) if levels else None), NODE_SCHEMA)
