"""Bodies, tables, figures, notes and references of TEI documents, read with the standard XML parser.

One document is one text; the parser runs in Arrow batches, no shuffle. Broken XML, null and empty text give
a null row. References to missing targets keep their text.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.body_steps import latex_table

NS = "{http://www.tei-c.org/ns/1.0}"
_SPACE = re.compile(r"\s+")


def _local(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def _flat(e: ET.Element | None) -> str:
    return _SPACE.sub(" ", "".join(e.itertext())).strip() if e is not None else ""


def _all(e: ET.Element, name: str) -> list[ET.Element]:
    return [x for x in e.iter() if _local(x) == name]


def _first(e: ET.Element | None, *path: str) -> ET.Element | None:
    for name in path:
        if e is None:
            return None
        e = next((x for x in e if _local(x) == name), None)
    return e


def person(e: ET.Element) -> dict[str, str | None]:
    """Name parts of a persName."""
    by = {"forename": [], "middle": [], "surname": []}
    for x in e:
        name = _local(x)
        if name == "forename":
            by["middle" if x.get("type") == "middle" else "forename"].append(_flat(x))
        elif name == "surname":
            by["surname"].append(_flat(x))
    parts = {k: " ".join(v) or None for k, v in by.items()}
    full = " ".join(v for v in (parts["forename"], parts["middle"], parts["surname"]) if v) or _flat(e)
    return {"full_name": full or None, "given_name": parts["forename"], "middle_name": parts["middle"], "surname": parts["surname"]}


def reference(e: ET.Element) -> dict[str, str | None]:
    """Fields of a biblStruct; the DOI without its address, pages as from-to."""
    title = next((t for t in _all(e, "title") if t.get("level") == "a"), None)
    journal = next((t for t in _all(e, "title") if t.get("level") == "j"), None)
    book = next((t for t in _all(e, "title") if t.get("level") == "m"), None)
    if title is None and book is not None:
        title, book = book, None
    out: dict[str, str | None] = {"key": e.get("{http://www.w3.org/XML/1998/namespace}id"), "title": _flat(title) or None, "journal": _flat(journal) or None, "book_title": _flat(book) or None}
    for x in _all(e, "biblScope"):
        if x.get("unit") == "page" and x.get("from"):
            out["pages"] = "-".join(v for v in (x.get("from"), x.get("to")) if v)
        elif x.get("unit"):
            out["pages" if x.get("unit") == "page" else x.get("unit")] = _flat(x) or None
    for x in _all(e, "idno"):
        kind = (x.get("type") or "").lower()
        out["doi" if kind == "doi" else "arxiv" if kind == "arxiv" else kind or "idno"] = re.sub(r"^(https?://(dx\.)?doi\.org/|arxiv:)", "", _flat(x), flags=re.I) or None
    date = next(iter(_all(e, "date")), None)
    out["date"] = (date.get("when") or _flat(date) or None) if date is not None else None
    out["authors"] = "; ".join(p["full_name"] for x in _all(e, "author") for y in _all(x, "persName") if (p := person(y))["full_name"]) or None
    return {k: v for k, v in out.items() if v}


def pipe_table(e: ET.Element) -> str:
    """A grid of the cells; spans repeat their text, rows are cut or filled to the width of the first, missing cells read None."""
    rows = []
    for r in _all(e, "row"):
        cells: list[str] = []
        for c in r:
            if _local(c) == "cell":
                cells += [_flat(c) or "None"] * max(1, int(c.get("cols") or 1) if (c.get("cols") or "1").isdigit() else 1)
        rows.append(cells)
    if not rows or not rows[0]:
        return ""
    width = len(rows[0])
    rows = [(r + ["None"] * width)[:width] for r in rows]
    line = lambda r: "|" + "|".join(r) + "|"
    return "\n".join([line(rows[0]), line(["-"] * width), *map(line, rows[1:])])


def figure(e: ET.Element) -> str:
    """A figure or table between the project's tags."""
    kind = "TABLE" if e.get("type") == "table" else "FIGURE"
    head, label, text = _flat(_first(e, "head")), _flat(_first(e, "label")), _flat(_first(e, "figDesc"))
    parts = [x for x in (head or (f"{kind.title()} {label}" if label else ""), text, pipe_table(e) if kind == "TABLE" else "") if x]
    return f"[START_{kind}]\n" + "\n\n".join(parts) + f"\n\n[END_{kind}]"


def paragraph(e: ET.Element, known: set[str]) -> str:
    """Running text with references and formulas tagged; unresolved citations keep their text only."""
    out = [e.text or ""]
    for x in e:
        name, inner = _local(x), _flat(x)
        if name == "ref":
            target = (x.get("target") or "").lstrip("#")
            out.append(f"[START_REF]{inner}[END_REF]" if target in known else inner)
        elif name == "formula":
            out.append(f"[START_FORMULA]{inner}[END_FORMULA]")
        elif name == "s":
            out.append(paragraph(x, known) + " ")
        else:
            out.append(inner)
        out.append(x.tail or "")
    return _SPACE.sub(" ", "".join(out)).strip()


def heading(e: ET.Element) -> str:
    """A section's title as a heading as deep as its number."""
    number = (e.get("n") or "").strip(".")
    depth = len(number.split(".")) if number else 1
    return "#" * (depth + 1) + " " + " ".join(v for v in (number, _flat(e)) if v)


def read_document(xml: str | None) -> dict | None:
    """Title, contents, body, figures, tables, notes and references of a TEI document."""
    if not xml or not xml.strip():
        return None
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return None
    cites = [reference(x) for b in _all(root, "listBibl") for x in b if _local(x) == "biblStruct"]
    known = {c["key"] for c in cites if "key" in c} | {x.get("{http://www.w3.org/XML/1998/namespace}id") or "" for x in _all(root, "figure")}
    body: list[str] = []
    contents: list[str] = []
    figures: list[str] = []
    tables: list[str] = []
    notes: list[str] = []
    text = next(iter(_all(root, "text")), root)
    for b in _all(text, "body"):
        for div in [x for x in b.iter() if _local(x) == "div"]:
            for x in div:
                name = _local(x)
                if name == "head" and _flat(x):
                    h = heading(x)
                    body.append(h)
                    contents.append("\t" * (len(h) - len(h.lstrip("#")) - 2) + h.lstrip("# "))
                elif name == "p":
                    body.append(paragraph(x, known))
                elif name == "formula":
                    body.append(f"[START_FORMULA]{_flat(x)}[END_FORMULA]")
        for x in _all(b, "figure"):
            (tables if x.get("type") == "table" else figures).append(figure(x))
        notes += [f"[START_NOTE]{_flat(x)}[END_NOTE]" for x in _all(b, "note")]
    title = next((_flat(t) for t in _all(root, "title") if _flat(t)), None)
    abstract = " ".join(_flat(p) for a in _all(root, "abstract") for p in _all(a, "p")) or None
    entries = [f"{i}.[{i}](<{c.get('key', '')}>{'.'.join(v for v in (c.get('authors'), c.get('title')) if v)}" + (f",{c['journal']}" if "journal" in c else "") + ")" for i, c in enumerate(cites)]
    return {"title": title, "abstract": abstract, "contents": "\n".join(contents), "body": "\n\n".join(body), "figures": figures, "tables": tables, "notes": notes, "references": entries}


def render(doc: dict) -> str:
    """The document as one text in a fixed order of sections."""
    parts = [("#Title", doc["title"]), ("##Contents", doc["contents"]), ("##Figures", "\n".join(doc["figures"])), ("##Tables", "\n".join(doc["tables"])), ("##Reference", "\n".join(doc["references"])), ("#Main Body", "\n\n".join(v for v in (doc["abstract"], doc["body"]) if v))]
    return "\n".join(f"{head}\n{text}" for head, text in parts if text)


def latex_of(xml: str | None) -> list[str] | None:
    """The tables of a TEI document as LaTeX; null where the XML cannot be read."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return None
    out = []
    for e in _all(root, "figure"):
        if e.get("type") != "table":
            continue
        rows = [[c for c in r if _local(c) == "cell"] for r in _all(e, "row")]
        spans = [[int(c.get("cols") or 1) if (c.get("cols") or "1").isdigit() else 1 for c in r] for r in rows]
        caption = [x for x in (_flat(_first(e, "figDesc")),) if x]
        out.append(latex_table(caption, [[_flat(c) or None for c in r] for r in rows], spans, _flat(_first(e, "label"))))
    return out


def latex_tables(df: DataFrame, key: str, xml: str) -> DataFrame:
    """(id, tables) of every TEI document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([latex_of(x) for x in batch.column(1).to_pylist()], pa.list_(pa.string()))], names=["id", "tables"])

    return df.select(F.col(key).cast("string").alias("id"), F.col(xml).cast("string")).mapInArrow(run, "id string, tables array<string>")


_LISTS = ("figures", "tables", "notes", "references")
_SCHEMA = "id string, title string, abstract string, contents string, body string, figures array<string>, tables array<string>, notes array<string>, references array<string>, text string"


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    for batch in batches:
        rows = []
        for key, xml in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            doc = read_document(xml)
            rows.append((key, *([None] * (len(names) - 1))) if doc is None else (key, *(doc[n] for n in names[1:-1]), render(doc)))
        columns = list(zip(*rows)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.string()) if n in _LISTS else pa.string()) for c, n in zip(columns, names)], names=names)


def read_documents(df: DataFrame, key: str, xml: str) -> DataFrame:
    """One row per document; all but the key null where the XML cannot be read."""
    return df.select(F.col(key).cast("string"), F.col(xml).cast("string")).mapInArrow(_run, _SCHEMA)
