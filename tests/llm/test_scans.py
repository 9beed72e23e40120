"""Scan defects on small items, and the repair of lines."""

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.scans import CONFUSIONS, _skeletons, explains, reflow, repair_lines, scan_defects, skeleton

GOOD = "the modern kernel of a balanced channel shows a stable element during winter months".split()


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(GOOD), st.lists(st.tuples(st.integers(0, 20), st.sampled_from(CONFUSIONS)), min_size=1, max_size=3))
def test_every_confusion_keeps_the_skeleton(word, changes):
    seen = word
    for _, (right, wrong) in changes:
        if right in word:
            seen = word.replace(right, wrong, 1)
            break
    if seen != word:
        assert skeleton(seen) == skeleton(word) and explains(seen, word)
    assert not explains(word, word)


def rows(pages=4):
    out, n = [], 0

    def add(page, y, cat, lines):
        nonlocal n
        n += 1
        out.append((n, "item", page, n, cat, [0.0, float(y)] + [0.0] * 6, lines, "\n".join(lines)))
        return n

    ids = {}
    body = [" ".join(GOOD), "and the channel of the kernel"]
    for p in range(1, pages + 1):
        ids[f"head{p}"] = add(p, 40, 2, ["THE STABLE KERNEL" + (f"  {p + 10}" if p == 2 else "")])
        add(p, 120, 1, body)
        ids[f"number{p}"] = add(p, 500, 2, [f"- {p + 10} -"])
    ids["title"] = add(1, 60, 0, ["The stable kernel"])
    ids["hyphen"] = add(1, 200, 1, ["a bal-", "anced channel"])
    ids["soft"] = add(1, 210, 1, ["a stab¬", "le kernel."])
    for _ in range(3):
        ids["compound"] = add(2, 220, 1, ["a long-", "term channel."])
    ids["misread"] = add(2, 230, 1, ["the kcrnel of a channel."])
    ids["glyph"] = add(2, 240, 1, ["some un!que words."])
    for y in range(241, 245):  # a form with a glyph inside is a misreading where its right form has support
        add(2, y, 1, ["some unique words."])
    add(2, 246, 1, ["un5upported form."])
    ids["number"] = add(3, 250, 1, ["about 1O.5 units of H2O and B12, plot 3b."])
    ids["spaced"] = add(3, 260, 1, ["a s t a b l e channel."])
    ids["year"] = add(3, 270, 1, ["1994"])
    return out, ids


SCHEMA = "det_id long, data_id string, page int, box_id int, category_id int, poly array<double>, ptrmfr_texts array<string>, content string"


def test_defects(spark):
    data, ids = rows()
    got = {(r.det_id, r.defect) for r in scan_defects(spark.createDataFrame(data, SCHEMA)).collect()}
    want = {(ids[k], "hyphen") for k in ("hyphen", "soft")} | {(ids[k], "misread") for k in ("misread", "glyph", "number", "spaced")}
    want |= {(ids[f"head{p}"], "header") for p in range(1, 5)} | {(ids[f"number{p}"], "page_number") for p in range(1, 5)} | {(ids["head2"], "page_number")}
    assert got == want


def test_awkward_rows(spark):
    base = [(1, None, None, None, None, None, None, None), (2, "i", 1, 0, 1, [], [], ""), (3, "i", 1, 0, 1, None, None, "only content"), (4, "i", 1, 1, 1, [], ["word"] * 5000, "x")]
    df = spark.createDataFrame(base * 2, SCHEMA).selectExpr("*", "'y' as key", "1 as n")
    assert {r.defect for r in scan_defects(df).collect()} <= {"header", "page_number"}
    assert scan_defects(df.limit(0)).count() == 0 and reflow(df.limit(0)).count() == 0


def test_repair():
    lines = ["The kcrnel of a bal-", "anced long-", "term channel", "s h o w s 1O units."]
    assert repair_lines(lines, {"kcrnel": "kernel"}, {("bal", "-", "anced")}) == "The kernel of a balanced long-term channel shows 10 units."


def test_reflow(spark):
    data, _ = rows()
    got = reflow(spark.createDataFrame(data, SCHEMA)).orderBy("paragraph_no").collect()
    text = "\n".join(r.text for r in got)
    assert "STABLE KERNEL" not in text and "- 1" not in text and "a balanced channel" in text and "long-term" in text and "kcrnel" not in text


def test_native_skeleton(spark):
    words = ["".join(b for _, b in CONFUSIONS), "c@5$!†0|1l9nmuhb6dw", "", "plain words", "ﬁx‐ing"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", _skeletons("w").alias("s")).collect()
    assert all(r.s == skeleton(r.w) for r in got)


def test_titles_captions_and_repeated_body_lines_are_no_headers(spark):
    """Over half of the repeated keys are titles, captions and body lines; one item has no header on its first page, one has none at all."""
    out = []

    def add(item, page, y, cat, lines):
        out.append((len(out) + 1, item, page, len(out), cat, [0.0, float(y), 9.0, float(y), 9.0, y + 20.0, 0.0, y + 20.0], lines, "\n".join(lines)))
        return len(out)

    heads = set()
    for k in range(6):
        item = f"item{k}"
        title = f"On the motion of {'abcdef'[k] * 5} plates"
        for page in range(1, 5):
            if page > 1 or k != 0:
                heads.add(add(item, page, 40, 0 if page == 3 else 2, [title if page % 2 else f"Annals of Plates 1{page}"]))
            if page == 1:
                add(item, page, 60, 0, [title])
            add(item, page, 120, 1, ["Results and their discussion follow here"])
            add(item, page, 200, 4, [f"Figure {page}. A plate"])
            add(item, page, 250, 6, [f"Table {page}. Some plates"])
            add(item, page, 300, 1, ["Results and their discussion follow here", "as was said before."])
            add(item, page, 500, 2, [f"Page {page + 7}"])
        heads.add(add(item, 5, 120, 1, [title, "and the text of the page goes on."]))
        add(item, 6, 60, 0, ["Conclusions"])
    for page in (1, 2):
        add("bare", page, 60, 0, ["A section"])
        add("bare", page, 120, 1, ["Some text of a page without a header."])
    got = {r.det_id for r in scan_defects(spark.createDataFrame(out, SCHEMA)).collect() if r.defect == "header"}
    assert got == heads
