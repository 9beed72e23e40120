"""Reading of typed names: persons into surname, given and middle parts; organisations into kind, field and place."""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

# Letters that Unicode does not decompose.
_PLAIN = str.maketrans({"ø": "o", "ß": "ss", "ı": "i", "ł": "l", "đ": "d", "æ": "a", "œ": "o", "ð": "d", "þ": "th"})
# Titles before or after a name.
TITLES = frozenset("dr prof phd md mr mrs ms msc bsc dipl ing hon habil univ".split())
# Common short forms of given names.
NICKNAMES = {
    "dick": "richard", "rick": "richard", "bob": "robert", "rob": "robert", "bill": "william", "will": "william", "kate": "katherine", "kathy": "katherine",
    "matt": "matthias", "alex": "alexander", "sasha": "alexander", "ben": "benjamin", "sam": "samuel", "ed": "edward", "ted": "edward", "ned": "edward",
    "fred": "frederick", "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "willa": "wilhelmina", "mina": "wilhelmina", "gaby": "gabriella",
    "josie": "josephine", "jo": "josephine", "tony": "anthony", "chris": "christopher", "kit": "christopher", "nick": "nicholas", "sue": "susanna", "susie": "susanna",
    "paco": "francisco", "mila": "ludmila", "fritz": "frederick", "sanna": "susanna", "pippa": "philippa",
    "peggy": "margaret", "meg": "margaret", "maggie": "margaret", "lena": "magdalena", "magda": "magdalena", "theo": "theodora", "dora": "theodora",
    "bella": "isabella", "izzy": "isabella", "hans": "johannes", "jan": "johannes", "vova": "vladimir", "volodya": "vladimir", "dima": "dmitri", "mitya": "dmitri",
    "beppe": "giuseppe", "peppe": "giuseppe", "bruno": "bruno", "steve": "stefan",
}

_MARKS = re.compile(r"[\d*†‡§¶#]+(?:\s*,\s*[\d*†‡§¶#]+)*\s*$|(?:\s+[a-d](?:\s*,\s*[a-d])*)\s*$")
_GLUED = re.compile(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ])")
_INITIALS = re.compile(r"^(?:[^\W\d_]\.?-?){1,3}$")


def fold(text: str) -> str:
    """Lower case without accents; ae, oe, ue as their first letter."""
    text = unicodedata.normalize("NFKD", text.lower()).translate(_PLAIN)
    text = "".join(c for c in text if not unicodedata.combining(c))
    return text.replace("ae", "a").replace("oe", "o").replace("ue", "u")


class Person(NamedTuple):
    surname: str
    given: str | None  # in full
    initial: str | None
    middle: str | None  # in full
    middle_initial: str | None


def _tokens(text: str) -> list[str]:
    out = []
    for t in re.split(r"[\s]+", text):
        t = t.strip(".,;:()")
        if t and fold(t) not in TITLES:
            out.append(t)
    return out


def _split_initials(token: str, original: str) -> list[str] | None:
    """The letters of a group of initials such as "G.M." or "GM" (capitals only), else None."""
    letters = re.findall(r"[^\W\d_]", token)
    if len(letters) == 1 or "." in token and len(letters) <= 3 and all(len(p) <= 1 for p in token.split(".")):
        return [fold(x)[:1] for x in letters]
    if len(letters) <= 2 and token.isupper():
        return [fold(x)[:1] for x in letters]
    return None


def read_person(name: str | None, given_names: frozenset[str]) -> Person | None:
    """Parts of a full name; ``given_names`` are folded given names, for names with the surname first."""
    if not name or not name.strip():
        return None
    raw = _MARKS.sub("", name.strip())
    before, comma, after = raw.partition(",")
    if comma and not _tokens(after):
        raw, comma = before, ""
    if comma:
        last, rest = _tokens(_GLUED.sub(" ", before)), _tokens(after)
        surname = fold("".join(last))
    else:
        parts = _tokens(raw if raw.isupper() else _GLUED.sub(" ", raw))
        full = [k for k, t in enumerate(parts) if _split_initials(t, raw) is None]
        if not parts:
            return None
        if not full:
            return None
        if len(full) == 1:
            pick = full[0]
        elif len(full) >= 2 and _is_given(parts[full[-1]], given_names) and not _is_given(parts[full[0]], given_names):
            pick = full[0]
        else:
            pick = full[-1]
        surname = fold(parts[pick])
        rest = parts[:pick] + parts[pick + 1 :]
    names: list[tuple[str | None, str]] = []
    for t in rest:
        letters = _split_initials(t, raw)
        if letters is not None:
            names += [(None, x) for x in letters]
        else:
            f = fold(t)
            names.append((f, f[:1]))
    if not surname:
        return None
    first = names[0] if names else (None, None)
    second = names[1] if len(names) > 1 else (None, None)
    given = correct(first[0], given_names)
    given = NICKNAMES.get(given, given) if given else None
    middle = correct(second[0], given_names)
    return Person(surname, given, given[:1] if given else first[1], middle, middle[:1] if middle else second[1])


def edits(word: str):
    """All strings one deletion away, and the word."""
    yield word
    for i in range(len(word)):
        yield word[:i] + word[i + 1 :]


_near: dict[frozenset, dict[str, str]] = {}


def correct(word: str | None, known: frozenset[str]) -> str | None:
    """The known word within one edit or swap of ``word``, if there is just one; else ``word``."""
    if word is None or word in known or word in NICKNAMES or len(word) < 3:
        return word
    table = _near.get(known)
    if table is None:
        table = {}
        for k in known:
            if len(k) >= 3:
                for e in edits(k):
                    table[e] = "" if table.get(e, k) != k else k
        _near.clear()
        _near[known] = table
    found = {table[e] for e in edits(word) if table.get(e)}
    found |= {k for k in (word[:i] + word[i + 1] + word[i] + word[i + 2 :] for i in range(len(word) - 1)) if k in known}
    return found.pop() if len(found) == 1 else word


def _is_given(token: str, known: frozenset[str]) -> bool:
    f = fold(token)
    return f in known or f in NICKNAMES or correct(f, known) in known


# Words for kinds of organisations, folded, by the word they stand for.
KIND_WORDS = {
    "university": "university universitat universite universidad universitas universita universidade univ uni u",
    "technical": "technical technology technische tech technological tu",
    "polytechnic": "polytechnic polytech polytechnique politecnico poly polytechnikum",
    "medical": "medical medizinische med",
    "school": "school sch schule hochschule ecole faculty faculte fakultat fac",
    "institute": "institute inst institut instituto istituto",
    "national": "national nat natl nationales nacional",
    "laboratory": "laboratory lab labs laboratoire laboratorio labor",
    "department": "department dept dep departement abteilung departamento division div",
}
_KIND_OF = {w: k for k, ws in KIND_WORDS.items() for w in ws.split()}
_SHORT_FOR = re.compile(r"\bfor\.", re.I)
STOP = frozenset("the of for de la du des der die das and di do da e y et in at fur f".split())


def org_tokens(text: str) -> list[str]:
    return [t for t in re.findall(r"[^\W_]+", fold(_GLUED.sub(" ", text) if not text.isupper() else text)) if not t.isdigit()]


def distance(a: str, b: str, limit: int) -> int:
    """Levenshtein distance with swaps of neighbours as one step, cut off above ``limit``; only a band of the table is filled."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    start, end = 0, 0
    short = min(len(a), len(b))
    while start < short and a[start] == b[start]:
        start += 1
    while end < short - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a or not b:
        return len(a) + len(b)
    far = limit + 1
    width = len(b)
    before2: list[int] = []
    before = [j if j <= limit else far for j in range(width + 1)]
    for i, x in enumerate(a, 1):
        row = [far] * (width + 1)
        row[0] = i if i <= limit else far
        low = row[0]
        for j in range(max(1, i - limit), min(width, i + limit) + 1):
            y = b[j - 1]
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before2[j - 2] + 1)
            row[j] = d
            if d < low:
                low = d
        if low > limit:
            return far
        before2, before = before, row
    return min(before[-1], far)


class Register:
    """Clean organisation names, read once; resolves typed ones. Its size is that of the register, which is fixed."""

    def __init__(self, units: list[tuple[int, int | None, str, str, str | None]]):
        """Rows of unit_id, parent_id, level, name, settlement."""
        self.at: dict[str, list[tuple[int, frozenset[str], frozenset[str], str]]] = {}
        self.departments: dict[int, list[tuple[int, frozenset[str], str]]] = {}
        words: set[str] = set()
        for uid, parent, level, name, settlement in units:
            tokens = [t for t in org_tokens(name) if t not in STOP]
            if level == "institution":
                place = fold(settlement or tokens[-1])
                kinds = frozenset(_KIND_OF[t] for t in tokens if t in _KIND_OF and t != place)
                field = frozenset(t for t in tokens if t not in _KIND_OF and t != place)
                self.at.setdefault(place, []).append((uid, kinds, field, name))
            else:
                field = frozenset(t for t in tokens if t not in _KIND_OF)
                self.departments.setdefault(parent, []).append((uid, field, name))
            words |= field
        self.fields = words
        self.near_place = self._deletions(self.at)
        self.near_word = self._deletions([w for w in (*words, *_KIND_OF) if len(w) >= 4])
        self.cache: dict[str, str | None] = {}

    @staticmethod
    def _deletions(words) -> dict[str, set[str]]:
        out: dict[str, set[str]] = {}
        for w in words:
            for e in edits(w):
                for f in edits(e):
                    out.setdefault(f, set()).add(w)
        return out

    def place_of(self, token: str) -> list[str]:
        """Places within two edits of a token (one for short ones), nearest first; the exact one alone."""
        if token in self.at:
            return [token]
        if len(token) < 5:
            return []
        limit = 2 if len(token) >= 7 else 1
        near = {p for e in edits(token) for f in edits(e) for p in self.near_place.get(f, ())}
        ranked = sorted((d, p) for p in near if (d := distance(token, p, limit)) <= limit)
        return [p for d, p in ranked if d == ranked[0][0]]

    def place_in(self, text: str) -> str | None:
        """The only known place that a name of an organisation outside the register holds."""
        found = {places[0] for t in org_tokens(text) if len(places := self.place_of(t)) == 1}
        return found.pop() if len(found) == 1 else None

    def word_of(self, token: str) -> str | None:
        """The kind or field word a token stands for: itself, a misspelling, or an abbreviation."""
        if token in _KIND_OF or token in self.fields:
            return token
        if token not in self.cache:
            found = None
            longer = {w for w in (*self.fields, *_KIND_OF) if len(w) > len(token) and w.startswith(token)} if len(token) >= 4 else set()
            if len(longer) == 1:
                found = longer.pop()
            elif len(token) >= 3 and distance(token, "univ", 1) == 1:
                found = "univ"
            elif len(token) >= 4:
                limit = 1 if len(token) < 6 else 2
                near = {w for e in edits(token) for f in edits(e) for w in self.near_word.get(f, ())}
                ranked = sorted((d, w) for w in near if (d := distance(token, w, limit)) <= limit)
                found = ranked[0][1] if ranked else None
            if found is None and len(token) >= 3:
                longer = {w for w in (*self.fields, *_KIND_OF) if len(w) > len(token) and w.startswith(token)}
                kinds = {_KIND_OF.get(w, w) for w in longer}
                found = longer.pop() if len(kinds) == 1 else "?" + token if longer else None
            self.cache[token] = found
        return self.cache[token]

    def read(self, text: str) -> tuple[frozenset[str], frozenset[str]]:
        """Kinds and field words (abbreviations of several words as "?abc") of a stretch of text."""
        kinds, field = set(), set()
        if _SHORT_FOR.search(text):
            field.add("?for")
        for t in org_tokens(text):
            if t in STOP:
                continue
            if t == "tu":
                kinds |= {"technical", "university"}
                continue
            w = self.word_of(t)
            if w is None:
                continue
            (kinds if w in _KIND_OF else field).add(_KIND_OF.get(w, w))
            if w in self.fields and w in _KIND_OF:
                field.add(w)
            if w.startswith("?") or w in ("med", "medical", "medizinische"):
                field.add("?" + t)
        return frozenset(kinds), frozenset(field)

    @staticmethod
    def _covers(found: frozenset[str], wanted: frozenset[str]) -> bool:
        return all(w in found or any(f[0] == "?" and w.startswith(f[1:]) for f in found) for w in wanted)

    def institution(self, text: str | None, settlement: str | None = None) -> tuple[int | None, str]:
        """(unit_id, the rest of the text that may name a department)."""
        if not text or not text.strip():
            return None, ""
        flat = re.sub(r"\([^)]*\)", " ", text)
        parts = [p for p in re.split(r"[,;]", flat) if p.strip()]
        home = fold(settlement or "")
        best: tuple = ()
        for k, part in enumerate(parts):
            tokens = org_tokens(part)
            for t in tokens:
                places = self.place_of(t)
                if len(places) > 1 and home in places:
                    places = [home]
                for place in places:
                    rest = " ".join(x for x in tokens if x != t)
                    kinds, field = self.read(rest)
                    other = [p for j, p in enumerate(parts) if j != k]
                    own = True
                    if not kinds:
                        others = " ".join(other)
                        kinds, field = self.read(others)
                        own = False
                    for uid, want_kinds, want_field, name in self.at[place]:
                        if not want_kinds <= kinds or not self._covers(field, want_field):
                            continue
                        extra = len(kinds - want_kinds)
                        if own and extra and "university" in want_kinds and {"technical"} & (kinds - want_kinds):
                            continue
                        if "university" not in want_kinds and "university" in kinds and own:
                            continue
                        off = distance(t, place, 3)
                        score = (-off, own, len(want_kinds) + len(want_field), -extra)
                        if not best or score > best[0]:
                            best = (score, uid, ", ".join(other) if own else "")
        return (best[1], best[2]) if best else (None, "")

    def department(self, institution: int | None, text: str | None) -> int | None:
        """The institution's department that a text names, by its field of study."""
        if institution is None or not text or not text.strip():
            return None
        _, field = self.read(text)
        if not field:
            return None
        hits = [(len(w), uid) for uid, w, _ in self.departments.get(institution, ()) if self._covers(field, w)]
        return max(hits)[1] if hits and (len(hits) == 1 or sorted(hits)[-1][0] > sorted(hits)[-2][0]) else None
