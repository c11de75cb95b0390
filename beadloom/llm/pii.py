"""Personal data, also where it is disguised, with spans of the source text.

Two passes over each whole text. The base pass applies fixed patterns to the source itself. The second pass sends the
text through three transducers, one after the other: characters (homoglyphs, full-width forms, marks without width),
numbers (digits spelled in words, alone or mixed with numerals, with spelled dots), and addresses (at/dot disguises). The
latter two are finite machines over tokens whose output is held back until an accepting state. Each keeps, for every
character that it emits, the source characters that it came from, and these maps compose. Identifiers found in the
normalised text are mapped back to source spans, and added unless a base span of their kind covers them.

Every step reads a text once from left to right, so time is linear in its length.

Defined cases: a null text is empty and has no spans; texts of any length are taken whole; ties (equal spans of two kinds)
are all returned; an added span may overlap base spans, which stay, and masking covers the union; repeated rows and
doc_ids give a row each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata

from pyspark.sql import DataFrame

from .common import append_batches, fresh, map_batches

# The base patterns of the four kinds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # the lookbehind only spares tries inside a run of digits
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
MASKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}

# Letters and signs that look like Latin ones: Cyrillic small and capital, Greek small and capital, others.
HOMOGLYPHS = dict(zip("авгеикмнопрстухѕіїјһӏԁԛԝ", "abreukmhonpctyxsiijhldqw")) | dict(zip("АВЕЅІЈКМНОРСТУХҮӀԌ", "ABESIJKMHOPCTYXYIG"))
HOMOGLYPHS |= dict(zip("αβεικνορτυχγ", "abeikvoptuxy")) | dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX")) | dict(zip("ıſ‐‑‒−", "is----"))

# Digits in words, English, German, French and Spanish.
DIGIT_WORDS = {
    w: str(d)
    for d, words in enumerate(
        [
            "zero oh null zéro cero", "one eins un une uno", "two zwei zwo deux dos", "three drei trois tres", "four vier quatre cuatro",
            "five fünf fuenf cinq cinco", "six sechs seis", "seven sieben sept siete", "eight acht huit ocho", "nine neun neuf nueve",
        ]
    )
    for w in words.split()
}
# Words before a digit that repeat it.
REPEATS = {"double": 2, "triple": 3}
# Those of them that are articles, too.
ARTICLES = frozenset(("one", "un", "une"))
# Words for the signs of addresses in these languages. "point" is prose behind an English "at".
AT_WORDS = ("at", "ät", "arobase", "arroba")
DOT_WORDS = ("dot", "punkt", "punto", "point")
# Endings of hosts that a bare "name at host.tld" counts with, and words before it that are no names.
ENDINGS = frozenset("com org net edu gov info io co uk eu de at ch fr be es mx ar us ca au nl it pl se".split())
NO_NAMES = frozenset(
    "a about again all also an and are around arrive arrived arrives as available back be been begin both buy buying call check click contact "
    "day details download ends ever everyone find found free get go going good had has have he help here hosted i in info is it join just last "
    "later learn listed live located look looked looking looks me meet meeting met more much news not now of offer offers on online open order "
    "or out page people photo posted published read register see seen she shop shopping shot sign site starts stay store team that the them then "
    "there they this to today together up us visit visited visiting was watch we website were while work working works you your".split()
)

#: No kind but an address of four numbers has fewer digits.
MIN_DIGITS = 9
#: A number without a plus sign counts as a phone number if so many of its digits are words.
MIN_BARE_WORDS = 4
_NUMBER_WORD = r"(?<!\w)(?=[zoenutdfvcqsha])(?:%s)(?!\w)" % "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_NUMERAL = r"(?<![\w.])[0-9]++(?!\w|\.[0-9])"
_REPEATED = rf"(?<!\w)(?:double|triple)[\s-]++(?:{_NUMBER_WORD}|[0-9](?!\w))"
_NUMBER = re.compile(rf"{_REPEATED}|{_NUMBER_WORD}|{_NUMERAL}")
_OPEN, _CLOSE = r"[\[({<]\s*+", r"\s*+[\])}>]"
_AT, _DOT = "|".join(AT_WORDS), "|".join(DOT_WORDS)
_BETWEEN = re.compile(r"[\s,()/-]++")
_SPELLED_DOT = re.compile(rf"\s*+{_OPEN}(?:{_DOT}|\.){_CLOSE}\s*+|\s++(?:{_DOT})\s++|\s*+\.\s*+")
#: A number word beside another or a numeral, or a numeral beside one.
_MIXED = re.compile(rf"{_NUMBER_WORD}(?:[\s,()/-]++|\s*+{_OPEN}(?:{_DOT}|\.){_CLOSE}\s*+|\s++(?:{_DOT})\s++|\.)(?:[0-9]|{_NUMBER_WORD})|[0-9](?:[\s,()/-]++|\s*+{_OPEN}(?:{_DOT}|\.){_CLOSE}\s*+|\s++(?:{_DOT})\s++|\.)(?={_NUMBER_WORD})")
#: Numerals parted by spelled dots, as of an address: "10 dot 0 dot 0 dot 1".
_DOTTED = re.compile(rf"[0-9]\s++(?:{_DOT})\s++[0-9]++\s++(?:{_DOT})\s")
_LETTERS = re.compile(r"[^\W\d_]+")
#: Tokens of addresses; a run of white space is one token, so that it is read once.
_TOKEN = re.compile(
    rf"(?P<at>\s*+{_OPEN}(?:{_AT}|@){_CLOSE}\s*+|\s++(?:{_AT})\s++|\s*+@\s*+)"
    rf"|(?P<dot>\s*+{_OPEN}(?:{_DOT}|\.){_CLOSE}\s*+|\s++(?:{_DOT})\s++|\.(?=[\w%+-]))"
    rf"|(?P<atom>[\w%+-]++)|\s++|[^\w\s]",
    re.IGNORECASE,
)
#: An address whose signs are words between underscores or hyphens.
_JOINED = re.compile(r"(?<![A-Za-z0-9_-])[a-z0-9]++(?:[_-](?!at[_-])[a-z0-9]++)*+[_-]at[_-][a-z0-9]++(?:[_-](?!dot[_-])[a-z0-9]++)*+(?:[_-]dot[_-][a-z0-9]++)++(?![A-Za-z0-9])", re.IGNORECASE)
_JOINED_SIGN = re.compile(r"[_-](at|dot)[_-]", re.IGNORECASE)
_JOINED_HINT = re.compile(r"[_-]at[_-]", re.IGNORECASE).search
_HINT = re.compile(rf"{_OPEN}(?:{_AT}|{_DOT}|@|\.){_CLOSE}|\s(?:{_DOT})\s|\s(?:arobase|arroba|ät)\s|\sat\s++[\w-]++\.\w", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) << (i & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def valid(kind: str, text: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text.split("."))
    digits = "".join(c for c in text if "0" <= c <= "9")
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns: by kind as in KINDS, then by start. Failing matches are dropped."""
    found = []
    if "@" in text:
        # A match holds its "@", and what precedes it is the longest run of name characters that no match has taken.
        at, taken = text.find("@"), 0
        while at >= 0:
            start = at
            while start > taken and (text[start - 1] in _NAME):
                start -= 1
            m = EMAIL.match(text, start) if start < at else None
            if m:
                found.append(("email", m.start(), m.end()))
                taken = m.end()
                at = text.find("@", taken)
            else:
                at = text.find("@", at + 1)
    if not _ANY_DIGIT(text):
        return found
    for kind, pattern in (("ip", IP), ("card", CARD)):
        if kind == "ip" and "." not in text:
            continue
        found += [(kind, *m.span()) for m in pattern.finditer(text) if valid(kind, m.group())]
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if valid("phone", m.group())]
    return found


_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_ANY_DIGIT = re.compile("[0-9]").search


class Mapped:
    """A text with the source span of each of its characters; edits compose."""

    def __init__(self, text: str):
        self.text = self.source_text = text
        self.edits: list[tuple[int, int, int, int]] = []  # (start here, end here, source start, source end), in order

    def rewrite(self, changes: list[tuple[int, int, str]]) -> None:
        """Replace [start, end) by text, for sorted changes that don't overlap."""
        if not changes:
            return
        pieces, edits, at, new_at = [], [], 0, 0
        for start, end, put in changes:
            pieces += [self.text[at:start], put]
            new_at += start - at
            edits.append((new_at, new_at + len(put), self.source(start, end)))
            new_at += len(put)
            at = end
        pieces.append(self.text[at:])
        # earlier edits outside of the changes move along
        moved, k, shift = [], 0, 0
        for s, e, a, b in self.edits:
            while k < len(changes) and changes[k][1] <= s:
                shift += len(changes[k][2]) - (changes[k][1] - changes[k][0])
                k += 1
            if not (k < len(changes) and changes[k][0] < max(e, s + 1)):
                moved.append((s + shift, e + shift, a, b))
        self.text = "".join(pieces)
        self.edits = sorted(moved + [(s, e, *src) for s, e, src in edits])
        self._starts = [x[0] for x in self.edits]

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source span of [start, end) of this text."""
        return self._point(start, False), self._point(end, True)

    def _point(self, at: int, is_end: bool) -> int:
        if not self.edits:
            return at
        k = bisect.bisect_left(self._starts, at) - 1 if is_end else bisect.bisect_right(self._starts, at) - 1
        if k < 0:
            return at
        s, e, a, b = self.edits[k]
        if at < e or (is_end and at == e):
            return b if is_end else a
        return b + (at - e)

    _starts: list[int] = []


def _beside_signs(text: str) -> list[tuple[int, int, str]]:
    """Letters that aren't ASCII in the name or host of an @: whatever they are, they belong to the address. They become the
    letter that they look like, or the one they are written with, or else x."""
    changes, taken, at = [], 0, text.find("@")
    while at >= 0:
        start, end = at, at + 1
        while start > taken and (text[start - 1].isalnum() or text[start - 1] in "_.%+-‐‑‒−"):
            start -= 1
        while end < len(text) and (text[end].isalnum() or text[end] in ".-‐‑‒−"):
            end += 1
        for i in range(start, end):
            c = text[i]
            if not c.isascii():
                put = HOMOGLYPHS.get(c) or unicodedata.normalize("NFKD", c)[:1]
                changes.append((i, i + 1, put if put.isascii() and (put.isalnum() or put == "-") else "x"))
        taken = end
        at = text.find("@", end)
    return changes


def _homoglyph_changes(text: str) -> list[tuple[int, int, str]]:
    changes = _beside_signs(text) if "@" in text else []
    done = {s for s, _, _ in changes}
    for m in re.finditer(r"[^\x00-\x7fÀ-İĲ-ɏ]", text):
        c = m.group()
        if m.start() in done:
            continue
        if c in "​‌‍⁠﻿­":
            changes.append((m.start(), m.end(), ""))
            continue
        put = HOMOGLYPHS.get(c)
        if put is None:
            put = unicodedata.normalize("NFKC", c)
        if put != c and put.isascii():
            changes.append((m.start(), m.end(), put))
    return sorted(changes)


def normalise(text: str) -> Mapped:
    """The text through the three transducers."""
    m = Mapped(text)
    if not text.isascii():
        m.rewrite(_homoglyph_changes(m.text))
    low = _lower(m.text)
    if _MIXED.search(low) or _DOTTED.search(low):
        m.rewrite(_number_changes(low))
    if _JOINED_HINT(m.text):
        m.rewrite([(s.start() + x.start(), s.start() + x.end(), "@" if x.group(1).lower() == "at" else ".") for s in _JOINED.finditer(m.text) for x in _JOINED_SIGN.finditer(s.group())])
    if _HINT.search(m.text):
        m.rewrite(_address_changes(m.text))
    return m


def _lower(text: str) -> str:
    """Lower case of the same length (a few capitals would become two characters), the long s as s."""
    low = text.lower().replace("ſ", "s")
    return low if len(low) == len(text) else "".join(x if len(x) == 1 else c for c, x in ((c, c.lower()) for c in text))


def _number_changes(text: str) -> list[tuple[int, int, str]]:
    """The number transducer. Its states are idle and in a number; a token goes on with the number if only separators, or
    one spelled dot, stand between. At a number's end its output is accepted or dropped."""
    changes: list[tuple[int, int, str]] = []
    groups: list[list[tuple[int, int, str]]] = []  # digits between dots
    at = 0
    for m in _NUMBER.finditer(text):
        word = m.group()
        if word[:6] in REPEATS:
            last = re.split(r"[\s-]+", word)[-1]
            digits = (DIGIT_WORDS.get(last) or last) * REPEATS[word[:6]]
        else:
            digits = DIGIT_WORDS.get(word) or word
        token = (m.start(), m.end(), digits)
        if groups and _BETWEEN.fullmatch(text, at, m.start()):
            groups[-1].append(token)
        elif groups and _SPELLED_DOT.fullmatch(text, at, m.start()):
            groups.append([token])
        else:
            changes += _number(text, groups)
            groups = [[token]]
        at = m.end()
    return changes + _number(text, groups)


def _number(text: str, groups: list[list[tuple[int, int, str]]]) -> list[tuple[int, int, str]]:
    """What a number is rewritten to: four groups up to 255 with dots, or else each group that is long enough.

    An article at an end, with a numeral beside it, belongs to the prose: "+1 555-1373 Un homme".
    """
    for k, inner in ((-1, -2), (0, 1)):
        if groups and len(groups[k]) > 1 and text[slice(*groups[k][k][:2])] in ARTICLES and text[groups[k][inner][0]] <= "9":
            groups[k].pop(k)
    spelled = [any(text[s] > "9" for s, _, _ in g) for g in groups]
    values = ["".join(d for _, _, d in g) for g in groups]
    dotted = len(groups) == 4 and all(len(v) <= 3 and int(v) <= 255 for v in values)
    # numerals alone are an address only if all their dots are words
    words = dotted and all(any(c.isalpha() for c in text[a[-1][1] : b[0][0]]) for a, b in zip(groups, groups[1:]))
    if not any(spelled) and not words:
        return []
    out = []
    for k, g in enumerate(groups):
        if dotted and k:
            out.append((groups[k - 1][-1][1], g[0][0], "."))
        if dotted or (spelled[k] and len(values[k]) >= MIN_DIGITS):
            # the separator goes with the digit before it
            out += [(s, g[i + 1][0] if i + 1 < len(g) else e, d) for i, (s, e, d) in enumerate(g)]
    return out


class _Address:
    """What the address transducer holds back: separators of one candidate, as (token, start, end, sign)."""

    def __init__(self, start: int, names: list):
        self.start, self.names, self.hosts, self.at = start, names, [], None
        self.host_start = self.end = start
        self.ending = self.name = ""

    def changes(self) -> list[tuple[int, int, str]]:
        found = [*((d, ".") for d in self.names), (self.at, "@"), *((d, ".") for d in self.hosts)]
        return [(*d.span(), put) for d, put in found if d.group() != put]

    def accepted(self) -> bool:
        if not self.hosts:
            return False
        sign = self.at.group().strip().lower()
        hidden = [d.group().strip().lower() for d in self.hosts if d.group() != "."]
        names = any(d.group() != "." for d in self.names)
        if sign == "@":
            return names or bool(hidden)
        if sign != "at":
            return True
        if any(d != "point" for d in hidden) or names:
            return True
        # "jane at example.org", but not "look at example.org"
        return not hidden and self.ending in ENDINGS and self.name not in NO_NAMES

    def sure(self) -> bool:
        """Whether it may take the host of an address before it as its name."""
        return self.at.group().strip().lower() != "at" or any(d.group() != "." for d in self.hosts)


def _address_changes(text: str) -> list[tuple[int, int, str]]:
    """The address transducer: states 0, N (name), M (dot in a name), A (at), H (host), D (dot in a host).

    Output is held back until a token has no arc. Of two addresses that share a part, "me at john dot doe [at] host.tld",
    the latter is taken if it is sure, else the former. Bracketed signs anywhere else are rewritten, too.
    """
    changes: list[tuple[int, int, str]] = []
    rest: list[tuple[int, int, str]] = []
    state, now, before, dot = "0", None, None, None

    def finish() -> None:
        nonlocal now, before
        for c in (now if now is not None and now.at is not None and now.accepted() and (before is None or now.sure()) else before,):
            if c is not None:
                changes.extend(c.changes())
        now = before = None

    for m in _TOKEN.finditer(text):
        kind = m.lastgroup
        if kind in ("at", "dot") and m.group().strip()[0] in "[({<":
            rest.append((*m.span(), "@" if kind == "at" else "."))
        arc = state, kind
        if arc == ("N", "dot"):
            dot, state = m, "M"
        elif arc == ("M", "atom"):
            now.names.append(dot)
            now.name, state = m.group().lower(), "N"
        elif arc == ("N", "at"):
            now.at, state = m, "A"
        elif arc == ("A", "atom"):
            now.host_start, now.ending, now.end, state = m.start(), m.group().lower(), m.end(), "H"
        elif arc == ("H", "dot"):
            dot, state = m, "D"
        elif arc == ("D", "atom"):
            now.hosts.append(dot)
            now.ending, now.end, state = m.group().lower(), m.end(), "H"
        elif arc == ("H", "at"):
            if now.accepted() and (before is None or now.sure()):
                before = now
            ending, now = now.ending, _Address(now.host_start, now.hosts)
            now.at, now.name, state = m, ending, "A"
        else:
            finish()
            state = "0"
            if kind == "atom":
                now, state = _Address(m.start(), []), "N"
                now.name = m.group().lower()
    finish()
    changes.sort()
    out, k = [], 0
    for x in rest:
        while k < len(changes) and changes[k][1] <= x[0]:
            k += 1
        if k == len(changes) or changes[k][0] >= x[1]:
            out.append(x)
    return sorted(changes + out)


_LATIN_1 = re.compile("[\xa0\xaa\xad\xb2\xb3\xb9\xba]").search


def suspect(text: str) -> bool:
    """Whether a transducer could change anything; a cheap test that never misses."""
    if not text.isascii():
        try:
            text.encode("latin-1")  # the soft hyphen, and what NFKC makes ASCII
            if _LATIN_1(text) or ("@" in text and _beside_signs(text)):
                return True
        except UnicodeEncodeError:
            return True
    if _HINT.search(text) is not None or _JOINED_HINT(text) is not None:
        return True
    low = _lower(text)
    return _MIXED.search(low) is not None or _DOTTED.search(low) is not None


def added_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans only the normalised text shows: (kind, start, end) in source characters, but those that a base span covers."""
    if not suspect(text):
        return []
    m = normalise(text)
    if not m.edits:
        return []
    taken = {k: [(s, e) for kind, s, e in base if kind == k] for k in KINDS}
    found = []
    for kind, s, e in base_spans(m.text):
        start, end = m.source(s, e)
        if end > start and not _covered(taken[kind], start, end):
            found.append((kind, start, end))
    phones = sorted(taken["phone"] + [(s, e) for kind, s, e in found if kind in ("phone", "card")])
    return found + [("phone", *p) for p in _bare_phones(m, phones)]


def _covered(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of the sorted spans, which don't overlap, holds all of [start, end)."""
    k = bisect.bisect_right(spans, start, key=lambda x: x[0]) - 1
    return k >= 0 and spans[k][1] >= end


def _bare_phones(m: Mapped, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Numbers spelled out in words have no plus sign; a run of 10 to 12 digits, enough of them spelled, counts as a phone number."""
    spans = []
    for run in re.finditer(r"(?<![0-9])[0-9]{10,12}(?![0-9])", m.text):
        start, end = m.source(*run.span())
        if end - start > 2 * (run.end() - run.start()) and len(_LETTERS.findall(m.source_text, start, end)) >= MIN_BARE_WORDS and not any(a < end and b > start for a, b in taken):
            spans.append((start, end))
    return spans


def find(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), both by kind, then start."""
    text = text or ""
    base = base_spans(text)
    more = added_spans(text, base)
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + more, key=lambda x: (order[x[0]], x[1], x[2])) if more else base


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def mask(text: str | None) -> str | None:
    """The text with every span replaced by its kind's mark; overlapping spans become one, of the earliest kind."""
    if not text:
        return text
    spans = sorted(find(text)[1], key=lambda x: (x[1], -x[2]))
    out, at = [], 0
    for kind, s, e in spans:
        if s >= at:
            out += [text[at:s], MASKS[kind]]
        at = max(at, e)
    return "".join([*out, text[at:]]) if spans else text


def detect(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, base counts per kind, base_sha256, spans."""

    def make():
        def run(batch: dict) -> dict:
            out: dict[str, list] = {"doc_id": batch["doc_id"], "n_email": [], "n_ip": [], "n_card": [], "n_phone": [], "base_sha256": [], "spans": []}
            for text in batch["text"]:
                base, spans = find(text)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(x[0] == k for x in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(spans))
            return out

        return run

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked in `text` (and n_chars kept true, where there is such a column)."""
    from pyspark.sql import functions as F

    def make():
        return lambda batch: {new: [mask(t) for t in batch["text"]]}

    new = fresh(docs, "__text")
    rows = append_batches(docs, make, f"{new} string", ["text"])
    columns = [F.col(new).alias("text") if c == "text" else F.coalesce(F.length(new), F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return rows.select(*columns)
