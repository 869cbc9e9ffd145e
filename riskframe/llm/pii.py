"""Personal data in texts, through disguises, at places of the source text.

Base spans are four patterns with their checks (:func:`base_spans`). Then transducers rewrite
the text (:class:`Traced`): each rewrites parts of it and keeps for every character of the
new text the source characters it came from.

1. Look-alikes: full-width and mathematical forms, digits of other scripts, and Cyrillic and
   Greek letters that look Latin in a word that also holds ASCII letters or digits, become
   ASCII; unusual spaces and dashes become plain; invisible characters go.
2. Bracketed disguises: ``[at]``, ``(dot)``, ``{.}`` and the like between characters of an address.
3. Spelled digits: runs of at least ``RUN`` digit words of four languages, with ``double``,
   ``plus``, and ``dot`` between digits.
4. Bare words: `` at `` and `` dot `` in a chain of labels that makes an address (with a bare ``at`` the domain
   needs a spelled or bracketed dot, or the name a digit or one of ``._%+-``), and
   `` dot `` between the four parts of an address of digits.

The four patterns run again over the result, and what they find goes back to source places:
from the first source character of a span to its last. Such a span is added unless it lies
within a base span of its kind; base spans always stay.

All patterns walk a text in linear time: addresses are grown from each ``@``, quantifiers
are possessive, and starts inside a run are ruled out.

Defined cases: a null text is empty; rows without an id are ignored; rows that repeat an id
are read each; whole texts of any length are read; an empty table gives no rows; other
columns are not read. Places are code points of the source text, ends exclusive. An address
of digits with a part above 255, a card that fails Luhn and a phone of too few or many digits
are dropped whole; what they cover is not tried again.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import slices, texts_of

KINDS = ("email", "ip", "card", "phone")
#: Digit words in a row that count as spelled digits.
RUN = 3

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LABEL = r"[A-Za-z0-9-]"
_DOMAIN = re.compile(rf"@{LABEL}++(?:\.{LABEL}++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]*+")
_DIGIT = re.compile(r"[0-9]")

# Letters that look like Latin ones.
LOOKS = dict(zip(
    "аеорсухіјѕһԁԛԝвкмнтАВЕКМНОРСТУХІЈЅԌԚԜΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρυιεκℓıɡ",
    "aeopcyxijshdqwbkmhtABEKMHOPCTYXIJSGQWABEZHIKMNOPTYXaovpuiekLig".replace("L", "l")))
# Digit words of the four languages, and words for the signs of an address.
DIGITS = {w: d for d, words in enumerate((
    "zero oh cero zéro null", "one uno un eins", "two dos deux zwei", "three tres trois drei", "four cuatro quatre vier",
    "five cinco cinq fünf", "six seis sechs", "seven siete sept sieben", "eight ocho huit acht", "nine nueve neuf neun")) for w in words.split()}
TIMES = {"double": 2, "triple": 3}
AT = "at arroba arobase"
DOT = "dot punto point punkt"

_alt = "|".join
_AT, _DOT = _alt(AT.split()), _alt(DOT.split())
_ODD = re.compile("[ ­ıɡͰ-ϿЀ-ԯ؀-࿿ -⃿℀-⅏−①-⓿　-〿︀-﻿＀-￯\U0001d400-\U0001d7ff]")
_BRACKET = re.compile(rf"(?<=[\w%+-])(?:\s{{1,3}})?[\[({{<]\s{{0,2}}(?:(?P<at>@|{_AT})|(?P<dot>\.|{_DOT}))\s{{0,2}}[\])}}>](?:\s{{1,3}})?(?=\w)", re.I)
_WORDS = _alt(sorted(DIGITS, key=len, reverse=True))
_RUN = re.compile(rf"(?:\bplus[ -]{{1,3}})?\b(?:(?:double|triple)[ -]{{1,3}})?(?:{_WORDS})\b"
                  rf"(?:[ ,-]{{1,3}}(?:(?:{_DOT})[ ,-]{{1,3}})?(?:(?:double|triple)[ -]{{1,3}})?(?:{_WORDS}|[0-9]{{1,4}}+)\b)++", re.I)
_WORD = re.compile(r"[^\W_]+")
_AT_WORD = re.compile(rf"@|(?<=[A-Za-z0-9]) {{1,3}}(?:{_AT}) {{1,3}}(?=[A-Za-z0-9])", re.I)
_CHAIN = re.compile(rf"{LABEL}++(?:(?:\.| {{1,3}}(?:{_DOT}) {{1,3}}){LABEL}++)*+", re.I)
_DOT_WORD = re.compile(rf" {{1,3}}(?:{_DOT}) {{1,3}}", re.I)
_DOT_BEFORE = re.compile(rf" {{1,3}}(?:{_DOT}) {{1,3}}\Z", re.I)
_SPOKEN_IP = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:(?:\.| {{1,3}}(?:{_DOT}) {{1,3}})[0-9]{{1,3}}){{3}}(?![0-9])", re.I)

#: What a text must hold for a pattern to find anything in it (a scan of whole batches).
NEEDED = {
    "email": r"@", "ip": r"[0-9]\.[0-9]+\.", "card": r"[0-9](?:[ -]?[0-9]){11}", "phone": r"\+[0-9]",
    "odd": r"[\x{a0}\x{ad}\x{131}\x{261}\x{370}-\x{52f}\x{600}-\x{fff}\x{2000}-\x{214f}\x{2212}\x{2460}-\x{24ff}\x{3000}-\x{303f}\x{fe00}-\x{feff}\x{ff00}-\x{ffef}\x{1d400}-\x{1d7ff}]",
    "bracket": rf"(?i)[\[({{<]\s*(?:@|\.|{_AT}|{_DOT})\s*[\])}}>]", "spelled": rf"(?i)\b(?:{_WORDS})[ ,-]{{1,3}}(?:{_WORDS}|{_DOT}|double|triple|[0-9])",
    "word": rf"(?i)[a-z0-9] {{1,3}}(?:{_DOT}|{_AT}) {{1,3}}[a-z0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, free = [], 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            out.append((start, m.end()))
            free = m.end()
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    fits = lambda part: len(part := part.lstrip("0")) < 4 and int(part or "0") <= 255
    return [m.span() for m in _IP.finditer(text) if all(map(fits, m.group().split(".")))]


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _PHONE.finditer(text):
        found = m.group()
        end = len(found)
        while not "0" <= found[end - 1] <= "9":
            end -= 1
        if end > 3 and 9 <= len(_DIGIT.findall(found, 0, end)) <= 15:
            out.append((m.start(), m.start() + end))
    return out


FINDERS = {"email": emails, "ip": addresses, "card": cards, "phone": phones}
Span = tuple[int, int, int]     # start, place of the kind in KINDS, end


def base_spans(text: str, kinds=KINDS) -> list[Span]:
    """Spans of the four patterns in ``text``, sorted by start and kind."""
    return sorted((a, KINDS.index(k), b) for k in kinds for a, b in FINDERS[k](text))


class Traced:
    """A rewritten text, and for each of its characters the source characters it came from."""

    def __init__(self, text: str):
        self.text = text
        self.start = self.end = None        # none: unchanged so far

    def rewrite(self, edits: list[tuple[int, int, str, list[tuple[int, int]]]]) -> None:
        """Replace parts (start, end, new text, place of each new character in the present text)."""
        if not edits:
            return
        if self.start is None:
            self.start = np.arange(len(self.text))
            self.end = self.start + 1
        text, first, last, at = [], [], [], 0
        for a, b, new, places in edits:
            text += [self.text[at:a], new]
            first += [self.start[at:a], self.start[[p for p, _ in places]]] if places else [self.start[at:a]]
            last += [self.end[at:a], self.end[[q - 1 for _, q in places]]] if places else [self.end[at:a]]
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.start = np.concatenate([*first, self.start[at:]])
        self.end = np.concatenate([*last, self.end[at:]])

    def source(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.start is None else (int(self.start[a]), int(self.end[b - 1]))


def _look(c: str) -> str:
    """The plain form of a character outside ASCII; itself if it has none."""
    if unicodedata.category(c) in ("Cf", "Mn") and c != "؀":
        return "" if c in "­​‌‍‎‏⁠⁡⁢⁣⁤﻿" or "︀" <= c <= "️" else c
    if c in LOOKS:
        return LOOKS[c]
    d = unicodedata.decimal(c, None)
    if d is not None:
        return str(d)
    kind = unicodedata.category(c)
    if kind == "Zs":
        return " "
    if kind == "Pd" or c == "−":
        return "-"
    if c in "․。﹒｡":
        return "."
    plain = unicodedata.normalize("NFKC", c)
    return plain if len(plain) == 1 and plain.isascii() else c


def fold_looks(t: Traced) -> None:
    edits = []
    ascii_near: dict[int, bool] = {}
    for m in _ODD.finditer(t.text):
        c, at = m.group(), m.start()
        new = _look(c)
        if new == c:
            continue
        if c in LOOKS:      # letters of another script stay letters unless their word mixes scripts
            a = at
            while a > 0 and not t.text[a - 1].isspace() and a - 1 not in ascii_near:
                a -= 1
            if a > 0 and a - 1 in ascii_near and not t.text[a - 1].isspace():
                mixed = ascii_near[a - 1]
            else:
                b = at
                while b < len(t.text) and not t.text[b].isspace():
                    b += 1
                mixed = any(x.isascii() and x.isalnum() for x in t.text[a:b])
            ascii_near[at] = mixed
            if not mixed:
                continue
        edits.append((at, at + 1, new, [(at, at + 1)] * len(new)))
    t.rewrite(edits)


def undo_brackets(t: Traced) -> None:
    t.rewrite([(m.start(), m.end(), "@" if m["at"] else ".", [m.span()]) for m in _BRACKET.finditer(t.text)])


def undo_spelling(t: Traced) -> None:
    edits = []
    for m in _RUN.finditer(t.text):
        new, places, times, words = [], [], 1, 0
        for w in _WORD.finditer(t.text, *m.span()):
            name = w.group().lower()
            if name in TIMES:
                times, since = TIMES[name], w.start()
                continue
            if name in DIGITS:
                add, words = str(DIGITS[name]) * times, words + times
            elif name == "plus":
                add = "+"
            else:
                add = name if name.isdigit() else "."
            here = (since if times > 1 else w.start(), w.end())
            spread = [here] * len(add) if not name.isdigit() else [(w.start() + k, w.start() + k + 1) for k in range(len(add))]
            new.append(add)
            places += spread
            times = 1
        if words >= RUN:
            edits.append((*m.span(), "".join(new), places))
    t.rewrite(edits)


def undo_words(t: Traced) -> None:
    text, edits, free = t.text, [], 0
    sign = lambda m, c: (m.start(), m.end(), c, [m.span()])
    for m in _AT_WORD.finditer(text):
        domain = _CHAIN.match(text, m.end())
        if not domain or m.start() < free:
            continue
        dots = list(_DOT_WORD.finditer(domain.group()))
        end, start, names = domain.end(), m.start(), []
        while True:     # the local part: labels, and dots as words between them
            a = start
            while a > free and text[a - 1] in LOCAL:
                a -= 1
            if a == start:
                if names:
                    start = names.pop().end()
                break
            start = a
            before = _DOT_BEFORE.search(text, max(free, a - 16), a)
            if not before or before.start() <= free or text[before.start() - 1] not in LOCAL:
                break
            names.append(before)
            start = before.start()
        name = text[start:m.start()]
        bare = m.group() != "@"
        plain = bare and not dots and not (names or re.search(r"[0-9._%+-]", name))
        if not name or plain or "." not in domain.group() and not dots or not (bare or dots or names):
            continue
        edits += [sign(d, ".") for d in reversed(names)]
        if bare:
            edits.append(sign(m, "@"))
        edits += [(m.end() + d.start(), m.end() + d.end(), ".", [(m.end() + d.start(), m.end() + d.end())]) for d in dots]
        free = end
    done = [e[0] for e in edits]        # in order of place
    for m in _SPOKEN_IP.finditer(text):
        k = bisect_right(done, m.end() - 1) - 1
        if k < 0 or edits[k][1] <= m.start():
            edits += [(m.start() + d.start(), m.start() + d.end(), ".", [(m.start() + d.start(), m.start() + d.end())]) for d in _DOT_WORD.finditer(m.group())]
    t.rewrite(sorted(edits))


TRANSDUCERS = {"odd": fold_looks, "bracket": undo_brackets, "spelled": undo_spelling, "word": undo_words}


def all_spans(text: str, base: list[Span], held: set[str] | None = None) -> list[Span]:
    """Base spans and those found through disguises. ``held`` names what of ``NEEDED`` the text
    holds; a transducer whose pattern is absent in the source still runs after one that rewrote."""
    t = Traced(text)
    for name, undo in TRANSDUCERS.items():
        if held is None or name in held or t.start is not None:
            undo(t)
    if t.start is None:
        return base
    starts, ends = ([[s[at] for s in base if s[1] == kind] for kind in range(len(KINDS))] for at in (0, 2))
    found = set(base)
    for a, kind, b in base_spans(t.text):
        a, b = t.source(a, b)
        lo = bisect_right(starts[kind], a) - 1
        if lo < 0 or ends[kind][lo] < b:
            found.add((a, kind, b))
    return sorted(found)


def written(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])


def _holds(texts: pa.Array) -> dict[str, np.ndarray]:
    return {k: pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False) for k, p in NEEDED.items()}


SCHEMA = "doc_id long, base array<string>, spans array<string>, values array<string>"


def find(docs: DataFrame) -> DataFrame:
    """``(doc_id, base, spans, values)``: base spans, all spans and their source texts, a list each
    of ``kind:start:end`` (``values``: the text of each span of ``spans``)."""
    def run(batches):
        for batch in slices(batches):
            column = batch.column("text")
            holds = _holds(column)
            hit = np.logical_or.reduce(list(holds.values()))
            out = [[[], [], []] for _ in range(batch.num_rows)]
            for i in np.flatnonzero(hit).tolist():
                text = column[i].as_py()
                held = {k for k, v in holds.items() if v[i]}
                base = base_spans(text, [k for k in KINDS if k in held])
                spans = all_spans(text, base, held) if held - set(KINDS) else base
                names = lambda found: [written([s]) for s in found]
                out[i] = [names(base), names(spans), [text[a:b] for a, _, b in spans]]
            kind = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[c] for r in out], type=kind) for c in range(3))],
                                             names=["doc_id", "base", "spans", "values"])
    return texts_of(docs).mapInArrow(run, SCHEMA)


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts per kind and the digest of base spans, then all spans and counts of all."""
    of = lambda c, k: F.size(F.filter(c, lambda s: s.startswith(f"{k}:"))).cast("long")
    return found.select("doc_id", *[of("base", k).alias(f"n_{k}") for k in KINDS], F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
                        F.array_join("spans", ",").alias("spans"), *[of("spans", k).alias(f"n_all_{k}") for k in KINDS])
