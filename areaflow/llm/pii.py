"""Personal data, found also behind disguises, with spans in the source text.

Base identifiers are matched in the text as it is.  Then a transducer rewrites
disguises in one pass from left to right: look-alike characters become ASCII,
spelled digits become digits, spelled or bracketed "at", "dot" and "plus" become
their signs, invisible characters vanish.  It keeps for every written character
the source interval it came from.  Spelled digits are written in two ways: runs of
three or more names as digits with spaces between, and any names as one number,
where a dot between names stays a dot; the second serves ip, card and phone.  The
same detectors run over each rewritten text, and a span found there is mapped back
and added if it holds a rewritten character and touches no base span.  Of spans of
one kind that touch, the first way's counts unless the second's holds it and two
more digits.  A cheap trigger leaves texts without any
disguise untouched.

Defined results: a null text counts as empty and has no span; rows are
independent, so repeated rows give repeated results; an empty table gives no
rows; other columns are not read.  White space inside a disguise counts up to 32
characters on each side.  Work is linear in the text's length, but for sorting spans.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from areaflow.llm import spans, texts

KINDS = ("email", "ip", "card", "phone")

Span = tuple[int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# An address lies in one run of digits and dots, and starts where a run of digits does: no later start can do better.
_DOTTED = re.compile(r"[0-9][0-9.]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[Span]:
    """Around each at sign, so that a long run without one costs nothing."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[Span]:
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        for m in _IP.finditer(text, *run.span()):
            parts = (p.lstrip("0") for p in m.group().split("."))
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                yield m.span()


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NO_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
                yield m.span()


DETECTORS = {"email": emails, "ip": ips, "card": cards, "phone": phones}

# Digits by name in the four languages of the corpus, zero to nine.
DIGIT_NAMES = (
    ("zero", "oh", "null", "cero", "zéro"),
    ("one", "eins", "uno", "un"),
    ("two", "zwei", "zwo", "dos", "deux"),
    ("three", "drei", "tres", "trois"),
    ("four", "vier", "cuatro", "quatre"),
    ("five", "fünf", "cinco", "cinq"),
    ("six", "sechs", "seis"),
    ("seven", "sieben", "siete", "sept"),
    ("eight", "acht", "ocho", "huit"),
    ("nine", "neun", "nueve", "neuf"),
)

# Letters of other scripts that look like the ASCII letter beside them.
LOOK_ALIKES = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q",
    "ѕ": "s", "у": "y", "х": "x", "ԝ": "w", "ѵ": "v", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I",
    "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "α": "a", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H",
    "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g",
    "ո": "n", "ս": "u", "օ": "o", "։": ":", "。": ".", "․": ".", "٠": "0", "۰": "0",
}


def _one_char() -> dict[str, str]:
    """Characters outside ASCII that stand for one ASCII character, or for none."""
    table = {}
    for code in [*range(0x2B0, 0xFFF0), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F170)]:
        c = chr(code)
        plain = unicodedata.normalize("NFKC", c)
        if unicodedata.category(c) == "Nd":
            table[c] = str(unicodedata.digit(c))
        elif unicodedata.category(c) == "Cf":
            table[c] = ""
        elif unicodedata.category(c) == "Pd":
            table[c] = "-"
        elif unicodedata.category(c) == "Zs":
            table[c] = " "
        elif len(plain) == 1 and " " <= plain <= "~":
            table[c] = plain
    table |= LOOK_ALIKES
    return table | {"\xa0": " ", "\xad": "", "−": "-"}


# Mathematical and enclosed letters and digits.
_BEYOND = "[\U0001d400-\U0001d7ff\U0001f100-\U0001f16f]"


class Transducer:
    """The rewriting rules, compiled once in each task."""

    def __init__(self) -> None:
        self.chars = _one_char()
        self.digits = {name: str(d) for d, names in enumerate(DIGIT_NAMES) for name in names}
        word = "(?:" + "|".join(sorted(self.digits, key=len, reverse=True)) + r")\b"
        run = rf"\b{word}(?:[\s,./-]{{1,3}}{word})"
        # bounded and without a way back, so that a long run of white space costs no more than its length
        maybe, gap = r"\s{0,32}+", r"\s{1,32}+"
        opened, closed = rf"{maybe}[\[({{<]{maybe}", rf"{maybe}[\])}}>]{maybe}"
        dots = "dot|punkt|punto|point"
        rules = {
            # one class for the basic plane, which is looked up by table, and ranges beyond
            "char": "[" + re.escape("".join(sorted(c for c in self.chars if c <= "\uffff"))) + "]|" + _BEYOND,
            "at": rf"{opened}(?:at|@){closed}|{gap}at{gap}(?=[a-z0-9-]++(?:{gap}(?:{dots}){gap}|{opened}(?:{dots}|\.){closed})[a-z0-9-])",
            "dot": rf"{opened}(?:{dots}|\.){closed}|(?<=[a-z0-9]){gap}(?:{dots}){gap}(?=[a-z0-9])",
            "plus": rf"\bplus{gap}(?=[0-9]|{word})",
        }
        most = "|".join(f"(?P<{k}>{v})" for k, v in rules.items())
        self.rules = re.compile(rf"{most}|(?P<run>{run}{{2,}})", re.IGNORECASE)
        self.joining = re.compile(rf"{most}|(?P<run>{run}*)", re.IGNORECASE)
        self.inside = re.compile(rf"(?P<word>{word})|(?P<gap>[\s,./-]+)", re.IGNORECASE)
        # with the two letters that rules take for i and s, and lower() does not
        self.odd = re.compile(rules["char"] + "|[\u0130\u017f]")
        self.words = re.compile(r"\w+")  # words end where the rules' \b is
        self.bracketed = re.compile(rf"[\[({{<]{maybe}(?:at|@|{dots}|\.){maybe}[\])}}>]", re.IGNORECASE)
        # "un" and the like are words of their own, and tell only beside a digit or each other
        unsure = "un|oh|null"
        self.unsure = frozenset(unsure.split("|"))
        self.beside = re.compile(
            rf"\b(?:{unsure})\b[\W_]{{1,4}}(?:[0-9]|(?:{unsure})\b)|[0-9][\W_]{{1,4}}(?:{unsure})\b", re.IGNORECASE
        )
        self.telling = frozenset(self.digits) - self.unsure | frozenset([*dots.split("|"), "plus"])

    def disguised(self, text: str) -> bool:
        """Cheap, and true wherever a rule could make an identifier."""
        if not text.isascii() and self.odd.search(text) or self.bracketed.search(text):
            return True
        words = set(self.words.findall(text.lower()))
        return not self.telling.isdisjoint(words) or not self.unsure.isdisjoint(words) and bool(self.beside.search(text))

    def rewrite(self, text: str, joined: bool = False) -> tuple[str, list[int], list[int], list[bool]]:
        """The rewritten text; for each of its characters the source interval, and whether it was rewritten.

        ``joined``: any digit names, also one alone, as one number.
        """
        out: list[str] = []
        starts: list[int] = []
        ends: list[int] = []
        new: list[bool] = []

        def put(chars: str, a: int, b: int) -> None:
            for c in chars:
                out.append(c)
                starts.append(a)
                ends.append(b)
                new.append(True)

        def copy(a: int, b: int, after_gap: bool) -> None:
            out.append(text[a:b])
            starts.extend(range(a, b))
            ends.extend(range(a + 1, b + 1))
            new.extend([after_gap] * min(1, b - a) + [False] * (b - a - 1))

        at = 0
        vanished = False  # what follows an invisible character counts as rewritten
        for m in (self.joining if joined else self.rules).finditer(text):
            copy(at, m.start(), vanished)
            at = m.end()
            vanished = m.lastgroup == "char" and not self.chars.get(m.group(), m.group())
            if m.lastgroup == "char":
                put(self.chars.get(m.group(), m.group()), *m.span())
            elif m.lastgroup == "run":
                for part in self.inside.finditer(text, *m.span()):
                    if part.lastgroup == "word":
                        put(self.digits[part.group().lower()], *part.span())
                    else:
                        put(" " if not joined else "." if "." in part.group() else "", *part.span())
            else:
                put({"at": "@", "dot": ".", "plus": "+"}[m.lastgroup], *m.span())
        copy(at, len(text), vanished)
        return "".join(out), starts, ends, new


def scan(text: str, transducer: Transducer) -> list[tuple[int, int, int, bool]]:
    """Spans as (place of the kind, start, end, whether it is a base span), ascending."""
    found = [(k, a, b, True) for k, kind in enumerate(KINDS) for a, b in DETECTORS[kind](text)]
    if transducer.disguised(text):
        taken = sorted((a, b) for _, a, b, _ in found)
        reach = list(accumulate((b for _, b in taken), max))
        added = _either(_rewritten(text, transducer, False, KINDS), _rewritten(text, transducer, True, KINDS[1:]))
        found += [(k, a, b, False) for k, a, b in added if not _touches(taken, reach, a, b)]
    return sorted(found)


def _rewritten(text: str, transducer: Transducer, joined: bool, kinds: tuple[str, ...]) -> dict[tuple[int, int, int], int]:
    """Spans in ``text`` of what one way of rewriting shows, and the digits of each."""
    plain, starts, ends, new = transducer.rewrite(text, joined)
    changed = [0]
    for n in new:
        changed.append(changed[-1] + n)
    return {
        (KINDS.index(kind), starts[a], ends[b - 1]): len(_NO_DIGIT.sub("", plain[a:b]))
        for kind in kinds for a, b in DETECTORS[kind](plain) if changed[b] > changed[a]
    }


def _either(apart: dict[tuple[int, int, int], int], joined: dict[tuple[int, int, int], int]) -> list[tuple[int, int, int]]:
    """Spans of both ways of rewriting; of ones that touch, a joined one only if it holds the others and two more digits."""
    # spans of one kind and way lie apart, so those touching another are neighbours
    by_kind = [sorted((a, b) for k, a, b in apart if k == kind) for kind in range(len(KINDS))]
    kept = dict(apart)
    for (kind, start, end), n in joined.items():
        near = by_kind[kind]
        first = bisect_right(near, start, key=lambda s: s[1])
        touched = near[first : bisect_left(near, end, lo=first, key=lambda s: s[0])]
        if all(start <= a and b <= end and n >= apart[kind, a, b] + 2 for a, b in touched):
            for a, b in touched:
                kept.pop((kind, a, b), None)
            kept[kind, start, end] = n
    return list(kept)


def _touches(taken: list[Span], reach: list[int], start: int, end: int) -> bool:
    """Whether one of the ascending spans ``taken``, the first k of which reach ``reach[k - 1]``, touches another."""
    before = bisect_left(taken, end, key=lambda s: s[0])
    return before > 0 and reach[before - 1] > start


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id and ``found``, the spans by kind as in ``KINDS``, then by start."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer()
        for piece in texts.pieces(batches, "text"):
            rows = [
                [{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in scan(s, transducer)]
                for s in texts.strings(piece.column("text"))
            ]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(rows, spans.SPANS_ARROW)], names=["doc_id", "found"]
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return narrow.mapInArrow(task, f"doc_id {kind}, found {spans.SPANS_SQL}")
