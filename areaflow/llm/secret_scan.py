"""Secret scan over a trigram inverted index.

Each rule is a regular expression.  From its syntax tree follows a Boolean query
over trigrams that every match must contain (letters folded to lower case).  A
task indexes its texts block by block: one vectorised pass over a block's bytes
yields the postings of the wanted trigrams, the queries intersect and unite
postings, and only the texts that remain are searched with the regular
expression itself.  A rule without a mandatory trigram has the query "all" and
searches every text.  Blocks are bounded, nothing is shuffled, and a lost task
is simply run again.

Defined results: a null text counts as empty and has no span; spans are code
points, end exclusive; rows are independent, so repeated rows give repeated
results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as op
from re import _parser as syntax

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from areaflow.llm import spans, texts


@dataclass(frozen=True)
class Rule:
    """A match counts if group ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False
    flags: int = 0


# The three contracted kinds, then well-known public key formats.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
        base=True,
        flags=re.ASCII,  # "either case" of A-Z only
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18, base=True),
    Rule("hex", r"[0-9a-f]{16,}", least=16, base=True),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

KINDS = tuple(r.kind for r in RULES)
BASE_KINDS = tuple(r.kind for r in RULES if r.base)

#: A query is True (every text), a trigram, or ("and" | "or", frozenset of queries).
Query = bool | bytes | tuple

#: Larger sets of exact strings are given up for their trigrams.
_EXACT = 64


def _both(a: Query, b: Query) -> Query:
    if a is True or b is True:
        return b if a is True else a
    parts = [x[1] if isinstance(x, tuple) and x[0] == "and" else frozenset([x]) for x in (a, b)]
    return ("and", parts[0] | parts[1]) if len(parts[0] | parts[1]) > 1 else next(iter(parts[0]))


def _either(queries: list[Query]) -> Query:
    if not queries or any(q is True for q in queries):
        return True
    unique = frozenset(queries)
    return next(iter(unique)) if len(unique) == 1 else ("or", unique)


def _of_string(s: bytes) -> Query:
    query: Query = True
    for i in range(len(s) - 2):
        query = _both(query, s[i : i + 3])
    return query


def _of_strings(strings: frozenset[bytes]) -> Query:
    return _either([_of_string(s) for s in strings])


def _fold(code: int) -> bytes:
    return chr(code).encode().lower()


def _members(items) -> frozenset[bytes] | None:
    """The folded characters of a class, or None for a large or negated one."""
    found: set[bytes] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(_fold(value))
        elif kind is op.RANGE and value[1] - value[0] < 8:
            found.update(_fold(c) for c in range(value[0], value[1] + 1))
        else:
            return None
    return frozenset(found) if len(found) <= 8 else None


def _sequence(nodes) -> tuple[frozenset[bytes] | None, Query]:
    """All strings the nodes can match (None: too many to list), and the query of what is given up."""
    query: Query = True
    run: frozenset[bytes] = frozenset([b""])
    whole = True
    for kind, value in nodes:
        exact: frozenset[bytes] | None = None
        inner: Query = True
        if kind is op.LITERAL:
            exact = frozenset([_fold(value)])
        elif kind is op.IN:
            exact = _members(value)
        elif kind is op.AT or kind in (op.ASSERT, op.ASSERT_NOT):
            exact = frozenset([b""])
        elif kind is op.SUBPATTERN:
            exact, inner = _sequence(value[-1])
        elif kind is op.BRANCH:
            arms = [_sequence(arm) for arm in value[1]]
            if all(e is not None for e, _ in arms):
                exact = frozenset().union(*(e for e, _ in arms))
            else:
                inner = _either([q if e is None else _of_strings(e) for e, q in arms])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, body = value
            part, under = _sequence(body)
            if part is not None and most == 1 and least == 0:
                exact = part | {b""}
            elif part is not None and least == most and least <= 4:
                exact = frozenset([b""])
                for _ in range(least):
                    exact = frozenset(x + y for x in exact for y in part)
            elif least:
                inner = under if part is None else _of_strings(part)
        if exact is not None and len(exact) * len(run) <= _EXACT:
            run = frozenset(x + y for x in run for y in exact)
            continue
        query = _both(_both(query, _of_strings(run)), inner)
        if exact is not None:
            query = _both(query, _of_strings(exact))
        run, whole = frozenset([b""]), False
    return (run, True) if whole else (None, _both(query, _of_strings(run)))


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """What every text with a match must contain, as a Boolean query over folded trigrams."""
    exact, query = _sequence(syntax.parse(pattern, flags))
    return query if exact is None else _of_strings(exact)


def _trigrams(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set().union(*map(_trigrams, query[1])) if isinstance(query, tuple) else set()


class Index:
    """Postings of the wanted trigrams over one block of texts."""

    def __init__(self, wanted: list[bytes]):
        self.place = {t: i for i, t in enumerate(wanted)}
        self.lookup = np.full(1 << 24, -1, dtype=np.int16)
        for t, i in self.place.items():
            self.lookup[t[0] << 16 | t[1] << 8 | t[2]] = i
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32
        self.postings: list[np.ndarray] = []
        self.everything = np.zeros(0, np.int64)

    def build(self, data: np.ndarray, begins: np.ndarray) -> None:
        n = len(begins) - 1
        self.everything = np.arange(n)
        codes = self.fold[data].astype(np.uint32)
        hits = self.lookup[(codes[:-2] << 16) | (codes[1:-1] << 8) | codes[2:]] if len(codes) > 2 else np.zeros(0, int)
        at = np.flatnonzero(hits >= 0)
        owner = np.searchsorted(begins, at, side="right") - 1
        inside = at + 3 <= begins[owner + 1]  # not across two texts
        pairs = np.unique(hits[at[inside]].astype(np.int64) * n + owner[inside])
        cuts = np.searchsorted(pairs, np.arange(len(self.place) + 1) * n)
        self.postings = [pairs[a:b] - i * n for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]

    def search(self, query: Query) -> np.ndarray:
        """Places of the texts that satisfy the query, ascending."""
        if query is True:
            return self.everything
        if isinstance(query, bytes):
            return self.postings[self.place[query]]
        lists = sorted((self.search(q) for q in query[1]), key=len)
        found = lists[0]
        for more in lists[1:]:
            found = np.intersect1d(found, more, assume_unique=True) if query[0] == "and" else np.union1d(found, more)
        return found


def _search(text: str, rule: Rule, compiled: re.Pattern) -> Iterator[tuple[int, int]]:
    for m in compiled.finditer(text):
        if m.end(rule.group) - m.start(rule.group) >= rule.least:
            yield m.span()


class Scanner:
    """Made once in each task: compiled rules, their queries and an empty index."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(i, r, re.compile(r.pattern, r.flags), trigram_query(r.pattern, r.flags)) for i, r in enumerate(rules)]
        self.index = Index(sorted(set().union(*(_trigrams(q) for *_, q in self.rules))))

    def scan(self, column: pa.Array) -> tuple[list[str], list[list[tuple[int, int, int]]]]:
        """The texts, and for each its spans as (start, place of the rule, end), ascending."""
        self.index.build(*texts.raw_bytes(column))
        strings = texts.strings(column)
        found: list[list[tuple[int, int, int]]] = [[] for _ in strings]
        for i, rule, compiled, query in self.rules:
            for k in self.index.search(query).tolist():
                found[k].extend((a, i, b) for a, b in _search(strings[k], rule, compiled))
        for each in found:
            each.sort()
        return strings, found


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: the id and ``found``, the spans by start, then by the rules' order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for piece in texts.pieces(batches, "text"):
            _, found = scanner.scan(piece.column("text"))
            rows = [
                [{"kind": rules[i].kind, "start": a, "end": b, "base": rules[i].base} for a, i, b in each] for each in found
            ]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(rows, spans.SPANS_ARROW)], names=["doc_id", "found"]
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return narrow.mapInArrow(task, f"doc_id {kind}, found {spans.SPANS_SQL}")


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The same rows and columns with every found span replaced by ``[kind]``.

    Overlapping spans are replaced together, under the kind of the first.  Texts
    without a span, null ones included, stay as they are; where the table has a
    ``length`` column, rows that change get their new length.
    """
    names = docs.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for piece in texts.pieces(batches, text):
            strings, found = scanner.scan(piece.column(text))
            if any(found):
                arrays = list(piece.columns)
                at = names.index(text)
                new = [_replaced(s, each, rules) if each else None for s, each in zip(strings, found, strict=True)]
                old = arrays[at].to_pylist()
                arrays[at] = pa.array([o if n is None else n for o, n in zip(old, new, strict=True)], arrays[at].type)
                if length in names:
                    lengths = arrays[names.index(length)]
                    arrays[names.index(length)] = pa.array(
                        [o if n is None else len(n) for o, n in zip(lengths.to_pylist(), new, strict=True)], lengths.type
                    )
                piece = pa.RecordBatch.from_arrays(arrays, names=names)
            yield piece

    return docs.mapInArrow(task, docs.schema)


def _replaced(s: str, found: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    parts, at = [], 0
    for start, i, end in found:
        if start >= at:
            parts += [s[at:start], f"[{rules[i].kind}]"]
        at = max(at, end)
    return "".join([*parts, s[at:]])
