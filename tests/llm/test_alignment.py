from __future__ import annotations

from collections import Counter

import numpy as np
import public_tokenizers as public
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from areaflow.llm import token_alignment
from tests.llm import docs

FIRST = token_alignment.ByteVocabulary(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
SECOND = token_alignment.PieceVocabulary(public.path("piece_bpe_32k.model"))
TEXTS = docs.odd_texts() + [
    "Plain words, twice. Plain words, twice.", "say <|endoftext|> and </s> <s>", "▁ under", "  two  spaces\n\ttab", " ", "ﬁ ligature ｆｕｌｌ",
    "Straße über café naïve 12345.678", "​zero", "é", "é", "🎉 x 🎉", "the the the the", "𝒳 ∑ ∞", "x\x00y",
]


def by_bytes(text):
    """Tokens of both with their bytes, from the libraries' own files, or none."""
    if not text:
        return [], []
    plain = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in kept]
    back = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}
    encoded = plain.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(back[c] for c in plain.id_to_token(i))) for i in encoded.ids]
    pieces = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    b = []
    for i in pieces.encode(text):
        p = pieces.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
    spaced = b" " + text.encode()
    return (a, b) if b"".join(x for _, x in a) == spaced == b"".join(x for _, x in b) else ([], [])


def groups_of(a, b):
    written, i, j, end_a, end_b, own = [], 0, 0, 0, 0, ([], [])
    while i < len(a) or j < len(b):
        if j == len(b) or (end_a <= end_b and i < len(a)):
            own[0].append(str(a[i][0]))
            end_a += len(a[i][1])
            i += 1
        else:
            own[1].append(str(b[j][0]))
            end_b += len(b[j][1])
            j += 1
        if end_a == end_b:
            written.append(",".join(own[0]) + "|" + ",".join(own[1]))
            own = ([], [])
    return ";".join(written)


def links_of(a, b):
    at = {int(e): i for (i, _), e in zip(b, np.cumsum([len(x) for _, x in b]), strict=True)}
    return [(i, at[int(e)]) for (i, _), e in zip(a, np.cumsum([len(x) for _, x in a]), strict=True) if int(e) in at]


@pytest.mark.parametrize("hot_pairs", [token_alignment.HOT_PAIRS, 40, 0])
def test_odd_documents(spark, hot_pairs):
    """All pairs travel, a few do and the others are joined, or all are joined."""
    both = [by_bytes(t) for t in TEXTS]
    links = [links_of(*x) for x in both]
    count = Counter(p for own in links for p in own)
    best: dict[int, int] = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    expected = [
        (i, len(a), len(b), len(groups_of(a, b).split(";")) if a else 0, len(own), groups_of(a, b),
         sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own))
        for i, ((a, b), own) in enumerate(zip(both, links, strict=True))
    ]
    found = token_alignment.align(docs.table(spark, TEXTS), FIRST, SECOND, hot_pairs=hot_pairs)
    assert sorted(map(tuple, found.collect())) == expected
    assert sum(x[1] > 0 for x in expected) > len(TEXTS) // 2


def test_long_texts_are_aligned_whole(spark):
    texts = ["x" * 200_000, "word and " * 60_000, " " * 100_000, "日本" * 50_000]
    found = token_alignment.align(docs.table(spark, texts), FIRST, SECOND).collect()
    for row in found:
        encoded = FIRST.encoder()([texts[row.doc_id]])[0]
        other = SECOND.encoder()([texts[row.doc_id]])[0]
        assert row.n_a in (0, len(encoded))
        assert row.n_b in (0, len(other))
        sides = [g.split("|") for g in row.groups.split(";")] if row.groups else []
        assert len(sides) == row.n_groups
        assert [int(i) for s in sides for i in s[0].split(",")] == encoded.tolist()[: row.n_a]
    assert sum(r.n_a > 0 for r in found) >= 2


def test_repeated_and_null_ids_and_no_rows(spark):
    texts, ids = ["some words here", "some words here", None, "other"], [5, 5, None, None]
    found = token_alignment.align(docs.table(spark, texts, ids), FIRST, SECOND).collect()
    assert sorted((r.doc_id or 0, r.n_a > 0) for r in found) == [(0, False), (0, True), (5, True), (5, True)]
    twice = [r for r in found if r.doc_id == 5]
    assert all(r.count_sum == 2 * r.n_links for r in twice)
    assert token_alignment.align(docs.table(spark, []), FIRST, SECOND).count() == 0


@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1), st.lists(st.integers(1, 4), min_size=1)), min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_cuts_are_the_common_ends(pairs):
    """Any two ways to cut a text; the shorter is filled up so that both end together."""
    ends, starts, base = ([], []), ([0], [0]), 0
    for sides in pairs:
        sides = [list(s) for s in sides]
        longest = max(map(sum, sides))
        for k, side in enumerate(sides):
            if sum(side) < longest:
                side.append(longest - sum(side))
            ends[k].extend((base + np.cumsum(side)).tolist())
            starts[k].append(len(ends[k]))
        base += longest
    a, b = (np.array(e) for e in ends)
    found_a, found_b = token_alignment.cuts(a, b, np.array(starts[0]), np.array(starts[1]))
    common = sorted(set(ends[0]) & set(ends[1]))
    assert a[found_a].tolist() == b[found_b].tolist() == common
