from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from areaflow.llm import packing
from tests.llm import docs

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, texts, ids, reference, length):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in zip(ids, texts, strict=True):
        own = [*reference.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            part = np.array(own[at : at + r.length], "<u4")
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(part.tobytes()), len(own))
            at += r.length
        assert at == len(own)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length


@pytest.mark.parametrize("length", [64, 1024])
def test_odd_documents(spark, reference, length):
    texts = docs.odd_texts()
    rows = packing.pack(docs.table(spark, texts), PATH, public_tokenizers.PATTERN, length).collect()
    check(rows, texts, range(len(texts)), reference, length)


def test_added_tokens_in_a_text(spark, reference):
    end = "<|endoftext|>"
    texts = [end, f"one {end} two", f"one  {end}{end}\n\n x", f"a<|endoftext|b{end[:-1]}", f"  {end}  "]
    rows = packing.pack(docs.table(spark, texts), PATH, public_tokenizers.PATTERN).collect()
    assert reference.encode(end, add_special_tokens=False).ids == [50256]
    check(rows, texts, range(len(texts)), reference, packing.LENGTH)


def test_sequences_hold_the_ids(spark, reference):
    texts = docs.odd_texts()[:12]
    packed, _ = packing.session.staged(
        packing.pack(docs.table(spark, texts), PATH, public_tokenizers.PATTERN, 64, keep_ids=True), "packed"
    )
    rows = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert rows[r.sequence_id][r.offset : r.offset + r.length] == r.ids


def test_groups_and_little_padding(spark):
    texts = [docs.sentence(docs.random.Random(k), 40 + 13 * k % 400) for k in range(400)]
    cut, _ = packing.session.staged(packing.pieces(docs.table(spark, texts), PATH, public_tokenizers.PATTERN), "cut")
    rows = packing.assign(cut, group_pieces=100).collect()
    used = {r.sequence_id for r in rows}
    assert len({s >> 32 for s in used}) > 2
    assert sum(r.length for r in rows) > 0.9 * 1024 * len(used)


def test_repeated_rows_and_empty_table(spark):
    frame = docs.table(spark, ["same text"] * 50, [7] * 50)
    rows = packing.pack(frame, PATH, public_tokenizers.PATTERN).collect()
    assert len(rows) == 50 and len({(r.sequence_id, r.offset) for r in rows}) == 50
    assert packing.pack(docs.table(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_first_fit_against_a_scan():
    rng = np.random.default_rng(3)
    sizes = sorted(rng.integers(1, 101, 300).tolist(), reverse=True)
    rooms, want = [], []
    for size in sizes:
        k = next((i for i, r in enumerate(rooms) if r >= size), len(rooms))
        if k == len(rooms):
            rooms.append(100)
        want.append((k, 100 - rooms[k]))
        rooms[k] -= size
    assert list(zip(*packing.first_fit(sizes, 100), strict=True)) == want
