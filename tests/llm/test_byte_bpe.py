from __future__ import annotations

import random
import string
import time

import public_tokenizers
import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from areaflow.llm import byte_bpe, packing
from tests.llm import docs

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return packing.read_ranks(PATH)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def round_trip(spark, texts, ranks, words):
    frame = docs.table(spark, texts)
    vocabulary = byte_bpe.learned(frame, ranks, public_tokenizers.PATTERN, words=words)
    encoded = byte_bpe.encode(frame, vocabulary).select("doc_id", "ids", vocabulary.decode(F.col("ids")).alias("back"))
    return {r.doc_id: (r.ids, bytes(r.back)) for r in encoded.collect()}


@pytest.mark.parametrize("words", [0, 5, 1 << 16])
def test_odd_documents(spark, ranks, reference, words):
    texts = docs.odd_texts() + ["aaaaaa aaaaaaaaaaaaa", "it's we'll \r\n\r\n  x", "a\x1cb"]
    found = round_trip(spark, texts, ranks, words)
    for i, t in enumerate(texts):
        assert found[i] == (reference.encode_ordinary(t or ""), (t or "").encode()), t


def test_long_words_end(spark, ranks, reference):
    rng = random.Random(5)
    texts = ["".join(rng.choices(string.ascii_lowercase, k=n)) for n in (99, 100, 101, 102, 4_000)] + ["ab" * 50_000]
    assert {i: ids for i, (ids, _) in round_trip(spark, texts, ranks, 0).items()} == {
        i: reference.encode_ordinary(t) for i, t in enumerate(texts)
    }


def test_short_words_stop_at_the_last_merge(spark, ranks, reference):
    """99 bytes without a merge are one look at 98 pairs, not 98 of them."""
    words = ["\x01\x7f" * 49 + "\x01"] * 20_000
    assert reference.encode_ordinary(words[0]) == [reference.encode_ordinary(c)[0] for c in words[0]]
    frame = docs.table(spark, words).coalesce(1)
    vocabulary = byte_bpe.Vocabulary(ranks, public_tokenizers.PATTERN)
    assert byte_bpe.encode(frame.limit(1), vocabulary).first().ids == reference.encode_ordinary(words[0])
    began = time.monotonic()
    byte_bpe.encode(frame, vocabulary).write.format("noop").mode("overwrite").save()
    assert time.monotonic() - began < 20


def test_words_are_no_part_of_a_plan_or_a_row(spark, ranks, capsys):
    frame = docs.table(spark, ["zyxwvutsrq zyxwvutsrq"] * 2)
    vocabulary = byte_bpe.learned(frame, ranks, public_tokenizers.PATTERN)
    byte_bpe.encode(frame, vocabulary).explain()
    plan = capsys.readouterr().out
    assert "Subquery" in plan and "zyxwvutsrq" not in plan
    assert "AS _buckets" not in plan  # the optimizer moved it into the expression that uses it


def test_words_are_bounded_in_bytes(spark, ranks, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "WORD_BYTES", 60)
    frame = docs.table(spark, ["alpha beta alpha beta alpha"] * 3)
    vocabulary = byte_bpe.Vocabulary(ranks, public_tokenizers.PATTERN)
    assert {r.word for r in byte_bpe.frequent_words(frame, vocabulary).collect()} == {" alpha", " beta"}


def test_empty_table(spark, ranks):
    assert round_trip(spark, [], ranks, 10) == {}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), min_size=20, max_size=40))
def test_any_text(spark, ranks, reference, texts):
    vocabulary = byte_bpe.Vocabulary(ranks, public_tokenizers.PATTERN)
    frame = docs.table(spark, texts)
    found = {r.doc_id: r.ids for r in byte_bpe.encode(frame, vocabulary).collect()}
    assert [found[i] for i in range(len(texts))] == [reference.encode_ordinary(t) for t in texts]


def test_the_maps_of_the_vocabulary_are_made_once(spark, ranks, monkeypatch):
    made, merges = [], byte_bpe._merges
    monkeypatch.setattr(byte_bpe, "_merges", lambda r: made.append(len(r)) or merges(r))
    byte_bpe.learned(docs.table(spark, ["alpha beta alpha"] * 2), ranks, public_tokenizers.PATTERN)
    assert made == [len(ranks)]
