from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from areaflow.llm import ngram_join, prefix_tree, shingles
from areaflow.llm import texts as texts_module
from tests.llm import docs


def shingle_set(text):
    words = docs.lower_words(text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(texts):
    sets = [shingle_set(t) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    low = docs.smallest(list(range(len(sets))), links)
    return [(i, len(s), low[i]) for i, s in enumerate(sets)]


def found(frame, **more):
    return sorted(map(tuple, ngram_join.near_duplicates(frame, **more).collect()))


def near_copies(rng, groups, copies, words):
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = f"n{rng.randrange(5000)}"
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return texts


def test_odd_documents(spark):
    texts = docs.odd_texts()
    assert found(docs.table(spark, texts)) == expected(texts)


def test_near_copies_over_many_tiles(spark):
    rng = random.Random(5)
    shared = " ".join(f"p{k}" for k in range(55))
    texts = near_copies(rng, 6, 30, 60) + near_copies(rng, 20, 3, 25)
    texts += [f"{shared} {docs.sentence(rng, 3)} u{k} v{k} w{k}" for k in range(30)]
    texts += [f"{shared} " + " ".join(f"q{k}x{j}" for j in range(70)) for k in range(30)]
    assert found(docs.table(spark, texts), tile=8) == expected(texts)
    assert found(docs.table(spark, texts)) == expected(texts)


def test_threshold_is_inclusive(spark):
    # 7 shared shingles of 7 and 9, then of 7 and 10: 7 / 9 links, 7 / 10 does not; 9 of 12 is the threshold itself
    words = [f"k{i}" for i in range(40)]
    texts = [" ".join(words[:11]), " ".join(words[:13]), " ".join(words[20:31]), " ".join(words[20:34])]
    texts += [" ".join(f"e{i}" for i in range(13)), " ".join(f"e{i}" for i in range(16))]
    assert found(docs.table(spark, texts)) == expected(texts)
    assert [c for _, _, c in expected(texts)] == [0, 0, 2, 3, 4, 4]


def test_null_and_repeated_ids(spark):
    text = docs.odd_texts()[7]
    frame = docs.table(spark, [text, text, text, "", text], [None, 4, 4, 4, 2])
    rows = ngram_join.near_duplicates(frame).collect()
    n = len(shingle_set(text))
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(None, n, None), (4, n, 2), (4, n, 2), (4, 0, 4), (2, n, 2)], key=str
    )


def test_empty_table(spark):
    assert found(docs.table(spark, [])) == []


def test_survivors(spark):
    rng = random.Random(6)
    texts = near_copies(rng, 4, 5, 40)
    frame = docs.table(spark, texts)
    left = ngram_join.survivors(frame)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, _, c in expected(texts)})


def test_shingles_against_sets():
    texts = docs.odd_texts()
    sets = list(shingles.Shingler().sets(pa.array(texts, pa.string())))
    for a, s in zip(texts, sets, strict=True):
        assert len(s) == len(shingle_set(a))
        for b, t in zip(texts, sets, strict=True):
            assert len(np.intersect1d(s, t)) == len(shingle_set(a) & shingle_set(b))


def thue_morse(n, flip=False):
    return "".join("ab"[(k.bit_count() + flip) % 2] for k in range(n))


@pytest.mark.parametrize("n", [8, 64, 256, 1024, 1 << 15])
def test_words_that_polynomials_modulo_powers_of_two_confuse(spark, n):
    words = [thue_morse(n), thue_morse(n, True), thue_morse(n).upper()]
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs.table(spark, words)).collect()}
    assert found == {0: 0, 1: 1, 2: 0}


def test_words_of_every_length_have_their_own_hash():
    words = sorted({c * n for c in "abé\x00" for n in range(1, 300)} | {"a" * n + "b" for n in range(300)})
    data, begins = texts_module.raw_bytes(pa.array(words, pa.string()))
    hashes, at = shingles.Shingler().word_hashes(data, begins)
    assert len(set(hashes.tolist())) == len(words) == len(hashes)
    alone = [shingles.Shingler().word_hashes(*texts_module.raw_bytes(pa.array([w], pa.string())))[0][0] for w in words[::50]]
    assert alone == hashes[::50].tolist()


def test_packed_numbers_come_back():
    numbers = np.array([0, 1, 2**63, 2**64 - 1], np.uint64)
    assert (shingles.unpack(shingles.pack(numbers), np.uint64) == numbers).all()


def test_tree_finds_what_all_pairs_find():
    rng = np.random.default_rng(1)
    for _ in range(100):
        m = int(rng.integers(1, 14))
        base = rng.integers(0, 60, 30)
        sets = [
            np.unique(np.r_[base[rng.random(30) < 0.9], rng.integers(0, 60, int(rng.integers(1, 6)))]).astype(np.uint64)
            for _ in range(m)
        ]
        sizes = np.array([len(s) for s in sets]) + rng.integers(0, 4, m)
        tree = prefix_tree.PrefixTree(sets, sizes)
        for q in range(m):
            i = tree.order[q]
            linked = []
            for k in range(q + 1, m):
                j = tree.order[k]
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 75 * (sizes[i] + sizes[j] - both):
                    linked.append(k)
            assert sorted(tree.search(q, q + 1).tolist()) == linked
