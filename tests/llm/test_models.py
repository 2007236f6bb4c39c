"""Quality, language and language model: held-out results, whole texts, odd rows."""

from __future__ import annotations

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from areaflow.llm import attention_lm, language, packing, quality
from tests.llm import docs


@pytest.fixture(scope="module")
def net(spark):
    base = "/root/testdata/sf0.01"
    frame, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    return quality.train(frame, labels, fold=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)


def test_quality_held_out(spark, net):
    base = "/root/testdata/sf0.01"
    scored = quality.score(spark.read.parquet(f"{base}/documents.parquet"), net)
    rows = scored.join(spark.read.parquet(f"{base}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good = [r.score for r in held if r.quality == 1]
    poor = [r.score for r in held if r.quality == 0]
    assert np.mean([s >= quality.THRESHOLD for s in good]) > 0.95
    assert np.mean([g > p for g in good for p in poor]) > 0.95


def test_quality_looks_at_the_whole_text(net):
    fine = docs.odd_texts()[13][:20_000]
    rng = np.random.default_rng(1)
    junk = " ".join("".join(rng.choice(list("#$%&*!")) for _ in range(12)) for _ in range(200))
    scorer = quality.Scorer(net)
    a, b = scorer.pooled(*_bytes([fine, fine + junk]))
    assert not np.allclose(a, b)


def _bytes(texts):
    from areaflow.llm import texts as t

    return t.raw_bytes(pa.array(texts, pa.string()))


def test_quality_pooling_against_a_loop(net):
    texts = [t for t in docs.odd_texts()] + ["abcde", "abcdef", "y" * 512, "y" * 513, "z" * 1000]
    found = quality.Scorer(net).pooled(*_bytes(texts))
    for text, row in zip(texts, found, strict=True):
        data = (text or "").encode()
        tops = []
        starts = list(range(0, max(1, len(data) - quality.CHUNK + quality.STEP), quality.STEP)) if data else []
        for s in starts:
            chunk = data[s : s + quality.CHUNK]
            places = max(1, len(chunk) - quality.WIDTH + 1)
            answers = [
                sum(net.taps[j][chunk[p + j]] for j in range(quality.WIDTH) if p + j < len(chunk)) for p in range(places)
            ]
            tops.append(np.maximum(np.max(answers, axis=0) + net.bias, 0))
        want = np.zeros(quality.POOLED)
        want[-1] = min(len(data), quality.CHUNK) / quality.CHUNK
        if tops:
            want[: quality.FILTERS] = np.mean(tops, axis=0)
            want[quality.FILTERS : -1] = np.max(tops, axis=0)
        assert np.allclose(row, want, atol=1e-3)


def test_quality_learns_from_what_it_scores(net):
    texts = [t or "" for t in docs.odd_texts()] + ["abcde", "abcdef", "y" * 512, "y" * 513, "é" * 700]
    scored = quality.Scorer(net).pooled(*_bytes(texts))
    for text, row in zip(texts, scored, strict=True):
        chunks = quality._chunk_rows(text.encode())
        if len(chunks):
            top = np.maximum(quality._tops(net, chunks, block=7)[1], 0)
            want = np.r_[top.mean(axis=0), top.max(axis=0), (chunks[0] < 256).mean()]
            assert np.allclose(row, want, atol=1e-3), text[:20]


def test_quality_sees_every_part_of_a_sampled_text(monkeypatch):
    monkeypatch.setattr(quality, "_STEPS", 3)
    fine = docs.odd_texts()[13].encode()[:40_000]
    plain = quality.fit([(fine, 1), (fine, 0)])
    for at in range(0, 40_000, 7_777):
        junk = fine[:at] + b"#$%&*!#$%&*!" * 3 + fine[at:]
        other = quality.fit([(junk, 1), (fine, 0)])
        assert not np.allclose(plain.taps, other.taps, atol=0)


def test_quality_sample_is_bounded_in_rows_and_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda samples: seen.append(samples))
    texts = ["ab", None, "x" * 50, "ab", "é"]
    frame = docs.table(spark, texts + texts, [1, 2, 3, 4, 5] * 2)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 6)], "doc_id long, quality int")
    quality.train(frame, labels)
    quality.train(frame, labels, rows=3)
    quality.train(frame, labels, size=60)
    assert sorted(seen[0]) == sorted(((t or "").encode(), i % 2) for i, t in [*zip([1, 2, 3, 4, 5] * 2, texts + texts)])
    assert len(seen[1]) == 3 and seen[1] == seen[0][:3]
    assert sum(len(t) for t, _ in seen[2]) <= 60 and seen[2] == seen[0][: len(seen[2])]


def test_quality_odd_rows(spark, net):
    texts = docs.odd_texts()
    frame = docs.table(spark, texts + texts, [*range(len(texts)), *[None] * len(texts)])
    rows = quality.score(frame, net).collect()
    assert len(rows) == 2 * len(texts) and all(0 <= r.score <= 1 for r in rows)
    kept = quality.keep_good(frame, net)
    assert kept.columns == frame.columns
    assert kept.count() == sum(r.score >= quality.THRESHOLD for r in rows)
    assert quality.score(docs.table(spark, []), net).count() == 0


def test_quality_without_labels(spark):
    frame = docs.table(spark, docs.odd_texts())
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score(frame, quality.train(frame, labels)).collect()} == {0.5}


def test_language_held_out(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    filters = language.learn(frame.filter(fold != 2))
    rows = language.predict(frame.filter(fold == 2), filters).join(frame, "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98


def test_language_odd_rows(spark):
    frame = docs.table(spark, docs.odd_texts())
    filters = language.learn(frame)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(frame, filters).collect()}
    for i, t in enumerate(docs.odd_texts()):
        letters = any(c.isalpha() for c in t or "")
        assert found[i][0] == ("en" if letters else "und")
        assert 0 <= found[i][1] <= 1
    nothing = language.learn(frame.withColumn("lang", F.lit(None).cast("string")))
    assert {tuple(r)[1:] for r in language.predict(frame, nothing).collect()} == {("und", 0.0)}
    assert language.predict(docs.table(spark, []), filters).count() == 0


def test_language_against_a_loop(spark):
    """Counts, kept trigrams, correction for false positives and scores, by sets and dictionaries."""
    own = [("der hund und die katze", "de"), ("Über uns", "de"), ("the dog and the cat", "en"), ("", "en"), (None, "en")]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(own * 3)], "doc_id long, text string, lang string")

    def grams(text):
        padded = [c if c.isalpha() else " " for c in f" {(text or '').lower()} "]
        return ["".join(padded[i - 1 : i + 2]) for i in range(1, len(padded) - 1) if padded[i] != " "]

    def packed(gram):
        return (ord(gram[0]) << 42) | (ord(gram[1]) << 21) | ord(gram[2])

    counts = Counter((lang, packed(g)) for text, lang in own * 3 for g in grams(text))
    assert {(r.lang, r.gram): r.n for r in language.count_trigrams(frame).collect()} == counts
    total = Counter()
    for (lang, _), n in counts.items():
        total[lang] += n
    filters = language.learn(frame, min_share=0.075)
    kept = {x: {g for (lang, g), n in counts.items() if lang == x and n >= 0.075 * total[x]} for x in total}
    assert 0 < len(kept["en"]) < len({g for lang, g in counts if lang == "en"})

    def hit(i, gram):
        places = filters._places(np.array([gram], np.uint64), len(filters.slots))
        return all(int(filters.slots[p[0], 0]) >> i & 1 for p in places)

    for i, lang in enumerate(filters.languages):
        assert all(hit(i, g) for g in kept[lang])
        used = {int(p[0]) for g in kept[lang] for p in filters._places(np.array([g], np.uint64), len(filters.slots))}
        assert math.isclose(filters.full[i], (len(used) / len(filters.slots)) ** language.HASHES)
    texts = ["the cat", "die katze und the dog", "123", "qqq", "Über"]
    names, scores = filters.decide(texts)
    for text, name, score in zip(texts, names, scores, strict=True):
        found = [packed(g) for g in grams(text)]
        share = [
            min(1, max(0, (sum(hit(i, g) for g in found) / max(1, len(found)) - f) / (1 - f)))
            for i, f in enumerate(filters.full)
        ]
        assert name == (filters.languages[int(np.argmax(share))] if found else "und")
        assert math.isclose(score, max(share) / sum(share) if sum(share) else 0.0, abs_tol=1e-9)


def test_language_many_languages_in_bits():
    rng = np.random.default_rng(2)
    learned = {f"l{k:03d}": np.unique(rng.integers(0, 2**62, 300).astype(np.uint64)) for k in range(130)}
    filters = language.Filters.build(learned)
    for k, name in enumerate(filters.languages):
        found = filters.containing(learned[name])
        assert ((found[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).all()


def test_language_model_base_and_edges(spark):
    texts = docs.odd_texts() + ["alpha beta unseenword"]
    ids = [*range(len(texts) - 1), 99]
    frame = docs.table(spark, texts, ids)
    training = frame.filter("doc_id <> 99")
    ranks = packing.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    counts = Counter(w for t in texts[:-1] for w in docs.lower_words(t))
    n_docs = len(texts) - 1
    total, distinct = sum(counts.values()) + n_docs, len(counts) + 1
    for frequent in (0, 3, 1000):
        rows = attention_lm.score(frame, training, ranks, public_tokenizers.PATTERN, frequent=frequent).collect()
        assert len(rows) == len(texts)
        for r in rows:
            words = docs.lower_words(texts[ids.index(r.doc_id)])
            base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
            base += math.log10((n_docs + 0.1) / (total + 0.1 * (distinct + 1)))
            assert r.n_tokens == len(words) + 1 and r.train_tokens == total
            assert r.n_known == sum(counts[w] > 0 for w in words) + 1
            assert r.base_score == pytest.approx(base, rel=1e-9)
            assert r.score < 0 and math.isfinite(r.score)


def test_language_model_without_training(spark):
    ranks = packing.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    frame = docs.table(spark, ["a b", None])
    rows = attention_lm.score(frame, frame.limit(0), ranks, public_tokenizers.PATTERN).collect()
    assert {(r.n_known, r.train_tokens) for r in rows} == {(0, 0)}
    empty = attention_lm.score(frame.limit(0), frame, ranks, public_tokenizers.PATTERN)
    assert empty.count() == 0


def test_windows_score_each_id_once():
    rng = np.random.default_rng(4)
    ids = [rng.integers(0, 50, n).astype(np.int32) for n in (1, 7, 24, 25, 100)]
    inputs, targets = attention_lm.cut(ids, 50)
    assert np.concatenate([t[t >= 0] for t in targets]).tolist() == np.concatenate(ids).tolist()
    for row, out in zip(inputs, targets, strict=True):
        shown = row[row >= 0]
        assert shown[-1] in (50, *np.concatenate(ids)) and len(out) == attention_lm.SCORED


def test_language_model_gradients():
    a, rng = attention_lm, np.random.default_rng(0)
    shapes = [(6, a.WIDTH), (a._SPAN, a.WIDTH), *[(a.WIDTH, a.WIDTH)] * 4, (a.WIDTH, a.HIDDEN), (a.HIDDEN,)]
    shapes += [(a.HIDDEN, a.WIDTH), (a.WIDTH, a.CLASSES), (a.CLASSES,)]
    layers = a.Layers(*[rng.normal(0, 0.15, s) for s in shapes])
    inputs, targets = a.cut([np.array([1, 2, 3, 4, 0], np.int32), np.array([3, 1] * 15, np.int32)], 5)
    shares = a._shares(rng.random((6, a.CLASSES)), np.arange(6))
    _, grads, parts = a._gradients(layers, inputs, targets, shares)
    assert np.allclose(parts.sum(axis=-1), 1)
    for name in layers.__dataclass_fields__:
        x = getattr(layers, name)
        for _ in range(3):
            at = tuple(rng.integers(0, s) for s in x.shape)
            old = x[at]
            x[at] = old + 1e-5
            up = a._gradients(layers, inputs, targets, shares.astype(float))[0]
            x[at] = old - 1e-5
            down = a._gradients(layers, inputs, targets, shares.astype(float))[0]
            x[at] = old
            assert (up - down) / 2e-5 == pytest.approx(grads[name][at], rel=1e-3, abs=1e-6)


def test_language_model_step_costs_what_its_windows_hold():
    """No step makes a row for each id there is; sums and moves are those of the ids met."""
    a, rng, size = attention_lm, np.random.default_rng(2), 200_000
    shapes = [(size, a.WIDTH), (a._SPAN, a.WIDTH), *[(a.WIDTH, a.WIDTH)] * 4, (a.WIDTH, a.HIDDEN), (a.HIDDEN,)]
    shapes += [(a.HIDDEN, a.WIDTH), (a.WIDTH, a.CLASSES), (a.CLASSES,)]
    layers = a.Layers(*[rng.normal(0, 0.15, s).astype(np.float32) for s in shapes])
    learner = a.Learner(layers, np.full((size, a.CLASSES), 1 / a.CLASSES, np.float32), np.ones(size), 1)
    ids = [rng.integers(0, 50, n).astype(np.int32) * 3000 for n in (70, 1, 200)]
    learner.learn(ids[:1])
    tracemalloc.start()
    learner.learn(ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < layers.emb.nbytes / 4
    counts = np.bincount(np.concatenate([ids[0], *ids]), minlength=size)
    assert np.allclose(learner.gathered.sum(axis=1), counts) and learner.seen == counts.sum()
    assert ((learner.m.emb != layers.emb).any(axis=1) == (learner.met > 0)).all()


def test_language_model_is_a_distribution():
    """Over all ids that can follow, probabilities add up to one; tables give what the layers give."""
    a, rng = attention_lm, np.random.default_rng(1)
    sample = [rng.integers(0, 40, 60).astype(np.int32) for _ in range(20)]
    shapes = [(41, a.WIDTH), (a._SPAN, a.WIDTH), *[(a.WIDTH, a.WIDTH)] * 4, (a.WIDTH, a.HIDDEN), (a.HIDDEN,)]
    shapes += [(a.HIDDEN, a.WIDTH), (a.WIDTH, a.CLASSES), (a.CLASSES,)]
    layers, parts = a.Layers(*[rng.normal(0, 0.4, s).astype(np.float32) for s in shapes]), rng.random((41, a.CLASSES))
    counts = np.bincount(np.concatenate(sample), minlength=41)
    model = a.Model.build(layers, parts, counts)
    first = sample[0][:30]
    scores = model.scores([np.r_[first, np.int32(k)] for k in range(41)])
    assert (10 ** (scores - model.scores([first])[0])).sum() == pytest.approx(1, rel=1e-3)
    inputs, targets = a.cut(sample[:3], 40)
    loss, _, _ = a._gradients(layers, inputs, targets, a._shares(parts, counts))
    assert model.scores(sample[:3]).sum() == pytest.approx(-loss * (targets >= 0).sum() / np.log(10), rel=1e-3)


def test_language_model_learns_from_every_text(spark):
    """A text outside the starting sample changes what is known of context; so does the far end of a long text."""
    ranks = packing.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = attention_lm.Subwords(ranks, public_tokenizers.PATTERN)
    start = "alpha beta gamma delta eps zeta eta theta iota kappa "
    size = known.size
    layers, held = attention_lm.fit([known.document(attention_lm.words_of(start))], size)
    held = np.full(held.shape, 1 / attention_lm.CLASSES)
    late = attention_lm.words_of("omega psi chi")
    ids = np.unique(np.concatenate([known.document([w])[:-1] for w in late]))
    for tasks in (1, 3):
        frame = docs.table(spark, [start * 40 + "omega psi chi " * 30, start, None]).repartition(3)
        after, parts = attention_lm.learn_all(frame, layers, held, np.ones(size), ranks, public_tokenizers.PATTERN, tasks)
        assert (after.emb[ids] != layers.emb[ids]).any(axis=1).all()
        assert not np.allclose(parts[ids], held[ids]) and np.allclose(parts.sum(axis=1), 1)
        unmet = np.setdiff1d(np.arange(size), np.concatenate([known.document(attention_lm.words_of(start)), ids]))
        assert (after.emb[unmet] == layers.emb[unmet]).all()


def test_language_model_ends_are_real():
    ranks = packing.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = attention_lm.Subwords(ranks, public_tokenizers.PATTERN)
    cut_off, whole = attention_lm.begun_ids(known, [("one two thr", False), ("one two", True), ("cut", False)])
    assert whole[-1] == known.end and cut_off.tolist() == whole[:-1].tolist()


def test_language_model_starts_on_distinct_texts(spark):
    frame = docs.table(spark, [f"text {k}" for k in range(40) for _ in range(50)])
    begun = attention_lm.starting_texts(frame, most=10)
    assert len(begun) == len(set(begun)) == 10 and all(whole for _, whole in begun)
    assert attention_lm.starting_texts(docs.table(spark, [])) == []
