"""The pipeline against a slow version of each stage on its own input."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from areaflow import session
from areaflow.llm import quality, secret_scan
from tests.llm import docs
from tests.llm.test_ngram_join import shingle_set

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    frames, frame = {}, spark.read.parquet(f"{SF}/documents.parquet")
    frames["documents"] = frame
    for name, stage in corpus_pipeline.STAGES:
        frame, _ = session.staged(stage(spark, frame, SF), name)
        frames[name] = frame
    return frames


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_columns_stay(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_quality_rejects_and_keeps(spark, stages):
    before, after = rows(stages["documents"]), rows(stages["quality"])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i in after for i, y in labels.items() if y == 1]
    poor = [i in after for i, y in labels.items() if y == 0]
    assert np.mean(good) > 0.95 and np.mean(poor) < 0.3
    assert all(after[i] == before[i] for i in after)


def test_exact_copies_leave_one(stages):
    before, after = rows(stages["quality"]), rows(stages["exact_dedup"])
    first = {}
    for i in sorted(before):
        first.setdefault(docs.GAP.sub(" ", before[i].text or ""), i)
    assert after == {i: before[i] for i in first.values()}


def test_near_copies_leave_one(stages):
    before, after = rows(stages["exact_dedup"]), rows(stages["near_dedup"])
    sets = {i: shingle_set(r.text) for i, r in before.items()}
    links = [
        (i, j) for i in sets for j in sets
        if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    low = docs.smallest(list(sets), links)
    assert after == {i: before[i] for i in sets if low[i] == i}


def test_secrets_are_gone(stages):
    before, after = rows(stages["near_dedup"]), rows(stages["secrets"])
    assert set(before) == set(after)
    scanner = secret_scan.Scanner(secret_scan.RULES)
    ids = sorted(before)
    _, found = scanner.scan(pa.array([before[i].text for i in ids]))
    for i, spans in zip(ids, found, strict=True):
        assert (after[i] == before[i]) == (not spans)
    _, left = scanner.scan(pa.array([after[i].text for i in ids]))
    assert not any(left)
    assert all(after[i].n_chars == len(after[i].text) for i in ids if after[i] != before[i])


def test_packing_takes_everything(stages):
    packed = stages["packing"].collect()
    assert {r.doc_id for r in packed} == set(rows(stages["secrets"]))
    assert all(sum(r.length for r in packed if r.doc_id == i) == next(r.doc_tokens for r in packed if r.doc_id == i) for i in {r.doc_id for r in packed})


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == stages["packing"].columns and found.count() == stages["packing"].count()


def test_empty_documents(spark, tmp_path):
    frame = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    net = quality.fit([])
    assert quality.keep_good(frame, net).count() == 0
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, frame, SF).count() == 0, name
