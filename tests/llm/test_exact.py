from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from areaflow.llm import chunk_dedup
from tests.llm import docs


def expected(texts, ids):
    plain = [docs.GAP.sub(" ", t or "") for t in texts]
    groups: dict[str, list] = {}
    for i, p in zip(ids, plain, strict=True):
        groups.setdefault(p, []).append(i)
    rows = []
    for i, p in zip(ids, plain, strict=True):
        own = [x for x in groups[p] if x is not None]
        keep = min(own) if own else None
        rows.append((i, keep, len(groups[p]), i == keep, hashlib.sha256(p.encode()).hexdigest()))
    return sorted(rows, key=str)


def weak(chunk):
    """Three identifiers for everything: nearly all of them stand for several chunks."""
    return F.crc32(F.encode(chunk, "UTF-8")) % 3


@pytest.mark.parametrize("identify", [chunk_dedup.identifier, weak])
def test_odd_documents(spark, identify):
    texts = docs.odd_texts()
    ids = list(range(len(texts)))
    found = chunk_dedup.duplicates(docs.table(spark, texts), identify=identify).collect()
    assert sorted(map(tuple, found), key=str) == expected(texts, ids)


def test_null_and_repeated_ids(spark):
    texts, ids = ["a b", "a  b", "c", None, "", "c"], [None, 5, None, 7, 7, None]
    found = chunk_dedup.duplicates(docs.table(spark, texts, ids)).collect()
    assert sorted(map(tuple, found), key=str) == expected(texts, ids)


def test_empty_table(spark):
    assert chunk_dedup.duplicates(docs.table(spark, [])).count() == 0


def test_survivors_keep_columns_and_leave_one(spark):
    texts, ids = ["a b", "a  b", "a b", "c", "c"], [4, 3, 4, 9, 9]
    frame = docs.table(spark, texts, ids)
    left = chunk_dedup.survivors(frame)
    assert left.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(3, "a  b"), (9, "c")]


def test_survivors_keep_a_column_of_any_name(spark):
    frame = docs.table(spark, ["a", "a", "b"]).withColumns({n: F.col("doc_id") for n in ("_SHA", "_sha_", "plain")})
    left = chunk_dedup.survivors(frame)
    assert left.columns == frame.columns and left.count() == 2


def test_chunks_cover_the_text(spark):
    text = docs.odd_texts()[13]
    frame = spark.createDataFrame([(text,)], "t string").select(chunk_dedup._chunks(F.col("t")).alias("c"))
    chunks = frame.first().c
    assert "".join(chunks) == text and len(chunks) > 50


def test_most_chunks_survive_an_insertion_in_front(spark, sf_dir):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(F.length("text") > 20_000)
    plain = chunk_dedup.normalised(F.col("text"))
    cut = frame.select(
        chunk_dedup._chunks(plain).alias("a"), chunk_dedup._chunks(F.concat(F.lit("q" * 93), plain)).alias("b")
    )
    again, every = cut.select(
        F.sum(F.size(F.filter("a", lambda c: F.array_contains("b", c)))), F.sum(F.size("a"))
    ).first()
    assert every > 100 and again > 0.8 * every


@pytest.mark.parametrize("letters", ["абвгдежзиклмнопрстуфхцчшщыэюя", "กขคงจฉชซญฎฏฐฑฒณดตถทธนบปผฝพ", "가나다라마바사아자차카타파하거너더러머버서어저처"])
def test_other_scripts_are_cut_by_content(spark, letters):
    rng = random.Random(4)
    text = " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(20_000))
    frame = spark.createDataFrame([(text, "x" * 93 + text)], "t string, u string")
    a, b = frame.select(chunk_dedup._chunks(F.col("t")), chunk_dedup._chunks(F.col("u"))).first()
    assert "".join(a) == text and len(set(a) & set(b)) > 0.8 * len(a)


def test_no_python_in_the_plan(spark, sf_dir, capsys):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chunk_dedup.duplicates(frame).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
