from __future__ import annotations

import numpy as np
import pytest

from areaflow.llm import line_dedup
from areaflow.llm.perfect_hash import PerfectHash
from tests.llm import docs

WHITE = " \t\n\x0b\x0c\r"
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def expected(texts, ids, least=10):
    def key(line):
        return line.strip(WHITE).translate(UPPER)

    holders: dict[str, set] = {}
    for i, text in zip(ids, texts, strict=True):
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    rows = []
    for i, text in zip(ids, texts, strict=True):
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            who = holders[key(line)]
            named = [w for w in who if w is not None]
            if len(key(line)) < least or len(who) < 2 or not named or i == min(named):
                kept.append(line)
        rows.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(rows, key=str)


def shared_texts():
    long = "a line that very many of them hold"
    return docs.odd_texts() + [
        f"{long}\nsecond of its own\n{long}", f"  {long.upper()}\t\r\nkurz\nkurz", long, "\n\n\n", "ä" * 9 + "\n" + "ö" * 10,
        "Ö" * 10 + "\n" + "ö" * 10, "ö" * 10 + "\x85", *[f"{long}\nnumber {i} alone" for i in range(60)],
    ]


@pytest.mark.parametrize(("shard_keys", "part_probes"), [(8192, 65_536), (7, 11)])
def test_lines_of_odd_documents(spark, shard_keys, part_probes):
    """One shard, and many shards of which the hot one is taken in parts."""
    texts = shared_texts()
    ids = list(range(len(texts)))
    found = line_dedup.drop_shared(docs.table(spark, texts), shard_keys=shard_keys, part_probes=part_probes)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(texts, ids)


def test_null_and_repeated_ids(spark):
    texts = ["one shared line\nx", "one shared line\ny", "one shared line\nx", "a line without any id", "a line without any id"]
    ids = [4, None, 4, None, None]
    found = line_dedup.drop_shared(docs.table(spark, texts, ids))
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(texts, ids)


def test_rows_of_one_id_are_one_document(spark):
    texts, ids = ["one shared line\nx", "one shared line"], [7, 7]
    found = line_dedup.drop_shared(docs.table(spark, texts, ids))
    assert sorted(r.n_dropped for r in found.collect()) == [0, 0]


def test_no_rows(spark):
    assert line_dedup.drop_shared(docs.table(spark, [])).count() == 0


@pytest.mark.parametrize(("n", "levels"), [(0, 32), (1, 32), (50_000, 32), (500, 1)])
def test_indexes_are_a_permutation(n, levels):
    """Also with so few levels that keys are listed."""
    rng = np.random.default_rng(n)
    low, high = rng.integers(0, 1 << 63, (2, n)).astype(np.uint64)
    low[: n // 2] = 5  # halves may repeat, keys do not
    built = PerfectHash.build(low, high, levels)
    row = built.to_row()
    again = PerfectHash.from_row(row["sizes"], row["bits"], row["rest"])
    assert sorted(again.find(low, high).tolist()) == list(range(n))
    assert len(built.rest) == 0 or levels == 1
    strange = again.find(high, low)
    assert ((strange >= -1) & (strange < max(1, n))).all()
    assert len(built.bits) <= 5 * max(8, n) or levels == 1
