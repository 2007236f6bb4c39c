r"""Lines that several documents share, kept in one of them, by sharded perfect hashes.

A line's key is the line without white space at its ends and with A-Z in lower case.
Every distinct key, as a 128-bit hash, belongs to a shard.  A shard is one row: a
minimal perfect hash of its keys, and arrays in the order of its indexes that hold a
32-bit fingerprint, the number of documents and the smallest document of each key.
Lines go to the shards as hashes and probe the arrays there; no line's text is
moved or joined.  What comes back is the number of each line that its document loses.

A shard with many probes, as a line in very many documents makes it, is handed to
several tasks, each with a part of the probes and a copy of the row.  Shards and
parts have a bounded size, so no group grows with the input.

Defined results: a null or empty text is one empty line; keys below the least
length stay wherever they are; a key's lines stay in the smallest document that holds
it, all of them where it has several, and go from all others; rows that repeat an id
are one document for this, each with its own result; a row without an id is no
document that could keep a line and loses what any document with an id holds; ids are
whole numbers; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow import session
from areaflow.llm import texts
from areaflow.llm.perfect_hash import PerfectHash

#: Code points a key needs to be looked for.
LEAST_LENGTH = 10
#: Keys of a shard on average; about 150 kB.
SHARD_KEYS = 8192
#: Probes one task takes of a shard at a time.
PART_PROBES = 65_536

_WHITE = b" \t\n\x0b\x0c\r"
_CONTINUED = bytes(range(0x80, 0xC0))
_ROW = ("doc_id", "text_a", "text_b")
#: Hashed lines sent on at once.
_FLUSH = 1 << 18


def _rows_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, text`` as bytes and two hashes of the text, which tell rows that repeat an id apart."""
    plain = F.coalesce(docs[text], F.lit(""))
    return docs.select(
        docs[doc_id].cast("long").alias("doc_id"), plain.cast("binary").alias("text"),
        F.xxhash64(plain).alias("text_a"), F.xxhash64(F.lit(1), plain).alias("text_b"),
    )


def hashed_lines(docs: DataFrame, least: int = LEAST_LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_a, text_b, line, low, high``: the 128-bit key hash of every line long enough."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in texts.pieces(batches, "text"):
            at: list[int] = []
            numbers: list[int] = []
            digests: list[bytes] = []

            def flush(piece=piece, at=at, numbers=numbers, digests=digests) -> pa.RecordBatch:
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                row = [piece.column(c).take(pa.array(at, pa.int64())) for c in _ROW]
                columns = [*row, pa.array(numbers, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
                for held in (at, numbers, digests):
                    held.clear()
                return pa.RecordBatch.from_arrays(columns, names=[*_ROW, "line", "low", "high"])

            for i, whole in enumerate(piece.column("text").to_pylist()):
                for number, line in enumerate(whole.split(b"\n")):
                    key = line.strip(_WHITE)
                    if len(key) >= least and len(key.translate(None, _CONTINUED)) >= least:
                        at.append(i)
                        numbers.append(number)
                        digests.append(xxhash.xxh3_128_digest(key.lower()))
                        if len(at) >= _FLUSH:
                            yield flush()
            yield flush()

    schema = "doc_id long, text_a long, text_b long, line int, low long, high long"
    return _rows_of(docs, doc_id, text).mapInArrow(task, schema)


def _halves(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return tuple(table.column(c).to_numpy().view(np.uint64) for c in ("low", "high"))


_INDEX = (
    "shard long, n_keys long, sizes array<long>, bits binary, rest binary, fingerprints binary, counts binary, "
    "owners binary"
)
_NO_OWNER = np.iinfo(np.int64).max


def build_index(lines: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """One stored row per shard, and the number of shards; ``lines`` as :func:`hashed_lines` gives them."""
    # a key in very many documents leaves every task as one row
    per_key = lines.groupBy("low", "high").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"),
        F.max(F.col("doc_id").isNull()).alias("nameless"),
    )
    # held by one document however many of its lines, then nobody loses it
    shared = F.col("owner").isNotNull() & ((F.col("last") > F.col("owner")) | F.col("nameless"))
    keys, _ = session.staged(
        per_key.select("low", "high", F.when(shared, F.greatest("n", F.lit(2))).otherwise(1).alias("n"), "owner"), "keys"
    )
    shards = max(1, -(-keys.count() // shard_keys))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        low, high = _halves(table)
        perfect = PerfectHash.build(low, high)
        place = perfect.find(low, high)
        fingerprints, counts = np.zeros(len(low), np.uint32), np.zeros(len(low), np.uint32)
        owners = np.zeros(len(low), np.int64)
        fingerprints[place] = high.astype(np.uint32)
        counts[place] = np.minimum(table.column("n").to_numpy(), np.iinfo(np.uint32).max)
        owners[place] = table.column("owner").fill_null(_NO_OWNER).to_numpy()
        row = {"shard": key[0].as_py(), "n_keys": len(low), **perfect.to_row()}
        row |= {"fingerprints": fingerprints.tobytes(), "counts": counts.tobytes(), "owners": owners.tobytes()}
        fields = pa.schema([("shard", pa.int64()), ("n_keys", pa.int64()), ("sizes", pa.list_(pa.int64()))])
        for name in ("bits", "rest", "fingerprints", "counts", "owners"):
            fields = fields.append(pa.field(name, pa.binary()))
        return pa.Table.from_pylist([row], schema=fields)

    shard = F.pmod("low", F.lit(shards)).alias("shard")
    index, _ = session.staged(keys.select("*", shard).groupBy("shard").applyInArrow(build, _INDEX), "line-index")
    return index, shards


def probe(lines: DataFrame, index: DataFrame, shards: int, part_probes: int = PART_PROBES) -> DataFrame:
    """``doc_id, text_a, text_b, line`` of every line that its document loses by the index."""
    sharded = lines.withColumn("shard", F.pmod("low", F.lit(shards)))
    # one row per ``part_probes`` lines at most, and none where no shard is hot
    hot, _ = session.staged(
        sharded.groupBy("shard").count().filter(F.col("count") > part_probes)
        .select("shard", F.ceil(F.col("count") / part_probes).alias("parts")), "hot-shards"
    )
    parts = F.coalesce("parts", F.lit(1))
    spread = F.pmod(F.xxhash64(*_ROW, "line"), parts).alias("part")
    probes = sharded.join(hot, "shard", "left").select(*_ROW, "line", "low", "high", "shard", spread)
    copies = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part")
    rows = index.join(hot, "shard", "left").select(*index.columns, copies)

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        low, high = _halves(left)
        arrays = {c: right.column(c)[0].as_py() for c in right.column_names} if right.num_rows else None
        if arrays is None:
            return left.select([*_ROW, "line"]).slice(0, 0)
        perfect = PerfectHash.from_row(arrays["sizes"], arrays["bits"], arrays["rest"])
        place = perfect.find(low, high)
        known = place >= 0
        place = np.maximum(place, 0)
        known &= np.frombuffer(arrays["fingerprints"], np.uint32)[place] == high.astype(np.uint32)
        several = np.frombuffer(arrays["counts"], np.uint32)[place] > 1
        owner = np.frombuffer(arrays["owners"], np.int64)[place]
        own = left.column("doc_id").fill_null(_NO_OWNER).to_numpy()
        lost = known & several & (own != owner)
        return left.select([*_ROW, "line"]).filter(pa.array(lost))

    schema = "doc_id long, text_a long, text_b long, line int"
    return probes.groupBy("shard", "part").cogroup(rows.groupBy("shard", "part")).applyInArrow(look, schema)


def drop_shared(
    docs: DataFrame, least: int = LEAST_LENGTH, shard_keys: int = SHARD_KEYS, part_probes: int = PART_PROBES,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` for every row; ``kept`` is the text without the lines it loses."""
    lines, _ = session.staged(hashed_lines(docs, least, doc_id, text), "lines")
    index, shards = build_index(lines, shard_keys)
    lost = probe(lines, index, shards, part_probes)
    # line numbers of one document; a set, as equal rows repeat them
    per_row = lost.groupBy(*_ROW).agg(F.collect_set("line").alias("lost"))
    rows = _rows_of(docs, doc_id, text)
    same = [rows[c].eqNullSafe(per_row[c]) for c in _ROW]
    joined = rows.join(per_row, same, "left").select(rows["doc_id"], rows["text"], per_row["lost"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in texts.pieces(batches, "text"):
            n_lines, n_dropped, kept = [], [], []
            for whole, numbers in zip(piece.column("text").to_pylist(), piece.column("lost").to_pylist(), strict=True):
                gone = set(numbers or ())
                n_lines.append(whole.count(b"\n") + 1)
                n_dropped.append(len(gone))
                if gone:
                    whole = b"\n".join([x for i, x in enumerate(whole.split(b"\n")) if i not in gone])
                kept.append(whole)
            columns = [piece.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            columns.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_dropped", "kept"])

    found = joined.mapInArrow(task, "doc_id long, n_lines long, n_dropped long, kept binary")
    return found.withColumn("kept", F.col("kept").cast("string"))
