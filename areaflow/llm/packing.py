"""First-fit decreasing into sequences of bounded length, group by group.

Documents become token ids once; a document is cut at multiples of the sequence
length.  The pieces, a few numbers each, are dealt into randomised groups of
bounded size.  Inside a group pieces go, longest first, into the first sequence
with room, found by descending a tournament tree whose inner nodes hold the
largest free room below them.  Groups are independent, so any number of tasks
packs at once and only piece sizes are shuffled.

Defined results: a null text is a document of the end id alone; an empty table
gives no rows; a text of any length becomes as many pieces as it needs; pieces
of equal length are taken by document and start; repeated rows are documents of
their own; other columns are not read.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow import session
from areaflow.llm import texts

#: Tokens of a sequence.
LENGTH = 1024
#: Pieces of a group on average.  Waste falls with the size, a few thousand leave next to none.
GROUP_PIECES = 8192
END_ID = 0


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a public byte-level vocabulary: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def read_added(ranks_path: str) -> dict[str, int]:
    """Added tokens of the ``tokenizers`` file beside the ranks, which that library finds in any text."""
    path = ranks_path.removesuffix(".tiktoken") + ".json"
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"added tokens that look at their neighbours are not supported: {path}")
    return {t["content"]: t["id"] for t in added}


def pieces(
    docs: DataFrame, ranks_path: str, pattern: str, length: int = LENGTH, keep_ids: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Token pieces of every document: ``doc_id, start, length, ids_crc32, doc_tokens``, and ``ids`` if kept.

    ``salt`` numbers the rows of a task, so that even repeated rows spread over groups.
    The vocabulary has a fixed size and travels with the broadcast below.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), read_added(ranks_path)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks, added = shared.value
        encoding = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
        salt = 0
        for piece in texts.pieces(batches, "text"):
            rows: dict[str, list] = {n: [] for n in ("at", "start", "length", "ids_crc32", "doc_tokens", "ids")}
            for i, s in enumerate(texts.strings(piece.column("text"))):
                ids = np.append(encoding.encode_to_numpy(s, allowed_special="all"), END_ID).astype("<u4")
                for start in range(0, len(ids), length):
                    own = ids[start : start + length]
                    rows["at"].append(i)
                    rows["start"].append(start)
                    rows["length"].append(len(own))
                    rows["ids_crc32"].append(zlib.crc32(own.tobytes()))
                    rows["doc_tokens"].append(len(ids))
                    if keep_ids:
                        rows["ids"].append(own.astype(np.int32))
            n = len(rows["at"])
            columns = [piece.column("doc_id").take(pa.array(rows["at"], pa.int64()))]
            columns += [pa.array(rows[k], pa.int64()) for k in ("start", "length", "ids_crc32", "doc_tokens")]
            columns.append(pa.array(np.arange(salt, salt + n, dtype=np.int64)))
            salt += n
            if keep_ids:
                columns.append(pa.array(rows["ids"], pa.list_(pa.int32())))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"] + ["ids"] * keep_ids
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, salt long"
    schema += ", ids array<int>" if keep_ids else ""
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(task, schema)


class Tournament:
    """Free room of up to ``bins`` sequences; finds the first with enough of it in log time."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """The first bin with room for ``size``, and its room before."""
        most, node = self.most, 1
        while node < self.leaves:
            node *= 2
            if most[node] < size:
                node += 1
        room = most[node]
        place = node - self.leaves
        most[node] = room - size
        node //= 2
        while node:
            left, right = most[2 * node], most[2 * node + 1]
            most[node] = left if left >= right else right
            node //= 2
        return place, room


def first_fit(sizes: list[int], length: int) -> tuple[list[int], list[int]]:
    """For sizes in decreasing order: the bin of each and its offset there."""
    tree = Tournament(len(sizes), length)
    bins, offsets = [], []
    for size in sizes:
        place, room = tree.place(size)
        bins.append(place)
        offsets.append(length - room)
    return bins, offsets


def assign(cut: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces; ``salt`` goes."""
    groups = max(1, -(-cut.count() // group_pieces))
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "salt"), F.lit(groups)))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "salt"], ascending=[False, True, True, True])
        bins, offsets = first_fit(group["length"].tolist(), length)
        group["sequence_id"] = (group["part"].to_numpy(np.int64) << 32) + np.array(bins, dtype=np.int64)
        group["offset"] = np.array(offsets, dtype=np.int64)
        return group.drop(columns=["part", "salt"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema if f.name != "salt"]
    return dealt.groupBy("part").applyInPandas(pack, ", ".join([*kept, "sequence_id long", "offset long"]))


def pack(docs: DataFrame, ranks_path: str, pattern: str, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """All pieces of all documents with their place in a sequence."""
    cut, _ = session.staged(pieces(docs, ranks_path, pattern, length, keep_ids), "pieces")
    return assign(cut, length)


def sequences(packed: DataFrame) -> DataFrame:
    """Real sequences from pieces that kept their ids; a sequence holds at most the sequence length."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
