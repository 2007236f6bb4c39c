r"""Two tokenizations of one text, aligned where tokens of both end together.

Byte offsets at which tokens of both vocabularies end are cuts.  They are found by
divide and conquer: an interval of tokens looks for a common end near its middle, one
bisect per place tried, and splits there into halves that go on by themselves; an
interval without a cut is a leaf, one group.  All intervals of a piece of text take
the same step at once.  Tokens that end at a cut are linked; how often the corpus links a
pair of ids tells how sure a link is.

Every text is encoded once.  What a document needs later, its distinct pairs and how
often it has each, is stored beside its figures.  The pairs most common in the corpus, at
most ``HOT_PAIRS`` of them, travel to the stored documents; only pairs rarer than
these are joined, so no join key holds more than a sliver of the rows.

Defined results: a text that is null or empty, or whose tokens' joined bytes are not
a space and the text, has no tokens: zeros and an empty list of groups; rows that repeat an
id are documents of their own and count each; an empty table gives no rows; a text
of any length is aligned whole; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow import session
from areaflow.llm import texts

#: Pairs that travel to the documents: 3 MB.
HOT_PAIRS = 1 << 18
#: Bytes of text aligned at once.
PIECE = 1 << 19


class ByteVocabulary:
    """A byte-level vocabulary from its rank file; the same ids as its ``tokenizers`` file with special tokens as text."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.pattern = pattern
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token

    def encoder(self):
        import tiktoken

        encoding = tiktoken.Encoding("byte", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
        return lambda found: [encoding.encode_to_numpy(" " + t, disallowed_special=()) for t in found]


class PieceVocabulary:
    """A ``sentencepiece`` model; its pieces as bytes."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            self.model = file.read()
        found = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        self.tokens = [
            bytes([int(piece[3:5], 16)]) if found.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, found.id_to_piece(i)) for i in range(found.get_piece_size()))
        ]

    def encoder(self):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        return lambda found: [np.array(x, np.uint32) for x in processor.encode(found, num_threads=1)]


def cuts(a: np.ndarray, b: np.ndarray, a_starts: np.ndarray, b_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of two ascending lists of ends end together, as two lists of places.

    Interval ``d`` of the first list is ``a_starts[d]`` up to ``a_starts[d + 1]``, and
    likewise of the second; the last ends of both are equal.
    """
    low_a, high_a, low_b, high_b = a_starts[:-1], a_starts[1:] - 1, b_starts[:-1], b_starts[1:] - 1
    found_a, found_b = [high_a], [high_b]
    while True:
        # the last end of an interval is a cut already; one without further ends on either side is a leaf
        open_ = (high_a > low_a) & (high_b > low_b)
        low_a, high_a, low_b, high_b = low_a[open_], high_a[open_], low_b[open_], high_b[open_]
        if not len(low_a):
            break
        middle = (low_a + high_a - 1) >> 1
        cut_a = np.full(len(middle), -1)
        cut_b = np.full(len(middle), -1)
        pending = np.arange(len(middle))
        away = 0
        while len(pending):
            for place in (middle[pending] + away, middle[pending] - away)[: 1 if away == 0 else 2]:
                inside = (place >= low_a[pending]) & (place < high_a[pending]) & (cut_a[pending] < 0)
                tried, at = pending[inside], place[inside]
                other = np.searchsorted(b, a[at])
                hit = b[other] == a[at]
                cut_a[tried[hit]], cut_b[tried[hit]] = at[hit], other[hit]
            away += 1
            more = (middle[pending] + away < high_a[pending]) | (middle[pending] - away >= low_a[pending])
            pending = pending[(cut_a[pending] < 0) & more]
        split = cut_a >= 0
        cut_a, cut_b = cut_a[split], cut_b[split]
        found_a.append(cut_a)
        found_b.append(cut_b)
        # both halves, side by side, so that the next bisects go through the list in order
        low_a = np.stack([low_a[split], cut_a + 1], axis=1).ravel()
        high_a = np.stack([cut_a, high_a[split]], axis=1).ravel()
        low_b = np.stack([low_b[split], cut_b + 1], axis=1).ravel()
        high_b = np.stack([cut_b, high_b[split]], axis=1).ravel()
    return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))


class Aligner:
    """Both vocabularies and what alignment looks up in them; travels with a broadcast of a fixed size."""

    def __init__(self, first, second):
        self.first, self.second = first, second
        self.n_second = len(second.tokens)

    def tables(self) -> None:
        """Lookups built inside a task."""
        if hasattr(self, "lengths"):
            return
        self.lengths = [np.array([len(t) for t in v.tokens], np.int64) for v in (self.first, self.second)]
        self.encoders = [self.first.encoder(), self.second.encoder()]
        self.n_first = len(self.first.tokens)
        digits = [str(i) for i in range(max(self.n_first, self.n_second))]
        # an id with what follows it: inside its side, at the side's end, inside and at the end of the other side
        self.written = [
            d + after
            for after, n in ((",", self.n_first), ("|", self.n_first), (",", self.n_second), (";", self.n_second))
            for d in digits[:n]
        ]

    def encode(self, found: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids by both, empty for texts without tokens."""
        read = [t.decode("utf-8", "replace") for t in found]
        none = np.zeros(0, np.uint32)
        first, second = (encoder(read) for encoder in self.encoders)
        for i, text in enumerate(found):
            spaced = b" " + text
            sizes = [int(lengths[ids].sum()) for lengths, ids in zip(self.lengths, (first[i], second[i]), strict=True)]
            if not text or sizes != [len(spaced)] * 2 or not self._writes(first[i], second[i], spaced):
                first[i] = second[i] = none
        return first, second

    def _writes(self, first: np.ndarray, second: np.ndarray, spaced: bytes) -> bool:
        """Whether both join to the text; byte-level ids of equal length always do."""
        sides = [(self.second, second)] + [(self.first, first)] * (not isinstance(self.first, ByteVocabulary))
        return all(b"".join(map(v.tokens.__getitem__, ids.tolist())) == spaced for v, ids in sides)

    def align(self, found: list[bytes]) -> dict[str, list | np.ndarray]:
        """Figures, groups and distinct linked pairs of each text."""
        self.tables()
        first, second = self.encode(found)
        counts = [np.array([len(x) for x in side], np.int64) for side in (first, second)]
        some = counts[0] > 0
        ids = [np.concatenate([*side, np.zeros(0, np.uint32)]).astype(np.int64) for side in (first, second)]
        starts = [np.r_[0, np.cumsum(n[some])] for n in counts]
        ends = [np.cumsum(lengths[i]) for lengths, i in zip(self.lengths, ids, strict=True)]
        last_a, last_b = cuts(ends[0], ends[1], starts[0], starts[1])
        # cuts of each text
        until = np.searchsorted(last_a, starts[0][1:])
        n_groups = np.zeros(len(found), np.int64)
        n_groups[some] = np.diff(np.r_[0, until])
        groups = [""] * len(found)
        for i, text in zip(np.flatnonzero(some).tolist(), self._written(ids, last_a, last_b, starts), strict=True):
            groups[i] = text
        pair = ids[0][last_a] * self.n_second + ids[1][last_b]
        span = self.n_first * self.n_second
        keys, times = np.unique(np.repeat(np.arange(len(found)), n_groups) * span + pair, return_counts=True)
        return {
            "n_a": counts[0], "n_b": counts[1], "n_groups": n_groups, "n_links": n_groups, "groups": groups,
            "pairs": keys % span, "times": times, "pair_starts": np.searchsorted(keys, np.arange(len(found) + 1) * span),
        }

    def _written(self, ids, last_a, last_b, starts) -> Iterator[str]:
        """The groups of each text with tokens: ids of both sides in order."""
        ends_a, ends_b = np.zeros(len(ids[0]), np.int64), np.zeros(len(ids[1]), np.int64)
        ends_a[last_a] = 1
        ends_b[last_b] = 1
        # a token stands behind its side and behind the other side's tokens of earlier groups, or of its own
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        before = np.r_[0, last_b + 1]
        order = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        order[np.arange(len(ids[0])) + before[group_a]] = ids[0] + ends_a * self.n_first
        order[np.arange(len(ids[1])) + last_a[group_b] + 1] = ids[1] + 2 * self.n_first + ends_b * self.n_second
        both = starts[0] + starts[1]
        get = self.written.__getitem__
        for low, high in zip(both[:-1].tolist(), both[1:].tolist(), strict=True):
            yield "".join(map(get, order[low:high].tolist()))[:-1]


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))


def aligned(docs: DataFrame, first, second, digest=None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times`` of every document.

    ``groups`` writes the ids of each group as ``a1,a2|b1;a3|b2,b3``, or what ``digest``
    makes of that.  ``pairs`` are distinct linked ids, the first times the size of the second
    vocabulary plus the second.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(Aligner(first, second))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = shared.value
        for piece in texts.pieces(batches, "text", PIECE):
            found = aligner.align(piece.column("text").to_pylist())
            groups = [digest(g) for g in found["groups"]] if digest else found["groups"]
            figures = [pa.array(found[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
            starts = found["pair_starts"]
            lists = [_lists(found["pairs"], starts, pa.int64()), _lists(found["times"], starts, pa.int32())]
            columns = [piece.column("row"), piece.column("doc_id"), *figures, pa.array(groups, pa.string()), *lists]
            names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, "
        "pairs array<long>, times array<int>"
    )
    plain = F.coalesce(docs[text], F.lit("")).cast("binary").alias("text")
    return docs.select(F.monotonically_increasing_id().alias("row"), docs[doc_id].alias("doc_id"), plain).mapInArrow(task, schema)


def pair_counts(stored: DataFrame, n_second: int) -> DataFrame:
    """``pair, links, best`` of every pair the corpus links; ``best`` where no other first id has more links with its second."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
            if len(pairs):
                order = np.argsort(pairs, kind="stable")
                own, first = np.unique(pairs[order], return_index=True)
                totals = np.add.reduceat(times[order].astype(np.int64), first)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(totals)], names=["pair", "links"])

    parts = stored.select("pairs", "times").mapInArrow(task, "pair long, links long")
    counted, _ = session.staged(parts.groupBy("pair").agg(F.sum("links").alias("links")), "pairs")
    second = F.pmod("pair", F.lit(n_second))
    # one row per id of the second vocabulary, whose size is fixed
    most = counted.groupBy(second.alias("_second")).agg(F.max("links").alias("_most"))
    return counted.join(most, second == F.col("_second")).select("pair", "links", (F.col("links") == F.col("_most")).alias("best"))


def _common(pairs: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs with at least so many links that no more than ``most`` have them."""
    power = F.floor(F.log2(F.col("links").cast("double"))).cast("int").alias("power")
    total, least = 0, None
    # at most 64 rows
    for row in pairs.groupBy(power).count().orderBy(F.col("power").desc()).collect():
        total += row["count"]
        if total > most:
            break
        least = 1 << row["power"]
    hot = pairs.limit(0) if least is None else pairs.filter(F.col("links") >= least)
    found = hot.toArrow().combine_chunks()
    pair, links, best = (found.column(c).to_numpy() for c in ("pair", "links", "best"))
    order = np.argsort(pair)
    return pair[order].astype(np.int64), links[order].astype(np.int64), best[order].astype(bool)


def with_link_counts(stored: DataFrame, n_second: int, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Replaces ``pairs`` and ``times`` of stored documents by ``n_best`` and ``count_sum``."""
    pairs, _ = session.staged(pair_counts(stored, n_second), "pair-counts")
    shared = stored.sparkSession.sparkContext.broadcast(_common(pairs, hot_pairs))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, links, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            own, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            sizes = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.searchsorted(hot, own)
            at[at == len(hot)] = 0
            known = hot[at] == own if len(hot) else np.zeros(len(own), bool)
            if len(hot):
                sums, bests = times * links[at] * known, times * best[at] * known
            else:
                sums = bests = np.zeros(len(own), np.int64)
            totals = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(totals[0], row, sums)
            np.add.at(totals[1], row, bests)
            rare = np.bincount(row[~known], minlength=batch.num_rows)
            starts = np.r_[0, np.cumsum(rare)]
            kept = [batch.column(c) for c in names]
            columns = [*kept, pa.array(totals[1]), pa.array(totals[0])]
            columns += [_lists(own[~known], starts, pa.int64()), _lists(times[~known], starts, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_best", "count_sum", "pairs", "times"])

    names = [f.name for f in stored.schema if f.name not in ("pairs", "times")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema if f.name in names)
    schema = f"{kinds}, n_best long, count_sum long, pairs array<long>, times array<int>"
    summed, _ = session.staged(stored.mapInArrow(task, schema), "summed")
    rare = summed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    times = F.col("times").cast("long")
    rest = (
        rare.join(pairs, F.col("pairs") == F.col("pair"))
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), times).otherwise(0)).alias("_best"), F.sum(times * F.col("links")).alias("_sum"))
    )
    return summed.join(rest, "row", "left").select(
        *names[1:],
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
    )


def align(
    docs: DataFrame, first, second, digest=None, hot_pairs: int = HOT_PAIRS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum`` of every document."""
    stored, _ = session.staged(aligned(docs, first, second, digest, doc_id, text), "aligned")
    return with_link_counts(stored, len(second.tokens), hot_pairs)
