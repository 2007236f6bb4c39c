"""Quality score by a byte-level convolutional network.

Filters of six bytes slide over a text cut into overlapping chunks that cover it
whole.  A chunk is the maximum of each filter over its places; a text is the mean
and the maximum of its chunks, and how full its first chunk is, which one hidden
layer turns into a probability.
Max-pooling sees what occurs in a chunk and, by low maxima, how little does,
which betrays repetition.  The network is trained in numpy on the driver from a
bounded sample of labelled rows, whose whole texts it sees in the chunks that
scoring uses; scoring runs in tasks over whole texts.  There a filter is three
lookups of byte pairs, so no multiplication is left.

Defined results: null and empty texts have no chunk and get the score of zero
features; texts shorter than a filter are padded; rows are independent, so
repeated rows give repeated results; an empty table gives no rows; without
labelled rows every score is 0.5; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow.llm import texts

#: Labelled rows the network is fitted on at most, and the bytes of their texts: rows are taken whole, in
#: the order of a hash of the id, until the next one would pass the bytes.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 64 << 20

FILTERS, WIDTH, HIDDEN = 24, 6, 24
#: Mean and maximum over the chunks, and how full the first chunk is.
POOLED = 2 * FILTERS + 1
CHUNK, STEP = 512, 384
#: A row with at least this score is taken as good.
THRESHOLD = 0.3

_STEPS, _DOCS, _RATE = 800, 32, 0.01


@dataclass
class Network:
    """``taps``: one table per place in a filter, a row for each byte and one, zero, for padding."""

    taps: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        layer = np.maximum(pooled @ self.hidden + self.hidden_bias, 0)
        return 1 / (1 + np.exp(-(layer @ self.out + self.out_bias)))


def _starts(size: int) -> range:
    """Where the chunks of a text of so many bytes begin."""
    return range(0, max(1, size - CHUNK + STEP), STEP) if size else range(0)


def _chunk_rows(text: bytes) -> np.ndarray:
    """A text's chunks, one to a row, filled up with 256."""
    data = np.frombuffer(text, dtype=np.uint8)
    rows = np.full((len(_starts(len(data))), CHUNK), 256, dtype=np.uint16)
    for row, start in zip(rows, _starts(len(data)), strict=True):
        own = data[start : start + CHUNK]
        row[: len(own)] = own
    return rows


def fit(samples: list[tuple[bytes, int]], seed: int = 7) -> Network:
    """Adam on the cross-entropy of (a whole text, 0 or 1)."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.3, (WIDTH, 257, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.3, (POOLED, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
        rng.normal(0, 0.3, HIDDEN).astype(np.float32), 0.0,
    )
    net.taps[:, 256] = 0
    if not samples:
        net.out[:] = 0
        return net
    labels = np.array([y for _, y in samples], dtype=np.float32)
    good, poor = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    names = ("taps", "bias", "hidden", "hidden_bias", "out", "out_bias")
    first = {n: np.zeros_like(getattr(net, n), dtype=np.float32) for n in names}
    second = {n: np.zeros_like(getattr(net, n), dtype=np.float32) for n in names}
    for step in range(1, _STEPS + 1):
        # a third of each batch is poor, where there are any of both kinds
        if len(good) and len(poor):
            chosen = np.r_[rng.choice(poor, _DOCS // 3), rng.choice(good, _DOCS - _DOCS // 3)]
        else:
            chosen = rng.integers(0, len(labels), _DOCS)
        grads = _gradients(net, [_chunk_rows(samples[i][0]) for i in chosen], labels[chosen])
        for n in names:
            first[n] = 0.9 * first[n] + 0.1 * grads[n]
            second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
            rate = _RATE * min(1.0, 2.0 - 2.0 * step / (_STEPS + 1))
            change = rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
            setattr(net, n, getattr(net, n) - change.astype(np.float32))
        net.taps[:, 256] = 0
    net.out_bias = float(net.out_bias)
    return net


def _tops(net: Network, chunks: np.ndarray, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """For each chunk and filter the place with the largest answer, and that answer with its bias."""
    places = CHUNK - WIDTH + 1
    at = np.zeros((len(chunks), FILTERS), np.int64)
    top = np.zeros((len(chunks), FILTERS), np.float32)
    for first in range(0, len(chunks), block):
        part = chunks[first : first + block]
        answers = net.taps[0][part[:, :places]]
        for j in range(1, WIDTH):
            answers += net.taps[j][part[:, j : j + places]]
        # a filter lies wholly inside its chunk; one in a shorter chunk has the first place only
        whole = np.maximum((part < 256).sum(axis=1) - WIDTH + 1, 1)
        answers[np.arange(places)[None, :] >= whole[:, None]] = -np.inf
        own = answers.argmax(axis=1)
        at[first : first + block] = own
        top[first : first + block] = np.take_along_axis(answers, own[:, None], axis=1)[:, 0]
    return at, top + net.bias


def _gradients(net: Network, docs: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    sizes = np.array([len(d) for d in docs])
    chunks = np.concatenate(docs)
    owner = np.repeat(np.arange(len(docs)), sizes)
    at, top = _tops(net, chunks)
    active = np.maximum(top, 0)
    mean = np.zeros((len(docs), FILTERS), np.float32)
    np.add.at(mean, owner, active)
    mean /= np.maximum(sizes, 1)[:, None]
    most = np.zeros((len(docs), FILTERS), np.float32)
    np.maximum.at(most, owner, active)
    full = np.array([(d[0] < 256).mean() if len(d) else 0 for d in docs], np.float32)
    pooled = np.concatenate([mean, most, full[:, None]], axis=1)
    raw = pooled @ net.hidden + net.hidden_bias
    layer = np.maximum(raw, 0)
    score = 1 / (1 + np.exp(-(layer @ net.out + net.out_bias)))
    back = (score - labels) / len(docs)
    d_layer = np.outer(back, net.out) * (raw > 0)
    d_pooled = d_layer @ net.hidden.T
    d_active = d_pooled[owner, :FILTERS] / np.maximum(sizes, 1)[owner, None]
    d_active = d_active + d_pooled[owner, FILTERS : 2 * FILTERS] * (active == most[owner])
    d_top = np.where(top > 0, d_active, 0).astype(np.float32)
    taps = np.zeros_like(net.taps)
    n, f = np.nonzero(d_top)
    for j in range(WIDTH):
        np.add.at(taps[j], (chunks[n, at[n, f] + j], f), d_top[n, f])
    return {
        "taps": taps, "bias": d_top.sum(axis=0), "hidden": pooled.T @ d_layer, "hidden_bias": d_layer.sum(axis=0),
        "out": layer.T @ back, "out_bias": np.float32(back.sum()),
    }


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    fold: Column | None = None, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES,
) -> Network:
    """Fit on the whole texts of at most ``rows`` labelled rows, and ``size`` bytes, where ``fold`` holds."""
    marked = labels.select(labels[doc_id].alias("doc_id"), labels[label].cast("int").alias("label"))
    marked = marked.filter("doc_id IS NOT NULL AND label IN (0, 1)")
    if fold is not None:
        marked = marked.filter(fold)
    order = [F.xxhash64("doc_id"), "doc_id", "label"]
    chosen = marked.orderBy(*order).limit(rows)
    own = docs.select(docs[doc_id].alias("doc_id"), F.encode(F.coalesce(docs[text], F.lit("")), "UTF-8").alias("text"))
    # the chosen rows are bounded by a parameter, so sending them to every task is safe
    found = own.join(F.broadcast(chosen), "doc_id")
    # rows that repeat an id may be many; the first ones do, by length and hash before their texts move
    by = [*order, F.col("n"), F.col("h")]
    sized = found.select("doc_id", "label", F.length("text").alias("n"), F.xxhash64("text").alias("h"))
    taken, total = [], 0
    for row in sized.orderBy(*by).limit(rows).collect():
        total += row["n"]
        if total > size:
            break
        taken.append(row)
    if not taken:
        return fit([])
    keys = docs.sparkSession.createDataFrame([(r["doc_id"], r["label"], r["h"]) for r in taken], (
        sized.select("doc_id", "label", "h").schema
    )).distinct()
    texts_of = found.withColumn("h", F.xxhash64("text")).join(F.broadcast(keys), ["doc_id", "label", "h"])
    sample = texts_of.dropDuplicates(["doc_id", "label", "h"]).collect()
    held = {(r["doc_id"], r["label"], r["h"]): bytes(r["text"]) for r in sample}
    return fit([(held[r["doc_id"], r["label"], r["h"]], r["label"]) for r in taken])


class Scorer:
    """Made once in each task: filters as tables over byte pairs."""

    #: Bytes convolved at once.
    BLOCK = 1 << 18

    def __init__(self, net: Network):
        self.net = net
        taps = net.taps[:, :256]
        self.pairs = [
            (taps[j][:, None] + taps[j + 1][None, :]).reshape(65536, FILTERS).copy() for j in range(0, WIDTH, 2)
        ]

    def answers(self, data: np.ndarray) -> np.ndarray:
        """Filter answers at the places of ``data``; the last ``WIDTH - 1`` bytes only lend context."""
        pair = (data[:-1].astype(np.intp) << 8) | data[1:]
        n = len(data) - WIDTH + 1
        total = self.pairs[0].take(pair[:n], axis=0)
        for k in range(1, len(self.pairs)):
            total += self.pairs[k].take(pair[2 * k : 2 * k + n], axis=0)
        return total

    def pooled(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Mean and maximum over each text's chunks of their filters' maxima."""
        result = np.zeros((len(begins) - 1, POOLED), np.float32)
        result[:, -1] = np.minimum(np.diff(begins), CHUNK) / CHUNK
        block = 0
        starts, stops, owner = [], [], []
        for i, (a, b) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)):
            if 0 < b - a < WIDTH:
                result[i, :-1] = np.tile(self._short(data[a:b]), 2)
            elif b > a:
                own = [a + s for s in _starts(b - a)]
                starts += own
                stops += [min(s + CHUNK, b) - WIDTH + 1 for s in own]
                owner += [i] * len(own)
        if not starts:
            return result
        starts, stops, owner = np.array(starts), np.array(stops), np.array(owner)
        tops = np.empty((len(starts), FILTERS), np.float32)
        while block < len(starts):
            upto = max(block + 1, int(np.searchsorted(stops, starts[block] + self.BLOCK)))
            base = starts[block]
            found = self.answers(data[base : stops[upto - 1] + WIDTH - 1])
            edges = np.stack([starts[block:upto], stops[block:upto]], axis=1).ravel() - base
            # a last stop at the very end is no place of the array; the chunk then ends there by itself
            tops[block:upto] = np.maximum.reduceat(found, edges[:-1], axis=0)[::2]
            block = upto
        tops = np.maximum(tops + self.net.bias, 0)
        cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        docs = owner[cuts]
        counts = np.diff(np.r_[cuts, len(owner)])
        result[docs, :FILTERS] = np.add.reduceat(tops, cuts, axis=0) / counts[:, None]
        result[docs, FILTERS : 2 * FILTERS] = np.maximum.reduceat(tops, cuts, axis=0)
        return result

    def _short(self, own: np.ndarray) -> np.ndarray:
        answer = sum(self.net.taps[j][b] for j, b in enumerate(own.tolist()))
        return np.maximum(answer + self.net.bias, 0)

    def scores(self, column: pa.Array) -> np.ndarray:
        return self.net.probability(self.pooled(*texts.raw_bytes(column))).astype(np.float64)


def score(docs: DataFrame, net: Network, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id and ``score``."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for piece in texts.pieces(batches, "text"):
            scores = pa.array(scorer.scores(piece.column("text")))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), scores], names=["doc_id", "score"])

    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return narrow.mapInArrow(task, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, net: Network, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least ``threshold``, with all their columns."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for piece in texts.pieces(batches, text):
            yield piece.filter(pa.array(scorer.scores(piece.column(text)) >= threshold))

    return docs.mapInArrow(task, docs.schema)
