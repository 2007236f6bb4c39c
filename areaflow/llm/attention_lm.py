"""Log-probability of texts under a causal self-attention model on subword ids.

A text is its lower-cased words and one end.  The base model is the smoothed
unigram model of words, counted over all training texts.  The attention model
predicts subword ids: from the ids before, one attention layer and one hidden
layer give a distribution over classes; an id belongs to several classes in parts,
and inside a class it has its share of all training texts' ids.  Layers and parts
start from a fit on a bounded sample and are then trained on every training text:
each task goes over all windows of its texts, and the tasks' layers are averaged,
an id's row by how often the task met the id.  Parts are summed over all texts,
and the counts come from the whole corpus.  Scoring cuts a document's ids
into windows that overlap by the context, each id being scored once, with batched
masked attention over many windows at a time.

Word counts are added up per task, then by word.  Scoring carries the logarithms
of the most frequent words, a bounded number, and joins all other words with the
counts, so no table of all words has to fit anywhere.

Defined results: a null text is an empty one, whose only token is the end; rows
are independent, so repeated rows give repeated results, also with repeated or
null ids; without training texts N and V are 0; an empty table gives no rows;
other columns are not read.  ``score`` depends on how the training texts are dealt
to tasks; the other columns do not.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow import session
from areaflow.llm import texts

#: Frequent words whose logarithms travel with the scoring tasks, at most.
WORDS = 1 << 18
#: Training texts that give the layers their starting values at most, and characters taken from each.
SAMPLE_ROWS, SAMPLE_CHARS = 2000, 2400
#: Words of training texts for each task of the pass over all of them, about.
TASK_WORDS = 3_000_000

CLASSES, WIDTH, HIDDEN = 40, 16, 24
#: Ids scored in a window, and ids before them that it also sees.
SCORED, CONTEXT = 24, 8
_SPAN = SCORED + CONTEXT

_STEPS, _BATCH, _RATE = 800, 128, 0.01
#: Steps between two looks at which class explains which id.
_REFRESH = 25
#: Exponents are held below what single precision can take; the result stays a distribution.
_LIMIT = np.float32(40)
#: Windows in one matrix product.
_GROUP = 8
_SMOOTH = 0.1
#: The pass over all texts: its rate at the start, steps after which that has halved, ids in a row of sums.
_PASS_RATE, _PASS_HALF, _BLOCK_IDS = 0.003, 300, 16


def words_of(text: str) -> list[bytes]:
    """ASCII letters lower-cased, cut at ASCII white space: exactly what bytes do by themselves."""
    return text.encode().lower().split()


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, n`` over all texts; a task sends each of its words once per half a million distinct ones."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            whole = pa.RecordBatch.from_arrays(columns, names=["word", "n"])
            for at in range(0, whole.num_rows, 50_000):
                yield whole.slice(at, 50_000)

        for piece in texts.pieces(batches, "text"):
            for s in texts.strings(piece.column("text")):
                counts.update(words_of(s))
            if len(counts) > 500_000:
                yield from out()
                counts.clear()
        yield from out()

    narrow = docs.select(docs[text].alias("text"))
    return narrow.mapInArrow(task, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Remembered(dict):
    """Words and their ids as 32-bit numbers, encoded when first asked for; forgets all when full."""

    KEPT = 200_000

    def __init__(self, encoding):
        self.encoding = encoding

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.KEPT:
            self.clear()
        ids = self.encoding.encode_ordinary(" " + word.decode())
        found = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = found
        return found


class Subwords:
    """Ids of words by a public rank file; a word is encoded with the space before it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.encoding = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.size = self.end + 1
        self.known = Remembered(self.encoding)

    def ids(self, word: bytes) -> bytes:
        """The word's ids as 32-bit numbers."""
        return self.known[word]

    def document(self, words: list[bytes]) -> np.ndarray:
        joined = b"".join(map(self.known.__getitem__, words))
        return np.r_[np.frombuffer(joined, "<u4").astype(np.int32), np.int32(self.end)]


def count_ids(words: DataFrame, ranks: dict[bytes, int], pattern: str) -> np.ndarray:
    """How often each id occurs in texts with these word counts; the vocabulary bounds what the driver gets."""
    shared = words.sparkSession.sparkContext.broadcast(ranks)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = Subwords(shared.value, pattern)
        total = np.zeros(subwords.size)
        for batch in batches:
            n = batch.column("n").to_numpy()
            own = [np.frombuffer(subwords.ids(w), "<u4") for w in batch.column("word").to_pylist()]
            if own:
                ids = np.concatenate(own).astype(np.int64)
                total += np.bincount(ids, weights=np.repeat(n, [len(x) for x in own]), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "n"])

    found = words.mapInArrow(task, "id long, n double").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(max(ranks.values()) + 2)
    counts[found["id"].to_numpy(np.int64)] = found["n"]
    return counts


def _classes(sample: list[np.ndarray], size: int, seed: int = 3) -> np.ndarray:
    """A class for every id: the sample's frequent ids by the company they keep, all others together."""
    flat = np.concatenate(sample)
    counts = np.bincount(flat, minlength=size)
    top = np.argsort(-counts, kind="stable")[:4096]
    top = top[counts[top] > 1]
    place = np.full(size, -1)
    place[top] = np.arange(len(top))
    result = np.full(size, CLASSES - 1)
    if len(top) < CLASSES:
        return result
    leads = min(256, len(top))
    table = np.zeros((len(top), 2 * leads))
    before, after = place[flat[:-1]], place[flat[1:]]
    both = (before >= 0) & (after >= 0)
    known = both & (before < leads)
    np.add.at(table, (after[known], before[known]), 1)
    known = both & (after < leads)
    np.add.at(table, (before[known], leads + after[known]), 1)
    table = np.sqrt(table / np.maximum(table.sum(axis=1, keepdims=True), 1))
    _, axes = np.linalg.eigh(table.T @ table)
    points = table @ axes[:, -16:]
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), CLASSES - 1, replace=False)]
    for _ in range(20):
        nearest = ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        for k in range(CLASSES - 1):
            if (nearest == k).any():
                centres[k] = points[nearest == k].mean(axis=0)
    result[top] = nearest
    return result


@dataclass
class Layers:
    """``emb``, ``pos``: ids and places; ``wq`` to ``wo``: attention; the rest: hidden and class layer."""

    emb: np.ndarray
    pos: np.ndarray
    wq: np.ndarray
    wk: np.ndarray
    wv: np.ndarray
    wo: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    w3: np.ndarray
    b3: np.ndarray


#: A scored place sees itself and everything before it in its window.
_VISIBLE = (np.arange(_SPAN)[None, :] <= np.arange(CONTEXT, _SPAN)[:, None]).astype(np.float32)


def cut(ids: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of inputs, ``-1`` where there is none, and of targets for the scored places.

    The input of a place is the id before it, the end for the first.
    """
    sizes = np.array([len(x) for x in ids])
    counts = -(-sizes // SCORED)
    begin = np.repeat(np.cumsum(sizes) - sizes, counts)
    stop = begin + np.repeat(sizes, counts)
    number = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = np.concatenate(ids)
    inputs = np.r_[np.int32(end), flat[:-1]]
    inputs[np.cumsum(sizes)[:-1]] = end
    at = (begin + number * SCORED - CONTEXT)[:, None] + np.arange(_SPAN)
    inside = (at >= begin[:, None]) & (at < stop[:, None])
    safe = np.clip(at, 0, len(flat) - 1)
    return np.where(inside, inputs[safe], -1), np.where(inside, flat[safe], -1)[:, CONTEXT:]


def _grouped(x: np.ndarray) -> np.ndarray:
    """Windows' rows in matrices of a few windows each: small enough for one processor and its cache."""
    return x.reshape(len(x) // _GROUP if len(x) % _GROUP == 0 else 1, -1, x.shape[-1])


def _through(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (_grouped(x) @ w).reshape(*x.shape[:-1], w.shape[-1])


def _over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of the columns, summed over all rows."""
    return (_grouped(a).transpose(0, 2, 1) @ _grouped(b)).sum(axis=0)


def _total(x: np.ndarray) -> np.ndarray:
    """Sums of the columns over all rows."""
    rows = _grouped(x)
    return (np.ones(rows.shape[1], x.dtype) @ rows).sum(axis=0)


def _in_order(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in rising order, and where each was."""
    n = max(1, len(places))
    return np.divmod(np.sort(places.astype(np.int64) * n + np.arange(len(places))), n)


def _summed(places: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each number once, and its rows' sum; the numbers are in order."""
    last = np.flatnonzero(np.r_[places[1:] != places[:-1], True][: len(places)])
    sums = np.cumsum(rows, axis=0, dtype=np.float64).take(last, axis=0)
    return places[last], np.diff(sums, axis=0, prepend=0)


@dataclass
class Step:
    """What some windows teach.

    ``chances``: of the scored ids; ``grads``: of all layers but ``emb``, whose are the
    sums ``emb`` of the inputs ``met``, each ``times`` an input; ``parts``: each class's
    part in the ids ``wanted``, in their order, the first ``none`` of them places without an id.
    """

    chances: np.ndarray
    grads: dict[str, np.ndarray]
    met: np.ndarray
    times: np.ndarray
    emb: np.ndarray
    wanted: np.ndarray
    parts: np.ndarray
    none: int

    def all_grads(self, m: Layers) -> dict[str, np.ndarray]:
        grads = self.grads | {"emb": np.zeros_like(m.emb)}
        grads["emb"][self.met] = self.emb
        return grads


def _learnt(m: Layers, inputs: np.ndarray, targets: np.ndarray, shares: np.ndarray) -> Step:
    """Gradients of the mean surprise at the scored places' ids (-1: none).

    ``shares`` has the probability of each id in each class.  Rows are only made for ids
    that the windows hold, whatever the number of ids.
    """
    n, w, kind = len(inputs), WIDTH, m.emb.dtype
    hidden = np.flatnonzero(inputs < 0)
    x = m.emb.take(np.maximum(inputs, 0), axis=0)
    x += m.pos
    scale = kind.type(1 / np.sqrt(w))
    turn = np.concatenate([m.wq * scale, m.wk, m.wv], axis=1)
    qkv = np.empty((n, _SPAN, 3 * w + 1), kind)
    np.matmul(_grouped(x), turn, out=_grouped(qkv)[..., : 3 * w])
    qkv[..., 3 * w] = 1  # gives the weights' sum
    qkv.reshape(-1, 3 * w + 1)[hidden, 2 * w :] = 0  # where there is no input, neither its value nor its weight counts
    q, k, v = qkv[:, CONTEXT:, :w], qkv[..., w : 2 * w], qkv[..., 2 * w :]
    att = q @ k.transpose(0, 2, 1)
    np.clip(att, -_LIMIT, _LIMIT, out=att)
    np.exp(att, out=att)
    att *= _VISIBLE
    mixed = att @ v
    weight = mixed[..., w:].copy()
    mixed = mixed[..., :w] / weight
    h = _through(mixed, m.wo)
    h += x[:, CONTEXT:]
    act = _through(h, m.w1)
    act += m.b1
    np.maximum(act, 0, out=act)
    g = _through(act, m.w2)
    g += h
    # the class layer takes the places in the order of their ids
    wanted, order = _in_order(targets.ravel())
    none = int(np.searchsorted(wanted, 0))
    total = max(1, len(wanted) - none)
    ordered = g.reshape(-1, w).take(order, axis=0).reshape(g.shape)
    p = _through(ordered, m.w3)
    p += m.b3
    np.clip(p, -_LIMIT, _LIMIT, out=p)
    np.exp(p, out=p)
    whole = (_grouped(p) @ np.ones(CLASSES, kind)).ravel()
    p = p.reshape(-1, CLASSES)
    parts = shares.take(np.maximum(wanted, 0), axis=0).astype(kind, copy=False)
    parts *= p
    chance = (_grouped(parts.reshape(n, SCORED, CLASSES)) @ np.ones(CLASSES, kind)).ravel()
    parts /= chance[:, None]
    p /= whole[:, None]
    p -= parts
    p[:none] = 0
    d = p.reshape(n, SCORED, CLASSES)
    grads = {"w3": _over(ordered, d) / total, "b3": _total(d) / total}
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    dh = _through(d, m.w3.T / total).reshape(-1, w).take(back, axis=0).reshape(g.shape)
    grads["w2"] = _over(act, dh)
    dpre = _through(dh, m.w2.T)
    dpre *= act > 0
    grads["w1"], grads["b1"] = _over(h, dpre), _total(dpre)
    dh += _through(dpre, m.w1.T)
    grads["wo"] = _over(mixed, dh)
    dmixed = np.empty((n, SCORED, w + 1), kind)
    np.divide(_through(dh, m.wo.T), weight, out=dmixed[..., :w])
    dmixed[..., w] = -((dmixed[..., :w] * mixed) @ np.ones(w, kind))
    draw = dmixed @ v.transpose(0, 2, 1)
    draw *= att
    dqkv = np.empty((n, _SPAN, 3 * w), kind)
    dqkv[:, :CONTEXT, :w] = 0
    np.matmul(draw, k, out=dqkv[:, CONTEXT:, :w])
    np.matmul(draw.transpose(0, 2, 1), q, out=dqkv[..., w : 2 * w])
    np.matmul(att.transpose(0, 2, 1), dmixed[..., :w], out=dqkv[..., 2 * w :])
    dqkv.reshape(-1, 3 * w)[hidden] = 0
    wide = _over(x, dqkv)
    grads["wq"], grads["wk"], grads["wv"] = wide[:, :w] * scale, wide[:, w : 2 * w], wide[:, 2 * w :]
    dx = _through(dqkv, turn.T)
    dx[:, CONTEXT:] += dh
    grads["pos"] = dx.sum(axis=0)
    ids, order = _in_order(inputs.ravel())
    unseen = len(hidden)
    met, emb = _summed(ids[unseen:], dx.reshape(-1, w).take(order[unseen:], axis=0))
    times = np.diff(np.r_[np.searchsorted(ids, met), len(ids)])
    return Step(chance[none:] / whole[none:], grads, met, times, emb, wanted, parts, none)


def _gradients(m: Layers, inputs: np.ndarray, targets: np.ndarray, shares: np.ndarray) -> tuple:
    """Mean surprise, the gradients of all layers, and each class's part in each id, in the ids' order."""
    step = _learnt(m, inputs, targets, shares)
    return float(-np.log(step.chances).mean()) if len(step.chances) else 0.0, step.all_grads(m), step.parts


def _gather(gathered: np.ndarray, learnt: Step) -> None:
    """Adds the classes' parts to the rows of their ids."""
    ids, sums = _summed(learnt.wanted[learnt.none :], learnt.parts[learnt.none :])
    gathered[ids] += sums


def _shares(parts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Probability of each id in each class, from the classes' parts in each id and the ids' counts."""
    return _shared(parts.astype(np.float64), counts + 0.5)


def _shared(table: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The table's rows times their weights as shares of each column; the table is used up."""
    whole = weights @ table
    table *= weights[:, None]
    return np.divide(table, whole, out=np.empty(table.shape, np.float32), casting="same_kind")


def fit(sample: list[np.ndarray], size: int, seed: int = 5) -> tuple[Layers, np.ndarray]:
    """Adam over random windows of the sample; every few steps the parts follow what the classes explained."""
    rng = np.random.default_rng(seed)

    def start(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.2 if len(shape) == 2 and shape[0] < 100 else 0.1, shape).astype(np.float32)

    m = Layers(
        start(size, WIDTH), start(_SPAN, WIDTH), *(start(WIDTH, WIDTH) for _ in range(4)),
        start(WIDTH, HIDDEN), np.zeros(HIDDEN, np.float32), start(HIDDEN, WIDTH),
        start(WIDTH, CLASSES), np.zeros(CLASSES, np.float32),
    )
    inputs, targets = cut(sample, size - 1)
    every, met = m.emb, np.unique(inputs[inputs >= 0])  # no other rows move
    inputs = np.where(inputs < 0, -1, np.searchsorted(met, inputs))
    m.emb = every[met]
    counts = np.bincount(np.concatenate(sample), minlength=size)
    held = np.full((size, CLASSES), 0.3 / CLASSES)
    held[np.arange(size), _classes(sample, size)] += 0.7
    gathered = 2 * held
    shares = _shares(held, counts)
    names = list(m.__dataclass_fields__)
    first = {n: np.zeros_like(getattr(m, n)) for n in names}
    second = {n: np.zeros_like(getattr(m, n)) for n in names}
    for step in range(1, _STEPS + 1):
        chosen = rng.integers(0, len(inputs), _BATCH)
        learnt = _learnt(m, inputs[chosen], targets[chosen], shares)
        grads = learnt.all_grads(m)
        _gather(gathered, learnt)
        if step % _REFRESH == 0:
            held = gathered / gathered.sum(axis=1, keepdims=True)
            shares = _shares(held, counts)
            gathered = 0.5 * gathered + held
        rate = _RATE * min(1.0, 2 - 2 * step / (_STEPS + 1))
        for n in names:
            first[n] += 0.1 * (grads[n] - first[n])
            second[n] += 0.01 * (grads[n] ** 2 - second[n])
            change = rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-7)
            setattr(m, n, (getattr(m, n) - change).astype(np.float32))
    every[met] = m.emb
    m.emb = every
    return m, held


@dataclass
class Model:
    """Layers folded into tables of ids, and the probability of each id in each class."""

    end: int
    shares: np.ndarray
    tables: np.ndarray
    places: np.ndarray
    tail: tuple

    @classmethod
    def build(cls, m: Layers, parts: np.ndarray, counts: np.ndarray) -> Model:
        turn = np.concatenate([np.eye(WIDTH, dtype=np.float32), m.wq / np.sqrt(WIDTH), m.wk, m.wv @ m.wo], axis=1)

        def table(rows: np.ndarray, last: float) -> np.ndarray:
            return np.c_[rows @ turn, np.full(len(rows), last)].astype(np.float32)

        return cls(
            len(parts) - 1, _shares(parts, counts), table(m.emb, 1.0), table(m.pos, 0.0),
            (m.w1, m.b1, m.w2, m.w3, m.b3),
        )

    #: Windows attended to at once; their rows stay in a processor's cache.
    BLOCK = 64

    def scores(self, ids: list[np.ndarray]) -> np.ndarray:
        """log10 of each document's probability."""
        inputs, targets = cut(ids, self.end)
        sums = np.empty(len(inputs))
        for at in range(0, len(inputs), self.BLOCK):
            sums[at : at + self.BLOCK] = self._window_scores(inputs[at : at + self.BLOCK], targets[at : at + self.BLOCK])
        counts = -(-np.array([len(x) for x in ids]) // SCORED)
        return np.add.reduceat(sums, np.cumsum(counts) - counts)

    def _window_scores(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        w1, b1, w2, w3, b3 = self.tail
        d = WIDTH
        rows = self.tables.take(np.maximum(inputs, 0), axis=0)
        rows += self.places
        rows[inputs < 0, 3 * d :] = 0  # where there is no input, neither its value nor its weight counts
        own = rows[:, CONTEXT:]
        weights = own[..., d : 2 * d] @ rows[..., 2 * d : 3 * d].transpose(0, 2, 1)
        np.minimum(weights, _LIMIT, out=weights)
        np.exp(weights, out=weights)
        weights *= _VISIBLE
        mixed = weights @ rows[..., 3 * d :]  # the last column is the weights' sum
        h = (own[..., :d] + mixed[..., :d] / mixed[..., d:]).reshape(-1, d)
        g = h + np.maximum(h @ w1 + b1, 0) @ w2
        logits = g @ w3 + b3
        np.minimum(logits, _LIMIT, out=logits)
        wanted = np.maximum(targets, 0).ravel()
        np.exp(logits, out=logits)
        total = logits @ np.ones(CLASSES, np.float32)
        logits *= self.shares.take(wanted, axis=0)
        log = np.log10((logits @ np.ones(CLASSES, np.float32)) / total)
        return np.where(targets.ravel() >= 0, log, 0.0).reshape(targets.shape).sum(axis=1, dtype=np.float64)


class Learner:
    """One task's training: Adam over the windows it is given, where only the rows of ids it meets move."""

    def __init__(self, m: Layers, held: np.ndarray, counts: np.ndarray, seed: int):
        self.m = Layers(*(x.copy() for x in astuple(m)))
        self.held, self.counts = held, counts
        self.shares = _shares(held, counts)
        self.met = np.zeros(len(held))  # inputs
        self.gathered = np.zeros(held.shape)  # classes' parts in the targets
        self.first = {n: np.zeros_like(x) for n, x in vars(self.m).items()}
        self.second = {n: np.zeros_like(x) for n, x in vars(self.m).items()}
        self.rng = np.random.default_rng(seed)
        self.steps = self.seen = 0

    def learn(self, ids: list[np.ndarray]) -> None:
        """Once over all windows of these documents, in random order."""
        inputs, targets = cut(ids, len(self.held) - 1)
        order = self.rng.permutation(len(inputs))
        for at in range(0, len(order), _BATCH):
            chosen = order[at : at + _BATCH]
            self._step(inputs[chosen], targets[chosen])

    def _step(self, inputs: np.ndarray, targets: np.ndarray) -> None:
        learnt = _learnt(self.m, inputs, targets, self.shares)
        _gather(self.gathered, learnt)
        self.met[learnt.met] += learnt.times
        self.seen += len(learnt.chances)
        self.steps += 1
        rate = _PASS_RATE / (1 + self.steps / _PASS_HALF)
        low, high = 1 - 0.9**self.steps, 1 - 0.99**self.steps
        learnt.grads["emb"] = learnt.emb.astype(np.float32)
        for n, x in vars(self.m).items():
            at = learnt.met if n == "emb" else slice(None)
            grad, first, second = learnt.grads[n], self.first[n][at], self.second[n][at]
            first = first + 0.1 * (grad - first)
            second = second + 0.01 * (grad**2 - second)
            self.first[n][at], self.second[n][at] = first, second
            x[at] -= (rate * (first / low) / (np.sqrt(second / high) + 1e-7)).astype(np.float32)
        if self.steps % (4 * _REFRESH) == 0:
            table = self.gathered + 2 * self.held
            self.shares = _shared(table, (self.counts + 0.5) / (table @ np.ones(CLASSES)))

    def sums(self) -> Iterator[tuple[int, bytes]]:
        """Rows to be added up over tasks: blocks of ids, and -1 for the layers without ids."""
        if not self.seen:
            return
        table = np.c_[self.met, self.m.emb * self.met[:, None], self.gathered].astype(np.float32)
        table = np.pad(table, ((0, -len(table) % _BLOCK_IDS), (0, 0))).reshape(-1, _BLOCK_IDS * table.shape[1])
        for block in np.flatnonzero(table.any(axis=1)):
            yield int(block), table[block].tobytes()
        dense = np.concatenate([x.ravel() for n, x in vars(self.m).items() if n != "emb"])
        yield -1, (np.r_[1, dense] * self.seen).astype(np.float32).tobytes()


def _parts(gathered: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The classes' parts in each id; what was held before counts as two occurrences."""
    table = gathered + 2 * before
    return table / table.sum(axis=1, keepdims=True)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, row in zip(batch.column("block").to_pylist(), batch.column("row").to_pylist(), strict=True):
            own = np.frombuffer(row, np.float32)
            if block in total:
                total[block] += own
            else:
                total[block] = own.astype(np.float64)
    columns = [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, names=["block", "row"])


def averaged(m: Layers, held: np.ndarray, sums: dict[int, np.ndarray]) -> tuple[Layers, np.ndarray]:
    """Layers and parts from the sums of all tasks; what no task met stays as it was."""
    if -1 not in sums:
        return m, held
    size, width = len(held), 1 + WIDTH + CLASSES
    table = np.zeros((-(-size // _BLOCK_IDS), _BLOCK_IDS * width))
    for block, row in sums.items():
        if block >= 0:
            table[block] = row
    table = table.reshape(-1, width)[:size]
    met, emb = table[:, 0] > 0, m.emb.copy()
    emb[met] = table[met, 1 : 1 + WIDTH] / table[met, :1]
    dense, at, layers = sums[-1][1:] / sums[-1][0], 0, [emb]
    for n, x in vars(m).items():
        if n != "emb":
            layers.append(dense[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
    return Layers(*layers), _parts(table[:, 1 + WIDTH :], held)


def learn_all(
    docs: DataFrame, m: Layers, held: np.ndarray, counts: np.ndarray, ranks: dict[bytes, int], pattern: str,
    tasks: int, text: str = "text",
) -> tuple[Layers, np.ndarray]:
    """Layers and parts after one pass over all texts, in about so many tasks."""
    shared = docs.sparkSession.sparkContext.broadcast((m, held.astype(np.float32), counts, ranks))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, held, counts, ranks = shared.value
        subwords, learner = Subwords(ranks, pattern), Learner(m, held, counts, TaskContext.get().partitionId())
        for piece in texts.pieces(batches, "text", 1 << 19):
            learner.learn([subwords.document(words_of(s)) for s in texts.strings(piece.column("text"))])
        rows = list(learner.sums())
        columns = [pa.array([b for b, _ in rows], pa.int32()), pa.array([r for _, r in rows], pa.binary())]
        whole = pa.RecordBatch.from_arrays(columns, names=["block", "row"])
        for at in range(0, whole.num_rows, 1000):
            yield whole.slice(at, 1000)

    narrow = docs.select(docs[text].alias("text")).coalesce(tasks)
    rows = narrow.mapInArrow(task, "block int, row binary").repartition("block")
    found = rows.mapInArrow(_add_up, "block int, row binary").collect()
    return averaged(m, held, {r["block"]: np.frombuffer(r["row"]) for r in found})


def starting_texts(docs: DataFrame, text: str = "text", most: int = SAMPLE_ROWS) -> list[tuple[str, bool]]:
    """Beginnings of at most so many texts, by their hashes, and whether each is all of its text."""
    plain = F.coalesce(docs[text], F.lit(""))
    # the hash up to which there are as many texts as wanted, then those texts' beginnings alone
    hashed = docs.select(F.xxhash64(plain).alias("h")).distinct()  # a group of copies is one text
    upto = hashed.orderBy("h").limit(most).agg(F.max("h")).first()[0]
    chosen = docs.where(F.xxhash64(plain) <= F.lit(upto)) if upto is not None else docs.limit(0)
    begun = chosen.select(F.substr(plain, F.lit(1), F.lit(SAMPLE_CHARS)).alias("p"), (F.length(plain) <= SAMPLE_CHARS).alias("whole"))
    return [(r["p"], r["whole"]) for r in begun.distinct().orderBy("p", "whole").collect()]


def begun_ids(subwords: Subwords, begun: list[tuple[str, bool]]) -> list[np.ndarray]:
    """Ids of the beginnings, the end only where the text ends; a last word that may be cut is left out."""
    ids = [subwords.document(words_of(p)) if whole else subwords.document(words_of(p)[:-1])[:-1] for p, whole in begun]
    return [x for x in ids if len(x)]


def train(docs: DataFrame, words: DataFrame, n_docs: int, ranks: dict[bytes, int], pattern: str, text: str = "text") -> Model:
    """Layers and parts from all of ``docs``, after a start on a bounded sample; shares from ``words``, their counts."""
    subwords = Subwords(ranks, pattern)
    ids = begun_ids(subwords, starting_texts(docs, text)) or [np.array([subwords.end], np.int32)]
    counts = count_ids(words, ranks, pattern)
    counts[subwords.end] += n_docs
    m, held = fit(ids, subwords.size)
    own = np.bincount(np.concatenate(ids), minlength=subwords.size)
    held[own == 0] = own @ held / own.sum()  # nothing is known of ids outside the sample
    n_words = words.agg(F.sum("n")).first()[0] or 0
    return Model.build(*learn_all(docs, m, held, counts, ranks, pattern, 1 + n_words // TASK_WORDS, text), counts)


def score(
    docs: DataFrame, training: DataFrame, ranks: dict[bytes, int], pattern: str,
    doc_id: str = "doc_id", text: str = "text", frequent: int = WORDS,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``; learns from ``training``."""
    context = docs.sparkSession.sparkContext
    n_docs = training.count()
    words, _ = session.staged(count_words(training, text), "words")
    totals = words.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    tokens = totals["n"] + n_docs
    distinct = totals["v"] + (n_docs > 0)
    least = _least_count(words, frequent)
    below = tokens + _SMOOTH * (distinct + 1)
    known = {} if least is None else {
        bytes(r["word"]): r["n"] for r in words.filter(F.col("n") >= least).toLocalIterator()
    }
    model = train(training, words, n_docs, ranks, pattern, text)
    shared = context.broadcast({"sent": (ranks, known, astuple(model))})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = shared.value
        if "made" not in kept:  # a worker keeps it for its next tasks
            ranks, known, parts = kept.pop("sent")
            logs = {w: float(np.log10((n + _SMOOTH) / below)) for w, n in known.items()}
            kept["made"] = Subwords(ranks, pattern), Model(*parts), logs
        subwords, own, logs = kept["made"]
        end = float(np.log10((n_docs + _SMOOTH) / below))
        row = TaskContext.get().partitionId() << 40
        for piece in texts.pieces(batches, "text", 1 << 19):
            lists = [words_of(s) for s in texts.strings(piece.column("text"))]
            scores = own.scores([subwords.document(ws) for ws in lists])
            base, seen, rare = [], [], []
            for ws in lists:
                found = list(map(logs.get, ws))
                other = [w for w, x in zip(ws, found, strict=True) if x is None] if None in found else []
                some = [x for x in found if x is not None] if other else found
                base.append(sum(some) + end)
                seen.append(len(some) + (n_docs > 0))
                rare.append(other)
            n = len(lists)
            columns = [
                pa.array(np.arange(row, row + n)), piece.column("doc_id"),
                pa.array([len(ws) + 1 for ws in lists], pa.int64()), pa.array(seen, pa.int64()),
                pa.array(base, pa.float64()), pa.array(scores), pa.array(rare, pa.list_(pa.binary())),
            ]
            row += n
            yield pa.RecordBatch.from_arrays(
                columns, names=["row", "doc_id", "n_tokens", "n_seen", "base", "score", "rare"]
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"row long, doc_id {kind}, n_tokens long, n_seen long, base double, score double, rare array<binary>"
    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    scored, _ = session.staged(narrow.mapInArrow(task, schema), "scored")
    others = scored.select("row", F.explode("rare").alias("word")).groupBy("row", "word").count()
    counted = words if least is None else words.filter(F.col("n") < least)
    joined = others.join(counted, "word", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    more = joined.groupBy("row").agg(
        F.sum(F.col("count") * F.log10((F.col("c") + _SMOOTH) / F.lit(float(below)))).alias("more"),
        F.sum(F.when(F.col("c") > 0, F.col("count")).otherwise(0)).alias("known"),
    )
    return scored.drop("rare").join(more, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_seen") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
    )


def _least_count(words: DataFrame, most: int) -> int | None:
    """The count that at most ``most`` words reach; there are few distinct counts."""
    least, total = None, 0
    sizes = words.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n"))
    for row in sizes.toLocalIterator():
        total += row["words"]
        if total > most:
            break
        least = row["n"]
    return least
