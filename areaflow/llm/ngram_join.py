"""Documents whose word shingles overlap by three quarters, and what hangs together by such links.

1.  Every task turns its texts into sets of distinct shingles (64-bit numbers) and
    sends sorted, packed postings by range of the shingle.  Only shingles held by
    two documents or more come back, with the number of documents that hold them;
    nothing else can add to an overlap.
2.  A document goes on if shared shingles make up three quarters of its set.  Of
    equal sets one goes on.
3.  In the order from rare to frequent, two linking sets share one of their first
    n - ceil(0.75 n) + 1 shingles.  Documents that share such a shingle hang
    together loosely; only inside these clusters can links exist.
4.  A cluster is cut into tiles of bounded size.  A tile's sets go into a prefix
    tree, most frequent shingle first, and every set is searched for in it: partial
    overlaps are shared along the tree, subtrees that cannot reach the threshold
    are left.  For a cluster of several tiles this is repeated with one document of
    each component found; in the end all pairs of tiles that still hold different
    components are compared, so no link between two components is missed.

Links are only followed until a component is known; its pairs are never listed.

Defined results: null and empty texts have an empty set and are alone; with fewer
than five words the whole sequence is the one shingle; rows without an id have no
component; of rows that repeat an id the one with the largest set takes part, with
any shared shingle of the others, and a row with another set gets the component of
its own set's class; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow import session
from areaflow.llm import shingles
from areaflow.llm.components import components
from areaflow.llm.prefix_tree import linked_groups

#: Shingles a task gathers before it sends them.
BLOCK = 1_500_000
#: Sets of a tile.
TILE = 256

_MEMBERS = "doc_id long, n long, s1 long, s2 long"


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))


def members(narrow: DataFrame) -> DataFrame:
    """Per row: the id, the size of its set and 128 bits that name the set."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = shingles.Shingler()
        for ids, sets in shingler.pieces(batches):
            names = [shingles.signature(s) for s in sets]
            columns = [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64())]
            columns += [pa.array([n[k] for n in names], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "s1", "s2"])

    return narrow.mapInArrow(task, _MEMBERS)


def _postings(narrow: DataFrame, bits: int) -> DataFrame:
    """``part, tokens, docs``: packed postings of one range of shingles; equal sets of a block once."""

    def flush(sets: list[np.ndarray], ids: list[int]) -> Iterator[pa.RecordBatch]:
        tokens = np.concatenate(sets)
        docs = np.repeat(np.array(ids, np.int64), [len(s) for s in sets])
        order = np.argsort(tokens)
        tokens, docs = tokens[order], docs[order]
        cuts = np.searchsorted(tokens >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        parts = [k for k in range(1 << bits) if cuts[k] < cuts[k + 1]]
        for first in range(0, len(parts), 64):
            some = parts[first : first + 64]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some, pa.int32()),
                    pa.array([shingles.pack(tokens[cuts[k] : cuts[k + 1]]) for k in some], pa.binary()),
                    pa.array([shingles.pack(docs[cuts[k] : cuts[k + 1]]) for k in some], pa.binary()),
                ],
                names=["part", "tokens", "docs"],
            )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = shingles.Shingler()
        held, ids, gathered, seen = [], [], 0, set()
        for some_ids, sets in shingler.pieces(batches):
            for i, s in zip(some_ids, sets, strict=True):
                name = shingles.signature(s)
                if i is None or not len(s) or name in seen:
                    continue
                seen.add(name)
                held.append(s)
                ids.append(i)
                gathered += len(s)
            if gathered >= BLOCK:
                yield from flush(held, ids)
                held, ids, gathered, seen = [], [], 0, set()
        if held:
            yield from flush(held, ids)

    return narrow.mapInArrow(task, "part int, tokens binary, docs binary")


def _doc_parts(docs: np.ndarray, parts: int) -> np.ndarray:
    mixed = docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _shared(postings: DataFrame, doc_parts: int) -> DataFrame:
    """``doc_part, tokens, docs, holders``: packed postings of the shingles that several documents hold."""

    def task(group: pd.DataFrame) -> pd.DataFrame:
        tokens = np.concatenate([shingles.unpack(x, np.uint64) for x in group["tokens"]])
        docs = np.concatenate([shingles.unpack(x, np.int64) for x in group["docs"]])
        order = np.argsort(tokens)
        tokens, docs = tokens[order], docs[order]
        same = np.r_[False, tokens[1:] == tokens[:-1]]
        several = same | np.r_[same[1:], False]
        tokens, docs = tokens[several], docs[several]
        order = np.lexsort((docs, tokens))
        tokens, docs = tokens[order], docs[order]
        once = np.r_[True, (tokens[1:] != tokens[:-1]) | (docs[1:] != docs[:-1])] if len(tokens) else several[:0]
        tokens, docs = tokens[once], docs[once]
        first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[first, len(tokens)])
        holders = np.repeat(sizes, sizes)
        tokens, docs, holders = tokens[holders > 1], docs[holders > 1], holders[holders > 1].astype(np.uint32)
        to = _doc_parts(docs, doc_parts)
        order = np.argsort(to, kind="stable")
        tokens, docs, holders, to = tokens[order], docs[order], holders[order], to[order]
        cuts = np.searchsorted(to, np.arange(doc_parts + 1))
        rows = [(k, cuts[k], cuts[k + 1]) for k in range(doc_parts) if cuts[k] < cuts[k + 1]]
        return pd.DataFrame(
            {
                "doc_part": np.array([k for k, *_ in rows], np.int32),
                "tokens": [shingles.pack(tokens[a:b]) for _, a, b in rows],
                "docs": [shingles.pack(docs[a:b]) for _, a, b in rows],
                "holders": [shingles.pack(holders[a:b]) for _, a, b in rows],
            }
        )

    return postings.groupBy("part").applyInPandas(task, "doc_part int, tokens binary, docs binary, holders binary")


def _eligible(shared: DataFrame, sizes: DataFrame, doc_parts: int) -> DataFrame:
    """Documents of whose set shared shingles make up enough: ``doc_id, n, s1, s2, tokens, lead``.

    ``tokens`` go from rare to frequent; the first ``lead`` of them are those to meet partners by.
    """

    def own_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
            part = pa.array(_doc_parts(docs, doc_parts).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, part], names=[*batch.schema.names, "doc_part"])

    def task(postings: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(postings) and len(own):
            tokens = np.concatenate([shingles.unpack(x, np.uint64) for x in postings["tokens"]])
            docs = np.concatenate([shingles.unpack(x, np.int64) for x in postings["docs"]])
            holders = np.concatenate([shingles.unpack(x, np.uint32) for x in postings["holders"]])
            order = np.lexsort((tokens, holders, docs))
            tokens, docs = tokens[order], docs[order]
            own = own.sort_values(["doc_id", "n"]).drop_duplicates("doc_id", keep="last")
            ids = own["doc_id"].to_numpy()
            starts, ends = np.searchsorted(docs, ids), np.searchsorted(docs, ids, side="right")
            for i, n, s1, s2, a, b in zip(
                ids.tolist(), own["n"].tolist(), own["s1"].tolist(), own["s2"].tolist(), starts.tolist(), ends.tolist(),
                strict=True,
            ):
                n = max(n, b - a)
                if 100 * (b - a) >= 75 * n:
                    lead = n - (75 * n + 99) // 100 + 1 - (n - (b - a))
                    rows.append((i, n, s1, s2, shingles.pack(tokens[a:b]), max(0, lead)))
        return pd.DataFrame(rows, columns=["doc_id", "n", "s1", "s2", "tokens", "lead"])

    placed = sizes.filter("doc_id IS NOT NULL AND n > 0").mapInArrow(own_part, f"{_MEMBERS}, doc_part int")
    both = shared.groupBy("doc_part").cogroup(placed.groupBy("doc_part"))
    return both.applyInPandas(task, f"{_MEMBERS}, tokens binary, lead int")


def _clusters(vertices: DataFrame) -> DataFrame:
    """``v, cluster``: documents that share a leading shingle, directly or by others."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tokens", "lead")), strict=True)
            for i, tokens, lead in rows:
                own = shingles.unpack(tokens, np.int64)[:lead]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array(np.full(len(own), i, np.int64))], names=["token", "v"]
                )

    postings, _ = session.staged(
        vertices.select("doc_id", "tokens", "lead").mapInArrow(task, "token long, v long"), "leads"
    )
    least = postings.groupBy("token").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("holders"))
    edges = postings.join(least.filter("holders > 1"), "token").select(F.col("v").alias("a"), F.col("low").alias("b"))
    return components(edges.distinct()).withColumnRenamed("component", "cluster")


def _compare(tiles: DataFrame) -> DataFrame:
    """Edges ``a, b`` between sets of a tile, or of a pair of tiles, that are not in one ``part`` yet."""

    def task(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("v")
        ids = group["v"].to_numpy()
        sets = [shingles.unpack(x, np.uint64) for x in group["tokens"]]
        found = linked_groups(sets, group["n"].to_numpy(), group["part"].tolist())
        return pd.DataFrame(
            {"a": ids[[i for i, _ in found]], "b": ids[[j for _, j in found]]} if found else {"a": [], "b": []}
        )

    return tiles.groupBy("cluster", "low", "high").applyInPandas(task, "a long, b long")


def _tile(rows: DataFrame, tile: int) -> DataFrame:
    """Adds ``t``, one of as many tiles as the cluster's rows need, and ``tiles``, their number."""
    sizes = rows.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles"))
    return rows.join(sizes, "cluster").withColumn("t", F.pmod(F.xxhash64("v"), F.col("tiles")))


def _parts(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` with ``part``, the component by the edges found so far."""
    known = components(edges).select("v", F.col("component").alias("found"))
    kept = [c for c in rows.columns if c != "part"]
    return rows.join(known, "v", "left").select(*kept, F.coalesce("found", "v").alias("part"))


def _links(vertices: DataFrame, clusters: DataFrame, tile: int) -> DataFrame:
    """Edges that connect exactly what links connect."""
    rows = vertices.join(clusters, vertices["doc_id"] == clusters["v"]).select("cluster", "v", "n", "tokens")
    rows, _ = session.staged(_tile(rows, tile).withColumn("part", F.col("v")), "sets")

    def inside(some: DataFrame) -> DataFrame:
        alone = some.withColumn("low", F.col("t")).withColumn("high", F.col("t"))
        return _compare(alone.select("cluster", "low", "high", "v", "n", "tokens", "part"))

    edges, _ = session.staged(inside(rows), "edges")
    large = rows.filter("tiles > 1")
    if large.isEmpty():
        return edges
    # one document of each component, tiled anew: most components of a large cluster meet here
    large, _ = session.staged(_parts(large, edges), "large")
    heads = large.filter("v = part").drop("t", "tiles")
    more, _ = session.staged(inside(_tile(heads, tile)), "edges")
    edges = edges.union(more)
    # what is left of a cluster: documents of large components in tiles of their own, the others together
    large = _parts(large, edges)
    sizes = large.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("size"))
    open_ = sizes.groupBy("cluster").agg(F.count(F.lit(1)).alias("parts"))
    open_ = open_.filter("parts > 1").select("cluster")
    sizes = sizes.join(open_, "cluster").withColumn("own", F.col("size") >= tile)
    rest = sizes.filter("NOT own").groupBy("cluster").agg(F.sum("size").alias("rest"))
    dealt = large.drop("t", "tiles").join(sizes, ["cluster", "part"]).join(rest, "cluster", "left")
    room = F.when(F.col("own"), F.col("size")).otherwise(F.col("rest"))
    whose = F.when(F.col("own"), F.col("part")).otherwise(F.lit(None).cast("long"))
    slot = F.when(F.col("own"), F.xxhash64("v")).otherwise(F.xxhash64("part", "v"))
    dealt = dealt.withColumn("whose", whose).withColumn("slot", F.pmod(slot, F.ceil(room / tile)))
    dealt = dealt.withColumn("t", F.xxhash64(F.coalesce("whose", F.lit(-1)), "slot"))
    dealt, _ = session.staged(dealt.select("cluster", "t", "whose", "v", "n", "tokens", "part"), "rest")
    tiles = dealt.select("cluster", "t", "whose").distinct()
    left, right = tiles.alias("x"), tiles.alias("y")
    # two tiles of one component need no comparison
    pairs = left.join(
        right, (F.col("x.cluster") == F.col("y.cluster")) & (F.col("x.t") <= F.col("y.t"))
    ).filter("x.whose IS NULL OR y.whose IS NULL OR x.whose <> y.whose")
    pairs = pairs.select("x.cluster", F.col("x.t").alias("low"), F.col("y.t").alias("high"))
    both = pairs.select("cluster", "low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("t"))
    units = both.join(dealt, ["cluster", "t"]).select("cluster", "low", "high", "v", "n", "tokens", "part")
    last, _ = session.staged(_compare(units), "edges")
    return edges.union(last)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = _narrow(docs, doc_id, text)
    sizes, _ = session.staged(members(narrow), "members")
    # ranges a few times as many as shuffle partitions, which are set after the input's size
    bits = min(20, (4 * parts - 1).bit_length())
    shared = _shared(_postings(narrow, bits), parts)
    eligible, _ = session.staged(_eligible(shared, sizes, parts), "eligible")
    first = eligible.groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    vertices, _ = session.staged(eligible.join(first, "doc_id", "left_semi"), "vertices")
    edges = _links(vertices, _clusters(vertices), tile)
    joined = components(edges).select(F.col("v").alias("doc_id"), "component")
    known = vertices.select("doc_id", "s1", "s2").join(joined, "doc_id").select("s1", "s2", "component")
    # classes of equal sets, then the smallest id of all classes of a component
    usable = sizes.filter("doc_id IS NOT NULL AND n > 0")
    classes = usable.groupBy("s1", "s2").agg(F.min("doc_id").alias("low")).join(known, ["s1", "s2"], "left")
    lowest = classes.filter("component IS NOT NULL").groupBy("component").agg(F.min("low").alias("lowest"))
    classes = classes.join(lowest, "component", "left").select(
        "s1", "s2", F.coalesce("lowest", "low").alias("component_id")
    )
    found = sizes.join(classes, ["s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def survivors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Rows without an id, which no component can name, stay.
    """
    decided, _ = session.staged(near_duplicates(docs, doc_id, text), "near")
    gone = decided.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[doc_id] == gone["_gone"], "left_anti")
