"""Exact duplicates by content-defined chunk recipes; DataFrame functions only.

A normalised text is cut where its own content says so.  Every chunk gets a
64-bit identifier, and the distinct chunks, each moved once however often it
occurs, verify that no identifier stands for two different chunks.  A document
then is its recipe, the ordered list of identifiers, eight bytes for some six
hundred characters, and only recipes are grouped and joined.  Where verification
finds an identifier with two chunks, the documents that hold it compare their
chunks' texts instead, so the result is exact in any case.

Defined results: a null text counts as empty, and empty texts are equal; of equal
texts the smallest non-null id stays, none if all ids are null (``keep_id`` is
then null and each such row is kept); rows that repeat an id and text all count
in ``group_size`` and are all marked kept (``survivors`` leaves one); an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow import session



def _quarter(k: int) -> str:
    """A character class of about a quarter of each script: by the last two bits of an ASCII code, else by runs of codes."""
    plain = "".join(f"\\x{c:02x}" for c in range(0x21, 0x7F) if c % 4 == k)
    runs = [range(c, c + 8) for c in range(0x80, 0x1000, 8) if c // 8 % 4 == k]
    runs += [range(c, c + 64) for c in range(0x1000, 0x10000, 64) if c // 64 % 4 == k and not 0xD800 <= c < 0xE000]
    others = "".join(f"\\x{{{r.start:x}}}-\\x{{{r.stop - 1:x}}}" for r in runs)
    # only characters beyond ASCII go through the runs
    return f"(?:[{plain}]|(?=\\P{{ASCII}})[{others}])"


# A cut comes 128 to 4,095 characters after the last one: at a space or full-width stop where the characters beside
# it are of certain quarters.  That is about one place in four hundred, by two rules so that few vocabularies avoid
# both; what stands around a place decides it alone, so that after an insertion the cuts soon are the old ones again.
# Without any, a chunk ends after 4,096 characters.
_Q0, _Q1, _Q2, _Q3 = map(_quarter, range(4))
_PLACE = f"(?:(?<= )(?:(?<={_Q2}{_Q0} )(?={_Q3})|(?<={_Q0}{_Q1} )(?={_Q3}{_Q1}))|(?<=[。！？])(?={_Q3}))"
_CHUNK = f"(?s).{{128,4095}}?{_PLACE}|.{{1,4096}}"

Hash = Callable[[Column], Column]


def identifier(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_CHUNK), F.lit(0))


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", identify: Hash = identifier) -> DataFrame:
    """Per row: id, hash of the normalised text, ordered chunk identifiers, and texts where these could mislead."""
    plain = docs.select(docs[doc_id].alias("doc_id"), normalised(docs[text]).alias("plain"))
    cut = plain.select(
        "doc_id",
        F.sha2(F.encode("plain", "UTF-8"), 256).alias("text_sha256"),
        F.transform(_chunks(F.col("plain")), identify).alias("recipe"),
    )
    stored, _ = session.staged(cut, "recipes")
    chunks = plain.select(F.explode(_chunks(F.col("plain"))).alias("chunk"))
    distinct = chunks.select(identify(F.col("chunk")).alias("chunk_id"), "chunk").distinct()
    clashes, _ = session.staged(distinct.groupBy("chunk_id").count().filter("count > 1"), "clashes")
    nothing = F.array().cast("array<string>")
    if clashes.isEmpty():
        return stored.withColumn("spelled", nothing)
    # every document with such an identifier is told apart by its chunks' texts
    held = stored.select("doc_id", "text_sha256", F.explode("recipe").alias("chunk_id"))
    marked = held.join(clashes, "chunk_id", "left_semi").select("doc_id", "text_sha256").distinct()
    spelled = plain.select(
        "doc_id", F.sha2(F.encode("plain", "UTF-8"), 256).alias("text_sha256"), _chunks(F.col("plain")).alias("spelled")
    )
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("doc_id", "text_sha256")]
    doubtful = spelled.alias("a").join(marked.alias("b"), same, "left_semi")
    doubtful = doubtful.withColumn("recipe", F.transform("spelled", identify))
    sure = stored.alias("a").join(marked.alias("b"), same, "left_anti").withColumn("spelled", nothing)
    return sure.unionByName(doubtful)


def duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", identify: Hash = identifier) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    lists = recipes(docs, doc_id, text, identify)
    groups = lists.groupBy("recipe", "spelled").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return lists.join(groups, ["recipe", "spelled"]).select("doc_id", "keep_id", "group_size", kept, "text_sha256")


def survivors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; rows repeating an id and text leave one."""
    decided, _ = session.staged(duplicates(docs, doc_id, text), "duplicates")
    stay = decided.filter("kept").groupBy("doc_id", "text_sha256").count()
    sha = F.sha2(F.encode(normalised(docs[text]), "UTF-8"), 256)
    name = "_sha"
    while name in map(str.lower, docs.columns):
        name += "_"
    rows = docs.withColumn(name, sha)
    same = F.col(f"rows.{doc_id}").eqNullSafe(F.col("stay.doc_id")) & (F.col(f"rows.{name}") == F.col("stay.text_sha256"))
    left = rows.alias("rows").join(stay.alias("stay"), same, "left_semi")
    if not stay.filter("count > 1").isEmpty():
        left = left.dropDuplicates([doc_id, name])
    return left.drop(name)
