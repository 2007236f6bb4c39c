"""Byte-level BPE in Spark's own functions.

A word's bytes become a string with one character per piece, the character that
stands for the piece's id.  A fold merges, step by step, the adjacent pair of
lowest rank, the leftmost of equals, until no pair has a rank; a literal map, cut
into buckets by hash so that a lookup stays constant, gives the merged piece of a
pair, and as ids are ranks, the least character is the lowest rank.  Of the
corpus's distinct words the most frequent, up to ``WORDS`` of them and
``WORD_BYTES`` bytes, are folded once in tasks and written as one row of buckets.
The scan over the texts reads this row through a scalar subquery, so no plan holds
the words; any other word is folded where it stands.  Which words are in the map
changes the speed, never the ids.  Decoding looks up the bytes of every id and
concatenates.

A step merges all places of its pair.  That equals one place at a time because a
merge never makes a pair of a lower rank: a token's rank is above those of the two
tokens it was made from.

Defined results: a null text counts as empty and has no ids; words of any length
are folded, at a cost of the word's length for each different pair that merges;
rows are independent, so repeated rows give repeated results; an empty table gives
no rows; other columns are not read; an id without a piece is an error.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow import session

#: Distinct words folded in advance at most, and the bytes they and their ids may take in the map.
WORDS = 1 << 18
WORD_BYTES = 32 << 20
#: Longer words in the corpus are never in the map.
WORD_CHARS = 64
#: From this many bytes on a word's state carries whether a pair is left; in shorter ones a last character says so.
_LONG = 100
#: No piece's character.
_DONE = "."
_BYTES = "ISO-8859-1"
#: Ids are carried as characters from here on: no surrogates, and in the ids' order.
_FIRST = 0x10000


def _bucket(key: str, buckets: int) -> int:
    """The low bits of Spark's ``xxhash64(key)``; ``buckets`` is a power of two."""
    return xxhash.xxh64_intdigest(key.encode(), seed=42) % buckets


class BucketMap:
    """One value, an array of ``size`` small maps; a key's hash tells which of them may hold it.

    An expression should name the value once and bind it: planning costs grow
    with every copy of it.
    """

    def __init__(self, buckets: Column, size: int, row: DataFrame | None = None):
        self.buckets, self.size, self.row = buckets, size, row

    @classmethod
    def literal(cls, entries: dict[str, str]) -> BucketMap:
        """A constant of the plan, for entries whose number is fixed."""
        size = _buckets_for(len(entries))
        buckets: list[dict[str, str]] = [{} for _ in range(size)]
        for key, value in entries.items():
            buckets[_bucket(key, size)][key] = value
        text = json.dumps(buckets, separators=(",", ":"), ensure_ascii=False)
        return cls(F.from_json(F.lit(text), "array<map<string,string>>"), size)

    @classmethod
    def stored(cls, entries: DataFrame, key: str, value: str) -> BucketMap:
        """Entries of a bounded table, written as one row, which ``beside`` puts beside the rows that need it."""
        size = _buckets_for(entries.count())
        pairs = entries.select(_slot(F.col(key), size).alias("slot"), F.struct(key, value).alias("pair"))
        filled = pairs.groupBy("slot").agg(F.collect_list("pair").alias("pairs"))
        every = entries.sparkSession.range(size).select(F.col("id").cast("int").alias("slot"))
        none = F.array().cast(filled.schema["pairs"].dataType)
        rows = every.join(filled, "slot", "left").select("slot", F.coalesce("pairs", none).alias("pairs"))
        ordered = F.sort_array(F.collect_list(F.struct("slot", "pairs")))
        one = rows.agg(F.transform(ordered, lambda b: F.map_from_entries(b["pairs"])).alias("buckets"))
        row, _ = session.staged(one, "words-map")
        return cls(F.col("_buckets"), size, row)

    def beside(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the value as one more column, a scalar subquery.

        The optimizer moves the subquery into the one expression that uses the column,
        so no row carries it (a test looks at the plan).
        """
        return rows.select("*", self.row.scalar().alias("_buckets"))

    def get(self, buckets: Column, key: Column) -> Column:
        """The key's value or NULL; ``buckets`` is what the value is bound to."""
        return F.try_element_at(F.get(buckets, _slot(key, self.size)), key)


def _buckets_for(entries: int) -> int:
    return 1 << max(0, (entries // 2).bit_length())


def _slot(key: Column, size: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(size - 1)).cast("int")


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _merges(ranks: dict[bytes, int]) -> dict[str, str]:
    """For every two tokens that make a third, both characters and the third's."""
    found = {}
    for token, i in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                found[chr(_FIRST + left) + chr(_FIRST + right)] = chr(_FIRST + i)
    return found


def _unreachable(ranks: dict[bytes, int], merges: dict[str, str]) -> dict[str, str]:
    """Tokens that no merges lead to; as whole words they are themselves all the same."""
    found = {}
    for token, i in ranks.items():
        parts = [chr(_FIRST + ranks[token[k : k + 1]]) for k in range(len(token))]
        while len(parts) > 1:
            pairs = [merges.get(a + b, "\U0010ffff") for a, b in zip(parts, parts[1:], strict=False)]
            best = min(pairs)
            if best == "\U0010ffff":
                break
            at = pairs.index(best)
            parts[at : at + 2] = [best]
        if len(parts) > 1:
            found[token.decode(errors="replace")] = chr(_FIRST + i)
    return found


class Vocabulary:
    """``ranks``: bytes of each token and its id, every single byte among them; ``pattern`` splits texts.

    ``known`` gives words' ids as characters.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, known: BucketMap | None = None):
        merges = _merges(ranks)
        self.merges = BucketMap.literal(merges)
        apart = _unreachable(ranks, merges)
        self.apart = BucketMap.literal(apart) if apart else None
        self.known = known
        pieces: list[str | None] = [None] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            pieces[i] = token.decode(_BYTES)
        self.pieces = F.from_json(F.lit(json.dumps(pieces, separators=(",", ":"), ensure_ascii=False)), "array<string>")
        self.pattern = f"(?U){pattern}"  # Unicode white space, as in the tokenizer's own pattern
        every = bytes(range(256))
        self.bytes = every.decode(_BYTES), "".join(chr(_FIRST + ranks[every[k : k + 1]]) for k in range(256))

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))

    def _folded(self, merges: Column, word: Column) -> Column:
        """A character for each piece after all merges."""
        raw = F.decode(F.encode(word, "UTF-8"), _BYTES)
        start = F.translate(raw, *self.bytes)
        size = F.octet_length(word)
        steps = F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1)))

        def on(state: Column) -> Column:
            # a long word has far fewer different pairs than bytes: the steps behind the last merge cost nothing
            text = state["text"]
            step = _bound(
                self._merged(merges, text, True), lambda t: F.struct(t.alias("text"), (t == text).alias("done"))
            )
            return F.when(state["done"], state).otherwise(step)

        first = F.struct(start.alias("text"), F.lit(False).alias("done"))
        long = F.aggregate(steps, first, lambda s, _: on(s), lambda s: s["text"])

        def on_short(state: Column) -> Column:
            # a mark at the end says the same as cheaply as a short word's few steps need it
            return F.when(F.endswith(state, F.lit(_DONE)), state).otherwise(self._merged(merges, state, False, _DONE))

        short = F.aggregate(steps, start, lambda s, _: on_short(s), lambda s: F.replace(s, F.lit(_DONE), F.lit("")))
        return F.when(size > _LONG, long).otherwise(short)

    def _merged(self, merges: Column, state: Column, split: bool, mark: str = "") -> Column:
        """One step; where no pair has a rank, the state gets the mark and is else as it was."""

        n = F.length(state)
        if split:  # a character's place is costly to find far inside
            chars = F.split(state, "")
            pairs = F.zip_with(chars, F.slice(chars, 2, n), lambda a, b: self.merges.get(merges, F.concat(a, b)))
        else:
            pairs = F.transform(
                F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                lambda i: self.merges.get(merges, F.substring(state, i, F.lit(2))),
            )

        def step(made: Column) -> Column:
            def put(least: Column) -> Column:
                pair = F.substring(state, F.array_position(made, least).cast("int"), F.lit(2))
                same = F.concat(state, F.lit(mark)) if mark else state
                return F.when(least.isNull(), same).otherwise(F.replace(state, pair, least))

            return _bound(F.array_min(made), put)

        return _bound(pairs, step)

    def _with_maps(self, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
        """``body`` of a function that gives a word's ids; each map is bound once."""

        def with_merges(merges: Column) -> Column:
            def fold(word: Column) -> Column:
                return self._folded(merges, word)

            return self._looked_up(self.apart, fold, lambda first: self._looked_up(self.known, first, body))

        return _bound(self.merges.buckets, with_merges)

    @staticmethod
    def _looked_up(
        own: BucketMap | None, other: Callable[[Column], Column], body: Callable[[Callable[[Column], Column]], Column]
    ) -> Column:
        """``body`` of a function that looks into ``own`` first."""
        if own is None:
            return body(other)
        return _bound(own.buckets, lambda b: body(lambda word: F.coalesce(own.get(b, word), other(word))))

    def code_word(self, word: Column) -> Column:
        """The ids of one word as characters."""
        return self._with_maps(lambda coded: coded(word))

    def code(self, text: Column) -> Column:
        """The ids of a whole text as characters, for :func:`ids_of`."""
        words = self.words(text)
        return self._with_maps(lambda coded: F.array_join(F.transform(words, coded), ""))

    def decode(self, ids: Column) -> Column:
        """``binary``: the bytes of the ids of an ``array<int>``, one after the other."""
        joined = F.array_join(F.transform(ids, lambda i: F.element_at(self.pieces, i + 1)), "")
        return F.encode(joined, _BYTES)


def ids_of(code: Column) -> Column:
    """``array<int>`` from ids as characters."""
    ids = F.transform(F.split(code, ""), lambda c: F.ascii(c) - F.lit(_FIRST))
    return F.when(code == "", F.array().cast("array<int>")).otherwise(ids)


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", words: int = WORDS) -> DataFrame:
    """``word``: those above the count that ``words`` distinct words or their bytes reach; counted over all texts."""
    counted = docs.select(F.explode(vocabulary.words(docs[text])).alias("word")).groupBy("word").count()
    small = counted.filter((F.col("count") > 1) & (F.length("word") <= WORD_CHARS))
    repeated, _ = session.staged(small, "words")
    # an id takes four bytes and stands for at least one
    size = F.sum(F.octet_length("word") * 5).alias("bytes")
    # one row per distinct count, at most about the square root of twice the corpus
    sizes = repeated.groupBy("count").agg(F.count(F.lit(1)).alias("n"), size).orderBy(F.desc("count"))
    least, total, taken = None, 0, 0
    for row in sizes.toLocalIterator():
        total += row["n"]
        taken += row["bytes"]
        if total > words or taken > WORD_BYTES:
            break
        least = row["count"]
    return repeated.filter(F.lit(False) if least is None else F.col("count") >= least).select("word")


def learned(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", words: int = WORDS
) -> Vocabulary:
    """A vocabulary that knows the corpus's frequent words' ids."""
    plain = Vocabulary(ranks, pattern)
    # a word costs far more than its bytes, which adaptive execution goes by, and each task a copy of the rank map
    frequent = frequent_words(docs, plain, text, words).repartition(16, "word")
    folded, _ = session.staged(frequent.select("word", plain.code_word(F.col("word")).alias("code")), "words-folded")
    # the same maps of merges and pieces: each would be one more constant of some megabytes in the driver
    plain.known = BucketMap.stored(folded, "word", "code")
    return plain


def encode(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id and ``ids``."""
    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    if vocabulary.known is not None:
        narrow = vocabulary.known.beside(narrow)
    coded = narrow.select("doc_id", vocabulary.code(F.col("text")).alias("code"))
    return coded.select("doc_id", ids_of(F.col("code")).alias("ids"))
