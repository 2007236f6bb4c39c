"""Small document tables with every odd case, and slow reference answers."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

GAP = re.compile(r"[\x20\x09-\x0D]+")


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) for _ in range(n))


def odd_texts() -> list[str | None]:
    rng = random.Random(3)
    base = sentence(rng, 60)
    return [
        None, "", " ", "\t\n", "one", "one two", "ONE  two", base, base, base.upper(), base.replace(" ", "\n", 3),
        base + " tail", "x" * 20_000, sentence(rng, 20_000), "ünï çödé 日本語のテキスト。もう一つ", "\x85 \xa0  ", "🎉" * 50,
    ]


def table(spark: SparkSession, texts: list[str | None], ids: list[int | None] | None = None) -> DataFrame:
    """Documents with extra columns whose names operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", 1, "a", 2, "k", b"t") for i, t in zip(ids, texts, strict=True)]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, plain string, n long, kept string, "
        "tokens binary"
    )
    return spark.createDataFrame(rows, schema)


def lower_words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in GAP.split(lowered) if w]


def smallest(ids: list[int], links: list[tuple[int, int]]) -> dict[int, int]:
    """The smallest id reachable from each."""
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low
