"""Small made-up tables for the corpus operators."""

from __future__ import annotations

import random

WORDS = "river stone lamp quiet garden window paper copper morning letter bridge market winter candle forest signal harbour velvet thunder orchard".split()
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int) -> list[str]:
    draw = random.Random(seed)
    return [draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(words)]


def documents(spark, texts: dict, source="s"):
    rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in texts.items()]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def union_find(pairs, nodes):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
