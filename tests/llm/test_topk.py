from __future__ import annotations

import math

import numpy as np
import pytest

from reviewmill.llm.topk import top_products

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every, k, factor=256):
    whole = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(factor * float(np.float32(x))) for x in v]
        whole[i] = min(whole.get(i, ints), ints)
    width = max(map(len, whole.values()), default=0)
    whole = {i: v + [0] * (width - len(v)) for i, v in whole.items()}
    out = set()
    for q in (i for i in whole if i % every == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in whole if c != q)[:k]
        out |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(best)}
    return out


def run(spark, stage, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as block", "'x' as place", "2 as score")
    return [tuple(r) for r in top_products(frame, stage, **options).select("query_id", "rank", "vec_id", "score").collect()]


@pytest.mark.parametrize("block_rows,query_rows,head", [(16, 4, 2), (4096, 2048, 16)])
def test_equals_brute_force(spark, stage, block_rows, query_rows, head):
    draw = np.random.default_rng(2)
    rows = [(i, (draw.normal(size=12) * draw.gamma(1.0)).astype(np.float32).tolist(), 0) for i in range(300)]
    rows += [(1000 + i, rows[3][1], 0) for i in range(40)]  # ties
    rows += [(2000, None, 0), (2050, [1.0, None], 0), (2100, [float("nan")] * 12, 0), (2150, [float("inf")] + [0.0] * 11, 0), (None, [9.0] * 12, 0)]
    rows += [(2200, [0.0] * 12, 0), (2250, [], 0), (2300, [5.0, -3.0], 0), (50, rows[50][1], 0), (-50, [0.5] * 12, 0)]
    got = run(spark, stage, rows, every=50, k=5, block_rows=block_rows, query_rows=query_rows, head=head)
    assert len(got) == len(set(got)) and set(got) == brute(rows, 50, 5)


def test_few_and_none(spark, stage):
    assert run(spark, stage, []) == []
    assert run(spark, stage, [(0, [1.0], 0)]) == []
    assert set(run(spark, stage, [(0, [1.0], 0), (50, [2.0], 0), (3, [-1.0], 0)])) == brute([(0, [1.0]), (50, [2.0]), (3, [-1.0])], 50, 5)
    assert run(spark, stage, [(1, [1.0], 0), (2, [2.0], 0)]) == []
    assert run(spark, stage, [(0, [], 0), (1, [], 0)]) == []
