"""Exact top-k inner products over vectors sorted by length.

After Teflioudi et al., "LEMP: fast retrieval of large entries in a matrix product", SIGMOD 2015, and Li et al.,
"FEXIPRO: fast and exact inner product retrieval", SIGMOD 2017. Vectors are cut into blocks by
descending length. The longest block gives every query a first bound on its k-th score; blocks
whose length cannot reach it are never sent out. In the other blocks the first coordinates after
an SVD rotation give most of each product, and Cauchy-Schwarz bounds the rest; only vectors that
may still enter the result are multiplied in full, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators.joins import broadcast_if_small
from reviewmill.staging import Stage

BLOCK_ROWS = 4096
QUERY_ROWS = 2048
SLOT_BITS = 33
SLACK = 1e-6


def scaled(embedding: Column, factor: int) -> Column:
    """floor(factor * x) of every component, as whole numbers."""
    return F.transform(embedding, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("bigint"))


def whole_vectors(vectors: DataFrame, factor: int = 256) -> DataFrame:
    """(vec_id, v): usable vectors in whole numbers, one per vec_id (the smallest, if they differ)."""
    broken = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    usable = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(~broken)
    rows = usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled(F.col("embedding"), factor).alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of the vectors, strongest first, from one width x width sum."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = matrix(batch.column("v"), width).astype(float)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["cell", "part"])

    cells = vectors.select("v").mapInArrow(gram, "cell bigint, part double").groupBy("cell").agg(F.sum("part").alias("part"))
    total = np.zeros(width * width)
    for row in cells.collect():  # width^2 numbers
        total[row["cell"]] = row["part"]
    _, axes = np.linalg.eigh(total.reshape(width, width))
    return np.ascontiguousarray(axes[:, ::-1])


def matrix(lists, width: int) -> np.ndarray:
    """Rows of a list column as an integer matrix; short vectors are filled with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), width), np.int64)
    start = np.cumsum(size) - size
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(start, size)] = flat
    return out


def best_of_block(ids, block, query_ids, queries, floor, k: int, head: int, axes: np.ndarray) -> pd.DataFrame:
    """The k best vectors of a block per query, among those that can reach the query's ``floor``.

    Products of whole numbers are exact in doubles up to 2^53; larger ones are taken as integers.
    """
    turned, asked = block @ axes, queries @ axes
    part = asked[:, :head] @ turned[:, :head].T
    rest = np.linalg.norm(asked[:, head:], axis=1)[:, None] * np.linalg.norm(turned[:, head:], axis=1)[None, :]
    length = np.linalg.norm(asked, axis=1)[:, None] * np.linalg.norm(turned, axis=1)[None, :]
    open_ = (part + rest + SLACK * (1.0 + length) >= floor[:, None]) & (query_ids[:, None] != ids[None, :])
    rows = []
    for q in np.flatnonzero(open_.any(axis=1)):
        at = np.flatnonzero(open_[q])
        score = block[at] @ queries[q]
        order = np.lexsort((ids[at], -score))[:k]
        rows.append(pd.DataFrame({"query_id": query_ids[q], "vec_id": ids[at][order], "score": score[order]}))
    if not rows:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    return pd.concat(rows, ignore_index=True)


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_products(
    vectors: DataFrame,
    stage: Stage,
    every: int = 50,
    k: int = 5,
    factor: int = 256,
    head: int = 16,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of every query.

    Queries are the vectors whose vec_id is divisible by ``every``; candidates are all vectors with
    another vec_id. Equal scores rank by vec_id. Null vectors, vectors with a null or non-finite
    component and rows with a null vec_id take no part; rows with one vec_id count as one vector;
    vectors of different lengths are compared as if filled with zeros.
    """
    whole = stage.put(whole_vectors(vectors, factor), "whole_vectors")
    width = whole.agg(F.max(F.size("v"))).first()[0] or 0
    if not width:
        return whole.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("bigint").alias("score")
        ).limit(0)
    axes = rotation(whole, width)
    squared = F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    placed = (
        whole.withColumn("length", F.sqrt(squared))
        .repartitionByRange(F.desc("length"), F.asc("vec_id")).sortWithinPartitions(F.desc("length"), F.asc("vec_id"))
        .withColumn("place", F.monotonically_increasing_id())
    )
    within = F.floor(F.col("place").bitwiseAND((1 << SLOT_BITS) - 1) / block_rows)
    block = (F.shiftright("place", SLOT_BITS) * F.lit(1 << 20) + within).alias("block")
    blocks = stage.put(placed.select("vec_id", "v", "length", block), "blocks")
    lengths = stage.put(blocks.groupBy("block").agg(F.max("length").alias("longest"), F.count(F.lit(1)).alias("n")), "block_lengths")
    first = lengths.orderBy(F.desc("longest"), "block").first()["block"]
    n_queries = blocks.filter(F.col("vec_id") % every == 0).count()
    groups = max(1, -(-n_queries // query_rows))
    group = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("bigint").alias("group")
    asked = blocks.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "length", group)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        m = matrix(pa.array(left["v"], pa.list_(pa.int64())), width)
        q = matrix(pa.array(right["q"], pa.list_(pa.int64())), width)
        return best_of_block(left["vec_id"].to_numpy(), m, right["query_id"].to_numpy(), q, right["floor"].to_numpy(), k, head, axes)

    def scored(pairs: DataFrame, queries: DataFrame) -> DataFrame:
        """Search every (block, group) of ``pairs``; both sides are sent once per pair."""
        pairs = broadcast_if_small(pairs)
        left = blocks.select("block", "vec_id", "v").join(pairs, "block").groupBy("block", "group")
        right = queries.join(pairs, "group").groupBy("block", "group")
        return left.cogroup(right).applyInPandas(search, "query_id bigint, vec_id bigint, score bigint")

    all_groups = lengths.select("block", "longest", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("group"))
    start = stage.put(all_groups.filter(F.col("block") == first).select("block", "group"), "first_pairs")
    opening = stage.put(scored(start, asked.withColumn("floor", F.lit(float("-inf")))), "first_scores")
    kth = _ranked(opening, k).filter(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("kth"))
    bounded = stage.put(
        asked.join(kth, "query_id", "left").withColumn("floor", F.coalesce("kth", F.lit(float("-inf")))).drop("kth"), "queries"
    )
    longest_needed = bounded.groupBy("group").agg(
        F.min(F.when(F.col("length") > 0, F.col("floor") / F.col("length")).otherwise(F.lit(float("-inf")))).alias("needed")
    )
    reachable = F.col("longest") * (1 + SLACK) + SLACK >= F.col("needed")
    rest = all_groups.filter(F.col("block") != first).join(broadcast_if_small(stage.put(longest_needed, "needed")), "group")
    others = scored(stage.put(rest.filter(reachable).select("block", "group"), "pairs"), bounded)
    return _ranked(opening.unionByName(others), k).select("query_id", "rank", "vec_id", "score")
