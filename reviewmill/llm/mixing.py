"""Mixing sources to target word counts by balanced sampling with the cube method.

After Deville & Tille, "Efficient balanced sampling: the cube method", Biometrika 2004. A source that
gives a share of its words includes each document with that probability. The flight phase moves the
probabilities along directions in which neither the expected words nor the expected documents of
the source change, until they are 0 or 1; at most two per block stay open. Blocks of a source are
flown apart from each other and their few open documents meet on the next level, so a source of any
size needs no task larger than one block. In the last block of a source a dozen documents land: they are
rounded to whichever choice comes nearest to the target.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import WORD, complete_groups
from reviewmill.operators.joins import broadcast_if_small
from reviewmill.operators.keys import dense_keys
from reviewmill.staging import Stage

BLOCK_DOCS = 4096
NEAR = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


# --- targets -------------------------------------------------------------------------------------------

def source_targets(
    sized: DataFrame, stage: Stage, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """(place, source, docs, source_size, target) of ``sized`` (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and divide ``share`` times all
    words between them. A target stops at ``most`` times its source; what is left over goes to
    the others by weight until no target is above its limit. Each round is one aggregate over
    the sources, of which two sums reach the driver.
    """
    sums = sized.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    placed = dense_keys(stage.put(sums, "sources"), "place", [F.col("source").asc_nulls_last()], stage, "source_order")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") - 1) % len(weights) + 1)
    ranked = stage.put(placed.withColumn("weight", turn).withColumn("limit", F.col("source_size") * F.lit(most)), "weighted")
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * level >= F.col("limit")
        state = ranked.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, F.col("limit"))), F.lit(0.0)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if state[0] == capped or not state[2]:
            break
        capped, level = state[0], (total - state[1]) / state[2]
    target = F.least(F.col("weight") * level, F.col("limit")) if capped >= 0 else F.col("limit")
    return ranked.withColumn("target", target).select("place", "source", "docs", "source_size", "target")


# --- the cube ------------------------------------------------------------------------------------------

def flight(size: Sequence[float], prob: list[float], draw: Iterator[float]) -> None:
    """Move ``prob`` in place until at most two entries are neither 0 nor 1.

    Three open documents always have a direction that keeps both sum(prob) and
    sum(size * prob); two have one if their sizes are equal. The way along it is drawn so
    that every probability stays what it was on average.
    """
    open_, next_ = [], 0
    while True:
        while len(open_) < 3 and next_ < len(prob):
            if NEAR < prob[next_] < 1 - NEAR:
                open_.append(next_)
            next_ += 1
        x = [size[i] for i in open_]
        if len(open_) == 3 and len(set(x)) > 1:
            step = (x[1] - x[2], x[2] - x[0], x[0] - x[1])
        elif len(open_) > 1 and x[0] == x[1]:
            step = (1.0, -1.0, 0.0)
        else:
            return
        moves = [(i, u) for i, u in zip(open_, step) if u]
        ahead = min((1 - prob[i]) / u if u > 0 else prob[i] / -u for i, u in moves)
        back = min(prob[i] / u if u > 0 else (1 - prob[i]) / -u for i, u in moves)
        way = ahead if next(draw) * (ahead + back) < back else -back
        for i, u in moves:
            moved = prob[i] + way * u
            prob[i] = 0.0 if moved < NEAR else 1.0 if moved > 1 - NEAR else moved
        open_ = [i for i in open_ if 0.0 < prob[i] < 1.0]


def land(size: Sequence[float], prob: list[float]) -> None:
    """Round the open entries to the choice with the least change of words, then of documents."""
    open_ = [i for i, p in enumerate(prob) if 0.0 < p < 1.0]
    if not open_:
        return
    choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    change = choices - np.array([prob[i] for i in open_])
    words = np.abs(change @ np.array([size[i] for i in open_]))
    best = np.lexsort((np.abs(change.sum(axis=1)), np.round(words, 6)))[0]
    for i, c in zip(open_, choices[best].tolist()):
        prob[i] = float(c)


def settle(size: Sequence[float], prob: list[float], draw: Iterator[float], spare: int = 10) -> None:
    """Flight and landing of a last block, in descending order of size.

    ``spare`` documents spread over all sizes stay out of the flight, so the landing has small and
    large documents to meet the total with: at most 2^(spare + 2) choices.
    """
    aside = set(np.linspace(0, len(prob) - 1, spare).astype(int).tolist()) if len(prob) > spare else set(range(len(prob)))
    flown = [i for i in range(len(prob)) if i not in aside]
    part = [prob[i] for i in flown]
    flight([size[i] for i in flown], part, draw)
    for i, p in zip(flown, part):
        prob[i] = p
    land(size, prob)


def _level(units: DataFrame, level: int, seed: int, block_docs: int) -> DataFrame:
    """One flight over all blocks; sources that fit one block land as well."""
    blocks = F.ceil(F.col("docs") / block_docs).cast("bigint")
    block = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed + level)), F.col("blocks"))
    keyed = (
        units.withColumn("blocks", blocks).withColumn("block", block)
        .withColumn("cell", F.xxhash64("place", "block", F.lit(seed + level)))
        .repartition("cell").sortWithinPartitions("cell", F.desc("size"), F.asc_nulls_first("doc_id"))
    )
    names = ["doc_id", "place", "size", "whole", "part"]

    def fly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in complete_groups(batches, "cell"):
            cell = table.column("cell").to_numpy()
            size = table.column("size").to_numpy().astype(float).tolist()
            last = (table.column("blocks").to_numpy() == 1).tolist()
            part = table.column("part").to_numpy().tolist()
            edges = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(part)]
            for start, stop in zip(edges, edges[1:]):
                own, words = part[start:stop], size[start:stop]
                draw = iter(np.random.default_rng(abs(int(cell[start]))).random(2 * len(own) + 4).tolist())
                (settle if last[start] else flight)(words, own, draw)
                part[start:stop] = own
            columns = [table.column(n) for n in names[:-1]] + [pa.chunked_array([pa.array(part, pa.float64())])]
            yield from pa.table(columns, names=names).to_batches()

    columns = keyed.select("cell", "blocks", *names)
    return columns.mapInArrow(fly, "doc_id bigint, place int, size bigint, whole bigint, part double")


def cube_mix(
    docs: DataFrame,
    stage: Stage,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 11,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, source) for every row of ``docs``.

    ``copies`` is the whole part of target / source_size, plus one for the documents drawn by the
    cube; ``taken`` = copies * size. Sources of the same name are one source, null is one too.
    Null texts have size 0. Rows with the same or a null doc_id are separate documents. The
    draw depends on ids, sizes and ``seed`` alone, so reruns agree.
    """
    sized = stage.put(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")),
        "sized",
    )
    targets = stage.put(source_targets(sized, stage, weights, share, most), "targets")
    side = broadcast_if_small(targets.withColumnRenamed("source", "_source"))
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    whole = F.floor(ratio + NEAR).cast("bigint")
    joined = sized.join(side, sized["source"].eqNullSafe(F.col("_source")))
    units = joined.select("doc_id", "place", "size", "docs", whole.alias("whole"), F.greatest(ratio - whole, F.lit(0.0)).alias("part"))
    settled = []
    level = 0
    is_open = F.col("part").between(2 * NEAR, 1 - 2 * NEAR)
    while True:
        flown = stage.put(_level(units, level, seed, block_docs), f"flight_{level}")
        settled.append(flown.filter(~is_open))
        left = flown.filter(is_open)
        counts = stage.put(left.groupBy("place").agg(F.count(F.lit(1)).alias("docs")), f"open_{level}")
        if not counts.limit(1).count():
            break
        units = left.join(broadcast_if_small(counts), "place")
        level += 1
    drawn = settled[0]
    for part in settled[1:]:
        drawn = drawn.unionByName(part)
    copies = (F.col("whole") + F.round("part").cast("bigint")).alias("copies")
    facts = broadcast_if_small(targets.select("place", "source", "source_size", "target"))
    return drawn.select("doc_id", "place", "size", copies).join(facts, "place").select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source"
    )


def mix_documents(docs: DataFrame, stage: Stage, **options) -> DataFrame:
    """The documents that the mix takes, with ``copies``: how often each one goes in.

    Also size, source_size, target and taken; a column of ``docs`` with such a name gives way. Every row is a
    document of its own: when some doc_id is null or repeated, rows are stored with numbers and drawn by those
    (reruns agree as long as no id is null or repeated).
    """
    unclear = docs.groupBy("doc_id").count().filter("doc_id is null or count > 1")
    if unclear.isEmpty():
        numbered = docs.withColumn("_row", F.col("doc_id").cast("bigint"))
    else:
        numbered = stage.put(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    rows = numbered.select(F.col("_row").alias("doc_id"), "source", "text")
    mixed = cube_mix(rows, stage, **options).filter("copies > 0").drop("source").withColumnRenamed("doc_id", "_taken")
    mixed = stage.put(mixed, "mixed")
    plain = numbered.drop(*[c for c in mixed.columns if c != "_taken"])
    return plain.join(broadcast_if_small(mixed), F.col("_row") == F.col("_taken")).drop("_row", "_taken")
