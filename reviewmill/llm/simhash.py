"""SimHash near-duplicates: fingerprints, sharded BK-trees, connected components.

Fingerprints that lie within the radius must agree on certain groups of bits, so every fingerprint
is filed under several shard keys and only meets the fingerprints of its own shards; by the
pigeonhole principle no pair is missed. A shard is searched with BK-trees; a shard above ``BLOCK_ROWS``
is cut into blocks, and the tree of each block is sent - by the shuffle, never through the driver,
because trees grow with the corpus - to every block that has to be searched in it. A task returns the
links that hold its groups together, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.llm.bktree import forest_links
from reviewmill.llm.common import complete_groups, slices, utf8
from reviewmill.llm.components import connected_components
from reviewmill.operators.joins import broadcast_if_small
from reviewmill.staging import Stage

SEED = 42
BLOCK_ROWS = 1024
COUNT_AT_ONCE = 1 << 16


# --- shingles and fingerprints --------------------------------------------------------------------

def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words, repeats included, A-Z lower-cased.

    A text with fewer words is one shingle; a text without words has none.
    """
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    starts = [0]
    for part in parts:
        starts.append(starts[-1] + len(part) + 1)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[words:])], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """64 bits; a bit is 1 when it is set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), COUNT_AT_ONCE):
        part = hashes[start : start + COUNT_AT_ONCE]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _prints(texts: pa.Array, shingle_words: int) -> pa.Array:
    found = [fingerprint(shingle_hashes(t.as_py(), shingle_words)) for t in utf8(texts)]
    return pa.array(np.array(found, np.uint64).view(np.int64))


def fingerprint_table(docs: DataFrame, shingle_words: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp0): 64 bits over all shingles, repeats included; null texts have no words."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _prints(batch.column("text"), shingle_words)], ["doc_id", "fp0"])

    source = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return source.mapInArrow(marks, "doc_id bigint, fp0 bigint")


def with_fingerprint(docs: DataFrame, name: str, shingle_words: int) -> DataFrame:
    """``docs`` plus a column of fingerprints."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.append_column(name, _prints(batch.column("text"), shingle_words))

    return docs.mapInArrow(marks, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


# --- shards ------------------------------------------------------------------------------------------

def pigeonhole_keys(bits: int, radius: int, agree: int = 2) -> list[list[int]]:
    """Bit positions per key such that near fingerprints agree on all bits of at least one key.

    Cut into radius + agree runs, at least ``agree`` runs hold no differing bit.
    """
    runs = [list(map(int, r)) for r in np.array_split(np.arange(bits), radius + agree)]
    return [sum(chosen, []) for chosen in combinations(runs, agree)]


def _words_of(batch) -> np.ndarray:
    names = [n for n in batch.schema.names if n.startswith("fp")]
    columns = [batch.column(n).to_numpy() for n in names]
    return np.ascontiguousarray(np.column_stack(columns)).view(np.uint64)


def shard_keys(nodes: DataFrame, keys: Sequence[Sequence[int]]) -> DataFrame:
    """(key, id), one row per fingerprint and key: the key's number and its bits."""

    def file_under(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            raw = _words_of(batch)
            bits = np.unpackbits(raw.view(np.uint8), axis=1, bitorder="little")
            for number, positions in enumerate(keys):
                value = bits[:, positions].astype(np.int64) @ (np.int64(1) << np.arange(len(positions), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(value + (number << 40)), batch.column("id")], ["key", "id"])

    return nodes.mapInArrow(file_under, "key bigint, id bigint")


def block_pairs(rows: DataFrame, group: Sequence[str], blocks: str) -> DataFrame:
    """Rows of every group dealt over its number of ``blocks`` and sent to all tasks of their block.

    Task (i, j) with i <= j holds blocks i and j; together the tasks see every pair of rows.
    Adds ``shard`` (the task), ``one`` (row is of block i) and ``two`` (row is of block j).
    """
    mine, other = F.col("_mine"), F.col("_other")
    return (
        rows.withColumn("_mine", F.pmod(F.xxhash64("id", F.lit(1)), F.col(blocks)))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(blocks) - 1)))
        .withColumn("shard", F.xxhash64(*group, F.least(mine, other), F.greatest(mine, other)))
        .withColumn("one", mine <= other)
        .withColumn("two", mine >= other)
        .drop("_mine", "_other", blocks)
    )


def near_links(nodes: DataFrame, keys: Sequence[Sequence[int]], radius: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): links between ids of ``nodes`` (id, fp0..) that hold near fingerprints together."""
    names = [n for n in nodes.columns if n.startswith("fp")]
    filed = shard_keys(nodes.select("id", *names), keys)
    sizes = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block_rows).cast("bigint")
    shared = filed.join(sizes, "key").withColumn("blocks", blocks).drop("n")
    dealt = block_pairs(shared, ["key"], "blocks").join(nodes.select("id", *names), "id")

    def search_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in complete_groups(batches, "shard"):
            ids = table.column("id").to_numpy()
            shard = table.column("shard").to_numpy()
            tree = np.cumsum(np.concatenate([[0], shard[1:] != shard[:-1]]))
            one, two = (table.column(c).to_numpy(zero_copy_only=False) for c in ("one", "two"))
            label = forest_links(_words_of(table), tree, two, one, radius)
            row = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(ids[label[row]])], ["a", "b"])

    ordered = dealt.select("shard", "id", "one", "two", *names).repartition("shard").sortWithinPartitions("shard")
    return ordered.mapInArrow(search_shards, "a bigint, b bigint")


def fingerprint_classes(marks: DataFrame, stage: Stage, radius: int) -> DataFrame:
    """(fp0, class, component_id) per distinct fingerprint of ``marks`` (doc_id, fp0).

    ``component_id`` is the smallest doc_id of the class, null when no row of it has one.
    """
    distinct = stage.put(
        marks.groupBy("fp0").agg(F.min("doc_id").alias("least")).withColumn("id", F.col("fp0")), "distinct_fingerprints"
    )
    links = near_links(distinct, pigeonhole_keys(64, radius), radius)
    parts = connected_components(links, "a", "b", stage)
    classes = distinct.join(parts, distinct["id"] == parts["node"], "left").select(
        "fp0", "least", F.coalesce("component", "id").alias("class")
    )
    named = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    return classes.join(named, "class").select("fp0", "class", "component_id")


def simhash_classes(docs: DataFrame, stage: Stage, shingle_words: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    Fingerprints at ``radius`` or fewer differing bits are linked; ``component_id`` is the smallest
    doc_id reachable. Null and blank texts have fingerprint zero and are linked like any other.
    Rows with a null doc_id are classified, but never name a class (null when there is no other).
    Repeated rows are repeated in the result; other columns are ignored.
    """
    marks = stage.put(fingerprint_table(docs, shingle_words), "fingerprints")
    named = fingerprint_classes(marks, stage, radius).select("fp0", "component_id")
    hexed = F.lpad(F.lower(F.hex("fp0")), 16, "0")
    return marks.join(named, "fp0").select("doc_id", hexed.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, stage: Stage, shingle_words: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one document of each class of ``simhash_classes``: the one with the smallest doc_id.

    Of several rows with that id, and in a class without ids, one stays, the same one in every run. All columns
    are kept as they are. Rows that have an id of their own are judged by id, so no text
    moves for them; only rows without such an id are looked at again.
    """
    marks = stage.put(fingerprint_table(docs, shingle_words), "fingerprints")
    classes = stage.put(fingerprint_classes(marks, stage, radius), "classes")
    judged = marks.join(classes, "fp0")
    gone = stage.put(judged.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    repeated = marks.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_again")).count().filter("count > 1")
    repeated = broadcast_if_small(stage.put(repeated.select("_again"), "repeated_ids"))
    again = docs["doc_id"] == F.col("_again")
    once = docs.filter(docs["doc_id"].isNotNull()).join(repeated, again, "left_anti")
    once = once.join(broadcast_if_small(gone), once["doc_id"] == F.col("_gone"), "left_anti")
    others = docs.filter(docs["doc_id"].isNull()).unionByName(docs.join(repeated, again, "left_semi"))
    sides = classes.select(F.col("fp0").alias("_other"), F.col("class").alias("_class"), F.col("component_id").alias("_least"))
    others = with_fingerprint(others, "_print", shingle_words).join(sides, F.col("_print") == F.col("_other"))
    first = Window.partitionBy("_class").orderBy(F.xxhash64("text"), "text")
    others = others.filter(F.col("doc_id").eqNullSafe(F.col("_least"))).withColumn("_place", F.row_number().over(first))
    return once.unionByName(others.filter("_place = 1").select(*docs.columns))
