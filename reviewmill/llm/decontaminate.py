"""Benchmark leaks by spaced-seed hashing.

After Ma, Tromp & Li, "PatternHunter: faster and more sensitive homology search", 2002. A mask picks some of
the tokens of a window; the others may differ. Windows of the documents and of the benchmark with
the same hash under the same mask meet in a join, and around every hit the two token sequences
are compared without gaps, so that a passage with replaced words is found as a whole.

Documents send only windows that pass two bit maps of the benchmark's hashes. The maps have a fixed
size and never reject a true hit, so what is shuffled follows the leaks and not the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import slices
from reviewmill.operators.joins import broadcast_if_small
from reviewmill.staging import Stage

# Fixed masks: 1 is compared, 0 is ignored. Seven tokens each. Together they meet every stretch of 12 or more
# equal tokens at an identity of 0.8: all patterns of 1 change in 13 tokens, 2 in 14, 3 in 15, 4 in 20 and
# 5 in 25 hit a mask, and every such stretch holds one of those lengths with at most as many changes.
MASKS = ("111001000111", "11101111", "111000101101", "110101010011", "1100110111", "1001011111")
SPAN = max(len(mask) for mask in MASKS)
LEAST_ITEM_WORDS = 5
MAP_BITS = 24
# Outer characters that are no part of a token.
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + " ‘’“”…«»–—"


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts in a row, and where each text's tokens end.

    Tokens are lower-cased words without outer punctuation; what has nothing else is no token.
    """
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    flat = lists.flatten().dictionary_encode()
    words = [w.strip(EDGES) for w in flat.dictionary.to_pylist()]
    known = np.array([xxhash.xxh64_intdigest(w.encode()) if w else 0 for w in words], np.uint64)
    code = flat.indices.to_numpy()
    hashes = known[code] if len(code) else np.empty(0, np.uint64)
    real = np.array([bool(w) for w in words], bool)[code] if len(code) else np.empty(0, bool)
    ends = np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))
    kept = np.concatenate([[0], np.cumsum(real)])
    return hashes[real], kept[ends.astype(np.int64)]


def masks_for(short: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Token positions per mask: the fixed masks, then one full mask per shorter item length."""
    fixed = [tuple(i for i, c in enumerate(mask) if c == "1") for mask in MASKS]
    return fixed + [tuple(range(n)) for n in short]


def window_hashes(tokens: np.ndarray, positions: tuple[int, ...], number: int) -> np.ndarray:
    """Hash of the masked tokens of every window; a window is as long as the mask."""
    span = positions[-1] + 1
    n = len(tokens) - span + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, number + 1, np.uint64)
    for at in positions:
        total = (total ^ tokens[at : at + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(31)
    return total


def benchmark_tokens(benchmark: DataFrame) -> DataFrame:
    """(item_id, tokens): items with at least ``LEAST_ITEM_WORDS`` tokens; shorter ones identify nothing."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, ends = token_hashes(batch.column("text").fill_null(""))
            parts = [p.view(np.int64) for p in np.split(hashes, ends[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(parts, pa.list_(pa.int64()))], ["item_id", "tokens"])

    source = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    found = source.filter("item_id is not null").mapInArrow(tokens, "item_id bigint, tokens array<bigint>")
    return found.filter(F.size("tokens") >= LEAST_ITEM_WORDS)


def benchmark_windows(items: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    """(hash, item_id, item_at) of every window of every item under every mask.

    A full mask for short items is only applied to items of just that length.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, cell in zip(batch.column("item_id").to_pylist(), batch.column("tokens")):
                tokens = np.array(cell.as_py(), np.int64).view(np.uint64)
                for number, positions in enumerate(masks):
                    if number >= len(MASKS) and len(tokens) != len(positions):
                        continue
                    hashes = window_hashes(tokens, positions, number).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes), pa.array(np.full(len(hashes), item)), pa.array(np.arange(len(hashes), dtype=np.int32))],
                        ["hash", "item_id", "item_at"],
                    )

    return items.mapInArrow(windows, "hash bigint, item_id bigint, item_at int")


def bit_map(windows: DataFrame, shift: int) -> np.ndarray:
    """2^MAP_BITS bits, one for each value of the chosen bits of the hashes in ``windows``.

    At most 2^(MAP_BITS - 6) words reach the driver, however many windows there are.
    """
    place = F.shiftrightunsigned("hash", shift).bitwiseAND((1 << MAP_BITS) - 1)
    word = windows.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {shift}) & 63 as int))")).alias("bits")
    )
    bits = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for row in word.collect():
        bits[row["word"]] = row["bits"]
    return bits.view(np.uint64)


def _marked(bits: np.ndarray, hashes: np.ndarray, shift: int) -> np.ndarray:
    place = (hashes >> np.uint64(shift)) & np.uint64((1 << MAP_BITS) - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def document_windows(docs: DataFrame, masks: list[tuple[int, ...]], low: np.ndarray, high: np.ndarray) -> DataFrame:
    """(doc_id, tokens, hits): documents with windows that both maps know, and those windows."""
    hit_type = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32())]))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, ends = token_hashes(batch.column("text").fill_null(""))
            starts = np.concatenate([[0], ends[:-1]])
            owner = np.repeat(np.arange(len(ends)), ends - starts)
            rows, places, found = [], [], []
            for number, positions in enumerate(masks):
                window = window_hashes(hashes, positions, number)
                at = np.flatnonzero(_marked(low, window, 0))
                at = at[_marked(high, window[at], MAP_BITS)]
                at = at[owner[at] == owner[at + positions[-1]]] if len(at) else at
                rows.append(owner[at])
                places.append(at - starts[owner[at]])
                found.append(window[at])
            row, place, window = np.concatenate(rows), np.concatenate(places), np.concatenate(found).view(np.int64)
            order = np.argsort(row, kind="stable")
            row, place, window = row[order], place[order], window[order]
            docs_hit, first = np.unique(row, return_index=True)
            if not len(docs_hit):
                continue
            parts = [
                [{"hash": int(h), "at": int(a)} for h, a in zip(hs, at)]
                for hs, at in zip(np.split(window, first[1:]), np.split(place, first[1:]))
            ]
            tokens = [hashes[starts[d] : ends[d]].view(np.int64) for d in docs_hit]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(docs_hit)), pa.array(tokens, pa.list_(pa.int64())), pa.array(parts, hit_type)],
                ["doc_id", "tokens", "hits"],
            )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(windows, "doc_id bigint, tokens array<bigint>, hits array<struct<hash:bigint,at:int>>")


def best_stretch(equal: np.ndarray, penalty: float) -> tuple[int, int]:
    """The stretch with the most matches, each mismatch costing ``penalty``: [start, end)."""
    gain = np.concatenate([[0.0], np.cumsum(np.where(equal, 1.0, -penalty))])
    floor = np.minimum.accumulate(gain)
    end = int(np.argmax(gain - floor))
    start = int(np.argmin(gain[: end + 1]))
    return start, end


def leaking_stretch(equal: np.ndarray, least: int, identity: float) -> tuple[int, int]:
    """[start, end) of a stretch with ``least`` matches at ``identity`` or better, (0, 0) if there is none.

    That is the best stretch at half the break-even penalty if it meets the rule. A best stretch may run
    on through a passage that falls short; then it is the one with the most matches of all that meet
    the rule: each start goes with the farthest end up to which the share of matches holds.
    """
    share = Fraction(str(identity))
    matches = np.concatenate([[0], np.cumsum(equal, dtype=np.int64)])
    if matches[-1] < least:
        return 0, 0
    start, end = best_stretch(equal, identity / (1 - identity) / 2)
    if (found := matches[end] - matches[start]) >= least and found * share.denominator >= share.numerator * (end - start):
        return start, end
    gain = matches * share.denominator - np.arange(len(matches)) * share.numerator
    ahead = np.maximum.accumulate(gain[::-1])  # the highest gain from each end on, last end first
    starts = np.flatnonzero(equal)
    ends = len(equal) - np.searchsorted(ahead, gain[starts])
    found = matches[ends] - matches[starts]
    at = int(np.argmax(found))
    if found[at] < least:
        return 0, 0
    return int(starts[at]), int(np.flatnonzero(equal[: ends[at]])[-1]) + 1


def benchmark_overlaps(
    docs: DataFrame, benchmark: DataFrame, stage: Stage, least_words: int = 12, identity: float = 0.8
) -> DataFrame:
    """(doc_id, item_id, doc_start, doc_end, item_start, item_end, matched, words), a row per leak.

    A document leaks an item when a stretch of ``least_words`` equal tokens (all of a shorter item)
    lines up without gaps and at least ``identity`` of the stretch's tokens are equal. Positions
    count tokens, ends are exclusive; the best stretch per document and item is reported (see
    ``leaking_stretch``; of several alignments the one with most matches), ties to the first. No leak is
    missed at the default ``least_words`` and ``identity`` or higher ones; at lower ones some have no seed. Case and punctuation around words do not matter. Null texts and ids and items of
    fewer than five tokens take no part; rows with one doc_id count as one document; items with one
    item_id as one item.
    """
    items = stage.put(benchmark_tokens(benchmark), "items")
    lengths = items.filter(F.size("tokens") < SPAN).select(F.size("tokens").alias("n")).distinct().collect()
    masks = masks_for(tuple(sorted(r["n"] for r in lengths)))  # fewer than SPAN lengths
    windows = stage.put(benchmark_windows(items, masks), "item_windows")
    maps = bit_map(windows, 0), bit_map(windows, MAP_BITS)
    found = document_windows(docs.filter(F.col("doc_id").isNotNull()), masks, *maps)
    found = stage.put(found.withColumn("row", F.monotonically_increasing_id()), "document_windows")
    hits = found.select("row", F.inline("hits")).join(broadcast_if_small(windows), "hash")
    lined = hits.select("row", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    pairs = (
        lined.groupBy("row", "item_id").agg(F.collect_list("shift").alias("shifts"))
        .join(broadcast_if_small(items.withColumnRenamed("tokens", "item")), "item_id")
        .join(found.select("row", "doc_id", "tokens"), "row")
    )
    names = ["doc_start", "doc_end", "item_start", "item_end", "matched", "words"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number in range(batch.num_rows):
                doc = batch.column("tokens")[number].values.to_numpy()
                item = batch.column("item")[number].values.to_numpy()
                for shift in batch.column("shifts")[number].values.to_numpy():
                    begin, end = max(0, -int(shift)), min(len(item), len(doc) - int(shift))
                    equal = item[begin:end] == doc[begin + shift : end + shift]
                    start, stop = leaking_stretch(equal, max(1, min(least_words, len(item))), identity)
                    if stop > start:
                        matched, at = int(equal[start:stop].sum()), begin + start
                        rows.append((number, at + shift, begin + stop + shift, at, begin + stop, matched, stop - start))
            if rows:
                table = np.array(rows, np.int64)
                columns = [batch.column(c).take(pa.array(table[:, 0])) for c in ("doc_id", "item_id")]
                columns += [pa.array(np.ascontiguousarray(table[:, i + 1])) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", *names])

    kinds = ", ".join(f"{n} bigint" for n in ("doc_id", "item_id", *names))
    leaks = pairs.select("doc_id", "item_id", "item", "tokens", "shifts").mapInArrow(verify, kinds)
    best = F.struct("matched", (-F.col("doc_start")).alias("d"), (-F.col("item_start")).alias("i"), (-F.col("words")).alias("w"))
    value = F.max(best).alias("best")
    ends = [(-F.col("best.d")).alias("doc_start"), (-F.col("best.d") - F.col("best.w")).alias("doc_end")]
    ends += [(-F.col("best.i")).alias("item_start"), (-F.col("best.i") - F.col("best.w")).alias("item_end")]
    return leaks.groupBy("doc_id", "item_id").agg(value).select(
        "doc_id", "item_id", *ends, F.col("best.matched").alias("matched"), (-F.col("best.w")).alias("words")
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, stage: Stage, least_words: int = 12, identity: float = 0.8) -> DataFrame:
    """``docs`` without the documents that leak a benchmark item. Rows with a null doc_id stay."""
    leaks = benchmark_overlaps(docs, benchmark, stage, least_words, identity)
    bad = stage.put(leaks.select(F.col("doc_id").alias("_leak")).distinct(), "leaking")
    return docs.join(broadcast_if_small(bad), docs["doc_id"] == bad["_leak"], "left_anti")
