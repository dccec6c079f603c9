"""Source divergence audit: how the words of a source differ from its language and from other sources.

Terms are runs of letters; a language keeps those in at least ``least_docs`` of its documents. Counts
become smoothed shares in billionths, p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and two shares differ by
floor((p - q)^2 / (p + q)). All of it is whole-number arithmetic.

* ``pair``: the difference between two sources of a language, summed over its kept terms. A kept term
  is one row with its shares in all sources of the language; a task adds up a sources-by-sources table
  over its rows and emits that table alone.
* ``term``: the ``top`` terms that a source uses more than its language does, by a dominance skyband. The
  difference grows with the source's count and shrinks with the language's, so a term cannot be
  ranked when ``top`` others have at least its source count, at most its language count and an
  earlier place in UTF-8 order. Every partition keeps the terms dominated by fewer others, the
  skybands of the partitions are merged the same way, and what is left is ranked exactly.

No task holds the terms of a source: they are spread by term, and skybands meet in merges.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import slices, utf8
from reviewmill.operators.joins import broadcast_if_small
from reviewmill.staging import Stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# By byte of a UTF-8 text: its lower case, and whether it belongs to a term. Terms are ASCII letters and
# characters beyond ASCII, all of whose bytes are 0x80 or more.
LOWERED = np.frombuffer(bytes(range(256)).lower(), np.uint8)
IN_TERM = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])
# Texts are counted in slices of this many bytes.
COUNT_BYTES = 6 << 20
SMOOTHING = 2
# Skybands of this many buckets per source meet in the first merge.
MERGE_BUCKETS = 16
# Rows times sources whose differences are added up at once.
CELLS_AT_ONCE = 1 << 18


# --- counts ----------------------------------------------------------------------------------------------

def terms_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row, term) of all terms of binary ``texts`` in order, A-Z lower-cased."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    first = int(offsets[0])
    # Empty texts may come without a buffer of bytes.
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[first : int(offsets[-1])]
    inside = IN_TERM[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    # A term ends with its text.
    edges = offsets[:-1][np.diff(offsets) > 0] - first
    begins[edges] = inside[edges]
    begin = np.flatnonzero(begins)
    row = np.searchsorted(offsets - first, begin, "right") - 1
    bounds = np.append(np.cumsum(inside)[begin] - 1, np.count_nonzero(inside)).astype(np.int32)
    letters = LOWERED[data[inside]]
    return row, pa.StringArray.from_buffers(len(begin), pa.py_buffer(bounds), pa.py_buffer(letters))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, holders): occurrences, and documents that hold the term.

    A slice of texts is counted as a whole, so what reaches the aggregate is a row per term and group of
    the slice.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", COUNT_BYTES):
            row, terms = terms_of(utf8(batch.column("text")))
            if not len(terms):
                continue
            terms = terms.dictionary_encode()
            langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
            width = len(terms.dictionary)
            held, n = np.unique(row * width + terms.indices.to_numpy(), return_counts=True)
            group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            key = group[held // width] * width + held % width
            order = np.argsort(key, kind="stable")
            key, edges, holders = np.unique(key[order], return_index=True, return_counts=True)
            group, code = key // width, key % width
            columns = [
                langs.dictionary.take(pa.array(group // len(sources.dictionary))),
                sources.dictionary.take(pa.array(group % len(sources.dictionary))),
                terms.dictionary.take(pa.array(code)),
                pa.array(np.add.reduceat(n[order], edges)),
                pa.array(holders),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "holders"])

    texts = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    counted = texts.mapInArrow(count, "lang string, source string, term string, n bigint, holders bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("holders").alias("holders"))


def share(count, size, div=lambda a, b: F.call_function("div", a, b)):
    """1 + floor(10^9 count / size) by long division, three digits at a time; for columns and numpy arrays.

    Exact for sizes below 9 * 10^15; a product with 10^9 would overflow from 9 * 10^9 words on.
    """
    digits, rest = div(count, size), count % size
    for _ in range(3):
        digits, rest = digits * 1000 + div(rest * 1000, size), rest * 1000 % size
    return digits + 1


def difference(p, q, div=lambda a, b: F.call_function("div", a, b)):
    """floor((p - q)^2 / (p + q)); shares are at most 10^9 + 1, so squares fit into 63 bits."""
    return div((p - q) * (p - q), p + q)


class Audit:
    """Stored tables of one audit.

    ``kept``: (lang, term, total, by_source), one row per kept term; ``by_source`` holds (source, n) of the
    sources that use it. ``groups``: (lang, source, size, lang_size) for every group that occurs;
    the sizes are N + 2 V. ``languages``: (lang, sources, sizes), sources in UTF-8 order.
    """

    def __init__(self, docs: DataFrame, stage: Stage, least_docs: int = 10):
        blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
        docs = docs.select(blank("lang"), blank("source"), blank("text"))
        kept = (
            term_counts(docs)
            .groupBy("lang", "term")
            .agg(F.sum("n").alias("total"), F.sum("holders").alias("holders"), F.collect_list(F.struct("source", "n")).alias("by_source"))
            .filter(F.col("holders") >= least_docs)
        )
        self.stage = stage
        self.kept = stage.put(kept.drop("holders"), "kept_terms")
        used = self.kept.select("lang", F.inline("by_source")).groupBy("lang", "source").agg(F.sum("n").alias("used"))
        whole = self.kept.groupBy("lang").agg(F.sum("total").alias("lang_used"), F.count(F.lit(1)).alias("terms"))
        smooth = SMOOTHING * F.coalesce("terms", F.lit(0))
        groups = docs.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(whole, "lang", "left")
        self.groups = stage.put(
            groups.select(
                "lang", "source",
                (F.coalesce("used", F.lit(0)) + smooth).alias("size"),
                (F.coalesce("lang_used", F.lit(0)) + smooth).alias("lang_size"),
            ),
            "groups",
        )
        rows = F.array_sort(F.collect_list(F.struct("source", "size")))
        languages = self.groups.groupBy("lang").agg(rows.alias("rows"))
        self.languages = stage.put(languages.select("lang", F.col("rows.source").alias("sources"), F.col("rows.size").alias("sizes")), "languages")

    def pairs(self, block_sources: int = 512) -> DataFrame:
        """(lang, source, item, value): every ordered pair of different sources of a language.

        Above ``block_sources`` sources a kept term goes to every pair of blocks, so a task's table stays
        within that width.
        """
        blocks = F.ceil(F.size("sources") / block_sources).cast("int")
        dealt = F.flatten(
            F.transform(
                F.sequence(F.lit(0), blocks - 1),
                lambda i: F.transform(F.sequence(i, blocks - 1), lambda j: F.struct(i.alias("rows"), j.alias("columns"))),
            )
        )
        wide = self.kept.join(broadcast_if_small(self.languages), "lang").select(
            "lang", "by_source", "sources", "sizes", F.inline(dealt)
        )
        ordered = wide.sortWithinPartitions("lang", "rows", "columns")
        parts = ordered.mapInArrow(lambda batches: _pair_tables(batches, block_sources), "lang string, a string, b string, value bigint")
        sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
        both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
        sums = sums.select("lang", "value", F.inline(both))
        # Also languages without a kept term have pairs.
        every = self.languages.select("lang", "sources", F.explode("sources").alias("source"))
        every = every.select("lang", "source", F.explode("sources").alias("item")).filter("source <> item")
        return every.join(sums, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)))

    def terms(self, top: int = 10) -> DataFrame:
        """(lang, source, item, value, rank): the ``top`` terms that a source uses more than its language."""
        used = self.kept.select("lang", "term", "total", F.inline("by_source"))
        valued = (
            used.join(broadcast_if_small(self.groups), ["lang", "source"])
            .withColumn("p", share(F.col("n") + SMOOTHING, F.col("size")))
            .withColumn("q", share(F.col("total") + SMOOTHING, F.col("lang_size")))
            .filter("p > q")
            .select("lang", "source", "term", "n", "total", "p", "q")
        )
        found = skyband(valued, top)
        found = skyband(found.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(MERGE_BUCKETS))), top)
        found = skyband(found.repartition("lang", "source"), top)
        place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        return (
            found.select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(place))
            .filter(F.col("rank") <= top)
        )


def _pair_tables(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows of (lang, a, b, value), one table for each run of equal lang and blocks."""
    held, table = None, None

    def emit():
        lang, sources, i, j = held
        a, b = np.nonzero(table if i < j else np.triu(table, 1))
        names = [pa.array(sources[k * width : (k + 1) * width], pa.string()) for k in (i, j)]
        columns = [pa.array([lang] * len(a), pa.string()), names[0].take(pa.array(a)), names[1].take(pa.array(b)), pa.array(table[a, b])]
        return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])

    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = [batch.column(c).dictionary_encode().indices.to_numpy() for c in ("lang", "rows", "columns")]
        edges = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
        for start, stop in zip([0, *edges], [*edges, batch.num_rows]):
            part = batch.slice(start, stop - start)
            lang, i, j = (part.column(c)[0].as_py() for c in ("lang", "rows", "columns"))
            if held is None or (held[0], *held[2:]) != (lang, i, j):
                if held:
                    yield emit()
                sources = part.column("sources")[0].as_py()
                held = (lang, sources, i, j)
                index = pa.array(sources, pa.string())
                sizes = np.array(part.column("sizes")[0].as_py(), np.int64)
                table = np.zeros((len(sources[i * width : (i + 1) * width]), len(sources[j * width : (j + 1) * width])), np.int64)
            step = max(1, CELLS_AT_ONCE // len(sizes))
            for first in range(0, part.num_rows, step):
                _add_differences(table, part.column("by_source").slice(first, step), index, sizes, i * width, j * width)
    if held:
        yield emit()


def _add_differences(table: np.ndarray, by_source: pa.Array, index: pa.Array, sizes: np.ndarray, top: int, left: int) -> None:
    row = pc.list_parent_indices(by_source).to_numpy()
    cells = pc.list_flatten(by_source)
    counts = np.zeros((len(by_source), len(sizes)), np.int64)
    counts[row, pc.index_in(cells.field("source"), index).to_numpy()] = cells.field("n").to_numpy()
    shares = share(counts + SMOOTHING, sizes[None, :], np.floor_divide)
    columns = shares[:, left : left + table.shape[1]]
    for k in range(len(table)):
        own = shares[:, top + k, None]
        # On the diagonal block only the pairs above the diagonal are wanted.
        skip = k + 1 if top == left else 0
        table[k, skip:] += difference(own, columns[:, skip:], np.floor_divide).sum(axis=0)


# --- skyband -----------------------------------------------------------------------------------------------

class Skyband:
    """Terms of one source dominated by fewer than ``k`` others, fed in UTF-8 order.

    Dominators come earlier, and a term dominated by ``k`` others is dominated by ``k`` members of
    the skyband, so members are final and nothing else is held.
    """

    def __init__(self, k: int):
        self.k, self.n, self.total = k, [], []
        self._steps()

    def _steps(self) -> None:
        """For every source count among the members: the k-th smallest language count from there up."""
        self.counts, self.limits, least = [], [], []
        for n, total in sorted(zip(self.n, self.total), reverse=True):
            heapq.heappush(least, -total)
            if len(least) > self.k:
                heapq.heappop(least)
            if len(least) == self.k:
                self.counts.append(n)
                self.limits.append(-least[0])
        self.counts, self.limits = np.array(self.counts[::-1], np.int64), np.array(self.limits[::-1], np.int64)

    def feed(self, n: np.ndarray, total: np.ndarray) -> list[int]:
        """Positions of the new members."""
        members = []
        at = np.searchsorted(self.counts, n, "left")
        known = at < len(self.counts)
        limit = np.full(len(n), np.iinfo(np.int64).max)
        limit[known] = self.limits[at[known]]
        own_n, own_total = np.array(self.n, np.int64), np.array(self.total, np.int64)
        for i in np.flatnonzero(total < limit).tolist():
            if len(own_n) < len(self.n):
                own_n, own_total = np.array(self.n, np.int64), np.array(self.total, np.int64)
            if np.count_nonzero((own_n >= n[i]) & (own_total <= total[i])) < self.k:
                self.n.append(int(n[i]))
                self.total.append(int(total[i]))
                members.append(i)
        if members:
            self._steps()
        return members


def skyband(terms: DataFrame, k: int, at_once: int = 512) -> DataFrame:
    """Per partition, lang and source the terms dominated by fewer than ``k`` others of that partition.

    ``terms`` has lang, source, term, n (source count) and total (language count); a term dominates another
    with n not above, total not below and a later place in UTF-8 order.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, band = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = [batch.column(c).dictionary_encode().indices.to_numpy() for c in ("lang", "source")]
            edges = np.flatnonzero(np.any([np.diff(x) != 0 for x in keys], axis=0)) + 1
            n, total = (batch.column(c).to_numpy() for c in ("n", "total"))
            members = []
            for start, stop in zip([0, *edges], [*edges, batch.num_rows]):
                group = (batch.column("lang")[int(start)].as_py(), batch.column("source")[int(start)].as_py())
                if group != held:
                    held, band = group, Skyband(k)
                for first in range(start, stop, at_once):
                    last = min(stop, first + at_once)
                    members += [int(first) + i for i in band.feed(n[first:last], total[first:last])]
            yield batch.take(pa.array(members, pa.int64()))

    return terms.sortWithinPartitions("lang", "source", "term").mapInArrow(search, terms.schema)


def source_divergence(docs: DataFrame, stage: Stage, least_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank) of both parts; ranks by value, then item in UTF-8 order.

    Null text, lang and source count as empty; every row is a document, repeated rows too; other columns are
    ignored. Groups without terms take part in ``pair``; without kept terms all its values are 0. A language
    with a single source has no pairs. An empty table gives an empty result.
    """
    audit = Audit(docs, stage, least_docs)
    place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = audit.pairs().withColumn("rank", F.row_number().over(place)).withColumn("part", F.lit("pair"))
    terms = audit.terms(top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))
