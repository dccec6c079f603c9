"""Main text of pages, with nearest-URL page differencing.

After the page-differencing idea of Bar-Yossef & Rajagopalan, "Template detection via data mining and its
applications", WWW 2002: pages of a host that are neighbours in URL order share its template. Every
page is paired with the page before it in its host's path order (the first with the one behind it),
their text lines are aligned by a longest common subsequence, and shared lines are deleted.

An article element is taken at its word: shared lines are deleted around it, not inside it, since the
articles of two pages may share short lines or be copies.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import slices
from reviewmill.llm.html_blocks import ARTICLE, main_region, page_blocks
from reviewmill.llm.urls import _host, _path, _rest

ROWS_BYTES = 32 << 20
NO_ID = -(1 << 63)


# --- longest common subsequence -----------------------------------------------------------------------

def _rows(a: Sequence, b: Sequence, keep: bool) -> list[int]:
    """Bit vectors of the LCS table, one per item of ``a`` (only the last unless ``keep``).

    Bit j is 0 where the LCS with b[: j + 1] is longer than with b[:j].
    """
    places: dict = {}
    for j, item in enumerate(b):
        places[item] = places.get(item, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, rows = full, []
    for item in a:
        u = v & places.get(item, 0)
        v = ((v + u) | (v - u)) & full
        if keep:
            rows.append(v)
    return rows if keep else [v]


def _lengths(v: int, width: int) -> list[int]:
    """LCS lengths with b[:0], b[:1], .. from a bit vector."""
    out = [0]
    for mark in bin(v | 1 << width)[:2:-1]:
        out.append(out[-1] + (mark == "0"))
    return out


def common_positions(a: Sequence, b: Sequence) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of ``a`` and ``b``.

    Memory stays below ``ROWS_BYTES`` by splitting ``a`` in the middle (Hirschberg).
    """
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    tail = 0
    while tail < min(len(a), len(b)) - start and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    head, end = list(range(start)), list(range(len(a) - tail, len(a)))
    x, y = a[start : len(a) - tail], b[start : len(b) - tail]
    if not x or not y:
        return head + end
    if len(x) > 1 and len(x) * len(y) // 8 > ROWS_BYTES:
        half = len(x) // 2
        left = _lengths(_rows(x[:half], y, False)[0], len(y))
        right = _lengths(_rows(x[half:][::-1], y[::-1], False)[0], len(y))[::-1]
        cut = max(range(len(y) + 1), key=lambda j: left[j] + right[j])
        inner = common_positions(x[:half], y[:cut]) + [half + i for i in common_positions(x[half:], y[cut:])]
    else:
        rows, inner, i, j = _rows(x, y, True), [], len(x), len(y)
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if not i or rows[i - 1] >> (j - 1) & 1:
                    j -= 1
                    inner.append(i)
        inner.reverse()
    return head + [start + i for i in inner] + end


# --- pages ----------------------------------------------------------------------------------------------

def pack(blocks: list[tuple[int, str]]) -> bytes:
    return zlib.compress("\n".join(f"{region}{line}" for region, line in blocks).encode("utf-8", "surrogatepass"), 1)


def unpack(data: bytes) -> list[tuple[int, str]]:
    text = zlib.decompress(data).decode("utf-8", "surrogatepass")
    return [(int(line[0]), line[1:]) for line in text.split("\n")] if text else []


def main_text(own: list[tuple[int, str]], other: list[tuple[int, str]] | None) -> tuple[str, int]:
    """Main text of a page next to another one, and the number of shared lines deleted.

    A page without an article that shares all its lines is a copy, which tells nothing about a
    template; it keeps them.
    """
    lines = [(r, t) for r, t in own if t]
    shared: set[int] = set()
    if other:
        shared = set(common_positions([t for _, t in lines], [t for _, t in other if t]))
    region = main_region(own)
    deleted = {i for i in shared if lines[i][0] != ARTICLE}
    if region != ARTICLE and len(deleted) == len(lines):
        deleted = set()
    kept = [t for i, (r, t) in enumerate(lines) if r == region and i not in deleted]
    return "\n".join(kept), len(deleted)


def extract_pages(pages: DataFrame, parts_per_partition: int = 4) -> DataFrame:
    """(page_id, url, text, n_chars, n_shared), one row per row of ``pages``.

    The text is the article without boilerplate, blocks joined by newlines; ``n_shared`` counts lines
    deleted because the neighbouring page has them. Null html is empty text. Pages with a null
    url, or one without ``://``, are neighbours of each other under an empty host. Repeated rows are
    repeated in the result; other columns are ignored.

    Pages are dealt over ranges of (host, path), many per partition, so a host of any size is
    spread; the pages at both ends of a range are sent to the next range too. Only compressed text
    is shuffled.
    """
    spark = pages.sparkSession
    rest = F.col("rest")
    named = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        _rest(F.coalesce("url", F.lit(""))).alias("rest"), F.coalesce("html", F.lit("")).alias("html"),
    ).select(
        "page_id", "url", _host(rest).alias("host"), _path(rest).alias("path"),
        F.coalesce("url", F.lit("")).alias("at_url"), F.coalesce("page_id", F.lit(NO_ID)).alias("at_id"), "html",
    )
    order = ["host", "path", "at_url", "at_id"]
    parts = parts_per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = named.select(*order).repartitionByRange(parts, *order).select(F.struct(*order).alias("key"), F.spark_partition_id().alias("part"))
    bounds = ranged.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high")).orderBy("high").collect()  # parts rows
    lows, highs = [tuple(r["low"]) for r in bounds], [tuple(r["high"]) for r in bounds]
    names = ["block", "again", *order, "page_id", "url", "data"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            rows = []
            for row in batch.to_pylist():
                key = tuple(row[c] for c in order)
                block = min(bisect_left(highs, key), len(highs) - 1)
                data = pack(page_blocks(row["html"]))
                rest = (*key, row["page_id"], row["url"], data)
                rows.append((block, False, *rest))
                if key == highs[block] and block + 1 < len(highs):
                    rows.append((block + 1, True, *rest))
                if key == lows[block] and block:
                    rows.append((block - 1, True, *rest))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    kinds = [pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    schema = "block int, again boolean, host string, path string, at_url string, at_id bigint, page_id bigint, url string, data binary"
    parsed = named.select(*order, "page_id", "url", "html").mapInArrow(parse, schema)

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(page, before, after):
            near = next((p for p in (before, after) if p and (p["block"], p["host"]) == (page["block"], page["host"])), None)
            return page["page_id"], page["url"], *main_text(page["blocks"], near and near["blocks"])

        def pages_in_order():
            for batch in slices(batches, "data"):
                for row in batch.to_pylist():
                    row["blocks"] = unpack(row.pop("data"))
                    yield row

        def out(rows):
            text = [r[2] for r in rows]
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array(text, pa.string())]
            columns += [pa.array([len(t) for t in text], pa.int64()), pa.array([r[3] for r in rows], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars", "n_shared"])

        before = page = None
        rows, size = [], 0
        for after in pages_in_order():
            if page and not page["again"]:
                rows.append(finished(page, before, after))
                size += len(rows[-1][2])
            before, page = page, after
            if size > 4 << 20:
                yield out(rows)
                rows, size = [], 0
        if page and not page["again"]:
            rows.append(finished(page, before, None))
        if rows:
            yield out(rows)

    dealt = parsed.repartition("block").sortWithinPartitions("block", *order, "again")
    return dealt.mapInArrow(difference, "page_id bigint, url string, text string, n_chars bigint, n_shared bigint")
