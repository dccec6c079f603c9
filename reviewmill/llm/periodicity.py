"""Periodic runs of words: maximal repetitions by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) that is
long enough and cannot be extended with that period. Per text:

1. **Cut.** Inside a run of ``least_powers`` periods every stretch of ``GRAM`` words comes back one
   period away. Words that lie in no repeated gram of their stretch are cut away and the rest is
   looked at again, until nothing changes. Equal grams are told by 64-bit hashes, so a collision can
   only keep words; no run is lost. Ordinary prose vanishes here.
2. **Access.** Over every stretch left a suffix automaton is built. A link-cut tree holds its suffix
   links; each preferred path carries the word number at which its strings ended last. Appending
   word i accesses the automaton's state of the prefix: the paths met on the way to the root are
   the strings that end at i, cut into segments by their last end e. When d = i - e is a length of
   that segment, the last d words stand right before themselves: a square of period d, whose half
   is primitive because it does not end anywhere between e and i.
3. **Runs.** A run of period q has a square of period q ending at each of its words from the 2q-th
   on, and nowhere else within q words, so squares at consecutive ends make up the run.

Time is in proportion to the words plus, for the words left by the cut, words x log(words)
amortised. Memory follows the longest text: about 1 KB per word that the cut leaves of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import BLANKS, once, slices, utf8

GRAM = 4
# Odd constants that spread the words of a gram.
SPREAD = tuple(np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
APART = np.uint64(0xD6E8FEB86659FD93)
RUN_TYPE = "struct<start: bigint, length: bigint, period: bigint>"


# --- the cut ---------------------------------------------------------------------------------------

def repeated_stretches(marks: np.ndarray, least_words: int) -> list[tuple[int, int]]:
    """Stretches [start, stop) that hold all runs, each in one of them; ``marks`` are 64-bit hashes of the words."""
    if len(marks) < max(GRAM, least_words):
        return []
    with np.errstate(over="ignore"):
        grams = sum(marks[k : len(marks) - GRAM + 1 + k] * c for k, c in enumerate(SPREAD))
    at, stretch = np.arange(len(grams)), np.zeros(len(grams), np.uint64)
    while True:
        with np.errstate(over="ignore"):
            value = grams[at] + stretch * APART
        order = np.argsort(value)
        same = value[order[1:]] == value[order[:-1]]
        again = np.zeros(len(at), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        left = at[again]
        # All grams of a run follow one another, so a gap between grams is a border.
        number = np.cumsum(np.diff(left, prepend=-2) != 1) - 1
        keep = np.bincount(number, minlength=1)[number] > least_words - GRAM
        done = len(left) == len(at) and keep.all()
        at, stretch = left[keep], number[keep].astype(np.uint64)
        if done or not len(at):
            break
    edges = np.flatnonzero(np.diff(at) != 1)
    starts, stops = at[np.append(0, edges + 1)[: len(at)]], at[np.append(edges, -1)[: len(at)]] + GRAM
    return list(zip(starts.tolist(), stops.tolist()))


# --- suffix automaton --------------------------------------------------------------------------------

def suffix_automaton(words: list) -> tuple[list[int], list[int], list[int]]:
    """(length, link, prefix): longest string and suffix link per state, and the state of every prefix.

    State 1 is the start; 0 stands for none.
    """
    length, link, following, prefix = [0, 0], [0, 0], [{}, {}], []
    last = 1
    for word in words:
        state = len(length)
        length.append(length[last] + 1)
        link.append(1)
        following.append({})
        p = last
        while p and word not in following[p]:
            following[p][word] = state
            p = link[p]
        if p:
            q = following[p][word]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                following.append(following[q].copy())
                while p and following[p].get(word) == q:
                    following[p][word] = clone
                    p = link[p]
                link[q] = link[state] = clone
        prefix.append(state)
        last = state
    return length, link, prefix


# --- link-cut access ----------------------------------------------------------------------------------

class LastEnds:
    """Link-cut tree over suffix links; each preferred path knows where its strings ended last.

    Paths are splay trees ordered by depth. All strings of a path ended last at the same word, so
    the end is kept once per path, at the root of its splay tree.
    """

    def __init__(self, length: list[int], link: list[int]):
        self.length = length
        self.up = list(link)  # parent within a splay tree, or the state above a path
        self.left, self.right = [0] * len(link), [0] * len(link)
        self.end = [-1] * len(link)

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        if not y or (left[y] != x and right[y] != x):
            return
        while True:
            y = up[x]
            if not y or not (left[y] == x or right[y] == x):
                break
            z = up[y]
            inner = z and (left[z] == y or right[z] == y)
            if inner and (left[z] == y) == (left[y] == x):
                self._rotate(y, z)
                self._rotate(x, y)
            elif inner:
                self._rotate(x, y)
                self._rotate(x, z)
            else:
                self.end[x] = self.end[y]
                self._rotate(x, y)
                break
            above = up[x]
            if not above or not (left[above] == x or right[above] == x):
                self.end[x] = self.end[z]
                break

    def _rotate(self, x: int, y: int) -> None:
        """Lift ``x`` over its parent ``y``."""
        up, left, right = self.up, self.left, self.right
        z = up[y]
        if left[y] == x:
            inner = left[y] = right[x]
            right[x] = y
        else:
            inner = right[y] = left[x]
            left[x] = y
        if inner:
            up[inner] = y
        up[y], up[x] = x, z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def access(self, state: int, now: int) -> list[tuple[int, int, int]]:
        """Make the path from the root to ``state`` one path that ended at ``now``.

        Returns (last end, shortest length - 1, longest length) of every segment it was made of.
        """
        up, right, end, length = self.up, self.right, self.end, self.length
        segments, below, at = [], 0, state
        while at:
            self._splay(at)
            deeper = right[at]
            if deeper:
                end[deeper] = end[at]
            above = up[at]
            if end[at] >= 0:
                segments.append((end[at], length[above], length[at]))
            right[at] = below
            below, at = at, above
        self._splay(state)
        end[state] = now
        return segments


def squares(words: list) -> Iterator[tuple[int, int]]:
    """(end, period) of every square with a primitive half, by end."""
    length, link, prefix = suffix_automaton(words)
    ends = LastEnds(length, link)
    for now, state in enumerate(prefix):
        for before, least, most in ends.access(state, now):
            if least < now - before <= most:
                yield now, now - before


def periodic_stretches(words: list, least_words: int, least_powers: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one stretch of words."""
    growing: dict[int, list[int]] = {}
    runs = []

    def close(period: int, first: int, last: int) -> None:
        start = first - 2 * period + 1
        if last + 1 - start >= max(least_words, least_powers * period):
            runs.append((start, last + 1 - start, period))

    for end, period in squares(words):
        seen = growing.get(period)
        if seen and seen[1] == end - 1:
            seen[1] = end
        else:
            if seen:
                close(period, *seen)
            growing[period] = [end, end]
    for period, seen in growing.items():
        close(period, *seen)
    return runs


def word_runs(words: list[bytes], least_words: int = 6, least_powers: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text, by start, then period."""
    marks = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    found = []
    for start, stop in repeated_stretches(marks, least_words):
        found += [(start + s, n, q) for s, n, q in periodic_stretches(words[start:stop], least_words, least_powers)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, without those that some run holds after its first period."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept = np.cumsum(edges[:-1]) == 0
    return b" ".join([w for w, k in zip(words, kept.tolist()) if k])


# --- Spark --------------------------------------------------------------------------------------------

def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 6, least_powers: int = 4
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs``; a narrow step, no shuffle.

    ``runs`` are (start, length, period) by start, then period: runs of at least ``least_words`` words
    and ``least_powers`` (four at least) periods. ``collapsed`` keeps the first period of every run and
    all other words, blanks as one space. Null and blank texts have no words, no runs and an empty
    collapsed text. Rows with a null id and repeated rows are handled like any other; other columns
    are ignored, whatever their names. Runs may overlap; a word of several runs goes when one drops it.
    """
    if least_powers < 4 or least_words <= GRAM:
        raise ValueError(f"the cut needs runs of at least 4 periods and {GRAM + 1} words")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, runs, rest = [], [], []
            for cell in utf8(batch.column("text")):
                words = cell.as_py().split()
                found = word_runs(words, least_words, least_powers)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                rest.append(collapsed(words, found).decode("utf-8"))
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(rest, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    source = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return source.mapInArrow(search, f"doc_id bigint, n_words bigint, runs array<{RUN_TYPE}>, collapsed string")


def _div(a: Column, b: Column) -> Column:
    return ((a - a % b) / b).cast("bigint")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by crc32 of its id turns periodic from some word on.

    With n words, h the crc32 and g = h div 10: from word a = g mod n on, words repeat with period
    1 + (n - a) div (3 + g mod 8). A null id plants nothing.
    """
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(hashed % 10 == 0, F.lit(False)) & F.coalesce(F.col("text").rlike(f"[^{BLANKS}]"), F.lit(False))
    words = F.split(F.btrim("text", F.lit(" \t\n\x0b\x0c\r")), f"[{BLANKS}]+")
    n, g = F.size("_words").cast("bigint"), _div(hashed, F.lit(10))
    a, p = F.col("_a"), F.col("_p")
    planted = F.transform("_words", lambda word, i: F.when(i < a, word).otherwise(F.get("_words", (a + (i - a) % p).cast("int"))))
    return (
        docs.select("doc_id", "text", once(F.when(chosen, words)).alias("_words"))
        .withColumn("_a", g % n)
        .withColumn("_p", 1 + _div(n - F.col("_a"), 3 + g % 8))
        .select("doc_id", F.when(F.col("_words").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))
    )


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period, the earliest of several; null without runs.

    ``runs`` are ordered by start, then period, and stay so among equals.
    """
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))),
        F.get(runs, F.lit(0)),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )


def run_report(found: DataFrame) -> DataFrame:
    """Digest of ``periodic_runs``: counts, the strongest run, hashes of the runs and of the collapsed text."""
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    )
    best = F.col("best")
    return found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        _div(best["length"] * 1000, best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
