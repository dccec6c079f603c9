"""Toxicity by character n-grams scaled by naive Bayes log-count ratios.

After Wang & Manning, "Baselines and bigrams", ACL 2012: a linear classifier over the presence of n-grams,
each multiplied by the log ratio of its document frequencies in the two classes. N-grams are
runs of 3 to 5 bytes of the lower-cased text, filed into 2^19 buckets. Frequencies and the choice
of n-grams are Spark aggregates over the labelled sample; the weights of the chosen n-grams are
fitted on the driver, whose input is bounded by ``fit_rows`` and ``features``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import label_fold, slices, utf8
from reviewmill.llm.quality import labelled_sample
from reviewmill.staging import Stage

BUCKET_BITS = 19
BUCKETS = 1 << BUCKET_BITS
CHUNK = 4096
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
BYTES_AT_ONCE = 1 << 20


def ngram_buckets(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of all 3-, 4- and 5-grams, repeats included, for one stretch of text after another.

    White space is one blank, and the text is padded with blanks, so word edges show.
    """
    plain = np.frombuffer(b" " + b" ".join(text.split()) + b" ", np.uint8)
    shift = np.uint64(64 - BUCKET_BITS)
    for start in range(0, max(1, len(plain) - 2), BYTES_AT_ONCE):
        code = plain[start : start + BYTES_AT_ONCE + 4].astype(np.uint64)
        gram = code[:-1] | (code[1:] << np.uint64(8)) if len(code) > 1 else code[:0]
        for n, multiplier in zip((3, 4, 5), MULTIPLIERS):
            if len(code) < n:
                break
            gram = gram[: len(code) - n + 1] | (code[n - 1 :] << np.uint64(8 * (n - 1)))
            yield ((gram[:BYTES_AT_ONCE] * np.uint64(multiplier)) >> shift).astype(np.int64)


def present(text: bytes, wanted: np.ndarray | None = None) -> np.ndarray:
    """Distinct buckets of a text, or those of them that ``wanted`` marks."""
    found = [b if wanted is None else b[wanted[b]] for b in ngram_buckets(text)]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


@dataclass(frozen=True)
class ToxicityModel:
    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def _chunk_counts(rows: DataFrame) -> DataFrame:
    """(chunk, toxic, clean): per task, document frequencies of CHUNK buckets as bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int32)
        for batch in slices(batches, "text"):
            for cell, label in zip(utf8(batch.column("text")), batch.column("label").to_pylist()):
                seen[int(label), present(cell.as_py())] += 1
        clean, toxic = seen.reshape(2, -1, CHUNK)
        used = np.flatnonzero((clean + toxic).any(axis=1))
        for start in range(0, len(used), 32):
            part = used[start : start + 32]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array([toxic[c].tobytes() for c in part]), pa.array([clean[c].tobytes() for c in part])],
                ["chunk", "toxic", "clean"],
            )

    return rows.select("label", "text").mapInArrow(count, "chunk bigint, toxic binary, clean binary")


def telling_ngrams(rows: DataFrame, toxic_docs: int, clean_docs: int, features: int, least: int = 3, smooth: float = 1.0) -> DataFrame:
    """(bucket, ratio, gain): the n-grams whose frequency differs most between the classes.

    ``ratio`` is the naive Bayes log-count ratio, ``gain`` the chi-square statistic.
    """

    def weigh(part: pd.DataFrame) -> pd.DataFrame:
        total = {c: sum(np.frombuffer(x, np.int32).astype(np.int64) for x in part[c]) for c in ("toxic", "clean")}
        a, b = total["toxic"], total["clean"]
        row = np.flatnonzero(a + b >= least)
        a, b = a[row].astype(float), b[row].astype(float)
        ratio = np.log((a + smooth) / (toxic_docs + 2 * smooth)) - np.log((b + smooth) / (clean_docs + 2 * smooth))
        n, share = toxic_docs + clean_docs, toxic_docs / (toxic_docs + clean_docs)
        seen = a + b
        expected = seen * share
        spread = expected * (1 - share) * np.maximum(n - seen, 0.5) / n
        gain = (a - expected) ** 2 / np.maximum(spread, 1e-9)
        return pd.DataFrame({"bucket": row + int(part["chunk"].iloc[0]) * CHUNK, "ratio": ratio, "gain": gain})

    weighed = _chunk_counts(rows).groupBy("chunk").applyInPandas(weigh, "bucket bigint, ratio double, gain double")
    return weighed.orderBy(F.desc("gain"), "bucket").limit(features)


def fit_logistic(rows: list[np.ndarray], label: np.ndarray, ratio: np.ndarray, l2: float = 2.0, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights over the log-count ratios and the bias, by accelerated gradient descent."""
    column = np.concatenate(rows) if rows else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    value = ratio[column]
    n, width = len(rows), len(ratio)
    share = min(max(label.mean(), 1e-3), 1 - 1e-3)
    weight, bias = np.zeros(width), float(np.log(share / (1 - share)))
    look, look_bias = weight.copy(), bias
    # The largest eigenvalue of the data bounds the curvature.
    probe = np.ones(width) / np.sqrt(max(width, 1))
    bound = 1.0
    for _ in range(12):
        ahead = np.bincount(row, value * probe[column], n)
        probe = np.bincount(column, value * ahead[row], width)
        bound = float(np.linalg.norm(probe)) or 1.0
        probe /= bound
    pace = 1.0 / (0.25 * (bound + n) + l2)
    momentum = 1.0
    for _ in range(rounds):
        score = np.bincount(row, value * look[column], n) + look_bias
        error = 1.0 / (1.0 + np.exp(-score)) - label
        next_weight = look - pace * (np.bincount(column, value * error[row], width) + l2 * look)
        next_bias = look_bias - pace * error.sum()
        step = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        slide = (momentum - 1) / step
        look, look_bias = next_weight + slide * (next_weight - weight), next_bias + slide * (next_bias - bias)
        weight, bias, momentum = next_weight, next_bias, step
    return weight, float(bias)


def fit_toxicity(docs: DataFrame, labels: DataFrame, stage: Stage, fit_rows: int = 16_000, features: int = 6_000) -> ToxicityModel:
    """Fit on at most about ``fit_rows`` labelled documents outside the held-out fold.

    At most ``fit_rows`` x ``features`` numbers reach the driver. A single class, or no labelled row,
    gives a model without n-grams.
    """
    sample = F.broadcast(labelled_sample(labels, "toxic", fit_rows))  # bounded by fit_rows
    text = F.lower(F.coalesce("text", F.lit(""))).cast("binary").alias("text")
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text).join(sample, "doc_id")
    rows = stage.put(chosen.select("label", "text"), "labelled_texts")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = counts.get(1.0, 0), counts.get(0.0, 0)
    if not toxic or not clean:
        return ToxicityModel(np.empty(0, np.int64), np.empty(0), 20.0 if toxic else -20.0 if clean else 0.0)
    best = telling_ngrams(rows, toxic, clean, features).collect()
    order = np.argsort([r["bucket"] for r in best])
    buckets = np.array([r["bucket"] for r in best], np.int64)[order]
    ratio = np.array([r["ratio"] for r in best], float)[order]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(BUCKETS, bool)
        wanted[buckets] = True
        for batch in slices(batches, "text"):
            found = [np.searchsorted(buckets, present(t.as_py(), wanted)).astype(np.int32).tobytes() for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.binary())], ["label", "found"])

    marked = rows.select("label", "text").mapInArrow(mark, "label double, found binary").toArrow()
    present_rows = [np.frombuffer(x.as_py(), np.int32).astype(np.int64) for x in marked.column("found")]
    weight, bias = fit_logistic(present_rows, marked.column("label").to_numpy(), ratio)
    return ToxicityModel(buckets, weight * ratio, bias)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, stage: Stage, threshold: float = 0.5, fit_rows: int = 16_000, features: int = 6_000
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Whole texts are scored. Null texts are scored like empty ones; rows with a null doc_id are
    scored and count as held out; repeated rows get the same score; other columns are ignored.
    """
    model = fit_toxicity(docs, labels, stage, fit_rows, features)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weight = np.zeros(BUCKETS, bool), np.zeros(BUCKETS)
        wanted[model.buckets] = True
        weight[model.buckets] = model.weights
        for batch in slices(batches, "text"):
            total = [model.bias + float(weight[present(t.as_py(), wanted)].sum()) for t in utf8(batch.column("text"))]
            value = 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(value)], ["doc_id", "score"])

    text = F.lower(F.coalesce("text", F.lit(""))).cast("binary").alias("text")
    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text).mapInArrow(score, "doc_id bigint, score double")
    return scored.select(
        "doc_id", (label_fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
