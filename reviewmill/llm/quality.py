"""Quality by a sparse rule ensemble, scored as a Spark column expression.

After Friedman & Popescu, "Predictive learning via rule ensembles", 2008. Statistics of every text
are computed by built-in functions and stored. Trees are grown on the labelled rows, every path from
a root becomes a conjunctive rule over the statistics, and a lasso logistic regression keeps few
of the rules. Trees and regression are trained by Spark; the driver sees the rules and weights.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import BLANKS, WORD, label_fold
from reviewmill.operators.joins import broadcast_if_small
from reviewmill.staging import Stage

SCALE = 1_000_000


def _count(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that match the single-character ``pattern``."""
    return F.length(F.regexp_replace(text, f"(?:(?!{pattern})[\\s\\S])+", ""))


def text_statistics(text: Column) -> dict[str, Column]:
    """Numbers that tell prose from junk; null texts count as empty."""
    body = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(body), F.lit(1))
    words = F.filter(F.split(F.lower(body), f"[{BLANKS}]+"), lambda w: w != "")
    many = F.greatest(F.size(words), F.lit(1))

    def share(removed: str) -> Column:
        return (F.length(body) - F.length(F.regexp_replace(body, removed, ""))) / chars

    def each(mark: str) -> Column:
        return (F.length(body) - F.length(F.replace(body, F.lit(mark), F.lit("")))) / many

    pairs = F.zip_with(words, F.slice(words, 2, F.size(words) + 1), lambda a, b: a == b)
    return {
        "log_words": F.log1p(F.size(words).cast("double")),
        "word_length": F.length(body) / many,
        "upper_share": share(r"\p{Lu}+"),
        "digit_share": share(r"[0-9]+"),
        "symbol_share": share(r"[^\p{L}\p{N}\s.,;:'\"!?()-]+"),
        "letter_share": share(r"\p{L}+"),
        "bars_per_word": each("|"),
        "bangs_per_word": each("!"),
        "stops_per_word": each("."),
        "commas_per_word": each(","),
        "lines_per_word": each("\n"),
        "distinct_share": F.size(F.array_distinct(words)) / many,
        "repeat_share": F.size(F.filter(pairs, lambda same: same)) / many,
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is_above, threshold)."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        parts = [F.col(name) > F.lit(at) if above else F.col(name) <= F.lit(at) for name, above, at in self.terms]
        rule = parts[0]
        for part in parts[1:]:
            rule = rule & part
        return rule


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def score(self) -> Column:
        total = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(model, names: list[str]) -> list[Rule]:
    """Every path from a root to a node below it, the tightest bound kept per side and statistic."""
    found: dict[Rule, None] = {}

    def walk(node, bounds: dict[tuple[str, bool], float]) -> None:
        if bounds:
            found[Rule(tuple((n, above, bounds[n, above]) for n, above in sorted(bounds)))] = None
        if node.getClass().getSimpleName() == "LeafNode":
            return
        split = node.split()
        name, at = names[split.featureIndex()], split.threshold()
        walk(node.leftChild(), bounds | {(name, False): min(at, bounds.get((name, False), at))})
        walk(node.rightChild(), bounds | {(name, True): max(at, bounds.get((name, True), at))})

    for tree in model.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


def fit_rules(
    rows: DataFrame, names: list[str], stage: Stage, trees: int = 16, depth: int = 3, lasso: float = 0.002, seed: int = 5
) -> RuleModel:
    """Fit on ``rows`` (label 0.0 / 1.0 and the statistics). One class alone gives its own score."""
    balance = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("share")).first()
    if not balance["n"]:
        return RuleModel((), (), 0.0)
    if balance["share"] in (0.0, 1.0):
        return RuleModel((), (), 20.0 if balance["share"] else -20.0)
    packed = rows.select("label", array_to_vector(F.array(*[F.col(n).cast("double") for n in names])).alias("features"))
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=64, featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=seed
    ).fit(packed)
    rules = tree_rules(forest, names)
    if not rules:
        return RuleModel((), (), 0.0)
    marked = rows.select("label", F.array(*[r.column().cast("double") for r in rules]).alias("marks"))
    marked = stage.put(marked, "rule_marks").select("label", array_to_vector("marks").alias("features"))
    lasso_fit = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=80, standardization=False).fit(marked)
    weights = lasso_fit.coefficients.toArray().tolist()
    kept = [(r, w) for r, w in zip(rules, weights) if abs(w) > 1e-6]
    return RuleModel(tuple(r for r, _ in kept), tuple(w for _, w in kept), float(lasso_fit.intercept))


def labelled_sample(labels: DataFrame, label: str, fit_rows: int, seed: int = 3) -> DataFrame:
    """(doc_id, label) outside the held-out fold, thinned by a hash to about ``fit_rows`` rows."""
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("double").alias("label")).filter(
        F.col("label").isin(0.0, 1.0) & F.col("doc_id").isNotNull() & (label_fold(F.col("doc_id")) != 0)
    )
    part = int(SCALE * min(1.0, fit_rows / max(1, usable.count())))
    return usable.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(SCALE)) < part)


def score_quality(
    docs: DataFrame, labels: DataFrame, stage: Stage, threshold: float = 0.3, fit_rows: int = 20_000
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Learns ``labels.quality`` from at most about ``fit_rows`` labelled rows whose crc32(doc_id) mod 5
    is not 0. Null texts are scored like empty ones; rows with a null doc_id are scored and count
    as held out; labels that are null or neither 0 nor 1 are ignored. Without labels all score 0.5.
    """
    numbers = text_statistics(F.col("text"))
    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[c.cast("double").alias(n) for n, c in numbers.items()])
    stats = stage.put(scored, "statistics")
    names = list(numbers)
    sample = broadcast_if_small(stage.put(labelled_sample(labels, "quality", fit_rows), "labelled"))
    rows = stage.put(stats.join(sample, "doc_id").select("label", *names), "fit_rows")
    model = fit_rules(rows, names, stage)
    return stats.select(
        "doc_id", (label_fold(F.col("doc_id")) == 0).alias("held_out"), model.score().alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, stage: Stage, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the documents that score below ``threshold``; all columns are kept.

    A doc_id that repeats goes only when each of its texts is rejected; a null doc_id stays.
    """
    scores = score_quality(docs, labels, stage, threshold)
    bad = scores.groupBy("doc_id").agg(F.max("predicted").alias("best")).filter("best = 0 and doc_id is not null")
    bad = stage.put(bad.select(F.col("doc_id").alias("_bad")), "rejected")
    return docs.join(broadcast_if_small(bad), docs["doc_id"] == bad["_bad"], "left_anti")
