"""Secret scans of versioned texts with an incremental blob ledger.

A version is a path and a text; paths may come many times (history) and texts may be shared by many paths.

1. **Address.** Every version is reduced to its path and the SHA-256 of its text, its blob.
2. **Ledger.** Append-only tables in a folder of the user's say which blobs were scanned by which rules
   in which versions, and what was found. Blobs with a pair (blob, rule version) that the ledger
   lacks are unseen; one of their paths stands for each.
3. **Scan.** Only the standing versions' texts are read again and only by the rules they lack. A text moves
   once, to its row of the unseen table; copies and texts seen before never move.
4. **Join back.** Findings of the current rules go from blobs to all versions.

A run is recorded by one row in ``runs``, written after its tables; whatever a lost run left behind is not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm.common import slices, utf8
from reviewmill.operators.joins import broadcast_if_small
from reviewmill.staging import Stage

# Above this size findings meet the versions by shuffle.
BROADCAST_BYTES = 16 << 20


@dataclass(frozen=True)
class Rule:
    """One kind of secret. A new ``version`` makes every blob unseen for this rule alone.

    Matches are leftmost and non-overlapping, without retries; those whose ``group`` has fewer than ``least``
    characters are dropped. ``anchors`` are ASCII texts in lower case, one of which is in every match in
    some case; they only spare texts the pattern.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    anchors: tuple[str, ...] = ()
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}/{self.version}"


# The rules of the contract.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=12, group=2, anchors=("password", "passwd", "secret", "token", "api"),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18, anchors=("akia",)),
    # Runs of [0-9a-f] of 16 or more; asking for the length at once spares a match per shorter run.
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
# Kinds beyond the contract: private keys, signed tokens, and passwords inside addresses.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]{0,30}PRIVATE KEY-----", anchors=("private key",)),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", anchors=("eyj",)),
    Rule("login", r"://[^\s/:@]{1,64}:[^\s/@]{6,128}@[A-Za-z0-9]", anchors=("://",)),
)
RULES = BASE_RULES + MORE_RULES


def matches(rule: Rule, data: bytes, lowered: bytes) -> list[tuple[int, int]]:
    """(start, end) in code points of what ``rule`` finds in a UTF-8 text; ``lowered`` is its ASCII lower case."""
    if rule.anchors and not any(a.encode() in lowered for a in rule.anchors):
        return []
    text = data.decode("utf-8", "replace")
    return [m.span() for m in re.finditer(rule.pattern, text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


# --- ledger --------------------------------------------------------------------------------------------

class Ledger:
    """Scanned blobs and findings under ``root``: ``scanned/<run>``, ``findings/<run>`` and the list ``runs``.

    One writer at a time. ``runs`` has a row per run and rule; it is read by the driver and grows with the
    number of runs, not with the corpus.
    """

    SCANNED = "blob binary, rules array<string>"
    FINDINGS = "blob binary, rule string, start int, `end` int"
    RUNS = "run string, rules array<string>"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        # A first row without rules makes the list readable before any scan.
        spark.createDataFrame([], self.RUNS).write.mode("append").parquet(f"{self.root}/runs")

    def runs(self) -> list[str]:
        return [r["run"] for r in self.spark.read.schema(self.RUNS).parquet(f"{self.root}/runs").select("run").distinct().collect()]

    def _read(self, table: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{table}/{run}" for run in self.runs()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        """(blob, rules): which rules each run has taken a blob through."""
        return self._read("scanned", self.SCANNED)

    def findings(self) -> DataFrame:
        """(blob, rule, start, end) of all recorded runs."""
        return self._read("findings", self.FINDINGS)

    def record(self, scanned: DataFrame, findings: DataFrame, rules: Sequence[Rule]) -> str:
        """Write a run; its row in ``runs`` comes last and makes it count."""
        run = uuid.uuid4().hex
        findings.write.parquet(f"{self.root}/findings/{run}")
        scanned.write.parquet(f"{self.root}/scanned/{run}")
        row = self.spark.createDataFrame([(run, [r.name for r in rules])], self.RUNS)
        row.write.mode("append").parquet(f"{self.root}/runs")
        return run


# --- scan ----------------------------------------------------------------------------------------------

def addressed(versions: DataFrame, key: str, text: str) -> DataFrame:
    """(path, text, blob): null texts count as empty."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return versions.select(F.col(key).alias("path"), whole.alias("text")).withColumn(
        "blob", F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    )


def unseen_blobs(blobs: DataFrame, ledger: Ledger, rules: Sequence[Rule]) -> DataFrame:
    """(blob, path, lacking): distinct blobs, their smallest path and the rules the ledger lacks for them."""
    every = F.array(*[F.lit(r.name) for r in rules])
    seen = ledger.scanned().select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    standing = blobs.groupBy("blob").agg(F.min("path").alias("path"))
    lacking = F.when(F.col("seen").isNull(), every).otherwise(F.array_except(every, "seen"))
    return standing.join(seen, "blob", "left").select("blob", "path", lacking.alias("lacking")).filter(F.size("lacking") > 0)


def scan(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, rule, start, end) of every match of the ``lacking`` rules of a row; a narrow step."""
    by_name = {r.name: r for r in rules}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = []
            for blob, cell, names in zip(batch.column("blob"), utf8(batch.column("text")), batch.column("lacking")):
                data = cell.as_py()
                lowered = data.lower()
                for name in names.as_py():
                    found += [(blob.as_py(), name, *span) for span in matches(by_name[name], data, lowered)]
            columns = list(zip(*found)) or [[]] * 4
            kinds = (pa.binary(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["blob", "rule", "start", "end"])

    return texts.select("blob", F.col("text").cast("binary").alias("text"), "lacking").mapInArrow(search, Ledger.FINDINGS)


def scan_versions(
    versions: DataFrame, ledger: Ledger, stage: Stage, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, blob, spans), one row per row of ``versions``; brings the ledger up to date first.

    ``spans`` are (start, place, end, kind) by start, then place, the rule's number in ``rules``; positions are code points, ends
    exclusive; empty where nothing was found. Null and empty texts are one blob. Rows with a null key take part.
    Rows that repeat a key with the same text are one version for the ledger (each is looked at when it
    stands for an unseen blob) and all get the findings. Other columns are ignored, whatever their names.
    """
    if len({r.kind for r in rules}) < len(rules):
        raise ValueError("one rule per kind")
    whole = addressed(versions, key, text)
    blobs = stage.put(whole.select("path", "blob"), "blobs")
    unseen = stage.put(unseen_blobs(blobs, ledger, rules), "unseen")
    if not unseen.isEmpty():
        # Left to Spark, which broadcasts a handful of new blobs and else deals texts by path and blob.
        standing = unseen.withColumnsRenamed({"blob": "_blob", "path": "_path"})
        texts = whole.join(standing, F.col("path").eqNullSafe(F.col("_path")) & (F.col("blob") == F.col("_blob")))
        ledger.record(unseen.select("blob", F.col("lacking").alias("rules")), scan(texts, rules).distinct(), rules)
    places = F.create_map(*[F.lit(x) for place, r in enumerate(rules) for x in (r.name, place)])
    kinds = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.kind)])
    span = F.struct("start", F.element_at(places, F.col("rule")).alias("place"), "end", F.element_at(kinds, F.col("rule")).alias("kind"))
    current = ledger.findings().filter(F.col("rule").isin(*[r.name for r in rules]))
    found = current.join(blobs.select("blob").distinct(), "blob", "left_semi") if len(ledger.runs()) > 1 else current
    found = stage.put(found.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans")), "found")
    return blobs.join(broadcast_if_small(found, BROADCAST_BYTES), "blob", "left").select(
        F.col("path").alias(key), F.lower(F.hex("blob")).alias("blob"), F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)).alias("spans")
    )


def secret_report(found: DataFrame, base: Sequence[Rule] = BASE_RULES, key: str = "doc_id") -> DataFrame:
    """Digest of ``scan_versions``: counts per base kind, a hash of the base spans, and all spans as text."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of([r.kind])).cast("bigint").alias(f"n_{r.kind}") for r in base]
    own = of([r.kind for r in base])
    return found.select(key, *counts, F.sha2(joined(own).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), "blob")
