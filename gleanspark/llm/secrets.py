"""Secret scans with an incremental blob ledger (operator 10).

Every version of every path is content-addressed: its blob is the SHA-256 of its
text. The ledger, a folder of two Parquet tables, keeps which (blob, rule
version) pairs were scanned and what was found. A scan works on the blobs whose
pair is new, one text each however many paths hold it, and joins all findings
back to all paths. Both tables only grow, a run in folders of its own, written
findings first: a run that is lost half-way leaves nothing that counts.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import dataclass, field

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm.common import new_folder, table


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and the least length of a match or of one of its groups."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    flags: int = re.ASCII

    @property
    def version(self) -> str:
        """Changes with anything that changes what the rule finds."""
        return hashlib.sha256(repr((self.kind, self.pattern, self.least, self.group, int(self.flags))).encode()).hexdigest()[:16]


# fixed values
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)


@dataclass(frozen=True)
class Ledger:
    """Where scans are recorded; any folder that all tasks reach."""

    folder: str
    scanned: str = field(default="scanned", init=False)
    findings: str = field(default="findings", init=False)

    def read(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(f"{self.folder}/{name}/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)


SCANNED = "blob string, rule_version string"
FOUND = "blob string, rule_version string, kind string, start long, end long"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def spans_of(text: str, rules: tuple[Rule, ...]) -> list[tuple[str, str, int, int]]:
    """(rule version, kind, start, end) of each match, leftmost and non-overlapping per rule, in code points."""
    out = []
    for rule in rules:
        # one class of characters, repeated: all shorter runs can be left out while searching
        simple = re.fullmatch(r"\[[^\]]+\]\+", rule.pattern) and not rule.group
        pattern = re.compile(f"{rule.pattern[:-1]}{{{rule.least},}}" if simple else rule.pattern, rule.flags)
        out += [(rule.version, rule.kind, m.start(), m.end()) for m in pattern.finditer(text) if len(m[rule.group]) >= rule.least]
    return out


def record_scan(blobs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what (blob, text) holds that the ledger doesn't know under each rule's version. Equal blobs are scanned once."""
    spark, run = blobs.sparkSession, uuid.uuid4().hex
    known = ledger.read(spark, ledger.scanned, SCANNED).filter(F.col("rule_version").isin([r.version for r in rules]))
    done = known.groupBy("blob").agg(F.collect_set("rule_version").alias("done"))
    # copies go before the shuffle, in each task; the ledger then meets the blobs where they are
    todo = blobs.dropDuplicates(["blob"]).join(done, "blob", "left").filter(F.coalesce(F.size("done"), F.lit(0)) < len(rules))

    def scan(batches):
        for pdf in batches:
            rows = []
            for blob, text, seen in zip(pdf["blob"], pdf["text"], pdf["done"], strict=True):
                left = tuple(r for r in rules if seen is None or r.version not in seen)
                rows += [(blob, *s) for s in spans_of(text or "", left)]
                # a mark without a span: scanned
                rows += [(blob, r.version, None, None, None) for r in left]
            out = pd.DataFrame(rows, columns=["blob", "rule_version", "kind", "start", "end"])
            yield out.astype({"start": "Int64", "end": "Int64"})

    path = f"{ledger.folder}/run-{run}"
    todo.select("blob", "text", "done").mapInPandas(scan, FOUND).write.parquet(path)
    result = spark.read.schema(FOUND).parquet(path)
    result.filter("kind is not null").write.parquet(f"{ledger.folder}/{ledger.findings}/{run}")
    result.filter("kind is null").select("blob", "rule_version").write.parquet(f"{ledger.folder}/{ledger.scanned}/{run}")


def scan(versions: DataFrame, ledger: Ledger, id_column: str = "doc_id", text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Each row of `versions` as id_column, blob and found, its spans as array<struct<start,kind_no,end>> in order.

    Null texts count as empty, and repeated rows each keep their row. Runs that
    overlap may scan a blob twice; its findings still count once.
    """
    spark = versions.sparkSession
    rows = versions.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), blob_id(F.col(text_column)).alias("blob"))
    record_scan(rows.select("blob", "text"), ledger, rules)
    kind_no = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind")).cast("int")
    # a finding of an unfinished run has no mark, and doesn't count
    marked = ledger.read(spark, ledger.scanned, SCANNED).filter(F.col("rule_version").isin([r.version for r in rules]))
    found = (ledger.read(spark, ledger.findings, FOUND).join(marked, ["blob", "rule_version"], "left_semi")
             .groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("start", kind_no.alias("kind_no"), "end"))).alias("found")))
    return rows.select("id", "blob").join(found, "blob", "left").withColumn("found", F.coalesce("found", F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>"))).withColumnRenamed("id", id_column)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(r.kind) for r in RULES])
    rows = scan(table(spark, sf_dir, "documents"), Ledger(new_folder(spark, "ledger")))
    text = F.array_join(F.transform("found", lambda s: F.concat_ws(":", kinds[s["kind_no"] - 1], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("found", lambda s: s["kind_no"] == k)).cast("long")
    return rows.select("doc_id", *[count(i + 1).alias(f"n_{r.kind}") for i, r in enumerate(RULES)], F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))
