"""Secret scans by an incremental ledger of blobs.

A text is a blob, known by the SHA-256 of its bytes; every row of a table is a path at
which a version of some blob lies. The ledger has one row per blob and version of a
rule that was ever scanned, with what was found, and is only appended to. A scan
anti-joins the pairs of blob and rule with the ledger, reads one text for each blob
that has unseen pairs, scans it for the unseen rules only, and joins the findings
back to all paths. A changed pattern is a new version and has all blobs
scanned for this rule alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import join_hot, keep
from starmart.sources.store import FolderStore, workspace


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches from the left, each after the end of the last; a
    match counts if its ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    ignore_case: bool = False

    def spans(self, text: str) -> list[tuple[int, int]]:
        # ASCII: in either case means a-z and A-Z, no other letters that fold to them.
        found = re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0)).finditer(text)
        return [m.span() for m in found if len(m[self.group]) >= self.least]


# Kinds and patterns, in the order in which spans that start alike are listed.
# Runs of one class of characters are whole matches, so those too short need not match at
# first to be dropped: 20 characters of an access key and 24 digits are in the pattern.
RULES = (
    Rule(
        "assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)

_SPANS = "array<struct<start:int,end:int>>"
_LEDGER = f"blob binary, kind string, version int, spans {_SPANS}"


@dataclass
class BlobLedger:
    """The scanned pairs and their findings: a table of Parquet files in a folder all executors share.

    Appended to by one scan at a time; a scan that fails before its append leaves the ledger
    as it was, and a pair appended twice counts once.
    """

    spark: SparkSession
    path: str

    @classmethod
    def create(cls, spark: SparkSession, path: str) -> BlobLedger:
        """A new, empty ledger; one that exists is opened by the class itself."""
        spark.createDataFrame([], _LEDGER).write.parquet(path)
        return cls(spark, path)

    @classmethod
    def temporary(cls, spark: SparkSession) -> BlobLedger:
        store = workspace(spark)
        return cls.create(spark, store.path("ledger"))

    def read(self) -> DataFrame:
        return self.spark.read.schema(_LEDGER).parquet(self.path)

    def append(self, findings: DataFrame) -> None:
        findings.select("blob", "kind", "version", F.col("spans").cast(_SPANS)).write.mode("append").parquet(self.path)


def blob_id(text: Column) -> Column:
    """SHA-256 of the text in UTF-8; NULL counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _scan(rules: Sequence[Rule]):
    """Rows of blob, positions of its unseen rules, and text to a row a pair."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {n: [] for n in ("blob", "kind", "version", "spans")}
            for blob, unseen, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for i in unseen:
                    out["blob"].append(blob)
                    out["kind"].append(rules[i].kind)
                    out["version"].append(rules[i].version)
                    out["spans"].append([{"start": a, "end": b} for a, b in rules[i].spans(text or "")])
            types = pa.schema(
                [("blob", pa.binary()), ("kind", pa.string()), ("version", pa.int32()),
                 ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
            )
            yield pa.RecordBatch.from_pydict(out, types)

    return run


def unseen_pairs(paths: DataFrame, ledger: BlobLedger, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(blob, place, unseen)``: blobs of ``paths`` (see ``blobs``) with the positions of the
    rules that the ledger lacks for them, and the least place at which each lies.

    Paths of one blob collapse in the tasks before they are shuffled.
    """
    found = keep(paths.groupBy("blob").agg(F.min("place").alias("place")))
    now = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))
            for i, r in enumerate(rules)
        ]
    )
    pairs = found.select("blob", "place", F.inline(now))
    unseen = pairs.join(ledger.read().select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
    return unseen.groupBy("blob").agg(F.min("place").alias("place"), F.sort_array(F.collect_list("i")).alias("unseen"))


def blobs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(place, id, blob)`` of every row, written; ``place`` tells apart rows alike in all."""
    row = F.monotonically_increasing_id()
    return keep(docs.select(row.alias("place"), F.col(doc_id).alias("id"), blob_id(F.col(text)).alias("blob")))


def scan(
    docs: DataFrame, ledger: BlobLedger, doc_id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Scan what the ledger lacks, append it, and return the findings at every row of ``docs``.

    ``doc_id, blob, findings``: an array of (kind, start, end) by start, then by the order of ``rules``, in
    code points, end exclusive; empty where there are none. Rows alike in all come
    as often as they are there. NULL text is the empty blob; NULL ids are kept.

    Only rows of unseen blobs have their text shuffled, one for each blob where ids tell
    its paths apart; the rest of a group of copies, however large, is left out before. Texts
    are scanned whole. What a scan finds is written to the ledger before it is read back, so a lost
    executor changes nothing.
    """
    paths = blobs(docs, doc_id, text)
    todo = keep(unseen_pairs(paths, ledger, rules))
    if not todo.isEmpty():
        chosen = paths.join(todo, ["blob", "place"]).select("id", "blob", "unseen")
        texts = docs.select(F.col(doc_id).alias("_id"), blob_id(F.col(text)).alias("_blob"), F.col(text).alias("_text"))
        same = (F.col("_blob") == F.col("blob")) & F.col("_id").eqNullSafe(F.col("id"))
        # Copies with one id are scanned each, but one of them is kept.
        read = texts.join(chosen, same).select("blob", "unseen", "_text")
        ledger.append(read.mapInArrow(_scan(rules), _LEDGER).dropDuplicates(["blob", "kind", "version"]))
    return _at_paths(paths, ledger, rules)


def _at_paths(paths: DataFrame, ledger: BlobLedger, rules: Sequence[Rule]) -> DataFrame:
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    current = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    hits = ledger.read().where((F.size("spans") > 0) & (F.col("version") == F.try_element_at(current, "kind")))
    hits = hits.dropDuplicates(["blob", "kind"])
    marked = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("rank"), F.col("kind"), s["end"].alias("end")))
    by_blob = (
        hits.withColumn("rank", F.try_element_at(order, "kind"))
        .groupBy("blob")
        .agg(F.sort_array(F.flatten(F.collect_list(marked))).alias("found"))
    )
    # One entry per rule and blob; a blob's findings are as long as its text at most.
    findings = F.transform("found", lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end")))
    at = join_hot(paths, by_blob, "blob", "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return at.select(F.col("id").alias("doc_id"), "blob", F.coalesce(findings, none).alias("findings"))
