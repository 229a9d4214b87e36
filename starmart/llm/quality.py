"""Quality of a text by the votes of its nearest labelled neighbours."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.langid import held_out

TERMS = 1_024
RANK = 32
# Labelled rows that vote, of each label, about; the vectors are broadcast (128 bytes a row).
SAMPLE = 2_000
NEIGHBOURS = 25
THRESHOLD = 0.7
# Documents whose cosine products with all voters are held at once: 256 x 4,000 doubles, 8 MB.
_ROWS = 256

_CAPITALS = regex.compile(r"\p{Lu}+")
_OTHERS = regex.compile(r"[\p{L}--A]+", regex.V1)
_DIGIT = regex.compile(r"\p{N}+")
_BLOCK = 1 << 20


def _share(part: float, whole: float) -> int:
    """A share in steps that are finer near zero: 0, 1 to 9 for 2 %, 5 %, 10 %, ... and above."""
    value = part / whole if whole else 0.0
    return int(np.searchsorted([0.02, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.75, 0.9], value, side="right"))


def terms(text: str) -> Counter:
    """What describes a text's form, with counts; letters are replaced by their kind.

    Word shapes (A capitals, a other letters, 0 digits, runs as one; other signs as
    they are), pairs of shapes, and the share of words that repeat the word before,
    and of words and lines that occurred before.
    """
    found: Counter = Counter()
    seen: set[str] = set()
    words, again, before, last, shape_before = 0, 0, 0, None, ""
    for at in range(0, len(text), _BLOCK):
        block = text[at : at + _BLOCK]
        plain = block.split()
        shapes = _DIGIT.sub("0", _OTHERS.sub("a", _CAPITALS.sub("A", block))).split()
        found.update(shapes)
        found.update(zip([shape_before, *shapes], shapes, strict=False))
        if plain:
            again += sum(map(str.__eq__, [last or "", *plain[:-1]], plain))
            words += len(plain)
            last, shape_before = plain[-1], shapes[-1] if shapes else shape_before
            seen.update(plain)
    lines = text.split("\n")
    size = max(1.0, words / 4)
    for name, part, whole in (
        ("again", again, words),
        ("old", words - len(seen), words),
        ("lines", len(lines) - len(set(lines)), len(lines)),
    ):
        found[("share", name, _share(part, whole))] += size
    return found


def _place(term, memo: dict) -> int:
    at = memo.get(term)
    if at is None:
        if len(memo) > 200_000:
            memo.clear()
        at = memo[term] = xxhash.xxh64_intdigest(repr(term)) % TERMS
    return at


def _counts(texts: list[str], memo: dict) -> np.ndarray:
    """Rows of hashed term weights, 1 + log(count)."""
    out = np.zeros((len(texts), TERMS))
    for row, text in zip(out, texts, strict=True):
        for term, n in terms(text).items():
            row[_place(term, memo)] += n
    return np.log1p(out)


@dataclass
class Model:
    """Term weights, the projection, and the voters: unit vectors with their labels."""

    idf: np.ndarray
    axes: np.ndarray
    voters: np.ndarray
    labels: np.ndarray
    prior: float

    @classmethod
    def fit(cls, raw: np.ndarray, labels: list[int], rank: int = RANK) -> Model:
        """From the term weights of labelled texts, a row each (``_counts``)."""
        labels_ = np.array(labels, float)
        idf = np.log((1 + len(raw)) / (1 + (raw > 0).sum(0))) + 1
        weighted = _unit(raw * idf) if len(raw) else np.zeros((0, TERMS))
        # Truncated SVD by the eigenvectors of the term matrix.
        values, vectors = np.linalg.eigh(weighted.T @ weighted)
        axes = vectors[:, ::-1][:, :rank]
        return cls(idf, axes, _unit(weighted @ axes).astype(np.float32), labels_, float(labels_.mean()) if len(raw) else 0.5)

    def score(self, texts: list[str], memo: dict, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 among the nearest voters, weighted by cosine; exact, in blocks."""
        out = np.full(len(texts), self.prior)
        k = min(neighbours, len(self.labels))
        for at in range(0, len(texts) if k else 0, _ROWS):
            near = _unit(_unit(_counts(texts[at : at + _ROWS], memo) * self.idf) @ self.axes).astype(np.float32)
            cosines = near @ self.voters.T
            best = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosines, best, 1).astype(float), 0.0) ** 8
            total = weight.sum(1)
            votes = (weight * self.labels[best]).sum(1)
            out[at : at + _ROWS] = np.where(total > 0, votes / np.where(total > 0, total, 1), self.prior)
        return np.clip(out, 0.0, 1.0)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows**2).sum(1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``docs`` ``(id, text)`` and ``labels`` ``(id, quality)``; NULL labels do not count.

    Of each label about ``sample`` ids are used, chosen by a hash of the id: the bound on
    what is broadcast to find their texts, comes to the driver and votes. Texts are
    weighed in the tasks; the driver gets 4 kB a text, however long it is. Of rows
    with one id, that with the smallest hash of its text votes.
    """
    known = labels.where("quality IN (0, 1)").distinct()
    counted = known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()
    share = {r["quality"]: min(1.0, sample / r["n"]) for r in counted}
    part = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 30)) / (1 << 30)
    least = F.when(F.col("quality") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))
    chosen = F.broadcast(known.where(part < least))
    rows = docs.join(chosen, "id").select("id", F.col("quality").cast("int").alias("quality"), F.xxhash64("text").alias("mark"), "text")

    def weigh(batches):
        memo: dict = {}
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                raw = _counts([one.column(3)[0].as_py() or ""], memo).astype(np.float32)
                yield pa.RecordBatch.from_arrays([*one.columns[:3], pa.array([raw.tobytes()])], [*"iqmw"])

    known = rows.mapInArrow(weigh, f"i {rows.schema['id'].dataType.simpleString()}, q int, m long, w binary")
    known = known.groupBy("i", "q").agg(F.min_by("w", "m").alias("w")).orderBy("i", "q").collect()
    raw = np.frombuffer(b"".join(r["w"] for r in known), np.float32).reshape(-1, TERMS)
    return Model.fit(raw.astype(float), [r["q"] for r in known])


def score_quality(docs: DataFrame, model: Model, text: str = "text", neighbours: int = NEIGHBOURS) -> DataFrame:
    """``docs`` without the text, with ``score`` (0 to 1, higher: label 1 likelier).

    Rows depend on their text alone; NULL counts as empty. Where nothing was learned all
    scores are 0.5.
    """
    rest = [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        memo: dict = {}
        for batch in batches:
            names = batch.schema.names
            texts = [t or "" for t in batch.column(names.index(text)).to_pylist()]
            columns = [batch.column(names.index(c)) for c in rest]
            scores = shared.value.score(texts, memo, neighbours)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], [*rest, "score"])

    return docs.select(*rest, text).mapInArrow(run, docs.select(*rest).schema.add("score", "double"))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD, out: Column | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Labels are learned from rows that are not held out (crc32 of the id as text, mod 4,
    is not 2; NULL ids are held out). A label row without a document does not count, and of
    several labels of one document all vote.
    """
    out = held_out(F.col("doc_id"), 4, 2) if out is None else out
    rows = docs.select(F.col("doc_id").alias("id"), out.alias("held_out"), F.col("text").alias("text"))
    given = labels.where(~out).select(F.col("doc_id").alias("id"), F.col("quality").alias("quality"))
    model = learn(rows.where("NOT held_out").select("id", "text"), given, sample)
    found = score_quality(rows, model)
    return found.select(
        F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
