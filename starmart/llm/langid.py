"""Language of a text by rank-order profiles of its letter n-grams."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONGEST = 3
PROFILE = 400
# Labelled documents per language from which profiles are learned, about.
SAMPLE = 2_000
UNKNOWN = "und"

_BLOCK = 1 << 20
_BLANK = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _block_grams(codes: np.ndarray) -> np.ndarray:
    """n-grams of 1 to 3 characters as integers; words are set off by single blanks."""
    letter = _letters()[codes]
    codes = np.where(letter, codes, _BLANK)
    # A blank after a blank goes.
    stay = letter | np.r_[True, letter[:-1]]
    one = codes[stay].astype(np.int64)
    two = one[:-1] << 21 | one[1:]
    three = two[:-1] << 21 | one[2:] if len(two) else two
    # Blanks alone are no n-gram.
    return np.concatenate([one[one != _BLANK], two, three])


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a whole text and how often each occurs, a bounded block at a time.

    No n-gram is counted across the edge of a block of a million characters.
    """
    found, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    low = f" {text} ".lower()
    for at in range(0, len(low), _BLOCK):
        part = low[at : at + _BLOCK].encode("utf-32-le", "surrogatepass")
        new, times = np.unique(_block_grams(np.frombuffer(part, np.uint32)), return_counts=True)
        if not len(found):
            found, counts = new, times
        else:
            found, where = np.unique(np.r_[found, new], return_inverse=True)
            counts = np.bincount(where, np.r_[counts, times]).astype(np.int64)
    return found, counts


def _ranked(found: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, ties to the smaller."""
    if len(found) > 4 * size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        found, counts = found[counts >= least], counts[counts >= least]
    return found[np.lexsort((found, -counts))[:size]]


def _count_grams(batches):
    for batch in batches:
        by: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by.setdefault(lang, []).append(grams(text or ""))
        for lang, parts in by.items():
            found, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([p[1] for p in parts]), len(found)).astype(np.int64)
            columns = [pa.array([lang] * len(found)), pa.array(found), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "times"])


def learn_profiles(labelled: DataFrame, sample: int = SAMPLE, size: int = PROFILE) -> dict[str, list[int]]:
    """Language to its ``size`` most frequent n-grams, from rows ``(id, text, lang)``.

    Rows without a language do not count. Of each language about ``sample`` rows
    are used, chosen by a hash of their id and text, so the profiles do not depend on the
    size or order of the table. Small enough for the driver: ``size`` numbers a
    language.
    """
    known = labelled.where("lang IS NOT NULL")
    counted = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = {r["lang"]: min(1.0, sample / r["n"]) for r in counted.collect()}
    if not share:
        return {}
    least = F.element_at(F.create_map(*[F.lit(x) for p in share.items() for x in p]), F.col("lang"))
    part = F.pmod(F.xxhash64(F.lit(7), "id", "text"), F.lit(1 << 30)) / (1 << 30)
    chosen = known.where(part < least).select("lang", "text")
    counts = chosen.mapInArrow(_count_grams, "lang string, gram long, times long")
    order = Window.partitionBy("lang").orderBy(F.desc("times"), "gram")
    top = (
        counts.groupBy("lang", "gram")
        .agg(F.sum("times").alias("times"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= size)
    )
    found: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "rank").collect():
        found.setdefault(row["lang"], []).append(row["gram"])
    return found


class Profiles:
    """Out-of-place distances of a text to all languages at once."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.size, self.langs = size, sorted(profiles)
        self.known = np.unique(np.concatenate([np.array(p, np.int64) for p in profiles.values()] or [[]])).astype(np.int64)
        self.ranks = np.full((len(self.known), len(self.langs)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.known, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score. The score is 1 for the profile itself, 0 if nothing is shared."""
        if not text or not self.langs:
            return UNKNOWN, 0.0
        mine = _ranked(*grams(text), self.size)
        if not len(mine):
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.known, mine), len(self.known) - 1)
        ranks = np.where((self.known[at] == mine)[:, None], self.ranks[at], -1)
        places = np.arange(len(mine))[:, None]
        out = np.where(ranks < 0, self.size, np.abs(ranks - places)).sum(0)
        best = int(out.argmin())
        return self.langs[best], float(max(0.0, 1.0 - out[best] / (self.size * len(mine))))


def predict_languages(
    docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", size: int = PROFILE, drop_text: bool = True
) -> DataFrame:
    """``docs``, by default without the text, with ``lang_pred`` and ``score``; rows depend on their text alone.

    ``und`` with score 0 for a text that is NULL or has no letter, and for all where
    nothing was learned. Ties go to the language that sorts first.
    """
    rest = [c for c in docs.columns if c != text or not drop_text]

    def run(batches):
        model = Profiles(profiles, size)
        for batch in batches:
            names = batch.schema.names
            found = [model.predict(t.as_py()) for t in batch.column(names.index(text))]
            columns = [batch.column(names.index(c)) for c in rest]
            columns += [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*rest, "lang_pred", "score"])

    schema = docs.select(*rest).schema.add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column, parts: int = 5, part: int = 0) -> Column:
    """Whether a row is kept out of learning; NULL ids are."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(True))


def languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row; only rows not held out are learned from."""
    out = held_out(F.col(doc_id))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"), out.alias("held_out"))
    profiles = learn_profiles(rows.where("NOT held_out").select("id", "text", "lang"), sample)
    found = predict_languages(rows.select("id", "held_out", "text"), profiles)
    return found.select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score")


def _with_letter(docs: DataFrame, text: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text)).to_pylist()
            yield batch.filter(pa.array([any(map(str.isalpha, t or "")) for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def keep_known(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose text has a language: rejected are those without a letter.

    Where no profile can be learned, as without labels, the rule is the same. The
    columns are those of ``docs``; ``lang`` keeps the label it came with.
    """
    plain = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    profiles = learn_profiles(plain.where(~held_out(F.col("id"))), sample)
    if not profiles:
        return _with_letter(docs, text)
    # Numbered columns cannot clash with those of the prediction.
    names = [f"c{i}" for i in range(len(docs.columns))]
    read = names[docs.columns.index(text)]
    found = predict_languages(docs.toDF(*names), profiles, read, drop_text=False)
    stay = found.where(F.col("lang_pred") != UNKNOWN)
    return stay.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
