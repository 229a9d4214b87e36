"""Trained operators against plain versions that compare every text with everything learned."""

import os
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from starmart.llm import langid, quality
from starmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

WORDS = {
    "en": "the quick brown fox jumps over a lazy dog while the others watch from there".split(),
    "de": "der schnelle braune fuchs springt über den faulen hund während die anderen zusehen".split(),
    "fr": "le renard brun saute par dessus le chien paresseux pendant que les autres regardent".split(),
}


def _plain_grams(text):
    low = " " + "".join(c if c.isalpha() else " " for c in f" {text} ".lower()).strip() + " "
    low = " ".join(low.split(" ")) if low.strip() else " "
    while "  " in low:
        low = low.replace("  ", " ")
    found = Counter()
    for n in (1, 2, 3):
        for at in range(len(low) - n + 1):
            gram = low[at : at + n]
            if gram != " ":
                number = 0
                for c in gram:
                    number = number << 21 | ord(c)
                found[number] += 1
    return found


def _plain_rank(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda p: (-p[1], p[0]))[:size]]


def _plain_language(text, profiles, size):
    mine = _plain_rank(_plain_grams(text), size) if any(map(str.isalpha, text or "")) else []
    if not mine:
        return "und", 0.0
    far = {
        lang: sum(abs(profile.index(g) - at) if g in profile else size for at, g in enumerate(mine))
        for lang, profile in profiles.items()
    }
    best = min(sorted(far), key=far.get)
    return best, max(0.0, 1 - far[best] / (size * len(mine)))


def _learned_from(rows):
    counts = {}
    for r in rows:
        counts.setdefault(r["lang"], Counter()).update(_plain_grams(r["text"] or ""))
    return {lang: _plain_rank(c, langid.PROFILE) for lang, c in counts.items()}


def _same_languages(docs, found):
    held = {r["doc_id"]: r["held_out"] for r in found}
    rows = docs.select("doc_id", "text", "lang").collect()
    profiles = _learned_from(r for r in rows if r["lang"] is not None and not held[r["doc_id"]])
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert len(by_id) == len(rows) and profiles
    for r in rows:
        lang, score = _plain_language(r["text"], profiles, langid.PROFILE)
        assert by_id[r["doc_id"]] == (lang, pytest.approx(score, abs=1e-12)), r["doc_id"]


@needs_data
def test_languages_equal_plain_distances(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    _same_languages(docs, QUERIES["op10_language"](spark, SF).collect())


def test_languages_equal_plain_distances_of_short_and_odd_texts(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(WORDS[lang], rng.integers(1, 30))), lang) for i, lang in enumerate(list(WORDS) * 15)]
    rows += [(100, None, "en"), (101, "12 34", "de"), (102, "Ünïcode—dash, A.B.C!", None), (103, "x", None), (104, "漢字 かな", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    _same_languages(docs, langid.languages(docs).collect())


def _plain_weights(text):
    """log(1 + count) at the place of each term, one term after another."""
    row = [0.0] * quality.TERMS
    for term, n in quality.terms(text or "").items():
        row[xxhash.xxh64_intdigest(repr(term)) % quality.TERMS] += n
    return np.log1p(np.array(row))


def _plain_unit(v):
    norm = float(np.sqrt(sum(x * x for x in v)))
    return v / norm if norm else v


@needs_data
def test_quality_equals_all_cosines(spark):
    """All labelled rows vote at this size, so the voters are known without the operator."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    text = {r["doc_id"]: r["text"] for r in docs}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = {r["doc_id"]: r for r in QUERIES["op8_quality"](spark, SF).collect()}
    assert len(found) == len(docs)
    voting = sorted(i for i, q in labels.items() if q in (0, 1) and i in text and not found[i]["held_out"])
    assert max(Counter(labels[i] for i in voting).values()) < quality.SAMPLE

    raw = np.array([_plain_weights(text[i]) for i in voting]).astype(np.float32).astype(float)
    seen = [sum(1 for v in raw[:, t] if v > 0) for t in range(quality.TERMS)]
    idf = np.array([np.log((1 + len(raw)) / (1 + n)) + 1 for n in seen])
    weighted = np.array([_plain_unit(r * idf) for r in raw])
    # The axes by another decomposition than the operator's.
    _, strength, axes = np.linalg.svd(weighted, full_matrices=False)
    rank = quality.RANK
    assert strength[rank - 1] > 1.0001 * strength[rank], "the axes are not unique here"
    axes = axes[:rank].T
    voters = [_plain_unit(r @ axes) for r in weighted]

    compared = 0
    for i, t in text.items():
        mine = _plain_unit(_plain_unit(_plain_weights(t) * idf) @ axes)
        near = sorted(((float(mine @ v), labels[j]) for j, v in zip(voting, voters, strict=True)), reverse=True)
        # A tie at the last place leaves open which of the two votes.
        if len(near) > quality.NEIGHBOURS and near[quality.NEIGHBOURS - 1][0] - near[quality.NEIGHBOURS][0] < 1e-5:
            continue
        weights = [(max(c, 0.0) ** 8, q) for c, q in near[: quality.NEIGHBOURS]]
        total = sum(w for w, _ in weights)
        score = sum(w * q for w, q in weights) / total if total else np.mean([labels[j] for j in voting])
        assert found[i]["score"] == pytest.approx(score, abs=1e-4)
        assert found[i]["predicted"] == int(found[i]["score"] >= quality.THRESHOLD)
        compared += 1
    assert compared > 0.5 * len(text)


def test_scores_of_clashing_and_extra_columns(spark):
    docs = spark.createDataFrame([(i, "word " * i, i * 2) for i in range(1, 9)], "id long, text string, extra long")
    labels = docs.select("id", (F.col("id") % 2).alias("quality"))
    model = quality.learn(docs.select("id", "text"), labels)
    scored = quality.score_quality(docs, model)
    assert scored.columns == ["id", "extra", "score"] and scored.count() == 8
    assert quality.score_quality(docs.limit(0), model).count() == 0
