"""From raw documents to a tokenised training mix, five stages.

Each stage takes all rows that the one before wrote and decides about whole rows:
rows rejected by language, exact duplicates, near duplicates, and the copies
of the mix go or come; the last stage returns the tokens' digests of each row.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import bpe, exact_dedup, langid, mixing, simhash
from starmart.llm.common import table
from starmart.llm.queries import tokenizer_path
from starmart.session import tune_texts
from starmart.sources.store import workspace


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are NULL or have no letter; languages are learned from ``docs``."""
    return langid.keep_known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the row with the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by SimHash, the row with the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix of sources takes it."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row."""
    return bpe.encode_documents(docs, tokenizer_path())


def _in_small_batches(stage):
    @wraps(stage)
    def run_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(tune_texts(spark), docs, sf_dir)

    return run_


STAGES = [
    ("language_id", _in_small_batches(language)),
    ("exact_dedup", _in_small_batches(exact)),
    ("simhash_dedup", _in_small_batches(near)),
    ("mixing", _in_small_batches(mix)),
    ("bpe", _in_small_batches(tokens)),
]

# Language profiles, fingerprints, dependent rounding and BPE are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    A stage's rows are removed once those of the next are written.
    """
    store = workspace(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = store.save(name, stage(spark, docs, sf_dir))
        if before:
            store.drop(spark, before)
        before = name
    return docs
