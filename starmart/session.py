"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# A projection over dozens of columns compiles to one method that is too long for
# the JVM to optimise. Above this many bytes of byte code (the JVM's own limit)
# Spark is told to split the projection into small methods instead, which made
# the 69-column cleaning step about twice as fast at sf0.1 (5.3 s to 2.5 s).
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


# Texts of some thousand characters: 10,000 to a batch would be tens of MB in the JVM and again
# in each Python worker, for what goes in and what comes out.
TEXT_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


def tune_texts(spark: SparkSession) -> SparkSession:
    """Apply the settings that whole texts in Python workers need."""
    for key, value in TEXT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that wide projections need; call once per session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
