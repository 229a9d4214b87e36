"""Profiles and candidate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators import profile as P
from starmart.operators.checks import columns_equal
from starmart.operators.profile_log import ERROR, ProfileLog
from starmart.queries.inputs import MESSY_COLUMNS, MESSY_SQL, messy, table
from starmart.queries.registry import query
from starmart.sources.store import workspace

_TABLES = ("customer", "orders", "lineitem", "part", "events", "documents")


@query(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _TABLES)
)
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.row_counts({t: table(spark, sf_dir, t) for t in _TABLES})


_MESSY_TYPE_NAMES = {
    c: "bigint" if c in ("id", "host_id") else "string" for c in MESSY_COLUMNS
}


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS type, count(*) AS n_rows, count({c}) AS n_non_null"
        f" FROM ({MESSY_SQL}) m"
        for c, t in _MESSY_TYPE_NAMES.items()
    )
)
def profile_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.non_null_counts(messy(spark, sf_dir))


_EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM events"
        for c in _EVENT_COLUMNS
    )
)
def profile_nunique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values per column, NULLs excluded: integers, times, floats, texts."""
    return P.profile(table(spark, sf_dir, "events")).select("column_name", "n_distinct")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS type, count(*) AS n_rows,"
        f" count({c}) AS n_non_null, count(DISTINCT {c}) AS n_distinct FROM ({MESSY_SQL}) m"
        for c, t in _MESSY_TYPE_NAMES.items()
    )
)
def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.profile(messy(spark, sf_dir))


_DOCUMENT_TYPES = {
    "doc_id": "bigint",
    "text": "string",
    "lang": "string",
    "source": "string",
    "n_chars": "bigint",
}


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS type, count(*) AS n_rows,"
        f" count({c}) AS n_non_null, count(DISTINCT {c}) AS n_distinct FROM documents"
        for c, t in _DOCUMENT_TYPES.items()
    )
)
def profile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of a table with long texts, whole texts compared."""
    return P.profile(table(spark, sf_dir, "documents"))


_LINE_KEYS = (
    ("l_orderkey",),
    ("l_orderkey", "l_linenumber"),
    ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
    ("l_returnflag", "l_linestatus"),
)


def _key_sql(table_name: str, *subsets: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{', '.join(s)}' AS columns, CAST(sum(n) AS BIGINT) AS n_rows,
        count(*) AS n_distinct, sum(n) = count(*) AS is_key
        FROM (SELECT count(*) AS n FROM {table_name} GROUP BY {', '.join(s)}) g"""
        for s in subsets
    )


@query(_key_sql("lineitem", *_LINE_KEYS))
def candidate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.candidate_keys(table(spark, sf_dir, "lineitem"), *_LINE_KEYS)


_MESSY_KEYS = (
    ("id",),
    ("host_id",),
    ("host_response_time", "bathrooms_text", "price"),
    ("host_id", "first_review", "price"),
)


@query(_key_sql(f"({MESSY_SQL}) m", *_MESSY_KEYS))
def candidate_key_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate keys over columns with NULLs, which count as values."""
    return P.candidate_keys(messy(spark, sf_dir), *_MESSY_KEYS)


@query(
    """SELECT 'p_name' AS column_name, CAST(max(length(p_name)) AS INTEGER) AS max_width FROM part
    UNION ALL SELECT 'p_partkey', CAST(max(length(CAST(p_partkey AS STRING))) AS INTEGER) FROM part
    UNION ALL SELECT 'p_brand', CAST(max(length(p_brand)) AS INTEGER) FROM part"""
)
def max_text_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.max_text_width(table(spark, sf_dir, "part"), "p_name", "p_partkey", "p_brand")


@query("SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS width FROM documents")
def text_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    width = P.text_width(F.col("text")).alias("width")
    return table(spark, sf_dir, "documents").select("doc_id", "lang", width)


@query(
    """SELECT 'l_shipdate' AS left_column, 'l_shipdate_text' AS right_column,
      bool_and(CAST(l_shipdate AS DATE) IS NOT DISTINCT FROM CAST(CAST(CAST(l_shipdate AS DATE) AS STRING) AS DATE)) AS equal
      FROM lineitem
    UNION ALL SELECT 'l_discount', 'l_tax', bool_and(l_discount IS NOT DISTINCT FROM l_tax) FROM lineitem""",
    "columns_equal",
)
def _columns_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is a column redundant: a date against the same date parsed from text."""
    lines = table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date")
    both = lines.select(
        day.alias("l_shipdate"),
        day.cast("string").try_cast("date").alias("l_shipdate_text"),
        "l_discount",
        "l_tax",
    )
    return columns_equal(both, ("l_shipdate", "l_shipdate_text"), ("l_discount", "l_tax"))


_MERGED_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS type, count(*) AS n_rows, count({c}) AS n_non_null,"
    f" {f'max(length({c}))' if t == 'string' else 'CAST(NULL AS BIGINT)'} AS max_width, TRUE AS distinct_within FROM m"
    for c, t in _MESSY_TYPE_NAMES.items()
)


@query(f"WITH m AS ({MESSY_SQL}) {_MERGED_SQL}")
def profile_merged_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of two loads merged: counts and widths as of both together, distinct counts
    within three standard errors of the exact ones."""
    rows = messy(spark, sf_dir)
    log = ProfileLog(spark, workspace(spark).path("profiles"))
    first = F.col("id") % 2 == 0
    log.add("first", rows.where(first))
    log.add("second", rows.where(~first))
    exact = P.profile(rows).select("column_name", F.col("n_distinct").alias("exact"))
    within = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 3 * ERROR * F.col("exact"))
    return log.profile().join(exact, "column_name").select(
        "column_name", "type", "n_rows", "n_non_null", "max_width", within.alias("distinct_within")
    )
