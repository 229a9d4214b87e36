"""The listings star over raw listings derived from orders and customers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import rules as R
from starmart.operators.checks import check_star, not_in_list, pk_violations
from starmart.operators.dim_versions import version_ranges
from starmart.operators.dims import distinct_rows, extract_dim
from starmart.operators.key_search import key_table, minimal_keys
from starmart.operators.profile import candidate_keys
from starmart.plans.listings import (
    AS_PUBLISHED,
    CORRECTED,
    FILLS,
    FLAG_COLUMNS,
    LISTINGS_STAR,
    NEIGHBOURHOODS,
    OVERVIEW_KEY,
    PARTIAL_KEYS,
    RAW_COLUMNS,
    clean_listings,
    load_listings,
    with_partial_keys,
)
from starmart.plans.star import denormalize
from starmart.queries import oracle as O
from starmart.queries.inputs import RAW_LISTINGS_SQL, raw_listings
from starmart.queries.registry import query
from starmart.sources.store import workspace

_RENAMED = {"listing_id": "id", "neighbourhood_overview": "neighborhood_overview"}


def _clean_column(name: str, type_: str, published: bool) -> str:
    source = _RENAMED.get(name, name)
    raw = {c.name: c.type for c in RAW_COLUMNS}.get(source)
    ddl = {"int": "INTEGER", "string": "VARCHAR", "numeric": "DECIMAL(10,0)"}.get(type_, type_)
    if name == "host_response_time":
        codes = R.RESPONSE_TIME_CODES_AS_PUBLISHED if published else R.RESPONSE_TIME_CODES
        sql = O.codes(source, codes)
    elif name in ("host_response_rate", "host_acceptance_rate"):
        sql = O.percent(source)
    elif name == "host_verifications":
        bits = O.substring_bits if published else O.member_bits
        sql = bits(source, R.VERIFICATION_LABELS)
    elif name in FLAG_COLUMNS:
        sql = f"CAST({O.flag(source)} AS INTEGER)"
    elif name == "bathrooms":
        sql = f"try_cast({O.before_blank('baths')} AS {ddl})"
    elif name == "bathroom_desc":
        sql = O.after_blank("baths")
    elif name == "daily_price":
        sql = "try_cast(replace(price, '$', '') AS DECIMAL(10,2))" if published else O.money("price")
    elif raw == "string" and type_ == "int":
        sql = O.integer(source)
    else:
        sql = f"try_cast({source} AS {ddl})"
    if name in FILLS:
        fill = FILLS[name]
        literal = f"'{fill}'" if isinstance(fill, str) else f"CAST({fill} AS {ddl})"
        sql = f"coalesce({sql}, {literal})"
    return f"{sql} AS {name}"


def clean_sql(published: bool = False) -> str:
    texts = R.HALF_BATH_TEXTS_AS_PUBLISHED if published else R.HALF_BATH_TEXTS
    baths = O.half_bath("bathrooms_text", texts, not published)
    listed = ", ".join(
        _clean_column(c.name, c.type, published) for c in LISTINGS_STAR.wide_columns
    )
    return f"SELECT {listed} FROM (SELECT *, {baths} AS baths FROM ({RAW_LISTINGS_SQL}) r) b"


CLEAN_SQL = clean_sql()


@query(RAW_LISTINGS_SQL, "listings_raw")
def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_listings(spark, sf_dir)


@query(CLEAN_SQL)
def listings_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_listings(raw_listings(spark, sf_dir), CORRECTED)


@query(clean_sql(published=True))
def listings_clean_as_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_listings(raw_listings(spark, sf_dir), AS_PUBLISHED)


def _dim(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = LISTINGS_STAR.table(name)
    clean = clean_listings(raw_listings(spark, sf_dir))
    return extract_dim(clean, spec.attribute_names, spec.key)


for _spec in LISTINGS_STAR.dimensions:
    if not _spec.natural_key:
        query(O.dim(CLEAN_SQL, _spec.attribute_names, _spec.key), f"listings_{_spec.name}")(
            partial(_dim, _spec.name)
        )


def _table_sql(name: str) -> str:
    """Keys of sub-dimensions by rank over the wide rows; no join needed."""
    spec = LISTINGS_STAR.table(name)
    surrogate = {
        r.column: O.rank_key(LISTINGS_STAR.wide_attributes(r.table))
        for r in spec.references
        if not LISTINGS_STAR.table(r.table).natural_key
    }
    listed = ", ".join(
        f"{surrogate[c.name]} AS {c.name}" if c.name in surrogate else c.name
        for c in LISTINGS_STAR.table_columns(name)
    )
    return f"SELECT DISTINCT * FROM (SELECT {listed} FROM ({CLEAN_SQL}) c) t"


@query(_table_sql("host"))
def listings_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_listings(raw_listings(spark, sf_dir), key_kind="dense", only=["host"])["host"]


@query(_table_sql("listings"))
def listings_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_listings(raw_listings(spark, sf_dir), key_kind="dense", only=["listings"])["listings"]


@query(_table_sql("listings"))
def listings_fact_split_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lookup with hot groups split off; a third of the rows is one group."""
    return load_listings(raw_listings(spark, sf_dir), key_kind="dense", hot_share=0.001, only=["listings"])["listings"]


@query(_table_sql("listings"))
def listings_fact_one_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six lookups in one join and one regrouping by row."""
    return load_listings(raw_listings(spark, sf_dir), key_kind="dense", one_shuffle=True, only=["listings"])["listings"]


_PARTIAL = {k: PARTIAL_KEYS[k] for k in ("property", "scrapings")}
_PARTIAL_STAR = with_partial_keys(LISTINGS_STAR, _PARTIAL)


def _partial_sql() -> str:
    """Ranks over all attributes, but only where no compared column is NULL."""
    columns = []
    for c in _PARTIAL_STAR.table_columns("listings"):
        ref = {r.column: r for r in _PARTIAL_STAR.fact.references}.get(c.name)
        if ref is None or ref.table == "host":
            columns.append(c.name)
            continue
        attributes = _PARTIAL_STAR.wide_attributes(ref.table)
        present = " AND ".join(f"{a} IS NOT NULL" for a in ref.on or attributes)
        columns.append(f"CASE WHEN {present} THEN {O.rank_key(attributes)} END AS {c.name}")
    return f"SELECT {', '.join(columns)} FROM ({clean_sql(published=True)}) c"


@query(_partial_sql())
def listings_fact_as_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rules: keys by fewer columns, which are tested first, and NULL never
    matching, so that rows with a NULL among those columns have no key."""
    return load_listings(
        raw_listings(spark, sf_dir),
        rules=AS_PUBLISHED,
        star=_PARTIAL_STAR,
        key_kind="dense",
        null_safe=False,
        only=["listings"],
    )["listings"]


def _fan_out_sql(pair: Sequence[str]) -> str:
    """All three shorter keys: listings by the neighbourhoods of their pair of columns."""
    attributes = LISTINGS_STAR.table("neighbourhoods").attribute_names
    facts = _partial_sql().replace("SELECT ", f"SELECT {', '.join(pair)}, ", 1)
    dim = O.dim(clean_sql(published=True), attributes, "found_id")
    listed = ", ".join(
        "found_id AS neighbourhood_id" if c.name == "neighbourhood_id" else f"f.{c.name} AS {c.name}"
        for c in LISTINGS_STAR.table_columns("listings")
    )
    match = " AND ".join(f"f.{c} = n.{c}" for c in pair)
    return f"SELECT {listed} FROM ({facts}) f LEFT JOIN ({dim}) n ON {match}"


def _fan_out(pair: Sequence[str], spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rules in full: a listing comes once for each neighbourhood of its pair of columns."""
    return load_listings(
        raw_listings(spark, sf_dir),
        rules=AS_PUBLISHED,
        star=with_partial_keys(LISTINGS_STAR, PARTIAL_KEYS | {"neighbourhoods": pair}),
        key_kind="dense",
        null_safe=False,
        allow_fan_out=True,
        only=["listings"],
    )["listings"]


for _name, _pair in (
    ("listings_fact_fan_out", PARTIAL_KEYS["neighbourhoods"]),
    ("listings_fact_fan_out_overview", OVERVIEW_KEY),
):
    query(_fan_out_sql(_pair), _name)(partial(_fan_out, _pair))


def _no_key_sql() -> str:
    parts = []
    for ref in _PARTIAL_STAR.fact.references:
        if ref.table != "host":
            absent = " OR ".join(f"{a} IS NULL" for a in ref.on or _PARTIAL_STAR.wide_attributes(ref.table))
            parts.append(f"SELECT '{ref.column}' AS column_name, host_id FROM c WHERE {absent}")
    return f"""WITH c AS ({clean_sql(published=True)})
    SELECT column_name, host_id, count(*) AS n_listings FROM ({' UNION ALL '.join(parts)}) u
    GROUP BY column_name, host_id"""


@query(_no_key_sql())
def listings_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which hosts have listings that got no key under the published rules, and how many."""
    facts = listings_fact_as_published(spark, sf_dir)
    keys = [r.column for r in _PARTIAL_STAR.fact.references if r.table != "host"]
    missing = F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys]))
    return (
        facts.select("host_id", F.explode(missing).alias("column_name"))
        .groupBy("column_name", "host_id")
        .agg(F.count(F.lit(1)).alias("n_listings"))
    )


def _discovery_sql() -> str:
    parts = []
    for name, key in PARTIAL_KEYS.items():
        attributes = ", ".join(LISTINGS_STAR.table(name).attribute_names)
        parts.append(
            f"""SELECT '{name}' AS table_name, '{', '.join(key)}' AS columns, CAST(sum(n) AS BIGINT) AS n_rows,
            count(*) AS n_distinct, sum(n) = count(*) AS is_key
            FROM (SELECT count(*) AS n FROM (SELECT DISTINCT {attributes} FROM c) d GROUP BY {', '.join(key)}) g"""
        )
    return f"WITH c AS ({CLEAN_SQL}) {' UNION ALL '.join(parts)}"


@query(_discovery_sql())
def listings_key_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Do the shorter keys identify the rows of their dimensions?"""
    clean = clean_listings(raw_listings(spark, sf_dir))
    found = [
        candidate_keys(distinct_rows(clean, LISTINGS_STAR.table(name).attribute_names), tuple(key)).select(
            F.lit(name).alias("table_name"), "*"
        )
        for name, key in PARTIAL_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, found)


_KEY_WIDTH = 2


def _minimal_keys_sql() -> str:
    """Every set of up to two columns of every dimension, counted; keys without a smaller key."""
    tables, parts = [], []
    for spec in LISTINGS_STAR.dimensions:
        if spec.natural_key:
            continue
        names = spec.attribute_names
        tables.append(f"{spec.name} AS MATERIALIZED (SELECT DISTINCT {', '.join(names)} FROM c)")
        single = {a: f"(SELECT count(*) FROM (SELECT DISTINCT {a} FROM {spec.name}) s) = n" for a in names}
        size = f"(SELECT count(*) AS n FROM {spec.name}) t"
        parts += [f"SELECT '{spec.name}' AS table_name, '{a}' AS columns, 1 AS width FROM {size} WHERE {single[a]}" for a in names]
        parts += [
            f"SELECT '{spec.name}', '{a}, {b}', 2 FROM {size} WHERE NOT {single[a]} AND NOT {single[b]}"
            f" AND (SELECT count(*) FROM (SELECT DISTINCT {a}, {b} FROM {spec.name}) s) = n"
            for a, b in combinations(names, 2)
        ]
    return f"WITH c AS MATERIALIZED ({CLEAN_SQL}), {', '.join(tables)} {' UNION ALL '.join(parts)}"


@query(_minimal_keys_sql())
def listings_minimal_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest keys of every dimension, found by search."""
    store = workspace(spark)
    clean = store.save("clean", clean_listings(raw_listings(spark, sf_dir)))
    found = []
    for spec in LISTINGS_STAR.dimensions:
        if not spec.natural_key:
            rows = store.save(spec.name, distinct_rows(clean, spec.attribute_names))
            found += [(spec.name, key) for key in minimal_keys(rows, width=_KEY_WIDTH, staged=True)]
    return key_table(spark, found)


_TWO_VERSIONS = "CASE WHEN id % 2 = 0 THEN host_about ELSE 'Moved here in ' || CAST(host_id AS STRING) END"


@query(
    f"""WITH r AS (SELECT id, host_id, {_TWO_VERSIONS} AS host_about FROM ({RAW_LISTINGS_SQL}) r),
    v AS (SELECT host_id, count(*) AS n FROM (SELECT DISTINCT host_id, host_about FROM r) d GROUP BY host_id)
    SELECT 'fact_rows' AS measure, count(*) AS n FROM r
    UNION ALL SELECT 'repeated_hosts', count(*) FROM v WHERE n > 1
    UNION ALL SELECT 'joined_rows', CAST(sum(n) AS BIGINT) FROM r JOIN v ON r.host_id = v.host_id"""
)
def listings_two_host_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts with two versions: the fact keeps its rows, the check names the hosts, and
    joining back multiplies rows only as it was asked to."""
    raw = raw_listings(spark, sf_dir).withColumn("host_about", F.expr(_TWO_VERSIONS))
    tables = load_listings(raw)
    measures = {
        "fact_rows": tables["listings"],
        "repeated_hosts": pk_violations(tables["host"], "host_id"),
        "joined_rows": denormalize(LISTINGS_STAR, tables, allow_fan_out=True),
    }
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(m).alias("measure"), "n") for m, df in measures.items()]
    return reduce(DataFrame.unionByName, counts)


_HOST_ATTRIBUTES = [a for a in LISTINGS_STAR.reachable_attributes("host") if a != "host_id"]
_HOST_STRUCT = "{" + ", ".join(f"'{a}': {a}" for a in _HOST_ATTRIBUTES) + "}"
_TWO_VERSIONS_CLEAN_SQL = CLEAN_SQL.replace(f"({RAW_LISTINGS_SQL})", f"(SELECT * REPLACE ({_TWO_VERSIONS} AS host_about) FROM ({RAW_LISTINGS_SQL}) r0)")


@query(
    f"""WITH c AS ({_TWO_VERSIONS_CLEAN_SQL}), h AS (
        SELECT host_id, arg_max({_HOST_STRUCT}, {{'a': last_scraped, 'b': listing_id}}) AS latest FROM c GROUP BY host_id
    )
    SELECT listing_id, host_id, {', '.join(f'latest.{a} AS {a}' for a in _HOST_ATTRIBUTES)} FROM c JOIN h USING (host_id)"""
)
def listings_host_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts with two versions: every listing joined back with its host's latest one."""
    raw = raw_listings(spark, sf_dir).withColumn("host_about", F.expr(_TWO_VERSIONS))
    tables = load_listings(raw, latest={"host": ["last_scraped", "listing_id"]})
    return denormalize(LISTINGS_STAR, tables, columns=["listing_id", "host_id", *_HOST_ATTRIBUTES])


_RANGES_SQL = f"""WITH r AS (SELECT host_id, last_scraped, {_TWO_VERSIONS} AS host_about FROM ({RAW_LISTINGS_SQL}) r),
    d AS (SELECT host_id, last_scraped, max(host_about) AS host_about FROM r GROUP BY host_id, last_scraped),
    s AS (
        SELECT *, row_number() OVER w = 1 OR lag(host_about) OVER w IS DISTINCT FROM host_about AS new FROM d
        WINDOW w AS (PARTITION BY host_id ORDER BY last_scraped)
    )
    SELECT host_id, host_about, last_scraped AS valid_from,
           lead(last_scraped) OVER (PARTITION BY host_id ORDER BY last_scraped) AS valid_to FROM s WHERE new"""


@query(_RANGES_SQL)
def listings_host_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of hosts with the scrapes between which they were valid."""
    raw = raw_listings(spark, sf_dir).withColumn("host_about", F.expr(_TWO_VERSIONS))
    return version_ranges(raw, "host_id", ["host_about"], "last_scraped")


def _broken_sql() -> str:
    repeated = "count(*) FILTER (WHERE id % 20 = 1) + max(CASE WHEN id % 50 = 0 THEN 1 ELSE 0 END)"
    parts = [
        "SELECT 'schema' AS \"check\", NULL AS column_name, CAST(1 AS BIGINT) AS violations",
        f"SELECT 'primary_key', 'listing_id', CAST({repeated} AS BIGINT) FROM r",
    ]
    for ref in LISTINGS_STAR.fact.references:
        n = "count(*) FILTER (WHERE id % 30 = 2)" if ref.column == "scraping_id" else "count(*) * 0"
        parts.append(f"SELECT 'foreign_key', '{ref.column}', CAST({n} AS BIGINT) FROM r")
    return f"WITH r AS ({RAW_LISTINGS_SQL}) {' UNION ALL '.join(parts)}"


@query(_broken_sql())
def listings_checks_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks over facts with repeated and NULL ids, keys without a parent and a wrong type."""
    tables = load_listings(raw_listings(spark, sf_dir))
    facts = tables["listings"]
    row = F.col("listing_id")
    broken = (
        facts.union(facts.where(row % 20 == 1))
        .withColumn("scraping_id", F.when(row % 30 == 2, F.lit(-1).cast("long")).otherwise(F.col("scraping_id")))
        .withColumn("instant_bookable", F.col("instant_bookable").cast("string"))
        .withColumn("listing_id", F.when(row % 50 != 0, row))
    )
    found = check_star(LISTINGS_STAR, {**tables, "listings": broken})
    return found.where("table_name = 'listings' AND check <> 'text_width'").drop("table_name")


@query(CLEAN_SQL)
def listings_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten tables with hash keys, joined back: the clean wide table again."""
    return denormalize(LISTINGS_STAR, load_listings(raw_listings(spark, sf_dir)))


def _checks_sql() -> str:
    parts = []
    for name in LISTINGS_STAR.write_order:
        spec = LISTINGS_STAR.table(name)
        parts.append(f"SELECT '{name}', 'schema', NULL, CAST(0 AS BIGINT)")
        parts.append(f"SELECT '{name}', 'primary_key', '{spec.key}', CAST(0 AS BIGINT)")
        parts += [
            f"SELECT '{name}', 'foreign_key', '{r.column}', CAST(0 AS BIGINT)"
            for r in spec.references
        ]
        own = ", ".join(LISTINGS_STAR.wide_attributes(name))
        parts += [
            f"SELECT '{name}', 'text_width', '{c.name}', count(*) FILTER (WHERE length({c.name}) > {c.max_len})"
            f" FROM (SELECT DISTINCT {own} FROM ({CLEAN_SQL}) c) t"
            for c in LISTINGS_STAR.table_columns(name)
            if c.max_len is not None
        ]
    listed = " UNION ALL ".join(parts)
    return f'SELECT t.a AS table_name, t.b AS "check", t.c AS column_name, t.d AS violations FROM ({listed}) t(a, b, c, d)'


@query(_checks_sql())
def listings_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema, keys, references and widths of all ten written tables."""
    return check_star(LISTINGS_STAR, load_listings(raw_listings(spark, sf_dir)))


_LISTED = ", ".join(f"('{n}')" for n in NEIGHBOURHOODS)


@query(
    f"""SELECT neighbourhood_cleansed, count(*) AS n_rows FROM ({RAW_LISTINGS_SQL}) r
    WHERE neighbourhood_cleansed NOT IN (SELECT v FROM (VALUES {_LISTED}) t(v))
    GROUP BY neighbourhood_cleansed"""
)
def listings_unknown_neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.createDataFrame([(n,) for n in NEIGHBOURHOODS], "known string")
    return not_in_list(raw_listings(spark, sf_dir), "neighbourhood_cleansed", known, "known")


@query(
    f"""SELECT room_type, host_is_superhost, count(*) AS n_listings,
    CAST(sum(daily_price) AS DECIMAL(25,2)) AS total_price,
    count(*) FILTER (WHERE first_review IS NULL) AS n_unreviewed
    FROM ({CLEAN_SQL}) c GROUP BY room_type, host_is_superhost"""
)
def listings_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report over the star read back: fact, property, reviews, host and sub-dimension."""
    full = denormalize(LISTINGS_STAR, load_listings(raw_listings(spark, sf_dir)))
    return full.groupBy("room_type", "host_is_superhost").agg(
        F.count(F.lit(1)).alias("n_listings"),
        F.sum("daily_price").cast("decimal(25,2)").alias("total_price"),
        F.count(F.when(F.col("first_review").isNull(), 1)).alias("n_unreviewed"),
    )
