"""Splitting a clean wide table into a star, and putting it back together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.checks import require_schema
from starmart.operators.collisions import settled_key
from starmart.operators.dim_versions import latest_versions
from starmart.operators.dims import distinct_rows, frequent_shares, frequent_tuples, save_settled_dim
from starmart.operators.keys import has_duplicates, hash_key, narrowed
from starmart.operators.lookup import FanOutError, lookup, lookup_hash, lookup_keys, may_shuffle
from starmart.operators.lookup_all import lookup_all
from starmart.sources.store import UNSEARCHED, Store, workspace
from starmart.spec import Star


def resolve_keys(
    df: DataFrame,
    star: Star,
    table: str,
    tables: Mapping[str, DataFrame],
    kinds: Mapping[str, str],
    hot_share: float | None = None,
    null_safe: bool = True,
    allow_fan_out: bool = False,
    sides: Mapping[str, DataFrame] | None = None,
    key_bits: int = 64,
    one_shuffle: bool = False,
) -> DataFrame:
    """Turn wide rows into rows of ``table``: its key, foreign keys, attributes.

    A key that is a hash of its attributes is computed in the projection: no join
    and no shuffle. Where tuples of the dimension collided, their side table (``sides``) is
    broadcast and compared with the rows that have one of its hashes. Other keys are looked up on the full attribute set, so a
    lookup never multiplies rows. ``tables`` were made of ``df``: each of its tuples is
    there. So where the hashes of a dimension's tuples are tested to be distinct, the
    hash alone finds the row, and rows carry one BIGINT a lookup through
    the shuffles instead of its attributes. Only where hashes meet are tuples compared
    themselves.

    A reference that names fewer columns (``on``) is first tested to identify its
    rows, unless ``allow_fan_out``. Without ``null_safe`` rows with a NULL among the columns
    get no key. ``df`` should read from files: it is scanned a second time to find
    the hot groups of dimensions that Spark does not broadcast. With ``one_shuffle`` all
    lookups by hash are made in one join and one regrouping (``lookup_all``) instead of one
    after another: for facts with several dimensions too large to broadcast.
    """
    spec = star.table(table)
    computed, looked_up, settled = [], [], []
    for ref in spec.references:
        if star.table(ref.table).natural_key:
            continue
        attributes = list(ref.on or star.wide_attributes(ref.table))
        if kinds[ref.table] == "hash" and not ref.on:
            key = narrowed(hash_key(attributes), key_bits)
            side = (sides or {}).get(ref.table)
            if side is not None:
                settled.append((ref, side, attributes))
            if not null_safe:
                key = F.when(reduce(and_, [F.col(a).isNotNull() for a in attributes]), key)
            computed.append(key.alias(ref.column))
        else:
            looked_up.append((ref, attributes))

    written = [c.name for c in star.table_columns(table)]
    sizes = {r.table: tables[r.table].count() for r, _ in looked_up}
    # Small dimensions are broadcast: they go first and make the rows narrower
    # before large ones shuffle them.
    looked_up.sort(key=lambda pair: sizes[pair[0].table])
    lookups, sought = [], {}
    for ref, attributes in looked_up:
        dim = tables[ref.table].withColumnRenamed(star.table(ref.table).key, ref.column)
        given, tuple_hash = lookup_keys(df, dim, attributes), f"_tuple_{ref.column}"
        by_hash = dim.select(lookup_hash(dim, df, attributes).alias(tuple_hash), ref.column, *attributes)
        by_tuple = has_duplicates(by_hash, tuple_hash)
        if by_tuple:
            keys, options = attributes, {"null_safe": null_safe, "check_unique": bool(ref.on), "allow_fan_out": allow_fan_out}
        else:
            by_lookup = lookup_hash(df, dim, attributes)
            computed.append(by_lookup.alias(tuple_hash))
            keys, options, given = [tuple_hash], {"null_safe": False}, [by_lookup]
            # No row finds what a NULL keeps from being found.
            dim = (by_hash if null_safe else by_hash.dropna(subset=attributes)).select(tuple_hash, ref.column)
        if hot_share is not None or may_shuffle(dim, sizes[ref.table]):
            sought[ref.column] = given
        lookups.append((ref.column, dim, keys, {**options, "rows": sizes[ref.table]}))
    hot = frequent_shares(df, sought, hot_share)
    rows = df.select("*", *computed)
    if one_shuffle:
        together = {column: (F.col(keys[0]), dim) for column, dim, keys, _ in lookups if keys[0].startswith("_tuple_")}
        counted = sum(options["rows"] for column, _, _, options in lookups if column in together)
        lookups = [l for l in lookups if l[0] not in together]
        needed = {*written, *[k for _, _, later, _ in lookups for k in later], *[a for _, _, attributes in settled for a in attributes]}
        rows = lookup_all(rows, together, [c for c in rows.columns if c in needed and c not in together], hot, counted)
    for ref, side, attributes in settled:
        rows = settled_key(rows, side, star.table(ref.table).key, attributes, F.col(ref.column), ref.column)
    for i, (column, dim, keys, options) in enumerate(lookups):
        rows = lookup(rows, dim, keys, column, hot=list(hot.get(column, ())), spread_by=[spec.key], **options)
        needed = {*written, *[k for _, _, later, _ in lookups[i + 1 :] for k in later]}
        rows = rows.select(*[c for c in rows.columns if c in needed])
    return rows.select(*written)


def build_star(
    clean: DataFrame,
    star: Star,
    store: Store | None = None,
    key_kind: str = "hash",
    staged: bool = False,
    hot_share: float | None = None,
    parallel_writes: int = 4,
    null_safe: bool = True,
    allow_fan_out: bool = False,
    only: Sequence[str] | None = None,
    key_bits: int = 64,
    one_shuffle: bool = False,
    latest: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """Write the tables of ``star`` in dependency order; return them as read back.

    All tables, or those of ``only`` with the ones whose keys they look up.

    ``clean`` is written once, in the columns that these tables are made of, unless ``staged`` says that it already reads from
    files: each dimension then scans only its own columns. Dimensions with keys of
    ours are written before the tables that refer to them, and those use the written
    keys; a natural key is in the rows already and needs no waiting. Tables
    that do not depend on one another are written by ``parallel_writes`` jobs at a
    time, so that a small dimension does not leave the cluster idle. ``null_safe``,
    ``allow_fan_out`` and ``one_shuffle`` are explained at ``resolve_keys``. ``key_bits`` narrows hash keys;
    where hashes collide, ``<dimension>_collisions`` is written, too (``save_settled_dim``).

    ``latest`` names natural-key dimensions of which each key gets one version, that of the row
    greatest in the wide columns given (``latest_versions``). Without it all versions are written.
    """
    spark = clean.sparkSession
    scratch = replace(workspace(spark), options=UNSEARCHED)
    store = store or workspace(spark)
    def looked_up(name: str) -> list[str]:
        return [r.table for r in star.table(name).references if not star.table(r.table).natural_key]

    wanted = [star.table(n).name for n in only] if only is not None else list(star.write_order)
    for name in wanted:
        wanted += [n for n in looked_up(name) if n not in wanted]

    # Columns of the wanted tables only: cleaning and writing one costs the same whether it is read or not.
    read = {c for n in wanted for c in (star.table(n).key, *star.wide_attributes(n), *(latest or {}).get(n, ()))}
    wide = clean.select(*[c.name for c in star.wide_columns if c.name in read])
    if not staged:
        wide = scratch.save("clean", wide)

    tables: dict[str, DataFrame] = {}
    kinds: dict[str, str] = {}
    sides: dict[str, DataFrame] = {}
    matching = {"hot_share": hot_share, "null_safe": null_safe, "allow_fan_out": allow_fan_out}
    matching |= {"sides": sides, "key_bits": key_bits, "one_shuffle": one_shuffle}

    def write(name: str) -> None:
        spec, schema = star.table(name), star.table_schema(name)
        if name == star.fact.name:
            rows = resolve_keys(wide, star, name, tables, kinds, **matching)
        elif not spec.natural_key:
            saved, kinds[name], side = save_settled_dim(
                wide, name, spec.attribute_names, spec.key, key_kind, store, scratch, key_bits
            )
            if side is not None:
                sides[name] = side
            tables[name] = require_schema(saved, schema)
            return
        elif name in (latest or {}):
            attributes = list(dict.fromkeys([spec.key, *star.wide_attributes(name)]))
            source = scratch.save(f"{name}_rows", latest_versions(wide, spec.key, attributes, latest[name]))
            rows = resolve_keys(source, star, name, tables, kinds, **matching)
        elif all(kinds.get(r.table, "hash") == "hash" and not r.on for r in spec.references):
            # Keys stand for their attributes, so distinct keys are enough.
            rows = resolve_keys(wide, star, name, tables, kinds, **matching).distinct()
        else:
            # Shrink to distinct rows before the joins, not after.
            attributes = list(dict.fromkeys([spec.key, *star.wide_attributes(name)]))
            source = scratch.save(f"{name}_rows", distinct_rows(wide, attributes))
            rows = resolve_keys(source, star, name, tables, kinds, **matching)
        tables[name] = store.save(name, require_schema(rows, schema))

    waiting = [n for n in star.write_order if n in wanted]
    try:
        with ThreadPoolExecutor(max_workers=parallel_writes) as pool:
            while waiting:
                ready = [n for n in waiting if all(d in tables for d in looked_up(n))]
                list(pool.map(write, ready))
                waiting = [n for n in waiting if n not in ready]
    finally:
        scratch.drop(spark)  # the written tables do not depend on it
    return {name: tables[name] for name in star.write_order if name in tables}


def denormalize(
    star: Star,
    tables: Mapping[str, DataFrame],
    table: str | None = None,
    hot_share: float | None = None,
    allow_fan_out: bool = False,
    bucketed: str | None = None,
    broadcast: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Join a table (the fact by default) back with everything it refers to.

    The result has the wide table's columns. Keys are BIGINT, every join is on one
    key and keeps the rows of the left side. Surrogate keys are unique by
    construction; natural keys are tested first, and ``FanOutError`` is raised if one
    has several rows, since the rows that use it would multiply. ``allow_fan_out``
    asks for just that.

    ``bucketed`` names a dimension laid out like the table (``plans.layout``): it is joined first, by a
    merge of buckets, with no hot groups split off. ``broadcast`` names one that the caller has
    counted to be small.

    ``columns`` names the columns of the result, in its order. Tables that have none of them are not
    joined: that would change no row, unless ``allow_fan_out`` lets a natural key multiply them.
    """
    spec = star.table(table or star.fact.name)
    start = tables[spec.name]
    wide = list(dict.fromkeys([spec.key, *spec.attribute_names]))
    joins = []
    for ref in spec.references:
        target = star.table(ref.table)
        added = [c for c in star.reachable_attributes(ref.table) if c not in (target.key, *wide)]
        joins.append((ref, added))
        wide += added
        if target.natural_key and target.key not in wide:
            wide.append(target.key)

    if columns is not None:
        joins = [(r, a) for r, a in joins if {*a, star.table(r.table).key} & {*columns} - {*start.columns} or allow_fan_out]

    sizes = {ref.table: tables[ref.table].count() for ref, _ in joins}
    small = (bucketed, broadcast)
    large = [r.column for r, _ in joins if r.table not in small and (hot_share is not None or may_shuffle(tables[r.table], sizes[r.table]))]
    hot = frequent_tuples(start, {c: [c] for c in large}, hot_share)
    df = start
    # Large dimensions shuffle the rows: they go first, while the rows are narrow.
    for ref, added in sorted(joins, key=lambda join: (join[0].table != bucketed, -sizes[join[0].table])):
        target = star.table(ref.table)
        if target.natural_key and not allow_fan_out and has_duplicates(tables[ref.table], target.key):
            raise FanOutError(f"several rows of {ref.table} share a {target.key}; allow_fan_out joins them all")
        nested = None
        if target.references:
            nested = denormalize(star, tables, ref.table, hot_share, allow_fan_out)
        dim = (tables[ref.table] if nested is None else nested).select(F.col(target.key).alias(ref.column), *added)
        if ref.table == bucketed:
            dim = dim.hint("merge")
        elif ref.table == broadcast:
            dim = F.broadcast(dim)
        df = lookup(
            df,
            dim,
            [ref.column],
            added,
            null_safe=False,
            hot=hot.get(ref.column, ()),
            spread_by=[spec.key],
            rows=None if ref.table in small else sizes[ref.table],
        )
    return df.select(*(wide if columns is None else columns))
