"""Keyed load into a stored table without rewriting what the load does not touch.

A merged table is dealt into buckets by a hash of the key. A new load is written into the buckets of its keys, whole; then its keys
and those that are stored in these buckets are grouped, once and without their rows. That tells which buckets hold a key of
several files, and which hold stored rows that are replaced. Only these are rewritten, and a bucket of which no stored row stays
is left out unread. So a corrected row costs a look at one bucket and its rewriting, and a night of new transactions, or the same
night again, costs the night's rows and a key scan.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallyline.operators.upsert import (
    CONTENT, last_file_rows, latest_by_key, match_columns, with_matches, without_matches,
)
from tallyline.sources.store import BUCKET, SnapshotStore, Version, bucket_of

BUCKETS = 64
MOST_FOLDERS = 16


def bucket_number(key: Sequence[str], buckets: int) -> Column:
    """The bucket of a row: by its key as text, whatever type that is stored in, or by its content where the key is missing."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key], F.col(CONTENT)), F.lit(buckets)).cast("int")


def merge_load(
    store: SnapshotStore,
    table: str,
    incoming: DataFrame,
    key: Sequence[str],
    order_by: Sequence[Column] = (),
    ignore: Sequence[str] = (),
    file: str | None = None,
    ordered: bool = False,
    buckets: int = BUCKETS,
    **heavy_options,
) -> DataFrame:
    """Load ``incoming`` into ``table`` as ``upsert_by_key`` does, and return the table.

    With ``file``, the name of a column, the load keeps every row of the last file that holds a
    key, so that rows repeated within a file stay for validation to judge. With ``ordered``, stored
    rows take part in the choice of the first row by ``order_by``, so that a late load cannot bring
    an older row back. ``buckets`` counts for the first load: choose it so that one bucket is what a single
    correction may rewrite.
    """
    before = store.current(table)
    buckets = before.buckets if before else buckets
    if file:
        added = _staged(store, table, incoming, key, ignore, buckets)
    else:
        if ordered and before is not None:
            again = with_matches(_near(store, before, incoming, key, ignore), incoming, key, ignore)
            incoming = incoming.unionByName(again, allowMissingColumns=True)
        added = _staged(store, table, latest_by_key(incoming, key, order_by, ignore, **heavy_options), key, ignore, buckets)
    asked = before.of_buckets({bucket_of(path) for path in added.paths}) if before else None
    found = _key_counts(store, asked, added, key, ignore, file) if added.paths and (file or asked) else []
    torn = {row[BUCKET] for row in found if row["torn"]}
    if torn:
        rows = last_file_rows(store.open(added.of_buckets(torn)), key, file, ignore, **heavy_options)
        whole = {bucket_of(path) for path in added.paths} - torn
        mended = _staged(store, table, rows, key, ignore, buckets)
        added = replace(added, paths=(*added.of_buckets(whole).paths, *mended.paths))
    version = added if before is None else _merged(store, table, before, added, found, key, ignore)
    store.commit({table: version})
    return store.open(version)


def _near(
    store: SnapshotStore, before: Version, incoming: DataFrame, key: Sequence[str], ignore: Sequence[str]
) -> DataFrame:
    """Stored rows of the buckets that incoming rows fall into."""
    numbers = match_columns(incoming, key, ignore).select(bucket_number(key, before.buckets).alias(BUCKET)).distinct()
    return store.open(before.of_buckets({row[BUCKET] for row in numbers.collect()}))


def _staged(
    store: SnapshotStore, table: str, rows: DataFrame, key: Sequence[str], ignore: Sequence[str], buckets: int,
    in_place: bool = False,
) -> Version:
    dealt = match_columns(rows, key, ignore).withColumn(BUCKET, bucket_number(key, buckets)).drop(CONTENT)
    return store.stage_buckets(dealt, table, buckets, in_place)


def _merged(
    store: SnapshotStore, table: str, before: Version, added: Version, found: Sequence[Row], key: Sequence[str],
    ignore: Sequence[str],
) -> Version:
    """Stored folders that the load leaves alone, its own, and those of buckets rewritten without what it replaces."""
    folders = Counter(bucket_of(path) for path in before.paths)
    # buckets that hold rows the load replaces, or that lie in too many folders
    hit = {row[BUCKET] for row in found if row["replaced"] or folders[row[BUCKET]] >= MOST_FOLDERS}
    some_stay = {row[BUCKET] for row in found if row["stay"]} & hit
    paths = [path for path in before.paths if bucket_of(path) not in hit]
    if some_stay:
        rest = without_matches(store.open(before.of_buckets(some_stay)), store.open(added.of_buckets(some_stay)), key, ignore)
        # tasks behind the join are large or few, so rows that were just shuffled are not shuffled again
        paths += _staged(store, table, rest, key, ignore, before.buckets, in_place=True).paths
    wider = [f for f in added.schema.fields if f.name not in before.schema.names]
    schema = reduce(lambda s, f: s.add(f), wider, type(before.schema)(list(before.schema.fields)))
    return Version(tuple(sorted([*paths, *added.paths])), schema, before.buckets)


def _key_counts(
    store: SnapshotStore, stored: Version | None, added: Version, key: Sequence[str], ignore: Sequence[str], file: str | None
) -> list[Row]:
    """Per bucket of the load: whether one of its keys stands in several files, and how many stored rows are replaced and stay.

    One grouping of the keys of both sides. Rows without a key are known by their content; Parquet statistics skip files
    that have none. Two hashes of 96 bits together tell files apart: their names would have every row sorted by its key.
    """
    has_key = reduce(Column.__and__, [F.col(k).isNotNull() for k in key])
    match = [BUCKET, *key, CONTENT]

    def keys(rows: DataFrame, is_stored: int, *marks: Column) -> DataFrame:
        known = rows.filter(has_key).withColumn(CONTENT, F.lit(""))
        bare = match_columns(rows.filter(~has_key), key, ignore)
        sides = [side.withColumn(BUCKET, bucket_number(key, added.buckets)).select(
            *match, F.lit(is_stored).alias("stored"), *marks) for side in (known, bare)]
        return sides[0].unionAll(sides[1])

    one, other = (F.xxhash64(file), F.hash(file)) if file else (F.lit(0).cast("long"), F.lit(0))
    both = keys(store.open(added), 0, one.alias("one"), other.alias("other"))
    if stored and stored.paths:
        nothing = (F.lit(None).cast("long").alias("one"), F.lit(None).cast("int").alias("other"))
        both = both.unionAll(keys(store.open(stored), 1, *nothing))
    each = both.groupBy(*match).agg(
        F.sum("stored").alias("n"), F.min("one").alias("a"), F.max("one").alias("b"), F.min("other").alias("c"),
        F.max("other").alias("d"))
    arrives = F.col("a").isNotNull()
    return each.groupBy(BUCKET).agg(
        F.coalesce(F.max((F.col("a") != F.col("b")) | (F.col("c") != F.col("d"))), F.lit(False)).alias("torn"),
        F.sum(F.when(arrives, F.col("n")).otherwise(0)).alias("replaced"),
        F.sum(F.when(arrives, 0).otherwise(F.col("n"))).alias("stay")).collect()
