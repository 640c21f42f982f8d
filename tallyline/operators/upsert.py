"""Keyed load: repeat a file and nothing changes, correct a row and it is replaced."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators.dedup import keep_latest
from tallyline.operators.skew import heavy_keys, lookup_join

CONTENT = "_content"


def upsert_by_key(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: Sequence[str],
    order_by: Sequence[Column] = (),
    ignore: Sequence[str] = (),
    **heavy_options,
) -> DataFrame:
    """``existing`` with the rows of ``incoming`` replaced or added by key.

    Among incoming rows of one key the first by ``order_by`` counts. A row without a key matches
    nothing by key; it counts as loaded when a row of the same content is there (``ignore``
    names load stamps left out of that comparison), so that bad rows reach validation
    and loading them again adds nothing.

    The result is a new table: Parquet cannot be replaced while it is read. ``merge_load`` in
    ``tallyline.sources.merge`` does the same to a stored table, rewriting only what changed.
    """
    latest = latest_by_key(incoming, key, order_by, ignore, **heavy_options)
    if existing is None:
        return latest
    kept = without_matches(existing, latest, key, ignore)
    return kept.unionByName(latest, allowMissingColumns=True)


def latest_by_key(
    incoming: DataFrame,
    key: Sequence[str],
    order_by: Sequence[Column] = (),
    ignore: Sequence[str] = (),
    **heavy_options,
) -> DataFrame:
    """One incoming row per key, or per content where the key is missing."""
    rows = match_columns(incoming, key, ignore)
    match = [*key, CONTENT]
    (heavy,) = heavy_keys(rows, match, **heavy_options)
    return keep_latest(rows, match, order_by, heavy).drop(CONTENT)


def last_file_rows(
    incoming: DataFrame, key: Sequence[str], file: str, ignore: Sequence[str] = (), **heavy_options
) -> DataFrame:
    """All incoming rows of the last file (by name) that holds their key, or their content where
    the key is missing. Rows repeated within that file stay.

    First the keys are looked for that stand in several files, one slim row a key; where there are none, every row stays as it is.
    """
    rows = match_columns(incoming, key, ignore)
    match = [*key, CONTENT]
    # two hashes of 96 bits together tell files apart: their names would have every row sorted by its key
    one, other = F.xxhash64(file), F.hash(file)
    torn = rows.groupBy(*match).agg(
        F.min(one).alias("a"), F.max(one).alias("b"), F.min(other).alias("c"), F.max(other).alias("d")).filter("a <> b or c <> d")
    if torn.isEmpty():
        return incoming
    names = [f"_last_{c}" for c in match]
    last = rows.groupBy(*match).agg(F.max(file).alias("_last")).withColumnsRenamed(
        dict(zip(match, names, strict=True)))
    # the group of a key is named by a digest, which is never null, so null keys join too
    digest = F.sha2(F.to_json(F.struct(*match)), 256)
    last = last.withColumn("_group", F.sha2(F.to_json(F.struct(
        *[F.col(n).alias(c) for n, c in zip(names, match, strict=True)])), 256)).select("_group", "_last")
    named = rows.withColumn("_group", digest)
    (heavy,) = heavy_keys(named, ["_group"], **heavy_options)
    joined = lookup_join(named, last, ["_group"], heavy, "inner")
    return joined.filter(F.col(file).eqNullSafe(F.col("_last"))).drop("_group", "_last", CONTENT)


def without_matches(
    existing: DataFrame, latest: DataFrame, key: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """Existing rows that ``latest`` does not replace."""
    return _matched(existing, latest, key, ignore, "left_anti")


def with_matches(
    existing: DataFrame, latest: DataFrame, key: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """Existing rows that ``latest`` would replace."""
    return _matched(existing, latest, key, ignore, "left_semi")


def _matched(
    existing: DataFrame, latest: DataFrame, key: Sequence[str], ignore: Sequence[str], how: str
) -> DataFrame:
    match = [*key, CONTENT]
    arriving = match_columns(latest, key, ignore).select(
        *[F.col(c).alias(f"_new_{c}") for c in match])
    same = reduce(
        Column.__and__, [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in match])
    return match_columns(existing, key, ignore).join(arriving, same, how).drop(CONTENT)


def match_columns(df: DataFrame, key: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """Add what a row without a key is recognised by: a digest of its content, else blank."""
    compared = sorted(c for c in df.columns if c not in ignore)
    no_key = reduce(Column.__or__, [F.col(k).isNull() for k in key])
    digest = F.sha2(F.to_json(F.struct(*compared)), 256)
    return df.withColumn(CONTENT, F.when(no_key, digest).otherwise(F.lit("")))
