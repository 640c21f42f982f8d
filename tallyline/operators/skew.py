"""Keeping one heavy key from landing in one task.

``heavy_keys`` measures, with one narrow scan that counts buckets of key hashes, which key
hashes hold more rows than one task should get. The answer holds at most ``1 / share`` keys
whatever the data size. The other functions use that list to salt the heavy rows within the same
plan, so their input is read once. Salting never changes a result, only where a row is processed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKETS = 4096
DEFAULT_SHARE = 0.0001
DEFAULT_MIN_ROWS = 1_000_000
ROWS_PER_SALT = 1_000_000
SALT = "_salt"


@dataclass(frozen=True)
class HeavyKeys:
    """Hashes of heavy keys with their row counts."""

    key: tuple[str, ...]
    rows: Mapping[int, int] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.rows)

    @property
    def largest(self) -> int:
        return max(self.rows.values(), default=0)

    def salts(self, rows_per_salt: int) -> int:
        """Over how many tasks a heavy key is dealt."""
        return max(2, -(-self.largest // rows_per_salt))

    def matches(self, key: Sequence[str] | None = None) -> Column:
        """True on rows of a heavy key. Null keys hash like any other value."""
        return key_hash(key or self.key).isin([int(h) for h in self.rows])


def key_hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in key])


def heavy_keys(
    df: DataFrame,
    *keys: Sequence[str],
    share: float = DEFAULT_SHARE,
    min_rows: int = DEFAULT_MIN_ROWS,
) -> list[HeavyKeys]:
    """Heavy keys of each given column list, all from one scan of just those columns.

    A key is heavy when it holds at least ``min_rows`` rows, a bar that does not grow with the
    data; of more than ``1 / share`` heavy keys the largest count. Rows are counted first, which reads no
    column: fewer than ``min_rows`` of them hold no heavy key. Then the rows of each bucket of key hashes are counted,
    which combine to ``BUCKETS`` rows a task. Only where a bucket holds ``min_rows`` rows are its keys counted, by a second scan.
    """
    if df.count() < min_rows:
        return [HeavyKeys(tuple(k)) for k in keys]
    top = int(1 / share)
    hashed = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("which"), key_hash(k).alias("h")) for i, k in enumerate(keys)])).alias("_")).select("_.*")
    bucket, rows = F.pmod("h", F.lit(BUCKETS)), F.count("*").alias("n")
    full: dict[int, list[int]] = {}
    for row in hashed.groupBy("which", bucket.alias("bucket")).agg(rows).filter(F.col("n") >= min_rows).collect():
        full.setdefault(row["which"], []).append(row["bucket"])
    found: list[dict[int, int]] = [{} for _ in keys]
    if full:
        in_full = reduce(Column.__or__, [(F.col("which") == i) & bucket.isin(some) for i, some in full.items()])
        largest_first = F.row_number().over(W.partitionBy("which").orderBy(F.desc("n"), "h"))
        heavy = hashed.filter(in_full).groupBy("which", "h").agg(rows).filter(F.col("n") >= min_rows)
        for row in heavy.withColumn("place", largest_first).filter(F.col("place") <= top).collect():
            found[row["which"]][row["h"]] = row["n"]
    return [HeavyKeys(tuple(k), counts) for k, counts in zip(keys, found, strict=True)]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    heavy: HeavyKeys | None = None,
    how: str = "left",
) -> DataFrame:
    """Join many rows to a side that is unique on ``on``.

    Rows of a heavy key are dealt over several tasks by a hash of their content; the one row they
    meet travels to each of these. A right side that is not unique joins as usual, only wider.
    """
    on = list(on)
    if not heavy:
        return left.join(right, on, how)
    n = heavy.salts(ROWS_PER_SALT)
    is_heavy = heavy.matches(on)
    dealt = F.when(is_heavy, F.pmod(F.xxhash64(*left.columns), F.lit(n)).cast("int")).otherwise(0)
    everywhere = F.when(is_heavy, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    return left.withColumn(SALT, dealt).join(
        right.withColumn(SALT, F.explode(everywhere)), [*on, SALT], how).drop(SALT)
