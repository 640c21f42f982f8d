"""Declared shape and column classes of a source; plain configuration on the driver."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Contract:
    """Exact column set of a source's files. Order is not significant, names are.

    ``renames`` maps this version's names onto the ones used downstream, ``optional`` names
    downstream columns that other versions may lack; both make versions load together.
    ``match`` is a file pattern below the source folder. An ``incremental`` source sends a file
    per day, merged by key; any other sends its whole table each time.
    """

    source: str
    match: str
    columns: tuple[str, ...]
    key: tuple[str, ...] = ()
    version: int = 1
    renames: Mapping[str, str] = field(default_factory=dict)
    optional: tuple[str, ...] = ()
    incremental: bool = False


def map_version(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows of one contract version under the downstream names."""
    return df.withColumnsRenamed(dict(contract.renames))


def union_versions(
    parts: Mapping[Contract, DataFrame] | list[tuple[Contract, DataFrame]], optional: Iterable[str] = ()
) -> DataFrame:
    """Rows of several contract versions in one table; optional columns, and those named as ``optional``, are null where
    absent."""
    items = list(parts.items()) if isinstance(parts, Mapping) else list(parts)
    optional = {*optional, *(c for known, _ in items for c in known.optional)}
    union = None
    for contract, df in items:
        mapped = map_version(df, contract)
        if union is None:
            union = mapped
            continue
        missing = set(union.columns) ^ set(mapped.columns)
        if missing - optional:
            raise ValueError(f"versions differ in required columns: {sorted(missing - optional)}")
        union = union.unionByName(mapped, allowMissingColumns=True)
    for column in sorted(optional):
        if column not in union.columns:
            union = union.withColumn(column, F.lit(None).cast("string"))
    return union
