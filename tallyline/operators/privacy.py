"""Column classes: what may be loaded and what may leave."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.checks import columns_of

# The six column classes, least to most protected.
CLASSES = ("public", "internal", "personal", "sensitive", "restricted", "excluded")
CLASS_KEY = "classification"


def tag_columns(df: DataFrame, classes: Mapping[str, str]) -> DataFrame:
    """Attach each column's class to the schema, from where projections and writes keep it."""
    for column in df.columns:
        if column in classes:
            df = df.withMetadata(column, {CLASS_KEY: classes[column]})
    return df


def column_classes(df: DataFrame) -> dict[str, str]:
    return {
        f.name: f.metadata[CLASS_KEY] for f in df.schema.fields if CLASS_KEY in f.metadata
    }


def drop_classes(
    df: DataFrame, classes: Mapping[str, str], forbidden: Iterable[str] = ("excluded",)
) -> DataFrame:
    """Project the forbidden classes away; right above a scan they are never read."""
    banned = set(forbidden)
    return df.select(*[c for c in df.columns if classes.get(c) not in banned])


def guard_classified(
    layers: Mapping[str, Mapping[str, DataFrame]],
    classes: Mapping[str, str],
    forbidden: Iterable[str] = ("excluded",),
) -> DataFrame:
    """Columns of a forbidden class found in any table of any layer, by name or by tag."""
    banned = set(forbidden)
    tables = [(layer, name, df) for layer, group in layers.items() for name, df in group.items()]
    spark = tables[0][2].sparkSession
    by_name = {c for c, cls in classes.items() if cls in banned}
    tagged = {
        (layer, name, c)
        for layer, name, df in tables for c, cls in column_classes(df).items() if cls in banned
    }
    catalogue = columns_of(
        spark, {layer: {n: df.columns for n, df in group.items()} for layer, group in layers.items()}
    )
    hit = F.col("column_name").isin(*by_name) if by_name else F.lit(False)
    for layer, name, column in sorted(tagged):
        hit = hit | (
            (F.col("layer") == layer) & (F.col("table_name") == name)
            & (F.col("column_name") == column)
        )
    return catalogue.filter(hit)


def guard_values(
    layers: Mapping[str, Mapping[str, DataFrame]],
    classes: Mapping[str, str],
    forbidden: Iterable[str] = ("excluded",),
) -> DataFrame:
    """The columns ``guard_classified`` finds, each with its number of non-null values, counted in
    one scan per table. A listed column without values leaked its name only."""
    found = guard_classified(layers, classes, forbidden).collect()  # bounded by the schemas
    tables: dict[tuple[str, str], list[str]] = {}
    for row in found:
        tables.setdefault((row["layer"], row["table_name"]), []).append(row["column_name"])
    any_table = next(df for group in layers.values() for df in group.values())
    out = any_table.sparkSession.createDataFrame(
        [], "layer string, table_name string, column_name string, n_values long")
    for (layer, name), columns in tables.items():
        counts = layers[layer][name].agg(*[F.count(F.col(c)).alias(c) for c in columns])
        each = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_values")) for c in columns]))
        out = out.unionByName(counts.select(each.alias("v")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "v.*"))
    return out
