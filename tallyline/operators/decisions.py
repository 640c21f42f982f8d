"""Reviewers' decisions: overrides, the gated export, and scoring against labelled pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.skew import heavy_keys, lookup_join

RECORD = ("source_system", "source_id")


def apply_overrides(links: DataFrame, overrides: DataFrame) -> DataFrame:
    """Crosswalk with the enterprise ids people decided on in place of the computed ones.

    Of several decisions on a record (``source_system``, ``source_id``) the greatest id counts, so
    that no record is doubled.
    """
    decided = overrides.groupBy(*RECORD).agg(F.max("enterprise_client_id").alias("_decided"))
    joined = lookup_join(links, decided, RECORD)
    return joined.select(
        F.coalesce("_decided", "enterprise_client_id").alias("enterprise_client_id"),
        *[c for c in links.columns if c != "enterprise_client_id"],
        F.col("_decided").isNotNull().alias("is_overridden"),
    )


def gated_export(links: DataFrame, confirmed: DataFrame) -> DataFrame:
    """What another system may read: id-number matches, and other records a person confirmed."""
    by_hand = confirmed.select(*RECORD).distinct().withColumn("_confirmed", F.lit(True))
    marked = lookup_join(links, by_hand, RECORD)
    allowed = (F.col("match_tier") == "id_number") | (
        F.col("match_tier").isNotNull() & F.col("_confirmed").isNotNull())
    return marked.filter(allowed).select("enterprise_client_id", *RECORD, "match_tier")


def match_quality(links: DataFrame, labelled: DataFrame, **heavy_options) -> DataFrame:
    """Precision and recall of 'same identity' over labelled pairs of records.

    ``labelled`` has ``source_system_a, source_id_a, source_system_b, source_id_b, is_same``.
    Pairs with a record missing from the crosswalk count as not matched. One record may appear in
    any number of pairs.
    """
    heavy = heavy_keys(
        labelled, *[[f"source_system_{side}", f"source_id_{side}"] for side in "ab"],
        **heavy_options)
    scored = labelled
    for side, hot in zip("ab", heavy, strict=True):
        ids = links.select(
            F.col("source_system").alias(f"source_system_{side}"),
            F.col("source_id").alias(f"source_id_{side}"),
            F.col("enterprise_client_id").alias(f"_id_{side}"),
        )
        scored = lookup_join(scored, ids, [f"source_system_{side}", f"source_id_{side}"], hot)
    same = F.coalesce(F.col("_id_a") == F.col("_id_b"), F.lit(False))
    counts = scored.agg(
        F.count_if(same & F.col("is_same")).alias("true_positives"),
        F.count_if(same & ~F.col("is_same")).alias("false_positives"),
        F.count_if(~same & F.col("is_same")).alias("false_negatives"),
    )
    tp = F.col("true_positives").cast("double")
    return counts.select(
        "*",
        F.try_divide(tp, F.col("true_positives") + F.col("false_positives")).alias("precision"),
        F.try_divide(tp, F.col("true_positives") + F.col("false_negatives")).alias("recall"),
    )
