"""One enterprise identity per party across two systems, from exact keys only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators.skew import heavy_keys, lookup_join

SYSTEMS = ("ims", "cbs")
ROWS_PER_SALT = 10_000
HEX_DIGITS = 10
BLOCK = ("phone_key", "country")


def add_match_key(parties: DataFrame) -> DataFrame:
    """``match_key`` and ``match_tier`` by the first rule a record has the data for.

    Document id, else name with birth date and country, else the record stands alone. A record
    with an id never falls back to its name.
    """
    has_id = F.col("id_key").isNotNull()
    by_name = F.concat(
        F.lit("NDC:"), "name_key", F.lit("|"), F.col("date_of_birth").cast("string"),
        F.lit("|"), "country",
    )
    alone = F.concat(F.lit("SINGLETON:"), "source_system", F.lit(":"), "source_id")
    tier = (
        F.when(has_id, "id_number").when(by_name.isNotNull(), "name_dob_country")
        .otherwise("unmatched")
    )
    key = F.when(has_id, F.concat(F.lit("ID:"), "id_key")).otherwise(F.coalesce(by_name, alone))
    return parties.withColumn("match_key", key).withColumn("match_tier", tier)


def enterprise_id(match_key: Column | str, hex_digits: int = HEX_DIGITS) -> Column:
    """Stable id out of the match key. Ten hex digits (40 bits) equal the reference; beyond a
    million identities take more. The night is blocked by ``id_collisions``."""
    digest = F.md5(F.col(match_key) if isinstance(match_key, str) else match_key)
    return F.concat(F.lit("ECID-"), F.upper(F.substring(digest, 1, hex_digits)))


def crosswalk(matched: DataFrame, hex_digits: int = HEX_DIGITS) -> DataFrame:
    """Every record with its enterprise id. The id is a function of the key: no join, no shuffle."""
    return matched.select(
        enterprise_id("match_key", hex_digits).alias("enterprise_client_id"),
        "source_system", "source_id", "match_tier", "name_key", "date_of_birth", "country",
        "id_key", "phone_key", "gender_norm", "is_minor",
    )


def id_collisions(matched: DataFrame, hex_digits: int = HEX_DIGITS) -> DataFrame:
    """Enterprise ids shared by different match keys; must stay empty."""
    digest = F.sha2("match_key", 256)  # fixed width, so min and max stay cheap on long keys
    return (
        matched.groupBy(enterprise_id("match_key", hex_digits).alias("enterprise_client_id"))
        .agg(F.min(digest).alias("_low"), F.max(digest).alias("_high"))
        .filter("_low <> _high")
        .select("enterprise_client_id")
    )


def _in_system(system: str) -> Column:
    return F.col("source_system") == system


def identity_conflicts(
    links: DataFrame, systems: tuple[str, str] = SYSTEMS
) -> DataFrame:
    """Identities whose linked records disagree on country or birth date."""
    a, b = systems
    per_id = links.groupBy("enterprise_client_id").agg(
        F.count_if(_in_system(a)).alias(f"{a}_record_count"),
        F.count_if(_in_system(b)).alias(f"{b}_record_count"),
        F.countDistinct("country").alias("distinct_country_count"),
        F.countDistinct("date_of_birth").alias("distinct_dob_count"),
    )
    present = [F.when(F.col(f"{s}_record_count") > 0, 1).otherwise(0) for s in systems]
    per_id = per_id.select(
        "enterprise_client_id", (present[0] + present[1]).cast("long").alias("system_count"),
        f"{a}_record_count", f"{b}_record_count", "distinct_country_count", "distinct_dob_count",
    )
    return per_id.filter("distinct_country_count > 1 or distinct_dob_count > 1")


def identity_summary(
    links: DataFrame, matched: DataFrame, systems: tuple[str, str] = SYSTEMS
) -> DataFrame:
    """One row of counts over all identities.

    'Do the linked records disagree' needs only the least and greatest value, which combine
    before the shuffle; review pairs are counted without being formed.
    """
    a, b = systems
    per_id = links.groupBy("enterprise_client_id").agg(
        F.count_if(_in_system(a)).alias("in_a"),
        F.count_if(_in_system(b)).alias("in_b"),
        ((F.min("country") < F.max("country"))
         | (F.min("date_of_birth") < F.max("date_of_birth"))).alias("differs"),
        F.min("match_tier").alias("tier"),
    )
    in_a, in_b = F.col("in_a") > 0, F.col("in_b") > 0
    totals = per_id.agg(
        F.count("*").alias("total_enterprise_clients"),
        F.count_if(in_a & in_b).alias("matched_across_systems"),
        F.count_if(in_a & ~in_b).alias(f"{a}_only_unmatched"),
        F.count_if(in_b & ~in_a).alias(f"{b}_only_unmatched"),
        F.count_if(F.col("tier") == "id_number").alias("matched_via_id_number"),
        F.count_if(F.col("tier") == "name_dob_country").alias("matched_via_name_dob_country"),
        F.count_if("differs").alias("conflicting_attribute_ecids"),
    )
    pairs = review_pair_count(matched, systems).scalar()
    return totals.select("*", pairs.alias("review_queue_pairs"))


# --- review queue -------------------------------------------------------------------------
# Records of different systems that share a phone and a country but not a match key are for a
# person to decide. The queue has one row per record with the exact number of its partners, in
# blocks of any size; the partners of chosen records are listed on request.


def _members(matched: DataFrame) -> DataFrame:
    return matched.filter(F.col("phone_key").isNotNull() & F.col("country").isNotNull()).select(
        "source_system", "source_id", "match_key", *BLOCK
    )


def _sizes(members: DataFrame, by: tuple[str, ...], systems: tuple[str, str]) -> DataFrame:
    a, b = systems
    return members.groupBy(*by).agg(
        F.count_if(_in_system(a)).alias("n_a"), F.count_if(_in_system(b)).alias("n_b")
    )


def _product(a: str = "n_a", b: str = "n_b") -> Column:
    return F.col(a).cast("decimal(18,0)") * F.col(b).cast("decimal(18,0)")


def review_pair_count(
    matched: DataFrame, systems: tuple[str, str] = SYSTEMS, ordered: bool = True
) -> DataFrame:
    """Number of review pairs (one row), by counting: per block all cross-system pairs, less those
    that share the match key. ``ordered`` counts each pair in both directions."""
    members = _members(matched)
    per_block = _sizes(members, BLOCK, systems).select(_product().alias("pairs"))
    merged = _sizes(members, (*BLOCK, "match_key"), systems).select((-_product()).alias("pairs"))
    total = per_block.unionAll(merged).agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("p"))
    return total.select((F.col("p") * (2 if ordered else 1)).cast("long").alias("pairs"))


def review_queue(
    matched: DataFrame, systems: tuple[str, str] = SYSTEMS, **heavy_options
) -> DataFrame:
    """Every record that has partners, with their number.

    Partners are counted as the other system's records of the block less those of its match key,
    so the queue is as long as the records and no pair is formed.
    """
    a, _ = systems
    members = _members(matched)
    block_heavy, group_heavy = heavy_keys(
        members, BLOCK, (*BLOCK, "match_key"), **heavy_options
    )
    groups = _sizes(members, (*BLOCK, "match_key"), systems).withColumnsRenamed(
        {"n_a": "g_a", "n_b": "g_b"})
    both = _sizes(members, BLOCK, systems).filter(_product() > 0)
    rows = lookup_join(members, both, BLOCK, block_heavy, "inner")
    rows = lookup_join(rows, groups, (*BLOCK, "match_key"), group_heavy, "inner")
    partners = F.when(_in_system(a), F.col("n_b") - F.col("g_b")).otherwise(
        F.col("n_a") - F.col("g_a"))
    return rows.withColumn("partner_count", partners).filter("partner_count > 0").select(
        "source_system", "source_id", "match_key", *BLOCK, "partner_count"
    )


def review_partners(
    matched: DataFrame, wanted: DataFrame, rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Partners of the chosen records (``source_system``, ``source_id``), in blocks of any size.

    The output is as long as the chosen records' partner counts say. A block of more than
    ``rows_per_salt`` records is dealt over several tasks; the chosen records go to each of them.
    """
    members = _members(matched)
    large = members.groupBy(*BLOCK).agg(
        F.ceil(F.count("*") / rows_per_salt).cast("int").alias("_salts")).filter("_salts > 1")
    chosen = members.join(wanted.select("source_system", "source_id").distinct(),
                          ["source_system", "source_id"], "left_semi")
    one = chosen.select(
        *BLOCK, F.col("source_system").alias("system_a"), F.col("source_id").alias("source_id_a"),
        F.col("match_key").alias("match_key_a"))
    two = members.select(
        *BLOCK, F.col("source_system").alias("system_b"), F.col("source_id").alias("source_id_b"),
        F.col("match_key").alias("match_key_b"))
    salts = F.coalesce("_salts", F.lit(1))
    one = one.join(large, list(BLOCK), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    two = two.join(large, list(BLOCK), "left").withColumn(
        "_salt", F.pmod(F.xxhash64("system_b", "source_id_b"), salts).cast("int")).drop("_salts")
    return one.join(two, [*BLOCK, "_salt"]).filter(
        "system_a <> system_b and match_key_a <> match_key_b"
    ).select("system_a", "source_id_a", "match_key_a", "system_b", "source_id_b", "match_key_b",
             *BLOCK)
