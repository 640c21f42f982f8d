"""One night: arrival gate, raw, staging, identity, conversion, reconciliation, marts, publish.

Each step is written before the next one reads it, so nothing is evaluated twice, a lost
executor costs the step it was in, and a blocked night leaves all its evidence behind.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import checks as c
from tallyline.operators import identity, reconcile
from tallyline.operators import rules as r
from tallyline.operators.privacy import guard_classified
from tallyline.plans import lending as plan
from tallyline.sources.arrival import LOG_SCHEMA, arrival_check
from tallyline.sources.contracts import Contract
from tallyline.sources.merge import merge_load
from tallyline.sources.publish import publish_if
from tallyline.sources.store import SnapshotStore, Version

ARRIVAL_LOG = "arrival_log"
ARRIVAL_LOG_SCHEMA = f"{LOG_SCHEMA}, night date"
STAGED = tuple(s for s in plan.SOURCE_FILES if s != "investment_screening")
_STAMPS = ("_loaded_at", "_source_file")


@dataclass
class NightlyRun:
    """What a night produced. ``published`` is false when the last good outputs were kept."""

    published: bool
    results: DataFrame
    tables: Mapping[str, DataFrame] = field(default_factory=dict)


def load_raw(store: SnapshotStore, contract: Contract, rows: DataFrame) -> DataFrame:
    """Merge an incremental source by key; replace any other. Of several files the last one that
    holds a key counts, with all its rows: repeated keys are for validation to judge."""
    table = f"raw_{contract.source}"
    if contract.incremental:
        return merge_load(store, table, rows, contract.key, ignore=_STAMPS, file="_source_file")
    return store.replace(rows, table)


def load_night(
    store: SnapshotStore,
    source_dir: str,
    contracts: Mapping[str, Contract | Sequence[Contract]] = plan.CONTRACTS,
    classification: Mapping[str, Mapping[str, str]] = plan.CLASSIFICATION,
    checked_at: dt.datetime | None = None,
) -> dict[str, DataFrame | None]:
    """Check what arrived, log every verdict under its night, and load what passed; the raw table of every source.

    ``contracts`` has one contract a source, or its versions, the one with the names used downstream first. A source that was
    rejected or didn't arrive keeps the rows of its last good night (None if there was none).
    """
    versions = {s: [c] if isinstance(c, Contract) else list(c) for s, c in contracts.items()}
    log, accepted = arrival_check(
        store.spark, source_dir, [c for known in versions.values() for c in known], classification, checked_at)
    store.append_log(log.withColumn("night", F.to_date("checked_at")), ARRIVAL_LOG, ["night"])
    return {
        source: load_raw(store, known[0], accepted[source]) if source in accepted else store.read(f"raw_{source}")
        for source, known in versions.items()
    }


def _missing_sources(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(
        [(f"{name} loaded", 1, False) for name in names],
        "check_name string, n_bad long, passed boolean",
    )


def run_nightly(
    spark: SparkSession,
    source_dir: str,
    root: str,
    as_of: dt.date = plan.AS_OF,
    tolerance: float = plan.TOLERANCE,
    contracts: Mapping[str, Contract | Sequence[Contract]] = plan.CONTRACTS,
    classification: Mapping[str, Mapping[str, str]] = plan.CLASSIFICATION,
    **heavy_options,
) -> NightlyRun:
    """Run everything for the files in ``source_dir``; all tables live below ``root``. ``contracts`` and ``classification`` are those of
    ``load_night``."""
    store = SnapshotStore(spark, root)
    lookup = plan.country_lookup(spark)

    raw = load_night(store, source_dir, contracts, classification)
    absent = [s for s in STAGED if raw[s] is None]
    if absent:
        results = _missing_sources(spark, absent)
        return NightlyRun(publish_if(results, {}, store), results)

    versions: dict[str, Version] = {}
    checked: dict[str, DataFrame] = {}
    counts: dict[str, Observation] = {}

    def write(name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        versions[name] = store.stage(df, name, partition_by)
        return store.open(versions[name])

    def keep(source: str, df: DataFrame) -> DataFrame:
        rows, counts[source] = r.observed(df)
        checked[source] = write(f"checked_{source}", rows, [r.QUARANTINED])
        return plan.staged(source, checked[source], as_of)

    stg = {
        "ims_clients": keep("ims_clients", plan.check_clients(
            raw["ims_clients"], lookup, **heavy_options)),
        "cbs_borrowers": keep("cbs_borrowers", plan.check_borrowers(
            raw["cbs_borrowers"], **heavy_options)),
        "fx_rates": keep("fx_rates", plan.check_rates(raw["fx_rates"], **heavy_options)),
        "cbs_control_totals": keep("cbs_control_totals", plan.check_control_totals(
            raw["cbs_control_totals"], lookup, **heavy_options)),
    }
    heavy = plan.heavy_loan_keys(raw["cbs_loans"], **heavy_options)
    stg["cbs_loans"] = keep("cbs_loans", plan.check_loans(
        raw["cbs_loans"], stg["cbs_borrowers"], heavy))
    stg["cbs_repayments"] = keep("cbs_repayments", plan.check_repayments(
        raw["cbs_repayments"], stg["cbs_loans"], **heavy_options))
    quarantine = {s: plan.quarantined(s, df) for s, df in checked.items()}

    parties = write("parties", plan.matched_parties(stg["ims_clients"], stg["cbs_borrowers"]))
    links = write("client_crosswalk", identity.crosswalk(parties))
    mart = write("loan_mart", plan.loan_mart(stg["cbs_loans"], links, stg["fx_rates"], heavy[1]))
    tables = {
        "parties": parties,
        "client_crosswalk": links,
        "loan_mart": mart,
        "review_queue": write("review_queue", identity.review_queue(parties, **heavy_options)),
        "identity_conflicts": write("identity_conflicts", identity.identity_conflicts(links)),
        "identity_summary": write("identity_summary", identity.identity_summary(links, parties)),
        "period_summary": write("period_summary", plan.period_summary(mart)),
        "reconciliation": write("reconciliation", plan.reconciliation(
            stg["cbs_control_totals"], stg["cbs_loans"], r.passed(checked["cbs_repayments"]), tolerance)),
        "dq_summary": write("dq_summary", r.dq_summary(
            spark, counts, {s: raw[s].count() for s in STAGED})),
        **{f"raw_{s}": df for s, df in raw.items() if df is not None},
        **{f"stg_{s}": df for s, df in stg.items()},
        **{f"stg_{s}_quarantine": df for s, df in quarantine.items()},
    }
    results = write("check_results", run_assertions(tables))
    store.commit(versions)
    published = publish_if(
        results,
        {"published_loan_mart": mart, "published_period_summary": tables["period_summary"]},
        store,
    )
    return NightlyRun(published, results, tables)


def run_assertions(t: Mapping[str, DataFrame], hex_digits: int = identity.HEX_DIGITS) -> DataFrame:
    """Everything that must hold before the marts are published; checks on single columns share
    one scan per table. No two match keys may share an enterprise id of ``hex_digits`` digits."""
    loans, paid = t["stg_cbs_loans"], t["stg_cbs_repayments"]
    keys = {
        "stg_ims_clients": "ims_client_id", "stg_cbs_borrowers": "borrower_id",
        "stg_cbs_loans": "loan_id", "stg_cbs_repayments": "txn_id", "loan_mart": "loan_id",
    }
    more = {
        "stg_cbs_loans": ("borrower_id",), "stg_cbs_repayments": ("loan_id",),
        "loan_mart": ("enterprise_client_id", "principal_usd", "fx_rate_used"),
    }
    needed = {table: (key, *more.get(table, ())) for table, key in keys.items()}
    needed |= {"client_crosswalk": ("enterprise_client_id",), "period_summary": ("country",)}
    accepted = {
        "stg_cbs_loans": {
            "currency": plan.CURRENCIES, "status": tuple(plan.LOAN_STATUS.values())},
    }
    expected = [
        t[table].select(F.lit(system).alias("source_system"), F.col(key).alias("source_id"))
        for system, table, key in (("ims", "stg_ims_clients", "ims_client_id"),
                                   ("cbs", "stg_cbs_borrowers", "borrower_id"))
    ]
    excluded = {col: cls for cols in plan.CLASSIFICATION.values() for col, cls in cols.items()
                if cls == "excluded"}
    return c.run_checks(
        {
            **{f"unique_{table}_{key}": c.check_unique(t[table], key)
               for table, key in keys.items()},
            "relationships_loans_borrowers": c.check_relationship(
                loans, "borrower_id", t["stg_cbs_borrowers"], "borrower_id"),
            "relationships_repayments_loans": c.check_relationship(
                paid, "loan_id", loans, "loan_id"),
            "rows_accounted_for": c.check_rows_accounted(t["dq_summary"]),
            "enterprise_ids_unique": identity.id_collisions(t["parties"], hex_digits),
            "crosswalk_complete": c.check_crosswalk(
                expected[0].unionByName(expected[1]), t["client_crosswalk"]),
            "excluded_columns_never_loaded": guard_classified({"all": dict(t)}, excluded),
            "reconciliation_within_tolerance": reconcile.failing(
                t["reconciliation"], plan.MEASURES),
        },
        [c.column_checks(t[table], table, columns, accepted.get(table))
         for table, columns in needed.items()],
    )
