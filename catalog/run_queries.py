"""Registered queries on loading, publishing, monitoring, decisions and streams."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.inputs import DERIVED, SOURCES, plain_sql, raw, raw_dealt, scratch, table
from catalog.queries import Lending, register, stored
from tallyline import functions as fn
from tallyline.operators import checks, decisions, history
from tallyline.operators.dedup import latest_first
from tallyline.operators.privacy import drop_classes, guard_values, tag_columns
from tallyline.operators.upsert import upsert_by_key
from tallyline.plans import lending as plan
from tallyline.plans.nightly import ARRIVAL_LOG, ARRIVAL_LOG_SCHEMA, load_night, run_nightly
from tallyline.sources.arrival import check_source, load_accepted
from tallyline.sources.contracts import union_versions
from tallyline.sources.merge import merge_load
from tallyline.sources.publish import publish_if
from tallyline.sources.store import SnapshotStore
from tallyline.streaming.ingest import stream_dedup, stream_files, stream_upsert

# ---- arrival ---------------------------------------------------------------------------------

_PACKED = replace(plan.CONTRACTS["cbs_repayments"], match="*.csv.gz")
_CLASSES = plan.CLASSIFICATION["cbs_repayments_*.csv"]
_DRIFTED = {"amount": "amount_paid"}


def _write_extract(df: DataFrame, folder: str, encoding: str = "UTF-8", **more) -> None:
    """An extract as another system would send it: CSV with a header and doubled quotes."""
    df.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False,
                     ignoreTrailingWhiteSpace=False, encoding=encoding, **more).csv(folder)


def _extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = stored(raw(spark, sf_dir, "cbs_repayments"))  # rendered once for all extracts
    columns = rows.columns
    return {
        "as agreed": rows,
        "other column order": rows.select(*reversed(columns)),
        "renamed and extra": rows.withColumnsRenamed(_DRIFTED).withColumn("agent_code", F.lit("AG")),
        "column missing": rows.drop("channel"),
        "values over lines": rows.withColumn("channel", F.lit('counter "A"\nsecond line, left')),
        "not classified": rows,
    }


_REASON = {
    "renamed and extra": "header does not match contract v1: missing columns [''amount'']; "
                         "unexpected columns [''amount_paid'', ''agent_code'']",
    "column missing": "header does not match contract v1: missing columns [''channel'']",
    "not classified": "columns not classified: [''channel'']",
}


@register("arrival_verdicts", " union all ".join(
    f"select '{name}' as extract, '{'FAIL' if name in _REASON else 'PASS'}' as status, "
    f"'{_REASON.get(name, '')}' as reason, count(*)::bigint as row_count from lineitem"
    for name in ("as agreed", "other column order", "renamed and extra", "column missing",
                 "values over lines", "not classified")))
def arrival_verdicts(spark, sf_dir):
    root = scratch(spark)
    parts = []
    folders: dict[int, str] = {}
    for name, rows in _extracts(spark, sf_dir).items():
        if id(rows) not in folders:  # the extract that lacks a class is the one as agreed
            folders[id(rows)] = f"{root}/{len(folders)}"
            _write_extract(rows, folders[id(rows)], compression="gzip", maxRecordsPerFile=2_000_000)
        known = {c: kind for c, kind in _CLASSES.items() if name != "not classified" or c != "channel"}
        verdicts = check_source(spark, folders[id(rows)], _PACKED, known)
        parts.append(verdicts.groupBy("status", "reason").agg(
            F.sum("row_count").alias("row_count")).select(F.lit(name).alias("extract"), "*"))
    return reduce(DataFrame.unionByName, parts)


@register("arrival_rows", """
    select nullif(borrower_id, '') as borrower_id, nullif(full_name, '') as full_name,
        gender, nullif(date_of_birth, '') as date_of_birth, mobile_no, id_type, id_number, country, branch,
        office_id, created_on
    from raw_cbs_borrowers""")
def arrival_rows(spark, sf_dir):
    """Two extracts with different column orders, one of them excluded from loading."""
    root = scratch(spark)
    contract = replace(plan.CONTRACTS["cbs_borrowers"], match="*.csv")
    classes = plan.CLASSIFICATION["cbs_borrowers.csv"]
    rows = raw(spark, sf_dir, "cbs_borrowers").withColumn(
        "fingerprint_template_ref", F.md5(F.coalesce("borrower_id", F.lit(""))))
    odd = F.pmod(F.length("full_name"), F.lit(2)) == 1
    agreed = rows.select(*contract.columns)
    _write_extract(agreed.filter(odd), f"{root}/one")
    _write_extract(agreed.select(*reversed(contract.columns)).filter(~odd), f"{root}/two")
    accepted = [
        load_accepted(spark, f"{root}/{part}", check_source(spark, f"{root}/{part}", contract, classes),
                      contract, classes)
        for part in ("one", "two")
    ]
    return accepted[0].unionByName(accepted[1]).drop("_source_file", "_loaded_at")


_WITH_LINE = ", l_linenumber, l_suppkey from "  # the repayments with two columns more


@register("contract_v2_union", f"""
    select * exclude (l_linenumber, l_suppkey),
        case when l_linenumber % 2 = 0 then 'AG' || cast(l_suppkey % 50 as string) end as agent_code
    from ({plain_sql("raw_cbs_repayments").replace("from ", _WITH_LINE)})""")
def contract_v2_union(spark, sf_dir):
    first, second = _two_versions(spark, sf_dir)
    return union_versions([(plan.CONTRACTS["cbs_repayments"], first), (plan.REPAYMENTS_V2, second)])


def _twice(source: str, key: str) -> str:
    return f"(select count(*) from (select {key} from {source} where not bad group by {key} having count(*) > 1))"


def _null(source: str, column: str, where: str = "where not bad and") -> str:
    return f"(select count(*) from {source} {where} {column} is null)"


def _orphans(child: str, key: str, parent: str) -> str:
    return (f"(select count(distinct {key}) from {child} where not bad and {key} not in "
            f"(select {key} from {parent} where not bad))")


#: A stand-in for what must never be loaded: rendered from the borrower's id, so that it can be found again.
_FINGERPRINT = "md5(coalesce(borrower_id, ''))"
_BORROWER_COLUMNS = ("borrower_id", "full_name", "gender", "date_of_birth", "mobile_no", "id_type", "id_number", "country",
                     "branch", "office_id", "created_on")

_NIGHT_CHECKS = {
    "unique_stg_ims_clients_ims_client_id": _twice("clients", "ims_client_id"),
    "unique_stg_cbs_borrowers_borrower_id": _twice("borrowers", "borrower_id"),
    "unique_stg_cbs_loans_loan_id": _twice("loans", "loan_id"),
    "unique_stg_cbs_repayments_txn_id": _twice("repayments", "txn_id"),
    "unique_loan_mart_loan_id": "(select count(*) from (from mart select loan_id group by loan_id having count(*) > 1))",
    "not_null_stg_ims_clients_ims_client_id": _null("clients", "ims_client_id"),
    "not_null_stg_cbs_borrowers_borrower_id": _null("borrowers", "borrower_id"),
    "not_null_stg_cbs_loans_loan_id": _null("loans", "loan_id"),
    "not_null_stg_cbs_repayments_txn_id": _null("repayments", "txn_id"),
    "not_null_loan_mart_loan_id": _null("mart", "loan_id", "where"),
    "not_null_stg_cbs_loans_borrower_id": _null("loans", "borrower_id"),
    "not_null_stg_cbs_repayments_loan_id": _null("repayments", "loan_id"),
    "not_null_client_crosswalk_enterprise_client_id": _null("parties", "enterprise_client_id", "where"),
    "not_null_loan_mart_enterprise_client_id": _null("mart", "enterprise_client_id", "where"),
    "not_null_loan_mart_principal_usd": _null("mart", "principal_usd", "where"),
    "not_null_loan_mart_fx_rate_used": _null("mart", "fx_rate_used", "where"),
    "not_null_period_summary_country": "(select count(*) from (from mart select distinct "
                                       "strftime(disbursed_at, '%Y-%m'), currency where country is null))",
    "relationships_loans_borrowers": _orphans("loans", "borrower_id", "borrowers"),
    "relationships_repayments_loans": _orphans("repayments", "loan_id", "loans"),
    "accepted_values_currency": "(select count(*) from loans where not bad and currency not in ('ETB', 'KES', 'RWF', 'SSP', 'XAF'))",
    "accepted_values_status": "(select count(*) from loans where not bad and status not in ('active', 'closed'))",
    "rows_accounted_for": "(select count(*) from accounts where raw_count <> passed_count + quarantined_count)",
    "enterprise_ids_unique": "(select count(*) from (from parties select enterprise_client_id group by all "
                             "having count(distinct match_key) > 1))",
    "crosswalk_complete": "(select count(*) from (from parties select source_system, source_id group by all having count(*) <> 1))",
    # loaded columns in which a fingerprint can be found
    "excluded_columns_never_loaded": "(select " + " + ".join(
        f"(count(*) filter ({c} = {_FINGERPRINT}) > 0)::int" for c in _BORROWER_COLUMNS) + " from raw_cbs_borrowers)",
}


def _night(spark: SparkSession, sf_dir: str, times: int = 1, leak: bool = False):
    """The rendered extracts as CSV, and the night over them, ``times`` times. With ``leak`` the borrowers' classification
    fails to exclude their fingerprints."""
    root = scratch(spark)
    contracts, classification = {}, {}
    for source in SOURCES:
        match = f"{source}/*.csv.lz4"
        # of a source that is merged by key the rows of a key stand in one file, as an export would put them
        rows = raw_dealt(spark, sf_dir) if plan.CONTRACTS[source].incremental else raw(spark, sf_dir, source)
        for excluded in set(plan.CONTRACTS[source].columns) - set(rows.columns):
            rows = rows.withColumn(excluded, F.expr(_FINGERPRINT))
        _write_extract(rows, f"{root}/in/{source}", compression="lz4")
        contracts[source] = replace(plan.CONTRACTS[source], match=match)
        classification[match] = plan.CLASSIFICATION[plan.SOURCE_FILES[source][0]]
        if leak:
            classification[match] = {c: "internal" if kind == "excluded" else kind for c, kind in classification[match].items()}
    for _ in range(times):
        night = run_nightly(spark, f"{root}/in", f"{root}/out", contracts=contracts,
                            classification=classification)
    return night


@register("nightly_checks", "select check_name, n_bad, n_bad = 0 as passed from (" + " union all ".join(
    f"select '{name}' as check_name, {count}::bigint as n_bad" for name, count in _NIGHT_CHECKS.items()) + ")")
def nightly_checks(spark, sf_dir):
    """A whole night from CSV extracts to the checks; the reconciliation has a query of its own."""
    night = _night(spark, sf_dir)
    return night.results.filter("check_name <> 'reconciliation_within_tolerance'")


@register("nightly_accounts", "select * from accounts")
def nightly_accounts(spark, sf_dir):
    """Rows in, passed and quarantined after the same files were loaded twice: rows that a file
    repeats reach quarantine, and the second load changes nothing."""
    return _night(spark, sf_dir, times=2).tables["dq_summary"]


@register("nightly_leak", f"""
    select 'excluded_columns_never_loaded' as check_name, (count({_FINGERPRINT}) > 0)::bigint as n_bad,
        count({_FINGERPRINT}) as n_values, count({_FINGERPRINT}) = 0 as published from raw_cbs_borrowers""")
def nightly_leak(spark, sf_dir):
    """A night whose classification lets an excluded column in: the check finds it in the raw table, by name, and nothing is
    published."""
    night = _night(spark, sf_dir, leak=True)
    leaked = night.tables["raw_cbs_borrowers"].agg(F.count("fingerprint_template_ref").alias("n")).scalar()
    return night.results.filter("check_name = 'excluded_columns_never_loaded'").select(
        "check_name", "n_bad", leaked.alias("n_values"), F.lit(night.published).alias("published"))


# ---- arrivals over several nights ------------------------------------------------------------

_V2_CLASSES = {**_CLASSES, "amount_paid": "internal", "agent_code": "internal"}


def _two_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The repayments of odd line numbers in the first shape, and those of even ones in the second."""
    wide = spark.sql(DERIVED["raw_cbs_repayments"].replace("from ", _WITH_LINE), lineitem=table(spark, sf_dir, "lineitem"))
    even = F.col("l_linenumber") % 2 == 0
    agent = F.concat(F.lit("AG"), (F.col("l_suppkey") % 50).cast("string"))
    second = wide.filter(even).withColumn("agent_code", agent).withColumnsRenamed(_DRIFTED)
    return wide.filter(~even).drop("l_linenumber", "l_suppkey"), second.drop("l_linenumber", "l_suppkey")


_EMPTY_IS_NULL = ", ".join(f"nullif({c}, '') as {c}" for c in plan.CONTRACTS["cbs_repayments"].columns)


@register("nightly_v2", f"""
    select {_EMPTY_IS_NULL}, case when l_linenumber % 2 = 0 then 'AG' || cast(l_suppkey % 50 as string) end as agent_code,
        1 + (l_linenumber % 2 = 0)::int as contract_version
    from ({plain_sql("raw_cbs_repayments").replace("from ", _WITH_LINE)})""")
def nightly_v2(spark, sf_dir):
    """One night takes files of both versions of one source, each recognised by its header, into one raw table."""
    root = scratch(spark)
    first, second = _two_versions(spark, sf_dir)
    for name, rows in (("first", first), ("second", second)):  # the rows of a key stand in one file
        _write_extract(rows.repartition("txn_id"), f"{root}/in/cbs_repayments/{name}")
    match = "cbs_repayments/*/*.csv"
    versions = [replace(c, match=match) for c in (plan.CONTRACTS["cbs_repayments"], plan.REPAYMENTS_V2)]
    store = SnapshotStore(spark, f"{root}/out")
    rows = load_night(store, f"{root}/in", {"cbs_repayments": versions}, {match: _V2_CLASSES})["cbs_repayments"]
    log = store.read_log(ARRIVAL_LOG, ARRIVAL_LOG_SCHEMA).select(F.col("file").alias("_source_file"), "contract_version")
    return rows.join(log, "_source_file").drop("_source_file", "_loaded_at")


def _nights(spark: SparkSession, sf_dir: str, nights: int = 3) -> tuple[SnapshotStore, list[dict[str, DataFrame | None]]]:
    """Three nights of clients (a whole table each), rates (whole) and repayments (day by day).

    First night: all arrive. Second: the clients are not UTF-8, the rates come in another column order, the repayments lack a
    column. Third: no clients, rates renamed, repayments corrected.
    """
    root = scratch(spark)
    store = SnapshotStore(spark, f"{root}/out")
    clients, rates, drifted = (raw(spark, sf_dir, s) for s in ("ims_clients", "fx_rates", "cbs_repayments"))
    paid = raw_dealt(spark, sf_dir)  # the rows of a key stand in one file, where the file is to be loaded
    foreign = clients.filter("lower(first_name) = 'josé'")
    sent = [
        {"ims_clients": (clients, "UTF-8"), "fx_rates": (rates, "UTF-8"), "cbs_repayments": (paid, "UTF-8")},
        {"ims_clients": (foreign, "ISO-8859-1"), "fx_rates": (rates.select(*reversed(rates.columns)).filter("source is not null"), "UTF-8"),
         "cbs_repayments": (drifted.drop("channel"), "UTF-8")},
        {"fx_rates": (rates.withColumnRenamed("source", "origin"), "UTF-8"),
         "cbs_repayments": (paid.filter("txn_id like '%1'").withColumn("channel", F.lit("corrected")), "UTF-8")},
    ]
    loaded = []
    for number, sources in enumerate(sent[:nights], 1):
        contracts, classification = {}, {}
        for source in ("ims_clients", "fx_rates", "cbs_repayments"):
            match = f"night{number}/{source}/*.csv.gz"
            contracts[source] = replace(plan.CONTRACTS[source], match=match)
            classification[match] = plan.CLASSIFICATION[plan.SOURCE_FILES[source][0]]
            if source in sources:
                rows, encoding = sources[source]
                # a file can't be split once it is packed; only one that is loaded by key has to hold all rows of its keys
                whole = plan.CONTRACTS[source].incremental and rows is not drifted
                _write_extract(rows, f"{root}/in/night{number}/{source}", encoding, compression="gzip",
                               maxRecordsPerFile=0 if whole else 1_000_000)
        loaded.append(load_night(store, f"{root}/in", contracts, classification, dt.datetime(2026, 9, number, 2)))
    return store, loaded


_JOSE = "(select count(*) from raw_ims_clients where lower(first_name) = 'josé')"
_PAID_COLUMNS = "missing columns [''channel'']"
_RATE_COLUMNS = "missing columns [''source'']; unexpected columns [''origin'']"


@register("nightly_rejected", """
    select 'ims_clients' as source, 'FAIL' as status, 'could not read file: invalid UTF-8' as reason,
        count(*) as rows_before, count(*) as rows_in_service from raw_ims_clients
    union all select 'fx_rates', 'PASS', '', count(*), count(*) from raw_fx_rates
    union all select 'cbs_repayments', 'FAIL', 'header does not match contract v1: """ + _PAID_COLUMNS + """',
        count(*), count(*) from raw_cbs_repayments""")
def nightly_rejected(spark, sf_dir):
    """A second night with an unreadable file and a drifted one: they fail alone, and what was loaded before stays in service."""
    store, loaded = _nights(spark, sf_dir, nights=2)
    last = store.read_log(ARRIVAL_LOG, ARRIVAL_LOG_SCHEMA).filter("night = date '2026-09-02'")
    verdicts = last.groupBy("source", "status", "reason").agg(F.count("*").alias("n_files")).drop("n_files")
    counts = [
        loaded[1][source].agg(F.count("*").alias("rows_in_service")).select(
            F.lit(source).alias("source"), loaded[0][source].agg(F.count("*")).scalar().alias("rows_before"), "rows_in_service")
        for source in ("ims_clients", "fx_rates", "cbs_repayments")
    ]
    return verdicts.join(F.broadcast(reduce(DataFrame.unionByName, counts)), "source")  # one row a source


@register("arrival_history", f"""
    select date '2026-09-01' as night, 'ims_clients' as source, 'PASS' as status, '' as reason, count(*)::bigint as row_count,
        date '2026-09-01' as last_good_night, 0::bigint as failed_nights from raw_ims_clients
    union all select date '2026-09-02', 'ims_clients', 'FAIL', 'could not read file: invalid UTF-8', null, date '2026-09-01', 1
    union all select date '2026-09-03', 'ims_clients', 'FAIL', 'no file found matching this source''s pattern', null, date '2026-09-01', 2
    union all select date '2026-09-01', 'fx_rates', 'PASS', '', count(*), date '2026-09-01', 0 from raw_fx_rates
    union all select date '2026-09-02', 'fx_rates', 'PASS', '', count(*), date '2026-09-02', 0 from raw_fx_rates
    union all select date '2026-09-03', 'fx_rates', 'FAIL', 'header does not match contract v1: {_RATE_COLUMNS}', count(*),
        date '2026-09-02', 1 from raw_fx_rates
    union all select date '2026-09-01', 'cbs_repayments', 'PASS', '', count(*), date '2026-09-01', 0 from raw_cbs_repayments
    union all select date '2026-09-02', 'cbs_repayments', 'FAIL', 'header does not match contract v1: {_PAID_COLUMNS}', count(*),
        date '2026-09-01', 1 from raw_cbs_repayments
    union all select date '2026-09-03', 'cbs_repayments', 'PASS', '', count(*) filter (txn_id like '%1'), date '2026-09-03', 1
        from raw_cbs_repayments""")
def arrival_history(spark, sf_dir):
    """The log of three nights read back: verdicts a night, the last good night of each source, its bad nights so far."""
    store, _ = _nights(spark, sf_dir)
    return history.arrival_history(store.read_log(ARRIVAL_LOG, ARRIVAL_LOG_SCHEMA))


_SCREENED = f"""
    select c_name as applicant_name, case when c_custkey % 7 = 0 then null when c_custkey % 2 = 0 then '2519' || {{k}} || '.0' else '2519' || {{k}} end as phone,
        'Ethiopia' as country, 'Camp ' || cast(c_nationkey as string) as location,
        lpad(cast(1 + c_custkey % 28 as string), 2, '0') || '/' || lpad(cast(1 + c_custkey % 12 as string), 2, '0') || '/2024' as screened_on,
        case when c_acctbal < 0 then 'Declined' else 'Qualified' end as decision,
        case when c_acctbal < 0 then 'Existing debt, with another lender' end as decline_reason, 'INV-' || c_mktsegment as screened_by
    from {{customer}}""".replace("{k}", "lpad(cast(c_custkey as string), 8, '0')")


@register("raw_screening", """
    select *, try_strptime(screened_on, '%d/%m/%Y')::date as screened_day, regexp_replace(phone, '[.]0$', '') as phone_digits
    from (""" + " union all ".join([_SCREENED.replace("{customer}", "customer")] + [
        _SCREENED.replace("{customer}", "customer where c_custkey % 50 = 0")]) + ")")
def raw_screening(spark, sf_dir):
    """An extract without a key, with day-first dates and phones that went through a spreadsheet. It is loaded raw, whole, twice;
    rows that it repeats stay, and nothing else reads it."""
    root = scratch(spark)
    rows = spark.sql(_SCREENED, customer=table(spark, sf_dir, "customer"))
    again = spark.sql(_SCREENED, customer=table(spark, sf_dir, "customer").filter("c_custkey % 50 = 0"))
    _write_extract(rows.unionAll(again), f"{root}/in/screening")
    match = "screening/*.csv"
    contract = replace(plan.CONTRACTS["investment_screening"], match=match)
    store = SnapshotStore(spark, f"{root}/out")
    for _ in range(2):
        loaded = load_night(store, f"{root}/in", {"investment_screening": contract},
                            {match: plan.CLASSIFICATION["investment_screening.csv"]})["investment_screening"]
    return loaded.select(
        *contract.columns, fn.parse_date("screened_on", ("d/M/yyyy",)).alias("screened_day"),
        fn.phone_digits(fn.whole_number("phone")).alias("phone_digits"))


# ---- keyed load ------------------------------------------------------------------------------

_LOAD_KEY = "case when event_id % 50 = 0 then null else event_id end"
_LOADS = f"""
    select {_LOAD_KEY} as event_id, user_id, event_type, value, 0 as load from events where event_id % 3 <> 0
    union all
    select {_LOAD_KEY}, user_id, event_type, value * 2, 1 from events where event_id % 2 = 0 and event_id % 50 <> 0
    union all select {_LOAD_KEY}, user_id, event_type, value, 1 from events where event_id % 50 = 0"""
_UPSERTED = f"""
    select event_id, user_id, event_type, value from ({_LOADS})
    qualify event_id is not null and row_number() over (partition by event_id order by load desc) = 1
    union all
    select distinct event_id, user_id, event_type, value from ({_LOADS}) where event_id is null"""


def _loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rows already there and an extract that corrects half of them; some rows lack their key."""
    events = table(spark, sf_dir, "events")
    no_key = F.col("event_id") % 50 == 0
    rows = events.select(
        F.when(~no_key, F.col("event_id")).alias("event_id"), "user_id", "event_type", "value",
        F.col("event_id").alias("number"))
    there = rows.filter("number % 3 <> 0").drop("number")
    again = F.when(F.col("event_id").isNull(), F.col("value")).otherwise(F.col("value") * 2)
    extract = rows.filter("number % 2 = 0").withColumn("value", again).drop("number")
    return there, extract


@register("upsert_replace", _UPSERTED)
def upsert_replace(spark, sf_dir):
    there, extract = _loads(spark, sf_dir)
    first = upsert_by_key(None, there, ["event_id"])
    return upsert_by_key(first, extract, ["event_id"])


@register("upsert_twice", _UPSERTED)
def upsert_twice(spark, sf_dir):
    """The same extract merged into a stored table twice."""
    there, extract = _loads(spark, sf_dir)
    store = SnapshotStore(spark, scratch(spark))
    for rows in (there, extract, extract):
        merge_load(store, "loads", rows, ["event_id"])
    return store.read("loads")


# ---- gate, privacy ---------------------------------------------------------------------------


@register("run_checks", """
    select check_name, n_bad, n_bad = 0 as passed from (
        select 'accepted_values_o_orderstatus' as check_name, count(*) as n_bad
        from orders where o_orderstatus not in ('O', 'F')
        union all select 'orders unique', count(*) from (select 1 from orders group by o_orderkey having count(*) > 1)
        union all select 'lines unique', count(*) from (select 1 from lineitem group by l_orderkey having count(*) > 1)
        union all select 'not_null_orders_o_custkey', count(*) from orders where o_custkey is null
        union all select 'customer known', count(distinct o_custkey) from orders anti join customer on c_custkey = o_custkey)""")
def run_checks(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customers = table(spark, sf_dir, "customer")
    columns = checks.column_checks(
        orders, "orders", ["o_custkey"], {"o_orderstatus": ["O", "F"]})
    return checks.run_checks({
        "orders unique": checks.check_unique(orders, "o_orderkey"),
        "lines unique": checks.check_unique(lines, "l_orderkey"),
        "customer known": checks.check_relationship(orders, "o_custkey", customers, "c_custkey"),
    }, [columns])


@register("publish_gate", """
    select o_orderstatus, count(*) as n, 'BLOCKED' as last_status,
        'failed checks: lines unique' as last_reason from orders group by 1""")
def publish_gate(spark, sf_dir):
    """A passing run publishes; a failing run with changed figures leaves the published ones."""
    store = SnapshotStore(spark, scratch(spark))
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    totals = orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    good = {"orders unique": checks.check_unique(orders, "o_orderkey")}
    bad = {**good, "lines unique": checks.check_unique(lines, "l_orderkey")}
    publish_if(checks.run_checks(good), {"totals": totals}, store, dt.datetime(2026, 1, 1))
    publish_if(checks.run_checks(bad), {"totals": totals.withColumn("n", F.col("n") * 2)}, store,
               dt.datetime(2026, 1, 2))
    log = store.read_log("publish_log", "run_at timestamp, status string, reason string")
    last = log.agg(F.max_by("status", "run_at").alias("s"), F.max_by("reason", "run_at").alias("r"))
    return store.read("totals").select(
        "o_orderstatus", "n", last.select("s").scalar().alias("last_status"),
        last.select("r").scalar().alias("last_reason"))


@register("privacy_guard", """
    select 'raw' as layer, 'borrowers' as table_name, 'fingerprint_template_ref' as column_name,
        count(borrower_id) as n_values from raw_cbs_borrowers
    union all select 'marts', 'copy', 'template', count(borrower_id) from raw_cbs_borrowers""")
def privacy_guard(spark, sf_dir):
    """A column of an excluded class is found by its name and, once renamed, by its tag, with the
    number of values that got through."""
    classes = plan.CLASSIFICATION["cbs_borrowers.csv"]
    rows = raw(spark, sf_dir, "cbs_borrowers").withColumn("fingerprint_template_ref", F.md5("borrower_id"))
    tagged = tag_columns(rows, classes)
    return guard_values({
        "raw": {"borrowers": tagged, "cleaned": drop_classes(tagged, classes)},
        "marts": {"copy": tagged.select(
            "borrower_id", F.col("fingerprint_template_ref").alias("template"))},
    }, classes)


# ---- monitoring ------------------------------------------------------------------------------

_DAILY = """(select event_type, ts::date as run, count(*) as n, count(*) filter (value > 100) as n_bad,
    n_bad - 15 as diff, abs(diff) <= 3 as ok from events group by all)"""


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("run")).agg(
        F.count("*").alias("n"), F.count_if(F.col("value") > 100).alias("n_bad")
    ).withColumn("diff", F.col("n_bad") - 15).withColumn("ok", F.abs("diff") <= 3)


@register("recon_drift", f"""
    select event_type, run, diff, case when was then 'newly failing' else 'failing by more' end as drift
    from (select *, lag(ok) over w as was, lag(abs(diff)) over w as size from {_DAILY}
          window w as (partition by event_type order by run))
    where not ok and (was or abs(diff) > size)""")
def recon_drift(spark, sf_dir):
    return history.recon_drift(_daily(spark, sf_dir), ["event_type"], "run", "ok", "diff")


@register("quarantine_spike", f"""
    select * from (
        select event_type, run, n_bad, avg(n_bad) over (
            partition by event_type order by run rows between 7 preceding and 1 preceding) as trailing_avg
        from {_DAILY}) where n_bad > trailing_avg * 1.25""")
def quarantine_spike(spark, sf_dir):
    return history.quarantine_spike(
        _daily(spark, sf_dir), "event_type", "run", "n_bad", window=7, factor=1.25)


@register("queue_growth", """
    select * from (
        select 'carts' as queue, run, open_count,
            open_count - lag(open_count) over (order by run) as growth
        from (select ts::date as run, count(*) as open_count from events e
              where event_type = 'click' and user_id not in (select user_id from events where event_type = 'error' and value > 200)
              group by 1)) where growth > 0""")
def queue_growth(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    cleared = events.filter("event_type = 'error' and value > 200")
    still_open = history.open_items(events.filter("event_type = 'click'"), cleared, ["user_id"])
    per_run = still_open.groupBy(F.lit("carts").alias("queue"), F.to_date("ts").alias("run")).agg(
        F.count("*").alias("open_count"))
    return history.queue_growth(per_run, "queue", "run", "open_count")


@register("run_reliability", """
    select a.run_day, sum(b.runs)::bigint as run_count, sum(b.done)::bigint as completed_count,
        sum(b.done)::double / sum(b.runs) as completion_rate
    from (select distinct ts::date as run_day from events) a
    join (select ts::date as d, count(*) as runs, count(*) filter (value < 100) as done from events group by 1) b
        on b.d between a.run_day - 6 and a.run_day group by 1""")
def run_reliability(spark, sf_dir):
    runs = table(spark, sf_dir, "events").select("ts", (F.col("value") < 100).alias("completed"))
    return history.run_reliability(runs, "ts", "completed", days=7)


# ---- decisions -------------------------------------------------------------------------------

_OVERRIDES = "select source_system, source_id, 'ECID-MANUAL' || right(source_id, 1) as decided from parties where source_id like '%7'"


@register("apply_overrides", f"""
    select coalesce(decided, enterprise_client_id) as enterprise_client_id, source_system, source_id,
        match_tier, decided is not null as is_overridden
    from parties left join ({_OVERRIDES}) using (source_system, source_id)""")
def apply_overrides(spark, sf_dir):
    links = Lending(spark, sf_dir).links()
    overrides = links.filter("source_id like '%7'").select(
        "source_system", "source_id",
        F.concat(F.lit("ECID-MANUAL"), F.substring("source_id", -1, 1)).alias("enterprise_client_id"))
    return decisions.apply_overrides(links, overrides).select(
        "enterprise_client_id", "source_system", "source_id", "match_tier", "is_overridden")


@register("gated_export", """
    select enterprise_client_id, source_system, source_id, match_tier from parties
    where match_tier = 'id_number' or source_id like '%3'""")
def gated_export(spark, sf_dir):
    links = Lending(spark, sf_dir).links()
    confirmed = links.filter("source_id like '%3'").select("source_system", "source_id")
    return decisions.gated_export(links, confirmed)


@register("match_quality", """
    select *, true_positives::double / (true_positives + false_positives) as precision,
        true_positives::double / (true_positives + false_negatives) as recall
    from (
        select count(*) filter (hit and same) as true_positives, count(*) filter (hit and not same) as false_positives,
            count(*) filter (not hit and same) as false_negatives
        from (
            select k % 10 <> 4 as same, ifnull(a.enterprise_client_id = b.enterprise_client_id, false) as hit
            from (select c_custkey as k from customer) c
            left join (from parties where source_system = 'ims') a on a.source_id = 'C' || k
            left join (from parties where source_system = 'cbs') b on b.source_id = 'B' || k))""")
def match_quality(spark, sf_dir):
    """Labels: the customer a record was made from; every tenth pair is labelled as different."""
    key = F.col("c_custkey")
    labelled = table(spark, sf_dir, "customer").select(
        F.lit("ims").alias("source_system_a"), F.concat(F.lit("C"), key.cast("string")).alias("source_id_a"),
        F.lit("cbs").alias("source_system_b"), F.concat(F.lit("B"), key.cast("string")).alias("source_id_b"),
        (key % 10 != 4).alias("is_same"))
    return decisions.match_quality(Lending(spark, sf_dir, keep=("parties",)).links(), labelled)


# ---- streams ---------------------------------------------------------------------------------

_EVENT_COLUMNS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def _event_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


@register("stream_upsert", """
    select user_id, max(ts) as ts, arg_max(event_type, ts) as event_type from events group by 1""")
def stream_upsert_query(spark, sf_dir):
    """Extracts of two halves of the month, the later half first, each ingested by a run of the stream."""
    root = scratch(spark)
    store = SnapshotStore(spark, f"{root}/store")
    events = _event_columns(spark, sf_dir)
    for half in ("ts >= timestamp_ntz '2024-01-16'", "ts < timestamp_ntz '2024-01-16'"):
        events.filter(half).write.mode("append").parquet(f"{root}/landing")
        stream_upsert(
            stream_files(spark, f"{root}/landing", _EVENT_COLUMNS, "parquet"), store, "latest",
            ["user_id"], latest_first("ts"), f"{root}/checkpoint",
        ).awaitTermination()
    return store.read("latest").select("user_id", "ts", "event_type")


_LATE_DAYS = 3
_DELIVERIES = """
    -- every event with the batch it should come in
    days as (select event_id, ts, case when ts < timestamp '2024-01-11' then 1 when ts < timestamp '2024-01-21' then 2 else 3 end as own
             from events),
    deliveries as (
        select event_id, ts, 0 as copy, case when event_id % 13 = 0 then least(own + 1, 3) else own end as batch from days  -- some a batch late
        union all select event_id, ts, 1, least(own + 1, 3) from days where event_id % 13 in (1, 2)  -- again, unchanged
        union all select event_id, ts + interval 12 day, 2, case when ts + interval 12 day < timestamp '2024-01-21' then 2 else 3 end
            from days where event_id % 13 = 3 and ts < timestamp '2024-01-19'  -- again, twelve days later
    )"""


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three batches: some a batch late, some delivered again, some used again under an old key."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))

    def own(ts):
        return F.when(ts < F.lit("2024-01-11").cast("timestamp"), 1).when(ts < F.lit("2024-01-21").cast("timestamp"), 2).otherwise(3)

    kind, ts = F.col("event_id") % 13, F.col("ts")
    later = ts + F.expr("interval 12 days")
    once = events.select("event_id", "ts", F.lit(0).alias("copy"), F.when(kind == 0, F.least(own(ts) + 1, F.lit(3))).otherwise(own(ts)).alias("batch"))
    again = events.filter(kind.isin(1, 2)).select("event_id", "ts", F.lit(1).alias("copy"), F.least(own(ts) + 1, F.lit(3)).alias("batch"))
    reused = events.filter((kind == 3) & (ts < F.lit("2024-01-19").cast("timestamp"))).select(
        "event_id", later.alias("ts"), F.lit(2).alias("copy"), F.greatest(own(later), F.lit(2)).alias("batch"))
    return once.unionAll(again).unionAll(reused)


@register("stream_dedup", f"""
    with {_DELIVERIES},
    -- the watermark that a batch meets: the latest time of the batches before it, less the bound
    marks as (select b as batch, (select max(ts) from deliveries where batch < b) - interval {_LATE_DAYS} day as mark
              from (select unnest([1, 2, 3]) as b)),
    timely as (select d.*, mark from deliveries d join marks using (batch) where mark is null or ts > mark)
    select t.event_id, epoch_us(t.ts) as event_us, t.batch from timely t
    where not exists (  -- an earlier row of the key that was taken and is still remembered
        select 1 from timely f where f.event_id = t.event_id and (f.batch < t.batch or (f.batch = t.batch and f.copy < t.copy))
            and (t.mark is null or f.ts + interval {_LATE_DAYS} day > t.mark))""")
def stream_dedup_query(spark, sf_dir):
    """Three batches under a moving watermark: a row beyond the bound is dropped, a key is dropped while it is remembered, and
    taken again once it was forgotten."""
    root = scratch(spark)
    rows = _deliveries(spark, sf_dir)
    schema = "event_id bigint, ts timestamp, copy int, batch int"
    for batch in (1, 2, 3):
        rows.filter(F.col("batch") == batch).write.mode("append").parquet(f"{root}/landing")
        deduped = stream_dedup(
            stream_files(spark, f"{root}/landing", schema, "parquet"), "ts", ["event_id"], f"{_LATE_DAYS} days")
        deduped.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").option(
            "path", f"{root}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(f"{root}/out").select("event_id", F.unix_micros("ts").alias("event_us"), "batch")
