import datetime as dt

import pytest

from tallyline.plans.lending import CLASSIFICATION, CONTRACTS, REPAYMENTS_V2
from tallyline.plans.nightly import ARRIVAL_LOG, ARRIVAL_LOG_SCHEMA, run_nightly
from tallyline.sources.store import SnapshotStore


def csv(source, *rows):
    columns = CONTRACTS[source].columns
    lines = [",".join(columns)]
    for row in rows:
        cells = [str(row.get(c, "")) for c in columns]
        lines.append(",".join(f'"{c}"' if "," in c else c for c in cells))
    return "\n".join(lines) + "\n"


CLIENTS = [
    dict(ims_client_id="C1", first_name="Hawa", last_name="Abdi", sex="F", date_of_birth="07/05/1990",
         phone_1="0712-1", country="Kenya ", id_document_number="FAR-24-1", updated_at="2026-01-02T10:00:00Z"),
    dict(ims_client_id="C1", first_name="Hawa", last_name="Abdi", date_of_birth="1990-05-07", country="KE",
         updated_at="2025-01-02T10:00:00Z"),
    dict(ims_client_id="C2", first_name="Ali", last_name="Noor", date_of_birth="2012-01-01", phone_1="0712-2",
         country="Tchad", updated_at="2026-01-01"),
    dict(ims_client_id="C3", first_name="Sara", date_of_birth="1990", country="Atlantis"),
]
BORROWERS = [
    dict(borrower_id="B1", full_name="ABDI HAWA", gender="f", date_of_birth="1990-05-07", country="ke",
         id_number="far241", mobile_no="07 12 1", fingerprint_template_ref="SECRET", created_on="2025-02-01"),
    dict(borrower_id="B2", full_name="Omar Noor", date_of_birth="1980-01-01", country="TD", mobile_no="07122",
         created_on="2025-02-01"),
    dict(borrower_id="B3", full_name="", country="XX"),
]
LOANS = [
    dict(loan_id="L1", borrower_id="B1", country="KE", currency="Ksh", principal="11,360.00",
         disbursed_at="2026-01-31T23:30:00+02:00", status="ACTIVE"),
    dict(loan_id="L2", borrower_id="B2", country="TD", currency="XAF", principal="1 175 000",
         disbursed_at="2026-02-10", status="Closed (obligations met)"),
    dict(loan_id="L3", borrower_id="B3", country="KE", currency="KES", principal="5", disbursed_at="2026-02-10",
         status="active"),
]
REPAYMENTS = [
    dict(txn_id="T1", loan_id="L1", paid_at="2026-02-01T09:00:00Z", amount="500.00", currency="KES"),
    dict(txn_id="T2", loan_id="L3", paid_at="2026-02-01T09:00:00Z", amount="5", currency="KES"),
    dict(txn_id="T3", loan_id="L1", paid_at="2026-02-02T09:00:00Z", amount="-1", currency="KES"),
]
RATES = [
    dict(currency="KES", rate_date="2026-01-30", rate_type="Official", units_per_usd="128.5"),
    dict(currency="KES", rate_date="2026-02-01", rate_type="official", units_per_usd="130"),
    dict(currency="KES", rate_date="2026-01-31", rate_type="parallel", units_per_usd="150"),
    dict(currency="XAF", rate_date="2026/03/01", rate_type="official", units_per_usd="600"),
    dict(currency="XAF", rate_date="2026-03-02", rate_type="official", units_per_usd="0"),
]
TOTALS = [
    dict(country="Kenya", month="2026-01", currency="KSH", loans_disbursed_count=1,
         loans_disbursed_amount=11360, repayments_count=0, repayments_amount=0),
    dict(country="Kenya", month="2026-02", currency="KES", loans_disbursed_count=0, loans_disbursed_amount=0,
         repayments_count=1, repayments_amount=500),
    dict(country="Chad", month="2026-02", currency="XAF", loans_disbursed_count=1,
         loans_disbursed_amount="1,175,000", repayments_count=0, repayments_amount=0),
]


def write(folder, **texts):
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)


@pytest.fixture(scope="module")
def nights(spark, tmp_path_factory):
    folder, root = tmp_path_factory.mktemp("in"), str(tmp_path_factory.mktemp("out"))
    write(
        folder, ims_clients=csv("ims_clients", *CLIENTS), cbs_borrowers=csv("cbs_borrowers", *BORROWERS),
        cbs_loans=csv("cbs_loans", *LOANS), cbs_repayments_day1=csv("cbs_repayments", *REPAYMENTS),
        fx_rates=csv("fx_rates", *RATES), cbs_control_totals=csv("cbs_control_totals", *TOTALS),
    )
    first = run_nightly(spark, str(folder), root)
    # next night: a drifted daily file, and totals that no longer tie out
    write(
        folder,
        cbs_repayments_day2="txn_id,loan_id,paid_at,amount_paid,currency,channel,agent_code,reversal_of\n"
                            "T9,L1,2026-02-03T09:00:00Z,500,KES,,,\n",
        cbs_control_totals=csv("cbs_control_totals", *TOTALS[:2],
                               {**TOTALS[2], "loans_disbursed_amount": "900000"}),
    )
    second = run_nightly(spark, str(folder), root)
    return SnapshotStore(spark, root), first, second


def test_first_night_publishes(nights):
    _, first, _ = nights
    assert first.published, first.results.filter("not passed").collect()
    assert first.results.count() == 26
    mart = {r.loan_id: r for r in first.tables["loan_mart"].collect()}
    assert set(mart) == {"L1", "L2"}
    assert (mart["L1"].principal_usd, mart["L1"].fx_rate_is_estimated) == (88.4, False)
    assert mart["L1"].fx_rate_date == dt.date(2026, 1, 30)
    assert (mart["L2"].principal_usd, mart["L2"].fx_rate_is_estimated) == (1958.33, True)


def test_quarantine_cascades_and_counts_add_up(nights):
    _, first, _ = nights
    counts = {r.source_name: (r.raw_count, r.passed_count, r.quarantined_count)
              for r in first.tables["dq_summary"].collect()}
    assert counts == {
        "ims_clients": (4, 2, 2), "cbs_borrowers": (3, 2, 1), "cbs_loans": (3, 2, 1),
        "cbs_repayments": (3, 1, 2), "fx_rates": (5, 4, 1), "cbs_control_totals": (3, 3, 0)}
    why = {r.txn_id: r.quarantine_reasons for r in first.tables["stg_cbs_repayments_quarantine"].collect()}
    assert why == {
        "T2": ["loan_id not found in valid cbs_loans (missing or quarantined upstream): L3"],
        "T3": ["negative amount without a reversal_of reference"]}


def test_identity_and_privacy(nights):
    _, first, _ = nights
    ids = {r.source_id: r.enterprise_client_id for r in first.tables["client_crosswalk"].collect()}
    assert ids["C1"] == ids["B1"] and ids["C2"] != ids["B2"]
    queue = {(r.source_id, r.partner_count) for r in first.tables["review_queue"].collect()}
    assert queue == {("C2", 1), ("B2", 1)}
    minors = {r.ims_client_id: r.is_minor for r in first.tables["stg_ims_clients"].collect()}
    assert minors == {"C1": False, "C2": True}
    for name, df in first.tables.items():
        assert "fingerprint_template_ref" not in df.columns, name
    personal = {c for cols in CLASSIFICATION.values() for c, k in cols.items()
                if k in ("personal", "sensitive", "restricted", "excluded")}
    assert not personal & set(first.tables["period_summary"].columns)


def test_blocked_night_keeps_the_published_tables(nights):
    store, first, second = nights
    assert not second.published
    failed = [r.check_name for r in second.results.filter("not passed").collect()]
    assert failed == ["reconciliation_within_tolerance"]
    assert store.read("published_loan_mart").count() == 2
    log = store.read_log("publish_log", "run_at timestamp, status string, reason string").orderBy("run_at").collect()
    assert [r.status for r in log] == ["PUBLISHED", "BLOCKED"]
    assert log[1].reason == "failed checks: reconciliation_within_tolerance"
    from tallyline.sources.arrival import LOG_SCHEMA
    arrivals = store.read_log("arrival_log", LOG_SCHEMA)
    rejected = arrivals.filter("status = 'FAIL' and file = 'cbs_repayments_day2.csv'").collect()
    assert len(rejected) == 1 and "amount_paid" in rejected[0].reason
    # the accepted daily file came twice and was merged once
    assert second.tables["raw_cbs_repayments"].count() == 3


def test_a_night_takes_both_versions_of_a_source(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(
        folder, ims_clients=csv("ims_clients", *CLIENTS), cbs_borrowers=csv("cbs_borrowers", *BORROWERS),
        cbs_loans=csv("cbs_loans", *LOANS), cbs_repayments_day1=csv("cbs_repayments", *REPAYMENTS),
        cbs_repayments_day2="txn_id,loan_id,paid_at,amount_paid,currency,channel,agent_code,reversal_of\n"
                            "T9,L1,2026-02-03T09:00:00Z,500,KES,,AG7,\n",
        fx_rates=csv("fx_rates", *RATES),
        cbs_control_totals=csv("cbs_control_totals", TOTALS[0], {**TOTALS[1], "repayments_count": 2, "repayments_amount": 1000}, TOTALS[2]),
    )
    classes = {**CLASSIFICATION["cbs_repayments_*.csv"], "amount_paid": "internal", "agent_code": "internal"}
    night = run_nightly(
        spark, str(folder), str(tmp_path / "out"), contracts={**CONTRACTS, "cbs_repayments": [CONTRACTS["cbs_repayments"], REPAYMENTS_V2]},
        classification={**CLASSIFICATION, "cbs_repayments_*.csv": classes})
    assert night.published, night.results.filter("not passed").collect()
    raw = {r.txn_id: (r.amount, r.agent_code) for r in night.tables["raw_cbs_repayments"].collect()}
    assert raw["T9"] == ("500", "AG7") and raw["T1"] == ("500.00", None) and len(raw) == 4
    log = SnapshotStore(spark, str(tmp_path / "out")).read_log(ARRIVAL_LOG, ARRIVAL_LOG_SCHEMA)
    assert {r.file: r.contract_version for r in log.filter("source = 'cbs_repayments'").collect()} == {
        "cbs_repayments_day1.csv": 1, "cbs_repayments_day2.csv": 2}


def test_nothing_arrived_is_blocked_not_broken(spark, tmp_path):
    run = run_nightly(spark, str(tmp_path / "none"), str(tmp_path / "out"))
    assert not run.published and run.results.count() == 6
